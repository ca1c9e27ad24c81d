"""Column -> Column helpers; everything here is row-local and runs in the JVM."""
