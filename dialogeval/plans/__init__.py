"""End-to-end table jobs built from the operators."""
