"""The row-local jobs on streams of files."""
