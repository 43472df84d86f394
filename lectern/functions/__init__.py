"""Column functions on transcript text."""
