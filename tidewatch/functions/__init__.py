"""Column functions: scores, text parsing, calendar terms."""
