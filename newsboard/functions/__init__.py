"""Column helpers: every one maps columns to a column, no UDFs."""
