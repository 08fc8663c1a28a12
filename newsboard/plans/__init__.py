"""The view graph over the stored tables, and stored results."""
