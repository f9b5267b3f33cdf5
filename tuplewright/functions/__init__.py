"""Column functions: labels, tags, text, task detection."""
