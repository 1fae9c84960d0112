"""Column functions: null rules and text handling."""
