"""catalogloom operators."""
