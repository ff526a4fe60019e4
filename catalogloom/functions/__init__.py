"""catalogloom functions."""
