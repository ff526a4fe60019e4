"""catalogloom streaming."""
