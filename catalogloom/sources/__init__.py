"""catalogloom sources."""
