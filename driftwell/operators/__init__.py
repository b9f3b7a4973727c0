"""DataFrame operators over change events and table state."""
