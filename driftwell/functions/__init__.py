"""Column functions that convert change-event values to analytic types and texts."""
