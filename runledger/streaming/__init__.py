"""The run-status queries over a feed that keeps growing."""
