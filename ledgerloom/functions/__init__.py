"""Column → Column building blocks. No joins, no actions."""
