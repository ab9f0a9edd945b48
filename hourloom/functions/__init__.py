"""Pure Column expressions (no data movement)."""
