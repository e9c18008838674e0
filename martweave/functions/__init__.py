"""Column-level definitions: each takes Columns (or names) and returns a Column."""
