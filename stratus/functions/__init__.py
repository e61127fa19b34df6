"""Column-level helpers: calendar parts, rounding modes and rule labels."""
