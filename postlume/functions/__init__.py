"""Column functions: no I/O, no actions."""
