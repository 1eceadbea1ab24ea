"""Table-level operators the plans are built from."""
