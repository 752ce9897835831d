"""Reading tables, picking snapshots, and writing versioned results."""
