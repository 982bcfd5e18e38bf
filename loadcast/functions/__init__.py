"""Column-level functions: time buckets and grids, calendar features, labels."""
