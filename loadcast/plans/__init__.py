"""End-to-end plans: feature table, training, statistics and scoring."""
