"""DataFrame operators: rollups, gap filling, lags, encoding, model and metrics."""
