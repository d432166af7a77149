"""Plan-level helpers (join strategy, skew-safe ranking) and the query catalog."""
