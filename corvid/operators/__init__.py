"""DataFrame -> DataFrame operators, one module per workload."""
