"""DataFrame -> DataFrame operators: skew-safe joins, keys, profiling, validation."""
