"""DataFrame to DataFrame operators: profiling, data quality and joins."""
