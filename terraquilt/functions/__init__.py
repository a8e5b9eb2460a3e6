"""Column functions: no jobs, no joins, no Python workers."""
