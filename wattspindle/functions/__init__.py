"""Column functions: native expressions only, no Python workers."""
