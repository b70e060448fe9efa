"""The given test tables, bound to the package's tables, and the query registry."""
