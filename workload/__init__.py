"""The registered queries: the operators applied to the given tables, and their SQL checks."""
