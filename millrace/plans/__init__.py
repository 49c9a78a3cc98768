"""The shop's tables over the given data, and the named queries."""
