"""Record sources, table readers and writers, and the named-table registry."""
