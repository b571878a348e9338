"""Named queries with their SQL counterparts, over views of the given tables."""
