"""The driver's contract: test tables as a registry, queries, and their SQL counterparts."""
