"""Whole jobs: the load, the registered queries over the driver tables, and their SQL counterparts."""
