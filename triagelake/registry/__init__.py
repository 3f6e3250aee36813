"""Registered queries on the given tables and their SQL counterparts."""
