"""Derived tables, the registered queries and their SQL counterparts."""
