"""Queries over the generated tables, one per operator, with their SQL counterparts."""
