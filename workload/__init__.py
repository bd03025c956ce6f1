"""Queries over the test tables: inputs, one query per operator, and their SQL counterparts."""
