"""Queries of the engine over the star-schema test tables, with their SQL counterparts."""
