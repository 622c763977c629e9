"""Registered queries: input views, Spark callables and their SQL twins."""
