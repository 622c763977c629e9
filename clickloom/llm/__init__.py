"""Operators of a training-data pipeline; see the docstring of each module for its method and edge cases."""
