"""Multi-operator plans."""
