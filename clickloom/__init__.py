"""Harmonise acoustic click-detector recordings and deployment metadata with Spark."""
