"""Schemas, file readers and adapters from the driver's test tables."""
