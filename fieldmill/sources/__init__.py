"""Readers.  Schemas are explicit; nothing is inferred from the data."""
