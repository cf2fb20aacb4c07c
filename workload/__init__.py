"""Queries over the driver's tables, with an independent SQL oracle for each."""
