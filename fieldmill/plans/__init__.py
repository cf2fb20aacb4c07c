"""Whole runs over snapshots: discover, land, refine, catalog, export, compare.

Each step reads the table the step before it wrote, so a lost executor never costs more than the
step at hand.
"""
