"""fieldmill: entity-field refinement of semi-structured pages as Spark jobs."""

__version__ = "0.1.0"
