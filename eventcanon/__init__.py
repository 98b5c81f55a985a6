"""eventcanon: land, validate, canonicalise, fold, project and report on event data with PySpark."""

__version__ = "0.1.0"
