"""Healthcare lakehouse analytics on PySpark: raw files to a star schema to answers."""

__version__ = "0.1.0"
