"""Sales analytics warehouse, result tables and live alert rules on PySpark."""

__version__ = "0.1.0"
