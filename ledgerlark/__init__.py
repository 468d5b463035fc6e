"""ledgerlark: a lending-analytics engine written as PySpark DataFrame plans."""

__version__ = "0.1.0"
