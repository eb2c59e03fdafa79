"""Price-driver studies on city data, written as Spark DataFrame operators."""

__version__ = "0.1.0"
