"""textmill: a PySpark-native engine for curating language data."""

__version__ = "0.1.0"
