"""folioforge: a PySpark-native engine for turning raw documents into structured, searchable tables."""

__version__ = "0.1.0"
