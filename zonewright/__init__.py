"""zonewright: a PySpark-native engine for building and analysing corpora of domain names."""

__version__ = "0.1.0"
