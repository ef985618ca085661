"""kuramori - a PySpark-native engine for cultural-property, museum and hazard data."""

__version__ = "0.1.0"
