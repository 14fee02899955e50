"""voltloom: a PySpark-native engine for smart-meter series and low-voltage grid topology."""

__version__ = "0.1.0"
