"""loquela: a PySpark-native engine for corpora of transcribed conversations and the
time series recorded beside them."""

__version__ = "0.1.0"
