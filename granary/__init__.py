"""granary: a PySpark-native engine for building, cleaning, scoring and searching text corpora."""
