"""PySpark-native corpus and safety-signal analytics."""
