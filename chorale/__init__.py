"""chorale: a PySpark-native engine for labelled-signal datasets."""
