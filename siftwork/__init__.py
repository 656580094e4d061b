"""siftwork: a PySpark-native engine for curating figure and document collections."""
