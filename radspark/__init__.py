"""radspark: a PySpark-native engine for medical-image archives and dataset quality."""
