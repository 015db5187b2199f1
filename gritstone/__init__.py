"""gritstone: a PySpark-native engine for event and entity feature engineering."""
