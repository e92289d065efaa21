"""factloom: a PySpark-native engine for source-attributed fact graphs."""
