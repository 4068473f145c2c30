"""lamplight: a PySpark-native engine for document, retrieval and catalogue-sync pipelines."""
