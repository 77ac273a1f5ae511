"""millrace: a PySpark-native document curation and retrieval engine."""
