"""marlstone: a PySpark-native engine for curating and analysing text corpora."""
