"""Quillstone: a PySpark-native text-knowledge engine."""
