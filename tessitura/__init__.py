"""Corpus timeline analytics expressed as Spark DataFrame operators."""
