"""Prepare language-model training corpora with Spark."""
