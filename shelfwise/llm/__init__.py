"""Operators over text corpora for training data, each a Spark job on tables of documents or pages."""
