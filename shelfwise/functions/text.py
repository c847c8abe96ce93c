"""Tokens and relevance weights."""

from pyspark.sql import Column, functions as F

# Fixed value: a token is a run of letters and digits of any script.
TOKEN_PATTERN = r"[\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def inverse_document_frequency(n_docs: Column, df: Column) -> Column:
    return F.ln(1 + (n_docs - df + 0.5) / (df + 0.5))


def saturation(tf: Column, dl: Column, avgdl: Column, k1: float, b: float) -> Column:
    """Term-frequency part of BM25 with length normalisation."""
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))
