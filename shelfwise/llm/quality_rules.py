"""Quality rules: counts of a text's form, and a log-likelihood ratio of hashed n-grams."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm import ngram_models
from shelfwise.llm.line_dedup import line_spans
from shelfwise.llm.words import (
    NOT_SPACE, byte_set, covered, first_words, gram_fits, gram_hashes, pieces, span_hashes,
    text_buffer, word_spans,
)

LEAST_WORDS = 10
REPEAT_WINDOW = 5
MOST_REPEAT_PERCENT = 20

_SYMBOLS = byte_set(b"#*$%&|<>")
COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "log_ratio"]


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive bounds."""
    return np.diff(np.concatenate(([0], np.cumsum(values)))[bounds])


def _repeated(owner: np.ndarray, hashes: np.ndarray):
    """Whether each hash occurs more than once in its text, and whether it did before."""
    order = np.lexsort((np.arange(len(hashes)), hashes, owner))
    same = (np.diff(hashes[order]) == 0) & (np.diff(owner[order]) == 0)
    often, again = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
    again[order[1:]] = same
    often[order[1:]] |= same
    often[order[:-1]] |= same
    return often, again


def form(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of the base rules for a column of texts."""
    data, offsets = text_buffer(texts)
    starts, ends, text_of = word_spans(data, offsets, NOT_SPACE)
    begin = first_words(text_of, len(texts))
    leads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    windows = gram_hashes(span_hashes(data, starts, ends), REPEAT_WINDOW)
    fits = np.flatnonzero(gram_fits(text_of, REPEAT_WINDOW))
    often, _ = _repeated(text_of[fits], windows[fits])
    repeats = covered(fits[often], REPEAT_WINDOW, len(starts))
    line_starts, line_ends, line_text = line_spans(data, offsets)
    filled = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends, line_text = line_starts[filled], line_ends[filled], line_text[filled]
    _, again = _repeated(line_text, span_hashes(data, line_starts, line_ends))
    return {
        "n_words": np.diff(begin),
        "word_chars": _per_text(leads[ends] - leads[starts], begin),
        "n_symbols": _per_text(_SYMBOLS[data], offsets),
        "n_dup_lines": np.bincount(line_text[again], minlength=len(texts)),
        "n_repeat_words": _per_text(repeats, begin),
    }


def _measure(models: ngram_models.Models):
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = piece.column("text")
                found = form(texts)
                scored = ngram_models.measures(texts, models)
                columns = [pa.array(found[c].astype(np.int64)) for c in COLUMNS[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("rest"), *columns, pa.array(scored.mean), pa.array(scored.tail >= models.limit)],
                    names=["rest", *COLUMNS, "clean"],
                )

    return run


def apply_rules(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """``docs`` without its text, with the counts of the base rules, log_ratio, base_failed, kept.

    Base rules: fewer than ``LEAST_WORDS`` words, or more than ``MOST_REPEAT_PERCENT`` percent of
    the words in windows of ``REPEAT_WINDOW`` words that the text has twice. Others are kept if
    the log of their n-grams' likelihood under the trusted documents' model over that under the
    model of all documents, divided by the number of n-grams (and ``ngram_models.NEUTRAL``), is at
    least ``threshold`` (or else the models' floor), and if the words that convict them as toxic stay
    within the models' limit. Floor and limit come from held-out labelled documents, counts for the
    models from all documents and from all other labelled ones.

    Null or empty text: all counts are zero, the base rules fail. Null or repeated ``doc_id``: each
    row is judged alone; without an id a document is never a trusted one. Equal rows get equal
    results. Columns of the input named like an added one are replaced. Empty tables of either kind
    are allowed; without trusted documents the models agree and only the base rules decide.
    """
    models = ngram_models.fit(docs, labels)
    threshold = models.floor if threshold is None else threshold
    added = [*COLUMNS, "base_failed", "kept"]
    given = [c for c in docs.columns if c != "text"]
    read = docs.select(F.struct(*[F.col(f"`{c}`") for c in given]).alias("rest"), F.col("text").cast("string").alias("text"))
    rest = read.schema["rest"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in COLUMNS[:-1])
    measured = read.mapInArrow(_measure(models), f"rest {rest}, {counts}, log_ratio double, clean boolean")
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEAT_PERCENT * F.col("n_words")
    )
    return measured.select(
        *[F.col("rest").getField(c).alias(c) for c in given if c not in added],
        *COLUMNS, failed.alias("base_failed"), (~failed & F.col("clean") & (F.col("log_ratio") >= threshold)).alias("kept"),
    )
