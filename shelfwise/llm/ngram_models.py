"""Multinomial models over hashed n-grams of trusted and of all texts, and of toxic ones."""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.ordered import running_sums
from shelfwise.llm.words import (
    NOT_SPACE, first_words, gram_fits, gram_hashes, pieces, span_hashes, text_buffer, word_spans,
)
from shelfwise.session import staged

#: Buckets of each kind of feature; all models have KINDS times as many cells.
BUCKETS = 1 << 16
KINDS = 2
SMOOTHING = 1.0
#: Neutral n-grams added to a text where its log ratio is divided by its length, so that a few odd
#: words do not decide over a short text.
NEUTRAL = 16
#: The least log ratio per n-gram of a text that counts as good, where too few labels tell a better one.
FLOOR = -0.3
#: One of so many labelled documents is held out of the models; on these the limits are set.
HELD = 3
#: The least number of trusted and of rejected held-out documents that set a limit.
LEAST_HELD = 8
#: The share of held-out trusted documents that each limit may lose.
MOST_LOST = 0.02
#: Words this much likelier in toxic than in trusted documents (as a log ratio) convict a text.
CONVICTS = -1.5
TRUSTED, TOXIC, LOW = 1, 2, 4
#: Of every row, where the counts of all texts and of labelled ones are made in one pass.
ANY = 8

#: Classes of bytes in a word's shape: letters by case, digits, and each other sign as itself.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[0x30:0x3A] = ord("0")
_CLASS[0x41:0x5B] = ord("A")
_CLASS[0x61:0x7B] = ord("a")
_CLASS[0x80:] = ord("a")


class Features(NamedTuple):
    cells: np.ndarray
    row: np.ndarray


def features(texts: pa.Array) -> Features:
    """The cells of all n-grams of a column of texts and the row of each.

    A word gives its own hash and that of its shape with the shape before it. A shape is the word's
    runs of byte classes; a word equal to the one before has the shape of a repeat.
    """
    data, offsets = text_buffer(texts)
    starts, ends, row = word_spans(data, offsets, NOT_SPACE)
    if not len(starts):
        return Features(np.zeros(0, np.int64), np.zeros(0, np.int64))
    words = span_hashes(data, starts, ends)
    classes = _CLASS[data]
    turn = np.ones(len(data), bool)
    turn[1:] = classes[1:] != classes[:-1]
    turn[starts] = True
    at = np.concatenate(([0], np.cumsum(turn)))
    shapes = span_hashes(classes[turn], at[starts], at[ends], 1)
    repeat = np.zeros(len(words), bool)
    repeat[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
    shapes[repeat] = 0
    pairs = gram_hashes(shapes, 2)
    fits = gram_fits(row, 2)
    cells = np.concatenate((words % BUCKETS, pairs[fits] % BUCKETS + BUCKETS)).astype(np.int64)
    return Features(cells, np.concatenate((row, row[1:][fits])))


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Per cell the log of target over raw probability; each kind is a multinomial of its own.

    The raw counts, which include the target's, are also the prior of the target. It weighs as much
    as the target but no more than one n-gram per cell, so that a small target convicts nothing
    for merely being new to it.
    """
    out = []
    for t, r in zip(target.reshape(KINDS, -1), raw.reshape(KINDS, -1)):
        p = (r + SMOOTHING) / (r.sum() + SMOOTHING * len(r))
        prior = min(max(t.sum(), 1.0), SMOOTHING * len(r))
        out.append(np.log((t + prior * p) / (t.sum() + prior)) - np.log(p))
    return np.concatenate(out)


def convictions(toxic: np.ndarray, trusted: np.ndarray) -> np.ndarray:
    """Per cell the log ratio of trusted over toxic probability, if that is below ``CONVICTS``, or else 0.

    Only words convict. One word spread over the models is the prior of a cell.
    """
    out = np.zeros(len(toxic))
    bad, good = toxic[:BUCKETS], trusted[:BUCKETS]
    if bad.sum() and good.sum():
        ratio = np.log(good / good.sum() + SMOOTHING / bad.sum()) - np.log((bad + SMOOTHING) / bad.sum())
        out[:BUCKETS] = np.where(ratio <= CONVICTS, ratio, 0)
    return out


class Models(NamedTuple):
    #: Per cell: trusted over all texts, trusted over toxic texts.
    ratios: np.ndarray
    convictions: np.ndarray
    #: The least log ratio per n-gram, and the least sum of convictions per root of n-grams.
    floor: float = FLOOR
    limit: float = -np.inf


def best_limit(good: np.ndarray, bad: np.ndarray, default: float) -> float:
    """The limit below which most of ``bad`` and fewest of ``good`` values lie.

    At most ``MOST_LOST`` of the good ones lie below. The limit is in the middle between two values.
    With fewer than ``LEAST_HELD`` of either it is ``default``.
    """
    if min(len(good), len(bad)) < LEAST_HELD:
        return default
    values = np.unique(np.concatenate((good, bad)))
    limits = np.concatenate((values[:1] - 1, (values[1:] + values[:-1]) / 2))
    lost = np.searchsorted(np.sort(good), limits) / len(good)
    caught = np.searchsorted(np.sort(bad), limits) / len(bad)
    return float(limits[np.argmax(np.where(lost <= MOST_LOST, caught - lost, -1))])


def best_limits(values: DataFrame, defaults: dict[str, float]) -> dict[str, float]:
    """As ``best_limit``, by name, of rows ``name, value, good, bad`` of any number.

    ``good`` and ``bad`` say how often a value is one of these. The counts below each value are running
    sums over ranges of the values; the driver gets a row for each name.
    """
    points = staged(values.groupBy("name", "value").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")), "points")
    totals = points.groupBy("name").agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"))
    enough = totals.where(F.least("n_good", "n_bad") >= LEAST_HELD)
    below = running_sums(points, ["name"], ["value"], {"upto_good": F.col("good"), "upto_bad": F.col("bad")})
    lost = (F.col("upto_good") - F.col("good")) / F.col("n_good")
    caught = (F.col("upto_bad") - F.col("bad")) / F.col("n_bad")
    score = F.when(lost <= MOST_LOST, caught - lost).otherwise(-1.0)
    scored = below.join(F.broadcast(enough), "name").select("name", F.struct(score, -F.col("value"), "value").alias("x"))
    chosen = {r.name: r.value for r in scored.groupBy("name").agg(F.max("x")["value"].alias("value")).collect()}
    before = [F.max(F.when((F.col("name") == n) & (F.col("value") < v), F.col("value"))).alias(n) for n, v in chosen.items()]
    previous = points.agg(*before).first() if before else {}
    found = {n: v - 1 if previous[n] is None else (v + previous[n]) / 2 for n, v in chosen.items()}
    return defaults | found


def judged(labels: DataFrame) -> DataFrame:
    """``doc_id, flags`` of all labelled documents: what each is, as flags.

    Rows without an id count for nothing; a document with several labels is trusted (quality 1, toxic 0)
    if all of them say so, toxic or of low quality if one does.
    """
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    found = known.agg(
        F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(1))).alias("t"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"), F.max((F.col("quality") == 0).cast("int")).alias("low"),
    )
    flags = F.when(F.expr("q = 1 AND t = 0"), TRUSTED).otherwise(0) + F.coalesce("toxic", F.lit(0)) * TOXIC
    return found.select("doc_id", (flags + F.coalesce("low", F.lit(0)) * LOW).alias("flags"))


def held_out() -> Column:
    """Whether a document is held out of the models if it is labelled, by its id."""
    return F.pmod(F.xxhash64(F.lit(HELD), "doc_id"), F.lit(HELD)) == 0


def trusted_ids(labels: DataFrame, limit: int | None = None) -> np.ndarray:
    """Sorted ids of the trusted documents, or of those among the first ``limit`` labelled ones by a hash of the id."""
    found = judged(labels)
    if limit is not None:
        found = found.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return np.array(sorted(r.doc_id for r in found.where(F.col("flags").bitwiseAND(TRUSTED) > 0).collect()), np.int64)


def _count(batches):
    """The cells of ``flags, text`` rows, counted for each flag."""
    raw = np.zeros(KINDS * BUCKETS, np.int64)
    parts = {ANY: raw, TRUSTED: np.zeros_like(raw), TOXIC: np.zeros_like(raw)}
    for batch in batches:
        for piece in pieces(batch, "text"):
            cells, row = features(piece.column("text"))
            flags = piece.column("flags").to_numpy(zero_copy_only=False)
            for flag, counts in parts.items():
                of = flags & flag > 0
                if of.any():
                    counts += np.bincount(cells if of.all() else cells[of[row]], minlength=len(raw))
    used = np.flatnonzero(sum(parts.values()))
    for part in np.array_split(used, max(1, len(used) // 8192)):
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), *[pa.array(c[part]) for c in parts.values()]],
            names=["cell", "raw", "target", "toxic"],
        )


def _measured(models: Models):
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                found = measures(piece.column("text"), models)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("flags"), pa.array(found.mean), pa.array(found.tail)],
                    names=["doc_id", "flags", "mean", "tail"],
                )

    return run


def fit(docs: DataFrame, labels: DataFrame) -> Models:
    """Ratios of each cell from raw counts of all documents and counts of trusted and toxic ones,
    and the limits that tell the labelled documents apart that are held out of these.

    All labelled documents count. Labels grow with the documents, so they meet the texts in sorted joins; the
    id alone says whether a document is held out, so that a text travels once. The result has a fixed size
    (twice KINDS * BUCKETS numbers), whatever the tables hold. Without trusted documents the ratios are zero.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = judged(labels).hint("merge")
    fitted = read.where(~held_out()).join(known, "doc_id").select("flags", "text")
    every = read.select(F.lit(ANY).alias("flags"), "text").unionByName(fitted)
    counts = every.mapInArrow(_count, "cell int, raw long, target long, toxic long")
    sums = counts.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("raw", "target", "toxic")]).toPandas()
    raw, target, toxic = np.zeros((3, KINDS * BUCKETS))
    for whole, name in ((raw, "raw"), (target, "target"), (toxic, "toxic")):
        whole[sums["cell"]] = sums[name]
    models = Models(log_ratio(target, raw), convictions(toxic, target))
    if not target.any():
        return models
    found = read.where(held_out()).join(known, "doc_id").select("doc_id", "flags", "text")
    found = found.mapInArrow(_measured(models), "doc_id long, flags int, mean double, tail double")
    # A document in many rows is one.
    held = found.groupBy("doc_id").agg(*[F.min(c).alias(c) for c in ("flags", "mean", "tail")])

    def times(flag):
        return (F.col("flags").bitwiseAND(flag) > 0).cast("long")

    values = F.inline(F.array(*[
        F.struct(F.lit(name).alias("name"), F.col(name).alias("value"), times(TRUSTED).alias("good"), times(bad).alias("bad"))
        for name, bad in (("mean", LOW), ("tail", TOXIC))
    ]))
    limits = best_limits(held.select(values).where("good + bad > 0"), {"mean": FLOOR, "tail": -np.inf})
    return models._replace(floor=limits["mean"], limit=limits["tail"])


class Measures(NamedTuple):
    #: The sum of log ratios, the number of n-grams, the log ratio per n-gram (and ``NEUTRAL``).
    total: np.ndarray
    count: np.ndarray
    mean: np.ndarray
    #: The sum of convictions over the root of the number of n-grams (and ``NEUTRAL``), which a few
    #: words move in a text of any length.
    tail: np.ndarray


def measures(texts: pa.Array, models: Models) -> Measures:
    cells, row = features(texts)
    count = np.bincount(row, minlength=len(texts))
    total = np.bincount(row, weights=models.ratios[cells], minlength=len(texts))
    convicted = np.bincount(row, weights=models.convictions[cells], minlength=len(texts))
    return Measures(total, count, total / (count + NEUTRAL), convicted / np.sqrt(count + NEUTRAL))
