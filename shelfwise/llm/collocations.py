"""Phrases whose words occur together more often than apart, from sorted streams of phrase counts."""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.llm import chunks
from shelfwise.llm.ordered import running_lasts
from shelfwise.llm.words import (
    LOWER, byte_set, gram_fits, gram_hashes, pieces, span_hashes, text_buffer, word_spans,
)
from shelfwise.session import staged

LONGEST = 4
MIN_COUNT = 30
#: A candidate goes if a longer one around it has this share of its occurrences.
COVERED = (80, 100)
TOP = 2000
SCALE = 2_000_000

BREAKS = byte_set(b".,;:!?\n\x0b\x0c\r")
WORD = ~byte_set(b" \t.,;:!?\n\x0b\x0c\r")
#: Hashes that a bucket adds up at a time.
_AT_ONCE = 1 << 22


class _Chunk:
    """The words of a chunk's texts: places in one buffer, hashes, pieces and times counted."""

    def __init__(self, table: pa.Table):
        self.buffers, starts, ends, hashes, piece_of, row_of = [], [], [], [], [], []
        base = rows = breaks = 0
        for batch in table.select(["text"]).combine_chunks().to_batches():
            for part in pieces(batch, "text"):
                data, offsets = text_buffer(part.column("text"))
                data = LOWER[data]
                s, e, text_of = word_spans(data, offsets, WORD)
                before = np.cumsum(BREAKS[data])
                starts.append((s + base).astype(np.int32))
                ends.append((e + base).astype(np.int32))
                hashes.append(span_hashes(data, s, e))
                piece_of.append((before[s] + text_of + breaks).astype(np.int32))
                row_of.append((text_of + rows).astype(np.int32))
                self.buffers.append(data)
                base += len(data)
                rows += part.num_rows
                breaks += (int(before[-1]) if len(data) else 0) + part.num_rows
        self.starts, self.ends, self.words, self.piece_of, self.row_of = (
            np.concatenate(x) if x else np.zeros(0, np.int32) for x in (starts, ends, hashes, piece_of, row_of)
        )
        self.words = self.words.astype(np.uint64)
        self.langs = table.column("lang").to_pylist()
        hashes = {g: hashlib.blake2b(g.encode(), digest_size=8).digest() for g in set(self.langs)}
        self.lang_hash = np.frombuffer(b"".join([hashes[g] for g in self.langs]), np.uint64)
        self.times = table.column("times").combine_chunks().to_numpy(zero_copy_only=False)

    def phrases(self, n: int):
        """Distinct hashes of the phrases of ``n`` words in each language, in order, with the first
        word of one occurrence and the number of occurrences."""
        fits = np.flatnonzero(gram_fits(self.piece_of, n))
        rows = self.row_of[fits]
        hashes = gram_hashes(self.words, n)[fits] + self.lang_hash[rows]
        hashes = hashes ^ (hashes >> np.uint64(32)) ^ np.uint64(n)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        counts = np.zeros(len(distinct), np.int64)
        np.add.at(counts, which, self.times[rows])
        return distinct, fits[first], counts


def _send(buckets: int, longest: int, least: int):
    """One message per bucket: how many phrases of each length, their hashes, their counts.

    Counts beyond ``least`` need not be told apart, so they travel in as few bytes as it takes.
    """
    narrow = np.min_scalar_type(least)

    def send(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        chunk, sent = _Chunk(table), []
        for n in range(1, longest + 1):
            distinct, _, counts = chunk.phrases(n)
            slices = chunks.bucket_slices(distinct, buckets)
            sent.append((slices, distinct.astype(np.uint32), np.minimum(counts, least).astype(narrow)))
        sizes = np.stack([np.diff(slices) for slices, _, _ in sent])
        full = np.flatnonzero(sizes.any(axis=0))
        bodies = [
            sizes[:, k].tobytes() + b"".join(c[s[k] : s[k + 1]].tobytes() for s, *two in sent for c in two)
            for k in full
        ]
        return chunks.message_table(full, [key[0].as_py()] * len(full), 0, bodies)

    return send


def _judge(longest: int, least: int):
    narrow = np.min_scalar_type(least)

    def judge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """Which hashes reach the count over all chunks, in one answer to each chunk."""
        _, senders, bodies = chunks.of_kind(table, 0)
        sizes = np.stack([np.frombuffer(b, np.int64, longest) for b in bodies])
        at = [8 * longest] * len(bodies)
        bits = [b""] * len(bodies)
        for n in range(longest):
            hashes, counts = [], []
            for k, body in enumerate(bodies):
                hashes.append(np.frombuffer(body, np.uint32, sizes[k, n], at[k]))
                counts.append(np.frombuffer(body, narrow, sizes[k, n], at[k] + hashes[-1].nbytes))
                at[k] += hashes[-1].nbytes + counts[-1].nbytes
            hashes, counts = np.concatenate(hashes), np.concatenate(counts)
            frequent = np.zeros(len(hashes), bool)
            parts = len(hashes) // _AT_ONCE + 1
            part = (hashes.astype(np.uint64) * np.uint64(parts)) >> np.uint64(32)
            for p in range(parts):
                here = np.flatnonzero(part == p)
                which = np.unique(hashes[here], return_inverse=True)[1]
                frequent[here] = (np.bincount(which, counts[here]) >= least)[which]
            ends = np.cumsum(sizes[:, n])
            for k, (end, size) in enumerate(zip(ends, sizes[:, n])):
                bits[k] += np.packbits(frequent[end - size : end]).tobytes()
        return chunks.message_table([key[0].as_py()] * len(bits), senders, 0, bits)

    return judge


def _answers(replies: pa.Table, slices: list[np.ndarray]) -> list[np.ndarray]:
    """For each length, which of the phrases sent are frequent, in the order of their hashes."""
    out = [np.zeros(int(s[-1]), bool) for s in slices]
    buckets, _, bodies = chunks.of_kind(replies, 0)
    for bucket, body in zip(buckets, bodies):
        at = 0
        for found, s in zip(out, slices):
            a, b = int(s[bucket]), int(s[bucket + 1])
            size = (b - a + 7) // 8
            found[a:b] = np.unpackbits(np.frombuffer(body, np.uint8, size, at), count=b - a).astype(bool)
            at += size
    return out


def _count(buckets: int, longest: int):
    def count(key: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        """The chunk's counts of phrases that may be frequent, and its words by language."""
        chunk = _Chunk(table)
        text = np.concatenate(chunk.buffers).tobytes() if chunk.buffers else b""
        words = np.bincount(chunk.row_of, minlength=len(chunk.langs))
        langs, phrases, counts = list(chunk.langs), [None] * len(chunk.langs), (words * chunk.times).tolist()
        held = [chunk.phrases(n) for n in range(1, longest + 1)]
        answers = _answers(replies, [chunks.bucket_slices(distinct, buckets) for distinct, _, _ in held])
        for n, ((_, first, times), frequent) in enumerate(zip(held, answers), 1):
            first, times = first[frequent], times[frequent]
            spans = [
                list(zip(chunk.starts[first + k].tolist(), chunk.ends[first + k].tolist())) for k in range(n)
            ]
            phrases += [b" ".join([text[a:b] for a, b in s]).decode() for s in zip(*spans)]
            langs += [chunk.langs[r] for r in chunk.row_of[first].tolist()]
            counts += times.tolist()
        return pa.table(
            {"lang": pa.array(langs, pa.string()), "phrase": pa.array(phrases, pa.string()), "f": pa.array(counts, pa.int64())}
        )

    return count


def count_phrases(docs: DataFrame, longest: int = LONGEST, least: int = MIN_COUNT) -> DataFrame:
    """Columns lang, phrase (words joined by one space) and f: every phrase of up to ``longest``
    words that occurs at least ``least`` times, exactly counted; and a row without phrase for each
    language, whose f counts all its words.

    Equal texts are counted once and weighed. Chunks of texts send the owners of hash ranges the
    hashes of their phrases with counts; only phrases whose hash is frequent enough over all chunks
    are spelled out, and their exact counts decide.
    """
    grid = chunks.plan_grid(docs)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    texts = docs.select(lang.alias("lang"), F.col("text").cast("string").alias("text")).where("text <> ''")
    texts = texts.groupBy("lang", "text").agg(F.count("*").alias("times"))
    parts = texts.withColumn("chunk", F.pmod(F.xxhash64("lang", "text"), F.lit(grid.chunks)).cast("long"))
    by_chunk = parts.groupBy("chunk")
    sent = by_chunk.applyInArrow(_send(grid.buckets, longest, least), chunks.MESSAGE)
    judged = sent.groupBy("bucket").applyInArrow(_judge(longest, least), chunks.MESSAGE)
    counted = by_chunk.cogroup(judged.groupBy("chunk")).applyInArrow(
        _count(grid.buckets, longest), "lang string, phrase string, f long"
    )
    total = counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return staged(total.where((F.col("f") >= least) | F.col("phrase").isNull()), "phrases")


def _stream(counts: DataFrame, key: Column, name: str, longest: int) -> DataFrame:
    """The counts in the order of ``key``, each with those of the phrases that begin its key.

    In this order a phrase comes right before all that begin with it, so that the count of the first
    k words is the last one seen for k words.
    """
    size = F.size("words")
    begins = {f"{name}{k}": F.when(size == k, F.col("f")) for k in range(1, longest)}
    return running_lasts(counts.withColumn("_key", key), ["lang", "_key"], begins).drop("_key")


def mine_phrases(
    docs: DataFrame, longest: int = LONGEST, least: int = MIN_COUNT, top: int = TOP,
    covered: tuple[int, int] = COVERED,
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are split into pieces at ``.,;:!?`` and line ends, pieces into words at spaces and tabs;
    A-Z are lower-cased. A candidate has 2 to ``longest`` words and occurs ``a >= least`` times. Of
    its cuts into a first part (l occurrences) and a rest (r) the one with the lowest
    floor(2000000 a / (l + r)) counts, the shortest first part among equal ones. It goes if one more
    word beside it keeps ``covered`` (80 of 100) of its occurrences; that also answers for longer
    ones, which occur no more often. ``n`` counts the words of the language.

    The counts are kept as two sorted streams, one by the words and one by the words from the last
    to the first. A pass over each gives the counts of first parts and of rests; the two are
    merge-joined, and the phrases that a longer one covers are taken out by a merge join, too.

    Null text: empty. Null lang: ``und``. Empty texts: no words. Very long texts: whole. Repeated
    rows: counted each time. Ties of score: more occurrences first, then the phrase by its bytes.
    Other columns of the input do not matter. An empty table, or none with a candidate: no rows.
    """
    counts = count_phrases(docs, longest, least)
    words = counts.where("phrase is not null").withColumn("words", F.split("phrase", " "))
    first = _stream(words, F.col("words"), "l", longest).where(F.size("words") > 1)
    last = _stream(words, F.reverse("words"), "r", longest).where(F.size("words") > 1)
    rests = last.select("lang", "phrase", *[f"r{k}" for k in range(1, longest)])
    found = staged(first.hint("merge").join(rests, ["lang", "phrase"]), "streams")

    size = F.size("words")
    part, whole = covered
    around = [
        found.where(size > 2)
        .withColumn("_part", F.element_at(F.array(*[f"{side}{k}" for k in range(1, longest)]), size - 1))
        .where(F.col("f") * whole >= F.col("_part") * part)
        .select("lang", F.array_join(inner, " ").alias("phrase"))
        for side, inner in (("l", F.slice("words", F.lit(1), size - 1)), ("r", F.slice("words", F.lit(2), size - 1)))
    ]
    rests = F.array(*[f"r{k}" for k in range(1, longest)])
    cuts, scored = [], found
    for k in range(1, longest):
        # 2,000,000 a passes 64 bits where a does 2**43.
        scored = scored.withColumn("_r", F.element_at(rests, F.greatest(size - k, F.lit(1))))
        scored = scored.withColumn("_score", F.expr(f"cast(f as decimal(20,0)) * {SCALE} div cast(l{k} + _r as decimal(20,0))"))
        cut = F.struct(F.col("_score").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col("_r").alias("r"))
        scored = scored.withColumn(f"_cut{k}", F.when(size > k, cut)).drop("_r", "_score")
        cuts.append(f"_cut{k}")
    scored = scored.withColumn("_cut", F.array_min(F.array(*cuts)))
    gone = around[0].unionByName(around[1])
    scored = scored.hint("merge").join(gone, ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("_cut.score"), F.desc("f"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = counts.where("phrase is null").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("f").alias("a"),
        F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"), "n", F.col("_cut.score").alias("score"),
    )
