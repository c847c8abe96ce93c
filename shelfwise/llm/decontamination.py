"""Benchmark passages in documents, as a prefix-filtered join of shingle sets."""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.words import (
    ALNUM, LOWER, covered, first_words, gram_fits, gram_hashes, pieces, span_hashes, text_buffer,
    word_spans,
)
from shelfwise.session import remove, scratch_path, staged

WINDOW = 13
SHINGLE = 3
#: Benchmark windows that one pass over the documents looks for, about. A window takes some 250
#: bytes in each task.
BLOCK_WINDOWS = 1 << 17
#: A document is contaminated if at least one word of this many is hit.
HIT_SHARE = 20

_STATE = ["n_words", "n_hit", "hits", "items"]


def _words(texts: pa.Array):
    data, offsets = text_buffer(texts)
    data = LOWER[data]
    starts, ends, text_of = word_spans(data, offsets, ALNUM)
    return span_hashes(data, starts, ends), text_of


def _item_windows(batches):
    """The windows of each item as the bytes of their words' hashes."""
    for batch in batches:
        for piece in pieces(batch, "text"):
            words, text_of = _words(piece.column("text"))
            begin = first_words(text_of, piece.num_rows)
            items, windows = [], []
            for k, item in enumerate(piece.column("item").to_pylist()):
                own = words[begin[k] : begin[k + 1]]
                spans = [own[i : i + WINDOW] for i in range(max(len(own) - WINDOW + 1, min(len(own), 1)))]
                found = {w.tobytes() for w in spans}
                windows += sorted(found)
                items += [item] * len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(windows, pa.binary())], names=["item", "window"]
            )


class Lookup(NamedTuple):
    """Sorted hashes, and a table of flags that most other hashes miss."""

    hashes: np.ndarray
    flags: np.ndarray

    @staticmethod
    def of(hashes: np.ndarray) -> "Lookup":
        hashes = np.unique(hashes)
        flags = np.zeros(1 << max(12, (16 * len(hashes)).bit_length()), bool)
        flags[hashes & np.uint64(len(flags) - 1)] = True
        return Lookup(hashes, flags)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which positions of ``wanted`` are hashes held here, and the places of these."""
        at = np.flatnonzero(self.flags[wanted & np.uint64(len(self.flags) - 1)])
        if not len(self.hashes):
            return at[:0], at[:0]
        place = np.minimum(np.searchsorted(self.hashes, wanted[at]), len(self.hashes) - 1)
        held = self.hashes[place] == wanted[at]
        return at[held], place[held]


class Block(NamedTuple):
    """Distinct windows: words (one after the other), begin and length, and the items of each."""

    words: np.ndarray
    begin: np.ndarray
    length: np.ndarray
    items: np.ndarray
    item_begin: np.ndarray


def _block(rows: DataFrame) -> Block:
    table = rows.toArrow()
    windows, items = table.column("window").to_pylist(), table.column("item").to_pylist()
    order = sorted(range(len(windows)), key=lambda k: (windows[k], items[k]))
    distinct = sorted(set(windows))
    length = np.array([len(w) // 8 for w in distinct], np.int64)
    number = {w: k for k, w in enumerate(distinct)}
    owner = np.array([number[windows[k]] for k in order], np.int64)
    return Block(
        np.frombuffer(b"".join(distinct), np.uint64),
        np.cumsum(length) - length,
        length,
        np.array([items[k] for k in order], object),
        np.searchsorted(owner, np.arange(len(distinct) + 1)),
    )


def _shingles(block: Block, size: int):
    """The shingles of ``size`` words in the windows that use this size: hash, window, offset."""
    mine = np.flatnonzero(np.minimum(block.length, SHINGLE) == size)
    per = block.length[mine] - size + 1
    window = np.repeat(mine, per)
    offset = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    hashes = gram_hashes(np.concatenate((block.words, np.zeros(size, np.uint64))), size)
    return hashes[block.begin[window] + offset], window, offset


def _count_shingles(lookups: dict[int, Lookup]):
    def run(batches):
        counts = {size: np.zeros(len(x.hashes), np.int64) for size, x in lookups.items()}
        for batch in batches:
            for piece in pieces(batch, "text"):
                words, text_of = _words(piece.column("text"))
                for size, lookup in lookups.items():
                    fits = gram_fits(text_of, size)
                    _, place = lookup.find(gram_hashes(words, size)[fits])
                    counts[size] += np.bincount(place, minlength=len(counts[size]))
        for size, found in counts.items():
            held = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(held), size, np.int32)), pa.array(held.astype(np.int32)), pa.array(found[held])],
                names=["size", "place", "times"],
            )

    return run


class Prefixes(NamedTuple):
    """By place in the lookup, the windows whose rarest shingle it is and where it stands in them."""

    lookup: Lookup
    window: np.ndarray
    offset: np.ndarray
    begin: np.ndarray


def _prefixes(docs: DataFrame, block: Block) -> dict[int, Prefixes]:
    """Order the block's shingles by their count in all documents and keep each window's rarest.

    A document that contains a window contains all its shingles, so one of them is a sufficient
    prefix; a window with a shingle that no document has is not looked for at all.
    """
    sets = {size: _shingles(block, size) for size in range(1, SHINGLE + 1)}
    lookups = {size: Lookup.of(s[0]) for size, s in sets.items() if len(s[0])}
    counted = docs.select("text").mapInArrow(_count_shingles(lookups), "size int, place int, times long")
    sums = counted.groupBy("size", "place").agg(F.sum("times").alias("times")).toPandas()
    out = {}
    for size, lookup in lookups.items():
        times = np.zeros(len(lookup.hashes), np.int64)
        mine = sums[sums["size"] == size]
        times[mine["place"]] = mine["times"]
        hashes, window, offset = sets[size]
        place = np.searchsorted(lookup.hashes, hashes)
        order = np.lexsort((offset, times[place], window))
        first = order[np.flatnonzero(np.diff(window[order], prepend=-1))]
        first = first[times[place[first]] > 0]
        kept = Lookup.of(hashes[first])
        at = np.searchsorted(kept.hashes, hashes[first])
        order = np.argsort(at, kind="stable")
        out[size] = Prefixes(
            kept, window[first][order], offset[first][order], np.searchsorted(at[order], np.arange(len(kept.hashes) + 1))
        )
    return out


def _occurrences(words, text_of, bounds, block: Block, size: int, prefixes: Prefixes, step: int = 1 << 16):
    """Positions and windows of all occurrences, by prefix match, bounds and comparison word by word."""
    fits = np.flatnonzero(gram_fits(text_of, size))
    at, place = prefixes.lookup.find(gram_hashes(words, size)[fits])
    at = fits[at]
    many = prefixes.begin[place + 1] - prefixes.begin[place]
    ends = np.cumsum(many)
    begin = 0
    while begin < len(at):
        stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + step, side="right")))
        times = many[begin:stop]
        position = np.repeat(at[begin:stop], times)
        entry = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        entry += np.repeat(prefixes.begin[place[begin:stop]], times)
        window = prefixes.window[entry]
        start = position - prefixes.offset[entry]
        text = text_of[position]
        inside = (start >= bounds[text]) & (start + block.length[window] <= bounds[text + 1])
        start, window = start[inside], window[inside]
        for k in range(WINDOW):
            equal = np.ones(len(start), bool)
            longer = np.flatnonzero(block.length[window] > k)
            equal[longer] = words[start[longer] + k] == block.words[block.begin[window[longer]] + k]
            start, window = start[equal], window[equal]
        yield start, window
        begin = stop


def _runs(flags: np.ndarray) -> np.ndarray:
    """Begin and end of each run of set flags."""
    change = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return change.astype(np.int64)


def _search(block: Block, prefixes: dict[int, Prefixes]):
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                yield _searched(piece, block, prefixes)

    return run


def _searched(piece: pa.RecordBatch, block: Block, prefixes: dict[int, Prefixes]) -> pa.RecordBatch:
    words, text_of = _words(piece.column("text"))
    bounds = first_words(text_of, piece.num_rows)
    hit = np.zeros(len(words) + 1, np.int64)
    pairs = [np.zeros((2, 0), np.int64)]
    for size, prefix in prefixes.items():
        for start, window in _occurrences(words, text_of, bounds, block, size, prefix):
            np.add.at(hit, start, 1)
            np.add.at(hit, start + block.length[window], -1)
            pairs.append(np.unique(np.stack((text_of[start], window)), axis=1))
    flags = np.cumsum(hit[:-1]) > 0
    texts, windows = np.unique(np.concatenate(pairs, axis=1), axis=1)
    found = np.searchsorted(texts, np.arange(piece.num_rows + 1))
    before, hits, items, count = piece.column("hits"), [], [], []
    for k, known in enumerate(piece.column("items").to_pylist()):
        own = flags[bounds[k] : bounds[k + 1]]
        if before[k].is_valid:
            for a, b in np.frombuffer(before[k].as_py(), np.int64).reshape(-1, 2):
                own[a:b] = True
        hits.append(_runs(own).tobytes())
        count.append(int(own.sum()))
        names = set(known or ())
        for w in windows[found[k] : found[k + 1]]:
            names.update(block.items[block.item_begin[w] : block.item_begin[w + 1]])
        items.append(sorted(names))
    return pa.RecordBatch.from_arrays(
        [
            piece.column("rest"), piece.column("text"), pa.array(np.diff(bounds), pa.int64()),
            pa.array(count, pa.int64()), pa.array(hits, pa.binary()), pa.array(items, pa.list_(pa.string())),
        ],
        names=["rest", "text", *_STATE],
    )


def find_contamination(docs: DataFrame, benchmark: DataFrame, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` with n_words, n_hit, items (sorted ids of the items found) and contaminated.

    Words are runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII. A window is
    ``WINDOW`` consecutive words of an item; an item of fewer words, but not none, is one window. A
    document's word is hit inside any occurrence of a window; a document is contaminated if at
    least one of ``HIT_SHARE`` words is hit.

    The windows are dealt to blocks of about ``block_windows`` by a hash, and each block, of bounded
    size, goes to the tasks that read the documents; what they find is written before the next block is
    read. There a window's rarest shingle finds the
    places where it may stand; these must leave room for it, and are compared word by word.

    Null or empty text: no words, never contaminated; as an item: no windows. Null ``item_id``: the
    item has the empty id. Repeated items and documents: each row is judged alone, an id counts
    once. Null ``doc_id`` is allowed. Columns of the documents named like an added one are
    replaced. Empty tables of either kind are allowed.
    """
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text")
    )
    windows = staged(items.mapInArrow(_item_windows, "item string, window binary").distinct(), "windows")
    blocks = -(-windows.count() // block_windows)
    added = ["n_words", "n_hit", "items", "contaminated"]
    given = [c for c in docs.columns if c != "text"]
    read = docs.select(F.struct(*[F.col(f"`{c}`") for c in given]).alias("rest"), F.col("text").cast("string").alias("text"))
    rest = read.schema["rest"].dataType.simpleString()
    schema = f"rest {rest}, text string, n_words long, n_hit long, hits binary, items array<string>"
    found = read.withColumns({"hits": F.lit(None).cast("binary"), "items": F.lit(None).cast("array<string>")})
    spark, before = docs.sparkSession, None
    for k in range(max(blocks, 1)):
        block = _block(windows.where(F.pmod(F.xxhash64("item", "window"), F.lit(max(blocks, 1))) == k))
        found = found.select("rest", "text", "hits", "items").mapInArrow(_search(block, _prefixes(read, block)), schema)
        if k + 1 < blocks:
            # Written, so that neither the driver nor a task holds more than one block.
            path = scratch_path(spark, "hits")
            found.write.parquet(path)
            found = spark.read.schema(found.schema).parquet(path)
            if before is not None:
                remove(spark, before)
            before = path
    contaminated = (F.col("n_hit") > 0) & (HIT_SHARE * F.col("n_hit") >= F.col("n_words"))
    kept = [F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns if c not in added]
    return found.select(*kept, "n_words", "n_hit", "items", contaminated.alias("contaminated"))
