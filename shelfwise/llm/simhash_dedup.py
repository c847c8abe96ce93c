"""Near-duplicate groups by SimHash fingerprints, compared as vertical bit planes."""

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.llm.components import components
from shelfwise.llm.words import pieces
from shelfwise.session import staged

BITS = 64
SHINGLE = 4
RADIUS = 4
SEED = 42
#: Fingerprints compared with each other in one go, at most.
TILE = 4096
#: Stand-ins for missing ids start here, after every usual id.
NO_ID = 1 << 62

_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).reshape(-1).view(np.uint64)
_LANES = 255


def _digests(text: str | None, shingle: int) -> bytes:
    """The hashes of a text's shingles, eight bytes each with the highest first."""
    words = (text or "").encode().lower().split()
    if not words:
        return b""
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_digest(joined, SEED)
    ends = list(accumulate((len(w) + 1 for w in words), initial=-1))
    digest = xxhash.xxh64_digest
    return b"".join([digest(joined[a + 1 : b], SEED) for a, b in zip(ends, ends[shingle:])])


def fingerprints(texts: list, shingle: int = SHINGLE) -> np.ndarray:
    """One unsigned 64-bit fingerprint per text; bits set in over half of its shingles' hashes."""
    found = [_digests(text, shingle) for text in texts]
    counts = np.array([len(f) // 8 for f in found], np.int64)
    hashes = np.frombuffer(b"".join(found), np.uint8).reshape(-1, 8)
    out = np.zeros((len(texts), BITS), bool)
    full = np.flatnonzero(counts)
    if not len(full):
        return np.zeros(len(texts), np.uint64)
    # Sum bits in byte lanes, which hold up to 255, then the lanes of each text.
    blocks = -(-counts[full] // _LANES)
    first = np.concatenate(([0], np.cumsum(counts[full])[:-1]))
    inner = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    lanes = np.add.reduceat(_SPREAD[hashes], np.repeat(first, blocks) + inner * _LANES, axis=0)
    ones = np.add.reduceat(lanes.view(np.uint8).astype(np.int64), np.cumsum(blocks) - blocks, axis=0)
    out[full] = 2 * ones > counts[full][:, None]
    return np.packbits(out, axis=1).view(">u8").reshape(-1).astype(np.uint64)


def _fingerprint_batches(shingle: int):
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                found = fingerprints(piece.column("text").to_pylist(), shingle)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("key"), pa.array(found.view(np.int64))],
                    names=["doc_id", "key", "fp"],
                )

    return run


def band_masks(count: int, radius: int) -> list[int]:
    """Bit masks such that two fingerprints within the radius agree on at least one of them.

    The bits are cut into ``radius + m`` bands; ``radius`` differences leave ``m`` bands equal. The
    least m is taken that leaves at most ``TILE`` of ``count`` evenly spread fingerprints to a mask
    value on average; more bands only split the same comparisons further.
    """
    for agree in range(1, BITS - radius + 1):
        edges = [BITS * k // (radius + agree) for k in range(radius + agree + 1)]
        bands = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
        least = min(b - a for a, b in zip(edges, edges[1:])) * agree
        if count <= TILE << least:
            break
    return [sum(c) for c in combinations(bands, agree)]


def planes(prints: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of all fingerprints, 64 of them to a word."""
    width = -(-len(prints) // 64) * 64
    padded = np.zeros(width, np.uint64)
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(width, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def _exceeds(counter: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    above, equal = over.copy(), ~np.zeros_like(over)
    for k in reversed(range(len(counter))):
        if radius >> k & 1:
            equal &= counter[k]
        else:
            above |= equal & counter[k]
            equal &= ~counter[k]
    return above


def _count(counter: list[np.ndarray], over: np.ndarray, carry: np.ndarray, place: int) -> None:
    """Add ``carry`` at the counter's bit ``place``, in place; what leaves the counter stays over."""
    for k in range(place, len(counter)):
        out = counter[k] & carry
        counter[k] ^= carry
        carry = out
    over |= carry


def within(prints: np.ndarray, radius: int, stride: int = 8, block: int = 256) -> np.ndarray:
    """For each fingerprint a row of bits, set for the fingerprints within the radius.

    Two planes at a time enter the counters through a carry-save adder. After every ``stride``
    planes, words whose 64 distances all exceed the radius are abandoned.
    """
    lanes = planes(prints)
    valid = np.packbits(np.arange(lanes.shape[1] * 64) < len(prints), bitorder="little").view(np.uint64)
    out = np.zeros((len(prints), lanes.shape[1]), np.uint64)
    for begin in range(0, len(prints), block):
        queries = prints[begin : begin + block]
        row, word = (x.ravel() for x in np.indices((len(queries), lanes.shape[1])))
        counter = [np.zeros(len(row), np.uint64) for _ in range(max(radius.bit_length(), 1))]
        over = np.zeros(len(row), np.uint64)
        for bit in range(0, BITS, 2):
            a, b = (
                lanes[k][word] ^ (np.uint64(0) - (queries >> np.uint64(k) & np.uint64(1)))[row]
                for k in (bit, bit + 1)
            )
            half = a ^ b
            carry = (a & b) | (counter[0] & half)
            counter[0] ^= half
            if len(counter) > 1:
                _count(counter, over, carry, 1)
            else:
                over |= carry
            if (bit + 2) % stride == 0:
                far = _exceeds(counter, over, radius) | ~valid[word]
                alive = np.flatnonzero(far != ~np.uint64(0))
                if len(alive) < len(row):
                    row, word, over = row[alive], word[alive], over[alive]
                    counter = [c[alive] for c in counter]
                if not len(row):
                    break
        if len(row):
            out[begin + row, word] = ~_exceeds(counter, over, radius) & valid[word]
    return out


def star_links(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what lies within the radius in ``prints``: each member of a group with the
    group's least one."""
    near = within(prints, radius)
    left = np.ones(len(prints), bool)
    members, leasts = [], []
    degree = np.bitwise_count(near).sum(axis=1)
    for k in np.flatnonzero(degree > 1):
        if not left[k]:
            continue
        group = np.zeros(len(prints), bool)
        fresh = np.array([k])
        while len(fresh):
            group[fresh] = True
            reach = np.bitwise_or.reduce(near[fresh], axis=0)
            bits = np.unpackbits(reach.view(np.uint8), bitorder="little", count=len(prints))
            fresh = np.flatnonzero(bits.astype(bool) & ~group)
        left &= ~group
        inside = prints[group].view(np.int64)
        least = inside.min()
        inside = inside[inside != least]
        members.append(inside)
        leasts.append(np.full(len(inside), least))
    empty = np.zeros(0, np.int64)
    return np.concatenate(members or [empty]), np.concatenate(leasts or [empty])


def _compare(radius: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """The links within each bucket of a slot."""
        order = ["table", "value", "low", "high"]
        table = table.sort_by([(c, "ascending") for c in order])
        names = np.stack([table.column(c).to_numpy() for c in order])
        prints = table.column("fp").to_numpy().view(np.uint64)
        edges = np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1
        bounds = [0, *edges.tolist(), len(prints)]
        found = [star_links(prints[a:b], radius) for a, b in zip(bounds, bounds[1:]) if b - a > 1]
        u = np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)])
        v = np.concatenate([f[1] for f in found] or [np.zeros(0, np.int64)])
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (u, v) between the distinct fingerprints in column fp that join the same groups as all
    pairs within the radius.

    Fingerprints meet in buckets of equal masked bits. A bucket of more than half a tile is cut
    into parts, and each pair of parts is a tile of its own; its links are again stars.
    """
    count = distinct.count()
    masks = band_masks(count, radius)
    part = TILE // 2
    entries = distinct.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m if m < 1 << 63 else m - (1 << 64))) for m in masks]))
        .alias("table", "value"),
    )
    large = entries.groupBy("table", "value").count().where(F.col("count") > part)
    large = large.select("table", "value", F.ceil(F.col("count") / part).cast("int").alias("parts"))
    placed = entries.join(large, ["table", "value"], "left").withColumn(
        "own", F.pmod(F.xxhash64("fp"), F.coalesce("parts", F.lit(1))).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
    tiles = placed.withColumn("other", other).select(
        "fp", "table", "value",
        F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
    )
    # Many small buckets share a slot, so that a task compares about a tile at a time.
    slots = max(1, count * len(masks) // TILE)
    slot = F.when(F.col("high") == 0, F.pmod(F.xxhash64("table", "value"), F.lit(slots))).otherwise(
        F.xxhash64("table", "value", "low", "high").bitwiseOR(F.lit(-(1 << 63)))
    )
    return tiles.withColumn("slot", slot).groupBy("slot").applyInArrow(_compare(radius), "u long, v long")


def document_key(doc_id: str = "doc_id", text: str = "text"):
    """The id, or for a row without one a number after all ids that its text determines."""
    return F.coalesce(
        F.col(doc_id).cast("long"), F.xxhash64(text).bitwiseAND(F.lit(NO_ID - 1)) + F.lit(NO_ID)
    )


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: key, doc_id, fp (the fingerprint as a signed long) and component (the
    least key that links within ``radius`` bits reach).

    Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage
    return, with A-Z lower-cased. Shingles are ``shingle`` words joined by a space, repeats
    counted; a shorter text is one shingle. Null or empty text: fingerprint zero, linked like any
    other. Null ``doc_id``: the key is a number from the text after all ids. Repeated ``doc_id``:
    one row each, all with the same key. Other columns are not read. Equal fingerprints meet by
    grouping, so that only different ones are compared. An empty table gives an empty table.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), document_key().alias("key"), "text")
    prints = staged(
        keyed.mapInArrow(_fingerprint_batches(shingle), "doc_id long, key long, fp long"), "fingerprints"
    )
    distinct = staged(prints.groupBy("fp").agg(F.min("key").alias("least")), "distinct")
    roots = components(links(distinct, radius)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    groups = rooted.groupBy("root").agg(F.min("least").alias("component"))
    owners = rooted.join(groups, "root").select("fp", "component")
    return prints.join(owners, "fp").select("key", "doc_id", "fp", "component")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, that with the least key.

    Of rows with one ``doc_id`` (or, without an id, one text) a single row stays, the one with the
    least hash over its columns. Edge cases as in ``near_duplicates``.
    """
    first = near_duplicates(docs, shingle, radius).where("key = component").select("key").distinct()
    kept = docs.withColumn("_key", document_key()).join(first.withColumnRenamed("key", "_key"), "_key")
    order = Window.partitionBy("_key").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    return kept.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").select(docs.columns)
