"""Removal of lines that many documents repeat, by once-seen and twice-seen Bloom filters."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from shelfwise.llm import chunks
from shelfwise.llm.words import LOWER, NOT_SPACE, pieces, span_hashes, text_buffer

MIN_CHARS = 40
MIN_DOCS = 5
BITS_PER_KEY = 16
PROBES = 4

_HASHES, _SUSPECTS, _KEYS, _CONFIRMED, _WON = range(5)


class Bloom:
    """A Bloom filter over 32-bit hashes as an array of bytes, one per bit."""

    def __init__(self, keys: int):
        self.size = max(keys, 64) * BITS_PER_KEY
        self.bits = np.zeros(self.size, bool)

    def probes(self, hashes: np.ndarray) -> np.ndarray:
        wide = hashes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        step = (wide >> np.uint64(32)) | np.uint64(1)
        k = np.arange(PROBES, dtype=np.uint64)[:, None]
        return ((wide ^ (wide >> np.uint64(29))) + k * step) % np.uint64(self.size)

    def has(self, probes: np.ndarray) -> np.ndarray:
        return self.bits[probes].all(axis=0)

    def add(self, probes: np.ndarray) -> None:
        self.bits[probes] = True


def line_spans(data: np.ndarray, offsets: np.ndarray):
    """Start, end and text number of each line; every text has one line more than line feeds."""
    feeds = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate((offsets[:-1], feeds + 1)))
    ends = np.sort(np.concatenate((feeds, offsets[1:])))
    per_text = np.diff(np.searchsorted(feeds, offsets)) + 1
    return starts, ends, np.repeat(np.arange(len(offsets) - 1), per_text)


def key_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Start and end of each line's key, and the key's code points."""
    solid = np.flatnonzero(NOT_SPACE[data])
    a, b = np.searchsorted(solid, starts), np.searchsorted(solid, ends) - 1
    filled = a <= b
    left, right = starts.copy(), starts.copy()
    left[filled], right[filled] = solid[a[filled]], solid[b[filled]] + 1
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return left, right, points[right] - points[left]


def _documents(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The id of each row, and a number that is equal for rows of one document."""
    doc = chunks.ids(table)
    if not (doc == chunks.NO_ID).any():
        return doc, np.unique(doc, return_inverse=True)[1]
    texts = table.column("text").to_pylist()
    names = [(i, t if i == chunks.NO_ID else None) for i, t in zip(doc.tolist(), texts)]
    number = {name: k for k, name in enumerate(dict.fromkeys(names))}
    return doc, np.array([number[name] for name in names], np.int64)


def _lines(table: pa.Table, limit: int):
    """The chunk's lines with long keys: hash, row, line number in the chunk, and the key's bytes
    (as a function of the positions wanted); also the number of lines of each row."""
    hashes, rows, numbers, buffers, counts, base, lines = [], [], [], [], [], 0, 0
    for batch in table.select(["text"]).combine_chunks().to_batches():
        for piece in pieces(batch, "text"):
            data, offsets = text_buffer(piece.column("text"))
            data = LOWER[data]
            starts, ends, text_of = line_spans(data, offsets)
            left, right, points = key_spans(data, starts, ends)
            long = np.flatnonzero(points >= limit)
            hashes.append(span_hashes(data, left[long], right[long]))
            rows.append(text_of[long] + base)
            numbers.append(long + lines)
            buffers.append((data, left[long], right[long]))
            counts.append(np.bincount(text_of, minlength=piece.num_rows))
            base += piece.num_rows
            lines += len(starts)
    sizes = np.cumsum([0] + [len(h) for h in hashes])

    def key_bytes(positions: np.ndarray) -> list[bytes]:
        out = []
        for p in positions:
            k = int(np.searchsorted(sizes, p, side="right")) - 1
            data, left, right = buffers[k]
            out.append(data[left[p - sizes[k]] : right[p - sizes[k]]].tobytes())
        return out

    joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (hashes, rows, numbers, counts)]
    return joined[0].astype(np.uint64), *joined[1:], key_bytes


def _held(hashes, rows, doc, document):
    """The chunk's distinct keys in hash order: hash, first line with it, its documents and their
    largest id; and the place of each line among them."""
    distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    owners = np.unique(np.stack((which, document[rows])), axis=1)[0] if len(rows) else which
    times = np.bincount(owners, minlength=len(distinct))
    most = np.full(len(distinct), np.iinfo(np.int64).min)
    np.maximum.at(most, which, doc[rows])
    return distinct, first, times, most, which


def _send_hashes(buckets: int, limit: int):
    def send(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        hashes, *_ = _lines(table, limit)
        distinct = np.unique(hashes)
        slices = chunks.bucket_slices(distinct, buckets)
        return chunks.messages(key[0].as_py(), slices, _HASHES, distinct.astype(np.uint32))

    return send


def _filter(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Which hashes the bucket has in its twice-seen filter after the hashes of all chunks."""
    _, senders, bodies = chunks.of_kind(table, _HASHES)
    sent = [np.frombuffer(b, np.uint32) for b in bodies]
    total = sum(map(len, sent))
    once, twice = Bloom(total), Bloom(total)
    for hashes in sent:
        probes = once.probes(hashes)
        twice.add(probes[:, once.has(probes)])
        once.add(probes)
    answers = [np.packbits(twice.has(twice.probes(h))).tobytes() for h in sent]
    return chunks.message_table([key[0].as_py()] * len(answers), senders, _HASHES, answers)


def _send_suspects(buckets: int, limit: int):
    def send(key: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        chunk = key[0].as_py()
        hashes, rows, _, _, key_bytes = _lines(table, limit)
        distinct, first, times, most, _ = _held(hashes, rows, *_documents(table))
        slices = chunks.bucket_slices(distinct, buckets)
        suspect = chunks.read_bits(replies, _HASHES, slices) | (times > 1)
        keys = key_bytes(first[suspect])
        lengths = np.array([len(k) for k in keys], np.int64)
        slices = chunks.bucket_slices(distinct[suspect], buckets)
        full = np.flatnonzero(np.diff(slices))
        bodies = []
        for k in full:
            part = slice(slices[k], slices[k + 1])
            head = np.stack((lengths[part], times[suspect][part], most[suspect][part]))
            bodies.append(np.int64(head.shape[1]).tobytes() + head.tobytes() + b"".join(keys[part]))
        sent = chunks.message_table(full, [chunk] * len(full), _KEYS, bodies)
        memo = chunks.message_table([chunk % buckets], [chunk], _SUSPECTS, [np.packbits(suspect).tobytes()])
        return pa.concat_tables([sent, memo])

    return send


def _confirm(min_docs: int):
    def confirm(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """Which keys enough documents hold, and whether the sender has the largest of these."""
        bucket = key[0].as_py()
        memo = table.filter(pc.equal(table.column("kind"), _SUSPECTS))
        _, senders, bodies = chunks.of_kind(table, _KEYS)
        sent, times, most = [], {}, {}
        for body in bodies:
            n = int(np.frombuffer(body, np.int64, 1)[0])
            lengths, counts, largest = np.frombuffer(body, np.int64, 3 * n, 8).reshape(3, n)
            ends = 8 + 24 * n + np.cumsum(lengths)
            keys = [body[a:b] for a, b in zip((ends - lengths).tolist(), ends.tolist())]
            for k, c, d in zip(keys, counts.tolist(), largest.tolist()):
                times[k] = times.get(k, 0) + c
                most[k] = max(most.get(k, d), d)
            sent.append((keys, largest.tolist()))
        confirmed = [np.packbits([times[k] >= min_docs for k in keys]).tobytes() for keys, _ in sent]
        won = [np.packbits([most[k] == d for k, d in zip(*s)]).tobytes() for s in sent]
        found = [
            chunks.message_table([bucket] * len(sent), senders, kind, answers)
            for kind, answers in ((_CONFIRMED, confirmed), (_WON, won))
        ]
        return pa.concat_tables([*found, memo.cast(found[0].schema)])

    return confirm


def _drop(buckets: int, limit: int):
    def drop(key: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        doc, document = _documents(table)
        hashes, rows, numbers, n_lines, _ = _lines(table, limit)
        distinct, _, _, most, which = _held(hashes, rows, doc, document)
        _, _, memo = chunks.of_kind(replies, _SUSPECTS)
        suspect = np.unpackbits(np.frombuffer(memo[0], np.uint8), count=len(distinct)).astype(bool)
        slices = chunks.bucket_slices(distinct[suspect], buckets)
        confirmed, won = np.zeros(len(distinct), bool), np.zeros(len(distinct), bool)
        confirmed[suspect] = chunks.read_bits(replies, _CONFIRMED, slices)
        won[suspect] = chunks.read_bits(replies, _WON, slices)
        kept_here = won[which] & (doc[rows] == most[which])
        gone = np.zeros(int(n_lines.sum()), bool)
        gone[numbers[confirmed[which] & ~kept_here]] = True
        begin = np.concatenate(([0], np.cumsum(n_lines)))
        n_dropped = np.diff(np.concatenate(([0], np.cumsum(gone)))[begin])
        kept = []
        for i, text in enumerate(table.column("text").to_pylist()):
            if n_dropped[i]:
                lines = text.split("\n")
                text = "\n".join([lines[k] for k in np.flatnonzero(~gone[begin[i] : begin[i + 1]])])
            kept.append(text or "")
        return pa.table(
            {
                "rest": table.column("rest"),
                "text": pa.array(kept, pa.string()),
                "n_lines": pa.array(n_lines, pa.int64()),
                "n_dropped": pa.array(n_dropped, pa.int64()),
            }
        )

    return drop


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` without the lines that at least ``min_docs`` documents repeat.

    Texts are split at line feeds. A line's key is the line without white space (space and bytes 9
    to 13) at its ends, with A-Z lower-cased. A key of at least ``min_chars`` code points in at
    least ``min_docs`` documents loses its lines everywhere but in the document with the largest
    ``doc_id`` that has it. Added columns: ``n_lines`` (before) and ``n_dropped``.

    Chunks of documents send 32-bit hashes of their keys; the owner of a hash range runs them
    through two Bloom filters, for hashes seen once and seen again. Only keys in the second filter
    are sent as text, once by each chunk, for the exact count.

    Null or empty text: one empty line, an empty text results. Null ``doc_id``: after every other
    id; each text is a document, and all documents without an id that share the last place keep
    the line. Repeated ``doc_id``: the rows are one document. Columns of the input named like an
    added one are replaced; all others are kept. An empty table gives an empty table.
    """
    limit = max(min_chars, 1)
    grid = chunks.plan_grid(docs)
    parts = chunks.chunked(docs, grid)
    by_chunk = parts.groupBy("chunk")
    asked = by_chunk.applyInArrow(_send_hashes(grid.buckets, limit), chunks.MESSAGE)
    suspects = asked.groupBy("bucket").applyInArrow(_filter, chunks.MESSAGE)
    sent = by_chunk.cogroup(suspects.groupBy("chunk")).applyInArrow(
        _send_suspects(grid.buckets, limit), chunks.MESSAGE
    )
    judged = sent.groupBy("bucket").applyInArrow(_confirm(min_docs), chunks.MESSAGE)
    rest = parts.schema["rest"].dataType.simpleString()
    kept = by_chunk.cogroup(judged.groupBy("chunk")).applyInArrow(
        _drop(grid.buckets, limit), f"rest {rest}, text string, n_lines long, n_dropped long"
    )
    return chunks.restored(kept, docs.columns, ["n_lines", "n_dropped"])
