"""Removal of long word runs that an earlier document has, by difference-cover anchors."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from shelfwise.llm import chunks
from shelfwise.llm.words import (
    NOT_SPACE, covered, first_words, gram_fits, gram_hashes, pieces, span_hashes, text_buffer,
    word_spans,
)

WINDOW = 13
#: {1, 2, 4} is a difference cover modulo 7: any two positions have a shift below 7 that brings
#: both to a residue of the set.
PERIOD, COVER = 7, (1, 2, 4)
#: An anchor and a shift below the period fit in one window.
ANCHOR = WINDOW - PERIOD + 1

_ANCHORS, _WINDOWS, _SHARED = 0, 1, 2


def _words(table: pa.Table, families):
    """Hashes of all words of a chunk (one array per family) and the row each word belongs to."""
    found, rows, base = [[] for _ in families], [], 0
    for batch in table.select(["text"]).combine_chunks().to_batches():
        for piece in pieces(batch, "text"):
            data, offsets = text_buffer(piece.column("text"))
            starts, ends, text_of = word_spans(data, offsets, NOT_SPACE)
            for out, family in zip(found, families):
                out.append(span_hashes(data, starts, ends, family))
            rows.append(text_of + base)
            base += piece.num_rows
    joined = [np.concatenate(f) if f else np.zeros(0, np.uint64) for f in found]
    return joined, np.concatenate(rows) if rows else np.zeros(0, np.int64)


def _anchors(words: np.ndarray, rows: np.ndarray, doc: np.ndarray):
    """Positions and hashes of a chunk's anchors, the sorted distinct hashes, each anchor's place
    among them, and whether two documents of the chunk hold the hash."""
    fits = gram_fits(rows, ANCHOR)
    place = np.arange(len(words)) - first_words(rows, len(doc))[rows]
    at = np.flatnonzero(fits & np.isin(place[: len(fits)] % PERIOD, COVER))
    distinct, which = np.unique(gram_hashes(words, ANCHOR)[at], return_inverse=True)
    least = np.full(len(distinct), chunks.NO_ID)
    most = np.full(len(distinct), np.iinfo(np.int64).min)
    np.minimum.at(least, which, doc[rows[at]])
    np.maximum.at(most, which, doc[rows[at]])
    return at, distinct, which, least < most


def _candidates(words, rows, at, shared):
    """Starts of the windows around shared anchors."""
    near = covered(np.maximum(at[shared] - (PERIOD - 1), 0), PERIOD, len(words))
    fits = gram_fits(rows, WINDOW)
    return np.flatnonzero(near[: len(fits)] & fits)


def _windows(words, rows, doc, starts):
    """Distinct candidate windows in hash order: hash, check hash, least document, and the place of
    each candidate among them."""
    first = gram_hashes(words[0], WINDOW)[starts]
    check = (gram_hashes(words[1], WINDOW)[starts] >> np.uint64(32)).astype(np.uint32)
    owner = doc[rows[starts]]
    order = np.lexsort((owner, check, first))
    first, check, owner = first[order], check[order], owner[order]
    new = np.ones(len(order), bool)
    new[1:] = (first[1:] != first[:-1]) | (check[1:] != check[:-1])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return first[new], check[new], owner[new], which


def _send_anchors(buckets: int):
    def send(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        (words,), rows = _words(table, [0])
        _, distinct, _, _ = _anchors(words, rows, chunks.ids(table))
        slices = chunks.bucket_slices(distinct, buckets)
        return chunks.messages(key[0].as_py(), slices, _ANCHORS, distinct.astype(np.uint32))

    return send


def _judge_anchors(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Which of the anchors sent to a bucket came from more than one chunk."""
    _, senders, bodies = chunks.of_kind(table, _ANCHORS)
    sent = [np.frombuffer(b, np.uint32) for b in bodies]
    _, which, times = np.unique(np.concatenate(sent), return_inverse=True, return_counts=True)
    flags = np.split(times[which] > 1, np.cumsum([len(s) for s in sent])[:-1])
    answers = [np.packbits(f).tobytes() for f in flags]
    return chunks.message_table([key[0].as_py()] * len(answers), senders, _ANCHORS, answers)


def _send_windows(buckets: int):
    def send(key: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        chunk, doc = key[0].as_py(), chunks.ids(table)
        words, rows = _words(table, [0, 1])
        at, distinct, which, here = _anchors(words[0], rows, doc)
        slices = chunks.bucket_slices(distinct, buckets)
        shared = chunks.read_bits(replies, _ANCHORS, slices) | here
        starts = _candidates(words[0], rows, at, shared[which])
        first, check, owner, _ = _windows(words, rows, doc, starts)
        base = int(owner.min()) if len(owner) else 0
        wide = len(owner) and int(owner.max()) - base >= 1 << 32
        offset = (owner - base).astype(np.int64 if wide else np.uint32)
        slices = chunks.bucket_slices(first, buckets)
        sent = chunks.messages(chunk, slices, _WINDOWS, first, check, offset)
        head = np.array([base, offset.itemsize], np.int64).tobytes()
        sent = sent.set_column(3, "body", pa.array([head + b for b in sent.column("body").to_pylist()], pa.binary()))
        # The chunk's own answer travels along, so that the last step need not ask again.
        memo = chunks.message_table([chunk % buckets], [chunk], _SHARED, [np.packbits(shared).tobytes()])
        return pa.concat_tables([sent, memo])

    return send


def _judge_windows(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Which of the windows sent to a bucket stand in a document before all of the sender's."""
    bucket = key[0].as_py()
    _, senders, bodies = chunks.of_kind(table, _WINDOWS)
    memo = table.filter(pc.equal(table.column("kind"), _SHARED))
    if not bodies:
        return memo
    first, check, owner, lengths = [], [], [], []
    for body in bodies:
        base, width = (int(x) for x in np.frombuffer(body, np.int64, 2))
        n = (len(body) - 16) // (12 + width)
        first.append(np.frombuffer(body, np.uint64, n, 16))
        check.append(np.frombuffer(body, np.uint32, n, 16 + 8 * n))
        offset = np.frombuffer(body, np.int64 if width == 8 else np.uint32, n, 16 + 12 * n)
        owner.append(offset.astype(np.int64) + base)
        lengths.append(n)
    first, check, owner = (np.concatenate(x) for x in (first, check, owner))
    order = np.lexsort((owner, check, first))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(first[order]) != 0) | (np.diff(check[order]) != 0)
    least = owner[order][new][np.cumsum(new) - 1]
    earlier = np.empty(len(order), bool)
    earlier[order] = least < owner[order]
    answers = [np.packbits(f).tobytes() for f in np.split(earlier, np.cumsum(lengths)[:-1])]
    found = chunks.message_table([bucket] * len(answers), senders, _WINDOWS, answers)
    return pa.concat_tables([found, memo.cast(found.schema)])


def _remove(buckets: int):
    def remove(key: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        doc = chunks.ids(table)
        words, rows = _words(table, [0, 1])
        at, distinct, which, _ = _anchors(words[0], rows, doc)
        _, _, memo = chunks.of_kind(replies, _SHARED)
        shared = np.unpackbits(np.frombuffer(memo[0], np.uint8), count=len(distinct)).astype(bool)
        starts = _candidates(words[0], rows, at, shared[which])
        first, _, owner, place = _windows(words, rows, doc, starts)
        elsewhere = chunks.read_bits(replies, _WINDOWS, chunks.bucket_slices(first, buckets))
        gone = elsewhere[place] | (owner[place] < doc[rows[starts]])
        removed = covered(starts[gone], WINDOW, len(rows))
        begin = first_words(rows, table.num_rows)
        kept, n_removed = [], []
        for i, text in enumerate(table.column("text").to_pylist()):
            parts = (text or "").encode().split()
            drop = removed[begin[i] : begin[i + 1]]
            n = int(drop.sum())
            if n:
                parts = [parts[k] for k in np.flatnonzero(~drop)]
            kept.append(b" ".join(parts).decode())
            n_removed.append(n)
        return pa.table(
            {
                "rest": table.column("rest"),
                "text": pa.array(kept, pa.string()),
                "n_words": pa.array(np.diff(begin), pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
            }
        )

    return remove


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """``docs`` with each text cut to the words no earlier document accounts for.

    A window is ``WINDOW`` consecutive words (runs of anything but space, tab, line feed, vertical
    tab, form feed and carriage return). A word goes if a window over it also starts in a document
    with a smaller ``doc_id``; the windows are those of the input. The kept words are joined by one
    space. Added columns: ``n_words`` (before) and ``n_removed``.

    Anchors of ``ANCHOR`` words are hashed at the positions of the difference cover. Anchors that
    stand in one document only end there. Around the others each possible window is compared by a
    96-bit hash, and the least document of each window decides.

    Null or empty text: no words. Null ``doc_id``: after every other; such rows with one text are
    one document. Repeated ``doc_id``: the rows are one document, which takes nothing from itself.
    Columns of the input named like an added one are replaced; all others are kept. An empty table
    gives an empty table.
    """
    grid = chunks.plan_grid(docs)
    parts = chunks.chunked(docs, grid)
    by_chunk = parts.groupBy("chunk")
    asked = by_chunk.applyInArrow(_send_anchors(grid.buckets), chunks.MESSAGE)
    shared = asked.groupBy("bucket").applyInArrow(_judge_anchors, chunks.MESSAGE)
    sent = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(_send_windows(grid.buckets), chunks.MESSAGE)
    judged = sent.groupBy("bucket").applyInArrow(_judge_windows, chunks.MESSAGE)
    rest = parts.schema["rest"].dataType.simpleString()
    kept = by_chunk.cogroup(judged.groupBy("chunk")).applyInArrow(
        _remove(grid.buckets), f"rest {rest}, text string, n_words long, n_removed long"
    )
    return chunks.restored(kept, docs.columns, ["n_words", "n_removed"])
