"""Words and n-grams of Arrow text columns as numpy arrays.

The helpers work on one batch at a time and never on Python strings: a word is a pair of byte
offsets into the batch's text buffer and a 64-bit hash.
"""

import numpy as np
import pyarrow as pa

SPACES = b" \t\n\x0b\x0c\r"
PIECE_BYTES = 1 << 20

#: Bytes of a span whose multipliers are powers; powers of an odd number alone are of one pattern modulo
#: 2^64, and long words that swap two letters by it (Thue-Morse words) would all meet.
POWERS = 64

_mixer = np.random.Generator(np.random.PCG64(20240229))
_BYTES = _mixer.integers(0, 1 << 64, (2, 256), dtype=np.uint64)
_RADIX = _mixer.integers(0, 1 << 64, 2, dtype=np.uint64) | np.uint64(1)
_STEPS = _mixer.integers(0, 1 << 64, (2, 64), dtype=np.uint64) | np.uint64(1)


def byte_set(values) -> np.ndarray:
    """A table of 256 flags, set for the given byte values."""
    table = np.zeros(256, bool)
    table[np.frombuffer(bytes(values), np.uint8)] = True
    return table


NOT_SPACE = ~byte_set(SPACES)
#: Word bytes of the contamination rule: digits, lower-case letters, and all bytes beyond ASCII.
ALNUM = byte_set([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offset where each text begins (one more for the end).

    A null text counts as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES):
    """Slices of ``batch`` of about ``limit`` bytes of text each, at least one row; no row is cut."""
    if not batch.num_rows:
        return
    _, offsets = text_buffer(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Start, end and text number of each word; a word never reaches over the end of its text."""
    inside = is_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    text_of = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, text_of


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _multipliers(family: int, length: int) -> np.ndarray:
    """An odd multiplier for each place in a span: a few powers, then one of its own for each place."""
    out = _mixed(np.arange(length, dtype=np.uint64) * _STEPS[family][0] + _RADIX[family]) | np.uint64(1)
    few = min(length, POWERS)
    if few:
        out[0] = 1
        np.cumprod(np.full(few - 1, _RADIX[family]), out=out[1:few])
    return out


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int = 0) -> np.ndarray:
    """A 64-bit hash of each span's bytes, equal for equal bytes wherever they stand."""
    out = np.empty(len(starts), np.uint64)
    longest = int((ends - starts).max()) if len(starts) else 0
    factors = _multipliers(family, longest)
    begin = 0
    while begin < len(starts):
        stop = max(int(np.searchsorted(ends, starts[begin] + PIECE_BYTES, side="right")), begin + 1)
        s, e = starts[begin:stop], ends[begin:stop]
        length = e - s
        first = np.concatenate(([0], np.cumsum(length)))
        place = np.arange(first[-1]) - np.repeat(first[:-1], length)
        values = _BYTES[family][data[place + np.repeat(s, length)]] * factors[place]
        out[begin:stop] = np.add.reduceat(values, first[:-1]) + length.astype(np.uint64)
        begin = stop
    return _mixed(out)


def gram_hashes(words: np.ndarray, n: int, family: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` consecutive words, by the position of its first word."""
    count = max(len(words) - n + 1, 0)
    out = np.zeros(count, np.uint64)
    for k in range(n):
        out += words[k : k + count] * _STEPS[family][k]
    return _mixed(out)


def gram_fits(text_of: np.ndarray, n: int) -> np.ndarray:
    """Whether the run of ``n`` words from each position stays in one text."""
    count = max(len(text_of) - n + 1, 0)
    return text_of[:count] == text_of[n - 1 : n - 1 + count]


def covered(starts: np.ndarray, n: int, length: int) -> np.ndarray:
    """Flags of the positions that lie in a run of ``n`` positions from one of ``starts``."""
    change = np.zeros(length + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + n, -1)
    return np.cumsum(change[:-1]) > 0


def first_words(text_of: np.ndarray, texts: int) -> np.ndarray:
    """For each text the number of its first word, and the number of words at the end."""
    return np.searchsorted(text_of, np.arange(texts + 1))
