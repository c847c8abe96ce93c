"""Encoding and decoding with a byte-pair model file, by vectorised rounds of merges.

Texts become flat arrays of symbols, cut into words where no piece reaches across. Each distinct
word of a block is merged once: every round finds the best rank of each word, merges all of its
places at once from the left, and compacts the arrays, until no pair is left.
"""

import heapq
import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.words import pieces, text_buffer

SPACE = 0x2581
NONE = np.iinfo(np.int32).max
#: Texts above this are encoded in blocks that end where a word ends.
BLOCK_BYTES = 1 << 20
#: Words of more symbols are merged one place at a time, in the same order, with a heap.
LONG_WORD = 2048
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6


class PairTable:
    """Values of pairs of symbols, as open addressing in numpy arrays that whole arrays probe."""

    def __init__(self, left, right, values):
        keys = self._key(np.asarray(left, np.int64), np.asarray(right, np.int64))
        size = 1 << max(6, int(len(keys) * 3).bit_length())
        self.mask, self.keys, self.values = np.int64(size - 1), np.full(size, -1), np.full(size, NONE, np.int32)
        slot, todo, values = self._slot(keys), np.arange(len(keys)), np.asarray(values, np.int32)
        while len(todo):
            free = todo[self.keys[slot[todo]] < 0]
            self.keys[slot[free]] = keys[free]
            placed = self.keys[slot[todo]] == keys[todo]
            self.values[slot[todo[placed]]] = values[todo[placed]]
            todo = todo[~placed]
            slot[todo] = (slot[todo] + 1) & self.mask

    @staticmethod
    def _key(left, right):
        return (left << np.int64(32)) | right

    def _slot(self, keys):
        wide = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((wide >> np.uint64(32)).view(np.int64)) & self.mask

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The value of each pair, ``NONE`` for pairs that have none."""
        keys = self._key(left.astype(np.int64), right.astype(np.int64))
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], NONE)
        todo = np.flatnonzero((there != keys) & (there >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            there = self.keys[slot[todo]]
            same = there == keys[todo]
            out[todo[same]] = self.values[slot[todo[same]]]
            todo = todo[~same & (there >= 0)]
        return out


class Model(NamedTuple):
    """What tasks need of a model file; as large as its vocabulary."""

    size: int
    chars: np.ndarray  # symbol of each code point, -1 if no piece has it
    merges: PairTable  # number of the merge of a pair of symbols
    into: np.ndarray  # by merge: the piece made
    rank: np.ndarray  # by merge: order of the piece, best first
    early: np.ndarray  # by merge: whether it may come before the merge that makes one of its parts
    inside: PairTable  # pairs of symbols that stand side by side in some piece
    spaces_cut: bool  # a space after something else always begins a word
    byte_ids: np.ndarray
    prefix: bool
    unknown: int
    begin: int
    end: int
    surfaces: bytes  # what each id decodes to, one after the other
    surface_ends: np.ndarray
    kinds: np.ndarray
    begins_space: np.ndarray


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one message in the wire format of protocol buffers."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
            continue
        length = {1: 8, 5: 4}.get(tag & 7)
        length = number() if length is None else length
        yield tag >> 3, data[at : at + length]
        at += length


def load_model(path: str) -> Model:
    """Read a model file on the driver.

    It has to be a byte-pair model with byte fallback, with texts taken as they are (no character
    map, white space kept) and without user-defined or unused pieces; others raise a ValueError.
    """
    with open(path, "rb") as file:
        message = list(_fields(file.read()))
    names, scores, kinds = [], [], []
    for field, body in message:
        if field == 1:
            piece = dict(_fields(body))
            names.append(piece[1].decode())
            scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            kinds.append(piece.get(3, _NORMAL))
    trained = dict(_fields(dict(message)[2]))
    normal = dict(_fields(dict(message)[3]))
    plain = trained.get(3, 1) == 2 and trained.get(35) and not trained.get(24) and not normal.get(2)
    plain = plain and not normal.get(4, 1) and normal.get(5, 1) and set(kinds) <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}
    if not plain:
        raise ValueError(f"{path}: only byte-pair models with byte fallback and no normalisation are supported")
    return _tables(names, np.array(scores), np.array(kinds), trained, bool(normal.get(3, 1)))


def _tables(names: list[str], scores: np.ndarray, kinds: np.ndarray, trained: dict, prefix: bool) -> Model:
    size = len(names)
    ordinary = [k for k in range(size) if kinds[k] == _NORMAL]
    symbol = {names[k]: k for k in ordinary}
    for k in ordinary:
        for char in names[k]:
            symbol.setdefault(char, size + ord(char))
    chars = np.full(0x110000, -1, np.int32)
    for name, k in symbol.items():
        if len(name) == 1:
            chars[ord(name)] = k
    order = np.unique(-scores[ordinary], return_inverse=True)[1]
    rank_of = {k: int(r) for k, r in zip(ordinary, order)}
    left, right, into, rank, early, inside = [], [], [], [], [], set()
    for k in ordinary:
        name = names[k]
        for cut in range(1, len(name)):
            inside.add((symbol[name[cut - 1]], symbol[name[cut]]))
            x, y = symbol.get(name[:cut]), symbol.get(name[cut:])
            if x is not None and y is not None:
                parts = [rank_of[s] for s, n in ((x, cut), (y, len(name) - cut)) if n > 1]
                left.append(x), right.append(y), into.append(k), rank.append(rank_of[k])
                early.append(rank_of[k] <= max(parts, default=-1))
    surfaces = [
        b"" if kinds[k] == _CONTROL
        else bytes([int(names[k][3:5], 16)]) if kinds[k] == _BYTE
        else trained.get(44, " ⁇ ".encode()) if kinds[k] == _UNKNOWN
        else names[k].replace(chr(SPACE), " ").encode()
        for k in range(size)
    ]
    space = symbol.get(chr(SPACE), -1)
    byte_ids = np.zeros(256, np.int32)
    for k in np.flatnonzero(kinds == _BYTE):
        byte_ids[surfaces[k][0]] = k
    sides = np.array(sorted(inside), np.int64).reshape(-1, 2)
    return Model(
        size, chars, PairTable(left, right, np.arange(len(left))), np.array(into, np.int32),
        np.array(rank, np.int32), np.array(early, bool), PairTable(sides[:, 0], sides[:, 1], np.ones(len(sides))),
        not any(b == space != a for a, b in inside), byte_ids, prefix, trained.get(40, 0), trained.get(41, 1),
        trained.get(42, 2), b"".join(surfaces), np.cumsum([len(s) for s in surfaces]), kinds,
        np.array([names[k].startswith(chr(SPACE)) and kinds[k] == _NORMAL for k in range(size)]),
    )


def _flat(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of spans, one span after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def _in_turn(model: Model, symbols: list[int]) -> list[int]:
    """Merge one word a place at a time: best rank first, then leftmost."""
    n = len(symbols)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(lefts: list[int]) -> None:
        lefts = [i for i in lefts if i >= 0 and after[i] >= 0]
        a, b = [symbols[i] for i in lefts], [symbols[after[i]] for i in lefts]
        found = model.merges.find(np.array(a, np.int32), np.array(b, np.int32)).tolist() if lefts else []
        for i, x, y, merge in zip(lefts, a, b, found):
            if merge != NONE:
                heapq.heappush(heap, (int(model.rank[merge]), i, x, y, int(model.into[merge])))

    offer(list(range(n)))
    while heap:
        _, i, x, y, made = heapq.heappop(heap)
        if symbols[i] != x or after[i] < 0 or symbols[after[i]] != y:
            continue
        gone = after[i]
        symbols[i], symbols[gone], after[i] = made, -1, after[gone]
        if after[i] >= 0:
            before[after[i]] = i
        offer([before[i], i])
    return [s for s in symbols if s >= 0]


def merge_words(model: Model, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of each word, one word after the other, and their number by word.

    A word leaves the rounds when it has no pair left. Should a pair turn up whose piece ranks
    before one of its parts, so that merging all places of a round at once might differ from
    merging them in turn, the word starts again in turn; so do words of over ``LONG_WORD`` symbols.
    """
    words = len(starts)
    lengths = np.diff(np.append(starts, len(symbols)))
    in_turn = lengths > LONG_WORD
    done: list[tuple[np.ndarray, np.ndarray]] = []
    keep = np.repeat(~in_turn, lengths)
    word, sym = np.repeat(np.arange(words), lengths)[keep], symbols[keep]
    merge = np.full(len(sym), NONE, np.int32)
    fresh = np.arange(len(sym))

    def lookup(at: np.ndarray) -> None:
        at = at[(at >= 0) & (at < len(sym))]
        merge[at] = NONE
        at = at[at + 1 < len(sym)]
        at = at[word[at] == word[at + 1]]
        merge[at] = model.merges.find(sym[at], sym[at + 1])
        found = merge[at]
        known = found != NONE
        in_turn[word[at[known][model.early[found[known]]]]] = True

    while len(sym):
        lookup(fresh)
        rank = np.where(merge == NONE, NONE, model.rank[np.where(merge == NONE, 0, merge)])
        begin = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        best = np.minimum.reduceat(rank, begin)
        best = np.repeat(best, np.diff(np.append(begin, len(word))))
        ended, live = (best == NONE) & ~in_turn[word], (best != NONE) & ~in_turn[word]
        done.append((word[ended], sym[ended]))
        word, sym, merge, hit = word[live], sym[live], merge[live], (rank == best)[live]
        places = np.flatnonzero(hit)
        if not len(places):
            break
        first = np.concatenate(([True], np.diff(places) != 1))
        run = places[np.flatnonzero(first)[np.cumsum(first) - 1]]
        places = places[(places - run) % 2 == 0]
        made = model.into[merge[places]]
        # A piece just made may meet the left part of the next place before that is merged.
        close = np.flatnonzero(np.diff(places) == 2)
        close = close[word[places[close]] == word[places[close + 1]]]
        between = model.merges.find(made[close], sym[places[close + 1]])
        known = between != NONE
        in_turn[word[places[close[known][model.early[between[known]]]]]] = True
        sym[places] = made
        stay = np.ones(len(sym), bool)
        stay[places + 1] = False
        place = (np.cumsum(stay) - 1)[places]
        word, sym, merge = word[stay], sym[stay], merge[stay]
        changed = np.zeros(len(sym), bool)
        changed[place] = True
        changed[place[place > 0] - 1] = True
        fresh = np.flatnonzero(changed)
    for k in np.flatnonzero(in_turn).tolist():
        found = _in_turn(model, symbols[starts[k] : starts[k] + lengths[k]].tolist())
        done.append((np.full(len(found), k), np.array(found, sym.dtype)))
    word = np.concatenate([w for w, _ in done]) if done else np.zeros(0, np.int64)
    sym = np.concatenate([s for _, s in done]) if done else sym
    return sym[np.argsort(word, kind="stable")], np.bincount(word, minlength=words)


_POINT = np.random.Generator(np.random.PCG64(20240301)).integers(0, 1 << 64, 4096, dtype=np.uint64)
_RADIX = np.uint64(0x9E3779B97F4A7C15)


def _distinct(points: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One occurrence of each distinct word, and which of them each word equals, code for code."""
    place = np.arange(len(points)) - np.repeat(starts, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _RADIX))
    mixed = (_POINT[points & 4095] + points.astype(np.uint64)) * powers[place]
    hashes = np.add.reduceat(mixed ^ (mixed >> np.uint64(29)), starts)
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    twin = first[which]
    same = lengths == lengths[twin]
    over = np.minimum(np.repeat(starts[twin], lengths) + place, len(points) - 1)
    same &= np.logical_and.reduceat(points == points[over], starts)
    odd = np.flatnonzero(~same)
    which[odd] = len(first) + np.arange(len(odd))
    return np.concatenate((first, odd)), which


def _utf8(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of code points, one point after the other, and their number by point."""
    data = np.frombuffer("".join(map(chr, points.tolist())).encode("utf-8", "surrogatepass"), np.uint8)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    return data, np.diff(np.append(lead, len(data)))


def _block(model: Model, texts: list[str], prefix: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts, one text after the other, and their number by text; no begin and end ids."""
    sizes = np.array([len(t) for t in texts], np.int64)
    if prefix and model.prefix:
        texts, sizes = [chr(SPACE) + t if t else t for t in texts], sizes + (sizes > 0)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    if not len(points):
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    points[points == 32] = SPACE
    symbols = model.chars[points]
    symbols = np.where(symbols < 0, points.astype(np.int32) + model.size, symbols)
    cut = np.ones(len(points), bool)
    cut[1:] = model.inside.find(symbols[:-1], symbols[1:]) == NONE
    begins = np.cumsum(sizes) - sizes
    cut[begins[sizes > 0]] = True
    starts = np.flatnonzero(cut)
    lengths = np.diff(np.append(starts, len(points)))
    one, which = _distinct(points, starts, lengths)
    at = np.cumsum(lengths[one]) - lengths[one]
    made, counts = merge_words(model, symbols[_flat(starts[one], lengths[one])], at)
    loose = np.flatnonzero(made >= model.size)
    if len(loose):
        data, width = _utf8(made[loose] - model.size)
        repeat = np.ones(len(made), np.int64)
        repeat[loose] = width
        owner = np.repeat(np.repeat(np.arange(len(one)), counts), repeat)
        wide = np.repeat(made, repeat)
        wide[wide >= model.size] = model.byte_ids[data]
        made, counts = wide, np.bincount(owner, minlength=len(one))
    begin = np.cumsum(counts) - counts
    ids = made[_flat(begin[which], counts[which])]
    per_word = counts[which]
    text_of = np.searchsorted(begins + sizes, starts, side="right")
    return ids.astype(np.int32), np.bincount(text_of, per_word, len(texts)).astype(np.int64)


def _parts(model: Model, text: str) -> Iterator[str]:
    """A long text in parts that begin with words, each of about ``BLOCK_BYTES`` code points."""
    start = 0
    while len(text) - start > BLOCK_BYTES and model.spaces_cut:
        stop = text.find(" ", start + BLOCK_BYTES)
        while stop > 0 and text[stop - 1] in (" ", chr(SPACE)):
            stop = text.find(" ", stop + 1)
        if stop < 0:
            break
        yield text[start:stop]
        start = stop
    yield text[start:]


def encode_texts(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids with begin and end, one text after the other, and where each text begins and the last ends."""
    ids, counts = [], []
    if sum(map(len, texts)) > BLOCK_BYTES and len(texts) == 1:
        found = [_block(model, [part], k == 0)[0] for k, part in enumerate(_parts(model, texts[0]))]
        ids, counts = np.concatenate(found), np.array([sum(map(len, found))])
    else:
        ids, counts = _block(model, texts, True)
    ends = np.cumsum(counts)
    # Places that are equal are filled in the order given: an end before the next text's begin.
    places = np.stack((ends - counts, ends), axis=1).ravel()
    framed = np.insert(ids, places, np.tile([model.begin, model.end], len(texts)))
    return framed.astype("<u4"), np.concatenate(([0], ends + 2 * np.arange(1, len(texts) + 1)))


def _points(data: bytes) -> str:
    """Bytes as text; each byte that begins no valid character becomes U+FFFD."""
    out, at = [], 0
    while at < len(data):
        for width in (1, 2, 3, 4):
            try:
                out.append(data[at : at + width].decode())
            except UnicodeDecodeError:
                continue
            if out[-1]:
                at += width
                break
        else:
            out.append("�")
            at += 1
    return "".join(out)


def _careful(model: Model, ids: np.ndarray) -> bytes:
    """The text of one row whose byte ids do not all form characters."""
    out, run = [], b""
    for k in ids.tolist():
        surface = model.surfaces[model.surface_ends[k - 1] if k else 0 : model.surface_ends[k]]
        if model.kinds[k] == _BYTE:
            run += surface
        else:
            out.append(_points(run).encode() + surface)
            run = b""
    return b"".join([*out, _points(run).encode()])


def decode_ids(model: Model, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The texts of rows of ids. An id outside of the vocabulary counts as the unknown one."""
    ids = np.where((ids >= 0) & (ids < model.size), ids, model.unknown).astype(np.int64)
    ends = model.surface_ends
    begins = np.concatenate(([0], ends[:-1]))
    lengths = (ends - begins)[ids]
    data = np.frombuffer(model.surfaces, np.uint8)[_flat(begins[ids], lengths)].tobytes()
    where = np.concatenate(([0], np.cumsum(lengths)))[offsets]
    shown = np.append(np.flatnonzero(model.kinds[ids] != _CONTROL), len(ids))
    head = shown[np.searchsorted(shown, offsets[:-1])]
    strip = np.zeros(len(offsets) - 1, bool)
    real = head < offsets[1:]
    strip[real] = model.begins_space[ids[head[real]]] & model.prefix
    # A silent id between byte ids ends their run.
    kinds = model.kinds[ids]
    silent = np.flatnonzero((kinds[1:] == _CONTROL) & (kinds[:-1] == _BYTE)) + 1
    parted = set((np.searchsorted(offsets, silent, side="right") - 1).tolist())
    parted = {k for k in parted if (kinds[offsets[k] : offsets[k + 1] - 1] == _CONTROL)[1:].any()}
    out = []
    for k, (a, b) in enumerate(zip(where[:-1].tolist(), where[1:].tolist())):
        try:
            text = None if k in parted else data[a:b].decode()
        except UnicodeDecodeError:
            text = None
        if text is None:
            text = _careful(model, ids[offsets[k] : offsets[k + 1]]).decode()
        out.append(text[1:] if strip[k] else text)
    return out


def _added(docs: DataFrame, names: dict[str, str]) -> tuple[list[str], str]:
    """The input's columns that stay, and the schema of these with the new ones behind."""
    stay = [c for c in docs.columns if c not in names]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in stay]
    return stay, ", ".join([*fields, *[f"{n} {t}" for n, t in names.items()]])


def encode(docs: DataFrame, model_path: str, packed: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (begin id, the pieces of ``text``, end id) and ``n_tokens``, their number.

    ``ids`` is an array of int, or with ``packed`` the little-endian unsigned 32-bit integers as
    binary. The model file is read on the driver; its tables, as large as the vocabulary, are
    broadcast. A task holds a megabyte of text at a time, or one text; a longer one is encoded in
    blocks that end where a word ends.

    Null and empty texts: begin and end alone. Very long texts and words: whole, nothing is cut
    off. Repeated rows and ties: each row by itself. An empty table: an empty table. Columns named
    ``ids`` or ``n_tokens`` are replaced, all others kept.
    """
    stay, schema = _added(docs, {"n_tokens": "long", "ids": "binary" if packed else "array<int>"})
    tables = docs.sparkSession.sparkContext.broadcast(load_model(model_path))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "_text", BLOCK_BYTES):
                texts = [t or "" for t in piece.column("_text").to_pylist()]
                ids, offsets = encode_texts(tables.value, texts)
                if packed:
                    buffers = [None, pa.py_buffer((offsets * 4).astype(np.int64)), pa.py_buffer(ids.tobytes())]
                    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), buffers).cast(pa.binary())
                else:
                    found = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.view("<i4"), pa.int32()))
                columns = [piece.column(c) for c in stay]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(np.diff(offsets), pa.int64()), found], [*stay, "n_tokens", "ids"]
                )

    given = docs.select(*[F.col(f"`{c}`") for c in stay], F.col("text").cast("string").alias("_text"))
    return given.mapInArrow(task, schema)


def decode(docs: DataFrame, model_path: str, name: str = "decoded") -> DataFrame:
    """``docs`` with the text that ``ids`` (array of int, or packed binary) stand for.

    Begin and end ids are silent, the space that encoding puts first is taken off, byte ids that
    form no character become U+FFFD. Null or empty ``ids``: an empty text; null or unknown numbers
    in it: the unknown piece. A column of the result's name is replaced, all others are kept.
    """
    stay, schema = _added(docs, {name: "string"})
    tables = docs.sparkSession.sparkContext.broadcast(load_model(model_path))
    packed = docs.schema["ids"].dataType.simpleString() == "binary"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 64):
                batch = whole.slice(start, 64)
                rows = batch.column("_ids").to_pylist() if packed else None
                if packed:
                    rows = [np.frombuffer(r or b"", "<u4").astype(np.int64) for r in rows]
                    flat = np.concatenate(rows)
                    counts = [len(r) for r in rows]
                else:
                    lists = batch.column("_ids")
                    flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                    counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                texts = decode_ids(tables.value, flat, np.concatenate(([0], np.cumsum(counts))).astype(np.int64))
                columns = [batch.column(c) for c in stay]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*stay, name])

    return docs.select(*[F.col(f"`{c}`") for c in stay], F.col("ids").alias("_ids")).mapInArrow(task, schema)
