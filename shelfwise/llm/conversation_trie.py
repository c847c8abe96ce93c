"""A trie of the prefixes that conversations share, grown from sorted neighbours by union-find.

Conversations are sorted by their turns and cut into ranges. Within a range the edges between
neighbours, as deep as the prefix they share, join components in descending depth; every join is a
branching node, and what lies between a node and its parent is a chain of nodes with the same
members. Nodes that reach over the end of a range are contracted to one partial row per range and
depth, which are summed up.

Every number of a node is a sum over its conversations, taken at the edge to the neighbour before:
each but the first saves the bytes it shares with the one before it, below the node's parent.

A conversation of many turns becomes a row per ``BLOCK`` turns. The rows that begin behind the same
turns are a trie of their own, whose sums are carried down to the rows before.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.llm.ordered import PART, running_sums
from shelfwise.session import parallelism, staged

BLOCK = 64
#: Turns of a range of the order, on average, where there are more than the session's width of them.
RANGE_TURNS = 500_000
_WIDTH = 16

_ORDER = ["seg", "name", "key", "more", "conv_id"]
_NODE = (
    f"{PART} int, id binary, parent_id binary, conv_id long, parent_conv_id long, depth long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends string"
)
_SHARED = "conv_id long, seg long, saved long, leaf long, opens long"


def turn_keys(turns: DataFrame) -> DataFrame:
    """Columns conv_id, pos (from 1), digest (of role and text) and bytes (of the text in UTF-8).

    ``turns`` has conv_id, turn, role and text; others do not matter. Turns are in the order of
    ``turn``, null first, ties by the digest. Null role or text: empty. Rows without ``conv_id``
    belong to no conversation. Repeated rows are further turns. An empty table gives an empty one.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    written = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    keys = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn"),
        F.substring(F.unhex(F.sha2(written, 256)), 1, _WIDTH).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    placed = running_sums(keys, ["conv_id"], ["turn", "digest"], {"pos": F.lit(1).cast("long")})
    return placed.select("conv_id", "pos", "digest", "bytes")


def borrow_heads(keys: DataFrame, donor: Column, count: Column, most: int) -> DataFrame:
    """Conversations rebuilt: the first ``count`` turns of conversation ``donor`` (all if it has
    fewer, none if it is absent), then the own turns behind the first ``count``.

    ``donor`` and ``count`` are expressions over conv_id, ``count`` at most ``most``. A conversation
    left without turns keeps one row with pos 0.
    """
    keys = staged(keys, "turns")
    head = F.sort_array(F.collect_list(F.struct("pos", "digest", "bytes")))
    heads = keys.where(F.col("pos") <= most).groupBy(F.col("conv_id").alias("donor")).agg(head.alias("head"))
    plan = keys.select("conv_id").distinct().select("conv_id", donor.alias("donor"), count.alias("count"))
    plan = plan.join(heads, "donor", "left")
    plan = plan.withColumn("head", F.expr("slice(coalesce(head, array()), 1, int(count))"))
    own = keys.withColumn("count", count).where(F.col("pos") > F.col("count"))
    moved = own.join(plan.select("conv_id", F.size("head").alias("_given")), "conv_id")
    return (
        plan.select("conv_id", F.inline("head"))
        .unionByName(moved.withColumn("pos", F.col("pos") - F.col("count") + F.col("_given")).select(keys.columns))
        .unionByName(
            plan.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("bytes"))
        )
    )


def _blocks(keys: DataFrame, block: int) -> DataFrame:
    """A row for each ``block`` turns of a conversation: conv_id, seg, key (digests) and sizes."""
    seg = F.when(F.col("pos") > 0, F.floor((F.col("pos") - 1) / block)).otherwise(0).cast("long")
    turn = F.when(F.col("pos") > 0, F.struct("pos", "digest", "bytes"))
    listed = keys.groupBy("conv_id", seg.alias("seg")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return listed.select("conv_id", "seg", F.col("turns.digest").alias("key"), F.col("turns.bytes").alias("sizes"))


def _named(rows: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Rows with more (the conversation goes on), name (of the turns before) and root (the least
    conversation with these turns); and those of them that belong to conversations of many rows.

    Hashes of a conversation's blocks are summed up, so that equal beginnings get equal names.
    """
    ends = rows.groupBy("conv_id").agg(F.max("seg").alias("_last"))
    long = rows.join(ends.where("_last > 0"), "conv_id")
    hashes = {f"_h{k}": F.xxhash64(F.lit(k), "seg", "key").cast("decimal(38,0)") for k in (1, 2)}
    long = running_sums(long, ["conv_id"], ["seg"], hashes)
    before = [F.col(n) - value for n, value in hashes.items()]
    long = long.withColumn("name", F.when(F.col("seg") > 0, F.concat_ws("/", *before)).otherwise(""))
    long = staged(long.withColumn("more", F.col("seg") < F.col("_last")), "long")
    single = rows.join(ends.where("_last > 0"), "conv_id", "left_anti").withColumn("more", F.lit(False))
    full = F.size("key") == block
    after = [F.xxhash64(F.lit(k), "seg", "key").cast("decimal(38,0)") for k in (1, 2)]
    tops = single.where(full).select("conv_id", F.concat_ws("/", *after).alias("name"))
    tops = tops.unionByName(long.where(full).select("conv_id", F.concat_ws("/", *hashes).alias("name")))
    roots = tops.groupBy("name").agg(F.min("conv_id").alias("root"))
    columns = ["conv_id", "seg", "key", "sizes", "name", "more"]
    deep = long.where("seg > 0").join(roots, "name").select(*columns, "root")
    none = F.lit(None).cast("long").alias("root")
    shallow = long.where("seg = 0").select(*columns, none)
    single = single.withColumn("name", F.lit("")).select(*columns, none)
    return single.unionByName(shallow).unionByName(deep), long


def _with_neighbours(ranged: DataFrame) -> DataFrame:
    """The ranges with the last row before and the first row behind each, marked by ``ghost``."""
    place = F.struct(*_ORDER)
    ends = ranged.groupBy(PART).agg(F.min(place).alias("first"), F.max(place).alias("last"))
    order = Window.orderBy(PART)
    ends = ends.select(PART, F.lag("last").over(order).alias("_before"), F.lead("first").over(order).alias("_after"))
    rows = ranged.withColumn("ghost", F.lit(0))
    for side, name in ((-1, "_before"), (1, "_after")):
        beside = ends.where(F.col(name).isNotNull()).select(PART, f"{name}.*", F.lit(side).alias("ghost"))
        rows = rows.unionByName(beside, allowMissingColumns=True)
    return rows


class _Range:
    """The rows of a range in their order, and how many turns each shares with the one before."""

    def __init__(self, table: pa.Table):
        columns = {c: table.column(c).to_pylist() for c in table.column_names}
        keys = [b"".join(k) for k in columns["key"]]
        place = list(zip(columns["seg"], columns["name"], keys, columns["more"], columns["conv_id"]))
        real = sorted((k for k, g in enumerate(columns["ghost"]) if g == 0), key=place.__getitem__)
        beside = {g: k for k, g in enumerate(columns["ghost"]) if g}
        self.part = columns[PART][0]
        self.rows = {c: [values[k] for k in real] for c, values in columns.items()}
        self.keys, self.n = [keys[k] for k in real], len(real)
        self.turns = [len(k) // _WIDTH for k in self.keys]
        line = [beside.get(-1), *real, beside.get(1)]
        self.shared = [
            -1 if a is None or b is None or place[a][:2] != place[b][:2] else _common(keys[a], keys[b])
            for a, b in zip(line, line[1:])
        ]
        #: Bytes of the first turns of each row, from none of them on.
        self.bytes = []
        for sizes in self.rows["sizes"]:
            sums = [0]
            for size in sizes:
                sums.append(sums[-1] + size)
            self.bytes.append(sums)
        self.leaf = [
            int(not more and self.shared[i + 1] < self.turns[i]) for i, more in enumerate(self.rows["more"])
        ]


def _common(a: bytes, b: bytes) -> int:
    """How many digests two keys begin with alike."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // _WIDTH
    k = 0
    while a[k : k + _WIDTH] == b[k : k + _WIDTH]:
        k += _WIDTH
    return k // _WIDTH


def _shares(table: pa.Table) -> pa.Table:
    """What each row of a long conversation adds to the nodes above its block."""
    found = _Range(table)
    rows = [
        (
            found.rows["conv_id"][i], found.rows["seg"][i], found.bytes[i][max(found.shared[i], 0)],
            found.leaf[i], int(found.shared[i] <= 0 and found.turns[i] > 0),
        )
        for i in range(found.n)
        if found.rows["seg"][i] > 0 or found.rows["more"][i]
    ]
    columns = list(zip(*rows)) if rows else [[]] * 5
    names = ["conv_id", "seg", "saved", "leaf", "opens"]
    return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(names, columns)})


def _components(found: _Range) -> tuple[list[int], list[int], list[int], list[int], list[int], list[int]]:
    """Contracted nodes: depth, first and last row, least conversation, parent (-1: none) and number
    of children. The nodes 0 to n - 1 are the rows; one that is the same as another has children -1."""
    n, shared = found.n, found.shared
    depth, first, last = list(found.turns), list(range(n)), list(range(n))
    least, parent, children = list(found.rows["conv_id"]), [-1] * n, [0] * n
    root, node = list(range(n)), list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in sorted((i for i in range(1, n) if shared[i] >= 0), key=lambda i: -shared[i]):
        x, y, level = find(i - 1), find(i), shared[i]
        p, q = node[x], node[y]
        if depth[p] == level:
            top = p
            if depth[q] == level:  # a row of the same turns
                children[q] = -1
            else:
                parent[q] = p
                children[p] += 1
        elif depth[q] == level:
            top, parent[p] = q, q
            children[q] += 1
        else:
            top = len(depth)
            depth.append(level)
            first.append(0), last.append(0), least.append(0), parent.append(-1), children.append(2)
            parent[p] = parent[q] = top
        first[top], last[top], least[top] = first[p], last[q], min(least[p], least[q])
        root[y], node[x] = x, top
    return depth, first, last, least, parent, children


def _sums(values: Iterator[int]) -> list[int]:
    out = [0]
    for v in values:
        out.append(out[-1] + v)
    return out


_EMPTY = hashlib.sha256(b"").hexdigest()


def _forest(block: int):
    def forest(table: pa.Table) -> pa.Table:
        """A row for each node within the range, and a partial one for each that reaches beyond."""
        found = _Range(table)
        rows, keys, n, shared = found.rows, found.keys, found.n, found.shared
        depth, first, last, least, parent, children = _components(found)
        saved = _sums(b[max(s, 0)] for b, s in zip(found.bytes, shared))
        later = _sums(rows["later_saved"])
        leaves = _sums(a + b for a, b in zip(found.leaf, rows["later_leaves"]))
        out: list[tuple] = []

        def beyond(d: int, a: int, b: int) -> bool:
            return (a == 0 and shared[0] >= d) or (b == n - 1 and shared[n] >= d)

        def name(d: int, a: int) -> bytes:
            head = f"{rows['seg'][a]} {rows['name'][a]} {d} ".encode()
            return hashlib.sha256(head + keys[a][: d * _WIDTH]).digest()[:_WIDTH]

        for v in range(len(depth)):
            if children[v] < 0:
                continue
            a, b, up, deepest = first[v], last[v], parent[v], depth[v]
            seg, sizes = rows["seg"][a], found.bytes[a]
            ended, opened, i = [], 0, a
            while i <= b and found.turns[i] == deepest:
                if rows["more"][i]:
                    opened += rows["later_opens"][i]
                else:
                    ended.append(rows["conv_id"][i])
                i += 1
            for d in range(depth[up] + 1 if up >= 0 else min(seg, 1), deepest + 1):
                over = sizes[max(d - 1, 0)]
                total = saved[b + 1] - saved[a + 1] - (b - a) * over + later[b + 1] - later[a]
                total += max(0, sizes[max(shared[a], 0)] - over)
                below = children[v] + opened if d == deepest else 1
                below -= int(shared[a] > d)  # that child begins in an earlier range
                open_ = beyond(d, a, b)
                names = ",".join(map(str, ended)) if d == deepest and ended else None
                above, above_id = None, None
                if d == 1 and seg > 0:
                    above = rows["root"][a]
                elif d > 0:
                    pa_, pb_, pl = (a, b, least[v]) if up < 0 or d - 1 > depth[up] else (first[up], last[up], least[up])
                    if beyond(d - 1, pa_, pb_):
                        above_id = name(d - 1, a)
                    else:
                        above = pl
                if not open_:
                    names = hashlib.sha256(names.encode()).hexdigest() if names else _EMPTY
                out.append(
                    (found.part, name(d, a) if open_ else None, above_id, least[v], above, seg * block + d, b - a + 1,
                     below, leaves[b + 1] - leaves[a], total, names)
                )
        columns = list(zip(*out)) if out else [[]] * 11
        binary, number = pa.binary(), pa.int64()
        types = [pa.int32(), binary, binary, *[number] * 7, pa.string()]
        names = [PART, "id", "parent_id", "conv_id", "parent_conv_id", "depth", "n_convs", "n_children", "n_leaves",
                 "saved_tokens", "ends"]
        return pa.table({c: pa.array(v, t) for c, v, t in zip(names, columns, types)})

    return forest


def _hashed(ends: DataFrame) -> DataFrame:
    """The hash of each node's list of conversations, of which every range holds a stretch.

    A task reads the stretches in their order, so that no list is ever whole in memory.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.binary()), ("ends_sha256", pa.string())])
        now, state = None, None
        for batch in batches:
            ids, hashes = [], []
            for node, stretch in zip(batch.column("id").to_pylist(), batch.column("ends").to_pylist()):
                if node != now:
                    if now is not None:
                        ids.append(now), hashes.append(state.hexdigest())
                    now, state = node, hashlib.sha256(stretch.encode())
                else:
                    state.update(b"," + stretch.encode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(hashes, pa.string())], schema=schema)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], schema=schema)

    dealt = ends.repartition("id").sortWithinPartitions("id", PART)
    return dealt.select("id", "ends").mapInArrow(task, "id binary, ends_sha256 string")


def prefix_trie(keys: DataFrame, block: int = BLOCK) -> DataFrame:
    """The nodes of the trie of all conversations: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    ``keys`` are the rows of ``turn_keys`` or ``borrow_heads``. A node of depth d stands for the
    conversations that begin with the same d turns; conv_id is the least of them and with the depth
    names the node, parent_conv_id that of the node above (null for the root). n_leaves counts the
    childless nodes of its subtree, saved_tokens sums up, over the subtree, the bytes of a node's
    last text times the conversations beyond the first. ends_sha256 hashes the conversations that
    end at the node, as decimals in numeric order with commas between.

    Null, empty and long texts, nulls in other columns, ties and repeated rows: see ``turn_keys``.
    Conversations without turns end at the root. Copies of one conversation are members of the same
    nodes. An empty table has no node.
    """
    spark = keys.sparkSession
    rows = staged(_blocks(keys, block), "blocks")
    turns, longest = rows.agg(F.sum(F.size("key")), F.max("seg")).first()
    long = None
    if longest:
        rows, long = _named(rows, block)
    else:
        rows = rows.withColumns({"name": F.lit(""), "more": F.lit(False), "root": F.lit(None).cast("long")})
    ranges = max(parallelism(spark), (turns or 0) // RANGE_TURNS + 1)
    ranged = rows.repartitionByRange(ranges, *_ORDER).withColumn(PART, F.spark_partition_id())
    ranged = staged(ranged, "ordered")
    later = ["later_saved", "later_leaves", "later_opens"]
    none = {c: F.lit(0).cast("long") for c in later}
    if long is not None:
        shares = _with_neighbours(ranged).groupBy(PART).applyInArrow(_shares, _SHARED)
        behind = running_sums(
            shares.withColumn("_back", -F.col("seg")), ["conv_id"], ["_back"],
            {"later_saved": F.col("saved"), "later_leaves": F.col("leaf")},
        )
        behind = staged(behind, "shares")
        opens = behind.select("conv_id", (F.col("seg") - 1).alias("seg"), F.col("opens").alias("later_opens"))
        behind = behind.select(
            "conv_id", "seg", (F.col("later_saved") - F.col("saved")).alias("later_saved"),
            (F.col("later_leaves") - F.col("leaf")).alias("later_leaves"),
        ).join(opens, ["conv_id", "seg"], "left")
        many = F.col("more") | (F.col("seg") > 0)
        carried = ranged.where(many).join(behind.fillna(0, ["later_opens"]), ["conv_id", "seg"])
        ranged = ranged.where(~many).withColumns(none).unionByName(carried)
    else:
        ranged = ranged.withColumns(none)
    nodes = _with_neighbours(ranged).groupBy(PART).applyInArrow(_forest(block), _NODE)
    nodes = staged(nodes, "forests")

    partial = nodes.where("id is not null")
    merged = partial.groupBy("id").agg(
        F.min("conv_id").alias("conv_id"), F.min("parent_id").alias("parent_id"),
        F.min("parent_conv_id").alias("parent_conv_id"), F.min("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    merged = staged(merged, "merged")
    least = merged.select(F.col("id").alias("parent_id"), F.col("conv_id").alias("_above"))
    hashed = _hashed(partial.where("ends is not null").select("id", PART, "ends"))
    merged = merged.join(least, "parent_id", "left").join(hashed, "id", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY))
    )
    # Children of a node that spans many ranges look it up within their own range.
    least = partial.select(PART, F.col("id").alias("parent_id")).join(least, "parent_id")
    closed = nodes.where("id is null").withColumnRenamed("ends", "ends_sha256").join(least, [PART, "parent_id"], "left")
    columns = [
        "conv_id", "depth", F.coalesce("parent_conv_id", "_above").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", "ends_sha256",
    ]
    return closed.select(*columns).unionByName(merged.select(*columns))
