import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from conftest import ordered
from pyspark.sql import functions as F

from shelfwise.llm.conversation_trie import borrow_heads, prefix_trie, turn_keys

SCHEMA = "conv_id long, turn long, role string, text string, pos string, n_convs string, part string, seg string"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def sequences(rows):
    """Turns of each conversation; ties of turn are of equal role and text here."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute_trie(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    saved, leaves = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[c] for c in children[node])
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
    return [
        (
            m[0], len(node), members[node[:-1]][0] if node else None, len(m), len(children[node]), leaves[node],
            saved[node], hashlib.sha256(",".join(str(c) for c in m if convs[c] == list(node)).encode()).hexdigest(),
        )
        for node, m in members.items()
    ]


def conversations():
    rng = random.Random(13)
    said = [("user", "hi"), ("assistant", "hello"), ("user", ""), (None, "é漢"), ("user", None), ("a", "ser")]
    rows = []
    for c in range(120):
        length = rng.choice([0, 1, 2, 3, 5, 8, 13])
        rows += [(c, t, *rng.choice(said[: rng.choice([1, 2, 6])])) for t in range(length)]
    rows += [(c, t, "user", "the same") for c in range(200, 260) for t in range(4)]  # copies
    rows += [(c, t, "user", f"turn {t}") for c in (300, 303, 304, 306) for t in range(70 + c % 5 * 20)]  # long ones
    rows += [(307, t, "user", f"turn {t}" if t < 90 else "else") for t in range(140)]
    rows += [(-7, None, "user", "no turn"), (-7, 0, "user", "zero"), (None, 0, "user", "of none"), (400, 1, None, None)]
    rows += [(401, 3, "user", "twice"), (401, 3, "user", "twice"), (402, 0, "x" * 50_000, "y" * 300_000)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame([(*r, None, "clash", None, "clash") for r in conversations()], SCHEMA)


def outcome(df):
    assert df.columns == COLUMNS
    return ordered([tuple(r) for r in df.collect()])


@pytest.mark.parametrize("block", [1, 2, 5, 64, 1000])
def test_trie_beside_brute_force(turns, block):
    assert outcome(prefix_trie(turn_keys(turns), block)) == ordered(brute_trie(sequences(conversations())))


@pytest.mark.parametrize("block", [3, 64])
def test_rebuilt_conversations(turns, block):
    donor = F.col("conv_id") - F.pmod("conv_id", F.lit(5))
    count = F.crc32(F.col("conv_id").cast("string")) % 9
    found = prefix_trie(borrow_heads(turn_keys(turns), donor, count, 8), block)
    assert outcome(found) == ordered(brute_trie(rebuilt(sequences(conversations()))))


def test_empty_table(turns):
    assert prefix_trie(turn_keys(turns.where("false"))).count() == 0
