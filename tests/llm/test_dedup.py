import numpy as np
import pytest
from conftest import ordered, outcome
from pyspark.sql import functions as F

import brute
from shelfwise.llm import chunks, simhash_dedup
from shelfwise.llm.components import components
from shelfwise.llm.line_dedup import dedup_lines, key_spans, line_spans
from shelfwise.llm.simhash_dedup import band_masks, drop_near_duplicates, fingerprints, links, near_duplicates, within
from shelfwise.llm.substring_dedup import COVER, PERIOD, dedup_substrings


def test_the_cover_aligns_any_two_positions():
    for a in range(PERIOD):
        for b in range(PERIOD):
            assert any((a + s) % PERIOD in COVER and (b + s) % PERIOD in COVER for s in range(PERIOD))


def test_substrings(odd, odd_rows):
    found = dedup_substrings(odd)
    assert found.columns == [c for c in odd.columns if c not in ("n_words", "n_removed")] + ["n_words", "n_removed"]
    assert outcome(found, "doc_id", "n_words", "n_removed", "text") == ordered(brute.substrings(odd_rows))


def test_long_words_of_one_pattern_are_told_apart(spark):
    signs = [bin(k).count("1") % 2 for k in range(4096)]
    start = " ".join(f"w{k}" for k in range(12))
    rows = [(1, start + " " + "".join("ab"[s] for s in signs)), (2, start + " " + "".join("ba"[s] for s in signs))]
    rows += [(3, rows[0][1])]
    found = dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"))
    assert outcome(found, "doc_id", "n_words", "n_removed", "text") == ordered(brute.substrings(rows))


def test_lines(odd, odd_rows):
    found = dedup_lines(odd)
    assert outcome(found, "doc_id", "n_lines", "n_dropped", "text") == ordered(brute.lines(odd_rows))
    assert outcome(dedup_lines(odd, 3, 2), "doc_id", "n_lines", "n_dropped", "text") == ordered(
        brute.lines(odd_rows, 3, 2)
    )


def test_empty_tables(odd):
    none = odd.where("false")
    assert dedup_substrings(none).count() == dedup_lines(none).count() == near_duplicates(none).count() == 0
    assert drop_near_duplicates(none).count() == 0


def test_other_columns_stay(odd):
    found = dedup_lines(odd).select("doc_id", "lang", "source", "_part", "chunk")
    assert outcome(found, *found.columns) == outcome(odd, *found.columns)


def test_grid_grows_in_bounds():
    for exponent in range(6, 15):
        size = 10**exponent
        grid = chunks.grid_for(size, 200)
        assert grid.chunks * grid.buckets <= max(4 * 200 * 200, 2 * size / chunks.MESSAGE_BYTES + 1)
        assert size / grid.chunks <= 200 << 20


def test_lines_of_a_buffer():
    data = np.frombuffer(b"a\n\n b \n\xc3\xa9", np.uint8)
    starts, ends, text = line_spans(data, np.array([0, 2, 2, len(data)]))
    assert text.tolist() == [0, 0, 1, 2, 2, 2]
    left, right, points = key_spans(data, starts, ends)
    assert [bytes(data[a:b]) for a, b in zip(left, right)] == [b"a", b"", b"", b"", b"b", b"\xc3\xa9"]
    assert points.tolist() == [1, 0, 0, 0, 1, 1]


def test_fingerprints(odd_rows):
    texts = [t for _, t in odd_rows if len(t or "") < 10_000]
    assert [int(f) for f in fingerprints(texts)] == [brute.fingerprint(t) for t in texts]
    assert [int(f) for f in fingerprints(texts, 2)] == [brute.fingerprint(t, 2) for t in texts]


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7, 8])
def test_bit_planes_count_like_popcounts(radius):
    rng = np.random.default_rng(radius)
    prints = rng.integers(0, 1 << 64, 300, dtype=np.uint64)
    flips = [sum(1 << int(b) for b in rng.choice(64, k % 10, replace=False)) for k in range(300)]
    prints = np.concatenate((prints, prints ^ np.array(flips, np.uint64)))
    near = within(prints, radius).view(np.uint8)
    bits = np.unpackbits(near, axis=1, bitorder="little")[:, : len(prints)].astype(bool)
    assert (bits == (np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius)).all()


@pytest.mark.parametrize("count", [10, 10**8, 10**11])
def test_bands_miss_no_pair(count):
    masks = band_masks(count, 4)
    rng = np.random.default_rng(1)
    for _ in range(500):
        difference = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(difference & mask == 0 for mask in masks)


def test_near_duplicates(odd, odd_rows):
    rows = near_duplicates(odd).collect()
    assert len(rows) == len(odd_rows)
    pairs = [(r.key, r.fp % (1 << 64)) for r in rows]
    assert [r.component for r in rows] == brute.groups(pairs)
    assert sorted(p for _, p in pairs) == sorted(brute.fingerprint(t) for _, t in odd_rows)
    assert {r.key for r in rows if r.doc_id is not None} == {d for d, _ in odd_rows if d is not None}
    kept = drop_near_duplicates(odd)
    assert kept.columns == odd.columns and kept.count() == len({r.component for r in rows})
    assert {r.doc_id for r in kept.collect()} - {None} == {r.component for r in rows if r.component < simhash_dedup.NO_ID}


def test_large_buckets_are_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash_dedup, "TILE", 64)
    rng = np.random.default_rng(3)
    centers = rng.integers(0, 1 << 62, 20, dtype=np.int64)
    flips = [sum(1 << int(b) for b in rng.choice(62, 3, replace=False)) for _ in range(600)]
    prints = sorted({int(centers[k % 20]) ^ f for k, f in enumerate(flips)})
    roots = components(links(spark.createDataFrame([(p,) for p in prints], "fp long"))).collect()
    found = {r.u: r.v for r in roots}
    expected = brute.groups([(p, p) for p in prints])
    assert [found.get(p, p) for p in prints] == expected


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, k) for k in range(101, 300)] + [(101, 100)]
    found = {r.u: r.v for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {k: 1 for k in range(2, 61)} | {k: 100 for k in range(101, 300)}
