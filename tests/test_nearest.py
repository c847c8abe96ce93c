import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.functions.vectors import cosine
from shelfwise.operators.cells import BestK, Grid, plan_grid
from shelfwise.operators.nearest import topk_cosine, topk_dot
from shelfwise.operators.products import LEFT, RIGHT, Rule, offer_products, side


def frame(spark, vectors, start=0):
    rows = [(start + i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "id int, features array<float>")


def lists(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["id"], []).append((-r["r"], r["pid"]))
    return {i: [(p, -s) for s, p in sorted(v)] for i, v in out.items()}


def brute(left, right, k, unit, digits=6):
    left, right = np.float64(np.float32(left)), np.float64(np.float32(right))
    out = {}
    for i, a in enumerate(left):
        scored = []
        for j, b in enumerate(right):
            norm = np.linalg.norm(a) * np.linalg.norm(b) if unit else 1.0
            if norm == 0 or (unit and i == j) or a @ b <= 0:
                continue
            scored.append((-round(a @ b / norm, digits), j))
        if scored:
            out[i] = [(j, -s) for s, j in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("grid", [None, Grid(1, 1), Grid(3, 1), Grid(1, 4), Grid(3, 2), Grid(7, 5)])
def test_any_grid_gives_the_brute_force_lists(spark, grid):
    random = np.random.default_rng(1)
    left, right = random.normal(size=(60, 5)), random.normal(size=(90, 5))
    got = topk_dot(frame(spark, left), frame(spark, right), 7, digits=6, grid=grid)
    assert lists(got) == brute(left, right, 7, unit=False)
    got = topk_cosine(frame(spark, right), 7, digits=6, grid=grid)
    assert lists(got) == brute(right, right, 7, unit=True)


@pytest.mark.parametrize("grid", [Grid(1, 1), Grid(2, 3)])
def test_a_third_of_the_vectors_are_copies(spark, grid):
    random = np.random.default_rng(2)
    vectors = random.normal(size=(120, 4))
    vectors[::3] = vectors[0]
    got = topk_cosine(frame(spark, vectors), 10, digits=6, grid=grid)
    assert lists(got) == brute(vectors, vectors, 10, unit=True)


def test_zero_equal_and_opposite_vectors(spark):
    vectors = [[0, 0], [1, 1], [2, 2], [-1, -1], [1, 0]]
    got = lists(topk_cosine(frame(spark, vectors), 10, digits=6))
    assert set(got) == {1, 2, 4}
    assert got[1] == [(2, 1.0), (4, 0.707107)] and got[4] == [(1, 0.707107), (2, 0.707107)]


def test_agrees_with_the_pair_formula(spark):
    random = np.random.default_rng(3)
    df = frame(spark, random.normal(size=(40, 6)))
    a, b = df.alias("a"), df.alias("b")
    pairs = a.join(b, F.col("a.id") != F.col("b.id")).select(
        F.col("a.id").alias("id"), F.col("b.id").alias("pid"),
        F.round(cosine(F.col("a.features"), F.col("b.features")), 6).alias("r"),
    )
    assert lists(topk_cosine(df, 100, digits=6)) == lists(pairs.where("r > 0"))


def test_fewer_than_k_positives_and_empty_sides(spark):
    users, items = frame(spark, [[1, 0], [-1, 0]]), frame(spark, [[1, 0], [3, 1]], start=5)
    assert lists(topk_dot(users, items, 100)) == {0: [(6, 3.0), (5, 1.0)]}
    assert topk_dot(users, items.limit(0), 3).count() == 0
    assert topk_dot(users.limit(0), items, 3).count() == 0


def test_vectors_of_unequal_length_are_refused(spark):
    with pytest.raises(Exception, match="differ in length"):
        topk_cosine(frame(spark, [[1, 2], [1, 2, 3]]), 3).collect()


@pytest.mark.parametrize("n", [1, 10, 10**5, 10**8, 10**9, 10**10])
@pytest.mark.parametrize("m", [1, 10**4, 10**8, 10**9, 10**10])
def test_grids_stay_bounded(n, m):
    grid = plan_grid(n, m, 64, 64, 100, 8000)
    assert grid.blocks * 65_536 >= n and grid.strips >= 1
    assert n * m / grid.cells <= 1e11
    assert grid.cells <= 1.1 * max(8000, n * m / 1e11 + 1, n / 65_536 + 1) + grid.blocks
    copies = m * 64 * grid.blocks + n * (64 + 2400) * grid.strips
    # The least that any grid of so many cells ships, unless the rows of a block set the blocks.
    least = 2 * (m * 64 * n * 2464 * grid.cells) ** 0.5
    assert copies <= 3 * least or grid.blocks <= n / 65_536 + 1 or grid.strips == 1


def test_no_cross_join_in_the_plan(spark):
    df = frame(spark, np.eye(3))
    plan = topk_cosine(df, 3)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_lists_of_single_pairs_and_of_matrices_agree():
    random = np.random.default_rng(9)
    scores = np.round(random.normal(size=(40, 3000)), 2)
    scores[3] = scores[5] = 0.5
    partners = random.permutation(3000)
    whole, single = BestK(40, 7), BestK(40, 7)
    whole.offer(scores, partners)
    for at in range(0, 3000, 100):
        row, col = np.nonzero(scores[:, at : at + 100] > -1)
        single.take(row, scores[row, at + col], partners[at + col])
    single.settle()
    assert np.array_equal(whole.scores, single.scores) and np.array_equal(whole.partners, single.partners)
    wanted = [sorted(zip(-s, partners.tolist()))[:7] for s in scores]
    assert whole.partners.tolist() == [[p for _, p in w] for w in wanted]


def test_only_pairs_near_a_list_are_scored_as_doubles(monkeypatch):
    random = np.random.default_rng(10)
    vectors = random.normal(size=(3000, 12)) * random.uniform(1e-3, 1e3, size=(3000, 1))
    dense = []
    offer = BestK.offer
    monkeypatch.setattr(BestK, "offer", lambda s, a, b: (dense.append(a.size), offer(s, a, b))[1])
    for rule, k in ((Rule(LEFT, digits=6), 5), (Rule(RIGHT), 5), (Rule(None), 5), (Rule(None, single=True), 30)):
        dense.clear()
        best, left = BestK(500, k), side(np.arange(500), vectors[:500], True)
        for at in range(0, 3000, 250):
            right = side(np.arange(at, at + 250), vectors[at : at + 250], False)
            offer_products(best, 0, left, np.arange(500), right, rule, np.full(500, -np.inf))
        best.settle()
        assert 0 < sum(dense) <= 500 * 3000 // 3
        scores, counts = rule.finished(vectors[:500] @ vectors.T)
        if rule.same:
            counts[np.arange(500), np.arange(500)] = False
        wanted = BestK(500, k)
        offer(wanted, np.where(counts, scores, -np.inf), np.arange(3000))
        assert np.array_equal(best.partners, wanted.partners)
        assert np.allclose(best.scores, wanted.scores, rtol=1e-12)
