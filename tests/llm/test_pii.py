import random

from conftest import outcome
from pyspark.sql import functions as F

import brute
from shelfwise.llm import pii


def texts():
    rng = random.Random(11)
    parts = [
        "a@b.c", "x.y+z@mail.example.com", "a@b", "@", "a@b.c_d@e.f", "q@-.-", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1",
        "0001.02.3.255", "1.2.3", "9.9.9.9999", "4111 1111-1111 1111", "4111111111111111", "4111111111111112",
        "5500-0000-0000-0004", "4111  111111111111", "+1 (838) 555-9577", "+49.30.1234567", "+1", "+123456", "++1234567890",
        "+1 23456789012345678", "12345678901234567890", "é", "漢字", "😀", "word", "-", ".", "\n", "7",
    ]
    made = ["".join(rng.choice([p, p + " ", p + "\n"]) for p in rng.choices(parts, k=rng.randint(1, 12))) for _ in range(400)]
    return made + [None, "", "1" * 5000, "a" * 20_000 + "@", "a@" * 5000, "1.2.3.4 " * 3000, ("+1 " * 3000), "😀a@b.cd"]


def written(df):
    return df.select("n", pii.written("base").alias("base"), pii.written("spans").alias("spans"))


def test_base_spans(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(*r, "x", None) for r in rows], "n long, text string, base string, spans string")
    found = {r.n: r for r in written(pii.find_pii(docs)).collect()}
    for n, text in rows:
        assert found[n].base.split(",") == (brute.pii(text) or [""]), text
        assert set(brute.pii(text)) <= set(found[n].spans.split(","))
    assert pii.find_pii(docs.where("false")).count() == 0


def test_candidates_like_base_spans_are_added(spark):
    rng = random.Random(2)
    rows = []
    for k in range(600):
        number = f"+1 ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        rows.append((k, f"some words and call {number} or more"))
    plain = [(1000 + k, f"some words and call 1 (212) 555-{1000 + k} or more") for k in range(10)]
    numbers = [(2000 + k, f"the year {1900 + k} had {k} of 365 days, item {rng.randint(10**15, 10**16)}") for k in range(300)]
    docs = spark.createDataFrame(rows + plain + numbers, "n long, text string")
    found = pii.find_pii(docs)
    counts = found.select("n", F.size("base").alias("b"), F.size("spans").alias("s"), pii.count_of("base", "phone").alias("p"))
    by = {r.n: (r.b, r.s, r.p) for r in counts.collect()}
    assert all(by[k] == (1, 1, 1) for k in range(600))
    assert all(by[1000 + k] == (0, 1, 0) for k in range(10))
    assert all(by[2000 + k][1] == by[2000 + k][0] for k in range(300))


def test_places_over_many_runs(spark):
    text = "".join(f"{'x' * (k % 5)} 10.0.{k % 256}.{k % 256} " for k in range(3 * pii.RUN + 7))
    row = written(pii.find_pii(spark.createDataFrame([(1, text)], "n long, text string"))).first()
    assert row.base.split(",") == brute.pii(text)


def test_boosting_separates_what_features_separate():
    zero = dict.fromkeys(pii.FEATURES, 0)
    table = [({**zero, "context": c, "regular": r}, 90 if c and r else 0, 0 if c and r else 90) for c in (0, 1) for r in (0, 1)]
    trees = pii.boosted(table)
    scores = [pii.score(trees, row) for row, _, _ in table]
    assert min(s for s, t in zip(scores, table) if t[1]) > 0 > max(s for s, t in zip(scores, table) if t[2])
    assert pii.calibrated(trees, table) == max(scores)
    assert pii.calibrated(trees, [(row, 1, 0) for row, _, _ in table]) is None


def test_equal_rows_get_equal_spans(spark):
    docs = spark.createDataFrame([(1, "a@b.cd"), (1, "a@b.cd")], "n long, text string")
    assert outcome(written(pii.find_pii(docs)), "base") == [("email:0:6",)] * 2


def test_secrets_are_told_by_form_not_only_by_their_word(spark):
    """Precision and recall of additions over planted secrets, among runs of equal length that are none."""
    rng = random.Random(5)

    def code(n, letters):
        return "".join(rng.choice(letters) for _ in range(n - 1)) + "7a"[rng.randint(0, 1)]

    rows, true = [], {}
    for k in range(400):
        secret = code(40, "0123456789abcdef")
        rows.append((k, f'here {rng.choice(["token", "api_key", "password", "secret"])} = "{secret}" and words', None, "x"))
        true[k] = secret
    for k in range(400, 420):  # of the same form, without a word that announces them
        secret = code(40, "0123456789abcdef")
        rows.append((k, f'so it was "{secret}" in the end', None, "x"))
        true[k] = secret
    for k in range(1000, 1400):
        rows.append((k, f"see /archive/{rng.randint(1990, 2020)}/page-{k}/index_{k} and version-{k}-of-the-book-{k}", None, "x"))
    rows.append((5000, None, "a", "b"))
    docs = spark.createDataFrame(rows + rows[:3], "n long, text string, base string, spans string")
    found = pii.find_pii(docs).select("n", "text", "base", "spans").collect()
    assert len(found) == len(docs.collect())
    added = [(r.n, r.text[s.start:s.end]) for r in found for s in r.spans if s.kind == pii.KINDS.index("secret")]
    right = [x for x in added if true.get(x[0]) == x[1]]
    assert len(right) >= 0.9 * len(added) and {n for n, _ in right} == set(true)
    assert not any(r.base for r in found)


def test_check_digits_decide_over_other_forms(spark):
    """Numbers of 15 digits in groups are added where more have a right check digit than chance lets expect."""
    rng = random.Random(8)

    def luhn_ok(digits):
        total = sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits)))
        return total % 10 == 0

    def number(good):
        while True:
            d = "37" + "".join(str(rng.randint(0, 9)) for _ in range(13))
            if luhn_ok(d) == good:
                return d

    cards = [(k, "card {}.{}.{} ok".format(d[:4], d[4:10], d[10:])) for k in range(300) for d in [number(True)]]
    chance = [(1000 + k, f"serial {number(rng.random() < 0.1)} made") for k in range(600)]
    found = pii.find_pii(spark.createDataFrame(cards + chance, "n long, text string"))
    by = {r.n: [s.kind for s in r.spans] for r in found.collect()}
    assert all(by[k] == [pii.KINDS.index("card")] for k in range(300))
    assert not any(pii.KINDS.index("card") in by[1000 + k] for k in range(600))


def test_without_the_trees_the_result_is_another(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f'token = "{k:03d}{"0a1b2c3d4e5f" * 3}"') for k in range(60)], "n long, text string")
    assert pii.find_pii(docs).where("size(spans) = 1").count() == 60
    monkeypatch.setattr(pii, "fit", lambda docs: {})
    assert pii.find_pii(docs).where("size(spans) = 0").count() == 60
