import random
import re
from collections import Counter

import pytest
from conftest import ordered

from shelfwise.llm import collocations
from shelfwise.llm.collocations import mine_phrases

COLUMNS = "lang rank phrase a l r n score".split()


def brute(rows, least, top=2000, longest=4):
    counts, words = Counter(), Counter()
    for text, lang in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang or "und" if lang is None else lang] += len(w)
            for n in range(1, longest + 1):
                counts.update(("und" if lang is None else lang, tuple(w[i : i + n])) for i in range(len(w) - n + 1))
    frequent = {k: a for k, a in counts.items() if a >= least}
    gone = set()
    for (lang, w), f in frequent.items():
        for n in range(2, len(w)):
            for i in range(len(w) - n + 1):
                if 100 * f >= 80 * frequent[lang, w[i : i + n]]:
                    gone.add((lang, w[i : i + n]))
    out = []
    for lang in {k[0] for k in frequent}:
        found = []
        for (g, w), a in frequent.items():
            if g == lang and len(w) > 1 and (g, w) not in gone:
                cuts = [(2_000_000 * a // (frequent[g, w[:k]] + frequent[g, w[k:]]), k) for k in range(1, len(w))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(w).encode(), frequent[g, w[:k]], frequent[g, w[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, words[lang], -s))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    names = ["New", "york", "é", "漢", "\x01", "a\x01", "a", "ab", "the", "of", "\x7f", "İ"]
    out = [(None, None), (None, "en"), ("", "en"), ("  \t ", ""), (".,;", "de"), ("lone", "it")]
    for k in range(300):
        text = "".join(rng.choice(names) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", "\r\n", "\x0b"]) for _ in range(rng.randint(0, 40)))
        out += [(text, rng.choice(["en", "de", None, "", "é"]))] * rng.choice([1, 1, 3])
    return [*out, ("the same words here again " * 20_000, "en"), ("x" * 200_000, "en")]


@pytest.mark.parametrize("least, top", [(2, 2000), (30, 2000), (5, 7)])
def test_phrases_beside_brute_force(spark, rows, least, top):
    docs = spark.createDataFrame([(t, g, "clash", None) for t, g in rows], "text string, lang string, f string, words string")
    found = mine_phrases(docs.repartition(7), least=least, top=top)
    assert found.columns == COLUMNS
    assert ordered([tuple(r) for r in found.collect()]) == ordered(brute(rows, least, top))


def test_buckets_add_up_in_parts(spark, rows, monkeypatch):
    monkeypatch.setattr(collocations, "_AT_ONCE", 50)
    docs = spark.createDataFrame(rows, "text string, lang string")
    found = mine_phrases(docs, longest=3, least=4)
    assert ordered([tuple(r) for r in found.collect()]) == ordered(brute(rows, 4, longest=3))


def test_scores_beyond_64_bits(spark):
    a, both = 10**15, 2 * 10**15 + 1
    row = spark.range(1).selectExpr(f"cast({a} as bigint) as f", f"cast({both} as bigint) as b")
    score = row.selectExpr("cast(f as decimal(20,0)) * 2000000 div cast(b as decimal(20,0)) as s").first().s
    assert score == 2_000_000 * a // both


def test_empty_table(spark):
    assert mine_phrases(spark.createDataFrame([], "text string, lang string")).count() == 0
