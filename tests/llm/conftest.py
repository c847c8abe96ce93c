import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

#: Columns that operators add or use inside, as extra columns of their input.
CLASHING = (
    "n_words n_removed n_lines n_dropped chunk rest key row size copies selected kept base spans items hits "
    "contaminated host path rule verdict _part fp component log_ratio html_"
).split()


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text): nulls, empty and long texts, repeats, copies, shared passages and lines."""
    rng = random.Random(7)
    names = ["".join(rng.choices("abcdefghiéñ漢", k=rng.randint(1, 8))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choices(names, k=n))

    passage, line = prose(40), "A line that a number of documents of this corpus Share, word by word."
    rows = [(None, None), (None, prose(30)), (1, ""), (2, None), (3, " \t\n "), (4, "one"), (5, "ONE")]
    rows += [rows[1], (6, prose(60)), (6, prose(60)), (7, passage), (7, passage)]
    rows += [(k, f"{prose(20)}\n{line}\n{passage} {prose(rng.randint(0, 30))}") for k in range(20, 32)]
    rows += [(None, f"{prose(9)}\n  {line.upper()}\t\n"), (32, f"{line}\n{line}\n{prose(3)}")]
    rows += [(40, prose(150_000)), (41, "x" * 300_000)]
    rows += [(50 + k, " ".join([*passage.split()[: 10 + k], prose(5)])) for k in range(8)]
    base = prose(400).split()
    for k in range(20):
        changed = list(base)
        for _ in range(k // 4):
            changed[rng.randrange(400)] = "changed"
        rows.append((70 + k, " ".join(changed)))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, "
    schema += ", ".join(f"`{c}` string" for c in CLASHING)
    extra = (None, "clash") * (len(CLASHING) // 2) + (None,) * (len(CLASHING) % 2)
    sources = [None, "a", "b", "a", "é", "a"]
    data = [
        (d, t, None if k % 5 == 0 else "en", sources[k % len(sources)], None, *extra)
        for k, (d, t) in enumerate(odd_rows)
    ]
    return spark.createDataFrame(data, schema).repartition(5)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(k, 1, 0) for k in range(20, 40)] + [(None, 1, 0), (5, None, None), (4, 0, 0), (20, 1, 0)],
        "doc_id long, quality int, toxic int",
    )


def outcome(df, *columns):
    """Rows as sorted tuples, nulls first."""
    rows = [tuple(r[c] for c in columns) for r in df.select(*columns).collect()]
    return sorted(rows, key=lambda r: [(v is not None, v) for v in r])


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is not None, v) for v in r])
