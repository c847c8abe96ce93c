"""Personal data and secrets in texts: exact formats, and boosted trees over looser candidates.

Everything runs as column expressions. A document's spans are arrays in its row, so nothing is
shuffled but the counts that the trees are fitted on.
"""

import math
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

#: The kinds with a base format, and those that only the trees can find.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")

#: The base formats. Quantifiers that cannot give back are possessive, and a run that failed from
#: its first character is not tried again from the next ones; both leave the matches as they are.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must contain to be searched.
NEEDED = {"email": "@", "ip": ".", "card": None, "phone": "+"}

#: Candidates: the base formats and ways around them, and long runs of letters and digits.
LOOSE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++ ?(?:@|[\[({<]at[\])}>]) ?[A-Za-z0-9-]++"
    r"(?: ?(?:\.|[\[({<]dot[\])}>]) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:.])(?:[0-9]++(?:(?:\.|[\[({<](?:\.|dot)[\])}>])[0-9]++){3}|(?:[0-9A-Fa-f]{1,4}+:){7}+[0-9A-Fa-f]{1,4}+)",
    "card": r"[0-9](?:[ ._/-]{0,2}+[0-9]){12,}+",
    "phone": r"(?<![0-9A-Za-z+])(?:\+|00|\()?+[0-9](?:[ ().‐-―/-]{0,3}+[0-9]){7,}+",
    "secret": r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9])(?=[0-9_+/=-]*+[A-Za-z])[A-Za-z0-9_+/=-]{16,}+",
}

_OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_OCTETS = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"
#: Words that announce a kind, shortly before it.
_WORDS = {
    "email": "mail|contact|write|reach|address|adresse|correo|courriel",
    "ip": "\\bip\\b|server|host|address|login|adresse",
    "card": "card|visa|amex|credit|payment|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|whatsapp|téléphone|teléfono",
    "secret": "token|secret|passw|pwd|key|credential|bearer|auth",
}


def _announced(kind: str, left: Column) -> Column:
    pattern = rf"(?i)(?:{_WORDS[kind]})[^A-Za-z0-9]{{0,3}}[A-Za-z]{{0,8}}[^A-Za-z0-9]{{0,4}}$"
    return F.coalesce(F.rlike(left, F.lit(pattern)), F.lit(False))


_REGULAR = {
    "email": r"(?:\.|dot[\])}>]) ?[A-Za-z]{2,}$",
    "ip": r"^[0-9]{1,3}(?:[^0-9]+[0-9]{1,3}){3}$",
    "card": r"^[3-6][0-9]{3}(?:([ ._/-]{0,2})[0-9]{4}){2}(?:[ ._/-]{0,2}[0-9]+)+$",
    "phone": r"[0-9]{3}[^0-9]+[0-9]{4}$",
    "secret": r"^(?:[0-9a-f]{20,}|[0-9A-F]{20,})$",
}

CONTEXT_CHARS = 32
#: Spans of one text whose places are summed up together.
RUN = 256

TREES, RATE = 40, 0.3
#: Added spans have to score where at least this share of held-out candidates are true by the evidence,
#: with so many others assumed beside those counted, so that a few candidates prove nothing.
PRECISION = 0.9
DOUBT = 2
#: Kinds whose evidence is a check on the candidate's own digits, and the share of chance numbers that
#: pass it (one check digit; for addresses an upper estimate). The evidence of the other kinds is a word
#: before the candidate that announces them.
CHANCE = {"ip": 0.1, "card": 0.1}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total, place):
        digit = F.substring(digits, F.length(digits) - place + 1, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(place % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def valid(kind: str, text: Column) -> Column:
    """Whether a match of the base format is personal data."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.rlike(text, F.lit(_OCTETS))
    digits = _digits(text)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)


def _place(run: Column, begin: Column) -> Column:
    """The matches of one run, from the offset where its first gap begins."""
    nothing = F.array().cast("array<struct<start:int,end:int,text:string,left:string,right:string>>")

    def step(state, m):
        start = state["at"] + F.length(m["gap"])
        end = start + F.length(m["text"])
        placed = F.struct(
            start.alias("start"), end.alias("end"), m["text"].alias("text"),
            F.right(m["gap"], F.lit(CONTEXT_CHARS)).alias("left"), F.left(m["next"], F.lit(1)).alias("right"),
        )
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(placed)).alias("out"))

    return F.aggregate(run, F.struct(begin.alias("at"), nothing.alias("out")), step, lambda s: s["out"])


def matches(text: Column, pattern: str) -> Column:
    """Leftmost matches that do not overlap: start, end (code points), text, and what stands around.

    Places are sums of the lengths of all matches and gaps before, first by runs and then within
    each run, so that the work grows little faster than the matches.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    parts = F.zip_with(
        F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("text"), g.alias("gap"))),
        F.slice(gaps, 2, F.greatest(F.size(gaps), F.lit(1))),
        lambda m, g: F.struct(m["text"].alias("text"), m["gap"].alias("gap"), g.alias("next")),
    )
    parts = F.filter(parts, lambda m: m["text"].isNotNull())

    def run_lengths(parts):
        runs = F.transform(
            F.sequence(F.lit(0), ((F.size(parts) - 1) / RUN).cast("int")), lambda k: F.slice(parts, k * RUN + 1, F.lit(RUN))
        )

        def add(total, m):
            return total + F.length(m["gap"]) + F.length(m["text"])

        sums = F.transform(runs, lambda r: F.aggregate(r, F.lit(0), add))
        begins = F.aggregate(
            sums, F.array(F.lit(0)), lambda out, s: F.concat(out, F.array(F.element_at(out, -1) + s))
        )
        return F.zip_with(runs, F.slice(begins, F.lit(1), F.size(runs)), lambda r, b: F.struct(r.alias("run"), b.alias("at")))

    # An array of one, so that the matches are found once and named in the expression above it.
    placed = F.transform(
        F.array(parts), lambda p: F.flatten(F.transform(run_lengths(p), lambda r: _place(r["run"], r["at"])))
    )
    return F.element_at(placed, 1)


def _none() -> Column:
    return F.array().cast("array<struct<start:int,end:int,text:string,left:string,right:string>>")


def _searched(text: Column, pattern: str, needed: Column) -> Column:
    return F.when(needed & F.rlike(text, F.lit(pattern)), matches(text, pattern)).otherwise(_none())


def base_spans(kind: str, text: Column) -> Column:
    needed = F.contains(text, F.lit(NEEDED[kind])) if NEEDED[kind] else F.lit(True)
    return F.filter(_searched(text, BASE[kind], needed), lambda m: valid(kind, m["text"]))


def _char_class(char: Column) -> Column:
    return (
        F.when(F.coalesce(F.rlike(char, F.lit(r"^\s?$")), F.lit(True)), 0)
        .when(F.rlike(char, F.lit("[A-Za-z]")), 1)
        .when(F.rlike(char, F.lit("[0-9]")), 2)
        .otherwise(3)
    )


def _level(value: Column, *bounds: int) -> Column:
    return reduce(lambda total, b: total + (value >= b).cast("int"), bounds, F.lit(0))


#: The features of a candidate and how many levels each has: the table of their counts has at most
#: the product of these rows per kind, fold and label, whatever the input.
FEATURES = {"digits": 5, "signs": 4, "before": 4, "after": 4, "context": 2, "regular": 2, "chars": 4}


def _features(kind: str, m: Column) -> dict[str, Column]:
    """Format and context. A kind that is known by the words before it has no feature of them, so that
    the trees have to tell it by the rest."""
    text = m["text"]
    return {
        "digits": _level(F.length(_digits(text)), 8, 13, 16, 20),
        "signs": _level(F.length(F.regexp_replace(text, "[A-Za-z0-9]", "")), 1, 3, 5),
        "before": _char_class(F.right(m["left"], F.lit(1))),
        "after": _char_class(m["right"]),
        "context": _announced(kind, m["left"]).cast("int") if kind in CHANCE else F.lit(0),
        "regular": F.rlike(text, F.lit(_REGULAR[kind])).cast("int"),
        "chars": _level(F.length(text), 12, 20, 30),
    }


def evidence(kind: str, m: Column) -> Column:
    """What speaks for a candidate beside its features: right check digit, parts in range, or announced."""
    text = m["text"]
    if kind == "card":
        digits = _digits(text)
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "ip":
        plain = F.regexp_replace(text, "[^0-9]+", ".")
        return F.when(F.contains(text, F.lit(":")), F.rlike(text, F.lit("[0-9A-Fa-f]{3}"))).otherwise(valid("ip", plain))
    return _announced(kind, m["left"])


def _is_base(kind: str, text: Column) -> Column:
    """Whether the base format stands in a candidate's own text."""
    if kind not in BASE_KINDS:
        return F.lit(False)
    found = F.regexp_extract_all(text, F.lit(BASE[kind]), F.lit(0))
    return F.exists(found, lambda b: valid(kind, b))


def candidates(kind: str, text: Column) -> Column:
    """Loose matches with their features and evidence, and whether each is a base span."""
    return F.transform(
        _searched(text, LOOSE[kind], F.lit(True)),
        lambda m: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), _is_base(kind, m["text"]).alias("base"),
            evidence(kind, m).alias("true"), *[v.cast("int").alias(name) for name, v in _features(kind, m).items()],
        ),
    )


class Tree(NamedTuple):
    """Two levels: a split, a split on each side, and the four leaves' values. A value goes right if
    it is above the bound."""

    splits: tuple
    leaves: tuple


def _best_split(rows, features):
    """The split (feature, bound) that lowers the loss most, by the gain of second-order boosting."""

    def gain(part):
        g, h = sum(r[1] for r in part), sum(r[2] for r in part)
        return g * g / (h + 1.0)

    best, most = (features[0], 0), -1.0
    for name in features:
        for bound in range(FEATURES[name] - 1):
            left = [r for r in rows if r[0][name] <= bound]
            value = gain(left) + gain([r for r in rows if r[0][name] > bound])
            if value > most + 1e-12:
                best, most = (name, bound), value
    return best


def _leaf(rows) -> float:
    return RATE * sum(r[1] for r in rows) / (sum(r[2] for r in rows) + 1.0)


def _sides(rows, split):
    return [r for r in rows if r[0][split[0]] <= split[1]], [r for r in rows if r[0][split[0]] > split[1]]


def score(trees: list[Tree], row: dict) -> float:
    total = 0.0
    for tree in trees:
        side = int(row[tree.splits[0][0]] > tree.splits[0][1])
        name, bound = tree.splits[1 + side]
        total += tree.leaves[2 * side + int(row[name] > bound)]
    return total


def boosted(table: list[tuple[dict, int, int]]) -> list[Tree]:
    """Logistic boosting over counted feature rows: (features, with evidence, without)."""
    trees: list[Tree] = []
    features = list(FEATURES)
    scores = [0.0] * len(table)
    for _ in range(TREES if table else 0):
        rows = []
        for (row, yes, no), s in zip(table, scores):
            p = 1 / (1 + math.exp(-s))
            rows.append((row, yes - (yes + no) * p, (yes + no) * p * (1 - p)))
        top = _best_split(rows, features)
        sides = _sides(rows, top)
        splits = [_best_split(side, features) if side else top for side in sides]
        leaves = [_leaf(part) for side, split in zip(sides, splits) for part in _sides(side, split)]
        trees.append(Tree((top, *splits), tuple(leaves)))
        scores = [s + score(trees[-1:], row) for s, (row, _, _) in zip(scores, table)]
    return trees


def calibrated(trees: list[Tree], table: list[tuple[dict, int, int]]) -> float | None:
    """The least score, above even odds, from which on held-out candidates reach the precision; or None."""
    by_score = sorted(((score(trees, row), yes, no) for row, yes, no in table), key=lambda x: -x[0])
    limit, good, bad = None, 0, 0
    for k, (s, yes, no) in enumerate(by_score):
        good, bad = good + yes, bad + no
        last = k + 1 == len(by_score) or by_score[k + 1][0] < s
        if s > 0 and last and good >= PRECISION * (good + bad + DOUBT):
            limit = s
    return limit


def _by_chance(table: list[tuple[dict, int, int]], chance: float) -> list[tuple[dict, float, float]]:
    """Of the candidates that pass a check, how many are true and how many pass by chance: so many as
    the number of those that fail lets expect."""
    lucky = [min(yes, no * chance / (1 - chance)) for _, yes, no in table]
    return [(row, yes - n, n) for (row, yes, _), n in zip(table, lucky)]


def _score(trees: list[Tree], candidate: Column) -> Column:
    def right(split):
        return candidate[split[0]] > split[1]

    def value(tree):
        low = F.when(right(tree.splits[1]), tree.leaves[1]).otherwise(tree.leaves[0])
        high = F.when(right(tree.splits[2]), tree.leaves[3]).otherwise(tree.leaves[2])
        return F.when(right(tree.splits[0]), high).otherwise(low)

    return reduce(lambda a, b: a + b, map(value, trees))


def fit(docs: DataFrame) -> dict[str, tuple[list[Tree], float]]:
    """Trees and threshold of each kind that has any, from the candidates of all documents.

    Half of the texts, by a hash, give the counts that trees are fitted on, the others those that
    set the threshold; a kind with a check takes there only candidates that are no base spans, as
    only these can be added. Only counts of feature values leave the executors.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    tagged = F.concat(
        *[F.transform(candidates(kind, F.col("t")), lambda c: F.struct(F.lit(k).alias("kind"), *[c[n].alias(n) for n in ("base", "true", *FEATURES)]))
          for k, kind in enumerate(KINDS)]
    )
    counted = (
        docs.select(text.alias("t"))
        .where(F.rlike("t", F.lit("[0-9@]|[\\[({<]at[\\])}>]")))
        .select((F.xxhash64("t") % 2 == 0).alias("fitted"), F.explode(tagged).alias("c"))
        .groupBy("fitted", "c.kind", *[f"c.{n}" for n in FEATURES])
        .agg(
            F.count_if("c.true").alias("yes"), F.count_if(~F.col("c.true")).alias("no"),
            F.count_if(F.expr("c.true AND NOT c.base")).alias("new_yes"),
            F.count_if(F.expr("NOT c.true AND NOT c.base")).alias("new_no"),
        )
        .collect()
    )
    models = {}
    for k, kind in enumerate(KINDS):
        new = "new_" if kind in CHANCE else ""
        folds = [
            sorted(
                (({n: r[n] for n in FEATURES}, r[f"{of}yes"], r[f"{of}no"]) for r in counted if r.kind == k and r.fitted == fold),
                key=lambda x: tuple(x[0].values()),
            )
            for fold, of in ((True, ""), (False, new))
        ]
        trees = boosted(folds[0])
        held_out = _by_chance(folds[1], CHANCE[kind]) if kind in CHANCE else folds[1]
        limit = calibrated(trees, held_out) if trees else None
        if limit is not None:
            models[kind] = (trees, limit)
    return models


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def find_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with base and spans: arrays of structs (kind, start, end), by kind and start.

    Base spans are the leftmost matches of each kind's format that are valid: an IP address has
    parts up to 255, a card number 16 to 19 digits and a right check digit, a phone number 8 to 15
    digits. Looser patterns propose more candidates, among them runs of letters and digits that may be
    secrets. Boosted trees score their format and context, taking as examples those that evidence
    speaks for which is no feature (``evidence``). Those above the calibrated threshold of their kind, and
    with a right check where their kind has one, join the spans unless they overlap a base span or a
    better candidate. Offsets count code points, ends are exclusive.

    Null or empty text: no spans. Other columns are kept, whatever they hold; ``base`` and ``spans``
    of the input are replaced. Equal rows get equal spans. An empty table gives an empty table.
    """
    models = fit(docs)
    given = [F.col(f"`{c}`") for c in docs.columns if c not in ("base", "spans")]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    span = "array<struct<kind:int,start:int,end:int>>"
    base = F.concat(
        *[F.transform(base_spans(kind, text), lambda m: F.struct(F.lit(k).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
          for k, kind in enumerate(BASE_KINDS)]
    ).cast(span)
    scored = F.array().cast("array<struct<score:double,kind:int,start:int,end:int>>")
    for kind, (trees, limit) in models.items():
        own = F.transform(
            F.filter(candidates(kind, text), lambda c: ~c["base"] & (c["true"] if kind in CHANCE else F.lit(True))),
            lambda c: F.struct(
                _score(trees, c).alias("score"), F.lit(KINDS.index(kind)).alias("kind"), c["start"].alias("start"), c["end"].alias("end")
            ),
        )
        scored = F.concat(scored, F.filter(own, lambda c: c["score"] >= limit))
    found = docs.select(*given, base.alias("base"), scored.alias("_scored"))
    free = F.filter("_scored", lambda c: ~F.exists("base", lambda b: _overlaps(c, b)))
    found = found.withColumn("_scored", free)
    best = F.filter(
        "_scored",
        lambda c: ~F.exists(
            "_scored",
            lambda o: _overlaps(c, o) & ((o["score"] > c["score"]) | ((o["score"] == c["score"]) & (o["kind"] < c["kind"]))),
        ),
    )
    added = F.transform(best, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    return found.withColumn("spans", F.array_sort(F.concat("base", added))).drop("_scored")


def written(spans: str) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
