"""Relevance search over a text index, for tables of requests."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.functions.text import inverse_document_frequency, saturation, tokens
from shelfwise.operators.cells import BestK, Grid, best_pairs, plan_grid
from shelfwise.operators.recs import ANSWER_ITEMS
from shelfwise.operators.text_index import TextIndex, heavy_terms, join_by_term
from shelfwise.session import parallelism, staged
from shelfwise.sources.tables import of_keys

# The usual BM25 settings, and how a source document is turned into a query.
K1, B = 1.2, 0.75
MAX_QUERY_TERMS, MIN_TERM_FREQ, MIN_DOC_FREQ, MIN_SHOULD_MATCH = 25, 2, 5, 0.3

# Largest number of requests in one block and of the terms they ask for: every posting goes to each block,
# so blocks are as large as a task's memory allows, about half a gigabyte.
MAX_REQUESTS = 131_072
MAX_TERMS = 4_000_000
# Asked (block, term) pairs up to which they are sent to the postings, which then stay where they are.
FEW_ROUTES = 100_000
# Postings taken up in one step, their matches with requests held at once, and scores held at once: small
# enough that the working arrays stay in the processor's cache.
MATCHES_IN_MEMORY = 2_000_000
POSTINGS_PER_STEP = 100_000

# Bounds first look up the rarest terms of a request, with up to this share of all its postings.
RARE_SHARE = 0.1
SCORES_IN_MEMORY = 300_000


def text_terms(requests: DataFrame, key: str = "key") -> DataFrame:
    """Distinct terms of each request text, by its unique key; any one of them makes a hit."""
    words = F.array_distinct(tokens(F.col("text")))
    return requests.select(F.col(key).alias("id"), F.lit(1).alias("need"), F.explode(words).alias("term"))


def source_terms(
    index: TextIndex, requests: DataFrame | None = None, key: str = "productId",
    field: str = "features", max_query_terms: int = MAX_QUERY_TERMS,
    min_term_freq: int = MIN_TERM_FREQ, min_doc_freq: int = MIN_DOC_FREQ,
    min_should_match: float = MIN_SHOULD_MATCH,
) -> DataFrame:
    """The terms that mark each source document: the top ones by tf·idf.

    Without ``requests`` every document of the index is a source. ``need`` is the number of terms
    a hit has to share.
    """
    source = index.forward
    if requests is not None:
        wanted = requests.select(F.col(key).alias("id")).distinct()
        source = of_keys(source, wanted).join(wanted, "id", "left_semi")
    source = source.where((F.col("field") == field) & (F.col("tf") >= min_term_freq))
    heavy = heavy_terms(index, parallelism(index.postings.sparkSession))
    known = index.terms.where((F.col("field") == field) & (F.col("df") >= min_doc_freq))
    n_docs = F.broadcast(index.stats.select("field", "n_docs"))
    weighted = join_by_term(source, known, heavy).join(n_docs, "field").select(
        "id", "term",
        F.round(F.col("tf") * inverse_document_frequency(F.col("n_docs"), F.col("df")), 6).alias("w"),
    )
    order = Window.partitionBy("id").orderBy(F.desc("w"), "term")
    selected = weighted.withColumn("n", F.row_number().over(order)).where(
        F.col("n") <= max_query_terms
    )
    size = F.count("*").over(Window.partitionBy("id"))
    need = F.greatest(F.lit(1), F.floor(size * min_should_match)).cast("int")
    return selected.select("id", need.alias("need"), "term")


def leading_terms(
    index: TextIndex, request_terms: DataFrame, fields: list[str], floor: DataFrame | None = None,
    k1: float = K1, b: float = B,
) -> DataFrame:
    """``request_terms`` with ``df`` and ``leads``: every answer of a request has a leading term of it.

    A hit shares ``need`` terms, so all but the ``need`` - 1 most frequent ones can lead alone. With
    ``floor(id, floor)``, a score that each answer reaches, the terms whose largest weights together
    stay below it need not lead either. Per request the rule that leaves more postings aside holds.
    """
    stats = F.broadcast(index.stats.select("field", "n_docs", "avgdl"))
    most = inverse_document_frequency(F.col("n_docs"), F.col("df")) * saturation(
        F.col("max_tf"), F.col("min_dl"), F.col("avgdl"), k1, b
    )
    known = of_keys(index.terms, request_terms.select("term")).where(F.col("field").isin(fields))
    known = known.join(stats, "field").groupBy("term").agg(F.sum("df").alias("df"), F.max(most).alias("most"))
    found = request_terms.join(known, "term", "left").fillna(0, ["df", "most"])
    whole = Window.partitionBy("id")
    rank = F.row_number().over(whole.orderBy("df", "term"))
    frequent = rank > F.count("*").over(whole) - F.col("need") + 1
    if floor is None:
        weak = F.lit(False)
        found = found.withColumn("floor", F.lit(None).cast("double"))
    else:
        found = found.join(floor, "id", "left")
        together = F.sum("most").over(whole.orderBy("most", "term").rowsBetween(Window.unboundedPreceding, 0))
        weak = F.coalesce(together < F.col("floor"), F.lit(False))
    found = found.withColumn("frequent", frequent).withColumn("weak", weak)
    saved = [F.sum(F.when(F.col(c), F.col("df")).otherwise(0)).over(whole) for c in ("weak", "frequent")]
    aside = F.when(saved[0] > saved[1], F.col("weak")).otherwise(F.col("frequent"))
    return found.withColumn("leads", ~aside).select(*request_terms.columns, "df", "leads")


def _floor(index, request_terms, fields, n, digits, **how):
    """``floor(id, floor)``: the n-th score by each request's rarest terms alone, which its n-th score
    by all of them reaches, less what rounding may hide. Requests with fewer hits have none."""
    by_df = leading_terms(index, request_terms, fields)
    whole = Window.partitionBy("id")
    upto = F.sum("df").over(whole.orderBy("df", "term").rowsBetween(Window.unboundedPreceding, 0))
    rare = by_df.withColumn("rare", upto <= RARE_SHARE * F.sum("df").over(whole)).where("rare")
    found = relevant(index, rare.select(*request_terms.columns), fields, n, digits=None, **how)
    floors = found.groupBy("id").agg(F.count("*").alias("hits"), F.min("r").alias("floor")).where(F.col("hits") == n)
    slack = 10.0 ** -digits if digits is not None else 0.0
    return staged(floors.select("id", (F.col("floor") * (1 - 1e-9) - slack).alias("floor")), "floors")


def bounded_relevant(
    index: TextIndex, request_terms: DataFrame, fields: list[str], n: int = ANSWER_ITEMS,
    skip_self: bool = False, digits: int | None = None, k1: float = K1, b: float = B, grid: Grid | None = None,
) -> DataFrame:
    """The answers of ``relevant``, by way of the documents that can be among them.

    The rarest terms alone give each request a score that its answers reach. The postings of the terms
    that must lead by it propose documents; of the others, the most frequent ones, only the
    postings of proposed documents travel.
    """
    request_terms = staged(request_terms, "request-terms")
    how = dict(skip_self=skip_self, k1=k1, b=b)
    floor = _floor(index, request_terms, fields, n, digits, **how)
    led = staged(leading_terms(index, request_terms, fields, floor, k1, b), "leading")
    return relevant(index, led, fields, n, digits=digits, grid=grid, **how)


def relevant(
    index: TextIndex, request_terms: DataFrame, fields: list[str], n: int = ANSWER_ITEMS,
    skip_self: bool = False, digits: int | None = None, k1: float = K1, b: float = B,
    grid: Grid | None = None,
) -> DataFrame:
    """Top documents per request by BM25: ``id`` (request), ``pid`` (document), ``r``.

    With several fields the best field's score counts. Each posting is sent only to the request
    blocks that hold its term, with its finished weight, and a block adds up its own documents:
    (request, document) pairs are never rows. Terms travel as numbers, which the distinct terms of all
    requests get first. Where ``request_terms`` says which terms lead (``leading_terms``), a block takes
    postings of other terms only for documents that a leading term of one of its requests proposes.
    """
    spark = index.postings.sparkSession
    width = parallelism(spark)
    request_terms = staged(request_terms, "request-terms")
    grid = grid or _grid(index, request_terms, fields, n, width)

    block = F.pmod(F.xxhash64("id"), F.lit(grid.blocks)).cast("int")
    strip = F.pmod(F.xxhash64("id"), F.lit(grid.strips)).cast("int")
    words = request_terms.select("term").distinct().withColumn("word", F.monotonically_increasing_id())
    words = staged(words, "words")  # written, so that the numbers stay
    asked = request_terms.withColumn("block", block).join(words, "term")
    cell = (F.col("block") * grid.strips + F.col("strip")).cast("int").alias("cell")

    left = asked.withColumn("strip", F.explode(F.sequence(F.lit(0), F.lit(grid.strips - 1)))).select(
        cell, F.col("id").cast("long"), F.lit(0).alias("part"), "word",
        F.col("need").cast("double").alias("weight"),
    )
    part = F.array_position(F.array(*map(F.lit, fields)), F.col("field")).cast("int") - 1
    terms, postings = (
        of_keys(t, words.select("term")).where(F.col("field").isin(fields)) for t in (index.terms, index.postings)
    )
    stats = F.broadcast(index.stats.select("field", "n_docs", "avgdl"))
    leads = F.max("leads").alias("leads") if "leads" in request_terms.columns else F.lit(True).alias("leads")
    routes = (
        asked.groupBy("block", "term", "word").agg(leads)
        .join(terms, "term")
        .join(stats, "field")
        .select(
            "field", "term", "word", "block", "avgdl", "leads",
            inverse_document_frequency(F.col("n_docs"), F.col("df")).alias("idf"),
        )
    )
    weight = F.col("idf") * saturation(F.col("tf"), F.col("dl"), F.col("avgdl"), k1, b)
    if request_terms.count() <= FEW_ROUTES:  # each is one (block, term) pair at most

        def route(postings, routes):
            return postings.join(F.broadcast(routes), ["field", "term"])
    else:
        heavy = heavy_terms(index, width)

        def route(postings, routes):
            return join_by_term(postings, routes, heavy)

    routed = route(postings, routes.where("leads"))
    if "leads" in request_terms.columns:
        routed = staged(routed.select("block", "id", "field", "word", weight.alias("weight")), "proposing")
        weight = F.col("weight")
        proposed = routed.select("block", "id").distinct()
        others = route(postings, routes.where("NOT leads")).join(proposed, ["block", "id"], "left_semi")
        others = others.select("block", "id", "field", "word", (
            F.col("idf") * saturation(F.col("tf"), F.col("dl"), F.col("avgdl"), k1, b)
        ).alias("weight"))
        routed = routed.unionByName(others)
    right = (
        routed
        .withColumn("strip", strip)
        .select(
            cell, F.col("id").cast("long"), part.alias("part"), "word", weight.alias("weight"),
        )
    )
    n_fields = len(fields)

    def open_cell(table: pa.Table):
        ids, row = np.unique(table.column("id").to_numpy(), return_inverse=True)
        need = np.ones(ids.size)
        need[row] = table.column("weight").to_numpy()
        words = table.column("word").to_numpy()
        by_word = np.argsort(words, kind="stable")
        askers = row[by_word].astype(np.int64)
        vocabulary, first = np.unique(words[by_word], return_index=True)
        count = np.diff(np.append(first, words.size))
        width = max(1, SCORES_IN_MEMORY // (ids.size * n_fields))

        def offer(best: BestK, postings: pa.Table):
            doc_ids, doc = np.unique(postings.column("id").to_numpy(), return_inverse=True)
            term = np.searchsorted(vocabulary, postings.column("word").to_numpy())
            part, weight = (postings.column(c).to_numpy() for c in ("part", "weight"))
            bounds = np.searchsorted(doc, np.arange(doc_ids.size + 1))
            matches = np.concatenate(([0], np.cumsum(count[term])))[bounds]
            at = end = 0
            while end < doc_ids.size:
                at = end
                fitting = np.searchsorted(matches, matches[at] + MATCHES_IN_MEMORY, side="right") - 1
                end = max(at + 1, min(at + width, int(fitting)))
                some, lo, hi = doc_ids[at:end], bounds[at], bounds[end]
                n = count[term[lo:hi]]
                # Every posting once per request that asks for its term.
                start = first[term[lo:hi]] - (np.cumsum(n) - n)
                spot = askers[np.arange(n.sum()) + np.repeat(start, n)] * some.size
                place = part[lo:hi] * (ids.size * some.size) + doc[lo:hi] - at
                spot += np.repeat(place, n)
                shape = (n_fields, ids.size, some.size)
                size = n_fields * ids.size * some.size
                scores = np.bincount(spot, np.repeat(weight[lo:hi], n), size).reshape(shape)
                if need.max() > 1:
                    scores[np.bincount(spot, minlength=size).reshape(shape) < need[:, None]] = 0
                scores = scores.max(axis=0)
                if skip_self:
                    own = np.flatnonzero(np.isin(some, ids))
                    scores[np.searchsorted(ids, some[own]), own] = 0
                counts = scores > 0
                if digits is not None:
                    scores = np.round(scores, digits)
                best.offer(np.where(counts, scores, -np.inf), some)

        return ids, offer

    order = ["id", "part", "word"]
    found = best_pairs(left, right, grid, n, open_cell, order, POSTINGS_PER_STEP)
    id_type = request_terms.schema["id"].dataType
    doc_type = index.postings.schema["id"].dataType
    return found.select(F.col("id").cast(id_type), F.col("pid").cast(doc_type), "r")


def _grid(index, request_terms, fields, n, width):
    """Cells by the pairs to rank and the postings to read."""
    n_requests, n_terms = request_terms.agg(F.count_distinct("id"), F.count("*")).first()
    n_docs, n_postings = (
        index.stats.where(F.col("field").isin(fields)).agg(F.max("n_docs"), F.sum("n_postings")).first()
    )
    n_docs, n_postings = n_docs or 1, n_postings or 1
    return plan_grid(
        n_requests, n_docs, 40 * n_terms / max(n_requests, 1), 40 * n_postings / n_docs, n, width,
        work=4 * n_requests * n_docs + 50 * n_postings,
        max_block=max(1, min(MAX_REQUESTS, int(MAX_TERMS * n_requests / max(n_terms, 1)))),
    )


def ranked(pairs: DataFrame, key: str) -> DataFrame:
    """``id, pid, r`` rows as answer rows ``key, rank, productId, rating``."""
    order = Window.partitionBy("id").orderBy(F.desc("r"), "pid")
    return pairs.select(
        F.col("id").alias(key),
        F.row_number().over(order).alias("rank"),
        F.col("pid").alias("productId"),
        F.col("r").alias("rating"),
    )
