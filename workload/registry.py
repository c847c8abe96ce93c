"""The registered queries: name to a function of (session, folder of tables)."""

from pyspark.sql import DataFrame, Window, functions as F

from shelfwise import schemas
from shelfwise.functions.ids import string_id
from shelfwise.functions.text import tokens
from shelfwise.functions.vectors import cosine, dot
from shelfwise.operators import normalize, ratings as model, recs
from shelfwise.operators.bounded import bounded_cosine, bounded_dot
from shelfwise.operators.nearest import topk_cosine, topk_dot
from shelfwise.operators.search import source_terms
from shelfwise.operators.text_index import build_index, term_statistics, with_delta, write_index_delta
from shelfwise.plans import load, recommend, serve, train
from shelfwise.session import scratch_path, staged
from shelfwise.sources import raw, requests, tables
from shelfwise.sources.versions import current, publishing
from workload import inputs

K = recs.STORED_ITEMS
DIGITS = 6
SHORT = 7


def _day(column="date"):
    return F.col(column).cast("date").cast("string").alias(column)


def _flat(spark, folder):
    return load.normalized(inputs.raw_documents(spark, folder))


def _stored(spark, folder):
    path = scratch_path(spark, "tables")
    load.write_tables(inputs.raw_documents(spark, folder), path)
    return load.read_tables(spark, path)


# Load stage


def raw_json_roundtrip(spark, folder):
    path = scratch_path(spark, "raw")
    inputs.raw_documents(spark, folder).write.option("zlib.compress.level", "BEST_SPEED").json(path, compression="gzip")
    return (
        raw.read_raw(spark, path)
        .groupBy(F.col("ProductInfo.ProductID").alias("ext_id"))
        .agg(
            F.count("*").alias("documents"),
            F.sum(F.coalesce(F.size("Reviews"), F.lit(0))).alias("reviews"),
        )
    )


def _compacted(spark, folder):
    source, target = scratch_path(spark, "small"), scratch_path(spark, "compact")
    documents = inputs.raw_documents(spark, folder)
    category = F.regexp_extract("ProductInfo.Features", r"(\S+)$", 1)
    documents.withColumn("category", category).write.partitionBy("category").json(source, compression="gzip")
    raw.compact_small_files(spark, source, target)
    return target


def compact_small_files(spark, folder):
    name = F.regexp_extract("category", r"=(.*)\.json$", 1)
    return spark.read.text(_compacted(spark, folder)).groupBy(name.alias("category")).agg(
        F.count("*").alias("lines")
    )


def compact_then_load(spark, folder):
    """The loaded tables of compacted files, summed up per product."""
    return _per_product(raw.read_raw(spark, _compacted(spark, folder)))


def products_flat(spark, folder):
    return _flat(spark, folder).products


def users_distinct(spark, folder):
    return _flat(spark, folder).users


def reviews_distinct(spark, folder):
    return _flat(spark, folder).reviews.withColumn("date", _day())


def dirty_reviews(spark, folder):
    flat = load.normalized(inputs.dirty_documents(spark, folder))
    return flat.reviews.withColumn("date", _day())


def accounted_drops(spark, folder):
    """What a load of spoilt documents drops, by cause."""
    drops = load.write_tables(inputs.dirty_documents(spark, folder), scratch_path(spark, "tables"))
    return spark.createDataFrame(list(drops.items()), "cause string, n long")


def dirty_products_users(spark, folder):
    flat = load.normalized(inputs.dirty_documents(spark, folder))
    kept = flat.products.select(F.lit("product").alias("kind"), "id", "extId")
    return kept.unionByName(flat.users.select(F.lit("user").alias("kind"), "id", "extId"))


def _names(spark, folder):
    customers = inputs.table(spark, folder, "customer").select(F.col("c_name").alias("extId"))
    parts = inputs.table(spark, folder, "part")
    return customers.unionByName(parts.select(F.concat(F.lit("P"), "p_partkey").alias("extId")))


def hash_ids(spark, folder):
    return _names(spark, folder).select(string_id(F.col("extId")).alias("id"), "extId")


def hash_texts(spark, folder):
    texts = inputs.table(spark, folder, "documents")
    return texts.select("doc_id", string_id(F.col("text")).alias("id"))


def hash_collisions(spark, folder):
    texts = inputs.table(spark, folder, "documents")
    words = texts.select(F.explode(tokens(F.col("text"))).alias("extId"))
    return normalize.id_collisions(_names(spark, folder).unionByName(words))


def _per_product(documents):
    spark = documents.sparkSession
    path = scratch_path(spark, "tables")
    load.load(documents, path)
    return _stored_per_product(spark, path)


def _stored_per_product(spark, path):
    stored = load.read_tables(spark, path)
    per_product = stored.reviews.groupBy(F.col("productId").alias("id")).agg(
        F.count("*").alias("reviews"),
        F.countDistinct("userId").alias("authors"),
        F.count("overall").alias("rated"),
        F.sum("overall").alias("stars"),
        F.date_format(F.max("date"), "yyyy-MM-dd").alias("last_date"),
    )
    documents = stored.products.groupBy("id", "extId", "price").agg(F.count("*").alias("documents"))
    return documents.join(per_product, "id")


def table_roundtrip(spark, folder):
    return _per_product(inputs.raw_documents(spark, folder))


def incremental_load(spark, folder):
    """The tables after a load and two additions."""
    path = scratch_path(spark, "tables")
    documents = staged(inputs.raw_documents(spark, folder), "raw")
    turn = F.pmod(F.xxhash64(F.col("Reviews").cast("string"), F.col("ProductInfo.ProductID")), F.lit(3))
    load.load(documents.where(turn == 0), path)
    load.add(documents.where(turn == 1), path)
    load.add(documents.where(turn == 2), path)
    return _stored_per_product(spark, path)


def incremental_index(spark, folder):
    """Terms of an index in which a delta has replaced some documents and added others."""
    catalog, path = inputs.catalog(spark, folder), scratch_path(spark, "delta")
    old = catalog.where("id % 3 < 2").withColumn(
        "features", F.when(F.col("id") % 3 == 1, F.concat_ws(" ", F.substring("features", 1, 200), "name"))
        .otherwise(F.col("features")),
    )
    base = build_index(old)
    write_index_delta(base, catalog.where("id % 3 > 0"), path)
    index = with_delta(base, spark, path)
    counted = term_statistics(index.postings).select("field", "term", F.col("df").alias("counted"))
    return (
        index.terms.join(counted, ["field", "term"]).where("df = counted").select("field", "term", "df", "occurrences")
    )


def ratings_triples(spark, folder):
    return model.build_ratings(_flat(spark, folder).reviews)


def distinct_ids(spark, folder):
    flat = _flat(spark, folder)
    ids = [
        model.distinct_ids(t).select(F.lit(kind).alias("kind"), "id")
        for kind, t in (("user", flat.users), ("product", flat.products))
    ]
    return ids[0].unionByName(ids[1])


# Text index


def _index(spark, folder):
    return build_index(inputs.catalog(spark, folder))


def text_index_terms(spark, folder):
    return _index(spark, folder).terms.select("field", "term", "df", "occurrences")


def text_index_postings(spark, folder):
    return _index(spark, folder).postings.drop(tables.BUCKET)


def text_index_documents(spark, folder):
    return _index(spark, folder).postings.groupBy("id", "field").agg(
        F.first("dl").alias("dl"), F.count("*").alias("terms"), F.max("tf").alias("max_tf")
    )


# Train stage


def als_factors(spark, folder):
    """Who has factors, how many, and whether all are numbers."""
    factors = train.fit_factors(_stored(spark, folder))
    sides = [t.withColumn("side", F.lit(s)) for s, t in (("user", factors.users), ("item", factors.items))]
    finite = F.forall("features", lambda x: F.abs(x) < float("inf"))
    return sides[0].unionByName(sides[1]).select(
        "side", "id", F.size("features").alias("rank"), finite.alias("finite")
    )


def als_predict(spark, folder):
    """Rated pairs, and each user with a product nobody knows: whether there is a prediction, and
    whether it is the dot product of the pair's factors."""
    triples = staged(model.build_ratings(_stored(spark, folder).reviews), "ratings")
    unknown = triples.select("user").distinct().withColumn("item", F.lit(-1))
    fitted = model.fit_als(triples)
    factors = train.stored_factors(fitted)
    u = factors.users.select(F.col("id").alias("user"), F.col("features").alias("a"))
    v = factors.items.select(F.col("id").alias("item"), F.col("features").alias("b"))
    # In the model's order, users first and then items, so that its joins and these share their shuffles.
    asked = triples.select("user", "item").unionByName(unknown).join(u, "user", "left")
    both = model.predict(fitted, asked).join(v, "item", "left")
    predicted = ~F.isnan("prediction")
    close = F.abs(F.col("prediction") - dot(F.col("a"), F.col("b"))) < 1e-4
    return both.select("user", "item", predicted.alias("predicted"), F.coalesce(close, ~predicted).alias("as_expected"))


def _list_checks(lists, left, right, score, k):
    """Per id whether the list has up to k entries, falls, and scores as ``score`` of the factors."""
    x = F.col("recs")
    falling = F.forall(F.zip_with(x, F.slice(x, 2, k), lambda a, b: b.isNull() | (a.r >= b.r)), lambda ok: ok)
    entries = lists.select("id", F.explode("recs").alias("x")).select("id", "x.pid", "x.r")
    a = left.select("id", F.col("features").alias("a"))
    b = right.select(F.col("id").alias("pid"), F.col("features").alias("b"))
    right_scores = entries.join(a, "id").join(b, "pid").groupBy("id").agg(
        F.count_if(F.abs(F.col("r") - score(F.col("a"), F.col("b"))) < 1e-4).alias("right")
    )
    return lists.join(right_scores, "id").select(
        "id", F.size(x).between(1, k).alias("bounded"), falling.alias("falling"),
        (F.col("right") == F.size(x)).alias("scored"),
    )


def als_user_recs(spark, folder):
    tables = _stored(spark, folder)
    factors = train.fit_factors(tables)
    lists = staged(train.user_recommendations(factors, tables.users, tables.products), "lists")
    return _list_checks(lists, factors.users, factors.items, dot, K)


def als_item_recs(spark, folder):
    factors = train.fit_factors(_stored(spark, folder))
    lists = staged(train.product_recommendations(factors), "lists")
    return _list_checks(lists, factors.items, factors.items, cosine, K)


def als_train(spark, folder):
    """Load and train over stored tables with short lists; per list its id, kind and length."""
    path = scratch_path(spark, "trained")
    load.load(inputs.raw_documents(spark, folder), path)
    train.train(spark, path, SHORT)
    stored = train.read_recommendations(spark, path)
    lists = [
        t.select(F.lit(kind).alias("kind"), "id", F.size("recs").alias("items"))
        for kind, t in (("user", stored.user_recs), ("product", stored.product_recs))
    ]
    return lists[0].unionByName(lists[1])


def als_recs_properties(spark, folder):
    """Counts that hold for any fit: who gets a list, and breaches of the list rules."""
    tables = _stored(spark, folder)
    factors = train.fit_factors(tables)
    kinds = {
        "user": train.user_recommendations(factors, tables.users, tables.products),
        "product": train.product_recommendations(factors),
    }
    x = F.col("recs")
    following = F.slice(x, 2, K)
    in_order = F.forall(
        F.zip_with(F.slice(x, 1, F.greatest(F.size(x) - 1, F.lit(0))), following, lambda a, b: a.r >= b.r),
        lambda ok: ok,
    )
    parts = [
        lists.agg(
            F.lit(kind).alias("kind"),
            F.count("*").alias("lists"),
            F.count_if(F.size(x) > K).alias("too_long"),
            F.count_if(~in_order).alias("out_of_order"),
            F.count_if(F.exists(x, lambda e: e.r <= 0)).alias("not_positive"),
            F.count_if(F.size(F.array_distinct(x.pid)) < F.size(x)).alias("repeated"),
            F.count_if((F.lit(kind) == "product") & F.array_contains(x.pid, F.col("id"))).alias("own"),
        )
        for kind, lists in kinds.items()
    ]
    return parts[0].unionByName(parts[1])


def _dot(spark, folder):
    items = inputs.vectors(spark, folder)
    return topk_dot(items, items, K, digits=DIGITS)


def dot_topk(spark, folder):
    return _dot(spark, folder)


def _cosine(spark, folder):
    return topk_cosine(inputs.vectors(spark, folder), K, digits=DIGITS)


def cosine_topk(spark, folder):
    return _cosine(spark, folder)


def bounded_dot_topk(spark, folder):
    """The same lists by the plan that skips what bounds rule out."""
    items = inputs.vectors(spark, folder)
    return bounded_dot(items, items, K, digits=DIGITS).pairs


def bounded_cosine_topk(spark, folder):
    return bounded_cosine(inputs.vectors(spark, folder), K, digits=DIGITS).pairs


def cosine_pair_formula(spark, folder):
    """The ten best pairs of each vector, scored again by the column expression."""
    items = inputs.vectors(spark, folder)
    pairs = topk_cosine(items, recs.ANSWER_ITEMS, digits=DIGITS).select("id", "pid")
    left = items.withColumnRenamed("features", "a")
    right = items.select(F.col("id").alias("pid"), F.col("features").alias("b"))
    scored = pairs.join(left, "id").join(right, "pid")
    return scored.select("id", "pid", F.round(cosine(F.col("a"), F.col("b")), DIGITS).alias("r"))


# Recommend stage


def cosine_recs_nested_topk(spark, folder):
    lists = recs.pack(_cosine(spark, folder))
    best = recs.best_of(F.col("recs"), recs.ANSWER_ITEMS)
    return lists.select("id", F.posexplode(best).alias("pos", "x")).select(
        "id", (F.col("pos") + 1).alias("rank"), F.col("x.pid").alias("pid"), F.col("x.r").alias("r")
    )


def product_cf_lookup(spark, folder):
    wanted = inputs.product_requests(spark, folder)
    return recommend.by_product(wanted, recs.pack(_cosine(spark, folder)))


def user_cf_lookup(spark, folder):
    wanted = inputs.user_requests(spark, folder)
    return recommend.by_user(wanted, recs.pack(_dot(spark, folder)))


def search_multi_field(spark, folder):
    wanted = inputs.text_requests(spark, folder)
    return recommend.by_text(wanted, _index(spark, folder), digits=DIGITS)


def bounded_search(spark, folder):
    wanted = inputs.text_requests(spark, folder)
    return recommend.by_text(wanted, _index(spark, folder), digits=DIGITS, bounded=True)


def more_like_this_terms(spark, folder):
    return source_terms(_index(spark, folder))


def more_like_this(spark, folder):
    wanted = inputs.document_requests(spark, folder)
    return recommend.similar_content(wanted, _index(spark, folder), digits=DIGITS)


def bounded_more_like_this(spark, folder):
    wanted = inputs.document_requests(spark, folder)
    return recommend.similar_content(wanted, _index(spark, folder), digits=DIGITS, bounded=True)


def _hybrid_inputs(spark, folder):
    return (
        inputs.document_requests(spark, folder),
        recs.pack(_cosine(spark, folder)),
        _index(spark, folder),
    )


def hybrid_scores(spark, folder):
    return recommend.hybrid_candidates(*_hybrid_inputs(spark, folder), digits=DIGITS)


def hybrid_topk(spark, folder):
    return recommend.hybrid(*_hybrid_inputs(spark, folder), digits=DIGITS)


def requests_json(spark, folder):
    """Product requests from files, answers to files and back; unknown ids give empty lists."""
    wanted, answers = scratch_path(spark, "requests"), scratch_path(spark, "answers")
    inputs.product_requests(spark, folder).write.json(wanted)
    asked = requests.read_requests(spark, wanted, "product")
    found = recommend.by_product(asked, recs.pack(_cosine(spark, folder)))
    keyed = asked.withColumnRenamed("productId", "requestId")
    nested = requests.nest_answers(keyed, found, "requestId", ["productId", "rating"])
    requests.write_answers(nested, answers)
    items = "array<struct<productId:int,rating:double>>"
    stored = spark.read.schema(f"requestId int, items {items}").json(answers)
    return stored.select(
        "requestId",
        F.size("items").alias("n_items"),
        F.get("items", F.lit(0))["productId"].alias("first_product"),
        F.get("items", F.lit(0))["rating"].alias("first_rating"),
    )


def hot_requests(spark, folder):
    """A request for each order line, half of them for one product: how often each answer is given."""
    wanted = F.when(F.col("l_orderkey") % 2 == 0, 7).otherwise(F.col("l_partkey")).alias("productId")
    asked = inputs.table(spark, folder, "lineitem").select(wanted)
    answers = recommend.by_product(asked, recs.pack(_cosine(spark, folder)))
    return answers.groupBy("requestId", "rank", "productId").agg(F.count("*").alias("n"))


def streamed_requests(spark, folder):
    """Request files in two drops, each answered by a run of its own that goes on where the last ended."""
    wanted, answers, done = (scratch_path(spark, name) for name in ("drops", "answered", "progress"))
    lists = staged(recs.pack(_cosine(spark, folder)), "lists")
    asked = inputs.product_requests(spark, folder)
    for drop in (0, 1):
        asked.where(F.col("productId") % 2 == drop).write.mode("append").json(wanted)
        serve.answer_files(
            spark, "product", wanted, answers, done, lambda q: recommend.by_product(q, lists), "requestId",
            ["productId", "rating"],
        )
    items = "array<struct<productId:bigint,rating:double>>"
    stored = spark.read.schema(f"productId int, file string, items {items}").json(f"{answers}/batch=*")
    return stored.groupBy("productId").agg(
        F.count("file").alias("answers"), F.max(F.size("items")).alias("n_items"),
        F.get(F.max("items"), F.lit(0))["productId"].cast("int").alias("first_product"),
        F.get(F.max("items"), F.lit(0))["rating"].alias("first_rating"),
    )


def interrupted_publish(spark, folder):
    """A reader's version stays while others are published, one of them cut off halfway."""
    path = scratch_path(spark, "published")
    names = inputs.catalog(spark, folder).select("id", "name")
    with publishing(spark, path) as version:
        tables.write_table(names, f"{version}/names", "id")
    reader = tables.read_table(spark, f"{current(spark, path)}/names")
    try:
        with publishing(spark, path) as version:
            tables.write_table(names.where("id % 2 = 0"), f"{version}/names", "id")
            raise InterruptedError
    except InterruptedError:
        kept = tables.read_table(spark, f"{current(spark, path)}/names")
    with publishing(spark, path) as version:
        tables.write_table(names.withColumn("name", F.concat("name", F.lit("!"))), f"{version}/names", "id")
    after = tables.read_table(spark, f"{current(spark, path)}/names")
    return (
        reader.withColumnRenamed("name", "before")
        .join(kept.withColumnRenamed("name", "kept"), "id")
        .join(after.withColumnRenamed("name", "after"), "id")
    )


def requests_text_json(spark, folder):
    """Text requests from files, answers to files and back, keyed by the text itself."""
    wanted, answers = scratch_path(spark, "requests"), scratch_path(spark, "answers")
    inputs.text_requests(spark, folder).select("text").write.json(wanted)
    asked = requests.read_requests(spark, wanted, "text")
    found = recommend.by_text(asked, _index(spark, folder), key="text", digits=DIGITS)
    nested = requests.nest_answers(asked, found, "text", ["productId", "rating"])
    requests.write_answers(nested, answers)
    items = "array<struct<productId:bigint,rating:double>>"
    stored = spark.read.schema(f"text string, items {items}").json(answers)
    return stored.select(
        "text",
        F.size("items").alias("n_items"),
        F.get("items", F.lit(0))["productId"].alias("first_product"),
        F.get("items", F.lit(0))["rating"].alias("first_rating"),
    )


def recommended_from_reviews(spark, folder):
    """From raw documents to answers: load, fit, stored lists, ten products per user."""
    tables = _stored(spark, folder)
    stored = train.user_recommendations(train.fit_factors(tables), tables.users, tables.products)
    return recommend.by_user(tables.users.select(F.col("id").alias("userId")), stored)


def user_cf_from_reviews(spark, folder):
    return recommended_from_reviews(spark, folder).select("userId", "rank")


def stored_answers(spark, folder):
    """Load, train, and ask for every product in three ways; per product how many answers come and
    whether they keep the rules of order, weights and candidates."""
    path = scratch_path(spark, "stored")
    load.load(inputs.raw_documents(spark, folder), path)
    train.train(spark, path, 2 * recs.ANSWER_ITEMS)
    lists = train.read_recommendations(spark, path).product_recs
    index = load.read_products_index(spark, path)
    asked = load.read_tables(spark, path).products.select(F.col("id").alias("productId")).distinct()
    terms = {"min_term_freq": 1, "min_doc_freq": 2}
    collaborative = recommend.by_product(asked, lists)
    content = recommend.similar_content(asked, index, **terms)
    blended = staged(recommend.hybrid(asked, lists, index, **terms), "blended")
    weight = F.round(F.col("hybridRating") / F.col("originalRating"), 6)
    order = Window.partitionBy("requestId").orderBy("rank")
    ruled = blended.select(
        "requestId", weight.isin(recs.CF_WEIGHT, round(1 - recs.CF_WEIGHT, 6)).alias("weighed"),
        (F.col("hybridRating") <= F.coalesce(F.lag("hybridRating").over(order), "hybridRating")).alias("falls"),
    )
    counts = ruled.groupBy("requestId").agg(
        F.count("*").alias("answers"), F.bool_and("weighed").alias("weighed"), F.bool_and("falls").alias("falls")
    )
    candidates = collaborative.select("requestId").unionByName(content.select("requestId")).groupBy("requestId")
    return counts.join(candidates.agg(F.count("*").alias("candidates")), "requestId").select(
        "requestId", "weighed", "falls", F.col("candidates").between(1, 2 * recs.ANSWER_ITEMS).alias("bounded"),
        (F.col("answers") == F.least("candidates", F.lit(recs.ANSWER_ITEMS))).alias("complete"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        raw_json_roundtrip, compact_small_files, compact_then_load, products_flat, users_distinct, reviews_distinct,
        dirty_reviews, dirty_products_users, accounted_drops, hash_ids, hash_texts, hash_collisions,
        table_roundtrip, incremental_load, incremental_index, ratings_triples, distinct_ids, text_index_terms, text_index_postings,
        text_index_documents, als_factors, als_predict, als_user_recs, als_item_recs, als_train,
        als_recs_properties, dot_topk, cosine_topk, bounded_dot_topk, bounded_cosine_topk, cosine_pair_formula, cosine_recs_nested_topk, product_cf_lookup,
        user_cf_lookup, search_multi_field, bounded_search, more_like_this_terms, more_like_this, bounded_more_like_this, hybrid_scores,
        hybrid_topk, requests_json, requests_text_json, hot_requests, streamed_requests, interrupted_publish,
        user_cf_from_reviews, stored_answers,
    )
}
