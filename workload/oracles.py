"""SQL for DuckDB over the same tables, one statement per query that SQL can express."""

from workload.inputs import ORDERS_PER_BATCH


def _id(x):
    units = (
        "CASE WHEN unicode(c) > 65535 THEN"
        " [55296 + (unicode(c) - 65536) // 1024, 56320 + (unicode(c) - 65536) % 1024]"
        " ELSE [unicode(c)] END"
    )
    return (
        f"list_reduce(list_prepend(0::bigint, flatten(list_transform(string_split({x}, ''),"
        f" lambda c: {units}))::bigint[]), lambda a, b: (a * 31 + b) % 268435456)::int"
    )


def _with(*parts):
    return "WITH " + ",\n".join(parts) + "\n"


LINES = f"""lines AS (
  SELECT *, l_orderkey // {ORDERS_PER_BATCH} AS batch
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""

DOCUMENTS = """docs AS (
  SELECT part.*, concat('P', p_partkey) AS ext_id, concat_ws(' ', p_name, p_brand, p_type) AS info,
         CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS price, coalesce(n, 0) AS n
  FROM part LEFT JOIN (SELECT l_partkey, batch, count(*) AS n FROM lines GROUP BY ALL)
       ON p_partkey = l_partkey)"""

_STARS = "CAST(floor((l_quantity - 1) / 10) + 1 AS DOUBLE)"
_REVIEW_ID = "concat('R', l_orderkey, '-', l_linenumber)"
_COLUMNS = f"""{_REVIEW_ID} AS "reviewId", {_id("c_name")} AS "userId",
         {_id("concat('P', l_partkey)")} AS "productId", concat(l_returnflag, l_linestatus) AS title"""
_CONTENT = "concat(l_returnflag, ' ', l_linestatus) AS content"

REVIEWS = f"""reviews AS (
  SELECT DISTINCT {_COLUMNS},
         CASE WHEN l_linenumber <> 7 THEN {_STARS} END AS overall, {_CONTENT},
         strftime(l_shipdate, '%Y-%m-%d') AS date
  FROM lines)"""

# What has to come out of the spoilt fields, written down by case.
DIRTY = f"""dirty AS (
  SELECT *, l_suppkey % 10 AS kind, l_quantity < 40 AS spoilt, l_orderkey % 3 = 0 AS far FROM lines JOIN part ON l_partkey = p_partkey),
accepted AS (
  SELECT * FROM dirty
  WHERE p_size NOT IN (7, 8) AND NOT (l_returnflag = 'N' AND l_quantity > 45)
    AND kind NOT IN (1, 7, 8) AND NOT (spoilt AND l_linenumber IN (2, 3, 6, 7))),
reviews AS (
  SELECT DISTINCT {_COLUMNS},
         CASE WHEN NOT spoilt THEN {_STARS} WHEN l_linenumber = 4 THEN 4 WHEN l_linenumber = 5 THEN 5 END
           AS overall, {_CONTENT},
         CASE WHEN kind = 0 THEN NULL
              WHEN kind = 5 THEN strftime(make_date(year(l_shipdate)::int, 2, 1) + 29, '%Y-%m-%d')
              WHEN kind = 9 AND far AND l_linenumber <= 5
                THEN ['0000-06-05', '-0005-06-05', '+200001-06-05', '4748-04-28', NULL][l_linenumber]
              ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date
  FROM accepted)"""

NAMES = """names AS (
  SELECT c_name AS name FROM customer UNION ALL SELECT concat('P', p_partkey) FROM part)"""

TOKEN = r"[\p{L}\p{N}]+"
POSTINGS = f"""tokens AS (
  SELECT doc_id AS id, 'features' AS field, unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS term
  FROM documents
  UNION ALL
  SELECT doc_id, 'name', unnest(regexp_extract_all(lower(string_split(text, chr(10))[1]), '{TOKEN}'))
  FROM documents),
counted AS MATERIALIZED (SELECT id, field, term, count(*)::int AS tf FROM tokens GROUP BY ALL),
lengths AS MATERIALIZED (
  SELECT id, field, sum(tf)::int AS dl, count(*) AS terms, max(tf) AS max_tf FROM counted GROUP BY ALL),
stats AS (SELECT field, count(*) AS n_docs, avg(dl) AS avgdl FROM lengths GROUP BY ALL),
terms AS MATERIALIZED (
  SELECT field, term, count(*) AS df, sum(tf)::bigint AS occurrences FROM counted GROUP BY ALL)"""

BM25 = """weights AS MATERIALIZED (
  SELECT id, field, term, tf, df, ln(1 + (n_docs - df + 0.5::double) / (df + 0.5::double)) AS idf,
         ln(1 + (n_docs - df + 0.5::double) / (df + 0.5::double)) * tf * 2.2::double
           / (tf + 1.2::double * (0.25::double + 0.75::double * dl / avgdl)) AS weight
  FROM counted JOIN lengths USING (id, field) JOIN terms USING (field, term) JOIN stats USING (field))"""

SELECTED = """chosen AS (
  SELECT id, term FROM weights WHERE field = 'features' AND tf >= 2 AND df >= 5
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY round(tf * idf, 6) DESC, term) <= 25),
selected AS MATERIALIZED (
  SELECT id, term, greatest(1, floor(count(*) OVER (PARTITION BY id) * 0.3::double))::int AS need
  FROM chosen)"""

MLT = """mlt AS (
  SELECT s.id AS id, w.id AS pid, round(sum(weight), 6) AS r
  FROM selected s JOIN weights w ON s.term = w.term AND w.field = 'features' AND w.id <> s.id
  GROUP BY s.id, w.id HAVING count(*) >= max(need)),
content AS (
  SELECT id, row_number() OVER (PARTITION BY id ORDER BY r DESC, pid)::int AS rank, pid, r FROM mlt
  QUALIFY rank <= 10)"""

DOT = """pairs AS (
  SELECT u.vec_id AS id, i.vec_id AS pid,
         list_inner_product(u.embedding::double[], i.embedding::double[]) AS raw
  FROM embeddings u, embeddings i)"""
COSINE = """pairs AS (
  SELECT u.vec_id AS id, i.vec_id AS pid,
         list_cosine_similarity(u.embedding::double[], i.embedding::double[]) AS raw
  FROM embeddings u JOIN embeddings i ON u.vec_id <> i.vec_id)"""


def _top(k):
    return f"""top AS (
  SELECT id, pid, round(raw, 6) AS r,
         row_number() OVER (PARTITION BY id ORDER BY round(raw, 6) DESC, pid)::int AS rank
  FROM pairs WHERE raw > 0 QUALIFY rank <= {k})"""


BLEND = """blend AS (
  SELECT id AS "requestId", 0 AS source, rank AS "sourceRank", pid AS "productId",
         r AS "originalRating", r * 0.8::double AS "hybridRating"
  FROM top JOIN documents ON id = doc_id
  UNION ALL
  SELECT id, 1, rank, pid, r, r * (1 - 0.8::double) FROM content)"""

_RECS_CHECK = """SELECT '{kind}' AS kind, count(DISTINCT "{column}") AS lists, 0::bigint AS too_long,
  0::bigint AS out_of_order, 0::bigint AS not_positive, 0::bigint AS repeated, 0::bigint AS own
  FROM reviews WHERE overall IS NOT NULL"""

_LIST_CHECK = """SELECT DISTINCT "{column}" AS id, true AS bounded, true AS falling, true AS scored
  FROM reviews WHERE overall IS NOT NULL"""

ORACLES = {
    "raw_json_roundtrip": _with(LINES, DOCUMENTS)
    + "SELECT ext_id, count(*) AS documents, sum(n)::bigint AS reviews FROM docs GROUP BY ext_id",
    "products_flat": _with(LINES, DOCUMENTS)
    + f"""SELECT {_id("ext_id")} AS id, ext_id AS "extId", p_name AS name, price, info AS features,
       concat('http://img.example.com/', p_partkey) AS "imgUrl" FROM docs""",
    "users_distinct": _with(LINES)
    + f"""SELECT DISTINCT {_id("c_name")} AS id, c_name AS "extId" FROM lines""",
    "reviews_distinct": _with(LINES, REVIEWS) + "SELECT * FROM reviews",
    "dirty_reviews": _with(LINES, DIRTY) + "SELECT * FROM reviews",
    "dirty_products_users": _with(LINES, DOCUMENTS, DIRTY)
    + f"""SELECT 'product' AS kind, {_id("ext_id")} AS id, ext_id AS "extId" FROM docs
    WHERE p_size NOT IN (7, 8)
    UNION ALL SELECT DISTINCT 'user', {_id("c_name")}, c_name FROM accepted""",
    "accounted_drops": _with(
        LINES, DOCUMENTS, DIRTY,
        """judged AS (
  SELECT CASE WHEN l_returnflag = 'N' AND l_quantity > 45 THEN 'no_author'
              WHEN spoilt AND l_linenumber IN (2, 3, 6, 7) THEN 'bad_rating'
              WHEN kind IN (1, 7, 8) THEN 'bad_date' ELSE 'kept' END AS cause
  FROM dirty WHERE p_size NOT IN (7, 8))""",
    )
    + """SELECT cause, count(*) AS n FROM judged GROUP BY cause
    UNION ALL SELECT 'documents', count(*) FROM docs
    UNION ALL SELECT 'corrupt', 0
    UNION ALL SELECT 'no_product', count(*) FROM docs WHERE p_size IN (7, 8)
    UNION ALL SELECT 'no_review', count(*) FROM docs WHERE n > 0 AND p_size NOT IN (7, 8)
    UNION ALL SELECT 'reviews', (SELECT count(*) FROM judged)
      + (SELECT count(*) FROM docs WHERE n > 0 AND p_size NOT IN (7, 8))""",
    "hash_ids": _with(NAMES) + f"""SELECT {_id("name")} AS id, name AS "extId" FROM names""",
    "hash_texts": f"SELECT doc_id, {_id('text')} AS id FROM documents",
    "hash_collisions": _with(
        NAMES,
        f"""everything AS (
  SELECT name FROM names
  UNION SELECT unnest(regexp_extract_all(lower(text), '{TOKEN}')) FROM documents),
hashed AS (SELECT {_id("name")} AS id, name FROM everything)""",
    )
    + "SELECT id, count(*) AS names FROM hashed GROUP BY id HAVING count(*) > 1",
    "ratings_triples": _with(LINES, REVIEWS)
    + """SELECT "userId" AS user, "productId" AS item, overall::float AS rating
    FROM reviews WHERE overall IS NOT NULL""",
    "distinct_ids": _with(LINES)
    + f"""SELECT DISTINCT 'user' AS kind, {_id("c_name")} AS id FROM lines
    UNION ALL SELECT DISTINCT 'product', {_id("concat('P', p_partkey)")} FROM part""",
    "text_index_terms": _with(POSTINGS) + "SELECT field, term, df, occurrences FROM terms",
    "incremental_index": _with(POSTINGS) + "SELECT field, term, df, occurrences FROM terms",
    "text_index_postings": _with(POSTINGS)
    + "SELECT id, field, term, tf, dl FROM counted JOIN lengths USING (id, field)",
    "text_index_documents": _with(POSTINGS) + "SELECT id, field, dl, terms, max_tf FROM lengths",
    "als_recs_properties": _with(LINES, REVIEWS)
    + _RECS_CHECK.format(kind="user", column="userId")
    + "\nUNION ALL "
    + _RECS_CHECK.format(kind="product", column="productId"),
    "dot_topk": _with(DOT, _top(100)) + "SELECT id, pid, r FROM top",
    "cosine_topk": _with(COSINE, _top(100)) + "SELECT id, pid, r FROM top",
    "bounded_dot_topk": _with(DOT, _top(100)) + "SELECT id, pid, r FROM top",
    "bounded_cosine_topk": _with(COSINE, _top(100)) + "SELECT id, pid, r FROM top",
    "cosine_pair_formula": _with(COSINE, _top(10)) + "SELECT id, pid, r FROM top",
    "cosine_recs_nested_topk": _with(COSINE, _top(10)) + "SELECT id, rank, pid, r FROM top",
    "product_cf_lookup": _with(COSINE, _top(10))
    + """SELECT id AS "requestId", rank, pid AS "productId", r AS rating
    FROM top JOIN part ON id = p_partkey""",
    "user_cf_lookup": _with(DOT, _top(10))
    + """SELECT id AS "userId", rank, pid AS "productId", r AS rating
    FROM top JOIN customer ON id = c_custkey""",
    "search_multi_field": _with(
        POSTINGS, BM25,
        f"""asked AS (
  SELECT DISTINCT item_id AS key, unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS term
  FROM benchmark),
scored AS (
  SELECT key, id, field, sum(weight) AS score FROM asked JOIN weights USING (term) GROUP BY ALL),
best AS (SELECT key, id, round(max(score), 6) AS rating FROM scored GROUP BY ALL)""",
    )
    + """SELECT key, row_number() OVER (PARTITION BY key ORDER BY rating DESC, id)::int AS rank,
       id AS "productId", rating FROM best QUALIFY rank <= 10""",
    "more_like_this_terms": _with(POSTINGS, BM25, SELECTED) + "SELECT id, need, term FROM selected",
    "more_like_this": _with(POSTINGS, BM25, SELECTED, MLT)
    + 'SELECT id AS "requestId", rank, pid AS "productId", r AS rating FROM content',
    "hybrid_scores": _with(POSTINGS, BM25, SELECTED, MLT, COSINE, _top(10), BLEND)
    + "SELECT * FROM blend",
    "hybrid_topk": _with(POSTINGS, BM25, SELECTED, MLT, COSINE, _top(10), BLEND)
    + """SELECT "requestId", row_number() OVER (PARTITION BY "requestId"
         ORDER BY "hybridRating" DESC, source, "sourceRank")::int AS rank,
       "productId", "originalRating", "hybridRating" FROM blend QUALIFY rank <= 10""",
    "requests_json": _with(
        COSINE, _top(10),
        "best AS (SELECT id, count(*) AS n, min_by(pid, rank) AS pid, max(r) AS r FROM top GROUP BY id)",
    )
    + """SELECT p_partkey::int AS "requestId", coalesce(n, 0)::int AS n_items,
       pid::int AS first_product, r AS first_rating FROM part LEFT JOIN best ON p_partkey = id""",
    "hot_requests": _with(COSINE, _top(10))
    + """SELECT id AS "requestId", rank, pid AS "productId", count(*) AS n
    FROM top JOIN lineitem ON id = CASE WHEN l_orderkey % 2 = 0 THEN 7 ELSE l_partkey END GROUP BY ALL""",
    "streamed_requests": _with(
        COSINE, _top(10),
        "best AS (SELECT id, count(*) AS n, min_by(pid, rank) AS pid, max(r) AS r FROM top GROUP BY id)",
    )
    + """SELECT p_partkey::int AS "productId", 1::BIGINT AS answers, coalesce(n, 0)::int AS n_items,
       pid::int AS first_product, r AS first_rating FROM part LEFT JOIN best ON p_partkey = id""",
    "interrupted_publish": """SELECT doc_id AS id, string_split(text, chr(10))[1] AS before,
       string_split(text, chr(10))[1] AS kept, string_split(text, chr(10))[1] || '!' AS after FROM documents""",
    "requests_text_json": _with(
        POSTINGS, BM25,
        f"""asked AS (
  SELECT DISTINCT text AS key, unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS term
  FROM benchmark),
scored AS (
  SELECT key, id, field, sum(weight) AS score FROM asked JOIN weights USING (term) GROUP BY ALL),
rated AS (SELECT key, id, round(max(score), 6) AS rating FROM scored GROUP BY ALL),
top AS (
  SELECT * FROM rated
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY rating DESC, id) <= 10),
best AS (
  SELECT key, count(*)::int AS n, first(id ORDER BY rating DESC, id) AS id, max(rating) AS rating
  FROM top GROUP BY key)""",
    )
    + """SELECT text, coalesce(n, 0)::int AS n_items, id AS first_product, rating AS first_rating
    FROM (SELECT DISTINCT text FROM benchmark) LEFT JOIN best ON text = key""",
    "als_factors": _with(LINES, REVIEWS)
    + """SELECT DISTINCT 'user' AS side, "userId" AS id, 10 AS rank, true AS finite
    FROM reviews WHERE overall IS NOT NULL
    UNION ALL SELECT DISTINCT 'item', "productId", 10, true FROM reviews WHERE overall IS NOT NULL""",
    "als_predict": _with(LINES, REVIEWS)
    + """SELECT "userId" AS user, "productId" AS item, true AS predicted, true AS as_expected
    FROM reviews WHERE overall IS NOT NULL
    UNION ALL SELECT DISTINCT "userId", -1, false, true FROM reviews WHERE overall IS NOT NULL""",
    "als_user_recs": _with(LINES, REVIEWS) + _LIST_CHECK.format(column="userId"),
    "als_item_recs": _with(LINES, REVIEWS) + _LIST_CHECK.format(column="productId"),
    "als_train": _with(LINES, REVIEWS)
    + """SELECT DISTINCT 'user' AS kind, "userId" AS id, 7 AS items FROM reviews WHERE overall IS NOT NULL
    UNION ALL SELECT DISTINCT 'product', "productId", 7 FROM reviews WHERE overall IS NOT NULL""",
    "user_cf_from_reviews": _with(LINES, REVIEWS)
    + """SELECT "userId", unnest(range(1, 11))::int AS rank
    FROM (SELECT DISTINCT "userId" FROM reviews WHERE overall IS NOT NULL)""",
    "stored_answers": _with(LINES, REVIEWS)
    + """SELECT DISTINCT "productId" AS "requestId", true AS weighed, true AS falls, true AS bounded,
       true AS complete
    FROM reviews WHERE overall IS NOT NULL""",
}

_PER_PRODUCT = _with(
    LINES, DOCUMENTS, REVIEWS,
    f"""products AS (
  SELECT {_id("ext_id")} AS id, ext_id AS "extId", price, count(*) AS documents FROM docs GROUP BY ALL),
written AS (
  SELECT "productId" AS id, count(*) AS reviews, count(DISTINCT "userId") AS authors,
         count(overall) AS rated, sum(overall) AS stars, max(date) AS last_date
  FROM reviews GROUP BY ALL)""",
) + "SELECT * FROM products JOIN written USING (id)"
ORACLES |= {"table_roundtrip": _PER_PRODUCT, "compact_then_load": _PER_PRODUCT, "incremental_load": _PER_PRODUCT}

# Documents per product type; a document is one line of JSON, so its lines count documents.
ORACLES["compact_small_files"] = (
    _with(LINES, DOCUMENTS) + "SELECT p_type AS category, count(*) AS lines FROM docs GROUP BY p_type"
)

# Bounds change the way, not the answers.
ORACLES["bounded_search"] = ORACLES["search_multi_field"]
ORACLES["bounded_more_like_this"] = ORACLES["more_like_this"]
