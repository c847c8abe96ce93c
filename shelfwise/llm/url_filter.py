"""Block and allow rules on URLs as a sort-merge range join over reversed-host keys."""

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.ordered import running_last
from shelfwise.session import staged

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: str) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.coalesce(F.regexp_extract(F.col(url), _URL, 1), F.lit(""))
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(F.col(url), _URL, 2), F.lit(""))


def host_key(host: Column) -> Column:
    """The labels from last to first, each followed by a dot: a domain's key is a prefix of the
    keys of its subdomains and of no other host's."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def active(items: DataFrame, rules: DataFrame) -> DataFrame:
    """``items`` with the keys in ``rules`` that are prefixes of the item's, shortest first.

    ``items`` has columns row and key, ``rules`` the distinct keys in column key. A key opens an
    interval, that of the keys it is a prefix of; intervals are nested or apart. All keys are sorted
    together. The last interval opened before an item carries the stack of those around it; the
    ones that do not reach the item are popped.
    """
    length = F.sequence(F.lit(1), F.length("key"))
    outer = rules.select(F.col("key").alias("inner"), F.explode(length).alias("n"), "key")
    outer = outer.select("inner", F.substring("key", F.lit(1), F.col("n")).alias("key"))
    stacks = outer.join(rules, "key", "left_semi").groupBy("inner").agg(F.sort_array(F.collect_list("key")).alias("stack"))
    starts = stacks.select(F.lit(None).cast("long").alias("row"), F.col("inner").alias("key"), "stack")
    swept = running_last(
        items.select("row", "key").withColumn("stack", F.lit(None).cast("array<string>")).unionByName(starts),
        ["key", "row"], "stack", "opened",
    )
    held = F.filter("opened", lambda k: F.startswith(F.col("key"), k))
    return swept.where("row IS NOT NULL").select("row", "key", F.coalesce(held, F.array().cast("array<string>")).alias("active"))


def judge_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``pages`` with host, path, rule (host and path of the rule that decides, or null) and verdict.

    ``rules`` has the columns verdict, host and path. A rule fits its host and all subdomains when
    the URL's path starts with the rule's path. The longest rule wins, by host and path together,
    then by host; a URL that no rule fits is allowed. One sweep finds the ruled domains around each
    host, a second one the ruled paths around each path.

    Null URL, or one without ``://``: host and path are empty, and no rule fits. Repeated rows and
    ``page_id`` of any kind are judged row by row. Of equal rules with two verdicts the block holds;
    a rule without a host is ignored, a rule without a path covers all. The pages' rows are written
    once, so project what is not needed; equally named columns are replaced. Empty tables of either
    kind are allowed.
    """
    added = ["host", "path", "rule", "verdict"]
    given = [c for c in pages.columns if c not in added]
    rows = staged(
        pages.select(
            F.struct(*[F.col(f"`{c}`") for c in given]).alias("page"),
            host_of("url").alias("host"), path_of("url").alias("path"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "urls",
    )
    lowered = F.translate(F.col("host"), _UPPER, _LOWER)
    ruled = rules.where("host IS NOT NULL").select(
        host_key(lowered).alias("domain"), F.coalesce("path", F.lit("")).alias("ruled_path"),
        F.concat(lowered, F.coalesce("path", F.lit(""))).alias("rule"), F.length("host").alias("host_chars"), "verdict",
    )
    ruled = ruled.groupBy("domain", "ruled_path", "rule", "host_chars").agg(F.max("verdict").alias("verdict"))
    ruled = staged(ruled.withColumn("key", F.concat("domain", F.lit("/"), "ruled_path")), "rules")
    hosts = rows.select("row", host_key(F.col("host")).alias("key"))
    domains = active(hosts, ruled.select(F.col("domain").alias("key")).distinct())
    under = domains.select("row", F.explode("active").alias("domain")).join(rows.select("row", "path"), "row")
    paths = active(
        under.select("row", F.concat("domain", F.lit("/"), "path").alias("key")), ruled.select("key").distinct()
    )
    fits = paths.select("row", F.try_element_at("active", F.lit(-1)).alias("key")).where("key IS NOT NULL").join(ruled, "key")
    best = fits.groupBy("row").agg(
        F.max(F.struct(F.length("rule").alias("chars"), "host_chars", "rule", "verdict")).alias("best")
    )
    return rows.join(best, "row", "left").select(
        *[F.col("page").getField(c).alias(c) for c in given],
        "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(ALLOW)).alias("verdict"),
    )
