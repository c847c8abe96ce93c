"""One registered query per operator over its whole table: digests of the operator's results."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm.collocations import mine_phrases
from shelfwise.llm.conversation_trie import borrow_heads, prefix_trie, turn_keys
from shelfwise.llm.decontamination import find_contamination
from shelfwise.llm.html_extraction import extract_pages
from shelfwise.llm.line_dedup import dedup_lines
from shelfwise.llm.mixing import mix
from shelfwise.llm.pii import BASE_KINDS, count_of, find_pii, written
from shelfwise.llm.quality_classifier import importance
from shelfwise.llm.quality_rules import apply_rules
from shelfwise.llm.sentencepieces import decode, encode
from shelfwise.llm.simhash_dedup import near_duplicates
from shelfwise.llm.substring_dedup import dedup_substrings
from shelfwise.llm.url_filter import ALLOW, BLOCK, judge_urls

#: The URL rules of the contract: verdict, host, path.
URL_RULES = [
    (BLOCK, "net", "/"),
    (ALLOW, "example.net", "/en/"),
    (BLOCK, "example.com", "/de/"),
    (ALLOW, "org", "/fr/"),
]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_substring_dedup(spark, folder):
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return dedup_substrings(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


def op2_pii(spark, folder):
    found = find_pii(_table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[count_of("base", kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(written("base"), 256).alias("base_sha256"),
        written("spans").alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )


def op3_source_mixing(spark, folder):
    docs = _table(spark, folder, "documents").select("doc_id", "source", "text")
    sizes = mix(docs, keep=["doc_id"])
    return sizes.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op4_simhash_dedup(spark, folder):
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return near_duplicates(docs).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op5_url_filter(spark, folder):
    rows = [F.struct(*[F.lit(v).alias(c) for v, c in zip(r, ("verdict", "host", "path"))]) for r in URL_RULES]
    rules = spark.range(1).select(F.inline(F.array(*rows)))
    return judge_urls(_table(spark, folder, "pages").select("page_id", "url"), rules).drop("url")


def op6_quality_rules(spark, folder):
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return apply_rules(docs, _table(spark, folder, "labels")).drop("log_ratio")


def op7_html_extraction(spark, folder):
    pages = _table(spark, folder, "pages").select("page_id", "url", "html")
    return extract_pages(pages).withColumn("n_chars", F.length("text").cast("long"))


def op8_decontamination(spark, folder):
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = find_contamination(docs, _table(spark, folder, "benchmark").select("item_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op9_quality_classifier(spark, folder):
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = importance(docs, _table(spark, folder, "labels"))
    return found.select("doc_id", "n_grams", "log_ratio", "noisy", F.col("selected").alias("kept"))


def op10_line_dedup(spark, folder):
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op11_phrase_collocations(spark, folder):
    return mine_phrases(_table(spark, folder, "documents").select("lang", "text"))


def op12_sentencepieces(spark, folder):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    encoded = encode(docs, path, packed=True).select("doc_id", "n_tokens", "ids")
    hashed = encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "ids")
    return decode(hashed, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op13_conversation_trie(spark, folder):
    keys = turn_keys(_table(spark, folder, "conversations"))
    donor = F.col("conv_id") - F.col("conv_id") % 5
    count = F.crc32(F.col("conv_id").cast("string")) % 9
    return prefix_trie(borrow_heads(keys, donor, count, 8))


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_pii, op3_source_mixing, op4_simhash_dedup,
        op5_url_filter, op6_quality_rules, op7_html_extraction, op8_decontamination,
        op9_quality_classifier, op10_line_dedup, op11_phrase_collocations, op12_sentencepieces,
        op13_conversation_trie,
    )
}
