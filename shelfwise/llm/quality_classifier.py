"""A quality classifier by importance resampling: n-gram models, and Gumbel noise for the choice."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm import ngram_models
from shelfwise.llm.ordered import running_sums
from shelfwise.llm.words import pieces
from shelfwise.session import staged

SEED = 20240229
#: What a unit of log ratio per n-gram counts beside the Gumbel noise.
SCALE = 100.0


def _score(models: ngram_models.Models):
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = piece.column("text")
                found = ngram_models.measures(texts, models)
                margin = np.minimum(found.mean - models.floor, found.tail - models.limit)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("rest"), texts, piece.column("key"), pa.array(found.total),
                        pa.array(found.count.astype(np.int64)), pa.array(margin),
                    ],
                    names=["rest", "text", "key", "log_ratio", "n_grams", "margin"],
                )

    return run


def importance(docs: DataFrame, labels: DataFrame, size: int | None = None, seed: int = SEED) -> DataFrame:
    """``docs`` with n_grams, log_ratio, noisy and selected.

    ``log_ratio`` is the log of the text's likelihood under the model of trusted documents over
    that under the model of all documents. Its margin is how far the log ratio per n-gram (and
    ``ngram_models.NEUTRAL``) lies above the models' floor, or the sum of words that convict it as
    toxic above their limit, whichever is less. Both limits come from held-out labelled documents.
    ``noisy`` is ``SCALE`` margins plus Gumbel noise from a hash of id and text, and the ``size``
    documents with the largest noisy values are selected: a sample without replacement by
    importance. The usual size is the number of documents whose margin is not negative, so that
    noise decides only among those within a few hundredths of the limit.

    Null or empty text: log ratio 0. Null ``doc_id``: never a trusted document, otherwise like any
    other. Equal rows get equal noise and are selected together, if the limit falls on them.
    Columns of the input named like an added one are replaced. Empty tables of either kind are
    allowed; without trusted documents all log ratios are 0 and all documents are selected.
    """
    added = ["n_grams", "log_ratio", "noisy", "selected"]
    models = ngram_models.fit(docs, labels)
    read = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("key"), F.col("text").cast("string").alias("text"),
    )
    rest = read.schema["rest"].dataType.simpleString()
    scored = read.mapInArrow(
        _score(models), f"rest {rest}, text string, key long, log_ratio double, n_grams long, margin double"
    )
    uniform = (F.shiftrightunsigned("key", 11).cast("double") + 0.5) / float(1 << 53)
    noisy = scored.withColumn("noisy", SCALE * F.col("margin") - F.log(-F.log(uniform)))
    narrow = staged(noisy.select((-F.col("noisy")).alias("down"), "key", (F.col("margin") >= 0).alias("reaches")), "scores")
    if size is None:
        size = narrow.where("reaches").count()
    ranked = running_sums(narrow.select("down", "key"), [], ["down", "key"], {"rank": F.lit(1)})
    # The last selected row in order; the texts are scored again instead of being moved.
    last = ranked.where(F.col("rank") == size).first() if size else None
    if last is None:
        selected = F.lit(size > 0)
    else:
        selected = (-F.col("noisy") < last.down) | ((-F.col("noisy") == last.down) & (F.col("key") <= last.key))
    given = [
        F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns if c not in added
    ]
    return noisy.select(*given, "n_grams", "log_ratio", "noisy", selected.alias("selected"))
