"""Documents to training tokens: toxic texts go, one of each group of near copies stays, benchmark leaks go, personal
data become pseudonyms, and the rest is encoded. Each stage takes and returns whole tables; its result is written as
Parquet and read again by the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridstats.llm import toxicity
from gridstats.llm.bpe import encode
from gridstats.llm.columns import unused
from gridstats.llm.decontaminate import without_leaks
from gridstats.llm.ngram_join import jaccard_components
from gridstats.llm.pii import pseudonymise
from gridstats.plans.sizing import broadcast_if_small, spill

REJECT_SCORE = 0.5
PSEUDONYM_KEY = "example key"
TOKENIZER = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored below ``REJECT_SCORE`` by a model of all labelled rows. A null text counts as empty and stays."""
    model = toxicity.train(toxicity.with_labels(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    score, found = unused(docs, "toxicity"), unused(docs, "toxic_passages")
    scored = toxicity.score(docs, model, column=score, passages=found)
    return scored.where(F.col(score) < REJECT_SCORE).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles with a similarity of 0.8 or more, the row with the smallest doc_id.

    Rows that repeat a doc_id are copies of each other: the first by text stays. Rows without doc_id or words stay.
    """
    groups = spill(jaccard_components(docs, width=5, percent=80))
    dropped = groups.where("component_id <> doc_id").select("doc_id").distinct()
    kept = docs.join(broadcast_if_small(dropped), "doc_id", "left_anti").select(*docs.columns)
    repeated = groups.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    repeated = broadcast_if_small(repeated)
    order = unused(docs, "place")
    by_text = Window.partitionBy("doc_id").orderBy(F.md5(F.col("text").cast("binary")))
    first = kept.join(repeated, "doc_id", "left_semi").withColumn(order, F.row_number().over(by_text)).where(F.col(order) == 1)
    return kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).union(first.select(*docs.columns))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no benchmark item, replaced words allowed for. Null and empty texts hold none and stay."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with pseudonyms for personal data in ``text`` and ``n_chars`` counted anew. Null texts stay null and keep their
    ``n_chars``, empty ones stay empty."""
    hidden = pseudonymise(docs, PSEUDONYM_KEY)
    if "n_chars" not in docs.columns:
        return hidden
    counted = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return hidden.withColumn("n_chars", counted).select(*docs.columns)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with ``token_ids`` and ``n_tokens``; columns of these names are replaced. Null and empty texts have no ids."""
    done = encode(docs.drop("n_tokens"), public_tokenizers.path(TOKENIZER))
    return done.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("pii", hide_personal_data),
    ("bpe", to_tokens),
]

# No stage but the third can be said in SQL; the tests look at planted and awkward rows of each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = spill(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
