"""The corpus pipeline: documents to token shards, five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read
again as the next stage's documents; all but the last return the columns of ``documents``.

1. language: documents whose text has no letter, or in which no language is credible, go.
2. near_duplicates: of each group of near copies (five-word shingles, similarity 0.8) the document
   with the smallest id stays.
3. decontaminate: documents that hold a benchmark item go.
4. mix: every source is taken as often as its target asks, documents repeated or left out.
5. tokens: texts become token shards; one row per document tells where its tokens are.

Null texts, null ids, other columns and empty tables: columns besides the five of documents are carried
through whatever their names; a null or empty text is rejected by the first stage; a
document with a null id is compared with none and stays; empty tables give empty results.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbusgrid.llm import decontaminate, jaccard, language, mixing, tokens
from nimbusgrid.llm.common import keep, picked, table

#: Below this the best language is hardly likelier than the others.
LEAST_SCORE = 0.3
WIDTH, PERCENT = 5, 80
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def shielded(stage):
    """``stage`` with all other columns under names of our own, so that none meets a working column."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c: f"extra_column_{i}_" for i, c in enumerate(docs.columns) if c not in COLUMNS}
        out = stage(spark, docs.withColumnsRenamed(names), sf_dir)
        return out.withColumnsRenamed({own: c for c, own in names.items()})
    return run_stage


@shielded
def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is credible."""
    model = language.train(docs.where(~language.held_out()))
    scored = language.predict(docs, model, lang_out="_lang", score_out="_score", keep=tuple(docs.columns))
    return scored.where((F.col("_lang") != language.UNDETERMINED) & (F.col("_score") >= LEAST_SCORE)).drop("_lang", "_score")


@shielded
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component; of rows that repeat its id, the one whose
    text, then whose columns, have the least digest."""
    member, found = jaccard.links(docs, width=WIDTH, percent=PERCENT)
    placed = member.where("rep is not null").join(found, "rep", "left").withColumn(
        "component", F.coalesce("component_id", "rep"))
    later, _ = keep(placed.where("id <> component").select(F.col("id").alias("_later")).distinct(), "later")
    single = picked(docs.where("doc_id is not null"), later, F.col("doc_id") == F.col("_later"), "left_anti")
    repeated = single.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_again"))
    repeated, _ = keep(repeated, "again")
    once = picked(single, repeated, F.col("doc_id") == F.col("_again"), "left_anti")
    whole = F.struct(*docs.columns)
    order = F.struct(F.md5(F.coalesce("text", F.lit(""))), F.md5(F.to_json(whole)))
    one = picked(single, repeated, F.col("doc_id") == F.col("_again"), "left_semi").groupBy("doc_id").agg(
        F.min_by(whole, order).alias("row")).select("row.*")
    return once.unionByName(one).unionByName(docs.where("doc_id is null"))


@shielded
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    found = decontaminate.matches(docs, table(spark, sf_dir, "benchmark", "item_id", "text"), keep=tuple(docs.columns))
    return found.where(F.size("matches") == 0).drop("matches")


@shielded
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


@shielded
def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's tokens are, read from the shard files."""
    return tokens.token_output(docs, tokens.default_tokenizer())


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontaminate", decontamination_stage),
    ("mix", mixing_stage),
    ("tokens", token_stage),
]

#: SQL can't express the learned and the tokenizing stages; the tests compare each with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
