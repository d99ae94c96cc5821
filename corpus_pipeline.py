"""A training corpus from documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's documents. All but the last return the columns of documents:

1. toxicity: documents that score 0.5 or more go; the model learns from the labels of those rows
   of its input that are not held out.
2. line_dedup: lines with an earlier match go; ``n_chars`` follows the text. A document of which
   every line with words went goes with them; documents that had no words stay.
3. near_duplicates: of each component of near duplicates the document with the least id stays; one
   without an id only if none there has one. Documents without words stay.
4. mixing: each document as often as the mix of sources takes it, so that rows repeat.
5. bpe: the token ids of each row, ``ids``, and their number.

Null texts, repeated rows and extra columns are handled as the operators state; extra columns are
carried along to the mix. Rows without an id, or with an id that other texts have as well, are
documents of their own to stage 3.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import bpe, line_dedup, mixing, ngram_join, toxicity
from skyledger.llm.queries import tokenizer_path
from skyledger.llm.tables import prepared, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    whole = docs.select(F.struct(*docs.columns).alias("row"), "text")
    scored = toxicity.scored(whole, model, ["row"])
    return scored.where("score < 0.5").select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    # One struct with names of its own, so that no column can clash with those of the operator.
    rest = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)])
    left = line_dedup.deduplicated(docs.select("doc_id", "text", rest.alias("rest"))).where(
        "lines = 0 or lines_left > 0")
    columns = {"doc_id": F.col("doc_id"), "text": F.col("text")} | {
        c: F.col(f"rest.c{i}") for i, c in enumerate(others)}
    columns["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return left.select(*[columns[c].alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return mixing.mixture(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return bpe.encoded(docs, bpe.WordBpe.from_file(tokenizer_path())).withColumn(
        "n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

#: SQL cannot express the first and the last stage; the tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, over the documents in ``sf_dir``."""
    docs = prepared(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
