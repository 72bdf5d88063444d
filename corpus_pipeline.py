"""From raw documents to token pieces: five stages, each over all rows that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  No SQL can express the sampled
segmentation or the hyperdimensional profiles, so ``ORACLE_SQL`` is None and
the stages are tested against brute-force versions.

Defined results, in all stages: rows with a null id stay rows of their own and
go by their texts like others (near_dedup keeps them: without an id they belong
to no group); of rows that repeat an id each goes by its own text, so that
another text under the id of a copy stays; rows that repeat id and text are one
document, of which near_dedup keeps one row; null lang, source and n_chars do
no harm; null and empty texts have no language and go in the first stage; an
empty table gives an empty table; further columns, whatever their names, are
left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import hyperlang, line_spread, lsh_forest, phrase_index, piece_lattice
from tidemark.llm.common import staged, table, work_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _one_text(text: str = "text") -> Column:
    return F.xxhash64(F.col("doc_id"), F.coalesce(F.col(text), F.lit("")))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Labels every document with its predicted language; texts without a language (``und``) go.

    Ties go to the language first in alphabetical order; very long texts count whole.
    """
    model = hyperlang.fit(docs.where(hyperlang.in_training(F.col("doc_id"))))
    labelled = hyperlang.predict(docs.select(*COLUMNS), model)
    return labelled.where("lang_pred <> 'und'").withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that ten sources or more carry, but for their first occurrence; documents left without text go.

    The first occurrence is that of the lowest id (null: lowest of all), then of the lowest hash of the text, then of the
    lowest line; a null source adds to no line's spread.
    """
    clean = line_spread.remove_boilerplate(docs.select(*COLUMNS)).where("n_removed = 0 or text rlike '[^ \\t\\r\\n]'")
    return clean.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def _one_vertex_a_text(docs: DataFrame) -> DataFrame:
    """``docs`` without rows that repeat id and text, and with ``v``: the id, or a hash of id and text (2 ** 62 or more) for ids with several texts."""
    twice = staged(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "repeated_ids")
    if twice.isEmpty():
        return docs.withColumn("v", F.col("doc_id"))
    own = F.col("h").bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    more = staged(docs.join(twice, "doc_id", "left_semi").withColumn("h", _one_text()).dropDuplicates(["doc_id", "h"]), "repeated")
    several = more.groupBy("doc_id").agg((F.count(F.lit(1)) > 1).alias("several"))
    more = more.join(several, "doc_id").withColumn("v", F.when(F.col("several"), own).otherwise(F.col("doc_id"))).drop("several", "h")
    return staged(docs.join(twice, "doc_id", "left_anti").withColumn("v", F.col("doc_id")).unionByName(more), "vertices")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the document with the smallest id stays.

    Texts that share an id are told apart by a hash of id and text, which stands for the id in their groups.  Of the rest,
    lines of more than 50 words stay only where they occur first, on however few sources they are; documents left without
    text go.  Before the copies are gone, this would leave their changed lines behind.
    """
    docs = _one_vertex_a_text(docs.select(*COLUMNS))
    gone = lsh_forest.near_duplicates(docs, key="v", words=5, percent=80).where("not kept").select(F.col("doc_id").alias("v"))
    rest = staged(docs.join(staged(gone, "copies"), "v", "left_anti").select(*COLUMNS), "rest")
    clean = line_spread.remove_repeated(rest).where("n_removed = 0 or text rlike '[^ \\t\\r\\n]'")
    return clean.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item (or a whole shorter item) go; of rows that share an id only those whose own text has them."""
    keyed = docs.select(*COLUMNS, _one_text().alias("v"))
    found = phrase_index.contamination(keyed, table(spark, sf_dir, "benchmark"), work_path(spark, "phrases"), key="v")
    return keyed.join(staged(found.where("contaminated").select(F.col("doc_id").alias("v")).distinct(), "contaminated"), "v", "left_anti").select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sampled pieces of every document, their number and checksum, and whether they decode to the text; repeated rows get the same pieces."""
    import public_tokenizers

    return piece_lattice.encode(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("piece_bpe_32k.model")).drop("text")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("sentencepiece", pieces),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
