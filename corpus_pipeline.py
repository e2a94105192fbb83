"""A training corpus from ``documents`` in five stages, each written and read again.

Each stage takes all rows its predecessor kept. All but the last return the columns of ``documents``, whatever
further ones there are. An empty table gives an empty one.
SQL can't express the learned, approximate-string and tokenizer stages, so there is no ORACLE_SQL; the
tests hold the stages against plain Python on a small corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.llm import decontamination, jaccard_join, line_dedup, sentencepiece_codec, toxicity
from chunkloom.llm.common import cut, fresh, table
from chunkloom.llm.queries import tokenizer_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose toxicity score is 0.5 or more.

    Null and empty texts stay; repeated rows, and rows of equal texts, go or stay together; without labels common
    insults decide. A score of just 0.5 goes. An empty table stays empty.
    """
    return toxicity.drop_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that repeat an earlier one up to two edits; n_chars follows the text.

    Documents that lose every line go; null and empty texts stay, with n_chars null and 0. The document with the
    least id keeps a line, rows that repeat an id don't take lines from each other, null ids come last.
    """
    kept = line_dedup.without_repeats(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the least id.

    Of rows that repeat this id and its text one stays, their other texts stay too. Texts without words and rows
    with a null id are in no group and stay. An empty table stays empty.
    """
    groups = jaccard_join.jaccard_groups(docs)
    other = fresh("other", docs.columns)
    others = groups.where("doc_id <> component_id").select(F.col("doc_id").alias(other)).distinct()
    kept = docs.join(others, F.col("doc_id") == F.col(other), "left_anti")
    again = cut(kept.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if again.isEmpty():
        return kept
    return kept.join(again, "doc_id", "left_anti").unionByName(kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item.

    Null, empty and wordless texts and rows with a null id stay; rows that repeat an id go together, and a
    similarity of just 0.8 counts. An empty table stays empty, and an empty benchmark leaves all.
    """
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text, a row for each row, repeated ones too.

    Null counts as empty. An empty table gives no rows.
    """
    return sentencepiece_codec.encode_decode(docs, tokenizer_file())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs)
    return docs
