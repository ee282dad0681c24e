"""The corpus pipeline: each stage calls one operator of ``halyard.llm`` on what the stage before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents. In every stage null, empty and blank texts are
texts without words (a null text stays null), texts of any length are taken
whole, repeated rows are judged alike, a null doc_id is an id like any other,
an empty table gives no rows, and columns beyond those of documents stay as
they are whatever their names. ``run`` writes each stage's rows to the shared
checkpoint folder and reads them back for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halyard.llm import decontaminate, line_templates, quality, simhash, trie_bpe
from halyard.llm.common import cleared, discard, durable, table


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts; it learns from labelled documents that are not held out.

    Of repeated rows all or none stay; texts without words are judged by the
    score of none. Without labels of both classes every text has one score.
    """
    return quality.keep_accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of recurring templates; n_chars follows the text.

    All rows stay; a text may become empty; repeated rows lose the same lines; a
    null text stays null, its n_chars too.
    """
    # the row travels as one column, so no name of its columns meets one of the operator's
    kept = line_templates.drop_templates(docs.select("doc_id", "text", F.struct(*docs.columns).alias("all")))
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)}
    return kept.select(*[changed.get(c, F.col("all").getField(c)).alias(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest doc_id, once.

    Texts without words are one group; a row without doc_id stays only where its
    group has no other.
    """
    return simhash.drop_near_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item.

    Texts without words contain none and stay; repeated rows go or stay together.
    """
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of each document: doc_id, n_tokens, ids, decoded, a row for each row.

    Texts without words have no ids and an empty decoded text.
    """
    coded = trie_bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality classifier", accept_quality),
    ("line dedup", drop_recurring_lines),
    ("simhash near-dedup", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("bpe encoding", encode),
]

#: The classifier and the tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents. What a stage has written is deleted once its rows stand, and its rows once the next stage's do."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with cleared(spark) as kept:
            docs, path = durable(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
            kept.add(path)
        if before:
            discard(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
