"""The corpus pipeline: documents through five of the dealt operators, in order.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; every stage but the last returns the columns of ``documents``.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trawl.llm import langid, linededup, mixing, ngramjoin, packing  # noqa: E402
from trawl.llm.common import WORD, Scratch, table, written  # noqa: E402
from trawl.llm.queries import tokenizer_path  # noqa: E402

#: As langid.has_letter, for where nothing was learned and no row has a score.
LETTER = r"\p{L}"


def language(spark, docs, sf_dir):
    """Operator 2: documents without letters (null and empty texts too) go, whatever their score; ``lang`` becomes
    the language identified in the text, by which the sequences are packed. Without any label to learn from it is ``und``."""
    names, weights = langid.fit(docs, F.col("text"), F.col("lang"), F.col("doc_id"))
    told = langid.identify(docs, names, weights)
    kept = told.where(F.col("score") > 0 if names else F.col("text").rlike(LETTER))  # only a text without letters scores 0
    return kept.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def line_dedup(spark, docs, sf_dir):
    """Operator 6: later copies of repeated line runs go, and documents of nothing else."""
    d = linededup.dedup(docs).where((F.col("_deleted") == 0) | F.col("text").rlike(WORD))
    return d.withColumn("n_chars", F.when(F.col("_deleted") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))) \
        .select(*docs.columns)


def own_ids(docs, temp):
    """``docs`` with _node: the doc_id where it is one row's, else a number above all ids for each different text that
    shares it; of rows equal in doc_id and text one is left, the first by its other columns. Rows without a doc_id have none."""
    top = docs.agg(F.max("doc_id")).first()[0]
    many = temp.written(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "shared-ids")
    if many.isEmpty():
        return docs.withColumn("_node", F.col("doc_id"))
    text = F.coalesce(F.sha2("text", 256), F.lit("")).alias("_text")
    shared = docs.join(many, "doc_id", "left_semi").select("*", text)
    ranks = linededup.numbered(shared.select("doc_id", "_text").distinct(), ["doc_id", "_text"], "_rank", temp)
    first = F.row_number().over(Window.partitionBy("doc_id", "_text").orderBy(F.xxhash64("lang", "source", "n_chars")))
    shared = shared.withColumn("_first", first).where("_first = 1").join(ranks, ["doc_id", "_text"])
    alone = docs.join(many, "doc_id", "left_anti").withColumn("_node", F.col("doc_id"))  # null ids too
    return alone.unionByName(shared.select(*docs.columns, (F.lit(top) + F.col("_rank")).alias("_node")))


def near_duplicates(spark, docs, sf_dir):
    """Operator 3 with five words and 0.8: one document of each group stays, the one with the smallest doc_id.

    Rows without a doc_id stay. Different texts of one doc_id are different documents, which
    stay unless they are in a group; of rows equal in doc_id and text one stays. A null text is in no group."""
    temp = Scratch(spark)
    nodes = own_ids(docs, temp)
    found = ngramjoin.similar_components(nodes, width=5, num=80, den=100, id_col="_node")
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_node")).distinct()
    kept = nodes.where("_node is not null").join(gone, "_node", "left_anti")
    return kept.select(*docs.columns).unionByName(nodes.where("_node is null").select(*docs.columns))


def mix_sources(spark, docs, sf_dir):
    """Operator 4: each document as often as the mix takes it. A null source is a source; a null text has no words and is taken once."""
    m = mixing.mix(docs).where("_copies > 0")
    often = m.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    return often.select(*[F.col(f"`{c}`") for c in docs.columns])


def pack_sequences(spark, docs, sf_dir):
    """Operator 9: the pieces of all documents in sequences of 2048 ids, each of documents of one language."""
    return packing.pack(docs, tokenizer_path(), group_col="lang")


STAGES = [
    ("language ID", language),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: SQL cannot express a trained network or the packing; tests/llm checks every stage against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``, each written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
