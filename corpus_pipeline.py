"""From raw documents to packed training sequences in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but
the last return the columns of ``docs``.  ``run`` applies them to the table
``documents``, writing each stage's result as Parquet into the shared folder
for the next.  Null and empty texts pass the first four stages like others
(as near duplicates they count as one text) and end as the end token alone;
empty input gives an empty result; other columns pass unchanged, but
``n_chars`` follows the text where lines go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepcurve.llm.common import materialise, remainder, table
from keepcurve.llm.line_dedup import without_boilerplate
from keepcurve.llm.mixing import mixed_documents
from keepcurve.llm.packing import pack_documents
from keepcurve.llm.queries import tokenizer_path
from keepcurve.llm.simhash import MAX_DISTANCE, SHINGLE_WORDS, one_per_group
from keepcurve.llm.toxicity import fit_toxicity, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, learned from four fifths of the labels, calls
    toxic go."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels").where(remainder(5) != 0))
    return without_toxic(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go from all documents but their first; no document goes."""
    return without_boilerplate(docs, length_col="n_chars", copies_once=True)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return one_per_group(docs, shingle_words=SHINGLE_WORDS, max_distance=MAX_DISTANCE)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces; a document that the mix repeats is packed as often."""
    p = pack_documents(docs, tokenizer_path())
    return p.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# Neither the learned toxicity model nor XXH64 fingerprints can be had in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
