"""The training-corpus pipeline: documents in, token digests out.

Each stage calls one operator of `voltrail.llm` on all rows its predecessor kept;
`run` writes every stage's rows to the shared folder and reads them back. All stages but
the last return the columns of documents.

1. Documents that the quality classifier rejects go.
2. Lines that ten documents or more share go; a text may end up empty.
3. One document of each group of near duplicates stays, that with the smallest doc_id.
4. Documents are taken as often as the mix takes them: not at all, once or twice.
5. What is left is encoded and decoded; one row of digests per row.

Empty tables pass through all stages; nulls, empty texts and repeated rows are handled
as each operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltrail.llm import bpe, line_dedup, mixing, quality, simhash_dedup
from voltrail.llm.common import stored, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = stored(quality.described(docs), "quality-traits")
    return quality.apply(docs, quality.train(rows))


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.apply(docs, line_dedup.keep_bitmaps(docs))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.apply(docs, simhash_dedup.grouped(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply(docs, mixing.mix(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.of_documents(docs)


STAGES = [
    ("quality classifier", good),
    ("line dedup", without_common_lines),
    ("SimHash near-dedup", without_near_copies),
    ("mixing", mixed),
    ("byte-level BPE", tokens),
]

#: The classifier, the fingerprints and the tokens can't be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = stored(stage(spark, rows, sf_dir), "corpus-" + name.replace(" ", "-"))
    return rows
