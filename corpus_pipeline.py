"""The corpus pipeline: an ordered list of stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs.  All but the last return the
columns of ``documents``, whatever they are: further columns pass through unchanged,
also those named like a stage's helpers or the last one's result.

Defined cases, for all stages: an empty table gives an empty result; a null doc_id is
kept like any other; repeated rows are rows of their own until near duplicates go; a null
text counts as empty; texts are worked on whole, however long.  Each stage says
what becomes of null and empty texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import jaccard, lines, packing, quality, secrets
from tillroll.llm._stage import staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go.

    Null, empty and short texts (fewer than ten words) fail the base rules; without any
    labelled document only the base rules decide.  Repeated rows have one verdict."""
    return quality.filtered(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go from the text; no document goes.

    A null text stays null, a text that loses all lines becomes empty; of repeated rows of one
    id, which hold each line in one document only, none loses a line to the other."""
    return lines.dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the smallest doc_id (null after
    all others); of repeated rows of that id one stays.

    Null, empty and wordless texts are like nothing, so all of them stay."""
    return jaccard.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text and n_chars follows it; no document goes.

    A null text stays null, an empty one empty."""
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: a row for each packed piece; its columns are the packing's alone.

    Null and empty texts are one piece of one token, the id that ends a document."""
    return packing.pack(docs, packing.default_vocabulary())


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("secret_scan", secret_scan), ("best_fit_packing", best_fit_packing)]

#: Learned verdicts and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{name}")
    return docs
