"""A bounded sample of labelled documents to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, text_of

SAMPLE_ROWS = 20_000  # labelled documents a classifier is fitted on, about; all if there are fewer
HELD_OUT_OF = 5


def held_out(id_col: str = "doc_id"):
    return remainder(id_col, HELD_OUT_OF) == 0


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Rows (text, label) of labelled documents that are not held out.

    Of more labelled documents than `rows`, those with the smallest hashes of their id are
    taken: about `rows`, spread over everything. Only their ids are broadcast, no more than
    the bound. Labels other than 0 and 1 and NULL ids are left out; of contradicting
    labels the larger counts; documents of one id all take its label.
    """
    known = (
        labels.select(F.col("doc_id").alias("labelled"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("labelled").isNotNull() & F.col("label").isin(0, 1) & ~held_out("labelled"))
        .groupBy("labelled")
        .agg(F.max("label").alias("label"))
    )
    steps = 1 << 30
    share = min(steps, steps * rows // max(1, known.count()))
    some = known.where(F.pmod(F.xxhash64("labelled"), F.lit(steps)) < share)
    return (
        docs.select(F.col("doc_id").alias("labelled"), text_of("text").alias("text"))
        .join(F.broadcast(some), "labelled")
        .select("text", "label")
    )
