"""Bringing an operator's verdicts back to whole rows without moving their texts.

Verdicts are functions of a row's content, so a key of the content stands for the row. Only rows
whose verdict differs from the usual one are listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.session import BROADCAST_ROWS, materialise


def content_key(docs: DataFrame) -> Column:
    """128 bits of all columns of a row; rows that are equal, nulls included, share it."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    nulls = F.concat(*(c.isNull().cast("int").cast("string") for c in columns))
    return F.struct(
        F.xxhash64(nulls, *columns).alias("k1"),
        F.xxhash64(F.lit("second"), *reversed(columns), nulls).alias("k2"),
    )


def labelled_sample(known: DataFrame, rows: int) -> DataFrame:
    """About `rows` of the rows of `known`, whose doc_id are distinct: those with the smallest hashes of it.

    All of them if there are fewer. Small enough to broadcast, whatever the size of `known`.
    """
    share = min(1.0, rows / max(1, known.count()))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    return known.where(place < int(share * (1 << 30)))


def with_verdicts(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """`docs` with the other columns of `verdicts` (`key` and one row each), null for rows not listed.

    The list is written, counted and broadcast up to the limit of a broadcast; a longer one is
    joined by shuffling both sides.
    """
    listed = materialise(verdicts.select(F.col("key").alias("_key"), *[c for c in verdicts.columns if c != "key"]), "verdicts")
    if listed.count() <= BROADCAST_ROWS:
        listed = F.broadcast(listed)
    return docs.withColumn("_key", content_key(docs)).join(listed, "_key", "left")
