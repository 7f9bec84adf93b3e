"""Attaching an aggregate to the rows it was made from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.session import BROADCAST_ROWS, materialise

SALTS = 64


def attach(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread_by: list[str],
    how: str = "left",
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join a per-key aggregate onto many rows without moving hot keys to one task.

    The aggregate is written once and counted. Up to `limit` rows it is
    broadcast. Beyond, each of its rows is repeated for every salt and the left
    rows are spread over the salts by a hash of `spread_by`, columns that vary
    inside a key, so a key holding a third of the rows still fills 64 tasks.
    """
    right = materialise(right, "attach")
    if right.count() <= limit:
        return left.join(F.broadcast(right), on, how)
    salted = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = left.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("int"))
    return spread.join(salted, [*on, "_salt"], how).drop("_salt")
