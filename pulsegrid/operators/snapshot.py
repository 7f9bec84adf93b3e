"""Features of a set of history rows per group: rates, moments, quantiles, trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.scalars import is_error_severity, slope_of_counts
from pulsegrid.operators.history import ARRIVAL, newest, recent
from pulsegrid.operators.joins import attach
from pulsegrid.operators.ordering import largest_group, running_counts
from pulsegrid.operators.quantiles import exact_quantile
from pulsegrid.session import GROUP_ROWS, PERCENTILE_ROWS

MEASURES = ("body_length", "duration_ms", "value")
ORDER = ("timestamp", "seq", "pos")
BINS = 5


def error_flag(basis: str = "severity") -> Column:
    """1.0 for an error row. History rows always carry a severity, so that is the
    default basis; 'is_error' counts failed spans instead."""
    if basis == "is_error":
        return F.col("is_error").cast("double")
    return is_error_severity(F.col("severity_number")).cast("double")


def _rates(window_minutes: float, error_basis: str) -> list[Column]:
    per_minute = F.count(F.lit(1)) / F.lit(float(max(window_minutes, 1)))
    columns = [
        per_minute.alias("messages_per_minute"),
        F.count_distinct("source").alias("unique_sources"),
        F.lit(window_minutes).cast("bigint").alias("window_minutes"),
        F.avg(error_flag(error_basis)).alias("error_rate"),
    ]
    for c in MEASURES:
        columns += [
            F.avg(c).alias(f"{c}_mean"),
            # one row has no deviation; report 0
            F.when(F.count(c) > 0, F.coalesce(F.stddev_samp(c), F.lit(0.0))).alias(f"{c}_std"),
            F.min(c).cast("double").alias(f"{c}_min"),
            F.max(c).cast("double").alias(f"{c}_max"),
        ]
    return [
        *columns,
        F.mode("hour", True).alias("peak_hour"),
        F.coalesce(F.var_samp("hour"), F.lit(0.0)).alias("hour_variance"),
    ]


def _known(column: str) -> Column:
    """A measure without NaN, as both ways to a quantile take it."""
    return F.when(~F.isnan(F.col(column).cast("double")), F.col(column))


def enhanced_features(
    records: DataFrame,
    window_minutes: float = 5,
    keys: tuple[str, ...] = ("topic",),
    error_basis: str = "severity",
    bounded: bool = False,
    group_rows: int = PERCENTILE_ROWS,
) -> DataFrame:
    """One row of features per group of already selected records.

    All measures but the 95th percentile combine map-side. The built-in
    `percentile` keeps a group's distinct values in one buffer, so it is used
    only for groups known (`bounded`) or counted to be small; beyond, the
    quantiles are located by digit counting and joined on.
    """
    keys = list(keys)
    rates = _rates(window_minutes, error_basis)
    if bounded or largest_group(records, keys)[0] <= group_rows:
        tails = [F.percentile(_known(c), F.lit(0.95)).alias(f"{c}_p95") for c in MEASURES]
        features = records.groupBy(*keys).agg(*rates, *tails)
    else:
        tails = exact_quantile(records, keys, list(MEASURES), 0.95)
        tails = tails.select(*keys, *[F.col(f"{c}_q").alias(f"{c}_p95") for c in MEASURES])
        features = records.groupBy(*keys).agg(*rates).join(tails, keys, "left")
    variations = [
        F.when(F.col(f"{c}_mean") > 0, F.col(f"{c}_std") / F.col(f"{c}_mean"))
        .when(F.col(f"{c}_mean").isNotNull(), F.lit(0.0))
        .alias(f"{c}_cv")
        for c in MEASURES
    ]
    ordered = ["messages_per_minute", "unique_sources", "window_minutes", "error_rate"]
    for c in MEASURES:
        ordered += [f"{c}_{m}" for m in ("mean", "std", "p95", "cv", "min", "max")]
    return features.select("*", *variations).select(*keys, *ordered, "peak_hour", "hour_variance")


def trend(
    records: DataFrame,
    column: str,
    keys: tuple[str, ...] = ("topic",),
    order: tuple[str, ...] = ORDER,
    group_rows: int = GROUP_ROWS,
    bounded: bool = False,
) -> DataFrame:
    """Least-squares slope of `column` against its position 0..n-1 in `order`; 0 below two values."""
    valid = records.filter(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
    placed = running_counts(valid, list(keys), list(order), {"_place": F.lit(True)}, group_rows, bounded)
    return placed.groupBy(*keys).agg(slope(F.col(column), F.col("_place")).alias("trend"))


def slope(y: Column, x: Column) -> Column:
    return F.coalesce(F.regr_slope(y.cast("double"), x.cast("double")), F.lit(0.0))


def aggregated_row(
    history: DataFrame,
    window_start,
    window_end,
    window_minutes: int = 5,
    keys: tuple[str, ...] = ("topic",),
    history_limit: int | None = None,
    as_of=None,
    open_end: bool = False,
    group_rows: int = GROUP_ROWS,
    arrival: tuple[str, ...] = ARRIVAL,
) -> DataFrame:
    """The per-topic row of a batch: features of the last minutes before its end.

    All rows count, by distributed paths where a group is large. `history_limit` keeps the newest
    rows of a group only. A group without a known value has trend 0.
    """
    as_of = window_end if as_of is None else as_of
    kept = history if history_limit is None else newest(history, history_limit, keys, arrival)
    rows = recent(kept, as_of, window_minutes, open_end)
    percentile_rows = min(group_rows, PERCENTILE_ROWS)
    bounded = history_limit is not None and history_limit <= percentile_rows
    key_list = list(keys)
    features = enhanced_features(
        rows, window_minutes, keys, bounded=bounded, group_rows=percentile_rows
    )
    slopes = trend(rows, "value", keys, group_rows=group_rows, bounded=bounded)
    return features.join(slopes, key_list, "left").select(
        *key_list,
        F.lit(window_start).cast("timestamp").alias("window_start"),
        F.lit(window_end).cast("timestamp").alias("window_end"),
        "window_minutes",
        "messages_per_minute",
        "error_rate",
        "unique_sources",
        F.col("body_length_mean").alias("avg_body_length"),
        F.col("duration_ms_mean").alias("avg_duration_ms"),
        F.col("duration_ms_p95").alias("p95_duration_ms"),
        F.coalesce("trend", F.lit(0.0)).alias("trend_coefficient"),
    )


# ---- sliding windows at one instant -------------------------------------


def _bin(ts: Column, low: Column, high: Column) -> Column:
    """Equal-width bin of a time inside [low, high]: right-closed, lowest included;
    a zero-width range puts everything into the middle bin."""
    share = F.ceil((ts - low) * BINS / (high - low)) - 1
    return F.when(high == low, F.lit(BINS // 2)).otherwise(F.greatest(F.lit(0), share))


def sliding_snapshot(
    history: DataFrame,
    as_of,
    windows: tuple[int, ...] = (5, 15, 60),
    keys: tuple[str, ...] = ("topic",),
    error_basis: str = "severity",
    group_rows: int = GROUP_ROWS,
    open_end: bool = False,
) -> DataFrame:
    """Window features of every group at `as_of`, all windows in one pass.

    The windows share their end, so each is a suffix of the longest and a slope
    against the position in the longest equals the slope against its own.
    A group with history but an empty window gets zeros for it.
    """
    keys = list(keys)
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    rows = recent(history, as_of, max(windows), open_end)
    places = {f"_{c}_place": F.col(c).isNotNull() for c in ("value", "duration_ms")}
    placed = running_counts(rows, keys, list(ORDER), places, group_rows)
    micros = F.unix_micros("timestamp")
    end = F.unix_micros(as_of)

    def inside(w: int) -> Column:
        return micros >= end - w * 60_000_000

    columns = []
    for w in windows:
        only = inside(w)
        n = F.count(F.when(only, 1))
        several = n > 1
        place = {c: F.when(only, F.col(f"_{c}_place")) for c in ("value", "duration_ms")}
        columns += [
            (n / F.lit(float(max(w, 1)))).alias(f"avg_messages_{w}m"),
            F.coalesce(F.avg(F.when(only, error_flag(error_basis))), F.lit(0.0)).alias(f"error_rate_{w}m"),
            slope(F.col("value"), place["value"]).alias(f"trend_{w}m"),
            F.when(several, slope(F.col("duration_ms"), place["duration_ms"])).alias(f"duration_trend_{w}m"),
            F.when(several, F.avg(F.when(only, F.col("duration_ms")))).alias(f"avg_duration_{w}m"),
            F.min(F.when(only, micros)).alias(f"_low_{w}"),
            F.max(F.when(only, micros)).alias(f"_high_{w}"),
        ]
    features = placed.groupBy(*keys).agg(*columns)

    limits = features.select(*keys, *[f"_{side}_{w}" for w in windows for side in ("low", "high")])
    binned = attach(rows, limits, keys, spread_by=["seq", "pos"])
    counts = []
    for w in windows:
        bin_ = _bin(micros, F.col(f"_low_{w}"), F.col(f"_high_{w}"))
        counts.append(
            F.array(*[F.count(F.when(inside(w) & (bin_ == b), 1)) for b in range(BINS)]).alias(f"_bins_{w}")
        )
    volumes = binned.groupBy(*keys).agg(*counts)
    volumes = volumes.select(
        *keys,
        *[
            F.when(F.aggregate(f"_bins_{w}", F.lit(0).cast("bigint"), lambda a, c: a + c) > 1,
                   slope_of_counts(F.col(f"_bins_{w}"))).alias(f"volume_trend_{w}m")
            for w in windows
        ],
    )
    names = ("avg_messages", "error_rate", "trend", "volume_trend", "duration_trend", "avg_duration")
    known = history.select(*keys).distinct()
    result = known.join(features, keys, "left").join(volumes, keys, "left")
    zeros = {f"{n}_{w}m": 0.0 for n in names[:3] for w in windows}
    return result.fillna(zeros).select(*keys, *[f"{n}_{w}m" for w in windows for n in names])
