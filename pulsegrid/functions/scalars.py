"""Small column expressions shared by the operators: clocks, numbers, JSON checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- JSON ---------------------------------------------------------------


def json_object(text: Column) -> Column:
    """The text as a variant if all of it is one JSON object, strictly read, repeated keys allowed; else NULL.

    A parser reads one value and stops behind it, so the text is read once as the first element of a list
    whose second is a hash of the text: only where the text is exactly one value does the hash come
    second.
    """
    seal = F.xxhash64(text)
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), seal.cast("string"), F.lit("]")))
    # the parsed list is looked at twice, so it is bound to a name
    sealed = F.transform(
        F.array(listed),
        lambda v: F.when(
            F.equal_null(F.try_variant_get(v, "$[1]", "bigint"), seal) & text.rlike(r"^[ \t\r\n]*\{"),
            F.try_variant_get(v, "$[0]", "variant"),
        ),
    )
    return F.get(sealed, F.lit(0))


def is_json_object(text: Column) -> Column:
    """Whether the whole text is one JSON object, see `json_object`."""
    return json_object(text).isNotNull()


def is_filled(document: Column) -> Column:
    """A stored document counts as present when it is neither NULL nor ''."""
    return F.coalesce(document != "", F.lit(False))


def json_float(document: Column, key: str) -> Column:
    """A numeric JSON field; 0 when the document is empty or the field missing."""
    return F.coalesce(F.get_json_object(document, f"$.{key}").try_cast("double"), F.lit(0.0))


# ---- clocks -------------------------------------------------------------


def nanos(text: Column) -> Column:
    """Unix nanoseconds as BIGINT; missing, unparsable and zero all mean unknown."""
    return F.nullif(text.try_cast("bigint"), F.lit(0).cast("bigint"))


def nanos_to_ts(text: Column, default: Column) -> Column:
    """Unix nanoseconds to a timestamp, rounded to the microsecond."""
    micros = F.rint(nanos(text) / F.lit(1000)).cast("bigint")
    return F.coalesce(F.timestamp_micros(micros), default)


def parse_instant(text: Column) -> Column:
    """ISO-8601 text to a timestamp; 'Z' and offsets honoured, none means UTC, bad is NULL."""
    return F.try_to_timestamp(text)


def iso(ts: Column) -> Column:
    """ISO-8601 with offset; the fraction appears only when there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
    fraction = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.unix_micros(ts) % 1_000_000 == 0, whole).otherwise(fraction)


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


# ---- numbers ------------------------------------------------------------


def number(text: Column) -> Column:
    """Lenient numeric coercion: what is not a number becomes NULL (NaN too)."""
    x = text.try_cast("double")
    return F.when(~F.isnan(x), x)


def whole_number(text: Column) -> Column:
    """Text of a whole number, also as 17.0 or 1.7e1, as an integer; NULL for anything else."""
    x = text.try_cast("double")
    return F.when(x == F.floor(x), x.try_cast("int"))


def ratio(part: Column, whole: Column) -> Column:
    """part / max(whole, 1)."""
    return part / F.greatest(whole, F.lit(1))


def one_minus_clamped(share: Column) -> Column:
    """1 - min(1, share)."""
    return F.lit(1.0) - F.least(F.lit(1.0), share)


def present(x: Column, digits: int) -> Column:
    """Rounding for display; NULL and NaN become 0.

    Rounds the stored binary value, half to even, so 2.675 (which is stored as
    2.67499999...) gives 2.67. The rounding error of `x * scale` is recovered
    exactly from the high and low halves of x and decides near-ties.
    """
    scale = F.lit(10.0**digits)
    carry = x * F.lit(134217729.0)  # 2**27 + 1 splits the 53-bit mantissa
    high = carry - (carry - x)
    product = x * scale
    error = (high * scale - product) + (x - high) * scale
    below = F.floor(product).cast("double")
    side = (product - below - F.lit(0.5)) + error
    up = (side > 0) | ((side == 0) & (below % 2 != 0))
    rounded = (below + F.when(up, F.lit(1.0)).otherwise(F.lit(0.0))) / scale
    return (
        F.when(x.isNull() | F.isnan(x), F.lit(0.0))
        .when(F.abs(product) >= 2.0**53, x)  # no digits left to round
        .otherwise(rounded)
    )


def slope_of_counts(counts: Column) -> Column:
    """Least-squares slope of the non-zero entries of an array against 0..n-1."""
    kept = F.filter(counts, lambda c: c > 0)
    n = F.size(kept)
    centre = (n - 1) / F.lit(2.0)
    covariance = F.aggregate(
        F.transform(kept, lambda c, i: (i - centre) * c), F.lit(0.0), lambda acc, v: acc + v
    )
    spread = n * (n * n - 1) / F.lit(12.0)
    return F.when(n < 2, F.lit(0.0)).otherwise(F.try_divide(covariance, spread))


# ---- severity and status ------------------------------------------------

# Application log levels and the OTLP severity they map to.
LEVEL_SEVERITY = ((400, 17), (300, 13), (200, 9))
LOWEST_SEVERITY = 5

# Fixed value: OTLP severity numbers from here on are errors.
ERROR_SEVERITY = 17


def severity_from_level(level: Column) -> Column:
    result = F.lit(LOWEST_SEVERITY)
    for floor, severity in reversed(LEVEL_SEVERITY):
        result = F.when(level >= floor, F.lit(severity)).otherwise(result)
    return result


def status_from_http(code: Column) -> Column:
    """OTLP status code: 2 (error) from HTTP 500 on, else 1 (ok)."""
    return F.when(code >= 500, F.lit(2)).otherwise(F.lit(1))


def is_error_severity(severity: Column) -> Column:
    return severity >= ERROR_SEVERITY
