"""Keys, ids, lenient parsing and text clean-up (pure Column functions)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
MESSAGE_LIMIT = 1000
MESSAGE_SUFFIX = " … (truncated; see run summary)"
LABEL_LIMIT = 63


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*columns: Column | str) -> Column:
    """MD5 of the natural key's parts joined by '-', NULL parts spelled out."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def timestamp_run_id(started_at: Column | str) -> Column:
    """Sortable id of a run: its UTC start time with microseconds."""
    return F.date_format(_col(started_at), "yyyyMMdd'T'HHmmssSSSSSS'Z'")


def run_id(started_at: Column | str) -> Column:
    """timestamp_run_id plus eight random hex digits, unique even for equal starts."""
    suffix = F.substring(F.regexp_replace(F.uuid(), "-", ""), 1, 8)
    return F.concat(timestamp_run_id(started_at), F.lit("-"), suffix)


def lenient_date(value: Column | str) -> Column:
    """Date of a text or timestamp column, NULL where it cannot be read."""
    return lenient_timestamp(value).cast("date")


def lenient_timestamp(value: Column | str) -> Column:
    """Instant, NULL where it cannot be read. A time of day without a date, which
    Spark reads as today, counts as unreadable."""
    dated = _col(value).cast("string").rlike(r"^\s*[+-]?\d{4}")
    return F.when(dated, _col(value).try_cast("timestamp"))


def lenient_number(value: Column | str) -> Column:
    """Number in a text column, NULL where it cannot be read.

    Spark also reads '1d', '1f', '0x1p3' and 'NaN'; here they count as unreadable.
    """
    text = _col(value).cast("string")
    end = F.lower(F.substring(F.rtrim(text, F.lit(" \t\r\n")), -3, 3))
    typed_suffix = F.substring(end, -1, 1).isin("d", "f") & (end != "inf")
    return F.when(~typed_suffix & ~text.rlike("(?i)0x"), F.nullif(text.try_cast("double"), F.lit(float("nan"))))


def redact_tokens(text: Column | str) -> Column:
    """Replace the value of every ``token=...`` in a text by ``***``."""
    return F.regexp_replace(_col(text), r"(?iU)(token=)[^&\s'\"]+", "$1***")


def short_message(text: Column | str, limit: int = MESSAGE_LIMIT, suffix: str = MESSAGE_SUFFIX) -> Column:
    """Cap a message at ``limit`` characters, the suffix included."""
    text = _col(text)
    cut = F.concat(F.substring(text, 1, limit - len(suffix)), F.lit(suffix))
    return F.when(F.length(text) > limit, cut).otherwise(text)


def label_value(text: Column | str) -> Column:
    """Lower-case label of at most 63 letters, digits, '_' and '-'."""
    return F.substring(F.regexp_replace(F.lower(_col(text)), "[^a-z0-9_-]", "_"), 1, LABEL_LIMIT)


def has_label(labels: Column | str, key: str, pattern: str) -> Column:
    """Whether an array of (key, value) structs holds the key with a matching value."""
    return F.exists(
        _col(labels),
        lambda label: (label["key"] == key) & label["value"].like(pattern),
    )


def not_finite(value: Column | str) -> Column:
    """NaN or an infinity; a NULL value is neither."""
    value = _col(value)
    return F.isnan(value) | (F.abs(value) == F.lit(float("inf")))


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """NULL instead of an error for a zero denominator."""
    return F.try_divide(_col(numerator), _col(denominator))


def fixed_decimals(value: Column | str, digits: int) -> Column:
    """A number with so many decimals, rounded from its exact value and from ties to the
    even digit, as Python and C do; ``format_string`` rounds its shortest spelling half up."""
    return F.call_function("format_number", _col(value), F.lit("0." + "0" * digits))
