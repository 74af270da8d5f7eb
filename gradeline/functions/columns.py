"""Column expressions. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Number syntax, band limits, sigma map, text clean-up patterns, masks and time formats.
NUMBER_PATTERN = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"
BANDS_CODE = ((0.7, "strong"), (0.4, "medium"))
BANDS_TEXT = ((0.3, "strong"), (0.15, "medium"), (0.05, "weak"))
SIGMA_SPAN = 3.0
PROFILE_MAX = 10.0
SIGNIFICANT_GAP = 1.0
CONTROL_CHARS = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
FILE_NAME_CHARS = r'[<>:"/\\|?*]'
FILE_NAME_LENGTH = 50
MASK_STARS = 10
MASK_TAIL = 5
LOG_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
REPORT_TIME_FORMAT = "yyyy-MM-dd HH:mm"
CLASS_NAMES = {0: "bad", 1: "good"}

# Fixed value: a date, a time with or without seconds and fraction, an offset.
TIME_PATTERN = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?([+-]\d{2}:?\d{2})?)?$"
HASH_DIGITS = 13  # 52 bits: every hash is exactly representable as a double


def nan_to_null(c: Column) -> Column:
    """NaN counts as missing. ``c`` appears once, so an expensive expression is not evaluated twice."""
    return F.nanvl(c, F.lit(None).cast("double"))


def to_number(c: Column) -> Column:
    """Text to double; text that is not a plain number (NaN included) becomes NULL."""
    text = c.cast("string")
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def number_or_default(c: Column, default: float = 0.0) -> Column:
    """Missing or unreadable input becomes ``default``."""
    return F.coalesce(to_number(c), F.lit(float(default)))


def label_code(c: Column, label_map: Mapping[str, int]) -> Column:
    """Class of a label spelling in any case; NULL when the spelling is unknown."""
    key = F.lower(c.cast("string"))
    code = F.lit(None).cast("int")
    for spelling, value in label_map.items():
        code = F.when(key == spelling, F.lit(int(value))).otherwise(code)
    return code


def class_name(c: Column, names: Mapping[int, str] = CLASS_NAMES) -> Column:
    """Display name of a class code; NULL for an unknown code."""
    name = F.lit(None).cast("string")
    for value, text in names.items():
        name = F.when(c.cast("int") == value, F.lit(text)).otherwise(name)
    return name


def z_score(c: Column, mean: Column, std: Column) -> Column:
    """Distance from the mean in population standard deviations; a constant column divides by 1."""
    return (c - mean) / F.coalesce(F.nullif(std, F.lit(0.0)), F.lit(1.0))


def sigma_scale(z: Column) -> Column:
    """Map standard scores from [-3, 3] onto [0, 10], without clamping."""
    return (z + F.lit(SIGMA_SPAN)) / F.lit(2 * SIGMA_SPAN) * F.lit(PROFILE_MAX)


def strength_band(
    r: Column,
    thresholds: Sequence[tuple[float, str]] = BANDS_CODE,
    lowest: str = "weak",
) -> Column:
    """Name of the band |r| falls in; thresholds are inclusive and ordered downwards."""
    size = F.abs(r)
    band = F.lit(lowest)
    for limit, name in reversed(list(thresholds)):
        band = F.when(size >= F.lit(float(limit)), F.lit(name)).otherwise(band)
    return F.when(r.isNotNull(), band)


def direction(r: Column) -> Column:
    return F.when(r > 0, "positive").when(r < 0, "negative").when(r == 0, "none")


def advantage(gap: Column) -> Column:
    """Which class has the higher average."""
    return F.when(gap > 0, "good_higher").when(gap < 0, "bad_higher").when(gap == 0, "equal")


def is_significant(gap: Column) -> Column:
    return F.abs(gap) > F.lit(SIGNIFICANT_GAP)


def changed_fields(pairs: Sequence[tuple[str, Column, Column]]) -> Column:
    """Names of the fields whose given value differs from the old one; a NULL value means not given."""
    names = [
        F.when(new.isNotNull() & ~new.eqNullSafe(old), F.lit(name)) for name, old, new in pairs
    ]
    return F.array_compact(F.array(*names))


def first_missing(fields: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first required field that is NULL, or NULL when all are present."""
    return F.coalesce(*[F.when(c.isNull(), F.lit(name)) for name, c in fields])


def parse_time(c: Column) -> Column:
    """ISO or ``yyyy-MM-dd HH:mm:ss`` text to timestamp; a trailing Z is ignored; NULL when unreadable.

    The whole text must be a date, with or without a time; a time of day, a year or a month alone is unreadable.
    """
    text = F.regexp_replace(F.trim(c), "Z$", "")
    return F.when(text.rlike(TIME_PATTERN), F.try_to_timestamp(text))


def parse_string_list(c: Column) -> Column:
    """JSON list text to array; bad or missing text gives an empty array."""
    parsed = F.from_json(c, "array<string>")
    return F.coalesce(parsed, F.array().cast("array<string>"))


def strip_control(c: Column) -> Column:
    """Remove control characters, keeping line feeds, carriage returns and tabs."""
    return F.regexp_replace(c, CONTROL_CHARS, "")


def safe_name(c: Column) -> Column:
    """Text usable as a file name: no reserved characters, no blanks, at most 50 characters."""
    no_reserved = F.regexp_replace(c, FILE_NAME_CHARS, "_")
    return F.substring(F.regexp_replace(no_reserved, r"\s+", "_"), 1, FILE_NAME_LENGTH)


def report_time(key: Column) -> Column:
    """Timestamp of a ``date_time_name`` key; NULL when the key has no readable time."""
    parts = F.split(key, "_")
    stamp = F.concat_ws(" ", F.get(parts, 0), F.regexp_replace(F.get(parts, 1), "-", ":"))
    return F.when(F.size(parts) >= 3, F.try_to_timestamp(stamp, F.lit(REPORT_TIME_FORMAT)))


def report_name(key: Column, fallback: str = "unknown") -> Column:
    """Name part of a ``date_time_name`` key with blanks restored."""
    parts = F.split(key, "_")
    name = F.array_join(F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(0))), " ")
    return F.when(report_time(key).isNotNull(), name).otherwise(F.lit(fallback))


def mask_secret(c: Column) -> Column:
    """Keep only the last five characters of a long secret; short ones vanish; empty stays empty."""
    tail = F.concat(F.lit("*" * MASK_STARS), F.right(c, F.lit(MASK_TAIL)))
    return (
        F.when(F.coalesce(F.length(c), F.lit(0)) == 0, "")
        .when(F.length(c) > MASK_TAIL, tail)
        .otherwise("*" * MASK_TAIL)
    )


def sample_hash(seed: int, *keys: Column) -> Column:
    """Uniform draw in [0, 2^52) that depends on the seed and the row key only."""
    text = F.concat_ws("-", *[k.cast("string") for k in keys])
    digest = F.md5(F.concat(F.lit(f"{seed}:"), text))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("double")
