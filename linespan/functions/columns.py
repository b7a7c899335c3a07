"""Column functions for feed text: cleaning, typed parsing, hashing, keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits of the timetable contract.
FIELD_SEPARATOR = "\x1f"
MAX_CALL_HOUR = 596522
PLAIN_DECIMAL = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)\s*$"
HEX_COLOUR = "^[0-9A-Fa-f]{6}$"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trimmed(value: Column | str) -> Column:
    """Text without surrounding spaces; blanks stay blank."""
    return F.trim(as_column(value))


def cleaned(value: Column | str) -> Column:
    """Text without surrounding spaces; blanks become NULL."""
    return F.nullif(trimmed(value), F.lit(""))


def is_blank(value: Column | str) -> Column:
    return cleaned(value).isNull()


def small_number(value: Column | str) -> Column:
    """SMALLINT or NULL when the text is not one."""
    return as_column(value).try_cast("smallint")


def whole_number(value: Column | str) -> Column:
    """INT or NULL when the text is not one."""
    return as_column(value).try_cast("int")


def plain_decimal(value: Column | str, precision: int, scale: int) -> Column:
    """Decimal or NULL; exponent notation is not accepted."""
    text = as_column(value)
    return F.when(text.rlike(PLAIN_DECIMAL), text.try_cast(f"decimal({precision},{scale})"))


def coordinate(value: Column | str) -> Column:
    return plain_decimal(value, 9, 6)


def distance(value: Column | str) -> Column:
    return plain_decimal(value, 18, 3)


def feed_date(value: Column | str) -> Column:
    """Date from yyyymmdd text, or NULL."""
    text = trimmed(value)
    return F.when(text.rlike("^[0-9]{8}$"), F.try_to_date(text, "yyyyMMdd"))


def date_key(value: Column | str) -> Column:
    """yyyymmdd as a number."""
    day = as_column(value)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def call_seconds(value: Column | str) -> Column:
    """Seconds since the start of the service day from H+:MM:SS text.

    Hours may pass 24. Anything that is not three numbers in range is NULL.
    """
    text = trimmed(value)
    hour = F.substring_index(text, ":", 1).try_cast("int")
    minute = F.substring_index(F.substring_index(text, ":", 2), ":", -1).try_cast("int")
    second = F.substring_index(text, ":", -1).try_cast("int")
    two_colons = F.length(text) - F.length(F.replace(text, F.lit(":"), F.lit(""))) == 2
    return F.when(
        two_colons
        & hour.between(0, MAX_CALL_HOUR)
        & minute.between(0, 59)
        & second.between(0, 59),
        hour * 3600 + minute * 60 + second,
    )


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the raw values in declared order; blanks count as ''."""
    values = [F.coalesce(F.col(name), F.lit("")) for name in columns]
    return F.sha2(F.concat_ws(FIELD_SEPARATOR, *values), 256)


def packed_hash(name: str, prefix: str = "") -> list[Column]:
    """A hash in hex as 32 bytes, which a shuffle moves in half the space; any other text as it is.

    Two texts are equal exactly where both columns are.
    """
    text = F.col(name)
    packed = F.unhex(text)
    exact = F.lower(F.hex(packed)) == text
    return [
        F.when(exact, packed).alias(f"{prefix}_packed_hash"),
        F.when(~F.coalesce(exact, F.lit(False)), text).alias(f"{prefix}_other_hash"),
    ]


def unpacked_hash(prefix: str = "") -> Column:
    """The text that ``packed_hash`` packed."""
    return F.coalesce(F.lower(F.hex(f"{prefix}_packed_hash")), f"{prefix}_other_hash")


def version_key(snapshot: Column | int, business_key: Column | str) -> Column:
    """Surrogate key ``snapshot:id``.

    Deterministic and exact: no shared counter, no global sort, no collisions,
    and a rerun gives the same key.
    """
    number = F.lit(snapshot) if isinstance(snapshot, int) else snapshot
    return F.concat(number.cast("string"), F.lit(":"), as_column(business_key))


def differs(left: Column | str, right: Column | str) -> Column:
    """NULL-aware inequality."""
    return ~as_column(left).eqNullSafe(as_column(right))
