"""Predicates and normalisers for untrusted record fields. A predicate is never null: what cannot be read is invalid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a time has to look. A zone offset is required, so that no reader guesses one.
ISO_WITH_OFFSET = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|z|[+-]\d{2}:?\d{2})$"
HEX_32 = "^([0-9a-f]{8})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{12})$"
CANONICAL_UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
INTEGER = r"^\s*[+-]?\d+(\.0+)?\s*$"
DECIMAL = r'(?i)^(\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*|"[+-]?(inf|infinity|nan)")$'
WITHOUT_SECONDS = r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2})(Z|z|[+-]\d{2}:?\d{2})$"


def sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def non_empty(text: Column) -> Column:
    return sure(F.length(text) > 0)


def number(text: Column) -> Column:
    """A number sent as a number or as text; null for anything else. Bare NaN and infinity come with quotes around."""
    return F.when(text.rlike(DECIMAL), F.btrim(text, F.lit('"')).try_cast("double"))


def whole_number(text: Column, kind: str = "bigint") -> Column:
    return F.when(text.rlike(INTEGER), F.regexp_replace(F.trim(text), r"\.0+$", "").try_cast(kind))


def boolean(text: Column) -> Column:
    return F.when(F.lower(text).isin("true", "1", "t", "yes", "y", "on"), F.lit(True)).when(
        F.lower(text).isin("false", "0", "f", "no", "n", "off"), F.lit(False)
    )


def has_offset(text: Column) -> Column:
    return sure(text.rlike(ISO_WITH_OFFSET))


def aware_timestamp(text: Column) -> Column:
    """A time that names its offset, or counts seconds (milliseconds beyond 2e10) since 1970; null for anything else."""
    count = number(text)
    seconds = F.when(F.abs(count) > F.lit(2e10), count / 1000).otherwise(count)
    return F.when(
        has_offset(text), F.try_to_timestamp(F.regexp_replace(F.upper(text), WITHOUT_SECONDS, "$1:00$2"))
    ).when(
        F.abs(count) < F.lit(9e14), F.timestamp_seconds(seconds)
    )


def iso_to_epoch(text: Column) -> Column:
    return F.unix_micros(aware_timestamp(text)) / F.lit(1e6)


def normalise_uuid(text: Column) -> Column:
    """Canonical lower-case form of a UUID in any usual spelling; null if it is none."""
    named = F.replace(F.replace(text, F.lit("urn:"), F.lit("")), F.lit("uuid:"), F.lit(""))
    bare = F.lower(F.replace(F.btrim(named, F.lit("{}")), F.lit("-"), F.lit("")))
    return F.when(text.rlike(CANONICAL_UUID), text).when(
        bare.rlike(HEX_32), F.regexp_replace(bare, HEX_32, "$1-$2-$3-$4-$5")
    )
