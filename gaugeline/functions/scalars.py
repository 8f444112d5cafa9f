"""Column expressions shared by the queries. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the binary size units, smallest first.
SIZE_UNITS = ("B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB")
# Sizes as little as this below the middle of two hundredths of a unit are rounded up, too.
MIDDLE = 1e-9


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds to a UTC timestamp cut to milliseconds."""
    return F.timestamp_millis(event_millis(seconds))


def event_millis(seconds: Column) -> Column:
    """Epoch seconds to whole milliseconds, truncated towards zero."""
    return (seconds * F.lit(1000)).cast("bigint")


def cut_to_millis(ts: Column) -> Column:
    return F.date_trunc("MILLISECOND", ts)


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_millis(later) - F.unix_millis(earlier)) / F.lit(1000)


def bucket(ts: Column, seconds: int) -> Column:
    """The start of the `seconds` wide bucket that holds `ts`."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts) / F.lit(seconds)) * F.lit(seconds))


def readable_size(size: Column, largest: str = SIZE_UNITS[-1]) -> Column:
    """A byte count in binary units, up to the `largest`, with two decimals."""
    result = F.format_string("%.2f " + SIZE_UNITS[0], size.cast("double"))
    for power, unit in enumerate(SIZE_UNITS[1 : SIZE_UNITS.index(largest) + 1], start=1):
        step = float(1024**power)
        result = F.when(size >= F.lit(step), F.format_string(f"%.2f {unit}", size / F.lit(step) + F.lit(MIDDLE))).otherwise(result)
    return result


def label(hostname: Column, machine_id: Column) -> Column:
    """A machine's name, or its id when it has none."""
    return F.coalesce(F.nullif(hostname, F.lit("")), machine_id)


def joined_names(names: Column) -> Column:
    return F.array_join(F.array_sort(names), ", ")
