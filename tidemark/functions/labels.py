"""Numbers as display text. A missing value shows as a dash."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DASH = "—"


def _half_away(value: Column) -> Column:
    """Nudge exact halves of a tenth (…25 and …75) away from zero.

    ``format_number`` rounds exact binary halves to even; no other double is a tie.
    """
    quarters = value * F.lit(4.0)
    tie = (quarters == F.floor(quarters)) & (F.abs(quarters) % F.lit(2.0) == F.lit(1.0))
    return F.when(tie, value + F.signum(value) * F.lit(0.01)).otherwise(value)


def fixed_one(value: Column) -> Column:
    """One decimal place, no grouping."""
    return F.translate(F.format_number(_half_away(value.cast("double")), 1), ",", "")


def percent_text(part: Column, whole: Column) -> Column:
    """``12.3%`` of a positive whole, else a dash."""
    ratio = part.cast("double") / F.nullif(whole, F.lit(0)).cast("double") * F.lit(100.0)
    return F.when(whole > 0, F.concat(fixed_one(ratio), F.lit("%"))).otherwise(F.lit(DASH))


def signed_percent_text(pct: Column) -> Column:
    """``+4.0%`` / ``-2.5%``; a dash where there is no change to show."""
    sign = F.when(pct >= 0, F.lit("+")).otherwise(F.lit(""))
    return F.coalesce(F.concat(sign, fixed_one(pct), F.lit("%")), F.lit(DASH))


def whole_number(value: Column) -> Column:
    """Rounded with thousands separators: ``1,234``."""
    rounded = F.floor(value.cast("double") + F.lit(0.5))
    return F.coalesce(F.format_number(rounded, 0), F.lit(DASH))


def compact_number(value: Column) -> Column:
    """A count with at most one decimal and a unit: ``950``, ``1.2K``, ``3M``, ``1.5B``.

    A value that rounds up to 1000 of its unit moves to the next unit.
    """
    count = value.cast("bigint")
    text = count.cast("string")
    for unit, size in (("K", 10 ** 3), ("M", 10 ** 6), ("B", 10 ** 9), ("T", 10 ** 12)):
        tenths = F.floor((count + F.lit(size // 20)) / F.lit(size // 10)).cast("bigint")
        whole, tenth = F.floor(tenths / F.lit(10)).cast("bigint"), tenths % F.lit(10)
        scaled = F.concat(
            whole.cast("string"),
            F.when(tenth == 0, F.lit("")).otherwise(F.concat(F.lit("."), tenth.cast("string"))),
            F.lit(unit))
        reaches = size if unit == "K" else size - size // 20_000
        text = F.when(count >= F.lit(reaches), scaled).otherwise(text)
    return F.coalesce(text, F.lit(DASH))


def status_label(failures: Column) -> Column:
    """PASS when nothing failed; NULL counts as a failure."""
    return F.when(failures == 0, F.lit("PASS")).otherwise(F.lit("FAIL"))
