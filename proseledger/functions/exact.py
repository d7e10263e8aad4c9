"""Sums of doubles that don't depend on the order of the rows.

A double is cut into pieces of 20 bits on a grid that is the same for all
doubles. Sums of pieces are sums of whole numbers, which come out the same in any order and
however rows are spread over tasks and chunks (up to 8 * 10^12 rows). Only the sums
are turned into a double, in a fixed order and with the rounding
errors carried along, which rounds the exact total correctly unless it is about 2^50 times smaller than
its largest pieces.

NULLs are left out. An infinity or NaN among the rows is the result, as in an ordinary
sum. Bits below 2^-1000 count as 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 20
# A double's 53 bits touch so many pieces at most.
PIECES = 4
LOWEST = -50


def is_finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) < float("inf"))


def top_bin(x: Column) -> Column:
    """The grid number of the piece with the highest bit of a finite double."""
    at = F.floor(F.log2(F.abs(x)) / BITS).cast("int")
    return F.greatest(F.coalesce(at, F.lit(LOWEST)), F.lit(LOWEST + PIECES - 1))


def pieces_from(x: Column, top: Column) -> list[Column]:
    """The pieces of a finite double from a grid number down, each as a whole number."""
    out = []
    for i in range(PIECES):
        # Powers of two are exact, and so is the remainder of doubles.
        moved = x * F.pow(F.lit(2.0), -BITS * (top - i))
        out.append((moved if i == 0 else moved % float(1 << BITS)).cast("long"))
    return out


def bins_of(df: DataFrame, value: str) -> range:
    """The grid numbers that the values of a column touch. To the driver come two numbers."""
    x = F.col(value).cast("double")
    top = F.when(is_finite(x) & (x != 0), top_bin(x))
    low, high = df.agg(F.min(top), F.max(top)).first()
    return range(0) if low is None else range(max(LOWEST, low - PIECES + 1), high + 1)


def pieces_in(x: Column, bins: range) -> list[Column]:
    """The pieces of a double on the grid numbers of its column, lowest first, and at the end what is not finite."""
    x = x.cast("double")
    usable = F.when(is_finite(x), x)
    out = []
    for at in bins:
        moved = usable * 2.0 ** (-BITS * at)
        piece = moved if at == bins[-1] else moved % float(1 << BITS)
        # All bits of a greater number lie above this piece.
        above = BITS * (at + 1) + 53
        if above < 1023:
            piece = F.when(F.abs(usable) < 2.0**above, piece).when(usable.isNotNull(), 0.0)
        out.append(piece.cast("long"))
    # Where no value touches the grid, all are 0 or not finite, and add up in any order.
    return [*out, F.when(~is_finite(x), x)] if out else [x]


def rounded(sums: Column) -> Column:
    """The double next to the total of sums of pieces: an array of (bin, sum), highest bin first."""

    def add(total: Column, term: Column) -> Column:
        # What the rounding of high + term loses goes to low.
        high = total["high"] + term
        back = high - total["high"]
        lost = (total["high"] - (high - back)) + (term - back)
        return F.struct(high.alias("high"), (total["low"] + lost).alias("low"))

    def terms(item: Column) -> Column:
        # Both halves of a sum are exact doubles, whatever the sum.
        unit = F.pow(F.lit(2.0), BITS * item["bin"])
        upper = F.shiftright(item["sum"], 32)
        lower = item["sum"] - F.shiftleft(upper, 32)
        return F.array(upper.cast("double") * float(1 << 32) * unit, lower.cast("double") * unit)

    zero = F.struct(F.lit(0.0).alias("high"), F.lit(0.0).alias("low"))
    listed = F.flatten(F.transform(sums, terms))
    return F.aggregate(listed, zero, add, lambda total: total["high"] + total["low"])


def rounded_bins(sums: list[Column], bins: range) -> Column:
    """The double next to the total of sums of ``pieces_in``; NULL if there was no value."""
    *pieces, special = sums
    if not len(bins):
        return special
    items = [
        F.struct(F.lit(at).alias("bin"), s.alias("sum")) for at, s in reversed(list(zip(bins, pieces)))
    ]
    total = F.when(pieces[0].isNotNull(), rounded(F.array(*items)))
    return F.coalesce(special + F.coalesce(total, F.lit(0.0)), total)
