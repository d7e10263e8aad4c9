"""The statistical report: every table of the profile, written to one folder."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import reused, store
from ..sources.tables import write_json, write_text
from .correlation import correlations
from .frequency import frequency_distribution, mode_of
from .profile import profile, profile_highlights
from .quantiles import QUANTILES, edge_fractions, histograms_of, select_ranks


def _union(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def write_profile_report(
    df: DataFrame,
    numbers: Sequence[str],
    categories: Sequence[str],
    path: str,
    persist: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
) -> None:
    """Write profile, correlations, histograms, frequencies and highlights as JSON, and a
    summary as text, each to a folder of its own below the path.

    The columns are kept from the first table to the last, and one selection gives the
    quantiles of the profile and the edges of the histograms. What is written is
    small: rows per column, per pair of columns, per bucket and per category.
    """
    with reused(df.select(*numbers, *categories), persist) as kept:
        fractions = [*QUANTILES.values(), *edge_fractions(10)]
        selected = store(select_ranks(kept, numbers, fractions), "selected")
        profiled = store(profile(kept, numbers, persist=None, selected=selected), "profile")
        correlated = store(correlations(kept, numbers), "correlations")
        modes = store(_union([mode_of(kept, c) for c in categories]), "modes")
        write_json(profiled, f"{path}/profile")
        write_json(correlated, f"{path}/correlations")
        write_json(histograms_of(selected), f"{path}/histograms")
        frequencies = [frequency_distribution(kept, c) for c in categories]
        write_json(_union(frequencies), f"{path}/frequencies")
        write_json(profile_highlights(profiled, correlated, modes), f"{path}/highlights")
        line = F.format_string(
            "%s: mean %.2f, std dev %.2f, skewness %.3f, IQR %.2f",
            F.upper("column"), "mean", "stddev", "skewness", "iqr",
        )
        write_text(profiled, f"{path}/summary", line)
