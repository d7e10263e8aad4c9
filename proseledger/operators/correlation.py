"""Pearson correlation between columns."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed

# Columns whose products a task keeps together in one matrix.
BLOCK = 64


def pearson(a: Column, b: Column) -> Column:
    """Correlation over the rows where both are known; NULL where it is undefined.

    ``F.corr`` raises on a constant column in ANSI mode, this gives NULL.
    """
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    spread = F.sqrt(F.var_pop(x)) * F.sqrt(F.var_pop(y))
    return F.try_divide(F.covar_pop(a, b), spread)


def strength(corr: Column) -> Column:
    """'Strong', 'Moderate', 'Weak' or 'Negligible' by the size of the correlation."""
    label = F.when(corr.isNull(), F.lit(None).cast("string"))
    for least, name in fixed.CORRELATION_STRENGTH:
        label = label.when(F.abs(corr) >= least, name)
    return label.otherwise("Negligible")


def _comoments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (i, j, n, mean_i, mean_j, m2_i, m2_j, c, odd) per task and pair of columns i <= j.

    Over the task's rows where both are known: their number, both means, the sums of squared
    deviations and of the products of deviations; ``odd`` counts rows with a value that is
    not finite, which are left out of the rest. A task holds these as matrices for blocks of
    columns, to which a batch of rows adds by matrix products.
    """
    width = len(columns)

    def task(batches):
        import numpy as np
        import pyarrow as pa

        blocks = [range(a, min(a + BLOCK, width)) for a in range(0, width, BLOCK)]
        state = {}
        # Values are taken from the task's first value of a column, so a constant column has no spread at all.
        shift, is_set = np.zeros(width), np.zeros(width, bool)
        for batch in batches:
            if not batch.num_rows:
                continue
            known, bad, values = [], [], []
            for c in range(width):
                column = batch.column(c)
                there = ~column.is_null().to_numpy(zero_copy_only=False)
                x = column.fill_null(0.0).to_numpy(zero_copy_only=False)
                finite = np.isfinite(x)
                good = there & finite
                if not is_set[c] and good.any():
                    shift[c], is_set[c] = x[good][0], True
                known.append(good)
                bad.append(there & ~finite)
                values.append(np.where(good, np.where(finite, x, 0.0) - shift[c], 0.0))
            known, values = np.array(known, float), np.array(values)
            bad, there = np.array(bad, float), known + np.array(bad, float)
            for p, one in enumerate(blocks):
                for q, two in enumerate(blocks[p:], p):
                    m, w = known[one.start:one.stop], known[two.start:two.stop].T
                    x, y = values[one.start:one.stop], values[two.start:two.stop].T
                    odd = bad[one.start:one.stop] @ there[two.start:two.stop].T
                    odd += there[one.start:one.stop] @ bad[two.start:two.stop].T
                    sums = np.stack([m @ w, x @ w, m @ y, (x * x) @ w, m @ (y * y), x @ y, odd])
                    state[p, q] = sums if (p, q) not in state else state[p, q] + sums
        for (p, q), (n, sx, sy, sxx, syy, sxy, odd) in state.items():
            one, two = np.array(blocks[p]), np.array(blocks[q])
            i, j = np.repeat(one, len(two)), np.tile(two, len(one))
            n, sx, sy, sxx, syy, sxy, odd = (v.ravel() for v in (n, sx, sy, sxx, syy, sxy, odd))
            keep = (i <= j) & (n + odd > 0)
            count = np.maximum(n, 1)
            out = [i, j, n.astype(np.int64), shift[i] + sx / count, shift[j] + sy / count,
                   sxx - sx * sx / count, syy - sy * sy / count, sxy - sx * sy / count, odd.astype(np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v[keep]) for v in out], ["i", "j", "n", "mean_i", "mean_j", "m2_i", "m2_j", "c", "odd"]
            )

    numbers = df.select([F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    schema = "i long, j long, n long, mean_i double, mean_j double, m2_i double, m2_j double, c double, odd long"
    return numbers.mapInArrow(task, schema)


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every pair of columns, each with itself too: correlation, its strength and sign.

    One scan, whatever the number of columns: a task sends one row per pair of columns, not per row of
    the table. The tasks' means are taken from the least of them before they are combined, so
    large values with a small spread don't cancel. NULL where a column is constant or there
    are no rows; NaN where a value is not finite.
    """
    made = _comoments(df, columns)
    pair = Window.partitionBy("i", "j")
    some = F.col("n") > 0
    from_least = made.withColumns(
        {
            "_x": F.when(some, F.col("mean_i") - F.min(F.when(some, F.col("mean_i"))).over(pair)),
            "_y": F.when(some, F.col("mean_j") - F.min(F.when(some, F.col("mean_j"))).over(pair)),
        }
    )
    n, x, y = F.col("n"), F.col("_x"), F.col("_y")

    def combined(inside: str, a: Column, b: Column) -> Column:
        within = F.sum(F.col(inside) + n * a * b)
        return within - F.try_divide(F.sum(n * a) * F.sum(n * b), F.sum("n"))

    sums = from_least.groupBy("i", "j").agg(
        combined("m2_i", x, x).alias("vi"), combined("m2_j", y, y).alias("vj"), combined("c", x, y).alias("c"),
        F.sum("odd").alias("odd"),
    )
    spread = F.sqrt(F.greatest("vi", F.lit(0.0))) * F.sqrt(F.greatest("vj", F.lit(0.0)))
    corr = F.when(F.col("odd") > 0, F.lit(float("nan"))).otherwise(F.try_divide("c", spread))
    # A row for each pair, also where no task has a row of it.
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    wanted = df.sparkSession.createDataFrame(
        pa.table([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["_i", "_j"])
    )
    name = F.array(*[F.lit(c) for c in columns])
    matrix = wanted.join(sums, (F.col("i") == F.col("_i")) & (F.col("j") == F.col("_j")), "left").select(
        name[F.col("_i").cast("int")].alias("col1"), name[F.col("_j").cast("int")].alias("col2"), corr.alias("corr")
    )
    corr = F.col("corr")
    itself = F.col("col1") == F.col("col2")
    return matrix.withColumns(
        {
            "strength": F.when(itself, "Perfect").otherwise(strength(corr)),
            "direction": F.when(corr > 0, "Positive").when(corr < 0, "Negative").otherwise("None"),
        }
    )
