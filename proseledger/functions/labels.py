"""Labels for numbers."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def bucketize(value: Column, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Label i for the first bound i above the value, the last label beyond them all.

    NULL stays NULL; it does not fall through to the last label.
    """
    if len(labels) != len(bounds) + 1:
        raise ValueError("there must be one more label than bounds")
    chosen = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, label in zip(bounds, labels):
        chosen = chosen.when(value < bound, label)
    return chosen.otherwise(labels[-1])


def sentiment_category(score: Column) -> Column:
    """'positive', 'negative' or 'neutral' by sign; NaN is neutral, NULL stays NULL."""
    number = score.cast("double")
    return (
        F.when(score.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(number), "neutral")
        .when(number > 0, "positive")
        .when(number < 0, "negative")
        .otherwise("neutral")
    )


def sentiment_category_python(score: Column) -> Column:
    """``sentiment_category`` from Python, one Arrow batch at a time; NULL in, NULL out.

    The function is defined in here so that it travels to the workers by value:
    they need pandas, not this package.
    """

    def label(numbers: pd.Series) -> pd.Series:
        labels = pd.Series("neutral", index=numbers.index, dtype=object)
        labels[numbers > 0] = "positive"
        labels[numbers < 0] = "negative"
        return labels

    # Arrow hands NULL over as NaN, so which of the two it was is settled outside.
    labelled = F.pandas_udf(label, StringType())(score.cast("double"))
    return F.when(score.isNotNull(), labelled)
