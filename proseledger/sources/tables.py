"""Tables in and out: Parquet, CSV, JSON, text and rows given in the program."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# What makes a CSV file give back the strings that went in: Spark's defaults trim
# blanks on writing and escape quotes in a way of their own. NULL is written as an
# empty field and an empty string as an empty field in quotes. The reader knows them
# apart if NULL has a name other than the empty string; it is a code point that
# Unicode keeps out of text.
CSV = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
EMPTY_IS_TEXT = {"nullValue": "\ufdd0", "emptyValue": ""}


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
    multiline: bool = False,
    empty_is_null: bool = False,
) -> DataFrame:
    """Read CSV. Without a schema the types are inferred, which reads the files twice.

    Fields with line breaks need ``multiline``, and then a file can't be split
    between tasks: write such tables as many files. An empty field is NULL and
    an empty field in quotes an empty string, or NULL too with ``empty_is_null``.
    """
    options = CSV if empty_is_null else CSV | EMPTY_IS_TEXT
    reader = spark.read.options(header=header, multiLine=multiline, **options)
    if schema is None:
        return reader.csv(path, inferSchema=True)
    return reader.schema(schema).csv(path)


def from_rows(spark: SparkSession, rows: Sequence, schema: StructType | str | Sequence[str]) -> DataFrame:
    """A small table from rows given in the program."""
    return spark.createDataFrame(list(rows), schema)


def read_or_default(
    spark: SparkSession, path: str, default: Callable[[], DataFrame]
) -> DataFrame:
    """Read Parquet; if there is nothing at the path, the default table instead.

    Any other failure is a failure: a table that is there but can't be read must
    not be replaced in silence.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return default()


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").options(header=header, **CSV).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row; NULL fields are written too."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_text(df: DataFrame, path: str, line) -> None:
    """One line of text per row, built by the string column ``line``."""
    df.select(line.alias("value")).write.mode("overwrite").text(path)
