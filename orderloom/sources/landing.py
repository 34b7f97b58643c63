"""Reading delimited text: landing tables and mapping tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import is_blank
from ..plans.fixed_values import LANDING_SEPARATOR


LINE = "__line"


def _parsed(
    spark: SparkSession, path: str, columns: list[str] | None, sep: str, multi_line: bool
) -> tuple[DataFrame, list[str], Column]:
    """The text with ``LINE`` set where a line does not have the header's number of fields.

    The columns are those of the header. Files whose headers differ stop the
    job, and so does a header without one of ``columns``. The returned
    condition is always true; it makes the reader look at all fields, without
    which it would not count them.
    """
    reader = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("inferSchema", False)
        .option("enforceSchema", False)
    )
    header = reader.csv(path).columns
    missing = [c for c in columns or [] if c not in header]
    if missing:
        raise ValueError(f"{path} has no columns {missing}; its header is {header}")
    schema = StructType([StructField(c, StringType()) for c in [*header, LINE]])
    text = reader.schema(schema).option("columnNameOfCorruptRecord", LINE).csv(path)
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in header]
    return text, columns or header, F.length(F.concat_ws("", *quoted)) >= 0


def read_landing(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    sep: str = LANDING_SEPARATOR,
    multi_line: bool = False,
    bad_lines: str = "fail",
) -> DataFrame:
    """A delimited file with a header as an all-text table; blanks are ``''``.

    Columns are found by their names in the header; ``columns`` selects and
    orders them. A line with too few or too many fields stops the job, or is
    left out with ``bad_lines="skip"``; :func:`rejected_lines` lists them.
    ``multi_line`` allows line breaks inside quotes, at the price of files that
    cannot be split; without it such a record is two bad lines.
    """
    if bad_lines not in ("fail", "skip"):
        raise ValueError(f"unknown choice for bad lines: {bad_lines}")
    text, names, seen = _parsed(spark, path, columns, sep, multi_line)
    good = F.col(LINE).isNull()
    if bad_lines == "fail":
        message = F.concat(F.lit("unreadable line: "), F.col(LINE))
        good = F.when(good, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    kept = text.where(seen & good)
    return kept.select(*[F.col("`" + c.replace("`", "``") + "`") for c in names]).na.fill("")


def rejected_lines(
    spark: SparkSession, path: str, sep: str = LANDING_SEPARATOR, multi_line: bool = False
) -> DataFrame:
    """(line): the lines that ``bad_lines="skip"`` leaves out, as they stand in the file."""
    text, _, seen = _parsed(spark, path, None, sep, multi_line)
    return text.where(seen & F.col(LINE).isNotNull()).select(F.col(LINE).alias("line"))


def one_row_per_key(df: DataFrame, key: str, values: list[str]) -> DataFrame:
    """A lookup table: non-blank keys, one row each, smallest values first."""
    return (
        df.where(F.col(key).isNotNull() & ~is_blank(key))
        .groupBy(key)
        .agg(F.min(F.struct(*values)).alias("__values"))
        .select(key, *[F.col(f"__values.{v}").alias(v) for v in values])
    )


def split_places(places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The city and the province lookup out of one file.

    The file holds two unrelated lists side by side; the shorter one is padded
    with blanks, which are no keys.
    """
    return (
        one_row_per_key(places, "city", ["city_new"]),
        one_row_per_key(places, "province", ["province_new"]),
    )


def rename_columns(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(renames)
