"""Scans with explicit schemas and the source-side predicate of the sales pull."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ovenplan.schemas import SALES, SALES_SELECT
from ovenplan.session import materialize

SALE_DOCUMENT = "sale"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select exactly the schema's columns, cast to its types, in its order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_parquet(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Parquet scan with a fixed schema: an empty or partial folder keeps all columns."""
    paths = [path] if isinstance(path, str) else path
    return spark.read.schema(schema).parquet(*paths)


def read_sales(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_parquet(spark, path, SALES)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with a fixed schema (dates parse per the schema's types)."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


#: Column of :func:`read_csv_checked` with the text of a line that does not fit the schema.
REJECTED = "_rejected"


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with a fixed schema whose bad lines are kept, not raised.

    A line with too few or too many fields, or with a field that is not of its type,
    has its text in ``_rejected``, and NULL in fields that could not be read. The
    lines are parsed once, whole, and written as Parquet to the shared folder: a scan
    that reads only some columns of a CSV file does not notice bad fields in others.
    Split the result with :func:`accepted` and :func:`rejected`.
    """
    wide = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType(), True)])
    reader = spark.read.schema(wide).option("header", True).option("mode", "PERMISSIVE")
    lines = reader.option("columnNameOfCorruptRecord", REJECTED).option("dateFormat", "yyyy-MM-dd").csv(path)
    return materialize(lines, "csv-lines")


def accepted(lines: DataFrame) -> DataFrame:
    """The lines that fit, without the column of rejected text."""
    return lines.where(F.col(REJECTED).isNull()).drop(REJECTED)


def rejected(lines: DataFrame) -> DataFrame:
    """The texts of the lines that do not fit."""
    return lines.where(F.col(REJECTED).isNotNull()).select(REJECTED)


def line_counts(lines: DataFrame) -> DataFrame:
    """accepted, rejected: numbers of lines; one row."""
    bad = F.col(REJECTED).isNotNull()
    return lines.agg(F.count_if(~bad).alias("accepted"), F.count_if(bad).alias("rejected"))


def _day(d) -> Column:
    return F.lit(d).cast("date") if isinstance(d, (str, _dt.date)) else d


def sales_in_range(sales: DataFrame, date_from, date_to, recorder_type: str | None = SALE_DOCUMENT) -> DataFrame:
    """Records with ``period`` in ``[date_from 00:00:00, date_to 23:59:59.999999]``
    of one record type, five columns.

    Written as ``period >= from AND period < to + 1 day`` on the raw column, so
    both bounds and the type test are pushed into the Parquet scan.
    """
    lo = _day(date_from).cast("timestamp_ntz")
    hi = F.date_add(_day(date_to), 1).cast("timestamp_ntz")
    cond = (F.col("period") >= lo) & (F.col("period") < hi)
    if recorder_type is not None:
        cond = cond & (F.col("recorder_type") == F.lit(recorder_type))
    return sales.where(cond).select(*SALES_SELECT)
