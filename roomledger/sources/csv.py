"""CSV source and sink of raw and processed bookings.

The source reads every column as text, named by the header: no schema inference (a second pass
over the data, and unstable types). Quotes inside fields are doubled, as pandas writes them.
Missing-value tokens are normalised afterwards in one projection (A2) because Spark's CSV reader
accepts only one ``nullValue`` token.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.functions.parsing import clean_column_name, missing_tokens, null_if_missing
from roomledger.schema import RAW_COLUMNS, SILVER_SCHEMA


BROKEN = "_broken_record"


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Raw bookings from CSV file(s) with a header row; every column as text.

    The first header gives the names (no inference pass); a file whose header differs from it is
    refused, as its columns would get other names. A row with too many or too few fields stops the
    job. So does a quoted field with a line break, unless ``multi_line`` is set: then it is read
    right, but a file is one task, where otherwise files are split. Names are cleaned (B1) and columns are
    selected by name, so their order does not matter.
    """
    df = read_csv_text(spark, path, multi_line)
    missing = [c for c in RAW_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"raw file lacks columns: {missing}")
    return normalise_missing(df.select(*RAW_COLUMNS))


def read_csv_text(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Every cell of CSV file(s) with a header row, as text; an empty cell is NULL. Broken rows stop the job."""
    options = {"header": "true", "quote": '"', "escape": '"', "multiLine": str(multi_line).lower()}
    names = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in (*names, BROKEN)])
    df = spark.read.options(
        **options, enforceSchema="false", columnNameOfCorruptRecord=BROKEN, columnPruning="false"
    ).csv(path, schema=schema)
    message = F.concat(F.lit("CSV row with other fields than the header: "), F.substring(BROKEN, 1, 200))
    df = df.filter(F.when(F.col(BROKEN).isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    return df.drop(BROKEN).toDF(*[clean_column_name(c) for c in names])


def read_processed_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Processed bookings as ``write_csv`` wrote them, typed; texts keep their blanks, the status date is text."""
    df = read_csv_text(spark, path, multi_line)
    return df.select(
        *[F.col(f.name) if f.name == "reservation_status_date" else F.col(f.name).cast(f.dataType) for f in SILVER_SCHEMA.fields]
    )


def normalise_missing(df: DataFrame) -> DataFrame:
    """Missing-value tokens (``''``, ``NA``, ``NULL``, ``nan`` ...) -> NULL in every column (A2)."""
    tokens = missing_tokens()
    return df.select(*[null_if_missing(F.col(c), tokens).alias(c) for c in df.columns])


def write_csv(df: DataFrame, path: str) -> None:
    """Bookings as CSV with a header (A3); one file per task, written in parallel.

    Blanks are kept as they are (Spark trims them on write by default), so a ``'  '`` cell
    survives the round trip; NULL is written as an empty field.
    """
    (
        df.write.mode("overwrite")
        .option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
