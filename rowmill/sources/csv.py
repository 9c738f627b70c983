"""CSV input and output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.functions.numeric import NUMBER_TEXT
from rowmill.functions.text import named
from rowmill.operators.columns import replace_columns, text_columns
from rowmill.sources.csv_records import breaks_in_quotes, csv_rows, file_lines

# Cell texts that mean "no value".
NULL_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    multi_line: bool = False,
    null_texts: Sequence[str] = NULL_TEXTS,
) -> DataFrame:
    """Read CSV with a header row; several paths or a folder form one table.

    Without a schema, columns are text unless every value in them is a number. Files are read in ranges, line breaks in
    quoted fields included: if there are any, records are put together and written by ``csv_rows``. ``multi_line`` reads
    each file by one task instead, which other line ends than ``\\n`` and ``\\r\\n`` need.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    lines = None if multi_line else file_lines(spark, path)
    if lines is not None and breaks_in_quotes(lines):
        # names come from the first record of a file; no more of it is read
        names = schema if isinstance(schema, T.StructType) else reader.option("multiLine", True).csv(path, schema).schema
        raw = csv_rows(lines, names)
    else:
        raw = reader.csv(path, schema)
    return null_out(raw, null_texts) if schema is not None else infer_numbers(null_out(raw, null_texts))


def null_out(df: DataFrame, texts: Sequence[str]) -> DataFrame:
    return replace_columns(
        df, {c: F.when(~named(c).isin(list(texts)), named(c)) for c in (text_columns(df) if texts else ())}
    )


def infer_numbers(df: DataFrame) -> DataFrame:
    """Cast text columns that hold only whole numbers to bigint, only numbers to double (one pass).

    Whole numbers beyond the range of bigint stay text: as doubles, different ids would become equal.
    """
    columns = text_columns(df)
    if not columns:
        return df

    # a cast to bigint would accept and cut "1.5", so whole numbers are told by their digits
    integral = [named(c).rlike(r"^\s*[+-]?[0-9]+\s*$") for c in columns]
    row = df.agg(
        *[F.count(named(c)).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.count_if(~named(c).rlike(NUMBER_TEXT)).alias(f"d{i}") for i, c in enumerate(columns)],
        *[F.count_if(~whole).alias(f"w{i}") for i, whole in enumerate(integral)],
        *[F.count_if(whole & named(c).try_cast("bigint").isNull()).alias(f"o{i}") for i, (c, whole) in enumerate(zip(columns, integral))],
        *[F.count_if(named(c).rlike(r"[0-9]")).alias(f"g{i}") for i, c in enumerate(columns)],
    ).first()
    casts = {}
    for i, name in enumerate(columns):
        if row[f"n{i}"] == 0:
            casts[name] = named(name).cast("double")
        elif row[f"d{i}"] == 0 and row[f"g{i}"] == row[f"n{i}"] and (row[f"w{i}"] or not row[f"o{i}"]):
            casts[name] = named(name).cast("double" if row[f"w{i}"] else "bigint")
    return replace_columns(df, casts)


def write_csv(df: DataFrame, path: str) -> None:
    """White space around values is kept, and quotes are doubled."""
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.mode("overwrite").option("header", True).option("escape", '"').options(**kept).csv(path)
