"""Delimited text files in and out."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkflow import schemas

# Quotes are doubled inside quoted fields, as CSV writers do.
_SEMICOLON = {
    "sep": ";", "header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"',
}


def read_semicolon_csv(spark, path, columns) -> DataFrame:
    """``;`` CSV with header; every column text, blank as NULL."""
    return (
        spark.read.options(**_SEMICOLON)
        .option("multiLine", "false")
        .schema(schemas.text_columns(columns))
        .csv(path)
    )


def read_semicolon_csv_inferred(spark, path) -> DataFrame:
    """The same with column types taken from the data (one extra pass)."""
    return spark.read.options(**_SEMICOLON).option("inferSchema", "true").csv(path)


def write_semicolon_csv(df: DataFrame, path, columns, mode="overwrite"):
    """Fixed column order; absent columns and NULL are blank.

    ``overwrite`` rewrites the folder, ``append`` adds a batch.
    """
    present = set(df.columns)
    out = df.select(
        *[
            (F.col(f"`{name}`") if name in present else F.lit(None)).cast("string").alias(name)
            for name in columns
        ]
    )
    out.write.mode(mode).options(**_SEMICOLON).option("emptyValue", "").csv(path)


def export_selection(df: DataFrame, path):
    """Selected rows as comma CSV with header."""
    df.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
