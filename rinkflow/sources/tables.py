"""All-text tables in the catalog.

A table is a view of the folder of its last complete load, so that a load takes
effect by one statement.
"""

import re
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rinkflow.functions.text import default_blank


def sanitized_names(columns):
    """Column names trimmed, upper-cased, spaces underscored, rest dropped."""
    return [re.sub(r"[^A-Z0-9_]", "", c.strip().upper().replace(" ", "_")) for c in columns]


def as_text_table(df: DataFrame) -> DataFrame:
    """Every column as text under its sanitized name; NULL is blank.

    Names that come out blank or equal raise, before anything is written.
    """
    names = sanitized_names(df.columns)
    clashing = sorted({n for n in names if names.count(n) > 1 or not n})
    if clashing:
        raise ValueError(f"column names {df.columns} are not distinct once cleaned: {clashing}")
    return df.select(
        *[default_blank(F.col(f"`{c}`")).alias(n) for c, n in zip(df.columns, names)]
    )


def save_text_table(df: DataFrame, name, folder):
    """Replace table ``name`` by the rows of ``df`` and return their number.

    The rows are written to a new sub-folder of ``folder``, counted as they are
    written; only when that has succeeded does ``name`` move to them, in one step.
    A load that fails at any point leaves the old rows, and readers see either
    those or the new ones.  A name that is a table of another kind raises.
    """
    spark = df.sparkSession
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    counted = Observation()
    as_text_table(df).observe(counted, F.count(F.lit(1)).alias("n")).write.parquet(path)
    rows = counted.get["n"]
    _point_at(spark, name, path)
    return rows


def _point_at(spark, name, path):
    """The switch: ``name`` shows the folder from here on."""
    spark.sql(f"CREATE OR REPLACE VIEW `{name}` AS SELECT * FROM parquet.`{path}`")
