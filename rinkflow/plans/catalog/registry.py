"""Registration of queries and the form in which results are compared."""

from pyspark.sql import functions as F

QUERIES = {}
SQL = {}


def query(sql=None):
    """Register a function of (session, folder) under its own name."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def plain(df, digits=4):
    """Dates as text, whole numbers as bigint, doubles rounded to ``digits``."""
    columns = []
    for name, dtype in df.dtypes:
        c = F.col(f"`{name}`")
        if dtype in ("date", "timestamp", "timestamp_ntz"):
            c = c.cast("string")
        elif dtype in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        elif dtype in ("double", "float"):
            c = F.round(c, digits)
        columns.append(c.alias(name))
    return df.select(*columns)
