"""Name similarity: the library's only Python function.

The length rule is a column expression, so pairs it rules out reach Python as
NULL and cost nothing there.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from rinkflow import fixed_values as fixed
from rinkflow.functions.text import _col


def lengths_agree(a, b) -> Column:
    """Both non-empty and at most 20 % of the longer apart in length."""
    la, lb = F.length(_col(a)), F.length(_col(b))
    close = F.abs(la - lb) <= F.greatest(la, lb) * F.lit(fixed.MAX_LENGTH_DIFFERENCE)
    return F.coalesce((la > 0) & (lb > 0) & close, F.lit(False))


def _ratio_function():
    # Nested, so that it is shipped to executors by value.
    def ratios(a, b):
        from difflib import SequenceMatcher

        import pandas as pd

        known = {}
        out = []
        for pair in zip(a, b):
            if pair[0] is None or pair[1] is None:
                out.append(None)
                continue
            if pair not in known:
                known[pair] = SequenceMatcher(None, pair[0], pair[1]).ratio()
            out.append(known[pair])
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(ratios, "double")


def sequence_ratio(a, b) -> Column:
    """Share of matching characters, 2M/T; NULL in, NULL out."""
    return _ratio_function()(_col(a), _col(b))


def similarity(a, b) -> Column:
    """0 if either text is empty or the lengths disagree, else the ratio."""
    agree = lengths_agree(a, b)
    ratio = sequence_ratio(F.when(agree, _col(a)), F.when(agree, _col(b)))
    return F.coalesce(ratio, F.lit(0.0))
