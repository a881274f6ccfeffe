"""User functions.

X1 is the extension point for a per-group feature function written in pandas:
``groupBy(key).applyInPandas``. Spark shuffles the rows by key and calls the
function once per group inside the Python workers, Arrow-batched. Every
built-in feature of this library is a native expression instead (no Python
on the hot path); use this only for logic that Spark cannot express.

X2 (custom aggregate in a spec) is a ``(name, builder)`` pair in an aggregate
spec, where ``builder(x, where) -> Column`` (see ``functions.aggfns``).
X3 (element-wise lambda) is any Column expression.
"""

from __future__ import annotations

from typing import Callable

import pandas as pd
from pyspark.sql import DataFrame


def per_group_features(
    df: DataFrame,
    key: str,
    fn: Callable[[pd.DataFrame], dict],
    schema: str,
) -> DataFrame:
    """One feature record per group from a pandas function ``fn(group) -> dict``.

    ``schema`` is the DDL of the output including ``key``. The key value is
    added to the record automatically.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rec = dict(fn(pdf))
        rec[key] = pdf[key].iloc[0]
        return pd.DataFrame([rec])

    names = [part.strip().split()[0] for part in schema.split(",")]

    def ordered(pdf: pd.DataFrame) -> pd.DataFrame:
        out = run(pdf)
        return out.reindex(columns=names)

    return df.groupBy(key).applyInPandas(ordered, schema)
