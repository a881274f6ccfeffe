"""Query catalogue: one callable per operator (or block) of SURVEY section 2.

Each query takes ``(spark, sf_dir)``, reads the driver's tables through the
role mapping of ``loomfeat.sources.fixtures`` and returns a DataFrame whose
computed columns are aliased exactly like the DuckDB oracle in
``oracle_sql.py``. Queries always run over whole tables.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomfeat.operators import aggregate as agg
from loomfeat.operators import joins
from loomfeat.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


# ------------------------------------------------------------------ flagship

# Status slices and recency windows of the flagship (kernel B44/B45 shape).
FLAGSHIP_STATUS = {"fin": "F", "opn": "O"}
FLAGSHIP_WINDOWS = {"1y": 365, "2y": 730}
FLAGSHIP_SPEC = {
    "o_totalprice": ["min", "max", "mean", "sum", "std", "size"],
    "o_days": ["min", "max", "mean"],
}


def flagship_slices() -> list[agg.Slice]:
    status = [agg.eq_slice(t, "o_orderstatus", v) for t, v in FLAGSHIP_STATUS.items()]
    windows = agg.window_slices("o_days", FLAGSHIP_WINDOWS)
    out = [agg.ALL, *windows]
    for s in status:
        out.append(s)
        out.extend(agg.and_slices(s, w) for w in windows)
    return out


def order_activity(spark: SparkSession, sf_dir: str, fused: bool = True) -> DataFrame:
    """Per customer: order statistics overall, by status and by recency window.

    A20 + A21 + A22 fused into one aggregate, J1 onto the customer spine, P3 fill.
    """
    orders = fx.bureau(spark, sf_dir)
    spine = fx.application(spark, sf_dir).select(F.col("c_custkey"))
    run = agg.aggregate if fused else agg.aggregate_naive
    block = run(orders, "o_custkey", FLAGSHIP_SPEC, flagship_slices(), prefix="ord_")
    block = block.withColumnRenamed("o_custkey", "c_custkey")
    return joins.left_join(spine, block, "c_custkey").na.fill(0)


@query("flagship_order_activity")
def q_flagship(spark, d):
    return order_activity(spark, d)


# Register the per-area query modules (they import ``query`` from here).
from loomfeat.plans import q_agg, q_blocks, q_enc, q_misc, q_win  # noqa: E402,F401
