"""Window-style operators.

Design for hot keys:

* last-k (W3/W5/W7): one ``row_number`` per key and a ``rn <= max(k)`` filter.
  Spark plans that as a WindowGroupLimit *before* the shuffle, so a key never
  ships more than ``max(k)`` rows per map task. The rows that are left become one
  ordered array per key, of ``max(k)`` rows at most, and the statistics of every k
  are array functions of its first k elements: no aggregation buffer per statistic.
  Whole-history statistics (W4) are a plain partial aggregate joined on the key,
  never a window.
* latest loan (W6) and dedup (W9/W10): ``max_by``/``min(struct)`` aggregates,
  partially combined map-side; no group is sorted in one task.
* lag/lead (W1/W2) need the ordered sequence of one loan; they are windows
  partitioned by (entity, loan). Window buffers spill to disk, and the loan
  level is far finer than the entity level.
"""

from __future__ import annotations

from typing import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomfeat.functions import aggfns
from loomfeat.operators.aggregate import aggregate
from loomfeat.operators.joins import null_safe_join


def _orders(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


# ------------------------------------------------------------------ W1 / W2


def _shift_within(df, partition, order, column, name, offset, method):
    if method == "window":
        w = Window.partitionBy(*partition).orderBy(*_orders(order))
        fn = F.lag if offset > 0 else F.lead
        return df.withColumn(name, fn(F.col(column), abs(offset)).over(w))
    # "rank": distributed row numbers (a long sequence spans many tasks), then an
    # equi-join on (partition, rank + offset): the triples are unique, no hot key
    from loomfeat.operators.scoring import prefix_rank

    order_cols = [o for o in order if isinstance(o, str)]
    if len(order_cols) != len(order):
        raise ValueError("method='rank' needs column names as the order")
    ranked = prefix_rank(df, list(partition), order_cols, name="__pos")
    other = ranked.select(*partition, (F.col("__pos") + F.lit(offset)).alias("__pos"), F.col(column).alias(name))
    return null_safe_join(ranked, other, [*partition, "__pos"]).drop("__pos")


def lag_within(
    df: DataFrame, partition: Sequence[str], order: Sequence[Column | str], column: str, name: str, offset: int = 1, method: str = "window"
) -> DataFrame:
    """Previous row's value within (entity, loan), in an explicit total order.

    ``method="window"`` sorts each (entity, loan) sequence in one task (fine at
    loan granularity); ``method="rank"`` never does: ranks come from
    ``scoring.prefix_rank`` and the previous row is found by an equi-join.
    """
    return _shift_within(df, partition, order, column, name, offset, method)


def lead_within(
    df: DataFrame, partition: Sequence[str], order: Sequence[Column | str], column: str, name: str, offset: int = 1, method: str = "window"
) -> DataFrame:
    """Next row's value within (entity, loan); ``method`` as in ``lag_within``."""
    return _shift_within(df, partition, order, column, name, -offset, method)


# ------------------------------------------------------------------ W9 / W10


def _keep_extreme(df: DataFrame, keys: Sequence[str], order: Sequence[str], first: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    # order columns lead the struct, the remaining columns make the order total
    tail = [c for c in rest if c not in order]
    s = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in tail])
    pick = F.min(s) if first else F.max(s)
    out = df.groupBy(*keys).agg(pick.alias("__k"))
    return out.select(*keys, *[F.col(f"__k.{c}").alias(c) for c in rest]).select(*df.columns)


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per ``keys`` by ``order`` (ascending, full tie-break)."""
    return _keep_extreme(df, list(keys), list(order), first=True)


def dedup_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the last row per ``keys`` by ``order``."""
    return _keep_extreme(df, list(keys), list(order), first=False)


# ------------------------------------------------------------------ W3-W5, W7, W8


def last_k_name(k: int | None, column: str, fn: str) -> str:
    return f"all_{column}_{fn}" if k is None else f"last_{k}_{column}_{fn}"


def trend_name(k: int, column: str) -> str:
    return f"trend_{k}_{column}"


def ranked(df: DataFrame, key: str, order_desc: Sequence[Column | str], tiebreak: Sequence[str] = (), rank_col: str = "__rn") -> DataFrame:
    """Row number per key, newest first (``order_desc`` descending, then ``tiebreak`` ascending)."""
    w = Window.partitionBy(key).orderBy(*[c.desc() for c in _orders(order_desc)], *[F.col(t).asc() for t in tiebreak])
    return df.withColumn(rank_col, F.row_number().over(w))


def _quantile_sql(p: float) -> str:
    at = f"{p}D * (s.n - 1)"
    low, high = f"int(floor({at}))", f"int(ceil({at}))"
    a, b = f"get(s.sorted, {low})", f"get(s.sorted, {high})"
    return f"if({low} = {high}, {a}, ({high} - {at}) * {a} + ({at} - {low}) * {b})"


_SPREAD = "s.n = s.rows AND s.n > 0 AND s.low < s.high AND s.m2 > 0"

#: Statistics of an array ``s.h`` of doubles (NULL elements are missing values), from the sums of ``_STAGES``.
_ARRAY_STATS = {
    "count": "bigint(s.n)",
    "size": "bigint(s.rows)",
    "sum": "s.total",
    "mean": "s.mean",
    "min": "s.low",
    "max": "s.high",
    "var": "if(s.n > 1, s.m2 / (s.n - 1), null)",
    "std": "if(s.n > 1, sqrt(s.m2 / (s.n - 1)), null)",
    "median": f"if(s.n > 0, {_quantile_sql(0.5)}, null)",
    "iqr": f"if(s.n = s.rows AND s.n > 0, {_quantile_sql(0.75)} - {_quantile_sql(0.25)}, null)",
    "skew": f"if({_SPREAD}, sqrt(double(s.n)) * s.m3 / pow(s.m2, 1.5D), null)",
    "kurt": f"if({_SPREAD}, s.n * s.m4 / (s.m2 * s.m2) - 3D, null)",
    "nonzero": "if(s.rows > 0, size(filter(s.h, y -> NOT (y <=> 0D))) / s.rows, null)",
    # least squares on 0, 1, ... from the newest element
    "slope": "CASE WHEN s.rows = 0 OR s.n < s.rows THEN null WHEN s.rows = 1 THEN 0D "
    "ELSE aggregate(transform(s.h, (y, i) -> (i - (s.rows - 1) / 2D) * y), 0D, (t, y) -> t + y) / (double(s.rows) * (double(s.rows) * s.rows - 1) / 12D) END",
}

_SORTED, _MOMENTS = {"min", "max", "median", "iqr", "skew", "kurt"}, {"var": (2,), "std": (2,), "skew": (2, 3), "kurt": (2, 4)}


def _array_stats(arrays: Sequence[str], fns: Sequence[str]) -> str:
    """SQL of an array with one struct of the statistics ``fns`` for each of ``arrays``.

    From arrays to sums in stages, every one a struct that the next reads, so nothing is
    computed twice; all arrays go through one expression.
    """
    kept = "'h', s.h, 'v', s.v, 'rows', s.rows, 'n', s.n, 'total', s.total"
    powers = sorted({p for f in fns for p in _MOMENTS.get(f, ())})
    ends = ", 'sorted', s.sorted, 'low', get(s.sorted, 0), 'high', get(s.sorted, s.n - 1)" if _SORTED & set(fns) else ""
    stages = [
        "'h', s, 'v', filter(s, y -> y IS NOT NULL)",
        "'h', s.h, 'v', s.v, 'rows', size(s.h), 'n', size(s.v), 'total', aggregate(s.v, 0D, (t, y) -> t + y)" + (", 'sorted', sort_array(s.v)" if ends else ""),
        f"{kept}, 'mean', if(s.n > 0, s.total / s.n, null){ends}",
    ]
    if powers:
        sums = ", ".join(f"'m{p}', aggregate(s.v, 0D, (t, y) -> t + {' * '.join(['(y - s.mean)'] * p)})" for p in powers)
        stages.append(f"{kept}, 'mean', s.mean{', ' + repr('sorted') + ', s.sorted, ' + repr('low') + ', s.low, ' + repr('high') + ', s.high' if ends else ''}, {sums}")
    stats = f"array({', '.join(arrays)})"
    for fields in (*stages, ", ".join(f"'{f}', {_ARRAY_STATS[f]}" for f in fns)):
        stats = f"transform({stats}, s -> named_struct({fields}))"
    return stats


#: Statistics of whole-number columns that stay whole, as aggregates of them do.
_WHOLE = {"sum": "long", "min": None, "max": None}


def last_k(
    df: DataFrame,
    key: str,
    order_desc: Sequence[Column | str],
    spec: Mapping[str, Sequence],
    ks: Iterable[int | None],
    tiebreak: Sequence[str] = (),
    trend: Mapping[int, Sequence[str]] | None = None,
    namer=None,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Statistics of each key's newest ``k`` rows, for several ``k`` at once.

    ``None`` in ``ks`` is the whole history (W4). ``trend`` maps ``k`` to the
    columns whose least-squares slope over the newest ``k`` rows is wanted
    (x = 0 for the newest row, W7). One window, one ordered array per key. ``derive`` adds
    columns of the spec to the rows that are left, so the shuffle does not carry them.
    """
    ks = list(ks)
    namer = namer or last_k_name
    finite = [k for k in ks if k is not None]
    trend = dict(trend or {})
    kmax = max([*finite, *trend.keys()], default=0)
    rn = "__rn"
    out = None
    if finite or trend:
        w = Window.partitionBy(key).orderBy(*[c.desc() for c in _orders(order_desc)], *[F.col(t).asc() for t in tiebreak])
        # row_number alone, then the filter: Spark inserts a WindowGroupLimit before the shuffle
        r = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= F.lit(kmax))
        r = derive(r) if derive else r
        used = list(dict.fromkeys([*spec, *[c for cs in trend.values() for c in cs]]))
        kinds = {f.name: f.dataType for f in r.schema.fields}
        cells = F.struct(F.col(rn), *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(used)])
        rows = r.groupBy(key).agg(F.sort_array(F.collect_list(cells)).alias("__rows"))
        arrays = rows.select(key, *[F.col(f"__rows.v{i}").alias(f"__a{i}") for i in range(len(used))])
        jobs = [(k, c) for k in dict.fromkeys([*finite, *trend]) for c in used if (k in finite and c in spec) or c in trend.get(k, ())]
        groups: dict[tuple, list] = {}  # arrays that want the same statistics go through one expression
        for k, c in jobs:
            fns = [aggfns.resolve(f)[0] for f in spec.get(c, ())] if k in finite else []
            groups.setdefault((*fns, *(["slope"] if c in trend.get(k, ()) else [])), []).append((k, c))
        named = {}
        for g, (fns, own) in enumerate(groups.items()):
            for j, (k, c) in enumerate(own):
                whole = kinds[c].typeName() in ("byte", "short", "integer", "long")
                for f in fns:
                    value = F.col(f"__g{g}")[j][f]
                    name = trend_name(k, c) if f == "slope" else namer(k, c, f)
                    named[name] = value.cast(_WHOLE[f] or kinds[c]) if whole and f in _WHOLE else value
        stats = [F.expr(_array_stats([f"slice(__a{used.index(c)}, 1, {k})" for k, c in own], fns)).alias(f"__g{g}") for g, (fns, own) in enumerate(groups.items())]
        order = [*[namer(k, c, aggfns.resolve(f)[0]) for k in finite for c, fns in spec.items() for f in fns], *[trend_name(k, c) for k, cs in trend.items() for c in cs]]
        out = arrays.select(key, *stats).select(key, *[named[n].alias(n) for n in order])
    if None in ks:
        whole = aggregate(derive(df) if derive else df, key, spec, namer=lambda p, c, t, f: namer(None, c, f))
        out = whole if out is None else whole.join(out, key, "left")
    return out


def fraction_features(
    df: DataFrame, pairs: Sequence[tuple[int, int]], spec: Mapping[str, Sequence], namer=None, moment_tol: float = 1e-9
) -> DataFrame:
    """short/long ratio of every last-k feature: long == 0 -> 0.0, missing stays missing.

    Only an exact 0 is zero, except for skewness and kurtosis: those of symmetric
    data are exactly 0 but come out of floating-point moments as ~1e-17, so they count
    as 0 below ``moment_tol``.
    """
    namer = namer or last_k_name
    new = []
    for s, l in pairs:
        for c, fns in spec.items():
            for fn in fns:
                name, _ = aggfns.resolve(fn)
                short, long_ = F.col(namer(s, c, name)), F.col(namer(l, c, name))
                zero = F.abs(long_.cast("double")) < F.lit(moment_tol) if name in ("skew", "kurt") else long_.cast("double") == 0
                value = F.when(zero, F.lit(0.0)).otherwise(F.try_divide(short.cast("double"), long_.cast("double")))
                new.append(value.alias(f"last_{s}by{l}_fraction_{c}_{name}"))
    return df.select("*", *new)


# ------------------------------------------------------------------ W6


def latest_loan(
    df: DataFrame,
    key: str,
    loan: str,
    order: Sequence[str],
    spec: Mapping[str, Sequence],
    prefix: str = "last_loan_",
) -> DataFrame:
    """Statistics over the rows of the loan that owns each key's newest row.

    The newest loan is ``max_by(loan, struct(order..., loan))``, a partial
    aggregate; the rows of that loan are then selected by an equi-join on
    (key, loan) and aggregated.
    """
    newest = df.groupBy(key).agg(F.max_by(F.col(loan), F.struct(*[F.col(o) for o in order], F.col(loan))).alias(loan))
    rows = df.join(newest, [key, loan], "left_semi")
    return aggregate(rows, key, spec, prefix=prefix)
