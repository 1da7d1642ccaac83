"""One-pass group profile: counts, exact sums, distinct counts and modes per key.

Spark's own plan for ``count(DISTINCT a), count(DISTINCT b), mode(c)`` in one
aggregate expands every row once per distinct column and carries a mode
buffer (a hash-map object) in every expanded group, which forces
object-hash / sort-based aggregation over the whole input.  Here:

values   GROUP BY GROUPING SETS ((k), (k, a), (k, b), (k, c), (k, d)) with
         fixed-width measures only (count, decimal sum): a hash aggregate whose
         partial step collapses rows map-side, so a hot key ships one row per
         distinct value per map task.
counted  GROUP BY k, the mode columns and the grouping id: the (k, a) and (k, b)
         rows shrink to one row a key that counts the distinct values, the
         mode rows pass as they are.  A hash aggregate too.
profile  GROUP BY k: counts and sums from the (k) row, distinct counts from
         theirs, and per mode column the value with the most rows, ties to the
         lowest (``min_by`` on (-rows, value)).  Only this small result --
         keys x values of the mode columns -- goes through a sort-based aggregate.
The input is read once and nothing is joined.  With ``approx_distinct`` the
sketches ride in a plain GROUP BY k, and modes come from a second read that is
joined null-safe on k.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepulse.functions.exprs import MONEY_SCALE, as_exact, exact_sum

HLL_RSD = 0.01  # relative standard deviation of the approximate distinct counts


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def group_profile(
    df: DataFrame,
    keys: list[str],
    count_col: str,
    value_col: str | None = None,
    distinct: dict[str, Column | str] | None = None,
    modes: dict[str, Column | str] | None = None,
    approx_distinct: bool = False,
    value_scale: int = MONEY_SCALE,
) -> DataFrame:
    """Per ``keys``: ``_n`` = count(count_col); ``_value_sum`` / ``_value_n``
    (decimal sum and count of ``value_col``, finished by ``rounded_mean``);
    one column per ``distinct`` alias (exact, or HLL++ when
    ``approx_distinct``); one column per ``modes`` alias (most frequent
    non-null value, ties -> lowest)."""
    distinct = dict(distinct or {})
    modes = dict(modes or {})

    inputs = [c for c in dict.fromkeys([count_col, value_col]) if c is not None and c not in keys]
    projected = {f"_x_{a}": _as_col(c) for a, c in distinct.items()}
    projected.update({f"_m_{a}": _as_col(c) for a, c in modes.items()})
    src = df.select(*keys, *inputs, *[c.alias(n) for n, c in projected.items()])

    measures = [F.count(count_col).alias("_n")]
    if value_col is not None:
        measures += [exact_sum(value_col, value_scale).alias("_value_sum"), F.count(as_exact(value_col, value_scale)).alias("_value_n")]
    if approx_distinct:
        # HLL++ sketches are fixed width: they ride in the (k) set's aggregate.
        measures += [F.approx_count_distinct(f"_x_{a}", HLL_RSD).alias(f"_a_{a}") for a in distinct]

    key_cols = [F.col(k) for k in keys]
    gid = F.col("_gid")
    exact = [] if approx_distinct else [f"_x_{a}" for a in distinct]
    mnames = [f"_m_{a}" for a in modes]
    if exact:
        return _from_one_read(src, keys, measures, distinct, modes, value_col is not None)

    base = src.groupBy(*keys).agg(*measures)
    base = base.select(*keys, *[F.col(c) for c in base.columns if c not in keys and not c.startswith("_a_")],
                       *[F.col(f"_a_{a}").alias(a) for a in distinct])
    if not modes:
        return base

    # Modes branch -------------------------------------------------------------
    if len(mnames) == 1:
        counted = src.where(F.col(mnames[0]).isNotNull()).groupBy(*keys, mnames[0]).agg(
            F.count(F.lit(1)).alias("_rows"), F.lit(0).alias("_gid"))

        def mgid(name: str) -> int:
            return 0
    else:
        mm = len(mnames)

        def mgid(name: str) -> int:
            return (1 << mm) - 1 - (1 << (mm - 1 - mnames.index(name)))

        counted = src.groupingSets(
            [key_cols + [F.col(n)] for n in mnames], *key_cols, *[F.col(n) for n in mnames]
        ).agg(F.count(F.lit(1)).alias("_rows"), F.grouping_id().alias("_gid"))
    picks = []
    for alias, n in zip(modes, mnames):
        take = (gid == mgid(n)) & F.col(n).isNotNull()
        picks.append(F.min_by(F.when(take, F.col(n)), F.when(take, F.struct(-F.col("_rows"), F.col(n)))).alias(alias))
    picked = counted.groupBy(*keys).agg(*picks)
    # Keys may hold nulls (e.g. an hour of an unparsable timestamp): join null-safe.
    cond = reduce(lambda x, y: x & y, [base[k].eqNullSafe(picked[k]) for k in keys])
    return base.join(picked, cond, "left").select(base["*"], *[picked[a] for a in modes])


def _from_one_read(
    src: DataFrame, keys: list[str], measures: list[Column], distinct: dict, modes: dict, has_value: bool
) -> DataFrame:
    """Exact distinct counts and modes from one grouping-sets aggregate, without a join."""
    exact, mnames = [f"_x_{a}" for a in distinct], [f"_m_{a}" for a in modes]
    names = exact + mnames
    whole = (1 << len(names)) - 1                     # grouping_id of the (k) set
    gid = F.col("_gid")

    def gid_of(name: str) -> int:                     # grouping_id of the (k, name) set
        return whole - (1 << (len(names) - 1 - names.index(name)))

    key_cols = [F.col(k) for k in keys]
    values = src.groupingSets(
        [key_cols] + [key_cols + [F.col(n)] for n in names], *key_cols, *[F.col(n) for n in names]
    ).agg(*measures, F.count(F.lit(1)).alias("_rows"), F.grouping_id().alias("_gid"))

    carried = ["_n"] + (["_value_sum", "_value_n"] if has_value else [])
    # One row per key for each counted column, one per key and value for the modes; the
    # measures of the other sets' rows are not used.
    counted = values.groupBy(*keys, *mnames, "_gid").agg(
        *[F.max(c).alias(c) for c in carried], F.max("_rows").alias("_rows"), *[F.count(n).alias(f"_d{n}") for n in exact]
    )
    aggs = [F.sum(F.when(gid == whole, F.col(c))).alias(c) for c in carried]
    aggs += [F.coalesce(F.sum(F.when(gid == gid_of(n), F.col(f"_d{n}"))), F.lit(0)).alias(a) for a, n in zip(distinct, exact)]
    for alias, n in zip(modes, mnames):
        take = (gid == gid_of(n)) & F.col(n).isNotNull()
        aggs.append(F.min_by(F.when(take, F.col(n)), F.when(take, F.struct(-F.col("_rows"), F.col(n)))).alias(alias))
    return counted.groupBy(*keys).agg(*aggs)
