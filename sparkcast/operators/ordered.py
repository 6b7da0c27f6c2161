"""Ordered work that stays parallel.

pandas code in this domain leans on positional order: shift, rolling,
ffill, "the first 80 % of rows". An unpartitioned Spark window would run all
of that in one task. The methods here keep every step distributed:

* ``with_ordinal``      dense 0-based row number over a total order: a range
                        partitioned sort, materialised with ``checkpoint()`` in
                        the shared checkpoint folder, plus per-partition offsets
                        (one row per partition, so the broadcast is bounded by
                        the partition count).
* ``halo_window``       chunk + halo: rows are cut into chunks of ``C``
                        consecutive ordinals, and the last ``halo`` rows of each
                        chunk are copied into the next one; any window whose
                        frame looks back at most ``halo`` rows is then exact
                        inside ``partitionBy(chunk, groups)``. Task size is
                        bounded by C + halo whatever the key skew.
* ``fill_nulls_ordered`` forward/backward fill: fill inside chunks, then carry the
                        last (first) non-null value of each chunk to the next.
* ``rank_boundaries``   the key of the k-th row in a total order, found level by
                        level with small count aggregates and running totals
                        (no sort of the rows); used for temporal cuts.
* ``running_totals``    running sums over a range-partitioned table.
* ``quantiles``         exact linear-interpolated quantiles: a sketch brackets
                        them, exact counts inside the brackets settle them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkcast.session import checkpoint_dir

ORD = "_ord"
DEFAULT_CHUNK_ROWS = 1 << 20


def _cols(cs: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


TARGET_PARTITION_BYTES = 128 << 20


def _estimated_bytes(df: DataFrame) -> int | None:
    """Size of the tables a plan reads (joins would multiply their estimates;
    checkpoints, whose size Spark does not know, count for nothing)."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
        return sum(x for x in sizes if x < 1 << 60)
    except Exception:  # noqa: BLE001 - estimates are best effort
        return None


def _num_partitions(df: DataFrame, n: int | None) -> int:
    """Range partitions for a sort: at least the shuffle partition count, and
    enough that each holds about 128 MB by the optimizer's estimate (so the
    count grows with the data instead of staying at a fixed setting)."""
    if n:
        return n
    base = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    size = _estimated_bytes(df)
    if size is None:
        return base
    return int(max(base, -(-size // TARGET_PARTITION_BYTES)))


def with_ordinal_n(
    df: DataFrame,
    order_cols: Sequence[str],
    ord_col: str = ORD,
    num_partitions: int | None = None,
    tiebreak: Column | None = None,
) -> tuple[DataFrame, int]:
    """Add a dense 0-based ordinal over ``order_cols`` (ascending, nulls first);
    also returns the row count.

    The order must be total for the ordinal to be deterministic; ``tiebreak``
    adds an extra sort column used only to spread equal keys over range
    partitions (quantiles, where ties do not change the answer).
    """
    spark = df.sparkSession
    checkpoint_dir(spark)  # fail early if the cluster names no shared folder
    n = _num_partitions(df, num_partitions)
    sort_cols = _cols(order_cols) + ([tiebreak] if tiebreak is not None else [])
    staged = (
        df.repartitionByRange(n, *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    # Range bounds come from sampling; recomputation could cut differently,
    # so the sorted frame is written to the shared checkpoint folder once.
    staged = staged.checkpoint(eager=True)
    offsets, total = _offsets(staged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_s")))
    out = staged.join(F.broadcast(offsets), "_pid").select(
        *[F.col(c) for c in df.columns], (F.col("_off") + F.col("_pos")).alias(ord_col)
    )
    return out, total


def _offsets(sizes: DataFrame) -> tuple[DataFrame, int]:
    """(_pid, _off) running offsets of (_pid, _s), and the sum of ``_s``.

    One row per range partition reaches the driver and goes back as a table.
    """
    rows = sorted((r["_pid"], int(r["_s"])) for r in sizes.collect())
    table, acc = [], 0
    for pid, size in rows:
        table.append((pid, acc))
        acc += size
    return sizes.sparkSession.createDataFrame(table, "_pid int, _off bigint"), acc


def running_totals(
    df: DataFrame, order: Sequence[str | Column], value: str, out: str, num_partitions: int | None = None
) -> tuple[DataFrame, int]:
    """Running sum of an integer column over a total order, without a single
    task: a range-partitioned table (checkpointed), sums inside partitions,
    and one offset per partition. Also returns the sum of everything."""
    checkpoint_dir(df.sparkSession)
    order = _cols(order)
    staged = (
        df.repartitionByRange(_num_partitions(df, num_partitions), *order)
        .withColumn("_pid", F.spark_partition_id())
        .checkpoint(eager=True)
    )
    offsets, total = _offsets(staged.groupBy("_pid").agg(F.sum(value).alias("_s")))
    w = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = staged.join(F.broadcast(offsets), "_pid").withColumn(out, F.col("_off") + F.sum(value).over(w))
    return totals.drop("_pid", "_off"), total


def with_ordinal(
    df: DataFrame,
    order_cols: Sequence[str],
    ord_col: str = ORD,
    num_partitions: int | None = None,
    tiebreak: Column | None = None,
) -> DataFrame:
    """``with_ordinal_n`` without the count."""
    return with_ordinal_n(df, order_cols, ord_col, num_partitions, tiebreak)[0]


def adaptive_chunk_rows(df: DataFrame, n_rows: int, halo: int) -> int:
    """About one chunk per shuffle partition, never below 64 halos (so the
    copied tail stays under 2 % of the rows)."""
    parts = _num_partitions(df, None)
    return max(-(-n_rows // parts) if n_rows else 1, 64 * max(halo, 1), 1024)


def halo_window(
    df_ord: DataFrame,
    halo: int,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    ord_col: str = ORD,
) -> DataFrame:
    """Cut ordered rows into chunks and copy each chunk's tail into the next.

    Adds ``_chunk`` and ``_home``; compute windows over
    ``Window.partitionBy('_chunk', *groups).orderBy(ord_col)`` and keep only
    ``_home`` rows afterwards.
    """
    c = max(int(chunk_rows), int(halo), 1)
    o = F.col(ord_col)
    chunk = F.floor(o / F.lit(c)).cast("bigint")
    in_tail = (o % F.lit(c)) >= F.lit(c - halo) if halo > 0 else F.lit(False)
    return (
        df_ord.withColumn("_home_chunk", chunk)
        .withColumn(
            "_chunk",
            F.explode(F.when(in_tail, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))),
        )
        .withColumn("_home", F.col("_chunk") == F.col("_home_chunk"))
        .drop("_home_chunk")
    )


def ordered_window_columns(
    df: DataFrame,
    order_cols: Sequence[str],
    group_cols: Sequence[str],
    halo: int,
    make_columns,
    strategy: str = "chunked",
    chunk_rows: int | None = None,
    ordinal_rows: int | None = None,
) -> DataFrame:
    """Add window columns whose frames look back at most ``halo`` rows.

    ``ordinal_rows``: ``df`` already carries ``_ord`` over (groups, order)
    for that many rows (e.g. from ``fill_nulls_ordered``); the chunked form
    then reuses it instead of sorting again.

    ``make_columns(window_spec, look_back) -> dict[name, Column]`` builds the
    columns for a ``WindowSpec`` (already partitioned and ordered);
    ``look_back`` is None for partitioned windows (unbounded frames are
    exact) and ``halo`` for the chunked form (frames must stay within it).

    strategy:
      * ``chunked``  ordinal + chunk + halo: task size bounded by
        ``chunk_rows + halo`` whatever the skew, with or without groups.
        ``chunk_rows=None`` sizes chunks from the row count (about one per
        shuffle partition).
      * ``partition`` plain ``Window.partitionBy(groups).orderBy(order)``:
        for callers that know every group fits one task.
    """
    group_cols = list(group_cols)
    if strategy == "partition" and group_cols:
        w = Window.partitionBy(*group_cols).orderBy(*order_cols)
        return df.withColumns(make_columns(w, None))
    if strategy != "chunked":
        raise ValueError(f"unknown strategy {strategy!r}")
    if ordinal_rows is not None and ORD in df.columns:
        ordered, n = df, ordinal_rows
    else:
        ordered, n = with_ordinal_n(df, [*group_cols, *order_cols])
    framed = halo_window(ordered, halo, chunk_rows or adaptive_chunk_rows(df, n, halo))
    w = Window.partitionBy("_chunk", *group_cols).orderBy(ORD)
    out = framed.withColumns(make_columns(w, halo)).where(F.col("_home"))
    return out.drop("_chunk", "_home", ORD)


def fill_nulls_ordered(
    df: DataFrame,
    columns: Sequence[str],
    order_cols: Sequence[str],
    backward: bool = False,
    chunk_rows: int | None = None,
    group_cols: Sequence[str] = (),
    return_rows: bool = False,
):
    """Forward (or backward) fill over an order, in parallel; within
    each group of ``group_cols`` when given.

    Rows are numbered over (groups, order) and cut into chunks; each
    (chunk, group) is filled with a running frame, and the value to carry
    into it comes from a window over the (chunk, group) edge table -- one row
    per chunk and group, so a hot group spread over many chunks is never one
    task. Adds the ordinal column ``_ord`` (and returns the row count too
    when ``return_rows``).
    """
    columns, groups = list(columns), list(group_cols)
    d, n = with_ordinal_n(df, [*groups, *order_cols])
    chunk_rows = chunk_rows or adaptive_chunk_rows(df, n, 1)
    d = d.withColumn("_chunk", F.floor(F.col(ORD) / F.lit(chunk_rows)).cast("bigint"))
    # Both directions use running frames (unbounded preceding .. current),
    # which Spark evaluates in one pass; a backward fill runs over the
    # descending order instead of an "unbounded following" frame, which
    # Spark would re-aggregate for every row (quadratic in the chunk size).
    if backward:
        inner = Window.partitionBy("_chunk", *groups).orderBy(F.desc(ORD)).rowsBetween(
            Window.unboundedPreceding, 0
        )
        outer_order = F.desc("_chunk")
        edge = [
            F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(ORD))).alias(f"_e_{c}")
            for c in columns
        ]
    else:
        inner = Window.partitionBy("_chunk", *groups).orderBy(ORD).rowsBetween(
            Window.unboundedPreceding, 0
        )
        outer_order = F.asc("_chunk")
        edge = [
            F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(ORD))).alias(f"_e_{c}")
            for c in columns
        ]
    outer = (
        (Window.partitionBy(*groups) if groups else Window)
        .orderBy(outer_order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    filled = d.withColumns({f"_f_{c}": F.last(F.col(c), ignorenulls=True).over(inner) for c in columns})
    carry = (
        d.groupBy("_chunk", *groups)
        .agg(*edge)
        .select(
            "_chunk",
            *groups,
            *[F.last(F.col(f"_e_{c}"), ignorenulls=True).over(outer).alias(f"_c_{c}") for c in columns],
        )
    )
    joined = filled.join(carry, ["_chunk", *groups], "left")
    out_cols = []
    for f in df.columns:
        if f in columns:
            out_cols.append(F.coalesce(F.col(f"_f_{f}"), F.col(f"_c_{f}")).alias(f))
        else:
            out_cols.append(F.col(f))
    result = joined.select(*out_cols, F.col(ORD))
    return (result, n) if return_rows else result


def _nulls_last(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]


def _lex_cmp(cols: Sequence[str], values: Sequence, op: str) -> Column:
    """Lexicographic comparison of ``cols`` with a tuple of literals; NULL
    sorts last and equals NULL, so the result is never NULL.

    op in {'<', '<=', '>='}.
    """
    acc: Column = F.lit(op != "<")
    for c, v in reversed(list(zip(cols, values))):
        col = F.col(c)
        same = col.eqNullSafe(F.lit(v))
        if op == ">=":
            beyond = F.lit(False) if v is None else col.isNull() | (col > F.lit(v))
        else:
            beyond = col.isNotNull() if v is None else col < F.lit(v)
        acc = F.coalesce(beyond, F.lit(False)) | (same & acc)
    return acc


def lex_less(cols: Sequence[str], values: Sequence) -> Column:
    return _lex_cmp(cols, values, "<")


def lex_less_equal(cols: Sequence[str], values: Sequence) -> Column:
    return _lex_cmp(cols, values, "<=")


def lex_greater_equal(cols: Sequence[str], values: Sequence) -> Column:
    return _lex_cmp(cols, values, ">=")


def lex_equal(cols: Sequence[str], values: Sequence) -> Column:
    return _and_all([F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(cols, values)])


def rank_boundaries(df: DataFrame, order_cols: Sequence[str], ranks) -> tuple[int, list[tuple]]:
    """Row count and, for each 1-based rank, (key, place, size): the key of
    that row in the order (NULLs last), its place among the ``size`` rows that
    share the key.

    Level by level: count rows per value of the next key column within the
    prefixes found so far, take running totals over the count table, pick
    the value whose total crosses each rank. One scan per key column for all
    ranks together; the driver sees one row per rank. ``ranks`` may be a
    callable ``n -> ranks``.
    """
    order_cols = list(order_cols)
    pending: list[tuple[int, tuple]] = []
    n_total, sizes = 0, []
    for level, c in enumerate(order_cols):
        prefix_cols = order_cols[:level]
        if level == 0:
            src = df
        else:
            cond = F.lit(False)
            for p in dict.fromkeys(p for _, p in pending):
                cond = cond | lex_equal(prefix_cols, p)
            src = df.where(cond)
        counts = src.groupBy(*prefix_cols, c).agg(F.count(F.lit(1)).alias("_n"))
        cum, total = running_totals(counts, _nulls_last([*prefix_cols, c]), "_n", "_cum")
        base = {(): 0}
        if level == 0:
            n_total = total
            pending = [(int(r), ()) for r in (ranks(total) if callable(ranks) else ranks)]
        else:
            starts = cum.groupBy(*prefix_cols).agg(F.min(F.col("_cum") - F.col("_n")).alias("_b"))
            base = {tuple(r[pc] for pc in prefix_cols): r["_b"] for r in starts.collect()}
        if not pending:
            return n_total, []
        at = [base[p] + rem for rem, p in pending]
        hit = F.lit(False)
        for t in at:
            hit = hit | ((F.col("_cum") >= t) & (F.col("_cum") - F.col("_n") < t))
        rows = cum.where(hit).select(*prefix_cols, c, "_cum", "_n").collect()  # <= one row per rank
        found = []
        for t, (_, p) in zip(at, pending):
            row = next((r for r in rows if r["_cum"] - r["_n"] < t <= r["_cum"]), None)
            if row is None:
                raise ValueError("rank is outside the table")
            found.append((t - (row["_cum"] - row["_n"]), (*p, row[c]), row["_n"]))
        pending = [(rem, key) for rem, key, _ in found]
        sizes = [size for *_, size in found]
    return n_total, [(key, rem, size) for (rem, key), size in zip(pending, sizes)]


def keys_at_ranks(df: DataFrame, order_cols: Sequence[str], ranks) -> list[tuple] | tuple[int, list[tuple]]:
    """Keys only; with callable ``ranks`` also the row count."""
    n, found = rank_boundaries(df, order_cols, ranks)
    keys = [key for key, _, _ in found]
    return (n, keys) if callable(ranks) else keys


def _and_all(conds: list[Column]) -> Column:
    acc = F.lit(True)
    for c in conds:
        acc = acc & c
    return acc


# --------------------------------------------------------------------------
# exact quantiles
# --------------------------------------------------------------------------


def unpivot_numeric(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, value) with value as double, NULL values dropped."""
    stacked = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                for c in columns
            ]
        )
    ).alias("_kv")
    return (
        df.select(*[F.col(b) for b in by], stacked)
        .select(*by, "_kv.column", "_kv.value")
        .where(F.col("value").isNotNull())
    )


# Relative rank error asked of the approximate pass is 1 / ACCURACY; brackets
# reach three times that to both sides of a quantile.
ACCURACY = 10_000


def quantiles(df: DataFrame, columns: Sequence[str], qs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles, linear interpolation (pandas / DuckDB ``quantile_cont``).

    Returns long form (by..., column, q, value). NULL-only groups give no row.

    Two passes, both combined before the shuffle. A quantile sketch brackets
    every quantile; then values inside a bracket are counted one by one and
    values between brackets only by count, minimum and maximum. The exact
    ranks are found in that table, which holds at most 6 / ACCURACY of a
    column's rows for each quantile.
    """
    columns, by, qs = list(columns), list(by), sorted({float(q) for q in qs})
    long = unpivot_numeric(df, columns, by)
    keys = [*by, "column"]
    eps = 3.0 / ACCURACY
    edges = [x for q in qs for x in (max(q - eps, 0.0), min(q + eps, 1.0))]
    sketch = long.groupBy(*keys).agg(
        F.percentile_approx("value", F.array(*[F.lit(x) for x in edges]), F.lit(ACCURACY)).alias("_at"),
        F.min("value").alias("_least"),
        F.max("value").alias("_most"),
    )
    low = [F.col("_least") if q - eps <= 0 else F.col("_at")[2 * i] for i, q in enumerate(qs)]
    high = [F.col("_most") if q + eps >= 1 else F.col("_at")[2 * i + 1] for i, q in enumerate(qs)]
    brackets = sketch.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        *[c.alias(f"_lo{i}") for i, c in enumerate(low)],
        *[c.alias(f"_hi{i}") for i, c in enumerate(high)],
    ).checkpoint()
    if not by:  # a row a column; else the join would deal all values by column
        brackets = F.broadcast(brackets)
    same = _and_all([F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    inside, passed = F.lit(False), F.lit(0)
    for i in range(len(qs)):
        inside = inside | F.col("value").between(F.col(f"_lo{i}"), F.col(f"_hi{i}"))
        passed = passed + F.when(F.col("value") > F.col(f"_hi{i}"), 1).otherwise(0)
    slots = (
        long.join(brackets, same)
        .groupBy(*keys, F.when(inside, F.col("value")).alias("_v"), F.when(~inside, passed).alias("_s"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("value").alias("_min"), F.max("value").alias("_max"))
    )
    group = Window.partitionBy(*keys)
    upto = group.orderBy("_min").rowsBetween(Window.unboundedPreceding, 0)
    ranked = slots.withColumn("_cum", F.sum("_n").over(upto)).withColumn("_all", F.sum("_n").over(group))

    def value_at(place):
        here = (F.col("_cum") > place) & (F.col("_cum") - F.col("_n") <= place)
        first = F.col("_cum") - F.col("_n") == place
        return F.max(F.when(here, F.coalesce("_v", F.when(first, F.col("_min")).otherwise(F.col("_max")))))

    found = []
    for i, q in enumerate(qs):
        at = (F.col("_all") - 1).cast("double") * q
        found += [
            value_at(F.floor(at)).alias(f"_a{i}"),
            value_at(F.ceil(at)).alias(f"_b{i}"),
            F.max(at - F.floor(at)).alias(f"_f{i}"),
        ]
    rows = ranked.groupBy(*keys).agg(*found)
    each = F.array(
        *[
            F.struct(
                F.lit(q).alias("q"),
                (F.col(f"_a{i}") + (F.col(f"_b{i}") - F.col(f"_a{i}")) * F.col(f"_f{i}")).alias("value"),
            )
            for i, q in enumerate(qs)
        ]
    )
    return rows.select(*keys, F.inline(each))


def quantile_columns(
    df: DataFrame,
    columns: Sequence[str],
    qs: Sequence[float],
    by: Sequence[str] = (),
    name=lambda c, q: f"{c}_q{int(round(q * 100))}",
) -> DataFrame:
    """Quantiles pivoted wide: one row per ``by`` group, one column per (c, q)."""
    long = quantiles(df, columns, qs, by)
    tags = {(c, q): name(c, q) for c in columns for q in qs}
    aggs = [
        F.max(F.when((F.col("column") == c) & (F.col("q") == F.lit(q)), F.col("value"))).alias(t)
        for (c, q), t in tags.items()
    ]
    if by:
        return long.groupBy(*by).agg(*aggs)
    return long.agg(*aggs)
