"""Ordered work inside groups, when one group may hold a large share of all rows.

A window partitioned by symbol or date runs each group in one task. So the rows per
group are counted first. If no group is above `rows_per_task`, the plain window is
used. Otherwise the large groups are cut into consecutive chunks along the order and
windows are partitioned by (group, chunk):

* the cut points are every `SAMPLES_PER_CHUNK`-th row of a hash sample of the large
  groups, so a chunk holds about `rows_per_task` rows and never fewer than
  `SAMPLES_PER_CHUNK`;
* the sample is chosen by a hash of the row's key, so a recomputed task picks the
  same rows and the same cut points; it is numbered, and only the cut points are gathered;
* cut points, chunk counts and the few rows around the cuts are written stages, so the
  rows themselves appear once in the plan.

Rows without a key are a group like any other. Bars by symbol need no count: a symbol has
at most one bar per calendar day, which is fewer than `ROWS_PER_TASK`.

Broadcast tables here have at most (all rows / rows_per_task) groups or cut points.
"""

from functools import reduce
from operator import and_, or_

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lineage import CALENDAR_DAYS, cut_lineage

ROWS_PER_TASK = 5_000_000
SAMPLES_PER_CHUNK = 64
# Values of a group that one aggregate may hold at a time.
PERCENTILE_ROWS = 500_000
_HASH_RANGE = 1 << 40
# Stands for "count the groups and find out".
_FIND = object()


def group_sizes(df, keys):
    """Rows per group. Any upper bound of it can be passed as `sizes` below."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))


def count_groups(sizes):
    """Number of groups and rows of the largest one."""
    row = sizes.agg(F.count(F.lit(1)), F.max("_rows")).first()
    return row[0], row[1] or 0


def join_keys(rows, few, keys, how):
    """Join a broadcast table of few rows on keys that may be NULL."""
    named = few.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return rows.join(F.broadcast(named), same, how).drop(*[f"_key_{k}" for k in keys])


def bounded_by_calendar(df, keys, order, rows_per_task):
    """Whether a group is one bar per calendar day at most (the contract of `bars`)."""
    return (
        list(keys) == ["symbol"]
        and list(order) == ["date"]
        and isinstance(df.schema["date"].dataType, T.DateType)
        and rows_per_task >= CALENDAR_DAYS
    )


def cut_points(df, keys, order, sizes=None, rows_per_task=ROWS_PER_TASK):
    """`keys`, `_cuts`, the sorted first rows of chunks 1, 2, ... of each large group, and
    `_steps`, one element per step of a binary search in them.

    None if no group is large. The functions below take the result as `points`, or the
    other arguments to find it themselves.
    """
    if bounded_by_calendar(df, keys, order, rows_per_task):
        return None
    sizes = group_sizes(df, keys) if sizes is None else sizes
    if count_groups(sizes)[1] <= rows_per_task:
        return None
    large = sizes.where(F.col("_rows") > rows_per_task).select(*keys)
    threshold = min(1.0, SAMPLES_PER_CHUNK / rows_per_task) * _HASH_RANGE
    marks = join_keys(
        df.select(*keys, *order).where(
            F.pmod(F.xxhash64(*keys, *order), F.lit(_HASH_RANGE)) < F.lit(int(threshold))
        ),
        large,
        keys,
        "left_semi",
    )
    group = Window.partitionBy(*keys)
    numbered = marks.withColumns(
        {
            "_mark": F.row_number().over(group.orderBy(*order)) - 1,
            "_left": F.row_number().over(group.orderBy(*[F.desc(c) for c in order])),
        }
    )
    starts_chunk = (
        (F.col("_mark") > 0)
        & (F.col("_mark") % SAMPLES_PER_CHUNK == 0)
        & (F.col("_left") >= SAMPLES_PER_CHUNK)
    )
    # One row per `rows_per_task` rows is left.
    cuts = numbered.where(starts_chunk).groupBy(*keys).agg(
        F.array_distinct(F.array_sort(F.collect_list(F.struct(*order)))).alias("_cuts")
    )
    steps = F.greatest(F.ceil(F.log2(F.size("_cuts") + 1)).cast("int"), F.lit(1))
    return cut_lineage(cuts.withColumn("_steps", F.sequence(F.lit(1), steps)))


def _chunk_of(cuts, steps, row):
    """Number of cut points at or below `row`."""

    def halve(span, _):
        middle = F.shiftright(span["lo"] + span["hi"], 1)
        return (
            F.when(span["lo"] >= span["hi"], span)
            .when(
                F.get(cuts, middle) <= row,
                F.struct((middle + 1).alias("lo"), span["hi"].alias("hi")),
            )
            .otherwise(F.struct(span["lo"].alias("lo"), middle.alias("hi")))
        )

    return F.aggregate(
        steps,
        F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi")),
        halve,
        lambda span: span["lo"],
    )


def _place(df, keys, order, points, how="left"):
    """Adds `_chunk`."""
    if points is None:
        return df.withColumn("_chunk", F.lit(0))
    chunk = _chunk_of(F.col("_cuts"), F.col("_steps"), F.struct(*order))
    return (
        join_keys(df, points, keys, how)
        .withColumn("_chunk", F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(chunk))
        .drop("_cuts", "_steps")
    )


def _chunk_counts(df, keys, order, points):
    """`_n` rows of every chunk of the large groups and `_before`, those of earlier chunks."""
    so_far = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_chunk"))
    return (
        _place(df.select(*keys, *order), keys, order, points, "inner")
        .groupBy(*keys, "_chunk")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", so_far - F.col("_n"))
    )


def _number_in_chunk(keys, order):
    in_chunk = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    return F.row_number().over(in_chunk).cast("bigint")


def _number(df, keys, order, points):
    """Adds `_chunk` and `_pos`."""
    number = _number_in_chunk(keys, order)
    rows = _place(df, keys, order, points)
    if points is None:
        return rows.withColumn("_pos", number)
    earlier = cut_lineage(_chunk_counts(df, keys, order, points).drop("_n"))
    return (
        join_keys(rows, earlier, [*keys, "_chunk"], "left")
        .withColumn("_pos", F.coalesce("_before", F.lit(0)) + number)
        .drop("_before")
    )


def with_position(df, keys, order, **skew):
    """Adds `_pos`, the exact 1-based row number inside the group (NULLs first).

    `keys + order` must identify a row, or the order of equal rows is arbitrary.
    """
    points = cut_points(df, keys, order, **skew)
    return _number(df, keys, order, points).drop("_chunk")


def with_neighbours(df, keys, order, before=0, after=0, points=_FIND, **skew):
    """Adds `_chunk` and `_halo`.

    Every chunk also gets copies (`_halo` true) of the `before` rows ahead of it and
    the `after` rows behind it, so bounded row frames over (keys, _chunk) give its own
    rows the same values as frames over the whole group.
    """
    if max(before, after) > SAMPLES_PER_CHUNK:
        raise ValueError(f"a chunk may hold only {SAMPLES_PER_CHUNK} rows")
    if points is _FIND:
        points = cut_points(df, keys, order, **skew)
    rows = _place(df, keys, order, points).withColumn("_halo", F.lit(False))
    if points is None:
        return rows
    large = _place(df, keys, order, points, "inner").withColumn("_halo", F.lit(True))
    for count, step, direction in ((before, 1, F.desc), (after, -1, F.asc)):
        if count:
            edge = Window.partitionBy(*keys, "_chunk").orderBy(*[direction(c) for c in order])
            copies = (
                large.withColumn("_k", F.row_number().over(edge))
                .where(F.col("_k") <= count)
                .drop("_k")
                .withColumn("_chunk", F.col("_chunk") + step)
            )
            rows = rows.unionByName(cut_lineage(copies))
    return rows


def over_groups(df, keys, order, add, before=0, after=0, **cuts):
    """`add(rows, window)` adds columns from row frames that reach at most `before` rows
    back and `after` rows ahead on `window` (groups `keys`, ordered by `order`)."""
    rows = with_neighbours(df, keys, order, before, after, **cuts)
    window = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    return add(rows, window).where(~F.col("_halo")).drop("_chunk", "_halo")


def over_symbols(df, add, before=0, after=0, **cuts):
    return over_groups(df, ["symbol"], ["date"], add, before, after, **cuts)


def with_average_rank(df, keys, value, ties, **skew):
    """Adds `_rank`: equal values share the mean of their positions (NULLs first).

    `ties` are columns that make (keys, value, ties) unique. They only serve to cut a
    long run of equal values into chunks; such a run (at most one per cut point) is put
    together again from its first and last position.
    """
    order = [value, *ties]
    points = cut_points(df, keys, order, **skew)
    if points is None:
        # One sort: the ties of a row are the rows of its RANGE frame.
        by_value = Window.partitionBy(*keys).orderBy(value)
        ties_too = F.count(F.lit(1)).over(by_value.rangeBetween(Window.currentRow, Window.currentRow))
        return df.withColumn("_rank", F.rank().over(by_value) + (ties_too - 1) / F.lit(2.0))
    run = Window.partitionBy(*keys, "_chunk", value)
    ranked = _number(df, keys, order, points)
    cut_values = (
        points.select(*keys, F.explode("_cuts").alias("_cut"))
        .select(*keys, F.col(f"_cut.{value}").alias(value))
        .distinct()
    )
    cut_runs = cut_lineage(
        _number(df.select(*keys, *order), keys, order, points)
        .transform(join_keys, cut_values, [*keys, value], "left_semi")
        .groupBy(*keys, value)
        .agg(F.min("_pos").alias("_run_first"), F.max("_pos").alias("_run_last"))
    )
    ranked = ranked.withColumns({"_first": F.min("_pos").over(run), "_last": F.max("_pos").over(run)})
    ranked = join_keys(ranked, cut_runs, [*keys, value], "left")
    first, last = F.coalesce("_run_first", "_first"), F.coalesce("_run_last", "_last")
    return ranked.withColumn("_rank", (first + last) / F.lit(2.0)).drop(
        "_pos", "_chunk", "_first", "_last", "_run_first", "_run_last"
    )


def quantiles(df, keys, value, probabilities, ties, join_sizes, **skew):
    """Exact linearly interpolated quantiles: `keys`, `_n` and the array `_quantiles`.

    NULL values are left out. Without a large group, one aggregate finds them. Of a large
    group, only the chunks that hold a quantile are sorted. `join_sizes(rows, counts)` joins
    the one-row-per-group table `counts` to `rows`.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, value, *ties)
    most = min(skew.pop("rows_per_task", ROWS_PER_TASK), PERCENTILE_ROWS)
    points = cut_points(rows, keys, [value, *ties], rows_per_task=most, **skew)
    if points is None:
        wanted = F.array(*[F.lit(float(p)) for p in probabilities])
        return rows.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_n"), F.percentile(value, wanted).alias("_quantiles")
        )
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    at = [F.lit(float(p)) * (F.col("_n") - F.lit(1)) for p in probabilities]
    wanted = [bound(t) + 1 for t in at for bound in (F.floor, F.ceil)]
    order = [value, *ties]
    chunks = _chunk_counts(rows, keys, order, points).withColumnRenamed("_n", "_in_chunk")
    holds = [
        (w > F.col("_before")) & (w <= F.col("_before") + F.col("_in_chunk")) for w in wanted
    ]
    needed = cut_lineage(
        chunks.withColumn("_n", F.sum("_in_chunk").over(Window.partitionBy(*keys)))
        .where(reduce(or_, holds))
        .select(*keys, "_chunk", "_before")
    )
    large = join_keys(_place(rows, keys, order, points, "inner"), needed, [*keys, "_chunk"], "inner")
    zero = F.lit(0)
    others = join_keys(rows, points.select(*keys), keys, "left_anti")
    others = others.withColumns({"_chunk": zero, "_before": zero.cast("bigint")})
    numbered = large.unionByName(others).withColumn(
        "_pos", F.col("_before") + _number_in_chunk(keys, order)
    )
    found = (
        join_sizes(numbered, counts)
        .where(reduce(or_, [F.col("_pos") == w for w in wanted]))
        .groupBy(*keys, "_n")
        .agg(F.map_from_entries(F.collect_list(F.struct("_pos", value))).alias("_at"))
    )

    def interpolate(t):
        low = F.element_at("_at", F.floor(t) + 1)
        high = F.element_at("_at", F.ceil(t) + 1)
        part, gap = t - F.floor(t), high - low
        # From the nearer end, so that the last digit agrees with other tools.
        return F.when(part < 0.5, low + gap * part).otherwise(high - gap * (F.lit(1.0) - part))

    return found.select(*keys, "_n", F.array(*[interpolate(t) for t in at]).alias("_quantiles"))
