"""Means and deviations over the last 5, 10, 20 and 50 rows.

A row frame is aggregated anew for every row, so its cost grows with its length. Here
only the shortest window is a frame. A longer one is put together from shorter ones
some rows back, by the rule for merging means and squared deviations, which loses no
precision. A window that is not full is NULL.
"""

from pyspark.sql import functions as F

# Each window as (rows, rows back) of shorter ones.
PARTS = {
    10: ((5, 0), (5, 5)),
    20: ((10, 0), (10, 10)),
    50: ((20, 0), (20, 20), (10, 40)),
}
SHORTEST = 5
WINDOWS = (SHORTEST, *PARTS)


def mean_name(value, n):
    return f"_mean_{n}_{value}"


def _squares_name(value, n):
    return f"_squares_{n}_{value}"


def deviation(value, n):
    """Sample deviation from the columns of `add_rolling`."""
    return F.expr(f"sqrt({_squares_name(value, n)} / {n - 1}D)")


def _names(v, deviations):
    return (mean_name, _squares_name) if v in deviations else (mean_name,)


def add_rolling(rows, w, values, deviations=None):
    """Adds the mean of every window and value, and for `deviations` (default: all values)
    the sum of squared deviations."""
    deviations = values if deviations is None else deviations
    frame = w.rowsBetween(-(SHORTEST - 1), 0)
    over_frame = {}
    for v in values:
        over_frame[f"_n_{v}"] = F.count(v).over(frame)
        over_frame[mean_name(v, SHORTEST)] = F.avg(v).over(frame)
        if v in deviations:
            over_frame[_squares_name(v, SHORTEST)] = F.var_pop(v).over(frame)
    only_full = {}
    for v in values:
        for name, factor in ((mean_name, 1), (_squares_name, SHORTEST))[: len(_names(v, deviations))]:
            c = name(v, SHORTEST)
            only_full[c] = F.expr(f"CASE WHEN _n_{v} = {SHORTEST} THEN {c} * {factor}D END")
    rows = rows.withColumns(over_frame).withColumns(only_full)

    for n, parts in PARTS.items():
        earlier = {
            f"{name(v, size)}_{back}": F.lag(name(v, size), back).over(w)
            for v in values
            for size, back in parts
            if back
            for name in _names(v, deviations)
        }

        def part(name, v, size, back):
            return f"{name(v, size)}_{back}" if back else name(v, size)

        means, squares = {}, {}
        for v in values:
            mean = mean_name(v, n)
            total = " + ".join(f"{size}D * {part(mean_name, v, size, back)}" for size, back in parts)
            means[mean] = F.expr(f"({total}) / {n}D")
            if v in deviations:
                squares[_squares_name(v, n)] = F.expr(
                    " + ".join(
                        f"{part(_squares_name, v, size, back)}"
                        f" + {size}D * power({part(mean_name, v, size, back)} - {mean}, 2D)"
                        for size, back in parts
                    )
                )
        rows = rows.withColumns(earlier).withColumns(means)
        if squares:
            rows = rows.withColumns(squares)
    return rows


def drop_rolling(rows, values):
    """Without the helper columns of `add_rolling`."""
    helpers = tuple(f"_{v}" for v in values)
    return rows.drop(
        *[
            c
            for c in rows.columns
            if c.startswith(("_mean_", "_squares_", "_n_"))
            and any(h in c for h in helpers)
        ]
    )
