"""Leaf-wise boosting against a plain loop that grows one leaf at a time, and DuckDB over its nodes."""

import datetime as dt
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerloom.operators import selection
from tickerloom.plans import boosting

COLUMNS = ["x", "y2", "z"]


def whole(v):
    return math.floor(v * boosting.SCALE + 0.5)


def draw(row, tree):
    return float(boosting._draw(np.array([row], np.int64), tree)[0])


def brute_edges(values, bins):
    values = sorted(v for v in values if v is not None)
    n = len(values)
    return sorted({values[math.ceil(k * n / bins) - 1] for k in range(1, bins) if n and math.ceil(k * n / bins)})


def brute(rows, trees, step, max_leaves, min_rows=20, row_share=1.0, column_share=1.0, max_depth=None):
    """(tree, path, feature, threshold, null_left) of every split, and the scores of all rows."""
    edges = {c: brute_edges([r[c] for r in rows if not r["_held"]], boosting.BINS) for c in COLUMNS}
    train = [r for r in rows if not r["_held"]]
    base = float(sum(whole(r["_w"] * r["_y"]) for r in train)) / float(sum(whole(r["_w"]) for r in train))
    scores = [base] * len(rows)
    splits = []

    def left(r, column, edge, null_left):
        return null_left if r[column] is None else r[column] <= edge

    def best(members, used):
        g, h = (sum(x) for x in zip(*[(gs[k], hs[k]) for k in members]))
        found = None
        for column in used:
            for edge in [*edges[COLUMNS[column]], math.inf]:
                for null_left in (True, False):
                    one = [k for k in members if left(rows[k], COLUMNS[column], edge, null_left)]
                    if len(one) < min_rows or len(members) - len(one) < min_rows:
                        continue
                    a, b = sum(gs[k] for k in one), sum(hs[k] for k in one)
                    c, d = g - a, h - b
                    gain = float(a) * a / b + float(c) * c / d - float(g) * g / h
                    if gain > 0 and (found is None or gain > found[0]):
                        found = (gain, column, edge, null_left)
        return found

    for tree in range(1, trees + 1):
        used = boosting.sampled_columns(len(COLUMNS), column_share, tree)
        gs = [whole(r["_w"] * (r["_y"] - s)) for r, s in zip(rows, scores)]
        hs = [whole(r["_w"]) for r in rows]
        sample = [k for k, r in enumerate(rows) if not r["_held"] and draw(r["_row"], tree) < row_share]
        leaves = {1: sample}
        everywhere = {1: list(range(len(rows)))}
        found = {1: best(sample, used)}
        while len(leaves) < max_leaves:
            open_ = [(-s[0], p) for p, s in found.items() if s and (max_depth is None or p.bit_length() <= max_depth)]
            if not open_:
                break
            path = min(open_)[1]
            _, column, edge, null_left = found.pop(path)
            splits.append((tree, path, COLUMNS[column], edge, null_left))
            for source in (leaves, everywhere):
                members = source.pop(path)
                goes = [left(rows[k], COLUMNS[column], edge, null_left) for k in members]
                source[2 * path] = [k for k, g in zip(members, goes) if g]
                source[2 * path + 1] = [k for k, g in zip(members, goes) if not g]
            for child in (2 * path, 2 * path + 1):
                found[child] = best(leaves[child], used)
        for path, members in leaves.items():
            value = float(sum(gs[k] for k in members)) / float(sum(hs[k] for k in members))
            for k in everywhere[path]:
                scores[k] = scores[k] + value * step
    return sorted(splits), scores


def made(n, seed=1, missing=0.1, held=0.0):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        x, z = rng.gauss(0, 1), rng.choice([-1.0, 0.0, 0.0, 2.5])
        row = {"x": x, "y2": round(rng.gauss(0, 1), 1), "z": z}
        y = (x > 0.3) * 1.0 - 0.5 * (z > 0) + 0.1 * row["y2"] + rng.gauss(0, 0.3)
        for c in COLUMNS:
            if rng.random() < missing:
                row[c] = None
        out.append({"_row": k * 7919, **row, "_y": y, "_w": rng.choice([0.5, 1.0, 2.0]), "_held": rng.random() < held})
    return out


SCHEMA = "_row long, x double, y2 double, z double, _y double, _w double, _held boolean"


def frame(spark, rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).repartition(3)


def paths(nodes):
    """The splits of a node table with the path of each."""
    out, path = [], {}
    for r in nodes.orderBy("tree", "node").collect():
        here = path.setdefault((r.tree, r.node), 1)
        if r.feature is not None:
            path[r.tree, r.left], path[r.tree, r.right] = 2 * here, 2 * here + 1
            out.append((r.tree, here, r.feature, r.threshold, r.null_left))
    return sorted(out)


@pytest.mark.parametrize(
    "options",
    [
        dict(max_leaves=9, row_share=1.0, column_share=1.0),
        dict(max_leaves=6, row_share=0.8, column_share=0.7),
        dict(max_leaves=40, row_share=1.0, column_share=1.0, min_rows=5, max_depth=3),
    ],
)
def test_trees_are_those_of_one_by_one_growth(spark, options):
    rows = made(400)
    model = boosting.fit(frame(spark, rows), COLUMNS, 3, 0.3, patience=None, **options)
    nodes = model.table(spark)
    splits, scores = brute(rows, 3, 0.3, **options)
    assert paths(nodes) == splits
    found = {r._row: r.prediction for r in boosting.score(frame(spark, rows), nodes).collect()}
    assert [found[r["_row"]] for r in rows] == scores


def test_missing_values_alone_can_be_a_side(spark):
    rng = random.Random(2)
    rows = [
        {"_row": k, "x": None if k % 2 else rng.random(), "y2": None, "z": 0.0, "_y": k % 2 + rng.gauss(0, 0.1), "_w": 1.0, "_held": False}
        for k in range(700)
    ]
    model = boosting.fit(frame(spark, rows), COLUMNS, 1, 1.0, patience=None, row_share=1, column_share=1)
    (tree, path, feature, threshold, null_left), *_ = paths(model.table(spark))
    assert (path, feature, threshold, null_left) == (1, "x", math.inf, False)
    found = {r._row: r.prediction for r in boosting.score(frame(spark, rows), model.table(spark)).collect()}
    assert all((found[k] > 0.5) == (k % 2 == 1) for k in range(700))


def test_no_tree_is_trained_twice(spark, monkeypatch):
    rows = made(600, seed=4, held=0.3)
    grown = []
    grow = boosting._Grower.grow
    monkeypatch.setattr(boosting._Grower, "grow", lambda self: grown.append(1) or grow(self))
    monkeypatch.setattr(boosting, "TREES_PER_STAGE", 2)
    model = boosting.fit(frame(spark, rows), COLUMNS, 60, 0.5, patience=3, max_leaves=8)
    assert len(grown) == model.trained == len(model.losses)
    best = int(np.argmin(model.losses)) + 1
    assert len(model.trees) == best and (model.trained == best + 3 or model.trained == 60)
    # The losses are those of the model on the held rows.
    table = model.table(spark)
    held = frame(spark, rows).where("_held")
    for n in (1, best):
        scored = boosting.score(held, table.where(F.col("tree") <= n))
        loss = scored.agg(F.avg((F.col("_y") - F.col("prediction")) ** 2)).first()[0]
        assert loss == pytest.approx(model.losses[n - 1], abs=1e-4)


def test_stages_of_any_length_give_the_same_model(spark, monkeypatch):
    rows = made(300, seed=5)
    found = []
    for n in (1, 2, 50):
        monkeypatch.setattr(boosting, "TREES_PER_STAGE", n)
        model = boosting.fit(frame(spark, rows).repartition(n), COLUMNS, 5, 0.3, patience=None, max_leaves=5)
        found.append(model.table(spark).orderBy("tree", "node").collect())
    assert found[0] == found[1] == found[2]


def test_few_cells_at_a_time(spark, monkeypatch):
    rows = made(400, seed=6)
    table = frame(spark, rows)
    want = boosting.fit(table, COLUMNS, 1, 0.3, patience=None, max_leaves=12, min_rows=10).table(spark).collect()
    monkeypatch.setattr(boosting, "CELLS", 1)
    found = boosting.fit(table, COLUMNS, 1, 0.3, patience=None, max_leaves=12, min_rows=10).table(spark).collect()
    assert found == want


def test_duckdb_walks_the_written_nodes(spark, tmp_path):
    rows = made(500, seed=7)
    model = boosting.fit(frame(spark, rows), COLUMNS, 4, 0.2, patience=None, max_leaves=16)
    path = str(tmp_path / "model")
    boosting.save_model(model.table(spark), path)
    nodes = boosting.load_model(spark, path)
    assert len(model.trees) == 4 and nodes.agg(F.max("tree")).first()[0] == 4
    frame(spark, rows).write.parquet(str(tmp_path / "rows"))
    sql = f"""
    WITH RECURSIVE n AS (SELECT * FROM '{path}/*.parquet'),
    r AS (SELECT * FROM '{tmp_path}/rows/*.parquet'),
    cells AS (SELECT "_row", 'x' AS feature, x AS v FROM r UNION ALL SELECT "_row", 'y2', y2 FROM r
              UNION ALL SELECT "_row", 'z', z FROM r),
    walk AS (
      SELECT "_row", tree, 0 AS node FROM r, (SELECT DISTINCT tree FROM n)
      UNION ALL
      SELECT w."_row", w.tree, CASE WHEN coalesce(c.v <= n.threshold, n.null_left) THEN n."left" ELSE n."right" END
      FROM walk w JOIN n ON n.tree = w.tree AND n.node = w.node AND n.feature IS NOT NULL
           JOIN cells c ON c."_row" = w."_row" AND c.feature = n.feature
    )
    SELECT "_row", list(value ORDER BY tree) FROM walk JOIN n USING (tree, node) WHERE n.feature IS NULL GROUP BY "_row"
    """
    want = {}
    for row, values in duckdb.sql(sql).fetchall():
        total = 0.0
        for v in values:
            total += v
        want[row] = total
    found = {r._row: r.prediction for r in boosting.score(frame(spark, rows), nodes).collect()}
    assert found == want and len(found) == 500


def test_nothing_to_learn(spark):
    rows = made(30)
    model = boosting.fit(frame(spark, rows), COLUMNS, 5, patience=2)
    assert model.trees == [] and model.trained == 0
    scores = {r.prediction for r in boosting.score(frame(spark, rows), model.table(spark)).collect()}
    assert scores == {model.base}
    empty = boosting.fit(frame(spark, rows).where("false"), COLUMNS, 5)
    assert empty.trees == [] and empty.base == 0.0


def test_run(spark):
    rng = random.Random(2)
    rows = []
    for s in range(12):
        for d in range(90):
            x, y = rng.gauss(0, 1), rng.gauss(0, 1)
            rows.append((f"S{s}", dt.date(2020, 1, 1) + dt.timedelta(d), x, y, 0.3 * x + 0.1 * y * y + rng.gauss(0, 0.3)))
    table = spark.createDataFrame(rows, "symbol string, date date, x double, y double, target_5 double")
    options = dict(long_pct=0.2, step_size=0.3, max_leaves=8)
    for validation in ("train", "test", None):
        found = boosting.train_predict(table, max_iter=6, patience=2, validation=validation, **options)
        assert 1 <= found.trees <= 6 and found.predictions.count() > 0
        assert found.nodes.agg(F.max("tree")).first()[0] == found.trees
    with pytest.raises(ValueError):
        boosting.train_predict(table, validation="tail")


# Order statistics


@pytest.mark.parametrize("finish", [0, 10, 1_000_000])
def test_values_at(spark, finish):
    rng = random.Random(finish)
    values = [rng.choice([rng.gauss(0, 1), rng.gauss(0, 1e300), 0.0, -0.0, 7.0, 1e-320, math.inf, -math.inf]) for _ in range(3000)]
    rows = [(None if k % 11 == 0 else v, math.nan if k % 7 == 0 else float(k % 5), k) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, "a double, b double, c long").repartition(5)
    present = {
        "a": sorted(r[0] for r in rows if r[0] is not None), "b": sorted(r[1] for r in rows if r[1] == r[1]),
        "c": [float(k) for k in range(3000)],
    }
    positions = {c: sorted({0, 1, len(v) // 3, len(v) // 2, len(v) - 2, len(v) - 1}) for c, v in present.items()}
    found = selection.values_at(df, positions, finish)
    assert {c: v.tolist() for c, v in found.items()} == {c: [present[c][p] for p in at] for c, at in positions.items()}


def test_quantiles_of(spark):
    rng = np.random.default_rng(3)
    values = rng.normal(size=1001)
    df = spark.createDataFrame([(float(v), None) for v in values], "a double, b double")
    shares = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]
    found = selection.quantiles_of(df, ["a", "b"], shares)
    assert found["a"] == pytest.approx(np.quantile(values, shares).tolist(), abs=1e-12)
    assert found["b"] == [None] * 6
    assert selection.values_at(df, {"a": []})["a"].tolist() == []


def test_target_analysis_beyond_one_aggregate(spark):
    from tickerloom.operators import quality

    rng = np.random.default_rng(4)
    rows = [(float(v), None if k % 3 else float(k), None) for k, v in enumerate(rng.normal(size=800))]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(4)
    small = quality.target_analysis(df, ["a", "b", "c"])
    large = quality.target_analysis(df, ["a", "b", "c"], rows_per_task=50)
    assert "Sort" not in large._jdf.queryExecution().executedPlan().toString()
    expected = df.toPandas().describe()
    for one, other in zip(small.collect(), large.collect()):
        for name in ("n", "mean", "std", "min", "q25", "q50", "q75", "max", "extreme"):
            assert one[name] == other[name] or one[name] == pytest.approx(other[name], rel=1e-12)
        if one.n:
            found = [one[x] for x in ("n", "mean", "std", "min", "q25", "q50", "q75", "max")]
            assert found == pytest.approx(expected[one.target].tolist(), rel=1e-12)
