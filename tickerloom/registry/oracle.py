"""DuckDB SQL for the registered queries, over the same tables."""

from ..schema import ROLL_WINDOWS, TARGET_HORIZONS

LONG_PCT = 0.1
SHORT_PCT = 0.1

FEATURES = (
    ["open", "high", "low", "close", "volume", "openint", "type", "return_1d", "return_5d"]
    + [f"{kind}_{n}" for kind in ("ma_ratio", "vol", "zscore") for n in ROLL_WINDOWS]
    + ["market_vol_regime", "momentum_vol_adj", "reversion_strength", "combo_momentum"]
)
TARGETS = [f"target_{h}" for h in TARGET_HORIZONS]


def r6(expr, name=None):
    """Same rounding as `queries.rounded`."""
    return f"floor(({expr}) * 1e6::DOUBLE + 0.5::DOUBLE) / 1e6::DOUBLE AS {name or expr}"


def s9(expr, name=None):
    """Same rounding as `queries.significant`."""
    return f"CAST(printf('%.8e', CAST({expr} AS DOUBLE)) AS DOUBLE) AS {name or expr}"


def zscore(value, partition):
    return (
        f"({value} - avg({value}) OVER (PARTITION BY {partition}))"
        f" / (stddev_samp({value}) OVER (PARTITION BY {partition}) + 1e-8::DOUBLE)"
    )


def correlation(x, y):
    return f"covar_samp({x}, {y}) / nullif(stddev_samp({x}) * stddev_samp({y}), 0)"


def full(aggregate, value, n):
    frame = f"(PARTITION BY symbol ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({value}) OVER {frame} = {n} THEN {aggregate}({value}) OVER {frame} END"


def unpivot(table, pairs, key, value):
    """One row per (label, expression) of a one-row table."""
    return " UNION ALL ".join(
        f"SELECT '{label}' AS {key}, {expr} AS {value} FROM {table}" for label, expr in pairs
    )


RANK_IN_DATE = (
    "(rank() OVER (PARTITION BY date ORDER BY {v})"
    " + (count(*) OVER (PARTITION BY date, {v}) - 1) / 2.0::DOUBLE)"
)

BARS = """
bars AS (
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date,
         min(l_extendedprice) AS open, max(l_extendedprice) AS high,
         min(l_extendedprice) AS low, max(l_extendedprice) AS close,
         CAST(sum(l_quantity) AS BIGINT) AS volume, count(*) AS openint,
         CAST(l_suppkey % 2 AS TINYINT) AS type
  FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE))"""


def returns_of(source="bars", name="returned"):
    lagged = ", ".join(
        f"close / nullif(lag(close, {k}) OVER (PARTITION BY symbol ORDER BY date), 0) - 1"
        f" AS return_{k}d"
        for k in (1, 5)
    )
    return f"{name} AS (SELECT *, {lagged} FROM {source})"


RETURNED = returns_of()

MOMENTUM = ", ".join(
    f"close / nullif(({full('avg', 'close', n)}) + 1e-9::DOUBLE, 0) AS ma_ratio_{n}"
    for n in ROLL_WINDOWS
)
VOLATILITY = ", ".join(f"{full('stddev_samp', 'return_1d', n)} AS vol_{n}" for n in ROLL_WINDOWS)
ZSCORES = ", ".join(
    f"(close - ({full('avg', 'close', n)})) / (({full('stddev_samp', 'close', n)}) + 1e-9::DOUBLE)"
    f" AS zscore_{n}"
    for n in ROLL_WINDOWS
)
TARGET_COLUMNS = ", ".join(
    f"lead(close, {h}) OVER (PARTITION BY symbol ORDER BY date) / nullif(close, 0) - 1"
    f" AS target_{h}"
    for h in TARGET_HORIZONS
)


def regime_of(scope, source="returned"):
    """CTEs ending in `regimes`: `source` with market_vol_regime."""
    order = "ORDER BY symbol, date" if scope == "row_order" else "PARTITION BY symbol ORDER BY date"
    return f"""
day_dev AS (SELECT date, stddev_samp(return_1d) AS dev FROM {source} GROUP BY date),
day_level AS (
  SELECT date, CASE WHEN count(dev) OVER w >= 5 THEN avg(dev) OVER w END AS level
  FROM day_dev WINDOW w AS (ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
leveled AS (SELECT s.*, l.level FROM {source} s LEFT JOIN day_level l ON s.date = l.date),
regimes AS (
  SELECT * EXCLUDE (level),
         level / nullif((CASE WHEN count(level) OVER w = 50 THEN avg(level) OVER w END)
                        + 1e-9::DOUBLE, 0) AS market_vol_regime
  FROM leveled WINDOW w AS ({order} ROWS BETWEEN 49 PRECEDING AND CURRENT ROW))"""


def features_of(scope="row_order", source="bars"):
    """CTEs ending in `features` with all feature and target columns, incomplete rows too."""
    return f"""
{returns_of(source)},
{regime_of(scope)},
windows AS (SELECT *, {MOMENTUM}, {VOLATILITY}, {ZSCORES}, {TARGET_COLUMNS} FROM regimes),
features AS (
  SELECT *, return_5d / nullif(vol_20 + 1e-9::DOUBLE, 0) AS momentum_vol_adj,
         -zscore_20 AS reversion_strength, return_5d * ma_ratio_10 AS combo_momentum
  FROM windows)"""


COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in FEATURES + TARGETS)
COMPLETE_FEATURES = f"complete AS (SELECT * FROM features WHERE {COMPLETE})"

SCORED = f"""{BARS}, {RETURNED},
scored AS (
  SELECT date, symbol, return_5d / nullif(vol_20 + 1e-9::DOUBLE, 0) AS prediction,
         target_5 AS target
  FROM (SELECT *, {VOLATILITY}, {TARGET_COLUMNS} FROM returned)
  WHERE return_5d / nullif(vol_20 + 1e-9::DOUBLE, 0) IS NOT NULL AND target_5 IS NOT NULL)"""

PREDICTIONS = f"""{SCORED},
predictions AS (
  SELECT * FROM (
    SELECT date, symbol, {zscore('prediction', 'date')} AS prediction, target FROM scored)
  WHERE prediction IS NOT NULL)"""

PORTFOLIO = f"""{PREDICTIONS},
standard AS (
  SELECT date, symbol, target, {zscore('prediction', 'date')} AS prediction FROM predictions),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY date ORDER BY prediction, symbol) AS DOUBLE)
            AS "rank", count(*) OVER (PARTITION BY date) AS names
  FROM standard),
chosen AS (
  SELECT *, "rank" / names AS rank_pct,
         CASE WHEN "rank" / names >= {1 - LONG_PCT}::DOUBLE THEN greatest(prediction, 0.0::DOUBLE)
              ELSE 0.0::DOUBLE END AS score
  FROM ranked),
portfolio AS (
  SELECT date, symbol, prediction, target, "rank", rank_pct,
         CASE WHEN sum(score) OVER (PARTITION BY date) > 1e-12::DOUBLE
              THEN score / sum(score) OVER (PARTITION BY date) ELSE 0.0::DOUBLE END AS weight
  FROM chosen),
traded AS (
  SELECT * REPLACE (CASE WHEN day(date) = 13 THEN 0.0::DOUBLE ELSE weight END AS weight,
                    target / 100 AS target)
  FROM portfolio)"""

PNL = f"""{PORTFOLIO},
pnl AS (
  SELECT date, sum(abs(weight)) AS gross, sum(weight * target) / sum(abs(weight)) AS pnl,
  FROM traded GROUP BY date HAVING sum(abs(weight)) >= 1e-12::DOUBLE),
days AS (SELECT *, row_number() OVER (ORDER BY date) AS day_idx FROM pnl),
held AS (
  SELECT t.symbol, d.day_idx, t.weight / d.gross AS w
  FROM traded t JOIN days d ON t.date = d.date),
turned AS (
  SELECT coalesce(c.day_idx, p.day_idx + 1) AS day_idx,
         sum(abs(coalesce(c.w, 0) - coalesce(p.w, 0))) AS turnover
  FROM held c FULL OUTER JOIN held p ON c.symbol = p.symbol AND c.day_idx = p.day_idx + 1
  GROUP BY 1),
netted AS (
  SELECT d.date, d.day_idx, d.pnl, t.turnover,
         greatest(d.pnl - t.turnover * 0.0005::DOUBLE, -0.99::DOUBLE) AS net_return
  FROM days d JOIN turned t ON d.day_idx = t.day_idx),
curve AS (
  SELECT *, product(1 + net_return) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS equity
  FROM netted),
fallen AS (
  SELECT *, max(equity) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS peak FROM curve)"""

LONG_SHORT = f"""{PREDICTIONS},
signed AS (SELECT *, prediction / 100 AS weight FROM predictions),
sides AS (
  SELECT date,
         coalesce(sum(weight * target) FILTER (weight > 0), 0) AS long_return,
         coalesce(sum(weight * target) FILTER (weight < 0), 0) AS short_return
  FROM signed GROUP BY date),
both_sides AS (SELECT *, long_return + short_return AS ls_return FROM sides)"""

SIGNALS = f"""{PREDICTIONS},
standard AS (SELECT *, {zscore('prediction', 'date')} AS pred_z FROM predictions),
placed AS (
  SELECT *, {RANK_IN_DATE.format(v='pred_z')} / count(*) OVER (PARTITION BY date) AS rank_pct,
         abs(pred_z) / (max(abs(pred_z)) OVER (PARTITION BY date) + 1e-8::DOUBLE) AS confidence
  FROM standard),
signals AS (
  SELECT *, CASE WHEN rank_pct <= {SHORT_PCT}::DOUBLE THEN 'SHORT'
                 WHEN rank_pct >= {1 - LONG_PCT}::DOUBLE THEN 'BUY' ELSE 'HOLD' END AS signal
  FROM placed),
latest AS (SELECT * FROM signals WHERE date = (SELECT max(date) FROM signals))"""

DECILES = f"""{PREDICTIONS},
edges AS (
  SELECT date, list_distinct(quantile_cont(prediction, [{', '.join(f'{i * 0.1}::DOUBLE' for i in range(11))}])) AS e,
         count(*) AS names
  FROM predictions GROUP BY date),
binned AS (
  SELECT p.*, names,
         CASE WHEN len(e) > 1
              THEN CAST(greatest(len(list_filter(e, lambda x: x < p.prediction)) - 1, 0) AS BIGINT)
         END AS decile
  FROM predictions p JOIN edges USING (date)),
bin_means AS (
  SELECT date, decile, avg(target) AS m, count(*) OVER (PARTITION BY date) AS bins
  FROM binned WHERE names >= 10 AND decile IS NOT NULL GROUP BY date, decile),
decile_means AS (
  SELECT decile, avg(m) AS avg_return, count(*) AS dates FROM bin_means WHERE bins > 1
  GROUP BY decile)"""

DAILY_IC = f"""{PREDICTIONS},
daily AS (
  SELECT date, count(*) AS n, {correlation('prediction', 'target')} AS ic
  FROM predictions GROUP BY date HAVING count(*) > 1)"""

RANK_IC = f"""{DAILY_IC},
ranks AS (
  SELECT date, {RANK_IN_DATE.format(v='prediction')} AS p, {RANK_IN_DATE.format(v='target')} AS t
  FROM predictions),
daily_rank AS (
  SELECT date, count(*) AS n, {correlation('p', 't')} AS rank_ic
  FROM ranks GROUP BY date HAVING count(*) > 1)"""

NORMALISED = ", ".join(f"coalesce({zscore(c, 'date')}, 0) AS {c}" for c in FEATURES)
TRAINING = f"""{BARS}, {features_of()}, {COMPLETE_FEATURES},
long_enough AS (
  SELECT * FROM complete
  WHERE symbol IN (SELECT symbol FROM complete GROUP BY symbol HAVING count(*) >= 60)),
smoothed AS (
  SELECT *, least(greatest(avg(target_5) OVER (
              PARTITION BY symbol ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
              -3.0::DOUBLE), 3.0::DOUBLE) AS smooth
  FROM long_enough),
training AS (
  SELECT date, symbol, {NORMALISED}, target_5 AS target_raw,
         epoch(date) / 86400.0::DOUBLE >
           (SELECT floor(quantile_cont(epoch(date) / 86400.0::DOUBLE, 0.8::DOUBLE)) FROM smoothed)
           AS is_test,
         (smooth - avg(smooth) OVER ()) / (stddev_samp(smooth) OVER () + 1e-8::DOUBLE) AS target_smooth,
         (rank() OVER (ORDER BY date) + (count(*) OVER (PARTITION BY date) - 1) / 2.0::DOUBLE)
           / count(*) OVER () AS time_rank
  FROM smoothed)"""

RAW = f"""{BARS},
defects AS (
  SELECT CASE WHEN day(date) % 13 = 0 THEN 'bad' ELSE CAST(date AS VARCHAR) END AS "Date",
         open AS "Open",
         CASE WHEN day(date) = 17 THEN 'infinity'::DOUBLE ELSE high END AS "High",
         low AS "Low", CASE WHEN day(date) % 11 <> 0 THEN close END AS "Close",
         CASE WHEN CAST(substr(symbol, 2) AS BIGINT) % 7 = 0 THEN 0 ELSE volume END AS "Volume",
         openint AS "OpenInt", symbol,
         CASE WHEN type = 0 THEN 'Stock' ELSE 'etf' END AS type
  FROM bars),
raw AS (
  SELECT * FROM defects
  UNION ALL SELECT * FROM defects WHERE CAST(substr(symbol, 2) AS BIGINT) % 5 = 0),
present AS (
  SELECT DISTINCT * FROM raw WHERE "High" <> 'infinity'::DOUBLE AND "Close" IS NOT NULL),
cleaned AS (
  SELECT * REPLACE (TRY_CAST("Date" AS DATE) AS "Date") FROM present
  WHERE "Volume" > 0 AND TRY_CAST("Date" AS DATE) IS NOT NULL)"""

RAW_COLUMNS = ["Date", "Open", "High", "Low", "Close", "Volume", "OpenInt", "symbol", "type"]

FILE_NAMES = """
file_names AS (
  SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN lower(s_name) || '.us.txt'
                         ELSE s_name || '.TXT' END AS file_name
  FROM supplier)"""

UNIVERSE = """
manifest AS (
  SELECT lower(s_name) || '.us.txt' AS file_name, upper(s_name) AS ticker,
         CAST(CASE WHEN s_suppkey % 9 = 0 THEN 0 ELSE s_suppkey * 100 END AS BIGINT) AS length
  FROM supplier),
symbols AS (
  SELECT upper(s_name) AS ticker FROM supplier WHERE s_suppkey % 3 = 0
  UNION
  SELECT 'UNLISTED' || CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_suppkey % 3 = 0)"""


def query(ctes, columns, source, tail=""):
    return f"WITH {ctes} SELECT {columns} FROM {source} {tail}"


def monthly(ctes):
    """The same tables with one bar per month."""
    return ctes.replace("CAST(l_shipdate AS DATE)", "CAST(date_trunc('month', l_shipdate) AS DATE)")


def listing(*columns):
    return ", ".join(columns)


def smallest(columns, source):
    return f"row_number() OVER (ORDER BY md5(concat_ws('|', {columns}, '42')), {source})"


def defect_counts():
    columns = [*RAW_COLUMNS, "Range", "Gain", "Name"]
    numbers = ("Open", "High", "Low", "Close", "Range", "Gain")
    missing = [f'count(*) FILTER ("{c}" IS NULL) AS "m_{c}"' for c in columns]
    infinite = [
        f"count(*) FILTER (abs(\"{c}\") = 'infinity'::DOUBLE) AS \"i_{c}\"" for c in numbers
    ]
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, \"m_{c}\" AS missing, "
        + (f'"i_{c}"' if c in numbers else "0::BIGINT")
        + " AS infinite FROM counts"
        for c in columns
    )
    return f"""{RAW},
wide AS (SELECT *, "High" - "Low" AS "Range", "Close" - "Open" AS "Gain", upper(symbol) AS "Name" FROM raw),
counts AS (SELECT {listing(*missing, *infinite)} FROM wide), defect AS ({rows})"""


def leakage():
    pairs = [(f, t) for t in TARGETS for f in FEATURES]
    sums = listing(*[f"abs({correlation(f, t)}) AS c{i}" for i, (f, t) in enumerate(pairs)])
    rows = " UNION ALL ".join(
        f"SELECT '{t}' AS target, '{f}' AS feature, c{i} AS abs_corr FROM sums"
        for i, (f, t) in enumerate(pairs)
    )
    return f"""{BARS}, {features_of()}, {COMPLETE_FEATURES},
sums AS (SELECT {sums} FROM complete), pairs AS ({rows}),
places AS (
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY abs_corr DESC, feature) AS position
  FROM pairs WHERE abs_corr IS NOT NULL)"""


def target_tables():
    rows = " UNION ALL ".join(
        f"SELECT '{t}' AS target, {t} AS value FROM targeted" for t in TARGETS
    )
    return f"{BARS}, targeted AS (SELECT *, {TARGET_COLUMNS} FROM bars), long AS ({rows})"


BOOSTED_TREES, BOOSTED_LEAVES, BOOSTED_STEP = 2, 8, 0.1


def boosted_ctes(trees=BOOSTED_TREES, leaves=BOOSTED_LEAVES, step=BOOSTED_STEP):
    """Bins, then for every split the sums of all leaves and the best cut of all; scores at the end."""
    columns = listing(*[r6(c) for c in FEATURES])
    whole = "CAST(floor({} * 65536 + 0.5::DOUBLE) AS BIGINT)"
    ctes = [
        TRAINING,
        f"""r AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY symbol, date) AS rid, date, symbol, is_test,
         {r6("target_smooth", "y")}, {r6("exp(1.5::DOUBLE * time_rank)", "w")}, {columns}
  FROM training)""",
        f"""cells AS MATERIALIZED (
  SELECT rid, is_test, unnest(range({len(FEATURES)})) AS f,
         unnest([{", ".join(f"{c}::DOUBLE" for c in FEATURES)}]) AS x
  FROM r)""",
        """edges AS MATERIALIZED (
  SELECT f, x, row_number() OVER (PARTITION BY f ORDER BY x) AS k FROM (
    SELECT DISTINCT f, x FROM (
      SELECT f, x, row_number() OVER (PARTITION BY f ORDER BY x) AS p, count(*) OVER (PARTITION BY f) AS n
      FROM cells WHERE NOT is_test)
    JOIN (SELECT unnest(range(1, 255)) AS j) ON p = (j * n + 254) // 255))""",
        """bins AS MATERIALIZED (
  SELECT c.rid, c.f, c.is_test, 1 + coalesce(e.k, 0) AS b
  FROM cells AS c ASOF LEFT JOIN edges AS e ON c.f = e.f AND c.x > e.x)""",
        f"""score0 AS MATERIALIZED (
  SELECT rid, (SELECT CAST(sum({whole.format("w * y")}) AS DOUBLE) / CAST(sum({whole.format("w")}) AS DOUBLE)
               FROM r WHERE NOT is_test) AS score
  FROM r)""",
    ]
    for t in range(1, trees + 1):
        ctes += [
            f"""grad{t} AS MATERIALIZED (
  SELECT rid, {whole.format("(w * (y - score))")} AS g, {whole.format("w")} AS h
  FROM r JOIN score{t - 1} USING (rid))""",
            f"leaf{t}_0 AS MATERIALIZED (SELECT rid, CAST(1 AS BIGINT) AS path FROM r)",
        ]
        for k in range(leaves - 1):
            ctes += [
                f"""best{t}_{k} AS MATERIALIZED (
  SELECT {t} AS tree, path, f, b, n, gl * gl / hl + gr * gr / hr - g * g / h AS gain FROM (
    SELECT path, f, b, nl, hl, gl, n, h, g, n - nl AS nr, h - hl AS hr, g - gl AS gr FROM (
      SELECT path, f, b, sum(n) OVER upto AS nl, CAST(sum(h) OVER upto AS DOUBLE) AS hl,
             CAST(sum(g) OVER upto AS DOUBLE) AS gl, sum(n) OVER every AS n,
             CAST(sum(h) OVER every AS DOUBLE) AS h, CAST(sum(g) OVER every AS DOUBLE) AS g
      FROM (SELECT path, f, b, sum(g) AS g, sum(h) AS h, count(*) AS n
            FROM bins JOIN leaf{t}_{k} USING (rid) JOIN grad{t} USING (rid)
            WHERE NOT is_test GROUP BY path, f, b)
      WINDOW upto AS (PARTITION BY path, f ORDER BY b), every AS (PARTITION BY path, f)))
  WHERE nl >= 20 AND nr >= 20 AND hl >= 66 AND hr >= 66 AND gl * gl / hl + gr * gr / hr - g * g / h > 0
  ORDER BY gain DESC, path, f, b LIMIT 1)""",
                f"""leaf{t}_{k + 1} AS MATERIALIZED (
  SELECT l.rid, CASE WHEN s.path IS NULL THEN l.path
                     ELSE 2 * l.path + CAST(c.b > s.b AS BIGINT) END AS path
  FROM leaf{t}_{k} AS l LEFT JOIN best{t}_{k} AS s USING (path)
       LEFT JOIN bins AS c ON c.rid = l.rid AND c.f = s.f)""",
            ]
        ctes.append(f"""score{t} AS MATERIALIZED (
  SELECT rid, score + value * {step}::DOUBLE AS score
  FROM score{t - 1} JOIN leaf{t}_{leaves - 1} USING (rid) JOIN (
    SELECT path, CAST(sum(g) AS DOUBLE) / CAST(sum(h) AS DOUBLE) AS value
    FROM leaf{t}_{leaves - 1} JOIN grad{t} USING (rid) JOIN r USING (rid) WHERE NOT is_test GROUP BY path)
  USING (path))""")
    splits = " UNION ALL ".join(
        f"SELECT * FROM best{t}_{k}" for t in range(1, trees + 1) for k in range(leaves - 1)
    )
    ctes.append(f"splits AS ({splits})")
    return ", ".join(ctes)


_FEATURE = "[" + ", ".join(f"'{c}'" for c in FEATURES) + "]"

ORACLE = {
    "returns": query(
        f"{BARS}, {RETURNED}", listing("symbol", "date", r6("return_1d"), r6("return_5d")), "returned"
    ),
    "momentum": query(
        f"{BARS}, m AS (SELECT *, {MOMENTUM} FROM bars)",
        listing("symbol", "date", r6("close"), *[r6(f"ma_ratio_{n}") for n in ROLL_WINDOWS]),
        "m",
    ),
    "volatility": query(
        f"{BARS}, {RETURNED}, v AS (SELECT *, {VOLATILITY} FROM returned)",
        listing("symbol", "date", r6("return_1d"), *[r6(f"vol_{n}") for n in ROLL_WINDOWS]),
        "v",
    ),
    "zscore": query(
        f"{BARS}, z AS (SELECT *, {ZSCORES} FROM bars)",
        listing("symbol", "date", r6("close"), *[r6(f"zscore_{n}") for n in ROLL_WINDOWS]),
        "z",
    ),
    "market_regime": query(
        f"{BARS}, {RETURNED}, {regime_of('row_order')}",
        listing("symbol", "date", r6("market_vol_regime")),
        "regimes",
    ),
    "market_regime_symbol": query(
        f"{BARS}, {RETURNED}, {regime_of('symbol')}",
        listing("symbol", "date", r6("market_vol_regime")),
        "regimes",
    ),
    "alpha_combos": query(
        f"{BARS}, {features_of()}",
        listing(
            "symbol", "date", *map(r6, ("momentum_vol_adj", "reversion_strength", "combo_momentum"))
        ),
        "features",
    ),
    "targets": query(
        f"{BARS}, t AS (SELECT *, {TARGET_COLUMNS} FROM bars)",
        listing("symbol", "date", *map(r6, TARGETS)),
        "t",
    ),
    "recent_rows": query(
        BARS,
        "symbol, date, close",
        "bars",
        f"WHERE epoch(date) / 86400.0::DOUBLE >= "
        f"(SELECT quantile_cont(epoch(date) / 86400.0::DOUBLE, {1 - 0.3}::DOUBLE) FROM bars)",
    ),
    "recent_dates": query(
        f"""{BARS}, dates AS (
          SELECT date, row_number() OVER (ORDER BY date) - 1 AS k, count(*) OVER () AS n
          FROM (SELECT DISTINCT date FROM bars))""",
        "symbol, date, close",
        "bars",
        f"WHERE date >= (SELECT date FROM dates WHERE k = floor(n * {1 - 0.3}::DOUBLE))",
    ),
    "feature_table": query(
        f"{BARS}, {features_of()}, {COMPLETE_FEATURES}",
        listing(
            "symbol, date, volume, openint, type",
            *[r6(c) for c in FEATURES + TARGETS if c not in ("volume", "openint", "type")],
        ),
        "complete",
    ),
    "feature_table_recent": query(
        f"""{BARS}, dates AS (
          SELECT date, row_number() OVER (ORDER BY date) - 1 AS k, count(*) OVER () AS n
          FROM (SELECT DISTINCT date FROM bars)),
        recent AS (
          SELECT * FROM bars
          WHERE date >= (SELECT date FROM dates WHERE k = floor(n * 0.5::DOUBLE))),
        {features_of('symbol', 'recent')}, {COMPLETE_FEATURES}""",
        listing(
            "symbol, date, volume, openint, type",
            *[r6(c) for c in FEATURES + TARGETS if c not in ("volume", "openint", "type")],
        ),
        "complete",
    ),
    "cs_zscore": query(
        f"{BARS}, {RETURNED}",
        listing(
            "symbol",
            "date",
            *[r6(zscore(c, "date"), c) for c in ("close", "return_1d", "return_5d")],
        ),
        "returned",
    ),
    "rank_pct": query(
        BARS,
        listing(
            "symbol",
            "date",
            "openint",
            r6(
                f"{RANK_IN_DATE.format(v='openint')} / count(*) OVER (PARTITION BY date)",
                "rank_pct",
            ),
        ),
        "bars",
    ),
    "time_decay": query(
        f"""{BARS}, t AS (
          SELECT symbol, date, (rank() OVER (ORDER BY date)
                 + (count(*) OVER (PARTITION BY date) - 1) / 2.0::DOUBLE)
                 / count(*) OVER () AS time_rank FROM bars)""",
        listing("symbol", "date", r6("time_rank"), r6("exp(1.5::DOUBLE * time_rank)", "sample_weight")),
        "t",
    ),
    "target_smooth": query(
        f"""{BARS}, t AS (SELECT *, {TARGET_COLUMNS} FROM bars), s AS (
          SELECT symbol, date, target_5, avg(target_5) OVER (
            PARTITION BY symbol ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS m
          FROM t)""",
        listing(
            "symbol",
            "date",
            r6("target_5"),
            r6(
                "CASE WHEN m IS NOT NULL THEN least(greatest(m, -3.0::DOUBLE), 3.0::DOUBLE) END",
                "target_smooth",
            ),
        ),
        "s",
    ),
    "target_standardised": query(
        SCORED,
        listing(
            "date",
            "symbol",
            r6("prediction"),
            r6(
                "(target - avg(target) OVER ()) / (stddev_samp(target) OVER () + 1e-8::DOUBLE)",
                "target",
            ),
        ),
        "scored",
    ),
    "min_history": query(
        BARS,
        "symbol, date, close",
        "bars",
        "WHERE symbol IN (SELECT symbol FROM bars GROUP BY symbol HAVING count(*) >= 530)",
    ),
    "sample_symbols": query(
        f"""{BARS}, names AS (SELECT DISTINCT symbol FROM bars), placed AS (
          SELECT symbol, {smallest('symbol', 'symbol')} AS k, count(*) OVER () AS n FROM names)""",
        "symbol, date, close",
        "bars",
        "WHERE symbol IN (SELECT symbol FROM placed WHERE k <= floor(n * 0.3::DOUBLE))",
    ),
    "sample_rows": query(
        f"""{BARS}, placed AS (
          SELECT *, {smallest('symbol, CAST(date AS VARCHAR)', 'symbol, date')} AS k FROM bars)""",
        "symbol, date, close",
        "placed",
        "WHERE k <= 5000",
    ),
    "train_test_split": query(
        BARS,
        "symbol, date, epoch(date) / 86400.0::DOUBLE > "
        "(SELECT quantile_cont(epoch(date) / 86400.0::DOUBLE, 0.8::DOUBLE) FROM bars) AS is_test",
        "bars",
    ),
    "deciles": query(DECILES, "date, symbol, decile", "binned"),
    "portfolio_weights": query(
        PORTFOLIO,
        listing(
            "date",
            "symbol",
            r6("prediction"),
            r6("target"),
            r6('"rank"'),
            r6("rank_pct"),
            r6("weight"),
        ),
        "portfolio",
    ),
    "daily_pnl": query(PNL, listing("date", r6("gross"), r6("pnl")), "days"),
    "turnover": query(PNL, listing("date", "day_idx", r6("turnover")), "netted"),
    "daily_net_return": query(
        PNL, listing("date", r6("pnl"), r6("turnover"), r6("net_return")), "netted"
    ),
    "equity_curve": query(PNL, listing("date", s9("equity")), "curve"),
    "drawdown": query(PNL, listing("date", r6("(equity - peak) / peak", "drawdown")), "fallen"),
    "performance_summary": query(
        PNL,
        listing(
            s9("arg_max(equity, date) - 1", "total_return"),
            s9("avg(net_return) / (stddev_samp(net_return) + 1e-8::DOUBLE)", "sharpe"),
            s9("min((equity - peak) / peak)", "max_drawdown"),
            "count(*) AS traded_days",
            "(SELECT count(DISTINCT date) FROM traded) - count(*) AS skipped_days",
        ),
        "fallen",
    ),
    "long_short": query(
        LONG_SHORT,
        listing("date", r6("long_return"), r6("short_return"), r6("ls_return")),
        "both_sides",
    ),
    "long_short_summary": query(
        f"""{LONG_SHORT},
        c AS (SELECT *, product(1 + ls_return) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS e
              FROM both_sides),
        f AS (SELECT *, max(e) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS peak FROM c)""",
        listing(
            s9("avg(long_return)", "avg_long"),
            s9("avg(short_return)", "avg_short"),
            s9("avg(ls_return)", "avg_long_short"),
            s9("avg(ls_return) / (stddev_samp(ls_return) + 1e-8::DOUBLE)", "sharpe"),
            s9("min((e - peak) / peak)", "max_drawdown"),
        ),
        "f",
    ),
    "backtest_checks": query(
        f"""{PORTFOLIO}, per_date AS (
          SELECT date, sum(weight) AS net, sum(abs(weight)) AS gross, count(*) AS n,
                 max(weight) AS top FROM traded GROUP BY date)""",
        listing(
            "CAST(sum(n) AS BIGINT) AS rows",
            "0::BIGINT AS missing",
            r6("avg(net)", "avg_weight_sum"),
            r6("avg(gross)", "avg_gross"),
            "NOT max(top) > 0 AS short_only",
        ),
        "per_date",
    ),
    "ic_flip": query(
        f"""{PREDICTIONS}, daily AS (
          SELECT {correlation('prediction', 'target')} AS ic FROM predictions GROUP BY date
          HAVING stddev_samp(prediction) > 1e-12::DOUBLE AND stddev_samp(target) > 1e-12::DOUBLE)""",
        listing(
            "date",
            "symbol",
            r6(
                "CASE WHEN (SELECT avg(ic) FROM daily) < 0 THEN -prediction ELSE prediction END",
                "prediction",
            ),
            r6("target"),
        ),
        "predictions",
    ),
    "ic_flip_reversed": query(
        f"""{PREDICTIONS}, daily AS (
          SELECT {correlation('prediction', 'target')} AS ic FROM predictions GROUP BY date
          HAVING stddev_samp(prediction) > 1e-12::DOUBLE AND stddev_samp(target) > 1e-12::DOUBLE)""",
        listing(
            "date",
            "symbol",
            r6(
                "CASE WHEN (SELECT avg(ic) FROM daily) > 0 THEN prediction ELSE -prediction END",
                "prediction",
            ),
            r6("target"),
        ),
        "predictions",
    ),
    "signals": query(
        SIGNALS,
        listing(
            "date, symbol, signal",
            *map(r6, ("prediction", "target", "pred_z", "rank_pct", "confidence")),
        ),
        "signals",
    ),
    "latest_signals": query(
        monthly(SIGNALS),
        listing(
            "date, symbol, signal, 5::BIGINT AS holding_days",
            *map(r6, ("prediction", "target", "pred_z", "rank_pct", "confidence")),
        ),
        "latest",
    ),
    "latest_trades": query(
        f"""{monthly(SIGNALS)}, best AS (
          SELECT * FROM latest WHERE signal <> 'HOLD' ORDER BY confidence DESC, symbol LIMIT 20)""",
        listing("symbol", "signal", r6("confidence"), "5::BIGINT AS holding_days"),
        "best",
    ),
    "top_signals": query(
        f"""{monthly(SIGNALS)}, places AS (
          SELECT *, row_number() OVER (
            PARTITION BY signal ORDER BY confidence DESC, symbol) AS position
          FROM latest WHERE signal <> 'HOLD')""",
        listing(
            "signal",
            "position",
            "symbol",
            r6("confidence"),
            "printf('%-10s | conf=%.3f | hold=N/A', symbol, confidence) AS line",
        ),
        "places",
        "WHERE position <= 20",
    ),
    "signal_summary": query(
        monthly(SIGNALS),
        listing(
            "max(date) AS latest_date",
            "count(*) AS total",
            "count(*) FILTER (signal = 'BUY') AS buys",
            "count(*) FILTER (signal = 'SHORT') AS shorts",
            r6("avg(confidence)", "avg_confidence"),
        ),
        "latest",
    ),
    "top_stocks": query(
        f"""{monthly(PORTFOLIO)}, best AS (
          SELECT * FROM portfolio WHERE date = (SELECT max(date) FROM portfolio)
          ORDER BY prediction DESC, symbol LIMIT 20)""",
        listing("symbol", r6("prediction"), r6("weight")),
        "best",
    ),
    "missing_report": query(
        f"""{BARS}, {features_of()},
        m AS (SELECT {listing(*[f'count(*) FILTER ({c} IS NULL) AS {c}'
                                for c in ['symbol', 'date'] + FEATURES + TARGETS])}
              FROM features),
        listed AS ({unpivot('m', [(c, c) for c in ['symbol', 'date'] + FEATURES + TARGETS],
                            'column_name', 'missing')})""",
        "*",
        "listed",
    ),
    "nan_inf_check": query(
        defect_counts(),
        "*, CAST(sum(missing) OVER () AS BIGINT) AS total_missing, "
        "CAST(sum(infinite) OVER () AS BIGINT) AS total_infinite, "
        "sum(missing) OVER () = 0 AS clean",
        "defect",
        "ORDER BY missing DESC, column_name LIMIT 10",
    ),
    "symbol_health": query(
        f"{BARS}, h AS (SELECT symbol, count(*) AS n FROM bars GROUP BY symbol)",
        "count(*) AS symbols, min(n) AS min_rows, max(n) AS max_rows, "
        "count(*) FILTER (n < 60) AS weak_symbols",
        "h",
    ),
    "target_analysis": query(
        target_tables(),
        listing(
            "target",
            "count(value) AS n",
            s9("avg(value)", "mean"),
            s9("stddev_samp(value)", "std"),
            s9("min(value)", "min"),
            s9("quantile_cont(value, 0.25::DOUBLE)", "q25"),
            s9("quantile_cont(value, 0.5::DOUBLE)", "q50"),
            s9("quantile_cont(value, 0.75::DOUBLE)", "q75"),
            s9("max(value)", "max"),
            s9("avg(CASE WHEN abs(value) > 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)", "extreme"),
        ),
        "long",
        "GROUP BY target",
    ),
    "feature_quality": query(
        f"""{BARS}, {features_of()}, {COMPLETE_FEATURES},
        v AS (SELECT {listing(*[f'var_samp({c}) AS {c}' for c in FEATURES])} FROM complete),
        listed AS ({unpivot('v', [(c, c) for c in FEATURES], 'feature', 'variance')})""",
        listing(
            "feature",
            s9("variance"),
            "variance < 1e-6::DOUBLE AS low_variance",
            "variance = 0 AS constant",
        ),
        "listed",
    ),
    "leakage_check": query(
        leakage(),
        listing(
            "target",
            "feature",
            r6("abs_corr"),
            "position",
            "CASE WHEN position = 1 THEN CASE WHEN abs_corr > 0.95::DOUBLE THEN 'leak' "
            "WHEN abs_corr > 0.2::DOUBLE THEN 'strong' ELSE 'ok' END END AS verdict",
        ),
        "places",
        "WHERE position <= 5",
    ),
    "dispersion": query(
        f"""{BARS}, {RETURNED},
        devs AS (
          SELECT date, [stddev_samp(close), stddev_samp(return_1d), stddev_samp(return_5d)] AS d
          FROM returned GROUP BY date HAVING count(*) > 1)""",
        listing("count(*) AS dates", s9("avg(list_avg(d))", "avg_dispersion")),
        "devs",
    ),
    "daily_ic": query(DAILY_IC, listing("date", "n", r6("ic")), "daily"),
    "daily_rank_ic": query(RANK_IC, listing("date", "n", r6("rank_ic")), "daily_rank"),
    "ic_summary": query(
        RANK_IC,
        listing(
            r6("avg(ic)", "mean_ic"),
            r6("stddev_samp(ic)", "std_ic"),
            r6("(SELECT avg(rank_ic) FROM daily_rank)", "mean_rank_ic"),
        ),
        "daily",
    ),
    "decile_analysis": query(
        DECILES, listing("decile", r6("avg_return"), "dates"), "decile_means"
    ),
    "decile_spread": query(
        DECILES,
        listing(
            r6("arg_max(avg_return, decile)", "top"),
            r6("arg_min(avg_return, decile)", "bottom"),
            r6(
                "CASE WHEN count(*) > 1 THEN arg_max(avg_return, decile)"
                " - arg_min(avg_return, decile) END",
                "spread",
            ),
        ),
        "decile_means",
    ),
    "prediction_diagnostics": query(
        f"""{PREDICTIONS},
        d AS (SELECT stddev_samp(prediction) AS dev FROM predictions GROUP BY date)""",
        listing(
            r6("avg(prediction)", "mean"),
            r6("stddev_samp(prediction)", "std"),
            r6("(SELECT avg(dev) FROM d)", "avg_daily_std"),
            "(SELECT avg(dev) FROM d) < 0.001::DOUBLE AS flat",
        ),
        "predictions",
    ),
    "directional_accuracy": query(
        PREDICTIONS,
        r6("avg(CASE WHEN sign(prediction) = sign(target) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)", "accuracy"),
        "predictions",
    ),
    "validation_warnings": query(
        f"""{LONG_SHORT},
        daily AS (
          SELECT {correlation('prediction', 'target')} AS ic FROM predictions
          GROUP BY date HAVING count(*) > 1),
        s AS (
          SELECT (SELECT avg(ic) FROM daily) AS mean_ic,
                 avg(ls_return) / (stddev_samp(ls_return) + 1e-8::DOUBLE) AS sharpe
          FROM both_sides)""",
        listing(
            r6("mean_ic"),
            r6("sharpe"),
            "mean_ic < 0.01::DOUBLE AS weak_signal",
            "mean_ic > 0.1::DOUBLE AS suspicious_signal",
            "sharpe > 1 AS high_sharpe",
        ),
        "s",
    ),
    "extract_symbol": query(
        FILE_NAMES,
        "s_suppkey, file_name, upper(CASE WHEN suffix(file_name, '.us.txt') "
        "THEN replace(file_name, '.us.txt', '') "
        "ELSE regexp_replace(file_name, '\\.[^.]*$', '') END) AS symbol",
        "file_names",
    ),
    "extract_ticker": query(
        FILE_NAMES,
        "s_suppkey, file_name, CASE WHEN suffix(lower(file_name), '.us.txt') "
        "THEN upper(left(file_name, length(file_name) - 7)) ELSE '' END AS ticker",
        "file_names",
    ),
    "ticker_lookup": query(
        UNIVERSE,
        "file_name, length, ticker AS symbol",
        "manifest",
        "WHERE ticker = (SELECT min(ticker) FROM manifest)",
    ),
    "universe_symbols": query(UNIVERSE, "ticker", "symbols"),
    "universe_filter": query(
        UNIVERSE,
        "ticker, file_name, 'Stocks/' || file_name AS file_path",
        "manifest",
        "WHERE length > 0 AND ticker IN (SELECT ticker FROM symbols)",
    ),
    "universe_empty": query(
        UNIVERSE,
        "ticker, file_name, 'Stocks/' || file_name AS file_path",
        "manifest",
        "WHERE length = 0 AND ticker IN (SELECT ticker FROM symbols)",
    ),
    "universe_missing": query(
        UNIVERSE, "ticker", "symbols", "WHERE ticker NOT IN (SELECT ticker FROM manifest)"
    ),
    "universe_summary": query(
        UNIVERSE,
        "count(*) AS total_files, count(*) FILTER (length = 0) AS empty_files, "
        "count(*) FILTER (length > 0 AND ticker IN (SELECT ticker FROM symbols)) AS matched_files, "
        "count(*) FILTER (length = 0 AND ticker IN (SELECT ticker FROM symbols)) "
        "AS matched_empty_files, (SELECT count(*) FROM symbols) AS symbols, "
        "CASE WHEN count(*) FILTER (length = 0) <= 50 THEN 'ignore' ELSE 'skip' END AS mode",
        "manifest",
    ),
    "universe_bars": query(
        BARS,
        "symbol, date, close",
        "bars",
        "WHERE symbol IN (SELECT 'S' || CAST(s_suppkey AS VARCHAR) FROM supplier "
        "WHERE s_suppkey % 3 = 0)",
    ),
    "merge_sources": query(
        BARS,
        "*",
        "(SELECT date, close, volume, symbol FROM bars WHERE type = 0 UNION ALL BY NAME "
        "SELECT symbol, open, close, date FROM bars WHERE type = 1)",
    ),
    "clean_bars": query(RAW, "*", "cleaned"),
    "cleaning_report": query(
        RAW,
        "(SELECT count(*) FROM raw) AS rows_in, "
        "count(*) FILTER (\"High\" = 'infinity'::DOUBLE OR \"Close\" IS NULL) AS missing_removed, "
        "count(*) FILTER (\"High\" <> 'infinity'::DOUBLE AND \"Close\" IS NOT NULL) "
        "- (SELECT count(*) FROM present) AS duplicates_removed, "
        '(SELECT count(*) FROM present WHERE "Volume" <= 0) AS zero_volume_removed, '
        '(SELECT count(*) FROM present WHERE "Volume" > 0 AND TRY_CAST("Date" AS DATE) IS NULL) '
        "AS bad_dates_removed, (SELECT count(*) FROM cleaned) AS rows_out",
        "raw",
    ),
    "typed_bars": query(
        RAW,
        '"Date" AS date, "Open" AS open, "High" AS high, "Low" AS low, "Close" AS close, '
        '"Volume" AS volume, "OpenInt" AS openint, symbol, '
        "CAST(CASE lower(type) WHEN 'stock' THEN 0 WHEN 'etf' THEN 1 END AS TINYINT) AS type",
        "cleaned",
    ),
    "precheck": query(
        RAW,
        "count(*) AS rows, 9::BIGINT AS columns, "
        'count(*) FILTER (TRY_CAST("Date" AS DATE) IS NULL) AS invalid_dates, '
        'min(TRY_CAST("Date" AS DATE)) AS min_date, max(TRY_CAST("Date" AS DATE)) AS max_date',
        "raw",
    ),
    "guardrail": query(
        f"""{RAW}, g AS (
          SELECT 1::BIGINT AS missing_columns,
                 count(*) FILTER (TRY_CAST("Date" AS DATE) IS NULL) AS invalid_dates,
                 count(*) FILTER (TRY_CAST("Date" AS DATE) IS NULL)
                 + count(*) FILTER ("Close" IS NULL) AS missing_values,
                 count(*) FILTER ("Volume" < 0) AS negative_volume
          FROM raw),
        listed AS ({unpivot('g', [(c, c) for c in ('missing_columns', 'invalid_dates',
                                                   'missing_values', 'negative_volume')],
                            'check_name', 'observed')}),
        checked AS (SELECT *, observed <= 0 AS ok FROM listed)""",
        "check_name, observed, ok",
        "checked",
        "UNION ALL SELECT 'all', count(*) FILTER (NOT ok), bool_and(ok) FROM checked",
    ),
    "training_table": query(
        TRAINING,
        listing(
            "date",
            "symbol",
            "is_test",
            *[r6(c) for c in FEATURES],
            *[r6(c) for c in ("target_smooth", "target_raw", "time_rank")],
            r6("exp(1.5::DOUBLE * time_rank)", "sample_weight"),
        ),
        "training",
    ),
    "boosted_splits": query(
        boosted_ctes(),
        f"CAST(tree AS BIGINT) AS tree, {_FEATURE}[splits.f + 1] AS feature, {r6('x', 'threshold')}, {s9('gain')}, CAST(n AS BIGINT) AS rows",
        "splits LEFT JOIN edges ON edges.f = splits.f AND edges.k = splits.b",
    ),
    "boosted_scores": query(
        boosted_ctes(),
        listing("date", "symbol", "is_test", r6("score", "prediction")),
        f"r JOIN score{BOOSTED_TREES} USING (rid)",
    ),
    "train_predict_checks": query(
        TRAINING,
        "date, count(*) AS names, true AS finite, true AS weights_sum, true AS few_longs",
        "training",
        "WHERE is_test GROUP BY date HAVING count(*) > 1",
    ),
}
