"""The same queries written independently in SQL, for checking against DuckDB."""

from __future__ import annotations

from statistics import NormalDist

K = "CAST(json_extract(props, '$.k') AS DOUBLE)"

PANEL_DAILY = """
SELECT CAST(l_suppkey AS VARCHAR) AS stock_symbol, l_shipdate AS Date,
  20000 + min(l_extendedprice / l_quantity) AS Open, 20000 + max(l_extendedprice / l_quantity) AS High,
  20000 + min(l_extendedprice / l_quantity) AS Low, 20000 + avg(l_extendedprice / l_quantity) AS Close,
  20000 + avg(l_extendedprice / l_quantity) AS Adj_Close, sum(l_quantity) AS Volume,
  CAST(CASE WHEN count(*) > 1 THEN 1 ELSE 0 END AS INT) AS News_flag,
  50 * avg(l_discount) AS Sentiment_gpt, 10 * avg(l_discount) AS Scaled_sentiment
FROM lineitem GROUP BY l_suppkey, l_shipdate"""

PANEL_HOURLY = f"""
SELECT event_type AS stock_symbol, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS Date,
  100 + min_by(value, ts) AS Open, 100 + max(value) AS High, 100 + min(value) AS Low,
  100 + max_by(value, ts) AS Close, 100 + max_by(value, ts) AS Adj_Close, CAST(count(*) AS DOUBLE) AS Volume,
  CAST(CASE WHEN count(*) > 1 THEN 1 ELSE 0 END AS INT) AS News_flag,
  avg({K}) / 19 AS Sentiment_gpt, avg({K}) / 97 AS Scaled_sentiment
FROM events GROUP BY event_type, date_trunc('hour', ts)"""

PANEL_EDGE = f"""
SELECT CAST(user_id AS VARCHAR) AS stock_symbol, ts AS Date, value AS Open, value * 1.01::DOUBLE AS High,
  value * 0.99::DOUBLE AS Low, value AS Close, value AS Adj_Close, {K} AS Volume, CAST(1 AS INT) AS News_flag,
  {K} / 19 AS Sentiment_gpt, {K} / 97 AS Scaled_sentiment
FROM events"""

TYPED = f"""
SELECT CAST(user_id AS VARCHAR) AS stock_symbol, event_id,
  CASE WHEN value > 100 THEN NULL ELSE ts END AS Date,
  CAST(NULL AS DOUBLE) AS Open, value * 2 AS High, value AS Low, value AS Close,
  CASE WHEN event_type <> 'view' THEN value END AS Adj_Close, {K} AS Volume,
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id AS INT) END AS News_flag, {K} AS Scaled_sentiment
FROM events"""

PANELS = {"panel_daily": PANEL_DAILY, "panel_hourly": PANEL_HOURLY, "panel_edge": PANEL_EDGE}
BAR_COLUMNS = ["Open", "High", "Low", "Close", "Adj_Close", "Volume", "Sentiment_gpt", "Scaled_sentiment"]

ROW_RULES = """Date IS NOT NULL AND Close IS NOT NULL AND Volume IS NOT NULL AND Scaled_sentiment IS NOT NULL
  AND NOT isnan(Close) AND NOT isnan(Volume) AND NOT isnan(Scaled_sentiment)"""
BY_SYMBOL = "(PARTITION BY stock_symbol ORDER BY Date)"


def _panel(name: str) -> str:
    return f"WITH RECURSIVE panel AS ({PANELS[name]})"


def _jumps(rows: str) -> str:
    return f"""SELECT *, abs((Close - lag(Close) OVER w) / nullif(lag(Close) OVER w, 0)) AS jump
  FROM {rows} WINDOW w AS {BY_SYMBOL}"""


def _valid(name: str) -> str:
    return f"""{_panel(name)},
kept AS (SELECT * FROM panel WHERE {ROW_RULES} AND Close > 0 AND Volume >= 0),
bars AS (SELECT * EXCLUDE (jump) FROM ({_jumps("kept")}) WHERE jump IS NULL OR jump <= 0.5)"""


def _features(name: str) -> str:
    return f"""{_valid(name)},
s1 AS (SELECT *,
    lag(Close, 1) OVER w AS close_lag_1, lag(Close, 2) OVER w AS close_lag_2,
    lag(Close, 3) OVER w AS close_lag_3, lag(Close, 5) OVER w AS close_lag_5,
    lag(Volume, 1) OVER w AS volume_lag_1,
    lag(Scaled_sentiment, 1) OVER w AS sentiment_lag_1, lag(Scaled_sentiment, 3) OVER w AS sentiment_lag_3,
    avg(Close) OVER w5 AS ma_5, avg(Close) OVER w10 AS ma_10, avg(Close) OVER w20 AS ma_20,
    avg(Volume) OVER w5 AS volume_ma_5, avg(Volume) OVER w20 AS volume_ma_20,
    avg(Scaled_sentiment) OVER w5 AS sentiment_ma_5, avg(Scaled_sentiment) OVER w10 AS sentiment_ma_10,
    avg(Scaled_sentiment) OVER w20 AS sentiment_ma_20,
    stddev_samp(Scaled_sentiment) OVER w5 AS sentiment_volatility_5d,
    max(High) OVER w5 AS high_5d, min(Low) OVER w5 AS low_5d, lead(Close, 1) OVER w AS next_close
  FROM bars WINDOW w AS {BY_SYMBOL},
    w5 AS (PARTITION BY stock_symbol ORDER BY Date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
    w10 AS (PARTITION BY stock_symbol ORDER BY Date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW),
    w20 AS (PARTITION BY stock_symbol ORDER BY Date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
s2 AS (SELECT *,
    (Close - close_lag_1) / nullif(close_lag_1, 0) AS price_change_1d,
    (Close - close_lag_3) / nullif(close_lag_3, 0) AS price_change_3d,
    (Close - close_lag_5) / nullif(close_lag_5, 0) AS price_change_5d,
    Close / nullif(ma_5, 0) - 1 AS close_vs_ma5, Close / nullif(ma_10, 0) - 1 AS close_vs_ma10,
    Close / nullif(ma_20, 0) - 1 AS close_vs_ma20, (High - Low) / nullif(Close, 0) AS high_low_spread,
    Close / nullif(close_lag_1, 0) - 1 AS close_normalized_vs_lag1,
    Close / nullif(close_lag_5, 0) - 1 AS close_normalized_vs_lag5,
    (Volume - volume_lag_1) / nullif(volume_lag_1, 0) AS volume_change_1d,
    Volume / nullif(volume_ma_5, 0) - 1 AS volume_vs_ma5, Volume / nullif(volume_ma_20, 0) - 1 AS volume_vs_ma20,
    Volume / nullif(volume_lag_1, 0) - 1 AS volume_normalized_vs_lag1,
    Scaled_sentiment - sentiment_lag_1 AS sentiment_change_1d,
    Scaled_sentiment - sentiment_lag_3 AS sentiment_change_3d,
    (Close - low_5d) / (high_5d - low_5d + 0.001::DOUBLE) AS price_position_5d,
    next_close / nullif(Close, 0) - 1 AS target
  FROM s1),
s3 AS (SELECT *, CASE WHEN price_change_1d > 0 THEN price_change_1d ELSE 0 END AS price_gain,
    CASE WHEN price_change_1d < 0 THEN abs(price_change_1d) ELSE 0 END AS price_loss FROM s2),
s4 AS (SELECT *, avg(price_gain) OVER w14 AS avg_gain_14, avg(price_loss) OVER w14 AS avg_loss_14,
    stddev_samp(price_change_1d) OVER w5 AS price_volatility_5d,
    stddev_samp(price_change_1d) OVER w10 AS price_volatility_10d,
    stddev_samp(volume_change_1d) OVER w5 AS volume_volatility_5d
  FROM s3 WINDOW
    w5 AS (PARTITION BY stock_symbol ORDER BY Date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
    w10 AS (PARTITION BY stock_symbol ORDER BY Date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW),
    w14 AS (PARTITION BY stock_symbol ORDER BY Date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)),
feats AS (SELECT *, avg_gain_14 / (avg_loss_14 + 0.001::DOUBLE) AS momentum_ratio,
    price_change_1d * volume_change_1d AS price_volume_interaction,
    price_change_1d * sentiment_change_1d AS price_sentiment_interaction,
    volume_change_1d * sentiment_change_1d AS volume_sentiment_interaction,
    price_change_1d * volume_change_1d * sentiment_change_1d AS price_volume_sentiment_interaction,
    price_volatility_5d / (price_volatility_10d + 0.001::DOUBLE) AS volatility_ratio_5_10,
    price_change_1d / (price_volatility_5d + 0.001::DOUBLE) AS risk_adjusted_return
  FROM s4)"""


# Feature names in their documented order, by group.
PRICE = [
    "close_lag_1", "close_lag_2", "close_lag_3", "close_lag_5", "price_change_1d",
    "price_change_3d", "price_change_5d", "ma_5", "close_vs_ma5", "ma_10", "close_vs_ma10", "ma_20",
    "close_vs_ma20", "high_low_spread", "close_normalized_vs_lag1", "close_normalized_vs_lag5",
]
VOLUME = [
    "volume_lag_1", "volume_ma_5", "volume_ma_20", "volume_change_1d", "volume_vs_ma5",
    "volume_vs_ma20", "volume_normalized_vs_lag1",
]
SENTIMENT = [
    "sentiment_lag_1", "sentiment_lag_3", "sentiment_ma_5", "sentiment_ma_10", "sentiment_ma_20",
    "sentiment_change_1d", "sentiment_change_3d", "sentiment_volatility_5d",
]
TECHNICAL = ["momentum_ratio", "price_position_5d"]
INTERACTION = [
    "price_volume_interaction", "price_sentiment_interaction", "volume_sentiment_interaction",
    "price_volume_sentiment_interaction",
]
VOLATILITY = [
    "price_volatility_5d", "price_volatility_10d", "volume_volatility_5d", "volatility_ratio_5_10",
    "risk_adjusted_return",
]
HELPERS = ["price_gain", "price_loss", "avg_gain_14", "avg_loss_14", "high_5d", "low_5d"]
NAMES = PRICE + VOLUME + SENTIMENT + TECHNICAL + INTERACTION + VOLATILITY
TOP25 = NAMES[:25]
MEANS = ["ma_5", "ma_10", "ma_20"]

COMPLETE = " AND ".join(f"{n} IS NOT NULL" for n in NAMES)


def _clean(name: str) -> str:
    return f"""{_features(name)},
clean AS (SELECT * FROM feats WHERE target IS NOT NULL AND {COMPLETE})"""


def _split(name: str) -> str:
    return f"""{_clean(name)},
parted AS (SELECT * EXCLUDE (pos, size), CASE WHEN pos <= floor(size * 0.85::DOUBLE) THEN 'train' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY stock_symbol ORDER BY Date) AS pos,
          count(*) OVER (PARTITION BY stock_symbol) AS size FROM clean))"""


def _scored(name: str = "panel_daily", part: str = "test") -> str:
    return f"""{_split(name)},
scored AS (SELECT stock_symbol, Date, Close, target, close_vs_ma5 AS prediction FROM parted WHERE split = '{part}'),
errs AS (SELECT *, target - prediction AS residual, abs(target - prediction) AS abs_error FROM scored)"""


def _x(expr: str, name: str, digits: int = 6) -> str:
    """Rounded as in the catalogue, moving averages of prices in steps off the decimal ties."""
    if name in MEANS:
        return f"floor({expr} * 10000 + 0.637::DOUBLE) / 10000 + 0.0::DOUBLE AS {name}"
    return f"round({expr}, {digits}) + 0.0::DOUBLE AS {name}"


def _r(names: list[str], digits: int = 6) -> str:
    return ", ".join(_x(n, n, digits) for n in names)


BARS = f"stock_symbol, Date, News_flag, {_r(BAR_COLUMNS)}"

R2 = """CASE WHEN count(target) < 2 THEN NULL WHEN var_pop(target) = 0 THEN
  CASE WHEN sum(power(target - prediction, 2)) = 0 THEN 1.0 ELSE 0.0 END
  ELSE 1 - sum(power(target - prediction, 2)) / (var_pop(target) * count(target)) END"""
MAE = "avg(abs(target - prediction))"
MSE = "avg((target - prediction) * (target - prediction))"
METRICS = f"""{_x(MAE, "mae")}, {_x(MSE, "mse")}, {_x(f"sqrt({MSE})", "rmse")}, {_x(R2, "r2")},
  count(*) AS sample_count"""


def _histogram(value: str) -> str:
    return f"""{_scored()},
span AS (SELECT CASE WHEN min({value}) = max({value}) THEN min({value}) - 0.5 ELSE min({value}) END AS lo,
  CASE WHEN min({value}) = max({value}) THEN max({value}) + 0.5 ELSE max({value}) END AS hi, count(*) AS total FROM errs),
hits AS (SELECT CAST(least(floor(50 * ({value} - lo) / (hi - lo)) + 1, 50) AS INT) AS bin, count(*) AS found
  FROM errs, span GROUP BY 1)
SELECT b.bin, {_x("lo + (b.bin - 1) * ((hi - lo) / 50)", "bin_start")}, {_x("lo + b.bin * ((hi - lo) / 50)", "bin_end")},
  coalesce(found, 0) AS n, {_x("coalesce(found, 0) / (total * ((hi - lo) / 50))", "density")}
FROM (SELECT CAST(range AS INT) AS bin FROM range(1, 51)) b CROSS JOIN span LEFT JOIN hits ON hits.bin = b.bin"""


def _stats(names: list[str], source: str = "parted") -> str:
    cols = ", ".join(f"avg({n}) AS m_{n}, stddev_samp({n}) AS s_{n}" for n in names)
    return f"stats AS (SELECT {cols} FROM {source} WHERE split = 'train')"


def _scaled(names: list[str]) -> str:
    return ", ".join(_x(f"coalesce(({n} - m_{n}) / nullif(s_{n}, 0), 0)", n) for n in names)


def _corr(names: list[str], pairs: list[tuple[int, int]], source: str) -> str:
    cells = ", ".join(f'corr({names[i]}, {names[j]}) AS "{i}|{j}"' for i, j in pairs)
    listed = ", ".join(f"({i}, '{n}')" for i, n in enumerate(names))
    return f"""cells AS (UNPIVOT (SELECT {cells} FROM {source}) ON COLUMNS(*) INTO NAME pair VALUE r),
labels_ AS (SELECT * FROM (VALUES {listed}) t(idx, label)),
corr_ AS (SELECT CAST(split_part(pair, '|', 1) AS INT) AS i, CAST(split_part(pair, '|', 2) AS INT) AS j, r FROM cells)"""


CORR_ROWS = f"""SELECT a.label AS feature_a, b.label AS feature_b, {_x("r", "r")}
FROM corr_ JOIN labels_ a ON a.idx = i JOIN labels_ b ON b.idx = j"""

PREDICTED = """SELECT stock_symbol, Date AS current_date, Close AS current_price, prediction AS predicted_return,
  Close * (1 + prediction) AS predicted_price FROM scored"""
LATEST = f"latest AS (SELECT * FROM ({PREDICTED}) QUALIFY row_number() OVER (PARTITION BY stock_symbol ORDER BY \"current_date\" DESC) = 1)"
RECORD = f"""stock_symbol, "current_date", {_r(["current_price", "predicted_return", "predicted_price"])}"""

DIGEST = "md5(concat_ws('|', '42', stock_symbol, strftime(Date, '%Y-%m-%d %H:%M:%S')))"

VERSIONS = """WITH versions AS (SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderdate AS started_at,
  o_orderpriority AS name, CASE o_orderstatus WHEN 'F' THEN 'Production' WHEN 'P' THEN 'Staging' END AS stage,
  CAST(o_custkey AS DOUBLE) AS version FROM orders)"""
VERSION_PLACE = "CASE coalesce(stage, 'None') WHEN 'Production' THEN 2 WHEN 'None' THEN 1 ELSE 0 END"
VERSION_ORDER = f"""{VERSION_PLACE} DESC, CASE WHEN {VERSION_PLACE} > 0 THEN version END DESC NULLS LAST,
  started_at DESC, run_id"""


def _inference(name: str, source: str, require_target: bool) -> str:
    """Features of the newest 50 validated bars of each symbol, computed with the 19 bars before them."""
    newest = f"""newest AS (SELECT *, row_number() OVER (PARTITION BY stock_symbol ORDER BY Date DESC) AS age FROM bars
  QUALIFY age <= 69)"""
    whole = _features(name)
    start = whole.index("s1 AS (")
    body = whole[start:].replace("FROM bars WINDOW", "FROM newest WINDOW")
    for cte in ("s1", "s2", "s3", "s4", "feats"):
        body = body.replace(f"{cte} AS (SELECT", f"n_{cte} AS (SELECT").replace(f"FROM {cte})", f"FROM n_{cte})")
        body = body.replace(f"FROM {cte} WINDOW", f"FROM n_{cte} WINDOW").replace(f"FROM {cte} ", f"FROM n_{cte} ")
    body = body.replace("FROM s2)", "FROM n_s2)")
    keep = f"WHERE age <= 50 AND {COMPLETE}" + (" AND target IS NOT NULL" if require_target else "")
    return f"{newest}, {body}, {source} AS (SELECT * FROM n_feats {keep})"


def _feature_query(name: str, columns: list[str], source: str = "feats", head: str | None = None) -> str:
    return f"{head or _features(name)} SELECT stock_symbol, Date, {_r(columns)} FROM {source}"


def _run_rows(run_id: str, part: str) -> str:
    return f"""SELECT '{run_id}' AS run_id, 'metric' AS kind, '{part}_' || metric AS key, {_x("value", "value")}
FROM (UNPIVOT (SELECT {MAE} AS mae, {MSE} AS mse, sqrt({MSE}) AS rmse, {R2} AS r2,
  CAST(count(*) AS DOUBLE) AS sample_count FROM (SELECT *, close_vs_ma5 AS prediction FROM parted WHERE split = '{part}'))
  ON COLUMNS(*) INTO NAME metric VALUE value)"""


def _grid() -> str:
    """The candidates of a search: every combination, each scored, one of them best."""
    return """SELECT 'maxIter=' || i || ',maxDepth=' || d || ',stepSize=' || s AS params, true AS scored, 1::BIGINT AS n_best
FROM (VALUES (2), (3)) a(i), (VALUES (2), (3)) b(d), (VALUES ('0.1'), ('0.2')) c(s)
WHERE (SELECT count(*) FROM lineitem) > 0"""


def _pruned(name: str) -> str:
    """Greedy pruning on the training rows."""
    pairs = [(i, j) for i in range(len(NAMES)) for j in range(len(NAMES))]
    return f"""{_split(name)}, train_ AS (SELECT * FROM parted WHERE split = 'train'), {_corr(NAMES, pairs, "train_")},
strong AS MATERIALIZED (SELECT j, list(i) AS partners FROM corr_ WHERE i <> j AND abs(r) > 0.95 GROUP BY j),
walk AS (SELECT 0 AS step, [0] AS kept UNION ALL
  SELECT step + 1, CASE WHEN list_has_any(kept, coalesce(partners, []::INT[])) THEN kept ELSE list_append(kept, step + 1) END
  FROM walk LEFT JOIN strong ON strong.j = step + 1 WHERE step < {len(NAMES) - 1}),
pruned AS (SELECT label, list_contains(kept, idx) AS kept FROM labels_, (SELECT kept FROM walk WHERE step = {len(NAMES) - 1}))"""


def oracle() -> dict[str, str]:
    daily = "panel_daily"
    all_pairs = [(i, j) for i in range(len(NAMES)) for j in range(len(NAMES))]
    low_pairs = [(i, j) for i in range(len(NAMES)) for j in range(len(NAMES)) if i > j]
    few = ["price_change_1d", "volume_change_1d", "sentiment_change_1d", "momentum_ratio", "target"]
    few_pairs = [(i, j) for i in range(5) for j in range(5) if i < j]
    describe = ["Close", "Volume", "Scaled_sentiment"]
    statistics = {
        "count": "CAST(count({c}) AS DOUBLE)",
        "mean": "avg({c})",
        "stddev": "stddev_samp({c})",
        "min": "min({c})",
        "max": "max({c})",
    }
    describe_rows = " UNION ALL ".join(
        f"SELECT '{s}' AS statistic, " + ", ".join(_x(e.format(c=c), c, 4) for c in describe) + " FROM bars"
        for s, e in statistics.items()
    )
    stats_rows = " UNION ALL ".join(
        f"SELECT '{n}' AS feature, {_x(f'm_{n}', 'mean')}, {_x(f's_{n}', 'std')} FROM stats" for n in NAMES
    )
    normal = NormalDist()
    qq = " UNION ALL ".join(
        f"SELECT {_x(f'{k / 100}::DOUBLE', 'probability')}, {_x(f'({normal.inv_cdf(k / 100)!r})::DOUBLE', 'theoretical')}, "
        f"{_x(f'q[{k}]', 'sample')} FROM quants"
        for k in range(1, 100)
    )
    grid = ", ".join(f"{k / 100}::DOUBLE" for k in range(1, 100))
    models = " UNION ALL ".join(
        f"SELECT '{m}' AS model, target, {m} AS prediction FROM parted WHERE split = 'test'"
        for m in ("close_vs_ma5", "close_vs_ma10", "close_vs_ma20")
    )
    ratios = ", ".join(_x(f"{m} / nullif(max({m}) OVER (), 0)", f"{m}_ratio") for m in ("mae", "mse", "rmse", "r2"))

    return {
        "clean_casts": f"""WITH t AS ({TYPED}) SELECT stock_symbol, event_id, Date, News_flag,
  {_r([c for c in BAR_COLUMNS if c != "Sentiment_gpt"])} FROM t""",
        "drop_null_critical": f"""WITH t AS ({TYPED}) SELECT event_id, stock_symbol, Date, {_r(["Close", "Volume"])} FROM t
WHERE Date IS NOT NULL AND Close IS NOT NULL AND Volume IS NOT NULL AND Scaled_sentiment IS NOT NULL""",
        "drop_invalid_price": f"{_panel('panel_edge')} SELECT {BARS} FROM panel WHERE Close > 0 AND Volume >= 0",
        "outlier_rule": f"""{_panel(daily)} SELECT stock_symbol, Date, {_r(["Close", "Volume"])} FROM ({_jumps("panel")})
WHERE jump IS NULL OR jump <= 0.5""",
        "validate_daily": f"{_valid(daily)} SELECT {BARS} FROM bars",
        "validate_hourly": f"{_valid('panel_hourly')} SELECT {BARS} FROM bars",
        "validate_edge": f"{_valid('panel_edge')} SELECT {BARS} FROM bars",
        "removed_counts": f"""WITH t AS ({TYPED}),
ruled AS (SELECT *, CASE
    WHEN Date IS NULL OR Close IS NULL OR Volume IS NULL OR Scaled_sentiment IS NULL THEN 'null'
    WHEN isnan(Close) OR isnan(Volume) OR isnan(Scaled_sentiment) THEN 'nan'
    WHEN Close <= 0 OR Volume < 0 THEN 'invalid' END AS rule FROM t),
good AS (SELECT * FROM ruled WHERE rule IS NULL),
flagged AS (SELECT stock_symbol, rule FROM ruled WHERE rule IS NOT NULL
  UNION ALL SELECT stock_symbol, CASE WHEN jump > 0.5 THEN 'outlier' END FROM ({_jumps("good")}))
SELECT stock_symbol, count(*) AS n_rows, count(*) FILTER (rule = 'null') AS n_null,
  count(*) FILTER (rule = 'nan') AS n_nan, count(*) FILTER (rule = 'invalid') AS n_invalid,
  count(*) FILTER (rule = 'outlier') AS n_outlier, count(rule) AS n_removed,
  count(*) - count(rule) AS n_kept FROM flagged GROUP BY stock_symbol""",
        "literal_entity": f"{_panel('panel_edge')} SELECT Date, {_r(['Close'])}, 'ACME' AS stock_symbol FROM panel",
        "sorted_panel": f"{_panel(daily)} SELECT stock_symbol, Date, {_r(['Close'])} FROM panel ORDER BY 1, 2",
        "rows_per_symbol": f"{_valid(daily)} SELECT stock_symbol, count(*) AS n FROM bars GROUP BY 1",
        "date_range": f"{_valid(daily)} SELECT min(Date) AS min_date, max(Date) AS max_date FROM bars",
        "describe_panel": f"{_valid(daily)} {describe_rows}",
        "total_rows": f"{_valid(daily)} SELECT count(*) AS n FROM bars",
        "distinct_symbols": "SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS stock_symbol FROM lineitem",
        "count_symbols": "SELECT count(DISTINCT user_id) AS n_entities FROM events",
        "union_panels": f"""WITH hourly AS ({PANEL_HOURLY}), edge AS ({PANEL_EDGE}),
both_ AS (SELECT * EXCLUDE (Adj_Close) FROM hourly UNION ALL BY NAME SELECT * EXCLUDE (News_flag) FROM edge)
SELECT {BARS} FROM both_""",
        "lag_lead": f"""{_features(daily)} SELECT stock_symbol, Date,
  {_r(["close_lag_1", "close_lag_2", "close_lag_3", "close_lag_5"])}, {_x("next_close", "close_lead_1")} FROM feats""",
        "rolling_mean": _feature_query(daily, ["ma_5", "ma_10", "ma_20", "volume_ma_5", "volume_ma_20"]),
        "rolling_stddev": f"""{_valid("panel_hourly")} SELECT stock_symbol, Date,
  {_x("stddev_samp(Scaled_sentiment) OVER (PARTITION BY stock_symbol ORDER BY Date ROWS 4 PRECEDING)", "sd_5")},
  {_x("stddev_samp(Scaled_sentiment) OVER (PARTITION BY stock_symbol ORDER BY Date ROWS 9 PRECEDING)", "sd_10")} FROM bars""",
        "rolling_minmax": _feature_query(daily, ["high_5d", "low_5d"]),
        "pct_change": _feature_query(
            "panel_edge", ["price_change_1d", "close_normalized_vs_lag5", "sentiment_change_3d"]
        ),
        "ratio_to_ma": _feature_query("panel_edge", ["close_vs_ma10", "volume_vs_ma5"]),
        "feat_price": _feature_query(daily, PRICE),
        "feat_volume": _feature_query(daily, VOLUME),
        "feat_sentiment": _feature_query(daily, SENTIMENT),
        "feat_technical": _feature_query(daily, TECHNICAL + HELPERS),
        "feat_interaction": _feature_query(daily, INTERACTION),
        "feat_volatility": _feature_query(daily, VOLATILITY),
        "target_next": _feature_query(daily, ["Close", "target"]),
        "features_all": _feature_query(daily, NAMES + ["target"]),
        "features_all_hourly": _feature_query("panel_hourly", NAMES + ["target"]),
        "features_all_edge": _feature_query("panel_edge", NAMES + ["target"]),
        "features_clean": _feature_query("panel_edge", NAMES + ["target"], "clean", _clean("panel_edge")),
        "features_top25": _feature_query(daily, TOP25 + ["target"], "clean", _clean(daily)),
        "time_split": f"{_split(daily)} SELECT stock_symbol, Date, split FROM parted",
        "split_sizes": f"{_split(daily)} SELECT stock_symbol, split, count(*) AS n FROM parted GROUP BY 1, 2",
        "test_rows": f"""{_split("panel_hourly")} SELECT stock_symbol, Date, {_r(["Close", "target"])} FROM parted
WHERE split = 'test'""",
        "latest_n": f"""{_panel(daily)} SELECT stock_symbol, Date, {_r(["Close", "Volume"])} FROM panel
QUALIFY row_number() OVER (PARTITION BY stock_symbol ORDER BY Date DESC) <= 50""",
        "latest_1": f"""{_panel(daily)} SELECT stock_symbol, Date, {_r(["Close", "Volume"])} FROM panel
QUALIFY row_number() OVER (PARTITION BY stock_symbol ORDER BY Date DESC) = 1""",
        "scale_train_stats": f"{_split(daily)}, {_stats(NAMES)} {stats_rows}",
        "scale_merged_stats": f"{_split(daily)}, {_stats(NAMES)} {stats_rows}",
        "describe_merged": f"""{_valid(daily)}, long_ AS (UNPIVOT (SELECT Close, Volume, Scaled_sentiment FROM bars)
  ON Close, Volume, Scaled_sentiment INTO NAME feature VALUE v)
SELECT feature, count(*) AS count, {_x("avg(v)", "mean")}, {_x("stddev(v)", "stddev")}, {_x("min(v)", "min")}, {_x("max(v)", "max")}
FROM long_ GROUP BY feature""",
        "scaled_features": f"""{_split(daily)}, {_stats(NAMES)} SELECT stock_symbol, Date, split, {_scaled(NAMES)}
FROM parted, stats""",
        "scaled_vectors": f"""{_split(daily)}, {_stats(NAMES)} SELECT stock_symbol, Date, split, {_scaled(NAMES)}
FROM parted, stats""",
        "corr_long": f"{_clean(daily)}, {_corr(NAMES, all_pairs, 'clean')} {CORR_ROWS}",
        "corr_lower": f"{_clean(daily)}, {_corr(NAMES, low_pairs, 'clean')} {CORR_ROWS}",
        "corr_pairwise": f"{_features(daily)}, {_corr(few, few_pairs, 'feats')} {CORR_ROWS}",
        "corr_pairwise_all": f"{_features(daily)}, {_corr(NAMES, [(i, j) for i in range(len(NAMES)) for j in range(i + 1, len(NAMES))], 'feats')} {CORR_ROWS}",
        "corr_prune": f"""{_clean(daily)}, {_corr(NAMES, all_pairs, "clean")},
strong AS MATERIALIZED (SELECT j, list(i) AS partners FROM corr_ WHERE i <> j AND abs(r) > 0.95 GROUP BY j),
walk AS (SELECT 0 AS step, [0] AS kept UNION ALL
  SELECT step + 1, CASE WHEN list_has_any(kept, coalesce(partners, []::INT[])) THEN kept ELSE list_append(kept, step + 1) END
  FROM walk LEFT JOIN strong ON strong.j = step + 1 WHERE step < {len(NAMES) - 1})
SELECT idx AS position, label AS feature, list_contains(kept, idx) AS kept
FROM labels_, (SELECT kept FROM walk WHERE step = {len(NAMES) - 1})""",
        "sample_md5": f"{_panel(daily)} SELECT stock_symbol, Date FROM panel ORDER BY {DIGEST}, 1, 2 LIMIT 1000",
        "sample_fraction": f"""{_panel(daily)} SELECT stock_symbol, Date FROM panel
WHERE CAST('0x' || substr({DIGEST}, 1, 8) AS BIGINT) < {int(0.3 * 2**32)}""",
        "metrics_overall": f"""{_split(daily)} SELECT split, {METRICS}
FROM (SELECT *, close_vs_ma5 AS prediction FROM parted) GROUP BY split""",
        "metrics_per_symbol": f"""{_scored()} SELECT stock_symbol, {_x(MAE, "mae")}, {_x(MSE, "mse")}, {_x(R2, "r2")},
  count(*) AS sample_count FROM scored GROUP BY 1""",
        "residuals": f"""{_scored()} SELECT stock_symbol, Date, {_r(["target", "prediction", "residual", "abs_error"])}
FROM errs""",
        "axis_bounds": f"""{_scored()} SELECT {_x("least(min(target), min(prediction))", "lower")},
  {_x("greatest(max(target), max(prediction))", "upper")} FROM scored""",
        "hist_actual": _histogram("target"),
        "hist_predicted": _histogram("prediction"),
        "hist_residual": _histogram("residual"),
        "hist_abs_error": _histogram("abs_error"),
        "normal_overlay": f"""{_scored()},
st AS (SELECT min(residual) AS lo, max(residual) AS hi, avg(residual) AS mu, stddev_samp(residual) AS sd FROM errs),
pts AS (SELECT CAST(range AS INT) AS point, lo + range * ((hi - lo) / 99) AS x, mu, sd FROM range(0, 100), st)
SELECT point, {_r(["x"])}, {_x("exp(-0.5::DOUBLE * ((x - mu) / sd) * ((x - mu) / sd)) / (sd * sqrt(2 * pi()))", "density")}
FROM pts""",
        "qq_points": f"{_scored()}, quants AS (SELECT quantile_cont(residual, [{grid}]) AS q FROM errs) {qq}",
        "box_per_symbol": f"""{_scored()},
q AS (SELECT stock_symbol, quantile_cont(residual, 0.25::DOUBLE) AS q1, quantile_cont(residual, 0.5::DOUBLE) AS median,
  quantile_cont(residual, 0.75::DOUBLE) AS q3 FROM errs GROUP BY 1),
b AS (SELECT stock_symbol, q1, median, q3, residual,
  residual BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1) AS inside FROM errs JOIN q USING (stock_symbol)),
g AS (SELECT stock_symbol, any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
  least(min(residual) FILTER (inside), any_value(q1)) AS whisker_low,
  greatest(max(residual) FILTER (inside), any_value(q3)) AS whisker_high,
  count(*) FILTER (NOT inside) AS n_outliers, count(*) AS n FROM b GROUP BY 1)
SELECT stock_symbol, {_r(["q1", "median", "q3", "whisker_low", "whisker_high"])}, n_outliers, n FROM g""",
        "residual_stats": f"""{_scored()} SELECT {_x("avg(residual)", "mean")}, {_x("stddev_samp(residual)", "std")},
  {_x("min(residual)", "min")}, {_x("max(residual)", "max")}, {_x("skewness(residual)", "skewness")},
  {_x("kurtosis(residual)", "kurtosis")}, {_x("quantile_cont(residual, 0.025::DOUBLE)", "q025")},
  {_x("quantile_cont(residual, 0.975::DOUBLE)", "q975")} FROM errs""",
        "sampled_fit": f"""{_scored()}, pick AS (SELECT * FROM scored ORDER BY {DIGEST}, stock_symbol, Date LIMIT 1000)
SELECT {_x(R2, "r2")}, {_x(MAE, "mae")}, count(*) AS sample_count FROM pick""",
        "per_symbol_ratio": f"""{_scored()}, m AS (SELECT stock_symbol, {MAE} AS mae, {MSE} AS mse, {R2} AS r2,
  count(*) AS sample_count FROM scored GROUP BY 1)
SELECT stock_symbol, sample_count, {_r(["mae", "mse", "r2"])}, {_x("mae / nullif(max(mae) OVER (), 0)", "mae_ratio")},
  {_x("mse / nullif(max(mse) OVER (), 0)", "mse_ratio")}, {_x("r2 / nullif(max(r2) OVER (), 0)", "r2_ratio")} FROM m""",
        "model_comparison_pivot": f"""{_split(daily)}, every AS ({models}),
m AS (SELECT model, {MAE} AS mae, {MSE} AS mse, sqrt({MSE}) AS rmse, {R2} AS r2 FROM every GROUP BY model)
SELECT model, {_r(["mae", "mse", "rmse", "r2"])}, {ratios} FROM m""",
        "predict_price": f"{_scored()}, p AS ({PREDICTED}) SELECT {RECORD} FROM p",
        "latest_predictions": f"{_scored()}, {LATEST} SELECT {RECORD} FROM latest",
        "direction": f"""{_scored()}, {LATEST},
moved AS (SELECT *, (predicted_price - current_price) / nullif(current_price, 0) AS predicted_change FROM latest)
SELECT {RECORD}, {_r(["predicted_change"])}, CASE WHEN predicted_change > 0 THEN 'up' WHEN predicted_change < 0 THEN 'down'
  ELSE 'flat' END AS direction FROM moved""",
        "prediction_summary": f"""{_scored()}, {LATEST} SELECT {_x("avg(predicted_return)", "avg_return")},
  {_x("max(predicted_return)", "max_return")}, {_x("min(predicted_return)", "min_return")},
  count(*) FILTER (predicted_return > 0) AS n_bullish, count(*) FILTER (predicted_return < 0) AS n_bearish FROM latest""",
        "inference_features": f"""{_split(daily)}, {_stats(NAMES)}, {_inference(daily, "fresh", False)}
SELECT stock_symbol, Date, {_scaled(NAMES)} FROM fresh, stats""",
        "inference_features_with_target": f"""{_valid("panel_hourly")}, {_inference("panel_hourly", "fresh", True)}
SELECT stock_symbol, Date, {_r(NAMES + ["target"])} FROM fresh""",
        "select_latest_run": f"{VERSIONS} SELECT * FROM versions ORDER BY {VERSION_ORDER} LIMIT 1",
        "select_latest_per_model": f"""{VERSIONS} SELECT * FROM versions
QUALIFY row_number() OVER (PARTITION BY name ORDER BY {VERSION_ORDER}) = 1""",
        "run_stamps": f"{VERSIONS} SELECT run_id, strftime(started_at, '%Y%m%d_%H%M%S') AS stamp FROM versions",
        "run_log_append": f"{_split(daily)} {_run_rows('a', 'train')} UNION ALL {_run_rows('b', 'test')}",
        "run_log_entities": f"""{_scored()}, m AS (SELECT stock_symbol, {MAE} AS mae, {MSE} AS mse, {R2} AS r2,
  CAST(count(*) AS DOUBLE) AS sample_count FROM scored GROUP BY 1)
SELECT 'a' AS run_id, 'metric' AS kind, stock_symbol || '_' || metric AS key, {_x("value", "value")}
FROM m UNPIVOT INCLUDE NULLS (value FOR metric IN (mae, mse, r2, sample_count))""",
        "csv_roundtrip": f"{_panel(daily)} SELECT {BARS} FROM panel",
        "ingest_csv": f"""{_valid("panel_hourly")} SELECT upper(stock_symbol) AS stock_symbol, Date, News_flag,
  {_r(BAR_COLUMNS)} FROM bars""",
        "ingest_incremental": f"""{_valid("panel_hourly")} SELECT upper(stock_symbol) AS stock_symbol, Date, News_flag,
  {_r(BAR_COLUMNS)}, true AS one_parsed FROM bars""",
        "table_overwrite": f"{_valid(daily)} SELECT stock_symbol, Date, {_r(['Close', 'Volume'])} FROM bars",
        "table_append": f"SELECT * FROM ({_scored()}, {LATEST} SELECT {RECORD} FROM latest) UNION ALL "
        f"SELECT * FROM ({_scored('panel_hourly')}, {LATEST} SELECT {RECORD} FROM latest)",
        "table_append_repeated": f"SELECT *, 'panel_daily' AS run_id FROM ({_scored()}, {LATEST} SELECT {RECORD} FROM latest) UNION ALL "
        f"SELECT *, 'panel_hourly' FROM ({_scored('panel_hourly')}, {LATEST} SELECT {RECORD} FROM latest)",
        "table_replace_itself": f"""{_valid("panel_hourly")} SELECT stock_symbol, Date, {_r(["Close", "Volume"])} FROM bars WHERE Volume > 1""",
        "slices_newest": f"""{_valid(daily)} SELECT stock_symbol, Date, News_flag, {_r(BAR_COLUMNS)} FROM bars
QUALIFY row_number() OVER (PARTITION BY stock_symbol ORDER BY Date DESC) <= 50""",
        "predictions_export": f"""{_scored()} SELECT 'prediction' AS part, stock_symbol AS name, Date AS date,
  {_x("target", "x")}, {_x("prediction", "y")} FROM scored
UNION ALL SELECT 'entity', stock_symbol, NULL, {_x(MAE, "x")}, {_x(R2, "y")} FROM scored GROUP BY stock_symbol
UNION ALL SELECT 'feature', unnest({NAMES}), NULL, 1.0, NULL""",
        "gbt_fit_score": f"""{_split(daily)} SELECT split, count(*) AS n, {_x("var_pop(target)", "spread")},
  CASE WHEN split = 'train' THEN true END AS beats_mean FROM parted GROUP BY split""",
        "gbt_importance": f"SELECT unnest({NAMES}) AS feature, true AS valid, true AS sums_to_one",
        "gbt_pruned_features": f"{_pruned(daily)} SELECT label AS feature, true AS valid, true AS sums_to_one "
        "FROM pruned WHERE kept",
        "gbt_reload": f"""{_split(daily)} SELECT 0.0::DOUBLE AS largest_gap, count(*) AS n, true AS same_scaler
FROM parted WHERE split = 'test'""",
        **dict.fromkeys(("cv_grid", "cv_time_folds"), _grid()),
        "random_search": """SELECT n AS n_scored, n AS n_distinct, n AS n_in_range, 1::BIGINT AS n_best
FROM (SELECT 10::BIGINT AS n) WHERE (SELECT count(*) FROM lineitem) > 0""",
        "sequential_search": """SELECT n AS n_scored, n AS n_distinct, n AS n_in_range, 1::BIGINT AS n_best
FROM (SELECT 10::BIGINT AS n) WHERE (SELECT count(*) FROM events) > 0""",
        "gbt_early_stopping": f"""{_split(daily)} SELECT split, count(*) AS n, {_x("var_pop(target)", "spread")},
  CASE WHEN split = 'train' THEN true END AS beats_mean, true AS within_limit FROM parted GROUP BY split""",
        "inference_run": f"""{_valid(daily)}, {_inference(daily, "fresh", False)}
SELECT stock_symbol, Date AS current_date, {_x("Close", "current_price")}, true AS consistent FROM fresh
QUALIFY row_number() OVER (PARTITION BY stock_symbol ORDER BY Date DESC) = 1""",
        "inference_sliced": f"""{_valid(daily)}, {_inference(daily, "fresh", False)}
SELECT stock_symbol, Date, {_r(NAMES)} FROM fresh""",
        "inference_named": """SELECT * FROM (VALUES ('a', 'a1', 1.0::DOUBLE, 'Production'), ('b', 'b1', 1.0::DOUBLE, 'None'))
  t(name, run_id, version, stage) WHERE (SELECT count(*) FROM events) > 0""",
        "run_log_model": f"""{_split("panel_hourly")},
numbers AS (SELECT unnest(['sequence_length', 'train_split', 'maxIter', 'maxDepth', 'stepSize', 'subsamplingRate', 'seed',
    'num_features', 'layout_partitions']) AS key, unnest([50, 0.85, 5, 4, 0.1, 0.8, 42, {len(NAMES)},
    greatest(1, ceil((SELECT count(*) FROM parted WHERE split = 'train') / 50000))]::DOUBLE[]) AS value)
SELECT 'param' AS kind, key, NULL::VARCHAR AS text, {_x("value", "value")}, 1::BIGINT AS n FROM numbers
UNION ALL SELECT * FROM (VALUES ('param', 'algorithm', 'GBTRegressor', NULL::DOUBLE, 1::BIGINT),
  ('param', 'featureSubsetStrategy', 'sqrt', NULL, 1), ('param', 'feature_names', NULL, NULL, 1),
  ('metric', 'importance', NULL, NULL, 10), ('model', 'name', 'panel_gbt', NULL, 1),
  ('model', 'stage', 'Production', NULL, 1), ('model', 'version', NULL, 1, 1), ('model', 'path', NULL, NULL, 1)) t""",
        "validate_without_volume": f"""{_panel("panel_edge")},
kept AS (SELECT * FROM panel WHERE {ROW_RULES.replace("AND Volume IS NOT NULL ", "").replace("AND NOT isnan(Volume) ", "")}
  AND Close > 0)
SELECT stock_symbol, Date, {_r(["Close"])} FROM ({_jumps("kept")}) WHERE jump IS NULL OR jump <= 0.5""",
    }
