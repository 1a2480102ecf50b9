"""The registered queries as DuckDB SQL, written independently of the operators."""

from __future__ import annotations

ZONES = """zones AS (
  SELECT n_nationkey AS LocationID, n_name AS Zone, r_name AS Borough
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

TRIPS = """trips AS (
  SELECT event_id, event_type, ts AS pickup_ts,
         ts + to_seconds(CAST(round(value * 60) AS BIGINT)) AS dropoff_ts,
         CAST(user_id % 25 AS INTEGER) AS PULocationID,
         CAST(event_id % 25 AS INTEGER) AS DOLocationID, value AS trip_distance
  FROM events)"""

NAMED = f"""{ZONES}, {TRIPS}, named AS (
  SELECT t.*, p.Zone AS Pickup_Zone, p.Borough AS Pickup_Borough,
         d.Zone AS Dropoff_Zone, d.Borough AS Dropoff_Borough
  FROM trips t LEFT JOIN zones p ON p.LocationID = t.PULocationID
               LEFT JOIN zones d ON d.LocationID = t.DOLocationID)"""

FARES = """fares AS (
  SELECT l_linestatus AS dataset, l_quantity AS trip_distance, l_extendedprice AS fare_amount,
         l_extendedprice * l_discount AS tip_amount, l_extendedprice * l_tax AS tolls_amount,
         l_extendedprice * (1 + l_discount + l_tax) AS total_amount
  FROM lineitem)"""

BARS = """bars AS (
  SELECT CASE WHEN substr(o_orderpriority, 1, 1) IN ('4', '5') THEN '^I' ELSE 'S' END
           || substr(o_orderpriority, 1, 1) AS ticker,
         CAST(o_orderdate AS DATE) AS date,
         100 + arg_min(o_totalprice, o_orderkey) / 10000 AS open_price,
         100 + max(o_totalprice) / 10000 AS high_price,
         100 + min(o_totalprice) / 10000 AS low_price,
         100 + arg_max(o_totalprice, o_orderkey) / 10000 AS close_price,
         count(*) - 1 AS volume
  FROM orders GROUP BY 1, 2)"""

KEYS = "keys AS (SELECT unnest(['S1', 'S2', 'S3', '^I4', '^I5']) AS ticker)"

GAPS = f"""{BARS}, {KEYS}, gaps AS (
  SELECT d.date, b.open_price, b.high_price, b.low_price, b.close_price,
         b.close_price AS adj_close, b.volume, k.ticker
  FROM (SELECT DISTINCT date FROM bars) d CROSS JOIN keys k
  LEFT JOIN bars b ON b.date = d.date AND b.ticker = k.ticker)"""

RAW = f"""{GAPS}, raw AS (
  SELECT date, coalesce(open_price, 0) AS open_price, coalesce(high_price, 0) AS high_price,
         coalesce(low_price, 0) AS low_price, coalesce(close_price, 0) AS close_price,
         coalesce(adj_close, 0) AS adj_close, coalesce(volume, 0) AS volume, ticker
  FROM gaps)"""

PRICES = f"""{RAW}, prices AS (
  SELECT * FROM raw
  WHERE close_price > 0 AND NOT (NOT starts_with(ticker, '^') AND volume = 0))"""

W = "(PARTITION BY ticker ORDER BY date)"


def last(n: int) -> str:
    return f"(PARTITION BY ticker ORDER BY date ROWS {n - 1} PRECEDING)"


def full(agg: str, n: int, x: str = "close_price") -> str:
    """An aggregate of the last n rows, NULL until there are n."""
    return f"CASE WHEN count({x}) OVER {last(n)} = n_{n} THEN {agg}({x}) OVER {last(n)} END".replace(f"n_{n}", str(n))


DIGITS_OF = {"portfolio_value": 2, "final_value": 2, "normalized": 4, "benchmark": 6, "SMA_200": 9}


def r(expr: str, name: str | None = None) -> str:
    return f"round({expr}, {DIGITS_OF.get(name or expr, 8)}) AS {name or expr}"


DAY = "CAST(date AS VARCHAR) AS date"
BAR = f"""{DAY}, {r('open_price')}, {r('high_price')}, {r('low_price')}, {r('close_price')},
  {r('adj_close')}, CAST(volume AS BIGINT) AS volume, ticker"""


def rsi(source: str, name: str) -> str:
    """CTEs ending in ``name``: the source's rows with RSI."""
    return f"""{name}_d AS (
  SELECT *, close_price - lag(close_price) OVER {W} AS d FROM {source}),
{name}_g AS (
  SELECT *, avg(CASE WHEN d > 0 THEN d ELSE 0 END) OVER {last(14)} AS up,
         avg(CASE WHEN d < 0 THEN -d ELSE 0 END) OVER {last(14)} AS down,
         count(*) OVER {last(14)} AS seen FROM {name}_d),
{name} AS (
  SELECT * EXCLUDE (d, up, down, seen),
         CASE WHEN seen = 14 AND down > 0 THEN 100 - 100 / (1 + up / down)
              WHEN seen = 14 AND up > 0 THEN 100 END AS RSI
  FROM {name}_g)"""


def means(source: str, name: str) -> str:
    """CTEs ending in ``name``: the source's rows with e9, e12, e26 and the smoothed MACD by recursion."""
    return f"""{name}_n AS (SELECT *, row_number() OVER {W} AS rn FROM {source}),
{name}_r(ticker, rn, e9, e12, e26, sig) AS (
  SELECT ticker, rn, close_price, close_price, close_price, 0.0::DOUBLE FROM {name}_n WHERE rn = 1
  UNION ALL
  SELECT ticker, rn, e9, e12, e26, sig * 0.8::DOUBLE + (e12 - e26) * 0.2::DOUBLE FROM (
    SELECT n.ticker, n.rn,
           p.e9 + (n.close_price - p.e9) * 2 / 10 AS e9,
           p.e12 + (n.close_price - p.e12) * 2 / 13 AS e12,
           p.e26 + (n.close_price - p.e26) * 2 / 27 AS e26, p.sig
    FROM {name}_r p JOIN {name}_n n ON n.ticker = p.ticker AND n.rn = p.rn + 1)),
{name} AS (
  SELECT n.*, q.e9, q.e12, q.e26, q.e12 - q.e26 AS macd, q.sig
  FROM {name}_n n JOIN {name}_r q ON q.ticker = n.ticker AND q.rn = n.rn)"""


FEATURES = f"""{PRICES}, {rsi('prices', 'with_rsi')}, {means('with_rsi', 'with_ema')},
table_f AS (
  SELECT date, open_price, high_price, low_price, close_price, adj_close, volume, ticker,
         close_price / lag(close_price) OVER {W} - 1 AS Daily_Return,
         {full('avg', 10)} AS SMA_10, {full('avg', 50)} AS SMA_50, RSI,
         e12 AS EMA_12, e26 AS EMA_26, macd AS MACD, sig AS MACD_Signal,
         {full('avg', 20)} AS Bollinger_Middle, {full('stddev_samp', 20)} AS Bollinger_Std,
         lag(close_price, 1) OVER {W} AS Lag_1, lag(close_price, 2) OVER {W} AS Lag_2,
         lag(close_price, 5) OVER {W} AS Lag_5,
         month(date) AS Month, isodow(date) - 1 AS DayOfWeek,
         lead(close_price) OVER {W} AS Next_Close
  FROM with_ema),
feats AS (
  SELECT *, Bollinger_Middle + 2 * Bollinger_Std AS Bollinger_Upper,
         Bollinger_Middle - 2 * Bollinger_Std AS Bollinger_Lower,
         close_price - Lag_1 AS Price_Change,
         CASE WHEN Next_Close > close_price THEN 1 ELSE 0 END AS Target
  FROM table_f
  WHERE SMA_50 IS NOT NULL AND Next_Close IS NOT NULL AND RSI IS NOT NULL AND Daily_Return IS NOT NULL)"""

SLICE = f"""{FEATURES},
slice_0 AS (SELECT * EXCLUDE (SMA_50, RSI, MACD) FROM feats WHERE date >= DATE '2001-01-01'),
{rsi('slice_0', 'slice_r')}, {means('slice_r', 'slice_e')},
slice_s AS (SELECT *, {full('avg', 50)} AS sma FROM slice_e),
slice AS (
  SELECT * EXCLUDE (RSI, sma), coalesce(RSI, 50) AS RSI, sig AS Signal_Line,
         first_value(sma IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS SMA_50
  FROM slice_s)"""

CHANCE = """CAST((date_diff('day', DATE '1995-01-01', date) * 7919
    + CAST(right(ticker, 1) AS BIGINT) * 104729) % 1000 AS DOUBLE) / 1000"""


def held(source: str, name: str, on: str, off: str) -> str:
    """CTEs ending in ``name``: signal and action of a rule that holds its last decision."""
    return f"""{name}_x AS (
  SELECT *, CASE WHEN {on} THEN 1 WHEN {off} THEN 0 END AS decided FROM {source}),
{name}_s AS (
  SELECT *, coalesce(last_value(decided IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS model_prediction FROM {name}_x),
{name} AS (
  SELECT *, coalesce(lag(model_prediction) OVER {W}, 0) AS strategy_action FROM {name}_s)"""


def ledger(source: str, name: str) -> str:
    """CTEs ending in ``name``: the value of a whole-unit ledger on every row, by recursion."""
    return f"""{name}_n AS (SELECT *, row_number() OVER {W} AS step FROM {source}),
{name}_r(ticker, step, cash, units, bought, sold) AS (
  SELECT ticker, 0::BIGINT, 100000.0::DOUBLE, 0::BIGINT, 0::BIGINT, 0.0::DOUBLE FROM {name}_n WHERE step = 1
  UNION ALL
  SELECT ticker, step,
         cash - bought * open_price * 1.001::DOUBLE + CASE WHEN strategy_action = 0 THEN units * open_price * 0.999::DOUBLE ELSE 0 END,
         CASE WHEN strategy_action = 0 THEN 0 ELSE units + bought END, bought, 0.0::DOUBLE
  FROM (
    SELECT n.ticker, n.step, n.open_price, n.strategy_action, p.cash, p.units,
           CASE WHEN n.strategy_action = 1 AND p.cash > n.open_price
                THEN CAST(floor(p.cash * 0.999::DOUBLE / n.open_price) AS BIGINT) ELSE 0 END AS bought
    FROM {name}_r p JOIN {name}_n n ON n.ticker = p.ticker AND n.step = p.step + 1)),
{name} AS (
  SELECT n.*, q.cash + q.units * n.close_price AS portfolio_value
  FROM {name}_n n JOIN {name}_r q ON q.ticker = n.ticker AND q.step = n.step)"""


SCORED = f"""{SLICE}, scored AS (SELECT *, {CHANCE} AS p FROM slice)"""

HYBRID = SCORED + ", " + held("scored", "placed", "p > 0.45", "p < 0.25 AND NOT coalesce(close_price > SMA_50, false)")

PLACED = f"""{SLICE}, slice_p AS (
  SELECT *, {CHANCE} AS p, CASE WHEN starts_with(ticker, '^') THEN 'INDICES' ELSE 'STOCKS' END AS category
  FROM slice), """ + held(
    "slice_p", "placed",
    "CASE WHEN category = 'STOCKS' THEN MACD > Signal_Line AND p > 0.40 ELSE close_price > SMA_50 OR p > 0.45 END",
    "CASE WHEN category = 'STOCKS' THEN MACD < Signal_Line OR RSI > 80 ELSE p < 0.40 END")

SIGNAL = f"""ticker, {DAY}, CAST(model_prediction AS BIGINT) AS model_prediction,
  CAST(strategy_action AS BIGINT) AS strategy_action"""

RANKED = f"""{PLACED}, {ledger('placed', 'valued')}, ranked AS (
  SELECT category, ticker, final_value,
         CASE WHEN held = 0 THEN 1 ELSE held END AS benchmark,
         final_value / CASE WHEN held = 0 THEN 1 ELSE held END AS score
  FROM (SELECT category, ticker, arg_max(portfolio_value, date) AS final_value,
               floor(100000 * 0.999::DOUBLE / arg_min(open_price, date)) * arg_max(close_price, date) AS held
        FROM valued GROUP BY 1, 2)),
best AS (
  SELECT * FROM ranked
  QUALIFY row_number() OVER (PARTITION BY category ORDER BY score DESC, ticker) = 1)"""

RETURNS = f"""{PRICES}, returns AS (
  SELECT ticker, date, close_price, close_price / lag(close_price) OVER {W} - 1 AS ret FROM prices)"""

LABELS = """labels_t AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_discount AS score,
         CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS pred FROM lineitem)"""

CELLS = f"""{LABELS}, cells AS (
  SELECT count(*) FILTER (label = 0 AND pred = 0)::DOUBLE AS a, count(*) FILTER (label = 0 AND pred = 1)::DOUBLE AS b,
         count(*) FILTER (label = 1 AND pred = 0)::DOUBLE AS c, count(*) FILTER (label = 1 AND pred = 1)::DOUBLE AS d
  FROM labels_t),
rates AS (
  SELECT a / (a + c) AS p0, a / (a + b) AS r0, 2 * a / (2 * a + b + c) AS f0, a + b AS s0,
         d / (b + d) AS p1, d / (c + d) AS r1, 2 * d / (2 * d + b + c) AS f1, c + d AS s1,
         (a + d) / (a + b + c + d) AS acc
  FROM cells)"""

ROC = f"""{LABELS}, points AS (
  SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM labels_t GROUP BY 1),
running AS (
  SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
         sum(pos) OVER () AS p_all, sum(neg) OVER () AS n_all FROM points)"""


def busiest(zone: str, n: int) -> str:
    return f"""WITH {NAMED} SELECT {zone}, count(*) AS trip_count FROM named GROUP BY 1
ORDER BY trip_count DESC, {zone} LIMIT {n}"""


def per_hour(ts: str, zone: str) -> str:
    return f"""WITH {NAMED}, counts AS (
  SELECT hour({ts}) AS hr, {zone}, count(*) AS trip_count FROM named GROUP BY 1, 2)
SELECT CAST(hr AS BIGINT) AS hr, {zone}, trip_count, CAST(rk AS BIGINT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY hr ORDER BY trip_count DESC, {zone}) AS rk FROM counts)
WHERE rk = 1"""


def pairs(source: str) -> str:
    """Correlation of every two keys over the dates on which both have a return."""
    return f"""SELECT x.ticker AS key_a, y.ticker AS key_b, round(CASE WHEN isfinite(corr(a.ret, b.ret)) THEN corr(a.ret, b.ret) END, 8) AS corr, count(b.ret) AS n
FROM keys x JOIN keys y ON x.ticker <> y.ticker AND list_position(['S1', 'S2', 'S3', '^I4', '^I5'], x.ticker)
    < list_position(['S1', 'S2', 'S3', '^I4', '^I5'], y.ticker)
LEFT JOIN {source} a ON a.ticker = x.ticker AND a.ret IS NOT NULL
LEFT JOIN {source} b ON b.ticker = y.ticker AND b.date = a.date AND b.ret IS NOT NULL
GROUP BY 1, 2"""


def column_rows(source: str, cols: list[str], value: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column, {value.format(c=c)} FROM {source}" for c in cols)


BAR_TYPES = {"date": "date", "open_price": "double", "high_price": "double", "low_price": "double",
             "close_price": "double", "adj_close": "double", "volume": "bigint", "ticker": "string"}
TIP_PAIRS = ["trip_distance", "fare_amount", "total_amount", "tolls_amount"]

ORACLES: dict[str, str] = {
    "trip_stats": f"""WITH {FARES}
SELECT dataset, count(*) AS Total_Trips, {r('avg(total_amount)', 'Avg_Total_Amount')},
  {r('avg(trip_distance)', 'Avg_Trip_Distance')}, {r('max(trip_distance)', 'Max_Trip_Distance')}
FROM fares GROUP BY 1""",
    "trips_with_zones": f"""WITH {NAMED}
SELECT event_id, CAST(PULocationID AS BIGINT) AS PULocationID, CAST(DOLocationID AS BIGINT) AS DOLocationID,
  Pickup_Borough, Pickup_Zone, Dropoff_Borough, Dropoff_Zone, {r('trip_distance')} FROM named""",
    "most_expensive_route": f"""WITH {NAMED}
SELECT Pickup_Zone, Dropoff_Zone, count(*) AS trip_count, {r('avg(trip_distance)', 'avg_cost')}
FROM named GROUP BY 1, 2 HAVING count(*) > 5
ORDER BY avg(trip_distance) DESC, Pickup_Zone, Dropoff_Zone LIMIT 1""",
    "busiest_zone": busiest("Pickup_Zone", 1),
    "top5_zones": busiest("Pickup_Zone", 5),
    "longest_trip": f"""WITH {NAMED}
SELECT Pickup_Zone, Dropoff_Zone, {r('trip_distance')}, event_id FROM named
ORDER BY named.trip_distance DESC, event_id LIMIT 1""",
    "top_zone_per_hour": per_hour("pickup_ts", "Pickup_Zone"),
    "top_dropoff_zone_per_hour": per_hour("dropoff_ts", "Dropoff_Zone"),
    "busiest_hours": f"""WITH {NAMED},
i AS (SELECT hour(pickup_ts) AS hr, count(*) AS n FROM named GROUP BY 1),
o AS (SELECT hour(dropoff_ts) AS hr, count(*) AS n FROM named GROUP BY 1)
SELECT CAST(coalesce(i.hr, o.hr) AS BIGINT) AS hr, coalesce(i.n, 0) AS pickup_count,
  coalesce(o.n, 0) AS dropoff_count FROM i FULL JOIN o ON i.hr = o.hr""",
    "trip_answers": f"""WITH {NAMED}, route AS (SELECT Pickup_Zone AS zone, Dropoff_Zone AS other, count(*) AS n, avg(trip_distance) AS v
  FROM named GROUP BY 1, 2 HAVING count(*) > 5 ORDER BY v DESC, zone, other LIMIT 1),
five AS (SELECT Pickup_Zone AS zone, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, Pickup_Zone) AS place FROM named GROUP BY 1),
far AS (SELECT Pickup_Zone AS zone, Dropoff_Zone AS other, trip_distance AS v FROM named ORDER BY trip_distance DESC, event_id LIMIT 1),
ins AS (SELECT hour(pickup_ts) AS hr, Pickup_Zone AS zone, count(*) AS n FROM named WHERE pickup_ts IS NOT NULL GROUP BY 1, 2),
outs AS (SELECT hour(dropoff_ts) AS hr, Dropoff_Zone AS zone, count(*) AS n FROM named WHERE dropoff_ts IS NOT NULL GROUP BY 1, 2),
top_in AS (SELECT * FROM ins QUALIFY row_number() OVER (PARTITION BY hr ORDER BY n DESC, zone) = 1),
top_out AS (SELECT * FROM outs QUALIFY row_number() OVER (PARTITION BY hr ORDER BY n DESC, zone) = 1),
hi AS (SELECT hr, sum(n) AS n FROM ins GROUP BY 1), ho AS (SELECT hr, sum(n) AS n FROM outs GROUP BY 1),
every AS (
  SELECT 'most_expensive_route' AS question, NULL AS hr, zone, other, n, NULL AS other_n, v AS value FROM route
  UNION ALL SELECT 'busiest_zone', NULL, zone, NULL, n, NULL, NULL FROM five WHERE place = 1
  UNION ALL SELECT 'top5_zones', NULL, zone, NULL, n, NULL, NULL FROM five WHERE place <= 5
  UNION ALL SELECT 'top_zone_per_hour', hr, zone, NULL, n, NULL, NULL FROM top_in
  UNION ALL SELECT 'top_dropoff_zone_per_hour', hr, NULL, zone, n, NULL, NULL FROM top_out
  UNION ALL SELECT 'busiest_hours', coalesce(hi.hr, ho.hr), NULL, NULL, coalesce(hi.n, 0), coalesce(ho.n, 0), NULL FROM hi FULL JOIN ho ON hi.hr = ho.hr
  UNION ALL SELECT 'longest_trip', NULL, zone, other, NULL, NULL, v FROM far)
SELECT question, CAST(hr AS BIGINT) AS hr, zone, other, CAST(n AS BIGINT) AS n, CAST(other_n AS BIGINT) AS other_n, round(value, 8) AS value FROM every""",
    "tip_correlation": f"""WITH {FARES} """ + column_rows(
        "fares", TIP_PAIRS, "round(corr(tip_amount, {c}), 8) AS correlation"),
    "src_csv_roundtrip": f"""SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
  {r('c_acctbal')}, c_mktsegment FROM customer""",
    "wide_to_long": f"""WITH {GAPS}
SELECT CAST(date AS VARCHAR) AS "Date", {r('open_price', '"Open"')}, {r('high_price', '"High"')},
  {r('low_price', '"Low"')}, {r('close_price', '"Close"')}, volume AS "Volume", ticker FROM gaps""",
    "missing_keys": f"""WITH {BARS}
SELECT w AS ticker FROM (SELECT unnest(['S1', 'S2', 'S3', '^I4', '^I5', 'S9', '^I0']) AS w)
WHERE w NOT IN (SELECT ticker FROM bars)""",
    "union_by_name": f"""WITH {BARS}
SELECT ticker, {DAY}, {r('open_price')}, {r('high_price')}, {r('low_price')}, {r('close_price')},
  CASE WHEN ticker <> '^I5' THEN volume END AS volume FROM bars""",
    "normalize_bars": f"WITH {RAW} SELECT {BAR} FROM raw",
    "bars_range": f"""WITH {PRICES} SELECT {BAR} FROM prices
WHERE prices.date >= DATE '1998-01-01' AND prices.date < DATE '1999-01-01'""",
    "bars_range_stored": f"""WITH {PRICES} SELECT {BAR} FROM prices
WHERE prices.date >= DATE '1997-06-01' AND prices.date < DATE '1999-01-01' AND ticker IN ('S1', '^I4')""",
    "bars_in_list": f"WITH {PRICES} SELECT {BAR} FROM prices WHERE ticker IN ('S1', '^I4', 'S9')",
    "clean_bars": f"WITH {PRICES} SELECT {BAR} FROM prices",
    "clean_report": f"""WITH {PRICES}
SELECT a.n AS rows_before, b.n AS rows_after, a.n - b.n AS rows_dropped
FROM (SELECT count(*) AS n FROM raw) a, (SELECT count(*) AS n FROM prices) b""",
    "null_counts": f"WITH {GAPS} " + column_rows("gaps", list(BAR_TYPES), "count(*) - count({c}) AS missing"),
    "zero_audit": f"""WITH {RAW} SELECT count(*) FILTER (volume = 0) AS zero_volume,
  count(*) FILTER (volume = 0 AND close_price = 0) AS zero_volume_and_price FROM raw""",
    "zero_audit_by_key": f"""WITH {RAW}
SELECT ticker, count(*) AS zero_volume FROM raw WHERE volume = 0 GROUP BY 1""",
    "describe_by_key": f"""WITH {PRICES}
SELECT ticker, count(*) AS count, {r('avg(close_price)', 'mean')}, {r('stddev_samp(close_price)', 'std')},
  {r('min(close_price)', 'min')}, {r('quantile_cont(close_price, 0.25)', 'p25')},
  {r('quantile_cont(close_price, 0.5)', 'p50')}, {r('quantile_cont(close_price, 0.75)', 'p75')},
  {r('max(close_price)', 'max')} FROM prices GROUP BY 1""",
    "table_profile": f"WITH {GAPS} " + " UNION ALL ".join(
        f"""SELECT count(*) AS rows, {len(BAR_TYPES)}::BIGINT AS columns, {i}::BIGINT AS position,
  '{c}' AS column, '{kind}' AS type, count({c}) AS present FROM gaps"""
        for i, (c, kind) in enumerate(BAR_TYPES.items())),
    "table_head": f"WITH {PRICES} SELECT {BAR} FROM prices ORDER BY prices.date, ticker LIMIT 10",
    "last_n": f"""WITH RECURSIVE {FEATURES} SELECT ticker, {DAY}, {r('close_price')} FROM feats
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY feats.date DESC) <= 200""",
    "daily_return": f"""WITH {RETURNS}
SELECT ticker, {DAY}, {r('close_price')}, {r('ret', 'Daily_Return')} FROM returns""",
    "lags": f"""WITH {PRICES}, l AS (
  SELECT ticker, date, close_price, lag(close_price, 1) OVER {W} AS a, lag(close_price, 2) OVER {W} AS b,
         lag(close_price, 5) OVER {W} AS c FROM prices)
SELECT ticker, {DAY}, {r('close_price')}, {r('a', 'Lag_1')}, {r('b', 'Lag_2')}, {r('c', 'Lag_5')},
  {r('close_price - a', 'Price_Change')} FROM l""",
    "target_label": f"""WITH {PRICES}, l AS (
  SELECT ticker, date, close_price, lead(close_price) OVER {W} AS nxt FROM prices)
SELECT ticker, {DAY}, {r('close_price')}, {r('nxt', 'Next_Close')},
  CAST(CASE WHEN nxt > l.close_price THEN 1 ELSE 0 END AS BIGINT) AS Target FROM l""",
    "sma": f"""WITH {PRICES}, s AS (
  SELECT ticker, date, close_price, {full('avg', 10)} AS a, {full('avg', 20)} AS b,
         {full('avg', 50)} AS c, {full('avg', 200)} AS d FROM prices)
SELECT ticker, {DAY}, {r('close_price')}, {r('a', 'SMA_10')}, {r('b', 'SMA_20')}, {r('c', 'SMA_50')},
  {r('d', 'SMA_200')} FROM s""",
    "bollinger": f"""WITH {PRICES}, s AS (
  SELECT ticker, date, close_price, {full('avg', 20)} AS m, {full('stddev_samp', 20)} AS sd FROM prices)
SELECT ticker, {DAY}, {r('close_price')}, {r('m', 'Bollinger_Middle')}, {r('sd', 'Bollinger_Std')},
  {r('m + 2 * sd', 'Bollinger_Upper')}, {r('m - 2 * sd', 'Bollinger_Lower')} FROM s""",
    "rsi": f"""WITH {PRICES}, {rsi('prices', 's')}
SELECT ticker, {DAY}, {r('close_price')}, {r('RSI')} FROM s""",
    "ema": f"""WITH RECURSIVE {PRICES}, {means('prices', 's')}
SELECT ticker, {DAY}, {r('close_price')}, {r('e9', 'EMA_9')}, {r('e12', 'EMA_12')}, {r('e26', 'EMA_26')} FROM s""",
    "macd": f"""WITH RECURSIVE {PRICES}, {means('prices', 's')}
SELECT ticker, {DAY}, {r('close_price')}, {r('macd', 'MACD')}, {r('sig', 'MACD_Signal')} FROM s""",
    "sma_cross": f"""WITH {PRICES}, s AS (
  SELECT ticker, date, close_price, {full('avg', 50)} - {full('avg', 200)} AS diff FROM prices),
c AS (
  SELECT *, coalesce(sign(diff), 0) AS side, lag(coalesce(sign(diff), 0)) OVER {W} AS was FROM s)
SELECT ticker, {DAY}, {r('close_price')}, CASE WHEN side > 0 THEN 'golden' ELSE 'death' END AS event
FROM c WHERE side <> 0 AND side IS DISTINCT FROM was""",
    "normalized_close": f"""WITH RECURSIVE {FEATURES}, period AS (SELECT * FROM feats WHERE date >= DATE '2001-01-01')
SELECT ticker, {DAY}, {r('close_price')},
  {r('close_price / first_value(close_price) OVER (PARTITION BY ticker ORDER BY period.date) * 100000', 'normalized')}
FROM period""",
    "filled_close": f"""WITH {GAPS}, f AS (
  SELECT ticker, date, close_price,
         last_value(close_price IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried,
         first_value(close_price IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_known FROM gaps)
SELECT ticker, {DAY}, {r('close_price')}, {r('carried')}, {r('next_known')} FROM f""",
    "features": f"""WITH RECURSIVE {FEATURES}
SELECT {BAR}, {r('Daily_Return')}, {r('SMA_10')}, {r('SMA_50')}, {r('RSI')}, {r('EMA_12')}, {r('EMA_26')},
  {r('MACD')}, {r('MACD_Signal')}, {r('Bollinger_Middle')}, {r('Bollinger_Std')}, {r('Bollinger_Upper')},
  {r('Bollinger_Lower')}, {r('Lag_1')}, {r('Lag_2')}, {r('Lag_5')}, {r('Price_Change')},
  CAST(Month AS BIGINT) AS Month, CAST(DayOfWeek AS BIGINT) AS DayOfWeek, {r('Next_Close')},
  CAST(Target AS BIGINT) AS Target FROM feats""",
    "slice_indicators": f"""WITH RECURSIVE {SLICE}
SELECT ticker, {DAY}, {r('close_price')}, {r('SMA_50')}, {r('RSI')}, {r('MACD')}, {r('Signal_Line')},
  {r('MACD_Signal')} FROM slice""",
    "split_counts": f"""WITH RECURSIVE {FEATURES}
SELECT CASE WHEN date < DATE '1999-01-01' THEN 'train' WHEN date < DATE '2000-01-01' THEN 'test'
            WHEN date < DATE '2001-01-01' THEN 'validation' ELSE 'prediction' END AS split,
       count(*) AS n FROM feats GROUP BY 1""",
    "pivot_close": f"""WITH {PRICES}
SELECT CAST(date AS VARCHAR) AS date, """ + ", ".join(
        f"round(avg(close_price) FILTER (ticker = '{k}'), 8) AS \"{k}\"" for k in ["S1", "S2", "S3", "^I4", "^I5"])
    + " FROM prices GROUP BY prices.date",
    "corr_ffill": f"""WITH {PRICES}, grid AS (
  SELECT d.date, k.ticker, last_value(p.close_price IGNORE NULLS) OVER (PARTITION BY k.ticker ORDER BY d.date
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price
  FROM (SELECT DISTINCT date FROM prices) d CROSS JOIN keys k
  LEFT JOIN prices p ON p.date = d.date AND p.ticker = k.ticker),
ret AS (SELECT ticker, date, price / lag(price) OVER {W} - 1 AS ret FROM grid)
{pairs("ret")}""",
    "return_corr": f"""WITH RECURSIVE {FEATURES}, listed AS (SELECT ticker, date, Daily_Return AS ret FROM feats)
{pairs("listed")}""",
    "return_kde": f"""WITH {RETURNS}, h AS (
  SELECT ticker, stddev_samp(ret) * pow(count(ret), -0.2) AS h FROM returns GROUP BY 1),
grid AS (SELECT range AS point, -0.1::DOUBLE + 0.2::DOUBLE * range / 40 AS x FROM range(41))
SELECT r.ticker, CAST(point AS BIGINT) AS point, round(x, 8) AS x,
  round(avg(exp(-0.5 * pow((x - ret) / h, 2))) / (any_value(h) * sqrt(2 * pi())), 8) AS density
FROM returns r JOIN h ON h.ticker = r.ticker CROSS JOIN grid
WHERE ret IS NOT NULL GROUP BY r.ticker, point, x""",
    "confusion": f"""WITH {LABELS}
SELECT CAST(l AS BIGINT) AS label, CAST(q AS BIGINT) AS pred, count(labels_t.label) AS n
FROM (SELECT unnest([0, 1]) AS l) CROSS JOIN (SELECT unnest([0, 1]) AS q)
LEFT JOIN labels_t ON labels_t.label = l AND labels_t.pred = q GROUP BY 1, 2""",
    "class_report": f"""WITH {CELLS}, lines AS (
  SELECT '0' AS class, p0 AS p, r0 AS r, f0 AS f, s0 AS s FROM rates
  UNION ALL SELECT '1', p1, r1, f1, s1 FROM rates
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 FROM rates
  UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1), (r0 * s0 + r1 * s1) / (s0 + s1),
                   (f0 * s0 + f1 * s1) / (s0 + s1), s0 + s1 FROM rates
  UNION ALL SELECT 'accuracy', acc, acc, acc, s0 + s1 FROM rates)
SELECT class, {r('p', 'precision')}, {r('r', 'recall')}, {r('f', 'f1')}, CAST(s AS BIGINT) AS support FROM lines""",
    "roc_curve": f"""WITH {ROC}
SELECT {r('score', 'threshold')}, {r('fp::DOUBLE / n_all', 'fpr')}, {r('tp::DOUBLE / p_all', 'tpr')} FROM running""",
    "roc_auc": f"""WITH {LABELS}, ranked AS (
  SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS mid FROM labels_t)
SELECT round((sum(mid) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2)
  / (sum(label)::DOUBLE * sum(1 - label)), 8) AS auc FROM ranked""",
    "signal_hybrid": f"WITH RECURSIVE {HYBRID} SELECT {SIGNAL} FROM placed",
    "signal_trend": f"WITH RECURSIVE {SCORED}, " + held(
        "scored", "placed", "close_price > SMA_50 OR p > 0.45", "p < 0.40") + f" SELECT {SIGNAL} FROM placed",
    "signal_macd": f"WITH RECURSIVE {SCORED}, " + held(
        "scored", "placed", "MACD > Signal_Line AND p > 0.40", "MACD < Signal_Line OR RSI > 80")
    + f" SELECT {SIGNAL} FROM placed",
    "ledger_final": f"""WITH RECURSIVE {HYBRID}, {ledger('placed', 'valued')}
SELECT ticker, {r('arg_max(portfolio_value, date)', 'final_value')} FROM valued GROUP BY 1""",
    "ledger_curve": f"""WITH RECURSIVE {HYBRID}, {ledger('placed', 'valued')}
SELECT ticker, {DAY}, {r('portfolio_value')} FROM valued""",
    "buy_hold": f"""WITH RECURSIVE {FEATURES}, e AS (
  SELECT ticker, arg_min(open_price, date) AS o, arg_max(close_price, date) AS c FROM feats
  WHERE date >= DATE '2001-01-01' GROUP BY 1)
SELECT ticker, {r('o', 'first_open')}, {r('c', 'last_close')},
  round(CASE WHEN floor(100000 * 0.999::DOUBLE / o) * c = 0 THEN 1
             ELSE floor(100000 * 0.999::DOUBLE / o) * c END, 6) AS benchmark FROM e""",
    "best_by_category": f"""WITH RECURSIVE {RANKED}
SELECT category, ticker, {r('final_value')}, {r('benchmark')}, {r('score')} FROM best""",
    "goal_verdict": f"""WITH RECURSIVE {RANKED}
SELECT CASE WHEN s > 1.2 AND i > 1.2 THEN 'both passed' WHEN i > 1.2 THEN 'index passed'
            ELSE 'not passed' END AS verdict
FROM (SELECT max(score) FILTER (category = 'STOCKS') AS s, max(score) FILTER (category = 'INDICES') AS i FROM best)""",
    "hybrid_results": f"""WITH RECURSIVE {HYBRID}, {ledger('placed', 'valued')}
SELECT {DAY}, ticker, {r('close_price')}, CAST(Target AS BIGINT) AS Target,
  CAST(model_prediction AS BIGINT) AS model_prediction, CAST(strategy_action AS BIGINT) AS strategy_action,
  {r('portfolio_value')} FROM valued""",
    "holdout_rows": f"""WITH RECURSIVE {FEATURES}
SELECT ticker, {DAY}, CASE WHEN feats.date < DATE '2000-01-01' THEN 'test' WHEN feats.date < DATE '2001-01-01' THEN 'validation'
    ELSE 'prediction' END AS split, CAST(Target AS BIGINT) AS Target
FROM feats WHERE feats.date >= DATE '1999-01-01'""",
    "holdout_support": f"""WITH RECURSIVE {FEATURES}
SELECT CASE WHEN date < DATE '1999-01-01' THEN 'train' WHEN date < DATE '2000-01-01' THEN 'test'
    WHEN date < DATE '2001-01-01' THEN 'validation' ELSE 'prediction' END AS split,
  CAST(Target AS BIGINT) AS Target, count(*) AS n FROM feats GROUP BY 1, 2""",
    "results_table": f"""WITH RECURSIVE {PLACED}, {ledger('placed', 'valued')}
SELECT {DAY}, ticker, {r('close_price')}, CAST(Target AS BIGINT) AS Target,
  CAST(model_prediction AS BIGINT) AS model_prediction, CAST(strategy_action AS BIGINT) AS strategy_action,
  {r('portfolio_value')} FROM valued""",
}
