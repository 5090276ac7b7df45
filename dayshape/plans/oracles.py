"""The same results in ANSI SQL over the same Parquet tables, for side-by-side checks."""

from __future__ import annotations

from dayshape.plans import bindings as b


def r(x: str, places: int = 6) -> str:
    """Half-up rounding through a decimal, as the operators round."""
    return f"CAST(round(CAST({x} AS DECIMAL(38, {places + 4})), {places}) AS DOUBLE)"


EVENTS = """
ev AS (
  SELECT event_id, user_id, CAST(year(ts) AS BIGINT) AS year, CAST(hour(ts) AS BIGINT) AS hour,
         CAST(ts AS DATE) AS day, value, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events),
e12 AS (SELECT * FROM ev WHERE hour BETWEEN 7 AND 18)"""

PLACES = """
places AS (
  SELECT c_custkey, c_name, c_mktsegment, c_acctbal, n_name, CAST(n_nationkey AS DOUBLE) AS lon,
         CAST(r_regionkey AS BIGINT) AS r_regionkey, r_name
  FROM customer JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey)"""

MAJOR = "CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 1 ELSE 0 END"

HOURLY = f"""{EVENTS}, {PLACES},
h AS (
  SELECT ev.*, c_name, c_mktsegment, c_acctbal AS lat, lon, n_name, r_regionkey, r_name
  FROM ev JOIN places ON c_custkey = user_id),
h12 AS (SELECT *, CAST({MAJOR} AS BIGINT) AS is_major FROM h WHERE hour BETWEEN 7 AND 18)"""

RAW = f"""{HOURLY},
raw AS (
  SELECT event_id, user_id, year, hour, k, c_mktsegment, n_name, r_name, lon,
         CASE WHEN event_id % 101 = 0 THEN 'n/a' ELSE strftime(day, '%Y-%m-%d') END AS day,
         CASE event_id % 3 WHEN 0 THEN ' ' || event_type || '  ' WHEN 1 THEN upper(event_type)
              ELSE event_type END AS event_type,
         CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN -value - 1
              ELSE value END AS value,
         CASE WHEN user_id % 83 <> 0 THEN lat END AS lat
  FROM h)"""

PROFILE = f"""
g AS (
  SELECT user_id, hour, count(*) AS observations,
         {r('avg(value)', 2)} AS mean_measure,
         {r('quantile_disc(value, 0.5)', 2)} AS median_measure,
         {r('coalesce(stddev_samp(value), 0)', 2)} AS sd_measure,
         {r('avg(k)', 2)} AS mean_k
  FROM e12 GROUP BY user_id, hour),
p AS (
  SELECT *, CASE WHEN avg(mean_measure) OVER (PARTITION BY user_id) > 0
    THEN {r('mean_measure / avg(mean_measure) OVER (PARTITION BY user_id)', 4)} END AS peak_index
  FROM g)"""

# Attributes of a user do not vary over its events, so any value is the earliest one.
DIMS = f"""
d AS (
  SELECT user_id, any_value(r_regionkey) AS r_regionkey, any_value(n_name) AS n_name,
         any_value(c_name) AS c_name, any_value(c_mktsegment) AS c_mktsegment,
         {r('any_value(lat)', 6)} AS lat, {r('any_value(lon)', 6)} AS lon,
         max(is_major) AS is_major, min(year) AS first_period, max(year) AS last_period
  FROM h12 GROUP BY user_id),
reg AS (
  SELECT r_regionkey, r_name, count(DISTINCT user_id) AS entities,
         count(DISTINCT n_name) AS authorities
  FROM h12 GROUP BY r_regionkey, r_name)"""

STAR = f"{HOURLY}, {PROFILE}, {DIMS}"

ORDERS = """
o AS (
  SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, o_totalprice,
         CAST(o_orderdate AS DATE) AS order_date, CAST(year(o_orderdate) AS BIGINT) AS year,
         CAST(month(o_orderdate) AS BIGINT) AS month
  FROM orders)"""

YEARLY = f"""{ORDERS}, {PLACES},
y AS (
  SELECT o.*, c_name, c_mktsegment, c_acctbal, lon, n_name, r_regionkey, r_name,
         CAST({MAJOR} AS BIGINT) AS is_major
  FROM o JOIN places ON c_custkey = o_custkey)"""

ANNUAL = f"""
af AS (SELECT o_custkey, year, {r('avg(o_totalprice)', 2)} AS flow FROM o GROUP BY o_custkey, year)"""

LINES = """
l AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
         l_tax, l_returnflag, l_linestatus, l_extendedprice * (1 - l_discount) AS net_price,
         l_extendedprice * l_discount AS discount_value,
         CAST(year(l_shipdate) AS BIGINT) AS year, CAST(month(l_shipdate) AS BIGINT) AS month,
         p_type, CAST(p_size AS BIGINT) AS p_size
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey)"""

ORPHANS = f"""{ORDERS},
x AS (
  SELECT o_orderkey, o_totalprice,
         CASE WHEN o_orderkey % 97 = 0 THEN -o_custkey - 1 ELSE o_custkey END AS o_custkey
  FROM o)"""


def history(train: str) -> str:
    return f"""
hist AS (
  SELECT o_custkey, {r('avg(o_totalprice)', 2)} AS hist_mean,
         {r('coalesce(stddev_samp(o_totalprice), 0)', 2)} AS hist_sd,
         count(DISTINCT year) AS hist_periods
  FROM {train} GROUP BY o_custkey),
dflt AS (SELECT avg(hist_mean) AS hist_mean, avg(hist_sd) AS hist_sd FROM hist)"""


def attached(block: str, columns: str = "b.*") -> str:
    return f"""
  SELECT {columns}, coalesce(hist.hist_mean, dflt.hist_mean) AS hist_mean,
         coalesce(hist.hist_sd, dflt.hist_sd) AS hist_sd,
         coalesce(hist_periods, 0) AS hist_periods
  FROM {block} b LEFT JOIN hist USING (o_custkey) CROSS JOIN dflt"""


SPLIT_WHERE = {
    "primary": ("year <= 1998", "year >= 2000"),
    "control": ("year <= 1996", "year BETWEEN 1997 AND 1998"),
}


def _forecast_ctes() -> str:
    parts = []
    for name, (train, test) in SPLIT_WHERE.items():
        parts.append(f"""
{name}_train AS (SELECT * FROM y WHERE {train}),
{name}_hist AS (
  SELECT o_custkey, {r('avg(o_totalprice)', 2)} AS hist_mean
  FROM {name}_train GROUP BY o_custkey),
{name}_dflt AS (SELECT avg(hist_mean) AS m FROM {name}_hist),
{name}_fit AS (
  SELECT regr_slope(o_totalprice, hist_mean) AS b1, regr_intercept(o_totalprice, hist_mean) AS b0,
         regr_slope(o_totalprice, month) AS c1, regr_intercept(o_totalprice, month) AS c0,
         regr_slope(o_totalprice / hist_mean, month) AS d1,
         regr_intercept(o_totalprice / hist_mean, month) AS d0,
         avg(o_totalprice) AS overall
  FROM {name}_train JOIN {name}_hist USING (o_custkey)),
{name}_test AS (
  SELECT y.*, coalesce(hist_mean, m) AS hist_mean
  FROM y LEFT JOIN {name}_hist USING (o_custkey) CROSS JOIN {name}_dflt WHERE {test})""")
    return ",".join(parts)


def _rows(split: str, model: str, forecast: str) -> str:
    return f"""
  SELECT '{split}' AS split, '{model}' AS model, o_custkey, month, c_mktsegment,
         o_totalprice AS actual, {forecast} AS prediction
  FROM {split}_test CROSS JOIN {split}_fit"""


NAIVE = " UNION ALL ".join(
    _rows(s, m, f)
    for s in SPLIT_WHERE
    for m, f in (("global_mean", "overall"), ("entity_history", "hist_mean"))
)
FITTED = " UNION ALL ".join(
    [
        _rows("primary", "linear on hist_mean", "b0 + b1 * hist_mean"),
        _rows("primary", "linear on month", "c0 + c1 * month"),
        _rows("primary", "relative line", "(d0 + d1 * month) * hist_mean"),
        _rows("control", "linear on hist_mean", "b0 + b1 * hist_mean"),
    ]
)

SCORES = """
m AS (
  SELECT split, model, count(*) AS n_rows, sqrt(avg(power(prediction - actual, 2))) AS rmse,
         avg(abs(prediction - actual)) AS mae,
         1 - avg(power(prediction - actual, 2)) / var_pop(actual) AS r2
  FROM f GROUP BY split, model),
s AS (
  SELECT *, max(CASE WHEN model = 'entity_history' THEN r2 END) OVER (PARTITION BY split) AS base
  FROM m)"""

NAIVE_CTES = f"WITH {YEARLY}, {_forecast_ctes()}, f AS ({NAIVE}), {SCORES}"
MODEL_CTES = f"WITH {YEARLY}, {_forecast_ctes()}, f AS ({NAIVE} UNION ALL {FITTED}), {SCORES}"
SCORE_COLUMNS = (
    f"split, model, n_rows, {r('rmse', 4)} AS rmse, {r('mae', 4)} AS mae, {r('r2', 4)} AS r2"
)

LINE_NUMERICS = ("month", "l_quantity", "l_discount", "l_tax", "p_size", "net_price")
MATRIX = ("month", "l_quantity", "l_discount", "l_tax", "p_size", "net_price", "l_extendedprice")


def _matrix_sql() -> str:
    cells = []
    for a in MATRIX:
        for c in MATRIX:
            value = "max(1.0::DOUBLE)" if a == c else r(f"corr({a}, {c})")
            cells.append(f"SELECT '{a}' AS \"left\", '{c}' AS \"right\", {value} AS r FROM known")
    return (
        f"WITH {LINES}, known AS (SELECT * REPLACE (CASE WHEN l_orderkey % 97 <> 0 THEN l_tax END "
        f"AS l_tax) FROM l), known2 AS (SELECT * FROM known WHERE l_tax IS NOT NULL) "
        + " UNION ALL ".join(cells).replace("FROM known", "FROM known2")
    )


def _corr_rows() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r(f'corr({c}, l_extendedprice)')} AS weight FROM l"
        for c in LINE_NUMERICS
    )


def _quality_rows(columns: tuple[str, ...], value: str, keep_rows: bool) -> str:
    rows = "count(*) AS n_rows, " if keep_rows else ""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {rows}count(*) FILTER (WHERE {c} IS NULL) AS {value} FROM raw"
        for c in columns
    )




def _null_rows() -> str:
    raw = "event_id user_id year hour k c_mktsegment n_name r_name lon day event_type value lat"
    return " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", count(*) AS n_rows, count(*) - count({c}) AS nulls FROM {t}"
        for t, columns in {**b.COLUMNS, "raw": raw}.items()
        for c in columns.split()
    )


def _bound_rows() -> str:
    quoted = ["'" + text.replace("'", "''") + "'" for text in b.HOSTILE]
    return " UNION ALL ".join(
        f"SELECT {q} AS id, count(*) AS n_rows FROM o WHERE CAST(o_custkey AS VARCHAR) = {q}"
        for q in quoted
    )


ORACLES: dict[str, str] = {
    # ---- sources and sinks
    "read_csv_named": f"""WITH {ORDERS} SELECT o_orderkey, o_orderpriority,
        CASE WHEN o_orderkey % 97 <> 0 THEN o_totalprice END AS o_totalprice, year FROM o""",
    "write_partitioned": f"""WITH {ORDERS}
        SELECT o_orderkey, o_custkey, o_totalprice, month, year FROM o""",
    "scan_pruned": f"""WITH {ORDERS} SELECT month, {r('avg(o_totalprice)', 4)} AS mean_price
        FROM o WHERE year >= 2000 GROUP BY month""",
    "write_tables": f"""WITH {HOURLY}, {DIMS} SELECT user_id, r_name, entities, authorities
        FROM d JOIN reg USING (r_regionkey)""",
    "build_star": f"""WITH {STAR}, {ORDERS}, {ANNUAL},
        fa AS (SELECT * FROM af WHERE year BETWEEN 1996 AND 2100
               AND o_custkey IN (SELECT user_id FROM d))
        SELECT 'dim_region' AS "table", count(*) AS n_rows, {r('sum(entities)', 2)} AS total,
            CAST(0 AS BIGINT) AS violations FROM reg
        UNION ALL SELECT 'dim_entity', count(*), {r('sum(lat)', 2)}, 0 FROM d
        UNION ALL SELECT 'fact_profile', count(*), {r('sum(peak_index)', 2)}, 0 FROM p
        UNION ALL SELECT 'fact_annual', count(*), {r('sum(flow)', 2)},
            count(*) FILTER (WHERE year NOT BETWEEN 2000 AND 2100) FROM fa""",
    "star_check": f"""WITH {HOURLY}, {ORDERS}, {ANNUAL},
        q AS (SELECT user_id, hour, r_regionkey, CASE WHEN r_regionkey <> 3 THEN r_name END AS r_name,
                  CASE WHEN user_id % 13 <> 0 THEN c_mktsegment END AS segment,
                  CASE WHEN user_id % 17 = 0 THEN 2 ELSE {MAJOR} END AS flag,
                  CASE WHEN user_id % 11 = 0 THEN -value ELSE value END AS v FROM h),
        d AS (SELECT user_id, any_value(r_regionkey) AS r_regionkey, any_value(segment) AS segment,
                  max(flag) AS flag FROM q GROUP BY user_id),
        pr AS (SELECT user_id, hour, count(*) AS n, {r('avg(v)', 2)} AS mean FROM q GROUP BY user_id, hour),
        pr2 AS (SELECT * FROM pr UNION ALL SELECT * FROM pr WHERE hour = 9),
        fa AS (SELECT o_custkey, year, CASE WHEN o_custkey % 19 = 0 THEN -flow ELSE flow END AS flow
               FROM af WHERE year BETWEEN 1990 AND 2100 AND o_custkey IN (SELECT user_id FROM d))
        SELECT 'dim_region' AS "table", 'key' AS rule, count(*) AS violations
            FROM (SELECT r_regionkey FROM q GROUP BY 1 HAVING count(DISTINCT r_name) > 1)
        UNION ALL SELECT 'dim_entity', 'key', count(*)
            FROM (SELECT user_id FROM d GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'fact_profile', 'key', count(*)
            FROM (SELECT user_id, hour FROM pr2 GROUP BY 1, 2 HAVING count(*) > 1)
        UNION ALL SELECT 'fact_annual', 'key', count(*)
            FROM (SELECT o_custkey, year FROM fa GROUP BY 1, 2 HAVING count(*) > 1)
        UNION ALL SELECT 'dim_entity', 'known r_regionkey', count(*) FROM d
            WHERE r_regionkey NOT IN (SELECT r_regionkey FROM region)
        UNION ALL SELECT 'fact_profile', 'known user_id', count(*) FROM pr2 WHERE user_id % 7 = 0
        UNION ALL SELECT 'fact_annual', 'known user_id', count(*) FROM fa WHERE o_custkey % 7 = 0
        UNION ALL SELECT 'dim_region', 'r_name not null', count(DISTINCT r_regionkey)
            FILTER (WHERE r_name IS NULL) FROM q
        UNION ALL SELECT 'dim_entity', 'c_mktsegment not null', count(*) FILTER (WHERE segment IS NULL) FROM d
        UNION ALL SELECT 'dim_entity', 'is_major not null', count(*) FILTER (WHERE flag IS NULL) FROM d
        UNION ALL SELECT 'dim_entity', 'flag in (0, 1)', count(*) FILTER (WHERE flag NOT IN (0, 1)) FROM d
        UNION ALL SELECT 'fact_profile', 'user_id not null', count(*) FILTER (WHERE user_id IS NULL) FROM pr
        UNION ALL SELECT 'fact_profile', 'hour not null', count(*) FILTER (WHERE hour IS NULL) FROM pr
        UNION ALL SELECT 'fact_profile', 'observations not null', count(*) FILTER (WHERE n IS NULL) FROM pr
        UNION ALL SELECT 'fact_profile', 'mean_measure not null', count(*) FILTER (WHERE mean IS NULL) FROM pr
        UNION ALL SELECT 'fact_profile', 'slot in window', count(*) FILTER (WHERE hour NOT BETWEEN 7 AND 18) FROM pr
        UNION ALL SELECT 'fact_profile', 'observations > 0', count(*) FILTER (WHERE n <= 0) FROM pr
        UNION ALL SELECT 'fact_profile', 'mean >= 0', count(*) FILTER (WHERE mean < 0) FROM pr
        UNION ALL SELECT 'fact_annual', 'user_id not null', count(*) FILTER (WHERE o_custkey IS NULL) FROM fa
        UNION ALL SELECT 'fact_annual', 'year not null', count(*) FILTER (WHERE year IS NULL) FROM fa
        UNION ALL SELECT 'fact_annual', 'year in range', count(*) FILTER (WHERE year NOT BETWEEN 2000 AND 2100) FROM fa
        UNION ALL SELECT 'fact_annual', 'flow >= 0', count(*) FILTER (WHERE flow < 0) FROM fa""",
    "load_report": f"""WITH {STAR}, {ORDERS}, {ANNUAL}, d2 AS (SELECT * FROM d WHERE user_id % 7 <> 0)
        SELECT 'profile rows dropped' AS step, count(*) AS n_rows FROM h12
            WHERE user_id NOT IN (SELECT user_id FROM d2)
        UNION ALL SELECT 'annual rows dropped', count(*) FROM af
            WHERE o_custkey NOT IN (SELECT user_id FROM d2)
        UNION ALL SELECT 'region keys repaired', count(*) FILTER (WHERE r_regionkey = 2) FROM d2""",
    "table_scale": " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS n_rows FROM {t}" for t in b.TABLES
    ),
    "prediction_sample": f"""WITH {LINES}, tr AS (SELECT * FROM l WHERE year <= 1998),
        hist AS (SELECT l_partkey, {r('avg(l_extendedprice)', 2)} AS hist_mean FROM tr GROUP BY l_partkey),
        f AS (
          SELECT l_partkey, month, p_type, l_extendedprice AS actual, unnest([
              {{'model': 'global_mean', 'prediction': (SELECT avg(l_extendedprice) FROM tr)}},
              {{'model': 'entity_history', 'prediction':
                coalesce(hist_mean, (SELECT avg(hist_mean) FROM hist))}}]) AS made
          FROM l LEFT JOIN hist USING (l_partkey) WHERE year >= 2000)
        SELECT 'primary' AS split, made.model AS model, l_partkey, month, p_type, actual,
            {r('made.prediction', 4)} AS prediction FROM f
        ORDER BY md5(made.model || '|' || l_partkey || '|' || month || '|' || CAST(round(actual * 100) AS BIGINT))
        LIMIT 20000""",
    "sql_slot_view": f"""WITH {EVENTS} SELECT hour, count(*) AS observations,
        {r('avg(value)', 1)} AS mean_measure, {r('avg(k)', 1)} AS mean_k FROM e12 GROUP BY hour""",
    # ---- projections, filters, predicates
    "normalise_code": f"""WITH {RAW} SELECT event_id, upper(trim(event_type)) AS event_type
        FROM raw""",
    "slot_window": f"WITH {EVENTS} SELECT event_id, user_id, hour, value FROM e12",
    "require_measure": f"WITH {RAW} SELECT event_id, value FROM raw WHERE value >= 0",
    "require_present": f"""WITH {YEARLY} SELECT o_orderkey, c_acctbal, lon FROM y
        WHERE o_custkey % 83 <> 0 AND o_orderkey % 97 <> 0
          AND c_acctbal IS NOT NULL AND lon IS NOT NULL""",
    "class_flag": f"WITH {YEARLY} SELECT o_orderkey, c_mktsegment, is_major FROM y",
    "safe_date": f"""WITH {ORDERS}, t AS (SELECT o_orderkey,
            CASE WHEN o_orderkey % 101 = 0 THEN '1999-02-30' WHEN o_orderkey % 103 = 0
                 THEN 'unknown' ELSE strftime(order_date, '%Y-%m-%d') END AS text FROM o)
        SELECT o_orderkey, TRY_CAST(text AS DATE) AS order_date FROM t
        WHERE TRY_CAST(text AS DATE) IS NOT NULL""",
    "calendar_features": f"""WITH {EVENTS} SELECT event_id, dayname(day) AS day_of_week,
        CAST(month(day) AS BIGINT) AS month,
        CAST(CASE WHEN dayofweek(day) IN (0, 6) THEN 1 ELSE 0 END AS BIGINT) AS is_weekend
        FROM ev""",
    "non_component_share": f"""WITH {LINES}, t AS (SELECT l_orderkey, l_linenumber, l_partkey,
            CASE WHEN l_orderkey % 89 = 0 THEN 0.0::DOUBLE ELSE l_extendedprice END AS total,
            CASE WHEN l_orderkey % 97 <> 0 THEN net_price END AS part FROM l)
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey,
            CASE WHEN total > 0 THEN {r('(total - coalesce(part, 0)) / total', 4)} END
            AS non_component_share FROM t""",
    "clean_fact": f"""WITH {RAW}, t AS (SELECT *, TRY_CAST(day AS DATE) AS dt FROM raw)
        SELECT event_id, user_id, year, hour, dt AS day, value,
            upper(trim(event_type)) AS event_type, k, c_mktsegment, n_name, r_name, lat, lon,
            CAST({MAJOR} AS BIGINT) AS is_major, dayname(dt) AS day_of_week,
            CAST(month(dt) AS BIGINT) AS month,
            CAST(CASE WHEN dayofweek(dt) IN (0, 6) THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
            CASE WHEN value > 0 THEN {r('(value - coalesce(k, 0)) / value', 4)} END
            AS non_component_share
        FROM t WHERE hour BETWEEN 7 AND 18 AND value >= 0 AND lat IS NOT NULL
            AND lon IS NOT NULL AND dt IS NOT NULL""",
    "cleaning_losses": f"""WITH {RAW}, t AS (SELECT CASE
            WHEN NOT hour BETWEEN 7 AND 18 THEN 'slot'
            WHEN value IS NULL OR value < 0 THEN 'measure'
            WHEN lat IS NULL OR lon IS NULL THEN 'required'
            WHEN TRY_CAST(day AS DATE) IS NULL THEN 'date' END AS broken FROM raw)
        SELECT count(*) AS rows_in, count(*) FILTER (WHERE broken = 'slot') AS lost_slot,
            count(*) FILTER (WHERE broken = 'measure') AS lost_measure,
            count(*) FILTER (WHERE broken = 'required') AS lost_required,
            count(*) FILTER (WHERE broken = 'date') AS lost_date,
            count(*) FILTER (WHERE broken IS NULL) AS rows_out FROM t""",
    "period_split": f"WITH {ORDERS} "
    + " UNION ALL ".join(
        f"SELECT '{s}' AS split, '{n}' AS block, year, count(*) AS n_rows FROM o WHERE {w} "
        "GROUP BY year"
        for s, pair in SPLIT_WHERE.items()
        for n, w in zip(("train", "test"), pair)
    ),
    "domain_check": """SELECT event_type AS value, count(*) AS n_rows FROM events
        WHERE event_type NOT IN ('click', 'view', 'error') GROUP BY event_type""",
    # ---- joins
    "attach_history": f"""WITH {ORDERS}, tr AS (SELECT * FROM o WHERE year <= 1998),
        te AS (SELECT * FROM o WHERE year >= 2000), {history('tr')}
        SELECT o_orderkey, o_custkey, {r('hist_mean', 4)} AS hist_mean,
            {r('hist_sd', 4)} AS hist_sd, hist_periods FROM ({attached('te')})""",
    "entity_profile": f"""WITH {STAR} SELECT hour, observations,
        {r('mean_measure', 1)} AS mean_measure, {r('peak_index', 3)} AS peak_index,
        n_name, c_mktsegment FROM p JOIN d USING (user_id) WHERE user_id = 7""",
    "entity_peak_map": f"""WITH {STAR}, k AS (SELECT user_id, max(peak_index) AS max_peak_index
            FROM p GROUP BY user_id HAVING sum(observations) >= 24)
        SELECT user_id, lat, lon, max_peak_index, is_major FROM k JOIN d USING (user_id)
        WHERE user_id % 7 <> 0 AND max_peak_index IS NOT NULL""",
    "region_star": f"""WITH {STAR} SELECT user_id, hour, mean_measure, peak_index, c_mktsegment,
        r_name FROM p JOIN d USING (user_id) JOIN reg USING (r_regionkey)""",
    "repair_fk": f"""WITH {ORPHANS} SELECT o_orderkey,
        CASE WHEN o_custkey IN (SELECT c_custkey FROM customer) THEN o_custkey END AS o_custkey
        FROM x""",
    "keep_known": f"""WITH {ORPHANS}, t AS (
            SELECT *, o_custkey IN (SELECT c_custkey FROM customer) AS known FROM x)
        SELECT count(*) FILTER (WHERE known) AS kept_rows,
            {r('sum(o_totalprice) FILTER (WHERE known)', 2)} AS kept_sum,
            count(*) FILTER (WHERE NOT known) AS dropped_rows FROM t""",
    "annual_fact": f"""WITH {ORDERS}, {ANNUAL} SELECT o_custkey, year, flow FROM af
        WHERE year BETWEEN 1996 AND 2000 AND o_custkey IN (SELECT c_custkey FROM customer)""",
    "align_models": f"""{MODEL_CTES} SELECT model,
        {r("max((r2 - base) / (1 - base)) FILTER (WHERE split = 'primary')")} AS "primary",
        {r("max((r2 - base) / (1 - base)) FILTER (WHERE split = 'control')")} AS control
        FROM s GROUP BY model""",
    # ---- aggregations
    "dedupe_by_key": """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey,
            l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey,
            l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) AS place FROM lineitem)
        WHERE place = 1""",
    "slot_profile": f"WITH {EVENTS}, {PROFILE} SELECT * FROM g",
    "entity_peak": f"""WITH {EVENTS}, {PROFILE} SELECT user_id, max(peak_index) AS max_peak_index,
        CAST(sum(observations) AS BIGINT) AS total_observations FROM p GROUP BY user_id
        HAVING sum(observations) >= 24""",
    "entity_dim": f"""WITH {YEARLY}, t AS (SELECT *,
            CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS pr FROM y)
        SELECT o_custkey, any_value(r_regionkey) AS r_regionkey, any_value(n_name) AS n_name,
            any_value(c_name) AS c_name, any_value(c_mktsegment) AS c_mktsegment,
            first(pr ORDER BY order_date, pr) FILTER (WHERE pr IS NOT NULL) AS o_orderpriority,
            {r('any_value(c_acctbal)')} AS c_acctbal, {r('any_value(lon)')} AS lon,
            max(is_major) AS is_major, min(year) AS first_period, max(year) AS last_period
        FROM t GROUP BY o_custkey""",
    "region_dim": f"WITH {HOURLY}, {DIMS} SELECT * FROM reg",
    "slot_summary": f"""WITH {EVENTS} SELECT hour, count(*) AS observations,
        {r('avg(value)', 1)} AS mean_measure, {r('avg(k)', 1)} AS mean_k FROM e12 GROUP BY hour""",
    "class_peak": f"""WITH {STAR} SELECT c_mktsegment, hour, count(*) AS links,
        {r('avg(peak_index)', 4)} AS mean_peak_index, {r('avg(mean_measure)', 1)} AS mean_measure
        FROM p JOIN d USING (user_id) WHERE observations >= 5 GROUP BY c_mktsegment, hour""",
    "annual_trend": f"""WITH {ORDERS}, {ANNUAL} SELECT year, count(*) AS links,
        {r('avg(flow)', 1)} AS mean_flow FROM af
        WHERE year BETWEEN 1996 AND 2000 AND o_custkey % 11 <> 0 GROUP BY year""",
    "region_summary": f"""WITH {STAR} SELECT r_name, count(DISTINCT user_id) AS entities,
        {r('avg(mean_measure)', 1)} AS mean_measure, {r('max(peak_index)', 3)} AS sharpest_peak_index
        FROM p JOIN d USING (user_id) JOIN reg USING (r_regionkey) GROUP BY r_name""",
    "slot_distribution": f"""WITH {EVENTS} SELECT hour, count(*) AS observations,
        {r('avg(value)')} AS mean_measure, {r('quantile_disc(value, 0.5)')} AS median_measure,
        {r('quantile_disc(value, 0.9)')} AS p90_measure FROM e12 GROUP BY hour""",
    "peak_trough": f"""WITH {EVENTS}, t AS (SELECT hour, avg(value) AS m FROM e12 GROUP BY hour)
        SELECT arg_max(hour, m) AS peak_slot, {r('max(m)')} AS peak_mean,
            arg_min(hour, m) AS trough_slot, {r('min(m)')} AS trough_mean,
            {r('max(m) / min(m)')} AS peak_trough_ratio FROM t""",
    "period_break": f"""WITH {ORDERS} SELECT year, count(*) AS observations,
        {r('avg(o_totalprice)', 4)} AS mean_measure FROM o GROUP BY year""",
    "moments": f"""WITH {EVENTS}, t AS (SELECT count(*) AS n, avg(value) AS a FROM e12)
        SELECT {r('avg(value)', 2)} AS mean, {r('quantile_disc(value, 0.5)', 2)} AS median,
            {r('stddev_samp(value)', 2)} AS sd,
            {r('avg(power(value - a, 3)) / power(var_pop(value), 1.5)', 3)} AS skewness,
            {r('kurtosis_pop(value)', 3)} AS kurtosis, {r('min(value)')} AS min,
            {r('max(value)')} AS max FROM e12 CROSS JOIN t""",
    "histogram": f"""WITH {EVENTS} SELECT CAST(floor(value / 10) * 10 AS BIGINT) AS bin,
        count(*) AS n_rows FROM e12 GROUP BY 1""",
    "corr_matrix": _matrix_sql(),
    "corr_with_measure": f"""WITH {LINES}
        SELECT feature AS "column", weight AS r FROM ({_corr_rows()})""",
    "quality_profile": f"WITH {RAW} " + _null_rows(),
    "missing_by_class": f"""WITH {YEARLY}, t AS (SELECT c_mktsegment,
            NOT (is_major = 1 OR o_orderkey % 5 = 0) AS absent FROM y)
        SELECT c_mktsegment, count(*) AS n_rows, count(*) FILTER (WHERE absent) AS n_null,
            {r('100 * avg(CAST(absent AS INT))', 1)} AS pct_null FROM t GROUP BY c_mktsegment""",
    "component_identity": f"""WITH {LINES}, t AS (SELECT abs(net_price + CASE
            WHEN l_orderkey % 97 <> 0 THEN discount_value ELSE 0 END - l_extendedprice) <= 1e-6
            AS holds FROM l)
        SELECT count(*) AS n_rows, count(*) FILTER (WHERE holds) AS n_exact,
            {r('count(*) FILTER (WHERE holds) / count(*)')} AS share FROM t""",
    "cardinality": f"""WITH {HOURLY}
        SELECT 'year' AS "column", count(DISTINCT year) AS n_distinct,
            CAST(NULL AS BIGINT) AS estimate_close FROM h12
        UNION ALL SELECT 'hour', count(DISTINCT hour), 1 FROM h12
        UNION ALL SELECT 'r_name', count(DISTINCT r_name), NULL FROM h12
        UNION ALL SELECT 'event_type', count(DISTINCT event_type), NULL FROM h12
        UNION ALL SELECT 'user_id', count(DISTINCT user_id), 1 FROM h12""",
    "kept_quantiles": f"""WITH {EVENTS} SELECT hour, CAST(share AS DOUBLE) AS share, 1::BIGINT AS near
        FROM (SELECT DISTINCT hour FROM e12) CROSS JOIN
            (SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.9, 0.99]) AS share)""",
    "kept_distinct": f"""WITH {HOURLY}
        SELECT 'user_id' AS "column", count(DISTINCT user_id) AS n_distinct, 1::BIGINT AS same_merged,
            1::BIGINT AS near FROM h12
        UNION ALL SELECT 'hour', count(DISTINCT hour), 1, 1 FROM h12
        UNION ALL SELECT 'n_name', count(DISTINCT n_name), 1, 1 FROM h12""",
    "iqr_outliers": f"""WITH {EVENTS}, q AS (SELECT quantile_disc(value, 0.25) AS q1,
            quantile_disc(value, 0.75) AS q3 FROM e12),
        t AS (SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM q)
        SELECT {r('any_value(q1)')} AS q1, {r('any_value(q3)')} AS q3, {r('any_value(low)')} AS low,
            {r('any_value(high)')} AS high, count(*) AS n_rows,
            count(*) FILTER (WHERE value < low OR value > high) AS outliers,
            {r('count(*) FILTER (WHERE value < low OR value > high) / count(*)')} AS share
        FROM e12 CROSS JOIN t""",
    "mean_index_by_slot": f"""WITH {EVENTS}, {PROFILE} SELECT hour,
        {r('avg(peak_index)', 3)} AS mean_peak_index FROM p GROUP BY hour""",
    "dead_entities": f"""WITH {EVENTS} SELECT count(*) AS dead_entities FROM (
        SELECT user_id FROM e12 GROUP BY user_id
        HAVING sum(CASE WHEN user_id % 10 = 3 THEN 0 ELSE value END) <= 0)""",
    "entity_history": f"""WITH {ORDERS}, tr AS (SELECT * FROM o WHERE year <= 1998),
        {history('tr')} SELECT * FROM hist""",
    "class_pivot": f"""WITH {STAR}, t AS (SELECT c_mktsegment, hour,
            {r('avg(peak_index)', 4)} AS i FROM p JOIN d USING (user_id) WHERE observations >= 5
            GROUP BY c_mktsegment, hour)
        SELECT hour, """
    + ", ".join(
        f"max(i) FILTER (WHERE c_mktsegment = '{s}') AS \"{s}\""
        for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    )
    + " FROM t GROUP BY hour",
    "clip_at_quantile": f"""WITH {EVENTS}, {PROFILE}, k AS (
            SELECT user_id, max(peak_index) AS max_peak_index FROM p GROUP BY user_id
            HAVING sum(observations) >= 24),
        c AS (SELECT quantile_cont(max_peak_index, 0.99) AS cap FROM k)
        SELECT user_id, max_peak_index, {r('least(max_peak_index, cap)')} AS clipped
        FROM k CROSS JOIN c""",
    "latest_period": f"""WITH {EVENTS}, {ORDERS}, {ANNUAL},
        t AS (SELECT year, avg(flow) AS m FROM af GROUP BY year)
        SELECT max(year) AS latest_period, {r('arg_max(m, year)', 1)} AS latest_mean_flow,
            (SELECT count(DISTINCT user_id) FROM e12) AS entities FROM t""",
    # ---- windows
    "peak_index": f"WITH {EVENTS}, {PROFILE} SELECT * FROM p",
    "peak_index_exact": f"""WITH {EVENTS}, t AS (SELECT user_id, hour, count(*) AS observations,
            avg(value) AS m FROM e12 GROUP BY user_id, hour)
        SELECT user_id, hour, observations, {r('m')} AS mean_measure,
            {r('m / avg(m) OVER (PARTITION BY user_id)')} AS peak_index FROM t""",
    "index_by_class": f"""WITH {HOURLY}, t AS (SELECT c_mktsegment, hour, count(*) AS observations,
            avg(value) AS m FROM h12 GROUP BY c_mktsegment, hour)
        SELECT c_mktsegment, hour, observations, {r('m')} AS mean_measure,
            {r('m / avg(m) OVER (PARTITION BY c_mktsegment)')} AS peak_index FROM t""",
    "index_by_daytype": f"""WITH {EVENTS}, t AS (SELECT
            CAST(CASE WHEN dayofweek(day) IN (0, 6) THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
            hour, count(*) AS observations, avg(value) AS m FROM e12 GROUP BY 1, 2)
        SELECT is_weekend, hour, observations, {r('m')} AS mean_measure,
            {r('m / avg(m) OVER (PARTITION BY is_weekend)')} AS peak_index FROM t""",
    "region_sharpness": f"""WITH {HOURLY}, t AS (SELECT r_name, hour, avg(value) AS m
            FROM h12 GROUP BY r_name, hour),
        u AS (SELECT *, avg(m) OVER (PARTITION BY r_name) AS level FROM t)
        SELECT r_name, {r('any_value(level)', 1)} AS mean_level,
            {r('max(m / level)', 3)} AS peak_sharpness FROM u GROUP BY r_name""",
    "base_index": f"""WITH {LINES}, t AS (SELECT year, avg(net_price) AS a,
            avg(discount_value) AS b FROM l GROUP BY year)
        SELECT year, {r('100 * a / first_value(a) OVER (ORDER BY year)')} AS index_net_price,
            {r('100 * b / first_value(b) OVER (ORDER BY year)')} AS index_discount_value FROM t""",
    "model_rank": f"""{MODEL_CTES} SELECT split, model, {r('r2')} AS r2,
        row_number() OVER (PARTITION BY split ORDER BY r2 DESC, model) AS place FROM m""",
    # ---- top-k
    "sharpest": f"""WITH {STAR} SELECT c_name, c_mktsegment, n_name, hour AS peak_slot,
        {r('peak_index', 3)} AS peak_index, {r('mean_measure', 1)} AS peak_measure, observations
        FROM (SELECT * FROM p JOIN d USING (user_id) WHERE observations >= 5
              ORDER BY peak_index DESC NULLS LAST, user_id, hour LIMIT 10)""",
    "sharpest_named": f"""WITH {STAR} SELECT n_name, c_mktsegment, hour AS peak_slot,
        {r('peak_index', 3)} AS peak_index, {r('mean_measure', 1)} AS peak_measure
        FROM (SELECT * FROM p JOIN d USING (user_id) WHERE observations >= 6
              ORDER BY peak_index DESC NULLS LAST, user_id, hour LIMIT 15)""",
    "top_features": f"""WITH {LINES} SELECT feature, weight FROM ({_corr_rows()})
        ORDER BY abs(weight) DESC, feature LIMIT 15""",
    # ---- constraints and bound parameters
    "pk_violations": """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
        count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "fk_violations": f"""WITH {ORPHANS} SELECT o_custkey AS value, count(*) AS n_rows FROM x
        WHERE o_orderkey % 89 <> 0 AND o_custkey NOT IN (SELECT c_custkey FROM customer)
        GROUP BY o_custkey""",
    "check_violations": f"""WITH {EVENTS}, g AS (SELECT user_id, hour, count(*) AS n,
            {r('avg(value)', 2)} AS mean FROM ev GROUP BY user_id, hour)
        SELECT 'flag in (0, 1)' AS rule, count(*) FILTER (WHERE user_id % 3 NOT IN (0, 1))
            AS violations FROM g
        UNION ALL SELECT 'slot in window', count(*) FILTER (WHERE hour NOT BETWEEN 7 AND 18) FROM g
        UNION ALL SELECT 'observations > 0', count(*) FILTER (WHERE NOT n - 1 > 0) FROM g
        UNION ALL SELECT 'mean >= 0',
            count(*) FILTER (WHERE user_id % 9 <> 0 AND NOT mean - 1 >= 0) FROM g
        UNION ALL SELECT 'year in range',
            count(*) FILTER (WHERE hour + 1990 NOT BETWEEN 2000 AND 2100) FROM g""",
    "notnull_violations": f"WITH {RAW} "
    + _quality_rows(("event_id", "value", "lat", "c_mktsegment"), "violations", False),
    "bound_params": f"WITH {ORDERS} {_bound_rows()}",
    "fit_closed_form": f"""WITH {LINES}, t AS (SELECT l_quantity, l_extendedprice AS y,
            CASE WHEN l_partkey % 31 <> 0 THEN l_returnflag END AS flag FROM l WHERE year <= 1998),
        m AS (SELECT flag, avg(y) AS m FROM t GROUP BY flag), z AS (SELECT m FROM m WHERE flag IS NULL)
        SELECT 'number' AS model, 'l_quantity' AS feature, CAST(NULL AS VARCHAR) AS category,
            {r('regr_slope(y, l_quantity)', 4)} AS weight FROM t
        UNION ALL SELECT 'number', 'intercept', NULL, {r('regr_intercept(y, l_quantity)', 4)} FROM t
        UNION ALL SELECT 'category', 'intercept', NULL, {r('m', 4)} FROM z
        UNION ALL SELECT 'category', 'l_returnflag', flag, {r('m.m - z.m', 4)} FROM m CROSS JOIN z
            WHERE flag IS NOT NULL""",
    "tune_forest": f"""WITH {LINES}, t AS (SELECT CAST(round(l_extendedprice * 100) AS BIGINT) AS c
            FROM l WHERE year <= 1998),
        s AS (SELECT CAST(floor(3 * (('0x' || substr(md5('fold|' || c), 1, 8))::BIGINT / 4294967296.0)) AS BIGINT) AS fold
              FROM t WHERE ('0x' || substr(md5('sample|' || c), 1, 8))::BIGINT / 4294967296.0 < 0.2),
        n AS (SELECT fold, count(*) AS n_test, sum(count(*)) OVER () AS total FROM s GROUP BY fold)
        SELECT fold, trees::BIGINT AS trees, depth::BIGINT AS depth, CAST(total - n_test AS BIGINT) AS n_train,
            n_test, 1::BIGINT AS scored
        FROM n CROSS JOIN (SELECT unnest([20, 30]) AS trees) CROSS JOIN (SELECT unnest([6, 8]) AS depth)""",
    # ---- features
    "leakage_guard": f"""WITH {LINES}, t AS (SELECT corr(month, l_extendedprice) AS month,
            corr(l_quantity, l_extendedprice) AS l_quantity,
            corr(l_discount, l_extendedprice) AS l_discount,
            corr(net_price, l_extendedprice) AS net_price,
            corr(discount_value, l_extendedprice) AS discount_value FROM l),
        u AS (UNPIVOT t ON month, l_quantity, l_discount, net_price, discount_value
              INTO NAME "column" VALUE c),
        i AS (SELECT avg(CAST(abs(net_price + discount_value - l_extendedprice) <= 1e-6 AS INT))
              AS share FROM l)
        SELECT "column", 'correlates with the measure' AS reason FROM u WHERE abs(c) > 0.95
        UNION ALL SELECT 'net_price', 'is a summand of the measure' FROM i WHERE share >= 0.99
        UNION ALL SELECT 'discount_value', 'is a summand of the measure' FROM i WHERE share >= 0.99""",
    "feature_blocks": f"""WITH {ORDERS}, tr AS (SELECT * FROM o WHERE year <= 1998),
        te AS (SELECT * FROM o WHERE year >= 2000), {history('tr')}
        SELECT block, o_orderkey, {r('hist_mean', 4)} AS hist_mean, {r('hist_sd', 4)} AS hist_sd,
            hist_periods FROM ({attached('tr', "'train' AS block, b.*")}
            UNION ALL {attached('te', "'test' AS block, b.*")})""",
    "history_earlier": f"""WITH {ORDERS}, tr AS (SELECT * FROM o WHERE year <= 1998),
        t AS (SELECT o_orderkey, year, avg(o_totalprice) OVER w AS m,
                coalesce(stddev_samp(o_totalprice) OVER w, 0) AS s, count(DISTINCT year) OVER w AS k
              FROM tr WINDOW w AS (PARTITION BY o_custkey ORDER BY year
                RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        c AS (SELECT y.year, avg(o_totalprice) AS m FROM (SELECT DISTINCT year FROM tr) y
              LEFT JOIN tr ON tr.year < y.year GROUP BY y.year)
        SELECT o_orderkey, {r('coalesce(t.m, c.m, 0)', 2)} AS hist_mean, {r('s', 2)} AS hist_sd,
            k AS hist_periods FROM t JOIN c USING (year)""",
    "history_others": f"""WITH {ORDERS}, tr AS (SELECT * FROM o WHERE year <= 1998),
        {history('tr')}, e AS (SELECT count(*) AS n, sum(hist_mean) AS m, sum(hist_sd) AS s FROM hist),
        t AS (SELECT *, avg(o_totalprice) OVER w AS own_m, stddev_samp(o_totalprice) OVER w AS own_s,
                count(*) OVER w AS own_n, count(*) OVER (PARTITION BY o_custkey, year) AS here
              FROM tr WINDOW w AS (PARTITION BY o_custkey ROWS BETWEEN UNBOUNDED PRECEDING
                AND UNBOUNDED FOLLOWING EXCLUDE CURRENT ROW))
        SELECT o_orderkey,
            {r('coalesce(own_m, (e.m - hist.hist_mean) / (e.n - 1))', 2)} AS hist_mean,
            {r('CASE WHEN own_n = 0 THEN e.s / (e.n - 1) ELSE coalesce(own_s, 0) END', 2)} AS hist_sd,
            hist.hist_periods - CASE WHEN here = 1 THEN 1 ELSE 0 END AS hist_periods
        FROM t JOIN hist USING (o_custkey) CROSS JOIN e""",
    "relative_target": f"""WITH {ORDERS}, tr AS (SELECT * FROM o WHERE year <= 1998),
        te AS (SELECT * FROM o WHERE year >= 2000), {history('tr')}
        SELECT o_orderkey, CASE WHEN hist_mean > 0 THEN {r('o_totalprice / hist_mean')} END
            AS relative_measure FROM ({attached('te')})""",
    # ---- evaluation
    "score": f"{MODEL_CTES} SELECT {SCORE_COLUMNS} FROM m",
    "trivial_baselines": f"{NAIVE_CTES} SELECT {SCORE_COLUMNS} FROM m",
    "results_table": f"{MODEL_CTES} SELECT {SCORE_COLUMNS} FROM m",
    "skill": f"""{MODEL_CTES} SELECT split, model, {r('r2 - base')} AS r2_gain,
        CASE WHEN base < 1 THEN {r('(r2 - base) / (1 - base)')} END AS skill FROM s""",
    "best_breakdown": f"""{MODEL_CTES}, w AS (SELECT *, row_number() OVER (PARTITION BY split
            ORDER BY r2 DESC, model DESC) AS place FROM s
            WHERE model NOT IN ('global_mean', 'entity_history'))
        SELECT split, model AS best_model, {r('r2')} AS best_r2, {r('base')} AS baseline_r2,
            {r('r2 - base')} AS added_r2, {r('1 - r2')} AS unexplained FROM w WHERE place = 1""",
    "profile_actual_pred": f"""{MODEL_CTES} SELECT split, model, month,
        {r('avg(actual)', 4)} AS mean_actual, {r('avg(prediction)', 4)} AS mean_prediction
        FROM f GROUP BY split, model, month""",
    "residual_by_slot": f"""{MODEL_CTES} SELECT split, model, month,
        {r('avg(prediction - actual)', 4)} AS mean_residual,
        {r('stddev_samp(prediction - actual)', 4)} AS sd_residual, count(*) AS n_rows
        FROM f GROUP BY split, model, month""",
    "error_by_class": f"""{MODEL_CTES} SELECT split, model, c_mktsegment,
        {r('avg(abs(prediction - actual))', 4)} AS mae, {r('avg(prediction - actual)', 4)} AS bias,
        {r('avg(actual)', 4)} AS mean_actual, count(*) AS n_rows
        FROM f GROUP BY split, model, c_mktsegment""",
    "density_2d": f"""{MODEL_CTES}, q AS (SELECT split, model, quantile_cont(actual, 0.995) AS lim
            FROM f GROUP BY split, model)
        SELECT split, model, CAST(CASE WHEN actual < 0 THEN -1 WHEN actual > lim THEN 45
                ELSE least(floor(actual * 45 / lim), 44) END AS BIGINT) AS actual_cell,
            CAST(CASE WHEN prediction < 0 THEN -1 WHEN prediction > lim THEN 45
                ELSE least(floor(prediction * 45 / lim), 44) END AS BIGINT) AS predicted_cell,
            count(*) AS n_rows FROM f JOIN q USING (split, model) GROUP BY 1, 2, 3, 4""",
    "split_profile": f"WITH {ORDERS} "
    + " UNION ALL ".join(
        f"SELECT '{s}' AS split, '{n}' AS block, count(*) AS n_rows, "
        f"{r('stddev_pop(o_totalprice)', 4)} AS target_sd FROM o WHERE {w}"
        for s, pair in SPLIT_WHERE.items()
        for n, w in zip(("train", "test"), pair)
    ),
}
