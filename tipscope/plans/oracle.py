"""Independent SQL statements (DuckDB dialect) for the oracle-checked queries.

They restate each operator's rules in plain SQL over the raw test tables, so a
mistake in the Spark code cannot hide in a shared helper.  Doubles are rounded
to 6 decimals on both sides where the two engines may differ in the last bits.
"""
from __future__ import annotations

# The rules' values, written out (not imported) so that a wrong value in the
# library shows as a difference.
NUMERIC_FEATURES = (
    "trip_distance", "passenger_count", "trip_duration_min", "avg_speed_mph", "fare_amount", "extra", "tolls_amount",
    "congestion_surcharge", "airport_fee", "pickup_hour", "is_weekend", "is_night", "PULocationID", "DOLocationID",
)
CORRELATED = tuple(c for c in NUMERIC_FEATURES if c not in ("PULocationID", "DOLocationID")) + ("label",)

# Lineitem joined to orders, in the canonical trip schema (before cleaning).
T1_RAW = """
SELECT l.l_orderkey AS trip_key,
       l.l_linenumber AS trip_line,
       o.o_orderdate AS tpep_pickup_datetime,
       l.l_shipdate AS tpep_dropoff_datetime,
       CAST(l.l_linenumber AS DOUBLE) AS passenger_count,
       l.l_quantity AS trip_distance,
       CAST(CASE o.o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2
            WHEN '3-MEDIUM' THEN 3 WHEN '5-LOW' THEN 5 END AS DOUBLE) AS RatecodeID,
       CAST(l.l_suppkey AS INTEGER) AS PULocationID,
       CAST(l.l_partkey AS INTEGER) AS DOLocationID,
       CAST(CASE o.o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END AS INTEGER) AS payment_type,
       l.l_extendedprice AS fare_amount,
       l.l_discount AS extra,
       l.l_extendedprice * l.l_tax AS tip_amount,
       CASE WHEN l.l_returnflag = 'R' THEN CAST(NULL AS DOUBLE) ELSE l.l_tax * 100 END AS tolls_amount,
       l.l_extendedprice + l.l_extendedprice * l.l_tax + l.l_discount AS total_amount,
       CASE WHEN l.l_linestatus = 'O' THEN CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
       CASE WHEN l.l_returnflag = 'A' THEN l.l_quantity / 10 END AS airport_fee
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

T1_DURATION = f"""
SELECT *, (floor(epoch(tpep_dropoff_datetime)) - floor(epoch(tpep_pickup_datetime)))
          / 86400.0 AS trip_duration_min
FROM ({T1_RAW}) r
"""

T1_CLEAN = f"""
SELECT trip_key, trip_line, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count,
       trip_distance, coalesce(RatecodeID, CAST(1 AS DOUBLE)) AS RatecodeID, PULocationID, DOLocationID,
       payment_type, fare_amount, coalesce(extra, 0) AS extra, tip_amount,
       coalesce(tolls_amount, 0) AS tolls_amount, total_amount,
       coalesce(congestion_surcharge, 0) AS congestion_surcharge,
       coalesce(airport_fee, 0) AS airport_fee, trip_duration_min, avg_speed_mph,
       CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
       CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS pickup_dow,
       CAST(CASE WHEN dayofweek(tpep_pickup_datetime) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
       CAST(CASE WHEN hour(tpep_pickup_datetime) >= 22 OR hour(tpep_pickup_datetime) <= 5
            THEN 1 ELSE 0 END AS INTEGER) AS is_night,
       CAST(CASE WHEN tip_amount / fare_amount < 0.015 THEN 1
                 WHEN tip_amount / fare_amount >= 0.015 THEN 0 END AS INTEGER) AS label,
       tip_amount / fare_amount AS tip_pct
FROM (
  SELECT *, trip_distance / (trip_duration_min / 1.0) AS avg_speed_mph
  FROM ({T1_DURATION}) d
  WHERE payment_type = 1
    AND fare_amount > 0 AND fare_amount < 100000
    AND trip_distance > 0 AND trip_distance < 50
    AND passenger_count >= 1 AND passenger_count <= 6
    AND trip_duration_min >= 1 AND trip_duration_min <= 730
) s
WHERE avg_speed_mph > 0 AND avg_speed_mph <= 1
"""

EVENTS_LABELLED = """
SELECT *, CAST(CASE WHEN value < 5 THEN 1 WHEN value >= 5 THEN 0 END AS INTEGER) AS label FROM events
"""

T4 = """
SELECT CAST(CASE WHEN l_tax < 0.015 THEN 1 ELSE 0 END AS INTEGER) AS label,
       l_quantity / 50.0 AS score,
       CASE WHEN l_quantity / 50.0 >= 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
FROM lineitem
"""

T4_LONG = """
SELECT label, model, score, CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
FROM (
  SELECT CAST(CASE WHEN l_tax < 0.015 THEN 1 ELSE 0 END AS INTEGER) AS label, 'quantity' AS model,
         l_quantity / 50.0 AS score FROM lineitem
  UNION ALL
  SELECT CAST(CASE WHEN l_tax < 0.015 THEN 1 ELSE 0 END AS INTEGER), 'discount', l_discount * 10.0 FROM lineitem
  UNION ALL
  SELECT CAST(CASE WHEN l_tax < 0.015 THEN 1 ELSE 0 END AS INTEGER), 'price', l_extendedprice / 105000.0 FROM lineitem
  UNION ALL
  SELECT CAST(CASE WHEN l_tax < 0.015 THEN 1 ELSE 0 END AS INTEGER), 'inverse_quantity',
         1.0 - l_quantity / 50.0 FROM lineitem
) u
"""


def _rnd(expr: str, digits: int | None) -> str:
    return expr if digits is None else f"round({expr}, {digits})"


def threshold_metrics_sql(pred_sql: str, group: str | None = None, digits: int | None = 6) -> str:
    g = f"{group}, " if group else ""
    gb = f"GROUP BY {group}" if group else ""
    return f"""
WITH cells AS (
  SELECT {g}
    count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
    count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
    count(*) FILTER (WHERE label = 1 AND prediction <> 1) AS fn,
    count(*) FILTER (WHERE label = 0 AND prediction <> 1) AS tn
  FROM ({pred_sql}) p WHERE label IS NOT NULL {gb}
), rates AS (
  SELECT *, tp + fn AS n1, tn + fp AS n0, tp + fn + tn + fp AS n,
    coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS p1,
    coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS r1,
    coalesce(tn::DOUBLE / nullif(tn + fn, 0), 0) AS p0,
    coalesce(tn::DOUBLE / nullif(tn + fp, 0), 0) AS r0
  FROM cells
), f AS (
  SELECT *, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1_1,
            coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f1_0,
            coalesce(n1::DOUBLE / nullif(n, 0), 0) AS w1,
            coalesce(n0::DOUBLE / nullif(n, 0), 0) AS w0
  FROM rates
)
SELECT {g} tp, fp, fn, tn,
  {_rnd("coalesce((tp + tn)::DOUBLE / nullif(n, 0), 0)", digits)} AS accuracy,
  {_rnd("w0 * f1_0 + w1 * f1_1", digits)} AS f1,
  {_rnd("w0 * p0 + w1 * p1", digits)} AS precision_w,
  {_rnd("w0 * r0 + w1 * r1", digits)} AS recall_w,
  {_rnd("r1", digits)} AS recall_pos
FROM f
"""


def auc_sql(pred_sql: str, group: str | None = None, digits: int | None = 6) -> str:
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group}" if group else ""
    gb = f"GROUP BY {group}" if group else ""
    return f"""
WITH s AS (
  SELECT {g} score,
         count(*) FILTER (WHERE label = 1) AS pos,
         count(*) FILTER (WHERE label = 0) AS neg
  FROM ({pred_sql}) p
  WHERE label IN (0, 1) AND score IS NOT NULL AND NOT isnan(score)
  GROUP BY {g} score
), c AS (
  SELECT *, coalesce(sum(neg) OVER ({part} ORDER BY score
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM s
)
SELECT {g} {_rnd("sum(pos * (below + neg / 2.0)) / (sum(pos)::DOUBLE * sum(neg))", digits)} AS auc
FROM c {gb}
"""


def metric_record_sql(pred_sql: str, group: str | None = None, digits: int | None = 6) -> str:
    g = f"t.{group}, " if group else ""
    on = f"ON t.{group} = a.{group}" if group else "ON TRUE"
    scored = f"SELECT * FROM ({pred_sql}) z WHERE score IS NOT NULL AND NOT isnan(score) AND prediction IS NOT NULL"
    return f"""
SELECT {g} a.auc, t.accuracy, t.f1, t.precision_w, t.recall_w, t.recall_pos, u.n_unscored
FROM ({threshold_metrics_sql(scored, group, digits)}) t JOIN ({auc_sql(pred_sql, group, digits)}) a {on}
JOIN (SELECT {group + ", " if group else ""} count(*) FILTER (WHERE score IS NULL OR isnan(score) OR prediction IS NULL) AS n_unscored
      FROM ({pred_sql}) q WHERE label IN (0, 1) {"GROUP BY " + group if group else ""}) u {on.replace("a.", "u.")}
"""


def correlation_sql(src_sql: str, cols: list[str]) -> str:
    parts = []
    for a in cols:
        for b in cols:
            ca, cb = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
            va = f"covar_pop({ca}, CASE WHEN {cb} IS NOT NULL THEN {ca} END)"
            vb = f"covar_pop({cb}, CASE WHEN {ca} IS NOT NULL THEN {cb} END)"
            r = f"covar_pop({ca}, {cb}) / nullif(sqrt({va} * {vb}), 0)"
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round({r}, 6) AS r FROM src")
    return f"WITH src AS ({src_sql})\n" + "\nUNION ALL\n".join(parts)


def _r6(cols: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


T1_CLEAN_COLS = [
    "trip_key", "trip_line", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
    "trip_distance", "RatecodeID", "PULocationID", "DOLocationID", "payment_type", "fare_amount",
    "extra", "tip_amount", "tolls_amount", "total_amount", "congestion_surcharge", "airport_fee",
    "trip_duration_min", "avg_speed_mph", "pickup_hour", "pickup_dow", "is_weekend", "is_night",
    "label", "tip_pct",
]
_T1_DOUBLES = {
    "passenger_count", "trip_distance", "RatecodeID", "fare_amount", "extra", "tip_amount",
    "tolls_amount", "total_amount", "congestion_surcharge", "airport_fee", "trip_duration_min",
    "avg_speed_mph", "tip_pct",
}


def _t1_select(cols: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" if c in _T1_DOUBLES else c for c in cols)


def _filter(pred: str, col: str, src: str = T1_RAW) -> str:
    return f"SELECT trip_key, trip_line, {_t1_select([col])} FROM ({src}) r WHERE {pred}"


def _index_sql(col: str) -> str:
    return f"""
SELECT value, CAST(row_number() OVER (ORDER BY n_rows DESC, value) - 1 AS INTEGER) AS idx, n_rows,
       '{col}' AS feature
FROM (SELECT CAST({col} AS VARCHAR) AS value, count(*) AS n_rows FROM ({T1_CLEAN}) c GROUP BY 1) g
"""


def _one_hot_sql(col: str) -> str:
    return f"""
SELECT value, CAST(count(*) OVER () AS INTEGER) AS vec_size, idx AS hot_slot, n_rows, feature
FROM ({_index_sql(col)}) i
"""


T1_HISTOGRAM_SQL = f"""
WITH src AS (
  SELECT * FROM ({T1_CLEAN}) c
  WHERE trip_distance < 25.0 AND trip_duration_min < 400.0 AND fare_amount < 60000.0 AND label IN (0, 1)
), long AS (
  SELECT label, 'trip_distance' AS feature, CAST(trip_distance AS DOUBLE) AS x FROM src
  UNION ALL SELECT label, 'trip_duration_min', CAST(trip_duration_min AS DOUBLE) FROM src
  UNION ALL SELECT label, 'fare_amount', CAST(fare_amount AS DOUBLE) FROM src
), raw_stats AS (
  SELECT feature, label, min(x) AS lo, max(x) AS hi, count(*) AS n FROM long
  WHERE x IS NOT NULL AND NOT isnan(x) GROUP BY feature, label
), stats AS (
  SELECT feature, label, n,
         CASE WHEN hi > lo THEN lo ELSE lo - 0.5 END AS lo,
         CASE WHEN hi > lo THEN hi ELSE hi + 0.5 END AS hi
  FROM raw_stats
), scaled AS (
  SELECT l.feature, l.label, l.x, s.lo, s.hi, s.n, (s.hi - s.lo) / 40.0 AS w,
         least(greatest(floor((l.x - s.lo) / (s.hi - s.lo) * 40.0), 0), 39) AS raw
  FROM long l JOIN stats s ON l.feature = s.feature AND l.label = s.label
  WHERE l.x IS NOT NULL AND NOT isnan(l.x)
), binned AS (
  SELECT feature, label, lo, hi, n,
         CAST(CASE WHEN x < raw * w + lo THEN raw - 1
                   WHEN raw <> 39 AND x >= (CASE WHEN raw + 1 >= 40 THEN hi ELSE (raw + 1) * w + lo END)
                   THEN raw + 1 ELSE raw END AS INTEGER) AS bin
  FROM scaled
)
SELECT feature, label, bin, round(lo + bin * ((hi - lo) / 40.0), 6) AS bin_lo, count(*) AS n_rows,
       round(count(*) / (n * ((hi - lo) / 40.0)), 6) AS density
FROM binned GROUP BY feature, label, bin, lo, hi, n
"""

BALANCE_SQL = """
SELECT n_neg, n_pos, n_neg + n_pos AS total,
       round(coalesce(n_pos::DOUBLE / nullif(n_neg + n_pos, 0), 0), 6) AS pos_rate,
       round(CASE WHEN n_pos > 0 THEN n_neg::DOUBLE / n_pos ELSE 'inf'::DOUBLE END, 6) AS imbalance_ratio,
       round(coalesce((n_neg + n_pos)::DOUBLE / nullif(2 * n_neg, 0), 0), 6) AS weight_neg,
       round(coalesce((n_neg + n_pos)::DOUBLE / nullif(2 * n_pos, 0), 0), 6) AS weight_pos,
       round(greatest(coalesce(n_pos::DOUBLE / nullif(n_neg + n_pos, 0), 0),
                      1.0 - coalesce(n_pos::DOUBLE / nullif(n_neg + n_pos, 0), 0)), 6) AS majority_accuracy
FROM (SELECT count(*) FILTER (WHERE {lab} = 0) AS n_neg, count(*) FILTER (WHERE {lab} = 1) AS n_pos
      FROM ({src}) s) c
"""

WEIGHTS_SQL = f"""
WITH c AS (SELECT * FROM ({T1_CLEAN}) t),
b AS (SELECT count(*) FILTER (WHERE label = 0) AS n0, count(*) FILTER (WHERE label = 1) AS n1 FROM c),
w AS (SELECT c.label,
        CASE WHEN c.label = 1 THEN (CASE WHEN n1 > 0 THEN (n0 + n1) / (2.0 * n1) ELSE 0 END)
             ELSE (CASE WHEN n0 > 0 THEN (n0 + n1) / (2.0 * n0) ELSE 0 END) END::DOUBLE AS class_weight,
        c.trip_key, c.trip_line
      FROM c, b)
"""


def majority_sql(label: str, src: str) -> str:
    return f"""
SELECT CASE WHEN n > 0 THEN round(greatest(p, n - p)::DOUBLE / n, 6) END AS majority_accuracy,
       CASE WHEN n > 0 THEN CASE WHEN p > n - p THEN 1.0 ELSE 0.0 END::DOUBLE END AS majority_recall_pos, n AS total
FROM (SELECT count(*) FILTER (WHERE {label} IN (0, 1)) AS n, count(*) FILTER (WHERE {label} = 1) AS p FROM ({src}) s) c"""


# T5: events as a table of runs.
RUNS_SQL = """
WITH runs AS (SELECT event_type, count(*) AS n_rows, round(sum(value), 3) AS train_seconds,
                     CAST(length(event_type) AS INTEGER) AS cores FROM events GROUP BY event_type)"""

# Labelled documents with their position in the 60-bit hash range.
QUALITY_SQL = """
WITH q AS (SELECT d.doc_id, CAST(('0x' || substr(md5(CAST(d.doc_id AS VARCHAR)), 1, 15)) AS BIGINT) AS place
           FROM documents d JOIN labels l USING (doc_id) WHERE d.text IS NOT NULL AND d.n_chars IS NOT NULL)"""

# Dear lines with class weights: the rows of the learner checks.
DEAR_SQL = """,
lines AS (
  SELECT l_quantity::DOUBLE AS quantity, l_linenumber::DOUBLE AS line, l_discount::DOUBLE AS discount, l_tax::DOUBLE AS tax,
         CASE WHEN l_extendedprice * (0.2::DOUBLE + l_quantity / 50.0::DOUBLE) > 35000 THEN 1 ELSE 0 END AS label
  FROM lineitem
), weighted AS (
  SELECT *, CASE WHEN label = 1 THEN count(*) OVER () / (2.0 * sum(label) OVER ())::DOUBLE
                 ELSE count(*) OVER () / (2.0 * sum(1 - label) OVER ())::DOUBLE END AS w
  FROM lines
)"""

# Newton steps of the weighted logistic regression on two columns; the 3 x 3 system by cofactors.
NEWTON_SQL = DEAR_SQL + """,
steps(step, b0, b1, b2) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
  UNION ALL
  SELECT step + 1,
         b0 + ((d * f - e * e) * g0 + (c * e - b * f) * g1 + (b * e - c * d) * g2) / det,
         b1 + ((c * e - b * f) * g0 + (a * f - c * c) * g1 + (b * c - a * e) * g2) / det,
         b2 + ((b * e - c * d) * g0 + (b * c - a * e) * g1 + (a * d - b * b) * g2) / det
  FROM (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det
        FROM (SELECT step, b0, b1, b2, sum(w * (label - p)) AS g0, sum(w * (label - p) * quantity) AS g1, sum(w * (label - p) * discount) AS g2,
                     sum(h) AS a, sum(h * quantity) AS b, sum(h * discount) AS c, sum(h * quantity * quantity) AS d,
                     sum(h * quantity * discount) AS e, sum(h * discount * discount) AS f
              FROM (SELECT *, w * p * (1 - p) AS h
                    FROM (SELECT *, 1 / (1 + exp(-(b0 + b1 * quantity + b2 * discount))) AS p FROM steps, weighted WHERE step < 20))
              GROUP BY step, b0, b1, b2))
), newton AS (
  SELECT round(b0, 6) AS intercept, round(b1, 6) AS quantity, round(b2, 6) AS discount FROM steps WHERE step = 20
)"""

# The first split of a tree: weighted class counts left of every value of every column.
ROOT_SQL = DEAR_SQL + """,
cells AS (
  SELECT place, feature, v, sum(w * label) AS w1, sum(w * (1 - label)) AS w0
  FROM (SELECT 0 AS place, 'quantity' AS feature, quantity AS v, w, label FROM weighted UNION ALL SELECT 1, 'line', line, w, label FROM weighted
        UNION ALL SELECT 2, 'discount', discount, w, label FROM weighted UNION ALL SELECT 3, 'tax', tax, w, label FROM weighted)
  GROUP BY ALL
), sides AS (
  SELECT place, feature, v, lead(v) OVER up AS next, sum(w1) OVER up AS l1, sum(w0) OVER up AS l0,
         sum(w1) OVER (PARTITION BY place) AS a1, sum(w0) OVER (PARTITION BY place) AS a0
  FROM cells WINDOW up AS (PARTITION BY place ORDER BY v)
), gains AS (
  SELECT place, feature, (v + next) / 2 AS threshold,
         1 - (a1 * a1 + a0 * a0) / pow(a1 + a0, 2)
         - (l1 + l0) / (a1 + a0) * (1 - (l1 * l1 + l0 * l0) / pow(l1 + l0, 2))
         - (a1 + a0 - l1 - l0) / (a1 + a0) * (1 - (pow(a1 - l1, 2) + pow(a0 - l0, 2)) / pow(a1 + a0 - l1 - l0, 2)) AS gain
  FROM sides WHERE next IS NOT NULL
), root AS (
  SELECT feature AS root_feature, threshold AS root_threshold, round(gain, 6) AS root_gain
  FROM gains ORDER BY round(gain, 12) DESC, place, threshold LIMIT 1
)"""


def fit_sql(model: str, steps: str, found: str, columns: str) -> str:
    return QUALITY_SQL.replace("WITH", "WITH RECURSIVE", 1) + steps + f"""
SELECT facts.*, {columns}, TRUE AS learner_agrees
FROM (SELECT '{model}' AS model, count(*) AS n_rows, count(*) FILTER (WHERE place < 922337203685477632) AS n_train,
             count(*) FILTER (WHERE place >= 922337203685477632) AS n_test, TRUE AS recall_is_accuracy, TRUE AS in_range
      FROM q) facts, {found}"""


FEATURES_SQL = r"""
WITH t AS (
  SELECT d.doc_id, d.lang, CAST(CASE WHEN l.quality = 0 THEN 1 WHEN l.quality IS NOT NULL THEN 0 END AS INTEGER) AS label,
         d.n_chars::DOUBLE AS slot_0, greatest(length(d.text), 1) AS n, d.text
  FROM documents d JOIN labels l USING (doc_id) WHERE d.text IS NOT NULL AND d.n_chars IS NOT NULL
), w AS (
  SELECT count(*) AS total, count(*) FILTER (WHERE label = 1) AS n1, count(*) FILTER (WHERE label = 0) AS n0 FROM t
), langs AS (
  SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS place, count(*) OVER () AS known
  FROM t WHERE lang <> 'es' GROUP BY lang
)
SELECT t.doc_id, t.label, round(CASE WHEN t.label = 1 THEN total / (2.0 * n1) ELSE total / (2.0 * n0) END, 6) AS class_weight,
       CAST(5 + (SELECT max(known) FROM langs) AS INTEGER) AS vec_size, round(slot_0, 6) AS slot_0,
       round(length(regexp_replace(text, '[^0-9]', '', 'g'))::DOUBLE / n, 6) AS slot_1,
       round(length(regexp_replace(text, '[^A-Z]', '', 'g'))::DOUBLE / n, 6) AS slot_2,
       round(length(regexp_replace(text, '[^\n]', '', 'g'))::DOUBLE / n, 6) AS slot_3,
       round(len(string_split_regex(text, '\s+'))::DOUBLE / n, 6) AS slot_4,
       CAST(CASE WHEN t.doc_id % 10 <> 0 THEN coalesce(langs.place, -1) ELSE -1 END AS INTEGER) AS hot_slot
FROM t CROSS JOIN w LEFT JOIN langs ON t.lang = langs.lang"""


def _feature_sum_sql() -> str:
    expr = "0.0::DOUBLE"
    for c in NUMERIC_FEATURES:
        expr = f"({expr} + CAST({c} AS DOUBLE))"
    return f"(({expr} + 1.0) + 1.0)"


def oracle_sql() -> dict[str, str]:
    leader = metric_record_sql(T4_LONG, "model")
    sql = {
        "scan_normalise": """
SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_partkey AS INTEGER) AS l_partkey,
       CAST(l_suppkey AS INTEGER) AS l_suppkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber,
       CAST(l_quantity AS INTEGER) AS l_quantity, l_extendedprice, l_tax, l_returnflag, l_shipdate
FROM lineitem""",
        "scan_union_by_name": """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
UNION ALL
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders""",
        "clean_trips": f"SELECT {_t1_select(T1_CLEAN_COLS)} FROM ({T1_CLEAN}) c",
        "filter_payment": _filter("payment_type = 1", "payment_type"),
        "filter_fare": _filter("fare_amount > 0 AND fare_amount < 100000", "fare_amount"),
        "filter_distance": _filter("trip_distance > 0 AND trip_distance < 50", "trip_distance"),
        "filter_passengers": _filter("passenger_count >= 1 AND passenger_count <= 6", "passenger_count"),
        "filter_duration": _filter("trip_duration_min >= 1 AND trip_duration_min <= 730",
                                   "trip_duration_min", T1_DURATION),
        "filter_speed": f"""
SELECT trip_key, trip_line, round(avg_speed_mph, 6) AS avg_speed_mph FROM (
  SELECT *, trip_distance / (trip_duration_min / 1.0) AS avg_speed_mph FROM ({T1_DURATION}) d) s
WHERE avg_speed_mph > 0 AND avg_speed_mph <= 1""",
        "duration": f"SELECT trip_key, trip_line, round(trip_duration_min, 6) AS trip_duration_min FROM ({T1_DURATION}) d",
        "speed": f"""
SELECT trip_key, trip_line, round(trip_distance / (trip_duration_min / 1.0), 6) AS avg_speed_mph
FROM ({T1_DURATION}) d WHERE trip_duration_min >= 1 AND trip_duration_min <= 730""",
        "time_features": """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS pickup_hour, CAST(dayofweek(ts) + 1 AS INTEGER) AS pickup_dow,
       CAST(CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
       CAST(CASE WHEN hour(ts) >= 22 OR hour(ts) <= 5 THEN 1 ELSE 0 END AS INTEGER) AS is_night,
       (['Dom', 'Lun', 'Mar', 'Mie', 'Jue', 'Vie', 'Sab'])[dayofweek(ts) + 1] AS day_name
FROM events""",
        "fill_nulls": f"""
SELECT trip_key, trip_line, round(coalesce(RatecodeID, 1.0), 6)::DOUBLE AS RatecodeID,
       round(coalesce(extra, 0), 6) AS extra, round(coalesce(tolls_amount, 0), 6) AS tolls_amount,
       round(coalesce(congestion_surcharge, 0), 6) AS congestion_surcharge,
       round(coalesce(airport_fee, 0), 6) AS airport_fee
FROM ({T1_RAW}) r""",
        "label_threshold": f"SELECT trip_key, trip_line, label FROM ({T1_CLEAN}) c",
        "tip_ratio": f"SELECT trip_key, trip_line, round(tip_pct, 6) AS tip_pct FROM ({T1_CLEAN}) c",
        "retention": f"""
SELECT n_raw, n_clean, round(n_clean::DOUBLE / nullif(n_raw, 0), 6) AS retained FROM (
  SELECT (SELECT count(*) FROM ({T1_RAW}) r) AS n_raw, (SELECT count(*) FROM ({T1_CLEAN}) c) AS n_clean) x""",
        "class_balance": BALANCE_SQL.format(lab="label", src=T1_CLEAN),
        "class_balance_toxic": BALANCE_SQL.format(lab="toxic", src="SELECT * FROM labels"),
        "majority_baseline": majority_sql("label", T1_CLEAN),
        "majority_baseline_inverse": majority_sql("quality", "SELECT * FROM labels"),
        "class_weights": WEIGHTS_SQL + """
SELECT label, round(max(class_weight), 6) AS class_weight, count(*) AS n_rows,
       round(sum(class_weight), 6) AS weight_sum
FROM w GROUP BY label""",
        "rows_per_month": """
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n_rows FROM orders GROUP BY 1""",
        "month_prefix": """
SELECT month, n_rows FROM (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n_rows
FROM orders GROUP BY 1) m WHERE starts_with(month, '1998')""",
        "ratio_histogram": f"""
SELECT CAST(floor(tip_pct / 0.02) AS BIGINT) AS bin_idx, count(*) AS n_rows,
       round(CAST(floor(tip_pct / 0.02) AS BIGINT) * CAST(0.02 AS DOUBLE), 6) AS bin
FROM ({T1_CLEAN}) c WHERE tip_pct <= 0.6 AND tip_pct IS NOT NULL GROUP BY 1""",
        "rate_by_hour": f"""
SELECT CAST(hour(ts) AS INTEGER) AS h, round(avg(label), 6) AS low_rate, count(*) AS n_rows
FROM ({EVENTS_LABELLED}) e GROUP BY 1""",
        "rate_by_weekday": f"""
SELECT CAST(dayofweek(ts) + 1 AS INTEGER) AS d, round(avg(label), 6) AS low_rate, count(*) AS n_rows,
       (['Dom', 'Lun', 'Mar', 'Mie', 'Jue', 'Vie', 'Sab'])[dayofweek(ts) + 1] AS day_name
FROM ({EVENTS_LABELLED}) e GROUP BY 1, 4""",
        "label_domain": f"SELECT DISTINCT label FROM ({T1_CLEAN}) c",
        "correlation": correlation_sql(T1_CLEAN, list(CORRELATED)),
        "correlation_time": correlation_sql(f"""
SELECT value, CASE WHEN event_id % 7 <> 0 THEN value END AS gap, hour(ts) AS pickup_hour, dayofweek(ts) + 1 AS pickup_dow,
       CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN hour(ts) >= 22 OR hour(ts) <= 5 THEN 1 ELSE 0 END AS is_night, label
FROM ({EVENTS_LABELLED}) e""", ["value", "gap", "pickup_hour", "pickup_dow", "is_weekend", "is_night", "label"]),
        "class_histogram": T1_HISTOGRAM_SQL,
        "exploration_balance": BALANCE_SQL.format(lab="label", src=EVENTS_LABELLED),
        "exploration_months": "SELECT strftime(ts, '%Y-%m') AS month, count(*) AS n_rows FROM events GROUP BY 1",
        "exploration_ratio": """
SELECT CAST(floor(value / 50.0 / 0.02) AS BIGINT) AS bin_idx, count(*) AS n_rows,
       round(CAST(floor(value / 50.0 / 0.02) AS BIGINT) * CAST(0.02 AS DOUBLE), 6) AS bin
FROM events WHERE value / 50.0 <= 0.6 GROUP BY 1""",
        "exploration_hour": f"""
SELECT CAST(hour(ts) AS INTEGER) AS h, round(avg(label), 6) AS low_rate, count(*) AS n_rows
FROM ({EVENTS_LABELLED}) e GROUP BY 1""",
        "exploration_weekday": f"""
SELECT CAST(dayofweek(ts) + 1 AS INTEGER) AS d, round(avg(label), 6) AS low_rate, count(*) AS n_rows,
       (['Dom', 'Lun', 'Mar', 'Mie', 'Jue', 'Vie', 'Sab'])[dayofweek(ts) + 1] AS day_name
FROM ({EVENTS_LABELLED}) e GROUP BY 1, 4""",
        "confusion": f"""
SELECT label, CAST(prediction AS INTEGER) AS prediction, count(*) AS n_rows
FROM ({T4}) p WHERE label IS NOT NULL GROUP BY 1, 2""",
        "auc": auc_sql(T4),
        "weighted_metrics": threshold_metrics_sql(T4),
        "minority_recall": f"SELECT tp, fn, recall_pos FROM ({threshold_metrics_sql(T4)}) m",
        "metric_record": metric_record_sql(T4),
        "metric_record_missing": metric_record_sql(f"""
SELECT label, CASE WHEN score < 0.1 THEN NULL WHEN score > 0.9 THEN 'nan'::DOUBLE ELSE score END AS score, prediction
FROM ({T4}) s"""),
        "leaderboard": leader,
        "best_model": f"""
WITH b AS ({leader})
SELECT (SELECT model FROM b ORDER BY auc DESC, model LIMIT 1) AS best_auc_model, (SELECT max(auc) FROM b) AS best_auc,
       (SELECT model FROM b ORDER BY f1 DESC, model LIMIT 1) AS best_f1_model,
       (SELECT model FROM b ORDER BY recall_pos DESC, model LIMIT 1) AS best_recall_pos_model""",
        "cost_tradeoff": f"""
WITH b AS ({leader}), c AS (SELECT model, CAST(sum(prediction) AS BIGINT) AS cost FROM ({T4_LONG}) p GROUP BY model),
r AS (SELECT b.model, c.cost, b.auc FROM b JOIN c USING (model))
SELECT x.model, x.cost, x.auc, x.auc IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM r y WHERE y.cost <= x.cost AND y.auc >= x.auc AND (y.cost < x.cost OR y.auc > x.auc)) AS pareto
FROM r x""",
        "report_rows": f"""
SELECT model, round(auc, 3) AS auc, round(accuracy, 3) AS accuracy, round(f1, 3) AS f1,
       round(precision_w, 3) AS precision_w, round(recall_w, 3) AS recall_w,
       round(recall_pos, 3) AS recall_pos, n_unscored
FROM ({metric_record_sql(T4_LONG, "model", None)}) b""",
        "hash_sample": """
SELECT event_id, CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 7)) AS BIGINT) % 10000 AS hash_bucket
FROM events
WHERE CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 15)) AS BIGINT) < 230584300921369408""",
        "hash_sample_small": """
SELECT l_orderkey, l_linenumber, l_orderkey || '-' || l_linenumber AS line_key FROM lineitem
WHERE CAST(('0x' || substr(md5(l_orderkey || '-' || l_linenumber), 1, 15)) AS BIGINT) < 403522526612396""",
        "hash_split": """
SELECT event_id,
       CASE WHEN CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 15)) AS BIGINT) < 922337203685477632
            THEN 'train' ELSE 'test' END AS part
FROM events""",
        "string_index": _index_sql("pickup_dow") + " UNION ALL " + _index_sql("RatecodeID"),
        "one_hot": _one_hot_sql("pickup_dow") + " UNION ALL " + _one_hot_sql("RatecodeID"),
        "assemble": f"""
SELECT trip_key, trip_line, label, vec_size, n_nonzero, feature_sum FROM (
  SELECT trip_key, trip_line, label,
         CAST(14 + (SELECT count(DISTINCT pickup_dow) FROM ({T1_CLEAN}) a)
            + (SELECT count(DISTINCT RatecodeID) FROM ({T1_CLEAN}) b) AS INTEGER) AS vec_size,
         2 + {" + ".join(f"(CASE WHEN {c} <> 0 THEN 1 ELSE 0 END)" for c in NUMERIC_FEATURES)} AS n_nonzero,
         {_feature_sum_sql()} AS feature_sum
  FROM ({T1_CLEAN}) c) x""",
        "load_trips_drift": f"SELECT {_t1_select(T1_CLEAN_COLS)} FROM ({T1_CLEAN}) c",
        "metrics_roundtrip": f"SELECT *, 'run-1' AS run_id FROM ({leader}) b WHERE model IN ('quantity', 'price')",
        "linear_reference": RUNS_SQL + """
SELECT event_type, n_rows, round(train_seconds, 6) AS train_seconds, round(
  first_value(train_seconds) OVER w / first_value(n_rows) OVER w * n_rows, 6) AS linear_seconds
FROM runs WINDOW w AS (ORDER BY n_rows, train_seconds ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
        "speedup": RUNS_SQL + """,
best AS (SELECT cores, min(train_seconds) AS train_seconds FROM runs GROUP BY cores),
base AS (SELECT arg_min(train_seconds, cores) AS s, min(cores) AS c FROM best)
SELECT cores, round(train_seconds, 6) AS train_seconds, round(s / train_seconds, 6) AS speedup,
       round(cores::DOUBLE / c, 6) AS ideal, round((s / train_seconds) / (cores::DOUBLE / c), 6) AS efficiency
FROM best, base""",
        "random_split": """
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, max(n) AS most_of_a_key
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) k""",
        "feature_pipeline": FEATURES_SQL,
        "data_scaling": QUALITY_SQL + """
SELECT CAST(f AS DOUBLE) AS fraction, (SELECT count(*) FROM q WHERE place < f * 1152921504606846976) AS n_rows, TRUE AS timed
FROM (VALUES (0.25), (0.5), (1.0)) v(f)""",
        "fit_lr": fit_sql("LogisticRegression", NEWTON_SQL, "newton", "intercept, quantity, discount"),
        **{f"fit_{short}": fit_sql(name, ROOT_SQL, "root", "root_feature, root_threshold, root_gain")
           for short, name in (("dt", "DecisionTree"), ("rf", "RandomForest"), ("gbt", "GBT"))},
        "experiment": f"""
WITH c AS (SELECT label, CAST(('0x' || substr(md5(trip_key || 'split'), 1, 15)) AS BIGINT) AS place,
                  CAST(('0x' || substr(md5(CAST(trip_key AS VARCHAR)), 1, 15)) AS BIGINT) AS own FROM ({T1_CLEAN}) t)
SELECT (SELECT count(*) FROM ({T1_RAW}) r) AS n_raw, count(*) AS n_clean, count(*) FILTER (WHERE label = 0) AS n_neg,
       count(*) FILTER (WHERE label = 1) AS n_pos, round(count(*) FILTER (WHERE label = 1) / count(label)::DOUBLE, 6) AS pos_rate,
       count(*) FILTER (WHERE place < 922337203685477632) AS n_train, count(*) FILTER (WHERE place >= 922337203685477632) AS n_test,
       1.0::DOUBLE AS fraction, 42::BIGINT AS seed, count(*) FILTER (WHERE own < 576460752303423488) AS n_half, count(*) AS n_full,
       TRUE AS timed, 1::BIGINT AS n_models
FROM c""",
        "target_row_sample": """
SELECT l_orderkey, l_linenumber, l_orderkey || '-' || l_linenumber AS line_key FROM lineitem
ORDER BY CAST(('0x' || substr(md5(l_orderkey || '-' || l_linenumber), 1, 15)) AS BIGINT) LIMIT 1000""",
        "sampler_facts": """
SELECT sampler, TRUE AS rows_of_the_table, TRUE AS size_fits FROM (VALUES ('bernoulli'), ('target')) v(sampler)""",
        "state_balance": BALANCE_SQL.format(lab="label", src=T1_CLEAN),
        "state_months": f"SELECT strftime(tpep_pickup_datetime, '%Y-%m') AS month, count(*) AS n_rows FROM ({T1_CLEAN}) c GROUP BY 1",
        "state_ratio": f"""
SELECT CAST(floor(tip_pct / 0.02) AS BIGINT) AS bin_idx, count(*) AS n_rows,
       round(CAST(floor(tip_pct / 0.02) AS BIGINT) * CAST(0.02 AS DOUBLE), 6) AS bin
FROM ({T1_CLEAN}) c WHERE tip_pct <= 0.6 AND tip_pct IS NOT NULL GROUP BY 1""",
        "state_correlation": correlation_sql(T1_CLEAN, list(CORRELATED)),
        "sink_roundtrip": WEIGHTS_SQL + "SELECT trip_key, trip_line, label, round(class_weight, 6) AS class_weight FROM w",
    }
    return {k: v.strip() for k, v in sql.items()}
