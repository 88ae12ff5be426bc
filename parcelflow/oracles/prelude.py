"""SQL over the base tables that the oracles start from: sources, enriched orders, fact, marts, results.

Written step by step with joins and unions, unlike the Spark plans, so that agreement means something.
"""

# Source tables derived from the star schema.
SOURCES = """
raw_orders AS (
  SELECT
    CAST(o_orderkey AS VARCHAR) AS order_id,
    CAST(o_custkey AS VARCHAR) AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'canceled' END AS order_status,
    o_orderdate AS order_purchase_timestamp,
    o_orderdate + to_days(1) AS order_approved_at,
    CASE WHEN o_orderstatus = 'P' AND o_orderkey % 5 = 0 THEN NULL
         ELSE o_orderdate + to_days(CAST(o_orderkey * 7 % 13 - 1 AS INTEGER)) END AS order_delivered_carrier_date,
    CASE WHEN o_orderstatus = 'P' AND o_orderkey % 5 = 0 THEN NULL
         ELSE o_orderdate + to_days(CAST(o_orderkey * 7 % 13 AS INTEGER)) END AS order_delivered_customer_date,
    o_orderdate + to_days(CAST(o_orderkey % 6 + 5 AS INTEGER)) AS order_estimated_delivery_date
  FROM orders
),
raw_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, n_name AS customer_state, n_regionkey AS region_key
  FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
),
raw_items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
    CAST(l_suppkey % 5 + 1 AS INTEGER) AS review_score
  FROM lineitem
)"""

# Category by counting and ranking, worst review by minimum.
ORDER_FACTS = """
category_votes AS (
  SELECT order_id, p_type AS category_name,
    row_number() OVER (PARTITION BY order_id ORDER BY count(*) DESC, p_type) AS place
  FROM raw_items JOIN part ON CAST(p_partkey AS VARCHAR) = product_id
  WHERE trim(p_type) <> ''
  GROUP BY order_id, p_type
),
order_categories AS (SELECT order_id, category_name FROM category_votes WHERE place = 1),
order_reviews AS (SELECT order_id, min(review_score) AS review_score FROM raw_items GROUP BY order_id)"""

# Windows in config order.
WINDOWS = """
known_windows(position, anomaly_id, anomaly_type, carrier, warehouse, day_from, day_to) AS (
  VALUES (1, 'ANOM_SPIKE_001', 'sharp_spike', 'CAR_B', 'WH_SOUTHEAST', DATE '1998-04-01', DATE '1998-04-14'),
         (2, 'ANOM_DRIFT_001', 'gradual_drift', NULL, 'WH_CENTRAL_WEST', DATE '1998-07-01', DATE '1998-07-28')
)"""


def enriched(months: bool = False) -> str:
    """The wide enriched orders; with `months`, only those of the last six complete months."""
    scope = ""
    if months:
        scope = "WHERE CAST(order_purchase_timestamp AS DATE) BETWEEN (SELECT day_from FROM recent) AND (SELECT day_to FROM recent)"
    return f"""
recent AS (
  SELECT date_trunc('month', newest - to_days(CASE WHEN day(newest) >= 28 THEN 0 ELSE day(newest)::INTEGER END))::DATE AS latest,
    (latest - to_months(5))::DATE AS day_from, last_day(latest) AS day_to
  FROM (SELECT max(order_purchase_timestamp)::DATE AS newest FROM raw_orders)
),
located AS (
  SELECT o.*, CAST(order_purchase_timestamp AS DATE) AS order_day, customer_state,
    CASE region_key WHEN 0 THEN 'WH_NORTH' WHEN 1 THEN 'WH_SOUTHEAST' WHEN 4 THEN 'WH_SOUTHEAST' WHEN 2 THEN 'WH_SOUTH'
      ELSE 'WH_CENTRAL_WEST' END AS warehouse_id,
    ('0x' || substr(md5('c' || order_id), 1, 8))::BIGINT / 4294967296::DOUBLE AS carrier_unit,
    ('0x' || substr(md5('i' || order_id), 1, 8))::BIGINT / 4294967296::DOUBLE AS issue_unit,
    ('0x' || substr(md5('t' || order_id), 1, 8))::BIGINT / 4294967296::DOUBLE AS type_unit
  FROM raw_orders o LEFT JOIN raw_customers c USING (customer_id)
  {scope}
),
carried AS (
  SELECT *,
    carrier_unit * CASE WHEN warehouse_id = 'WH_CENTRAL_WEST' THEN 1.23::DOUBLE ELSE 1.0::DOUBLE END AS spin,
    CASE WHEN spin < 0.33 THEN 'CAR_A' WHEN spin < 0.66 THEN 'CAR_B' WHEN spin < 0.88 THEN 'CAR_C' ELSE 'CAR_D' END AS carrier_id
  FROM located
),
tagged AS (
  SELECT order_id, arg_min(w.anomaly_id, position) AS anomaly_id, arg_min(w.anomaly_type, position) AS anomaly_type,
    arg_min(datediff('day', day_from, order_day), position) AS elapsed,
    arg_min(datediff('day', day_from, day_to), position) AS span
  FROM carried JOIN known_windows w
    ON order_day BETWEEN day_from AND day_to AND warehouse = warehouse_id AND (carrier IS NULL OR carrier = carrier_id)
  GROUP BY order_id
),
risked AS (
  SELECT c.*, coalesce(category_name, 'unknown') AS category_name, review_score, anomaly_id, anomaly_type,
    coalesce(order_delivered_customer_date::DATE > order_estimated_delivery_date::DATE, false) AS is_late,
    coalesce(review_score <= 2, false) AS is_low,
    carrier_id = 'CAR_C' AS is_weak,
    carrier_id = 'CAR_D' AND warehouse_id = 'WH_CENTRAL_WEST' AS is_exception,
    order_status = 'canceled' AS is_canceled,
    0.03::DOUBLE + if(is_late, 0.12::DOUBLE, 0) + if(is_low, 0.15::DOUBLE, 0) + if(is_weak, 0.05::DOUBLE, 0)
      + if(is_exception, 0.12::DOUBLE, 0)
      + CASE anomaly_type WHEN 'sharp_spike' THEN 0.35::DOUBLE
          WHEN 'gradual_drift' THEN 0.05::DOUBLE + 0.18::DOUBLE * (elapsed / span::DOUBLE) ELSE 0 END AS base_score,
    CASE WHEN is_canceled THEN greatest(base_score, 0.95::DOUBLE) ELSE least(base_score, 0.95::DOUBLE) END AS issue_probability
  FROM carried c
  LEFT JOIN order_categories USING (order_id)
  LEFT JOIN order_reviews USING (order_id)
  LEFT JOIN tagged USING (order_id)
),
enriched AS (
  SELECT *,
    CASE warehouse_id WHEN 'WH_NORTH' THEN 'North FC' WHEN 'WH_SOUTHEAST' THEN 'Southeast FC' WHEN 'WH_SOUTH' THEN 'South FC'
      ELSE 'Central-West FC' END AS warehouse_name,
    'Carrier ' || right(carrier_id, 1) AS carrier_name,
    CASE WHEN regexp_matches(category_name, '(LARGE|ECONOMY)') THEN 'bulky'
      WHEN regexp_matches(category_name, '(SMALL|PROMO)') THEN 'fast' ELSE 'standard' END AS sla_tier,
    CASE sla_tier WHEN 'fast' THEN 3 WHEN 'bulky' THEN 8 ELSE 5 END AS sla_target_days,
    CASE WHEN is_canceled THEN 'cancelled'
      WHEN issue_unit >= issue_probability THEN 'none'
      WHEN anomaly_type = 'sharp_spike' THEN CASE WHEN type_unit < 0.7 THEN 'damaged' WHEN type_unit < 0.9 THEN 'missing' ELSE 'wrong' END
      WHEN anomaly_type = 'gradual_drift' THEN CASE WHEN type_unit < 0.6 THEN 'failed' WHEN type_unit < 0.85 THEN 'refund' ELSE 'missing' END
      WHEN type_unit < 0.2 THEN 'missing' WHEN type_unit < 0.4 THEN 'damaged' WHEN type_unit < 0.6 THEN 'wrong'
      WHEN type_unit < 0.8 THEN 'failed' ELSE 'refund' END AS issue_type,
    list_filter(
      [if(is_late, 'late_delivery', NULL), if(is_low, 'low_review', NULL), if(is_weak, 'carrier_reliability', NULL),
       if(is_exception, 'warehouse_carrier_weakness', NULL), if(anomaly_id IS NOT NULL, 'injected_anomaly', NULL),
       if(is_canceled, 'order_canceled', NULL)],
      lambda s: s IS NOT NULL) AS signals,
    CASE WHEN issue_type = 'none' THEN 'none' ELSE coalesce(signals[-1], 'synthetic_baseline') END AS issue_source,
    issue_probability::DECIMAL(6, 4) AS synthetic_issue_probability,
    coalesce(anomaly_id, 'none') AS anomaly_flag
  FROM risked
)"""


# Shipments and the fact.
FACT = """
shipment AS (
  SELECT 'ship_' || order_id AS shipment_id, order_id, warehouse_id, carrier_id, customer_state,
    order_purchase_timestamp::DATE AS order_purchase_date,
    order_delivered_customer_date::DATE AS delivered_customer_date,
    order_estimated_delivery_date::DATE AS estimated_delivery_date,
    CAST(delivered_customer_date - order_purchase_date AS INTEGER) AS actual_delivery_days,
    CAST(estimated_delivery_date - order_purchase_date AS INTEGER) AS estimated_delivery_days,
    sla_target_days,
    CAST(greatest(delivered_customer_date - estimated_delivery_date, 0) AS INTEGER) AS delay_days,
    actual_delivery_days > sla_target_days AS sla_breach_flag,
    delivered_customer_date > estimated_delivery_date AS real_late_delivery_flag
  FROM enriched
  WHERE order_purchase_timestamp IS NOT NULL AND order_delivered_customer_date IS NOT NULL AND order_estimated_delivery_date IS NOT NULL
),
fact AS (
  SELECT s.* EXCLUDE (customer_state), category_name, sla_tier, issue_type, issue_type <> 'none' AS quality_issue_flag, anomaly_flag
  FROM shipment s JOIN enriched USING (order_id)
),
named_fact AS (
  SELECT fact.*, warehouse_name, carrier_name
  FROM fact LEFT JOIN (SELECT DISTINCT warehouse_id, warehouse_name FROM enriched) USING (warehouse_id)
  LEFT JOIN (SELECT DISTINCT carrier_id, carrier_name FROM enriched) USING (carrier_id)
)"""

# Aggregate marts, with names.
MARTS = """
daily AS (
  SELECT order_purchase_date, warehouse_id, warehouse_name, carrier_id, carrier_name, sla_tier,
    count(*) AS shipment_count,
    count(*) FILTER (sla_breach_flag) AS sla_breach_count,
    count(*) FILTER (NOT sla_breach_flag) AS on_time_count,
    round(100.0::DOUBLE * on_time_count / shipment_count, 2) AS sla_attainment_pct,
    round(avg(delay_days), 2) AS avg_delay_days,
    count(*) FILTER (real_late_delivery_flag) AS real_late_delivery_count
  FROM named_fact GROUP BY ALL
),
weekly_rows AS (
  SELECT CAST(date_trunc('week', order_purchase_date) AS DATE) AS week_start_date, warehouse_id, warehouse_name, carrier_id,
    carrier_name, category_name, issue_type, quality_issue_flag, anomaly_flag
  FROM named_fact
),
flag_order AS (
  SELECT *, rank() OVER (PARTITION BY week_start_date, warehouse_id, carrier_id, category_name, issue_type
                         ORDER BY anomaly_flag_count DESC, anomaly_flag) AS place
  FROM (SELECT week_start_date, warehouse_id, carrier_id, category_name, issue_type, anomaly_flag, count(*) AS anomaly_flag_count
        FROM weekly_rows WHERE anomaly_flag <> 'none' GROUP BY ALL)
),
dominant AS (SELECT * EXCLUDE (place) FROM flag_order WHERE place = 1),
weekly_base AS (
  SELECT week_start_date, warehouse_id, warehouse_name, carrier_id, carrier_name, category_name, issue_type,
    count(*) AS shipment_count,
    count(*) FILTER (quality_issue_flag) AS issue_count,
    round(100.0::DOUBLE * issue_count / shipment_count, 2) AS issue_rate_pct,
    count(*) FILTER (anomaly_flag <> 'none') AS anomaly_count
  FROM weekly_rows GROUP BY ALL
),
weekly AS (
  SELECT b.*, coalesce(anomaly_flag, 'none') AS dominant_anomaly_flag
  FROM weekly_base b LEFT JOIN dominant USING (week_start_date, warehouse_id, carrier_id, category_name, issue_type)
)"""

# Segment-weeks, baselines, both tracks, long result and label summary. The minimum volume is 3.
RESULTS = """
segment AS (
  SELECT CAST(date_trunc('week', order_purchase_date) AS DATE) AS week_start_date, warehouse_id, warehouse_name, carrier_id, carrier_name,
    count(*) AS shipment_count,
    count(*) FILTER (sla_breach_flag) AS sla_breach_count,
    count(*) FILTER (issue_type = 'damaged') AS damaged_issue_count,
    sla_breach_count / shipment_count::DOUBLE AS sla_breach_rate,
    damaged_issue_count / shipment_count::DOUBLE AS damaged_issue_rate
  FROM named_fact GROUP BY ALL
),
baseline AS (
  SELECT *,
    count(*) OVER prior AS prior_week_count,
    avg(sla_breach_rate) OVER prior AS sla_mean,
    stddev_samp(sla_breach_rate) OVER prior AS sla_std,
    avg(damaged_issue_rate) OVER whole AS damaged_mean,
    stddev_samp(damaged_issue_rate) OVER whole AS damaged_std
  FROM segment
  WINDOW prior AS (PARTITION BY warehouse_id, carrier_id ORDER BY week_start_date ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING),
    whole AS (PARTITION BY warehouse_id, carrier_id)
),
label AS (
  SELECT CAST(date_trunc('week', order_purchase_date) AS DATE) AS week_start_date, warehouse_id, carrier_id,
    count(*) AS known_anomaly_count, array_to_string(list_sort(list_distinct(list(anomaly_flag))), ';') AS known_anomaly_labels
  FROM fact WHERE anomaly_flag LIKE 'ANOM%' GROUP BY ALL
),
track AS (
  SELECT 'sla_breach_rate' AS detection_metric, * EXCLUDE (sla_mean, sla_std, damaged_mean, damaged_std),
    sla_mean AS center, sla_std AS spread, prior_week_count >= 4 AS ready, sla_breach_rate AS current_rate
  FROM baseline
  UNION ALL BY NAME
  SELECT 'damaged_issue_rate' AS detection_metric, * EXCLUDE (sla_mean, sla_std, damaged_mean, damaged_std),
    damaged_mean AS center, damaged_std AS spread, true AS ready, damaged_issue_rate AS current_rate
  FROM baseline
),
result AS (
  SELECT detection_metric, week_start_date, warehouse_id, warehouse_name, carrier_id, carrier_name, shipment_count, sla_breach_count,
    damaged_issue_count, round(sla_breach_rate, 4) AS sla_breach_rate, round(damaged_issue_rate, 4) AS damaged_issue_rate,
    round(center, 4) AS trailing_4_week_mean, round(spread, 4) AS trailing_4_week_std,
    round(raw_z, 4) AS z_score,
    coalesce(shipment_count >= 3 AND abs(raw_z) >= 2.0, false) AS anomaly_detected,
    coalesce(known_anomaly_count, 0) AS known_anomaly_count,
    coalesce(known_anomaly_labels, 'none') AS known_anomaly_labels
  FROM (SELECT *, CASE WHEN ready AND spread > 0 THEN (current_rate - center) / spread END AS raw_z FROM track)
  LEFT JOIN label USING (week_start_date, warehouse_id, carrier_id)
),
judged(anomaly_id, validation_metric) AS (VALUES ('ANOM_SPIKE_001', 'damaged_issue_rate'), ('ANOM_DRIFT_001', 'sla_breach_rate')),
hit AS (
  SELECT anomaly_id, r.*, row_number() OVER (PARTITION BY anomaly_id ORDER BY abs(z_score) DESC, week_start_date, warehouse_id, carrier_id) AS place
  FROM result r JOIN judged ON validation_metric = detection_metric AND list_contains(string_split(known_anomaly_labels, ';'), anomaly_id)
  WHERE anomaly_detected
),
segment_label AS (
  SELECT *, warehouse_id || ' x ' || carrier_id || ' (z=' || CAST(round(z_score, 2) AS VARCHAR) || ')' AS segment FROM hit
),
summary AS (
  SELECT anomaly_id, validation_metric, count(h.place) > 0 AS detected, min(week_start_date) AS first_detected_week,
    count(h.place) AS flagged_segment_weeks,
    coalesce(string_agg(segment, '; ' ORDER BY place) FILTER (place <= 3), '') AS top_flagged_segments
  FROM judged LEFT JOIN segment_label h USING (anomaly_id) GROUP BY anomaly_id, validation_metric
)"""


def over(body: str, *steps: str) -> str:
    """`body` after the sources and the named steps."""
    return "WITH " + ",".join((SOURCES, *steps)) + "\n" + body


def on_sources(body: str) -> str:
    return over(body)


def on_orders(body: str, months: bool = False) -> str:
    return over(body, ORDER_FACTS, WINDOWS, enriched(months))


def on_fact(body: str) -> str:
    return over(body, ORDER_FACTS, WINDOWS, enriched(), FACT)


def on_marts(body: str) -> str:
    return over(body, ORDER_FACTS, WINDOWS, enriched(), FACT, MARTS)


def on_results(body: str) -> str:
    return over(body, ORDER_FACTS, WINDOWS, enriched(), FACT, RESULTS)


def on_all(body: str) -> str:
    return over(body, ORDER_FACTS, WINDOWS, enriched(), FACT, MARTS, RESULTS)
