"""One SQL statement per registered query, over the shared steps of `prelude`."""

from __future__ import annotations

from parcelflow.oracles.prelude import on_all, on_fact, on_marts, on_orders, on_results, on_sources

FACT_COLUMNS = """shipment_id, order_id, warehouse_id, carrier_id, category_name, sla_tier, order_purchase_date,
  delivered_customer_date, estimated_delivery_date, actual_delivery_days, estimated_delivery_days, sla_target_days, delay_days,
  sla_breach_flag, real_late_delivery_flag, issue_type, quality_issue_flag, anomaly_flag"""

EARLIER = """
  SELECT * REPLACE (
    CASE WHEN order_delivered_carrier_date < DATE '1998-07-01' THEN order_delivered_carrier_date END AS order_delivered_carrier_date,
    CASE WHEN order_delivered_customer_date < DATE '1998-07-01' THEN order_delivered_customer_date END AS order_delivered_customer_date)
  FROM raw_orders WHERE order_purchase_timestamp < DATE '1998-07-01'"""
KEPT = "SELECT * FROM raw_orders WHERE order_status IS DISTINCT FROM 'canceled'"

TABLE_COUNTS = """
  SELECT 'raw_orders' AS table_name, count(*) AS row_count FROM raw_orders
  UNION ALL SELECT 'raw_order_items', count(*) FROM lineitem
  UNION ALL SELECT 'raw_products', count(*) FROM part
  UNION ALL SELECT 'raw_customers', count(*) FROM customer
  UNION ALL SELECT 'raw_reviews', count(*) FROM lineitem
  UNION ALL SELECT 'raw_payments', count(*) FROM orders
  UNION ALL SELECT 'raw_sellers', count(*) FROM supplier
  UNION ALL SELECT 'raw_geolocation', count(*) FROM nation
  UNION ALL SELECT unnest(['raw_warehouse_assignments', 'raw_carrier_assignments', 'raw_sla_targets', 'raw_issue_flags']),
    (SELECT count(*) FROM enriched)"""

ORACLES: dict[str, str] = {
    # sources
    "src_csv_scan": on_sources("SELECT * FROM raw_orders"),
    "bronze_row_counts": on_orders(TABLE_COUNTS),
    "dq_row_counts": on_orders(f"SELECT *, CASE WHEN row_count > 0 THEN 'pass' ELSE 'fail' END AS status FROM ({TABLE_COUNTS})"),
    "scalar_casts": on_sources("""
        SELECT order_id, TRY_CAST(order_id AS INTEGER) AS order_number, order_purchase_timestamp::DATE AS purchase_date,
          CAST(order_purchase_timestamp AS VARCHAR) AS purchase_text,
          TRY_CAST(strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS purchase_again,
          (order_number / 7.0::DOUBLE)::DECIMAL(12, 4) AS as_decimal,
          round(order_number / 8.0::DOUBLE, 2) AS as_rounded,
          order_number::DOUBLE AS as_double
        FROM raw_orders"""),
    # staging and marts
    "stg_orders": on_orders(
        """
        SELECT o.order_id, o.customer_id, c.customer_state, o.order_status, o.order_purchase_timestamp, o.order_approved_at,
          o.order_delivered_carrier_date, o.order_delivered_customer_date, o.order_estimated_delivery_date,
          e.warehouse_id, e.warehouse_name, e.carrier_id, e.carrier_name
        FROM raw_orders o LEFT JOIN raw_customers c USING (customer_id) LEFT JOIN enriched e USING (order_id)""",
        months=True,
    ),
    "stg_shipments": on_fact("SELECT * FROM shipment"),
    "stg_issues": on_orders("""
        SELECT order_id, issue_type, issue_source, synthetic_issue_probability, anomaly_flag,
          issue_type <> 'none' AS quality_issue_flag FROM enriched"""),
    "fct_shipments": on_fact(f"SELECT {FACT_COLUMNS} FROM fact"),
    "fct_shipments_joined": on_fact(f"SELECT {FACT_COLUMNS} FROM fact"),
    "dim_warehouse": on_orders("SELECT warehouse_id, any_value(warehouse_name) AS warehouse_name FROM enriched GROUP BY warehouse_id"),
    "dim_carrier": on_orders("SELECT carrier_id, any_value(carrier_name) AS carrier_name FROM enriched GROUP BY carrier_id"),
    "dim_category": on_orders("SELECT DISTINCT category_name, sla_tier, sla_target_days FROM enriched"),
    "dim_date": on_fact("""
        SELECT d AS date_day, year(d)::INTEGER AS year, quarter(d)::INTEGER AS quarter, month(d)::INTEGER AS month,
          left(CAST(d AS VARCHAR), 7) AS year_month, day(d)::INTEGER AS day_of_month, (isodow(d) % 7)::INTEGER AS day_of_week
        FROM (SELECT unnest(range(lo, (hi + 1)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d
              FROM (SELECT min(order_purchase_date)::TIMESTAMP AS lo, max(order_purchase_date) AS hi FROM shipment))"""),
    "agg_daily_sla": on_marts("SELECT * EXCLUDE (warehouse_name, carrier_name) FROM daily"),
    "weekly_quality_base": on_marts("SELECT * EXCLUDE (warehouse_name, carrier_name) FROM weekly_base"),
    "weekly_dominant_flag": on_marts("SELECT * FROM dominant"),
    "agg_weekly_quality": on_marts("SELECT * EXCLUDE (warehouse_name, carrier_name) FROM weekly"),
    # scoring and validation
    "weekly_segment": on_results("""
        SELECT week_start_date, warehouse_id, carrier_id, shipment_count, sla_breach_count, damaged_issue_count,
          round(sla_breach_rate, 6) AS sla_breach_rate, round(damaged_issue_rate, 6) AS damaged_issue_rate FROM segment"""),
    "scored_sla": on_results("""
        SELECT week_start_date, warehouse_id, carrier_id, prior_week_count, round(sla_mean, 4) AS trailing_4_week_mean,
          round(sla_std, 4) AS trailing_4_week_std FROM baseline"""),
    "scored_damaged": on_results("""
        SELECT week_start_date, warehouse_id, carrier_id, round(damaged_mean, 4) AS damaged_segment_mean,
          round(damaged_std, 4) AS damaged_segment_std FROM baseline"""),
    "label_rollup": on_results("SELECT * FROM label"),
    "anomaly_sla_track": on_results("SELECT * FROM result WHERE detection_metric = 'sla_breach_rate'"),
    "anomaly_damaged_track": on_results("SELECT * FROM result WHERE detection_metric = 'damaged_issue_rate'"),
    "anomaly_results": on_results("SELECT * FROM result"),
    "flagged_by_metric": on_results("""
        SELECT detection_metric, count(*) AS flagged_segment_weeks FROM result WHERE anomaly_detected GROUP BY detection_metric"""),
    "anomaly_summary": on_results("SELECT * FROM summary"),
    "top_flagged_segments": on_results("""
        SELECT anomaly_id, place::INTEGER AS segment_rank, segment, week_start_date, z_score FROM segment_label WHERE place <= 3"""),
    "spike_diagnostics": on_results("""
        SELECT detection_metric, warehouse_name, carrier_name, week_start_date, shipment_count, sla_breach_count, sla_breach_rate,
          damaged_issue_count, damaged_issue_rate, z_score, anomaly_detected, known_anomaly_count
        FROM result WHERE list_contains(string_split(known_anomaly_labels, ';'), 'ANOM_SPIKE_001')"""),
    "top_damaged_segment": on_results("""
        SELECT warehouse_name, carrier_name, week_start_date, damaged_issue_rate, z_score FROM result
        WHERE anomaly_detected AND detection_metric = 'damaged_issue_rate'
        ORDER BY abs(z_score) DESC, week_start_date, warehouse_id, carrier_id LIMIT 1"""),
    "top_sla_segment": on_results("""
        SELECT warehouse_name, carrier_name, week_start_date, sla_breach_rate, z_score FROM result
        WHERE anomaly_detected AND detection_metric = 'sla_breach_rate'
        ORDER BY abs(z_score) DESC, week_start_date, warehouse_id, carrier_id LIMIT 1"""),
    # findings
    "findings_overview": on_results("""
        SELECT count(*) AS total_shipments, min(order_purchase_date) AS date_start, max(order_purchase_date) AS date_end,
          (SELECT count(*) FROM result WHERE anomaly_detected) AS total_flagged_segment_weeks
        FROM fact"""),
    "finding_spike_inside": on_fact("""
        SELECT anomaly_id, count(order_id) AS shipments, CAST(sum((issue_type = 'damaged')::INTEGER) AS BIGINT) AS damaged_count,
          round(avg((issue_type = 'damaged')::INTEGER), 6) AS damaged_rate
        FROM known_windows LEFT JOIN fact
          ON warehouse_id = warehouse AND carrier_id = carrier AND order_purchase_date BETWEEN day_from AND day_to
        WHERE anomaly_type = 'sharp_spike' GROUP BY anomaly_id"""),
    "finding_spike_outside": on_fact("""
        SELECT anomaly_id, count(order_id) AS shipments, CAST(sum((issue_type = 'damaged')::INTEGER) AS BIGINT) AS damaged_count,
          round(avg((issue_type = 'damaged')::INTEGER), 6) AS damaged_rate
        FROM known_windows LEFT JOIN fact
          ON warehouse_id = warehouse AND carrier_id = carrier AND (order_purchase_date < day_from OR order_purchase_date > day_to)
        WHERE anomaly_type = 'sharp_spike' GROUP BY anomaly_id"""),
    "finding_spike_share": on_fact("""
        SELECT anomaly_id,
          CAST(sum((issue_type = 'damaged')::INTEGER) FILTER (warehouse_id = warehouse AND carrier_id = carrier) AS BIGINT) AS segment_damaged_count,
          count(*) FILTER (issue_type = 'damaged') AS window_damaged_count,
          round(segment_damaged_count::DOUBLE / nullif(window_damaged_count, 0), 6) AS damaged_share
        FROM known_windows JOIN fact ON order_purchase_date BETWEEN day_from AND day_to
        WHERE anomaly_type = 'sharp_spike' GROUP BY anomaly_id"""),
    "finding_drift_start_end": on_fact("""
        SELECT anomaly_id, warehouse AS affected_warehouse_id,
          count(*) FILTER (order_purchase_date < day_from + 7) AS start_shipments,
          CAST(sum(sla_breach_flag::INTEGER) FILTER (order_purchase_date < day_from + 7) AS BIGINT) AS start_breach_count,
          round(avg(sla_breach_flag::INTEGER) FILTER (order_purchase_date < day_from + 7), 6) AS start_breach_rate,
          count(*) FILTER (order_purchase_date > day_to - 7) AS end_shipments,
          CAST(sum(sla_breach_flag::INTEGER) FILTER (order_purchase_date > day_to - 7) AS BIGINT) AS end_breach_count,
          round(avg(sla_breach_flag::INTEGER) FILTER (order_purchase_date > day_to - 7), 6) AS end_breach_rate
        FROM known_windows JOIN fact ON warehouse_id = warehouse AND order_purchase_date BETWEEN day_from AND day_to
        WHERE anomaly_type = 'gradual_drift' GROUP BY anomaly_id, warehouse"""),
    "findings_text": on_results("""
        , spike AS (
          SELECT count(*) FILTER (mine AND inside) AS n_in, count(*) FILTER (mine AND inside AND hurt) AS d_in,
            count(*) FILTER (mine AND NOT inside) AS n_out, count(*) FILTER (mine AND NOT inside AND hurt) AS d_out,
            count(*) FILTER (inside AND hurt) AS d_all
          FROM (SELECT warehouse_id = 'WH_SOUTHEAST' AND carrier_id = 'CAR_B' AS mine, issue_type = 'damaged' AS hurt,
                  order_purchase_date BETWEEN DATE '1998-04-01' AND DATE '1998-04-14' AS inside FROM fact)
        ),
        drift AS (
          SELECT count(*) FILTER (early) AS n_start, count(*) FILTER (early AND sla_breach_flag) AS b_start,
            count(*) FILTER (late) AS n_end, count(*) FILTER (late AND sla_breach_flag) AS b_end
          FROM (SELECT sla_breach_flag, order_purchase_date BETWEEN DATE '1998-07-01' AND DATE '1998-07-07' AS early,
                  order_purchase_date BETWEEN DATE '1998-07-22' AND DATE '1998-07-28' AS late
                FROM fact WHERE warehouse_id = 'WH_CENTRAL_WEST')
        ),
        best AS (
          SELECT * FROM result WHERE anomaly_detected
          QUALIFY row_number() OVER (PARTITION BY detection_metric ORDER BY abs(z_score) DESC, week_start_date, warehouse_id, carrier_id) = 1
        )
        SELECT 'overview' AS section, 'total shipments' AS item, format('{:,}', count(*)) AS text FROM fact
        UNION ALL SELECT 'overview', 'date range', min(order_purchase_date) || ' to ' || max(order_purchase_date) FROM fact
        UNION ALL SELECT 'overview', 'flagged segment-weeks', format('{:,}', count(*)) FROM result WHERE anomaly_detected
        UNION ALL SELECT anomaly_id, 'detected', if(detected, 'yes', 'no') FROM summary
        UNION ALL SELECT anomaly_id, 'first detected week', coalesce(CAST(first_detected_week AS VARCHAR), 'n/a') FROM summary
        UNION ALL SELECT 'top segments', if(detection_metric = 'sla_breach_rate', 'SLA breach rate', 'damaged issue rate'),
          warehouse_name || ' x ' || carrier_name || ' on ' || week_start_date || ' ('
          || if(detection_metric = 'sla_breach_rate', 'SLA breach rate ', 'damaged issue rate ')
          || printf('%.2f%%', round(if(detection_metric = 'sla_breach_rate', sla_breach_rate, damaged_issue_rate) * 100, 2))
          || ', z-score ' || printf('%.2f', round(z_score, 2)) || ')' FROM best
        UNION ALL SELECT 'ANOM_SPIKE_001', 'damaged rate in window',
          coalesce(printf('%.2f%%', round(100 * d_in::DOUBLE / nullif(n_in, 0), 2)) || format(' ({:,} of {:,})', d_in, n_in), 'n/a (n/a of 0)') FROM spike
        UNION ALL SELECT 'ANOM_SPIKE_001', 'damaged rate outside window',
          coalesce(printf('%.2f%%', round(100 * d_out::DOUBLE / nullif(n_out, 0), 2)) || format(' ({:,} of {:,})', d_out, n_out), 'n/a (n/a of 0)') FROM spike
        UNION ALL SELECT 'ANOM_SPIKE_001', 'share of damages in window', if(n_in > 0 AND d_all > 0, printf('%.2f%%', round(100 * d_in::DOUBLE / d_all, 2)), 'n/a') FROM spike
        UNION ALL SELECT 'ANOM_DRIFT_001', 'breach rate at start',
          coalesce(printf('%.2f%%', round(100 * b_start::DOUBLE / nullif(n_start, 0), 2)) || format(' ({:,} of {:,})', b_start, n_start), 'n/a (n/a of 0)') FROM drift
        UNION ALL SELECT 'ANOM_DRIFT_001', 'breach rate at end',
          coalesce(printf('%.2f%%', round(100 * b_end::DOUBLE / nullif(n_end, 0), 2)) || format(' ({:,} of {:,})', b_end, n_end), 'n/a (n/a of 0)') FROM drift"""),
    # quality
    "dq_not_null": on_sources("""
        SELECT column_name, violations FROM (
          UNPIVOT (SELECT count(*) - count(order_id) AS order_id, count(*) - count(customer_id) AS customer_id,
            count(*) - count(order_status) AS order_status, count(*) - count(order_purchase_timestamp) AS order_purchase_timestamp,
            count(*) - count(order_approved_at) AS order_approved_at,
            count(*) - count(order_delivered_carrier_date) AS order_delivered_carrier_date,
            count(*) - count(order_delivered_customer_date) AS order_delivered_customer_date,
            count(*) - count(order_estimated_delivery_date) AS order_estimated_delivery_date FROM raw_orders)
          ON COLUMNS(*) INTO NAME column_name VALUE violations)
        WHERE violations > 0"""),
    "dq_unique": "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "dq_relationships": on_sources("""
        SELECT order_id AS key_value, count(*) AS row_count FROM raw_orders
        WHERE order_id NOT IN (SELECT order_id FROM raw_items) GROUP BY order_id"""),
    "dq_accepted_values": """
        SELECT p_type AS value, count(*) AS row_count FROM part WHERE p_type NOT IN ('SMALL', 'LARGE', 'PROMO', 'ECONOMY') GROUP BY p_type""",
    "dq_date_order": """
        SELECT * FROM (
          SELECT 'ship_' || o_orderkey AS shipment_id, o_orderkey::VARCHAR AS order_id, o_orderdate::DATE AS order_purchase_date,
            if(l_linenumber = 1, NULL, l_shipdate::DATE) AS delivered_customer_date, l_shipdate::DATE + 400 AS estimated_delivery_date
          FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
        WHERE coalesce(delivered_customer_date < order_purchase_date, false) OR estimated_delivery_date < order_purchase_date""",
    "dq_expected_counts": on_orders(
        """
        SELECT 'raw_order_items' AS table_name, (SELECT count(*) FROM lineitem) AS row_count, count(*) AS expected_rows FROM enriched""",
        months=True,
    ),
    "dq_blank_keys": on_sources(
        "SELECT 'raw_orders' AS table_name, count(*) AS violations FROM raw_orders WHERE order_status = 'canceled'"
    ),
    "dq_value_counts": on_orders("SELECT issue_type AS value, count(*) AS row_count FROM enriched GROUP BY issue_type"),
    "dq_required_values": on_orders("""
        SELECT unnest(['ANOM_SPIKE_001', 'ANOM_DRIFT_001', 'ANOM_ABSENT']) AS value EXCEPT SELECT anomaly_flag FROM enriched"""),
    "dq_detection_outcome": on_results("""
        SELECT anomaly_id, expected AS expected_metric, validation_metric, coalesce(detected, false) AS detected
        FROM (SELECT anomaly_id, validation_metric AS expected FROM judged UNION ALL SELECT 'ANOM_ABSENT', 'sla_breach_rate')
        LEFT JOIN summary USING (anomaly_id) WHERE detected IS DISTINCT FROM true"""),
    "dq_report": on_marts("""
        , checks(check_name, table_name, column_name, violations) AS (
          SELECT 'not_null', t, c, v FROM (
            SELECT unnest([
              ('stg_orders', 'order_id', (SELECT count(*) FROM raw_orders WHERE order_id IS NULL)),
              ('stg_shipments', 'shipment_id', (SELECT count(*) FROM shipment WHERE shipment_id IS NULL)),
              ('stg_shipments', 'order_id', (SELECT count(*) FROM shipment WHERE order_id IS NULL)),
              ('fct_shipments', 'shipment_id', (SELECT count(*) FROM fact WHERE shipment_id IS NULL)),
              ('dim_warehouse', 'warehouse_id', 0::BIGINT), ('dim_carrier', 'carrier_id', 0::BIGINT),
              ('dim_category', 'category_name', 0::BIGINT), ('dim_date', 'date_day', 0::BIGINT),
              ('agg_daily_sla_performance', 'order_purchase_date', (SELECT count(*) FROM daily WHERE order_purchase_date IS NULL)),
              ('agg_daily_sla_performance', 'warehouse_id', (SELECT count(*) FROM daily WHERE warehouse_id IS NULL)),
              ('agg_daily_sla_performance', 'carrier_id', (SELECT count(*) FROM daily WHERE carrier_id IS NULL)),
              ('agg_daily_sla_performance', 'sla_tier', (SELECT count(*) FROM daily WHERE sla_tier IS NULL)),
              ('agg_weekly_quality_by_segment', 'week_start_date', (SELECT count(*) FROM weekly WHERE week_start_date IS NULL)),
              ('agg_weekly_quality_by_segment', 'warehouse_id', (SELECT count(*) FROM weekly WHERE warehouse_id IS NULL)),
              ('agg_weekly_quality_by_segment', 'carrier_id', (SELECT count(*) FROM weekly WHERE carrier_id IS NULL)),
              ('agg_weekly_quality_by_segment', 'category_name', (SELECT count(*) FROM weekly WHERE category_name IS NULL)),
              ('agg_weekly_quality_by_segment', 'issue_type', (SELECT count(*) FROM weekly WHERE issue_type IS NULL))
            ]) AS cell) x(cell), LATERAL (SELECT cell[1], cell[2], cell[3]) y(t, c, v)
          UNION ALL SELECT 'unique', 'stg_orders', 'order_id', count(*) FROM (SELECT 1 FROM raw_orders GROUP BY order_id HAVING count(*) > 1)
          UNION ALL SELECT 'unique', 'stg_shipments', 'shipment_id', count(*) FROM (SELECT 1 FROM shipment GROUP BY shipment_id HAVING count(*) > 1)
          UNION ALL SELECT 'unique', 'fct_shipments', 'shipment_id', count(*) FROM (SELECT 1 FROM fact GROUP BY shipment_id HAVING count(*) > 1)
          UNION ALL SELECT 'unique', 'dim_warehouse', 'warehouse_id', count(*) FROM
            (SELECT 1 FROM (SELECT DISTINCT warehouse_id, warehouse_name FROM enriched) GROUP BY warehouse_id HAVING count(*) > 1)
          UNION ALL SELECT 'unique', 'dim_carrier', 'carrier_id', count(*) FROM
            (SELECT 1 FROM (SELECT DISTINCT carrier_id, carrier_name FROM enriched) GROUP BY carrier_id HAVING count(*) > 1)
          UNION ALL SELECT 'unique', 'dim_category', 'category_name', count(*) FROM
            (SELECT 1 FROM (SELECT DISTINCT category_name, sla_tier, sla_target_days FROM enriched) GROUP BY category_name HAVING count(*) > 1)
          UNION ALL SELECT 'unique', 'dim_date', 'date_day', 0
          UNION ALL SELECT 'relationships', 'stg_shipments', 'order_id', count(*) FROM shipment ANTI JOIN raw_orders USING (order_id)
          UNION ALL SELECT 'relationships', 'stg_shipments', c, count(*) FROM shipment, (SELECT unnest(['warehouse_id', 'carrier_id']) AS c)
            WHERE order_id NOT IN (SELECT order_id FROM enriched) GROUP BY c HAVING count(*) > 0
          UNION ALL SELECT 'relationships', 'stg_shipments', 'warehouse_id', 0
          UNION ALL SELECT 'relationships', 'stg_shipments', 'carrier_id', 0
          UNION ALL SELECT 'relationships', 'fct_shipments', 'warehouse_id', count(*) FROM fact ANTI JOIN enriched USING (warehouse_id)
          UNION ALL SELECT 'relationships', 'fct_shipments', 'carrier_id', count(*) FROM fact ANTI JOIN enriched USING (carrier_id)
          UNION ALL SELECT 'relationships', 'fct_shipments', 'category_name', count(*) FROM fact ANTI JOIN enriched USING (category_name)
          UNION ALL SELECT 'relationships', 'agg_daily_sla_performance', 'warehouse_id', count(*) FROM daily ANTI JOIN enriched USING (warehouse_id)
          UNION ALL SELECT 'relationships', 'agg_daily_sla_performance', 'carrier_id', count(*) FROM daily ANTI JOIN enriched USING (carrier_id)
          UNION ALL SELECT 'relationships', 'agg_weekly_quality_by_segment', 'warehouse_id', count(*) FROM weekly ANTI JOIN enriched USING (warehouse_id)
          UNION ALL SELECT 'relationships', 'agg_weekly_quality_by_segment', 'carrier_id', count(*) FROM weekly ANTI JOIN enriched USING (carrier_id)
          UNION ALL SELECT 'accepted_values', 'stg_issues', 'issue_type', count(*) FROM enriched
            WHERE issue_type NOT IN ('none', 'missing', 'damaged', 'wrong', 'failed', 'cancelled', 'refund')
          UNION ALL SELECT 'accepted_values', 'agg_weekly_quality_by_segment', 'issue_type', count(*) FROM weekly
            WHERE issue_type NOT IN ('none', 'missing', 'damaged', 'wrong', 'failed', 'cancelled', 'refund')
          UNION ALL SELECT 'date_order', 'stg_shipments', 'order_purchase_date', count(*) FROM shipment
            WHERE least(delivered_customer_date, estimated_delivery_date) < order_purchase_date
        )
        SELECT *, if(violations = 0, 'pass', 'fail') AS status FROM checks"""),
    # exports
    "export_fct_shipments": on_fact(f"SELECT {FACT_COLUMNS}, warehouse_name, carrier_name FROM named_fact"),
    "export_daily_sla": on_marts("SELECT * FROM daily"),
    "export_weekly_quality": on_marts("SELECT * FROM weekly"),
    "export_anomaly_summary": on_results("SELECT * REPLACE (nullif(top_flagged_segments, '') AS top_flagged_segments) FROM summary"),
    # dashboards
    "kpi_executive": on_marts("""
        SELECT sum(shipment_count)::BIGINT AS total_shipments, round(sum(on_time_count) / sum(shipment_count)::DOUBLE, 4) AS sla_attainment,
          sum(sla_breach_count)::BIGINT AS sla_breach_count, round(avg(avg_delay_days), 4) AS avg_delay_days,
          sum(real_late_delivery_count)::BIGINT AS real_late_delivery_count FROM daily"""),
    "kpi_ops": on_fact("""
        SELECT count(*) AS shipment_count, round(avg((NOT real_late_delivery_flag)::INTEGER), 4) AS on_time_delivery,
          round(avg(sla_breach_flag::INTEGER), 4) AS sla_breach_rate, round(avg(delay_days), 4) AS avg_delay_days,
          count(*) FILTER (quality_issue_flag) AS quality_issue_count FROM fact"""),
    "kpi_quality": on_all("""
        SELECT sum(shipment_count)::BIGINT AS shipment_count, round(sum(issue_count) / sum(shipment_count)::DOUBLE, 4) AS quality_issue_rate,
          sum(issue_count)::BIGINT AS issue_count, sum(anomaly_count)::BIGINT AS anomaly_count,
          (SELECT count(*) FROM summary WHERE detected) AS detected_known_anomalies FROM weekly"""),
    "kpi_avg_delay_by_carrier": on_marts("""
        SELECT carrier_name, warehouse_name, round(avg(avg_delay_days), 4) AS avg_delay_days FROM daily GROUP BY ALL"""),
    "kpi_damaged_spike": on_marts("""
        SELECT week_start_date, carrier_name, round(sum(issue_rate_pct), 4) AS damaged_issue_signal FROM weekly
        WHERE issue_type = 'damaged' AND warehouse_name = 'Southeast FC' GROUP BY ALL"""),
    "kpi_delay_distribution": on_fact("""
        SELECT (delay_days // 5 * 5)::INTEGER AS delay_days_bin, warehouse_name, count(DISTINCT shipment_id) AS shipments FROM named_fact GROUP BY ALL"""),
    "kpi_sla_trend": on_marts("""
        SELECT date_trunc('week', order_purchase_date)::DATE AS week_start_date, warehouse_name,
          round(avg(sla_attainment_pct), 4) AS avg_sla_attainment_pct FROM daily GROUP BY ALL"""),
    "kpi_breach_by_category": on_fact("""
        SELECT category_name, sla_tier, count(DISTINCT shipment_id) AS shipments FROM fact WHERE sla_breach_flag GROUP BY ALL"""),
    "kpi_breach_by_warehouse": on_marts("""
        SELECT warehouse_name, carrier_name, sum(sla_breach_count)::BIGINT AS sla_breach_count FROM daily GROUP BY ALL"""),
    "kpi_breach_trend": on_marts("""
        SELECT date_trunc('week', order_purchase_date)::DATE AS week_start_date, warehouse_name,
          sum(sla_breach_count)::BIGINT AS sla_breach_count FROM daily GROUP BY ALL"""),
    "kpi_shipments_by_segment": on_fact("""
        SELECT warehouse_name, carrier_name, sla_breach_flag, count(DISTINCT shipment_id) AS shipments FROM named_fact GROUP BY ALL"""),
    "kpi_daily_attainment": on_marts("""
        SELECT order_purchase_date, warehouse_name, round(sum(on_time_count) / sum(shipment_count)::DOUBLE, 4) AS sla_attainment
        FROM daily GROUP BY ALL"""),
    "kpi_breaches_per_warehouse": on_marts(
        "SELECT warehouse_name, sum(sla_breach_count)::BIGINT AS sla_breach_count FROM daily GROUP BY ALL"
    ),
    "kpi_carrier_tier": on_marts("""
        SELECT carrier_name, sla_tier, round(sum(on_time_count) / sum(shipment_count)::DOUBLE, 4) AS sla_attainment FROM daily GROUP BY ALL"""),
    "kpi_daily_volume": on_fact("SELECT order_purchase_date, count(*) AS shipments FROM fact GROUP BY ALL"),
    "kpi_delay_bins": on_fact("SELECT (delay_days // 5 * 5)::INTEGER AS delay_days_bin, count(*) AS shipments FROM fact GROUP BY ALL"),
    "kpi_breach_pivot": on_fact("""
        SELECT warehouse_name, """ + ", ".join(
        f"""round(avg(sla_breach_flag::INTEGER) FILTER (carrier_name = 'Carrier {c}'), 4) AS "Carrier {c}" """ for c in "ABCD"
    ) + """ FROM named_fact GROUP BY warehouse_name"""),
    "kpi_category_view": on_fact("""
        SELECT category_name, count(*) AS shipments, round(avg(actual_delivery_days), 4) AS avg_delivery_days FROM fact GROUP BY ALL"""),
    "kpi_shipment_detail": on_fact("""
        SELECT order_id, warehouse_name, carrier_name, category_name, sla_tier, actual_delivery_days, sla_target_days, issue_type,
          anomaly_flag, if(anomaly_flag = 'none', 'No injected anomaly', anomaly_flag) AS anomaly_label FROM named_fact"""),
    "kpi_weekly_issue_rate": on_marts("""
        SELECT week_start_date, issue_type, round(sum(issue_count) / sum(shipment_count)::DOUBLE, 4) AS quality_issue_rate
        FROM weekly GROUP BY ALL"""),
    "kpi_quality_heatmap": on_marts("""
        SELECT warehouse_name, """ + ", ".join(
        f"""round(sum(issue_count) FILTER (carrier_name = 'Carrier {c}')
            / sum(shipment_count) FILTER (carrier_name = 'Carrier {c}')::DOUBLE, 4) AS "Carrier {c}" """ for c in "ABCD"
    ) + """ FROM weekly GROUP BY warehouse_name"""),
    "kpi_category_issues": on_marts("SELECT category_name, issue_type, sum(issue_count)::BIGINT AS issue_count FROM weekly GROUP BY ALL"),
    "kpi_filtered_quality": on_marts("""
        SELECT week_start_date, issue_type, round(sum(issue_count) / sum(shipment_count)::DOUBLE, 4) AS quality_issue_rate FROM weekly
        WHERE week_start_date BETWEEN DATE '1998-01-05' AND DATE '1998-12-28' AND warehouse_name IN ('Southeast FC', 'South FC')
          AND carrier_name = 'Carrier B' AND issue_type IN ('damaged', 'missing') GROUP BY ALL"""),
    # enrichment
    "enrich_six_month_window": on_orders("SELECT order_id, order_purchase_timestamp FROM enriched", months=True),
    "enrich_warehouse": on_orders("SELECT order_id, customer_state, warehouse_id, warehouse_name FROM enriched"),
    "enrich_carrier_assignment": on_orders("SELECT order_id, warehouse_id, carrier_id, carrier_name FROM enriched"),
    "enrich_order_category": on_orders("SELECT * FROM order_categories"),
    "enrich_sla_tier": on_orders("SELECT order_id, category_name, sla_tier, sla_target_days FROM enriched"),
    "enrich_min_review": on_orders("SELECT * FROM order_reviews"),
    "enrich_anomaly_window": on_orders("SELECT order_id, anomaly_flag, anomaly_type FROM enriched"),
    "enrich_anomaly_window_join": on_orders("""
        SELECT order_id, coalesce(anomaly_id, 'none') AS anomaly_flag, anomaly_type FROM carried LEFT JOIN tagged USING (order_id)"""),
    "enrich_risk_score": on_orders("""
        SELECT order_id, round(issue_probability, 6) AS issue_probability, synthetic_issue_probability FROM enriched"""),
    "enrich_risk_signals": on_orders("SELECT order_id, array_to_string(signals, ';') AS signals, issue_source FROM enriched"),
    "enrich_issue_type": on_orders("SELECT order_id, issue_type, issue_source FROM enriched"),
    "enrich_order_count": on_orders("""
        SELECT unnest(['raw_warehouse_assignments', 'raw_carrier_assignments', 'raw_sla_targets', 'raw_issue_flags']) AS table_name,
          (SELECT count(*) FROM enriched) AS row_count"""),
    # time joins and changes
    "asof_join": """
        SELECT e.event_id, e.user_id, p.event_id AS prior_event_id, p.event_type AS prior_event_type,
          epoch_us(e.ts) - epoch_us(p.ts) AS micros_apart
        FROM events e LEFT JOIN (
          SELECT a.event_id AS id, b.event_id, b.event_type, b.ts
          FROM events a ASOF JOIN (
            SELECT user_id, ts, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id, ts
          ) b ON a.user_id = b.user_id AND a.ts > b.ts
          WHERE a.ts - b.ts <= INTERVAL 1 DAY
        ) p ON e.event_id = p.id""",
    "asof_purchase": """
        SELECT e.event_id, e.user_id, p.event_id AS purchase_id, p.value AS purchase_value
        FROM (SELECT * FROM events WHERE event_type = 'error') e ASOF LEFT JOIN (
          SELECT user_id, ts, max(event_id) AS event_id, arg_max(value, event_id) AS value
          FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts
        ) p ON e.user_id = p.user_id AND e.ts >= p.ts""",
    "overlap_join": """
        WITH spans AS (
          SELECT event_id, event_type, epoch_us(ts) AS starts, epoch_us(ts) + floor(value
            * (CASE WHEN event_type = 'click' OR value > 150 THEN 60 ELSE 1 END) * 1000000)::BIGINT AS ends
          FROM events
        )
        SELECT v.event_id AS visit_id, o.event_id AS outage_id
        FROM spans v JOIN spans o ON v.event_type = 'click' AND o.event_type = 'error'
          AND (v.starts BETWEEN o.starts AND o.ends OR o.starts BETWEEN v.starts AND v.ends)""",
    "dq_table_diff": on_sources(f"""
        SELECT coalesce(a.order_id, b.order_id) AS order_id,
          CASE WHEN a.order_id IS NULL THEN 'added' WHEN b.order_id IS NULL THEN 'removed' ELSE 'changed' END AS change,
          (a.order_id IS NOT NULL)::BIGINT AS old_rows, (b.order_id IS NOT NULL)::BIGINT AS new_rows
        FROM ({EARLIER}) a FULL JOIN ({KEPT}) b ON a.order_id IS NOT DISTINCT FROM b.order_id
        WHERE a.order_id IS NULL OR b.order_id IS NULL
          OR a.order_delivered_carrier_date IS DISTINCT FROM b.order_delivered_carrier_date
          OR a.order_delivered_customer_date IS DISTINCT FROM b.order_delivered_customer_date"""),
    "table_diff_applied": on_sources(KEPT),
}
ORACLES |= {
    # streams, subtotals, sketches, calendars, islands
    "stream_daily_flag_counts": on_fact("""
        SELECT order_purchase_date, warehouse_id, carrier_id, anomaly_flag, count(*) AS shipments,
          count(*) FILTER (sla_breach_flag) AS breaches, count(*) FILTER (issue_type = 'damaged') AS damages
        FROM fact GROUP BY ALL"""),
    "sla_subtotals": on_fact("""
        SELECT warehouse_id, carrier_id, sla_tier, GROUPING(warehouse_id, carrier_id, sla_tier)::INTEGER AS grouping_id, count(*) AS shipment_count,
          count(*) FILTER (sla_breach_flag) AS sla_breach_count,
          round(100.0::DOUBLE * count(*) FILTER (NOT sla_breach_flag) / count(*), 2) AS sla_attainment_pct
        FROM fact GROUP BY CUBE (warehouse_id, carrier_id, sla_tier)"""),
    "sketch_weekly_delay": on_fact("""
        SELECT date_trunc('week', order_purchase_date)::DATE AS week_start_date, warehouse_id, count(*) AS rows,
          TRUE AS distinct_near, TRUE AS quantiles_near
        FROM fact GROUP BY ALL"""),
    "kpi_shipments_by_segment_approx": on_fact("""
        SELECT DISTINCT warehouse_name, carrier_name, sla_breach_flag, TRUE AS shipments_near FROM named_fact"""),
    "calendar_baseline": on_results("""
        SELECT s.week_start_date, s.warehouse_id, s.carrier_id, s.shipment_count, s.sla_breach_count, baseline_shipments, baseline_breaches,
          greatest(0, least(4, (s.week_start_date - first_week) // 7) - weeks)::BIGINT AS empty_weeks,
          round(100.0::DOUBLE * baseline_breaches / nullif(baseline_shipments, 0), 4) AS baseline_breach_pct
        FROM (
          SELECT *, min(week_start_date) OVER (PARTITION BY warehouse_id, carrier_id) AS first_week,
            coalesce(sum(shipment_count) OVER month, 0)::BIGINT AS baseline_shipments,
            coalesce(sum(sla_breach_count) OVER month, 0)::BIGINT AS baseline_breaches, count(*) OVER month AS weeks
          FROM segment
          WINDOW month AS (PARTITION BY warehouse_id, carrier_id ORDER BY week_start_date
            RANGE BETWEEN INTERVAL 28 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING)
        ) s"""),
    "event_sessions": """
        SELECT user_id, session, count(*) AS event_count, count(*) FILTER (event_type = 'purchase') AS purchases,
          max(epoch_us(ts)) - min(epoch_us(ts)) AS length_micros
        FROM (
          SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts)::BIGINT AS session
          FROM (SELECT *, ((ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 6 HOURS) IS NOT TRUE)::INTEGER AS fresh FROM events)
        )
        GROUP BY user_id, session""",
    "flagged_streaks": on_results("""
        SELECT detection_metric, warehouse_id, carrier_id, min(week_start_date) AS first_week, max(week_start_date) AS last_week, count(*) AS weeks
        FROM (
          SELECT *, week_start_date - 7 * row_number() OVER (PARTITION BY detection_metric, warehouse_id, carrier_id ORDER BY week_start_date)::INTEGER AS island
          FROM result WHERE anomaly_detected
        )
        GROUP BY detection_metric, warehouse_id, carrier_id, island"""),
}
ORACLES |= {
    # payloads, quarantine, multisets
    "event_payloads": """
        SELECT event_id, event_type, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
          array_to_string(list_sort(list_filter(json_keys(props), lambda x: x <> 'k')), ',') AS further_keys,
          CASE WHEN props IS NULL OR trim(props) = '' THEN 'missing' WHEN NOT json_valid(props) THEN 'malformed'
            WHEN json_type(props) <> 'OBJECT' THEN 'no object' WHEN json_extract_string(props, '$.k') IS NULL THEN 'absent field'
            WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NULL THEN 'wrong type' END AS payload_fault
        FROM events""",
    "src_csv_quarantine": on_sources("""
        SELECT CASE order_status WHEN 'shipped' THEN 'wrong number of values' WHEN 'canceled' THEN 'no timestamp_ntz in order_purchase_timestamp'
            ELSE 'good' END AS outcome, coalesce(order_status, '') AS order_status, count(*) AS lines
        FROM raw_orders GROUP BY ALL"""),
    "dq_multiset_diff": on_sources(f"""
        SELECT customer_id, order_status, order_estimated_delivery_date, sum(l)::BIGINT AS left_count, sum(r)::BIGINT AS right_count,
          least(left_count, right_count) AS common, greatest(left_count - right_count, 0) AS left_surplus, greatest(right_count - left_count, 0) AS right_surplus
        FROM (
          SELECT customer_id, order_status, order_estimated_delivery_date, 1 AS l, 0 AS r FROM ({EARLIER})
          UNION ALL SELECT customer_id, order_status, order_estimated_delivery_date, 0, 1 FROM ({KEPT})
        )
        GROUP BY customer_id, order_status, order_estimated_delivery_date HAVING sum(l) <> sum(r)"""),
}
ORACLES["incremental_weekly_quality"] = ORACLES["agg_weekly_quality"]
