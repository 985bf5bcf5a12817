"""Check SQL: what each query must give, over the same tables, in DuckDB's dialect."""

from __future__ import annotations

import re

RUN_TS = "TIMESTAMP '2024-02-01 00:00:00'"


def _hash(**columns: str) -> str:
    """The row hash over named texts."""
    parts = [
        f"coalesce(CAST(length({text}) AS VARCHAR) || ':' || {text}, '-')"
        for _, text in sorted(columns.items())
    ]
    return f"sha256({' || '.join(parts)})"


def _text(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


def _time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


ASSET_HASH = _hash(
    **{c: c for c in ("company", "asset_id", "home_branch", "current_branch", "status",
                      "delete_code", "serial", "priority")},
    **{c: _text(c) for c in ("category", "class_code", "price")},
)
EVENT_HASH = _hash(
    **{c: c for c in ("company", "branch", "event")},
    **{c: _text(c) for c in ("category", "class_code", "seq", "qty")},
    synced_at=_time("synced_at"),
)
SNAPSHOT_HASH = _hash(
    **{c: c for c in ("company", "branch")},
    **{c: _text(c) for c in ("category", "class_code", "qty")},
)

KEY = "company, branch, category, class_code"
EVENT_KEY = f"{KEY}, event, seq, synced_at"
ASSET_KEY = "company, asset_id"
ENTRY = "company, asset_id, branch, category, class_code"
KEY_NOW = "company, current_branch, category, class_code"

# Stand-in tables; a definition may use the ones before it.
CTES = {
    "assets": """
        SELECT CASE WHEN o_custkey % 4 = 0 THEN '02' ELSE '01' END AS company, 'A' || o_orderkey AS asset_id,
               1 + o_custkey % 25 AS category, 1 + o_orderkey % 50 AS class_code,
               right('0000' || (o_custkey % 25), 4) AS home_branch,
               right('0000' || (o_orderkey % 25), 4) AS current_branch,
               CASE WHEN o_orderstatus = 'F' THEN 'I' ELSE 'A' END AS status,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'D' ELSE 'A' END AS delete_code,
               ' S' || o_custkey || ' ' AS serial, o_orderpriority AS priority,
               CAST(o_totalprice AS DECIMAL(12,2)) AS price, o_orderdate AS synced_at
        FROM orders""",
    "assets_before": """
        SELECT * REPLACE (CASE WHEN priority = '1-URGENT' THEN 'X' ELSE status END AS status)
        FROM assets WHERE synced_at < TIMESTAMP '2000-01-01'""",
    "prints": f"SELECT {ASSET_KEY}, {ASSET_HASH} AS hash FROM assets",
    "prints_before": f"SELECT {ASSET_KEY}, {ASSET_HASH} AS hash FROM assets_before",
    "active": """
        SELECT CAST(100 + n_nationkey AS BIGINT) AS id, '01' AS company,
               right('0000' || n_nationkey, 4) AS branch
        FROM nation WHERE n_regionkey < 3
        UNION ALL
        SELECT CAST(200 + n_nationkey AS BIGINT), '02', right('0000' || n_nationkey, 4)
        FROM nation WHERE n_regionkey > 1""",
    "sku_master": """
        SELECT c.company, category, class_code, description,
               CASE WHEN (category + class_code) % 2 = 0 THEN 'Y' ELSE 'N' END AS bulk,
               'P' || category || 'X' || class_code AS item
        FROM (SELECT CAST(substr(p_brand, 7) AS BIGINT) AS category,
                     CAST(p_size AS BIGINT) AS class_code, min(p_name) AS description
              FROM part GROUP BY 1, 2)
        JOIN (VALUES ('01'), ('02')) c(company) ON c.company = '01' OR class_code % 3 <> 0""",
    "qty_events": """
        SELECT CASE WHEN user_id % 4 = 0 THEN '02' ELSE '01' END AS company, right('0000' || (user_id % 25), 4) AS branch,
               1 + (user_id // 25) % 25 AS category,
               CAST(CASE event_type WHEN 'click' THEN 5 WHEN 'view' THEN 10
                    WHEN 'purchase' THEN 15 WHEN 'signup' THEN 20 ELSE 25 END AS BIGINT)
                    AS class_code,
               upper(substr(event_type, 1, 2)) AS event, event_id AS seq, ts AS synced_at,
               CAST(floor(value) AS BIGINT) AS qty
        FROM events""",
    "qty_snapshot": f"SELECT {KEY}, max(qty) AS qty FROM qty_events GROUP BY {KEY}",
    "event_state": """
        SELECT * FROM qty_events WHERE synced_at < TIMESTAMP '2024-01-10'
        UNION ALL
        SELECT * REPLACE (synced_at - INTERVAL 100 DAY AS synced_at)
        FROM qty_events WHERE event = 'CL'""",
    "lagged": f"""
        SELECT *, lag(qty, 1, 0) OVER (PARTITION BY {KEY} ORDER BY seq) AS prev_qty
        FROM qty_events""",
    "deltas": f"""
        SELECT l.* REPLACE (CASE WHEN l.prev_qty = 0 THEN coalesce(s.qty, 0)
                            ELSE l.prev_qty END AS prev_qty)
        FROM lagged l LEFT JOIN qty_snapshot s USING ({KEY})""",
    "quantity_changes": f"""
        SELECT {EVENT_KEY}, qty, qty - prev_qty AS qty_to_send,
               CASE WHEN EXISTS (
                   SELECT 1 FROM event_state e
                   WHERE e.company = d.company AND e.branch = d.branch
                     AND e.category = d.category AND e.class_code = d.class_code
                     AND e.event = d.event AND e.seq = d.seq)
               THEN 'UPD' ELSE 'NEW' END AS change_type
        FROM deltas d
        WHERE synced_at BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'
          AND qty - prev_qty > 0
          AND (company, category, class_code) IN
              (SELECT (company, category, class_code) FROM sku_master WHERE bulk = 'Y')
          AND (company, branch) IN (SELECT (company, branch) FROM active)""",
    "rollup": f"""
        SELECT {KEY}, CAST(sum(qty_to_send) AS BIGINT) AS qty, 'RC' AS status
        FROM quantity_changes GROUP BY {KEY}""",
    "diff": f"""
        SELECT {ASSET_KEY}, CASE WHEN b.hash IS NULL THEN 'NEW' ELSE 'UPD' END AS change_type
        FROM prints p LEFT JOIN prints_before b USING ({ASSET_KEY})
        WHERE b.hash IS NULL OR b.hash <> p.hash""",
    "asset_queue": """
        SELECT 'r0' AS run_id, company, asset_id,
               CASE WHEN category % 3 = 0 THEN home_branch ELSE current_branch END AS branch,
               right('000' || category, 3) AS category,
               right('0000' || (class_code + CASE WHEN category % 5 = 0 THEN 1 ELSE 0 END), 4)
                   AS class_code,
               CAST(1 AS BIGINT) AS reason, synced_at AS detected_at,
               CASE WHEN status = 'I' THEN synced_at END AS sent_at
        FROM assets WHERE priority IN ('2-HIGH', '3-MEDIUM')""",
    "feed": """
        SELECT d.* FROM diff d JOIN assets a USING (company, asset_id)
        JOIN active b ON b.company = a.company AND b.branch = a.current_branch""",
    "changes": f"""
        SELECT * FROM feed
        UNION ALL
        SELECT {ASSET_KEY}, 'UPD' FROM asset_queue
        WHERE sent_at IS NULL
          AND ({ASSET_KEY}) NOT IN (SELECT ({ASSET_KEY}) FROM feed)""",
    "bulk_queue": """
        SELECT 'r' || l_linenumber AS run_id, CASE WHEN l_suppkey % 4 = 0 THEN '02' ELSE '01' END AS company,
               right('0000' || (l_suppkey % 25), 4) AS branch,
               1 + l_partkey % 25 AS category, 1 + l_partkey % 50 AS class_code,
               CAST(l_quantity AS BIGINT) AS qty,
               CASE WHEN l_returnflag = 'N' THEN 'RC' ELSE 'RT' END AS status,
               l_shipdate AS detected_at,
               CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS sent_at
        FROM lineitem""",
    "master_skus": """
        SELECT a.id AS pc_id, m.company, a.branch, m.category, m.class_code,
               right('0000' || m.class_code, 4) AS product_id, m.description,
               right('000' || m.category, 3) AS upc,
               right('000' || m.category, 3) || '-' || right('0000' || m.class_code, 4) AS label,
               false AS is_consumable, m.bulk = 'Y' AS is_bulk
        FROM sku_master m JOIN active a USING (company)""",
    "asset_skus": f"""
        SELECT * FROM master_skus WHERE NOT is_bulk AND ({KEY}) IN
          (SELECT (company, current_branch, category, class_code) FROM assets
           WHERE delete_code = 'A' AND ({ASSET_KEY}) IN (SELECT ({ASSET_KEY}) FROM changes))""",
    "bulk_skus": f"""
        SELECT * FROM master_skus
        WHERE is_bulk AND ({KEY}) IN (SELECT ({KEY}) FROM quantity_changes)""",
    "listed": "SELECT * FROM asset_skus UNION ALL SELECT * FROM bulk_skus",
    "remote_keys": f"""
        SELECT company, current_branch AS branch, category, class_code FROM assets_before
        UNION SELECT {KEY} FROM qty_events WHERE event <> 'ER'""",
    "remote_skus": """
        SELECT CASE WHEN class_code = 20 THEN 0
               ELSE (CASE WHEN company = '02' THEN 200 ELSE 100 END + CAST(branch AS BIGINT)) * 10000000
                    + category * 10000 + class_code
               END AS sku_id,
               CASE WHEN company = '02' THEN 200 ELSE 100 END + CAST(branch AS BIGINT) AS location_id,
               right('000' || category, 3) AS upc, right('0000' || class_code, 4) AS product_id
        FROM remote_keys""",
    "resolved": """
        SELECT l.*, l.pc_id AS location_id, coalesce(r.sku_id, 0) AS sku_id
        FROM listed l LEFT JOIN remote_skus r
          ON r.location_id = l.pc_id AND r.upc = l.upc AND r.product_id = l.product_id""",
    "held_bulk": f"""
        SELECT 'run-1' AS run_id, {KEY}, qty, status, CAST(1 AS BIGINT) AS reason,
               {RUN_TS} AS detected_at, CAST(NULL AS TIMESTAMP) AS sent_at
        FROM rollup
        WHERE ({KEY}) NOT IN (SELECT ({KEY}) FROM resolved WHERE is_bulk AND sku_id <> 0)""",
    "waiting_bulk": f"""
        SELECT run_id, {KEY}, status, qty, detected_at FROM bulk_queue
        WHERE sent_at IS NULL AND ({KEY}, status) IN (SELECT ({KEY}, status) FROM held_bulk)
        UNION ALL
        SELECT run_id, {KEY}, status, qty, detected_at FROM held_bulk""",
    "replayed": f"""
        SELECT {KEY}, status, CAST(sum(qty) AS BIGINT) AS qty FROM bulk_queue
        WHERE sent_at IS NULL
          AND ({KEY}) IN (SELECT ({KEY}) FROM resolved WHERE is_bulk AND sku_id <> 0)
        GROUP BY {KEY}, status""",
    "send_list": f"""
        SELECT * FROM (
            SELECT {KEY}, qty, status, CAST(0 AS BIGINT) AS source_rank FROM rollup
            UNION ALL SELECT {KEY}, qty, status, 1 FROM replayed)
        WHERE ({KEY}) NOT IN (SELECT ({KEY}) FROM held_bulk)""",
    "positions": f"""
        SELECT company, asset_id, current_branch AS branch, category, class_code,
               ({KEY_NOW}) IN (SELECT ({KEY}) FROM resolved WHERE NOT is_bulk AND sku_id <> 0) AS ready
        FROM assets
        WHERE ({ASSET_KEY}) IN (SELECT ({ASSET_KEY}) FROM changes)
          AND (company, current_branch) IN (SELECT (company, branch) FROM active)""",
    "places": f"""
        SELECT {ASSET_KEY}, branch, right('000' || category, 3) AS category,
               right('0000' || class_code, 4) AS class_code, ready
        FROM positions""",
    "held_assets": f"""
        SELECT 'run-1' AS run_id, {ENTRY}, CAST(1 AS BIGINT) AS reason, {RUN_TS} AS detected_at,
               CAST(NULL AS TIMESTAMP) AS sent_at
        FROM places
        WHERE NOT ready
          AND ({ENTRY}) NOT IN (SELECT ({ENTRY}) FROM asset_queue WHERE sent_at IS NULL)""",
    "queue_now": "SELECT * FROM asset_queue UNION ALL SELECT * FROM held_assets",
    "settled": f"""
        SELECT CASE WHEN done THEN 'run-1' ELSE run_id END AS run_id, {ENTRY}, reason, detected_at,
               CASE WHEN done THEN {RUN_TS} ELSE sent_at END AS sent_at
        FROM (SELECT *, sent_at IS NULL
                     AND ({ASSET_KEY}) IN (SELECT ({ASSET_KEY}) FROM places)
                     AND ({ENTRY}) NOT IN (SELECT ({ENTRY}) FROM places WHERE NOT ready) AS done
              FROM queue_now)""",
    "sendable": f"""
        SELECT * FROM changes
        WHERE ({ASSET_KEY}) IN (SELECT ({ASSET_KEY}) FROM positions WHERE ready)""",
    "prior": """
        SELECT company, asset_id, trim(serial) AS serial FROM assets_before
        WHERE status = 'A' AND (company, home_branch) IN (SELECT (company, branch) FROM active)""",
    "remote_items": """
        SELECT location_id, location_id * 10000000 + category * 10000 + class_code AS sku_id,
               CASE qty WHEN 0 THEN 'nounderscore' WHEN 1 THEN stem WHEN 2 THEN stem || 'x'
               ELSE stem || qty END AS asset_id
        FROM (SELECT *, CASE WHEN company = '02' THEN 200 ELSE 100 END + CAST(branch AS BIGINT) AS location_id,
                     'P' || category || 'X' || class_code || '_' || branch || '_' AS stem
              FROM qty_events)""",
    "tags": """
        SELECT location_id, sku_id,
               CAST(max(coalesce(try_cast(split_part(asset_id, '_', -1) AS INTEGER), 0)) AS BIGINT)
                   AS max_tag
        FROM remote_items WHERE regexp_matches(asset_id, '_[0-9]') GROUP BY 1, 2""",
    "source_units": f"""
        SELECT {KEY}, source_rank, CAST(sum(qty) AS BIGINT) AS units FROM send_list
        WHERE qty >= 1 GROUP BY {KEY}, source_rank""",
    "ranges": f"""
        SELECT u.*, r.location_id, r.sku_id, m.item,
               coalesce(t.max_tag, 0)
                 + CAST(coalesce(sum(u.units) OVER (PARTITION BY {", ".join("u." + c for c in KEY.split(", "))}
                        ORDER BY u.source_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                   AS BIGINT) AS after_tag
        FROM source_units u
        JOIN (SELECT * FROM resolved WHERE is_bulk AND sku_id <> 0) r USING ({KEY})
        JOIN sku_master m USING (company, category, class_code)
        LEFT JOIN tags t ON t.location_id = r.location_id AND t.sku_id = r.sku_id""",
    "unit_tags": """
        SELECT location_id, sku_id, after_tag + n AS tag_no,
               item || '_' || right('0000' || branch, 4) || '_' || (after_tag + n) AS tag
        FROM (SELECT *, unnest(range(1, units + 1)) AS n FROM ranges)""",
    "control": """
        SELECT event_type AS source,
               CASE WHEN event_type <> 'error' THEN
                   CAST(CAST(min(ts) AS DATE) AS TIMESTAMP) + to_days(CAST(length(event_type) AS INTEGER))
               END AS start_ts
        FROM events GROUP BY event_type""",
    "bounds": """
        SELECT source, coalesce(start_ts, TIMESTAMP '2024-01-20') AS start,
               TIMESTAMP '2024-01-20' AS "end"
        FROM control""",
    "sites": """
        SELECT c_custkey AS site_id, CASE WHEN c_custkey % 4 = 0 THEN '02' ELSE '01' END AS company, right('0000' || c_nationkey, 4) AS branch, c_custkey AS k,
               c_name, c_mktsegment
        FROM customer""",
    "remote_sites": """
        SELECT s_suppkey * 3 AS site_id, CASE WHEN s_suppkey % 4 = 0 THEN '02' ELSE '01' END AS company, CAST(1000 + s_nationkey * 10 + s_suppkey % 3 AS BIGINT)
               AS location_id, CAST(s_suppkey AS VARCHAR) AS account, 'J' || s_suppkey AS job,
               'BUILDING' AS job_location, right('0000' || s_nationkey, 4) AS branch
        FROM supplier""",
}

_SENT = f"""
        SELECT CASE WHEN done THEN 'run-1' ELSE run_id END AS run_id, {KEY}, qty, status, detected_at,
               CASE WHEN done THEN {RUN_TS} ELSE sent_at END AS sent_at
        FROM (SELECT *, sent_at IS NULL AND ({KEY}) IN (SELECT ({KEY}) FROM send_list) AS done
              FROM bulk_queue)"""

_RISE = "CASE WHEN qty > prev_qty THEN qty - prev_qty ELSE 0 END AS rise"

_ASSET_FEED = """
        SELECT b.id AS "HQLocationID", s.sku_id AS "HQSKUID", a.asset_id AS "TagID",
               a.asset_id AS "AssetID", trim(a.serial) AS "SerialNumber", p.serial AS "PrevSerial"
        FROM sendable c
        JOIN assets a USING (company, asset_id)
        JOIN active b ON b.company = a.company AND b.branch = a.current_branch
        JOIN resolved s ON s.company = a.company AND s.branch = a.current_branch
          AND s.category = a.category AND s.class_code = a.class_code
          AND NOT s.is_bulk AND s.sku_id <> 0
        LEFT JOIN prior p ON p.company = a.company AND p.asset_id = a.asset_id"""

_FLAGGED = """
        SELECT l.*, r.upc IS NULL AS missing FROM listed l
        LEFT JOIN remote_skus r ON r.location_id = l.pc_id AND r.upc = l.upc
          AND r.product_id = l.product_id"""


def _sku_payload(where: str) -> str:
    stamp = "'2024-02-01 00:00:00.000'"
    return f"""
        SELECT {stamp} AS "DateAdded", {stamp} AS "LastUpdated", {stamp} AS "LastNotification",
               pc_id AS "HQLocationID", upc AS "UPC", product_id AS "ProductID",
               label AS "SKUListType", description AS "Description",
               CAST(0 AS BIGINT) AS "IsConsumable", CAST(1 AS BIGINT) AS "IsActive",
               CAST(1 AS BIGINT) AS "QuantityOnHand"
        FROM ({_FLAGGED}) WHERE {where}"""


_MATCHED = """
        SELECT s.site_id AS "CJID", r.location_id AS "HQLocationID", s.company AS "CompanyCode",
               CAST(k AS VARCHAR) AS "AccountNumber", 'J' || k AS "JobNumber",
               c_mktsegment AS "JobLocation", 'contact ' || k AS "ContactName", c_name AS "Name",
               k || ' Main St' AS "Address1", 'Unit ' || k AS "Address2",
               'Springfield' AS "City", 'OH' AS "State", right('00000' || k, 5) AS "Zip",
               200 + k % 700 AS "OrderedByAreaCode", 5550000 + k % 10000 AS "OrderedByPhone",
               CAST(k % 97 AS VARCHAR) AS "SalesRep", 'PO' || k AS "PONumber"
        FROM sites s JOIN remote_sites r ON """

_BY_ANY_RULE = f"""
        {_MATCHED} r.site_id = s.site_id
        UNION {_MATCHED} r.branch = s.branch AND r.account = CAST(k AS VARCHAR)
          AND r.job = 'J' || k AND r.job_location = c_mktsegment
        UNION {_MATCHED} r.branch = s.branch"""

_QUEUED_BULK = """
        SELECT * FROM master_skus
        WHERE is_bulk AND ({key}) IN (SELECT ({key}) FROM bulk_queue WHERE qty > 0 {unsent})
          AND ({but}) NOT IN (SELECT ({but}) FROM listed)"""

BODIES = {
    "fingerprint_orders": "SELECT o_orderkey, "
    + _hash(
        o_orderkey=_text("o_orderkey"), o_custkey=_text("o_custkey"),
        o_orderstatus="o_orderstatus", o_totalprice=_text("CAST(o_totalprice AS DECIMAL(12,2))"),
        o_orderdate=_time("o_orderdate"), o_orderpriority="o_orderpriority",
    )
    + " AS hash FROM orders",
    "interval_scan_events": f"""
        SELECT {EVENT_KEY}, qty FROM qty_events
        WHERE synced_at BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'""",
    "interval_bounds": "SELECT * FROM bounds",
    "scan_by_source": """
        SELECT event_id, ts, event_type FROM events JOIN bounds ON source = event_type
        WHERE ts BETWEEN start AND "end\"""",
    "scan_by_source_partitioned": """
        SELECT event_id, ts, event_type FROM events JOIN bounds ON source = event_type
        WHERE ts BETWEEN start AND "end\"""",
    "forced_scan_orders": f"""
        SELECT {ASSET_KEY}, home_branch, current_branch, synced_at FROM assets
        WHERE (home_branch = '0007' OR current_branch = '0007')
          AND (company, '0007') IN (SELECT (company, branch) FROM active)
          AND NOT (synced_at BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '2002-01-01')""",
    "snapshot_diff_orders": "SELECT * FROM diff",
    "snapshot_diff_buckets": "SELECT * FROM diff",
    "snapshot_diff_deletes": f"""
        SELECT {ASSET_KEY}, CASE WHEN b.hash IS NULL THEN 'DEL' ELSE 'UPD' END AS change_type
        FROM prints p LEFT JOIN prints_before b USING ({ASSET_KEY})
        WHERE b.hash IS NULL OR b.hash <> p.hash""",
    "active_change_feed": "SELECT * FROM feed",
    "queue_replay_changes": "SELECT * FROM changes",
    "restrict_to_changes": """
        SELECT 'A' || l_orderkey AS asset_id, CAST(l_linenumber AS BIGINT) AS l_linenumber,
               l_partkey, CAST(l_quantity AS BIGINT) AS qty
        FROM lineitem WHERE 'A' || l_orderkey IN (SELECT asset_id FROM diff)""",
    "quantity_delta_events": f"SELECT {EVENT_KEY}, qty, prev_qty, {_RISE} FROM lagged",
    "quantity_delta_sliced": f"SELECT {EVENT_KEY}, qty, prev_qty, {_RISE} FROM lagged",
    "quantity_delta_sparse": f"""
        SELECT {EVENT_KEY.replace("seq", "seq * 1000003 AS seq")}, qty, prev_qty, {_RISE} FROM lagged""",
    "semi_join_history": f"""
        SELECT {EVENT_KEY}, qty, prev_qty, {_RISE} FROM lagged WHERE ({KEY}) IN
          (SELECT ({KEY}) FROM qty_events
           WHERE synced_at BETWEEN TIMESTAMP '2024-01-20' AND TIMESTAMP '2024-01-21')""",
    "snapshot_fallback": f"SELECT {EVENT_KEY}, qty, prev_qty, {_RISE} FROM deltas",
    "snapshot_fallback_first": f"""
        SELECT {EVENT_KEY}, qty, prev_qty, {_RISE} FROM (
            SELECT {EVENT_KEY}, l.qty, CASE WHEN l.number = 1 THEN s.qty ELSE l.prev_qty END AS prev_qty
            FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY seq) AS number
                  FROM lagged) l JOIN qty_snapshot s USING ({KEY}))""",
    "lookup_default": f"""
        SELECT {EVENT_KEY}, e.qty, coalesce(s.qty, 0) AS cached_qty, s.qty IS NOT NULL AS known
        FROM qty_events e LEFT JOIN event_state s USING ({EVENT_KEY})""",
    "quantity_change_feed": "SELECT * FROM quantity_changes",
    "unseen_events": f"""
        SELECT {EVENT_KEY} FROM qty_events
        WHERE ({EVENT_KEY}) NOT IN (SELECT ({EVENT_KEY}) FROM event_state)""",
    "rollup_quantities": "SELECT * FROM rollup",
    "rollup_net": f"""
        SELECT {KEY}, CAST(sum(qty - prev_qty) AS BIGINT) AS qty, 'RC' AS status FROM lagged
        GROUP BY {KEY} HAVING sum(qty - prev_qty) > 0""",
    "sku_derivation": "SELECT * FROM asset_skus",
    "sku_derivation_bulk": "SELECT * FROM bulk_skus",
    "sku_queue_assets": f"""
        SELECT * FROM master_skus
        WHERE NOT is_bulk AND ({KEY}) IN
          (SELECT (company, branch, CAST(category AS BIGINT), CAST(class_code AS BIGINT))
           FROM asset_queue WHERE sent_at IS NULL)
          AND ({KEY}) NOT IN (SELECT ({KEY}) FROM bulk_skus)""",
    "sku_queue_bulk": _QUEUED_BULK.format(key=KEY, but=KEY, unsent="AND sent_at IS NULL"),
    "sku_queue_bulk_any_branch": _QUEUED_BULK.format(
        key=KEY, but="company, category, class_code", unsent=""
    ),
    "project_active_bulk": """
        SELECT right('000' || m.category, 3) AS upc, right('0000' || m.class_code, 4) AS product_id,
               right('000' || m.category, 3) || '-' || right('0000' || m.class_code, 4) AS label,
               coalesce(m.description, '') AS description, q.qty, true AS is_bulk
        FROM bulk_queue q JOIN sku_master m USING (company, category, class_code)
        WHERE m.bulk = 'Y'""",
    "remote_missing_skus": f"SELECT * EXCLUDE (missing) FROM ({_FLAGGED}) WHERE missing",
    "flag_missing_skus": f"""
        SELECT {KEY}, label, CAST(missing AS BIGINT) AS action FROM ({_FLAGGED})""",
    "resolve_skus": f"SELECT {KEY}, is_bulk, location_id, sku_id FROM resolved",
    "unresolved_keys": f"""
        SELECT run_id, {KEY}, qty, status FROM bulk_queue
        WHERE ({KEY}) NOT IN (SELECT ({KEY}) FROM resolved WHERE sku_id <> 0)""",
    "hold_back_bulk": "SELECT * FROM held_bulk",
    "hold_back_bulk_dedupe": f"""
        SELECT coalesce(q.run_id, oldest.run_id) AS run_id,
               {KEY}, status, q.qty, q.reason, q.detected_at, q.sent_at
        FROM (
            SELECT run_id, {KEY}, status, qty, CAST(1 AS BIGINT) AS reason, detected_at, sent_at
            FROM bulk_queue
            WHERE sent_at IS NOT NULL
               OR ({KEY}, status) NOT IN (SELECT ({KEY}, status) FROM held_bulk)
            UNION ALL
            SELECT NULL, {KEY}, status, CAST(sum(qty) AS BIGINT), CAST(1 AS BIGINT),
                   min(detected_at), NULL
            FROM waiting_bulk GROUP BY {KEY}, status) q
        LEFT JOIN (
            SELECT {KEY}, status, min(struct_pack(t := detected_at, r := run_id)).r AS run_id
            FROM waiting_bulk GROUP BY {KEY}, status) oldest
          USING ({KEY}, status)""",
    "hold_back_assets": "SELECT * FROM held_assets",
    "append_capture_queue": "SELECT * FROM queue_now WHERE sent_at IS NULL",
    "append_capture_rows": "SELECT * FROM held_assets",
    "replay_quantities": "SELECT * FROM replayed",
    "replay_send_list": "SELECT * FROM send_list",
    "replay_mark_sent": _SENT,
    "settle_changes": "SELECT * FROM sendable",
    "settle_queue": "SELECT * FROM settled",
    "max_tag": "SELECT * FROM tags",
    "max_tag_incremental": "SELECT * FROM tags",
    "waiting_sums_incremental": f"""
        SELECT {KEY}, status, CAST(sum(qty) AS BIGINT) AS qty, count(*) AS entries
        FROM bulk_queue WHERE sent_at IS NULL GROUP BY {KEY}, status""",
    "expand_units": """
        SELECT p_partkey, unnest(range(1, CAST(p_size AS BIGINT))) AS unit_no FROM part""",
    "expand_units_totals": """
        SELECT l_partkey, count(*) AS units, CAST(sum(unit_no) AS BIGINT) AS sum_unit_no
        FROM (SELECT l_partkey, unnest(range(1, CAST(l_quantity AS BIGINT) + 1)) AS unit_no
              FROM lineitem) GROUP BY l_partkey""",
    "expand_units_chunked": """
        SELECT l_partkey, count(*) AS units, CAST(sum(unit_no) AS BIGINT) AS sum_unit_no
        FROM (SELECT l_partkey, unnest(range(1, CAST(sum(l_quantity) AS BIGINT) + 1)) AS unit_no
              FROM lineitem GROUP BY l_partkey) GROUP BY l_partkey""",
    "tag_ranges": f"SELECT {KEY}, source_rank, units, after_tag, sku_id FROM ranges",
    "allocate_tags": "SELECT * FROM unit_tags",
    "match_customer_sites": _BY_ANY_RULE,
    "union_site_rules": """
        SELECT s.site_id, r.location_id FROM sites s JOIN remote_sites r ON r.site_id = s.site_id
        UNION
        SELECT s.site_id, r.location_id FROM sites s JOIN remote_sites r ON r.branch = s.branch""",
    "union_site_rules_factorised": """
        WITH here AS (SELECT DISTINCT branch, location_id FROM remote_sites),
        alone AS (SELECT DISTINCT s.site_id, r.location_id FROM sites s
                  JOIN remote_sites r ON r.site_id = s.site_id
                  WHERE (s.branch, r.location_id) NOT IN (SELECT (branch, location_id) FROM here))
        SELECT 'branch:' || branch AS "group", 'site' AS side, site_id AS id FROM sites
        WHERE branch IN (SELECT branch FROM here)
        UNION ALL SELECT DISTINCT 'site:' || site_id, 'site', site_id FROM alone
        UNION ALL SELECT 'branch:' || branch, 'location', location_id FROM here
        UNION ALL SELECT 'site:' || site_id, 'location', location_id FROM alone""",
    "match_sites_first_rule": f"""
        WITH pairs AS (
            SELECT DISTINCT s.site_id, r.location_id, CASE
                   WHEN r.site_id = s.site_id THEN 1
                   WHEN r.account = CAST(k AS VARCHAR) AND r.job = 'J' || k
                        AND r.job_location = c_mktsegment AND r.branch = s.branch
                        AND r.company = s.company THEN 2
                   WHEN r.company = s.company AND r.branch = s.branch THEN 3
                   ELSE 4 END AS rule
            FROM sites s JOIN remote_sites r ON r.site_id = s.site_id OR r.branch = s.branch)
        SELECT m.*, CAST(rule AS BIGINT) AS rule
        FROM pairs p JOIN ({_BY_ANY_RULE}) m
          ON m."CJID" = p.site_id AND m."HQLocationID" = p.location_id
        WHERE rule = (SELECT min(q.rule) FROM pairs q WHERE q.site_id = p.site_id)""",
    "prior_attributes": "SELECT * FROM prior",
    "asset_payload": f"""
        SELECT {RUN_TS} AS "DateAdded", {RUN_TS} AS "LastUpdated", {RUN_TS} AS "LastNotification",
               * FROM ({_ASSET_FEED})""",
    "asset_payload_nested": f"""
        SELECT "HQLocationID", "HQSKUID", "AssetGroup",
               '{{"HQLocationID":' || "HQLocationID" || ',"HQSKUID":' || "HQSKUID"
               || ',"AssetGroup":"' || "AssetGroup" || '","items":['
               || string_agg(item, ',' ORDER BY "TagID") || ']}}' AS doc
        FROM (SELECT *, left("AssetID", greatest(length("AssetID") - 2, 0)) AS "AssetGroup",
                     CASE WHEN "PrevSerial" IS NULL
                     THEN CAST(to_json({{'TagID': "TagID", 'AssetID': "AssetID",
                                         'SerialNumber': "SerialNumber"}}) AS VARCHAR)
                     ELSE CAST(to_json({{'TagID': "TagID", 'AssetID': "AssetID",
                                         'SerialNumber': "SerialNumber",
                                         'PrevSerial': "PrevSerial"}}) AS VARCHAR) END AS item
              FROM ({_ASSET_FEED}))
        GROUP BY "HQLocationID", "HQSKUID", "AssetGroup" """,
    "sku_payload": _sku_payload("true"),
    "sku_payload_missing": _sku_payload("missing"),
    "json_shred_events": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    "json_nest_orders": """
        SELECT o_custkey, o_orderstatus,
               CAST(to_json({'o_custkey': o_custkey, 'o_orderstatus': o_orderstatus, 'orders': list(
                   {'o_orderkey': o_orderkey, 'o_orderpriority': o_orderpriority}
                   ORDER BY o_orderkey)}) AS VARCHAR) AS doc
        FROM orders GROUP BY o_custkey, o_orderstatus""",
    "export_roundtrip": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
               CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%g') AS added FROM orders""",
    "feed_remote_skus": "SELECT location_id, upc, product_id, sku_id FROM remote_skus",
    "customer_snapshot": "SELECT c_custkey, "
    + _hash(
        c_custkey=_text("c_custkey"), c_name="c_name", c_nationkey=_text("c_nationkey"),
        c_acctbal=_text("CAST(c_acctbal AS DECIMAL(12,2))"), c_mktsegment="c_mktsegment",
    )
    + " AS hash FROM customer",
    "distinct_keys": f"SELECT DISTINCT {KEY} FROM bulk_queue",
    "dimension_joins": """
        SELECT s.site_id, a.id AS location_id, s.branch, n.sites
        FROM sites s JOIN active a USING (company, branch)
        JOIN (SELECT branch, count(*) AS sites FROM sites
              WHERE branch IN (SELECT branch FROM active) GROUP BY branch) n ON n.branch = s.branch""",
    "upsert_state": f"""
        SELECT * FROM prints WHERE ({ASSET_KEY}) IN (SELECT ({ASSET_KEY}) FROM changes)
        UNION ALL
        SELECT * FROM prints_before WHERE ({ASSET_KEY}) NOT IN (SELECT ({ASSET_KEY}) FROM changes)""",
    "upsert_bucketed": f"""
        SELECT * FROM prints WHERE ({ASSET_KEY}) IN (SELECT ({ASSET_KEY}) FROM changes)
        UNION ALL
        SELECT * FROM prints_before WHERE ({ASSET_KEY}) NOT IN (SELECT ({ASSET_KEY}) FROM changes)""",
    "advance_watermark": """
        SELECT b.source, TIMESTAMP '2024-01-20' AS start_ts, TIMESTAMP '2024-01-20' AS prev_start_ts,
               coalesce(max(e.ts), TIMESTAMP '2024-01-20') AS end_ts
        FROM bounds b LEFT JOIN events e
          ON e.event_type = b.source AND e.ts BETWEEN b.start AND b."end"
        GROUP BY b.source""",
    "rebuild_assets": """
        SELECT p.*, trim(a.serial) AS serial FROM prints p LEFT JOIN (
            SELECT * FROM assets WHERE status = 'A'
              AND (company, home_branch) IN (SELECT (company, branch) FROM active)) a
        USING (company, asset_id)""",
    "rebuild_quantities": f"SELECT {EVENT_KEY}, qty, prev_qty, {EVENT_HASH} AS hash FROM deltas",
    "rebuild_snapshot": f"SELECT {KEY}, qty, {SNAPSHOT_HASH} AS hash FROM qty_snapshot",
    "stream_delta": """
        SELECT event_id, ts, user_id, event_type, CAST(floor(value) AS BIGINT) AS qty,
               lag(CAST(floor(value) AS BIGINT), 1, 0)
                   OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS prev_qty
        FROM events""",
    "stream_late_corrections": """
        SELECT event_id, ts, user_id, event_type, CAST(floor(value) AS BIGINT) AS qty,
               lag(CAST(floor(value) AS BIGINT), 1, 0)
                   OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS prev_qty
        FROM events""",
    "stream_dedupe": "SELECT event_id, ts, user_id, event_type FROM events",
    "feed_rejects": """
        SELECT CASE WHEN event_id % 50 IN (7, 11) THEN 'bad' ELSE 'good' END AS kind,
               CASE event_id % 50
                    WHEN 7 THEN '{"ID":"x' || event_id || '","PC":"' || event_type || '"}'
                    WHEN 11 THEN '{"ID":' || event_id ELSE CAST(event_id AS VARCHAR) END AS content,
               CASE event_id % 50 WHEN 7 THEN 'ID' WHEN 11 THEN 'malformed' ELSE event_type END AS note
        FROM events""",
}


# In a whole run nothing was sent before, the interval takes in all events, and the SKU
# list has the SKUs of the queues too.
RUN_CTES = {
    "quantity_changes": f"""
        SELECT {EVENT_KEY}, qty, qty - prev_qty AS qty_to_send, 'NEW' AS change_type
        FROM deltas
        WHERE qty - prev_qty > 0
          AND (company, category, class_code) IN
              (SELECT (company, category, class_code) FROM sku_master WHERE bulk = 'Y')
          AND (company, branch) IN (SELECT (company, branch) FROM active)""",
    "listed": f"""
        SELECT * FROM master_skus WHERE NOT is_bulk AND (
            ({KEY}) IN (SELECT ({KEY}) FROM asset_skus)
            OR ({KEY}) IN (SELECT (company, branch, CAST(category AS BIGINT), CAST(class_code AS BIGINT))
                           FROM asset_queue WHERE sent_at IS NULL))
        UNION ALL
        SELECT * FROM master_skus WHERE is_bulk AND (
            ({KEY}) IN (SELECT ({KEY}) FROM bulk_skus)
            OR ({KEY}) IN (SELECT ({KEY}) FROM bulk_queue WHERE sent_at IS NULL AND qty > 0))""",
}

_STAMP = "'2024-02-01 00:00:00.000'"
_NONE = "CAST(NULL AS VARCHAR)"
_NO_NUMBER = "CAST(NULL AS BIGINT)"

SYNC_RUN = f"""
        SELECT 'skus' AS feed, "DateAdded" || "LastUpdated" || "LastNotification" AS stamps,
               "HQLocationID", {_NO_NUMBER} AS "HQSKUID", {_NONE} AS "TagID", {_NONE} AS "AssetID",
               {_NONE} AS "SerialNumber", {_NONE} AS "PrevSerial", "UPC", "ProductID",
               "SKUListType", "Description", "IsConsumable", "IsActive", "QuantityOnHand" AS quantity
        FROM ({_sku_payload("true")})
        UNION ALL
        SELECT 'units', {_STAMP}, location_id, sku_id, tag, tag, NULL, NULL, NULL, NULL, NULL, NULL,
               NULL, 1, 1
        FROM unit_tags
        UNION ALL
        SELECT 'assets', {_STAMP} || {_STAMP} || {_STAMP}, "HQLocationID", "HQSKUID", "TagID",
               "AssetID", "SerialNumber", "PrevSerial", NULL, NULL, NULL, NULL, NULL, NULL, NULL
        FROM ({_ASSET_FEED})"""

_SKU_TEXT = "company || '/' || branch || '/' || category || '/' || class_code"

SYNC_RUN_STATE = f"""
        SELECT 'asset_state' AS name, company || '/' || asset_id AS key, hash AS value
        FROM (SELECT * FROM prints WHERE ({ASSET_KEY}) IN (SELECT ({ASSET_KEY}) FROM sendable)
              UNION ALL
              SELECT * FROM prints_before
              WHERE ({ASSET_KEY}) NOT IN (SELECT ({ASSET_KEY}) FROM sendable))
        UNION ALL
        SELECT 'prior_attributes', company || '/' || asset_id, serial
        FROM (SELECT company, asset_id, trim(serial) AS serial FROM assets
              WHERE status = 'A' AND ({ASSET_KEY}) IN (SELECT ({ASSET_KEY}) FROM sendable)
                AND (company, home_branch) IN (SELECT (company, branch) FROM active)
              UNION ALL
              SELECT * FROM prior WHERE ({ASSET_KEY}) NOT IN (
                  SELECT ({ASSET_KEY}) FROM assets
                  WHERE status = 'A' AND ({ASSET_KEY}) IN (SELECT ({ASSET_KEY}) FROM sendable)
                    AND (company, home_branch) IN (SELECT (company, branch) FROM active)))
        UNION ALL
        SELECT 'qty_event_state', {_SKU_TEXT} || '/' || seq, CAST(qty AS VARCHAR)
        FROM quantity_changes
        UNION ALL
        SELECT 'last_qty', {_SKU_TEXT}, max(seq) || '/' || max_by(qty, seq)
        FROM qty_events GROUP BY {KEY}
        UNION ALL
        SELECT 'qty_snapshot_state', {_SKU_TEXT}, CAST(qty AS VARCHAR) FROM qty_snapshot
        UNION ALL
        SELECT 'bulk_queue', {_SKU_TEXT} || '/' || status, CAST(qty AS VARCHAR)
        FROM (SELECT {KEY}, status, qty FROM bulk_queue WHERE sent_at IS NULL
                AND ({KEY}) NOT IN (SELECT ({KEY}) FROM send_list)
              UNION ALL SELECT {KEY}, status, qty FROM held_bulk)
        UNION ALL
        SELECT 'asset_queue', company || '/' || asset_id, branch || '/' || category || '/' || class_code
        FROM settled WHERE sent_at IS NULL
        UNION ALL
        SELECT 'control', source, '2024-02-01 00:00:00/' || strftime(reached, '%Y-%m-%d %H:%M:%S')
        FROM (SELECT 'assets' AS source, max(synced_at) AS reached FROM assets
              UNION ALL SELECT 'qty_events', max(synced_at) FROM qty_events)"""

SYNC_RUN_SITES = f"""
        SELECT * EXCLUDE (rule) FROM ({BODIES["match_sites_first_rule"]})"""


# Times are whole hours, every seventh event comes three days late, and the first run sees the even
# ones of those at its own time.
SYNC_RUN_SECOND = f"""
        WITH replicated AS (
            SELECT * REPLACE (date_trunc('hour', synced_at)
                              + CASE WHEN seq % 7 = 0 THEN INTERVAL 3 DAY ELSE INTERVAL 0 DAY END AS synced_at)
            FROM qty_events),
        log AS (SELECT * FROM replicated WHERE synced_at <= TIMESTAMP '2024-02-01'),
        one AS (SELECT * FROM log WHERE synced_at < TIMESTAMP '2024-01-15'
                OR (synced_at = TIMESTAMP '2024-01-15' AND seq % 2 = 0)),
        snapshot AS (SELECT {KEY}, max(qty) AS known FROM one GROUP BY {KEY}),
        first_run AS (
            SELECT *, lag(qty, 1, 0) OVER (PARTITION BY {KEY} ORDER BY seq) AS prev_qty, 1 AS run FROM one),
        second_run AS (
            SELECT l.* REPLACE (CASE WHEN prev_qty = 0 THEN coalesce(known, 0) ELSE prev_qty END AS prev_qty)
            FROM (SELECT *, lag(qty, 1, 0) OVER (PARTITION BY {KEY} ORDER BY seq) AS prev_qty, 2 AS run
                  FROM log) l LEFT JOIN snapshot USING ({KEY})
            WHERE synced_at >= TIMESTAMP '2024-01-15' AND seq NOT IN (SELECT seq FROM one)),
        risen AS (
            SELECT * FROM (SELECT * FROM first_run UNION ALL SELECT * FROM second_run)
            WHERE qty > prev_qty
              AND (company, category, class_code) IN
                  (SELECT (company, category, class_code) FROM sku_master WHERE bulk = 'Y')
              AND (company, branch) IN (SELECT (company, branch) FROM active))
        SELECT 'rise' AS what, {_SKU_TEXT} || '/' || seq AS key, CAST(run AS BIGINT) AS run, qty FROM risen
        UNION ALL
        SELECT 'waits', {_SKU_TEXT}, run, CAST(sum(qty - prev_qty) AS BIGINT) FROM risen GROUP BY {KEY}, run
        UNION ALL
        SELECT 'last', {_SKU_TEXT} || '/' || max(seq), 2, max_by(qty, seq) FROM log GROUP BY {KEY}"""


def _needed(sql: str, ctes: dict[str, str]) -> list[str]:
    """The stand-ins a statement uses, in definition order."""
    reach = {name for name in ctes if re.search(rf"\b{name}\b", sql)}
    for name in reversed(ctes):
        if name in reach:
            reach |= {n for n in ctes if n != name and re.search(rf"\b{n}\b", ctes[name])}
    return [name for name in ctes if name in reach]


def statement(body: str, **changed: str) -> str:
    ctes = {**CTES, **changed}
    names = _needed(body, ctes)
    if not names:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({ctes[n]})" for n in names) + "\n" + _unnest_with(body)


def _unnest_with(body: str) -> str:
    """A body that brings definitions of its own becomes a subquery."""
    return f"SELECT * FROM ({body})" if body.lstrip().startswith("WITH") else body


def oracle_sql() -> dict[str, str]:
    runs = {
        "sync_run": SYNC_RUN, "sync_run_state": SYNC_RUN_STATE, "sync_run_sites": SYNC_RUN_SITES
    }
    second = {"sync_run_second": statement(SYNC_RUN_SECOND)}
    return second | {name: statement(body) for name, body in BODIES.items()} | {
        name: statement(body, **RUN_CTES) for name, body in runs.items()
    }
