"""The registered queries as plain SQL over the same tables, for cross-checking results."""

from clickloom.schema import alert_columns
from clickloom.sources.tables import ARRIVAL_FACTOR, ARRIVAL_PRIME, DEVICE_ORDER, TYPE_ORDER

_TYPES = str(list(TYPE_ORDER))
_DEVICES = str(list(DEVICE_ORDER))

_BASE = f"""
raw AS (
  SELECT event_id, ts, user_id, CAST(props::json->>'k' AS INTEGER) AS k FROM events
), base AS (
  SELECT
    CASE WHEN event_id % 101 = 0 THEN '' ELSE printf('ACC%08d', user_id + 1) END
      AS acc_id,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS event_time,
    {_TYPES}[(event_id * 31 + user_id * 17 + k * 7) % 8 + 1] AS event_type,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE printf('PR%03d', k) END
      AS product_id,
    {_DEVICES}[event_id % 3 + 1] AS device_type,
    (1 + event_id % 60)::integer AS time_on_page_minutes,
    ts AS event_ts,
    event_id AS seq
  FROM raw
)"""

_SESSIONS = """gaps AS (
  SELECT *, CASE WHEN event_ts - lag(event_ts) OVER (PARTITION BY acc_id ORDER BY event_ts, seq)
                      > INTERVAL 15 MINUTE THEN 1 ELSE 0 END AS gap
  FROM base
), numbered AS (
  SELECT *, 1 + sum(gap) OVER (PARTITION BY acc_id ORDER BY event_ts, seq) AS n FROM gaps
), ev AS (
  SELECT acc_id,
    CASE WHEN acc_id <> '' THEN printf('SS%08d', n::bigint) END AS session_id,
    event_time, event_type, product_id, device_type, time_on_page_minutes,
    event_time AS created_at, event_time AS updated_at, event_ts, seq,
    CASE WHEN acc_id <> '' THEN n ELSE 0 END AS n
  FROM numbered
)"""

_EV = f"{_BASE}, {_SESSIONS}"

# The same events arriving in another order, with the sessions they have by time.
_SWAPPED = f"seq * {ARRIVAL_FACTOR} % {ARRIVAL_PRIME}"
_EV_SWAPPED = f"{_EV}".replace("), ev AS (", "), timed AS (") + f""", ev AS (
  SELECT * REPLACE ({_SWAPPED} AS seq) FROM timed
)"""

_LIFE = """acting AS (
  SELECT * FROM ev
  WHERE acc_id <> '' AND product_id IS NOT NULL
    AND event_type IN ('ADD_TO_CART','WISHLIST','CHECKOUT','PURCHASE','REMOVE_FROM_CART')
), flagged AS (
  SELECT *, coalesce(lag(event_type) OVER w IN ('ADD_TO_CART','WISHLIST','CHECKOUT'), false)
    AS live
  FROM acting WINDOW w AS (PARTITION BY acc_id, product_id ORDER BY seq)
), grouped AS (
  SELECT *, sum(CASE WHEN event_type IN ('ADD_TO_CART','WISHLIST')
                       OR (event_type = 'CHECKOUT' AND NOT live) THEN 1 ELSE 0 END)
    OVER (PARTITION BY acc_id, product_id ORDER BY seq) AS episode
  FROM flagged
), counted AS (
  SELECT *, count(*) FILTER (WHERE event_type = 'CHECKOUT')
    OVER (PARTITION BY acc_id, product_id, episode ORDER BY seq) AS attempts
  FROM grouped
), closed AS (
  SELECT acc_id, product_id, episode, min(seq) AS start_seq, arg_min(n, seq) AS start_n,
    arg_min(session_id, seq) AS start_session_id, arg_min(event_time, seq) AS start_time,
    arg_min(event_type, seq) AS origin_action, max(attempts) AS attempts,
    min(seq) FILTER (WHERE event_type IN ('PURCHASE','REMOVE_FROM_CART')) AS closed_seq
  FROM counted WHERE episode > 0 GROUP BY acc_id, product_id, episode
), episodes AS (
  SELECT *, coalesce(closed_seq,
      lead(start_seq) OVER (PARTITION BY acc_id, product_id ORDER BY episode)) AS end_seq
  FROM closed
), fired AS (
  SELECT e.acc_id, e.product_id, e.episode, any_value(e.start_session_id) AS start_session_id,
    min(v.seq) AS seq, arg_min(v.session_id, v.seq) AS current_session_id
  FROM episodes e JOIN ev v ON v.acc_id = e.acc_id AND v.n > start_n AND v.seq > e.start_seq
    AND (e.end_seq IS NULL OR v.seq <= e.end_seq)
  GROUP BY e.acc_id, e.product_id, e.episode
), alerts AS (
  SELECT 'INTENT_CAPTURED' AS alert_type, acc_id, product_id, seq, event_type AS action,
    session_id, event_time, NULL::bigint AS checkout_attempts,
    NULL::varchar AS start_session_id, NULL::varchar AS current_session_id
  FROM counted WHERE event_type IN ('ADD_TO_CART','WISHLIST')
  UNION ALL
  SELECT 'CHECKOUT_FRICTION', acc_id, product_id, seq, '20k Voucher/FreeShip', NULL, NULL,
    attempts, NULL, NULL
  FROM counted WHERE event_type = 'CHECKOUT' AND attempts >= 2
  UNION ALL
  SELECT 'CONVERSION_SUCCESS', acc_id, product_id, seq, NULL, NULL, NULL, attempts, NULL, NULL
  FROM counted WHERE event_type = 'PURCHASE' AND live
  UNION ALL
  SELECT 'CART_REMOVED', acc_id, product_id, seq, NULL, NULL, NULL, NULL, NULL, NULL
  FROM counted WHERE event_type = 'REMOVE_FROM_CART' AND live
  UNION ALL
  SELECT 'DYNAMIC_PRICING', acc_id, product_id, seq, '10% Extra Discount Coupon', NULL, NULL,
    NULL, start_session_id, current_session_id
  FROM fired
)"""

_INTENTS = f"{_EV}, {_LIFE}"
_INTENTS_SWAPPED = f"{_EV_SWAPPED}, {_LIFE}"

# Sessions that are blank, absent or without a number.
_EV_BLANK = f"{_EV}".replace("), ev AS (", "), timed AS (") + """, ev AS (
  SELECT * REPLACE (CASE seq % 13 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN NULL WHEN 3 THEN 'abc'
      ELSE session_id END AS session_id, CASE WHEN seq % 13 < 4 THEN 0 ELSE n END AS n) FROM timed
)"""

# An aggregate of the first value that does not pass over an absent session.
_LIFE_BLANK = _LIFE.replace("arg_min(session_id, seq)", "first(session_id ORDER BY seq)")

_DOCS = f"""{_EV}, delivered AS (
  SELECT * FROM ev
  UNION ALL
  SELECT * REPLACE (seq + 1000000000 AS seq, time_on_page_minutes + 1 AS time_on_page_minutes)
  FROM ev WHERE seq % 10 = 0
), docs AS (
  SELECT *, strftime(event_ts, '%Y.%m.%d') AS index_date,
    acc_id || '_' || coalesce(session_id, '%{{session_id}}') || '_' || event_time AS doc_id
  FROM delivered
), latest AS (
  SELECT * FROM docs QUALIFY row_number() OVER (PARTITION BY index_date, doc_id
                                                ORDER BY seq DESC) = 1
)"""


def _catalog(fine: bool, where: str = "") -> str:
    suffix = " || '-' || (p_partkey % 10)::varchar" if fine else ""
    return f"""catalog AS (
  SELECT printf('PR%03d', p_partkey) AS product_id,
    'CG-' || p_type || '-' || p_size::varchar{suffix} AS category_id,
    p_brand AS brand_id, p_partkey AS catalog_ord
  FROM part {where}
)"""


def _ranked(fine: bool, where: str = "") -> str:
    return f"""{_catalog(fine, where)}, candidates AS (
  SELECT t.product_id AS target, 1 AS tier, c.* FROM catalog t
  JOIN catalog c ON c.category_id = t.category_id AND c.product_id <> t.product_id
  UNION ALL
  SELECT t.product_id, 2, c.* FROM catalog t
  JOIN catalog c ON c.brand_id = t.brand_id AND c.product_id <> t.product_id
    AND c.category_id <> t.category_id
), ranked AS (
  SELECT target, tier, product_id AS recommended_id, category_id AS recommended_category,
    brand_id AS recommended_brand,
    row_number() OVER (PARTITION BY target ORDER BY tier, catalog_ord) AS rank
  FROM candidates QUALIFY rank <= 5
)"""


_EVENT_LIST = (
    "acc_id, session_id, event_time, event_type, product_id, device_type, "
    "time_on_page_minutes, created_at, updated_at"
)
_JSON = "json_object({})::varchar".format(
    ", ".join(f"'{name}', {name}" for name in _EVENT_LIST.split(", "))
)
_ALERT_LIST = (
    "alert_type, acc_id, product_id, seq, action, session_id, event_time, checkout_attempts, "
    "start_session_id, current_session_id"
)


def _alerts_of(kind: str) -> str:
    columns = ", ".join(alert_columns(kind))
    return f"WITH {_INTENTS} SELECT {columns} FROM alerts WHERE alert_type = '{kind}'"


def _open_intents(intents: str) -> str:
    return f"""WITH {intents}
        SELECT acc_id, product_id, origin_action, start_session_id,
          start_n::integer AS start_session_number, start_time,
          attempts AS checkout_attempts, fired.seq IS NOT NULL AS discount_applied
        FROM episodes LEFT JOIN (SELECT acc_id, product_id, episode, seq FROM fired) fired
          USING (acc_id, product_id, episode)
        WHERE end_seq IS NULL"""


ORACLE_SQL = {
    "decode_events": f"WITH {_EV} SELECT seq, {_EVENT_LIST} FROM ev WHERE seq % 53 <> 0",
    "quarantine_events": f"""WITH {_BASE} SELECT seq, acc_id AS key, 'bad{{' || seq AS value,
        'malformed_json' AS reject_reason FROM base WHERE seq % 53 = 0""",
    "encode_events": f"WITH {_EV} SELECT seq, acc_id AS key, {_JSON} AS value FROM ev",
    "typed_documents": f"""WITH {_EV} SELECT acc_id, session_id, event_type, product_id,
        device_type, time_on_page_minutes::float AS time_on_page_minutes,
        event_ts AS event_time, event_ts AS created_at, event_ts AS updated_at, event_ts,
        false AS ts_parse_failed, strftime(event_ts, '%Y.%m.%d') AS index_date,
        acc_id || '_' || coalesce(session_id, '%{{session_id}}') || '_' || event_time AS doc_id,
        seq FROM ev""",
    "sessionize": f"WITH {_EV} SELECT acc_id, seq, session_id FROM ev",
    "session_number": """SELECT event_id AS seq,
        CASE event_id % 6 WHEN 0 THEN printf('SS%08d', event_id)
          WHEN 2 THEN '' WHEN 3 THEN 'abc' WHEN 4 THEN 'SS99999999999' WHEN 5 THEN 'S1S2' END
          AS session_id,
        CASE event_id % 6 WHEN 0 THEN event_id::integer WHEN 5 THEN 12 ELSE 0 END
          AS session_number FROM events""",
    "catalog_load": f"WITH {_catalog(False)} SELECT * FROM catalog WHERE catalog_ord % 11 <> 4",
    "catalog_enrich": f"""WITH {_BASE}, {_catalog(False)}
        SELECT seq, base.product_id, category_id, brand_id
        FROM base LEFT JOIN catalog USING (product_id)""",
    "recommend_catalog": f"""WITH {_ranked(True)}
        SELECT target AS product_id, rank, tier, recommended_id, recommended_category,
          recommended_brand FROM ranked""",
    "recommend_events": f"""WITH {_EV}, {_ranked(False)}
        SELECT acc_id, session_id, event_type, product_id, seq, rank, tier, recommended_id,
          recommended_category, recommended_brand
        FROM ev JOIN ranked ON target = product_id
        WHERE event_type IN ('VIEW','CLICK','SEARCH')""",
    "intents_captured": _alerts_of("INTENT_CAPTURED"),
    "checkout_attempts": f"""WITH {_INTENTS}
        SELECT acc_id, product_id, c.seq, c.attempts AS checkout_attempts, origin_action
        FROM counted c JOIN episodes USING (acc_id, product_id, episode)
        WHERE event_type = 'CHECKOUT'""",
    "checkout_friction": _alerts_of("CHECKOUT_FRICTION"),
    "conversions": _alerts_of("CONVERSION_SUCCESS"),
    "cart_removals": _alerts_of("CART_REMOVED"),
    "dynamic_pricing": _alerts_of("DYNAMIC_PRICING"),
    "pricing_alerts": f"WITH {_INTENTS} SELECT {_ALERT_LIST} FROM alerts",
    "open_intents": _open_intents(_INTENTS),
    "pricing_alerts_unordered": f"WITH {_INTENTS_SWAPPED} SELECT {_ALERT_LIST} FROM alerts",
    "open_intents_unordered": _open_intents(_INTENTS_SWAPPED),
    "sessionize_arrival": f"""WITH {_BASE}, swapped AS (
          SELECT * REPLACE ({_SWAPPED} AS seq, CASE WHEN event_id_ % 89 <> 0 THEN event_ts END AS event_ts)
          FROM (SELECT *, seq AS event_id_ FROM base)
        ), reached AS (
          SELECT *, last_value(event_ts IGNORE NULLS) OVER (PARTITION BY acc_id ORDER BY seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
          FROM swapped
        ), counted AS (
          SELECT *, 1 + sum(CASE WHEN event_ts - before > INTERVAL 15 MINUTE THEN 1 ELSE 0 END)
            OVER (PARTITION BY acc_id ORDER BY seq) AS n FROM reached
        ) SELECT acc_id, seq, CASE WHEN acc_id <> '' THEN printf('SS%08d', n::bigint) END AS session_id
        FROM counted""",
    "time_parse": """SELECT event_id AS seq, CASE event_id % 6 WHEN 0 THEN ts WHEN 1 THEN ts
          WHEN 2 THEN ts - INTERVAL 7 HOUR WHEN 4 THEN date_trunc('day', ts) END AS event_ts,
        strftime(CASE event_id % 6 WHEN 0 THEN ts WHEN 1 THEN ts
          WHEN 2 THEN ts - INTERVAL 7 HOUR WHEN 4 THEN date_trunc('day', ts) END, '%Y.%m.%d') AS index_date
        FROM events""",
    "doc_store": f"""WITH {_DOCS}
        SELECT index_date, doc_id, time_on_page_minutes::float AS time_on_page_minutes, seq FROM latest""",
    "doc_upsert": f"""WITH {_DOCS}
        SELECT index_date, doc_id, acc_id, event_type,
          time_on_page_minutes::float AS time_on_page_minutes, seq FROM latest""",
    "daily_index_counts": f"""WITH {_DOCS}
        SELECT index_date, count(*) AS documents FROM latest GROUP BY index_date""",
    "latest_documents": f"""WITH {_DOCS}
        SELECT index_date, doc_id, event_type, seq FROM latest
        ORDER BY event_ts DESC, doc_id LIMIT 20""",
    "recent_events": f"""WITH {_BASE}
        SELECT seq, acc_id, event_type, event_time FROM base
        WHERE event_ts >= (SELECT max(event_ts) FROM base) - INTERVAL 24 HOUR""",
    "ingestion_velocity": f"""WITH {_BASE}
        SELECT date_trunc('minute', event_ts) AS minute, count(*) AS events
        FROM base GROUP BY 1""",
    "ingestion_velocity_filled": f"""WITH {_BASE}, counts AS (
          SELECT date_trunc('minute', event_ts) AS minute, count(*) AS events
          FROM base GROUP BY 1
        ), spine AS (
          SELECT unnest(generate_series((SELECT min(minute) FROM counts),
            (SELECT max(minute) FROM counts), INTERVAL 1 MINUTE)) AS minute
        ) SELECT minute, coalesce(events, 0) AS events FROM spine LEFT JOIN counts USING (minute)""",
    "funnel": f"""WITH {_BASE}, stages AS (
          SELECT unnest([1, 2, 3, 4]) AS stage_no,
            unnest(['VIEW','ADD_TO_CART','CHECKOUT','PURCHASE']) AS stage
        ), counts AS (
          SELECT stage_no, stage, count(event_type) AS events
          FROM stages LEFT JOIN base ON event_type = stage GROUP BY stage_no, stage
        ) SELECT stage_no, stage, events,
            round(1 - events::double / nullif(lag(events) OVER (ORDER BY stage_no), 0), 6)
              AS drop_off
          FROM counts""",
    "top_products": f"""WITH {_BASE}
        SELECT product_id, count(*) AS events FROM base WHERE product_id IS NOT NULL
        GROUP BY product_id ORDER BY events DESC, product_id LIMIT 10""",
    "device_share": f"""WITH {_BASE}
        SELECT device_type, count(*) AS events,
          round(count(*)::double / sum(count(*)) OVER (), 6) AS share
        FROM base GROUP BY device_type""",
    "decode_odd_numbers": f"""WITH {_BASE}
        SELECT seq, acc_id, CASE seq % 8 WHEN 0 THEN seq || '.50' WHEN 1 THEN '-' || seq || '.0E+2'
            WHEN 2 THEN '00' || seq ELSE seq::varchar END AS product_id,
          CASE seq % 8 WHEN 0 THEN '1e3' WHEN 1 THEN '12.50' WHEN 2 THEN '-0.0' ELSE 'true' END AS session_id,
          'say "x": 1.50, 2.50' AS device_type, time_on_page_minutes
        FROM base WHERE seq % 8 IN (0, 1, 2, 6)""",
    "quarantine_reasons": f"""WITH {_BASE}
        SELECT seq, acc_id AS key, CASE seq % 8 WHEN 3 THEN 'wrong_type' WHEN 7 THEN 'null_value'
          ELSE 'malformed_json' END AS reject_reason
        FROM base WHERE seq % 8 IN (3, 4, 5, 7)""",
    "topic_formats": f"WITH {_BASE} SELECT seq, event_time AS time_text, acc_id AS key FROM base",
    "pricing_alerts_hot": f"WITH {_INTENTS} SELECT {_ALERT_LIST} FROM alerts",
    "pricing_alerts_blank_sessions": f"WITH {_EV_BLANK}, {_LIFE_BLANK} SELECT {_ALERT_LIST} FROM alerts",
    "recommend_unknown_products": f"""WITH {_EV}, {_ranked(False, "WHERE p_partkey % 3 = 0")}
        SELECT acc_id, ev.product_id, seq, rank, recommended_id FROM ev JOIN ranked ON target = ev.product_id
        WHERE event_type IN ('VIEW','CLICK','SEARCH')""",
    "alerts_across_layouts": f"WITH {_INTENTS} SELECT {_ALERT_LIST} FROM alerts",
    "handed_over_alerts": f"WITH {_INTENTS} SELECT {_ALERT_LIST} FROM alerts",
    "live_intents": _open_intents(_INTENTS),
    "session_totals": f"""WITH {_EV} SELECT acc_id, min(event_ts) AS first_ts, max(event_ts) AS last_ts,
          count(*) AS events, count(DISTINCT product_id) AS products
        FROM ev WHERE acc_id <> '' GROUP BY acc_id, n""",
}

# Streams that keep what a batch job answers are asked the same.
for _live, _batch in {
    "live_velocity": "ingestion_velocity",
    "live_funnel": "funnel",
    "live_top_products": "top_products",
    "live_device_share": "device_share",
    "day_counts_kept": "daily_index_counts",
    "newest_stored": "latest_documents",
}.items():
    ORACLE_SQL[_live] = ORACLE_SQL[_batch]
