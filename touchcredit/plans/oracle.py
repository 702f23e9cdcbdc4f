"""Independent DuckDB SQL for every catalogue query with an oracle.

Written from the semantics, not from the Spark code: the mapping of the
given ``events`` table is a flat CASE/JOIN (no arrays), and credit is the
literal join + ``row_number`` form (pairs are fine at test scale).
"""

from __future__ import annotations

from touchcredit.sources.events_adapter import EVENT_NAMES, acquisition

MICROS_PER_DAY = 86_400_000_000


def _lit(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def _acquired(j: str, alias: str) -> str:
    """The three acquisition values of ``j`` as columns (the mapping rule is given, not part of what is checked)."""
    return ", ".join(f"{sql} AS {alias}_{name}" for name, sql in acquisition(j).items())


def _event_name_case() -> str:
    whens = " ".join(f"WHEN {_lit(k)} THEN {_lit(v)}" for k, v in EVENT_NAMES.items())
    return f"CASE event_type {whens} END"


def base_ctes(feed: str = "all", window: tuple[str, str] | None = None, hot_user: bool = False) -> str:
    """CTEs ``ev``, ``stg``, ``tp``, ``cv``, ``cvu`` over the events view."""
    user = "CASE WHEN event_id % 3 = 0 THEN 999999 ELSE user_id END" if hot_user else "user_id"
    feed_pred = {"all": "TRUE", "batch": "event_id % 10 <> 0", "streaming": "event_id % 10 = 0"}[feed]
    win = "TRUE" if window is None else f"event_date BETWEEN '{window[0]}' AND '{window[1]}'"
    return f"""
ev AS (
  SELECT event_id, ts, {user} AS user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         epoch_us(ts) AS us
  FROM events WHERE {feed_pred}
),
raw AS (
  SELECT strftime(ev.ts, '%Y%m%d') AS event_date,
         ev.us AS event_timestamp,
         {_event_name_case()} AS event_name,
         'user_' || CAST(ev.user_id AS VARCHAR) AS user_pseudo_id,
         ev.event_id AS ga_session_id,
         CASE WHEN ev.k % 2 = 0 THEN a_source END AS p_source,
         CASE WHEN ev.k % 2 = 0 THEN a_medium END AS p_medium,
         CASE WHEN ev.k % 2 = 0 THEN a_campaign END AS p_campaign,
         CASE WHEN ev.k % 10 = 1 THEN NULL ELSE b_source END AS t_source,
         CASE WHEN ev.k % 10 = 1 THEN NULL ELSE b_medium END AS t_medium,
         CASE WHEN ev.k % 10 = 1 THEN NULL ELSE b_campaign END AS t_name,
         CASE WHEN ev.event_type = 'purchase' THEN ev.value END AS purchase_revenue,
         ev.k AS k, ev.event_id AS src_event_id, ev.ts AS ts
  FROM (SELECT *, {_acquired('k', 'a')}, {_acquired('k // 7', 'b')} FROM ev) ev
),
stg AS (
  SELECT event_date, event_timestamp, event_name, user_pseudo_id, ga_session_id,
         coalesce(p_source, t_source) AS source,
         coalesce(p_medium, t_medium) AS medium,
         coalesce(p_campaign, t_name) AS campaign,
         purchase_revenue, 'batch' AS _source
  FROM raw WHERE {win}
),
tp AS (
  SELECT user_pseudo_id, ga_session_id, event_timestamp AS touchpoint_us,
         coalesce(source, '(direct)') AS source, coalesce(medium, '(none)') AS medium, campaign,
         coalesce(source, '(direct)') || ' / ' || coalesce(medium, '(none)') AS channel
  FROM stg WHERE event_name = 'session_start'
),
cv AS (
  SELECT user_pseudo_id || '-' || CAST(event_timestamp AS VARCHAR) AS conversion_id,
         user_pseudo_id, event_date AS conversion_date, event_timestamp AS conversion_us,
         purchase_revenue
  FROM stg WHERE event_name = 'purchase'
),
cvu AS (
  SELECT conversion_id, user_pseudo_id, conversion_date, conversion_us, purchase_revenue FROM (
    SELECT *, row_number() OVER (PARTITION BY conversion_id
      ORDER BY purchase_revenue DESC NULLS LAST, conversion_date DESC NULLS LAST) AS rn
    FROM cv WHERE conversion_id IS NOT NULL) WHERE rn = 1
)"""


def credit_cte(name: str, model: str, days: int) -> str:
    """Literal form: inner join on user and the inclusive range, then
    row_number per conversion."""
    L = days * MICROS_PER_DAY
    if model == "first_click":
        order = "t.touchpoint_us ASC, t.ga_session_id ASC NULLS FIRST, t.channel ASC"
    else:
        order = "t.touchpoint_us DESC, t.ga_session_id DESC NULLS LAST, t.channel DESC"
    return f"""
{name} AS (
  SELECT conversion_id, conversion_date, purchase_revenue, channel AS attributed_channel,
         '{model}' AS attribution_model, touchpoint_us, ga_session_id AS touch_session_id,
         conversion_us
  FROM (
    SELECT c.conversion_id, c.conversion_date, c.purchase_revenue, c.conversion_us,
           t.channel, t.touchpoint_us, t.ga_session_id,
           row_number() OVER (PARTITION BY c.conversion_id ORDER BY {order}) AS rn
    FROM cvu c JOIN tp t
      ON t.user_pseudo_id = c.user_pseudo_id
     AND t.touchpoint_us <= c.conversion_us
     AND t.touchpoint_us >= c.conversion_us - {L}
  ) WHERE rn = 1
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


MART = "conversion_id, conversion_date, purchase_revenue, attributed_channel, attribution_model"
DAILY = """SELECT attribution_model, conversion_date, attributed_channel,
       count(*) AS conversions, round(sum(purchase_revenue), 2) AS revenue
FROM (SELECT * FROM fc UNION ALL SELECT * FROM lc)
GROUP BY attribution_model, conversion_date, attributed_channel"""


def credited_ctes(days: int, feed: str = "all", hot_user: bool = False) -> str:
    return with_(base_ctes(feed, hot_user=hot_user), credit_cte("fc", "first_click", days),
                 credit_cte("lc", "last_click", days))


AS_OF_US = 1_706_659_200_000_000
UNION_FL = "u AS (SELECT * FROM fc UNION ALL SELECT * FROM lc)"
STREAM = """s AS (
  SELECT substr(sha256(r.user_pseudo_id || '|' || CAST(r.event_timestamp AS VARCHAR) || '|' || r.event_name), 1, 16)
           AS event_id,
         r.event_date, r.event_timestamp, r.event_name, r.user_pseudo_id, r.ga_session_id,
         coalesce(r.p_source, r.t_source) AS source, coalesce(r.p_medium, r.t_medium) AS medium,
         coalesce(r.p_campaign, r.t_name) AS campaign, r.purchase_revenue,
         r.ts + to_seconds(r.k) AS ingested_ts, r.src_event_id
  FROM raw r
)"""
ISO = "'%Y-%m-%dT%H:%M:%S.%f'"
STG = f"\nSELECT *, strftime(make_timestamp(event_timestamp), {ISO}) AS event_ts FROM stg"
DAILY_CTE = "daily AS (" + DAILY + ")"


def _not_null_sql() -> str:
    spec = [
        ("stg_events", "stg", ["event_timestamp", "event_name", "user_pseudo_id"], {}),
        ("int_touchpoints", "tp", ["touchpoint_ts", "channel"], {"touchpoint_ts": "touchpoint_us"}),
        ("int_conversions", "cv", ["conversion_id", "conversion_ts", "purchase_revenue"],
         {"conversion_ts": "conversion_us"}),
        ("mart_attribution_first_click", "fc", ["conversion_id", "attributed_channel", "purchase_revenue"], {}),
        ("mart_attribution_last_click", "lc", ["conversion_id", "attributed_channel", "purchase_revenue"], {}),
        ("mart_channel_daily", "daily", ["attribution_model", "conversion_date", "conversions"], {}),
    ]
    parts = []
    for rel, cte, cols, alias in spec:
        for c in cols:
            parts.append(f"SELECT '{rel}' AS relation, '{c}' AS column_name, "
                         f"CAST(count(*) FILTER (WHERE {alias.get(c, c)} IS NULL) AS BIGINT) AS failures FROM {cte}")
    return "\nUNION ALL ".join(parts)


def _unique_sql() -> str:
    parts = []
    for rel, cte in (("int_conversions", "cv"), ("mart_attribution_first_click", "fc"),
                     ("mart_attribution_last_click", "lc")):
        parts.append(f"SELECT '{rel}' AS relation, 'conversion_id' AS column_name, CAST(count(*) AS BIGINT) AS failures "
                     f"FROM (SELECT conversion_id FROM {cte} WHERE conversion_id IS NOT NULL "
                     f"GROUP BY conversion_id HAVING count(*) > 1)")
    return "\nUNION ALL ".join(parts)


ACCEPTED_SQL = """SELECT 'stg_events' AS relation, 'event_name' AS column_name, event_name AS value, count(*) AS n_rows
FROM stg WHERE event_name NOT IN ('session_start','page_view','view_item','add_to_cart','begin_checkout','purchase')
GROUP BY event_name
UNION ALL
SELECT 'mart_channel_daily', 'attribution_model', attribution_model, count(*)
FROM daily WHERE attribution_model NOT IN ('first_click','last_click') GROUP BY attribution_model"""

ORPHAN_RATE_SQL = """SELECT count(*) AS conversions,
       count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM lc m WHERE m.conversion_id = c.conversion_id)) AS orphans,
       round(orphans / conversions, 6) AS orphan_rate
FROM cv c"""

CONSERVED_SQL = """SELECT first_click_total, last_click_total,
       coalesce(first_click_total <> last_click_total, FALSE) AS ref_violation,
       CASE WHEN uf IS NULL AND ul IS NULL THEN FALSE WHEN uf IS NULL OR ul IS NULL THEN TRUE
            ELSE abs(uf - ul) > 0.005 END AS strict_violation
FROM (SELECT round(sum(revenue) FILTER (WHERE attribution_model = 'first_click'), 2) AS first_click_total,
             round(sum(revenue) FILTER (WHERE attribution_model = 'last_click'), 2) AS last_click_total
      FROM daily),
     (SELECT (SELECT sum(purchase_revenue) FROM fc) AS uf, (SELECT sum(purchase_revenue) FROM lc) AS ul)"""

def fresh_sql(*feeds: str) -> str:
    listed = ", ".join(f"('{f}')" for f in feeds)
    return f"""SELECT feed, newest_event_us, hours_since,
       CASE WHEN hours_since <= 26 THEN 'pass' WHEN hours_since <= 50 THEN 'warn' ELSE 'error' END AS status
FROM (SELECT feed, max(event_timestamp) AS newest_event_us, round(({AS_OF_US} - max(event_timestamp)) / 3600000000.0, 3) AS hours_since
      FROM (VALUES {listed}) f(feed) LEFT JOIN stg ON _source = feed GROUP BY feed)"""


ROWCOUNT_SQL = """SELECT strftime(cal.d, '%Y%m%d') AS conversion_date,
       CAST(coalesce(pd.n_rows, 0) AS BIGINT) AS n_rows,
       round(coalesce(sp.prev7, 0) / 7.0, 3) AS prev7_avg,
       CASE WHEN round(coalesce(sp.prev7, 0) / 7.0, 3) > 0
             AND coalesce(pd.n_rows, 0) < round(coalesce(sp.prev7, 0) / 7.0, 3) * 0.5
            THEN 'fail' ELSE 'pass' END AS status
FROM (SELECT unnest(generate_series(lo, DATE '2024-01-30', INTERVAL 1 DAY))::DATE AS d
      FROM (SELECT min(d) AS lo FROM pd)) cal
LEFT JOIN pd ON pd.d = cal.d
LEFT JOIN (SELECT CAST(pd.d + r.i AS DATE) AS d, sum(pd.n_rows) AS prev7
           FROM pd, (SELECT CAST(range AS INTEGER) AS i FROM range(1, 8)) r GROUP BY 1) sp ON sp.d = cal.d"""
PD_CTE = "pd AS (SELECT CAST(strptime(conversion_date, '%Y%m%d') AS DATE) AS d, count(*) AS n_rows FROM daily GROUP BY 1)"


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    b = with_(base_ctes())
    out["stg_events"] = b + STG
    out["stg_param_lookup"] = b + """
SELECT event_timestamp, user_pseudo_id, ga_session_id,
       p_source AS param_source, p_medium AS param_medium, p_campaign AS param_campaign,
       CAST(1 + (p_source IS NOT NULL)::INT + (p_medium IS NOT NULL)::INT + (p_campaign IS NOT NULL)::INT AS INTEGER) AS n_params,
       FALSE AS has_repeated_key
FROM raw"""
    out["stg_source_fallback"] = b + """
SELECT event_timestamp, user_pseudo_id, ga_session_id,
       coalesce(p_source, t_source) AS source,
       CASE WHEN p_source IS NOT NULL THEN 'param' WHEN t_source IS NOT NULL THEN 'traffic' END AS source_from,
       coalesce(p_medium, t_medium) AS medium,
       CASE WHEN p_medium IS NOT NULL THEN 'param' WHEN t_medium IS NOT NULL THEN 'traffic' END AS medium_from,
       coalesce(p_campaign, t_name) AS campaign,
       CASE WHEN p_campaign IS NOT NULL THEN 'param' WHEN t_name IS NOT NULL THEN 'traffic' END AS campaign_from
FROM raw"""
    out["stg_batch_window"] = with_(base_ctes(window=("20240117", "20240131"))) + STG
    out["stg_export_trailing"] = out["stg_events"] + """
WHERE event_date >= strftime(CAST(strptime((SELECT max(event_date) FROM stg), '%Y%m%d') AS DATE) - 14, '%Y%m%d')"""
    out["touchpoints"] = b + "\nSELECT * FROM tp"
    out["conversions"] = b + "\nSELECT * FROM cv"
    for days in (1, 7, 30):
        w = credited_ctes(days)
        out[f"attribution_first_click_{days}d"] = w + f"\nSELECT {MART} FROM fc"
        out[f"attribution_last_click_{days}d"] = w + f"\nSELECT {MART} FROM lc"
    out["attribution_first_click_7d_fine_chunks"] = out["attribution_first_click_7d"]
    out["attribution_last_click_7d_fine_chunks"] = out["attribution_last_click_7d"]
    out["attribution_first_asof_7d"] = out["attribution_first_click_7d"]
    out["attribution_split_hot_7d"] = credited_ctes(7) + f"\nSELECT {MART} FROM fc UNION ALL SELECT {MART} FROM lc"
    out["attribution_last_asof_7d"] = out["attribution_last_click_7d"]
    out["channel_daily"] = credited_ctes(30) + "\n" + DAILY
    out["channel_daily_1d"] = credited_ctes(1) + "\n" + DAILY
    out["channel_daily_hot_user"] = credited_ctes(30, hot_user=True) + "\n" + DAILY
    out["attribution_last_click_30d_hot_user"] = credited_ctes(30, hot_user=True) + f"\nSELECT {MART} FROM lc"
    out["channel_daily_7d"] = credited_ctes(7) + "\n" + DAILY

    c30 = credited_ctes(30)
    agg2 = "count(*) AS conversions, round(sum(purchase_revenue), 2) AS revenue"
    out["model_totals"] = c30 + f", {UNION_FL}\nSELECT attribution_model, {agg2} FROM u GROUP BY 1"
    out["channel_breakdown"] = c30 + f", {UNION_FL}\nSELECT attribution_model, attributed_channel, {agg2} FROM u GROUP BY 1, 2"
    cmp_sel = """SELECT attributed_channel,
  count(*) FILTER (WHERE attribution_model = 'first_click') AS fc_conversions,
  coalesce(round(sum(purchase_revenue) FILTER (WHERE attribution_model = 'first_click'), 2), 0.0) AS fc_revenue,
  count(*) FILTER (WHERE attribution_model = 'last_click') AS lc_conversions,
  coalesce(round(sum(purchase_revenue) FILTER (WHERE attribution_model = 'last_click'), 2), 0.0) AS lc_revenue
FROM u GROUP BY attributed_channel"""
    out["channel_compare"] = c30 + f", {UNION_FL}\n" + cmp_sel
    out["channel_scaled"] = c30 + f", {UNION_FL}, cmp AS ({cmp_sel}),\n" + """mx AS (SELECT greatest(1.0, max(greatest(fc_revenue, lc_revenue))) AS m FROM cmp)
SELECT attributed_channel, fc_revenue, lc_revenue,
       round(fc_revenue / m * 100, 1) AS fc_pct, round(lc_revenue / m * 100, 1) AS lc_pct
FROM cmp, mx"""
    out["trend_14"] = c30 + f", {DAILY_CTE},\n" + """d AS (SELECT DISTINCT conversion_date FROM daily ORDER BY conversion_date DESC LIMIT 14),
per AS (SELECT conversion_date,
   CAST(coalesce(sum(conversions) FILTER (WHERE attribution_model = 'first_click'), 0) AS BIGINT) AS first_click,
   CAST(coalesce(sum(conversions) FILTER (WHERE attribution_model = 'last_click'), 0) AS BIGINT) AS last_click
 FROM daily WHERE conversion_date IN (SELECT conversion_date FROM d) GROUP BY 1)
SELECT *, CAST((SELECT greatest(1, max(greatest(first_click, last_click))) FROM per) AS BIGINT) AS chart_max,
       strftime(strptime(conversion_date, '%Y%m%d'), '%m/%d') AS label FROM per"""
    dis = """SELECT f.conversion_id, f.attributed_channel AS first_channel, l.attributed_channel AS last_channel
FROM fc f JOIN lc l ON f.conversion_id = l.conversion_id
WHERE f.attributed_channel <> l.attributed_channel"""
    out["model_disagreement"] = c30 + "\n" + dis
    out["model_disagreement_sample"] = c30 + "\n" + dis + "\nORDER BY f.conversion_id LIMIT 5"

    sb = with_(base_ctes(), STREAM)
    out["stream_dedupe"] = sb + f"""
SELECT event_id, event_date, event_timestamp, event_name, user_pseudo_id, ga_session_id,
       source, medium, campaign, purchase_revenue, strftime(ingested_ts, {ISO}) AS ingested_at
FROM s"""
    out["latest_events_20"] = sb + f"""
SELECT event_id, event_name, user_pseudo_id, source, medium, purchase_revenue,
       strftime(ingested_ts, {ISO}) AS ingested_at
FROM s ORDER BY ingested_ts DESC, event_id ASC LIMIT 20"""
    out["stream_replay_counts"] = sb + """,
deliv AS (
  SELECT event_id, event_date AS batch_id FROM s
  UNION ALL SELECT event_id, event_date FROM s WHERE src_event_id % 20 = 0
  UNION ALL SELECT event_id, strftime(strptime(event_date, '%Y%m%d') + INTERVAL 1 DAY, '%Y%m%d')
            FROM s WHERE src_event_id % 20 = 0
),
first_seen AS (SELECT event_id, min(batch_id) AS batch_id FROM deliv GROUP BY event_id),
n_in AS (SELECT batch_id, count(*) AS n_in FROM deliv GROUP BY batch_id),
n_new AS (SELECT batch_id, count(*) AS n_new FROM first_seen GROUP BY batch_id)
SELECT n_in.batch_id, n_in.n_in, CAST(coalesce(n_new.n_new, 0) AS BIGINT) AS n_new,
       n_in.n_in - CAST(coalesce(n_new.n_new, 0) AS BIGINT) AS n_skipped
FROM n_in LEFT JOIN n_new ON n_in.batch_id = n_new.batch_id"""
    out["latest_events_5"] = out["latest_events_20"].replace("LIMIT 20", "LIMIT 5")
    out["last_click_breakdown"] = c30 + f"\nSELECT attributed_channel, {agg2} FROM lc GROUP BY 1"
    out["channel_daily_ordered"] = out["channel_daily"]
    out["stream_union_marts"] = out["channel_daily"]
    out["stream_attribution"] = c30 + f""", {UNION_FL}
SELECT {MART} FROM u
WHERE conversion_id IN (SELECT user_pseudo_id || '-' || CAST(event_timestamp AS VARCHAR) FROM raw
                        WHERE src_event_id % 10 = 0 AND event_name = 'purchase')"""
    out["stream_channel_daily"] = out["mart_published"] = out["channel_daily"]
    out["stream_lag"] = sb + f"""
SELECT n_rows, newest_ingested_us, lag_seconds,
       CASE WHEN lag_seconds > 300 THEN 'alert' ELSE 'ok' END AS status
FROM (SELECT count(*) AS n_rows, max(epoch_us(ingested_ts)) AS newest_ingested_us,
             round(({AS_OF_US} - max(epoch_us(ingested_ts))) / 1000000.0, 3) AS lag_seconds FROM s)"""
    out["event_id_hash"] = b + """
SELECT ga_session_id,
       substr(sha256(user_pseudo_id || '|' || CAST(event_timestamp AS VARCHAR) || '|' || event_name), 1, 16) AS event_key
FROM stg"""
    out["stg_csv_clean"] = b + """
SELECT event_date, event_timestamp, event_timestamp / 1000000.0 AS event_ts_seconds, event_name,
       user_pseudo_id, ga_session_id, source, medium, campaign, purchase_revenue
FROM stg"""
    out["csv_rejects"] = b + """
SELECT event_date, CAST(event_timestamp AS VARCHAR) AS event_timestamp, event_name, user_pseudo_id,
       CAST(ga_session_id AS VARCHAR) AS ga_session_id, 'fields' AS reason
FROM stg WHERE event_timestamp % 13 = 0"""
    out["stream_compacted"] = out["stream_dedupe"]

    sections = {"totals": "model_totals", "channel_breakdown": "channel_breakdown", "channel_daily": "channel_daily",
                "trend": "trend_14", "live_events": "latest_events_20"}
    lines = "SELECT 'meta' AS section, '2024-01-31' AS generated_at" + "".join(
        f"\nUNION ALL BY NAME SELECT '{section}' AS section, * FROM ({out[name]})" for section, name in sections.items())
    counters = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in ("conversions", "first_click", "last_click", "chart_max"))
    out["report_bundle"] = f"SELECT * REPLACE ({counters}) FROM ({lines})"

    out["dq_not_null"] = c30 + f", {DAILY_CTE}\n" + _not_null_sql()
    out["dq_unique"] = c30 + "\n" + _unique_sql()
    out["dq_accepted_values"] = c30 + f", {DAILY_CTE}\n" + ACCEPTED_SQL
    for days, suffix in ((30, ""), (1, "_1d")):
        w = with_(base_ctes(), credit_cte("lc", "last_click", days))
        out[f"dq_orphans{suffix}"] = w + """
SELECT conversion_id, conversion_date FROM cv c
WHERE NOT EXISTS (SELECT 1 FROM lc m WHERE m.conversion_id = c.conversion_id)"""
    # the stream's log has a conversion once
    out["stream_orphans"] = out["dq_orphans"].replace("SELECT conversion_id, conversion_date FROM cv c", "SELECT conversion_id, conversion_date FROM cvu c")
    for days, suffix in ((30, ""), (7, "_7d")):
        w = with_(base_ctes(), credit_cte("lc", "last_click", days))
        out[f"dq_orphan_rate{suffix}"] = w + "\n" + ORPHAN_RATE_SQL
    out["dq_revenue_conserved"] = c30 + f", {DAILY_CTE}\n" + CONSERVED_SQL
    out["dq_freshness"] = b + "\n" + fresh_sql("batch")
    out["dq_freshness_feeds"] = b.replace("'batch' AS _source", "CASE WHEN src_event_id % 10 = 0 THEN 'streaming' ELSE 'batch' END AS _source") \
        + "\nSELECT feed, hours_since, status FROM (" + fresh_sql("batch", "streaming", "backfill") + ")"
    out["dq_stream_keys"] = sb + """
SELECT CAST(0 AS BIGINT) AS null_keys,
       CAST((SELECT count(*) FROM (SELECT event_id FROM s GROUP BY event_id HAVING count(*) > 1)) AS BIGINT)
         AS duplicate_keys_in_target"""
    out["dq_rowcount_7d"] = c30 + f", {DAILY_CTE}, {PD_CTE}\n" + ROWCOUNT_SQL
    out["dq_summary"] = c30 + f""", {DAILY_CTE}, {PD_CTE},
nn AS ({_not_null_sql()}),
un AS ({_unique_sql()}),
acc AS ({ACCEPTED_SQL}),
orr AS ({ORPHAN_RATE_SQL}),
cons AS ({CONSERVED_SQL}),
fr AS ({fresh_sql('batch')}),
rc AS ({ROWCOUNT_SQL}),
counted AS (
  SELECT 'not_null:' || relation || '.' || column_name AS check_name, failures FROM nn
  UNION ALL SELECT 'unique:' || relation || '.' || column_name, failures FROM un
  UNION ALL SELECT 'accepted_values:' || k.relation || '.' || k.column_name,
                   CAST(coalesce((SELECT sum(n_rows) FROM acc WHERE acc.relation = k.relation
                                   AND acc.column_name = k.column_name), 0) AS BIGINT)
            FROM (VALUES ('stg_events', 'event_name'), ('mart_channel_daily', 'attribution_model')) k(relation, column_name)
  UNION ALL SELECT 'no_orphaned_conversions', CAST(orphans AS BIGINT) FROM orr
  UNION ALL SELECT 'revenue_conserved', CAST(ref_violation AS BIGINT) FROM cons
  UNION ALL SELECT 'revenue_conserved_null_safe', CAST(strict_violation AS BIGINT) FROM cons
  UNION ALL SELECT 'param_repeated_keys', CAST(0 AS BIGINT)
  UNION ALL SELECT 'mart_rowcount_7d', CAST(count(*) FILTER (WHERE status = 'fail') AS BIGINT) FROM rc
)
SELECT check_name, failures, CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status FROM counted
UNION ALL
SELECT 'source_freshness:' || feed, CAST(CASE WHEN status = 'pass' THEN 0 ELSE 1 END AS BIGINT), status FROM fr"""
    return out
