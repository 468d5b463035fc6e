"""DuckDB SQL equivalents of the registered queries, on the raw test tables.

Written independently of the Spark plans: the raw stand-in rules, the tolerant casts and
the layer logic are restated here in SQL, as CTEs shared by name.
"""

from __future__ import annotations

import re

OBS = "DATE '2000-07-01'"
AS_OF = "DATE '2001-12-31'"


def spell(text: str, style: str) -> str:
    return (
        f"CASE {style} WHEN 1 THEN replace({text}, '-', '/') "
        f"WHEN 2 THEN substr({text}, 9, 2) || '-' || substr({text}, 6, 2) || '-' || "
        f"substr({text}, 1, 4) || substr({text}, 11) ELSE {text} END"
    )


def iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def ts_iso(c: str) -> str:
    return f"TRY_CAST(replace({c}, '/', '-') AS TIMESTAMP)"


def ts(c: str) -> str:
    return f"COALESCE({ts_iso(c)}, try_strptime({c}, '%d-%m-%Y %H:%M:%S'))"


def date(c: str) -> str:
    return (
        f"COALESCE(TRY_CAST(replace({c}, '/', '-') AS DATE), "
        f"CAST(try_strptime({c}, '%d-%m-%Y') AS DATE))"
    )


CTES: dict[str, str] = {}

# --- Bronze stand-ins -------------------------------------------------------------
CTES["people"] = """
SELECT c_custkey AS k, n_name,
       TIMESTAMP '1995-01-01 08:00:00' + to_days(CAST(c_custkey * 37 % 2000 AS INTEGER)) AS c0
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""
CTES["people_versions"] = """
SELECT k, n_name, c0, c0 AS u FROM people
UNION ALL SELECT k, n_name, c0, c0 + INTERVAL 1 DAY FROM people WHERE k % 10 = 0
"""
CTES["bronze_users"] = f"""
SELECT CASE WHEN k % 50 <> 49 THEN CAST(k AS VARCHAR) END AS user_id,
       CASE WHEN k % 40 = 7 THEN 'invalid-date'
            ELSE {spell(iso('c0'), 'k % 4')} END AS created_at,
       n_name AS country,
       {iso('u')} AS updated_at,
       strftime(u, '%Y/%m/%d %H:%M:%S') AS ingestion_timestamp
FROM people_versions
"""
CTES["bronze_sessions"] = f"""
SELECT CASE WHEN event_id % 101 <> 0 THEN CAST(event_id AS VARCHAR) END AS session_id,
       CASE WHEN event_id % 103 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
       CASE WHEN event_id % 107 = 0 THEN 'invalid-date'
            ELSE {spell(iso('(ts - INTERVAL 8603 DAY)'), 'event_id % 3')} END
         AS session_timestamp
FROM events
"""
CTES["loan_versions"] = """
SELECT o_orderkey AS k, o_custkey, o_orderdate, o_orderdate AS u,
       CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders
UNION ALL
SELECT o_orderkey, o_custkey, o_orderdate, o_orderdate + INTERVAL 1 DAY,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(1.25 AS DECIMAL(3,2)) AS DECIMAL(18,2))
FROM orders WHERE o_orderkey % 12 = 0
"""
CTES["bronze_loans"] = f"""
SELECT CASE WHEN k % 199 <> 0 THEN CAST(k AS VARCHAR) END AS loan_id,
       CASE WHEN k % 211 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS user_id,
       CASE WHEN k % 89 = 0 THEN 'invalid-date'
            ELSE {spell("strftime(o_orderdate, '%Y-%m-%d')", 'k % 3')} END
         AS disbursement_date,
       CASE WHEN k % 97 = 0 THEN 'invalid-amount' ELSE CAST(amount AS VARCHAR) END AS amount,
       CAST(6 + 6 * (k % 4) AS VARCHAR) AS term_months,
       {iso('u')} AS updated_at,
       {iso('u')} AS ingestion_timestamp
FROM loan_versions
"""
CTES["installments"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
       l_partkey * 7 + l_suppkey * 13 AS h,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
       CAST(l_discount AS DECIMAL(3,2)) AS discount,
       o_orderdate + to_days(CAST(30 * l_linenumber AS INTEGER)) AS due
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""
CTES["bronze_payments"] = f"""
SELECT CASE WHEN h % 151 <> 0
            THEN CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END
         AS payment_id,
       CASE WHEN h % 157 <> 0 THEN CAST(l_orderkey AS VARCHAR) END AS loan_id,
       CASE WHEN h % 163 = 0 THEN 'invalid-date'
            ELSE {spell("strftime(due, '%Y-%m-%d')", 'l_linenumber % 3')} END AS due_date,
       CASE WHEN h % 50 <> 0
            THEN strftime(due + to_days(CAST((h + l_linenumber) % 40 - 8 AS INTEGER)),
                          '%Y-%m-%d') END AS payment_date,
       CAST(price AS VARCHAR) AS amount_due,
       CASE WHEN h % 167 = 0 THEN 'n/a'
            ELSE CAST(CAST(price * (CAST(1 AS DECIMAL(3,2)) - discount) AS DECIMAL(18,2))
                      AS VARCHAR) END AS amount_paid,
       {iso('l_shipdate')} AS updated_at,
       {iso('(l_shipdate + to_seconds(l_partkey))')} AS ingestion_timestamp
FROM installments
"""

# --- Silver -----------------------------------------------------------------------
def typed(table: str, **columns: str) -> str:
    picks = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f"SELECT {picks} FROM {table}"


def newest(table: str, key: str, keep: str, order: list[str], valid: str = "TRUE") -> str:
    """Newest version per key among rows with keys, then only valid ones."""
    ordered = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return (
        f"SELECT * FROM (SELECT * FROM {table} WHERE {keep} QUALIFY row_number() OVER "
        f"(PARTITION BY {key} ORDER BY {ordered}) = 1) WHERE {valid}"
    )


VERSION = ["updated_at", "ingestion_timestamp"]
STAMPS = {c: ts(c) for c in VERSION}
CTES["typed_users"] = typed(
    "bronze_users", user_id="user_id", created_at=ts("created_at"), country="country", **STAMPS
)
CTES["typed_sessions"] = typed(
    "bronze_sessions", session_id="session_id", user_id="user_id",
    session_timestamp=ts("session_timestamp"),
)
CTES["typed_loans"] = typed(
    "bronze_loans", loan_id="loan_id", user_id="user_id",
    disbursement_date=date("disbursement_date"), amount="TRY_CAST(amount AS DOUBLE)",
    term_months="TRY_CAST(term_months AS INTEGER)", **STAMPS,
)
CTES["typed_payments"] = typed(
    "bronze_payments", payment_id="payment_id", loan_id="loan_id", due_date=date("due_date"),
    payment_date=date("payment_date"), amount_due="TRY_CAST(amount_due AS DOUBLE)",
    amount_paid="TRY_CAST(amount_paid AS DOUBLE)", **STAMPS,
)
CTES["silver_users"] = newest("typed_users", "user_id", "user_id IS NOT NULL", VERSION)
CTES["silver_sessions"] = newest(
    "typed_sessions", "session_id", "session_id IS NOT NULL AND user_id IS NOT NULL",
    ["session_timestamp"],
)
LOAN_KEYS = "loan_id IS NOT NULL AND user_id IS NOT NULL"
LOAN_VALID = "disbursement_date IS NOT NULL AND amount IS NOT NULL"
CTES["silver_loans"] = newest("typed_loans", "loan_id", LOAN_KEYS, VERSION, LOAN_VALID)
CTES["silver_payments"] = newest(
    "typed_payments", "payment_id", "payment_id IS NOT NULL AND loan_id IS NOT NULL", VERSION,
    "due_date IS NOT NULL",
)

# --- Gold -------------------------------------------------------------------------
CTES["volume"] = f"""
SELECT user_id, round(SUM(amount), 6) AS monthly_volume
FROM silver_loans
WHERE disbursement_date >= {OBS} - INTERVAL 30 DAY AND disbursement_date <= {OBS}
GROUP BY user_id
"""
CTES["regularity"] = f"""
SELECT user_id, CAST(COUNT(DISTINCT CAST(session_timestamp AS DATE)) AS INTEGER)
         AS session_regularity
FROM silver_sessions
WHERE CAST(session_timestamp AS DATE) >= {OBS} - INTERVAL 30 DAY
  AND CAST(session_timestamp AS DATE) <= {OBS}
GROUP BY user_id
"""
CTES["late_payers"] = f"""
SELECT l.user_id, bool_or(
         coalesce(p.payment_date, {AS_OF}) - p.due_date > 30
       ) AS late
FROM silver_payments p JOIN silver_loans l USING (loan_id)
WHERE p.due_date > {OBS} AND p.due_date <= {OBS} + INTERVAL 12 MONTH
GROUP BY l.user_id
"""
CTES["targets"] = f"""
SELECT u.user_id, {OBS} AS observation_date,
       CAST(COALESCE(d.late, FALSE) AS INTEGER) AS target_default_30d
FROM silver_users u LEFT JOIN late_payers d USING (user_id)
"""
CTES["gold"] = f"""
SELECT u.user_id, {OBS} AS observation_date,
       COALESCE(v.monthly_volume, 0.0) AS monthly_volume,
       CAST(COALESCE(r.session_regularity, 0) AS INTEGER) AS session_regularity,
       t.target_default_30d
FROM silver_users u
LEFT JOIN volume v ON u.user_id = v.user_id
LEFT JOIN regularity r ON u.user_id = r.user_id
JOIN targets t ON u.user_id = t.user_id
"""
CTES["cohorts"] = """
SELECT strftime(u.created_at, '%Y-%m') AS reg_month,
       AVG(CAST(g.target_default_30d AS DOUBLE)) AS default_rate,
       COUNT(*) AS cohort_size
FROM gold g JOIN silver_users u ON g.user_id = u.user_id
GROUP BY 1
"""


# --- features and scores ------------------------------------------------------------
def uniform(key: str, seed: int, part: int = 0) -> str:
    digits = f"substr(md5({key} || '|{seed}'), {1 + 8 * part}, 8)"
    return f"(CAST(('0x' || {digits}) AS BIGINT) / 4294967296.0)"


CTES["incomes"] = f"""
SELECT user_id, observation_date, monthly_volume, session_regularity, target_default_30d,
       greatest(15000.0, 1.5 * monthly_volume + exp(9.5 + 0.5 *
         sqrt(-2.0 * ln({uniform('user_id', 42, 0)} + 1.0 / 4294967296.0))
         * cos(2 * pi() * {uniform('user_id', 42, 1)}))) AS income
FROM gold
"""
CTES["untidy"] = """
SELECT user_id, target_default_30d,
       CASE WHEN u % 11 = 0 THEN -monthly_volume - 1.0
            WHEN u % 13 = 0 THEN CAST('inf' AS DOUBLE)
            ELSE monthly_volume + u END AS monthly_volume,
       u % 45 - 5 AS session_regularity,
       CASE WHEN u % 17 = 0 THEN CAST('inf' AS DOUBLE)
            WHEN u % 19 = 0 THEN -income
            WHEN u % 23 = 0 THEN CAST('nan' AS DOUBLE)
            WHEN u % 7 <> 0 THEN round(income, 2) END AS income
FROM (SELECT *, CAST(user_id AS BIGINT) AS u FROM incomes)
"""
CTES["bounded_rows"] = """
SELECT user_id, target_default_30d,
       CASE WHEN monthly_volume < 0 THEN 0.0
            WHEN isinf(monthly_volume) THEN NULL ELSE monthly_volume END AS monthly_volume,
       CAST(least(greatest(session_regularity, 0), 30) AS DOUBLE) AS session_regularity,
       CASE WHEN isnan(income) OR isinf(income) OR income < 0 THEN NULL ELSE income END AS income
FROM untidy
"""
CTES["class_sizes"] = """
SELECT target_default_30d AS cls, COUNT(*) AS n, SUM(COUNT(*)) OVER () AS total
FROM untidy GROUP BY 1
"""
CTES["class_quotas"] = """
SELECT cls, ceil(round(total * 0.3, 9)) AS wanted, floor(round(ceil(round(total * 0.3, 9)) * n / total, 9)) AS base,
       round(ceil(round(total * 0.3, 9)) * n / total, 9) AS quota FROM class_sizes
"""
CTES["class_tests"] = """
SELECT cls, base + CASE WHEN row_number() OVER (ORDER BY quota - base DESC, cls DESC)
                             <= wanted - SUM(base) OVER () THEN 1 ELSE 0 END AS n_test
FROM class_quotas
"""
CTES["parts"] = """
SELECT b.*, row_number() OVER (PARTITION BY target_default_30d
              ORDER BY md5('42|' || user_id) || '|' || user_id) <= n_test AS is_test
FROM bounded_rows b JOIN class_tests ON cls = target_default_30d
"""
CTES["medians"] = """
SELECT coalesce(median(monthly_volume), 0.0) AS mv, coalesce(median(session_regularity), 0.0) AS sr,
       coalesce(median(income), 0.0) AS inc
FROM parts WHERE NOT is_test
"""
CTES["scored"] = f"""
SELECT user_id, target_default_30d AS label,
       floor(({uniform('user_id', 11)} * 0.6 + target_default_30d * 0.4) * 100.0) / 100.0 AS p
FROM gold
"""
CTES["score_ranks"] = """
SELECT label, p, rank() OVER (ORDER BY p) + (COUNT(*) OVER (PARTITION BY p) - 1) / 2.0 AS r
FROM scored
"""
CTES["auc"] = """
SELECT (SUM(r) FILTER (WHERE label = 1) - n1 * (n1 + 1) / 2.0) / (n1 * n0) AS roc_auc
FROM score_ranks, (SELECT CAST(SUM(label) AS DOUBLE) AS n1,
                          CAST(COUNT(*) - SUM(label) AS DOUBLE) AS n0 FROM scored)
GROUP BY n1, n0
"""
CTES["cdfs"] = """
SELECT t.p AS score,
       CAST(COUNT(*) FILTER (WHERE s.label = 1 AND s.p <= t.p) AS DOUBLE)
         / COUNT(*) FILTER (WHERE s.label = 1) AS positives_cdf,
       CAST(COUNT(*) FILTER (WHERE s.label = 0 AND s.p <= t.p) AS DOUBLE)
         / COUNT(*) FILTER (WHERE s.label = 0) AS negatives_cdf
FROM (SELECT DISTINCT p FROM scored) t, scored s GROUP BY t.p
"""
CTES["evaluation"] = """
SELECT (SELECT roc_auc FROM auc) AS roc_auc,
       2.0 * (SELECT roc_auc FROM auc) - 1.0 AS gini_index,
       (SELECT MAX(abs(negatives_cdf - positives_cdf)) FROM cdfs) AS ks_statistic,
       AVG(CASE WHEN (p > 0.5) = (label = 1) THEN 1.0 ELSE 0.0 END) AS accuracy,
       AVG(-CASE WHEN label = 1 THEN ln(greatest(least(p, 1.0 - 2.220446049250313e-16), 2.220446049250313e-16))
             ELSE ln(1.0 - greatest(least(p, 1.0 - 2.220446049250313e-16), 2.220446049250313e-16)) END) AS log_loss
FROM scored
"""
CTES["requests"] = """
SELECT CASE WHEN u % 29 = 0 THEN '' ELSE user_id END AS user_id,
       CASE WHEN u % 31 = 0 THEN -10.0 ELSE monthly_volume END AS monthly_volume,
       CASE WHEN u % 37 = 0 THEN 35 WHEN u % 41 = 0 THEN -1 ELSE session_regularity END
         AS session_regularity,
       CASE WHEN u % 43 = 0 THEN -5000.0 WHEN u % 47 = 0 THEN CAST('nan' AS DOUBLE)
            WHEN u % 53 <> 0 THEN income END AS income
FROM (SELECT *, CAST(user_id AS BIGINT) AS u FROM incomes)
"""

# --- logs ---------------------------------------------------------------------------
def limit_of(pd: str, income: str) -> str:
    return (
        f"CASE WHEN {pd} > 0.10 THEN 0.0 "
        f"WHEN {pd} > 0.04 THEN least(greatest(0.10 * {income}, 2000.0), 25000.0) "
        f"ELSE least(greatest(0.25 * {income}, 5000.0), 100000.0) END"
    )


def decision_of(pd: str) -> str:
    return (
        f"CASE WHEN {pd} > 0.10 THEN 'REJECT' WHEN {pd} > 0.04 THEN 'APPROVE_MEDIUM_RISK' "
        "ELSE 'APPROVE_LOW_RISK' END"
    )


def answered(factor: str) -> str:
    return f"""
SELECT prediction_id, timestamp, user_id, monthly_volume, session_regularity, income,
       coalesce(pd, 0.08) AS probability_of_default,
       CASE WHEN pd IS NULL THEN 2000.0 ELSE {limit_of('pd', 'income')} END AS credit_limit,
       CASE WHEN pd IS NULL THEN 'FALLBACK_APPROVE' ELSE {decision_of('pd')} END AS decision,
       latency_ms, CASE WHEN pd IS NULL THEN 'FALLBACK' ELSE 'SUCCESS' END AS status
FROM (SELECT 'p' || event_id AS prediction_id, ts AS timestamp,
             CASE WHEN event_id % 103 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
             CASE WHEN event_id % 59 <> 0 THEN value * 40.0 * {factor} END AS monthly_volume,
             CAST(event_id * 7 % 31 AS INTEGER) AS session_regularity,
             value * 100.0 * {factor} + 15000.0 AS income,
             CASE WHEN event_id % 61 <> 0
                  THEN {uniform('CAST(event_id AS VARCHAR)', 7)} * 0.2 END AS pd,
             value AS latency_ms FROM events)
"""


CTES["answers"] = answered("1.0")
CTES["answers_drifted"] = answered(
    "CASE WHEN ts > TIMESTAMP '2024-01-22 23:59:59' THEN CAST(2.2 AS DOUBLE) ELSE 1.0 END"
)
LOG_ROW = """
SELECT prediction_id, timestamp, coalesce(user_id, 'UNKNOWN') AS user_id, monthly_volume,
       session_regularity, income, probability_of_default, credit_limit, decision, latency_ms,
       status, (user_id IS NULL OR monthly_volume IS NULL) AS is_anomaly
FROM {source}
"""
CTES["prediction_logs"] = LOG_ROW.format(source="answers")
CTES["drifted_logs"] = LOG_ROW.format(source="answers_drifted")
CTES["dialogues"] = """
SELECT u.conv_id || '-' || u.turn AS dialogue_id,
       TIMESTAMP '2024-01-15 06:00:00' + to_days(CAST(u.conv_id % 15 AS INTEGER))
         + to_hours(u.turn) AS timestamp,
       CASE WHEN u.conv_id % 97 = 0 THEN 'UNKNOWN' ELSE CAST(u.conv_id AS VARCHAR) END AS user_id,
       u.text AS user_query, a.text AS bot_response
FROM conversations u LEFT JOIN conversations a
  ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
WHERE u.role = 'user'
"""


def hits(text: str, tests: list[str], how: str) -> str:
    return " + ".join(f"CAST({how}(lower({text}), '{t}') AS INTEGER)" for t in tests)


CTES["dialogue_logs"] = f"""
SELECT *,
       CASE WHEN coalesce(user_query, '') = '' THEN 0.0 ELSE
         least(({hits('user_query', ['hate', 'that', 'keit', 'eaux'], 'contains')}) / 3.0, 1.0) END
         AS toxicity_score,
       CASE WHEN coalesce(user_query, '') = '' THEN 0.0 ELSE
         least(({hits('user_query', ['the and', 'en ', 'ou.', '^in '], 'regexp_matches')}) / 2.0, 1.0)
         END AS prompt_injection_score,
       CASE WHEN coalesce(bot_response, '') = '' THEN 0.0 ELSE greatest(CAST(1.0 AS DOUBLE) - 0.5 *
         ({hits('bot_response', ['thth', 'un[g]', 'la '], 'regexp_matches')}), 0.0) END AS fidelity_score
FROM dialogues
"""


# --- drift --------------------------------------------------------------------------
def long_of(source: str, where: str) -> str:
    variables = ("monthly_volume", "session_regularity", "income", "probability_of_default")
    return " UNION ALL ".join(
        f"SELECT '{v}' AS variable, CAST({v} AS DOUBLE) AS x FROM {source} "
        f"WHERE {v} IS NOT NULL AND {where}"
        for v in variables
    )


STEPS = "[" + ", ".join(str(i / 10) for i in range(11)) + "]"


def edge_rows(source: str) -> str:
    return f"""
SELECT variable, edge, row_number() OVER (PARTITION BY variable ORDER BY edge) - 1 AS position,
       COUNT(*) OVER (PARTITION BY variable) AS edges
FROM (SELECT DISTINCT variable, unnest(q) AS edge
      FROM (SELECT variable, quantile_cont(x, {STEPS}) AS q FROM {source} GROUP BY variable))
"""


def bin_rows(edges: str, expected: str, actual: str) -> str:
    def binned(sample: str) -> str:
        return f"""
SELECT variable, bin, COUNT(*) AS n FROM (
  SELECT s.variable, COUNT(e.edge) AS bin FROM
    (SELECT variable, x, row_number() OVER () AS id FROM {sample}) s
    LEFT JOIN (SELECT * FROM {edges} WHERE position > 0 AND position < edges - 1) e
      ON e.variable = s.variable AND e.edge <= s.x
  GROUP BY s.variable, s.id) GROUP BY 1, 2"""

    return f"""
SELECT g.variable, g.bin, coalesce(x.n, 0) AS e0, coalesce(y.n, 0) AS a0
FROM (SELECT DISTINCT variable, greatest(position - 1, 0) AS bin FROM {edges}
      WHERE position < edges) g
LEFT JOIN ({binned(expected)}) x ON x.variable = g.variable AND x.bin = g.bin
LEFT JOIN ({binned(actual)}) y ON y.variable = g.variable AND y.bin = g.bin
"""


def psi_rows(bins: str) -> str:
    return f"""
SELECT variable, CASE WHEN SUM(a0) = 0 OR SUM(e0) = 0 THEN 0.0
                      ELSE SUM((a / ta - e / te) * ln((a / ta) / (e / te))) END AS psi
FROM (SELECT *, SUM(a) OVER (PARTITION BY variable) AS ta, SUM(e) OVER (PARTITION BY variable) AS te
      FROM (SELECT *, greatest(e0, 0.0001::DOUBLE) AS e, greatest(a0, 0.0001::DOUBLE) AS a
            FROM {bins}))
GROUP BY variable
"""


def between_days(start: str, end: str) -> str:
    return f"timestamp >= TIMESTAMP '{start} 00:00:00' AND timestamp <= TIMESTAMP '{end} 23:59:59'"


WEEKS = {"stable": ("2024-01-15", "2024-01-22"), "drifted": ("2024-01-22", "2024-01-29")}
BEFORE = "timestamp < TIMESTAMP '2024-01-15 00:00:00'"
CTES["base_long"] = long_of("prediction_logs", BEFORE)
CTES["base_edges"] = edge_rows("base_long")
for _week, (_start, _end) in WEEKS.items():
    CTES[f"{_week}_long"] = long_of("drifted_logs", between_days(_start, _end))
    CTES[f"{_week}_bins"] = bin_rows("base_edges", "base_long", f"{_week}_long")
    CTES[f"{_week}_psi"] = psi_rows(f"{_week}_bins")
    CTES[f"{_week}_safety"] = f"""
SELECT coalesce(AVG(toxicity_score), 0.0) AS tox, coalesce(AVG(prompt_injection_score), 0.0) AS inj,
       coalesce(AVG(fidelity_score), 1.0) AS fid,
       coalesce(AVG(CASE WHEN prompt_injection_score > 0 THEN 1.0 ELSE 0.0 END), 0.0) AS rate
FROM dialogue_logs WHERE {between_days(_start, _end)}
"""
    CTES[f"{_week}_week"] = f"""
SELECT variable AS variable_name, psi AS psi_value, CAST(NULL AS DOUBLE) AS avg_value,
       CAST(NULL AS DOUBLE) AS rate_value,
       CASE WHEN psi >= 0.25 THEN 'DRIFT' WHEN psi >= 0.1 THEN 'MODERATE' ELSE 'STABLE' END
         AS drift_status, psi >= 0.25 AS alert_triggered FROM {_week}_psi
UNION ALL SELECT 'toxicity_score', 0.0, tox, 0.0, 'STABLE', tox > 0.20 FROM {_week}_safety
UNION ALL SELECT 'prompt_injection_score', 0.0, inj, rate, 'STABLE', rate > 0.05 FROM {_week}_safety
UNION ALL SELECT 'fidelity_score', 0.0, fid, 0.0, 'STABLE', FALSE FROM {_week}_safety
"""

# --- streams ------------------------------------------------------------------------
CTES["event_base"] = (
    "SELECT 'value' AS variable, value AS x FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00'"
)
CTES["event_edges"] = edge_rows("event_base")
CTES["event_weeks"] = """
SELECT CAST(time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01 00:00:00') AS VARCHAR) AS variable,
       value AS x FROM events
"""
CTES["event_week_edges"] = """
SELECT DISTINCT w.variable, e.edge, e.position, e.edges FROM event_edges e,
  (SELECT DISTINCT variable FROM event_weeks) w
"""
CTES["event_week_base"] = """
SELECT w.variable, b.x FROM event_base b, (SELECT DISTINCT variable FROM event_weeks) w
"""
CTES["event_week_bins"] = bin_rows("event_week_edges", "event_week_base", "event_weeks")
CTES["event_week_psi"] = psi_rows("event_week_bins")


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the CTEs it names, directly or through others, in order."""
    needed: set[str] = set()
    pending = [body]
    while pending:
        words = set(re.findall(r"\b\w+\b", pending.pop()))
        for name in CTES:
            if name in words and name not in needed:
                needed.add(name)
                pending.append(CTES[name])
    parts = [f"{name} AS ({CTES[name].strip()})" for name in CTES if name in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + body.strip()


QUERIES: dict[str, str] = {}

for _table in ("users", "sessions", "loans", "payments"):
    QUERIES[f"silver_{_table}"] = f"SELECT * FROM silver_{_table}"

QUERIES["monthly_volume"] = "SELECT user_id, monthly_volume FROM volume"
QUERIES["session_regularity"] = "SELECT user_id, session_regularity FROM regularity"
QUERIES["default_target"] = "SELECT * FROM targets"
QUERIES["gold_features"] = "SELECT * FROM gold"
QUERIES["cohort_default_rate"] = (
    "SELECT reg_month, round(default_rate, 6) AS default_rate, cohort_size FROM cohorts"
)
QUERIES["cohort_alerts"] = (
    "SELECT reg_month, round(default_rate, 6) AS default_rate, cohort_size "
    "FROM cohorts WHERE default_rate > 0.15"
)


QUERIES["csv_ingest"] = "SELECT * FROM bronze_sessions"
QUERIES["json_ingest"] = "SELECT * FROM bronze_loans"
QUERIES["json_array_ingest"] = "SELECT * FROM bronze_users"
QUERIES["csv_quoted_ingest"] = """
SELECT CAST(doc_id AS VARCHAR) AS user_id, source AS created_at, '"' || text || '", ' AS country,
       CAST(NULL AS VARCHAR) AS updated_at, CAST(NULL AS VARCHAR) AS ingestion_timestamp
FROM documents
"""
QUERIES["stream_json_bronze"] = "SELECT * FROM bronze_loans"
def failing(*conditions: str) -> str:
    return f"COUNT(*) FILTER (WHERE {' AND '.join(conditions)})"


def surplus(key: str, table: str) -> str:
    """Rows beyond the first of each key, counted by grouping."""
    return (
        f"(SELECT CAST(coalesce(SUM(n - 1), 0) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM bronze_{table} "
        f"WHERE {key} IS NOT NULL GROUP BY {key} HAVING COUNT(*) > 1))"
    )


AUDIT = {
    "users": {
        "users_null_pk": failing("user_id IS NULL"),
        "users_duplicate_pk": surplus("user_id", "users"),
        "users_invalid_timestamps": failing(
            "user_id IS NOT NULL",
            "("
            + " OR ".join(
                f"{ts_iso(c)} IS NULL" for c in ("created_at", "updated_at", "ingestion_timestamp")
            )
            + ")",
        ),
    },
    "sessions": {
        "sessions_null_pk": failing("(session_id IS NULL OR user_id IS NULL)"),
        "sessions_invalid_timestamp": failing(
            "session_id IS NOT NULL", f"{ts_iso('session_timestamp')} IS NULL"
        ),
    },
    "loans": {
        "loans_null_pk": failing("(loan_id IS NULL OR user_id IS NULL)"),
        "loans_duplicate_pk": surplus("loan_id", "loans"),
        "loans_invalid_disbursement_date": failing(
            "loan_id IS NOT NULL", f"{date('disbursement_date')} IS NULL"
        ),
        "loans_invalid_amount": failing(
            "loan_id IS NOT NULL", "TRY_CAST(amount AS DOUBLE) IS NULL"
        ),
    },
    "payments": {
        "payments_null_pk": failing("(payment_id IS NULL OR loan_id IS NULL)"),
        "payments_duplicate_pk": surplus("payment_id", "payments"),
        "payments_invalid_due_date": failing(
            "payment_id IS NOT NULL", f"{date('due_date')} IS NULL"
        ),
        "payments_invalid_payment_date": failing(
            "payment_id IS NOT NULL", "payment_date IS NOT NULL", f"{date('payment_date')} IS NULL"
        ),
        "payments_invalid_amounts": failing(
            "payment_id IS NOT NULL",
            "(TRY_CAST(amount_due AS DOUBLE) IS NULL OR TRY_CAST(amount_paid AS DOUBLE) IS NULL)",
        ),
    },
}
for _table, _checks in AUDIT.items():
    CTES[f"audit_{_table}"] = (
        "SELECT " + ", ".join(f"{q} AS {n}" for n, q in _checks.items()) + f" FROM bronze_{_table}"
    )
QUERIES["audit_counts"] = "SELECT * FROM " + ", ".join(f"audit_{t}" for t in AUDIT)
QUERIES["audit_warning_lines"] = (
    "SELECT \"check\", anomalies, 'Data Quality Anomaly: ' || \"check\" || ' = ' || anomalies || "
    "' invalid/duplicate records detected.' AS warning FROM ("
    + " UNION ALL ".join(
        f"SELECT '{n}' AS \"check\", {n} AS anomalies FROM audit_{t}"
        for t, checks in AUDIT.items()
        for n in checks
    )
    + ") WHERE anomalies > 0"
)
QUERIES["layer_counts"] = " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{name}' AS table_name, COUNT(*) AS rows FROM {layer}_{short}"
    for layer in ("bronze", "silver")
    for name, short in (
        ("users", "users"),
        ("user_sessions", "sessions"),
        ("loans", "loans"),
        ("loan_payments", "payments"),
    )
)
for _n, _part in ((1, "updated_at < '1999-01-01'"), (2, "updated_at >= '1998-01-01'")):
    CTES[f"silver_loans_{_n}"] = newest(
        "typed_loans", "loan_id", f"{LOAN_KEYS} AND {_part}", VERSION, LOAN_VALID
    )
QUERIES["silver_upsert"] = """
SELECT * FROM silver_loans_2 UNION ALL
SELECT * FROM silver_loans_1 WHERE loan_id NOT IN (SELECT loan_id FROM silver_loans_2)
"""
DATED = ("volume", "regularity", "late_payers", "targets", "gold")
for _name in DATED:
    _earlier = CTES[_name].replace(OBS, "DATE '2000-06-01'")
    for _inner in DATED:
        _earlier = re.sub(rf"(FROM|JOIN) {_inner}\b", rf"\1 {_inner}_earlier", _earlier)
    CTES[f"{_name}_earlier"] = _earlier
QUERIES["gold_merge_second_run"] = "SELECT * FROM gold UNION ALL SELECT * FROM gold_earlier"
QUERIES["gold_daily_partials"] = QUERIES["gold_merge_second_run"]
QUERIES["incremental_audit"] = " UNION ALL ".join(
    f"SELECT '{n}' AS \"check\", {n} AS anomalies FROM audit_{t}" for t, checks in AUDIT.items() for n in checks
)
QUERIES["pipeline_cohorts"] = QUERIES["cohort_default_rate"]
QUERIES["cohort_report"] = """
SELECT COUNT(*) AS alerting_cohorts, CASE WHEN COUNT(*) > 0 THEN
  '# Diagnostic Drift Report — Cohort 2000-07-01' || chr(10) || chr(10) ||
  'Generated for observation cohort date: 2000-07-01' || chr(10) ||
  'Status: WARNING — High Default Rate Alert Triggered' || chr(10) || chr(10) ||
  'Potential shift in credit profile or adverse selection detected in the following cohorts:'
  || chr(10) || string_agg(
    '- **Registration Month**: ' || coalesce(reg_month, 'None') || ' | **Default Rate**: ' ||
    format('{:.2f}', default_rate * 100) || '% | **Cohort Size**: ' || cohort_size || ' users'
    || chr(10), '' ORDER BY reg_month NULLS FIRST) END AS drift_report
FROM cohorts WHERE default_rate > 0.15
"""
QUERIES["synthetic_income"] = "SELECT user_id, round(income, 6) AS income FROM incomes"
QUERIES["stratified_split"] = "SELECT user_id, target_default_30d, is_test FROM parts"
QUERIES["bounded_imputed_features"] = """
SELECT user_id, target_default_30d, is_test,
       round(coalesce(monthly_volume, mv), 6) AS monthly_volume,
       round(coalesce(session_regularity, sr), 6) AS session_regularity,
       round(coalesce(income, inc), 6) AS income
FROM parts, medians
"""
QUERIES["class_weight"] = """
SELECT round(CASE WHEN SUM(target_default_30d) > 0
  THEN CAST(COUNT(*) - SUM(target_default_30d) AS DOUBLE) / SUM(target_default_30d)
  ELSE 1.0 END, 6) AS class_weight FROM parts WHERE NOT is_test
"""
QUERIES["roc_auc_gini"] = (
    "SELECT round(roc_auc, 6) AS roc_auc, round(2.0 * roc_auc - 1.0, 6) AS gini_index FROM auc"
)
QUERIES["ks_statistic"] = (
    "SELECT round(MAX(abs(negatives_cdf - positives_cdf)), 6) AS ks_statistic FROM cdfs"
)
QUERIES["class_cdfs"] = (
    "SELECT score, round(positives_cdf, 6) AS positives_cdf, "
    "round(negatives_cdf, 6) AS negatives_cdf FROM cdfs"
)
QUERIES["accuracy_logloss"] = (
    "SELECT round(accuracy, 6) AS accuracy, round(log_loss, 6) AS log_loss FROM evaluation"
)
QUERIES["model_evaluation"] = "SELECT " + ", ".join(
    f"round({m}, 6) AS {m}"
    for m in ("roc_auc", "gini_index", "ks_statistic", "accuracy", "log_loss")
) + ", CAST(0 AS BIGINT) AS unscored_rows FROM evaluation"
QUERIES["credit_decisions"] = f"""
SELECT user_id, pd, round({limit_of('pd', 'income')}, 6) AS credit_limit,
       {decision_of('pd')} AS decision
FROM (SELECT user_id, income, round({uniform('user_id', 7)} * 0.2, 4) AS pd FROM incomes)
"""
QUERIES["request_validation"] = """
SELECT concat_ws(',', CASE WHEN user_id = '' THEN 'user_id' END,
                 CASE WHEN monthly_volume < 0 THEN 'monthly_volume' END,
                 CASE WHEN session_regularity NOT BETWEEN 0 AND 30 THEN 'session_regularity' END,
                 CASE WHEN income IS NULL OR isnan(income) OR income < 0 THEN 'income' END) AS reasons,
       COUNT(*) AS requests
FROM requests GROUP BY 1
"""
QUERIES["scoring_fallback"] = """
SELECT prediction_id, round(probability_of_default, 6) AS probability_of_default,
       round(credit_limit, 6) AS credit_limit, decision, status FROM answers
"""
QUERIES["prediction_log_anomalies"] = """
SELECT * REPLACE (round(income, 6) AS income, round(credit_limit, 6) AS credit_limit,
                  round(probability_of_default, 6) AS probability_of_default,
                  round(monthly_volume, 6) AS monthly_volume) FROM prediction_logs
"""
QUERIES["batch_repeated_requests"] = """
SELECT 'p' || event_id AS prediction_id,
       CASE WHEN event_id % 33 <= 30 THEN 'FALLBACK_APPROVE' ELSE 'session_regularity' END AS answer,
       event_id % 33 <= 30 AS logged
FROM events
"""
QUERIES["gbt_scores"] = """
SELECT user_id, TRUE AS in_range, TRUE AS limit_fits, TRUE AS decision_fits,
       TRUE AS same_when_loaded, 'SUCCESS' AS status
FROM gold
"""
# At most 256 cuts a feature, the smallest values of runs of nearly equal counts.
CTES["train_part"] = """
SELECT target_default_30d AS y, coalesce(monthly_volume, mv) AS monthly_volume,
       CAST(coalesce(session_regularity, sr) AS DOUBLE) AS session_regularity, coalesce(income, inc) AS income
FROM parts, medians WHERE NOT is_test
"""
CTES["train_values"] = " UNION ALL ".join(
    f"SELECT '{f}' AS variable, {f} AS x, y FROM train_part" for f in ("monthly_volume", "session_regularity", "income")
)
CTES["train_cuts"] = """
SELECT variable, MIN(x) AS cut FROM (
  SELECT variable, x, ((SUM(n) OVER (PARTITION BY variable ORDER BY x) - n) * 256) // SUM(n) OVER (PARTITION BY variable) AS part
  FROM (SELECT variable, x, COUNT(*) AS n FROM train_values GROUP BY ALL))
GROUP BY variable, part
"""
QUERIES["boosting_cuts"] = "SELECT variable, round(cut, 6) AS cut FROM train_cuts"
# At a margin of 0 the gradient is (1/2 - y) w and the hessian w/4; w makes both classes weigh the same.
QUERIES["boosted_stump"] = """
SELECT variable, round(cut, 6) AS cut, round(-0.05 * gl / (hl + 1), 6) AS below, round(-0.05 * gr / (hr + 1), 6) AS above
FROM (
  SELECT variable, cut, SUM(g) FILTER (x < cut) AS gl, SUM(h) FILTER (x < cut) AS hl,
         SUM(g) FILTER (x >= cut) AS gr, SUM(h) FILTER (x >= cut) AS hr
  FROM train_cuts JOIN (
    SELECT variable, x, (0.5 - y) * w AS g, 0.25 * w AS h
    FROM (SELECT *, CASE WHEN y = 1 THEN (SELECT CAST(COUNT(*) - SUM(y) AS DOUBLE) / SUM(y) FROM train_part)
                         ELSE CAST(1 AS DOUBLE) END AS w FROM train_values)) USING (variable)
  GROUP BY variable, cut)
WHERE hl >= 1 AND hr >= 1
ORDER BY gl * gl / (hl + 1) + gr * gr / (hr + 1) DESC LIMIT 1
"""
QUERIES["second_order_scores"] = """
SELECT user_id, TRUE AS in_range, TRUE AS limit_fits, TRUE AS decision_fits,
       TRUE AS same_when_loaded, 'SUCCESS' AS status
FROM gold
"""
# The probabilities are a model's own: these say what must hold of them, whatever they are.
QUERIES["model_answers"] = """
SELECT channel, user_id, TRUE AS same_as_model, TRUE AS limit_fits, TRUE AS decision_fits,
       'SUCCESS' AS status, FALSE AS is_anomaly
FROM gold, (SELECT unnest(['batch', 'stream']) AS channel)
"""
QUERIES["training_gate"] = f"""
SELECT '2000-07-01' AS run_id, unnest(['roc_auc', 'gini_index', 'ks_statistic', 'accuracy', 'log_loss']) AS name,
       TRUE AS accepted
"""
QUERIES["rolling_latency_dirty"] = """
SELECT event_type, ts, window_requests, coalesce(isnan(m), FALSE) AS not_a_number,
       CASE WHEN m < 1e9 THEN round(m, 6) END AS rolling_mean,
       CASE WHEN m >= 1e9 AND NOT isnan(m) THEN round(m / 1e15) END AS in_peta
FROM (
  SELECT DISTINCT event_type, ts, COUNT(*) OVER w AS window_requests,
         CASE WHEN COUNT(*) FILTER (isnan(v)) OVER w > 0 THEN CAST('NaN' AS DOUBLE)
              ELSE SUM(v) FILTER (NOT isnan(v)) OVER w / COUNT(v) OVER w END AS m
  FROM (SELECT event_type, ts, CASE WHEN event_id % 7 = 0 THEN NULL
                                    WHEN event_id % 501 = 0 THEN CAST('NaN' AS DOUBLE)
                                    WHEN event_id % 1001 = 1 THEN 1e21 ELSE value END AS v FROM events)
  WINDOW w AS (PARTITION BY event_type ORDER BY ts
               RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW))
"""
QUERIES["rolling_latency"] = """
SELECT DISTINCT event_type, ts, COUNT(*) OVER w AS window_requests,
       round(AVG(value) OVER w, 6) AS rolling_mean, AVG(value) OVER w > 100 AS sla_warning
FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts
             RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW)
"""
QUERIES["latency_sla"] = """
SELECT event_type, COUNT(*) AS requests, COUNT(*) FILTER (WHERE value > 100) AS over_sla,
       round(AVG(CASE WHEN value <= 100 THEN 1.0 ELSE 0.0 END), 6) AS compliance,
       bool_and(value <= 100) AS all_within_sla
FROM events GROUP BY event_type
"""
QUERIES["telemetry_summary"] = """
SELECT CAST(timestamp AS DATE) AS log_date, COUNT(*) AS requests,
       round(AVG(latency_ms), 6) AS mean_latency_ms,
       round(quantile_cont(latency_ms, 0.5), 6) AS p50_latency_ms,
       round(quantile_cont(latency_ms, 0.95), 6) AS p95_latency_ms,
       round(quantile_cont(latency_ms, 0.99), 6) AS p99_latency_ms,
       round(AVG(probability_of_default), 6) AS mean_pd,
       round(AVG(CASE WHEN status = 'FALLBACK' THEN 1.0 ELSE 0.0 END), 6) AS fallback_rate,
       round(AVG(CASE WHEN is_anomaly THEN 1.0 ELSE 0.0 END), 6) AS anomaly_rate
FROM prediction_logs GROUP BY 1
"""
QUERIES["decile_edges"] = (
    "SELECT variable, CAST(position AS INTEGER) AS position, round(edge, 6) AS edge FROM base_edges"
)
QUERIES["psi_by_variable"] = """
SELECT variable_name, round(psi_value, 6) AS psi_value, drift_status, alert_triggered
FROM drifted_week WHERE avg_value IS NULL
"""
# Sketches draw lots: what they must keep to is compared, not their values.
QUERIES["sketched_percentiles"] = """
SELECT log_date, rank, TRUE AS within_rank_error
FROM (SELECT DISTINCT CAST(timestamp AS DATE) AS log_date FROM prediction_logs WHERE latency_ms IS NOT NULL),
     (SELECT unnest([CAST(0.5 AS DOUBLE), 0.95, 0.99]) AS rank)
"""
QUERIES["drift_sketched_baseline"] = """
SELECT variable_name, drift_status, alert_triggered, TRUE AS near_exact FROM drifted_week WHERE avg_value IS NULL
"""
QUERIES["psi_bin_counts"] = (
    "SELECT variable, CAST(bin AS INTEGER) AS bin, e0 AS expected, a0 AS actual FROM drifted_bins"
)
QUERIES["week_logs"] = f"""
SELECT prediction_id, timestamp, CAST(timestamp AS DATE) AS log_date, is_anomaly
FROM prediction_logs WHERE {between_days(*WEEKS['stable'])}
"""
QUERIES["training_cohort"] = (
    "SELECT user_id, monthly_volume, session_regularity, target_default_30d FROM gold"
)
QUERIES["payments_past_due"] = f"""
SELECT payment_id, CAST(d AS INTEGER) AS days_past_due, d > 30 AS is_default
FROM (SELECT payment_id, date_diff('day', due_date, coalesce(payment_date, {AS_OF})) AS d
      FROM silver_payments)
"""
QUERIES["weekly_drift_metrics"] = """
SELECT sha256('2024-01-22|' || variable_name) AS metric_id,
       TIMESTAMP '2024-01-22 00:00:00' AS timestamp, variable_name,
       round(psi_value, 6) AS psi_value, drift_status, alert_triggered,
       DATE '2024-01-22' AS metric_date
FROM stable_week
"""
QUERIES["drift_week_comparison"] = (
    "SELECT variable_name, "
    + ", ".join(
        f"{w}.{c} AS {p}_{c}" if c in ("drift_status", "alert_triggered")
        else f"round({w}.{c}, 6) AS {p}_{c}"
        for w, p in (("a", "first"), ("b", "second"))
        for c in ("psi_value", "avg_value", "rate_value", "drift_status", "alert_triggered")
    )
    + " FROM stable_week a JOIN drifted_week b USING (variable_name)"
)
CTES["gold_base"] = (
    "SELECT 'monthly_volume' AS variable, monthly_volume AS x FROM incomes "
    "UNION ALL SELECT 'session_regularity', CAST(session_regularity AS DOUBLE) FROM incomes "
    "UNION ALL SELECT 'income', income FROM incomes"
)
CTES["gold_base_edges"] = edge_rows("gold_base")
CTES["calm_long"] = long_of("prediction_logs", between_days(*WEEKS["stable"]))
CTES["gold_base_bins"] = bin_rows("gold_base_edges", "gold_base", "calm_long")
CTES["gold_base_psi"] = psi_rows("gold_base_bins")
# Tracked: five parameters; PSI and alert of seven variables; a flag, three averages and a rate.
QUERIES["drift_on_gold_baseline"] = """
SELECT variable AS variable_name, round(psi, 6) AS psi_value,
       CASE WHEN psi >= 0.25 THEN 'DRIFT' WHEN psi >= 0.1 THEN 'MODERATE' ELSE 'STABLE' END AS drift_status,
       psi >= 0.25 AS alert_triggered, TRUE AS class_fits, CAST(5 + 7 * 2 + 1 + 3 + 1 AS BIGINT) AS tracked_rows
FROM gold_base_psi
UNION ALL SELECT 'probability_of_default', NULL, NULL, NULL, TRUE, 24
UNION ALL SELECT variable_name, round(psi_value, 6), drift_status, alert_triggered, TRUE, 24
FROM stable_week WHERE variable_name IN ('toxicity_score', 'prompt_injection_score', 'fidelity_score')
"""
QUERIES["drift_overall_alert"] = """
SELECT bool_or(alert_triggered) AS alerts_triggered,
       COUNT(*) FILTER (WHERE alert_triggered) AS alerting_metrics
FROM drifted_week
"""
QUERIES["drift_run_metrics"] = """
SELECT 'drifted-week' AS run_id, 'metric' AS kind, name, CAST(NULL AS VARCHAR) AS value,
       round(number, 6) AS number FROM (
  SELECT 'psi_' || variable_name AS name, psi_value AS number FROM drifted_week
  UNION ALL SELECT 'alert_' || variable_name, CAST(alert_triggered AS INTEGER) FROM drifted_week
  UNION ALL SELECT 'drift_alert_probability_of_default', CAST(psi_value >= 0.25 AS INTEGER)
    FROM drifted_week WHERE variable_name = 'probability_of_default'
  UNION ALL SELECT 'avg_' || variable_name, avg_value FROM drifted_week WHERE avg_value IS NOT NULL
  UNION ALL SELECT 'rate_prompt_injection', rate_value
    FROM drifted_week WHERE variable_name = 'prompt_injection_score')
"""
QUERIES["dialogue_scores"] = (
    "SELECT * REPLACE (round(toxicity_score, 6) AS toxicity_score) FROM dialogue_logs"
)
CTES["long_lexicon"] = """
SELECT DISTINCT word FROM (SELECT unnest(string_split(lower(text), ' ')) AS word FROM documents)
WHERE length(word) BETWEEN 4 AND 20
"""
QUERIES["large_lexicon_toxicity"] = """
SELECT conv_id, turn, round(CASE WHEN coalesce(text, '') = '' THEN 0.0 ELSE least(n / 3.0, 1.0) END, 6) AS toxicity_score
FROM (SELECT conv_id, turn, any_value(text) AS text, CAST(COUNT(word) AS DOUBLE) AS n
      FROM conversations LEFT JOIN long_lexicon ON contains(lower(text), word)
      GROUP BY conv_id, turn)
"""
QUERIES["lexicon_words_found"] = """
SELECT word, COUNT(DISTINCT (conv_id, turn)) AS turns
FROM conversations JOIN long_lexicon ON contains(lower(text), word)
GROUP BY word
"""
QUERIES["dialogue_safety_summary"] = """
SELECT variable_name, CAST(0 AS DOUBLE) AS psi_value, round(v, 6) AS avg_value, round(r, 6) AS rate_value,
       'STABLE' AS drift_status, alert AS alert_triggered FROM (
  SELECT 'toxicity_score' AS variable_name, AVG(toxicity_score) AS v, 0.0::DOUBLE AS r,
         AVG(toxicity_score) > 0.20 AS alert FROM dialogue_logs
  UNION ALL SELECT 'prompt_injection_score', AVG(prompt_injection_score),
         AVG(CASE WHEN prompt_injection_score > 0 THEN 1.0 ELSE 0.0 END),
         AVG(CASE WHEN prompt_injection_score > 0 THEN 1.0 ELSE 0.0 END) > 0.05 FROM dialogue_logs
  UNION ALL SELECT 'fidelity_score', AVG(fidelity_score), 0.0, FALSE FROM dialogue_logs)
"""
QUERIES["stream_silver_users"] = "SELECT * FROM silver_users"
QUERIES["stream_prediction_log"] = """
SELECT 'p' || event_id AS prediction_id, ts AS timestamp, CAST(user_id AS VARCHAR) AS user_id,
       round(value * 40.0, 6) AS monthly_volume,
       CAST(event_id * 7 % 33 AS INTEGER) AS session_regularity, round(value * 100.0, 6) AS income,
       CAST(0.08 AS DOUBLE) AS probability_of_default, CAST(2000 AS DOUBLE) AS credit_limit, 'FALLBACK_APPROVE' AS decision,
       value AS latency_ms, 'FALLBACK' AS status, FALSE AS is_anomaly
FROM events WHERE event_id * 7 % 33 <= 30
"""
QUERIES["stream_latency_windows"] = """
SELECT event_type, start AS window_start, start + INTERVAL 60 SECONDS AS window_end,
       COUNT(*) AS requests, round(AVG(value), 6) AS mean_latency, AVG(value) > 100 AS sla_warning
FROM (SELECT event_type, value, time_bucket(INTERVAL 10 SECONDS, ts)
               - to_seconds(10 * CAST(unnest(range(6)) AS INTEGER)) AS start FROM events)
GROUP BY event_type, start
"""
QUERIES["stream_rolling_latency"] = QUERIES["rolling_latency"]
QUERIES["stream_final_windows"] = """
WITH w AS (
       SELECT DISTINCT event_type, time_bucket(INTERVAL 10 SECONDS, ts)
              - to_seconds(10 * CAST(unnest(range(6)) AS INTEGER)) + INTERVAL 60 SECONDS AS window_end FROM events),
     f AS (SELECT *, window_end <= (SELECT MAX(ts) - INTERVAL 2 MINUTES FROM events) AS done FROM w)
SELECT event_type, COUNT(*) FILTER (done) AS final_windows, COUNT(*) FILTER (NOT done) AS open_windows,
       MAX(window_end) FILTER (done) AS last_final
FROM f GROUP BY event_type
"""
QUERIES["stream_weekly_psi"] = """
SELECT CAST(variable AS TIMESTAMP) AS week, 'value' AS variable, round(psi, 6) AS psi
FROM event_week_psi
"""
QUERIES["stream_late_requests"] = """
SELECT 'p' || event_id AS prediction_id, ts AS timestamp, CAST(ts AS DATE) AS log_date,
       'FALLBACK' AS status
FROM events
"""
QUERIES["stream_repeated_ids"] = """
SELECT 'p' || event_id AS prediction_id, sent AS timestamp, CAST(sent AS DATE) AS log_date, 'FALLBACK' AS status
FROM (SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN ts ELSE ts + INTERVAL 2 DAY END AS sent FROM events)
"""


def all_sql() -> dict[str, str]:
    return {name: with_ctes(body) for name, body in QUERIES.items()}
