"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The driver pre-registers every generic table as a view; these strings only
read those views.  They restate each operator's rule directly in SQL, written
independently of the Spark plans in ``plans.catalog``.
"""

from __future__ import annotations

from dealsieve.plans import views as V

DECISIONS_SQL = (
    "(SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS company_number, d.decision_date "
    "FROM orders, (VALUES " + ", ".join(f"(TIMESTAMP '{d}')" for d in V.DECISION_DATES) + ") AS d(decision_date))"
)

FACT_SQL = {
    "filings": ("SELECT CAST(o_custkey AS VARCHAR) AS company_number, o_orderdate AS fact_date, "
                "o_orderkey, o_totalprice, o_orderstatus FROM orders",
                ["o_orderkey"], ["o_totalprice", "o_orderstatus"]),
    "tenders": ("SELECT CAST(user_id AS VARCHAR) AS company_number, ts AS fact_date, event_id, value "
                "FROM events WHERE event_type = 'purchase'",
                ["event_id"], ["value"]),
    "charges": ("SELECT CAST(o.o_custkey AS VARCHAR) AS company_number, l.l_shipdate AS fact_date, "
                "l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_quantity "
                "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey",
                ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], ["l_extendedprice", "l_quantity"]),
    "ownership": ("SELECT CAST(c_custkey AS VARCHAR) AS company_number, "
                  f"TIMESTAMP '{V.OWNERSHIP_SNAPSHOT_DATE}' AS fact_date, c_mktsegment, c_nationkey FROM customer",
                  [], ["c_mktsegment", "c_nationkey"]),
}


def as_of_sql(name: str) -> str:
    """The as-of pick as the greatest (date, tie keys, rest) record known at each decision date."""
    body, ties, rest = FACT_SQL[name]
    cols = ["fact_date"] + ties + rest
    record = ", ".join(f"{c} := f.{c}" for c in cols)
    return f"""
        SELECT company_number, decision_date, {", ".join(f"best.{c} AS {c}" for c in cols)} FROM (
            SELECT f.company_number, w.decision_date, max(struct_pack({record})) AS best
            FROM (SELECT DISTINCT company_number, decision_date FROM {DECISIONS_SQL}) AS w, ({body}) AS f
            WHERE f.company_number = w.company_number AND w.decision_date >= f.fact_date
            GROUP BY f.company_number, w.decision_date)"""


def decision_rows_sql() -> str:
    selects, joins = ["d.company_number", "d.decision_date"], []
    for i, name in enumerate(["filings", "tenders", "charges", "ownership"]):
        _, ties, rest = FACT_SQL[name]
        alias = f"t{i}"
        selects += [f"{alias}.{c} AS {name}__{c}" for c in ["fact_date"] + ties + rest]
        joins.append(f"LEFT JOIN ({as_of_sql(name)}) AS {alias} "
                     f"ON d.company_number = {alias}.company_number AND d.decision_date = {alias}.decision_date")
    return f"SELECT {', '.join(selects)} FROM {DECISIONS_SQL} AS d " + " ".join(joins)


def future_fact_leaks_sql() -> str:
    parts = []
    for name, (body, _, _) in FACT_SQL.items():
        newest = (f"SELECT d.decision_date, n.fact_date FROM (SELECT DISTINCT * FROM {DECISIONS_SQL}) d JOIN "
                  f"(SELECT company_number, max(fact_date) AS fact_date FROM ({body}) GROUP BY company_number) n "
                  "ON d.company_number = n.company_number")
        for how, rows in (("as_of", as_of_sql(name)), ("newest", newest)):
            parts.append(f"SELECT '{name}' AS table_name, '{how}' AS picked, "
                         f"COUNT(*) FILTER (WHERE fact_date > decision_date) AS leak_count, "
                         f"COUNT(*) AS rows_checked FROM ({rows})")
    return " UNION ALL ".join(parts)


ORACLE: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql


def quantiles_sql(source: str, group_cols: list[str], value: str, probs: list[float], names: list[str]) -> str:
    """Linear quantiles spelled out: position (n-1)*p into the sorted values of each group,
    a + (b-a)*t below t = 0.5 and b - (b-a)*(1-t) from there (the array-library rule)."""
    g = ", ".join(group_cols)
    probs_sql = ", ".join(f"({i}, CAST({p!r} AS DOUBLE))" for i, p in enumerate(probs))
    pivots = ", ".join(f"MAX(CASE WHEN i = {i} THEN qv END) AS {n}" for i, n in enumerate(names))
    return f"""
        WITH s AS (SELECT {g}, list_sort(list({value})) AS l, COUNT({value}) AS n
                   FROM ({source}) WHERE {value} IS NOT NULL GROUP BY {g}),
             p AS (SELECT s.*, pr.i, CAST(s.n - 1 AS DOUBLE) * pr.p AS pos
                   FROM s, (VALUES {probs_sql}) AS pr(i, p)),
             ab AS (SELECT *, l[CAST(FLOOR(pos) AS BIGINT) + 1] AS a,
                           l[LEAST(CAST(FLOOR(pos) AS BIGINT) + 2, n)] AS b, pos - FLOOR(pos) AS t FROM p)
        SELECT {g}, {pivots} FROM (
            SELECT {g}, i, CASE WHEN t >= 0.5 THEN b - (b - a) * (1.0 - t) ELSE a + (b - a) * t END AS qv FROM ab)
        GROUP BY {g}"""


register("asof_latest_fact", as_of_sql("filings"))
register("decision_rows", decision_rows_sql())
register("future_fact_leaks", future_fact_leaks_sql())


# ---------------------------------------------------------------- scores, valuation, validation

BALANCE_SHEETS_SQL = """
    SELECT CAST(s.s_suppkey AS VARCHAR) AS company_number,
           x.net - x.gross * 0.5 AS working_capital,
           s.s_acctbal * 10 AS retained_earnings,
           CASE WHEN s.s_acctbal >= 0 THEN x.disc END AS ebit,
           x.qty * 10 AS book_value_of_equity,
           x.tax AS total_liabilities,
           CASE WHEN s.s_nationkey = 7 THEN 0.0 ELSE x.gross END AS total_assets
    FROM supplier s LEFT JOIN (
        SELECT l_suppkey, SUM(l_extendedprice * (1 - l_discount)) AS net, SUM(l_extendedprice) AS gross,
               SUM(l_extendedprice * l_tax) AS tax, SUM(l_extendedprice * l_discount) AS disc,
               SUM(l_quantity) AS qty
        FROM lineitem GROUP BY l_suppkey) x ON s.s_suppkey = x.l_suppkey"""

register("distress_scores", f"""
    SELECT company_number,
           ROUND(CASE WHEN total_assets IS NULL OR total_assets = 0
                        OR total_liabilities IS NULL OR total_liabilities = 0 THEN NULL
                      WHEN ebit IS NOT NULL THEN 6.56 * (working_capital / total_assets)
                           + 3.26 * (retained_earnings / total_assets) + 6.72 * (ebit / total_assets)
                           + 1.05 * (book_value_of_equity / total_liabilities)
                      ELSE 6.56 * (working_capital / total_assets) + 3.26 * (retained_earnings / total_assets)
                           + 1.05 * (book_value_of_equity / total_liabilities) END, 6) AS distress_score,
           CASE WHEN ebit IS NOT NULL THEN 'full' ELSE 'reduced_no_ebit' END AS score_form
    FROM ({BALANCE_SHEETS_SQL})""")

HEADCOUNTS_SQL = """
    SELECT CAST(c_custkey AS VARCHAR) AS company_number, CAST(c_nationkey AS VARCHAR) AS industry_code,
           CAST(CASE WHEN c_acctbal >= 0 THEN FLOOR(c_acctbal / 100) + 1 END AS DOUBLE) AS filed_headcount,
           c_acctbal * ((c_nationkey % 5) + 1) * 400 AS multiples_revenue_estimate
    FROM customer"""

BENCHMARKS_SQL = """
    SELECT CAST(n_nationkey AS VARCHAR) AS industry_code, 50000.0 + n_nationkey * 1000 AS revenue_per_employee,
           1 AS benchmark_order
    FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'MIDDLE EAST'
    UNION ALL
    SELECT CAST(n_nationkey AS VARCHAR), 999.0, 2
    FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE'"""

register("revenue_cross_check", f"""
    WITH b AS (SELECT industry_code, revenue_per_employee FROM (
                 SELECT *, ROW_NUMBER() OVER (PARTITION BY industry_code ORDER BY benchmark_order) AS rn
                 FROM ({BENCHMARKS_SQL})) WHERE rn = 1),
         e AS (SELECT h.company_number, h.filed_headcount * b.revenue_per_employee AS hc_est,
                      h.multiples_revenue_estimate AS m_est
               FROM ({HEADCOUNTS_SQL}) h LEFT JOIN b ON h.industry_code = b.industry_code),
         r AS (SELECT *, CASE WHEN hc_est > 0 AND m_est > 0
                              THEN GREATEST(hc_est, m_est) / LEAST(hc_est, m_est) END AS ratio FROM e)
    SELECT company_number, hc_est AS headcount_revenue_estimate,
           m_est AS multiples_revenue_estimate, ratio AS disagreement_ratio,
           COALESCE(ratio <= 2.0, FALSE) AS revenue_usable
    FROM r""")

PEERS_SQL = """
    SELECT code AS industry_code, p_retailprice / 100 AS multiple
    FROM (SELECT *, LPAD(CAST((p_size * 97) % 1000 AS VARCHAR), 3, '0') AS code FROM part)
    WHERE substr(code, 1, 1) NOT IN ('4', '5', '6', '7', '8') OR p_partkey % (p_size * 3 + 7) = 0"""
TARGETS_SQL = """
    SELECT row_number() OVER () AS target_row, * FROM (
        SELECT CAST(s_suppkey AS VARCHAR) AS company_number,
               CASE WHEN s_nationkey = 0 THEN SUBSTR(code, 1, 2) WHEN s_nationkey = 1 THEN ''
                    WHEN s_nationkey = 2 THEN 'X' || code ELSE code END AS industry_code,
               s_acctbal AS scaling_value
        FROM (SELECT *, LPAD(CAST((s_suppkey * 37) % 1000 AS VARCHAR), 3, '0') AS code FROM supplier)
        UNION ALL
        SELECT CAST(s_suppkey AS VARCHAR), LPAD(CAST((s_suppkey * 53) % 1000 AS VARCHAR), 3, '0'), s_acctbal * 2
        FROM supplier WHERE s_nationkey = 3)"""

# Brute force: count peers by startswith for each tried length, pick the first with >= 8.
WIDENING_SQL = f"""
    SELECT *, CASE WHEN n3 >= 8 THEN 3 WHEN n2 >= 8 THEN 2 WHEN n1 >= 8 THEN 1 ELSE 0 END AS code_length_used,
           CASE WHEN n3 >= 8 THEN n3 WHEN n2 >= 8 THEN n2 WHEN n1 >= 8 THEN n1 ELSE n0 END AS peer_count
    FROM (SELECT t.target_row, t.company_number, t.industry_code, t.scaling_value,
                 COUNT(*) FILTER (starts_with(p.industry_code, LEFT(t.industry_code, 3))) AS n3,
                 COUNT(*) FILTER (starts_with(p.industry_code, LEFT(t.industry_code, 2))) AS n2,
                 COUNT(*) FILTER (starts_with(p.industry_code, LEFT(t.industry_code, 1))) AS n1,
                 COUNT(*) AS n0
          FROM ({TARGETS_SQL}) t, ({PEERS_SQL}) p GROUP BY ALL)"""

register("peer_widening", f"""
    SELECT company_number, industry_code, CAST(code_length_used AS INTEGER) AS code_length_used, peer_count
    FROM ({WIDENING_SQL})""")

MATCHED_PEERS_SQL = f"""
    SELECT w.target_row, w.company_number, w.code_length_used, w.scaling_value, w.peer_count, p.multiple
    FROM ({WIDENING_SQL}) w JOIN ({PEERS_SQL}) p
      ON w.code_length_used = 0 OR starts_with(p.industry_code, LEFT(w.industry_code, w.code_length_used))"""

register("value_distribution", f"""
    SELECT company_number, CAST(code_length_used AS INTEGER) AS code_length_used, multiple,
           scaling_value * multiple AS estimated_value
    FROM ({MATCHED_PEERS_SQL})""")

VQ_NAMES = ["value_quantile_10", "value_quantile_25", "value_quantile_50", "value_quantile_75", "value_quantile_90"]
register("valuation_quantiles", f"""
    WITH q AS ({quantiles_sql(MATCHED_PEERS_SQL, ["target_row"], "multiple",
                              [0.10, 0.25, 0.50, 0.75, 0.90], ["m10", "m25", "m50", "m75", "m90"])}),
         w AS (SELECT DISTINCT target_row, company_number, peer_count, code_length_used, scaling_value
               FROM ({MATCHED_PEERS_SQL}))
    SELECT w.company_number, w.peer_count, CAST(w.code_length_used AS INTEGER) AS code_length_used,
           (CASE WHEN scaling_value >= 0 THEN scaling_value * m10 ELSE scaling_value * m90 END) AS value_quantile_10,
           (CASE WHEN scaling_value >= 0 THEN scaling_value * m25 ELSE scaling_value * m75 END) AS value_quantile_25,
           scaling_value * m50 AS value_quantile_50,
           (CASE WHEN scaling_value >= 0 THEN scaling_value * m75 ELSE scaling_value * m25 END) AS value_quantile_75,
           (CASE WHEN scaling_value >= 0 THEN scaling_value * m90 ELSE scaling_value * m10 END) AS value_quantile_90
    FROM w LEFT JOIN q ON w.target_row = q.target_row""")

ESTIMATES_SQL = """
    SELECT l_returnflag AS method_name, l_extendedprice * (1 - l_discount) AS estimated_value,
           l_extendedprice * (1 - l_tax) AS filed_value,
           l_extendedprice * (1 - l_discount) * (1 - CASE WHEN l_returnflag = 'R' THEN 0.10 ELSE 0.05 END)
               AS interval_lower,
           l_extendedprice * (1 - l_discount) * (1 + CASE WHEN l_returnflag = 'R' THEN 0.10 ELSE 0.05 END)
               AS interval_upper
    FROM lineitem"""

EQ_NAMES = ["error_quantile_5", "error_quantile_25", "error_quantile_50", "error_quantile_75", "error_quantile_95"]
register("validation_report", f"""
    WITH e AS (SELECT *, estimated_value - filed_value AS e FROM ({ESTIMATES_SQL})),
         q AS ({quantiles_sql("SELECT * FROM e", ["method_name"], "e", [0.05, 0.25, 0.50, 0.75, 0.95], EQ_NAMES)}),
         s AS (SELECT method_name, COUNT(*) AS sample_size, AVG(e) AS mean_error,
                      STDDEV_SAMP(e) AS error_standard_deviation, MAX(ABS(e)) AS worst_case_error,
                      AVG(CASE WHEN filed_value >= interval_lower AND filed_value <= interval_upper
                               THEN 1.0 ELSE 0.0 END) AS observed_coverage
               FROM e GROUP BY method_name)
    SELECT s.method_name, sample_size, ROUND(mean_error, 6) AS mean_error,
           ROUND(error_standard_deviation, 6) AS error_standard_deviation,
           worst_case_error,
           CASE WHEN mean_error > 0 THEN 'overestimates' WHEN mean_error IS NOT NULL THEN 'underestimates' END
               AS bias_direction,
           {", ".join(EQ_NAMES)},
           ROUND(observed_coverage, 6) AS observed_coverage, 0.8 AS target_coverage,
           observed_coverage >= 0.8 AS calibrated
    FROM s LEFT JOIN q ON s.method_name = q.method_name""")


# ---------------------------------------------------------------- facts, landing, candidates, web

MKT_SIC_SQL = ("CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in V.MKT_SIC.items()) + " END")
EMPTY = "CAST([] AS VARCHAR[])"

register("filing_records", f"""
    SELECT CAST(c.c_custkey AS VARCHAR) AS company_number, c.c_name AS company_name,
           'Unit ' || CAST(c.c_custkey AS VARCHAR) AS registered_address,
           'PC' || CAST(c.c_nationkey AS VARCHAR) AS registered_postcode,
           '19' || CAST(c.c_nationkey + 70 AS VARCHAR) || '-01-15' AS incorporation_date,
           CASE WHEN c.c_mktsegment <> 'HOUSEHOLD'
                THEN ['4' || LPAD(CAST(c.c_nationkey AS VARCHAR), 2, '0'), {MKT_SIC_SQL}] ELSE {EMPTY} END AS sic_codes,
           CASE WHEN c.c_mktsegment <> 'AUTOMOBILE'
                THEN [c.c_name || ' director', 'Secretary ' || c.c_mktsegment] ELSE {EMPTY} END AS officer_names,
           COALESCE(o.cnt, 0) AS filing_count
    FROM customer c LEFT JOIN (SELECT o_custkey, COUNT(*) AS cnt FROM orders GROUP BY o_custkey) o
      ON c.c_custkey = o.o_custkey""")

register("charges_flatten", """
    SELECT CAST(o.o_custkey AS VARCHAR) AS company_number, strftime(l.l_shipdate, '%Y-%m-%d') AS created_on,
           CASE WHEN l.l_linestatus = 'O' THEN 'outstanding' ELSE 'fully-satisfied' END AS status,
           CASE WHEN l.l_returnflag <> 'N' THEN 'flag ' || l.l_returnflag END AS classification,
           [CASE WHEN l.l_linenumber <> 1 THEN 'Supplier#' || CAST(l.l_suppkey AS VARCHAR) ELSE '' END]
               AS persons_entitled,
           CASE WHEN l.l_quantity > 25 THEN 'qty ' || CAST(CAST(TRUNC(l.l_quantity) AS INTEGER) AS VARCHAR) END
               AS description
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")

register("ownership_flags", f"""
    SELECT CAST(c_custkey AS VARCHAR) AS company_number,
           CASE WHEN c_acctbal > 5000 THEN [c_mktsegment || ' Holdings'] ELSE {EMPTY} END AS corporate_controllers,
           c_acctbal > 5000 AS part_of_group
    FROM customer WHERE c_custkey % 50 <> 0""")

register("unreadable_documents", """
    SELECT CAST(c_custkey AS VARCHAR) AS company_number,
           substr('{"items":[{"name":"' || CASE WHEN c_acctbal > 5000 THEN c_mktsegment || ' Holdings'
                                                ELSE 'Person ' || CAST(c_custkey AS VARCHAR) END
                  || '","kind":"', 1, 20) AS payload
    FROM customer WHERE c_custkey % 50 = 0""")

# The award date's four forms by event, as text and as the UTC time it stands for.
AWARD_FORM_SQL = """
    CASE event_id % 4 WHEN 1 THEN strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END
        || CASE event_id % 4 WHEN 2 THEN 'Z' WHEN 3 THEN '+01:00' ELSE '' END"""
AWARD_AT_SQL = """
    CASE event_id % 4 WHEN 1 THEN date_trunc('day', ts) WHEN 3 THEN date_trunc('second', ts) - INTERVAL 1 HOUR
                      ELSE date_trunc('second', ts) END"""

register("award_summary", f"""
    WITH n AS (SELECT CAST(user_id AS VARCHAR) AS company_number,
                      CASE WHEN event_type IN ('purchase', 'signup') THEN {AWARD_FORM_SQL} END AS awarded,
                      CASE WHEN event_type <> 'signup' THEN 'Authority ' || json_extract_string(props, '$.k') END AS org
               FROM events),
         a AS (SELECT company_number, COUNT(*) AS award_count, MAX(awarded) AS most_recent,
                      list_sort(list_distinct(list(COALESCE(org, '')))) AS auth
               FROM n WHERE awarded IS NOT NULL AND awarded <> '' GROUP BY company_number)
    SELECT CAST(c.c_custkey AS VARCHAR) AS company_number, c.c_name AS company_name,
           COALESCE(a.award_count, 0) AS award_count, a.most_recent AS most_recent_award_date,
           COALESCE(a.auth, {EMPTY}) AS buying_authorities
    FROM customer c LEFT JOIN a ON CAST(c.c_custkey AS VARCHAR) = a.company_number""")

register("award_authorities", f"""
    WITH n AS (SELECT CAST(user_id AS VARCHAR) AS company_number,
                      CASE WHEN event_type IN ('purchase', 'signup') THEN {AWARD_FORM_SQL} END AS awarded,
                      CASE WHEN event_type <> 'signup' THEN 'Authority ' || json_extract_string(props, '$.k')
                           ELSE '' END AS authority
               FROM events)
    SELECT company_number, ROW_NUMBER() OVER (PARTITION BY company_number ORDER BY authority) - 1 AS place, authority,
           COUNT(*) AS award_count, MAX(awarded) AS most_recent_award_date
    FROM n WHERE awarded IS NOT NULL AND awarded <> '' GROUP BY company_number, authority""")

SOURCES_SQL = ", ".join(f"'{s}'" for s in V.LANDING_SOURCES)
PULLS_SQL = (f"SELECT event_type AS source, CAST(user_id AS VARCHAR) AS record_key, ts AS pulled_at, "
             f"props AS payload FROM events WHERE event_type IN ({SOURCES_SQL})")

register("latest_pull", f"""
    SELECT source, record_key, pulled_at, payload FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY source, record_key ORDER BY pulled_at DESC, payload DESC) AS rn
        FROM ({PULLS_SQL})) WHERE rn = 1""")

register("packed_pulls", f"SELECT *, sha256(payload) AS sha256 FROM ({PULLS_SQL})")

register("packed_latest", f"""
    SELECT source, record_key, pulled_at, CAST(strlen(payload) AS BIGINT) AS n_bytes, payload FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY source, record_key ORDER BY pulled_at DESC, payload DESC) AS rn
        FROM ({PULLS_SQL})) WHERE rn = 1""")

register("pull_changes", f"""
    SELECT source, record_key, pulled_at, h AS payload_hash, prev IS NULL AS first_pull,
           COALESCE(prev <> h, FALSE) AS changed
    FROM (SELECT source, record_key, pulled_at, md5(payload) AS h,
                 LAG(md5(payload)) OVER (PARTITION BY source, record_key ORDER BY pulled_at, md5(payload)) AS prev
          FROM ({PULLS_SQL}))""")

register("landing_gaps", f"""
    WITH ex AS (SELECT s.source, CAST(c.c_custkey AS VARCHAR) AS record_key
                FROM customer c, (VALUES {", ".join(f"('{s}')" for s in V.LANDING_SOURCES)}) AS s(source)
                UNION ALL SELECT 'registry', c_name FROM customer WHERE c_custkey % 10 = 0
                UNION ALL SELECT 'registry', c_name || ' Ltd' FROM customer WHERE c_custkey % 10 = 0),
         got AS (SELECT DISTINCT source, record_key FROM ({PULLS_SQL})
                 WHERE NOT (CAST(record_key AS BIGINT) % 5 = 0 AND source IN ('click', 'view'))),
         gaps AS (SELECT * FROM ex WHERE NOT EXISTS (
                    SELECT 1 FROM got WHERE got.source = ex.source AND got.record_key = ex.record_key)),
         f AS (SELECT ([{SOURCES_SQL}])[CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 + 1] AS source,
                      CAST(user_id AS VARCHAR) AS record_key, date_trunc('second', ts) AS failed_at,
                      'HTTP ' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 + 500 AS VARCHAR)
                          || ' Server Error' AS reason
               FROM events WHERE event_type = 'error' AND event_id % 97 <> 0
               UNION ALL SELECT 'registry', c_name || ' Ltd', TIMESTAMP '2024-01-01', 'HTTP 500 Server Error'
               FROM customer WHERE c_custkey % 10 = 0),
         lf AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY source, record_key
                                                           ORDER BY failed_at DESC, reason DESC) AS rn FROM f)
                WHERE rn = 1)
    SELECT g.source, g.record_key, lf.failed_at AS last_failed_at, lf.reason
    FROM gaps g LEFT JOIN lf ON g.source = lf.source AND g.record_key = lf.record_key""")

register("failure_log_quarantine", f"""
    SELECT 'broken ' || strftime(ts, '%Y%m%dT%H%M%SZ') || ' '
           || ([{SOURCES_SQL}])[CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 + 1] || ' '
           || CAST(user_id AS VARCHAR) || ' HTTP '
           || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 + 500 AS VARCHAR) || ' Server Error' AS line
    FROM events WHERE event_type = 'error' AND event_id % 97 = 0""")

CANDIDATES_SQL = f"""
    SELECT LPAD(CAST(c_custkey AS VARCHAR), 8, '0') AS company_number, c_name AS company_name,
           'PC' || CAST(c_nationkey AS VARCHAR) AS postcode,
           '4' || LPAD(CAST(c_nationkey AS VARCHAR), 2, '0') AS sic_code, CAST(NULL AS VARCHAR) AS website_url
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    WHERE c_acctbal >= 0
      AND ('4' || LPAD(CAST(c_nationkey AS VARCHAR), 2, '0') IN ({", ".join(f"'{c}'" for c in V.SEARCH_SIC_CODES)})
           OR {MKT_SIC_SQL} IN ({", ".join(f"'{c}'" for c in V.SEARCH_SIC_CODES)}))
      AND contains(lower(n_name), '{V.SEARCH_LOCATION}')"""

register("candidate_select", CANDIDATES_SQL)
register("register_search_capped", CANDIDATES_SQL.replace(
    f"AND contains(lower(n_name), '{V.SEARCH_LOCATION}')", "ORDER BY company_number LIMIT 500"))
register("selection_criteria", f"""
    SELECT 'companies_house_advanced_search' AS route, '{",".join(V.SEARCH_SIC_CODES)}' AS sic_codes,
           '{V.SEARCH_LOCATION}' AS location, COUNT(*) AS candidate_count FROM ({CANDIDATES_SQL})""")

PAGE_TEXT_SQL = "lower(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))"
register("page_text", f"SELECT page_id, {PAGE_TEXT_SQL} AS page_text FROM pages")


def _snippet(term: str) -> str:
    pos = f"instr(t, '{term}')"
    start = f"GREATEST({pos} - 120, 1)"
    return f"CASE WHEN {pos} > 0 THEN substring(t, {start}, {pos} + {len(term)} + 120 - {start}) END"


def _accreditation_wide_sql() -> str:
    cols = []
    for name, variants in V.WEB_TERMS.items():
        cite = "COALESCE(" + ", ".join(_snippet(v) for v in variants) + ")"
        cols.append(f"CASE WHEN {cite} IS NOT NULL THEN 'claimed on site' ELSE 'not found on site' END AS {name}_status")
        cols.append(f"{cite} AS {name}_citation")
    return f"""
        SELECT company_number, company_name, website_url, {", ".join(cols)}
        FROM (SELECT CAST(page_id AS VARCHAR) AS company_number,
                     regexp_extract(url, '^https?://([^/]+)', 1) AS company_name, url AS website_url,
                     {PAGE_TEXT_SQL} AS t
              FROM pages)"""


register("accreditation_wide", _accreditation_wide_sql())
register("accreditation_long", " UNION ALL ".join(
    f"""SELECT company_number, '{n}' AS accreditation, {n}_status AS status, {n}_citation AS citation,
               CASE WHEN {n}_status = 'not found on site'
                    THEN '{n.replace("_", " ")}: not found on the site, which is not proof it is not held'
                    ELSE '{n.replace("_", " ")}: ' || {n}_status END AS statement
        FROM ({_accreditation_wide_sql()})""" for n in V.WEB_TERMS))


# ---------------------------------------------------------------- names and resolution

NAME_RECORDS_SQL = ("SELECT doc_id, regexp_extract(text, '^[^.!?\\n]*', 0) AS company_name, "
                    "source AS postcode, lang AS sic_code FROM documents")
SUFFIXES_SQL = ", ".join("'" + w + "'" for w in ["limited", "ltd", "llp", "plc", "public limited company"])
NORM_SQL = f"""
    SELECT doc_id, company_name,
           array_to_string(list_filter(string_split(regexp_replace(lower(company_name), '[^\\p{{L}}\\p{{N}} ]', '', 'g'), ' '),
                                       lambda w: w <> '' AND w NOT IN ({SUFFIXES_SQL})), ' ') AS normalised
    FROM ({NAME_RECORDS_SQL})"""
SHINGLES_SQL = f"""
    SELECT doc_id, CASE WHEN length(s) < 3 THEN [s]
                        ELSE list_distinct(list_transform(range(1, length(s) - 1), lambda i: substring(s, i, 3))) END AS sh
    FROM (SELECT doc_id, replace(normalised, ' ', '_') AS s FROM ({NORM_SQL}))"""
SHINGLE_ROWS_SQL = f"SELECT DISTINCT doc_id, unnest(sh) AS shingle FROM ({SHINGLES_SQL})"
MINHASH_SQL = f"""
    SELECT x.doc_id, k.slot, MIN(md5(CAST(k.slot AS VARCHAR) || ':' || x.shingle)) AS min_hash
    FROM ({SHINGLE_ROWS_SQL}) x, (SELECT range AS slot FROM range(64)) k
    GROUP BY x.doc_id, k.slot"""

register("name_normalise", NORM_SQL)
register("name_shingles", SHINGLE_ROWS_SQL)
register("minhash_signature", f"SELECT doc_id, CAST(slot AS INTEGER) AS slot, min_hash FROM ({MINHASH_SQL})")
register("minhash_candidates", f"""
    WITH m AS ({MINHASH_SQL})
    SELECT a.doc_id AS id_one, b.doc_id AS id_two, CAST(COUNT(*) AS DOUBLE) / 64.0 AS similarity
    FROM m a JOIN m b ON a.slot = b.slot AND a.min_hash = b.min_hash AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id HAVING COUNT(*) >= 32""")


# ---------------------------------------------------------------- text, credit, similar companies

TOKENS_SQL = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')"

register("tfidf_terms", f"""
    WITH t AS (SELECT doc_id, unnest({TOKENS_SQL}) AS term FROM documents),
         tf AS (SELECT doc_id, term, COUNT(*) AS tf FROM t GROUP BY doc_id, term),
         df AS (SELECT term, COUNT(*) AS df FROM tf GROUP BY term),
         n AS (SELECT COUNT(*) AS n FROM documents),
         w AS (SELECT tf.doc_id, tf.term, tf.tf * (ln((1.0 + CAST(n.n AS DOUBLE)) / (1.0 + df.df)) + 1.0) AS raw
               FROM tf JOIN df ON tf.term = df.term, n),
         r AS (SELECT doc_id, term, raw, raw / SQRT(SUM(raw * raw) OVER (PARTITION BY doc_id)) AS weight,
                      ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY raw DESC, term) AS rank FROM w)
    SELECT doc_id, term, CAST(rank AS INTEGER) AS rank, ROUND(weight, 6) AS weight FROM r WHERE rank <= 5""")

register("keyword_onehot", "SELECT doc_id, " + ", ".join(
    f"CAST(list_contains({TOKENS_SQL}, '{kw}') AS INTEGER) AS kw_{kw}" for kw in V.KEYWORDS) + " FROM documents")

NEG_SQL = ", ".join(f"'{w}'" for w in V.FLAG_WORDS)
TEXT_FEATURES_SQL = f"""
    SELECT doc_id, CAST(len({TOKENS_SQL}) AS INTEGER) AS n_tokens,
           CAST(len(list_distinct({TOKENS_SQL})) AS INTEGER) AS n_distinct_tokens,
           CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_lines,
           CAST(len(list_intersect({TOKENS_SQL}, [{NEG_SQL}])) > 0 AS INTEGER) AS report_negative_language_flag,
           CAST(instr(lower(text), 'licen') > 0 AS INTEGER) AS going_concern_flag
    FROM documents"""
register("text_features", TEXT_FEATURES_SQL)

register("credit_split", """
    SELECT l.doc_id, substr(md5(CAST(l.doc_id AS VARCHAR)), 1, 2) < '40' AS is_test
    FROM labels l JOIN documents d ON l.doc_id = d.doc_id""")

register("auc_exact", """
    WITH s AS (SELECT l.quality AS label, CAST(d.n_chars AS DOUBLE) / CAST(d.n_chars + 1000 AS DOUBLE) AS score
               FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
         r AS (SELECT label, CAST(RANK() OVER (ORDER BY score) AS DOUBLE)
                            + CAST(COUNT(*) OVER (PARTITION BY score) - 1 AS DOUBLE) / 2.0 AS mr FROM s),
         a AS (SELECT SUM(CASE WHEN label = 1 THEN mr ELSE 0 END) AS rs,
                      SUM(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS p, SUM(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS q
               FROM r)
    SELECT (rs - CAST(p AS DOUBLE) * (CAST(p AS DOUBLE) + 1.0) / 2.0) / (CAST(p AS DOUBLE) * CAST(q AS DOUBLE)) AS auc,
           p AS positives, q AS negatives FROM a""")


NEWTON_STEPS = 40      # the fit itself stops when it no longer moves


def _newton_sql(name: str, features: int, steps: int) -> str:
    """Recursive CTE ``name``(step, w0, w1, ...): Newton steps over ``train`` (x1, x2, ..., y), each system solved by
    elimination, row by row, in nested selects."""
    n = range(features + 1)
    xs = ["1.0", *[f"x{j}" for j in n[1:]]]
    z = " + ".join(["w0", *[f"w{j} * x{j}" for j in n[1:]]])
    carried = ", ".join(f"w{j}" for j in n)
    sums = [f"sum({xs[i]} * (y - p)) - {'0.0' if i == 0 else f'w{i}'} AS r{i}" for i in n]
    sums += [f"sum({xs[i]} * {xs[j]} * p * (1.0 - p)) + {'1.0' if i == j > 0 else '0.0'} AS a{i}{j}" for i in n for j in n]
    rows = f"SELECT *, 1.0 / (1.0 + exp(-least(greatest({z}, -30.0), 30.0))) AS p FROM train, {name} WHERE step < {steps}"
    q = f"SELECT step, {carried}, {', '.join(sums)} FROM ({rows}) GROUP BY step, {carried}"
    for k in n[:-1]:
        done = [f"r{i} - a{i}{k} / a{k}{k} * r{k} AS r{i}" if i > k else f"r{i}" for i in n]
        done += [f"a{i}{j} - a{i}{k} / a{k}{k} * a{k}{j} AS a{i}{j}" if i > k and j >= k else f"a{i}{j}" for i in n for j in n]
        q = f"SELECT step, {carried}, {', '.join(done)} FROM ({q})"
    for k in reversed(n):
        known = "".join(f" - a{k}{j} * d{j}" for j in n[k + 1:])
        q = f"SELECT *, (r{k}{known}) / a{k}{k} AS d{k} FROM ({q})"
    q = f"SELECT *, {' + '.join(f'abs(d{j}) * m{j}' for j in n)} AS s FROM ({q}), (SELECT * FROM largest)"
    moved = ", ".join(f"w{j} + d{j} * (CASE WHEN s < 1e-12 THEN 1.0 ELSE ln(1.0 + s) / s END)" for j in n)
    return f"""{name}(step, {carried}) AS (
        SELECT 0, {', '.join('0.0::DOUBLE' for _ in n)} UNION ALL SELECT step + 1, {moved} FROM ({q}))"""


def _lift_auc_sql(name: str, features: int, steps: int) -> str:
    z = " + ".join(["round(w0, 9)", *[f"round(w{j}, 9) * x{j}" for j in range(1, features + 1)]])
    return f"""
        SELECT (rs - p * (p + 1.0) / 2.0) / (p * q) FROM (
            SELECT sum(CASE WHEN y = 1 THEN mr ELSE 0 END)::DOUBLE AS rs, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END)::DOUBLE AS p,
                   sum(CASE WHEN y = 1 THEN 0 ELSE 1 END)::DOUBLE AS q
            FROM (SELECT y, rank() OVER (ORDER BY z) + (count(*) OVER (PARTITION BY z) - 1) / 2.0 AS mr
                  FROM (SELECT y, {z} AS z FROM used, {name} WHERE is_test AND step = {steps})))"""


register("text_lift", f"""
    WITH RECURSIVE f AS ({TEXT_FEATURES_SQL}),
    seen AS MATERIALIZED (
        SELECT (1 - quality)::DOUBLE AS y, n_chars / 1000.0::DOUBLE AS x1, n_tokens::DOUBLE / nullif(n_chars, 0)::DOUBLE AS x2,
               n_lines / 10.0::DOUBLE AS x3, report_negative_language_flag::DOUBLE AS x4, going_concern_flag::DOUBLE AS x5,
               substr(md5(CAST(l.doc_id AS VARCHAR)), 1, 2) < '40' AS is_test
        FROM labels l JOIN documents d ON l.doc_id = d.doc_id JOIN f ON f.doc_id = d.doc_id),
    used AS MATERIALIZED (SELECT * FROM seen WHERE isfinite(y + x1 + x2 + x3 + x4 + x5)),
    train AS MATERIALIZED (SELECT * FROM used WHERE NOT is_test),
    largest AS (SELECT 1.0 AS m0, max(abs(x1)) AS m1, max(abs(x2)) AS m2, max(abs(x3)) AS m3, max(abs(x4)) AS m4,
                       max(abs(x5)) AS m5 FROM train),
    {_newton_sql('ratio', 3, NEWTON_STEPS)},
    {_newton_sql('every', 5, NEWTON_STEPS)}
    SELECT r AS ratio_only_auc, t AS with_text_auc, t - r AS text_feature_lift, (SELECT count(*) FROM used) AS rows_used,
           (SELECT count(*) FROM seen) - (SELECT count(*) FROM used) AS rows_left_out
    FROM (SELECT ({_lift_auc_sql('ratio', 3, NEWTON_STEPS)}) AS r, ({_lift_auc_sql('every', 5, NEWTON_STEPS)}) AS t)""")

ITEMS_SQL = ("SELECT p_partkey, CASE WHEN p_partkey % 13 <> 0 THEN CAST(p_size AS DOUBLE) END AS size, "
             "p_retailprice / 100 AS price, p_brand, p_type FROM part")


EVERY_QUERY = f"SELECT * FROM i WHERE size IS NOT NULL AND p_partkey % {V.QUERY_STEP} = 0"


def _nearest_sql(pool: str) -> str:
    return f"""
        WITH i AS ({ITEMS_SQL}),
             refs AS ({EVERY_QUERY}),
             d AS (SELECT r.p_partkey AS reference_id, x.p_partkey AS item_id,
                          SQRT(0.0 + (x.size - r.size) * (x.size - r.size) + (x.price - r.price) * (x.price - r.price)
                               + CASE WHEN x.p_brand = r.p_brand THEN 0.0 ELSE 2.0 END
                               + CASE WHEN x.p_type = r.p_type THEN 0.0 ELSE 2.0 END) AS distance
                   FROM ({pool}) x, refs r WHERE x.p_partkey <> r.p_partkey AND x.size IS NOT NULL)
        SELECT reference_id, item_id, distance, rank FROM (
            SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY reference_id ORDER BY distance, item_id) AS INTEGER) AS rank
            FROM d) WHERE rank <= {V.NEAREST_K}"""


for twin in ("nearest_companies", "nearest_companies_all"):
    register(twin, _nearest_sql("SELECT * FROM i"))
for twin in ("portfolio_similar", "portfolio_similar_all"):
    register(twin, f"""
        SELECT n.*, i2.size <= 30 AS suitable
        FROM ({_nearest_sql("SELECT * FROM i WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')")}) n
        JOIN ({ITEMS_SQL}) i2 ON n.item_id = i2.p_partkey""")


# ---------------------------------------------------------------- briefs, dossier

NL = "chr(10)"
SCREENED_SQL = """
    SELECT CAST(c_custkey AS VARCHAR) AS company_number, c_name AS company_name,
           '0.' || LPAD(CAST((c_custkey * 37) % 1000 AS VARCHAR), 3, '0') AS probability,
           '0.' || LPAD(CAST((c_custkey * 17) % 500 AS VARCHAR), 3, '0') AS interval_lower,
           '0.' || LPAD(CAST((c_custkey * 17) % 500 + 499 AS VARCHAR), 3, '0') AS interval_upper,
           CASE WHEN c_acctbal < 0 THEN 'abstained' ELSE 'scored' END AS abstention_status,
           c_mktsegment AS top_drivers,
           CASE WHEN c_mktsegment = 'BUILDING' THEN n_name || ', ' || n_name ELSE n_name END AS comparable_companies,
           CASE WHEN c_nationkey % 2 = 0 THEN 'reduce gearing' ELSE 'extend credit terms' END AS counterfactual_levers
    FROM customer JOIN nation ON c_nationkey = n_nationkey"""
BRIEF_TEXT_SQL = (
    "CASE WHEN abstention_status = 'abstained' "
    "THEN 'ABSTAINED. The screen declined to score this company. "
    "Do not treat the figures below as a recommendation.' "
    "ELSE 'Scored. The screen returned a usable result for this company.' END"
    f" || {NL} || {NL} || 'Company: ' || company_name || ' (' || company_number || ')' || {NL} || {NL}"
    f" || 'Calibrated probability: ' || probability || ' (interval ' || interval_lower || ' to ' || interval_upper"
    f" || ')' || {NL} || {NL} || 'Top drivers:' || {NL} || top_drivers || {NL} || {NL}"
    f" || 'Nearest comparable companies:' || {NL} || comparable_companies || {NL} || {NL}"
    f" || 'Counterfactual levers, marked causal or associational:' || {NL} || counterfactual_levers || {NL} || {NL}"
    " || 'An associational lever describes what moves with the outcome, not what causes it. "
    f"Do not act on one without separate evidence.' || {NL}")

register("brief_render", f"""
    SELECT company_number, {BRIEF_TEXT_SQL} AS brief_text
    FROM ({SCREENED_SQL}) WHERE top_drivers <> 'BUILDING'""")

register("csv_quarantine", f"""
    SELECT concat_ws(',', company_number, company_name, probability, interval_lower, interval_upper,
                     abstention_status, top_drivers, comparable_companies, counterfactual_levers) AS line,
           10 AS field_count, 9 AS expected_count
    FROM ({SCREENED_SQL}) WHERE top_drivers = 'BUILDING'""")

register("dispatch_queue", f"""
    SELECT lower(r.r_name) || '@example.org' AS recipient, s.company_number AS brief, 'queued' AS outcome
    FROM ({SCREENED_SQL}) s, region r
    WHERE s.top_drivers <> 'BUILDING' AND s.abstention_status <> 'abstained'
    UNION ALL
    SELECT 'none', company_number, 'skipped_abstained'
    FROM ({SCREENED_SQL}) WHERE top_drivers <> 'BUILDING' AND abstention_status = 'abstained'""")

REVIEW_SQL = """
    SELECT company_number, predicted_code, confidence, filed_sic_code,
           confidence < 0.6 OR predicted_code IS DISTINCT FROM filed_sic_code AS needs_review,
           predicted_code IS DISTINCT FROM filed_sic_code AS disagrees_with_filed
    FROM (SELECT CAST(o_orderkey AS VARCHAR) AS company_number, o_orderstatus AS predicted_code,
                 (o_orderkey % 100) / 100.0 AS confidence,
                 CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN 'X' ELSE o_orderstatus END
                     AS filed_sic_code
          FROM orders)"""
register("review_given", REVIEW_SQL)

CLAIM_COLUMNS = [f"{n}_status" for n in V.WEB_TERMS]
# Module -> (all rows, columns carried by the page, types of the columns).
MODULE_SQL = {
    "filings": (ORACLE["filing_records"], ["filing_count"], ["BIGINT"]),
    "tenders": (f"SELECT * FROM ({ORACLE['award_summary']}) WHERE award_count > 0", ["award_count"], ["BIGINT"]),
    "charges": (f"SELECT company_number, COUNT(*) AS charge_count FROM ({ORACLE['charges_flatten']}) "
                "GROUP BY company_number", ["charge_count"], ["BIGINT"]),
    "ownership": (ORACLE["ownership_flags"], ["part_of_group"], ["BOOLEAN"]),
    "accreditation": (_accreditation_wide_sql(), CLAIM_COLUMNS, ["VARCHAR"] * len(CLAIM_COLUMNS)),
    "distress": (ORACLE["distress_scores"], ["distress_score", "score_form"], ["DOUBLE", "VARCHAR"]),
    "industry": (f"SELECT company_number, predicted_code AS industry_predicted_code, confidence AS industry_confidence, "
                 f"needs_review AS industry_needs_review FROM ({REVIEW_SQL})",
                 ["industry_predicted_code", "industry_confidence", "industry_needs_review"],
                 ["VARCHAR", "DOUBLE", "BOOLEAN"]),
    "valuation": (f"SELECT company_number, {', '.join(VQ_NAMES)}, peer_count AS valuation_peer_count, "
                  f"code_length_used AS valuation_code_length FROM (SELECT *, row_number() OVER (PARTITION BY "
                  f"company_number ORDER BY code_length_used, {', '.join(VQ_NAMES)}, peer_count) AS r "
                  f"FROM ({ORACLE['valuation_quantiles']})) WHERE r = 1",
                  [*VQ_NAMES, "valuation_peer_count", "valuation_code_length"], ["DOUBLE"] * 5 + ["BIGINT", "INTEGER"]),
    "revenue": (ORACLE["revenue_cross_check"],
                ["headcount_revenue_estimate", "multiples_revenue_estimate", "disagreement_ratio", "revenue_usable"],
                ["DOUBLE", "DOUBLE", "DOUBLE", "BOOLEAN"]),
}
COMPANIES_SQL = "SELECT CAST(c_custkey AS VARCHAR) AS company_number, c_name AS company_name FROM customer"


def _dossier_sql(not_run: tuple[str, ...] = ()) -> str:
    columns, joins = [], []
    for i, (name, (sql, carried, types)) in enumerate(MODULE_SQL.items()):
        if name in not_run:
            columns.append(f"'not run' AS {name}_state")
            columns += [f"CAST(NULL AS {t}) AS {c}" for c, t in zip(carried, types)]
            continue
        columns.append(f"CASE WHEN m{i}.company_number IS NULL THEN 'no record' ELSE 'present' END AS {name}_state")
        columns += [f"m{i}.{c}" for c in carried]
        joins.append(f"LEFT JOIN ({sql}) m{i} ON c.company_number = m{i}.company_number")
    return f"SELECT c.company_number, c.company_name, {', '.join(columns)} FROM ({COMPANIES_SQL}) c {' '.join(joins)}"


register("company_dossier", _dossier_sql())
register("dossier_stored", _dossier_sql())
register("dossier_before_modelling", _dossier_sql(("distress", "industry", "valuation", "revenue")))

# Module -> (all records or None, columns shown, their types).
PAGE_SQL = {
    "charges": (ORACLE["charges_flatten"], ["created_on", "status", "description"], ["VARCHAR"] * 3),
    "tenders": (f"""SELECT CAST(user_id AS VARCHAR) AS company_number, {AWARD_FORM_SQL} AS awardedDate,
                           CASE WHEN event_type <> 'signup' THEN 'Authority ' || json_extract_string(props, '$.k') END
                               AS organisationName
                    FROM events WHERE event_type IN ('purchase', 'signup')""",
                ["awardedDate", "organisationName"], ["VARCHAR"] * 2),
    "filings": (ORACLE["filing_records"], ["registered_postcode", "filing_count"], ["VARCHAR", "BIGINT"]),
    "ownership": (ORACLE["ownership_flags"], ["part_of_group"], ["BOOLEAN"]),
    "comparables": (None, ["multiple"], ["DOUBLE"]),
}


def _page_sql() -> str:
    parts = []
    for name, (sql, _, _) in PAGE_SQL.items():
        state = ("'not run'" if sql is None else
                 "CASE WHEN m.company_number IS NULL THEN 'no record' ELSE 'present' END")
        columns = ", ".join(f"{f'm.{c}' if own == name and sql else f'CAST(NULL AS {t})'} AS {own}__{c}"
                            for own, (_, carried, types) in PAGE_SQL.items() for c, t in zip(carried, types))
        join = f"LEFT JOIN ({sql}) m ON m.company_number = c.company_number" if sql else ""
        parts.append(f"SELECT c.company_number, c.company_name, '{name}' AS module, {state} AS state, {columns} "
                     f"FROM ({COMPANIES_SQL}) c {join}")
    return " UNION ALL ".join(parts)


register("company_page", _page_sql())

register("signal_coverage", " UNION ALL ".join(
    [f"""SELECT '{name}' AS module, (SELECT COUNT(*) FROM ({sql})) AS row_count,
                (SELECT COUNT(DISTINCT company_number) FROM ({sql})
                 WHERE company_number IN (SELECT company_number FROM ({COMPANIES_SQL}))) AS companies_covered,
                1.0 - CAST((SELECT COUNT(DISTINCT company_number) FROM ({sql})
                            WHERE company_number IN (SELECT company_number FROM ({COMPANIES_SQL}))) AS DOUBLE)
                      / (SELECT COUNT(*) FROM customer) AS share_missing"""
     for name, (sql, _, _) in MODULE_SQL.items()]
    + ["SELECT 'comparables', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), 1.0"]))

register("company_rows", f"""
    SELECT 'number' AS matched_on, concat_ws('|', created_on, status, description) AS row
    FROM ({ORACLE['charges_flatten']}) WHERE company_number = '7'
    UNION ALL SELECT 'name', company_name FROM ({COMPANIES_SQL}) WHERE company_name = 'Customer#000000007'""")


register("extractor_check", f"""
    WITH s AS (SELECT CAST(page_id AS VARCHAR) AS company_number, html, {PAGE_TEXT_SQL} AS t FROM pages
               ORDER BY md5(CAST(page_id AS VARCHAR)), CAST(page_id AS VARCHAR) LIMIT 100),
         c AS (SELECT instr(t, 'the and') > 0 AS claimed, instr(lower(html), 'and.<') > 0 AS holds FROM s)
    SELECT 'claim' AS accreditation, COUNT(*) AS checked,
           CAST(SUM(CASE WHEN claimed AND holds THEN 1 ELSE 0 END) AS DOUBLE)
               / NULLIF(SUM(CASE WHEN claimed THEN 1 ELSE 0 END), 0) AS precision,
           CAST(SUM(CASE WHEN claimed AND holds THEN 1 ELSE 0 END) AS DOUBLE)
               / NULLIF(SUM(CASE WHEN holds THEN 1 ELSE 0 END), 0) AS recall
    FROM c""")

register("awards_as_of", f"""
    WITH a AS (SELECT CAST(user_id AS VARCHAR) AS company_number, {AWARD_AT_SQL} AS award_at
               FROM events WHERE event_type IN ('purchase', 'signup')),
         d AS (SELECT DISTINCT company_number, decision_date FROM {DECISIONS_SQL}),
         k AS (SELECT d.company_number, d.decision_date, COUNT(*) AS award_count, MAX(a.award_at) AS latest_award_at
               FROM a JOIN d ON a.company_number = d.company_number AND a.award_at <= d.decision_date
               GROUP BY d.company_number, d.decision_date)
    SELECT x.company_number, x.decision_date, COALESCE(k.award_count, 0) AS award_count, k.latest_award_at
    FROM {DECISIONS_SQL} AS x LEFT JOIN k
      ON x.company_number = k.company_number AND x.decision_date = k.decision_date""")

register("asof_latest_fact_scan", as_of_sql("filings"))


# ---------------------------------------------------------------- resolution on given inputs

register("reference_search", f"""
    WITH m AS ({MINHASH_SQL}),
         p AS (SELECT a.doc_id AS candidate_id, b.doc_id AS other, CAST(COUNT(*) AS DOUBLE) / 64.0 AS similarity
               FROM m a JOIN m b ON a.slot = b.slot AND a.min_hash = b.min_hash
               GROUP BY a.doc_id, b.doc_id HAVING COUNT(*) >= 32),
         r AS (SELECT *, 'DOC' || LPAD(CAST(other AS VARCHAR), 7, '0') AS company_number FROM p)
    SELECT candidate_id, company_number, similarity, CAST(rank AS INTEGER) AS rank FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY candidate_id ORDER BY similarity DESC, company_number) AS rank FROM r)
    WHERE rank <= 20""")

register("pair_scores", """
    WITH p AS (SELECT o_orderkey, (o_orderkey % 101) / 100.0 AS ratio, o_orderstatus, c_mktsegment,
                      'PC' || CAST(c_nationkey AS VARCHAR) AS pc
               FROM orders JOIN customer ON o_custkey = c_custkey),
         f AS (SELECT o_orderkey, ratio,
                      CASE o_orderkey % 7 WHEN 0 THEN ' ' WHEN 1 THEN NULL ELSE pc END AS a,
                      CASE o_orderkey % 5 WHEN 0 THEN 'PC1' WHEN 1 THEN NULL ELSE pc END AS b,
                      CASE WHEN o_orderkey % 3 <> 0 THEN c_mktsegment END AS c,
                      CASE WHEN o_orderstatus = 'O' THEN c_mktsegment ELSE 'BUILDING' END AS d FROM p),
         h AS (SELECT *, trim(coalesce(a, '')) <> '' AND trim(coalesce(b, '')) <> '' AS pcs,
                      trim(coalesce(c, '')) <> '' AND trim(coalesce(d, '')) <> '' AS sics FROM f)
    SELECT o_orderkey,
           ROUND((0.6 * ratio + CASE WHEN pcs AND a = b THEN 0.2 ELSE 0.0 END + CASE WHEN sics AND c = d THEN 0.2 ELSE 0.0 END)
                 / (0.6 + CASE WHEN pcs THEN 0.2 ELSE 0.0 END + CASE WHEN sics THEN 0.2 ELSE 0.0 END), 6) AS score
    FROM h""")

register("best_references", """
    SELECT candidate, reference, score FROM (
        SELECT l_orderkey AS candidate, l_suppkey AS reference, l_discount * 10 AS score,
               ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_discount * 10 DESC, l_linenumber, l_suppkey) AS r
        FROM lineitem WHERE l_discount * 10 > 0) WHERE r = 1""")

register("resolution_counts", """
    SELECT 'candidates' AS part, COUNT(*) AS n FROM documents
    UNION ALL SELECT 'resolved or unmatched', COUNT(*) FROM documents
    UNION ALL SELECT 'audit', COUNT(*) FROM documents WHERE source NOT IN ('src0', 'src1')
    UNION ALL SELECT 'passed through', COUNT(*) FROM documents WHERE source IN ('src0', 'src1')""")

register("vocabulary", f"""
    SELECT ROW_NUMBER() OVER (ORDER BY n DESC, term) - 1 AS place, term FROM (
        SELECT term, COUNT(*) AS n FROM (SELECT unnest({TOKENS_SQL}) AS term FROM documents) GROUP BY term
        ORDER BY n DESC, term LIMIT 5000)""")
