"""The same queries as plain SQL for DuckDB, written independently of the Spark code."""

from __future__ import annotations

from . import fixtures as fx

ORACLE: dict[str, str] = {}

AS_OF = f"DATE '{fx.AS_OF.isoformat()}'"

# Columns that DuckDB would give as 32-bit whole numbers.
WHOLE = {
    "scan_panel_parquet": "iid f_score",
    "scan_panel_csv": "iid f_score",
    "scan_by_keys": "iid",
    "sink_labeled_parquet": "year",
    "make_ticker": "iid",
    "parse_yyyymmdd": "iid",
    "parse_yyyymmdd_coerce": "iid",
    "resolve_price": "iid",
    "volume_proxy": "iid",
    "project_essential": "iid year month f_score",
    "normalize_panel": "iid year month f_score",
    "scan_by_key_list": "iid",
    "ensure_columns": "detection_score",
    "label_event_windows": "iid",
    "label_from_verdicts": "iid",
    "label_acquisitions": "iid year",
    "label_from_acquisitions": "iid year",
    "date_gaps": "iid",
    "pct_change": "iid",
    "prev_row_value": "iid",
    "tail_n": "iid",
    "last_and_nth_last": "f_score_last",
    "sort_panel": "iid",
    "rank_best_event": "priority",
}

# Named subqueries; each lists the others it reads.
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "panel": ((), fx.PANEL),
    "names_usa": ((), fx.NAMES_USA),
    "names_global": ((), fx.NAMES_GLOBAL),
    "verdicts": ((), fx.VERDICTS),
    "responses": ((), fx.RESPONSES),
    "flagged": ((), fx.FLAGGED),
}


def part(name: str, needs: str, sql: str) -> None:
    PARTS[name] = (tuple(needs.split()), sql)


def _ordered(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _ordered(PARTS[name][0], seen)
            seen.append(name)
    return seen


def oracle(name: str, needs: str, sql: str) -> None:
    used = _ordered(tuple(needs.split()), [])
    ctes = ",\n".join(f"{n} AS ({PARTS[n][1].strip()})" for n in used)
    sql = sql.strip()
    whole = WHOLE.get(name)
    if whole:
        longs = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in whole.split())
        sql = f"SELECT * REPLACE ({longs}) FROM ({sql})"
    ORACLE[name] = f"WITH {ctes}\n{sql}" if used else sql


def day(column: str, alias: str | None = None) -> str:
    return f"CAST({column} AS VARCHAR) AS {alias or column.split('.')[-1]}"


def six(column: str, alias: str | None = None) -> str:
    return f"round({column}, 6) AS {alias or column.split('.')[-1]}"


part("p", "panel", "SELECT *, prc AS price, CAST(gvkey AS VARCHAR) || '_' || CAST(iid AS VARCHAR) AS ticker FROM panel")
for _name, _key in (("pr", "gvkey"), ("pr_t", "ticker")):
    part(_name, "p", f"""
SELECT *, lag(price) OVER w AS prev_price, lag(volume) OVER w AS prev_volume, lag(date) OVER w AS prev_date,
  row_number() OVER w AS nr, count(*) OVER (PARTITION BY {_key}) AS n_rows, max(date) OVER (PARTITION BY {_key}) AS newest,
  lead(date) OVER w AS next_date
FROM p WINDOW w AS (PARTITION BY {_key} ORDER BY date, iid)
""")
part("bounds", "panel", """
SELECT min(date) AS dataset_start, max(date) AS dataset_end, quantile_cont(bidaskhl_21d, 0.85) AS spread_p85 FROM panel
""")

# Names ------------------------------------------------------------------------------------------

part("usa", "names_usa", """
SELECT gvkey, arg_max(conm, (datadate IS NULL, coalesce(datadate, DATE '1900-01-01'), seq)) AS company_name
FROM names_usa WHERE conm IS NOT NULL GROUP BY gvkey
UNION ALL
SELECT gvkey, NULL FROM names_usa GROUP BY gvkey HAVING count(conm) = 0
""")
part("second", "names_global", """
SELECT gvkey, arg_max(conm, (d IS NULL, coalesce(d, DATE '1900-01-01'), seq)) AS company_name
FROM (SELECT *, TRY_CAST(datadate_raw AS DATE) AS d FROM names_global WHERE trim(conm) <> '') GROUP BY gvkey
""")
part("second_only", "usa second", "SELECT * FROM second WHERE gvkey NOT IN (SELECT gvkey FROM usa)")
part("names", "usa second_only", """
SELECT gvkey, company_name, 1 AS known FROM usa UNION ALL SELECT gvkey, company_name, 1 FROM second_only
""")
NAMED = "CASE WHEN n.known = 1 THEN n.company_name ELSE 'Unknown' END AS company_name"


def named(select: str, source: str) -> str:
    """Event rows with their company name; ``select`` reads the events as e."""
    return f"SELECT e.gvkey, {NAMED}, {select} FROM {source} e LEFT JOIN names n ON n.gvkey = e.gvkey"


# Sources, projections, filters ------------------------------------------------------------------

PANEL_COLUMNS = f"gvkey, iid, {day('date')}, {six('prc')}, {six('volume')}, {six('stock_ret')}, {six('z_score')}, f_score, {six('age')}"
oracle("scan_panel_parquet", "panel", f"SELECT {PANEL_COLUMNS} FROM panel")
oracle("scan_panel_csv", "panel", f"SELECT {PANEL_COLUMNS} FROM panel")
oracle("scan_dispatch", "", """
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice, kind FROM orders CROSS JOIN (VALUES ('parquet'), ('csv')) AS k(kind)
""")
oracle("scan_by_key_list", "panel", f"SELECT gvkey, iid, {day('date')}, {six('prc')} FROM panel WHERE gvkey IN (4, 7, 15, 22)")
oracle("distinct_keys", "panel", "SELECT DISTINCT gvkey FROM panel")

part("acq_all", "verdicts", """
SELECT *, TRY_CAST(actual_date_raw AS DATE) AS actual_date FROM verdicts
WHERE upper(verified) = 'TRUE' AND lower(actual_event_type) = 'acquisition'
  AND TRY_CAST(actual_date_raw AS DATE) IS NOT NULL
  AND NOT (year(TRY_CAST(actual_date_raw AS DATE)) = 2014 AND month(TRY_CAST(actual_date_raw AS DATE)) = 12)
""")
part("acq", "acq_all", """
SELECT * FROM acq_all QUALIFY row_number() OVER (PARTITION BY gvkey, actual_date ORDER BY seq) = 1
""")
oracle("scan_by_keys", "panel acq", f"""
SELECT gvkey, iid, {day('date')}, {six('prc')}, {six('volume')} FROM panel WHERE gvkey IN (SELECT gvkey FROM acq)
""")
oracle("make_ticker", "p", f"SELECT gvkey, iid, {day('date')}, ticker FROM p")
oracle("parse_yyyymmdd", "panel", f"""
SELECT gvkey, iid, CAST(year * 10000 + month * 100 + 1 AS DOUBLE) AS raw, {day('date')} FROM panel
""")
oracle("parse_yyyymmdd_coerce", "panel", f"""
SELECT gvkey, iid, raw, CAST(CAST(try_strptime(CAST(CAST(raw AS BIGINT) AS VARCHAR), '%Y%m%d') AS DATE) AS VARCHAR) AS date
FROM (SELECT gvkey, iid, CAST(year * 10000 + month * 100 + 1 + CASE WHEN gvkey % 7 = 0 THEN 90 ELSE 0 END AS DOUBLE) AS raw FROM panel)
""")
oracle("parse_date_coerce", "names_global", f"""
SELECT gvkey, seq, datadate_raw, CAST(TRY_CAST(datadate_raw AS DATE) AS VARCHAR) AS datadate FROM names_global
""")
oracle("resolve_price", "panel", f"SELECT gvkey, iid, {day('date')}, {six('prc', 'price')} FROM panel")
oracle("volume_proxy", "panel", f"SELECT gvkey, iid, {day('date')}, round(abs(stock_ret) * 1000000, 6) AS volume FROM panel")

RATIOS = (
    "z_score", "o_score", "kz_index", "ni_be", "ocf_at", "ebitda_mev", "zero_trades_252d", "zero_trades_21d",
    "ami_126d", "bidaskhl_21d", "turnover_126d", "dolvol_126d", "at_be", "debt_me", "ni_ar1", "eqnpo_me", "age",
)
oracle("project_essential", "p", f"""
SELECT ticker, {day('date')}, {six('price')}, {six('volume')}, {six('stock_ret')}, gvkey, iid, excntry, year, month,
  f_score, {', '.join(six(c) for c in RATIOS)} FROM p
""")
oracle("normalize_panel", "p", f"""
SELECT ticker, {day('date')}, CASE WHEN stock_ret IS NOT NULL THEN round(100 * product(1 + stock_ret)
    OVER (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING), 6) END AS price,
  round(abs(stock_ret) * 1000000, 6) AS volume, {six('stock_ret')}, gvkey, iid, excntry, year, month,
  f_score, {', '.join(six(c) for c in RATIOS)} FROM p
""")
oracle("filter_min_history", "panel", "SELECT gvkey, count(*) AS n_rows FROM panel GROUP BY gvkey HAVING count(*) >= 24")
oracle("filter_verified_acquisitions", "acq_all", f"""
SELECT seq, gvkey, {day('actual_date')}, acquirer, {six('acquisition_price')} FROM acq_all
""")
oracle("filter_event_year", "verdicts", """
SELECT seq, gvkey, CAST(TRY_CAST(detected_date_raw AS DATE) AS VARCHAR) AS event_date FROM verdicts
WHERE year(TRY_CAST(detected_date_raw AS DATE)) = 1998
""")
part("confident", "verdicts", """
SELECT * FROM verdicts WHERE upper(verified) = 'TRUE' AND llm_confidence IN ('high', 'medium')
""")
oracle("filter_label_confidence", "confident", "SELECT seq, gvkey, llm_confidence FROM confident")
oracle("ensure_columns", "flagged", """
SELECT *, CAST(NULL AS VARCHAR) AS verified, CAST(NULL AS VARCHAR) AS actual_event_type,
  CAST(NULL AS VARCHAR) AS actual_date, CAST(NULL AS VARCHAR) AS llm_confidence, CAST(NULL AS VARCHAR) AS details,
  CAST(NULL AS VARCHAR) AS acquirer, CAST(NULL AS DOUBLE) AS acquisition_price
FROM flagged
""")
oracle("project_acquisition_fields", "acq_all", f"""
SELECT seq, gvkey, {day('actual_date')}, actual_event_type, acquirer, {six('acquisition_price')} FROM acq_all
""")
part("firms", "panel", "SELECT DISTINCT gvkey FROM panel")
oracle("attach_company_name", "firms names", f"SELECT e.gvkey, {NAMED} FROM firms e LEFT JOIN names n ON n.gvkey = e.gvkey")
oracle("filter_has_name", "firms names", f"""
SELECT *, coalesce(company_name IS NOT NULL AND company_name <> 'Unknown' AND company_name <> '', false) AS named
FROM (SELECT e.gvkey, {NAMED} FROM firms e LEFT JOIN names n ON n.gvkey = e.gvkey)
""")
part("flagged_named", "flagged names", f"""
SELECT e.*, {NAMED}, TRY_CAST(e.event_date AS DATE) AS event_day FROM flagged e LEFT JOIN names n ON n.gvkey = e.gvkey
""")
HAS_NAME = "company_name IS NOT NULL AND company_name <> 'Unknown' AND company_name <> ''"
part("skipped", "flagged_named", f"""
SELECT gvkey, 'Unknown' AS company_name, false AS verified, 'skipped' AS actual_event_type, 'low' AS llm_confidence,
  'Skipped verification - no company name found in database' AS details, event_type AS detected_event_type,
  CAST(event_day AS VARCHAR) AS detected_date, 'no_company_name' AS skip_reason
FROM flagged_named WHERE NOT coalesce({HAS_NAME}, false)
""")
oracle("skip_unnamed_rows", "skipped", "SELECT * FROM skipped")
oracle("company_name_mapping", "names", "SELECT gvkey, company_name FROM names")
oracle("names_except", "second_only", "SELECT gvkey, company_name FROM second_only")

# Features of a firm -----------------------------------------------------------------------------

LAST = (
    "z_score", "o_score", "kz_index", "ni_be", "ocf_at", "ebitda_mev", "zero_trades_252d", "zero_trades_21d",
    "bidaskhl_21d", "at_be", "debt_me", "f_score", "ni_ar1",
)
EXACT = "CAST(CAST(eqnpo_me AS DECIMAL(18,12)) AS DECIMAL(38,12))"
for _name, _key in (("feat", "gvkey"), ("feat_t", "ticker")):
    part(_name, "p bounds", f"""
SELECT f.*, b.*, CAST(b.dataset_end - f.last_date AS BIGINT) AS days,
  CASE WHEN p24 = 0 AND last_price < 0 THEN -CAST('inf' AS DOUBLE) WHEN p24 = 0 AND last_price > 0 THEN CAST('inf' AS DOUBLE)
       WHEN p24 <> 0 THEN (last_price - p24) / p24 END AS pc,
  CASE WHEN ami_med > 0 THEN ami_12 / ami_med END AS ami_r,
  CASE WHEN turn_med > 0 THEN 1 - turn_12 / turn_med END AS turn_r,
  CASE WHEN dol_med > 0 THEN 1 - dol_12 / dol_med END AS dol_fall,
  CASE WHEN dol_med > 0 THEN dol_6 / dol_med END AS dol_rise,
  CASE WHEN spr_med > 0 THEN (spr_6 - spr_med) / spr_med END AS spr_r
FROM (
  SELECT {_key}, count(*) AS n_rows, max(date) AS last_date,
    max(price) FILTER (rn = 1) AS last_price, max(price) FILTER (rn = 24) AS p24,
    {', '.join(f'max({c}) FILTER (rn = 1) AS {c}' for c in LAST)},
    avg(ami_126d) FILTER (rn <= 12) AS ami_12, avg(turnover_126d) FILTER (rn <= 12) AS turn_12,
    avg(dolvol_126d) FILTER (rn <= 12) AS dol_12, avg(dolvol_126d) FILTER (rn <= 6) AS dol_6,
    avg(bidaskhl_21d) FILTER (rn <= 6) AS spr_6, avg(eqnpo_me) FILTER (rn <= 5) AS pay_5,
    sum({EXACT}) FILTER (rn <= 5) AS pay_s5, count(eqnpo_me) FILTER (rn <= 5) AS pay_n5,
    sum({EXACT}) FILTER (rn > 5) AS pay_sr, count(eqnpo_me) FILTER (rn > 5) AS pay_nr,
    quantile_cont(ami_126d, 0.5) AS ami_med, quantile_cont(turnover_126d, 0.5) AS turn_med,
    quantile_cont(dolvol_126d, 0.5) AS dol_med, quantile_cont(bidaskhl_21d, 0.5) AS spr_med
  FROM (SELECT *, row_number() OVER (PARTITION BY {_key} ORDER BY date DESC, iid DESC) AS rn FROM p) GROUP BY {_key}
) f CROSS JOIN bounds b
""")
oracle("last_and_nth_last", "feat", f"""
SELECT gvkey, {day('last_date')}, {six('last_price')}, {six('p24', 'tail_first_price')}, {six('pc', 'price_change')},
  {six('z_score', 'z_score_last')}, f_score AS f_score_last FROM feat
""")
oracle("trailing_mean", "feat", f"""
SELECT gvkey, {six('dol_6', 'dolvol_126d_m6')}, {six('dol_12', 'dolvol_126d_m12')}, {six('spr_6', 'bidaskhl_21d_m6')},
  {six('pay_5', 'eqnpo_me_m5')} FROM feat
""")
RISES = "pay_n5 > 0 AND pay_nr > 0 AND CAST(pay_s5 AS DECIMAL(30,12)) * pay_nr > CAST(pay_sr AS DECIMAL(30,12)) * pay_n5"
oracle("mean_excluding_last_k", "feat", f"""
SELECT gvkey, CASE WHEN pay_n5 > 0 THEN round(CAST(pay_s5 AS DOUBLE) / pay_n5, 6) END AS eqnpo_me_recent,
  CASE WHEN pay_nr > 0 THEN round(CAST(pay_sr AS DOUBLE) / pay_nr, 6) END AS eqnpo_me_rest, {RISES} AS eqnpo_me_rises FROM feat
""")
oracle("firm_median", "feat", f"""
SELECT gvkey, {six('ami_med', 'ami_126d')}, {six('turn_med', 'turnover_126d')}, {six('dol_med', 'dolvol_126d')},
  {six('spr_med', 'bidaskhl_21d')} FROM feat
""")
oracle("global_quantile", "bounds", f"SELECT {six('spread_p85', 'quantile')} FROM bounds")
oracle("dataset_bounds", "bounds", f"SELECT {day('dataset_start')}, {day('dataset_end')} FROM bounds")
oracle("broadcast_global_stats", "feat", f"""
SELECT gvkey, {day('last_date')}, {day('dataset_start')}, {day('dataset_end')}, {six('spread_p85')}, days AS days_since FROM feat
""")


def f2(x: str) -> str:
    return f"printf('%.2f', {x})"


def f1(x: str) -> str:
    return f"printf('%.1f', {x})"


def f0(x: str) -> str:
    return f"printf('%.0f', {x})"


def rules_sql(rules: list[list[tuple[str, int, str]]]) -> tuple[str, str]:
    """Points and joined reasons of (condition, points, text) tiers, first tier of each rule."""
    points = " + ".join("CASE " + " ".join(f"WHEN {c} THEN {n}" for c, n, _ in rule) + " ELSE 0 END" for rule in rules)
    texts = ", ".join("CASE " + " ".join(f"WHEN {c} THEN {t}" for c, _, t in rule) + " END" for rule in rules)
    return f"({points})", f"concat_ws('; ', {texts})"


BANKRUPTCY = rules_sql([
    [("z_score < 1.8", 15, f"'Altman Z-score ' || {f2('z_score')} || ' (bankruptcy zone)'"),
     ("z_score < 3.0", 8, f"'Altman Z-score ' || {f2('z_score')} || ' (gray zone)'")],
    [("o_score > 0.5", 15, f"'Ohlson O-score ' || {f2('o_score')} || ' (high risk)'"),
     ("o_score > 0.3", 8, f"'Ohlson O-score ' || {f2('o_score')} || ' (elevated risk)'")],
    [("kz_index < -3", 10, f"'KZ index ' || {f2('kz_index')} || ' (constrained)'")],
    [("ni_be < -0.2", 10, f"'ROE ' || {f1('ni_be * 100')} || '%'"), ("ni_be < -0.1", 5, f"'ROE ' || {f1('ni_be * 100')} || '%'"),
     ("ni_be < 0", 3, "'ROE negative'")],
    [("ocf_at < -0.05", 10, f"'Operating CF ' || {f1('ocf_at * 100')} || '%'"), ("ocf_at < 0", 5, "'Operating CF negative'")],
    [("ebitda_mev < 0", 8, "'Negative EBITDA/EV'")],
    [("zero_trades_252d > 90", 10, f"{f0('zero_trades_252d')} || ' zero-trade days (>3m)'"),
     ("zero_trades_252d > 60", 5, f"{f0('zero_trades_252d')} || ' zero-trade days (>2m)'"),
     ("zero_trades_252d > 30", 3, f"{f0('zero_trades_252d')} || ' zero-trade days (>1m)'")],
    [("ami_r > 5", 8, f"'Illiquidity spike ' || {f1('ami_r')} || 'x'")],
    [("bidaskhl_21d > spread_p85", 5, "'Wide bid-ask spread (>85th pct)'")],
    [("turn_r > 0.6", 5, f"'Turnover declined ' || {f0('turn_r * 100')} || '%'")],
    [("at_be > 0.7", 8, f"'High leverage ' || {f2('at_be')}")],
    [("debt_me > 1.5", 5, f"'Debt-to-market ' || {f2('debt_me')}")],
    [("f_score < 3", 10, "'Pitroski F-score ' || f_score"), ("f_score < 4", 5, "'Pitroski F-score ' || f_score")],
    [("ni_ar1 < 0", 5, "'Negative earnings persistence'")],
    [("days > 180", 20, "'Stopped trading ' || days || ' days before dataset end'"),
     ("days > 120", 10, "'Stopped trading ' || days || ' days before dataset end'")],
    [("pc < -0.8", 15, f"'Price dropped ' || {f1('pc * 100')} || '%'"), ("pc < -0.6", 8, f"'Price dropped ' || {f1('pc * 100')} || '%'"),
     ("pc < -0.4", 4, f"'Price dropped ' || {f1('pc * 100')} || '%'")],
    [("dol_fall > 0.8", 8, f"'Volume collapsed ' || {f0('dol_fall * 100')} || '%'"),
     ("dol_fall > 0.7", 4, f"'Volume collapsed ' || {f0('dol_fall * 100')} || '%'")],
])
MERGER = rules_sql([
    [("pc > -0.15 AND pc < 0.5", 20, f"'Price stable (' || {f1('pc * 100')} || '%)'"),
     ("pc > -0.25 AND pc < 1.0", 10, f"'Price moderately stable (' || {f1('pc * 100')} || '%)'")],
    [("dol_rise > 2", 15, f"'Volume spike ' || {f1('dol_rise')} || 'x'"), ("dol_rise > 1.5", 8, f"'Volume elevated ' || {f1('dol_rise')} || 'x'")],
    [("spr_r < -0.2", 10, "'Bid-ask spread tightened'")],
    [("zero_trades_21d < 5", 8, "'Active trading (low zero-trade days)'")],
    [("ni_be > 0", 8, "'Positive ROE'")],
    [("ocf_at > 0", 8, "'Positive operating CF'")],
    [("z_score > 1.8", 5, f"'Healthy Z-score ' || {f2('z_score')}")],
    [(RISES, 5, "'Payout increased'")],
    [("days > 120", 15, "'Trading stopped ' || days || ' days before dataset end'")],
])
ANTI = (
    "(CASE WHEN z_score < 1.8 THEN 15 ELSE 0 END + CASE WHEN pc < -0.5 THEN 15 ELSE 0 END "
    "+ CASE WHEN ni_be < -0.1 THEN 10 ELSE 0 END)"
)


def full_events(threshold_b: int, threshold_m: int) -> str:
    bankrupt, why_b = BANKRUPTCY
    merge, why_m = MERGER
    return f"""
SELECT gvkey, 'bankruptcy' AS event_type, last_date AS event_date, s AS detection_score,
  CASE WHEN s >= 60 THEN 'high' WHEN s >= 40 THEN 'medium' ELSE 'low' END AS confidence, why AS reasons, last_price, pc
FROM (SELECT *, {bankrupt} AS s, {why_b} AS why FROM feat WHERE n_rows >= 24) WHERE s >= {threshold_b}
UNION ALL
SELECT gvkey, 'merger', last_date, s, CASE WHEN s >= 40 THEN 'medium' ELSE 'low' END, why, last_price, pc
FROM (SELECT *, {merge} AS s, {why_m} AS why FROM feat WHERE n_rows >= 24 AND days >= 120 AND {ANTI} < 30)
WHERE s >= {threshold_m}"""


SEVEN = f"event_type, {day('event_date')}, CAST(detection_score AS BIGINT) AS detection_score, confidence, reasons"
part("full_set", "feat", full_events(50, 40))
part("full_low", "feat", full_events(15, 10))
part("full_5", "feat", full_events(5, 5))
oracle("detect_bankruptcy", "full_set names", named(
    f"{SEVEN}, {six('last_price')}, round(pc * 100, 6) AS price_change_60d", "full_set") + " WHERE event_type = 'bankruptcy'")
oracle("detect_merger", "full_set names", named(
    f"{SEVEN}, {six('last_price')}, round(pc * 100, 6) AS price_change_60d", "full_set") + " WHERE event_type = 'merger'")
oracle("detect_all_events", "full_low names", named(SEVEN, "full_low"))

SINGLE_B = rules_sql([
    [("z_score < 1.8", 15, f"'Z-score ' || {f2('z_score')} || ' (bankruptcy zone)'"),
     ("z_score < 3.0", 8, f"'Z-score ' || {f2('z_score')} || ' (gray zone)'")],
    [("o_score > 0.5", 15, f"'O-score ' || {f2('o_score')} || ' (high risk)'")],
    [("ni_be < -0.2", 10, f"'ROE ' || {f1('ni_be * 100')} || '%'"), ("ni_be < 0", 5, "'Negative ROE'")],
    [("zero_trades_252d > 90", 10, f"{f0('zero_trades_252d')} || ' zero-trade days'")],
    [("dol_fall > 0.8", 8, f"'Volume collapsed ' || {f0('dol_fall * 100')} || '%'")],
    [("days > 365", 20, "'Stopped trading ' || days || ' days early'")],
    [("pc < -0.8", 15, f"'Price dropped ' || {f1('pc * 100')} || '%'")],
])
SINGLE_M = rules_sql([
    [("pc > -0.15 AND pc < 0.5", 20, f"'Price stable (' || {f1('pc * 100')} || '%)'")],
    [("dol_rise > 2", 15, f"'Volume spike ' || {f1('dol_rise')} || 'x'")],
    [("ni_be > 0", 8, "'Positive ROE'")],
    [("z_score > 1.8", 5, f"'Healthy Z-score ' || {f2('z_score')}")],
    [("days > 120", 15, "'Trading stopped ' || days || ' days early'")],
])
part("single", "feat", f"""
SELECT gvkey, n_rows, last_date,
  CASE WHEN n_rows >= 24 THEN {SINGLE_B[0]} ELSE 0 END AS bs, CASE WHEN n_rows >= 24 THEN {SINGLE_B[1]} ELSE '' END AS bw,
  CASE WHEN n_rows >= 24 AND days >= 240 THEN {SINGLE_M[0]} ELSE 0 END AS ms,
  CASE WHEN n_rows >= 24 AND days >= 240 THEN {SINGLE_M[1]} ELSE '' END AS mw
FROM feat
""")
part("single_events", "single", """
SELECT gvkey, 'bankruptcy' AS event_type, last_date AS event_date, bs AS detection_score,
  CASE WHEN bs >= 60 THEN 'high' WHEN bs >= 40 THEN 'medium' ELSE 'low' END AS confidence, bw AS reasons
FROM single WHERE n_rows >= 10 AND bs >= 55
UNION ALL
SELECT gvkey, 'merger', last_date, ms, CASE WHEN ms >= 50 THEN 'medium' ELSE 'low' END, mw
FROM single WHERE n_rows >= 10 AND bs < 44 AND ms >= 50
""")
oracle("score_bankruptcy_single", "single", f"""
SELECT gvkey, n_rows, {day('last_date')}, CAST(bs AS BIGINT) AS bankruptcy_score, bw AS bankruptcy_reasons FROM single
""")
oracle("score_merger_single", "single", f"""
SELECT gvkey, n_rows, {day('last_date')}, CAST(ms AS BIGINT) AS merger_score, mw AS merger_reasons FROM single
""")
oracle("detect_single_pass", "single_events names", named(SEVEN, "single_events"))
oracle("sink_events_csv", "single_events names", named(SEVEN, "single_events"))
oracle("confidence_band", "verdicts", """
SELECT seq, score, actual_event_type,
  CASE actual_event_type WHEN 'bankruptcy' THEN CASE WHEN score >= 60 THEN 'high' WHEN score >= 40 THEN 'medium' ELSE 'low' END
    WHEN 'merger' THEN CASE WHEN score >= 50 THEN 'medium' ELSE 'low' END
    WHEN 'halt' THEN CASE WHEN score >= 35 THEN 'medium' ELSE 'low' END ELSE 'medium' END AS confidence
FROM (SELECT *, seq % 90 AS score FROM verdicts)
""")

SIMPLE_B = rules_sql([
    [("z_score < 1.8", 15, f"'Altman Z-score ' || {f2('z_score')} || ' (bankruptcy zone)'"),
     ("z_score < 3.0", 8, f"'Altman Z-score ' || {f2('z_score')} || ' (gray zone)'")],
    [("o_score > 0.5", 15, f"'Ohlson O-score ' || {f2('o_score')} || ' (high risk)'"),
     ("o_score > 0.3", 8, f"'Ohlson O-score ' || {f2('o_score')} || ' (elevated risk)'")],
    [("ni_be < -0.2", 10, f"'ROE ' || {f1('ni_be * 100')} || '%'"), ("ni_be < -0.1", 5, f"'ROE ' || {f1('ni_be * 100')} || '%'"),
     ("ni_be < 0", 3, "'ROE negative'")],
    [("zero_trades_252d > 90", 10, f"{f0('zero_trades_252d')} || ' zero-trade days (3+ months)'"),
     ("zero_trades_252d > 60", 5, f"{f0('zero_trades_252d')} || ' zero-trade days (2+ months)'")],
    [("pc < -0.8", 15, f"'Price dropped ' || {f1('pc * 100')} || '%'"), ("pc < -0.6", 8, f"'Price dropped ' || {f1('pc * 100')} || '%'")],
    [("old > 180", 20, "'No trading for ' || old || ' days (6+ months)'"), ("old > 90", 10, "'No trading for ' || old || ' days (3+ months)'")],
])
SIMPLE_M = rules_sql([
    [("pc > -0.15 AND pc < 0.5", 20, f"'Price stable (' || {f1('pc * 100')} || '%)'")],
    [("dol_rise > 2", 15, f"'Volume spike ' || {f1('dol_rise')} || 'x'"), ("dol_rise > 1.5", 8, f"'Volume elevated ' || {f1('dol_rise')} || 'x'")],
    [("ni_be > 0", 8, "'Positive ROE'")],
    [("old > 90", 15, "'Trading stopped ' || old || ' days ago (3+ months)'")],
])
part("aged", "feat_t", f"SELECT *, CAST({AS_OF} - last_date AS BIGINT) AS old FROM feat_t WHERE n_rows >= 24")
oracle("detect_bankruptcy_simple", "aged", f"""
SELECT ticker, {six('last_price')}, 'bankruptcy' AS event_type, {day('last_date', 'event_date')}, CAST(s AS BIGINT) AS detection_score,
  CASE WHEN s >= 50 THEN 'high' WHEN s >= 35 THEN 'medium' ELSE 'low' END AS confidence, why AS reasons
FROM (SELECT *, {SIMPLE_B[0]} AS s, {SIMPLE_B[1]} AS why FROM aged) WHERE s >= 5
""")
oracle("detect_merger_simple", "aged", f"""
SELECT ticker, {six('last_price')}, 'merger' AS event_type, {day('last_date', 'event_date')}, CAST(s AS BIGINT) AS detection_score,
  CASE WHEN s >= 35 THEN 'medium' ELSE 'low' END AS confidence, why AS reasons
FROM (SELECT *, {SIMPLE_M[0]} AS s, {SIMPLE_M[1]} AS why FROM aged WHERE old >= 90
  AND CASE WHEN z_score < 1.8 THEN 15 ELSE 0 END + CASE WHEN pc < -0.5 THEN 15 ELSE 0 END < 30) WHERE s >= 5
""")

# Rows and gaps ----------------------------------------------------------------------------------

oracle("date_gaps", "pr", f"SELECT gvkey, iid, {day('date')}, CAST(date - prev_date AS DOUBLE) AS gap_days FROM pr")
CHANGE = (
    "CASE WHEN prev_price = 0 AND price > 0 THEN CAST('inf' AS DOUBLE) WHEN prev_price = 0 AND price < 0 THEN -CAST('inf' AS DOUBLE) "
    "WHEN prev_price <> 0 THEN price / prev_price - 1 END"
)
oracle("pct_change", "pr", f"SELECT gvkey, iid, {day('date')}, round({CHANGE}, 6) AS change FROM pr")
oracle("prev_row_value", "pr", f"SELECT gvkey, iid, {day('date')}, {six('prev_price')}, {six('prev_volume')} FROM pr")
oracle("tail_n", "p", f"""
SELECT gvkey, iid, {day('date')}, {six('price')}, row_number() OVER w AS rn FROM p
WINDOW w AS (PARTITION BY gvkey ORDER BY date DESC, iid DESC) QUALIFY row_number() OVER w <= 24
""")
oracle("first_row_value", "pr", f"""
SELECT gvkey, {day('date', 'first_date')}, {six('age', 'first_age')}, {six('price', 'first_price')} FROM pr WHERE nr = 1
""")
oracle("sort_panel", "panel", f"SELECT gvkey, iid, {day('date')}, {six('prc')} FROM panel ORDER BY gvkey, date, iid")
oracle("price_index_from_returns", "p", f"""
SELECT ticker, {day('date')}, {six('stock_ret')}, CASE WHEN stock_ret IS NOT NULL THEN round(100 * product(1 + stock_ret)
  OVER (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING), 6) END AS price FROM p
""")
for _name, _rows in (("gaps", "pr"), ("gaps_t", "pr_t")):
    part(_name, _rows, f"""
SELECT *, CAST(date - prev_date AS BIGINT) AS gap_days FROM {_rows} WHERE n_rows >= 10
""")
part("islands", "gaps", """
SELECT gvkey, min(prev_date) AS start_date, max(date) AS end_date, CAST(sum(gap_days) AS BIGINT) AS total_gap_days,
  count(*) AS consecutive_gaps, max(nr) < max(n_rows) AS resumed
FROM (SELECT *, nr - row_number() OVER (PARTITION BY gvkey ORDER BY nr) AS island FROM gaps WHERE gap_days >= 120)
GROUP BY gvkey, island
""")
oracle("consecutive_gap_islands", "islands", f"""
SELECT gvkey, {day('start_date')}, {day('end_date')}, total_gap_days, consecutive_gaps, resumed FROM islands
""")
HALT = rules_sql([
    [("consecutive_gaps > 1", 10, "total_gap_days || '-day halt period (' || consecutive_gaps || ' consecutive gaps)'"),
     ("true", 10, "total_gap_days || '-day gap'")],
    [("resumed", 15, "'Trading resumed'")],
    [("total_gap_days < 180", 10, "'Short halt (likely temporary)'"), ("total_gap_days < 365", 5, "'Medium halt'")],
    [("consecutive_gaps > 1", 5, "'Multiple consecutive gaps (' || consecutive_gaps || ')'")],
])
for _name, _least in (("halts", 30), ("halts_5", 5)):
    part(_name, "islands", f"""
SELECT gvkey, 'halt' AS event_type, start_date AS event_date, s AS detection_score,
  CASE WHEN s >= 20 THEN 'medium' ELSE 'low' END AS confidence, why AS reasons, end_date, total_gap_days, consecutive_gaps
FROM (SELECT *, {HALT[0]} AS s, {HALT[1]} AS why FROM islands) WHERE s >= {_least}
""")
oracle("detect_halt", "halts names", named(
    f"{SEVEN}, {day('end_date', 'halt_end_date')}, total_gap_days, consecutive_gaps", "halts"))
oracle("score_halt_single", "gaps", f"""
SELECT gvkey, CAST(s AS BIGINT) AS score, gap_days || '-day gap; Trading resumed' || CASE WHEN gap_days < 180 THEN '; Short halt' ELSE '' END AS reasons,
  {day('date', 'halt_date')}
FROM (SELECT *, 25 + CASE WHEN gap_days < 180 THEN 10 ELSE 0 END AS s FROM gaps WHERE gap_days >= 120 AND date < newest)
QUALIFY row_number() OVER (PARTITION BY gvkey ORDER BY s DESC, date) = 1
""")
SIMPLE_HALT = rules_sql([
    [("true", 10, "gap_days || '-day gap (3+ months)'")],
    [("nr < n_rows", 15, "'Trading resumed'")],
    [("gap_days < 180", 10, "'Short gap (likely halt)'"), ("gap_days < 365", 5, "'Medium gap'")],
])
oracle("detect_halt_simple", "gaps_t", f"""
SELECT ticker, 'halt' AS event_type, {day('prev_date', 'event_date')}, {day('date', 'halt_end_date')}, CAST(s AS BIGINT) AS detection_score,
  CASE WHEN s >= 25 THEN 'medium' ELSE 'low' END AS confidence, why AS reasons, gap_days
FROM (SELECT *, {SIMPLE_HALT[0]} AS s, {SIMPLE_HALT[1]} AS why FROM gaps_t WHERE gap_days >= 90)
""")
for _name, _rows in (("firsts", "pr"), ("firsts_t", "pr_t")):
    part(_name, f"{_rows} bounds", f"""
SELECT gvkey, ticker, date, age, price, CAST(date - dataset_start AS BIGINT) / 30.0 AS months FROM {_rows} CROSS JOIN bounds WHERE nr = 1
""")
YOUNG = f"'Young firm (age ' || {f1('age')} || 'y), appeared ' || {f1('months')} || ' months after dataset start'"
part("ipos", "firsts", f"""
SELECT gvkey, 'ipo' AS event_type, date AS event_date, 100 AS detection_score, 'high' AS confidence, {YOUNG} AS reasons, price AS first_price
FROM firsts WHERE months >= 18 AND age < 3
""")
oracle("detect_ipo", "ipos names", named(f"{SEVEN}, {six('first_price')}", "ipos"))
oracle("detect_ipo_simple", "firsts_t", f"""
SELECT ticker, CASE WHEN age >= 2 THEN 'uncertain_ipo' ELSE 'ipo' END AS event_type, {day('date', 'event_date')},
  CAST(100 AS BIGINT) AS detection_score, CASE WHEN age < 2 THEN 'high' ELSE 'medium' END AS confidence,
  CASE WHEN age < 2 THEN {YOUNG} WHEN age >= 2 THEN 'Firm age ' || {f1('age')} || 'y, appeared ' || {f1('months')} || ' months after dataset start'
    ELSE 'Appeared ' || {f1('months')} || ' months after dataset start' END AS reasons, {six('price', 'first_price')}
FROM firsts_t WHERE months >= 6
""")
for _name, _rows in (("splits", "pr"), ("splits_t", "pr_t")):
    part(_name, _rows, f"""
SELECT gvkey, ticker, 'stock_split' AS event_type, date AS event_date, 15 + CASE WHEN spike THEN 10 ELSE 0 END AS detection_score,
  'medium' AS confidence,
  'Price drop ' || {f1('change * 100')} || '% (matches ' || split_type || ')' || CASE WHEN spike THEN '; Volume spike' ELSE '' END AS reasons,
  split_type
FROM (SELECT *, CASE WHEN abs(change + 0.5) < 0.02 THEN '2:1 split' WHEN abs(change + 0.67) < 0.02 THEN '3:1 split'
        WHEN abs(change + 0.75) < 0.02 THEN '4:1 split' END AS split_type,
        coalesce(prev_volume > 0 AND volume > prev_volume * 1.5, false) AS spike
      FROM (SELECT *, {CHANGE} AS change FROM {_rows}))
WHERE split_type IS NOT NULL
""")
SIMPLE_SEVEN = f"ticker, {SEVEN}"
oracle("detect_stock_split", "splits names", named(f"{SEVEN}, split_type", "splits"))
oracle("detect_split_simple", "splits_t", f"SELECT {SIMPLE_SEVEN}, split_type FROM splits_t")
oracle("pad_event_schema", "splits_t", f"""
SELECT CAST(NULL AS DOUBLE) AS gvkey, CAST(NULL AS VARCHAR) AS company_name, {SEVEN} FROM splits_t
""")
JUMP = "CASE WHEN prev_price > 0 THEN (price - prev_price) / prev_price END"
ERRORS = rules_sql([
    [("price < 0", 20, "'Negative price'")],
    [("abs(jump) > CASE WHEN prev_price >= 20 THEN 5 WHEN prev_price >= 5 THEN 10 WHEN prev_price >= 1 THEN 20 "
      "WHEN prev_price >= 0.1 THEN 50 ELSE 100 END", 15, f"'Extreme jump ' || {f0('jump * 100')} || '%'")],
    [("volume = 0 AND price >= 5", 8, "'Zero volume (unusual for higher-priced stock)'"),
     ("volume = 0 AND price >= 1", 3, "'Zero volume (somewhat unusual)'")],
])
ERRORS_SIMPLE = rules_sql([
    [("price < 0", 20, "'Negative price'")],
    [("abs(jump) > 10", 15, f"'Extreme jump ' || {f0('jump * 100')} || '%'")],
    [("volume = 0", 5, "'Zero volume'")],
])
for _name, _rows, _rules, _least in (("errors", "pr", ERRORS, 10), ("errors_simple", "pr_t", ERRORS_SIMPLE, 3)):
    part(_name, _rows, f"""
SELECT gvkey, ticker, 'data_error' AS event_type, date AS event_date, s AS detection_score, 'high' AS confidence, why AS reasons, price
FROM (SELECT *, {_rules[0]} AS s, {_rules[1]} AS why FROM (SELECT *, {JUMP} AS jump FROM {_rows})) WHERE s >= {_least}
""")
oracle("detect_data_errors", "errors names", named(f"{SEVEN}, {six('price')}", "errors"))
oracle("detect_data_errors_simple", "errors_simple", f"SELECT {SIMPLE_SEVEN}, {six('price')} FROM errors_simple")
EVENT = "gvkey, event_type, event_date, detection_score, confidence, reasons"
part("union_all", "full_set halts ipos splits errors", " UNION ALL ".join(
    f"SELECT {EVENT} FROM {source}" for source in ("full_set", "halts", "ipos", "splits", "errors")))
oracle("union_detections", "union_all names", named(SEVEN, "union_all"))

# Profiles ---------------------------------------------------------------------------------------

COVERAGE = [
    ("Bankruptcy Detection", "z_score o_score kz_index ni_be ocf_at zero_trades_252d ami_126d at_be"),
    ("Merger Detection", "dolvol_126d bidaskhl_21d ni_be eqnpo_me"),
    ("Liquidity Metrics", "zero_trades_21d zero_trades_126d zero_trades_252d turnover_126d ami_126d dolvol_var_126d"),
    ("Quality Metrics", "f_score ni_ar1 ni_ivol"),
]
ABSENT = ("zero_trades_126d", "dolvol_var_126d", "ni_ivol")
oracle("feature_coverage", "panel", " UNION ALL ".join(
    f"SELECT '{category}' AS category, '{c}' AS feature, false AS available, 'NOT FOUND' AS column_name, "
    "CAST(NULL AS DOUBLE) AS coverage, 'N/A' AS coverage_pct" if c in ABSENT else
    f"SELECT '{category}', '{c}', true, '{c}', round(count({c}) * 100.0 / count(*), 6), "
    f"{f1(f'count({c}) * 100.0 / count(*)')} || '%' FROM panel"
    for category, features in reversed(COVERAGE) for c in reversed(features.split())))
oracle("sample_statistics", "p", """
SELECT count(*) AS total_rows, count(DISTINCT ticker) AS unique_tickers, count(DISTINCT gvkey) AS unique_stocks,
  CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date, count(DISTINCT year) AS years_covered,
  string_agg(DISTINCT excntry, ',' ORDER BY excntry) AS countries, round(count(*) / count(DISTINCT ticker), 6) AS avg_observations_per_stock,
  CAST(18 AS BIGINT) AS total_features
FROM p
""")
part("patterns", "p", f"""
SELECT *, CASE WHEN days_since_last > 365 THEN 'likely_delisted' WHEN days_since_last > 90 THEN 'possibly_delisted'
  WHEN n_gaps > 5 THEN 'many_gaps' ELSE 'active' END AS status
FROM (SELECT ticker, min(date) AS first_date, max(date) AS last_date, count(*) AS n_observations,
        count(*) FILTER (gap > 35) AS n_gaps, coalesce(max(gap), 0) AS max_gap_days, CAST({AS_OF} - max(date) AS BIGINT) AS days_since_last
      FROM (SELECT ticker, date, CAST(date - lag(date) OVER (PARTITION BY ticker ORDER BY date) AS BIGINT) AS gap FROM p) GROUP BY ticker)
""")
oracle("missing_patterns", "patterns", f"""
SELECT ticker, {day('first_date')}, {day('last_date')}, n_observations, n_gaps, max_gap_days, days_since_last, status FROM patterns
""")
oracle("missing_pattern_summary", "patterns", """
SELECT 'total_stocks' AS metric, count(*) AS n FROM patterns
UNION ALL SELECT 'stocks_with_gaps', count(*) FROM patterns WHERE n_gaps > 0
UNION ALL SELECT 'likely_delisted', count(*) FROM patterns WHERE status = 'likely_delisted'
UNION ALL SELECT 'status:' || status, count(*) FROM patterns GROUP BY status
""")
oracle("value_counts", "verdicts", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM verdicts WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in ("actual_event_type", "llm_confidence", "verified")))

# Labels -----------------------------------------------------------------------------------------


def window_labels(events: str) -> str:
    """Last event by seq whose window holds the row's date; events has gvkey, seq, lo, hi and the label."""
    return f"""
SELECT p.gvkey, p.iid, p.date, coalesce(e.actual_event_type, 'none') AS event_label, e.day AS event_date,
  CASE WHEN e.seq IS NOT NULL THEN coalesce(e.llm_confidence, 'medium') END AS event_confidence, coalesce(e.details, '') AS event_details
FROM panel p LEFT JOIN (
  SELECT p.gvkey, p.iid, p.date, max(e.seq) AS seq FROM panel p JOIN {events} e
  ON e.gvkey = p.gvkey AND p.date BETWEEN e.lo AND e.hi GROUP BY p.gvkey, p.iid, p.date
) w ON w.gvkey = p.gvkey AND w.iid = p.iid AND w.date = p.date LEFT JOIN {events} e ON e.seq = w.seq"""


WINDOWED = """
SELECT *, CASE WHEN actual_event_type IN ('bankruptcy', 'merger', 'acquisition') THEN day - 60 ELSE day END AS lo,
  {hi} AS hi
FROM (SELECT *, coalesce(TRY_CAST(actual_date_raw AS DATE), TRY_CAST(detected_date_raw AS DATE)) AS day FROM {source})
"""
part("windowed_all", "verdicts", WINDOWED.format(
    source="verdicts", hi="CASE WHEN actual_event_type = 'halt' AND seq % 2 = 0 THEN day + 200 ELSE day END"))
part("windowed", "confident", WINDOWED.format(source="confident", hi="day"))
part("labeled_all", "panel windowed_all", window_labels("windowed_all"))
part("labeled", "panel windowed", window_labels("windowed"))
LABELED = f"gvkey, iid, {day('date')}, event_label, {day('event_date')}, event_confidence, event_details"
oracle("label_event_windows", "labeled_all", f"SELECT {LABELED} FROM labeled_all")
oracle("label_from_verdicts", "labeled", f"SELECT {LABELED} FROM labeled")
part("distribution", "labeled", """
SELECT event_label AS label, count(*) AS n FROM labeled GROUP BY event_label
UNION ALL SELECT '(labeled rows)', count(*) FROM labeled WHERE event_label <> 'none'
""")
oracle("label_distribution", "distribution labeled", """
SELECT label, n, round(n * 100.0 / (SELECT count(*) FROM labeled), 6) AS percent FROM distribution
""")
part("acquired", "panel acq", """
SELECT p.gvkey, p.iid, p.date, p.year,
  CASE WHEN (p.gvkey, p.date, p.iid) IN (SELECT (gvkey, date, iid) FROM (
    SELECT a.seq, q.gvkey, q.date, q.iid, row_number() OVER (PARTITION BY a.seq ORDER BY q.date DESC, q.iid) AS nr
    FROM acq a JOIN panel q ON q.gvkey = a.gvkey AND q.date < a.actual_date) WHERE nr = 1) THEN 1 ELSE 0 END AS is_acquired,
  a.actual_date AS acquisition_date, CAST(a.actual_date - p.date AS DOUBLE) AS days_to_acquisition, a.acquirer, a.acquisition_price,
  a.actual_event_type AS event_type_verified
FROM panel p LEFT JOIN (
  SELECT q.gvkey, q.iid, q.date, max(a.seq) AS seq FROM panel q JOIN acq a ON a.gvkey = q.gvkey AND q.date < a.actual_date
  GROUP BY q.gvkey, q.iid, q.date
) w ON w.gvkey = p.gvkey AND w.iid = p.iid AND w.date = p.date LEFT JOIN acq a ON a.seq = w.seq
""")
ACQUIRED = (
    f"gvkey, iid, {day('date')}, year, CAST(is_acquired AS BIGINT) AS is_acquired, {day('acquisition_date')}, days_to_acquisition, "
    f"acquirer, {six('acquisition_price')}, event_type_verified"
)
oracle("label_acquisitions", "acquired", f"SELECT {ACQUIRED} FROM acquired")
oracle("label_from_acquisitions", "acquired", f"SELECT {ACQUIRED} FROM acquired")
oracle("sink_labeled_parquet", "acquired", f"""
SELECT gvkey, {day('date')}, year, CAST(is_acquired AS BIGINT) AS is_acquired, {day('acquisition_date')}, days_to_acquisition, acquirer FROM acquired
""")
part("summary", "acquired", """
SELECT count(*) AS total_rows, CAST(sum(is_acquired) AS BIGINT) AS total_acquired, CAST(sum(1 - is_acquired) AS BIGINT) AS total_not_acquired,
  round(sum(is_acquired) * 100.0 / count(*), 6) AS positive_rate,
  string_agg(DISTINCT CAST(year(date) AS VARCHAR), '; ' ORDER BY CAST(year(date) AS VARCHAR)) FILTER (is_acquired = 1) AS years_covered
FROM acquired
""")
oracle("acquisition_label_summary", "summary", "SELECT * FROM summary")
oracle("sink_label_summary_json", "summary", """
SELECT *, 'Only acquisitions (not mergers); Excluded all December 2014; Dropped duplicates (gvkey + actual_date); '
  || 'Labeled closest month before acquisition; Only verified events with actual_date' AS filters_applied FROM summary
""")
oracle("acquisition_labels_by_year", "acquired", """
SELECT year(date) AS year, count(*) AS n FROM acquired WHERE is_acquired = 1 GROUP BY year(date)
""")
oracle("acquisitions_by_year", "acq", "SELECT year(actual_date) AS year, count(*) AS n FROM acq GROUP BY year(actual_date)")
oracle("multi_label_firms", "acquired", """
SELECT gvkey, n, count(*) OVER () AS firms_with_several FROM (
  SELECT gvkey, count(*) AS n FROM acquired WHERE is_acquired = 1 GROUP BY gvkey HAVING count(*) > 1)
ORDER BY n DESC, gvkey LIMIT 10
""")
oracle("dedup_events", "acq", f"SELECT seq, gvkey, {day('actual_date')}, acquirer FROM acq")
oracle("sample_head", "acq", f"""
SELECT seq, gvkey, {day('actual_date')}, actual_event_type, acquirer, {six('acquisition_price')} FROM acq ORDER BY seq LIMIT 10
""")
oracle("match_counts", "panel acq", """
SELECT count(*) FILTER (matched) AS events_matched, count(*) FILTER (NOT matched) AS events_unmatched
FROM (SELECT EXISTS (SELECT 1 FROM panel p WHERE p.gvkey = a.gvkey AND p.date < a.actual_date) AS matched FROM acq a)
""")
oracle("rank_best_event", "verdicts", f"""
SELECT gvkey, actual_event_type AS event_type, {day('day', 'event_date')}, seq % 50 AS detection_score, details AS reasons, priority
FROM (SELECT *, coalesce(TRY_CAST(actual_date_raw AS DATE), TRY_CAST(detected_date_raw AS DATE)) AS day,
        CASE actual_event_type WHEN 'bankruptcy' THEN 1 WHEN 'merger' THEN 2 WHEN 'acquisition' THEN 2 ELSE 3 END AS priority FROM verdicts)
QUALIFY row_number() OVER (PARTITION BY gvkey ORDER BY priority, seq % 50 DESC, day NULLS FIRST, details) = 1
""")

# Verification -----------------------------------------------------------------------------------

FIELDS = "verified, actual_event_type, actual_date, llm_confidence, details, acquirer, acquisition_price"


def guide(kinds: str) -> str:
    return " || chr(10) || ".join(f"'{line}'" for line in (
        "verified: true or false", f"actual_event_type: one of {kinds}", "actual_date: text YYYY-MM-DD, or null",
        "llm_confidence: one of high, medium, low", "details: short text", "acquirer: company name, or null",
        "acquisition_price: number per share, or null", "If nothing is found, set verified to false and llm_confidence to low."))


oracle("build_prompts", "flagged_named", f"""
SELECT seq, concat('Check a suspected ', event_type, ' of ', coalesce(company_name, 'Unknown Company'), ' (GVKEY ', gvkey, ').', chr(10),
  'Detected date: ', event_day, chr(10), 'Detection score: ', detection_score, chr(10), 'Confidence: ', confidence, chr(10),
  'Reasons: ', coalesce(reasons, 'N/A'), chr(10), 'Search for what happened to ', coalesce(company_name, 'Unknown Company'), ' around ',
  strftime(event_day, '%B %Y'), ' and answer with one JSON object with these keys:', chr(10),
  {guide('bankruptcy, merger, acquisition, halt, ipo, stock_split, ticker_change, data_error, none, unknown')}) AS prompt FROM flagged_named
""")
oracle("build_prompts_year", "flagged_named", f"""
SELECT seq, concat('Check a suspected ', event_type, ' of ', coalesce(company_name, 'Unknown'), ' (GVKEY ', gvkey, ').', chr(10),
  'Detected date: ', event_day, chr(10), 'Find out what really happened to ', coalesce(company_name, 'Unknown'), ' in 1998.', chr(10),
  'Leave actual_date null unless the exact date is found; never reuse the detected date unconfirmed.', chr(10),
  'Answer with one JSON object with these keys:', chr(10), {guide('acquisition, merger, bankruptcy, none, unknown')}) AS prompt FROM flagged_named
""")
TRIMMED = "trim({x}, ' ' || chr(10) || chr(13) || chr(9))"
FENCED = (
    "CASE WHEN contains(t, '```json') THEN " + TRIMMED.format(x="split_part(split_part(t, '```json', 2), '```', 1)")
    + " WHEN contains(t, '```') THEN " + TRIMMED.format(x="split_part(split_part(t, '```', 2), '```', 1)")
    + " ELSE {rest} END"
)
part("answered", "responses", f"""
SELECT *, {FENCED.format(rest=TRIMMED.format(x='t'))} AS fenced,
  {FENCED.format(rest="CASE WHEN contains(t, '{') THEN regexp_extract(t, '[{][^{}]*[}]') ELSE " + TRIMMED.format(x='t') + " END")} AS balanced
FROM (SELECT *, response_text AS t FROM responses)
""")
oracle("extract_json_fenced", "answered", "SELECT seq, fenced AS json FROM answered")
oracle("extract_json_balanced", "answered", "SELECT seq, balanced AS json FROM answered")
for _name, _json in (("parsed", "balanced"), ("parsed_fenced", "fenced")):
    part(_name, "answered", f"""
SELECT *, CASE WHEN ok THEN json_extract_string(js, '$.verified') = 'true' END AS verified,
  CASE WHEN ok THEN json_extract_string(js, '$.actual_event_type') END AS actual_event_type,
  CASE WHEN ok THEN json_extract_string(js, '$.actual_date') END AS actual_date,
  CASE WHEN ok THEN json_extract_string(js, '$.llm_confidence') END AS llm_confidence,
  CASE WHEN ok THEN json_extract_string(js, '$.details') END AS details,
  CASE WHEN ok THEN json_extract_string(js, '$.acquirer') END AS acquirer,
  CASE WHEN ok THEN TRY_CAST(json_extract_string(js, '$.acquisition_price') AS DOUBLE) END AS acquisition_price
FROM (SELECT *, {_json} AS js, coalesce(json_valid({_json}), false) AS ok FROM answered)
""")
oracle("parse_verdict", "parsed", f"""
SELECT seq, CAST(verified AS VARCHAR) AS verified, actual_event_type, actual_date, llm_confidence, details, acquirer, {six('acquisition_price')} FROM parsed
""")
NO_DATE = "('null', 'None', '', 'N/A', 'n/a')"
oracle("null_token_dates", "parsed", f"""
SELECT seq, actual_date AS raw, CASE WHEN actual_date NOT IN {NO_DATE} THEN actual_date END AS actual_date FROM parsed
""")
STOP = "coalesce(regexp_matches(lower(error_text), 'rate_limit|quota|billing'), false)"
part("judged", "parsed", f"""
SELECT seq, gvkey, prompt, response_text, error_text, failed, stop, coalesce(verified AND NOT failed, false) AS verified,
  CASE WHEN failed THEN 'error' ELSE actual_event_type END AS actual_event_type,
  CASE WHEN NOT failed AND actual_date NOT IN {NO_DATE} THEN actual_date END AS actual_date,
  CASE WHEN failed THEN 'low' ELSE llm_confidence END AS llm_confidence,
  CASE WHEN failed THEN CASE WHEN stop THEN 'API error: ' ELSE 'Error: ' END || coalesce(error_text, 'answer is not a JSON object')
    ELSE details END AS details,
  CASE WHEN NOT failed THEN acquirer END AS acquirer, CASE WHEN NOT failed THEN acquisition_price END AS acquisition_price
FROM (SELECT *, error_text IS NOT NULL OR NOT ok AS failed, {STOP} AS stop FROM parsed)
""")
oracle("verdict_errors", "judged", "SELECT seq, failed, stop, verified, actual_event_type, llm_confidence, details FROM judged")
oracle("verdict_metadata", "judged flagged_named", """
SELECT j.seq, f.gvkey, f.company_name, j.verified, f.event_type AS detected_event_type,
  CAST(f.event_day AS VARCHAR) AS detected_date, j.response_text AS llm_response
FROM judged j JOIN flagged_named f ON f.seq = j.seq
""")
part("priced", "responses", """
SELECT *, CASE WHEN error_text IS NULL THEN units ELSE 0 END AS cost_units
FROM (SELECT *, length(prompt) // 4 + 5 * (length(response_text) // 4) AS units FROM responses)
""")
DOLLAR = "0.00000025"  # one unit is a quarter of a millionth
oracle("request_cost", "priced", """
SELECT seq, length(prompt) // 4 AS input_tokens, length(response_text) // 4 AS output_tokens,
  round(cost_units * CAST(0.25 AS DOUBLE), 6) AS micro_dollars, round(CAST(0.0003 AS DOUBLE), 6) AS other_model_cost FROM priced
""")
part("running", "priced", """
SELECT *, CAST(coalesce(sum(cost_units) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before_units FROM priced
""")
oracle("budget_admission", "running", f"""
SELECT seq, round(CAST(cost_units * CAST({DOLLAR} AS DECIMAL(12,8)) AS DOUBLE), 6) AS cost,
  round(CAST(before_units * CAST({DOLLAR} AS DECIMAL(12,8)) AS DOUBLE), 6) AS spent_before,
  before_units < 20000 AS admitted, round(before_units / 20000 * 100, 6) AS percent_used FROM running
""")
oracle("usage_stats", "priced", f"""
SELECT count(*) AS requests, round(CAST(sum(cost_units) AS DOUBLE) * {DOLLAR}, 6) AS total_cost,
  round(CAST(sum(cost_units) AS DOUBLE) * {DOLLAR} / count(*), 6) AS mean_cost FROM priced WHERE error_text IS NULL
""")
oracle("stop_after_error", "judged", """
SELECT seq, gvkey, actual_event_type FROM judged WHERE seq < coalesce((SELECT min(seq) FROM judged WHERE stop), 9223372036854775807)
""")
QUEUE_ORDER = "conf_rank DESC, detection_score DESC, gvkey, event_type, event_day, seq"
part("queue_all", "flagged_named", f"""
SELECT *, CAST(CASE confidence WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 WHEN 'very_low' THEN 0 END AS BIGINT) AS conf_rank
FROM flagged_named WHERE {HAS_NAME}
""")
part("queue", "queue_all", f"SELECT * FROM queue_all ORDER BY {QUEUE_ORDER} LIMIT 100")
oracle("verification_queue", "queue", f"""
SELECT gvkey, seq, event_type, {day('event_day', 'event_date')}, CAST(detection_score AS BIGINT) AS detection_score, confidence, reasons,
  company_name, conf_rank FROM queue
""")
oracle("resume_offset", "flagged_named", f"""
SELECT seq, gvkey, company_name FROM flagged_named WHERE {HAS_NAME} ORDER BY seq OFFSET 613
""")
oracle("verification_cost_estimate", "flagged_named", f"""
SELECT events, named, least(100, named) AS to_verify, round(least(100, named) * CAST(0.003 AS DOUBLE), 6) AS cost_large,
  round(least(100, named) * CAST(0.0003 AS DOUBLE), 6) AS cost_small, round(least(100, named) * 0.5 / 60, 6) AS minutes
FROM (SELECT count(*) AS events, count(*) FILTER ({HAS_NAME}) AS named FROM flagged_named)
""")


def queue_verdicts(queue: str) -> str:
    return f"""
SELECT gvkey, company_name, verified, actual_event_type, llm_confidence, details, detected_event_type, detected_date, skip_reason,
  CAST(NULL AS VARCHAR) AS actual_date, CAST(NULL AS VARCHAR) AS acquirer, CAST(NULL AS DOUBLE) AS acquisition_price FROM skipped
UNION ALL
SELECT q.gvkey, q.company_name, coalesce(r.verified AND NOT r.failed, false), CASE WHEN r.failed THEN 'error' ELSE r.actual_event_type END,
  CASE WHEN r.failed THEN 'low' ELSE r.llm_confidence END,
  CASE WHEN r.failed THEN 'Error during verification: '
    || coalesce(r.error_text, CASE WHEN r.response_text IS NULL THEN 'no answer' ELSE 'answer is not a JSON object' END) ELSE r.details END,
  q.event_type, CAST(q.event_day AS VARCHAR), NULL, CASE WHEN NOT r.failed THEN r.actual_date END,
  CASE WHEN NOT r.failed THEN r.acquirer END, CASE WHEN NOT r.failed THEN r.acquisition_price END
FROM {queue} q JOIN (
  SELECT a.seq, error_text, response_text, verified, actual_event_type, actual_date, llm_confidence, details, acquirer, acquisition_price,
    error_text IS NOT NULL OR NOT coalesce(ok, false) AS failed
  FROM (SELECT seq FROM {queue}) a LEFT JOIN parsed_fenced f ON f.seq = a.seq
) r ON r.seq = q.seq"""


part("checked", "skipped queue parsed_fenced", queue_verdicts("queue"))
part("checked_all", "skipped queue_all parsed_fenced", queue_verdicts("queue_all"))
oracle("verify_queue", "checked", f"SELECT * REPLACE (round(acquisition_price, 6) AS acquisition_price) FROM checked")
oracle("union_skipped_and_verified", "checked_all", f"SELECT * REPLACE (round(acquisition_price, 6) AS acquisition_price) FROM checked_all")
part("outcome", "checked", """
SELECT CASE WHEN verified THEN 'verified' ELSE 'not_verified' END AS metric, count(*) AS n FROM checked GROUP BY verified
UNION ALL SELECT 'type:' || actual_event_type, count(*) FROM checked WHERE verified AND actual_event_type IS NOT NULL GROUP BY actual_event_type
""")
oracle("verification_summary", "outcome", "SELECT * FROM outcome")


def written(new: str, old: str) -> str:
    """Flagged events with the verdict columns of the processed rows; ``old`` maps columns to earlier values."""
    earlier = dict(part.split("=") for part in old.split(",")) if old else {}

    def column(c: str) -> str:
        before = earlier.get(c, "NULL")
        return f"CASE WHEN j.seq IS NOT NULL THEN j.{c} ELSE {before} END AS {c}"

    columns = ", ".join(column(c.strip()) for c in FIELDS.split(",")[1:-1])
    return f"""
SELECT f.gvkey, f.seq, f.event_type, f.event_date, CAST(f.detection_score AS BIGINT) AS detection_score, f.confidence, f.reasons, f.company_name,
  CAST(j.verified AS VARCHAR) AS verified, {columns}, round(j.acquisition_price, 6) AS acquisition_price
FROM flagged_named f LEFT JOIN {new} j ON j.seq = f.seq"""


oracle("upsert_verdicts", "flagged_named judged", written(
    "(SELECT * FROM judged WHERE verified)", "actual_date='1990-01-01',details='old'"))
part("due", "flagged_named priced judged", f"""
SELECT j.*, p.cost_units FROM judged j JOIN priced p ON p.seq = j.seq WHERE j.seq IN (
  SELECT seq FROM flagged_named WHERE {HAS_NAME} AND year(event_day) = 1998 ORDER BY seq OFFSET 20)
""")
part("admitted", "due", """
SELECT * FROM (SELECT *, coalesce(sum(cost_units) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_units FROM due)
WHERE before_units < 20000
""")
part("processed", "admitted", """
SELECT * FROM admitted WHERE seq < coalesce((SELECT min(seq) FROM admitted WHERE stop), 9223372036854775807)
""")
part("updated", "flagged_named processed", written("processed", ""))
oracle("reverify_year", "updated", "SELECT * FROM updated")
oracle("year_summary", "updated", """
SELECT 'total' AS metric, count(*) AS n FROM updated WHERE year(TRY_CAST(event_date AS DATE)) = 1998
UNION ALL SELECT 'verified', count(*) FROM updated WHERE year(TRY_CAST(event_date AS DATE)) = 1998 AND verified = 'true'
UNION ALL SELECT 'with_date', count(*) FROM updated WHERE year(TRY_CAST(event_date AS DATE)) = 1998 AND actual_date IS NOT NULL
UNION ALL SELECT 'no_date', count(*) FROM updated WHERE year(TRY_CAST(event_date AS DATE)) = 1998 AND actual_date IS NULL
UNION ALL SELECT 'type:' || actual_event_type, count(*) FROM updated
  WHERE year(TRY_CAST(event_date AS DATE)) = 1998 AND actual_date IS NOT NULL AND actual_event_type IS NOT NULL GROUP BY actual_event_type
""")

# Report -----------------------------------------------------------------------------------------

oracle("summary_report", "p single_events outcome distribution labeled", """
SELECT 'dataset' AS section, 'total_stocks' AS metric, CAST(NULL AS VARCHAR) AS key, CAST(count(DISTINCT ticker) AS VARCHAR) AS value FROM p
UNION ALL SELECT 'dataset', 'first_date', NULL, CAST(min(date) AS VARCHAR) FROM p
UNION ALL SELECT 'dataset', 'last_date', NULL, CAST(max(date) AS VARCHAR) FROM p
UNION ALL SELECT 'dataset', 'total_observations', NULL, CAST(count(*) AS VARCHAR) FROM p
UNION ALL SELECT 'detection', 'total', NULL, CAST(count(*) AS VARCHAR) FROM single_events
UNION ALL SELECT 'detection', 'event_type', event_type, CAST(count(*) AS VARCHAR) FROM single_events GROUP BY event_type
UNION ALL SELECT 'detection', 'confidence', confidence, CAST(count(*) AS VARCHAR) FROM single_events GROUP BY confidence
UNION ALL SELECT 'verification', metric, NULL, CAST(n AS VARCHAR) FROM outcome
UNION ALL SELECT 'labels', 'rows', label, CAST(n AS VARCHAR) FROM distribution
UNION ALL SELECT 'labels', 'percent', NULL, printf('%.2f', count(*) FILTER (event_label <> 'none') * 100.0 / count(*)) FROM labeled
""")

# The whole run ----------------------------------------------------------------------------------

part("run_events", "full_5 halts_5 ipos splits errors", " UNION ALL ".join(
    f"SELECT {EVENT} FROM {source}" for source in ("full_5", "halts_5", "ipos", "splits", "errors")))
part("run_answers", "parsed_fenced", "SELECT * FROM parsed_fenced QUALIFY row_number() OVER (PARTITION BY gvkey ORDER BY seq) = 1")
part("run_checked", "run_events names run_answers", f"""
SELECT gvkey, event_date, named AND NOT failed AND coalesce(verified, false) AS verified, llm_confidence,
  CASE WHEN NOT named THEN 'skipped' WHEN failed THEN 'error' ELSE actual_event_type END AS actual_event_type,
  coalesce(TRY_CAST(actual_date AS DATE), event_date) AS day
FROM (
  SELECT e.gvkey, e.event_date, coalesce({HAS_NAME}, false) AS named, a.error_text IS NOT NULL OR NOT coalesce(a.ok, false) AS failed,
    a.verified, a.actual_event_type, a.actual_date, a.llm_confidence
  FROM (SELECT e.*, {NAMED} FROM run_events e LEFT JOIN names n ON n.gvkey = e.gvkey) e LEFT JOIN run_answers a ON a.gvkey = e.gvkey
)
""")
part("run_outcome", "run_checked", """
SELECT CASE WHEN verified THEN 'verified' ELSE 'not_verified' END AS metric, count(*) AS n FROM run_checked GROUP BY verified
UNION ALL SELECT 'type:' || actual_event_type, count(*) FROM run_checked WHERE verified AND actual_event_type IS NOT NULL GROUP BY actual_event_type
""")
part("run_labeled", "panel run_checked", """
SELECT CASE WHEN EXISTS (SELECT 1 FROM run_checked c WHERE c.verified AND c.llm_confidence IN ('high', 'medium')
  AND c.gvkey = p.gvkey AND p.date BETWEEN c.day - 60 AND c.day) THEN 'acquisition' ELSE 'none' END AS event_label FROM panel p
""")
oracle("full_run", "p run_events run_checked run_outcome run_labeled", """
SELECT 'dataset' AS section, 'total_stocks' AS metric, CAST(NULL AS VARCHAR) AS key, CAST(count(DISTINCT ticker) AS VARCHAR) AS value FROM p
UNION ALL SELECT 'dataset', 'first_date', NULL, CAST(min(date) AS VARCHAR) FROM p
UNION ALL SELECT 'dataset', 'last_date', NULL, CAST(max(date) AS VARCHAR) FROM p
UNION ALL SELECT 'dataset', 'total_observations', NULL, CAST(count(*) AS VARCHAR) FROM p
UNION ALL SELECT 'detection', 'total', NULL, CAST(count(*) AS VARCHAR) FROM run_events
UNION ALL SELECT 'detection', 'event_type', event_type, CAST(count(*) AS VARCHAR) FROM run_events GROUP BY event_type
UNION ALL SELECT 'detection', 'confidence', confidence, CAST(count(*) AS VARCHAR) FROM run_events GROUP BY confidence
UNION ALL SELECT 'verification', metric, NULL, CAST(n AS VARCHAR) FROM run_outcome
UNION ALL SELECT 'labels', 'rows', event_label, CAST(count(*) AS VARCHAR) FROM run_labeled GROUP BY event_label
UNION ALL SELECT 'labels', 'rows', '(labeled rows)', CAST(count(*) FILTER (event_label <> 'none') AS VARCHAR) FROM run_labeled
UNION ALL SELECT 'labels', 'percent', NULL, printf('%.2f', count(*) FILTER (event_label <> 'none') * 100.0 / count(*)) FROM run_labeled
UNION ALL SELECT 'export', 'rows', 'detected', CAST(count(*) AS VARCHAR) FROM run_events
UNION ALL SELECT 'export', 'rows', 'verified', CAST(count(*) AS VARCHAR) FROM run_checked
UNION ALL SELECT 'export', 'rows', 'labeled', CAST(count(*) AS VARCHAR) FROM panel
""")
