"""The queries again, as SQL for DuckDB over the same tables.

Written from the definitions, not from the Spark plans: windows where the
library aggregates, joins where it carries columns along.
"""

from __future__ import annotations

from knownwhen.sources import driver_tables as dt
from knownwhen.sources.schemas import raw_columns
from verification import queries as q

# Fixed values, stated here once more, so that a wrong one in the library shows.
SCALE_BANDS = [(0.99e-3, 1.01e-3), (0.99e-2, 1.01e-2), (0.99e-1, 1.01e-1),
               (9.9, 10.1), (99.0, 101.0), (990.0, 1010.0)]
FORMS = "('10-K', '10-K/A', '10-Q', '10-Q/A', '10-KT', '10-KT/A', '10-QT', '10-QT/A')"
ACCESSION = "^[0-9]{10}-[0-9]{2}-[0-9]{6}$"
BINS = [("(0, 0.01]", 0, 0.01), ("(0.01, 1]", 0.01, 1), ("(1, 5]", 1, 5), ("(5, 25]", 5, 25),
        ("(25, 100]", 25, 100), ("(100, 1000]", 100, 1000), ("(1000, 1e+12]", 1000, 1e12)]
CURATED_TAGS = [
    ("Revenues", "REVENUE", "IS", "TAXONOMY_MIGRATION", "HIGH"),
    ("RevenueFromContractWithCustomerExcludingAssessedTax", "REVENUE", "IS",
     "TAXONOMY_MIGRATION", "HIGH"),
    ("SalesRevenueNet", "REVENUE", "IS", "TAXONOMY_MIGRATION", "HIGH"),
    ("SalesRevenueGoodsNet", "REVENUE", "IS", "TAXONOMY_MIGRATION", "MEDIUM"),
    ("CostOfRevenue", "COST_OF_REVENUE", "IS", "TAXONOMY_MIGRATION", "HIGH"),
    ("CostOfGoodsAndServicesSold", "COST_OF_REVENUE", "IS", "TAXONOMY_MIGRATION", "HIGH"),
    ("CostOfGoodsSold", "COST_OF_REVENUE", "IS", "TAXONOMY_MIGRATION", "MEDIUM"),
    ("CostsAndExpenses", "TOTAL_COSTS", "IS", "MANUAL", "HIGH"),
    ("NetIncomeLoss", "NET_INCOME", "IS", "SELF", "HIGH"),
    ("ProfitLoss", "NET_INCOME_INCL_NCI", "IS", "MANUAL", "HIGH"),
    ("CashAndCashEquivalentsAtCarryingValue", "CASH", "BS", "SELF", "HIGH"),
    ("Cash", "CASH", "BS", "MANUAL", "MEDIUM"),
    ("CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents", "CASH_INCL_RESTRICTED",
     "BS", "MANUAL", "HIGH")]
WORDS = [
    ("BS", "assets|liabilities|stockholdersequity|goodwill|inventory|propertyplant|"
           "accountspayable|accountsreceivable|retainedearnings|commonstock|preferredstock|"
           "additionalpaidin|accumulatedother|deposits"),
    ("CF", "netcashprovided|paymentsto|proceedsfrom|increasedecreasein|depreciation|"
           "sharebasedcompensation|repaymentsof"),
    ("EPS", "earningspershare|perbasicshare|perdilutedshare|parorstatedvalue")]

OPEN = "TIMESTAMP '9999-12-31 00:00:00'"
KEY = "cik, canonical_tag, ddate, qtrs, uom"
SNAP_KEY = "cik, canonical_tag, ddate, qtrs"


def _double(x: float) -> str:
    text = repr(float(x))
    return text if "e" in text else f"{text}e0"


def _round(x: str, digits: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,8)), {digits}) AS DOUBLE)"


def _values(rows: list[tuple], names: str) -> str:
    quoted = ", ".join(
        "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {quoted}) AS t({names})"


_near = " OR ".join(
    f"factor BETWEEN {_double(low)} AND {_double(high)}" for low, high in SCALE_BANDS)

BLOCKS: dict[str, str] = {
    "filing": "SELECT o_orderkey AS adsh, o_custkey AS cik, o_orderdate AS accepted_ts, "
              "o_orderpriority AS form FROM orders",
    "cmap": _values(dt.CONCEPTS, "src_tag, canonical_tag, statement"),
    "line": """
        SELECT l_orderkey AS adsh, l_returnflag || l_linestatus AS src_tag,
               1 + l_linenumber % 2 AS years_back,
               CAST(CASE l_returnflag WHEN 'N' THEN 0 ELSE 4 END AS SMALLINT) AS qtrs,
               'USD' AS uom,
               CAST(CASE WHEN l_returnflag = 'N'  THEN 100 * l_quantity
                         WHEN l_discount >= 0.095e0 THEN -round(l_quantity / 5) * 10
                         WHEN l_discount <= 0.005e0 THEN round(l_quantity / 5) * 10000
                         WHEN l_tax < 0.005e0 THEN round(l_quantity / 5) * 10 + 0.01e0
                         ELSE round(l_quantity / 5) * 10 END AS DECIMAL(28,4)) AS value
        FROM lineitem""",
    "fact": """
        SELECT f.cik, m.canonical_tag,
               make_date(CAST(year(f.accepted_ts) - l.years_back AS INTEGER), 12, 31) AS ddate,
               l.qtrs, l.uom, l.value, l.adsh, f.form, f.accepted_ts, m.statement
        FROM line l JOIN cmap m USING (src_tag) JOIN filing f ON l.adsh = f.adsh""",
    "per_filing": f"""
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY {KEY}, adsh
                                       ORDER BY value DESC, statement DESC) AS rn FROM fact)
        WHERE rn = 1""",
    "per_instant": f"""
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY {KEY}, accepted_ts ORDER BY adsh DESC) AS rn
          FROM per_filing) WHERE rn = 1""",
    "change": f"""
        SELECT * FROM (
          SELECT *, lag(value) OVER (PARTITION BY {KEY} ORDER BY accepted_ts, adsh) AS prev_value
          FROM per_instant)
        WHERE prev_value IS NULL OR prev_value <> value""",
    "spell": f"""
        SELECT * EXCLUDE (prev_value, accepted_ts), accepted_ts AS known_from_ts,
               coalesce(lead(accepted_ts) OVER k, {OPEN}) AS known_to_ts,
               CAST(row_number() OVER k AS INTEGER) AS revision_seq,
               lag(value) OVER k AS prev_value
        FROM change WINDOW k AS (PARTITION BY {KEY} ORDER BY accepted_ts, adsh)""",
    "measured": """
        SELECT *, abs(a - b) / nullif(abs(b), 0) AS pct_change,
               nullif(abs(a / nullif(b, 0)), 0) AS factor,
               abs(abs(a) - abs(b)) / nullif(abs(b), 0) AS mag
        FROM (SELECT *, CAST(prev_value AS DOUBLE) AS b, CAST(value AS DOUBLE) AS a FROM spell)""",
    "pit": f"""
        SELECT {KEY}, value, known_from_ts, known_to_ts, known_to_ts = {OPEN} AS is_current,
               adsh AS source_adsh, form AS source_form, form LIKE '%/A' AS is_amendment,
               revision_seq, prev_value,
               CASE WHEN prev_value IS NULL THEN 'FIRST_REPORT'
                    WHEN {_near} THEN 'UNIT_SCALE'
                    WHEN pct_change < 0.005e0 THEN 'IMMATERIAL'
                    WHEN sign(a) * sign(b) < 0 AND mag < 0.02e0 THEN 'SIGN_FLIP'
                    ELSE 'RESTATEMENT' END AS change_class,
               pct_change, statement
        FROM measured""",
    "revision": f"""
        SELECT {KEY}, prev_value, value AS revised_value, pct_change,
               known_from_ts AS revised_at_ts, source_adsh, source_form, revision_seq, statement
        FROM pit WHERE change_class = 'RESTATEMENT'""",
    "cal": """
        SELECT CAST(last_day(s + INTERVAL 2 MONTH) AS DATE) AS rebalance_dt,
               CAST(last_day(s + INTERVAL 2 MONTH) AS TIMESTAMP) AS rebalance_ts
        FROM (SELECT unnest(generate_series(date_trunc('quarter', min(o_orderdate)),
                                            date_trunc('quarter', max(o_orderdate)),
                                            INTERVAL 3 MONTH)) AS s FROM orders)""",
    "grid": """
        SELECT c.rebalance_dt, p.* FROM pit p
        JOIN cal c ON p.known_from_ts <= c.rebalance_ts AND p.known_to_ts > c.rebalance_ts""",
    "factor_pit": f"""
        SELECT *, max(value) FILTER (is_current) OVER (PARTITION BY {KEY}) AS current_value
        FROM pit
        WHERE uom = 'USD' AND ((canonical_tag = 'NET_INCOME' AND qtrs = 4)
                               OR (canonical_tag = 'ASSETS' AND qtrs = 0))""",
    "inputs": """
        SELECT rebalance_dt, cik, max(ddate) FILTER (is_ni) AS ni_ddate,
               max(ddate) FILTER (NOT is_ni) AS assets_ddate,
               arg_max(value, ddate) FILTER (is_ni) AS pit_ni,
               arg_max(value, ddate) FILTER (NOT is_ni) AS pit_assets,
               arg_max(current_value, ddate) FILTER (is_ni) AS naive_ni,
               arg_max(current_value, ddate) FILTER (NOT is_ni) AS naive_assets
        FROM (SELECT c.rebalance_dt, p.*, canonical_tag = 'NET_INCOME' AS is_ni
              FROM factor_pit p JOIN cal c
                ON p.known_from_ts <= c.rebalance_ts AND p.known_to_ts > c.rebalance_ts
               AND p.ddate <= c.rebalance_dt
               AND p.ddate > CAST(c.rebalance_dt - INTERVAL 24 MONTH AS DATE))
        GROUP BY rebalance_dt, cik""",
    "roa": """
        SELECT *, CAST(pit_ni AS DOUBLE) / CAST(pit_assets AS DOUBLE) AS pit_roa,
               CAST(naive_ni AS DOUBLE) / CAST(naive_assets AS DOUBLE) AS naive_roa,
               naive_ni <> pit_ni AS ni_revised, naive_assets <> pit_assets AS assets_revised
        FROM inputs
        WHERE pit_ni IS NOT NULL AND naive_ni IS NOT NULL AND pit_assets > 0 AND naive_assets > 0""",
    "decile": """
        SELECT rebalance_dt, cik, pit_roa, naive_roa, pit_decile, naive_decile,
               pit_decile <> naive_decile AS decile_moved, ni_revised, assets_revised
        FROM (SELECT *,
                CAST(ntile(10) OVER (PARTITION BY rebalance_dt ORDER BY pit_roa DESC, cik)
                     AS INTEGER) AS pit_decile,
                CAST(ntile(10) OVER (PARTITION BY rebalance_dt ORDER BY naive_roa DESC, cik)
                     AS INTEGER) AS naive_decile
              FROM roa)""",
    "bias": f"""
        SELECT rebalance_dt, count(*) AS universe,
               {_round("100.0e0 * count(*) FILTER (decile_moved) / count(*)", 2)}
                 AS pct_decile_moved,
               {_round("100.0e0 * count(*) FILTER (ni_revised OR assets_revised) / count(*)", 2)}
                 AS pct_any_input_revised,
               {_round("100.0e0 * count(*) FILTER (naive_decile = 1 AND pit_decile <> 1) "
                       "/ nullif(count(*) FILTER (naive_decile = 1), 0)", 2)}
                 AS pct_top_decile_turnover
        FROM decile GROUP BY rebalance_dt""",
    "registrant": """
        SELECT o_custkey AS cik, o_orderdate AS accepted_ts, o_orderpriority AS name,
               o_orderstatus AS sic, CASE WHEN o_orderkey % 97 <> 0 THEN '1231' END AS fye
        FROM orders""",
    "company": f"""
        SELECT cik, name, sic, fye, accepted_ts AS valid_from_ts,
               coalesce(lead(accepted_ts) OVER c, {OPEN}) AS valid_to_ts,
               CAST(row_number() OVER c AS INTEGER) AS version_seq,
               lead(accepted_ts) OVER c IS NULL AS is_current
        FROM (SELECT *, lag(name) OVER c AS n0, lag(sic) OVER c AS s0, lag(fye) OVER c AS f0,
                     row_number() OVER c AS nth
              FROM (SELECT * FROM (
                      SELECT *, row_number() OVER (
                        PARTITION BY cik, accepted_ts ORDER BY name NULLS FIRST, sic NULLS FIRST,
                        fye NULLS FIRST) AS rn FROM registrant) WHERE rn = 1)
              WINDOW c AS (PARTITION BY cik ORDER BY accepted_ts))
        WHERE nth = 1 OR n0 IS DISTINCT FROM name OR s0 IS DISTINCT FROM sic
           OR f0 IS DISTINCT FROM fye
        WINDOW c AS (PARTITION BY cik ORDER BY accepted_ts)""",
    "raw_sub": """
        SELECT CASE WHEN o_orderkey % 199 = 0 THEN CAST(o_orderkey AS VARCHAR)
                    ELSE printf('%010d', o_orderkey) || '-00-'
                         || printf('%06d', o_orderkey % 1000000) END AS adsh,
               CASE WHEN o_orderkey % 211 = 0 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END AS cik,
               'Company "' || o_custkey || '"' AS name, o_orderstatus AS sic, '1231' AS fye,
               CASE o_orderpriority WHEN '1-URGENT' THEN '8-K' WHEN '2-HIGH' THEN '10-K/A'
                    WHEN '5-LOW' THEN '10-Q' ELSE '10-K' END AS form,
               CASE WHEN o_orderkey % 223 = 0 THEN '19xx0101'
                    WHEN o_orderkey % 227 = 0 THEN '20301231'
                    ELSE (year(o_orderdate) - 1) || '1231' END AS period,
               CAST(year(o_orderdate) - 1 AS VARCHAR) AS fy, 'FY' AS fp,
               strftime(o_orderdate, '%Y%m%d') AS filed,
               CASE WHEN o_orderkey % 229 = 0 THEN 'bad'
                    ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS accepted,
               CASE WHEN o_orderkey % 5 = 0 THEN '1' ELSE '0' END AS prevrpt, '1' AS detail,
               year(o_orderdate) || 'q' || quarter(o_orderdate) AS quarter
        FROM orders""",
    "raw_num": """
        SELECT CASE WHEN l_orderkey % 199 = 0 THEN CAST(l_orderkey AS VARCHAR)
                    ELSE printf('%010d', l_orderkey) || '-00-'
                         || printf('%06d', l_orderkey % 1000000) END AS adsh,
               l_returnflag || l_linestatus AS tag,
               CASE WHEN l_partkey % 31 = 0 THEN CAST(l_orderkey AS VARCHAR)
                    ELSE 'us-gaap/2024' END AS version,
               CASE WHEN l_suppkey % 23 = 0 AND l_partkey % 41 = 0 THEN '9999'
                    WHEN l_partkey % 43 = 0 THEN '19791231'
                    ELSE (year(o_orderdate) - 1 - l_linenumber % 2) || '1231' END AS ddate,
               CASE WHEN l_partkey % 29 = 0 THEN '2' WHEN l_returnflag = 'N' THEN '0'
                    ELSE '4' END AS qtrs,
               CASE WHEN l_partkey % 19 = 0 THEN 'EUR' ELSE 'USD' END AS uom,
               CASE l_partkey % 7 WHEN 0 THEN 'Seg=A' WHEN 1 THEN '  ' END AS segments,
               CASE WHEN l_partkey % 53 = 0 THEN 'Sub' END AS coreg,
               CASE WHEN l_partkey % 47 = 0 THEN 'abc'
                    WHEN l_partkey % 59 <> 0 THEN CAST(l_quantity AS VARCHAR) END AS value,
               CAST(NULL AS VARCHAR) AS footnote,
               year(o_orderdate) || 'q' || quarter(o_orderdate) AS quarter
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "raw_cmap": _values(dt.RAW_CONCEPTS, "src_tag, canonical_tag, statement"),
    "typed_sub": """
        SELECT *, CASE WHEN accepted_ts IS NULL THEN 'accepted_unparseable'
                       WHEN period_dt IS NULL THEN 'period_unparseable'
                       WHEN cik_n IS NULL THEN 'cik_null'
                       WHEN accepted_ts < CAST(period_dt AS TIMESTAMP) THEN 'accepted_before_period'
                  END AS _reject_reason
        FROM (SELECT *, try_strptime(accepted, '%Y-%m-%d %H:%M:%S') AS accepted_ts,
                     CAST(try_strptime(period, '%Y%m%d') AS DATE) AS period_dt,
                     CAST(try_strptime(filed, '%Y%m%d') AS DATE) AS filed_dt,
                     TRY_CAST(cik AS BIGINT) AS cik_n FROM raw_sub)""",
    "silver_sub": f"""
        SELECT adsh, cik_n AS cik, name, sic, form, form LIKE '%/A' AS is_amendment, period_dt,
               filed_dt, accepted_ts, TRY_CAST(fy AS INTEGER) AS fy, fp, fye,
               prevrpt = '1' AS prevrpt_flag, CAST(NULL AS VARCHAR) AS former,
               CAST(NULL AS VARCHAR) AS changed, detail, quarter
        FROM typed_sub WHERE _reject_reason IS NULL AND form IN {FORMS}""",
    "typed_num": """
        SELECT *, CASE WHEN ddate_dt IS NULL THEN 'ddate_unparseable'
                       WHEN value IS NOT NULL AND value_dec IS NULL THEN 'value_uncastable'
                       WHEN ddate_dt < DATE '1990-01-01' THEN 'ddate_implausible'
                  END AS _reject_reason
        FROM (SELECT *, CAST(try_strptime(ddate, '%Y%m%d') AS DATE) AS ddate_dt,
                     TRY_CAST(qtrs AS SMALLINT) AS qtrs_i,
                     TRY_CAST(value AS DECIMAL(28,4)) AS value_dec FROM raw_num)""",
    "outcome_num": """
        SELECT t.*, m.src_tag, m.canonical_tag, m.statement,
               CASE WHEN _reject_reason IS NOT NULL THEN _reject_reason
                    WHEN trim(coalesce(segments, '')) <> '' OR trim(coalesce(coreg, '')) <> ''
                      THEN 'segment'
                    WHEN uom IS DISTINCT FROM 'USD' THEN 'non_usd'
                    WHEN version IS NULL OR version NOT LIKE 'us-gaap%' THEN 'custom_tag'
                    WHEN qtrs_i IS NULL OR qtrs_i NOT IN (0, 1, 4) THEN 'qtrs'
                    WHEN value_dec IS NULL THEN 'null_value'
                    WHEN m.src_tag IS NULL THEN 'unmapped'
                    ELSE 'kept' END AS outcome
        FROM typed_num t LEFT JOIN raw_cmap m ON t.tag = m.src_tag""",
    "silver_num": """
        SELECT adsh, src_tag, canonical_tag, statement, ddate_dt AS ddate, qtrs_i AS qtrs, uom,
               value_dec AS value, version, footnote, quarter
        FROM outcome_num WHERE outcome = 'kept'""",
    "outcome_sub": f"""
        SELECT *, CASE WHEN _reject_reason IS NOT NULL THEN _reject_reason
                       WHEN form NOT IN {FORMS} THEN 'form'
                       ELSE 'kept' END AS outcome FROM typed_sub""",
    "tag_name": _values(list(dt.TAG_NAMES.items()), "code, tag"),
    "named": """
        SELECT r.* REPLACE (CASE WHEN r.ddate = '19791231' THEN 'RareTag' || substr(r.value, 1, 1)
                                 ELSE t.tag END AS tag)
        FROM raw_num r LEFT JOIN tag_name t ON r.tag = t.code""",
    "usable": """
        SELECT tag, adsh FROM named
        WHERE trim(coalesce(segments, '')) = '' AND trim(coalesce(coreg, '')) = ''
          AND uom = 'USD' AND version LIKE 'us-gaap%' AND value IS NOT NULL""",
    "candidate": """
        SELECT tag, count(DISTINCT adsh) AS filings FROM usable GROUP BY tag
        HAVING count(DISTINCT adsh) >= 0.05e0 * (SELECT count(DISTINCT adsh) FROM usable)""",
    "curated": _values(CURATED_TAGS,
                       "src_tag, canonical_tag, statement, mapping_method, confidence"),
    "full_map": "SELECT * FROM curated UNION ALL SELECT tag, tag, CASE "
                + " ".join(f"WHEN regexp_matches(lower(tag), '{words}') THEN '{name}'"
                           for name, words in WORDS)
                + " ELSE 'IS' END, 'SELF', 'HIGH' FROM candidate "
                  "WHERE tag NOT IN (SELECT src_tag FROM curated)",
    "quarter_link": """
        SELECT DISTINCT year(o_orderdate) || 'q' || quarter(o_orderdate) AS quarter FROM orders""",
    "control": """
        SELECT quarter, 'https://example.org/' || quarter || '.zip' AS zip_url,
               CASE WHEN quarter >= '1999' THEN 'PENDING'
                    ELSE CASE right(quarter, 1) WHEN '1' THEN 'DONE' WHEN '2' THEN 'PENDING'
                         WHEN '3' THEN 'FAILED' ELSE 'RUNNING' END END AS status,
               CASE WHEN quarter >= '1999' THEN 0 ELSE 1 END AS attempts,
               CAST(NULL AS VARCHAR) AS last_error,
               CASE WHEN quarter >= '1999' THEN TIMESTAMP '2025-01-01 00:00:00'
                    ELSE TIMESTAMP '2024-01-01 00:00:00' END AS discovered_at
        FROM quarter_link""",
    "snap_a": "",
    "snap_b": "",
    "diff": """
        SELECT a.cik, a.canonical_tag, a.ddate, a.qtrs, a.value AS value_a, a.adsh AS adsh_a,
               a.accepted_ts AS accepted_ts_a, b.value AS value_b, b.adsh AS adsh_b,
               b.accepted_ts AS accepted_ts_b, b.value - a.value AS delta,
               abs(CAST(b.value AS DOUBLE) - CAST(a.value AS DOUBLE))
                 / nullif(abs(CAST(a.value AS DOUBLE)), 0) * 100 AS pct,
               abs(CAST(b.value AS DOUBLE) / nullif(CAST(a.value AS DOUBLE), 0)) AS factor
        FROM snap_a a JOIN snap_b b ON a.cik = b.cik AND a.canonical_tag = b.canonical_tag
         AND a.ddate = b.ddate AND a.qtrs = b.qtrs""",
}
for _name, _year in (("snap_a", 1997), ("snap_b", 1998)):
    BLOCKS[_name] = f"""
        SELECT {SNAP_KEY}, value, adsh, accepted_ts FROM (
          SELECT *, row_number() OVER (PARTITION BY {SNAP_KEY}
                                       ORDER BY accepted_ts DESC, adsh DESC, value DESC) AS rn
          FROM told WHERE year(accepted_ts) = {_year}) WHERE rn = 1"""
BLOCKS["told"] = """
    SELECT s.cik_n AS cik, m.canonical_tag, n.ddate_dt AS ddate, n.qtrs_i AS qtrs,
           n.value_dec AS value, n.adsh, s.accepted_ts
    FROM typed_num n JOIN raw_cmap m ON n.tag = m.src_tag JOIN typed_sub s ON n.adsh = s.adsh
    WHERE n._reject_reason IS NULL AND trim(coalesce(segments, '')) = ''
      AND trim(coalesce(coreg, '')) = '' AND version LIKE 'us-gaap%' AND uom = 'USD'
      AND value_dec IS NOT NULL AND s.cik_n IS NOT NULL AND s.accepted_ts IS NOT NULL"""

_FACT = ["filing", "cmap", "line", "fact"]
_PIT = [*_FACT, "per_filing", "per_instant", "change", "spell", "measured", "pit"]
_ROA = [*_PIT, "cal", "factor_pit", "inputs"]
_DEC = [*_ROA, "roa", "decile"]
_NUM = ["raw_num", "raw_cmap", "typed_num", "outcome_num", "silver_num"]
_SUB = ["raw_sub", "typed_sub", "silver_sub"]
_MAP = ["raw_num", "tag_name", "named", "usable", "candidate", "curated", "full_map"]
_TOLD = ["raw_num", "raw_cmap", "typed_num", "raw_sub", "typed_sub", "told"]
_DIFF = [*_TOLD, "snap_a", "snap_b", "diff"]


def _sql(blocks: list[str], select: str, **instead: str) -> str:
    """``instead`` gives other SQL for some of the blocks."""
    if not blocks:
        return select
    return "WITH " + ",\n".join(
        f"{b} AS ({instead.get(b, BLOCKS.get(b, ''))})" for b in blocks) + "\n" + select


def _guess(tag: str) -> str:
    return "CASE " + " ".join(
        f"WHEN regexp_matches(lower({tag}), '{words}') THEN '{name}'" for name, words in WORDS
    ) + " ELSE 'IS' END"


def _chi(n: str, b: str, n0: str, b0: str) -> str:
    """Chi-square of two rates."""
    n, b, n0, b0 = (f"({x})::DOUBLE" for x in (n, b, n0, b0))
    return (f"CASE WHEN {n0} IS NULL THEN NULL ELSE coalesce("
            f"({b} * {n0} - {b0} * {n}) * ({b} * {n0} - {b0} * {n}) * ({n} + {n0}) "
            f"/ nullif({n} * {n0} * ({b} + {b0}) * (({n} + {n0}) - ({b} + {b0})), 0e0), 0e0) END")


_RUNS = " UNION ALL ".join(
    f"SELECT quarter AS run, '{rule}' AS rule, count(*) AS \"rows\", "
    f"count(*) FILTER (NOT coalesce({ok}, false)) AS breaches FROM typed_num GROUP BY quarter"
    for rule, ok in {
        "ddate_not_null": "ddate_dt IS NOT NULL",
        "ddate_plausible": "ddate_dt >= DATE '1990-01-01'",
        "value_castable": "value IS NULL OR value_dec IS NOT NULL",
        "value_not_null": "value_dec IS NOT NULL",
        "qtrs_valid": "qtrs_i IN (0, 1, 4)",
        "reported_before_1995": "ddate_dt < DATE '1995-01-01'"}.items())
BLOCKS["placed_line"] = """
    SELECT DISTINCT adsh, tag, trim(unnest(CASE right(adsh, 1)
        WHEN '1' THEN ['BS'] WHEN '2' THEN [usual, 'EQ'] WHEN '3' THEN [' '] ELSE [usual] END)) AS stmt
    FROM (SELECT DISTINCT adsh, tag, CASE WHEN tag LIKE 'Assets%' THEN 'BS'
                 WHEN tag LIKE 'Proceeds%' THEN 'CF' ELSE 'IS' END AS usual FROM named)"""
BLOCKS["tag_vote"] = """
    SELECT tag, stmt AS statement, votes, votes / (sum(votes) OVER (PARTITION BY tag))::DOUBLE AS share
    FROM (SELECT l.tag, l.stmt, CAST(sum(n) AS BIGINT) AS votes FROM placed_line l
          JOIN (SELECT adsh, tag, count(*) AS n FROM named GROUP BY adsh, tag) f
            ON f.adsh = l.adsh AND f.tag = l.tag WHERE l.stmt <> '' GROUP BY l.tag, l.stmt)
    QUALIFY row_number() OVER (PARTITION BY tag ORDER BY votes DESC, stmt) = 1"""

# The gold tables as they follow from the silver ones.
_FROM_SILVER = dict(
    fact="""SELECT s.cik, n.canonical_tag, n.ddate, n.qtrs, n.uom, n.value, n.adsh, s.form,
                   s.accepted_ts, n.statement
            FROM silver_num n JOIN silver_sub s ON n.adsh = s.adsh""",
    registrant="SELECT cik, accepted_ts, name, sic, fye FROM silver_sub",
    cal=BLOCKS["cal"].replace("o_orderdate", "accepted_ts").replace("orders", "silver_sub"))


def _published() -> str:
    """Rows of every table, with the breaches of each rule that only warns."""
    plain = ["sub_quarantine", "num_quarantine", "concept_map", "exclusions", "fact_revision",
             "dim_company_scd2", "dim_concept", "dim_rebalance_date", "fact_roa_comparison",
             "fact_roa_ranked", "agg_bias_by_quarter"]
    source = {
        "sub_raw": "raw_sub", "num_raw": "raw_num", "tag_raw": _TAGS, "pre_raw": _PRES,
        "sub": "silver_sub", "num": "silver_num",
        "sub_quarantine": "(SELECT * FROM typed_sub WHERE _reject_reason IS NOT NULL)",
        "num_quarantine": "(SELECT * FROM typed_num WHERE _reject_reason IS NOT NULL)",
        "concept_map": "raw_cmap", "exclusions": "(SELECT DISTINCT outcome FROM outcome_num)",
        "fact_fundamental_pit": "pit", "fact_revision": "revision", "dim_company_scd2": "company",
        "dim_concept": "(SELECT DISTINCT canonical_tag, statement FROM raw_cmap)",
        "dim_rebalance_date": "cal", "fact_roa_comparison": "roa", "fact_roa_ranked": "decile",
        "agg_bias_by_quarter": "bias"}
    rules = [
        ("sub_raw", "adsh_not_null", "adsh IS NOT NULL"),
        ("num_raw", "adsh_not_null", "adsh IS NOT NULL"),
        ("tag_raw", "tag_not_null", "tag IS NOT NULL"),
        ("pre_raw", "adsh_not_null", "adsh IS NOT NULL"),
        ("sub", "adsh_well_formed", _WELL_FORMED), ("num", "value_not_null", "value IS NOT NULL"),
        ("num", "qtrs_valid", "qtrs IN (0, 1, 4)"),
        ("fact_fundamental_pit", "revision_seq_positive", "revision_seq >= 1")]
    counted = [f"SELECT '{t}' AS \"table\", count(*) AS \"rows\", '{r}' AS rule, "
               f"count(*) FILTER (NOT coalesce({ok}, false)) AS breaches FROM {source[t]}"
               for t, r, ok in rules]
    counted += [f"SELECT '{t}', count(*), NULL, NULL FROM {source[t]}" for t in plain]
    return " UNION ALL ".join(counted)


def _check(name: str, violation: str, rows: str) -> str:
    return (f"SELECT '{name}' AS \"check\", count(*) FILTER ({violation}) AS violations, "
            f"count(*) AS checked FROM ({rows})")


_NEXT = (f"SELECT known_to_ts, lead(known_from_ts) OVER (PARTITION BY {KEY} "
         "ORDER BY known_from_ts, known_to_ts) AS next_from FROM pit")
_CHECKS = {
    "inv_i1_no_overlap": _check("I1_no_overlap", "next_from < known_to_ts", _NEXT),
    "inv_i2_one_open": _check(
        "I2_one_open", "n <> 1", "SELECT sum(CASE WHEN is_current THEN 1 ELSE 0 END) AS n "
        f"FROM pit GROUP BY {KEY}"),
    "inv_i3_no_gap": _check("I3_no_gap", "next_from <> known_to_ts", _NEXT),
    "inv_i4_source_match": _check(
        "I4_source_match", "known_from_ts <> accepted_ts",
        "SELECT known_from_ts, accepted_ts FROM pit JOIN filing ON source_adsh = adsh"),
    "inv_i4b_zero_width": _check(
        "I4b_zero_width", "known_from_ts >= known_to_ts", "SELECT * FROM pit"),
    "inv_i6_seq_contiguous": _check(
        "I6_seq_contiguous", "mx <> n",
        f"SELECT max(revision_seq) AS mx, count(*) AS n FROM pit GROUP BY {KEY}"),
}

_CHANGED = "coalesce(pct > 1, false)"
_RATE = ("count(*) AS n, "
         + _round(f"100.0e0 * count(*) FILTER ({_CHANGED}) / count(*)", 1) + " AS chg_pct")


def _digests(kind: str, source: str) -> str:
    fields = ", ".join(f"coalesce({c}, '~')" for c in raw_columns(kind))
    return (f"SELECT '{kind}' AS kind, quarter, md5(concat_ws('|', {fields}, '~')) AS fields "
            f"FROM {source}")


_TAGS = """(SELECT DISTINCT tag, quarter,
    CASE WHEN version LIKE 'us-gaap%' THEN 'us-gaap/2024' ELSE 'filer' END AS version,
    CASE WHEN version LIKE 'us-gaap%' THEN '0' ELSE '1' END AS custom, '0' AS abstract,
    'monetary' AS datatype, CASE WHEN tag LIKE 'N%' THEN 'I' ELSE 'D' END AS iord,
    CAST(NULL AS VARCHAR) AS crdr, 'Label ' || tag AS tlabel, CAST(NULL AS VARCHAR) AS doc
    FROM raw_num)"""
_PRES = """(SELECT DISTINCT adsh, tag, version, quarter, '1' AS report, '1' AS line,
    CASE WHEN tag LIKE 'N%' THEN 'BS' ELSE 'IS' END AS stmt, '0' AS inpth, 'H' AS rfile,
    'As "shown": ' || tag AS plabel, '0' AS negating FROM raw_num)"""
_SUBS = "(SELECT *, " + ", ".join(
    f"CAST(NULL AS VARCHAR) AS {c}" for c in raw_columns("sub")
    if c not in ("adsh", "cik", "name", "sic", "fye", "form", "period", "fy", "fp", "filed",
                 "accepted", "prevrpt", "detail")) + " FROM raw_sub)"


def _rates(table: str, source: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{rule}' AS rule, count(*) AS \"rows\", "
        f"count(*) FILTER (NOT coalesce({ok}, false)) AS breaches, "
        f"CAST(count(*) FILTER (NOT coalesce({ok}, false)) AS DOUBLE) / count(*) AS rate "
        f"FROM {source}" for rule, ok in rules.items())


_WELL_FORMED = f"regexp_matches(adsh, '{ACCESSION}')"


def _reconcile(table: str, bronze: str, silver_rows: str, broken: str, outcomes: str,
               breaks: tuple[str, ...]) -> str:
    return (f"SELECT *, bronze = silver + quarantine + excluded AS reconciles FROM ("
            f"SELECT '{table}' AS \"table\", (SELECT count(*) FROM {bronze}) AS bronze, "
            f"(SELECT count(*) FROM {silver_rows}) AS silver, "
            f"(SELECT count(*) FROM {broken} WHERE _reject_reason IS NOT NULL) AS quarantine, "
            f"(SELECT count(*) FROM {outcomes} WHERE outcome <> 'kept' "
            f"AND outcome NOT IN {breaks}) AS excluded)")


_BINS = " ".join(f"WHEN pct > {_double(lo)} AND pct <= {_double(hi)} THEN '{label}'"
                 for label, lo, hi in BINS)
_ARTEFACTS = " UNION ALL ".join(
    f"SELECT '{name}' AS artefact, count(*) AS n FROM diff WHERE {rule}" for name, rule in [
        ("identical", "factor > 0.999e0 AND factor < 1.001e0"),
        *[(f"scale_1e{k}", f"factor > {_double(10.0 ** k * 0.99)} "
                           f"AND factor < {_double(10.0 ** k * 1.01)}")
          for k in (-3, -2, -1, 1, 2, 3)],
        ("sign_flip", "sign(value_a) <> sign(value_b)")])
_BUCKETS = {
    "large_pct_nonrevenue": "pct > 15 AND canonical_tag <> 'REVENUE' AND abs(value_a) > 40",
    "small_material": "pct BETWEEN 1 AND 5 AND abs(value_a) > 1000",
    "sign_flip": "sign(value_a) <> sign(value_b)",
    "balance_sheet": "qtrs = 0 AND pct > 10 AND abs(value_a) > 1000",
}

ORACLES: dict[str, str] = {
    "fact_filing_join": _sql(
        ["filing", "line"], "SELECT l.adsh, src_tag, qtrs, uom, value, cik, accepted_ts, form "
        "FROM line l JOIN filing f ON l.adsh = f.adsh"),
    "concept_map_apply": _sql(
        ["cmap", "line"], "SELECT adsh, src_tag, canonical_tag, statement, qtrs, value "
        "FROM line JOIN cmap USING (src_tag)"),
    "dedup_per_filing": _sql([*_FACT, "per_filing"], "SELECT * FROM per_filing"),
    "dedup_per_instant": _sql([*_FACT, "per_filing", "per_instant"], "SELECT * FROM per_instant"),
    "change_points": _sql(
        [*_FACT, "per_filing", "per_instant", "change"],
        f"SELECT {KEY}, accepted_ts, adsh, value, prev_value FROM change"),
    "knowledge_intervals": _sql(_PIT, "SELECT * FROM pit"),
    "publish_roundtrip": _sql(_PIT, "SELECT * FROM pit"),
    "layout_curve": _sql(_PIT, " UNION ALL ".join(
        f"SELECT '{c}' AS ranged_by, canonical_tag, count(*) AS n, sum(value) AS total, "
        f"min(known_from_ts) AS first_known FROM pit WHERE {c} BETWEEN '{a}' AND '{b}' GROUP BY ALL"
        for c, (a, b) in q.RANGES.items())),
    "revision_class": _sql(
        _PIT, "SELECT canonical_tag, change_class, count(*) AS n, min(pct_change) AS min_pct, "
        "max(pct_change) AS max_pct FROM pit GROUP BY ALL"),
    "fact_revision": _sql([*_PIT, "revision"], "SELECT * FROM revision"),
    "fundamental_as_of": _sql(
        _PIT, f"SELECT {KEY}, value, known_from_ts, source_adsh, revision_seq FROM pit "
        f"WHERE known_from_ts <= TIMESTAMP '{q.AS_OF}' AND known_to_ts > TIMESTAMP '{q.AS_OF}'"),
    "asof_grid": _sql([*_PIT, "cal", "grid"],
                      f"SELECT rebalance_dt, {KEY}, value, revision_seq FROM grid"),
    "scd2_build": _sql(["registrant", "company"], "SELECT * FROM company"),
    "concept_candidates": _sql(_MAP[:5], "SELECT * FROM candidate"),
    "concept_statement_vote": _sql(
        [*_MAP[:3], "placed_line", "tag_vote"], f"""
        SELECT tag, statement, votes, share, guessed, statement = guessed AS agrees
        FROM (SELECT *, {_guess('tag')} AS guessed FROM tag_vote)"""),
    "concept_map_placed": _sql(
        [*_MAP, "placed_line", "tag_vote"], """
        SELECT src_tag, canonical_tag, mapping_method,
               CASE WHEN mapping_method = 'SELF' AND canonical_tag = src_tag AND v.share > 0.5e0
                    THEN v.statement ELSE m.statement END AS statement
        FROM full_map m LEFT JOIN tag_vote v ON v.tag = m.src_tag"""),
    "concept_map_build": _sql(_MAP, "SELECT * FROM full_map"),
    "dim_concept": _sql(
        _MAP, "SELECT canonical_tag, statement, count(*) AS n_source_tags, "
        "string_agg(DISTINCT src_tag, ',' ORDER BY src_tag) AS source_tags, "
        "max(mapping_method) AS mapping_method, min(confidence) AS min_confidence, "
        "CASE min(CASE confidence WHEN 'LOW' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END) "
        "WHEN 1 THEN 'LOW' WHEN 2 THEN 'MEDIUM' ELSE 'HIGH' END AS weakest_confidence "
        "FROM full_map GROUP BY canonical_tag, statement"),
    "concept_lineage": _sql(
        _MAP, "SELECT canonical_tag, count(*) AS n_source_tags, "
        "string_agg(src_tag, ',' ORDER BY src_tag) AS tags, "
        "CAST(coalesce(sum(facts), 0) AS BIGINT) AS facts FROM full_map LEFT JOIN "
        "(SELECT tag, count(*) AS facts FROM named GROUP BY tag) ON src_tag = tag "
        "WHERE mapping_method <> 'SELF' GROUP BY canonical_tag"),
    "concept_coverage": _sql(
        ["raw_num", "raw_cmap"], f"""
        SELECT canonical_tag, filings, filings_best_tag, filings_mapped,
               {_round("100.0e0 * filings_best_tag / filings", 2)} AS pct_best_tag,
               {_round("100.0e0 * filings_mapped / filings", 2)} AS pct_mapped
        FROM (SELECT canonical_tag, count(DISTINCT adsh) AS filings_mapped
              FROM raw_num JOIN raw_cmap ON tag = src_tag GROUP BY 1)
        JOIN (SELECT canonical_tag, max(n) AS filings_best_tag FROM (
                SELECT canonical_tag, src_tag, count(DISTINCT adsh) AS n
                FROM raw_num JOIN raw_cmap ON tag = src_tag GROUP BY 1, 2) GROUP BY 1)
          USING (canonical_tag),
        (SELECT count(DISTINCT adsh) AS filings FROM raw_num)"""),
    "rebalance_calendar": _sql(["cal"], "SELECT * FROM cal"),
    "factor_input_asof": _sql(_ROA, "SELECT * FROM inputs"),
    "roa_comparison": _sql([*_ROA, "roa"], "SELECT * FROM roa"),
    "roa_deciles": _sql(_DEC, "SELECT * FROM decile"),
    "bias_by_quarter": _sql([*_DEC, "bias"], "SELECT * FROM bias"),
    "bias_window": _sql(
        [*_DEC, "bias"], "SELECT rebalance_dt, pct_decile_moved, pct_top_decile_turnover, "
        f"pct_any_input_revised FROM bias WHERE rebalance_dt < DATE '{q.CENSOR_FROM}' "
        "ORDER BY rebalance_dt"),
    "coverage_by_quarter": _sql(
        _NUM, "SELECT quarter, count(DISTINCT adsh) AS filings, count(*) AS facts "
        "FROM silver_num GROUP BY quarter"),
    "fact_explorer": _sql(
        _PIT, "SELECT cik, ddate, value, known_from_ts, known_to_ts, revision_seq, change_class, "
        + _round("pct_change * 100", 2) + " AS pct FROM pit WHERE canonical_tag = 'NET_INCOME' "
        "AND qtrs = 4"),
    "restatement_monitor": _sql(
        [*_PIT, "revision", "registrant", "company"], f"""
        SELECT c.name AS company, r.canonical_tag, r.ddate, r.qtrs, r.prev_value,
               r.revised_value, {_round("r.pct_change * 100", 1)} AS pct_change, r.revised_at_ts,
               r.source_form
        FROM revision r LEFT JOIN company c ON r.cik = c.cik AND c.is_current
        WHERE abs(r.prev_value) > {q.MONITOR_ABOVE}
        ORDER BY abs(r.pct_change) DESC, r.cik, r.canonical_tag, r.ddate, r.qtrs, r.uom,
                 r.revised_at_ts LIMIT 200"""),
    **{name: _sql(_PIT, select) for name, select in _CHECKS.items()},
    "invariant_report": _sql(
        _PIT, "SELECT *, violations = 0 AS passed FROM ("
        + " UNION ALL ".join(f"({s})" for s in _CHECKS.values()) + ")"),
    "key_sample": _sql(
        _PIT, f"""
        SELECT {KEY}, value, known_from_ts, known_to_ts FROM pit JOIN (
          SELECT DISTINCT {KEY}, md5(concat_ws('|', cik, canonical_tag, ddate, qtrs, uom,
                                               '{q.SEED}')) AS spot
          FROM pit WHERE revision_seq > 1 ORDER BY spot, {KEY} LIMIT 300) USING ({KEY})"""),
    # No difference is what the check must find: its zeros are the query's own claim.
    "equivalence_check": _sql(
        _PIT, f"""
        SELECT count(*) AS keys_built, count(*) AS keys_rebuilt, count(*) AS keys_in_both,
               CAST(0 AS BIGINT) AS keys_only_built, CAST(0 AS BIGINT) AS keys_only_rebuilt,
               CAST(0 AS BIGINT) AS keys_differing, CAST(sum(n) AS BIGINT) AS intervals
        FROM (SELECT count(*) AS n FROM pit GROUP BY {KEY})"""),
    "bronze_read": _sql(
        ["raw_sub", "raw_num"], " UNION ALL ".join([
            _digests("sub", _SUBS), _digests("num", "raw_num"), _digests("tag", _TAGS),
            _digests("pre", _PRES)])),
    "bronze_rescue": _sql(
        ["raw_num"], """
        SELECT quarter, count(*) AS "rows", count(*) FILTER (d IN ('3', '7')) AS rescued,
               count(*) FILTER (d = '3') AS too_long,
               count(*) FILTER (d NOT IN ('3', '7') AND value IS NOT NULL) AS sound_values
        FROM (SELECT *, right(split_part(adsh, '-', 1), 1) AS d FROM raw_num) GROUP BY quarter"""),
    # Both flags must be set on every row; the query's own tests set them.
    "bronze_provenance": _sql(
        ["raw_sub"], "SELECT adsh, quarter, true AS has_time, true AS has_file FROM raw_sub"),
    "bronze_stream": _sql(
        ["raw_sub", "raw_num"], """
        SELECT 'sub' AS kind, quarter, count(*) AS "rows", count(DISTINCT adsh) AS filings
        FROM raw_sub GROUP BY quarter UNION ALL
        SELECT 'num', quarter, count(*), count(DISTINCT adsh) FROM raw_num GROUP BY quarter"""),
    "silver_stream": _sql(_NUM, "SELECT * EXCLUDE (footnote) FROM silver_num"),
    "submission_stream": _sql(
        _SUB, "SELECT adsh, cik, form, CAST(NULL AS VARCHAR) AS reason, quarter FROM silver_sub "
        "UNION ALL SELECT adsh, cik_n, form, _reject_reason, quarter FROM typed_sub "
        "WHERE _reject_reason IS NOT NULL"),
    "publish_all": _sql(
        [*_NUM, *_SUB, *_PIT[3:], "revision", "registrant", "company", "cal", "factor_pit",
         "inputs", "roa", "decile", "bias"], _published(), **_FROM_SILVER),
    "header_profile": _sql(
        ["raw_sub", "raw_num"], " UNION ALL ".join(
            f"SELECT DISTINCT '{kind}' AS kind, quarter, '{','.join(raw_columns(kind))}' "
            f"AS columns FROM raw_{kind}" for kind in ("sub", "num"))),
    "full_refresh": _sql(
        _NUM, "SELECT canonical_tag, count(*) AS facts, CAST(sum(value) AS DECIMAL(38,4)) AS total "
        "FROM silver_num GROUP BY canonical_tag"),
    "raw_manifest": _sql(
        ["raw_sub", "raw_num"], "SELECT quarter, sub_rows, num_rows FROM (SELECT quarter, "
        "count(*) AS sub_rows FROM raw_sub GROUP BY 1) FULL JOIN (SELECT quarter, "
        "count(*) AS num_rows FROM raw_num GROUP BY 1) USING (quarter)"),
    "column_profile": _sql(["raw_num"], " UNION ALL ".join(
        f"SELECT quarter, count(*) AS \"rows\", '{c}' AS \"column\", count({c}) AS filled, "
        f"CAST(count({c}) AS DOUBLE) / count(*) AS populated FROM raw_num GROUP BY quarter"
        for c in raw_columns("num"))),
    "silver_sub": _sql(_SUB, "SELECT * FROM silver_sub"),
    "silver_num": _sql(_NUM, "SELECT * FROM silver_num"),
    "quarantine_route": _sql(
        ["raw_num", "typed_num", "raw_sub", "typed_sub"], """
        SELECT 'num' AS "table", adsh, _reject_reason, quarter FROM typed_num
        WHERE _reject_reason IS NOT NULL UNION ALL
        SELECT 'sub', adsh, _reject_reason, quarter FROM typed_sub
        WHERE _reject_reason IS NOT NULL"""),
    "exclusion_funnel": _sql(
        _NUM[:4], 'SELECT outcome, count(*) AS "rows" FROM outcome_num GROUP BY outcome'),
    "reconcile_layers": _sql(
        [*_NUM, *_SUB, "outcome_sub"],
        _reconcile("num", "raw_num", "silver_num", "typed_num", "outcome_num",
                   ("ddate_unparseable", "value_uncastable", "ddate_implausible"))
        + " UNION ALL " + _reconcile(
            "sub", "raw_sub", "silver_sub", "typed_sub", "outcome_sub",
            ("accepted_unparseable", "period_unparseable", "cik_null",
             "accepted_before_period"))),
    "quality_rates": _sql(
        ["raw_num", "typed_num", "raw_sub", "typed_sub"],
        _rates("num", "typed_num", {
            "ddate_not_null": "ddate_dt IS NOT NULL",
            "ddate_plausible": "ddate_dt >= DATE '1990-01-01'",
            "value_castable": "value IS NULL OR value_dec IS NOT NULL",
            "value_not_null": "value_dec IS NOT NULL",
            "qtrs_valid": "qtrs_i IN (0, 1, 4)"}) + " UNION ALL "
        + _rates("sub", "typed_sub", {
            "accepted_ts_not_null": "accepted_ts IS NOT NULL",
            "period_dt_not_null": "period_dt IS NOT NULL",
            "cik_not_null": "cik_n IS NOT NULL",
            "accepted_after_period": "accepted_ts >= CAST(period_dt AS TIMESTAMP)",
            "adsh_well_formed": _WELL_FORMED})),
    "quality_jumps": _sql(
        ["raw_num", "typed_num"], f"""
        SELECT run, rule, "rows", breaches, breaches / "rows"::DOUBLE AS rate,
               b0 / n0::DOUBLE AS earlier_rate, chi AS chi_square,
               coalesce(chi >= 10.83e0 AND abs(breaches / "rows"::DOUBLE - b0 / n0::DOUBLE)
                        >= (b0 / n0::DOUBLE) * 0.25e0, false) AS jumped
        FROM (SELECT *, {_chi('"rows"', "breaches", "n0", "b0")} AS chi FROM (
          SELECT *, sum("rows") OVER w AS n0, sum(breaches) OVER w AS b0 FROM ({_RUNS})
          WINDOW w AS (PARTITION BY rule ORDER BY run
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))"""),
    "quality_change_points": _sql(
        ["raw_num", "typed_num"], f"""
        SELECT rule, run, chi AS chi_square, b0 / n0::DOUBLE AS rate_before,
               b1 / n1::DOUBLE AS rate_after,
               chi >= 10.83e0 AND abs(b1 / n1::DOUBLE - b0 / n0::DOUBLE)
                   >= (b0 / n0::DOUBLE) * 0.25e0 AS changed
        FROM (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY chi DESC, run) AS nth FROM (
          SELECT *, {_chi("n1", "b1", "n0", "b0")} AS chi FROM (
            SELECT late.rule, late.run, sum(r."rows") FILTER (r.run < late.run) AS n0,
                   sum(r.breaches) FILTER (r.run < late.run) AS b0,
                   sum(r."rows") FILTER (r.run >= late.run) AS n1,
                   sum(r.breaches) FILTER (r.run >= late.run) AS b1
            FROM ({_RUNS}) late JOIN ({_RUNS}) r USING (rule) GROUP BY late.rule, late.run)
          WHERE n0 IS NOT NULL)) WHERE nth = 1"""),
    "expect_warn": _sql(
        [*_SUB, *_PIT], " UNION ALL ".join(
            f"SELECT '{table}' AS \"table\", '{rule}' AS rule, count(*) AS written, "
            f"count(*) AS \"rows\", count(*) FILTER (NOT coalesce({ok}, false)) AS breaches "
            f"FROM {source}" for table, source, rule, ok in (
                ("sub", "silver_sub", "adsh_well_formed", _WELL_FORMED),
                ("sub", "silver_sub", "fp_known", "fp IS NOT NULL"),
                ("fact_fundamental_pit", "pit", "revision_seq_positive", "revision_seq >= 1"),
                ("fact_fundamental_pit", "pit", "value_positive", "value > 0")))),
    "expect_fail": _sql(_SUB, "SELECT form, count(*) AS filings FROM silver_sub GROUP BY form"),
    "company_function": _sql(
        ["registrant", "company"], f"""
        SELECT t.cik, t.name, t.sic, t.fye, n.name AS name_now, n.version_seq AS versions
        FROM company t JOIN company n USING (cik)
        WHERE n.is_current AND t.valid_from_ts <= TIMESTAMP '{q.AS_OF}'
          AND t.valid_to_ts > TIMESTAMP '{q.AS_OF}'"""),
    "catalog_tables": _sql(
        [*_PIT, "revision", "quarter_link", "control"], " UNION ALL ".join(
            f"SELECT '{name}' AS name, '{layer}' AS layer, '{comment}' AS comment, "
            f"CAST(2 AS INTEGER) AS version, count(*) AS \"rows\" FROM {source}"
            for name, layer, comment, source in (
                ("fact_fundamental_pit", "gold", "Knowledge intervals per fact", "pit"),
                ("fact_revision", "gold", "Restatements", "revision"),
                ("ingest_control", "ops", "One row per quarter to fetch", "control")))),
    "table_digest": _sql(_PIT, f"""
        SELECT {KEY}, CAST(value + changed AS DECIMAL(28,4)) AS value, known_from_ts, known_to_ts,
               CAST(1 - changed AS BIGINT) AS in_a, CAST(changed AS BIGINT) AS in_b
        FROM pit, (VALUES (0), (1)) c(changed)
        WHERE cik % 70 = 1 AND revision_seq = 1
           OR cik % 50 = 0 AND revision_seq = 2 AND changed = 0"""),
    "distinct_filings": _sql(
        ["raw_num", "tag_name", "named", "usable"],
        "SELECT tag AS \"grouped\", count(DISTINCT adsh) AS items FROM usable GROUP BY tag "
        "UNION ALL SELECT 'all', count(DISTINCT adsh) FROM usable"),
    "stream_bounded": _sql(
        ["raw_num", "raw_cmap", "typed_num", "outcome_num"],
        "SELECT adsh, quarter, outcome FROM outcome_num WHERE outcome = 'kept' UNION ALL "
        "SELECT adsh, quarter, _reject_reason FROM outcome_num WHERE _reject_reason IS NOT NULL"),
    "bronze_header_route": _sql(["raw_num"], """
        SELECT quarter, count(*) AS "rows",
               CASE WHEN right(quarter, 1) <> '4' THEN count(*) FILTER (adsh LIKE '%-%') END
                 AS adshs,
               CASE WHEN right(quarter, 1) <> '4' THEN count(value) END AS "values",
               CASE right(quarter, 1) WHEN '4' THEN NULL WHEN '3' THEN count(segments) ELSE 0 END
                 AS rescued,
               CASE WHEN right(quarter, 1) = '4' THEN 'missing_column' END AS reason
        FROM raw_num GROUP BY quarter"""),
    "control_merge": _sql(["quarter_link", "control"], "SELECT * FROM control"),
    "control_transition": _sql(
        ["quarter_link", "control"], """
        SELECT quarter,
               CASE WHEN status = 'DONE' OR right(quarter, 1) IN ('1', '2') THEN 'DONE'
                    WHEN right(quarter, 1) = '3' THEN 'FAILED' ELSE 'RUNNING' END AS status,
               CAST(CASE WHEN status = 'DONE' THEN attempts ELSE attempts + 1 END AS INTEGER)
                 AS attempts,
               CASE WHEN moved THEN n * 100 END AS bytes_downloaded,
               CAST(CASE WHEN moved THEN 1 END AS INTEGER) AS files_extracted,
               CASE WHEN moved THEN n END AS sub_rows,
               CASE WHEN status <> 'DONE' AND right(quarter, 1) = '3'
                    THEN substr('cant read ' || repeat('x', 1000), 1, 900) END AS last_error,
               CASE WHEN moved THEN TIMESTAMP '2025-02-01 00:00:00' END AS completed_at
        FROM (SELECT *, status <> 'DONE' AND right(quarter, 1) IN ('1', '2') AS moved FROM control)
        JOIN (SELECT year(o_orderdate) || 'q' || quarter(o_orderdate) AS quarter, count(*) AS n
              FROM orders GROUP BY 1) USING (quarter)"""),
    "control_status": _sql(
        ["quarter_link", "control"], "SELECT status, count(*) AS n, "
        "CASE WHEN status <> 'DONE' THEN string_agg(quarter, ',' ORDER BY quarter) END AS pending "
        "FROM control GROUP BY status"),
    "link_discovery": """
        SELECT regexp_extract(zip_url, '([a-z]+)$', 1) AS quarter, zip_url FROM (
          SELECT DISTINCT CASE WHEN h LIKE 'http%' THEN h ELSE 'https://example.org' || h END
                 AS zip_url
          FROM (SELECT unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS h FROM pages))
        WHERE regexp_extract(zip_url, '([a-z]+)$', 1) <> ''""",
    "snapshot_resolve": _sql([*_TOLD, "snap_b"], "SELECT * FROM snap_b"),
    "snapshot_diff": _sql(_DIFF, "SELECT * EXCLUDE (factor) FROM diff"),
    "snapshot_rates": _sql(
        _DIFF, f"SELECT canonical_tag AS grouped, {_RATE} FROM diff GROUP BY 1 UNION ALL "
        f"SELECT 'qtrs ' || qtrs, {_RATE} FROM diff GROUP BY 1"),
    "snapshot_artefacts": _sql(_DIFF, _ARTEFACTS),
    "snapshot_histogram": _sql(
        _DIFF, f"SELECT bin, count(*) AS n FROM (SELECT CASE {_BINS} END AS bin FROM diff) "
        "WHERE bin IS NOT NULL GROUP BY bin"),
    "snapshot_year_mix": _sql(
        _DIFF, "SELECT CAST(year(ddate) AS INTEGER) AS year, count(*) AS n FROM diff GROUP BY 1"),
    "snapshot_candidates": _sql(
        _DIFF, f"SELECT {SNAP_KEY}, value_a, value_b, pct FROM diff WHERE {_CHANGED} AND qtrs = 4 "
        "AND pct BETWEEN 3 AND 90 AND abs(value_a) > 20 "
        f"ORDER BY abs(value_a) DESC, {SNAP_KEY} LIMIT 25"),
    "snapshot_buckets": _sql(
        _DIFF, f"SELECT bucket, CAST(place AS INTEGER) AS place, {SNAP_KEY}, value_a, value_b, pct "
        "FROM (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY abs(value_a) DESC, "
        f"{SNAP_KEY}) AS place FROM ("
        + " UNION ALL ".join(f"SELECT '{b}' AS bucket, * FROM diff WHERE {_CHANGED} AND {rule}"
                             for b, rule in _BUCKETS.items()) + ")) WHERE place <= 8"),
    "snapshot_largest": _sql(
        _DIFF, f"SELECT {SNAP_KEY}, value_a, value_b, pct, adsh_a, adsh_b FROM diff "
        f"WHERE {_CHANGED} ORDER BY pct DESC, {SNAP_KEY} LIMIT 15"),
    "filing_path": _sql(
        _SUB, "SELECT adsh, cik, 'https://example.org/data/' || cik || '/' "
        "|| replace(adsh, '-', '') || '/' AS path FROM silver_sub"),
}
ORACLES["company_lineage"] = f"""
    WITH RECURSIVE said AS (
        SELECT o_custkey AS cik, o_orderdate AS told_at, 'Company ' || o_custkey AS name,
               CASE WHEN o_custkey % 35 = 0 THEN o_custkey // 70 END AS ein,
               CASE WHEN o_custkey % 7 = 3 AND o_custkey % 50 >= 7
                    THEN 'Company ' || (o_custkey - 7) END AS former,
               CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) - 30 END AS changed
        FROM orders),
    firm AS (SELECT DISTINCT cik, name, ein, former FROM said),
    tied AS (
        SELECT a.cik AS a, b.cik AS b FROM firm a JOIN firm b
        ON a.ein = b.ein OR a.former = b.name OR b.former = a.name OR a.former = b.former),
    reached AS (
        SELECT DISTINCT cik, cik AS other FROM said
        UNION SELECT r.cik, t.b FROM reached r JOIN tied t ON r.other = t.a),
    member AS (SELECT cik, min(other) AS entity FROM reached GROUP BY cik),
    told AS (
        SELECT cik, name, CAST(told_at AS TIMESTAMP) AS told_at FROM said
        UNION SELECT cik, name, CAST(changed AS TIMESTAMP) FROM said
        WHERE former IS NOT NULL AND changed < told_at),
    instant AS (
        SELECT entity, told_at, name, cik FROM (
            SELECT *, row_number() OVER (PARTITION BY entity, told_at ORDER BY name, cik) AS nth
            FROM told JOIN member USING (cik)) WHERE nth = 1),
    opened AS (
        SELECT * FROM (
            SELECT *, lag(name) OVER w AS name0, lag(cik) OVER w AS cik0,
                   row_number() OVER w AS nth
            FROM instant WINDOW w AS (PARTITION BY entity ORDER BY told_at))
        WHERE nth = 1 OR name <> name0 OR cik <> cik0)
    SELECT entity, name, cik, told_at AS valid_from_ts,
           coalesce(lead(told_at) OVER e, {OPEN}) AS valid_to_ts,
           CAST(row_number() OVER e AS INTEGER) AS version_seq,
           lead(told_at) OVER e IS NULL AS is_current
    FROM opened WINDOW e AS (PARTITION BY entity ORDER BY told_at)"""
ORACLES["as_of_function"] = ORACLES["fundamental_as_of"]
ORACLES["intervals_incremental"] = ORACLES["knowledge_intervals"]
