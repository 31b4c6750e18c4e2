"""The expected result of every registered query, as SQL over the same tables."""

from __future__ import annotations

import re

from tallyspan import fixed_values as fv

YEARS = list(range(fv.FIRST_YEAR, fv.LAST_YEAR + 1))


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _values(text: str, numeric: list[str]) -> str:
    rows = fv.rows(text)
    cells = [", ".join(v if c in numeric else _text(v) for c, v in r.items()) for r in rows]
    return f"(VALUES {', '.join(f'({c})' for c in cells)}) AS t({', '.join(rows[0])})"


# --- the derived datasets ----------------------------------------------------

HIGH, LOW = "p IN ('1','2')", "p IN ('3','4','5')"
COUNTS = {
    223: "true", 224: "s = 'F'", 225: "s IN ('O','P')",
    226: "p IN ('1','2','3')", 227: "p = '1'", 228: "p = '2'",
    230: "s = 'P'", 232: f"s = 'P' AND {HIGH}", 233: f"s = 'P' AND {LOW}",
    235: f"s = 'O' AND {HIGH}", 242: f"s = 'O' AND {LOW}", 243: "s = 'O'",
    268: "p = '4'", 269: "p = '5'",
}
SUMS = {244: "s = 'O' AND year >= 2014", 245: "s IN ('F','P')", 246: "true", 247: HIGH, 248: LOW}

_measures = ", ".join(
    [f"CAST(count(*) FILTER (WHERE {c}) AS DOUBLE) AS d{i}" for i, c in COUNTS.items()]
    + [f"CAST(sum(cents) FILTER (WHERE {c}) AS DOUBLE) / 100000.0 AS d{i}" for i, c in SUMS.items()]
)
_cells = ", ".join(f"{{'dataset_id': {i}, 'value': d{i}}}" for i in [*COUNTS, *SUMS])

LONG = f"""
o AS (
  SELECT o_custkey, CAST(year(o_orderdate) + 15 AS INTEGER) AS year, o_orderstatus AS s,
         substr(o_orderpriority, 1, 1) AS p, CAST(round(o_totalprice * 100) AS BIGINT) AS cents
  FROM orders),
c AS (
  SELECT c_custkey, c_name || CASE c_mktsegment WHEN 'BUILDING' THEN ' shahri' WHEN 'HOUSEHOLD' THEN ' Tumani'
           WHEN 'FURNITURE' THEN ' VILOYATI' WHEN 'MACHINERY' THEN ' respublikasi' ELSE '' END AS own,
         n_name || ' tumani' AS nat, r_name || ' viloyati' AS reg,
         CAST(1710 + 2 * n_regionkey AS BIGINT) AS rc,
         CAST(1710 + 2 * n_regionkey AS BIGINT) * 1000 + 200 + n_nationkey AS nc
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
placed AS (
  SELECT rc AS geo_code, reg AS geo_name_raw, o.* FROM o JOIN c ON o_custkey = c_custkey
  UNION ALL SELECT nc, nat, o.* FROM o JOIN c ON o_custkey = c_custkey
  UNION ALL SELECT nc * 1000000000 + c_custkey, own, o.* FROM o JOIN c ON o_custkey = c_custkey),
m AS (SELECT geo_code, geo_name_raw, year, {_measures} FROM placed GROUP BY ALL),
cells AS (SELECT geo_code, geo_name_raw, year, unnest([{_cells}]) AS x FROM m),
long AS (
  SELECT CAST(x.dataset_id AS INTEGER) AS dataset_id, geo_code, geo_name_raw, year, x.value AS value
  FROM cells WHERE x.value IS NOT NULL)"""

ATOMIC = f"""{LONG},
dict AS (SELECT * FROM {_values(fv.METRIC_DICTIONARY_CSV, ["dataset_id"])}),
atomic AS (
  SELECT l.dataset_id, geo_code, geo_name_raw, year, metric_group, metric_key,
         coalesce(sex, 'total') AS sex, coalesce(settlement_type, 'total') AS settlement_type, value
  FROM long l JOIN dict d ON l.dataset_id = d.dataset_id)"""

GEO = f"""{ATOMIC},
ovr AS (SELECT CAST(geo_code AS BIGINT) AS geo_code, geo_name_clean FROM {_values(fv.GEO_OVERRIDE_CSV, ["geo_code"])}),
base AS (SELECT geo_code, min(geo_name_raw) AS raw FROM atomic GROUP BY 1),
geo AS (
  SELECT b.geo_code, coalesce(geo_name_clean, raw) AS geo_name,
         CASE WHEN lower(raw) LIKE '%shahri%' THEN 'shahar' WHEN lower(raw) LIKE '%tumani%' THEN 'tuman'
              WHEN lower(raw) LIKE '%viloyati%' THEN 'viloyat'
              WHEN lower(raw) LIKE '%respublikasi%' THEN 'respublika' ELSE 'nomalum' END AS geo_level
  FROM base b LEFT JOIN ovr o ON b.geo_code = o.geo_code)"""


def _pick(metric: str, name: str | None = None) -> str:
    return f"max(value) FILTER (WHERE metric_key = '{metric}') AS {name or metric}"


def _in(keys) -> str:
    return ", ".join(_text(k) for k in keys)


def _prefix(prefix: str, column: str = "geo_code") -> str:
    return f"CAST({column} AS VARCHAR) LIKE '{prefix}%'"


def overview(prefix: str = "1714", unit: int = 1) -> str:
    pop = "nullif(population_total, 0)" if unit == 1 else f"nullif(population_total * {unit}.0, 0)"
    return f"""{GEO},
wide AS (
  SELECT geo_code, year, {", ".join(_pick(k) for k in fv.OVERVIEW_MEASURES)} FROM atomic
  WHERE {_prefix(prefix)} AND sex = 'total' AND settlement_type = 'total'
    AND metric_key IN ({_in(fv.OVERVIEW_MEASURES)})
  GROUP BY 1, 2),
mart AS (
  SELECT w.geo_code, geo_name, geo_level, w.year, {", ".join(fv.OVERVIEW_MEASURES)},
         birth_total - death_total AS natural_increase, in_migration - out_migration AS net_migration,
         birth_total / {pop} * 1000 AS cbr_per_1000, death_total / {pop} * 1000 AS cdr_per_1000,
         (in_migration - out_migration) / {pop} * 1000 AS net_mig_per_1000
  FROM wide w LEFT JOIN geo g ON w.geo_code = g.geo_code)"""


SPLIT = f"""{ATOMIC},
wide AS (
  SELECT geo_code, year, {", ".join(_pick(k) for k in fv.POPULATION_MEASURES)} FROM atomic
  WHERE {_prefix("1714")} AND metric_group = 'population' GROUP BY 1, 2),
mart AS (
  SELECT *, population_total - (population_men + population_women) AS sex_diff,
         population_total - (population_urban + population_rural) AS settlement_diff,
         CAST(population_women IS NULL AS INTEGER) AS missing_women_flag FROM wide)"""

BIRTHS = f"""{ATOMIC},
wide AS (
  SELECT geo_code, year, {", ".join(_pick(k, n) for n, k in fv.BIRTH_MEASURES.items())} FROM atomic
  WHERE {_prefix("1714")} AND metric_key IN ({_in(fv.BIRTH_MEASURES.values())}) GROUP BY 1, 2),
mart AS (
  SELECT *, birth_girls / nullif(total_birth_yearly, 0) * 100 AS share_girls,
         birth_boys / nullif(total_birth_yearly, 0) * 100 AS share_boys,
         total_birth_yearly - (birth_girls + birth_boys) AS sex_diff FROM wide)"""

COVERAGE = f"""{ATOMIC},
mart AS (
  SELECT metric_key, year, CAST(count(*) AS BIGINT) AS rows_cnt, CAST(count(value) AS BIGINT) AS non_null_cnt
  FROM atomic WHERE {_prefix("1714")} GROUP BY 1, 2)"""


def melt(source: str, ids: str, columns: list[str], name: str, keep_nulls: bool = True) -> str:
    parts = [f"SELECT {ids}, '{c}' AS {name}, CAST({c} AS DOUBLE) AS value FROM {source}" for c in columns]
    union = " UNION ALL ".join(parts)
    return union if keep_nulls else f"SELECT * FROM ({union}) u WHERE value IS NOT NULL"


# --- reconciliation ----------------------------------------------------------

CHECKS = {
    "births_total_vs_girls_boys": (["birth_total", "birth_girls", "birth_boys"], "settlement_type = 'total'"),
    "deaths_total_vs_women_men": (["death_total", "death_women", "death_men"], "settlement_type = 'total'"),
    "population_total_vs_men_women": (
        ["population_total", "population_men", "population_women"], "settlement_type = 'total'"),
    "population_total_vs_urban_rural": (
        ["population_total", "population_urban", "population_rural"], "sex = 'total'"),
    "marriages_total_vs_urban_rural": (["marriages_total", "marriages_urban", "marriages_rural"], "sex = 'total'"),
    "divorces_total_vs_urban_rural": (["divorces_total", "divorces_urban", "divorces_rural"], "sex = 'total'"),
}
PUBLISHED = {
    "births_total_vs_girls_boys": (
        CHECKS["births_total_vs_girls_boys"][0], "sex = 'total' AND settlement_type = 'total'"),
    "deaths_total_vs_women_men": (
        CHECKS["deaths_total_vs_women_men"][0], "sex = 'total' AND settlement_type = 'total'"),
    "divorces_total_vs_urban_rural": (["divorce_total", "divorce_urban", "divorce_rural"], "sex = 'total'"),
}


def _check_body(name: str, keys: list[str], where: str) -> str:
    total, a, b = keys
    flag = f", CAST({b} IS NULL AS INTEGER) AS missing_women_flag" if name == "population_total_vs_men_women" else ""
    return f"""SELECT '{name}' AS check_name, geo_code, year, {total}, {a}, {b}, {total} - ({a} + {b}) AS diff{flag}
FROM (SELECT geo_code, year, {", ".join(_pick(k) for k in keys)} FROM atomic
      WHERE {_prefix("1714")} AND {where} AND metric_key IN ({_in(keys)}) GROUP BY 1, 2) w"""


def check(name: str, spec: tuple[list[str], str]) -> str:
    return f"WITH {ATOMIC} {_check_body(name, *spec)}"


def report() -> str:
    parts = []
    for name, (keys, where) in CHECKS.items():
        total, a, b = keys
        parts.append(
            f"SELECT check_name, geo_code, year, {total} AS total, {a} AS part1, {b} AS part2, diff "
            f"FROM ({_check_body(name, keys, where)}) q"
        )
    return f"""WITH {ATOMIC.replace("atomic AS (", "atomic AS MATERIALIZED (")},
allchecks AS ({" UNION ALL ".join(parts)})
SELECT *, CASE WHEN diff IS NULL THEN 'gap' WHEN abs(diff) <= 1e-6 THEN 'ok' ELSE 'investigate' END AS reading
FROM allchecks"""


# --- data tests --------------------------------------------------------------


def dq_row(table: str, column: str, test: str, n: str, f: str, source: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{test}' AS test, "
        f"CAST({n} AS BIGINT) AS n_rows, CAST({f} AS BIGINT) AS n_failed, ({f}) = 0 AS passed FROM {source}"
    )


def not_null(table: str, column: str, source: str | None = None) -> str:
    return dq_row(table, column, "not_null", "count(*)", f"count(*) FILTER (WHERE {column} IS NULL)", source or table)


def unique(table: str, column: str) -> str:
    counted = f"(SELECT {column} AS k, count(*) AS c FROM {table} GROUP BY 1) g"
    repeated = "count(*) FILTER (WHERE k IS NOT NULL AND c > 1)"
    return dq_row(table, column, "unique", "coalesce(sum(c), 0)", repeated, counted)


def accepted(table: str, column: str, values) -> str:
    bad = f"count(*) FILTER (WHERE {column} IS NOT NULL AND {column} NOT IN ({_in(values)}))"
    return dq_row(table, column, "accepted_values", "count(*)", bad, table)


def relationships(table: str, column: str, parent: str, key: str) -> str:
    known = f"SELECT {key} FROM {parent} WHERE {key} IS NOT NULL"
    bad = f"count(*) FILTER (WHERE {column} IS NOT NULL AND {column} NOT IN ({known}))"
    return dq_row(table, column, "relationships", "count(*)", bad, table)


def suite() -> str:
    groups = ["population", "births", "deaths", "migration", "marriages", "divorces"]
    levels = ["shahar", "tuman", "viloyat", "respublika", "nomalum"]
    staged = [223, 224, 225, 226, 227, 242, 268]
    ctes = f"""WITH {GEO.replace("atomic AS (", "atomic AS MATERIALIZED (")},
dim_geo AS (SELECT * FROM geo), dim_metric AS (SELECT * FROM dict), geo_override AS (SELECT * FROM ovr),
dim_sex AS (SELECT * FROM {_values(fv.SEX_LABELS_CSV, ["sort_order"])}),
dim_settlement_type AS (SELECT * FROM {_values(fv.SETTLEMENT_LABELS_CSV, ["sort_order"])}),
int_demography_atomic AS (SELECT * FROM atomic),
fact_population_yearly AS (SELECT * FROM atomic WHERE metric_group = 'population'),
fact_demography_flows_yearly AS (SELECT * FROM atomic WHERE metric_group <> 'population'),
scoped AS (SELECT * FROM atomic WHERE {_prefix("1714")}),
mart_region_overview_yearly AS (SELECT DISTINCT geo_code, year FROM scoped WHERE sex = 'total'
  AND settlement_type = 'total' AND metric_key IN ({_in(fv.OVERVIEW_MEASURES)})),
mart_population_split_yearly AS (SELECT DISTINCT geo_code, year FROM scoped WHERE metric_group = 'population'),
mart_metric_coverage AS (SELECT DISTINCT metric_key, year FROM scoped)"""
    tests = [not_null("dim_metric", c) for c in ["dataset_id", "metric_group", "metric_key"]]
    tests += [unique("dim_metric", "dataset_id"), accepted("dim_metric", "metric_group", groups)]
    tests += [not_null("geo_override", c) for c in ["geo_code", "geo_name_clean"]]
    tests += [unique("geo_override", "geo_code")]
    tests += [
        not_null(f"stg_sdmx_{i}_long", c, f"(SELECT * FROM atomic WHERE dataset_id = {i}) s")
        for i in staged for c in ["dataset_id", "geo_code", "year"]
    ]
    fact = "int_demography_atomic"
    tests += [not_null(fact, c) for c in ["geo_code", "dataset_id", "year", "metric_group", "metric_key", "sex",
                                          "settlement_type"]]
    tests += [accepted(fact, "metric_group", groups), relationships(fact, "geo_code", "dim_geo", "geo_code"),
              relationships(fact, "sex", "dim_sex", "sex_id"),
              relationships(fact, "settlement_type", "dim_settlement_type", "settlement_type_id")]
    tests += [not_null("dim_geo", c) for c in ["geo_code", "geo_name", "geo_level"]]
    tests += [unique("dim_geo", "geo_code"), accepted("dim_geo", "geo_level", levels)]
    tests += [not_null("dim_sex", "sex_id"), unique("dim_sex", "sex_id")]
    tests += [check("dim_settlement_type", "settlement_type_id") for check in (not_null, unique)]
    tests += [not_null("fact_population_yearly", c) for c in ["geo_code", "year", "metric_key"]]
    tests += [accepted("fact_population_yearly", "metric_key", fv.POPULATION_MEASURES)]
    tests += [not_null("fact_demography_flows_yearly", "metric_group"),
              accepted("fact_demography_flows_yearly", "metric_group", groups[1:])]
    tests += [not_null("mart_region_overview_yearly", c) for c in ["geo_code", "year"]]
    tests += [not_null("mart_population_split_yearly", c) for c in ["geo_code", "year"]]
    tests += [not_null("mart_metric_coverage", c) for c in ["metric_key", "year"]]
    return ctes + " " + " UNION ALL ".join(tests)


# --- everything --------------------------------------------------------------

RATES = """rates AS (SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS discount, nullif(l_tax, 0) AS tax
FROM lineitem)"""
_ids = "l_orderkey, l_linenumber"
_fact_columns = "geo_code, year, metric_key, sex, settlement_type"
_flow_columns = "geo_code, year, metric_group, metric_key, sex, settlement_type"
_atomic_columns = "dataset_id, geo_code, geo_name_raw, year, metric_group, metric_key, sex, settlement_type, value"
_catalogued = f"(SELECT * FROM {_values(fv.METRIC_DICTIONARY_CSV, ['dataset_id'])})"

SQL: dict[str, str] = {
    "unpivot_drop_nulls": f"WITH {RATES} {melt('rates', _ids, ['discount', 'tax'], 'rate', keep_nulls=False)}",
    "unpivot_keep_nulls": f"WITH {RATES} {melt('rates', _ids, ['discount', 'tax'], 'rate')}",
    "unpivot_restricted_years": f"WITH {LONG} SELECT * FROM long WHERE year >= 2014",
    "staging_contract": f"WITH {LONG} SELECT * FROM long",
    "conditional_pivot": """SELECT l_orderkey, max(l_quantity) FILTER (WHERE l_returnflag = 'A') AS qty_a,
        max(l_quantity) FILTER (WHERE l_returnflag = 'R') AS qty_r FROM lineitem GROUP BY 1""",
    "typed_cells": """SELECT 223 AS dataset_id, p_partkey AS geo_code, p_name AS geo_name_raw,
        CAST(2010 AS INTEGER) AS year, CAST(p_size AS DOUBLE) AS value FROM part WHERE p_size IS NOT NULL""",
    "rejected_cells": """SELECT 223 AS dataset_id, p_partkey AS geo_code, p_name AS geo_name_raw,
        CAST(2011 AS INTEGER) AS year, p_type AS cell FROM part
        WHERE p_type IS NOT NULL AND TRY_CAST(p_type AS DOUBLE) IS NULL""",
    "csv_rejects": """WITH p AS (SELECT *, p_name || chr(10) || '"second", line' AS name FROM part)
        SELECT 223 AS dataset_id, p_partkey || 'x' AS code, name AS geo_name_raw, CAST(NULL AS INTEGER) AS year,
          p_partkey || 'x' AS found, 'code' AS reason FROM p WHERE p_partkey % 10 = 0
        UNION ALL SELECT 223, CAST(p_partkey AS VARCHAR), name, 2011, p_type, 'cell' FROM p
        WHERE p_partkey % 10 <> 0 AND TRY_CAST(p_type AS DOUBLE) IS NULL AND p_type IS NOT NULL""",
    "csv_line_breaks": """WITH p AS (SELECT *, p_name || chr(10) || '"second", line' AS name FROM part),
        rows AS (SELECT 223 AS dataset_id, * FROM p WHERE p_partkey % 10 <> 0 UNION ALL SELECT 224, * FROM p)
        SELECT dataset_id, CAST(p_partkey AS BIGINT) AS geo_code, name AS geo_name_raw, 2010 AS year, CAST(p_size AS DOUBLE) AS value FROM rows
        UNION ALL SELECT dataset_id, p_partkey, name, 2011, TRY_CAST(p_type AS DOUBLE) FROM rows WHERE TRY_CAST(p_type AS DOUBLE) IS NOT NULL""",
    "raw_rough_tables": """WITH p AS (SELECT *, p_name || chr(10) || '"second", line' AS name FROM part)
        SELECT 'raw_rough.sdmx_data_223' AS table_name, 'string' AS code_type, p_partkey || CASE WHEN p_partkey % 10 = 0 THEN 'x' ELSE '' END AS code,
          name, CAST(p_size AS VARCHAR) AS y2010, p_type AS y2011 FROM p
        UNION ALL SELECT 'raw_rough.sdmx_data_224', 'bigint', CAST(p_partkey AS VARCHAR), name, CAST(p_size AS VARCHAR), p_type FROM p""",
    "manifest_records": """SELECT CAST(page_id AS VARCHAR) AS dataset_id, url, 'page_' || page_id || '.html' AS filename, '' AS title_uz,
        '' AS metric_key, '' AS periodicity, 'line one of ' || page_id || ';' || chr(10) || '"line two", with, commas' AS notes FROM pages""",
    "csv_extracts_to_atomic": f"WITH {ATOMIC} SELECT {_atomic_columns} FROM atomic",
    "incremental_rebuild": f"""WITH {ATOMIC} SELECT * REPLACE (CASE WHEN dataset_id = 224 THEN value + 1 ELSE value END AS value)
        FROM (SELECT {_atomic_columns} FROM atomic) WHERE dataset_id <> 227""",
    "refreshed_coverage": f"""WITH {ATOMIC} SELECT metric_key, year, CAST(count(*) AS BIGINT) AS rows_cnt,
        CAST(count(value) AS BIGINT) AS non_null_cnt FROM atomic GROUP BY ALL""",
    "landed_source_changes": f"""WITH {LONG} SELECT dataset_id, CASE dataset_id WHEN 228 THEN 'new' WHEN 227 THEN 'missing' WHEN 224 THEN 'changed'
        ELSE 'unchanged' END AS status FROM (SELECT DISTINCT dataset_id FROM long)""",
    "landed_source_age": f"""WITH {LONG} SELECT DISTINCT dataset_id, CAST(40 AS INTEGER) AS age_days, false AS fresh FROM long""",
    "raw_source_tables": f"""WITH {LONG} SELECT 'raw.sdmx_data_' || dataset_id AS table_name, geo_code AS code,
        geo_name_raw AS klassifikator, {", ".join(f"max(value) FILTER (WHERE year = {y}) AS y{y}" for y in YEARS)}
        FROM long GROUP BY 1, 2, 3""",
    "staging_views": f"WITH {LONG} SELECT * FROM long",
    "manifest_rows": """SELECT CAST(page_id AS VARCHAR) AS dataset_id, url, 'page_' || page_id || '.html' AS filename,
        '' AS title_uz, '' AS metric_key, 'yearly' AS periodicity, '' AS notes FROM pages""",
    "file_audit": f"""WITH {LONG}, per AS (SELECT dataset_id, count(DISTINCT geo_code) AS n FROM long GROUP BY 1)
        SELECT CAST(d.dataset_id AS VARCHAR) AS dataset_id, metric_key,
          CASE WHEN n IS NULL THEN 'missing' ELSE 'ok' END AS status, CAST(coalesce(n, 0) AS BIGINT) AS rows,
          CASE WHEN n IS NOT NULL THEN CAST({len(YEARS) + 5} AS INTEGER) END AS cols,
          CASE WHEN n IS NOT NULL THEN 'Klassifikator' END AS second_column, true AS all_digested
        FROM {_catalogued} d LEFT JOIN per ON d.dataset_id = per.dataset_id""",
    "audit_tally": f"""WITH {LONG}, per AS (SELECT DISTINCT dataset_id FROM long)
        SELECT CASE WHEN per.dataset_id IS NULL THEN 'missing' ELSE 'ok' END AS status,
          CAST(count(*) AS BIGINT) AS items
        FROM {_catalogued} d LEFT JOIN per ON d.dataset_id = per.dataset_id GROUP BY 1""",
    "export_status": f"""WITH {ATOMIC}, s AS (SELECT * FROM atomic WHERE {_prefix("1714")})
        SELECT 'mart_region_overview_yearly' AS table_name, 'ok' AS status, CAST(count(*) AS BIGINT) AS rows,
          CAST(NULL AS VARCHAR) AS message FROM (SELECT DISTINCT geo_code, year FROM s WHERE sex = 'total'
          AND settlement_type = 'total' AND metric_key IN ({_in(fv.OVERVIEW_MEASURES)})) a
        UNION ALL SELECT 'mart_population_split_yearly', 'ok', count(*), NULL FROM
          (SELECT DISTINCT geo_code, year FROM s WHERE metric_group = 'population') b
        UNION ALL SELECT 'mart_births_by_sex_yearly', 'ok', count(*), NULL FROM
          (SELECT DISTINCT geo_code, year FROM s WHERE metric_group = 'births') d
        UNION ALL SELECT 'mart_metric_coverage', 'ok', count(*), NULL FROM (SELECT DISTINCT metric_key, year FROM s) e
        UNION ALL SELECT 'mart_not_built', 'failed', NULL, 'TABLE_OR_VIEW_NOT_FOUND'""",
    "export_roundtrip": f"WITH {BIRTHS} SELECT * FROM mart",
    "optional_table": f"WITH {BIRTHS} SELECT 'mart_births_by_sex_yearly' AS table_name, geo_code, year FROM mart",
    "stored_atomic_slice": f"""WITH {ATOMIC} SELECT {_atomic_columns} FROM atomic WHERE {_prefix("1714")}
        AND metric_key IN ({_in(fv.OVERVIEW_MEASURES)})""",
    "union_by_name": """SELECT 1 AS dataset_id, c_custkey AS code, c_name AS name, c_acctbal AS value FROM customer
        UNION ALL SELECT 2, s_suppkey, s_name, s_acctbal FROM supplier
        UNION ALL SELECT 3, p_partkey, p_name, p_retailprice FROM part""",
    "dictionary_enrichment": """SELECT l_orderkey, l_linenumber, l_returnflag AS flag,
        CASE l_returnflag WHEN 'A' THEN 'accepted' ELSE 'returned' END AS label,
        CASE l_returnflag WHEN 'A' THEN 'urban' ELSE 'total' END AS settlement_type
        FROM lineitem WHERE l_returnflag IN ('A', 'R')""",
    "int_demography_atomic": f"WITH {ATOMIC} SELECT {_atomic_columns} FROM atomic",
    "label_counts": f"""WITH {ATOMIC}, n AS (
          SELECT sex, settlement_type, CAST(count(*) AS BIGINT) AS row_count FROM atomic GROUP BY 1, 2)
        SELECT n.*, a.sex_label_uz, a.sort_order AS sex_order, b.settlement_label_uz, b.sort_order AS settlement_order
        FROM n LEFT JOIN {_values(fv.SEX_LABELS_CSV, ["sort_order"]).replace("AS t(", "AS a(")} ON n.sex = a.sex_id
        LEFT JOIN {_values(fv.SETTLEMENT_LABELS_CSV, ["sort_order"]).replace("AS t(", "AS b(")}
          ON n.settlement_type = b.settlement_type_id""",
    "prefix_scope": f"SELECT o_orderkey, o_custkey FROM orders WHERE {_prefix('14', 'o_custkey')}",
    "prefix_of_signed_codes": """WITH c AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN -o_custkey ELSE o_custkey END AS code FROM orders)
        SELECT o_orderkey, code, prefix FROM c, (VALUES ('-12'), ('123'), ('-'), ('0'), ('1x')) p(prefix) WHERE starts_with(CAST(code AS VARCHAR), prefix)""",
    "prefix_blank_default": f"WITH {LONG} SELECT * FROM long WHERE {_prefix('1714')}",
    "total_axes_slice": f"""WITH {ATOMIC} SELECT geo_code, year, metric_key, value FROM atomic
        WHERE sex = 'total' AND settlement_type = 'total' AND metric_key IN ({_in(fv.OVERVIEW_MEASURES)})""",
    "year_range_orders": """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
        WHERE year(o_orderdate) BETWEEN 1996 AND 1998""",
    "existing_columns": "SELECT c_custkey, c_mktsegment FROM customer",
    "representative_name": """SELECT l_suppkey, min(l_returnflag || l_linestatus) AS name FROM lineitem GROUP BY 1""",
    "name_override": f"""WITH {GEO} SELECT geo_code, geo_name FROM geo""",
    "level_classes": """SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)the') THEN 'en'
        WHEN regexp_matches(text, '(?i)der') THEN 'de' WHEN regexp_matches(text, '(?i)les') THEN 'fr'
        ELSE 'unknown' END AS level FROM documents""",
    "dim_geo": f"WITH {GEO} SELECT * FROM geo",
    "maintained_dim_geo": "WITH " + GEO.replace(
        "min(geo_name_raw) AS raw FROM atomic", "min(CASE WHEN dataset_id = 227 THEN '#' ELSE '' END || geo_name_raw) AS raw FROM atomic WHERE dataset_id <> 228"
    ) + " SELECT * FROM geo",
    "dim_geo_region_code": f"""WITH {GEO} SELECT *, substr(CAST(geo_code AS VARCHAR), 1, 4) AS region_code FROM geo""",
    "fact_population_yearly": f"""WITH {ATOMIC} SELECT {_fact_columns}, value AS population_cnt FROM atomic
        WHERE metric_group = 'population'""",
    "fact_demography_flows_yearly": f"""WITH {ATOMIC} SELECT {_flow_columns}, value AS event_cnt FROM atomic
        WHERE metric_group IN ('births', 'deaths', 'migration', 'marriages', 'divorces')""",
    "fact_flows_published_groups": f"""WITH {ATOMIC} SELECT {_flow_columns}, value AS event_cnt FROM atomic
        WHERE metric_group IN ('birth', 'death', 'migration', 'marriages', 'divorce')""",
    "mart_region_overview_yearly": f"WITH {overview()} SELECT * FROM mart",
    "mart_region_overview_true_rates": f"WITH {overview(unit=1000)} SELECT * FROM mart",
    "mart_scoped_overview_yearly": f"WITH {overview('1716')} SELECT * FROM mart",
    "mart_population_split_yearly": f"WITH {SPLIT} SELECT * FROM mart",
    "mart_births_by_sex_yearly": f"WITH {BIRTHS} SELECT * FROM mart",
    "mart_metric_coverage": f"WITH {COVERAGE} SELECT * FROM mart",
    "coverage_gaps": f"""WITH {COVERAGE}, wanted AS (SELECT d.metric_key, y.year FROM dict d
          CROSS JOIN (SELECT DISTINCT year FROM mart) y)
        SELECT w.metric_key, w.year, coalesce(rows_cnt, 0) AS rows_cnt, coalesce(non_null_cnt, 0) AS non_null_cnt
        FROM wanted w LEFT JOIN mart m ON w.metric_key = m.metric_key AND w.year = m.year""",
    "rolling_average_births": f"""WITH {ATOMIC}, b AS (SELECT * FROM atomic WHERE metric_key = 'birth_total')
        SELECT geo_code, metric_key, year, avg(value) OVER (PARTITION BY geo_code, metric_key ORDER BY year
          RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) AS avg_3y FROM b""",
    **{f"check_{name}": check(name, spec) for name, spec in CHECKS.items()},
    **{f"published_check_{name}": check(name, spec) for name, spec in PUBLISHED.items()},
    "reconciliation_report": report(),
    "duplicate_grain": """SELECT o_custkey AS geo_code, CAST(year(o_orderdate) AS INTEGER) AS year,
        o_orderstatus AS metric_key, 'total' AS sex, 'total' AS settlement_type, CAST(count(*) AS BIGINT) AS row_count
        FROM orders GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    "dq_not_null": f"WITH {RATES} " + " UNION ALL ".join(
        not_null("lineitem", c, "rates") for c in ["l_orderkey", "discount", "tax"]),
    "dq_unique": unique("orders", "o_orderkey") + " UNION ALL " + unique("orders", "o_custkey"),
    "dq_accepted_values": " UNION ALL ".join([
        accepted("orders", "o_orderstatus", ["F", "O"]),
        accepted("orders", "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]),
        accepted("customer", "c_mktsegment", ["BUILDING"])]),
    "dq_relationships": "WITH builders AS (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') "
        + relationships("orders", "o_custkey", "builders", "c_custkey") + " UNION ALL "
        + relationships("customer", "c_custkey", "orders", "o_custkey"),
    "dq_failing_values": """SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS row_count FROM orders
        WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW') GROUP BY 1""",
    "dq_orphan_keys": """SELECT o_custkey, CAST(count(*) AS BIGINT) AS row_count FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1""",
    "dq_suite": suite(),
    "year_bounds": """SELECT CAST(min(year(o_orderdate)) AS INTEGER) AS min_year,
        CAST(max(year(o_orderdate)) AS INTEGER) AS max_year FROM orders""",
    "latest_per_customer": """SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "latest_day_orders": "SELECT * FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)",
    "any_flag_by_part": """SELECT l_partkey, CAST(bool_or(l_discount = 0) AS INTEGER) AS has_undiscounted
        FROM lineitem GROUP BY 1""",
    "distinct_options": "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem",
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS row_count FROM lineitem
        GROUP BY 1, 2 HAVING count(*) > 1""",
    "zero_safe_ratio": """SELECT l_orderkey, l_linenumber, l_tax / nullif(l_discount, 0) * 1000 AS tax_per_1000,
        l_tax / nullif(l_discount, 0) * 100 AS tax_share FROM lineitem""",
    "content_fingerprint": """SELECT doc_id, sha256(text) AS digest, CAST(strlen(text) AS BIGINT) AS bytes
        FROM documents""",
    "clean_cells": """SELECT doc_id, trim(trim(' "' || text || '"' || chr(9),
        ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)), '"') AS cell FROM documents""",
    "code_labels": "SELECT c_custkey, c_name || ' (' || c_custkey || ')' AS label FROM customer",
    "display_numbers": """SELECT c_custkey, format('{:,}', CAST(trunc(c_acctbal) AS BIGINT)) AS whole,
        printf('%.2f', c_acctbal) AS decimals FROM customer""",
    "overview_slice": f"WITH {overview()} SELECT * FROM mart WHERE year BETWEEN 2011 AND 2014",
    "overview_of_geo": f"WITH {overview()} SELECT * FROM mart WHERE geo_code = 1714207",
    "geo_options": f"""WITH {overview()} SELECT DISTINCT geo_code, geo_name,
        geo_name || ' (' || geo_code || ')' AS label FROM mart""",
    "latest_cards": f"""WITH {overview()}, last AS (SELECT * FROM mart
          QUALIFY row_number() OVER (PARTITION BY geo_code ORDER BY year DESC) = 1)
        SELECT geo_code, year, {", ".join(
            f"format('{{:,}}', CAST(trunc({c}) AS BIGINT)) AS {c}"
            for c in ["population_total", "birth_total", "death_total", "natural_increase", "net_migration"])},
          printf('%.2f', cbr_per_1000) AS cbr_per_1000 FROM last""",
    "trend_series": f"WITH {overview()} {melt('mart', 'geo_code, year', fv.TREND_MEASURES, 'measure')}",
    "district_ranking": f"""WITH {overview()} SELECT {", ".join(fv.RANKING_COLUMNS)} FROM mart
        WHERE year = (SELECT max(year) FROM mart)""",
    "urban_rural_series": f"""WITH {SPLIT}
        {melt("mart", "geo_code, year", ["population_urban", "population_rural"], "segment")}""",
    "men_women_series": f"""WITH {SPLIT}
        {melt("mart", "geo_code, year", ["population_men", "population_women"], "segment")}""",
    "gap_warnings": f"""WITH {SPLIT} SELECT geo_code, CAST(max(missing_women_flag) > 0 AS INTEGER) AS has_gap
        FROM mart GROUP BY 1""",
    "coverage_listing": f"WITH {COVERAGE} SELECT * FROM mart ORDER BY 1, 2",
    "births_check": f"""WITH {BIRTHS} SELECT geo_code, year, total_birth_yearly, birth_girls, birth_boys, sex_diff
        FROM mart WHERE year BETWEEN 2011 AND 2015""",
    "snapshot_changes": """WITH
        b AS (SELECT user_id, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1),
        a AS (SELECT user_id, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY 1)
        SELECT coalesce(a.user_id, b.user_id) AS user_id, CASE WHEN b.user_id IS NULL THEN 'new'
          WHEN a.user_id IS NULL THEN 'missing' WHEN a.n = b.n THEN 'unchanged' ELSE 'changed' END AS status
        FROM b FULL OUTER JOIN a ON a.user_id = b.user_id""",
    "source_freshness": """SELECT user_id,
        CAST(date_diff('day', CAST(max(ts) AS DATE), DATE '2024-01-31') AS INTEGER) AS age_days,
        date_diff('day', CAST(max(ts) AS DATE), DATE '2024-01-31') <= 2 AS fresh FROM events GROUP BY 1""",
}

_SCOPED = re.compile(r"CAST\([\w.]+ AS VARCHAR\) LIKE '1714%'")
#: These run over every geography; only the published models and checks keep their cut.
for _name in (
    "coverage_gaps mart_region_overview_true_rates export_status export_roundtrip optional_table geo_options latest_cards trend_series "
    "district_ranking urban_rural_series men_women_series gap_warnings coverage_listing births_check"
).split():
    SQL[_name] = _SCOPED.sub("true", SQL[_name])
for _name in (
    "mart_region_overview_yearly mart_population_split_yearly mart_births_by_sex_yearly mart_metric_coverage reconciliation_report"
).split():
    SQL[f"{_name}_all"] = _SCOPED.sub("true", SQL[_name])
SQL["urban_rural_series_scoped"] = f"SELECT * FROM ({SQL['urban_rural_series']}) WHERE year BETWEEN 2011 AND 2014 AND geo_code = 1714207"
SQL["births_check_scoped"] = f"SELECT * FROM ({SQL['births_check']}) WHERE year BETWEEN 2011 AND 2013 AND geo_code = 1714207"
SQL["dq_suite_all"] = _SCOPED.sub("true", SQL["dq_suite"])
