"""SQL twins of the registered queries, for DuckDB over the same tables.

Each string is a complete statement: a shared chain of common table
expressions (the adapter, the record sets, the join, the spine, prepared
and antibiotic rows), written independently of the DataFrame code, followed
by the query's own SELECT. Column names and types are chosen to match the
Spark results (counts as BIGINT, shares as DOUBLE).
"""

from __future__ import annotations

from rxcover import codes
from rxcover.plans import queries as q


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case_map(expr: str, mapping: dict[str, str], default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {_lit(k)} THEN {_lit(v)}" for k, v in mapping.items())
    return f"CASE {expr} {whens} ELSE {default} END"


_RULES = codes.FALLBACK_RULES


def _rule_case() -> str:
    whens = " ".join(f"WHEN ddd IS NULL AND contains(lower(vmp_nm), {_lit(frag)}) THEN {i}"
                     for i, (frag, _, _, _) in enumerate(_RULES))
    return f"CASE {whens} END"


def _by_rule(pos: int, as_double: bool = False) -> str:
    def v(x):
        return f"CAST({x!r} AS DOUBLE)" if as_double else _lit(x)
    whens = " ".join(f"WHEN {i} THEN {v(r[pos])}" for i, r in enumerate(_RULES))
    return f"CASE rule {whens} END"


def _to_mg(v: str, u: str) -> str:
    whens = " ".join(f"WHEN {_lit(unit)} THEN {v} {op} CAST({factor!r} AS DOUBLE)"
                     for unit, (op, factor) in codes.MG_CONVERSIONS.items())
    return f"CASE WHEN {v} IS NULL OR isnan({v}) THEN NULL ELSE CASE lower(trim({u})) {whens} END END"


def _spine_cte(name: str, unit_first: bool) -> str:
    if unit_first:
        unit = (f"coalesce(nullif(CASE WHEN rule IS NOT NULL AND (uom_raw IS NULL OR uom_raw = '') "
                f"THEN {_by_rule(2)} ELSE uom_raw END, ''), 'mg')")
    else:
        unit = "uom_def"
    return f"""
{name}_patched AS (
  SELECT vpid, vmp_nm, vtmid, vpid_prev, bnf_code,
         CASE WHEN rule IS NOT NULL AND atc_code IS NULL THEN {_by_rule(3)} ELSE atc_code END AS atc_code,
         CASE WHEN rule IS NOT NULL THEN {_by_rule(1, True)} ELSE ddd END AS ddd,
         CASE WHEN rule IS NOT NULL AND uom_def IS NULL THEN {_by_rule(2)} ELSE {unit} END AS ddd_uom,
         rule
  FROM ruled),
{name} AS (
  SELECT vpid, vmp_nm, vtmid, vpid_prev, bnf_code, atc_code, ddd, ddd_uom,
         {_to_mg('ddd', 'ddd_uom')} AS ddd_mg
  FROM {name}_patched)"""


_STATUS4 = """CASE WHEN has_atc AND has_bnf THEN 'ATC + BNF' WHEN has_bnf AND NOT has_atc THEN 'BNF only'
       WHEN has_atc AND NOT has_bnf THEN 'ATC only' WHEN NOT has_bnf AND NOT has_atc THEN 'Unmapped' END"""
_STATUS3 = """CASE WHEN has_atc AND has_bnf THEN 'ATC + BNF' WHEN has_bnf AND NOT has_atc THEN 'BNF only'
       WHEN NOT has_bnf AND NOT has_atc THEN 'Unmapped' END"""


def _group_other(c: str) -> str:
    return f"coalesce({_case_map(c, codes.ATC_GROUP_LABELS)}, 'Other (' || coalesce({c}, 'NA') || ')')"


def _group_code(c: str) -> str:
    return f"coalesce({_case_map(c, codes.ATC_GROUP_LABELS)}, {c})"


def _class_other(c: str) -> str:
    return f"coalesce({_case_map(c, codes.J01_SUBCLASS_LABELS)}, 'Other (' || coalesce({c}, 'NA') || ')')"


def _class_code(c: str) -> str:
    return f"coalesce({_case_map(c, codes.J01_SUBCLASS_LABELS)}, {c})"


def _comma(n: str) -> str:
    return f"format('{{:,}}', {n})"


def _pct(x: str, decimals: int) -> str:
    return f"printf('%.{decimals}f', round_even({x} * 100, {decimals})) || '%'"


CTE = f"""WITH
vmp AS (
  SELECT CAST(p_partkey AS VARCHAR) AS vpid,
         CASE WHEN p_partkey % 40 = 3 THEN ''
              WHEN p_partkey % 40 = 0 THEN 'Co-Amoxiclav ' || p_name
              WHEN p_partkey % 40 = 1 THEN 'Co-fluampicil ' || p_name
              WHEN p_partkey % 40 = 2 THEN 'Piperacillin / Tazobactam ' || p_name
              ELSE p_name END AS vmp_nm,
         CASE WHEN p_size % 5 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS vtmid,
         CASE WHEN p_partkey % 10 = 1 THEN CAST(p_partkey - 1 AS VARCHAR) ELSE '' END AS vpid_prev
  FROM part),
bnf_raw AS (
  SELECT CASE l_partkey % 7 WHEN 0 THEN printf('X%d', l_partkey) ELSE CAST(l_partkey AS VARCHAR) END AS vpid,
         CASE WHEN l_suppkey % 5 = 0 THEN ''
              WHEN l_suppkey % 5 IN (1, 2) THEN '0501' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0')
              ELSE '0407' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') END AS bnf_code,
         CASE WHEN l_suppkey % 6 = 0 THEN ''
              WHEN l_suppkey % 6 IN (1, 2) THEN 'J01' || substr('ABCDEFGMRXZ', CAST(1 + l_partkey % 11 AS INTEGER), 1)
                   || substr('AEFR', CAST(1 + l_suppkey % 4 AS INTEGER), 1) || lpad(CAST(l_suppkey % 20 AS VARCHAR), 2, '0')
              ELSE substr('ABCDGHJLMNPRSVQ', CAST(1 + l_partkey % 15 AS INTEGER), 1) || '02BE01' END AS atc_code,
         CASE WHEN l_linenumber = 1 THEN '' WHEN l_linenumber = 2 THEN 'n/a'
              ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS ddd,
         CASE l_suppkey % 9 WHEN 0 THEN '258684004' WHEN 1 THEN '258682000' WHEN 2 THEN '258685003'
              WHEN 3 THEN '258774008' WHEN 4 THEN '396186001' ELSE '' END AS ddd_uomcd,
         CASE l_suppkey % 9 WHEN 5 THEN ' G ' WHEN 6 THEN 'kg' WHEN 7 THEN 'µg' WHEN 0 THEN 'ignored'
              ELSE '' END AS ddd_uom_text
  FROM lineitem),
bnf AS (
  SELECT vpid, trim(bnf_code) AS bnf_code, trim(atc_code) AS atc_code, trim(ddd) AS ddd,
         coalesce({_case_map('u', codes.UNIT_CODES)}, u) AS ddd_uom
  FROM (SELECT *, CASE WHEN trim(ddd_uomcd) <> '' THEN trim(ddd_uomcd) ELSE trim(ddd_uom_text) END AS u
        FROM bnf_raw)),
joined AS (
  SELECT v.vpid, v.vmp_nm, v.vtmid, v.vpid_prev, b.bnf_code, b.atc_code,
         TRY_CAST(b.ddd AS DOUBLE) AS ddd, b.ddd_uom AS uom_raw
  FROM vmp v LEFT JOIN bnf b ON v.vpid = b.vpid),
ruled AS (
  SELECT *, coalesce(nullif(uom_raw, ''), 'mg') AS uom_def, {_rule_case()} AS rule
  FROM joined),{_spine_cte('spine', False)},{_spine_cte('spine_uf', True)},
prepared AS (
  SELECT *, {_STATUS4} AS mapping_status,
         coalesce(starts_with(atc_code, 'J01') OR starts_with(bnf_code, '0501'), false) AS is_antibiotic
  FROM (SELECT *, substr(atc_code, 1, 1) AS atc_level1_code, substr(atc_code, 1, 3) AS atc_level2_code,
               substr(atc_code, 1, 4) AS atc_level3_code, substr(atc_code, 1, 5) AS atc_level4_code,
               (bnf_code IS NOT NULL AND bnf_code <> '') AS has_bnf,
               (atc_code IS NOT NULL AND atc_code <> '') AS has_atc
        FROM spine)),
antibiotics AS (
  SELECT *, {_class_other('atc_level3_code')} AS j01_class
  FROM prepared WHERE starts_with(atc_code, 'J01') OR starts_with(bnf_code, '0501')),
lookup AS (
  SELECT atc_code, ddd, ddd_uom, ddd_mg,
         coalesce(array_to_string(list_sort(list_distinct(
             list(vmp_nm) FILTER (WHERE vmp_nm IS NOT NULL AND length(vmp_nm) > 0))), ' | '), '') AS drug_names
  FROM spine WHERE ddd IS NOT NULL
  GROUP BY atc_code, ddd, ddd_uom, ddd_mg)
"""


def _coverage(where: str = "") -> str:
    return f"""SELECT mapping_status, n, n / sum(n) OVER () AS pct
FROM (SELECT mapping_status, count(*) AS n FROM prepared {where} GROUP BY mapping_status)"""


def _shown(c: str) -> str:
    if c in ("ddd", "ddd_mg"):
        return (f"coalesce(rtrim(rtrim(CAST(TRY_CAST({c} AS DECIMAL(38, 18)) AS VARCHAR), '0'), '.'), "
                f"CAST({c} AS VARCHAR))")
    return c


def _column_test(c: str, wanted) -> str:
    if isinstance(wanted, tuple):
        return f"{c} BETWEEN {wanted[0]!r} AND {wanted[1]!r}"
    return f"coalesce(contains(lower({_shown(c)}), {_lit(wanted.lower())}), false)"


def _search_word(w: str) -> str:
    cols = ("atc_code", "ddd", "ddd_uom", "ddd_mg", "drug_names")
    return "(" + " OR ".join(f"coalesce(contains(lower({_shown(c)}), {_lit(w.lower())}), false)"
                             for c in cols) + ")"


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


# The names that need quoting, by the last character of the key.
_ODD_NAME = """CASE ascii(right(vpid, 1)) % 8 WHEN 0 THEN 'a "quoted", ' || vmp_nm WHEN 1 THEN vmp_nm || chr(10) || 'next line'
       WHEN 2 THEN '  ' || vmp_nm || ' ' WHEN 3 THEN vmp_nm || chr(92) WHEN 4 THEN '"' || vmp_nm
       WHEN 5 THEN vmp_nm || chr(13) || chr(10) || 'x' ELSE vmp_nm END"""

BODIES: dict[str, str] = {
    # sources
    "xml_vmp_records": "SELECT * FROM vmp",
    "xml_bnf_records": "SELECT * FROM bnf",
    "strip_namespace": """SELECT p_partkey,
  CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 3 = 0 THEN p_name
       WHEN p_partkey % 5 = 1 THEN '{urn:a}{' || p_brand || '}' || p_type
       ELSE '{http://example.org/' || p_brand || '}' || p_name END AS tag_text,
  CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 3 = 0 THEN p_name
       WHEN p_partkey % 5 = 1 THEN p_type ELSE p_name END AS tag
FROM part""",
    "trim_text": "SELECT p_partkey, p_name AS trimmed FROM part",
    "load_status": f"""SELECT 'part' AS source, true AS file_exists, count(*) AS rows,
       'Loaded ' || {_comma('count(*)')} || ' records.' AS message FROM part
UNION ALL SELECT 'lineitem', true, count(*), 'Loaded ' || {_comma('count(*)')} || ' records.' FROM lineitem
UNION ALL SELECT 'spine', false, CAST(NULL AS BIGINT), {_lit(codes.MISSING_MESSAGE)}""",
    # sinks
    "roundtrip_parquet": "SELECT * FROM spine",
    "roundtrip_csv": f"""SELECT nullif(vpid, '') AS vpid, nullif({_ODD_NAME}, '') AS vmp_nm, nullif(vtmid, '') AS vtmid,
       nullif(vpid_prev, '') AS vpid_prev, nullif(bnf_code, '') AS bnf_code, nullif(atc_code, '') AS atc_code,
       ddd, nullif(ddd_uom, '') AS ddd_uom, ddd_mg FROM spine""",
    "catalog_tables": "SELECT * FROM spine",
    # build
    "spine": "SELECT * FROM spine",
    "spine_sorted": "SELECT * FROM spine",
    "spine_unit_first": "SELECT * FROM spine_uf",
    "duplicate_keys": "SELECT vpid, count(*) AS n FROM bnf GROUP BY vpid HAVING count(*) > 1",
    "uom_resolve": "SELECT vpid, bnf_code, atc_code, ddd, ddd_uom FROM bnf",
    "ddd_numeric": "SELECT vpid, ddd AS ddd_text, TRY_CAST(ddd AS DOUBLE) AS ddd FROM bnf",
    "uom_default": "SELECT ddd_uom, count(*) AS n FROM spine GROUP BY ddd_uom",
    "ddd_fallback": f"""SELECT vpid, vmp_nm, bnf_code, atc_code, ddd, ddd_uom, {_by_rule(0)} AS fallback_rule
FROM spine_patched WHERE rule IS NOT NULL""",
    "ddd_to_mg": """SELECT ddd_uom, count(ddd) AS n_ddd, count(ddd_mg) AS n_mg, min(ddd_mg) AS min_mg,
       max(ddd_mg) AS max_mg FROM spine GROUP BY ddd_uom""",
    "uom_top10": "SELECT ddd_uom, count(*) AS n FROM bnf GROUP BY ddd_uom ORDER BY n DESC, ddd_uom NULLS FIRST LIMIT 10",
    "build_metrics": """SELECT 'vmp_rows' AS metric, count(*) AS value FROM vmp
UNION ALL SELECT 'bnf_rows', count(*) FROM bnf
UNION ALL SELECT 'spine_rows', count(*) FROM spine
UNION ALL SELECT 'non_null_atc', count(atc_code) FROM spine
UNION ALL SELECT 'with_atc', count(*) FILTER (WHERE atc_code IS NOT NULL AND atc_code <> '') FROM spine""",
    # classification
    "prepared": "SELECT * FROM prepared",
    "atc_levels": """SELECT atc_code, atc_level1_code, atc_level2_code, atc_level3_code, atc_level4_code, count(*) AS n
FROM prepared GROUP BY ALL""",
    "coverage_flags": "SELECT has_bnf, has_atc, count(*) AS n FROM prepared GROUP BY has_bnf, has_atc",
    "mapping_status3": f"SELECT {_STATUS3} AS mapping_status, count(*) AS n FROM prepared GROUP BY 1",
    "mapping_status4": "SELECT mapping_status, count(*) AS n FROM prepared GROUP BY mapping_status",
    "antibiotic_atc": "SELECT starts_with(atc_code, 'J01') AS is_antibiotic, count(*) AS n FROM prepared GROUP BY 1",
    "antibiotic_any": "SELECT is_antibiotic, count(*) AS n FROM prepared GROUP BY is_antibiotic",
    "antibiotics": "SELECT * FROM antibiotics",
    "atc_group_labels": f"""SELECT atc_level1_code, n, {_group_other('atc_level1_code')} AS group_other,
       {_group_code('atc_level1_code')} AS group_code
FROM (SELECT atc_level1_code, count(*) AS n FROM prepared GROUP BY atc_level1_code)""",
    # reports
    "coverage": _coverage(),
    "coverage_labels": f"""SELECT mapping_status, n, pct,
       {_comma('n')} || chr(10) || '(' || {_pct('pct', 1)} || ')' AS label, {_pct('pct', 1)} AS pct_label
FROM ({_coverage()})""",
    "group_filter": _coverage("WHERE " + " OR ".join(
        f"starts_with(atc_code, {_lit(c)})" for c, v in codes.ATC_GROUP_LABELS.items() if v == q.GROUP_PARAMETER)),
    "group_filter_empty": f"""SELECT mapping_status, n, pct, CAST(NULL AS VARCHAR) AS label, CAST(NULL AS VARCHAR) AS pct_label FROM ({_coverage("WHERE false")})""",
    "group_coverage": f"""SELECT atc_group, mapping_status, n,
       CAST(sum(n) OVER (PARTITION BY atc_group) AS BIGINT) AS group_total,
       n / sum(n) OVER (PARTITION BY atc_group) AS pct
FROM (SELECT {_group_other('atc_level1_code')} AS atc_group, mapping_status, count(*) AS n
      FROM prepared WHERE has_atc GROUP BY 1, 2)""",
    "group_gap_rate": f"""SELECT *, {_pct('pct_unmapped', 0)} AS label FROM (SELECT atc_group, total, unmapped, unmapped / total AS pct_unmapped
FROM (SELECT {_group_code('atc_level1_code')} AS atc_group, count(*) AS total, count(*) FILTER (WHERE NOT has_atc) AS unmapped
      FROM prepared WHERE atc_code IS NOT NULL AND atc_code <> '' GROUP BY 1)
WHERE total >= {codes.MIN_GROUP_SIZE})""",
    "abx_subclass": """SELECT j01_class, mapping_status, n, CAST(sum(n) OVER (PARTITION BY j01_class) AS BIGINT) AS total,
       n / sum(n) OVER (PARTITION BY j01_class) AS pct
FROM (SELECT j01_class, mapping_status, count(*) AS n FROM antibiotics GROUP BY 1, 2)""",
    "abx_subclass_total": f"SELECT j01_class, count(*) AS total, {_comma('count(*)')} AS label FROM antibiotics GROUP BY j01_class",
    "abx_level4": f"""SELECT atc_level4_code, atc_level3_code, n, j01_class,
       n / sum(n) OVER (PARTITION BY j01_class) AS pct_within_class
FROM (SELECT atc_level4_code, atc_level3_code, count(*) AS n, {_class_code('atc_level3_code')} AS j01_class
      FROM antibiotics WHERE has_atc GROUP BY 1, 2)""",
    "abx_ddd": """SELECT j01_class, total, with_ddd, with_ddd / total AS pct_ddd
FROM (SELECT j01_class, count(*) AS total, count(*) FILTER (WHERE ddd IS NOT NULL) AS with_ddd FROM antibiotics GROUP BY 1)""",
    "abx_ddd_labels": f"""SELECT j01_class, total, with_ddd, pct_ddd,
       {_pct('pct_ddd', 0)} || chr(10) || '(' || CAST(with_ddd AS VARCHAR) || '/' || CAST(total AS VARCHAR) || ')' AS label
FROM (SELECT j01_class, total, with_ddd, with_ddd / total AS pct_ddd
      FROM (SELECT j01_class, count(*) AS total, count(*) FILTER (WHERE ddd IS NOT NULL) AS with_ddd FROM antibiotics GROUP BY 1))""",
    "abx_gap": f"""SELECT status, n, pct, {_comma('n')} || chr(10) || '(' || {_pct('pct', 1)} || ')' AS label
FROM (SELECT status, n, n / sum(n) OVER () AS pct
      FROM (SELECT CASE WHEN has_atc THEN {_lit(codes.GAP_MAPPED)} ELSE {_lit(codes.GAP_MISSING)} END AS status,
                   count(*) AS n FROM antibiotics GROUP BY 1))""",
    "abx_gap_status": "SELECT mapping_status, count(*) AS n FROM antibiotics WHERE NOT has_atc GROUP BY mapping_status",
    "abx_status_long": f"""SELECT total, status, n, n / total AS pct, {_pct('n / total', 1)} AS label FROM (
  SELECT total, 'ATC + BNF' AS status, fully_mapped AS n FROM w
  UNION ALL SELECT total, 'BNF only', bnf_only FROM w
  UNION ALL SELECT total, 'Unmapped', unmapped FROM w)""",
    "summary": f"""SELECT total, with_bnf, with_bnf / total * 100 AS pct_bnf, with_atc, with_atc / total * 100 AS pct_atc,
       antibiotics, {_lit(codes.TOTAL_TEXT)} || {_comma('total')} AS label
FROM (SELECT count(*) AS total, count(*) FILTER (WHERE has_bnf) AS with_bnf, count(*) FILTER (WHERE has_atc) AS with_atc,
             count(*) FILTER (WHERE is_antibiotic) AS antibiotics FROM prepared)""",
    "abx_missing": "SELECT " + ", ".join(f"{c} AS {_quoted(h)}" for c, h in codes.ABX_MISSING_HEADERS.items())
                   + " FROM antibiotics WHERE NOT has_atc",
    # dose explorer
    "ddd_lookup": "SELECT * FROM lookup",
    "ddd_lookup_names": """SELECT DISTINCT atc_code, ddd, ddd_uom, ddd_mg, vmp_nm AS drug_name FROM spine
WHERE ddd IS NOT NULL AND vmp_nm IS NOT NULL AND length(vmp_nm) > 0""",
    "ddd_search": "SELECT * FROM lookup WHERE " + " AND ".join(_search_word(w) for w in q.SEARCH_TERM.split()),
    "ddd_search_columns": "SELECT * FROM lookup WHERE " + " AND ".join(
        _column_test(c, t) for c, t in q.SEARCH_COLUMNS.items()),
    "ddd_search_indexed": "SELECT * FROM lookup WHERE " + " AND ".join(_search_word(w) for w in q.SEARCH_TERM.split())
                          + " UNION ALL SELECT * FROM lookup WHERE " + " AND ".join(
                              _column_test(c, t) for c, t in q.SEARCH_COLUMNS.items()),
    "page_of_table": f"""SELECT * FROM lookup ORDER BY atc_code NULLS LAST, ddd NULLS LAST, ddd_uom NULLS LAST,
  ddd_mg NULLS LAST LIMIT {codes.DDD_LOOKUP_PAGE_SIZE} OFFSET {(q.LOOKUP_PAGE - 1) * codes.DDD_LOOKUP_PAGE_SIZE}""",
    "abx_missing_page": "SELECT " + ", ".join(f"{c} AS {_quoted(h)}" for c, h in codes.ABX_MISSING_HEADERS.items())
                        + " FROM antibiotics WHERE NOT has_atc ORDER BY vmp_nm NULLS LAST, vpid, bnf_code NULLS LAST,"
                        + f" mapping_status NULLS LAST LIMIT {codes.ABX_MISSING_PAGE_SIZE}"
                        + f" OFFSET {(q.ABX_MISSING_PAGE - 1) * codes.ABX_MISSING_PAGE_SIZE}",
    "report_cube": """SELECT atc_level1_code, atc_level3_code, atc_level4_code, has_atc, has_bnf, mapping_status,
       is_antibiotic, ddd IS NOT NULL AS has_ddd, count(*) AS _rows FROM prepared GROUP BY ALL""",
    "ddd_lookup_display": "SELECT " + ", ".join(f"{c} AS {_quoted(h)}" for c, h in codes.DDD_LOOKUP_HEADERS.items())
                          + " FROM lookup",
}

# Extra CTEs some bodies need.
_EXTRA = {
    "abx_status_long": """, w AS (SELECT count(*) AS total, count(*) FILTER (WHERE has_atc AND has_bnf) AS fully_mapped,
       count(*) FILTER (WHERE has_bnf AND NOT has_atc) AS bnf_only, count(*) FILTER (WHERE NOT has_bnf AND NOT has_atc) AS unmapped
  FROM antibiotics)
""",
}

# Report name -> the body whose rows that report holds.
_REPORT_BODY = {name: name for name in q.rp.REPORT_NAMES}
_REPORT_BODY.update({"coverage": "coverage_labels", "abx_ddd": "abx_ddd_labels"})
# Columns of each report, and those that are shares.
_REPORT_COLUMNS = {
    "coverage": "label mapping_status n pct pct_label", "group_coverage": "atc_group group_total mapping_status n pct",
    "group_gap_rate": "atc_group label pct_unmapped total unmapped", "abx_subclass": "j01_class mapping_status n pct total",
    "abx_subclass_total": "j01_class label total", "abx_level4": "atc_level3_code atc_level4_code j01_class n pct_within_class",
    "abx_ddd": "j01_class label pct_ddd total with_ddd", "abx_status_long": "label n pct status total",
    "abx_gap": "label n pct status", "abx_gap_status": "mapping_status n",
    "summary": "antibiotics label pct_atc pct_bnf total with_atc with_bnf",
}


def _line(columns: str) -> str:
    parts = []
    for c in columns.split():
        x = f"CAST(round({c} * 1000000) AS BIGINT)" if c.startswith("pct") and c != "pct_label" else c
        parts.append(f"'{c}=' || coalesce(CAST({x} AS VARCHAR), '-')")
    return " || ';' || ".join(parts)


BODIES["write_reports"] = "\nUNION ALL ".join(
    f"SELECT {_lit(name)} AS report, {_line(_REPORT_COLUMNS[name])} AS line FROM ({BODIES[body]})"
    for name, body in _REPORT_BODY.items())
_EXTRA["write_reports"] = _EXTRA["abx_status_long"]


def sql(name: str) -> str:
    return CTE + _EXTRA.get(name, "") + BODIES[name]


def oracle_sql() -> dict[str, str]:
    return {name: sql(name) for name in BODIES}
