"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL runs on the driver tables registered as views (customer, part, nation, orders,
events, pages, supplier, ...). It re-derives the fixture inbox, resolves headers with its own
LCS (list_reduce lambdas), and builds silver and gold with plain SQL, so it shares no code
path with the Spark implementation; only the fixed values (aliases, partial names, tokens,
formats, layouts) are rendered from the same constants.
"""

from __future__ import annotations

from driftsweep.schema import (
    ALIASES, DATE_TARGETS, GOLD_ORDER, GOLD_UPPER, NA_TOKENS, PARTIAL_NAMES, PY_WHITESPACE_CLASS,
    SILVER_ORDER, TARGETS,
)
from driftsweep.sources.fixtures import LAYOUTS, discover_ordinals


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values: list[str]) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


WS = PY_WHITESPACE_CLASS
DUCK_DATE_FORMATS = ("['%Y-%m-%d %H:%M:%S', '%Y-%m-%d', '%m/%d/%Y', '%b %d, %Y', '%Y%m%d', "
                     "'%Y-%m-%d %H:%M:%S.%f', '%Y-%m-%dT%H:%M:%S', '%m/%d/%Y %H:%M:%S', '%m/%d/%Y %H:%M', "
                     "'%m/%d/%Y %I:%M:%S %p', '%m/%d/%Y %I:%M %p']")

# The fixture view of FIXTURES.md §2, unchanged.
FX = """
ev AS (
  SELECT user_id,
         sum(CASE WHEN event_type='view'  THEN 1 ELSE 0 END) AS n_open,
         sum(CASE WHEN event_type='click' THEN 1 ELSE 0 END) AS n_click,
         max(CASE WHEN event_type='view'  THEN CAST(ts AS DATE) END) AS d_open,
         max(CASE WHEN event_type='click' THEN CAST(ts AS DATE) END) AS d_click,
         max(CASE WHEN event_type='error' THEN CAST(ts AS DATE) END) AS d_err
  FROM events GROUP BY user_id),
od AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS d_first, max(CAST(o_orderdate AS DATE)) AS d_last, count(*) AS n
       FROM orders GROUP BY o_custkey),
fx AS (
SELECT c.c_custkey AS src_row,
       CASE c.c_custkey % 4 WHEN 0 THEN 'canon' WHEN 1 THEN 'spaced' WHEN 2 THEN 'upper_S1' ELSE 'combined' END AS file_name,
       concat('u', CAST(c.c_custkey AS STRING), '@example.com') AS email,
       CASE WHEN c.c_custkey % 4 = 3 THEN p.p_name ELSE split_part(p.p_name, ' ', 1) END AS first_name,
       split_part(p.p_name, ' ', 2) AS last_name,
       n.n_name AS state,
       c.c_mktsegment AS campaign,
       c.c_name AS sub_key,
       concat('C', CAST(c.c_custkey % 97 AS STRING)) AS cid,
       CASE WHEN c.c_custkey % 5 = 0 THEN NULL ELSE concat('v', CAST(c.c_custkey % 7 AS STRING)) END AS var1,
       CASE WHEN c.c_custkey % 3 = 0 THEN 'N/A' ELSE 'w' END AS var2,
       CASE WHEN c.c_custkey % 4 = 1 THEN CAST(month(od.d_first) AS STRING) || '/' || CAST(day(od.d_first) AS STRING) || '/' || CAST(year(od.d_first) AS STRING)
            ELSE CAST(od.d_first AS STRING) END AS created,
       CAST(od.d_last AS STRING) AS modified,
       CAST(od.n AS STRING) AS sent,
       CAST(ev.n_open AS STRING) AS opens, CAST(ev.d_open AS STRING) AS open_date,
       CAST(ev.n_click AS STRING) AS clicks, CAST(ev.d_click AS STRING) AS click_date,
       CASE WHEN c.c_custkey % 11 = 0 THEN CAST(ev.d_err AS STRING) END AS hard_bounce
FROM customer c
JOIN part p ON p.p_partkey = c.c_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN od ON od.o_custkey = c.c_custkey
LEFT JOIN ev ON ev.user_id = c.c_custkey)"""

_FX_COLS = ["email", "first_name", "last_name", "state", "campaign", "sub_key", "cid", "var1", "var2",
            "created", "modified", "sent", "opens", "open_date", "clicks", "click_date", "hard_bounce"]

# The large lineitem export, as its text rows (src_row only needs to be unique per row).
LX = """lx AS (
  SELECT row_number() OVER () AS src_row, 'lineitem' AS file_name,
         'L' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS li_key,
         l_returnflag || l_linestatus AS li_campaign,
         CAST(l_quantity AS VARCHAR) AS li_sent,
         strftime(l_shipdate, '%Y-%m-%d') AS li_created,
         CAST(l_partkey AS VARCHAR) AS li_cid,
         CAST(l_suppkey AS VARCHAR) AS li_var1,
         CASE WHEN l_discount > CAST(0.05 AS DOUBLE) THEN strftime(l_shipdate, '%-m/%-d/%Y') END AS li_bounce
  FROM lineitem)"""
_LX_COLS = ["li_key", "li_campaign", "li_sent", "li_created", "li_cid", "li_var1", "li_bounce"]


def _layouts(hot: bool):
    """(file_name, source, fmt, ordinal, columns) per dataset of the inbox being modelled."""
    if not hot:
        ords = discover_ordinals()
        return [(l.file_name, l.source, l.fmt, ords[l.source], l.columns) for l in LAYOUTS]
    from driftsweep.sources.fixtures import LINEITEM_LAYOUT

    # the CSV inbox: every fixture dataset as <name>.csv plus the lineitem export
    entries = [(l.file_name, l.source if l.fmt == "csv" else f"{l.file_name}.csv", l.columns) for l in LAYOUTS]
    entries.append((LINEITEM_LAYOUT.file_name, LINEITEM_LAYOUT.source, LINEITEM_LAYOUT.columns))
    order = {src: i + 1 for i, src in enumerate(sorted(e[1] for e in entries))}
    return [(n, src, "csv", order[src], cols) for n, src, cols in entries]


def _layout_values(hot: bool = False) -> str:
    rows = []
    for name, src, fmt, ordinal, cols in _layouts(hot):
        for pos, (h, c) in enumerate(cols):
            rows.append(f"({q(name)}, {q(src)}, {q(fmt)}, {ordinal}, {pos}, {q(h)}, {q(c)})")
    return ",\n  ".join(rows)


def _alias_values() -> str:
    rows = []
    for t_no, (t, al) in enumerate(ALIASES.items()):
        for a_no, a in enumerate(al):
            rows.append(f"({t_no}, {q(t)}, {a_no}, {q(a)})")
    return ", ".join(rows)


def lcs_sql(a: str, b: str) -> str:
    """LCS length of two string expressions as a DuckDB list_reduce DP."""
    return f"""(CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 ELSE list_reduce(
      list_transform(range(1, length({a}) + 1), lambda i: substr({a}, i::BIGINT, 1)),
      lambda p, ch: list_reduce(range(1, length({b}) + 1),
          lambda c, j: list_append(c, CASE WHEN ch = substr({b}, j, 1) THEN p[j] + 1 ELSE greatest(p[j + 1], c[j]) END), [0]),
      list_transform(range(0, length({b}) + 1), lambda x: 0))[length({b}) + 1] END)"""


def ratio_sql(a: str, b: str, lcs: str) -> str:
    return f"(CASE WHEN length({a}) + length({b}) = 0 THEN 100.0::DOUBLE ELSE CAST(200 * {lcs} AS DOUBLE) / CAST(length({a}) + length({b}) AS DOUBLE) END)"


def date_sql(x: str) -> str:
    return f"coalesce(strftime(try_strptime({x}, {DUCK_DATE_FORMATS}), '%Y-%m-%d'), 'NaT')"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def _raw_value_case(alias: str = "fx", cols: list[str] = _FX_COLS) -> str:
    return "CASE l.col " + " ".join(f"WHEN {q(c)} THEN {alias}.{c}" for c in cols) + " END"


def chain(hot: bool = False) -> str:
    """All CTEs from the driver tables to gold. Every query selects from one of them."""
    targets_pivot = ",\n    ".join(f"max(v) FILTER (WHERE target = {q(t)}) AS {t}" for t in TARGETS)
    date_cols = ", ".join(f"{date_sql(t)} AS {t}" for t in DATE_TARGETS)
    split_cond = "(lastname IS NULL AND firstname IS NOT NULL AND contains(fn_strip, ' '))"
    parts = f"list_filter(regexp_split_to_array(fn_strip, '{WS}+'), lambda t: t <> '')"
    gold_cols = []
    for c in GOLD_ORDER:
        if c == "sourcefile":
            gold_cols.append("file_name AS sourcefile")
        elif c in GOLD_UPPER:
            gold_cols.append(f"upper({c}) AS {c}")
        elif c in DATE_TARGETS:
            gold_cols.append(f"(CASE WHEN {c} LIKE 'NaT' THEN NULL ELSE {c} END) AS {c}")
        else:
            gold_cols.append(c)
    lx_cte = f",\n{LX}" if hot else ""
    lx_raw = (f"""
  UNION ALL
  SELECT lx.src_row, l.file_name, l.source, l.fmt, l.file_ordinal, l.pos, l.header, {_raw_value_case('lx', _LX_COLS)} AS v
  FROM lx JOIN layout l ON l.file_name = lx.file_name""" if hot else "")
    lx_rows = "\n    UNION ALL SELECT file_name, count(*) FROM lx GROUP BY file_name" if hot else ""
    return f"""WITH {FX}{lx_cte},
layout(file_name, source, fmt, file_ordinal, pos, header, col) AS (VALUES
  {_layout_values(hot)}),
raw AS (
  SELECT fx.src_row, l.file_name, l.source, l.fmt, l.file_ordinal, l.pos, l.header, {_raw_value_case()} AS v
  FROM fx JOIN layout l ON l.file_name = fx.file_name{lx_raw}),
cells AS (
  SELECT src_row, file_name, source, fmt, file_ordinal, pos, header,
         CASE WHEN v IN {in_list(NA_TOKENS)} THEN NULL ELSE v END AS value
  FROM raw),
ds AS (
  SELECT l.file_name, l.source, l.fmt, l.file_ordinal, count(DISTINCT l.pos) AS n_cols,
         coalesce(max(r.n_rows), 0) AS n_rows
  FROM layout l LEFT JOIN (SELECT file_name, count(*) AS n_rows FROM fx GROUP BY file_name{lx_rows}) r USING (file_name)
  GROUP BY ALL),
partials(p) AS (VALUES {", ".join(f"({q(p)})" for p in PARTIAL_NAMES)}),
gates AS (
  SELECT ds.*,
         (n_cols >= 2 AND n_rows >= CASE fmt WHEN 'csv' THEN 2 ELSE 1 END) AS shape_ok,
         EXISTS (SELECT 1 FROM layout h, partials pp WHERE h.file_name = ds.file_name AND contains(h.header, pp.p)) AS gate_ok
  FROM ds),
acc AS (SELECT * FROM gates WHERE shape_ok AND gate_ok),
aliases(target_no, target, alias_no, alias) AS (VALUES {_alias_values()}),
sc AS (
  SELECT h.file_name, h.source, h.pos, h.header, a.target_no, a.target, a.alias_no, a.alias,
         {lcs_sql('a.alias', 'h.header')} AS lcs
  FROM layout h JOIN acc ON acc.file_name = h.file_name AND acc.source = h.source CROSS JOIN aliases a),
sc2 AS (
  SELECT *, {ratio_sql('alias', 'header', 'lcs')} AS score,
         200 * lcs > 80 * (length(alias) + length(header)) AS passes
  FROM sc),
best AS (
  SELECT * EXCLUDE (rk) FROM (
    SELECT *, row_number() OVER (PARTITION BY file_name, source, target_no, alias_no ORDER BY score DESC, pos) AS rk FROM sc2)
  WHERE rk = 1),
cnt AS (
  SELECT file_name, source, header, count(*) FILTER (WHERE value IS NOT NULL AND value NOT IN ('', ' ')) AS n_non_blank
  FROM cells GROUP BY ALL),
rep AS (
  SELECT b.file_name, b.source, b.target_no, b.target, b.alias_no, b.alias, b.header AS found, b.pos AS found_pos,
         b.score, b.passes, coalesce(c.n_non_blank, 0) AS row_count
  FROM best b LEFT JOIN cnt c ON c.file_name = b.file_name AND c.source = b.source AND c.header = b.header),
fsel AS (
  SELECT * EXCLUDE (rk) FROM (
    SELECT *, row_number() OVER (PARTITION BY file_name, source, target_no ORDER BY score DESC, alias_no) AS rk FROM rep)
  WHERE rk = 1),
csel AS (
  SELECT * EXCLUDE (rk) FROM (
    SELECT *, row_number() OVER (PARTITION BY file_name, source, target_no ORDER BY row_count DESC, alias_no) AS rk FROM rep)
  WHERE rk = 1),
dec AS (
  SELECT f.file_name, f.source, f.target_no, f.target, f.alias_no AS i_score, c.alias_no AS i_count, f.found,
         f.score, f.row_count, (f.passes AND (f.alias_no <> c.alias_no OR f.row_count > 0)) AS resolved
  FROM fsel f JOIN csel c ON c.file_name = f.file_name AND c.source = f.source AND c.target_no = f.target_no),
mp AS (SELECT file_name, source, target, found FROM dec WHERE resolved),
lng AS (
  SELECT x.file_name, x.source, x.file_ordinal, x.src_row, m.target, coalesce(x.value, '') AS v
  FROM cells x JOIN mp m ON m.file_name = x.file_name AND m.source = x.source AND m.found = x.header),
proj AS (
  SELECT file_name, source, file_ordinal, src_row,
    {targets_pivot}
  FROM lng GROUP BY file_name, source, file_ordinal, src_row),
dated AS (SELECT * REPLACE ({date_cols}) FROM proj),
named AS (
  SELECT * EXCLUDE (fn_strip) REPLACE (
      CASE WHEN {split_cond} THEN {parts}[1] ELSE firstname END AS firstname,
      CASE WHEN {split_cond} THEN array_to_string({parts}[2:], ' ') ELSE lastname END AS lastname)
  FROM (SELECT *, {strip_sql('firstname')} AS fn_strip FROM dated)),
filled AS (SELECT * REPLACE (coalesce(cid, concat_ws('', var1, var2, var3, var4)) AS cid) FROM named),
silver AS (
  SELECT (row_number() OVER (ORDER BY file_ordinal, src_row) - 1) AS rowid, * FROM filled),
gold AS (SELECT {", ".join(gold_cols)} FROM silver)
"""


def silver_select() -> str:
    return ", ".join(SILVER_ORDER)


def targets_select() -> str:
    return ", ".join(TARGETS)
