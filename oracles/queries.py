"""DuckDB SQL per registered query; column names equal the Spark query's."""

from __future__ import annotations

from driftsweep.schema import DATE_TARGETS, GOLD_ORDER, NA_TOKENS, TARGETS
from oracles.duck import DUCK_DATE_FORMATS, chain, date_sql, in_list, lcs_sql, ratio_sql, silver_select

NAMES_FROM_PAGES = """names AS (
  SELECT page_id, url,
         'p' || CAST(page_id AS VARCHAR) || '_' || regexp_extract(url, '://([^/]+)', 1) ||
         CASE page_id % 6 WHEN 0 THEN '.csv' WHEN 1 THEN '.xlsx' WHEN 2 THEN '.xls' WHEN 3 THEN '.CSV'
                          WHEN 4 THEN '.txt' ELSE '.csv.xlsx' END AS file
  FROM pages)"""

MIXED_DATES = """mixed AS (
  SELECT o_orderkey, CAST(o_orderkey % 8 AS INTEGER) AS form,
         CASE o_orderkey % 8
           WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
           WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
           WHEN 2 THEN strftime(o_orderdate, '%-m/%-d/%Y')
           WHEN 3 THEN strftime(o_orderdate, '%b %-d, %Y')
           WHEN 4 THEN strftime(o_orderdate, '%Y%m%d')
           WHEN 5 THEN strftime(o_orderdate, '%d/%m/%Y')
           WHEN 6 THEN 'abc'
           ELSE '' END AS raw
  FROM orders)"""

NON_BLANK = "({x} IS NOT NULL AND {x} NOT IN ('', ' '))"


def _nb(x: str) -> str:
    return NON_BLANK.format(x=x)


def _raw_case(alias: str) -> str:
    from oracles.duck import _FX_COLS

    return "CASE l.col " + " ".join(f"WHEN '{c}' THEN {alias}.{c}" for c in _FX_COLS) + " END"


def sql() -> dict[str, str]:
    c = chain()
    t = ", ".join(TARGETS)
    d = ", ".join(DATE_TARGETS)
    out = {
        "gold_harmonise": f"{c} SELECT * FROM gold",
        "silver_order": f"{c} SELECT {silver_select()} FROM silver",
        "silver_project": f"{c} SELECT file_name, src_row, {t} FROM proj",
        "resolver": f"{c} SELECT file_name, target, i_score, i_count, found, score, row_count, resolved FROM dec",
        "match_report": f"{c} SELECT file_name, target, alias_no, alias AS query, found, score, row_count FROM rep",
        "best_header": f"{c} SELECT file_name, target, alias_no, found, found_pos, score FROM rep",
        "non_blank_counts": f"{c} SELECT file_name, header, n_non_blank FROM cnt",
        "date_normalise": f"{c} SELECT file_name, src_row, {d} FROM filled",
        "silver_date_rejects": f"""WITH {MIXED_DATES}
            SELECT 'dates' AS file_name, 'createddate' AS target,
                   count(*) FILTER (WHERE {_nb('raw')} AND try_strptime(raw, {DUCK_DATE_FORMATS}) IS NULL) AS n_rejects,
                   count(*) FILTER (WHERE {_nb('raw')}) AS n_values FROM mixed""",
        "split_name": f"{c} SELECT file_name, src_row, firstname, lastname FROM filled",
        "fill_cid": f"{c} SELECT file_name, src_row, cid, var1, var2, var3, var4 FROM filled",
        "rowid": f"{c} SELECT rowid, file_name, emailaddress FROM silver",
        "lineage": f"{c} SELECT file_name, count(*) AS n_rows FROM filled GROUP BY file_name",
        "min_shape": f"{c} SELECT file_name, fmt, n_rows, n_cols, shape_ok FROM gates",
        "header_gate": f"{c} SELECT file_name, gate_ok, (shape_ok AND gate_ok) AS accepted FROM gates",
        "sheet_shape": f"""{c} SELECT file_name, fmt, n_rows, n_cols,
                              CASE WHEN fmt = 'csv' THEN n_rows ELSE n_rows + 1 END AS max_row FROM ds""",
        "audit_datasets": f"{c} SELECT file_name, source, fmt, n_rows, n_cols FROM ds",
        "read_success_count": f"{c} SELECT count(DISTINCT source) AS n_read FROM ds",
        "preview": f"""{c} SELECT file_name, src_row, preview_no FROM (
              SELECT file_name, src_row, row_number() OVER (PARTITION BY file_name ORDER BY src_row) AS preview_no
              FROM fx) WHERE preview_no <= 10""",
        "non_blank": f"""{c} SELECT file_name, header,
              count(*) FILTER (WHERE value IS NULL) AS n_null,
              count(*) FILTER (WHERE value IN ('', ' ')) AS n_blank,
              count(*) FILTER (WHERE {_nb('value')}) AS n_non_blank
            FROM cells GROUP BY file_name, header""",
        "na_tokens": f"""{c} SELECT file_name, header,
              count(*) FILTER (WHERE v IN {in_list(NA_TOKENS)}) AS n_na,
              count(*) FILTER (WHERE v IS NULL OR v IN {in_list(NA_TOKENS)}) AS n_null_after
            FROM raw GROUP BY file_name, header""",
        "indel_ratio": f"""WITH l AS (SELECT p_partkey, p_name, p_type, {lcs_sql('p_name', 'p_type')} AS lcs FROM part)
            SELECT p_partkey, p_name, p_type, CAST(lcs AS INTEGER) AS lcs, {ratio_sql('p_name', 'p_type', 'lcs')} AS score FROM l""",
        "score_threshold": f"""WITH x AS (SELECT p_partkey, p_type,
              CASE WHEN p_partkey % 2 = 0 THEN replace(p_type, 'E', '') ELSE p_name END AS other FROM part),
            l AS (SELECT *, {lcs_sql('p_type', 'other')} AS lcs FROM x)
            SELECT p_partkey, p_type, other, {ratio_sql('p_type', 'other', 'lcs')} AS score,
                   200 * lcs > 80 * (length(p_type) + length(other)) AS passes FROM l""",
        "clean_header": """SELECT p_partkey, p_type, trim(lower(regexp_replace(p_type, '[^a-zA-Z]', '', 'g'))) AS cleaned FROM part""",
        "date_normalise_mixed": f"WITH {MIXED_DATES} SELECT o_orderkey, raw, {date_sql('raw')} AS normalised FROM mixed",
        "date_reject_report": f"""WITH {MIXED_DATES} SELECT form,
              count(*) FILTER (WHERE {_nb('raw')}) AS n_values,
              count(*) FILTER (WHERE {_nb('raw')} AND try_strptime(raw, {DUCK_DATE_FORMATS}) IS NULL) AS n_rejects
            FROM mixed GROUP BY form""",
        "inbox_filter": f"""WITH {NAMES_FROM_PAGES} SELECT page_id, file,
              (suffix(file, '.xlsx') OR suffix(file, '.xls') OR suffix(file, '.csv')) AS allowed FROM names""",
        "dispatch_ext": f"""WITH {NAMES_FROM_PAGES}, e AS (SELECT page_id, file, lower(regexp_extract(file, '(\\.[^./]*)$', 1)) AS ext FROM names)
            SELECT page_id, file, ext, CASE ext WHEN '.xls' THEN 'xls' WHEN '.xlsx' THEN 'xlsx' WHEN '.csv' THEN 'csv' ELSE 'other' END AS kind FROM e""",
        "discover_order": f"""WITH {NAMES_FROM_PAGES}, r AS (
              SELECT page_id, file, CASE WHEN suffix(file, '.xlsx') THEN 0 WHEN suffix(file, '.xls') THEN 1
                                         WHEN suffix(file, '.csv') THEN 2 END AS type_rank FROM names)
            SELECT page_id, file, row_number() OVER (ORDER BY type_rank, file) AS file_ordinal
            FROM r WHERE type_rank IS NOT NULL""",
        "dataset_name": f"""WITH {NAMES_FROM_PAGES}, s AS (
              SELECT page_id, file,
                     CASE WHEN lower(regexp_extract(file, '(\\.[^./]*)$', 1)) IN ('.xlsx', '.xls')
                          THEN 'Sheet' || CAST(page_id % 3 AS VARCHAR) END AS sheet FROM names)
            SELECT page_id, file, sheet,
                   CASE WHEN sheet IS NULL THEN regexp_replace(file, '\\.xlsx|\\.xls|\\.csv', '', 'g')
                        ELSE regexp_replace(file, '\\.xlsx|\\.xls|\\.csv', '', 'g') || '_' || sheet END AS dataset_name
            FROM s""",
        "basename": "SELECT page_id, string_split(url, '/')[-1] AS basename FROM pages",
        "run_stamp": "SELECT event_id, strftime(ts, '%Y-%m-%d_%H%M%S') AS run_id FROM events",
    }
    entries = f"""{c},
        ents AS (
          SELECT CASE file_name WHEN 'upper_S1' THEN 'upper_S1.csv' ELSE file_name || '.csv' END AS entry,
                 'good' AS status, NULL AS reason, count(*) AS n_rows FROM fx GROUP BY file_name
          UNION ALL SELECT 'overlong.csv', CASE WHEN count(*) FILTER (WHERE s_suppkey % 10 = 0) > 0 THEN 'error' ELSE 'good' END,
                 CASE WHEN count(*) FILTER (WHERE s_suppkey % 10 = 0) > 0 THEN 'overlong' END, count(*) FROM supplier
          UNION ALL SELECT 'narrow.csv', 'good', NULL, count(*) FROM part
          UNION ALL SELECT 'gate_fail.csv', 'good', NULL, count(*) FROM supplier
          UNION ALL SELECT 'email_only.csv', 'good', NULL, count(*) FROM customer
          UNION ALL SELECT 'unmatched.csv', 'good', NULL, count(*) FROM orders
          UNION ALL SELECT 'twin.csv', 'good', NULL, count(*) FROM supplier
          UNION ALL SELECT 'twin.csv.csv', 'good', NULL, count(*) FROM part),
        ranked AS (SELECT *, CAST(row_number() OVER (ORDER BY entry) AS INTEGER) AS file_ordinal FROM ents)"""
    out.update({
        "csv_sweep": f"{c} SELECT * FROM gold",
        "hot_sweep": f"{chain(hot=True)} SELECT * FROM gold",
        "hot_lineage": f"""{chain(hot=True)} SELECT file_name, count(*) AS n_rows, min(rowid) AS first_rowid,
                                                  max(rowid) AS last_rowid FROM silver GROUP BY file_name""",
        "csv_silver": f"{c} SELECT file_name, {t} FROM filled",
        "probe_status": f"{entries} SELECT entry, status, reason, n_rows FROM ents",
        "route_good": f"{entries} SELECT entry, file_ordinal FROM ranked WHERE status = 'good'",
        "route_error": f"{entries} SELECT entry, reason FROM ranked WHERE status = 'error'",
        "inbox_manifest": """WITH e AS (SELECT DISTINCT n_name, CASE n_nationkey % 4 WHEN 0 THEN '.csv' WHEN 1 THEN '.txt'
                WHEN 2 THEN '.csv.csv' ELSE '.xls' END AS x FROM nation JOIN supplier ON n_nationkey = s_nationkey),
              m AS (SELECT 'nation=' || n_name || x AS entry, x <> '.txt' AS allowed, regexp_extract(x, '[.][a-z]+$') AS ext FROM e),
              k AS (SELECT *, CASE ext WHEN '.xls' THEN 1 WHEN '.csv' THEN 2 END AS r FROM m)
            SELECT entry, allowed, ext, CASE WHEN r IS NULL THEN 'other' ELSE substr(ext, 2) END AS kind,
                   CASE WHEN r IS NOT NULL THEN CAST(row_number() OVER (ORDER BY r, entry) AS INTEGER) END AS file_ordinal FROM k""",
        "csv_multiline": """SELECT CAST(doc_id AS VARCHAR) AS cid, text AS var1, 'State' || chr(10) || 'of origin' AS third_header
                            FROM documents""",
        "csv_wide": """SELECT 'wide' AS file_name, CAST(s_suppkey AS VARCHAR) AS cid, s_name AS subscriberkey, 1500 AS n_cols
                       FROM supplier""",
        "header_repair": """SELECT n_name, CASE n_nationkey % 3 WHEN 0 THEN n_name || '|' || n_name || '.2|' || n_name || '.1|Unnamed: 3'
                              WHEN 1 THEN n_name || '.1|' || n_name || '|' || n_name || '.2|' || n_name || '.3'
                              ELSE 'Unnamed: 0.1|' || n_name || '|Unnamed: 0|' || n_name || '.1' END AS headers FROM nation""",
        "silver_two_runs": """SELECT 'run-1' AS run_id, row_number() OVER (ORDER BY c_custkey) - 1 AS rowid, 'weekly' AS file_name,
                 CAST(c_custkey AS VARCHAR) AS cid, c_name AS subscriberkey FROM customer
            UNION ALL SELECT 'run-2', row_number() OVER (ORDER BY s_suppkey) - 1, 'weekly', CAST(s_suppkey AS VARCHAR), s_name FROM supplier""",
        "stream_archive": """SELECT 'weekly' AS file_name, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_left FROM customer
            UNION ALL SELECT 'other', count(*), 0 FROM supplier""",
        "silver_after_failure": """SELECT 'run-2' AS run_id, 'weekly' AS file_name, CAST(c_custkey AS VARCHAR) AS cid, c_name AS subscriberkey FROM customer
            UNION ALL SELECT 'run-2', 'other', CAST(s_suppkey AS VARCHAR), s_name FROM supplier""",
        "quarantine_chunks": """WITH l AS (SELECT CAST(o_orderkey AS VARCHAR) || ',' || o_orderstatus || CASE WHEN o_orderkey % 7 = 0 THEN ',extra' ELSE '' END AS line
              FROM orders UNION ALL SELECT 'CID,State')
            SELECT 'overlong.csv' AS entry, 'overlong' AS reason, CAST(sum(strlen(line) + 1) AS BIGINT) AS bytes, count(*) AS n_lines,
                   CAST(sum(CAST('0x' || substr(md5(line), 1, 8) AS BIGINT)) AS BIGINT) AS checksum FROM l""",
        "gold_changed": """SELECT 'weekly' AS sourcefile, CAST(c_custkey AS VARCHAR) AS cid, c_name AS subscriberkey FROM customer
            UNION ALL SELECT 'weekly', CAST(s_suppkey AS VARCHAR), s_name FROM supplier
            UNION ALL SELECT 'other', CAST(s_suppkey AS VARCHAR), s_name FROM supplier""",
        "compact_files": f"{c} SELECT file_name, CAST(1 AS BIGINT) AS n_files, count(*) AS n_rows FROM silver GROUP BY file_name",
        "read_success_status": f"{entries} SELECT count(*) FILTER (WHERE status = 'good') AS n_read, count(*) AS n_entries FROM ents",
        "date_day_first": """SELECT CAST(o_orderkey AS VARCHAR) AS cid, strftime(o_orderdate, '%Y-%m-%d') AS createddate,
              strftime(o_orderdate, '%Y-%m-%d') AS lastmodifieddate,
              CASE WHEN o_orderkey % 3 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'NaT' END AS sentdate FROM orders""",
        "cells_to_records": """WITH b AS (SELECT 'S' || CAST(c_custkey // 400 AS VARCHAR) AS sheet, c_custkey % 400 + 2 AS row_no, c_custkey % 11 AS blank,
              c_name || '|' || CASE WHEN c_custkey % 5 > 0 THEN c_mktsegment ELSE '-' END || '|' ||
              CASE WHEN c_custkey % 7 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE '-' END AS cells FROM customer),
            e AS (SELECT sheet, max(row_no) FILTER (WHERE blank > 0) AS last FROM b GROUP BY sheet),
            r AS (SELECT sheet, unnest(range(2, last + 1)) AS row_no FROM e)
            SELECT r.sheet, CAST(r.row_no AS BIGINT) AS row_no, 'Name|Segment|Key' AS headers, coalesce(b.cells, '-|-|-') AS cells
            FROM r LEFT JOIN b ON b.sheet = r.sheet AND b.row_no = r.row_no AND b.blank > 0""",
        "gold_pii_absent": f"""{c} SELECT sourcefile, count(*) AS n_rows,
              count(*) FILTER (WHERE concat_ws('|', {', '.join(GOLD_ORDER)}) LIKE '%@%') AS n_with_email FROM gold GROUP BY sourcefile""",
        "inbox_gates": f"""{entries},
          g AS (
            SELECT regexp_replace(entry, '\\.csv$', '') AS file_name, n_rows,
                   CASE WHEN entry = 'narrow.csv' THEN 1
                        WHEN entry IN ('gate_fail.csv', 'email_only.csv', 'unmatched.csv', 'twin.csv.csv') THEN 2
                        ELSE (SELECT n_cols FROM ds WHERE ds.file_name = regexp_replace(entry, '\\.csv$', '')) END AS n_cols,
                   entry NOT IN ('gate_fail.csv', 'email_only.csv') AS gate_ok
            FROM ents WHERE status = 'good' AND entry <> 'twin.csv')
          SELECT regexp_replace(file_name, '\\.csv$', '') AS file_name, n_rows, n_cols,
                 (n_cols >= 2 AND n_rows >= 2) AS shape_ok, gate_ok,
                 (n_cols >= 2 AND n_rows >= 2 AND gate_ok) AS accepted FROM g""",
        "csv_lineage": f"""{c} SELECT file_name, count(*) AS n_rows FROM filled GROUP BY file_name
                              UNION ALL SELECT 'twin', count(*) FROM part""",
        "last_write_wins": f"""{entries}
            SELECT regexp_replace(entry, '\\.csv', '', 'g') AS file_name, entry AS source, n_rows
            FROM ents WHERE status = 'good' AND entry <> 'twin.csv'""",
        "silver_typed": f"{c} SELECT {silver_select()} FROM silver",
        "silver_roundtrip": f"{c} SELECT {silver_select()} FROM silver",
        "partition_read": f"{c} SELECT {silver_select()} FROM silver WHERE file_name = 'canon'",
        "silver_table": f"{c} SELECT {silver_select()} FROM silver",
        "gold_compact": f"{c} SELECT * FROM gold",
        "stream_sweep": f"{c} SELECT file_name, {t} FROM filled",
        "stream_gold": f"{c} SELECT * FROM gold",
        "xlsx_sweep": f"{c} SELECT * FROM gold",
        "xlsx_cells": f"""{c},
          u AS (SELECT *, row_number() OVER (ORDER BY src_row) + 1 AS row_no FROM fx WHERE file_name = 'upper_S1'),
          cl AS (
            SELECT 'upper.xlsx' AS entry, 'S1' AS sheet, CAST(1 AS BIGINT) AS row_no, CAST(pos AS INTEGER) AS col,
                   header AS value FROM layout WHERE file_name = 'upper_S1'
            UNION ALL
            SELECT 'upper.xlsx', 'S1', CAST(u.row_no AS BIGINT), CAST(l.pos AS INTEGER), {_raw_case('u')}
            FROM u JOIN layout l ON l.file_name = 'upper_S1')
          SELECT entry, sheet, row_no, col, value FROM cl WHERE value IS NOT NULL AND value <> ''""",
        "sheet_fanout": f"{c} SELECT file_name, 'S1' AS sheet, n_rows, n_cols FROM ds WHERE file_name = 'upper_S1'",
        "silver_union": f"{c} SELECT file_name, {t} FROM filled",
        "mixed_rowid": f"""{c} SELECT (row_number() OVER (ORDER BY CASE WHEN file_name = 'upper_S1' THEN 0 ELSE 1 END,
                                                         file_name, src_row) - 1) AS rowid, file_name, emailaddress
                             FROM filled""",
    })
    return out
