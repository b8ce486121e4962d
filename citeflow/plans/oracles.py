"""What each query must return, as DuckDB SQL computed straight from the table columns."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_SPACE = (
    "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160) || "
    "chr(5760) || chr(8192) || chr(8193) || chr(8194) || chr(8195) || chr(8196) || chr(8197) || "
    "chr(8198) || chr(8199) || chr(8200) || chr(8201) || chr(8202) || chr(8232) || chr(8233) || "
    "chr(8239) || chr(8287) || chr(12288)"
)

# documents ----------------------------------------------------------------------------------

_TEXTS = r"""
WITH cleaned AS (
  SELECT doc_id, lang, source,
    string_split(regexp_replace(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)),
      '[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]', '', 'g'), chr(10)) AS lines,
    'baseline/art-' || lpad((doc_id % (SELECT greatest(1, count(*) // 500)
      FROM documents))::VARCHAR, 6, '0') || '.xml.gz' AS file
  FROM documents),
every AS (
  SELECT *, split_part(lines[1], ' ', 1) || CASE WHEN contains(lines[1], ' ') THEN ' ' ELSE '' END
      AS head,
    doc_id % 50 = 49 AS malformed, doc_id % 45 = 7 AS no_id
  FROM cleaned),
docs AS (
  SELECT *, doc_id::VARCHAR AS pmid,
    CASE doc_id % 40 WHEN 0 THEN '' WHEN 20 THEN 'Book of ' || lang
      ELSE CASE WHEN head = '' THEN ' in ' || lang ELSE head END END AS title,
    rtrim(array_to_string(list_transform(lines, lambda line, i:
      CASE WHEN i % 3 = 0 THEN 'PART ' || i || ': ' ELSE '' END || line ||
      CASE WHEN i % 2 = 0 THEN ' end' ELSE '' END || chr(10)), ''), """ + _SPACE + r""") AS abstract,
    array_to_string(list_transform(lines, lambda line, i: CASE WHEN line = '' THEN '' ELSE
      CASE WHEN i % 3 = 0 THEN '<b>PART ' || i || '</b>: ' ELSE '' END || line || '<br>' END), '')
      AS html,
    strftime(try_cast((2000 + doc_id % 20) || '-' || lpad((doc_id % 12 + 1)::VARCHAR, 2, '0') || '-'
      || lpad((doc_id % 31 + 1)::VARCHAR, 2, '0') AS DATE), '%Y-%m-%d') AS created,
    lang || '|' || CASE WHEN doc_id % 7 = 0 THEN '<null>' ELSE source END AS types
  FROM every WHERE NOT malformed AND NOT no_id)
"""

_TEXT_QUERIES = {
    "raw_split_pmid": "SELECT file, CASE WHEN NOT no_id THEN doc_id::VARCHAR END AS pmid FROM every",
    "write_doc_json": "SELECT pmid, title, abstract, types FROM docs",
    "remove_listed_ids": """SELECT pmid, title, file AS source_file FROM docs
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "lookup_docs": """SELECT pmid, title, abstract, file AS source_file FROM docs
        WHERE doc_id IN (SELECT doc_id FROM labels)""",
    "lookup_raw": """SELECT doc_id::VARCHAR AS pmid, file, lang FROM every
        WHERE NOT no_id AND doc_id IN (SELECT doc_id FROM labels)""",
    "compressed_roundtrip": "SELECT pmid, title, abstract, lang FROM docs",
    "doc_pmid": "SELECT pmid FROM docs",
    "doc_title": "SELECT pmid, title FROM docs",
    "doc_title_full": """SELECT pmid, CASE doc_id % 40 WHEN 0 THEN '' WHEN 20 THEN 'no'
        ELSE lines[1] || ' in ' || lang END AS title FROM docs""",
    "doc_abstract": "SELECT pmid, abstract FROM docs",
    "node_text": """SELECT pmid, (i - 1)::INTEGER AS part,
        lines[i] || CASE WHEN i % 2 = 0 THEN ' end' ELSE '' END AS text
        FROM (SELECT pmid, lines, unnest(generate_series(1, len(lines))) AS i FROM docs)""",
    "doc_article_types": "SELECT pmid, types AS article_types FROM docs",
    "doc_source_file": "SELECT pmid, file AS source_file FROM docs",
    "abstract_html": "SELECT pmid, html AS abstract_html FROM docs",
    "created_date": "SELECT pmid, created AS created_date FROM docs",
    "search_source_rows": """SELECT pmid, CASE WHEN doc_id % 20 <> 0 THEN nullif(head, '') END
        AS title, created AS created_date, html AS abstract FROM docs""",
    "missing_titles": "SELECT pmid, file AS source_file FROM docs WHERE doc_id % 40 = 0",
    "bad_records": """SELECT file, CASE WHEN malformed THEN 'malformed xml' ELSE 'no record id' END
        AS error, CASE WHEN NOT no_id THEN doc_id::VARCHAR END AS raw_id
        FROM every WHERE malformed OR no_id""",
    "missing_ids": "SELECT file, count(*) AS records FROM every WHERE no_id GROUP BY file",
    "id_mismatch": """SELECT l.doc_id::VARCHAR AS requested, d.pmid
        FROM labels l JOIN docs d ON d.doc_id = l.doc_id + l.toxic WHERE l.toxic <> 0""",
}
ORACLES.update({name: _TEXTS + sql for name, sql in _TEXT_QUERIES.items()})

# orders -------------------------------------------------------------------------------------

_FILE_OF_ORDER = """'baseline/ord-' || lpad((o_orderkey % (SELECT greatest(1, count(*) // 4000) FROM orders))::VARCHAR, 6, '0') || '.xml.gz'"""

_AUTHOR = """CASE o_custkey % 4 WHEN 0 THEN 'C' || o_custkey || ', ' || o_orderstatus
      WHEN 1 THEN 'C' || o_custkey || ', ' || o_orderstatus WHEN 2 THEN ', '
      ELSE 'C' || o_custkey || ', ' END || '|N' || (o_orderkey % 25) || ', '"""


def _pub_date(forms: int) -> str:
    return f"""CASE o_orderkey % {forms}
      WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
      WHEN 2 THEN year(o_orderdate) || '-01-01'
      WHEN 3 THEN year(o_orderdate) || '-' || month(o_orderdate) || '-' || day(o_orderdate)
      WHEN 4 THEN strftime(o_orderdate, '%Y-%m') || '-01'
      WHEN 7 THEN (year(o_orderdate) - 150) || '-01-01'
      WHEN 9 THEN year(o_orderdate) || '-01-01' WHEN 12 THEN year(o_orderdate) || '-01-01'
      ELSE '1900-01-01' END"""


def _term(ui: str, name: str) -> str:
    return f"'MESH:D' || ({ui}) || '=' || {name}"


_C1, _C2 = "o_custkey % 20", "o_orderkey % 20"
_CHEM_2 = (
    "CASE WHEN o_orderkey % 6 = 0 THEN 'MESH:None=plain' ELSE "
    + _term(_C2, f"'chem ' || ({_C2})") + " END"
)
_HEADS = (
    (_C1, f"'head ' || ({_C1})"),
    ("(o_orderkey + 7) % 20", "CASE WHEN o_orderkey % 9 = 0 THEN '<null>' ELSE 'head' END"),
    ("(o_custkey + 1) % 20", "'head ' || ((o_custkey + 1) % 20)"),
)
_IS_COMPOUND = "({ui}) = {c1} OR (o_orderkey % 6 <> 0 AND ({ui}) = {c2})"


def _kept(ui: str, name: str) -> str:
    hidden = _IS_COMPOUND.format(ui=ui, c1=_C1, c2=_C2)
    return f"CASE WHEN {hidden} THEN NULL ELSE {_term(ui, name)} END"


_ORDERS = f"""
WITH docs AS (
  SELECT o_orderkey, o_orderkey::VARCHAR AS pmid, 'Order ' || o_orderkey || ' & ' AS title,
    {_FILE_OF_ORDER} AS source_file, {_AUTHOR} AS authors, {_pub_date(13)} AS pub_date,
    o_orderpriority AS journal_title,
    CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS journal_iso_title,
    CASE o_orderkey % 5 WHEN 0 THEN '10.1/o' || o_orderkey WHEN 2 THEN NULL
      ELSE '10.2/c' || o_custkey END AS doi,
    {_term(_C1, "'chem ' || (" + _C1 + ")")} || '|' || {_CHEM_2} AS compounds,
    concat_ws('|', {', '.join(_kept(*head) for head in _HEADS)}) AS mesh,
    concat_ws('|', {', '.join(_term(*head) for head in _HEADS)}) AS mesh_all,
    CASE o_orderkey % 13 WHEN 9 THEN year(o_orderdate)::VARCHAR WHEN 12 THEN
      year(o_orderdate)::VARCHAR WHEN 10 THEN '1900' WHEN 11 THEN '1900' END AS medline_year,
    year(o_orderdate)::VARCHAR AS y
  FROM orders)
"""

_FULL = """SELECT pmid, title, '' AS abstract, authors, pub_date, journal_iso_title, journal_title,
    '' AS article_types, doi, compounds, mesh, source_file FROM docs"""

_ORDER_QUERIES = {
    "read_doc_json": _FULL,
    "doc_full": _FULL,
    "reprocess_raw": "SELECT pmid, title, pub_date, doi, source_file FROM docs",
    "doc_authors": "SELECT pmid, authors FROM docs",
    "doc_pub_date": "SELECT pmid, pub_date FROM docs",
    "medline_year": "SELECT pmid, medline_year FROM docs",
    "doc_journal": "SELECT pmid, journal_title, journal_iso_title FROM docs",
    "doc_doi": "SELECT pmid, doi FROM docs",
    "doc_doi_own": "SELECT pmid, CASE o_orderkey % 5 WHEN 0 THEN '10.1/o' || o_orderkey END AS doi FROM docs",
    "doc_compounds": "SELECT pmid, compounds FROM docs",
    "doc_mesh": "SELECT pmid, mesh FROM docs",
    "doc_mesh_live": "SELECT pmid, mesh_all AS mesh FROM docs",
    "bad_dates": """SELECT pmid, source_file, y AS year,
        CASE o_orderkey % 13 WHEN 5 THEN 'Feb' ELSE 'September' END AS month,
        CASE o_orderkey % 13 WHEN 5 THEN '30' ELSE '01' END AS day
        FROM docs WHERE o_orderkey % 13 IN (5, 6)""",
}
ORACLES.update({name: _ORDERS + sql for name, sql in _ORDER_QUERIES.items()})

ORACLES["book_docs"] = f"""
SELECT o_orderkey::VARCHAR AS pmid, 'Book ' || o_orderkey AS title,
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'ABOUT: ' END || o_orderpriority || '  ' ||
    o_orderstatus AS abstract,
  'E' || (o_custkey % 7) || ', |' || {_AUTHOR} AS authors, {_pub_date(9)} AS pub_date,
  '' AS journal_iso_title, '' AS journal_title, '' AS article_types, '' AS doi, '' AS compounds,
  '' AS mesh, {_FILE_OF_ORDER} AS source_file
FROM orders
"""

# lineitem -----------------------------------------------------------------------------------

_KEY = (
    "l_orderkey {0}, l_linenumber {0}, l_partkey {0}, l_suppkey {0}, l_extendedprice {0}, "
    "l_shipdate {0}, l_returnflag {0}"
)
_REVISIONS = f"""
WITH placed AS (
  SELECT *, CASE WHEN l_shipdate < '1998-01-01' THEN 0 ELSE 1 END AS phase,
    CASE WHEN l_shipdate < '1998-01-01' THEN 'baseline' ELSE 'updatefiles' END || '/chg-' ||
      lpad(((l_orderkey + 7 * l_linenumber + 13 * l_partkey + 31 * l_suppkey) %
      (SELECT greatest(1, count(*) // 8000) FROM lineitem))::VARCHAR, 6, '0') ||
      '.xml.gz' AS file,
    l_orderkey || '-' || l_linenumber || '-' || l_suppkey AS title,
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'D' ELSE 'U' END AS op
  FROM lineitem),
changes AS (
  SELECT *, l_partkey AS id FROM placed
  UNION ALL SELECT *, l_suppkey AS id FROM placed WHERE op = 'D'),
counts AS (
  SELECT phase, file, count(*) FILTER (op = 'U') AS article_cnt, sum(l_quantity) AS duration
  FROM placed GROUP BY phase, file),
final AS (
  SELECT id::VARCHAR AS pmid, title, file FROM (SELECT *, row_number() OVER (PARTITION BY id
    ORDER BY phase DESC, file DESC, {_KEY.format('DESC')}) AS n FROM changes)
  WHERE n = 1 AND op = 'U'),
base AS (
  SELECT id::VARCHAR AS pmid, title, file FROM (SELECT *, row_number() OVER (PARTITION BY id
    ORDER BY file DESC, {_KEY.format('DESC')}) AS n FROM changes WHERE phase = 0)
  WHERE n = 1 AND op = 'U'),
versions AS (
  SELECT id::VARCHAR AS pmid, title, file FROM (SELECT *, row_number() OVER (PARTITION BY id
    ORDER BY phase DESC, file DESC, {_KEY.format('DESC')}) AS n FROM changes WHERE op = 'U')
  WHERE n = 1)
"""

_REVISION_QUERIES = {
    "scan_records": f"""SELECT file, phase,
        CASE op WHEN 'U' THEN 'PubmedArticle' ELSE 'DeleteCitation' END AS kind,
        row_number() OVER (PARTITION BY file ORDER BY {_KEY.format('')})::INTEGER AS place,
        l_partkey::VARCHAR AS first_id FROM placed""",
    "pending_files": "SELECT phase, file FROM counts WHERE phase = 1",
    "queued_counts": """SELECT phase, count(*) AS listed,
        count(*) FILTER (phase = 1) AS queued FROM counts GROUP BY phase""",
    "ledger_files": "SELECT file AS fn FROM counts WHERE phase = 0",
    "upsert_latest": "SELECT * FROM versions",
    "upsert_raw": "SELECT * FROM versions",
    "apply_deletes": "SELECT * FROM final",
    "insert_if_absent": f"""SELECT * FROM base UNION ALL
        SELECT id::VARCHAR AS pmid, title, file FROM (SELECT *, row_number() OVER (PARTITION BY id
          ORDER BY file, {_KEY.format('')}) AS n FROM changes WHERE op = 'U' AND phase = 1)
        WHERE n = 1 AND id::VARCHAR NOT IN (SELECT pmid FROM base)""",
    "file_ledger": """SELECT sha256(file) AS file_key, file AS fn, article_cnt, duration
        FROM counts""",
    "reset_tables": """SELECT 'documents' AS table_name, count(*) AS rows_before,
        0::BIGINT AS rows_after FROM final
        UNION ALL SELECT 'ledger', count(*), 0 FROM counts""",
    "file_rates": """SELECT phase, file, article_cnt, duration,
        round(article_cnt / duration, 6) AS rate,
        CASE WHEN phase = 0 THEN round(article_cnt / duration * 10, 6) END AS estimated_rate
        FROM counts""",
    "total_rate": """SELECT sum(article_cnt)::BIGINT AS article_cnt,
        round(sum(article_cnt) / max(duration), 6) AS total_rate FROM counts""",
    "progress_blocks": """SELECT phase, block, file, block * 1000 AS records,
        round(elapsed, 4) AS elapsed, round(block * 1000 / elapsed, 4) AS rate
        FROM (SELECT phase, file, b AS block,
            before_time + (b * 1000 - before) / article_cnt * duration AS elapsed
          FROM (SELECT *, sum(article_cnt) OVER w - article_cnt AS before,
              sum(duration) OVER w - duration AS before_time
            FROM counts WINDOW w AS (PARTITION BY phase ORDER BY file)) s
          JOIN (SELECT unnest(generate_series(1, (SELECT sum(article_cnt) // 1000 FROM counts)::BIGINT))
              AS b) marks
          ON b * 1000 > before AND b * 1000 <= before + article_cnt)""",
    "load_baseline": "SELECT pmid, title, file AS source_file FROM base",
    "bad_files": "SELECT min(file) AS file FROM placed WHERE phase = 0",
    "load_progress": """SELECT count(*)::BIGINT AS files, sum(article_cnt)::BIGINT AS article_cnt,
        0::BIGINT AS damaged FROM counts""",
    "load_beside_damaged": f"""SELECT id::VARCHAR AS pmid, title, file AS source_file FROM (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY phase DESC, file DESC, {_KEY.format('DESC')}) AS n
        FROM changes WHERE file <> (SELECT min(file) FROM placed WHERE phase = 0))
        WHERE n = 1 AND op = 'U'""",
    "load_updates": "SELECT pmid, title, file AS source_file FROM final",
    "stream_load": "SELECT pmid, title, file AS source_file FROM final",
    "reopened_lookup": """SELECT pmid, title, file AS source_file FROM final
        WHERE pmid IN (SELECT s_suppkey::VARCHAR FROM supplier)""",
    "delete_stored": """SELECT pmid, title, file AS source_file FROM final
        WHERE pmid NOT IN (SELECT s_suppkey::VARCHAR FROM supplier)""",
    "reprocess_store": "SELECT pmid, title, file AS source_file FROM final",
    "json_insert_if_absent": """SELECT pmid, title, file AS source_file FROM base UNION ALL
        SELECT id::VARCHAR AS pmid, title, file FROM (SELECT *, row_number() OVER (PARTITION BY id
          ORDER BY file, title) AS n FROM changes WHERE op = 'U' AND phase = 1)
        WHERE n = 1 AND id::VARCHAR NOT IN (SELECT pmid FROM base)""",
    "ledger_counts": "SELECT phase, file, article_cnt FROM counts",
}
ORACLES.update({name: _REVISIONS + sql for name, sql in _REVISION_QUERIES.items()})

# events -------------------------------------------------------------------------------------

_KINDS = """
WITH placed AS (
  SELECT *, 'updatefiles/evt-' || CASE WHEN event_type IN ('purchase', 'error') THEN 'del-'
      ELSE 'art-' END || lpad((event_id % (SELECT greatest(1, count(*) // 2500)
      FROM events))::VARCHAR, 6, '0') || '.xml.gz' AS file,
    CASE WHEN event_type = 'view' THEN 'PubmedArticle' WHEN event_type = 'click' THEN
      'PubmedBookArticle' WHEN event_type = 'signup' THEN 'BookDocument' WHEN
      event_type = 'purchase' THEN 'DeleteCitation' WHEN event_id % 2 = 0 THEN 'DeleteDocument'
      ELSE 'Retraction' END AS kind
  FROM events),
counts AS (
  SELECT 1 AS phase, file, count(*) FILTER (kind IN ('PubmedArticle', 'PubmedBookArticle'))
    AS article_cnt FROM placed GROUP BY file)
"""

_KIND_QUERIES = {
    "kind_counts": "SELECT kind, count(*) AS records FROM placed GROUP BY kind",
    "unhandled_kinds": """SELECT file, kind, count(*) AS records FROM placed WHERE kind NOT IN
        ('PubmedArticle', 'PubmedBookArticle', 'DeleteCitation') GROUP BY file, kind""",
    "deleted_ids": """SELECT file, event_id::VARCHAR AS pmid FROM placed
        WHERE kind = 'DeleteCitation' UNION ALL
        SELECT file, user_id::VARCHAR FROM placed WHERE kind = 'DeleteCitation'""",
    "file_counts": "SELECT * FROM counts",
    "nonempty_files": "SELECT * FROM counts WHERE article_cnt > 0",
}
ORACLES.update({name: _KINDS + sql for name, sql in _KIND_QUERIES.items()})
