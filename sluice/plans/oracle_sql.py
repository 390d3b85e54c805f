"""DuckDB SQL that computes each registered query's answer straight from the tables.

The SQL restates the fixture rules of ``sources.fixtures`` over ``events`` (and
``orders``) and the semantics of each operator; it shares no code with the
Spark decoder, so a match checks decoding, dedupe and paging end to end.
"""

from __future__ import annotations

from .queries import (CHUNK_SIZE, DAMAGED_AT, DAMAGED_EVERY, FLUSH_BATCH, KEYSET_AFTER, KEYSET_LIMIT,
                      ORDERS_PAGE, PAGE_SIZE, RUNS_MULTI)
from ..operators.envelope import (ERR_GAP, ERR_NO_CURSOR, ERR_RELANDED, ERR_NOT_ARRAY, ERR_NOT_JSON, ERR_NOT_OBJECT,
                                   ERR_STUCK, ERR_UNREADABLE)

PS = PAGE_SIZE
SERVE_START = 5000          # what SERVE_CURSOR spells in base64


def _occ(runs: int) -> str:
    """CTEs ``b2`` (one row per event) and ``occ`` (one row per landed occurrence)."""
    return f"""
b0 AS (SELECT event_id, event_type, epoch_us(ts) AS us,
              row_number() OVER (ORDER BY event_id NULLS FIRST, ts NULLS FIRST, user_id NULLS FIRST,
                                 event_type NULLS FIRST, value NULLS FIRST, props NULLS FIRST) - 1 AS rn
       FROM events),
nn AS (SELECT count(*) AS n FROM events),
b1 AS (SELECT b0.*, rn % {runs} AS run, rn // {runs} AS rrn FROM b0),
b2 AS (SELECT b1.*, rrn // {PS} AS page_no, rrn % {PS} AS pos,
              ((nn.n - run + {runs} - 1) // {runs} - 1) // {PS} AS last_page
       FROM b1, nn),
occ0 AS (SELECT b2.*, page_no AS opage, pos AS slot, 0 AS tag FROM b2
         UNION ALL SELECT b2.*, (page_no + 1) % (last_page + 1), {PS} + pos, 1 FROM b2 WHERE rn % 7 = 3
         UNION ALL SELECT b2.*, page_no, {2 * PS} + pos, 2 FROM b2 WHERE rn % 11 = 5),
occ AS (SELECT occ0.*, row_number() OVER (PARTITION BY run, opage ORDER BY slot) - 1 AS opos FROM occ0),
pg AS (SELECT run, opage AS page_no, count(*) AS n, max(last_page) AS last_page
       FROM occ GROUP BY run, opage)"""


_RUN = "printf('run-%03d', run)"
_ID = "printf('evt-%09d', event_id)"
_EMS = """CASE WHEN rn % 37 = 36 OR rn % 41 = 40 THEN NULL
     WHEN rn % 10 IN (0, 2, 6) THEN us // 1000
     WHEN rn % 10 IN (1, 5, 9) THEN (us // 1000000) * 1000
     WHEN rn % 10 IN (3, 7) THEN CAST(trunc(CAST(us AS DOUBLE) / 1000.0) AS BIGINT)
     ELSE CAST(trunc(CAST(us * 1000 AS DOUBLE) / 1000000.0) AS BIGINT) END"""
_COPY = "CASE WHEN tag > 0 THEN CAST(tag AS BIGINT) END"


def _b64(expr: str) -> str:
    return f"to_base64(encode(CAST({expr} AS VARCHAR)))"


def _winners(runs: int, where: str = "TRUE") -> str:
    return f"""win AS (SELECT * FROM (
         SELECT occ.*, row_number() OVER (PARTITION BY event_id ORDER BY run, opage, opos) AS w
         FROM occ WHERE {where}) WHERE w = 1)"""


def _flush_ctes(runs: int) -> str:
    b = FLUSH_BATCH
    return f"""{_occ(runs)},
{_winners(runs)},
fl AS (SELECT * FROM (WITH RECURSIVE r(run, page_no, n, buf, flush_no, closes) AS (
         SELECT run, page_no, n, CASE WHEN n >= {b} OR page_no = last_page THEN 0 ELSE n END,
                CAST(1 AS BIGINT),
                (n >= {b} OR page_no = last_page)
         FROM pg WHERE page_no = 0
         UNION ALL
         SELECT p.run, p.page_no, p.n,
                CASE WHEN r.buf + p.n >= {b} OR p.page_no = p.last_page THEN 0 ELSE r.buf + p.n END,
                r.flush_no + CASE WHEN r.closes THEN 1 ELSE 0 END,
                (r.buf + p.n >= {b} OR p.page_no = p.last_page)
         FROM r JOIN pg p ON p.run = r.run AND p.page_no = r.page_no + 1)
       SELECT * FROM r)),
fpage AS (SELECT fl.*, pg.last_page,
                 CASE WHEN fl.page_no < pg.last_page THEN {_b64(f'(fl.page_no + 1) * {PS}')} END AS next_cursor,
                 coalesce(ins.k, 0) AS ins
          FROM fl JOIN pg ON pg.run = fl.run AND pg.page_no = fl.page_no
          LEFT JOIN (SELECT run, opage, count(*) AS k FROM win GROUP BY run, opage) ins
            ON ins.run = fl.run AND ins.opage = fl.page_no),
fsum AS (SELECT run, flush_no, CAST(sum(ins) AS BIGINT) AS inserted, max(page_no) AS last_page_no
         FROM fpage GROUP BY run, flush_no),
fcur AS (SELECT f.run, f.flush_no, f.inserted, f.last_page_no, p.next_cursor AS cursor
         FROM fsum f JOIN fpage p ON p.run = f.run AND p.page_no = f.last_page_no)"""


def oracle_sql() -> dict[str, str]:
    one = _occ(1)
    q: dict[str, str] = {}

    q["page_envelope"] = f"""WITH {one}
SELECT {_RUN} AS run_id, page_no, n AS n_events, page_no < last_page AS has_more,
       CASE WHEN page_no < last_page THEN {_b64(f'(page_no + 1) * {PS}')} END AS next_cursor
FROM pg"""

    q["event_rows"] = f"""WITH {one}
SELECT {_RUN} AS run_id, opage AS page_no, opos AS pos, {_ID} AS event_id,
       {_EMS} AS occurred_at_ms, rn % 37 <> 36 AS time_present, event_type, {_COPY} AS copy_tag
FROM occ"""

    q["event_table_rows"] = f"""WITH {one},
{_winners(1)}
SELECT {_ID} AS event_id, {_EMS} AS occurred_at_ms, TRUE AS has_ingested_at FROM win"""

    q["epoch_units"] = """WITH x AS (
  SELECT event_id, CASE event_id % 6
      WHEN 0 THEN CAST(epoch_us(ts) AS DOUBLE) / 1000000.0
      WHEN 1 THEN CAST(epoch_us(ts) // 1000 AS DOUBLE)
      WHEN 2 THEN CAST(epoch_us(ts) AS DOUBLE)
      WHEN 3 THEN CAST(epoch_us(ts) * 1000 AS DOUBLE)
      WHEN 4 THEN value
      ELSE -CAST(epoch_us(ts) // 1000 AS DOUBLE) END AS x
  FROM events),
y AS (SELECT event_id, x, CASE WHEN abs(x) >= 1e17 THEN x / 1e6 WHEN abs(x) >= 1e14 THEN x / 1e3
                               WHEN abs(x) >= 1e8 AND abs(x) < 1e11 THEN x * 1e3 ELSE x END AS ms
      FROM x)
SELECT event_id,
       CASE WHEN abs(x) >= 1e17 THEN 'ns' WHEN abs(x) >= 1e14 THEN 'us' WHEN abs(x) >= 1e11 THEN 'ms'
            WHEN abs(x) >= 1e8 THEN 's' ELSE 'ms' END AS unit,
       CASE WHEN isnan(x) OR isinf(x) THEN NULL
            WHEN ms > -62135596800001 AND ms < 253402300800000 THEN CAST(trunc(ms) AS BIGINT) END AS instant_ms
FROM y"""

    q["first_by_key"] = f"""WITH {one},
{_winners(1)}
SELECT {_ID} AS event_id, opage AS page_no, opos AS pos, rn % 3 = 0 AS has_event_id_key,
       {_COPY} AS copy_tag
FROM win"""

    q["insert_if_absent"] = f"""WITH {one},
mid AS (SELECT (max(last_page) + 1) // 2 AS m FROM b2),
stored AS (SELECT DISTINCT event_id FROM occ, mid WHERE opage < mid.m),
{_winners(1, "opage >= (SELECT m FROM mid)")}
SELECT {_ID} AS event_id, opage AS page_no, opos AS pos
FROM win WHERE event_id NOT IN (SELECT event_id FROM stored)"""

    ingest = f"""WITH {one},
{_winners(1)}
SELECT {_ID} AS event_id, {_EMS} AS occurred_at_ms, event_type, {_COPY} AS copy_tag,
       rn % 37 <> 36 AS has_time_key, opage AS page_no, opos AS pos
FROM win"""
    q["insert_indexed"] = q["insert_if_absent"]
    q["ingest_batch"] = ingest
    q["ingest_stream"] = ingest
    q["ingest_replay"] = ingest

    # Pages landed with faults, gaps, copies, and a third of the request cursors missing.
    more = "page_no < last_page AND page_no % 5 <> 4"
    lost, stuck = f"({more} AND page_no % 13 = 7)", f"({more} AND page_no % 13 <> 7 AND page_no % 17 = 11)"
    before = "(page_no - 1) % 19 <> 4 AND NOT ((page_no - 1) % 5 <> 4 AND ((page_no - 1) % 13 = 7 OR (page_no - 1) % 17 = 11))"
    seen = f"({stuck} AND (page_no % 3 <> 0 OR ({before})))"
    reports = f"""
SELECT {_RUN} AS run_id, page_no, '{ERR_NO_CURSOR}' AS kind FROM pg WHERE page_no % 19 <> 4 AND {lost}
UNION ALL SELECT {_RUN}, page_no, '{ERR_STUCK}' FROM pg WHERE page_no % 19 <> 4 AND {seen}
UNION ALL SELECT {_RUN}, page_no, '{ERR_RELANDED}' FROM pg WHERE page_no % 19 <> 4 AND page_no % 23 = 6
UNION ALL SELECT {_RUN}, page_no, '{ERR_GAP}' FROM pg
          WHERE page_no % 19 <> 4 AND page_no > 0 AND page_no % 3 = 0 AND (page_no - 1) % 19 = 4"""
    loads = f"""{one}, {_winners(1)},
pq AS (SELECT page_no, n, page_no * 4 // (SELECT count(*) FROM pg) AS b,
              CASE WHEN page_no < last_page THEN {_b64(f"(page_no + 1) * {PS}")} END AS cursor FROM pg),
ins AS (SELECT b, count(*) AS inserted FROM win JOIN pq ON opage = pq.page_no GROUP BY b),
fl AS (SELECT b, max(page_no) AS last_page_no, count(*) AS pages, sum(n) AS events, coalesce(max(inserted), 0) AS inserted,
              max_by(coalesce(cursor, ''), page_no) AS cursor FROM pq LEFT JOIN ins USING (b) GROUP BY b)"""
    q["hook_flushes"] = f"""WITH {loads}
SELECT CAST(events AS BIGINT) AS batch_size, pages, inserted, nullif(cursor, '') AS cursor, b + 1 AS flush_number FROM fl"""
    q["stream_progress"] = f"""WITH {loads},
log AS (SELECT page_no + b AS seq, 1 AS p, n AS e, 0 AS i, 0 AS f, cursor FROM pq
        UNION ALL SELECT last_page_no + 1 + b, 0, 0, inserted, 1, nullif(cursor, '') FROM fl)
SELECT seq, CAST(sum(p) OVER w AS BIGINT) AS pages, CAST(sum(e) OVER w AS BIGINT) AS events,
       CAST(sum(i) OVER w AS BIGINT) AS inserted, CAST(sum(f) OVER w AS BIGINT) AS flushes,
       CAST(100 + sum(i) OVER w AS BIGINT) AS total_ingested, cursor
FROM log WINDOW w AS (ORDER BY seq)"""
    q["time_forms"] = """WITH e AS (SELECT event_id, epoch_us(ts) // 1000 AS ms,
              make_timestamp((epoch_us(ts) // 1000 + 284012568000000) * 1000) AS t FROM events)
SELECT event_id, CAST(CASE WHEN event_id % 7 = 0 THEN ms WHEN event_id % 7 = 4 THEN ms // 86400000 * 86400000
       WHEN event_id % 7 = 5 THEN ms // 60000 * 60000 ELSE ms // 1000 * 1000 END AS BIGINT) AS instant_ms,
       printf('+%06d', year(t)) || strftime(t, '-%m-%dT%H:%M:%S.%g') || 'Z' AS far
FROM e"""
    day = "ms // 86400000 * 86400000"
    q["free_dates"] = f"""WITH e AS (SELECT event_id, ts, epoch_us(ts) // 1000 AS ms, event_id % 10 AS k FROM events)
SELECT event_id, CAST(CASE WHEN k IN (0, 2) THEN {day} WHEN k IN (1, 4, 5, 6) THEN ms // 1000 * 1000
       WHEN k = 3 THEN ms // 60000 * 60000 WHEN k = 7 THEN epoch_ms(make_date(year(ts), 2, 1)) + CAST(30 AS BIGINT) * 86400000
       WHEN k = 9 THEN ms END AS BIGINT) AS instant_ms
FROM e"""
    q["cursor_forms"] = """SELECT o_orderkey,
       CAST(CASE WHEN o_orderkey % 6 = 4 THEN 0 ELSE o_orderkey END AS BIGINT) AS start FROM orders"""
    q["page_reports"] = f"WITH {one} {reports}"
    skip = "page_no % 19 = 4 OR " + lost + " OR " + seen
    kept = "opage IN (SELECT page_no FROM pg WHERE NOT (" + skip + "))"
    q["ingest_quarantine_chain"] = f"""WITH {one},
{_winners(1, kept)}
SELECT {_ID} AS event_id, {_EMS} AS occurred_at_ms, event_type, {_COPY} AS copy_tag,
       rn % 37 <> 36 AS has_time_key, opage AS page_no, opos AS pos
FROM win"""

    bad_page = "(page_no % 23 = 7 OR page_no % 29 = 13 OR page_no % 31 = 17 OR page_no % 37 = 19)"
    bad_event = "(rn % 97 = 13 OR rn % 89 = 7 OR rn % 83 = 5 OR rn % 79 = 3)"
    q["ingest_quarantine"] = f"""WITH {one},
good AS (SELECT occ.* FROM occ WHERE NOT {bad_event.replace('page_no', 'opage')}
         AND NOT {bad_page.replace('page_no', 'opage')}),
win AS (SELECT * FROM (
         SELECT good.*, row_number() OVER (PARTITION BY event_id ORDER BY run, opage, opos) AS w
         FROM good) WHERE w = 1)
SELECT {_ID} AS event_id, {_EMS} AS occurred_at_ms, event_type, {_COPY} AS copy_tag,
       rn % 37 <> 36 AS has_time_key, opage AS page_no, opos AS pos
FROM win"""

    q["stream_chain"] = q["ingest_quarantine_chain"]

    q["unnest_columns"] = f"""WITH {one}
SELECT {_RUN} AS run_id, opage AS page_no, {_ID} AS event_id, {_EMS} AS occurred_at_ms, event_type
FROM occ"""

    chain = f"""WITH {one},
pages AS (SELECT DISTINCT page_no, last_page FROM b2),
faulted AS (SELECT page_no, last_page,
                   page_no < last_page AND page_no % 5 <> 4 AND page_no % 13 = 7 AS missing,
                   page_no < last_page AND page_no % 5 <> 4 AND page_no % 13 <> 7
                     AND page_no % 17 = 11 AS stuck
            FROM pages)"""
    q["page_chain"] = f"""{chain}
SELECT 'run-000' AS run_id, page_no,
       CASE WHEN missing THEN '{ERR_NO_CURSOR}' ELSE '{ERR_STUCK}' END AS kind
FROM faulted WHERE missing OR stuck"""
    q["page_chain_lag"] = f"""{chain}
SELECT 'run-000' AS run_id, f.page_no,
       CASE WHEN f.missing THEN '{ERR_NO_CURSOR}' ELSE '{ERR_STUCK}' END AS kind
FROM faulted f LEFT JOIN faulted prev ON prev.page_no = f.page_no - 1
WHERE f.missing OR (f.stuck AND NOT coalesce(prev.missing, FALSE))"""

    page_err = f"""CASE WHEN page_no % 23 = 7 OR page_no % 29 = 13 THEN '{ERR_NOT_ARRAY}'
            WHEN page_no % 31 = 17 THEN '{ERR_NOT_OBJECT}'
            WHEN page_no % 37 = 19 THEN '{ERR_NOT_JSON}' END"""
    q["invalid_events"] = f"""WITH {one},
perr AS (SELECT run, page_no, {page_err} AS reason FROM pg)
SELECT {_RUN} AS run_id, page_no, CAST(NULL AS BIGINT) AS pos, reason FROM perr WHERE reason IS NOT NULL
UNION ALL
SELECT printf('run-%03d', occ.run) AS run_id, opage AS page_no, opos AS pos,
       CASE WHEN rn % 97 = 13 OR rn % 89 = 7 OR rn % 83 = 5 THEN 'missing event id'
            ELSE 'event must be an object' END AS reason
FROM occ JOIN perr ON perr.run = occ.run AND perr.page_no = occ.opage
WHERE perr.reason IS NULL AND (rn % 97 = 13 OR rn % 89 = 7 OR rn % 83 = 5 OR rn % 79 = 3)"""

    q["left_out"] = q["invalid_events"].replace("reason FROM perr", "reason, TRUE AS kept FROM perr") \
        .replace("END AS reason\nFROM occ JOIN", "END AS reason, TRUE AS kept\nFROM occ JOIN")
    cut = f"page_no % {DAMAGED_EVERY} = {DAMAGED_AT}"
    q["damaged_lines"] = f"""WITH {one}
SELECT CASE WHEN NOT {cut} THEN {_RUN} END AS run_id, CASE WHEN NOT {cut} THEN page_no END AS page_no,
       CASE WHEN NOT {cut} THEN n END AS n_events, CASE WHEN {cut} THEN '{ERR_UNREADABLE}' END AS reason, TRUE AS traced
FROM pg"""

    multi = _flush_ctes(RUNS_MULTI)
    q["flush_batches"] = f"""WITH RECURSIVE {multi}
SELECT {_RUN} AS run_id, page_no, n AS n_events, flush_no, closes AS closes_flush FROM fl"""

    q["flush_rollup"] = f"""WITH RECURSIVE {multi}
SELECT printf('run-%03d', f.run) AS run_id, f.flush_no, count(*) AS pages,
       CAST(sum(p.n) AS BIGINT) AS events,
       max(CASE WHEN p.page_no = f.last_page_no THEN p.next_cursor END) AS cursor
FROM fsum f JOIN fpage p ON p.run = f.run AND p.flush_no = f.flush_no
GROUP BY f.run, f.flush_no"""

    q["stream_flushes"] = f"""WITH RECURSIVE {multi}
SELECT printf('run-%03d', f.run) AS run_id, f.flush_no, count(*) AS pages, CAST(sum(p.n) AS BIGINT) AS events,
       max(f.inserted) AS inserted, max(CASE WHEN p.page_no = f.last_page_no THEN p.next_cursor END) AS cursor
FROM fsum f JOIN fpage p ON p.run = f.run AND p.flush_no = f.flush_no
GROUP BY f.run, f.flush_no"""

    q["run_summary"] = f"""WITH RECURSIVE {multi}
SELECT {_RUN} AS run_id, count(*) AS pages, CAST(sum(n) AS BIGINT) AS events,
       CAST(sum(ins) AS BIGINT) AS inserted, max(flush_no) AS flushes,
       CAST(NULL AS VARCHAR) AS final_cursor
FROM fpage GROUP BY run"""

    q["progress"] = f"""WITH RECURSIVE {multi},
log AS (SELECT run, page_no * 2 AS seq, 1 AS pages, n AS events, 0 AS inserted, 0 AS flushes,
               next_cursor AS cursor FROM fpage
        UNION ALL
        SELECT run, last_page_no * 2 + 1, 0, 0, inserted, 1, cursor FROM fcur)
SELECT {_RUN} AS run_id, seq,
       CAST(sum(pages) OVER w AS BIGINT) AS pages, CAST(sum(events) OVER w AS BIGINT) AS events,
       CAST(sum(inserted) OVER w AS BIGINT) AS inserted, CAST(sum(flushes) OVER w AS BIGINT) AS flushes,
       CAST(100 + sum(inserted) OVER w AS BIGINT) AS total_ingested, cursor
FROM log WINDOW w AS (PARTITION BY run ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

    # the last flush's cursor may be NULL; DuckDB's arg_max skips NULLs, so take it by join
    q["ledger_state"] = f"""WITH RECURSIVE {multi},
agg AS (SELECT run, CAST(sum(inserted) AS BIGINT) AS total_ingested, max(flush_no) AS last_batch
        FROM fcur GROUP BY run)
SELECT printf('run-%03d', agg.run) AS run_id, f.cursor, agg.total_ingested, agg.last_batch
FROM agg JOIN fcur f ON f.run = agg.run AND f.flush_no = agg.last_batch"""

    q["paginate"] = f"""SELECT o_orderkey, rn AS row_idx, rn // {ORDERS_PAGE} AS page_no,
       rn % {ORDERS_PAGE} AS pos, {_b64('rn + 1')} AS cursor_after
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey NULLS FIRST, o_custkey NULLS FIRST) - 1 AS rn
      FROM orders)"""

    L = ORDERS_PAGE
    q["page_table"] = f"""WITH c AS (SELECT count(*) AS n FROM orders),
p AS (SELECT DISTINCT (row_number() OVER (ORDER BY o_orderkey) - 1) // {L} AS page_no FROM orders)
SELECT page_no, CASE WHEN page_no = 0 THEN NULL ELSE {_b64(f'page_no * {L}')} END AS request_cursor,
       least((page_no + 1) * {L}, n) - page_no * {L} AS n,
       least((page_no + 1) * {L}, n) < n AS has_more,
       CASE WHEN least((page_no + 1) * {L}, n) < n THEN {_b64(f'least((page_no + 1) * {L}, n)')} END
         AS next_cursor
FROM p, c"""

    q["serve_page"] = f"""SELECT o_orderkey, rn AS row_idx
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey NULLS FIRST, o_custkey NULLS FIRST) - 1 AS rn
      FROM orders)
WHERE rn >= {SERVE_START} AND rn < {SERVE_START} + {ORDERS_PAGE}"""

    q["keyset_page"] = f"""SELECT o_orderkey FROM orders WHERE o_orderkey > {KEYSET_AFTER}
ORDER BY o_orderkey LIMIT {KEYSET_LIMIT}"""

    q["stored_keyset_page"] = q["keyset_page"]

    C = CHUNK_SIZE
    q["keyset_chunks"] = f"""WITH ids AS (SELECT DISTINCT {_ID} AS k FROM events),
r AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS rn FROM ids)
SELECT rn // {C} AS chunk_no, min(k) AS first_key, max(k) AS last_key, count(*) AS n,
       (rn // {C}) * {C} + count(*) AS running_total
FROM r GROUP BY rn // {C}"""

    q["export_keys"] = f"SELECT DISTINCT {_ID} AS value FROM events"
    q["export_ordered"] = q["export_keys"]
    q["payload_fields"] = f"""WITH {one},
{_winners(1)}
SELECT {_ID} AS event_id, event_type, {_COPY} AS copy_tag FROM win"""

    first_keys = """CASE rn % 3 WHEN 0 THEN 'eventId' WHEN 1 THEN 'event_id' ELSE 'id' END ||
  CASE WHEN rn % 37 = 36 THEN '' WHEN rn % 41 = 40 THEN ',occurredAt,timestamp'
       ELSE CASE rn % 10 WHEN 0 THEN ',occurredAt' WHEN 1 THEN ',occurred_at' WHEN 2 THEN ',timestamp'
                 WHEN 3 THEN ',occurredAt' WHEN 4 THEN ',occurredAt' WHEN 5 THEN ',timestamp'
                 WHEN 6 THEN ',occurred_at' WHEN 7 THEN ',timestamp' WHEN 8 THEN ',occurredAt'
                 ELSE ',occurredAt,timestamp' END END || ',eventType,userId,value,props'"""
    q["page_shape"] = f"""WITH {one},
firsts AS (SELECT run, page_no, rn FROM b2 WHERE pos = 0)
SELECT {_RUN} AS run_id, pg.page_no,
  CASE pg.page_no % 5 WHEN 0 THEN 'data,hasMore,nextCursor' WHEN 1 THEN 'events,has_more,next_cursor'
       WHEN 4 THEN 'data,nextCursor' ELSE 'data,pagination' END AS top_level_keys,
  CASE WHEN pg.page_no % 5 = 1 THEN 'undefined' ELSE 'array' END AS data_type,
  CASE WHEN pg.page_no % 5 = 1 THEN NULL ELSE pg.n END AS data_length,
  CASE WHEN pg.page_no % 5 = 0 THEN 'boolean' ELSE 'undefined' END AS has_more_type,
  CASE WHEN pg.page_no % 5 IN (0, 4) THEN CASE WHEN pg.page_no < pg.last_page THEN 'string' ELSE 'null' END
       ELSE 'undefined' END AS next_cursor_type,
  CASE WHEN pg.page_no % 5 = 1 THEN NULL ELSE {first_keys} END AS first_event_keys,
  pg.n AS sample_size
FROM pg JOIN firsts USING (run, page_no)"""

    time_key = """CASE rn % 10 WHEN 0 THEN 'occurredAt' WHEN 1 THEN 'occurred_at' WHEN 2 THEN 'timestamp'
       WHEN 3 THEN 'occurredAt' WHEN 4 THEN 'occurredAt' WHEN 5 THEN 'timestamp'
       WHEN 6 THEN 'occurred_at' WHEN 7 THEN 'timestamp' WHEN 8 THEN 'occurredAt' ELSE 'timestamp' END"""
    q["field_profile"] = f"""WITH {one},
kv AS (SELECT CASE rn % 3 WHEN 0 THEN 'eventId' WHEN 1 THEN 'event_id' ELSE 'id' END AS key,
              'string' AS type FROM occ
       UNION ALL SELECT 'eventType', 'string' FROM occ
       UNION ALL SELECT 'userId', 'number' FROM occ
       UNION ALL SELECT 'value', 'number' FROM occ
       UNION ALL SELECT 'props', 'string' FROM occ
       UNION ALL SELECT 'copy', 'number' FROM occ WHERE tag > 0
       UNION ALL SELECT 'occurredAt', 'null' FROM occ
                 WHERE rn % 37 <> 36 AND (rn % 41 = 40 OR rn % 10 = 9)
       UNION ALL SELECT 'timestamp', 'null' FROM occ WHERE rn % 37 <> 36 AND rn % 41 = 40
       UNION ALL SELECT {time_key}, CASE WHEN rn % 10 IN (1, 2, 3, 4) THEN 'number' ELSE 'string' END
                 FROM occ WHERE rn % 37 <> 36 AND rn % 41 <> 40)
SELECT key, type, count(*) AS n, (SELECT count(*) FROM occ) AS events,
       count(*) / (SELECT count(*) FROM occ)::DOUBLE AS share FROM kv GROUP BY key, type"""

    q["pending"] = f"""WITH {one},
mid AS (SELECT (max(page_no) + 1) // 2 AS m FROM pg)
SELECT printf('%s/%09d', {_RUN}, page_no) AS name FROM pg, mid WHERE page_no >= mid.m"""

    q["count_events"] = "SELECT count(DISTINCT event_id) AS n FROM events"
    return q
