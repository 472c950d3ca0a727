"""The registered queries once more as plain SQL on the given tables, written from the rules, not from the code."""

from arborflow.plans.oracle_graph import graph_statements

DOC = "(SELECT *, source || '/' || CASE lang WHEN 'de' THEN 'tests' WHEN 'es' THEN 'generated' ELSE 'main' END || '/' || CASE source WHEN 'src1' THEN 'test_' WHEN 'src2' THEN 'setup_' ELSE '' END || doc_id || '.py' AS file_path FROM documents)"
EV = "(SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INT) AS k, 'c' || CAST(floor(value / 100) AS INT) AS h FROM events)"
REASON = (
    "CASE WHEN lang = 'de' OR source = 'src1' THEN 'Excluded test file'"
    " WHEN source = 'src2' THEN 'Excluded setup/build file' WHEN lang = 'es' THEN 'Excluded generated file' END"
)
MANIFEST = f"""(SELECT 'docs' AS repository_id, 'c0ffee' AS commit_sha, file_path, octet_length(encode(text)) AS size_bytes,
    sha256(text) AS content_sha256, 'final' AS scope, {REASON} IS NULL AS included, {REASON} AS exclusion_reason FROM {DOC})"""
SAMPLE = f"""(SELECT file_path, ok AND r <= 25 AS included,
    CASE WHEN NOT (ok AND r <= 25) THEN coalesce({REASON}, 'Excluded by scope include pattern') END AS exclusion_reason
  FROM (SELECT *, row_number() OVER (PARTITION BY ok ORDER BY file_path) AS r
        FROM (SELECT *, source LIKE 'src1%' AND {REASON} IS NULL AS ok FROM {DOC})))"""
CLASSIFIED = """(SELECT d.*, p.h AS previous_hash, sha256(d.text) AS content_hash,
    source || '/' || d.doc_id || '.py' AS file_path,
    CASE WHEN lang = 'es' THEN 'FAILED' WHEN p.h IS NULL THEN 'NEW' WHEN p.h <> sha256(d.text) THEN 'CHANGED'
         WHEN p.quality = 1 AND lang <> 'fr' THEN 'UNCHANGED' ELSE 'VERSION_REFRESH' END AS change
  FROM documents d LEFT JOIN (SELECT l.doc_id, l.quality, sha256(CASE WHEN toxic = 1 THEN text || '!' ELSE text END) AS h
    FROM labels l JOIN documents x ON x.doc_id = l.doc_id) p ON p.doc_id = d.doc_id)"""
ORDER_EVENTS = """(SELECT CAST(l_orderkey AS VARCHAR) AS file_id, CAST(l_partkey AS VARCHAR) AS entity_id,
    CASE l_returnflag WHEN 'A' THEN 'NODE_UPSERT' WHEN 'N' THEN 'EDGE_UPSERT' ELSE 'NODE_DELETE' END AS event_type,
    CASE l_returnflag WHEN 'N' THEN 'cpg.edges' ELSE 'cpg.nodes' END AS topic
  FROM lineitem)"""
RESULTS = f"""(SELECT o_orderkey || '.py' AS file_path,
    CASE WHEN o_totalprice < 20000 THEN 'FAILED' WHEN o_orderstatus = 'F' THEN 'SKIPPED_UNCHANGED' ELSE 'SUCCESS' END AS status,
    CAST(coalesce(n, 0) AS BIGINT) AS node_count, CAST(coalesce(e, 0) AS BIGINT) AS edge_count,
    CASE WHEN o_totalprice < 20000 THEN 'SyntaxError' END AS error, nt AS node_topic, et AS edge_topic
  FROM orders LEFT JOIN (SELECT file_id, count(*) FILTER (event_type = 'NODE_UPSERT') AS n,
      count(*) FILTER (event_type = 'EDGE_UPSERT') AS e, nullif(count(*) FILTER (topic = 'cpg.nodes'), 0) AS nt,
      nullif(count(*) FILTER (topic = 'cpg.edges'), 0) AS et FROM {ORDER_EVENTS} GROUP BY file_id)
    ON file_id = CAST(o_orderkey AS VARCHAR))"""
AUDIT = f"""(SELECT *, CASE WHEN event_type IN ('view', 'click') THEN 'cpg.nodes' ELSE 'cpg.edges' END AS topic,
    CASE WHEN value < 200 THEN 0 ELSE 1 END AS partition, event_id AS "offset",
    CASE WHEN event_type = 'signup' THEN NULL ELSE user_id || '-' || k END AS eid,
    event_type = 'click' AND k < 50 AS foreign_key FROM {EV})"""
GRAPH_NODES = """(SELECT l_orderkey || '-' || l_linenumber AS id, CASE WHEN l_returnflag <> 'N' THEN CAST(l_suppkey AS VARCHAR) END AS file_id,
    CASE WHEN l_linestatus = 'O' THEN l_suppkey || ':' || l_returnflag END AS generation_id,
    l_returnflag = 'R' AND l_quantity > 40 AS placeholder FROM lineitem)"""
GRAPH_EDGES = """(SELECT CAST(o_orderkey AS VARCHAR) AS edge_id, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS file_id,
    CASE WHEN o_totalprice > 1000 THEN o_custkey || ':' || o_orderpriority END AS generation_id, o_orderpriority AS edge_type FROM orders)"""
META = f"""(SELECT '1.0' AS schema_version, 'x' || event_id AS event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS event_time,
    'docs' AS repository_id, 'c0ffee' AS commit_sha, 'f' || user_id AS file_id, 'u/' || user_id || '.py' AS file_path,
    h AS content_hash, '1.0.0' AS parser_version, CAST(k AS BIGINT) AS size_bytes, CAST(0 AS BIGINT) AS line_count,
    CAST(1 AS BIGINT) AS function_count, CAST(2 AS BIGINT) AS class_count, CAST(3 AS BIGINT) AS import_count,
    CAST(4 AS BIGINT) AS node_count, CAST(5 AS BIGINT) AS edge_count, CAST(6 AS BIGINT) AS parse_duration_ms,
    event_type AS parse_status, 'python.ast' AS parser, event_id AS seq
  FROM {EV} WHERE event_type NOT IN ('error', 'click'))"""
LATEST = f"(SELECT * EXCLUDE (seq) FROM {META} QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY seq DESC) = 1)"

# Node history: n<user>, deleted by a purchase, else upserted with property p_<event type> = k.
NODE_HISTORY = f"""
e AS (SELECT event_id AS seq, user_id, 'n' || user_id AS id, event_type = 'purchase' AS del, h, event_type AS name, k FROM {EV}),
w AS (SELECT *, last_value(CASE WHEN NOT del THEN h END IGNORE NULLS) OVER (PARTITION BY id ORDER BY seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS alive FROM e),
hit AS (SELECT id, user_id, h, seq FROM w WHERE del AND alive = h),
gone AS (SELECT id, max(seq) AS g FROM hit GROUP BY id),
lastup AS (SELECT id, any_value(user_id) AS user_id, arg_max(name, seq) AS name, arg_max(h, seq) AS h, max(seq) AS s FROM e WHERE NOT del GROUP BY id),
live AS (SELECT l.*, g FROM lastup l LEFT JOIN gone USING (id) WHERE coalesce(g, -1) < s)"""
# Edge history: e<user> from n<user> to t-<event type>, deleted by a signup, replayed event by event.
EDGE_HISTORY = f"""WITH RECURSIVE {NODE_HISTORY},
tomb AS (SELECT DISTINCT user_id, h FROM hit),
ev AS (SELECT v.user_id, row_number() OVER (PARTITION BY v.user_id ORDER BY event_id) AS rn, event_id AS seq, event_type = 'signup' AS del,
       v.h, CASE WHEN event_type <> 'signup' THEN 't-' || event_type END AS t, t.h IS NOT NULL AND event_type <> 'signup' AS ent
       FROM {EV} v LEFT JOIN tomb t ON t.user_id = v.user_id AND t.h = v.h),
r AS (
  SELECT DISTINCT user_id, CAST(0 AS BIGINT) AS rn, CAST(-1 AS BIGINT) AS seq, 'start' AS outcome, CAST(NULL AS VARCHAR) AS t,
         CAST(NULL AS VARCHAR) AS h, CAST([] AS VARCHAR[]) AS dels, CAST(NULL AS VARCHAR) AS eh, CAST(NULL AS VARCHAR) AS et FROM ev
  UNION ALL
  SELECT user_id, rn, seq, outcome,
         CASE WHEN outcome = 'up' THEN et WHEN outcome = 'del' AND h = eh THEN NULL ELSE t END,
         CASE WHEN outcome = 'up' THEN eh WHEN outcome = 'del' AND h = eh THEN NULL ELSE h END,
         CASE WHEN outcome = 'del' THEN list_append(dels, eh) ELSE dels END, eh, et
  FROM (SELECT ev.user_id, ev.rn, ev.seq, r.t, r.h, r.dels, ev.h AS eh, ev.t AS et,
          CASE WHEN NOT ev.del AND r.t IS NOT NULL AND r.t <> ev.t THEN 'dead' WHEN ev.ent THEN 'skip' WHEN ev.del THEN 'del'
               WHEN list_contains(r.dels, ev.h) THEN 'blocked' ELSE 'up' END AS outcome
        FROM r JOIN ev ON ev.user_id = r.user_id AND ev.rn = r.rn + 1)),
fin AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rn DESC) = 1)"""
_V = ":1.0.0:1.0"

_TYPES = {
    "view": ("node", "NODE_UPSERT", "node_type", "NODE_DELETE", "node_id"),
    "click": ("edge", "EDGE_UPSERT", "edge_type", "EDGE_DELETE", "edge_id"),
    "signup": ("metadata", "FILE_METADATA_UPSERT", "size_bytes", None, None),
    "error": ("error", "PARSER_ERROR", "retryable", None, None),
    "purchase": ("node", "NODE_UPSERT", "node_type", "EDGE_DELETE", "edge_id"),
}


def _contract(event_type):
    payload, _, field, second, other = _TYPES[event_type]
    payload = f"CASE WHEN value < 50 THEN '{second.split('_')[0].lower()}' ELSE '{payload}' END" if second else f"'{payload}'"
    name = f"CASE WHEN value < 50 THEN '{other}' ELSE '{field}' END" if other else f"'{field}'"
    return f"""SELECT event_id, CASE WHEN k < 10 THEN 'missing event_id' WHEN k < 20 THEN 'const schema_version' WHEN k < 30 THEN 'extra source_path'
      WHEN k < 40 THEN 'type ' || {payload} || '.' || {name} WHEN k < 50 THEN 'missing ' || {payload} || '.' || {name} WHEN k < 55 THEN 'unknown event_type'
      WHEN k < 60 THEN 'not JSON' WHEN k < 65 THEN 'type ' || {payload} WHEN k < 70 THEN 'non-finite number' ELSE '' END AS violations FROM {EV} WHERE event_type = '{event_type}'"""


def _event_record(kind, topic, entity, content, payload, source):
    """Wire text of one event type."""
    digest = f"sha256('1.0|1.0.0|{kind}|' || {entity} || '|' || {content})"
    head = f"""'{{"schema_version":"1.0","event_id":"' || {digest} || '","event_type":"{kind}","event_time":"2026-01-01T00:00:00Z","repository_id":"docs","commit_sha":"c0ffee","file_id":"' || fid || '","file_path":"' || fpath || '","content_hash":"' || {content} || '","parser_version":"1.0.0",'"""
    return f"SELECT '{topic}' AS topic, fid AS key, '{kind}' AS event_type, {digest} AS event_id, {head} || {payload} || '}}' AS value FROM {source}"


def _event_records():
    nations = "(SELECT CAST(n_nationkey AS VARCHAR) AS fid, n_name || '.py' AS fpath, n_name AS now, CASE WHEN n_regionkey > 1 THEN 'before' ELSE n_name END AS old FROM nation)"
    upserts = f"{nations} JOIN customer ON fid = CAST(c_nationkey AS VARCHAR)"
    node = """'"node":{"node_id":"' || c_custkey || '","node_type":"' || c_mktsegment || '","name":' || CASE WHEN c_acctbal > 0 THEN '"' || c_name || '"' ELSE 'null' END || ',"qualified_name":null,"ast_path":"Module","line_start":' || length(c_name) || ',"column_start":null,"line_end":null,"column_end":null,"properties":{"has_value":' || CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END || ',"value_type":"' || c_mktsegment || '"}}'"""
    edge = """'"edge":{"edge_id":"' || o_orderkey || '","source_id":"' || o_custkey || '","target_id":"' || o_orderstatus || '","edge_type":"CALLS","properties":{}}'"""
    meta = """'"metadata":{"size_bytes":0,"line_count":1,"function_count":2,"class_count":3,"import_count":4,"node_count":5,"edge_count":6,"parse_duration_ms":7,"parse_status":"SUCCESS","parser":"python.ast"}'"""
    gone = f"{nations} JOIN supplier ON fid = CAST(s_nationkey AS VARCHAR)"
    parts = [
        _event_record("NODE_UPSERT", "cpg.nodes", "c_custkey", "now", node, upserts),
        _event_record("EDGE_UPSERT", "cpg.edges", "o_orderkey", "now", edge, f"{upserts} JOIN orders ON o_custkey = c_custkey"),
        _event_record("FILE_METADATA_UPSERT", "source.metadata", "fid", "now", meta, nations),
        _event_record("NODE_DELETE", "cpg.nodes", "s_name", "old", """'"node":{"node_id":"' || s_name || '"}'""", gone),
        _event_record("EDGE_DELETE", "cpg.edges", "s_name", "old", """'"edge":{"edge_id":"' || s_name || '"}'""", f"{gone} WHERE s_acctbal < 0"),
    ]
    return " UNION ALL ".join(parts)


def _per_topic(flag):
    return f"CAST(count(*) FILTER ({flag}) AS BIGINT)"


def statements() -> dict[str, str]:
    audit_flags = f"count(*) AS events, {_per_topic('eid IS NULL')} AS schema_failures, {_per_topic('foreign_key')} AS key_mismatchs, CAST(0 AS BIGINT) AS unexpected_file_ids"
    offsets = lambda until: f"(SELECT topic, partition, max(\"offset\") AS o FROM {AUDIT} {until} GROUP BY topic, partition)"
    window = f"""(SELECT topic, partition, min("offset") FILTER (CAST(ts AS DATE) >= DATE '2024-01-05') AS s, max("offset") FILTER (CAST(ts AS DATE) < DATE '2024-01-20') AS e FROM {AUDIT} GROUP BY topic, partition)"""
    delta = lambda old, new, name: f"SELECT topic, CAST(sum(greatest(0, coalesce(n.o, 0) - coalesce(b.o, 0))) AS BIGINT) AS {name} FROM {new} n FULL JOIN {old} b USING (topic, partition) GROUP BY topic"
    lines = "(SELECT CAST(l_orderkey AS VARCHAR) AS file_id, CAST(l_partkey AS VARCHAR) AS node_id, l_linestatus AS s, l_returnflag AS f FROM lineitem)"
    cust = "(SELECT CAST(c_custkey AS VARCHAR) AS file_id, c_name, c_mktsegment FROM customer)"
    part = "(SELECT CAST(p_partkey AS VARCHAR) AS file_id, p_name, p_brand FROM part)"
    sql = {
        "file_identity": f"SELECT file_path, sha256('docs|' || file_path) AS file_id, sha256(text) AS content_hash FROM {DOC}",
        "entity_ids": "SELECT o_orderkey, sha256(o_custkey || '|' || o_orderstatus || '|' || o_orderpriority || '||' || o_orderkey) AS node_id, sha256(o_custkey || '|CALLS|' || o_orderkey || '|call|' || o_orderpriority) AS edge_id FROM orders",
        "event_ids": f"SELECT event_id, sha256('1.0|1.0.0|' || event_type || '|' || user_id || '|' || h) AS digest, user_id || ':' || h || '{_V}' AS generation_id FROM {EV}",
        "manifest_scoped": f"SELECT * FROM {MANIFEST}",
        "scope_limit": f"SELECT * FROM {SAMPLE}",
        "path_contract": f"SELECT CAST(count(*) AS BIGINT) AS paths, CAST(count(*) - count(DISTINCT file_path) AS BIGINT) AS duplicates, {_per_topic('''NOT ends_with(file_path, '.py')''')} AS not_python, CAST(0 AS BIGINT) AS backslashes, {_per_topic('''starts_with(file_path, '../')''')} AS outside, {_per_topic('before >= file_path')} AS out_of_order FROM (SELECT file_path, lag(file_path) OVER (ORDER BY doc_id) AS before FROM {DOC})",
        "path_normalize": r"""SELECT page_id, CASE WHEN starts_with(url, 'http:') THEN 'starts at the root' END AS problem,
            regexp_replace(regexp_replace(replace(CASE WHEN starts_with(url, 'https://') THEN substr(url, 9) ELSE substr(url, 7) END, '//', '/'), '/$', ''), '/en/', '/en/', 'g') AS path FROM pages""",
        "manifest_sizes": f"SELECT count(*) AS files, min(size_bytes) AS min_size, max(size_bytes) AS max_size, avg(size_bytes) AS mean_size, median(size_bytes) AS median_size FROM {MANIFEST} WHERE included",
        "files_by_directory": f"SELECT split_part(file_path, '/', 1) AS directory, count(*) AS files FROM {MANIFEST} GROUP BY 1",
        "exclusion_reasons": f"SELECT exclusion_reason, count(*) AS files FROM {MANIFEST} WHERE NOT included GROUP BY 1",
        "manifest_problems": f"SELECT CAST(0 AS BIGINT) AS wrong_repository, count(*) AS wrong_commit, CAST(0 AS BIGINT) AS not_python, {_per_topic('content_sha256 IS NULL')} AS no_hash FROM {MANIFEST}",
        "manifest_subset": f"SELECT file_path FROM {MANIFEST} WHERE included AND file_path NOT IN (SELECT file_path FROM {SAMPLE} WHERE included)",
        "set_difference": "SELECT source, lang, CASE WHEN n > 0 THEN 'left' ELSE 'right' END AS only_in, CAST(abs(n) AS BIGINT) AS copies FROM (SELECT d.source, d.lang, count(*) - count(*) FILTER (l.quality = 1) AS n FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1, 2) WHERE n <> 0",
        "run_digests": "WITH d AS (SELECT doc_id, list_sort(string_split(text, chr(10))) AS ls FROM documents WHERE text IS NOT NULL) SELECT doc_id, CAST(len(ls) AS BIGINT) AS rows, min(doc_id) OVER (PARTITION BY ls) AS same_as FROM d",
        "read_rules": "SELECT url AS file_path, CASE WHEN n > 20000 THEN url || ': ' || n || ' bytes, more than the limit of 20000' END AS read_error, CASE WHEN n <= 20000 THEN n END AS size_bytes FROM (SELECT url, octet_length(encode(html)) AS n FROM pages)",
        "change_classification": f"SELECT file_path, change, previous_hash FROM {CLASSIFIED}",
        "unchanged_skip": f"SELECT file_path, content_hash FROM {CLASSIFIED} WHERE change = 'UNCHANGED'",
        "graph_diff_removed": f"SELECT DISTINCT file_id, node_id FROM {lines} a WHERE NOT EXISTS (SELECT 1 FROM {lines} b WHERE b.s = 'O' AND a.file_id = b.file_id AND a.node_id = b.node_id)",
        "full_snapshot_upsert": f"SELECT file_id, count(*) AS upserts FROM {lines} WHERE s = 'O' GROUP BY file_id",
        "replay_summary": f"""SELECT CAST(o_orderkey AS VARCHAR) AS file_id, o_orderkey || '.py' AS file_path,
            CASE WHEN o_orderstatus = 'F' THEN 'SKIPPED_UNCHANGED' WHEN o_totalprice < 20000 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
            CASE WHEN o_orderstatus = 'O' THEN 'None' ELSE 'old' END AS old_content_hash, o_orderpriority AS new_content_hash,
            CAST(coalesce(a, 0) AS BIGINT) AS removed_node_count, CAST(coalesce(b, 0) AS BIGINT) AS removed_edge_count,
            CAST(coalesce(c, 0) AS BIGINT) AS upsert_node_count, CAST(coalesce(d, 0) AS BIGINT) AS upsert_edge_count,
            CASE WHEN o_totalprice < 20000 THEN 'SyntaxError' END AS error
          FROM orders LEFT JOIN (SELECT l_orderkey, count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'F') AS a,
              count(*) FILTER (l_returnflag = 'A' AND l_linestatus = 'F') AS b, count(*) FILTER (l_returnflag = 'N' AND l_linestatus = 'O') AS c,
              count(*) FILTER (l_returnflag = 'A' AND l_linestatus = 'O') AS d FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
        "file_results": f"SELECT * FROM {RESULTS}",
        "run_summary": f"SELECT count(*) AS discovered, count(*) AS eligible, count(*) FILTER (status = 'SUCCESS') AS processed, count(*) FILTER (status = 'SKIPPED_UNCHANGED') AS skipped_unchanged, count(*) FILTER (status = 'FAILED') AS failed, CAST(sum(node_topic) AS BIGINT) AS node_events, CAST(sum(edge_topic) AS BIGINT) AS edge_events, CAST(0 AS BIGINT) AS metadata_events, count(*) FILTER (status = 'FAILED') AS error_events FROM {RESULTS}",
        "event_records": _event_records(),
        "error_events": "SELECT 'parser.errors' AS topic, sha256('docs|' || p) AS key, sha256('1.0|1.0.0|PARSER_ERROR|' || sha256('docs|' || p) || '|0') AS event_id, '{\"schema_version\":\"1.0\",\"event_id\":\"' || sha256('1.0|1.0.0|PARSER_ERROR|' || sha256('docs|' || p) || '|0') || '\",\"event_type\":\"PARSER_ERROR\",\"event_time\":\"2026-01-01T00:00:00Z\",\"repository_id\":\"docs\",\"commit_sha\":\"c0ffee\",\"file_id\":\"' || sha256('docs|' || p) || '\",\"file_path\":\"' || p || '\",\"content_hash\":\"0\",\"parser_version\":\"1.0.0\",\"error\":{\"error_type\":\"ReadFileError\",\"message\":\"unreadable\",\"line\":null,\"column\":null,\"retryable\":false}}' AS value FROM (SELECT source || '/' || doc_id || '.py' AS p FROM documents WHERE lang = 'es')",
        "event_order": f"SELECT file_id, event_type, entity_id, row_number() OVER (PARTITION BY file_id ORDER BY CASE event_type WHEN 'NODE_DELETE' THEN 1 WHEN 'NODE_UPSERT' THEN 2 ELSE 3 END, entity_id) AS sequence FROM {ORDER_EVENTS}",
        "events_valid": f"SELECT event_type, count(*) AS events, CAST(0 AS BIGINT) AS invalid FROM ({_event_records()}) GROUP BY event_type",
        "publish_gate": "SELECT event_id, NOT max(event_type = 'error' AND value > 150) OVER (PARTITION BY user_id) AS publishable FROM events",
        "validate_node": _contract("view"),
        "validate_edge": _contract("click"),
        "validate_metadata": _contract("signup"),
        "validate_error": _contract("error"),
        "validate_stream": " UNION ALL ".join(map(_contract, _TYPES)),
        "nonfinite_reject": f"SELECT event_type, count(*) AS rejected FROM (SELECT event_type, CASE WHEN event_type = 'error' THEN CAST('nan' AS DOUBLE) WHEN k > 90 THEN CAST('-inf' AS DOUBLE) ELSE value END AS v FROM {EV}) WHERE isnan(v) OR isinf(v) GROUP BY event_type",
        "stream_audit": f"SELECT topic, {audit_flags}, CAST(NULL AS BIGINT) AS duplicate_event_ids FROM {AUDIT} GROUP BY topic UNION ALL SELECT NULL, {audit_flags}, CAST(count(eid) - count(DISTINCT eid) AS BIGINT) FROM {AUDIT}",
        "audit_expected_ids": f"SELECT topic, {audit_flags.replace('CAST(0 AS BIGINT)', _per_topic("user_id <> 8"))}, CAST(NULL AS BIGINT) AS duplicate_event_ids FROM {AUDIT} GROUP BY topic UNION ALL SELECT NULL, {audit_flags.replace('CAST(0 AS BIGINT)', _per_topic("user_id <> 8"))}, CAST(count(eid) - count(DISTINCT eid) AS BIGINT) FROM {AUDIT}",
        "partition_consistency": f"SELECT topic, CASE WHEN foreign_key THEN 'other' ELSE 'f' || user_id END AS file_id, count(DISTINCT partition) AS partitions FROM {AUDIT} GROUP BY 1, 2 HAVING count(DISTINCT partition) > 1",
        "offset_order": "SELECT event_type AS topic, user_id AS key, count(*) FILTER (before >= o) AS out_of_order FROM (SELECT event_type, user_id, floor(value) AS o, lag(floor(value)) OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS before FROM events) GROUP BY 1, 2",
        "offset_window": f"""SELECT topic, partition, count(*) AS records, min("offset") AS first, max("offset") AS last FROM {AUDIT} JOIN {window} USING (topic, partition) WHERE "offset" >= s AND "offset" < e GROUP BY topic, partition""",
        "offset_delta": delta(offsets("WHERE ts < TIMESTAMP '2024-01-10'"), offsets(""), "delta"),
        "consumer_lag": delta(offsets("WHERE ts < TIMESTAMP '2024-01-25'"), offsets(""), "lag"),
        "metadata_flatten": f"SELECT * EXCLUDE (seq) FROM {META}",
        "metadata_latest": f"SELECT * FROM {LATEST}",
        "metadata_duplicates": f"SELECT 'file_id' AS broken_key, file_id AS value, count(*) AS copies FROM {META} GROUP BY 2 HAVING count(*) > 1 UNION ALL SELECT 'repository_id, file_path', repository_id || '|' || file_path, count(*) FROM {META} GROUP BY 2 HAVING count(*) > 1",
        "metadata_sample": f"SELECT file_path, size_bytes, parse_status FROM {LATEST} ORDER BY file_path LIMIT 3",
        "metadata_lookup": f"SELECT file_path, event_id, size_bytes FROM {LATEST} WHERE file_path = 'u/8.py'",
        "line_stats": r"""SELECT doc_id, octet_length(encode(text)) AS size_bytes, CAST(len(p) - CASE WHEN p[-1] = '' THEN 1 ELSE 0 END AS BIGINT) AS line_count
            FROM (SELECT doc_id, text, string_split_regex(text, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]') AS p FROM documents)""",
        "node_fold": f"WITH {NODE_HISTORY}, props AS (SELECT id, string_agg(p, ',' ORDER BY p) AS properties FROM (SELECT e.id, 'p_' || e.name || '=' || arg_max(k, seq) AS p FROM e JOIN live USING (id) WHERE NOT del AND seq > coalesce(g, -1) GROUP BY e.id, e.name) GROUP BY id) SELECT id, name, false AS placeholder, 'f' || user_id || ':' || h || '{_V}' AS generation_id, properties FROM live JOIN props USING (id)",
        "node_tombstones": f"WITH {NODE_HISTORY} SELECT DISTINCT id, 'f' || user_id || ':' || h || '{_V}' AS generation_id, 'f' || user_id AS file_id FROM hit",
        "edge_fold": f"{EDGE_HISTORY} SELECT 'e' || user_id AS edge_id, 'n' || user_id AS source_id, t AS target_id, 'f' || user_id || ':' || h || '{_V}' AS generation_id FROM fin WHERE t IS NOT NULL",
        "edge_tombstones": f"{EDGE_HISTORY} SELECT 'e' || user_id AS id, 'f' || user_id || ':' || d || '{_V}' AS generation_id, 'f' || user_id AS file_id, d AS content_hash FROM (SELECT DISTINCT user_id, unnest(dels) AS d FROM fin)",
        "placeholders": f"{EDGE_HISTORY} SELECT id, 'f' || u AS file_id, 'f' || u || ':' || h || '{_V}' AS generation_id, h AS content_hash FROM (SELECT id, arg_min(user_id, seq) AS u, arg_min(eh, seq) AS h FROM (SELECT 'n' || user_id AS id, user_id, eh, seq FROM r WHERE outcome = 'up' UNION ALL SELECT et, user_id, eh, seq FROM r WHERE outcome = 'up') GROUP BY id) WHERE id NOT IN (SELECT id FROM live)",
        "dead_letters": f"{EDGE_HISTORY} SELECT 'connector.errors' AS topic, 'f' || user_id AS key, 'edge endpoints differ from the stored edge' AS reason, seq FROM r WHERE outcome = 'dead'",
        "dead_letters_of_long_histories": f"{EDGE_HISTORY} SELECT 'connector.errors' AS topic, 'f' || user_id AS key, 'edge endpoints differ from the stored edge' AS reason, seq FROM r WHERE outcome = 'dead'",
        "node_dead_letters": f"SELECT 'cpg.nodes' AS topic, 'f' || user_id AS key, CASE WHEN event_id % 100 < 10 THEN 'malformed event' ELSE 'NODE_UPSERT without node_id' END AS reason, event_id AS seq FROM {EV} WHERE event_id % 100 < 10 OR event_id % 100 < 20 AND event_type <> 'purchase'",
        "state_upsert": f"SELECT file_id, CASE WHEN c_name IS NULL THEN 'other' ELSE 'docs' END AS repository_id, coalesce(c_name, p_name) AS file_path, coalesce(p_brand, c_mktsegment) AS content_hash, CASE WHEN p_brand IS NOT NULL THEN '1.0.0' END AS parser_version, CASE WHEN p_brand IS NOT NULL THEN '1.0' END AS schema_version FROM {cust} FULL JOIN {part} USING (file_id)",
        "state_delete": f"SELECT file_id, c_name AS file_path FROM {cust} WHERE file_id NOT IN (SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'P')",
        "state_load": f"SELECT file_id, c_name AS file_path, CAST(NULL AS VARCHAR) AS parser_version FROM {part} LEFT JOIN {cust} USING (file_id)",
        "entity_state": "SELECT CAST(l_orderkey AS VARCHAR) AS file_id, count(*) AS entities FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey WHERE CASE WHEN coalesce(o_orderstatus, '') = 'O' THEN 'O' ELSE 'F' END = l_linestatus GROUP BY l_orderkey",
        "graph_counts": f"SELECT (SELECT count(*) FROM {GRAPH_NODES} WHERE file_id = '7') AS node_count, (SELECT count(*) FROM {GRAPH_EDGES} WHERE file_id = '7') AS edge_count",
        "top_files": f"SELECT file_id, count(*) AS node_count FROM {GRAPH_NODES} GROUP BY file_id ORDER BY node_count DESC, file_id NULLS FIRST LIMIT 10",
        "top_files_edges": f"SELECT file_id, count(*) AS edge_count FROM {GRAPH_EDGES} GROUP BY file_id ORDER BY edge_count DESC, file_id NULLS FIRST LIMIT 10",
        "duplicate_edges": f"SELECT edge_type, file_id, count(*) AS copies FROM {GRAPH_EDGES} GROUP BY ALL HAVING count(*) > 1",
        "null_properties_nodes": f"SELECT id, file_id, generation_id FROM {GRAPH_NODES} WHERE file_id IS NULL OR generation_id IS NULL",
        "duplicate_ids": f"SELECT id, count(*) AS copies FROM {GRAPH_NODES} GROUP BY id HAVING count(*) > 1",
        "null_properties": f"SELECT edge_id, file_id, generation_id FROM {GRAPH_EDGES} WHERE file_id IS NULL OR generation_id IS NULL",
        "open_placeholders": f"SELECT file_id, count(*) AS placeholders FROM {GRAPH_NODES} WHERE placeholder GROUP BY file_id",
        "tombstone_summary": f"""WITH n AS (SELECT id, generation_id, count(*) AS c, count(*) FILTER (file_id IS NULL OR generation_id IS NULL) AS b FROM {GRAPH_NODES} GROUP BY 1, 2),
            g AS (SELECT edge_type, generation_id, count(*) AS c, count(*) FILTER (file_id IS NULL OR generation_id IS NULL) AS b FROM {GRAPH_EDGES} GROUP BY 1, 2)
            SELECT (SELECT CAST(sum(c) AS BIGINT) FROM n) AS node_tombstone_count, (SELECT CAST(sum(c) AS BIGINT) FROM g) AS edge_tombstone_count,
              (SELECT count(*) FROM n WHERE c > 1) AS duplicate_node_tombstones, (SELECT count(*) FROM g WHERE c > 1) AS duplicate_edge_tombstones,
              CAST((SELECT sum(b) FROM n) + (SELECT sum(b) FROM g) AS BIGINT) AS malformed_tombstones""",
        "edge_type_dist": f"SELECT edge_type, count(*) AS edges FROM {GRAPH_EDGES} GROUP BY edge_type",
    }
    return sql | graph_statements()
