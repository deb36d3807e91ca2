"""DuckDB SQL for every registered query (tables are pre-registered views).

The adapter rules of ``plans.adapters`` are restated here in SQL so the
oracle is an independent statement of the same result.
"""

from __future__ import annotations

from fieldcat.plans import adapters as ad
from fieldcat.schemas import unique_keys


def _kw(x: str) -> str:
    return (f"list_transform(list_filter(regexp_split_to_array({x}, '[^a-zA-Z0-9]'), "
            f"lambda t: length(t) > 0), lambda t: lower(t))")


def _in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


DOC_PATH = "'/data/' || source || '/' || lang || '/doc_' || CAST(doc_id AS VARCHAR) || '.h5'"

META_CTE = f"""
d AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic,
         '/data/' || d.source || '/' || d.lang || '/doc_' || CAST(d.doc_id AS VARCHAR) || '.h5' AS file_path
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
), m AS (
  SELECT doc_id, file_path, n_chars AS size, text AS file_name,
    CASE WHEN quality = 1 THEN 'pi-' || lang END AS pi,
    lang || '@' || source || '.example' AS email,
    source AS instrument_name,
    CASE WHEN quality IS NULL THEN NULL WHEN toxic = 1 THEN 'None' WHEN quality = 0 THEN ''
         ELSE 'P-' || CAST(doc_id AS VARCHAR) END AS proposal,
    CASE WHEN source = 'src0' THEN '' WHEN source = 'src8' THEN 'bl832' ELSE source END AS beamline,
    lang AS username,
    CAST(to_json(struct_pack(n_chars := n_chars, quality := quality, toxic := toxic)) AS VARCHAR)
      AS scientific_metadata
  FROM d
), acl AS (
  SELECT *,
    CASE WHEN proposal IS NOT NULL AND proposal <> '' AND proposal <> 'None' THEN proposal
         ELSE username END AS owner_group,
    CASE WHEN beamline IS NOT NULL AND beamline <> '' THEN
         CASE WHEN beamline = 'bl832' THEN [beamline, username, '8.3.2'] ELSE [beamline, username] END
         ELSE []::VARCHAR[] END AS access_groups
  FROM m
)"""

DATASET_CATALOG = f"""
WITH {META_CTE}, k AS (SELECT *, {_kw('file_name')} AS kw FROM acl)
SELECT sha256(file_path) AS pid,
  coalesce(nullif(pi, ''), 'Unknown') AS owner,
  coalesce(nullif(email, ''), 'Unknown') AS contactEmail,
  coalesce(nullif(instrument_name, ''), 'Unknown') AS creationLocation,
  file_name AS datasetName, 'raw' AS type,
  coalesce(nullif(instrument_name, ''), 'Unknown') AS instrumentId,
  proposal AS proposalId, 'DX' AS dataFormat,
  coalesce(nullif(pi, ''), 'Unknown') AS principalInvestigator,
  regexp_replace(file_path, '/+[^/]*$', '') AS sourceFolder,
  CAST(size AS BIGINT) AS size, scientific_metadata AS scientificMetadata,
  array_to_string(kw, ' ') AS sampleId, false AS isPublished,
  array_to_string(kw, ' ') AS description, CAST(len(kw) AS BIGINT) AS n_keywords,
  CAST(NULL AS VARCHAR) AS creationTime, owner_group AS ownerGroup,
  array_to_string(access_groups, ',') AS accessGroups
FROM k
"""

SEARCH_TERMS_DOCUMENTS = f"""
SELECT doc_id, array_to_string({_kw('text')}, ' ') AS terms,
       CAST(len({_kw('text')}) AS BIGINT) AS n_keywords
FROM documents
"""

SEARCH_TERMS_PAGES = f"""
SELECT page_id, array_to_string({_kw('url')}, ' ') AS terms,
       CAST(len({_kw('url')}) AS BIGINT) AS n_keywords
FROM pages
"""

ACCESS_CONTROLS = f"""
WITH {META_CTE}
SELECT doc_id, owner_group, array_to_string(access_groups, ',') AS access_groups,
       CAST(len(access_groups) AS BIGINT) AS n_access_groups
FROM acl
"""

FIELDS_CTE = f"""
df AS (
  SELECT doc_id, text, lang, source, n_chars, {DOC_PATH} AS file_path, source AS mapping_id
  FROM documents
), fields AS (
  SELECT file_path, '/doc/lang' AS key, 'S' AS kind, []::BIGINT[] AS shape, []::BIGINT[] AS maxshape,
         [lang] AS str_values, NULL::BIGINT[] AS int_values, NULL::DOUBLE[] AS dbl_values FROM df
  UNION ALL SELECT file_path, '/doc/source', 'S', [1]::BIGINT[], [1]::BIGINT[], [source], NULL, NULL FROM df
  UNION ALL SELECT file_path, '/doc/n_chars', 'i', [1]::BIGINT[], [1]::BIGINT[], NULL, [n_chars], NULL FROM df
  UNION ALL SELECT file_path, '/doc/text', 'S', []::BIGINT[], []::BIGINT[], [text], NULL, NULL FROM df
  UNION ALL SELECT df.file_path, '/labels/quality', 'i', [1]::BIGINT[], [NULL]::BIGINT[], NULL,
                   [CAST(l.quality AS BIGINT)], NULL FROM labels l JOIN df ON l.doc_id = df.doc_id
  UNION ALL SELECT df.file_path, '/labels/toxic', 'i', []::BIGINT[], []::BIGINT[], NULL,
                   [CAST(l.toxic AS BIGINT)], NULL FROM labels l JOIN df ON l.doc_id = df.doc_id
), keys(key, key_seq) AS (
  VALUES {", ".join(f"('{k}', {i})" for i, k in enumerate(unique_keys(ad.REQUESTED_KEYS)))}
)"""

NORM_CTE = f"""
u AS (
  SELECT *, CASE WHEN kind = 'S' THEN (len(shape) = 0 OR (len(shape) = 1 AND shape[1] = 1))
                 ELSE ((len(maxshape) = 1 AND coalesce(maxshape[1] = 1, false)) OR len(shape) = 0)
            END AS unbox
  FROM fields WHERE key IN ({_in_list(unique_keys(ad.REQUESTED_KEYS))})
), norm AS (
  SELECT file_path, key,
    CASE WHEN kind = 'S' THEN CASE WHEN unbox THEN 'string' ELSE 'string_array' END
         WHEN kind = 'i' THEN CASE WHEN unbox THEN 'int' ELSE 'int_array' END
         ELSE CASE WHEN unbox THEN 'double' ELSE 'double_array' END END AS value_kind,
    CASE WHEN kind = 'S' AND unbox THEN str_values[1]
         WHEN kind = 'i' AND unbox THEN CAST(int_values[1] AS VARCHAR)
         WHEN kind = 'S' THEN array_to_string(str_values, ',')
         WHEN kind = 'i' THEN array_to_string(list_transform(int_values, lambda x: CAST(x AS VARCHAR)), ',')
    END AS value_text,
    CAST(CASE WHEN kind = 'S' THEN len(str_values) WHEN kind = 'i' THEN len(int_values)
              ELSE len(dbl_values) END AS BIGINT) AS n_values
  FROM u
)"""

FIELD_EXTRACT = f"""
WITH {FIELDS_CTE}, {NORM_CTE}
SELECT file_path, key, value_kind, value_text, n_values FROM norm
"""


def _col(k):
    return k.strip("/").replace("/", "_").replace(":", "_")


FIELD_PIVOT = f"""
WITH {FIELDS_CTE}, {NORM_CTE}
SELECT file_path,
  {", ".join(f"max(value_text) FILTER (WHERE key = '{k}') AS {_col(k)}" for k in unique_keys(ad.REQUESTED_KEYS))}
FROM norm GROUP BY file_path
"""

SCIENTIFIC_METADATA = f"""
WITH {FIELDS_CTE}, {NORM_CTE}, j AS (
  SELECT n.file_path, k.key_seq,
    CAST(to_json(n.key) AS VARCHAR) || ':' || CASE
      WHEN n.value_kind = 'string' THEN coalesce(CAST(to_json(n.value_text) AS VARCHAR), 'null')
      WHEN n.value_kind = 'int' THEN coalesce(n.value_text, 'null')
      WHEN n.value_kind = 'string_array' THEN CAST(to_json(string_split(n.value_text, ',')) AS VARCHAR)
      ELSE '[' || n.value_text || ']' END AS e
  FROM norm n JOIN keys k ON n.key = k.key
)
SELECT file_path, '{{' || string_agg(e, ',' ORDER BY key_seq) || '}}' AS metadata
FROM j GROUP BY file_path
"""

MISSING_KEY_ISSUES = f"""
WITH {FIELDS_CTE}
SELECT f.file_path, k.key, k.key_seq, 'extract' AS stage, 'warning' AS severity,
       'dataset not found ' || k.key AS msg
FROM df f CROSS JOIN keys k
WHERE NOT EXISTS (SELECT 1 FROM fields x WHERE x.file_path = f.file_path AND x.key = k.key)
"""

BATCH_CTE = f"""
{FIELDS_CTE}, batch AS (
  SELECT 'job-' || CAST(doc_id AS VARCHAR) AS job_id, file_path, mapping_id,
         mapping_id IN ({_in_list(ad.REGISTERED_SPECS)}) AS registered
  FROM df
), issues AS (
  SELECT job_id, -1 AS seq, 'error' AS severity,
         'mapping is not configured ' || file_path || ' and mapping ' || mapping_id AS msg
  FROM batch WHERE NOT registered
  UNION ALL
  SELECT b.job_id, k.key_seq, 'warning', 'dataset not found ' || k.key
  FROM batch b CROSS JOIN keys k
  WHERE b.registered AND NOT EXISTS (
    SELECT 1 FROM fields x WHERE x.file_path = b.file_path AND x.key = k.key)
)"""

JOB_FINAL_STATUS = f"""
WITH {BATCH_CTE}, s AS (
  SELECT job_id, count(*) AS n_issues,
         sum(CASE WHEN severity = 'error' THEN 1 ELSE 0 END) AS n_errors,
         sum(CASE WHEN severity = 'warning' THEN 1 ELSE 0 END) AS n_warnings
  FROM issues GROUP BY job_id
)
SELECT b.job_id,
  CASE WHEN coalesce(s.n_errors, 0) > 0 THEN 'error'
       WHEN coalesce(s.n_issues, 0) > 0 THEN 'complete_with_issues' ELSE 'successful' END AS status,
  CAST(coalesce(s.n_issues, 0) AS BIGINT) AS n_issues,
  CAST(coalesce(s.n_errors, 0) AS BIGINT) AS n_errors,
  CAST(coalesce(s.n_warnings, 0) AS BIGINT) AS n_warnings
FROM batch b LEFT JOIN s ON b.job_id = s.job_id
"""

JOB_LOG = f"""
WITH {BATCH_CTE}, s AS (
  SELECT job_id, string_agg(chr(10) || ' :  ' || msg, '' ORDER BY seq) AS body
  FROM issues GROUP BY job_id
)
SELECT b.job_id,
  'ingested dataset: ' || b.file_path || ' as '
    || coalesce(CASE WHEN b.registered THEN sha256(b.file_path) END, 'None')
    || coalesce(s.body, '') AS log
FROM batch b LEFT JOIN s ON b.job_id = s.job_id
"""

REGISTRY_MATCH = f"""
WITH {BATCH_CTE}
SELECT job_id, mapping_id, registered,
  CASE WHEN NOT registered THEN 'mapping is not configured ' || file_path || ' and mapping ' || mapping_id
  END AS error_msg
FROM batch
"""

ARRAY_STRIDE = """
WITH s AS (
  SELECT vec_id, embedding, CAST(len(embedding) AS BIGINT) AS n_values,
         CAST(greatest(len(embedding) // 10, 1) AS BIGINT) AS step
  FROM embeddings
), t AS (
  SELECT vec_id, n_values, step,
         list_filter(embedding, lambda x, i: (i - 1) % step = 0) AS sample
  FROM s
)
SELECT vec_id, n_values, step, CAST(len(sample) AS BIGINT) AS sample_len,
       CAST(generate_subscripts(sample, 1) - 1 AS BIGINT) AS pos,
       CAST(unnest(sample) AS DOUBLE) AS value
FROM t
"""

STRIDE_CTE = """
e AS (
  SELECT event_id, ts, user_id, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS row_idx,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM events
), s AS (
  SELECT * FROM e WHERE row_idx % greatest(n // 10, 1) = 0
)"""

ROW_STRIDE = f"""
WITH {STRIDE_CTE}
SELECT user_id, event_id, ts, event_type, CAST(row_idx AS BIGINT) AS row_idx, CAST(n AS BIGINT) AS n
FROM s
"""

EVENT_PAGE_JSON = f"""
WITH {STRIDE_CTE}
SELECT user_id,
  '{{"event_id":{{' || string_agg('"' || row_idx || '":' || event_id, ',' ORDER BY row_idx)
  || '}},"event_type":{{' || string_agg('"' || row_idx || '":"' || event_type || '"', ',' ORDER BY row_idx)
  || '}},"ts":{{' || string_agg('"' || row_idx || '":' || (epoch_us(ts) // 1000), ',' ORDER BY row_idx)
  || '}}}}' AS page_json
FROM s GROUP BY user_id
"""

NONFINITE_MASK = """
WITH s AS (
  SELECT vec_id, list_transform(embedding, lambda x:
    CASE WHEN CAST(x AS DOUBLE) > 0.2 THEN CAST('Infinity' AS DOUBLE)
         WHEN CAST(x AS DOUBLE) < -0.2 THEN CAST('-Infinity' AS DOUBLE)
         WHEN abs(CAST(x AS DOUBLE)) < 0.001 THEN CAST('NaN' AS DOUBLE)
         ELSE CAST(x AS DOUBLE) END) AS sat
  FROM embeddings
), m AS (
  SELECT vec_id, list_transform(sat, lambda x: CASE WHEN isnan(x) OR isinf(x) THEN NULL ELSE x END) AS masked
  FROM s
)
SELECT vec_id, CAST(generate_subscripts(masked, 1) - 1 AS BIGINT) AS pos, unnest(masked) AS value FROM m
"""

EVENTS_CTE = """
ev AS (
  SELECT 'job-' || CAST(user_id AS VARCHAR) AS id, ts AS time,
    CASE event_type WHEN 'signup' THEN 'submitted' WHEN 'view' THEN 'running'
      WHEN 'click' THEN 'complete_with_issues' WHEN 'purchase' THEN 'successful'
      WHEN 'error' THEN 'error' END AS status,
    CASE WHEN event_type = 'signup' THEN 'user' || CAST(user_id AS VARCHAR) ELSE 'system' END AS submitter,
    props AS log, event_id
  FROM events
), r AS (
  SELECT *, CASE status WHEN 'submitted' THEN 0 WHEN 'running' THEN 1 ELSE 2 END AS rnk FROM ev
)"""

JOBS_CTE = f"""
{EVENTS_CTE}, lastev AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY time DESC, rnk DESC, event_id DESC) AS rn
                 FROM r) WHERE rn = 1
), firsts AS (
  SELECT id, min(time) FILTER (WHERE status = 'submitted') AS submit_time,
         min(time) FILTER (WHERE status = 'running') AS start_time,
         min(time) FILTER (WHERE status IN ('complete_with_issues', 'successful', 'error')) AS end_time,
         count(*) AS n_events
  FROM r GROUP BY id
), subm AS (
  SELECT id, submitter FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY time, rnk, event_id) AS rn
    FROM r WHERE status = 'submitted') WHERE rn = 1
), jobs AS (
  SELECT f.id, l.status, l.time AS status_time, f.submit_time, f.start_time, f.end_time,
         s.submitter, l.submitter AS last_actor, l.log AS last_log, CAST(f.n_events AS BIGINT) AS n_events
  FROM firsts f JOIN lastev l ON f.id = l.id LEFT JOIN subm s ON f.id = s.id
)"""

JOB_CURRENT = f"""
WITH {JOBS_CTE}
SELECT id, status, status_time, submit_time, start_time, end_time, submitter, last_actor, n_events
FROM jobs
"""

JOB_HISTORY = f"""
WITH {EVENTS_CTE}
SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY time, rnk, event_id) AS BIGINT) AS pos,
       CAST(count(*) OVER (PARTITION BY id) AS BIGINT) AS history_len,
       time, status, submitter, event_id
FROM r
"""

ORACLE = {
    "dataset_catalog": DATASET_CATALOG,
    "search_terms_documents": SEARCH_TERMS_DOCUMENTS,
    "search_terms_pages": SEARCH_TERMS_PAGES,
    "access_controls": ACCESS_CONTROLS,
    "field_extract": FIELD_EXTRACT,
    "field_pivot": FIELD_PIVOT,
    "missing_key_issues": MISSING_KEY_ISSUES,
    "scientific_metadata": SCIENTIFIC_METADATA,
    "job_final_status": JOB_FINAL_STATUS,
    "job_log": JOB_LOG,
    "registry_match": REGISTRY_MATCH,
    "array_stride": ARRAY_STRIDE,
    "row_stride": ROW_STRIDE,
    "event_page_json": EVENT_PAGE_JSON,
    "nonfinite_mask": NONFINITE_MASK,
    "job_current": JOB_CURRENT,
    "job_history": JOB_HISTORY,
}

TRANSITIONS_CTE = f"""
{EVENTS_CTE}, p AS (
  SELECT *, coalesce(lag(status) OVER (PARTITION BY id ORDER BY time, rnk, event_id), 'none') AS prev_status
  FROM r
)"""

JOB_TRANSITIONS = f"""
WITH {TRANSITIONS_CTE}
SELECT id, event_id, time, prev_status, status, 'invalid transition ' || prev_status || ' -> ' || status AS msg
FROM p
WHERE NOT (
  (prev_status = 'none' AND status = 'submitted')
  OR (prev_status = 'submitted' AND status IN ('running', 'error'))
  OR (prev_status = 'running' AND status IN ('running', 'complete_with_issues', 'successful', 'error')))
"""

JOB_LOOKUP = f"""
WITH {JOBS_CTE}
SELECT 'job-' || CAST(c.c_custkey AS VARCHAR) AS id, j.id IS NOT NULL AS found, j.status
FROM customer c LEFT JOIN jobs j ON j.id = 'job-' || CAST(c.c_custkey AS VARCHAR)
"""

UNSTARTED_JOBS = f"""
WITH {JOBS_CTE}
SELECT id, submit_time, submitter, status_time FROM jobs WHERE status = 'submitted'
"""

NEXT_JOB = f"""
WITH {JOBS_CTE}
SELECT id, submit_time, submitter FROM jobs WHERE status = 'submitted'
ORDER BY submit_time DESC, id DESC LIMIT 1
"""

PENDING_TERMINAL = f"""
WITH {JOBS_CTE}
SELECT id, status, CASE WHEN status IN ('submitted', 'running') THEN 'pending' ELSE 'terminal' END AS phase
FROM jobs
"""

STATUS_TIMELINE = f"""
WITH {BATCH_CTE}, s AS (
  SELECT job_id, count(*) AS n_issues, sum(CASE WHEN severity = 'error' THEN 1 ELSE 0 END) AS n_errors,
         string_agg(chr(10) || ' :  ' || msg, '' ORDER BY seq) AS body
  FROM issues GROUP BY job_id
), items AS (
  SELECT job_id, CAST(2 AS BIGINT) AS pos, 'running' AS status, 'Starting job' AS log FROM batch
  UNION ALL
  SELECT b.job_id, CAST(3 AS BIGINT),
    CASE WHEN coalesce(s.n_errors, 0) > 0 THEN 'error'
         WHEN coalesce(s.n_issues, 0) > 0 THEN 'complete_with_issues' ELSE 'successful' END,
    'ingested dataset: ' || b.file_path || ' as '
      || coalesce(CASE WHEN b.registered THEN sha256(b.file_path) END, 'None') || coalesce(s.body, '')
  FROM batch b LEFT JOIN s ON b.job_id = s.job_id
), l AS (SELECT *, string_split(log, chr(10)) AS lines FROM items)
SELECT job_id, pos, status, CAST(generate_subscripts(lines, 1) - 1 AS INTEGER) AS line_no,
       unnest(lines) AS line
FROM l
"""

REQ_CTE = """
req AS (
  SELECT 'req-' || CAST(o_orderkey AS VARCHAR) AS id, o_orderkey,
         sha256('key-' || CAST(o_custkey AS VARCHAR)) AS digest,
         '/data/orders/' || CAST(o_orderkey AS VARCHAR) || '.h5' AS document_path,
         o_orderpriority AS mapping_id, o_orderdate AS submit_time
  FROM orders
), cl AS (
  SELECT sha256('key-' || CAST(c_custkey AS VARCHAR)) AS digest, c_name AS client, c_mktsegment AS api
  FROM customer WHERE c_acctbal >= 0
)"""

ADMITTED_REQUESTS = f"""
WITH {REQ_CTE}
SELECT r.id, c.client AS submitter, r.document_path, r.mapping_id, r.submit_time
FROM req r JOIN cl c ON r.digest = c.digest
"""

JOB_SUBMISSIONS = f"""
WITH {REQ_CTE}
SELECT r.id, r.submit_time AS time, 'submitted' AS status, c.client AS submitter, CAST(NULL AS VARCHAR) AS log
FROM req r JOIN cl c ON r.digest = c.digest
"""

REJECTED_REQUESTS = f"""
WITH {REQ_CTE}
SELECT r.id, r.document_path, r.submit_time FROM req r
WHERE NOT EXISTS (SELECT 1 FROM cl c WHERE c.digest = r.digest)
"""

DUPLICATE_IDS = """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""

REGISTRY_FIRST_WINS = """
SELECT p_brand, p_partkey, p_name, p_type FROM (
  SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM part
) WHERE rn = 1
"""

ORPHAN_EVENTS = f"""
WITH {REQ_CTE}, acc AS (SELECT r.id FROM req r JOIN cl c ON r.digest = c.digest)
SELECT 'req-' || CAST(l_orderkey AS VARCHAR) AS id, l_orderkey, l_linenumber, l_linestatus
FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM acc WHERE acc.id = 'req-' || CAST(l_orderkey AS VARCHAR))
"""

ORPHAN_CHILDREN = f"""
WITH {BATCH_CTE}
SELECT b.file_path, sha256(b.file_path) AS datasetId FROM batch b
WHERE NOT EXISTS (SELECT 1 FROM batch p WHERE p.registered AND sha256(p.file_path) = sha256(b.file_path))
"""

ORDER_DATASETS_CTE = """
ds AS (
  SELECT o.o_orderkey AS pid, 'c' || CAST(o.o_custkey AS VARCHAR) AS owner,
         ['n' || CAST(c.c_nationkey AS VARCHAR), 's' || o.o_orderstatus] AS access,
         c.c_nationkey AS proposal
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
), us AS (
  SELECT s_name AS "user", ['c' || CAST(s_suppkey AS VARCHAR), 'n' || CAST(s_nationkey AS VARCHAR)] AS groups
  FROM supplier
)"""

VISIBLE_DATASETS = f"""
WITH {ORDER_DATASETS_CTE}
SELECT u."user", d.pid, true AS can_read, list_contains(u.groups, d.owner) AS can_write
FROM us u, ds d
WHERE list_contains(u.groups, d.owner) OR list_has_any(u.groups, d.access)
"""

SHARE_ROUTING = f"""
WITH {ORDER_DATASETS_CTE}, sh AS (
  SELECT n.n_nationkey AS proposal,
         '/shares/' || lower(r.r_name) || '/' || lower(n.n_name) AS share_folder
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_name <> 'MIDDLE EAST'
)
SELECT d.pid, d.proposal, sh.share_folder, sh.share_folder IS NOT NULL AS routed,
  CASE WHEN sh.share_folder IS NULL THEN 'no share for proposal ' || coalesce(CAST(d.proposal AS VARCHAR), 'None') END
    AS error_msg
FROM ds d LEFT JOIN sh ON d.proposal = sh.proposal
"""

ORACLE.update({
    "job_transitions": JOB_TRANSITIONS,
    "job_lookup": JOB_LOOKUP,
    "unstarted_jobs": UNSTARTED_JOBS,
    "next_job": NEXT_JOB,
    "pending_terminal": PENDING_TERMINAL,
    "status_timeline": STATUS_TIMELINE,
    "admitted_requests": ADMITTED_REQUESTS,
    "rejected_requests": REJECTED_REQUESTS,
    "job_submissions": JOB_SUBMISSIONS,
    "duplicate_ids": DUPLICATE_IDS,
    "registry_first_wins": REGISTRY_FIRST_WINS,
    "orphan_events": ORPHAN_EVENTS,
    "orphan_children": ORPHAN_CHILDREN,
    "visible_datasets": VISIBLE_DATASETS,
    "share_routing": SHARE_ROUTING,
})

FRAME_INTENSITY = """
WITH f AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS px FROM embeddings
), s AS (SELECT vec_id, px, list_min(px) AS mn, list_max(px) AS mx FROM f)
SELECT vec_id, CAST(generate_subscripts(px, 1) - 1 AS BIGINT) AS pos,
       round(205.0 * ln((unnest(px) - mn) + 1.001) / ln((mx - mn) + 1.001), 6) AS intensity
FROM s
"""

FRAME_STATS = """
SELECT vec_id, list_min(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS frame_min,
       list_max(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS frame_max
FROM embeddings
"""

CONTRAST_STRETCH = """
WITH px AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, CAST(l_quantity AS INTEGER) AS v FROM lineitem
), h AS (
  SELECT l_returnflag, l_linestatus, v, count(*) AS c FROM px GROUP BY ALL
), w AS (
  SELECT *, sum(c) OVER (PARTITION BY l_returnflag, l_linestatus) AS n,
         sum(c) OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY v
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
         sum(c) OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY v DESC
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rcum
  FROM h
), b AS (
  SELECT l_returnflag, l_linestatus,
         min(v) FILTER (WHERE cum > floor(CAST(n AS DOUBLE) * 0.1 / 100.0)) AS lo,
         max(v) FILTER (WHERE rcum > floor(CAST(n AS DOUBLE) * 0.1 / 100.0)) AS hi
  FROM w GROUP BY ALL
)
SELECT p.l_orderkey, p.l_linenumber, p.l_returnflag, p.l_linestatus, p.v, b.lo, b.hi,
  CASE WHEN b.hi <= b.lo THEN p.v ELSE CAST(least(greatest(floor(
    CAST(p.v AS DOUBLE) * (CAST(255.0 AS DOUBLE) / CAST(b.hi - b.lo AS DOUBLE))
    + (-CAST(b.lo AS DOUBLE)) * (CAST(255.0 AS DOUBLE) / CAST(b.hi - b.lo AS DOUBLE))), 0), 255) AS INTEGER) END
    AS stretched
FROM px p JOIN b ON p.l_returnflag = b.l_returnflag AND p.l_linestatus = b.l_linestatus
"""

FIRST_FRAMES = """
SELECT conv_id, turn AS frame_idx, role, text FROM conversations WHERE turn < 1
"""


def _norm_all(keys):
    return f"""
{FIELDS_CTE.replace("keys(key, key_seq)", "unused_keys(key, key_seq)")}, u AS (
  SELECT *, CASE WHEN kind = 'S' THEN (len(shape) = 0 OR (len(shape) = 1 AND shape[1] = 1))
                 ELSE ((len(maxshape) = 1 AND coalesce(maxshape[1] = 1, false)) OR len(shape) = 0) END AS unbox
  FROM fields WHERE key IN ({_in_list(keys)})
), norm AS (
  SELECT file_path, key,
    CASE WHEN kind = 'S' AND unbox THEN str_values[1]
         WHEN kind = 'i' AND unbox THEN CAST(int_values[1] AS VARCHAR)
         WHEN kind = 'S' THEN array_to_string(str_values, ',')
         WHEN kind = 'i' THEN array_to_string(list_transform(int_values, lambda x: CAST(x AS VARCHAR)), ',')
    END AS value_text
  FROM u
)"""


MAPPING_START = f"""
WITH {_norm_all(['/doc/lang', '/doc/source', '/doc/n_chars', '/doc/title'])}
SELECT file_path, key AS field, value_text FROM norm
"""

MAPPING_CONFIG = f"""
WITH {_norm_all(['/labels/quality', '/labels/toxic', '/doc/n_chars'])}
SELECT file_path, 'primary' AS stream,
       CASE WHEN key = '/doc/n_chars' THEN 'doc' ELSE 'labels' END AS device, key AS field, value_text
FROM norm
"""

VEC_CTE = """
v AS (
  SELECT '/data/vectors/vec_' || CAST(vec_id AS VARCHAR) || '.h5' AS file_path,
         list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS emb,
         list_transform(list_filter(embedding, lambda x: x > 0), lambda x: CAST(x AS DOUBLE)) AS pos
  FROM embeddings
)"""

MAPPING_EVENTS = f"""
WITH {VEC_CTE}, e AS (SELECT file_path, emb, pos, unnest(generate_series(1, len(emb))) AS i FROM v)
SELECT file_path, CAST(i - 1 AS BIGINT) AS seq, CAST(i - 1 AS DOUBLE) AS time_stamp,
       emb[i] AS vec_embedding, pos[i] AS vec_positive
FROM e
"""

MAPPING_EVENT_ISSUES = f"""
WITH {VEC_CTE}
SELECT file_path, '/vec/positive' AS field, 'warning' AS severity,
       'length of /vec/positive (' || CAST(len(pos) AS VARCHAR) || ') differs from time stamps ('
       || CAST(len(emb) AS VARCHAR) || ')' AS msg
FROM v WHERE len(pos) <> len(emb)
"""

MAPPING_PROJECTION = f"""
WITH {_norm_all(['/doc/lang', '/doc/source', '/doc/n_chars', '/doc/title', '/doc/author'])}, p(out_name, key) AS (
  VALUES ('language', '/doc/lang'), ('collection', '/doc/source'), ('length', '/doc/n_chars'),
         ('title', '/doc/title'), ('author', '/doc/author')
)
SELECT n.file_path, 'doc_app' AS projection, p.out_name, n.key AS field, n.value_text
FROM norm n JOIN p ON n.key = p.key
"""

MAPPING_EXTERNAL = """
SELECT '/data/vectors/vec_' || CAST(vec_id AS VARCHAR) || '.h5' AS file_path, '/vec/frame' AS key,
       0 AS frame_idx
FROM embeddings
"""

FILE_INVENTORY = """
SELECT filename AS file_path, regexp_extract(filename, '([^/]+)$', 1) AS file_name,
       regexp_replace(filename, '/+[^/]*$', '') AS folder, size,
       CAST(epoch(last_modified) AS BIGINT) AS mod_epoch
FROM read_blob('/root/testdata/sf0.01/*.parquet')
"""

DATABLOCKS = """
SELECT sha256(filename) AS datasetId, size, CAST(1 AS BIGINT) AS n_files,
       regexp_extract(filename, '([^/]+)$', 1) AS df_path, size AS df_size, 'RawDatasets' AS df_type
FROM read_blob('/root/testdata/sf0.01/*.parquet')
"""

ATTACHMENTS = """
SELECT page_id, sha256(url) AS datasetId, 'data:image/jpg;base64,' || to_base64(encode(html)) AS thumbnail,
       'raw image' AS caption
FROM pages
"""

ORACLE.update({
    "frame_intensity": FRAME_INTENSITY,
    "frame_stats": FRAME_STATS,
    "contrast_stretch": CONTRAST_STRETCH,
    "first_frames": FIRST_FRAMES,
    "mapping_start": MAPPING_START,
    "mapping_config": MAPPING_CONFIG,
    "mapping_events": MAPPING_EVENTS,
    "mapping_event_issues": MAPPING_EVENT_ISSUES,
    "mapping_projection": MAPPING_PROJECTION,
    "mapping_external": MAPPING_EXTERNAL,
    "file_inventory": FILE_INVENTORY,
    "datablocks": DATABLOCKS,
    "attachments": ATTACHMENTS,
})

STREAM_DEDUP = "SELECT event_id, ts, user_id, event_type FROM events"

STREAM_FAILURE_ISOLATION = """
SELECT 'turn-' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS job_id,
       CASE WHEN role = 'user' THEN 'successful' ELSE 'error' END AS status,
       CAST(CASE WHEN role = 'user' THEN 0 ELSE 1 END AS BIGINT) AS n_errors
FROM conversations
"""

ORACLE.update({
    "stream_job_state": JOB_CURRENT,
    "stream_job_transitions": JOB_TRANSITIONS,
    "stream_dedup": STREAM_DEDUP,
    "stream_failure_isolation": STREAM_FAILURE_ISOLATION,
    "stream_upsert": DATASET_CATALOG,
    "stream_ingest": JOB_FINAL_STATUS,
    "stream_ingest_log": JOB_LOG,
})

STREAM_INGEST_STATE = f"""
WITH f AS ({JOB_FINAL_STATUS})
SELECT job_id AS id, status, 'user' AS submitter, 'ingestor' AS last_actor, CAST(3 AS BIGINT) AS n_events,
  true AS started, true AS ended
FROM f
"""

STREAM_INGEST_HISTORY = f"""
WITH f AS ({JOB_FINAL_STATUS})
SELECT job_id AS id, CAST(1 AS BIGINT) AS pos, CAST(3 AS BIGINT) AS history_len, 'submitted' AS status, 'user' AS submitter,
  CAST(0 AS BIGINT) AS n_issues FROM f
UNION ALL SELECT job_id, 2, 3, 'running', 'ingestor', 0 FROM f
UNION ALL SELECT job_id, 3, 3, status, 'ingestor', n_issues FROM f
"""

_ING = f"""
{META_CTE}, f AS (
  SELECT *, CAST(regexp_extract(file_path, 'doc_([0-9]+)', 1) AS BIGINT) AS id, sha256(file_path) AS pid,
    strftime(TIMESTAMP '2020-01-01 00:00:00' + to_hours(CAST(doc_id AS INTEGER)), '%Y-%m-%d %H:%M:%S')
      || CASE WHEN doc_id % 2 = 0 THEN '.250000' ELSE '' END AS t
  FROM acl
)"""

INGEST_DATASETS = f"""
WITH {_ING}, k AS (SELECT *, {_kw('file_name')} AS kw FROM f)
SELECT 'job-' || CAST(doc_id AS VARCHAR) AS job_id, pid, coalesce(nullif(pi, ''), 'Unknown') AS owner,
  coalesce(nullif(email, ''), 'Unknown') AS contactEmail,
  coalesce(nullif(instrument_name, ''), 'Unknown') AS creationLocation, proposal AS proposalId,
  coalesce(nullif(pi, ''), 'Unknown') AS principalInvestigator,
  regexp_replace(file_path, '/+[^/]*$', '') AS sourceFolder, CAST(size AS BIGINT) AS size,
  '{{"/measurement/instrument/detector/binning_x":' || CAST(size AS VARCHAR)
    || ',"/measurement/instrument/detector/dark_field_value":' || CASE WHEN size > 5000 THEN 'null' ELSE '0.5' END || '}}'
    AS scientificMetadata,
  CAST(len(kw) AS BIGINT) AS n_keywords, t AS creationTime, owner_group AS ownerGroup,
  array_to_string(access_groups, ',') AS accessGroups
FROM k WHERE file_name IS NOT NULL
"""

INGEST_DATABLOCKS = f"""
WITH {_ING}
SELECT pid AS datasetId, CAST(size AS BIGINT) AS size, regexp_extract(file_path, '([^/]+)$', 1) AS df_path, t AS df_time,
  'RawDatasets' AS df_type, owner_group AS ownerGroup, array_to_string(access_groups, ',') AS accessGroups
FROM f WHERE file_name IS NOT NULL
"""

INGEST_ATTACHMENTS = f"""
WITH {_ING}
SELECT pid AS datasetId, 'data:image/jpg;base64,' || base64(encode(username || ':' || instrument_name)) AS thumbnail,
  'raw image' AS caption, owner_group AS ownerGroup, array_to_string(access_groups, ',') AS accessGroups
FROM f WHERE file_name IS NOT NULL
"""

INGEST_ISSUES = f"""
WITH {_ING}, w(key, seq) AS (VALUES ('/measurement/instrument/instrument_name', 0),
  ('/measurement/sample/experiment/beamline', 1), ('/measurement/sample/experiment/experiment_lead', 2),
  ('/measurement/sample/experiment/pi', 3), ('/measurement/sample/experiment/proposal', 4),
  ('/measurement/sample/experimenter/email', 5), ('/measurement/sample/experimenter/name', 6),
  ('/measurement/sample/file_name', 7))
SELECT 'job-' || CAST(doc_id AS VARCHAR) AS job_id, seq, 'warning' AS severity, 'dataset not found ' || key AS msg
FROM f, w WHERE seq = 2 OR (seq = 3 AND pi IS NULL) OR (seq = 4 AND proposal IS NULL) OR (seq = 7 AND file_name IS NULL)
UNION ALL SELECT 'job-' || CAST(doc_id AS VARCHAR), -1, 'error', 'file has no name' FROM f WHERE file_name IS NULL
"""

ACCESS_GRANTS = f"""
WITH {ORDER_DATASETS_CTE}, g AS (
  SELECT pid, owner, unnest(list_distinct(list_concat([owner], access))) AS "group" FROM ds)
SELECT pid, "group", true AS can_read, "group" = owner AS can_write FROM g
"""

GROUP_REACH = f"""
WITH a AS ({ACCESS_GRANTS})
SELECT "group", count(*) AS n_read, CAST(sum(CASE WHEN can_write THEN 1 ELSE 0 END) AS BIGINT) AS n_write
FROM a GROUP BY "group"
"""

JOB_RECORD = f"""
WITH {JOBS_CTE}, h AS (
  SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY time, rnk, event_id) AS BIGINT) AS pos,
         time AS item_time, status AS item_status, submitter AS item_actor FROM r),
q AS (SELECT 'job-' || CAST(c_custkey AS VARCHAR) AS id, c_name AS submitter, c_mktsegment AS mapping_id FROM customer)
SELECT q.id, q.submitter, q.mapping_id, j.status, j.status_time, j.start_time, j.end_time, coalesce(j.n_events, 0) AS n_events,
       coalesce(h.pos, 0) AS pos, h.item_time, h.item_status, h.item_actor
FROM q LEFT JOIN jobs j ON q.id = j.id LEFT JOIN h ON q.id = h.id
"""

ORACLE.update({
    "stream_ingest_state": STREAM_INGEST_STATE,
    "stream_ingest_history": STREAM_INGEST_HISTORY,
    "ingest_datasets": INGEST_DATASETS,
    "ingest_datablocks": INGEST_DATABLOCKS,
    "ingest_attachments": INGEST_ATTACHMENTS,
    "ingest_issues": INGEST_ISSUES,
    "access_grants": ACCESS_GRANTS,
    "group_reach": GROUP_REACH,
    "job_record": JOB_RECORD,
})

_STEPS = "list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1000) AS BIGINT))"
_MOTORS = "/measurement/instrument/sample_motor_stack/setup/"

SAMPLES_CTE = f"""
v AS (SELECT vec_id, '/data/vectors/vec_' || CAST(vec_id AS VARCHAR) || '.h5' AS file_path, label, {_STEPS} AS st FROM embeddings),
a AS (
  SELECT file_path, 0 AS seq, '{_MOTORS}axis1pos' AS key, list_transform(st, lambda x: CAST(x AS DOUBLE)) AS s FROM v WHERE vec_id % 5 <> 0
  UNION ALL SELECT file_path, 1, '{_MOTORS}axis2pos', list_transform(list_filter(st, lambda x: x > 0), lambda x: CAST(x AS DOUBLE)) FROM v
  UNION ALL SELECT file_path, 2, '{_MOTORS}sample_x', list_transform(flatten(list_transform(range(32), lambda i: st)), lambda x: CAST(x AS DOUBLE)) FROM v
  UNION ALL SELECT file_path, 9, '/measurement/instrument/detector/exposure_time', [CAST(label AS DOUBLE)] FROM v
  UNION ALL SELECT file_path, 10, '/measurement/instrument/time_stamp', list_transform(range(len(st)), lambda x: CAST(x AS DOUBLE)) FROM v
  UNION ALL SELECT file_path, 12, '/measurement/instrument/monochromator/setup/turret1', []::DOUBLE[] FROM v),
m AS (SELECT *, len(s) AS n, greatest(len(s) // 10, 1) AS step FROM a),
k AS (SELECT *, list_transform(range(0, n, step), lambda i: s[i + 1]) AS kept,
        CASE WHEN n > 64 THEN (n + 63) // 64 ELSE 1 END AS chunks,
        CASE WHEN n > 64 THEN len(list_distinct(list_transform(range(0, n, step), lambda i: i // 64))) ELSE 1 END AS chunks_read FROM m)"""

SAMPLED_FIELDS = f"""
WITH {SAMPLES_CTE},
x AS (SELECT *, unnest(CASE WHEN n = 0 THEN [-1] ELSE range(0, len(kept)) END) AS pos FROM k)
SELECT file_path, key, CAST(n AS BIGINT) AS n_values, CAST(step AS BIGINT) AS step, CAST(chunks AS BIGINT) AS chunks,
  CAST(chunks_read AS BIGINT) AS chunks_read, CAST(pos AS BIGINT) AS pos, CASE WHEN pos >= 0 THEN kept[pos + 1] END AS value, CAST(NULL AS VARCHAR) AS msg FROM x
UNION ALL SELECT file_path, '/measurement/instrument/monochromator/energy', -1, -1, -1, -1, -1, NULL,
  'data sample of a scalar /measurement/instrument/monochromator/energy' FROM v
"""

INGEST_VECTOR_DATASETS = f"""
WITH {SAMPLES_CTE},
j AS (SELECT file_path, string_agg('"' || key || '":[' || array_to_string(list_transform(kept, lambda x:
        CASE WHEN seq = 10 THEN CAST(x AS VARCHAR) ELSE CAST(CAST(x AS BIGINT) AS VARCHAR) END), ',') || ']', ',' ORDER BY seq) AS js FROM k GROUP BY file_path)
SELECT 'job-' || CAST(vec_id AS VARCHAR) AS job_id, sha256(file_path) AS pid, 'Unknown' AS owner, 'vectors' AS creationLocation,
  'vec ' || CAST(vec_id AS VARCHAR) AS datasetName, '/data/vectors' AS sourceFolder,
  '{{"/measurement/instrument/detector/binning_x":' || CAST(label AS VARCHAR) || ',"data_sample":{{' || js || '}}}}' AS scientificMetadata,
  CAST(2 AS BIGINT) AS n_keywords, 'user' || CAST(label AS VARCHAR) AS ownerGroup, '' AS accessGroups
FROM v JOIN j USING (file_path)
"""

INGEST_VECTOR_ATTACHMENTS = """
WITH f AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS px FROM embeddings),
s AS (SELECT *, list_min(px) AS mn, list_max(px) AS mx FROM f),
b AS (SELECT vec_id, label, array_to_string(list_transform(px, lambda p:
        lpad(hex(CAST(floor(round(205.0::DOUBLE * ln((p - mn) + 1.001::DOUBLE) / ln((mx - mn) + 1.001::DOUBLE), 9)) AS INTEGER)), 2, '0')), '') AS h FROM s)
SELECT sha256('/data/vectors/vec_' || CAST(vec_id AS VARCHAR) || '.h5') AS datasetId,
  'data:image/jpg;base64,' || base64(from_hex(hex(encode('P5' || chr(10) || '8 8' || chr(10) || '255' || chr(10))) || h)) AS thumbnail,
  'raw image' AS caption, 'user' || CAST(label AS VARCHAR) AS ownerGroup, '' AS accessGroups
FROM b
"""

INGEST_VECTOR_ISSUES = """
WITH w(key, seq) AS (VALUES ('/measurement/sample/experiment/beamline', 1), ('/measurement/sample/experiment/experiment_lead', 2),
  ('/measurement/sample/experiment/pi', 3), ('/measurement/sample/experiment/proposal', 4), ('/measurement/sample/experimenter/email', 5))
SELECT 'job-' || CAST(vec_id AS VARCHAR) AS job_id, CAST(seq AS INTEGER) AS seq, 'warning' AS severity, 'dataset not found ' || key AS msg FROM embeddings, w
UNION ALL SELECT 'job-' || CAST(vec_id AS VARCHAR), 16, 'error', 'data sample of a scalar /measurement/instrument/monochromator/energy' FROM embeddings
"""

ORACLE.update({
    "container_fields": FIELD_EXTRACT,
    "stream_container_fields": FIELD_EXTRACT,
    "sampled_fields": SAMPLED_FIELDS,
    "ingest_vector_datasets": INGEST_VECTOR_DATASETS,
    "ingest_vector_attachments": INGEST_VECTOR_ATTACHMENTS,
    "ingest_vector_issues": INGEST_VECTOR_ISSUES,
})

STREAM_CATALOG = f"""
SELECT * FROM ({DATASET_CATALOG}) WHERE regexp_matches(instrumentId, '^src([0-9]|1[0-7])$')
"""

ORACLE.update({
    "stream_upsert_buckets": DATASET_CATALOG,
    "stream_catalog": STREAM_CATALOG,
})

CLAIMED_JOBS = """
WITH RECURSIVE e AS (
  SELECT 'job-' || CAST(user_id AS VARCHAR) AS id, event_id, ts, epoch_us(ts) AS t, 'runner' || CAST(event_id % 3 AS VARCHAR) AS runner,
    CASE event_type WHEN 'signup' THEN 'submit' WHEN 'view' THEN 'claim' WHEN 'click' THEN 'renew' ELSE 'finish' END AS action,
    CASE event_type WHEN 'signup' THEN 0 WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS rnk FROM events),
o AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY t, rnk, event_id) AS pos FROM e),
s AS (
  SELECT DISTINCT id, CAST(0 AS BIGINT) AS pos, 'none' AS status, CAST(NULL AS VARCHAR) AS holder, CAST(0 AS BIGINT) AS fence, CAST(0 AS BIGINT) AS until,
    CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS TIMESTAMP) AS time, CAST(NULL AS VARCHAR) AS action, CAST(NULL AS VARCHAR) AS runner, CAST(NULL AS VARCHAR) AS reason FROM o
  UNION ALL
  SELECT id, pos,
    CASE WHEN action = 'submit' THEN CASE WHEN status IN ('none', 'ended') THEN 'submitted' ELSE status END
         WHEN reason IS NOT NULL THEN status WHEN action = 'claim' THEN 'running' WHEN action = 'finish' THEN 'ended' ELSE status END,
    CASE WHEN action = 'submit' AND status IN ('none', 'ended') THEN NULL WHEN action = 'claim' AND reason IS NULL THEN runner ELSE holder END,
    CASE WHEN action = 'claim' AND reason IS NULL THEN fence + 1 ELSE fence END,
    CASE WHEN action IN ('claim', 'renew') AND reason IS NULL THEN t + 21600000000 ELSE until END,
    event_id, ts, action, runner, reason
  FROM (SELECT o.id, o.pos, s.status, s.holder, s.fence, s.until, o.event_id, o.ts, o.t, o.action, o.runner,
          CASE WHEN o.action = 'submit' THEN NULL
               WHEN o.action = 'claim' THEN CASE WHEN s.status = 'none' THEN 'not submitted' WHEN s.status = 'ended' THEN 'already ended'
                 WHEN s.status = 'running' AND o.t < s.until THEN 'held' END
               WHEN s.status <> 'running' THEN 'not running' WHEN o.runner <> s.holder THEN 'not the holder' END AS reason
        FROM s JOIN o ON o.id = s.id AND o.pos = s.pos + 1) x)
SELECT id, event_id, time, action, runner, reason IS NULL AS granted, fence, holder, reason FROM s WHERE pos > 0 AND action <> 'submit'
"""

ORACLE["claimed_jobs"] = CLAIMED_JOBS

STREAM_TASK_ISOLATION = """
WITH t AS (SELECT CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) AS n, turn, turn % 5 = 3 AS bad FROM conversations),
p AS (SELECT *, '/data/conversations/turn_' || n || '.txt' AS path FROM t)
SELECT 'turn-' || n AS job_id, CASE WHEN bad THEN 'error' ELSE 'successful' END AS status, CAST(CASE WHEN bad THEN 1 ELSE 0 END AS BIGINT) AS n_errors,
  'ingested dataset: ' || path || ' as ' || CASE WHEN bad THEN 'None' ELSE sha256(path) END || CASE WHEN bad THEN
    chr(10) || ' :  ingestor failed' || chr(10) || '    Exception: ValueError: cannot read turn ' || CAST(turn AS VARCHAR) ELSE '' END AS log,
  CASE WHEN bad THEN 'ingestor failed' END AS msg, CASE WHEN bad THEN 'ValueError: cannot read turn ' || CAST(turn AS VARCHAR) END AS exception
FROM p
"""

ORACLE.update({
    "jobs_incremental": JOB_CURRENT,
    "stream_task_isolation": STREAM_TASK_ISOLATION,
})

USER_REACH = f"""
WITH v AS ({VISIBLE_DATASETS})
SELECT s.s_name AS "user", count(v.pid) AS n_read, CAST(coalesce(sum(CASE WHEN can_write THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_write
FROM supplier s LEFT JOIN v ON v."user" = s.s_name GROUP BY s.s_name
"""

CLUSTERED_EVENTS = """
SELECT 'time' AS "by", event_type, count(*) AS n, min(event_id) AS first_event, max(event_id) AS last_event
FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-10' GROUP BY event_type
UNION ALL SELECT 'user', event_type, count(*), min(event_id), max(event_id) FROM events WHERE user_id BETWEEN 40 AND 60 GROUP BY event_type
"""

ORACLE.update({
    "user_reach": USER_REACH,
    "job_lookup_indexed": JOB_LOOKUP,
    "clustered_events": CLUSTERED_EVENTS,
})

WIDENED_VALUES = """
SELECT vec_id, CAST(label AS BIGINT) AS label, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS pos, CAST(unnest(embedding) AS DOUBLE) AS value
FROM embeddings
"""

JOB_LOG_LINES = f"""
WITH {EVENTS_CTE}, l AS (
  SELECT id, event_id AS pos, regexp_split_to_array('status ' || status || '\\nby ' || submitter || chr(10) || coalesce(log, ''), '\n|\\\\n') AS ls FROM ev)
SELECT id, pos, CAST(generate_subscripts(ls, 1) - 1 AS BIGINT) AS line_no, unnest(ls) AS line FROM l
"""

MAPPING_LINKED = """
SELECT '/data/vectors/vec_' || CAST(vec_id AS VARCHAR) || '.h5' AS file_path, 'doc_app' AS projection, 'image_data' AS out_name,
  '/vec/frame' AS field, CAST(1 AS BIGINT) AS n_frames
FROM embeddings
"""

OVERDUE_JOBS = f"""
WITH {JOBS_CTE}
SELECT id, status, status_time FROM jobs WHERE status IN ('submitted', 'running')
"""

CONTAINER_INVENTORY = """
SELECT 'doc_' || CAST(doc_id AS VARCHAR) || '.h5.npz' AS file_name, '/data/' || source || '/' || lang AS folder, true AS filled FROM documents
"""

STORED_RECORDS = f"""
WITH b AS ({INGEST_DATABLOCKS}), a AS ({INGEST_ATTACHMENTS})
SELECT b.datasetId, b.size, b.df_path, b.ownerGroup, a.thumbnail, a.caption FROM b JOIN a ON a.datasetId = b.datasetId
"""

ORACLE.update({
    "widened_values": WIDENED_VALUES,
    "job_log_lines": JOB_LOG_LINES,
    "renamed_fields": FIELD_EXTRACT,
    "mapping_linked": MAPPING_LINKED,
    "overdue_jobs": OVERDUE_JOBS,
    "container_inventory": CONTAINER_INVENTORY,
    "stored_records": STORED_RECORDS,
})
