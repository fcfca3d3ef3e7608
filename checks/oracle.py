"""The registered queries in SQL, over the same tables."""

# --- common table expressions, by name -------------------------------------

_VIEWS = {
    "doc_files": """
SELECT doc_id, '/corpus/' || lang || '/' || source || '/'
    || CAST(CAST(floor(doc_id / 40) AS BIGINT) AS VARCHAR)
    || '/contract_' || CAST(doc_id % 40 AS VARCHAR)
    || CASE doc_id % 6 WHEN 0 THEN '.pdf' WHEN 1 THEN '.docx' WHEN 2 THEN '.pdf'
         WHEN 3 THEN '.docx' WHEN 4 THEN '.PDF' ELSE '.txt' END AS file_path,
    text, lang, n_chars
FROM documents""",
    "supported": """
SELECT * FROM doc_files WHERE file_path LIKE '%.pdf' OR file_path LIKE '%.docx'""",
    "replies": """
SELECT doc_id, file_path, CASE doc_id % 11 WHEN 0 THEN '{}'
    WHEN 1 THEN '{"type": null, "jurisdiction": "XX"}' WHEN 2 THEN NULL WHEN 3 THEN 'null'
    WHEN 4 THEN '[1]'
    ELSE '{"type":"' || CASE WHEN n_chars < 1000 THEN 'memo' WHEN n_chars < 2500 THEN 'letter'
      ELSE 'contract' END || '","jurisdiction":"' || upper(lang) || '"}' END AS body
FROM doc_files""",
    "answered": """
SELECT file_path, body, CASE
    WHEN NOT (file_path LIKE '%.pdf' OR file_path LIKE '%.docx') THEN 'extraction_failure'
    WHEN body IS NULL OR body = 'null' THEN 'api_failure'
    WHEN json_type(body) = 'OBJECT' THEN 'success' ELSE 'error' END AS outcome
FROM replies""",
    "run_1": """
SELECT CASE WHEN file_path NOT LIKE '%.txt' THEN file_path END AS filepath,
    CASE WHEN toxic = 1 AND quality = 1 THEN 'api_failure' WHEN toxic = 1 THEN 'error'
      ELSE 'success' END AS status,
    CAST(1 AS BIGINT) AS run_seq
FROM doc_files JOIN labels USING (doc_id)""",
    "run_2": """
SELECT file_path AS filepath, CASE WHEN toxic = 1 THEN 'success' ELSE 'error' END AS status,
    CAST(2 AS BIGINT) AS run_seq
FROM doc_files JOIN labels USING (doc_id) WHERE quality <> 1""",
    "ledger": "SELECT * FROM run_1 UNION ALL SELECT * FROM run_2",
    "latest": """
SELECT filepath, status, run_seq FROM (
  SELECT *, row_number() OVER (PARTITION BY filepath ORDER BY run_seq DESC, status DESC) AS rn
  FROM ledger) WHERE rn = 1""",
    "left_over": """
SELECT * FROM supported s WHERE NOT EXISTS (
  SELECT 1 FROM latest l WHERE l.status = 'success' AND l.filepath = s.file_path)""",
    "attempts": """
SELECT user_id AS call_key, CAST(ts AS DATE) AS call_day, ts, event_id, CASE event_type
    WHEN 'click' THEN 429 WHEN 'view' THEN 429 WHEN 'error' THEN NULL
    WHEN 'purchase' THEN 200 ELSE 500 END AS http_status
FROM events""",
    "numbered": """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY call_key, call_day ORDER BY ts, event_id)
    AS attempt_no FROM attempts) WHERE attempt_no <= 5""",
    "lines": """
SELECT doc_id, file_path, CAST(g AS INTEGER) AS page_no, p[g] AS text FROM (
  SELECT doc_id, file_path, string_split(text, chr(10)) AS p,
    unnest(generate_series(1, len(string_split(text, chr(10))))) AS g
  FROM doc_files)""",
    "doc_pages": """
SELECT file_path, page_no, CASE WHEN (doc_id + page_no - 1) % 9 = 0 THEN ''
    WHEN (doc_id + page_no - 1) % 13 = 0 THEN NULL ELSE text END AS text
FROM lines""",
    "line_texts": """
SELECT file_path, coalesce(string_agg(CASE WHEN length(text) > 0 THEN 'Page ' || page_no
    || ' - Text Section:' || chr(10) || chr(10) || text || chr(10) || chr(10) END,
    chr(10) ORDER BY page_no), '') AS text
FROM lines GROUP BY file_path""",
    "texts": """
SELECT file_path, CASE WHEN file_path LIKE '%.pdf' THEN l.text
    WHEN file_path LIKE '%.docx' THEN d.text || chr(10) END AS text
FROM doc_files d JOIN line_texts l USING (file_path)""",
    "guarded": """
SELECT file_path,
  CASE WHEN file_path LIKE '%.pdf' OR file_path LIKE '%.docx' THEN text END AS text
FROM doc_files""",
}


def _model(source: str) -> str:
    """What the stand-in model answers to the texts of a view."""
    return f"""
SELECT file_path,
  CASE WHEN text IS NULL OR r = 9 THEN NULL WHEN r = 0 THEN 500 WHEN r = 2 THEN 429 ELSE 200 END
    AS http_status,
  CASE WHEN text IS NULL OR r IN (0, 2, 4, 9) THEN NULL WHEN r = 5 THEN 'null'
    WHEN r = 6 THEN '[1]' WHEN r = 7 THEN '{{}}'
    WHEN r = 8 THEN '{{"type": null, "jurisdiction": "XX"}}' ELSE answer END AS body,
  CASE WHEN text IS NULL THEN 0 WHEN r IN (2, 4) THEN 5 WHEN r = 1 THEN 3 WHEN r = 3 THEN 2
    ELSE 1 END AS attempts,
  CASE WHEN text IS NULL THEN 0.0 WHEN r IN (2, 4) THEN 12.1875 WHEN r = 1 THEN 3.75
    WHEN r = 3 THEN 1.5 ELSE 0.0 END::DOUBLE AS waited_s,
  CASE WHEN text IS NULL THEN 'extraction_failure' WHEN r IN (0, 2, 4, 5) THEN 'api_failure'
    WHEN r IN (6, 9) THEN 'error' ELSE 'success' END AS outcome
FROM (
  SELECT file_path, text, length(text) % 16 AS r, '{{"type":"' ||
    CASE WHEN length(text) < 1000 THEN 'memo' WHEN length(text) < 2500 THEN 'letter'
      ELSE 'contract' END || '","jurisdiction":"' ||
    CASE WHEN contains(text, ' the ') THEN 'EN' WHEN contains(text, ' der ') THEN 'DE'
      WHEN contains(text, ' les ') THEN 'FR' ELSE 'ES' END || '"}}' AS answer
  FROM {source})"""


_VIEWS["asked_texts"] = "SELECT * FROM texts SEMI JOIN supported USING (file_path)"
_VIEWS["asked_left"] = "SELECT * FROM texts SEMI JOIN left_over USING (file_path)"
_VIEWS["asked_lines"] = "SELECT * FROM line_texts SEMI JOIN supported USING (file_path)"
_VIEWS["model_guarded"] = _model("guarded")
_VIEWS["model_texts"] = _model("asked_texts")
_VIEWS["model_left"] = _model("asked_left")
_VIEWS["model_lines"] = _model("asked_lines")

_NEEDS = {
    "supported": ["doc_files"],
    "replies": ["doc_files"],
    "answered": ["replies"],
    "run_1": ["doc_files"],
    "run_2": ["doc_files"],
    "ledger": ["run_1", "run_2"],
    "latest": ["ledger"],
    "left_over": ["supported", "latest"],
    "numbered": ["attempts"],
    "lines": ["doc_files"],
    "doc_pages": ["lines"],
    "line_texts": ["lines"],
    "texts": ["line_texts"],
    "guarded": ["doc_files"],
    "asked_texts": ["texts", "supported"],
    "asked_left": ["texts", "left_over"],
    "asked_lines": ["line_texts", "supported"],
    "model_guarded": ["guarded"],
    "model_texts": ["asked_texts"],
    "model_left": ["asked_left"],
    "model_lines": ["asked_lines"],
}


def _with(select: str, *views: str) -> str:
    """The query behind the views it needs, each stated once."""
    ordered: list[str] = []

    def add(view: str) -> None:
        for needed in _NEEDS.get(view, []):
            add(needed)
        if view not in ordered:
            ordered.append(view)

    for view in views:
        add(view)
    return "WITH " + ",\n".join(f"{v} AS ({_VIEWS[v]})" for v in ordered) + "\n" + select


def _field(key: str, default: str) -> str:
    """A value of a reply object; the default only where the key is absent."""
    return (
        f"CASE WHEN json_type(body) = 'OBJECT' AND list_contains(json_keys(body), '{key}') "
        f"THEN json_extract_string(body, '$.{key}') ELSE '{default}' END"
    )


def _answer(key: str, default: str) -> str:
    return f"CASE WHEN outcome = 'success' THEN {_field(key, default)} ELSE '{default}' END"


_TYPE = ("type", "Unknown Type")
_PLACE = ("jurisdiction", "Unknown Jurisdiction")


def _raw(source: str) -> str:
    return (
        f"SELECT file_path, body FROM {source} "
        "WHERE outcome = 'success' AND body NOT IN ('{}', '[]', 'null')"
    )


def _minimal(source: str) -> str:
    return (
        f"SELECT file_path AS filepath, {_field(*_TYPE)} AS type, "
        f'{_field(*_PLACE)} AS "Jurisdiction" FROM {source} WHERE outcome = \'success\''
    )


def _flags(source: str) -> str:
    return (
        f"SELECT file_path AS filepath, {_answer(*_TYPE)} AS type, "
        f'{_answer(*_PLACE)} AS "Jurisdiction", '
        "CASE WHEN outcome IN ('extraction_failure', 'error') THEN 'yes' ELSE 'no' END "
        "AS extraction_failure, "
        "CASE WHEN outcome IN ('api_failure', 'error') THEN 'yes' ELSE 'no' END AS api_failure "
        f"FROM {source}"
    )


def _persisted(source: str, renamed: str, more: str = "") -> str:
    return (
        f"SELECT file_path AS filepath, {_answer(*_TYPE)} AS type, "
        f"{_answer(*_PLACE)} AS jurisdiction, "
        f"CASE WHEN outcome = '{renamed}' THEN 'error' ELSE outcome END AS status{more} "
        f"FROM {source}"
    )


def _status(source: str) -> str:
    return _persisted(source, "api_failure")


def _ledger(source: str, more: str = "") -> str:
    return _persisted(source, "extraction_failure", more)


_LISTED = _with("SELECT file_path FROM supported", "supported")
_BYTES = _with(
    "SELECT file_path, CAST(strlen(text) AS INTEGER) AS n_bytes, md5(text) AS digest "
    "FROM supported",
    "supported",
)
_STEM = "regexp_replace(regexp_extract(file_path, '[^/]*$'), '^(.+)\\.[^.]+$', '\\1') || '.json'"

# Raw replies: asked once, any status accepted, so every body that is JSON counts.
_RAW_RUN = """
SELECT file_path, body FROM model_texts
WHERE outcome <> 'extraction_failure' AND body IS NOT NULL AND attempts = 1
  AND body NOT IN ('{}', 'null')"""

_HOT_PATH = "CASE WHEN doc_id % 3 = 0 THEN '/corpus/hot.pdf' ELSE file_path END"

ORACLE: dict[str, str] = {
    "list_files": _LISTED,
    "list_files_index": _LISTED,
    "list_files_flat": _with(
        "SELECT '/' || md5(file_path) || '.' || regexp_extract(file_path, '[^.]*$') AS file_path "
        "FROM supported",
        "supported",
    ),
    "list_files_paged": _with(
        "SELECT '/' || md5(file_path) || '.' || regexp_extract(file_path, '[^.]*$') AS file_path "
        "FROM supported",
        "supported",
    ),
    "paths_df": _with("SELECT file_path FROM doc_files", "doc_files"),
    "read_bytes": _BYTES,
    "read_bytes_index": _BYTES,
    "read_ledger": _with(
        f"SELECT * FROM ({_ledger('answered')}) WHERE status = 'success'", "answered"
    ),
    "read_corrupt": _with(
        "SELECT md5(file_path) || '.json' AS file, "
        "coalesce(body, '{\"filepath\": \"trunc') AS value "
        "FROM answered WHERE outcome <> 'success'",
        "answered",
    ),
    "filter_supported": _LISTED,
    "unsupported_guard": _with(
        "SELECT file_path, text, CASE WHEN text IS NULL THEN 'extraction_failure' END AS outcome "
        "FROM guarded",
        "guarded",
    ),
    "drop_failed": _with(
        "SELECT file_path, body FROM answered WHERE outcome = 'success'", "answered"
    ),
    "drop_empty_reply": _with(
        "SELECT file_path, body FROM replies WHERE body IS NOT NULL "
        "AND body NOT IN ('{}', 'null')",
        "replies",
    ),
    "skip_blank_pages": _with("SELECT * FROM doc_pages WHERE length(text) > 0", "doc_pages"),
    "ledger_success": _with("SELECT * FROM ledger WHERE status = 'success'", "ledger"),
    "extract_text": _with(
        "SELECT file_path, text, "
        "CASE WHEN text IS NULL THEN 'extraction_failure' END AS outcome, "
        "CASE WHEN text IS NULL THEN 'Unsupported file format' END AS error FROM texts",
        "texts",
    ),
    "explode_pages": _with("SELECT file_path, page_no, text FROM lines", "lines"),
    "page_section": _with(
        "SELECT file_path, page_no, 'Page ' || page_no || ' - Text Section:' || chr(10) || chr(10) "
        "|| text || chr(10) || chr(10) AS section FROM doc_pages WHERE length(text) > 0",
        "doc_pages",
    ),
    "join_pages": _with(
        "SELECT file_path, coalesce(string_agg(CASE WHEN length(text) > 0 THEN 'Page ' || page_no "
        "|| ' - Text Section:' || chr(10) || chr(10) || text || chr(10) || chr(10) END, chr(10) "
        "ORDER BY page_no), '') AS text FROM doc_pages GROUP BY file_path",
        "doc_pages",
    ),
    "docx_paragraphs": _with(
        "SELECT file_path, page_no AS para_no, text FROM lines WHERE file_path LIKE '%.docx'",
        "lines",
    ),
    "join_paragraphs": _with(
        "SELECT file_path, string_agg(coalesce(text, '') || chr(10), '' ORDER BY page_no) AS text "
        "FROM doc_pages GROUP BY file_path",
        "doc_pages",
    ),
    "placeholder_text": _with(
        "SELECT file_path, CASE WHEN file_path LIKE '%.pdf' THEN 'Extracted text from PDF' "
        "WHEN file_path LIKE '%.docx' THEN 'Extracted text from DOCX' END AS text FROM doc_files",
        "doc_files",
    ),
    "enrich": _with("SELECT * FROM model_guarded", "model_guarded"),
    "enrich_from_replies": _with(
        "SELECT file_path, body, CASE WHEN body IS NULL OR body = 'null' THEN 'api_failure' "
        "WHEN json_type(body) = 'OBJECT' THEN 'success' ELSE 'error' END AS outcome FROM replies",
        "replies",
    ),
    "enrich_hot_path": _with(
        "SELECT doc_id, file_path, body, CASE WHEN body IS NULL OR body = 'null' THEN 'api_failure' "
        "WHEN json_type(body) = 'OBJECT' THEN 'success' ELSE 'error' END AS outcome "
        f"FROM (SELECT doc_id, {_HOT_PATH} AS file_path FROM doc_files) "
        f"JOIN (SELECT {_HOT_PATH} AS file_path, max(body) AS body FROM replies GROUP BY 1) USING (file_path)",
        "replies",
    ),
    "request_payload": _with(
        "SELECT file_path, CAST(to_json({'text': text}) AS VARCHAR) AS payload, "
        "CAST(to_json({'input': text}) AS VARCHAR) AS raw_payload FROM doc_files",
        "doc_files",
    ),
    "classify_status": _with(
        "SELECT event_id, http_status, CASE WHEN http_status IS NULL OR http_status = 429 "
        "THEN 'retry' WHEN http_status = 200 THEN 'done' ELSE 'fail' END AS action FROM attempts",
        "attempts",
    ),
    "resolve_attempts": _with(
        """SELECT call_key, call_day, CAST(coalesce(decided_at, seen) AS INTEGER) AS attempts,
  decision AS http_status,
  CASE WHEN decided_at IS NULL AND seen < 5 THEN
      list_sum(list_transform(generate_series(1, seen), lambda k: pow(1.5, k)))
    WHEN coalesce(decided_at, seen) = 1 THEN 0.0
    ELSE list_sum(list_transform(generate_series(1, coalesce(decided_at, seen) - 1),
      lambda k: pow(1.5, k))) END AS waited_s,
  CASE WHEN decision = 200 THEN 'success' WHEN decided_at IS NOT NULL OR seen >= 5
    THEN 'api_failure' ELSE 'open' END AS outcome
FROM (SELECT call_key, call_day, max(attempt_no) AS seen,
    min(attempt_no) FILTER (WHERE http_status <> 429) AS decided_at,
    arg_min(http_status, attempt_no) FILTER (WHERE http_status <> 429) AS decision
  FROM numbered GROUP BY call_key, call_day)""",
        "numbered",
    ),
    "backoff_schedule": _with(
        "SELECT event_id, CAST(attempt_no AS INTEGER) AS attempt_no, "
        "pow(1.5, attempt_no) AS wait_s, "
        "CAST(19.78125 AS DOUBLE) AS total_s FROM numbered",
        "numbered",
    ),
    "format_wait": _with(
        "SELECT event_id, CASE attempt_no WHEN 1 THEN '1.5' WHEN 2 THEN '2.2' WHEN 3 THEN '3.4' "
        "WHEN 4 THEN '5.1' ELSE '7.6' END AS wait FROM numbered "
        "WHERE http_status IS NULL OR http_status = 429",
        "numbered",
    ),
    "retry_log": _with(
        "SELECT event_id, CASE WHEN http_status = 429 THEN 'WARNING' ELSE 'ERROR' END AS level, "
        "CASE WHEN http_status = 429 THEN 'Rate limit exceeded. Retrying in ' || CASE attempt_no "
        "WHEN 1 THEN '1.5' WHEN 2 THEN '2.2' WHEN 3 THEN '3.4' WHEN 4 THEN '5.1' ELSE '7.6' END "
        "|| ' seconds...' ELSE 'API request failed. Retrying ' || attempt_no || '/5...' END "
        "AS message FROM numbered WHERE http_status IS NULL OR http_status = 429",
        "numbered",
    ),
    "parse_reply": _with(
        "SELECT file_path, CASE WHEN body IS NULL THEN NULL WHEN json_type(body) = 'OBJECT' "
        "THEN 'object' WHEN json_type(body) = 'NULL' THEN 'null' ELSE 'other' END AS reply_kind, "
        "json_extract_string(body, '$.type') AS type, "
        "json_extract_string(body, '$.jurisdiction') AS jurisdiction FROM replies",
        "replies",
    ),
    "get_or_default": _with(
        f"SELECT file_path, {_field(*_TYPE)} AS type, {_field(*_PLACE)} AS jurisdiction "
        "FROM replies",
        "replies",
    ),
    "shape_raw": _with(_raw("answered"), "answered"),
    "shape_minimal": _with(_minimal("answered"), "answered"),
    "shape_flags": _with(_flags("answered"), "answered"),
    "shape_status": _with(_status("answered"), "answered"),
    "shape_ledger": _with(_ledger("answered"), "answered"),
    "failure_log": _with(
        "SELECT file_path AS filepath, CASE WHEN outcome = 'error' THEN 'ERROR' ELSE 'WARNING' END "
        "AS level, CASE outcome WHEN 'extraction_failure' THEN 'Extraction failed for file: ' "
        "|| file_path WHEN 'api_failure' THEN 'API call failed for file: ' || file_path "
        "ELSE 'Unexpected error processing file ' || file_path "
        "|| ': the reply is not a JSON object' END AS message "
        "FROM answered WHERE outcome <> 'success'",
        "answered",
    ),
    "skip_processed": _with("SELECT file_path FROM left_over", "left_over"),
    "skip_processed_by_key": _with("SELECT file_path FROM left_over", "left_over"),
    "processed_paths": _with(
        "SELECT DISTINCT filepath FROM ledger WHERE status = 'success' AND filepath IS NOT NULL",
        "ledger",
    ),
    "latest_by_key": _with("SELECT filepath, status, run_seq FROM latest", "latest"),
    "union_results": _with(_minimal("answered"), "answered"),
    "preview": _with(
        "SELECT "
        + ", ".join(
            f"CASE WHEN length({c}) > 20 THEN substr({c}, 1, 17) || '...' ELSE {c} END AS {c}"
            for c in ("filepath", "type", "jurisdiction", "status")
        )
        + f" FROM (SELECT * FROM ({_status('answered')}) ORDER BY filepath LIMIT 20)",
        "answered",
    ),
    "key_md5": _with(
        "SELECT file_path, md5(file_path) || '.json' AS key FROM doc_files", "doc_files"
    ),
    "key_stem": _with(f"SELECT file_path, {_STEM} AS key FROM doc_files", "doc_files"),
    "path_join": _with(
        f"SELECT file_path, '/out/' || lang || '/' || {_STEM} AS target FROM doc_files",
        "doc_files",
    ),
    "to_json_row": _with(
        "SELECT filepath, CAST(to_json({'filepath': filepath, 'type': type, "
        "'jurisdiction': jurisdiction, 'status': status}) AS VARCHAR) AS json "
        f"FROM ({_status('answered')})",
        "answered",
    ),
    "csv_round_trip": _with(_flags("answered"), "answered"),
    "keyed_json_round_trip": _with(_ledger("answered"), "answered"),
    "ledger_round_trip": _with(
        f"SELECT * FROM ({_ledger('answered', ', outcome, CAST(1 AS BIGINT) AS run_seq')}) "
        "WHERE outcome = 'success' UNION ALL "
        f"SELECT * FROM ({_ledger('model_guarded', ', outcome, CAST(2 AS BIGINT) AS run_seq')}) "
        "WHERE filepath IN (SELECT file_path FROM answered WHERE outcome <> 'success')",
        "answered",
        "model_guarded",
    ),
    "repartitioned": _with("SELECT file_path FROM doc_files", "doc_files"),
    "map_partitions": _with(
        "SELECT file_path, length(text) AS text_length FROM doc_files", "doc_files"
    ),
    "ingest_new": _with(
        "SELECT file_path, strlen(text) AS length FROM supported", "supported"
    ),
    "raw_run": _with(_RAW_RUN, "model_texts"),
    "minimal_run": _with(_minimal("model_texts"), "model_texts"),
    "flags_run": _with(_flags("model_texts"), "model_texts"),
    "status_run": _with(_status("model_left"), "model_left"),
    "resumed_run": _with(
        _ledger(
            "model_lines",
            ", outcome, CAST(CASE WHEN outcome = 'success' THEN 1 ELSE 2 END AS BIGINT) AS run_seq",
        ),
        "model_lines",
    ),
    "compacted_run": _with(_ledger("model_lines", ", outcome"), "model_lines"),
    "skip_processed_compacted": _with("SELECT file_path FROM left_over", "left_over"),
    "restarted_run": _with(_status("model_lines"), "model_lines"),
    "raw_folder_run": _with(
        "SELECT '/' || md5(file_path) || '.' || regexp_extract(file_path, '[^.]*$') AS file_path, body "
        f"FROM ({_RAW_RUN.replace('model_texts', 'model_lines')})",
        "model_lines",
    ),
    "resumed_files_run": _with(_ledger("model_lines"), "model_lines"),
    "minimal_folder_run": _with(_minimal("model_lines"), "model_lines"),
    "flags_folder_run": _with(_flags("model_lines"), "model_lines"),
    "streamed_run": _with(_ledger("model_lines", ", outcome"), "model_lines"),
}
