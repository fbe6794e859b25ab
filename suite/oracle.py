"""The same results in SQL, for a side-by-side check of every query."""

from __future__ import annotations

from corpusloom.functions.text import WHITESPACE
from corpusloom.spec import DECLARED_SHARES
from suite.queries import BATCH_SIZE, LANGUAGE_CAPS, MIXTURE_BUDGET
from suite.sources import ANSWER_TAG, BOX_TAG, catalog

_WS = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)
_WS_BACK = " || ".join(f"chr({ord(c)})" for c in reversed(WHITESPACE))
_NL = "chr(10)"


def _strip(text: str) -> str:
    return f"trim({text}, {_WS})"


def _long(text: str) -> str:
    return f"length({_strip(text)}) >= 10"


def _block(role: str, body: str) -> str:
    return f"'<|{role}|>' || {_NL} || {body}"


# Reasoning texts: the part after the last mark is found by reversing the answer.
_RIGHT = "reverse(split_part(reverse(answer), '####', 1))"
_LEFT = f"left(answer, length(answer) - length({_RIGHT}) - 4)"
_ANSWER = f"""CASE
  WHEN contains(answer, '####') THEN '<think>' || {_NL} || {_strip(_LEFT)} || {_NL} || '</think>' || {_NL} || {_NL}
    || 'The answer is: ' || {_strip(_RIGHT)}
  WHEN contains(answer, '\\boxed{{') THEN '<think>' || {_NL} || answer || {_NL} || '</think>'
  ELSE answer END"""


def _reasoning(system: str = "''") -> str:
    body = f"{_block('user', 'question')} || {_NL} || {_block('assistant', f'({_ANSWER})')} || {_NL} || '<|end|>'"
    lead = f"CASE WHEN coalesce({system}, '') <> '' THEN {_block('system', system)} || {_NL} ELSE '' END"
    return f"CASE WHEN question = '' OR answer = '' THEN '' ELSE {lead} || {body} END"


_CTES = {
    "pairs": """SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer FROM conversations u
      JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
      WHERE u.role = 'user' AND a.role = 'assistant'""",
    "gsm": f"SELECT conv_id, turn, question, answer || '{ANSWER_TAG}' || turn AS answer FROM pairs",
    "boxed": f"SELECT conv_id, turn, question, answer || '{BOX_TAG}' || turn || '}}' AS answer FROM pairs",
    "orca": """SELECT p.*, s.system_prompt FROM pairs p LEFT JOIN
      (SELECT conv_id, arg_min(text, turn) AS system_prompt FROM conversations WHERE role = 'system' GROUP BY conv_id) s
      ON s.conv_id = p.conv_id""",
    "chat": f"""SELECT conv_id, string_agg('<|' || role || '|>' || {_NL} || text, {_NL} ORDER BY turn)
      || {_NL} || '<|end|>' AS text FROM conversations GROUP BY conv_id""",
    "dispatch": f"""SELECT 'web_en' AS source, doc_id::VARCHAR AS row_key, text FROM documents
      UNION ALL SELECT 'web_de', doc_id::VARCHAR, text FROM documents
      UNION ALL SELECT 'code', page_id::VARCHAR, html FROM pages
      UNION ALL SELECT 'gsm', conv_id || ':' || turn, {_reasoning()} FROM gsm
      UNION ALL SELECT 'boxed', conv_id || ':' || turn, {_reasoning()} FROM boxed
      UNION ALL SELECT 'orca', conv_id || ':' || turn, {_reasoning('system_prompt')} FROM orca
      UNION ALL SELECT 'chat', conv_id::VARCHAR, text FROM chat
      UNION ALL SELECT 'qa', item_id::VARCHAR,
        {_block('user', 'text')} || {_NL} || {_block('assistant', 'item_id')} || {_NL} || '<|end|>' FROM benchmark""",
}

# Kept and capped rows of the whole catalog.
_CAPS = {s.name: (s.batch_cap, s.streaming) for s in catalog()}
_CAP_CASE = "CASE source " + " ".join(f"WHEN '{n}' THEN {c if c is not None else 2**60}" for n, (c, _) in _CAPS.items()) + " END"
_LAZY = ", ".join(f"'{n}'" for n, (_, lazy) in _CAPS.items() if lazy)
_ORDER = "CASE WHEN contains(row_key, ':') THEN split_part(row_key, ':', 1)::BIGINT ELSE row_key::BIGINT END, " \
    "CASE WHEN contains(row_key, ':') THEN split_part(row_key, ':', 2)::BIGINT ELSE 0 END"
_CTES["scanned"] = f"""SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY {_ORDER}) AS at_scan, {_long('text')} AS keep
      FROM dispatch d WHERE NOT (source = 'web_en' AND row_key::VARCHAR NOT IN (SELECT doc_id::VARCHAR FROM documents WHERE lang = 'en'))
      AND NOT (source = 'web_de' AND row_key NOT IN (SELECT doc_id::VARCHAR FROM documents WHERE lang = 'de'))"""
_CTES["corpus"] = f"""SELECT source, row_key, text FROM (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY {_ORDER}) AS at_keep FROM scanned WHERE keep)
      WHERE CASE WHEN source IN ({_LAZY}) THEN at_keep ELSE at_scan END <= {_CAP_CASE}"""
_CTES["docs"] = "SELECT source, doc_id::VARCHAR AS row_key, text, md5('42|' || source || '|' || doc_id) AS h FROM documents"
_CTES["runs"] = """SELECT user_id AS run, event_id AS step, value AS loss, ts AS "timestamp",
      event_type <> 'error' AS success, event_type FROM events"""
# The split's hashes are its own; 1 % of 2**52 hash numbers are test rows.
_SPLIT_HASH = "md5('split|42|' || source || '|' || row_key)"
_SPLIT = f"CASE WHEN ('0x' || substr({_SPLIT_HASH}, 1, 13))::BIGINT < 45035996273705 THEN 'test' ELSE 'train' END"
_EXACT = f"""CASE WHEN row_number() OVER (ORDER BY {_SPLIT_HASH}, source, row_key) <= ceil(0.01::DOUBLE * count(*) OVER ())
      THEN 'test' ELSE 'train' END"""

_HEX = "substr(hex(encode(text)), 1, 4094)"
_DIGIT = "(strpos('0123456789ABCDEF', pair[{at}]) - 1)"
_BYTE_IDS = (
    f"[1] || list_transform(regexp_extract_all(x, '..'), "
    f"lambda pair: 3 + 16 * {_DIGIT.format(at=1)} + {_DIGIT.format(at=2)})"
)
_CTES["byte_tokens"] = f"""SELECT source, row_key, h, {_BYTE_IDS} AS ids FROM (SELECT *, {_HEX} AS x FROM docs)
      WHERE octet_length(encode(text)) + 1 >= 32"""
_CTES["placed"] = "SELECT *, row_number() OVER (ORDER BY h, source, row_key) AS row_index, count(*) OVER () AS row_total FROM docs"
_CTES["vocab"] = """SELECT piece, (row_number() OVER (ORDER BY n DESC, piece) + 2)::INTEGER AS id, n
      FROM (SELECT piece, count(*) AS n FROM (
        SELECT unnest(regexp_extract_all(text, '[^ \\n\\t\\r]+')) AS piece FROM docs) GROUP BY piece)
      ORDER BY n DESC, piece LIMIT 31997"""

_NEEDS = {
    "gsm": ["pairs"], "boxed": ["pairs"], "orca": ["pairs"],
    "dispatch": ["pairs", "gsm", "boxed", "orca", "chat"],
    "scanned": ["pairs", "gsm", "boxed", "orca", "chat", "dispatch"],
    "corpus": ["pairs", "gsm", "boxed", "orca", "chat", "dispatch", "scanned"],
    "byte_tokens": ["docs"], "placed": ["docs"], "vocab": ["docs"],
}


def _with(names: str, body: str) -> str:
    wanted: list[str] = []
    for name in names.split():
        wanted += [n for n in [*_NEEDS.get(name, []), name] if n not in wanted]
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n]})" for n in wanted) + "\n" + body


def _ids(column: str) -> str:
    return f"array_to_string({column}, ',')"


def _caps_by_language(after: bool) -> str:
    test = _long("text")
    parts = []
    for lang, cap in LANGUAGE_CAPS.items():
        rows = f"SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) AS n FROM documents WHERE lang = '{lang}'"
        rows = f"SELECT * FROM ({rows}{f' AND {test}' if after else ''}) WHERE n <= {cap} AND {test}"
        parts.append(f"SELECT 'web_{lang}' AS source, doc_id::VARCHAR AS row_key, text FROM ({rows})")
    return " UNION ALL ".join(parts)


_WEIGHT = sum(s.weight for s in catalog())
_QUOTA = "CASE source " + " ".join(
    f"WHEN '{s.name}' THEN {int(MIXTURE_BUDGET * s.weight / _WEIGHT + 0.5)}" for s in catalog()
) + " END"
_CATALOG = "(VALUES " + ", ".join(f"('{s.name}', '{s.category}', {s.weight}::DOUBLE)" for s in catalog()) + \
    ") c(source, category, weight)"
_SHARES = "(VALUES " + ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in DECLARED_SHARES.items()) + ") s(category, declared_share)"

_DOC_COLUMNS = "source, row_key"

ORACLE = {
    "scan_batch": "SELECT doc_id, lang, source, n_chars, text FROM documents",
    "scan_lazy_capped": f"""SELECT 'code' AS source, page_id::VARCHAR AS row_key, html AS text FROM pages
      WHERE {_long('html')} ORDER BY page_id LIMIT 200""",
    "scan_subset_de": "SELECT doc_id, lang, text FROM documents WHERE lang = 'de'",
    "corpus_union": _with("corpus", "SELECT source, row_key, text FROM corpus"),
    "scan_tolerant": f"""SELECT 'documents' AS source, doc_id::VARCHAR AS row_key, text FROM documents WHERE {_long('text')}
      UNION ALL SELECT 'missing', '', 'left out'""",
    "scan_staged": f"SELECT 'documents' AS source, doc_id::VARCHAR AS row_key, text FROM documents WHERE {_long('text')}",
    "corpus_write": _with("corpus", f"""SELECT source, row_key, {_SPLIT} AS split,
      least(octet_length(encode(text)) + 1, 2048)::INTEGER AS n_tokens
      FROM (SELECT *, md5('42|' || source || '|' || row_key) AS h FROM corpus) WHERE octet_length(encode(text)) + 1 >= 32"""),
    "run_history_append": _with("runs", """SELECT step, step / 1000 AS epoch, loss, "timestamp", 'base' AS model_name,
      1000000000::BIGINT AS num_params, CASE WHEN success THEN 'good' ELSE 'bad' END AS entry FROM runs"""),
    "snapshot_folder": "SELECT c_mktsegment, CAST(c_custkey AS BIGINT) AS c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'",
    "snapshot_publish": "SELECT doc_id, text, lang, source FROM documents",
    "render_dispatch": _with("dispatch", "SELECT source, row_key, text FROM dispatch"),
    "render_chat": _with("chat", "SELECT conv_id, text FROM chat"),
    "render_reasoning": _with("gsm boxed", f"""SELECT conv_id, turn, {_reasoning()} AS text
      FROM (SELECT * FROM gsm UNION ALL SELECT * FROM boxed UNION ALL SELECT * FROM pairs)"""),
    "render_final_answer": _with("gsm", f"SELECT conv_id, turn, {_reasoning()} AS text FROM gsm"),
    "render_boxed": _with("boxed", f"SELECT conv_id, turn, {_reasoning()} AS text FROM boxed"),
    "render_general": _with("pairs", f"SELECT conv_id, turn, {_reasoning()} AS text FROM pairs"),
    "render_system": _with("orca", f"SELECT conv_id, turn, {_reasoning('system_prompt')} AS text FROM orca"),
    "render_qa": f"""SELECT item_id, {_block('user', 'text')} || {_NL} || {_block('assistant', 'item_id')} || {_NL}
      || '<|end|>' AS text FROM benchmark""",
    "render_plain": """SELECT doc_id, text FROM documents
      UNION ALL SELECT doc_id, coalesce(n_chars::VARCHAR, 'None') FROM documents""",
    "render_missing": "SELECT doc_id, '' AS text FROM documents",
    "project_text": "SELECT html AS text FROM pages",
    "scalar_strip": f"""SELECT doc_id, {_strip('x')} AS stripped, length({_strip('x')})::INTEGER AS n
      FROM (SELECT doc_id, {_WS} || text || {_WS_BACK} AS x FROM documents)""",
    "scalar_rsplit": f"""SELECT doc_id, {_LEFT} AS left_part, {_RIGHT} AS right_part
      FROM (SELECT doc_id, '#' || replace(text, 'a', '#####') || '####' || lang AS answer FROM documents)""",
    "filter_min_chars": f"SELECT doc_id, text FROM documents WHERE {_long('text')}",
    "filter_min_tokens": _with("docs", """SELECT source, row_key, least(octet_length(encode(text)) + 1, 2048)::INTEGER AS n_tokens
      FROM docs WHERE octet_length(encode(text)) + 1 >= 32"""),
    "metrics_every_n": _with("runs", "SELECT run, step, loss FROM runs WHERE step % 10 = 0"),
    "cap_after_filter": _caps_by_language(after=True),
    "cap_before_filter": _caps_by_language(after=False),
    "retain_latest_n": _with("runs", """SELECT run, step, loss FROM (
      SELECT *, row_number() OVER (PARTITION BY run ORDER BY step DESC) AS n FROM runs) WHERE n <= 5"""),
    "latest_checkpoint": _with("runs", """SELECT run, 'checkpoint-' || CASE
        WHEN arg_max(event_type, {'l': loss, 's': step}) = 'purchase' THEN arg_max(step, {'l': loss, 's': step})
        ELSE max(step) END AS path FROM runs GROUP BY run"""),
    "shuffle_seeded": _with("docs", "SELECT source, row_key, text, h AS row_hash FROM docs ORDER BY h, source, row_key"),
    "global_index": _with("placed", "SELECT row_index, row_total, source, row_key FROM placed"),
    "split_exact": _with("docs", f"SELECT source, row_key, {_EXACT} AS split FROM docs"),
    "mixture_split": _with("corpus", f"""SELECT source, row_key, {_EXACT} AS split FROM (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('mixture|42|' || source || '|' || row_key)) AS n FROM corpus)
      WHERE n <= {_QUOTA}"""),
    "row_keys": r"""SELECT doc_id, coalesce(replace(replace(nullif(lang, 'en') || repeat(':', (doc_id % 3)::INTEGER), '\', '\\'), ':', '\:'), '\N')
      || ':' || doc_id AS row_key FROM documents""",
    "split_hash": _with("docs", f"SELECT source, row_key, {_SPLIT} AS split FROM docs"),
    "mixture_quota": _with("corpus", f"""SELECT source, row_key, text FROM (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('mixture|42|' || source || '|' || row_key)) AS n FROM corpus)
      WHERE n <= {_QUOTA}"""),
    "mixture_report": _with("corpus", f"""SELECT category, sources, rows, weight_share,
        round(rows / (SELECT count(*) FROM corpus), 6) AS observed_share, declared_share
      FROM (SELECT category, count(*) AS sources, coalesce(sum(n), 0)::BIGINT AS rows,
          round(sum(weight) / (SELECT sum(weight) FROM {_CATALOG}), 6) AS weight_share
        FROM {_CATALOG} LEFT JOIN (SELECT source, count(*) AS n FROM corpus GROUP BY source) USING (source)
        GROUP BY category) LEFT JOIN {_SHARES} USING (category)"""),
    "count_per_source": _with("corpus", f"""SELECT source, coalesce(n, 0) AS rows
      FROM (SELECT source FROM {_CATALOG} UNION ALL SELECT 'empty')
      LEFT JOIN (SELECT source, count(*) AS n FROM corpus GROUP BY source) USING (source)"""),
    "count_total": _with("corpus", "SELECT count(*) AS rows FROM corpus"),
    "count_tokenized": "SELECT count(*) AS rows FROM documents WHERE octet_length(encode(text)) + 1 >= 32",
    "count_split": _with("docs", f"SELECT {_SPLIT} AS split, count(*) AS rows FROM docs GROUP BY 1"),
    "observe_filter": f"""SELECT count(*) AS scanned, count(*) FILTER (WHERE {_long('text')}) AS kept,
      count(*) FILTER (WHERE NOT {_long('text')}) AS rejected FROM documents""",
    "step_budget": _with("docs", f"""SELECT train_rows, 128::BIGINT AS effective_batch, steps AS steps_per_epoch,
      round(100000 / steps, 4) AS epochs FROM (SELECT train_rows, greatest(train_rows // 8 // 16, 1) AS steps FROM (
        SELECT count(*) FILTER (WHERE {_SPLIT} = 'train') AS train_rows FROM docs))"""),
    "last_metric": _with("runs", "SELECT run, coalesce(arg_max(loss, step), 0.0::DOUBLE) AS loss FROM runs GROUP BY run"),
    "publish_outcomes": _with("runs", """SELECT run, count(*) AS attempts, count(*) FILTER (WHERE success) AS successes,
      max(step) AS last_step, arg_max(success, step) AS last_success FROM runs GROUP BY run"""),
    "tokenize_bytes": _with("byte_tokens", f"""SELECT source, row_key, {_ids('ids')} AS input_ids,
      {_ids('list_transform(ids, lambda i: 1)')} AS attention_mask FROM byte_tokens"""),
    "tokenize_plugged": _with("byte_tokens", f"SELECT source, row_key, {_ids('ids')} AS input_ids FROM byte_tokens"),
    "vocabulary": _with("vocab", "SELECT piece, id, n FROM vocab"),
    "tokenize_vocab": _with("vocab", """SELECT source, row_key, '1,' || string_agg(coalesce(id, 0)::VARCHAR, ',' ORDER BY spot) AS input_ids
      FROM (SELECT source, row_key, length(p) AS n_pieces, unnest(p[1:2047]) AS piece, generate_subscripts(p[1:2047], 1) AS spot
        FROM (SELECT source, row_key, regexp_extract_all(text, '[^ \\n\\t\\r]+') AS p FROM docs))
      LEFT JOIN vocab USING (piece) WHERE n_pieces + 1 >= 32 GROUP BY source, row_key"""),
    "map_rows": _with("docs", "SELECT row_key, length(text) AS n FROM docs"),
    "batch_drop_last": _with("placed", """SELECT (row_index - 1) // 16 AS batch_id, ((row_index - 1) % 16)::INTEGER AS batch_row,
      source, row_key FROM placed WHERE (row_index - 1) // 16 < row_total // 16"""),
    "lm_collate": _with("byte_tokens", f"""SELECT batch_id, batch_row,
        {_ids('ids || repeat([0], longest - length(ids))')} AS input_ids,
        {_ids('list_transform(ids, lambda i: 1) || repeat([0], longest - length(ids))')} AS attention_mask,
        {_ids('ids || repeat([-100], longest - length(ids))')} AS labels
      FROM (SELECT *, max(length(ids)) OVER (PARTITION BY batch_id) AS longest FROM (
        SELECT ids, (place // {BATCH_SIZE}) AS batch_id, (place % {BATCH_SIZE})::INTEGER AS batch_row, total FROM (
          SELECT ids, row_number() OVER (ORDER BY h, source, row_key) - 1 AS place, count(*) OVER () AS total FROM byte_tokens))
        WHERE batch_id < total // {BATCH_SIZE})"""),
    "stream_two_sources": f"""SELECT 'web_' || lang AS source, doc_id::VARCHAR AS row_key,
        least(octet_length(encode(text)) + 1, 2048)::INTEGER AS n_tokens
      FROM documents WHERE lang IN ('en', 'de') AND {_long('text')} AND octet_length(encode(text)) + 1 >= 10""",
    "corpus_summary": f"""SELECT 'missing' AS source, 0::BIGINT AS rows, true AS left_out UNION ALL
      SELECT 'documents', count(*), false FROM documents WHERE {_long('text')} AND octet_length(encode(text)) + 1 >= 32""",
    "stream_prepare": f"""SELECT 'web_en' AS source, doc_id::VARCHAR AS row_key, {_ids(_BYTE_IDS)} AS input_ids
      FROM (SELECT doc_id, {_HEX} AS x FROM documents WHERE lang = 'en' AND {_long('text')} ORDER BY doc_id LIMIT 500)""",
    "stream_resume": f"""SELECT 'documents' AS source, doc_id::VARCHAR AS row_key,
      least(octet_length(encode(text)) + 1, 2048)::INTEGER AS n_tokens, (lang <> 'en')::BIGINT AS batch
      FROM documents WHERE {_long('text')}""",
    "stream_shuffle": """SELECT 0::BIGINT AS batch, row_number() OVER (ORDER BY md5('42|documents|' || doc_id)) AS row_index,
      'documents' AS source, doc_id::VARCHAR AS row_key FROM documents""",
    "scan_damage": """SELECT 'ok' AS state, 3::BIGINT AS files, count(*) AS expected, count(*) AS read, 0::BIGINT AS lost FROM documents
      UNION ALL SELECT 'no rows', 1, NULL, 0, NULL""",
    "scan_cached": "SELECT doc_id, lang, text, 2::BIGINT AS stages FROM documents",
    "checkpoint_folders": """SELECT user_id::VARCHAR AS run, user_id || '/checkpoint-' || max(event_id) AS path
      FROM events WHERE user_id < 3 GROUP BY user_id""",
    "corpus_isolated": f"""SELECT 'web_' || lang AS source, count(*) AS rows, NULL::BOOLEAN AS bad_row
      FROM documents WHERE lang IN ('en', 'de', 'fr', 'es') AND {_long('text')} GROUP BY lang
      UNION ALL SELECT 'broken', 0, true""",
    "corpus_versions": _with("docs", f"SELECT source, row_key, {_SPLIT} AS split FROM docs"),
    "render_numbers": """SELECT l_orderkey, l_linenumber, (l_extendedprice::DOUBLE * scale)::VARCHAR AS text
      FROM lineitem, (VALUES (1e-9::DOUBLE), (1.0::DOUBLE), (1e8::DOUBLE), (1e13::DOUBLE)) s(scale)""",
    "cap_keyless": f"""SELECT 'lazy' AS source, row, text FROM (
        SELECT *, row_number() OVER (ORDER BY row) AS n FROM (
          SELECT text, row_number() OVER (ORDER BY doc_id) - 1 AS row FROM documents) WHERE {_long('text')}) WHERE n <= 150
      UNION ALL SELECT 'batch', row, text FROM (SELECT text, row_number() OVER (ORDER BY doc_id) - 1 AS row FROM documents)
      WHERE row < 150 AND {_long('text')}""",
    "cap_large": """WITH e AS (SELECT user_id || ':' || event_id AS row_key, 'user ' || user_id || ' did ' || event_type AS text,
          user_id, event_id FROM events)
      SELECT 'lazy' AS source, row_key, text FROM (
        SELECT *, row_number() OVER (ORDER BY user_id, event_id) AS n FROM e WHERE length(text) >= 16) WHERE n <= 700
      UNION ALL SELECT 'batch', row_key, text FROM (SELECT *, row_number() OVER (ORDER BY user_id, event_id) AS n FROM e)
      WHERE n <= 700 AND length(text) >= 16""",
    "vocabulary_cut": _with("vocab", "SELECT piece, id, n FROM vocab WHERE id < 1503"),
    "stream_progress": f"""WITH b AS (
        SELECT (lang <> 'en')::BIGINT AS batch, count(*) AS scanned,
          count(*) FILTER (WHERE {_long('text')} AND octet_length(encode(text)) + 1 >= 10) AS fit FROM documents GROUP BY 1),
      k AS (SELECT *, least(sum(fit) OVER (ORDER BY batch), 300)::BIGINT AS kept_so_far FROM b),
      d AS (SELECT *, (kept_so_far - coalesce(lag(kept_so_far) OVER (ORDER BY batch), 0))::BIGINT AS kept FROM k)
      SELECT 'documents' AS source, batch, scanned, kept, (scanned - kept)::BIGINT AS rejected, kept_so_far FROM d""",
}
