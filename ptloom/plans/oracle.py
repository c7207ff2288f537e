"""DuckDB twins of the catalog queries (the correctness oracle).

Each entry is plain SQL over the pre-registered driver-table views.  Derived
inputs are CTE fragments with the same definitions as ``derived.py``; they
are written independently in SQL, not generated from the Spark code.
"""

from __future__ import annotations

from ptloom import constants as K


def H(*parts: str, start: int = 1) -> str:
    """Seeded hash: 8 hex digits of md5('42|p1|p2..') as an integer."""
    joined = ", ".join(["'42'", *parts])
    return f"('0x' || substr(md5(concat_ws('|', {joined})), {start}, 8))::BIGINT"


def STRIP(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def sql_str(s: str) -> str:
    """SQL literal of a Python string (newlines via chr(10))."""
    parts = s.split("\n")
    lits = ["'" + p.replace("'", "''") + "'" for p in parts]
    return " || chr(10) || ".join(lits)


TOOLS_LIST = "[" + ", ".join(f"'{t}'" for t in K.TOOL_NAMES) + "]"

TOOLCALLS = """
toolcalls AS (
  SELECT key, prompt, tool, arguments_json, answer,
         json_object('tool', tool, 'arguments', json(arguments_json))::VARCHAR AS chosen
  FROM (
    SELECT 'calculator-' || o_orderkey AS key,
           'Calculate ' || o_custkey || ' * ' || (o_orderkey % 97 + 2) || '.' AS prompt,
           'calculator' AS tool,
           json_object('expression', o_custkey || ' * ' || (o_orderkey % 97 + 2))::VARCHAR AS arguments_json,
           CAST(o_custkey * (o_orderkey % 97 + 2) AS VARCHAR) AS answer
    FROM orders
    UNION ALL
    SELECT 'weather-' || n_nationkey, 'What is the weather in ' || n_name || '?', 'weather',
           json_object('city', n_name)::VARCHAR, NULL FROM nation
    UNION ALL
    SELECT 'search-' || p_partkey, 'Search for ' || p_name || '.', 'search',
           json_object('query', p_name)::VARCHAR, NULL FROM part
    UNION ALL
    SELECT 'translate-' || r_regionkey, 'Translate "' || r_name || '" to French.', 'translate',
           json_object('text', r_name)::VARCHAR, NULL FROM region
    UNION ALL
    SELECT 'unit_convert-' || c_custkey, 'Convert ' || c_custkey || ' kilometers to miles.', 'unit_convert',
           json_object('value', c_custkey, 'from_unit', 'km', 'to_unit', 'miles')::VARCHAR, NULL FROM customer
  )
)"""

VARIANTS = f"""
variants AS (
  SELECT key, 1 AS variant,
         'I will calculate this for you. The answer is approximately ' || (1 + {H('key', "'prose'")} % 9999) || '.' AS text
  FROM toolcalls
  UNION ALL
  SELECT key, 2, json_object('function', tool, 'params', json(arguments_json))::VARCHAR FROM toolcalls
  UNION ALL
  SELECT key, 3, json_object('tool', list_filter({TOOLS_LIST}, lambda x: x <> tool)[1 + {H('key', "'wrong_tool'")} % 4],
                             'arguments', json(arguments_json))::VARCHAR FROM toolcalls
  UNION ALL
  SELECT key, 4, {sql_str(K.REJECT_EXTRA_TEXT_PREFIX)} || chosen || {sql_str(K.REJECT_EXTRA_TEXT_SUFFIX)} FROM toolcalls
  UNION ALL
  SELECT key, 5, json_object('tool', tool, 'arguments', json('{{}}'))::VARCHAR FROM toolcalls
  UNION ALL
  SELECT key, 6, '{{"tool": "' || tool || '", "arguments": {{' FROM toolcalls
)"""

PAIRS = """
pairs AS (
  SELECT t.key, t.prompt, t.tool, t.arguments_json, t.answer, t.chosen,
         v.variant, v.text AS rejected, t.key || '-' || v.variant AS pair_id
  FROM toolcalls t JOIN variants v USING (key)
)"""


def CLASSIFY(x: str) -> str:
    s = STRIP(x)
    return f"""CASE WHEN {x} IS NULL OR NOT starts_with({s}, '{{') THEN 'non_json'
     WHEN NOT json_valid({s}) THEN 'invalid_json'
     WHEN json_exists({s}, '$.function') OR json_exists({s}, '$.params') THEN 'wrong_key_name'
     WHEN json_type({s}, '$.arguments') = 'OBJECT' AND json_extract({s}, '$.arguments')::VARCHAR = '{{}}' THEN 'empty_arguments'
     WHEN json_exists({s}, '$.tool') THEN 'wrong_tool_name'
     WHEN length({s}) > {K.EXTRA_TEXT_MIN_CHARS} THEN 'extra_text_pollution'
     ELSE 'other' END"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


PREF_QUALITY_REPORT = with_ctes(TOOLCALLS, VARIANTS, PAIRS) + f"""
, classified AS (
  SELECT tool, {CLASSIFY('rejected')} AS rejected_type,
         (CASE WHEN chosen = rejected THEN 2 ELSE 0 END
          + CASE WHEN {STRIP('prompt')} = '' THEN 1 ELSE 0 END
          + CASE WHEN {STRIP('chosen')} = '' THEN 1 ELSE 0 END
          + CASE WHEN {STRIP('rejected')} = '' THEN 1 ELSE 0 END) AS n_err
  FROM pairs
)
SELECT tool, rejected_type, CAST(count(*) AS BIGINT) AS n,
       round(count(*) / sum(count(*)) OVER (PARTITION BY tool), 6) AS share,
       CAST(sum(n_err) AS BIGINT) AS n_errors
FROM classified GROUP BY tool, rejected_type
"""

ORACLE: dict[str, str] = {
    "pref_quality_report": PREF_QUALITY_REPORT,
}

# ------------------------------------------------------------ preference data
SYS = sql_str(K.PREFERENCE_SYSTEM_PROMPT)
MSG_T = "STRUCT(role VARCHAR, content VARCHAR)[]"
VAL_HEX = "'19999999'"  # ratio_threshold_hex(0.1)

PAIR_CTES = with_ctes(TOOLCALLS, VARIANTS, PAIRS)

ORACLE["toolcalls_build"] = with_ctes(TOOLCALLS) + """
SELECT key, prompt, tool, arguments_json, answer, chosen FROM toolcalls"""

REGISTRY_VALUES = ", ".join(
    f"('{name}', {sql_str(desc)}, {len(keys)})" for name, desc, keys in K.TOOLS
)
ORACLE["tool_lookup"] = with_ctes(TOOLCALLS) + f"""
, reg(tool, description, n_arg_keys) AS (VALUES {REGISTRY_VALUES})
, per_tool AS (SELECT tool, CAST(count(*) AS BIGINT) AS n_prompts FROM toolcalls GROUP BY tool)
SELECT tool, description, CAST(n_arg_keys AS BIGINT) AS n_arg_keys, n_prompts, false AS unknown
FROM per_tool JOIN reg USING (tool)
UNION ALL
SELECT tool, NULL, NULL, n_prompts, true FROM per_tool WHERE tool NOT IN (SELECT tool FROM reg)"""

ORACLE["pref_pairs_build"] = PAIR_CTES + f"""
SELECT pair_id, key, variant, rejected,
       to_json({{'prompt': [{{'role': 'system', 'content': {SYS}}}, {{'role': 'user', 'content': prompt}}],
                'chosen': [{{'role': 'assistant', 'content': chosen}}],
                'rejected': [{{'role': 'assistant', 'content': rejected}}]}})::VARCHAR AS record
FROM pairs"""

ORACLE["rejected_distribution"] = PAIR_CTES + f"""
, c AS (SELECT {CLASSIFY('rejected')} AS rejected_type, CAST(count(*) AS BIGINT) AS n FROM pairs GROUP BY 1)
SELECT rejected_type, n, max(n) OVER () AS max_n, CAST(floor(n * 20 / max(n) OVER ()) AS BIGINT) AS bar_len,
       round(n / sum(n) OVER (), 6) AS share
FROM c"""

ORACLE["class_balance"] = PAIR_CTES + f"""
, c AS (SELECT {CLASSIFY('rejected')} AS t, count(*) AS n FROM pairs GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS n_total, CAST(count(*) AS BIGINT) AS n_types,
       round(max(n) / sum(n), 6) AS max_share, max(n) / sum(n) < 0.5 AS balanced
FROM c"""

RAW_PAIRS = f"""
raw_pairs AS (
  SELECT line_id, tool, damage, file,
         CASE damage WHEN 0 THEN left(js, length(js) - 1) WHEN 1 THEN '  ' ELSE js END AS value
  FROM (
    SELECT line_id, tool, damage, file,
           CASE WHEN damage = 2 THEN to_json({{'prompt': pm, 'chosen': cm}})
                ELSE to_json({{'prompt': pm, 'chosen': cm, 'rejected': rm}}) END::VARCHAR AS js
    FROM (
      SELECT pair_id AS line_id, tool, d AS damage,
             CASE WHEN substr(md5('42|' || key), 1, 8) < {VAL_HEX} THEN 'preference_val.jsonl'
                  ELSE 'preference_train.jsonl' END AS file,
             [{{'role': 'system', 'content': {SYS}}}, {{'role': 'user', 'content': prompt}}] AS pm,
             CASE WHEN d = 3 THEN []::{MSG_T}
                  WHEN d = 5 THEN [{{'role': 'bot', 'content': chosen}}]
                  ELSE [{{'role': 'assistant', 'content': chosen}}] END AS cm,
             CASE WHEN d = 4 THEN [{{'role': 'assistant', 'content': chosen}}]
                  WHEN d = 6 THEN [{{'role': 'assistant', 'content': ' '}}]
                  ELSE [{{'role': 'assistant', 'content': rejected}}] END AS rm
      FROM (SELECT *, {H("'rawpair'", 'pair_id')} % 11 AS d FROM pairs)
    )
  )
)"""

# the roles of a message; by field under strict roles
ANY_ROLE = "(m ->> '$.role') IN ('system', 'user', 'assistant')"
STRICT_ROLE = "CASE WHEN name = 'prompt' THEN (m ->> '$.role') IN ('system', 'user') ELSE (m ->> '$.role') = 'assistant' END"


def pref_validate_sql(role_ok: str) -> str:
    return f"""
, lines AS (SELECT line_id, file, {STRIP('value')} AS s FROM raw_pairs WHERE {STRIP('value')} <> '')
, pj AS (SELECT line_id, file, CASE WHEN json_valid(s) THEN s::JSON END AS j, json_valid(s) AS ok FROM lines)
, st AS (
  SELECT line_id, file, j,
         CASE WHEN NOT ok THEN 'invalid_json'
              WHEN json_type(j) <> 'OBJECT' THEN 'not_object'
              WHEN NOT (json_exists(j, '$.prompt') AND json_exists(j, '$.chosen') AND json_exists(j, '$.rejected')) THEN 'missing'
              ELSE 'checked' END AS stage
  FROM pj)
, fields(name) AS (VALUES ('prompt'), ('chosen'), ('rejected'))
, msgs AS (
  SELECT line_id, 'prompt' AS name, unnest(json_extract(j, '$.prompt[*]')) AS m
  FROM st WHERE stage = 'checked' AND json_type(j, '$.prompt') = 'ARRAY'
  UNION ALL
  SELECT line_id, 'chosen', unnest(json_extract(j, '$.chosen[*]'))
  FROM st WHERE stage = 'checked' AND json_type(j, '$.chosen') = 'ARRAY'
  UNION ALL
  SELECT line_id, 'rejected', unnest(json_extract(j, '$.rejected[*]'))
  FROM st WHERE stage = 'checked' AND json_type(j, '$.rejected') = 'ARRAY')
, errs AS (
  SELECT line_id, stage AS rule FROM st WHERE stage IN ('invalid_json', 'not_object')
  UNION ALL SELECT line_id, 'missing_field' FROM st, fields WHERE stage = 'missing' AND NOT json_exists(j, '$.' || name)
  UNION ALL SELECT line_id, 'not_list' FROM st, fields WHERE stage = 'checked' AND json_type(j, '$.' || name) <> 'ARRAY'
  UNION ALL SELECT line_id, 'empty_list' FROM st, fields
            WHERE stage = 'checked' AND json_type(j, '$.' || name) = 'ARRAY' AND json_array_length(j, '$.' || name) = 0
  UNION ALL SELECT line_id, 'message_not_object' FROM msgs WHERE json_type(m) <> 'OBJECT'
  UNION ALL SELECT line_id, 'missing_role' FROM msgs WHERE json_type(m) = 'OBJECT' AND NOT json_exists(m, '$.role')
  UNION ALL SELECT line_id, 'bad_role' FROM msgs
            WHERE json_type(m) = 'OBJECT' AND json_exists(m, '$.role')
              AND NOT coalesce(json_type(m, '$.role') = 'VARCHAR' AND {role_ok}, false)
  UNION ALL SELECT line_id, 'missing_content' FROM msgs WHERE json_type(m) = 'OBJECT' AND NOT json_exists(m, '$.content')
  UNION ALL SELECT line_id, 'content_not_string' FROM msgs
            WHERE json_type(m) = 'OBJECT' AND json_exists(m, '$.content') AND json_type(m, '$.content') <> 'VARCHAR'
  UNION ALL SELECT line_id, 'empty_content' FROM msgs
            WHERE json_type(m) = 'OBJECT' AND json_type(m, '$.content') = 'VARCHAR' AND {STRIP("(m ->> '$.content')")} = ''
  UNION ALL SELECT line_id, 'chosen_equals_rejected' FROM st
            WHERE stage = 'checked'
              AND coalesce(json_extract(j, '$.chosen[#-1].content')::VARCHAR, '""')
                = coalesce(json_extract(j, '$.rejected[#-1].content')::VARCHAR, '""'))
, rej AS (
  SELECT line_id,
         CASE WHEN json_extract(j, '$.rejected[#-1].content') IS NULL THEN ''
              WHEN json_type(j, '$.rejected[#-1].content') = 'VARCHAR' THEN json_extract_string(j, '$.rejected[#-1].content')
         END AS rej_text
  FROM st WHERE stage = 'checked')
, per_line AS (
  SELECT st.line_id, st.file,
         CAST(count(errs.rule) AS BIGINT) AS n_errors,
         CAST(count(errs.rule) FILTER (WHERE errs.rule = 'chosen_equals_rejected') AS BIGINT) AS n_warnings,
         coalesce(string_agg(errs.rule, ',' ORDER BY errs.rule), '') AS rules
  FROM st LEFT JOIN errs USING (line_id) GROUP BY st.line_id, st.file)
"""


PREF_VALIDATE = pref_validate_sql(ANY_ROLE)

ORACLE["pref_validate_lines"] = with_ctes(TOOLCALLS, VARIANTS, PAIRS, RAW_PAIRS) + PREF_VALIDATE + f"""
SELECT p.line_id, p.file, p.n_errors, p.n_warnings,
       CASE WHEN rej.line_id IS NULL THEN NULL ELSE {CLASSIFY('rej.rej_text')} END AS rejected_type, p.rules
FROM per_line p LEFT JOIN rej USING (line_id)"""

PREF_RULE_PAIRS = f"""
raw_pairs AS (
  SELECT line_id, file, CASE WHEN d = 0 THEN '[' || js || ']' ELSE js END AS value FROM (
    SELECT pair_id AS line_id, d, file, '{{"prompt": '
        || CASE d WHEN 4 THEN '[{{"content": "x"}}]' WHEN 7 THEN '[{{"role": "assistant", "content": "x"}}]'
                  ELSE to_json([{{'role': 'system', 'content': {SYS}}}, {{'role': 'user', 'content': prompt}}])::VARCHAR END
        || ', "chosen": '
        || CASE d WHEN 1 THEN '"a text"' WHEN 2 THEN '["a text"]' WHEN 5 THEN '[{{"role": "assistant"}}]' WHEN 6 THEN '[{{"role": "user", "content": "x"}}]'
                  ELSE to_json([{{'role': 'assistant', 'content': chosen}}])::VARCHAR END
        || ', "rejected": '
        || CASE d WHEN 3 THEN '[{{"role": "assistant", "content": 5}}]'
                  WHEN 8 THEN to_json([{{'role': 'assistant', 'content': '{{"note": "' || repeat('many words ', 20) || '"}}'}}])::VARCHAR
                  WHEN 9 THEN to_json([{{'role': 'assistant', 'content': '{{"a": 1}}'}}])::VARCHAR
                  WHEN 10 THEN 'null' ELSE to_json([{{'role': 'assistant', 'content': rejected}}])::VARCHAR END || '}}' AS js
    FROM (SELECT *, {H("'prefrule'", 'pair_id')} % 13 AS d,
                 CASE WHEN substr(md5('42|' || key), 1, 8) < {VAL_HEX} THEN 'preference_val.jsonl' ELSE 'preference_train.jsonl' END AS file FROM pairs)))"""

ORACLE["pref_rule_lines"] = with_ctes(TOOLCALLS, VARIANTS, PAIRS, PREF_RULE_PAIRS) + PREF_VALIDATE + f"""
SELECT p.line_id, p.file, p.n_errors, p.n_warnings,
       CASE WHEN rej.line_id IS NULL THEN NULL ELSE {CLASSIFY('rej.rej_text')} END AS rejected_type, p.rules
FROM per_line p LEFT JOIN rej USING (line_id)"""

ORACLE["pref_strict_role_lines"] = with_ctes(TOOLCALLS, VARIANTS, PAIRS, PREF_RULE_PAIRS) + pref_validate_sql(STRICT_ROLE) + """
SELECT line_id, n_errors, rules FROM per_line"""

ORACLE["line_error_table"] = with_ctes(TOOLCALLS, VARIANTS, PAIRS, RAW_PAIRS) + PREF_VALIDATE + """
, places AS (SELECT line_id, file, row_number() OVER (PARTITION BY file ORDER BY line_id) - 1 AS n FROM raw_pairs)
SELECT file || '/' || (n // 1000) AS path, CAST(n % 1000 + 1 AS BIGINT) AS line_no, rule FROM errs JOIN places USING (line_id)
UNION ALL SELECT 'preference_test.jsonl', NULL, 'file_missing'"""

ORACLE["pref_file_summary"] = with_ctes(TOOLCALLS, VARIANTS, PAIRS, RAW_PAIRS) + PREF_VALIDATE + """
SELECT file, CAST(count(*) AS BIGINT) AS n_examples, CAST(sum(n_errors) AS BIGINT) AS n_errors,
       CAST(sum(n_warnings) AS BIGINT) AS n_warnings
FROM per_line GROUP BY file"""

ORACLE["pref_string_to_messages"] = PAIR_CTES + """
SELECT pair_id AS id,
       to_json([{'role': 'user', 'content': prompt}])::VARCHAR AS prompt_json,
       to_json([{'role': 'assistant', 'content': chosen}])::VARCHAR AS chosen_json,
       to_json([{'role': 'assistant', 'content': rejected}])::VARCHAR AS rejected_json
FROM pairs"""

# ------------------------------------------------------------------ chat data
CHAT = """
chat AS (
  SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS messages
  FROM conversations GROUP BY conv_id
)"""

RAW_CHAT = f"""
raw_chat AS (
  SELECT line_id, damage,
         CASE damage WHEN 0 THEN left(js, length(js) - 1) WHEN 1 THEN '   ' WHEN 4 THEN js || ' tail'
                     WHEN 5 THEN '[' || js || ']' ELSE js END AS value
  FROM (
    SELECT line_id, damage,
           CASE WHEN damage = 3 THEN to_json({{'id': conv_id, 'messages': msgs, 'meta': {{'task': 'chat'}}}})
                ELSE to_json({{'id': CASE WHEN damage = 9 THEN ' ' ELSE line_id END, 'messages': msgs,
                               'meta': {{'task': 'chat'}}}}) END::VARCHAR AS js
    FROM (
      SELECT conv_id, line_id, damage,
             CASE WHEN damage = 6 THEN []::{MSG_T}
                  WHEN damage = 7 THEN list_transform(messages, lambda x, i: {{'role': x.role, 'content': CASE WHEN i = 1 THEN ' ' ELSE x.content END}})
                  WHEN damage = 8 THEN list_transform(messages, lambda x: {{'role': x.role, 'content': CASE WHEN x.role = 'assistant' THEN '{{"tool": "calculator", "arguments": {{' ELSE x.content END}})
                  WHEN damage = 2 THEN list_transform(messages, lambda x: {{'role': CASE WHEN x.role = 'user' THEN 'bot' ELSE x.role END, 'content': x.content}})
                  ELSE messages END AS msgs
      FROM (SELECT conv_id, 'conv-' || conv_id AS line_id, {H("'raw'", "'conv-' || conv_id")} % 13 AS damage, messages FROM chat)
    )
  )
)"""


def chat_validate_sql(lines_cte: str, require_assistant: bool = True) -> str:
    """Chat validator over a CTE with columns line_id, value (per_line: line_id, n_errors, rules)."""
    asst = "" if not require_assistant else """
  UNION ALL SELECT line_id, 'missing_assistant' FROM st
            WHERE stage = 'checked' AND n_msgs > 0 AND line_id NOT IN (SELECT line_id FROM msgs WHERE is_obj AND role = 'assistant')"""
    return f"""
, lines AS (SELECT line_id, value FROM {lines_cte} WHERE {STRIP('value')} <> '')
, pj AS (SELECT line_id, json_valid(value) AS ok, CASE WHEN json_valid(value) THEN value::JSON END AS j FROM lines)
, st AS (
  SELECT line_id, j,
         CASE WHEN NOT ok THEN 'invalid_json' WHEN json_type(j) <> 'OBJECT' THEN 'not_object' ELSE 'checked' END AS stage,
         CASE WHEN json_type(j, '$.messages') = 'ARRAY' THEN json_array_length(j, '$.messages') ELSE 0 END AS n_msgs
  FROM pj)
, msgs0 AS (
  SELECT line_id, unnest(json_extract(j, '$.messages[*]')) AS m
  FROM st WHERE stage = 'checked' AND json_type(j, '$.messages') = 'ARRAY')
, msgs AS (
  SELECT line_id, m, json_type(m) = 'OBJECT' AS is_obj,
         CASE WHEN json_type(m, '$.role') = 'VARCHAR' THEN m ->> '$.role' END AS role,
         CASE WHEN json_type(m, '$.content') = 'VARCHAR' THEN m ->> '$.content' END AS content
  FROM msgs0)
, errs AS (
  SELECT line_id, stage AS rule FROM st WHERE stage IN ('invalid_json', 'not_object')
  UNION ALL SELECT line_id, 'bad_id' FROM st
            WHERE stage = 'checked' AND NOT coalesce(json_type(j, '$.id') = 'VARCHAR' AND {STRIP("(j ->> '$.id')")} <> '', false)
  UNION ALL SELECT line_id, 'bad_messages' FROM st WHERE stage = 'checked' AND n_msgs = 0
  UNION ALL SELECT line_id, 'message_not_object' FROM msgs WHERE NOT is_obj
  UNION ALL SELECT line_id, 'bad_role' FROM msgs WHERE is_obj AND NOT coalesce(role IN ('system', 'user', 'assistant'), false)
  UNION ALL SELECT line_id, 'empty_content' FROM msgs WHERE is_obj AND coalesce({STRIP('content')} = '', true)
  UNION ALL SELECT line_id, 'assistant_json_invalid' FROM msgs
            WHERE is_obj AND role = 'assistant' AND content IS NOT NULL
              AND (starts_with({STRIP('content')}, '{{') OR starts_with({STRIP('content')}, '['))
              AND NOT json_valid(content)
  UNION ALL SELECT line_id, 'missing_user' FROM st
            WHERE stage = 'checked' AND n_msgs > 0 AND line_id NOT IN (SELECT line_id FROM msgs WHERE is_obj AND role = 'user')
  {asst})
, per_line AS (
  SELECT st.line_id, CAST(count(errs.rule) AS BIGINT) AS n_errors,
         coalesce(string_agg(errs.rule, ',' ORDER BY errs.rule), '') AS rules
  FROM st LEFT JOIN errs USING (line_id) GROUP BY st.line_id)
"""


ORACLE["chat_records"] = with_ctes(CHAT) + """
SELECT conv_id, CAST(len(messages) AS BIGINT) AS n_messages, to_json(messages)::VARCHAR AS messages_json FROM chat"""

ORACLE["messages_to_turns"] = """
SELECT conv_id, turn, role, text FROM conversations"""

ORACLE["chat_validate_lines"] = with_ctes(CHAT, RAW_CHAT) + chat_validate_sql("raw_chat") + """
SELECT line_id, n_errors, rules FROM per_line"""

CHAT_RULES = f"""
raw_chat AS (
  SELECT line_id, CASE WHEN d = 6 THEN 'null' ELSE '{{"id": "' || line_id || '", "messages": ' || CASE d
           WHEN 0 THEN '["a text", ' || substring(js, 2) WHEN 1 THEN '[null, ' || substring(js, 2) WHEN 2 THEN '[{{"content": "no role"}}, ' || substring(js, 2)
           WHEN 3 THEN '[{{"role": 7, "content": "x"}}, ' || substring(js, 2) WHEN 4 THEN '[{{"role": "user", "content": 5}}, ' || substring(js, 2)
           WHEN 5 THEN '{{"role": "user", "content": "x"}}' ELSE js END || '}}' END AS value
  FROM (SELECT 'conv-' || conv_id AS line_id, to_json(messages)::VARCHAR AS js, {H("'chatrule'", "'conv-' || conv_id")} % 9 AS d FROM chat))"""
ORACLE["chat_rule_lines"] = with_ctes(CHAT, CHAT_RULES) + chat_validate_sql("raw_chat") + """
SELECT line_id, n_errors, rules FROM per_line"""

ORACLE["chat_validate_summary"] = with_ctes(CHAT, RAW_CHAT) + chat_validate_sql("raw_chat") + """
SELECT CAST(count(*) AS BIGINT) AS n_checked, CAST(count(*) FILTER (WHERE n_errors > 0) AS BIGINT) AS n_failed,
       CAST(sum(n_errors) AS BIGINT) AS n_errors, CASE WHEN sum(n_errors) = 0 THEN 'OK' ELSE 'FAILED' END AS verdict
FROM per_line"""

ORACLE["chat_error_table"] = with_ctes(CHAT, RAW_CHAT) + chat_validate_sql("raw_chat") + """
SELECT rule, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT line_id) AS BIGINT) AS n_lines FROM errs GROUP BY rule"""

PROMPT_ONLY = """
, last_asst AS (SELECT conv_id, max(turn) FILTER (WHERE role = 'assistant') AS la FROM conversations GROUP BY conv_id)
, kept AS (
  SELECT c.conv_id, c.turn, c.role, c.text FROM conversations c JOIN last_asst USING (conv_id)
  WHERE la IS NULL OR c.turn < la)
, po AS (
  SELECT l.conv_id, 'conv-' || l.conv_id AS id,
         coalesce(list({'role': k.role, 'content': k.text} ORDER BY k.turn) FILTER (WHERE k.turn IS NOT NULL), []::STRUCT(role VARCHAR, content VARCHAR)[]) AS messages
  FROM last_asst l LEFT JOIN kept k USING (conv_id) GROUP BY l.conv_id)
"""

ORACLE["prompt_only_records"] = with_ctes(CHAT) + PROMPT_ONLY + """
, po_lines AS (SELECT id AS line_id, to_json({'id': id, 'messages': messages})::VARCHAR AS value, messages FROM po)
""" + chat_validate_sql("po_lines", require_assistant=False) + """
SELECT p.line_id AS id, CAST(len(l.messages) AS BIGINT) AS n_messages, p.n_errors, p.rules
FROM per_line p JOIN po_lines l USING (line_id)"""

CHATML = "'<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)"
ORACLE["chat_render"] = with_ctes(CHAT) + PROMPT_ONLY + f"""
, full_r AS (SELECT conv_id, string_agg({CHATML}, '' ORDER BY turn) AS t FROM conversations GROUP BY conv_id)
, gen_r AS (
  SELECT l.conv_id, coalesce(string_agg({CHATML.replace('role', 'k.role').replace('text', 'k.text')}, '' ORDER BY k.turn), '')
                    || '<|im_start|>assistant' || chr(10) AS t
  FROM last_asst l LEFT JOIN kept k USING (conv_id) GROUP BY l.conv_id)
SELECT f.conv_id, CAST(length(f.t) AS BIGINT) AS n_chars, md5(f.t) AS text_md5,
       CAST(length(g.t) AS BIGINT) AS n_chars_prompt, md5(g.t) AS prompt_md5
FROM full_r f JOIN gen_r g USING (conv_id)"""

SFT_SYS = sql_str(K.SFT_SYSTEM_PROMPT)
CALC_EXPR = "o_custkey || ' * ' || (o_orderkey % 97 + 2)"
ORACLE["sft_records_build"] = f"""
SELECT printf('sft_calc_%03d', o_orderkey) AS id, 'calculator' AS task,
       CAST(o_custkey * (o_orderkey % 97 + 2) AS VARCHAR) AS answer,
       to_json([{{'role': 'system', 'content': {SFT_SYS}}},
                {{'role': 'user', 'content': 'Use a tool to calculate: ' || {CALC_EXPR}}},
                {{'role': 'assistant', 'content': json_object('tool', 'calculator', 'arguments', json_object('expression', {CALC_EXPR}))::VARCHAR}}])::VARCHAR AS messages_json
FROM orders
UNION ALL
SELECT printf('sft_json_%03d', event_id), 'json_validator', NULL,
       to_json([{{'role': 'system', 'content': {SFT_SYS}}},
                {{'role': 'user', 'content': 'Validate whether this text is JSON: ' || props}},
                {{'role': 'assistant', 'content': json_object('tool', 'json_validator', 'arguments', json_object('text', props))::VARCHAR}}])::VARCHAR
FROM events"""

ORACLE["reward_records"] = f"""
SELECT printf('sft_calc_%03d', o_orderkey) AS id, 'Use a tool to calculate: ' || {CALC_EXPR} AS prompt,
       'calculator' AS expected_tool, json_object('expression', {CALC_EXPR})::VARCHAR AS expected_arguments,
       CAST(o_custkey * (o_orderkey % 97 + 2) AS VARCHAR) AS answer
FROM orders
UNION ALL
SELECT printf('sft_json_%03d', event_id), 'Validate whether this text is JSON: ' || props, 'json_validator',
       json_object('text', props)::VARCHAR, NULL
FROM events"""

# --------------------------------------------------------------------- splits
ORACLE["hash_split_pairs"] = PAIR_CTES + f"""
SELECT pair_id, key, CASE WHEN substr(md5('42|' || key), 1, 8) < {VAL_HEX} THEN 'val' ELSE 'train' END AS split
FROM pairs"""

ORACLE["exact_split_chat"] = """
WITH base AS (SELECT DISTINCT 'conv-' || conv_id AS line_id FROM conversations),
o AS (SELECT line_id, md5('42|' || line_id) AS m FROM base),
k AS (SELECT greatest(1, round_even(count(*) * 0.2, 0)) AS k FROM o)
SELECT line_id, CASE WHEN row_number() OVER (ORDER BY m, line_id) <= (SELECT k FROM k) THEN 'val' ELSE 'train' END AS split
FROM o"""

EXACT_PAIRS = PAIR_CTES + """
, o AS (SELECT pair_id, md5('42|' || pair_id) AS m FROM pairs)
, k AS (SELECT greatest(1, floor(count(*) * 0.1)) AS k FROM o)
, s AS (SELECT pair_id, CASE WHEN row_number() OVER (ORDER BY m, pair_id) <= (SELECT k FROM k) THEN 'val' ELSE 'train' END AS split FROM o)
"""
ORACLE["exact_split_pairs"] = EXACT_PAIRS + "SELECT pair_id, split FROM s"

ORACLE["split_check_pairs"] = EXACT_PAIRS + """
SELECT 'n_train' AS metric, CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT) AS value FROM s
UNION ALL SELECT 'n_val', CAST(count(*) FILTER (WHERE split = 'val') AS BIGINT) FROM s
UNION ALL SELECT 'n_overlap_keys', CAST(count(*) AS BIGINT) FROM (
  SELECT pair_id FROM s WHERE split = 'train' INTERSECT SELECT pair_id FROM s WHERE split = 'val')
UNION ALL SELECT 'n_lost', CAST(count(*) AS BIGINT) FROM (SELECT pair_id FROM pairs EXCEPT ALL SELECT pair_id FROM s)
UNION ALL SELECT 'n_extra', CAST(count(*) AS BIGINT) FROM (SELECT pair_id FROM s EXCEPT ALL SELECT pair_id FROM pairs)"""

ORACLE["seeded_shuffle_head"] = PAIR_CTES + """
SELECT pair_id, rejected, CAST(row_number() OVER (ORDER BY md5('42|' || pair_id), pair_id) AS BIGINT) AS pos
FROM pairs ORDER BY md5('42|' || pair_id), pair_id LIMIT 8"""

ORACLE["seeded_shuffle_pairs"] = PAIR_CTES + """
SELECT pair_id, CAST(row_number() OVER (ORDER BY md5('42|' || pair_id), pair_id) AS BIGINT) AS pos FROM pairs"""

ORACLE["contiguous_split_docs"] = """
SELECT doc_id, source,
       CASE WHEN coalesce(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 < 0.9 * sum(n_chars) OVER (PARTITION BY source) THEN 'train' ELSE 'val' END AS split
FROM documents"""

# ------------------------------------------------------------------ evaluation
OUTPUTS = """
outputs AS (
  SELECT m.model, t.key AS prompt_id, t.prompt,
         CASE WHEN (('0x' || substr(md5('42|' || m.model || '|' || t.key), 1, 8))::BIGINT % 10) < m.share
              THEN t.chosen ELSE v.text END AS output,
         t.tool AS expected_tool, t.arguments_json AS expected_arguments, t.answer
  FROM toolcalls t CROSS JOIN (VALUES ('base', 3), ('tuned', 7)) m(model, share)
  JOIN variants v ON v.key = t.key
   AND v.variant = (('0x' || substr(md5('42|' || m.model || '|' || t.key), 9, 8))::BIGINT % 6 + 1)
)"""


def scored_sql(src: str = "outputs") -> str:
    return f"""
scored AS MATERIALIZED (
  SELECT *, CAST(4 * is_valid_json::INT + 2 * has_tool_key::INT + 3 * tool_correct::INT + has_arguments::INT AS DOUBLE) / 10 AS score,
         coalesce(args_j::VARCHAR = json(expected_arguments)::VARCHAR, false) AS args_exact
  FROM (
    SELECT *, j IS NOT NULL AS is_valid_json,
           coalesce(json_type(j) = 'OBJECT' AND json_exists(j, '$.tool'), false) AS has_tool_key,
           coalesce(json_type(j) = 'OBJECT' AND json_type(j, '$.tool') = 'VARCHAR' AND json_extract_string(j, '$.tool') = expected_tool, false) AS tool_correct,
           coalesce(json_type(j) = 'OBJECT' AND json_type(j, '$.arguments') = 'OBJECT' AND len(json_keys(j, '$.arguments')) > 0, false) AS has_arguments,
           CASE WHEN json_type(j) = 'OBJECT' THEN json_extract(j, '$.arguments') END AS args_j
    FROM (SELECT *, CASE WHEN json_valid({STRIP('output')}) THEN {STRIP('output')}::JSON END AS j FROM {src})
  )
)"""


EVAL_CTES = with_ctes(TOOLCALLS, VARIANTS, OUTPUTS, scored_sql())

ORACLE["output_scores"] = EVAL_CTES + """
SELECT model, prompt_id, is_valid_json, has_tool_key, tool_correct, has_arguments, args_exact, score FROM scored"""

MODEL_SUMMARY = f"""
SELECT model, CAST(count(*) AS BIGINT) AS n, round(avg(score), 3) AS mean_score,
       round(avg(is_valid_json::INT), 6) AS format_acc, round(avg(tool_correct::INT), 6) AS tool_acc,
       round(avg(has_arguments::INT), 6) AS has_args_rate, round(avg(args_exact::INT), 6) AS args_acc,
       round(avg((is_valid_json AND tool_correct AND args_exact)::INT), 6) AS overall_acc,
       round(avg(({STRIP('output')} <> '')::INT), 6) AS answer_rate, round(avg(length(output)), 6) AS mean_len
FROM scored GROUP BY model"""
ORACLE["model_summary"] = EVAL_CTES + MODEL_SUMMARY

# one row per prompt by a group-by, no self-join
def _side(model: str, col: str) -> str:
    return f"any_value({col}) FILTER (WHERE model = '{model}')"


_FLAGS = ("is_valid_json", "has_tool_key", "tool_correct", "has_arguments", "score")
COMPARE = f"""
, sides AS (
  SELECT prompt_id, any_value(prompt) AS prompt, any_value(expected_tool) AS expected_tool,
         {", ".join(f"{_side(m, c)} AS {m}_{c}" for m in ("base", "tuned") for c in ("output", *_FLAGS))}
  FROM scored GROUP BY prompt_id HAVING count(*) FILTER (WHERE model = 'base') > 0 AND count(*) FILTER (WHERE model = 'tuned') > 0)
, cmp AS (
  SELECT *, regexp_replace(base_output, '\\s', '', 'g') <> '' AS base_answered, regexp_replace(tuned_output, '\\s', '', 'g') <> '' AS tuned_answered,
         CAST(1 AS BIGINT) AS base_n_outputs, CAST(1 AS BIGINT) AS tuned_n_outputs,
         CAST(round((tuned_score - base_score) * 10) AS BIGINT) AS diff_tenths,
         CASE WHEN tuned_score - base_score > 0 THEN '↑' WHEN tuned_score - base_score < 0 THEN '↓' ELSE '→' END AS direction,
         CASE WHEN base_is_valid_json THEN '✓' ELSE '✗' END AS tick_a,
         CASE WHEN tuned_is_valid_json THEN '✓' ELSE '✗' END AS tick_b
  FROM sides)
"""
ORACLE["model_compare_detail"] = EVAL_CTES + COMPARE + "SELECT * FROM cmp"

ORACLE["model_diff"] = EVAL_CTES + """
, ms AS (SELECT model, round(avg(score), 3) AS m FROM scored GROUP BY model)
, p AS (SELECT max(m) FILTER (WHERE model = 'base') AS base_mean, max(m) FILTER (WHERE model = 'tuned') AS tuned_mean FROM ms)
SELECT base_mean, tuned_mean, round(tuned_mean - base_mean, 3) AS diff,
       CASE WHEN round(tuned_mean - base_mean, 3) > 0 THEN '↑' WHEN round(tuned_mean - base_mean, 3) < 0 THEN '↓' ELSE '→' END AS direction,
       printf('%+.3f', round(tuned_mean - base_mean, 3)) AS diff_text
FROM p"""

ORACLE["win_rate"] = EVAL_CTES + COMPARE + """
SELECT CAST(count(*) AS BIGINT) AS n,
       CAST(count(*) FILTER (WHERE tuned_score - base_score > 0) AS BIGINT) AS n_improved,
       CAST(count(*) FILTER (WHERE tuned_score - base_score < 0) AS BIGINT) AS n_regressed,
       CAST(count(*) FILTER (WHERE tuned_score - base_score = 0) AS BIGINT) AS n_tied,
       round(avg(CASE WHEN tuned_score - base_score > 0 THEN 1.0 ELSE 0.0 END), 6) AS win_rate,
       round(avg(CASE WHEN tuned_score - base_score = 0 THEN 1.0 ELSE 0.0 END), 6) AS tie_rate
FROM cmp"""

ORACLE["improved_regressed"] = EVAL_CTES + COMPARE + """
SELECT prompt_id, substring(prompt, 1, 50) AS prompt_preview, diff_tenths,
       CASE WHEN diff_tenths > 0 THEN 'improved' ELSE 'regressed' END AS kind
FROM cmp WHERE diff_tenths <> 0"""

ORACLE["reward_average"] = EVAL_CTES + """
SELECT model, CAST(count(*) AS BIGINT) AS n, round(avg((tool_correct AND args_exact)::INT), 6) AS avg_reward,
       round(avg(score), 6) AS avg_score
FROM scored GROUP BY model"""

ORACLE["positional_pairing"] = with_ctes(TOOLCALLS, VARIANTS, OUTPUTS) + """
, a AS (SELECT prompt_id, output AS base_output FROM outputs WHERE model = 'base')
, b AS (SELECT prompt_id, output AS tuned_output FROM outputs WHERE model = 'tuned')
SELECT CAST(sum(CASE WHEN base_output IS NOT NULL AND tuned_output IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_matched,
       CAST(sum(CASE WHEN tuned_output IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_only_base,
       CAST(sum(CASE WHEN base_output IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_only_tuned,
       CAST(sum(CASE WHEN base_output = tuned_output THEN 1 ELSE 0 END) AS BIGINT) AS n_same_output
FROM a FULL OUTER JOIN b USING (prompt_id)"""

ORACLE["format_checks"] = with_ctes(TOOLCALLS, VARIANTS, OUTPUTS) + """
, f AS (SELECT model, json_valid(output) AS ok, CASE WHEN json_valid(output) THEN output::JSON END AS j FROM outputs)
SELECT model, round(avg(ok::INT), 6) AS json_rate,
       round(avg(coalesce(json_type(j) = 'OBJECT' AND json_exists(j, '$.tool') AND json_exists(j, '$.arguments'), false)::INT), 6) AS tool_shape_rate,
       round(avg(coalesce(json_type(j) = 'OBJECT' AND json_exists(j, '$.tool_name') AND json_exists(j, '$.arguments'), false)::INT), 6) AS tool_name_shape_rate
FROM f GROUP BY model"""

ORACLE["output_text_stats"] = with_ctes(TOOLCALLS, VARIANTS, OUTPUTS) + """
, w AS (SELECT model, output, list_filter(regexp_split_to_array(lower(output), '\\s+'), lambda x: x <> '') AS words FROM outputs)
, g AS (SELECT model, output, CASE WHEN len(words) >= 3
              THEN list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' ')) ELSE [] END AS grams FROM w)
, per_model AS (
  SELECT model,
         round(avg(CASE WHEN len(grams) > 0 THEN 1 - len(list_distinct(grams)) / len(grams) ELSE 0.0 END), 6) AS mean_repetition,
         round(avg(length(output)), 6) AS mean_len,
         CAST(sum(length(output) - length(replace(output, chr(10), ''))) AS BIGINT) AS n_line_breaks,
         CAST(sum(len(regexp_extract_all(chr(10) || output, '\\n[A-Z][A-Za-z]*:'))) AS BIGINT) AS n_speaker_lines,
         round(avg(CASE WHEN length(output) > 0 THEN length(regexp_replace(output, '[^[:punct:]]', '', 'g')) / length(output) ELSE 0.0 END), 6) AS mean_punct_share
  FROM g GROUP BY model)
, corpus AS (SELECT DISTINCT w FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^\\p{L}]+')) AS w FROM documents) WHERE w <> '')
, ow AS (SELECT model, w FROM (SELECT model, unnest(regexp_split_to_array(lower(output), '[^\\p{L}]+')) AS w FROM outputs) WHERE w <> '')
, shares AS (SELECT model, round(count(*) FILTER (WHERE w IN (SELECT w FROM corpus)) / count(*), 6) AS known_word_share FROM ow GROUP BY model)
SELECT * FROM per_model JOIN shares USING (model)"""

# --------------------------------------------------------------------- tokens
DOC_SPLIT = f"""
docs AS (SELECT *, CASE WHEN substr(md5('42|' || doc_id), 1, 8) < {VAL_HEX} THEN 'val' ELSE 'train' END AS split FROM documents)"""

ORACLE["char_vocab"] = """
WITH c AS (SELECT ch, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(string_split(text, '')) AS ch FROM documents WHERE length(text) > 0) GROUP BY ch)
SELECT ch, n, CAST(row_number() OVER (ORDER BY ch) - 1 AS INTEGER) AS id FROM c"""

ORACLE["encode_decode_roundtrip"] = with_ctes(DOC_SPLIT) + """
, vocab AS (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM docs WHERE split = 'train' AND length(text) > 0)
, toks AS (SELECT doc_id, unnest(string_split(text, '')) AS ch FROM docs WHERE length(text) > 0)
, unk AS (SELECT doc_id, count(*) AS n_unk FROM toks WHERE ch NOT IN (SELECT ch FROM vocab) GROUP BY doc_id)
SELECT split, CAST(count(*) AS BIGINT) AS n_docs,
       CAST(count(*) FILTER (WHERE coalesce(n_unk, 0) = 0) AS BIGINT) AS n_roundtrip_ok,
       CAST(sum(length(text)) AS BIGINT) AS n_tokens, CAST(sum(coalesce(n_unk, 0)) AS BIGINT) AS n_unknown
FROM docs LEFT JOIN unk USING (doc_id) GROUP BY split"""

ORACLE["token_length_stats"] = """
WITH d AS (SELECT lang, length(text) AS n_tok,
                  len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) AS n_words FROM documents)
SELECT lang, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n_tok) AS BIGINT) AS n_tokens, round(avg(n_tok), 6) AS mean_tokens,
       CAST(max(n_tok) AS BIGINT) AS max_tokens, round(quantile_cont(n_tok, 0.5), 6) AS p50_tokens,
       round(quantile_cont(n_tok, 0.9), 6) AS p90_tokens, CAST(sum(n_words) AS BIGINT) AS n_words,
       round(sum(n_tok) / sum(n_words), 6) AS tokens_per_word
FROM d GROUP BY lang"""

ORACLE["overlength_docs"] = """
SELECT lang, CAST(count(*) FILTER (WHERE length(text) > 1024) AS BIGINT) AS n_over,
       CAST(sum(greatest(length(text) - 1024, 0)) AS BIGINT) AS n_lost_tokens
FROM documents GROUP BY lang"""

ORACLE["overlength_chat"] = with_ctes(CHAT) + PROMPT_ONLY + f"""
, full_r AS (SELECT conv_id, sum(length({CHATML})) AS n_full FROM conversations GROUP BY conv_id)
, gen_r AS (SELECT l.conv_id, coalesce(sum(length({CHATML.replace('role', 'k.role').replace('text', 'k.text')})), 0) AS n_prompt
            FROM last_asst l LEFT JOIN kept k USING (conv_id) GROUP BY l.conv_id)
SELECT CAST(count(*) AS BIGINT) AS n_samples,
       CAST(count(*) FILTER (WHERE n_prompt > 512) AS BIGINT) AS n_prompt_over,
       CAST(count(*) FILTER (WHERE n_full > 1024) AS BIGINT) AS n_truncated,
       CAST(count(*) FILTER (WHERE n_full > 1024 AND n_prompt < 1024) AS BIGINT) AS n_answer_cut,
       CAST(count(*) FILTER (WHERE n_prompt >= 1024) AS BIGINT) AS n_answer_lost
FROM full_r JOIN gen_r USING (conv_id)"""

ORACLE["next_token_pairs"] = """
WITH t AS (SELECT doc_id, generate_subscripts(c, 1) AS pos, unnest(c) AS ch
           FROM (SELECT doc_id, string_split(text, '') AS c FROM documents WHERE length(text) > 1)),
p AS (SELECT ch AS cur, lead(ch) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM t)
SELECT cur, nxt, CAST(count(*) AS BIGINT) AS n FROM p WHERE nxt IS NOT NULL GROUP BY cur, nxt"""

ORACLE["context_blocks"] = """
WITH s AS (SELECT doc_id, text, unnest(range(0, length(text), 256)) AS start FROM documents WHERE length(text) > 0)
SELECT doc_id, CAST(start // 256 AS BIGINT) AS block_no, CAST(least(256, length(text) - start) AS BIGINT) AS n_tokens,
       md5(substring(text, start + 1, 256)) AS input_md5, md5(substring(text, start + 2, 256)) AS target_md5
FROM s"""

ORACLE["label_mask"] = f"""
WITH p AS (SELECT conv_id, role, {CHATML} AS piece FROM conversations),
t AS (SELECT conv_id, role, unnest(string_split(piece, '')) AS ch FROM p)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_tokens,
       CAST(count(*) FILTER (WHERE role = 'assistant') AS BIGINT) AS n_label_tokens,
       CAST(coalesce(sum(unicode(ch)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS sum_label_ids,
       true AS lengths_equal
FROM t GROUP BY conv_id"""

CHAT_LENGTHS = f"""
lens AS (SELECT conv_id, {H("'conv-' || conv_id")} % 4 AS bucket, CAST(sum(length({CHATML})) AS BIGINT) AS n_tok
         FROM conversations GROUP BY conv_id)"""

ORACLE["padding_batches"] = with_ctes(CHAT_LENGTHS) + """
, r AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY n_tok, conv_id) AS rn FROM lens)
, b AS (SELECT bucket, CAST(floor((rn - 1) / 8) AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS n_samples,
               CAST(max(n_tok) AS BIGINT) AS max_len, CAST(sum(n_tok) AS BIGINT) AS sum_len FROM r GROUP BY 1, 2)
SELECT *, n_samples * max_len - sum_len AS n_pad, round((n_samples * max_len - sum_len) / (n_samples * max_len), 6) AS pad_share FROM b"""

ORACLE["batch_plan"] = with_ctes(CHAT_LENGTHS) + """
SELECT CAST(count(*) AS BIGINT) AS n_samples, CAST(8 AS BIGINT) AS effective_batch,
       CAST(ceil(count(*) / 8) AS BIGINT) AS steps_per_epoch FROM lens"""

ORACLE["packing"] = f"""
WITH d AS (SELECT doc_id, {H('doc_id')} % 8 AS bucket, n_chars AS n_tok FROM documents),
c AS (SELECT *, coalesce(sum(n_tok) OVER (PARTITION BY bucket ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d),
p AS (
  SELECT *, unnest(range(CAST(floor(before / 4096) AS BIGINT), CAST(floor((before + n_tok - 1) / 4096) AS BIGINT) + 1)) AS pack_id FROM c WHERE n_tok > 0)
SELECT bucket, pack_id, CAST(count(*) AS BIGINT) AS n_docs,
       CAST(count(*) FILTER (WHERE pack_id = CAST(floor(before / 4096) AS BIGINT)) AS BIGINT) AS n_docs_starting,
       CAST(sum(least(before + n_tok, (pack_id + 1) * 4096) - greatest(before, pack_id * 4096)) AS BIGINT) AS n_tokens
FROM p GROUP BY 1, 2"""

# BPE: words as strings of symbols between two marks, one CTE for each round (as many as the query learns)
BPE_ROUNDS = 10
SPACES = r"' \t\n\x0B\f\r'"[1:-1]
_ESC = "replace(replace(replace(w, chr(3), chr(3) || 'c'), chr(1), chr(3) || 'a'), chr(2), chr(3) || 'b')"
_SYMS = "string_split(substring(sym, 2, length(sym) - 2), chr(2) || chr(1))"


def bpe_ctes(rounds: int = BPE_ROUNDS) -> str:
    ctes = [rf"""doc_words AS MATERIALIZED (
  SELECT lang, w, count(*) AS freq FROM (SELECT lang, unnest(regexp_extract_all(text, '[^{SPACES}]{{1,256}}')) AS w FROM documents) GROUP BY lang, w)""",
            rf"""s0 AS MATERIALIZED (
  SELECT w, sum(freq) AS freq, regexp_replace({_ESC}, '(?s)(\x03?.)', chr(1) || '\1' || chr(2), 'g') AS sym FROM doc_words GROUP BY w)"""]
    for r in range(rounds):
        ctes.append(f"""b{r + 1} AS MATERIALIZED (
  SELECT p[1] AS a, p[2] AS b, n FROM (
    SELECT p, sum(freq) AS n FROM (
      SELECT freq, unnest(list_transform(range(1, len(x)), lambda i: [x[i], x[i + 1]])) AS p FROM (SELECT freq, {_SYMS} AS x FROM s{r})) GROUP BY p)
  ORDER BY n DESC, chr(1) || p[1] || chr(2) || chr(1) || p[2] || chr(2) LIMIT 1)""")
        ctes.append(f"""s{r + 1} AS MATERIALIZED (
  SELECT w, freq, coalesce(replace(sym, chr(1) || a || chr(2) || chr(1) || b || chr(2), chr(1) || a || b || chr(2)), sym) AS sym FROM s{r} LEFT JOIN b{r + 1} ON true)""")
    return ", ".join(ctes)


def _plain(x: str) -> str:
    return f"replace(replace(replace({x}, chr(3) || 'b', chr(2)), chr(3) || 'a', chr(1)), chr(3) || 'c', chr(3))"


MERGES = "merges AS (" + " UNION ALL ".join(
    f"SELECT {r} AS rank, {_plain('a')} AS a, {_plain('b')} AS b, CAST(n AS BIGINT) AS count FROM b{r}" for r in range(1, BPE_ROUNDS + 1)) + ")"
ORACLE["bpe_merges"] = f"WITH {bpe_ctes()}, {MERGES} SELECT rank, a, b, a || b AS merged, count FROM merges"

# what a word comes to: its symbols after the last round, their ids after the characters' ids
BPE_WORDS = f"""{bpe_ctes()}, {MERGES}
, vocab AS (SELECT ch, row_number() OVER (ORDER BY ch) - 1 AS id FROM (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM documents WHERE length(text) > 0))
, n_vocab AS (SELECT count(*) AS v FROM vocab)
, known AS (
  SELECT ch AS tok, id FROM vocab
  UNION ALL SELECT a || b, min(rank) - 1 + any_value(v) FROM merges, n_vocab GROUP BY a || b)
, word_toks AS (
  SELECT w, count(*) AS n_tokens, count(*) FILTER (WHERE id >= v) AS n_merged, sum(id) AS sum_ids
  FROM (SELECT w, unnest(list_transform({_SYMS}, lambda x: {_plain('x')})) AS tok FROM s{BPE_ROUNDS}) JOIN known USING (tok), n_vocab GROUP BY w)
, lang_words AS (
  SELECT lang, sum(freq * n_tokens) AS n_tokens, sum(freq * n_merged) AS n_merged, sum(freq * sum_ids) AS sum_ids FROM doc_words JOIN word_toks USING (w) GROUP BY lang)
, lang_space AS (
  SELECT lang, count(*) AS n_tokens, sum(id) AS sum_ids
  FROM (SELECT lang, unnest(regexp_extract_all(text, '[{SPACES}]')) AS ch FROM documents) JOIN vocab USING (ch) GROUP BY lang)
"""
ORACLE["bpe_encode_stats"] = f"""WITH {BPE_WORDS}
SELECT d.lang, CAST(d.n_docs AS BIGINT) AS n_docs, CAST(coalesce(w.n_tokens, 0) + coalesce(s.n_tokens, 0) AS BIGINT) AS n_tokens,
       CAST(coalesce(n_merged, 0) AS BIGINT) AS n_merged_tokens, CAST(coalesce(w.sum_ids, 0) + coalesce(s.sum_ids, 0) AS BIGINT) AS sum_ids,
       CAST(d.n_docs AS BIGINT) AS n_roundtrip_ok
FROM (SELECT lang, count(*) AS n_docs FROM documents GROUP BY lang) d
LEFT JOIN lang_words w ON d.lang IS NOT DISTINCT FROM w.lang LEFT JOIN lang_space s ON d.lang IS NOT DISTINCT FROM s.lang"""

ORACLE["token_counts_by_tokenizer"] = f"""WITH {BPE_WORDS}
, doc_bpe AS (
  SELECT rid, lang, text, len(regexp_extract_all(text, '[{SPACES}]')) + coalesce(sum(n_tokens), 0) AS n
  FROM (SELECT rid, lang, text, unnest(CASE WHEN len(ws) > 0 THEN ws ELSE [NULL] END) AS w
        FROM (SELECT row_number() OVER () AS rid, lang, text, regexp_extract_all(text, '[^{SPACES}]{{1,256}}') AS ws FROM documents))
  LEFT JOIN word_toks USING (w) GROUP BY rid, lang, text)
, per AS (
  SELECT lang, octet_length(encode(text)) AS byte, length(text) AS char, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) AS word, n AS bpe FROM doc_bpe)
, long AS (
  SELECT lang, unnest(['byte', 'char', 'word', 'bpe']) AS tokenizer, unnest([coalesce(byte, 0), coalesce(char, 0), coalesce(word, 0), coalesce(bpe, 0)]) AS n FROM per)
, g AS (SELECT lang, tokenizer, count(*) AS n_docs, sum(n) AS n, max(n) AS most FROM long GROUP BY lang, tokenizer)
SELECT lang, tokenizer, CAST(n_docs AS BIGINT) AS n_docs, CAST(n AS BIGINT) AS n_tokens, CAST(most AS BIGINT) AS max_tokens,
       round(n / n_docs, 6) AS mean_tokens,
       round(n / nullif(max(n) FILTER (WHERE tokenizer = 'word') OVER (PARTITION BY lang), 0), 6) AS tokens_per_word,
       round(max(n) FILTER (WHERE tokenizer = 'char') OVER (PARTITION BY lang) / nullif(n, 0), 6) AS chars_per_token
FROM g"""

ORACLE["packed_sequences"] = f"""
WITH vocab AS (SELECT ch, row_number() OVER (ORDER BY ch) - 1 AS id FROM (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM documents WHERE length(text) > 0)),
t AS (SELECT bucket, doc_id, generate_subscripts(c, 1) AS i, unnest(c) AS ch FROM (
  SELECT {H('doc_id')} % 8 AS bucket, doc_id, string_split(text, '') AS c FROM documents WHERE length(text) > 0)),
p AS (SELECT bucket, doc_id, id, row_number() OVER (PARTITION BY bucket ORDER BY doc_id, i) - 1 AS gp FROM t JOIN vocab USING (ch)),
q AS (SELECT *, gp // 4096 AS pack_id, row_number() OVER (PARTITION BY bucket, gp // 4096, doc_id ORDER BY gp) - 1 AS pos,
             dense_rank() OVER (PARTITION BY bucket, gp // 4096 ORDER BY doc_id) AS seg FROM p)
SELECT bucket, CAST(pack_id AS BIGINT) AS pack_id, CAST(count(*) AS BIGINT) AS n_tokens, CAST(max(seg) AS BIGINT) AS n_segments,
       md5(string_agg(id, ',' ORDER BY gp)) AS input_ids_md5, md5(string_agg(seg, ',' ORDER BY gp)) AS segment_ids_md5, md5(string_agg(pos, ',' ORDER BY gp)) AS position_ids_md5
FROM q GROUP BY bucket, pack_id"""

ORACLE["truncated_chat"] = f"""
WITH p AS (SELECT conv_id, turn, role, {CHATML} AS piece FROM conversations),
o AS (SELECT *, sum(length(piece)) OVER (PARTITION BY conv_id ORDER BY turn) AS b, sum(length(piece)) OVER (PARTITION BY conv_id ORDER BY turn) - length(piece) AS a FROM p),
c AS (SELECT conv_id, max(b) AS n, arg_max(a, turn) FILTER (WHERE role = 'assistant') AS aa, arg_max(b, turn) FILTER (WHERE role = 'assistant') AS ab,
             string_agg(piece, '' ORDER BY turn) AS whole FROM o GROUP BY conv_id),
w AS (SELECT *, CASE WHEN n <= 512 OR coalesce(ab, -1) <= 512 THEN 0 WHEN ab - aa > 512 THEN aa ELSE ab - 512 END AS cut FROM c),
l AS (SELECT conv_id, role, b - a AS n_tok, greatest(least(b, cut + 512) - greatest(a, cut), 0) AS kept FROM o JOIN w USING (conv_id)),
r AS (SELECT conv_id, sum(n_tok - kept) FILTER (WHERE role = 'system') AS s, sum(n_tok - kept) FILTER (WHERE role = 'user') AS u,
             sum(n_tok - kept) FILTER (WHERE role = 'assistant') AS x, sum(kept) FILTER (WHERE role = 'assistant') AS lab FROM l GROUP BY conv_id)
SELECT conv_id, CAST(n AS BIGINT) AS n_tokens, CAST(cut AS BIGINT) AS cut_start, CAST(least(n - cut, 512) AS BIGINT) AS n_kept,
       md5(array_to_string(list_transform(string_split(substring(whole, CAST(cut AS BIGINT) + 1, 512), ''), lambda ch: unicode(ch)), ',')) AS ids_md5,
       CAST(coalesce(lab, 0) AS BIGINT) AS n_label_tokens, aa >= cut AND ab <= cut + 512 AS answer_kept,
       CAST(coalesce(s, 0) AS BIGINT) AS lost_system, CAST(coalesce(u, 0) AS BIGINT) AS lost_user, CAST(coalesce(x, 0) AS BIGINT) AS lost_assistant
FROM w JOIN r USING (conv_id)"""

# ----------------------------------------------------------------------- runs
RUNLOG = """
runlog AS (
  SELECT event_type AS run_id, CASE WHEN event_id % 2 = 0 THEN 'train' ELSE 'val' END AS split,
         CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS BIGINT) AS step,
         value AS loss, CAST(event_id % 50 + 440 AS DOUBLE) AS ms, event_id
  FROM events)"""

RUN_PARAMS = f"""
params AS (
  SELECT run_id, 'ptloom-run' AS model, CAST({H('run_id')} % 5 + 1 AS DOUBLE) / 10 AS beta,
         CAST({H('run_id')} % 3 + 1 AS DOUBLE) * CAST(0.00001 AS DOUBLE) AS lr
  FROM (SELECT DISTINCT run_id FROM runlog))"""

ORACLE["loss_table"] = with_ctes(RUNLOG) + """
, g AS (
  SELECT run_id,
         arg_min(loss, step) FILTER (WHERE split = 'train') AS first_train, arg_max(loss, step) FILTER (WHERE split = 'train') AS last_train,
         arg_min(loss, step) FILTER (WHERE split = 'val') AS first_val, arg_max(loss, step) FILTER (WHERE split = 'val') AS last_val,
         min(loss) FILTER (WHERE split = 'val') AS best_val
  FROM runlog GROUP BY run_id)
SELECT run_id, round(first_train, 6) AS first_train, round(last_train, 6) AS last_train, round(first_val, 6) AS first_val,
       round(last_val, 6) AS last_val, round(best_val, 6) AS best_val, round(first_train - last_train, 6) AS total_drop,
       round(last_val - last_train, 6) AS final_gap
FROM g"""

ORACLE["experiment_summary"] = with_ctes(RUNLOG, RUN_PARAMS) + """
, g AS (SELECT run_id, CAST(count(*) AS BIGINT) AS n_rows, CAST(max(step) AS BIGINT) AS steps,
               round(arg_min(loss, step), 6) AS loss_first, round(arg_max(loss, step), 6) AS loss_last FROM runlog GROUP BY run_id)
SELECT run_id, model, beta, lr, n_rows, steps, loss_first, loss_last FROM g JOIN params USING (run_id)"""

ORACLE["sweep_pivot"] = with_ctes(RUNLOG, RUN_PARAMS) + """
SELECT beta, round(avg(loss) FILTER (WHERE split = 'train'), 6) AS train, round(avg(loss) FILTER (WHERE split = 'val'), 6) AS val
FROM runlog JOIN params USING (run_id) GROUP BY beta"""

GPU_LOG = """
gpu_log AS (
  SELECT event_type AS stage, 'gpu-' || (user_id % 3) AS gpu, CAST(user_id % 8 + 1 AS DOUBLE) AS hours,
         CAST(event_id % 5 + 1 AS DOUBLE) AS price FROM events)"""

ORACLE["gpu_cost_rollup"] = with_ctes(GPU_LOG) + """
SELECT stage, gpu, sum(hours) AS hours, sum(hours * price) AS cost, CAST(count(*) AS BIGINT) AS n
FROM gpu_log GROUP BY ROLLUP (stage, gpu)"""

ORACLE["step_time_summary"] = with_ctes(RUNLOG) + """
, g AS (
  SELECT run_id, round(avg(ms) FILTER (WHERE split = 'train'), 6) AS train_ms_mean,
         min(ms) FILTER (WHERE split = 'train') AS train_ms_min, max(ms) FILTER (WHERE split = 'train') AS train_ms_max,
         round(quantile_cont(ms, 0.5) FILTER (WHERE split = 'train'), 6) AS train_ms_p50,
         round(avg(ms) FILTER (WHERE split <> 'train'), 6) AS eval_ms_mean,
         CAST(count(*) FILTER (WHERE split <> 'train') AS BIGINT) AS n_eval
  FROM runlog GROUP BY run_id)
SELECT *, round(train_ms_mean - avg(train_ms_mean) OVER (), 6) AS train_ms_vs_mean FROM g"""

ORACLE["run_alignment"] = with_ctes(RUNLOG) + """
, t AS (SELECT run_id, step, loss, split, step / max(step) OVER (PARTITION BY run_id) AS progress FROM runlog)
, a AS (SELECT * FROM t WHERE split = 'train' AND run_id <> 'click')
, b AS (SELECT * FROM t WHERE split = 'train' AND run_id = 'click')
SELECT a.run_id, a.step, round(a.progress, 6) AS progress, round(a.loss, 6) AS loss, b.step AS base_step, round(b.loss, 6) AS base_loss,
       round(a.loss - b.loss, 6) AS change, b.step IS NOT NULL AS matched
FROM a ASOF LEFT JOIN b ON a.progress >= b.progress"""

LOSS_DELTAS = """
, o AS (SELECT run_id, split, step, loss, row_number() OVER (PARTITION BY run_id, split ORDER BY step) AS ord FROM runlog)
, deltas AS (
  SELECT run_id, split, CAST(ord AS BIGINT) AS ord, step, round(loss, 6) AS loss,
         round(loss - lag(loss) OVER (PARTITION BY run_id, split ORDER BY ord), 6) AS delta,
         coalesce(loss < min(loss) OVER (PARTITION BY run_id, split ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS new_best
  FROM o)
"""
ORACLE["loss_deltas"] = with_ctes(RUNLOG) + LOSS_DELTAS + "SELECT * FROM deltas"

ORACLE["overfit_flags"] = with_ctes(RUNLOG) + LOSS_DELTAS + """
SELECT t.run_id, CAST(count(*) AS BIGINT) AS n_aligned,
       CAST(count(*) FILTER (WHERE t.delta < 0 AND v.delta > 0) AS BIGINT) AS n_overfit
FROM deltas t JOIN deltas v ON t.run_id = v.run_id AND t.ord = v.ord AND t.split = 'train' AND v.split = 'val'
GROUP BY t.run_id"""

ORACLE["eval_interval_sample"] = with_ctes(RUNLOG) + """
SELECT run_id, split, step, loss FROM runlog WHERE step % 100 = 0"""

ORACLE["dataset_card"] = PAIR_CTES + f"""
SELECT CASE WHEN substr(md5('42|' || key), 1, 8) < {VAL_HEX} THEN 'preference_val.jsonl' ELSE 'preference_train.jsonl' END AS file,
       CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT tool) AS BIGINT) AS n_tools,
       CAST(count(DISTINCT {CLASSIFY('rejected')}) AS BIGINT) AS n_types
FROM pairs GROUP BY 1"""

ORACLE["examples_per_task"] = with_ctes(TOOLCALLS, VARIANTS, PAIRS) + """
SELECT 'calculator' AS name, CAST(count(*) AS BIGINT) AS n, 'task' AS kind FROM orders
UNION ALL SELECT 'json_validator', CAST(count(*) AS BIGINT), 'task' FROM events
UNION ALL SELECT tool, CAST(count(*) AS BIGINT), 'tool' FROM pairs GROUP BY tool"""

# ---------------------------------------------------------------------- align
ORACLE["dpo_loss"] = """
WITH lp AS (SELECT label, -abs(CAST(embedding[1] AS DOUBLE)) AS pc, -abs(CAST(embedding[2] AS DOUBLE)) AS pr,
                   -abs(CAST(embedding[3] AS DOUBLE)) AS rc, -abs(CAST(embedding[4] AS DOUBLE)) AS rr FROM embeddings),
t AS (SELECT label, 0.1 * (pc - rc) AS rwc, 0.1 * (pr - rr) AS rwr FROM lp),
m AS (SELECT *, rwc - rwr AS margin FROM t)
SELECT label, CAST(count(*) AS BIGINT) AS n,
       round(avg(greatest(-margin, 0.0) + ln(1 + exp(-abs(margin)))), 6) AS mean_loss,
       round(avg(rwc), 6) AS mean_reward_chosen, round(avg(rwr), 6) AS mean_reward_rejected,
       round(avg(margin), 6) AS mean_margin, round(avg(CASE WHEN rwc > rwr THEN 1.0 ELSE 0.0 END), 6) AS reward_accuracy
FROM m GROUP BY label"""

ORACLE["token_cross_entropy"] = with_ctes(DOC_SPLIT) + """
, counts AS (SELECT split, ch, count(*) AS n FROM (SELECT split, unnest(string_split(text, '')) AS ch FROM docs WHERE length(text) > 0) GROUP BY 1, 2)
, model AS (SELECT ch, -ln(n / sum(n) OVER ()) AS nll FROM counts WHERE split = 'train')
, per AS (
  SELECT split, sum(n * nll) FILTER (WHERE nll IS NOT NULL) / sum(n) FILTER (WHERE nll IS NOT NULL) AS ce,
         CAST(coalesce(sum(n) FILTER (WHERE nll IS NULL), 0) AS BIGINT) AS n_unseen, CAST(sum(n) AS BIGINT) AS n_tokens
  FROM counts LEFT JOIN model USING (ch) GROUP BY split)
SELECT split, round(ce, 6) AS cross_entropy, round(exp(ce), 6) AS perplexity, n_tokens, n_unseen FROM per"""

ORACLE["temperature_topk"] = """
WITH c AS (SELECT doc_id AS prompt, ch AS token, count(*) AS n
           FROM (SELECT doc_id, unnest(string_split(text, '')) AS ch FROM documents WHERE length(text) > 0) GROUP BY 1, 2),
l AS (SELECT *, ln(CAST(n AS DOUBLE)) AS logit FROM c),
z AS (SELECT *, exp((logit - max(logit) OVER (PARTITION BY prompt)) / 0.7) AS z FROM l),
p AS (SELECT *, z / sum(z) OVER (PARTITION BY prompt) AS prob FROM z),
r AS (SELECT *, row_number() OVER (PARTITION BY prompt ORDER BY prob DESC, token) AS rank FROM p)
SELECT prompt, token, CAST(rank AS BIGINT) AS rank, round(prob, 6) AS prob FROM r WHERE rank <= 5"""

# -------------------------------------------------------------- scans / sinks
ORACLE["jsonl_roundtrip"] = ORACLE["pref_file_summary"]
ORACLE["training_curve_csv"] = ORACLE["loss_table"]
ORACLE["model_outputs_jsonl"] = ORACLE["model_summary"]

ORACLE["token_shards"] = with_ctes(DOC_SPLIT) + """
, toks AS (SELECT split, unnest(string_split(text, '')) AS ch FROM docs WHERE length(text) > 0)
, vocab AS (SELECT ch, row_number() OVER (ORDER BY ch) - 1 AS id FROM (SELECT DISTINCT ch FROM toks))
SELECT d.split, CAST(d.n_docs AS BIGINT) AS n_docs, CAST(coalesce(t.n_tokens, 0) AS BIGINT) AS n_tokens,
       CAST(coalesce(t.sum_ids, 0) AS BIGINT) AS sum_ids
FROM (SELECT split, count(*) AS n_docs FROM docs GROUP BY split) d
LEFT JOIN (SELECT split, count(*) AS n_tokens, sum(id) AS sum_ids FROM toks JOIN vocab USING (ch) GROUP BY split) t USING (split)"""
