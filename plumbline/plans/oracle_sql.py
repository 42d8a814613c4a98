"""The queries of the catalogue as DuckDB SQL.

The rules are stated on their own here: other regular expressions, lists and
joins, and plain windows where the Spark side works in levels.
"""

from __future__ import annotations

import re

from plumbline.functions.text import WS_CHARS
from plumbline.plans import derived
from plumbline.plans.catalog import BLOCK, MAX_COMPLETION, MAX_PROMPT, SAMPLE, TEMPLATE


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _strip(x: str) -> str:
    return f"trim({x}, {_lit(WS_CHARS)})"


def _hash(x: str) -> str:
    return f"('0x'||substr(md5({x}),1,8))::BIGINT"


def _case(selector: str, values: list[str], default: str) -> str:
    arms = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE {selector} {arms} ELSE {default} END"


def _lits(values) -> list[str]:
    return [_lit(v) for v in values]


# White space, leading junk and quotes that cleaning takes off.
_QUOTES = "`\"' \n\t"
_WS = r"[\t\n\x{0b}\f\r\x{1c}-\x{1f}\x{85}\p{Z}]"
_IN_CLASS = _WS[1:-1]
_JUNK = (
    rf"(?i)^(?:[{_IN_CLASS}\x{{feff}}\x{{fffd}}]+|(?:\x{{1f310}}{_WS}*)?assistant{_WS}*:"
    rf"|im_assistant{_WS}*:|limelight{_WS}*:|em\p{{Nd}}+\.)+"
)


def _clean(x: str) -> str:
    t = f"regexp_replace(coalesce({x},''), {_lit(_JUNK)}, '')"
    t = f"ltrim({t}, {_lit(_QUOTES)})"
    t = f"regexp_replace({t}, '\\r\\n?', chr(10), 'g')"
    return _strip(t)


def _words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{_WS}+'), lambda w: w <> '')"


def _lines(x: str) -> str:
    stripped = _strip("l")
    return (
        f"list_filter(list_transform(string_split({x}, chr(10)), lambda l: {stripped}), lambda l: l <> '')"
    )


def _bullets(x: str) -> str:
    rule = rf"^(?:[-*•]|\p{{Nd}}+[.)]|[A-Za-z][.)]){_WS}+"
    return f"len(list_filter({_lines(x)}, lambda l: regexp_matches(l, {_lit(rule)})))::BIGINT"


def _dashed(x: str, prefix: str = "- ") -> str:
    return f"len(list_filter({_lines(x)}, lambda l: starts_with(l, {_lit(prefix)})))::BIGINT"


def _candidate(x: str) -> str:
    fence = rf"(?is)```(?:json)?{_WS}*(.*?){_WS}*```"
    return (
        f"CASE WHEN regexp_matches({x}, {_lit(fence)}) THEN {_strip(f'regexp_extract({x}, {_lit(fence)}, 1)')} "
        f"WHEN regexp_matches({x}, '(?s)\\{{.*\\}}') THEN regexp_extract({x}, '(?s)\\{{.*\\}}') "
        f"WHEN regexp_matches({x}, '(?s)\\[.*\\]') THEN regexp_extract({x}, '(?s)\\[.*\\]') END"
    )


_PY_TYPE = (
    "CASE json_type(candidate) WHEN 'OBJECT' THEN 'dict' WHEN 'ARRAY' THEN 'list' "
    "WHEN 'VARCHAR' THEN 'str' WHEN 'BOOLEAN' THEN 'bool' WHEN 'NULL' THEN 'NoneType' "
    "WHEN 'DOUBLE' THEN 'float' ELSE 'int' END"
)


def _number(patterns: list[str]) -> str:
    tries = ", ".join(
        f"try_cast(nullif(regexp_extract(prompt, {_lit(p)}, 1), '') AS BIGINT)" for p in patterns
    )
    return f"coalesce({tries})"


_N_BULLETS = _number(
    [
        rf"(?i)\bexactly{_WS}+([0-9]+){_WS}+bullets?\b",
        rf"(?i)\bin{_WS}+([0-9]+){_WS}+bullets?\b",
    ]
)
_N_QUESTIONS = _number(
    [
        rf"(?i)\bask(?:{_WS}+me)?{_WS}+([0-9]+){_WS}+questions?\b",
        rf"(?i)\bfirst{_WS}+([0-9]+){_WS}+questions?\b",
    ]
)
_JSON_ONLY = f"regexp_matches(prompt, '(?i)\\breturn{_WS}+only{_WS}+valid{_WS}+json\\b')"
_ENUM = rf'\b([A-Za-z_][A-Za-z0-9_]*)\b{_WS}*:{_WS}*("[^"]+"(?:{_WS}*\|{_WS}*"[^"]+")+)'

# Doubling of quotes keeps literal texts intact inside SQL.
_TICKET_KEYS = "['intent','urgency']"

# Named subqueries; each is pulled in where its name appears.
_CTE: dict[str, str] = {}

_CTE["pref_pairs"] = f"""
SELECT pair_id, conv_id*1048576+turn AS ord, CASE WHEN h % 10 = 0 THEN 'test' ELSE 'train' END AS split,
  prompt, chosen,
  CASE WHEN h % 11 = 0 THEN chosen
       ELSE coalesce(other, substr(chosen, 1, (length(chosen)//2)::INTEGER)) END AS rejected, h
FROM (SELECT u.conv_id, u.turn, u.text AS prompt, a.text AS chosen, o.text AS other,
        u.conv_id || '-' || u.turn AS pair_id, {_hash("u.conv_id || '-' || u.turn")} AS h
      FROM conversations u
      JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
      LEFT JOIN conversations o
        ON o.conv_id = u.conv_id + 1 AND o.turn = u.turn + 1 AND o.role = 'assistant'
      WHERE u.role = 'user')
"""


def _padded(x: str) -> str:
    return (
        f"CASE h % 5 WHEN 0 THEN chr(160) || {x} || chr(10) || chr(12288) "
        f"WHEN 1 THEN chr(28) || ' ' || {x} || chr(133) || ' ' ELSE {x} END"
    )


_CTE["pref_texts"] = f"""
SELECT pair_id, ord, split, h, {_padded('prompt')} AS prompt, {_padded('chosen')} AS chosen,
  {_padded('rejected')} AS rejected FROM pref_pairs
"""

_CTE["prompts"] = f"""
SELECT 'p' || doc_id AS id, doc_id AS ord, doc_id % 6 AS k,
  CASE WHEN toxic = 1 THEN 'safety_harm' WHEN toxic IS NOT NULL THEN 'general' END AS category,
  {_case('doc_id % 6', _lits(derived.RULES), "''")} || chr(10) || chr(10) || text AS prompt, text
FROM documents LEFT JOIN labels USING (doc_id)
"""

_CTE["declared"] = """
SELECT id, 1 AS idx, 'exact_bullets' AS type, 3 AS n, '- ' AS prefix, NULL AS sch_type FROM prompts WHERE k = 0
UNION ALL SELECT id, 1, 'exact_bullets', 2, NULL, NULL FROM prompts WHERE k = 1
UNION ALL SELECT id, 2, 'first_n_lines_questions', 1, NULL, NULL FROM prompts WHERE k = 1
UNION ALL SELECT id, 1, 'first_n_lines_questions', 2, NULL, NULL FROM prompts WHERE k = 2
UNION ALL SELECT id, 1, 'json_schema', NULL, NULL, 'object' FROM prompts WHERE k = 3
UNION ALL SELECT id, 1, 'max_words', 50, NULL, NULL FROM prompts WHERE k = 4
UNION ALL SELECT id, 2, 'json_schema', NULL, NULL, NULL FROM prompts WHERE k = 4
"""


def _raw() -> str:
    v = "(h >> 10) % 8"
    lf = "chr(10)"
    body = lambda values: _case(v, _lits(values), "''")
    ticket = "(" + body(derived.TICKET_BODIES) + ")"
    dress = _case(
        "(h >> 15) % 4",
        [
            ticket,
            f"text || {_lit(chr(10) + '```json' + chr(10))} || {ticket} || {_lit(chr(10) + '```')}",
            f"text || {lf} || {ticket}",
        ],
        f"{_lit('```JSON' + chr(10))} || {ticket} || {_lit(chr(10) + '```' + chr(10) + 'Done. ```x```')}",
    )
    kinds = [
        f"({body(derived.BULLET_BODIES)}) || {lf} || {lf} || text",
        f"({body(derived.MIXED_BODIES)}) || CASE WHEN {v} = 7 THEN '' ELSE {lf} || text END",
        f"({body(derived.QUESTION_BODIES)}) || CASE WHEN {v} IN (2, 7) THEN '' ELSE {lf} || text END",
        dress,
        f"CASE WHEN {v} < 5 THEN text || {lf} ELSE '' END || ({body(derived.TOPIC_BODIES)})",
    ]
    junk = _case("(h >> 5) % 9", _lits(derived.JUNK), "''")
    return f"CASE WHEN h % 17 <> 0 THEN ({junk}) || ({_case('k', kinds, 'text')}) END"


_CTE["generations"] = f"""
SELECT id, ord, model, variant, {_raw()} AS raw
FROM (SELECT id, ord, k, text, model, variant, {_hash('id || model || variant')} AS h
      FROM prompts, (SELECT unnest(['base','sft','dpo']) AS model), (SELECT unnest(['det','samp']) AS variant))
"""
_CTE["cleaned_all"] = f"SELECT id, model, variant, {_clean('raw')} AS cleaned FROM generations"
_CTE["cleaned"] = f"""
SELECT id, model, variant, {_clean('raw')} AS cleaned FROM generations WHERE raw IS NOT NULL
"""
_CTE["kept_prompts"] = "SELECT * FROM prompts WHERE category IS NULL OR category <> 'safety_harm'"
_CTE["answers"] = f"""
SELECT g.id, model, variant, raw, {_clean('raw')} AS cleaned
FROM generations g JOIN kept_prompts USING (id) WHERE raw IS NOT NULL
"""
_CTE["candidates"] = f"SELECT id, model, variant, {_candidate('cleaned')} AS candidate FROM cleaned"
_CTE["parsed"] = """
SELECT id, model, variant, candidate, coalesce(candidate <> '' AND json_valid(candidate), false) AS ok
FROM candidates
"""
_CTE["members"] = """
SELECT id, model, variant, key, arg_max(type, place) AS type, arg_max(value, place) AS value
FROM (SELECT p.id, p.model, p.variant, e.key, e.type, e.value, e.id AS place
      FROM (SELECT * FROM parsed WHERE ok AND json_type(candidate) = 'OBJECT') p, json_each(p.candidate) e)
GROUP BY ALL
"""
_CTE["objects"] = """
SELECT id, model, variant FROM parsed WHERE ok AND json_type(candidate) = 'OBJECT'
"""
_CTE["shown_keys"] = r"""
SELECT id, key, min(place) AS place
FROM (SELECT id, unnest(ks) AS key, unnest(range(len(ks))) AS place
      FROM (SELECT id, regexp_extract_all(prompt, '"([A-Za-z_][A-Za-z0-9_]*)"\s*:', 1) AS ks FROM prompts))
GROUP BY ALL
"""
_CTE["shown_enums"] = f"""
SELECT id, key, arg_max(allowed, place) AS allowed
FROM (SELECT id, unnest(ks) AS key, unnest(vs) AS raw, unnest(range(len(ks))) AS place,
        regexp_extract_all(raw, '"([^"]+)"', 1) AS allowed
      FROM (SELECT id, regexp_extract_all(prompt, {_lit(_ENUM)}, 1) AS ks,
              regexp_extract_all(prompt, {_lit(_ENUM)}, 2) AS vs FROM prompts))
GROUP BY id, key
"""
# Required keys and allowed values of the JSON check of each prompt
_CTE["need_keys"] = f"""
SELECT id, unnest({_TICKET_KEYS}) AS key, unnest([0, 1]) AS place FROM prompts WHERE k = 3
UNION ALL SELECT id, s.key, s.place FROM shown_keys s JOIN prompts USING (id) WHERE k = 4
"""
_CTE["need_enums"] = """
SELECT id, 'urgency' AS key, ['low','medium','high'] AS allowed FROM prompts WHERE k = 3
UNION ALL SELECT id, s.key, s.allowed FROM shown_enums s JOIN prompts USING (id) WHERE k = 4
"""


def _lacking(keys: str) -> str:
    return f"""
SELECT o.id, o.model, o.variant, string_agg(n.key, ',' ORDER BY n.place) AS missing
FROM objects o JOIN {keys} n USING (id)
LEFT JOIN members m ON m.id = o.id AND m.model = o.model AND m.variant = o.variant AND m.key = n.key
WHERE m.key IS NULL GROUP BY ALL
"""


def _broken(enums: str) -> str:
    return f"""
SELECT m.id, m.model, m.variant, string_agg(m.key, ',' ORDER BY m.key) AS broken
FROM members m JOIN {enums} e ON e.id = m.id AND e.key = m.key
WHERE m.type = 'VARCHAR' AND NOT list_contains(e.allowed, json_extract_string(m.value, '$'))
GROUP BY ALL
"""


_CTE["lacking"] = _lacking("need_keys")
_CTE["broken"] = _broken("need_enums")
_CTE["lacking_shown"] = _lacking("shown_keys")
_CTE["broken_shown"] = _broken("shown_enums")
_CTE["ticket_keys"] = f"SELECT id, unnest({_TICKET_KEYS}) AS key, unnest([0, 1]) AS place FROM prompts"
_CTE["ticket_enums"] = "SELECT id, 'urgency' AS key, ['low','medium','high'] AS allowed FROM prompts"
_CTE["lacking_ticket"] = _lacking("ticket_keys")
_CTE["broken_ticket"] = _broken("ticket_enums")

_CTE["results_all"] = f"""
SELECT id, model, variant, idx, type,
  coalesce(CASE type WHEN 'exact_bullets' THEN found = n
    WHEN 'first_n_lines_questions' THEN len(head) >= n AND len(list_filter(head, lambda l: NOT contains(l, '?'))) = 0
    WHEN 'json_schema' THEN json_reason IS NULL END, false) AS pass,
  CASE type WHEN 'exact_bullets' THEN NULL
    WHEN 'first_n_lines_questions' THEN CASE WHEN len(head) < n THEN 'too_few_lines' END
    WHEN 'json_schema' THEN json_reason ELSE 'unknown_check:' || type END AS reason,
  CASE WHEN type = 'exact_bullets' THEN found
    WHEN type = 'first_n_lines_questions' AND len(head) < n THEN len(head)::BIGINT END AS found_count,
  CASE WHEN json_reason = 'wrong_type' AND type = 'json_schema' THEN found_type END AS found_type,
  CASE WHEN type = 'exact_bullets' OR (type = 'first_n_lines_questions' AND len(head) < n) THEN n::VARCHAR
    WHEN type = 'json_schema' AND json_reason = 'wrong_type' THEN 'object' END AS expected
FROM (SELECT a.*, d.idx, d.type, d.n,
        CASE WHEN d.prefix IS NULL THEN {_bullets('a.cleaned')} ELSE {_dashed('a.cleaned')} END AS found,
        {_lines('a.cleaned')}[1:d.n] AS head,
        CASE WHEN p.ok THEN {_PY_TYPE} END AS found_type,
        CASE WHEN coalesce(p.candidate, '') = '' THEN 'no_json_found'
          WHEN NOT p.ok THEN 'json_parse_error'
          WHEN d.sch_type = 'object' AND json_type(p.candidate) <> 'OBJECT' THEN 'wrong_type'
          WHEN l.missing IS NOT NULL THEN 'missing_keys'
          WHEN b.broken IS NOT NULL THEN 'enum_violation' END AS json_reason
      FROM cleaned a JOIN declared d USING (id)
      LEFT JOIN parsed p USING (id, model, variant)
      LEFT JOIN lacking l USING (id, model, variant)
      LEFT JOIN broken b USING (id, model, variant))
"""
_CTE["results"] = "SELECT r.* FROM results_all r JOIN kept_prompts USING (id)"
_CTE["verdicts"] = """
SELECT a.id, a.model, a.variant, bool_and(r.pass) AS pass_all, count(*) FILTER (WHERE r.pass) AS n_passed
FROM answers a LEFT JOIN results r USING (id, model, variant) GROUP BY ALL
"""
_CTE["outcomes"] = """
SELECT id, CASE WHEN count(*) = 1 THEN min(model) ELSE 'tie' END AS outcome
FROM (SELECT id, model, n_passed, max(n_passed) OVER (PARTITION BY id) AS best
      FROM verdicts WHERE variant = 'det') WHERE n_passed = best GROUP BY id
"""
_MODEL_LIST = "(SELECT unnest(['base','sft','dpo']) AS model)"
_CTE["summary"] = f"""
SELECT 'pass_all_rate' AS metric, m.model, NULL::VARCHAR AS check_type,
  count(*) FILTER (WHERE pass_all) AS num, count(pass_all)::BIGINT AS den,
  CASE WHEN count(pass_all) > 0 THEN count(*) FILTER (WHERE pass_all) / count(pass_all) END AS rate
FROM {_MODEL_LIST} m LEFT JOIN verdicts v ON v.model = m.model AND v.variant = 'det' GROUP BY m.model
UNION ALL
SELECT 'per_check_rate', model, type, count_if(pass)::BIGINT, count(*)::BIGINT, count_if(pass) / count(*)
FROM results WHERE variant = 'det' GROUP BY model, type
UNION ALL
SELECT 'wins', outcome, NULL, count(*)::BIGINT, NULL, NULL FROM outcomes WHERE outcome <> 'tie' GROUP BY outcome
UNION ALL
SELECT 'ties', NULL, NULL, count_if(outcome = 'tie')::BIGINT, NULL, NULL FROM outcomes
"""

_CTE["sides"] = """
SELECT pair_id, prompt, split, 'chosen' AS side, chosen AS completion FROM pref_pairs
UNION ALL SELECT pair_id, prompt, split, 'rejected', rejected FROM pref_pairs
"""


def _tokens(source: str, keys: str, text: str) -> str:
    """Tokens with place and predecessor."""
    return f"""
SELECT {keys}, unnest(ts) AS token, unnest(range(len(ts))) AS pos,
  unnest(list_concat(['<s>'], ts[1:len(ts)-1])) AS prev
FROM (SELECT {keys}, {_words(text)} AS ts FROM {source}) WHERE len(ts) > 0
"""


_CTE["pair_tokens"] = _tokens(
    f"(SELECT *, len({_words('prompt')}) AS n_prompt FROM sides)",
    "pair_id, side, n_prompt",
    "prompt || chr(10) || completion",
)
_CTE["token_logprobs"] = f"""
SELECT pair_id, model, side, pos, pos < n_prompt AS is_prompt,
  -({_hash("token || '|' || prev || '|' || model")} % 5000) AS logp
FROM pair_tokens, {_MODEL_LIST}
"""
_CTE["logliks"] = f"""
SELECT pair_id, model, side,
  coalesce(sum(logp) FILTER (WHERE pos >= greatest(least(n_prompt, {MAX_PROMPT}), 1)
    AND pos < {MAX_PROMPT + MAX_COMPLETION}), 0)::BIGINT AS logp
FROM (SELECT *, count(*) FILTER (WHERE is_prompt) OVER (PARTITION BY pair_id, model, side) AS n_prompt
      FROM token_logprobs) GROUP BY pair_id, model, side
"""
_CTE["scores"] = """
SELECT pair_id, model, c.logp AS logp_chosen, r.logp AS logp_rejected, c.logp - r.logp AS margin
FROM (SELECT * FROM logliks WHERE side = 'chosen') c
JOIN (SELECT * FROM logliks WHERE side = 'rejected') r USING (pair_id, model)
"""
_CTE["metrics"] = """
SELECT model, count(*) AS n, count_if(margin > 0)::BIGINT AS correct, sum(margin)::DOUBLE AS total,
  count_if(abs(margin) < 1e-6)::BIGINT AS ties FROM scores GROUP BY model
"""
_CTE["lengths"] = f"SELECT id, ord, len({_words('prompt')})::BIGINT AS n_tokens FROM prompts"
_CTE["ranked"] = """
SELECT *, row_number() OVER (ORDER BY n_tokens DESC, ord) AS rank
FROM (SELECT id, ord, least(n_tokens, @MAX@) AS n_tokens FROM lengths)
""".replace("@MAX@", str(MAX_PROMPT))
_CTE["seeded"] = """
SELECT *, ('0x'||substr(md5('42:' || pair_id),1,15))::BIGINT AS place FROM pref_pairs
"""
_CTE["prompt_keys"] = r"""
SELECT id, regexp_extract_all(prompt, '"([A-Za-z_]+)"\s*:', 1) AS ks FROM prompts
"""

_TURN_TEXT = f"{_strip('arg_max(text, turn)')}"
_QUERY: dict[str, str] = {}

_QUERY["src_preferences"] = "SELECT split, pair_id, prompt, 2::BIGINT AS turns FROM pref_texts"
_QUERY["src_one_split"] = _QUERY["src_preferences"] + " WHERE split = 'test'"
_QUERY["src_train_eval_json"] = f"""
SELECT CASE split WHEN 'train' THEN 'train' ELSE 'eval' END AS part, {_strip('prompt')} AS prompt,
  {_strip('chosen')} AS response FROM pref_texts
"""
_QUERY["src_prompt_items"] = """
SELECT id, category, md5(prompt) AS prompt_md5, k < 5 OR (ord // 6) % 2 <> 0 AS declared,
  CASE WHEN k IN (0, 2, 3) THEN 1 WHEN k IN (1, 4) THEN 2 ELSE 0 END::BIGINT AS n_checks FROM prompts
"""
_QUERY["src_generation_artifact"] = """
SELECT id, model, variant, md5(raw) AS raw_md5, md5(cleaned) AS cleaned_md5, pass_all
FROM answers JOIN verdicts USING (id, model, variant)
"""
_QUERY["sink_pairs_json"] = f"""
SELECT {_strip('prompt')} AS prompt, {_strip('chosen')} AS chosen, {_strip('rejected')} AS rejected,
  count(*) OVER () AS written FROM pref_texts
"""
_QUERY["sink_run_payload"] = """
SELECT p.id, category, count(v.model) AS outputs, count(*) FILTER (WHERE pass_all) AS passed, count(pass_all) AS applicable
FROM kept_prompts p LEFT JOIN verdicts v USING (id) GROUP BY p.id, category
"""
_QUERY["sink_eval_summary"] = "SELECT * FROM summary"
_QUERY["sink_preference_report"] = f"""
SELECT 'conversations' AS dataset, {MAX_PROMPT}::INTEGER AS max_prompt_tokens, model, n,
  correct / n AS preference_accuracy, total / n AS avg_logp_margin, ties FROM metrics
"""
_QUERY["last_message_text"] = f"""
SELECT 'list' AS form, pair_id AS key, {_strip('chosen')} AS text FROM pref_texts
UNION ALL SELECT 'turns', conv_id::VARCHAR, {_TURN_TEXT} FROM conversations GROUP BY conv_id
"""
_QUERY["last_user_message"] = """
SELECT 'list' AS form, pair_id AS key, prompt AS text FROM pref_texts
UNION ALL SELECT 'turns', conv_id::VARCHAR,
  coalesce(arg_max(text, turn) FILTER (WHERE role = 'user'), arg_max(text, turn))
FROM conversations GROUP BY conv_id
"""
_QUERY["normalize_preference_schema"] = f"""
SELECT pair_id, prompt, {_strip('chosen')} AS chosen, {_strip('rejected')} AS rejected FROM pref_texts
"""
_QUERY["build_sft_pairs"] = f"SELECT {_strip('prompt')} AS prompt, {_strip('chosen')} AS response FROM pref_texts"
_QUERY["build_preference_pairs"] = f"""
SELECT {_strip('prompt')} AS prompt, {_strip('chosen')} AS chosen, {_strip('rejected')} AS rejected FROM pref_texts
"""
_HEAD, _TAIL = _lit(TEMPLATE.bos + TEMPLATE.user_prefix), _lit(TEMPLATE.user_suffix)
_QUERY["render_chat_sft"] = f"""
SELECT {_HEAD} || {_strip('prompt')} || {_TAIL} || ' ' || {_strip('chosen')} || '</s>' AS text FROM pref_texts
"""
_QUERY["render_chat_prompt"] = f"""
SELECT id, 'plain' AS form, md5('User: ' || prompt || chr(10) || 'Assistant:') AS chat_md5 FROM prompts
UNION ALL SELECT id, 'template', md5({_HEAD} || prompt || {_TAIL}) FROM prompts
"""
_QUERY["render_dpo_rows"] = f"""
SELECT {_HEAD} || prompt || {_TAIL} AS prompt, {_strip('chosen')} AS chosen, {_strip('rejected')} AS rejected
FROM pref_pairs
"""
_QUERY["clean_outputs"] = """
SELECT id, model, variant, length(cleaned)::BIGINT AS n_chars, md5(cleaned) AS cleaned_md5 FROM cleaned_all
"""
_QUERY["clean_triplets"] = f"""
SELECT pair_id, {_strip('prompt')} AS prompt, {_clean("' limelight : ' || " + _strip('chosen'))} AS chosen,
  {_clean(_strip('rejected'))} AS rejected FROM pref_texts
"""
_QUERY["rubric_scaffold"] = "SELECT id, '' AS notes, NULL::VARCHAR AS winner, true AS unrated FROM prompts"
_QUERY["assemble_items"] = f"""
SELECT p.id, p.category, {", ".join(
    f"md5(max(raw) FILTER (WHERE model = '{m}' AND variant = '{v}')) AS {m}_{v}"
    for m in ("base", "sft", "dpo") for v in ("det", "samp"))}
FROM prompts p LEFT JOIN generations g USING (id) GROUP BY p.id, p.category
"""
_QUERY["skip_categories"] = "SELECT id, category FROM kept_prompts"
_QUERY["drop_missing_outputs"] = "SELECT id, model, variant FROM generations WHERE raw IS NOT NULL"
_QUERY["select_variant"] = "SELECT id, model, variant, md5(raw) AS raw_md5 FROM generations WHERE variant = 'samp'"
_QUERY["skip_absent_models"] = "SELECT id, model, variant FROM generations WHERE model IN ('base', 'dpo')"
_QUERY["applicable_only"] = "SELECT id, model, variant, pass_all FROM verdicts WHERE pass_all IS NOT NULL"
_QUERY["join_prompts_outputs"] = """
SELECT g.id, model, variant, md5(prompt) AS prompt_md5, md5(raw) AS raw_md5,
  CASE WHEN k IN (0, 2, 3) THEN 1 WHEN k IN (1, 4) THEN 2 ELSE 0 END::BIGINT AS n_checks
FROM generations g JOIN prompts USING (id)
"""


def _verdict_text(m: str) -> str:
    return (
        f"coalesce(max('pass_all=' || coalesce(CASE WHEN pass_all THEN 'True' ELSE 'False' END, 'None') || "
        f"' | checks=' || listed) FILTER (WHERE model = '{m}'), 'N/A')"
    )


_QUERY["replay_lookup"] = f"""
SELECT id, variant, md5(prompt) AS prompt_md5,
  {", ".join(f"md5(max(raw) FILTER (WHERE model = '{m}')) AS {m}" for m in ("base", "sft", "dpo"))},
  '**Base:** ' || {_verdict_text('base')} || chr(10) || chr(10) || '**SFT:** ' || {_verdict_text('sft')}
  || chr(10) || chr(10) || '**DPO:** ' || {_verdict_text('dpo')} || chr(10) AS eval_text
FROM (SELECT a.id, a.model, a.variant, a.raw,
        CASE WHEN count(r.idx) > 0 THEN bool_and(r.pass) END AS pass_all,
        coalesce(string_agg(r.type || '=' || r.pass, ',' ORDER BY r.idx), '') AS listed
      FROM answers a LEFT JOIN results r USING (id, model, variant) GROUP BY ALL)
RIGHT JOIN (SELECT id, variant, prompt FROM kept_prompts, (SELECT unnest(['det','samp']) AS variant))
  USING (id, variant) GROUP BY id, variant, prompt
"""
_QUERY["replay_lookup"] = _QUERY["replay_lookup"].replace(
    "coalesce(CASE WHEN pass_all THEN 'True' ELSE 'False' END, 'None')",
    "CASE WHEN pass_all THEN 'True' WHEN NOT pass_all THEN 'False' ELSE 'None' END",
)
_QUERY["join_chosen_rejected"] = "SELECT * FROM scores"
_QUERY["pass_all_rate"] = f"""
SELECT m.model, count(*) FILTER (WHERE pass_all) AS passed, count(pass_all) AS applicable,
  CASE WHEN count(pass_all) > 0 THEN count(*) FILTER (WHERE pass_all) / count(pass_all) END AS rate
FROM {_MODEL_LIST} m LEFT JOIN verdicts v USING (model) GROUP BY m.model
"""
_QUERY["per_check_rate"] = """
SELECT model, type AS check_type, count_if(pass)::BIGINT AS passed, count(*) AS total,
  count_if(pass) / count(*) AS rate FROM results GROUP BY model, type
"""
_QUERY["wins_and_ties"] = """
SELECT outcome, count(*) AS n FROM outcomes GROUP BY outcome
"""
_QUERY["eval_summary"] = "SELECT * FROM summary"
_QUERY["completion_loglik"] = "SELECT * FROM logliks"
_QUERY["preference_accuracy"] = """
SELECT model, n, correct / n AS preference_accuracy, total / n AS avg_logp_margin, ties FROM metrics
"""
_QUERY["tie_aware_accuracy"] = """
SELECT model, correct / (n - ties) AS accuracy_excl_ties, (correct + 0.5::DOUBLE * ties) / n AS accuracy_w_ties_half
FROM metrics
"""
_QUERY["dataset_row_counts"] = "SELECT split, count(*) AS n FROM pref_pairs GROUP BY split"
_QUERY["preference_margin_vs_reference"] = """
SELECT pair_id, round(m * 1e6)::BIGINT AS margin_micro, round(ln(1 + exp(-m)) * 1e6)::BIGINT AS loss_micro
FROM (SELECT pair_id, 0.0001::DOUBLE * (p.margin - r.margin) AS m
      FROM (SELECT * FROM scores WHERE model = 'dpo') p
      JOIN (SELECT * FROM scores WHERE model = 'sft') r USING (pair_id))
"""
_QUERY["length_sorted_order"] = "SELECT id, n_tokens, rank FROM ranked"
_QUERY["restore_order"] = "SELECT id, ord, rank FROM ranked"
_QUERY["length_sorted_batches"] = """
SELECT id, batch_id, padded_len, padded_len - n_tokens AS waste
FROM (SELECT *, (ceil(max(n_tokens) OVER (PARTITION BY batch_id) / 8) * 8)::BIGINT AS padded_len
      FROM (SELECT *, (rank - 1) // 8 AS batch_id FROM ranked))
"""
_QUERY["pack_sequences"] = f"""
SELECT block_id, id, greatest(block_id * {BLOCK} - start, 0)::BIGINT AS from_token,
  least(block_id * {BLOCK} - start + {BLOCK}, n_tokens)::BIGINT AS to_token
FROM (SELECT *, unnest(range(start // {BLOCK}, (start + n_tokens - 1) // {BLOCK} + 1)) AS block_id
      FROM (SELECT *, (sum(n_tokens) OVER (ORDER BY ord) - n_tokens)::BIGINT AS start
            FROM lengths WHERE n_tokens > 0))
"""
_QUERY["length_buckets"] = "SELECT id, n_tokens, n_tokens // 64 AS bucket FROM lengths"
_QUERY["train_test_split"] = f"""
SELECT pair_id, CASE WHEN rn <= ceil(greatest(0.02::DOUBLE, least(0.2::DOUBLE, {int(SAMPLE * 1.2)} / total)) * total)
  THEN 'test' ELSE 'train' END AS part
FROM (SELECT pair_id, row_number() OVER (ORDER BY place, pair_id) AS rn, count(*) OVER () AS total FROM seeded)
"""
_QUERY["sample_n"] = f"""
SELECT pair_id, prompt, chosen FROM seeded QUALIFY row_number() OVER (ORDER BY place, pair_id) <= {SAMPLE}
"""
_QUERY["head_n"] = "SELECT id, ord FROM prompts ORDER BY ord LIMIT 100"
_QUERY["first_n_lines"] = f"""
SELECT id, model, variant, len(ls)::BIGINT AS n_lines, md5(array_to_string(ls, chr(10))) AS lines_md5
FROM (SELECT *, {_lines('cleaned')}[1:3] AS ls FROM cleaned)
"""
_QUERY["truncate_tokens"] = f"""
SELECT id, len(ts)::BIGINT AS n_tokens, md5(array_to_string(ts, ' ')) AS tokens_md5
FROM (SELECT id, {_words('prompt')}[1:192] AS ts FROM prompts)
"""
_QUERY["union_splits"] = "SELECT split, pair_id, prompt, chosen FROM pref_pairs"
_QUERY["distinct_keys_in_order"] = """
SELECT p.id, coalesce(string_agg(key, ',' ORDER BY place), '') AS keys
FROM prompts p LEFT JOIN shown_keys USING (id) GROUP BY p.id
"""
_QUERY["missing_keys"] = """
SELECT id, array_to_string(list_filter(['urgency','topic','intent'], lambda k: NOT list_contains(ks, k)), ',') AS missing
FROM prompt_keys
"""
_QUERY["count_bullets"] = f"""
SELECT id, model, variant, {_bullets('cleaned')} AS plain, {_dashed('cleaned')} AS dashed FROM cleaned
"""
_QUERY["check_exact_bullets"] = f"""
SELECT id, model, variant, found = 3 AS pass, found AS found_count, '3' AS expected, '- ' AS prefix
FROM (SELECT *, {_dashed('cleaned')} AS found FROM cleaned)
"""
_QUERY["check_first_n_questions"] = f"""
SELECT id, model, variant,
  len(ls) = 2 AND len(list_filter(ls, lambda l: contains(l, '?'))) = 2 AS pass,
  CASE WHEN len(ls) < 2 THEN 'too_few_lines' END AS reason,
  CASE WHEN len(ls) < 2 THEN len(ls)::BIGINT END AS found_count,
  CASE WHEN len(ls) < 2 THEN '2' END AS expected,
  CASE WHEN len(ls) = 2 THEN md5(array_to_string(ls, chr(10))) END AS lines_md5
FROM (SELECT *, {_lines('cleaned')}[1:2] AS ls FROM cleaned)
"""
_QUERY["extract_json_candidate"] = "SELECT id, model, variant, candidate FROM candidates"
_QUERY["json_parses"] = "SELECT id, model, variant, ok FROM parsed"
_QUERY["json_type_check"] = f"""
SELECT id, model, variant, CASE WHEN wrong THEN 'wrong_type' END AS reason,
  CASE WHEN wrong THEN found END AS found_type
FROM (SELECT *, CASE WHEN ok THEN {_PY_TYPE} END AS found, ok AND found <> 'dict' AS wrong FROM parsed)
"""
_QUERY["json_required_keys"] = """
SELECT id, model, variant, coalesce(missing, '') AS missing,
  CASE WHEN missing IS NOT NULL THEN 'missing_keys' END AS reason
FROM parsed LEFT JOIN lacking_shown USING (id, model, variant)
"""
_QUERY["json_enum_check"] = """
SELECT id, model, variant, coalesce(broken, '') AS broken,
  CASE WHEN broken IS NOT NULL THEN 'enum_violation' END AS reason
FROM parsed LEFT JOIN broken_shown USING (id, model, variant)
"""
_QUERY["check_json_schema"] = f"""
SELECT id, model, variant, reason IS NULL AS pass, reason,
  CASE WHEN reason = 'wrong_type' THEN found END AS found_type,
  CASE WHEN reason = 'missing_keys' THEN missing END AS missing,
  CASE WHEN reason = 'enum_violation' THEN broken END AS broken
FROM (SELECT p.*, l.missing, b.broken, CASE WHEN ok THEN {_PY_TYPE} END AS found,
        CASE WHEN coalesce(candidate, '') = '' THEN 'no_json_found' WHEN NOT ok THEN 'json_parse_error'
          WHEN json_type(candidate) <> 'OBJECT' THEN 'wrong_type'
          WHEN missing IS NOT NULL THEN 'missing_keys'
          WHEN broken IS NOT NULL THEN 'enum_violation' END AS reason
      FROM parsed p LEFT JOIN lacking_ticket l USING (id, model, variant)
      LEFT JOIN broken_ticket b USING (id, model, variant))
"""
_QUERY["run_checks"] = """
SELECT id, model, variant, type, pass, reason, found_count, found_type, expected FROM results_all
"""
_QUERY["declared_checks"] = """
SELECT p.id, coalesce(string_agg(concat_ws(':', type, n, prefix), ',' ORDER BY idx), '') AS checks
FROM prompts p LEFT JOIN declared USING (id) GROUP BY p.id
"""
_QUERY["infer_exact_bullets"] = f"SELECT id, {_N_BULLETS} AS n FROM prompts"
_QUERY["infer_first_n_questions"] = f"SELECT id, {_N_QUESTIONS} AS n FROM prompts"
_QUERY["infer_json_check"] = f"SELECT id, {_JSON_ONLY} AS flag FROM prompts"
_QUERY["infer_required_keys"] = _QUERY["distinct_keys_in_order"]
_QUERY["infer_enums"] = """
SELECT p.id, coalesce(string_agg(key || '=' || array_to_string(allowed, '|'), ',' ORDER BY key), '') AS enums
FROM prompts p LEFT JOIN shown_enums USING (id) GROUP BY p.id
"""
_QUERY["infer_checks"] = f"""
SELECT p.id, CASE WHEN k = 5 AND (ord // 6) % 2 <> 0 THEN ''
  ELSE concat_ws(',', 'exact_bullets:' || {_N_BULLETS}, 'first_n_lines_questions:' || {_N_QUESTIONS},
    CASE WHEN {_JSON_ONLY} THEN 'json_schema' END) END AS checks
FROM prompts p
"""
_QUERY["validate_required_keys"] = """
SELECT 'id' AS key, 0::BIGINT AS missing, NULL::BIGINT AS first_row
UNION ALL SELECT 'prompt', 0, NULL
UNION ALL SELECT 'category', count(*), min(ord) FROM prompts WHERE category IS NULL
UNION ALL SELECT 'rubric', count(*), min(ord) FROM prompts
"""
_QUERY["schema_gate"] = """
SELECT key_set, key, CASE key WHEN 'response' THEN n WHEN 'rejected' THEN n_same ELSE 0 END::BIGINT AS missing,
  CASE key WHEN 'response' THEN first_any WHEN 'rejected' THEN first_same END AS first_row
FROM (SELECT unnest(['sft','sft','dpo','dpo','dpo']) AS key_set,
        unnest(['prompt','response','prompt','chosen','rejected']) AS key),
  (SELECT count(*) AS n, min(ord) AS first_any, count_if(chosen = rejected) AS n_same,
     min(ord) FILTER (WHERE chosen = rejected) AS first_same FROM pref_pairs)
"""
_QUERY["batch_generate"] = f"""
SELECT id, model, variant,
  substr(md5(model || '|' || variant || '|' || 'User: ' || prompt || chr(10) || 'Assistant:'), 1, 12) AS raw
FROM prompts, {_MODEL_LIST}, (SELECT unnest(['det','samp']) AS variant)
"""
_QUERY["batch_score"] = f"""
SELECT pair_id, model, side,
  coalesce(sum(-(length(token) + length(model))) FILTER (
    WHERE pos >= greatest(least(n_prompt, {MAX_PROMPT}), 1) AND pos < {MAX_PROMPT + MAX_COMPLETION}), 0)::BIGINT AS logp
FROM pair_tokens, {_MODEL_LIST} GROUP BY pair_id, model, side
"""
_CTE["corpus_tokens"] = _tokens("(SELECT * FROM pref_pairs WHERE split = 'train')", "pair_id", "chosen")
_CTE["side_tokens"] = _tokens("sides", "pair_id, side", "completion")
_QUERY["ngram_token_logp"] = """
SELECT pair_id, side, count(*) AS n,
  sum(round(ln((coalesce(b.n, 0) + 1) / (coalesce(c.n, 0) + v.n)) * 1e6)::BIGINT)::BIGINT AS logp_micro
FROM side_tokens t
LEFT JOIN (SELECT prev, token, count(*) AS n FROM corpus_tokens GROUP BY ALL) b USING (prev, token)
LEFT JOIN (SELECT prev, count(*) AS n FROM corpus_tokens GROUP BY ALL) c USING (prev),
  (SELECT count(DISTINCT token) AS n FROM corpus_tokens) v
GROUP BY pair_id, side
"""
_QUERY["stream_pass_rate"] = """
SELECT (ord // 60) * 3600 AS window_start, model,
  count(*) FILTER (WHERE pass_all) AS passed, count(pass_all) AS applicable
FROM (SELECT c.id, c.model, c.variant, bool_and(r.pass) AS pass_all
      FROM cleaned c LEFT JOIN results_all r USING (id, model, variant) GROUP BY ALL)
JOIN prompts USING (id) GROUP BY ALL
"""

_NAME = re.compile(r"\b(?:FROM|JOIN)\s+(" + "|".join(_CTE) + r")\b")


def _needed(sql: str, seen: dict[str, None]) -> None:
    # literals hold no table names
    for name in _NAME.findall(re.sub(r"'(?:[^']|'')*'", "''", sql)):
        if name not in seen:
            _needed(_CTE[name], seen)
            seen[name] = None


def statement(name: str) -> str:
    """One statement: the query with the subqueries it needs, in order."""
    needed: dict[str, None] = {}
    _needed(_QUERY[name], needed)
    parts = ",\n".join(f"{n} AS ({_CTE[n].strip()})" for n in needed)
    return (f"WITH {parts}\n" if parts else "") + _QUERY[name].strip()


def statements() -> dict[str, str]:
    return {name: statement(name) for name in _QUERY}
