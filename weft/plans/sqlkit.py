"""DuckDB SQL fragments for the oracles: the derived inputs of :mod:`weft.plans.derived`
re-stated in SQL, plus token-text helpers. Written against DuckDB's dialect."""

from __future__ import annotations

from ..functions import tokens as tk
from ..functions.draws import uniform_sql
from ..operators.chat import DEFAULT_SYSTEM_PROMPTS, EMPTY_THINK, TOOLS_INTRO
from ..operators.toolcalls import TOOL_SPEC_JSON
from .derived import SEQ_LEN, TOOL_BLOCKS


def s(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def slist(items) -> str:
    return "[" + ", ".join(s(x) for x in items) + "]"


def utf8(t: str) -> str:
    return f"regexp_replace(hex(encode({t})), '(..)', ' {"0" * (tk.DIGITS - 2)}\\1', 'g')"


def ntok(c: str) -> str:
    return f"(length({c}) // {tk.TOKEN_WIDTH})"


SPECIAL_ALT = tk.specials_alternation()


def special_code(x: str) -> str:
    whens = " ".join(f"WHEN {s(sp)} THEN {s(tk.code_hex(tk.SPECIAL_BASE + i))}"
                     for i, sp in enumerate(tk.ALL_SPECIAL_TOKENS))
    return f"(CASE {x} {whens} END)"


def encode_bytes(t: str) -> str:
    """Code text of a text under the byte vocabulary, specials kept whole."""
    parts = f"string_split_regex({t}, {s(SPECIAL_ALT)})"
    seps = f"regexp_extract_all({t}, {s(SPECIAL_ALT)})"
    return (f"array_to_string(list_transform(range(1, len({parts}) + 1), lambda i: "
            f"{utf8(f'{parts}[i]')} || coalesce({special_code(f'{seps}[i]')}, '')), '')")


def code_ids(c: str) -> str:
    """Code text -> list of production ids."""
    conv = tk.code_to_id_sql("v")
    return (f"CASE WHEN {c} = '' THEN []::INT[] ELSE list_transform(string_split(ltrim({c}), ' '), "
            f"lambda x: (SELECT {conv} FROM (SELECT ('0x' || x)::INT AS v))) END")


def code_ids_fast(c: str) -> str:
    conv = tk.code_to_id_sql("('0x' || x)::INT")
    return f"CASE WHEN {c} = '' THEN []::INT[] ELSE list_transform(string_split(ltrim({c}), ' '), lambda x: {conv}) END"


def pad(c: str, max_length: int) -> str:
    pad_code = tk.code_hex(tk.SPECIAL_BASE + tk.ALL_SPECIAL_TOKENS.index(tk.PAD))
    return f"({c} || repeat({s(pad_code)}, greatest({max_length} - {ntok(c)}, 0)))"


def trunc(c: str, n: int) -> str:
    return f"substr({c}, 1, {n * tk.TOKEN_WIDTH})"


def draw(key: str, purpose: str) -> str:
    return uniform_sql(key, purpose)


def specs_list() -> str:
    return slist(TOOL_SPEC_JSON)


def turns_cte() -> str:
    n = len(TOOL_SPEC_JSON)
    return f"""turns AS (
  SELECT conv_id, turn, role,
    CASE WHEN role = 'assistant' AND conv_id % 4 = 1 THEN {s(EMPTY_THINK)} || text ELSE text END AS content,
    CASE WHEN role = 'system' AND conv_id % 2 = 0
         THEN '[' || {specs_list()}[conv_id % {n} + 1] || ', ' || {specs_list()}[(conv_id + 1) % {n} + 1] || ']' END AS tools,
    CASE WHEN role = 'system' AND conv_id % 2 = 0
         THEN {specs_list()}[conv_id % {n} + 1] || chr(10) || {specs_list()}[(conv_id + 1) % {n} + 1] END AS tools_text
  FROM conversations)"""


def render_piece(role: str, content: str, thinking: str = "false") -> str:
    body = (f"CASE WHEN {thinking} AND {role} = 'assistant' THEN {s(tk.THINK_START)} || {content} || "
            f"{s(tk.THINK_END)} ELSE {content} END")
    return f"({s(tk.BOS)} || {role} || chr(10) || {body} || {s(tk.EOS)} || chr(10))"


def system_prompt_cols(key: str, first_role: str, any_tools: str, n_msgs: str) -> str:
    """(added BOOLEAN, sys_content) of the C7 draw."""
    prompts = slist(DEFAULT_SYSTEM_PROMPTS)
    added = (f"(NOT {any_tools} AND coalesce({first_role} <> 'system', true) AND {n_msgs} > 0 "
             f"AND {draw(key, 'system-draw')} < 0.2)")
    content = f"{prompts}[CAST(floor({draw(key, 'system-choice')} * {len(DEFAULT_SYSTEM_PROMPTS)}) AS INT) + 1]"
    return f"{added} AS added, {content} AS sys_content"


def conv_meta_cte(src: str = "turns") -> str:
    """Per conversation: first role, any tools, size, last role, last system tools text."""
    return f"""meta AS (
  SELECT conv_id, count(*) AS n_msgs,
    arg_min(role, turn) AS first_role, arg_max(role, turn) AS last_role,
    bool_or(coalesce(tools, '') <> '') AS any_tools,
    arg_max(tools_text, turn) FILTER (WHERE role = 'system' AND coalesce(tools, '') <> '') AS tools_text
  FROM {src} GROUP BY conv_id)"""


def rendered_cte(thinking: str = "false", with_tools: bool = True, system_prompt: bool = False,
                 drop_last: bool = False, gen_prompt: bool = False, name: str = "rendered") -> str:
    """Prompt text per conversation, via per-turn pieces and an ordered string_agg."""
    aug = ""
    if system_prompt:
        aug = f"""aug AS (
  SELECT m.*, {system_prompt_cols('m.conv_id', 'm.first_role', 'm.any_tools', 'm.n_msgs')} FROM meta m),"""
    else:
        aug = "aug AS (SELECT m.*, false AS added, NULL::VARCHAR AS sys_content FROM meta m),"
    # message list = optional prompt (pos -1) + turns; drop_last removes the last one
    has_tools = "(coalesce(a.tools_text, '') <> '')" if with_tools else "false"
    first_is_sys = "(CASE WHEN a.added THEN true ELSE a.first_role = 'system' END)"
    return f"""{aug}
msgs AS (
  SELECT a.conv_id, -1 AS turn, 'system' AS role, a.sys_content AS content FROM aug a WHERE a.added
  UNION ALL
  SELECT t.conv_id, t.turn, t.role, t.content FROM turns t),
msgs2 AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k,
         count(*) OVER (PARTITION BY conv_id) AS nk FROM msgs),
pieces AS (
  SELECT m.conv_id, m.k,
    CASE WHEN {has_tools} AND m.k = 1 AND {first_is_sys}
         THEN {s(tk.BOS)} || 'system' || chr(10) || coalesce(m.content, 'None') || chr(10) || {s(TOOLS_INTRO)} || chr(10) || a.tools_text || {s(tk.EOS)} || chr(10)
         ELSE {render_piece('m.role', "coalesce(m.content, 'None')", thinking)} END AS piece
  FROM msgs2 m JOIN aug a USING (conv_id)
  WHERE {'m.k < m.nk' if drop_last else 'true'}),
{name} AS (
  SELECT a.conv_id,
    CASE WHEN {has_tools} AND NOT {first_is_sys}
         THEN {s(tk.BOS)} || 'system' || chr(10) || {s(TOOLS_INTRO)} || chr(10) || a.tools_text || {s(tk.EOS)} || chr(10) ELSE '' END
    || coalesce((SELECT string_agg(p.piece, '' ORDER BY p.k) FROM pieces p WHERE p.conv_id = a.conv_id), '')
    {('|| ' + s(tk.BOS + 'assistant' + chr(10))) if gen_prompt else ''} AS prompt
  FROM aug a)"""


def drop_think(prompt: str, key: str, purpose: str = "empty-think") -> str:
    return (f"CASE WHEN contains({prompt}, {s(EMPTY_THINK)}) AND {draw(key, purpose)} > 0.2 "
            f"THEN replace({prompt}, {s(EMPTY_THINK)}, '') ELSE {prompt} END")


def span_mask(c: str, b: str, e: str, keep: str, drop: str) -> str:
    """Per-token label/loss values over a code text (same piece cutting as the Spark side,
    written with DuckDB list functions)."""
    return span_mask_of(c, s(b), s(e), keep, drop)


def span_mask_of(c: str, b: str, e: str, keep: str, drop: str) -> str:
    """The same with the anchors as SQL expressions."""
    pat = f"'(.*?)(' || {b} || ')(.*?(?:' || {e} || '|$))|(.+)$'"
    return (f"flatten(list_transform(regexp_extract_all({c}, {pat}), lambda p: "
            f"list_transform(range(0, length(p) // {tk.TOKEN_WIDTH}), lambda i: "
            f"CASE WHEN strpos(p, {b}) > 0 AND i * {tk.TOKEN_WIDTH} >= strpos(p, {b}) - 1 + length({b}) THEN {keep} ELSE {drop} END)))")


def token_logs_cte() -> str:
    return f"""ev AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
logs AS (
  SELECT user_id, event_id, ts, event_type, value, k, rn,
    CAST((rn - 1) // {SEQ_LEN} AS BIGINT) AS seq_no, CAST((rn - 1) % {SEQ_LEN} AS INTEGER) AS pos,
    -ln(1.0 + value / 10.0) AS policy_logp,
    -ln(1.0 + k / 10.0) AS ref_logp,
    -ln(1.0 + value / 10.0) + ((k % 5) - 2) / 20.0 AS old_logp,
    CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS mask,
    CASE WHEN event_type = 'purchase' THEN 1.0 WHEN event_type = 'signup' THEN 0.5 ELSE 0.0 END AS reward,
    k / 100.0 AS v_est,
    k / 100.0 + ((k % 3) - 1) / 10.0 AS old_v
  FROM ev)"""


def tool_responses_cte() -> str:
    return f"""resp AS (
  SELECT conv_id, turn, text || chr(10) || {slist(TOOL_BLOCKS)}[conv_id % {len(TOOL_BLOCKS)} + 1] AS response,
    CASE WHEN conv_id % 4 = 0 THEN split_part(text, ' ', 1) WHEN conv_id % 4 = 1 THEN '  '
         WHEN conv_id % 4 = 2 THEN 'zzqx' ELSE NULL END AS gt
  FROM conversations WHERE role = 'assistant')"""

