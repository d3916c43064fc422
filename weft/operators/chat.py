"""Conversation rendering and augmentation.

A conversation is ``ARRAY<STRUCT<role, content, reasoning_content, tools, tool_calls>>``.
Everything is a column expression over that array (``transform``/``filter``/``slice``),
so rendering is map-only and runs unchanged on a streaming DataFrame.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import tokens as tk
from ..functions.draws import uniform

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's rendered text): the line that
# introduces the tool block inside the system turn ("You can use the following tools:").
TOOLS_INTRO = "你可以使用以下工具："
# The empty reasoning block removed by post-processing.
EMPTY_THINK = tk.THINK_START + "\n\n" + tk.THINK_END + "\n\n"
# Roles kept by the template-string variant.
TEMPLATE_ROLES = ("system", "user", "assistant", "tool")
# ---------------------------------------------------------------------------

# Our own system-prompt table (callers may pass their own list).
DEFAULT_SYSTEM_PROMPTS = (
    "You are a careful assistant. Answer accurately and concisely.",
    "You are a helpful assistant that explains its reasoning clearly.",
    "Answer the user's question as precisely as you can.",
    "You are a patient tutor. Give correct, well-organised answers.",
    "You are a reliable assistant; say so when you are unsure.",
    "Respond helpfully and truthfully to the user.",
    "You are an assistant that writes short, accurate replies.",
    "Help the user solve their problem step by step.",
    "You are a knowledgeable assistant. Be accurate and polite.",
    "Give the user a useful, correct and friendly answer.",
)

def _str(c: Column) -> Column:
    """Python f-string semantics for a possibly-NULL string field."""
    return F.coalesce(c, F.lit("None"))


def render_one(m: Column, open_thinking: Column | bool = False) -> Column:
    thinking = F.lit(open_thinking) if isinstance(open_thinking, bool) else open_thinking
    content = F.when(thinking & (m["role"] == "assistant"),
                     F.concat(F.lit(tk.THINK_START), _str(m["content"]), F.lit(tk.THINK_END))
                     ).otherwise(_str(m["content"]))
    return F.concat(F.lit(tk.BOS), _str(m["role"]), F.lit("\n"), content, F.lit(tk.EOS + "\n"))


def render_messages(messages: Column, tools_text: Column | None = None,
                    open_thinking: Column | bool = False,
                    add_generation_prompt: bool = False) -> Column:
    """C1-C4. ``tools_text`` is the tool list as one JSON object per line (see
    :func:`normalise_tools`); NULL or '' means no tools."""
    first = F.try_element_at(messages, F.lit(1))
    first_is_system = F.coalesce(first["role"] == "system", F.lit(False))
    n = F.size(messages)
    if tools_text is None:
        has_tools = F.lit(False)
        tools_text = F.lit("")
    else:
        has_tools = F.coalesce(tools_text != "", F.lit(False))
    sys_content = F.when(first_is_system,
                         F.concat(_str(first["content"]), F.lit("\n" + TOOLS_INTRO + "\n"), tools_text)
                         ).otherwise(F.concat(F.lit(TOOLS_INTRO + "\n"), tools_text))
    tool_block = F.when(has_tools, F.concat(F.lit(tk.BOS + "system\n"), sys_content,
                                            F.lit(tk.EOS + "\n"))).otherwise(F.lit(""))
    start = F.when(has_tools & first_is_system, F.lit(2)).otherwise(F.lit(1))
    rest = F.slice(messages, start, F.greatest(n - start + 1, F.lit(0)))
    body = F.array_join(F.transform(rest, lambda m: render_one(m, open_thinking)), "")
    out = F.concat(tool_block, body)
    if add_generation_prompt:
        out = F.concat(out, F.lit(tk.BOS + "assistant\n"))
    return out


def render_template(messages: Column, open_thinking: Column | bool = False,
                    add_generation_prompt: bool = False) -> Column:
    """The template-string variant: other roles dropped, tools ignored."""
    kept = F.filter(messages, lambda m: m["role"].isin(*TEMPLATE_ROLES))
    return render_messages(kept, None, open_thinking, add_generation_prompt)


def has_any_tools(messages: Column) -> Column:
    return F.exists(messages, lambda m: F.coalesce(m["tools"] != "", F.lit(False)))


def add_system_prompt(messages: Column, key: Column, ratio: float = 0.2,
                      prompts=DEFAULT_SYSTEM_PROMPTS, seed: int = 42) -> Column:
    """With probability ``ratio`` prepend one system prompt (chosen uniformly),
    unless a message carries tools or the first message is already a system message.
    Draws come from the row key (deterministic under retries)."""
    first_role = F.try_element_at(messages, F.lit(1))["role"]
    draw = uniform(key, "system-draw", seed)
    pick = (F.floor(uniform(key, "system-choice", seed) * len(prompts)) + 1).cast("int")
    table = F.array(*[F.lit(p) for p in prompts])
    sys_msg = F.struct(F.lit("system").alias("role"), F.element_at(table, pick).alias("content"),
                       F.lit(None).cast("string").alias("reasoning_content"),
                       F.lit(None).cast("string").alias("tools"),
                       F.lit(None).cast("string").alias("tool_calls"))
    prepend = (~has_any_tools(messages)) & F.coalesce(first_role != "system", F.lit(True)) \
        & (draw < ratio) & (F.size(messages) > 0)
    return F.when(prepend, F.concat(F.array(sys_msg), messages)).otherwise(messages)


def drop_empty_think(prompt: Column, key: Column, ratio: float = 0.2,
                     purpose: str = "empty-think", seed: int = 42) -> Column:
    """If the empty reasoning block occurs, remove all of them when draw > ratio."""
    hit = F.contains(prompt, F.lit(EMPTY_THINK)) & (uniform(key, purpose, seed) > ratio)
    return F.when(hit, F.replace(prompt, F.lit(EMPTY_THINK), F.lit(""))).otherwise(prompt)


def thinking_draw(key: Column, ratio: float = 0.5, seed: int = 42) -> Column:
    """Per-sample reasoning-mode flag."""
    return uniform(key, "thinking-mode", seed) < ratio


def last_system_tools(messages: Column) -> Column:
    """The ``tools`` of the last system message that has tools (last one wins)."""
    with_tools = F.filter(messages, lambda m: (m["role"] == "system")
                          & F.coalesce(m["tools"] != "", F.lit(False)))
    return F.try_element_at(with_tools, F.lit(-1))["tools"]


@F.pandas_udf(T.StringType())
def normalise_tools(tools_json):
    """Re-serialise a JSON tool list one object per line with Python separators and
    non-ASCII kept. Each distinct value of an Arrow batch is parsed once; a value that is not
    JSON counts as no tools."""
    def one(s):
        try:
            parsed = json.loads(s)
        except (ValueError, RecursionError):
            return None
        if not parsed:
            return ""
        if isinstance(parsed, dict):
            parsed = [parsed]
        return "".join(json.dumps(t, ensure_ascii=False) + "\n" for t in parsed).strip()
    known = {s: one(s) for s in tools_json.unique() if s}
    return tools_json.map(lambda s: known.get(s) if s else None)
