"""Token sequences as fixed-width code text.

Every token is written as a space plus five upper-case hex digits, e.g. ``" 00074 00068"``.
Internal codes:

* ``0x00000-0x000FF``  a raw UTF-8 byte,
* ``0x00100 + r``     the merge learned in round ``r`` (0-based), up to ``0xFFEFF``,
* ``0xFFF00 + s``     special token number ``s``.

Because each token starts with the only space in its six characters, a built-in
``replace(text, " A B", " N")`` merges a pair left to right without overlaps and can
never match across a token boundary. Conversion to integer ids happens only at the
output edge, in one of two id layouts:

* ``teaching``: byte ``b`` -> ``b``; merge ``r`` -> ``256 + r`` (no special tokens);
* ``production``: special ``s`` -> ``s``; byte ``b`` -> ``n_special + alphabet_rank(b)``;
  merge ``r`` -> ``n_special + 256 + r``. The alphabet is the 256 byte-level symbols in
  symbol order (printable bytes keep their own code point, the other 68 are shifted
  above 255), which gives the rank rule in :func:`alphabet_rank`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPECIAL_BASE = 0xFFF00
MERGE_BASE = 0x100
DIGITS = 5
TOKEN_WIDTH = DIGITS + 1
CODE_FORMAT = f" %0{DIGITS}X"
MAX_MERGES = SPECIAL_BASE - MERGE_BASE

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference): special-token spellings in id order.
# The order fixes the ids 0..23; bos = "<|im_start|>", eos = "<|im_end|>",
# pad = "<|pad|>".
SPECIAL_TOKENS = (
    "<|im_start|>",
    "<|im_end|>",
    "<|pad|>",
    "<|vision_start|>",
    "<|vision_end|>",
    "<|image_pad|>",
    "<|audio_pad|>",
    "📞",
    "<toolcall_start>",
    "<toolcall_end>",
    "<executionsandbox_start>",
    "<executionsandbox_end>",
    "<executionresult_start>",
    "<executionresult_end>",
    "<reasoningchain_start>",
    "<reasoningchain_end>",
)
BUFFER_TOKENS = tuple(f"<|buffer{i}|>" for i in range(1, 9))
ALL_SPECIAL_TOKENS = SPECIAL_TOKENS + BUFFER_TOKENS
BOS, EOS, PAD = "<|im_start|>", "<|im_end|>", "<|pad|>"
THINK_START, THINK_END = "<reasoningchain_start>", "<reasoningchain_end>"

# Byte-level pre-split pattern (fixed value: behaviour of the byte-level vocabulary
# trainer the reference uses). Java flavour; (?U) makes \s Unicode-aware.
PRESPLIT_PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# ---------------------------------------------------------------------------

_REGEX_META = set(".^$*+?()[]{}|\\")


def regex_escape(s: str) -> str:
    """Escape a literal for both Java regex and RE2."""
    return "".join("\\" + ch if ch in _REGEX_META else ch for ch in s)


def specials_alternation(specials=ALL_SPECIAL_TOKENS) -> str:
    return "|".join(regex_escape(s) for s in sorted(specials, key=len, reverse=True))


def code_hex(code: int) -> str:
    if not 0 <= code < 1 << (4 * DIGITS):
        raise ValueError(f"code {code} has no {DIGITS}-digit form")
    return CODE_FORMAT % code


def pair_text(left: int, right: int) -> str:
    return code_hex(left) + code_hex(right)


# --- column helpers ----------------------------------------------------------

def utf8_codes(text: Column) -> Column:
    """Text -> code text of its UTF-8 bytes (' 000XX' per byte)."""
    return F.regexp_replace(F.hex(F.encode(text, "UTF-8")), "(..)", " " + "0" * (DIGITS - 2) + "$1")


def n_tokens(code_text: Column) -> Column:
    return (F.length(code_text) / TOKEN_WIDTH).cast("int")


def truncate_codes(code_text: Column, n: Column | int) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.substring(code_text, F.lit(1), n * TOKEN_WIDTH)


def codes_array(code_text: Column) -> Column:
    """Code text -> ARRAY<INT> of internal codes."""
    parts = F.split(F.ltrim(code_text), " ")
    return F.when(code_text == "", F.array().cast("array<int>")).otherwise(
        F.transform(parts, lambda x: F.conv(x, 16, 10).cast("int")))


def alphabet_rank(b: Column) -> Column:
    """Rank of byte b's byte-level symbol among all 256 symbols (rule, not a table)."""
    return (F.when(b <= 32, b + 188)
            .when(b <= 126, b - 33)
            .when(b <= 160, b + 94)
            .when(b <= 172, b - 67)
            .when(b == 173, F.lit(255))
            .otherwise(b - 68))


def code_to_id(c: Column, layout: str = "production", n_special: int = len(ALL_SPECIAL_TOKENS)) -> Column:
    if layout == "teaching":
        return c
    return (F.when(c >= SPECIAL_BASE, c - SPECIAL_BASE)
            .when(c >= MERGE_BASE, c - MERGE_BASE + (n_special + 256))
            .otherwise(alphabet_rank(c) + n_special))


def codes_to_ids(code_text: Column, layout: str = "production",
                 n_special: int = len(ALL_SPECIAL_TOKENS)) -> Column:
    return F.transform(codes_array(code_text), lambda c: code_to_id(c, layout, n_special))


def alphabet_rank_sql(b: str) -> str:
    return (f"(CASE WHEN {b} <= 32 THEN {b} + 188 WHEN {b} <= 126 THEN {b} - 33 "
            f"WHEN {b} <= 160 THEN {b} + 94 WHEN {b} <= 172 THEN {b} - 67 "
            f"WHEN {b} = 173 THEN 255 ELSE {b} - 68 END)")


def code_to_id_sql(c: str, n_special: int = len(ALL_SPECIAL_TOKENS)) -> str:
    return (f"(CASE WHEN {c} >= {SPECIAL_BASE} THEN {c} - {SPECIAL_BASE} "
            f"WHEN {c} >= {MERGE_BASE} THEN {c} - {MERGE_BASE} + {n_special + 256} "
            f"ELSE {alphabet_rank_sql(c)} + {n_special} END)")


def special_code_text(specials=ALL_SPECIAL_TOKENS) -> Column:
    """Map literal: special spelling -> its code text."""
    kv = []
    for i, s in enumerate(specials):
        kv += [F.lit(s), F.lit(code_hex(SPECIAL_BASE + i))]
    return F.create_map(*kv)
