"""Tool-use evaluation and reward.

Tool calls are pulled out of reply text with a regex; the blocks found are parsed by
Python's JSON rules in an Arrow-batched UDF, because Spark's parser accepts texts that
those rules reject."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference): the tool catalogue.
TOOLS = [
    {"type": "function", "function": {"name": "calculate_math", "description": "计算数学表达式", "parameters": {"type": "object", "properties": {"expression": {"type": "string"}}, "required": ["expression"]}}},
    {"type": "function", "function": {"name": "unit_converter", "description": "单位换算", "parameters": {"type": "object", "properties": {"value": {"type": "number"}, "from_unit": {"type": "string"}, "to_unit": {"type": "string"}}, "required": ["value", "from_unit", "to_unit"]}}},
    {"type": "function", "function": {"name": "get_current_weather", "description": "获取天气", "parameters": {"type": "object", "properties": {"location": {"type": "string"}}, "required": ["location"]}}},
    {"type": "function", "function": {"name": "get_current_time", "description": "获取时间", "parameters": {"type": "object", "properties": {"timezone": {"type": "string", "default": "Asia/Shanghai"}}, "required": []}}},
    {"type": "function", "function": {"name": "get_exchange_rate", "description": "查询汇率", "parameters": {"type": "object", "properties": {"from_currency": {"type": "string"}, "to_currency": {"type": "string"}}, "required": ["from_currency", "to_currency"]}}},
    {"type": "function", "function": {"name": "translate_text", "description": "翻译文本", "parameters": {"type": "object", "properties": {"text": {"type": "string"}, "target_language": {"type": "string"}}, "required": ["text", "target_language"]}}},
]
CALL_PATTERN = r"(?sU)```json\s*(.*?)\s*```"
WORD_PATTERN = r"(?U)\w+|[^\w\s]"
CALLS = T.ArrayType(T.StructType([T.StructField("call_no", T.IntegerType()), T.StructField("name", T.StringType()),
                                  T.StructField("arguments", T.StringType())]))
# ---------------------------------------------------------------------------

TOOL_NAMES = tuple(t["function"]["name"] for t in TOOLS)
TOOL_SPEC_JSON = tuple(json.dumps(t, ensure_ascii=False) for t in TOOLS)


def catalogue(spark: SparkSession) -> DataFrame:
    """(name, description, parameters JSON, required ARRAY<STRING>)."""
    rows = [(t["function"]["name"], t["function"]["description"],
             json.dumps(t["function"]["parameters"], ensure_ascii=False),
             list(t["function"]["parameters"]["required"])) for t in TOOLS]
    return spark.createDataFrame(rows, "name STRING, description STRING, parameters STRING, required ARRAY<STRING>")


def ustrip(c: Column) -> Column:
    """Python str.strip(): remove Unicode whitespace at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def _parse(block: str) -> tuple[str | None, str | None] | None:
    """(name, arguments) of a call, by Python's own JSON rules (the last of repeated keys
    wins, NaN is a value, nothing may follow the object); None if it is no call."""
    try:
        call = json.loads(block.strip())
    except (ValueError, RecursionError):
        return None
    if not isinstance(call, dict) or "name" not in call:
        return None
    return tuple(v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False)
                 for v in (call["name"], call.get("arguments")))


@F.pandas_udf(CALLS)
def _calls(blocks: pd.Series) -> pd.Series:
    def row(texts):
        found = [(i, _parse(t)) for i, t in enumerate([] if texts is None else texts)]
        return [{"call_no": i, "name": c[0], "arguments": c[1]} for i, c in found if c is not None]
    return blocks.map(row)


def calls(response: Column) -> Column:
    """F1 as a column: (call_no, name, arguments) of the fenced json blocks of a reply that are
    objects with a ``name`` key (a null name counts), in order; bad JSON is skipped."""
    return _calls(F.regexp_extract_all(response, F.lit(CALL_PATTERN), 1))


def extract_calls(df: DataFrame, text_col: str, key_cols: list[str]) -> DataFrame:
    """one row per call of :func:`calls`. Only replies that hold a block reach Python."""
    some = df.where(F.contains(F.col(text_col), F.lit("```json")))
    return (some.select(*key_cols, F.explode(calls(F.col(text_col))).alias("_c"))
            .select(*key_cols, F.col("_c.call_no").alias("call_no"), F.col("_c.name").alias("name"),
                    F.col("_c.arguments").alias("arguments")))


def length_score(response: Column) -> Column:
    """+0.5 if the stripped length is within [20, 800], else -0.5."""
    n = F.length(ustrip(response))
    return F.when((n >= 20) & (n <= 800), F.lit(0.5)).otherwise(F.lit(-0.5))


def gt_in_text(gt: Column, response: Column) -> Column:
    """stripped, lower-cased answer is a substring of the lower-cased reply."""
    return F.contains(F.lower(response), ustrip(F.lower(gt)))


def repetition_penalty(response: Column, cap: float = 0.5) -> Column:
    """min(cap, repeated-3-gram share * 2 * cap) over \\w+|[^\\w\\s] tokens. The
    3-grams come from zipping the token list with itself shifted by one and two (no
    per-element re-evaluation of the token regex)."""
    toks = F.regexp_extract_all(F.lower(response), F.lit(WORD_PATTERN), 0)
    return F.aggregate(F.array(toks), F.lit(0.0), lambda acc, t: acc + _rep_from_tokens(t, cap))


def _rep_from_tokens(toks: Column, cap: float) -> Column:
    n = F.size(toks) - 2
    m = F.greatest(n, F.lit(0))
    ab = F.zip_with(F.slice(toks, 1, m), F.slice(toks, 2, m), lambda a, b: F.concat(a, F.lit("\u0001"), b))
    grams = F.zip_with(ab, F.slice(toks, 3, m), lambda x, c: F.concat(x, F.lit("\u0001"), c))
    rep = (n - F.size(F.array_distinct(grams))) * F.lit(cap * 2) / n
    return F.when(n > 0, F.least(F.lit(cap), rep)).otherwise(F.lit(0.0))


def rewards(spark: SparkSession, df: DataFrame, key_cols: list[str], response_col: str = "response",
            gt_col: str = "gt", cap: float = 0.5) -> DataFrame:
    """reward = length score + valid-tool bonus + answer bonus - repetition.
    Row-local: the calls of a reply come from its own text and the catalogue is a fixed
    list of six names, so no explode, join or shuffle is needed (F6 is the semi join
    of F1 with F2 written as a membership test)."""
    resp, gt = F.col(response_col), F.col(gt_col)
    staged = df.withColumn("_calls", calls(resp))
    names = F.transform("_calls", lambda c: c["name"])
    out = staged.select(*key_cols, F.size("_calls").cast("bigint").alias("n_calls"),
                        F.exists(names, lambda n: F.coalesce(n.isin(*TOOL_NAMES), F.lit(False))).alias("valid_tool"),
                        length_score(resp).alias("length_score"),
                        (F.coalesce(gt != "", F.lit(False)) & gt_in_text(gt, resp)).alias("gt_hit"),
                        repetition_penalty(resp, cap).alias("rep_penalty"))
    total = (F.col("length_score") + F.when(F.col("valid_tool"), 1.0).otherwise(0.0)
             + F.when(F.col("gt_hit"), 1.0).otherwise(0.0) - F.col("rep_penalty"))
    return out.withColumn("reward", total)
