"""Derived inputs: the driver's tables reshaped into the inputs the
reference's operators take. Every rule here has a twin in :mod:`weft.plans.sqlkit`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.chat import EMPTY_THINK
from ..operators.ordering import ordered_index
from ..operators.toolcalls import TOOL_SPEC_JSON
from ..sources.readers import load_table, spread

SEQ_LEN = 16          # events per logged sequence
GROUP_SIZE = 6        # generations per prompt group (E7)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    df = load_table(spark, d, name)
    return spread(df) if name == "documents" else df


def turns(spark: SparkSession, d: str) -> DataFrame:
    """Conversation turns with derived tools (system turns of even conversations carry
    two catalogue tools) and derived empty reasoning blocks (assistant turns of
    conversations with conv_id % 4 = 1 start with one)."""
    c = table(spark, d, "conversations")
    specs = F.array(*[F.lit(s) for s in TOOL_SPEC_JSON])
    n = len(TOOL_SPEC_JSON)
    tools = F.concat(F.lit("["), F.element_at(specs, (F.col("conv_id") % n + 1).cast("int")), F.lit(", "),
                     F.element_at(specs, ((F.col("conv_id") + 1) % n + 1).cast("int")), F.lit("]"))
    return c.select(
        "conv_id", "turn", "role",
        F.when((F.col("role") == "assistant") & (F.col("conv_id") % 4 == 1),
               F.concat(F.lit(EMPTY_THINK), F.col("text"))).otherwise(F.col("text")).alias("content"),
        F.when((F.col("role") == "system") & (F.col("conv_id") % 2 == 0), tools).alias("tools"))


def messages(spark: SparkSession, d: str) -> DataFrame:
    """A10 over the derived turns: (conv_id, messages) in turn order."""
    t = turns(spark, d)
    msg = F.struct(F.col("turn").alias("o"), "role", "content", "tools")
    g = t.groupBy("conv_id").agg(F.array_sort(F.collect_list(msg)).alias("_m"))
    return g.select("conv_id", F.transform("_m", lambda m: F.struct(
        m["role"].alias("role"), m["content"].alias("content"),
        F.lit(None).cast("string").alias("reasoning_content"), m["tools"].alias("tools"),
        F.lit(None).cast("string").alias("tool_calls"))).alias("messages"))


def pairs(spark: SparkSession, d: str) -> DataFrame:
    """Preference pairs: chosen = a conversation ending in an assistant turn; rejected =
    the same messages with the last reply replaced by the conversation's first user
    turn (an echo), or '' when there is none. Local to one conversation: no shuffle
    beyond A10's."""
    m = messages(spark, d).where(F.element_at("messages", -1)["role"] == "assistant")
    simple = F.transform("messages", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    echo = F.coalesce(F.try_element_at(F.filter("messages", lambda x: x["role"] == "user"), F.lit(1))["content"],
                      F.lit(""))
    head = F.slice(simple, 1, F.size("messages") - 1)
    rejected = F.concat(head, F.array(F.struct(F.lit("assistant").alias("role"), echo.alias("content"))))
    return m.select(F.col("conv_id").alias("pair_id"), simple.alias("chosen"), rejected.alias("rejected"))


# Fenced tool-call blocks appended to replies, by conv_id % 6 (fixed test inputs).
TOOL_BLOCKS = (
    '```json\n{"name": "get_current_weather", "arguments": {"location": "北京"}}\n```',
    '```json\n{"name": "unit_converter", "arguments": {"value": 10, "from_unit": "km", "to_unit": "miles"}}\n```'
    ' then ```json {"name": "get_exchange_rate", "arguments": {"from_currency": "USD", "to_currency": "CNY"}} ```',
    "no tool needed",
    '```json\n{"name": "get_current_time", "arguments": {\n```',
    '```json\n[{"name": "translate_text"}]\n```',
    '```json\n{"arguments": {}}\n``` and ```json\n{"name": "search_web", "arguments": {"q": "x"}}\n```'
    ' and ```json\n{"name": "translate_text", "arguments": {"text": "Good morning", "target_language": "chinese"}}\n```'
    ' and ```json\n{"name": "get_current_time", "arguments": {"timezone": "Europe/London"}}\n```'
    ' and ```json\n{"name": "unit_converter", "arguments": {"value": 3.5, "from_unit": "KG", "to_unit": "Pounds"}}\n```',
    "```json\n{'name': 'get_current_weather'}\n```",
    '```json\n{"name": "get_current_weather"} trailing\n```',
    '```json\n{"name": "get_current_weather"} {\n```',
    '```json\n{"name": "get_current_weather",}\n```',
    '```json\n{"name": "x", "name": "get_current_time"}\n```',
    '```json\n{"name": "get_current_time", "v": NaN}\n```',
)


def tool_responses(spark: SparkSession, d: str) -> DataFrame:
    """Tool-use replies: every assistant turn plus a fenced block chosen by conv_id;
    gt = the reply's first word (hit), whitespace only, a miss, or NULL by conv_id % 4."""
    c = table(spark, d, "conversations").where(F.col("role") == "assistant")
    blocks = F.array(*[F.lit(b) for b in TOOL_BLOCKS])
    response = F.concat(F.col("text"), F.lit("\n"),
                        F.element_at(blocks, (F.col("conv_id") % len(TOOL_BLOCKS) + 1).cast("int")))
    gt = (F.when(F.col("conv_id") % 4 == 0, F.split_part(F.col("text"), F.lit(" "), F.lit(1)))
          .when(F.col("conv_id") % 4 == 1, F.lit("  "))
          .when(F.col("conv_id") % 4 == 2, F.lit("zzqx"))
          .otherwise(F.lit(None).cast("string")))
    return c.select("conv_id", "turn", response.alias("response"), gt.alias("gt"))


def logits(spark: SparkSession, d: str) -> DataFrame:
    """Logit rows: each embedding is the 64-token logit vector of one position;
    (row_id, token_id, logit DOUBLE)."""
    e = table(spark, d, "embeddings")
    return e.select(F.col("vec_id").alias("row_id"),
                    F.posexplode("embedding").alias("token_id", "logit")
                    ).select("row_id", F.col("token_id").cast("int").alias("token_id"),
                             F.col("logit").cast("double").alias("logit"))


def token_logs(spark: SparkSession, d: str) -> DataFrame:
    """Per-token training logs from events: per user in time order, cut into sequences of
    16; log-probs, values, rewards and masks are fixed arithmetic on value and props.k."""
    ev = table(spark, d, "events").select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"))
    ev = ordered_index(ev, ["user_id"], ["ts", "event_id"], "rn")
    k = F.col("k")
    policy = -F.log(F.lit(1.0) + F.col("value") / 10.0)
    return ev.select(
        "user_id", "event_id", "ts", "event_type", "value", "k", "rn",
        F.floor((F.col("rn") - 1) / SEQ_LEN).cast("bigint").alias("seq_no"),
        ((F.col("rn") - 1) % SEQ_LEN).cast("int").alias("pos"),
        policy.alias("policy_logp"),
        (-F.log(F.lit(1.0) + k / 10.0)).alias("ref_logp"),
        (policy + ((k % 5) - 2) / 20.0).alias("old_logp"),
        F.when(F.col("event_type") == "error", 0).otherwise(1).alias("mask"),
        F.when(F.col("event_type") == "purchase", 1.0).when(F.col("event_type") == "signup", 0.5)
        .otherwise(0.0).alias("reward"),
        (k / 100.0).alias("v_est"),
        (k / 100.0 + ((k % 3) - 1) / 10.0).alias("old_v"))

