"""13. Filter interaction audit: what each of five filters removes, in every order.

Failure conditions of a document (null text counts as empty; words are maximal runs of
``[^\\x20\\x09-\\x0D]``): A, under 100 words; B, 100 * distinct words < 80 * words; C, 100 * capitals
``[A-Z]`` > 10 * code points; D, one of ``#$%&*|`` occurs; E, the text equals that of any smaller
doc_id, removed or not.

E is an existential self-join: a document is marked by a left-semi join on hash, exact text
and smaller doc_id. Only texts whose hash occurs under two ids take part, and the right side
is pre-aggregated to one row per text, repeated once for every ``SPREAD`` copies, among which these
are dealt out; so a group of copies costs a row each, however large, and lies in no one task.
The marked ids are united with the failures of the other filters and grouped by document to
a combination of bits. Everything else follows from the number of documents per part and
combination, at most 32 rows a part: a filter removes in an order what fails it and none of
the filters before it.

Defined results: a null lang is the part ``''``; a null doc_id is never a copy and marks none;
each repeated row is a document of its own, and rows of one doc_id never mark each other; a
label of 1 in any row of ``labels`` for an id holds, null labels hold nothing; an empty table
gives no rows; a document of no words fails A alone of A to D; further columns are ignored.
"""

from __future__ import annotations

import itertools
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.session import shared_path

LETTERS = "ABCDE"
ORDERS = ["".join(p) for p in itertools.permutations(LETTERS)]
#: Hashes of repeated texts that may be broadcast: at most so many rows of 24 bytes.
TWINS_BROADCAST = 250_000
#: Copies of one text that are compared in one place, and places that a hash has if it is not broadcast.
SPREAD, SALTS = 128, 16


def failures(text: Column) -> dict[str, Column]:
    """The conditions of the filters that look at one document."""
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")
    n = F.size(words)
    return {
        "A": n < 100,
        "B": F.size(F.array_distinct(words)) * 100 < n * 80,
        "C": F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * 10,
        "D": text.rlike("[#$%&*|]"),
    }


def _bit(letter: str) -> int:
    return 1 << LETTERS.index(letter)


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
                       text.alias("text"), F.unhex(F.md5(text)).alias("digest"))


def marked_copies(docs: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """(doc_id, part, digest) of each row whose text equals that of a smaller doc_id.

    ``seen`` may hold (doc_id, digest) of all rows, if they are written already."""
    rows = _rows(docs)
    spark = docs.sparkSession
    path = shared_path(spark, f"twins-{uuid.uuid4().hex}")
    ((rows if seen is None else seen).groupBy("digest").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"))
     .where("low < high").select("digest", F.ceil(F.col("n") / SPREAD).alias("places")).write.parquet(path))
    twins = spark.read.parquet(path)
    # a row's own place in its partition deals copies out, also rows that are repeated in full
    rows = rows.withColumn("deal", F.xxhash64("doc_id", F.monotonically_increasing_id()))
    if twins.count() <= TWINS_BROADCAST:
        rows = rows.join(F.broadcast(twins), "digest")
    else:
        salted = twins.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        rows = rows.withColumn("salt", F.pmod("deal", F.lit(SALTS))).join(salted, ["digest", "salt"]).drop("salt")
    rows = rows.withColumn("place", F.pmod("deal", "places"))
    texts = (rows.groupBy("digest", "text", "places").agg(F.min("doc_id").alias("low"))
             .withColumn("place", F.explode(F.sequence(F.lit(0).cast("long"), F.col("places") - 1))))
    left, right = rows.alias("l"), texts.alias("r")
    same = ((F.col("l.digest") == F.col("r.digest")) & (F.col("l.text") == F.col("r.text")) & (F.col("l.place") == F.col("r.place"))
            & (F.col("r.low") < F.col("l.doc_id")))
    return left.join(right, same, "left_semi").select("doc_id", "part", "digest")


def combinations(docs: DataFrame) -> DataFrame:
    """doc_id, part, fails (letters) and n, the number of such rows, for every document."""
    path = shared_path(docs.sparkSession, f"failures-{uuid.uuid4().hex}")
    bits = sum((F.when(c, _bit(k)).otherwise(0) for k, c in failures(F.col("text")).items()), F.lit(0))
    _rows(docs).select("doc_id", "part", "digest", bits.alias("bits"), F.lit(1).cast("long").alias("n")).write.parquet(path)
    own = docs.sparkSession.read.parquet(path)
    copies = marked_copies(docs, own).withColumn("bits", F.lit(_bit("E"))).withColumn("n", F.lit(0).cast("long"))
    found = own.unionByName(copies).groupBy("doc_id", "part", "digest").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    fails = F.concat(*(F.when(F.col("bits").bitwiseAND(_bit(k)) != 0, k).otherwise("") for k in LETTERS))
    return found.select("doc_id", "part", fails.alias("fails"), "n")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter_order (all 120) and step (1 to 5)."""
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    counts = (combinations(docs).join(marks, "doc_id", "left").groupBy("part", "fails")
              .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
                   F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic")))
    steps = (counts.withColumn("filter_order", F.explode(F.array(*map(F.lit, ORDERS))))
             .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS))))))
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    before = F.substring("filter_order", F.lit(1), F.col("step") - 1)
    steps = (steps.withColumn("own", F.contains("fails", letter))
             .withColumn("gone", F.length(F.call_function("translate", before, F.col("fails"), F.lit(""))) < F.length(before)))
    # a document that fails k filters is removed by each of them in 120 / k of the orders
    share = F.expr(f"{len(ORDERS)} div nullif(length(fails), 0)")
    here = F.col("own") & ~F.col("gone")

    def total(count: Column, of: Column) -> Column:
        return F.sum(F.when(of, count).otherwise(0)).cast("long")
    return steps.groupBy("part", "filter_order", "step").agg(
        total(F.col("n"), ~F.col("own") & ~F.col("gone")).alias("kept"),
        total(F.col("n"), here).alias("removed"),
        total(F.col("n"), F.col("own") & F.col("gone")).alias("redundant"),
        total(F.col("n"), F.col("fails") == letter).alias("unique_fails"),
        total(F.col("good"), here).alias("good_lost"),
        total(F.col("toxic"), here).alias("toxic_lost"),
        total(F.col("n") * share, F.col("own")).alias("shapley"))


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS low FROM d),
f AS (SELECT doc_id, part, len(words) < 100 AS A, 100 * len(list_distinct(words)) < 80 * len(words) AS B,
        100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) AS C, regexp_matches(t, '[#$%&*|]') AS D,
        coalesce(low < doc_id, false) AS E FROM w),
m AS (SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, {" || ".join(f"CASE WHEN {k} THEN '{k}' ELSE '' END" for k in LETTERS)} AS fails,
        count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM f LEFT JOIN m USING (doc_id) GROUP BY ALL),
o AS (SELECT unnest([{", ".join(f"'{x}'" for x in ORDERS)}]) AS filter_order),
s AS (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM o),
x AS (SELECT *, contains(fails, filter_order[step]) AS own, translate(filter_order[1:step - 1], fails, '') <> filter_order[1:step - 1] AS gone FROM c, s),
r AS (SELECT part, filter_order, step, coalesce(sum(n) FILTER (NOT own AND NOT gone), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (own AND NOT gone), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (own AND gone), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (fails = filter_order[step]), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (own AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (own AND NOT gone), 0)::BIGINT AS toxic_lost
      FROM x GROUP BY ALL)
SELECT *, (sum(removed) OVER (PARTITION BY part, filter_order[step]))::BIGINT AS shapley FROM r"""
