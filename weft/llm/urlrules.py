"""11. URL filters: a broadcast trie over reversed host labels and path segments.

A rule is (host, path, verdict). It fits its host and all subdomains where the url's path
starts with the rule's path. Of all rules that fit, the longest text ``host + path`` wins; of
equally long ones the longer host; of an allow and a block entry with the same host and path
the block entry. A url that no rule fits gets the verdict ``default``.

The trie is walked from the last host label to the first; every node may hold a second trie,
of path segments (each with its closing ``/``), where the last segment of a rule may be open
(``/en`` fits ``/enter``). Rule lists of at most ``TRIE_BYTES`` of text are broadcast as a trie;
longer ones are joined: each distinct url asks for its host suffixes and folders, as deep as
the rules go, in a salted join.

Defined results: the host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with
A-Z lower-cased, port and user included; the path goes on up to ``?``, ``#`` or the end; a null
url, or one without ``://``, has an empty host and path; an empty table gives no rows; repeated
rows and null ids are judged row by row; further columns are ignored by ``judge`` and kept by
``keep_allowed``. A rule with an empty host fits every host. A null or unknown verdict, or a
null host or path of a rule, is an error.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The list that the query applies: (host, path, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
DEFAULT = "allow"
TRIE_BYTES = 4 << 20
SALTS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = "://([^/?#]*)([^?#]*)"
RULE_SCHEMA = "host string, path string, verdict string"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


class Trie:
    """Rules by reversed host labels, then by path segments."""

    def __init__(self, rules):
        self.root: dict = {}
        for host, path, verdict in rules:
            node = self.root
            for label in reversed(host.split(".")) if host else ():
                node = node.setdefault(label, {})
            # the key "." cannot be a label: it holds the paths of the rules of this host
            node = node.setdefault(".", {})
            *folders, open_end = _segments(path)
            for segment in folders:
                node = node.setdefault(segment, {})
            # the key "" cannot be a segment: it holds the rules that end in this folder
            ends = node.setdefault("", {})
            if ends.get(open_end, ("", "allow"))[1] == "allow":
                ends[open_end] = (host + path, verdict)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits."""
        segments = _segments(path)
        found = _deepest(self.root.get("."), segments)
        node = self.root
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            own = _deepest(node.get("."), segments)
            if own and (found is None or len(own[0]) >= len(found[0])):
                found = own
        return found


def _segments(path: str) -> list[str]:
    """Segments with their closing slash, then the open rest (perhaps empty)."""
    parts = path.split("/")
    return [p + "/" for p in parts[:-1]] + parts[-1:]


def _deepest(node: dict | None, segments: list[str]) -> tuple[str, str] | None:
    found = None
    for segment in segments:
        if node is None:
            break
        ends = node.get("")
        if ends:
            fits = [e for e in ends if segment.startswith(e)]
            if fits:
                found = ends[max(fits, key=len)]
        node = node.get(segment)
    return found


def _rules_table(pages: DataFrame, rules) -> DataFrame:
    if not isinstance(rules, DataFrame):
        rules = pages.sparkSession.createDataFrame(list(rules), RULE_SCHEMA)
    rules = rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
    bad = rules.where(F.col("host").isNull() | F.col("path").isNull() | ~F.coalesce(F.col("verdict").isin("allow", "block"), F.lit(False)))
    if bad.limit(1).count():
        raise ValueError(f"not a rule: {bad.first()}")
    return rules


def judge(pages: DataFrame, rules=RULES, default: str = DEFAULT, id_col: str = "page_id", url_col: str = "url",
          trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """id_col, host, path, rule (null where none fits) and verdict of every row."""
    urls = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    table = _rules_table(pages, rules)
    size = table.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 16)).first()[0] or 0
    if size > trie_bytes:
        return _by_join(urls, table, default, id_col)
    out = _by_trie(urls, table, default)
    return out.select(id_col, "host", "path", F.col("judged.rule").alias("rule"), F.col("judged.verdict").alias("verdict"))


def _by_trie(urls: DataFrame, table: DataFrame, default: str) -> DataFrame:
    trie = urls.sparkSession.sparkContext.broadcast(Trie([tuple(r) for r in table.collect()]))

    @F.pandas_udf("rule string, verdict string")
    def look_up(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        find = trie.value.find
        return pd.DataFrame([find(h, p) or (None, default) for h, p in zip(host, path)], columns=["rule", "verdict"], dtype=object)
    return urls.withColumn("judged", look_up("host", "path"))


def _by_join(urls: DataFrame, table: DataFrame, default: str, id_col: str) -> DataFrame:
    """The same verdicts, for rule lists too long to broadcast."""
    folder = F.regexp_extract("path", "^(.*/)?", 0)
    rules = table.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).select(
        F.col("host").alias("k_host"), folder.alias("k_folder"), F.concat("host", "path").alias("rule"), "verdict",
        F.col("path").alias("k_path"), F.length("host").alias("k_length"))
    deep = rules.agg(F.max(F.size(F.split("k_host", "[.]"))), F.max(F.size(F.split("k_folder", "/")))).first()
    labels, parts = F.reverse(F.split("host", "[.]")), F.split("path", "/")
    hosts = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deep[0]))),
                        lambda i: F.array_join(F.reverse(F.slice(labels, 1, i)), "."))
    folders = F.transform(F.sequence(F.lit(0), F.least(F.size(parts), F.lit(deep[1])) - 1),
                          lambda i: F.when(i == 0, "").otherwise(F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/"))))
    asked = (urls.select("host", "path").distinct().withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)))
             .withColumn("k_host", F.explode(F.array_distinct(F.concat(F.array(F.lit("")), hosts))))
             .withColumn("k_folder", F.explode(folders)))
    salted = rules.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    found = (asked.join(salted, ["k_host", "k_folder", "salt"]).where(F.startswith("path", "k_path"))
             .groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "k_length", "rule", "verdict")).alias("best")))
    return urls.join(found, ["host", "path"], "left").select(
        id_col, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def keep_allowed(pages: DataFrame, rules=RULES, default: str = DEFAULT, url_col: str = "url") -> DataFrame:
    """The rows whose url is allowed, with all their columns. Rules must fit ``TRIE_BYTES``."""
    table = _rules_table(pages, rules)
    size = table.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 16)).first()[0] or 0
    if size > TRIE_BYTES:
        raise ValueError(f"{size} bytes of rules: judge the urls, then join the verdicts by id")
    spot = "url_rule"
    while spot.lower() in {c.lower() for c in pages.columns}:
        spot += "_"
    urls = pages.withColumn(spot, F.struct(host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")))
    trie = pages.sparkSession.sparkContext.broadcast(Trie([tuple(r) for r in table.collect()]))

    @F.pandas_udf("boolean")
    def allowed(host: pd.Series, path: pd.Series) -> pd.Series:
        find = trie.value.find
        return pd.Series([(find(h, p) or (None, default))[1] == "allow" for h, p in zip(host, path)], dtype=bool)
    return urls.where(allowed(F.col(f"{spot}.host"), F.col(f"{spot}.path"))).drop(spot)


_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
ORACLE = f"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {_VALUES}),
u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '{_PARTS}', 1), ''), '{UPPER}', '{LOWER}') AS host,
             coalesce(regexp_extract(url, '{_PARTS}', 2), '') AS path FROM pages),
best AS (SELECT host, path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                max_by(verdict, length(rule_host || rule_path)) AS verdict
         FROM (SELECT DISTINCT host, path FROM u) JOIN rules
           ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
         GROUP BY host, path)
SELECT page_id, u.host, u.path, rule, coalesce(verdict, '{DEFAULT}') AS verdict
FROM u LEFT JOIN best ON best.host = u.host AND best.path = u.path"""
