"""URL filters: a trie over reversed host labels and path segments with longest-match precedence.

A rule is a host with a path prefix. It fits its host and every subdomain of it when the url's path
starts with the rule's path. Of the fitting rules the longest decides: the one with more host labels,
then the one with the longer path, then block before allow.

The rules are cut into blocks of at most ``BLOCK_RULES``; each block's trie is broadcast for its own
pass and the best match so far is carried along, so no broadcast grows with the rule list and a longer
list only adds passes (maps without a shuffle).

Defined results: a null url, or one without ``://``, has an empty host and path and meets no rule; an
empty path meets only rules whose path is empty; no rules or an empty table are fine; repeated rows give
repeated results; other columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentiflow.llm.common import ascii_lower, read_table

BLOCK_RULES = 100_000
MATCH = "rule string, verdict string, labels int, path_chars int"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @classmethod
    def parse(cls, verdict: str, text: str) -> Rule:
        """``Rule.parse("block", "example.com/de/")``; the path begins at the first slash."""
        cut = text.find("/")
        return cls(verdict, text, "") if cut < 0 else cls(verdict, text[:cut], text[cut:])

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule.parse("block", "net/"),
    Rule.parse("allow", "example.net/en/"),
    Rule.parse("block", "example.com/de/"),
    Rule.parse("allow", "org/fr/"),
)


class RuleTrie:
    """Reversed host labels lead to a node; below it whole path segments lead on, and a last partial segment is a prefix."""

    def __init__(self, rules):
        self.root = {}
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.lower().split(".")):
                node = node.setdefault(label, {})
            segments = rule.path.split("/")
            node = node.setdefault("/paths", {})  # a label holds no slash, so this key is free
            for segment in segments[:-1]:
                node = node.setdefault(segment, {})
            tails = node.setdefault("/tails", {})
            found = tails.get(segments[-1])
            if found is None or (rule.verdict, found.verdict) == ("block", "allow"):
                tails[segments[-1]] = rule

    def longest(self, host: str, path: str) -> tuple[Rule, int] | None:
        """The deciding rule and its number of host labels."""
        best, node, segments = None, self.root, None
        for depth, label in enumerate(reversed(host.split(".")), 1):
            node = node.get(label)
            if node is None:
                break
            if "/paths" in node:
                if segments is None:
                    segments = path.split("/")
                rule = self._by_path(node["/paths"], segments)
                if rule:
                    best = rule, depth
        return best

    @staticmethod
    def _by_path(node: dict, segments: list[str]) -> Rule | None:
        best = None
        for i, segment in enumerate(segments):
            tails = node.get("/tails", {})
            if tails:
                for n in range(len(segment), -1, -1):
                    if segment[:n] in tails:
                        best = tails[segment[:n]]
                        break
            if i + 1 == len(segments) or segment not in node:
                break
            node = node[segment]
        return best


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def _longest_of(trie):
    """Column function (host, path) -> the longest fitting rule of a broadcast trie."""

    @F.pandas_udf(MATCH)
    def longest(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        find = trie.value.longest
        found = [find(h, p) for h, p in zip(host, path)]
        rows = [(m[0].text, m[0].verdict, m[1], len(m[0].path)) if m else (None, None, None, None) for m in found]
        return pd.DataFrame(rows, columns=["rule", "verdict", "labels", "path_chars"]).astype(
            {"labels": "Int32", "path_chars": "Int32"}
        )

    return longest


def judge_urls(
    pages: DataFrame,
    rules=RULES,
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
    block_rules: int = BLOCK_RULES,
) -> DataFrame:
    """(id, host, path, rule, verdict) of every row; ``verdict`` is ``default`` where no rule fits."""
    spark = pages.sparkSession
    out = pages.select(
        F.col(id_col).alias("page_id"),
        url_host(F.col(url_col)).alias("host"),
        url_path(F.col(url_col)).alias("path"),
        F.lit(None).cast(f"struct<{MATCH}>").alias("best"),
    )
    rules = list(rules)
    for start in range(0, len(rules), block_rules):
        longest = _longest_of(spark.sparkContext.broadcast(RuleTrie(rules[start : start + block_rules])))
        order = lambda m: F.struct(m["labels"], m["path_chars"], m["verdict"])  # noqa: E731  "block" sorts above "allow"
        out = out.withColumn("now", longest("host", "path"))
        better = F.col("now")["rule"].isNotNull() & (
            F.col("best").isNull() | (order(F.col("now")) > order(F.col("best")))
        )
        out = out.withColumn("best", F.when(better, F.col("now")).otherwise(F.col("best"))).drop("now")
    return out.select(
        "page_id",
        "host",
        "path",
        F.col("best")["rule"].alias("rule"),
        F.coalesce(F.col("best")["verdict"], F.lit(default)).alias("verdict"),
    )


def op5_url_filter(spark, sf_dir):
    return judge_urls(read_table(spark, sf_dir, "pages"))


ORACLE_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), j AS (
  SELECT page_id, host, path,
         CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
              WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
              WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
              WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM h
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM j
"""
