"""URL filter: a trie over reversed host labels, each node with a trie over path segments.

The trie is a broadcast value. Its size is bounded by MAX_RULES and checked; it
does not grow with the pages. Of all rules that fit a URL the longest rule
string wins; at equal length the longer host, then block before allow.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_RULES = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str  # from the first slash on

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def rank(self) -> tuple:
        return len(self.text), len(self.host), self.verdict == "block"


def parse_rule(line: str) -> Rule:
    """``block example.com/en/`` as a rule; the ASCII letters of its host are lower-cased, as those of URLs are."""
    verdict, _, where = line.strip().partition(" ")
    host, slash, path = where.strip().partition("/")
    if verdict not in ("allow", "block"):
        raise ValueError(f"a rule starts with allow or block: {line!r}")
    return Rule(verdict, host.translate(str.maketrans(UPPER, LOWER)), slash + path)


def build_trie(rules: Sequence[Rule]) -> dict:
    """Nodes are dictionaries: ``next`` label or segment to node, ``paths`` a path trie, ``ends`` path tail to rule."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the broadcast trie takes at most {MAX_RULES}")
    root: dict = {"next": {}}
    for rule in rules:
        node = root
        for label in reversed(rule.host.split(".")):
            node = node["next"].setdefault(label, {"next": {}})
        place = node.setdefault("paths", {"next": {}})
        *whole, tail = rule.path.split("/")
        for segment in whole:
            place = place["next"].setdefault(segment, {"next": {}})
        ends = place.setdefault("ends", {})
        place.setdefault("sizes", set()).add(len(tail))
        if tail not in ends or rule.rank > ends[tail].rank:
            ends[tail] = rule
    return root


def lookup(trie: dict, host: str, path: str) -> Rule | None:
    """The winning rule, or None."""
    best, node, segments = None, trie, path.split("/")
    for label in reversed(host.split(".")):
        node = node["next"].get(label)
        if node is None:
            break
        place = node.get("paths")
        for segment in segments if place else ():
            for size in place.get("sizes", ()):
                rule = place["ends"].get(segment[:size]) if size <= len(segment) else None
                if rule is not None and (best is None or rule.rank > best.rank):
                    best = rule
            place = place["next"].get(segment)
            if place is None:
                break
    return best


def host_and_path(url):
    """Columns host and path of a URL: empty for NULL and for text without ``://``.

    The host ends at the first of / ? # and has its ASCII letters lower-cased;
    the path ends at ? or #.
    """
    text = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def judge_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url", keys: Sequence[str] = ("page_id",),
               default: str = "allow") -> DataFrame:
    """keys, host, path, rule (NULL if none fits) and verdict of every row.

    Rows are kept as they are, repeated ones and NULL keys too; other columns
    are left out. NULL and empty URLs have an empty host and path, and the
    default verdict unless a rule fits those. Every row costs one walk down the trie.
    """
    shared = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def judge(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        found = [lookup(shared.value, h, p) for h, p in zip(hosts, paths, strict=True)]
        return pd.DataFrame({"rule": [r.text if r else None for r in found],
                             "verdict": [r.verdict if r else default for r in found]}, dtype=object)

    host, path = host_and_path(F.col(url))
    parts = pages.select(*keys, host.alias("host"), path.alias("path"))
    return (parts.select("*", judge("host", "path").alias("_judged"))
            .select(*keys, "host", "path", "_judged.rule", "_judged.verdict"))
