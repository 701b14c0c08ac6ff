"""URL filter: a trie over reversed host labels and path segments with longest-match precedence."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: (verdict, host, path): the rule covers the host and its subdomains where the url's path starts with path.
Rule = tuple[str, str, str]
#: Rules that are broadcast to every executor at most; more are refused rather than dropped.
MOST_RULES = 1_000_000
#: The verdict where no rule fits.
DEFAULT = "allow"


class UrlTrie:
    """Host labels from the right, then path segments from the left.

    A rule's last path segment may end in the middle of a url's segment, so each node keeps the rules that end below
    it by that partial segment, and the lengths of these. A url's segment is looked up once for each length.
    """

    def __init__(self, rules: Sequence[Rule]):
        if len(rules) > MOST_RULES:
            raise ValueError(f"{len(rules)} rules; at most {MOST_RULES} can be broadcast")
        self.hosts: dict = {}
        for verdict, host, path in rules:
            node = self.hosts
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            *whole, last = path.split("/")
            node = node.setdefault("/", {"segments": {}, "ends": {}, "lengths": set()})  # "/" is no host label
            for segment in whole:
                node = node["segments"].setdefault(segment, {"segments": {}, "ends": {}, "lengths": set()})
            old = node["ends"].get(last)
            # of a rule given twice with both verdicts, block stays
            if old is None or old[0] == "allow":
                node["ends"][last] = (verdict, host + path)
                node["lengths"].add(len(last))

    def match(self, host: str, path: str) -> tuple[str | None, str]:
        """The longest rule that fits (host and path together) and its verdict."""
        found, size, segments = None, -1, path.split("/")
        node = self.hosts
        for label in [None, *reversed(host.split("."))]:
            if label is not None:
                node = node.get(label) if label != "/" else None
                if node is None:
                    break
            here = node.get("/")
            for segment in segments if here else ():
                for n in here["lengths"]:
                    end = here["ends"].get(segment[:n]) if n <= len(segment) else None
                    if end is not None and len(end[1]) > size:
                        found, size = (end[1], end[0]), len(end[1])
                here = here["segments"].get(segment)
                if here is None:
                    break
        return found or (None, DEFAULT)


def split_url(url) -> tuple:
    """Columns host and path of a url column; both empty without :// or if null."""
    after = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + F.lit(3), F.length(url))).otherwise(F.lit(""))
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path


def judge_urls(pages: DataFrame, rules: Sequence[Rule], url_col: str = "url") -> DataFrame:
    """Every row of pages with host, path, rule and verdict.

    The longest rule that fits wins, counted over host and path together; of equally long ones, that of the shorter
    host; of the same rule as allow and block, block does. Without a fitting rule, rule is null and the verdict DEFAULT.
    Null urls and urls without :// have empty host and path and fit no rule; urls are read whole, however long.
    Repeated rows are judged each; an empty table gives an empty result. Columns of pages called host, path, rule or
    verdict give way to the results.
    """
    spark = pages.sparkSession
    made = {"host", "path", "rule", "verdict"}
    trie = spark.sparkContext.broadcast(UrlTrie(rules))  # at most MOST_RULES rules

    @F.pandas_udf("rule string, verdict string")
    def judge(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        match = trie.value.match
        for hosts, paths in parts:
            yield pd.DataFrame([match(h, p) for h, p in zip(hosts, paths, strict=True)], columns=["rule", "verdict"])

    host, path = split_url(pages[f"`{url_col}`"])
    others = [pages[f"`{c}`"] for c in pages.columns if c.lower() not in made]
    out = pages.select(*others, host.alias("host"), path.alias("path"))
    names = [F.col(f"`{c}`") for c in out.columns]
    return out.select(*names, judge("host", "path").alias("judged")).select(*names, "judged.rule", "judged.verdict")
