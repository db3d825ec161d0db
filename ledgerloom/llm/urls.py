"""URL filter: a trie over reversed host labels and path segments, the longest rule wins."""

from __future__ import annotations

import string
from collections.abc import Iterable
from dataclasses import dataclass, field
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.stored import stored

RULE_BYTES = 64 * 2**20
MATCH = "host string, path string, rule string, verdict string"


class Rule(NamedTuple):
    """`verdict` is `allow` or `block`; the rule fits `host` and all its subdomains."""

    verdict: str
    host: str
    path: str


@dataclass
class _Node:
    """Children by label or segment; what ends here, by the start of the next segment."""

    children: dict[str, _Node] = field(default_factory=dict)
    paths: _Node | None = None
    ends: dict[str, tuple[str, str]] = field(default_factory=dict)


def build_trie(rules: Iterable[Rule]) -> _Node:
    """Host labels from the last to the first, then path segments; on equal keys `block` wins."""
    root = _Node()
    for verdict, host, path in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"verdict {verdict!r}")
        node = root
        for label in reversed(host.translate(_LOWER).split(".")):
            node = node.children.setdefault(label, _Node())
        node.paths = node.paths or _Node()
        *segments, last = path.split("/")
        place = node.paths
        for segment in segments:
            place = place.children.setdefault(segment, _Node())
        if place.ends.get(last, ("allow",))[0] == "allow":
            place.ends[last] = (verdict, host.translate(_LOWER) + path)
    return root


def _longest_path(paths: _Node, path: str) -> tuple[str, str] | None:
    found, place = None, paths
    for segment in path.split("/"):
        if place.ends:
            for size in range(len(segment), -1, -1):
                if segment[:size] in place.ends:
                    found = place.ends[segment[:size]]
                    break
        if (place := place.children.get(segment)) is None:
            break
    return found


def longest_match(trie: _Node, host: str, path: str) -> tuple[str, str] | None:
    """Verdict and rule of the longest fit: most host labels first, then the longest path."""
    node, walked = trie, []
    for label in reversed(host.split(".")):
        if (node := node.children.get(label)) is None:
            break
        if node.paths:
            walked.append(node.paths)
    for paths in reversed(walked):
        if found := _longest_path(paths, path):
            return found
    return None


_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both are empty where the url is null or has no `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return (
        F.translate(host, string.ascii_uppercase, string.ascii_lowercase),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    )


def _by_trie(located: DataFrame, rules: list[Rule]) -> DataFrame:
    trie = located.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("verdict string, rule string")
    def match(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        fits = [longest_match(trie.value, h, p) or (None, None) for h, p in zip(host, path)]
        return pd.DataFrame(fits, columns=["verdict", "rule"], dtype=object)

    return located.withColumn("_fit", match("host", "path"))


def _by_join(located: DataFrame, rules: DataFrame) -> DataFrame:
    """Every host suffix and every path start of a length that rules have, looked up by equality.

    Rows get stored numbers of their own first, so repeated and null keys are judged one by one.
    """
    located = stored(located.withColumn("_row", F.monotonically_increasing_id()))
    rules = rules.select(
        "verdict",
        F.translate("host", string.ascii_uppercase, string.ascii_lowercase).alias("_host"),
        F.col("path").alias("_path"),
    )
    rules = rules.groupBy("_host", "_path").agg(F.max("verdict").alias("verdict"))
    lengths = [r[0] for r in rules.select(F.length("_path")).distinct().collect()]
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    starts = F.array_distinct(
        F.transform(
            F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("path")),
            lambda n: F.substring(F.col("path"), F.lit(1), n),
        )
    )
    tried = located.select("_row", "host", "path", F.explode(suffixes).alias("_host")).select(
        "_row", "_host", F.explode(starts).alias("_path")
    )
    fits = tried.join(rules, ["_host", "_path"]).select(
        "_row",
        F.struct(
            F.size(F.split("_host", r"\.", -1)).alias("labels"),
            F.length("_path").alias("length"),
            "verdict",
            F.concat("_host", "_path").alias("rule"),
        ).alias("_fit"),
    )
    best = fits.groupBy("_row").agg(F.max("_fit").alias("_fit"))
    return located.join(best, "_row", "left")


def judge_urls(
    pages: DataFrame,
    rules: Iterable[Rule] | DataFrame,
    key: str = "page_id",
    url: str = "url",
    default: str = "allow",
    rule_bytes: int = RULE_BYTES,
) -> DataFrame:
    """`key`, host, path, rule and verdict of every row.

    Rules up to `rule_bytes` (measured) are broadcast as a trie; beyond that, or given as a table of
    that size, they are joined by host suffixes and path starts, with the same result. A rule fits its host
    and all subdomains when the path starts with the rule's path. More host labels win, then the longer
    path, then `block`. Without a fit, rule is null and the verdict is `default`.

    Null urls and urls without `://` have an empty host and path; they fit no rule but one with an empty
    host. Repeated rows are judged each; an empty table gives an empty result. Columns other than `key`
    and `url` are not looked at and not returned, so their names cannot clash.
    """
    host, path = host_and_path(F.col(url))
    located = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    if isinstance(rules, DataFrame):
        size = F.coalesce(F.sum(F.length("host") + F.length("path") + 200), F.lit(0))
        if rules.select(size).first()[0] <= rule_bytes:
            rules = [Rule(*r) for r in rules.select("verdict", "host", "path").collect()]
    else:
        rules = [Rule(*r) for r in rules]
        if sum(len(r.host) + len(r.path) + 200 for r in rules) > rule_bytes:
            rules = pages.sparkSession.createDataFrame(rules, "verdict string, host string, path string")
    found = _by_join(located, rules) if isinstance(rules, DataFrame) else _by_trie(located, rules)
    return found.select(
        key,
        "host",
        "path",
        F.col("_fit.rule").alias("rule"),
        F.coalesce("_fit.verdict", F.lit(default)).alias("verdict"),
    )
