"""URL filters: allow and block entries for hosts with all their subdomains and path prefixes.

The entries form a trie over reversed host labels, then path segments: ``example.com/en/7`` is com > example > en > "7".
A rule's last segment may be cut (``/en/7`` also fits ``/en/725``), so a node keeps its cut ends beside its children. The walk goes as deep as
the URL allows and the deepest match wins: more host labels first, then the longer path; of equal entries the blocking one.
Up to ``MOST_RULES`` rules the trie is broadcast to the tasks. A longer list is joined instead: every URL gives its host suffixes, which meet the
rules' hosts in a shuffled join, and the longest fitting rule is aggregated.

Rows: one per input row. A null URL, or one without ``://``, has an empty host and path, which no rule fits. Only A-Z are lower-cased.
Ports and user names are part of the host as written. A rule's host is not empty and in lower case, its path is empty or begins with a slash; other rules are errors. Columns other than page_id and url are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_RULES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DEFAULT = "allow"

Rule = tuple[str, str, str]  # verdict, host, path

#: The rules of the registered query (fixed values).
RULES: list[Rule] = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]


def checked(rules: Iterable[Rule]) -> list[Rule]:
    """The rules, if all are well formed."""
    rules = list(rules)
    for rule in rules:
        verdict, host, path = rule
        if verdict not in ("allow", "block") or not host or any(c in UPPER or c in "/?#" for c in host) or path and not path.startswith("/") or any(c in path for c in "?#"):
            raise ValueError(f"not a rule: {rule}")
    return rules


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class Trie:
    """Nodes are dicts: host labels are kept as they are, path segments with a leading slash."""

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for verdict, host, path in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            *whole, last = path.split("/")[1:] if path else [""]
            node = node.setdefault("/", {}) if path else node
            for segment in whole:
                node = node.setdefault("/" + segment, {})
            ends = node.setdefault(".", {})
            if ends.get(last, ("",))[0] != "block":
                ends[last] = (verdict, host + path)

    def longest(self, host: str, path: str) -> tuple[str, str] | None:
        best, node = None, self.root
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            best = self._path(node, path) or best
        return best

    @staticmethod
    def _path(node: dict, path: str) -> tuple[str, str] | None:
        best = node.get(".", {}).get("")
        node = node.get("/")
        if node is None or not path.startswith("/"):
            return best
        segments = path.split("/")[1:]
        for i, segment in enumerate(segments):
            if ends := node.get("."):
                for n in range(len(segment) + 1):
                    best = ends.get(segment[:n], best)
            if i + 1 == len(segments) or (node := node.get("/" + segment)) is None:
                break
        return best


def judge_urls(pages: DataFrame, rules: list[Rule], most_rules: int = MOST_RULES) -> DataFrame:
    """page_id, host, path, rule (the text of the longest that fits, else null) and verdict."""
    rules = checked(rules)
    pages = pages.select("page_id", F.col("url").cast("string").alias("url")).select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if len(rules) > most_rules:
        return _joined(pages, rules)
    trie = pages.sparkSession.sparkContext.broadcast(Trie(rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest = trie.value.longest
        for batch in batches:
            found = [longest(h, p) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([f and f[1] for f in found], pa.string()), pa.array([f[0] if f else DEFAULT for f in found], pa.string())], ["page_id", "host", "path", "rule", "verdict"])

    return pages.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")


def _joined(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    table = pages.sparkSession.createDataFrame(rules, "rule_verdict string, rule_host string, rule_path string").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    urls = pages.where("host <> ''").select("host", "path").distinct()
    order = F.struct(F.size(F.split("rule_host", r"\.")), F.length("rule_path"), F.col("rule_verdict"))
    best = (
        urls.withColumn("rule_host", F.explode(suffixes)).join(table, "rule_host").where("startswith(path, rule_path)")
        .groupBy(F.col("host").alias("h"), F.col("path").alias("p")).agg(F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict")), order).alias("best"))
    )
    return pages.join(best, (pages.host == best.h) & (pages.path == best.p), "left").select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(DEFAULT)).alias("verdict"))


SQL = r"""
with parts as (
  select page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '') as h, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
urls as (select page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, path from parts),
rules(verdict, rh, rp) as (values ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
fits as (
  select page_id, rh || rp as rule, verdict, row_number() over (partition by page_id order by len(rh) desc, len(rp) desc) as n
  from urls join rules on (host = rh or suffix(host, '.' || rh)) and prefix(path, rp))
select u.page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from urls u left join fits f on u.page_id = f.page_id and f.n = 1
"""
