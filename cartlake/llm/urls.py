"""Allow and block rules for URLs, by a sort-merge range join of canonical keys.

A key is the host's labels in reverse, each closed by a mark, then the path. A rule's
host becomes the interval of keys that begin with its labels: the host and all its
subdomains. URLs and rules are dealt to ranges of keys and sorted; a sweep over a range
keeps a stack of the rule hosts that the current key lies in, and each of these has its
paths, sorted and linked to the path that encloses them, so the longest that fits is found
by bisection. A rule goes to every range that its interval touches.

The cuts between ranges come from a bounded sample of keys. A key that takes several cuts
is spread over the ranges between them by the row's number in its task, so one host or URL with a
third of all rows, exact copies too, does not end in one task. The URLs are shuffled once.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: No label of a host holds the mark, so labels begin alike just for a host and its subdomains.
MARK, LAST = ".", "\U0010ffff"
#: Sampled keys for each range.
PER_RANGE = 20
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host: what follows the first "://" up to "/", "?" or "#", A-Z lower-cased; path: then
    up to "?" or "#". Both are empty for a null URL or one without "://"."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: str) -> str:
    return "".join(label + MARK for label in reversed(host.split(".")))


def url_key(host: str, path: str) -> str:
    return reversed_host(host) + MARK + path


class Host:
    """The rules of one host: paths in order, each linked to the longest that encloses it."""

    def __init__(self, labels: str) -> None:
        self.labels, self.paths, self.outer, self.rules = labels, [], [], []

    def add(self, path: str, rule: tuple[str, str]) -> None:
        if self.paths and self.paths[-1] == path:
            return  # of equal rules the first in order stays
        i = len(self.paths) - 1
        while i >= 0 and not path.startswith(self.paths[i]):
            i = self.outer[i]
        self.outer.append(i)
        self.paths.append(path)
        self.rules.append(rule)

    def longest(self, path: str) -> tuple[str, str] | None:
        i = bisect_right(self.paths, path) - 1
        while i >= 0 and not path.startswith(self.paths[i]):
            i = self.outer[i]
        return self.rules[i] if i >= 0 else None


class Sweep:
    """Takes rules and URLs in order of key and keeps the rule hosts that the last key lies in."""

    def __init__(self) -> None:
        self.stack: list[Host] = []

    def feed(self, labels: str, path: str, rule: str | None, verdict: str | None) -> tuple[str | None, str | None]:
        """The rule of a URL (rule is None) and its verdict."""
        while self.stack and not labels.startswith(self.stack[-1].labels):
            self.stack.pop()
        if rule is not None:
            if not self.stack or self.stack[-1].labels != labels:
                self.stack.append(Host(labels))
            self.stack[-1].add(path, (rule, verdict))
            return None, None
        fits = [f for f in (host.longest(path) for host in self.stack) if f]
        return max(fits, key=lambda f: len(f[0])) if fits else (None, None)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", ranges: int | None = None) -> DataFrame:
    """Per row of ``pages`` (page_id, url): page_id, host, path, rule and verdict.

    ``rules``: verdict, host, path. A rule fits its host and all subdomains, if the URL's
    path starts with the rule's; the longest rule (host and path as text) wins, of equal
    texts the first verdict in order. ``rule`` is null and the verdict ``default`` where
    none fits. Rules with a null are left out. Repeated rows and rows without id each give
    a row; an empty table gives an empty result; other columns are not read.
    """
    spark = pages.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = split_url(F.col("url"))
    # Ids travel as text: beside rules, which have none, pandas would round them.
    urls = pages.select(F.col("page_id").cast("string").alias("page_id"), host.alias("host"), path.alias("path"))
    # By row, not by content: the sample shows copies as often as the table does.
    salted = urls.withColumn("salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)).cast("int"))
    sample = salted.orderBy("salt", "host", "path").limit(PER_RANGE * ranges).select("host", "path").collect()
    keys = sorted(url_key(r["host"], r["path"]) for r in sample)
    cuts = keys[PER_RANGE::PER_RANGE]
    page_type = pages.schema["page_id"].dataType.simpleString()
    schema = "part int, labels string, page_id string, host string, path string, rule string, verdict string"

    def deal_urls(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            labels = [reversed_host(h) for h in batch["host"]]
            key = map(url_key, batch["host"], batch["path"])
            part = []
            for k, salt in zip(key, batch["salt"]):
                low, high = bisect_left(cuts, k), bisect_right(cuts, k)
                part.append(low + salt % (high - low + 1))
            none = [None] * len(batch)
            yield frame(part, labels, batch["page_id"], batch["host"], batch["path"], none, none)

    def deal_rules(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples():
                labels = reversed_host(r.host)
                for part in range(bisect_left(cuts, labels), bisect_right(cuts, labels + LAST) + 1):
                    out.append((part, labels, None, r.host, r.path, f"{r.host}{r.path}", r.verdict))
            if out:
                yield frame(*zip(*out))

    def frame(*columns, names=[f.split()[0] for f in schema.split(", ")]) -> pd.DataFrame:
        return pd.DataFrame({n: pd.Series(list(c), dtype=object) for n, c in zip(names[-len(columns) :], columns)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The stack lives on from batch to batch and starts anew with each range.
        part, found = None, Sweep()
        for batch in batches:
            keep, verdicts = [], []
            for i, row in enumerate(zip(batch["part"], batch["labels"], batch["path"], batch["rule"], batch["verdict"])):
                if row[0] != part:
                    part, found = row[0], Sweep()
                got = found.feed(*row[1:])
                if row[3] is None:
                    keep.append(i)
                    verdicts.append(got)
            if keep:
                held = [batch[c].iloc[keep] for c in ("page_id", "host", "path")]
                yield frame(*held, [v[0] for v in verdicts], [v[1] or default for v in verdicts])

    usable = rules.filter("verdict is not null and host is not null and path is not null").select("verdict", "host", "path")
    dealt = salted.mapInPandas(deal_urls, schema).unionByName(usable.mapInPandas(deal_rules, schema))
    ordered = dealt.repartitionById(ranges, "part").sortWithinPartitions("part", "labels", F.col("rule").isNotNull().desc(), "path", "rule", "verdict")
    judged = ordered.mapInPandas(run, "page_id string, host string, path string, rule string, verdict string")
    return judged.withColumn("page_id", F.col("page_id").cast(page_type))


def fixed_rules(spark) -> DataFrame:
    return spark.createDataFrame(list(RULES), "verdict string, host string, path string")


#: The same rows from DuckDB.
SQL = """
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
urls AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM parts),
rules(verdict, host, path) AS (VALUES
  ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/'))
SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM urls u LEFT JOIN LATERAL (
  SELECT r.host || r.path AS rule, r.verdict FROM rules r
  WHERE (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  ORDER BY length(r.host || r.path) DESC LIMIT 1) m ON true
"""
