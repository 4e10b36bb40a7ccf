"""URL rules by a sort-merge range join.

The canonical key of a host is its labels in reverse order, each closed by \\x01, so a host and all its subdomains are
one interval of keys. URLs and rules are dealt out by ranges of the key and sorted; a sweep over each range keeps a
stack of the rule hosts whose intervals are open, nested in each other, and each of these finds its longest path.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys that a sample draws for each range; the sample is all that reaches the driver.
SAMPLES_PER_RANGE = 40


def host_of(url: Column) -> Column:
    """What follows the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    host = F.regexp_extract(_rest(url), r"(?s)\A([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end."""
    return F.regexp_extract(_rest(url), r"(?s)\A[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", url)
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def host_key(host: Column) -> Column:
    labels = F.reverse(F.split(host, r"\."))
    return F.concat(F.array_join(labels, "\x01"), F.lit("\x01"))


class _OpenHost:
    """The rules of one host whose interval is open: sorted paths, each with its longest other prefix."""

    def __init__(self, host: str, key: str):
        self.host, self.key = host, key
        self.paths: list[str] = []
        self.found: dict[str, tuple[str, str]] = {}
        self.parents: list[int] | None = None

    def add(self, path: str, rule: str, verdict: str) -> None:
        # block before allow, then by text: the same winner whatever order equal rules come in
        self.found[path] = min(self.found.get(path, ("￿", "")), (verdict, rule), key=lambda x: (x[0] != "block", x))
        self.parents = None

    def _nest(self) -> None:
        self.paths, self.parents, open_ = sorted(self.found), [], []
        for k, path in enumerate(self.paths):
            while open_ and not path.startswith(self.paths[open_[-1]]):
                open_.pop()
            self.parents.append(open_[-1] if open_ else -1)
            open_.append(k)

    def longest(self, path: str) -> str | None:
        if self.parents is None:
            self._nest()
        k = bisect.bisect_right(self.paths, path) - 1
        while k >= 0 and not path.startswith(self.paths[k]):
            k = self.parents[k]
        return self.paths[k] if k >= 0 else None


def _sweep(default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[_OpenHost] = []
        range_ = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("range", "key", "rule", "verdict", "host", "path")]
            seat, rules, verdicts = [], [], []
            for at, (own, key, rule, verdict, host, path) in enumerate(zip(*columns)):
                if own != range_:
                    stack, range_ = [], own
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if rule is not None:
                    if not stack or stack[-1].host != host or stack[-1].key != key:
                        stack.append(_OpenHost(host, key))
                    stack[-1].add(path, rule, verdict)
                    continue
                best = None
                for level in stack:
                    if host == level.host or host.endswith("." + level.host):
                        prefix = level.longest(path)
                        if prefix is not None and (best is None or len(level.host + prefix) >= len(best[0])):
                            best = (level.host + prefix, *level.found[prefix])
                seat.append(at)
                verdicts.append(best[1] if best else default)
                rules.append(best[2] if best else None)
            taken = batch.take(pa.array(seat, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [taken.column("page_id"), taken.column("host"), taken.column("path"),
                 pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
                ["page_id", "host", "path", "rule", "verdict"])
    return run


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) of each row of `pages` (page_id, url).

    `rules` (host, path, verdict): a rule fits its host and all subdomains if the url's path starts with the rule's;
    the longest rule (host and path together) wins, of equal rules block. rule is its host and path as one text; without a fitting rule it is
    null and the verdict is `default`.

    - A null url or one without :// has an empty host and path, which only a rule of the empty host fits.
    - Null or repeated page_ids are answered row by row; other columns are not read; empty tables give their due.
    - Rules with a null host or verdict are ignored; a null path counts as empty.

    Keys of URLs end in a hash of the row, so one host or one URL that holds a third of all rows is dealt to several
    ranges. A rule goes to every range that its interval meets. No table is broadcast; the driver sees the keys of a
    sample of fixed size for each range.
    """
    spark = pages.sparkSession
    ranges = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"),
                        path_of(F.col("url")).alias("path"))
    place = F.concat(host_key(F.col("host")), F.col("path"), F.lit("\x00"), F.hex(F.xxhash64("page_id", "host", "path")))
    urls = urls.withColumn("place", place)
    drawn = urls.select("place").orderBy(F.xxhash64("place")).limit(SAMPLES_PER_RANGE * ranges).collect()
    drawn = sorted((row.place for row in drawn), key=lambda x: x.encode())
    bounds = [drawn[len(drawn) * k // ranges] for k in range(1, ranges)] if drawn else []
    limits = F.array(*map(F.lit, bounds)).cast("array<string>")
    below = lambda place: F.size(F.filter(limits, lambda bound: bound <= place))

    urls = urls.select(below(F.col("place")).alias("range"), "place", host_key(F.col("host")).alias("key"),
                       F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"),
                       "host", "path", "page_id")
    rules = rules.select("host", F.coalesce("path", F.lit("")).alias("path"), "verdict").where(
        "host is not null and verdict is not null").distinct()
    key = host_key(F.col("host"))
    spread = F.explode(F.sequence(below(key), below(F.concat(key, F.lit("\U0010ffff")))))
    rules = rules.select(spread.alias("range"), key.alias("place"), key.alias("key"),
                         F.concat("host", "path").alias("rule"), "verdict", "host", "path",
                         F.lit(None).cast("long").alias("page_id"))
    dealt = urls.union(rules).repartition(ranges, "range").sortWithinPartitions(
        "range", "key", F.col("rule").isNull(), "place")
    return dealt.mapInArrow(_sweep(default), "page_id long, host string, path string, rule string, verdict string")
