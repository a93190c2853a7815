"""URL rules by a sort-merge range join.

A host is written with its labels reversed and a dot after each, so a rule's host
covers an interval of keys: all that start with its own. Urls and rules are sorted
by key together; a sweep keeps a stack of the rules whose intervals hold the
current key, which nest, and picks the longest of them whose path fits.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aisflow.storage import written

#: Urls and rules of a slice, about.
SLICE_ROWS = 25_000
DEFAULT_VERDICT = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
JUDGED = "page_id long, host string, path string, rule string, verdict string"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ?, # or the end, A-Z lower-cased. Path: from there up
    to ?, # or the end. Both empty for a null url or one without ://."""
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_replace(url, "(?s)^.*?://", "")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def reversed_key(host: Column) -> Column:
    """com.example.www. for www.example.com; empty for an empty host."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


class Host:
    """The rules of one host by path, with the lengths that their paths have."""

    def __init__(self, key: str) -> None:
        self.key, self.paths, self.lengths = key, {}, None

    def add(self, path: str, rule: str, verdict: str) -> None:
        # of two verdicts for one rule the stricter holds
        if path not in self.paths or verdict == "block":
            self.paths[path], self.lengths = (rule, verdict), None

    def longest(self, path: str) -> tuple[str, str] | None:
        if self.lengths is None:
            self.lengths = sorted({len(p) for p in self.paths}, reverse=True)
        fitting = (self.paths.get(path[:end]) for end in self.lengths if end <= len(path))
        return next((rule for rule in fitting if rule), None)


class Stack:
    """Hosts whose intervals hold the current key, outermost first."""

    def __init__(self) -> None:
        self.open: list[Host] = []

    def move_to(self, key: str) -> None:
        while self.open and not key.startswith(self.open[-1].key):
            self.open.pop()

    def push(self, key: str, path: str, rule: str, verdict: str) -> None:
        self.move_to(key)
        if not self.open or self.open[-1].key != key:
            self.open.append(Host(key))
        self.open[-1].add(path, rule, verdict)

    def longest(self, key: str, path: str) -> tuple[str | None, str | None]:
        """The rule that fits and has most characters, the longer host on a tie."""
        self.move_to(key)
        found = [rule for host in self.open if (rule := host.longest(path))]
        return max(reversed(found), key=lambda rule: len(rule[0]), default=(None, None))


def _sweep(default: str):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack, current = Stack(), None
        for batch in rows:
            ids, hosts, paths, rules, verdicts, times = [], [], [], [], [], []
            names = ("slice", "key", "kind", "page_id", "host", "path", "rule", "verdict", "copies")
            for slice_, key, kind, page_id, host, path, rule, verdict, copies in zip(*(batch.column(n).to_pylist() for n in names)):
                if slice_ != current:
                    stack, current = Stack(), slice_
                if kind == 0:
                    stack.push(key, path, rule, verdict)
                    continue
                rule, verdict = stack.longest(key, path) if key else (None, None)
                found = (page_id, host, path, rule, verdict or default, copies)
                for out, value in zip((ids, hosts, paths, rules, verdicts, times), found):
                    out.append(value)
            columns = [pa.array(ids, pa.int64()), *(pa.array(c, pa.string()) for c in (hosts, paths, rules, verdicts)), pa.array(times, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "host", "path", "rule", "verdict", "copies"])

    return run


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict: one row per page.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host
    and all subdomains where the url's path starts with the rule's; the longest
    host and path wins. Without one, rule is null and the verdict ``default``. A
    null url or one without :// has no host and fits nothing; rules with a null
    or empty host are left out, a null path counts as empty. Repeated rows stay,
    other columns are ignored, an empty table gives an empty result.

    Equal rows are one until the end. Urls and rules are put in order of their
    keys together by Spark's range partitioning, which cuts busy hosts, too; the
    cut is stored. A slice also needs the rules that begin before it and are
    still open at its first key: their hosts are that key's own prefixes, so
    these are looked up by an equality join, as many as the key has labels.
    """
    host, path = host_and_path(F.col("url"))
    split = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    none = F.lit(None).cast("string")
    urls = split.groupBy("page_id", "host", "path").agg(F.count(F.lit(1)).alias("copies")).select(
        reversed_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), "page_id", "host", "path", none.alias("rule"), none.alias("verdict"), "copies"
    )
    usable = rules.where("host IS NOT NULL AND host != ''").select(
        F.translate("host", _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    )
    named = written(usable.select(
        reversed_key(F.col("host")).alias("key"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("page_id"), "host", "path",
        F.concat("host", "path").alias("rule"), "verdict", F.lit(0).cast("long").alias("copies"),
    ).distinct(), "rules")
    rows = written(urls.unionByName(named), "urls")
    slices = max(1, -(-rows.count() // slice_rows))
    ranged = rows.repartitionByRange(slices, "key", "kind", "path", "page_id").withColumn("slice", F.spark_partition_id())
    cut = written(ranged, "url-slices")
    firsts = cut.groupBy("slice").agg(F.min("key").alias("_key"))
    labels = F.split("_key", r"\.")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")))
    opened = firsts.select("slice", F.explode(F.array_distinct(F.concat(prefixes, F.array("_key")))).alias("_open"))
    carried = opened.join(named, F.col("_open") == F.col("key")).drop("_open")
    together = cut.unionByName(carried.select(*cut.columns)).repartition("slice").sortWithinPartitions("slice", "key", "kind")
    judged = together.mapInArrow(_sweep(default), f"{JUDGED}, copies long")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return judged.withColumn("_copy", copies).drop("_copy", "copies")


def parse_rules(lines: list[tuple[str, str]]) -> list[tuple[str, str, str]]:
    """(verdict, 'host/path') pairs as rows of host, path, verdict."""
    return [(rule.partition("/")[0], "/" + rule.partition("/")[2] if "/" in rule else "", verdict) for verdict, rule in lines]


RULE_SCHEMA = "host string, path string, verdict string"
