"""URL filters: host and path rules as a sort-merge range join over reversed-host keys."""

from __future__ import annotations

import bisect
import math
import zlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lorebase.llm.common import ascii_lower, tasks_for

# Keys sampled per task to place the borders between tasks.
SAMPLE = 64


class Rule(NamedTuple):
    """A rule fits its host and all subdomains of it, if the path starts with the rule's."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://` or url."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    start = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")


def host_key(host: Column) -> Column:
    """Labels in reverse order, each closed by a dot: `a.example.net` is `net.example.a.`.

    A host and its subdomains are then the keys from its own key on up to its key with the last dot
    raised by one character. Such intervals are nested or apart, never overlapping in part.
    """
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _interval(host: str) -> tuple[str, str]:
    key = ".".join(reversed(host.split("."))) + "."
    return key, key[:-1] + chr(ord(".") + 1)


def judge_urls(pages: DataFrame, rules: DataFrame | Sequence[Rule], default: str = "allow") -> DataFrame:
    """Verdict of the longest rule that fits each url of `pages` (page_id, url, ...).

    `rules` is a table (verdict, host, path) or a sequence of `Rule`. The longest rule is the one with the
    longest host and path together; then the longer host, then block. Returns page_id, host, path, rule (host and
    path of the rule, null if none fits) and verdict (`default` if none fits).

    Method: urls are dealt by ranges of their reversed-host key and sorted there; a rule goes to each task
    whose range its interval touches. A task sweeps the sorted rows once and keeps a stack of the
    rules whose interval holds the current key; nesting bounds it by the number of labels of a host times the rules
    of one host. Borders come from about 64 sampled keys per task. A host that many urls share
    takes up several borders, and its urls are dealt over the tasks between them. Rows are read as a
    stream, so a task holds one batch and its stack.

    Null url or one without `://`: host and path are empty and no rule fits. Null page_id stays null. Repeated
    rows are judged each. No rows or no rules: no rows, or the default for all. Rules with a null or empty host fit
    nothing; a null path counts as empty. Other columns are ignored.
    """
    spark = pages.sparkSession
    keyed = pages.select(
        F.col("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    ).withColumn("key", host_key(F.col("host")))
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(
            [tuple(r) for r in rules] or [(None, None, None)], "verdict string, host string, path string"
        )
    tasks = tasks_for(spark)
    borders = _borders(keyed, tasks)

    def place_urls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = batch.column("key").to_pylist(), batch.column("page_id").to_pylist()
            paths = batch.column("path").to_pylist()
            at = []
            for key, page_id, path in zip(keys, ids, paths):
                first, last = bisect.bisect_left(borders, key), bisect.bisect_right(borders, key)
                spread = zlib.crc32(f"{page_id} {path}".encode()) % (last - first + 1)
                at.append(first + spread)
            empty = pa.nulls(batch.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), batch.column("key"), pa.array([1] * batch.num_rows, pa.int32()),
                 batch.column("page_id"), batch.column("host"), batch.column("path"), empty],
                names=NAMES,
            )

    def place_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for rule in batch.to_pylist():
                if not rule["host"]:
                    continue
                low, high = _interval(rule["host"])
                first, last = bisect.bisect_left(borders, low), bisect.bisect_left(borders, high)
                rows += [(t, low, 0, None, rule["host"], rule["path"] or "", rule["verdict"]) for t in range(first, last + 1)]
            columns = list(zip(*rows)) or [()] * len(NAMES)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=NAMES)

    id_type = keyed.schema["page_id"].dataType
    types = [pa.int32(), pa.string(), pa.int32(), _arrow_type(id_type), pa.string(), pa.string(), pa.string()]
    schema = f"task int, key string, kind int, page_id {id_type.simpleString()}, host string, path string, verdict string"
    placed = keyed.mapInArrow(place_urls, schema).unionByName(
        rules.select("verdict", "host", "path").distinct().mapInArrow(place_rules, schema)
    )
    dealt = placed.repartitionById(len(borders) + 1, F.col("task")).sortWithinPartitions("task", "key", "kind")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple[str, list[tuple[int, int, bool, str, str]]]] = []  # interval end, rules of that host
        task = None
        for batch in batches:
            kinds = batch.column("kind").to_pylist()
            columns = [batch.column(c).to_pylist() for c in ("task", "key", "host", "path", "verdict")]
            found, verdicts = [], []
            for kind, at, key, host, path, verdict in zip(kinds, *columns):
                if at != task:
                    stack, task = [], at
                while stack and stack[-1][0] <= key:
                    stack.pop()
                if kind == 0:
                    end = _interval(host)[1]
                    if not stack or stack[-1][0] != end:
                        stack.append((end, []))
                    stack[-1][1].append((len(host) + len(path), len(host), verdict == "block", path, verdict, host))
                    continue
                best = max(
                    (r for _, rules_here in stack for r in rules_here if path.startswith(r[3])), default=None
                )
                found.append(best and best[5] + best[3])
                verdicts.append(best[4] if best else default)
            keep = pa.array([k == 1 for k in kinds])
            urls = batch.filter(keep)
            yield pa.RecordBatch.from_arrays(
                [urls.column("page_id"), urls.column("host"), urls.column("path"),
                 pa.array(found, pa.string()), pa.array(verdicts, pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    return dealt.mapInArrow(
        sweep, f"page_id {id_type.simpleString()}, host string, path string, rule string, verdict string"
    )


NAMES = ["task", "key", "kind", "page_id", "host", "path", "verdict"]


def _arrow_type(kind) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]


def _borders(keyed: DataFrame, tasks: int) -> list[str]:
    """Keys between tasks, `tasks` - 1 of them at most, from a sample of about 64 keys per task."""
    total = keyed.count()
    wanted = SAMPLE * tasks
    sample = keyed.select("key") if total <= wanted else keyed.select("key").sample(fraction=wanted / total, seed=1)
    keys = sorted(r.key for r in sample.collect())
    step = max(1, math.ceil(len(keys) / tasks))
    return keys[step::step]
