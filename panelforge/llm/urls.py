"""URL filters by a sort-merge range join.

The labels of a host are reversed (``www.example.org`` becomes
``org.example.www.``), so that a host with all its subdomains is one interval
of keys.  Urls are sorted by that key within their partitions, without a
shuffle, and one sweep over the sorted urls and the sorted rules keeps a stack
of the nested rule intervals that are open at the present key.  A url only
looks at its stack; of the rules there whose path starts its own path, the
longest decides.

A partition needs no other partition: a url's verdict depends on rules only,
so a host with a third of all urls is spread over as many tasks as it has
input splits.  Rules travel to the tasks in blocks of at most ``RULE_BLOCK``;
more rules make further sweeps, each of which improves on what was found.  The
rank of the best rule so far (its length, then its host's) is carried along,
so the block size has no part in a verdict.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import without

#: Most rules that are sent to the tasks at once.
RULE_BLOCK = 200_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; A-Z in lower case; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What stands between the host and the next ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """The host's labels from last to first, each with a dot behind it; empty for an empty host."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def _key(host: str) -> str:
    return ".".join(reversed(host.split("."))) + "."


class Sweep:
    """Walks sorted rules along ascending keys; ``stack`` holds the intervals that are open at the present key."""

    def __init__(self, rules: list[tuple[str, str, str, str]]) -> None:
        # (key, host, path, verdict), sorted by key; the rules of one host open together
        self.rules, self.next, self.stack = rules, 0, []

    def match(self, key: str, path: str) -> tuple[str, str, int] | None:
        """The rule that decides, its verdict and its rank: by length, then by length of the host; only one rule that fits has it."""
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()
        while self.next < len(self.rules) and self.rules[self.next][0] <= key:
            rule = self.rules[self.next]
            self.next += 1
            if key.startswith(rule[0]):
                self.stack.append(rule)
        best = None
        for _, host, prefix, verdict in self.stack:
            if path.startswith(prefix):
                rank = (len(host) + len(prefix) << 32) + len(host)
                if best is None or rank > best[2]:
                    best = (host + prefix, verdict, rank)
        return best


def judge(df: DataFrame, rules: Iterable[tuple[str, str, str]], url: str = "url", keep: list[str] | None = None, default: str = "allow") -> DataFrame:
    """``keep`` columns with ``host``, ``path``, ``rule`` and ``verdict`` for each row of ``df``.

    ``rules`` are (host, path, verdict); one fits a url if the url's host is
    the rule's or a subdomain of it and the url's path starts with the rule's.
    The longest rule that fits decides (host and path together; of equally
    long ones that with the longer host; of equal ones the first).  Without a
    rule, ``rule`` is null and ``verdict`` is ``default``.  A null url and one
    without ``://`` have an empty host and path and fit no rule.  Rows are
    kept as they are, repeated ones too, of any length; other columns of ``df``
    are ignored.  A column of ``keep`` that is named like a result gives way
    to it.
    """
    keep = without(["page_id"] if keep is None else keep, "host", "path", "rule", "verdict")
    own = df.select(*keep, host_of(df[url]).alias("host"), path_of(df[url]).alias("path"))
    own = own.select(*keep, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"), F.lit(-1).cast("long").alias("__rank"), host_key(F.col("host")).alias("__key"))
    unique = {}
    for host, path, verdict in rules:
        unique.setdefault((host, path), verdict)
    every = iter(sorted((_key(h), h, p, v) for (h, p), v in unique.items()))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)
    while block := list(islice(every, RULE_BLOCK)):
        own = own.sortWithinPartitions("__key").mapInArrow(_sweeper(block, len(keep)), fields)
    return own.drop("__rank", "__key")


def _sweeper(block: list[tuple[str, str, str, str]], n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep = Sweep(block)
        for batch in batches:
            path, rule, verdict, rank, key = (batch.column(n + k).to_pylist() for k in (1, 2, 3, 4, 5))
            for k in range(len(key)):
                found = sweep.match(key[k], path[k])
                if found and found[2] > rank[k]:
                    rule[k], verdict[k], rank[k] = found
            out = [*batch.columns[: n + 2], pa.array(rule, pa.string()), pa.array(verdict, pa.string()), pa.array(rank, pa.int64()), batch.column(n + 5)]
            yield pa.RecordBatch.from_arrays(out, batch.schema.names)

    return run
