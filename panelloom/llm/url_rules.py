"""URL filter over a sorted digest array.

Rules are (host, path, action). The index is one file: ascending 64-bit xxhash keys of
``host NUL path``, then offsets, actions and the full strings. Executors fetch the file
once each, map it into memory, probe it with vectorised binary search and compare the
stored string of every hit, so a hash collision never decides. The file's size depends on
the rules only and is checked; mapped pages are shared by all workers of a machine.

A rule fits its host and all subdomains when the url's path starts with the rule's path.
The longest rule (host and path characters) wins, among equals the one with the longer
host, then the later one given. Where no rule fits, the verdict is ``default``.

Defined results: null urls and urls without ``://`` have an empty host and path and get the
default; an empty host fits no rule; repeated rows are judged alike; an empty table gives
an empty table; all other columns pass through, whatever their names, and ``host``, ``path``,
``rule``, ``verdict`` are returned beside them in a struct of their own, which is called ``_url``
unless the caller names it otherwise; rows that have a column of that name raise.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm.common import save_bytes

MAX_INDEX_BYTES = 8 << 30
ACTIONS = ("allow", "block")
RESULT = "rule STRING, verdict STRING"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8"))


def _section(strings: list[str], marks: list[int]) -> list[np.ndarray]:
    """Sorted keys, string offsets, marks and string bytes of one array."""
    keys = np.array([_digest(s) for s in strings], np.uint64)
    order = np.argsort(keys, kind="stable")
    blobs = [strings[i].encode("utf-8") for i in order]
    ends = np.cumsum([0, *map(len, blobs)]).astype(np.uint64)
    return [
        keys[order], ends, np.array([marks[i] for i in order], np.uint64),
        np.frombuffer(b"".join(blobs), np.uint8),
    ]


def build_index(rules: Iterable[tuple[str, str, str]]) -> bytes:
    """The index file's bytes: an array of hosts (marked with a bit per path length) and
    an array of rules (marked with the action)."""
    final = {(host, path): action for host, path, action in rules}
    lengths = sorted({len(path) for _, path in final})
    hosts: dict[str, set[int]] = {}
    for host, path in final:
        hosts.setdefault(host, set()).add(lengths.index(len(path)))
    if len(lengths) > 64:
        # More lengths than bits: every host is probed at all of them.
        marks = [2**64 - 1] * len(hosts)
    else:
        marks = [sum(1 << i for i in bits) for bits in hosts.values()]
    sections = [
        np.array(lengths, np.uint64),
        *_section(list(hosts), marks),
        *_section([f"{h}\0{p}" for h, p in final], [ACTIONS.index(a) for a in final.values()]),
    ]
    sizes = np.array([s.nbytes for s in sections], np.uint64)
    data = b"".join([sizes.tobytes(), *(s.tobytes() + bytes(-s.nbytes % 8) for s in sections)])
    if len(data) > MAX_INDEX_BYTES:
        raise ValueError("the rules exceed one index; split them and judge in turns")
    return data


class DigestIndex:
    """A mapped index file."""

    def __init__(self, path: str) -> None:
        raw = np.memmap(path, np.uint8, "r")
        sizes = raw[: 9 * 8].view(np.uint64).tolist()
        at, parts = 9 * 8, []
        for size in sizes:
            parts.append(raw[at : at + size])
            at += size + -size % 8
        self.lengths = parts[0].view(np.uint64).tolist()
        self.hosts, self.rules = parts[1:5], parts[5:9]

    @staticmethod
    def probe(section: list[np.ndarray], strings: list[str]) -> np.ndarray:
        """Mark of each string, -1 where it is absent."""
        keys, ends = section[0].view(np.uint64), section[1].view(np.uint64)
        marks, blob = section[2].view(np.uint64), section[3]
        found = np.full(len(strings), -1, object)
        if not strings or not len(keys):
            return found
        wanted = np.array([_digest(s) for s in strings], np.uint64)
        left = np.searchsorted(keys, wanted, "left")
        right = np.searchsorted(keys, wanted, "right")
        for i in np.flatnonzero(right > left):
            text = strings[i].encode("utf-8")
            for j in range(left[i], right[i]):  # equal digests: the stored string decides
                if blob[int(ends[j]) : int(ends[j + 1])].tobytes() == text:
                    found[i] = int(marks[j])
        return found

    def judge(self, hosts: list[str], paths: list[str]) -> list[tuple[str, str] | None]:
        """Rule and action of each (host, path)."""
        names = list(dict.fromkeys(hosts))
        owners, suffixes = [], []
        for name in names:
            at = 0
            while name and at >= 0:
                owners.append(name)
                suffixes.append(name[at:])
                at = name.find(".", at) + 1 or -1
        bits: dict[str, list[tuple[str, int]]] = {}
        for name, suffix, mark in zip(
            owners, suffixes, self.probe(self.hosts, suffixes), strict=True
        ):
            if mark != -1:
                bits.setdefault(name, []).append((suffix, mark))
        rows, tries = [], []
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            for suffix, mark in bits.get(host, ()):
                for k, length in enumerate(self.lengths):
                    if length <= len(path) and (k >= 64 or mark >> k & 1):
                        rows.append(i)
                        tries.append((suffix, path[:length]))
        wanted = {pair: i for i, pair in enumerate(dict.fromkeys(tries))}
        marks = self.probe(self.rules, [f"{h}\0{p}" for h, p in wanted])
        best: list = [None] * len(hosts)
        for i, pair in zip(rows, tries, strict=True):
            mark = marks[wanted[pair]]
            if mark == -1:
                continue
            rank = (len(pair[0]) + len(pair[1]), len(pair[0]))
            if best[i] is None or rank > best[i][0]:
                best[i] = (rank, pair[0] + pair[1], ACTIONS[mark])
        return [b and b[1:] for b in best]


@functools.cache
def _opened(name: str) -> DigestIndex:
    return DigestIndex(SparkFiles.get(name))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path without query and fragment."""
    begin = F.locate("://", url)
    rest = F.when(begin > 0, F.substr(url, begin + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def judge_urls(
    spark: SparkSession,
    rows: DataFrame,
    rules: Iterable[tuple[str, str, str]],
    url_col: str = "url",
    default: str = "allow",
    into: str = "_url",
) -> DataFrame:
    """Rows with a struct ``into`` (host, path, rule, verdict); nothing is shuffled."""
    if into in rows.columns:
        raise ValueError(f"the rows have a column {into}; choose another name")
    name = f"rules-{uuid.uuid4().hex}.idx"
    # From the shared folder Spark copies the file to each executor once.
    spark.sparkContext.addFile(save_bytes(spark, build_index(rules), name))

    @F.pandas_udf(RESULT)
    def judged(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        index = _opened(name)
        for hosts, paths in batches:
            found = index.judge(hosts.tolist(), paths.tolist())
            yield pd.DataFrame(
                {
                    "rule": [f[0] if f else None for f in found],
                    "verdict": [f[1] if f else default for f in found],
                }
            )

    # The judged columns have names of this call, which no column of the rows can have.
    own = {part: f"{part}_{name}" for part in ("host", "path", "verdict")}
    host, path = host_and_path(F.col(f"`{url_col}`"))
    given = [F.col(f"`{column}`") for column in rows.columns]
    split = rows.select(*given, host.alias(own["host"]), path.alias(own["path"]))
    both = [F.col(f"`{own[part]}`") for part in ("host", "path")]
    verdict = F.col(f"`{own['verdict']}`")
    return split.select("*", judged(*both).alias(own["verdict"])).select(
        *given,
        F.struct(
            both[0].alias("host"), both[1].alias("path"),
            verdict.getField("rule").alias("rule"), verdict.getField("verdict").alias("verdict"),
        ).alias(into),
    )
