"""URL rules looked up in a sorted array of 64-bit digests.

The rule strings (host + path) are kept sorted by xxhash digest. A URL is cut
into the strings that a rule on it could have, their digests are probed with one
vectorised binary search in the memory-mapped key array, and every hit is
confirmed against the stored full string, so that a digest collision can never
decide a URL.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules up to this number go to every task; more are dealt out by digest.
MAX_SENT_RULES = 1_000_000

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def digests(strings: Sequence[str]) -> np.ndarray:
    return np.fromiter(
        (xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass")) for s in strings),
        dtype=np.uint64, count=len(strings),
    )


class DigestArray:
    """Full strings behind their sorted, memory-mapped 64-bit digests.

    The key file is an unlinked file of the task, so nothing is left behind.
    """

    def __init__(self, strings: Sequence[str]):
        keys = digests(strings)
        order = np.argsort(keys, kind="stable")
        self.strings = [strings[i] for i in order]
        self._file = tempfile.TemporaryFile()
        # A file of no bytes cannot be mapped, so one spare key follows the rest.
        self._file.write(keys[order].tobytes() + b"\xff" * 8)
        self._file.flush()
        self.keys = np.memmap(self._file, dtype=np.uint64, mode="r")[: len(strings)]

    def probe(self, strings: Sequence[str]) -> np.ndarray:
        """Place of each string in the array, or -1."""
        wanted = digests(strings)
        place = np.searchsorted(self.keys, wanted)
        found = np.full(len(strings), -1, dtype=np.int64)
        near = place < len(self.keys)
        near[near] = self.keys[place[near]] == wanted[near]
        for i in np.flatnonzero(near):
            at = int(place[i])
            while at < len(self.keys) and self.keys[at] == wanted[i]:
                if self.strings[at] == strings[i]:
                    found[i] = at
                    break
                at += 1
        return found


def host_of(url: str | Column) -> Column:
    """Behind the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased.

    A null URL, or one without ``://``, has an empty host.
    """
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit(""))


def path_of(url: str | Column) -> Column:
    """Behind the host up to ``? #`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidates(host: str, path: str, lengths: Sequence[int]) -> list[str]:
    """All rule strings that would fit: host and its parents, path prefixes."""
    hosts, at = [host], host.find(".")
    while at >= 0:
        hosts.append(host[at + 1 :])
        at = host.find(".", at + 1)
    paths = [path[:n] for n in lengths if n <= len(path)]
    return [h + p for h in hosts if h for p in paths]


def _decide(page_hits: dict[int, str], verdicts: dict[str, str], n: int, default: str):
    rules = [page_hits.get(i) for i in range(n)]
    return rules, [default if r is None else verdicts[r] for r in rules]


def _rule_rows(rules: DataFrame) -> DataFrame:
    """One row per rule string; of two verdicts on one string, block holds."""
    return (
        rules.select((F.col("host").alias("h")), F.col("path").alias("p"), F.col("verdict"))
        .groupBy(F.concat("h", "p").alias("rule"))
        .agg(F.max("verdict").alias("verdict"), F.min(F.length("p")).alias("n"))
    )


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    default: str = "allow",
    id_column: str = "page_id",
    url_column: str = "url",
    max_sent_rules: int = MAX_SENT_RULES,
) -> DataFrame:
    """host, path, rule and verdict of every page.

    ``rules`` has host, path and verdict (``allow`` or ``block``). A rule fits
    its host and all subdomains, if the URL's path starts with its path; the
    longest rule string wins, and of equally long ones that with the longest host. URLs that no rule fits get ``default``: the method
    lists what is decided, and an unlisted URL is not held against its page.
    Null URLs, and URLs without ``://``, have an empty host and path and no rule.
    Repeated pages give repeated rows; columns other than id and URL are dropped.

    Up to ``max_sent_rules`` rules are sent to every task. A longer list is
    dealt out by digest, and each task maps only its part of it.
    """
    kind = dict(pages.select(F.col(id_column).alias("id")).dtypes)["id"]
    # Ids pass through pandas as text: a null beside whole numbers would make them floating point.
    whole = kind in ("tinyint", "smallint", "int", "bigint")
    read = pages.select(
        (F.col(id_column).cast("string") if whole else F.col(id_column)).alias("page_id"), host_of(url_column).alias("host"),
        path_of(url_column).alias("path"),
    )
    listed = _rule_rows(rules)
    lengths = sorted(row.n for row in listed.select("n").distinct().collect())
    few = listed.limit(max_sent_rules + 1).collect()
    if len(few) <= max_sent_rules:
        judged = _sent(read, {row.rule: row.verdict for row in few}, lengths, default)
    else:
        judged = _dealt(read, listed, lengths, default)
    return judged.withColumn("page_id", F.col("page_id").cast(kind))


def _sent(read: DataFrame, verdicts: dict[str, str], lengths: list[int], default: str) -> DataFrame:
    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        array = DigestArray(list(verdicts))
        for frame in frames:
            strings, owners = [], []
            for i, (host, path) in enumerate(zip(frame.host, frame.path)):
                found = candidates(host, path, lengths)
                strings += found
                owners += [i] * len(found)
            best: dict[int, str] = {}
            hit = array.probe(strings)
            for j in np.flatnonzero(hit >= 0):
                i, rule = owners[j], strings[j]
                # Of equally long candidates the first has the longest host.
                if i not in best or len(rule) > len(best[i]):
                    best[i] = rule
            rule, verdict = _decide(best, verdicts, len(frame), default)
            yield pd.DataFrame({
                "page_id": frame.page_id, "host": frame.host.tolist(), "path": frame.path.tolist(),
                "rule": rule, "verdict": verdict,
            })

    kind = dict(read.dtypes)["page_id"]
    return read.mapInPandas(
        judge, f"page_id {kind}, host string, path string, rule string, verdict string"
    )


def _dealt(read: DataFrame, listed: DataFrame, lengths: list[int], default: str) -> DataFrame:
    """The same by digest shards: each distinct candidate travels once."""
    parts = int(read.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    @F.pandas_udf("array<string>")
    def cut(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([candidates(h, p, lengths) for h, p in zip(hosts, paths)])

    def shard(column):
        return F.pmod(F.xxhash64(column), F.lit(parts * 8))

    urls = read.select("host", "path").distinct()
    # Candidates stand in the order of their hosts, the longest first.
    asked = urls.select("host", "path", F.posexplode(cut("host", "path")).alias("place", "rule"))

    def probe(wanted: pd.DataFrame, rules: pd.DataFrame) -> pd.DataFrame:
        array = DigestArray(list(rules.rule))
        verdicts = dict(zip(rules.rule, rules.verdict))
        hit = array.probe(list(wanted.rule))
        kept = wanted[hit >= 0]
        found = kept.rule.tolist()
        return pd.DataFrame({"rule": found, "verdict": [verdicts[r] for r in found]}, dtype=object)

    distinct = asked.select("rule").distinct().withColumn("shard", shard("rule"))
    hits = (
        distinct.groupBy("shard")
        .cogroup(listed.withColumn("shard", shard("rule")).groupBy("shard"))
        .applyInPandas(probe, "rule string, verdict string")
    )
    best = (
        asked.join(hits, "rule")
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("n"), -F.col("place"), "rule", "verdict")).alias("best"))
    )
    return read.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
