"""Repeated byte strings, found by a distributed, prefix-aware merge sort of suffixes.

Every string of ``LENGTH`` bytes that also starts anywhere else, in the same document
or another, is removed. Not every suffix has to be sorted for that:

1. Of each such string the smallest of its ``GRAM``-byte hashes is its anchor. Equal
   strings have equal anchors at equal places, so a string whose anchor's hash is
   unique in the corpus is unique. The strings of one anchor start next to each
   other; together they are a region of their document.
2. The regions behind repeated anchors are the suffixes to sort, each from its anchor
   on, with the bytes left of the anchor beside it. Every task sorts its own, keeps
   equal ones once, and front-codes the run: of each suffix the length of the prefix
   that it shares with the one before, and the rest. The runs are exchanged by
   anchor.
3. The runs that meet are merged with a loser tree that knows for every run how long
   a prefix its head shares with the last suffix given out. It compares bytes only
   behind prefixes known to be equal, and gives the common prefixes of neighbours
   with the merged order. Two strings are equal if their suffixes share enough of
   the one and their left sides of the other.
4. The repeated ranges go back to their documents, where they are united and cut out.

Texts travel compressed. An anchor that more than ``HOT`` regions share would gather
them all in one task, so its regions are cut into their single strings, which are
dealt out by their bytes instead; equal ones still meet. That a string is repeated
needs two occurrences only: where two meet, in a run or later, their ranges are given
out, and the string goes on alone, marked as repeated by having no references. A run
so gives on at most one occurrence of a string, and the runs of a part are merged
``FAN`` at a time, in rounds, so no task holds more than about ``FAN`` of them.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import given_back, mixed, seeds, texts_of
from ledgerlark.session import materialise

LENGTH = 200
GRAM = 64
#: Windows looked at in one step of the anchor search.
STEP = 1 << 19
#: Regions of one anchor that may meet in one task as they are.
HOT = 100_000
#: Bytes of text whose regions are sorted into one run.
RUN_BYTES = 24 << 20
#: Bytes of regions, before they are front-coded, that are merged in one task.
PART_BYTES = 64 << 20
#: Runs of single strings that meet in one task.
FAN = 64
#: Ranges of single strings that are given out together.
GIVEN = 1 << 17

#: Runs of regions have no number, ranges have no part.
RUNS = "part int, number bigint, run binary, place bigint, mark bigint, span bigint"

_TABLE = seeds(256, 5)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64((1 << 24) - 1)


def _gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k`` bytes; ``k`` is a power of two."""
    h, n, power = _TABLE[data], 1, _BASE
    with np.errstate(over="ignore"):
        while n < k:
            h = h[:-n] * power + h[n:]
            n, power = 2 * n, power * power
    return mixed(h)


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    n = 1
    while 2 * n <= w:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    return np.minimum(x[: len(x) - (w - n)], x[w - n :]) if w > n else x


def regions(data: np.ndarray, first: np.ndarray, size: np.ndarray, length: int = LENGTH,
            gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """Regions of texts that lie in ``data`` one after the other.

    Gives anchor hashes, the text of each region, and, counted in that text, the
    starts of its first and last string and of its anchor.
    """
    w = length - gram + 1
    total = len(data) - length + 1
    for lo in range(0, max(total, 0), STEP):
        part = data[lo : lo + STEP + length - 1]
        hashes = _gram_hashes(part, gram)
        # The smallest hash and, among equals, the leftmost; its place is in the low bits.
        key = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
        least = _sliding_min(key, w)
        text = np.searchsorted(first, np.arange(lo, lo + len(least)), side="right") - 1
        inside = np.arange(lo, lo + len(least)) + length <= first[text] + size[text]
        new = np.concatenate([[True], (least[1:] != least[:-1]) | (text[1:] != text[:-1])])
        start = np.flatnonzero(new & inside)
        if not len(start):
            continue
        stop = np.flatnonzero(np.concatenate([(new | ~inside)[1:], [True]]))
        end = stop[np.searchsorted(stop, start)]
        anchor = (least[start] & _LOW).astype(np.int64)
        own = text[start]
        base = lo - first[own]
        # Other anchors may share what is left of a hash; it only chooses what is sorted.
        yield hashes[anchor] >> np.uint64(16), own, start + base, end + base, anchor + base


class _Texts:
    """Texts as one array of bytes."""

    def __init__(self, raw: list[bytes]):
        self.size = np.array([len(r) for r in raw], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        # Empty texts share their start with the next; the last of equals is looked up.
        self.regions = lambda length, gram: regions(self.data, self.first, self.size, length, gram)


def _batches(frames: Iterator[pd.DataFrame], most: int = 1 << 21) -> Iterator[pd.DataFrame]:
    for frame in frames:
        sizes = frame.raw.str.len().to_numpy()
        group = (np.cumsum(sizes) - sizes) // most
        for lo in np.unique(group):
            yield frame[group == lo]


# -- step 1 ---------------------------------------------------------------------


def _counts(length: int, gram: int):
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _batches(frames):
            found = [r[0] for r in _Texts(frame.raw.tolist()).regions(length, gram)]
            h, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
            yield pd.DataFrame({"h": h.view(np.int64), "n": n.astype(np.int64)})

    return count


def _anchors(length: int, gram: int):
    """Regions as (start of the first string, of the last, of the anchor) in one number."""

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _batches(frames):
            place, mark = frame.place.to_numpy(), frame.mark.to_numpy()
            for h, own, s, e, a in _Texts(frame.raw.tolist()).regions(length, gram):
                packed = (s << 16) | ((e - s) << 8) | (a - s)
                yield pd.DataFrame({"h": h.view(np.int64), "place": place[own], "mark": mark[own],
                                    "region": packed})

    return find


# -- step 2 ---------------------------------------------------------------------


def _common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    most = min(len(a), len(b))
    if a[known:most] == b[known:most]:
        return most
    lo, hi = known, most
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def encode_run(suffixes: dict[bytes, dict[bytes, list[tuple]]]) -> bytes:
    """A sorted, front-coded run: of every suffix its common prefix with the one
    before, the rest, and its left sides with what refers to them."""
    numbers, blob = [len(suffixes)], []
    before = b""
    for right in sorted(suffixes):
        shared = _common(before, right, 0)
        sides = suffixes[right]
        numbers += (shared, len(right) - shared, len(sides))
        blob.append(right[shared:])
        for left, refs in sides.items():
            numbers += (len(left), len(refs))
            blob.append(left)
            for ref in refs:
                numbers += ref
        before = right
    head = np.array(numbers, np.int64)
    body = head.tobytes() + b"".join(blob)
    return len(head).to_bytes(8, "little") + zstandard.ZstdCompressor(level=3).compress(body)


def decode_run(run: bytes) -> Iterator[tuple[int, bytes, list[tuple[bytes, list[tuple]]]]]:
    """The suffixes of a run, in order: common prefix with the one before, suffix, and sides."""
    n = int.from_bytes(run[:8], "little")
    body = zstandard.ZstdDecompressor().decompress(run[8:])
    numbers = np.frombuffer(body[: 8 * n], np.int64).tolist()
    at, i, right = 8 * n, 1, b""
    for _ in range(numbers[0]):
        shared, rest, n_sides = numbers[i : i + 3]
        i += 3
        right = right[:shared] + body[at : at + rest]
        at += rest
        sides = []
        for _ in range(n_sides):
            size, n_refs = numbers[i : i + 2]
            i += 2
            refs = [tuple(numbers[i + 3 * j : i + 3 * j + 3]) for j in range(n_refs)]
            i += 3 * n_refs
            sides.append((body[at : at + size], refs))
            at += size
        yield shared, right, sides


def _meet(sides: dict[bytes, list[tuple]], left: bytes, refs: list[tuple], given: list[tuple]) -> bool:
    """Puts a single string to those that share its suffix, and says if it is new there.

    A string met again goes to ``given`` with every occurrence not given out before,
    and is kept without references.
    """
    known = sides.get(left)
    if known is None:
        sides[left] = refs
        return True
    given.extend((*ref, len(left)) for ref in known + refs)
    sides[left] = []
    return False


def _given(given: list[tuple], length: int) -> pd.DataFrame:
    """Ranges of single strings; those of one document that start next to each other are
    one, as far as its size fits its code."""
    place, mark, a, ahead = np.array(given, np.int64).reshape(-1, 4).T
    start = a - ahead
    order = np.lexsort((start, mark, place))
    place, mark, start = place[order], mark[order], start[order]
    new = np.ones(len(start), bool)
    new[1:] = ((place[1:] != place[:-1]) | (mark[1:] != mark[:-1])
               | (start[1:] > start[:-1] + 1) | (start[1:] >> 19 != start[:-1] >> 19))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start))[: len(first)] - 1
    span = (start[first] << 20) | (start[last] - start[first] + length)
    return pd.DataFrame({"part": np.int32(-1), "number": np.int64(-1), "run": None,
                         "place": place[first], "mark": mark[first], "span": span})


def _written(parts: list[int], number: int, runs: list[bytes]) -> pd.DataFrame:
    return pd.DataFrame({"part": np.array(parts, np.int32), "number": np.int64(number), "run": runs,
                         "place": np.int64(0), "mark": np.int64(0), "span": np.int64(0)})


def _runs(parts: int, length: int, gram: int):
    """Runs of regions, runs of the single strings behind frequent anchors, and the
    ranges of single strings that are repeated within their run."""

    def make(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_runs: dict[int, dict] = defaultdict(dict)
        single: dict[int, dict] = defaultdict(dict)
        given: list[tuple] = []
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        held = 0

        def close() -> Iterator[pd.DataFrame]:
            for some, n in ((open_runs, -1), (single, number)):
                full = sorted(p for p, run in some.items() if run)
                yield _written(full, n, [encode_run(some[p]) for p in full])
                some.clear()

        unpack = zstandard.ZstdDecompressor()
        for frame in frames:
            for place, mark, packed, found in zip(frame.place, frame.mark, frame.packed, frame.regions):
                raw = unpack.decompress(packed)
                for code in np.unique(found).tolist():
                    hot, code = code & 1, code >> 1
                    s, reach, ahead = code >> 16, (code >> 8) & 255, code & 255
                    e, a = s + reach, s + ahead
                    if not hot:
                        run = open_runs[xxhash.xxh64_intdigest(raw[a : a + gram]) % parts]
                        sides = run.setdefault(raw[a : e + length], {})
                        sides.setdefault(raw[s:a], []).append((place, mark, a))
                        held += length + 24
                        continue
                    for p in range(s, e + 1):
                        run = single[xxhash.xxh64_intdigest(raw[p : p + length]) % parts]
                        sides = run.setdefault(raw[a : p + length], {})
                        if _meet(sides, raw[p:a], [(place, mark, a)], given):
                            held += length + 24
                    if len(given) >= GIVEN:
                        yield _given(given, length)
                        given.clear()
                    if held >= RUN_BYTES:
                        yield from close()
                        number, held = number + 1, 0
                if held >= RUN_BYTES:
                    yield from close()
                    number, held = number + 1, 0
        yield from close()
        yield _given(given, length)

    return make


# -- step 3 ---------------------------------------------------------------------


class LoserTree:
    """Merges sorted runs of suffixes.

    Each run's head is kept with the length of the prefix it shares with the suffix
    given out last. Of two heads the one that shares more is smaller; only where
    they share the same are bytes compared, and only behind that prefix. What a
    comparison learns is the loser's common prefix with the winner.
    """

    def __init__(self, runs: list[Iterator]):
        self.runs = runs
        self.heads: list[tuple[bytes, list] | None] = [None] * len(runs)
        self.shared = [0] * len(runs)
        size = 1
        while size < len(runs):
            size *= 2
        self.size = size
        for i in range(len(runs)):
            self._next(i, first=True)
        self.losers = [-1] * size
        self.winner = self._build(1)

    def _next(self, i: int, first: bool = False) -> None:
        found = next(self.runs[i], None)
        if found is None:
            self.heads[i] = None
        else:
            # The head given out last was this run's, so its own code says what is shared.
            self.shared[i] = 0 if first else found[0]
            self.heads[i] = found[1:]

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """Winner and loser of two runs; -1 is a place without a run."""
        if a < 0 or (b >= 0 and self.heads[a] is None):
            return b, a
        if b < 0 or self.heads[b] is None:
            return a, b
        x, y = self.shared[a], self.shared[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        left, right = self.heads[a][0], self.heads[b][0]
        same = _common(left, right, x)
        if left[same:] <= right[same:]:
            self.shared[b] = same
            return a, b
        self.shared[a] = same
        return b, a

    def _build(self, node: int) -> int:
        if node >= self.size:
            leaf = node - self.size
            return leaf if leaf < len(self.runs) else -1
        winner, self.losers[node] = self._play(self._build(2 * node), self._build(2 * node + 1))
        return winner

    def __iter__(self) -> Iterator[tuple[int, bytes, list]]:
        """Common prefix with the suffix before, suffix, and sides, in order."""
        while self.winner >= 0 and self.heads[self.winner] is not None:
            i = self.winner
            suffix, sides = self.heads[i]
            yield self.shared[i], suffix, sides
            self._next(i)
            node, winner = (i + self.size) // 2, i
            while node:
                winner, self.losers[node] = self._play(winner, self.losers[node])
                node //= 2
            self.winner = winner


def _repeated(group: list[list], length: int) -> Iterator[tuple[list[tuple], int, int]]:
    """Of the suffixes behind one gram: references, and the least and the greatest
    distance from the anchor back to a repeated string's start.

    An item is [common prefix with the one before, suffix, sides].
    """
    entries = []
    for rank, (_, right, sides) in enumerate(group):
        for left, refs in sides.items():
            # Its strings start between these distances left of the anchor.
            entries.append((rank, left, refs, length - len(right), len(left)))
    if len(entries) == 1:
        _, _, refs, low, high = entries[0]
        if len(refs) > 1:
            yield refs, low, high
        return
    whole = [len(refs) > 1 for _, _, refs, _, _ in entries]
    for entry, full in zip(entries, whole):
        if full:
            yield entry[2], entry[3], entry[4]
    if all(whole):
        return
    shared = [item[0] for item in group]
    if len(entries) <= 6:
        for i, (rank, left, refs, low, high) in enumerate(entries):
            if whole[i]:
                continue
            for j, (other, beside, _, least, most) in enumerate(entries):
                if i == j:
                    continue
                a, b = min(rank, other), max(rank, other)
                ahead = min(shared[a + 1 : b + 1], default=len(group[a][1]))
                back = _common(left[::-1], beside[::-1], 0)
                lo, hi = max(low, least, length - ahead), min(high, most, back)
                if lo <= hi:
                    yield refs, lo, hi
        return
    for d in range(min(e[3] for e in entries), max(e[4] for e in entries) + 1):
        # Suffixes that share the string's part ahead of the anchor are one class.
        number, classes = 0, []
        for i, common in enumerate(shared):
            number += i > 0 and common < length - d
            classes.append(number)
        seen: dict[tuple, list] = {}
        for i, (rank, left, refs, low, high) in enumerate(entries):
            if low <= d <= high:
                seen.setdefault((classes[rank], left[len(left) - d :]), []).append(i)
        for equal in seen.values():
            if len(equal) > 1:
                for i in equal:
                    if not whole[i]:
                        yield entries[i][2], d, d


def _merge(length: int, gram: int):
    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []

        def settle(group: list[list]) -> None:
            for refs, low, high in _repeated(group, length):
                out.extend((place, mark, a - high, a - low + length) for place, mark, a in refs)

        group: list[list] = []
        for shared, suffix, sides in LoserTree([decode_run(run) for run in frame.run]):
            if group and shared == len(suffix) == len(group[-1][1]):
                own = group[-1][2]
                for left, refs in sides:
                    own[left] = own[left] + refs if left in own else refs
                continue
            if group and shared < gram:
                settle(group)
                group = []
            group.append([shared, suffix, dict(sides)])
        if group:
            settle(group)
        places, marks, starts, ends = zip(*out) if out else ((), (), (), ())
        return pd.DataFrame({
            "place": np.array(places, np.int64), "mark": np.array(marks, np.int64),
            "span": (np.array(starts, np.int64) << 20) | (np.array(ends, np.int64) - np.array(starts, np.int64)),
        })

    return merge


def _merge_single(length: int, last: bool):
    """Ranges of the single strings that meet, and one run of all of them unless this
    is the last round."""

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        kept: dict[bytes, dict[bytes, list[tuple]]] = {}
        given: list[tuple] = []
        before, own = None, {}
        for _, suffix, sides in LoserTree([decode_run(run) for run in frame.run]):
            if suffix != before:
                before, own = suffix, {}
                if not last:
                    kept[suffix] = own
            for left, refs in sides:
                _meet(own, left, refs, given)
        out = _given(given, length)
        if not last:
            run = _written([frame.part.iloc[0]], frame.salt.iloc[0], [encode_run(kept)])
            out = pd.concat([out, run], ignore_index=True)
        return out

    return merge


def _single_ranges(written: DataFrame, length: int, fan: int) -> DataFrame | None:
    """The ranges of repeated single strings, if there are any such strings."""
    ranges = None
    while True:
        own = written.where("part < 0").select("place", "mark", "span")
        ranges = own if ranges is None else ranges.unionByName(own)
        runs = written.where("part >= 0 AND number >= 0").select("part", "number", "run")
        most = runs.groupBy("part").count().agg(F.max("count")).first()[0]
        if most is None:
            return None
        groups = -(-most // fan)
        met = (
            runs.select("part", "run", F.pmod(F.xxhash64("number"), F.lit(groups)).alias("salt"))
            .groupBy("part", "salt")
            .applyInPandas(_merge_single(length, groups == 1), RUNS)
        )
        if groups == 1:
            return ranges.unionByName(met.select("place", "mark", "span"))
        written = materialise(met)


# -- step 4 ---------------------------------------------------------------------


def united(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the ranges; ranges that touch are one run."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])]


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    unpack = zstandard.ZstdDecompressor()
    for frame in frames:
        rows = []
        for place, packed, spans in zip(frame.place.tolist(), frame.packed, frame.spans):
            raw, removed, runs = unpack.decompress(packed), 0, 0
            kept = hashlib.sha256()
            at = 0
            if spans is not None and len(spans):
                codes = np.unique(np.asarray(spans, np.int64))
                first = codes >> 20
                for a, b in zip(*united(first, first + (codes & ((1 << 20) - 1)))):
                    kept.update(raw[at:a])
                    at, removed, runs = int(b), removed + int(b - a), runs + 1
            kept.update(raw[at:])
            rows.append((place, len(raw), removed, runs, kept.hexdigest()))
        yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    packer = zstandard.ZstdCompressor(level=9)
    for frame in frames:
        yield frame.drop(columns="raw").assign(packed=[packer.compress(raw) for raw in frame.raw])


def _number_of_parts(repeated: DataFrame, length: int, gram: int, part_bytes: int) -> int:
    """As many parts as the regions of all repeated anchors fill.

    A region is at most ``2 * length - gram`` bytes. Those behind frequent anchors are
    counted as well, although their strings are merged in rounds of ``fan`` runs.
    """
    regions = repeated.agg(F.sum("n")).first()[0] or 0
    least = 2 * int(repeated.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-regions * (2 * length - gram) // part_bytes))


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    hot: int = HOT,
    fan: int = FAN,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """n_bytes, n_removed, n_spans and kept_sha256 of every document.

    Each byte covered by a string of ``length`` bytes that also starts anywhere else
    is removed; strings are judged on the input, overlaps count, and matches never
    cross documents. Null texts are empty. Repeated rows are documents of their own,
    so a repeated text of ``length`` bytes or more goes in all of them. Extra columns
    are left out. ``gram`` is a power of two, and ``length - gram`` below 256.
    """
    if gram & (gram - 1) or not 0 <= length - gram < 256:
        raise ValueError("gram must be a power of two and length - gram in 0..255")
    if fan < 2:
        raise ValueError("at least two runs must meet")
    whole = texts_of(docs, id_column, text_column).select(
        F.coalesce("doc_id", F.lit(-(2**63))).alias("place"),
        F.xxhash64("text").alias("mark"), F.col("text").cast("binary").alias("raw"),
    )
    keys = ["place", "mark"]
    # Written, so that both sides of the join on a frequent anchor can be split.
    repeated = materialise(
        whole.select("raw").mapInPandas(_counts(length, gram), "h bigint, n bigint")
        .groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") > 1)
    )
    found = (
        whole.select(*keys, "raw")
        .mapInPandas(_anchors(length, gram), "h bigint, place bigint, mark bigint, region bigint")
        .join(repeated, "h")
        .groupBy(*keys)
        .agg(F.collect_list(F.col("region") * 2 + (F.col("n") > hot).cast("bigint")).alias("regions"))
    )
    packed = whole.mapInPandas(
        _pack, "place bigint, mark bigint, packed binary"
    )
    parts = _number_of_parts(repeated, length, gram, part_bytes)
    runs = materialise(
        packed.select(*keys, "packed").join(found, keys)
        .mapInPandas(_runs(parts, length, gram), RUNS)
    )
    ranges = (
        runs.where("part >= 0 AND number < 0").select("part", "run").groupBy("part")
        .applyInPandas(_merge(length, gram), "place bigint, mark bigint, span bigint")
    )
    single = _single_ranges(runs, length, fan)
    if single is not None:
        ranges = ranges.unionByName(single)
    ranges = ranges.groupBy(*keys).agg(F.collect_list("span").alias("spans"))
    return given_back(packed.join(ranges, keys, "left").select("place", "packed", "spans").mapInPandas(
        _cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    ))
