"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct word shingles, seen through ``TOKENS`` minwise
tokens. Every tree starts with all documents in its root. In a node a document
follows those of its tokens whose hash with the path so far falls below
``1 / (threshold * TOKENS)``; two documents stand in a common child wherever both
have a chosen token, so a pair at the threshold is expected to meet once per level
however deep the tree goes, while pairs with little in common soon part. The
trees are independent, and ``TREES`` of them bring a pair at the threshold
together but for a chance of about e**-TREES at the first level.

Documents with equal sets are one class and only classes meet. A node is settled in
steps, and what none of them settles branches once more:

* Every class is compared with one pivot of the node, which links the members of a
  large group of copies through it.
* Where all but ``LEAF`` classes of the node are connected by then, these few are
  compared with all that they are not yet connected with.
* Nodes in which one component prevails are taken together by that component, and
  their other classes compared with all of them. So a group of copies that many
  nodes hold, and whose members are not all linked, is compared once.
* Other nodes of up to ``WIDE`` classes are compared exhaustively.

Pairs are first judged by the sizes of their sets and by sketches of ``BITS`` bits,
with a margin of five standard deviations. Pairs that may reach the threshold are not
listed: a task only gives as many as connect the same classes. What these connect is
a cluster, and its classes are compared on their full sets, where again only as many
links are given as connect what is linked. No step brings more than a block of
classes of a node or cluster into one task; larger ones are compared in blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from ledgerlark.llm.common import carried, chunked, given_back, mixed, rolled, seeds, texts_of, whole_row, word_table
from ledgerlark.llm.components import components
from ledgerlark.session import materialise

SHINGLE = 5
#: Similarity that links, in hundredths.
PERCENT = 75
TOKENS = 64
TREES = 20
#: Classes of a node that may be compared with all others of it.
LEAF = 8
#: Classes of a node that are compared exhaustively, and of those that meet in one task.
WIDE, BLOCK = 16384, 4096
#: Full sets that a task holds to confirm pairs with, and four times as many partners.
VERIFY = 1000
#: Characters of text worked on at once.
PART = 400_000
#: Classes of a cluster whose full sets meet in one task, from either side.
SETS = 1000
#: Bits of a sketch.
BITS = 512
#: Up to so many ids (2 MB) are sent to every task to pick their texts.
MAX_SENT = 100_000
#: Levels after which a node is compared exhaustively whatever its size.
LEVELS = 12
SEED = 2

# Words stand between the ASCII white space.
GAPS = np.zeros(256, bool)
GAPS[[9, 10, 11, 12, 13, 32]] = True

_SLOTS = seeds(TOKENS, SEED)
_ORDER = seeds(2 * TOKENS, SEED + 1).astype(np.uint32)
_ROOTS = seeds(TREES, SEED + 2)
_CHOOSE = np.uint64(0xD6E8FEB86659FD93)
_BELOW = np.uint64(int(2.0**64 / (PERCENT / 100 * TOKENS)))


def shingle_sets(texts: list[str], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each, and their numbers.

    A text of fewer words than a shingle has its whole sequence as one; a text
    without words has none.
    """
    words, n = word_table(texts, GAPS)
    ends = np.cumsum(n)
    grams = rolled(words, k)
    sets = []
    for end, count in zip(ends, n):
        first = end - count
        if count >= k:
            sets.append(np.unique(grams[first : first + count - k + 1]))
        elif count:
            # Salted by the length, so that no sequence equals a shingle.
            sets.append(rolled(words[first:end], int(count)) ^ np.uint64(count))
        else:
            sets.append(np.zeros(0, np.uint64))
    sizes = np.array([len(s) for s in sets], np.int64)
    return np.concatenate([np.zeros(0, np.uint64), *sets]), sizes


def minwise_tokens(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``TOKENS`` minwise tokens of each non-empty set, one row a set."""
    start = np.cumsum(sizes) - sizes
    high, low = (hashes >> np.uint64(32)).astype(np.uint32), hashes & np.uint64(0xFFFFFFFF)
    out = np.zeros((len(sizes), TOKENS), np.uint64)
    for i in range(TOKENS):
        x = (high ^ _ORDER[i]) * (_ORDER[TOKENS + i] | np.uint32(1))
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(13)
        out[:, i] = np.minimum.reduceat((x.astype(np.uint64) << np.uint64(32)) | low, start)
    return mixed(out)


def children(tokens: np.ndarray, paths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of tokens at given paths, the rows that go on and their new paths."""
    with np.errstate(over="ignore"):
        path = mixed((tokens ^ _SLOTS) + paths[:, None])
        row, slot = np.nonzero(mixed(path ^ _CHOOSE) < _BELOW)
    return row, path[row, slot]


def sketches(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``BITS`` bits of each non-empty set, packed, one row a set.

    The range of the hashes is cut into as many bins; the least hash of a bin gives
    its bit, and an empty bin takes that of the next one that is not. ``hashes`` are
    sorted within each set, so the least of a bin is its first.
    """
    n = len(sizes)
    shift = np.uint64(64 - (BITS.bit_length() - 1))
    cell = np.repeat(np.arange(n), sizes) * BITS + (hashes >> shift).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    cells = cell[first]
    owner = cells // BITS
    # For every bin the place of the first filled one at or behind it, around the end.
    ends = np.searchsorted(owner, np.arange(n), side="right")
    at = np.searchsorted(cells, np.arange(n * BITS))
    begin = np.concatenate([[0], ends[:-1]])
    row = np.repeat(np.arange(n), BITS)
    at = np.where(at < ends[row], at, begin[row])
    # A borrowed bit depends on how far it was borrowed, so that copies differ.
    distance = (cells[at] - np.arange(n * BITS)) % BITS
    bits = mixed(hashes[first][at] + mixed(distance.astype(np.uint64) + _CHOOSE)) & np.uint64(1)
    return np.packbits(bits.astype(bool).reshape(n, BITS), axis=1)


def _sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for part in chunked(frame, PART):
            hashes, sizes = shingle_sets(part.text.tolist())
            full = np.flatnonzero(sizes > 0)
            tokens = np.zeros((len(part), TOKENS), np.uint64)
            bits = np.zeros((len(part), BITS // 8), np.uint8)
            k1, k2 = np.zeros(len(part), np.uint64), np.zeros(len(part), np.uint64)
            paths = [[] for _ in range(len(part))]
            if len(full):
                tokens[full] = minwise_tokens(hashes, sizes[full])
                bits[full] = sketches(hashes, sizes[full])
                start = (np.cumsum(sizes) - sizes)[full]
                with np.errstate(over="ignore"):
                    k1[full] = np.add.reduceat(mixed(hashes), start)
                    k2[full] = np.add.reduceat(mixed(hashes ^ _CHOOSE), start)
                found = []
                for root in _ROOTS:
                    row, path = children(tokens[full], np.full(len(full), root))
                    found.append((full[row], path))
                row = np.concatenate([r for r, _ in found])
                path = np.concatenate([p for _, p in found]).view(np.int64)
                order = np.argsort(row, kind="stable")
                cuts = np.searchsorted(row[order], np.arange(1, len(part)))
                paths = [p.tolist() for p in np.split(path[order], cuts)]
            yield pd.DataFrame({
                "doc_id": part.doc_id, "mark": part.mark, "n": sizes, "k1": k1.view(np.int64), "k2": k2.view(np.int64),
                "tokens": [row.tobytes() if n else None for row, n in zip(tokens, sizes)],
                "bits": [row.tobytes() if n else None for row, n in zip(bits, sizes)],
                "paths": paths,
            })


def _sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for part in chunked(frame, PART):
            hashes, sizes = shingle_sets(part.text.tolist())
            with np.errstate(over="ignore"):
                rows = [
                    (int(mixed(s).sum(dtype=np.uint64).view(np.int64)), s.view(np.int64))
                    for s in np.split(hashes, np.cumsum(sizes)[:-1])
                ]
            yield pd.DataFrame({"k1": [k for k, _ in rows], "n": sizes, "shingles": [s for _, s in rows]})


def may_link(alike: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether pairs with so many equal bits, the smaller set having ``n`` shingles, may
    reach the threshold. Of two sketches the bits of what both hold are equal, and half
    of the rest; as many bits count as there are bins that a set of ``n`` fills."""
    share = (1 + PERCENT / 100) / 2
    filled = BITS * -np.expm1(-n / BITS)
    margin = 5 * np.sqrt(share * (1 - share) / filled)
    return alike >= (share - margin) * BITS


def _words(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint64).reshape(-1, BITS // 64)


@F.pandas_udf(BooleanType())
def _alike(a: pd.Series, b: pd.Series, n: pd.Series) -> pd.Series:
    """Whether the sketches of two classes, the smaller of ``n``, allow a link."""
    if not len(a):
        return pd.Series([], dtype="bool")
    differ = np.bitwise_count(_words(a) ^ _words(b)).sum(1, dtype=np.int64)
    return pd.Series(may_link(BITS - differ, n.to_numpy().astype(np.float64)))


class _Forest:
    """Components of numbered places, joined one place with several others at a time."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, place: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` that were in components of their own, one of each."""
        found, first = np.unique(self.label[others], return_index=True)
        new = found != self.label[place]
        if new.any():
            joined = np.zeros(len(self.label), bool)
            joined[found] = True
            self.label[joined[self.label]] = self.label[place]
        return others[first[new]]


def _near(here: pd.DataFrame, there: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """For each place of one frame the places of the other whose classes it is not
    connected with and may link."""
    if not len(here) or not len(there):
        return
    bits, others = _words(here.bits), _words(there.bits)
    n, sizes = here.n.to_numpy(), there.n.to_numpy()
    v, names = here.v.to_numpy(), there.v.to_numpy()
    label, labels = here.label.to_numpy(), there.label.to_numpy()
    for i in range(len(here)):
        alike = BITS - np.bitwise_count(others ^ bits[i]).sum(1, dtype=np.int64)
        least = np.minimum(sizes, n[i])
        fits = (labels != label[i]) & (names != v[i])
        fits &= 100 * least >= PERCENT * np.maximum(sizes, n[i])
        fits &= may_link(alike, least.astype(np.float64))
        found = np.flatnonzero(fits)
        if len(found):
            yield i, found


def _compare(block: pd.DataFrame) -> pd.DataFrame:
    """Of the pairs of a block that may link, as many as connect the same classes."""
    here, there = block[block.asks], block[~block.asks]
    names, place = np.unique(np.concatenate([here.v, there.v]), return_inverse=True)
    forest, out_a, out_b = _Forest(len(names)), [], []
    for i, found in _near(here, there):
        kept = forest.join(place[i], place[len(here) + found])
        out_a.append(np.minimum(names[kept], names[place[i]]))
        out_b.append(np.maximum(names[kept], names[place[i]]))
    nothing = np.zeros(0, np.int64)
    return pd.DataFrame({"a": np.concatenate([nothing, *out_a]), "b": np.concatenate([nothing, *out_b])})


def _shares(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Whether a set reaches the threshold with each of some others."""
    sizes = np.array([len(x) for x in others])
    values = np.concatenate(others)
    place = np.minimum(np.searchsorted(own, values), len(own) - 1)
    common = np.add.reduceat((own[place] == values).astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * common >= PERCENT * (len(own) + sizes - common)


def _link(block: pd.DataFrame) -> pd.DataFrame:
    """Of the links between the classes of a block, confirmed on their full sets, as
    many as connect the same classes."""
    here, there = block[block.asks], block[~block.asks]
    sets, others = _arrays(here.shingles), _arrays(there.shingles)
    names, place = np.unique(np.concatenate([here.v, there.v]), return_inverse=True)
    forest, out_a, out_b = _Forest(len(names)), [], []
    for i, found in _near(here, there):
        # What is connected by now needs no look.
        spots = place[len(here) + found]
        found = found[forest.label[spots] != forest.label[place[i]]]
        for lo in range(0, len(found), 100):
            some = found[lo : lo + 100]
            linked = some[_shares(sets[i], [others[j] for j in some])]
            if len(linked):
                kept = forest.join(place[i], place[len(here) + linked])
                out_a.append(np.minimum(names[kept], names[place[i]]))
                out_b.append(np.maximum(names[kept], names[place[i]]))
    nothing = np.zeros(0, np.int64)
    return pd.DataFrame({"a": np.concatenate([nothing, *out_a]), "b": np.concatenate([nothing, *out_b])})


def _arrays(column) -> list[np.ndarray]:
    return [np.asarray(x, np.int64).view(np.uint64) for x in column]


def _verify(block: pd.DataFrame) -> pd.DataFrame:
    """Pairs of a block that reach the threshold; rows without ``b`` hold a set."""
    known = block.b.isna().to_numpy()
    sets = {v: np.asarray(s, np.int64).view(np.uint64) for v, s in zip(block.a[known], block.shingles[known])}
    pairs = block[~known].sort_values("a")
    a, b = pairs.a.to_numpy(np.int64), pairs.b.to_numpy(np.int64)
    linked = np.zeros(len(a), bool)
    cuts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, int)
    # One set against up to 100 others at once.
    starts = [i for lo, hi in zip(cuts, [*cuts[1:], len(a)]) for i in range(lo, hi, 100)]
    for lo, hi in zip(starts, [*starts[1:], len(a)]):
        linked[lo:hi] = _shares(sets[a[lo]], [sets[v] for v in b[lo:hi]])
    return pd.DataFrame({"a": a[linked], "b": b[linked]})


class _Join:
    """The state of the join: classes, verified links, and what was compared."""

    def __init__(self, docs: DataFrame, sketch: DataFrame):
        self.docs, self.sketch = docs, sketch
        full = sketch.where(F.col("n") > 0)
        # A class is known by its least row number.
        self.classes = full.groupBy("k1", "k2", "n").agg(F.min("row").alias("v"))
        self.vertices = materialise(
            full.join(self.classes.select(F.col("v").alias("row")), "row", "left_semi")
            .select(F.col("row").alias("v"), "doc_id", "k1", "n", "tokens", "bits", "paths")
        )
        self.links = self.open = self.labels = self.sets = None

    def judged(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``a`` < ``b`` that sizes and sketches allow to link."""
        bits = self.vertices.select("v", "n", "bits")
        return (
            pairs.distinct()
            .join(bits.select(F.col("v").alias("a"), F.col("n").alias("na"), F.col("bits").alias("xa")), "a")
            .join(bits.select(F.col("v").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("xb")), "b")
            # What two sets share is at most the smaller, and their union at least the larger.
            .where(100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb"))
            .where(_alike("xa", "xb", F.least("na", "nb")))
            .select("a", "b")
        )

    def take(self, found: DataFrame) -> None:
        found = materialise(found)
        if not found.isEmpty():
            self.links = found if self.links is None else self.links.unionByName(found)
            self.open = found if self.open is None else self.open.unionByName(found)

    def confirm(self, pairs: DataFrame) -> None:
        """Compare pairs ``a`` < ``b``, a few of each class, and take the links."""
        judged = materialise(self.judged(pairs))
        if not judged.isEmpty():
            self._fetch(judged.select(F.col("a").alias("v")).union(judged.select("b")).distinct())
            self.take(self._verified(judged))

    def link_clusters(self, near: DataFrame) -> None:
        """Take the links among the classes that ``near`` connects with each other.

        ``near`` holds pairs that may link, at least as many as connect all that do. The
        classes that it connects are a cluster, and all of a cluster are compared.
        """
        near = materialise(near)
        if near.isEmpty():
            return
        roots = components(near)
        members = roots.select(F.col("a").alias("v"), F.col("b").alias("g")).union(
            roots.select("b", "b")).distinct()
        self._fetch(members.select("v"))
        rows = self.labelled(members.withColumn("major", F.lit(None).cast("bigint")))
        rows = rows.join(self.sets.select("v", "shingles"), "v")
        self.take(_in_blocks(self, rows, ["shingles"], _link, SETS))

    def _verified(self, judged: DataFrame) -> DataFrame:
        """The pairs that reach the threshold on their full sets.

        Pairs are dealt to blocks by their first class, and within a block by their
        second if these are many; a set travels once to every block that needs it.
        """
        blocks = max(1, -(-self.sets.count() // VERIFY))
        dealt = judged.withColumn("i", F.pmod(F.xxhash64("a"), F.lit(blocks)))
        wide = dealt.groupBy("i").agg(
            F.ceil(F.approx_count_distinct("b") / (4 * VERIFY)).alias("wide"))
        dealt = dealt.join(wide, "i").select("i", F.pmod(F.xxhash64("b"), "wide").alias("j"), "a", "b")
        needed = dealt.select("i", "j", F.col("a").alias("v")).union(dealt.select("i", "j", "b")).distinct()
        sets = needed.join(self.sets, "v").select("i", "j", F.col("v").alias("a"), F.lit(None).cast("bigint").alias("b"), "shingles")
        pairs = dealt.withColumn("shingles", F.lit(None).cast("array<bigint>"))
        return sets.unionByName(pairs).groupBy("i", "j").applyInPandas(_verify, "a bigint, b bigint")

    def _fetch(self, wanted: DataFrame) -> None:
        """Have the full sets of the classes ``v``; each is made from its text once."""
        if self.sets is not None:
            wanted = wanted.join(self.sets.select("v"), "v", "left_anti")
        keys = materialise(self.vertices.join(wanted, "v", "left_semi").select(
            "v", F.coalesce("doc_id", F.lit(-(2**63))).alias("place"), "k1", "n"
        ))
        missing = keys.limit(MAX_SENT + 1).count()
        if not missing:
            return
        ids = keys.select("place").distinct()
        texts = self.docs.withColumn("place", F.coalesce("doc_id", F.lit(-(2**63))))
        texts = texts.join(F.broadcast(ids) if missing <= MAX_SENT else ids, "place", "left_semi")
        sets = texts.select("text").mapInPandas(_sets, "k1 bigint, n bigint, shingles array<bigint>")
        # Rows that share an id or a text may give more sets than are wanted.
        new = sets.join(keys.select("v", "k1", "n"), ["k1", "n"]).dropDuplicates(["v"])
        new = materialise(new.select("v", "n", "shingles"))
        self.sets = new if self.sets is None else self.sets.unionByName(new)

    def settle(self) -> None:
        """Take links found since into the components."""
        if self.open is not None:
            known = self.open if self.labels is None else self.labels.unionByName(self.open)
            self.labels, self.open = components(known), None

    def labelled(self, nodes: DataFrame) -> DataFrame:
        """Rows of nodes with the component that each class is in so far."""
        self.settle()
        if self.labels is None:
            return nodes.withColumn("label", F.col("v"))
        known = self.labels.select(F.col("a").alias("v"), F.col("b").alias("found"))
        return nodes.join(known, "v", "left").select(
            *nodes.columns, F.coalesce("found", "v").alias("label")
        )


def _shared(nodes: DataFrame) -> DataFrame:
    """Rows of the nodes that hold more than one class."""
    nodes = nodes.distinct()
    shared = nodes.groupBy("path").count().where(F.col("count") > 1).select("path")
    return nodes.join(shared, "path")


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _run(join: _Join) -> None:
    nodes = join.vertices.select(F.explode("paths").alias("path"), "v")
    for level in range(1, LEVELS + 1):
        nodes = materialise(_shared(nodes))
        if nodes.isEmpty():
            return
        pivots = nodes.groupBy("path").agg(
            F.min(F.struct(F.xxhash64("path", "v").alias("h"), "v")).alias("p")
        ).select("path", F.col("p.v").alias("p"))
        join.confirm(
            nodes.join(pivots, "path").where(F.col("v") != F.col("p"))
            .select(*_ordered(F.col("v"), F.col("p")))
        )
        open_rows = materialise(join.labelled(nodes))
        parts = open_rows.groupBy("path", "label").agg(F.count("*").alias("n"))
        sizes = parts.groupBy("path").agg(
            F.sum("n").alias("size"), F.max(F.struct("n", "label")).alias("most"),
        ).where(F.col("size") > F.col("most.n"))
        sizes = sizes.select("path", "size", F.col("most.label").alias("major"),
                             (F.col("size") - F.col("most.n")).alias("minor"))
        rows = materialise(open_rows.join(sizes, "path"))
        few, prevails = F.col("minor") <= LEAF, 2 * F.col("minor") <= F.col("size")
        now = rows.where(few)
        pairs = now.select("path", "v", "label").join(
            now.where(F.col("label") != F.col("major")).select(
                "path", F.col("v").alias("w"), F.col("label").alias("other")), "path"
        ).where(F.col("label") != F.col("other")).select(*_ordered(F.col("v"), F.col("w")))
        ends = F.lit(level == LEVELS) | (F.col("size") <= WIDE)
        groups = rows.where(~few & (prevails | ends)).select(
            F.when(prevails, F.xxhash64("major")).otherwise(F.col("path")).alias("g"),
            F.when(prevails, F.col("major")).alias("major"), "v", "label",
        ).distinct()
        near = _in_blocks(join, groups, [], _compare, BLOCK)
        join.link_clusters(join.judged(pairs).unionByName(near))
        nodes = rows.where(~few & ~prevails & ~ends).select("path", "v").join(
            join.vertices.select("v", "tokens"), "v"
        ).mapInPandas(_branch, "path bigint, v bigint")


def _in_blocks(
    join: _Join, groups: DataFrame, more: list[str], compare: Callable, block: int
) -> DataFrame:
    """Pairs of the groups ``g``: of the classes outside the component ``major``, or of
    all where there is none, with every class of the group.

    Either side is cut into blocks, and every two blocks meet in a task of their own.
    """
    outside = F.col("major").isNull() | (F.col("label") != F.col("major"))
    counts = groups.groupBy("g").agg(
        F.ceil(F.count("*") / block).alias("wide"), F.ceil(F.count_if(outside) / block).alias("long")
    )
    rows = groups.join(counts, "g").join(join.vertices.select("v", "n", "bits"), "v")
    rows = rows.withColumn("spot", F.xxhash64("v", F.lit(SEED)))

    def upto(name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), (F.col(name) - 1).cast("int")))

    kept = ["g", "v", "n", "bits", "label", *more]
    few = rows.where(outside).select(
        *kept, F.pmod("spot", "long").cast("int").alias("i"), upto("wide").alias("j"), F.lit(True).alias("asks"))
    wide = rows.where("long > 0").select(
        *kept, upto("long").alias("i"), F.pmod("spot", "wide").cast("int").alias("j"), F.lit(False).alias("asks"))
    # Where a group has no component of its own, two blocks meet once.
    both = few.unionByName(wide).join(groups.groupBy("g").agg(F.count("major").alias("has")), "g")
    both = both.where((F.col("has") > 0) | (F.col("i") <= F.col("j"))).drop("has")
    return both.groupBy("g", "i", "j").applyInPandas(compare, "a bigint, b bigint")


def _branch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        if not len(frame):
            continue
        tokens = np.frombuffer(b"".join(frame.tokens), np.uint64).reshape(-1, TOKENS)
        row, path = children(tokens, frame.path.to_numpy().view(np.uint64))
        yield pd.DataFrame({"path": path.view(np.int64), "v": frame.v.to_numpy()[row]})


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and n_tree_links of every document.

    Documents are linked if their shingle sets reach the similarity; the component
    is the least id reachable over links, and the document that has it is kept.
    Texts without words, null ones included, are linked with nothing. ``n_tree_links``
    counts the links of the document's class in a spanning forest of the confirmed links,
    not all that it has. Rows that
    share an id are judged row by row; of repeated rows each is kept or not alike.
    A null id is never kept. Extra columns are left out.
    """
    return _judged(texts_of(docs, id_column, text_column)).select(
        "doc_id", "n_shingles", "component_id", "kept", "n_tree_links"
    )


def _judged(whole: DataFrame) -> DataFrame:
    """One row per document, with the hash of its text and the component's vertex."""
    sketch = materialise(
        given_back(carried(whole.withColumn("mark", F.xxhash64("text"))).mapInPandas(
            _sketch, "doc_id bigint, mark bigint, n bigint, k1 bigint, k2 bigint,"
            " tokens binary, bits binary, paths array<bigint>",
        )).withColumn("row", F.monotonically_increasing_id())
    )
    join = _Join(whole, sketch)
    _run(join)
    join.settle()
    rows = sketch.select("doc_id", "mark", "n", "k1", "k2", "row")
    rows = rows.join(join.classes, ["k1", "k2", "n"], "left")
    rows = rows.select("doc_id", "mark", "n", F.coalesce("v", "row").alias("v"))
    if join.labels is not None:
        known = join.labels.select(F.col("a").alias("v"), F.col("b").alias("found"))
        ends = join.links.select(F.col("a").alias("v")).union(join.links.select("b"))
        degree = ends.groupBy("v").agg(F.count("*").alias("n_tree_links"))
        rows = rows.join(known, "v", "left").join(degree, "v", "left")
        rows = rows.select("doc_id", "mark", "n", F.coalesce("found", "v").alias("v"), "n_tree_links")
    else:
        rows = rows.withColumn("n_tree_links", F.lit(0))
    least = rows.groupBy("v").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "v").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
        F.coalesce("n_tree_links", F.lit(0)).cast("bigint").alias("n_tree_links"), "mark", "v",
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, of which one of each component stays.

    It is the one with the least id, null ids last, and with the least hash of its
    text among rows that share the id; of repeated rows one. Texts without words all
    stay.
    """
    place = F.coalesce(F.col(id_column).cast("bigint"), F.lit(2**63 - 1))
    mark = F.xxhash64(F.coalesce(text_column, F.lit("")))
    found = materialise(_judged(texts_of(docs, id_column, text_column)).select(
        F.coalesce("doc_id", F.lit(2**63 - 1)).alias("_place"), F.col("mark").alias("_mark"),
        (F.col("n_shingles") == 0).alias("bare"), "v",
    ))
    bare = found.where("bare").select("_place", "_mark", F.lit(False).alias("again")).distinct()
    first = found.where(~F.col("bare")).groupBy("v").agg(
        F.min(F.struct("_place", "_mark")).alias("one")
    ).select("one.*")
    copies = found.where(~F.col("bare")).groupBy("_place", "_mark").agg((F.count("*") > 1).alias("again"))
    chosen = first.join(copies, ["_place", "_mark"]).unionByName(bare)
    rows = docs.select(whole_row(docs), place.alias("_place"), mark.alias("_mark"))
    rows = rows.join(chosen, ["_place", "_mark"])
    # Only rows that are repeated as they are meet once more.
    once, again = rows.where(~F.col("again")), rows.where("again").dropDuplicates(["_place", "_mark"])
    return once.unionByName(again).select("row.*")
