"""Vector codes by ball k-means over the parts of integer vectors.

Every vector is cut into equal parts, and the parts at one position share a codebook.
The entry a part belongs to is the centre of a ball, whose radius is the distance of its
farthest part. By the triangle inequality, an entry can only be as near to a part as its
own entry is if the two entries are at most twice that far apart. So

* an entry's neighbours are those within twice its ball's radius;
* a part within half the distance of the nearest neighbour lies in the stable core and
  keeps its entry unseen;
* the neighbours, ordered by distance, cut the rest of the ball into rings, and a part
  in the k-th ring is compared with its first k neighbours alone.

All components are whole numbers and all comparisons are of squared distances in 64-bit
integers, so nothing is lost by skipping, ties included.

A round reads the vectors with their entries, assigns, and writes them with the new
entries; the last row of each task holds what its parts moved into and out of each entry, so
the next codebook needs a read of that one column. Codebooks are small (``parts`` x
``entries`` x the length of a part) and are all that the driver sees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.session import materialise

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Whole components are held within this, so that no squared distance leaves 64 bits.
LARGEST = 1 << 26
#: Labels whose sums of errors are sent to all tasks; more of them are joined by label.
SENT_LABELS = 100_000


@dataclass(frozen=True)
class Balls:
    """The entries of all parts and what lies around each of them.

    ``centre`` (part, entry, component); ``order`` (part, entry, k): its neighbours,
    nearest first, filled up with the entry itself; ``far`` (part, entry, k): their squared
    distances, filled up with the largest number.
    """

    centre: np.ndarray
    order: np.ndarray
    far: np.ndarray


def balls_of(centre: np.ndarray, radius: np.ndarray) -> Balls:
    """Neighbours of every entry, given a bound of the squared radius of its ball."""
    parts, entries, _ = centre.shape
    order = np.tile(np.arange(entries)[None, :, None], (parts, 1, entries))
    far = np.full((parts, entries, entries), np.iinfo(np.int64).max)
    for p in range(parts):
        apart = ((centre[p][:, None] - centre[p][None]) ** 2).sum(-1)
        for i in range(entries):
            near = np.flatnonzero(apart[i] <= 4 * radius[p, i])
            near = near[near != i]
            near = near[np.lexsort((near, apart[i, near]))]
            order[p, i, : len(near)] = near
            far[p, i, : len(near)] = apart[i, near]
    return Balls(centre, order, far)


def nearest(part: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of every part, of equally near ones the first, and its squared distance."""
    # Products of numbers this small are exact in doubles, and quicker.
    reach = max(int(np.abs(part).max(initial=0)), int(np.abs(centre).max(initial=0)), 1)
    kind = np.float64 if 4 * reach * reach * part.shape[1] < 1 << 52 else np.int64
    x, c = part.astype(kind), centre.astype(kind)
    own = ((c * c).sum(1) - 2 * (x @ c.T)).argmin(1)
    return own, ((part - centre[own]) ** 2).sum(1)


def reassign(part: np.ndarray, own: np.ndarray, balls: Balls, p: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``nearest``, from the entries that the parts belonged to so far."""
    centre, order, far = balls.centre[p], balls.order[p], balls.far[p]
    best, least = own.copy(), ((part - centre[own]) ** 2).sum(1)
    reach = 4 * least
    outside = np.flatnonzero(far[own, 0] <= reach)  # of the stable core
    outside = outside[np.argsort(own[outside], kind="stable")]
    ring = np.zeros(len(outside), np.int64)
    bounds = np.searchsorted(own[outside], np.arange(len(centre) + 1))
    for i in range(len(centre)):
        a, b = bounds[i], bounds[i + 1]
        if a < b:
            ring[a:b] = np.searchsorted(far[i], reach[outside[a:b]], side="right")
    by_ring = np.argsort(-ring, kind="stable")
    outside, ring = outside[by_ring], ring[by_ring]
    for k in range(int(ring[0]) if len(ring) else 0):
        some = outside[: np.searchsorted(-ring, -k, side="left")]  # those with more than k
        other = order[own[some], k]
        distance = ((part[some] - centre[other]) ** 2).sum(1)
        closer = (distance < least[some]) | ((distance == least[some]) & (other < best[some]))
        best[some[closer]], least[some[closer]] = other[closer], distance[closer]
    return best, least


class Tally:
    """What the parts of a task add to and take from each entry, and each ball's radius."""

    def __init__(self, parts: int, entries: int, length: int):
        self.shape = parts, entries, length + 2  # components, number, radius
        self.total = np.zeros(self.shape, np.int64)

    def add(self, p: int, part: np.ndarray, own: np.ndarray, sign: int = 1) -> None:
        entries = self.shape[1]
        for d in range(part.shape[1]):
            # Whole numbers below 2**53 whatever the batch, so the doubles are exact.
            moved = np.bincount(own, weights=part[:, d].astype(np.float64), minlength=entries)
            self.total[p, :, d] += sign * moved.astype(np.int64)
        self.total[p, :, -2] += sign * np.bincount(own, minlength=entries)

    def widen(self, p: int, own: np.ndarray, distance: np.ndarray) -> None:
        np.maximum.at(self.total[p, :, -1], own, distance)


def whole_components(batch: pa.RecordBatch, column: str, length: int) -> np.ndarray:
    """All vectors of a batch as whole numbers, one row each; those of a round before are already."""
    values = batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
    if values.dtype.kind != "f":
        return values.astype(np.int64)
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -LARGEST, LARGEST).astype(np.int64)


def _array(values: np.ndarray) -> pa.Array:
    """Rows of whole numbers as an Arrow list column."""
    n, length = values.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(n + 1, dtype=np.int32) * length), pa.array(values.astype(np.int32).ravel())
    )


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and has finite components only."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    return df.where(F.col(vector).isNotNull() & finite)


def _length_of(kept: DataFrame, parts: int) -> int:
    """The length that most vectors have, of those that can be cut; the longest of several."""
    found = (
        kept.groupBy(F.size("vector").alias("length")).count()
        .where((F.col("length") > 0) & (F.col("length") % parts == 0))
        .orderBy(F.desc("count"), F.desc("length")).first()
    )
    return found["length"] if found else 0


def _first_entries(kept: DataFrame, parts: int, entries: int, length: int) -> np.ndarray:
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    values = np.array([row.vector for row in first], np.float64).reshape(-1, length)
    values = np.clip(np.floor(values * SCALE), -LARGEST, LARGEST).astype(np.int64)
    return values.reshape(len(first), parts, -1).transpose(1, 0, 2)


def _state(label: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("vec_id", T.LongType()),
        T.StructField("label", label),
        T.StructField("vector", T.ArrayType(T.IntegerType())),
        T.StructField("codes", T.BinaryType()),
        T.StructField("moved", T.BinaryType()),
    ])


def _assigned(df: DataFrame, balls: Balls, label: T.DataType) -> DataFrame:
    """All vectors with their entries, and behind those of a task its ``moved``.

    Rows without ``codes`` are new and are compared with all entries; the others
    move from the entries they have.
    """
    parts, entries, width = balls.centre.shape
    schema = _state(label)
    first = "codes" not in df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(parts, entries, width)
        names, types = schema.fieldNames(), None
        for batch in batches:
            types = types or batch.column("label").type
            if not batch.num_rows:
                continue
            vectors = whole_components(batch, "vector", parts * width)
            codes = np.zeros((len(vectors), parts), np.uint8)
            if not first:
                before = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8)
                before = before.reshape(-1, parts)
            for p in range(parts):
                part = vectors[:, p * width : (p + 1) * width]
                if first:
                    own, distance = nearest(part, balls.centre[p])
                    tally.add(p, part, own)
                else:
                    was = before[:, p].astype(np.int64)
                    own, distance = reassign(part, was, balls, p)
                    moved = np.flatnonzero(own != was)
                    tally.add(p, part[moved], was[moved], -1)
                    tally.add(p, part[moved], own[moved])
                tally.widen(p, own, distance)
                codes[:, p] = own
            nothing = pa.nulls(len(vectors), pa.binary())
            columns = [batch.column("vec_id"), batch.column("label"), _array(vectors),
                       pa.array([row.tobytes() for row in codes], pa.binary()), nothing]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        if types is not None:
            last = [pa.nulls(1, pa.int64()), pa.nulls(1, types), pa.nulls(1, pa.list_(pa.int32())),
                    pa.nulls(1, pa.binary()), pa.array([tally.total.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(last, names=names)

    return materialise(df.mapInArrow(run, schema))


def _tallied(state: DataFrame, shape: tuple[int, int, int]) -> np.ndarray:
    """The tallies of all tasks together: sums and numbers added up, the largest radius."""
    cells = shape[0] * shape[1]
    columns = [f"s{d}" for d in range(shape[2])]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((cells, shape[2]), np.int64)
        for batch in batches:
            for moved in batch.column("moved").to_pylist():
                each = np.frombuffer(moved, np.int64).reshape(cells, shape[2])
                total[:, :-1] += each[:, :-1]
                total[:, -1] = np.maximum(total[:, -1], each[:, -1])
        cell = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell), *[pa.array(total[cell, d]) for d in range(shape[2])]], names=["cell", *columns]
        )

    rows = (
        state.where(F.col("moved").isNotNull()).select("moved")
        .mapInArrow(spread, ", ".join(f"{c} bigint" for c in ["cell", *columns]))
        .groupBy("cell").agg(*[F.sum(c).alias(c) for c in columns[:-1]], F.max(columns[-1]).alias(columns[-1]))
        .collect()
    )
    total = np.zeros((cells, shape[2]), np.int64)
    for row in rows:
        total[row.cell] = row[1:]
    return total.reshape(shape)


def _moved_entries(centre: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries at the floored mean of their parts, unused ones where they were, and a bound
    of each ball's squared radius around its new centre: the old one and the step."""
    used = total[..., -2] > 0
    mean = total[..., :-2] // np.maximum(total[..., -2], 1)[..., None]
    new = np.where(used[..., None], mean, centre)
    step = np.sqrt(((new - centre) ** 2).sum(-1).astype(np.float64))
    bound = (np.sqrt(total[..., -1].astype(np.float64)) + step) * (1 + 1e-9) + 1
    return new, np.ceil(bound * bound).astype(np.int64)


@dataclass(frozen=True)
class Codes:
    """``rows`` (vec_id, label, code, error) and ``codebooks`` (part, entry, component)."""

    rows: DataFrame
    codebooks: np.ndarray


def compress(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> Codes:
    """Codes of all vectors, written to the shared folder, and the codebooks they refer to.

    ``code`` has two hex digits per part, ``error`` is the squared distance of the vector
    from its entries, over whole components (floored multiples of 1/256). Rows without a
    vector, or with a component that is null or not finite, are dropped. So are vectors that
    have not the length most vectors have (a multiple of ``parts``; of several, the
    longest). Components beyond 262,144 to either side count as that. Codebooks start with
    the least ids, null ids behind all others, and equal ids by their vectors. Null
    ids and labels, ids of any size and repeated rows come back, one row each; an empty
    table gives no row and empty codebooks; extra columns are left out.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte per part: from 1 to 256 entries")
    kept = usable(
        vectors.select(
            F.col(id_column).cast("bigint").alias("vec_id"),
            F.col(label_column).alias("label"),
            F.col(vector_column).alias("vector"),
        ),
        "vector",
    )
    element = kept.schema["vector"].dataType.elementType
    if not isinstance(element, (T.FloatType, T.DoubleType)):
        kept = kept.withColumn("vector", F.col("vector").cast("array<double>"))
    label = kept.schema["label"].dataType
    length = _length_of(kept, parts)
    kept = kept.where(F.size("vector") == length)
    if not length:
        empty = kept.limit(0).select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"))
        return Codes(empty, np.zeros((parts, 0, 0), np.int64))
    centre = _first_entries(kept, parts, entries, length)
    shape = (*centre.shape[:2], centre.shape[2] + 2)
    state, total = kept, np.zeros(shape, np.int64)
    radius = np.zeros(shape[:2], np.int64)
    for _ in range(rounds):
        balls = balls_of(centre, radius)
        state = _assigned(state, balls, label)
        change = _tallied(state, shape)
        total[..., :-1] += change[..., :-1]
        total[..., -1] = change[..., -1]
        centre, radius = _moved_entries(centre, total)
        state = state.where(F.col("moved").isNull()).drop("moved")
    return Codes(materialise(_coded(state, balls_of(centre, radius), label, rounds == 0)), centre)


def _coded(state: DataFrame, balls: Balls, label: T.DataType, first: bool) -> DataFrame:
    """The last assignment, with each row's error."""
    parts, _, width = balls.centre.shape
    schema = T.StructType([
        T.StructField("vec_id", T.LongType()), T.StructField("label", label),
        T.StructField("code", T.StringType()), T.StructField("error", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = whole_components(batch, "vector", parts * width)
            codes, error = np.zeros((len(vectors), parts), np.uint8), np.zeros(len(vectors), np.int64)
            if not first:
                before = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8)
                before = before.reshape(-1, parts)
            for p in range(parts):
                part = vectors[:, p * width : (p + 1) * width]
                if first:
                    own, distance = nearest(part, balls.centre[p])
                else:
                    own, distance = reassign(part, before[:, p].astype(np.int64), balls, p)
                codes[:, p] = own
                error += distance
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"),
                 pa.array([row.tobytes().hex() for row in codes], pa.string()), pa.array(error)],
                names=schema.fieldNames(),
            )

    return state.mapInArrow(run, schema)


def with_label_errors(rows: DataFrame) -> DataFrame:
    """``label_error``: the error of all rows of a label together, null labels among them.

    Errors are added up by label before the join; the sums are sent to all tasks if they
    are few, and joined by label otherwise.
    """
    sums = materialise(rows.groupBy("label").agg(F.sum("error").alias("label_error")))
    few = sums.count() <= SENT_LABELS
    sums = sums.withColumnRenamed("label", "_label")
    same = F.col("label").eqNullSafe(F.col("_label"))
    return rows.join(F.broadcast(sums) if few else sums, same).drop("_label")


def codebook_digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def vector_codes(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256``; see ``compress``."""
    codes = compress(vectors)
    return with_label_errors(codes.rows).select(
        "vec_id", "code", "error", "label_error",
        F.lit(codebook_digest(codes.codebooks)).alias("codebooks_sha256"),
    )
