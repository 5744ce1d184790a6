"""Session settings the plans rely on, and the checkpoint folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings; all of them may be changed on a live session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A join key may hold a third of all rows: let AQE cut its partition.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Do so also where the rows are grouped by the join key afterwards, at the
    # price of one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Top-n per group is cut on the map side up to this n.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}


def cluster_settings(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a session on ``cores`` cores whose largest shuffle moves
    ``shuffle_bytes``.

    Shuffles start with pieces that fit in memory; AQE joins small ones again.
    """
    piece = 256 * 1024**2
    partitions = max(2 * cores, -(-shuffle_bytes // piece))
    return RUNTIME_SETTINGS | {
        "spark.sql.files.maxPartitionBytes": str(piece),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(piece // 2),
    }


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables that every executor can reach.

    It is the one named by ``spark.checkpoint.dir``; where that is unset, a
    folder in the warehouse, which is shared as well.
    """
    context = spark.sparkContext
    shared = (
        context.getCheckpointDir()
        or spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir", None)
    )
    return shared or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The rows are computed once, survive the loss of executors, and later steps
    read only the columns they need. The folder is left to its owner to clear.
    """
    return materialise_pieces([df])


def materialise_pieces(pieces: Iterable[DataFrame]) -> DataFrame:
    """Write DataFrames of one schema, at least one, into one table as ``materialise`` does, one after the other."""
    table = path = None
    for piece in pieces:
        path = path or f"{shared_dir(piece.sparkSession)}/{uuid.uuid4().hex}"
        piece.write.mode("append").parquet(path)
        table = piece.sparkSession.read.schema(piece.schema).parquet(path)
    if (own := _OWN.get()) is not None:
        own.append((table, path))
    return table


#: The tables written inside the innermost ``alone``, with their paths.
_OWN: ContextVar[list[tuple[DataFrame, str]] | None] = ContextVar("_OWN", default=None)


def _delete(spark: SparkSession, path: str) -> None:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def alone(build: Callable[[], DataFrame]) -> DataFrame:
    """The written table that ``build`` returns; other tables that are written on the way to it
    are deleted behind it."""
    outer, own = _OWN.get(), []
    token = _OWN.set(own)
    try:
        result = build()
    finally:
        _OWN.reset(token)
    for table, path in own:
        if table is not result:
            _delete(table.sparkSession, path)
        elif outer is not None:
            outer.append((table, path))
    return result


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more before their ``alone`` ends; outside one they stay."""
    own = _OWN.get() or []
    for i in reversed(range(len(own))):
        if any(own[i][0] is table for table in tables):
            table, path = own.pop(i)
            _delete(table.sparkSession, path)


#: Shuffle files are freed when the action that wrote them ends, not when the driver collects garbage;
#: a join whose smaller side fits in memory piece by piece sorts, and spills, neither side; tables written are packed more.
SPARING_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(64 * 1024**2),
    "spark.sql.parquet.compression.codec": "zstd",
}


@contextmanager
def sparing(spark: SparkSession) -> Iterator[None]:
    """Settings for actions that would otherwise fill the disks; those before hold again behind it."""
    before = {key: spark.conf.get(key, None) for key in SPARING_SETTINGS}
    for key, value in SPARING_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


_WRITTEN: dict[tuple, DataFrame] = {}


def _versions(spark: SparkSession, paths: list[str]) -> tuple:
    """Files of each path with their length and time of change, so that a rewritten table is told
    from the one before."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for path in paths:
        root = jvm.org.apache.hadoop.fs.Path(path)
        fs = root.getFileSystem(conf)
        for status in fs.listStatus(root):
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(found))


def written_once(
    spark: SparkSession, name: str, paths: list[str], build: Callable[[], DataFrame], as_table: bool = False
) -> DataFrame:
    """The written table that ``build`` returns, shared by all who ask for ``name`` over the same files.

    ``as_table`` says that it is a named table, whose layout is to be kept.

    It is built again if a file under ``paths`` changed or if its own files are gone.
    """
    key = (spark.sparkContext.applicationId, name, _versions(spark, paths))
    known = _WRITTEN.get(key)
    if known is not None:
        root = spark._jvm.org.apache.hadoop.fs.Path(known.inputFiles()[0] if known.inputFiles() else "/")
        if root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root):
            if as_table:
                return known
            return known.sparkSession.read.schema(known.schema).parquet(root.getParent().toString())
    _WRITTEN[key] = build()
    return _WRITTEN[key]
