"""Written intermediate tables that outlive the executors which made them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodeworks.sources import storage

CHECKPOINT_DIR = "spark.checkpoint.dir"
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of input files that are worked off in one round, see ``staged_in_rounds``.
ROUND_BYTES = 1 << 30
#: Paths of tables staged within the innermost ``released``.
_paths: ContextVar[list[str] | None] = ContextVar("paths", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the session.

    A local session without the setting uses its warehouse. Elsewhere that may be a folder
    of the driver's machine, so that a missing setting is an error.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_DIR
    )
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors reach")
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staging").rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid4().hex}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes within delete their shuffle files when they are done.

    Otherwise these stay until the driver happens to collect its garbage, and a job of
    several writes holds the files of all of them. Only for writes, which are planned
    anew each time: a result that is collected twice would be computed again.
    """
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what was staged inside, also after a failure.

    What is to outlast it must be computed and written elsewhere before.
    """
    made: list[str] = []
    outer = _paths.set(made)
    try:
        yield
    finally:
        _paths.reset(outer)
        for path in made:
            storage.remove(spark, path)


def _staging_path(spark: SparkSession, label: str) -> str:
    path = fresh_path(spark, label)
    if (within := _paths.get()) is not None:
        within.append(path)
    return path


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write the rows as parquet and return a scan of them.

    The scan has no lineage beyond the files: losing executors later does not
    cause the work behind it to be repeated, and readers still get column
    pruning and filter pushdown.
    """
    path = _staging_path(df.sparkSession, label)
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def rounds_for(spark: SparkSession, files: Sequence[str], at_once: int = 1) -> int:
    """One round for every ``at_once`` times ``ROUND_BYTES`` of the files, at least one."""
    total = sum(storage.bytes_of(spark, path) for path in set(files))
    return max(1, -(-total // (at_once * ROUND_BYTES)))


def staged_in_rounds(
    df: DataFrame, label: str, keys: Sequence[str], rounds: int | None = None
) -> DataFrame:
    """Like ``staged``, but the rows of a part of the keys' hashes at a time.

    On disk are the shuffle files of one round besides what is written. Where the rows
    are grouped or joined by ``keys`` the choice reaches the scans below, which are read
    once a round; the steps between see each row once. Rows of equal keys are in one round.
    """
    spark = df.sparkSession
    if rounds is None:
        rounds = rounds_for(spark, df.inputFiles())
    if rounds == 1:
        return staged(df, label)
    path = _staging_path(spark, label)
    share = F.pmod(F.xxhash64(*keys), F.lit(rounds))
    for k in range(rounds):
        with freed_shuffles(spark):
            df.filter(share == k).write.mode("append").parquet(path)
    return spark.read.parquet(path)
