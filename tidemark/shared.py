"""Tables in the folder that driver and executors share: lineage is cut by writing, never by local checkpoints."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Paths that are to be deleted, each with its session, oldest first.
_scratch: dict[str, SparkSession] = {}

#: Removes a query's shuffle files as soon as its result is written; a retried stage makes them anew.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder from spark.checkpoint.dir; a local master without one gets a temporary folder."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at
    have = spark.sparkContext._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder; it is removed by discard(), at the end of its scope(), or when the driver's process ends."""
    if not _scratch:
        atexit.register(clean_up)
    path = f"{shared_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    _scratch[path] = spark
    return path


def _delete(paths: list[str]) -> None:
    for path in paths:
        spark = _scratch.pop(path)
        try:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # noqa: BLE001  the session has ended already
            return


def clean_up() -> None:
    """Remove every scratch table of this process; results that still read them must be written before."""
    _delete(list(_scratch))


def _read_by(df: DataFrame) -> list[str]:
    """The scratch tables that df reads."""
    leaves, roots = df._jdf.queryExecution().analyzed().collectLeaves(), []
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        if leaf.getClass().getSimpleName() == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            roots.append(leaf.relation().location().rootPaths().mkString(" "))
    return [p for p in _scratch if any(os.path.basename(p) in r for r in roots)]


def discard(*tables: DataFrame) -> None:
    """Delete scratch tables that nothing reads any more: what was made from them has been written."""
    _delete([p for t in tables for p in _read_by(t)])


def scratch_paths() -> set[str]:
    return set(_scratch)


def free(paths: set[str], *but: DataFrame) -> None:
    """Delete these scratch paths, except what `but` reads. For a caller that has written what it took from all others."""
    stay = {p for t in but for p in _read_by(t)}
    _delete([p for p in _scratch if p in paths and p not in stay])


@contextmanager
def scope() -> Iterator[None]:
    """Delete the scratch tables made inside when it ends: results must have been written or collected by then."""
    before = set(_scratch)
    try:
        yield
    finally:
        _delete([p for p in _scratch if p not in before])


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it again: cuts the lineage, survives lost executors, is read as often as needed.
    Its shuffle files go with the write's end."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    was = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEAN, was)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once a context."""
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark.zip")  # the driver's copy; Spark sends it on
    with zipfile.ZipFile(path, "w") as z:
        for d, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(d, name), os.path.relpath(os.path.join(d, name), os.path.dirname(top)))
    sc.addPyFile(path)
    sc._tidemark_shipped = True
