"""Spark session helpers.

The session is configured for the cluster case first: AQE on (coalesces
small shuffles, splits skewed join partitions), UTC session time zone
(the reference works on naive local datetimes), Arrow for the few pandas
paths.  Nothing here forces a broadcast: ``autoBroadcastJoinThreshold`` is
the size check that decides it for tables whose size grows with the data.
"""

from __future__ import annotations

import os
import re
import tempfile
import time
import uuid
import zipfile
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "tillpoint",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; tests
    pass ``local[*]`` and a small ``shuffle_partitions``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder used to cut lineage and to hold scratch tables.

    Read from ``spark.checkpoint.dir``, which a cluster sets to a file system
    that the driver and all executors share.  Where it is unset a local
    master gets a fresh scratch folder; any other master is refused, because
    each executor would write to a disk that the others cannot read.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share "
                               f"(master {master!r} has no shared default)")
        d = tempfile.mkdtemp(prefix="tillpoint-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:  # connect sessions have no SparkContext
        pass
    return d


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers (once per application), so that
    functions pickled by reference can be imported there whatever the workers'
    working directory is."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="tillpoint-zip-"), "tillpoint.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(out)
    _shipped.add(sc.applicationId)


def materialize(df, name: str, compression: str = "snappy"):
    """Write ``df`` once as parquet under the shared checkpoint folder and
    read it back: cuts the lineage and lets several branches of a plan use
    the result without recomputing it (a lost executor re-reads the files
    instead of recomputing the whole chain)."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)   # known schema: no footer scan
    if _open.get():
        _open.get()[-1].tables.append((table, path))
    return table


def release_shuffles(spark: SparkSession) -> None:
    """Have the files of finished shuffles removed.  Spark keeps them until the
    driver's garbage collection meets the plans that made them, which a driver
    with room to spare does not reach within a query: the disk would hold the
    shuffles of all its steps at once.  So the collection is asked for where a
    step with large shuffles has ended; what a first one lets go of still holds
    the shuffles, and a second one, a moment later, meets these."""
    try:
        system = spark.sparkContext._jvm.System
    except Exception:  # connect sessions have no SparkContext
        return
    system.gc()
    time.sleep(0.2)
    system.gc()


def settle(df, name: str):
    """``materialize`` for a table behind large shuffles: they are released, and
    the table itself takes little of the disk too."""
    table = materialize(df, name, compression="zstd")
    release_shuffles(df.sparkSession)
    return table


def by_shuffle(df):
    """``df`` as a side of a join that is never broadcast.  A static plan takes
    the size of a table from its compressed files and ignores what an explode
    adds, so names, signatures and sale ids that grow with the data would be
    gathered on the driver long after their rows have outgrown it."""
    return df.hint("merge")


class Scratch:
    """Tables written by ``materialize`` while a ``scratch()`` block is open."""

    def __init__(self):
        self.tables: list = []
        self.kept: list = []

    def keep(self, table):
        """Leave ``table`` for whoever uses the block's result."""
        self.kept += [t for t in self.tables if t[0] is table]
        return table


#: the open blocks of this thread (a stream's batches and other queries have their own)
_open: ContextVar[tuple[Scratch, ...]] = ContextVar("open_scratch_blocks", default=())


@contextmanager
def scratch():
    """Empty, at the end of the block, the tables that were written in it and
    not kept; kept ones belong to the enclosing block, if any.  For results
    that no longer read the others, i.e. are materialised themselves."""
    block = Scratch()
    outer = _open.get()
    _open.set((*outer, block))
    try:
        yield block
    finally:
        _open.set(outer)
    kept = {path for _, path in block.kept}
    for table, path in block.tables:
        if path not in kept:
            table.sparkSession.createDataFrame([], table.schema).write.mode("overwrite").parquet(path)
    if outer:
        outer[-1].tables += block.kept


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 << 20,
                           minimum: int = 200) -> int:
    """Initial shuffle partition count for a job reading ``input_bytes``:
    about one partition per ``target_bytes`` of input (so a partition's
    shuffle data fits an executor core's memory share without spilling
    much), never fewer than ``minimum``.  AQE then coalesces small
    partitions and splits skewed ones at run time.  100 TB -> ~400k."""
    return max(minimum, -(-int(input_bytes) // target_bytes))


def configure_for_input(spark: SparkSession, input_bytes: int) -> None:
    """Set the shuffle sizing for a run over ``input_bytes`` of input."""
    n = shuffle_partitions_for(input_bytes)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(128 << 20))
