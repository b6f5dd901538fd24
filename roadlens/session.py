"""Session settings, the shared scratch location, and who cleans it.

The library never changes settings of a session it is handed; only
:func:`build_session` (tests, bench) and the job's command line set them.
"""

from __future__ import annotations

import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans joins from runtime sizes
# (broadcast only what really is small), coalesces small shuffle partitions
# and splits skewed join partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "roadlens",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = {**SCALE_CONF, "spark.ui.enabled": "false"}
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach: the cluster's ``spark.checkpoint.dir``.

    A local session that names none uses a folder beside its warehouse.  On a
    cluster the warehouse may be each machine's own disk, so there it is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a local SparkContext (Spark Connect)
        sc = None
    current = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_roadlens_scratch"
    return current.rstrip("/")


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system Spark uses for it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


_OWNER: ContextVar[Scratch | None] = ContextVar("roadlens_scratch", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under :func:`shared_dir`; the :class:`Scratch` that is entered, if any, owns it."""
    path = f"{shared_dir(spark)}/roadlens-{name}-{uuid.uuid4().hex[:12]}"
    owner = _OWNER.get()
    if owner is not None:
        owner.paths.append(path)
    return path


class Scratch:
    """Owns the scratch folders that are named while it is entered, and deletes them when it is left, well or not.

    What is read lazily from those folders must be written before that: :meth:`hand_over` writes a result to a
    folder that belongs to the enclosing scope, or to nobody, and reads it back.

        with Scratch(spark) as own:
            result = own.hand_over(near_duplicates(docs), "result")
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []
        self._outer: list[Scratch | None] = []

    def __enter__(self) -> Scratch:
        self._outer.append(_OWNER.get())
        _OWNER.set(self)
        return self

    def __exit__(self, *exc: object) -> None:
        _OWNER.set(self._outer.pop())
        self.close()

    def close(self, but: int = 0) -> None:
        """Delete the folders, but for the last few."""
        while len(self.paths) > but:
            delete_path(self.spark, self.paths.pop(0))

    def release(self) -> None:
        """Give the folders to the enclosing scope, or to nobody."""
        if self._outer[-1] is not None:
            self._outer[-1].paths += self.paths
        self.paths = []

    def hand_over(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)  # ours until it is written
        df.write.parquet(path)
        self.paths.remove(path)
        if self._outer[-1] is not None:
            self._outer[-1].paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)
