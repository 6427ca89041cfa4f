"""Session settings and staging tables shared by the jobs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings the jobs are written for. All but the master are runtime settings.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # Generated methods over this size are not compiled by the JVM; the extraction columns
    # then run faster as separately generated projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Temporary folders of local sessions without the setting, which cannot be set later.
_LOCAL_ROOTS: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the one the cluster names.

    Only a local session without the setting gets a temporary folder, since executors
    of a cluster could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="noticeflow-")
    return _LOCAL_ROOTS[app]


#: Bytes of an input file that a task reads. Compressed rows of numbers take a few bytes each, and the texts and
#: sorts made of them many times that, so Spark's 128 MB would be gigabytes of a task's memory.
TASK_BYTES = 4 << 20


def _file_bytes(df: DataFrame) -> int:
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in df.inputFiles()]
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)


def spread(df: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """A scan with at least one task per core and per ``task_bytes`` of its files. Text and page work is bound by
    the CPU, so an input of few splits is cut up first; inputs with more splits are left as they are."""
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-_file_bytes(df) // task_bytes))
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks)


_SCOPES: list[list[DataFrame]] = []


@contextmanager
def staged_scope() -> Iterator[None]:
    """Delete, at the end, the tables staged inside: for work whose result is written."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for df in _SCOPES.pop():
            unstage(df)


def unstage(df: DataFrame) -> None:
    """Delete the files of a table made by ``stage`` once nothing reads it any more."""
    spark = df.sparkSession
    root = spark._jvm.org.apache.hadoop.fs.Path(staging_root(spark))
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.getName().startswith("noticeflow-"):
            files.delete(path, True)


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to a fresh table under the shared folder and read it back.

    Used where a result feeds several later steps or its partition layout must not
    change: lineage ends here, a lost executor re-reads files, and later steps prune
    columns as on any parquet table. ``options`` go to the writer.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark).rstrip('/')}/noticeflow-{label}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").options(**options).parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    if _SCOPES:
        _SCOPES[-1].append(staged)
    return staged
