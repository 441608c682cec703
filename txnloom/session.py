"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

SCRATCH_KEY = "spark.checkpoint.dir"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # De-duplication state grows with the number of ids, so it must not live on the
    # JVM heap; changelog checkpoints upload only what a micro-batch changed.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app_name: str = "txnloom", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with this package's defaults, where neither ``conf`` nor submission set them."""
    conf = conf or {}
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    submitted = spark.sparkContext.getConf()
    for key, value in DEFAULTS.items():
        if key not in conf and not submitted.contains(key):
            spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder under the cluster's shared scratch location.

    The location is ``spark.checkpoint.dir``. Only a local master may fall back
    to a temporary folder, because there driver and tasks share one disk.
    """
    base = spark.conf.get(SCRATCH_KEY, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{SCRATCH_KEY} must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="txnloom-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _located(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def _is_local(file_system) -> bool:
    return file_system.getUri().getScheme() == "file"


def on_local_disk(spark: SparkSession, path: str) -> bool:
    return _is_local(_located(spark, path)[0])


def has_class(spark: SparkSession, name: str) -> bool:
    loader = spark._jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader()
    return loader.getResource(name.replace(".", "/") + ".class") is not None


def is_directory(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder on whichever file system it names."""
    file_system, jvm_path = _located(spark, path)
    return bool(file_system.getFileStatus(jvm_path).isDirectory())


def input_files(spark: SparkSession, path: str) -> list[str]:
    """All visible files of a file, folder or glob, in order of path."""
    file_system, jvm_path = _located(spark, path)
    starts = [start.getPath() for start in file_system.globStatus(jvm_path) or ()]
    listed = _walked if _is_local(file_system) else _listed
    files = (file for start in starts for file in listed(file_system, start))
    return sorted(file.toString() for file in files if not file.getName().startswith(("_", ".")))


def _listed(file_system, start):
    files = file_system.listFiles(start, True)
    while files.hasNext():
        yield files.next().getPath()


def _walked(file_system, start):
    """As ``_listed``, which on a local disk starts a process for the owner of each file."""
    folders = [start]
    while folders:
        for entry in file_system.listStatus(folders.pop()):
            if entry.isDirectory():
                folders.append(entry.getPath())
            else:
                yield entry.getPath()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, in order."""
    file_system, jvm_path = _located(spark, path)
    return sorted(entry.getPath().getName() for entry in file_system.listStatus(jvm_path))


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place at once: readers see the old one or the new one."""
    jvm = spark._jvm
    hadoop = spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    # a hidden name, which readers of the folder pass over
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    file_system = target.getFileSystem(hadoop)
    out = file_system.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), hadoop)
    renames = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    renames[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(
        file_system.makeQualified(draft), file_system.makeQualified(target), renames
    )


def read_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None if it is not there."""
    file_system, jvm_path = _located(spark, path)
    if not file_system.exists(jvm_path):
        return None
    stream = file_system.open(jvm_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove_file(spark: SparkSession, path: str) -> None:
    file_system, jvm_path = _located(spark, path)
    file_system.delete(jvm_path, False)


def remove_folder(spark: SparkSession, path: str) -> None:
    file_system, jvm_path = _located(spark, path)
    file_system.delete(jvm_path, True)


def make_folder(spark: SparkSession, path: str) -> None:
    file_system, jvm_path = _located(spark, path)
    file_system.mkdirs(jvm_path)


def path_exists(spark: SparkSession, path: str) -> bool:
    file_system, jvm_path = _located(spark, path)
    return bool(file_system.exists(jvm_path))


def size_shuffle(
    spark: SparkSession,
    *paths: str,
    partition_bytes: int = 256 * 1024 * 1024,
    growth: float = 3.0,
    most: int = 50_000,
) -> int:
    """Set the shuffle partition count from the size of a batch job's input.

    De-duplication sends every row through one shuffle, whose tasks adaptive
    execution can merge but not split, so the count has to come from the data:
    input bytes, times ``growth`` for decoding compressed files into rows, over
    the bytes one task should sort. It never goes below the session's setting,
    nor above ``most``: past that the number of shuffle blocks costs more than
    larger tasks, which sort on disk.
    """
    total = 0
    for path in paths:
        file_system, jvm_path = _located(spark, path)
        for found in file_system.globStatus(jvm_path) or ():
            total += file_system.getContentSummary(found.getPath()).getLength()
    wanted = min(math.ceil(total * growth / partition_bytes), most)
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)
    spark.conf.set("spark.sql.shuffle.partitions", str(count))
    return count


def size_scan(spark: SparkSession, path: str, rows: int = 1_000_000, least: int = 1024 * 1024) -> int:
    """Set the bytes of a scan task so that it holds about ``rows`` rows of the Parquet ``path``.

    Repeats are pruned by sorting what a scan task decoded, and columnar files decode into
    many times their bytes, so tasks cut by bytes alone sort on disk. The rows are counted
    in the footers. A row group is never cut. It never goes above the submitted setting.
    """
    submitted = spark.sparkContext.getConf().get("spark.sql.files.maxPartitionBytes", "128m")
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(submitted)
    file_system, jvm_path = _located(spark, path)
    total = file_system.getContentSummary(jvm_path).getLength()
    held = max(spark.read.parquet(path).count(), 1)
    size = min(most, max(least, math.ceil(total * rows / held)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    return size
