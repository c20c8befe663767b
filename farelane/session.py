"""Session settings the library relies on, and the shared folder for saved tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_APP_DIRS: dict[str, str] = {}


# Fixed value: the size in bytes up to which the JVM compiles a method.
COMPILED_METHOD_LIMIT = 8000


def prepare(spark: SparkSession) -> SparkSession:
    """Set what the results and the speed rely on, and return the session.

    The time zone is UTC, the one rule for weekday and hour everywhere. Whole-stage code
    beyond the JVM's limit would only be interpreted; rules over many columns can reach it,
    and run several times faster as the smaller methods Spark then generates instead.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    limit = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(limit, "65535")) > COMPILED_METHOD_LIMIT:
        spark.conf.set(limit, COMPILED_METHOD_LIMIT)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without the setting it is ``/tmp/farelane`` on the session's default file system, which has
    to be a shared one unless driver and executors share a machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    fs, path = hadoop_path(spark, "/tmp/farelane")
    own_machine = fs.getUri().getScheme() == "file"
    if own_machine and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return fs.makeQualified(path).toString()


def app_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder; it goes when the application ends."""
    app = spark.sparkContext.applicationId
    if app not in _APP_DIRS:
        path = f"{shared_dir(spark)}/farelane-{app}-{uuid.uuid4().hex}"
        fs, jpath = hadoop_path(spark, path)
        fs.mkdirs(jpath)
        fs.deleteOnExit(jpath)
        _APP_DIRS[app] = path
    return _APP_DIRS[app]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage at the shared folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(app_dir(spark))


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop file system and path object behind ``path``."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path for a table of this application."""
    return f"{app_dir(spark)}/{name}-{uuid.uuid4().hex}"


def save_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, safe from lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file with ``text``, there as a whole or not at all; one of that name is replaced."""
    fs, target = hadoop_path(spark, path)
    _, part = hadoop_path(spark, f"{path}.{uuid.uuid4().hex}.part")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(part, target):
        # Some file systems do not rename onto a file.
        fs.delete(target, False)
        if not fs.rename(part, target):
            raise OSError(f"could not write {path}")


def read_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    fs, target = hadoop_path(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
