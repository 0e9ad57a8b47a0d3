"""Table I/O on paths (A8-A11, A14): append, read, stream, existence, views.

Tables are Parquet folders; when the ``delta`` package is importable the same
calls can be pointed at ``format="delta"``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on its file system (any Hadoop scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_small_text(spark: SparkSession, path: str) -> str | None:
    """Read a small metadata file (a schema) on any Hadoop file system;
    None when absent."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        jvm = spark.sparkContext._jvm
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small metadata file: to a temporary name, then renamed over the
    target in one step, so a reader sees the old or the new file, never none."""
    p, fs = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.tmp-{jvm.java.util.UUID.randomUUID().toString()}")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    option = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    options[0] = option
    context.rename(tmp, p, options)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this package wrote (staging copies); absent is fine."""
    p, fs = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Paths of a folder's folders, sorted; none where it is absent."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(f"{path.rstrip('/')}/{st.getPath().getName()}" for st in fs.listStatus(p) if st.isDirectory())


def move_path(spark: SparkSession, old: str, new: str) -> None:
    """Rename a folder this package wrote; one that lies at the new place is replaced."""
    p, fs = _fs(spark, old)
    q, _ = _fs(spark, new)
    fs.mkdirs(q.getParent())
    fs.delete(q, True)
    if not fs.rename(p, q):
        raise OSError(f"could not rename {old} to {new}")


def move_files(spark: SparkSession, old: str, new: str) -> None:
    """Rename a folder's data files into another folder (one call a file, within a file
    system); files that are there no more were moved before."""
    p, fs = _fs(spark, old)
    q, _ = _fs(spark, new)
    if not fs.exists(p):
        return
    fs.mkdirs(q)
    jvm = spark.sparkContext._jvm
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isFile() and not name.startswith(("_", ".")) and not fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(q, name)):
            raise OSError(f"could not rename {old}/{name} to {new}")


def table_exists(spark: SparkSession, path: str) -> bool:
    """A committed table: the folder exists and holds data or a commit marker."""
    if not path_exists(spark, path):
        return False
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name == "_SUCCESS" or "=" in name or not name.startswith(("_", ".")):
            return True
    return False


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                 fmt: str = "parquet") -> None:
    """Append; the first append creates the table."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: StructType | None = None, merge_schema: bool = False) -> DataFrame:
    """Batch read of a table folder (partition columns discovered).

    Pass ``schema`` when it is known: no file footer is read to infer it.
    ``merge_schema`` reads every footer (for folders whose files differ)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "parquet" and merge_schema:
        r = r.option("mergeSchema", "true")
    return r.load(path)


def table_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A table folder as a stream source (new files become micro-batches)."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a frame to SQL."""
    df.createOrReplaceTempView(name)
    return df
