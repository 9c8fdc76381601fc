"""What the corpus operators share: scratch tables in the cluster's shared folder, Arrow maps, connected components."""

from __future__ import annotations

import contextlib
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}
#: Folders of open scratch() blocks, by application.
_SCRATCH: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir. In local mode, where it may be unset, a local one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    key = spark.sparkContext.applicationId
    if key not in _OWN:
        _OWN[key] = "file://" + tempfile.mkdtemp(prefix="versica-")
    return _OWN[key]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody has; inside a scratch() block it goes with it."""
    held = _SCRATCH.get(spark.sparkContext.applicationId)
    return f"{held[-1] if held else shared_dir(spark) + '/versica'}/{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write df as a table in the shared folder and return a frame that reads it: lineage is cut, and no executor is needed to read it again."""
    path = path or new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merged(df: DataFrame) -> DataFrame:
    """df, joined by sorting: Spark goes by the size of compressed files, and would send tables of many short rows, several times as large unpacked, through the driver."""
    return df.hint("merge")


def give_back(spark: SparkSession) -> None:
    """Executors collect their garbage, and give the heap that this frees back to their machines. Else what earlier jobs have left stays
    with them beside the memory of Python workers, Arrow and the network. A few tasks for each core, so that every executor gets some.
    The driver does the same."""
    n = 4 * spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.expr("java_method('java.lang.System', 'gc')").alias("gone")).write.format("noop").mode("overwrite").save()
    driver_gives_back(spark)


def driver_gives_back(spark: SparkSession) -> str:
    """The driver collects its garbage and gives the freed heap back, and also what its allocator holds beyond the heap: plans are compiled
    in threads by the dozen, whose freed memory malloc keeps, some 300 MB after a few hundred of them. What the JVM says of that; '' where it can't."""
    gc.collect()  # frames that only each other refer to hold their plans
    jvm = spark._jvm
    jvm.java.lang.System.gc()
    server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    args = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)  # the server's class is not open to py4j, its interface is
    args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    call = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
    try:
        return str(call.invoke(server, args)).strip()
    except Py4JJavaError:  # a JVM without this command: its heap is all that can be given back
        return ""


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is stored inside this block is deleted when it ends; what is to outlive it needs a path of its own, made before."""
    held = _SCRATCH.setdefault(spark.sparkContext.applicationId, [])
    held.append(f"{shared_dir(spark)}/versica/scratch-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        delete(spark, held.pop())


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def same_columns(df: DataFrame) -> list:
    """df's columns, whatever their names hold."""
    return [F.col(quoted(c)) for c in df.columns]


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with so many underscores before it that df has no such column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), null texts as empty ones: extra columns, whatever their names, never reach an operator."""
    return docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("text"))


#: Rows and bytes that a worker takes up at a time, or one row. Spark itself sends no batch over spark.sql.execution.arrow.maxBytesPerBatch (64 MB) or one row.
ROWS, BYTES = 1000, 4 << 20


def sliced(batches: Iterator[pa.RecordBatch], rows: int = ROWS, size: int = BYTES) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that a worker holds few texts as Python objects at a time."""
    for b in batches:
        step = max(1, min(rows, size * b.num_rows // max(1, b.nbytes)))
        for k in range(0, b.num_rows, step):
            yield b.slice(k, step)


def in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema, rows: int = ROWS) -> DataFrame:
    """mapInArrow with sliced batches; Arrow's pool gives memory back between them. The session's settings stay as they are."""

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = pa.default_memory_pool()
        for out in run(sliced(batches, rows)):
            yield out
            pool.release_unused()

    return df.mapInArrow(lean, schema)


def arrow_map(df: DataFrame, rows: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """mapInArrow with a function of one batch; empty results are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows and (out := rows(b)) is not None and out.num_rows:
                yield out

    return in_arrow(df, run, schema)


def binary(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


#: Nodes of a graph beyond which its labels are joined by sorting; fewer may be broadcast.
FEW_NODES = 100_000


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of edges(a long, b long): (node, label), label the smallest node reachable.

    Each round every node takes the smallest label of its neighbours, then the label of its label (pointer jumping), so
    chains shrink geometrically. Every round is a table in the shared folder; nothing is collected but a count of changes.
    """
    edges = edges.where("a <> b")
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    sent = (lambda df: df) if labels.count() <= FEW_NODES else merged
    for k in range(rounds):
        near = both.join(sent(labels), both.b == labels.node).groupBy(F.col("a").alias("at")).agg(F.min("label").alias("near"))
        step = labels.join(sent(near), F.col("node") == F.col("at")).select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("up"), F.col("label").alias("over"))
        step = stored(step.join(sent(up), F.col("label") == F.col("up")).select("node", "was", F.least("label", "over").alias("label")), f"labels{k}")
        done = step.where("was <> label").limit(1).count() == 0
        labels = step.select("node", "label")
        if done:
            return labels
    raise RuntimeError(f"components did not settle in {rounds} rounds")
