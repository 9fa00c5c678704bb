"""Tables, intermediate results and connected components for the operators here."""

from __future__ import annotations

import os
import pathlib
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 2_000
#: A batch of rows on its way to Python is held several times there.
ARROW_BYTES, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


#: Python workers live on from stage to stage, and what they have freed counts as theirs until
#: it is given back: by default glibc keeps up to 64 MB of it, and Arrow's own pool some more.
WORKER_MEMORY = {
    "MALLOC_TRIM_THRESHOLD_": str(4 << 20),
    "MALLOC_MMAP_THRESHOLD_": str(4 << 20),
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}


def ship(spark: SparkSession) -> None:
    """Give the executors this package, unless PYTHONPATH or the working folder has it; hand
    rows to Python in small batches; let its workers give memory back, if the session's own
    settings (``spark.executorEnv``) say nothing about that."""
    spark.conf.set(ARROW_BYTES, BATCH_BYTES)
    for name, value in WORKER_MEMORY.items():
        spark.sparkContext.environment.setdefault(name, value)
    package = pathlib.Path(__file__).resolve().parents[1]
    root = str(package.parent)
    known = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    if root in known or any(f.endswith("/tidemark.zip") for f in spark.sparkContext.listFiles):
        return
    archive = f"{tempfile.mkdtemp(prefix='tidemark-')}/tidemark.zip"  # the driver hands it out
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared scratch folder and read from there.

    Cuts the lineage; the files outlive lost executors. Rows go to Python functions in
    small batches meanwhile, as a batch of whole texts is held several times.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(ARROW_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    """Null text counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def other_columns(docs: DataFrame) -> Column:
    """All columns but the text as one, ``doc``: no name of theirs can clash with others."""
    own = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    filler = "_" * (1 + max(len(c) for c in docs.columns))
    return F.struct(*own, F.lit(0).alias(filler)).alias("doc")


def document_columns(columns: list[str]) -> list[Column]:
    """The columns of documents again, from ``doc`` and ``text``."""
    return [F.col("text") if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in columns]


def components(edges: DataFrame, name: str) -> DataFrame:
    """(id, component) of all ids in ``edges`` (columns a, b); the smallest id names it.

    Edges are first reduced to stars within slices of each task. Then two steps alternate
    until all that is left are stars: each id hands the smallest id around it to its larger
    neighbours, then to its smaller ones and itself. Edges only ever move closer to the
    smallest id, so the number of rounds grows with the logarithm of the longest path, and
    an id with many neighbours costs one aggregated row per task and a join that can be
    split. Null ends and loops are left out.
    """
    edges = edges.where("a <> b").select(
        F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v")
    )
    edges = stored(edges.mapInArrow(_local_stars, "u bigint, v bigint").distinct(), f"{name}-edges")
    while not _are_stars(edges):
        edges = stored(_small_star(_large_star(edges)), f"{name}-edges")
    tops = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(tops)


def top_of(top: dict[int, int], i: int) -> int:
    """The smallest id that is known to be linked to ``i``; shortens the way to it."""
    while (up := top.setdefault(i, i)) != i:
        top[i] = top[up]
        i = up
    return i


def _local_stars(batches):
    """Each slice of edges as one star per component, the smallest id in the middle."""
    for batch in batches:
        top: dict[int, int] = {}
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            u, v = top_of(top, u), top_of(top, v)
            if u != v:
                top[max(u, v)] = min(u, v)
        rows = [(i, r) for i in list(top) if (r := top_of(top, i)) != i]
        yield pa.record_batch(
            [pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.int64())], ["u", "v"]
        )


def local_stars(batches, held: int = 1 << 16):
    """All pairs (a, b) of a task as one star per component: fewer rows than there are ids.
    So many pairs are held at once, and the stars."""
    slices, n = [], 0
    for batch in batches:
        slices.append(batch)
        n += batch.num_rows
        if n >= held:
            slices, n = _one_star(slices), 0
    yield from _one_star(slices)


def _one_star(slices: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    pairs = [pa.Table.from_batches(slices)] if slices else []
    return [x.rename_columns(["a", "b"]) for x in _local_stars(pairs)]


def _are_stars(edges: DataFrame) -> bool:
    """No id has two smaller neighbours, or neighbours on both sides."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    seen = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up > 1 OR up + down > 1").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Each id links its larger neighbours to the smallest id around it, itself included."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each id links its smaller neighbours and itself to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    return (
        joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(least.select("u", F.col("m").alias("v")))
        .where("u <> v")
        .distinct()
    )
