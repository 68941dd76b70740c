"""Small helpers of the operators: reading, staging in the shared folder, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bedwatch.session import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str | Column = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def per_text(docs: DataFrame, make: Callable[[], Callable], fields: list[tuple[str, str, pa.DataType]],
             id_col: str = "doc_id", text_col: str = "text", rows: int = 256) -> DataFrame:
    """(doc_id, fields): ``make()`` is called once per task and gives f(ids, texts) -> one list per field.

    Texts are whole, null ones empty; f sees ``rows`` of them at a time, so that what it derives from long texts
    does not pile up. Ids pass through unchanged, null ones too. Fields are (name, Spark type, Arrow type).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                some = batch.slice(at, rows)
                ids = some.column(0)
                columns = work(ids.to_pylist(), some.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [ids, *[pa.array(c, kind) for c, (_, _, kind) in zip(columns, fields)]],
                    names=["doc_id", *[f[0] for f in fields]])

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return read.mapInArrow(run, ", ".join(["doc_id long", *[f"{name} {kind}" for name, kind, _ in fields]]))


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage is cut, lost executors cost nothing."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a staged table that nothing will read again."""
    spark = df.sparkSession
    jvm = spark._jvm
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components: (node, component), component being the smallest node reachable.

    ``edges`` has long columns a and b; nodes without an edge do not occur in the result. Large-star and
    small-star steps alternate until the edges stop changing: each step sends every node to the smallest
    neighbour, so the number of rounds grows with the logarithm of the longest chain. A node with very many
    edges is never gathered: the minimum is a partial aggregate, and the join is one that Spark splits.
    Self loops, repeated and reversed edges are allowed.
    """
    current = stage(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _fingerprint(current)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        # large star: every larger neighbour of u is tied to the smallest node around u
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        # small star: every smaller neighbour of u, and u itself, is tied to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        following = stage(small.unionByName(low.withColumnRenamed("m", "b")).filter("a <> b").distinct(), "edges")
        discard(current)
        before, current, state = state, following, _fingerprint(following)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
