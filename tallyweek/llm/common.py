"""What the operators share: intermediate tables, row keys, words and components."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words of the license and benchmark operators, on lower-cased text.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A table of at most this many rows may be broadcast; larger ones are shuffled.
BROADCAST_ROWS = 200_000
SPACE = re.compile(rb"[\x20\x09-\x0d]")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`, where unset one in the warehouse."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, of known size, safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a written table that nothing reads any more; what was made of it must be written itself."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.scratch)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of each finished write, not only when the driver collects garbage."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for a broadcast if it has at most `limit` rows; `df` is a written table, so that counting is cheap."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def content_key(*columns: Column | str) -> Column:
    """64 bits of a row's content: the same in every evaluation, in whatever order and partitioning rows come."""
    return F.xxhash64(*columns)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is; null as empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a lower-cased text: runs of digits, a-z and characters beyond ASCII."""
    return F.array_remove(F.split(text, NOT_WORD), "")


def word_grams(tokens: Column, width: int) -> Column:
    """Every run of `width` words as a struct w0, w1, ...; empty when there are fewer words."""
    n = F.size(tokens) - width + 1
    parts = [F.slice(tokens, i + 1, F.greatest(n, F.lit(0))).alias(f"w{i}") for i in range(width)]
    return F.arrays_zip(*parts)


def blocks(data: bytes, size: int = 1 << 22) -> Iterator[bytes]:
    """A text in pieces of about `size` bytes that end where white space does, so that memory stays bounded."""
    start = 0
    while start < len(data):
        stop = len(data)
        if start + size < stop and (found := SPACE.search(data, start + size)):
            stop = found.end()
        yield data[start:stop]
        start = stop


def slices(batch, text_at: int, size: int) -> Iterator:
    """A record batch in parts of about `size` bytes of text; a longer text is a part of its own."""
    lengths = [0 if x is None else x for x in pc.binary_length(batch.column(text_at)).to_pylist()]
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > size:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield batch.slice(start)


_HELD: dict = {}


def held(key, make):
    """The one large object a Python worker keeps between tasks; workers live on, so another key frees the one before."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def components(edges: DataFrame) -> DataFrame:
    """Connected components: (node, root) for every node of the edges (a, b), root being its smallest node.

    Large-star and small-star steps alternate until the edges stay as they are;
    each is a grouping and a join, whose hot keys adaptive execution splits. All
    steps are written out, so a lost executor costs one step.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges")
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            break
        state = now
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        edges = written(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        least = written(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
        near = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(near.union(least.toDF("a", "b")).distinct(), "small")
    return edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root").union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
