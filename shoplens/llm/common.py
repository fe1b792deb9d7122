"""Shared pieces: tables cut off from their lineage, text normal forms, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplens.config import shuffles_dropped, stored_bytes

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: The characters that split words and are stripped from lines: space and U+0009 to U+000D.
BLANKS = r"[\x20\x09-\x0D]"
NOT_BLANKS = r"[^\x20\x09-\x0D]"


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share.

    Where the setting is missing, a local session (tests) gets a temporary folder and sets it;
    a cluster session is refused, since executors could not see a folder of the driver.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="llm-scratch-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the lineage ends there,
    lost executors do not bring the work back, the planner knows the table's size, and the
    shuffle files behind it go."""
    return materialize_in_turns([df])


def materialize_in_turns(parts: Iterable[DataFrame]) -> DataFrame:
    """As ``materialize``, for the rows of all ``parts``, one after the other: only one part's shuffle
    files are on the disks at a time."""
    path = None
    for df in parts:
        spark = df.sparkSession
        path = path or scratch_dir(spark)
        with shuffles_dropped(spark):
            df.write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Stored bytes for each turn of a step that is done in turns, and turns at most.
TURN_BYTES, TURNS = 128 << 20, 8


def turns(df: DataFrame) -> int:
    """In how many turns to shuffle ``df``, by the bytes it reads: one while they are few."""
    return max(1, min(TURNS, -(-stored_bytes(df) // TURN_BYTES)))


def drop_table(df: DataFrame) -> None:
    """Delete the files behind a materialized table that no later plan reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores appended where a column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def thin_parts(spark: SparkSession, groups: int) -> int:
    """Partitions for ``groups`` groups of costly work: hashed so thin that two seldom meet while
    there are few."""
    return max(1, min(4 * groups, max(shuffle_width(spark), 1000)))


def numbered(df: DataFrame, order: list, by: list[str] | None = None, name: str = "__n") -> DataFrame:
    """A written copy of ``df`` with ``name``: the row's place (from 0) in ``order``, within rows of equal
    ``by``. Rows are dealt by ranges of ``by`` and ``order`` and sorted there; only the ranges' counts
    are added up, so no group is in one task, however large, if ``order`` tells its rows apart."""
    by, cols = by or [], [f"`{c}`" for c in df.columns]
    keys = [F.col(c) for c in by] + list(order)
    rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = materialize(rows.withColumn("__part", F.spark_partition_id()).withColumn("__row", F.monotonically_increasing_id()))
    size = rows.groupBy(*by, "__part").agg(F.count("*").alias("__size"), F.min("__row").alias("__first"))
    before = F.sum("__size").over(Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    begin = materialize(size.select(*by, "__part", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__begin")))
    return rows.join(begin, [*by, "__part"]).select(*cols, (F.col("__row") + F.col("__begin")).alias(name))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, all else as it is. All-ASCII texts take the JVM's quick path."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def held_out(doc_id: Column, remainder: int) -> Column:
    """crc32 of the id as text, modulo 5, equals ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == remainder, F.lit(False))


def tokens(text: str | None) -> list[bytes]:
    """Words between blanks with A-Z lowered. ``bytes`` methods touch ASCII only, as wanted."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def batches(it: Iterator[pa.RecordBatch], cols: list[str], chars: int) -> Iterator[list[list]]:
    """Python columns in slices of about ``chars`` characters of the last column."""
    for batch in it:
        data = [batch.column(batch.schema.get_field_index(c)) for c in cols]
        sizes = pa.compute.fill_null(pa.compute.binary_length(data[-1]), 0).to_numpy(zero_copy_only=False)
        at = 0
        ends = np.cumsum(sizes, dtype=np.int64)
        while at < len(sizes):
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + chars, side="right")))
            yield [c.slice(at, to - at).to_pylist() for c in data]
            at = to


def pack_ints(values: np.ndarray) -> bytes:
    """Non-negative integers below 2^32, byte planes apart and compressed: small numbers cost little."""
    planes = np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return len(values).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(planes), codec="zstd", asbytes=True)


def unpack_ints(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 4 * n, codec="zstd", asbytes=True), np.uint8) if n else np.empty(0, np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").reshape(-1).astype(np.int64)


def pack_longs(values: np.ndarray) -> bytes:
    """As ``pack_ints``, for non-negative integers below 2^63."""
    planes = np.ascontiguousarray(values.astype("<i8")).view(np.uint8).reshape(-1, 8).T
    return len(values).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(planes), codec="zstd", asbytes=True)


def unpack_longs(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 8 * n, codec="zstd", asbytes=True), np.uint8) if n else np.empty(0, np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<i8").reshape(-1).astype(np.int64)


def mix64(x: np.ndarray) -> np.ndarray:
    """An invertible scrambling of unsigned 64-bit values (xor-shift and multiply, twice)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(src, dst) links to (node, component), component being the smallest node reached.

    Alternates two star steps: each node's larger neighbours are tied to its smallest neighbour,
    then each node and its smaller neighbours are. Links only ever get re-tied, so a hub costs a
    partial ``min`` and a join that Spark can split. Each round is a table in the shared folder;
    rounds grow with the logarithm of the longest chain. Loops and repeated links do no harm;
    rows with a null end are ignored.
    """
    links = materialize(
        edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        .filter("src is not null and dst is not null").filter("u <> v").distinct()
    )
    mark = _mark(links)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written out, so that the join stands alone in its stage and Spark can split a hub's links
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = materialize(large)
        drop_table(least)
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")))
        small = (
            large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
            .unionByName(least.withColumnRenamed("m", "v")).distinct()
        )
        new = materialize(small)
        new_mark = _mark(new)
        for old in (links, large, least):
            drop_table(old)
        links = new
        if new_mark == mark:
            break
        mark = new_mark
    else:
        raise RuntimeError("the component search did not settle")
    # settled links are stars: every node but the centre is tied to its component's smallest node
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _mark(links: DataFrame) -> tuple:
    with shuffles_dropped(links.sparkSession):
        return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(1)))).first())
