"""Helpers the training-data operators share: inputs, scratch tables, bit filters and graph labels."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITESPACE = " \t\n\x0b\f\r"
_LOCAL_SCRATCH: list[str] = []


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Documents in an Arrow batch, where the session has Spark's own default: 10,000 long texts are more than a worker should hold.
BATCH_DOCS = 1000


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package where it is not installed, and keeps batches of documents small."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_DOCS)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env, old = spark.sparkContext.environment, spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in old.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, old) if x)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the session. Where it names none, a folder of our own, but only if all tasks run on this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _LOCAL_SCRATCH:
            _LOCAL_SCRATCH.append("file://" + tempfile.mkdtemp(prefix="tilelake-"))
        base = _LOCAL_SCRATCH[0]
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop(spark, path)
    fs.delete(p, True)


def write_table(df: DataFrame, path: str, **options: str) -> DataFrame:
    """Writes a table and reads it back, so that its lineage ends at the files."""
    df.write.options(compression="zstd", **options).mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of finished jobs now, not when the driver next happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_SCOPES: list[list[str]] = []


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the tables that materialize() wrote inside, but for those that outlive it."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            delete_path(spark, path)
        release(spark)


def materialize(df: DataFrame, name: str, outlive: bool = False) -> DataFrame:
    """df, written to the shared folder and read back. outlive: for the scope around the present one to delete, if there is one."""
    path = scratch_path(df.sparkSession, name)
    at = len(_SCOPES) - (2 if outlive else 1)
    if at >= 0:
        _SCOPES[at].append(path)
    return write_table(df, path)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """For iterators that Python workers run: gives the memory they freed back to the system, as workers are kept."""

    @functools.wraps(run)
    def wrapped(frames: Iterator) -> Iterator:
        try:
            yield from run(frames)
        finally:
            give_back()

    return wrapped


def give_back() -> None:
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def join_counted(left: DataFrame, right: DataFrame, key: str, rows: int, share: int = 1000) -> DataFrame:
    """left joined to right(key, copies, ...), which has each key once with the number of left's rows that hold it.

    Keys with more than 1/share of the rows number at most share, so they are broadcast and never fill one task; the others are shuffled.
    Rows of left without a partner get nulls. copies is dropped.
    """
    hot = F.col("copies") * share > rows
    (flag,) = fresh(left, "hot_flag")
    marked = left.join(F.broadcast(right.where(hot).select(F.col(key), F.lit(True).alias(flag))), key, "left")
    columns = [c for c in right.columns if c not in (key, "copies")]
    some = marked.where(F.col(flag)).drop(flag).join(F.broadcast(right.where(hot).select(key, *columns)), key)
    rest = marked.where(F.col(flag).isNull()).drop(flag).join(right.where(~hot).select(key, *columns), key, "left")
    return some.unionByName(rest)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that df does not have, whatever case is ignored."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def hash_sample(df: DataFrame, keys: list[str], most: int) -> DataFrame:
    """At most `most` rows, the first in the order of a hash of keys; about all of them if df has no more.

    A threshold on the hash first leaves about twice the rows wanted, so tasks send few rows whatever their number.
    """
    total = df.count()
    h = F.xxhash64(*keys)
    if total > 2 * most:
        df = df.where(F.pmod(h, F.lit(1 << 40)) < int((1 << 40) * 2 * most / total))
    return df.orderBy(h, *keys).limit(most)


# --- bit filters -----------------------------------------------------------------------------------------------------
# A set of keys as rows (bucket, bits) of 4 KB, at most 2**max_log2 bits in all: small enough to broadcast whatever the
# number of keys. A miss is certain, a hit has to be checked.

BUCKET_BITS = 32768


def _position(key: Column, log2: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << log2))


def filter_log2(n_keys: int, max_log2: int = 26) -> int:
    return min(max_log2, max(15, (16 * max(1, n_keys)).bit_length()))


def bit_filter(keys: DataFrame, key: str, log2: int, *by: str) -> DataFrame:
    """(bf_bucket, bf_bits), one filter for each value of the columns `by`."""
    at = _position(F.col(key), log2) + 1
    return keys.where(F.col(key).isNotNull()).groupBy(*by, F.bitmap_bucket_number(at).alias("bf_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bf_bits"))


def maybe_in(df: DataFrame, key: Column, filt: DataFrame, log2: int, flag: str) -> DataFrame:
    """df with a boolean column flag: false only for keys that are not in the filter (null keys are not)."""
    at, bucket, bits = fresh(df, "bf_at", "bf_bucket", "bf_bits")
    small = F.broadcast(filt.select(F.col("bf_bucket").alias(bucket), F.col("bf_bits").alias(bits)))
    df = df.withColumn(at, F.when(key.isNotNull(), _position(key, log2)))
    df = df.withColumn(f"{bucket}l", F.bitmap_bucket_number(F.col(at) + 1))
    df = df.join(small, F.col(f"{bucket}l") == F.col(bucket), "left")
    pos = F.col(at) % BUCKET_BITS
    byte = F.conv(F.hex(F.substring(F.col(bits), (pos / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.shiftright(byte, 0).bitwiseAND(F.expr(f"shiftleft(1, cast(`{at}` % 8 as int))")) != 0, F.lit(False))
    return df.withColumn(flag, hit).drop(at, bucket, f"{bucket}l", bits)


def prune(docs: DataFrame, dropped: DataFrame, n_dropped: int) -> DataFrame:
    """docs without the rows whose doc_id is in dropped(doc_id). Rows that a bit filter clears are not shuffled. Rows without doc_id stay."""
    log2 = filter_log2(n_dropped)
    (flag,) = fresh(docs, "bf_flag")
    marked = maybe_in(docs, F.col("doc_id"), bit_filter(dropped, "doc_id", log2), log2, flag)
    sure = marked.where(~F.col(flag)).drop(flag)
    unsure = marked.where(F.col(flag)).drop(flag).join(dropped.select("doc_id").distinct(), "doc_id", "left_anti")
    return sure.unionByName(unsure.select(*sure.columns))


# --- labels of connected components ------------------------------------------------------------------------------------


def component_labels(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label) for every node of edges(a, b): label is the smallest node that edges reach.

    Alternates the large-star and small-star steps, which keep the components and shrink every one to a star around its
    smallest node, until all are stars. Each round is written to the shared folder; only counts reach the driver. Nodes
    with very many edges are met by broadcast, so none fills a task.
    """
    spark = edges.sparkSession
    path = scratch_path(spark, "edges")
    now = write_table(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), path)
    for _ in range(max_rounds):
        tops = now.groupBy("a").agg(F.count("*").alias("k"))
        if tops.where("k > 1").isEmpty() and now.join(tops.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            break
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("copies"))
        large = join_counted(both, low, "a", 2 * now.count()).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(least.select("a", F.col("m").alias("b"))).distinct()
        next_path = scratch_path(spark, "edges")
        now = write_table(small, next_path)
        delete_path(spark, path)
        path = next_path
        release(spark)
    else:
        raise RuntimeError("component labels did not settle")
    labels = materialize(now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()), "labels")
    delete_path(spark, path)
    return labels


def concat_ws_columns(cols: list[Column]) -> Column:
    return reduce(lambda a, b: F.concat(a, F.lit(","), b), cols)
