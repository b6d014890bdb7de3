"""Operator 7, exact deduplication: a log-structured merge index of text digests.

Documents stream into a log of (doc_id, length, digest), a batch at a time. Memtables, hash slices of the log, flush as runs
sorted by digest; a run row keeps the best document and the count of its digest. Each run has a bit filter. Compaction
first asks the filters: a digest whose bit is set in one run only can't be in another, so its row goes to the new level as
it is, and only the others are shuffled and merged. Digests with more than one document are hits. A filter of the hits
tells most single documents at the scan, without a join, and picks the texts to verify: these are grouped by the bytes
themselves, and a digest that turns out to stand for several texts is split by text. Very large groups are joined by
broadcast, so none fills a task. Everything runs as DataFrame expressions: no Python code touches a row.

Defined results: null text counts as empty; all texts of white space only are equal; the longest original (code points)
stays, then the smallest doc_id, null doc_ids last. doc_id is a key: rows that repeat the winner's doc_id are all marked
kept. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITESPACE, bit_filter, delete_path, documents, filter_log2, join_counted, materialize, maybe_in, prune, scratch_path, scratch_scope, write_table

RESULT = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def normalised(text: Column) -> Column:
    """Text without the characters [\\x20\\x09-\\x0D]; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for ch in WHITESPACE:
        out = F.replace(out, F.lit(ch), F.lit(""))
    return out


def _rank(n_points: str = "n_points") -> Column:
    """Smallest first: longest text, then smallest doc_id, null last."""
    return F.struct((-F.col(n_points)).alias("neg"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"))


class DigestIndex:
    """Sorted digest runs in the shared folder. key_bytes shortens the digest (for tests of the byte verification), log2 is the size of a run's filter in bits."""

    def __init__(self, spark: SparkSession, path: str | None = None, key_bytes: int = 32, log2: int = 26):
        self.spark, self.key_bytes, self.log2 = spark, key_bytes, log2
        self.path = path or scratch_path(spark, "digest-index")
        self.logs: list[DataFrame] = []
        self.runs: list[DataFrame] = []
        self.filters: list[DataFrame] = []

    def key(self) -> Column:
        return F.substring(F.col("sha"), 1, self.key_bytes) if self.key_bytes < 32 else F.col("sha")

    def append(self, docs: DataFrame, memtables: int = 4) -> DataFrame:
        """Logs a batch and flushes its memtables as runs with their filters; the log."""
        at = len(self.logs)
        sha = F.unhex(F.sha2(normalised(F.col("text")), 256))
        rows = docs.select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).alias("n_points"), sha.alias("sha"))
        log = write_table(rows, f"{self.path}/log={at}")
        slice_ = (F.pmod(F.xxhash64("doc_id", "n_points"), F.lit(memtables)) + at * memtables).alias("run")
        runs = log.select(self.key().alias("digest"), slice_, _rank().alias("best")).groupBy("run", "digest").agg(F.min("best").alias("best"), F.count("*").alias("n"))
        runs = write_table(runs.sortWithinPartitions("run", "digest"), f"{self.path}/runs={at}")
        if not self.filters:
            self.log2 = min(self.log2, filter_log2(runs.count()) + 2)
        self.logs.append(log)
        self.runs.append(runs)
        self.filters.append(write_table(bit_filter(runs, "digest", self.log2, "run"), f"{self.path}/filters={at}"))
        return log

    def shared_bits(self) -> DataFrame:
        """The filter of digests that more than one run may hold: bits that any two runs' filters both have."""
        every = reduce(DataFrame.unionByName, self.filters)
        other = every.select("bf_bucket", F.col("run").alias("run2"), F.col("bf_bits").alias("bits2"))
        two = every.join(other, "bf_bucket").where("run < run2").select("bf_bucket", "run", "run2", F.explode(F.array("bf_bits", "bits2")).alias("bits"))
        return two.groupBy("bf_bucket", "run", "run2").agg(F.bitmap_and_agg("bits").alias("bits")).groupBy("bf_bucket").agg(F.bitmap_or_agg("bits").alias("bf_bits"))

    def compact(self) -> DataFrame:
        """One level of all runs: digest, the best document of all (keep_id, n_points) and the number of documents, n."""
        shared = write_table(self.shared_bits(), f"{self.path}/shared={len(self.runs)}")
        rows = maybe_in(reduce(DataFrame.unionByName, self.runs), F.col("digest"), shared, self.log2, "many")
        alone = rows.where("not many").select("digest", "best", "n")
        merged = rows.where("many").groupBy("digest").agg(F.min("best").alias("best"), F.sum("n").alias("n"))
        level = alone.unionByName(merged).select("digest", F.col("best.id").alias("keep_id"), (-F.col("best.neg")).alias("n_points"), "n")
        return write_table(level.sortWithinPartitions("digest"), f"{self.path}/level={len(self.runs)}")

    def verify(self, docs: DataFrame, hits: DataFrame, marks: DataFrame, log2: int) -> DataFrame:
        """Digests of hits whose texts differ. Equal texts collapse before the shuffle; rows that the filter clears never move."""
        rows = docs.select(normalised(F.col("text")).alias("norm")).withColumn("sha", F.unhex(F.sha2("norm", 256))).select(self.key().alias("digest"), "norm")
        rows = maybe_in(rows, F.col("digest"), marks, log2, "hit").where("hit")
        texts = rows.groupBy("digest", "norm").agg(F.count("*").alias("copies"))
        return materialize(texts.groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1").select("digest"), "collided")

    def drop(self) -> None:
        delete_path(self.spark, self.path)


def _decide(docs: DataFrame, index: DigestIndex, memtables: int) -> DataFrame:
    log = index.append(docs, memtables)
    hits = index.compact().where("n > 1")
    n_hits = hits.count()
    log2 = filter_log2(n_hits)
    marks = write_table(bit_filter(hits, "digest", log2), f"{index.path}/marks")
    collided = index.verify(docs, hits, marks, log2)
    rows = maybe_in(log.select("doc_id", "sha", index.key().alias("digest")), F.col("digest"), marks, log2, "hit")
    hex_ = F.lower(F.hex("sha")).alias("text_sha256")
    out = rows.where("not hit").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), hex_)
    unsure, split = rows.where("hit").drop("hit"), not collided.isEmpty()
    if split:
        unsure = unsure.join(collided, "digest", "left_anti")
    joined = join_counted(unsure, hits.select("digest", "keep_id", F.col("n").alias("copies"), F.col("n").alias("group_size")), "digest", log.count())
    own = F.col("group_size").isNull()
    out = out.unionByName(joined.select("doc_id", F.when(own, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), hex_))
    if split:
        full = docs.select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).alias("n_points"), normalised(F.col("text")).alias("norm")).withColumn("sha", F.unhex(F.sha2("norm", 256))).withColumn("digest", index.key())
        full = materialize(full.join(collided, "digest", "left_semi"), "collided-rows")
        best = full.groupBy("digest", "norm").agg(F.min(_rank()).alias("best"), F.count("*").alias("n"))
        out = out.unionByName(full.join(best, ["digest", "norm"]).select("doc_id", F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"), hex_))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(*RESULT)


def exact_dedup(docs: DataFrame, memtables: int = 4, key_bytes: int = 32) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    return _decide(docs.select("doc_id", "text"), DigestIndex(docs.sparkSession, key_bytes=key_bytes), memtables)


def drop_exact_copies(docs: DataFrame, memtables: int = 4) -> DataFrame:
    """The documents that exact_dedup keeps, with all their columns."""
    index = DigestIndex(docs.sparkSession)
    with scratch_scope(docs.sparkSession):
        decided = materialize(_decide(docs.select("doc_id", "text"), index, memtables).where("not kept").select("doc_id"), "exact-dropped", outlive=True)
    index.drop()
    return prune(docs, decided, decided.count())


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm, length(coalesce(text, '')) AS n_points
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       sha256(norm) AS text_sha256
FROM d
WINDOW w AS (PARTITION BY norm ORDER BY n_points DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""
