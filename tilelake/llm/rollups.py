"""Operator 10, token counts: delta-maintained rollups with idempotent batch commits.

A batch is a table of signed changes: inserts, deletes and revised counts, by source, language and tokenizer version. A
revision carries the count before and after (and the keys before, if they changed). Each batch is pre-aggregated to one
signed row per key, written aside and then renamed to its own folder in the shared store: the rename is the commit, and
of two writers of one batch id only one succeeds. A batch id that is already committed is ignored, what is left half
written is never read, so replays and lost executors change nothing. Totals are the sum of all committed deltas;
compaction lists the batches once and folds these, and only these, into a base that names them.

Defined results: null source, language or version form keys of their own; null counts are 0; an insert of n tokens adds
one document and n tokens, a delete takes them away, a revision adds the difference; keys whose documents and tokens are
all gone are left out; repeated rows of a batch are separate changes; an empty batch commits and changes nothing; an op
that is null or none of insert, delete and revise, or a revision without the column old_tokens, fails the batch, which
is then not committed; other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import delete_path, documents, materialize, path_exists, scratch_path

KEYS = ["source", "lang", "version"]
_DELTA = "source string, lang string, version string, d_docs long, d_tokens long"


class TokenRollup:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, batch: str) -> str:
        return f"{self.path}/deltas/batch={batch}"

    def _names(self, folder: str, marker: str) -> list[str]:
        if not path_exists(self.spark, folder):
            return []
        p = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        names = [s.getPath().getName() for s in p.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(p)]
        return [n for n in names if path_exists(self.spark, f"{folder}/{n}/{marker}")]

    def _base(self) -> str | None:
        """The newest whole base; its ids are written last."""
        names = self._names(f"{self.path}/base", "ids/_SUCCESS")
        return f"{self.path}/base/{max(names, key=lambda n: int(n[1:]))}" if names else None

    def _folded(self, base: str | None, batches: list[str]) -> set[str]:
        """Which of batches the base holds. Only asked for batches that still have folders, or one that is to be committed."""
        if base is None or not batches:
            return set()
        ids = self.spark.read.schema("batch string").parquet(f"{base}/ids")
        return {r.batch for r in ids.where(F.col("batch").isin(batches)).distinct().collect()}

    def committed(self, batch: str) -> bool:
        return path_exists(self.spark, f"{self._folder(batch)}/_SUCCESS") or bool(self._folded(self._base(), [batch]))

    def _batches(self) -> list[str]:
        return sorted(n.removeprefix("batch=") for n in self._names(f"{self.path}/deltas", "_SUCCESS"))

    @staticmethod
    def deltas(changes: DataFrame) -> DataFrame:
        """Signed sums per key of changes(op, source, lang, version, n_tokens[, old_source, old_lang, old_version, old_tokens])."""
        n = F.coalesce(F.col("n_tokens"), F.lit(0)).cast("long")
        after = F.struct(*[F.col(k).cast("string").alias(k) for k in KEYS], F.lit(1).cast("long").alias("d_docs"), n.alias("d_tokens"))
        gone = F.struct(*[F.col(k).cast("string").alias(k) for k in KEYS], F.lit(-1).cast("long").alias("d_docs"), (-n).alias("d_tokens"))
        cases = F.when(F.col("op") == "insert", F.array(after)).when(F.col("op") == "delete", F.array(gone))
        if "old_tokens" in changes.columns:
            was = [F.col(f"old_{k}" if f"old_{k}" in changes.columns else k).cast("string").alias(k) for k in KEYS]
            before = F.struct(*was, F.lit(-1).cast("long").alias("d_docs"), (-F.coalesce(F.col("old_tokens"), F.lit(0)).cast("long")).alias("d_tokens"))
            cases = cases.when(F.col("op") == "revise", F.array(before, after))
        kind = "array<struct<source:string,lang:string,version:string,d_docs:bigint,d_tokens:bigint>>"
        cases = cases.otherwise(F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(F.col("op").cast("string"), F.lit("null")))).cast(kind))
        each = changes.select(F.explode(cases).alias("d")).select("d.*")
        return each.groupBy(*KEYS).agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens"))

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commits a batch; False if it was committed before."""
        if not batch.replace("-", "").replace("_", "").isalnum():
            raise ValueError("batch ids are letters, digits, - and _")
        if self.committed(batch):
            return False
        aside = f"{self.path}/aside/{uuid.uuid4().hex}"
        self.deltas(changes).write.mode("overwrite").parquet(aside)
        return self._rename(aside, self._folder(batch))

    def _rename(self, of: str, to: str) -> bool:
        """Puts a whole folder in place; False if another writer was first."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        source, target = hadoop.Path(of), hadoop.Path(to)
        if path_exists(self.spark, to) and not path_exists(self.spark, f"{to}/_SUCCESS"):
            delete_path(self.spark, to)  # left by a writer that did not finish
        files = source.getFileSystem(self.spark._jsc.hadoopConfiguration())
        files.mkdirs(target.getParent())
        if not path_exists(self.spark, to) and files.rename(source, target) and not path_exists(self.spark, f"{to}/{source.getName()}"):
            return True
        delete_path(self.spark, f"{to}/{source.getName()}")  # some stores move into a folder that has appeared meanwhile
        delete_path(self.spark, of)
        return False

    def _all(self, base: str | None, batches: list[str]) -> DataFrame:
        """The rows of a base and of those batches that it does not hold."""
        read, folded = self.spark.read.schema(_DELTA), self._folded(base, batches)
        paths = ([f"{base}/sums"] if base else []) + [self._folder(b) for b in batches if b not in folded]
        return read.parquet(*paths) if paths else self.spark.createDataFrame([], _DELTA)

    def compact(self) -> None:
        """Folds the batches that are committed now into a new base, then removes their folders. One compaction at a time."""
        base, batches = self._base(), self._batches()
        to = f"{self.path}/base/v{int(base.rpartition('/v')[2]) + 1 if base else 1}"
        sums = self._all(base, batches).groupBy(*KEYS).agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens"))
        sums.write.mode("overwrite").parquet(f"{to}/sums")
        ids = self.spark.createDataFrame([(b,) for b in batches], "batch string")
        if base:
            ids = ids.union(self.spark.read.schema("batch string").parquet(f"{base}/ids")).distinct()
        ids.write.mode("overwrite").parquet(f"{to}/ids")
        for b in batches:
            delete_path(self.spark, self._folder(b))

    def totals(self) -> DataFrame:
        """source, lang, version, n_docs, n_tokens."""
        sums = self._all(self._base(), self._batches()).groupBy(*KEYS).agg(F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens"))
        return sums.where("n_docs <> 0 or n_tokens <> 0")


def word_tokens(text: Column) -> Column:
    """Version w1: runs of characters other than [\\x20\\x09-\\x0D]."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def byte_tokens(text: Column) -> Column:
    """Version b4: one token for every four bytes begun."""
    return F.ceil(F.octet_length(F.coalesce(text, F.lit(""))) / 4).cast("long")


def op10_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches over all documents: first counts, revised counts for a third (version b4 instead of w1), deletes of a
    seventh, then the first batch once more, which changes nothing. Each batch's counts come from whole texts."""
    docs = documents(spark, sf_dir)
    counted = docs.select("doc_id", "source", "lang", word_tokens(F.col("text")).alias("w1"), byte_tokens(F.col("text")).alias("b4"))
    counts = materialize(counted, "token-counts")
    third, seventh = F.col("doc_id") % 3 == 0, F.col("doc_id") % 7 == 0
    first = counts.select(F.lit("insert").alias("op"), "source", "lang", F.lit("w1").alias("version"), F.col("w1").alias("n_tokens"))
    revised = counts.where(third).select(F.lit("revise").alias("op"), "source", "lang", F.lit("b4").alias("version"), F.col("b4").alias("n_tokens"), F.lit("w1").alias("old_version"), F.col("w1").alias("old_tokens"))
    gone = counts.where(seventh).select(F.lit("delete").alias("op"), "source", "lang", F.when(third, "b4").otherwise("w1").alias("version"), F.when(third, F.col("b4")).otherwise(F.col("w1")).alias("n_tokens"))
    rollup = TokenRollup(spark, scratch_path(spark, "rollup"))
    for batch, changes in (("load-1", first), ("revise-1", revised), ("load-1", first), ("delete-1", gone), ("revise-1", revised)):
        rollup.apply(batch, changes)
    rollup.compact()
    rollup.apply("load-1", first)
    return rollup.totals()


SQL = r"""
WITH c AS (
  SELECT doc_id, source, lang, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w1, (strlen(coalesce(text, '')) + 3) // 4 AS b4
  FROM documents)
SELECT source, lang, CASE WHEN doc_id % 3 = 0 THEN 'b4' ELSE 'w1' END AS version, count(*) AS n_docs,
       CAST(sum(CASE WHEN doc_id % 3 = 0 THEN b4 ELSE w1 END) AS BIGINT) AS n_tokens
FROM c WHERE doc_id % 7 <> 0
GROUP BY ALL
"""
