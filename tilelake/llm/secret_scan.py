"""Operator 3, secret scans with corpus-wide ownership frequency, as DataFrame expressions only.

Each document is scanned for the base kinds (assign, access, hex) and for further candidate kinds (prefixed tokens, web
tokens, mixed-case random strings, hexadecimal runs in capitals). Splitting the text at the matches gives the gaps before
them, and a running sum over a document's gaps and matches gives positions, in linear time. Candidate values are hashed and counted over the corpus by distinct owner and repository,
in three grouped steps that each pre-aggregate. A value in more than max_owners owners is a copied example; one that is
confined to few owners and looks random is live. Base spans always stay; further candidates become spans if live.

Defined results: null text is empty, with zero counts and the hash of the empty string; null owners and repositories
count as one owner and one repository of their own; repeated rows are reported each and count as more copies of the same
owner; an empty table gives an empty result; texts of any length are scanned whole; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, join_counted, materialize

# The base patterns.
BASE = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}
#: Same matches as BASE after its length filter, for patterns whose failing matches hide nothing; these skip short runs in the matcher.
_FAST = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}
EXTRA = {
    "prefixed": (r"\b(gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9]{24,}|xox[abprs]-[A-Za-z0-9-]{20,})", 0, 20),
    "webtoken": (r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 36),
    "mixed": (r"\b[A-Za-z0-9]{24,}", 0, 24),
    "hexcaps": (r"\b[0-9A-F]{32,}\b", 0, 32),
}
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|your|placeholder|x{4,}|0{6,}|1234567|abcdef"
KINDS = [*BASE, *EXTRA]


_PART = "struct<ord:int,i:int,gap:int,len:int,v:string>"


def find_parts(text: Column, kind: str, pattern: str, group: int) -> Column:
    """array<struct<ord, i, gap, len, v>>: the matches of a kind in order, each with the code points since the match before it, its length and its value."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    zipped = F.filter(F.arrays_zip(F.split(text, pattern, -1).alias("p"), whole.alias("m"), value.alias("v")), lambda x: x["m"].isNotNull())

    def part(x: Column, i: Column) -> Column:
        return F.struct(F.lit(KINDS.index(kind)).alias("ord"), i.alias("i"), F.char_length(x["p"]).alias("gap"), F.char_length(x["m"]).alias("len"), x["v"].alias("v"))

    return F.when(text.rlike(pattern), F.transform(zipped, part)).otherwise(F.expr(f"cast(array() as array<{_PART}>)"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def live_looking(value: Column) -> Column:
    """Random-looking: letters and digits, many different characters, no placeholder words."""
    varied = F.size(F.array_distinct(F.split(value, ""))) >= 10
    return varied & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & ~value.rlike(PLACEHOLDER)


def scan(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """One narrow row per document: the parts of all kinds with hashes in place of values, without the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), owner.cast("string").alias("owner"), repository.cast("string").alias("repository"))
    parts = F.concat(*[find_parts(F.col("text"), kind, _FAST.get(kind, pattern), group) for kind, (pattern, group, _) in (BASE | EXTRA).items()])
    least = F.array(*[F.lit(n) for _, _, n in (BASE | EXTRA).values()])

    def narrow(x: Column) -> Column:
        long = F.char_length(x["v"]) >= F.element_at(least, x["ord"] + 1)
        mixed = x["v"].rlike("[a-z]") & x["v"].rlike("[A-Z]") & x["v"].rlike("[0-9]")
        ok = long & ((x["ord"] != KINDS.index("mixed")) | mixed)
        return F.struct(x["ord"], x["i"], x["gap"], x["len"], F.unhex(F.sha2(x["v"], 256)).alias("h"), ok.alias("ok"), live_looking(x["v"]).alias("live"))

    return rows.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "owner", "repository", F.transform(parts, narrow).alias("parts"))


def candidates(rows: DataFrame) -> DataFrame:
    """uid, owner, repository, s, ord, e, kind, h, live: the spans of scan(), positions in code points, end exclusive."""
    each = rows.where(F.size("parts") > 0).select("uid", "owner", "repository", F.explode("parts").alias("c")).select("uid", "owner", "repository", "c.*")
    end = F.sum(F.col("gap") + F.col("len")).over(Window.partitionBy("uid", "ord").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("ord") + 1)
    placed = each.withColumn("e", end.cast("int")).withColumn("s", F.col("e") - F.col("len"))
    return placed.where("ok").select("uid", "owner", "repository", "s", "ord", "e", kind.alias("kind"), "h", "live")


def ownership(cands: DataFrame) -> DataFrame:
    """Hash of a value -> number of owners, repositories and documents over the corpus."""
    by_repo = cands.select("uid", "owner", "repository", "h").distinct().groupBy("h", "owner", "repository").agg(F.count("*").alias("copies"))
    by_owner = by_repo.groupBy("h", "owner").agg(F.count("*").alias("repositories"), F.sum("copies").alias("copies"))
    return by_owner.groupBy("h").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("copies").alias("copies"))


def secret_scan(docs: DataFrame, owner: Column, repository: Column, max_owners: int = 2) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied."""
    rows = materialize(scan(docs, owner, repository), "secret-rows")
    cands = materialize(candidates(rows), "secret-spans")
    owned = materialize(ownership(cands), "secret-owners")
    # a value in very many documents is found by broadcast: not more than 1000 values hold a thousandth of the spans each
    spans = cands.count()
    counted = owned.join(cands.groupBy("h").agg(F.count("*").alias("spans")), "h").select("h", "owners", F.col("spans").alias("copies"))
    cands = join_counted(cands.drop("owner", "repository"), counted, "h", spans)
    copied = F.col("owners") > max_owners
    live, base = ~copied & F.col("live"), F.col("ord") < len(BASE)
    span = F.struct("s", "ord", "e", "kind")
    by_doc = cands.groupBy("uid").agg(
        *[F.count_if(F.col("ord") == i).alias(f"n_{k}") for i, k in enumerate(BASE)],
        F.array_sort(F.array_distinct(F.collect_list(F.when(base | live, span)))).alias("spans"), F.array_sort(F.collect_list(F.when(base, span))).alias("base"),
        F.count_if(live).alias("n_live"), F.count_if(copied).alias("n_copied"),
    )
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    joined = lambda c: F.coalesce(_joined(F.col(c)), F.lit(""))
    return rows.select("uid", "doc_id").join(by_doc, "uid", "left").select(
        "doc_id", *[count(f"n_{k}") for k in BASE], F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"), count("n_live"), count("n_copied"),
    )


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owner: the source. Repository: a language within a source."""
    return secret_scan(documents(spark, sf_dir), F.col("source"), F.concat_ws("/", "source", "lang"))


def _sql() -> str:
    """The same rows in DuckDB's SQL, whose regular expressions fold more than A-Z: letters in either case are spelt out."""

    def plain(pattern: str) -> str:
        if pattern.startswith("(?i)"):
            words = pattern[4:].split(")", 1)
            pattern = re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", words[0]) + ")" + words[1]
        return pattern.replace("'", "''")

    found = "\n  UNION ALL ".join(
        f"SELECT uid, owner, {i} AS ord, '{kind}' AS kind, {least} AS least, string_split_regex(text, '{plain(p)}') AS gaps, "
        f"regexp_extract_all(text, '{plain(p)}', 0) AS whole, regexp_extract_all(text, '{plain(p)}', {group}) AS vals FROM d"
        for i, (kind, (p, group, least)) in enumerate((BASE | EXTRA).items())
    )
    n = len(BASE)
    counts = ", ".join(f"count(c.uid) FILTER (c.ord = {i}) AS n_{kind}" for i, kind in enumerate(BASE))
    return f"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, source AS owner, coalesce(text, '') AS text FROM documents),
f AS (
  {found}),
i AS (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM f),
c AS (
  SELECT uid, owner, ord, kind, vals[i] AS v, least, list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS s,
         length(whole[i]) AS n
  FROM i),
ok AS (
  SELECT uid, owner, ord, kind, v, CAST(s AS BIGINT) AS s, CAST(s + n AS BIGINT) AS e,
         len(list_distinct(string_split(v, ''))) >= 10 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AND NOT regexp_matches(v, '{PLACEHOLDER}') AS random
  FROM c WHERE length(v) >= least AND (kind <> 'mixed' OR (regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[0-9]')))),
owned AS (SELECT v, count(DISTINCT owner) + max(CAST(owner IS NULL AS INT)) > 2 AS copied FROM ok GROUP BY v),
judged AS (SELECT ok.*, copied, random AND NOT copied AS live, kind || ':' || s || ':' || e AS span FROM ok JOIN owned USING (v)),
docs AS (
  SELECT d.uid, any_value(d.doc_id) AS doc_id, {counts},
         sha256(coalesce(string_agg(c.span, ',' ORDER BY c.s, c.ord) FILTER (c.ord < {n}), '')) AS base_sha256,
         coalesce(string_agg(c.span, ',' ORDER BY c.s, c.ord) FILTER (c.ord < {n} OR c.live), '') AS spans,
         count(c.uid) FILTER (c.live) AS n_live, count(c.uid) FILTER (c.copied) AS n_copied
  FROM d LEFT JOIN judged c ON c.uid = d.uid GROUP BY d.uid)
SELECT * EXCLUDE (uid) FROM docs
"""


SQL = _sql()
