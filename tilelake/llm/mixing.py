"""Operator 1, mixing sources to target weights by iterative proportional fitting.

Tokens are summed per cell (source, language, topic) with map-side sums. Inclusion probabilities per cell start equal and
are raked: each step scales the cells of a margin so that its expected tokens meet the target, and caps them at 1; the
steps go round the three margins until no probability changes any more, `rounds` times at most. Where caps or the margins
themselves contradict the targets, raking can't meet them: margins() gives the expected share, the target and the gap
of every category, and a warning names the largest gap if it is over `tolerance` of all tokens. Documents are then drawn by their own hash against their
cell's probability, so the draw needs no shuffle and is the same for every layout of the data; 1 / probability is the
weight that makes sums over the sample estimate sums over the corpus.

Cells go to the driver only while they are at most max_cells; beyond that the same steps run as DataFrame operations.

Defined results: null text has no tokens; null source, language or topic form categories of their own; documents without
tokens get their cell's probability; a category without a target keeps its share to the power alpha; a target for a
category that has no documents is left out and the rest renormalised; repeated rows draw alike; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import delete_path, documents, fresh, scratch_path, write_table

MARGINS = ["source", "lang", "topic"]
Targets = Mapping[str, Mapping[str, float]]


def n_tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def topic_of(text: Column) -> Column:
    """A coarse topic by what a text holds."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t.contains("@") | t.contains("+1 ("), "contact").when(t.contains(" | "), "table").when(t.contains("ights reserved") | t.contains("icense"), "notice").otherwise("prose")


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) from 52 bits of the MD5 of seed:doc_id."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13), 16, 10).cast("double") / float(1 << 52)


def shares(tokens: Mapping[str | None, float], target: Mapping[str, float] | None, alpha: float) -> dict[str | None, float]:
    """Target shares of the categories at hand, summing to 1."""
    total = sum(tokens.values())
    raw = {k: (target or {}).get(k, (t / total) ** alpha if t else 0.0) for k, t in tokens.items()}
    norm = sum(raw.values())
    return {k: v / norm for k, v in raw.items()} if norm else raw


#: Below what is seen after rounding to six places.
SETTLED = 1e-12


def rake(keys: list[tuple], tokens: np.ndarray, targets: Targets, alpha: float, budget: float, rounds: int) -> np.ndarray:
    """Probability of each cell."""
    p = np.full(len(keys), budget)
    aims, codes = [], []
    for j, name in enumerate(MARGINS):
        cats = sorted({k[j] for k in keys}, key=lambda x: (x is not None, x))
        code = np.array([cats.index(k[j]) for k in keys], np.int64)
        sums = np.bincount(code, tokens, len(cats))
        share = shares(dict(zip(cats, sums, strict=True)), targets.get(name), alpha)
        aims.append(np.array([share[c] for c in cats]) * budget * tokens.sum())
        codes.append(code)
    for _ in range(rounds):
        last = p
        for code, aim in zip(codes, aims, strict=True):
            now = np.bincount(code, tokens * p, len(aim))
            p = np.minimum(1.0, p * np.divide(aim, now, out=np.ones(len(aim)), where=now > 0)[code])
        if np.abs(p - last).max(initial=0.0) < SETTLED:
            break
    return p


def rake_distributed(cells: DataFrame, targets: Targets, alpha: float, budget: float, rounds: int) -> DataFrame:
    """rake() for cells that don't fit the driver: cells(source, lang, topic, tokens) with p."""
    spark, total = cells.sparkSession, cells.agg(F.sum("tokens")).head()[0] or 0
    path = scratch_path(spark, "cells")
    now = write_table(cells.withColumn("p", F.lit(float(budget))), path)
    aims = {}
    for name in MARGINS:
        share = cells.groupBy(name).agg(F.sum("tokens").alias("tokens"))
        kept = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(alpha))).otherwise(0.0)
        given = targets.get(name) or {}
        if given:
            listed = F.create_map(*[F.lit(x) for kv in given.items() for x in kv])
            kept = F.coalesce(F.when(F.col(name).isNotNull(), F.try_element_at(listed, F.col(name))), kept)
        share = share.select(name, kept.alias("raw"))
        norm = share.agg(F.sum("raw")).head()[0] or 1.0
        aim_path = scratch_path(spark, "aims")
        aims[name] = write_table(share.select(F.col(name).alias("cat"), (F.col("raw") / norm * budget * total).alias("aim")), aim_path)
    for _ in range(rounds):
        before = now
        for name in MARGINS:
            sums = now.groupBy(F.col(name).alias("cat")).agg(F.sum(F.col("tokens") * F.col("p")).alias("now"))
            scale = aims[name].join(sums, aims[name]["cat"].eqNullSafe(sums["cat"])).select(aims[name]["cat"].alias("cat"), F.when(F.col("now") > 0, F.col("aim") / F.col("now")).otherwise(1.0).alias("f"))
            now = now.join(scale, now[name].eqNullSafe(scale["cat"])).select(*MARGINS, "tokens", F.least(F.lit(1.0), F.col("p") * F.col("f")).alias("p"))
        next_path = scratch_path(spark, "cells")
        now = write_table(now, next_path)
        at = lambda df: F.struct(*[df[m] for m in MARGINS])
        moved = now.join(before.withColumnRenamed("p", "q"), at(now).eqNullSafe(at(before))).agg(F.max(F.abs(F.col("p") - F.col("q")))).head()[0]
        delete_path(spark, path)
        path = next_path
        if moved is None or moved < SETTLED:
            break
    return now


def probabilities(rows: DataFrame, targets: Targets, alpha: float, budget: float, rounds: int, max_cells: int) -> tuple[DataFrame, bool]:
    """(source, lang, topic, p) and whether it is small enough to broadcast. rows: the margins and n_tokens."""
    spark = rows.sparkSession
    cells = write_table(rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")), scratch_path(spark, "cells"))
    if cells.count() > max_cells:
        return rake_distributed(cells, targets, alpha, budget, rounds).select(*MARGINS, "p"), False
    found = cells.orderBy(*MARGINS).collect()
    keys = [tuple(r[m] for m in MARGINS) for r in found]
    p = rake(keys, np.array([float(r.tokens or 0) for r in found]), targets, alpha, budget, rounds)
    return spark.createDataFrame([(*k, float(x)) for k, x in zip(keys, p, strict=True)], "source string, lang string, topic string, p double"), True


def margins(mixed: DataFrame, targets: Targets, alpha: float, tolerance: float = 0.02) -> DataFrame:
    """margin, category, tokens, expected (after the draw), share (of expected), target and gap for every category of mix()'s rows."""
    expected = F.sum(F.col("n_tokens") * F.col("probability"))
    cells = write_table(mixed.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens"), expected.alias("expected")), scratch_path(mixed.sparkSession, "margins"))
    total, drawn = cells.agg(F.sum("tokens"), F.sum("expected")).head()
    out = None
    for name in MARGINS:
        each = cells.groupBy(F.col(name).alias("category")).agg(F.sum("tokens").alias("tokens"), F.sum("expected").alias("expected"))
        raw = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(alpha))).otherwise(0.0)
        if given := targets.get(name):
            listed = F.create_map(*[F.lit(x) for kv in given.items() for x in kv])
            raw = F.coalesce(F.when(F.col("category").isNotNull(), F.try_element_at(listed, F.col("category"))), raw)
        each = each.withColumn("raw", raw)
        norm = each.agg(F.sum("raw")).head()[0] or 1.0
        each = each.select(F.lit(name).alias("margin"), "category", "tokens", "expected", (F.col("expected") / F.lit(float(drawn or 1))).alias("share"), (F.col("raw") / norm).alias("target"))
        out = each if out is None else out.unionByName(each)
    out = out.withColumn("gap", F.col("share") - F.col("target"))
    worst = out.agg(F.max_by(F.struct("margin", "category", "gap"), F.abs("gap"))).head()[0]
    if worst is not None and abs(worst.gap) > tolerance:
        warnings.warn(f"raking leaves {worst.margin} {worst.category} {worst.gap:+.3f} from its target share", stacklevel=2)
    return out


def _matched(rows: DataFrame, cells: DataFrame, small: bool, names: list[str]) -> tuple[DataFrame, str]:
    """rows with the probability of their cell, and that column's name; names: the columns of rows that hold the margins."""
    *cols, p = fresh(rows, "mix_c0", "mix_c1", "mix_c2", "mix_p")
    cells = cells.select(*[F.col(m).alias(c) for m, c in zip(MARGINS, cols, strict=True)], F.col("p").alias(p))
    on = [F.col(n).eqNullSafe(F.col(c)) for n, c in zip(names, cols, strict=True)]
    return rows.join(F.broadcast(cells) if small else cells, on[0] & on[1] & on[2]).drop(*cols), p


#: Of the query and the pipeline.
LANG_TARGET = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}
ALPHA, BUDGET, ROUNDS, SEED, MAX_CELLS = 0.7, 0.5, 30, 17, 100_000


def mix(docs: DataFrame, topic: Column, targets: Targets, alpha: float = ALPHA, budget: float = BUDGET, rounds: int = ROUNDS, seed: int = SEED, max_cells: int = MAX_CELLS) -> DataFrame:
    """One row per document: doc_id, source, lang, topic, n_tokens, probability, weight (null at 0), selected."""
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), topic.cast("string").alias("topic"), n_tokens(F.col("text")).alias("n_tokens"))
    rows = write_table(rows, scratch_path(docs.sparkSession, "mix"))
    cells, small = probabilities(rows, targets, alpha, budget, rounds, max_cells)
    out, at = _matched(rows, cells, small, MARGINS)
    p = F.round(at, 6)
    return out.select("doc_id", *MARGINS, "n_tokens", p.alias("probability"), F.when(p > 0, F.round(1 / p, 6)).alias("weight"), (uniform(F.col("doc_id"), seed) < p).alias("selected"))


def sample_documents(docs: DataFrame, topic: Column, targets: Targets, alpha: float = ALPHA, budget: float = BUDGET, rounds: int = ROUNDS, seed: int = SEED, max_cells: int = MAX_CELLS) -> DataFrame:
    """The documents that mix() selects, with all their columns; texts are not shuffled unless cells outgrow max_cells."""
    rows = docs.select(F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), topic.cast("string").alias("topic"), n_tokens(F.col("text")).alias("n_tokens"))
    cells, small = probabilities(rows, targets, alpha, budget, rounds, max_cells)
    names = fresh(docs, "mix_source", "mix_lang", "mix_topic")
    wide = docs.withColumns({names[0]: F.col("source").cast("string"), names[1]: F.col("lang").cast("string"), names[2]: topic.cast("string")})
    out, p = _matched(wide, cells, small, names)
    return out.where(uniform(F.col("doc_id"), seed) < F.round(p, 6)).select(*docs.columns)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir), topic_of(F.col("text")), {"lang": LANG_TARGET})


def _sql() -> str:
    steps = []
    last = "c0"
    for r in range(ROUNDS):
        for j, m in enumerate(MARGINS):
            name = f"c{r * 3 + j + 1}"
            steps.append(f"{name} AS MATERIALIZED (SELECT source, lang, topic, tokens, a_source, a_lang, a_topic, least(1e0, p * (CASE WHEN sum(tokens * p) OVER w > 0 THEN a_{m} / sum(tokens * p) OVER w ELSE 1e0 END)) AS p FROM {last} WINDOW w AS (PARTITION BY {m}))")
            last = name
    lang = "CASE lang " + " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in LANG_TARGET.items()) + f" ELSE pow(s_lang / total, {ALPHA}) END"
    return rf"""
WITH d AS (
  SELECT doc_id, source, lang,
         CASE WHEN contains(t, '@') OR contains(t, '+1 (') THEN 'contact' WHEN contains(t, ' | ') THEN 'table' WHEN contains(t, 'ights reserved') OR contains(t, 'icense') THEN 'notice' ELSE 'prose' END AS topic,
         CAST(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens
  FROM (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents)),
g AS (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM d GROUP BY ALL),
s AS (SELECT *, sum(tokens) OVER () AS total, sum(tokens) OVER (PARTITION BY source) AS s_source, sum(tokens) OVER (PARTITION BY lang) AS s_lang, sum(tokens) OVER (PARTITION BY topic) AS s_topic FROM g),
r AS (SELECT *, pow(s_source / total, {ALPHA}) AS r_source, {lang} AS r_lang, pow(s_topic / total, {ALPHA}) AS r_topic FROM s),
c0 AS MATERIALIZED (SELECT source, lang, topic, tokens,
         r_source / (SELECT sum(x) FROM (SELECT DISTINCT source, r_source AS x FROM r)) * {BUDGET} * total AS a_source,
         r_lang / (SELECT sum(x) FROM (SELECT DISTINCT lang, r_lang AS x FROM r)) * {BUDGET} * total AS a_lang,
         r_topic / (SELECT sum(x) FROM (SELECT DISTINCT topic, r_topic AS x FROM r)) * {BUDGET} * total AS a_topic,
         CAST({BUDGET} AS DOUBLE) AS p FROM r),
{",".join(steps)}
SELECT doc_id, d.source, d.lang, d.topic, n_tokens, round(p, 6) AS probability, CASE WHEN round(p, 6) > 0 THEN round(1 / round(p, 6), 6) END AS weight,
       CAST('0x' || substr(md5('{SEED}:' || doc_id), 1, 13) AS BIGINT) / {float(1 << 52)!r} < round(p, 6) AS selected
FROM d JOIN {last} c ON d.source IS NOT DISTINCT FROM c.source AND d.lang IS NOT DISTINCT FROM c.lang AND d.topic IS NOT DISTINCT FROM c.topic
"""


SQL = _sql()
