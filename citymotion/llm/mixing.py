"""Mixing sources to target weights (operator 1); DataFrame functions only.

Token weights of the cells (source, language, topic) are raked by iterative proportional
fitting: each sweep scales the cells of every source, then language, then topic, to its
target share.  There are ``SWEEPS`` sweeps at least, and more until every share is within
``TOLERANCE`` of its target, relatively.  ``MOST_SWEEPS`` without that raise for targets that the
caller gave (the cells cannot meet them together, mostly); default targets never raise, and
``fit`` returns how far the largest miss still is.  A number of sweeps that the caller
gives is done as it is, unchecked.  A document's probability is its cell's raked weight over its cell's tokens,
scaled so that the largest is 1; ``sampled`` compares it with a number in [0, 1) that
an MD5 of seed and id gives, so a decision never depends on partitions or reruns.

Targets: a dict of shares per dimension.  By default each cell's tokens are tempered: scaled
by the power ``ALPHAS[d] - 1`` of its category's share in each dimension d, which lifts small
sources and languages; a dimension's targets are the marginal of the tempered cells.
These exist together by construction, whatever goes with what (sources in one language
each, one source only).  Shares of categories that the corpus lacks are spread over the
others; categories without a given share get 0.

The cells are counted with map-side aggregation, so a source with a third of all rows is a
few partial rows; raking works on cells only, in files of the shared folder.  Cells are
broadcast to the documents only if their exact count proves them small.

Defined results: null source, language, topic or text are categories (texts) of their own:
``NONE`` and empty; cells without tokens have probability 0; repeated rows get the same
decision; an empty table gives an empty result.  Clashing columns: the topic is kept under
``__topic`` while sampling and dropped after.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citymotion.llm.common import written
from citymotion.session import broadcast_if_bounded

NONE = "(none)"
SWEEPS = 6
TOLERANCE = 1e-4
MOST_SWEEPS = 200  # a guard that fails
SEED = "mix-1"
ALPHAS = {"source": 0.8, "lang": 0.9, "topic": 1.0}
DIMENSIONS = ("source", "lang", "topic")
WORD_BREAK = r"[\x20\x09-\x0D]+"
# surface topics, first match wins
TOPICS = (("license", "Licensed under"), ("contact", "@"), ("table", " | "), ("marked", "%%%"))
ELSE_TOPIC = "prose"
CELL_BYTES = 512


def n_words(text: Column) -> Column:
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK, -1), "")
    return F.size(words).cast("long")


def topic(text: Column) -> Column:
    out = F.lit(ELSE_TOPIC)
    for name, mark in reversed(TOPICS):
        out = F.when(F.contains(text, F.lit(mark)), F.lit(name)).otherwise(out)
    return out


def uniform(id_col: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on seed and id alone."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with its cell in ``__source``, ``__lang``, ``__topic``; a column that
    ``docs`` lacks is one category."""
    def key(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(NONE)) if c in docs.columns else F.lit(NONE)

    return docs.withColumns({"__source": key("source"), "__lang": key("lang"), "__topic": topic(F.col("text")) if "topic" not in docs.columns else key("topic")})


def miss(state: DataFrame) -> float:
    """The largest relative distance of a share from its target (a target of 0: the share)."""
    every = None
    for d in DIMENSIONS:
        m = state.groupBy(d).agg(F.sum("weight").alias("now"), F.first(f"target_{d}").alias("target")).select("now", "target")
        every = m if every is None else every.unionByName(m)
    off = F.when(F.col("target") > 0, F.abs(F.col("now") / F.col("target") - 1)).otherwise(F.col("now"))
    return every.agg(F.max(off)).first()[0] or 0.0


def fit(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None, sweeps: int | None = None) -> tuple[DataFrame, float]:
    """(source, lang, topic, tokens) cells with ``weight``, raked to the targets, and the
    largest relative miss of a target that is left."""
    targets = targets or {}
    cells = written(cells.filter("tokens > 0"), "cells")
    whole = float(cells.agg(F.sum("tokens")).first()[0] or 1.0)
    lifted = cells.withColumn("tempered", F.col("tokens").cast("double"))
    for d in DIMENSIONS:
        if ALPHAS[d] != 1:
            share = cells.groupBy(d).agg((F.sum("tokens").cast("double") / F.lit(whole)).alias("__share"))
            lifted = lifted.join(share, d).withColumn("tempered", F.col("tempered") * F.pow(F.col("__share"), F.lit(ALPHAS[d] - 1))).drop("__share")
    totals = None
    for d in DIMENSIONS:
        t = lifted.select(F.lit(d).alias("dim"), F.col(d).alias("category"), "tempered")
        totals = t if totals is None else totals.unionByName(t)
    share = F.col("tempered")
    for d in DIMENSIONS:
        if d in targets:
            given = F.create_map(*[F.lit(x) for kv in targets[d].items() for x in (kv[0], float(kv[1]))])
            share = F.when(F.col("dim") == d, F.coalesce(F.try_element_at(given, F.col("category")), F.lit(0.0))).otherwise(share)
    wanted = written(totals.groupBy("dim", "category").agg(F.sum("tempered").alias("tempered")).withColumn("share", share), "wanted")
    sums = {r["dim"]: r["s"] for r in wanted.groupBy("dim").agg(F.sum("share").alias("s")).collect()}  # three rows
    state = cells.withColumn("weight", F.col("tokens").cast("double"))
    for d in DIMENSIONS:
        target = wanted.filter(F.col("dim") == d).select(F.col("category").alias(d), (F.col("share") / F.lit(sums.get(d) or 1.0)).alias(f"target_{d}"))
        state = state.join(target, d)
    state = written(state, "targets")
    for done in range(1, (MOST_SWEEPS if sweeps is None else sweeps) + 1):
        for d in DIMENSIONS:
            now = state.groupBy(d).agg(F.sum("weight").alias("now"))
            factor = F.when(F.col("now") > 0, F.col(f"target_{d}") / F.col("now")).otherwise(0.0)
            state = state.join(now, d).withColumn("weight", F.col("weight") * factor).drop("now")
        state = written(state, "raked")
        if sweeps is None and done >= SWEEPS and (off := miss(state)) <= TOLERANCE:
            break
    else:
        off = miss(state)
        if sweeps is None and targets:
            raise ValueError(f"after {MOST_SWEEPS} sweeps a share is still off its target by {off:.2g} of it (tolerance {TOLERANCE}): the cells cannot meet the targets together")
    return state.select(*DIMENSIONS, "tokens", "weight"), off


def rake(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None, sweeps: int | None = None) -> DataFrame:
    """The cells of ``fit``."""
    return fit(cells, targets, sweeps)[0]


def probabilities(counted: DataFrame, targets: dict[str, dict[str, float]] | None = None, sweeps: int | None = None) -> tuple[DataFrame, float]:
    """(source, lang, topic, probability) of the cells of ``counted`` (keyed rows with
    ``__tokens``), and the miss of ``fit``."""
    cells = counted.groupBy(*[F.col(f"__{d}").alias(d) for d in DIMENSIONS]).agg(F.sum("__tokens").alias("tokens"))
    raked, off = fit(cells, targets, sweeps)
    ratio = raked.withColumn("ratio", F.col("weight") / F.col("tokens"))
    most = ratio.agg(F.max("ratio")).first()[0] or 1.0
    out = ratio.select(*[F.col(d).alias(f"__{d}") for d in DIMENSIONS], F.round(F.col("ratio") / F.lit(most), 9).alias("__p"))
    return broadcast_if_bounded(out, out.count(), CELL_BYTES), off


def decided(docs: DataFrame, cells: DataFrame, id_col: str = "doc_id", seed: str = SEED) -> DataFrame:
    """Keyed ``docs`` with ``__p`` and the decision ``__sampled``."""
    out = docs.join(cells, [f"__{d}" for d in DIMENSIONS], "left").withColumn("__p", F.coalesce("__p", F.lit(0.0)))
    return out.withColumn("__sampled", uniform(F.col(id_col), seed) < F.col("__p"))


def report(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, id_col: str = "doc_id", sweeps: int | None = None, seed: str = SEED) -> DataFrame:
    """Per row: id, cell, tokens, probability, decision, and whether all targets are met."""
    rows = keyed(docs).select(F.col(id_col), *[f"__{d}" for d in DIMENSIONS], n_words(F.col("text")).alias("__tokens"))
    rows = written(rows, "counted")
    cells, off = probabilities(rows, targets, sweeps)
    out = decided(rows, cells, id_col, seed)
    return out.select(
        id_col, *[F.col(f"__{d}").alias(d) for d in DIMENSIONS], F.col("__tokens").alias("n_tokens"),
        F.col("__p").alias("probability"), F.col("__sampled").alias("sampled"), F.lit(off <= TOLERANCE).alias("targets_met"),
    )


def sample(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, id_col: str = "doc_id", sweeps: int | None = None, seed: str = SEED) -> DataFrame:
    """The sampled rows of ``docs``, with its columns."""
    rows = keyed(docs)
    cells, _ = probabilities(rows.select(*[f"__{d}" for d in DIMENSIONS], n_words(F.col("text")).alias("__tokens")), targets, sweeps)
    return decided(rows, cells, id_col, seed).filter("__sampled").select(*docs.columns)


def oracle(source: str = "documents", seed: str = SEED) -> str:
    """DuckDB SQL of ``report`` with the default targets and the same rule to stop."""
    case = " ".join(f"WHEN contains(coalesce(text, ''), '{mark}') THEN '{name}'" for name, mark in TOPICS)
    parts = [
        f"""rows_ AS (SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang, CASE {case} ELSE '{ELSE_TOPIC}' END AS topic,
  CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '{WORD_BREAK}'), lambda x: x <> '')) AS BIGINT) AS n_tokens FROM {source})""",
        "c AS (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM rows_ GROUP BY ALL HAVING sum(n_tokens) > 0)",
        "c0 AS (SELECT *, tokens" + "".join(f" * pow(sum(tokens) OVER (PARTITION BY {d}) / sum(tokens) OVER (), {ALPHAS[d]} - 1)" for d in DIMENSIONS if ALPHAS[d] != 1) + " AS tempered FROM c)",
        "cells AS MATERIALIZED (SELECT *, " + ", ".join(f"sum(tempered) OVER (PARTITION BY {d}) / sum(tempered) OVER () AS t_{d}" for d in DIMENSIONS) + " FROM c0)",
    ]
    step, targets = "raked", ", ".join(f"t_{d}" for d in DIMENSIONS)
    for d in DIMENSIONS:
        step = f"(SELECT sweep, source, lang, topic, tokens, {targets}, off, weight * (t_{d} / sum(weight) OVER (PARTITION BY {d})) AS weight FROM {step})"
        if d == DIMENSIONS[0]:
            step = step.replace("FROM raked)", f"FROM raked WHERE sweep < {SWEEPS} OR (off > {TOLERANCE} AND sweep < {MOST_SWEEPS}))")
    off = ", ".join(f"abs(sum(weight) OVER (PARTITION BY {d}) / t_{d} - 1)" for d in DIMENSIONS)
    parts += [
        f"""raked AS (SELECT 0 AS sweep, source, lang, topic, tokens, {targets}, CAST(1 AS DOUBLE) AS off, tokens AS weight FROM cells
  UNION ALL SELECT sweep + 1, source, lang, topic, tokens, {targets}, max(miss) OVER () AS off, weight FROM (SELECT *, greatest({off}) AS miss FROM {step}))""",
        "done AS MATERIALIZED (SELECT * FROM raked WHERE sweep = (SELECT max(sweep) FROM raked))",
        "p AS (SELECT source, lang, topic, off, round((weight / tokens) / (SELECT max(weight / tokens) FROM done), 9) AS probability FROM done)",
    ]
    number = f"CAST(CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(r.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0"
    return (
        "WITH RECURSIVE " + ",\n".join(parts) + f"""
SELECT r.doc_id, r.source, r.lang, r.topic, r.n_tokens, coalesce(p.probability, 0.0) AS probability, {number} < coalesce(p.probability, 0.0) AS sampled,
  coalesce((SELECT max(off) FROM p), 0) <= {TOLERANCE} AS targets_met
FROM rows_ r LEFT JOIN p ON r.source = p.source AND r.lang = p.lang AND r.topic = p.topic"""
    )
