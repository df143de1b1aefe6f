"""Mixing sources to target weights by iterative proportional fitting.

Token weights of the cells (source, language, topic) are raked until each
margin meets its target; documents are then sampled with probabilities in
proportion to their cell's factor, calibrated to a share of all tokens.  A kept
document carries ``factor / probability`` as its weight, so weighted tokens meet
the margins in expectation even where a probability was cut at 1.

The documents have no topic column; the default topic is the length class
(note, article, essay, book).  Default targets are the token shares to the power
``TEMPER``, which lifts small categories.  Given targets are looked up by category, as
many as there are; a target for ``OTHER`` is shared by all categories without one of their
own, in proportion to their tokens, and without it those get none.  A category whose target
is 0 keeps no document, whatever the share: if the others can't make up the share, they
are all kept.

All categories are raked, however many.  Up to ``DRIVER_CELLS`` cells (a million, some
40 MB) come to the driver, are raked there and are broadcast to the documents; more are
raked as grouped sums and joins, a staged table per round, and joined to the documents (AQE
splits a hot cell).  Both give the same factors.

Targets that contradict each other can't all be met: ``Mix.misfit`` is the largest relative
error of a margin, ``Mix.margins()`` lists what each category reaches, and a warning says
so above ``TOLERANCE``.

Inputs: a null category is one of its own, shown as ``(none)``; a category that is called so
is another one.  A given target for None, or else for ``(none)``, is the null category's.
Null and empty texts have no tokens; they don't weigh and are sampled like their cell.
Draws are hashes of id and text: rows equal in both share their fate.  Texts are only
counted, so their length doesn't matter; ties don't occur; an empty table has no cells and
gives an empty result; other columns are kept or not read, whatever their names.
"""

from __future__ import annotations

import logging
import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

log = logging.getLogger(__name__)

DIMS = ("source", "lang", "topic")
NONE, OTHER = "(none)", "(other)"
TEMPER = 0.85
SHARE = 0.9
DRIVER_CELLS = 1_000_000
ROUNDS = 200
TOLERANCE = 1e-3
PROBES = 64  # values of a factor that one pass over the cells tries
SEED = 977


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("bigint")


def length_topic(text: Column) -> Column:
    n = n_tokens(text)
    return F.when(n < 128, "note").when(n < 512, "article").when(n < 2048, "essay").otherwise("book")


# ---- raking, on the driver ----------------------------------------------------------

def rake(weights: np.ndarray, codes: np.ndarray, targets: list[np.ndarray], rounds: int = ROUNDS) -> np.ndarray:
    """Factors of cells with ``weights`` and category ``codes`` (a column per margin) that
    make every margin's weighted shares equal its target."""
    factor = np.ones(len(weights))
    for _ in range(rounds):
        worst = 0.0
        for k, target in enumerate(targets):
            now = np.bincount(codes[:, k], weights * factor, len(target))
            there = now > 0
            goal = target * there
            if not goal.sum():
                continue
            scale = np.where(there, goal / goal.sum() * now.sum() / np.where(there, now, 1), np.where(target > 0, 1.0, 0.0))
            factor *= scale[codes[:, k]]
            worst = max(worst, float(np.abs(scale[there & (target > 0)] - 1).max(initial=0)))
        if worst < 1e-12:
            break
    return factor


def misfit(weights: np.ndarray, codes: np.ndarray, targets: list[np.ndarray], factor: np.ndarray) -> float:
    """The largest relative error of a margin, among categories that have tokens."""
    worst = 0.0
    for k, target in enumerate(targets):
        tokens = np.bincount(codes[:, k], weights, len(target))
        goal = target * (tokens > 0)
        now = np.bincount(codes[:, k], weights * factor, len(target))
        if goal.sum() and now.sum():
            reached, goal = now / now.sum(), goal / goal.sum()
            worst = max(worst, float((np.abs(reached - goal)[goal > 0] / goal[goal > 0]).max(initial=0)))
    return worst


def calibrate(weights: np.ndarray, factor: np.ndarray, share: float) -> np.ndarray:
    """``min(1, k * factor)`` with ``k`` such that ``share`` of the weights is expected; where
    that is out of reach, 1 for all factors above 0."""
    if not weights.sum():
        return np.where(factor > 0, float(share), 0.0)
    order = np.argsort(-factor, kind="stable")
    w, f = weights[order], factor[order]
    full = np.concatenate([[0.0], np.cumsum(w)])  # of the cells cut at 1
    rest = np.concatenate([np.cumsum((w * f)[::-1])[::-1], [0.0]])
    for cut in range(len(w)):
        if rest[cut] <= 0:
            break
        k = (share * w.sum() - full[cut]) / rest[cut]
        if k * f[cut] <= 1:
            return np.minimum(1.0, max(k, 0.0) * factor)
    return np.where(factor > 0, 1.0, 0.0)


# ---- the same as Spark jobs -----------------------------------------------------------

def _on(d: str, left: str, right: str) -> Column:
    return F.col(f"{left}.{d}").eqNullSafe(F.col(f"{right}.{d}"))


def rake_table(cells: DataFrame, goals: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (dims, ``tokens``) with ``factor``; ``goals`` has ``goal`` of each category."""
    cells = cells.withColumn("factor", F.lit(1.0))
    for _ in range(rounds):
        steps = []
        for d in DIMS:
            now = cells.groupBy(d).agg(F.sum(F.col("tokens") * F.col("factor")).alias("now"))
            there = now.alias("n").join(goals[d].alias("g"), _on(d, "n", "g")).select(f"n.{d}", "now", "goal")
            sums = there.agg(F.sum("now").alias("all"), F.sum(F.when(F.col("now") > 0, F.col("goal"))).alias("goals")).first()
            if not sums.goals:
                continue
            scale = F.when(F.col("now") > 0, F.col("goal") / sums.goals * sums["all"] / F.col("now")).otherwise(F.when(F.col("goal") > 0, 1.0).otherwise(0.0))
            steps.append((d, stage(there.withColumn("scale", scale), "mix-margin")))
            scaled = cells.alias("c").join(steps[-1][1].select(d, "scale").alias("s"), _on(d, "c", "s"))
            cells = scaled.select("c.*", "s.scale").withColumn("factor", F.col("factor") * F.col("scale")).drop("scale")
        cells = stage(cells, "mix-raked")
        off = [s.where("now > 0 AND goal > 0").agg(F.max(F.abs(F.col("scale") - 1))).first()[0] or 0.0 for _, s in steps]
        if max(off, default=0.0) < 1e-9:
            break
    return cells


def calibrated_table(cells: DataFrame, share: float) -> DataFrame:
    """``cells`` with ``probability``.  The expected share grows with ``k``, so passes that try
    ``PROBES`` values each close in on the one wanted."""
    w, f = F.col("tokens"), F.col("factor")
    total, scaled, least, held = cells.agg(
        F.sum(w), F.sum(w * f), F.min(F.when((f > 0) & (w > 0), f)), F.sum(F.when(f > 0, w))
    ).first()
    if not total:
        return cells.withColumn("probability", F.when(f > 0, F.lit(float(share))).otherwise(0.0))
    if not scaled or held <= share * total:
        return cells.withColumn("probability", F.when(f > 0, 1.0).otherwise(0.0))
    lo, hi = share * total / scaled, 1 / least  # none is cut at 1; all are
    while hi / lo > 1 + 1e-13:
        tried = [lo * (hi / lo) ** (k / (PROBES - 1)) for k in range(PROBES)]
        got = cells.agg(*[F.sum(w * F.least(F.lit(1.0), F.lit(k) * f)) for k in tried]).first()
        under = max((k for k, x in zip(tried, got, strict=True) if x <= share * total), default=lo)
        over = min((k for k, x in zip(tried, got, strict=True) if x > share * total), default=hi)
        if (under, over) == (lo, hi):
            break
        lo, hi = under, over
    return cells.withColumn("probability", F.least(F.lit(1.0), F.lit(math.sqrt(lo * hi)) * f))


# ---- the operator -----------------------------------------------------------------------

def _raw(names: dict[str, Column]) -> list[Column]:
    return [names[d].cast("string").alias(d) for d in DIMS]


class Mix:
    """Cells with factors and probabilities, and how a document finds its cell."""

    def __init__(self, docs: DataFrame, names: dict[str, Column], text: Column, targets: dict[str, dict[str, float]] | None = None, share: float = SHARE):
        self.names, self.given = names, targets or {}
        raw = docs.select(*_raw(names), n_tokens(text).alias("tokens"))
        cells = raw.groupBy(*DIMS).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
        cells = stage(cells, "mix-cells")
        self.goals = {d: self._goals(cells, d) for d in DIMS}
        self.small = cells.count() <= DRIVER_CELLS
        self.table = self._on_driver(cells, share) if self.small else self._as_jobs(cells, share)
        if self.misfit > TOLERANCE:
            log.warning("mixing: after %d rounds a margin is off its target by %.1f %%", ROUNDS, 100 * self.misfit)

    def _goals(self, cells: DataFrame, d: str) -> DataFrame:
        """``goal`` (not normalised) of each category."""
        margin = cells.groupBy(d).agg(F.sum("tokens").alias("tokens"))
        given = self.given.get(d)
        if given is None:
            return stage(margin.select(d, F.when(F.col("tokens") > 0, F.pow("tokens", F.lit(TEMPER))).otherwise(0.0).alias("goal"), "tokens"), "mix-goals")
        own = {None: given[NONE]} if NONE in given else {}
        rows = [(k, float(v)) for k, v in {**own, **given}.items() if k != OTHER]
        named = cells.sparkSession.createDataFrame(rows, f"{d} string, own double")
        found = stage(margin.alias("m").join(named.alias("n"), _on(d, "m", "n"), "left").select(f"m.{d}", "tokens", "own"), "mix-goals")
        rest = found.where("own IS NULL").agg(F.sum("tokens")).first()[0] or 0
        other = float(given.get(OTHER, 0.0))
        goal = F.coalesce("own", F.lit(other) * F.col("tokens") / rest if rest else F.lit(0.0))
        found = found.select(d, goal.alias("goal"), "tokens")
        # Targets that name nothing that is there ask for nothing: all as it is.
        return found if found.where("goal > 0 AND tokens > 0").take(1) else found.withColumn("goal", F.col("tokens").cast("double"))

    def _on_driver(self, cells: DataFrame, share: float) -> DataFrame:
        found = cells.toPandas()  # at most DRIVER_CELLS
        found = found.sort_values(list(DIMS), na_position="first").reset_index(drop=True)
        w, codes, goals = found.tokens.to_numpy(np.float64), np.zeros((len(found), len(DIMS)), np.int64), []
        for k, d in enumerate(DIMS):
            goal = {r[d]: r.goal for r in self.goals[d].collect()}  # no more than cells
            place = {c: i for i, c in enumerate(goal)}
            codes[:, k] = [place[None if c is None or c != c else c] for c in found[d]]
            target = np.array([goal[c] for c in place])
            goals.append(target / target.sum() if target.sum() else target)
        factor = rake(w, codes, goals)
        self.misfit = misfit(w, codes, goals, factor)
        probability = calibrate(w, factor, share)
        rows = [
            (*(None if r[d] is None or r[d] != r[d] else r[d] for d in DIMS), int(r.tokens), float(f), float(p))
            for (_, r), f, p in zip(found.iterrows(), factor, probability, strict=True)
        ]
        kinds = ", ".join(f"{d} string" for d in DIMS)
        return cells.sparkSession.createDataFrame(rows, f"{kinds}, tokens bigint, factor double, probability double")

    def _as_jobs(self, cells: DataFrame, share: float) -> DataFrame:
        raked = rake_table(cells.drop("docs"), self.goals)
        table = stage(calibrated_table(raked, share), "mix-table")
        off = []
        for d in DIMS:
            now = table.groupBy(d).agg(F.sum(F.col("tokens") * F.col("factor")).alias("now"))
            there = now.alias("n").join(self.goals[d].where("tokens > 0").alias("g"), _on(d, "n", "g")).select("now", "goal")
            sums = there.agg(F.sum("now"), F.sum("goal")).first()
            if sums[0] and sums[1]:
                off.append(there.where("goal > 0").agg(F.max(F.abs(F.col("now") / sums[0] * sums[1] / F.col("goal") - 1))).first()[0] or 0.0)
        self.misfit = max(off, default=0.0)
        return table

    def margins(self) -> DataFrame:
        """``margin, category, tokens, target, reached``: shares asked for and shares of the weighted tokens."""
        parts = []
        for d in DIMS:
            now = self.table.groupBy(d).agg(F.sum(F.col("tokens") * F.col("factor")).alias("now"))
            both = now.alias("n").join(self.goals[d].alias("g"), _on(d, "n", "g")).select(f"n.{d}", "tokens", "now", "goal")
            now_all, goal_all = both.agg(F.sum("now"), F.sum(F.when(F.col("tokens") > 0, F.col("goal")))).first()
            share = lambda c, of: (F.col(c) / of if of else F.lit(None).cast("double"))
            parts.append(both.select(F.lit(d).alias("margin"), F.col(d).alias("category"), "tokens", share("goal", goal_all).alias("target"), share("now", now_all).alias("reached")))
        return reduce(DataFrame.unionByName, parts)

    def place(self, docs: DataFrame) -> DataFrame:
        """``docs`` (as ``d``) joined with their cell (as ``m``)."""
        table = self.table.select(*[F.col(d).alias(f"{d}_") for d in DIMS], F.col("factor").alias("factor_"), F.col("probability").alias("probability_")).alias("m")
        on = [c.eqNullSafe(F.col(f"m.{d}_")) for d, c in zip(DIMS, [self.names[d].cast("string") for d in DIMS], strict=True)]
        # At most DRIVER_CELLS rows; more are joined as the planner sees fit.
        return docs.alias("d").join(F.broadcast(table) if self.small else table, on)


def draw(id_col: Column, text: Column) -> Column:
    h = F.xxhash64(id_col, F.xxhash64(text), F.lit(SEED))
    return (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def _defaults(text_col: str) -> dict[str, Column]:
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": length_topic(F.col(text_col))}


def sample_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", names: dict[str, Column] | None = None, targets=None, share: float = SHARE) -> DataFrame:
    """Every document with its cell, factor, probability, draw and whether it is kept."""
    names, text = names or _defaults(text_col), F.col(text_col)
    mix = Mix(docs, names, text, targets, share)
    placed = mix.place(docs).select(
        F.col(id_col).alias("doc_id"),
        *[F.coalesce(names[d].cast("string"), F.lit(NONE)).alias(d) for d in DIMS],
        n_tokens(text).alias("n_tokens"),
        F.col("m.factor_").alias("factor"),
        F.col("m.probability_").alias("probability"),
        draw(F.col(id_col), text).alias("draw"),
    )
    kept = F.col("draw") < F.col("probability")
    return placed.withColumn("kept", kept).withColumn("weight", F.when(kept, F.col("factor") / F.col("probability")).otherwise(0.0))


def sampled_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", names: dict[str, Column] | None = None, targets=None, share: float = SHARE) -> DataFrame:
    """The sampled documents, columns as they came; decided row by row."""
    names = names or _defaults(text_col)
    mix = Mix(docs, names, F.col(text_col), targets, share)
    u = draw(F.col(f"d.`{id_col}`"), F.col(f"d.`{text_col}`"))
    return mix.place(docs).where(u < F.col("m.probability_")).select("d.*")
