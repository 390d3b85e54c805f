"""Operator 10: mix sources to target weights by entropy balancing, in DataFrame functions only.

Targets.  Sources in code-point order (null last) weigh ``WEIGHTS`` in turn and
share ``SHARE`` of all words; a target stops at ``CAP`` times its source's size
and the excess is shared again by weight until no target is above.

Rates.  Among all document rates ``0 <= r <= CAP`` that meet a source's token
constraint ``sum(size * r) = target``, entropy balancing takes those with the
least relative entropy to rate 1: ``r = min(CAP, exp(lambda * size / mean))``,
an exponential tilt whose ``lambda`` solves the convex dual.  Newton steps
(bracketed, so that the cap's kink cannot throw them out) run for all sources
at once.  A rate depends on source and size alone, so every step aggregates
the ``(source, size, documents)`` histogram, not the documents.

Copies.  Systematic rounding of the running rate, long documents first, gives
whole copies per histogram row; the words still missing or in excess are then
closed by copies of ever shorter documents, until no document fits the rest.
Inside a histogram row the copies go to documents in the order of a hash of
the id, ranked in ``CELLS`` cells so that no hot group is ranked in one task.

Defined cases: a null text or one without words has size 0 and is never taken;
a null source is a source of its own, the last; a null id is an id like any
other; repeated rows count each; an empty table gives an empty result; columns
that clash with a result's name are replaced by the result, those with an inner
name (``_INNER``) are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, others, stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
CELLS = 4096          # rank cells per (source, size)
TOLERANCE = 1e-7      # of a token constraint, relative; the copies close what is left
MAX_STEPS = 80        # bracketed Newton steps; about ten are taken

_RESULTS = ("size", "source_size", "target", "rate", "copies", "taken")
_INNER = ("_src", "_z", "_cell", "_off", "_each", "_more")


def sizes(docs: DataFrame, text: str, source: str) -> DataFrame:
    """``docs`` with ``_src`` (sorts as the source, null last) and ``_z`` (its words)."""
    return (docs.withColumn("_src", F.when(F.col(source).isNull(), "b").otherwise(F.concat(F.lit("a"), source)))
            .withColumn("_z", F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")))


def targets(histogram: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """``(_src, source_size, mean, target)`` of every source."""
    per = stored(histogram.groupBy("_src").agg(F.sum(F.col("_z") * F.col("_n")).alias("source_size"),
                                               F.sum("_n").alias("docs")), "sources")
    # Rank of a source: one row per source, range partitioned; ranges are numbered by their offsets.
    ranked = stored(per.repartitionByRange("_src").sortWithinPartitions("_src")
                    .withColumn("_m", F.monotonically_increasing_id())
                    .withColumn("_range", F.shiftright("_m", 33))
                    .withColumn("_at", F.col("_m").bitwiseAND((1 << 33) - 1)), "ranked")
    offsets = (ranked.groupBy("_range").agg(F.count(F.lit(1)).alias("_k"))
               .withColumn("_off", F.sum("_k").over(Window.orderBy("_range")) - F.col("_k")))
    order = (F.col("_off") + F.col("_at")) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (order + 1).cast("int"))
    s = ranked.join(offsets, "_range").select(
        "_src", "source_size", "docs", weight.alias("w"), (F.col("source_size") * float(cap)).alias("top"))
    s = stored(s, "weights")
    whole = s.agg(F.sum("source_size"), F.sum("w")).first()
    if not whole[0]:
        level = 0.0
    else:
        total, level = share * whole[0], share * whole[0] / whole[1]
        if share >= cap:
            level = math.inf
        while level < math.inf:      # the level rises until no further source is capped
            over = F.col("w") * level >= F.col("top")
            used, free = s.agg(F.sum(F.when(over, F.col("top")).otherwise(0.0)),
                               F.sum(F.when(over, 0.0).otherwise(F.col("w")))).first()
            raised = (total - used) / free if free else math.inf
            if raised <= level * (1 + 1e-15):
                break
            level = raised
    aim = F.least(F.col("top"), F.col("w") * F.lit(level)) if level < math.inf else F.col("top")
    return s.select("_src", "source_size", (F.col("source_size") / F.col("docs")).alias("mean"),
                    aim.alias("target"))


def tilts(histogram: DataFrame, goal: DataFrame, cap: int = CAP) -> DataFrame:
    """``(_src, lam)``: the tilt of every source; null where no rate but 0 or ``cap`` will do."""
    top = F.col("source_size") * float(cap)
    inner = (F.col("target") > 0) & (F.col("target") < top * (1 - 1e-12))
    state = stored(goal.select("_src", "mean", "target", F.when(inner, 0.0).alias("lam"),
                               F.lit(-math.inf).alias("lo"), F.lit(math.inf).alias("hi"),
                               F.lit(False).alias("done")), "dual")
    for _ in range(MAX_STEPS):
        x = F.col("_z") / F.col("mean")
        tilt = F.exp(F.col("lam") * x)
        mass = F.col("_n") * F.col("_z")
        terms = histogram.where("_z > 0").join(state.where("lam is not null and not done").select("_src", "mean", "lam"), "_src")
        sums = terms.groupBy("_src").agg(
            F.sum(mass * F.least(F.lit(float(cap)), tilt)).alias("f"),
            F.sum(F.when(tilt < float(cap), mass * x * tilt).otherwise(0.0)).alias("slope"))
        s = state.join(sums, "_src", "left")
        gap = F.col("f") - F.col("target")
        done = F.col("done") | F.col("lam").isNull() | (F.abs(gap) <= F.col("target") * TOLERANCE)
        lo = F.when(gap < 0, F.greatest("lo", "lam")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.least("hi", "lam")).otherwise(F.col("hi"))
        s = (s.withColumn("done", F.coalesce(done, F.lit(True))).withColumn("lo", lo).withColumn("hi", hi)
             .withColumn("newton", F.when(F.col("slope") > 0, F.col("lam") - gap / F.col("slope"))))
        inside = F.col("newton").isNotNull() & (F.col("newton") > F.col("lo")) & (F.col("newton") < F.col("hi"))
        half = (F.when(F.col("hi") == math.inf, F.greatest(F.lit(1.0), 2 * F.abs("lo")))
                .when(F.col("lo") == -math.inf, -F.greatest(F.lit(1.0), 2 * F.abs("hi")))
                .otherwise((F.col("lo") + F.col("hi")) / 2))
        step = F.when(F.col("done"), F.col("lam")).when(inside, F.col("newton")).otherwise(half)
        state = stored(s.select("_src", "mean", "target", step.alias("lam"), "lo", "hi", "done"), "dual")
        if state.where("not done").limit(1).count() == 0:
            break
    # Sums arrive in any order; the tilt is rounded far above their noise so that reruns agree.
    return state.select("_src", F.round("lam", 9).alias("lam"))


def _rounded(histogram: DataFrame, goal: DataFrame, lam: DataFrame, cap: int) -> DataFrame:
    """The histogram with ``rate`` and ``_c``: copies of all its documents together."""
    full = F.when(F.col("target") > 0, float(cap)).otherwise(0.0)
    rate = F.when(F.col("_z") == 0, 0.0).when(F.col("lam").isNull(), full).otherwise(
        F.least(F.lit(float(cap)), F.exp(F.col("lam") * F.col("_z") / F.col("mean"))))
    h = (histogram.join(goal, "_src").join(lam, "_src").withColumn("rate", rate)
         .withColumn("_m", F.sum(F.col("rate") * F.col("_n")).over(
             Window.partitionBy("_src").orderBy(F.col("_z").desc()).rowsBetween(Window.unboundedPreceding, 0))))
    up = F.floor(F.col("_m") + 0.5)
    before = F.floor(F.coalesce(F.lag("_m").over(Window.partitionBy("_src").orderBy(F.col("_z").desc())), F.lit(0.0)) + 0.5)
    copies = F.greatest(F.lit(0), F.least(F.col("_n") * cap, up - before)).cast("long")
    h = stored(h.select("_src", "_z", "_n", "source_size", "target", "rate", copies.alias("_c")), "copies")
    while True:
        taken = h.groupBy("_src").agg((F.first("target") - F.sum(F.col("_c") * F.col("_z"))).alias("_rest"))
        open_ = h.join(taken, "_src")
        room = F.when(F.col("_rest") > 0, F.col("_n") * cap - F.col("_c")).otherwise(F.col("_c"))
        best = (open_.where((F.col("_z") > 0) & (F.col("_z") <= F.abs("_rest")) & (room > 0))
                .groupBy("_src").agg(F.max("_z").alias("_z"), F.first("_rest").alias("_rest")))
        best = stored(best, "closing")
        if best.limit(1).count() == 0:
            return h
        fit = F.least(room, F.floor(F.abs("_rest") / F.col("_z"))).cast("long")
        change = F.when(F.col("_rest") > 0, fit).when(F.col("_rest") < 0, -fit).otherwise(0)
        h = stored(h.join(best, ["_src", "_z"], "left").select(
            "_src", "_z", "_n", "source_size", "target", "rate",
            (F.col("_c") + change).alias("_c")), "copies")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
                weights=WEIGHTS, share: float = SHARE, cap: int = CAP, keep=None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all) with size, source_size, target, rate, copies and taken."""
    keep = others(docs, *_RESULTS, *_INNER) if keep is None else list(keep)
    cell = F.pmod(F.xxhash64(F.col(id_col)), F.lit(CELLS)).alias("_cell")
    cells = stored(sizes(docs.select(id_col, text, source), text, source)
                   .groupBy("_src", "_z", cell).agg(F.count(F.lit(1)).alias("_k")), "cells")
    histogram = stored(cells.groupBy("_src", "_z").agg(F.sum("_k").alias("_n")), "histogram")
    goal = stored(targets(histogram, weights, share, cap), "targets")
    given = _rounded(histogram, goal, tilts(histogram, goal, cap), cap)
    order = Window.partitionBy("_src", "_z").orderBy("_cell")
    place = (cells.withColumn("_off", F.sum("_k").over(order) - F.col("_k")).join(given, ["_src", "_z"])
             .select("_src", "_z", "_cell", "_off", "source_size", "target", "rate",
                     F.floor(F.col("_c") / F.col("_n")).alias("_each"), (F.col("_c") % F.col("_n")).alias("_more")))
    inside = F.row_number().over(Window.partitionBy("_src", "_z", "_cell").orderBy(F.xxhash64(F.col(id_col)), id_col))
    copies = F.col("_each") + F.when(F.col("_off") + inside <= F.col("_more"), 1).otherwise(0)
    rows = sizes(docs.select(*dict.fromkeys([*keep, id_col, text, source])), text, source).withColumn("_cell", cell)
    if text not in keep:
        rows = rows.drop(text)
    return (rows.join(place, ["_src", "_z", "_cell"]).withColumn("copies", copies.cast("int"))
            .select(*keep, F.col("_z").alias("size"), "source_size", "target", "rate", "copies",
                    (F.col("copies") * F.col("_z")).alias("taken")))


def copied(mixed: DataFrame) -> DataFrame:
    """A mix as rows: each document as often as it is taken, with its ``copy_no`` from 1 up."""
    return mixed.where("copies > 0").withColumn("copy_no", F.explode(F.sequence(F.lit(1), "copies")))
