"""Mixing sources to target weights by fitting each source's budget exactly.

Budgets are fitted to counts of documents by length, not to documents: a source
contributes whole passes over its documents, then the same share of every length,
and what is left of the budget is a bounded subset-sum, solved by dynamic
programming over the lengths. Documents of one length are then picked by a seeded hash.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from barhouse.llm.common import ranked, settled, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2
SEED = 17
# The dynamic programme's budget; greedy choices bring the rest below it first.
TABLE_WORDS = 1 << 16


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, passes: float) -> DataFrame:
    """(source, source_size) to (source, source_no, source_size, target).

    Sources stand in code-point order, null last, and take the weights in turn.
    Targets rise together, in proportion to the weights, until they add up to
    ``share`` of all sizes; each stops at ``passes`` times its own size. Resharing the
    excess by weight until none is above ends there. One row per source is looked at in one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), ((F.col("source_no") - 1) % len(weights) + 1).cast("int"))
    listed = sizes.withColumn("source_no", F.row_number().over(by_name)).withColumn("w", w)
    listed = listed.withColumn("stop", passes * F.col("source_size").cast("double"))
    by_stop = Window.orderBy(F.col("stop") / F.col("w"), "source_no")
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_stop.rowsBetween(0, Window.unboundedFollowing)
    everywhere = by_stop.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = share * F.sum("source_size").over(everywhere)
    level = (budget - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum("w").over(rest)
    levels = listed.withColumn("level", level)
    # The first source, by where it stops, that its level doesn't fill sets the level of all from there on.
    fits = F.when(F.col("level") * F.col("w") <= F.col("stop"), F.col("level"))
    common = F.first(fits, ignorenulls=True).over(everywhere)
    target = F.least(F.col("stop"), F.coalesce(common * F.col("w"), F.col("stop")))
    return levels.select("source", "source_no", "source_size", target.alias("target"))


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that the words come as near below ``budget`` as can be found."""
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts
    take = (counts * (budget / total)).astype(np.int64)
    left = budget - int((lengths * take).sum())
    while left < 0:  # the share was rounded up
        k = int(np.argmax(take * (lengths > 0)))
        take[k] -= 1
        left += int(lengths[k])
    for k in np.argsort(-lengths, kind="stable"):
        if left <= TABLE_WORDS:
            break
        if lengths[k] > 0:
            more = min(int(counts[k] - take[k]), (left - TABLE_WORDS // 2) // int(lengths[k]))
            if more > 0:
                take[k] += more
                left -= more * int(lengths[k])
    return take + _subset_sum(lengths, counts - take, left)


def _subset_sum(lengths: np.ndarray, spare: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack over sums 0..budget; counts are split into powers of two.

    ``via`` holds the first item that reached a sum; it came there from a sum that earlier items reach.
    """
    out = np.zeros(len(lengths), np.int64)
    reached = np.zeros(budget + 1, bool)
    reached[0] = True
    via = np.full(budget + 1, -1, np.int64)
    items: list[tuple[int, int]] = []
    for k in np.argsort(lengths, kind="stable"):
        n, length = int(spare[k]), int(lengths[k])
        if length == 0 or length > budget:
            continue
        n = min(n, budget // length)
        part = 1
        while n > 0 and not reached[budget]:
            part = min(part, n)
            step = part * length
            fresh = reached[: budget + 1 - step] & ~reached[step:]
            via[step:][fresh] = len(items)
            reached[step:] |= fresh
            items.append((int(k), part))
            n, part = n - part, part * 2
        if reached[budget]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at:
        k, part = items[via[at]]
        out[k] += part
        at -= part * int(lengths[k])
    return out


def mix(
    docs: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    passes: int = PASSES,
    seed: int = SEED,
    prefix: str = "",
) -> DataFrame:
    """How much of each document (doc_id, text, source) the mix takes.

    Adds size, source_size, target and taken (with ``prefix``) to the ``keep``
    columns. A document is taken whole, none to ``passes`` times. Null texts have size 0
    and are taken 0 words; null sources are one source. Equal documents are told apart by
    nothing, so any of them is picked. An empty table gives no rows.
    """
    s, no = f"{prefix}size", "__mix_no"
    sized = docs.withColumn("__mix_size", word_count(F.col("text")))
    histogram = settled(sized.groupBy("source", "__mix_size").agg(F.count("*").alias("n")).withColumnRenamed("__mix_size", "size"), "lengths")
    sizes = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    sources = settled(source_targets(sizes, weights, share, passes), "sources")
    budgets = histogram.join(sources, histogram["source"].eqNullSafe(sources["source"])).select(
        "source_no", "size", "n", "source_size", "target"
    )

    def fit(source: pd.DataFrame) -> pd.DataFrame:
        source = source.sort_values("size")
        whole, target = int(source["source_size"].iloc[0]), float(source["target"].iloc[0])
        budget = int(np.floor(target + 0.5))
        base = min(budget // whole, passes) if whole else 0
        take = fit_budget(source["size"].to_numpy(), source["n"].to_numpy(), budget - base * whole) if base < passes else 0
        return source[["source_no", "size"]].assign(base=base, take=take)

    fitted = budgets.groupBy("source_no").applyInPandas(fit, "source_no int, size bigint, base bigint, take bigint")
    known = sources.select(F.col("source").alias("__mix_source"), F.col("source_no").alias(no), "source_size", "target")
    known = known.withColumnsRenamed({"source_size": "__mix_whole", "target": "__mix_target"})
    takes = settled(fitted, "takes").select(
        F.col("source_no").alias(no), F.col("size").alias("__mix_size"), F.col("base").alias("__mix_base"), F.col("take").alias("__mix_take")
    )
    rows = sized.select(*keep, *(c for c in ("doc_id", "source") if c not in keep), "__mix_size")
    rows = rows.join(known, F.col("source").eqNullSafe(F.col("__mix_source"))).withColumn("__mix_hash", F.xxhash64(F.lit(seed), "doc_id"))
    order = ["__mix_hash", "doc_id"]
    rows = ranked(rows, [no, "__mix_size"], order, "__mix_rank").join(takes, [no, "__mix_size"])
    times = F.col("__mix_base") + (F.col("__mix_rank") <= F.col("__mix_take")).cast("bigint")
    return rows.select(
        *keep,
        F.col("__mix_size").alias(s),
        F.col("__mix_whole").alias(f"{prefix}source_size"),
        F.col("__mix_target").alias(f"{prefix}target"),
        (times * F.col("__mix_size")).alias(f"{prefix}taken"),
        *([times.alias(f"{prefix}times")] if prefix else []),
    )
