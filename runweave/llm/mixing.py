"""Mixing sources to target weights: iterative proportional fitting of token weights, then a calibrated sample.

DataFrame functions only. Cells are the combinations of source, language and topic that occur; their token weights are
raked to the target shares of each dimension in turn until all shares fit. Documents are then kept with a probability
in proportion to their cell's raked weight over its tokens, drawn by a hash of the id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runweave.llm.store import Workspace

DIMENSIONS = ("source", "lang", "topic")
#: The level that a null source, language or topic counts as.
NONE = "(none)"
WHITE = r"[\x20\x09-\x0D]+"


def topic_of(text: Column) -> Column:
    """A coarse topic by marks in the text: table, legal, contact or prose."""
    text = F.coalesce(text, F.lit(""))
    return (F.when(F.contains(text, F.lit(" | ")), "table")
            .when(F.rlike(text, F.lit("[Ll]icensed? |rights reserved")), "legal")
            .when(F.contains(text, F.lit("@")), "contact").otherwise("prose"))


def tokens_of(text: Column) -> Column:
    """Words of the text, the unit of the weights."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")).cast("long")


def with_levels(docs: DataFrame) -> DataFrame:
    """`docs` with the columns _source, _lang and _topic, never null."""
    level = lambda c: F.coalesce(c.cast("string"), F.lit(NONE))
    return docs.withColumns({"_source": level(F.col("source")), "_lang": level(F.col("lang")),
                             "_topic": topic_of(F.col("text"))})


def cells_of(docs: DataFrame) -> DataFrame:
    """(source, lang, topic, tokens) of the cells that hold a token; partial sums, so a hot source is a few rows."""
    rows = with_levels(docs).select(*(F.col(f"_{d}").alias(d) for d in DIMENSIONS), tokens_of(F.col("text")).alias("tokens"))
    return rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """(level, share): the dimension's shares of tokens raised to `power` and made to sum to one again."""
    raised = cells.groupBy(F.col(dimension).alias("level")).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("r"))
    total = raised.agg(F.sum("r")).first()[0] or 1.0
    return raised.select("level", (F.col("r") / F.lit(total)).alias("share"))


def rake(work: Workspace, cells: DataFrame, targets: dict[str, DataFrame], rounds: int = 30,
         tolerance: float = 1e-9) -> DataFrame:
    """`cells` with a column weight whose sums over each dimension meet the target shares (level, share).

    A level without a target gets no weight. Ends when no share is off by more than `tolerance`, or after `rounds`
    (targets that no weights can meet all at once are met as the last dimension in order has it).
    """
    raked = work.keep(cells.withColumn("weight", F.col("tokens").cast("double")), "raked-0")
    for k in range(1, rounds + 1):
        off = []
        for dimension, target in targets.items():
            sums = raked.groupBy(dimension).agg(F.sum("weight").alias("now"))
            sums = sums.join(target.select(F.col("level").alias(dimension), "share"), dimension, "left").select(
                dimension, "now", F.coalesce("share", F.lit(0.0)).alias("share"))
            raked = raked.join(sums, dimension).withColumn(
                "weight", F.when(F.col("now") > 0, F.col("weight") * F.col("share") / F.col("now")).otherwise(0.0))
            off.append(F.abs(F.col("now") - F.col("share")))
            raked = raked.withColumn("off", F.greatest(F.coalesce(F.col("off"), F.lit(0.0)) if len(off) > 1 else F.lit(0.0), off[-1]))
            raked = raked.drop("now", "share")
        raked = work.keep(raked, f"raked-{k}")
        work.drop(f"raked-{k - 1}")
        worst = raked.agg(F.max("off")).first()[0]
        raked = raked.drop("off")
        if worst is None or worst <= tolerance:
            break
    return raked


def _amounts(work: Workspace, cells: DataFrame, dimension: str, target: DataFrame, budget: float) -> DataFrame:
    """(level, amount): the tokens that each level is to give, `budget` together as far as there are that many.

    In proportion to the target shares, but no level more than it holds; what a scarce one lacks the others share.
    """
    held = cells.groupBy(F.col(dimension).alias("level")).agg(F.sum("tokens").cast("double").alias("held"))
    levels = work.keep(held.join(target.hint("merge"), "level").where("share > 0"), f"levels-{dimension}")
    scale, scarce = budget, -1
    while True:
        full = F.col("share") * F.lit(scale) >= F.col("held")
        row = levels.agg(F.count_if(full).alias("n"), F.sum(F.when(full, F.col("held"))).alias("given"),
                         F.sum(F.when(~full, F.col("share"))).alias("open")).first()
        if row.n == scarce or not row.open:
            break
        scarce, scale = row.n, (budget - (row.given or 0.0)) / row.open
    return levels.select("level", F.least(F.col("share") * F.lit(scale), F.col("held")).alias("amount")
                         if row.open else F.col("held").alias("amount"))


def within_budget(work: Workspace, cells: DataFrame, targets: dict[str, DataFrame], kept_share: float, rounds: int = 40,
                  tolerance: float = 1e-6) -> DataFrame:
    """(source, lang, topic, tokens, _p): probabilities that keep `kept_share` of the tokens, with the target shares.

    One raking loop with bounds: a cell's weight is a product of one factor for each of its levels, its probability is
    the weight cut to 1, and a factor is put right by what the cut cells give. So cells that would have to give more
    than they hold are kept whole, and a stray scarce cell takes nothing from the others (_amounts). Ends when no level
    is off by more than `tolerance` of the budget, or after `rounds`: if the targets can't be met all at once, the last
    dimension's are. Joins are by merging, so the driver holds no side of any.
    """
    budget = kept_share * (cells.agg(F.sum("tokens")).first()[0] or 0)
    amounts = {d: work.keep(_amounts(work, cells, d, target, budget), f"amounts-{d}") for d, target in targets.items()}
    given = F.col("tokens") * F.least(F.col("weight"), F.lit(1.0))
    raked = cells.withColumn("weight", F.lit(float(kept_share)))
    for d, wanted in amounts.items():
        wanted = wanted.select(F.col("level").alias(d), F.col("amount").alias(f"amount_{d}"))
        raked = raked.join(wanted.hint("merge"), d, "left").na.fill(0.0, [f"amount_{d}"])
    raked, held = work.keep(raked, "weights-0"), "weights-0"
    for k in range(1, rounds + 1):
        raked = raked.withColumn("off", F.lit(0.0))
        for d in amounts:
            # written at each step: a plan over all dimensions would hold each step twice for the next one
            now = raked.groupBy(d).agg(F.sum(given).alias("now"))
            raked = raked.join(now.hint("merge"), d).withColumns({
                "weight": F.when(F.col("now") > 0, F.col("weight") * F.col(f"amount_{d}") / F.col("now")).otherwise(0.0),
                "off": F.greatest("off", F.abs(F.col("now") - F.col(f"amount_{d}")))}).drop("now")
            raked = work.keep(raked, f"weights-{k}-{d}")
            work.drop(held)
            held = f"weights-{k}-{d}"
        worst = raked.agg(F.max("off")).first()[0]
        raked = raked.drop("off")
        if worst is None or worst <= tolerance * budget:
            break
    raked = raked.drop(*(f"amount_{d}" for d in amounts))
    return raked.withColumn("_p", F.least(F.col("weight"), F.lit(1.0))).drop("weight")


def draw(doc_id: Column) -> Column:
    """A number from 0 to below 1 that depends on the id alone; a null id counts as empty text."""
    digest = F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)


def mixed(docs: DataFrame, targets: dict[str, DataFrame] | None = None, power: float = 0.5,
          kept_share: float | None = None) -> DataFrame:
    """`docs` with the columns topic, keep_probability and kept added (equal names are replaced).

    `targets`: for each dimension a table (level, share); left out, tempered shares of the tokens that there are. The
    cell that is scarcest against its target keeps all of its documents, the others in proportion, so the kept tokens
    have the target shares in expectation. With `kept_share` (above 0, up to 1) that share of the tokens is kept in
    expectation instead, and cells too scarce for their targets are kept whole (within_budget).

    - Null sources and languages are the level (none); null and blank texts have no tokens. Cells without tokens, and
      levels without a target, have probability 0.
    - Repeated ids are drawn alike; an empty table gives an empty result.
    """
    work = Workspace(docs.sparkSession, "mixing")
    cells = work.keep(cells_of(docs), "cells")
    targets = targets or {d: work.keep(tempered(cells, d, power), f"target-{d}") for d in DIMENSIONS}
    if kept_share is None:
        raked = rake(work, cells, targets).withColumn("ratio", F.col("weight") / F.col("tokens"))
        most = raked.agg(F.max("ratio")).first()[0] or 1.0
        kept = raked.withColumn("_p", F.col("ratio") / F.lit(most))
    else:
        kept = within_budget(work, cells, targets, kept_share)
    kept = kept.select(*(F.col(d).alias(f"_{d}") for d in DIMENSIONS), "_p")
    rows = with_levels(docs).join(kept, [f"_{d}" for d in DIMENSIONS], "left")
    rows = rows.withColumns({"topic": F.col("_topic"), "keep_probability": F.coalesce("_p", F.lit(0.0))})
    rows = rows.withColumn("kept", draw(F.col("doc_id")) < F.col("keep_probability"))
    return rows.drop(*(f"_{d}" for d in DIMENSIONS), "_p")
