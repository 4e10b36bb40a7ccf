"""Links between items that share hash buckets, confirmed on full sets, without forming all pairs of a bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runweave.llm.components import connected_components
from runweave.llm.store import Workspace

#: Rounds in which each bucket compares its members with one leader before the rest is searched.
LEADER_ROUNDS = 2
#: Buckets of up to so many members are then compared in full; larger ones by the members' differences from a leader.
SMALL = 16


def similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of their sets (item, members without repeats)."""
    left = sets.select(F.col("item").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("item").alias("b"), F.col("members").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    # sort-merge at every size: which side is the smaller depends on the corpus
    return pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").where(
        common * (100 + percent) >= percent * (F.size("x") + F.size("y"))).select("a", "b")


def _pairs_of_small(members: DataFrame, near_size: str) -> DataFrame:
    return members.alias("p").join(members.alias("q"), F.expr(
        f"p.bucket = q.bucket and p.component < q.component and {near_size}")).select(
        F.expr("least(p.item, q.item)").alias("a"), F.expr("greatest(p.item, q.item)").alias("b"))


def _pairs_of_large(work: Workspace, members: DataFrame, sets: DataFrame, percent: int, name: str) -> DataFrame:
    """Pairs of the same large buckets that may be similar, found by what they have in common against their leader.

    Let h be the leader's set, a_u = |h - u|, b_u = |u - h| and s = percent / 100. A link of u and v has at least
    s * (|u| + |v|) / (1 + s), and so s * |u|, elements in common, at most |u| - b_u of them in h.

    - u is far from h if b_u > (1 - s) * |u|. Then u and v share at least b_u - (1 - s) * |u| elements that h lacks. So of
      any sort order, the first (1 - s) * |u| + 1 of these of u must hold one that v has too, and if v is far as well, it
      is among the first of v. Far members need no other rows, and nearly all members of a bucket by a common phrase are far.
    - If neither is far, and v is not linked with the leader, a_v + s * b_v > (1 - s) * |h|. From that follows: u and v reach
      s only if they share more than (a_u + s * b_u) / (1 + s) of the differences of u from h, lost and gained. So the first
      |differences| - that many of u must hold one that v has too. And as the pair must share
      (a_u + a_v + s * (b_u + b_v) - (1 - s) * |h|) / (1 + s) differences, the first one that it shares must have as many
      behind it in the order of either.

    Rarest first, nearly all of them are u's alone. Those are counted, but go no further.
    """
    leaders = members.groupBy("bucket").agg(F.max(F.struct("score", "item")).getField("item").alias("lead"))
    led = work.keep(members.join(leaders, "bucket").select("lead", "item", "component").distinct(), f"{name}-led")
    apart = led.join(sets, "item").join(
        sets.select(F.col("item").alias("lead"), F.col("members").alias("h")), "lead").select(
        "lead", "item", "component", F.array_except("members", "h").alias("gained"), "h", "members")
    n = F.size("members")
    apart = apart.withColumn("far", 100 * F.size("gained") > (100 - percent) * n).withColumn(
        "lost", F.when(~F.col("far"), F.array_except("h", "members")).otherwise(F.array().cast("array<long>")))
    weight = 100 * F.size("lost") + percent * F.size("gained")
    d = F.size("lost") + F.size("gained")
    rows = apart.select(
        "lead", "item", "component", "far", n.alias("n"), (n - F.size("gained")).alias("inside"),
        ((100 - percent) * F.size("h")).alias("spare"), weight.alias("weight"), d.alias("d"),
        F.when(F.col("far"), F.floor((100 - percent) * n / 100) + 1).otherwise(d - F.floor(weight / (100 + percent))).alias("ahead"),
        F.explode(F.concat("lost", "gained")).alias("difference"))
    # leads and differences are told apart by one hash: two under one only make a candidate more
    rows = work.keep(rows.withColumn("mark", F.xxhash64("lead", "difference")).drop("difference"), f"{name}-differences")
    work.drop(f"{name}-led")
    common = rows.groupBy("mark").agg(F.count("*").alias("k")).where("k > 1")
    whole = Window.partitionBy("lead", "item")
    placed = rows.join(common.hint("merge"), "mark").withColumn("alone", F.col("d") - F.count("*").over(whole)).withColumn(
        "at", F.col("alone") + F.row_number().over(whole.orderBy("k", "mark")))
    placed = work.keep(placed.where("not far or at <= ahead").drop("alone", "k"), f"{name}-placed")
    work.drop(f"{name}-differences")
    behind = "1 + least(p.d - p.at, q.d - q.at)"
    return placed.where("at <= ahead").alias("p").join(placed.alias("q"), F.expr(
        "p.mark = q.mark and p.lead = q.lead and p.component <> q.component and "
        f"100 * least(p.n, q.n) >= {percent} * greatest(p.n, q.n) and case when p.far then "
        f"{percent} * (p.n + q.n) <= (100 + {percent}) * ({behind} + least(p.inside, q.inside)) else "
        f"not q.far and q.weight > q.spare and p.weight + q.weight - p.spare <= (100 + {percent}) * ({behind}) end")).select(
        F.expr("least(p.item, q.item)").alias("a"), F.expr("greatest(p.item, q.item)").alias("b"))


def link_buckets(work: Workspace, buckets: DataFrame, sets: DataFrame, percent: int, name: str) -> DataFrame:
    """(item, component) of the items that are linked, directly or by others, to an item in a common bucket.

    buckets: (bucket, item, n, score): n the size of the item's set, score high for items that sit in full buckets.
    sets: (item, members). The result is the same as if all pairs of each bucket had been checked:

    - In a leader round each bucket with members of more than one component compares its members outside the leader's
      component with the leader: rows grow with the bucket, not with its square. First the member with the best score
      leads (the text that most copies resemble), then one drawn by hash.
    - What is then still open is compared in full in small buckets, and by _pairs_of_large in others. Pairs whose sizes
      alone rule a link out are not formed, and no pair is checked twice.
    """
    near_size = "100 * least(p.n, q.n) >= {0} * greatest(p.n, q.n)".format(percent)
    members = buckets.withColumn("component", F.col("item"))
    components, tried, links, open_name, last_name = None, None, None, None, None
    for round_ in range(LEADER_ROUNDS + 1):
        if round_ < LEADER_ROUNDS:
            rank = F.col("score") if round_ == 0 else F.xxhash64("bucket", "item", F.lit(round_))
            other = members.groupBy("bucket").agg(F.max(F.struct(rank.alias("rank"), "item", "n", "component")).alias("lead"))
            other = other.select("bucket", "lead.item", "lead.n", "lead.component")
            pairs = members.alias("p").join(other.alias("q"), F.expr(
                f"p.bucket = q.bucket and p.component <> q.component and {near_size}"))
            pairs = pairs.select(F.expr("least(p.item, q.item)").alias("a"), F.expr("greatest(p.item, q.item)").alias("b"))
        else:
            large = members.groupBy("bucket").agg(F.count("*").alias("k")).where(F.col("k") > SMALL)
            pairs = _pairs_of_small(members.join(large, "bucket", "left_anti"), near_size).union(
                _pairs_of_large(work, members.join(large, "bucket", "left_semi"), sets, percent, name))
        pairs = pairs.distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = work.keep(pairs, f"{name}-pairs-{round_}")
        if f"{name}-placed" in work.names:
            work.drop(f"{name}-placed")
        tried = pairs if tried is None else tried.union(pairs)
        found = work.keep(similar(pairs, sets, percent), f"{name}-links-{round_}")
        if not found.take(1):
            continue
        links = found if links is None else links.union(found)
        components = work.keep(connected_components(work, links, f"{name}-cc-{round_}"), f"{name}-components-{round_}")
        for table in [t for t in work.names if t.startswith(f"{name}-cc-{round_}-") or t == last_name]:
            work.drop(table)
        last_name = f"{name}-components-{round_}"
        if round_ < LEADER_ROUNDS:
            members = members.drop("component").join(components, "item", "left").withColumn(
                "component", F.coalesce("component", "item"))
            open_ = members.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
            members = work.keep(members.join(open_.where("low < high"), "bucket", "left_semi"), f"{name}-open-{round_}")
            if open_name:
                work.drop(open_name)
            open_name = f"{name}-open-{round_}"
    if components is None:
        return buckets.select("item", F.col("item").alias("component")).limit(0)
    return components
