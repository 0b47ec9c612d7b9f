"""Balanced label propagation: linked documents move towards their neighbours' shards under capacity quotas.

Only DataFrame operations run on the main path. The graph is given as memberships (node, hub): nodes that share a hub
are linked, so a group of any size costs one row per member, never a row per pair. Each round is two aggregations and
two joins: hubs count their members by shard, nodes add the counts of their hubs, choose the open shard that holds most
of their neighbours, and move if the (from, to) quota of their size class lets them; opposite demands of two shards are
exchanged also where both are full. Rounds end when nothing wants to move or nothing is gained. Groups that are linked to
no other group are then placed whole, largest first, at home if it has room. Nodes without a link have nothing to gain
anywhere; they fill what room is left at the end, which makes the counts exact.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import discard, staged

K = 8
_UNIT = 1 << 20
_LAST = 64


def _unit(*cols: Column | str) -> Column:
    """A number in [0, _UNIT) that depends on the columns alone."""
    return F.pmod(F.xxhash64(*cols), F.lit(_UNIT))


def _quotas(demand: list, load: list[int], cap: int, k: int) -> dict[tuple[int, int, int], float]:
    """Share of the movers of each (from, to, class) that may go: small classes first, no shard above ``cap``.

    What two shards ask of each other is exchanged, as it changes no load; what is left over shares the free room. At most
    k * k * 64 rows come to the driver, whatever the input. Moves that leave a shard otherwise make room only for later
    rounds, so a quota never depends on another one being used in full.
    """
    asked: dict[tuple[int, int], int] = {}
    for r in demand:
        asked[r["shard"], r["want"]] = asked.get((r["shard"], r["want"]), 0) + r["n"]
    over = {(a, b): n - min(n, asked.get((b, a), 0)) for (a, b), n in asked.items()}
    share: dict[tuple[int, int, int], float] = {}
    for to in range(k):
        left = sum(n for (_, b), n in over.items() if b == to)
        part = min(1.0, max(0, cap - load[to]) / left) if left else 0.0
        for a in range(k):
            may = asked.get((a, to), 0) - over.get((a, to), 0) * (1 - part)
            for r in sorted((r for r in demand if (r["shard"], r["want"]) == (a, to)), key=lambda r: r["cls"]):
                share[a, to, r["cls"]] = min(1.0, may / r["n"])
                may -= min(may, r["n"])
    return share


def propagate(members: DataFrame, k: int = K, cap: int | None = None, rounds: int | None = None) -> DataFrame:
    """(node, shard, cls, hub, hubs) for the nodes of ``members`` (node, hub): where each linked node ends.

    ``cls`` is the binary logarithm of the size of the node's largest hub, ``hubs`` the number of its hubs with other
    members. Without ``rounds`` it goes on until no node wants to move or a round gains no neighbour. Repeated memberships count once. An empty
    table gives an empty result. Hubs with a third of all rows are pre-aggregated per task before any shuffle; their
    counts come back by a join that adaptive execution may split.
    """
    spark = members.sparkSession
    edges = staged(members.select("node", "hub").distinct(), "shard-edges")
    sizes = edges.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    nodes = edges.join(sizes, "hub").groupBy("node").agg(F.max("n").alias("n"), F.max_by("hub", F.struct("n", "hub")).alias("hub"), F.count(F.lit(1)).alias("hubs"))
    state = nodes.select("node", "hub", "hubs", F.floor(F.log2("n")).cast("int").alias("cls"), F.pmod(F.xxhash64("hub", F.lit(1)), F.lit(k)).cast("int").alias("shard0"), F.pmod(F.xxhash64("node"), F.lit(k)).cast("int").alias("shard"))
    state = staged(state.drop("shard0"), "shard-state")
    total = state.count()
    cap = total if cap is None else cap
    last = -1
    for step in itertools.count() if rounds is None else range(rounds):
        load = [0] * k
        for r in state.groupBy("shard").count().collect():  # k rows
            load[r["shard"]] = r["count"]
        # by hub: members in each shard; by node: neighbours in each shard
        by_hub = edges.join(state.select("node", "shard"), "node").groupBy("hub").agg(*[F.count_if(F.col("shard") == s).alias(f"c{s}") for s in range(k)])
        seen = edges.join(by_hub, "hub").groupBy("node").agg(*[F.sum(f"c{s}").alias(f"c{s}") for s in range(k)])
        pull = state.join(seen, "node")
        # most neighbours first; ties go to the shard that the hub itself prefers in this round, so all members agree
        prefers = lambda s: F.pmod(F.xxhash64("hub", s, F.lit(step)), F.lit(1 << 30))  # noqa: B023, E731  used in this round alone
        options = [F.struct(F.col(f"c{s}").alias("c"), prefers(F.lit(s)).alias("tie"), F.lit(s).alias("s")) for s in range(k)]
        best = F.greatest(*options) if len(options) > 1 else options[0]
        own = F.element_at(F.array(*[F.col(f"c{s}") for s in range(k)]), F.col("shard") + 1)
        moves = pull.select("node", "hub", "hubs", "cls", "shard", best.alias("best"), own.alias("own"), prefers(F.col("shard")).alias("tie"))
        better = (F.col("best.s") != F.col("shard")) & ((F.col("best.c") > F.col("own")) | ((F.col("best.c") == F.col("own")) & (F.col("best.tie") > F.col("tie"))))
        moves = staged(moves.select("node", "hub", "hubs", "cls", "shard", "own", F.when(better, F.col("best.s")).alias("want")), "shard-moves")
        demand = moves.groupBy("shard", "want", "cls").agg(F.count(F.lit(1)).alias("n"), F.sum("own").alias("own")).collect()  # <= k*(k+1)*64 rows
        near = sum(r["own"] for r in demand)
        demand = [r for r in demand if r["want"] is not None]
        if not demand or near <= last:
            discard(moves)
            break
        last = near
        share = _quotas(demand, load, cap, k)
        rows = [(a, b, c, int(p * _UNIT)) for (a, b, c), p in share.items()]
        quota = spark.createDataFrame(rows, "shard int, want int, cls int, upto long")
        # whole hubs go or stay where the hub is small against the quota; members of a large hub are drawn one by one
        draw = F.when(F.col("cls") >= int(math.log2(max(2, cap))) - 4, _unit("node", F.lit(step))).otherwise(_unit("hub", F.lit(step)))
        old = state
        moved = moves.join(F.broadcast(quota), ["shard", "want", "cls"], "left")  # at most k*k*64 rows
        state = staged(moved.select("node", "hub", "hubs", "cls", F.when(draw < F.col("upto"), F.col("want")).otherwise(F.col("shard")).alias("shard")), "shard-state")
        discard(old, moves)
    discard(edges)
    return state


def _packed(sizes: list, room: list[int]) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """(home, n, [(first rank not taken, shard)]) for rows (home, n, groups): whole groups, largest first.

    Groups stay at home while it has room for them, then go where most room is; what no shard can take whole is left out.
    """
    room, out = list(room), []
    for n in sorted({r["n"] for r in sizes}, reverse=True):
        same = [r for r in sizes if r["n"] == n]
        taken = {}
        for r in same:
            taken[r["home"]] = [(min(r["groups"], room[r["home"]] // n), r["home"])]
            room[r["home"]] -= taken[r["home"]][0][0] * n
        for r in same:
            cuts = taken[r["home"]]
            for s in sorted(range(len(room)), key=lambda s: -room[s]):
                if more := min(r["groups"] - cuts[-1][0], room[s] // n):
                    cuts.append((cuts[-1][0] + more, s))
                    room[s] -= more * n
            out.append((r["home"], n, cuts))
    return out


def _whole(state: DataFrame, target: list[int], k: int) -> tuple[DataFrame, list[DataFrame]]:
    """``state`` with each group that is linked to no other one in one shard, within ``target``.

    A group is cut only where it is larger than a shard or, when its turn comes, no shard has as many places left; its
    nodes then rank behind all others. Sizes come to the driver as one row per home and size: with n nodes there are
    at most about sqrt(2 n) sizes.
    """
    spark = state.sparkSession
    by_hub = state.groupBy("hub").agg(F.count(F.lit(1)).alias("n"), F.max("hubs").alias("hubs"), *[F.count_if(F.col("shard") == s).alias(f"c{s}") for s in range(k)])
    most = F.greatest(*[F.struct(F.col(f"c{s}").alias("c"), F.lit(s).alias("s")) for s in range(k)]) if k > 1 else F.struct(F.lit(0).alias("s"))
    groups = staged(by_hub.select("hub", "n", "hubs", most["s"].alias("home"), *[f"c{s}" for s in range(k)]), "shard-groups")
    tied = groups.where("hubs > 1").agg(*[F.sum(f"c{s}") for s in range(k)]).first()  # one row
    room = [max(0, t - (x or 0)) for t, x in zip(target, tied)]
    lone = groups.where("hubs = 1")
    sizes = lone.groupBy("home", "n").agg(F.count(F.lit(1)).alias("groups")).collect()  # <= k * sqrt(2 n) rows
    plan = spark.createDataFrame(_packed(sizes, room), "home int, n long, cuts array<struct<upto:long,shard:int>>")
    wide = max(64, math.isqrt(sum(r["groups"] for r in sizes)))
    ranked = _ranks(lone.select(F.col("hub").alias("node"), F.struct("home", "n").alias("part"), F.pmod(F.xxhash64("hub"), F.lit(wide)).alias("bin")), ["bin"])
    ranked = ranked.select(F.col("node").alias("hub"), "part.home", "part.n", "rank").join(F.broadcast(plan), ["home", "n"])  # at most k * sqrt(2 n) rows
    put = F.get(F.filter("cuts", lambda c: F.col("rank") < c["upto"]), F.lit(0))["shard"]
    settled = staged(ranked.select("hub", put.alias("put"), put.isNull().alias("cut")), "shard-settled")
    cls = F.when(F.col("cut"), F.lit(_LAST)).otherwise(F.col("cls"))
    return state.join(settled, "hub", "left").select("node", F.coalesce("put", "shard").alias("shard"), cls.alias("cls"), "hub"), [state, groups, settled]


def balanced_shards(nodes: DataFrame, members: DataFrame, k: int = K, rounds: int | None = None) -> DataFrame:
    """(node, shard, slot): every node of ``nodes`` (node) in one of k shards, counts at most one apart.

    Linked nodes keep the shard that ``propagate`` and ``_whole`` gave them while it has room; the rest and all unlinked nodes take the
    free slots. Slots are gapless from 0 in each shard. Ranks come from counts of about sqrt(n) buckets, so no task
    sorts more than about sqrt(n) rows of a shard and nothing is collected but k sums. Ties are broken by node.
    """
    total = nodes.count()
    target = [total // k + (s < total % k) for s in range(k)]
    state, used = _whole(propagate(members, k, max(1, min(target)) if total else 1, rounds), target, k)
    wide = max(64, math.isqrt(total))
    placed = nodes.join(state.select("node", "shard", "cls", "hub"), "node", "left")
    placed = staged(placed.select("node", F.coalesce("shard", F.lit(k)).alias("part"), F.coalesce("cls", F.lit(0)).alias("cls"), F.pmod(F.xxhash64(F.coalesce(F.col("hub").cast("string"), F.lit("")), F.when(F.col("hub").isNull() | (F.col("cls") > 8), F.col("node"))), F.lit(wide)).alias("bin")), "shard-placed")
    discard(*used)
    ranked = _ranks(placed, ["cls", "bin"])
    held = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}  # k + 1 rows
    kept = [min(held.get(s, 0), target[s]) for s in range(k)]
    limit = F.element_at(F.array(*[F.lit(x) for x in kept], F.lit(0)), F.col("part") + 1)
    # what found no room joins the unlinked nodes: one line of them, cut at the shards' free slots
    line, at = [], held.get(k, 0)
    for s in range(k):
        line.append(at - kept[s])
        at += held.get(s, 0) - kept[s]
    shift = F.element_at(F.array(*[F.lit(x) for x in line], F.lit(0)), F.col("part") + 1)
    free = [target[s] - kept[s] for s in range(k)]
    ends = [sum(free[: s + 1]) for s in range(k)]
    q = F.col("queue")
    to = F.lit(k - 1)
    first = F.lit(ends[k - 1] - free[k - 1] - kept[k - 1])
    for s in range(k - 2, -1, -1):
        to = F.when(q < ends[s], F.lit(s)).otherwise(to)
        first = F.when(q < ends[s], F.lit(ends[s] - free[s] - kept[s])).otherwise(first)
    out = ranked.select("node", "part", "rank", F.when(F.col("rank") >= limit, F.col("rank") + shift).alias("queue"))
    out = out.select("node", F.when(q.isNull(), F.col("part")).otherwise(to).cast("int").alias("shard"), F.when(q.isNull(), F.col("rank")).otherwise(q - first).cast("long").alias("slot"))
    out.staged_at = placed.staged_at
    return out


def _ranks(df: DataFrame, by: list[str]) -> DataFrame:
    """``rank`` from 0 within ``part`` by ``by`` and node: offsets of the bins, then row numbers inside a bin."""
    bins = df.groupBy("part", *by).agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("part").orderBy(*by).rowsBetween(W.unboundedPreceding, -1)
    offsets = bins.select("part", *by, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = W.partitionBy("part", *by).orderBy("node")
    return df.join(offsets, ["part", *by]).select(df["*"], (F.col("before") + F.row_number().over(inside) - 1).alias("rank"))


def shard_documents(docs: DataFrame, k: int = K, rounds: int | None = None) -> DataFrame:
    """Documents in k shards by the ``rows`` law; documents of equal text are linked.

    Null text counts as empty, and empty texts are equal to each other. Every row is a node, also one that repeats
    another row or its doc_id, or has no doc_id; where ids repeat or are null, rows get a number of their own, so that no task
    holds all rows of one id. Ties are broken by node.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text, 256).alias("hub"))
    rows = rows.withColumn("copy", F.lit(0).cast("long") if _unique(docs) else F.monotonically_increasing_id())
    rows = staged(rows.select(F.struct("doc_id", "copy").alias("node"), "size", "text_crc32", "hub"), "shard-docs")
    placed = balanced_shards(rows.select("node"), rows.select("node", F.unhex("hub").alias("hub")), k, rounds)
    out = rows.join(placed, "node").select("node.doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
    out = staged(out, "shard-rows")
    discard(rows, placed)
    return out


def _unique(docs: DataFrame) -> bool:
    n, known = docs.select("doc_id").groupBy("doc_id").count().agg(F.max("count"), F.count(F.lit(1))).first()
    return (n or 0) <= 1
