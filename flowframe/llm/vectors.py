"""Near-duplicate vectors by an epsilon grid order join.

Vectors of length 1 have a cosine of at least ``threshold`` exactly if they lie within eps = sqrt(2 - 2 * threshold). They
are sorted by the grid cells, eps wide, of their leading principal coordinates, and cut into tiles of equal size. Intervals
of the sequence are joined recursively: two intervals whose boxes are further apart than eps are skipped, two that lie in one
ball of that diameter are linked as a whole, all others are split. Down to tiles the recursion is a join of small tables of
intervals; pairs of tiles that stay open go to tasks with their vectors, and are split further there. Of small intervals,
pairs whose leading coordinates and lengths of the rest already forbid the link are left out, and all others are compared.

Equal vectors are one from the start. No links are kept: a pair of tiles tells each vector how many others it links with, and
one edge of a spanning forest for each.
"""

from __future__ import annotations

import math
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import _arrow, discard, staged, tidy
from .components import components

THRESHOLD = 0.9
#: Vectors of a tile, intervals that make one of the next level, and vectors that are compared at once.
TILE, FAN, LEAF = 8192, 16, 512
#: Coordinates that make a grid cell, and those that bound a pair.
CELLS, LEAD = 8, 24
#: Vectors that the principal directions are fitted on; they set the order and the speed, never the result.
FIT = 1 << 16
_SLACK = 1e-9


def packed(rows: DataFrame, vector: str) -> DataFrame:
    """(row, vec_id, dim, vec, key): the bytes of each vector and a digest of 128 bits.

    All three are null for a vector that is null, zero, empty, or holds a null or a number that is not finite.
    """
    out = pa.schema([("row", pa.int64()), ("vec_id", pa.int64()), ("dim", pa.int32()), ("vec", pa.binary()), ("key", pa.binary())])

    def run(batches):
        for batch in batches:
            col = batch.column(2)
            dims, vecs, keys = [], [], []
            for v in col:
                a = v.values
                ok = a is not None and len(a) > 0 and not a.null_count
                x = a.to_numpy() if ok else None
                ok = ok and bool(np.isfinite(x).all()) and bool(x.any())
                raw = x.tobytes() if ok else None
                dims.append(len(x) if ok else None)
                vecs.append(raw)
                keys.append(blake2b(raw, digest_size=16).digest() if ok else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, out.field(i + 2).type) for i, c in enumerate((dims, vecs, keys))]], schema=out)

    return rows.select("row", "vec_id", vector).mapInArrow(tidy(run), "row long, vec_id long, dim int, vec binary, key binary")


def unit(vecs: list[bytes], kind: str) -> np.ndarray:
    """Vectors of one dimension as rows of length 1, in double precision; scaled first, so that no square overflows."""
    x = np.frombuffer(b"".join(vecs), kind).reshape(len(vecs), -1).astype(float)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _led(x: np.ndarray, turn: np.ndarray | None, lead: int) -> np.ndarray:
    """Leading coordinates and the length of the rest: distances between such rows never exceed the true ones."""
    y = x @ turn if turn is not None and turn.shape[0] == x.shape[1] else x[:, :lead]
    rest = np.sqrt(np.maximum(0.0, 1.0 - (y * y).sum(axis=1)))
    if y.shape[1] < lead:
        y = np.pad(y, ((0, 0), (0, lead - y.shape[1])))
    return np.column_stack([y, rest])


def fitted(reps: DataFrame, dim: int, n: int, kind: str, lead: int, rows: int = FIT) -> np.ndarray:
    """The leading principal directions (dim, lead) of a random sample of at most about ``rows`` vectors of ``dim``."""

    def run(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            if batch.num_rows:
                x = unit(batch.column(0).to_pylist(), kind)
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["sum"])

    some = reps.where(F.col("dim") == dim).select("vec").sample(min(1.0, rows / max(1, n)), seed=1)
    total = np.zeros((dim, dim))
    for r in some.repartition(8).mapInArrow(tidy(run), "sum binary").collect():  # eight sums, whatever the input
        total += np.frombuffer(r["sum"]).reshape(dim, dim)
    return np.linalg.eigh(total)[1][:, ::-1][:, :lead].copy()


def ordered(reps: DataFrame, turn: np.ndarray | None, kind: str, eps: float, lead: int, cells: int, tile: int) -> DataFrame:
    """(tile, at, rep, mult, dim, vec): reps in epsilon grid order, ``tile`` of them in each tile; ties by rep."""

    def run(batches):
        for batch in batches:
            dims = batch.column(2).to_numpy()
            at = np.empty((batch.num_rows, cells), np.int32)
            for d in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == d)
                y = _led(unit(batch.column(3).take(pa.array(rows)).to_pylist(), kind), turn, lead)[:, :cells]
                at[rows, : y.shape[1]] = np.floor(y / eps)
                at[rows, y.shape[1] :] = 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.FixedSizeListArray.from_arrays(pa.array(at.ravel()), cells).cast(pa.list_(pa.int32()))], ["rep", "mult", "dim", "vec", "cell"])

    grid = reps.select("rep", "mult", "dim", "vec").mapInArrow(tidy(run), "rep long, mult long, dim int, vec binary, cell array<int>")
    parts = max(1, int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    line = grid.repartitionByRange(parts, "dim", "cell", "rep").sortWithinPartitions("dim", "cell", "rep")
    line = staged(line.drop("cell").withColumn("at", F.monotonically_increasing_id()), "vectors-line")
    part, own = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    n = line.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = n.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))  # a row for each partition
    placed = line.withColumn("part", part).join(F.broadcast(before), "part").withColumn("at", F.col("before") + own)
    out = placed.select(F.floor(F.col("at") / tile).cast("long").alias("tile"), "at", "rep", "mult", "dim", "vec")
    out.staged_at = line.staged_at
    return out


def tiles(line: DataFrame, turn: np.ndarray | None, kind: str, lead: int) -> DataFrame:
    """One row a tile: its box, its ball, its weight, and its vectors in order."""
    schema = "id long, n long, weight long, first long, lo array<double>, hi array<double>, centre array<double>, radius double, dims array<int>, reps array<long>, mults array<long>, vecs array<binary>"
    out = pa.schema(_arrow(line.sparkSession, schema))

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by("at")
        dims = t["dim"].to_numpy()
        x = [unit(t["vec"].take(pa.array(np.flatnonzero(dims == d))).to_pylist(), kind) for d in np.unique(dims)]
        # vectors of two dimensions lie further apart than any two of one
        y = np.concatenate([np.column_stack([np.full(len(a), 4.0 * a.shape[1]), _led(a, turn, lead)]) for a in x])
        centre = x[0].mean(axis=0)
        radius = float(np.sqrt(((x[0] - centre) ** 2).sum(axis=1).max())) if len(x) == 1 else math.inf
        one = [t["tile"][0].as_py(), len(t), pc.sum(t["mult"]).as_py(), t["rep"][0].as_py(), y.min(axis=0).tolist(), y.max(axis=0).tolist(), centre.tolist(), radius]
        cols = [*one, *[t[c].to_pylist() for c in ("dim", "rep", "mult", "vec")]]
        return pa.Table.from_arrays([pa.array([c], f.type) for c, f in zip(cols, out)], schema=out)

    return line.groupBy("tile").applyInArrow(pack, schema)


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, v: s + v)


def _gap(a: str, b: str) -> Column:
    """Squared distance between two boxes."""
    less = lambda x, y: F.zip_with(F.col(x), F.col(y), lambda p, q: p - q)
    return _sum(F.zip_with(less(f"{a}.lo", f"{b}.hi"), less(f"{b}.lo", f"{a}.hi"), lambda p, q: F.pow(F.greatest(p, q, F.lit(0.0)), F.lit(2.0))))


def _reach(a: str, b: str) -> Column:
    """No two vectors of the two balls are further apart."""
    apart = F.sqrt(_sum(F.zip_with(F.col(f"{a}.centre"), F.col(f"{b}.centre"), lambda p, q: F.pow(p - q, F.lit(2.0)))))
    return apart + F.col(f"{a}.radius") + F.col(f"{b}.radius")


def _parents(nodes: DataFrame, fan: int) -> DataFrame:
    """Intervals of ``fan`` neighbours each, with a box and a ball around theirs."""
    each = lambda a, of: F.transform(F.sequence(F.lit(0), F.size(F.get(a, F.lit(0))) - 1), lambda i: of(F.transform(a, lambda v: F.get(v, i))))
    g = nodes.groupBy(F.floor(F.col("id") / fan).cast("long").alias("id")).agg(F.sum("n").alias("n"), F.sum("weight").alias("weight"), F.min_by("first", "id").alias("first"), F.collect_list(F.struct("lo", "hi", "centre", "radius")).alias("c"))
    mean = each(F.col("c.centre"), lambda v: _sum(v) / F.size(v))
    g = g.select("id", "n", "weight", "first", each(F.col("c.lo"), F.array_min).alias("lo"), each(F.col("c.hi"), F.array_max).alias("hi"), mean.alias("centre"), "c")
    # a null distance means vectors of several dimensions, which share no ball
    far = F.transform("c", lambda c: F.coalesce(F.sqrt(_sum(F.zip_with(c["centre"], F.col("centre"), lambda p, q: F.pow(p - q, F.lit(2.0))))) + c["radius"], F.lit(math.inf)))
    return g.withColumn("radius", F.array_max(far)).drop("c")


def open_pairs(nodes: DataFrame, eps: float, fan: int) -> tuple[DataFrame, list[tuple[int, DataFrame]], list[DataFrame]]:
    """Pairs (a, b) of tiles, a <= b, that have to be compared, (level, pairs) that are linked as a whole, and the tables
    that these are read from. Intervals that are provably distant are never split."""
    levels = [nodes]
    counts = [nodes.count()]
    while counts[-1] > fan:
        levels.append(staged(_parents(levels[-1], fan), "vectors-nodes"))
        counts.append(-(-counts[-1] // fan))
    pairs = levels[-1].select(F.col("id").alias("a"), F.explode(F.sequence(F.col("id"), F.lit(max(0, counts[-1] - 1)).cast("long"))).alias("b"))
    whole, kept = [], []
    for level in range(len(levels) - 1, -1, -1):
        node = lambda name: levels[level].select(F.col("id").alias(name), F.struct("lo", "hi", "centre", "radius", "weight", "first").alias(f"n{name}"))  # noqa: E731, B023
        both = pairs.join(node("a"), "a").join(node("b"), "b").where(_gap("na", "nb") <= eps * eps + _SLACK)
        near = F.coalesce(_reach("na", "nb") <= eps - _SLACK, F.lit(False))
        both = both.select("a", "b", near.alias("near"), *[F.col(f"n{x}.{c}").alias(f"{c}_{x}") for x in "ab" for c in ("weight", "first")])
        kept.append(staged(both, "vectors-pairs"))
        whole.append((level, kept[-1].where("near")))
        pairs = kept[-1].where("not near").select("a", "b")
        if level:
            child = lambda x: F.explode(F.sequence(F.col(x) * fan, F.least(F.col(x) * fan + fan - 1, F.lit(counts[level - 1] - 1).cast("long")))).alias(x)  # noqa: E731, B023
            pairs = pairs.select(child("a"), "b").select("a", child("b")).where("a <= b")
    return pairs, whole, levels[1:] + kept


class Side:
    """The vectors of one dimension of a tile, with boxes and balls of its intervals."""

    def __init__(self, vecs: list[bytes], mult: list[int], kind: str, turn: np.ndarray | None, lead: int):
        self.x = unit(vecs, kind)
        self.y = _led(self.x, turn, lead)
        self.mult = np.array(mult, np.int64)
        self.seen: dict[tuple[int, int], tuple] = {}

    def around(self, a: int, b: int):
        if (a, b) not in self.seen:
            x, y = self.x[a:b], self.y[a:b]
            centre = x.mean(axis=0)
            self.seen[a, b] = y.min(axis=0), y.max(axis=0), centre, math.sqrt(((x - centre) ** 2).sum(axis=1).max())
        return self.seen[a, b]


def _cosine(p: np.ndarray, q: np.ndarray) -> float:
    """Cosine by plain sums from left to right, for pairs within rounding of the threshold."""
    dot = pp = qq = 0.0
    for a, b in zip(p.tolist(), q.tolist()):
        dot, pp, qq = dot + a * b, pp + a * a, qq + b * b
    return dot / math.sqrt(pp * qq)


class Links:
    """Counts and a spanning forest over the vectors of two sides; the second one's come behind the first one's."""

    def __init__(self, n: int):
        self.count, self.label = np.zeros(n, np.int64), np.arange(n)

    def unite(self, i: np.ndarray, j: np.ndarray) -> None:
        a, b = self.label[i], self.label[j]
        cross = a != b
        if not cross.any():
            return
        top: dict[int, int] = {}

        def find(v):
            while top.setdefault(v, v) != v:
                top[v] = top[top[v]]
                v = top[v]
            return v

        for p, q in np.unique(np.stack([a[cross], b[cross]]), axis=1).T.tolist():
            p, q = find(p), find(q)
            if p != q:
                top[max(p, q)] = min(p, q)
        change = np.arange(len(self.label))
        for v in list(top):
            change[v] = find(v)
        self.label = change[self.label]


def join_sides(one: Side, two: Side, same: bool, threshold: float, links: Links, base: int, leaf: int = LEAF) -> None:
    """All links between two sides, or within one, into ``links``; the second side's vectors are numbered from ``base``."""
    eps = math.sqrt(max(0.0, 2 - 2 * threshold))
    stack = [(0, len(one.x), 0, len(two.x))]
    while stack:
        a, b, c, d = stack.pop()
        if a >= b or c >= d or (same and c < a):
            continue
        alike = same and a == c
        lo, hi, mid, r = one.around(a, b)
        lo2, hi2, mid2, r2 = two.around(c, d)
        gap = np.maximum(0.0, np.maximum(lo - hi2, lo2 - hi))
        if gap @ gap > eps * eps + _SLACK:
            continue
        if math.sqrt(((mid - mid2) ** 2).sum()) + r + r2 <= eps - _SLACK:
            links.count[a:b] += two.mult[c:d].sum()
            if alike:
                links.count[a:b] -= one.mult[a:b]
            else:
                links.count[base + c : base + d] += one.mult[a:b].sum()
            links.unite(np.arange(a, b), np.full(b - a, base + c))
            links.unite(np.full(d - c, a), np.arange(base + c, base + d))
            continue
        if b - a > leaf or d - c > leaf:
            m, n = (a + b) // 2, (c + d) // 2
            if alike:
                stack += [(a, m, a, m), (a, m, m, b), (m, b, m, b)]
            elif b - a >= d - c:
                stack += [(a, m, c, d), (m, b, c, d)]
            else:
                stack += [(a, b, c, n), (a, b, n, d)]
            continue
        i, j = np.nonzero(one.y[a:b] @ two.y[c:d].T >= threshold - _SLACK)
        if alike:
            i, j = i[i < j], j[i < j]
        if not len(i):
            continue
        if 16 * len(i) > (b - a) * (d - c):
            cos = (one.x[a:b] @ two.x[c:d].T)[i, j]
        else:
            cos = np.concatenate([np.einsum("ij,ij->i", one.x[a + i[k : k + 4096]], two.x[c + j[k : k + 4096]]) for k in range(0, len(i), 4096)])
        hit = cos >= threshold
        for k in np.flatnonzero(np.abs(cos - threshold) < 1e-12):
            hit[k] = _cosine(one.x[a + i[k]], two.x[c + j[k]]) >= threshold
        i, j = a + i[hit], c + j[hit]
        if len(i):
            np.add.at(links.count, i, two.mult[j])
            np.add.at(links.count, base + j, one.mult[i])
            first = np.flatnonzero(np.append(True, i[1:] != i[:-1]))  # one link of each row settles most
            links.unite(i[first], base + j[first])
            links.unite(i, base + j)


def compared(pairs: DataFrame, tile: DataFrame, turn: np.ndarray | None, kind: str, threshold: float, lead: int, leaf: int) -> DataFrame:
    """(rep, n, root) of each vector that has links in a pair of tiles; root is the least rep it hangs together with there."""
    out = pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("root", pa.int64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        same = left["a"][0] == left["b"][0]
        reps, mults, dims, vecs = (left[c][0].as_py() for c in ("reps", "mults", "dims", "vecs"))
        reps2, mults2, dims2, vecs2 = (reps, mults, dims, vecs) if same else (right[c][0].as_py() for c in ("reps", "mults", "dims", "vecs"))
        found: list[list[np.ndarray]] = [[], [], []]
        for d in sorted(set(dims) & set(dims2)):
            i, j = ([k for k, v in enumerate(x) if v == d] for x in (dims, dims2))
            one = Side([vecs[k] for k in i], [mults[k] for k in i], kind, turn, lead)
            two = one if same else Side([vecs2[k] for k in j], [mults2[k] for k in j], kind, turn, lead)
            name = np.array([reps[k] for k in i] + ([] if same else [reps2[k] for k in j]), np.int64)
            links = Links(len(name))
            join_sides(one, two, same, threshold, links, 0 if same else len(i), leaf)
            least = np.full(len(name), np.iinfo(np.int64).max)
            np.minimum.at(least, links.label, name)
            hit = links.count > 0
            for c, v in zip(found, (name[hit], links.count[hit], least[links.label][hit])):
                c.append(v)
        return pa.Table.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *c])) for c in found], schema=out)

    def side(x: str):
        load = tile.select(F.col("id").alias("tile"), *[F.col(c).alias(c) for c in ("reps", "mults", "dims", "vecs")])  # aliases tell the sides apart
        return pairs.select(F.col("a").alias("a"), F.col("b").alias("b"), F.col(x).alias("tile")).join(load, "tile").groupBy("a", "b")

    return side("a").cogroup(side("b")).applyInArrow(run, "rep long, n long, root long")


def near_vectors(rows: DataFrame, id_: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, tile: int = TILE, fan: int = FAN, leaf: int = LEAF, fit: int = FIT) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: how many others have a cosine of at least ``threshold`` with it,
    the least id that links lead to, and whether that is its own.

    Vectors that are null, empty, zero, or hold nulls or numbers that are not finite link with nothing, and neither do
    vectors of different dimensions. Rows with equal vectors are linked; rows that repeat an id or have none are vectors of
    their own, where component_id is the least id that is not null, or null if there is none, and kept is false for a row
    without id. Other columns are not read; no rows give no rows. ``threshold`` lies above 0 and up to 1.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie above 0 and not above 1")
    kind = "<f4" if rows.schema[vector].dataType.elementType.simpleString() == "float" else "<f8"
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    named = staged(packed(rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_).cast("long").alias("vec_id"), F.col(vector).cast("array<float>" if kind == "<f4" else "array<double>").alias(vector)), vector), "vectors-rows")
    reps = named.where("key is not null").groupBy("key").agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("mult"), F.min("vec_id").alias("low"), F.first("dim").alias("dim"), F.first("vec").alias("vec"))
    reps = staged(reps, "vectors-reps")
    most = reps.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    lead = min(LEAD, most["dim"]) if most else 1
    turn = fitted(reps, most["dim"], most["n"], kind, lead, fit) if most else None
    eps = max(math.sqrt(max(0.0, 2 - 2 * threshold)), 1e-4)  # a grid needs a width
    line = ordered(reps, turn, kind, eps, lead, min(CELLS, lead), tile)
    block = staged(tiles(line, turn, kind, lead), "vectors-tiles")
    nodes = block.select("id", "n", "weight", "first", "lo", "hi", "centre", "radius")
    pairs, whole, used = open_pairs(nodes, eps, fan)
    found = staged(compared(pairs, block, turn, kind, threshold, lead, leaf), "vectors-found")

    # intervals linked as a whole: what each vector below gains, an edge from it to the interval's first, and edges between firsts
    told, edges = None, found.where("rep <> root").select(F.col("root").alias("a"), F.col("rep").alias("b"))
    side = lambda p, x, y: p.select(F.col(x).alias("node"), F.col(f"weight_{y}").alias("w"), F.col(f"first_{x}").alias("first"), (F.col("a") == F.col("b")).cast("long").alias("own"))
    for level, p in whole:
        one = side(p, "a", "b").unionByName(side(p.where("a <> b"), "b", "a")).withColumn("step", F.lit(fan**level).cast("long"))
        told = one if told is None else told.unionByName(one)
        edges = edges.unionByName(p.where("a <> b").select(F.least("first_a", "first_b").alias("a"), F.greatest("first_a", "first_b").alias("b")))
    sums = told.groupBy("step", "node").agg(F.sum("w").alias("w"), F.sum("own").alias("own"), F.min("first").alias("first"))
    climb = nodes.select("id", F.explode(F.array(*[F.lit(fan**level).cast("long") for level, _ in whole])).alias("step")).withColumn("node", F.floor(F.col("id") / F.col("step")).cast("long"))
    above = climb.join(sums, ["step", "node"]).groupBy("id").agg(F.sum("w").alias("w"), F.sum("own").alias("own"), F.collect_set("first").alias("firsts"))  # one of each level
    more = staged(line.select("rep", "mult", F.col("tile").alias("id")).join(above, "id").select("rep", (F.col("w") - F.col("own") * F.col("mult")).alias("n"), "firsts"), "vectors-whole")
    edges = edges.unionByName(more.select(F.explode("firsts").alias("a"), F.col("rep").alias("b")).where("a <> b"))

    total = found.select("rep", "n").unionByName(more.select("rep", "n")).groupBy("rep").agg(F.sum("n").alias("n"))
    labels = components(edges)
    classes = reps.select("key", "rep", "mult", "low").join(total, "rep", "left").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    classes = classes.select("key", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("label", "rep").alias("label"), "low")
    least = classes.groupBy("label").agg(F.min("low").alias("component_id"))
    classes = classes.join(least, "label").select("key", "n_links", "component_id")
    linked = named.where("key is not null").select("vec_id", "key").join(classes, "key").select("vec_id", "n_links", "component_id", kept)
    alone = named.where("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")).withColumn("kept", F.col("vec_id").isNotNull())
    out = staged(linked.unionByName(alone), "vectors-links")
    discard(named, reps, line, block, *used, found, more, labels)
    return out
