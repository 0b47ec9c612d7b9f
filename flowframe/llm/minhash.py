"""Near-duplicate documents by BagMinHash over bags of word 5-shingles.

A shingle that stands c times weighs c. For every shingle, a Poisson process runs over (weight, time); a document sees
the points below its weight, and each point belongs to one of ``M`` signature components, which keep the earliest time.
Two documents agree in a component with probability equal to their weighted Jaccard similarity. The weight axis is cut
into dyadic cells, each with a process of its own, and a cell that a weight only reaches into is thinned by the position
of its points, so different weights share what they have in common. Points come in order of time, so a cell stops as soon
as its next point is later than every component of the document, which leaves about M ln M points a document.

Signatures are banded; documents that share a band are candidates, and every decision is made on the exact overlap of the
bags. Exact copies are one document from the start. In each bucket, candidates are first verified against two centres;
then the documents of buckets that still hold different classes are joined across classes by an exact prefix filter.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, lower, map_blocks, mix, ragged, space_words, span_hashes, staged, texts
from .components import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 8
M = BANDS * ROWS
#: Most ids that are broadcast to pick candidates out of a scan (8 bytes each); more of them are joined by shuffle.
BROADCAST_IDS = 1 << 20
#: Ratio of the largest to the least size of a class of bags.
CLASS = 1.04
_GOLD, _CELL, _PICK = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_STEP = np.uint64(0xD1B54A32D192ED03)


def bags(data: np.ndarray, offs: np.ndarray, width: int = SHINGLE):
    """(document, shingle hash, count) of a block, by document; a text of fewer words is one shingle."""
    low = lower(data)
    s, e, first = space_words(low, offs)
    n = np.diff(first)
    h = span_hashes(low, s, e) if len(s) else np.empty(0, np.uint64)
    count = np.where(n >= width, n - width + 1, 0)
    at = ragged(first[:-1], count)
    g = np.zeros(len(at), np.uint64)
    for i in range(width):
        g = g * _STEP + h[at + i]
    doc = np.repeat(np.arange(len(n)), count)
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        one = []
        for d in short.tolist():
            x = np.uint64(n[d])
            for w in h[first[d] : first[d + 1]]:
                x = np.uint64((int(x) * int(_STEP) + int(w)) & (1 << 64) - 1)
            one.append(x)
        g, doc = np.concatenate([g, np.array(one, np.uint64)]), np.concatenate([doc, short])
    g = mix(g)
    order = np.lexsort((g, doc))
    g, doc = g[order], doc[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], g[at], np.diff(np.append(at, len(g)))


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, m: int = M) -> np.ndarray:
    """n x m times of the earliest points; infinite for an empty bag. ``weight`` holds whole numbers of units."""
    levels = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1
    at = np.repeat(np.arange(len(doc)), levels)
    level = ragged(np.zeros(len(doc), np.int64), levels)
    low = np.where(level > 0, 2.0 ** np.maximum(level - 1, 0), 0.0)
    size = np.maximum(low, 1.0)
    who, top = doc[at], weight[at].astype(float)
    seed = mix(element[at] + level.astype(np.uint64) * _CELL)
    time = np.zeros(len(at))
    sig, late = np.full(n * m, np.inf), np.full(n, np.inf)
    while len(seed):
        seed = mix(seed + _GOLD)
        time = time - np.log(((seed >> np.uint64(11)) + np.uint64(1)).astype(float) * 2.0**-53) / (m * size)
        pick = mix(seed ^ _PICK)
        place = low + size * ((pick >> np.uint64(32)).astype(float) * 2.0**-32)
        seen = place < top
        slot = who * m + (pick & np.uint64(0xFFFFFFFF)).astype(np.int64) % m
        np.minimum.at(sig, slot[seen], time[seen])
        open_ = np.flatnonzero(np.bincount(who, minlength=n))
        late[open_] = sig.reshape(n, m)[open_].max(axis=1)
        go = time < late[who]
        seed, time, low, size, who, top = (x[go] for x in (seed, time, low, size, who, top))
    return sig.reshape(n, m)


def bands(sig: np.ndarray, count: int = BANDS) -> np.ndarray:
    """One 64-bit key for each band of a signature."""
    n, m = sig.shape
    x = sig.view(np.uint64).reshape(n, count, m // count)
    key = np.broadcast_to(np.arange(1, count + 1, dtype=np.uint64), (n, count))
    for i in range(x.shape[2]):
        key = mix(key * _STEP + x[:, :, i])
    return key.view(np.int64)


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, size, bands): key is the same for equal texts alone; no bands without words."""

    def run(ids, data, offs):
        n = len(offs) - 1
        doc, g, c = bags(data, offs)
        size = np.bincount(doc, weights=c, minlength=n).astype(np.int64)
        key = bands(signatures(doc, g, c, n))
        raw = data.tobytes()
        text = [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(offs, offs[1:])]
        return [ids, pa.array(text, pa.binary()), size, pa.array([k if s else [] for k, s in zip(key, size)], pa.list_(pa.int64()))]

    return map_blocks(texts(docs), run, "doc_id long, key binary, size long, bands array<long>", 2 << 20)


def elements(docs: DataFrame) -> DataFrame:
    """(doc_id, bag): the j-th copy of each shingle as one number, so that bags compare as sets."""

    def run(ids, data, offs):
        doc, g, c = bags(data, offs)
        copy = ragged(np.zeros(len(c), np.int64), c).astype(np.uint64)
        x = mix(np.repeat(g, c) + copy * _CELL).view(np.int64)
        size = np.bincount(np.repeat(doc, c), minlength=len(offs) - 1)
        at = np.append(0, np.cumsum(size))
        return [ids, pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x))]

    return map_blocks(texts(docs), run, "doc_id long, bag array<long>")


def verified(pairs: DataFrame, bag: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose bags reach the threshold, by exact overlap."""
    both = pairs.join(bag.select(F.col("doc_id").alias("a"), F.col("bag").alias("x")), "a").join(bag.select(F.col("doc_id").alias("b"), F.col("bag").alias("y")), "b")
    met = F.size(F.array_intersect("x", "y"))
    return both.where(met >= F.lit(threshold) * (F.size("x") + F.size("y") - met)).select("a", "b")


def across(left: DataFrame, bag: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a, b) of different labels among ``left`` (rep, size, label), by an exact prefix join; and the
    staged table that they are read from.

    Elements are ordered by how many of these bags hold them, rarest first. Bags that reach the threshold share one of
    their first size - ceil(threshold * size) + 1 elements, at places that leave enough of both behind (prefix, length
    and positional filters), so no link is lost, and a passage that many bags share joins none of them. Elements that
    one label alone holds are dropped before the join, so a large class is not paired with itself.
    """
    held = left.join(bag.select(F.col("doc_id").alias("rep"), F.explode("bag").alias("e")), "rep").select("rep", "e")
    df = held.groupBy("e").agg(F.count(F.lit(1)).alias("df"))
    ranked = held.join(df, "e").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("df", "e"))).alias("es")).join(left, "rep")
    wide = (F.col("size") - F.ceil(F.lit(threshold) * F.col("size") - F.lit(1e-9)) + 1).cast("int")
    prefix = ranked.select("rep", "size", "label", F.posexplode(F.slice("es", F.lit(1), wide)).alias("i", "x"))
    prefix = staged(prefix.where("x.df > 1").select("rep", "size", "label", "i", F.col("x.e").alias("e")), "near-prefix")
    mixed = prefix.groupBy("e").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("e")
    # a place is offered only to the classes of size in which a partner could still share enough behind it: of equally large
    # bags that is a ninth of the elements, so what more bags than that have in common joins none of them
    size, share = F.col("size"), threshold / (1 + threshold)
    of_size = lambda x: F.floor(F.log(x) / math.log(CLASS)).cast("int")
    one = prefix.join(mixed, "e").withColumn("own", of_size(size))
    one = one.withColumn("other", F.explode(F.sequence(of_size(size * (threshold * (1 - 1e-9))), of_size(size / (threshold * (1 - 1e-9))))))
    least = F.greatest(F.pow(F.lit(CLASS), F.col("other")) * (1 - 1e-9), size * threshold)
    one = one.where(size - F.col("i") >= (size + least) * share - 1e-6).withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    two = one.select("e", "low", "high", F.col("own").alias("other"), *[F.col(c).alias(f"{c}2") for c in ("rep", "size", "label", "i")])
    need = F.lit(share) * (F.col("size") + F.col("size2")) - F.lit(1e-9)
    fits = (F.col("size") >= F.lit(threshold) * F.col("size2")) & (F.col("size2") >= F.lit(threshold) * F.col("size"))
    enough = (F.col("size") - F.col("i") >= need) & (F.col("size2") - F.col("i2") >= need)
    pairs = one.drop("own").join(two, ["e", "low", "high", "other"]).where((F.col("rep") < F.col("rep2")) & (F.col("label") != F.col("label2")) & fits & enough)
    return pairs.select(F.col("rep").alias("a"), F.col("rep2").alias("b")).distinct(), prefix


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id) of every row: the least doc_id of its class of linked documents.

    Links are weighted Jaccard similarities of at least ``threshold`` between bags of 5-shingles; texts that are equal are
    one class, also where they have no word; null counts as empty. Rows that repeat a doc_id, with the same text or another
    one, and rows without one are documents of their own; class_id is null only where the whole class has no doc_id.
    """
    n, ids = docs.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if n == ids:
        return row_classes(texts(docs), threshold)
    rows = staged(texts(docs).select("doc_id", F.monotonically_increasing_id().alias("row"), "text"), "near-rows")
    named = row_classes(rows.select(F.col("row").alias("doc_id"), "text"), threshold).withColumnRenamed("doc_id", "row")
    named = named.hint("merge").join(rows.select("row", "doc_id"), "row")
    least = named.groupBy("class_id").agg(F.min("doc_id").alias("least"))
    return named.join(least.hint("merge"), "class_id").select("doc_id", F.col("least").alias("class_id"))


def row_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``near_duplicates`` of rows (doc_id, text) whose doc_id is unique and not null."""
    rows = staged(signed(docs), "near-signed")
    reps = staged(rows.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("size").alias("size"), F.first("bands").alias("bands")), "near-reps")
    flat = reps.select("rep", "size", F.explode("bands").alias("band"))
    full = flat.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band")
    shared = staged(flat.join(full, "band"), "near-shared")
    ids = staged(shared.select(F.col("rep").alias("doc_id")).distinct(), "near-ids")
    picked = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    bag = staged(elements(texts(docs).join(picked, "doc_id", "left_semi")), "near-bags")

    small, large = F.least("size", "c.size"), F.greatest("size", "c.size")
    fits = small >= F.lit(threshold) * large
    centre = F.struct("rep", "size")
    centres = shared.groupBy("band").agg(F.array_distinct(F.array(F.min(centre), F.max(centre))).alias("cs")).select("band", F.explode("cs").alias("c"))
    star = shared.join(centres, "band").where((F.col("rep") != F.col("c.rep")) & fits)
    star = staged(star.select(F.least("rep", "c.rep").alias("a"), F.greatest("rep", "c.rep").alias("b")).distinct(), "near-star")
    links = staged(verified(star, bag, threshold), "near-links")
    labels = components(links)

    named = shared.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("band", "rep", "size", F.coalesce("label", "rep").alias("label"))
    open_ = named.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo <> hi and n > 2").select("band")
    left = staged(named.join(open_, "band", "left_semi").select("rep", "size", "label").distinct(), "near-open")
    rest, prefix = across(left, bag, threshold)
    rest = staged(rest.join(star, ["a", "b"], "left_anti"), "near-rest")
    more = staged(verified(rest, bag, threshold), "near-links")
    if more.limit(1).count():
        old, labels = labels, components(links.unionByName(more))
        discard(old)
    classes = reps.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("key", F.coalesce("label", "rep").alias("class_id"))
    out = staged(rows.select("doc_id", "key").join(classes, "key").select("doc_id", "class_id"), "near-classes")
    discard(rows, reps, shared, ids, bag, star, links, left, rest, prefix, more, labels)
    return out
