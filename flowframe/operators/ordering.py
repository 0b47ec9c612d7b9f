"""Order statistics and totals of keys, without a task that holds all rows of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Rows of a key up to which one task may sort its values.
WHOLE = 1 << 20
#: Ranges that a key's values are counted in at a time.
RANGES = 1 << 12


def beside(df: DataFrame, key: str, totals: DataFrame) -> DataFrame:
    """Every row of ``df`` with what ``totals`` (key, columns) has for its key, null for a key that it lacks; nulls are a key.

    Totals hold a row a key and are joined back: by broadcast while they are small, else adaptive execution splits the rows of
    a key that many rows share.
    """
    own = totals.withColumnRenamed(key, "__key")
    return df.join(own, df[key].eqNullSafe(own["__key"]), "left").drop("__key")


def _spread(v: Column) -> Column:
    """A rising function of a double that gives each power of ten as much room: ranges of many magnitudes are cut evenly."""
    size = F.log(F.abs(v)) + 746.0  # above 0 for the least double too
    return F.when(v > 0, size).when(v < 0, -size).otherwise(0.0)


def quantiles(df: DataFrame, key: str, value: str, q: list[float], whole: int = WHOLE, ranges: int = RANGES) -> DataFrame:
    """(key, quantiles): the exact quantiles ``q`` of each key's values, between neighbours by linear interpolation.

    Null and NaN values are left out, infinite ones are not expected; a key without another value is absent; null is a key.
    A key of up to ``whole`` values is settled by one aggregate. For larger ones, of which there are few, each wanted rank is
    followed down: the values of the range that it lies in are counted in ``ranges`` narrower ones, cut by magnitude first and
    evenly then, until one holds a single value or the rank is the first or last of it. That takes seven rounds at most.
    """
    rows = df.select(F.col(key).alias("key"), F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    each = F.percentile("v", F.array(*[F.lit(x) for x in q])).alias("quantiles")
    sized = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).where(F.col("n") > whole)
    big = sized.collect()  # fewer than the rows by ``whole``
    if not big:
        return rows.groupBy("key").agg(each).withColumnRenamed("key", key)
    large = df.sparkSession.createDataFrame([tuple(r) for r in big], sized.schema)
    names = F.broadcast(large.select(F.col("key").alias("k")))
    few = rows.join(names, F.col("key").eqNullSafe(F.col("k")), "left_anti")
    many = rows.join(names, F.col("key").eqNullSafe(F.col("k")), "left_semi")
    place = lambda x: (F.col("n") - 1) * F.lit(x)
    asks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(place(x)), F.ceil(place(x))) for x in q])))
    # rank: from 0 within lo..hi, which holds n values
    wanted = large.select("key", F.explode(asks).alias("ask"), "n", "lo", "hi").withColumn("rank", F.col("ask"))
    done = None
    while True:
        state = wanted.withColumn("found", F.when((F.col("lo") == F.col("hi")) | (F.col("rank") == 0), F.col("lo")).when(F.col("rank") == F.col("n") - 1, F.col("hi")))
        state = state.select("key", "ask", "n", "lo", "hi", "rank", "found")
        known = [tuple(r) for r in state.collect()]  # two rows a quantile for each large key
        state = df.sparkSession.createDataFrame(known, state.schema)
        part = state.where("found is not null").select("key", "ask", "found")
        done = part if done is None else done.unionByName(part)
        if all(r[-1] is not None for r in known):
            break
        ask = state.where("found is null").select(F.col("key").alias("k"), "ask", "lo", "hi", "rank")
        within = many.join(F.broadcast(ask), F.col("key").eqNullSafe(F.col("k"))).where(F.col("v").between(F.col("lo"), F.col("hi")))
        low, high = _spread(F.col("lo")), _spread(F.col("hi"))
        even = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)  # halves, so that no difference overflows
        share = F.least(F.when(high - low > 1, (_spread(F.col("v")) - low) / (high - low)).otherwise(even), F.lit(1.0))
        bins = within.groupBy("key", "ask", "rank", F.floor(share * (ranges - 1)).alias("bin")).agg(F.count(F.lit(1)).alias("m"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        # at most ``ranges`` rows for a rank
        listed = bins.groupBy("key", "ask", "rank").agg(F.sort_array(F.collect_list(F.struct("bin", "m", "lo", "hi"))).alias("bins"))
        step = F.aggregate(
            "bins",
            F.struct(F.col("rank").alias("rank"), F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("lo"), F.lit(0.0).alias("hi"), F.lit(False).alias("hit")),
            lambda s, b: F.when(s["hit"], s).when(s["rank"] < b["m"], F.struct(s["rank"].alias("rank"), b["m"].alias("n"), b["lo"].alias("lo"), b["hi"].alias("hi"), F.lit(True).alias("hit"))).otherwise(F.struct((s["rank"] - b["m"]).alias("rank"), s["n"].alias("n"), s["lo"].alias("lo"), s["hi"].alias("hi"), F.lit(False).alias("hit"))),
        )
        wanted = listed.select("key", "ask", step.alias("s")).select("key", "ask", "s.n", "s.lo", "s.hi", "s.rank")
    values = large.select("key", "n").join(done.groupBy(F.col("key").alias("k")).agg(F.map_from_entries(F.collect_list(F.struct("ask", "found"))).alias("at")), F.col("key").eqNullSafe(F.col("k")))

    def between(x: float) -> Column:
        at = place(x)
        low, high = (F.element_at("at", f(at)) for f in (F.floor, F.ceil))
        share = at - F.floor(at)
        return F.when(share == 0, low).otherwise(low * (1 - share) + high * share)

    out = values.select("key", F.array(*[between(x) for x in q]).alias("quantiles"))
    out = out.unionByName(few.groupBy("key").agg(each))
    return out.withColumnRenamed("key", key)


def min_max(df: DataFrame, key: str, value: str, name: str = "level") -> DataFrame:
    """``df`` with (value - least) / (largest - least) within the key; 0 where the key holds one value."""
    rows = beside(df, key, df.groupBy(key).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi")))
    lo, hi = F.col("__lo"), F.col("__hi")
    return rows.withColumn(name, F.when(hi > lo, (F.col(value) - lo) / F.nullif(hi - lo, F.lit(0.0))).otherwise(F.lit(0.0))).drop("__lo", "__hi")


def max_share(df: DataFrame, key: str, value: str, name: str = "level", top: float = 255.0, least: float = 1e-6) -> DataFrame:
    """``df`` with value / (largest + ``least``) * ``top`` within the key."""
    rows = beside(df, key, df.groupBy(key).agg(F.max(value).alias("__hi")))
    return rows.withColumn(name, F.col(value) / (F.col("__hi") + F.lit(least)) * top).drop("__hi")


def cut_at(limits: list, at: Column, kind: str) -> Column:
    """How many of the sorted limits (value, digest) a struct of the two reaches, by halving."""

    def find(a: int, b: int) -> Column:
        if a == b:
            return F.lit(a)
        m = (a + b) // 2
        v, d = limits[m]
        return F.when(at >= F.struct(F.lit(v).cast(kind), F.lit(d)), find(m + 1, b)).otherwise(find(a, m))

    return find(0, len(limits))


def ranked(df: DataFrame, by: str, name: str = "pos", parts: int | None = None, whole: int = 1 << 16) -> DataFrame:
    """Position from 0 in the order of a column, nulls first, without sorting all rows in one task.

    Up to ``whole`` rows are numbered by one window. More of them are cut into ``parts`` ranges (the session's shuffle
    partitions) of (value, digest of the row), so that the rows of one value are spread too; the limits come from a random
    20 rows for each range. Every row is counted in its range, and ranges are numbered from the sums of those before.
    """
    n = df.count()
    line = [F.col(by).asc_nulls_first(), F.xxhash64(*df.columns)]
    if n <= whole:
        return df.withColumn(name, F.row_number().over(W.orderBy(*line)) - 1)
    parts = parts or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    some = df.select(by, F.xxhash64(*df.columns).alias("d")).where(F.col(by).isNotNull()).sample(min(1.0, 20 * parts / n), seed=1).collect()
    seen = sorted((r[0], r[1]) for r in some)
    limits = sorted({seen[i * len(seen) // parts] for i in range(1, parts)}) if seen else []
    rows = df.withColumn("__digest", F.xxhash64(*df.columns))
    rows = rows.withColumn("__range", cut_at(limits, F.struct(F.col(by), F.col("__digest")), df.schema[by].dataType.simpleString()))
    each = rows.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = each.select("__range", (F.sum("__n").over(W.orderBy("__range")) - F.col("__n")).alias("__before"))  # one row a range
    own = rows.withColumn("__own", F.row_number().over(W.partitionBy("__range").orderBy(F.col(by).asc_nulls_first(), "__digest")) - 1)
    out = own.join(F.broadcast(before), "__range")
    return out.select(*df.columns, (F.col("__before") + F.col("__own")).alias(name))

