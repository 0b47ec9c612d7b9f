"""Run-length codes of masks: runs as rows, the padded row-major code, and the column-major string code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def runs(df: DataFrame, key: str, order: list[str], bit: str = "bit") -> DataFrame:
    """(key, run, bit, start, length): maximal runs of equal bits in order."""
    w = W.partitionBy(key).orderBy(*order)
    n = df.select(key, F.col(bit).alias("bit"), (F.row_number().over(w) - 1).alias("i"), F.lag(bit).over(w).alias("was"))
    n = n.withColumn("run", F.sum((F.col("was").isNull() | (F.col("was") != F.col("bit"))).cast("int")).over(W.partitionBy(key).orderBy("i")))
    return n.groupBy(key, "run", "bit").agg(F.min("i").alias("start"), F.count(F.lit(1)).alias("length"))


def packed(df: DataFrame, key: str, order: list[str], bit: str = "bit") -> DataFrame:
    """(key, bits): the bits of a mask in order."""
    s = F.sort_array(F.collect_list(F.struct(*order, F.col(bit).cast("int").alias("bit"))))
    return df.groupBy(key).agg(F.transform(s, lambda x: x["bit"]).alias("bits"))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` made once a row, also where the body uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def padded(bits: Column) -> Column:
    """Counts of runs, zeros first, with a zero before and after; all-zero is [n], all-one [0, n], without padding."""
    n = F.size(bits)

    def counted(b: Column) -> Column:
        edges = F.filter(F.sequence(F.lit(1), F.size(b) - 1), lambda i: F.get(b, i) != F.get(b, i - 1))
        ends = F.concat(edges, F.array(F.size(b)))
        return _let(ends, lambda e: F.transform(e, lambda x, i: x - F.when(i > 0, F.get(e, i - 1)).otherwise(0)))

    counts = _let(F.concat(F.array(F.lit(0)), bits, F.array(F.lit(0))), counted)
    return F.when(F.forall(bits, lambda x: x == 0), F.array(n)).when(F.forall(bits, lambda x: x == 1), F.array(F.lit(0), n)).otherwise(counts)


def unpadded(counts: Column, n: Column) -> Column:
    """Bits of a padded code; a code whose counts sum to n holds no padding."""
    flat = F.flatten(F.transform(counts, lambda c, i: F.array_repeat((i % 2).cast("int"), c)))
    return _let(flat, lambda f: F.slice(f, F.when(F.size(f) == n + 2, F.lit(2)).otherwise(F.lit(1)), n))


# The string code in the language of SQL, for DataFrames and for functions of SQL alike. Runs are column-major, zeros first;
# from the fourth on each is the difference to the run two before. A number is cut into groups of five bits, lowest first;
# 32 marks that another group follows, and bit 16 of the last one is the sign. Groups are characters from 48 on.
_ENCODE = """case when size({bits}) = 0 then '0' else
element_at(transform(array(transform(sequence(0, size({bits}) - 1), i -> get({bits}, (i % {h}) * {w} + i div {h}))), c ->
element_at(transform(array(filter(sequence(1, size(c)), i -> i = size(c) or get(c, i) <> get(c, i - 1))), e ->
element_at(transform(array(concat(if(get(c, 0) <> 0, array(0), cast(array() as array<int>)), transform(e, (x, i) -> x - if(i > 0, get(e, i - 1), 0)))), n ->
array_join(transform(transform(n, (x, i) -> if(i > 2, x - get(n, i - 2), x)), x ->
element_at(transform(array(case when x between -16 and 15 then 0 when x between -512 and 511 then 1 when x between -16384 and 16383 then 2
  when x between -524288 and 524287 then 3 when x between -16777216 and 16777215 then 4 when x between -536870912 and 536870911 then 5 else 6 end), g ->
array_join(transform(sequence(0, g), k -> chr(48 + (shiftright(cast(x as bigint), 5 * k) & 31) + if(k < g, 32, 0))), '')), 1)), '')), 1)), 1)), 1) end"""
_DECODE = """element_at(transform(array(aggregate(transform(filter(split({code}, ''), c -> c <> ''), c -> ascii(c) - 48),
  named_struct('n', cast(array() as array<bigint>), 'x', 0L, 'k', 0),
  (s, c) -> if((c & 32) <> 0, named_struct('n', s.n, 'x', s.x | shiftleft(cast(c & 31 as bigint), 5 * s.k), 'k', s.k + 1),
    named_struct('n', concat(s.n, array((s.x | shiftleft(cast(c & 31 as bigint), 5 * s.k) | if((c & 16) <> 0, shiftleft(-1L, 5 * (s.k + 1)), 0L))
      + if(size(s.n) > 2, get(s.n, size(s.n) - 2), 0L))), 'x', 0L, 'k', 0)),
  s -> flatten(transform(s.n, (x, i) -> array_repeat(cast(i % 2 as int), cast(x as int)))))), b ->
if(size(b) = 0, b, transform(sequence(0, size(b) - 1), p -> get(b, (p % {w}) * {h} + p div {w})))), 1)"""


def coco_sql(bits: str, h: str, w: str) -> str:
    """SQL of the string code of row-major ``bits`` (array of int); null for a null mask."""
    return _ENCODE.format(bits=bits, h=h, w=w)


def from_coco_sql(code: str, h: str, w: str) -> str:
    """SQL of the row-major bits of a string code; null for a null code."""
    return _DECODE.format(code=code, h=h, w=w)


def coco(bits: str, h: int, w: int) -> Column:
    """The string code of the mask in column ``bits``."""
    return F.expr(coco_sql(bits, str(h), str(w)))


def from_coco(code: str, h: int, w: int) -> Column:
    return F.expr(from_coco_sql(code, str(h), str(w)))
