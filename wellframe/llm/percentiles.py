"""Exact percentiles by radix selection, and mergeable histograms with a stated error bound.

A double becomes a signed 64-bit integer of the same order. Selection counts one digit of that integer
after the other, each time only among rows that share the digits already known of a wanted rank, so no
values are sorted, gathered or shuffled; counts are combined on the map side. Histograms over the leading bits
can be kept per day or run and added up later: their percentiles are those of the whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

MANTISSA = 52


def order_key(x: Column) -> Column:
    """Signed long that orders as the double does; -0.0 and 0.0 are one value. Not for NaN."""
    a = F.abs(x)
    power = lambda e: F.pow(F.lit(2.0), e)
    guess = F.least(F.lit(1023), F.greatest(F.lit(-1022), F.floor(F.log2(a)).cast("int")))
    e = F.when(a / power(guess) >= 2, guess + 1).when((a / power(guess) < 1) & (guess > -1022), guess - 1).otherwise(guess)
    normal = F.shiftleft((e + 1023).cast("long"), MANTISSA) + ((a / power(e) - 1) * float(2**MANTISSA)).cast("long")
    tiny = (a * float(2.0**537) * float(2.0**537)).cast("long")
    bits = F.when(a == 0, F.lit(0).cast("long")).when(a == float("inf"), F.lit(2047 << MANTISSA)).when(a < float(2.0**-1022), tiny).otherwise(normal)
    return F.when(x < 0, -bits).otherwise(bits)


def from_order_key(k: Column) -> Column:
    """The double whose order key is ``k``."""
    bits = F.abs(k)
    e = F.shiftright(bits, MANTISSA).cast("int")
    m = bits.bitwiseAND(F.lit((1 << MANTISSA) - 1)).cast("double")
    tiny = m * float(2.0**-537) * float(2.0**-537)
    size = F.when(e == 0, tiny).when(e == 2047, F.lit(float("inf"))).otherwise((m / float(2**MANTISSA) + 1) * F.pow(F.lit(2.0), e - 1023))
    return F.when(k < 0, -size).otherwise(size)


def _valued(df: DataFrame, groups: list[str], value: str, extra: list[str] = ()) -> DataFrame:
    x = F.col(value).cast("double")
    named = [F.col(c).alias(f"g{i}") for i, c in enumerate(groups)]
    return df.where(x.isNotNull() & ~F.isnan(x)).select(*named, *[F.col(c) for c in extra], order_key(x).alias("k"))


def _same(a: DataFrame, b: DataFrame, cols: list[str]) -> Column:
    return reduce(lambda p, c: p & a[c].eqNullSafe(b[c]), cols, F.lit(True))


#: Bits of the digits, leading ones first: sign, exponent and 8 bits of the fraction, then the rest.
DIGITS = (20, 16, 14, 14)


def percentiles(df: DataFrame, groups: list[str], value: str, percents: list[int], digits: tuple[int, ...] = DIGITS, most_prefixes: int = 100_000) -> DataFrame:
    """One row per group: the group columns, ``n`` and ``pXX`` per wanted percent; the error is 0.

    ``pXX`` is the value of rank ceil(n * XX / 100), at least 1, among the group's values that are
    neither null nor NaN; infinities count. Groups without such a value give no row; null group keys
    form a group. Repeated rows and ties count each time; other columns are ignored; an empty table
    gives an empty result.

    The first digit is counted in one scan; a second one keeps, as a table in the shared folder, the rows
    that share a digit with a wanted rank (about the percents' share of the 2^-8 wide buckets), and the
    later digits read only those. No row is shuffled: of a group of any share only counts per digit are.
    That needs the wanted prefixes (at most groups x percents, counted) in every task; beyond
    ``most_prefixes`` of them they are joined on (group, prefix) instead, with the same result.
    """
    g = [f"g{i}" for i in range(len(groups))]
    data = _valued(df, groups, value)
    wanted = F.explode(F.array(*[F.lit(p).cast("int") for p in percents]))
    low = 64 - digits[0]
    counts = data.groupBy(*g, F.shiftright("k", low).alias("digit")).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(*g)
    counts = counts.withColumn("n", F.sum("c").over(w)).withColumn("upto", F.sum("c").over(w.orderBy("digit")))
    ranks = counts.withColumn("percent", wanted).withColumn("rank", F.greatest(F.lit(1).cast("long"), F.floor((F.col("n") * F.col("percent") + 99) / 100)))
    for width in (*digits[1:], 0):
        hit = ranks.where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("c")))
        targets = cut_lineage(hit.select(*g, "n", "percent", (F.col("rank") - F.col("upto") + F.col("c")).alias("rank"), "digit"))
        if not width:
            break
        prefix = targets.select(*g, F.col("digit").alias("prefix")).distinct()
        small = prefix.count() <= most_prefixes
        near = F.broadcast(prefix) if small else prefix
        named = data.withColumn("prefix", F.shiftright("k", low))
        kept = named.join(near, _same(named, near, [*g, "prefix"]), "left_semi")
        if low == 64 - digits[0]:
            data = cut_lineage(kept.drop("prefix"))
            kept = data.withColumn("prefix", F.shiftright("k", low))
        low -= width
        counts = kept.groupBy(*g, "prefix", F.shiftright("k", low).alias("digit")).agg(F.count(F.lit(1)).alias("c"))
        counts = counts.withColumn("upto", F.sum("c").over(Window.partitionBy(*g, "prefix").orderBy("digit")))
        t = targets.select(*[F.col(c).alias(f"t_{c}") for c in g], F.col("digit").alias("t_prefix"), "n", "percent", "rank")
        t = F.broadcast(t) if small else t
        ranks = counts.join(t, reduce(lambda p, c: p & counts[c].eqNullSafe(t[f"t_{c}"]), [*g, "prefix"], F.lit(True)))
    cells = [F.max(F.when(F.col("percent") == p, from_order_key(F.col("digit")))).alias(f"p{p:02d}") for p in percents]
    return targets.groupBy(*g, "n").agg(*cells).select(*[F.col(a).alias(b) for a, b in zip(g, groups)], "n", *[f"p{p:02d}" for p in percents])


def histogram(df: DataFrame, groups: list[str], value: str, parts: list[Column] = (), mantissa_bits: int = 10) -> DataFrame:
    """Counts per group, part and leading bits of the value: (groups, part0.., bucket, n).

    Parts (days, runs) can be made apart and stored. Two values in one bucket differ by less than
    2 ** -mantissa_bits of their size. Null and NaN values do not count.
    """
    named = [F.col(c) for c in groups]
    cols = [c.alias(f"part{i}") for i, c in enumerate(parts)]
    x = F.col(value).cast("double")
    rows = df.where(x.isNotNull() & ~F.isnan(x)).select(*named, *cols, F.shiftright(order_key(x), MANTISSA - mantissa_bits).alias("bucket"))
    return rows.groupBy(*groups, *[f"part{i}" for i in range(len(cols))], "bucket").agg(F.count(F.lit(1)).alias("n"))


def merge(histograms: DataFrame, groups: list[str]) -> DataFrame:
    """Adds up the parts' counts."""
    return histograms.groupBy(*groups, "bucket").agg(F.sum("n").alias("n"))


def histogram_percentiles(merged: DataFrame, groups: list[str], percents: list[int], mantissa_bits: int = 10) -> DataFrame:
    """(groups, percent, n, lower, upper, value, error): the true value lies in [lower, upper].

    ``error`` bounds the distance of ``value``, the middle of the bucket, from the true percentile.
    """
    w = Window.partitionBy(*groups)
    rows = merged.withColumn("total", F.sum("n").over(w)).withColumn("upto", F.sum("n").over(w.orderBy("bucket")))
    rows = rows.withColumn("percent", F.explode(F.array(*[F.lit(p).cast("int") for p in percents])))
    rank = F.greatest(F.lit(1).cast("long"), F.floor((F.col("total") * F.col("percent") + 99) / 100))
    rows = rows.where((rank <= F.col("upto")) & (rank > F.col("upto") - F.col("n")))
    shift = MANTISSA - mantissa_bits
    lower = from_order_key(F.shiftleft("bucket", shift))
    upper = from_order_key(F.shiftleft("bucket", shift) + ((1 << shift) - 1))
    return rows.select(*groups, "percent", F.col("total").alias("n"), lower.alias("lower"), upper.alias("upper"), ((lower + upper) / 2).alias("value"), ((upper - lower) / 2).alias("error"))
