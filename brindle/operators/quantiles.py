"""Exact quantiles and bounded ordered lists, per group, without a buffer of all of a group's values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.operators.persist import Rounds

#: Buckets of a refinement; values of a bucket that are ranked one by one; rows of state that are broadcast.
BUCKETS, FEW, MOST_BROADCAST = 1024, 1000, 100_000


def _matches(a: list[str], b: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(p).eqNullSafe(F.col(q)) for p, q in zip(a, b)], F.lit(True))


def _scale(x: Column, far: Column) -> Column:
    """Something that grows with x: x itself, or a logarithm where the bucket spans magnitudes."""
    clipped = F.least(F.greatest(x, F.lit(-1.7e308)), F.lit(1.7e308))
    return F.when(far, F.signum(clipped) * F.log1p(F.abs(clipped))).otherwise(x)


def _bucket(v: Column, lo: Column, hi: Column) -> Column:
    """0 to BUCKETS - 1, never less for a larger value, and not the same for lo and hi."""
    log = lambda x: F.signum(x) * F.log1p(F.least(F.abs(x), F.lit(1.7e308)))
    far = (hi / 2 - lo / 2 > 5e5) & (log(hi) - log(lo) > 1)
    at, first, last = _scale(v, far), _scale(lo, far), _scale(hi, far)
    # halves, so that no difference overflows
    share = (at / 2 - first / 2) / (last / 2 - first / 2)
    return F.when(v >= hi, BUCKETS - 1).when(v <= lo, 0).otherwise(F.least(F.greatest(F.floor(share * BUCKETS), F.lit(0)), F.lit(BUCKETS - 1))).cast("int")


def exact_quantiles(df: DataFrame, value: str, fractions: list[float], group: list[str] | None = None) -> DataFrame:
    """(group..., n, quantiles): the quantiles of each group's values, interpolated between neighbours; null and NaN are no values, and groups
    without values have no row. A null group is a group.

    A rank's bucket starts as the group's whole range. Each round counts the values of the bucket by 1,024 narrower ones, on the map side
    first, and keeps the one that holds the rank, with the least and largest value in it. It ends where these are equal, or a thousand
    values are left. So what is sent and held follows the number of groups and ranks, never a group's rows; rounds follow the logarithm of the spread.
    """
    group = group or []
    keys = [f"__g{i}" for i in range(len(group))]
    rows = df.select(*[F.col(g).alias(k) for g, k in zip(group, keys)], F.col(value).cast("double").alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    whole = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("__v").alias("lo"), F.max("__v").alias("hi")).where("n > 0")
    at = F.array(*[F.lit(float(q)) for q in fractions])
    ranks = F.transform(at, lambda q, i: F.struct(i.alias("q"), (q * (F.col("n") - 1)).alias("at")))
    two = whole.select(*keys, "n", "lo", "hi", F.explode(ranks).alias("r")).select(*keys, F.col("n").alias("all"), "n", "lo", "hi", "r.q", "r.at", F.explode(F.array(F.floor("r.at"), F.ceil("r.at"))).alias("rank"))
    rounds = Rounds(df.sparkSession)
    state = rounds.keep(two.distinct().withColumn("target", F.col("rank")))
    known = [*keys, "all", "q", "at", "target"]
    mine = [f"__s{i}" for i in range(len(keys))]

    def meeting(open_: DataFrame) -> DataFrame:
        """The rows in the buckets of the state, as (state, __v)."""
        wanted = open_.select(*[F.col(k).alias(s) for k, s in zip(keys, mine)], "target", "lo", "hi", "rank").distinct()
        wanted = F.broadcast(wanted) if open_.count() <= MOST_BROADCAST else wanted
        return rows.join(wanted, _matches(keys, mine) & F.col("__v").between(F.col("lo"), F.col("hi"))).drop(*mine)

    while True:
        open_ = state.where((F.col("lo") < F.col("hi")) & (F.col("n") > FEW))
        if open_.limit(1).count() == 0:
            break
        counts = meeting(open_).groupBy(*keys, "target", "rank", _bucket(F.col("__v"), F.col("lo"), F.col("hi")).alias("bucket")).agg(F.count(F.lit(1)).alias("c"), F.min("__v").alias("new_lo"), F.max("__v").alias("new_hi"))
        upto = F.sum("c").over(Window.partitionBy(*keys, "target").orderBy("bucket"))
        chosen = counts.withColumn("upto", upto).where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("c")))
        chosen = chosen.select(*[F.col(k).alias(s) for k, s in zip(keys, mine)], F.col("target").alias("__t"), "new_lo", "new_hi", F.col("c").alias("new_n"), (F.col("rank") - (F.col("upto") - F.col("c"))).alias("new_rank"))
        narrowed = open_.join(chosen, _matches([*keys, "target"], [*mine, "__t"])).select(*known, F.col("new_n").alias("n"), F.col("new_lo").alias("lo"), F.col("new_hi").alias("hi"), F.col("new_rank").alias("rank"))
        state = rounds.keep(state.where((F.col("lo") >= F.col("hi")) | (F.col("n") <= FEW)).select(*narrowed.columns).unionByName(narrowed))
    small = state.where("lo < hi")
    listed = meeting(small).groupBy(*keys, "target", "rank").agg(F.sort_array(F.collect_list("__v")).alias("values"))
    found = listed.select(*[F.col(k).alias(s) for k, s in zip(keys, mine)], F.col("target").alias("__t"), F.get("values", F.col("rank").cast("int")).alias("value"))
    values = small.join(found, _matches([*keys, "target"], [*mine, "__t"])).select(*known, "value").unionByName(state.where("lo >= hi").select(*known, F.col("lo").alias("value")))
    low, high = F.min("value"), F.max("value")
    share = F.first("at") - F.floor(F.first("at"))
    between = F.when(low == high, low).otherwise(low * (1 - share) + high * share)
    per = values.groupBy(*keys, "all", "q").agg(between.alias("value"))
    lists = per.groupBy(*keys, F.col("all").alias("n")).agg(F.transform(F.array_sort(F.collect_list(F.struct("q", "value"))), lambda x: x["value"]).alias("quantiles"))
    return lists.select(*[F.col(k).alias(g) for g, k in zip(group, keys)], "n", "quantiles")


def top_distinct(df: DataFrame, group: list[str], value: str, order: Column, n: int, out: str, parts: int = 64) -> DataFrame:
    """(group..., out): each group's first `n` distinct non-null values as a list, by the least order that a value has, then by value.

    Values are made distinct by an aggregation, then ranked in `parts` hashed parts of a group, and then the firsts of the parts: what
    meets in a task for one group are `n` values of each part, whatever number it has.
    """
    once = df.where(F.col(value).isNotNull()).groupBy(*group, F.col(value).alias("__value")).agg(F.min(order).alias("__order"))
    part = F.pmod(F.xxhash64("__value"), F.lit(parts))
    first = once.withColumn("__part", part).withColumn("__k", F.row_number().over(Window.partitionBy(*group, "__part").orderBy("__order", "__value"))).where(F.col("__k") <= n)
    ranked = first.withColumn("__k", F.row_number().over(Window.partitionBy(*group).orderBy("__order", "__value"))).where(F.col("__k") <= n)
    return ranked.groupBy(*group).agg(F.transform(F.array_sort(F.collect_list(F.struct("__k", "__value"))), lambda x: x["__value"]).alias(out))
