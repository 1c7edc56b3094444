"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time t in [0, 1]. Its integral is the source's cumulative
demand for words; a word that is the c-th of its source's stream is trained on at the time when the demand
reaches c. Every copy of a document (one for each pass of the stream over it) gets the position of its own first
word; copies are range-sorted by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import n_words_expr, words_expr

WEIGHTS, CAP = (5.0, 2.0, 1.0), 3
#: Knots (t, multiplier) of the weight schedules, one for each place in WEIGHTS, piecewise linear: the heavy
#: sources fade, the middle ones are even, the light ones rise.
SCHEDULES = (((0.0, 1.25), (0.5, 1.0), (1.0, 0.75)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))
#: Rows of a part of a source's stream, and of an output partition.
ROWS_IN_PART, ROWS_IN_TASK = 2_000, 20_000


def inverse_demand(share, knots) -> F.Column:
    """The time at which the schedule's integral reaches `share` (0 to 1) of its total: a root of a parabola in each piece."""
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
    out, before = F.lit(float(knots[-1][0])), area
    for (t0, m0), (t1, m1) in reversed(list(zip(knots, knots[1:]))):
        piece = (t1 - t0) * (m0 + m1) / 2
        before -= piece
        need, slope = F.greatest(share * area - before, F.lit(0.0)), (m1 - m0) / (t1 - t0)
        x = need / m0 if slope == 0 else 2 * need / (m0 + F.sqrt(F.greatest(F.lit(m0 * m0) + 2 * slope * need, F.lit(0.0))))
        out = F.when(share * area <= before + piece, F.least(t0 + x, F.lit(float(t1)))).otherwise(out)
    return out


def source_targets(sized: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size, place (rank by code point, null last), target: one row per source.

    Targets are least(level * weight, cap * source_size) that add up to all sizes: the level is found from
    running sums over sources in the order in which they reach their cap, which is where resharing the excess
    again and again ends. The windows hold one row per source.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    w = ranked.withColumn("weight", weight).withColumn("limit", (cap * F.col("source_size")).cast("double"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    whole = Window.partitionBy(F.lit(1))
    run = w.withColumns({
        "capped": F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "rest": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
        "total": F.sum(F.col("source_size").cast("double")).over(whole),
        "reached": F.row_number().over(order),
    }).withColumn("level", (F.col("total") - F.col("capped")) / F.col("rest"))
    level = F.min(F.when(F.col("level") <= F.col("limit") / F.col("weight"), F.struct("reached", "level"))).over(whole)["level"]
    return run.withColumn("level", level).select("source", "source_size", "place", F.least(F.coalesce(F.col("level") * F.col("weight"), F.col("limit")), F.col("limit")).alias("target"))


def place_in_streams(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights, cap: int, carry: tuple[str, ...]) -> tuple[DataFrame, int]:
    """One row per input row, and their number: id, carried columns as __c_<name>, size, source_size, place, target,
    wanted (words that the mix takes of the source), at (words of the source's stream before the row, in each pass).

    Running sums are taken in parts of about 2,000 rows cut by md5, then over the parts' totals, so a source
    that holds most rows is spread over tasks.
    """
    text, carried = F.col(text_col), [F.col(c).alias(f"__c_{c}") for c in carry]
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words_expr(text).alias("size"), key.alias("key"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("same"), *carried)
    n_rows = docs.count()
    # a part is a range of the first 32 bits of md5, so parts follow each other in stream order
    parts = max(1, -(-n_rows // ROWS_IN_PART))
    part = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * parts / F.lit(float(1 << 32))).cast("int")
    sized = sized.withColumn("part", part)
    targets = source_targets(sized, weights, cap)
    sums = sized.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("part_size").over(before), F.lit(0))).drop("part_size")
    info = starts.alias("p").join(targets.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source"))).select(F.col("p.source").alias("s_source"), F.col("p.part").alias("s_part"), "start", "source_size", "place", "target")
    within = Window.partitionBy("source", "part").orderBy("key", "size", "same").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0))).join(info, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("part") == F.col("s_part")))
    return placed.withColumns({"at": F.col("start") + F.col("inner"), "wanted": F.round("target").cast("long")}), n_rows


def curriculum_time(words_before, schedules) -> F.Column:
    """The time at which a source of `wanted` words and rank `place` has had `words_before` of them."""
    share = F.when(F.col("wanted") > 0, words_before / F.col("wanted")).otherwise(F.lit(0.0))
    out = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        out = F.when(F.pmod("place", F.lit(len(schedules))) == k, inverse_demand(share, knots)).otherwise(out)
    return out


def sort_by_position(rows: DataFrame, n_rows: int, *ties: str) -> DataFrame:
    order = [F.col("position").asc_nulls_last(), *map(F.col, ties)]
    return rows.repartitionByRange(max(1, -(-n_rows // ROWS_IN_TASK)), *order).sortWithinPartitions(*order)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, cap: int = CAP, schedules=SCHEDULES, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row, sorted by position: id, carried columns, size, source_size, target, taken, passes, position, last_position.

    A source's stream is its documents in the order of md5(id), over and over. The mix takes the first
    round(target) words of the stream, so a document is taken whole as often as the stream passes it, and one
    document of each source may end cut. taken counts its words, repeats included; position is the curriculum
    time of its first word in the first pass (`mix_copies` has all passes), null where nothing is taken.

    Null texts have size 0 and nothing is taken; a null source is a source of its own, last in order; null ids
    come first in the stream; rows alike in id are ordered by size and text, so reruns agree. Empty tables give
    no rows. Columns that are neither named nor carried are ignored, whatever their names.
    """
    placed, n_rows = place_in_streams(docs, id_col, text_col, source_col, weights, cap, carry)
    at, wanted = F.col("at"), F.col("wanted")
    full = F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.least(F.greatest(wanted - full * F.col("source_size") - at, F.lit(0)), F.col("size"))
    taken = (full * F.col("size") + rest).cast("long")
    passes = F.when(taken > 0, F.ceil((wanted - at) / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    placed = placed.withColumns({"taken": taken, "passes": passes})
    last = F.col("at") + (F.col("passes") - 1) * F.col("source_size")
    times = [F.when(F.col("taken") > 0, curriculum_time(begin, schedules)).alias(name) for name, begin in (("position", at), ("last_position", last))]
    out = placed.select(F.col("id").alias(id_col), *[F.col(f"__c_{c}").alias(c) for c in carry], "size", "source_size", "target", "taken", "passes", *times)
    return sort_by_position(out, n_rows, id_col)


def mix_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, cap: int = CAP, schedules=SCHEDULES, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per copy in the mix, sorted by position: id, carried columns, size, pass (from 0), words, position.

    The stream, its order and odd rows are those of `mix_sources`. Pass k over a document starts k * source_size
    words after the first one, and its position is the time at which the demand reaches that word; words is less
    than size for the copy at which a source's stream ends. Documents of which nothing is taken have no rows.
    """
    placed, n_rows = place_in_streams(docs, id_col, text_col, source_col, weights, cap, carry)
    left = F.col("wanted") - F.col("at")
    passes = F.sequence(F.lit(0).cast("long"), F.ceil(left / F.col("source_size")).cast("long") - 1)
    each = placed.where((F.col("size") > 0) & (left > 0)).withColumn("pass", F.explode(passes))
    begin = F.col("at") + F.col("pass") * F.col("source_size")
    words = F.least(F.col("size"), F.col("wanted") - begin).cast("long")
    out = each.select(F.col("id").alias(id_col), *[F.col(f"__c_{c}").alias(c) for c in carry], "size", F.col("pass").cast("int").alias("pass"), words.alias("words"), curriculum_time(begin, schedules).alias("position"))
    return sort_by_position(out, n_rows, id_col, "pass")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", length_col: str | None = "n_chars", **options) -> DataFrame:
    """The mix itself: documents with their columns, once for each time they are taken, each copy at its own
    position; the cut document of a source has the words it was taken for. Documents without words aren't taken, null texts among them; a null
    source is a source of its own; equal rows are documents of their own; long texts stay whole; an empty table gives no rows; other
    columns may be null and have any names."""
    own = docs.columns
    packed = docs.select(id_col, text_col, source_col, F.struct(*[F.col(c) for c in own]).alias("__own"))
    each = mix_copies(packed, id_col, text_col, source_col, carry=("__own",), **options)
    text = F.col("__own").getField(text_col)
    cut = F.array_join(F.slice(words_expr(text), F.lit(1), F.col("words").cast("int")), " ")
    each = each.withColumn("__text", F.when(F.col("words") < F.col("size"), cut).otherwise(text))
    own_columns = {c: F.col("__own").getField(c) for c in own} | {text_col: F.col("__text")}
    if length_col in own:
        own_columns[length_col] = F.length("__text").cast("long")
    return each.select(*[v.alias(c) for c, v in own_columns.items()])
