"""Ordered logic and geometry: running paths, carried state, line clusters, bands."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType
from pyspark.sql.window import Window

from lectern.functions.lineage import small
from lectern.functions.numbers import overlap, span_distance


def section_path(df: DataFrame, group: Sequence[str], order: Sequence[str], name: Column, is_group: Column, separator: str = " > ") -> DataFrame:
    """`df` with section_path: names of the group rows up to each row, joined; a name equal to the group row's before it is not added again. The path only grows."""
    w = Window.partitionBy(*group).orderBy(*order)
    named = df.withColumn("_name", F.when(is_group & name.isNotNull() & (name != ""), name))
    before = F.last("_name", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    added = named.withColumn("_added", F.when(F.col("_name").isNotNull() & ~F.col("_name").eqNullSafe(before), F.col("_name")))
    # Paths are made at the rows that add a name, and carried to the rows below.
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = added.withColumn("_n", F.count("_added").over(upto))
    own = [F.col(g).alias(f"_g{i}") for i, g in enumerate(group)]
    path = F.array_join(F.collect_list("_added").over(Window.partitionBy(*group).orderBy("_n").rowsBetween(Window.unboundedPreceding, Window.currentRow)), separator)
    paths = numbered.where("_added is not null").select(*own, F.col("_n").alias("_m"), path.alias("section_path"))
    met = F.col("_n") == F.col("_m")
    for i, g in enumerate(group):
        met = met & numbered[g].eqNullSafe(F.col(f"_g{i}"))
    out = numbered.join(paths, met, "left").withColumn("section_path", F.coalesce("section_path", F.lit("")))
    return out.drop("_name", "_added", "_n", "_m", *[f"_g{i}" for i in range(len(group))])


def carry_forward(df: DataFrame, group: Sequence[str], order: Sequence[str], own: Column, state: Column, default: str, alias: str = "state") -> DataFrame:
    """`df` with the row's own value, else the last `state` (null where a row sets none) of an earlier row, else the default."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("_state", state).withColumn(alias, F.coalesce(own, F.last("_state", ignorenulls=True).over(w), F.lit(default))).drop("_state")


def first_present(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """(group, value): the first value that isn't null, in order."""
    return df.where(F.col(value).isNotNull()).groupBy(*group).agg(F.min_by(value, F.struct(*order)).alias(value))


def gaps(df: DataFrame, group: Sequence[str], number: str, first: int = 1) -> DataFrame:
    """(group, from, to): the runs of whole numbers from `first` on up to the group's largest that none of its rows has. Repeats and nulls don't matter."""
    once = df.where(F.col(number) >= first).groupBy(*group, F.col(number).alias("_n")).agg(F.lit(1).alias("_one"))
    before = F.lag("_n", 1, first - 1).over(Window.partitionBy(*group).orderBy("_n"))
    return once.select(*group, (before + 1).alias("from"), (F.col("_n") - 1).alias("to")).where(F.col("from") <= F.col("to"))


def steps_back(df: DataFrame, group: Sequence[str], order: Sequence[str], number: str) -> DataFrame:
    """(group, repeated, unordered): the numbers that a group's rows have more than once, each once in order, and whether any row's number is less than the one before it."""
    moved = df.where(F.col(number).isNotNull()).withColumn("_back", F.col(number) < F.lag(number).over(Window.partitionBy(*group).orderBy(*order)))
    counted = moved.groupBy(*group, number).agg(F.count("*").alias("_k"), F.max("_back").alias("_back"))
    repeated = F.array_sort(F.collect_list(F.when(F.col("_k") > 1, F.col(number))))
    return counted.groupBy(*group).agg(repeated.alias("repeated"), F.coalesce(F.max("_back"), F.lit(False)).alias("unordered"))


def cluster_lines(values: Column, tolerance: float = 1.6) -> Column:
    """The line number of each value of a sorted array: a new line starts where a value is more than `tolerance` past the line's first value."""
    start = F.struct(F.lit(None).cast("double").alias("first"), F.lit(-1).alias("line"), F.array().cast("array<int>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        new = s["first"].isNull() | (F.abs(x - s["first"]) > tolerance)
        line = s["line"] + F.when(new, 1).otherwise(0)
        return F.struct(F.when(new, x).otherwise(s["first"]).alias("first"), line.alias("line"), F.concat(s["out"], F.array(line)).alias("out"))

    return F.aggregate(values, start, step, lambda s: s["out"])


def equal_bands(left: Column, right: Column, n: Column, parts: int = 5) -> Column:
    """n equal bands from left to right, each cut in `parts`: an array of (band, part, left, right)."""
    width = (right - left) / n
    cells = F.transform(
        F.sequence(F.lit(0), n * parts - 1),
        lambda i: F.struct(
            (F.floor(i / parts) + 1).cast("int").alias("band"),
            (i % parts).cast("int").alias("part"),
            (left + width * i / parts).alias("left"),
            (left + width * (i + 1) / parts).alias("right"),
        ),
    )
    return F.when(n > 0, cells).otherwise(F.array().cast("array<struct<band:int,part:int,left:double,right:double>>"))


def line_numbers(df: DataFrame, group: str, value: str, tolerance: float = 1.6) -> DataFrame:
    """(group, value, line): cluster_lines() for groups of any size. Spark sorts the rows; each task goes through its groups once and holds a line's first value only. Nulls are left out."""
    kinds = [df.schema[c].dataType.simpleString() for c in (group, value)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, line = None, None, 0
        for batch in batches:
            lines = []
            for g, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if first is None or g != now:
                    now, first, line = g, v, 0
                elif v - first > tolerance:
                    first, line = v, line + 1
                lines.append(line)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lines, pa.int32())], ["a", "b", "line"])

    ordered = df.select(F.col(group).alias("a"), F.col(value).alias("b")).where("b is not null").repartition("a").sortWithinPartitions("a", "b")
    return ordered.mapInArrow(scan, f"a {kinds[0]}, b {kinds[1]}, line int").withColumnsRenamed({"a": group, "b": value})


def _level(width: Column) -> Column:
    """The least power of two (its exponent, -20 at least) that a width doesn't exceed."""
    up = F.greatest(F.ceil(F.log2(F.when(width > 0, width))), F.lit(-20))
    return F.coalesce(F.when(F.pow(F.lit(2.0), up) < width, up + 1).otherwise(up), F.lit(-20)).cast("int")


def _levels(df: DataFrame) -> Column:
    """The levels that occur, at most the exponents of doubles."""
    return F.array(*[F.lit(r[0]) for r in df.select("_level").distinct().orderBy("_level").collect()]).cast("array<int>")


def _cell(x: Column) -> Column:
    return F.floor(x / F.pow(F.lit(2.0), F.col("_level"))).cast("long")


def _dealt(spans: DataFrame, left: Column, right: Column) -> DataFrame:
    """Spans with each cell of their _level that they touch: two at most, as no span is wider than a cell."""
    return spans.withColumn("_cell", F.explode(F.sequence(_cell(left), _cell(right))))


#: A cell with more points or spans than this is cut: in eight by place, and both sides in slices of about as many rows.
CROWDED = 8_192


def _near(points: DataFrame, x: str, spans: DataFrame, low: Column, high: Column, on: Sequence[str], crowded: int = CROWDED, share: float = 1 / 64) -> DataFrame:
    """Spans with points of equal `on` columns in the same cell of the span's level: every span with each point that it holds once, and with others near it.

    Crowded cells are told by a sample of both sides and cut; each slice of the points meets each slice of the spans, so a cell of any number of rows is dealt to as many tasks as it needs. Which
    cells are cut changes no pair.
    """
    cells = [*on, "_level", "_cell"]
    sized = spans.withColumn("_level", _level(high - low))
    levels = _levels(sized)
    at = lambda df: df.withColumn("_level", F.explode(levels)).withColumn("_cell", _cell(F.col(x)))
    counts = [df.select(*cells, F.lit(n).alias("_n"), F.lit(m).alias("_m")) for df, n, m in ((at(points.sample(share, seed=1)), 1, 0), (_dealt(sized.sample(share, seed=2), low, high), 0, 1))]
    slices = [F.greatest(F.ceil(F.sum(c) / (share * crowded)), F.lit(1)).cast("int") for c in ("_n", "_m")]
    often = small(counts[0].unionByName(counts[1]).groupBy(*cells).agg(F.ceil(slices[0] / 8).cast("int").alias("_points"), slices[1].alias("_spans"), (slices[0] > 1).alias("_many")).where("_many or _spans > 1").drop("_many"))

    def own(df: DataFrame, n: str) -> Column:
        plain = [f.name for f in df.schema if not isinstance(f.dataType, ArrayType | MapType | StructType)]
        return F.pmod(F.xxhash64(*plain), F.coalesce(n, F.lit(1))).cast("int")

    def part(v: Column) -> Column:
        eighth = F.floor((v / F.pow(F.lit(2.0), F.col("_level")) - F.col("_cell")) * 8).cast("int")
        return F.when(F.col("_points").isNotNull(), F.least(F.greatest(eighth, F.lit(0)), F.lit(7))).otherwise(0)

    every = lambda n: F.explode(F.sequence(F.lit(0), F.coalesce(n, F.lit(1)) - 1))
    ours = _dealt(sized, low, high).join(often, cells, "left").withColumn("_b", own(spans, "_spans")).withColumn("_part", F.explode(F.sequence(part(low), part(high)))).withColumn("_a", every("_points"))
    others = at(points).join(often, cells, "left").withColumn("_part", part(F.col(x))).withColumn("_a", own(points, "_points")).withColumn("_b", every("_spans"))
    keys, n = [*cells, "_part", "_a", "_b"], int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Pairs, not bytes, are the work: the number of partitions is given, so that small sides aren't put together in a few tasks.
    sides = [df.drop("_points", "_spans").repartition(n, *keys) for df in (ours, others)]
    return sides[0].join(sides[1], keys).drop("_level", "_cell", "_part", "_a", "_b")


def in_bands(points: DataFrame, x: str, bands: DataFrame, on: Sequence[str] = (), slack: float = 0.15, crowded: int = CROWDED) -> DataFrame:
    """Each point with every band (left, right) that holds it within `slack`; a point may lie in two. With `on` columns these are equal, too.

    For sides of any size and bands of any width: a band lies in cells of the next power of two of its width, a point in one cell of each such size that occurs; the join is on size and cell, and
    crowded cells are dealt to several tasks.
    """
    low, high = F.col("left") - slack, F.col("right") + slack
    met = _near(points, x, bands.where(low <= high), low, high, on, crowded).where((F.col(x) >= low) & (F.col(x) <= high))
    return met.select(*on, *[c for c in (*points.columns, *bands.columns) if c not in on])


def range_join(points: DataFrame, x: str, spans: DataFrame, width: float, slack: float = 0.0, on: Sequence[str] = ()) -> DataFrame:
    """Each point with every span (left, right) that holds it within `slack`, for large sides: spans are dealt to all cells of `width` that they touch, points to one, and the
    join is on the cell and the `on` columns."""
    cell = lambda c: F.floor(c / width).cast("long")
    dealt = spans.where(F.col("left") - slack <= F.col("right") + slack).withColumn("_cell", F.explode(F.sequence(cell(F.col("left") - slack), cell(F.col("right") + slack))))
    met = points.withColumn("_cell", cell(F.col(x))).join(dealt, [*on, "_cell"])
    return met.where((F.col(x) >= F.col("left") - slack) & (F.col(x) <= F.col("right") + slack)).drop("_cell")


def words_in_cells(words: DataFrame, cells: DataFrame, on: Sequence[str], slack: float = 0.6, width: float = 50.0) -> DataFrame:
    """Each word (x0, x1, top, bottom) with every cell (left, right, upper, lower) of the same `on` columns that holds its middle within `slack` on both axes. The join is on the `on`
    columns and on strips of `width`, so a page or sheet of any number of words is not one group."""
    middle = words.withColumn("_x", (F.col("x0") + F.col("x1")) / 2).withColumn("_y", (F.col("top") + F.col("bottom")) / 2)
    met = range_join(middle, "_x", cells, width, slack, on)
    return met.where((F.col("_y") >= F.col("upper") - slack) & (F.col("_y") <= F.col("lower") + slack)).drop("_x", "_y")


def line_envelopes(words: DataFrame, line: Sequence[str]) -> DataFrame:
    """(line, x0, top, x1, bottom, text, n_words): the box around the words of each line, and their texts from left to right."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "top", "text"))), lambda w: w["text"]), " ")
    return words.groupBy(*line).agg(F.min("x0").alias("x0"), F.min("top").alias("top"), F.max("x1").alias("x1"), F.max("bottom").alias("bottom"), text.alias("text"), F.count("*").alias("n_words"))


def overlapping(left: DataFrame, right: DataFrame, on: Sequence[str], least: float = 0.1) -> DataFrame:
    """Pairs with equal `on` columns whose spans (left, right and other_left, other_right) share more than `least` (0 or more), each once.

    For sides, groups and widths of any size: a span has the next power of two of its width as its level. Two spans meet in the cells of the wider one's level, of which each touches two at most,
    and count in the cell that holds the greater left end. Narrow spans never meet in a wide cell, so candidates stay in proportion to the pairs. Spans with a null end share nothing.
    """
    if least < 0:
        raise ValueError("least must be 0 or more")
    sides = []
    for df, a, b in ((left, "left", "right"), (right, "other_left", "other_right")):
        sides.append((df.where(F.col(b) - F.col(a) > least).withColumn("_level", _level(F.col(b) - F.col(a))), F.col(a), F.col(b)))
    (ours, a, b), (others, c, d) = sides
    own_levels, other_levels = _levels(ours), _levels(others)

    def raised(df: DataFrame, levels: Column, equal: bool) -> DataFrame:
        """The rows on each of `levels` above their own (or equal to it)."""
        above = F.filter(levels, lambda m: (m >= F.col("_level")) if equal else (m > F.col("_level")))
        return df.withColumn("_level", F.explode(above))

    keys = [*on, "_level", "_cell"]
    wide_left = _dealt(ours, a, b).join(_dealt(raised(others, own_levels, True), c, d), keys)
    wide_right = _dealt(raised(ours, other_levels, False), a, b).join(_dealt(others, c, d), keys)
    met = wide_left.unionByName(wide_right).where(F.col("_cell") == _cell(F.greatest(a, c)))
    return met.drop("_level", "_cell").withColumn("shared", overlap(a, b, c, d)).where(F.col("shared") > least)


def own_overlaps(spans: DataFrame, key: str, on: Sequence[str], least: float = 0.1, crowded: int = CROWDED) -> DataFrame:
    """(on, key, other, shared): the pairs of a table's own spans (left, right) with equal `on` columns that share more than `least` (0 or more), key less than other.

    Two spans meet where the one that starts first holds the other's left end, so a row goes out as a span at its own level and as a point, and a pair is looked at once. Otherwise as overlapping(),
    but for crowded cells, which are dealt to several tasks.
    """
    if least < 0:
        raise ValueError("least must be 0 or more")
    kept = spans.where(F.col("right") - F.col("left") > least).where(F.col(key).isNotNull())
    ours = kept.select(*on, F.col(key).alias("_own"), F.col("left").alias("_l"), F.col("right").alias("_r"))
    points = kept.select(*on, F.col(key).alias("_other"), F.col("left").alias("_x"), F.col("right").alias("_y"))
    a, b, start, end, x, y = (F.col(c) for c in ("_own", "_other", "_l", "_r", "_x", "_y"))
    met = _near(points, "_x", ours, start, end, on, crowded).where((x >= start) & (F.least(end, y) - x > least) & F.when(x > start, a != b).otherwise(a < b))
    return met.select(*on, F.least(a, b).alias(key), F.greatest(a, b).alias("other"), (F.least(end, y) - x).alias("shared"))


def nearest_band(x: Column, bands: Sequence[tuple[int, float, float]]) -> Column:
    """The band (number, left, right) nearest to x: 0 inside, the first of equally near ones."""
    near = F.array(*[F.struct(F.round(span_distance(x, F.lit(a), F.lit(b)), 9).alias("distance"), F.lit(n).alias("band")) for n, a, b in bands])
    return F.array_min(near)["band"]


def bounds(df: DataFrame, group: Sequence[str], x: Column) -> DataFrame:
    """(group, left, right): the least and the largest, 0 and 1 where there is none."""
    return df.groupBy(*group).agg(F.coalesce(F.min(x), F.lit(0.0)).alias("left"), F.coalesce(F.max(x), F.lit(1.0)).alias("right"))


def top_recent(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of each group."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= n)
