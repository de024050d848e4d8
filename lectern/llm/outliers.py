"""Quality rules (operator 11): counts of each text, and robust multivariate outliers by minimum covariance determinants; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.llm.common import cut, small, text_column, written
from lectern.llm.srs import chi_square_below, chi_square_quantile

WORD = r"[^\x20\x09-\x0D]"
SPACE = r"[\x20\x09-\x0D]+"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Transformed statistics are whole numbers, thousandths of their unit, so that sums are exact in any order.
UNIT = 1000
#: Standard deviation that every statistic has at least, in its unit: added to each estimate, so that none is singular and a statistic that is constant in a group has a scale.
LEAST_SPREAD = (0.05, 0.1, 0.1, 0.1, 0.5)


def let(value: Column, body) -> Column:
    """body(value), the value computed once, wherever body uses it inside of lambdas."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, n: int = 3) -> Column:
    """How many of an array's words lie in runs of n words that are found twice or more, first ones included. Runs are told apart by 64-bit hashes.

    Where hashes repeat, they are sorted with their places, and those next to an equal one repeat. Over their places in order, each run adds the words that it doesn't share with the next.
    """
    last = F.size(words) - n
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(n)]))

    def places(s: Column) -> Column:
        hit = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
        return F.sort_array(F.transform(hit, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        return F.aggregate(F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))), lambda a, b: F.coalesce(F.least(b - a, F.lit(n)), F.lit(n))), F.lit(0), lambda s, x: s + x)

    def found(h: Column) -> Column:
        by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(let(by_hash, places), covered))

    return F.when(last >= 0, let(runs, found)).otherwise(0)


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of the whole text (longs; null is no text)."""
    body = text_column(text)
    words = F.filter(F.split(body, SPACE), lambda w: w != "")
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(WORD))
    return docs.select(
        "*",
        let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words"))).alias("_words"),
        F.length(F.translate(body, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ).select("*", F.col("_words.n_words").alias("n_words"), F.col("_words.n_repeat_words").alias("n_repeat_words")).drop("_words")


def statistics() -> list[Column]:
    """The transformed statistics: log of the mean word length, roots of symbols, repeated lines and repeated words a word, log of the number of words."""
    rate = lambda c: F.sqrt(F.col(c) / F.col("n_words"))
    found = [F.log(F.col("word_chars") / F.col("n_words")), rate("n_symbols"), rate("n_dup_lines"), rate("n_repeat_words"), F.log(F.col("n_words"))]
    return [F.round(x * UNIT).cast("long") for x in found]


def distances(rows: DataFrame, p: int) -> DataFrame:
    """`rows` with d2, the squared Mahalanobis distance of x0.. from the mean m0.. under the Cholesky factor l00.., by forward substitution."""
    for i in range(p):
        rest = sum((F.col(f"l{i}{k}") * F.col(f"y{k}") for k in range(i)), F.lit(0.0))
        rows = rows.withColumn(f"y{i}", (F.col(f"x{i}") - F.col(f"m{i}") - rest) / F.col(f"l{i}{i}"))
    return rows.withColumn("d2", sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(p)), F.lit(0.0)))


def moments(p: int) -> list[Column]:
    """Count, sums and sums of products of x0.., exact."""
    exact = lambda c: F.sum(c.cast("decimal(38,0)"))
    x = [F.col(f"x{i}") for i in range(p)]
    return [F.count("*").alias("n"), *[exact(x[i]).alias(f"s{i}") for i in range(p)], *[exact(x[i] * x[j]).alias(f"q{i}{j}") for i in range(p) for j in range(i + 1)]]


def factored(sums: DataFrame, keys: Sequence[str], scale: float, spread: Sequence[float]) -> DataFrame:
    """Means m0.., Cholesky factor l00.. and log_det of scale * covariance + diag(spread ** 2), from n, s0.., q00.. of each key."""
    p = len(spread)
    n = F.col("n").cast("double")
    mean = [(F.col(f"s{i}") / F.col("n")).cast("double").alias(f"m{i}") for i in range(p)]
    own = [
        (scale * ((F.col(f"q{i}{j}") * F.col("n") - F.col(f"s{i}") * F.col(f"s{j}")).cast("double") / (n * n)) + (F.lit((spread[i] * UNIT) ** 2) if i == j else F.lit(0.0))).alias(f"c{i}{j}")
        for i in range(p)
        for j in range(i + 1)
    ]
    out = sums.select(*keys, *mean, *own)
    for j in range(p):  # a column of the factor at a time, as the next ones need it
        left = [F.col(f"c{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0)) for i in range(j, p)]
        out = out.select("*", F.sqrt(left[0]).alias(f"l{j}{j}"), *[(x / F.sqrt(left[0])).alias(f"l{i}{j}") for i, x in enumerate(left[1:], j + 1)])
    return out.withColumn("log_det", sum((F.log(f"l{i}{i}") for i in range(p)), F.lit(0.0))).drop(*[f"c{i}{j}" for i in range(p) for j in range(i + 1)])


def concentrated(points: DataFrame, estimates: DataFrame, p: int, share: float, keys: Sequence[str]) -> DataFrame:
    """The moments of the `share` of each pool's points that lie nearest to each of its estimates: one concentration step.

    Points are counted, and added up, by distance in steps of 1/32 of an octave of 1 + d2; the step that holds the point at the edge counts in whole.
    """
    rows = distances(points.join(small(estimates), "pool"), p).withColumn("step", F.floor(32 * F.log2(1 + F.col("d2"))))
    by_step = rows.groupBy(*keys, "step").agg(*moments(p))
    upto = Window.partitionBy(*keys).orderBy("step")
    names = ["n", *[f"s{i}" for i in range(p)], *[f"q{i}{j}" for i in range(p) for j in range(i + 1)]]
    run = by_step.select(*keys, "step", F.sum("n").over(Window.partitionBy(*keys)).alias("whole"), *[F.sum(c).over(upto).alias(c) for c in names])
    enough = run.where(F.col("n") >= F.ceil(F.col("whole") * share)).withColumn("first", F.row_number().over(upto))
    return enough.where("first = 1").select(*keys, *names)


def determinants(points: DataFrame, p: int, share: float, starts: int, first_steps: int, steps: int, spread: Sequence[float], seed: int) -> DataFrame:
    """(pool, m0.., l00..): minimum-covariance-determinant estimates of each pool's points, reweighted once.

    Each start takes p + 1 points of the pool in the order of a hash; all starts do the first concentration steps, the one with the smallest determinant goes on.
    Every estimate is made consistent for normal points and has the least spread added.
    """
    edge = chi_square_quantile(share, p)
    scale = share / chi_square_below(edge, p + 2)
    by_hash = Window.partitionBy("pool").orderBy(F.xxhash64(F.lit(seed), *[f"x{i}" for i in range(p)]), *[f"x{i}" for i in range(p)])
    drawn = points.withColumn("turn", F.row_number().over(by_hash)).where(F.col("turn") <= starts * (p + 1))
    drawn = drawn.withColumn("start", F.floor((F.col("turn") - 1) / (p + 1)).cast("int"))
    found = cut(factored(drawn.groupBy("pool", "start").agg(*moments(p)), ["pool", "start"], 1.0, spread))
    for _ in range(first_steps):
        found = cut(factored(concentrated(points, found, p, share, ["pool", "start"]), ["pool", "start"], scale, spread))
    best = Window.partitionBy("pool").orderBy("log_det", "start")
    found = cut(found.withColumn("place", F.row_number().over(best)).where("place = 1").drop("place", "start"))
    for _ in range(steps):
        found = cut(factored(concentrated(points, found, p, share, ["pool"]), ["pool"], scale, spread))
    near = chi_square_quantile(0.975, p)
    inside = distances(points.join(small(found), "pool"), p).where(F.col("d2") <= near).groupBy("pool").agg(*moments(p))
    return cut(factored(inside, ["pool"], 0.975 / chi_square_below(near, p + 2), spread))


def quality_rules(
    docs: DataFrame, by: Sequence[str] = ("lang", "source"), text: str = "text", key: str = "doc_id", share: float = 0.75, confidence: float = 0.9999, least_points: int = 50, starts: int = 12, first_steps: int = 2, steps: int = 4, spread: Sequence[float] = LEAST_SPREAD, seed: int = 0
) -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept), a row for each row of `docs`.

    base_failed: fewer than 50 words, or more than half of the words in three-word runs that repeat. Of the others, those are kept whose squared Mahalanobis distance is at most the chi-square
    quantile of `confidence`; `distance` is null where there was nothing to judge by, and for base_failed.

    Statistics are those of statistics(). Estimates are made for each (lang, source), of distinct vectors, so that copies count once. A pool with under `least_points` of them joins its
    language's small pools, these if still under it the small pools of all languages; where these too are few, every row is kept. A null language or source is a value of its own.
    A null or empty text has no words and fails the base rules. Repeated rows share their fate. An empty table gives an empty result. Other columns are left out.

    Texts are read once, each in its row, and the counts written as a narrow table; every step after is a pass over that. Nothing but estimates, a row a pool and start, is broadcast, if they are few.
    """
    p = len(spread)
    rows = docs.select(F.col(key).alias("id"), text_column(text).alias("body"), *[F.col(c).alias(f"g{i}") for i, c in enumerate(by)])
    counted = counts(rows, "body").drop("body")
    counted = counted.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    counted = counted.select("*", *[F.when(~F.col("base_failed"), x).alias(f"x{i}") for i, x in enumerate(statistics())])
    levels = [F.to_json(F.struct(F.lit(len(by) - n).alias("level"), *[f"g{i}" for i in range(len(by) - n)])) for n in range(len(by) + 1)]
    counted = written(counted.select("*", *[x.alias(f"level{i}") for i, x in enumerate(levels)]).drop(*[f"g{i}" for i in range(len(by))]))
    x = [f"x{i}" for i in range(p)]
    points = counted.where("not base_failed").groupBy(*[f"level{i}" for i in range(len(levels))], *x).agg(F.lit(1).alias("one"))
    points = written(points.drop("one"))
    chosen = cut(points.groupBy(*[f"level{i}" for i in range(len(levels))]).count())
    chosen = chosen.withColumn("pool", F.when(F.col("count") >= least_points, F.col("level0")))
    for i in range(1, len(levels)):
        left = chosen.where("pool is null").groupBy(f"level{i}").agg(F.sum("count").alias("left")).where(F.col("left") >= least_points)
        chosen = chosen.join(left, f"level{i}", "left").withColumn("pool", F.coalesce("pool", F.when(F.col("left").isNotNull(), F.col(f"level{i}")))).drop("left")
    chosen = small(cut(chosen.where("pool is not null").select("level0", "pool")))
    found = determinants(points.join(chosen, "level0").select("pool", *x), p, share, starts, first_steps, steps, spread, seed)
    judged = distances(counted.join(chosen, "level0", "left").join(small(found), "pool", "left"), p)
    far = F.when(F.col("base_failed"), None).otherwise(F.round("d2", 6))
    kept = ~F.col("base_failed") & F.coalesce(far <= chi_square_quantile(confidence, p), F.lit(True))
    return judged.select(F.col("id").alias(key), *BASE, "base_failed", far.alias("distance"), kept.alias("kept"))
