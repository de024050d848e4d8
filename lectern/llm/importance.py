"""Quality classifier (operator 1): importance resampling with hashed n-gram models, sampled by Gumbel top-k."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.llm.common import cut, given_back, lowered, mix, set_aside, slices, span_hashes, text_buffer, text_column, words, written

_U = np.uint64
#: The columns that the operator adds; an input's own columns of these names are replaced.
OWN = ("n_grams", "log_weight", "gumbel_key", "keep")


def grams(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each word and of each pair of neighbouring words (ASCII letters in lower case), and the row that each belongs to."""
    start, end, before = words(data, offsets)
    hashes = span_hashes(lowered(data), start, end)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
    pair = mix(hashes[:-1] * _U(0x9FB21C651E98DF25) + hashes[1:])
    same = row[:-1] == row[1:]
    return np.concatenate([hashes % _U(buckets), pair[same] % _U(buckets)]).astype(np.int64), np.concatenate([row, row[:-1][same]])


def count_models(docs: DataFrame, target: DataFrame, buckets: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(bucket, raw, target): n-gram counts over all documents, and over those with a key in `target` (a bounded table, which is broadcast). Every task adds up its own before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in slices(batches):
            bucket, row = grams(*text_buffer(batch.column(0)), buckets)
            raw += np.bincount(bucket, minlength=buckets)
            good += np.bincount(bucket[batch.column(1).to_numpy(zero_copy_only=False)[row]], minlength=buckets)
        there = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(raw[there]), pa.array(good[there])], ["bucket", "raw", "target"])

    chosen = F.broadcast(target.select(F.col(key).alias("_key")).distinct().withColumn("_good", F.lit(True)))
    marked = docs.select(F.col(key).alias("_key"), text_column(text).alias("text")).join(chosen, "_key", "left")
    counts = marked.select("text", F.coalesce("_good", F.lit(False)).alias("good")).mapInArrow(count, "bucket int, raw long, target long")
    return counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(models: DataFrame, buckets: int, smoothing: float = 1.0) -> np.ndarray:
    """log target probability minus log raw probability of each bucket. `models` has a row per bucket at most."""
    raw, good = np.zeros(buckets), np.zeros(buckets)
    for bucket, a, b in models.collect():
        raw[bucket], good[bucket] = a, b
    if not good.sum():
        return np.zeros(buckets)
    return np.log((good + smoothing) / (good.sum() + smoothing * buckets)) - np.log((raw + smoothing) / (raw.sum() + smoothing * buckets))


def importance(docs: DataFrame, ratios: np.ndarray, seed: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with n_grams, log_weight (sum of its n-grams' log ratios) and gumbel_key (log_weight plus Gumbel noise that depends on seed and key only)."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios.astype(np.float64))
    names = [c for c in docs.columns if c not in OWN]
    rows = set_aside(docs.select(*[F.col(f"`{c}`") for c in names]), key, text)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            bucket, row = grams(*text_buffer(batch.column(1).fill_null("")), len(shared.value))
            total = np.bincount(row, shared.value[bucket], batch.num_rows)
            n = np.bincount(row, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64()), pa.array(total.astype(float))], ["id", "body", "others", "n_grams", "log_weight"])

    kinds = [rows.schema[c].dataType.simpleString() for c in (key, text, "others")]
    scored = rows.mapInArrow(score, "id {}, body {}, others {}, n_grams long, log_weight double".format(*kinds)).withColumnsRenamed({"id": key, "body": text})
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 11) + 0.5) / float(2**53)
    return scored.select(*given_back(scored, names, key, text), "n_grams", "log_weight", (F.col("log_weight") - F.log(-F.log(uniform))).alias("gumbel_key"))


def top_k(scored: DataFrame, k: int, by: str = "gumbel_key", key: str = "doc_id") -> Column:
    """The condition that a row is among the k with the largest `by` (to 6 decimals; ties to the smaller key; rows equal in both share their fate), found without a global sort.

    Each pass counts rows in 65,536 equal parts of the range that holds the kth value and goes on with one part, so the
    driver gets at most that many counts.
    """
    number = F.round(F.col(by) * 1_000_000).cast("long")
    low, high = scored.agg(F.min(number), F.max(number)).first()
    if low is None or k <= 0:
        return F.lit(False)
    while low < high:
        width = (high - low) // 65536 + 1
        inside = scored.select(number.alias("n")).where(F.col("n").between(low, high))
        counts = dict(inside.groupBy(F.expr(f"(n - {low}) div {width}")).count().collect())
        for slot in sorted(counts, reverse=True):
            if counts[slot] >= k:
                break
            k -= counts[slot]
        low, high = low + slot * width, min(high, low + (slot + 1) * width - 1)
    # Rows that share a number to 6 decimals differ in key by chance only, so their keys are few; rows of one key are counted first.
    ties = scored.where(number == low).groupBy(key).count()
    upto = F.sum("count").over(Window.orderBy(F.asc_nulls_first(key)))
    last = ties.select(key, (upto - F.col("count")).alias("earlier")).where(F.col("earlier") < k).agg(F.max(key)).first()[0]
    return (number > low) | ((number == low) & (F.col(key).isNull() if last is None else F.coalesce(F.col(key) <= last, F.lit(True))))


def wanted_rows(labels: DataFrame, n: int) -> int:
    """How many of n documents to take: the share of good ones among the labels (_good), and a standard error more, as a good document lost weighs more than a bad one kept."""
    found = labels.agg(F.count("*"), F.sum(F.col("_good").cast("long"))).first()
    labelled, good = found[0], found[1] or 0
    if not 0 < good < labelled:
        return n
    share = good / labelled
    return min(n, math.ceil(n * (share + math.sqrt(share * (1 - share) / labelled))))


def fitted(docs: DataFrame, labels: DataFrame, k: int | None, buckets: int, most_labels: int, seed: int, key: str, text: str, quality: str) -> tuple[DataFrame, Column, np.ndarray]:
    """(scores, keep, ratios): (key, n_grams, log_weight, gumbel_key) of every row, the condition to be in the sample, and the models' ratios."""
    known = labels.where(F.col(key).isNotNull() & F.col(quality).isNotNull()).groupBy(key).agg(F.min(F.col(quality) == 1).alias("_good")).withColumn("_turn", F.xxhash64(F.lit(seed), key))
    held_out, own = known.where("pmod(_turn, 5) = 0"), known.where("pmod(_turn, 5) > 0")
    taken = cut(own.orderBy("_turn", key).limit(most_labels))
    ratios = log_ratios(count_models(docs, taken.where("_good"), buckets, key, text), buckets)
    scores = written(importance(docs.select(key, text), ratios, seed, key, text).drop(text))
    n = scores.count()
    return scores, top_k(scores, min(n, wanted_rows(held_out, n) if k is None else k), key=key), ratios


def resampled(docs: DataFrame, labels: DataFrame, k: int | None = None, buckets: int = 10_000, most_labels: int = 20_000, seed: int = 0, key: str = "doc_id", text: str = "text", quality: str = "quality") -> DataFrame:
    """(key, n_grams, log_weight, gumbel_key, keep), a row for each row of `docs`: whether it is among the k of the Gumbel top-k sample.

    The target model counts the documents labelled 1 among `most_labels` labels at most (those with the smallest hash of the key), the raw model all documents. k is given, or
    the share of documents labelled 1 among all labels that the model doesn't see, a fifth of them, and a standard error. Without labels of both kinds every row is kept.
    A null or empty text has no n-grams and weight 0; a null key gets noise like any other; repeated rows share their fate, also where the kth is one of them. Other columns are left out.
    Texts are hashed twice, to count and to score.
    """
    scores, keep, _ = fitted(docs, labels, k, buckets, most_labels, seed, key, text, quality)
    return scores.withColumn("keep", keep)


def classify(docs: DataFrame, labels: DataFrame, k: int | None = None, buckets: int = 10_000, most_labels: int = 20_000, seed: int = 0, key: str = "doc_id", text: str = "text", quality: str = "quality") -> DataFrame:
    """`docs` with n_grams, log_weight, gumbel_key and keep of resampled(), for callers that go on with the texts: these are scored once more, which costs less than to shuffle them to their scores. Columns of these four names are replaced."""
    _, keep, ratios = fitted(docs, labels, k, buckets, most_labels, seed, key, text, quality)
    return importance(docs, ratios, seed, key, text).withColumn("keep", keep)
