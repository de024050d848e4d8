"""N-gram Jaccard join (operator 8): adaptive multi-match prefixes over word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.llm.common import cut, forget, lowered, mix, slices, small, span_hashes, text_buffer, text_column, words, written
from lectern.llm.components import components

_U = np.uint64


def shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-word shingles of each row as 64-bit hashes, sorted, and the count of each row. ASCII letters count as lower case; fewer than n words are one shingle."""
    start, end, before = words(data, offsets)
    w = span_hashes(lowered(data), start, end)
    counts = np.diff(before)
    row = np.repeat(np.arange(len(counts)), counts)
    total = np.zeros(max(0, len(w) - n + 1), np.uint64)
    for i in range(n):
        total += mix(w[i : len(w) - n + 1 + i] * _U(0x9E3779B97F4A7C15 + 2 * i))
        total *= _U(0xD6E8FEB86659FD93)
    whole = row[: len(total)] == row[n - 1 :] if len(total) else np.zeros(0, bool)
    value, owner = [mix(total)[whole]], [row[: len(total)][whole]]
    for r in np.flatnonzero((counts > 0) & (counts < n)):
        h = _U(n)
        for x in w[before[r] : before[r + 1]]:
            h = mix(np.array([h], np.uint64) * _U(0xC2B2AE3D27D4EB4F) + x)[0]
        value.append(np.array([h], np.uint64))
        owner.append(np.array([r]))
    value, owner = np.concatenate(value).view(np.int64), np.concatenate(owner)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.bincount(owner[new], minlength=len(counts))


#: 64-bit words of a set's bitmap, and of its short form, in which bits FOLDED * 64 places apart are put together.
MAP_WORDS, FOLDED = 16, 8
_MAP, _SHORT = [f"m{i}" for i in range(MAP_WORDS)], [f"f{i}" for i in range(FOLDED)]


def bitmaps(value: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each row MAP_WORDS 64-bit words; a bit says whether an odd number of its shingles hash to it. Two maps differ in no more bits than the sets differ in shingles."""
    bits = 64 * MAP_WORDS
    place = np.repeat(np.arange(len(counts)), counts) * bits + (mix(value.view(np.uint64) ^ _U(0x94D049BB133111EB)) % _U(bits)).astype(np.int64)
    odd = (np.bincount(place, minlength=bits * len(counts)) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(len(counts), bits), axis=1).view(np.int64)


def folded() -> list:
    """The short form of a bitmap, which has the same property."""
    return [F.expr(" ^ ".join(_MAP[i::FOLDED])).alias(f"f{i}") for i in range(FOLDED)]


def bits_apart(words: list[str]) -> str:
    return "(" + " + ".join(f"bit_count({m} ^ o_{m})" for m in words) + ")"


def maybe_similar(num: int, den: int, words: list[str]) -> str:
    """SQL: the sizes and bitmaps of two sets allow a similarity of num / den."""
    sizes = f"least(size, other_size) * {den} >= greatest(size, other_size) * {num}"
    return f"{sizes} and (size + other_size - {bits_apart(words)}) * {num + den} >= 2 * {num} * (size + other_size)"


def likely_similar(num: int, den: int, words: list[str]) -> str:
    """SQL: the estimate of the similarity by the bitmaps is num / den or more."""
    bits = 64 * len(words)
    sets = f"(ln(greatest(1.0 - 2.0 * {bits_apart(words)} / {bits}, 0.01)) / ln(1.0 - 2.0 / {bits}))"  # shingles in which the sets differ
    return f"(size + other_size - {sets}) * {den} >= (size + other_size + {sets}) * {num}"


def packed(value: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Each row's sorted hashes as little-endian bytes."""
    offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(8 * counts, out=offsets[1:])
    order = np.lexsort((value.view(np.uint64), np.repeat(np.arange(len(counts)), counts)))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(value.view("<u8")[order].tobytes())]).cast(pa.binary())


def shared_needed(a, b, num: int, den: int):
    """The least intersection of sets of sizes a and b with den * intersection >= num * union."""
    return -(-num * (a + b) // (num + den))


def adaptive_prefix(cost: np.ndarray, least: int, most: int, verify: float) -> int:
    """The number l of shared tokens to ask for, from 1 to `most`: the one with the least estimated cost.

    `cost` holds the estimated lengths of the posting lists of the record's tokens in the global order, `least` the length of the
    prefix for l = 1. A prefix for l reads its lists; at most their sum over l candidates share l tokens and are verified.
    """
    best, at, lists = np.inf, 1, float(cost[:least].sum())
    for need in range(1, most + 1):
        if need > 1:
            if least + need - 1 > len(cost):
                break
            lists += float(cost[least + need - 2])
        price = lists + verify * lists / need
        if price < best:
            best, at = price, need
    return at


#: Buckets of the frequency estimate in one row.
CHUNK = 4096


def total_counts(chunks: DataFrame, buckets: int) -> np.ndarray:
    """The sum of the tasks' bucket counts, from rows (chunk, counts as 32-bit integers); `buckets` is fixed, whatever the corpus."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sums[c] = sums.get(c, 0) + np.frombuffer(data.as_buffer(), "<u4").astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["chunk", "counts"])

    out = np.zeros(buckets, np.float32)
    for c, data in chunks.repartition("chunk").mapInArrow(add, "chunk long, counts binary").collect():
        out[c * CHUNK : (c + 1) * CHUNK] = np.frombuffer(bytes(data), np.float64)
    return out


def jaccard_components(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5, key: str = "doc_id", text: str = "text", most_needed: int = 4, merges: int = 3, buckets: int = 1 << 20, crowd: int = 100_000) -> DataFrame:
    """One row per row of `docs`: key, n_shingles, component_id (the smallest key reachable by links of similarity >= num / den, itself included).

    A document's set is its distinct n-word shingles; fewer words are one shingle; no words or a null text is the empty set,
    linked with nothing. Keys are integers; a null key gets no component but its own null; rows with the same key are one node
    and their n_shingles are each row's own. An empty table gives an empty result; other columns are left out.

    1. Documents with the same set join at once and one of them goes on.
    2. Shingles are ordered by the load of their hash bucket, which bounds their frequency from above, then by hash. A record asks for l shared tokens and gives out the prefix for l, l chosen
       by estimated cost: two records that ask for l and l' and are similar share min(l, l') prefix tokens or more.
    3. In each token's list neighbours by size, and each record with the one whose tokens are best known to others (in a group of near copies the one with the
       fewest changes), are proposed if their components differ; the most alike pair a component is verified if the bitmaps make it likely, and those found similar grow
       into components; this goes on while links grow by 2 % or more, `merges` times at most. A list expected to exceed `crowd` is dealt to several tasks, anew each time.
    4. Of all pairs in a list, only those of different components are made: records outside the list's largest component meet the whole list.
       Pairs that share enough tokens are verified. No link between components is lost.
    Sizes and short bitmaps bound a pair's similarity from above where it is made, full bitmaps once for each pair left; sets, as 64-bit hashes, are only fetched for pairs that pass.
    """
    kind = docs.schema[key].dataType
    base = docs.select(F.col(key).cast("long").alias("key"), text_column(text).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.zeros(buckets, np.uint32)
        for batch in slices(batches, 1):
            value, counts = shingles(*text_buffer(batch.column(1)), n)
            at, times = np.unique(value.view(np.uint64) % _U(buckets), return_counts=True)
            often[at] = np.minimum(often[at] + times, (1 << 32) - 1)
            signs = []
            for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(value.view(np.uint64) + _U(salt)))])
                at = np.concatenate([np.zeros(1, int), np.cumsum(counts)])
                signs.append((sums[at[1:]] - sums[at[:-1]]).view(np.int64))
            maps = bitmaps(value, counts)
            nothing = pa.nulls(batch.num_rows, pa.int64()), pa.nulls(batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), *map(pa.array, signs), *(pa.array(maps[:, i]) for i in range(MAP_WORDS)), *nothing], names)
        parts = [often[a : a + CHUNK].astype("<u4").tobytes() for a in range(0, buckets, CHUNK)] if often.any() else []
        empty = [pa.nulls(len(parts), pa.int64())] * (4 + MAP_WORDS)
        yield pa.RecordBatch.from_arrays([*empty, pa.array(range(len(parts)), pa.int64()), pa.array(parts, pa.binary())], names)

    # One pass gives each document's set in short, and each task's counts of all its shingles in rows of their own (`chunk` is not null).
    names = ["key", "size", "s1", "s2", *_MAP, "chunk", "counts"]
    passed = written(base.mapInArrow(sign, ", ".join(f"{c} long" for c in names[:-1]) + ", counts binary"))
    signed = passed.where("chunk is null").drop("chunk", "counts")
    filled = signed.where("size > 0 and key is not null")
    groups = cut(filled.groupBy("size", "s1", "s2").agg(F.min("key").alias("rep"), F.count("*").alias("copies")).where("copies > 1").drop("copies"))
    same = cut(filled.join(groups, ["size", "s1", "s2"]).where("key <> rep").select(F.col("rep").alias("a"), F.col("key").alias("b")))
    # Rows of one id with different texts may be copies of different groups; such an id goes on if one of its rows does.
    copied = small(cut(same.groupBy(F.col("b").alias("key")).count().join(filled.groupBy("key").count().withColumnRenamed("count", "rows"), "key").where("count = rows").select("key")))

    spark = docs.sparkSession
    frequency = spark.sparkContext.broadcast(total_counts(passed.where("chunk is not null").select("chunk", "counts"), buckets))  # 4 * buckets bytes

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, met = frequency.value, {}
        usual = float(np.median(often[often > 0])) if (often > 0).any() else 0.0
        typical = usual + 3 * usual**0.5
        for batch in slices(batches, 1):
            value, counts = shingles(*text_buffer(batch.column(1)), n)
            at = np.concatenate([np.zeros(1, int), np.cumsum(counts)])
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(value.view(np.uint64)))])
            keys = batch.column(0).to_numpy()
            for r, sign in enumerate((sums[at[1:]] - sums[at[:-1]]).tolist()):
                if met.setdefault(sign, keys[r]) < keys[r]:  # an equal set with a smaller key was met in this task
                    counts[r] *= -1
            if len(met) > 1 << 16:
                met.clear()
            value = value[np.repeat(counts > 0, np.abs(counts))]
            counts = np.maximum(counts, 0)
            load = often[value.view(np.uint64) % _U(buckets)]
            owner = np.repeat(np.arange(len(counts)), counts)
            order = np.lexsort((value, load, owner))
            value, load = value[order], load[order]
            estimate = np.maximum(load - typical, 1)  # what stands out of a bucket's usual load
            at = np.concatenate([np.zeros(1, int), np.cumsum(counts)])
            take, needed, lengths = [], [], []
            for r, size in enumerate(counts):
                if not size:
                    lengths.append(0)
                    needed.append(1)
                    continue
                least = int(size - -(-num * int(size) // den) + 1)
                need = adaptive_prefix(estimate[at[r] : at[r + 1]], least, min(most_needed, int(size) - least + 1), 0.2)
                take.append(np.arange(at[r], at[r] + least + need - 1))
                needed.append(need)
                lengths.append(least + need - 1)
            lengths = np.array(lengths)
            take = np.concatenate(take) if take else np.zeros(0, int)
            owner_key = np.repeat(keys, lengths)
            tasks = np.floor(estimate[take] / crowd).astype(np.int64)  # 0: one task has the whole list
            part = np.where(tasks > 0, 1 + (mix(owner_key.astype(np.uint64)) % np.maximum(tasks, 1).astype(np.uint64)).astype(np.int64), 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(value[take]), pa.array(part.astype(np.int32)), pa.array(owner_key, pa.int64()), pa.array(np.repeat(counts, lengths).astype(np.int32)), pa.array(np.repeat(needed, lengths).astype(np.int8))],
                ["token", "part", "key", "size", "need"],
            )

    postings = base.where("key is not null").mapInArrow(prefixes, "token long, part int, key long, size int, need byte")
    by_size = Window.partitionBy("token", "part").orderBy("size", "key")
    around = postings.withColumn("before", F.lag("key").over(by_size)).withColumn("after", F.lead("key").over(by_size))
    shared = around.where("(part > 0 or before is not null or after is not null) and not (before <=> key)").drop("before", "after")  # tokens that one record alone gives out are gone
    posted = written(shared.join(copied, "key", "left_anti"))  # of equal sets one goes on
    lists = written(one_of_equal(posted).withColumn("known", F.sum("weight").over(Window.partitionBy("key"))))  # a key has no more rows than its texts have words
    forget(posted)

    maps = filled.select("key", "size", *_MAP)
    shorts = filled.select("key", "size", *folded())
    other = lambda m, words: m.select(F.col("key").alias("b"), F.col("size").alias("other_size"), *[F.col(w).alias(f"o_{w}") for w in words])
    near = found = tried = None
    links = 0
    for turn in range(merges):
        here = lists.withColumn("component", F.col("key")) if found is None else labelled(lists, found)
        dealt = F.when(F.col("part") == 0, 0).otherwise(F.pmod(F.xxhash64(F.lit(turn), "key"), F.greatest("parts", F.lit(1))))
        here = here.withColumn("dealt", dealt)
        near_by = Window.partitionBy("token", "dealt")
        beside = {f"{c}{i}": f(c).over(w) for i, (f, w) in enumerate(((F.lag, near_by.orderBy("size", "key")), (F.first, near_by.orderBy(F.desc("known"), "key")))) for c in ("key", "component")}
        beside = here.select("key", "component", *[c.alias(name) for name, c in beside.items()])
        either = F.explode(F.array(*[F.struct(F.col(f"key{i}").alias("a"), F.col(f"component{i}").alias("other")) for i in (0, 1)]))
        met = beside.select("key", "component", either.alias("x")).where("x.a is not null and x.other <> component")
        pairs = met.groupBy(F.least("x.a", "key").alias("a"), F.greatest("x.a", "key").alias("b")).agg(F.min("component").alias("component"))
        pairs = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        pairs = pairs.join(shorts.withColumnRenamed("key", "a"), "a").join(other(shorts, _SHORT), "b").where(maybe_similar(num, den, _SHORT)).where(likely_similar(num, den, _SHORT))
        pairs = pairs.select("a", "b", "component", F.expr(f"{bits_apart(_SHORT)} / (size + other_size)").alias("differ"))
        pairs = pairs.withColumn("r", F.row_number().over(Window.partitionBy("component").orderBy("differ", "b", "a"))).where("r = 1")  # step 4 looks at all others
        pairs = cut(pairs.select("a", "b"))
        tried = pairs if tried is None else tried.unionByName(pairs)
        more = verified(base, pairs, n, num, den)
        near = cut(more if near is None else near.unionByName(more))
        found, before, links = components(near), links, near.count()
        if links - before < 0.02 * links + 1:
            break
    here = labelled(lists, found)
    counted = here.groupBy("token", "component").agg(F.count("*").alias("n"))
    mixed = counted.groupBy("token").agg(F.max(F.struct("n", "component")).alias("most"), F.count("*").alias("different")).where("different > 1").select("token", F.col("most.component").alias("largest"))
    here = written(here.join(mixed, "token").select("token", "key", "component", "weight", "need", F.expr("component = largest").alias("inside")).join(shorts, "key"))
    right = here.select("token", F.col("key").alias("other"), F.col("need").alias("other_need"), F.col("component").alias("other_component"), F.col("inside").alias("other_inside"), F.col("size").alias("other_size"), *[F.col(m).alias(f"o_{m}") for m in _SHORT])
    # Records outside the list's largest component meet the whole list; two of them meet once.
    crossing = here.where("not inside").join(right, "token").where(f"component <> other_component and (other_inside or key < other) and {maybe_similar(num, den, _SHORT)}")
    crossing = crossing.groupBy(F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b")).agg(F.sum("weight").alias("shared"), F.min(F.least("need", "other_need")).alias("need")).where("shared >= need")
    crossing = crossing.join(maps.withColumnRenamed("key", "a"), "a").join(other(maps, _MAP), "b").where(maybe_similar(num, den, _MAP))
    rest = cut(verified(base, cut(crossing.select("a", "b")), n, num, den))
    forget(here, lists)
    links = same.unionByName(near.select("a", "b")).unionByName(rest.select("a", "b"))
    final = components(links)
    out = signed.join(final, F.col("key") == F.col("node"), "left")
    return out.select(F.col("key").cast(kind).alias(key), F.col("size").alias("n_shingles"), F.coalesce("component", "key").cast(kind).alias("component_id"))


def one_of_equal(lists: DataFrame) -> DataFrame:
    """Of tokens with the same list one goes on, with their number as weight and the number of its parts; lists of one record go."""
    token = lists.groupBy("token").agg(*[F.expr(f"bit_xor(xxhash64({i}, key, size))").alias(f"x{i}") for i in (0, 1)], F.count("*").alias("n"), F.max("part").alias("parts")).where("n > 1")
    one = token.groupBy("x0", "x1", "n").agg(F.min_by(F.struct("token", "parts"), F.struct("parts", "token")).alias("t"), F.count("*").alias("weight")).select("t.*", "weight")
    return lists.join(one, "token")


def labelled(lists: DataFrame, found: DataFrame) -> DataFrame:
    """The lists with each record's component, itself where it has no link yet."""
    return lists.join(found.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))


def verified(base: DataFrame, pairs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of keys whose documents' sets are similar. Sets are made anew from the texts of the documents that occur."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            value, counts = shingles(*text_buffer(batch.column(1)), n)
            yield pa.RecordBatch.from_arrays([batch.column(0), packed(value, counts)], ["key", "tokens"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                a, b = (np.frombuffer(batch.column(c)[i].as_buffer(), "<u8") for c in (2, 3))
                at = np.searchsorted(b, a)
                shared = int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0
                good[i] = shared >= shared_needed(len(a), len(b), num, den)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    keys = small(cut(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()))
    tokens = base.where("key is not null").join(keys, "key", "left_semi").mapInArrow(sets, "key long, tokens binary")
    one = pairs.join(tokens.select(F.col("key").alias("a"), F.col("tokens").alias("left")), "a")
    two = one.join(tokens.select(F.col("key").alias("b"), F.col("tokens").alias("right")), "b")
    return two.select("a", "b", "left", "right").mapInArrow(check, "a long, b long").distinct()
