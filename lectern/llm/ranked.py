"""Ranked lexical search (operator 13): posting blocks of variable length with their largest values, searched shard by shard."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.llm.common import between, lowered, slices, span_hashes, text_buffer, text_column, words

#: Bytes that part terms: ASCII other than letters and digits.
PARTING = between(*(b for b in range(128) if not chr(b).isalnum()))
#: Numerator of a posting's value.
SCALE = 1_000_000_000


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all terms (A-Z as a-z) in order, and the number of terms of each row."""
    start, end, before = words(data, offsets, PARTING)
    return span_hashes(lowered(data), start, end), np.diff(before)


def occurrences(data: np.ndarray, offsets: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, tf) of the known terms (places in a sorted array of hashes) that each row holds, and every row's number of terms of any kind."""
    hashes, n = term_hashes(data, offsets)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    hit = np.flatnonzero(known[at] == hashes)
    keys, tf = np.unique(np.repeat(np.arange(len(n)), n)[hit] * len(known) + at[hit], return_counts=True)
    return keys // len(known), keys % len(known), tf, n


def block_starts(values: np.ndarray, first: np.ndarray, length: np.ndarray, block_cost: float = 4, longest: int = 128) -> np.ndarray:
    """Marks the first posting of each block, for lists that lie one after another in `values` (list i from first[i] on).

    The cut minimises the sum over postings of (largest value of the block - own value), the error of the block's bound, plus for each block `block_cost` times the standard deviation of the list's values.
    Dynamic programming over the end of the last block, which starts at one of the `longest` places before; all lists take their steps together.
    """
    order = np.argsort(-length, kind="stable")
    order = order[length[order] > 0]
    first, length = first[order], length[order]
    if not len(first):
        return np.zeros(len(values), bool)
    values = values.astype(np.float64)
    cost = block_cost * np.array([values[a : a + n].std() for a, n in zip(first, length, strict=True)])
    active = np.searchsorted(-length, -np.arange(length[0]), "left")  # lists that have a posting number j
    best, largest, begun = np.zeros((len(first), longest)), np.zeros((len(first), longest)), np.zeros(longest, np.int64)
    back, before = np.zeros(len(values), np.int64), np.zeros(len(first))
    for j, n in enumerate(active.tolist()):
        slot, used, now = j % longest, min(j + 1, longest), values[first[:n] + j]
        begun[slot] = j
        best[:n, slot] = before[:n] + cost[:n]
        largest[:n, slot] = 0
        np.maximum(largest[:n, :used], now[:, None], out=largest[:n, :used])
        whole = best[:n, :used] + largest[:n, :used] * (j + 1 - begun[:used])
        chosen = whole.argmin(1)
        before = whole[np.arange(n), chosen]
        back[first[:n] + j] = begun[chosen]
    marks, end = np.zeros(len(values), bool), length.copy()
    while len(end):
        end = back[first + end - 1]
        marks[first + end] = True
        first, end = first[end > 0], end[end > 0]
    return marks


@dataclass
class Shard:
    """Posting lists of a run of documents, by term and document, cut into blocks."""

    docs: np.ndarray
    values: np.ndarray
    lists: np.ndarray  #: first posting of each term, and one more at the end
    last: np.ndarray  #: each block's last document
    bound: np.ndarray  #: each block's largest value
    blocks: np.ndarray  #: first block of each term, and one more at the end
    size: int  #: documents

    @classmethod
    def of(cls, docs: np.ndarray, terms: np.ndarray, values: np.ndarray, n_terms: int, size: int) -> Shard:
        order = np.argsort(terms, kind="stable")
        docs, terms, values = docs[order], terms[order], values[order]
        lists = np.searchsorted(terms, np.arange(n_terms + 1))
        starts = np.flatnonzero(block_starts(values, lists[:-1], np.diff(lists)))
        bound = np.maximum.reduceat(values, starts) if len(starts) else values
        last = docs[np.append(starts[1:], len(docs)) - 1] if len(starts) else docs
        return cls(docs, values, lists, last, bound, np.searchsorted(terms[starts], np.arange(n_terms + 1)), size)

    def kth(self, term: int, k: int) -> int:
        """The kth largest value of a term's list, 0 if it has fewer."""
        own = self.values[self.lists[term] : self.lists[term + 1]]
        return int(np.partition(own, len(own) - k)[len(own) - k]) if len(own) >= k else 0


def search(shard: Shard, terms: np.ndarray, weights: np.ndarray, k: int, least: int = 0, report: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores), all that may be among the k best of the shard with a score of at least `least`, and above 0. A score is the sum of weights times values.

    Between two neighbouring block ends of the item's lists no list changes its block, so one sum of block bounds holds for all documents there; lists whose next document lies beyond add nothing.
    This is WAND's pivot test for the whole stretch. Stretches are visited in falling order of this sum, in growing groups, and all that come after the kth score are skipped; documents of equal score are kept, as ids decide between them.
    """
    there = (np.diff(shard.lists)[terms] > 0) & (weights > 0)
    terms, weights = terms[there], weights[there]
    if not len(terms):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = max(least, 1, *(w * shard.kth(t, k) for t, w in zip(terms.tolist(), weights.tolist(), strict=True)))
    parts = [slice(shard.blocks[t], shard.blocks[t + 1]) for t in terms]
    ends = np.unique(np.concatenate([shard.last[p] for p in parts]))
    bounds = np.zeros(len(ends), np.int64)
    upto = []
    for p, t, w in zip(parts, terms, weights, strict=True):
        upto.append(np.append(0, np.searchsorted(shard.docs[shard.lists[t] : shard.lists[t + 1]], ends, "right")))
        bounds += w * np.append(shard.bound[p], 0)[np.searchsorted(shard.last[p], ends)] * (upto[-1][1:] > upto[-1][:-1])
    live = np.flatnonzero(bounds >= least)
    live = live[np.argsort(-bounds[live], kind="stable")]
    scores = np.zeros(shard.size, np.int64)
    docs, found, at, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 64
    while at < len(live) and bounds[live[at]] >= least:
        group = np.sort(live[at : at + step])
        group = group[bounds[group] >= least]
        touched = []
        for t, w, places in zip(terms, weights, upto, strict=True):
            own, values = (x[shard.lists[t] : shard.lists[t + 1]] for x in (shard.docs, shard.values))
            low, high = places[group], places[group + 1]
            n = high - low
            if n.sum():
                i = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
                scores[own[i]] += w * values[i]
                touched.append(own[i])
        new = np.unique(np.concatenate(touched))
        if report is not None:
            report["scored"] = report.get("scored", 0) + len(new)
        docs, found = np.append(docs, new), np.append(found, scores[new])
        if len(found) >= k:
            least = max(least, int(np.partition(found, len(found) - k)[len(found) - k]))
        docs, found = docs[found >= least], found[found >= least]
        at, step = at + step, 2 * step
    return docs, found


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", shard_docs: int = 65_536, shard_postings: int = 4_000_000, item_bytes: int = 8 << 20
) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item the k documents with the highest integer BM25 score above 0; equal scores by ascending id, null ids last.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case; each of an item's terms counts as often as it stands there. A null or empty text has no
    terms: such a document isn't counted, such an item has no rows. Of items that repeat an id, the one with the smallest text is asked. Repeated document rows are documents of their own.
    Terms are told apart by 64-bit hashes. Empty tables give an empty result. Other columns are left out.

    Texts are read twice. First every task counts documents, terms and the documents that hold each of the items' terms. Then each task makes shards of its documents as they come, of at most
    `shard_docs` documents or about `shard_postings` postings of the items' terms, and searches them, with the kth score of its earlier shards as the score to reach; it gives its best at its end.
    Items go in blocks of about `item_bytes` of text, whose terms every task holds; each block reads the texts again.
    """
    asked = items.where(F.col(item_text).isNotNull()).groupBy(F.col(item).alias("item_id")).agg(F.min(item_text).alias("text"))
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = total // item_bytes + 1
    out = [_rank(docs.select(F.col(key).cast("long").alias("doc_id"), text_column(text).alias("text")), asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b), k, shard_docs, shard_postings) for b in range(blocks)]
    done = out[0]
    for more in out[1:]:
        done = done.unionByName(more)
    return done.withColumn("item_id", F.col("item_id").cast(items.schema[item].dataType))


def _rank(docs: DataFrame, asked: DataFrame, k: int, shard_docs: int, shard_postings: int) -> DataFrame:
    """rank_documents() for items that fit in a task."""
    spark = docs.sparkSession
    rows = asked.collect()
    texts = pa.array([r["text"] for r in rows], pa.large_string())
    hashes, n = term_hashes(*text_buffer(texts))
    known = np.unique(hashes)
    if not len(known):
        return spark.createDataFrame([], f"item_id {asked.dtypes[0][1]}, rank int, doc_id long, score long")
    ends = np.cumsum(n)
    items = [np.unique(np.searchsorted(known, hashes[b - a : b]), return_counts=True) for a, b in zip(n.tolist(), ends.tolist(), strict=True)]
    shared = spark.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents that hold each term; -1: documents with a term, -2: terms."""
        known = shared.value
        holding, n_docs, n_terms = np.zeros(len(known), np.int64), 0, 0
        for batch in slices(batches):
            _, term, _, n = occurrences(*text_buffer(batch.column(0)), known)
            holding += np.bincount(term, minlength=len(known))
            n_docs, n_terms = n_docs + np.count_nonzero(n), n_terms + int(n.sum())
        there = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(there, [-1, -2]), pa.int32()), pa.array(np.append(holding[there], [n_docs, n_terms]), pa.int64())], ["term", "n"])

    counts = dict(docs.select("text").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n")).collect())
    n_docs, n_terms = counts.get(-1, 0), counts.get(-2, 0)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counts.get(t, 0) + 1))) for t in range(len(known))], np.int64)
    shared_items = spark.sparkContext.broadcast((items, weights, n_docs, n_terms))

    def best_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, (items, weights, n_docs, n_terms) = shared.value, shared_items.value
        best = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))] * len(items)
        held, docs, postings = [], 0, 0

        def finish() -> None:
            ids, none, sizes = (np.concatenate([h[c] for h in held]) for c in range(3))
            row, term, tf = (np.concatenate([h[c] for h in held]) for c in range(3, 6))
            lengths, at = np.unique(sizes, return_inverse=True)
            m = np.array([75 + 25 * n * n_docs // max(n_terms, 1) for n in lengths.tolist()], np.int64)[at]
            shard = Shard.of(row, term, SCALE * tf // (1000 * tf + 12 * m[row]), len(known), len(ids))
            for i, (terms, times) in enumerate(items):
                old = best[i]
                least = int(old[2].min()) if len(old[2]) == k else 0
                found, score = search(shard, terms, weights[terms] * times, k, least)
                if len(found):
                    new = [np.append(a, b) for a, b in zip(old, (ids[found], none[found], score), strict=True)]
                    first = np.lexsort((new[0], new[1], -new[2]))[:k]
                    best[i] = tuple(x[first] for x in new)

        for batch in slices(batches, 1):
            row, term, tf, n = occurrences(*text_buffer(batch.column(1)), known)
            held.append((batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_null().to_numpy(zero_copy_only=False), n, row + docs, term, tf))
            docs, postings = docs + len(n), postings + len(row)
            if docs >= shard_docs or postings >= shard_postings:
                finish()
                held, docs, postings = [], 0, 0
        if held:
            finish()
        for i, (ids, none, score) in enumerate(best):
            if len(ids):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), i), pa.int32()), pa.array(ids, pa.int64(), mask=none), pa.array(score)], ["item", "doc_id", "score"])

    found = docs.mapInArrow(best_of_task, "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    ids = F.broadcast(spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item int, item_id {asked.dtypes[0][1]}"))  # one block of items
    return ranked.join(ids, "item").select("item_id", "rank", "doc_id", "score")
