"""Byte-level BPE (operator 5): encoding by replaying the merges over a corpus of words with an inverted index, and decoding."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import slices, text_column, worker_memory


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge_one(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word by the definition: of all neighbours whose join has a rank, the lowest rank is joined first, the leftmost of equal ones. Quadratic; for single words and tests."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if rank == 1 << 60:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


class Pairs:
    """Which pairs of ids merge, found once each by joining their bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.bytes_, self.known = ranks, {i: b for b, i in ranks.items()}, {}

    def rank(self, a: int, b: int) -> int:
        """The rank (also the new id), or -1."""
        pair = a << 32 | b
        got = self.known.get(pair)
        if got is None:
            got = self.known[pair] = self.ranks.get(self.bytes_[a] + self.bytes_[b], -1)
        return got


def replay(words: list[bytes], pairs: Pairs) -> list[bytes]:
    """The ids of each word, as little-endian unsigned 32-bit integers, by replaying all merges over all words in rank order.

    All words lie in one array of ids, linked to their neighbours. An inverted index has, for every rank, the places where a pair
    of that rank starts. The lowest rank goes next; its places are joined from left to right if the pair still stands there, and only
    the two new neighbour pairs are looked up and indexed. If a join makes a pair of a lower rank than the one in hand, the
    words it touches could differ from the definition's order, so such a word is merged by itself (merge_one).
    """
    ranks = pairs.ranks
    single = [ranks[bytes([b])] for b in range(256)]
    text = b"".join(words)
    ends = np.cumsum([len(w) for w in words])
    n = len(text)
    ids = np.array(single, np.int64)[np.frombuffer(text, np.uint8)]
    codes = ids[:-1] << 32 | ids[1:]
    inner = np.ones(max(0, n - 1), bool)
    inner[ends[:-1][ends[:-1] > 0] - 1] = False
    distinct, back = np.unique(codes, return_inverse=True)
    of_code = np.array([pairs.rank(int(c) >> 32, int(c) & 0xFFFFFFFF) for c in distinct] or [0], np.int64)
    rank = np.where(inner, of_code[back], -1) if n > 1 else np.zeros(0, np.int64)
    there = np.flatnonzero(rank >= 0)
    there = there[np.argsort(rank[there], kind="stable")]
    places: dict[int, list[int]] = {}
    if len(there):
        cuts = np.flatnonzero(np.diff(rank[there])) + 1
        for part in np.split(there, cuts):
            places[int(rank[part[0]])] = part.tolist()
    token = ids.tolist()
    last = np.zeros(n + 1, bool)
    last[ends - 1] = True
    follow = np.where(last[:n], -1, np.arange(1, n + 1)).tolist()
    first = np.zeros(n + 1, bool)
    first[0] = True
    first[ends[:-1]] = True
    prior = np.where(first[:n], -1, np.arange(-1, n - 1)).tolist()
    heap, odd, known, look = list(places), set(), pairs.known, pairs.rank
    heapq.heapify(heap)
    while heap:
        now = heapq.heappop(heap)
        spots = places.pop(now, None)
        if spots is None:
            continue
        spots.sort()
        for i in spots:
            j = follow[i]
            a = token[i]
            if j < 0 or a < 0:
                continue
            pair = a << 32 | token[j]
            if known.get(pair, -2) != now:
                continue
            token[i], token[j] = now, -1
            after = follow[j]
            follow[i] = after
            if after >= 0:
                prior[after] = i
                got = look(now, token[after])
                if got >= 0:
                    if got < now:
                        odd.add(i)
                    if got in places:
                        places[got].append(i)
                    else:
                        places[got] = [i]
                        heapq.heappush(heap, got)
            before = prior[i]
            if before >= 0:
                got = look(token[before], now)
                if got >= 0:
                    if got < now:
                        odd.add(i)
                    if got in places:
                        places[got].append(before)
                    else:
                        places[got] = [before]
                        heapq.heappush(heap, got)
    final = np.array(token, np.int64)
    kept = np.flatnonzero(final >= 0)
    data = final[kept].astype("<u4").tobytes()
    at = (np.searchsorted(kept, np.concatenate([[0], ends])) * 4).tolist()
    out = [data[a:b] for a, b in zip(at, at[1:], strict=False)]
    for w in {int(np.searchsorted(ends, i, "right")) for i in odd}:
        out[w] = np.array(merge_one(words[w], ranks), "<u4").tobytes()
    return out


class Coder:
    """Encodes texts word by word with a memory of at most `most_words` words, and decodes."""

    def __init__(self, path: str, pattern: str, most_words: int = 800_000):
        import regex

        self.pairs, self.split, self.memory, self.most_words = Pairs(load_ranks(path)), regex.compile(pattern).findall, {}, most_words

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers. The new words of all texts are merged together."""
        split = [self.split(t) for t in texts]
        memory = self.memory
        if len(memory) > self.most_words:
            memory.clear()
            self.pairs.known.clear()
        new = list(set().union(*split).difference(memory))
        if new:
            memory.update(zip(new, replay([w.encode() for w in new], self.pairs), strict=True))
        return [b"".join(map(memory.__getitem__, words)) for words in split]

    def decode(self, ids: bytes) -> bytes:
        name = self.pairs.bytes_
        return b"".join(map(name.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, decoded): the whole text's ids as little-endian unsigned 32-bit integers and the bytes that they decode to.

    A null text is empty; empty texts have no ids. Each repeated row is encoded. The table's other columns are left out. The words of a
    slice of a partition are merged as one corpus; no data are shuffled.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = worker_memory()
        coder = memory.get(("coder", path, pattern)) or Coder(path, pattern)
        memory["coder", path, pattern] = coder
        for batch in slices(batches, 1, 1 << 22):
            ids = coder.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array([coder.decode(x) for x in ids], pa.binary())], ["key", "ids", "decoded"])

    out = docs.select(F.col(key).alias("key"), text_column(text).alias("text")).mapInArrow(run, f"key {kind}, ids binary, decoded binary")
    return out.withColumnRenamed("key", key)
