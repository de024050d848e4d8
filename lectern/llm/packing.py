"""Packing (operator 3): harmonic packing of token sequences into reciprocal-capacity classes."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.taskcontext import TaskContext

from lectern.llm.common import slices, small, text_column, worker_memory, written

PIECES = "key {key}, start long, length int, ids_crc32 long, doc_tokens long, part int, own long"
#: From some 500,000 white-space characters in a row on tiktoken's regex overflows its stack and panics.
LONG_SPACE = 10_000


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes stand for themselves, the others for the letters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


class Ids:
    """Ids of texts as the vocabulary's own tokenizer gives them, several times faster.

    A byte-level vocabulary whose ids are its merges' ranks is replayed by tiktoken. Texts that hold the string of an added token, which the tokenizer finds in
    any text (unless `added` is False: then it is text like any other), and texts with very long runs of white space go to the tokenizer itself.
    """

    def __init__(self, path: str, pattern: str, added: bool = True):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as lines:
            known = json.load(lines)
        strings, letter = {t["content"] for t in known["added_tokens"]}, byte_letters()
        ranks = {bytes(map(letter.__getitem__, token)): i for token, i in known["model"]["vocab"].items() if token not in strings}
        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = not added
        self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.odd = re.compile("|".join([rf"\s{{{LONG_SPACE}}}", *map(re.escape, sorted(strings) if added else [])]))

    def __call__(self, text: str) -> list[int]:
        return self.slow.encode(text, add_special_tokens=False).ids if self.odd.search(text) else self.fast(text)


def cuts(tokens: int, capacity: int, least: int) -> list[int]:
    """Lengths of a document's pieces: full sequences, then the powers of two (from capacity / 2 to `least`) in the rest, then what is left.

    A piece of capacity / 2**i fills its class's bins without padding; a tail below `least` goes to a class with an
    i-th of the capacity for i > capacity / least, so a bin of tails is full but for a fraction of least / capacity.
    """
    out = [capacity] * (tokens // capacity)
    rest, part = tokens % capacity, capacity // 2
    while part >= least:
        if rest >= part:
            out.append(part)
            rest -= part
        part //= 2
    return [*out, rest] if rest else out


def tokenize(docs: DataFrame, vocabulary: str, pattern: str, capacity: int = 1024, least: int = 64, end: int = 0, added: bool = True, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per piece: key, start, length, ids_crc32 (of its ids as little-endian unsigned 32-bit numbers), doc_tokens, and its place among the pieces of its class in its task (part, own). Each document's ids end with `end`."""
    kind = docs.schema[key].dataType

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = worker_memory()
        encode = memory.get(("ids", vocabulary, pattern, added)) or Ids(vocabulary, pattern, added)
        memory["ids", vocabulary, pattern, added] = encode
        part, counts = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, 1):
            keys, start, length, crc, total, own = [], [], [], [], [], []
            for k, body in enumerate(batch.column(1).to_pylist()):
                ids = np.asarray([*encode(body), end], "<u4")
                raw, at = memoryview(ids).cast("B"), 0
                for n in cuts(len(ids), capacity, least):
                    keys.append(k)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(raw[4 * at : 4 * (at + n)]))
                    total.append(len(ids))
                    own.append(counts[capacity // n])
                    counts[capacity // n] += 1
                    at += n
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keys, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(crc, pa.int64()), pa.array(total, pa.int64()), pa.array([part] * len(own), pa.int32()), pa.array(own, pa.int64())],
                ["key", "start", "length", "ids_crc32", "doc_tokens", "part", "own"],
            )

    return docs.select(F.col(key).alias("key"), text_column(text).alias("text")).mapInArrow(pieces, PIECES.format(key=kind.simpleString()))


def harmonic_pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """`pieces` (length from 1 to capacity, part, own, ...: a written table, see tokenize()) with class, sequence_id and offset.

    Class j takes lengths over capacity / (j + 1), up to capacity / j; each of its bins takes j pieces in turn. Every worker has numbered the
    pieces of a class itself and needs only the counts of the workers before it, so a
    class leaves one bin unfilled, not one for each worker, and pieces are shuffled once, by bin. These last bins (one a class) are put together, largest first, where they fit.
    Sequence ids are gapless.
    """
    classed = pieces.withColumn("class", F.expr(f"cast({capacity} div length as int)"))
    counts = classed.groupBy("class", "part").agg(F.count("*").alias("m"))  # a row for each task and class
    before = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = written(counts.select("class", "part", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("before"), F.sum("m").over(Window.partitionBy("class")).alias("n")))
    numbered = (
        classed.join(small(sums), ["class", "part"])
        .withColumn("ordinal", F.col("before") + F.col("own"))
        .withColumn("bin", F.expr("ordinal div class"))
        .withColumn("last", F.expr("bin = n div class"))
        .drop("own", "before", "part")
    )
    # A row per class: at most `capacity` of them reach the driver.
    known = numbered.groupBy("class").agg(F.first("n").alias("n"), F.sum(F.when(F.col("last"), F.col("length")).otherwise(0)).alias("rest")).collect()
    full, first, open_, starts = 0, {}, [], {}
    for r in sorted(known, key=lambda r: r["class"]):
        first[r["class"]] = full
        full += r["n"] // r["class"]
    for r in sorted(known, key=lambda r: (-r["rest"], r["class"])):
        if r["rest"]:
            at = next((i for i, used in enumerate(open_) if used + r["rest"] <= capacity), len(open_))
            open_[at:] = open_[at:] or [0]
            starts[r["class"]] = (full + at, open_[at])
            open_[at] += r["rest"]
    schema = "class int, first long, last_id long, last_offset long"
    where = pieces.sparkSession.createDataFrame([(c, f, *map(int, starts.get(c, (0, 0)))) for c, f in first.items()], schema)
    inside = Window.partitionBy("class", "bin").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    full_pieces = numbered.where("class = 1").withColumn("within", F.lit(0).cast("long"))  # a bin each
    others = numbered.where("class > 1").withColumn("within", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long"))
    done = full_pieces.unionByName(others).join(F.broadcast(where), "class")
    return done.withColumn("sequence_id", F.when(F.col("last"), F.col("last_id")).otherwise(F.col("first") + F.col("bin"))).withColumn(
        "offset", F.col("within") + F.when(F.col("last"), F.col("last_offset")).otherwise(0)
    ).drop("n", "ordinal", "bin", "last", "first", "last_id", "last_offset", "within")


def pack(docs: DataFrame, vocabulary: str, pattern: str, capacity: int = 1024, least: int = 64, end: int = 0, added: bool = True, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's tokens in sequences of at most `capacity`: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, class.

    Ids are those of the tokenizer in the file `vocabulary` (byte-level BPE as JSON) without special tokens of its own; strings of added tokens in a text are these tokens if `added`, else plain text.
    A null or empty text is the single id `end`. Each repeated row is packed. An empty table gives an empty result. Columns
    other than key and text are left out. Sequence ids depend on how the input is split into tasks.
    """
    pieces = written(tokenize(docs, vocabulary, pattern, capacity, least, end, added, key, text))
    packed = harmonic_pack(pieces, capacity)
    return packed.select(F.col("key").alias(key), "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "offset", "class")
