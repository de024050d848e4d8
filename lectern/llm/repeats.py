"""Suffix-array dedup (operator 10): repeated passages from the common-prefix intervals of a sampled, enhanced suffix array."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.llm.common import cut, eights, forget, given_back, mix, set_aside, slices, small, span_hashes, text_buffer, text_column, written

_U = np.uint64
#: Low bits that hold a position while minima are taken; a slice of text must be shorter than this many bytes.
_AT = 28


def anchors(data: np.ndarray, offsets: np.ndarray, least: int, k: int) -> tuple[np.ndarray, ...]:
    """(row, at, low, high, hash) of the sampled suffixes of the rows; k is a multiple of 8.

    Every string of `least` bytes takes as its anchor the smallest hash of its k-byte substrings (the first of equal ones), so equal strings have
    equal anchors at equal places. The strings of one anchor are those that start in a run of places; low and high (exclusive)
    are the bytes from the first place of the run to the end of the last string: the anchor's context.
    """
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64))
    w, n = least - k + 1, len(data)
    if n < least:
        return none
    if n >> _AT:
        raise ValueError("a text is longer than 256 MB")
    eight, full = eights(data), np.zeros(n - k + 1, np.uint64)
    for i in range(0, k, 8):
        full += eight[i : i + n - k + 1] * _U(pow(0x9E3779B97F4A7C15, i + 1, 1 << 64))
    full = mix(full)
    low_bits = _U((1 << _AT) - 1)
    window = (full & ~low_bits) | np.arange(n - k + 1, dtype=np.uint64)
    size = 1
    while 2 * size <= w:
        window = np.minimum(window[: len(window) - size], window[size:])
        size *= 2
    window = np.minimum(window[: n - least + 1], window[w - size : w - size + n - least + 1])
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))[: n - least + 1]
    start = np.flatnonzero(np.arange(n - least + 1) + least <= offsets[1:][row])
    if not len(start):
        return none
    place, row = (window[start] & low_bits).astype(np.int64), row[start]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    low, high, place = start[first], start[last] + least, place[first]
    return row[first].astype(np.int64), place, low, high, full[place]


def common(rows: list[bytes]) -> list[int]:
    """Length of the common prefix of each row with the one before (0 for the first)."""
    out = [0]
    for a, b in zip(rows, rows[1:], strict=False):
        n = min(len(a), len(b))
        if a[:n] == b[:n]:
            out.append(n)
        else:
            low, high = 0, n
            while high - low > 1:
                mid = (low + high) // 2
                low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid)
            out.append(low)
    return out


def intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int, list[int]]]:
    """The nodes (length, from, to, starts of children) of the tree of common-prefix intervals of at least `least`, by one scan with a stack; `to` is exclusive."""
    stack: list[list] = []  # length, from, starts of children
    for i in range(1, len(lcp) + 1):
        now = lcp[i] if i < len(lcp) else -1
        start = i - 1
        while stack and stack[-1][0] > now:
            length, start, children = stack.pop()
            yield length, start, i, children
        if now >= least:
            if stack and stack[-1][0] == now:
                stack[-1][2].append(i)
            else:
                stack.append([now, start, [start, i]])


def maximal_repeats(right: list[bytes], left: list[bytes], least: int) -> Iterator[tuple[int, int, list[int]]]:
    """(left length, right length, members) of every maximal repeat of `least` bytes or more that holds the anchor.

    `right` holds the suffixes from the anchor on in sorted order, `left` the bytes before it, nearest first. A node of the interval tree
    gives the right length that its suffixes share; those before it are sorted in turn, and an interval of them is a repeat that
    ends on the left where its members' next bytes differ. It is one of this node only if its members come from several children, since
    otherwise all of them go on alike to the right. All members of an interval are given, not only neighbours.
    """
    shortest = max(0, least - max(map(len, left), default=0))
    order = sorted(range(len(left)), key=left.__getitem__)
    rank = [0] * len(left)
    for r, i in enumerate(order):
        rank[i] = r
    before = np.array(common([left[i] for i in order]))
    for length, a, b, children in intervals(common(right), shortest):
        inside = sorted(range(a, b), key=rank.__getitem__)
        places = [rank[i] for i in inside]
        shared = [0] + [int(before[p + 1 : q + 1].min()) for p, q in zip(places, places[1:], strict=False)]
        child = np.searchsorted(children, inside, "right")
        for depth, c, d, _ in intervals(shared, max(0, least - length)):
            if depth + length >= least and (child[c:d] != child[c]).any():
                yield depth, length, inside[c:d]


def identified(docs: DataFrame, text: str) -> DataFrame:
    """h1, h2, text: 128 bits that tell texts apart (null is the empty text), rows with equal texts not."""
    body = text_column(text)
    return docs.select(*hashes(body), body.alias("text"))


def hashes(body) -> list:
    return [F.xxhash64(body).alias("h1"), F.xxhash64(F.lit(1), body).alias("h2")]


def placed(bits: int) -> list:
    """at, left (bytes of the context before it), right (from it on) and done, out of one number; of a span that is done: its start, 0 and its length."""
    mask = (1 << bits) - 1
    either = lambda done, open_, name: F.expr(f"cast(if(place & 1 = 1, {done}, {open_}) as int) as {name}")
    return [either("place >> 32", f"place >> {2 * bits + 1}", "at"), either("0", f"(place >> {bits + 1}) & {mask}", "before_at"), either(f"(place >> 1) & {(1 << 31) - 1}", f"(place >> 1) & {mask}", "from_at"), F.expr("place & 1 = 1 as done")]


def stretches(data: np.ndarray, offsets: np.ndarray, least: int, most: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, offsets, where they begin) of a slice: the slice itself, or stretches of one long text with `most` places each where strings of `least` bytes start. What two of them share is shorter
    than such a string, so each string lies in one, and no context meets itself."""
    if len(offsets) != 2 or len(data) <= most:
        yield data, offsets, 0
        return
    for at in range(0, len(data) - least + 1, most):
        part = data[at : at + most + least - 1]
        yield part, np.array([0, len(part)]), at


def joined_up(row: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of spans in order, those of a row that touch or overlap as one."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (low[1:] > high[:-1])
    first = np.flatnonzero(new)
    return row[first], low[first], high[np.append(first[1:], len(row)) - 1] if len(row) else high


def sampled(texts: DataFrame, least: int, k: int) -> DataFrame:
    """Anchors of all texts, ready to be dealt by `route`: route, context, h1, h2, place. Of a context met in one task over and over, only two go on; the others are known to repeat (done): they go on as spans,
    neighbours of a text as one, dealt out anywhere. So a text that repeats itself at every byte or few gives a row or two, not one for each."""
    bits = least.bit_length()

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, met = {}, set()
        for batch in slices(batches, 2):
            h1, h2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            fresh = np.ones(len(h1), bool)
            for i, h in enumerate(zip(h1.tolist(), h2.tolist(), strict=True)):  # a text met before gives the same rows
                fresh[i] = h not in met
                met.add(h)
            for data, offsets, base in stretches(*text_buffer(batch.column(2)), least):
                row, at, low, high, anchor = anchors(data, offsets, least, k)
                row, at, low, high, anchor = (x[fresh[row]] for x in (row, at, low, high, anchor))
                context = mix(span_hashes(data, low, high) + (at - low).astype(np.uint64))
                done = np.zeros(len(row), bool)
                for i, c in enumerate((anchor ^ context).tolist()):
                    times = seen.get(c, 0)
                    done[i] = times >= 2
                    seen[c] = times + 1
                begin = base - offsets[row]
                own, start, end = joined_up(row[done], (low + begin)[done], (high + begin)[done])
                open_ = ~done
                place = (((at + begin << bits) + at - low) << bits) + high - at << 1
                columns = [
                    np.concatenate([anchor[open_], mix(h1.view(np.uint64)[own] ^ mix(start.astype(np.uint64)))]).view(np.int64), np.concatenate([context[open_], start.astype(np.uint64)]).view(np.int64),
                    np.concatenate([h1[row[open_]], h1[own]]), np.concatenate([h2[row[open_]], h2[own]]), np.concatenate([place[open_], ((start << 31) + end - start << 1) + 1]),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["route", "context", "h1", "h2", "place"])
                if len(seen) > 1 << 16:
                    seen.clear()
            if len(met) > 1 << 16:
                met.clear()

    return texts.select("h1", "h2", "text").mapInArrow(sample, "route long, context long, h1 long, h2 long, place long")


def fetched(texts: DataFrame, wanted: DataFrame, pieces: list) -> DataFrame:
    """`wanted` (h1, h2, ...) with the columns in `pieces`, made of `raw`, the bytes of the text with these hashes. Of equal texts one is moved."""
    by_text = wanted.groupBy("h1", "h2").agg(F.collect_list(F.struct(*[c for c in wanted.columns if c not in ("h1", "h2")])).alias("places"))
    keys = small(cut(wanted.select("h1", "h2").distinct()))
    once = texts.join(keys, ["h1", "h2"], "left_semi").dropDuplicates(["h1", "h2"])
    spread = once.join(by_text, ["h1", "h2"]).select("h1", "h2", F.col("text").cast("binary").alias("raw"), F.explode("places").alias("p"))
    return spread.select("h1", "h2", "raw", "p.*").select("h1", "h2", *[c for c in wanted.columns if c not in ("h1", "h2")], *pieces)


def piece(start: str, end: str, name: str):
    return F.expr(f"substring(raw, {start} + 1, {end} - ({start})) as {name}")


def contexts_of(texts: DataFrame, least: int, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(whole, open, table) of texts (h1, h2, text): spans (h1, h2, start, end) of contexts that occur again as they are, and one row (route, h1, h2, at, low, high, same, contexts, right, left)
    for each different context of the anchors that have several: the bytes from the anchor on and those before it. `table` is to be forgotten at the end."""
    anchor = Window.partitionBy("route")
    ordered = anchor.orderBy("context")
    marked = (
        sampled(texts, least, k)
        .withColumn("before", F.lag("context").over(ordered))
        .withColumn("after", F.lead("context").over(ordered))
        .where("place & 1 = 1 or before is not null or after is not null")
        .withColumn("same", F.expr("place & 1 = 1 or coalesce(before = context, false) or coalesce(after = context, false)"))
        .withColumn("first", F.expr("not coalesce(before = context, false)"))
    )
    marked = marked.withColumn("contexts", F.sum(F.expr("if(first, 1, 0)")).over(anchor)).withColumn("lone", F.max(~F.col("same")).over(anchor)).drop("before", "after", "context")
    table = written(marked.where("same or contexts > 1"))
    found = table.select("*", *placed(least.bit_length())).withColumn("low", F.expr("at - before_at")).withColumn("high", F.expr("at + from_at"))
    whole = found.where("same").select("h1", "h2", F.col("low").alias("start"), F.col("high").alias("end"))
    open_ = found.where("contexts > 1 and lone and first").select("route", "h1", "h2", "at", "low", "high", "same", "contexts")
    return whole, written(fetched(texts, open_, [piece("at", "high", "right"), piece("low", "at", "left")])), table


def in_anchors(rows: DataFrame, solve, schema: str) -> DataFrame:
    """solve(record batch of the rows of whole anchors, the edges of the anchors in it) over `rows` (route, right, ...), sorted by Spark by route and suffix."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the rows of the anchor that the last batch ended with
        for batch in batches:
            if not batch.num_rows:
                continue
            route = batch.column(0).to_numpy()
            ends = np.flatnonzero(route[1:] != route[:-1]) + 1
            if held and held[-1].column(0)[0].as_py() != route[0]:
                yield whole(held)
                held = []
            if len(ends):
                yield whole([*held, batch.slice(0, int(ends[-1]))])
                held = []
            held.append(batch.slice(int(ends[-1]) if len(ends) else 0))
        if held:
            yield whole(held)

    def whole(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        route = rows.column(0).to_numpy()
        return solve(rows, np.concatenate([[0], np.flatnonzero(route[1:] != route[:-1]) + 1, [len(route)]]).tolist())

    return rows.repartition("route").sortWithinPartitions("route", "right").mapInArrow(scan, schema)


def interval_scan(contexts: DataFrame, least: int) -> DataFrame:
    """(h1, h2, start, end): for each context the union of the maximal repeats found by the scan of its anchor's suffixes, one span as all of them hold the anchor."""

    def solve(rows: pa.RecordBatch, edges: list[int]) -> pa.RecordBatch:
        at, right, left = rows.column(3).to_numpy(), rows.column(4).to_pylist(), [x[::-1] for x in rows.column(5).to_pylist()]
        spans: list[tuple[int, int, int]] = []  # row, left, right
        for a, b in zip(edges, edges[1:], strict=False):
            reach: dict[int, tuple[int, int]] = {}
            for before, behind, inside in maximal_repeats(right[a:b], left[a:b], least) if b - a > 1 else ():
                for i in inside:
                    x, y = reach.get(i, (0, 0))
                    reach[i] = max(x, before), max(y, behind)
            spans += [(a + i, x, y) for i, (x, y) in reach.items()]
        row, before, behind = (np.array(x, np.int64) for x in zip(*spans, strict=True)) if spans else [np.zeros(0, np.int64)] * 3
        take = pa.array(row)
        return pa.RecordBatch.from_arrays([rows.column(1).take(take), rows.column(2).take(take), pa.array((at[row] - before).astype(np.int32)), pa.array((at[row] + behind).astype(np.int32))], ["h1", "h2", "start", "end"])

    return in_anchors(contexts.select("route", "h1", "h2", "at", "right", "left"), solve, "h1 long, h2 long, start int, end int")


def by_cores(contexts: DataFrame, least: int, step: int = 8) -> DataFrame:
    """The contexts of crowded anchors as contexts of finer ones: the strings that start in one run of `step` places have most bytes in common, and only contexts equal in these meet again. The bytes go no further than these strings."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for route, h1, h2, at, low, high, right, left in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = left + right
                for run in range(max(0, at - high + least) // step, (at - low) // step + 1):
                    core = at - run * step - low
                    a, b = max(low, at - run * step - step + 1), min(high, at - run * step + least)
                    if b - a >= least:
                        own = hashlib.blake2b(b"%d %d " % (route, run) + raw[core : core + least - step + 1], digest_size=8).digest()
                        out.append((int.from_bytes(own, "little", signed=True), h1, h2, at, a, b, raw[at - low : b - low], raw[a - low : at - low]))
            columns = list(zip(*out, strict=True)) if out else [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, batch.schema.types, strict=True)], batch.schema.names)

    columns = "route long, h1 long, h2 long, at int, low int, high int, right binary, left binary"
    return contexts.select("route", "h1", "h2", "at", "low", "high", "right", "left").mapInArrow(split, columns)


def repeats(texts: DataFrame, least: int = 200, k: int = 32, most_contexts: int = 20_000) -> tuple[DataFrame, list[DataFrame]]:
    """Spans (h1, h2, start, end) whose union is every byte in a string of `least` bytes that starts anywhere else, but for texts that are copies of others; and tables to forget once they are used.

    `texts` as from identified(). An anchor with more than `most_contexts` different contexts, too many for one task, is split by longer shared strings; the scan is the same.
    """
    whole, contexts, table = contexts_of(texts, least, k)
    few = interval_scan(contexts.where(F.col("contexts") <= most_contexts), least)
    finer = by_cores(contexts.where(F.col("contexts") > most_contexts), least)
    alike = finer.groupBy("route", "left", "right").agg(F.min(F.struct("h1", "h2", "at", "low", "high")).alias("one"), F.count("*").alias("n"))
    often = finer.join(alike.where("n > 1"), ["route", "left", "right"], "left_semi").select("h1", "h2", F.col("low").alias("start"), F.col("high").alias("end"))
    many = interval_scan(alike.select("route", "one.*", "right", "left"), least)
    return whole.unionByName(few).unionByName(often).unionByName(many), [contexts, table]


def repeat_groups(docs: DataFrame, least: int = 200, k: int = 32, reach: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(anchor, group, length, open, key, start): every maximal repeat of `least` bytes or more, a row for each of its places, in equal texts too.

    A maximal repeat is a string with two places or more whose neighbours differ on either side, a text's ends counting as such. It belongs to the anchor of its first
    `least` bytes, so each is given once. Suffixes are compared over `reach` bytes; a repeat that goes on beyond is cut there and `open`. Equal contexts of an anchor
    are scanned as one, and their places joined afterwards. Texts are UTF-8 bytes, null is empty, repeated rows are places of their own; an empty table gives an empty result.
    """
    texts = identified(docs, text)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            data, offsets = text_buffer(batch.column(2))
            row, at, low, high, anchor = anchors(data, offsets, least, k)
            first, last = np.maximum(low - 1, offsets[row]), np.minimum(at + reach, offsets[row + 1])
            context = mix(mix(span_hashes(data, first, last) + (at - first).astype(np.uint64)) + (last == offsets[row + 1]).astype(np.uint64))
            take = pa.array(row)
            places = [(x - offsets[row]).astype(np.int32) for x in (at, low, high)]
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)), batch.column(0).take(take), batch.column(1).take(take), *map(pa.array, places)], ["route", "context", "h1", "h2", "at", "low", "high"])

    places = cut(texts.mapInArrow(find, "route long, context long, h1 long, h2 long, at int, low int, high int").distinct())
    rows = cut(docs.select(F.col(key).alias("key"), *hashes(text_column(text))))
    held = rows.groupBy("h1", "h2").count()
    alike = places.join(held, ["h1", "h2"]).groupBy("route", "context").agg(F.min(F.struct("h1", "h2", "at", "low", "high")).alias("one"), F.sum("count").alias("n"))
    several = alike.groupBy("route").agg(F.sum("n").alias("all")).where("all > 1").select("route")
    wanted = alike.join(several, "route").select("route", "context", "one.*", "n")
    pieces = [piece("at", f"(at + {reach})", "right"), piece("greatest(low - 1, 0)", "at", "left"), F.expr(f"at + {reach} < octet_length(raw)").alias("goes_on")]

    def solve(rows: pa.RecordBatch, edges: list[int]) -> pa.RecordBatch:
        route, context, at, low, high = (rows.column(i).to_numpy() for i in (0, 1, 2, 3, 8))
        right, left = rows.column(4).to_pylist(), [x[::-1] for x in rows.column(5).to_pylist()]
        times, goes_on = rows.column(6).to_pylist(), rows.column(7).to_pylist()
        out: list[tuple] = []
        for a, b in zip(edges, edges[1:], strict=False):
            own = [i for i in range(a, b) for _ in range(min(2, times[i]))]  # a context with several places meets itself
            found = maximal_repeats([right[i] for i in own], [left[i] for i in own], least) if len(own) > 1 else ()
            for n, (before, behind, inside) in enumerate(found):
                members = sorted({own[i] for i in inside})
                if all(low[i] <= at[i] - before <= high[i] - least for i in members):  # else its first bytes have another anchor
                    ends_here = any(len(right[i]) == behind and not goes_on[i] for i in members)
                    out += [(route[i], context[i], n, before + behind, behind == reach and not ends_here, before) for i in members]
        columns = list(zip(*out, strict=True)) if out else [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["route", "context", "group", "length", "open", "before"])

    scanned = in_anchors(fetched(texts, wanted, pieces).select("route", "context", "at", "low", "right", "left", "n", "goes_on", "high"), solve, "route long, context long, group int, length int, open boolean, before int")
    return scanned.join(places, ["route", "context"]).join(rows, ["h1", "h2"]).select(F.col("route").alias("anchor"), "group", "length", "open", F.col("key").alias(key), (F.col("at") - F.col("before")).alias("start"))


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """The union of spans as disjoint runs that do not touch."""
    out: list[list[int]] = []
    for i in np.argsort(starts, kind="stable"):
        if out and starts[i] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], int(ends[i]))
        else:
            out.append([int(starts[i]), int(ends[i])])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, least: int = 200, key: str = "doc_id", text: str = "text", whole_characters: bool = False) -> DataFrame:
    """`docs` with kept (binary), n_bytes, n_removed, n_spans: each byte covered by a string of `least` bytes that also starts anywhere else is removed.

    Texts are UTF-8 bytes, null is empty; matches do not cross rows; the place may be in the same text, and strings may overlap.
    Strings are judged on the input. A row that repeats another counts as another place, whatever its key, which takes no part. With `whole_characters` a character
    goes only if all its bytes go, so what is left is text. An empty table gives an empty result; all columns are kept, but columns of the four names are
    replaced. Long texts are sampled in stretches, and what repeats at every few bytes is one span from the start, so texts of little variety cost no more than others.

    Rows are told apart by 128 bits of their text, so rows with equal texts are one; such a text of `least` bytes or more goes as a whole.
    """
    names = [c for c in docs.columns if c not in ("kept", "n_bytes", "n_removed", "n_spans")]
    rows = set_aside(docs.select(*[F.col(f"`{c}`") for c in names]), text)
    texts = identified(rows, text)
    signed = texts.select("h1", "h2", F.octet_length("text").alias("n"))
    copied = signed.where(F.col("n") >= least).groupBy("h1", "h2").count().where("count > 1").select("h1", "h2", F.lit(True).alias("copied"), F.array().cast("array<bigint>").alias("spans"))
    spans, tables = repeats(texts, least)
    joined_spans = F.collect_set(F.shiftleft(F.col("start").cast("long"), 32) + F.col("end")).alias("spans")
    by_text = spans.groupBy("h1", "h2").agg(joined_spans).select("h1", "h2", F.lit(False).alias("copied"), "spans")
    actions = written(by_text.unionByName(copied).groupBy("h1", "h2").agg(F.max("copied").alias("copied"), F.flatten(F.collect_list("spans")).alias("spans")))
    forget(*tables)
    body = text_column(text)
    joined = rows.select(*hashes(body), text, "others").join(actions, ["h1", "h2"], "left")
    arranged = joined.select(text, "others", text_column(text).cast("binary").alias("raw"), F.coalesce("copied", F.lit(False)).alias("copied"), "spans")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, 1 << 20):
            kept, sizes, removed, runs = [], [], [], []
            for i in range(batch.num_rows):
                body = batch.column(2)[i].as_py()
                if batch.column(3)[i].as_py():
                    spans = [(0, len(body))]
                elif batch.column(4)[i].is_valid:
                    both = batch.column(4)[i].values.to_numpy()
                    spans = merged(both >> 32, both & 0xFFFFFFFF)
                else:
                    spans = []
                if whole_characters:
                    spans = [(a, b) for a, b in ((inward(body, a, 1), inward(body, b, -1)) for a, b in spans) if a < b]
                left, last = [], 0
                for a, b in spans:
                    left.append(body[last:a])
                    last = b
                kept.append(b"".join([*left, body[last:]]))
                sizes.append(len(body))
                removed.append(len(body) - len(kept[-1]))
                runs.append(len(spans))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64())], ["body", "others", "kept", "n_bytes", "n_removed", "n_spans"])

    schema = f"body {rows.schema[text].dataType.simpleString()}, others {rows.schema['others'].dataType.simpleString()}, kept binary, n_bytes long, n_removed long, n_spans long"
    done = arranged.mapInArrow(strip, schema).withColumnRenamed("body", text)
    return done.select(*given_back(done, names, text), "kept", "n_bytes", "n_removed", "n_spans")


def inward(body: bytes, at: int, step: int) -> int:
    """The nearest start of a character from `at` on in the direction of `step`."""
    while 0 < at < len(body) and body[at] & 0xC0 == 0x80:
        at += step
    return at
