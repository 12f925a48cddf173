"""Repeated byte strings across documents: maximal repeats of an enhanced suffix array, built bucket by bucket.

Suffixes have to be compared only if their first ``LENGTH`` bytes can be equal. Every window of
that length has one anchor: its smallest hash of ``GRAM`` bytes, the leftmost of equals. Equal
windows have equal anchors, so all suffixes that can share ``LENGTH`` bytes are in the bucket of
one anchor. The windows with the same anchor in a row are a segment; equal segments are one.

In a bucket the suffixes are sorted, with the length of the common prefix of neighbours and the
byte to the left of each. One scan with a stack walks the common-prefix intervals, from the deepest
up. An interval whose suffixes differ in the byte to the left is a maximal repeat, and all its
suffixes are occurrences, not just neighbours. Where a repeat goes on beyond a segment, the next
segments hold the rest of it.

A bucket of very many different segments is cut into pieces of fewer windows, which agree on a
longer stretch and so meet in smaller buckets; a piece of one window needs no comparison at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from stockpond.session import materialize

LENGTH = 400
GRAM = 100
# Different segments that a task compares as one bucket; larger buckets are cut, first to this many windows a piece, then to one.
BUCKET = 256
PIECES = (32, 1)
# Bytes of text that one suffix array covers, and bytes whose hashes are worked out at once.
ARRAY_BYTES = 1 << 18
CHUNK = 1 << 20
DIGESTS_AT_ONCE = 1 << 14
ROWS_AT_ONCE = 1 << 16
BASE = 0x9E3779B97F4A7C15
PLACE_BITS = 21
DIVERSE = -1

U64 = np.uint64


class Rolling:
    """Hashes of all runs of bytes of one length, from powers of an odd number modulo 2^64."""

    def __init__(self, size: int):
        self.up, self.down = self._powers(BASE, size), self._powers(pow(BASE, -1, 1 << 64), size)

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        out = np.full(size, base, U64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def hashes(self, data: np.ndarray, length: int) -> np.ndarray:
        n = len(data)
        sums = np.zeros(n + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * self.down[:n], out=sums[1:])
        value = (sums[length:] - sums[:-length]) * self.up[: n - length + 1]
        value ^= value >> U64(32)
        value *= U64(0xD6E8FEB86659FD93)
        value ^= value >> U64(32)
        value *= U64(0xD6E8FEB86659FD93)
        return value ^ (value >> U64(32))


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row, from running minima of blocks in both directions."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(U64).max, U64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: bytes, rolling: Rolling, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Of each segment: hash at its anchor, first window, number of windows, place of the anchor from the first window; chunk by chunk."""
    body = np.frombuffer(data, np.uint8)
    place = U64((1 << PLACE_BITS) - 1)
    for begin in range(0, max(0, len(body) - length + 1), CHUNK):
        hashes = rolling.hashes(body[begin : begin + CHUNK + length - 1], gram)
        ranked = (hashes & ~place) | np.arange(len(hashes), dtype=U64)
        chosen = window_minima(ranked, length - gram + 1) & place
        first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
        yield hashes[chosen[first]], begin + first, np.diff(np.r_[first, len(chosen)]), chosen[first].astype(np.int64) - first


def folded(data: bytes, rolling: Rolling, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The ``anchors``, with the digest of each segment's bytes and how many times in a row it comes.

    Text of a short period has a segment for every period, all alike, which are one row. Digests
    are made in bounded runs, as the segments of such text overlap by almost their whole length.
    """
    for keys, starts, runs, places in anchors(data, rolling, length, gram):
        ends = (starts + runs + length - 1).tolist()
        begins = starts.tolist()
        marks = np.concatenate([digests([data[a:b] for a, b in zip(begins[i : i + DIGESTS_AT_ONCE], ends[i : i + DIGESTS_AT_ONCE])]) for i in range(0, len(begins), DIGESTS_AT_ONCE)])
        new = np.flatnonzero(np.r_[True, (marks[1:] != marks[:-1]).any(axis=1) | (runs[1:] != runs[:-1])])
        yield keys[new], marks[new], starts[new], runs[new], places[new], np.diff(np.r_[new, len(keys)])


def digests(parts: list[bytes]) -> np.ndarray:
    """128-bit hashes as two columns."""
    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(p) for p in parts]), "<i8").reshape(-1, 2)


def maximal_repeats(segments: list[bytes], windows: list[int], length: int, rolling: Rolling, every: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All occurrences of all maximal repeats of at least ``length`` bytes: segment, offset, length of the repeat, number of the repeat.

    Segments are different from each other; suffixes start in the first ``windows`` bytes of each.
    Repeats are nested, so a suffix can be in many; without ``every`` only two occurrences of a
    segment come back: its first one, with the longest repeat there, and the one that reaches furthest.
    """
    none = tuple(np.zeros(0, np.int64) for _ in range(4))
    sizes = np.array([len(s) for s in segments])
    counts = np.array(windows)
    longest = int(sizes.max())
    body = np.frombuffer(b"".join(segments) + bytes(longest), np.uint8)
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(segments)), counts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = begins[owner] + offset
    # A suffix that no other shares its first ``length`` bytes with is in no interval that counts.
    heads = rolling.hashes(body, length)[at]
    _, inverse, times = np.unique(heads, return_inverse=True, return_counts=True)
    keep = np.flatnonzero(times[inverse] > 1)
    if not len(keep):
        return none
    owner, offset, at = owner[keep], offset[keep], at[keep]
    data = body.tobytes()
    ends = begins[owner] + sizes[owner]
    suffixes = [data[a:b] for a, b in zip(at.tolist(), ends.tolist())]
    order = np.array(sorted(range(len(suffixes)), key=suffixes.__getitem__))
    del suffixes
    owner, offset, at, rest = owner[order], offset[order], at[order], (ends - at)[order]
    common = np.zeros(len(at), np.int64)
    view = np.lib.stride_tricks.sliding_window_view(np.r_[body, np.zeros(1, np.uint8)], longest)
    for low in range(1, len(at), 1 << 15):
        high = min(len(at), low + (1 << 15))
        differs = view[at[low - 1 : high - 1]] != view[at[low:high]]
        first = np.where(differs.any(axis=1), differs.argmax(axis=1), longest)
        common[low:high] = np.minimum(first, np.minimum(rest[low - 1 : high - 1], rest[low:high]))
    left = np.where(offset > 0, body[at - 1].astype(np.int64), DIVERSE).tolist()
    depth = [*common.tolist(), 0]
    stack: list[list[int]] = []
    found: list[tuple[int, int, int]] = []
    for i in range(1, len(depth)):
        here, low, byte = depth[i], i - 1, left[i - 1]
        while stack and stack[-1][0] > here:
            deep, low, held = stack.pop()
            byte = held if held == byte else DIVERSE
            if byte == DIVERSE:
                found.append((deep, low, i))
        if here >= length:
            if stack and stack[-1][0] == here:
                if stack[-1][2] != byte:
                    stack[-1][2] = DIVERSE
            else:
                stack.append([here, low, byte])
        else:
            stack.clear()
    if not found:
        return none
    spans = np.array(found)
    if not every:
        deepest = np.full(len(at), -1)
        for number, (_, low, high) in enumerate(found):  # inner intervals come first
            inside = deepest[low:high]
            inside[inside < 0] = number
        row = np.flatnonzero(deepest >= 0)
        reach = offset[row] + spans[deepest[row], 0]
        edges = []
        for rank in (offset[row], -reach):
            sorted_ = row[np.lexsort((rank, owner[row]))]
            edges.append(sorted_[np.r_[True, np.diff(owner[sorted_]) != 0]])
        row = np.unique(np.concatenate(edges))
        return owner[row], offset[row], spans[deepest[row], 0], deepest[row]
    members = spans[:, 2] - spans[:, 1]
    number = np.repeat(np.arange(len(spans)), members)
    row = np.arange(len(number)) - np.repeat(np.cumsum(members) - members, members) + spans[number, 1]
    return owner[row], offset[row], spans[number, 0], number


SEGMENT = StructType([StructField("key", LongType()), StructField("s1", LongType()), StructField("s2", LongType()), StructField("start", IntegerType()), StructField("windows", IntegerType()), StructField("at", IntegerType()), StructField("times", IntegerType())])


def _segments(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``_id``, ``_hash`` and the segments of every text, without their bytes."""
    source = docs.select("_id", "_hash", F.col("_text").cast("binary").alias("data"))
    schema = StructType([source.schema["_id"], source.schema["_hash"], *SEGMENT.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling(CHUNK + length)

        def sent(batch: pa.RecordBatch, rows: list[np.ndarray], parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            take = pa.array(np.concatenate(rows))
            keys, marks, starts, runs, places, times = (np.concatenate(column) for column in zip(*parts))
            flat = [keys.view(np.int64), marks[:, 0], marks[:, 1], *(x.astype(np.int32) for x in (starts, runs, places, times))]
            return pa.RecordBatch.from_arrays([batch.column("_id").take(take), batch.column("_hash").take(take), *map(pa.array, flat)], names=schema.names)

        for batch in batches:
            rows, parts, held = [], [], 0
            for i, data in enumerate(batch.column("data")):
                for part in folded(data.as_py(), rolling, length, gram):
                    rows.append(np.full(len(part[0]), i))
                    parts.append(part)
                    held += len(part[0])
                    if held >= ROWS_AT_ONCE:
                        yield sent(batch, rows, parts)
                        rows, parts, held = [], [], 0
            if held:
                yield sent(batch, rows, parts)

    return source.mapInArrow(run, schema)


def _compared(pieces: DataFrame, length: int, every: bool) -> DataFrame:
    """Maximal repeats among the different ``pieces`` (``bucket``, ``p1``, ``p2``, ``windows``, ``data``) of each bucket."""

    def solved(rows: pd.DataFrame, rolling: Rolling) -> pd.DataFrame:
        data = rows["data"].tolist()
        owner, offset, size, number = maximal_repeats(data, rows["windows"].tolist(), length, rolling, every)
        names = {}
        for o, a, n, g in zip(owner.tolist(), offset.tolist(), size.tolist(), number.tolist()):
            if g not in names:
                names[g] = xxhash.xxh3_64_intdigest(data[o][a : a + n])
        group = np.array([names[g] for g in number.tolist()], U64).view(np.int64) if len(number) else number
        return pd.DataFrame({"p1": rows["p1"].to_numpy()[owner], "p2": rows["p2"].to_numpy()[owner], "repeat": group, "offset": offset.astype("int32"), "length": size.astype("int32")})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rolling, rest = Rolling(4 * ARRAY_BYTES), None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            buckets = rest["bucket"].to_numpy()
            new = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])
            size = np.cumsum(rest["data"].map(len).to_numpy())
            low = 0
            for edge in new[1:].tolist():  # whole buckets, as many as one suffix array may cover
                if size[edge - 1] - (size[low - 1] if low else 0) >= ARRAY_BYTES:
                    yield solved(rest.iloc[low:edge], rolling)
                    low = edge
            rest = rest.iloc[low:].reset_index(drop=True)
        if rest is not None and len(rest):
            buckets = rest["bucket"].to_numpy()
            new = [*np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]]).tolist(), len(rest)]
            size = np.cumsum(rest["data"].map(len).to_numpy())
            low = 0
            for edge in new[1:]:
                if edge == len(rest) or size[edge - 1] - (size[low - 1] if low else 0) >= ARRAY_BYTES:
                    yield solved(rest.iloc[low:edge], rolling)
                    low = edge

    placed = pieces.select("bucket", "p1", "p2", "windows", "data").repartition("bucket").sortWithinPartitions("bucket", "p1", "p2")
    return placed.mapInPandas(run, "p1 bigint, p2 bigint, repeat bigint, offset int, length int")


def _cut(pieces: DataFrame, windows: int, length: int) -> DataFrame:
    """Pieces of up to ``windows`` windows of the given ones, cut at fixed distances from the anchor.

    Equal windows are as far from their anchors, so they come into pieces of the same number; the bytes
    that all windows of that number share name the bucket. Of pieces of one window the bytes aren't sent on: they
    are equal if their hashes are.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for p1, p2, count, at, data in batch[["p1", "p2", "windows", "at", "data"]].itertuples(index=False):
                a = 0
                while a < count:
                    number = (at - a) // windows
                    low = number * windows
                    n = min(count - a, at - a - low + 1)
                    shared = data[at - low : at - low - windows + 1 + length]
                    bucket = xxhash.xxh3_64_intdigest(shared + number.to_bytes(4, "little"))
                    out.append((bucket - (1 << 64) if bucket >> 63 else bucket, data[a : a + n + length - 1], n, at - a, p1, p2, a))
                    a += n
            if out:
                buckets, parts, counts, places, p1, p2, offsets = zip(*out)
                marks = digests(list(parts))
                kept = parts if windows > 1 else [b""] * len(parts)
                yield pd.DataFrame({"bucket": buckets, "q1": marks[:, 0], "q2": marks[:, 1], "windows": counts, "at": places, "data": kept, "p1": p1, "p2": p2, "shift": offsets})

    return pieces.mapInPandas(run, "bucket bigint, q1 bigint, q2 bigint, windows int, at int, data binary, p1 bigint, p2 bigint, shift int")


def _bucket_sizes(pieces: DataFrame) -> DataFrame:
    sizes = materialize(pieces.groupBy("bucket").agg(F.count("*").alias("different")).where("different > 1"), "bucket-sizes")
    return pieces.join(sizes, "bucket")


def _repeats_in(pieces: DataFrame, length: int, cuts: tuple[int, ...], every: bool) -> DataFrame:
    """``p1``, ``p2``, ``repeat``, ``offset``, ``length`` for the different pieces of buckets with more than one."""
    out = _compared(pieces.where(F.col("different") <= BUCKET), length, every)
    large = pieces.where(F.col("different") > BUCKET)
    if not cuts or large.isEmpty():
        return out
    uses = materialize(_cut(large, cuts[0], length), "pieces")
    same = uses.groupBy("bucket", "q1", "q2").agg(F.count("*").alias("copies"), *[F.min(c).alias(c) for c in ("windows", "at", "data")])
    same = materialize(same.withColumnsRenamed({"q1": "p1", "q2": "p2"}), "different-pieces")
    whole = same.where("copies > 1").select("p1", "p2", F.xxhash64("p1", "p2").alias("repeat"), F.lit(0).alias("offset"), (F.col("windows") + length - 1).alias("length"))
    if cuts[1:]:
        whole = whole.unionByName(_repeats_in(materialize(_bucket_sizes(same), "piece-buckets"), length, cuts[1:], every))
    inner = materialize(whole, "piece-repeats").withColumnsRenamed({"p1": "q1", "p2": "q2"})
    if not every:
        inner = inner.groupBy("q1", "q2").agg(F.lit(None).cast("bigint").alias("repeat"), F.min("offset").alias("offset"), (F.max(F.col("offset") + F.col("length")) - F.min("offset")).cast("int").alias("length"))
    mapped = uses.select("q1", "q2", "p1", "p2", "shift").join(inner, ["q1", "q2"]).select("p1", "p2", "repeat", (F.col("offset") + F.col("shift")).alias("offset"), "length")
    return out.unionByName(mapped)


def _prepared(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(id_col).alias("_id"), body.alias("_text"), F.xxhash64(body).alias("_hash"))


def _same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["_id"].eqNullSafe(right["_id"]) & (left["_hash"] == right["_hash"])


def _repeats(docs: DataFrame, length: int, gram: int, every: bool) -> tuple[DataFrame, DataFrame]:
    """Occurrences of segments whose anchor is not unique, and the repeats in each different segment."""
    segments = materialize(_segments(docs, length, gram), "segments")
    keys = materialize(segments.groupBy("key").agg(F.sum("times").alias("n")).where("n > 1").select("key"), "repeated-anchors")
    shared = materialize(segments.join(keys, "key", "left_semi"), "shared-segments")
    different = shared.groupBy("key", "s1", "s2").agg(
        F.sum("times").alias("copies"), F.min("windows").alias("windows"), F.min("at").alias("at"), F.min(F.struct("_hash", "start", "_id")).alias("first")
    )
    different = materialize(different, "different-segments")
    whole = different.where("copies > 1").select(
        F.col("s1").alias("p1"), F.col("s2").alias("p2"), F.xxhash64("s1", "s2").alias("repeat"), F.lit(0).alias("offset"), (F.col("windows") + length - 1).alias("length")
    )
    crowded = _bucket_sizes(different.withColumnRenamed("key", "bucket"))
    wanted = crowded.select("bucket", "s1", "s2", "windows", "at", "different", "first.*")
    # The bytes of one copy of each different segment; where rows repeat, of either.
    fetched = wanted.join(docs, _same_row(wanted, docs)).select(
        "bucket", F.col("s1").alias("p1"), F.col("s2").alias("p2"), "windows", "at", "different",
        F.substring(F.col("_text").cast("binary"), F.col("start") + 1, F.col("windows") + length - 1).alias("data"),
    )
    pieces = materialize(fetched.dropDuplicates(["bucket", "p1", "p2"]), "segment-bytes")
    found = materialize(whole.unionByName(_repeats_in(pieces, length, PIECES, every)), "repeats")
    return shared, found.withColumnsRenamed({"p1": "s1", "p2": "s2"})


def repeat_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``repeat`` (number of the group), ``length``, ``id_col``, ``start``: every occurrence, in bytes, of every maximal repeat found.

    A repeat is maximal within the segments of its anchor; a longer common stretch comes as a chain of
    overlapping repeats. Null texts count as empty; shorter texts than ``length`` have none.
    """
    shared, found = _repeats(_prepared(docs, id_col, text), length, gram, True)
    # A segment that comes several times in a row is one row here.
    begins = F.transform(F.sequence(F.lit(0), F.col("times") - 1), lambda n: F.col("start") + n * F.col("windows") + F.col("offset"))
    return shared.join(found, ["s1", "s2"]).select("repeat", "length", F.col("_id").alias(id_col), F.explode(begins).alias("start"))


CLEANED = StructType([StructField("kept", BinaryType()), StructField("n_removed", LongType()), StructField("n_spans", LongType())])


def _without(data: bytes, spans: list) -> tuple[bytes, int, int]:
    """What is left without the union of ``spans``, bytes removed, runs of removed bytes."""
    kept, end, removed, runs = [], 0, 0, 0
    for a, b in sorted((s["a"], s["b"]) for s in spans):
        if runs and a <= end:
            removed += max(0, b - end)
            end = max(end, b)
            continue
        kept.append(data[end:a])
        removed, end, runs = removed + b - a, b, runs + 1
    return b"".join(kept) + data[end:], removed, runs


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``id_col``, ``kept`` (binary: the bytes left), ``n_bytes``, ``n_removed``, ``n_spans`` for every row of ``docs``.

    A byte goes if a string of ``length`` bytes over it also starts elsewhere, in any document
    or row. All is judged on the texts as they are; no first copy is spared. Null texts are
    empty. Rows that share an id are told apart by their texts; equal rows are copies of each other.
    Very long texts are worked off in chunks of ``CHUNK`` bytes; equal segments in a row, as in text of
    one repeated letter, are one row. Other columns, whatever their names, are not looked at.
    """
    rows = _prepared(docs, id_col, text)
    shared, found = _repeats(rows, length, gram, False)
    # Repeats of a segment all overlap, also with those of the next of the same in a row: each is longer than a segment has windows.
    cover = materialize(found.groupBy("s1", "s2").agg(F.min("offset").alias("low"), F.max(F.col("offset") + F.col("length")).alias("high")), "covered")
    spans = shared.join(cover, ["s1", "s2"]).select("_id", "_hash", F.struct((F.col("start") + F.col("low")).alias("a"), (F.col("start") + (F.col("times") - 1) * F.col("windows") + F.col("high")).alias("b")).alias("span"))
    # At most one span for each segment of the text.
    per_doc = materialize(spans.groupBy("_id", "_hash").agg(F.collect_set("span").alias("spans")), "spans")
    joined = rows.join(per_doc, _same_row(rows, per_doc), "left").select(rows["_id"], F.col("_text").cast("binary").alias("data"), "spans")

    @F.pandas_udf(CLEANED)
    def clean(data: pd.Series, spans: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_without(d, s) for d, s in zip(data, spans)], columns=CLEANED.names)

    none = F.col("spans").isNull()
    cleaned = clean(F.when(~none, F.col("data")).otherwise(F.lit(b"")), F.coalesce("spans", F.array().cast("array<struct<a:int,b:int>>")))
    return joined.withColumn("c", cleaned).select(
        F.col("_id").alias(id_col),
        F.when(none, F.col("data")).otherwise(F.col("c.kept")).alias("kept"),
        F.octet_length("data").cast("bigint").alias("n_bytes"),
        F.col("c.n_removed").alias("n_removed"),
        F.col("c.n_spans").alias("n_spans"),
    )
