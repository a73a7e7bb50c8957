"""Operator 8: repeated passages of 100 bytes or more, by suffix arrays of shards.

A byte is removed if a string of 100 bytes that covers it also starts earlier: in a document of
a smaller key, or earlier in the same one. Suffix arrays are induced for shards of the text that
can hold repeats, not for all of it, and every repeat lies whole in one shard:

* Winnowing picks anchors: the places whose hash of 32 bytes is the least of those in some window
  of 100 bytes. Equal windows pick equal anchors, so equal windows meet at an anchor's hash. An
  anchor's segment is what the windows that hold it cover.
* Among the segments of one anchor hash, equal ones are settled by a hash of the segment: all but
  the first are covered whole. Tasks do this before the shuffle, so a passage that many documents
  share sends one row per slice of text.
* The distinct segments of an anchor hash that has several go to shards, a shard holding all of
  a hash. There the suffix array is induced and the permuted common prefixes computed; runs of
  suffixes with 100 common bytes are equal windows, and all but the first are covered.
* A hash with more distinct segments than one shard takes is split first: each segment's windows
  in two halves, each half under the hash of the bytes its windows share. Halves that are equal,
  or alone under their hash, are settled by that; the rest go to shards, or are split again.

Whole texts are shuffled twice, to cut what goes on after the first settling and to remove what was
found. Segments are split as cut, and halves are cut from them.

Texts are compared by two 64-bit hashes or bytes; the shards hold whole hashes in bounded bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import keyed, slices, staged
from assay.llm.hashing import BYTE_VALUES, Powers, mix
from assay.llm.induced import common_prefixes, suffix_array

LENGTH = 100
GRAM = 32
REACH = LENGTH - GRAM
# Bytes of segments whose suffix array a task induces at once.
SHARD_BYTES = 1024 * 1024
# Distinct segments of one anchor hash that go to a shard.
SHARD_SEGMENTS = 10_000
_SECOND = 0x5851F42D4C957F2D


def _slide(values: np.ndarray, width: int, choose) -> np.ndarray:
    """``choose`` (minimum or maximum) over each run of ``width`` values."""
    done, out = 1, values
    while 2 * done <= width:
        out = choose(out[:-done], out[done:])
        done *= 2
    if done < width:
        out = choose(out[: len(out) - (width - done)], out[width - done :])
    return out


class Slice:
    """Bytes of documents of at least ``LENGTH`` bytes, with hashes of any run of them."""

    def __init__(self, texts: list[bytes], cache: Powers):
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        n = len(self.data)
        up, self.down = cache.upto(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUES[self.data] * up[:n], out=self.sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, place among all bytes, hash) of the anchors, in order."""
        n = len(self.data)
        at = np.arange(n - GRAM + 1)
        grams = self.hashes(at, at + GRAM) | np.uint64(1)
        least = _slide(grams, REACH + 1, np.minimum)
        owner = np.repeat(np.arange(len(self.starts)), self.lengths)
        ends = (self.starts + self.lengths)[owner[: len(least)]]
        least[np.arange(len(least)) + LENGTH > ends] = 0  # a window of two documents
        padded = np.zeros(len(grams) + REACH, np.uint64)
        padded[REACH : REACH + len(least)] = least
        most = _slide(padded, REACH + 1, np.maximum)
        place = np.flatnonzero(grams == most)
        return owner[place], place, grams[place]


# A segment is a run of bytes of a row, and its windows all runs of LENGTH bytes in it. It lies in
# the same way about the same anchor in every document, so it may reach over the text's ends.
_SENT = "kind byte, key long, seg long, row long, start int, end int"
_TYPES = [pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
_NAMES = ["kind", "key", "seg", "row", "start", "end"]
SEGMENT, COVER, VARIANT = 0, 1, 2


def _batch(kind: int, key, seg, row, start, end) -> pa.RecordBatch:
    columns = [np.full(len(row), kind), key, seg, row, start, end]
    arrays = [pa.array(np.asarray(c).astype(t.to_pandas_dtype())) for c, t in zip(columns, _TYPES, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=_NAMES)


def _send_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = Powers()
    for batch in batches:
        rows, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
        for a, b in slices([len(t or b"") for t in texts]):
            long = [i for i in range(a, b) if texts[i] and len(texts[i]) >= LENGTH]
            if not long:
                continue
            part = Slice([texts[i] for i in long], cache)
            owner, place, key = part.anchors()
            first, last = part.starts[owner], (part.starts + part.lengths)[owner]
            start, end = np.maximum(place - REACH, first), np.minimum(place + LENGTH, last)
            seg = part.hashes(start, end) + mix(((place - start) << 32 | (end - place)).astype(np.uint64))
            at = place - first
            yield from _segments(key, seg, rows[long][owner].astype(np.int64), at - REACH, at + LENGTH)


def _segments(key, seg, row, start, end) -> Iterator[pa.RecordBatch]:
    """The first of each group of equal segments to be sent, and covers for the others."""
    order = np.lexsort((start, row, seg, key))

    def repeats(*columns) -> np.ndarray:
        same = np.zeros(len(order), bool)
        same[1:] = np.logical_and.reduce([c[order][1:] == c[order][:-1] for c in columns])
        return same

    # Halves of two anchors of one text can be the same run; it is no copy of itself.
    order = order[~repeats(key, seg, row, start)]
    again = repeats(key, seg)
    one, more = order[~again], order[again]
    yield _batch(SEGMENT, key[one].view(np.int64), seg[one].view(np.int64), row[one], start[one], end[one])
    if len(more):
        yield _covers(row[more], start[more], end[more])


def _covers(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """Covered runs, joined where they touch."""
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    # Rows are set apart far enough that the running maximum of ends cannot cross over.
    base = np.cumsum(np.concatenate([[0], (row[1:] != row[:-1]).astype(np.int64)])) << 32
    reach = np.maximum.accumulate(base + end)
    new = np.ones(len(row), bool)
    new[1:] = base[1:] + start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    stop = reach[np.append(at[1:], len(row)) - 1] - base[at]
    return _batch(COVER, row[at], np.zeros(len(at)), row[at], start[at], stop)


def _settle_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (kind, key, seg, row, start). Equal segments but the first become covers;
    the first of each of several distinct segments of a key is passed on."""
    last = (None, None)
    held: dict | None = None  # the last distinct segment, and whether it has been passed on
    for batch in batches:
        table = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in _NAMES}
        cover = table["kind"] == COVER
        if cover.any():
            yield batch.filter(pa.array(cover))
        t = {n: v[~cover] for n, v in table.items()}
        if not len(t["key"]):
            continue
        same_key = np.concatenate([[t["key"][0] == last[0]], t["key"][1:] == t["key"][:-1]])
        same = same_key & np.concatenate([[t["seg"][0] == last[1]], t["seg"][1:] == t["seg"][:-1]])
        last = (t["key"][-1], t["seg"][-1])
        if same.any():
            yield _covers(t["row"][same], *(t[n][same].astype(np.int64) for n in ("start", "end")))
        first = {n: t[n][~same] for n in ("key", "row", "start", "end")}
        sent = np.zeros(len(first["key"]), bool)
        if held is not None:
            first = {n: np.concatenate([[held[n]], v]).astype(np.int64) for n, v in first.items()}
            sent = np.concatenate([[held["sent"]], sent])
        if not len(first["key"]):
            continue
        alike = first["key"][1:] == first["key"][:-1]
        several = np.concatenate([alike, [False]]) | np.concatenate([[False], alike]) | sent
        out = several & ~sent
        if out.any():
            yield _batch(
                VARIANT, first["key"][out], np.zeros(out.sum()), first["row"][out], first["start"][out], first["end"][out]
            )
        held = {n: v[-1] for n, v in first.items()} | {"sent": bool(several[-1])}


# A cut segment: ``start`` and ``end`` are the segment's, ``piece`` what the text has of it.
_PIECES = "key long, row long, start int, end int, piece binary"


def _cut(batches: Iterator[pa.RecordBatch], runs_of) -> Iterator[pa.RecordBatch]:
    """Pieces of segments; ``runs_of`` gives (start, end, bytes) of what a row's source holds."""
    for batch in batches:
        out: dict[str, list] = {n: [] for n in ("key", "row", "start", "end", "piece")}
        for row, source, segments in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            runs = runs_of(source)
            for s in segments:
                start, end = s["start"], s["end"]
                low, _, data = next(r for r in runs if r[0] <= start and end <= r[1])
                low, begin = max(low, 0), max(start, 0)
                found = (s["key"], row, start, end, data[begin - low : end - low])
                for name, value in zip(out, found, strict=True):
                    out[name].append(value)
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_pydict(
            {n: pa.array(v, t) for (n, v), t in zip(out.items(), types, strict=True)}
        )


def _cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of whole texts, over whose ends they may reach."""
    return _cut(batches, lambda text: [(-REACH, len(text) + LENGTH, text)])


def _cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Halves of segments that are cut already; any that holds a half will do."""
    return _cut(batches, lambda held: [(p["start"], p["end"], p["piece"]) for p in held])


def _split_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each segment as two, with the first and the second half of its windows."""
    cache = Powers()
    for batch in batches:
        if not batch.num_rows:
            continue
        key, row, start, end = (
            batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("key", "row", "start", "end")
        )
        part = Slice(batch.column("piece").to_pylist(), cache)
        # Where the text's byte 0 would be among the bytes of the pieces, and the text's last window.
        low = np.maximum(start, 0)
        origin, final = part.starts - low, low + part.lengths - LENGTH
        last = end - LENGTH  # the last window
        middle = (start + last) // 2
        halves = [(start, middle, key, row, origin, final, low), (middle + 1, last, key, row, origin, final, low)]
        a, b, key, row, origin, final, low = (np.concatenate(x) for x in zip(*halves, strict=True))
        first, final = np.maximum(a, low), np.minimum(b, final)
        some = first <= final
        a, b, key, row, origin, first, final = (x[some] for x in (a, b, key, row, origin, first, final))
        seg = part.hashes(origin + first, origin + final + LENGTH)
        seg += mix(((first - a) << 32 | (b - final)).astype(np.uint64))
        # The bytes that all windows of the half share, at their place in it.
        shared = part.hashes(origin + b, origin + a + LENGTH)
        key = shared + mix(key.view(np.uint64) + np.uint64(_SECOND)) + mix((b - a).astype(np.uint64))
        yield from _segments(key, seg, row, a, b + LENGTH)


def repeated_windows(pieces: list[bytes], row: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, start) of the windows of ``LENGTH`` bytes in pieces that occur earlier in another place."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    text = np.frombuffer(b"".join(pieces), np.uint8)
    sa = suffix_array(text)
    group = np.cumsum(common_prefixes(text, sa) < LENGTH)
    owner = np.repeat(np.arange(len(pieces)), lengths)
    inside = np.arange(len(text)) - (np.cumsum(lengths) - lengths)[owner]
    whole = (lengths[owner] - inside >= LENGTH)[sa]
    sa, group = sa[whole], group[whole]
    rows, starts = row[owner[sa]], start[owner[sa]] + inside[sa]
    order = np.lexsort((starts, rows, group))
    rows, starts, group = rows[order], starts[order], group[order]
    # A window may come in several pieces: only its place counts.
    first = np.ones(len(group), bool)
    first[1:] = group[1:] != group[:-1]
    lead = np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
    later = (rows != rows[lead]) | (starts != starts[lead])
    return rows[later], starts[later]


def _settle_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key; a shard is a run of whole keys."""
    keys: list[int] = []
    rows: list[int] = []
    starts: list[int] = []
    pieces: list[bytes] = []
    size = 0

    def settle():
        row, start = repeated_windows(pieces, np.array(rows, np.int64), np.array(starts, np.int64))
        if len(row):
            yield _covers(row, start, start + LENGTH)

    for batch in batches:
        for key, row, start, piece in zip(*(batch.column(n).to_pylist() for n in ("key", "row", "start", "piece")), strict=True):
            if size >= SHARD_BYTES and key != keys[-1]:
                yield from settle()
                keys, rows, starts, pieces, size = [], [], [], [], 0
            keys.append(key)
            rows.append(row)
            starts.append(start)
            pieces.append(piece)
            size += len(piece)
    if pieces:
        yield from settle()


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {n: [] for n in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "runs")}
        for text, covers in zip(batch.column("body").to_pylist(), batch.column("covers").to_pylist(), strict=True):
            text, runs = text or b"", []
            size = len(text)
            for start, end in sorted((max(c["start"], 0), min(c["end"], size)) for c in covers or ()):
                if runs and start <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], end)
                else:
                    runs.append([start, end])
            kept, at = hashlib.sha256(), 0
            for start, end in runs:
                kept.update(text[at:start])
                at = end
            kept.update(text[at:])
            out["n_bytes"].append(len(text))
            out["n_removed"].append(sum(b - a for a, b in runs))
            out["n_spans"].append(len(runs))
            out["kept_sha256"].append(kept.hexdigest())
            out["runs"].append([x for run in runs for x in run])
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), *[pa.array(out[n], pa.int64()) for n in ("n_bytes", "n_removed", "n_spans")],
             pa.array(out["kept_sha256"], pa.string()), pa.array(out["runs"], pa.list_(pa.int32()))],
            names=["key", *out],
        )


def find_repeats(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    shard_segments: int = SHARD_SEGMENTS,
) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, removed_runs), a row for each document.

    ``removed_runs`` are byte offsets, flattened as start, end exclusive. A null text is empty:
    nothing is removed from it, nor from one shorter than 100 bytes. Rows of equal keys are
    documents of their own, in an order that is fixed by their text; null keys come last.
    Further columns are not looked at.
    """
    rows, _ = keyed(documents, key, text)
    rows = rows.select("row", "key", F.col("body").cast("binary").alias("body")).where("row is not null")

    def settled(sent: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(covers, segments left) of segments that meet at their keys."""
        done = staged(
            sent.repartition("key")
            .sortWithinPartitions("kind", "key", "seg", "row", "start")
            .mapInArrow(_settle_segments, _SENT),
            "segments",
        )
        return (
            done.where(F.col("kind") == COVER).select("row", "start", "end"),
            done.where(F.col("kind") == VARIANT).select("key", "row", "start", "end"),
        )

    def beside(segments: DataFrame, source: DataFrame) -> DataFrame:
        """(row, what ``source`` has of it, its segments)."""
        wanted = segments.groupBy("row").agg(
            F.collect_list(F.struct("key", "start", "end")).alias("segments")
        )
        return source.join(wanted.withColumnRenamed("row", "at"), F.col("row") == F.col("at")).drop("at")

    found, left = settled(rows.select("row", "body").mapInArrow(_send_anchors, _SENT))
    cut = staged(beside(left, rows.select("row", "body")).mapInArrow(_cut_texts, _PIECES), "pieces")
    to_shards = []
    while True:
        # Halving ends with single windows, which are equal wherever they meet.
        often = cut.groupBy("key").count().where(F.col("count") > shard_segments).select("key")
        often = staged(often, "often")  # several joins read it
        to_shards.append(cut.join(often, "key", "left_anti"))
        if often.isEmpty():
            break
        hot = cut.join(often, "key", "left_semi")
        covers, left = settled(hot.mapInArrow(_split_segments, _SENT))
        found = found.union(covers)
        held = hot.groupBy("row").agg(F.collect_list(F.struct("start", "end", "piece")).alias("held"))
        cut = staged(beside(left, held).mapInArrow(_cut_pieces, _PIECES), "pieces")
    sharded = (
        reduce(DataFrame.union, [s.select("key", "row", "start", "piece") for s in to_shards])
        .withColumn("start", F.greatest("start", F.lit(0)))
        .repartition("key")
        .sortWithinPartitions("key", "row", "start")
        .mapInArrow(_settle_shards, _SENT)
        .select("row", "start", "end")
    )
    found = found.union(sharded)
    covers = (
        found.groupBy("row")
        .agg(F.collect_list(F.struct("start", "end")).alias("covers"))
        .withColumnRenamed("row", "covered_row")
    )
    kind = rows.schema["key"].dataType.simpleString()
    return (
        rows.join(covers, F.col("row") == F.col("covered_row"), "left")
        .select("key", "body", "covers")
        .mapInArrow(_remove, f"key {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, runs array<int>")
        .select(F.col("key").alias(key), "n_bytes", "n_removed", "n_spans", "kept_sha256", F.col("runs").alias("removed_runs"))
    )
