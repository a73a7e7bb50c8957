"""Operator 5: documents whose sets of word 5-grams are alike, by prefix filtering.

Shingles are ordered rare first: by a count sketch over all documents, then by hash. Two sets
of Jaccard similarity t share a shingle in their prefixes under any such order, so a document
sends only the shingles of its prefix to the join (shorter documents of a pair a still shorter
one). Where two documents meet at a shingle, the length filter compares their sizes and the
positional filter what can follow in both; the suffix filter then compares how their shingles fall
into ranges of hashes, by the parity of each range. What passes is verified once, on the whole sets.

Copies and hot shingles are never paired with each other in full:

* equal sets are one class, found by a 128-bit signature; of the largest classes, bounded in
  number, the first row alone is sent, of others one from each task;
* at each shingle the documents of about one size are first paired with one of them only (a
  star), which a hash picks, in one of a few ways; a shingle too frequent for one task is salted,
  and the salts' stars are paired too;
* more rounds of stars follow at the shingles that still hold two components, each with leads of its
  own choice; only rows and leads of different components are tried, so near copies that are linked
  by some of their neighbours alone find one of them;
* only documents that no verified link has joined by then are paired in full, so no link between
  components is lost, and links inside a component add nothing. Such a pair is made only where the
  suffix filter leaves room for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.common import arrow_batches, clear_name, keyed, map_texts, slices, staged
from assay.llm.components import components
from assay.llm.hashing import SPACED_LOWER, Powers, hash_words, mix, windows
from assay.llm.sketch import as_levels, count_values, from_levels, is_any, mean_count

SHINGLE = 5
# The threshold is THRESHOLD / 100.
THRESHOLD = 75
# Shingles of all documents for each slot of the count sketch, and the most slots, as a power of
# two: a slot is a byte with every task, so at most 32 MB. Beyond, rare shingles of one slot get
# harder to tell apart and more pairs are tried; results are the same.
SLOT_SHINGLES = 8
SKETCH_BITS = (16, 25)
# Occurrences of a shingle, above the sketch's mean, that one salt takes.
SALT_ROWS = 50_000
# Orders in which documents that meet at a shingle are led; a shingle has one of them.
ORDERS = 8
# Classes of equal sets, the largest ones, whose first row every task knows.
KNOWN_CLASSES = 50_000
# Rounds of stars between components, and the leads that each shingle has in one. What they leave
# apart is paired in full, so this is a matter of cost alone.
ROUNDS = 1
LEADS = 4
# Longs of parity bits for each set: 512 ranges of hashes that the suffix filter compares.
PARITY_WORDS = 8
# Slots of the bitmap of rows to verify for each pair, and the most, as a power of two.
PAIR_SLOTS = 8
BITMAP_BITS = (16, 24)
# Bytes of text whose words are hashed together.
SLICE_BYTES = 256 * 1024
# Bytes of rows, texts or pairs of sets, that Spark hands to a task's Python at once.
BATCH_BYTES = 4 * 1024 * 1024


def shingle_sets(texts: list[bytes | None], cache: Powers) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the distinct shingles of text i, ascending, are hashes[bounds[i]:bounds[i+1]].

    A text of fewer than five words, but not none, has one shingle of all its words.
    """
    words = hash_words(texts, SPACED_LOWER, cache)
    first, hashes = windows(words, SHINGLE)
    owner = words.text[first]
    few = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    if len(few):
        whole = []
        for i in few:
            value = np.array([words.counts[i]], np.uint64)
            for j in range(words.bounds[i], words.bounds[i + 1]):
                value = mix(value * np.uint64(3) + words.hash[j])
            whole.append(value)
        hashes = np.concatenate([hashes, *whole])
        owner = np.concatenate([owner, few])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(len(texts) + 1))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set that do not depend on its order."""
    return (
        _sums(mix(hashes), bounds).view(np.int64),
        _sums(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), bounds).view(np.int64),
    )


def parities(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each set PARITY_WORDS longs of bits: whether an odd number of its shingles falls there."""
    n, width = len(bounds) - 1, 64 * PARITY_WORDS
    owner = np.repeat(np.arange(n), np.diff(bounds))
    slots = (mix(hashes) % np.uint64(width)).astype(np.int64)
    odd = (np.bincount(owner * width + slots, minlength=n * width) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(n, width), axis=1).view(np.int64)


def _make_signatures():
    cache = Powers()

    def call(texts):
        hashes, bounds = shingle_sets(texts, cache)
        one, two = signatures(hashes, bounds)
        return {"size": np.diff(bounds), "s1": one, "s2": two, "parity": list(parities(hashes, bounds))}

    return call


def _make_values():
    cache = Powers()

    def call(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        sizes = pc.binary_length(batch.column(0)).fill_null(0).to_pylist()
        for a, b in slices(sizes, SLICE_BYTES):
            yield shingle_sets(batch.column(0).slice(a, b - a).to_pylist(), cache)[0]

    return call


def probe_prefix(n):
    """Shingles of a set of ``n`` that a pair with a set of its size or smaller must meet in."""
    return n - (THRESHOLD * n + 99) // 100 + 1


def index_prefix(n):
    """The same for a pair with a set of its size or larger."""
    both = 100 + THRESHOLD
    return n - (2 * THRESHOLD * n + both - 1) // both + 1


def _first_rows(known: np.ndarray, one, two, sizes, rows) -> np.ndarray:
    """The first row of each set's class, of those known, else the row itself."""
    if not len(known):
        return rows
    at = np.minimum(np.searchsorted(known["s1"], one), len(known) - 1)
    found = known[at]
    same = (found["s1"] == one) & (found["s2"] == two) & (found["size"] == sizes)
    return np.where(same, found["first"], rows)


_CLASS = [("s1", "<i8"), ("s2", "<i8"), ("size", "<i8"), ("first", "<i8")]


def _make_prefixes(shared):
    def make():
        sketch, mean, known = shared.value
        cache, seen = Powers(), set()
        times = from_levels(np.arange(256)).astype(np.int64)

        def call(texts, rows):
            hashes, bounds = shingle_sets(texts, cache)
            one, two = signatures(hashes, bounds)
            counts = sketch[(hashes & np.uint64(len(sketch) - 1)).astype(np.int64)]
            out = {"size": np.diff(bounds), "tokens": [], "salts": []}
            first = _first_rows(known, one, two, np.diff(bounds), np.array(rows, np.int64))
            for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                mark = (int(one[i]), int(two[i]), int(b - a))
                # No set, or an equal one is sent: by its class, or by this task already.
                if a == b or first[i] != rows[i] or mark in seen:
                    out["tokens"].append([])
                    out["salts"].append([])
                    continue
                seen.add(mark)
                order = np.lexsort((hashes[a:b], counts[a:b]))[: probe_prefix(b - a)]
                often = np.maximum(times[counts[a:b][order]] - mean, 0) // SALT_ROWS
                which = int(one[i]) & 0x7FFFFFFF
                out["tokens"].append(hashes[a:b][order].view(np.int64))
                out["salts"].append(np.where(often > 0, 1 + which % (often + 1), 0).astype(np.int32))
            return out

        return call

    return make


_MET = "token long, salt int, row long, size int, pos int, lead_row long, lead_size int, lead_pos int"
_OF_LEAD = ("row", "size", "pos")


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (token, salt, level) and their order. Each row of a token that two rows
    or a salt share gets the first row of its token, salt and level of size as its lead."""
    names = ("token", "salt", "level", *_OF_LEAD)
    held = {n: np.zeros(0, np.int64) for n in names}  # the last row, if alone so far
    lead = None  # token, salt, class, row, size, pos of the current lead
    many = False  # whether the current token has been sent a row of
    for batch in batches:
        now = {n: batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names}
        now = {n: np.concatenate([held[n], now[n]]) for n in names}
        n = len(now["token"])
        if not n:
            continue
        group = np.flatnonzero(
            np.concatenate([[True], (np.diff(now["token"]) != 0) | (np.diff(now["salt"]) != 0)])
        )
        which = np.cumsum(np.isin(np.arange(n), group)) - 1
        rows_of = np.diff(np.append(group, n))
        shared = (rows_of > 1) | (now["salt"][group] > 0)
        goes_on = lead is not None and (lead[0], lead[1]) == (now["token"][0], now["salt"][0])
        if goes_on and many:
            shared[0] = True
        kind = now["level"]
        begins = np.zeros(n, bool)
        begins[group] = True
        begins[1:] |= kind[1:] != kind[:-1]
        if goes_on and lead[2] == kind[0] and len(held["token"]) == 0:
            begins[0] = False
        at = np.maximum.accumulate(np.where(begins, np.arange(n), -1))
        leads = {
            f: np.where(at >= 0, now[f][np.maximum(at, 0)], lead[3 + j] if lead else 0)
            for j, f in enumerate(_OF_LEAD)
        }
        last_alone = rows_of[-1] == 1 and not shared[-1]
        send = shared[which]
        if send.any():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(now["token"][send], pa.int64()),
                    pa.array(now["salt"][send].astype(np.int32)),
                    pa.array(now["row"][send], pa.int64()),
                    pa.array(now["size"][send].astype(np.int32)),
                    pa.array(now["pos"][send].astype(np.int32)),
                    pa.array(leads["row"][send], pa.int64()),
                    pa.array(leads["size"][send].astype(np.int32)),
                    pa.array(leads["pos"][send].astype(np.int32)),
                ],
                names=[f.split()[0] for f in _MET.split(", ")],
            )
        lead = (now["token"][-1], now["salt"][-1], kind[-1], *(leads[f][-1] for f in _OF_LEAD))
        many = bool(shared[-1])
        held = {f: now[f][-1:] if last_alone else now[f][:0] for f in names}


def level_of(size: Column, shift: float = 0.0) -> Column:
    """Class of sizes: sizes that can link are in one class or in neighbouring ones."""
    return F.floor(F.log(size) / F.log(F.lit(100 / THRESHOLD)) + F.lit(shift + 1e-9)).cast("int")


def meet(prefixes: DataFrame, order: Column, shift: float = 0.0, tokens: Column | None = None) -> DataFrame:
    """Rows (token, salt, row, size, pos) that share their token, each with a lead: the first by
    ``order`` of its token, salt and class of sizes.

    ``tokens`` makes an array of tokens of one; a row comes with each, and is shuffled once.
    """
    dealt = prefixes.select("token", "salt", *_OF_LEAD).repartition("token", "salt")
    if tokens is not None:
        dealt = dealt.withColumn("token", F.explode(tokens))
    return (
        dealt.select("token", "salt", level_of(F.col("size"), shift).alias("level"), *_OF_LEAD)
        .sortWithinPartitions("token", "salt", "level", order)
        .mapInArrow(_stars, _MET)
    )


def may_link(size_a: Column, pos_a: Column, size_b: Column, pos_b: Column) -> Column:
    """Length, prefix and positional filters for a first common shingle; a is no larger than b."""
    wanted = F.ceil(F.lit(THRESHOLD) * (size_a + size_b) / F.lit(100 + THRESHOLD) - F.lit(1e-9))
    both = 100 + THRESHOLD
    index = size_a - F.floor((2 * THRESHOLD * size_a + both - 1) / both) + 1
    return (
        (THRESHOLD * size_b <= 100 * size_a)
        & (pos_a < index)
        & (F.least(size_a - pos_a, size_b - pos_b) >= wanted)
    )


def may_be_alike(size_a: Column, parity_a: Column, size_b: Column, parity_b: Column) -> Column:
    """Whether the sets' parities leave room for enough common shingles.

    Shingles of both sets cancel out, so at least as many are in one of them alone as bits differ.
    """
    wanted = F.ceil(F.lit(THRESHOLD) * (size_a + size_b) / F.lit(100 + THRESHOLD) - F.lit(1e-9))
    apart = F.lit(0)
    for i in range(PARITY_WORDS):
        apart = apart + F.bit_count(F.get(parity_a, F.lit(i)).bitwiseXOR(F.get(parity_b, F.lit(i))))
    return apart <= size_a + size_b - 2 * wanted


def _make_sets(shared):
    def make():
        cache, wanted = Powers(), shared.value

        def call(texts, rows):
            marks = mix(np.array(rows, np.int64).view(np.uint64)) & np.uint64(len(wanted) - 1)
            hit = wanted[marks.astype(np.int64)]
            hashes, bounds = shingle_sets([t if h else None for t, h in zip(texts, hit, strict=True)], cache)
            own = [hashes[a:b].tobytes() if b > a else None for a, b in zip(bounds, bounds[1:], strict=False)]
            return {"set": own}

        return call

    return make


def _marks_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    yield mix(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))


def _needed(a: int, b: int) -> int:
    return -(-THRESHOLD * (a + b) // (100 + THRESHOLD))


def _sets_of(column: pa.Array) -> Iterator[np.ndarray]:
    """The sets of a column, each a view of the batch's bytes."""
    for value in column:
        yield np.frombuffer(value.as_buffer(), np.uint64)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(_sets_of(batch.column("set_a")), _sets_of(batch.column("set_b")), strict=True):
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * common >= THRESHOLD * (len(x) + len(y) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def verified(rows: DataFrame, signed: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, each verified once. ``rows`` is (row, body); ``signed`` has sizes
    and parities, by which most pairs that cannot link go before any set is made."""
    spark = rows.sparkSession

    def beside(df: DataFrame, other: DataFrame, *names: str) -> DataFrame:
        for side in ("a", "b"):
            named = [F.col(n).alias(f"{n}_{side}") for n in names]
            df = df.join(other.select(F.col("row").alias(side), *named), side)
        return df

    alike = staged(
        beside(pairs, signed, "size", "parity")
        .where(may_be_alike(F.col("size_a"), F.col("parity_a"), F.col("size_b"), F.col("parity_b")))
        .select("a", "b"),
        "alike",
    )
    both = alike.select(F.col("a").alias("row")).union(alike.select("b"))
    # A bitmap picks the rows whose sets are made; the joins settle the rest.
    bits = (PAIR_SLOTS * alike.count()).bit_length()
    bits = min(max(bits, BITMAP_BITS[0]), BITMAP_BITS[1])
    bitmap = count_values(both, lambda: _marks_of, bits, is_any).view(bool)
    shared = spark.sparkContext.broadcast(bitmap)
    sets = staged(
        map_texts(
            rows, _make_sets(shared), "set binary", text="body", inputs=("row",), keep=("row",), limit=SLICE_BYTES
        ).where(F.col("set").isNotNull()),
        "sets",
    )
    return staged(beside(alike, sets, "set").mapInArrow(_verify, "a long, b long"), "linked")


def star_pairs(met: DataFrame, order: Column, shift: float = 0.0) -> DataFrame:
    """Distinct pairs (a, b) of rows and their leads that pass the filters; a is the smaller. The leads
    of one token's salts meet as well."""
    leads = met.where("salt > 0 and row = lead_row").select("token", F.lit(0).alias("salt"), *_OF_LEAD)
    led = met.unionByName(meet(leads, order, shift))
    first = F.struct("lead_size", "lead_row") < F.struct("size", "row")

    def side(mine: bool, name: str) -> Column:
        return F.when(first if mine else ~first, F.col(f"lead_{name}")).otherwise(F.col(name))

    return (
        led.where("row <> lead_row")
        .where(may_link(side(True, "size"), side(True, "pos"), side(False, "size"), side(False, "pos")))
        .select(side(True, "row").alias("a"), side(False, "row").alias("b"))
        .distinct()
    )


def apart_pairs(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """The pairs (a, b) of rows that no link has joined yet."""
    for side in ("a", "b"):
        named = joined.select(F.col("node").alias(side), F.col("component").alias(f"component_{side}"))
        pairs = pairs.join(named, side, "left")
    return pairs.where(
        F.coalesce("component_a", "a") != F.coalesce("component_b", "b")
    ).select("a", "b")


def as_links(joined: DataFrame) -> DataFrame:
    return joined.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))


def still_apart(met: DataFrame, joined: DataFrame) -> DataFrame:
    """Rows (token, salt, row, size, pos, component) at tokens that rows of two components share."""
    placed = met.join(joined, met["row"] == joined["node"], "left").select(
        "token", "salt", "row", "size", "pos", F.coalesce("component", "row").alias("component")
    )
    # A token that is not salted fits a task and is judged where its rows are; salts are summed up first.
    beside = Window.partitionBy("token", "salt")
    fits = (
        placed.where("salt = 0")
        .select("*", F.min("component").over(beside).alias("least"), F.max("component").over(beside).alias("most"))
        .where("least <> most")
        .drop("least", "most")
    )
    salted = placed.where("salt > 0")
    mixed = (
        salted.groupBy("token")
        .agg(F.min("component").alias("least"), F.max("component").alias("most"))
        .where("least <> most")
        .select("token")
    )
    return fits.unionByName(salted.join(mixed, "token"))


def crossing_pairs(apart: DataFrame, signed: DataFrame) -> DataFrame:
    """All distinct pairs (a, b) of rows of different components that share a token of their prefixes
    and pass the filters, that of parities among them."""
    rows = apart.join(signed.select("row", "parity"), "row")
    level = level_of(F.col("size"))
    names = ("row", "size", "pos", "component", "parity")
    one = rows.select(
        "token",
        F.explode(F.array(level, level + 1)).alias("level"),
        *[F.col(c).alias(f"{c}_a") for c in names],
    )
    two = rows.select("token", level.alias("level"), *[F.col(c).alias(f"{c}_b") for c in names])
    return (
        one.join(
            two,
            (one["token"] == two["token"])
            & (one["level"] == two["level"])
            & (F.col("component_a") != F.col("component_b"))
            & (F.struct("size_a", "row_a") < F.struct("size_b", "row_b"))
            & may_link(F.col("size_a"), F.col("pos_a"), F.col("size_b"), F.col("pos_b"))
            & may_be_alike(F.col("size_a"), F.col("parity_a"), F.col("size_b"), F.col("parity_b")),
        )
        .select(F.col("row_a").alias("a"), F.col("row_b").alias("b"))
        .distinct()
    )


def join_similar(documents: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id): one row for each row of ``documents``.

    ``component_id`` is the smallest key reachable over links, the row's own included. A row whose
    text is null or has no words has no shingles and links with nothing. Equal rows are in one
    component; rows that share a key are still separate documents; null keys come last, so a
    component is null only if all its keys are. Further columns are not looked at.
    """
    with arrow_batches(documents.sparkSession, BATCH_BYTES):
        return _join_similar(documents, key, text)


def _join_similar(documents: DataFrame, key: str, text: str) -> DataFrame:
    """What runs Python is written within; the result only joins what was."""
    spark = documents.sparkSession
    rows, numbered = keyed(documents, key, text)
    bodies = rows.select("row", "body")
    signed = staged(
        map_texts(
            rows,
            _make_signatures,
            "size long, s1 long, s2 long, parity array<long>",
            text="body",
            keep=("row", "key"),
            limit=SLICE_BYTES,
        ),
        "signatures",
    )
    filled = signed.where("size > 0")
    classes = filled.groupBy("size", "s1", "s2").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    copies = (
        filled.join(classes.where("n > 1"), ["size", "s1", "s2"])
        .where("row <> first")
        .select(F.col("first").alias("a"), F.col("row").alias("b"))
    )
    shingles = signed.agg(F.sum("size").alias("n")).first()["n"] or 0
    bits = min(max((shingles // SLOT_SHINGLES).bit_length(), SKETCH_BITS[0]), SKETCH_BITS[1])
    levels = count_values(rows.select(F.col("body").cast("binary").alias("t")), _make_values, bits, as_levels)
    largest = classes.where("n > 1").orderBy(F.desc("n"), "first").limit(KNOWN_CLASSES).toArrow()
    known = np.zeros(largest.num_rows, _CLASS)
    for name in known.dtype.names:
        known[name] = largest[name].to_numpy()
    shared = spark.sparkContext.broadcast((levels, mean_count(levels), np.sort(known, order=["s1", "s2", "size"])))
    sent = map_texts(
        rows,
        _make_prefixes(shared),
        "size int, tokens array<long>, salts array<int>",
        text="body",
        inputs=("row",),
        keep=("row",),
        limit=SLICE_BYTES,
    )
    prefixes = sent.select(
        "row", "size", F.posexplode(F.arrays_zip("tokens", "salts")).alias("pos", "at")
    ).select(
        F.col("at.tokens").alias("token"),
        F.col("at.salts").alias("salt"),
        "row",
        "size",
        "pos",
    )
    met = staged(meet(prefixes, F.xxhash64("row", F.pmod("token", F.lit(ORDERS)))), "met")
    met_once = met.select("token", "salt", "row", "size", "pos")
    tried = staged(star_pairs(met, F.xxhash64("row", F.pmod("token", F.lit(ORDERS)))), "stars")
    links = verified(bodies, signed, tried).union(copies)
    joined = components(links)
    # Rounds of stars at what is left apart, then all pairs of what they leave.
    apart = staged(still_apart(met_once, joined), "apart")
    for turn in range(ROUNDS):
        # Each lead of a shingle has a token of its own, and sizes fall into classes anew.
        led = F.array(*[F.xxhash64("token", F.lit(turn * LEADS + i)) for i in range(LEADS)])
        order, shift = F.xxhash64("row", "token"), turn / ROUNDS
        pairs = star_pairs(meet(apart, order, shift, led), order, shift).join(tried, ["a", "b"], "left_anti")
        pairs = staged(apart_pairs(pairs, joined), "stars")
        if pairs.isEmpty():
            break
        tried = tried.union(pairs)
        joined = components(as_links(joined).union(verified(bodies, signed, pairs)))
        apart = staged(still_apart(apart.drop("component"), joined), "apart")
    crossing = staged(crossing_pairs(apart, signed).join(tried, ["a", "b"], "left_anti"), "crossing")
    if not crossing.isEmpty():
        joined = components(as_links(joined).union(verified(bodies, signed, crossing)))
    result = signed.join(joined, signed["row"] == joined["node"], "left").select(
        "key", "size", F.coalesce("component", "row").alias("component")
    )
    if numbered:
        names = signed.select(F.col("row").alias("component"), F.col("key").alias("named"))
        result = result.join(names, "component").select("key", "size", F.col("named").alias("component"))
    return result.select(
        F.col("key").alias(key),
        F.col("size").alias("n_shingles"),
        F.col("component").cast(documents.schema[key].dataType).alias("component_id"),
    )


def keep_one(documents: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group of alike ones: that of the smallest key, nulls last.

    Rows are told apart by their keys where those are unique, else by numbers given in that order
    in a table written once; so of rows that repeat a key or have none one stays as well.
    """
    counts = documents.agg(
        F.count("*").alias("n"), F.count(key).alias("filled"), F.countDistinct(key).alias("distinct")
    ).first()
    number = key
    rows = documents
    if not counts["n"] == counts["filled"] == counts["distinct"]:
        number = clear_name(documents, "row_number")
        ordered = documents.orderBy(F.asc_nulls_last(key), F.xxhash64(text))
        rows = staged(ordered.withColumn(number, F.monotonically_increasing_id()), "numbered")
    found = join_similar(rows, key=number, text=text)
    gone = clear_name(rows, "gone_key")
    others = found.where(F.col("component_id") != F.col(number)).select(F.col(number).alias(gone))
    return rows.join(others, rows[number] == others[gone], "left_anti").select(*documents.columns)
