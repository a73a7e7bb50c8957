"""Operator 3: language-model scores by online logistic mixing of context bit predictors.

A text is its lower-cased words and an end. Each word is coded as the bits on its path in a
Huffman tree of the most frequent words; a word that is not among them is coded as an escape and
its bytes, each as the bits on its path in a tree that depends on the byte before. So a token
takes a dozen bits or two, and the bits' probabilities multiply to a probability of the text.
Each bit is predicted under several contexts: its node alone, and the node with the word before,
the most frequent of the words just before (which tells the language), or that and the last byte
before (for bytes: with that word and one more byte, with three more bytes, with the word so far).
A predictor is the log odds of the bits that all training texts show
at that node in that context.

The predictions are mixed in the logistic domain. A gate, the kind of the bit and the number of
contexts that training knows, selects the weights; a bias by level of the mixed prediction
refines it. Weights and biases start from fixed values for each text and adapt online along it,
after every block of words, so a score depends on the corpus and on the text alone, in whatever
task it is worked out.

What is gathered from the corpus, in tables that grow with it: the count of every training token,
and how often each symbol comes in each context. The second yields the odds of every node in every
context that training shows, none of them shared: a context is a hash of 47 bits, which tells all
but a few in a million of a thousand million contexts apart, and its symbols, at most as many as
the code has, are summed to the nodes of their paths. Texts are dealt into slices, and packed. A slice sends
its distinct (context, symbol) pairs with their training counts to ranges of contexts, each range as
one row of packed differences; a range sums what all slices send and returns to each the odds along
its pairs' paths, in the order of the pairs, which the slice works out again to be scored.
Counts by node alone are as many as the code has, and follow from those of the
symbols. The most frequent tokens, bounded in number, are sent to the tasks with the code; the
counts of all others are joined by token.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assay.llm.common import arrow_batches, keyed, schema_of, slices, staged
from assay.llm.hashing import BYTE_VALUES, Powers, mix

FOLDS, HELD_OUT = 7, 2
# Most frequent tokens whose counts go to every task, at most.
HEAD = 50_000
# Distinct tokens a task counts before it passes the counts on.
COUNTED = 300_000
CONTEXTS = 4
# Slots of a table of odds given whole to ``log_likelihood``; a corpus is not scored by one.
SLOT_BITS = 20
STEP_BYTES = 1024 * 1024
# Bytes of texts scored side by side: each of their bits is held with all that predicts it.
SCORED_BYTES = 512 * 1024
# Bytes of texts in a slice, about; texts are never cut.
SLICE_BYTES = 12 * 1024 * 1024
# Bytes of texts for each range of contexts, about; contexts are never cut.
RANGE_BYTES = 8 * 1024 * 1024
# Bytes of training texts for each range of tokens, about.
TOKEN_RANGE_BYTES = 64 * 1024 * 1024
# Consecutive rows that go to a slice together, so that their texts compress together.
RUN_ROWS = 16
# Pairs that wait to be summed with those of a slice.
STEP_PAIRS = 1_500_000
# Bytes of rows handed to a task's Python at once.
BATCH_BYTES = 4 * 1024 * 1024
# Low bits of a pair that hold its symbol; the code has at most HEAD + 2 + 65,536.
SYMBOL_BITS = 17
# Words before a word of which the most frequent is a context of it.
NEAR = 12
# Words after which weights adapt.
BLOCK = 64
GATES = 2 * CONTEXTS
LEVELS = 24
# First weights, for bits of words and of bytes.
START = ((0.3, 0.2, 0.5, 0.2), (0.1, 0.25, 0.35, 0.55))
RATE = 1.5
SPACE = 0x20


def tokens_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(data, asbytes=True)


def expanded(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)


def packed(values: np.ndarray) -> bytes:
    """64-bit numbers by planes of bytes, which most of the zeros of small ones fill."""
    return squeezed(values.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(expanded(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


def runs_of(numbers: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of each run of equal numbers."""
    edges = np.append(np.flatnonzero(np.diff(numbers, prepend=-1)), len(numbers)).tolist()
    return list(zip(edges, edges[1:], strict=False))


COUNTS = "range long, tokens binary, times binary"


def _count_tokens(ranges: int):
    """Counts of distinct tokens, which hold no space, in one row for each range of their hashes."""

    def rows(counts: Counter[bytes]) -> pa.RecordBatch:
        tokens = sorted(counts)
        number = np.fromiter((zlib.crc32(t) % ranges for t in tokens), np.int64, len(tokens))
        order = np.argsort(number, kind="stable")
        number, runs = number[order], runs_of(number[order])
        tokens = [tokens[i] for i in order.tolist()]
        times = np.fromiter((counts[t] for t in tokens), np.int64, len(tokens))
        columns = [
            pa.array([number[a] for a, _ in runs], pa.int64()),
            pa.array([squeezed(b" ".join(tokens[a:b])) for a, b in runs], pa.binary()),
            pa.array([packed(times[a:b]) for a, b in runs], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["range", "tokens", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(tokens_of(text))
                if len(counts) > COUNTED:
                    yield rows(counts)
                    counts.clear()
        yield rows(counts)

    return run


def _sum_tokens(counts: pa.Table) -> pa.Table:
    """The tokens of a range with the sums of their counts."""
    parts = [
        pa.table([pa.array(expanded(tokens).split(b" "), pa.binary()), pa.array(unpacked(times).view(np.int64))], names=["token", "n"])
        for tokens, times in zip(counts["tokens"].to_pylist(), counts["times"].to_pylist(), strict=True)
    ]
    found = pa.concat_tables(parts).group_by("token", use_threads=False).aggregate([("n", "sum")])
    return pa.table([found["token"], found["n_sum"]], names=["token", "n"])


PACKED = "slice long, rows binary"


def _pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each slice compressed, one row for a slice and batch."""
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3), use_threads=False)
    for batch in batches:
        number = batch.column("slice").to_numpy()
        order = np.argsort(number, kind="stable")
        number, batch = number[order], batch.take(pa.array(order))
        runs, blobs = runs_of(number), []
        for a, b in runs:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
                writer.write_batch(batch.slice(a, b - a))
            blobs.append(sink.getvalue().to_pybytes())
        columns = [pa.array([number[a] for a, _ in runs], pa.int64()), pa.array(blobs, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["slice", "rows"])


def texts_of(packed_rows: pa.Table) -> pa.Table:
    """The rows of a slice as ``_pack_texts`` had them."""
    parts = [pa.ipc.open_stream(pa.py_buffer(b)).read_all() for b in packed_rows["rows"].to_pylist()]
    return pa.concat_tables(parts).combine_chunks()


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << 16, np.int64)
    for batch in batches:
        tokens, times = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
        joined = np.frombuffer(b" " + b" ".join(tokens) + b" ", np.uint8).astype(np.int64)
        # Each byte with the one before it; a token's last pair is with the space that follows.
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        weight = np.repeat(times, lengths + 1)
        pairs = joined[:-1] << 8 | joined[1:]
        total += np.bincount(pairs[: len(weight)], weights=weight, minlength=1 << 16).astype(np.int64)
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], names=["pair", "n"])


def huffman(weights: list[float]) -> list[list[tuple[int, int]]]:
    """Path of (inner node, bit) from the root to each symbol."""
    n = len(weights)
    heap = [(w, i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    parent: dict[int, tuple[int, int]] = {}
    for inner in range(n, 2 * n - 1):
        one, two = heapq.heappop(heap), heapq.heappop(heap)
        parent[one[1]], parent[two[1]] = (inner, 0), (inner, 1)
        heapq.heappush(heap, (one[0] + two[0], inner))
    paths = []
    for i in range(n):
        path, at = [], i
        while at in parent:
            at, taken = parent[at]
            path.append((at - n, taken))
        paths.append(path[::-1])
    return paths


class Codes:
    """Codes of symbols: symbol s is the run first[s] : first[s] + size[s] of ``node`` and ``bit``.

    Symbols are the frequent words, the escape, the end, then byte b after byte a at
    ``bytes_from`` + a * 256 + b. Nodes are numbered over all trees.
    """

    def __init__(self, head: dict[bytes, int], others: int, ends: int, pairs: dict[int, int]):
        self.id = {word: i for i, word in enumerate(sorted(head))}
        self.escape = len(head)
        self.end, self.bytes_from = self.escape + 1, self.escape + 2
        self.last = np.array([w[-1] for w in sorted(head)] + [0, 0], np.uint32)
        self.rank = np.zeros(len(head) + 2, np.int64)  # 1 is the least frequent word
        order = sorted(head, key=lambda w: (head[w], w))
        self.rank[[self.id[w] for w in order]] = np.arange(1, len(order) + 1)
        paths = huffman([head[w] for w in sorted(head)] + [others + 1, ends + 1])
        inner = len(paths) - 1
        weights = np.zeros((256, 256))
        for pair, n in pairs.items():
            weights[pair >> 8, pair & 255] = n
        # Every byte can follow any.
        weights += 1e-3 + weights.sum(axis=0) * 1e-6
        for before in range(256):
            tree = huffman(weights[before].tolist())
            paths += [[(n + inner, t) for n, t in path] for path in tree]
            inner += 255
        # Symbols tree by tree from left to right, so that those below a node stand together.
        tree = [0] * self.bytes_from + [1 + i // 256 for i in range(1 << 16)]
        turns = ["".join("01"[t] for _, t in p) for p in paths]
        self.leaf = np.empty(len(paths), np.int64)
        self.leaf[sorted(range(len(paths)), key=lambda i: (tree[i], turns[i]))] = np.arange(len(paths))
        self.size = np.array([len(p) for p in paths], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.node = np.array([n for p in paths for n, _ in p], np.uint32)
        self.bit = np.array([t for p in paths for _, t in p], np.uint8)


class Units:
    """What is coded of texts: a symbol for each word and end, and one for each byte of a word
    that is escaped, with the hashes of its contexts, none of which reaches into another text."""

    def __init__(self, texts: list[list[bytes]], codes: Codes, cache: Powers):
        get, escape = codes.id.get, codes.escape
        words = np.fromiter(map(len, texts), np.int64, len(texts))
        sizes = words + 1  # with the end
        text = np.repeat(np.arange(len(texts)), sizes)
        last_of = np.cumsum(sizes) - 1
        ids = np.full(len(text), codes.end, np.int64)
        is_word = np.ones(len(text), bool)
        is_word[last_of] = False
        ids[is_word] = [get(t, escape) for tokens in texts for t in tokens]
        at = np.arange(len(ids)) - (last_of - words)[text]
        rare = np.flatnonzero(ids == escape)
        spelled = [texts[i][j] for i, j in zip(text[rare].tolist(), at[rare].tolist(), strict=True)]
        data = np.frombuffer(b"".join(w + b" " for w in spelled), np.uint8)
        lengths = np.fromiter((len(w) + 1 for w in spelled), np.int64, len(spelled))
        starts = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(rare)), lengths)
        inside = np.arange(len(data)) - starts[owner]
        up, down = cache.upto(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
        prefix = mix((sums[:-1] - sums[starts[owner]]) * down[starts[owner]] + np.uint64(1))

        def back(k: int) -> np.ndarray:
            out = np.zeros(len(data), np.uint32)
            out[k:] = data[:-k] if k else data
            out[inside < k] = SPACE if k == 1 else 0
            return out

        one, two = back(1), back(2)
        symbols = codes.bytes_from + (one.astype(np.int64) << 8 | data)
        far = two << np.uint32(16) ^ back(3) << np.uint32(8) ^ back(4)
        # Words by hash: frequent ones by number, others by their bytes.
        named = mix(ids.astype(np.uint64) + np.uint64(1 << 40))
        if len(rare):
            named[rare] = prefix[starts + lengths - 1]
        last = codes.last[ids]
        if len(rare):
            last[rare] = data[starts + lengths - 2]

        def word_back(values: np.ndarray, k: int) -> np.ndarray:
            out = np.zeros_like(values)
            out[k:] = values[:-k]
            out[at < k] = 0
            return out

        before, ending = word_back(named, 1), word_back(last, 1)
        # The most frequent of the words just before tells the language, and something of style.
        usual = codes.rank[ids]
        common = np.zeros(len(ids), np.int64)
        for k in range(1, NEAR + 1):
            np.maximum(common, word_back(usual, k), out=common)
        common = mix(common.astype(np.uint64) + np.uint64(1 << 41))
        tongue = common[rare][owner]
        contexts = (
            (before, tongue + two),
            (common, far.astype(np.uint64)),
            (common + ending, prefix),
        )
        self.ids, self.of = ids, text
        self.rare, self.spelled = rare, spelled
        self.symbol = np.concatenate([ids, symbols])
        self.contexts = [
            np.concatenate([mix(x + np.uint64(2 * k + i << 56)) for i, x in enumerate(c)]) for k, c in enumerate(contexts)
        ]
        self.text = np.concatenate([text, text[rare][owner]])
        self.block = np.concatenate([at, at[rare][owner]]) // BLOCK
        self.is_byte = np.concatenate([np.zeros(len(ids), np.int64), np.ones(len(data), np.int64)])

    def bits(self, codes: Codes, order: np.ndarray):
        """(unit, place in its path, node, bit) of every bit of the units in ``order``, and where each unit ends."""
        symbol = self.symbol[order]
        size = codes.size[symbol]
        ends = np.cumsum(size)
        inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
        at = inside + np.repeat(codes.first[symbol], size)
        return np.repeat(order, size), inside, codes.node[at], codes.bit[at], ends


def pair_keys(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Context and symbol as one number, in the order of contexts."""
    return context >> np.uint64(SYMBOL_BITS) << np.uint64(SYMBOL_BITS) | symbol.astype(np.uint64)


def symbols_of(pairs: np.ndarray) -> np.ndarray:
    return (pairs & np.uint64((1 << SYMBOL_BITS) - 1)).astype(np.int64)


def log_odds(ones: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Log odds of a set bit, in sixteenths; 0 where nothing is known."""
    return np.clip(np.round(np.log((ones + 0.4) / (zeros + 0.4)) * 16), -127, 127).astype(np.int8)


def node_odds(codes: Codes, counts: np.ndarray) -> np.ndarray:
    """Log odds by node alone, from the counts of all symbols."""
    times = np.repeat(counts.astype(np.float64), codes.size)
    ones = np.bincount(codes.node, weights=times * codes.bit)
    return log_odds(ones, np.bincount(codes.node, weights=times) - ones)


class PairOdds:
    """Log odds along the path of each pair that is known. The pairs come in order, their odds whole
    or in consecutive parts."""

    def __init__(self, pairs: np.ndarray, odds: bytes | Iterator[np.ndarray], codes: Codes):
        size = codes.size[symbols_of(pairs)].astype(np.int32)
        self.keys, self.none = pairs, int(size.sum())
        self.first = np.cumsum(size, dtype=np.int64 if self.none >> 31 else np.int32)
        self.first -= size
        # What is not known reads a path of zeros behind the others.
        self.odds = np.zeros(self.none + int(codes.size.max()), np.int8)
        start = 0
        for part in [np.frombuffer(odds, np.int8)] if isinstance(odds, bytes) else odds:
            self.odds[start : start + len(part)] = part
            start += len(part)

    def starts(self, wanted: np.ndarray) -> np.ndarray:
        out = np.full(len(wanted), self.none, np.int64)
        if len(self.keys):
            # Sought in order, neighbours are found in the same few places of the keys.
            order = np.argsort(wanted)
            wanted = wanted[order]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            out[order] = np.where(self.keys[at] == wanted, self.first[at], self.none)
        return out


def pairs_of(units: Units) -> np.ndarray:
    return np.concatenate([pair_keys(c, units.symbol) for c in units.contexts])


def summed(pairs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs in order, with the sums of their counts."""
    order = np.argsort(pairs)
    pairs = pairs[order]
    first = firsts(pairs)
    return pairs[first], np.add.reduceat(n[order], first)


def firsts(pairs: np.ndarray) -> np.ndarray:
    """Where the runs of equal pairs begin."""
    return np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)])


def distinct(pairs: np.ndarray) -> np.ndarray:
    pairs = np.sort(pairs)
    return pairs[firsts(pairs)]


def joined(one: tuple[np.ndarray, ...], other: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Distinct pairs in order, with their counts if there are any, of both; ``one`` is used up."""
    if not len(one[0]):
        return other
    at = np.searchsorted(one[0], other[0])
    found = one[0][np.minimum(at, len(one[0]) - 1)] == other[0]
    for counts, more in zip(one[1:], other[1:], strict=True):
        counts[at[found]] += more[found]
    at = at[~found]
    return tuple(np.insert(a, at, b[~found]) for a, b in zip(one, other, strict=True))


def counted_once(pairs: np.ndarray, trained: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs in order, and how many of each are ``trained``."""
    learned = np.sort(pairs[trained])
    first = firsts(learned)
    others = distinct(pairs[~trained])
    return joined((learned[first], np.diff(np.append(first, len(learned)))), (others, np.zeros(len(others), np.int64)))


def gathered(parts: Iterator[tuple[np.ndarray, ...]], merge) -> tuple[np.ndarray, ...]:
    """``merge`` of all parts, made while they come: of those that wait, then joined with what was
    merged before. Parts are let go before they are merged."""
    held: list[tuple[np.ndarray, ...]] = []
    before = None
    waiting = 0

    def merged():
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        held.clear()
        return joined(before, merge(*columns)) if before else merge(*columns)

    for part in parts:
        held.append(part)
        waiting += len(part[0])
        del part
        if waiting > STEP_PAIRS:
            before = merged()
            waiting = 0
    return merged() if held else before


def ranges_of(pairs: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each pair by its context; ranges ascend with contexts."""
    return ((pairs >> np.uint64(SYMBOL_BITS)) * np.uint64(ranges) >> np.uint64(64 - SYMBOL_BITS)).astype(np.int64)


ASKED = "range long, slice long, pairs binary, times binary"
ANSWERED = "slice long, range long, n long, odds binary"


def _count_contexts(shared, ranges: int):
    """For a slice of texts: its distinct pairs, and how often training texts have them, by range."""

    def call(texts: pa.Table) -> pa.Table:
        codes, cache = shared.value, Powers()
        bodies, trained = texts["body"].to_pylist(), texts["trained"].to_numpy().astype(bool)

        def part(a: int, b: int):
            units = Units([tokens_of(t) for t in bodies[a:b]], codes, cache)
            return counted_once(pairs_of(units), np.tile(trained[a:b][units.text], len(units.contexts)))

        steps = slices([len(t or b"") for t in bodies], STEP_BYTES)
        pairs, n = gathered((part(a, b) for a, b in steps), summed)
        number = ranges_of(pairs, ranges)
        runs = runs_of(number)
        return pa.table(
            [
                pa.array(number[[a for a, _ in runs]]),
                pa.repeat(texts["slice"][0], len(runs)),
                pa.array([packed(np.diff(pairs[a:b], prepend=np.uint64(0))) for a, b in runs], pa.binary()),
                pa.array([packed(n[a:b].astype(np.int64)) for a, b in runs], pa.binary()),
            ],
            names=["range", "slice", "pairs", "times"],
        )

    return call


def context_odds(codes: Codes, pairs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds along the path of each pair's symbol, one after another, and where each path begins.

    ``pairs`` are in order and hold their contexts whole.
    """
    context, symbol = pairs >> np.uint64(SYMBOL_BITS), symbols_of(pairs)
    size = codes.size[symbol]
    first = np.cumsum(size) - size
    out = np.zeros(size.sum(), np.int8)
    number = np.cumsum(np.concatenate([[0], context[1:] != context[:-1]])).astype(np.int64)
    # From the roots down, all paths by one node at a time; those that share one stand together.
    order = np.argsort(number << SYMBOL_BITS | codes.leaf[symbol])
    walk = (number[order], codes.first[symbol][order], first[order], size[order], n[order].astype(np.float64))
    alone = []
    while len(walk[0]):
        number, at, place, left, times = walk
        node = codes.node[at]
        new = np.ones(len(at), bool)
        new[1:] = (number[1:] != number[:-1]) | (node[1:] != node[:-1])
        start = np.flatnonzero(new)
        ones, total = np.add.reduceat(times * codes.bit[at], start), np.add.reduceat(times, start)
        count = np.diff(np.append(start, len(at)))
        out[place] = np.repeat(log_odds(ones, total - ones), count)
        # Below a node that one path alone goes through there is no other.
        one = np.repeat(count == 1, count)
        alone.append([x[one] for x in (at, place, left, times)])
        go = ~one & (left > 1)
        walk = (number[go], at[go] + 1, place[go] + 1, left[go] - 1, times[go])
    if alone:
        at, place, left, times = map(np.concatenate, zip(*alone, strict=True))
        inside = np.arange(left.sum()) - np.repeat(np.cumsum(left) - left, left)
        sure = np.repeat(log_odds(times, np.zeros(len(times))), left)
        out[np.repeat(place, left) + inside] = np.where(codes.bit[np.repeat(at, left) + inside] == 1, sure, -sure)
    return out, first


def signs(codes: Codes, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the pairs' paths, and all their bits, one path after another, as signs."""
    symbol = symbols_of(pairs)
    size = codes.size[symbol]
    at = np.arange(size.sum()) + np.repeat(codes.first[symbol] - np.cumsum(size) + size, size)
    return size, codes.bit[at].astype(np.int8) * np.int8(2) - np.int8(1)


def by_node(codes: Codes, pairs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All bits of the pairs' paths by their places, one path after another, and which of them are
    the first at their context and node, those of one together: depth by depth, last the rest of
    paths that no other pair shares."""
    context, symbol = pairs >> np.uint64(SYMBOL_BITS), symbols_of(pairs)
    size = codes.size[symbol]
    number = np.cumsum(np.concatenate([[0], context[1:] != context[:-1]])).astype(np.int64)
    order = np.argsort(number << SYMBOL_BITS | codes.leaf[symbol])
    walk = (number[order], codes.first[symbol][order], (np.cumsum(size) - size)[order], size[order])
    alone = []
    while len(walk[0]):
        number, at, place, left = walk
        node = codes.node[at]
        new = np.ones(len(at), bool)
        new[1:] = (number[1:] != number[:-1]) | (node[1:] != node[:-1])
        one = new & np.append(new[1:], True)
        alone.append((place[one], left[one]))
        yield place[~one], new[~one]
        go = ~one & (left > 1)
        walk = (number[go], at[go] + 1, place[go] + 1, left[go] - 1)
    place, left = map(np.concatenate, zip(*alone, strict=True))
    rest = np.arange(left.sum()) + np.repeat(place - np.cumsum(left) + left, left)
    yield rest, np.ones(len(rest), bool)


def to_answer(codes: Codes, pairs: np.ndarray, odds: np.ndarray) -> bytes:
    """The odds along the pairs' paths, each node of a context once, as those of the bit that comes."""
    own = odds * signs(codes, pairs)[1]
    return squeezed(b"".join(own[place[new]].tobytes() for place, new in by_node(codes, pairs)))


def from_answer(codes: Codes, pairs: np.ndarray, blob: bytes) -> np.ndarray:
    values, start = np.frombuffer(expanded(blob), np.int8), 0
    sign = signs(codes, pairs)[1]
    odds = np.empty(len(sign), np.int8)
    for place, new in by_node(codes, pairs):
        end = start + np.count_nonzero(new)
        odds[place] = (values[start:end] * sign[place[new]])[np.cumsum(new) - 1]
        start = end
    if start != len(values):
        raise ValueError(f"{len(values)} odds for {start} nodes")
    return odds


def _answer(shared):
    """For a range: the odds that all slices' counts give, to each slice along the paths of its pairs."""

    def call(asked: pa.Table) -> pa.Table:
        codes = shared.value
        parts = [np.cumsum(unpacked(blob)) for blob in asked["pairs"].to_pylist()]
        counts = (unpacked(blob).view(np.int64) for blob in asked["times"].to_pylist())
        pairs, n = gathered(zip(parts, counts, strict=True), summed)
        odds, first = context_odds(codes, pairs, n)
        answers = []
        for part in parts:
            size = codes.size[symbols_of(part)]
            begin = first[np.searchsorted(pairs, part)] - np.cumsum(size) + size
            answers.append(to_answer(codes, part, odds[np.arange(size.sum()) + np.repeat(begin, size)]))
        sizes = pa.array([len(part) for part in parts], pa.int64())
        names = ["slice", "range", "n", "odds"]
        return pa.table([asked["slice"], asked["range"], sizes, pa.array(answers, pa.binary())], names=names)

    return call


def log_likelihood(texts: list[list[bytes]], codes: Codes, table: np.ndarray, cache: Powers) -> np.ndarray:
    """Natural logarithm of the probability of each text in a model whose odds are ``table``, by
    context and slot: node, or hash of context and node."""
    units = Units(texts, codes, cache)

    def look(k: int, unit: np.ndarray, inside: np.ndarray, node: np.ndarray) -> np.ndarray:
        if not k:
            return table[0][node]
        return table[k][mix(units.contexts[k - 1][unit] + node) & np.uint64(table.shape[1] - 1)]

    return likelihood_of(units, len(texts), codes, look)


def looked_up(units: Units, alone: np.ndarray, known: PairOdds):
    starts = [known.starts(pair_keys(c, units.symbol)) for c in units.contexts]

    def look(k: int, unit: np.ndarray, inside: np.ndarray, node: np.ndarray) -> np.ndarray:
        return known.odds[starts[k - 1][unit] + inside] if k else alone[node]

    return look


def likelihood_of(units: Units, n: int, codes: Codes, look) -> np.ndarray:
    """``look`` gives context k's log odds, in sixteenths, of bits by unit, place in the path and node."""
    order = np.argsort(units.block, kind="stable")
    unit, inside, node, bit, ends = units.bits(codes, order)
    owner = units.text[unit]
    inputs = np.empty((CONTEXTS, len(unit)), np.float32)
    for k in range(CONTEXTS):
        inputs[k] = look(k, unit, inside, node)
    known = np.zeros(len(unit), np.int8)
    for k in range(1, CONTEXTS):
        known += inputs[k] != 0
    inputs *= np.float32(1 / 16)
    cell = owner * GATES + units.is_byte[unit] * CONTEXTS + known
    del unit, inside, node, known
    sign = bit.astype(np.float32) * 2 - 1
    starts = np.repeat(np.array(START, np.float32), CONTEXTS, axis=0)  # by gate
    weights = np.tile(starts.T, (1, n))
    bias = np.zeros(n * LEVELS, np.float32)
    seen = np.full(n * GATES, 16.0)
    curve = np.full(n * LEVELS, 8.0)
    out = np.zeros(n)
    blocks = units.block[order]
    edges = np.searchsorted(blocks, np.arange(blocks.max() + 2))
    places = np.concatenate([[0], ends])[edges]
    offset, scale, one = np.float32(9), np.float32(LEVELS / 18.001), np.float32(1)
    for a, b in zip(places, places[1:], strict=False):
        x, c, o, s = inputs[:, a:b], cell[a:b], owner[a:b], sign[a:b]
        mixed = weights[0][c]
        mixed *= x[0]
        for k in range(1, CONTEXTS):
            part = weights[k][c]
            part *= x[k]
            mixed += part
        np.clip(mixed, -9, 9, out=mixed)
        level = ((mixed + offset) * scale).astype(np.int64)
        level += o * LEVELS
        mixed += bias[level]
        mixed *= s
        right = one / (one + np.exp(-mixed))  # of the bit that came
        out += np.bincount(o, weights=np.log(right), minlength=n)
        wrong = one - right
        error = wrong * s
        seen += np.bincount(c, minlength=n * GATES)
        for k in range(CONTEXTS):
            step = np.bincount(c, weights=error * x[k], minlength=n * GATES)
            weights[k] += (RATE * step / seen).astype(np.float32)
        curve += np.bincount(level, weights=wrong * right, minlength=n * LEVELS)
        bias += (np.bincount(level, weights=error, minlength=n * LEVELS) / curve).astype(np.float32)
    return out


SCORES = (
    "n_tokens long, n_known long, known_logs double, score double, coded_bytes long, "
    "rest array<struct<token: binary, times: int>>"
)


def odds_of_slice(texts: list[bytes | None], answers: pa.Table, codes: Codes, cache: Powers) -> PairOdds:
    """The answers to a slice, beside the pairs that it asked for."""
    steps = slices([len(t or b"") for t in texts], STEP_BYTES)
    parts = ((distinct(pairs_of(Units([tokens_of(t) for t in texts[a:b]], codes, cache))),) for a, b in steps)
    (pairs,) = gathered(parts, lambda x: (distinct(x),))
    sizes = answers["n"].to_pylist()

    def odds():
        start = 0
        for i in np.argsort(answers["range"].to_numpy()).tolist():
            yield from_answer(codes, pairs[start : start + sizes[i]], answers["odds"][i].as_py())
            start += sizes[i]
        if start != len(pairs):
            raise ValueError(f"answers to {start} of {len(pairs)} pairs")

    return PairOdds(pairs, odds(), codes)


def _score_slice(shared):
    def call(table: pa.Table, answers: pa.Table) -> pa.Table:
        codes, alone, counted = shared.value
        cache, logs = Powers(), np.log10(counted + 1.0)
        texts = table["body"].to_pylist()
        known = odds_of_slice(texts, answers, codes, cache)
        names = ("n_tokens", "n_known", "known_logs", "score", "coded_bytes")
        out: dict[str, list] = {n: [] for n in names}
        rest_tokens: list[bytes] = []
        rest_times: list[int] = []
        rest_ends = [0]
        for a, b in slices([len(t or b"") for t in texts], SCORED_BYTES):
            parts = [tokens_of(t) for t in texts[a:b]]
            n = len(parts)
            units = Units(parts, codes, cache)
            scores = likelihood_of(units, n, codes, looked_up(units, alone, known)) / np.log(10)
            rest: list[Counter[bytes]] = [Counter() for _ in parts]
            for i, token in zip(units.of[units.rare].tolist(), units.spelled, strict=True):
                rest[i][token] += 1
            out["n_tokens"] += [len(tokens) + 1 for tokens in parts]
            out["n_known"] += np.bincount(units.of[counted[units.ids] > 0], minlength=n).tolist()
            out["known_logs"] += np.bincount(units.of, weights=logs[units.ids], minlength=n).tolist()
            out["score"] += scores.tolist()
            out["coded_bytes"] += [sum(map(len, tokens)) + max(len(tokens), 1) for tokens in parts]
            for found in rest:
                rest_tokens += found
                rest_times += found.values()
                rest_ends.append(len(rest_tokens))
        entries = pa.StructArray.from_arrays(
            [pa.array(rest_tokens, pa.binary()), pa.array(rest_times, pa.int32())], names=["token", "times"]
        )
        rest_of = pa.ListArray.from_arrays(pa.array(rest_ends, pa.int32()), entries)
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64())
        columns = [pa.array(out[name], kind) for name, kind in zip(names, kinds, strict=True)]
        return pa.table([table["row"], table["key"], *columns, rest_of], names=["row", "key", *names, "rest"])

    return call


def is_held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def score_texts(documents: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document: key, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``score`` is log10 of the mixing model's probability of the text, ``bits_per_byte`` the same
    per byte of words, spaces and the end; ``base_score`` that of add-one token counts. A null
    or empty text is the end alone; a null key counts as an empty one, which is not held out.
    Rows of equal keys are documents of their own. With no training text nothing is known, and
    all bits start even. Further columns are not looked at.
    """
    spark = documents.sparkSession
    rows, _ = keyed(documents, key, text)
    rows = rows.select("row", "key", F.col("body").cast("binary").alias("body"))
    training = rows.where(~is_held_out(F.col("key"))).select("body")
    size = rows.agg(F.sum(F.length("body")).alias("n")).first()["n"] or 0
    with arrow_batches(spark, BATCH_BYTES):
        counts = staged(
            training.mapInArrow(_count_tokens(-(-size // TOKEN_RANGE_BYTES) or 1), COUNTS)
            .groupBy("range")
            .applyInArrow(_sum_tokens, "token binary, n long"),
            "tokens",
        )
    ends = training.count()
    whole = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    train_tokens, distinct = (whole["n"] or 0) + ends, whole["v"] + (ends > 0)
    # The count from which tokens are frequent: a level of counts that at most HEAD tokens reach.
    level = F.floor(F.log2("n") * 8)
    levels = counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    least, seen = None, 0
    for found in levels:
        seen += found["count"]
        if seen > HEAD:
            break
        least = found["level"]
    frequent = F.lit(False) if least is None else level >= least
    head = {bytes(r["token"]): r["n"] for r in counts.where(frequent).collect()}
    pairs = (
        counts.where(~frequent)
        .mapInArrow(_count_pairs, "pair long, n long")
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
    )
    others = train_tokens - ends - sum(head.values())
    pairs = {r["pair"]: r["n"] for r in pairs.collect()}
    codes = Codes(head, others, ends, pairs)
    symbols = np.zeros(len(codes.size), np.int64)
    symbols[: codes.bytes_from] = [*(head[w] for w in sorted(head)), others, ends]
    symbols[codes.bytes_from + np.array(list(pairs), np.int64)] = list(pairs.values())
    counted = symbols[: codes.bytes_from].copy()
    counted[codes.escape] = 0
    shared_codes = spark.sparkContext.broadcast(codes)
    run = F.floor(F.col("row") / RUN_ROWS)
    part = F.pmod(F.xxhash64(run), F.lit(-(-size // SLICE_BYTES) or 1)).alias("slice")
    texts = rows.select(part, "row", "key", "body", (~is_held_out(F.col("key"))).alias("trained"))
    shared = spark.sparkContext.broadcast((codes, node_odds(codes, symbols), counted))
    count = _count_contexts(shared_codes, min(-(-size // RANGE_BYTES) or 1, 1 << SYMBOL_BITS))
    score = _score_slice(shared)
    # Both read the same columns, so texts are shuffled once.
    slices_of = texts.mapInArrow(_pack_texts, schema_of(PACKED)).groupBy("slice")
    asked = slices_of.applyInArrow(lambda rows: count(texts_of(rows)), schema_of(ASKED))
    answers = asked.groupBy("range").applyInArrow(_answer(shared_codes), schema_of(ANSWERED))
    scored = (
        slices_of.cogroup(answers.groupBy("slice"))
        .applyInArrow(lambda rows, found: score(texts_of(rows), found), StructType(texts.select("row", "key").schema.fields + schema_of(SCORES).fields))
    )
    with arrow_batches(spark, BATCH_BYTES):
        scored = staged(scored, "scores")
    rest = (
        scored.select("row", F.explode("rest").alias("r"))
        .select("row", "r.token", "r.times")
        .join(counts.where(~frequent), "token")
        .groupBy("row")
        .agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_logs"))
    )
    unknown = float(np.log10(train_tokens + distinct + 1))
    return scored.join(rest, "row", "left").select(
        F.col("key").alias(key),
        is_held_out(F.col("key")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(int(train_tokens)).cast("long").alias("train_tokens"),
        (F.col("known_logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(unknown)).alias("base_score"),
        "score",
        (-F.col("score") * float(np.log2(10)) / F.col("coded_bytes")).alias("bits_per_byte"),
    )
