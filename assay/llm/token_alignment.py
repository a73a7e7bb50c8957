"""Operator 13: two tokenizers' tokens of the same texts, cut into groups that end together.

Tokenizer A (a byte-level vocabulary of ``tokenizers``) reports the characters that each token
spans, tokenizer B (a ``sentencepiece`` model) the bytes of its pieces. These spans are coarse
cuts: a token that ends inside a character, or a piece of byte fallback, has the span of the whole
character. Such ends are refined with the decoded bytes of the tokens.

Neither tokenizer merges across a space that stands before a visible character and after anything
but a space, so texts are cut there into chunks and each distinct chunk of a slice is encoded once,
many of them in one go. A task remembers chunks, so those that later slices hold again are not
encoded again; when its memory is full, what was not met again is forgotten.
Ends of both over the bytes of all distinct chunks, laid one after another, are then merged in
whole-array steps: where both end, a group ends; between two neighbouring ends lies exactly one
overlapping pair, a link.

How many documents hold a linked pair is summed per slice of texts and task before it is shuffled.
The table of these counts is as large as the pairs of ids that ever overlap, whatever the number of
documents. It is sent to tasks in blocks of a fixed size; the sums over a document's links add up
from block to block.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from assay.llm.common import arrow_batches, slices, staged
from assay.llm.token_counts import byte_alphabet

# Bytes of text encoded together, and those whose links one row of the written table holds: larger
# rows are dear to the JVM, larger slices to Python.
SLICE_BYTES = 1024 * 1024
ROW_BYTES = 512 * 1024
# Chunks a task remembers, at most, and bytes of one that is remembered.
MEMORY = 200_000
REMEMBERED_BYTES = 64
# Bytes of a group of such rows in the written table.
ROW_GROUP = 16 * 1024 * 1024
# Bytes of rows handed to a task's Python at once.
BATCH_BYTES = 4 * 1024 * 1024
# Pairs of ids in one block of counts: two arrays of eight bytes each in every task, 32 MB.
BLOCK_PAIRS = 1 << 21
# Pairs a task holds before it hands its counts on.
HELD_PAIRS = 1 << 21
# Bytes of distinct chunks that a tokenizer takes as one text, and such texts handed over at once: the
# libraries' spans are objects, far larger than the arrays they are turned into.
UNIT_BYTES = 16 * 1024
UNITS_AT_ONCE = 8

_SPACE = 0x20
# First bytes, in UTF-8, of the characters above ASCII that are white space.
_MAY_BE_BLANK = (0xC2, 0xE1, 0xE2, 0xE3)


class TokenizerA:
    """Tokens of a ``tokenizers`` file with byte-level entries: ids, ends in bytes, decoded bytes."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        splitter = (described.get("pre_tokenizer") or {}).get("type")
        if described.get("normalizer") or splitter != "ByteLevel":
            raise ValueError(f"{path} is no plain byte-level vocabulary")
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.library.no_padding()
        self.library.no_truncation()
        alphabet = byte_alphabet()
        entries = self.library.get_vocab(with_added_tokens=False)
        self.bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            if all(c in alphabet for c in entry):
                self.bytes[i] = bytes(alphabet[c] for c in entry)
        self.sizes = np.fromiter(map(len, self.bytes), np.int64, len(self.bytes))

    def encode(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, tokens of each chunk, ends within the chunk, whether its tokens' bytes are the chunk's)."""
        texts = [c.decode() for c in chunks]
        found = self.library.encode_batch(texts, add_special_tokens=False)
        counts = np.fromiter((len(e) for e in found), np.int64, len(found))
        ids = _numbers(e.ids for e in found)
        spans = _numbers(chain.from_iterable(e.offsets) for e in found).reshape(-1, 2)
        # Where each character of the texts, laid one after another, begins in bytes.
        data = np.frombuffer(b"".join(chunks), np.uint8)
        begins = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        first_char = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        base = np.repeat(first_char, counts)
        starts, ends = begins[base + spans[:, 0]], begins[base + spans[:, 1]]
        chunk_bytes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        before = np.repeat(np.concatenate([[0], np.cumsum(chunk_bytes)])[:-1], counts)
        decoded_ends = _running(self.sizes[ids], counts)
        coarse = ends - before
        # An end is the span's unless the next token starts before it, inside the same character.
        split = np.zeros(len(ids), bool)
        split[:-1] = starts[1:] < ends[:-1]
        last = np.cumsum(counts) - 1
        split[last[counts > 0]] = False
        ends = np.where(split, decoded_ends, coarse)
        return ids, counts, ends, _same(self.bytes, ids, counts, chunks)


class TokenizerB:
    """Pieces of a ``sentencepiece`` model: ids, ends in bytes, decoded bytes.

    Chunks begin with a space, which the model puts before a text itself.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            if self.library.is_byte(i):
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif self.library.is_control(i) or self.library.is_unknown(i):
                self.bytes.append(b"")
            else:
                self.bytes.append(piece.replace("▁", " ").encode())
        self.sizes = np.fromiter(map(len, self.bytes), np.int64, len(self.bytes))
        inside = [self.library.id_to_piece(i).lstrip("▁") for i in range(len(self.bytes))]
        # Whether no piece goes on over a space.
        self.cut_at_spaces = not any("▁" in piece for piece in inside)

    def encode(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        texts = [c[1:].decode() for c in chunks]
        # The spans of the pieces, as the library's proto holds them, counted in bytes.
        found = self.library.encode(texts, return_type="offset_mapping", return_bytes=True, num_threads=1)
        counts = np.fromiter((len(f["ids"]) for f in found), np.int64, len(found))
        ids = _numbers(f["ids"] for f in found)
        spans = _numbers(chain.from_iterable(f["offsets"]) for f in found).reshape(-1, 2)
        decoded_ends = _running(self.sizes[ids], counts)
        coarse = spans[:, 1] + 1  # the space before the text
        # Byte fallback: all but the last byte of a character have an empty span. The first piece
        # may be the space alone, which has one too.
        split = spans[:, 1] <= spans[:, 0]
        ends = np.where(split, decoded_ends, coarse)
        return ids, counts, ends, _same(self.bytes, ids, counts, chunks)


def _running(sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of sizes from the first token of each chunk to each of its tokens."""
    total = np.cumsum(sizes)
    first = np.cumsum(counts) - counts
    before = np.concatenate([[0], total])[first]
    return total - np.repeat(before, counts)


def _numbers(lists) -> np.ndarray:
    return np.array(array("q", chain.from_iterable(lists)), np.int64)


def _same(table: list[bytes], ids: np.ndarray, counts: np.ndarray, chunks: list[bytes]) -> np.ndarray:
    """For each chunk, whether its tokens' bytes, one after another, are the chunk."""
    parts = list(map(table.__getitem__, ids.tolist()))
    sizes = _sums(np.fromiter(map(len, parts), np.int64, len(parts)), counts)
    if b"".join(parts) == b"".join(chunks) and sizes.tolist() == list(map(len, chunks)):
        return np.ones(len(chunks), bool)
    bounds = np.concatenate([[0], np.cumsum(counts)]).tolist()
    return np.array([b"".join(parts[a:b]) == c for a, b, c in zip(bounds, bounds[1:], chunks, strict=False)], bool)


def _sums(sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(sizes)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


class Aligner:
    """Chunks of texts to the tokens, groups and links of both tokenizers."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = TokenizerA(path_a), TokenizerB(path_b)
        most = max(len(self.a.bytes), len(self.b.bytes))
        spelled = [str(i).encode() for i in range(most)]
        width = max(map(len, spelled)) + 1
        # Ids as digits, with room for what follows one.
        self.digits = np.frombuffer(b"".join(d.ljust(width, b"\0") for d in spelled), np.uint8).reshape(-1, width)
        self.n_digits = np.fromiter(map(len, spelled), np.int64, most)
        self.place: dict[bytes, int] = {}  # of remembered chunks in ``known``
        self.known = self.align([])
        self.again = np.zeros(0, bool)  # whether a later slice held the chunk too

    def remember(self, chunks: list[bytes]) -> tuple["Aligned", np.ndarray]:
        """What aligning chunks gives, among others, and the place there of each; distinct chunks come in."""
        if len(self.place) + len(chunks) > MEMORY:
            self.forget()
        at = np.fromiter((self.place.get(c, -1) for c in chunks), np.int64, len(chunks))
        new = np.flatnonzero(at < 0)
        self.again[at[at >= 0]] = True
        at[new] = len(self.again) + np.arange(len(new))
        fresh = [chunks[i] for i in new.tolist()]
        known = self.known.and_more(self.align(fresh))
        # Long chunks hardly come again and would fill the memory.
        short = np.flatnonzero(np.fromiter(map(len, fresh), np.int64, len(fresh)) <= REMEMBERED_BYTES)
        if len(short) == len(fresh):
            self.known, self.again = known, np.append(self.again, np.zeros(len(new), bool))
            self.place.update(zip(fresh, at[new].tolist(), strict=True))
        else:
            first = len(self.again)
            self.known = known.only(np.append(np.arange(first), first + short))
            self.again = np.append(self.again, np.zeros(len(short), bool))
            self.place.update(zip([fresh[i] for i in short.tolist()], range(first, first + len(short)), strict=True))
        return known, at

    def forget(self) -> None:
        """Keeps the chunks that came again since the last time, if these leave room for others."""
        kept = np.flatnonzero(self.again)
        kept = kept if len(kept) <= MEMORY // 2 else kept[:0]
        old = list(self.place)
        self.place = {old[i]: k for k, i in enumerate(kept.tolist())}
        self.known, self.again = self.known.only(kept), np.zeros(len(kept), bool)

    def chunk_starts(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Starts of the chunks of texts that begin (with their space) at ``starts``."""
        begin = np.zeros(len(data), bool)
        if self.b.cut_at_spaces and len(data) > 2:
            begin[1:-1] = (data[1:-1] == _SPACE) & (data[:-2] != _SPACE) & _visible(data[2:])
        begin[starts] = True
        return np.flatnonzero(begin)

    def align(self, chunks: list[bytes]) -> "Aligned":
        """What aligning each chunk gives; distinct chunks come in."""
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        base = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(chunks), np.uint8)
        # Chunks that may follow each other are encoded in one go, as the texts they are cut from were.
        second = data[np.minimum(base + 1, max(len(data) - 1, 0))] if len(data) else data
        plain = (sizes > 1) & _visible(second) & (data[base + sizes - 1] != _SPACE) if len(data) else sizes > 0
        plain &= self.b.cut_at_spaces
        bad = np.zeros(len(chunks), bool)
        parts: tuple[list, ...] = ([], [], [], [])
        waiting = _units(plain, sizes)
        while waiting:
            pending, waiting = waiting[:UNITS_AT_ONCE], waiting[UNITS_AT_ONCE:]
            units = [b"".join(chunks[i:j]) for i, j in pending]
            first = base[[i for i, _ in pending]]
            ids_a, n_a, ends_a, same_a = self.a.encode(units)
            ids_b, n_b, ends_b, same_b = self.b.encode(units)
            same = same_a & same_b
            for k, (ids, counts, ends) in enumerate(((ids_a, n_a, ends_a), (ids_b, n_b, ends_b))):
                keep = np.repeat(same, counts)
                parts[2 * k].append(ids[keep])
                parts[2 * k + 1].append((ends + np.repeat(first, counts))[keep])
            again = [unit for unit, whole in zip(pending, same, strict=True) if not whole]
            for i, j in again:
                bad[i] |= j == i + 1
            waiting = [(k, k + 1) for i, j in again if j > i + 1 for k in range(i, j)] + waiting
        ids_a, end_a, ids_b, end_b = (np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts)
        order_a, order_b = np.argsort(end_a), np.argsort(end_b)
        ids_a, end_a, ids_b, end_b = ids_a[order_a], end_a[order_a], ids_b[order_b], end_b[order_b]
        edges = np.append(base, len(data))

        def per_chunk(ends):
            return np.diff(np.searchsorted(ends, edges, side="right"))

        cuts = end_a[np.isin(end_a, end_b, assume_unique=True, kind="table" if len(end_b) else None)]
        every = np.sort(np.concatenate([end_a, end_b]), kind="stable")
        every = every[np.append(True, every[1:] != every[:-1])[: len(every)]]
        pairs = ids_a[np.searchsorted(end_a, every)] << 32 | ids_b[np.searchsorted(end_b, every)]
        words, bounds = self._spelled(ids_a, end_a, ids_b, end_b, cuts, edges)
        at = bounds.tolist()
        spelled = [words[i:j] for i, j in zip(at, at[1:], strict=False)]
        return Aligned(bad, per_chunk(end_a), per_chunk(end_b), per_chunk(cuts), per_chunk(every), pairs, spelled)

    def _spelled(self, ids_a, end_a, ids_b, end_b, cuts, edges) -> tuple[bytes, np.ndarray]:
        """The groups of all chunks as text, each with a semicolon after it, and where chunks begin."""
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        ids, ends = np.concatenate([ids_a, ids_b])[order], np.concatenate([end_a, end_b])[order]
        last_a = np.append(group_a[1:] != group_a[:-1], True)[: len(group_a)]
        last_b = np.append(group_b[1:] != group_b[:-1], True)[: len(group_b)]
        after = np.concatenate([np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))])[order]
        rows = self.digits[ids]
        sizes = self.n_digits[ids]
        rows[np.arange(len(ids)), sizes] = after
        flat = rows.ravel()
        ends_at = np.concatenate([[0], np.cumsum(sizes + 1)])
        group = np.concatenate([group_a, group_b])[order]
        firsts = np.searchsorted(cuts, edges, side="right")
        return flat[flat != 0].tobytes(), ends_at[np.searchsorted(group, firsts)]


@dataclass
class Aligned:
    """For each chunk: whether bytes differ, counts, its pairs (id A shifted by 32 bits, with id B;
    one that is linked twice stands twice), one chunk's after another's, and its groups as text."""

    bad: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    pairs: np.ndarray
    words: list[bytes]

    @property
    def pair_bounds(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.n_links)])

    def and_more(self, other: "Aligned") -> "Aligned":
        joined = [np.concatenate([getattr(self, f), getattr(other, f)]) for f in ("bad", *_DIGESTS, "pairs")]
        return Aligned(*joined, self.words + other.words)

    def only(self, which: np.ndarray) -> "Aligned":
        picked = [getattr(self, f)[which] for f in ("bad", *_DIGESTS)]
        return Aligned(*picked, self.pairs[_gather(self.pair_bounds, which)], [self.words[i] for i in which.tolist()])


def _visible(data: np.ndarray) -> np.ndarray:
    """Bytes that surely begin a visible character."""
    return (data > _SPACE) & (data != 0x7F) & ~np.isin(data, _MAY_BE_BLANK)


def _units(plain: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Runs of chunks to encode together: plain neighbours up to ``UNIT_BYTES``, others alone."""
    out, start, held = [], 0, 0
    for i, (may, size) in enumerate(zip(plain.tolist(), sizes.tolist(), strict=True)):
        if not may or held + size > UNIT_BYTES:
            if i > start:
                out.append((start, i))
            start, held = i, 0
        if may:
            held += size
        else:
            out.append((i, i + 1))
            start = i + 1
    if len(sizes) > start:
        out.append((start, len(sizes)))
    return out


def _gather(bounds: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Places of the items of the runs ``which``."""
    first = bounds[which]
    sizes = bounds[which + 1] - first
    shift = np.repeat(first - (np.cumsum(sizes) - sizes), sizes)
    return shift + np.arange(len(shift))


def align_slice(texts: list[bytes | None], aligner: Aligner) -> dict[str, object]:
    """The digests of each text, its chunks, and the pairs of each chunk of the slice."""
    n = len(texts)
    spaced = [b" " + t for t in texts if t]
    lengths = np.fromiter(map(len, spaced), np.int64, len(spaced))
    starts = np.cumsum(lengths) - lengths
    joined = b"".join(spaced)
    data = np.frombuffer(joined, np.uint8)
    begin = aligner.chunk_starts(data, starts) if len(spaced) else np.zeros(0, np.int64)
    offsets = np.append(begin, len(data)).astype(np.int64)
    cut = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(joined)]
    )
    encoded = pc.dictionary_encode(cut)
    which = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    chunks, place = aligner.remember(encoded.dictionary.to_pylist())
    which = place[which]
    bounds = np.append(np.searchsorted(begin, starts), len(begin))

    def per_text(values):
        total = np.concatenate([[0], np.cumsum(values[which])])
        return total[bounds[1:]] - total[bounds[:-1]]

    whole = per_text(chunks.bad.astype(np.int64)) == 0
    place = np.flatnonzero([bool(t) for t in texts])
    out: dict[str, object] = {"groups_sha256": [""] * n}
    for name in _DIGESTS:
        values = np.zeros(n, np.int64)
        values[place] = np.where(whole, per_text(getattr(chunks, name)), 0)
        out[name] = values
    words, listed = chunks.words, which.tolist()
    for i, fine, a, b in zip(place.tolist(), whole.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if fine:
            spelled = b"".join([words[c] for c in listed[a:b]])
            out["groups_sha256"][i] = hashlib.sha256(spelled[:-1]).hexdigest()
    sizes = np.zeros(n, np.int64)
    sizes[place] = np.where(whole, np.diff(bounds), 0)
    out["chunk_counts"] = sizes
    out["chunks"] = which[np.repeat(whole, np.diff(bounds))]
    out["pairs"], out["pair_bounds"] = chunks.pairs, chunks.pair_bounds
    return out


def packed(made: dict, a: int, b: int) -> dict[str, bytes]:
    """The chunks of texts a to b of a slice and the pairs of these chunks, numbered anew."""
    ends = np.cumsum(made["chunk_counts"])
    own = made["chunks"][ends[a] - made["chunk_counts"][a] : ends[b - 1]]
    distinct, chunks = np.unique(own, return_inverse=True)
    places = _gather(made["pair_bounds"], distinct)
    codes, at_code = np.unique(made["pairs"][places], return_inverse=True)
    sizes = np.diff(made["pair_bounds"])[distinct]
    values = (codes, at_code, np.concatenate([[0], np.cumsum(sizes)]), chunks, made["chunk_counts"][a:b])
    return {
        name: value.astype(_KIND.get(name, "<i4")).tobytes() for name, value in zip(_PACKED, values, strict=True)
    }


_DIGESTS = ("n_a", "n_b", "n_groups", "n_links")
_PACKED = ("codes", "at_code", "pair_bounds", "chunks", "chunk_counts")
_KIND = {"codes": "<i8"}


def _unpacked(row: dict) -> tuple[np.ndarray, ...]:
    return tuple(np.frombuffer(row[name], _KIND.get(name, "<i4")).astype(np.int64) for name in _PACKED)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one by one, as each is a slice of texts."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _documents_of_pairs(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """(codes, texts of the slice that hold each)."""
    codes, at_code, bounds, chunks, counts = _unpacked(row)
    held = np.zeros(len(codes), np.int64)
    ends = np.cumsum(counts)
    for start, end in zip((ends - counts).tolist(), ends.tolist(), strict=True):
        if end > start:
            # Each chunk once in a text, then each pair once.
            places = _gather(bounds, np.unique(chunks[start:end]))
            held[np.unique(at_code[places])] += 1
    return codes, held


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def merged():
        codes = np.concatenate([c for c, _ in held])
        counts = np.concatenate([n for _, n in held])
        distinct, place = np.unique(codes, return_inverse=True)
        return distinct, np.bincount(place, counts, len(distinct)).astype(np.int64)

    def sent(codes, counts):
        for i in range(0, len(codes), 100_000):
            part = codes[i : i + 100_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((part >> 32).astype(np.int32)),
                    pa.array((part & 0xFFFFFFFF).astype(np.int32)),
                    pa.array(counts[i : i + 100_000]),
                ],
                names=["a", "b", "n"],
            )

    for batch in batches:
        for row in _rows(batch):
            codes, counts = _documents_of_pairs(row)
            held.append((codes[counts > 0], counts[counts > 0]))
            size += len(codes)
            if size > HELD_PAIRS:
                held = [merged()]
                size = len(held[0][0])
                if size > HELD_PAIRS // 2:
                    yield from sent(*held.pop())
                    size = 0
    if held:
        yield from sent(*merged())


def _sum_links(shared, names: list[str]):
    """Adds, for each text, its links' counts and those that are their A id's highest; of the columns,
    ``names`` are passed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, best = shared.value
        for batch in batches:
            out = {"sums": [], "bests": []}
            for row in _rows(batch.select([*_PACKED, "sums", "bests"])):
                codes, at_code, bounds, chunks, sizes = _unpacked(row)
                at = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
                here = known[at] == codes if len(known) else np.zeros(len(codes), bool)
                for name, table in (("sums", counts), ("bests", best)):
                    value = np.where(here, table[at], 0) if len(known) else np.zeros(len(codes), np.int64)
                    total = np.concatenate([[0], np.cumsum(value[at_code])])
                    per_chunk = total[bounds[1:]] - total[bounds[:-1]] if len(bounds) else total[:0]
                    total = np.concatenate([[0], np.cumsum(per_chunk[chunks])])
                    ends = np.cumsum(sizes)
                    out[name].append((total[ends] - total[ends - sizes] + np.array(row[name], np.int64)).tolist())
            added = {name: pa.array(values, pa.list_(pa.int64())) for name, values in out.items()}
            columns = [added[name] if name in added else batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text of the rows, whose columns are lists."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([c.flatten() for c in batch.columns], names=batch.schema.names)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, n, best): documents that hold each linked pair, and whether A id ``a`` has no higher."""
    counted = (
        aligned.select(*_PACKED)
        .mapInArrow(_count_pairs, "a int, b int, n long")
        .groupBy("a", "b")
        .agg(F.sum("n").alias("n"))
    )
    # An A id overlaps at most the ids of vocabulary B.
    highest = F.max("n").over(Window.partitionBy("a"))
    return counted.withColumn("best", F.col("n") == highest)


def align_tokens(
    documents: DataFrame,
    path_a: str,
    path_b: str,
    *,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    block_pairs: int = BLOCK_PAIRS,
) -> DataFrame:
    """The columns ``keep`` of each row with n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256.

    A text that is null or empty, or that either tokenizer does not give back byte for byte (with a
    space before it), has no tokens: zeros and an empty digest. Each row is a document of its own,
    so repeated rows each count; null ids, an empty table and further columns change nothing. A
    very long text is one slice; kept columns may have any names.
    """
    spark = documents.sparkSession
    hidden = [f"c{i}" for i in range(len(keep))]
    source = documents.select(
        *[F.col(c).alias(h) for c, h in zip(keep, hidden, strict=True)], F.col(text).cast("binary").alias("t")
    )
    listed = [StructField(h, ArrayType(source.schema[h].dataType)) for h in hidden]
    sums = "sums array<long>, bests array<long>"
    plain = ", ".join(f"{name} array<long>" for name in _DIGESTS)
    binary = ", ".join(f"{name} binary" for name in _PACKED)
    schema = StructType(
        listed + StructType.fromDDL(f"{plain}, groups_sha256 array<string>, {binary}, {sums}").fields
    )
    n_keep = len(hidden)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target, aligner = to_arrow_schema(schema), Aligner(path_a, path_b)
        for batch in batches:
            sizes = pc.binary_length(batch.column(n_keep)).fill_null(0).to_pylist()
            for a, b in slices(sizes, SLICE_BYTES):
                part = batch.slice(a, b - a)
                made = align_slice(part.column(n_keep).to_pylist(), aligner)
                for c, d in slices(sizes[a:b], ROW_BYTES):
                    row = packed(made, c, d) | {"sums": [0] * (d - c), "bests": [0] * (d - c)}
                    row |= {name: made[name][c:d] for name in (*_DIGESTS, "groups_sha256")}
                    whole = pa.array([0, d - c], pa.int32())
                    columns = [pa.ListArray.from_arrays(whole, part.column(j).slice(c, d - c)) for j in range(n_keep)]
                    columns += [pa.array([row[f.name]], f.type) for f in list(target)[n_keep:]]
                    yield pa.RecordBatch.from_arrays(columns, schema=target)

    with arrow_batches(spark, BATCH_BYTES):
        aligned = staged(source.mapInArrow(encode, schema), "aligned", ROW_GROUP)
        pairs = staged(pair_counts(aligned), "pair-counts")
        n_blocks = max(1, -(-pairs.count() // block_pairs))
        block = F.pmod(F.xxhash64("a", "b"), F.lit(n_blocks))
        for i in range(n_blocks):
            found = pairs.where(block == i).toArrow() if n_blocks > 1 else pairs.toArrow()
            codes = found["a"].to_numpy().astype(np.int64) << 32 | found["b"].to_numpy().astype(np.int64)
            order = np.argsort(codes)
            best = found["best"].to_numpy(zero_copy_only=False).astype(np.int64)
            shared = spark.sparkContext.broadcast((codes[order], found["n"].to_numpy()[order], best[order]))
            # After the last block the links themselves are not asked for any more.
            left = [f for f in schema if i + 1 < n_blocks or f.name not in _PACKED]
            aligned = aligned.mapInArrow(_sum_links(shared, [f.name for f in left]), StructType(left))
            aligned = staged(aligned, "aligned" if i + 1 < n_blocks else "summed", ROW_GROUP)
    columns = [*hidden, *_DIGESTS, "bests", "sums", "groups_sha256"]
    each = StructType([StructField(c, aligned.schema[c].dataType.elementType) for c in columns])
    names = {h: c for h, c in zip(hidden, keep, strict=True)} | {"bests": "n_best", "sums": "count_sum"}
    laid_out = aligned.select(*columns).mapInArrow(_texts, each)
    return laid_out.select(*[F.col(c).alias(names.get(c, c)) for c in columns])
