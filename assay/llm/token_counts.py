"""Operator 9: exact token counts of a byte-level BPE tokenizer by finite-state transducers.

Two deterministic transducers are compiled.

* The splitter reads character classes and marks where pre-tokens start; each transition is
  annotated with the starts it emits. A batch of texts is one string of classes, cut into
  chunks. Every chunk is run from all states at once, which gives its state map; the maps are
  composed by a parallel prefix scan, which gives each chunk its true first state; a last run
  emits the starts.
* The merger reads the bytes of a pre-token. It is compiled lazily as a trie whose nodes hold
  the token that ends there and the tokens emitted so far. It rests on a property of BPE: a
  prefix is encoded as the encoding of a shorter prefix and one more token, and that token is
  right if and only if it and its neighbour survive together when merged from bytes.

The vocabulary's merges are read on the driver from the file whose path is a parameter, and
sent to tasks with the function; a vocabulary file is a few megabytes.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import map_texts

# Entries of a task's memory of pre-tokens and trie nodes, and bytes of a pre-token that enters
# it; beyond, the memory is emptied, or the pre-token is counted without it.
MEMORY = 500_000
REMEMBERED_BYTES = 48
CHUNK = 64
# Last bytes by which tokens are told apart that can end at a place.
TAIL = 4

# Character classes.
END, SPACE, BLANK, NUMBER, OTHER, APOSTROPHE, LETTER, STMD, RV, E, L = range(11)
LETTERS = (LETTER, STMD, RV, E, L)
# States of the splitter: FRESH stands where nothing has been read of the next pre-token.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ONE_SPACE, ONE_BLANK = range(6)
MORE_SPACE, MORE_BLANK, QUOTE, QUOTE_RV, QUOTE_L = range(6, 11)
N_STATES = 11
# What a transition emits: a pre-token starts at this character, or at the one before.
HERE, BEFORE = 1, 2


def compile_splitter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, emission), both indexed by state * 16 + class.

    The rule: a contraction ('s 't 're 've 'm 'll 'd), or letters, numbers or other characters
    with a leading space if there is one, or white space, whose last character is left to what
    follows it.
    """
    step, emit = np.zeros(256, np.uint8), np.zeros(256, np.uint8)
    opens = {END: FRESH, SPACE: ONE_SPACE, BLANK: ONE_BLANK, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS}
    opens |= {APOSTROPHE: QUOTE} | dict.fromkeys(LETTERS, IN_LETTERS)

    def rule(state: int, kind: int) -> tuple[int, int]:
        begin = (opens[kind], 0 if kind == END else HERE)
        letter, white = kind in LETTERS, kind in (SPACE, BLANK)
        if state == IN_LETTERS and letter or state == IN_NUMBERS and kind == NUMBER:
            return state, 0
        if state in (IN_OTHERS, QUOTE) and kind in (OTHER, APOSTROPHE):
            return IN_OTHERS, 0
        if state == QUOTE and kind in (STMD, RV, L):
            return {STMD: FRESH, RV: QUOTE_RV, L: QUOTE_L}[kind], 0
        if (state, kind) in ((QUOTE_RV, E), (QUOTE_L, L)):
            return FRESH, 0
        if state in (QUOTE_RV, QUOTE_L):  # no contraction: letters began with the last character
            return (IN_LETTERS, BEFORE) if letter else (begin[0], begin[1] | BEFORE)
        if state in (ONE_SPACE, ONE_BLANK, MORE_SPACE, MORE_BLANK) and white:
            return MORE_SPACE if kind == SPACE else MORE_BLANK, 0
        if state in (ONE_SPACE, MORE_SPACE) and kind != END:
            into = IN_OTHERS if kind == APOSTROPHE else opens[kind]
            return into, BEFORE if state == MORE_SPACE else 0
        if state == MORE_BLANK and kind != END:
            return begin[0], begin[1] | BEFORE
        return begin

    for state in range(N_STATES):
        for kind in range(11):
            step[state * 16 + kind], emit[state * 16 + kind] = rule(state, kind)
    return step, emit


def character_classes() -> np.ndarray:
    """Class of every code point, from the Unicode properties of letters, numbers and spaces."""
    import sys

    import regex

    every = "".join(map(chr, range(sys.maxunicode + 1)))
    classes = np.full(len(every), OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", BLANK)):
        for found in regex.finditer(pattern, every):
            classes[found.start() : found.end()] = kind
    for letters, kind in (("stmd", STMD), ("rv", RV), ("e", E), ("l", L), (" ", SPACE), ("'", APOSTROPHE)):
        classes[[ord(c) for c in letters]] = kind
    return classes


def split_starts(kinds: np.ndarray, step: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """Positions at which pre-tokens start, for a string of character classes."""
    n = len(kinds)
    chunks = -(-n // CHUNK)
    padded = np.zeros(chunks * CHUNK, np.uint8)  # END
    padded[:n] = kinds
    columns = np.ascontiguousarray(padded.reshape(chunks, CHUNK).T)
    # The state map of each chunk: where it ends from each state.
    ends = np.repeat(np.arange(N_STATES, dtype=np.uint8)[:, None], chunks, axis=1)
    for column in columns:
        ends = step[(ends << 4) + column]
    # Inclusive prefix scan of the composed maps.
    width, which = 1, np.arange(chunks)
    while width < chunks:
        later = ends[:, width:]
        ends = np.concatenate([ends[:, :width], later[ends[:, :-width], which[None, : chunks - width]]], axis=1)
        width *= 2
    state = np.concatenate([[np.uint8(FRESH)], ends[FRESH, :-1]]).astype(np.uint8)
    seen = np.empty_like(columns)
    for k, column in enumerate(columns):
        seen[k] = (state << 4) + column
        state = step[seen[k]]
    emitted = emit[seen.T.reshape(-1)]
    starts = (emitted & HERE).astype(bool)
    starts[:-1] |= (emitted[1:] & BEFORE).astype(bool)
    return np.flatnonzero(starts[:n])


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_vocabulary(path: str) -> dict:
    """Merges as pairs of byte strings in order of rank, and special tokens, of a .json file."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    alphabet = byte_alphabet()
    raw = [m if isinstance(m, list) else m.split(" ") for m in described["model"]["merges"]]
    merges = [tuple(bytes(alphabet[c] for c in part) for part in pair) for pair in raw]
    special = [t["content"] for t in described["added_tokens"]]
    return {"merges": merges, "special": special}


class Merger:
    """Lazily compiled transducer from the bytes of a pre-token to its number of tokens."""

    def __init__(self, merges: list[tuple[bytes, bytes]]):
        never = len(merges)
        texts = [bytes([b]) for b in range(256)] + [a + b for a, b in merges]
        self.id = {text: i for i, text in reversed(list(enumerate(texts)))}
        # Length of the longest token that ends in the same four bytes.
        self.longest: dict[bytes, int] = {}
        for text in sorted(texts, key=len):
            if len(text) >= TAIL:
                self.longest[text[-TAIL:]] = len(text)
        self.rank = {self.id[a] << 32 | self.id[b]: r for r, (a, b) in enumerate(merges)}
        # What a token's right (left) edge is made of: each part with the rank of the merge
        # that takes it up, innermost last.
        self.right: list[list[tuple[int, int]]] = [[(i, never)] for i in range(len(texts))]
        self.left: list[list[tuple[int, int]]] = [[(i, never)] for i in range(len(texts))]
        for r, (a, b) in enumerate(merges):
            made, one, two = self.id[a + b], self.id[a], self.id[b]
            if made == 256 + r:
                self.right[made] += [(two, r), *self.right[two][1:]]
                self.left[made] += [(one, r), *self.left[one][1:]]
        self.counts: dict[bytes, int] = {}
        self.pairs: dict[int, bool] = {}
        self.clear()

    def clear(self) -> None:
        self.counts.clear()
        self.next: dict[int, int] = {}  # node and byte to node
        self.token: list[int] = [-1]
        self.count: list[int] = [0]

    def stand_together(self, one: int, two: int) -> bool:
        """Whether no merge across the border of two neighbours comes before their own merges."""
        key = one << 32 | two
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > MEMORY:
                self.pairs.clear()
            rank, known = self.rank, True
            for x, taken_x in self.right[one]:
                for y, taken_y in self.left[two]:
                    r = rank.get(x << 32 | y)
                    # Equal ranks: of two equal pairs the left one is merged first.
                    if r is not None and r < taken_x and r <= taken_y:
                        known = False
                        break
                if not known:
                    break
            self.pairs[key] = known
        return known

    def ending(self, text: bytes, end: int, tokens: list[int]) -> tuple[int, int]:
        """The token that ends at ``end``, and its size; ``tokens`` has those that end before, by place."""
        find, known = self.id.get, self.pairs.get
        longest = self.longest.get(text[end - TAIL : end], TAIL - 1) if end >= TAIL else end
        for start in range(max(0, end - longest), end):
            last = find(text[start:end])
            if last is None:
                continue
            if start:
                one = tokens[start]
                fits = known(one << 32 | last)
                if not (self.stand_together(one, last) if fits is None else fits):
                    continue
            return last, end - start
        raise AssertionError("a byte is always a token")

    def _walk(self, text: bytes) -> int:
        """Follows the trie as far as it goes, then adds a branch for the rest."""
        node, path, find = 0, [0], self.next.get
        for byte in text:
            node = find(node << 8 | byte)
            if node is None:
                break
            path.append(node)
        else:
            return self.count[node]
        node, token_of, count_of = path[-1], self.token, self.count
        tokens = [token_of[p] for p in path]
        # Nodes of a branch are new, one after another, and none of them is looked up.
        for end in range(len(path), len(text) + 1):
            token, size = self.ending(text, end, tokens)
            edge = node << 8 | text[end - 1]
            node = self.next[edge] = len(token_of)
            token_of.append(token)
            count_of.append(count_of[path[end - size]] + 1)
            path.append(node)
            tokens.append(token)
        return count_of[node]

    def _run(self, text: bytes) -> int:
        tokens, counts = [-1], [0]
        for end in range(1, len(text) + 1):
            token, size = self.ending(text, end, tokens)
            tokens.append(token)
            counts.append(counts[end - size] + 1)
        return counts[-1]

    def __call__(self, piece: bytes) -> int:
        known = self.counts.get(piece)
        if known is None:
            if len(piece) > REMEMBERED_BYTES:
                return self._run(piece)
            if max(len(self.counts), len(self.token)) > MEMORY:
                self.clear()
            known = self.counts[piece] = self._walk(piece)
        return known


def counter(vocabulary: dict):
    """A function of a list of texts as bytes (None for null) to their token counts."""
    step, emit = compile_splitter()
    classes, merger, special = character_classes(), Merger(vocabulary["merges"]), vocabulary["special"]
    parts_of = None
    if special:
        import re

        parts_of = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))))

    def call(texts):
        owners, parts, counts = [], [], [0] * len(texts)
        for i, text in enumerate(texts):
            split = parts_of.split(text.decode()) if parts_of and text else [(text or b"").decode()]
            counts[i] = len(split) - 1
            filled = [part for part in split if part]
            parts += filled
            owners += [i] * len(filled)
        if parts:
            joined = "\0".join(parts)
            lengths = np.fromiter(map(len, parts), np.int64, len(parts))
            ends = np.cumsum(lengths + 1) - 1
            kinds = classes[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
            kinds[ends[:-1]] = END
            starts = split_starts(kinds, step, emit)
            # Pre-tokens and the separators between parts, one after another, in bytes.
            places = np.sort(np.concatenate([starts, ends[:-1]]), kind="stable")
            data = np.frombuffer(joined.encode(), np.uint8)
            begins = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
            offsets = np.append(begins[places], len(data)).astype(np.int64)
            pieces = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
            )
            # Each distinct pre-token of the slice is counted once.
            encoded = pc.dictionary_encode(pieces)
            each = np.array([merger(piece) for piece in encoded.dictionary.to_pylist()], np.int64)
            tokens = each[encoded.indices.to_numpy(zero_copy_only=False)]
            tokens[np.searchsorted(places, ends[:-1])] = 0
            total = np.concatenate([[0], np.cumsum(tokens)])
            first = np.searchsorted(places, ends - lengths)
            last = np.searchsorted(places, ends)
            sums = np.bincount(owners, total[last] - total[first], len(texts)).astype(np.int64)
            counts = (np.array(counts) + sums).tolist()
        return counts

    return call


def _make(vocabulary: dict):
    def make():
        count = counter(vocabulary)

        def call(texts):
            return {"n_bytes": [len(t or b"") for t in texts], "n_tokens": count(texts)}

        return call

    return make


def count_tokens(
    documents: DataFrame,
    vocabulary_path: str,
    *,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    limit: int = 1024,
) -> DataFrame:
    """The columns ``keep`` of each row, n_bytes, n_tokens and over_limit (n_tokens > limit).

    Special tokens written out in a text count as one token each, as the library takes them.
    A null or empty text has no bytes and no tokens. Each row is counted by itself, so repeated
    rows and ids, null ids and further columns change nothing.
    """
    names = tuple(f"c{i}" for i in range(len(keep)))
    source = documents.select(
        *[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], F.col(text).alias("body")
    )
    counted = map_texts(
        source,
        _make(load_vocabulary(vocabulary_path)),
        "n_bytes long, n_tokens long",
        text="body",
        keep=names,
    )
    return counted.select(
        *[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)],
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
