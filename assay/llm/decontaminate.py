"""Operator 1: benchmark decontamination by Wu-Manber multi-pattern search over words.

Words are runs of ASCII letters and digits and of non-ASCII characters, after lower-casing
A-Z. A benchmark item gives one pattern for each 13 consecutive words, or one of all its
words if it has fewer. Patterns are sought with Wu-Manber's method, words being the alphabet:
a block of words looked up in a shift table tells how far the search may jump; where the shift
is 0, a bucket keyed by the hash of the suffix block, then by the prefix block, picks patterns;
a direct comparison confirms each occurrence.

The benchmark is the stated query set. It is cut into blocks of bounded bytes; documents are
passed once per block and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import map_texts, staged

WINDOW = 13
# Bytes of benchmark words compiled into one set of tables; what a task holds of the benchmark.
BLOCK_BYTES = 16 * 1024 * 1024
# Words of a long item that one row holds; neighbouring rows overlap by WINDOW - 1 words.
PIECE_WORDS = 50_000

_DELIMITERS = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_UPPER = bytes(range(0x41, 0x5B))
_FOLD = bytes.maketrans(
    bytes(b for b in _DELIMITERS if b not in _UPPER) + _UPPER,
    b" " * (len(_DELIMITERS) - len(_UPPER)) + _UPPER.lower(),
)


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words of a UTF-8 text; none for null."""
    return text.translate(_FOLD).split() if text else []


class WuManber:
    """Tables for patterns (lists of words) of one class of lengths."""

    def __init__(self, patterns: list[tuple[bytes, ...]]):
        self.m = min(map(len, patterns))
        self.block = min(3, (self.m + 1) // 2)
        self.jump = self.m - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list[list[bytes]]]] = {}
        for pattern in patterns:
            head = pattern[: self.m]
            for end in range(self.block, self.m + 1):
                part = head[end - self.block : end]
                self.shift[part] = min(self.shift.get(part, self.jump), self.m - end)
            bucket = self.buckets.setdefault(head[self.m - self.block :], {})
            bucket.setdefault(head[: self.block], []).append(list(pattern))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """(start, pattern) of every occurrence, in order of start."""
        m, block, jump, shift, n = self.m, self.block, self.jump, self.shift, len(words)
        end = m
        while end <= n:
            part = tuple(words[end - block : end])
            step = shift.get(part, jump)
            if step:
                end += step
                continue
            start = end - m
            for pattern in self.buckets[part].get(tuple(words[start : start + block]), ()):
                if words[start : start + len(pattern)] == pattern:
                    yield start, tuple(pattern)
            end += 1


def patterns_of(words: list[bytes], window: int = WINDOW) -> Iterator[tuple[bytes, ...]]:
    if words and len(words) < window:
        yield tuple(words)
    for i in range(len(words) - window + 1):
        yield tuple(words[i : i + window])


def _pieces(window: int):
    def make():
        def call(texts):
            out = []
            for text in texts:
                words = words_of(text)
                step = PIECE_WORDS
                starts = range(0, max(1, len(words) - window + 1), step) if words else ()
                out.append([b" ".join(words[s : s + step + window - 1]) for s in starts])
            return {"piece": out}

        return call

    return make


def benchmark_blocks(
    benchmark: DataFrame, item: str, text: str, window: int, block_bytes: int
) -> list[DataFrame]:
    """The benchmark's distinct (item, words) in blocks of about ``block_bytes`` at most.

    Sizes are measured first, so each block can go through the driver by itself.
    """
    pieces = staged(
        map_texts(
            benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")),
            _pieces(window),
            "piece array<binary>",
            keep=("item",),
        )
        .select("item", F.explode("piece").alias("piece"))
        .distinct(),
        "benchmark",
    )
    total = pieces.agg(F.sum(F.length("piece")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // block_bytes))
    while True:
        block = F.pmod(F.xxhash64("item", "piece"), F.lit(blocks))
        sizes = pieces.groupBy(block.alias("block")).agg(F.sum(F.length("piece")).alias("n"))
        largest = sizes.agg(F.max("n").alias("n")).first()["n"] or 0
        # A piece is bounded by PIECE_WORDS, so doubling soon helps; past total it cannot.
        if largest <= 2 * block_bytes or blocks > total:
            return [pieces.where(block == b) for b in range(blocks)]
        blocks *= 2


def compile_block(rows: list[tuple[str | None, bytes]], window: int = WINDOW):
    """(searchers, items by pattern) of one block; patterns are classed by length."""
    items: dict[tuple[bytes, ...], set[str]] = {}
    for item, piece in rows:
        for pattern in patterns_of(piece.split(), window):
            found = items.setdefault(pattern, set())
            if item is not None:
                found.add(item)
    classes: dict[int, list[tuple[bytes, ...]]] = {}
    for pattern in items:
        classes.setdefault(len(pattern).bit_length() if len(pattern) < window else 0, []).append(pattern)
    return [WuManber(patterns) for patterns in classes.values()], items


def merge_runs(runs: list[tuple[int, int]]) -> list[int]:
    """Sorted disjoint runs [start, end), flattened."""
    flat: list[int] = []
    for start, end in sorted(runs):
        if flat and start <= flat[-1]:
            flat[-1] = max(flat[-1], end)
        else:
            flat += [start, end]
    return flat


def _scan(rows: list[tuple[str | None, bytes]], window: int):
    def make():
        searchers, items_of = compile_block(rows, window)

        def call(texts, earlier_runs, earlier_items):
            n_words, n_hit, hits, items = [], [], [], []
            for text, before, had in zip(texts, earlier_runs, earlier_items, strict=True):
                words = words_of(text)
                runs = list(zip(before[::2], before[1::2], strict=True)) if before else []
                ids = set(had or ())
                for searcher in searchers:
                    for start, pattern in searcher.find(words):
                        runs.append((start, start + len(pattern)))
                        ids |= items_of[pattern]
                flat = merge_runs(runs)
                n_words.append(len(words))
                n_hit.append(sum(flat[1::2]) - sum(flat[::2]))
                hits.append(flat)
                items.append(sorted(ids))
            return {"n_words": n_words, "n_hit": n_hit, "hit_runs": hits, "hit_items": items}

        return call

    return make


FIELDS = "n_words long, n_hit long, hit_runs array<int>, hit_items array<string>"


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    name: str = "contamination",
) -> DataFrame:
    """The columns ``keep`` of each document row and a struct column ``name``.

    ``name`` holds: n_words, n_hit (words inside an occurrence), hit_runs (disjoint word
    runs, flattened as start, end exclusive), hit_items (distinct item ids as strings, sorted),
    contaminated (n_hit > 0 and 20 * n_hit >= n_words). A null or empty text has no words and
    is not contaminated; an item without words has no pattern; an item with a null id marks
    words but is in no list; repeated items count once; every document row gives one row, in
    the presence of repeated or null ids as well. An empty benchmark marks nothing.
    """
    names = tuple(f"c{i}" for i in range(len(keep)))
    body = dict(zip(keep, names, strict=True)).get(text, "body")
    apart = () if body in names else (body,)
    carried = documents.select(
        *[F.col(c).alias(name) for c, name in zip(keep, names, strict=True)],
        *[F.col(text).alias(b) for b in apart],
        F.lit(None).cast("array<int>").alias("hit_runs"),
        F.lit(None).cast("array<string>").alias("hit_items"),
    )
    blocks = benchmark_blocks(benchmark, item, item_text, window, block_bytes)
    for i, block in enumerate(blocks):
        rows = [(r["item"], bytes(r["piece"])) for r in block.collect()]
        last = i == len(blocks) - 1
        carried = map_texts(
            carried,
            _scan(rows, window),
            FIELDS,
            text=body,
            inputs=("hit_runs", "hit_items"),
            keep=names if last else (*names, *apart),
        )
        if not last:
            carried = staged(carried.drop("n_words", "n_hit"), "contamination")
    n_hit, n_words = F.col("n_hit"), F.col("n_words")
    contaminated = (n_hit > 0) & (20 * n_hit >= n_words)
    return carried.select(
        *[F.col(name).alias(c) for c, name in zip(keep, names, strict=True)],
        F.struct(
            "n_words", "n_hit", "hit_runs", "hit_items", contaminated.alias("contaminated")
        ).alias(name),
    )
