"""Benchmark decontamination by q-gram filtering and banded alignment.

A passage of m characters that occurs in a text with at most k edits shares at least m - q + 1 - k * q of its
q-grams with it, and all of those lie on diagonals (place in the text minus place in the passage) no more than
2k apart. So the shared q-grams are counted per passage in diagonal bands that overlap by half, each wide enough
to hold any such match whole; a band that reaches the bound is a region, and an alignment of the passage within
the band decides. Case, punctuation and spacing do not count: both sides become lower-case runs of letters and
digits with one space between.

The budget k is a share of the passage's length, and less where the bound would ask for no shared q-gram at all.
Passages shorter than ``BORDERED`` characters must begin and end where words do: they are matched with the spaces
around them. Those shorter than q have no q-gram and are looked up as runs of whole words. Passages are handed to
the tasks in blocks of at most ``BLOCK_CHARS`` characters, each with its q-gram table; the texts are read once per
block, and the driver holds one block at a time.

Rows: a NULL or empty text matches nothing. Passages without a letter or digit take no part, as do NULL ones. Equal
passages match under each of their ids. Texts are worked off in overlapping pieces, so their length is not bounded. Other columns are not
read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import id_and_bytes, written

Q = 12
# Edits allowed per character of a passage.
BUDGET = 0.05
# Passages below so many normalized characters are matched at word borders.
BORDERED = 40
# Normalized characters of the passages a task holds at once.
BLOCK_CHARS = 4_000_000
# Characters of a text whose q-grams are looked up at once.
PIECE = 1 << 20
FACTOR = np.uint64(0x9E3779B97F4A7C15)
FILTER_BITS = 22


# Code points whose kind is looked up in a table; the few beyond are asked one by one.
TABLED = 0x3000


class Normalizer:
    """Lower-case letters and digits, one space for any run of anything else, none at the ends."""

    def __init__(self):
        self.alphanumeric = np.array([chr(c).isalnum() for c in range(TABLED)])

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Code points, and the place in the lower-cased text of each."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        keep = self.alphanumeric[np.minimum(codes, TABLED - 1)]
        beyond = np.flatnonzero(codes >= TABLED)
        keep[beyond] = [chr(c).isalnum() for c in codes[beyond]]
        gap = ~keep
        gap[1:] &= keep[:-1]
        if len(gap):
            gap[0] = False
        places = np.flatnonzero(keep | gap)
        out = np.where(keep[places], codes[places], 32).astype(np.uint32)
        if len(out) and out[-1] == 32:
            out, places = out[:-1], places[:-1]
        return out, places


def qgrams(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every run of Q code points; empty for shorter input."""
    if len(codes) < Q:
        return np.zeros(0, np.uint64)
    power, length, hashes = FACTOR, 1, codes.astype(np.uint64) + np.uint64(1)
    result, done, scale = None, 0, np.uint64(1)
    size = len(codes) - Q + 1
    with np.errstate(over="ignore"):
        while length <= Q:
            if Q & length:
                part = hashes[done : done + size] * scale
                result = part if result is None else result + part
                done, scale = done + length, scale * power
            hashes = hashes[:-length] + hashes[length:] * power if len(hashes) > length else hashes[:0]
            power, length = power * power, 2 * length
        return (result ^ (result >> np.uint64(29))) * FACTOR


def bordered(codes: np.ndarray) -> np.ndarray:
    """Normalized text with a space at either end."""
    return np.concatenate([[32], codes, [32]]).astype(np.uint32)


def as_text(codes: np.ndarray) -> str:
    return codes.tobytes().decode("utf-32-le", "surrogatepass")


class Passages:
    """Passages of a block, and where each of their q-grams occurs."""

    def __init__(self, ids: list[int], texts: list[str], only: bool = True):
        normalize, self.only = Normalizer(), only
        self.ids, self.codes, keys, owner, place = [], [], [], [], []
        lengths = []
        # Passages without a q-gram, by their text, and how many words they have.
        self.brief: dict[str, list[int]] = {}
        for item, text in zip(ids, texts):
            codes, _ = normalize(text)
            if not len(codes):
                continue
            if len(codes) < Q:
                self.brief.setdefault(as_text(codes), []).append(item)
                continue
            lengths.append(len(codes))
            if len(codes) < BORDERED:
                codes = bordered(codes)
            grams = qgrams(codes)
            keys.append(grams)
            owner.append(np.full(len(grams), len(self.ids)))
            place.append(np.arange(len(grams)))
            self.ids.append(item)
            self.codes.append(codes)
        joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, owner, place)]
        order = np.argsort(joined[0], kind="stable")
        self.keys, self.owner, self.place = joined[0][order].astype(np.uint64), joined[1][order], joined[2][order]
        self.lengths = np.array([len(c) for c in self.codes], np.int64)
        # With more edits than this not one q-gram need be shared.
        most = (self.lengths - Q) // Q
        self.budgets = np.minimum(np.floor(np.array(lengths, np.int64) * BUDGET).astype(np.int64), most)
        self.words = sorted({text.count(" ") + 1 for text in self.brief})
        self.bounds = self.lengths - Q + 1 - self.budgets * Q
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.keys >> np.uint64(64 - FILTER_BITS)] = True

    def shared(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the text, passage, place in the passage) of every shared q-gram."""
        places = np.flatnonzero(self.filter[grams >> np.uint64(64 - FILTER_BITS)])
        first = np.searchsorted(self.keys, grams[places], "left")
        count = np.searchsorted(self.keys, grams[places], "right") - first
        hits = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        return np.repeat(places, count), self.owner[hits], self.place[hits]

    def regions(self, grams: np.ndarray) -> list[tuple[int, int, int]]:
        """(passage, first and last diagonal) of the bands that reach the bound."""
        places, owner, inner = self.shared(grams)
        # Too few in the whole text are too few in any band: most texts end here.
        enough = (np.bincount(owner, minlength=len(self.ids)) >= self.bounds)[owner]
        if not enough.any():
            return []
        places, owner, inner = places[enough], owner[enough], inner[enough]
        diagonal = places - inner
        half = 2 * self.budgets[owner] + 1
        band = diagonal // half
        # Band b holds the diagonals of the steps b and b + 1; a place in the passage counts once in it.
        both = np.concatenate([np.stack([owner, band - shift, inner]) for shift in (0, 1)], axis=1)
        pairs, counts = np.unique(np.unique(both, axis=1)[:2], axis=1, return_counts=True)
        full = counts >= self.bounds[pairs[0]]
        steps = 2 * self.budgets[pairs[0]] + 1
        return [(int(p), int(b * s), int((b + 2) * s - 1)) for p, b, s in zip(*pairs[:, full], steps[full])]


def align(passage: np.ndarray, text: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """Fewest edits from the passage to a part of the text along diagonals low..high, and where that part lies.

    None beyond the budget. A row of the table holds the places low - budget to high + budget, moved with the row.
    """
    for diagonal in range(max(low, 0), min(high, len(text) - len(passage)) + 1):
        if text[diagonal] == passage[0] and np.array_equal(text[diagonal : diagonal + len(passage)], passage):
            return 0, diagonal, diagonal + len(passage)  # nothing is cheaper than no edit
    shifts = np.arange(low - budget, high + budget + 1)
    far = len(passage) + budget + 1
    inside = (shifts >= 0) & (shifts <= len(text))
    cost, origin = np.where(inside, 0, far), shifts.copy()
    ramp = np.arange(len(shifts))
    padded = np.concatenate([text, [0]])
    for row, code in enumerate(passage, 1):
        at = shifts + row  # places in the text after this row, before which its character lies
        real = (at >= 1) & (at <= len(text))
        same = padded[np.clip(at - 1, 0, len(text))] == code
        step = np.where(real, cost + ~same, far)
        up = np.append(cost[1:] + 1, far)  # the passage's character is missing from the text
        up = np.where((at >= 0) & (at <= len(text)), up, far)
        begin = np.where(step <= up, origin, np.append(origin[1:], 0))
        cost = np.minimum(step, up)
        # Characters the text has besides: the cheapest place to the left plus the distance.
        key = cost - ramp
        best = np.minimum.accumulate(key)
        source = np.maximum.accumulate(np.where(key == best, ramp, 0))
        source = np.where(key[source] == best, source, ramp)
        origin, cost = begin[source], np.where(real | (at == 0), best + ramp, far)
        if cost.min() > budget:
            return None
    end = int(np.argmin(cost))
    return (int(cost[end]), int(origin[end]), int(shifts[end] + len(passage))) if cost[end] <= budget else None


class Matcher:
    """Finds the passages of a block in a text."""

    def __init__(self, passages: Passages):
        self.passages, self.normalize = passages, Normalizer()
        self.overlap = int((passages.lengths + 6 * passages.budgets).max(initial=0)) + Q

    def find(self, text: bytes | None) -> list[tuple[int, int, int, int]]:
        """Per passage found its id and the best match: edits, and its first and last place in the lower-cased text."""
        if not text:
            return []
        codes, places = self.normalize(text.decode("utf-8", "replace"))
        if not len(codes):
            return []
        whole = sorted(self.similar(bordered(codes), np.concatenate([places[:1], places, places[-1:]])).items())
        return [(self.passages.ids[p], *match) for p, match in whole] + self.equal(codes, places)

    def equal(self, codes: np.ndarray, places: np.ndarray) -> list[tuple[int, int, int, int]]:
        """The first place of each passage that is too short for a q-gram."""
        found: dict[str, tuple[int, int]] = {}
        if not self.passages.brief:
            return []
        words = as_text(codes).split(" ")
        ends = list(itertools.accumulate(len(w) + 1 for w in words))
        for n in self.passages.words:
            for first in range(len(words) - n + 1):
                run = " ".join(words[first : first + n])
                if run in self.passages.brief and run not in found:
                    start = ends[first] - len(words[first]) - 1
                    found[run] = int(places[start]), int(places[start + len(run) - 1])
        return sorted((item, 0, *found[run]) for run in found for item in self.passages.brief[run])

    def similar(self, codes: np.ndarray, places: np.ndarray) -> dict[int, tuple[int, int, int]]:
        """Per passage with q-grams its best match."""
        found: dict[int, tuple[int, int, int]] = {}
        if not self.passages.ids:
            return found
        for start in range(0, max(1, len(codes) - self.overlap), PIECE):
            piece = codes[start : start + PIECE + self.overlap]
            for passage, low, high in self.passages.regions(qgrams(piece)):
                if passage in found and not found[passage][0]:
                    continue
                match = align(self.passages.codes[passage], piece, low, high, int(self.passages.budgets[passage]))
                if match and (passage not in found or match[0] < found[passage][0]):
                    first, last = start + match[1], start + match[2] - 1
                    first, last = first + (codes[first] == 32), last - (codes[last] == 32)
                    found[passage] = match[0], int(places[first]), int(places[last])
        return found


def passage_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> Iterator[Passages]:
    """The passages, a bounded block at a time."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / BLOCK_CHARS))
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = part.orderBy("item_id", "text").collect()
        yield Passages([r["item_id"] for r in rows], [r["text"] for r in rows], only=blocks == 1)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, edits, first_char, last_char) for every passage found in a text."""
    names = ["doc_id", "item_id", "edits", "first_char", "last_char"]
    parts = []
    for passages in passage_blocks(benchmark):

        def work(batches: Iterator[pa.RecordBatch], passages=passages) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(passages)
            for batch in batches:
                rows = [
                    (doc, *match) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)) for match in matcher.find(text.as_py())
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in list(zip(*rows)) or [()] * 5], names)

        found = id_and_bytes(docs, id_col, text_col).mapInArrow(work, ", ".join(f"{n} long" for n in names))
        # Of several blocks each is done with before the next one comes to the driver.
        parts.append(found if passages.only else written(found, "leaks"))
    return reduce(DataFrame.unionByName, parts)


def leak_judge(passages: Passages):
    """A pandas UDF over text bytes: does any passage of the block occur?"""

    @F.pandas_udf("boolean")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(passages)
        for texts in batches:
            yield pd.Series([bool(matcher.find(t)) for t in texts], dtype=bool)

    return judge


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows whose text holds no passage of the benchmark."""
    for passages in passage_blocks(benchmark):
        docs = docs.where(~leak_judge(passages)(F.col(text_col).cast("binary")))
        if not passages.only:
            docs = written(docs, "unleaked")
    return docs
