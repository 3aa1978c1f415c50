"""Suffix-array dedup: remove every byte covered by a string of ``window`` bytes that also starts elsewhere.

Shards are dealt so that equal strings meet. Of the grams of half a window in a window, the one with the smallest
hash is the window's anchor: equal windows have equal anchors at equal offsets. Neighbouring windows share
anchors, so a text falls into pieces: the windows of one anchor and the bytes they cover. Pieces whose anchor is
found nowhere else in the corpus hold no repeat. Of the others, equal ones are one piece with a count, and all
pieces of an anchor go to one shard. There the pieces' suffixes are sorted by external induced sorting
(``induced_sort``), which carries common-prefix values; a window is repeated if its suffix shares ``window`` bytes
with a neighbour, or if its piece is counted more than once. Pieces end with a separator, so nothing matches
across documents, and a shard may be far larger than memory: texts, arrays and queues lie in files of the task's
scratch folder, which the task deletes.

An anchor with very many different pieces (a passage in a third of all texts) would fill a shard. Its pieces are
cut in two by the offset of their windows; each half covers more bytes around the anchor in common, so its anchor
is a longer string. That goes on until no anchor is crowded, at the latest at whole windows, which are equal if
their anchors are.

The digests that stand for anchors and pieces have 64 bits each; pieces count as equal where both agree.

Rows: a NULL text counts as empty; a text shorter than the window loses nothing. Rows without an id and repeated
rows are rows of their own, so a repeated row is a repeat. No rows give no rows. Long texts are cut into pieces in
blocks.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import written
from tidemark.llm.induced_sort import Scratch, blocks, suffix_array

WINDOW = 400
# Window starts of a text that are looked at together, and bytes of pieces of a shard; with more shards than this
# they grow.
TEXT_BLOCK, SHARD_BYTES, SHARDS = 1 << 20, 1 << 22, 20_000
# Different pieces of an anchor beyond which they are cut.
CROWDED = 50_000
# Bits of the filter that spares texts without a find the shuffle; full, it spares none.
FILTER_BITS = 1 << 23
# Fixed values of the rolling hash: an odd multiplier, a multiplier of the finish.
_STEP, _MIX = 0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD
# Symbols of a shard's text: its end, a separator, then bytes.
_END, _SEPARATOR, _BYTE = 0, 1, 2


def _powers(step: int, n: int) -> np.ndarray:
    return np.cumprod(np.append(np.uint64(1), np.full(n, step, np.uint64)))


class Cutter:
    """Cuts texts into pieces of windows with one anchor."""

    def __init__(self, window: int):
        self.window, self.gram = window, max(1, window // 2)
        self.byte = np.random.default_rng(11).integers(0, 2**64 - 1, 256, np.uint64)
        self.up = self.down = np.zeros(0, np.uint64)

    def _hashes(self, x: np.ndarray) -> np.ndarray:
        """A hash of each gram that depends on its bytes alone."""
        if len(self.up) < len(x):
            self.up, self.down = _powers(_STEP, len(x)), _powers(pow(_STEP, -1, 2**64), len(x))
        sums = np.append(np.uint64(0), np.cumsum(self.byte[x] * self.up[: len(x)]))
        h = (sums[self.gram :] - sums[: -self.gram]) * self.down[: len(sums) - self.gram]
        h ^= h >> np.uint64(33)
        h *= np.uint64(_MIX)
        h ^= h >> np.uint64(33)
        return h

    def pieces(self, text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """First window start, number of windows, offset of the anchor and its hash, for blocks of a text."""
        whole, span = np.frombuffer(text, np.uint8), self.window - self.gram + 1
        for start, end in blocks(len(whole) - self.window + 1, TEXT_BLOCK):
            h = self._hashes(whole[start : end + self.window - 1])
            # The leftmost smallest of the grams of a window: hash above, place below.
            placed = (h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
            rows = np.full(-(-len(h) // span) * span, np.uint64(2**64 - 1))
            rows[: len(h)] = placed
            rows = rows.reshape(-1, span)
            up_to = np.minimum.accumulate(rows, axis=1).ravel()
            back_to = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
            n = end - start
            anchor = (np.minimum(back_to[:n], up_to[span - 1 : span - 1 + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            first = np.flatnonzero(np.diff(anchor, prepend=-1))
            yield first + start, np.diff(np.append(first, n)), anchor[first] - first, h[anchor[first]].view(np.int64)


def _digest(text: bytes, offset: int) -> int:
    """Stands for a piece: its bytes and where its anchor begins."""
    return int.from_bytes(hashlib.blake2b(text + offset.to_bytes(8, "little", signed=True), digest_size=8).digest(), "little", signed=True)


PIECES = "row long, start long, windows int, offset int, key long, piece long"


def pieces(rows: DataFrame, window: int) -> DataFrame:
    """All pieces of all texts; ``rows`` holds (row, text binary)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(window)
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text")):
                data = text.as_py() or b""
                for start, count, offset, key in cutter.pieces(data):
                    begins, counts, offsets = start.tolist(), count.tolist(), offset.tolist()
                    digests = [_digest(data[b : b + c + window - 1], o) for b, c, o in zip(begins, counts, offsets)]
                    for column, values in zip(out, ([row] * len(begins), begins, counts, offsets, key.tolist(), digests)):
                        column += values
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["row", "start", "windows", "offset", "key", "piece"])

    return rows.select("row", "text").mapInArrow(run, PIECES)


def _with_text(found: DataFrame, rows: DataFrame, window: int) -> DataFrame:
    """(key, piece, offset, many, text) of one place of each different piece."""
    wanted = found.groupBy("row").agg(F.collect_list(F.struct("key", "piece", "start", "windows", "offset", "many")).alias("found"))
    maybe, _ = split_by_filter(rows, found.select("row"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64()), ("piece", pa.int64()), ("offset", pa.int32()), ("many", pa.bool_()), ("text", pa.binary())])
        for batch in batches:
            for text, places in zip(batch.column("text"), batch.column("found").to_pylist()):
                data = text.as_py()
                yield pa.RecordBatch.from_pylist(
                    [{**p, "text": data[p["start"] : p["start"] + p["windows"] + window - 1]} for p in places], schema
                )

    return maybe.join(wanted, "row").select("text", "found").mapInArrow(cut, "key long, piece long, offset int, many boolean, text binary")


def split_by_filter(rows: DataFrame, some: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key may be among ``some``, and those whose key is not, by a bitmap of bounded size."""
    place = f"pmod(xxhash64(row), {FILTER_BITS}L)"
    word, bit = F.expr(f"cast({place} div 64 AS int)"), F.expr(f"shiftleft(1L, cast({place} % 64 AS int))")
    bits = some.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    # A row per word of the bitmap at most, whatever ``some`` holds.
    bits = F.broadcast(written(bits, "filter"))
    joined = rows.withColumns({"_word": word, "_bit": bit}).join(bits, "_word", "left")
    hit = F.coalesce(F.col("_bits").bitwiseAND(F.col("_bit")) != 0, F.lit(False))
    return joined.where(hit).select(rows.columns), joined.where(~hit).select(rows.columns)


FOUND = "key long, piece long, firsts array<int>, lasts array<int>"


def _runs(hit: np.ndarray) -> tuple[list[int], list[int]]:
    edges = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0))
    return edges[::2].tolist(), edges[1::2].tolist()


def sort_shard(texts: Iterable[bytes], window: int, folder: str) -> Iterator[np.ndarray]:
    """For each text which of its windows also start elsewhere in the shard."""
    scratch = Scratch(folder)
    path, sizes, n = scratch.path(), [], 0
    with open(path, "wb") as out:
        for text in texts:
            symbols = np.append(np.frombuffer(text, np.uint8).astype(np.uint16) + _BYTE, np.uint16(_SEPARATOR))
            symbols.tofile(out)
            sizes.append(len(text))
            n += len(symbols)
        np.full(3, _END, np.uint16).tofile(out)
    symbols = np.memmap(path, np.uint16, "r").view(np.ndarray)
    order, shares = suffix_array(scratch, symbols, n + 1, 255 + _BYTE, window)
    hit = scratch.array(n + 1, np.bool_)
    for start, end in blocks(len(order)):
        close = shares[start : min(end + 1, len(order))] >= window
        either = close[: end - start].copy()
        either[: len(close) - 1] |= close[1:]
        hit[order[start:end]] = either
    at = 0
    for size in sizes:
        yield hit[at : at + size - window + 1]
        at += size + 1


def repeated_in_shards(found: DataFrame, window: int, shard_bytes: int) -> DataFrame:
    """(key, piece, firsts, lasts): runs of repeated windows of each piece, pieces of a key in one shard."""
    total = found.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, names, many = [], [], []

        def texts() -> Iterator[bytes]:
            for batch in batches:
                keys.extend(batch.column("key").to_pylist())
                names.extend(batch.column("piece").to_pylist())
                many.extend(batch.column("many").to_pylist())
                for text in batch.column("text"):
                    yield text.as_py()

        # Spilled arrays of this task alone, as a shuffle's spills are: gone with the task, made anew if it is run again.
        with tempfile.TemporaryDirectory(prefix="shard-") as folder:
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            rows: list[tuple] = []
            for i, hit in enumerate(sort_shard(texts(), window, folder)):
                firsts, lasts = ([0], [len(hit)]) if many[i] else _runs(hit)
                if firsts:
                    rows.append((keys[i], names[i], firsts, lasts))
                if len(rows) == 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["key", "piece", "firsts", "lasts"])
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["key", "piece", "firsts", "lasts"])

    dealt = found.select("key", "piece", "many", "text").repartition(max(1, min(SHARDS, -(-total // shard_bytes))), "key")
    return dealt.mapInArrow(run, FOUND)


def _by_company(different: DataFrame, crowded: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Different pieces whose anchor was found more than once: those alone with it, those to be sorted, and those
    in a crowd. ``n`` says how often a piece was found."""
    kinds = different.groupBy("key").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).where("total > 1")
    # A crowded anchor has many rows here and one there: a join whose skewed side Spark splits.
    kinds = written(kinds.select("key", "kinds"), "kinds")
    found = written(written(different, "different").join(kinds, "key").withColumn("many", F.col("n") > 1), "shared")
    return found.where("kinds = 1"), found.where(F.col("kinds").between(2, crowded)), found.where(F.col("kinds") > crowded)


def _whole(alone: DataFrame) -> DataFrame:
    """A piece alone with its anchor leaves a shard nothing to sort: it was found twice, and so all its windows."""
    return alone.select("key", "piece", F.array(F.lit(0)).alias("firsts"), F.array(F.col("windows")).alias("lasts"))


HALVES = (
    "parent_key long, parent long, shift int, n int, windows int, offset int, key long, piece long, side int, text binary"
)


def _halves(texts: DataFrame, low: int, high: int, window: int) -> DataFrame:
    """Pieces whose anchors lie ``low`` to ``high`` behind their windows' starts, cut in two halves of that range."""
    middle = (low + high) // 2

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("parent_key", pa.int64()), ("parent", pa.int64()), ("shift", pa.int32()), ("n", pa.int32()), ("windows", pa.int32()),
            ("offset", pa.int32()), ("key", pa.int64()), ("piece", pa.int64()), ("side", pa.int32()), ("text", pa.binary()),
        ])
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                count, offset, text = len(r["text"]) - window + 1, r["offset"], r["text"]
                # The window at i has its anchor at offset - i.
                for side, (least, most) in enumerate(((low, middle), (middle + 1, high))):
                    first, last = max(0, offset - most), min(count - 1, offset - least)
                    if first > last:
                        continue
                    part, place = text[first : last + window], offset - first
                    # What all windows of this half cover, wherever a piece begins.
                    core = text[offset - least : offset - most + window]
                    out.append({
                        "parent_key": r["key"], "parent": r["piece"], "shift": first, "n": 2 if r["many"] else 1, "windows": last - first + 1,
                        "offset": place, "key": _digest(core, least), "piece": _digest(part, place), "side": side, "text": part,
                    })
            yield pa.RecordBatch.from_pylist(out, schema)

    return texts.select("key", "piece", "offset", "many", "text").mapInArrow(run, HALVES)


def _uncrowded(texts: DataFrame, low: int, high: int, window: int, crowded: int, shard_bytes: int) -> DataFrame:
    """``FOUND`` rows of pieces of crowded anchors, through their halves."""
    halves = written(_halves(texts, low, high, window), "halves")
    middle, found = (low + high) // 2, None
    for side, (least, most) in enumerate(((low, middle), (middle + 1, high))):
        each = halves.where(F.col("side") == side)
        different = each.groupBy("key", "piece").agg(
            F.sum("n").alias("n"), F.first("windows").alias("windows"), F.first("offset").alias("offset"), F.first("text").alias("text")
        )
        alone, some, many = _by_company(different, crowded)
        part = _whole(alone).unionByName(repeated_in_shards(some, window, shard_bytes))
        # Pieces of a single offset are windows, equal if their anchors are: no crowd is left.
        if least < most and not many.isEmpty():
            part = part.unionByName(_uncrowded(many, least, most, window, crowded, shard_bytes))
        of_side = part.join(each.select("key", "piece", "parent_key", "parent", "shift"), ["key", "piece"])
        found = of_side if found is None else found.unionByName(of_side)
    shifted = {c: F.transform(c, lambda x: x + F.col("shift")) for c in ("firsts", "lasts")}
    lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("firsts", "lasts")]
    both = found.withColumns(shifted).groupBy("parent_key", "parent").agg(*lists)
    return both.withColumnsRenamed({"parent_key": "key", "parent": "piece"})


def repeats(rows: DataFrame, window: int = WINDOW, crowded: int = CROWDED, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(row, firsts, lasts): runs of repeated window starts of each text that has any; lasts are exclusive.

    ``rows`` holds (row long, text binary) with a key per row; read several times, so best a written table.
    """
    everywhere = written(pieces(rows, window), "pieces")
    # Written, so that the join shuffles both sides itself and Spark can split the rows of a frequent anchor.
    repeated = written(everywhere.groupBy("key").count().where("count > 1").select("key"), "repeated")
    places = written(everywhere.join(repeated, "key", "left_semi"), "places")
    different = places.groupBy("key", "piece").agg(
        F.count("*").alias("n"), F.first("windows").alias("windows"), F.first("offset").alias("offset"),
        F.min(F.struct("row", "start")).alias("at"),
    ).select("key", "piece", "n", "windows", "offset", "at.row", "at.start")
    alone, some, many = _by_company(different, crowded)
    found = _whole(alone).unionByName(repeated_in_shards(written(_with_text(some, rows, window), "sortable"), window, shard_bytes))
    if not many.isEmpty():
        texts = written(_with_text(many, rows, window), "crowded")
        span = window - max(1, window // 2) + 1
        found = found.unionByName(_uncrowded(texts, 0, span - 1, window, crowded, shard_bytes))
    # A piece found very often meets its single row here: Spark splits its places.
    shifted = {c: F.transform(c, lambda x: x.cast("long") + F.col("start")) for c in ("firsts", "lasts")}
    lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("firsts", "lasts")]
    return places.join(found, ["key", "piece"]).withColumns(shifted).groupBy("row").agg(*lists)


def covered(firsts: list[int], lasts: list[int], window: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the windows starting in these runs cover."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(zip(firsts, lasts)):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last + window - 1))
        else:
            out.append((first, last + window - 1))
    return out


KEPT = "doc_id long, n_bytes long, n_removed long, spans array<struct<first:long,last:long>>, kept binary"


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    crowded: int = CROWDED, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept): what was removed, ends exclusive, and the bytes that are left."""
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = written(rows, "texts")
    found = written(repeats(rows, window, crowded, shard_bytes), "repeats")
    maybe, none = split_by_filter(rows, found.select("row"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("first", pa.int64()), ("last", pa.int64())])
        for batch in batches:
            texts, spans, kept, removed = batch.column("text"), [], [], []
            for text, firsts, lasts in zip(texts, batch.column("firsts").to_pylist(), batch.column("lasts").to_pylist()):
                data, at, left = text.as_py(), 0, []
                gone = covered(firsts or [], lasts or [], window)
                for first, last in gone:
                    left.append(data[at:first])
                    at = last
                spans.append([{"first": f, "last": l} for f, l in gone])
                kept.append(b"".join([*left, data[at:]]))
                removed.append(len(data) - len(kept[-1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "spans", "kept"],
            )

    size = F.octet_length("text").cast("long").alias("n_bytes")
    touched = maybe.join(found, "row", "left").select("doc_id", size, "text", "firsts", "lasts").mapInArrow(cut, KEPT)
    whole = none.select(
        "doc_id", size, F.lit(0).cast("long").alias("n_removed"),
        F.array().cast("array<struct<first:bigint,last:bigint>>").alias("spans"), F.col("text").alias("kept"),
    )
    return touched.unionByName(whole)
