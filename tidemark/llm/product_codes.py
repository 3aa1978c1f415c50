"""Vector code compression: codebooks of vector parts by Lloyd rounds with adaptive distance bounds.

A vector is quantized to integers and cut into equal parts; each part position has a codebook. A round assigns
every part to its nearest entry and replaces entries by their members' means, rounded down. Between rounds every
part keeps what Drake and Hamerly keep: its b closest entries, nearest first, with a lower bound on the distance
to each but the first, an upper bound on that to the first, and one outer bound below the distance to all other
entries. When entries move, bounds are loosened by how far. A part whose upper bound stays below all lower ones
keeps its entry unseen; where some stored entries are in question, these alone are measured; where the outer
bound is, all are. Bounds are floats with a margin, verdicts are not: whatever is measured is measured in
integers, and ties go to the lower index. How many entries the next round keeps, b, follows in each block from
how deep this round had to look.

The state between rounds is a written table. Codebooks are bounded (entries times dimensions integers) and
travel with the tasks; sums of members are added up in a task and then by Spark.

Rows: a vector that is NULL or holds a NULL or non-finite component takes no part. All other rows are returned,
repeated ones too; those without an id come last where ids are put in order. Vectors are as long as the longest,
rounded up to a multiple of the parts: others have zeros behind them. Fewer vectors than entries give as many
entries as there are vectors. Huge components are computed with integers of any size; an error that is no long is
NULL. No rows give no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import written
from tidemark.llm.vectors import finite_rows, in_blocks, longest, matrix

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
BLOCK_ROWS = 4_096
# Of all the entries the first round keeps a quarter per part; later rounds between an eighth and a half.
FIRST_SHARE, LEAST_SHARE, MOST_SHARE = 4, 8, 2
# b suits all but so many of the parts of a block; these are measured against every entry.
LEFT_OVER = 0.05
# Floats of these sizes are off by far less.
MARGIN = 1e-9
# Up to here squared distances of a part fit a long.
SMALL = 2**27
# Totals of up to so many labels are sent to the tasks whole.
FEW_LABELS = 20_000


def _integers(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * x), as longs where squares of differences fit, as Python integers elsewhere."""
    scaled = np.floor(vectors * SCALE)
    if np.abs(scaled).max(initial=0) < SMALL:
        return scaled.astype(np.int64)
    exact = [[int(np.floor(x * SCALE)) if np.isfinite(x * SCALE) else int(x) * SCALE for x in row] for row in vectors]
    return np.array(exact, object).reshape(vectors.shape)


def _roots(squares: np.ndarray) -> np.ndarray:
    if squares.dtype == object:
        root = [math.sqrt(s) if s < 2**900 else float(math.isqrt(s)) for s in squares.ravel().tolist()]
        return np.array(root, float).reshape(squares.shape)
    return np.sqrt(squares)


def _apart(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances in integers; the last axis of both is the components."""
    step = points - entries
    return (step * step).sum(axis=-1)


@dataclass
class Bounds:
    """Per part: its entries nearest first, an upper bound, lower bounds of the entries after the first, an outer bound."""

    near: np.ndarray
    upper: np.ndarray
    lower: np.ndarray
    outer: np.ndarray

def measure_all(points: np.ndarray, codebook: np.ndarray, keep: int) -> Bounds:
    """Bounds of points (rows of components) from their distances to every entry of a codebook."""
    keep = min(keep, len(codebook))
    squares = _apart(points[:, None, :], codebook[None, :, :])
    order = np.argsort(squares, axis=1, kind="stable")
    far = _roots(np.take_along_axis(squares, order, axis=1))
    outer = far[:, keep] if keep < len(codebook) else np.full(len(points), np.inf)
    return Bounds(order[:, :keep], far[:, 0], far[:, 1:keep], outer)


def reassign(points: np.ndarray, codebook: np.ndarray, moved: np.ndarray, held: Bounds) -> tuple[Bounds, np.ndarray]:
    """Bounds after the entries moved by at most ``moved``, and how many stored entries each point had to look at.

    The count is 1 where no other entry came into question and ``b + 1`` where all entries had to be measured.
    """
    b = held.near.shape[1]
    slack = 1 - MARGIN
    upper = (held.upper + moved[held.near[:, 0]]) * (1 + MARGIN)
    lower = (held.lower - moved[held.near[:, 1:]]) * slack
    outer = (held.outer - moved.max(initial=0)) * slack
    # Stored entries from position z on are farther than the nearest can be: none of them, nor the rest, is looked at.
    beyond = np.minimum.accumulate(np.column_stack([lower, outer])[:, ::-1], axis=1)[:, ::-1]
    depth = np.where(beyond > upper[:, None], np.arange(1, b + 1), b + 1).min(axis=1)
    near = held.near.copy()
    new_upper, new_lower, new_outer = upper.copy(), np.maximum(lower, 0), np.maximum(outer, 0)
    for z in np.unique(depth[(depth > 1) & (depth <= b)]):
        at = np.flatnonzero(depth == z)
        some = held.near[at, :z]
        squares = _apart(points[at, None, :], codebook[some])
        order = np.lexsort((some, squares), axis=1)
        near[at, :z] = np.take_along_axis(some, order, axis=1)
        far = _roots(np.take_along_axis(squares, order, axis=1))
        new_upper[at] = far[:, 0]
        new_lower[at, : z - 1] = far[:, 1:]
    deep = np.flatnonzero(depth > b)
    if len(deep):
        found = measure_all(points[deep], codebook, b)
        near[deep], new_upper[deep], new_lower[deep], new_outer[deep] = found.near, found.upper, found.lower, found.outer
    return Bounds(near, new_upper, new_lower, new_outer), depth


def adapted(depth: np.ndarray, entries: int, b: int) -> int:
    """Stored entries for the next round: enough for nearly all parts, judged by how deep they looked."""
    wanted = np.sort(depth)[int((1 - LEFT_OVER) * (len(depth) - 1))]
    wanted = 2 * b if wanted > b else wanted + 1
    return int(min(max(wanted, entries // LEAST_SHARE, 2), max(entries // MOST_SHARE, 2), entries))


def resized(held: Bounds, b: int, points: np.ndarray, codebook: np.ndarray) -> Bounds:
    """The same bounds with b stored entries: dropped ones go into the outer bound, more are measured."""
    have = held.near.shape[1]
    if b > have:
        return measure_all(points, codebook, b)
    if b == have:
        return held
    outer = np.minimum(held.outer, held.lower[:, b - 1 :].min(axis=1))
    return Bounds(held.near[:, :b], held.upper, held.lower[:, : b - 1], outer)


STATE = (
    "vec_id long, label {label}, vector array<double>, code array<int>, near array<int>, upper array<double>, "
    "lower array<double>, outer array<double>"
)


def _state(table: pa.Table, code: np.ndarray, bounds: list[Bounds] | None) -> list[pa.RecordBatch]:
    n, parts = code.shape

    def listed(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
        rows = rows.reshape(n, -1)
        offsets = pa.array(np.arange(n + 1, dtype=np.int32) * rows.shape[1])
        return pa.ListArray.from_arrays(offsets, pa.array(rows.ravel(), kind))

    def joined(name: str) -> np.ndarray:
        each = [getattr(b, name) for b in bounds] if bounds else [np.zeros((n, 0))] * parts
        return np.stack(each, axis=1)

    columns = {name: table[name].combine_chunks() for name in ("vec_id", "label", "vector")}
    columns["code"] = listed(code, pa.int32())
    columns["near"] = listed(joined("near"), pa.int32())
    for name in ("upper", "lower", "outer"):
        columns[name] = listed(joined(name), pa.float64())
    return pa.table(columns).to_batches()


def _held(table: pa.Table, parts: int) -> list[Bounds]:
    n = table.num_rows

    def split(name: str) -> np.ndarray:
        return table[name].chunk(0).flatten().to_numpy(zero_copy_only=False).reshape(n, parts, -1)

    near, upper, lower, outer = split("near"), split("upper"), split("lower"), split("outer")
    return [Bounds(near[:, p], upper[:, p, 0], lower[:, p], outer[:, p, 0]) for p in range(parts)]


def _assign(rows: DataFrame, books: list[np.ndarray], width: int, schema: str, keep: bool, moved: list[np.ndarray] | None) -> DataFrame:
    """The state of all rows under these codebooks; ``moved`` says how far entries went since the state was made."""
    parts = len(books)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in in_blocks(batches, BLOCK_ROWS):
            for table in _alike(whole, moved is not None):
                points = np.split(_integers(matrix(table["vector"].chunk(0), width)), parts, axis=1)
                if moved is None:
                    bounds = [measure_all(p, c, max(2, len(c) // FIRST_SHARE)) for p, c in zip(points, books)]
                else:
                    seen = [reassign(p, c, m, h) for p, c, m, h in zip(points, books, moved, _held(table, parts))]
                    b = adapted(np.concatenate([depth for _, depth in seen]), len(books[0]), seen[0][0].near.shape[1])
                    bounds = [resized(h, b, p, c) for (h, _), p, c in zip(seen, points, books)] if keep else [h for h, _ in seen]
                code = np.stack([b.near[:, 0] for b in bounds], axis=1)
                yield from _state(table, code, bounds if keep else None)

    return rows.mapInArrow(run, schema)


def _alike(table: pa.Table, stored: bool) -> Iterator[pa.Table]:
    """Runs of rows that keep equally many entries: blocks of the round before need not be those of this one."""
    if not stored:
        yield table
        return
    sizes = np.diff(table["near"].chunk(0).offsets.to_numpy())
    edges = np.flatnonzero(np.diff(sizes)) + 1
    for start, end in zip([0, *edges], [*edges, len(sizes)]):
        yield table.slice(start, end - start).combine_chunks()


def _moved(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    return _roots(_apart(new, old)) * (1 + MARGIN)


def _put(book: np.ndarray, entry: int, at: int, value: int) -> np.ndarray:
    if book.dtype != object and abs(value) >= SMALL:
        book = book.astype(object)
    book[entry, at] = value
    return book


def _updated(state: DataFrame, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    """Codebooks of the rounded means of members; entries without any stay."""
    parts, entries, size = len(books), len(books[0]), width // len(books)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, size), object)
        count = np.zeros((parts, entries), np.int64)
        for table in in_blocks(batches, BLOCK_ROWS):
            points = np.split(_integers(matrix(table["vector"].chunk(0), width)), parts, axis=1)
            code = table["code"].chunk(0).flatten().to_numpy().reshape(-1, parts)
            for p, x in enumerate(points):
                block = np.zeros((entries, size), x.dtype)
                np.add.at(block, code[:, p], x)
                total[p] = total[p] + block
                count[p] += np.bincount(code[:, p], minlength=entries)
        rows = []
        for part, entry in np.argwhere(count).tolist():
            for at, t in enumerate(total[part, entry].tolist()):
                sign, t = (-1 if t < 0 else 1), abs(t)
                # A sum of any size goes in digits of 64 bits, each of which Spark can add up.
                for digit in range(max(1, -(-t.bit_length() // 64))):
                    value = sign * (t >> 64 * digit & 0xFFFFFFFFFFFFFFFF)
                    rows.append((part, entry, at, digit, int(count[part, entry]), value))
        if rows:
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0))
            names = ("part", "entry", "at", "digit", "n", "total")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], list(names))

    schema = "part int, entry int, at int, digit int, n long, total decimal(38,0)"
    sums = state.select("vector", "code").mapInArrow(partial, schema)
    totals: dict[tuple[int, int, int], int] = {}
    members: dict[tuple[int, int, int], int] = {}
    # Entries times dimensions rows, whatever the number of vectors.
    for r in sums.groupBy("part", "entry", "at", "digit").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        place = (r["part"], r["entry"], r["at"])
        totals[place] = totals.get(place, 0) + (int(r["total"]) << 64 * r["digit"])
        if r["digit"] == 0:
            members[place] = r["n"]
    new = [book.copy() for book in books]
    for (part, entry, at), total in totals.items():
        new[part] = _put(new[part], entry, at, total // members[part, entry, at])
    return new


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal by part, entry and position, with commas between."""
    return hashlib.sha256(",".join(str(int(x)) for book in books for x in book.ravel()).encode()).hexdigest()


def train(rows: DataFrame, width: int, parts: int, entries: int, rounds: int) -> tuple[DataFrame, list[np.ndarray]]:
    """The final state of all rows and the final codebooks."""
    schema = STATE.format(label=dict(rows.dtypes)["label"])
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select("vector").toArrow()
    start = _integers(matrix(first["vector"].combine_chunks(), width))
    books, moved, state = np.split(start, parts, axis=1), None, rows
    for _ in range(rounds):
        state = written(_assign(state, books, width, schema, True, moved), "assigned")
        new = _updated(state, books, width)
        moved = [_moved(old, now) for old, now in zip(books, new)]
        books = new
    return _assign(state, books, width, schema, False, moved), books


def encode(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, codes array<int>, error) of the rows that take part, and the codebooks, one array per part."""
    rows = finite_rows(vectors, id_col, vector_col, F.col(label_col).alias("label"))
    label = dict(rows.dtypes)["label"]
    schema = f"vec_id long, label {label}, codes array<int>, error long"
    longest_row = longest(rows)
    if not longest_row:
        lone = rows.withColumn("codes", F.array_repeat(F.lit(0), parts)).withColumn("error", F.lit(0).cast("long"))
        return lone.select("vec_id", "label", "codes", "error"), [np.zeros((0, 0), np.int64)] * parts
    width = -(-longest_row // parts) * parts
    state, books = train(rows, width, parts, entries, rounds)

    def errors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in in_blocks(batches, BLOCK_ROWS):
            points = np.split(_integers(matrix(table["vector"].chunk(0), width)), parts, axis=1)
            code = table["code"].chunk(0).flatten().to_numpy().reshape(-1, parts)
            error = sum(_apart(x, books[p][code[:, p]]) for p, x in enumerate(points))
            yield from pa.table({
                "vec_id": table["vec_id"], "label": table["label"], "codes": table["code"],
                "error": pa.array([e if e < 2**63 else None for e in error.tolist()], pa.int64()),
            }).to_batches()

    return state.mapInArrow(errors, schema), books


def code_text(codes: Column | str) -> Column:
    """Indexes in part order, two hex digits each."""
    return F.array_join(F.transform(codes, lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")


def with_label_error(coded: DataFrame) -> DataFrame:
    """``label_error``: the errors of all rows of the same label, NULL labels together.

    Totals are added up in a task first. Few labels go to the tasks whole; of many, Spark splits the rows of a
    frequent one, whose partner is a single row.
    """
    coded = written(coded, "coded")
    totals = written(coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error")), "totals")
    if totals.count() <= FEW_LABELS:
        totals = F.broadcast(totals)
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of_label")), "left").drop("of_label")
