"""Approximate nearest neighbours by multi-index hashing.

Vectors are centred, rotated by a learned rotation (principal axes, then alternating between codes and the
rotation that best fits them) and reduced to the signs: one bit per axis. A code is split into ``tables``
substrings, each an index of its own. If two codes differ in r = a * tables + b bits, one of the first b + 1
substrings differs in at most a bits or one of the others in at most a - 1; so probing those buckets retrieves
every code within r. Buckets are probed key by key where fewer keys than buckets are in reach, else all buckets'
keys are compared. What is retrieved is held against the radius in full and ranked by the distance of the
original vectors in double precision.

The radius is each query's own: the distance of the code of the k-th nearest id, counted over the whole index,
plus ``slack`` bits. Codes are noisy, and the slack is what turns nearest codes into nearly all nearest vectors.

The rotation is fitted on at most ``SAMPLE`` vectors, those with the smallest hash of id and vector; every vector
is indexed. Codes are made once; the radius is found from codes alone. Index rows and queries meet in blocks of
bounded size, dealt by id and vector, so that many rows of one id crowd no block. Of equal vectors only the k + 1
smallest ids can be in anybody's list, so the others share their entry's fate: the choice is made before the
shuffle and changes no result. Repeated rows are made one before anything is chosen, so a cap on rows is one on ids.

Rows: vectors that are NULL, empty, zero or hold a NULL or non-finite component take no part. A vector shorter
than another has zeros behind it; codes look at as many entries as most vectors have, distances at all. An id
with several vectors is listed once, at its smallest distance, and as a query asks for all of them. A NULL id takes
no part. Fewer than k candidates are all returned. Distances beyond a double are infinite.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import bounded_sample, blocks_for, written
from tidemark.llm.vectors import is_finite, matrix

SAMPLE = 20_000
TABLES = 4
SLACK = 12
ROUNDS = 30
# Rows of a block of vectors, of the index or of queries, and of a block of codes; at least so many blocks of the index.
VECTOR_ROWS, CODE_ROWS, LEAST_BLOCKS = 32_768, 262_144, 48
# Pairs of a query and a row that are looked at together.
PAIRS_AT_ONCE = 1 << 21
# Candidates are screened by rough distances if at least one pair in so many is a candidate.
SCREEN_FROM = 16


class Coder:
    """A learned rotation and the signs it gives."""

    def __init__(self, sample: np.ndarray, rounds: int = ROUNDS):
        self.scale = np.abs(sample).max()
        sample = self.scaled(sample)
        self.centre = sample.mean(axis=0)
        centred = sample - self.centre
        _, axes = np.linalg.eigh(centred.T @ centred)
        projected = centred @ axes
        rotation = np.linalg.qr(np.random.default_rng(7).standard_normal((axes.shape[1],) * 2))[0]
        for _ in range(rounds):
            signs = np.where(projected @ rotation >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(projected.T @ signs)
            rotation = left @ right
        self.axes = axes @ rotation
        self.bits = self.axes.shape[1]

    def scaled(self, vectors: np.ndarray) -> np.ndarray:
        """In units of the sample's largest entry, so that no product overflows."""
        with np.errstate(over="ignore"):
            return np.clip(vectors / (self.scale or 1.0), -1e100, 1e100)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """One row of bytes per vector, a bit per axis, zeros at the end."""
        return np.packbits((self.scaled(vectors) - self.centre) @ self.axes >= 0, axis=1)


def hamming(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes ^ code).sum(axis=1, dtype=np.int64)


def as_words(codes: np.ndarray) -> np.ndarray:
    """Rows of bytes as rows of one short or several long words, zeros at the end."""
    n = codes.shape[1]
    size = next((s for s in (1, 2, 4) if n <= s), 8)
    filled = np.zeros((len(codes), -(-n // size) * size), np.uint8)
    filled[:, :n] = codes
    return filled.view(f"u{size}")


def all_apart(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Differing bits of every row of words on the left and every one on the right."""
    bits = np.zeros((len(left), len(right)), np.uint16)
    for a, b in zip(left.T, right.T):
        bits += np.bitwise_count(a[:, None] ^ b)
    return bits


@lru_cache(maxsize=64)
def differences(bits: int, reach: int) -> np.ndarray:
    """All words of ``bits`` bits with at most ``reach`` of them set."""
    return np.array([sum(1 << b for b in set_) for n in range(reach + 1) for set_ in combinations(range(bits), n)], np.uint64)


def buckets_within(asked: np.ndarray, values: np.ndarray, bits: int, reach: int) -> np.ndarray:
    """For every asked key which of the sorted bucket keys are within ``reach`` bits of it."""
    reach = min(reach, bits)
    if asked.shape[1] > 1 or sum(comb(bits, n) for n in range(reach + 1)) >= len(values):
        return all_apart(asked, values) <= reach
    probes = asked ^ differences(bits, reach).astype(asked.dtype)
    place = np.minimum(np.searchsorted(values[:, 0], probes), len(values) - 1)
    row, nth = np.nonzero(values[place, 0] == probes)
    hits = np.zeros((len(asked), len(values)), bool)
    hits[row, place[row, nth]] = True
    return hits


class Tables:
    """The substring indexes of a block of codes."""

    def __init__(self, codes: np.ndarray, tables: int):
        self.words = as_words(codes)
        self.cuts = [c for c in np.array_split(np.arange(codes.shape[1]), min(tables, codes.shape[1])) if len(c)]
        self.buckets = []
        for cut in self.cuts:
            keys = as_words(codes[:, cut])
            values, bucket = np.unique(keys, axis=0 if keys.shape[1] > 1 else None, return_inverse=True)
            self.buckets.append((values.reshape(-1, keys.shape[1]), bucket.ravel()))

    def near(self, codes: np.ndarray, radius: int) -> np.ndarray:
        """A row per code asked for: which codes of the block are within the radius."""
        a, b = divmod(radius, len(self.cuts))
        seen = np.zeros((len(codes), len(self.words)), bool)
        for i, (cut, (values, bucket)) in enumerate(zip(self.cuts, self.buckets)):
            reach = a if i <= b else a - 1
            if reach >= 0:
                seen |= buckets_within(as_words(codes[:, cut]), values, 8 * len(cut), reach)[:, bucket]
        asked, found = np.nonzero(seen)
        apart = np.bitwise_count(as_words(codes)[asked] ^ self.words[found]).sum(axis=1, dtype=np.int64)
        seen[asked, found] = apart <= radius
        return seen

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Places of all codes within the radius."""
        return np.flatnonzero(self.near(code[None], radius)[0])


class Vectors:
    """A block of vectors: the first ``width`` entries as a matrix, and what is left of longer ones."""

    def __init__(self, column: pa.Array, width: int):
        sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
        longer = np.flatnonzero(sizes > width)
        self.heads = matrix(pc.list_slice(column, 0, width) if len(longer) else column, width)
        self.tails = {int(i): column[int(i)].values.to_numpy()[width:] for i in longer}
        self.of_tails = np.zeros(len(column))
        with np.errstate(over="ignore"):
            self.of_tails[longer] = [(self.tails[int(i)] ** 2).sum() for i in longer]
            self.squares = (self.heads**2).sum(axis=1) + self.of_tails

    def distances(self, places: np.ndarray, other: Vectors, row: int) -> np.ndarray:
        """From the vectors at the places to one of another block."""
        with np.errstate(over="ignore"):
            squares = ((self.heads[places] - other.heads[row]) ** 2).sum(axis=1)
            tail = other.tails.get(row)
            if tail is None:
                return np.sqrt(squares + self.of_tails[places])
            apart = [_apart(self.tails[p], tail) if p in self.tails else other.of_tails[row] for p in places.tolist()]
            return np.sqrt(squares + np.array(apart, float))

    def screened(self, near: np.ndarray, other: Vectors, rows: np.ndarray, k: int) -> np.ndarray:
        """Of the candidates of each of the other's rows those that may be among its k nearest.

        Distances from one matrix product are rough; what their rounding leaves open stays.
        """
        if near.shape[1] <= k or SCREEN_FROM * np.count_nonzero(near) < near.size or any(int(r) in other.tails for r in rows):
            return near
        with np.errstate(over="ignore", invalid="ignore"):
            sizes = other.squares[rows][:, None] + self.squares
            rough = sizes - 2 * (other.heads[rows] @ self.heads.T)
        if not np.isfinite(rough).all():
            return near
        margin = 8 * (self.heads.shape[1] + 8) * np.finfo(float).eps * sizes.max(axis=1)
        nth = np.partition(np.where(near, rough, np.inf), k - 1, axis=1)[:, k - 1]
        return near & (rough <= (nth + 2 * margin)[:, None])


def _apart(a: np.ndarray, b: np.ndarray) -> float:
    """The squared distance of two vectors; the shorter has zeros behind it."""
    n = min(len(a), len(b))
    return ((a[:n] - b[:n]) ** 2).sum() + (a[n:] ** 2).sum() + (b[n:] ** 2).sum()


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    v = F.col("vector")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & is_finite(v) & F.exists(v, lambda x: x != 0))


def with_codes(rows: DataFrame, coder: Coder, width: int) -> DataFrame:
    """(vec_id, vector, code)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = coder.codes(Vectors(batch.column("vector"), width).heads)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c.tobytes() for c in codes], pa.binary())], ["vec_id", "vector", "code"])

    return rows.select("vec_id", "vector").mapInArrow(work, "vec_id long, vector array<double>, code binary")


def in_block_pairs(index: DataFrame, queries: DataFrame, work: Callable, schema: str, rows_per_block: int, n_index: int, n_queries: int) -> DataFrame:
    """``work`` on every block of the index with every block of queries, rows spread evenly over the blocks."""
    index_blocks, query_blocks = blocks_for(n_index, rows_per_block, LEAST_BLOCKS), blocks_for(n_queries, rows_per_block, 1)

    def dealt(frame: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        place = F.pmod(F.xxhash64(*[c for c in ("vec_id", "vector", "code") if c in frame.columns]), F.lit(blocks))
        # Both sides' block numbers are of one type, or equal ones would be shuffled apart.
        return frame.select("*", place.cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other)).groupBy("i", "q")

    asked = dealt(queries, "q", query_blocks, "i", index_blocks)
    return dealt(index, "i", index_blocks, "q", query_blocks).cogroup(asked).applyInArrow(work, schema)


def matrix_of(codes: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(codes.to_pylist()), np.uint8).reshape(len(codes), -1)


def table_of(schema: dict[str, pa.DataType], parts: list[tuple]) -> pa.Table:
    columns = zip(*parts) if parts else [[np.zeros(0)]] * len(schema)
    return pa.table({n: pa.array(np.concatenate(c)).cast(t) for (n, t), c in zip(schema.items(), columns)})


def nearest_codes(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """In a block, the k ids with the nearest codes of each query: (query_id, vec_id, apart)."""

    def work(index: pa.Table, asked: pa.Table) -> pa.Table:
        parts = []
        if len(index) and len(asked):
            index = index.sort_by("vec_id")
            ids, first = np.unique(index["vec_id"].to_numpy(), return_index=True)
            codes, wanted, queries = as_words(matrix_of(index["code"])), as_words(matrix_of(asked["code"])), asked["vec_id"].to_numpy()
            step = max(1, PAIRS_AT_ONCE // len(codes))
            for start in range(0, len(wanted), step):
                bits = all_apart(wanted[start : start + step], codes)
                if len(first) < len(codes):
                    bits = np.minimum.reduceat(bits, first, axis=1)
                own = ids == queries[start : start + step, None]
                bits[own] = np.iinfo(bits.dtype).max
                best = np.argpartition(bits, min(k, len(ids)) - 1, axis=1)[:, :k]
                counts = ~np.take_along_axis(own, best, axis=1)
                row, nth = np.nonzero(counts)
                parts.append((queries[start + row], ids[best[row, nth]], bits[row, best[row, nth]]))
        return table_of({"query_id": pa.int64(), "vec_id": pa.int64(), "apart": pa.int64()}, parts)

    return work


def ranked(k: int, width: int, tables: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """In a block, the k ids with the nearest vectors of each query among the codes within its radius."""

    def work(index: pa.Table, asked: pa.Table) -> pa.Table:
        parts = []
        if len(index) and len(asked):
            rows, ids = Vectors(index["vector"].combine_chunks(), width), index["vec_id"].to_numpy()
            wanted, queries = Vectors(asked["vector"].combine_chunks(), width), asked["vec_id"].to_numpy()
            lookup, codes, radii = Tables(matrix_of(index["code"]), tables), matrix_of(asked["code"]), asked["radius"].to_numpy()
            # So many rows hold k ids for certain.
            enough = k * int(np.unique(ids, return_counts=True)[1].max())
            step = max(1, PAIRS_AT_ONCE // len(ids))
            for radius in np.unique(radii):
                alike = np.flatnonzero(radii == radius)
                for some in (alike[s : s + step] for s in range(0, len(alike), step)):
                    near = lookup.near(codes[some], int(radius)) & (ids != queries[some, None])
                    for row, found in zip(some.tolist(), rows.screened(near, wanted, some, enough)):
                        places = np.flatnonzero(found)
                        score = rows.distances(places, wanted, row)
                        order = np.lexsort((ids[places], score))
                        # The first row of each id, nearest first.
                        once = np.sort(np.unique(ids[places][order], return_index=True)[1])[:k]
                        best = order[once]
                        parts.append((np.full(len(best), queries[row]), ids[places][best], score[best]))
        return table_of({"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}, parts)

    return work


def k_least(found: DataFrame, value: str, k: int) -> DataFrame:
    """Of each query the k ids of least value, with their rank; an id counts once."""
    once = found.groupBy("query_id", "vec_id").agg(F.min(value).alias(value))
    order = Window.partitionBy("query_id").orderBy(value, "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    slack: int = SLACK,
    tables: int = TABLES,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k nearest other vectors found.

    ``is_query`` is a condition over ``vec_id``.
    """
    rows = written(usable(vectors, id_col, vector_col).distinct(), "usable")
    # As many entries as most vectors have.
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not lengths:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = lengths[0]["n"]
    heads = F.slice(F.concat("vector", F.array_repeat(F.lit(0.0), width)), 1, width)
    sample = bounded_sample(rows, "vec_id", "vector", rows=SAMPLE).select(heads.alias("head")).toPandas()["head"]
    coder = Coder(np.stack(sample.to_numpy()))

    # Spark keeps the k + 1 smallest of a group in each task before it shuffles the rest away.
    copies = Window.partitionBy("vector").orderBy("vec_id")
    entries = rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1)
    entries = written(with_codes(entries, coder, width), "vectors")
    queries = written(with_codes(rows.where(is_query), coder, width), "queries")
    sizes = entries.count(), queries.count()

    codes = [frame.select("vec_id", "code") for frame in (entries, queries)]
    close = in_block_pairs(*codes, nearest_codes(k), "query_id long, vec_id long, apart long", CODE_ROWS, *sizes)
    radius = k_least(close, "apart", k).groupBy("query_id").agg((F.max("apart") + slack).alias("radius"))
    asked = queries.join(radius.withColumnRenamed("query_id", "vec_id"), "vec_id")
    found = in_block_pairs(entries, asked, ranked(k, width, tables), "query_id long, vec_id long, score double", VECTOR_ROWS, *sizes)
    return k_least(found, "score", k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
