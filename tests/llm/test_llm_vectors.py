"""Whitening and vector codes against plain numpy over whole tables, and on awkward rows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.llm import product_codes, queries, whitening
from tidemark.llm.common import bounded_sample, prepare

NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    prepare(spark)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return df.withColumns({c: F.lit("x") for c in ("vector", "place", "n", "code", "codes", "near", "component", "of_label")})


# Whitening --------------------------------------------------------------------------------------------


def quantized(embeddings):
    return np.floor(64 * np.stack(embeddings).astype(float)).astype(np.int64) + 1_000_000


def check_whitened(got, ids, x, components):
    n, total = len(x), x.sum(axis=0)
    centred = x - total / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    got = got.set_index(["vec_id", "component"])
    assert len(got) == n * components
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, total)) for row in x]
    first = got.xs(1, level="component").loc[ids]
    assert first.deviation.tolist() == deviation and first.deviation_exact.tolist() == [str(d) for d in deviation]
    assert set(got.n) == {n}
    assert np.allclose(got.groupby("component").explained.first(), values[:components] / values.sum(), rtol=1e-9)
    white = got.whitened.unstack().loc[ids].to_numpy()
    expected = centred @ axes[:, :components] / np.sqrt(values[:components])
    assert np.allclose(white * np.sign((white * expected).sum(axis=0)), expected, atol=1e-8)
    assert got.identity_error.nunique() == 1
    assert got.identity_error.iloc[0] <= 1e-9 and abs(white.T @ white / n - np.eye(components)).max() <= 1e-9


def test_whitening_equals_numpy(spark, sf_dir):
    rows = pd.read_parquet(f"{sf_dir}/embeddings.parquet")
    got = queries.op11_embedding_whitening(spark, sf_dir).toPandas()
    check_whitened(got, rows.vec_id.tolist(), quantized(rows.embedding), 32)


@pytest.mark.parametrize("partitions, fan_in, block", [(1, 16, 7), (9, 2, 3), (40, 3, 4096)])
def test_spectra_combine_however_rows_are_dealt(spark, monkeypatch, partitions, fan_in, block):
    monkeypatch.setattr(whitening, "FAN_IN", fan_in)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", block)
    rng = np.random.default_rng(partitions)
    vectors = rng.standard_normal((60, 5)) * [9, 3, 1, 0.5, 0.2]
    df = frame(spark, [(i, v.tolist(), 0) for i, v in enumerate(vectors)]).repartition(partitions, "vec_id")
    check_whitened(whitening.whiten(df, 4).toPandas(), list(range(60)), quantized(vectors), 4)


@given(st.integers(0, 2**32))
@settings(max_examples=80, deadline=None)
def test_rank_one_updates_keep_the_spectrum_of_the_scatter(seed):
    rng = np.random.default_rng(seed)
    width, n = int(rng.integers(1, 12)), int(rng.integers(1, 60))
    rows = np.floor(rng.standard_normal((n, width)) * rng.choice([1, 20, 1e5]))
    if rng.random() < 0.5:  # equal rows, equal and constant columns: everything that deflates
        rows[n // 2 :] = rows[0]
        rows[:, -1] = rows[:, 0]
        rows[:, width // 2] = 7
    halves = []
    for part in np.array_split(rows, int(rng.integers(1, 4))):
        held = whitening.Spectrum.empty(width)
        for block in np.array_split(part, 2):
            held.add_block(block)
        halves.append(held)
    whole = halves[0]
    for other in halves[1:]:
        whole.add(other)
    centred = rows - rows.mean(axis=0)
    scatter, size = centred.T @ centred, max(1.0, np.abs(centred).max() ** 2 * n)
    assert whole.n == n and np.allclose(whole.mean, rows.mean(axis=0))
    assert np.abs(whole.vectors * whole.values @ whole.vectors.T - scatter).max() <= 1e-11 * size
    assert np.abs(whole.vectors.T @ whole.vectors - np.eye(width)).max() <= 1e-12


@pytest.mark.parametrize("weight", [1e-10, 1e-16, 1e-20, 1e-26])
def test_roots_beside_poles_of_little_weight(weight):
    # 1 + weight / (p - x) + 1 / (q - x) is zero at these roots, up to squares of the weight.
    for poles, weights, root in (([0.0, 1.0], [weight, 1.0], weight / 2), ([0.0, 1.0], [4.0, weight], -weight / 3)):
        origin, offset = whitening.secular_roots(np.array(poles), np.array(weights))
        near = np.flatnonzero(np.array(weights)[origin] == weight)[0]
        assert offset[near] == pytest.approx(root, rel=max(1e-14, 4 * weight), abs=0)


def test_an_update_with_little_weight_in_a_direction():
    rows = np.array([[0.0, 3e5], [1e6, 1e-4]])
    held = whitening.Spectrum.empty(2)
    for row in rows:
        held.update(row)
    assert np.abs(held.vectors * held.values @ held.vectors.T - rows.T @ rows).max() <= 1e-14 * 1e12


def test_whitening_of_awkward_rows(spark):
    rows = [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (None, [3.0, 1.0], 0), (2, None, 0), (3, [NAN, 1.0], 0), (4, [INF, 1.0], 0),
            (5, [None, 1.0], 0), (6, [], 0), (7, [5.0], 0), (8, [1e300, 0.0], 0)]
    got = whitening.whiten(frame(spark, rows)).toPandas()
    assert sorted(got.vec_id.fillna(-1).tolist()) == sorted([1, 1, -1, 6, 7] * 2)
    x = quantized([[1.0, 2.0], [1.0, 2.0], [3.0, 1.0], [0.0, 0.0], [5.0, 0.0]])
    assert set(got.n) == {5} and got[got.vec_id == 7].deviation.iloc[0] == sum((5 * x[4] - x.sum(axis=0)) ** 2)
    same = whitening.whiten(frame(spark, [(i, [1.0, 2.0, 3.0], 0) for i in range(5)])).toPandas()
    assert same.whitened.isna().all() and set(same.deviation) == {0} and set(same.explained) == {0.0} and set(same.identity_error) == {0.0}
    flat = whitening.whiten(frame(spark, [(i, [float(i), 1.0, 2.0], 0) for i in range(9)])).toPandas()
    assert flat[flat.component == 1].whitened.notna().all() and flat[flat.component > 1].whitened.isna().all()
    assert flat.identity_error.max() < 1e-9
    assert whitening.whiten(frame(spark, rows).limit(0)).collect() == []
    assert whitening.whiten(frame(spark, [(1, [], 0)])).collect() == []


def test_a_deviation_beyond_a_long_is_text(spark):
    rows = [(i, [float(10**12 * i), 1.0], 0) for i in range(40)]
    got = {r["vec_id"]: r for r in whitening.whiten(frame(spark, rows), 1).collect()}
    x = [64 * 10**12 * i for i in range(40)]
    assert got[3]["deviation"] is None and got[3]["deviation_exact"] == str((40 * x[3] - sum(x)) ** 2)


# Codes ------------------------------------------------------------------------------------------------


def brute_codes(vectors, parts, entries, rounds):
    """Codes, errors and codebooks by plain integers; vectors in the order of their ids."""
    points = [[int(np.floor(256 * v)) for v in row] for row in vectors]
    size = len(points[0]) // parts
    cut = lambda row, p: row[p * size : (p + 1) * size]
    books = [[cut(row, p) for row in points[:entries]] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for turn in range(rounds + 1):
        codes = [[min(range(len(books[p])), key=lambda k: (away(cut(row, p), books[p][k]), k)) for p in range(parts)] for row in points]
        if turn < rounds:
            for p in range(parts):
                for k in range(len(books[p])):
                    mine = [cut(row, p) for row, code in zip(points, codes) if code[p] == k]
                    if mine:
                        books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    errors = [sum(away(cut(row, p), books[p][code[p]]) for p in range(parts)) for row, code in zip(points, codes)]
    return codes, errors, books


def text_of(books):
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def test_codes_equal_plain_integers(spark, sf_dir):
    rows = pd.read_parquet(f"{sf_dir}/embeddings.parquet").sort_values("vec_id")
    codes, errors, books = brute_codes(np.stack(rows.embedding).astype(float).tolist(), 16, 64, 2)
    got = queries.op13_vector_codes(spark, sf_dir).toPandas().set_index("vec_id").loc[rows.vec_id]
    assert got.code.tolist() == ["".join(f"{c:02x}" for c in code) for code in codes] and got.error.tolist() == errors
    assert set(got.codebooks_sha256) == {text_of(books)}
    assert got.label_error.tolist() == pd.Series(errors).groupby(rows.label.to_numpy()).transform("sum").tolist()


@pytest.mark.parametrize("scale, rounds, entries", [(1.0, 4, 16), (0.02, 5, 8), (2e5, 3, 8), (1.0, 1, 100)])
def test_bounds_change_no_code(spark, monkeypatch, scale, rounds, entries):
    monkeypatch.setattr(product_codes, "BLOCK_ROWS", 37)
    rng = random.Random(entries)
    # Few different values: ties and equal vectors.
    vectors = [[scale * rng.randrange(-6, 6) * rng.choice([1, 0.25]) for _ in range(6)] for _ in range(150)]
    rows = [(i, v, rng.choice([None, 1, 2])) for i, v in enumerate(vectors)]
    coded, books = product_codes.encode(frame(spark, rows).repartition(5, "vec_id"), 3, entries, rounds)
    got = {r["vec_id"]: r for r in product_codes.with_label_error(coded).collect()}
    codes, errors, expected = brute_codes(vectors, 3, entries, rounds)
    assert [got[i]["codes"] for i in range(150)] == codes and [got[i]["error"] for i in range(150)] == errors
    assert product_codes.digest(books) == text_of(expected)
    labels = [r[2] for r in rows]
    assert [got[i]["label_error"] for i in range(150)] == [sum(e for e, other in zip(errors, labels) if other == mine) for mine in labels]


def test_bounds_are_bounds_and_adapt():
    rng = np.random.default_rng(5)
    points, book = rng.integers(-99, 99, (400, 3)), rng.integers(-99, 99, (32, 3))
    held, sizes = product_codes.measure_all(points, book, 8), []
    for step in (9, 1, 1, 0):
        new = book + rng.integers(-step, step + 1, book.shape)
        moved = np.sqrt(((new - book) ** 2).sum(axis=1)) * (1 + product_codes.MARGIN)
        book = new
        held, depth = product_codes.reassign(points, book, moved, held)
        squares = ((points[:, None] - book) ** 2).sum(axis=2)
        assert (held.near[:, 0] == squares.argmin(axis=1)).all()
        far = np.sqrt(np.take_along_axis(squares, held.near, axis=1))
        assert (held.upper >= far[:, 0] * (1 - 1e-9)).all() and (held.lower <= far[:, 1:] * (1 + 1e-9)).all()
        others = np.sqrt(squares).copy()
        np.put_along_axis(others, held.near, np.inf, axis=1)
        assert (held.outer <= others.min(axis=1) * (1 + 1e-9)).all()
        held = product_codes.resized(held, product_codes.adapted(depth, 32, held.near.shape[1]), points, book)
        sizes.append(held.near.shape[1])
    assert sizes[-1] < sizes[0] and min(sizes) >= 4


def test_codes_of_awkward_rows(spark):
    rows = [(3, [1.0, 2.0, 3.0], 1), (3, [1.0, 2.0, 3.0], 1), (None, [9.0], None), (1, None, 1), (2, [NAN], 1), (4, [None, 1.0], 1), (5, [], None),
            (6, [-INF, 0.0, 0.0], 2)]
    coded, books = product_codes.encode(frame(spark, rows), parts=2, entries=64, rounds=2)
    got = product_codes.with_label_error(coded).collect()
    assert sorted(str(r["vec_id"]) for r in got) == ["3", "3", "5", "None"]
    codes, errors, expected = brute_codes([[1.0, 2.0, 3.0, 0.0]] * 2 + [[0.0] * 4, [9.0, 0, 0, 0]], 2, 64, 2)
    assert sum(r["error"] for r in got) == sum(errors) and product_codes.digest(books) == text_of(expected)
    for rows in ([(1, [1e300, -1e300], 1), (2, [0.0, 1.0], 1)], [(1, [], 1)], []):
        coded, _ = product_codes.encode(frame(spark, rows), parts=2)
        assert product_codes.with_label_error(coded).count() == len(rows)


# Samples ----------------------------------------------------------------------------------------------


def test_a_sample_of_few_keys_is_as_large_as_asked_for(spark):
    df = spark.range(90_000).select((F.col("id") % 2).alias("k"), "id")
    assert bounded_sample(df, "k", rows=20_000).count() == 20_000
    assert bounded_sample(df, "k", "id", rows=20_000).count() == 20_000
