"""The induced sort against sorted(), and the removal of repeats against a table of all windows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.llm import induced_sort, queries, suffix_dedup
from tidemark.llm.common import prepare


def brute_order(symbols, cap):
    order = sorted(range(len(symbols)), key=lambda i: symbols[i:])
    shares = [0]
    for a, b in zip(order, order[1:]):
        same = 0
        while same < cap and max(a, b) + same < len(symbols) and symbols[a + same] == symbols[b + same]:
            same += 1
        shares.append(same)
    return order, shares


def sort(symbols, cap, folder):
    text = np.array([*symbols, 0, 0], np.uint16)
    order, shares = induced_sort.suffix_array(induced_sort.Scratch(str(folder)), text, len(symbols), 300, cap)
    return order.tolist(), shares.tolist()


TEXTS = st.one_of(
    st.lists(st.integers(1, 2), max_size=90),
    st.lists(st.integers(1, 300), max_size=60),
    st.builds(lambda part, n, tail: part * n + tail, st.lists(st.integers(1, 3), max_size=12), st.integers(1, 9), st.lists(st.integers(1, 3), max_size=5)),
    st.integers(0, 120).map(lambda n: [5] * n),
)


# In files from the first array on, in blocks and intervals of a few suffixes; and all at once.
@pytest.mark.parametrize("small", [True, False])
def test_suffixes_and_common_prefixes(tmp_path, monkeypatch, small):
    if small:
        for name, value in {"BATCH": 5, "BLOCK": 7, "QUEUED": 9, "IN_MEMORY": 16}.items():
            monkeypatch.setattr(induced_sort, name, value)

    @given(TEXTS, st.sampled_from([2, 3, 10, 400]))
    @settings(max_examples=250, deadline=None)
    def check(symbols, cap):
        assert sort([*symbols, 0], cap, tmp_path) == brute_order([*symbols, 0], cap)

    check()
    assert not list(tmp_path.iterdir())


def test_smallest_values_of_ranges(tmp_path):
    rng = np.random.default_rng(2)
    values = rng.integers(0, 400, 3_000).astype(np.uint16)
    table = induced_sort.RangeMin(induced_sort.Scratch(str(tmp_path)), len(values))
    for part in np.split(values, [1, 20, 21, 700, 1_500]):
        table.append(part)
    low = rng.integers(0, 3_000, 5_000)
    high = np.minimum(low + rng.integers(0, 3_000, 5_000) // rng.integers(1, 900, 5_000), 2_999)
    assert table.query(low, high).tolist() == [values[a : b + 1].min() for a, b in zip(low, high)]


def brute(texts, window):
    where, out = {}, []
    for d, text in enumerate(texts):
        for i in range(len(text) - window + 1):
            where.setdefault(text[i : i + window], []).append((d, i))
    gone = [np.zeros(len(t), bool) for t in texts]
    for places in where.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i : i + window] = True
    for text, mask in zip(texts, gone):
        kept = bytes(np.frombuffer(text, np.uint8)[~mask])
        out.append((len(text), int(mask.sum()), int((np.diff(mask.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def digest(r):
    return r["n_bytes"], r["n_removed"], len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()


def test_repeats_of_the_whole_table(spark, sf_dir):
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet")
    got = queries.op12_suffix_dedup(spark, sf_dir).toPandas().set_index("doc_id").loc[docs.doc_id]
    want = brute([t.encode() for t in docs.text], 400)
    assert list(zip(got.n_bytes, got.n_removed, got.n_spans, got.kept_sha256)) == want
    assert sum(w[1] for w in want) > 0


def corpus(seed):
    rnd = random.Random(seed)
    texts = [bytes(rnd.choices(b"ab", k=rnd.randint(0, 80))) for _ in range(60)]
    # A passage in most texts, at their ends, beginnings and between other things; copies; runs of one byte.
    common = b"xyzzyplughplover"
    texts += [rnd.choice(texts) + common + rnd.choice(texts) for _ in range(60)]
    return texts + texts[:20] + [common, common * 3, b"a" * 50, b"a" * 70, b"", b"ab" * 40]


# Crowds that are never cut, always cut down to single windows, and in between; one shard and many.
@pytest.mark.parametrize("crowded, shard_bytes", [(50_000, 1 << 22), (0, 1 << 22), (3, 200)])
@pytest.mark.parametrize("window", [2, 16])
def test_repeats_however_anchors_are_crowded(spark, crowded, shard_bytes, window):
    prepare(spark)
    texts = corpus(window)
    docs = spark.createDataFrame([(i, bytearray(t)) for i, t in enumerate(texts)], "doc_id long, text binary")
    got = {r["doc_id"]: digest(r) for r in suffix_dedup.remove_repeats(docs, window, crowded=crowded, shard_bytes=shard_bytes).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, window)


def test_long_texts_are_cut_in_blocks(spark, monkeypatch):
    rnd = random.Random(4)
    text = bytes(rnd.choices(b"abcd", k=3_000))
    text += text[500:900]
    whole = [p for part in suffix_dedup.Cutter(40).pieces(text) for p in zip(*part)]
    monkeypatch.setattr(suffix_dedup, "TEXT_BLOCK", 101)
    cut = [p for part in suffix_dedup.Cutter(40).pieces(text) for p in zip(*part)]
    starts = lambda found: {s + i: (s + o, key) for s, n, o, key in found for i in range(n)}
    assert starts(whole) == starts(cut) and set(starts(whole)) == set(range(len(text) - 39))
    # Equal windows have equal anchors at equal places.
    assert {(a - i, k) for i, (a, k) in starts(whole).items() if 500 <= i <= 860} == {(a - i, k) for i, (a, k) in starts(whole).items() if i >= 3_000}


def test_awkward_rows(spark):
    prepare(spark)
    passage = "a passage of some length that stands in two documents, and not by chance alone"
    rows = [(1, f"one {passage} here"), (2, f"{passage}!"), (None, "no id, nothing repeated in it at all, that is what it is"), (3, None), (4, ""),
            (5, "short"), (5, "short"), (6, "the same row twice, which is a repeat of itself"), (6, "the same row twice, which is a repeat of itself"),
            (7, "\u00e9" * 300), (8, "w" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({c: F.lit("x") for c in ("row", "key", "piece", "n_bytes", "spans", "kept", "start", "_word")})
    got = suffix_dedup.remove_repeats(docs, 30).collect()
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1]))
    want = [(i, w) for (i, _), w in zip(rows, brute([(t or "").encode() for _, t in rows], 30))]
    assert sorted([(r["doc_id"], digest(r)) for r in got], key=key) == sorted(want, key=key)
    assert suffix_dedup.remove_repeats(docs.limit(0), 30).collect() == []
