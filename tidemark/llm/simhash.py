"""SimHash near-duplicate detection with pigeonring filtering.

A text becomes words (runs of anything but space and 0x09-0x0D, A-Z lower-cased), the words become shingles,
and the fingerprint has a bit where more than half of the shingle hashes have it. Fingerprints within
``max_distance`` bits are linked; a component is what links reach.

Candidates come from the pigeonring principle. Cut 64 bits into ``segments`` arranged in a ring: if the whole
distance is at most t, some segment starts a chain whose first l segments differ in at most l * t / segments
bits, for every l at once. The first lengths allow no difference at all, so those segments together are the
join key; the longer ones prune what the key brings together, and length ``segments`` is the full check.

A key that more than ``bucket_rows`` different fingerprints share would mean all pairs of a group. Those
fingerprints take an exact linear way instead: each visits the 65 values within one bit of it, and two
fingerprints meet at some value exactly if they differ in two bits or fewer.

Rows: NULL text is an empty one; no words give fingerprint zero, linked like any other. Repeated texts share a
fingerprint and are grouped before anything is compared. Rows that share a doc_id are one document. A NULL
doc_id gets a fingerprint and the component of that fingerprint's other rows, NULL if there are none; such rows
link nothing. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import id_and_bytes, written
from tidemark.llm.components import components

BITS = 64
HASH_SEED = 42
# Different fingerprints under one key that are still compared pair by pair.
BUCKET_ROWS = 128
# Shingle hashes whose bits are counted at once.
HASHES_AT_ONCE = 1 << 15


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Majority bits over the XXH64 hashes of all word shingles, repeats included; 0 without words."""
    import xxhash

    words = (text or b"").lower().split()  # on bytes: A-Z only, and exactly 0x09-0x0D and space
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return digest(b" ".join(words), HASH_SEED)
    hashes = [digest(b" ".join(s), HASH_SEED) for s in zip(*(words[i:] for i in range(shingle)))]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        part = np.array(hashes[at : at + HASHES_AT_ONCE], dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a signed long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return id_and_bytes(docs, id_col, text_col).mapInArrow(work, "doc_id long, fp long")


def free_chain(segments: int, max_distance: int) -> int:
    """How many segments of a chain may not differ at all."""
    return max(n for n in range(1, segments + 1) if n * max_distance // segments == 0)


def _rotated(fp: Column, bits: int) -> Column:
    if not bits:
        return fp
    return F.shiftleft(fp, bits).bitwiseOR(F.shiftrightunsigned(fp, BITS - bits))


def _top(value: Column, bits: int) -> Column:
    return F.shiftrightunsigned(value, BITS - bits) if bits < BITS else value


def keyed(classes: DataFrame, segments: int, max_distance: int) -> DataFrame:
    """One row per fingerprint and place on the ring: the place, the key there, and the ring turned to it."""
    width = BITS // segments
    key_bits = width * free_chain(segments, max_distance)
    turns = F.array(*[
        F.struct(F.lit(i).alias("place"), _top(_rotated(F.col("fp"), i * width), key_bits).alias("key"),
                 _rotated(F.col("fp"), i * width).alias("ring"))
        for i in range(segments)
    ])
    return classes.select("fp", "node", F.inline(turns))


def chain_holds(difference: Column, segments: int, max_distance: int) -> Column:
    """Every prefix of the chain keeps to its share of the distance; the last prefix is the whole ring."""
    width = BITS // segments
    first = free_chain(segments, max_distance) + 1
    within = F.lit(True)
    for n in range(first, segments + 1):
        within = within & (F.bit_count(_top(difference, n * width)) <= n * max_distance // segments)
    return within


def ring_links(classes: DataFrame, segments: int, max_distance: int, bucket_rows: int) -> DataFrame:
    """Links (a, b) between nodes of different fingerprints, enough to reach all that is within the distance."""
    places = written(keyed(classes, segments, max_distance), "ring")
    crowded = places.groupBy("place", "key").count().where(F.col("count") > bucket_rows).select("place", "key")
    sparse = places.join(crowded, ["place", "key"], "left_anti")
    left = sparse.select("place", "key", F.col("node").alias("a"), F.col("ring").alias("ring_a"))
    right = sparse.select("place", "key", F.col("node").alias("b"), F.col("ring").alias("ring_b"))
    near = chain_holds(F.col("ring_a").bitwiseXOR(F.col("ring_b")), segments, max_distance)
    pairs = left.join(right, ["place", "key"]).where((F.col("a") < F.col("b")) & near).select("a", "b")
    visits = [F.lit(0)] + [F.lit(1 << b if b < 63 else -(1 << 63)) for b in range(BITS)]
    visited = F.explode(F.array(*[F.col("fp").bitwiseXOR(v.cast("long")) for v in visits]))
    dense = places.join(crowded, ["place", "key"], "left_semi").select("fp", "node").distinct()
    # At most 65 fingerprints lie within one bit of a value, so these groups are small by construction.
    meeting = dense.select("node", visited.alias("value")).groupBy("value").agg(F.collect_list("node").alias("nodes"))
    stars = meeting.where(F.size("nodes") > 1).select(F.array_min("nodes").alias("a"), F.explode("nodes").alias("b"))
    return pairs.unionByName(stars.where("a < b").distinct())


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    max_distance: int = 2,
    segments: int = 8,
    bucket_rows: int = BUCKET_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, fp, component_id) for every row; ``max_distance`` is 0 or 2."""
    if max_distance not in (0, 2) or BITS % segments:
        raise ValueError("max_distance must be 0 or 2, and segments must divide 64")
    rows = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    classes = rows.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node"))
    if max_distance:
        classes = written(classes, "classes")
        # Rows of one doc_id are one document, whatever their texts: their fingerprints belong together.
        ids = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
        several = ids.where("low <> high").select("doc_id")
        same_id = rows.join(several, "doc_id", "left_semi").join(classes, "fp")
        same_id = same_id.select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
        links = ring_links(classes, segments, max_distance, bucket_rows).unionByName(same_id)
        classes = classes.join(components(links), "node", "left").select(
            "fp", F.coalesce("component", "node").alias("component_id")
        )
    else:
        classes = classes.withColumnRenamed("node", "component_id")
    return rows.join(classes, "fp", "left").select("doc_id", "fp", "component_id")


def one_of_each(rows: DataFrame, row: str, grouped: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay: of each component one, that with the smallest id; one without an id if none has any.

    ``rows`` has a key column ``row``, and ``grouped`` is what ``near_duplicates`` gives under those keys.
    """
    named = rows.select(F.col(row).alias("key"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"))
    members = grouped.select(F.col("doc_id").alias("key"), "component_id").join(named, "key")
    first = F.min(F.struct(F.col("id").isNull(), "id", "hash", "key"))["key"]
    stays = members.groupBy("component_id").agg(first.alias(row)).select(row)
    return rows.join(stays, row, "left_semi").drop(row)
