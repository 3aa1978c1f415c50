"""Language-model scoring: the likelihood of a text over all its segmentations into subword pieces.

A text is its words (runs of anything but space and 0x09-0x0D, A-Z lower-cased) and one end. The pieces of an
existing vocabulary are arcs over a word; a word's probability is the sum over all paths, by a forward
recursion in log space, and as every piece begins or lies inside a word, a text's is the product over its
words. The vocabulary's scores weigh the arcs: log probabilities as they are, and the ranks of a merge
vocabulary by Zipf's law. If asked, ``rounds`` of expected counts over the training words move the weights, the
scores being the prior; the vocabulary stays as it is. A word seen in training is one more arc, weighted by its
count after Witten and Bell, so P(word) = (c + V * lattice) / (N + V).

Everything from the corpus is counted over all training rows. Counting keeps a bounded table per task and adds
up partial counts by word. For scoring, the ``FREQUENT`` most frequent words, a table of proven size, go to
every task; all other words of a document are joined with the counts by word and added up by row.

Rows: a NULL text has the end alone, as has an empty one. A row with a NULL doc_id is told from others by its
text and counts as the empty id for the split. Repeated rows are scored each. Without training rows every count
is zero. Other columns of the input are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import written

SIGN = "▁"
# Words of a task counted before their counts are handed on.
COUNTED_AT_ONCE = 400_000
# Words whose counts and probabilities every task holds: some 20 MB.
FREQUENT = 1 << 17
FOLDS, HELD_OUT = 7, 2
LOG10 = math.log(10)


class Lattice:
    """The arcs of a vocabulary and their log probabilities."""

    def __init__(self, weights: dict[str, float], byte_weights: list[float], longest: int):
        self.weights = weights
        self.byte_weights = byte_weights
        self.longest = longest
        self.prefixes = {p[:n] for p in weights for n in range(1, len(p) + 1)}

    def arcs(self, word: str) -> list[list[tuple[int, str, float]]]:
        """For each end the arcs (start, piece, log probability) into it; NULL piece: the bytes of a character."""
        text, weights, prefixes = SIGN + word, self.weights, self.prefixes
        into: list[list[tuple[int, str, float]]] = [[] for _ in range(len(text) + 1)]
        for start, char in enumerate(text):
            if char not in weights:
                cost = sum(self.byte_weights[b] for b in char.encode("utf-8", "replace"))
                into[start + 1].append((start, None, cost))
            for end in range(start + 1, min(len(text), start + self.longest) + 1):
                piece = text[start:end]
                if piece not in prefixes:
                    break
                if piece in weights:
                    into[end].append((start, piece, weights[piece]))
        return into

    @staticmethod
    def total(logs: list[float]) -> float:
        """Logarithm of the sum of what the logarithms stand for."""
        if len(logs) == 1:
            return logs[0]
        top = max(logs, default=-math.inf)
        return top + math.log(sum(math.exp(x - top) for x in logs)) if top > -math.inf else top

    def forward(self, into: list[list[tuple[int, str, float]]]) -> list[float]:
        """Log probability of reaching every place by any path."""
        reached = [0.0]
        for arcs in into[1:]:
            reached.append(self.total([reached[start] + weight for start, _, weight in arcs]))
        return reached

    def log_probability(self, word: str) -> float:
        """Log probability of a word over all paths; holds as many places as the longest piece, however long the word."""
        text, weights, prefixes = SIGN + word, self.weights, self.prefixes
        places = self.longest + 1
        into: list[list[float]] = [[] for _ in range(places)]
        into[0].append(0.0)
        for start, char in enumerate(text):
            here, into[start % places] = self.total(into[start % places]), []
            if char not in weights:
                cost = sum(self.byte_weights[b] for b in char.encode("utf-8", "replace"))
                into[(start + 1) % places].append(here + cost)
            for end in range(start + 1, min(len(text), start + self.longest) + 1):
                piece = text[start:end]
                if piece not in prefixes:
                    break
                if piece in weights:
                    into[end % places].append(here + weights[piece])
        return self.total(into[len(text) % places])

    def expected(self, word: str, times: float, into_counts: dict[str, float]) -> None:
        """Add the expected uses of every piece over all paths of a word."""
        into = self.arcs(word)
        reached = self.forward(into)
        left = [-math.inf] * len(into)
        left[-1] = 0.0
        for end in range(len(into) - 1, 0, -1):
            for start, piece, weight in into[end]:
                log = left[end] + weight
                if left[start] == -math.inf:
                    left[start] = log
                elif log > -math.inf:
                    high, low = (log, left[start]) if log > left[start] else (left[start], log)
                    left[start] = high + math.log1p(math.exp(low - high))
                if piece is not None:
                    into_counts[piece] += times * math.exp(reached[start] + log - reached[-1])


def vocabulary_weights(model_path: str) -> tuple[dict[str, float], list[float], float, int]:
    """Log probabilities of the pieces, of the 256 bytes and of the end, and the longest piece's length."""
    from sentencepiece import sentencepiece_model_pb2 as messages

    model = messages.ModelProto()
    with open(model_path, "rb") as file:
        model.ParseFromString(file.read())
    usable = [p for p in model.pieces if p.type == 1 and p.score > -1e8 and SIGN not in p.piece[1:]]
    if model.trainer_spec.model_type == 1:
        raw = {p.piece: p.score for p in usable}
    else:
        ordered = sorted(usable, key=lambda p: -p.score)
        raw = {p.piece: -math.log(rank + 2.7) for rank, p in enumerate(ordered)}
    least = min(raw.values())
    total = math.log(sum(map(math.exp, raw.values())) + 257 * math.exp(least))
    weights = {piece: log - total for piece, log in raw.items()}
    return weights, [least - total] * 256, least - total, max(map(len, weights))


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def count_words(texts: DataFrame) -> DataFrame:
    """(word, c): how often each word occurs in a frame whose one column holds UTF-8 bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush():
            words = pa.array(list(counts), pa.binary()).cast(pa.string())
            out = pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                counts.update((text.as_py() or b"").lower().split())
                if len(counts) >= COUNTED_AT_ONCE:
                    yield flush()
        yield flush()

    return texts.mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("c"))


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words of the highest counts, ``most`` of them or fewer: as many whole steps of the count as fit.

    A step is an eighth of a power of two, so some five hundred numbers say where to stop.
    """
    step = F.floor(F.log2("c") * 8).cast("int")
    sizes = sorted(counts.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"])
    lowest, taken = 1 << 30, 0
    for r in sizes:
        taken += r["count"]
        if taken > most:
            break
        lowest = r["step"]
    return counts.where(step >= lowest)


def reweighted(counts: DataFrame, weights: dict, byte_weights: list, longest: int, prior: float) -> dict[str, float]:
    """One round of expected counts over all training words; the result is as large as the vocabulary."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, sums = Lattice(weights, byte_weights, longest), Counter()
        for batch in batches:
            for word, times in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lattice.expected(word, times, sums)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.float64())], ["piece", "n"])

    uses = counts.select("word", "c").mapInArrow(work, "piece string, n double").groupBy("piece").agg(F.sum("n").alias("n"))
    found = {r["piece"]: r["n"] for r in uses.collect()}
    used = math.fsum(found.values())
    return {p: math.log((found.get(p, 0.0) + prior * math.exp(w)) / (used + prior)) for p, w in weights.items()}


def mixed(lattice_log: float, c: int, smooth: int) -> float:
    """log10 of c + smooth * lattice, without leaving logarithms: a long word's probability is no float."""
    drawn = math.log(smooth) + lattice_log
    if not c:
        return drawn / LOG10
    seen = math.log(c)
    return (max(seen, drawn) + math.log1p(math.exp(-abs(seen - drawn)))) / LOG10


def score_documents(
    docs: DataFrame,
    model_path: str,
    rounds: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequent: int = FREQUENT,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row."""
    read = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), is_held_out(F.col(id_col)).alias("held_out"),
        F.col(text_col).cast("binary").alias("text"),
    )
    training = read.where("NOT held_out")
    counts = written(count_words(training.select("text")), "words")
    ends = training.count()
    words, tokens = counts.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    total, kinds = tokens + ends, words + bool(ends)
    weights, byte_weights, end_weight, longest = vocabulary_weights(model_path)
    for _ in range(rounds):
        # As many uses as the vocabulary has pieces: enough for pieces never used, little beside a corpus.
        weights = reweighted(counts, weights, byte_weights, longest, prior=len(weights))
    smooth = max(kinds, 1)
    base_below, below = math.log10(total + kinds + 1), math.log10(total + smooth)

    base_end, score_end = math.log10(ends + 1), mixed(end_weight, ends, smooth)

    def with_logs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words with their counts and the logarithm that the model scores them by."""
        lattice = Lattice(weights, byte_weights, longest)
        for batch in batches:
            found, cs = batch.column(0), batch.column(1).to_pylist()
            logs = [mixed(lattice.log_probability(w), c, smooth) for w, c in zip(found.to_pylist(), cs)]
            yield pa.RecordBatch.from_arrays([found, pa.array(cs, pa.int64()), pa.array(logs, pa.float64())], ["word", "c", "log"])

    scored_schema = "word string, c long, log double"
    frequent_words = most_frequent(counts, frequent).mapInArrow(with_logs, scored_schema).collect()
    top = {r["word"].encode(): (r["c"], math.log10(r["c"] + 1), r["log"]) for r in frequent_words}

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums over the frequent words of each row; its other words follow as rows of their own."""
        for batch in batches:
            out = []
            for row, doc, held, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                found = Counter((text or b"").lower().split())
                n, n_known, base, score = 1, int(ends > 0), base_end, score_end
                for word, times in found.items():
                    n += times
                    logs = top.get(word)
                    if logs is None:
                        out.append((row, None, None, 0, 0, 0.0, 0.0, word, times))
                        continue
                    n_known += times
                    base += times * logs[1]
                    score += times * logs[2]
                out.append((row, doc, held, n, n_known, base, score, None, 0))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 9, KINDS)], NAMES)

    numbered = read.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    parts = written(numbered.mapInArrow(first, SCHEMA), "parts")
    of_rows = parts.where("word IS NULL")
    others = parts.where("word IS NOT NULL").select("row", F.col("word").cast("string").alias("word"), "times")
    scored = others.select("word").distinct().join(counts, "word", "left")
    scored = scored.select("word", F.coalesce("c", F.lit(0).cast("long")).alias("c"))
    scored = scored.mapInArrow(with_logs, scored_schema)
    sums = others.join(scored, "word").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("base"),
        F.sum(F.col("times") * F.col("log")).alias("score"),
    )
    whole = of_rows.join(sums.select("row", *[F.col(c).alias(f"{c}_rare") for c in ("n_known", "base", "score")]), "row", "left")

    def both(name: str) -> Column:
        return F.col(name) + F.coalesce(f"{name}_rare", F.lit(0))

    return whole.select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"), both("n_known").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (both("base") - F.col("n") * F.lit(base_below)).alias("base_score"),
        (both("score") - F.col("n") * F.lit(below)).alias("score"),
    )


NAMES = ["row", "doc_id", "held_out", "n", "n_known", "base", "score", "word", "times"]
KINDS = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.int64()]
SCHEMA = "row long, doc_id long, held_out boolean, n long, n_known long, base double, score double, word binary, times long"
