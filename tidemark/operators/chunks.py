"""Windows over a key's whole history, cut into chunks of time so that no task holds a whole key.

A window sorts its group in one task, and a key may own a third of a table. Rows are therefore placed by key and
chunk; what a chunk hands on to the later ones of its key is one small row, and a window over these rows alone
carries it forward. What arrives in a chunk is a first row beside its own, so nothing is joined. Both steps read the
same exchange, so the input is computed once. All keys go this way: there is no list of large ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

# Long enough that an ordinary key has few chunks, short enough that a day of a key with a third of a table that spans
# years is no more than a core's share of the whole.
CHUNK_SECONDS = 86_400
# Where rows go: key text, whether there is none (its rows are a group), chunk number.
KEY, NO_KEY, CHUNK = "_key", "_no_key", "_chunk"
PLACE = (KEY, NO_KEY, CHUNK)


def chunk(at: Column, seconds: int = CHUNK_SECONDS) -> Column:
    """Number of the chunk of a timestamp, zoned or not; only its order and equality matter."""
    return F.floor(F.unix_seconds(at.cast("timestamp")) / F.lit(seconds))


def key_columns(key: str) -> dict[str, Column]:
    return {KEY: F.coalesce(F.col(key), F.lit("")), NO_KEY: F.col(key).isNull()}


def given_key(name: str) -> Column:
    """The key as it came."""
    return F.when(~F.col(NO_KEY), F.col(KEY)).alias(name)


def within(*order: str | Column) -> Window:
    return Window.partitionBy(*PLACE).orderBy(*order)


def carried(placed: DataFrame, per_chunk: dict[str, Column], carry: Callable[[str, Window], Column], asked: Column) -> DataFrame:
    """What reaches each chunk from the earlier ones of its key, under the names of ``per_chunk``: a row to be added to
    the chunk's own, where it must sort first.

    ``per_chunk`` sums a chunk up, ``carry`` makes the carried value of a column over a frame of earlier chunks.
    Only chunks with a row that is ``asked`` for get one: nobody reads the others. ``asked`` must need what the windows
    over the chunks carry; then both steps need the same columns, and Spark reuses one exchange.
    """
    earlier = Window.partitionBy(KEY, NO_KEY).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(*PLACE).agg(*[c.alias(n) for n, c in per_chunk.items()], F.count_if(asked).alias("_asked"))
    values = [carry(n, earlier).alias(n) for n in per_chunk]
    rows = sums.select(*PLACE, *values, "_asked").where(F.col("_asked") > 0).drop("_asked")
    return rows.repartition(*PLACE)
