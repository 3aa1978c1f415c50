"""Ten-second event-time counts with allowed lateness, replayed over a recorded arrival order.

The watermark follows the largest event time seen so far, less the out-of-order bound, record by record.
A record is judged by the watermark before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Fixed values, in milliseconds.
WINDOW_MS = 10_000
LATENESS_MS = 5_000
OUT_OF_ORDER_MS = 2_000
# A source without a record for so long, by the arrival of others, holds nobody up.
IDLE_MS = 2_000
# Arrivals are cut into runs of this many positions; a run is sorted by one task.
RUN_LENGTH = 1 << 20
# Records that say when they arrived are cut by it instead: a task sorts the arrivals of so many milliseconds.
SLICE_MS = 1_000


def window_start_ms(ms: Column, size_ms: int = WINDOW_MS) -> Column:
    return ms - F.pmod(ms, F.lit(size_ms))


def millis_to_ntz(ms: Column) -> Column:
    """Timestamp without zone of epoch milliseconds, under the UTC session zone."""
    return F.timestamp_millis(ms).cast("timestamp_ntz")


def arrival_watermark(
    events: DataFrame,
    arrival: str = "seq",
    ms: str = "ms",
    bound_ms: int = OUT_OF_ORDER_MS,
    run_length: int = RUN_LENGTH,
    source: str | None = None,
    peaks: DataFrame | None = None,
) -> DataFrame:
    """Events with ``watermark_ms`` as it stood before each of them; NULL on the first.

    ``arrival`` is a unique integer position. A running maximum over the whole stream would be one task, so
    it is taken within runs of positions, and the maxima of the earlier runs, one row per run, are added.

    With ``source`` every source has positions and a watermark of its own, and ``peaks`` (source, peak_ms) may
    say what its largest event time was before these events.
    """
    by = [source] if source else []
    runs = events.withColumn("_run", F.col(arrival) - F.pmod(F.col(arrival), F.lit(run_length)))
    inside = Window.partitionBy(*by, "_run").orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*by).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    per_run = (
        runs.groupBy(*by, "_run").agg(F.max(ms).alias("_peak")).select(*by, "_run", F.max("_peak").over(earlier).alias("_before"))
    )
    if peaks is not None:
        per_run = per_run.join(peaks.select(*by, F.col("peak_ms").alias("_seed")), by, "left").withColumn(
            "_before", F.greatest("_before", "_seed")
        )
    return (
        runs.withColumn("_inside", F.max(ms).over(inside))
        .join(per_run.select(*by, "_run", "_before"), [*by, "_run"])
        # greatest skips NULLs: no earlier run, or first of its run.
        .withColumn("watermark_ms", F.greatest("_inside", "_before") - F.lit(bound_ms))
        .drop("_run", "_inside", "_before")
    )


def merged_watermark(
    records: DataFrame,
    sources: dict[str, tuple[int, int | None]],
    mark: int | None = None,
    bound_ms: int = OUT_OF_ORDER_MS,
    idle_ms: int = IDLE_MS,
    slice_ms: int = SLICE_MS,
    run_length: int = RUN_LENGTH,
) -> DataFrame:
    """Records with ``watermark_ms`` as it stood before each: that of the slowest source, never falling.

    ``records`` has ms, source, offset and arrival_ms, which may be NULL; they count in the order of arrival, then
    source, then offset. A source's own mark is its largest event time less the bound; a source whose last record
    arrived more than ``idle_ms`` before this one is left out, and so is one without any record yet. ``sources``
    names all sources of these records and earlier ones, with the largest event time and last arrival before
    these records, if any; ``mark`` is the largest mark so far. There are as many sources as partitions of a topic.

    Nothing is sorted whole: per slice of arrivals one row with the peaks of all sources is carried forward.
    """
    names = sorted(sources)
    arrival = F.col("arrival_ms")
    untimed = arrival.isNull()
    cut = {
        "_slice": F.coalesce(F.floor(arrival / slice_ms), F.lit(-(1 << 62))),
        "_of": F.when(untimed, F.col("source")).otherwise(""),
        "_run": F.when(untimed, F.floor(F.col("offset") / run_length)).otherwise(0),
    }
    placed = records.withColumns(cut)
    slices = list(cut)
    order = [F.col("arrival_ms"), F.col("source"), F.col("offset")]
    inside = Window.partitionBy(*slices).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice, whatever it holds.
    earlier = Window.partitionBy(F.lit(0)).orderBy(*slices).rowsBetween(Window.unboundedPreceding, -1)

    def of(i: int, name: str) -> Column:
        return F.when(F.col("source") == names[i], F.col(name))

    numbers = range(len(names))
    gathered = {f"_{kind}{i}": F.max(of(i, column)) for i in numbers for kind, column in (("peak", "ms"), ("seen", "arrival_ms"))}

    def known(name: str, i: int, window: Window) -> Column:
        given = sources[names[i]][0 if name == "_peak" else 1]
        return F.greatest(F.max(f"{name}{i}").over(window), F.lit(given).cast("long")).alias(f"{name}{i}_before")

    per_slice = placed.groupBy(*slices).agg(*[c.alias(n) for n, c in gathered.items()])
    per_slice = per_slice.select(*slices, *[known(n, i, earlier) for i in numbers for n in ("_peak", "_seen")])
    peaks = {f"_peak{i}": F.max(of(i, "ms")).over(inside) for i in numbers}
    seens = {f"_seen{i}": F.max(of(i, "arrival_ms")).over(inside) for i in numbers}
    joined = placed.withColumns({**peaks, **seens}).join(per_slice, slices)

    def active(i: int) -> Column:
        peak, seen = (F.greatest(f"{n}{i}", f"{n}{i}_before") for n in ("_peak", "_seen"))
        idle = F.coalesce(arrival - seen > idle_ms, F.lit(False))
        return F.when(~idle, peak)

    actives = [active(i) for i in numbers]
    slowest = F.least(*actives) if len(actives) > 1 else actives[0]
    held = joined.withColumn("_mark", slowest - F.lit(bound_ms)).select(*records.columns, *slices, "_mark")
    # A source that wakes up does not take the mark back.
    risen = held.groupBy(*slices).agg(F.max("_mark").alias("_top"))
    risen = risen.select(*slices, F.greatest(F.max("_top").over(earlier), F.lit(mark).cast("long")).alias("_before"))
    so_far = Window.partitionBy(*slices).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    result = held.withColumn("_top", F.max("_mark").over(so_far)).join(risen, slices)
    return result.select(*records.columns, F.greatest("_top", "_before").alias("watermark_ms"))


def judge(
    events: DataFrame, ms: str = "ms", size_ms: int = WINDOW_MS, lateness_ms: int = LATENESS_MS
) -> DataFrame:
    """Adds ``start_ms``, ``fired`` (its window had a result before it came) and ``late`` (not counted)."""
    start = window_start_ms(F.col(ms), size_ms)
    last_instant = F.col("start_ms") + F.lit(size_ms - 1)
    mark = F.col("watermark_ms")
    return (
        events.withColumn("start_ms", start)
        .withColumn("late", F.coalesce(mark >= last_instant + F.lit(lateness_ms), F.lit(False)))
        .withColumn("fired", F.coalesce(mark >= last_instant, F.lit(False)))
    )


def tumbling_counts(judged: DataFrame, size_ms: int = WINDOW_MS) -> DataFrame:
    """Final count per type and window. Partial counts come first, so five types do not mean five tasks."""
    return (
        judged.where(~F.col("late"))
        .groupBy("event_type", "start_ms")
        .agg(F.count("*").alias("n"))
        .select(
            "event_type",
            millis_to_ntz(F.col("start_ms")).alias("window_start"),
            millis_to_ntz(F.col("start_ms") + F.lit(size_ms)).alias("window_end"),
            "n",
        )
    )


def late_events(judged: DataFrame) -> DataFrame:
    """The side output: every event too late for its window, whole."""
    return judged.where("late")


def window_firings(judged: DataFrame) -> DataFrame:
    """How often each window produced a result: once when it closes, again for each late-but-allowed event."""
    refires = F.sum(F.col("fired").cast("long"))
    on_time = F.max((~F.col("fired")).cast("long"))
    return (
        judged.where(~F.col("late"))
        .groupBy("event_type", "start_ms")
        .agg((refires + on_time).alias("firings"), F.count("*").alias("final_n"))
        .select("event_type", millis_to_ntz(F.col("start_ms")).alias("window_start"), "firings", "final_n")
    )


def count_lines(counts: DataFrame) -> DataFrame:
    """The console line of each result, window bounds in epoch seconds."""

    def seconds(name: str) -> Column:
        return F.unix_seconds(F.col(name).cast("timestamp"))

    return counts.select(
        F.format_string(
            "%s count=%d window=[%ds..%ds)", "event_type", "n", seconds("window_start"), seconds("window_end")
        ).alias("line")
    )
