"""Averages that run over a whole series, without a window limit.

The state after a row depends on every row before it, but a series may be too long for one task. The ordered rows are
cut into chunks. Where a chunk continues a series, the state it starts from is first guessed by running over the rows
just before it; old values fade, so the guess is mostly exact, to the bit. Chunks whose guess is not where the chunk
before ended are run again from there, all at once. A state that never forgets can still disagree after that; then the
rest of its series is read through in order by one task, in batches. So there are two rounds at most, and the result is
that of one pass over the series, whatever the chunk size.

Within a task the pieces of many chunks, under all settings, advance side by side: one array operation per step takes
every piece a reading further (`advance`).
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.operators.ordering import Ordered, balanced_rows, order_rows, with_chunks
from gaugeline.operators.scoring import DEFAULT_ORDER, SERIES, series_starts
from gaugeline.session import materialise

# The readings before anything is flagged, and the defaults of the parameters.
WARMUP_READINGS = 10
DEFAULT_ALPHA = 0.1
DEFAULT_MULTIPLIER = 3.0
DEFAULT_MIN_DEVIATION = 10.0
DEFAULT_DAMPING = 0.1
SPAN_FACTOR = 3.0

# Rows run before a continuing chunk to guess its state, and rows of the chunks that one task advances side by side.
GUESS_ROWS = 512
TASK_ROWS = 200_000


@dataclass(frozen=True)
class Settings:
    alpha: float = DEFAULT_ALPHA
    multiplier: float = DEFAULT_MULTIPLIER
    min_deviation: float = DEFAULT_MIN_DEVIATION
    damping: float = DEFAULT_DAMPING


class States:
    """Readings so far (counted up to the end of the warm-up), averages and variances: a row per piece, a column per setting."""

    def __init__(self, readings: np.ndarray, average: np.ndarray, variance: np.ndarray):
        self.readings, self.average, self.variance = readings, average, variance

    @classmethod
    def fresh(cls, pieces: int, settings: int) -> States:
        return cls(np.zeros((pieces, settings), np.int32), np.zeros((pieces, settings)), np.zeros((pieces, settings)))

    def at(self, rows) -> States:
        return States(self.readings[rows], self.average[rows], self.variance[rows])

    def put(self, rows, other: States) -> None:
        self.readings[rows], self.average[rows], self.variance[rows] = other.readings, other.average, other.variance


class Traces:
    """What `advance` notes for each reading: a row per reading, a column per setting; of `flags` alone, an eighteenth."""

    def __init__(self, readings: int, settings: int, flags: bool = False):
        self.flagged = np.zeros((readings, settings), bool)
        self.average = self.threshold = self.warm = None
        if not flags:
            self.average = np.empty((readings, settings))
            self.threshold = np.full((readings, settings), np.nan)
            self.warm = np.zeros((readings, settings), bool)


def advance(values: np.ndarray, begin: np.ndarray, end: np.ndarray, states: States, settings: list[Settings],
            traces: Traces | None = None) -> States:
    """The states after each piece `values[begin:end]`, from the states before; all pieces take a step at a time.

    Pieces go in order of length, so that those still running are the first rows of every array.
    """
    alpha, multiplier, least, damping = (np.array(c, float) for c in zip(*[asdict(x).values() for x in settings], strict=True))
    order = np.argsort(begin - end, kind="stable")
    first, lengths = begin[order], (end - begin)[order]
    now = states.at(order)
    running = np.searchsorted(-lengths, -np.arange(lengths.max(initial=0)), "left")  # pieces longer than each step
    with np.errstate(all="ignore"):
        for step, k in enumerate(running.tolist()):
            places = first[:k] + step
            value = values[places][:, None]
            readings, average, variance = now.readings[:k], now.average[:k], now.variance[:k]
            threshold = average + np.maximum(multiplier * np.sqrt(variance), least)
            warm = readings >= WARMUP_READINGS
            flagged = warm & (value > threshold)
            share = np.where(flagged, alpha * damping, alpha)
            rise = value - average
            opening = readings == 0
            now.average[:k] = np.where(opening, value, average + share * rise)
            now.variance[:k] = np.where(opening, 0.0, (1 - share) * (variance + share * (rise * rise)))
            now.readings[:k] = np.minimum(readings + 1, WARMUP_READINGS)
            if traces is not None:
                traces.flagged[places] = flagged
                if traces.average is not None:
                    traces.average[places], traces.threshold[places], traces.warm[places] = now.average[:k], threshold, warm
    after = States.fresh(*states.average.shape)
    after.put(order, now)
    return after


STATE_SCHEMA = (
    "_chunk long, setting int, continues boolean, "
    "start_readings int, start_average double, start_variance double, "
    "end_readings int, end_average double, end_variance double"
)


def _values(table: pa.Table) -> np.ndarray:
    """The readings as doubles; null is not a number."""
    return pc.cast(table.column("value"), pa.float64()).to_numpy()


class Pieces:
    """The runs of rows of one series in sorted chunks, and which run is the first and the last of each chunk."""

    def __init__(self, table: pa.Table):
        chunk = table.column("_chunk").to_numpy()
        turns = np.flatnonzero(np.diff(chunk)) + 1
        self.begin = np.unique(np.r_[series_starts(table), turns]) if len(chunk) else np.zeros(0, np.int64)
        self.end = np.r_[self.begin[1:], len(chunk)] if len(chunk) else self.begin
        self.chunk_begin = np.r_[0, turns] if len(chunk) else turns
        self.chunk = chunk[self.chunk_begin]
        self.first = np.searchsorted(self.begin, self.chunk_begin)
        self.last = np.r_[self.first[1:], len(self.begin)] - 1 if len(chunk) else self.first


def _state_table(chunk: np.ndarray, continues: np.ndarray, start: States, end: States) -> pa.Table:
    """A row per chunk and setting."""
    n, settings = start.average.shape
    columns = {"_chunk": np.repeat(chunk, settings), "setting": np.tile(np.arange(settings, dtype=np.int32), n)}
    columns["continues"] = np.repeat(continues, settings)
    for side, states in (("start", start), ("end", end)):
        for name in ("readings", "average", "variance"):
            columns[f"{side}_{name}"] = getattr(states, name).ravel()
    return pa.table(columns)


def _given(rows: pa.Table, chunk: np.ndarray, settings: int, side: str = "start") -> tuple[States, np.ndarray]:
    """The states of the chunks as `rows` tell them, and which of them continue a series; fresh where they say nothing."""
    states, continues = States.fresh(len(chunk), settings), np.zeros((len(chunk), settings), bool)
    at, setting = np.searchsorted(chunk, rows.column("_chunk").to_numpy()), rows.column("setting").to_numpy()
    for name in ("readings", "average", "variance"):
        getattr(states, name)[at, setting] = rows.column(f"{side}_{name}").to_numpy()
    continues[at, setting] = rows.column("continues").to_numpy(zero_copy_only=False)
    return states, continues


def _guess_states(settings: list[Settings]):
    """Per chunk and setting: a guessed start and the end that follows from it."""

    def kernel(table: pa.Table) -> pa.Table:
        table = table.sort_by([("_chunk", "ascending"), ("_pos", "ascending")])
        own = table.column("_own").to_numpy(zero_copy_only=False)
        values, pieces = _values(table), Pieces(table)
        # The first own row of each chunk; before it stand the rows to guess from.
        lead = pieces.chunk_begin + np.add.reduceat(~own, pieces.chunk_begin)
        begin = pieces.begin[np.searchsorted(pieces.begin, lead, "right") - 1]
        fresh = States.fresh(len(lead), len(settings))
        start = advance(values, begin, lead, fresh, settings)
        tail, stop = pieces.begin[pieces.last], pieces.end[pieces.last]
        opens = tail > lead
        known = States.fresh(len(lead), len(settings))
        known.put(~opens, start.at(~opens))
        end = advance(values, np.maximum(lead, tail), stop, known, settings)
        return _state_table(pieces.chunk, begin < lead, start, end)

    return kernel


def _rerun_states(settings: list[Settings]):
    """Per chunk and setting with a known start: the end that follows from it."""

    def kernel(chunks: pa.Table, starts: pa.Table) -> pa.Table:
        chunks = chunks.sort_by([("_chunk", "ascending"), ("_pos", "ascending")])
        pieces = Pieces(chunks)
        start, asked = _given(starts, pieces.chunk, len(settings))
        tail = pieces.begin[pieces.last]
        inside = tail > pieces.chunk_begin
        known = States.fresh(len(tail), len(settings))
        known.put(~inside, start.at(~inside))
        end = advance(_values(chunks), tail, pieces.end[pieces.last], known, settings)
        return _state_table(pieces.chunk, np.ones(len(tail), bool), start, end).filter(pa.array(asked.ravel()))

    return kernel


def _differs(guess: str, truth: str):
    """Other than the same number, both not a number counting as the same."""
    return ~F.col(guess).eqNullSafe(F.col(truth))


def _mistaken(states: DataFrame) -> DataFrame:
    """Chunks that continue a series from another state than the chunk before ended in, with that state."""
    names = ("readings", "average", "variance")
    before = states.select(
        (F.col("_chunk") + 1).alias("_chunk"), "setting", *[F.col(f"end_{name}").alias(f"true_{name}") for name in names]
    )
    wrong = _differs("start_readings", "true_readings")
    for name in names[1:]:
        wrong = wrong | _differs(f"start_{name}", f"true_{name}")
    found = states.where("continues").join(before, ["_chunk", "setting"]).where(wrong)
    starts = [F.col(f"true_{name}").alias(f"start_{name}") for name in names]
    return found.select("_chunk", "setting", "continues", *starts)


def _read_through(settings: list[Settings]):
    """Start states of consecutive chunks, row batch by row batch, from the state of the first; each series opens afresh."""

    def work(batches):
        chunk, states, series = None, None, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            numbers, values = table.column("_chunk").to_numpy(), _values(table)
            cuts = np.unique(np.r_[0, np.flatnonzero(np.diff(numbers)) + 1, series_starts(table), len(numbers)])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                now = tuple(table.column(key)[a].as_py() for key in SERIES)
                if numbers[a] != chunk:
                    chunk, given = int(numbers[a]), table.column("_starts")[a].as_py()
                    if given is not None:  # the first chunk that is mistaken
                        rows = sorted(given, key=lambda r: r["setting"])
                        columns = [np.array([[r[f"start_{n}"] for r in rows]]) for n in ("readings", "average", "variance")]
                        states, series = States(columns[0].astype(np.int32), *columns[1:]), now
                    goes_on = np.array([now == series])
                    yield from _state_table(np.array([chunk]), goes_on, states, states).to_batches()
                if now != series:
                    states, series = States.fresh(1, len(settings)), now
                states = advance(values, np.array([a]), np.array([b]), states, settings)

    return work


def _settled(own: DataFrame, states: DataFrame, settings: list[Settings], task: Column) -> DataFrame:
    """Start states that agree, chunk by chunk, with where the chunk before ended."""
    wrong = materialise(_mistaken(states), "restarts")
    if wrong.isEmpty():
        return states
    redone = (
        own.join(wrong.select("_chunk").distinct(), "_chunk", "left_semi")
        .groupBy(task)
        .cogroup(wrong.groupBy(task))
        .applyInArrow(_rerun_states(settings), STATE_SCHEMA)
    )
    kept = states.join(wrong.select("_chunk", "setting"), ["_chunk", "setting"], "left_anti")
    states = materialise(kept.unionByName(redone), "states")
    wrong = materialise(_mistaken(states), "restarts")
    if wrong.isEmpty():
        return states
    # A row per chunk: which chunk opened its series, and the first of them that is mistaken under any setting.
    chunks = states.groupBy("_chunk").agg(F.max("continues").alias("continues"))
    so_far = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, 0)
    opened = F.max(F.when(~F.col("continues"), F.col("_chunk"))).over(so_far)
    chunks = materialise(chunks.select("_chunk", F.coalesce(opened, F.lit(0)).alias("_chain")), "chains")
    first = chunks.join(wrong, "_chunk").groupBy("_chain").agg(F.min("_chunk").alias("_from"))
    late = chunks.join(first, "_chain").where("_chunk >= _from")
    true = states.join(wrong.select("_chunk", "setting"), ["_chunk", "setting"], "left_anti").select(wrong.columns)
    true = true.unionByName(wrong).join(late.where("_chunk = _from").select("_chunk"), "_chunk", "left_semi")
    names = ("setting", "start_readings", "start_average", "start_variance")
    true = true.groupBy("_chunk").agg(F.collect_list(F.struct(*names)).alias("_starts"))  # a state per setting
    rows = own.join(late, "_chunk").join(true, "_chunk", "left").select(*SERIES, "_chain", "_chunk", "_pos", "value", "_starts")
    rows = rows.repartition("_chain").sortWithinPartitions("_chain", "_pos")
    read = materialise(rows.mapInArrow(_read_through(settings), STATE_SCHEMA), "read-through")
    return materialise(states.join(late.select("_chunk"), "_chunk", "left_anti").unionByName(read), "states")


def _ordered_series(series: DataFrame, order: tuple[str, ...]) -> Ordered:
    columns = list(dict.fromkeys([*SERIES, *order, "value"]))
    return order_rows(series.select(*columns), [*SERIES, *order])


#: The columns of chunks that states follow from; tasks in Python are handed no others unless they return them.
_CHUNKED = (*SERIES, "value", "_chunk", "_pos", "_own")


def _run_all(
    series: DataFrame, settings: list[Settings], order: tuple[str, ...], kernel, schema: str, carried: tuple[str, ...] = ()
) -> DataFrame:
    ordered = _ordered_series(series, order)
    size = balanced_rows(series.sparkSession, ordered.total)
    together = F.lit(max(1, TASK_ROWS // size))
    task = F.floor(F.col("_chunk") / together).alias("_task")
    led = with_chunks(ordered, min(GUESS_ROWS, size), size).select(*_CHUNKED)
    whole = with_chunks(ordered, 0, size)
    own = whole.select(*_CHUNKED)
    returned = whole.select(*dict.fromkeys([*_CHUNKED, *carried]))
    guessed = led.groupBy(task).applyInArrow(_guess_states(settings), STATE_SCHEMA)
    states = _settled(own, materialise(guessed, "states"), settings, task)
    return returned.groupBy(task).cogroup(states.groupBy(task)).applyInArrow(kernel, schema)


def _traced(chunks: pa.Table, states: pa.Table, settings: list[Settings], flags: bool = False) -> tuple[pa.Table, Pieces, Traces]:
    """The chunks in order, and what every reading came to."""
    chunks = chunks.sort_by([("_chunk", "ascending"), ("_pos", "ascending")])
    pieces = Pieces(chunks)
    given, continues = _given(states, pieces.chunk, len(settings))
    start = States.fresh(len(pieces.begin), len(settings))
    goes_on = continues.any(axis=1)
    start.put(pieces.first[goes_on], given.at(goes_on))
    traces = Traces(chunks.num_rows, len(settings), flags)
    advance(_values(chunks), pieces.begin, pieces.end, start, settings, traces)
    return chunks, pieces, traces


def ewma_trajectory(
    series: DataFrame,
    alpha: float = DEFAULT_ALPHA,
    multiplier: float = DEFAULT_MULTIPLIER,
    min_deviation: float = DEFAULT_MIN_DEVIATION,
    damping: float = DEFAULT_DAMPING,
    order: tuple[str, ...] = DEFAULT_ORDER,
) -> DataFrame:
    """Each reading with the running average, the threshold it was held against (none while warming up) and its flag."""
    settings = [Settings(alpha, multiplier, min_deviation, damping)]
    carried = list(dict.fromkeys([*SERIES, *order, "value"]))

    def kernel(chunks: pa.Table, states: pa.Table) -> pa.Table:
        chunks, _, traces = _traced(chunks, states, settings)
        return (
            chunks.select(carried)
            .append_column("average", pa.array(traces.average[:, 0]))
            .append_column("threshold", pa.array(traces.threshold[:, 0], mask=~traces.warm[:, 0]))
            .append_column("anomaly", pa.array(traces.flagged[:, 0]))
        )

    kinds = {field.name: field.dataType.simpleString() for field in series.schema}
    schema = ", ".join(f"{name} {kinds[name]}" for name in carried)
    schema += ", average double, threshold double, anomaly boolean"
    return _run_all(series, settings, order, kernel, schema, tuple(carried))


def ewma_flagged(series: DataFrame, **settings) -> DataFrame:
    return ewma_trajectory(series, **settings).where("anomaly").drop("anomaly")


def ewma_sweep(
    series: DataFrame, settings: list[Settings], order: tuple[str, ...] = DEFAULT_ORDER
) -> DataFrame:
    """Flags per series under each of several settings: the data is ordered and read once for all of them."""

    def kernel(chunks: pa.Table, states: pa.Table) -> pa.Table:
        chunks, pieces, traces = _traced(chunks, states, settings, flags=True)
        flagged = np.add.reduceat(traces.flagged, pieces.begin, dtype=np.int64)
        each, first = len(settings), pa.array(np.repeat(pieces.begin, len(settings)))
        return pa.table(
            {
                "machine_id": chunks.column("machine_id").take(first),
                "name": chunks.column("name").take(first),
                "setting": np.tile(np.arange(each, dtype=np.int32), len(pieces.begin)),
                "readings": np.repeat(pieces.end - pieces.begin, each),
                "flagged": flagged.ravel(),
            }
        )

    schema = "machine_id string, name string, setting int, readings long, flagged long"
    counted = _run_all(series, settings, order, kernel, schema)
    listed = series.sparkSession.createDataFrame(
        [(i, *map(float, asdict(each).values())) for i, each in enumerate(settings)],
        "setting int, alpha double, multiplier double, min_deviation double, damping double",
    )
    return (
        counted.groupBy(*SERIES, "setting")
        .agg(F.sum("readings").alias("readings"), F.sum("flagged").alias("flagged"))
        .join(F.broadcast(listed), "setting")  # a row per setting
        .drop("setting")
    )


def _smoothed(values: np.ndarray, start: float | None, weight: float) -> np.ndarray:
    """Weighted running average, block by block: within a block it is a triangular product plus the faded start."""
    out = np.empty(len(values))
    if start is None and len(values):
        out[0] = start = values[0]
        values, rest = values[1:], out[1:]
    else:
        rest = out
    size = 64
    fade = (1 - weight) ** np.arange(size + 1)
    lag = np.subtract.outer(np.arange(size), np.arange(size))
    triangle = np.where(lag >= 0, weight * fade[lag.clip(0)], 0.0)
    for at in range(0, len(values), size):
        block = values[at : at + size]
        n = len(block)
        with np.errstate(all="ignore"):
            rest[at : at + n] = triangle[:n, :n] @ block + fade[1 : n + 1] * start
        if not np.isfinite(block).all() or not np.isfinite(start):  # a zero in the product would spread what is not finite
            for i, value in enumerate(block):
                start = rest[at + i] = weight * value + (1 - weight) * start
        start = rest[at + n - 1]
    return out


def ewma_span(
    series: DataFrame, span: int | None = None, factor: float = SPAN_FACTOR, order: tuple[str, ...] = DEFAULT_ORDER
) -> DataFrame:
    """Running average with weight 2 / (span + 1), the span being the length of the series unless given, without the
    readings above `factor` times the average they have just entered.

    The average is linear in its start, so a chunk is summed up as `share * start + gain`, and starts follow from the
    sums of the chunks before: no guess is needed.
    """
    ordered = _ordered_series(series, order)
    chunks = with_chunks(ordered, 0, balanced_rows(series.sparkSession, ordered.total))
    whole = Window.partitionBy(*SERIES)
    # A row per (series, chunk) pair, counted map-side.
    pieces = materialise(
        chunks.groupBy(*SERIES, "_chunk")
        .agg(F.count("*").alias("_rows"))
        .select(
            *SERIES,
            "_chunk",
            (F.sum("_rows").over(whole) if span is None else F.lit(span).cast("long")).alias("_span"),
            (F.min("_chunk").over(whole) == F.col("_chunk")).alias("_opens"),
            (F.max("_chunk").over(whole) == F.col("_chunk")).alias("_closes"),
        ),
        "pieces",
    )

    def matched(chunk: pa.Table, given: pa.Table):
        """The pieces of a chunk that are asked for, each with its row of `given`."""
        asked = {(row["machine_id"], row["name"]): row for row in given.to_pylist()}
        machines, names = chunk.column("machine_id"), chunk.column("name")
        pieces = Pieces(chunk)
        for begin, end in zip(pieces.begin.tolist(), pieces.end.tolist(), strict=True):
            row = asked.get((machines[begin].as_py(), names[begin].as_py()))
            if row is not None:
                yield begin, end, row

    def sum_up(chunk: pa.Table, given: pa.Table) -> pa.Table:
        chunk = chunk.sort_by("_pos")
        values, rows = _values(chunk), []
        for begin, end, row in matched(chunk, given):
            weight = 2 / (row["_span"] + 1)
            gain = float(_smoothed(values[begin:end], None if row["_opens"] else 0.0, weight)[-1])
            share = 0.0 if row["_opens"] else (1 - weight) ** (end - begin)
            rows.append((row["machine_id"], row["name"], row["_chunk"], share, gain))
        kinds = [pa.string(), pa.string(), pa.int64(), pa.float64(), pa.float64()]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        heads = [*SERIES, "_chunk", "share", "gain"]
        return pa.table({h: pa.array(c, k) for h, c, k in zip(heads, columns, kinds, strict=True)})

    sums = (
        chunks.groupBy("_chunk")
        .cogroup(pieces.where("not (_opens and _closes)").groupBy("_chunk"))
        .applyInArrow(sum_up, "machine_id string, name string, _chunk long, share double, gain double")
    )

    def chain(table: pa.Table) -> pa.Table:
        table = table.sort_by("_chunk")
        starts, current = [], None
        for share, gain in zip(table.column("share").to_pylist(), table.column("gain").to_pylist(), strict=True):
            starts.append(current)
            current = gain if current is None else share * current + gain
        return table.select([*SERIES, "_chunk"]).append_column("start", pa.array(starts, pa.float64()))

    # Series that cross chunks only, a row per chunk: about the square root of the rows at most.
    starts = sums.groupBy(*SERIES).applyInArrow(chain, "machine_id string, name string, _chunk long, start double")
    given = pieces.join(starts, [*SERIES, "_chunk"], "left")
    carried = list(dict.fromkeys([*SERIES, *order, "value"]))
    kinds = {field.name: field.dataType.simpleString() for field in series.schema}

    def finish(chunk: pa.Table, given: pa.Table) -> pa.Table:
        chunk = chunk.sort_by("_pos")
        values = _values(chunk)
        averages, keep = np.empty(len(values)), np.ones(len(values), bool)
        for begin, end, row in matched(chunk, given):
            averages[begin:end] = _smoothed(values[begin:end], row["start"], 2 / (row["_span"] + 1))
            keep[begin:end] = ~(values[begin:end] > factor * averages[begin:end])
            if row["_opens"]:
                keep[begin] = True
        kept_rows = chunk.select(carried).append_column("average", pa.array(averages))
        return kept_rows.filter(pa.array(keep))

    return (
        chunks.groupBy("_chunk")
        .cogroup(given.groupBy("_chunk"))
        .applyInArrow(finish, ", ".join(f"{name} {kinds[name]}" for name in carried) + ", average double")
    )
