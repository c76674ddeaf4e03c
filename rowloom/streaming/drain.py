"""Running a streaming Frame to its end."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.frame import Frame
from rowloom.plans.order import scan_frame
from rowloom.plans.staging import staging_path


#: One row per step and batch.
STATE = "batch bigint, step int, seen bigint, start bigint, held string"


@dataclass(frozen=True)
class Seen:
    """What a step knows after a batch."""

    seen: int = 0  # rows that reached the step
    start: int = 0  # of which so many came before its buffer began
    held: str = ""  # where the rows of its buffer are


def drain(frame: Frame, folder: str | None = None) -> Frame:
    """Process everything the stream has now, and return it as a loaded frame.

    Rows go to ``folder/rows/<batch>``, in order within the batch.  The number of rows that each
    positional step has seen is stored per batch next to them, and so are the rows that a shuffle
    keeps in its buffer.  A batch that is replayed after a failure starts from the same state and
    overwrites its own output.  At the end buffers are emptied into ``folder/rows/<last batch>e``;
    a later run adds new files with new buffers, and one that follows a run that never came to its
    end goes on with the buffers as they were.
    """
    if frame.bounded:
        return frame
    folder = folder or staging_path(frame.spark, "stream")
    finished: list[list[Seen]] = []  # state of the steps, once a take has all its rows

    def run(batch: DataFrame, number: int) -> None:
        if finished:  # nothing can be added, but a later run continues from this batch
            _store(batch.sparkSession, finished[0], number, folder)
            return
        state = _run_batch(frame, batch, number, folder)
        if _full(frame, state):
            finished.append(state)

    query = (
        frame.df.writeStream.foreachBatch(run)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    while not query.awaitTermination(0.2):
        if finished:
            query.stop()
    if any(step.mixer for step in frame.steps):
        _empty_buffers(frame, folder)
    schema = (frame.steps[-1].template if frame.steps else frame).unordered_rows().schema
    reader = frame.spark.read.schema(schema).option("recursiveFileLookup", "true")
    try:
        return scan_frame(reader.parquet(f"{folder}/rows"))
    except AnalysisException:  # the stream had no files at all
        return Frame(frame.spark.createDataFrame([], schema), (), "sorted")


def _full(frame: Frame, state: list[Seen], first: int = 0) -> bool:
    """Whether some step from ``first`` on lets nothing more through."""
    pairs = list(zip(frame.steps, state, strict=True))[first:]
    return any(step.limit is not None and known.seen >= step.limit for step, known in pairs)


def _run_batch(frame: Frame, batch: DataFrame, number: int, folder: str) -> list[Seen]:
    """Process one micro-batch; returns what each step knows afterwards."""
    spark = batch.sparkSession
    state = [Seen()] * len(frame.steps)
    if number > 0 and state:
        state = _state_before(frame, number, folder)
    current = replace(frame, df=batch, bounded=True, steps=(), files=None, by_file=False, twin=None)
    if state:
        batch.persist()  # positions need several passes
    try:
        rows = _through(frame, current, state, 0, f"{number:012d}", folder)
        rows.write.mode("overwrite").parquet(f"{folder}/rows/{number:012d}")
        if state:
            _store(spark, state, number, folder)
    finally:
        if state:
            batch.unpersist()
    return state


def _through(frame: Frame, current: Frame, state: list[Seen], first: int, name: str, folder: str) -> DataFrame:
    """Rows of a piece of the stream behind the steps from ``first`` on; ``state`` is brought up to date."""
    for i, step in enumerate(frame.steps[first:], first):
        known = state[i]
        if step.mixer is None:
            current, seen = step.run(current, known.seen)
            state[i] = replace(known, seen=seen)
            continue
        entered = step.mixer.entered(current, known.seen, known.start)
        arrived = entered.count()
        if known.held:
            entered = current.spark.read.schema(entered.schema).parquet(known.held).unionByName(entered)
        freed = step.mixer.freed(entered)
        held = f"{folder}/held/{name}/{i:04d}"
        step.mixer.held(freed).write.mode("overwrite").parquet(held)
        state[i] = Seen(known.seen + arrived, known.start, held)
        current = step.mixer.released(freed)
    return current.rows()


def _empty_buffers(frame: Frame, folder: str) -> None:
    """Let the rows that buffers hold after the last batch go through the steps behind them."""
    spark = frame.spark
    try:
        stored = spark.read.schema(STATE).option("recursiveFileLookup", "true").parquet(f"{folder}/seen")
    except AnalysisException:  # there was no batch
        return
    last = stored.agg(F.max("batch")).first()[0]
    try:
        _state_of(spark, f"{last:012d}e", len(frame.steps), folder)
        return  # an earlier run emptied them, and there was nothing new
    except AnalysisException:
        state = _state_of(spark, f"{last:012d}", len(frame.steps), folder)
    if not any(known.held for known in state):
        return
    _discard(spark, last, folder)
    for i, step in enumerate(frame.steps):
        if step.mixer is None or not state[i].held:
            continue
        name, held = f"{last:012d}e/{i:04d}", state[i].held
        state[i] = Seen(state[i].seen, state[i].seen)
        if not _full(frame, state, i + 1):
            current = step.mixer.emptied(spark.read.parquet(held))
            _through(frame, current, state, i + 1, name, folder).write.mode("overwrite").parquet(f"{folder}/rows/{name}")
    _store(spark, state, last, folder, "e")


def _state_before(frame: Frame, number: int, folder: str) -> list[Seen]:
    """What the steps know before the batch ``number``."""
    spark, steps, name = frame.spark, len(frame.steps), f"{number - 1:012d}"
    if any(step.mixer for step in frame.steps):
        try:
            return _state_of(spark, name + "e", steps, folder)
        except AnalysisException:  # the buffers were not emptied, or not to the end
            _discard(spark, number - 1, folder)
    return _state_of(spark, name, steps, folder)


def _state_of(spark: SparkSession, name: str, steps: int, folder: str) -> list[Seen]:
    state = [Seen()] * steps
    for row in spark.read.schema(STATE).parquet(f"{folder}/seen/{name}").collect():  # one row per step
        state[row["step"]] = Seen(row["seen"], row["start"] or 0, row["held"] or "")
    return state


def _store(spark: SparkSession, state: list[Seen], number: int, folder: str, mark: str = "") -> None:
    rows = [(number, i, known.seen, known.start, known.held) for i, known in enumerate(state)]
    table = spark.createDataFrame(rows, STATE)
    table.coalesce(1).write.mode("overwrite").parquet(f"{folder}/seen/{number:012d}{mark}")


def _discard(spark: SparkSession, number: int, folder: str) -> None:
    """Take back rows from buffers that a run began to empty after the batch ``number`` and did not finish."""
    path = f"{folder}/rows/{number:012d}e"
    try:
        left = spark.read.option("recursiveFileLookup", "true").parquet(path)
    except AnalysisException:  # nothing there, as usual
        return
    left.limit(0).write.mode("overwrite").parquet(path)
