"""One micro-batch into several sinks."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ..session import delete_folder, file_system, read_text, write_text
from .tables import stored_once

Sink = Callable[[DataFrame, int], None]
POOL = "spark.scheduler.pool"


class Branch(NamedTuple):
    """Sinks that share one frame made from the batch; ``hold`` keeps it while they run."""

    frame: Callable[[DataFrame], DataFrame]
    sinks: Mapping[str, Sink]
    hold: bool = True


class SinkErrors(RuntimeError):
    """Some sinks of a batch failed; the others were written."""


def fan_out(branches: list[Branch], shared: Callable[[DataFrame], DataFrame] = lambda batch: batch,
            on_error: Callable[[str, int, Exception], None] | None = None, at_once: int = 1, park: str | None = None) -> Sink:
    """A ``foreachBatch`` function that gives a batch to every sink.

    ``shared`` is the work all branches need, done once; the frame of a branch is
    made once for its sinks. An empty batch is skipped. A failing sink does not
    keep the others from running; without ``on_error`` and ``park`` the failures are raised
    afterwards, so that the batch runs again and its sinks replace what they wrote.

    ``at_once`` sinks run side by side, each in a scheduler pool of its name (which
    matters with fair scheduling): a slow sink holds up the end of the batch, not the other
    sinks. With ``park``, the rows that a failed sink was given are kept in a folder
    there, from which ``replay`` takes them, and the stream goes on.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        failures: dict[str, Exception] = {}
        with ExitStack() as held_frames:
            held = _held(shared(batch), held_frames)
            if held.isEmpty():
                return
            if at_once > 1:
                frames = [_held(b.frame(held), held_frames) if b.hold else b.frame(held) for b in branches]
                calls = [(name, sink, frame) for b, frame in zip(branches, frames) for name, sink in b.sinks.items()]
                failures = _run(calls, batch_id, at_once, park)
            else:
                for branch in branches:
                    with ExitStack() as own:
                        frame = _held(branch.frame(held), own) if branch.hold else branch.frame(held)
                        failures |= _run([(name, sink, frame) for name, sink in branch.sinks.items()], batch_id, 1, park)
        if on_error is not None:
            for name, error in failures.items():
                on_error(name, batch_id, error)
        elif failures and park is None:
            raise _errors(failures)

    return write


def _held(frame: DataFrame, stack: ExitStack) -> DataFrame:
    return stack.enter_context(stored_once(frame))


def _errors(failures: Mapping[str, Exception]) -> SinkErrors:
    return SinkErrors("; ".join(f"{name}: {error}" for name, error in failures.items()))


def _run(calls: list[tuple[str, Sink, DataFrame]], batch_id: int, at_once: int, park: str | None) -> dict[str, Exception]:
    """Give frames to sinks; the failures by name. Rows that cannot be parked either are an error of the batch."""

    def one(name: str, sink: Sink, frame: DataFrame) -> Exception | None:
        if at_once > 1:
            frame.sparkSession.sparkContext.setLocalProperty(POOL, name)
        try:
            sink(frame, batch_id)
        except Exception as error:
            if park is not None:
                frame.write.mode("overwrite").parquet(_parked(park, name, batch_id))
                write_text(frame.sparkSession, f"{_parked(park, name, batch_id)}.json", json.dumps({"sink": name, "batch_id": batch_id, "error": str(error)[:2000]}))
            return error
        return None

    if at_once <= 1:
        found = [one(*call) for call in calls]
    else:
        # The jobs of a thread belong to the stream's job group, so stopping the query stops them. A target has properties
        # of its own: threads that share one would set each other's pool.
        with ThreadPoolExecutor(at_once) as pool:
            found = [f.result() for f in [pool.submit(inheritable_thread_target(call[2].sparkSession)(one), *call) for call in calls]]
    return {name: error for (name, _, _), error in zip(calls, found) if error is not None}


def _parked(park: str, name: str, batch_id: int) -> str:
    return f"{park}/{name}/{batch_id}"


def parked(spark: SparkSession, park: str) -> list[dict]:
    """What waits for a replay: sink, batch_id and error of each folder, by batch."""
    files, at = file_system(spark, park)
    notes = []
    if files.exists(at):
        found = files.listFiles(at, True)
        while found.hasNext():
            path = found.next().getPath().toString()
            if path.endswith(".json"):
                notes.append(json.loads(read_text(spark, path)))
    return sorted(notes, key=lambda note: (note["batch_id"], note["sink"]))


def replay(spark: SparkSession, park: str, sinks: Mapping[str, Sink]) -> list[tuple[str, int]]:
    """Give parked rows to their sinks once more, under the id of their batch, oldest first; gives those that were taken.

    A sink replaces what it wrote of a batch, so a replay that broke off may run again. What fails again stays and is raised
    at the end; later batches of that sink then wait too.
    """
    done, failures = [], {}
    for note in parked(spark, park):
        name, batch_id = note["sink"], note["batch_id"]
        if name not in sinks or name in failures:
            continue
        try:
            sinks[name](spark.read.parquet(_parked(park, name, batch_id)), batch_id)
        except Exception as error:
            failures[name] = error
            continue
        delete_folder(spark, f"{_parked(park, name, batch_id)}.json")
        delete_folder(spark, _parked(park, name, batch_id))
        done.append((name, batch_id))
    if failures:
        raise _errors(failures)
    return done
