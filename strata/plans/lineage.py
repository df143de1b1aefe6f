"""Which datasets of a layer wait for which, and running the others side by side.

A dataset waits for those that write a path it reads.  What does not depend on each
other runs at once, each dataset on a thread and in a scheduler pool of its own
(``spark.scheduler.mode=FAIR`` shares the cluster between them): a day's run has many
small jobs, and one after another they leave most executors idle.  Those that read the
same large table take turns: each fills the cluster alone, and has all of the table in its
shuffle files.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from graphlib import CycleError, TopologicalSorter

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from .specs import DatasetSpec, place_of

WORKERS = 4
POOL = "spark.scheduler.pool"
LARGE = 256 << 20  # bytes of files


def dependencies(specs: Mapping[str, DatasetSpec]) -> dict[str, set[str]]:
    """For each dataset, the others that write what it reads."""
    writer = {place_of(s.sink["path"]): name for name, s in specs.items() if s.sink.get("path")}
    reads = {name: [s.source["path"], *(j["path"] for j in s.joins)] for name, s in specs.items()}
    return {name: {writer[place_of(p)] for p in paths if place_of(p) in writer} - {name} for name, paths in reads.items()}


def taking_turns(waits_for: Mapping[str, set[str]], specs: Mapping[str, DatasetSpec], size: Callable[[DatasetSpec], int]) -> dict[str, set[str]]:
    """With each dataset waiting for the one before it that reads the same large table, if neither
    waits for what another writes."""
    out, last = dict(waits_for), {}
    for name, spec in specs.items():
        place = place_of(spec.source["path"])
        if not waits_for[name] and size(spec) >= LARGE:
            out[name] = {last[place]} if place in last else set()
            last[place] = name
    return out


def run_all(spark: SparkSession, waits_for: Mapping[str, set[str]], task: Callable[[str], object], workers: int = WORKERS) -> dict[str, object]:
    """``task(name)`` for every dataset, each when those it waits for have ended, well or not
    (a task that fails says so by what it returns).  An exception ends the run when the
    tasks that have begun are over."""
    order = TopologicalSorter(waits_for)
    try:
        order.prepare()
    except CycleError as exc:
        raise ValueError(f"datasets wait for each other: {' -> '.join(exc.args[1])}") from exc

    def pooled(name: str):
        spark.sparkContext.setLocalProperty(POOL, name)
        return task(name)

    done, results = {}, {}
    with ThreadPoolExecutor(max(1, workers)) as threads:
        while order.is_active():
            for name in order.get_ready():
                # The caller's job group and other local properties hold in the thread too.
                done[threads.submit(inheritable_thread_target(spark)(lambda n=name: pooled(n)))] = name
            ended, _ = wait(done, return_when=FIRST_COMPLETED)
            for future in ended:
                name = done.pop(future)
                results[name] = future.result()
                order.done(name)
    return results


def in_order(names: Sequence[str], results: Mapping[str, object]) -> list:
    return [results[n] for n in names if n in results]
