"""Recognition engines: one in each Python worker, a failure to start remembered, and a probe before a run."""

from __future__ import annotations

import hashlib
import sys
import types
from collections.abc import Callable

from pyspark.sql import SparkSession

_KEEPER = "_folioweave_engines"


def _made() -> dict[str, tuple[object, str | None]]:
    """What this process has made, by the factory's digest: an engine, or why there is none.

    This package's functions and globals travel by value and are new in each task; an entry of
    sys.modules outlives them.
    """
    return sys.modules.setdefault(_KEEPER, types.ModuleType(_KEEPER)).__dict__


class EngineFailed(RuntimeError):
    """An engine that did not start."""


class PerWorker:
    """A factory whose engine a worker makes once, however many tasks it runs.

    Workers know it by a digest of the pickled factory, taken on the driver. A factory that raises is not
    called again in that worker: later calls raise EngineFailed with the first failure's message.
    """

    def __init__(self, factory: Callable[[], Callable]):
        from pyspark import cloudpickle

        self.factory, self.name = factory, hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()

    def __call__(self) -> Callable:
        made = _made()
        if self.name not in made:
            try:
                made[self.name] = self.factory(), None
            except Exception as e:  # noqa: BLE001 - kept for all later calls
                made[self.name] = None, f"{type(e).__name__}: {e}"
        engine, failure = made[self.name]
        if failure:
            raise EngineFailed(failure)
        return engine


def per_worker(factory: Callable) -> PerWorker:
    return factory if isinstance(factory, PerWorker) else PerWorker(factory)


def probe(spark: SparkSession, factory: Callable, workers: int | None = None) -> tuple[int, list[str]]:
    """How many of so many tasks start the engine, and the different failures of the others."""
    import pyarrow as pa

    workers, make = workers or spark.sparkContext.defaultParallelism, per_worker(factory)

    def tried(batches):
        for batch in batches:
            failures = []
            for _ in range(batch.num_rows):
                try:
                    make()
                    failures.append(None)
                except EngineFailed as e:
                    failures.append(str(e))
            yield pa.RecordBatch.from_arrays([pa.array(failures, pa.string())], ["failure"])

    found = spark.range(0, workers, 1, workers).mapInArrow(tried, "failure string").groupBy("failure").count().collect()
    return sum(r["count"] for r in found if r["failure"] is None), sorted(r["failure"] for r in found if r["failure"] is not None)
