"""Jobs in dependency order that can be taken up again after an interruption.

A stage that ends writes what it read and made to a log; a later run skips a stage whose
inputs are the same, file by file, and whose needed stages were skipped too or have the
result it was made from.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from reviewloom.store.buckets import CommitLog


@dataclass(frozen=True)
class Stage:
    """A job: what it does (returning what is worth noting), the stages it needs, its input paths and its parameters."""

    name: str
    run: Callable[[], dict]
    needs: tuple[str, ...] = ()
    inputs: tuple[str, ...] = ()
    outputs: tuple[str, ...] = ()
    parameters: dict = field(default_factory=dict)


class StageFailed(RuntimeError):
    """A stage raised; those that do not need it were still run."""


def files_of(spark: SparkSession, path: str) -> list[list]:
    """Path, size and time of all files below ``path``, in order; hidden ones left out.  Globs are expanded."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    start = jvm.org.apache.hadoop.fs.Path(path)
    fs = start.getFileSystem(conf)
    found = []
    for top in fs.globStatus(start) or []:
        listed = fs.listFiles(top.getPath(), True)
        while listed.hasNext():
            status = listed.next()
            name = status.getPath().getName()
            if not name.startswith((".", "_")):
                found.append([status.getPath().toString(), status.getLen(), status.getModificationTime()])
    return sorted(found)


class JobGraph:
    """Stages and their log below ``path``."""

    def __init__(self, spark: SparkSession, path: str, stages: Sequence[Stage]) -> None:
        self.spark = spark
        self.log = CommitLog(spark, f"{path.rstrip('/')}/manifest")
        self.stages = {s.name: s for s in stages}
        order: list[str] = []
        left = dict(self.stages)
        while left:
            ready = [n for n, s in left.items() if all(d in order for d in s.needs)]
            if not ready:
                raise ValueError(f"stages that need each other or an unknown stage: {sorted(left)}")
            for name in ready:
                order.append(name)
                del left[name]
        self.order = order

    def done(self) -> dict[str, dict]:
        """Newest entry of every stage that has ended."""
        return {e["stage"]: {**e, "version": v} for v, e in sorted(self.log.read().items())}

    def _mark(self, stage: Stage, made: dict[str, str]) -> str:
        """What a stage's result depends on: parameters, input files and the results it needs."""
        told = {"parameters": stage.parameters, "needs": {n: made[n] for n in stage.needs}, "inputs": [files_of(self.spark, p) for p in stage.inputs]}
        return hashlib.sha256(json.dumps(told, sort_keys=True, default=str).encode()).hexdigest()

    def run(self, parallel: int = 3) -> dict[str, dict]:
        """Run what is not done; returns per stage its ``result`` and whether it was ``skipped``.  Raises after all that could run has."""
        before, out, made, failed = self.done(), {}, {}, {}

        def one(name: str) -> tuple[dict, bool, str]:
            stage = self.stages[name]
            mark = self._mark(stage, made)
            old = before.get(name)
            if old and old["mark"] == mark and all(files_of(self.spark, p) == w for p, w in old["made"].items()):
                return old["result"], True, old["token"]
            began = time.time()
            result = json.loads(json.dumps(stage.run(), default=str))
            written = {p: files_of(self.spark, p) for p in stage.outputs}
            # What needs this stage runs again when it has run again.
            token = hashlib.sha256(json.dumps([mark, written, began], default=str).encode()).hexdigest()
            self.log.claim({"stage": name, "mark": mark, "token": token, "made": written, "result": result, "seconds": round(time.time() - began, 3)})
            return result, False, token

        with ThreadPoolExecutor(max(1, parallel)) as pool:
            waiting, running = list(self.order), {}
            while waiting or running:
                for name in [n for n in waiting if all(d in made for d in self.stages[n].needs)]:
                    waiting.remove(name)
                    running[pool.submit(one, name)] = name
                if not running:
                    break
                ended: set[Future] = wait(running, return_when=FIRST_COMPLETED).done
                for future in ended:
                    name = running.pop(future)
                    try:
                        result, skipped, made[name] = future.result()
                        out[name] = {"result": result, "skipped": skipped}
                    except Exception as error:  # noqa: BLE001
                        failed[name] = error
        if failed:
            name, error = next(iter(failed.items()))
            raise StageFailed(f"{sorted(failed)}; {name}: {error}") from error
        return out
