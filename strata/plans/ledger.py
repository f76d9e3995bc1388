"""What a named run has finished, so that a rerun after a failure repeats only the rest.

One marker a finished output, below the lake: ``<root>/<run>/<stage>/<output>``. Spark writes it after
the output itself, and it counts once its own write is committed, so an output that broke off half way
is done again. The markers say that the run wrote an output, not that its inputs still hold: a load of
new files is a new run.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import SparkSession

from strata.sources.files import list_entries


class Ledger:
    def __init__(self, spark: SparkSession, root: str, run: str):
        if not re.fullmatch(r"\w[\w.-]*", run):
            raise ValueError(f"a run's name is made of letters, digits, '_', '-' and '.': {run!r}")
        self.spark, self.root = spark, f"{root.rstrip('/')}/{run}"

    def _marker(self, stage: str, output: str) -> str:
        return f"{self.root}/{stage}/{output}"

    def is_finished(self, stage: str, output: str) -> bool:
        try:
            return "_SUCCESS" in list_entries(self.spark, self._marker(stage, output))
        except FileNotFoundError:
            return False

    def note(self, stage: str, output: str) -> None:
        row = self.spark.createDataFrame([(stage, output)], "stage string, output string")
        row.coalesce(1).write.mode("overwrite").parquet(self._marker(stage, output))

    def missing(self, stage: str, jobs: dict[str, Callable[[], object]]) -> dict[str, Callable[[], object]]:
        """The jobs whose output this run has not finished; each notes its output when it is done."""

        def noting(output: str, job: Callable[[], object]) -> Callable[[], object]:
            def run() -> object:
                result = job()
                self.note(stage, output)
                return result

            return run

        return {o: noting(o, job) for o, job in jobs.items() if not self.is_finished(stage, o)}
