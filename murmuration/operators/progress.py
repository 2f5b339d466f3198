"""State of an iterative run, one folder per pass, so that a run goes on where it stopped.

A pass's state is written as one JSON line below ``path/pass=<number>``; it
counts once the writer's success mark is there, so a pass that was being written
when the driver died is run again.  The run's settings are pass 0; going on with
others is an error.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession


class PassLog:
    """Passes of one run below a folder that outlives the driver."""

    def __init__(self, spark: SparkSession, path: str, settings: dict) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        known = self.load(0)
        settings = json.loads(json.dumps(settings))
        if known is None:
            self.save(0, settings)
        elif known != settings:
            raise ValueError(f"{path} holds a run with other settings")

    def _folder(self, number: int) -> str:
        return f"{self.path}/pass={number:05d}"

    def _complete(self, number: int) -> bool:
        mark = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._folder(number)}/_SUCCESS")
        conf = self.spark._jsc.hadoopConfiguration()
        return mark.getFileSystem(conf).exists(mark)

    def load(self, number: int) -> dict | None:
        """The state after a pass, or None where it is not complete."""
        if not self._complete(number):
            return None
        return json.loads(self.spark.read.text(self._folder(number)).first()["value"])

    def save(self, number: int, state: dict) -> None:
        self.spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1) \
            .write.mode("overwrite").text(self._folder(number))

    def once(self, number: int, run: Callable[[], dict]) -> dict:
        """The state after a pass: as stored, or run and stored now."""
        state = self.load(number)
        if state is None:
            state = json.loads(json.dumps(run()))
            self.save(number, state)
        return state
