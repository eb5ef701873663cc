"""Pipelines: named tables, actions between them, feeds, checks without data and run reports."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

Frames = dict[str, DataFrame]


@dataclass(frozen=True)
class Table:
    """A Parquet table of the pipeline. `schema` makes a table readable before it is written (recursive inputs)."""

    name: str
    path: str
    mode: str = "overwrite"
    schema: str | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        from ..sources.geo import read_or_empty

        return read_or_empty(spark, self.path, self.schema) if self.schema else spark.read.parquet(self.path)

    def write(self, df: DataFrame) -> None:
        df.write.mode(self.mode).parquet(self.path)


@dataclass(frozen=True)
class Action:
    """Tables in, tables out. Each step maps frames to frames; a text step is SQL over views named like the tables."""

    name: str
    inputs: tuple[str, ...]
    outputs: tuple[str, ...]
    steps: tuple[Callable[[Frames], Frames] | str, ...] = ()
    feed: str = "default"
    recursive: tuple[str, ...] = ()

    def plan(self, frames: Frames) -> Frames:
        for step in self.steps:
            if callable(step):
                frames = {**frames, **step(frames)}
            else:
                spark = next(iter(frames.values())).sparkSession
                text = re.sub(r"%\{(\w+)\}", r"{\1}", step)
                frames = {**frames, self.outputs[0]: spark.sql(text, **{re.sub(r"\W", "_", k): v for k, v in frames.items()})}
        if not self.steps:
            frames = {**frames, self.outputs[0]: frames[self.inputs[0]]}
        missing = [o for o in self.outputs if o not in frames]
        if missing:
            raise ValueError(f"{self.name} makes no {', '.join(missing)}")
        return {o: frames[o] for o in self.outputs}


@dataclass
class Pipeline:
    tables: dict[str, Table]
    actions: list[Action]
    report: dict = field(default_factory=dict)

    def ordered(self, feeds: str | None = None) -> list[Action]:
        """Actions of the feeds (comma-separated; None: all), each after those that make its inputs."""
        wanted = [a for a in self.actions if feeds is None or a.feed in [f.strip() for f in feeds.split(",")]]
        makers = {o: a.name for a in wanted for o in a.outputs}
        graph = {a.name: {makers[i] for i in a.inputs if i in makers and makers[i] != a.name} for a in wanted}
        by_name = {a.name: a for a in wanted}
        return [by_name[n] for n in TopologicalSorter(graph).static_order()]

    def _frames(self, spark: SparkSession, action: Action) -> Frames:
        return {i: self.tables[i].read(spark) for i in (*action.inputs, *action.recursive)}

    def dry_run(self, spark: SparkSession, feeds: str | None = None) -> dict[str, dict[str, str]]:
        """Schemas of all outputs, from plans over empty tables; nothing is computed or written."""
        known: Frames = {}
        out = {}
        for a in self.ordered(feeds):
            frames = {i: known[i] if i in known else self.tables[i].read(spark).limit(0) for i in (*a.inputs, *a.recursive)}
            made = a.plan(frames)
            known |= made
            out[a.name] = {k: df.schema.simpleString() for k, df in made.items()}
        return out

    def run(self, spark: SparkSession, feeds: str | None = None, report_path: str | None = None) -> dict:
        """Run all actions in order; every output is written, and read back by later actions."""
        self.report = {"feeds": feeds, "started": time.time(), "actions": {}}
        for a in self.ordered(feeds):
            state = self.report["actions"][a.name] = {"state": "running", "started": time.time(), "rows": {}}
            try:
                for name, df in a.plan(self._frames(spark, a)).items():
                    seen = Observation(f"{a.name}-{name}")
                    self.tables[name].write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
                    state["rows"][name] = seen.get["rows"]
                state["state"] = "succeeded"
            except Exception as e:
                state |= {"state": "failed", "error": str(e)[:500]}
                raise
            finally:
                state["seconds"] = round(time.time() - state["started"], 3)
                if report_path:
                    with open(report_path, "w") as f:
                        json.dump(self.report, f, indent=1)
        return self.report
