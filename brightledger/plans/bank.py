"""Puts the layers together: bank inputs in, any table of any layer out."""

from __future__ import annotations

import inspect
from collections.abc import Mapping
from hashlib import sha256
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from brightledger.params import RunParams
from brightledger.plans import alternative, gold, silver, staging
from brightledger.sources.driver_tables import TableFrames, alternative_frames, bank_frames
from brightledger.sources.published import content_mark, stored_mark, stored_table, write_table
from brightledger.sources.reference import BuiltinReferences


class Bank:
    """Lazy tables by name.

    With ``store`` every roll-up that is asked for is written there and read back:
    reports that share roll-ups then share their work, and each report's plan starts
    at files that survive the loss of an executor. A stored roll-up carries a mark of
    the input files below it, of its parameters and of its profile; another bank over
    the same store takes it as it is if the mark is still right, and replaces it if not.
    Without ``store`` everything stays one lazy plan, in which the optimizer reuses
    equal shuffles.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        references: Mapping[str, DataFrame],
        params: RunParams = RunParams(),
        store: str | None = None,
        profile: str = "main",
    ):
        self.raw, self.references, self.params, self.store, self.profile = raw, references, params, store, profile
        other = profile == "alt"
        self.cleaning = {**staging.MODELS, **(alternative.STAGING if other else {})}
        self.roll_ups = {**alternative.SHARED, **alternative.ROLL_UPS} if other else {**silver.MODELS, **silver.PARTS, **gold.PARTS}
        self.reports = alternative.REPORTS if other else gold.MODELS
        self._tables: dict[str, DataFrame] = {}
        self._marks: dict[str, str] = {}

    @classmethod
    def over(
        cls,
        spark: SparkSession,
        folder: str,
        params: RunParams = RunParams(),
        store: str | None = None,
        profile: str = "main",
    ) -> Bank:
        """Over the given order and event tables."""
        frames = alternative_frames if profile == "alt" else bank_frames
        raw = frames(spark, folder, params.as_of.isoformat())
        return cls(raw, BuiltinReferences(spark), params, store, profile)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._make(name)
        return self._tables[name]

    def _make(self, name: str) -> DataFrame:
        if name in self.cleaning:
            clean, references = self.cleaning[name]
            return clean(self.raw[name], self.params, *[self.references[r] for r in references])
        model = self.roll_ups.get(name) or self.reports[name]
        if not self.store or name not in self.roll_ups:
            return self.call(model)
        spark, place, mark = self.spark, f"{self.store}/{name}", self.mark(name)
        if stored_mark(spark, place) == mark:
            return stored_table(spark, place)
        return write_table(self.call(model), place, mark)

    @property
    def spark(self) -> SparkSession:
        return self.raw[next(iter(self.raw))].sparkSession

    def inputs_of(self, name: str) -> set[str]:
        """The bank inputs a table is made of, through all layers."""
        if name in self.cleaning:
            return {name}
        return set().union(*[self.inputs_of(wanted) for wanted in self._wanted(self.roll_ups.get(name) or self.reports[name])])

    def mark(self, name: str) -> str:
        """A mark of all that a table follows from: it changes with any file of its inputs and
        of the reference tables that are joined to them."""
        inputs = sorted(self.inputs_of(name))
        joined = sorted({reference for i in inputs for reference in self.cleaning[i][1]})
        marks = [*[self._mark_of(self.raw, i) for i in inputs], *[self._mark_of(self.references, r) for r in joined]]
        return sha256(" ".join([self.profile, self.params.as_of.isoformat(), name, *marks]).encode()).hexdigest()[:32]

    def _mark_of(self, frames: Mapping[str, DataFrame], name: str) -> str:
        if isinstance(frames, BuiltinReferences):
            return name
        paths = [frames.source(name)] if isinstance(frames, TableFrames) else [unquote(f) for f in frames[name].inputFiles()]
        # Rows that lie in no file have a mark of their own in each bank.
        key = " ".join(sorted(paths)) or name
        if key not in self._marks:
            self._marks[key] = content_mark(self.spark, paths) if paths else uuid4().hex
        return self._marks[key]

    @staticmethod
    def _wanted(model) -> list[str]:
        return [name for name in inspect.signature(model).parameters if name != "p"]

    def call(self, model) -> DataFrame:
        """Calls a model with the tables its parameters name."""
        takes_params = ["p"] if "p" in inspect.signature(model).parameters else []
        given = {name: self.params for name in takes_params} | {name: self[name] for name in self._wanted(model)}
        return model(**given)
