"""All models of one run, from landing records to tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from moonstride.operators.sinks import create_view, ensure_schema, rebuild_table, schema_for
from moonstride.plans import intermediate, marts, staging
from moonstride.plans.names import DEFAULT_NAMES, Names
from moonstride.sources.seeds import default_activity_mapping


@dataclass(frozen=True)
class Inputs:
    """Raw records as the loads keep them. Cycles and recoveries are optional."""

    activities: DataFrame
    sleeps: DataFrame
    workouts: DataFrame
    moon_calendar: DataFrame
    activity_mapping: DataFrame | None = None
    cycles: DataFrame | None = None
    recoveries: DataFrame | None = None


class Build:
    """Writes every model to its schema; a model that others read is read back as a table.

    Staging models are views, the rest are tables. Facts are clustered by day and id, so a question about
    some days reads those alone; with ``partition_facts`` they are partitioned by day instead.
    """

    def __init__(
        self,
        spark: SparkSession,
        names: Names = DEFAULT_NAMES,
        location: str | None = None,
        schema_prefix: str = "",
        partition_facts: bool = False,
    ) -> None:
        self.spark = spark
        self.names = names
        self.location = location
        self.schema_prefix = schema_prefix
        self.partition_facts = partition_facts
        self.models: dict[str, DataFrame] = {}

    def _view(self, model: str, df: DataFrame) -> DataFrame:
        self.models[model] = create_view(df, model)
        return self.models[model]

    def _table(self, model: str, folder: str, df: DataFrame) -> DataFrame:
        schema = self.schema_prefix + schema_for(
            model, folder, sources=(self.names.body, self.names.track)
        )
        base = f"{self.location}/{schema}" if self.location else None
        ensure_schema(self.spark, schema, base)
        by_day = ("date_day",) if self.partition_facts and model.startswith("fct_") else ()
        path = f"{base}/{model}" if base else None
        clusters = ()
        if model.startswith("fct_") and "date_day" in df.columns:
            clusters = ("date_day", *[c for c in df.columns if c.endswith("_id")][:1])
        self.models[model] = rebuild_table(df, f"{schema}.{model}", path, by_day, clusters)
        return self.models[model]

    def run(self, inputs: Inputs, calendar_end: date | None = None) -> dict[str, DataFrame]:
        """Build everything and return the models by name."""
        track, body = self.names.track, self.names.body
        seed = inputs.activity_mapping
        seed = default_activity_mapping(self.spark) if seed is None else seed
        mapping = self._view("stg_seeds_activity_mapping", staging.stage_activity_mapping(seed))
        moon = self._view("stg_seeds_moon_data", staging.moon_calendar_columns(inputs.moon_calendar))

        staged = self._view(f"stg_{track}_activities", staging.stage_activities(inputs.activities))
        acts = self._table(
            f"int_{track}_activities", track, intermediate.activities(staged, mapping, self.names)
        )
        types = self._table(f"dim_{track}_activity_type", track, marts.activity_types(acts, self.names))
        gears = self._table(f"dim_{track}_gear", track, marts.gear(acts, self.names))
        keyed = marts.keyed_activities(acts, types, gears, self.names)
        fact = self._table(f"fct_{track}_activities", track, marts.fact_activities(keyed, self.names))
        self._table(f"fct_{track}_activities_socials", track, marts.fact_activity_socials(keyed, self.names))
        self._table("fct_activities", "semantic", marts.semantic_activities(fact, types, self.names))

        staged_sleep = self._view(f"stg_{body}_sleep", staging.stage_sleeps(inputs.sleeps))
        slept = self._table(f"int_{body}_sleep", body, intermediate.sleeps(staged_sleep, moon))
        sleeps = self._table(f"fct_{body}_sleeps", body, marts.fact_sleeps(slept))
        self._table(f"fct_{body}_sleep_quality", body, marts.fact_sleep_quality(slept))

        staged = self._view(f"stg_{body}_workouts", staging.stage_workouts(inputs.workouts))
        worked = self._table(
            f"int_{body}_workouts", body, intermediate.workouts(staged, mapping, self.names)
        )
        workouts = self._table(f"fct_{body}_workouts", body, marts.fact_workouts(worked))
        self._table(f"dim_{body}_workouts", body, marts.workout_activities(workouts, self.names))

        if inputs.cycles is not None and inputs.recoveries is not None:
            cycles = intermediate.physiological_cycles(
                self._view(f"stg_{body}_cycles", staging.stage_cycles(inputs.cycles)),
                self._view(f"stg_{body}_recoveries", staging.stage_recoveries(inputs.recoveries)),
                intermediate.numbered_sleeps(staged_sleep),
            )
            self._table(f"fct_{body}_physiological_cycles", body, cycles)

        dates = self._table("dim_dates", "dates", marts.dim_dates(fact, calendar_end))
        self._table("data_check", "semantic", marts.data_check(dates, sleeps, workouts, fact, self.names))
        return self.models
