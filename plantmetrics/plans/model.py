"""The model graph: raw sources -> staging -> facts -> marts, as lazy DataFrames.

Each attribute is a DataFrame built on first access and memoised as a *plan* (not
data): touching ``oee_daily`` builds one logical plan from the scans up, which Catalyst
optimises as a whole. Staging and marts run nothing until used. ``numbered_history`` (ids),
``at_risk_stored`` and ``similar_failures`` (matches) run checkpoint jobs when they are first touched.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from plantmetrics.operators import health, oee, staging
from plantmetrics.params import DEFAULT, Params
from plantmetrics.sources.readers import Source


class Model:
    def __init__(self, spark: SparkSession, source: Source, params: Params = DEFAULT):
        self.spark = spark
        self.source = source
        self.params = params

    def using(self, **tables: DataFrame) -> "Model":
        """Use stored tables for some models (e.g. ``oee_daily=spark.read.parquet(...)``);
        everything downstream is then built on top of them."""
        for name, df in tables.items():
            if not isinstance(getattr(type(self), name, None), cached_property):
                raise AttributeError(f"no model named {name}")
            self.__dict__[name] = df
        return self

    # staging ---------------------------------------------------------------------------
    @cached_property
    def stg_machines(self) -> DataFrame:
        return staging.stg_machines(self.source.table("machines"))

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.source.table("production_orders"))

    @cached_property
    def stg_defects(self) -> DataFrame:
        return staging.stg_defects(self.source.table("defects"))

    @cached_property
    def stg_sensor(self) -> DataFrame:
        return staging.stg_sensor(self.source.table("sensor_readings"))

    @cached_property
    def stg_downtime(self) -> DataFrame:
        return staging.stg_downtime(self.source.table("downtime_events"))

    @cached_property
    def recommendations_raw(self) -> DataFrame:
        return self.source.table("maintenance_recommendations")

    # intermediate ------------------------------------------------------------------------
    @cached_property
    def availability(self) -> DataFrame:
        return oee.availability(self.stg_orders, self.stg_downtime)

    @cached_property
    def performance(self) -> DataFrame:
        return oee.performance(self.stg_orders, self.stg_machines, self.availability)

    @cached_property
    def quality(self) -> DataFrame:
        return oee.quality(self.stg_orders, self.stg_defects)

    # marts ---------------------------------------------------------------------------
    @cached_property
    def oee_daily(self) -> DataFrame:
        return oee.oee_daily(self.stg_machines, self.stg_orders, self.stg_downtime, self.stg_defects)

    @cached_property
    def machine_health(self) -> DataFrame:
        return health.machine_health(self.stg_sensor, self.params)

    @cached_property
    def production_summary(self) -> DataFrame:
        return oee.production_summary(self.oee_daily)

    # trend / queue ------------------------------------------------------------------------
    @cached_property
    def oee_trend(self) -> DataFrame:
        from plantmetrics.operators import trend
        return trend.oee_trend_7d(self.oee_daily, self.params)

    @cached_property
    def latest_health(self) -> DataFrame:
        from plantmetrics.operators import trend
        return trend.latest_health(self.machine_health, self.params)

    @cached_property
    def at_risk_machines(self) -> DataFrame:
        from plantmetrics.operators import trend
        return trend.at_risk_machines(self.stg_machines, self.machine_health, self.oee_trend, self.params)

    @cached_property
    def maintenance_queue(self) -> DataFrame:
        from plantmetrics.operators import recommend
        return recommend.maintenance_queue(self.stg_machines, self.machine_health, self.oee_daily,
                                           self.recommendations_raw, self.params)

    # retrieval / recommendations -------------------------------------------------------------
    @cached_property
    def failure_history(self) -> DataFrame:
        from plantmetrics.operators import retrieval
        return retrieval.failure_history(self.source.table("downtime_events"), self.stg_machines,
                                         self.machine_health, self.oee_daily, self.params)

    @cached_property
    def numbered_history(self) -> DataFrame:
        from plantmetrics.operators import retrieval
        return retrieval.numbered_history(self.failure_history)

    @cached_property
    def failure_patterns(self) -> DataFrame:
        from plantmetrics.operators import retrieval
        return retrieval.failure_patterns(self.numbered_history, self.source.pattern_vectors)

    @cached_property
    def at_risk_stored(self) -> DataFrame:
        """The at-risk machines, worked out once for all that is made from them."""
        from plantmetrics.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(self.spark)
        return self.at_risk_machines.checkpoint()

    @cached_property
    def query_vectors(self) -> DataFrame:
        return self.source.machine_vectors(self.at_risk_stored.select("machine_id"))

    @cached_property
    def similar_failures(self) -> DataFrame:
        from plantmetrics.operators import retrieval
        return retrieval.similar_failures(self.query_vectors, self.failure_patterns, self.params.top_k)

    @cached_property
    def validated_responses(self) -> DataFrame:
        from plantmetrics.operators import recommend
        return recommend.validate_responses(self.source.table("responses"), self.params)

    @cached_property
    def fallback_recommendations(self) -> DataFrame:
        from plantmetrics.operators import recommend
        return recommend.fallback_recommendations(self.at_risk_stored, self.similar_failures, self.params)

    @cached_property
    def new_recommendations(self) -> DataFrame:
        from plantmetrics.operators import recommend
        return recommend.recommendations(self.at_risk_stored, self.similar_failures,
                                         self.validated_responses, self.params)

    @cached_property
    def prompts(self) -> DataFrame:
        from plantmetrics.operators import recommend
        return recommend.prompts(self.at_risk_stored, self.similar_failures)
