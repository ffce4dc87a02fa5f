"""Query registration and the inputs the queries share."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight import fixed_values as fv
from wardlight.catalogue import oracle
from wardlight.functions.exact import round6
from wardlight.ml import split, train
from wardlight.plans import features, marts, scores, staging
from wardlight.sources import adapter
from wardlight.workspace import in_parallel, stage, stage_path


class Inputs:
    """Tables of one data folder; derived tables are built on first use and stored.

    The marts are stored tables that other queries read, as in any warehouse.
    The queries that are the marts themselves build them anew on every call.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = adapter.read(self.spark, self.folder, name)
        return self._tables[name]

    def raw(self, view: str) -> DataFrame:
        sql = adapter.VIEWS[view]
        used = {t: self.table(t) for t in adapter.TABLES if "{" + t + "}" in sql}
        return self.spark.sql(sql, **used)

    # -- lazy staging tables
    @property
    def hospitals(self) -> DataFrame:
        return staging.hospitals(self.raw("hospitals_general"))

    @property
    def readmissions(self) -> DataFrame:
        return staging.readmissions(self.raw("hospitals_readmissions"))

    @property
    def experience(self) -> DataFrame:
        return staging.patient_experience(self.raw("hospitals_patient_experience"))

    @property
    def timely(self) -> DataFrame:
        return staging.timely_care(self.raw("hospitals_timely_care"))

    @property
    def counties(self) -> DataFrame:
        return staging.community_health(self.raw("cdc_places_county"))

    # -- fresh builds
    def build_scores(self) -> DataFrame:
        return scores.hospital_scores(self.hospitals, self.readmissions, self.experience, self.timely)

    def build_community(self) -> DataFrame:
        scored, states = in_parallel(self.spark, self.build_scores, lambda: scores.state_health(self.counties))
        return scores.community_risk(scored, states)

    def build_performance(self) -> DataFrame:
        return marts.hospital_performance(self.build_community())

    # -- stored tables
    @cached_property
    def performance(self) -> DataFrame:
        return stage(self.build_performance(), "mart_hospital_performance")

    @cached_property
    def risk(self) -> DataFrame:
        return stage(marts.readmission_risk(self.performance), "mart_readmission_risk")

    @cached_property
    def regions(self) -> DataFrame:
        return stage(marts.regional_summary(self.performance), "mart_regional_summary")

    @cached_property
    def _features(self) -> tuple[DataFrame, dict[str, float]]:
        matrix, medians = features.feature_matrix(self.performance)
        return stage(matrix, "features"), medians

    @property
    def features(self) -> DataFrame:
        return self._features[0]

    @cached_property
    def risk_training(self) -> tuple[train.Fitted, DataFrame]:
        """The classifier, tuned over the whole grid on the train part, and the part held out."""
        rows, held = split.split(self.features, "provider_id", strata="readmission_risk_label")
        cols = features.numeric_features(self.features)
        return train.fit_classifier(rows, cols, "readmission_risk_label", "provider_id", grid=fv.CLASSIFIER_GRID), held

    @cached_property
    def quality_training(self) -> tuple[train.Fitted, DataFrame]:
        """The regressor, tuned over the whole grid on the train part, and the part held out."""
        rows, held = (stage(part, "split") for part in split.split(self.features, "provider_id"))
        cols = features.numeric_features(self.features, ["composite_quality_score"])
        return train.fit_regressor(rows, cols, "composite_quality_score", "provider_id", grid=fv.REGRESSOR_GRID), held

    @property
    def risk_model(self) -> train.Model:
        return self.risk_training[0].model

    @property
    def quality_model(self) -> train.Model:
        return self.quality_training[0].model

    @property
    def models(self) -> tuple[train.Model, train.Model]:
        """Classifier and regressor, trained side by side: the last tasks of one leave cores to the other."""
        self.features
        in_parallel(self.spark, lambda: self.risk_training, lambda: self.quality_training)
        return self.risk_model, self.quality_model

    @cached_property
    def stored_models(self) -> dict[str, str]:
        """Folders of both models, written."""
        path = stage_path(self.spark, "models")
        folders = {"readmission_classifier": f"{path}/readmission_classifier", "quality_regressor": f"{path}/quality_regressor"}
        for model, folder in zip(self.models, folders.values()):
            model.save(self.spark, folder)
        return folders

    @property
    def medians(self) -> dict[str, float]:
        return self._features[1]


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Inputs], DataFrame]
    sql: str | None
    doubles: tuple[str, ...]

    def run(self, inputs: Inputs) -> DataFrame:
        """The query's rows, doubles at six decimals so both engines print the same."""
        df = self.build(inputs)
        return df.select(*[round6(F.col(c)).alias(c) if c in self.doubles else F.col(c) for c in df.columns])

    def oracle(self) -> str | None:
        return None if self.sql is None else oracle.complete(self.sql, self.doubles)


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, doubles: Sequence[str] = ()):
    def register(build: Callable[[Inputs], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(name, build, sql, tuple(doubles))
        return build
    return register


_inputs: dict[tuple[str, str], Inputs] = {}


def inputs_for(spark: SparkSession, folder: str) -> Inputs:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _inputs:
        _inputs[key] = Inputs(spark, folder)
    return _inputs[key]
