"""``feature_transform``: all risk features in one projection."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from ..functions.features import feature_columns

DERIVED = ["bmi_category", "age_risk", "age_bmi_interaction", "medical_risk_score",
           "metabolic_score", "smoking_risk", "lifestyle_score", "age_hypertension",
           "age_heart_disease", "cardio_metabolic_risk", "combined_risk_score"]


def feature_transform(df: DataFrame, cfg: dict | None = None, **columns) -> DataFrame:
    """Append the eleven derived risk features (a single ``withColumns``)."""
    return df.withColumns(feature_columns(cfg=cfg, **columns))


class RiskFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage form of :func:`feature_transform`."""

    ageRiskThreshold = Param(Params._dummy(), "ageRiskThreshold", "age risk threshold",
                             typeConverter=TypeConverters.toFloat)
    glucoseRiskThreshold = Param(Params._dummy(), "glucoseRiskThreshold", "glucose threshold",
                                 typeConverter=TypeConverters.toFloat)
    hba1cRiskThreshold = Param(Params._dummy(), "hba1cRiskThreshold", "HbA1c threshold",
                               typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, ageRiskThreshold=40.0, glucoseRiskThreshold=140.0, hba1cRiskThreshold=5.7):
        super().__init__()
        self._setDefault(ageRiskThreshold=40.0, glucoseRiskThreshold=140.0, hba1cRiskThreshold=5.7)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return feature_transform(df, cfg={
            "age_risk_threshold": self.getOrDefault(self.ageRiskThreshold),
            "glucose_risk_threshold": self.getOrDefault(self.glucoseRiskThreshold),
            "HbA1c_risk_threshold": self.getOrDefault(self.hba1cRiskThreshold),
        })
