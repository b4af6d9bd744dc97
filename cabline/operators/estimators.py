"""Feature design and linear models as pipeline stages that can be written and read.

``Design`` and ``PenalisedRegression`` are estimators, ``FittedDesign`` and ``LinearModel``
the transformers they give. What a fit has learned is a parameter of the transformer, so
that Spark's own writer and reader store it, alone or inside a ``Pipeline``, and a later job
applies it to later data. A tuner such as ``CrossValidator`` takes them like any stage.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabline.operators import linear as LN
from cabline.operators.features import BINARY, CATEGORICAL, INTERACTION, NUMERIC, Preprocessor
from cabline.operators.gram import collect_grams


def _param(name: str, doc: str, kind) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=kind)


class _DesignParams(Params):
    numeric = _param("numeric", "columns to scale", TypeConverters.toListString)
    categorical = _param("categorical", "columns to one-hot encode", TypeConverters.toListString)
    binary = _param("binary", "0/1 columns", TypeConverters.toListString)
    interaction = _param("interaction", "two scaled columns appended with their product, or none", TypeConverters.toListString)
    outputCol = _param("outputCol", "array of the design's columns", TypeConverters.toString)

    def preprocessor(self) -> Preprocessor:
        pair = tuple(self.getOrDefault("interaction"))
        return Preprocessor(tuple(self.getOrDefault("numeric")), tuple(self.getOrDefault("categorical")),
                            tuple(self.getOrDefault("binary")), pair if len(pair) == 2 else None)


class Design(Estimator, _DesignParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits ``features.Preprocessor`` on the rows it is given."""

    def __init__(self, **params):
        super().__init__()
        self._setDefault(numeric=list(NUMERIC), categorical=list(CATEGORICAL), binary=list(BINARY), interaction=list(INTERACTION), outputCol="x")
        self._set(**params)

    def _fit(self, df: DataFrame) -> FittedDesign:
        pre = self.preprocessor().fit(df)
        learned = json.dumps({"means": pre.means, "stds": pre.stds, "categories": pre.categories})
        return self._copyValues(FittedDesign(learned=learned))


class FittedDesign(Model, _DesignParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the design vector to rows; the rows keep their other columns."""

    learned = _param("learned", "means, deviations and categories as JSON", TypeConverters.toString)

    def __init__(self, **params):
        super().__init__()
        self._set(**params)

    def fitted(self) -> Preprocessor:
        pre = self.preprocessor()
        for k, v in json.loads(self.getOrDefault("learned")).items():
            setattr(pre, k, v)
        return pre

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOrDefault("outputCol"), F.array(*self.fitted().columns()))


def _values(df: DataFrame, x: str) -> Column:
    """The design's columns as an array."""
    return vector_to_array(F.col(x)) if isinstance(df.schema[x].dataType, VectorUDT) else F.col(x)


class _LinearParams(Params):
    kind = _param("kind", "Ridge, Lasso, ElasticNet or SGD", TypeConverters.toString)
    alpha = _param("alpha", "penalty", TypeConverters.toFloat)
    l1Ratio = _param("l1Ratio", "share of the penalty on absolute weights (ElasticNet)", TypeConverters.toFloat)
    solver = _param("solver", "gram: one pass of sufficient statistics; mllib: Spark's LinearRegression", TypeConverters.toString)
    featuresCol = _param("featuresCol", "array or vector of the design's columns", TypeConverters.toString)
    labelCol = _param("labelCol", "target", TypeConverters.toString)
    predictionCol = _param("predictionCol", "prediction", TypeConverters.toString)

    def _defaults(self):
        self._setDefault(kind="Ridge", alpha=1.0, l1Ratio=0.5, solver="gram", featuresCol="x", labelCol="y", predictionCol="prediction")


class PenalisedRegression(Estimator, _LinearParams, DefaultParamsReadable, DefaultParamsWritable):
    """Least squares with an unpenalised intercept and the penalty of its kind, in the
    objectives of ``linear.intercept_fit``. Rows without a target are left out. MLlib makes a
    vector of every array in each of its passes, so rows that it reads often should hold one."""

    def __init__(self, **params):
        super().__init__()
        self._defaults()
        self._set(**params)

    def _fit(self, df: DataFrame) -> LinearModel:
        x, y = self.getOrDefault("featuresCol"), self.getOrDefault("labelCol")
        known = df.where(F.col(y).isNotNull())
        kind, alpha, ratio = self.getOrDefault("kind"), self.getOrDefault("alpha"), self.getOrDefault("l1Ratio")
        if self.getOrDefault("solver") == "mllib":
            fit = LN.mllib_fit(known.select(F.col(x), F.col(y).cast("double").alias(y)), kind, x, y, alpha=alpha, l1_ratio=ratio)
        else:
            known = known.withColumn(x, _values(known, x))
            first = known.select(F.size(x).alias("p")).first()
            if first is None:
                raise ValueError("no rows with a target to fit on")
            fit = LN.intercept_fit(kind, collect_grams(known, first["p"], x=x, y=y)["all"], alpha=alpha, l1_ratio=ratio)
        return self._copyValues(LinearModel(weights=[float(w) for w in fit.weights], bias=float(fit.bias)))


class LinearModel(Model, _LinearParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds x . w + b."""

    weights = _param("weights", "weight of each design column", TypeConverters.toListFloat)
    bias = _param("bias", "intercept", TypeConverters.toFloat)

    def __init__(self, **params):
        super().__init__()
        self._defaults()
        self._set(**params)

    def as_fit(self) -> LN.LinearFit:
        return LN.LinearFit(self.getOrDefault("kind"), np.array(self.getOrDefault("weights")), self.getOrDefault("bias"),
                            {"alpha": self.getOrDefault("alpha"), "l1_ratio": self.getOrDefault("l1Ratio")})

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOrDefault("predictionCol"), LN.predict(self.as_fit(), _values(df, self.getOrDefault("featuresCol"))))
