"""Metrics of this package as ``pyspark.ml`` evaluators, so that
CrossValidator and TrainValidationSplit choose by them."""
from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasProbabilityCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import functions as F

from .metrics import amex_metric


class AmexEvaluator(Evaluator, HasLabelCol, HasProbabilityCol, DefaultParamsReadable, DefaultParamsWritable):
    """AMEX metric (M1) of the probability of class 1; larger is better.
    ``idCol`` orders rows of equal probability.  0 where the metric is not
    defined (one class only)."""

    idCol = Param(Params._dummy(), "idCol", "unique row id", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, labelCol: str = "label", probabilityCol: str = "probability", idCol: str = "id"):
        super().__init__()
        self._setDefault(labelCol="label", probabilityCol="probability", idCol="id")
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset) -> float:
        label, key = self.getOrDefault(self.labelCol), self.getOrDefault(self.idCol)
        scored = dataset.select(F.col(key).alias("id"), F.col(label).cast("double").alias("y"),
                                vector_to_array(self.getOrDefault(self.probabilityCol))[1].alias("p"))
        got = amex_metric(scored, "y", "p", "id").first()["amex"]
        return 0.0 if got is None else float(got)

    def isLargerBetter(self) -> bool:
        return True
