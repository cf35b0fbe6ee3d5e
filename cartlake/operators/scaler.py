"""Scaling by mean and population deviation, as a stage of ``pyspark.ml`` pipelines."""

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def moments(frame: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, 1 where it is 0: one row to the driver."""
    row = frame.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in columns],
    ).first()
    return {c: (row[f"mean_{c}"] or 0.0, row[f"std_{c}"] or 1.0) for c in columns}


class PopulationScaler(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / deviation, the deviation being that of the rows themselves, not of a
    population they were drawn from; a column that never varies is only centred. Nulls stay."""

    def __init__(self, inputCols: list[str] | None = None, outputCols: list[str] | None = None):  # noqa: N803
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols, outputCols=outputCols)

    def _fit(self, dataset: DataFrame) -> "PopulationScalerModel":
        columns = self.getInputCols()
        found = moments(dataset, columns)
        model = PopulationScalerModel()
        return model._set(
            inputCols=columns, outputCols=self.getOutputCols(),
            means=[found[c][0] for c in columns], deviations=[found[c][1] for c in columns],
        )


class PopulationScalerModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "mean per column", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "population deviation per column", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.means), self.getOrDefault(self.deviations))
        return dataset.withColumns({out: (F.col(c) - F.lit(mean)) / F.lit(std) for c, out, mean, std in names})
