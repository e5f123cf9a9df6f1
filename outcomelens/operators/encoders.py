"""Pipeline stages of our own: exact medians for missing numbers, and one-hot levels held as a table.

Both are fitted with DataFrame jobs, transform with column expressions and joins, and are saved and loaded
with the pipeline they are part of.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomelens.operators.columns import quoted
from outcomelens.operators.levels import add_one_hot, level_table
from outcomelens.operators.quantiles import lower_medians


# Medians -----------------------------------------------------------------------


class _Imputation(HasInputCols, HasOutputCols):
    pass


class MedianImputer(Estimator, _Imputation, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the median of each input column: the observed value at rank ceil(n / 2), exactly."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = (), outputCols: Sequence[str] = ()):
        super().__init__()
        self._setDefault(inputCols=[], outputCols=[])
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> MedianImputerModel:
        inputs = self.getInputCols()
        found = {r["name"]: r["median"] for r in lower_medians(df, inputs).collect()} if inputs else {}
        model = MedianImputerModel()
        model._set(
            inputCols=inputs,
            outputCols=self.getOutputCols(),
            medians=[found.get(c, float("nan")) for c in inputs],
        )
        return model


class MedianImputerModel(Model, _Imputation, DefaultParamsReadable, DefaultParamsWritable):
    """Fills null and NaN with the learnt median; a column without any value stays null."""

    medians: Param = Param(Params._dummy(), "medians", "median per input column", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        filled = {}
        for name, out, median in zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.medians)):
            value = quoted(name).cast("double")
            known = F.when(~F.isnan(value), value)
            filled[out] = known if median != median else F.coalesce(known, F.lit(median))
        return df.withColumns(filled) if filled else df


# Levels ------------------------------------------------------------------------


class _Encoding(HasInputCols, HasOutputCol):
    numericCols: Param = Param(Params._dummy(), "numericCols", "numbers after the levels", TypeConverters.toListString)


class LevelEncoder(Estimator, _Encoding, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the levels of the input columns; see :mod:`outcomelens.operators.levels`."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = (), numericCols: Sequence[str] = (), outputCol: str = "features"):
        super().__init__()
        self._setDefault(inputCols=[], numericCols=[], outputCol="features")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> LevelEncoderModel:
        levels = level_table(df, self.getInputCols())
        model = LevelEncoderModel()
        model._set(
            inputCols=self.getInputCols(),
            numericCols=self.getOrDefault(self.numericCols),
            outputCol=self.getOutputCol(),
            width=levels.count(),
        )
        model.levels = levels
        return model


class LevelEncoderModel(Model, _Encoding, MLWritable, MLReadable):
    """One-hot levels and numbers as a sparse vector. ``levels`` is the stored table (column, level, n, slot)."""

    width: Param = Param(Params._dummy(), "width", "number of levels", TypeConverters.toInt)
    levels: DataFrame

    def _transform(self, df: DataFrame) -> DataFrame:
        return add_one_hot(
            df,
            self.levels,
            self.getOrDefault(self.width),
            self.getInputCols(),
            self.getOrDefault(self.numericCols),
            self.getOutputCol(),
        )

    def feature_names(self) -> DataFrame:
        """Rows (feature, name) for every place of the vector: ``column=level``, or the number's column."""
        spark, inputs = self.levels.sparkSession, self.getInputCols()
        named = F.element_at(F.array(*[F.lit(c) for c in inputs] or [F.lit("")]), F.col("column") + 1)
        hot = self.levels.select(
            F.col("slot").cast("int").alias("feature"), F.concat(named, F.lit("="), F.col("level")).alias("name")
        )
        width = self.getOrDefault(self.width)
        rest = [(width + j, c) for j, c in enumerate(self.getOrDefault(self.numericCols))]
        return hot.unionByName(spark.createDataFrame(rest, "feature int, name string"))

    def write(self) -> MLWriter:
        return _LevelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _LevelReader(cls)


class _LevelWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.levels.write.parquet(f"{path}/levels")


class _LevelReader(DefaultParamsReader):
    def load(self, path: str) -> LevelEncoderModel:
        model = super().load(path)
        model.levels = SparkSession.active().read.parquet(f"{path}/levels")
        return model
