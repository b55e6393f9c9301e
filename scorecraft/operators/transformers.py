"""Pipeline stages of the library's own.

``ScorecardBinner`` fits what a scorecard does to raw columns (level groups,
transforms, bin edges, low-cardinality levels) and gives a
``ScorecardBinnerModel``, a transformer like any other of ``pyspark.ml``: a saved
pipeline holds its binning and needs nothing beside it. The fitted tables (edges,
levels, groups) are parquet below the stage's folder, as a group map has one row
per training level.

``L1Logit`` is the logit whose constant is penalised too (the reference's), fitted by
``gram.l1_logit``; its model is the coefficients.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
                             MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import MISSING_BIN
from ..sources.io import save_stage
from . import binning as B
from . import prep as P
from .gram import l1_logit


class _BinnerParams(Params):
    numeric = Param(Params._dummy(), "numeric", "numeric columns", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "string columns", TypeConverters.toListString)
    label = Param(Params._dummy(), "label", "0/1 label of the monotonic search", TypeConverters.toString)
    binned = Param(Params._dummy(), "binned", "whether numeric columns become bins", TypeConverters.toBoolean)
    bins = Param(Params._dummy(), "bins", "bins of a column (B2)", TypeConverters.toInt)
    method = Param(Params._dummy(), "method", "quantile (B2) or monotonic (B3)", TypeConverters.toString)
    maxBins = Param(Params._dummy(), "maxBins", "most bins of the monotonic search", TypeConverters.toInt)
    cutoff = Param(Params._dummy(), "cutoff", "what the rank correlation may lack of 1", TypeConverters.toFloat)
    lowCardinality = Param(Params._dummy(), "lowCardinality", "columns of at most so many values keep them (B4)", TypeConverters.toInt)
    quantiles = Param(Params._dummy(), "quantiles", "exact or approx", TypeConverters.toString)
    customEdges = Param(Params._dummy(), "customEdges", "edges by column (B5)")
    groups = Param(Params._dummy(), "groups", "level groups by column (P19)")
    transforms = Param(Params._dummy(), "transforms", "log, sqrt or reciprocal by column (P20)")


class ScorecardBinner(Estimator, _BinnerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits bins, levels and groups on the frame it is given (training rows)."""

    @keyword_only
    def __init__(self, *, numeric=None, categorical=None, label="y", binned=True, bins=5, method="quantile", maxBins=20,
                 cutoff=0.001, lowCardinality=5, quantiles="exact", customEdges=None, groups=None, transforms=None):
        super().__init__()
        self._setDefault(numeric=[], categorical=[], label="y", binned=True, bins=5, method="quantile", maxBins=20, cutoff=0.001,
                         lowCardinality=5, quantiles="exact", customEdges={}, groups={}, transforms={})
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> "ScorecardBinnerModel":
        get = self.getOrDefault
        maps = {c: save_stage(P.category_map(df, c, m), f"category_map_{c}") for c, m in get("groups").items()}
        base = df
        for c, m in maps.items():
            base = P.group_categories(base, c, m)
        if get("transforms"):
            base = P.transform_numeric(base, get("transforms"))
        edges, low = {}, {}
        if get("binned"):
            fit = [c for c in get("numeric") if c not in get("customEdges")]
            if fit:
                found = B.low_cardinality_levels(base, fit, get("lowCardinality")).where("low_cardinality")
                low = {r["feature"]: list(r["levels"] or []) for r in found.collect()}
                fit = [c for c in fit if c not in low]
            if fit and get("method") == "monotonic":
                edges = B.edges_dict(B.monotonic_edges(base, fit, get("label"), get("maxBins"), get("bins"), get("cutoff"), get("quantiles")))
            elif fit:
                edges = B.edges_dict(B.forced_edges(base, fit, get("bins"), method=get("quantiles")))
            edges.update({c: B.round_edges(sorted(set(v))) for c, v in get("customEdges").items()})
        model = ScorecardBinnerModel(edges=edges, levels=low, maps=maps)
        return self._copyValues(model)


class ScorecardBinnerModel(Model, _BinnerParams, MLReadable, MLWritable):
    """Replays P19, P20, B6 with P18 or P17, and the categorical fill on any frame."""

    def __init__(self, edges=None, levels=None, maps=None):
        super().__init__()
        self.edges, self.levels, self.maps = dict(edges or {}), dict(levels or {}), dict(maps or {})

    @property
    def columns(self) -> list[str]:
        """Columns that are levels after the transform, bins first."""
        return [*self.edges, *self.levels, *self.getOrDefault("categorical")]

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c, m in self.maps.items():
            out = P.group_categories(out, c, m)
        if self.getOrDefault("transforms"):
            out = P.transform_numeric(out, self.getOrDefault("transforms"))
        if self.getOrDefault("binned"):
            out = B.apply_bins(out, self.edges, include_lowest=True, missing_bin=MISSING_BIN)
            out = out.withColumns({c: F.col(c).cast("string") for c in self.edges})
            out = out.withColumns({c: F.coalesce(F.col(c).cast("double").cast("string"), F.lit(str(MISSING_BIN))) for c in self.levels})
        else:
            out = P.fill_unbinned_numeric(out, self.getOrDefault("numeric"))
        return P.impute_categorical(out, self.getOrDefault("categorical"))

    def write(self) -> MLWriter:
        return _BinnerWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _BinnerReader()


class _BinnerWriter(MLWriter):
    def __init__(self, model: ScorecardBinnerModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark, m = SparkSession.getActiveSession(), self.model
        DefaultParamsWriter.saveMetadata(m, path, spark)
        numbers = [(kind, f, [float(x) for x in v]) for kind, table in (("edges", m.edges), ("levels", m.levels)) for f, v in table.items()]
        spark.createDataFrame(numbers, "kind string, feature string, numbers array<double>").write.parquet(f"{path}/bins")
        names = sorted(m.maps)
        spark.createDataFrame([(c,) for c in names], "feature string").write.parquet(f"{path}/mapped")
        for i, c in enumerate(names):
            m.maps[c].write.parquet(f"{path}/map_{i}")


class _BinnerReader(MLReader):
    def load(self, path: str) -> ScorecardBinnerModel:
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        tables: dict = {"edges": {}, "levels": {}}
        for r in spark.read.parquet(f"{path}/bins").collect():
            tables[r["kind"]][r["feature"]] = list(r["numbers"])
        names = sorted(r["feature"] for r in spark.read.parquet(f"{path}/mapped").collect())
        model = ScorecardBinnerModel(tables["edges"], tables["levels"], {c: spark.read.parquet(f"{path}/map_{i}") for i, c in enumerate(names)})
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class _LogitParams(Params):
    features = Param(Params._dummy(), "features", "vector column", TypeConverters.toString)
    label = Param(Params._dummy(), "label", "0/1 label", TypeConverters.toString)
    alpha = Param(Params._dummy(), "alpha", "weight of the L1 norm against the summed loss", TypeConverters.toFloat)
    penaliseConstant = Param(Params._dummy(), "penaliseConstant", "whether the constant is in the norm", TypeConverters.toBoolean)
    values = Param(Params._dummy(), "values", "fitted coefficients, the constant first", TypeConverters.toListFloat)


class L1Logit(Estimator, _LogitParams, DefaultParamsReadable, DefaultParamsWritable):
    """M9 with the constant penalised as well."""

    @keyword_only
    def __init__(self, *, features="features", label="y", alpha=0.8, penaliseConstant=True):
        super().__init__()
        self._setDefault(features="features", label="y", alpha=0.8, penaliseConstant=True)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "L1LogitModel":
        rows = df.select(vector_to_array(self.getOrDefault("features")).alias("x"), F.col(self.getOrDefault("label")).cast("double").alias("y"))
        first = rows.first()
        beta, _ = l1_logit(rows, len(first["x"]) if first else 0, self.getOrDefault("alpha"), self.getOrDefault("penaliseConstant"))
        return self._copyValues(L1LogitModel()._set(values=[float(b) for b in beta]))


class L1LogitModel(Model, _LogitParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` and ``prediction`` as Spark's own classifiers do."""

    def __init__(self):
        super().__init__()
        self._setDefault(features="features", label="y", alpha=0.8, penaliseConstant=True, values=[0.0])

    @property
    def intercept(self) -> float:
        return self.getOrDefault("values")[0]

    @property
    def coefficients(self):
        return Vectors.dense(self.getOrDefault("values")[1:])

    def _transform(self, df: DataFrame) -> DataFrame:
        const, *rest = self.getOrDefault("values")
        terms = F.zip_with(vector_to_array(self.getOrDefault("features")), F.array(*map(F.lit, rest)), lambda x, b: x * b)
        z = F.aggregate(terms, F.lit(const), lambda a, t: a + t) if rest else F.lit(const)
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
        return (df.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - p, p)))
                .withColumn("prediction", (vector_to_array("probability")[1] > 0.5).cast("double")))
