"""Feature encoding with Spark ML transformers: ordinal codes, one-hot
dummies (all levels kept), vector assembly and class weights.

Encoders are fitted once (on training data) and applied to any table, so
train, validation and test share one level dictionary. Fitting collects only
the distinct levels of each categorical column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep.operators.ordering import with_row_index


def ordinal_model(df: DataFrame, cols: Sequence[str], suffix: str = "_idx"):
    """StringIndexer over all ``cols`` in one fit (levels sorted by text)."""
    idx = StringIndexer(inputCols=list(cols), outputCols=[c + suffix for c in cols],
                        stringOrderType="alphabetAsc", handleInvalid="keep")
    return idx.fit(df)


def ordinal(df: DataFrame, cols: Sequence[str], suffix: str = "_code",
            model=None) -> DataFrame:
    """1-based codes of the sorted levels (as R factor codes); unseen or null
    values get ``n_levels + 1``."""
    model = model or ordinal_model(df, cols)
    out = model.transform(df)
    return out.withColumns({c + suffix: (F.col(c + "_idx") + 1).cast("int") for c in cols}) \
        .drop(*[c + "_idx" for c in cols])


def level_codes(df: DataFrame, col: str) -> DataFrame:
    """(level, code) of a column of any number of levels: 1-based codes of the
    sorted distinct values, as a table that never leaves the executors."""
    levels = df.select(F.col(f"`{col}`").alias("level")).where(F.col("level").isNotNull()).distinct()
    return with_row_index(levels, ["level"], "code")


def ordinal_by_table(df: DataFrame, col: str, codes: DataFrame, suffix: str = "_code") -> DataFrame:
    """:func:`ordinal` by a join with :func:`level_codes`; unseen and null
    values get ``n_levels + 1``. Nulls get keys of their own, so they spread."""
    top = codes.agg((F.count(F.lit(1)) + 1).alias("top")).select("top").scalar()
    apart = F.concat(F.lit("\0"), F.monotonically_increasing_id().cast("string"))
    keyed = df.withColumn("__k", F.coalesce(F.col(f"`{col}`").cast("string"), apart))
    j = keyed.join(codes.select(F.col("level").cast("string").alias("__level"), F.col("code").alias("__code")),
                   F.col("__k") == F.col("__level"), "left")
    return j.withColumn(col + suffix, F.coalesce("__code", top).cast("int")).drop("__k", "__level", "__code")


class Dummies:
    """One 0/1 column per level of each categorical column (no reference
    level dropped); other columns pass through."""

    def __init__(self, cols: Sequence[str], sep: str = "_"):
        self.cols, self.sep = list(cols), sep
        self.model: PipelineModel | None = None
        self.levels: dict[str, list[str]] = {}

    def fit(self, df: DataFrame) -> Dummies:
        idx = StringIndexer(inputCols=self.cols, outputCols=[c + "__i" for c in self.cols],
                            stringOrderType="alphabetAsc", handleInvalid="keep")
        ohe = OneHotEncoder(inputCols=[c + "__i" for c in self.cols],
                            outputCols=[c + "__v" for c in self.cols], dropLast=True,
                            handleInvalid="keep")
        self.model = Pipeline(stages=[idx, ohe]).fit(df)
        self.levels = dict(zip(self.cols, self.model.stages[0].labelsArray))
        return self

    def names(self) -> list[str]:
        return [f"{c}{self.sep}{lv}" for c in self.cols for lv in self.levels[c]]

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(df)
        exprs = []
        for c in self.cols:
            arr = vector_to_array(F.col(c + "__v"))
            for i, lv in enumerate(self.levels[c]):
                exprs.append(arr[i].cast("int").alias(f"{c}{self.sep}{lv}"))
        keep = [F.col(f"`{c}`") for c in df.columns if c not in self.cols]
        return out.select(*keep, *exprs)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Numeric columns -> one vector column (nulls are an error: impute first)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out,
                           handleInvalid="error").transform(df)


def disassemble(df: DataFrame, vec: str, names: Sequence[str]) -> DataFrame:
    arr = vector_to_array(F.col(vec))
    return df.select(*[c for c in df.columns if c != vec],
                     *[arr[i].alias(n) for i, n in enumerate(names)])


def binary_label(col, positive: str = "YES") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return (c == positive).cast("int")


def class_weight(col, weights: dict, default: float = 1.0) -> Column:
    """Per-row weight from the class label (e.g. NO=1.5, YES=3.5)."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for k, w in weights.items():
        expr = F.when(c == k, F.lit(float(w))) if expr is None else expr.when(c == k, F.lit(float(w)))
    return expr.otherwise(F.lit(float(default)))
