"""Feature transformers: fit on train, apply anywhere.

* ``PopulationScaler`` (T1): (x - mean) / population std; a constant column
  is centred with scale 1.  ML ``StandardScaler`` divides by the n-1 std and
  maps constants to 0, so this is an Estimator of our own (one aggregate to
  fit, plain column arithmetic to apply, persisted with the pipeline).
* ``MedianImputer`` (T4): NULL -> exact column median (ML ``Imputer``'s
  median is approximate).
* one-hot (T2): categories in order, numbered in a table (``categories.CategoryEncoder``); unknown values give
  the zero vector; NULL becomes a sentinel category first, as the source encoder gives NULL
  a column of its own.
* ``tabular_pipeline`` (T3): numerics scaled, categoricals one-hot, then one
  vector; ``feature_names`` is the table of its ``num__c`` / ``cat__c_v`` names.
* TF-IDF (T5): lower-case word tokens of >= 2 chars, 1- and 2-grams, the
  5,000 terms with the highest corpus count (ties by term), smooth idf
  ln((1+n)/(1+df)) + 1, L2-normalised rows.
* T6: ``PipelineModel`` ``save`` / ``load``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import (CountVectorizerModel, ElementwiseProduct, NGram, Normalizer, RegexTokenizer, SQLTransformer,
                                VectorAssembler)
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .categories import CategoryEncoder, feature_names  # noqa: F401
from .quantiles import Stat, quantiles

NULL_TOKEN = "__null__"
EMPTY_TOKEN = "__empty__"
TOKEN_PATTERN = r"(?U)\b\w\w+\b"


# ---------------------------------------------------------------- T1


class _ScalerParams(HasInputCols, HasOutputCols):
    means = Param(Params._dummy(), "means", "fitted means", typeConverter=TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "fitted scales", typeConverter=TypeConverters.toListFloat)


class PopulationScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Standardise with the population std (constant column -> scale 1)."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "PopulationScalerModel":
        cols = self.getInputCols()
        row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
                     *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)]).first()
        means = [float(row[f"m{i}"] or 0.0) for i in range(len(cols))]
        scales = [float(s) if s not in (None, 0.0) and not math.isnan(s) else 1.0
                  for s in (row[f"s{i}"] for i in range(len(cols)))]
        m = PopulationScalerModel(inputCols=cols, outputCols=self.getOutputCols())
        return m._set(means=means, scales=scales)


class PopulationScalerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        cols, outs = self.getInputCols(), self.getOutputCols()
        ms, ss = self.getOrDefault(self.means), self.getOrDefault(self.scales)
        return df.withColumns({o: (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
                               for c, o, m, s in zip(cols, outs, ms, ss)})


# ---------------------------------------------------------------- T4


class _ImputerParams(HasInputCols, HasOutputCols):
    medians = Param(Params._dummy(), "medians", "fitted medians", typeConverter=TypeConverters.toListFloat)


class MedianImputer(Estimator, _ImputerParams, DefaultParamsReadable, DefaultParamsWritable):
    """T4 (first half): NULL -> the exact median of the training column."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "MedianImputerModel":
        cols = self.getInputCols()
        meds = quantiles(df, [Stat(c, 0.5, "cont") for c in cols])
        m = MedianImputerModel(inputCols=cols, outputCols=self.getOutputCols())
        return m._set(medians=[float("nan") if v is None else float(v) for v in meds])


class MedianImputerModel(Model, _ImputerParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c, o, m in zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.medians)):
            x = F.col(c).cast("double") if c in df.columns else F.lit(0.0)  # absent column -> 0.0
            out = out.withColumn(o, F.coalesce(x, F.lit(None if math.isnan(m) else m).cast("double")))
        return out


# ---------------------------------------------------------------- T2 / T3


def null_sentinel(cols: Sequence[str]) -> SQLTransformer:
    """String casts with NULL and '' as categories of their own (one-hot parity;
    ML attribute names cannot be empty)."""
    keep = ", ".join(f"CASE WHEN `{c}` IS NULL THEN '{NULL_TOKEN}' WHEN CAST(`{c}` AS STRING) = '' "
                     f"THEN '{EMPTY_TOKEN}' ELSE CAST(`{c}` AS STRING) END AS `_cat_{c}`" for c in cols)
    return SQLTransformer(statement=f"SELECT *, {keep} FROM __THIS__" if cols else "SELECT * FROM __THIS__")


def tabular_pipeline(numeric: Sequence[str], categorical: Sequence[str], output: str = "features",
                     scale: bool = True, impute: bool = False, missing: float | None = None) -> Pipeline:
    """Numerics (imputed / scaled), categoricals one-hot, remainder dropped, one vector.

    ``missing``: value for a numeric that is still NULL after scaling (model
    input: Spark's tree learners take no NaN; 0.0 is the training mean).
    """
    stages = []
    num_in = list(numeric)
    if impute and num_in:
        stages.append(MedianImputer(inputCols=num_in, outputCols=[f"_imp_{c}" for c in num_in]))
        num_in = [f"_imp_{c}" for c in num_in]
    if scale and num_in:
        stages.append(PopulationScaler(inputCols=num_in, outputCols=[f"num__{c}" for c in numeric]))
        num_out = [f"num__{c}" for c in numeric]
    else:
        num_out = num_in
    if missing is not None and num_out:
        fill = ", ".join(f"coalesce(CAST(`{c}` AS DOUBLE), {float(missing)!r}) AS `_fill_{c}`" for c in num_out)
        stages.append(SQLTransformer(statement=f"SELECT *, {fill} FROM __THIS__"))
        num_out = [f"_fill_{c}" for c in num_out]
    if categorical:
        stages.append(null_sentinel(categorical))
        stages.append(CategoryEncoder(inputCols=[f"_cat_{c}" for c in categorical], numericCols=num_out, outputCol=output))
    else:
        stages.append(VectorAssembler(inputCols=num_out, outputCol=output, handleInvalid="keep"))
    return Pipeline(stages=stages)


def save_pipeline(model: PipelineModel, path: str) -> None:
    """Persist the fitted preprocessor (input columns live in its stages)."""
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ---------------------------------------------------------------- T5


def terms(df: DataFrame, text: str = "nlp_text", out: str = "terms") -> DataFrame:
    """1- and 2-grams of lower-case word tokens (>= 2 word characters)."""
    tok = RegexTokenizer(inputCol="_text", outputCol="_tok", pattern=TOKEN_PATTERN, gaps=False,
                         toLowercase=True, minTokenLength=1)
    x = tok.transform(df.withColumn("_text", F.coalesce(F.col(text), F.lit(""))))
    x = NGram(n=2, inputCol="_tok", outputCol="_bi").transform(x)
    return x.withColumn(out, F.concat("_tok", "_bi")).drop("_text", "_tok", "_bi")


def term_table(docs: DataFrame, terms_col: str = "terms") -> DataFrame:
    """(term, tf, df): corpus count and document frequency of every term, each row a document.

    A document's terms count for tf and its distinct terms for df; both are summed by term in one aggregate, combined
    before the shuffle, so no (term, document) pair moves.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = F.array(F.struct(F.col(terms_col).alias("t"), one.alias("tf"), none.alias("df")),
                   F.struct(F.array_distinct(terms_col).alias("t"), none.alias("tf"), one.alias("df")))
    x = docs.select(F.explode(both).alias("x")).select(F.explode("x.t").alias("term"), "x.tf", "x.df")
    return x.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def fit_tfidf(train: DataFrame, text: str = "nlp_text", max_features: int = 5000,
              output: str = "tfidf") -> tuple[PipelineModel, DataFrame]:
    """T5: fit vocabulary + idf on ``train``; returns (model, vocabulary table).

    The vocabulary is the top ``max_features`` terms by (corpus count desc,
    term asc) -- a top-k, the only rows that reach the driver.
    """
    t = terms(train, text)
    n_docs = train.count()
    table = term_table(t)
    vocab_rows = table.orderBy(F.col("tf").desc(), F.col("term").asc()).limit(max_features).collect()
    vocab = [r["term"] for r in vocab_rows]
    idf = [math.log((1.0 + n_docs) / (1.0 + r["df"])) + 1.0 for r in vocab_rows]
    spark = train.sparkSession
    vocab_df = spark.createDataFrame([(i, r["term"], int(r["tf"]), int(r["df"]), idf[i])
                                      for i, r in enumerate(vocab_rows)],
                                     "idx int, term string, tf long, df long, idf double")
    tok = SQLTransformer(statement=f"SELECT *, coalesce(`{text}`, '') AS _text FROM __THIS__")
    stages = [tok,
              RegexTokenizer(inputCol="_text", outputCol="_tok", pattern=TOKEN_PATTERN, gaps=False,
                             toLowercase=True, minTokenLength=1),
              NGram(n=2, inputCol="_tok", outputCol="_bi"),
              SQLTransformer(statement="SELECT *, concat(_tok, _bi) AS _terms FROM __THIS__"),
              CountVectorizerModel.from_vocabulary(vocab or ["__empty__"], inputCol="_terms", outputCol="_tf"),
              ElementwiseProduct(scalingVec=Vectors.dense(idf or [0.0]), inputCol="_tf", outputCol="_tfidf"),
              Normalizer(p=2.0, inputCol="_tfidf", outputCol=output),
              SQLTransformer(statement="SELECT * EXCEPT (_text, _tok, _bi, _terms, _tf, _tfidf) FROM __THIS__")]
    return PipelineModel(stages=stages), vocab_df
