"""Fraud classifier with Spark ML.

One multi-column ``StringIndexer`` (one fitting pass for all 13 categorical
fields instead of 13; nulls and unseen values get their own index rather
than failing), a mean ``Imputer`` for missing numerics, a
``VectorAssembler`` and a logistic regression (10 iterations).  Train/test
rows are chosen by a seeded hash of the record key, so the split does not
change with partitioning.  The area under ROC is exact (ties count one
half) and computed by Spark over the whole test set (``fraudlens.ml.auc``).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import FeatureHasher, Imputer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.functions import is_fraud_str
from fraudlens.ml import auc
from fraudlens.operators.rows import split_frames
from fraudlens.schemas import ML_CATEGORICAL_FIELDS, ML_NUMERIC_FIELDS
from fraudlens.session import shared_dir

LABEL = "label"
MAX_ITER = 10
SPLIT = (0.8, 0.2)
SEED = 42


def with_label(df: DataFrame, label_col: str = "fraud_label") -> DataFrame:
    """Numeric label from the string form: "1" -> 1.0, anything else
    (including null) -> 0.0, the reports' "not fraud" reading."""
    return df.withColumn(LABEL, F.when(is_fraud_str(label_col), 1.0).otherwise(0.0))


def labelled_or_null(df: DataFrame, label_col: str = "fraud_label") -> DataFrame:
    """As ``with_label``, but a row without a label has none: it is neither
    trained on nor counted in the area under the curve."""
    return with_label(df, label_col).withColumn(LABEL, F.when(F.col(label_col).isNotNull(), F.col(LABEL)))


def build_pipeline(categorical=ML_CATEGORICAL_FIELDS, numeric=ML_NUMERIC_FIELDS,
                   max_iter: int = MAX_ITER, hashed=(), hash_features: int = 1 << 18) -> Pipeline:
    """``hashed`` names categorical fields with an open domain (vendors,
    brands, sites): they are hashed into ``hash_features`` slots, so that no
    list of their values is gathered on the driver or kept in the model.  The
    others are indexed by frequency."""
    cat = [c for c in categorical if c not in set(hashed)]
    num = list(numeric)
    idx = [f"{c}_index" for c in cat]
    imp = [f"{c}_imputed" for c in num]
    indexer = StringIndexer(inputCols=cat, outputCols=idx, handleInvalid="keep",
                            stringOrderType="frequencyDesc")
    imputer = Imputer(inputCols=num, outputCols=imp, strategy="mean")
    hasher = [FeatureHasher(inputCols=list(hashed), outputCol="hashed", numFeatures=hash_features,
                            categoricalCols=list(hashed))] if hashed else []
    assembler = VectorAssembler(inputCols=imp + idx + ["hashed"] * bool(hashed), outputCol="features",
                                handleInvalid="error")
    lr = LogisticRegression(featuresCol="features", labelCol=LABEL, maxIter=max_iter)
    return Pipeline(stages=[*([indexer] if cat else []), imputer, *hasher, assembler, lr])


def feature_frame(df: DataFrame, **kw) -> tuple[DataFrame, list[str]]:
    """``df`` with its assembled ``features`` and their names in order (not
    for ``hashed`` fields, whose slots have no names)."""
    stages = build_pipeline(**kw).getStages()[:-1]
    return Pipeline(stages=stages).fit(df).transform(df), stages[-1].getInputCols()


def feature_cells(df: DataFrame, keep=(), **kw) -> DataFrame:
    """The assembled vectors in long form: (feature, value) per row."""
    features, names = feature_frame(df, **kw)
    cells = F.arrays_zip(F.array(*map(F.lit, names)).alias("feature"), vector_to_array("features").alias("value"))
    return features.select(*keep, F.explode(cells).alias("c")).select(*keep, "c.feature", "c.value")


def logistic_gradient(df: DataFrame, names, coefficients, intercept: float, reg: float) -> DataFrame:
    """(feature, gradient): the gradient of the regularised mean log loss at
    the given coefficients, by the standardised features, in which the
    regression is fitted; all zero at the optimum.  ``df`` has ``features`` (a
    vector) and the label.  Two aggregates of one expression per feature."""
    rows = df.select(vector_to_array("features").alias("x"), F.col(LABEL).alias("y"))
    x = [F.col("x")[j] for j in range(len(names))]
    spread = rows.agg(*[F.stddev_samp(c).alias(f"s{j}") for j, c in enumerate(x)]).first()
    weights = F.array(*[F.lit(float(c)) for c in coefficients])
    margin = F.aggregate(F.zip_with("x", weights, lambda a, b: a * b), F.lit(float(intercept)), lambda a, b: a + b)
    error = rows.withColumn("e", 1.0 / (1.0 + F.exp(-margin)) - F.col("y"))
    total = error.agg(F.avg("e").alias("intercept"), *[F.avg(F.col("e") * c).alias(f"g{j}") for j, c in enumerate(x)])
    out = [F.struct(F.lit("(intercept)").alias("feature"), F.col("intercept").alias("gradient"))]
    for j, name in enumerate(names):
        s = float(spread[f"s{j}"] or 0.0)                # a constant feature has no gradient
        g = F.col(f"g{j}") / s + reg * s * float(coefficients[j]) if s else F.lit(0.0)
        out.append(F.struct(F.lit(name).alias("feature"), g.alias("gradient")))
    return total.select(F.explode(F.array(*out)).alias("r")).select("r.*")


def split(df: DataFrame, key_cols=("pq",), weights=SPLIT, seed: int = SEED):
    return split_frames(df, list(key_cols), weights, seed)


def fit(train: DataFrame, **kw) -> PipelineModel:
    """The fitted pipeline without the regression's training summary: that
    holds the session, which cannot be sent to the executors with the model
    once the session has used ``observe``."""
    model = build_pipeline(**kw).fit(train)
    model.stages[-1]._java_obj.setSummary(train.sparkSession._jvm.scala.Option.empty())
    return model


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Predictions with the fraud probability as a plain double column."""
    pred = model.transform(df)
    return pred.withColumn("fraud_score", vector_to_array("probability")[1])


def area_under_roc(df: DataFrame, score_col: str, label_col: str = LABEL) -> float:
    """Exact AUC (ties count one half), computed by Spark over the whole
    input (see ``fraudlens.ml.auc``)."""
    return auc.area_under_roc(df, score_col, label_col)


def train_and_score(records: DataFrame, key_cols=("pq",), seed: int = SEED, **kw):
    """80/20 split, fit on the labelled training rows, score all test rows;
    returns (model, test predictions).  Only the key, the inputs and the label
    are staged, once, as Parquet, so that the indexer, the imputer, the
    regression and the scoring each read the columns they need."""
    spark = records.sparkSession
    fields = list(dict.fromkeys([*key_cols, *ML_CATEGORICAL_FIELDS, *ML_NUMERIC_FIELDS]))
    narrow = labelled_or_null(records).select(*fields, LABEL)
    path = shared_dir(spark, "model-input")
    narrow.write.parquet(path)
    train, test = split(spark.read.schema(narrow.schema).parquet(path), key_cols, seed=seed)
    model = fit(train.where(F.col(LABEL).isNotNull()), **kw)
    return model, score(model, test)


def train_and_evaluate(records: DataFrame, key_cols=("pq",), seed: int = SEED, **kw):
    """``train_and_score`` and the test split's exact area under the curve."""
    model, pred = train_and_score(records, key_cols, seed, **kw)
    return model, pred, area_under_roc(pred, "fraud_score")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
