"""Direction models on Spark ML: training, voting, comparison, tuning, persistence."""

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import add

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Window, functions as F
from pyspark.util import inheritable_thread_target

from tickloom.operators.features import feature_columns

# Settings of the compared models.
SEED = 42
TREES = 100
BOOST_ROUNDS = 100
BOOST_RATE = 0.05
MAX_ITER = 1000
# Depths are choices of this library: trees of the compared models grow without bound.
FOREST_DEPTH = 8
DEEP = 6
VOTERS = ("random_forest", "boosted_trees", "logistic_regression")
C_GRID = (0.01, 0.1, 1.0, 10.0, 100.0)
FOLDS = 5


def reg_param(c, rows):
    """Ridge strength equal to an inverse-regularisation C summed over ``rows`` losses."""
    return 1.0 / (c * rows)


def _assembled(columns):
    return VectorAssembler(inputCols=list(columns), outputCol="features_raw")


def _scaled():
    return StandardScaler(
        inputCol="features_raw", outputCol="features", withMean=True, withStd=True
    )


def logistic(columns, rows, c=1.0, label="target"):
    """Scaling sits inside the pipeline, so it is fitted on training rows only."""
    model = LogisticRegression(
        featuresCol="features", labelCol=label, maxIter=MAX_ITER,
        regParam=reg_param(c, rows), standardization=False,
    )
    return Pipeline(stages=[_assembled(columns), _scaled(), model])


def forest(columns, label="target"):
    """Trees to FOREST_DEPTH; Spark grows a tree level by level and has no unbounded depth."""
    model = RandomForestClassifier(
        featuresCol="features_raw", labelCol=label, numTrees=TREES, maxDepth=FOREST_DEPTH, seed=SEED
    )
    return Pipeline(stages=[_assembled(columns), model])


def boosted(columns, label="target", rounds=BOOST_ROUNDS, depth=5):
    model = GBTClassifier(
        featuresCol="features_raw", labelCol=label, maxIter=rounds, stepSize=BOOST_RATE, maxDepth=depth, seed=SEED
    )
    return Pipeline(stages=[_assembled(columns), model])


def all_models(columns, train_rows, label="target", rounds=BOOST_ROUNDS):
    return {
        "random_forest": forest(columns, label),
        "boosted_trees": boosted(columns, label, rounds),
        "boosted_trees_deep": boosted(columns, label, rounds, DEEP),
        "logistic_regression": logistic(columns, train_rows, label=label),
    }


def majority(votes):
    """Hard vote of 0/1 columns; more than half must say 1."""
    total = reduce(add, (F.col(v).cast("int") for v in votes))
    return (total * 2 > len(votes)).cast("int")


def fit_models(train, label="target", rounds=BOOST_ROUNDS):
    """All models, fitted side by side: each is a long chain of short jobs, which alone leaves most cores idle."""
    pipelines = all_models(feature_columns(train, (label,)), train.count(), label, rounds)
    with ThreadPoolExecutor(len(pipelines)) as pool:
        fits = {n: pool.submit(inheritable_thread_target(train.sparkSession)(p.fit), train) for n, p in pipelines.items()}
        return {n: fit.result() for n, fit in fits.items()}


def score(models, rows):
    """Predictions of every fitted model as 0/1 columns, plus the vote of VOTERS."""
    keep = rows.columns
    for name, model in models.items():
        scored = model.transform(rows)
        rows = scored.withColumn(name, F.col("prediction").cast("int")).select(*keep, name)
        keep = rows.columns
    return rows.withColumn("voting", majority(VOTERS))


def compare(scored, names, label="target"):
    """Accuracy of each prediction column, one row per model, in one pass."""
    hits = [F.avg((F.col(n) == F.col(label)).cast("int")).alias(n) for n in names]
    wide = scored.agg(*hits, F.count(F.lit(1)).alias("test_rows"))
    return wide.unpivot(["test_rows"], list(names), "model", "accuracy")


def ordered_folds(rows, folds=FOLDS, label="target", order="date"):
    """Add ``_fold``: per label, the rows in order cut into equal stretches (rows of one date stay together).

    Only counts per label and date are put in order, so no row is gathered.
    """
    days = rows.groupBy(label, order).agg(F.count(F.lit(1)).alias("_n"))
    along = Window.partitionBy(label).orderBy(order)
    before = F.coalesce(F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = F.sum("_n").over(Window.partitionBy(label))
    placed = days.select(label, order, F.floor(before * folds / whole).cast("int").alias("_fold"))
    return rows.join(placed, [label, order])


def grid_search(train, columns, rows, label="target", grid=C_GRID, folds=FOLDS, parallelism=4, order="date"):
    """Best C by accuracy over ordered, stratified folds; returns (best C, mean accuracy per C)."""
    pipeline = logistic(columns, rows, label=label)
    estimator = pipeline.getStages()[-1]
    params = ParamGridBuilder().addGrid(estimator.regParam, [reg_param(c, rows) for c in grid])
    fitted = _validator(pipeline, params.build(), folds, parallelism, label).fit(ordered_folds(train, folds, label, order))
    scores = dict(zip(grid, fitted.avgMetrics))
    return max(scores, key=scores.get), scores


def cross_val_score(train, pipeline, label="target", folds=FOLDS, parallelism=4, order="date"):
    """Mean accuracy over ordered, stratified folds."""
    validator = _validator(pipeline, ParamGridBuilder().build(), folds, parallelism, label)
    return validator.fit(ordered_folds(train, folds, label, order)).avgMetrics[0]


def _validator(pipeline, grid, folds, parallelism, label):
    accuracy = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    return CrossValidator(
        estimator=pipeline, estimatorParamMaps=grid, evaluator=accuracy,
        numFolds=folds, foldCol="_fold", parallelism=parallelism, seed=SEED,
    )


def save_model(model, path):
    model.write().overwrite().save(path)


def load_model(path):
    return PipelineModel.load(path)
