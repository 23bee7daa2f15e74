"""Queries over the feature table and the direction models."""

from pyspark.sql import functions as F

from tickloom.operators import features, logit, models, summary
from tickloom.operators.averages import rolling_mean
from tickloom.operators.oscillators import add_rsi_partial
from tickloom.layout import over_series
from tickloom.plans import inputs
from tickloom.plans.q_indicators import PATTERN_NAMES, PATTERN_SQL, ROLLING, SIZED, strict_sql
from tickloom.plans.registry import query
from tickloom.session import scratch_path, stored

W = "(PARTITION BY pair ORDER BY date)"

FEATURES = (
    "pair date:d open:4 high:4 low:4 close:4 hl:4 oc:4 body:4 rsi:6 ema_12:4 ema_26:4 macd:4 bb_high:4 "
    "bb_low:4 stoch:6 "
    + " ".join(f"{n}:4" for n, _ in ROLLING)
    + " hour:i day_of_week:i prev_open:4 prev_close:4 "
    + " ".join(f"{n}:i" for n in PATTERN_NAMES.split())
    + " target:i"
)
FEATURES_SQL = f"""SELECT * FROM (
    SELECT p.*, CASE WHEN z.down = 0 THEN 100 ELSE 100 - 100 / (1 + z.up / z.down) END AS rsi,
      e.ema_12, e.ema_26, e.ema_12 - e.ema_26 AS macd, b.mid + 2 * b.sd AS bb_high, b.mid - 2 * b.sd AS bb_low,
      100 * (p.close - b.lo) / nullif(b.hi - b.lo, 0) AS stoch, {", ".join("b." + n for n, _ in ROLLING)},
      0 AS hour, isodow(p.date) - 1 AS day_of_week, b.target, e.rn
    FROM ({PATTERN_SQL}) p JOIN ema_run e USING (pair, date) JOIN wilder_run z USING (pair, date)
    JOIN (SELECT *, {strict_sql('avg', 20)} AS mid, {strict_sql('stddev_pop', 20)} AS sd,
            {strict_sql('min', 14, 'low')} AS lo, {strict_sql('max', 14, 'high')} AS hi,
            {", ".join(f"{s} AS {n}" for n, s in ROLLING)},
            CAST(coalesce(lead(close) OVER w > close, false) AS INTEGER) AS target
          FROM {SIZED} WINDOW w AS {W}) b USING (pair, date))
    WHERE rn >= 26 AND stoch IS NOT NULL"""


@query("ml_features", FEATURES, FEATURES_SQL)
def ml_features(spark, sf):
    return features.ml_features(inputs.bars(spark, sf))


SPLIT_SQL = f"""SELECT *, row_number() OVER {W} <= floor(0.8 * count(*) OVER (PARTITION BY pair)) AS is_train FROM bars"""


@query("time_split", "pair date:d is_train:b", SPLIT_SQL)
def time_split(spark, sf):
    return features.time_split(inputs.bars(spark, sf))


def scaled_sql(c):
    return f"({c} - avg({c}) FILTER (is_train) OVER ()) / stddev_samp({c}) FILTER (is_train) OVER () AS {c}"


@query(
    "scaled_features",
    "pair date:d close:6 hl:6 oc:6 is_train:b",
    f"""SELECT pair, date, is_train, {scaled_sql('close')}, {scaled_sql('hl')}, {scaled_sql('oc')}
        FROM (SELECT *, high - low AS hl, close - open AS oc FROM ({SPLIT_SQL}))""",
)
def scaled_features(spark, sf):
    split = features.time_split(features.candle_geometry(inputs.bars(spark, sf)))
    return features.scaled_columns(split, ("close", "hl", "oc"))


def _votes(spark, sf):
    """Three plain rules as stand-ins for models, and the target."""

    def build(df, w):
        df = features.target_up(add_rsi_partial(df, w), w)
        return df.withColumns(
            {
                "rising": (F.col("close") > F.col("open")).cast("int"),
                "above_mean": (F.col("close") > rolling_mean("close", w, 7)).cast("int"),
                "low_rsi": (F.col("rsi_14") < 50).cast("int"),
            }
        )

    return over_series(inputs.bars(spark, sf), build, back=14, ahead=1)


RULES = ("rising", "above_mean", "low_rsi")
VOTES_SQL = f"""SELECT *, CAST(rising + above_mean + low_rsi >= 2 AS INTEGER) AS vote FROM (
    SELECT pair, date, CAST(close > open AS INTEGER) AS rising, CAST(rsi_14 < 50 AS INTEGER) AS low_rsi,
    CAST(close > avg(close) OVER (PARTITION BY pair ORDER BY date ROWS 6 PRECEDING) AS INTEGER) AS above_mean,
    CAST(coalesce(lead(close) OVER {W} > close, false) AS INTEGER) AS target FROM emas)"""


@query("majority_vote", "pair date:d rising:i above_mean:i low_rsi:i vote:i", VOTES_SQL)
def majority_vote(spark, sf):
    return _votes(spark, sf).withColumn("vote", models.majority(RULES))


@query(
    "confusion_matrix",
    "target:i vote:i n:l",
    f"SELECT target, vote, count(*) AS n FROM ({VOTES_SQL}) GROUP BY 1, 2",
)
def confusion_matrix(spark, sf):
    scored = _votes(spark, sf).withColumn("vote", models.majority(RULES))
    return summary.confusion_matrix(scored, "target", "vote")


@query(
    "classification_report",
    "class:i precision:6 recall:6 f1:6 support:l accuracy:6",
    f"""WITH v AS ({VOTES_SQL}), c AS (SELECT class, count(*) FILTER (target = class AND vote = class) AS hit,
          count(*) FILTER (vote = class) AS predicted, count(*) FILTER (target = class) AS support,
          avg(CAST(vote = target AS INTEGER)) AS accuracy
          FROM v CROSS JOIN (VALUES (0), (1)) AS k(class) GROUP BY class)
        SELECT *, coalesce(hit / nullif(predicted, 0), 0) AS precision, coalesce(hit / nullif(support, 0), 0) AS recall,
          coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM c""",
)
def classification_report(spark, sf):
    scored = _votes(spark, sf).withColumn("vote", models.majority(RULES))
    return summary.classification_report(scored, "target", "vote")


_STORED = {}


def _scored(spark, sf):
    """Predictions for the test rows, stored under the state of the table they come from: several queries read them."""
    orders = inputs.table(spark, sf, "orders").select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    state = (spark.sparkContext.applicationId, tuple(map(tuple, orders.distinct().collect())))
    if state not in _STORED:
        rows, _ = stored(features.time_split(features.ml_features(inputs.bars(spark, sf))), "features")
        fitted = models.fit_models(rows.filter("is_train").drop("is_train"))
        _STORED[state] = list(fitted), stored(models.score(fitted, rows.filter(~F.col("is_train")).drop("is_train")), "predictions")[0]
    return _STORED[state]


MODELS = ("random_forest", "boosted_trees", "boosted_trees_deep", "logistic_regression")


@query("ml_predictions", "pair date:d target:i " + " ".join(f"{m}:i" for m in (*MODELS, "voting")))
def ml_predictions(spark, sf):
    return _scored(spark, sf)[1]


@query("model_comparison", "model accuracy:6 test_rows:l")
def model_comparison(spark, sf):
    names, scored = _scored(spark, sf)
    return models.compare(scored, [*names, "voting"])


TEST_SQL = f"""SELECT * FROM (SELECT *, row_number() OVER {W} > floor(0.8 * count(*) OVER (PARTITION BY pair)) AS held
    FROM ({FEATURES_SQL})) WHERE held"""


@query(
    "ml_prediction_rows",
    "pair date:d target:i known:b vote:b",
    f"SELECT pair, date, target, true AS known, true AS vote FROM ({TEST_SQL})",
)
def ml_prediction_rows(spark, sf):
    """Every test row is predicted as 0 or 1 by all models, and the vote is the majority of its voters."""
    names, scored = _scored(spark, sf)
    votes = sum((F.col(v) for v in models.VOTERS), F.lit(0))
    known = F.forall(F.array(*names, "voting"), lambda p: p.isin(0, 1))
    return scored.select("pair", "date", "target", known.alias("known"), (F.col("voting") == (votes >= 2).cast("int")).alias("vote"))


@query(
    "model_rows",
    "model test_rows:l sane:b",
    f"SELECT model, (SELECT count(*) FROM ({TEST_SQL})) AS test_rows, true AS sane FROM (VALUES "
    + ", ".join(f"('{m}')" for m in (*MODELS, "voting"))
    + ") AS m(model)",
)
def model_rows(spark, sf):
    return model_comparison(spark, sf).withColumn("sane", F.col("accuracy").between(0.4, 1))


@query(
    "feature_coverage",
    "column_name n:l",
    " UNION ALL ".join(
        f"SELECT '{c.partition(':')[0]}' AS column_name, count(*) AS n FROM ({FEATURES_SQL})"
        for c in FEATURES.split()
        if c.partition(":")[0] not in ("pair", "date", "target")
    ),
)
def feature_coverage(spark, sf):
    """The numeric columns that models read, with their values; no row misses one."""
    rows = features.ml_features(inputs.bars(spark, sf))
    columns = features.feature_columns(rows)
    counted = rows.agg(*[F.count(c).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "n")


# --- models whose right answers are known ---------------------------------------

LOGIT_ROWS = f"""SELECT pair, date, (close - open) / nullif(open, 0) * 100 AS x,
    CAST(coalesce(lead(close) OVER {W} > close, false) AS INTEGER) AS y FROM bars"""
GRID_SQL = f"""WITH RECURSIVE rows AS MATERIALIZED ({LOGIT_ROWS}),
    days AS (SELECT y, date, count(*) AS n FROM rows GROUP BY 1, 2),
    placed AS (SELECT y, date, CAST(floor({models.FOLDS} * coalesce(sum(n) OVER (PARTITION BY y ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      / sum(n) OVER (PARTITION BY y)) AS INTEGER) AS fold FROM days),
    folded AS MATERIALIZED (SELECT x, y, fold FROM rows JOIN placed USING (y, date)),
    sets AS (SELECT CAST(s AS INTEGER) AS s FROM range({models.FOLDS + 1}) t(s)),
    scales AS (SELECT s, avg(x) AS m, stddev_samp(x) AS sd FROM folded, sets WHERE fold <> s GROUP BY s),
    z AS MATERIALIZED (SELECT s, (x - m) / sd AS z, y, fold <> s AS used FROM folded, scales),
    newton AS (SELECT s, c, 0 AS k, 0e0 AS w0, 0e0 AS w1 FROM sets, (VALUES {", ".join(f"({c}e0)" for c in models.C_GRID)}) v(c)
      UNION ALL SELECT s, c, k + 1, w0 - (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01), w1 - (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01)
      FROM (SELECT s, c, k, w0, w1, sum(p - y) AS g0, sum((p - y) * z) + w1 / c AS g1, sum(p * (1 - p)) AS h00,
              sum(p * (1 - p) * z) AS h01, sum(p * (1 - p) * z * z) + 1 / c AS h11
            FROM (SELECT n.*, z.z, z.y, 1 / (1 + exp(-(w0 + w1 * z.z))) AS p FROM newton n JOIN z USING (s) WHERE z.used AND k < 12)
            GROUP BY s, c, k, w0, w1)),
    fitted AS (SELECT * FROM newton WHERE k = 12)
    SELECT c, CASE WHEN s = {models.FOLDS} THEN -1 ELSE s END AS fold, w0 AS intercept, w1 AS slope,
      avg(CAST((w0 + w1 * z > 0) = (y = 1) AS INTEGER)) AS accuracy
    FROM fitted JOIN z USING (s) WHERE NOT used OR s = {models.FOLDS} GROUP BY ALL"""


def _logit_rows(spark, sf):
    def build(df, w):
        return features.target_up(df.withColumn("x", F.try_divide(F.col("close") - F.col("open"), F.col("open")) * 100), w)

    return over_series(inputs.bars(spark, sf), build, ahead=1).select("pair", "date", "x", "target")


@query("logistic_grid", "c:4 fold:i intercept:6 slope:6 accuracy:6", GRID_SQL)
def logistic_grid(spark, sf):
    """Every fold and strength of a grid over one feature, by exact Newton steps; fold -1 saw all rows."""
    found = logit.fit_grid(_logit_rows(spark, sf), ["x"]).table(spark)
    return found.select("c", F.coalesce("fold", F.lit(-1)).alias("fold"), "intercept", F.col("coefficients")[0].alias("slope"), "accuracy")


SIGNED_SQL = f"""SELECT pair, date, CAST(close > open AS INTEGER) AS target FROM bars
    QUALIFY row_number() OVER {W} > floor(0.8 * count(*) OVER (PARTITION BY pair))"""


def _signed_rows(spark, sf):
    """A label that one of the features settles."""
    rows = inputs.bars(spark, sf).select(
        "pair", "date", F.signum(F.col("close") - F.col("open")).alias("side"), (F.col("high") - F.col("low")).alias("width"),
        (F.col("close") > F.col("open")).cast("int").alias("target"),
    )
    split, _ = stored(features.time_split(rows), "signed")
    return split.filter("is_train").drop("is_train"), split.filter("NOT is_train").drop("is_train")


@query(
    "models_of_a_known_rule",
    "pair date:d target:i " + " ".join(f"{m}:i" for m in (*MODELS, "voting")),
    "SELECT *, " + ", ".join(f"target AS {m}" for m in (*MODELS, "voting")) + f" FROM ({SIGNED_SQL})",
)
def models_of_a_known_rule(spark, sf):
    """All models learn a label that one feature settles: every prediction is right."""
    train, test = _signed_rows(spark, sf)
    return models.score(models.fit_models(train, rounds=10), test)


@query("saved_model", "pair date:d target:i before:i after:i", f"SELECT *, target AS before, target AS after FROM ({SIGNED_SQL})")
def saved_model(spark, sf):
    """A model scores alike before it is saved and after it is loaded."""
    train, test = _signed_rows(spark, sf)
    path = f"{scratch_path(spark, 'model')}/logistic"
    fitted = models.logistic(["side", "width"], train.count()).fit(train)
    models.save_model(fitted, path)
    before = fitted.transform(test).select("pair", "date", "target", F.col("prediction").cast("int").alias("before"))
    after = models.load_model(path).transform(test).select("pair", "date", F.col("prediction").cast("int").alias("after"))
    return before.join(after, ["pair", "date"])
