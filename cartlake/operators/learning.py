"""Feature tables, splits and classifiers on ``pyspark.ml``."""

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import (
    IndexToString,
    OneHotEncoder,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.functions import profiles
from cartlake.operators import metrics
from cartlake.operators.running import exact_quantiles
from cartlake.operators.scaler import PopulationScaler, moments
from cartlake.operators.serving import MODEL_COLUMNS, MODEL_DEFAULTS, conform
from cartlake.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES, TARGET
from cartlake.session import stage

TEST_SHARE = 0.2
HASH_RANGE = 2**32

# Features of the two forests trained on the training table.
TRAINING_FEATURES = [
    "total_cart_value",
    "num_cart_items",
    "num_views_before_cart",
    "view_to_cart_ratio",
    "session_duration_sec",
    "hour_of_day",
    "is_night",
    "user_prior_views",
    "user_prior_carts",
]


# --- tables -----------------------------------------------------------------


def training_table(gold: DataFrame) -> DataFrame:
    """The training table with rule C as the profile label."""
    return gold.withColumnRenamed("user_session", "session_id").withColumn("user_profile", profiles.rule_c())


def feature_frame(carts: DataFrame, keep: list[str]) -> DataFrame:
    """The model's columns in order, missing columns and nulls filled."""
    kept = {c: carts.schema[c].dataType.simpleString() for c in keep}
    return conform(carts, kept | MODEL_COLUMNS, MODEL_DEFAULTS).fillna(0, NUMERIC_FEATURES).fillna(MODEL_DEFAULTS)


def scaled(frame: DataFrame, digits: int | None = None) -> DataFrame:
    """Each numeric feature with mean 0 and population deviation 1; a constant
    feature only loses its mean."""
    columns = [c for c in NUMERIC_FEATURES if c in frame.columns]
    scale = moments(frame, columns)

    def one(c: str) -> Column:
        mean, std = scale[c]
        x = (F.col(c) - F.lit(mean)) / F.lit(std)
        # Adding 0 turns a rounded -0.0 into 0.0.
        return (x if digits is None else F.round(x, digits) + F.lit(0.0)).alias(c)

    return frame.select(*[one(c) if c in scale else F.col(c) for c in frame.columns])


def known_categories(train: DataFrame, column: str, most: int = 1000) -> list[str]:
    """The names that occur in the training rows, in order; nulls are none.

    Each becomes a column, so more than ``most`` of them is an error."""
    names = [r[0] for r in train.select(column).filter(F.col(column).isNotNull()).distinct().limit(most + 1).collect()]
    if len(names) > most:
        raise ValueError(f"{column} has more than {most} categories")
    return sorted(names)


def one_hot(df: DataFrame, column: str, categories: list[str], keep: list[str]) -> DataFrame:
    """One 0/1 column per known category; an unknown one leaves all at 0."""
    return df.select(
        *keep, *[F.when(F.col(column) == c, 1).otherwise(0).alias(f"{column}_{c}") for c in categories]
    )


def split_hash() -> Column:
    """A number below 2^32 that depends on the session id alone."""
    return F.conv(F.substring(F.md5("user_session"), 1, 8), 16, 10).cast("long")


def with_split(carts: DataFrame, test_share: float = TEST_SHARE, exact: bool = False) -> DataFrame:
    """Mark each cart as train or test by the hash of its session, so the split
    does not depend on order or partitioning. Class shares hold on average;
    ``exact`` moves the cut per class to that class's own quantile."""
    number = split_hash()
    if not exact:
        in_test = number < F.lit(int(test_share * HASH_RANGE))
        return carts.withColumn("split", F.when(in_test, "test").otherwise("train"))
    carts = stage(carts, "split")
    # One row per class.
    cuts = F.broadcast(exact_quantiles(carts, number, [test_share], [TARGET]))
    marked = F.when(number <= F.col("q0"), "test").otherwise("train")
    return carts.join(cuts, TARGET).withColumn("split", marked).drop("q0")


def split_shares(split: DataFrame) -> DataFrame:
    in_test = F.col("split") == "test"
    return split.groupBy(TARGET).agg(
        F.count(F.lit(1)).alias("carts"),
        F.count_if(in_test).alias("test_carts"),
        F.round(F.count_if(in_test) / F.count(F.lit(1)), 4).alias("test_share"),
    )


# --- classifiers ------------------------------------------------------------


def preprocessing(numeric: list[str], categorical: list[str]) -> list:
    """Scaled numbers and one-hot categories in one vector; unknown categories
    go to a bucket of their own."""
    stages = [PopulationScaler(inputCols=numeric, outputCols=[f"scaled_{c}" for c in numeric])]
    parts = [f"scaled_{c}" for c in numeric]
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCol=f"{c}_index", outputCol=f"{c}_flags", dropLast=False))
        parts.append(f"{c}_flags")
    return [*stages, VectorAssembler(inputCols=parts, outputCol="features")]


def logistic_regression(rows: int) -> LogisticRegression:
    """L2 with unit strength over the summed loss, i.e. 1/rows over its mean."""
    return LogisticRegression(labelCol=TARGET, maxIter=1000, regParam=1.0 / max(rows, 1), standardization=False)


def random_forest(trees: int = 120, depth: int = 8, label: str = TARGET, seed: int = 42) -> RandomForestClassifier:
    """A row's node in each tree is kept from level to level; the trees are the same as without."""
    return RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True)


def boosted_trees(rounds: int = 100, depth: int = 6, seed: int = 42) -> GBTClassifier:
    return GBTClassifier(labelCol=TARGET, maxIter=rounds, maxDepth=depth, seed=seed)


def dealt(rows: DataFrame) -> DataFrame:
    """Training rows, written in as many equal parts as there are cores; Spark reads large ones in pieces.

    A fit passes over them up to hundreds of times, and a pass is as slow as its fullest core."""
    return stage(rows.repartition(rows.sparkSession.sparkContext.defaultParallelism), "features")


def fit_each(
    train: DataFrame,
    classifiers: dict,
    numeric: list[str] = NUMERIC_FEATURES,
    categorical: list[str] = CATEGORICAL_FEATURES,
) -> dict[str, PipelineModel]:
    """A model per classifier, by name; the features of all are prepared and written once."""
    prepared = Pipeline(stages=preprocessing(numeric, categorical)).fit(train)
    labels = sorted({c.getLabelCol() for c in classifiers.values()})
    rows = dealt(prepared.transform(train).select(*labels, "features"))
    return {name: PipelineModel([*prepared.stages, c.fit(rows)]) for name, c in classifiers.items()}


def fit(
    train: DataFrame,
    classifier,
    numeric: list[str] = NUMERIC_FEATURES,
    categorical: list[str] = CATEGORICAL_FEATURES,
) -> PipelineModel:
    return fit_each(train, {"": classifier}, numeric, categorical)[""]


def probability() -> Column:
    """The probability of class 1 in a transformed table."""
    return vector_to_array("probability")[1]


def predict(model: PipelineModel, carts: DataFrame) -> DataFrame:
    """Add ``p_abandonment``; columns the model needs and the table lacks are
    filled with their defaults."""
    features = feature_frame(carts, keep=["user_session"])
    scored = model.transform(features).select("user_session", probability().alias("p_abandonment"))
    missing = [c for c in MODEL_COLUMNS if c not in carts.columns]
    if missing:
        return carts.join(scored, "user_session")
    # All columns are there, so the carts can be scored in place, beside what they held.
    held = carts.withColumn("held", F.struct(*carts.columns))
    filled = held.fillna(0, NUMERIC_FEATURES).fillna(MODEL_DEFAULTS)
    return model.transform(filled).select("held.*", probability().alias("p_abandonment"))


def evaluate(model: PipelineModel, test: DataFrame) -> DataFrame:
    """One row: accuracy, precision, recall, f1, roc_auc and the four counts."""
    judged = model.transform(test).select(
        F.col(TARGET).alias("label"), probability().alias("score"), "prediction"
    )
    judged = stage(judged, "judged")
    matrix = metrics.confusion_matrix(judged)
    quality = metrics.classification_metrics(matrix)
    counts = ("tn", "fp", "fn", "tp")
    return quality.select(
        "*",
        metrics.roc_auc(judged).select("roc_auc").scalar().alias("roc_auc"),
        *[matrix.select(c).scalar().alias(c) for c in counts],
    )


# Names shown in a comparison.
LOGISTIC = "Regressão Logística (Baseline)"
FOREST = "Random Forest Classifier"
BOOSTING = "Gradient-Boosted Trees"


@dataclass
class Trained:
    """Fitted models by name, their quality on the test rows, and the best."""

    models: dict[str, PipelineModel]
    comparison: DataFrame
    best_name: str

    @property
    def best(self) -> PipelineModel:
        return self.models[self.best_name]


def train_models(
    gold: DataFrame, test_share: float = TEST_SHARE, seed: int = 42, save_to: str | None = None
) -> Trained:
    """Train the three classifiers, compare them on the test rows and choose by
    area under the ROC curve."""
    frame = feature_frame(gold, keep=["user_session", TARGET])
    split = stage(with_split(frame, test_share), "split")
    train = split.where(F.col("split") == "train")
    test = split.where(F.col("split") == "test")
    classifiers = {
        LOGISTIC: logistic_regression(train.count()),
        FOREST: random_forest(seed=seed),
        BOOSTING: boosted_trees(seed=seed),
    }
    models = fit_each(train, classifiers)
    spark = gold.sparkSession
    rows = [{"model": name} | evaluate(m, test).first().asDict() for name, m in models.items()]
    best = max(rows, key=lambda r: r["roc_auc"] or 0.0)["model"]
    comparison = spark.createDataFrame([r | {"is_best": r["model"] == best} for r in rows])
    if save_to:
        save_model(models[best], save_to)
    return Trained(models, comparison, best)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def importances(model: PipelineModel, numeric: list[str], categorical: list[str]) -> list[tuple[str, float]]:
    """Share of each feature, the flags of one category added up."""
    values = list(model.stages[-1].featureImportances.toArray())
    shares = dict(zip(numeric, values, strict=False))
    position = len(numeric)
    indexers = [s for s in model.stages if hasattr(s, "labels")]
    for name, indexer in zip(categorical, indexers, strict=False):
        width = len(indexer.labels) + 1
        shares[name] = sum(values[position : position + width])
        position += width
    return sorted(((n, float(v)) for n, v in shares.items()), key=lambda pair: (-pair[1], pair[0]))


def with_ratio(training: DataFrame) -> DataFrame:
    ratio = F.round(F.col("num_views_before_cart") / F.greatest(F.col("num_cart_items"), F.lit(1)), 2)
    columns = [c for c in TRAINING_FEATURES if c in training.columns]
    return training.fillna(0, columns).withColumn("view_to_cart_ratio", ratio)


def training_features(training: DataFrame) -> list[str]:
    """Seven features, or nine where the table has the buyer's history."""
    return [c for c in TRAINING_FEATURES if c in (*training.columns, "view_to_cart_ratio")]


def fit_risk_forest(training: DataFrame, trees: int = 100, depth: int = 10) -> PipelineModel:
    return fit(with_ratio(training), random_forest(trees, depth), training_features(training), [])


def fit_profile_forest(training: DataFrame, trees: int = 100, depth: int = 8) -> PipelineModel:
    """Three profile classes; the prediction comes back as its name."""
    labels = StringIndexer(inputCol="user_profile", outputCol="profile_index").fit(training)
    indexed = labels.transform(with_ratio(training))
    forest = fit(indexed, random_forest(trees, depth, "profile_index"), training_features(training), [])
    names = IndexToString(inputCol="prediction", outputCol="predicted_profile", labels=labels.labels)
    return PipelineModel([labels, *forest.stages, names])


@dataclass
class Forests:
    """The two forests of the one-hour decision."""

    risk: PipelineModel
    profile: PipelineModel

    def save(self, path: str) -> None:
        save_model(self.risk, f"{path}/risk")
        save_model(self.profile, f"{path}/profile")

    @staticmethod
    def load(path: str) -> "Forests":
        return Forests(load_model(f"{path}/risk"), load_model(f"{path}/profile"))


def fit_forests(training: DataFrame) -> Forests:
    return Forests(fit_risk_forest(training), fit_profile_forest(training))


def judged_by(forests: Forests, carts: DataFrame) -> DataFrame:
    """Add ``p_abandonment`` and ``predicted_profile`` to carts with the nine training features."""
    scored = forests.risk.transform(carts).select(*carts.columns, probability().alias("p_abandonment"))
    return forests.profile.transform(scored).select(*scored.columns, "predicted_profile")
