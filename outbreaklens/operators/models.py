"""Onset classifiers on MLlib: weighting, training, evaluation inputs, batch scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outbreaklens.operators import forest
from outbreaklens.operators.anomaly import standardise, standardiser
from outbreaklens.operators.ordered import date_at_fraction
from outbreaklens.session import checkpointed

FEATURES = ("cumulative_confirmed_cases", "days_since_first_case", "population_density")
LABEL = "label_next_7d_onset"
SEED = 42
TREES, DEPTH = 300, 6
HIDDEN = (32, 16)
MAX_ITERATIONS, SEGMENT, PATIENCE = 100, 20, 2
VALIDATION_FRACTION = 0.15
PART_ROWS = 50_000


def balanced_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """n / (2 * rows of the class) per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("class_rows"))
    total = counts.agg(F.sum("class_rows")).scalar()
    return counts.withColumn("weight", total / (2 * F.col("class_rows")))


def loss_weight(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Positive and negative rows and the weight of the positive class, n_neg / max(n_pos, 1)."""
    return df.agg(F.count_if(F.col(label) == 1).alias("n_pos"), F.count_if(F.col(label) == 0).alias("n_neg")).select(
        "n_pos", "n_neg", (F.col("n_neg") / F.greatest("n_pos", F.lit(1))).alias("positive_weight")
    )


def with_log_features(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Optional step for skewed counts."""
    return df.select("*", *[F.log1p(c).alias(f"{c}_log") for c in columns])


def impute_ratio(df: DataFrame, train_median: Column) -> DataFrame:
    """Growth ratio with the training median in place of missing values."""
    return df.withColumn("rt_proxy", F.coalesce("rt_proxy", train_median))


def missing_features(df: DataFrame, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """Missing values per feature, as one row."""
    return df.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(c) for c in features])


def require_complete(df: DataFrame, features: tuple[str, ...] = FEATURES) -> None:
    counts = missing_features(df, features).first().asDict()
    if any(counts.values()):
        raise ValueError(f"missing feature values: {counts}")


def _class_case(weights: DataFrame, label: str, value: str) -> Column:
    """Literal per class, from a frame with one row per class."""
    expression = F.lit(1.0)
    for row in weights.where(F.col(label).isin(0, 1)).collect():  # two rows at most
        expression = F.when(F.col(label) == row[label], F.lit(float(row[value]))).otherwise(expression)
    return expression


def train_forest(train: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> PipelineModel:
    """Random forest with balanced class weights; one feature per split, as the square root of three floors to one."""
    weighted = train.withColumn("_weight", _class_case(balanced_weights(train), LABEL, "weight"))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    classifier = RandomForestClassifier(
        labelCol=LABEL,
        weightCol="_weight",
        numTrees=trees,
        maxDepth=depth,
        featureSubsetStrategy="1",
        seed=seed,
    )
    return Pipeline(stages=[assembler, classifier]).fit(weighted)


def importances(model: PipelineModel) -> list[tuple[str, float]]:
    values = model.stages[-1].featureImportances.toArray()
    return sorted(zip(FEATURES, map(float, values)), key=lambda pair: pair[1])


def dealt(rows: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Stored rows, in parts of about `part_rows` at most: training reads and keeps them part by part, many times.

    Small rows come out of a shuffle in few large parts, or in one a date. A table in parts enough stays as it is.
    """
    stored = checkpointed(rows)
    sizes = stored.groupBy(F.spark_partition_id()).count().agg(F.max("count").alias("most"), F.sum("count").alias("n")).first()
    if (sizes["most"] or 0) <= part_rows:
        return stored
    return checkpointed(stored.repartition(-(-sizes["n"] // part_rows)))


def replicate_minority(train: DataFrame, label: str = LABEL) -> DataFrame:
    """Repeat the rows of the rarer class until it is as large as the other: the network takes no row weights.

    The rare class thus weighs exactly the class ratio. With the ratio a / b, the i-th rare row by date is repeated
    floor((i + 1) a / b) - floor(i a / b) times, so the rows with one more copy lie evenly over the dates.
    """
    counts = {r[label]: r["class_rows"] for r in balanced_weights(train, label).collect()}
    if len(counts) < 2:
        return train
    rare = min(counts, key=lambda c: (counts[c], c))
    few, many = F.lit(counts[rare]), F.lit(max(counts.values()))
    ours = train.where(F.col(label) == rare)
    # One row per date reaches the running total.
    before = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    dates = ours.groupBy("date").count().select("date", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("date").orderBy(*[c for c in train.columns if c not in ("date", label)])
    place = F.col("_before") + F.row_number().over(inside) - 1
    # Whole-number division, so that no ratio is rounded.
    copies = F.call_function("div", (place + 1) * many, few) - F.call_function("div", place * many, few)
    repeated = ours.join(dates, "date").withColumn("_copies", copies).where("_copies > 0")
    repeated = repeated.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).select(*train.columns)
    return train.where(F.col(label) != rare).unionByName(repeated)


def _log_loss(scored: DataFrame, label: str = LABEL) -> float:
    p = F.greatest(F.least("onset_probability", F.lit(1 - 1e-7)), F.lit(1e-7))
    loss = F.when(F.col(label) == 1, -F.log(p)).otherwise(-F.log(1 - p))
    return float(scored.agg(F.avg(loss)).first()[0])


def train_network(
    train: DataFrame,
    hidden: tuple[int, ...] = HIDDEN,
    segment: int = SEGMENT,
    max_iterations: int = MAX_ITERATIONS,
    seed: int = SEED,
) -> PipelineModel:
    """Feed-forward network on standardised features, with early stopping.

    The latest part of the training dates is held out. Training goes on in segments of iterations,
    each from the weights of the one before, until the loss on the held-out rows has not improved
    for PATIENCE segments; the weights with the lowest loss are kept.
    """
    require_complete(train)
    inputs = [f"{c}_std" for c in FEATURES]
    cutoff = date_at_fraction(train, "date", 1 - VALIDATION_FRACTION).first()[0]
    scaled = standardise(train, standardiser(train, FEATURES), FEATURES).select("date", LABEL, *inputs)
    # Stored, as every segment reads both parts again.
    scaled = checkpointed(scaled)
    # Dealt evenly: the copies are numbered date by date, and every iteration reads them.
    fit_rows = dealt(replicate_minority(scaled.where(F.col("date") < F.lit(cutoff))).select(LABEL, *inputs))
    held_out = scaled.where(F.col("date") >= F.lit(cutoff))

    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    network = MultilayerPerceptronClassifier(
        labelCol=LABEL, layers=[len(FEATURES), *hidden, 2], maxIter=segment, seed=seed
    )
    best, lowest, waited = None, float("inf"), 0
    for _ in range(max(1, max_iterations // segment)):
        model = Pipeline(stages=[assembler, network]).fit(fit_rows)
        loss = _log_loss(with_probability(model, held_out))
        best, lowest, waited = (model, loss, 0) if loss < lowest else (best, lowest, waited + 1)
        if waited >= PATIENCE:
            break
        network = network.copy()
        network.setInitialWeights(model.stages[-1].weights)
    return best or model


def with_probability(model: PipelineModel, df: DataFrame, out: str = "onset_probability") -> DataFrame:
    """Add the probability of the positive class."""
    scored = model.transform(df)
    return scored.withColumn(out, vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def with_class(df: DataFrame, probability: str = "onset_probability", threshold: float = 0.5) -> DataFrame:
    return df.withColumn("predicted", (F.col(probability) >= threshold).cast("int"))


def predict_zones(state: DataFrame, network: PipelineModel, trees: PipelineModel, stats: DataFrame, density: Column) -> DataFrame:
    """Both probabilities for every zone at once; a missing density is replaced for scoring only."""
    inputs = state.withColumnRenamed("population_density", "_reported").withColumn(
        "population_density", F.coalesce("_reported", density, F.lit(0.0))
    )
    scored = with_probability(network, standardise(inputs, stats, FEATURES), "next_7d_onset_probability")
    scored = with_probability(trees, scored, "baseline_rf_probability")
    return scored.select(
        *[c for c in state.columns if c != "population_density"],
        F.col("_reported").alias("population_density"),
        F.bround("next_7d_onset_probability", 4).alias("next_7d_onset_probability"),
        F.bround("baseline_rf_probability", 4).alias("baseline_rf_probability"),
    )


def score_zones(state: DataFrame, by_network: Column, trees: DataFrame, density: Column, depth: int = DEPTH) -> DataFrame:
    """Both probabilities for every zone by native expressions; a missing density is replaced for scoring only.

    `by_network` is an expression on the features, `trees` the node table of the forest.
    """
    inputs = state.withColumnRenamed("population_density", "_reported").withColumn(
        "population_density", F.coalesce("_reported", density, F.lit(0.0))
    )
    scored = forest.with_probability(inputs.withColumn("_network", by_network), trees, FEATURES, depth, "_forest")
    return scored.select(
        *[c for c in state.columns if c != "population_density"],
        F.col("_reported").alias("population_density"),
        F.bround("_network", 4).alias("next_7d_onset_probability"),
        F.bround("_forest", 4).alias("baseline_rf_probability"),
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
