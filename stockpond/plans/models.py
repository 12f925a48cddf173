"""Forest training, evaluation, model versions and batch scoring on MLlib."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.errors import AnalysisException
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stockpond.operators.ordering import hash_bucket
from stockpond.plans.drift import f1
from stockpond.session import materialize

# The search grid.
GRID = {"numTrees": [10, 20, 40], "maxDepth": [4, 6, 8], "minInstancesPerNode": [1, 4]}

# Rows that stand for all rows of a cell at most, the files that they lie in, and the accuracy of quantiles (one part in so many rows).
PACKETS = 64
PACKET_FILES = 8
QUANTILE_ACCURACY = 10_000

REGISTRY_SCHEMA = "model string, version string, path string, f1 double, auc double, logged_at timestamp_ntz"
ALIAS_SCHEMA = "model string, alias string, version string, set_at timestamp_ntz"


def _features(df: DataFrame, features: list[str]) -> list[Column]:
    """One double per feature, a vector column giving one for each of its places; missing values are NaN, as in the assembler."""
    out = []
    for name in features:
        quoted = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, VectorUDT):
            # All vectors of a column have one length.
            first = df.select(name).where(quoted.isNotNull()).first()
            out += [F.get(vector_to_array(quoted), F.lit(i)) for i in range(len(first[0]) if first else 0)]
        else:
            out.append(quoted.cast("double"))
    return [F.coalesce(c, F.lit(float("nan"))) for c in out]


def marks(rows: DataFrame, names: list[str], most: int) -> dict[str, list[float]]:
    """For each column at most ``most`` values that stand for the others: all of them if there are no more, otherwise quantiles over all rows."""
    shares = [(i + 0.5) / most for i in range(most)]
    known = {n: F.when(~F.isnan(n), F.col(n)) for n in names}
    counted = [F.approx_count_distinct(c).alias(f"n_{n}") for n, c in known.items()]
    quantiles = [F.percentile_approx(c, shares, QUANTILE_ACCURACY).alias(f"q_{n}") for n, c in known.items()]
    stats = rows.agg(*counted, *quantiles).first()
    # The count is off by some per cent, so up to twice as many are listed.
    few = [n for n in names if stats[f"n_{n}"] <= 2 * most]
    listed = rows.agg(*[F.collect_set(known[n]).alias(n) for n in few]).first() if few else None
    out = {}
    for n in names:
        values = listed[n] if n in few else None
        out[n] = sorted(set(values if values is not None and len(values) <= most else stats[f"q_{n}"] or []))
    return out


def nearest_mark(column: str, values: list[float]) -> Column:
    """The mark whose side of the midpoints a value lies on. A forest on marks splits at these midpoints, so rows go where their mark goes."""
    if not values:
        return F.col(column)
    steps = F.when(F.isnan(column), F.lit(float("nan")))
    for low, high in zip(values, values[1:]):
        steps = steps.when(F.col(column) <= (low + high) / 2.0, F.lit(low))
    return steps.otherwise(F.lit(values[-1]))


def cells(rows: DataFrame, features: list[str], label: str, most: int, fold: Column | None = None) -> DataFrame:
    """(``fold``, label, ``_x0``, ``_x1``…, ``_n``): how many rows share their marks; a written table whose size has a bound in the marks."""
    numbers = _features(rows, features)
    names = [f"_x{i}" for i in range(len(numbers))]
    flat = rows.select((F.lit(0) if fold is None else fold).alias("fold"), F.col(label).cast("double").alias(label), *[c.alias(n) for c, n in zip(numbers, names)])
    chosen = marks(flat, names, most)
    marked = flat.select("fold", label, *[nearest_mark(n, chosen[n]).alias(n) for n in names])
    return materialize(marked.groupBy("fold", label, *names).agg(F.count("*").alias("_n")), "cells")


def packets(counted: DataFrame, label: str) -> DataFrame:
    """Each cell as at most ``PACKETS`` rows that carry its count as ``_weight``, in a fixed order; cells of up to that many rows as the rows themselves."""
    parts = F.least(F.col("_n"), F.lit(PACKETS))
    names = [c for c in counted.columns if c.startswith("_x")]
    whole = counted.groupBy(label, *names).agg(F.sum("_n").alias("_n"))
    dealt = whole.select(label, *names, "_n", parts.alias("_parts"), F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))).alias("_part"))
    weight = F.expr("_n div _parts") + F.when(F.col("_part") < F.col("_n") % F.col("_parts"), 1).otherwise(0)
    return materialize(
        dealt.select(label, *names, weight.cast("double").alias("_weight"), "_part").repartition(PACKET_FILES, *names, "_part").sortWithinPartitions(label, *names, "_part"),
        "packets",
    )


class CellForest(Estimator):
    """A forest learned from counts of equal rows.

    A forest looks at features only through at most ``maxBins`` values of each. So rows are counted by these values first,
    in one aggregate, and the trees grow on packets of equal rows with their number as weight. A tree draws packets with
    replacement, as it draws rows. The fitted pipeline takes plain rows.
    """

    def __init__(self, features: list[str], label: str, classifier: RandomForestClassifier):
        super().__init__()
        self.features, self.label, self.classifier = features, label, classifier

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        counted = cells(dataset, self.features, self.label, self.classifier.getMaxBins())
        return self.fit_packets(packets(counted, self.label))

    def fit_packets(self, table: DataFrame, params: dict | None = None) -> PipelineModel:
        """A pipeline for plain rows, learned from the packets made of them."""
        names = [c for c in table.columns if c.startswith("_x")]
        vectors = VectorAssembler(inputCols=names, outputCol="_features", handleInvalid="keep").transform(table)
        model = self.classifier.fit(vectors, params) if params else self.classifier.fit(vectors)
        assembler = VectorAssembler(inputCols=self.features, outputCol="_features", handleInvalid="keep")
        return PipelineModel(stages=[assembler, model])


def forest(features: list[str], label: str, trees: int = 20, depth: int = 6, min_leaf: int = 1, seed: int = 42) -> CellForest:
    classifier = RandomForestClassifier(
        featuresCol="_features",
        labelCol=label,
        predictionCol="predicted",
        weightCol="_weight",
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=min_leaf,
        seed=seed,
    )
    return CellForest(features, label, classifier)


def fit_all(learners: list[CellForest], rows: DataFrame) -> list[PipelineModel]:
    """The forests as ``fit`` learns them, from one count of the rows; they may differ in parameters of the classifier, but not in what is counted."""
    counts = {(*f.features, f.label, f.classifier.getMaxBins()) for f in learners}
    if len(counts) != 1:
        raise ValueError("the forests need one set of features, one label and one number of bins")
    first = learners[0]
    table = packets(cells(rows, first.features, first.label, first.classifier.getMaxBins()), first.label)
    return [f.fit_packets(table) for f in learners]


def accuracy(scored: DataFrame, label: str, prediction: str = "predicted") -> DataFrame:
    return scored.agg(
        F.count("*").alias("rows"), F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy")
    )


def f1_of(scored: DataFrame, label: str, prediction: str = "predicted", rows: str | None = None) -> DataFrame:
    """F1 of class 1; a row counts as often as its column ``rows`` says."""
    y, p = F.col(label) == 1, F.col(prediction) == 1

    def count(which: Column) -> Column:
        return F.count_if(which) if rows is None else F.coalesce(F.sum(F.when(which, F.col(rows))), F.lit(0))

    return scored.agg(f1(count(y & p), count(~y & p), count(y & ~p)).alias("f1"))


def f1_evaluator(label: str) -> MulticlassClassificationEvaluator:
    """F1 of class 1, not the class-weighted mean MLlib calls ``f1``."""
    return MulticlassClassificationEvaluator(
        labelCol=label, predictionCol="predicted", metricName="fMeasureByLabel", metricLabel=1.0
    )


def auc_evaluator(label: str, score: str = "rawPrediction") -> BinaryClassificationEvaluator:
    """Area under the curve over all different scores, not over bins of them."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=0)


def grid_search(
    train: DataFrame,
    features: list[str],
    label: str,
    fold_key: list[str],
    grid: dict[str, list] | None = None,
    folds: int = 3,
    seed: int = 42,
    parallelism: int = 8,
) -> tuple[PipelineModel, DataFrame]:
    """Cross-validated search for the best F1: the model refitted on all rows, and the scores.

    Folds follow a hash of the key. The rows are counted once, by fold and by the marks that are all a forest
    sees of them; the marks come from features of all folds, not from labels. All combinations learn from the counts and
    are judged on them, which gives the F1 of the rows. Fits run ``parallelism`` at
    a time, each from a thread of its own; MLlib's own search shares one set of job properties between its threads, which
    makes concurrent fits fail now and then.
    """
    learner = forest(features, label, seed=seed)
    classifier = learner.classifier
    builder = ParamGridBuilder()
    names = list(grid or GRID)
    for name in names:
        builder = builder.addGrid(classifier.getParam(name), (grid or GRID)[name])
    combinations = builder.build()
    counted = cells(train, features, label, classifier.getMaxBins(), hash_bucket(*fold_key, buckets=folds))
    learned = [packets(counted.where(F.col("fold") != f), label) for f in range(folds)]
    held = [materialize(counted.where(F.col("fold") == f).coalesce(1), "held-cells") for f in range(folds)]

    def score(task: tuple[int, int]) -> float:
        combination, fold = task
        # The packets stand for all features one by one, so the rest of the pipeline is the forest alone.
        columns = [c for c in held[fold].columns if c.startswith("_x")]
        assembler = VectorAssembler(inputCols=columns, outputCol="_features", handleInvalid="keep")
        fitted = learner.fit_packets(learned[fold], combinations[combination]).stages[-1]
        return f1_of(fitted.transform(assembler.transform(held[fold])), label, rows="_n").first()[0] or 0.0

    tasks = [(c, f) for c in range(len(combinations)) for f in range(folds)]
    with ThreadPool(parallelism) as pool:
        scores = pool.map(score, tasks, chunksize=1)
    means = [sum(scores[c * folds : (c + 1) * folds]) / folds for c in range(len(combinations))]
    best = learner.fit_packets(packets(counted, label), combinations[means.index(max(means))])
    rows = [(*[int(p[classifier.getParam(n)]) for n in names], m) for p, m in zip(combinations, means)]
    schema = ", ".join(f"{n} int" for n in names) + ", f1 double"
    return best, train.sparkSession.createDataFrame(rows, schema).orderBy(F.desc("f1"), *names)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def log_model(
    model: PipelineModel, root: str, name: str, version: str, metrics: dict[str, float] | None = None
) -> str:
    """Save a model version and register it with its metrics; a known version is refused."""
    spark = SparkSession.getActiveSession()
    known = _read(spark, f"{root}/registry", REGISTRY_SCHEMA)
    if not known.where((F.col("model") == name) & (F.col("version") == version)).isEmpty():
        raise ValueError(f"{name} {version} is already registered")
    path = f"{root}/models/{name}/{version}"
    model.write().overwrite().save(path)
    values = metrics or {}
    entry = spark.createDataFrame([(name, version, path, values.get("f1"), values.get("auc"))], "model string, version string, path string, f1 double, auc double")
    entry.withColumn("logged_at", F.localtimestamp()).write.mode("append").parquet(f"{root}/registry")
    return path


def set_alias(spark: SparkSession, root: str, name: str, version: str, alias: str = "default") -> None:
    """Point an alias at a registered version; earlier settings are kept as history."""
    known = _read(spark, f"{root}/registry", REGISTRY_SCHEMA)
    if known.where((F.col("model") == name) & (F.col("version") == version)).isEmpty():
        raise ValueError(f"{name} {version} is not registered")
    entry = spark.createDataFrame([(name, alias, version)], "model string, alias string, version string")
    entry.withColumn("set_at", F.localtimestamp()).write.mode("append").parquet(f"{root}/aliases")


def resolve(spark: SparkSession, root: str, name: str, alias: str = "default") -> str:
    """The version an alias points at now."""
    chosen = (
        _read(spark, f"{root}/aliases", ALIAS_SCHEMA)
        .where((F.col("model") == name) & (F.col("alias") == alias))
        .agg(F.max_by("version", F.struct("set_at", "version")))
        .first()[0]
    )
    if chosen is None:
        raise ValueError(f"{name} has no alias {alias}")
    return chosen


def load_model(spark: SparkSession, root: str, name: str, alias: str = "default") -> PipelineModel:
    return PipelineModel.load(f"{root}/models/{name}/{resolve(spark, root, name, alias)}")


def batch_scores(df: DataFrame, root: str, name: str, keep: list[str], alias: str = "default") -> DataFrame:
    """Score with whatever version the alias names."""
    scored = load_model(df.sparkSession, root, name, alias).transform(df)
    return scored.select(*keep, F.col("predicted").cast("int").alias("prediction"))


def champion_challenger(holdout: DataFrame, champion: PipelineModel, challenger: PipelineModel, label: str) -> DataFrame:
    """F1 of both on the same holdout; the challenger is promoted if it does not lose."""
    both = challenger.transform(
        champion.transform(holdout).select(*holdout.columns, F.col("predicted").alias("_champion"))
    )
    return compare_predictions(both, label, "_champion", "predicted")


def compare_predictions(scored: DataFrame, label: str, champion: str, challenger: str) -> DataFrame:
    y, old, new = F.col(label) == 1, F.col(champion) == 1, F.col(challenger) == 1
    scores = scored.agg(
        F.count("*").alias("rows"),
        f1(F.count_if(y & old), F.count_if(~y & old), F.count_if(y & ~old)).alias("champion_f1"),
        f1(F.count_if(y & new), F.count_if(~y & new), F.count_if(y & ~new)).alias("challenger_f1"),
    )
    return scores.withColumn("promote", F.coalesce(F.col("challenger_f1") >= F.col("champion_f1"), F.lit(False)))
