"""Multiclass classifier of the built-in ML library over categorical columns, with evaluation.

For labels and columns whose values grow with the data see ``label_tree``.

Pipeline: reproducible key-hash split (train/valid/test) -> optional merge
of all but the most frequent classes of the label -> ``StringIndexer`` +
``OneHotEncoder``, or ``FeatureHasher`` for the columns that the caller names
in ``hashed`` (no fitted vocabulary, a fixed model width: the choice for any
column whose values grow with the data) -> ``VectorAssembler`` ->
``LogisticRegression``.  Everything that learns from data is fitted on the
training part only; unseen categories map to the 'keep' bucket.  A logistic
model has one row of coefficients per class on the driver, so more than
``class_limit`` classes are an error, not a silent merge.

The training set is checkpointed (written to the session's checkpoint
folder) before the iterative fit, so an executor lost during one of the
many passes of L-BFGS re-reads a short lineage instead of recomputing the
source joins.  Each iteration's gradient is a ``treeAggregate`` over the
partitions: no data passes through the driver, only coefficients.

Reported metrics are named for what they are: ``f1`` (weighted F1, what
the evaluator computes by default) and ``accuracy``; both are aggregates over
(label, prediction) counts, and one row comes back.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popstats.operators.ranking import top_groups
from popstats.operators.sampling import sample_by_key, split_by_key
from popstats.session import cut_lineage

OTHER = "__other__"


@dataclass
class Classifier:
    prep: object                 # fitted PipelineModel: features + label index
    model: object                # fitted LogisticRegressionModel (the chosen one)
    reg_param: float
    label: str
    key: str
    splits: dict[str, DataFrame] = field(default_factory=dict)
    metrics: list[tuple] = field(default_factory=list)


def _capped_label(train: DataFrame, data: DataFrame, label: str, max_classes: int | None) -> DataFrame:
    if not max_classes:
        return data
    top = top_groups(train.select(label), label, k=max_classes).select(F.col(label).alias("_keep"))
    kept = data.join(F.broadcast(top), data[label] == top["_keep"], "left")  # at most max_classes rows
    return kept.withColumn(label, F.when(F.col("_keep").isNull(), F.lit(OTHER)).otherwise(F.col(label))).drop("_keep")


def _prep_pipeline(features: Sequence[str], label: str, hashed: Sequence[str], num_hash_features: int):
    """Label index + one-hot for ``features`` not in ``hashed`` + hashing for
    those in ``hashed``, assembled into one ``features`` vector."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import FeatureHasher, OneHotEncoder, StringIndexer, VectorAssembler

    onehot = [c for c in features if c not in set(hashed)]
    idx = [f"_i{i}" for i in range(len(onehot))]
    ohe = [f"_o{i}" for i in range(len(onehot))]
    # one indexer for the label and the one-hot features: one pass over train
    stages = [StringIndexer(inputCols=[label] + onehot, outputCols=["_label"] + idx, handleInvalid="keep")]
    parts = []
    if onehot:
        stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe, handleInvalid="keep"))
        parts += ohe
    if hashed:
        stages.append(FeatureHasher(inputCols=list(hashed), outputCol="_hashed",
                                    numFeatures=num_hash_features, categoricalCols=list(hashed)))
        parts.append("_hashed")
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return Pipeline(stages=stages)


def score_eval(pred: DataFrame, *, label: str = "_label", prediction: str = "prediction") -> DataFrame:
    """One row ``f1, accuracy, n``: weighted F1 and accuracy of predictions.

    A class's F1 is 2 tp / (actual + predicted), 0 where it has no hit;
    weights are the true-class shares.  Rows without a label do not count.
    """
    cells = (pred.filter(F.col(label).isNotNull())
             .groupBy(F.col(label).cast("string").alias("_l"), F.col(prediction).cast("string").alias("_p"))
             .agg(F.count(F.lit(1)).alias("_n")))
    n, zero = F.col("_n"), F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("_l").alias("_class"), n.alias("_actual"), zero.alias("_said"),
                 F.when(F.col("_l").eqNullSafe(F.col("_p")), n).otherwise(zero).alias("_hit")),
        F.struct(F.col("_p").alias("_class"), zero.alias("_actual"), n.alias("_said"), zero.alias("_hit")))
    classes = cells.select(F.inline(sides)).groupBy("_class").agg(*[F.sum(c).alias(c) for c in ("_actual", "_said", "_hit")])
    f1 = F.col("_actual") * (2.0 * F.col("_hit") / (F.col("_actual") + F.col("_said")))
    return classes.agg((F.sum(f1) / F.sum("_actual")).alias("f1"), (F.sum("_hit") / F.sum("_actual")).alias("accuracy"),
                       F.coalesce(F.sum("_actual"), F.lit(0)).alias("n"))


def _evaluate(pred: DataFrame) -> tuple[float, float, int]:
    row = score_eval(pred).first()
    return (float("nan"), float("nan"), 0) if not row["n"] else (row["f1"], row["accuracy"], row["n"])


def train_classifier(df: DataFrame, features: Sequence[str], label: str, key: str, *,
                     reg_params: Sequence[float] = (0.3, 0.01, 0.001), weights=(0.7, 0.1, 0.2),
                     seed: int = 100, max_classes: int | None = None, max_iter: int = 100,
                     elastic_net: float = 0.0, hashed: Sequence[str] = (),
                     num_hash_features: int = 1 << 18, evaluate_test: bool = True,
                     parallelism: int | None = None, sample_fraction: float | None = None,
                     sample_seed: int = 2018, partitions: int | None = None, class_limit: int = 10_000) -> Classifier:
    """Fit on train, pick ``regParam`` by validation F1, score the test part.

    ``hashed`` names the features to hash instead of one-hot encoding them.
    ``partitions`` coalesces the materialised data before the iterative fit
    (every iteration is a job over all partitions); by default they stay.

    ``sample_fraction`` first keeps a reproducible Bernoulli sample of the
    rows (decided by a hash of ``key``), as the reference did before its
    model fits; by default every row is used.
    """
    from pyspark.ml.classification import LogisticRegression

    features = list(features)
    data = (df.select(key, *[F.col(c).cast("string").alias(c) for c in features],
                      F.col(label).cast("string").alias(label))
            .filter(F.col(label).isNotNull()))
    if sample_fraction is not None:
        data = sample_by_key(data, key, sample_fraction, seed=sample_seed)
    data = split_by_key(data, key, weights=weights, seed=seed)
    # the iterative fit reads the training part many times: cut the lineage
    # once, so the source joins never rerun
    data = cut_lineage(data)
    if partitions:
        data = data.coalesce(partitions)
    data = _capped_label(data.filter(F.col("part") == "train"), data, label, max_classes)
    train = data.filter(F.col("part") == "train")
    found = train.select(label).distinct().limit(class_limit + 1).count()
    if found > class_limit:
        raise ValueError(f"more than {class_limit} classes in {label!r}: merge them (max_classes) or choose another label")
    prep = _prep_pipeline(features, label, hashed, num_hash_features).fit(train)
    encoded = prep.transform(data).select(key, "part", label, "_label", "features")
    train_x = encoded.filter(F.col("part") == "train")
    valid_x = encoded.filter(F.col("part") == "valid")
    test_x = encoded.filter(F.col("part") == "test")

    # with one candidate and no report wanted, validation would choose nothing
    score_valid = len(reg_params) > 1 or evaluate_test

    def fit_and_score(rp: float):
        lr = LogisticRegression(featuresCol="features", labelCol="_label", maxIter=max_iter,
                                regParam=float(rp), elasticNetParam=float(elastic_net))
        model = lr.fit(train_x)
        scores = _evaluate(model.transform(valid_x)) if score_valid else (float("nan"), float("nan"), 0)
        return float(rp), model, scores

    # grid points are independent: fit them concurrently on the same
    # checkpointed data, as TrainValidationSplit(parallelism=...) does
    workers = max(1, min(parallelism or len(reg_params), len(reg_params)))
    with ThreadPoolExecutor(max_workers=workers) as pool:
        fitted = list(pool.map(fit_and_score, reg_params))
    metrics, best = [], None
    for rp, model, (f1, acc, n) in fitted:
        if score_valid:
            metrics.append(("valid", rp, f1, acc, n))
        if best is None or f1 > best[0]:
            best = (f1, rp, model)
    _, best_rp, best_model = best
    if evaluate_test:
        f1, acc, n = _evaluate(best_model.transform(test_x))
        metrics.append(("test", best_rp, f1, acc, n))
    return Classifier(prep=prep, model=best_model, reg_param=best_rp, label=label, key=key,
                      splits={"train": train_x, "valid": valid_x, "test": test_x}, metrics=metrics)


def classify_eval(df: DataFrame, features: Sequence[str], label: str, key: str, **kwargs) -> DataFrame:
    """``part, reg_param, f1, accuracy, n``: one row per validated regParam
    and one for the chosen model on the test part."""
    clf = train_classifier(df, features, label, key, **kwargs)
    return df.sparkSession.createDataFrame(
        clf.metrics, "part string, reg_param double, f1 double, accuracy double, n long")


def predictions(clf: Classifier, part: str = "test") -> DataFrame:
    """The chosen model's output on one part: key, label index, probability, prediction."""
    return clf.model.transform(clf.splits[part]).select(clf.key, "_label", "probability", "prediction")


def _probabilities(pred: DataFrame, column: str):
    """The probability column as an array (a model's output is a vector, a table may hold arrays)."""
    from pyspark.ml.functions import vector_to_array

    return F.col(column) if dict(pred.dtypes)[column] == "array<double>" else vector_to_array(F.col(column))


def topk_accuracy(pred: DataFrame, *, probability: str = "probability", label: str = "_label",
                  ks: Sequence[int] = (1, 2, 3, 4, 5)) -> DataFrame:
    """Share of rows whose true class is among the k most probable: ``k, accuracy, n``.

    The true class's position is counted, not sorted for: it is 1 + the
    number of classes more probable than it (equal probabilities go to the
    lower class index, as ``argmax`` does), so top-1 equals plain accuracy.
    A label the model never saw has no position and counts as a miss.
    """
    p = _probabilities(pred, probability)
    lab = F.col(label).cast("int")
    pl = F.try_element_at(p, lab + 1)
    ahead = F.size(F.filter(p, lambda x, i: (x > pl) | ((x == pl) & (i < lab))))
    pos = F.when(pl.isNotNull(), ahead + 1)
    ks = list(ks)
    one = pred.select(pos.alias("_pos")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(F.coalesce(F.col("_pos") <= k, F.lit(False)).cast("double")).alias(f"_a{k}") for k in ks])
    rows = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"_a{k}").alias("accuracy")) for k in ks])
    return one.select(F.inline(rows), "n")


def top_confident(pred: DataFrame, n: int = 10, *, probability: str = "probability",
                  label: str = "_label", prediction: str = "prediction", key: str | None = None) -> DataFrame:
    """The n predictions made with the highest confidence (largest class
    probability): ``prediction, label, confidence`` -- no identifiers."""
    conf = F.array_max(_probabilities(pred, probability))
    order = [F.col("confidence").desc()] + ([F.col(key).asc()] if key else [])
    return (pred.select(F.col(prediction).alias("prediction"), F.col(label).alias("label"),
                        conf.alias("confidence"), *([key] if key else []))
            .orderBy(*order).limit(n).select("prediction", "label", "confidence"))


def topk_blockwise(blocks: DataFrame, labels: DataFrame, key: str, *, ks: Sequence[int] = (1, 2, 3, 4, 5)) -> DataFrame:
    """``topk_accuracy`` of a model with too many classes for one vector per row: ``k, accuracy, n``.

    ``blocks`` (key, first_class, scores) holds any number of rows per key, each
    the scores of consecutive classes; ``labels`` (key, label) their true class
    numbers.  The true class's score is found first; every block then counts the
    classes ahead of it, and only these counts are summed.  Ties go to the lower
    class; a label without a score, or NULL, counts as a miss.
    """
    lab = F.col("label").cast("long")
    own = blocks.join(labels.select(F.col(key), lab.alias("label")), key)
    at = (F.col("label") - F.col("first_class")).cast("int")
    score = F.when((at >= 0) & (at < F.size("scores")), F.get("scores", at))
    truth = own.groupBy(key).agg(F.max(score).alias("_true"))
    ahead = F.size(F.filter("scores", lambda x, i: (x > F.col("_true")) | ((x == F.col("_true")) & (F.col("first_class") + i < F.col("label")))))
    place = own.join(truth, key).groupBy(key).agg(F.when(F.max("_true").isNotNull(), F.sum(ahead) + 1).alias("_pos"))
    every = labels.select(key).join(place, key, "left")
    one = every.agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.coalesce(F.col("_pos") <= k, F.lit(False)).cast("double")).alias(f"_a{k}") for k in ks])
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"_a{k}").alias("accuracy")) for k in ks])), "n")


def pattern_probabilities(df: DataFrame, features: Sequence[str], label: str, *, reg_param: float = 0.0, max_iter: int = 200,
                          tol: float = 1e-12, class_limit: int = 10_000) -> DataFrame:
    """``features..., label, total, probability``: the fitted probability of every label for every feature pattern.

    The rows are collapsed to (pattern, label, number) and the model is fitted
    with ``weightCol`` on those, so an iteration costs a pass over the distinct
    patterns, not over the rows.  NULL features and labels are left out.
    """
    from pyspark.ml.classification import LogisticRegression

    features = list(features)
    own = df.select(*[F.col(c).cast("string").alias(c) for c in features], F.col(label).cast("string").alias(label)).na.drop()
    counts = cut_lineage(own.groupBy(*features, label).agg(F.count(F.lit(1)).alias("total")))
    found = counts.select(label).distinct().limit(class_limit + 1).count()
    if found > class_limit:
        raise ValueError(f"more than {class_limit} classes in {label!r}")
    prep = _prep_pipeline(features, label, (), 0).fit(counts)
    encoded = prep.transform(counts.withColumn("_weight", F.col("total").cast("double")))
    model = LogisticRegression(featuresCol="features", labelCol="_label", weightCol="_weight", regParam=float(reg_param),
                               maxIter=max_iter, tol=tol, standardization=False).fit(encoded)
    from pyspark.ml.functions import vector_to_array

    p = F.get(vector_to_array("probability"), F.col("_label").cast("int"))
    return model.transform(encoded).select(*features, label, "total", p.alias("probability"))
