from __future__ import annotations

import pytest
from conftest import SF_SMALL

from popstats.operators import classify
from popstats.sources.people import load_people


def _probs(spark):
    # label, probability per class; equal probabilities resolve to the lower index
    data = [
        (0, 0.0, [0.5, 0.3, 0.2]),   # true class first
        (1, 1.0, [0.5, 0.3, 0.2]),   # second
        (2, 2.0, [0.4, 0.4, 0.2]),   # tie between 0 and 1, true class third
        (3, 1.0, [0.4, 0.4, 0.2]),   # tied with class 0, lower index 0 goes first -> second
        (4, 0.0, [0.4, 0.4, 0.2]),   # tied, wins the tie -> first
        (5, 3.0, [0.4, 0.4, 0.2]),   # label never seen by the model -> never counted
    ]
    return spark.createDataFrame(data, "id long, label double, p array<double>")


def test_topk_accuracy_positions(spark):
    out = {r.k: (r.accuracy, r.n) for r in
           classify.topk_accuracy(_probs(spark), probability="p", label="label", ks=(1, 2, 3)).collect()}
    assert out[1] == (pytest.approx(2 / 6), 6)
    assert out[2] == (pytest.approx(4 / 6), 6)
    assert out[3] == (pytest.approx(5 / 6), 6)


def test_classifier_beats_majority_and_topk_monotone(spark):
    people = load_people(spark, SF_SMALL)
    feats = ["origin_city", "origin_district", "address_district", "gender"]
    clf = classify.train_classifier(people, feats, "address_city", "person_id",
                                    reg_params=(0.01,), max_iter=50)
    parts = {m[0]: m for m in clf.metrics}
    assert set(parts) == {"valid", "test"}
    test = clf.splits["test"]
    majority = test.groupBy("_label").count().agg({"count": "max"}).first()[0] / test.count()
    assert parts["test"][3] > majority
    acc = [r.accuracy for r in classify.topk_accuracy(classify.predictions(clf), ks=(1, 2, 3, 5, 25))
           .orderBy("k").collect()]
    assert acc == sorted(acc)
    assert acc[0] == pytest.approx(parts["test"][3], abs=1e-9)
    top = classify.top_confident(classify.predictions(clf), 5, key="person_id")
    assert top.columns == ["prediction", "label", "confidence"] and top.count() == 5


def test_hashing_encoder_and_class_merge(spark):
    people = load_people(spark, SF_SMALL)
    out = classify.classify_eval(people, ["origin_city", "address_city", "gender"], "last_name", "person_id",
                                 reg_params=(0.01,), max_iter=20, hashed=["origin_city", "address_city", "gender"],
                                 num_hash_features=1024, max_classes=3)
    rows = out.collect()
    assert [r.part for r in rows] == ["valid", "test"]
    assert all(0 <= r.accuracy <= 1 and r.n > 0 for r in rows)


def test_named_columns_are_hashed(spark):
    people = load_people(spark, SF_SMALL)
    clf = classify.train_classifier(people, ["gender", "street", "origin_city"], "address_city", "person_id",
                                    reg_params=(0.01,), max_iter=10, hashed=["street"], num_hash_features=256, partitions=4)
    assert clf.prep.stages[-2].__class__.__name__ == "FeatureHasher"
    assert clf.metrics[-1][0] == "test"


def test_too_many_classes_are_an_error(spark):
    people = load_people(spark, SF_SMALL)
    with pytest.raises(ValueError, match="classes"):
        classify.train_classifier(people, ["gender"], "street", "person_id", class_limit=10)


def test_score_eval(spark):
    data = [("a", "a")] * 6 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("c", "a")] + [(None, "a")]
    r = classify.score_eval(spark.createDataFrame(data, "l string, p string"), label="l", prediction="p").first()
    f1 = (8 * 2 * 6 / (8 + 7) + 3 * 2 * 3 / (3 + 5) + 0) / 12
    assert (r.f1, r.accuracy, r.n) == (pytest.approx(f1), pytest.approx(9 / 12), 12)
    none = classify.score_eval(spark.createDataFrame([], "l string, p string"), label="l", prediction="p").first()
    assert (none.f1, none.n) == (None, 0)


def test_sample_fraction_trains_on_a_reproducible_sample(spark):
    people = load_people(spark, SF_SMALL)
    clf = classify.train_classifier(people, ["origin_city"], "address_city", "person_id",
                                    reg_params=(0.01,), max_iter=5, sample_fraction=0.5)
    n = sum(m[4] for m in clf.metrics)  # valid + test rows
    full = people.count()
    assert 0 < clf.splits["train"].count() + n < full
    again = classify.train_classifier(people, ["origin_city"], "address_city", "person_id",
                                      reg_params=(0.01,), max_iter=5, sample_fraction=0.5)
    assert [m[4] for m in again.metrics] == [m[4] for m in clf.metrics]
