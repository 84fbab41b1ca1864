from __future__ import annotations

import datetime as dt

from conftest import plan_text, rows

from popstats.operators import distribution as d


def test_gender_ratio_missing_denominator(spark):
    df = spark.createDataFrame([("M",), ("M",), ("X",)], "gender string")
    r = d.gender_ratio(df).first()
    assert (r.male, r.female, r.ratio) == (2, 0, None)
    df2 = spark.createDataFrame([("M",), ("M",), ("F",)], "gender string")
    assert d.gender_ratio(df2).first().ratio == 2.0
    assert rows(d.gender_counts(df2)) == [("F", 1), ("M", 2)]


def test_city_aging_rounds_before_comparing(spark):
    # 1 of 10 aged 60+: share 0.1 is not > 0.1; 1 of 9: 0.111 > 0.1
    a = [("A", 61.0)] + [("A", 30.0)] * 9 + [("B", 61.0)] + [("B", 30.0)] * 8 + [("C", None), ("C", 66.0)]
    df = spark.createDataFrame(a, "city string, age double")
    out = {r.city: r for r in d.city_aging(df, "city").collect()}
    assert (out["A"].gt_60, out["A"].aging) == (0.1, False)
    assert (out["B"].gt_60, out["B"].aging) == (0.111, True)
    # NULL age: in the denominator, not in the average
    assert (out["C"]["count"], out["C"].avg_age, out["C"].gt_65, out["C"].aging) == (2, 66.0, 0.5, True)
    assert out["A"].avg_age == round((61 + 9 * 30) / 10, 3)


def test_density_missing_and_zero_area(spark):
    people = spark.createDataFrame([("X",)] * 3 + [("Y",)] * 2 + [("Z",)], "city string")
    dim = spark.createDataFrame([("X", 2), ("Y", 0)], "city string, area long")
    out = {r.city: (r.total, r.area, r.density) for r in d.density(people, "city", dim, k=3).collect()}
    assert out == {"X": (3, 2, 1.5), "Y": (2, 0, None), "Z": (1, None, None)}


def test_migration_share_null_safe(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "b"), (None, None)], "o string, c string")
    pairs = {"p": ("o", "c")}
    plain = d.migration_share(df, pairs).first()
    assert (plain.moved, plain.total, plain.proportion) == (1, 4, 0.25)
    safe = d.migration_share(df, pairs, null_safe=True).first()
    assert safe.moved == 2


def test_letter_frequency_unicode(spark):
    df = spark.createDataFrame([("İpek", "Öz-Can"), ("Ça ğ", "d2"), (None, "Ab")],
                               "first_name string, last_name string")
    got = dict(rows(d.letter_frequency(df)))
    # dotted capital I lowers to i plus a combining dot, which is not a letter
    assert got["i"] == 1 and "̇" not in got
    assert got["ö"] == 1 and got["z"] == 1 and got["ç"] == 1 and got["ğ"] == 1
    assert "-" not in got and " " not in got and "2" not in got
    assert got["a"] == 3  # can, ça, ab (a NULL first name keeps the last name)
    assert rows(d.top_letter(df)) == [("a", 3)]


def test_yearly_counts_filters_old_years(spark):
    df = spark.createDataFrame([(dt.date(1650, 1, 1),), (dt.date(1901, 1, 1),), (dt.date(1901, 5, 1),), (None,)],
                               "birth_date date")
    assert rows(d.yearly_counts(df)) == [(1901, 2)]


def test_one_pass_plans_have_no_python(spark):
    df = spark.createDataFrame([("M", "a", "a", 30.0)], "gender string, o string, c string, age double")
    for out in (d.gender_ratio(df), d.city_aging(df, "o"), d.migration_share(df, {"p": ("o", "c")}),
                d.letter_frequency(df, ["o", "c"])):
        plan = plan_text(out)
        assert "Python" not in plan and "ArrowEval" not in plan
