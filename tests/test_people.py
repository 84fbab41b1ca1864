from __future__ import annotations

import datetime as dt

from conftest import SF_ORACLE, SF_SMALL, plan_text, rows
from pyspark.sql import functions as F

from popstats.sources.people import load_people, people
from popstats.sources.tables import table


PART = "p_partkey long, p_name string, p_type string, p_brand string"


def test_names_and_places_grow_with_the_tables(spark):
    def distinct(sf):
        return load_people(spark, sf).agg(*[F.count_distinct(c).alias(c) for c in
                                            ("last_name", "street", "origin_district", "uid", "person_id")]).first()

    small, large = distinct(SF_SMALL), distinct(SF_ORACLE)
    assert all(large[c] > 4 * small[c] for c in small.asDict())


def test_every_order_is_a_person_and_part_is_read_whole(spark):
    p = load_people(spark, SF_SMALL)
    assert p.count() == table(spark, SF_SMALL, "orders").count()
    plan = plan_text(p)
    assert "p_partkey" in plan and "< 200" not in plan


def test_long_keys_keep_all_their_digits(spark):
    orders = spark.createDataFrame([(1234567, 0), (1234568, 0), (5, 0)], "o_orderkey long, o_custkey long")
    customer = spark.createDataFrame([(0, 0)], "c_custkey long, c_nationkey long")
    nation = spark.createDataFrame([(i, f"N{i}") for i in range(25)], "n_nationkey long, n_name string")
    part = spark.createDataFrame([(0, "red ring", "LARGE", "Brand#1"), (1, "blue box", "SMALL", "Brand#2")], PART)
    got = people(orders, customer, nation, part)
    assert rows(got, "uid") == [("000005",), ("1234567",), ("1234568",)]
    assert got.filter(F.col("birth_date") < F.lit(dt.date(1900, 1, 1))).count() == 0


def test_part_keys_may_start_anywhere_and_have_gaps(spark):
    orders = spark.createDataFrame([(k, 0) for k in range(100)], "o_orderkey long, o_custkey long")
    customer = spark.createDataFrame([(0, 0)], "c_custkey long, c_nationkey long")
    nation = spark.createDataFrame([(i, f"N{i}") for i in range(25)], "n_nationkey long, n_name string")
    for keys, unnamed in ((range(1, 11), 0), ([1, 2, 3, 5, 6, 7, 8, 9, 10], 10)):
        part = spark.createDataFrame([(k, "red ring", "LARGE", "Brand#1") for k in keys], PART)
        got = people(orders, customer, nation, part)
        assert got.count() == 100 and got.filter("last_name IS NULL").count() == unnamed
    assert set(got.columns) >= {"mother_first", "father_first", "birth_city", "address_neighborhood"}
