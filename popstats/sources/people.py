"""Synthetic ``people`` relation derived from the driver's TPC-H-like tables.

The operators are written for person records (names, gender code, birth
date, registered and current city/district, street).  No real record is
used; this view derives such columns deterministically from ``orders``,
``customer``, ``nation`` and ``part`` so that the work grows with the
tables: surnames with ``part``, streets and districts with ``customer``.
The same definition in SQL (``PEOPLE_SQL``) is the CTE every oracle starts
from.

Plan shape: ``orders`` joins ``customer`` on the customer key and ``part`` on
a key made of both, taken modulo the span of the part keys (scalar subqueries
over one column).  All three grow with the data, so no join is hinted: Spark
broadcasts a side only below its own measured size threshold and otherwise
sort-merges, with AQE splitting a hot key.  Only ``nation``, a fixed 25-row
dimension, is always broadcast.  Part keys need not start at 0 nor be dense: a
person whose part does not exist is kept, with NULL names.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popstats.sources.tables import table

# Fixed values of the synthetic view (must equal PEOPLE_SQL below).
NATIONS = 25             # nation keys 0..24 (TPC-H fixed dimension)
PARTS_PER_SURNAME = 20   # part keys that share one surname suffix
CUSTOMERS_PER_STREET = 5
CUSTOMERS_PER_DISTRICT = 100
PARTS_PER_NEIGHBORHOOD = 100     # families of neighbouring parts live together,
CUSTOMERS_PER_NEIGHBORHOOD = 50  # but for three in ten, who live by customer
DATE_ORIGIN = _dt.date(1900, 1, 1)
DATE_SPAN_DAYS = 33238   # birth dates fall in [1900-01-01, 1990-12-31)


def people(orders: DataFrame, customer: DataFrame, nation: DataFrame, part: DataFrame) -> DataFrame:
    """Person records: one row per order (``person_id`` is unique)."""
    o = orders.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("ck"))
    numbered = lambda name, x, size: F.concat(F.lit(name), F.floor(x / size).cast("string"))
    # texts that depend on a customer or a part alone are made there, once, not for every order
    key = F.col("c_custkey")
    c = customer.select(key.alias("ck"), F.col("c_nationkey").alias("nk"),
                        numbered("D", key, CUSTOMERS_PER_DISTRICT).alias("origin_district"),
                        numbered("Street ", key, CUSTOMERS_PER_STREET).alias("street"),
                        numbered("C", key, CUSTOMERS_PER_NEIGHBORHOOD).alias("by_customer"))
    origin = nation.select(F.col("n_nationkey").alias("nk"), F.col("n_name").alias("origin_city"))
    address = nation.select(F.col("n_nationkey").alias("mk"), F.col("n_name").alias("address_city"))
    word = lambda n: F.split_part(F.col("p_name"), F.lit(" "), F.lit(n))
    names = part.select(F.col("p_partkey").alias("pk"), word(1).alias("first_name"),
                        F.concat(word(2), F.lit("_"), F.floor(F.col("p_partkey") / PARTS_PER_SURNAME).cast("string")).alias("last_name"),
                        F.lower("p_type").alias("mother_first"), F.translate(F.lower("p_brand"), "#", "_").alias("father_first"))
    first, last = part.agg(F.min("p_partkey")).scalar(), part.agg(F.max("p_partkey")).scalar()

    k, ck, pk = F.col("k"), F.col("ck"), F.col("pk")
    moved_city = F.when(k % 10 < 2, k % NATIONS).otherwise(F.lit(0))
    moved_district = F.when(k % 10 < 3, k).otherwise(F.lit(0))
    birth = F.when(k % 97 == 0, F.lit(None).cast("date")).otherwise(
        F.date_add(F.lit(DATE_ORIGIN), ((k * 7919) % DATE_SPAN_DAYS).cast("int")))

    base = (o.join(c, "ck")
            .withColumn("mk", (F.col("nk") + moved_city) % NATIONS)
            .withColumn("pk", first + (k * 13 + ck) % (last - first + 1))
            .join(names, "pk", "left"))
    return (base
            .join(F.broadcast(origin), "nk")
            .join(F.broadcast(address), "mk")
            .select(
                k.alias("person_id"),
                F.when(k < 1_000_000, F.lpad(k.cast("string"), 6, "0")).otherwise(k.cast("string")).alias("uid"),
                "first_name", "last_name",
                F.when((k * 31 + ck) % 50 < 26, "M").otherwise("F").alias("gender"),
                birth.alias("birth_date"),
                "origin_city", "address_city", "origin_district",
                numbered("D", ck + moved_district, CUSTOMERS_PER_DISTRICT).alias("address_district"),
                "street", "mother_first", "father_first",
                F.when(k % 7 == 0, F.col("address_city")).otherwise(F.col("origin_city")).alias("birth_city"),
                F.when(k % 10 < 3, F.col("by_customer")).otherwise(numbered("N", pk, PARTS_PER_NEIGHBORHOOD)).alias("address_neighborhood"),
            ))


def load_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"),
                  table(spark, sf_dir, "nation"), table(spark, sf_dir, "part"))


# The same view in SQL (DuckDB).
PEOPLE_SQL = """
SELECT o.o_orderkey AS person_id,
       printf('%06d', o.o_orderkey) AS uid,
       split_part(p.p_name, ' ', 1) AS first_name,
       split_part(p.p_name, ' ', 2) || '_' || CAST(pk // 20 AS string) AS last_name,
       CASE WHEN (o.o_orderkey * 31 + o.o_custkey) % 50 < 26 THEN 'M' ELSE 'F' END AS gender,
       CASE WHEN o.o_orderkey % 97 = 0 THEN NULL
            ELSE DATE '1900-01-01' + CAST((o.o_orderkey * 7919) % 33238 AS int) END AS birth_date,
       n.n_name AS origin_city,
       m.n_name AS address_city,
       concat('D', CAST(o.o_custkey // 100 AS string)) AS origin_district,
       concat('D', CAST((o.o_custkey + CASE WHEN o.o_orderkey % 10 < 3 THEN o.o_orderkey ELSE 0 END) // 100 AS string)) AS address_district,
       concat('Street ', CAST(o.o_custkey // 5 AS string)) AS street,
       lower(p.p_type) AS mother_first,
       replace(lower(p.p_brand), '#', '_') AS father_first,
       CASE WHEN o.o_orderkey % 7 = 0 THEN m.n_name ELSE n.n_name END AS birth_city,
       CASE WHEN o.o_orderkey % 10 < 3 THEN concat('C', CAST(o.o_custkey // 50 AS string))
            ELSE concat('N', CAST(pk // 100 AS string)) END AS address_neighborhood
FROM (SELECT *, lo + (o_orderkey * 13 + o_custkey) % (hi - lo + 1) AS pk
      FROM orders, (SELECT min(p_partkey) AS lo, max(p_partkey) AS hi FROM part)) o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN nation m ON m.n_nationkey = (c.c_nationkey + CASE WHEN o.o_orderkey % 10 < 2 THEN o.o_orderkey % 25 ELSE 0 END) % 25
LEFT JOIN part p ON p.p_partkey = o.pk
"""


def with_people(sql: str) -> str:
    """Prefix an oracle query with the ``people`` CTE."""
    return f"WITH people AS ({PEOPLE_SQL})\n{sql}"
