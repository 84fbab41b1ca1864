"""
driver's tables (or over the ``people`` view Spark derives from them), each
with the DuckDB oracle SQL when SQL can express the result.

Types are aligned with Spark's natural result types: counts BIGINT, months,
years and ranks INTEGER, ratios DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popstats.functions.dates import age_years as _age_years
from popstats.functions.dates import clean_dates as _clean_dates
from popstats.operators import association, classify, distribution, encoding, features, label_tree, logit, ranking, sampling, stored, trend
from popstats.plans.registry import register
from popstats.session import cut_lineage
from popstats.sources import dump
from popstats.sources.people import load_people, with_people
from popstats.sources.tables import table

AS_OF = "2009-12-31"


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_people(spark, sf_dir)


# --------------------------------------------------------------------------
# A1 row count
# --------------------------------------------------------------------------

@register("row_count", with_people("SELECT count(*) AS total FROM people"))
def q_row_count(spark, sf_dir):
    return distribution.row_count(_people(spark, sf_dir))


# --------------------------------------------------------------------------
# Top-k and ranks
# --------------------------------------------------------------------------

_PEAK_MONTHS_SQL = with_people("""
, cells AS (SELECT address_city, CAST(month(birth_date) AS INTEGER) AS birth_month, count(*) AS total
            FROM people GROUP BY 1, 2)
, top AS (SELECT address_city FROM cells WHERE address_city IS NOT NULL GROUP BY address_city
          ORDER BY sum(total) DESC, address_city ASC LIMIT 10)
SELECT address_city, birth_month, total, CAST(rank AS INTEGER) AS rank FROM (
  SELECT c.*, rank() OVER (PARTITION BY address_city ORDER BY total DESC) AS rank
  FROM cells c WHERE birth_month IS NOT NULL AND address_city IN (SELECT address_city FROM top))
WHERE rank <= 2
""")


@register("peak_months_in_top_cities", _PEAK_MONTHS_SQL)
def q_peak_months_in_top_cities(spark, sf_dir):
    """N3 (and N5): the two birth months with most births in each of the top-10 cities."""
    p = _people(spark, sf_dir).select("address_city", F.month("birth_date").alias("birth_month"))
    return ranking.rank_within_topk(p, "address_city", "birth_month", k_groups=10, k_items=2)


@register("top_names_in_top_cities", with_people("""
, cells AS (SELECT address_city, last_name, count(*) AS total FROM people GROUP BY 1, 2)
, top AS (SELECT address_city FROM cells WHERE address_city IS NOT NULL GROUP BY address_city
          ORDER BY sum(total) DESC, address_city ASC LIMIT 10)
SELECT address_city, last_name, total, CAST(rank AS INTEGER) AS rank FROM (
  SELECT c.*, rank() OVER (PARTITION BY address_city ORDER BY total DESC) AS rank
  FROM cells c WHERE last_name IS NOT NULL AND address_city IN (SELECT address_city FROM top))
WHERE rank <= 3
"""))
def q_top_names_in_top_cities(spark, sf_dir):
    """N4 first half: the three most common surnames in each of the top-10 cities."""
    p = _people(spark, sf_dir).select("address_city", "last_name")
    return ranking.rank_within_topk(p, "address_city", "last_name", k_groups=10, k_items=3)


@register("rank_within_topk", """
WITH cells AS (SELECT user_id, event_type, count(*) AS total FROM events GROUP BY 1, 2)
, top AS (SELECT user_id FROM cells WHERE user_id IS NOT NULL GROUP BY user_id
          ORDER BY sum(total) DESC, user_id ASC LIMIT 10)
SELECT user_id, event_type, total, CAST(rank AS INTEGER) AS rank FROM (
  SELECT c.*, rank() OVER (PARTITION BY user_id ORDER BY total DESC) AS rank
  FROM cells c WHERE event_type IS NOT NULL AND user_id IN (SELECT user_id FROM top))
WHERE rank <= 3
""")
def q_rank_within_topk(spark, sf_dir):
    """Generic form on another table: top-3 event types of the 10 most active users."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_type")
    return ranking.rank_within_topk(ev, "user_id", "event_type", k_groups=10, k_items=3)


@register("top_groups", with_people("""
SELECT address_city, count(*) AS total FROM people GROUP BY address_city
ORDER BY total DESC, address_city ASC LIMIT 10
"""))
def q_top_groups(spark, sf_dir):
    """N3/N4/N6 shared step: the 10 most populous cities (ties by name)."""
    return ranking.top_groups(_people(spark, sf_dir).select("address_city"), "address_city", k=10)


@register("top_groups_ties", """
SELECT l_partkey, total FROM (
  SELECT l_partkey, count(*) AS total, rank() OVER (ORDER BY count(*) DESC) AS r
  FROM lineitem GROUP BY l_partkey)
WHERE r <= 10
""")
def q_top_groups_ties(spark, sf_dir):
    """Top groups with every tie at the k-th count kept (rank semantics)."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey")
    return ranking.top_groups(li, "l_partkey", k=10, ties="all")


@register("oldest_by_gender", with_people("""
SELECT * FROM people p
WHERE birth_date = (SELECT min(birth_date) FROM people q WHERE q.gender = p.gender)
"""))
def q_oldest_by_gender(spark, sf_dir):
    """The oldest person rows of each gender code, all ties, all columns."""
    return ranking.oldest_by_gender(_people(spark, sf_dir))


@register("extreme_rows", """
SELECT * FROM orders o
WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders q WHERE q.o_orderpriority = o.o_orderpriority)
""")
def q_extreme_rows(spark, sf_dir):
    """Generic form: the most expensive order(s) of every priority class."""
    return ranking.extreme_rows(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice",
                                ascending=False)


@register("peak_month_by_gender", with_people("""
SELECT gender, birth_month, total FROM (
  SELECT gender, CAST(month(birth_date) AS INTEGER) AS birth_month, count(*) AS total,
         row_number() OVER (PARTITION BY gender ORDER BY count(*) DESC,
                            CAST(month(birth_date) AS INTEGER) ASC NULLS LAST) AS rn
  FROM people WHERE birth_date IS NOT NULL GROUP BY 1, 2)
WHERE rn = 1
"""))
def q_peak_month_by_gender(spark, sf_dir):
    """E5: the month with most births for each gender (one row per gender)."""
    return ranking.peak_month_by_gender(_people(spark, sf_dir))


@register("modal_value", with_people("""
SELECT street, total FROM (
  SELECT street, count(*) AS total, rank() OVER (ORDER BY count(*) DESC) AS r
  FROM people GROUP BY street)
WHERE r = 1
"""))
def q_modal_value(spark, sf_dir):
    """The street text with the most residents, every tie."""
    return ranking.modal_value(_people(spark, sf_dir).select("street"), "street")


@register("top_names_by_gender", with_people("""
SELECT gender, last_name, total, CAST(rank AS INTEGER) AS rank FROM (
  SELECT gender, last_name, count(*) AS total,
         row_number() OVER (PARTITION BY gender ORDER BY count(*) DESC, last_name ASC NULLS LAST) AS rank
  FROM people GROUP BY 1, 2 HAVING last_name IS NOT NULL)
WHERE rank <= 10
"""))
def q_top_names_by_gender(spark, sf_dir):
    """The 10 most common surnames of each gender."""
    return ranking.top_names_by_gender(_people(spark, sf_dir), k=10)


@register("top_first_names_by_gender", with_people("""
SELECT gender, first_name, total, CAST(rank AS INTEGER) AS rank FROM (
  SELECT gender, first_name, count(*) AS total,
         rank() OVER (PARTITION BY gender ORDER BY count(*) DESC) AS rank
  FROM people GROUP BY 1, 2 HAVING first_name IS NOT NULL)
WHERE rank <= 3
"""))
def q_top_first_names_by_gender(spark, sf_dir):
    """N1 with rank semantics: every name tied within the top 3 is kept."""
    return ranking.top_names_by_gender(_people(spark, sf_dir), name="first_name", k=3, ties="all")


# --------------------------------------------------------------------------
# Ages, bands, shares
# --------------------------------------------------------------------------


# months_between(DATE '2009-12-31', d) for the fixed reference day, in DuckDB
_AGE_SQL = ("round(((2009 - year(birth_date)) * 12 + 12 - month(birth_date) + "
            "CASE WHEN birth_date = last_day(birth_date) THEN 0 "
            "ELSE round((31 - day(birth_date)) / 31.0, 8) END) / 12, 2)")
_AGED_SQL = f", aged AS (SELECT *, {_AGE_SQL} AS age FROM people)"


def _aged(spark, sf_dir):
    return _age_years(_people(spark, sf_dir), "birth_date", as_of=AS_OF)


@register("age_years", with_people(f"SELECT person_id, {_AGE_SQL} AS age FROM people"))
def q_age_years(spark, sf_dir):
    """Age in years on 2009-12-31, two decimals (NULL for a NULL date)."""
    return _aged(spark, sf_dir).select("person_id", "age")


_BAND_SQL = """CASE WHEN age > 0 AND age <= 18 THEN '0-18'
     WHEN age > 18 AND age <= 28 THEN '19-28'
     WHEN age > 28 AND age <= 38 THEN '29-38'
     WHEN age > 38 AND age <= 48 THEN '39-48'
     WHEN age > 48 AND age <= 59 THEN '49-59'
     WHEN age > 59 AND age < 200 THEN '60+'
     ELSE 'NULL' END"""


@register("age_distribution", with_people(f"""{_AGED_SQL}
SELECT band, total, round(total / sum(total) OVER (), 3) AS proportion FROM (
  SELECT {_BAND_SQL} AS band, count(*) AS total FROM aged GROUP BY 1)
"""))
def q_age_distribution(spark, sf_dir):
    """Rows and share per age band."""
    return distribution.age_distribution(_aged(spark, sf_dir).select("age"))


def _parsed_dump(spark, sf_dir):
    return dump.dump_parse(_people_dump(spark, sf_dir), columns=PEOPLE_DUMP_COLUMNS)


@register("gender_counts", with_people("SELECT gender, count(*) AS total FROM people GROUP BY gender"))
def q_gender_counts(spark, sf_dir):
    """Rows per gender code."""
    return distribution.gender_counts(_people(spark, sf_dir))


@register("gender_ratio", with_people("""
SELECT CAST(count_if(gender = 'M') AS BIGINT) AS male, CAST(count_if(gender = 'F') AS BIGINT) AS female,
       CAST(count_if(gender = 'M') AS DOUBLE) / nullif(count_if(gender = 'F'), 0) AS ratio
FROM people
"""))
def q_gender_ratio(spark, sf_dir):
    """Male and female counts and their ratio, one pass."""
    return distribution.gender_ratio(_people(spark, sf_dir))


@register("city_aging", with_people(f"""{_AGED_SQL}
SELECT address_city, count(*) AS count,
       round(sum(CAST(round(age * 100) AS BIGINT)) / (count(age) * 100.0), 3) AS avg_age,
       round(count_if(age >= 60) / count(*), 3) AS gt_60,
       round(count_if(age >= 65) / count(*), 3) AS gt_65,
       (round(count_if(age >= 60) / count(*), 3) > 0.1
        OR round(count_if(age >= 65) / count(*), 3) > 0.07) AS aging
FROM aged GROUP BY address_city
"""))
def q_city_aging(spark, sf_dir):
    """Per city the average age, shares aged 60+ and 65+, and the aging flag."""
    return distribution.city_aging(_aged(spark, sf_dir).select("address_city", "age"))


def _area_dim(spark, sf_dir):
    """Dimension table derived from the driver's tables: every nation name with
    an integer 'area' (its number of suppliers); a nation without suppliers
    has no row, so its density is NULL."""
    sup = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n_nationkey"))
    nat = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("address_city"))
    return (sup.join(F.broadcast(nat), "n_nationkey")
            .groupBy("address_city").agg(F.count(F.lit(1)).alias("area")))


@register("density", with_people("""
, top AS (SELECT address_city, count(*) AS total FROM people GROUP BY 1
          ORDER BY total DESC, address_city ASC LIMIT 10)
, dim AS (SELECT n.n_name AS address_city, count(*) AS area
          FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey GROUP BY 1)
SELECT t.address_city, t.total, d.area, round(t.total / nullif(d.area, 0), 2) AS density
FROM top t LEFT JOIN dim d ON t.address_city = d.address_city
"""))
def q_density(spark, sf_dir):
    """Rows per area for the 10 most populous cities."""
    return distribution.density(_people(spark, sf_dir), "address_city", _area_dim(spark, sf_dir))


@register("migration_share", with_people("""
SELECT 'district' AS pair, CAST(count_if(origin_district != address_district) AS BIGINT) AS moved, count(*) AS total,
       count_if(origin_district != address_district) / count(*) AS proportion FROM people
UNION ALL
SELECT 'city', CAST(count_if(origin_city != address_city) AS BIGINT), count(*),
       count_if(origin_city != address_city) / count(*) FROM people
"""))
def q_migration_share(spark, sf_dir):
    """Share of rows whose registered district (city) differs from the current one."""
    return distribution.migration_share(_people(spark, sf_dir))


_LETTERS_SQL = ("unnest(string_split(regexp_replace(concat_ws('', {cols}), '\\P{{L}}+', '', 'g'), ''))")


@register("letter_frequency", with_people(f"""
SELECT letter, count(*) AS total FROM (
  SELECT {_LETTERS_SQL.format(cols="lower(first_name), lower(last_name)")} AS letter FROM people)
WHERE letter != '' GROUP BY letter
"""))
def q_letter_frequency(spark, sf_dir):
    """Letter counts over all first and last names."""
    return distribution.letter_frequency(_people(spark, sf_dir))


@register("top_letter", f"""
SELECT letter, total FROM (
  SELECT letter, count(*) AS total, rank() OVER (ORDER BY count(*) DESC) AS r FROM (
    SELECT {_LETTERS_SQL.format(cols="lower(text)")} AS letter FROM documents)
  WHERE letter != '' GROUP BY letter)
WHERE r = 1
""")
def q_top_letter(spark, sf_dir):
    """E2 on whole texts: the most frequent letter over every document."""
    return distribution.top_letter(table(spark, sf_dir, "documents"), ["text"])


# --------------------------------------------------------------------------
# Association (N4 second half)
# --------------------------------------------------------------------------

_TOP_CITIES_SQL = """
, top AS (SELECT address_city FROM people WHERE address_city IS NOT NULL GROUP BY 1
          ORDER BY count(*) DESC, address_city ASC LIMIT 10)
, kept AS (SELECT * FROM people WHERE address_city IN (SELECT address_city FROM top))
"""


def _top_city_cells(spark, sf_dir, item="last_name", k=10):
    """(city, item) counts restricted to the k most populous cities (one scan)."""
    from popstats.operators.ranking import count_by, restrict_to_top_groups

    cells = count_by(_people(spark, sf_dir).select("address_city", item), ["address_city", item])
    return restrict_to_top_groups(cells, "address_city", k=k)


@register("dense_counts", with_people(f"""{_TOP_CITIES_SQL}
, cells AS (SELECT address_city, last_name, count(*) AS total FROM kept GROUP BY 1, 2)
SELECT c.address_city, n.last_name, coalesce(x.total, 0) AS total
FROM (SELECT address_city FROM top) c CROSS JOIN (SELECT DISTINCT last_name FROM cells) n
LEFT JOIN cells x ON x.address_city = c.address_city AND x.last_name = n.last_name
"""))
def q_dense_counts(spark, sf_dir):
    """Zero-filled surname counts for each of the top-10 cities."""
    return association.dense_counts(_people(spark, sf_dir), "address_city", "last_name", k_groups=10)


PIVOT_CITIES = tuple(f"NATION_{i}" for i in range(25))  # every city of the fixed dimension


@register("count_pivot", with_people("SELECT last_name, " + ", ".join(
    f"CAST(count(*) FILTER (WHERE address_city = '{c}') AS BIGINT) AS \"{c}\"" for c in PIVOT_CITIES) + """
FROM people WHERE address_city IN (""" + ", ".join(f"'{c}'" for c in PIVOT_CITIES) + """)
GROUP BY last_name
"""))
def q_count_pivot(spark, sf_dir):
    """N4 (commented-out variant in the reference): surnames x named cities, wide."""
    return association.count_pivot(_people(spark, sf_dir).select("last_name", "address_city"), "last_name",
                                   "address_city", PIVOT_CITIES)


_CHI2_SQL = """
, cells AS (SELECT {a} AS a, {b} AS b, count(*) AS o FROM {src} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2)
, r AS (SELECT a, sum(o) AS r FROM cells GROUP BY a)
, c AS (SELECT b, sum(o) AS c FROM cells GROUP BY b)
, s AS (SELECT CAST(sum(o) AS BIGINT) AS n, sum(CAST(o AS DOUBLE) * o / (CAST(r AS DOUBLE) * c)) AS s,
               count(DISTINCT cells.a) AS nr, count(DISTINCT cells.b) AS nc
        FROM cells JOIN r ON cells.a = r.a JOIN c ON cells.b = c.b)
SELECT round(greatest(n * (s - 1), 0.0), 9) AS statistic, CAST((nr - 1) * (nc - 1) AS BIGINT) AS dof,
       round(sqrt(greatest(n * (s - 1), 0.0) / (n * nullif(least(nr, nc) - 1, 0))), 9) AS cramers_v, n
FROM s
"""


@register("contingency_chi2", with_people(_TOP_CITIES_SQL + _CHI2_SQL.format(
    a="address_city", b="last_name", src="kept")))
def q_contingency_chi2(spark, sf_dir):
    """N4 intended test: are surname and city independent (top-10 cities)?"""
    return association.contingency_chi2(_top_city_cells(spark, sf_dir), "address_city", "last_name",
                                        counts="total", bounded="address_city")


@register("contingency_chi2_lineitem", "WITH x AS (SELECT 1)" + _CHI2_SQL.format(
    a="l_returnflag", b="l_linestatus", src="lineitem"))
def q_contingency_chi2_lineitem(spark, sf_dir):
    """The same test on another table: return flag against line status."""
    return association.contingency_chi2(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus")


# the upper tail for even degrees of freedom: a finite Poisson sum
_TAIL_SQL = """CASE WHEN dof > 0 AND dof % 2 = 0 THEN round(coalesce(list_sum(list_transform(range(0, dof // 2),
  lambda i: exp(CASE WHEN i = 0 THEN 0.0 ELSE i * ln({x} / 2) - lgamma(i + 1) END - {x} / 2))), 0), 9) END"""


@register("contingency_chi2_p", "SELECT *, " + _TAIL_SQL.format(x="statistic") + " AS p_value FROM (WITH x AS (SELECT 1)"
          + _CHI2_SQL.format(a="l_returnflag", b="l_linestatus", src="lineitem") + ")")
def q_contingency_chi2_p(spark, sf_dir):
    """The test with its p-value (chi-square upper tail)."""
    return association.contingency_chi2(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus", p_value=True)


@register("chi_square_features", with_people("""
, long AS (SELECT 'origin_city' AS feature, origin_city AS a, address_city AS b FROM people
           UNION ALL SELECT 'last_name', last_name, address_city FROM people
           UNION ALL SELECT 'gender', gender, address_city FROM people
           UNION ALL SELECT 'birth_month', CAST(month(birth_date) AS VARCHAR), address_city FROM people)
, cells AS (SELECT feature, a, b, count(*) AS o FROM long WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY 1, 2, 3)
, r AS (SELECT feature, a, sum(o) AS r FROM cells GROUP BY 1, 2)
, c AS (SELECT feature, b, sum(o) AS c FROM cells GROUP BY 1, 2)
, s AS (SELECT feature, sum(o) AS n, sum(CAST(o AS DOUBLE) * o / (CAST(r AS DOUBLE) * c)) AS s,
               (count(DISTINCT cells.a) - 1) * (count(DISTINCT cells.b) - 1) AS dof
        FROM cells JOIN r USING (feature, a) JOIN c USING (feature, b) GROUP BY feature)
, t AS (SELECT feature, greatest(n * (s - 1), 0.0) AS x, dof FROM s)
SELECT feature, round(x, 6) AS statistic, CAST(dof AS BIGINT) AS dof, """ + _TAIL_SQL.format(x="x").replace(", 9)", ", 6)")
    + " AS p_value FROM t"))
def q_chi_square_features(spark, sf_dir):
    """N4 as the reference ran it: a chi-square test of several categorical features against the city."""
    p = _people(spark, sf_dir).withColumn("birth_month", F.month("birth_date"))
    return association.chi_square_features(p, ["origin_city", "last_name", "gender", "birth_month"], "address_city",
                                           digits=6)


# --------------------------------------------------------------------------
# Yearly counts and trend models (H4)
# --------------------------------------------------------------------------

_YEARLY_SQL = """
, yearly AS (SELECT CAST(year(birth_date) AS INTEGER) AS year, count(*) AS total
             FROM people WHERE year(birth_date) > 1700 GROUP BY 1)
, long AS (SELECT 'linear' AS model, year, year - (SELECT min(year) FROM yearly) AS index,
                  CAST(total AS DOUBLE) AS y FROM yearly
           UNION ALL
           SELECT 'log', year, year - (SELECT min(year) FROM yearly), ln(total) FROM yearly WHERE total > 0)
"""


def _yearly(spark, sf_dir):
    return distribution.yearly_counts(_people(spark, sf_dir), "birth_date", min_year=1700)


@register("yearly_counts", with_people(_YEARLY_SQL + "SELECT year, total FROM yearly"))
def q_yearly_counts(spark, sf_dir):
    """H4: births per calendar year (years after 1700)."""
    return _yearly(spark, sf_dir)


_FIT_SQL = """SELECT round(regr_slope(y, index), 9) AS slope, round(regr_intercept(y, index), 9) AS intercept,
       round(regr_r2(y, index), 9) AS r2, count(*) AS n FROM long WHERE model = '{m}'"""


@register("yearly_trend", with_people(_YEARLY_SQL + _FIT_SQL.format(m="linear")))
def q_yearly_trend(spark, sf_dir):
    """H4: linear trend of births per year."""
    return trend.yearly_trend(_yearly(spark, sf_dir))


@register("yearly_log_trend", with_people(_YEARLY_SQL + _FIT_SQL.format(m="log")))
def q_yearly_log_trend(spark, sf_dir):
    """H4: exponential (log-linear) trend of births per year."""
    return trend.yearly_log_trend(_yearly(spark, sf_dir))


_TREND_EVAL_SQL = """
, fit AS (SELECT model, regr_slope(y, index) AS slope, regr_intercept(y, index) AS intercept, count(*) AS n
          FROM marked WHERE NOT test GROUP BY model)
, score AS (SELECT m.model, sum((y - (intercept + slope * index)) * (y - (intercept + slope * index))) AS sse,
                   var_pop(y) * count(*) AS sst, count(*) AS n_test
            FROM marked m JOIN fit f ON m.model = f.model WHERE test GROUP BY m.model)
SELECT f.model, round(slope, 9) AS slope, round(intercept, 9) AS intercept,
       round(1 - sse / nullif(sst, 0), 9) AS r2, n AS n_train, coalesce(n_test, 0) AS n_test
FROM fit f LEFT JOIN score s ON f.model = s.model
"""


@register("trend_eval", with_people(_YEARLY_SQL + """
, marked AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY year)
                       > count(*) OVER (PARTITION BY model) - ceil(count(*) OVER (PARTITION BY model) * 0.2) AS test
             FROM long)""" + _TREND_EVAL_SQL))
def q_trend_eval(spark, sf_dir):
    """H4: both models fitted on earlier years, r2 on the last 20 % of years."""
    return trend.trend_eval(_yearly(spark, sf_dir))


@register("trend_eval_hash", with_people(_YEARLY_SQL + f"""
, marked AS (SELECT *, CAST('0x' || substr(md5(concat(CAST(year AS VARCHAR), ':2020')), 1, 15) AS BIGINT)
                       >= {int((1 - 0.2) * (1 << 60))} AS test FROM long)""" + _TREND_EVAL_SQL))
def q_trend_eval_hash(spark, sf_dir):
    """H4 as the reference split it: a random (here hashed) 20 % of the years held out."""
    return trend.trend_eval(_yearly(spark, sf_dir), split="hash")


@register("next_year_forecast", with_people(_YEARLY_SQL + """
, fit AS (SELECT model, regr_slope(y, index) AS slope, regr_intercept(y, index) AS intercept,
                 max(year) AS last, max(year - index) AS origin FROM long GROUP BY model)
SELECT model, CAST(last + 1 AS INTEGER) AS year,
       round(CASE WHEN model = 'log' THEN exp(intercept + slope * (last + 1 - origin))
                  ELSE intercept + slope * (last + 1 - origin) END, 6) AS forecast
FROM fit
"""))
def q_next_year_forecast(spark, sf_dir):
    """H4 as asked: the number of births forecast for the next year, both models."""
    return trend.next_year_forecast(_yearly(spark, sf_dir))


# --------------------------------------------------------------------------
# Dump ingest (S1-S4) and date cleaning (F7, P6) on a dump Spark derives
# from the people view, with planted defects: a footer line, short lines,
# ISO (malformed) and 31 February (impossible) dates, empty dates.
# --------------------------------------------------------------------------


PEOPLE_DUMP_COLUMNS = ("uid", "first_name", "last_name", "gender", "date_of_birth", "origin_city",
                       "origin_district", "address_city", "address_district", "street")


def _people_dump(spark, sf_dir):
    p = _people(spark, sf_dir)
    pid, b = F.col("person_id"), F.col("birth_date")
    date_text = (F.when(b.isNull(), F.lit(""))
                 .when(pid % 211 == 0, F.date_format(b, "yyyy-MM-dd"))
                 .when(pid % 223 == 0, F.concat(F.lit("31/2/"), F.year(b).cast("string")))
                 .otherwise(F.date_format(b, "d/M/yyyy")))
    street = F.when(pid % 499 == 0, F.lit(None)).otherwise(F.col("street"))  # short line
    line = F.concat_ws(dump.SEPARATOR, "uid", "first_name", "last_name", "gender", date_text,
                       "origin_city", "origin_district", "address_city", "address_district", street, F.lit(dump.TRAILER))
    # a generated column: filters on a line are not rewritten into several copies of the expression that makes it
    lines = p.select(F.explode(F.array(line)).alias("value"))
    # every order is a person, so the footer's count comes from that table's metadata, not from a second pass
    footer = table(spark, sf_dir, "orders").agg(F.concat(F.lit("-- rows: "), F.count(F.lit(1)).cast("string")).alias("value"))
    return lines.unionByName(footer)


_DUMP_SQL = """
, dump AS (
  SELECT concat_ws(chr(9), uid, first_name, last_name, gender,
           CASE WHEN birth_date IS NULL THEN ''
                WHEN person_id % 211 = 0 THEN strftime(birth_date, '%Y-%m-%d')
                WHEN person_id % 223 = 0 THEN '31/2/' || CAST(year(birth_date) AS VARCHAR)
                ELSE strftime(birth_date, '%-d/%-m/%Y') END,
           origin_city, origin_district, address_city, address_district,
           CASE WHEN person_id % 499 = 0 THEN NULL ELSE street END, '<NULL>') AS value
  FROM people
  UNION ALL SELECT '-- rows: ' || CAST(count(*) AS VARCHAR) FROM orders)
, parsed AS (
  SELECT p[1] AS uid, p[2] AS first_name, p[3] AS last_name, p[4] AS gender, p[5] AS date_of_birth,
         p[6] AS origin_city, p[7] AS origin_district, p[8] AS address_city, p[9] AS address_district,
         p[10] AS street
  FROM (SELECT string_split(value, chr(9)) AS p FROM dump WHERE regexp_matches(value, '^[0-9]{6}'))
  WHERE len(p) = 11)
"""


@register("dump_lines", with_people(_DUMP_SQL + "SELECT value FROM dump WHERE regexp_matches(value, '^[0-9]{6}')"))
def q_dump_lines(spark, sf_dir):
    """Data lines of the dump (the footer is left out)."""
    return dump.dump_lines(_people_dump(spark, sf_dir))


@register("dump_text_lines", with_people(_DUMP_SQL + """
, lines AS (SELECT value, regexp_matches(value, '^[0-9]{6}') AS data, CAST(len(string_split(value, chr(9))) AS INTEGER) AS n_parts FROM dump)
SELECT value, n_parts, CASE WHEN NOT data THEN 'no_uid' WHEN n_parts != 11 THEN 'field_count' ELSE 'parsed' END AS state, true AS from_file FROM lines
"""))
def q_dump_text_lines(spark, sf_dir):
    """S1 to S4 over text files: the dump is written as lines, read as text, and every line parsed or rejected with a reason."""
    import uuid

    from popstats.session import ensure_checkpoint_dir
    from popstats.sources.files import remove

    path = f"{ensure_checkpoint_dir(spark)}/dump-{uuid.uuid4().hex}"
    dump.write_dump(_people_dump(spark, sf_dir), path, compression="gzip")
    lines = dump.read_dump(spark, path, file_column="file")
    state = F.when(~F.col("value").rlike(dump.UID_PATTERN), "no_uid").when(F.col("n_parts") != 11, "field_count").otherwise("parsed")
    out = cut_lineage(lines.withColumn("n_parts", dump.field_count(F.col("value"), dump.SEPARATOR))
                      .select("value", "n_parts", state.alias("state"), F.col("file").endswith(".gz").alias("from_file")))
    remove(spark, path)
    return out


@register("dump_parse", with_people(_DUMP_SQL + "SELECT * FROM parsed"))
def q_dump_parse(spark, sf_dir):
    """S3: dump lines split into the 10-column schema (trailer dropped)."""
    return dump.dump_parse(_people_dump(spark, sf_dir), columns=PEOPLE_DUMP_COLUMNS)


@register("dump_rejects", with_people(_DUMP_SQL + """
SELECT value, CAST(len(string_split(value, chr(9))) AS INTEGER) AS n_parts,
       CASE WHEN NOT regexp_matches(value, '^[0-9]{6}') THEN 'no_uid' ELSE 'field_count' END AS reason
FROM dump
WHERE NOT regexp_matches(value, '^[0-9]{6}') OR len(string_split(value, chr(9))) != 11
"""))
def q_dump_rejects(spark, sf_dir):
    """Lines that cannot be bound to the schema, with the reason."""
    return dump.dump_rejects(_people_dump(spark, sf_dir), columns=PEOPLE_DUMP_COLUMNS)


_SHAPE_SQL = "regexp_matches(date_of_birth, '^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$')"
_PARSE_SQL = "CAST(try_strptime(date_of_birth, '%d/%m/%Y') AS DATE)"


@register("clean_dates", with_people(_DUMP_SQL + f"""
SELECT uid, date_of_birth, birth_date, CAST(month(birth_date) AS INTEGER) AS birth_month,
       CAST(year(birth_date) AS INTEGER) AS birth_year, date_status FROM (
  SELECT uid, date_of_birth, CASE WHEN {_SHAPE_SQL} THEN {_PARSE_SQL} END AS birth_date,
         CASE WHEN NOT {_SHAPE_SQL} THEN 'malformed'
              WHEN {_PARSE_SQL} IS NULL THEN 'impossible' ELSE 'ok' END AS date_status
  FROM parsed)
WHERE date_status != 'malformed'
"""))
def q_clean_dates(spark, sf_dir):
    """Parse d/M/yyyy dates; drop malformed rows, keep impossible ones with a NULL date."""
    parsed = dump.dump_parse(_people_dump(spark, sf_dir), columns=PEOPLE_DUMP_COLUMNS)
    return _clean_dates(parsed.select("uid", "date_of_birth"), "date_of_birth")


@register("date_status_counts", with_people(_DUMP_SQL + f"""
SELECT CASE WHEN NOT {_SHAPE_SQL} THEN 'malformed' WHEN {_PARSE_SQL} IS NULL THEN 'impossible' ELSE 'ok' END
         AS date_status, count(*) AS total
FROM parsed GROUP BY 1
"""))
def q_date_status_counts(spark, sf_dir):
    """Rows per date state in the parsed dump (nothing dropped)."""
    parsed = dump.dump_parse(_people_dump(spark, sf_dir), columns=PEOPLE_DUMP_COLUMNS)
    cleaned = _clean_dates(parsed.select("date_of_birth"), "date_of_birth", drop_malformed=False)
    return ranking.count_by(cleaned, "date_status")


# --------------------------------------------------------------------------
# Completeness, sampling, splitting, vocabularies
# --------------------------------------------------------------------------


_PEOPLE_COLS = ("person_id", "uid", "first_name", "last_name", "gender", "birth_date", "origin_city",
                "address_city", "origin_district", "address_district", "street")


@register("drop_incomplete", with_people(
    f"SELECT {', '.join(_PEOPLE_COLS)} FROM people WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _PEOPLE_COLS)))
def q_drop_incomplete(spark, sf_dir):
    """Rows without any NULL."""
    return sampling.drop_incomplete(_people(spark, sf_dir).select(*_PEOPLE_COLS))


_DRAW_SQL = "CAST('0x' || substr(md5(concat(CAST(person_id AS VARCHAR), ':{seed}')), 1, 15) AS BIGINT)"


@register("sample_by_key", with_people(
    f"SELECT {', '.join(_PEOPLE_COLS)} FROM people WHERE " + _DRAW_SQL.format(seed=2018) + f" < {int(0.1 * (1 << 60))}"))
def q_sample_by_key(spark, sf_dir):
    """P10: reproducible 10 % Bernoulli sample decided by a hash of the key."""
    return sampling.sample_by_key(_people(spark, sf_dir).select(*_PEOPLE_COLS), "person_id", 0.1, seed=2018)


@register("split_by_key", with_people(f"""
SELECT person_id, address_city, CASE WHEN d < {int(0.7 / (0.7 + 0.1 + 0.2) * (1 << 60))} THEN 'train'
       WHEN d < {int((0.7 / (0.7 + 0.1 + 0.2) + 0.1 / (0.7 + 0.1 + 0.2)) * (1 << 60))} THEN 'valid' ELSE 'test' END AS part
FROM (SELECT *, {_DRAW_SQL.format(seed=100)} AS d FROM people)
"""))
def q_split_by_key(spark, sf_dir):
    """M4: train/valid/test parts 70/10/20 decided by a hash of the key."""
    p = _people(spark, sf_dir).select("person_id", "address_city")
    return sampling.split_by_key(p, "person_id", weights=(0.7, 0.1, 0.2), seed=100)


@register("string_index", with_people("""
, pairs AS (SELECT 'address_city' AS column_name, address_city AS value FROM people
            UNION ALL SELECT 'gender', gender FROM people
            UNION ALL SELECT 'last_name', last_name FROM people
            UNION ALL SELECT 'street', street FROM people)
SELECT column_name, value, total,
       row_number() OVER (PARTITION BY column_name ORDER BY total DESC, value ASC) - 1 AS index
FROM (SELECT column_name, value, count(*) AS total FROM pairs WHERE value IS NOT NULL GROUP BY 1, 2)
"""))
def q_string_index(spark, sf_dir):
    """M1: value counts and frequency-descending indexes of four columns."""
    return features.string_index(_people(spark, sf_dir), ["address_city", "gender", "last_name", "street"])


# --------------------------------------------------------------------------
# Classifier (H1-H3): predict the current city from the other columns
# --------------------------------------------------------------------------

CITY_FEATURES = ("first_name", "last_name", "mother_first", "father_first", "gender", "birth_city", "birth_month", "birth_year",
                 "origin_city", "origin_district", "address_district", "address_neighborhood", "street")
GENDER_FEATURES = tuple(c for c in CITY_FEATURES if c != "gender") + ("address_city",)
NAME_FEATURES = tuple(c for c in CITY_FEATURES if c not in ("first_name", "last_name")) + ("address_city",)


def _model_input(spark, sf_dir):
    p = _people(spark, sf_dir)
    return p.withColumn("birth_month", F.month("birth_date")).withColumn("birth_year", F.year("birth_date"))


@register("classify_eval")
def q_classify_eval(spark, sf_dir):
    """H1: city from all 13 features; regParam chosen on validation, scored on test (F1 and accuracy)."""
    return label_tree.tree_eval(_model_input(spark, sf_dir), CITY_FEATURES, "address_city", "person_id", reg_params=(0.3, 0.01, 0.001))


@register("classify_eval_gender")
def q_classify_eval_gender(spark, sf_dir):
    """H2: the same operator with the gender code as label."""
    return label_tree.tree_eval(_model_input(spark, sf_dir), GENDER_FEATURES, "gender", "person_id", reg_params=(0.01,))


@register("classify_eval_name")
def q_classify_eval_name(spark, sf_dir):
    """H3: the same operator with the whole surname as label (as many classes as the data has)."""
    return label_tree.tree_eval(_model_input(spark, sf_dir), NAME_FEATURES, "last_name", "person_id", reg_params=(0.001,))


@register("classify_topk")
def q_classify_topk(spark, sf_dir):
    """H1/H3 as asked: top-1 to top-5 accuracy of the city and the surname model on the test part."""
    out = []
    models = (("address_city", CITY_FEATURES), ("last_name", NAME_FEATURES))
    both = label_tree.split_rows(_model_input(spark, sf_dir), CITY_FEATURES + NAME_FEATURES, [label for label, _ in models], "person_id")
    for label, feats in models:
        rows = both.filter(F.col(label).isNotNull())
        test = rows.filter(F.col("part") == "test")
        tree = label_tree.fit_label_tree(rows.filter(F.col("part") == "train"), feats, label, "person_id", reg_params=(0.001,), keep=False)
        ranked = label_tree.predict(tree, test, "person_id", beam=5)
        found = label_tree.ranked_accuracy(ranked, test, label, "person_id").select(F.lit(label).alias("label"), "k", "accuracy", "n")
        out.append(cut_lineage(found))  # five rows: a model's files are given back before the next is fitted
        tree.fits.done()
    return out[0].unionByName(out[1])


# The parts of the pipeline that SQL can follow: vocabularies fitted on the training part, exact one-hot places, assembled
# vectors, a stored closed-form model applied to the test part, a saturated model and a Newton fit.

_ENCODED = ("gender", "birth_city", "last_name", "street", "address_neighborhood")
_PART_SQL = f"""
, marked AS (SELECT *, CASE WHEN d < {int(0.7 / (0.7 + 0.1 + 0.2) * (1 << 60))} THEN 'train'
       WHEN d < {int((0.7 / (0.7 + 0.1 + 0.2) + 0.1 / (0.7 + 0.1 + 0.2)) * (1 << 60))} THEN 'valid' ELSE 'test' END AS part
  FROM (SELECT *, {_DRAW_SQL.format(seed=100)} AS d FROM people))
"""


def _long_sql(columns):
    return " UNION ALL ".join(f"SELECT person_id, part, '{c}' AS column_name, {i} AS position, CAST({c} AS VARCHAR) AS value FROM marked"
                              for i, c in enumerate(columns))


def _onehot_sql(columns):
    return _PART_SQL + f"""
, long AS ({_long_sql(columns)})
, vocab AS (SELECT column_name, value, row_number() OVER (PARTITION BY column_name ORDER BY count(*) DESC, value) - 1 AS index
            FROM long WHERE part = 'train' AND value IS NOT NULL GROUP BY 1, 2)
, sizes AS (SELECT column_name, position, (SELECT count(*) FROM vocab v WHERE v.column_name = c.column_name) AS size
            FROM (SELECT DISTINCT column_name, position FROM long) c)
, place AS (SELECT *, CAST(coalesce(sum(size + 1) OVER (ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
            FROM sizes)
, indexed AS (SELECT person_id, long.column_name, "offset", coalesce(index, size) AS index
              FROM long JOIN place ON place.column_name = long.column_name
              LEFT JOIN vocab ON vocab.column_name = long.column_name AND vocab.value = long.value)
"""


def _fitted_vocab(spark, sf_dir, columns):
    rows = label_tree.split_rows(_model_input(spark, sf_dir), columns, "address_city", "person_id")
    return rows, cut_lineage(encoding.vocabulary(rows.filter(F.col("part") == "train"), columns))


@register("onehot_index", with_people(_onehot_sql(_ENCODED) + "SELECT person_id, column_name, index FROM indexed"))
def q_onehot_index(spark, sf_dir):
    """M2: the one-hot place of every value under vocabularies fitted on the training part (unseen values share the last)."""
    rows, vocab = _fitted_vocab(spark, sf_dir, _ENCODED)
    return encoding.onehot_index(rows, vocab, _ENCODED, "person_id")


@register("assemble_features", with_people(_onehot_sql(_ENCODED) + """
SELECT person_id, string_agg(CAST("offset" + index AS VARCHAR), ',' ORDER BY "offset" + index) AS indices,
       (SELECT CAST(sum(size + 1) AS BIGINT) FROM place) AS vector_size
FROM indexed GROUP BY person_id
"""))
def q_assemble_features(spark, sf_dir):
    """M5: every row's sparse feature vector (positions of its ones, length of the vector)."""
    rows, vocab = _fitted_vocab(spark, sf_dir, _ENCODED)
    place = encoding.widths(vocab, _ENCODED)
    out = encoding.assemble(encoding.onehot_index(rows, vocab, _ENCODED, "person_id"), place, "person_id")
    return out.select("person_id", F.array_join("indices", ",").alias("indices"), encoding.vector_size(place).alias("vector_size"))


_STORED = ("gender", "birth_city", "origin_city", "address_neighborhood")


@register("pipeline_transform", with_people(_PART_SQL + f"""
, long AS (SELECT l.*, m.address_city AS class FROM ({_long_sql(_STORED)}) l JOIN marked m USING (person_id))
, cells AS (SELECT column_name, value, class, count(*) AS n FROM long WHERE part = 'train' AND value IS NOT NULL GROUP BY 1, 2, 3)
, places AS (SELECT column_name, count(DISTINCT value) + 1 AS places FROM cells GROUP BY 1)
, classes AS (SELECT address_city AS class, count(*) AS rows, sum(count(*)) OVER () AS every FROM marked WHERE part = 'train' GROUP BY 1)
, scored AS (SELECT person_id, c.class, ln(any_value(c.rows) / any_value(c.every)) + sum(ln((coalesce(n, 0) + 1.0) / (c.rows + places))) AS s
             FROM (SELECT * FROM long WHERE part = 'test') t CROSS JOIN classes c JOIN places p ON p.column_name = t.column_name
             LEFT JOIN cells ON cells.column_name = t.column_name AND cells.value = t.value AND cells.class = c.class
             GROUP BY person_id, c.class)
, normed AS (SELECT *, s - max(s) OVER w - ln(sum(exp(s - m)) OVER w) AS lp FROM (
               SELECT *, max(s) OVER (PARTITION BY person_id) AS m FROM scored) WINDOW w AS (PARTITION BY person_id))
SELECT person_id, class AS prediction, round(lp, 6) AS log_probability FROM (
  SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY lp DESC, class) AS k FROM normed) WHERE k = 1
"""))
def q_pipeline_transform(spark, sf_dir):
    """M3: a pipeline fitted on the training part, stored, loaded again and applied to the test part."""
    import uuid

    from popstats.session import ensure_checkpoint_dir
    from popstats.sources.files import remove

    rows = label_tree.split_rows(_model_input(spark, sf_dir), _STORED, "address_city", "person_id")
    path = f"{ensure_checkpoint_dir(spark)}/pipeline-transform-{uuid.uuid4().hex}"
    stored.save(stored.fit_counts(rows.filter(F.col("part") == "train"), _STORED, "address_city", "person_id"), path)
    ranked = label_tree.predict(stored.load(spark, path), rows.filter(F.col("part") == "test"), "person_id", beam=1)
    out = cut_lineage(ranked.select("person_id", "prediction", F.round("log_probability", 6).alias("log_probability")))
    remove(spark, path)
    return out


@register("classify_saturated", with_people("""
SELECT CAST(month(birth_date) AS VARCHAR) AS birth_month, gender, count(*) AS total,
       round(count(*) / sum(count(*)) OVER (PARTITION BY month(birth_date)), 4) AS probability
FROM people WHERE birth_date IS NOT NULL AND gender IS NOT NULL GROUP BY month(birth_date), gender
"""))
def q_classify_saturated(spark, sf_dir):
    """M6: an unpenalised model on one column, fitted on distinct patterns with weights, is the column's frequencies."""
    found = classify.pattern_probabilities(_model_input(spark, sf_dir), ["birth_month"], "gender")
    return found.withColumn("probability", F.round("probability", 4))


def _logit_sql(iterations):
    step = """
, it{i} AS (SELECT b0 + (r0 * (d * f - e * e) - b * (r1 * f - e * r2) + c * (r1 * e - d * r2)) / det AS b0,
                   b1 + (a * (r1 * f - e * r2) - r0 * (b * f - c * e) + c * (b * r2 - r1 * c)) / det AS b1,
                   b2 + (a * (d * r2 - r1 * e) - b * (b * r2 - r1 * c) + r0 * (b * e - c * d)) / det AS b2
  FROM (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det FROM (
    SELECT any_value(b0) AS b0, any_value(b1) AS b1, any_value(b2) AS b2, sum(w) AS a, sum(w * x1) AS b, sum(w * x2) AS c,
           sum(w * x1 * x1) AS d, sum(w * x1 * x2) AS e, sum(w * x2 * x2) AS f, sum(r) AS r0, sum(r * x1) AS r1, sum(r * x2) AS r2
    FROM (SELECT *, n * p * (1 - p) AS w, s - n * p AS r FROM (
      SELECT *, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM patterns, it{j})))))"""
    return ("""
, patterns AS (SELECT x1, x2, count(*) AS n, count(*) FILTER (WHERE gender = 'M') AS s FROM (
    SELECT gender, (year(birth_date) - 1945) / 50.0::DOUBLE AS x1, CAST(origin_city != address_city AS INTEGER)::DOUBLE AS x2
    FROM people WHERE birth_date IS NOT NULL) GROUP BY x1, x2)
, it0 AS (SELECT 0::DOUBLE AS b0, 0::DOUBLE AS b1, 0::DOUBLE AS b2)""" + "".join(step.format(i=i + 1, j=i) for i in range(iterations)) + f"""
SELECT unnest(['(constant)', 'birth_year', 'moved']) AS term, round(unnest([b0, b1, b2]), 6) AS coefficient FROM it{iterations}
""")


@register("binary_logit", with_people(_logit_sql(8)))
def q_binary_logit(spark, sf_dir):
    """M7: logistic regression of the gender code on the scaled birth year and on having moved, by reweighted least squares."""
    p = _people(spark, sf_dir).select(
        ((F.year("birth_date") - 1945) / 50.0).alias("birth_year"), (F.col("origin_city") != F.col("address_city")).cast("int").alias("moved"),
        (F.col("gender") == "M").cast("int").alias("male"))
    return logit.binary_logit(p, ["birth_year", "moved"], "male", iterations=8).withColumn("coefficient", F.round("coefficient", 6))


# The evaluation operators on a probability table that SQL can build too: 7
# classes, probabilities in 1/1000ths made from the order key, the label often the likeliest.

_CLASSES = 7


def _scored(spark, sf_dir):
    k = F.col("o_orderkey")
    raw = F.array(*[((k * (31 + 7 * i) + 101 * i * i) % 997 + 1).cast("double") for i in range(_CLASSES)])
    o = table(spark, sf_dir, "orders").select(k.alias("key"), raw.alias("raw"), (k * 13 % 8).alias("turn"),
                                              (k * 5 % _CLASSES).alias("other"))
    best = (F.array_position("raw", F.array_max("raw")) - 1).cast("long")
    return o.select("key", F.transform("raw", lambda x: x / 1000.0).alias("probability"), best.cast("double").alias("prediction"),
                    F.when(F.col("turn") < 4, best).otherwise(F.col("other")).cast("double").alias("_label"))


_SCORED_SQL = f"""WITH raw AS (SELECT o_orderkey AS key, [{", ".join(
    f"CAST((o_orderkey * {31 + 7 * i} + {101 * i * i}) % 997 + 1 AS DOUBLE)" for i in range(_CLASSES))}] AS raw FROM orders)
, best AS (SELECT key, raw, list_position(raw, list_max(raw)) - 1 AS b FROM raw)
, scored AS (SELECT key, list_transform(raw, lambda x: x / 1000.0) AS p, CAST(b AS DOUBLE) AS prediction,
                    CASE WHEN key * 13 % 8 < 4 THEN b ELSE key * 5 % {_CLASSES} END AS l FROM best)
"""


@register("topk_accuracy", _SCORED_SQL + """
, pos AS (SELECT list_count(list_filter(list_transform(p, lambda x, i: CASE WHEN x > p[l + 1] OR (x = p[l + 1] AND i - 1 < l)
                 THEN 1 END), lambda x: x = 1)) + 1 AS pos FROM scored)
SELECT CAST(k AS INTEGER) AS k, avg(CAST(pos <= k AS DOUBLE)) AS accuracy, count(*) AS n
FROM pos, (SELECT unnest([1, 2, 3, 4, 5]) AS k) GROUP BY k
""")
def q_topk_accuracy(spark, sf_dir):
    """Top-1 to top-5 accuracy of a table of class probabilities."""
    return classify.topk_accuracy(_scored(spark, sf_dir), ks=(1, 2, 3, 4, 5))


@register("topk_blockwise", _SCORED_SQL + """
, pos AS (SELECT list_count(list_filter(list_transform(p, lambda x, i: CASE WHEN x > p[l + 1] OR (x = p[l + 1] AND i - 1 < l)
                 THEN 1 END), lambda x: x = 1)) + 1 AS pos FROM scored)
SELECT CAST(k AS INTEGER) AS k, avg(CAST(pos <= k AS DOUBLE)) AS accuracy, count(*) AS n
FROM pos, (SELECT unnest([1, 2, 3, 4, 5]) AS k) GROUP BY k
""")
def q_topk_blockwise(spark, sf_dir):
    """M10 for many classes: the same accuracies from blocks of three classes, without a vector per row."""
    scored = _scored(spark, sf_dir)
    blocks = scored.select("key", F.inline(F.array(*[
        F.struct(F.lit(i).alias("first_class"), F.slice("probability", i + 1, 3).alias("scores")) for i in range(0, _CLASSES, 3)])))
    return classify.topk_blockwise(blocks, scored.select("key", F.col("_label").alias("label")), "key")


@register("top_confident", _SCORED_SQL + """
SELECT prediction, CAST(l AS DOUBLE) AS label, list_max(p) AS confidence FROM scored
ORDER BY confidence DESC, key LIMIT 10
""")
def q_top_confident(spark, sf_dir):
    """The 10 predictions made with the highest confidence (no identifiers)."""
    return classify.top_confident(_scored(spark, sf_dir), 10, key="key")


@register("score_eval", _SCORED_SQL + """
, cells AS (SELECT CAST(l AS DOUBLE) AS l, prediction AS p, count(*) AS n FROM scored GROUP BY 1, 2)
, a AS (SELECT l AS c, sum(n) AS actual, sum(n) FILTER (WHERE l = p) AS hit FROM cells GROUP BY 1)
, s AS (SELECT p AS c, sum(n) AS said FROM cells GROUP BY 1)
SELECT round(sum(actual * 2.0 * coalesce(hit, 0) / (actual + coalesce(said, 0))) / sum(actual), 9) AS f1,
       round(sum(coalesce(hit, 0)) / sum(actual), 9) AS accuracy, CAST(sum(actual) AS BIGINT) AS n
FROM a LEFT JOIN s USING (c)
""")
def q_score_eval(spark, sf_dir):
    """M9: weighted F1 and accuracy of predictions, by aggregates."""
    e = classify.score_eval(_scored(spark, sf_dir))
    return e.select(F.round("f1", 9).alias("f1"), F.round("accuracy", 9).alias("accuracy"), "n")


# --------------------------------------------------------------------------
# The reference's own denominators: well-shaped rows above, all dump rows below
# --------------------------------------------------------------------------

_DUMP_AGED_SQL = _DUMP_SQL + f"""
, shaped AS (SELECT *, {_PARSE_SQL} AS birth_date FROM parsed WHERE {_SHAPE_SQL})
, aged AS (SELECT *, {_AGE_SQL} AS age FROM shaped)
"""


@register("age_distribution_population", with_people(_DUMP_AGED_SQL + f"""
SELECT band, total, round(total / (SELECT count(*) FROM parsed), 3) AS proportion FROM (
  SELECT {_BAND_SQL} AS band, count(*) AS total FROM aged GROUP BY 1)
"""))
def q_age_distribution_population(spark, sf_dir):
    """E3 with every parsed row of the dump as denominator, malformed dates included."""
    parsed = _parsed_dump(spark, sf_dir)
    clean = _clean_dates(parsed.select("date_of_birth"), "date_of_birth")
    return distribution.age_distribution(_age_years(clean, "birth_date", as_of=AS_OF).select("age"),
                                         population=parsed.select("uid"))


@register("migration_share_population", with_people(_DUMP_AGED_SQL + """
SELECT 'district' AS pair, CAST(count_if(origin_district != address_district) AS BIGINT) AS moved,
       (SELECT count(*) FROM parsed) AS total,
       count_if(origin_district != address_district) / (SELECT count(*) FROM parsed) AS proportion FROM shaped
UNION ALL
SELECT 'city', CAST(count_if(origin_city != address_city) AS BIGINT), (SELECT count(*) FROM parsed),
       count_if(origin_city != address_city) / (SELECT count(*) FROM parsed) FROM shaped
"""))
def q_migration_share_population(spark, sf_dir):
    """N7 with well-shaped rows counted and every parsed row as denominator."""
    parsed = _parsed_dump(spark, sf_dir)
    clean = _clean_dates(parsed, "date_of_birth")
    return distribution.migration_share(clean, population=parsed.select("uid"))


@register("peak_month_by_gender_nulls", with_people("""
SELECT gender, birth_month, total FROM (
  SELECT gender, CAST(month(birth_date) AS INTEGER) AS birth_month, count(*) AS total,
         row_number() OVER (PARTITION BY gender ORDER BY count(*) DESC,
                            CAST(month(birth_date) AS INTEGER) ASC NULLS LAST) AS rn
  FROM people GROUP BY 1, 2)
WHERE rn = 1
"""))
def q_peak_month_by_gender_nulls(spark, sf_dir):
    """E5 where an unknown month counts as a month, as in the reference."""
    return ranking.peak_month_by_gender(_people(spark, sf_dir), include_null=True)


# --------------------------------------------------------------------------
# S3 with the 16-column layout
# --------------------------------------------------------------------------

# dump column -> people column (or a constant) for both the dump lines and the SQL
_FULL_DUMP = (("uid", "uid"), ("national_identifier", "person_id"), ("first", "first_name"), ("last", "last_name"),
              ("mother_first", "first_name"), ("father_first", "gender"), ("gender", "gender"), ("birth_city", "origin_city"),
              ("date_of_birth", "birth_date"), ("id_registration_city", "origin_city"),
              ("id_registration_district", "origin_district"), ("address_city", "address_city"),
              ("address_district", "address_district"), ("address_neighborhood", "street"),
              ("street_address", "street"), ("door_or_entrance_number", "person_id"))


@register("dump_parse_full", with_people("SELECT " + ", ".join(
    f"coalesce(CAST({b} AS VARCHAR), '') AS {a}" for a, b in _FULL_DUMP) + " FROM people"))
def q_dump_parse_full(spark, sf_dir):
    """S3 with the default layout: 16 columns and the trailer, empty fields kept."""
    p = _people(spark, sf_dir)
    fields = p.select(*[F.col(b).alias(a) for a, b in _FULL_DUMP])
    return dump.dump_parse(dump.format_dump(fields, [a for a, _ in _FULL_DUMP]))
