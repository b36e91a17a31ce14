"""Sweeps of large inboxes: one expression for all targets."""

from pyspark.sql import functions as F

from driftsweep.functions.dates import normalise_date, parse_date
from driftsweep.operators import harmonise
from driftsweep.operators.joins import stored
from driftsweep.operators.resolver import day_first_col, source_col
from driftsweep.schema import DATE_TARGETS, TARGETS


def _projected(spark):
    bronze = spark.range(2).select(F.lit("d").alias("file_name"), F.lit("d.csv").alias("source"), F.lit("p").alias("part"),
                                   F.col("id").alias("src_row"),
                                   F.array(F.lit("3/4/2021"), F.lit("N/A"), F.lit("k"), F.lit("2021-05-06")).alias("cells"))
    at = {"createddate": 0, "cid": 1, "subscriberkey": 2, "opendate": 3, "var1": 9}
    mapping = spark.range(1).select(F.lit("d").alias("file_name"), F.lit("d.csv").alias("source"), F.lit(1).alias("file_ordinal"),
                                    *[F.lit(at.get(t)).cast("int").alias(source_col(t)) for t in TARGETS],
                                    *[F.lit(t == "createddate").alias(day_first_col(t)) for t in DATE_TARGETS])
    return harmonise.project_targets(stored(bronze), stored(mapping))


def test_cell_and_date_expressions_stand_once_in_the_plan(spark):
    silver = harmonise.fill_cid(harmonise.split_name(harmonise.normalise_dates(_projected(spark))))
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = silver._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    # one target's share of each: a cell is looked at twice or so, not once more for each of 33 targets
    assert 1 <= plan.count("element_at(") <= 3
    assert 1 <= plan.count("MMM d, yyyy") <= 3


def test_projection_values(spark):
    p = _projected(spark)
    row = p.first()
    assert (row.createddate, row.cid, row.subscriberkey, row.var1, row.firstname) == ("3/4/2021", "", "k", "", None)
    dated = harmonise.normalise_dates(p)
    row = dated.first()
    assert (row.createddate, row.opendate, row.sentdate) == ("2021-04-03", "2021-05-06", "NaT")
    assert not any(c.startswith(("_dates", "_values", "day_first")) for c in dated.columns)


def test_plain_dates_read_as_by_the_forms(spark):
    texts = ["2021-05-06", "2021-02-30", "2020-02-29", "2021-13-01", "0000-01-01", "0999-01-01", "1000-01-01", "1582-10-10", "1900-02-29",
             "9999-12-31", "2021-1-5", " 2021-05-06", "2021-05-06\n", "2021-05-06 ", "12021-05-06", "20210506", "5/6/2021", "", " ", "abc", None]
    x = spark.createDataFrame([(t,) for t in texts], "t string")
    by_forms = F.coalesce(F.date_format(parse_date(F.col("t")), "yyyy-MM-dd"), F.lit("NaT"))
    for r in x.select("t", normalise_date(F.col("t")).alias("got"), by_forms.alias("want")).collect():
        assert r.got == r.want, r
