"""Golden vectors for the scalar functions (FIXTURES.md §3-§5)."""

import pytest
from pyspark.sql import functions as F

from driftsweep.functions import (
    dataset_name, indel_ratio, lcs_length, na_to_null, non_blank, normalise_date, passes_threshold,
)
from driftsweep.operators.harmonise import fill_cid, split_name

# (header, target, best score over the target's aliases, passes)
RATIO_VECTORS = [
    ("Email Address", "emailaddress", 96.00, True), ("E-mail Address", "emailaddress", 92.31, True),
    ("Email", "emailaddress", 58.82, False), ("firstName", "firstname", 88.89, True),
    ("FIRST_NAME", "firstname", 94.74, True), ("Addr 1", "addr1", 90.91, True),
    ("Address1", "addr1", 76.92, False), ("ZipCode", "zip", 60.00, False),
    ("Cid", "cid", 66.67, False), ("ID", "cid", 80.00, False),
    ("Campaign", "campaignname", 80.00, False), ("Mobile", "mobilenumber", 66.67, False),
    ("Sate", "state", 88.89, True), ("Click", "click", 80.00, False), ("Unsub", "unsub", 80.00, False),
    ("SoftBounce", "softbounce", 80.00, False), ("Softbounce", "softbounce", 90.00, True),
    ("HardBounce", "hardbounce", 90.00, True), ("BlockedBounce", "blockedbounce", 84.62, True),
    ("Blocked Bounce", "blockedbounce", 81.48, True), ("Open Date", "opendate", 77.78, False),
    ("ClickDate", "clickdate", 77.78, False), ("click date", "clickdate", 94.74, True),
    ("Opens", "open", 88.89, True), ("Opened", "open", 80.00, False), ("sent date", "sentdate", 94.12, True),
]


def _lcs_py(a, b):
    prev = [0] * (len(b) + 1)
    for ch in a:
        cur = [0]
        for j, cb in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if ch == cb else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


def test_ratio_golden_vectors(spark):
    from driftsweep.schema import ALIASES

    rows = [(h, t, a) for h, t, _, _ in RATIO_VECTORS for a in ALIASES[t]]
    df = spark.createDataFrame(rows, "h string, t string, a string")
    lcs = lcs_length(F.col("a"), F.col("h"))
    out = (df.select("h", "t", indel_ratio(F.col("a"), F.col("h"), lcs).alias("s"),
                     passes_threshold(F.col("a"), F.col("h"), lcs).alias("p"))
             .groupBy("h", "t").agg(F.max("s").alias("s"), F.bool_or("p").alias("p")).collect())
    got = {(r.h, r.t): (round(r.s, 2), r.p) for r in out}
    for h, t, score, ok in RATIO_VECTORS:
        assert got[(h, t)] == (score, ok), (h, t)


def test_ratio_properties(spark):
    words = ["", "a", "ab", "ba", "abc", "EmailAddress", "Email Address", "ü-ñ", "zz top", "aaaa"]
    pairs = [(x, y) for x in words for y in words]
    df = spark.createDataFrame(pairs, "x string, y string")
    rows = df.select("x", "y", lcs_length(F.col("x"), F.col("y")).alias("l"),
                     indel_ratio(F.col("x"), F.col("y")).alias("s"),
                     indel_ratio(F.col("y"), F.col("x")).alias("t")).collect()
    for r in rows:
        assert r.l == _lcs_py(r.x, r.y)
        assert r.s == r.t                      # symmetric
        assert (r.s == 100.0) == (r.x == r.y)  # 100 iff equal


def test_name_split_vectors(spark):
    cases = [("Ann Lee Roe", None, "Ann", "Lee Roe"), ("  Ann   Lee ", None, "Ann", "Lee"),
             (" Bo ", None, " Bo ", None), ("Cy\tDe", None, "Cy\tDe", None),
             ("A\tB C", None, "A", "B C"), ("A B", "", "A B", ""), (None, None, None, None)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _, _) in enumerate(cases)],
                               "i int, firstname string, lastname string")
    got = {r.i: (r.firstname, r.lastname) for r in split_name(df).collect()}
    for i, (_, _, fo, lo) in enumerate(cases):
        assert got[i] == (fo, lo), cases[i]


def test_fill_cid_vectors(spark):
    df = spark.createDataFrame([(0, None, "v3", None, "w", None), (1, None, None, None, None, None),
                                (2, "", "x", "y", None, None)],
                               "i int, cid string, var1 string, var2 string, var3 string, var4 string")
    got = {r.i: r.cid for r in fill_cid(df).collect()}
    assert got == {0: "v3w", 1: "", 2: ""}


def test_date_vectors(spark):
    cases = [("2024-01-02", "2024-01-02"), ("20240102", "2024-01-02"), ("2024-01-02 03:04:05", "2024-01-02"),
             ("", "NaT"), (None, "NaT"), ("1/2/2024", "2024-01-02"), ("abc", "NaT"),
             ("Jan 5, 2024", "2024-01-05"), ("13/02/2024", "NaT"),
             ("2024-01-02 03:04:05.123000", "2024-01-02"), ("2024-01-02T03:04:05", "2024-01-02"),
             ("1/2/2024 3:04:05 PM", "2024-01-02"), ("12/31/2023 23:59", "2023-12-31"),
             ("1/2/2024 13:04:05", "2024-01-02"), ("2024-01-02 03:04:05+01:00", "NaT")]
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], "i int, v string")
    got = {r.i: r.d for r in df.select("i", normalise_date(F.col("v")).alias("d")).collect()}
    assert got == {i: out for i, (_, out) in enumerate(cases)}


@pytest.mark.parametrize("value,expected", [("N/A", None), (" NA", " NA"), ("", None), ("null", None),
                                            ("x", "x"), ("#N/A N/A", None), ("NAN", "NAN")])
def test_na_tokens_exact(spark, value, expected):
    r = spark.createDataFrame([(value,)], "v string").select(na_to_null(F.col("v")).alias("o")).first()
    assert r.o == expected


def test_non_blank(spark):
    df = spark.createDataFrame([(None,), ("",), (" ",), ("  ",), ("a",)], "v string")
    assert [r.o for r in df.select(non_blank(F.col("v")).alias("o")).collect()] == [False, False, False, True, True]


def test_dataset_name(spark):
    df = spark.createDataFrame([("a.csv.v2.xlsx", "S1"), ("list.csv", None), ("x.xls", "Data")], "f string, s string")
    got = [r.n for r in df.select(dataset_name(F.col("f"), F.col("s")).alias("n")).collect()]
    assert got == ["a.v2_S1", "list", "x_Data"]


def test_bit_parallel_lcs_matches_dp(spark):
    import random

    from driftsweep.functions.similarity import char_masks, lcs_fast

    random.seed(7)
    alpha = "abAB c-é"
    words = ["".join(random.choice(alpha) for _ in range(random.randint(0, 70))) for _ in range(400)]
    df = spark.createDataFrame([(random.choice(words), random.choice(words)) for _ in range(2000)], "a string, b string")
    out = df.select(lcs_fast(F.col("a"), F.col("b"), char_masks(F.col("b"))).alias("x"),
                    lcs_length(F.col("a"), F.col("b")).alias("y"), "a", "b").collect()
    for r in out:
        assert r.x == r.y == _lcs_py(r.a, r.b)


def test_shared_folder_is_required_off_local_masters(tmp_path):
    from driftsweep.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default):
            return default

    class Context:
        def __init__(self, master):
            self.master, self.folder = master, None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

        def getConf(self):
            return Conf()

    session = type("Session", (), {})()
    for master in ("local", "local[4]", "local[*]"):
        session.sparkContext = Context(master)
        assert ensure_checkpoint_dir(session)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        session.sparkContext = Context(master)
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(session)


def test_match_masks_are_made_once_a_row(spark):
    """The steps over a's characters look up a variable, not the expression that makes the masks."""
    import re

    from driftsweep.functions.similarity import char_masks, lcs_fast

    df = spark.createDataFrame([("STEEL", "STL"), ("", "x"), ("a" * 70, "a" * 65)], "a string, b string")
    out = df.withColumn("m", char_masks(F.col("b"))).select(lcs_fast(F.col("a"), F.col("b"), F.col("m")).alias("x"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    looked_up = re.findall(r"element_at\((\w+)", plan)
    assert looked_up and set(looked_up) == {"lambda"}, looked_up
    assert [r.x for r in out.collect()] == [3, 0, 65]
