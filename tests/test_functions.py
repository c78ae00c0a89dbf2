import re

from pyspark.sql import functions as F

from visitlens.functions import dates, text
from visitlens.functions.buckets import in_bucket
from visitlens.schema import STEP_BUCKETS, VISIT_BUCKETS


def field_of(record, name):
    """Value of the first ``name=value`` part, stated as a pattern."""
    parts = (re.fullmatch(rf"{name}=([^=]+)=*", part) for part in (record or "").split("|"))
    return next((m[1] for m in parts if m), None)


def items_of(text):
    return set(re.sub(",+$", "", text).split(",")) if text.strip(",") or not text else set()


def number_of(text):
    return int(text) if re.fullmatch(r"[+-]?[0-9]+", text or "") else None


# record -> value of the field "a", value of the field ""
KV_ROWS = {
    "a=1|b=2": ("1", None),
    "a=|a=3": ("3", None),
    "a=1=2|a=4": ("4", None),
    "a=1=|b=2": ("1", None),
    "a==1|a=9": ("9", None),
    "=v|a=0": ("0", "v"),
    "": (None, None),
    "|||": (None, None),
    "b=7": (None, None),
    "a=x|a=y": ("x", None),
    "a=5==|": ("5", None),
    None: (None, None),
}


def test_kv_field(spark):
    df = spark.createDataFrame([(r,) for r in KV_ROWS], "r string")
    got = df.select("r", text.kv_field("r", "a").alias("a"), text.kv_field("r", "").alias("e")).collect()
    assert {row.r: (row.a, row.e) for row in got} == KV_ROWS


def test_kv_predicates(spark):
    rows = [
        ("age=30|city=X,Y|sex=m", "startAge=20|endAge=40|cities=Y,Z|sex=m", True, True, True),
        ("age=50|city=X|sex=f", "startAge=20|endAge=40|cities=Y|sex=m", False, False, False),
        ("city=X", "cities=X", True, True, True),  # missing params -> true
        ("city=X", "startAge=1|endAge=9|sex=m", False, True, False),  # missing data field -> false
        ("age=30", "startAge=20", True, True, True),  # one bound missing -> true
    ]
    df = spark.createDataFrame(rows, "d string, p string, b boolean, i boolean, e boolean")
    got = df.select(
        text.kv_between("d", "age", F.col("p"), "startAge", "endAge").alias("b2"),
        text.kv_in("d", "city", F.col("p"), "cities").alias("i2"),
        text.kv_equal("d", "sex", F.col("p"), "sex").alias("e2"),
        "b", "i", "e",
    ).collect()
    for r in got:
        assert (r.b2, r.i2, r.e2) == (r.b, r.i, r.e), r


def test_java_split_drops_trailing_empties(spark):
    want = {"a,b": ["a", "b"], "a,b,": ["a", "b"], ",a": ["", "a"], "": [""], ",,,": [], "a,,b": ["a", "", "b"]}
    df = spark.createDataFrame([(v,) for v in want], "v string")
    assert {r.v: list(r.s) for r in df.select("v", text.java_split("v", ",").alias("s")).collect()} == want


def test_trim_comma_and_pad(spark):
    df = spark.createDataFrame([(",a,b,",), ("a",), (",,x,,",)], "v string")
    got = [r.t for r in df.select(text.trim_comma("v").alias("t")).collect()]
    assert got == ["a,b", "a", ",x,"]
    df = spark.createDataFrame([("5",), ("12",)], "v string")
    assert [r.p for r in df.select(text.pad2("v").alias("p")).collect()] == ["05", "12"]
    df = spark.createDataFrame([(None,), ("",), ("x",)], "v string")
    assert [r.e for r in df.select(text.is_empty("v").alias("e")).collect()] == [True, True, False]


def test_time_helpers(spark):
    df = spark.createDataFrame(
        [("2019-01-01 5:03:04", "2019-01-01 05:03:10"), ("bad", "2019-01-01 05:03:10")], "a string, b string"
    )
    got = df.select(
        dates.parse_time("a").alias("t"),
        dates.before("a", "b").alias("bf"),
        dates.after("a", "b").alias("af"),
        dates.minus("b", "a").alias("mi"),
        dates.date_hour(dates.parse_time("a")).alias("dh"),
    ).collect()
    assert str(got[0].t) == "2019-01-01 05:03:04"
    assert (got[0].bf, got[0].af, got[0].mi, got[0].dh) == (True, False, 6, "2019-01-01_05")
    assert (got[1].t, got[1].bf, got[1].af, got[1].mi) == (None, False, False, 0)


def test_bucket_boundaries(spark):
    visit_vals = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
    df = spark.createDataFrame([(v,) for v in visit_vals], "x long")
    names = [n for n, _, _ in VISIT_BUCKETS]
    cols = [F.when(in_bucket(F.col("x"), lo, hi), F.lit(n)) for n, lo, hi in VISIT_BUCKETS]
    got = {r.x: r.b for r in df.select("x", F.coalesce(*cols).alias("b")).collect()}
    expect = {0: None, 1: "1s_3s", 3: "1s_3s", 4: "4s_6s", 6: "4s_6s", 7: "7s_9s", 9: "7s_9s", 10: "10s_30s",
              30: "10s_30s", 31: "30s_60s", 60: "30s_60s", 61: "1m_3m", 180: "1m_3m", 181: "3m_10m",
              600: "3m_10m", 601: "10m_30m", 1800: "10m_30m", 1801: "30m"}
    assert got == expect and set(expect.values()) - {None} == set(names)
    step_vals = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61]
    df = spark.createDataFrame([(v,) for v in step_vals], "x long")
    cols = [F.when(in_bucket(F.col("x"), lo, hi), F.lit(n)) for n, lo, hi in STEP_BUCKETS]
    got = {r.x: r.b for r in df.select("x", F.coalesce(*cols).alias("b")).collect()}
    assert got == {1: "1_3", 3: "1_3", 4: "4_6", 6: "4_6", 7: "7_9", 9: "7_9", 10: "10_30", 30: "10_30",
                   31: "30_60", 60: "30_60", 61: "60"}


def test_kv_field_random_records(spark):
    import random

    rnd = random.Random(11)
    alphabet = ["a", "b", "=", "|", "1", "x", ""]
    recs = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(600)]
    df = spark.createDataFrame([(r,) for r in recs], "r string")
    got = df.select("r", text.kv_field("r", "a").alias("a"), text.kv_field("r", "b").alias("b")).collect()
    bad = [(g.r, g.a, field_of(g.r, "a")) for g in got
           if g.a != field_of(g.r, "a") or g.b != field_of(g.r, "b")]
    assert not bad, bad[:5]


def test_kv_predicates_random_records(spark):
    """between / in / equal against the Java rules (missing parameter -> true,
    missing field -> false, comma lists split like Java)."""
    import random

    rnd = random.Random(5)

    def record(names):
        parts = []
        for _ in range(rnd.randint(0, 3)):
            name = rnd.choice(names)
            value = rnd.choice(["1", "7", "30", "x", "1,7", "7,", "", "30=", "a,b"])
            parts.append(f"{name}={value}")
        return "|".join(parts)

    rows = [(record(["age", "city"]), record(["lo", "hi", "c"])) for _ in range(400)]
    df = spark.createDataFrame(rows, "d string, p string")
    got = df.select(
        "d", "p",
        text.kv_between("d", "age", F.col("p"), "lo", "hi").alias("b"),
        text.kv_in("d", "city", F.col("p"), "c").alias("i"),
        text.kv_equal("d", "city", F.col("p"), "c").alias("e"),
    ).collect()
    for r in got:
        lo, hi, want = field_of(r.p, "lo"), field_of(r.p, "hi"), field_of(r.p, "c")
        age, city = field_of(r.d, "age"), field_of(r.d, "city")
        if lo is None or hi is None:
            b = True
        else:
            v, a, z = number_of(age), number_of(lo), number_of(hi)
            b = v is not None and a is not None and z is not None and a <= v <= z
        i = True if want is None else (city is not None and bool(items_of(city) & items_of(want)))
        e = True if want is None else (city is not None and city == want)
        assert (r.b, r.i, r.e) == (b, i, e), r


def test_today_and_yesterday(spark):
    from visitlens.functions.dates import today, yesterday

    r = spark.range(1).select(
        today().alias("t"), yesterday().alias("y"), F.date_format(F.current_date(), "yyyy-MM-dd").alias("now"),
        F.date_format(F.date_sub(F.current_date(), 1), "yyyy-MM-dd").alias("before"),
    ).first()
    assert (r.t, r.y) == (r.now, r.before) and len(r.t) == 10
