import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cartwheel.functions import jsonfns, text, timefns
from cartwheel.schemas import STARTUP_CASTS, STARTUP_FIELDS


def test_log_date_hour_midnight_edges(spark):
    midnight = int(dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc).timestamp() * 1000)
    df = spark.createDataFrame([(midnight - 1,), (midnight,), (midnight + 1,)], "ts long")
    rows = timefns.with_log_date_hour(df).orderBy("ts").collect()
    assert [(r.log_date, r.log_hour) for r in rows] == [
        ("2024-01-01", "23"), ("2024-01-02", "00"), ("2024-01-02", "00")]


def test_epoch_ms_floors_microseconds(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0, 999999),)], "t timestamp_ntz")
    assert df.select(timefns.epoch_ms("t").alias("ms")).first().ms == 1704067200999


def test_create_date_hour_text_split(spark):
    df = spark.createDataFrame([("2019-03-04 07:15:00",)], "create_time string")
    r = timefns.with_create_date_hour(df).first()
    assert (r.create_date, r.create_hour) == ("2019-03-04", "07")


def test_create_hour_strict_raises_and_lenient_nulls(spark):
    df = spark.createDataFrame([("2019-03-04",)], "create_time string")
    with pytest.raises(PySparkException):
        timefns.with_create_date_hour(df).collect()
    r = timefns.with_create_date_hour(df, strict=False).first()
    assert r.create_date == "2019-03-04" and r.create_hour is None


def test_age_years_uses_365_day_years(spark):
    # 2000-01-01 .. 2024-01-01 is 24 calendar years but 8766 days = 24.016 x 365
    df = spark.createDataFrame([("2000-01-01",), ("2000-01-10",), ("2023-12-31",)], "b string")
    ages = [r.a for r in df.select(timefns.age_years("b", "2024-01-01 00:00:00").alias("a")).collect()]
    assert ages == [24, 23, 0]


def test_previous_day_and_alert_id(spark):
    df = spark.createDataFrame([("2024-03-01", "7", 120_000 * 3 + 59_999)], "d string, mid string, ts long")
    r = df.select(timefns.previous_day("d").alias("p"), timefns.alert_id("mid", "ts").alias("a")).first()
    assert r.p == "2024-02-29" and r.a == "76"


def test_tokens_split_and_cjk(spark):
    df = spark.createDataFrame([("Hello, World! 羽毛球 x2-y",)], "t string")
    toks = df.select(text.tokens("t").alias("k")).first().k
    assert toks == ["hello", "world", "羽", "毛", "球", "x2", "y"]
    assert text.analyse("Hello 羽毛球") == ["hello", "羽", "毛", "球"]


def test_term_and_match(spark):
    df = spark.createDataFrame([(1, "Big ball game"), (2, "small ball"), (3, "nothing")], "id int, t string")
    ids = lambda c: sorted(r.id for r in df.where(c).collect())
    assert ids(text.term("t", "ball")) == [1, 2]
    assert ids(text.term("t", "Ball")) == []          # term is not analysed
    assert ids(text.match("t", "BALL nothing")) == [1, 2, 3]
    assert ids(text.match("t", "ball game", "and")) == [1]


def test_decode_failfast_and_permissive(spark):
    good = '{"mid":"m1","uid":"u1","ts":"1704067200000","type":"startup"}'
    bad_num = '{"mid":"m2","uid":"u2","ts":"abc"}'
    bad_json = "{not json"
    df = spark.createDataFrame([(good,), (bad_num,), (bad_json,)], "value string")
    dec = jsonfns.decode(df, STARTUP_FIELDS, STARTUP_CASTS, mode="permissive")
    ok, bad = jsonfns.split_corrupt(dec)
    assert [(r.mid, r.ts) for r in ok.collect()] == [("m1", 1704067200000)]
    assert sorted(r._raw for r in bad.collect()) == sorted([bad_num, bad_json])
    for bad_row in (bad_num, bad_json):     # fail-fast: both a bad number and bad JSON raise
        one = spark.createDataFrame([(bad_row,)], "value string")
        with pytest.raises(Exception):
            jsonfns.decode(one, STARTUP_FIELDS, STARTUP_CASTS).collect()


def test_quoted_numbers_are_coerced(spark):
    df = spark.createDataFrame([('{"ts": 12, "mid": 7}',)], "value string")
    r = jsonfns.decode(df, STARTUP_FIELDS, STARTUP_CASTS).first()
    assert r.ts == 12 and r.mid == "7"


def test_after_image_json_duplicates_and_nulls(spark):
    df = spark.createDataFrame([([("id", "1"), ("name", None), ("id", "2")],)],
                               "after array<struct<name:string,value:string>>")
    assert df.select(jsonfns.after_image_json("after").alias("j")).first().j == '{"id":"2","name":null}'


def test_regex_match_equals_token_match(spark):
    texts = ["que", "Que,la", "quela", "laque que", "x que羽la", "羽que", "quea", "aque", "QUE!", "la-1que",
             "ñque", "queñ", "que1", "1que", "", None, "  la  ", "lá", "que\nla", "毛球", "球"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    for q, op in [("que la", "or"), ("que la", "and"), ("球", "or"), ("que 球", "and"), ("que 1", "or")]:
        qa = F.array(*[F.lit(x) for x in text.analyse(q)])
        ref = F.arrays_overlap(text.tokens("t"), qa) if op == "or" else \
            F.size(F.array_except(qa, text.tokens("t"))) == 0
        rows = df.select("id", text.match("t", q, op).alias("m"), ref.alias("r")).collect()
        assert [bool(r.m) for r in rows] == [bool(r.r) for r in rows], (q, op)
    for v in ["que", "Que", "q-e", "羽", "羽毛"]:
        ref = F.array_contains(text.tokens("t"), F.lit(v))
        rows = df.select(text.term("t", v).alias("m"), ref.alias("r")).collect()
        assert [bool(r.m) for r in rows] == [bool(r.r) for r in rows], v


def test_calendar_age_option(spark):
    df = spark.createDataFrame([("2000-02-29",), ("2000-03-01",)], "b string")
    ages = [r.a for r in df.select(timefns.age_years("b", "2024-02-29 00:00:00", calendar=True).alias("a")).collect()]
    assert ages == [24, 23]


def test_cluster_session_requires_shared_checkpoint_folder():
    from cartwheel.session import checkpoint_root

    class Conf(dict):
        def get(self, k, default=None):
            return dict.get(self, k, default)

        def set(self, k, v):
            self[k] = v

    class Ctx:
        master = "yarn"
        _dir = None

        def getCheckpointDir(self):
            return self._dir

        def setCheckpointDir(self, d):
            self._dir = d

    class Session:
        conf = Conf()
        sparkContext = Ctx()

    with pytest.raises(RuntimeError):
        checkpoint_root(Session())
    s = Session()
    s.conf = Conf({"spark.checkpoint.dir": "hdfs://nn/shared/ckpt/"})
    assert checkpoint_root(s) == "hdfs://nn/shared/ckpt"
