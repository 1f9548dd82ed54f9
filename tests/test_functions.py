"""Hand-written edge rows of the scalar, collection and user functions."""

from __future__ import annotations

import base64
import hashlib
import hmac as std_hmac

import pytest
from pyspark.sql import functions as F

from rillstone.functions import collections as coll
from rillstone.functions import extensions, signing, strings
from rillstone.plans.aggregates import AverageParts
from tests.conftest import rows

# What the JVM's split gives.
SPLITS = {
    "": [""], " ": [], "   ": [], "a  b  ": ["a", "", "b"], " a": ["", "a"], "a b": ["a", "b"], "x": ["x"],
}


def test_java_split(spark):
    df = spark.createDataFrame([(s,) for s in SPLITS], "s string")
    for parts in (strings.java_split(F.col("s"), " "), strings.java_split(F.col("s"), "[ ]", regex=True)):
        assert {r[0]: r[1] for r in df.select("s", parts).collect()} == SPLITS


def test_java_split_other_separators(spark):
    df = spark.createDataFrame([("a_b_",), ("_",), ("a||b||",), ("a|b",)], "s string")
    got = df.select(strings.java_split(F.col("s"), "_"), strings.java_split(F.col("s"), "||")).collect()
    assert [r[0] for r in got] == [["a", "b"], [], ["a||b||"], ["a|b"]]
    assert [r[1] for r in got] == [["a_b_"], ["_"], ["a", "b"], ["a|b"]]


def python_hash(s, factor):
    h = 0
    data = s.encode("utf-16-be")
    for i in range(0, len(data), 2):
        h = (h * 31 + data[i] * 256 + data[i + 1]) & 0xFFFFFFFF
    h = h * factor & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


def test_java_hash(spark):
    texts = ["", "sensor_1", "é😀x", "a" * 5000]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [tuple(r) for r in df.select(strings.java_hash(F.col("s")), strings.java_hash(F.col("s"), 23)).collect()]
    assert got == [(python_hash(t, 13), python_hash(t, 23)) for t in texts]
    assert got[1][0] == -772373508
    assert spark.sql("select cast(null as string) as s").select(strings.java_hash(F.col("s"))).first()[0] is None


def test_utf16_length(spark):
    df = spark.createDataFrame([("",), ("abc",), ("é😀",)], "s string")
    assert [r[0] for r in df.select(strings.utf16_length(F.col("s"))).collect()] == [0, 3, 3]


def test_find_all(spark):
    text = '"value""value with embedded \\" quote"'
    df = spark.createDataFrame([(text, "123-34345-234-00")], "a string, b string")
    found = df.select(strings.find_all(F.col("a"), strings.QUOTED_STRING, 1),
                      strings.find_all(F.col("b"), strings.DIGIT_RUN)).first()
    assert found[0] == ["value", 'value with embedded \\" quote']
    assert found[1] == ["123", "34345", "234"]
    long = spark.createDataFrame([('"' + "x" * 200_000 + '"',)], "s string")
    assert len(long.select(strings.find_all(F.col("s"), strings.QUOTED_STRING, 1)).first()[0][0]) == 200_000


@pytest.mark.parametrize("algorithm", ["sha1", "sha256"])
@pytest.mark.parametrize("key", [b"k", b"x" * 64, b"y" * 200, "schlüssel".encode()])
def test_signatures(spark, algorithm, key):
    paths = ["/a?b=1", "/查询?x=%20", ""]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    parts = lambda: [F.lit("GET"), F.lit(None).cast("string"), F.col("path")]
    signed = signing.sign_requests(df, parts(), key, algorithm)
    want = [
        base64.b64encode(std_hmac.new(key, f"GET\n\n{p}".encode(), getattr(hashlib, algorithm)).digest()).decode()
        for p in paths
    ]
    assert [r["signature"] for r in signed.collect()] == want
    tampered = signed.withColumn("path", F.concat("path", F.lit("!")))
    assert {r["valid"] for r in signing.verify_requests(tampered, parts(), F.col("signature"), key, algorithm).collect()} == {False}


def test_key_is_not_in_the_plan(spark, capsys):
    df = spark.createDataFrame([("a",)], "path string")
    signing.sign_requests(df, [F.col("path")], b"very-private").explain("extended")
    shown = capsys.readouterr().out
    pad = bytes(b ^ 0x36 for b in b"very-private")
    assert pad.hex().upper() not in shown.upper() and "very-private" not in shown


def test_url_coding(spark):
    df = spark.createDataFrame([("2022年07月",), ("a b*~+",)], "s string")
    got = df.select(signing.url_encode(F.col("s"))).collect()
    assert [r[0] for r in got] == ["2022%E5%B9%B407%E6%9C%88", "a+b*%7E%2B"]
    assert rows(df.select(signing.url_decode(signing.url_encode(F.col("s"))))) == rows(df)


def test_collections(spark):
    df = spark.createDataFrame([([3, 1, 2, 5], {"a": "x"}), ([], {})], "a array<int>, m map<string,string>")
    small, large = coll.partition_pivot(F.col("a"), coll.half_length(F.col("a")))
    got = df.select(coll.sort_ints(F.col("a"), False), small, large, coll.upper_values(F.col("m")),
                    coll.zip_apply(F.col("a"), F.col("a"), lambda x, y: x + y)).collect()
    assert tuple(got[0]) == ([5, 3, 2, 1], [1, 2], [3, 5], {"a": "X"}, [6, 2, 4, 10])
    assert tuple(got[1]) == ([], [], [], {}, [])


def test_setup_runs_once_per_partition(spark, tmp_path):
    log = str(tmp_path / "log")

    def setup():
        with open(log, "a") as f:
            f.write("open\n")
        return 1

    def teardown(_):
        with open(log, "a") as f:
            f.write("close\n")

    df = spark.range(0, 100, 1, 3)
    out = extensions.map_with_setup(df, setup, lambda k, b: b.assign(id=b.id + k), teardown, "id bigint")
    assert rows(out) == [(i + 1,) for i in range(100)]
    lines = open(log).read().split()
    assert lines.count("open") == lines.count("close") == 3


def test_user_functions(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "id string, v double")
    df.createOrReplaceTempView("uf")
    twice = extensions.register_scalar(spark, "twice", lambda s: s * 2, "double")
    assert rows(df.select(twice("v"))) == rows(spark.sql("select twice(v) from uf")) == [(2.0,), (6.0,), (10.0,)]
    got = extensions.aggregate_by_key(df, "id", "v", AverageParts(), "avg")
    assert rows(got) == [("a", 2.0), ("b", 5.0)]
    assert rows(extensions.reduce_by_key(df, "id", "v", lambda a, b: a + b, "s")) == [("a", 4.0), ("b", 5.0)]


def test_user_aggregate_with_nulls_and_flushes(spark, monkeypatch):
    df = spark.range(0, 5000, 1, 4).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("k"), (F.col("id") * 1.0).alias("v")
    )
    monkeypatch.setattr(extensions, "PARTIAL_KEYS", 2)
    got = extensions.aggregate_by_key(df, "k", "v", AverageParts(), "avg")
    assert rows(got) == rows(df.groupBy("k").agg(F.avg("v")))


def test_average_skips_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "v double")
    assert df.agg(extensions.average_from_parts(F.col("v"))).first()[0] == 1.0
