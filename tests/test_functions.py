import pytest
from pyspark.sql import functions as F

from ticklake.functions import paths, times
from ticklake.sources.files import pair

from .conftest import rows


@pytest.mark.parametrize(
    ("text", "ms"),
    [
        ("1735689600000", 1735689600000),
        ("1735689600000.7", 1735689600000),
        ("1.7356896000009E12", 1735689600000),
        ("-1.7", -1),
        ("2025-12-31T19:00:00.000000+00:00", 1767207600000),
        ("2025-12-31T20:00:00+01:00", 1767207600000),
        ("", None),
        ("n/a", None),
        ("NaN", None),
        ("1e300", None),
        (None, None),
    ],
)
def test_every_form_of_an_instant_has_one_value(spark, text, ms):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(times.to_epoch_ms(F.col("t"))).first()[0] == ms


def test_typed_instants_are_not_parsed(spark):
    df = spark.sql("SELECT 5L AS a, TIMESTAMP'1970-01-01 00:00:01.9995' AS b, 7.9D AS c")
    got = df.select(*[times.epoch_ms_of(f.name, f.dataType) for f in df.schema]).first()
    assert tuple(got) == (5, 1999, 7)


def test_stamp_is_utc_with_microseconds(spark):
    df = spark.sql("SELECT 1735689600123.456D AS ms, 0L AS zero")
    got = df.select(times.stamp(F.col("ms")), times.stamp(F.col("zero"))).first()
    assert tuple(got) == ("25-01-01 00:00:00.123456", "70-01-01 00:00:00.000000")
    bad = spark.sql("SELECT 'x' AS t").select(times.stamp_or_null(F.col("t"))).first()
    assert bad[0] is None


def test_now_is_in_milliseconds(spark):
    assert spark.range(1).select(times.now_ms()).first()[0] > 1_700_000_000_000


def test_buckets_of_negative_instants(spark):
    df = spark.createDataFrame([(-1,), (0,), (9,), (10,)], "ms long")
    assert [r[0] for r in df.select(times.bucket_ms(F.col("ms"), 10)).collect()] == [-10, 0, 0, 10]


@pytest.mark.parametrize(
    ("parts", "ms", "expected"),
    [
        (["north_depth_books"], 1699999999999, "north/depth/books_1699999999999.json"),
        (["north", "depth", "books"], 1699999999999, "north/depth/books_1699999999999.json"),
        (["north_depth", "books"], 0, "north/depth/books_0.json"),
        (["two__gaps"], 7, "two//gaps_7.json"),
    ],
)
def test_layout(spark, parts, ms, expected):
    asset = paths.asset_path(*[F.lit(p) for p in parts])
    path = paths.snapshot_path(asset, F.lit(ms))
    got = spark.range(1).select(
        path, paths.sidecar_path(path), paths.exchange_of(path), paths.file_name(path), paths.directory(path)
    ).first()
    folder, name = expected.rsplit("/", 1)
    assert tuple(got) == (
        expected, expected.replace(".json", ".meta.json"), expected.split("/")[0], name, folder,
    )


def test_prefix_does_not_match_longer_siblings(spark):
    names = ["a/raw/tickers_1.json", "a/raw/tickers_old_1.json", "a/raw/tickers2_1.json", "a/raw/tickers_1.meta.json"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    assert rows(df.filter(paths.under_prefix(F.col("p"), "a/raw/tickers"))) == [(names[0],)]


def test_pairing_by_name_survives_a_missing_sidecar(spark):
    data = spark.createDataFrame([("d/x_1.json",), ("d/x_2.json",), ("d/x_3.json",)], "file_path string")
    side = spark.createDataFrame([("d/x_1.meta.json", "true"), ("d/x_3.meta.json", "false")], "file_path string, loaded string")
    assert rows(pair(data, side)) == [("d/x_1.json", "true"), ("d/x_2.json", None), ("d/x_3.json", "false")]
