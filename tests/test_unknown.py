"""Fields outside the contract are kept and reported."""

import json

from ticklake.operators import unknown

TEXTS = [
    {"metadata": {"timestamp": 5.7, "exchange_id": "x"}, "data": {"A/B": {"symbol": "A/B", "last": 1, "fee": 1, "info": {"q": [1, 2]}}, "C": {"last": 2, "fee": "free", "gone": None}}},
    {"metadata": {}, "data": {"A/B": {"fee": 2.5}, "D": 7}},
    {"data": {}},
    {"data": [1]},
    [1],
]


def lines(spark):
    return spark.createDataFrame([(json.dumps(t),) for t in TEXTS] + [("{oops",), (None,), ('{"data": {"E": {"x": 1, "x": 2}}}',)], "value string")


def test_report_names_types_and_counts(spark):
    got = {r.field: (r.kind, r.tickers, r.venues) for r in unknown.report(unknown.ticker_fields(lines(spark))).collect()}
    assert got == {"fee": ("VARIANT", 3, 1), "info": ("OBJECT<q: ARRAY<BIGINT>>", 1, 1), "gone": ("VOID", 1, 1)}


def test_extras_keep_contents(spark):
    got = {(r.exchange_id, r.extraction_timestamp, r.symbol): r.extras for r in unknown.extras(unknown.ticker_fields(lines(spark))).collect()}
    assert got == {
        ("x", 5, "A/B"): {"fee": "1", "info": '{"q":[1,2]}'},
        ("x", 5, "C"): {"fee": '"free"', "gone": "null"},
        (None, None, "A/B"): {"fee": "2.5"},
    }
    assert unknown.report(unknown.ticker_fields(lines(spark).limit(0))).count() == 0
