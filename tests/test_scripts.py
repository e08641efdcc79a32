"""Script replies, read by tokens."""

import json

import pytest
from pyspark.sql import functions as F

from quillstack.sources import scripts

REPLIES = [
    ('[{a:"x, b: y"}]', [{"a": "x, b: y"}]),
    ("cb([{a:'it\\'s \"q\"', 'b': [1, [2, [3]]], 3: .5,}]);", [{"a": "it's \"q\"", "b": [1, [2, [3]]], "3": 0.5}]),
    ("/* f([0]) */ f(1, 'two', [new Date(1742754600000), new Date(\"2024-01-02\"), new Map(1, 2), g(x.y, [1])]) // f(2)", [1742754600000, "2024-01-02", ["Map", [1, 2]], ["g", ["x.y", [1]]]]),
    ("var x = {t: true, f: false, n: null, u: undefined, nan: NaN, neg: -1, plus: +2, hex: 0xff, big: 1e3, no: !1};",
     {"t": True, "f": False, "n": None, "u": None, "nan": None, "neg": -1, "plus": 2, "hex": 255, "big": 1000.0, "no": False}),
    ("[1,,2,]", [1, None, 2]),
    ("f(['a' + \"b\" + 'c', '\\x41\\u0042\\u{1F600}\\ud83d\\ude00\\n\\\n', (5)])", ["abc", "AB😀😀\n", 5]),
    ("throw 'allowScriptTagRemoting is false.';\n(function(){\nvar r=window.dwr._[0];\n//#DWR-REPLY\nr.handleCallback(\"0\",\"0\",[[null,1,\"f(a, [b])\"]]);\n})();", [[None, 1, "f(a, [b])"]]),
    ("f('[1]')", "[1]"),
    ("f()", None), ("", None), ("no data", None), ("f([1", None), ("f([1 2])", None), ("{a 1}", None), ("f('open)", None), ("[" * 5000, None), (None, None), ("f([-'x'])", None),
    ("['\\ud800']", ["�"]),
]


def test_script_data(spark):
    rows = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(REPLIES)], "k int, t string")
    got = {r["k"]: r["j"] for r in rows.select("k", scripts.script_data(F.col("t")).alias("j")).collect()}
    for k, (text, want) in enumerate(REPLIES):
        assert (None if got[k] is None else json.loads(got[k])) == want, text


@pytest.mark.parametrize("callee, want", [("handle", [["x"], 1]), ("first", [[]]), ("other", None)])
def test_arguments_of_a_call(spark, callee, want):
    text = "first([]); r.handle(['x'], 1); if (handle) { a.b.handle(2) } 'other(3)'"
    got = spark.range(1).select(scripts.call_arguments(F.lit(text), callee)).first()[0]
    assert (got and json.loads(got)) == want


def test_script_variants_are_typed(spark):
    row = spark.range(1).select(scripts.script_variant(F.lit("f({a: [new Date(5), 'x']})")).alias("v"), scripts.script_variant(F.lit("f(")).alias("none"))
    assert row.select(F.try_variant_get("v", "$.a[0]", "long"), F.col("none").isNull()).first()[:] == (5, True)
