"""The strict parser against Python's, and the falsy and cast rules."""

import json

from pyspark.sql import functions as F

from cardwarden.streaming import ingest

ODD = [
    '{"TransactionID":1,"ProductCD":"x"}', '{"TransactionID":1}] x', '{"TransactionID":1}, {"b":2}',
    '{"TransactionID":1} x', '{"TransactionID":1} {"b":2}', "{'TransactionID':1}", "", "null", "1",
    "[1]", '[{"TransactionID":1}]', '{"TransactionID":NaN}', '{"TransactionID":1,"TransactionID":2}',
    '{"TransactionID":01}', '{"TransactionID":1,}', '{"TransactionID":1}}', '{"card1":{"z":[1,2]}}',
    '{"TransactionID":12345678901234567890}', '{"TransactionAmt":1e400}', '{"TransactionAmt":-0.0}',
    '{"ProductCD":"tab\there"}', '﻿{"TransactionID":1}', '  {"TransactionID":1} \n',
    '{"TransactionAmt":Infinity}', '{"TransactionAmt":INF}', '{"TransactionAmt":+INF}',
    '{"other":[-INF]}', '{"ProductCD":"+INF"}', '{"ProductCD":"\\"+INF"}', '{"TransactionAmt":+1}',
    '{"TransactionAmt":.5}', '{"TransactionAmt":5.}', '/*c*/{"a":1}', "{a:1}", '{"TransactionID":1',
    '{"TransactionID":1,"b":}', '"x"', "{}", '{"a":tru}', '{"a":"\\x"}', '{"a":"\\u00e9é"}',
    '{"a":1}, {"__seal":"0"}', '{"a":1},{"__seal":"0"}] x', '{"__seal":"0"}', "true", "   ",
]


def _is_object(text):
    try:
        return isinstance(json.loads(text), dict)
    except ValueError:
        return False


def _messages(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, value string")


def test_parser_accepts_what_python_accepts(spark):
    parsed = ingest.parse_messages(_messages(spark, ODD))
    rows = parsed.select("i", F.col("fields").isNotNull().alias("ok")).orderBy("i").collect()
    wrong = [ODD[r.i] for r in rows if r.ok != _is_object(ODD[r.i])]
    assert wrong == []


def test_bytes_that_are_not_utf8(spark):
    rows = [(0, bytearray(b'{"TransactionID": 1}')), (1, bytearray(b'{"ProductCD": "\xff\xfe"}'))]
    parsed = ingest.parse_messages(spark.createDataFrame(rows, "i int, value binary"))
    got = parsed.select("i", F.col("fields").isNotNull().alias("ok")).orderBy("i").collect()
    assert [r.ok for r in got] == [True, False]


def test_missing_fields_follow_truthiness(spark):
    values = [
        "0", "-0.0", "0.0", '""', "null", "false", "[]", "{}", None,
        "1", "-1", '"0"', '" "', "true", "[0]", '{"a":null}', "0.01", "NaN", "1e-300",
    ]
    texts = [
        '{"TransactionID":1,"ProductCD":"W"' + (f',"TransactionAmt":{v}' if v else "") + "}"
        for v in values
    ]
    checked = ingest.validate(ingest.parse_messages(_messages(spark, texts)))
    got = {r.i: r.missing for r in checked.select("i", "missing").collect()}
    for i, text in enumerate(texts):
        falsy = not json.loads(text).get("TransactionAmt")
        assert got[i] == (["TransactionAmt"] if falsy else []), text


def _python_cast(to, value):
    try:
        cast = to(value)
        return cast if not isinstance(cast, int) or abs(cast) < 2**63 else None
    except (TypeError, ValueError, OverflowError):
        return None


def test_casts_follow_python(spark):
    values = [
        "5", '"5"', '" 5 "', '"+5"', '"-7"', "12.7", '"12.7"', '"abc"', "true", '"1_000"', '"1__0"',
        '"1e3"', "1e3", '"1.0d"', '"0x10"', '"nan"', '"-inf"', '"Infinity"', "NaN", "[1]",
        '{"a":1}', "12345678901234567890", '"9223372036854775807"', '"9223372036854775808"',
        '".5"', '"5."', '"1_0.2_5"', '"."', "-3.9",
    ]
    texts = [f'{{"card1":{v},"addr1":{v}}}' for v in values]
    cast = ingest.cast_fields(ingest.validate(ingest.parse_messages(_messages(spark, texts))))
    rows = cast.select("i", "record.card1", "record.addr1", "bad_fields").collect()
    for r in rows:
        value = json.loads(values[r.i])
        want = _python_cast(int, value), _python_cast(float, value)
        assert repr((r.card1, r.addr1)) == repr(want), values[r.i]
        assert set(r.bad_fields) == {n for n, v in zip(("card1", "addr1"), want) if v is None}


def test_guarded_fields_may_be_falsy(spark):
    text = (
        '{"TransactionID":"7","TransactionAmt":"1.5","ProductCD":5,"card1":"","addr1":0,'
        '"addr2":null,"dist1":[],"isFraud":null}'
    )
    row = ingest.route_messages(_messages(spark, [text])).first()
    assert row.route == "valid"
    assert (row.record.TransactionID, row.record.TransactionAmt) == (7, 1.5)
    assert row.record.ProductCD == "5"
    assert (row.record.card1, row.record.addr1, row.record.dist1) == (None, 0.0, None)


def test_nested_value_in_a_text_field_is_a_cast_error(spark):
    text = '{"TransactionID":7,"TransactionAmt":1,"ProductCD":{"a":1}}'
    row = ingest.route_messages(_messages(spark, [text])).first()
    assert (row.route, row.bad_fields, row.value) == ("cast_error", ["ProductCD"], text)


def test_a_message_is_parsed_once(spark):
    routed = ingest.route_messages(_messages(spark, ODD))
    for frame in (ingest.conform(routed), ingest.dead_letters(routed), ingest.stream_totals(routed)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json") == 1


def test_fractions_are_cast_errors_but_for_two_fields(spark):
    base = '"TransactionID":12,"TransactionAmt":5,"ProductCD":"W","TransactionDT":1'
    texts = ["{" + base + x + "}" for x in (', "isFraud": 0.7', ', "tx_hour": 3.9', ', "card1": 3.9', ', "tx_hour": 4.0')]
    cast = ingest.cast_fields(ingest.validate(ingest.parse_messages(_messages(spark, texts))))
    rows = cast.select("i", "bad_fields", "record.card1", "record.tx_hour").orderBy("i").collect()
    assert [list(r.bad_fields) for r in rows] == [["isFraud"], ["tx_hour"], [], []]
    assert rows[2].card1 == 3 and rows[3].tx_hour == 4
