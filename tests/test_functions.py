"""Scalar rules: padding, numbers, flags, dates and JSON text."""

import pytest
from pyspark.sql import functions as F

from slotline.functions import json_text, text


def values(spark, function, *inputs):
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [row[0] for row in frame.orderBy("i").select(function(F.col("x"))).collect()]


@pytest.mark.parametrize(
    "value, width, fill, expected",
    [
        ("123456789", 7, "0", "1234567"),
        ("12.5", 7, "0", "00012.5"),
        ("12.50", 7, "0", "0012.50"),
        ("7", 7, "0", "0000007"),
        ("-5.00", 7, "0", "00-5.00"),
        ("0.04750", 5, "0", "0.047"),
        ("", 3, "0", "000"),
        (None, 3, "0", None),
    ],
)
def test_left_pad_cuts_and_fills(spark, value, width, fill, expected):
    assert values(spark, lambda x: text.left_pad(x, width, fill), value) == [expected]


def test_right_pad(spark):
    assert values(spark, lambda x: text.right_pad(x, 6), "Montgomery", "Lee", "") == ["Montgo", "Lee   ", " " * 6]


def test_dates_are_replaced_as_text(spark):
    assert values(spark, text.date_text, "2025-12-12") == ["20251212"]
    spaced = lambda x: text.left_pad(text.date_text(x, " "), 8, "0")
    assert values(spark, spaced, "2025-12-12", "0") == ["2025 12 ", "00000000"]


@pytest.mark.parametrize(
    "word, expected",
    [
        ("100.50", "100.50"), ("007.10", "7.10"), ("+5", "5"), (".5", "0.5"), ("5.", "5"), ("-0", "0"), ("-0.00", "0.00"),
        ("1234567890123456789012", "1234567890123456789012"), ("1.5e3", "1500"), ("1e25", "1" + "0" * 25), ("1.5E-20", "0." + "0" * 19 + "15"), ("NaN", "NaN"), ("-0e5", "0"), ("-12.5e1", "-125"), ("00.5e1", "5"), ("1.50e1", "15.0"), ("1e999999", None), ("1.5E-3", "0.0015"), ("1.50e0", "1.50"),
        ("abc", None), ("", None), ("1,5", None), (" 12 ", "12"),
    ],
)
def test_number_text(spark, word, expected):
    assert values(spark, text.number_text, word) == [expected]


def test_number_text_keeps_plain_digits(spark):
    assert values(spark, text.number_text, "100.50", "0.05", "-2.00", None) == ["100.50", "0.05", "-2.00", None]


def test_flags(spark):
    words = ["true", " ON ", "y", "1", "f", "off", "No", "0", "maybe", "o", None]
    assert values(spark, text.flag, *words) == [True] * 4 + [False] * 4 + [None] * 3
    as_letter = lambda x: text.yes_no(text.flag(x), "Y", "N")
    assert values(spark, as_letter, "on", "off", "maybe", None) == ["Y", "N", "N", "N"]


def test_code_types(spark):
    codes = ["M545", "U071", "S72001A", "m545", None]
    assert values(spark, text.type_by_letter, *codes) == ["0", "9", "0", "9", " "]
    assert values(spark, text.type_by_length, *codes) == ["9", "9", "0", "9", " "]


def test_bare_numbers_keep_their_digits(spark):
    documents = [
        '{"totalBilledAmount":100.50}',
        '{"totalBilledAmount" : 7 ,"planCode":"x"}',
        '{"totalBilledAmount":1234567890123456789012}',
        '{"totalBilledAmount":"12.50"}',
        '{"beneficiaryLastName":"a\\"totalBilledAmount\\":5.10","totalBilledAmount":-0.50}',
        '{"beneficiaryLastName":": 5 stars","totalBilledAmount":1.0}',
        '{"serviceLines":[{"billedAmount":1.10}],"totalBilledAmount":null}',
    ]
    got = values(spark, lambda x: json_text.parse_claim(x)["totalBilledAmount"], *documents)
    assert got == ["100.50", "7", "1234567890123456789012", "12.50", "-0.50", "1.0", None]
    names = values(spark, lambda x: json_text.parse_claim(x)["beneficiaryLastName"], *documents[4:6])
    assert names == ['a"totalBilledAmount":5.10', ": 5 stars"]
    assert values(spark, lambda x: json_text.parse_claim(x)["serviceLines"][0]["billedAmount"], documents[6]) == ["1.10"]


def test_arrays_read_as_text(spark):
    cutbacks = lambda x: json_text.spaced_json(json_text.parse_claim(x)["cutbackAmounts"])
    documents = [
        '{"cutbackAmounts":[12.50,7]}',
        '{"cutbackAmounts": [ 1.0 , 2.50]}',
        '{"cutbackAmounts":["a,b","c:\\"d"]}',
        '{"cutbackAmounts":"a,b"}',
        '{"cutbackAmounts":[{"k":"v"},1]}',
        '{"cutbackAmounts":[]}',
    ]
    got = values(spark, cutbacks, *documents)
    assert got == ["[12.50, 7]", "[1.0, 2.50]", '["a,b", "c:\\"d"]', "a,b", '[{"k": "v"}, 1]', "[]"]


def test_nested_values_keep_their_digits(spark):
    cutbacks = lambda x: json_text.spaced_json(json_text.parse_claim(x)["cutbackAmounts"])
    line = lambda x: json_text.spaced_json(json_text.parse_claim(x)["serviceLines"][0]["cutbackAmounts"])
    name = lambda x: json_text.parse_claim(x)["beneficiaryLastName"]
    texts = {
        '{"a":1.50}': '{"a": 1.50}',
        '[1.50,"x"]': '[1.50, "x"]',
        '["x",[2.00,{"b":[1.10,null]}],true]': '["x", [2.00, {"b": [1.10, null]}], true]',
        '{ "a" : 1.50 ,\n "b" : "c  d, \\"e\\": 1.0 ]" }': '{"a": 1.50, "b": "c  d, \\"e\\": 1.0 ]"}',
        '{"serviceLines":[{"x":1.0}],"u":"\\u00e9\\\\"}': '{"serviceLines": [{"x": 1.0}], "u": "\\u00e9\\\\"}',
        "{}": "{}",
        '[["a"],["b"]]': '[["a"], ["b"]]',
        "[" * 12 + "1.50" + "]" * 12: "[" * 12 + "1.50" + "]" * 12,
    }
    # Two nested values in one document, next to values that aren't.
    documents = [
        f'{{"beneficiaryLastName":"{{\\"k\\":[1.0,2","other":{x},"cutbackAmounts":{x},"serviceLines":[{{"cutbackAmounts":{x}}},1.0]}}'
        for x in texts
    ]
    assert values(spark, cutbacks, *documents) == list(texts.values())
    assert values(spark, line, *documents) == list(texts.values())
    assert values(spark, name, *documents) == ['{"k":[1.0,2'] * len(texts)


def test_long_nested_values(spark):
    cutbacks = lambda x: json_text.parse_claim(x)["cutbackAmounts"]
    long = "[" + ",".join(f'{{"k{i}":{i}.50}}' for i in range(20000)) + ',"x"]'
    open_ = '{"cutbackAmounts":' + "[" * 3000 + '"x"'
    assert values(spark, cutbacks, f'{{"cutbackAmounts":{long}}}', open_) == [long, None]


def test_number_codes_stay_an_array(spark):
    first = lambda x: F.get(json_text.parse_claim(x)["diagnosisCodes"], F.lit(0))
    assert values(spark, first, '{"diagnosisCodes":[25000,4019]}', '{"diagnosisCodes":[]}', "{}") == ["25000", None, None]


def test_lines_that_are_no_array_leave_the_rest_of_the_claim(spark):
    documents = [f'{{"serviceLines":{lines},"macId":"1"}}' for lines in ('{"a":1}', '"x"', "null", "[]")] + ['{"macId":"1"}']
    count = lambda x: F.size(json_text.parse_claim(x)["serviceLines"])
    assert values(spark, count, *documents) == [None, None, None, 0, None]
    assert values(spark, lambda x: json_text.parse_claim(x)["macId"], *documents) == ["1"] * 5


def test_digits_are_kept_from_colon_to_colon(spark):
    """Where the search looks back from a number: odd blanks, times, escaped quotes, long keys and keys that are none."""
    documents = {
        '{"a" : 1.50,"b":[1.0,\n2.50],"t":"12:30:45","u":"k\\": 5.0","c":-0.10}':
            '{"a" : "1.50","b":"[1.0,\n2.50]","t":"12:30:45","u":"k\\": 5.0","c":"-0.10"}',
        '{"diagnosisCodes" : ["x", 1.0 , 2.00],"n":3.0}': '{"diagnosisCodes" : ["x", "1.0" , "2.00"],"n":"3.0"}',
        '{"diagnosisCodes":[],"n"' + " " * 150 + ": 3.0}": '{"diagnosisCodes":[],"n"' + " " * 150 + ': "3.0"}',
        '{"' + "k" * 150 + '":3.0}': '{"' + "k" * 150 + '":"3.0"}',
        '{"o": {"x":1.10},"serviceLines" :[{"p":[1.0,"y"]}]}': '{"o": "{\\"x\\":1.10}","serviceLines" :[{"p":"[1.0,\\"y\\"]"}]}',
        "[1.0]": "[1.0]",
        "": "",
    }
    rows = spark.createDataFrame([(text,) for text in documents], "text string")
    got = {row.text: row.kept for row in rows.select("text", json_text.keep_digits(F.col("text")).alias("kept")).collect()}
    assert got == documents


def test_most_documents_are_seen_to_have_nothing_nested(spark):
    """The fast pattern settles ordinary documents; the one that finds nested values is for the rest."""
    plain = '{"a":1.5,"s":"x, y: z","m":["p","q"],"n":[1.0,2.0],"serviceLines":[{"a":"1"},{"b":null}],"e":[]}'
    rows = spark.createDataFrame([(plain,), ('{"a":{"b":1}}',), ('{"a" : [1,"x"]}',)], "text string")
    settled = rows.select(F.col("text").rlike(json_text._NOT_NESTED).alias("settled")).collect()
    assert [row.settled for row in settled] == [True, False, False]


ODD_DOCUMENTS = [
    '{"macId":10001,"totalBilledAmount":100.50,"diagnosisCodes":[1.50,"A1"],"serviceLines":[{"billedAmount":1.10,"cutbackAmounts":[0.10,2]}]}',
    '{"macId" : "1", "totalBilledAmount" :\n 7.00, "serviceLines": [{"billedAmount": {"paid": 1.10}}, {"cutbackAmounts": ["a", 1.0]}]}',
    '{"macId":{"a": 1.0},"totalBilledAmount":[1.0, 2.50],"serviceLines":[{"cutbackAmounts":["a", "b"],"diagnosisCodes":[1.0]}]}',
    '{"macId":"1","totalBilledAmount":2.50,"serviceLines":["odd",{"billedAmount":3.10},null,5]}',
    '{"macId":"1","totalBilledAmount":2.50,"serviceLines":"none"}',
    '{"macId":"1","totalBilledAmount":2.50,"patientPaidAmount":007.10,"diagnosisCodes":"A"}',
    '{"macId":"1","totalBilledAmount":007.10,"x":{"totalBilledAmount":9.90}}',
    '{"macId":"[1","totalBilledAmount":"say \\"billedAmount\\": 5","serviceLines":[{"billedAmount":"{x"}]}',
    '{"macId":"1","totalBilledAmount":1.0,"totalBilledAmount":2.0,"cutbackAmounts":[1, 2.0]}',
    '{"macId":"1","totalBilledAmount":2.50', "[1]", "null", "", "{}", "{} x", None,
]


@pytest.mark.parametrize(
    "keys, line_keys",
    [
        (("macId", "totalBilledAmount"), ()), (("diagnosisCodes",), ()), ((), ("billedAmount", "cutbackAmounts")),
        (("macId", "cutbackAmounts"), ("billedAmount", "diagnosisCodes")), ((), ("diagnosisCodes",)),
        (json_text.LINE_SCHEMA.names, json_text.LINE_SCHEMA.names),
    ],
)
def test_values_of_some_keys_are_those_of_the_whole_claim(spark, keys, line_keys):
    def picked(document):
        claim = json_text.parse_claim(document)
        of_line = lambda line: F.struct(*[line[key].alias(key) for key in line_keys])
        held = [F.transform(claim["serviceLines"], of_line).alias("serviceLines")] if line_keys else []
        return F.to_json(F.struct(*[claim[key].alias(key) for key in keys], *held))

    few = lambda document: F.to_json(json_text.parse_claim_values(document, keys, line_keys))
    got, want = values(spark, few, *ODD_DOCUMENTS), values(spark, picked, *ODD_DOCUMENTS)
    for document, a, b in zip(ODD_DOCUMENTS, got, want):
        assert (a or "{}") == (b or "{}"), document
