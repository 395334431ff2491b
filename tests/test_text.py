import pytest
from pyspark.sql import functions as F

from pairsift.functions.text import clean_token, decade_of, token_list, trimmed, whole_number

TOKENS = {
    "'ve": "ve",
    "I": None,
    "19th": "th",
    '"Hello,': "hello",
    "_NOUN_": "noun",
    "café": "caf",
    "dog_NOUN": None,
    "état": "tat",
    "don't": None,
    "x1y": None,
    "תל": "תל",
    'ארה"ב': None,
    "של": "של",
    "ארה״ב": "ארה״ב",
    "": None,
    "   ": None,
    "...": None,
    "1a2": None,
    "--AB--": "ab",
    "ab\n": "ab",
    "\tab \x00": "ab",
    "a b": None,
    "ab cd": None,
    "King": "king",  # the Kelvin sign
    "İstan": "stan",  # its small form is an i and a dot above, which cuts the i off
    "ß": None,
    "שָׁלוֹם": "שָׁלוֹם",
}


def column(spark, values, expression, type_name="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_name}")
    return [r.out for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_clean_token(spark):
    got = column(spark, TOKENS, clean_token)
    expected = [None if k == "İstan" else v for k, v in TOKENS.items()]
    # "i" + dot above + "stan" are two runs of letters.
    assert got == expected


def test_null_token(spark):
    assert column(spark, [None], clean_token) == [None]


def test_long_run_of_other_signs_is_read_once(spark):
    token = "7" * 200_000 + "a"
    assert column(spark, [token, token + "b", token + "b" + token], clean_token) == [None, "ab", None]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("1995", 1995),
        (" 1995\x1f", 1995),
        ("+7", 7),
        ("-7", -7),
        ("007", 7),
        ("2147483647", 2147483647),
        ("2147483648", None),
        ("1995.5", None),
        ("1995.", None),
        ("1e3", None),
        ("199x", None),
        ("+", None),
        ("", None),
        ("1 9", None),
        ("1995\x7f", None),
        (" ١٩٩٥", 1995),
        ("-１9９5", -1995),
        ("१९.५", None),
        ("²", None),
        (None, None),
    ],
)
def test_whole_number(spark, text, expected):
    assert column(spark, [text], lambda c: whole_number(c, "int")) == [expected]


def test_large_count(spark):
    got = column(
        spark, ["9223372036854775807", "9223372036854775808"], lambda c: whole_number(c, "bigint")
    )
    assert got == [9223372036854775807, None]


def test_decade(spark):
    years = [1995, 2000, 1999, 0, 9, -5, -15, 12345]
    assert column(spark, years, decade_of, "int") == [1990, 2000, 1990, 0, 0, 0, -10, 12340]


def test_trim_takes_control_characters_but_no_other_blanks(spark):
    texts = ["\x00 a \x1f", "a ", "a\x01", "", " \t", "\u00a0a", "a\x7f"]
    assert column(spark, texts, trimmed) == ["a", "a", "a", "", "", "\u00a0a", "a\x7f"]


def test_token_list(spark):
    texts = ["\x01 a  b\tc\x02 ", "a\u00a0b c", "a", "", "a \x01 b", "a\x0bb\x0cc\rd\ne"]
    assert column(spark, texts, token_list) == [
        ["a", "b", "c"],
        ["a\u00a0b", "c"],
        ["a"],
        [],
        ["a", "\x01", "b"],
        ["a", "b", "c", "d", "e"],
    ]
