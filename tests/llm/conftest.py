import pytest

LONG = " ".join(f"word{i % 977} and" for i in range(20_000))
KEY = "AKIA" + "ABCD1234EFGH5678"
ODD = [
    (0, None, "en", "a"), (1, "", "en", "a"), (2, " \n\t", None, "b"), (3, "One", "en", None),
    (4, "one two", "fr", "b"), (5, "ONE TWO", "fr", "b"), (6, "ÉCOLE É x　y z", "fr", "c"),
    (7, LONG, "en", "a"), (8, "the same line " * 300, "en", "a"), (9, "1234 5678 --", "de", "c"),
    (10, f"password = 'hunter22x' {KEY} token:short secret: token = abcdefgh", "en", "a"),
    (11, f"see {KEY} 0123456789abcdef0123456789abcdef", "en", "b"),
    (12, "日本語 passwd=\"zz9+/zz==\" api_key=0123456789abcdef01234567 😀 Secret=a1b2c3d4", "en", "c"),
    (13, "Released under the MIT License. GNU General Public License, CC BY, cc by cc by", "en", "a"),
    (14, "Licensed under the Apache License, Version 2.0.", "en", "b"),
    (15, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen", "en", "a"),
    (16, "x one two three four five six seven eight nine ten eleven twelve thirteen y tiny item", "en", "b"),
    (17, "a  double   space\r\n and <|endoftext|> inside é à", "fr", None),
    (18, "the same line " * 300, "en", "a"), (19, "token=token=abcdef AKIAAKIA- AKIA", "en", "a"),
]
ITEMS = [(1, "One two three four five six seven eight nine ten eleven twelve thirteen"),
         (2, "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"),
         (3, "tiny item"), (4, None), (5, ""), (3, "tiny item"), (None, "the same line")]
# Columns with names that the operators use themselves.
CLASH = ("_id long, size string, shard string, matches string, _text double, word string, "
         "_label string, _m string, _k1 int, _k2 string, _n long, copies string, _copies int, "
         "_row string, _t string, taken string, `a.b` string")
VALUES = (-1, "s", "t", "m", 0.5, "w", "label", "m1", 7, "k", -9, "three", 8, "r", "tt", "no", "dot")


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(*r, *VALUES) for r in ODD]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, " + CLASH).repartition(3)


@pytest.fixture(scope="session")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")
