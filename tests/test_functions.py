"""Text, number, identity and token functions against their definitions."""

import hashlib
import unicodedata

import pytest
from pyspark.sql import functions as F

from lectern.functions import ids, numbers, text, tokens

TEXTS = [None, "", "  A  b\tc ", "ẞ Straße ﬁ", "Ａ B", "é́", "İ", "x y", "Mixed CASE"]


def values(spark, rows, column, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, c {kind}")
    return [r.v for r in df.select("i", column(F.col("c")).alias("v")).orderBy("i").collect()]


def test_normalize_key(spark):
    expected = ["" if x is None else " ".join(unicodedata.normalize("NFKC", x).split()).casefold() for x in TEXTS]
    assert values(spark, TEXTS, text.normalize_key) == expected


def test_canonical_url(spark):
    cases = {
        "HTTP://Example.COM:80/Path/": "http://example.com/Path",
        "https://example.com:443": "https://example.com/",
        "https://example.com?x=1": "https://example.com/?x=1",
        "https://u@Example.com/x": "https://u:@example.com/x",
        "https:///x": "https:///x",
        "https://u:P@Example.com:8443/a//?b=2&a=1&c=#frag": "https://u:P@example.com:8443/a?a=1&b=2&c=",
        "http://example.com/": "http://example.com/",
        "  Plain  Text ": "plain text",
        "ftp://X/Y": "ftp://x/y",
        "http://[::1]:80/x": "http://[::1]/x",
    }
    assert values(spark, list(cases), text.canonical_url) == list(cases.values())


def test_html_text(spark):
    page = "<p>One&nbsp;<b>two</b></p><div>three &amp;amp; four</div><script>x</script>\n\n<br>five"
    assert values(spark, [page, None, ""], text.html_text) == ["One two\nthree & four\nx\nfive", "", ""]
    ends = ["a\rb c", "a\r\nb\u2028c\u0085d\x0be", "\u2003 a\t \tb\u2003", "<p>Первый&nbsp;текст</p><ul><li>Второй</li></ul>", "&amp;lt;b&amp;gt;", "<p>a"]
    assert values(spark, ends, text.html_text) == ["a\nb c", "a\nb\nc\nd\ne", "a b", "Первый текст\nВторой", "<b>", "a"]


def test_html_text_of_cut_entities(spark):
    cut = ["<title>a &amp</title><p>b &amp;", "x &copy y &copy; &amp;copy; &notit;", "a&am<b>p;", "<script>if (a && b &amp c)</script>&#65; &#66 &bogus;", None]
    assert values(spark, cut, lambda c: text.html_text(c, closed=True)) == ["a &amp\nb &", "x &copy y © © &notit;", "a&", "if (a && b &amp c)A &#66 &bogus;", ""]
    assert values(spark, cut, text.html_text) == ["a &\nb &", "x © y © © ¬it;", "a&", "if (a && b & c)A B &bogus;", ""]


def test_small_text_functions(spark):
    assert values(spark, ["да", " YES ", "0", "maybe", None], text.bool_or_none) == [True, True, False, None, None]
    assert values(spark, [2.0, 0.0, None], text.bool_or_none, "double") == [True, False, None]
    assert values(spark, [" a  b ", None], text.clean) == ["a b", ""]
    assert values(spark, ["..Имя файла?.pdf", "", None], text.slug) == ["Имя_файла_.pdf", "file", "file"]
    assert values(spark, ['a<b>:c "d" ', None], text.safe_filename) == ["a_b__c _d_", "file"]
    df = spark.createDataFrame([(None, " ", "x"), ("", None, None)], "a string, b string, c string")
    assert [r[0] for r in df.select(text.first_text(*map(F.col, "abc"))).collect()] == ["x", ""]
    joined = spark.createDataFrame([("http://h/a/b", "../c?d=1"), ("http://h/a", ""), ("http://h/a", None)], "a string, b string")
    assert [r[0] for r in joined.select(text.resolve_url("a", "b")).collect()] == ["http://h/c?d=1", "", ""]
    raw = spark.createDataFrame([(b"%PDF-1.7",), (b"PK\x03\x04xx",), (b" <!DOCTYPE html>",), (b"abc",), (None,)], "c binary")
    assert [r[0] for r in raw.select(text.sniff(F.col("c"))).collect()] == ["pdf", "docx", "html", "unknown", "missing"]


@pytest.mark.parametrize(
    ("raw", "value", "warning"),
    [("40", "40", None), ("699 000", "699000", None), ("1.234,50 ₽", "1234.5", None), ("12,5", "12.5", None), ("1,234", "1234", None), ("неизвестно", None, "invalid_number"), ("abc", None, "invalid_number"), ("", None, None), ("-", None, None), ("1-2", None, "invalid_number"), (None, None, None), ("н/д", None, None), ("1.2.3", None, "invalid_number")],
)
def test_parse_decimal(spark, raw, value, warning):
    got = values(spark, [raw], lambda c: F.struct(numbers.wire(numbers.parse_decimal(c)["value"]).alias("v"), numbers.parse_decimal(c)["raw"].alias("r"), numbers.parse_decimal(c)["warning"].alias("w")))[0]
    assert (got.v, got.r, got.w) == (value, raw, warning)


def test_other_numbers(spark):
    got = values(spark, ["7", "7.5", "x1", "1" * 30], numbers.parse_int)
    assert [(r.value, r.warning) for r in got] == [(7, None), (None, "not_integral"), (1, None), (None, "invalid_number")]
    assert values(spark, ["a −3,5 b 7", "none", None, "4."], numbers.first_number) == [-3.5, None, None, 4.0]
    assert values(spark, ["3", "0", "4.0", "x", None, "-1"], numbers.positive_int) == [3, None, 4, None, None, None]
    assert values(spark, ["1.500", "100", "0.0"], numbers.wire) == ["1.5", "100", "0"]


def test_ids(spark):
    digest = hashlib.sha256("u|kind_a|straße x|http://h/a".replace("straße", "strasse").encode()).hexdigest()[:24]
    df = spark.createDataFrame([("Straße  X", "HTTP://H/a/")], "a string, b string")
    assert df.select(ids.stable_id("U", "Kind A", F.col("a"), F.col("b"))).first()[0] == f"university:u:kind_a:{digest}"
    assert df.select(ids.stable_id(" U", "Kind A", F.col("a"), F.col("b"), prefix="")).first()[0] == f"u:kind_a:{digest}"
    with pytest.raises(ValueError):
        ids.stable_id(" ", "x", F.col("a"))


def test_source_keys(spark):
    rows = [("a", 1, 0), ("a", 1, 1), ("a", 2, 2), ("b", 1, 3), ("c", 1, 4), ("c", 1, 5), ("c", 2, 6), ("c", 2, 7)]
    df = spark.createDataFrame(rows, "k string, v int, pos int")
    got = {r.pos: r.source_key for r in ids.source_keys(df, ["k"], ["v"], ["pos"]).collect()}
    assert [got[0], got[1], got[3]] == ["a|duplicate:1", "a|duplicate:2", "b"]
    assert got[2].startswith("a|variant:") and len(got[2]) == len("a|variant:") + 16
    assert got[4] == got[6] == "c|duplicate:1"  # two repeating payloads share keys, as defined
    strict = {r.pos: r.source_key for r in ids.source_keys(df, ["k"], ["v"], ["pos"], strict=True).collect()}
    assert len(set(strict.values())) == len(rows)
    assert ids.record_ids(df, "u", "row", ["k"], ["v"], ["pos"]).where("record_id like 'university:u:row:%'").count() == len(rows)


def test_tokens(spark):
    found = values(spark, ["Экз, ДЗчт; экз КуР", "экономика", None, ""], tokens.control_tokens)
    assert found == [["Экз", "ДЗчт", "КуР"], ["эк"], [], []]
    kinds = values(spark, ["РЭкз Зчт", "x"], lambda c: tokens.control_kinds(tokens.control_tokens(c)))
    assert kinds == [["rated_exam", "credit"], []]
    names = ["Дисциплины (модули)", "Обязательная часть", "Дисциплины по выбору", "Раздел", "", "Обязательные, вариативные"]
    assert values(spark, names, lambda c: tokens.row_kind(F.lit(""), c)) == ["cycle", "mandatory_group", "elective_group", "section", "empty", "mandatory_group"]
    assert values(spark, names, lambda c: tokens.row_kind(F.lit("12"), c)) == ["discipline"] * 6
    assert values(spark, names, tokens.part_type) == [None, "mandatory", "elective", None, None, "elective"]
    heads = values(spark, ["Семестр 1 - 17 недель 2–16 недель", "none"], tokens.semester_headers)
    assert [[tuple(x) for x in h] for h in heads] == [[(1, 17), (2, 16)], []]
