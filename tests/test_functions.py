import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates, numbers, payload, similarity, text


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize("raw, want", [("12345.0", "12345"), ("1.05", "1.05"), (" 7.0 ", "7"), (None, None)])
def test_strip_decimal_suffix(spark, raw, want):
    assert one(spark, text.strip_decimal_suffix, raw) == want


@pytest.mark.parametrize("raw, want", [("nan", None), (" None ", None), ("", None), ("  ", None), ("-1", None), ("000000000", None), ("0712", "0712")])
def test_null_tokens(spark, raw, want):
    assert one(spark, text.null_tokens, raw) == want


@pytest.mark.parametrize("raw, want", [("0712345678", "254712345678"), ("+254712345678", "254712345678"), ("07x", None), ("712345678", "712345678"), (None, None)])
def test_standard_phone(spark, raw, want):
    assert one(spark, text.standard_phone, raw) == want


@pytest.mark.parametrize("raw, want", [("254712345678", "254712345678"), ("25471234567", None), ("0712345678", "0712345678"), ("071", None), ("712345678", "712345678"), ("112", None), ("999", "999")])
def test_valid_phone(spark, raw, want):
    assert one(spark, text.valid_phone, raw) == want


def test_special_characters_are_deleted_and_words_fuse(spark):
    assert one(spark, text.drop_special_characters, "a½b ~c�ïÂd") == "ab cd"


@pytest.mark.parametrize("raw, want", [("Ann", ("Ann", None, None)), ("  Ann  B ", ("Ann", "B", None)), ("Ann B C D", ("Ann", "B", "C D")), ("", (None, None, None))])
def test_split_names(spark, raw, want):
    assert tuple(one(spark, text.split_names, raw)) == want


def test_names_and_amounts(spark):
    assert one(spark, text.letters_title, "o'NEIL 3rd") == "Oneilrd"
    assert one(spark, text.parse_amount, " 1,234.50 ") == 1234.5
    assert one(spark, text.parse_amount, "n/a") is None
    assert one(spark, text.minor_units, 1234.5, "double") == "123450"
    assert one(spark, text.minor_units, 0.0, "double") == "000"


@pytest.mark.parametrize("raw, want", [("1234", True), ("12345678", True), ("123456789", False), ("000", False), ("12a", False), ("1_2", False)])
def test_plain_id(spark, raw, want):
    assert one(spark, text.is_plain_id, raw) is want


def test_dates(spark):
    assert one(spark, text.compact_date, "20230105.0") == dt.date(2023, 1, 5)
    assert one(spark, text.compact_date, "2023-01-05") is None
    assert dates.shift_months("2024-03-31", -1) == dt.date(2024, 2, 29)
    assert dates.shift_months("2024-01-31", -6) == dt.date(2023, 7, 31)
    assert dates.month_window(2024, 2) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    birth = lambda c: dates.plausible_birth_date(c, "2024-01-31")
    assert one(spark, birth, dt.date(2010, 1, 1), "date") == dt.date(1970, 10, 10)
    assert one(spark, birth, dt.date(1990, 1, 1), "date") == dt.date(1990, 1, 1)
    assert one(spark, birth, None, "date") == dt.date(1970, 10, 10)
    assert one(spark, lambda c: dates.age_years(c, "2024-01-31"), dt.date(2023, 1, 31), "date") == 1


@pytest.mark.parametrize("v, want", [(0.5, 0.0), (1.5, 2.0), (2.5, 2.0), (-0.5, -0.0)])
def test_half_even(spark, v, want):
    assert one(spark, numbers.half_even, v, "double") == want


def test_half_even_works_on_the_binary_value(spark):
    assert one(spark, lambda c: numbers.half_even(c, 2), 0.285, "double") == 0.28
    assert one(spark, lambda c: numbers.half_even(c, 2), 0.295, "double") == 0.3


def test_bands_close_the_named_side(spark):
    rows = [(0, 10, "a"), (10, None, "b")]
    assert one(spark, lambda c: numbers.band("v", rows), 10, "int") == "b"
    assert one(spark, lambda c: numbers.band("v", rows, "right"), 10, "int") == "a"
    assert one(spark, lambda c: numbers.band("v", rows, "right"), 0, "int") is None
    assert one(spark, lambda c: numbers.band("v", [(0, 29, "a"), (30, 49, "b")], "both"), 29.5, "double") is None
    assert one(spark, lambda c: numbers.band("v", [(None, None, "x")]), None, "int") is None


def test_limit_arithmetic(spark):
    assert one(spark, numbers.round_up, 100.01, "double") == 200
    clamp = lambda c: numbers.clamp_limit(c, 35000, 1000000)
    assert [one(spark, clamp, v, "double") for v in (34999.0, 35000.0, 1000001.0)] == [0, 35000, 1000000]


def test_payload_repair_and_rejects(spark):
    log = spark.createDataFrame([(1, '{"body": "{"a": 1}",\n"b": "x"}'), (2, '{"body": {"a": 2}'), (3, None)], "id int, raw string")
    good, bad = payload.parse_payload(log, "raw", "body struct<a: int>, b string")
    assert [(r.id, r.payload.body.a, r.payload.b) for r in good.collect()] == [(1, 1, "x")]
    assert sorted(r.id for r in bad.collect()) == [2, 3]


def test_flatten_follows_one_path_and_refuses_pairs(spark):
    nested = spark.sql("select 1 as id, named_struct('x', 2, 'items', array(named_struct('k', 'a', 'n', array(1, 2)))) as doc, array(7, 8) as other")
    with pytest.raises(ValueError):
        payload.flatten_nested(nested)
    flat = payload.flatten_nested(nested.drop("other"))
    assert flat.columns == ["id", "doc_x", "doc_items_k", "doc_items_n"]
    assert sorted(r.doc_items_n for r in flat.collect()) == [1, 2]
    kept = payload.flatten_nested(nested, path=["doc_items"])
    assert kept.count() == 1 and "other" in kept.columns


def test_flatten_keeps_empty_lists(spark):
    empty = spark.sql("select 1 as id, cast(array() as array<int>) as v")
    assert [tuple(r) for r in payload.flatten_nested(empty).collect()] == [(1, None)]


def test_names_of_report_columns():
    assert payload.snake_case("personalProfile") == "personal_profile"
    assert payload.snake_case("phone1Number") == "phone1_number"
    assert payload.unique_words("score_score_output") == "score_output"


def test_section_keeps_the_last_part(spark):
    df = spark.createDataFrame([(1, 2)], ["`BODY.SCORE.Value`".strip("`"), "other"])
    assert payload.section(df, "SCORE").columns == ["value"]


def reference_score(a, b):
    """Token-set ratio by the textbook: three strings, longest common subsequence."""
    import re

    def words(s):
        return sorted(set(re.sub(r"\W", " ", (s or "").lower()).split()))

    def lcs(x, y):
        row = [0] * (len(y) + 1)
        for c in x:
            prev = 0
            for j, e in enumerate(y, 1):
                prev, row[j] = row[j], prev + 1 if c == e else max(row[j], row[j - 1])
        return row[-1]

    def ratio(x, y):
        return 0 if not x or not y else int(round(100 * (2 * lcs(x, y) / (len(x) + len(y)))))

    ta, tb = words(a), words(b)
    if not ta or not tb:
        return 0
    shared = " ".join(w for w in ta if w in tb)
    full_a = (shared + " " + " ".join(w for w in ta if w not in tb)).strip()
    full_b = (shared + " " + " ".join(w for w in tb if w not in ta)).strip()
    return max(ratio(shared, full_a), ratio(shared, full_b), ratio(full_a, full_b))


def test_token_scores_match_brute_force(spark):
    random.seed(7)
    words = ["anna", "ana", "otieno", "o'tieno", "mary", "marie", "kamau", "été", "de", "", "WANJIKU", "wanjiru", "x9"]
    pairs = [(" ".join(random.choices(words, k=random.randint(0, 5))), " ".join(random.choices(words, k=random.randint(0, 5)))) for _ in range(300)]
    pairs += [("Mary Ann", "ann  MARY"), ("mary", None), (None, None), ("a b", "a b c")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = {r.i: r.s for r in similarity.with_token_scores(df, {"s": ("a", "b")}).collect()}
    assert got == {i: reference_score(a, b) for i, (a, b) in enumerate(pairs)}
    assert got[300] == 100 and got[301] == 0 and got[303] == 100


def test_common_lengths_of_long_texts(spark):
    random.seed(11)
    text_of = lambda n, letters: "".join(random.choices(letters, k=n))
    pairs = [(text_of(random.randint(0, 300), "abcdeé 🙂"), text_of(random.randint(0, 300), "abcxyé 🙂")) for _ in range(60)]
    pairs += [("a" * n, "a" * m) for n in (0, 1, 61, 62, 63, 124, 125) for m in (0, 62, 63, 200)] + [("ab" * 62, "ba" * 62)]

    def longest(x, y):
        row = [0] * (len(y) + 1)
        for c in x:
            before = 0
            for j, e in enumerate(y, 1):
                before, row[j] = row[j], before + 1 if c == e else max(row[j], row[j - 1])
        return row[-1]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = {r.i: (r.s, r.t) for r in similarity.with_common_lengths(df, {"s": ("a", "b"), "t": ("b", "a")}).collect()}
    assert got == {i: (longest(a, b),) * 2 for i, (a, b) in enumerate(pairs)}


def test_common_lengths_by_marks(spark, plan):
    """Letters with a meaning in patterns, and the mark itself; texts without it are not turned into bits."""
    random.seed(12)
    text_of = lambda n, letters: "".join(random.choices(letters, k=n))
    pairs = [(text_of(random.randint(0, 90), letters), text_of(random.randint(0, 90), letters))
             for letters in ("ab\\$.*[", "^|(){}?+E", "Qé🙂 1\n", "a\x01b", "\x02\x01") for _ in range(12)]

    def longest(x, y):
        row = [0] * (len(y) + 1)
        for c in x:
            before = 0
            for j, e in enumerate(y, 1):
                before, row[j] = row[j], before + 1 if c == e else max(row[j], row[j - 1])
        return row[-1]
    df = similarity.with_common_lengths(spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string"), {"s": ("a", "b")})
    assert {r.i: r.s for r in df.collect()} == {i: longest(a, b) for i, (a, b) in enumerate(pairs)}
    assert "regexp_replace" in plan(df)


def test_variant_rows_of_any_shape(spark):
    docs = [(1, '{"a": 1, "b": null, "c": {"x": "s", "y": {"z": 1.5}}, "l": [{"p": 1, "q": [{"r": 1}, {"r": 2, "s": []}]}, {"p": 2}], "m": [10, "[]", [7, 8]], "e": {}, "f": []}'),
            (2, None), (3, "[]"), (4, "not json"), (5, '[{"k": true}, 3]'), (6, '"text"'), (7, '{"only": [{"deep": [[{"x": 1}]]}]}'), (1, '{"a": 9}')]
    df = spark.createDataFrame(docs, "id int, doc string").withColumns({"key": F.lit("clash"), "pos": F.lit(1), "value": F.lit("clash")})
    got = sorted((r.id, r.table_name, r.row_path, sorted(r.fields.items())) for r in payload.variant_rows(df.filter("not (id = 1 and doc like '%9%')"), ["id"], "doc").collect())
    assert got == [
        (1, "", "", [("a", "1"), ("b", None), ("c_x", "s"), ("c_y_z", "1.5")]), (1, "l", "/0", [("p", "1")]), (1, "l", "/1", [("p", "2")]),
        (1, "l.q", "/0/0", [("r", "1")]), (1, "l.q", "/0/1", [("r", "2")]), (1, "m", "/0", [("value", "10")]), (1, "m", "/1", [("value", "[]")]),
        (1, "m.items", "/2/0", [("value", "7")]), (1, "m.items", "/2/1", [("value", "8")]),
        (5, "", "/0", [("k", "true")]), (5, "", "/1", [("value", "3")]), (6, "", "", [("value", "text")]), (7, "only.deep.items", "/0/0/0", [("x", "1")])]
    cut = payload.variant_rows(df.filter("id = 7"), ["id"], "doc", depth=3).collect()
    assert [(r.table_name, r.row_path, r.fields) for r in cut] == [("only", "/0", {"deep": '[[{"x":1}]]'})]
    clash = spark.createDataFrame([(1, '{"a_b": 2, "a": {"b": 1}}')], "id int, doc string")
    assert [r.fields for r in payload.variant_rows(clash, ["id"], "doc").collect()] == [{"a_b": "1"}]
    wide = payload.variant_table(payload.variant_rows(df.filter("id <> 1 or doc like '%null%'"), ["id"], "doc"), "l.q", {"r": "int", "none": "string"})
    assert sorted(tuple(r) for r in wide.collect()) == [(1, "/0/0", "/0", 1, None), (1, "/0/1", "/0", 2, None)]


def test_full_name_drops_missing_parts(spark):
    df = spark.createDataFrame([("Ann", None, "LEE")], "a string, b string, c string")
    assert df.select(text.full_name(F.col("a"), F.col("b"), F.col("c"))).first()[0] == "ann lee"


def test_report_lists_keep_every_node(spark, rows):
    schema = "head: struct<a: string>, phoneList: array<struct<n: int, kind: string>>, other: array<struct<x: string>>"
    df = spark.createDataFrame([(1, (("h",), [(1, "a"), (2, "b"), (3, None)], [("o",)])), (2, (None, None, []))], f"id int, r struct<{schema}>")
    got = rows(payload.report_lists(df, "r", keep=("id",)).select("id", "list_name", "position", F.map_values("fields").alias("v")))
    assert got == [(1, "other", 1, ["o"]), (1, "phone_list", 1, ["1", "a"]), (1, "phone_list", 2, ["2", "b"]), (1, "phone_list", 3, ["3", None])]
    with pytest.raises(ValueError, match="other"):
        payload.flatten_report(df, "r", {"phoneList": 2}, keep=("id",))
    wide = payload.flatten_report(df, "r", {"phoneList": 1, "other": 1}, keep=("id",))
    assert rows(wide, "id", "phone_list_count", "other_count") == [(1, 3, 1), (2, 0, 0)]
