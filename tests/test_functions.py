"""Trap tests for the column expressions (one per SURVEY trap)."""

import datetime as dt

from pyspark.sql import functions as F

from silverline.functions import arrays as A
from silverline.functions import dates as D
from silverline.functions import numbers as N
from silverline.functions import predicates as P
from silverline.functions import strings as S


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")


def col_values(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_blanks_clean_text(spark):  # STR-1..3
    df = one_col(spark, ["", " ", " a \t b ", "x  y", None, " lead"])
    assert col_values(df, S.collapse_whitespace("v")) == ["", "", "a b", "x y", None, "lead"]
    assert col_values(df, S.clean_text("v")) == [None, None, "a b", "x y", None, "lead"]
    assert col_values(df, S.empty_to_null("v")) == [None, " ", " a \t b ", "x  y", None, " lead"]


def test_sentinels(spark):  # STR-4
    df = one_col(spark, ["None", "none", "N/A", "ok", None])
    assert col_values(df, S.sentinel_to_null("v", ["None", "N/A"])) == [None, "none", None, "ok", None]


def test_replace_first_vs_all(spark):  # STR-5 / STR-6 / STR-8
    df = one_col(spark, ["ab-ab", "none", "x equihash 1 2 y equihash 3 4"])
    assert col_values(df, S.replace_first("v", "ab", "Z")) == ["Z-ab", "none", "x equihash 1 2 y equihash 3 4"]
    assert col_values(df, S.replace_all("v", "ab", "Z")) == ["Z-Z", "none", "x equihash 1 2 y equihash 3 4"]
    got = col_values(df, S.replace_first("v", r"(?i)equihash (\d) (\d)", "E($1,$2)"))
    assert got[2] == "x E(1,2) y equihash 3 4"
    braces = col_values(df, S.replace_first("v", r"(?i)equihash (\d) (\d)", "E(${1},${2})"))
    assert braces[2] == "x E(1,2) y equihash 3 4"
    assert S._shift_groups(r"a$1b${2}c\$3", 1) == r"a$2b$3c\$3"


def test_extract_no_match_is_null(spark):  # STR-9
    df = one_col(spark, ["/algorithm/sha/", "/coin/x", None])
    assert col_values(df, S.extract_group("v", "/algorithm/([^/]+)")) == ["sha", None, None]


def test_split_last_and_before(spark):  # STR-10 / STR-18 / STR-19
    df = one_col(spark, ["a/b/c", "a/b/", "Bitcoin (BTC)", "x..."])
    assert col_values(df, S.split_last("v", "/")) == ["c", "", "Bitcoin (BTC)", "x..."]
    assert col_values(df, S.text_before("v", " (")) == ["a/b/c", "a/b/", "Bitcoin", "x..."]
    assert col_values(df, S.rstrip_chars("v", ".")) == ["a/b/c", "a/b/", "Bitcoin (BTC)", "x"]


def test_concat_null_propagates(spark):  # STR-11..13
    df = spark.createDataFrame([(0, "a", "b"), (1, "a", None)], "i int, x string, y string")
    assert col_values(df, S.concat_sep("-", "x", "y")) == ["a-b", None]
    assert col_values(df, S.template("https://h/{}/", "y")) == ["https://h/b/", None]
    assert col_values(df, S.concat_strict(F.lit("p:"), F.col("x"))) == ["p:a", "p:a"]


def test_match_key_and_snake_case(spark):  # STR-14 / STR-16
    df = one_col(spark, ["Bit-Coin", " Hash Rate (TH/s) ", "日本"])
    assert col_values(df, S.match_key("v")) == ["bitcoin", "hashrateths", ""]
    assert col_values(df, S.snake_case("v")) == ["bit_coin", "hash_rate_th_s", ""]
    assert S.snake_case_name(" Hash Rate (TH/s) ") == "hash_rate_th_s"


def test_join_url_and_slug(spark):  # STR-15 / STR-17 / STR-7
    df = spark.createDataFrame([(0, "https://x.org/", "/a/", "b")], "i int, a string, b string, c string")
    assert col_values(df, S.join_url("a", "b", "c")) == ["https://x.org/a/b"]
    df2 = one_col(spark, ["two words here", "a$b"])
    assert col_values(df2, S.slugify("v")) == ["two-words-here", "a$b"]
    assert col_values(df2, S.replace_literal("v", "$", "S")) == ["two words here", "aSb"]


def test_halves_round_vs_trunc(spark):  # MTH-1 / MTH-2 / MTH-3
    df = one_col(spark, [0.5, 1.5, 2.5, -2.5, 2.7, -2.7, 1e18, 1e19], "double")
    assert col_values(df, N.round_to_int("v")) == [0, 2, 2, -2, 3, -3, 10**18, None]
    assert col_values(df, N.truncate_to_int("v")) == [0, 1, 2, -2, 2, -2, 10**18, None]
    df2 = one_col(spark, [0.123456785, 1.0000000049], "double")
    assert col_values(df2, N.round_half_even("v", 8)) == [0.12345678, 1.0]


def test_currency_text(spark):  # MTH-4
    df = one_col(spark, ["$1,234.5", "504,025,790.86 USD", "$2.5", "n/a", None])
    assert col_values(df, N.currency_to_int("v")) == [1234, 504025791, 2, None, None]


def test_magnitude_suffixes(spark):  # MTH-5
    df = one_col(spark, ["$1.5k", "$1.5K", "$2M", "$3B", "$4T", "$7", "$1,234", "n/a", "$2m"])
    assert col_values(df, N.magnitude_to_number("v")) == [1500.0, 1500.0, 2e6, 3e9, 4e12, 7.0, None, None, None]


def test_units(spark):  # MTH-6 / JOIN-6
    units = list(N.HASHRATE_UNITS) + ["XH/s", None]
    df = spark.createDataFrame([(i, 2.0, u) for i, u in enumerate(units)], "i int, v double, u string")
    got = col_values(df, N.to_per_second("v", "u"))
    assert got[:12] == [int(2 * f) for f in N.HASHRATE_UNITS.values()]
    assert got[12:] == [None, None]
    assert col_values(df, N.unit_is_known("u")) == [True] * 12 + [False, True]


def test_least_ignores_null(spark):  # MTH-7
    df = spark.createDataFrame([(0, 3, None), (1, 3, 1), (2, None, None)], "i int, a int, b int")
    assert col_values(df, N.least_non_null("a", "b")) == [3, 1, None]


def test_dates(spark):  # DAT-1..6
    df = one_col(spark, ["Jan 03, 2009", "Jan 3, 2009", "bad", None])
    assert col_values(df, D.parse_date("v")) == [dt.date(2009, 1, 3), dt.date(2009, 1, 3), None, None]
    df2 = one_col(spark, ["2021-05-06T10:00:00Z", "2021-05-06", "x"])
    assert col_values(df2, D.iso_to_date("v")) == [dt.date(2021, 5, 6), dt.date(2021, 5, 6), None]
    df3 = one_col(spark, [2017, None], "int")
    assert col_values(df3, D.year_start("v")) == [dt.date(2017, 1, 1), None]


def test_earliest_year_mention(spark):  # DAT-7
    df = one_col(spark, ["Launched IN 2019, forked in 2017 and in 2099; in 1999", "no years", None])
    assert col_values(df, D.earliest_year_mention("v", "2024-06-01")) == [2017, None, None]


def test_earliest_upload_date_two_layouts(spark):  # DAT-8, our own two layouts
    old = ('<div class="name-logo"><img src="https://x.test/wp-content/uploads/2019/03/Foo-logo.png">'
           '<img src="/wp-content/uploads/2017/10/Foo-logo.jpg"></div>')
    hero = ('<section><div class="coin-page-hero__logo big"><img src="/wp-content/uploads/2017/10/Bar-Coin-logo.jpeg">'
            '<img src="/wp-content/uploads/2017/13/Bar-logo.png"></div></section>')
    single = ("<div class='name-logo'><div class='logo-container'><img src='/wp-content/uploads/2017/10/Baz-logo.png'>"
              "</div></div><div class='other'><img src='/wp-content/uploads/2015/01/Old-logo.png'></div>")
    df = one_col(spark, [old, hero, single, "<div class='xname-logo'>/wp-content/uploads/2017/10/A-logo.png</div>"])
    got = col_values(df, D.earliest_upload_date(D.logo_scope("v"), "2024-01-01"))
    assert got == [dt.date(2017, 10, 1), dt.date(2017, 10, 1), dt.date(2017, 10, 1), None]


def test_humanised_age(spark):  # DAT-9
    df = one_col(spark, ["2024-06-01", "2024-05-31", "2024-05-20", "2024-04-20", "2024-01-01",
                         "2023-05-01", "2020-01-01", "2025-01-01", None])
    got = col_values(df, D.humanised_age(F.col("v").cast("date"), "2024-06-01"))
    assert got == ["today", "yesterday", "12 days ago", "a month ago", "5 months ago", "a year ago",
                   "4 years ago", "in the future", "unknown"]


def test_truncated_member_list(spark):  # ARR-4 / JSN-3
    lists = [[f"m{i}" for i in range(n)] for n in (14, 15, 16, 201)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "i int, v array<string>")
    got = col_values(df, A.truncated_join("v"))
    assert got[0] == "\n".join(lists[0])
    assert got[1] == "TRUNCATED\n" + "\n".join(lists[1]) + "\n..."  # 15 members: marker kept
    assert got[2] == got[1] and got[3] == got[1]
    js = col_values(df, A.to_json_list(A.head("v", 200)))
    import json
    assert [len(json.loads(x)) for x in js] == [14, 15, 16, 200]


def test_empty_lists_and_merge(spark):  # ARR-5 / ARR-6 / SET-6 / JSN-1 / JSN-4
    df = spark.createDataFrame([(0, ["b", "a", "b"], None), (1, [], ["c"]), (2, None, None)],
                               "i int, a array<string>, b array<string>")
    assert col_values(df, A.to_json_list(A.merge_sorted("a", "b"))) == ['["a","b"]', '["c"]', "[]"]
    assert col_values(df, A.json_array_not_empty(A.to_json_list(A.empty_if_null("a")))) == [True, False, False]
    assert col_values(df, A.sorted_distinct("a")) == [["a", "b"], [], None]


def test_json_keeps_null_fields(spark):  # JSN-2
    df = spark.createDataFrame([(0, [("x", None)])], "i int, v array<struct<name:string,rate:double>>")
    assert col_values(df, A.to_json_list("v")) == ['[{"name":"x","rate":null}]']


def test_in_list_with_null(spark):  # FLT-5 / FLT-7 / FLT-8
    df = one_col(spark, ["Defunct", "None", "SHA", None])
    assert col_values(df, P.is_null_or_in("v", [None, "None", "Defunct"])) == [True, True, False, True]
    assert col_values(df, P.contains_flag("v", "one")) == [False, True, False, False]
    assert col_values(df, P.eq_null_safe("v", F.lit(None).cast("string"))) == [False, False, False, True]


URL_CASES = [  # our own cases: only the first two are direct entity URLs
    ("https://cryptoslate.com/coins/foo/", True),
    ("https://cryptoslate.com/coins/foo", True),
    ("https://cryptoslate.com/coins/foo/amp", False),
    ("https://cryptoslate.com/coins/foo/amp/", False),
    ("http://cryptoslate.com/coins/foo/", False),
    ("https://cryptoslate.com/coins/", False),
    ("https://cryptoslate.com/coins/foo/bar/", False),
    ("https://cryptoslate.com/coins/?show=all", False),
    ("https://cryptoslate.com/coins/foo?x=1", False),
    ("https://cryptoslate.com/coins/a=b/", False),
    ("https://www.cryptoslate.com/coins/foo/", False),
    ("https://cryptoslate.com/cryptos/foo/", False),
    ("https://cryptoslate.com/coins/foo/\n", False),
    ("https://cryptoslate.com/coins//", False),
]


def test_direct_url_cases(spark):  # FLT-9
    df = one_col(spark, [u for u, _ in URL_CASES])
    assert col_values(df, P.is_direct_url("v")) == [e for _, e in URL_CASES]


def test_markers_and_size(spark):  # FLT-10 / FLT-11 / FLT-13
    df = one_col(spark, ["<div coin-heading>", "é" * 3000, '<li class="page-item disabled">'])
    assert col_values(df, P.has_any_marker("v", ["coin-heading", "coin-page-hero"])) == [True, False, False]
    assert col_values(df, P.min_bytes("v", 5000)) == [False, True, False]  # 6000 bytes, 3000 chars
    assert col_values(df, P.is_last_page("v", F.lit(2))) == [False, False, True]
