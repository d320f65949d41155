from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from termloom.functions.metadata import size_kb, sortable_date, utc
from termloom.functions import text as analysis
from termloom.functions.text import (
    count_tokens,
    decode_utf8,
    extension,
    format_term,
    line_window,
    tokenize,
)
from termloom.plans.oracle import tokens_of


def evaluate(spark, texts, expression, kind="string"):
    rows = spark.createDataFrame(list(enumerate(texts)), f"i int, text {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("text"))).collect()]


@pytest.mark.parametrize(
    ("text", "tokens"),
    [
        ("The can't a1.b 3,000.5 foo_bar naïve", "the can't a1 b 3,000.5 foo_bar naïve"),
        ("__ _a_ a_'b 1.a a.1 1,2,3 a,b a..b", "_a_ a_ b 1 a a 1 1,2,3 a b a b"),
        ("l’été a:b a·b x@y.org", "l’été a:b a·b x y.org"),
        ("ΑΣ İx", "ασ ix"),
        ("中国ab 日本", "中 国 ab 日 本"),
        ("  ...  __ ' ", ""),
        ("foo\u203fbar \u203f Ⅷ ⅷx", "foo\u203fbar ⅷ ⅷx"),
        ("co\u00adoperate \u00adx می\u200cروم a\u200bb", "co\u00adoperate x می\u200cروم a b"),
        ("can\u00ad't a\u00ad\u2060.b x'\u00ady 1\u00ad,\u00ad2 a\u00ad'1", "can\u00ad't a\u00ad\u2060.b x'\u00ady 1\u00ad,\u00ad2 a\u00ad 1"),
        ("アイb カ1 xア ラーメン カ'カ ｱﾞa", "アイ b カ 1 x ア ラーメン カ カ ｱﾞ a"),
        ("hi😀there 👍🏽 👨\u200d👩\u200d👧 x❤\ufe0fy ❤ ✓ © ™ 1\ufe0f\u20e3", "hi 😀 there 👍🏽 👨\u200d👩\u200d👧 x ❤\ufe0f y 1\ufe0f\u20e3"),
        ("🇫🇷🇩🇪🇪 a🇦b 🏽", "🇫🇷 🇩🇪 a b"),
        ("🏴\U000e0067\U000e0062\U000e007f ok", "🏴\U000e0067\U000e0062\U000e007f ok"),
        ("", ""),
    ],
)
def test_tokens(spark, text, tokens):
    assert evaluate(spark, [text], tokenize) == [tokens.split()]


def test_long_tokens_are_cut(spark):
    found = evaluate(spark, ["x " + "a" * 600, "_" * 300 + "b"], tokenize)
    assert [len(t) for t in found[0]] == [1, 255, 255, 90]
    assert found[1] == ["_" * 45 + "b"]


def test_hostile_tokens(spark):
    found = evaluate(spark, ["ab12" * 5000, "a." * 20000, "1.a_" * 9000], tokenize)
    assert [len(t) for t in found] == [79, 157, 9001]


def test_tokens_agree_with_sql_on_random_text(spark):
    rng = random.Random(7)
    alphabet = "aZé1٣_.:,;'’·-  \ńß中\u203fⅧ\u00ad\u200c\u200b"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(2000)]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, text VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(texts)))
    sql = con.execute(f"SELECT {tokens_of('text')} FROM t ORDER BY i").fetchall()
    found = evaluate(spark, texts, tokenize)
    wrong = [(t, a, b[0]) for t, a, b in zip(texts, found, sql) if a != b[0]]
    assert not wrong


def test_counts(spark):
    (found,) = evaluate(spark, ["b a b ab a b"], lambda t: count_tokens(tokenize(t)))
    assert found.asDict() == {
        "length": 6, "n_terms": 3, "terms": ["a", "ab", "b"], "tfs": [2, 1, 3]
    }
    (empty,) = evaluate(spark, ["..."], lambda t: count_tokens(tokenize(t)))
    assert empty.asDict() == {"length": 0, "n_terms": 0, "terms": [], "tfs": []}


FIVE = "l0\nl1\nl2\nl3\nl4"


@pytest.mark.parametrize(
    ("text", "top", "bottom", "kept"),
    [
        (FIVE, 2, None, "l0 l1"),
        (FIVE, None, 1, "l4"),
        (FIVE, 2, 1, "l0 l1 l4"),
        (FIVE, 9, None, "l0 l1 l2 l3 l4"),
        (FIVE, 0, None, ""),
        (FIVE, 0, 0, ""),
        ("l0\nl1\nl2\n", 2, 2, "l0 l1 l2"),
        ("a\r\nb\rc\n", 9, None, "a b c"),
        ("", 2, 2, ""),
    ],
)
def test_line_window(spark, text, top, bottom, kept):
    want = "".join(line + "\n" for line in kept.split())
    assert evaluate(spark, [text], lambda t: line_window(t, top, bottom)) == [want]


def test_line_window_unset_and_blank_lines(spark):
    assert evaluate(spark, [FIVE], line_window) == [FIVE]
    assert evaluate(spark, ["\n", "\n\na"], lambda t: line_window(t, 2)) == ["\n", "\n\n"]


def test_extension(spark):
    paths = ["a/b.txt", "README", ".profile", "x.tar.gz", "a.b/c", "x.TXT", "a."]
    want = [".txt", "", "", ".gz", ".b/c", ".TXT", "."]
    assert evaluate(spark, paths, extension) == want


def test_malformed_bytes(spark):
    assert evaluate(spark, [bytes([0x41, 0xFF, 0x42])], decode_utf8, "binary") == ["A�B"]


def test_sizes(spark):
    found = evaluate(spark, [1023, 1024, 3500], lambda n: size_kb(n).cast("string"), "bigint")
    assert found == ["0.0", "1.0", "3.0"]


def test_format_term(spark):
    line = spark.range(1).select(format_term(F.lit("x"), F.lit(1), F.lit(2), F.lit(0.30103)))
    assert line.first()[0] == "term='x', tf=1, df=2, tfxidf=0.30"


def test_sortable_date_is_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        stamp = F.timestamp_millis(F.lit(1577836799000))
        assert spark.range(1).select(sortable_date(utc(stamp))).first()[0] == "20191231235959"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_no_unusual_character_passes_the_first_test(spark):
    """The cheap test lets every character through that the long class holds, and no plain letter."""
    code = spark.range(0, 0x110000).filter("id not between 55296 and 57343")
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    seen = code.select(
        char.rlike(analysis.MAYBE_UNUSUAL).alias("maybe"), char.rlike(analysis.UNUSUAL).alias("is"), "id"
    ).persist()
    assert seen.filter("is").count() > 3000
    assert seen.filter("is and not maybe").isEmpty()
    assert [r["id"] for r in seen.filter("maybe and id < 1536").collect()] == [0xA9, 0xAD, 0xAE]


def test_common_texts_take_no_step_for_ideographs_and_bytes_tell_long_words(spark):
    from pyspark.sql import functions as F

    from termloom.functions.text import COMMON, PLAIN_SEPARATOR, tokenize

    # Every character that is listed is part of a word by the long class too.
    listed = spark.createDataFrame([(c,) for c in COMMON], "c string")
    assert listed.filter(~F.col("c").rlike(r"[\p{L}\p{M}\p{Nl}\p{Nd}_]")).count() == 0
    assert listed.filter(F.col("c").rlike(PLAIN_SEPARATOR)).count() == 0
    rows = {
        "It's 3.5, na_ïve ÷ × Straße": ["it's", "3.5", "na_ïve", "straße"],
        "_ __ a_ _b": ["a_", "_b"],
        "é" * 200: ["é" * 200],  # 400 bytes, 200 characters: one word
        "é" * 256: ["é" * 255, "é"],
        "ab漢字cd": ["ab", "漢", "字", "cd"],
        "": [],
    }
    docs = spark.createDataFrame([(t,) for t in rows], "t string")
    got = {r["t"]: r["w"] for r in docs.select("t", tokenize(F.col("t")).alias("w")).collect()}
    assert got == rows
    assert docs.select(tokenize(F.lit(None).cast("string")).alias("w")).first()["w"] is None
