"""Golden rows for the text functions."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from textloom.functions import clean, ngrams, profile
from textloom.functions.unicode_tables import HANGUL
from textloom.operators import phrases

GOLDEN = [
    (clean.strip_urls, "xem http://a.b/c nha", "xem  nha"),
    (clean.strip_urls, "a ftp.www.x.y b", "a ftp. b"),
    (clean.strip_hashtags, "tin #hot_1 đây", "tin  đây"),
    (clean.replace_emoticons, "ok :)", "ok  cười "),
    (clean.replace_emoticons, "thôi =(", "thôi  buồn "),
    (clean.replace_emoticons, "((((= :-) :-(", " cười   cười   buồn "),
    (lambda t: clean.squash_spaces(clean.strip_urls(t)), "www.a.b nha", "nha"),
    (clean.strip_special, "a_b, c!", "a_b  c "),
    (clean.collapse_repeats, "hayyyy quáaaa 1122 good", "hay quáa 1122 god"),
    (clean.demojize, "a\U0001f600b ❤c", "a grinning_face b  heavy_black_heart c"),
    (clean.demojize, "none", "none"),
    (profile.tokens, "Được không, hả_bạn 12", ["được", "không", "hả_bạn", "12"]),
    (profile.tokens, "", []),
    (profile.strip_accents, "Được đm Ấy", "Đuoc đm Ay"),
    (profile.no_diacritics, "di choi", True),
    (profile.no_diacritics, "đi choi", True),
    (profile.no_diacritics, "đi chơi", False),
    (profile.no_diacritics, "123", False),
    (profile.has_slang, "vui :v", True),
    (profile.has_slang_norm, "vui :v", False),
    (profile.has_slang, "đk", False),
    (profile.has_slang, "KO biết", True),
    (profile.has_slang_norm, "cười hihiii nha", True),
    (profile.has_slang_norm, "he  he!", True),
    (profile.has_slang_norm, "the he", False),
    (profile.match_key, "  Được, không?! ", "đuoc khong"),
    (profile.has_url, "xem HTTPS://a", True),
    (profile.has_url, "www. a", False),
    (profile.has_emoji, "x \U0001f1e6", True),
    (ngrams.word_analyzer(1, 2), "a b c", ["a", "b", "c", "a b", "b c"]),
    (ngrams.word_analyzer(2, 3), "a b c", ["a b", "b c", "a b c"]),
    (ngrams.word_analyzer(1, 2), "a", ["a"]),
    (ngrams.word_analyzer(1, 2), "", []),
    (ngrams.char_analyzer(3, 5), "ab", [" ab", "ab ", " ab "]),
    (ngrams.char_analyzer(3, 5), "", []),
    (ngrams.char_analyzer(3, 3), "a\U0001f600", [" a\U0001f600", "a\U0001f600 "]),
]


@pytest.mark.parametrize("fn,text,expected", GOLDEN)
def test_golden(one, fn, text, expected):
    assert one(fn, text) == expected


CHAR_TEXTS = ["", " ", "a", "ab", "abc", "A  b\t\nC d", "\U0001f600", "a\U0001f600\U0001f1e6b\U0001f600", "Đã e\u0301 x", "aaaaaaa", None]


@pytest.mark.parametrize("lo,hi", [(3, 5), (1, 1), (1, 4), (2, 2)])
def test_char_ngrams_equal_slices_of_the_padded_text(spark, lo, hi):
    def slices(text):
        padded = f" {' '.join(text.lower().split())} "
        return [padded[i : i + n] for n in range(lo, hi + 1) for i in range(len(padded) - n + 1)]

    rows = spark.createDataFrame(list(enumerate(CHAR_TEXTS)), "k int, text string")
    found = dict(rows.select("k", ngrams.char_ngrams(F.col("text"), lo, hi)).collect())
    assert found == {k: None if t is None else slices(t) for k, t in enumerate(CHAR_TEXTS)}


def test_char_ngrams_read_the_text_once(spark):
    grams = spark.range(1).select(ngrams.char_ngrams(F.col("id").cast("string"), 3, 5).alias("grams"))
    assert grams._jdf.queryExecution().analyzed().toString().count("regexp_extract_all") == 1


@pytest.mark.parametrize("text", ["é", "가", "Å", "ậ", "plain", "đã", None])
def test_nfc(one, text):
    assert one(clean.nfc, text) == (None if text is None else unicodedata.normalize("NFC", text))


def test_nfc_finds_every_character_that_changes(spark):
    changing = [
        chr(c) for c in range(0x80, 0x30000)
        if not 0xD800 <= c <= 0xDFFF and unicodedata.normalize("NFC", chr(c)) != chr(c)
    ]
    rows = spark.createDataFrame([(c, unicodedata.normalize("NFC", c)) for c in changing], "text string, want string")
    assert rows.filter(clean.nfc(F.col("text")) != F.col("want")).count() == 0


def test_strip_accents_equals_decomposition_on_the_basic_plane(spark):
    def stripped(ch):
        return "".join(c for c in unicodedata.normalize("NFD", ch) if unicodedata.category(c) != "Mn")

    chars = [chr(c) for c in range(0x20, 0x10000) if not 0xD800 <= c <= 0xDFFF and c not in HANGUL]
    single = [c for c in chars if len(stripped(c)) <= 1]
    rows = spark.createDataFrame([(c, stripped(c)) for c in single], "text string, want string")
    wrong = rows.filter(profile.strip_accents(F.col("text")) != F.col("want"))
    # Java and Python ship different Unicode versions: marks added later than Java's are not
    # compared, and U+1734 was a non-spacing mark before Unicode 14.
    assert [r.text for r in wrong.filter(F.col("want") != "").collect()] in ([], ["\u1734"])


LEXICON = [("ko", "không"), ("bít", "biết"), ("vl", "rất là")]


def lexicon(spark):
    return spark.createDataFrame(LEXICON, "term string, expansion string")


def test_expand_slang_inline_and_joined_agree(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "ko bít"), (2, "vl  x ko"), (3, ""), (4, "kok")], "doc_id int, text string")
    inline = {r.doc_id: r.text for r in clean.expand_slang(docs, lexicon(spark)).collect()}
    assert inline == {1: "không biết", 2: "rất là x không", 3: "", 4: "kok"}
    monkeypatch.setattr(clean, "INLINE_LEXICON", 1)
    joined = {r.doc_id: r.text for r in clean.expand_slang(docs, lexicon(spark)).collect()}
    assert joined == inline


def test_clean_text_chain(spark):
    docs = spark.createDataFrame(
        [(1, "Ko http://x.y #tag :) haaay!!"), (2, None), (3, "Bít \U0001f600")], "doc_id int, text string"
    )
    cleaned = {r.doc_id: r.text for r in clean.clean_text(docs, lexicon(spark)).collect()}
    assert cleaned == {1: "không cười hay", 2: "", 3: "biết grining_face"}


def test_phrases(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "học sinh học sinh x"), (2, "a a a a"), (3, "")], "doc_id int, text string")
    known = spark.createDataFrame([("học", "sinh"), ("sinh", "học"), ("a", "a")], "first string, second string")
    want = {1: "học_sinh học_sinh x", 2: "a_a a_a", 3: ""}
    assert {r.doc_id: r.text for r in phrases.join_phrases(docs, known).collect()} == want
    monkeypatch.setattr(phrases, "INLINE_PHRASES", 1)
    assert {r.doc_id: r.text for r in phrases.join_phrases(docs, known).collect()} == want


ODD_ROWS = [
    (1, "a b c d e"), (2, "a b c d e"), (2, "c d x y"), (3, "a b"), (3, "a b"), (4, None), (5, ""), (None, "a b"), (None, "a b"),
    (6, None), (6, "b c d"), (7, " a b  q "), (8, "x x x x x"), (9, "z"), (12, "a b"), (12, "a z"),
]


@pytest.mark.parametrize("small", [0, 1 << 26])
def test_phrases_of_a_table_keep_odd_rows(spark, monkeypatch, small):
    """Rows with one key are one text, those without a key have none, and words stay where the text is."""
    from textloom.operators import lookup as module

    known = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "x"), ("d", ""), ("", "q")], "first string, second string")
    docs = spark.createDataFrame(ODD_ROWS, "doc_id int, text string")
    monkeypatch.setattr(phrases, "INLINE_PHRASES", 1)
    monkeypatch.setattr(module.lookup, "__defaults__", (3, small))
    joined = phrases.join_phrases(docs, known)
    want = {
        1: ["a_b c_d e"], 2: ["a_c b_d c_x d y e"] * 2, 3: ["a_a b b"] * 2, 4: [None], 5: [""], None: [None] * 2, 6: ["b_c d"] * 2,
        7: ["a_b _q"], 8: ["x_x x_x x"], 9: ["z"], 12: ["a a_b z"] * 2,
    }
    assert sorted(map(tuple, joined.collect()), key=repr) == sorted([(k, t) for k, ts in want.items() for t in ts], key=repr)
    plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    collected = plan[plan.index("partial_collect_list") :]
    assert "(_rows" in collected and "isnotnull(flag" in collected  # only places of phrases, and words of shared keys


def test_mine_phrases(spark):
    texts = ["new york is big"] * 5 + ["york new", "is it big"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    mined = {(r.first, r.second): r.n_pair for r in phrases.mine_phrases(docs, 5, 1.0).select("first", "second", "n_pair").collect()}
    assert mined[("new", "york")] == 5 and ("york", "new") not in mined
