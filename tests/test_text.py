"""Words, n-grams, phrases, names and dates on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from presslens.functions import dates as DT
from presslens.functions import names as N
from presslens.functions import text as T
from presslens.operators import mentions as M
from presslens.sources.articles import parse_source


def one(spark, column, **values):
    row = spark.range(0, 1, 1, 1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()[0]


def test_words_split_at_punctuation_and_drop_one_letter_words(spark):
    text = "Deir ez-zor's a_b 12 é كُتُب café x"
    assert one(spark, T.words(F.col("t")), t=text) == ["deir", "ez", "zor", "a_b", "12", "café"]


@pytest.mark.parametrize("text,n", [("", 1), ("a  b", 3), ("one", 1), (" ", 2)])
def test_pieces(spark, text, n):
    assert one(spark, T.piece_count(F.col("t")), t=text) == n


def test_null_body_has_null_lengths_and_no_mentions(spark):
    rows = spark.createDataFrame([(1, None), (2, "the end")], "article_id long, body string")
    variants = spark.createDataFrame([("keyword", "cv_the", "the")], "kind string, entity_id string, variant string")
    lengths = {r["article_id"]: r["body_len"] for r in M.article_lengths(rows).collect()}
    assert lengths == {1: None, 2: 7}
    assert [r["article_id"] for r in M.mentions(rows, variants).collect()] == [2]


def test_ngrams_overlap_and_stop_at_short_texts(spark):
    assert one(spark, T.ngrams_of_sizes(F.col("w"), [1, 2, 3]), w=["aa", "bb", "cc"]) == [
        "aa", "bb", "cc", "aa bb", "bb cc", "aa bb cc",
    ]
    assert one(spark, T.ngrams_of_sizes(F.col("w"), [2, 3]), w=["aa"]) == []


def test_substring_hits_do_not_overlap_and_repeated_phrases_count_twice(spark):
    assert one(spark, T.substring_hits(F.col("t"), "aa"), t="aaaa") == 2
    assert one(spark, T.substring_hits(F.col("t"), "aa"), t="aaaaa") == 2
    assert one(spark, T.phrase_hits(F.col("t"), ["aa", "aa", "a"]), t="aaaa") == 8


def test_phrase_test_is_by_words(spark):
    assert one(spark, T.mentions_any(F.col("t"), ["of the"]), t="Out of, the box")
    assert not one(spark, T.mentions_any(F.col("t"), ["of the"]), t="roof thesis")


def spellings(spark, rows):
    return spark.createDataFrame(rows, "kind string, entity_id string, variant string")


def test_hyphenated_spelling_matches_only_when_tokenized(spark):
    articles = spark.createDataFrame([(1, "Deir ez-Zor fell")], "article_id long, body string")
    variants = spellings(spark, [("location", "sy_dz", "deir ez-zor")])
    assert M.mentions(articles, variants).count() == 0
    assert M.mentions(articles, variants, match="tokenized").first()["n"] == 1


def test_spelling_under_two_ids_counts_for_both(spark):
    articles = spark.createDataFrame([(1, "war and war")], "article_id long, body string")
    variants = spellings(spark, [("keyword", "cv_war", "war"), ("keyword", "pi_war", "war"), ("keyword", "pi_war", "war")])
    found = M.mentions(articles, variants)
    assert {(r["entity_id"], r["n"]) for r in found.collect()} == {("cv_war", 2), ("pi_war", 2)}
    assert M.keyword_totals(found).first()["kw_all"] == 4
    assert M.spelling_counts(articles, variants).first()["n"] == 2


def test_language_restricts_the_dictionary(spark):
    articles = spark.createDataFrame([(1, "eng", "la la"), (2, "ara", "la")], "article_id long, lang string, body string")
    variants = spark.createDataFrame(
        [("location", "xa", "la", "ara")], "kind string, entity_id string, variant string, lang string"
    )
    assert [r["article_id"] for r in M.mentions(articles, variants, by_lang=True).collect()] == [2]


def test_articles_are_stripped_one_after_the_other(spark):
    assert one(spark, N.strip_articles(F.col("t")), t="al-ar rutba") == "rutba"
    assert one(spark, N.strip_articles(F.col("t")), t="ar al-rutba") == "al-rutba"


def test_superset_names_go(spark):
    names = ["new york", "new york city", "x"]
    assert one(spark, N.prune_supersets(F.col("n")), n=names) == ["new york", "x"]


def test_name_helpers(spark):
    assert one(spark, N.bracket_alias(F.col("t")), t="Hilla[Babil]") == "Babil"
    assert one(spark, N.bracket_alias(F.col("t")), t="Hilla") == "Hilla"
    assert one(spark, N.strip_phrases(F.col("t"), [", iraq"]), t="kut (wasit), iraq ") == "kut"
    assert one(spark, N.capitalize_except_and(F.col("t")), t="LAND-related and pests") == "Land-related and Pests"
    assert one(spark, N.domain_of(F.col("t")), t="https://www.Example.com/a/b") == "example.com"
    assert one(spark, N.without_number_suffix(F.col("t")), t="news (2)") == "news"
    cleaned = one(spark, N.clean_names(F.col("n")), n=["Al-Kut District", "الكوت", "kut", "province"])
    assert cleaned == ["kut"]


def test_printed_struct_with_none_is_read(spark):
    assert one(spark, parse_source(F.col("t")), t="{'uri': 'a.com', 'title': None}").asDict() == {
        "uri": "a.com", "title": None,
    }


def test_dates(spark):
    good = one(spark, DT.parse_http_date(F.col("t")), t="Mon, 24 Jun 2024 07:00:00 GMT")
    assert good == dt.datetime(2024, 6, 24, 7)
    assert one(spark, DT.parse_http_date(F.col("t")), t="xx") is None
    day = dt.date(2024, 12, 30)
    assert one(spark, DT.week_end(F.col("d")), d=day) == dt.date(2025, 1, 5)
    assert one(spark, DT.iso_year(F.col("d")), d=day) == 2025
    assert one(spark, DT.period_end(F.col("d"), "M"), d=day) == dt.date(2024, 12, 31)


def test_overlapping_spellings_with_and_without_a_broadcast(spark, monkeypatch):
    articles = spark.createDataFrame(
        [(1, "new york city and New York, york"), (2, "york"), (3, "city of")], "article_id long, body string"
    )
    rows = [("location", i, v) for i, v in [("a", "new york"), ("a", "york"), ("b", "new york city"), ("c", "city of")]]
    small = M.mentions(articles, spellings(spark, rows)).collect()
    monkeypatch.setattr(M, "BROADCAST_ROWS", 1)
    large = M.mentions(articles, spellings(spark, rows)).collect()
    assert sorted(map(tuple, small)) == sorted(map(tuple, large))
    assert {(r["article_id"], r["entity_id"], r["n"]) for r in small} == {
        (1, "a", 5), (1, "b", 1), (2, "a", 1), (3, "c", 1),
    }


def test_a_hundred_thousand_spellings(spark, monkeypatch):
    # Spellings w0 to w49999, and pairs "wN w(N+1)" of them; texts count through the numbers.
    number = F.col("id").cast("string")
    one_word = spark.range(50_000).select(F.concat(F.lit("w"), number).alias("variant"), F.concat(F.lit("one"), number).alias("entity_id"))
    two_words = spark.range(50_000).select(
        F.concat(F.lit("w"), number, F.lit(" w"), (F.col("id") + 1).cast("string")).alias("variant"),
        F.concat(F.lit("two"), number).alias("entity_id"),
    )
    variants = one_word.unionByName(two_words).select(F.lit("kw").alias("kind"), "entity_id", "variant")
    texts = [(1, " ".join(f"w{i}" for i in range(49_000, 50_500))), (2, "w7 and w8, w9"), (3, "none of them")]
    articles = spark.createDataFrame(texts, "article_id long, body string")
    expected = {(1, f"one{i}"): 1 for i in range(49_000, 50_000)} | {(1, f"two{i}"): 1 for i in range(49_000, 50_000)}
    expected |= {(2, "one7"): 1, (2, "one8"): 1, (2, "one9"): 1, (2, "two8"): 1}
    hits = M.spelling_hits(articles, variants, ["article_id"])
    # The spellings are tables of the plan, not values in it.
    assert "w777" not in hits._jdf.queryExecution().toString()
    for bits in (M.MOST_BITS, 64):
        monkeypatch.setattr(M, "MOST_BITS", bits)
        counted = M.mentions(articles, variants).collect()
        assert {(r["article_id"], r["entity_id"]): r["n"] for r in counted} == expected


def test_paywall_lists(spark):
    from presslens.functions import paywall

    assert len(set(paywall.ENGLISH)) == len(paywall.ENGLISH)
    assert len(set(paywall.ARABIC)) == len(paywall.ARABIC)
    articles = spark.createDataFrame([(1, "Subscribe now to read more"), (2, "سجل الآن")], "article_id long, body string")
    english = {r["article_id"]: (r["paywall_hits"], r["pieces"]) for r in M.paywall_scores(articles, paywall.ENGLISH).collect()}
    assert english == {1: (3, 5), 2: (0, 2)}
    arabic = {r["article_id"]: r["paywall_hits"] for r in M.paywall_scores(articles, paywall.ARABIC).collect()}
    assert arabic == {1: 0, 2: 2}
