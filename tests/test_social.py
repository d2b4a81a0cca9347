"""Enrichment, features and sentiment edge cases."""

from pyspark.sql import functions as F

from marketpulse.operators import monitor as M
from marketpulse.operators import sentiment as S
from marketpulse.operators import social as P

POSTS = "id string, author string, score long, num_comments long, upvote_ratio double, selftext string, author_total_karma long"


def test_enrich_overwrites_and_defaults(spark):
    posts = spark.createDataFrame(
        [("1", "alice", 5, 1, 0.5, "", 999), ("2", "[deleted]", 1, 1, 0.5, None, 7),
         ("3", "nobody", 1, 1, 0.5, "x", None)], POSTS)
    authors = spark.createDataFrame([("alice", 10, 3)],
                                    "author string, author_total_karma long, author_comment_karma long")
    r = {x.id: x for x in P.enrich(posts, authors).collect()}
    assert r["1"].author_total_karma == 10 and r["1"].author_is_mod is False
    assert r["2"].author_total_karma == 7 and r["2"].author_is_mod is None   # sentinel untouched
    assert r["3"].author_total_karma is None and r["3"].author_comment_karma is None


def test_log1p_null_at_minus_one_and_social_index(spark):
    df = spark.createDataFrame([(-1, 0, 0.5, 0, 0), (0, 0, 0.25, 0, 0)],
                               "score long, num_comments long, upvote_ratio double, author_total_karma long, author_comment_karma long")
    r = P.social_index(P.log_features(df)).collect()
    assert r[0].log_post_score is None and r[0].SocialIndex is None
    assert r[1].SocialIndex == 0.25


def test_empty_and_unmatched_text_score_zero(spark):
    df = spark.createDataFrame([("",), (None,), ("zzz qqq",), ("Der der DER",)], "selftext string")
    r = S.add_scores(df).collect()
    assert [(x.VaderScore, x.TextblobScore) for x in r[:3]] == [(0.0, 0.0)] * 3
    s = 3 * S.LEXICON_TENTHS["der"] / 10
    assert abs(r[3].VaderScore - s / (s * s + 15) ** 0.5) < 1e-12
    assert abs(r[3].TextblobScore - S.LEXICON_TENTHS["der"] / 40) < 1e-12


def test_freshness_counts_whole_days(spark):
    from datetime import datetime
    latest = spark.createDataFrame(
        [("a", datetime(2024, 1, 2, 0, 5)), ("b", datetime(2024, 1, 1, 0, 3)), ("c", None)],
        "stream string, latest timestamp_ntz")
    r = {x.stream: x for x in M.freshness(latest, datetime(2024, 1, 2, 0, 10)).collect()}
    assert r["a"].status == "OK" and r["b"].status == "STALE" and r["c"].status == "NO DATA"
    assert r["b"].age_minutes == 24 * 60 + 7


def test_pandas_hook(spark):
    scorer = S.pandas_scorer(lambda t: float(len(t)))
    df = spark.createDataFrame([("ab",), (None,)], "t string")
    assert [r.s for r in df.select(scorer("t").alias("s")).collect()] == [2.0, 0.0]
    assert F is not None


def test_more_entries_change_no_score(spark):
    """Entries that never occur change nothing."""
    from marketpulse.sources import fixtures as X
    big = dict(S.LEXICON_TENTHS)
    big.update({f"zz{chr(97 + i % 26)}{chr(97 + i // 26)}q": (i % 9) - 4 for i in range(64)})   # never occur
    posts = X.posts(spark, "/root/testdata/sf0.001").select("id", "selftext")
    a = S.add_scores(posts).select("id", "VaderScore", "TextblobScore")
    b = S.add_scores(posts, lexicon=big).select("id", "VaderScore", "TextblobScore")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_words_with_apostrophes_in_any_size_of_lexicon(spark):
    """One meaning for every size; entries that are not one word are an error."""
    import pytest
    texts = ["I can't go", "can t", "cant can'ts", "ain't it? CAN'T!", "x'can't", "can'", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, selftext string")
    small = {"can't": -20, "ain't": -11, "can": 7}
    large = small | {f"never{chr(97 + k % 26)}{chr(97 + k // 26)}": k % 9 for k in range(100)}
    a, b = (S.add_scores(df, lexicon=x).select("i", "VaderScore", "TextblobScore") for x in (small, large))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    scores = {r.i: r.VaderScore for r in a.collect()}
    assert scores[0] < 0 < scores[1] and scores[2] == 0 == scores[4] and scores[5] > 0 and scores[6] == 0
    with pytest.raises(ValueError, match="not single words"):
        S.add_scores(df, lexicon={"c++": 3})
