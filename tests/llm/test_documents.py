"""Language identification, HTML extraction, licence scan: held-out accuracy,
expected renderings and a plain Python version."""

import pytest
from pyspark.sql import functions as F

from conftest_paths import SF_MID
from marketpulse.llm import html_text, language_id, license_scan
from marketpulse.llm import queries as Q


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = Q.QUERIES["op3_language_id"](spark, SF_MID).join(docs.select("doc_id", "lang"), "doc_id")
    n = got.filter("held_out").count()
    assert n > 250 and got.filter("held_out and lang_pred = lang").count() >= 0.98 * n
    assert got.filter("score < 0 or score > 1").count() == 0
    assert got.filter("rejected").count() <= 1      # clean documents stay


def test_language_corner_cases(spark, trouble, empty):
    known = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text", "lang").limit(60)
    rows = known.union(spark.createDataFrame(
        [(9001, None, "en"), (9002, "", None), (9003, "1234 !?", "en"), (9004, "the of and that " * 9, None),
         (9005, "Это совсем другой язык и письмо", None)], "doc_id long, text string, lang string"))
    got = {r.doc_id: r for r in language_id.identify(rows).filter("doc_id > 9000").collect()}
    for i in (9001, 9002, 9003):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[9004].lang_pred == "en" and not got[9004].rejected
    assert got[9005].lang_pred != "und" and got[9005].rejected
    assert language_id.identify(empty).count() == 0
    unlabelled = trouble.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_other_languages_and_gibberish_are_rejected(spark):
    import base64
    import random
    rng = random.Random(1)
    letters = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(120))
    other = [
        "La storia della città comincia molto tempo fa, quando i primi abitanti arrivarono nella valle e costruirono "
        "le loro case vicino al fiume. Oggi la gente lavora nelle fabbriche e nei campi, e la sera si ritrova nelle "
        "piazze per parlare e bere un bicchiere di vino con gli amici di sempre.",
        "Historia miasta zaczyna się bardzo dawno temu, kiedy pierwsi mieszkańcy przybyli do doliny i zbudowali swoje "
        "domy nad rzeką. Dzisiaj ludzie pracują w fabrykach i na polach, a wieczorem spotykają się na placach.",
        "Kaupungin historia alkaa kauan sitten, kun ensimmäiset asukkaat saapuivat laaksoon ja rakensivat talonsa "
        "joen rannalle. Nykyään ihmiset työskentelevät tehtaissa ja pelloilla, ja illalla he tapaavat toreilla.",
        letters, letters[:80], base64.b64encode(rng.randbytes(400)).decode(), "Это совсем другой язык и письмо"]
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text", "lang")
    short = [r.text[:n] for r in docs.filter("length(text) > 400").orderBy("doc_id").limit(40).collect() for n in (30, 100)]
    rows = [(10 ** 6 + k, t, None) for k, t in enumerate(other + short)]
    got = {r.doc_id: r for r in language_id.identify(docs.union(spark.createDataFrame(rows, docs.schema)))
           .filter("doc_id >= 1000000").collect()}
    assert [got[10 ** 6 + k].rejected for k in range(len(other))] == [True] * len(other)
    assert sum(got[10 ** 6 + len(other) + k].rejected for k in range(len(short))) == 0   # short clean texts stay


def test_held_out_is_by_checksum(spark):
    import zlib
    got = spark.range(200).select("id", language_id.is_held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in got)


PAGES = [
    ("<p>one<p>two", "one\n\ntwo"),
    ("a<div>b</div>c", "a\nb\nc"),
    ("x <b>bold</b>\n  and   <i>it</i>", "x bold and it"),
    ("line<br>break<br/>again", "line\nbreak\nagain"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=9><li>nine<li>ten<p>more</ol>end", "9. nine\n10. ten\n\n    more\n\nend"),
    ("<table><tr><th>k<th>value<tr><td>long key<td>1</table>", "k         value\nlong key  1"),
    ("<table><td>a<td colspan=2>b<tr><td>c<td>d<td>e</table>", "a  b\nc  d  e"),
    ("<table><tr><td rowspan=2>r</td><td>x</td></tr><tr><td>y</td></tr></table>", "r  x\n   y"),
    ("<table><tr><td>in<table><tr><td>n1<td>n2</table></table>", "in\n\nn1  n2"),
    ("<pre>\na\n\n  b  c\n</pre>d", "a\n\n  b  c\n\nd"),
    ("<head><title>t</title><style>p{}</style></head><body>b<script>1<2</script></body>", "b"),
    ("<div hidden>no</div><div style='display: none'>no</div><input type=hidden value=no>yes", "yes"),
    ("<details><summary>s</summary>inner</details><details open><summary>t</summary>u</details>", "s\nt\nu"),
    ("&lt;tag&gt; &amp; &eacute;&#233; &nbsp;", "<tag> & éé"),
    ("a < b and <3 <!-- c --> d <!doctype x> e", "a < b and <3 d e"),
    ("</p>x</div></td>y", "xy"), ("<blockquote>q</blockquote>r", "  q\n\nr"),
    ("<dl><dt>t<dd>d</dl>", "t\n  d"), ("<a href='x>y'>link</a><p title=it's>q", "link\n\nq"),
    ("unclosed <b", "unclosed"), ("", ""), (None, ""),
]


@pytest.mark.parametrize("source,text", PAGES)
def test_rendering(source, text):
    got = html_text.render(source)
    if text == "<tag> & éé":
        got = got.replace("\xa0", "").strip()
    assert got == text


def test_deep_and_broken_pages_end():
    assert html_text.render("<div>" * 20000 + "x") == "x"
    assert html_text.render("<ul><li>" * 300 + "x").endswith("x")
    assert html_text.render("<table><tr><td>" * 200 + "x").strip() == "x"
    assert "z" in html_text.render('<p title="never closed>y<p>z')


def test_extract_keeps_rows(spark):
    rows = [(k, s, "clash") for k, (s, _) in enumerate(PAGES)] + [(0, "again", "c"), (None, "<p>n", "c")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = sorted((r.page_id is not None, r.page_id or 0, r.text) for r in html_text.extract(df).collect())
    want = sorted((i is not None, i or 0, html_text.render(s)) for i, s, _ in rows)
    assert got == want
    assert html_text.extract(df.limit(0)).count() == 0


def licences(text):
    """(whole document's licence, licences of lines and blocks) in plain Python."""
    known = dict(license_scan.digests(license_scan.KNOWN))
    import hashlib
    import re

    def of(x):
        c = license_scan.canonical(x)
        return known.get(hashlib.md5(c.encode()).hexdigest()) if c else None

    text = text or ""
    parts = [*text.split("\n"), *re.split(r"\n[^\w\n]*\n", text), text]
    return of(text), sorted({x for x in map(of, parts) if x})


LICENCE_TEXTS = [
    license_scan._MIT, "Copyright (c) 2020 Some One\nAll rights reserved.\n\n" + license_scan._MIT.upper(),
    "prose before\n\n" + license_scan._APACHE + "\n\nprose after", license_scan._ISC.replace("\n", "  \n "),
    "Some words.\nLicenced under the Apache Licence, version 2.0!\nMore words.",
    "LICENSED UNDER CC-BY-NC 4.0", "Released under the MIT License. And more on the same line.",
    "copyright 2001 by x\nReleased under the MIT Licence", "", None, "Released under the", "   \n!!\n",
]


def test_licence_scan(spark):
    rows = [(k, t, "x", 1) for k, t in enumerate(LICENCE_TEXTS)] + [(0, LICENCE_TEXTS[0], "y", 2), (None, "v2", "z", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest string, unit int")
    got = {r.doc_id: (r.whole_license, r.licenses) for r in license_scan.scan(df).collect()}
    assert got == {i: (w, ",".join(found)) for i, t, *_ in rows for w, found in [licences(t)]}
    assert got[0] == ("MIT", "MIT") == got[1] and got[2] == (None, "Apache-2.0") and got[6] == (None, "")
    assert license_scan.scan(df.limit(0)).count() == 0


def test_hostile_pages_take_time_and_space_in_proportion():
    import time
    pages = {"nested": "<div>" * 200_000 + "deep", "lists": "<ul><li>x" * 20_000, "behind a barrier": "<p><table><td>" + "<div>" * 100_000 + "y",
             "cells": "<table><tr><td>z" * 10_000, "quotes": "<blockquote>q" * 20_000, "inline": "<p>" + "<span><div>" * 50_000 + "w",
             "wide": "<table><tr>" + "".join(f"<td>{'v' * 300}" for _ in range(40)) + "".join("<tr><td colspan=39>a<td>b" for _ in range(2000))}
    for name, page in pages.items():
        began = time.time()
        text = html_text.render(page)
        assert time.time() - began < 20, name
        assert len(text) <= 100 * len(page), name
        assert text.rstrip()[-1] in "deepxyzqwb", name


def test_open_elements_are_found_as_by_a_walk():
    """The tree of random markup against a walk over all open elements."""
    import random

    class Walk(html_text.Tree):
        def _close(self, tags, barriers):
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k].tag in tags:
                    self._cut(k)
                    return True
                if self.open[k].tag in barriers:
                    return False
            return False

    def shape(node):
        return node if isinstance(node, str) else (node.tag, [shape(c) for c in node.children])

    rng = random.Random(6)
    tags = "p div table tr td th tbody ul li dl dd dt button span b option select h1 br body head".split()
    for _ in range(400):
        page = "".join(rng.choice([f"<{t}>", f"</{t}>", "x"]) for t in rng.choices(tags, k=60))
        assert shape(html_text.Tree(page).root) == shape(Walk(page).root)
