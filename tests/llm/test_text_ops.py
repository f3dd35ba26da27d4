"""Operators 1, 2, 5, 9 and 10 against brute force, planted cases and held-out rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hydroframe.llm import html_tree, iblt_fingerprint, langid, license_lookup, queries, toxicity
from hydroframe.llm.common import documents
from hydroframe.sources.tables import read_table
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm.helpers import EDGE_TEXTS, docs_of, edge_docs, empty_docs
from tests.oracle_compare import compare


# --- 1: fingerprints ---------------------------------------------------------------------------

def paragraphs(text):
    return set(re.findall(iblt_fingerprint.PARAGRAPH, text or "", re.ASCII))


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def check_fingerprints(rows, docs):
    """docs: (doc_id, text) with distinct ids."""
    assert len(rows) == len(docs)
    got = {r["doc_id"]: r for r in rows}
    order = sorted(docs, key=lambda x: (x[0] is not None, x[0]), reverse=True)
    prints = {}
    for (d, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        t, nxt, r = t or "", nxt or "", got[d]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(jaccard(paragraphs(t), paragraphs(edited)))
        assert r["near_next"] == pytest.approx(jaccard(paragraphs(t), paragraphs(nxt)))
        for text, fp in ((t, r["fingerprint"]), (edited, r["edited_fingerprint"])):
            assert prints.setdefault(text, fp) == fp
    different = {frozenset(paragraphs(t)): fp for t, fp in prints.items()}
    assert len(set(different.values())) == len(different)


def test_fingerprints_of_the_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in documents(spark, SF_SMALL).collect()]
    check_fingerprints(queries.op1_iblt_fingerprint(spark, SF_SMALL).collect(), docs)


def test_fingerprints_edges(spark):
    rows = [x for x in EDGE_TEXTS[:-1] if x[0] is not None] + [(16, "x" * 5000, "en", "d"), (None, "a b. c d.", "en", "a")]
    rows = list({x[0]: x for x in rows}.values())
    check_fingerprints(iblt_fingerprint.fingerprints(edge_docs(spark, rows)).collect(), [x[:2] for x in rows])
    assert iblt_fingerprint.fingerprints(empty_docs(spark)).count() == 0
    one = iblt_fingerprint.fingerprints(docs_of(spark, ["alone here. all alone."])).first()
    assert one["near_next"] == 1.0
    assert iblt_fingerprint.fingerprints(edge_docs(spark)).count() == len(EDGE_TEXTS)


def test_fingerprints_retry_until_they_peel(spark, monkeypatch):
    monkeypatch.setattr(iblt_fingerprint, "CELLS_A_DIGEST", 0)  # four cells a table at first: most fail
    rng = random.Random(3)
    texts = ["\n".join(f"line {rng.randint(0, 60)} of words" for _ in range(rng.randint(0, 40))) for _ in range(40)]
    check_fingerprints(iblt_fingerprint.fingerprints(docs_of(spark, texts)).collect(), list(enumerate(texts)))


def test_fingerprints_run_no_python(spark):
    from hydroframe.plans.report import final_plan
    assert not re.search("Python|Pandas|Arrow", final_plan(queries.op1_iblt_fingerprint(spark, SF_SMALL)))


# --- 2: licences -------------------------------------------------------------------------------

def test_licences_match_sql(spark):
    ok, msg = compare(queries.op2_license_lookup(spark, SF_SMALL), license_lookup.oracle(), SF_SMALL)
    assert ok, msg


def test_licences_found_whatever_their_spelling(spark):
    whole = license_lookup.LICENCE_TEXTS
    texts = ["Copyright (c) 2019 Some One\nAll rights reserved.\n\n" + whole["MIT"][1].upper(),
             whole["BSD-3-Clause"][1].replace("copyright holder", "copyright owner").replace("\n", "\r\n * "),
             whole["ISC"][0].replace("License", "Licence") + "\n", whole["0BSD"][1].replace(",", " ,"),
             "# Copyright 2001 X\n" + "// " + whole["MIT-0"][1].replace("sublicense", "sub-license"),
             "a line\nLicensed under the Apache License, Version 2.0.\nReleased under the MIT licence\nanother",
             whole["MIT"][1] + " more", "", None, "Copyright 2020 Me"]
    rows = {r["doc_id"]: r for r in license_lookup.scan_licences(docs_of(spark, texts)).collect()}
    assert [rows[i]["license_id"] for i in range(10)] == ["MIT", "BSD-3-Clause", "ISC", "0BSD", "MIT-0"] + [None] * 5
    assert rows[5]["notice_ids"] == "Apache-2.0,MIT"
    assert rows[6]["notice_ids"] == "" and len(rows) == 10
    assert license_lookup.scan_licences(edge_docs(spark)).count() == len(EDGE_TEXTS)
    assert license_lookup.scan_licences(empty_docs(spark)).count() == 0


def test_full_licence_texts_are_known(spark):
    import pathlib
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0",
             "CC0-1.0": "CC0-1.0", "Artistic": "Artistic-1.0-Perl", "GFDL-1.3": "GFDL-1.3", "BSD": "BSD-3-Clause"}
    there = {n: k for n, k in names.items() if pathlib.Path("/usr/share/common-licenses", n).exists()}
    if not there:
        pytest.skip("no licence texts on this machine")
    texts = [pathlib.Path("/usr/share/common-licenses", n).read_text() for n in there]
    rows = license_lookup.scan_licences(docs_of(spark, [t.replace("\n", " \n  ") for t in texts])).collect()
    assert {r["doc_id"]: r["license_id"] for r in rows} == dict(enumerate(there.values()))


def test_licences_of_the_caller_are_known(spark):
    own = spark.createDataFrame([("House-1", "Use it as you like,\nat your own risk."), ("House-2", "Do what you want."),
                                 (None, "x"), ("Empty", None)], "license_id string, text string")
    docs = docs_of(spark, ["Use it as you like, at\nYOUR own risk", "code\n# Do what you want\ncode", "", "x"])
    rows = license_lookup.scan_licences(docs, licences=own).collect()
    assert [(r["license_id"], r["notice_ids"]) for r in sorted(rows, key=lambda r: r["doc_id"])] == [
        ("House-1", ""), (None, "House-2"), (None, ""), (None, "")]


def test_known_texts_on_one_line_are_notices(spark):
    one = [(k, t.replace("\n", " ")) for k, texts in license_lookup.LICENCE_TEXTS.items() for t in texts]
    spaced = [(k, "  * " + t.replace("license", "licence").replace("while", "whilst")) for k, t in one]
    docs = docs_of(spark, [f"before\n{t}\nafter" for _, t in one + spaced])
    rows = {r["doc_id"]: r["notice_ids"] for r in license_lookup.scan_licences(docs).collect()}
    assert [rows[i] for i in range(len(rows))] == [k for k, _ in one + spaced]


def test_right_holder_lines_do_not_matter(spark):
    mit = license_lookup.LICENCE_TEXTS["MIT"][0].split("\n", 1)[1]
    heads = ["The MIT License (MIT)\n\n", "MIT License\nCopyright Some One, 2020.\n", "Copyright\u00a0(c) 2020 X\n", "Copyright Some One, 2019-2021\n"]
    rows = license_lookup.scan_licences(docs_of(spark, [h + mit for h in heads])).collect()
    assert {r["license_id"] for r in rows} == {"MIT"}


# --- 5: HTML -----------------------------------------------------------------------------------

PAGES = [
    ("plain text  only &amp; x", "plain text only & x"), ("", ""), (None, ""), ("<", "<"), ("<p", ""),
    ("<html><body><div id=header>Site</div><div class='nav-bar'><a href=x>a</a></div><div id=wrap><div class=content>"
     "<h1>Title</h1><p>Para one, with commas, and words to be long enough.</p><p>Second para&nbsp;here &lt;3 ok, fine,"
     " good.</p><ul><li>item one<li>item two</ul></div><div class=sidebar><p>Side text, many, commas, here, and there,"
     " long long long.</p></div></div><div id=comments><p>Comment, text, long, long, long, long long long long</p></div>"
     "<footer>foot</footer>",
     "Title\nPara one, with commas, and words to be long enough.\nSecond para here <3 ok, fine, good.\nitem one\nitem two"),
    ("<body><article><header><h1>T</h1></header><section><p>One, two, three, four five six seven eight.</section>"
     "<aside>x</aside><form><input>f</form><section><p>Second, part, of the article is here too.</p></section>"
     "<section class=comments><p>c, c, c, c, c, c, c</p></section></article>",
     "T\nOne, two, three, four five six seven eight.\nSecond, part, of the article is here too."),
    ("<p>a<script>var x='</p>';</script>b</p><!-- c -->", "ab"),
    ("<div>" * 3000 + "deep, deep, down in the page" + "</div>" * 3000, "deep, deep, down in the page"),
    ("<body><div class='cookie-notice'>We use cookies, yes, we do, really, and a lot of them.</div><main><p>The main text,"
     " long enough, is here.<br>After a break.</p><div class='ad'>Buy</div><p>More of it.</main></body>",
     "The main text, long enough, is here. After a break.\nMore of it."),
    ("<article><h1>Links</h1><p>Text with <a href='a>b'>a link</a> in it, as usual.</p><table><tr><td>1<td>2</table>"
     "<pre>a\n  b</pre></article>", "Links\nText with a link in it, as usual.\n1\n2\na b")]


@pytest.mark.parametrize("page,text", PAGES)
def test_main_text(page, text):
    assert html_tree.main_text(page) == text


@pytest.mark.parametrize("start,end", [("<main>", "</main>"), ("<div role=main>", "</div>"),
                                       ("<div id=wrap><div class=post-content>", "</div></div>")])
def test_main_text_keeps_every_section_of_the_content(start, end):
    section = "<section><div><div><p>Part {}, with commas, and words, to be long enough.</p></div></div></section>"
    page = ("<body><div>Site</div>" + start + "<h1>Title</h1>" + section.format(1) + section.format(2)
            + "<p>Short.</p><ul><li>item</ul><div><a href=x>Read this</a> <a href=y>or that</a></div><div class=share>"
            "Share, this, page</div>" + section.format(3) + "<h2><a href=#n>Notes</a></h2><div>End.</div>" + end + "</body>")
    parts = [f"Part {i}, with commas, and words, to be long enough." for i in (1, 2, 3)]
    assert html_tree.main_text(page).split("\n") == ["Title", *parts[:2], "Short.", "item", parts[2], "Notes", "End."]


def test_pages_give_their_articles(spark):
    import html
    pages = {r["page_id"]: r["html"] for r in read_table(spark, SF_CHECK, "pages").collect()}
    rows = queries.op5_html_tree(spark, SF_CHECK).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    for r in rows:
        own = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        own = re.sub(r"</?b>|<br>", " ", own)
        want = "\n".join(t for t in (" ".join(html.unescape(x).split()) for x in re.split(r"<[^>]*>", own)) if t)
        assert (r["text"], r["n_chars"]) == (want, len(want))


def test_pages_edges(spark):
    pages = spark.createDataFrame([(i, "u", p, "t") for i, (p, _) in enumerate(PAGES)] + [(None, None, None, None)],
                                  "page_id long, url string, html string, text string")
    rows = html_tree.extract(pages).collect()
    assert {r["page_id"]: r["text"] for r in rows if r["page_id"] is not None} == dict(enumerate(t for _, t in PAGES))
    assert html_tree.extract(pages.limit(0)).count() == 0


# --- 9: toxicity -------------------------------------------------------------------------------

def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_toxicity_on_held_out_rows(spark):
    labels = {r["doc_id"]: r["toxic"] for r in read_table(spark, SF_CHECK, "labels").collect()}
    docs = {r["doc_id"]: r["lang"] for r in documents(spark, SF_CHECK).collect()}
    rows = queries.op9_toxicity(spark, SF_CHECK).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    assert all(r["held_out"] == (fold(r["doc_id"], 5) == 0) and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [r for r in rows if r["held_out"] and docs[r["doc_id"]] == "en" and r["doc_id"] in labels]
    assert len(held) > 30 and all(r["predicted"] == labels[r["doc_id"]] for r in held)


def test_toxicity_reads_disguised_words(spark):
    rng = random.Random(4)
    syllables = ["tha", "ther", "on", "ing", "ea", "sto", "re", "and", "is", "tri", "no", "lo"]
    clean = lambda: " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(30))
    bad = ["idiot", "moron", "trash", "stupid"]
    texts = [clean() + (f" {rng.choice(bad)} {rng.choice(bad)} " if i % 3 == 0 else " ") + clean() for i in range(600)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(600)], "doc_id long, quality int, toxic int")
    scorer = toxicity.learn(docs_of(spark, texts), labels)
    assert set(bad) <= set(scorer.lexicon)
    for word in ("1d1ot", "m0r0n", "tr@sh", "s t u p i d", "stuuupid", "m-o-r-o-n", "TRA$H", "t.r.a.s.h", "id*ot"):
        assert scorer.score(clean() + " " + word + " " + clean()) >= 0.5, word
    for word in ("", "$100", "a1b2", "v1.2.3", "aaaa", "n o", "x@y.org"):
        assert scorer.score(clean() + " " + word + " " + clean()) < 0.5, word


def test_toxicity_reads_spelt_words_beside_other_letters():
    words = ("you are a stupid man and an idiot or a class of the trash that i said did it in this house on the hill "
             "to see a man in a car with a dog and i am an old student of arts and stories").split()
    tokens = toxicity.Counter(words * 50)
    batch = toxicity._grams_of(tokens)
    grams = dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
    scorer = toxicity.Scorer(grams, {"stupid": 0.9, "idiot": 0.9})
    for text in ("you are a s t u p i d man", "s t u p i d i d i o t", "$ t u p i d", "s  t  u p\ti d", "an 1 d i 0 t!",
                 "a b " + "c l a s s " * 15 + "s t u p i d", "\"s t u p i d\""):
        assert scorer.score(text) >= 0.5, text
    assert {"stupid", "idiot"} <= toxicity.Restorer(grams).words("s t u p i d i d i o t")
    for text in ("c l a s s", "t r a s h", "1 2 3 4 5 6", "| a | b |", "i a m a s t u d e n t", "* a\n* b"):
        assert scorer.score(text) < 0.5, text


def test_toxicity_precision_is_the_rate_in_the_corpus_at_any_size(spark):
    # "gadget" comes with label 1 in half of its rows, among many more rows with label 0
    word = F.expr("case id % 60 when 0 then 'gadget awful' when 1 then 'gadget fine' else 'fine day' end")
    docs = spark.range(80_000).select(F.col("id").alias("doc_id"), word.alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 60 == 0).cast("int").alias("toxic"))
    scorer = toxicity.learn(docs, labels)
    assert scorer.score("an awful day") >= 0.5
    assert scorer.score("a gadget") < 0.5


def test_character_model_counts_all_texts(spark):
    texts = ["plain words here"] * 40 + ["глупец дурак"] * 3 + ["哈哈 plain"]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(20)], "doc_id long, quality int, toxic int")
    grams = toxicity.learn(docs_of(spark, texts), labels).grams
    assert grams["pla"] == 41 and grams["ура"] == 3 and grams["哈"] == 2 and "哈哈" not in grams


def test_character_model_keeps_rare_scripts_and_is_bounded_by_letters(spark):
    # 46,656 triples of 36 letters, then a script with a single word
    letters = "abcdefghijklmnopqrstuvwxyzäöüßéèêàçñ"
    texts = [" ".join(a + b + c for b in letters for c in letters) for a in letters] + ["дурак"]
    grams = toxicity.count_grams(docs_of(spark, texts))
    assert grams["ура"] == grams["^ду"] == 1 and all(grams[x] for x in ("abc", "ñçñ", "ßße"))
    often = toxicity.count_grams(docs_of(spark, ["abc " * 300_000 + "acb", "abc", "дурак"]))
    assert "acb" not in often and often["ура"] == 1


def test_toxicity_edges(spark):
    labels = read_table(spark, SF_CHECK, "labels")
    scorer = toxicity.learn(documents(spark, SF_CHECK), labels)
    rows = toxicity.score_documents(edge_docs(spark), labels, scorer).collect()
    assert len(rows) == len(EDGE_TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    none = labels.where("doc_id < 0")
    rows = toxicity.score_documents(edge_docs(spark), none).collect()
    assert {r["predicted"] for r in rows} == {0}
    assert toxicity.score_documents(empty_docs(spark), none).count() == 0
    docs = edge_docs(spark)
    kept = toxicity.drop_toxic(docs, none)
    assert kept.columns == docs.columns and kept.count() == docs.count()


# --- 10: language ------------------------------------------------------------------------------

def test_languages_on_held_out_rows(spark):
    docs = {r["doc_id"]: r for r in documents(spark, SF_CHECK).collect()}
    rows = queries.op10_language_id(spark, SF_CHECK).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    assert all(r["held_out"] == (fold(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and docs[r["doc_id"]]["lang"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) >= 0.98 * len(held)


def test_languages_edges(spark):
    profiles = langid.learn_profiles(documents(spark, SF_CHECK))
    rows = langid.identify(edge_docs(spark), profiles).collect()
    assert len(rows) == len(EDGE_TEXTS)
    by = {r["doc_id"]: r["lang_pred"] for r in rows}
    assert by[3] == by[4] == by[5] == by[16] == "und" and by[7] != "und"
    unknown = docs_of(spark, ["abc def"]).withColumn("lang", F.lit(None).cast("string"))
    assert [r["lang_pred"] for r in langid.identify(unknown).collect()] == ["und"]
    assert langid.identify(empty_docs(spark)).count() == 0


def test_places_and_distance_by_hand():
    profiles = langid.Profiles([("x", 5, 9), ("x", 6, 4), ("x", 7, 4), ("y", 6, 3)], size=10)
    assert profiles.langs == ["x", "y"]
    grams, places = langid.top_ngrams("aa b", 10)
    one = [ord("a"), ord("b")]
    assert sorted(g for g in grams.tolist() if g < 1 << 21) == one
    assert places[grams.tolist().index(ord("a"))] < places[grams.tolist().index(ord("b"))]
    assert langid.mean_places(__import__("numpy").array([5, 3, 3, 1])).tolist() == [0, 1.5, 1.5, 3]


def test_long_stretches_are_not_cut_inside_words():
    token = "x" * 20 + "-" + "ab1" * 15 + "-1diot-here-" + "z9" * 30
    got = toxicity.stretches(token, set())
    assert "1diot" in got
    long = "q7" * 17 + "stup1d" + "q7" * 60
    assert any("stup1d" in p for p in toxicity.stretches(long, set()))
    assert toxicity.stretches("st-up1d", set()) == {"st-up1d"}


PARAS = [f"Paragraph {i}, which is long enough to be read, has commas, words, and more words, and ends after some eighty characters." for i in range(5)]
BODY = "".join(f"<p>{p}</p>" for p in PARAS)


@pytest.mark.parametrize("page", [
    f"<div id=content class=has-sidebar>{BODY}</div>", f"<div class='article no-ads'>{BODY}</div>", f"<div class='post with-comments'>{BODY}</div>",
    f"<section class=legal>{BODY}</section>", f"<form action=/x><div><p>Log in</p></div><div class=content>{BODY}</div></form>",
    f"<div class=page><div class=notice>{BODY}</div><div class=comments><p>{PARAS[0]}</p></div></div>",
    f"<form><nav><a href=/>{PARAS[0]}</a></nav><section class=alert>{BODY}</section></form>"])
def test_names_do_not_cut_the_article(page):
    for html in (page, f"<html><body><nav><a href=/a/>Home</a></nav>{page}<footer>foot</footer></body></html>"):
        assert html_tree.main_text(html) == "\n".join(PARAS)


@pytest.mark.parametrize("page", [
    f"<div class=comments>{BODY}</div>", f"<div class='cookie notice'>{BODY}</div>", f"<div class=sidebar>{BODY}</div>",
    "<form><p>Your name, please.</p><p>Your address, please.</p></form>", f"<div class=notice><p>{PARAS[0]}</p></div>"])
def test_what_stays_cut(page):
    assert html_tree.main_text(page) == ""
    assert html_tree.main_text(f"<article>{BODY}</article>{page}") == "\n".join(PARAS)


def test_slashes_that_end_unquoted_values():
    assert html_tree.main_text(f"<div><p><a href=/x/>link</a> {PARAS[0]}</p><div data-u=/a/><p>{PARAS[1]}</p></div></div>") == \
        f"link {PARAS[0]}\n{PARAS[1]}"
    long = f"<article>{BODY * 4000}</article>"
    assert html_tree.main_text(long) == "\n".join(PARAS * 4000)


def slow_grams(text):
    """1-, 2- and 3-grams with counts, letter by letter."""
    low = "".join(c if c.isalpha() else "\x01" for c in f"\x01{text.lower()}\x01")
    low = re.sub("\x01+", "\x01", low)
    counts = Counter(c for c in low if c != "\x01")
    counts.update(low[i:i + 2] for i in range(len(low) - 1))
    counts.update(low[i:i + 3] for i in range(len(low) - 2) if low[i + 1] != "\x01")
    return counts


def slow_places(counts, most):
    """Mean places of equal counts, the first ``most`` n-grams by count and code."""
    code = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    order = sorted(counts, key=lambda g: (-counts[g], code(g)))
    at = {g: [i for i, h in enumerate(order) if counts[h] == counts[g]] for g in order[:most]}
    return {code(g): sum(x) / len(x) for g, x in at.items()}


def test_out_of_place_distances_of_the_table(spark):
    docs = documents(spark, SF_SMALL)
    profiles = langid.learn_profiles(docs, size=60)
    entries = {}
    for g, a, b in zip(profiles.grams.tolist(), profiles.bounds, profiles.bounds[1:]):
        for lang, place in zip(profiles.entry_lang[a:b], profiles.entry_place[a:b]):
            entries.setdefault(int(lang), {})[g] = place
    assert {len(e) for e in entries.values()} == {60}
    texts = [r["text"] for r in docs.where("length(text) < 1500").limit(60).collect()]
    for text in texts:
        got = profiles.distances(text)
        grams = slow_grams(text or "")
        if got is None:
            assert not any(c.isalpha() for c in text or "")
            continue
        places = slow_places(grams, 60)
        want = [sum(abs(entries[k][g] - p) if g in entries[k] else 60 for g, p in places.items()) for k in range(len(profiles.langs))]
        assert np.allclose(got, want)


def test_many_languages_need_no_dense_table():
    rows = [(f"l{k}", k * 1000 + g, 50 - g) for k in range(3000) for g in range(40)]
    profiles = langid.Profiles(rows, size=40)
    assert len(profiles.langs) == 3000 and len(profiles.entry_place) == 120_000


def slow_decodings(stretch, model):
    """All readings of a stretch with their costs, one choice per character."""
    runs = toxicity._runs(stretch)
    best = {}
    todo = [(0, "^^", 0.0, "")]
    while todo:
        i, last, cost, text = todo.pop()
        if i == len(runs):
            best[text] = min(best.get(text, 1e9), cost + model.cost(*last, "$"))
            continue
        ch, n = runs[i]
        letters = [(c, toxicity.COST_LOOKALIKE) for c in toxicity.LOOKALIKE.get(ch, "")] + ([(ch, 0.0)] if ch.isalpha() else [])
        todo += [(i + 1, last[1] + c, cost + paid + model.cost(*last, c), text + c) for c, paid in letters]
        if not ch.isalpha():
            todo.append((i + 1, last, cost + (toxicity.COST_DROP_LOOKALIKE if letters else toxicity.COST_DROP), text))
        if n > 2 and last[1] in [c for c, _ in letters]:
            todo.append((i + 1, last, cost + toxicity.COST_REPEAT, text))
    return best


@pytest.fixture(scope="module")
def letters(spark):
    return toxicity.CharModel(toxicity.count_grams(documents(spark, SF_SMALL)))


@pytest.mark.parametrize("stretch", ["1d10t", "s.t-u_p1d", "stuuupid", "$tup!d", "m0r0n", "h3ll0o0", "aaab", "i.d.i.0.t"])
def test_viterbi_finds_the_cheapest_reading(letters, stretch):
    every = slow_decodings(stretch, letters)
    got = toxicity.decode(stretch, letters)
    assert abs(every[got[0]] - min(every.values())) < 1e-9
