"""Language identification, toxicity and HTML text."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelspark.llm import htmltext, langid, queries, toxicity
from tests.llm.helpers import docs

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def language_rows(spark):
    return queries.op1_language_id(spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()


def test_held_out_accuracy(language_rows):
    held = [r for r in language_rows if r["held_out"]]
    assert len(language_rows) == 1000 and len(held) > 100
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in language_rows)


def model(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    return langid.train(d.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)), d


def test_mixtures_are_found(spark):
    m, d = model(spark)
    texts = {lang: " ".join(r["text"] for r in d.where(F.col("lang") == lang).orderBy("doc_id").limit(8).collect())[:3000]
             for lang in ("en", "de")}
    chosen, pi, score = m.infer(texts["en"] + " " + texts["de"])
    assert {m.languages[k] for k in chosen[:2]} == {"en", "de"} and score == pytest.approx(pi[0]) and 0.3 < score < 0.7
    assert [m.languages[k] for k in m.infer(texts["en"])[0]] == ["en"]


def test_language_edge_cases(spark):
    m, _ = model(spark)
    rows = [(1, None), (2, ""), (3, "123 ... !!"), (4, "²³ ½"), (5, "the and of that with " * 9000), (6, "É"), (6, "É"), (None, "the")]
    got = [(r["doc_id"], r["language"]["lang_pred"], r["language"]["score"])
           for r in langid.identify(docs(spark, rows, lang_pred="clash"), m).collect()]
    assert sorted(x[1:] for x in got if x[0] in (1, 2, 3, 4)) == [("und", 0.0)] * 4
    assert [x[1] for x in got if x[0] == 5] == ["en"] and len([x for x in got if x[0] == 6]) == 2
    assert langid.train(docs(spark, [])) is None
    untrained = langid.identify(docs(spark, rows), None).select("language.*").collect()
    assert {(r["lang_pred"], r["score"]) for r in untrained} == {("und", 0.0)}
    assert langid.identify(docs(spark, []), m).collect() == []


def best_segments(s):
    """All maximal scoring segments by their recursive definition."""
    def rec(a, z):
        best = None
        for i in range(a, z):
            t = 0.0
            for j in range(i, z):
                t += s[j]
                if t > 1e-12 and (best is None or t > best[0] + 1e-12):
                    best = (t, i, j + 1)
        if best is None:
            return []
        return [*rec(a, best[1]), best[1:], *rec(best[2], z)]
    return rec(0, len(s))


def test_segments_equal_brute_force():
    rng = random.Random(8)
    for _ in range(400):
        s = np.array([rng.choice([-3, -2, -1, 1, 2, 3]) + rng.random() * 0.1 for _ in range(rng.randint(0, 14))])
        assert [(a, z) for a, z, _ in toxicity.segments(s)] == best_segments(s)


def toxic_fixture(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(3))
    vocab = [word() for _ in range(300)]
    rows, marks = [], []
    for i in range(400):
        w = [rng.choice(vocab) for _ in range(rng.randint(20, 200))]
        bad = i % 5 == 0
        for _ in range(3 if bad else 0):
            w.insert(rng.randint(0, len(w)), "vile" + rng.choice(vocab))
        rows.append((i, " ".join(w)))
        marks.append((i, int(bad)))
    return rows, marks


def test_unseen_spellings_of_a_family_are_scored(spark):
    rows, marks = toxic_fixture(spark)
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    d = docs(spark, rows, best="clash")
    m = toxicity.train(d, labels.where("doc_id % 3 <> 1"))
    got = {r["doc_id"]: r["toxicity"] for r in toxicity.score_toxicity(d, m).collect()}
    held = [(i, y) for i, y in marks if i % 3 == 1]
    assert np.mean([(got[i]["score"] >= toxicity.THRESHOLD) == bool(y) for i, y in held]) >= 0.97
    text = dict(rows)
    for i, y in held:  # passages hold the planted words
        words = text[i].split()
        for p in got[i]["passages"]:
            assert any(w.startswith("vile") for w in words[p["first"]:p["end"]]) or not y
    edge = toxicity.score_toxicity(docs(spark, [(1, None), (2, ""), (3, "x" * 100_000), (4, "!"), (4, "!"), (None, "a")]), m)
    scores = [r["toxicity"]["score"] for r in edge.collect()]
    assert len(scores) == 6 and all(0 <= s < toxicity.THRESHOLD for s in scores)


def test_toxicity_without_labels(spark):
    d = docs(spark, [(1, "some text"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, toxic int")
    assert toxicity.train(d, none) is None and toxicity.train(d, one) is None
    assert [r["toxicity"]["score"] for r in toxicity.score_toxicity(d, None).collect()] == [0.0, 0.0]


def test_toxicity_query(spark):
    rows = queries.op2_toxicity(spark, SF).collect()
    assert len(rows) == 1000 and all(r["predicted"] == int(r["score"] >= 0.7) for r in rows)


ARTICLE = "<article><h1>A title</h1><p>First &amp; <b>bold</b>\n  text.<br>Same block.</p><p>Second&nbsp;one</p></article>"
PAGES = {
    ARTICLE: "A title\n\nFirst & bold text. Same block.\n\nSecond one",
    None: "", "": "", "<html></html>": "", "plain text, a<b & c": "plain text, a<b & c", "<p>x": "x",
    "<nav><a>Home</a></nav><header>H</header>" + ARTICLE + "<aside>S</aside><footer>F</footer>":
        "A title\n\nFirst & bold text. Same block.\n\nSecond one",
    "<article><p>Text one</p><div class='ad'>Buy</div><script>var t='</p><p>no';</script><!-- <p>no</p> --><p>Text two</p>"
    "<section class=\"comments\"><article class='comment'><p>First!</p></article></section></article>": "Text one\n\nText two",
    "<main><p>In main</p><form><label>Name</label></form></main><p>outside</p>": "In main",
    "<body class='has-sidebar'><div id=ad-wrapper><article><p>Kept in spite of the wrapper</p></article></div></body>":
        "Kept in spite of the wrapper",
    "<article><p>one<p>two<ul><li>three<li>four</ul>five</article>": "one\n\ntwo\n\nthree\n\nfour\n\nfive",
    "<article><p style='display:none'>hidden</p><p hidden>h</p><p>&#65;&#x42;&copy;&lt;p&gt;</p></article>": "AB©<p>",
    "<article><p>a</p><img alt='x > y' src=z><p>b</p>": "a\n\nb",
}


def test_pages(spark):
    for html, text in PAGES.items():
        assert htmltext.main_text(html) == text, html
    rows = [(i, "u", h) for i, h in enumerate(PAGES)]
    out = htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")))
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert got == {i: (t, len(t)) for i, t in enumerate(PAGES.values())}
    assert htmltext.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_surge_and_dive_without_semantic_markup():
    para = "A paragraph of running text that is long enough to lift the window over the surge threshold of the page."
    menu = "".join(f"<div><a href=/{i}>Section {i}</a></div>" for i in range(12))
    html = f"<body>{menu}<div>{para}</div><div>Short one.</div><div>{para}</div>{menu}<div>Imprint</div></body>"
    assert htmltext.main_text(html) == f"{para}\n\nShort one.\n\n{para}"


STORY = "A long story told in a plain element, with as many words as a page needs to pass the surge threshold. " * 3


def test_article_elements_weigh_lines_and_bound_stretches():
    story = STORY.strip()
    teaser = "<article><h3>Teaser</h3><p>Two words.</p></article>"
    # An article of any size takes nothing from the text around it.
    assert htmltext.main_text(f"<div>{story}</div><div>{teaser}</div>") == f"{story}\n\nTeaser\n\nTwo words."
    assert htmltext.main_text(f"{ARTICLE}<div>Imprint</div><article><p>{story}</p></article>") == (
        f"A title\n\nFirst & bold text. Same block.\n\nSecond one\n\n{story}")
    # Its weight lifts no line outside; those mostly of links are link lists beside another.
    assert htmltext.main_text(f"<div>Welcome</div>{ARTICLE}<div>Imprint</div>") == htmltext.main_text(ARTICLE)
    links = "<article><h3><a href=/1>Another story</a></h3><p>More</p></article>"
    assert htmltext.main_text(ARTICLE + links * 3) == htmltext.main_text(ARTICLE)
    assert htmltext.main_text(links) == "Another story\n\nMore"
    # Lines of a main element beside its article.
    assert htmltext.main_text("<main><h1>Title</h1><article><p>Short.</p></article></main><p>out</p>") == "Title\n\nShort."
    assert htmltext.main_text(f"<main><p>In main</p></main><div>{teaser}</div>") == "In main\n\nTeaser\n\nTwo words."


INSERTS = ["<div class=ad>Buy</div>", "<div class='cookie-notice'>We use</div>", "<aside>Aside</aside>", "<form>Mail</form>",
           "<div role=alert>Alert</div>", "<div class=newsletter><div class=menu>Join</div></div>"]


@pytest.mark.parametrize("insert", INSERTS)
def test_inserts_between_sections_of_plain_pages(insert):
    long, middle, short = STORY.strip() * 7, STORY.strip()[:300], "A closing line."
    parts = [short, long, short, middle, short]
    html = "<body><nav>Menu</nav><div>" + long + "</div>" + insert + insert.join(f"<div>{x}</div>" for x in parts)
    assert htmltext.main_text(html + "</body>") == "\n\n".join([long, *(p.strip() for p in parts)])


def test_stretches_are_judged_by_their_own_lines():
    long, middle = STORY.strip() * 7, STORY.strip()[:300].strip()
    menu = "".join(f"<div><a href=/{i}>Section {i}</a></div>" for i in range(12))
    for cut in (menu, "<nav>Contents</nav>", "<div class=site-header>Site</div>"):
        # No share of the longest stretch is asked for; the page's frame still ends one.
        assert htmltext.main_text(f"<div>{long}</div>{cut}<div>{middle}</div>") == f"{long}\n\n{middle}"
        assert htmltext.main_text(f"<div>{long}</div>{cut}<div>Imprint</div>") == long
    # Headers and menus of a section are not the page's.
    sections = "".join(f"<section><header><h2>Head</h2></header><p>{x}</p></section>" for x in (long, "Short one.", middle))
    assert htmltext.main_text(sections) == f"{long}\n\nShort one.\n\n{middle}"


def test_long_pages_stay_linear():
    html = "<article>" + "<p>word</p>" * 30_000 + "<" * 20_000 + "</article>"
    assert htmltext.main_text(html).startswith("word\n\nword")
    assert htmltext.main_text("<div>" * 20_000 + "deep") == "deep"


def test_whole_table_of_pages(spark):
    import html as h
    import re
    for r, p in zip(queries.op3_html_text(spark, SF).orderBy("page_id").collect(),
                    spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").collect()):
        body = re.search("<article>(.*?)</article>", p["html"], re.S)[1]
        blocks = [" ".join(h.unescape(re.sub("</?b>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", body)]
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_segment_scan_is_linear():
    import time
    spent = []
    for n in (20_000, 80_000):
        start = time.process_time()
        toxicity.segments(np.tile([1.0, -2.0], n // 2))
        toxicity.segments(np.where(np.random.default_rng(0).random(n) < .2, 1.0, -0.5))
        spent.append(time.process_time() - start)
    assert spent[1] < 1 and spent[1] < 10 * spent[0] + 0.2


@pytest.mark.parametrize("page", [
    "<div class='wrapper with-sidebar'><p>{}</p></div>", "<div id=content class=no-sidebar>{}</div>",
    "<div class=promo-page><div class=menu>Menu</div><p>{}</p></div>", "<body><section class=alert>{}</section><div class=ad>Buy</div>",
    "<div>{}</div><div class=comments>" + STORY * 5 + "</div>", "<article><p>{}</p><section class=comments>" + STORY * 5 + "</section></article>",
    "<article><p>{}</p><p class=ad>Buy</p><figure class=ad-unit>Buy</figure><div class=related-posts>More</div></article>"])
def test_class_words_are_evidence_only(page):
    assert htmltext.main_text(page.format(STORY)) == STORY.strip()


def test_other_names_with_a_class_word():
    html = ("<article><p>{}</p><p class='share-price'>It rose.</p><section class='discussion'><p>We find this.</p>"
            "<div class=comment>First!</div></section><figure class='ad-astra'>To the stars.</figure></article>")
    assert htmltext.main_text(html.format(STORY)) == f"{STORY.strip()}\n\nIt rose.\n\nWe find this.\n\nTo the stars."


def test_unclosed_tags():
    assert htmltext.main_text("<p>if a<b and c <p>then d") == "if a<b and c\n\nthen d"
    assert htmltext.main_text("<p>one <b title='x' <i>two</i></b> three</p>") == "one two three"
    assert htmltext.main_text("<p title=it's>one</p><p>it's two") == "one\n\nit's two"


def test_bad_markup_stays_linear():
    import time
    for piece, tail in (("<a ", ""), ("<div><main>", ""), ("<div>x", "</p>"), ('<a x="<a"', ""), ("<a x='<b y=\"", ""),
                        ("<div class=ad>x", "</p>"), ("<script ", ""), ("<!--", ""), ("<a x= ", "")):
        start = time.process_time()
        htmltext.main_text(piece * 100_000 + tail * 100_000)
        assert time.process_time() - start < 6, piece


def windows_by_brute_force(lines):
    """Kept texts of (text, is link list, is frame) lines: every window summed, every stretch from surge to dive."""
    cells = []
    for text, linked, frame in lines:
        cells += [(0, "")] * htmltext.WINDOW if frame else [(0 if linked else len(text), text)]
    def window(i):
        return sum(n for n, _ in cells[i:i + htmltext.WINDOW])

    def kept(threshold):
        # A line stays if some surge at or before it has no dive between them.
        return [text for i, (n, text) in enumerate(cells) if n and any(
            cells[a][0] and window(a) > threshold and all(window(j) for j in range(a, i + 1)) for a in range(i + 1))]
    return kept(htmltext.SURGE) or kept(0)


def test_windows_equal_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        lines = [(f"{i} " + "w" * rng.choice([1, 5, 20, 30, 60, 100]), rng.random() < .3, rng.random() < .15) for i in range(rng.randint(0, 25))]
        html = "".join("<nav>Menu</nav>" if f else f"<div><a href=x>{t}</a></div>" if k else f"<div>{t}</div>" for t, k, f in lines)
        assert htmltext.main_text(html) == "\n\n".join(windows_by_brute_force(lines)), html
