import html
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelwise.llm import html_wrapper, impact_search
from panelwise.llm.queries import QUERIES, SQL
from tests.check_sql import compare, connect
from tests.llm import brute


def vectors(spark, rows):
    return impact_search.quantise(spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int").repartition(3), "vec_id", "embedding")


def best(rows, k):
    usable = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (q, a) in enumerate(usable):
        if q % 20 == 0:
            others = sorted((-sum(x * y for x, y in zip(a, b)), i) for m, (i, b) in enumerate(usable) if m != n)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(others[:k])]
    return sorted(out)


@pytest.mark.parametrize("scale", [0.3, 0.02, 40000.0])
def test_search_is_exact(spark, monkeypatch, scale):
    monkeypatch.setattr(impact_search, "BLOCK_ROWS", 64)
    rnd = random.Random(8)
    rows = [(i % 280, [rnd.gauss(0, scale) for _ in range(12)], 1) for i in range(300)]
    rows += [(40, None, 1), (60, [1.0, None], 1), (80, [float("nan")] * 12, 1), (100, [float("inf")] * 12, 1), (None, [1.0] * 12, 1), (120, [], 1), (140, [0.5], 1)]
    got = impact_search.top_k(vectors(spark, rows), F.col("vec_id") % 20 == 0, 5).collect()
    assert sorted(tuple(r) for r in got) == best(rows, 5)


def test_search_of_few_and_no_vectors(spark):
    rows = [(0, [0.1, 0.2], 1), (1, [0.3, 0.1], 1)]
    assert [tuple(r) for r in impact_search.top_k(vectors(spark, rows), F.col("vec_id") % 20 == 0, 20).collect()] == [(0, 1, 1, 6 * 19 + 12 * 6)]
    assert impact_search.top_k(vectors(spark, []), F.col("vec_id") % 20 == 0, 20).count() == 0


def test_search_stops_before_the_last_segment():
    x = np.zeros((300, 4), dtype=np.int64)
    x[:, 3] = 1
    x[:20, 0] = 40
    rows = [{"segment": s} for s in range(4)]
    for s, lower in enumerate(impact_search.IMPACTS):
        held = (np.abs(x) >= lower) & ((np.abs(x) < impact_search.IMPACTS[s - 1]) if s else True)
        where, who = np.nonzero(held.T)
        rows[s] |= {"rows": np.arange(300).tobytes(), "ids": np.arange(300).tobytes(), "width": 4, "starts": np.searchsorted(where, np.arange(5)).tobytes(), "postings": who.astype(np.int32).tobytes(), "values": x.T[held.T].tobytes(), "rest": (np.where(np.abs(x) < lower, x, 0).astype(float) ** 2).sum(axis=1).tobytes()}
    rows[3]["starts"] = rows[3]["starts"]
    (found,) = impact_search.search_block(rows, np.array([[10, 0, 0, 1]]), np.array([-1]), 10)
    assert found[1].tolist() == list(range(10)) and set(found[2].tolist()) == {401}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, small, name):
    assert compare(spark, connect(small), name, QUERIES[name], SQL[name], small) == ""


# --- pages -----------------------------------------------------------------------------------------------------------


def tree(label, *kids):
    return [label, 1, list(kids)]


def test_tree_matching_keeps_order():
    a = tree("r", tree("x"), tree("y", tree("z")), tree("w"))
    b = tree("r", tree("y", tree("z")), tree("x"), tree("w"))
    weight = lambda x, y: html_wrapper.Matching().weight(x, y)
    assert weight(a, a) == 5 and weight(a, b) == 4 and weight(a, tree("q")) == 0
    merged = html_wrapper.merge(a, b)
    assert merged[1] == 2 and [k[0] for k in merged[2]].count("y") == 1 and [k[0] for k in merged[2]].count("x") == 2
    assert html_wrapper.read_tree(html_wrapper.write_tree(merged)) == merged


def plain_weight(a, b):
    if a[0] != b[0]:
        return 0
    best = [[0] * (len(b[2]) + 1) for _ in range(len(a[2]) + 1)]
    for i, x in enumerate(a[2]):
        for j, y in enumerate(b[2]):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + plain_weight(x, y))
    return 1 + best[-1][-1]


def test_weights_are_those_of_plain_matching():
    rnd = random.Random(6)

    def grow(depth):
        kids = [grow(depth - 1) for _ in range(rnd.randrange(4))] if depth else []
        return tree(rnd.choice("ab"), *kids)

    for _ in range(200):
        a, b = grow(3), grow(3)
        assert html_wrapper.Matching().weight(a, b) == plain_weight(a, b)
        if a[0] == b[0]:
            count = lambda t: 1 + sum(map(count, t[2]))
            assert count(html_wrapper.merge(a, b)) == count(a) + count(b) - plain_weight(a, b)


def test_wrapper_of_changing_names_is_bounded():
    rnd, wrapper = random.Random(1), None
    for _ in range(300):
        names = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(20)]
        page_ = html_wrapper.flat_shape(html_wrapper.Page("".join(f'<div id="{n}"><p>t</p></div>' for n in names)).root)
        wrapper = html_wrapper.read_tree(page_) if wrapper is None else html_wrapper.merge(wrapper, html_wrapper.read_tree(page_))
    assert len(wrapper[2]) <= html_wrapper.KINDS and len(html_wrapper.write_tree(wrapper)) < 5000


def page(body, extra=""):
    return f'<!DOCTYPE html><html><head><title>T</title><script>var a = "</p><p>no";</script></head><body><nav><a href=1>Home</a></nav><div class="cookie-notice">We use</div>{extra}<article><h1>Title</h1>{body}</article><aside>More</aside><footer>&copy; x</footer>'


def test_main_text_of_odd_pages(spark):
    rows = [
        (1, "http://a.example/1", page("<p>One &amp; <b>tw</b>o<br>three<!-- no --> </p>\n<p>four")),
        (2, None, None),
        (3, "nonsense", ""),
        (4, "http://a.example/4", "plain &lt;text&gt; a < b"),
        (5, "http://a.example/5", "<div>only div</div><div class='comments'>nice</div><form>send</form><p>para <i>x</i>y"),
        (6, "http://a.example/6", page("<ul><li>l1<li>l2</ul><div class=ad>buy</div><p>end&am")),
        (7, "http://b.example/", "<p>" + "long " * 20000),
        (7, "http://b.example/", "<p>" + "long " * 20000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("main_text", F.lit(1)).withColumn("host", F.lit("clash"))
    got = {r.page_id: r for r in html_wrapper.main_text(pages).collect()}
    assert got[1].main_text == "Title One & two three four" and got[1].host == "clash"
    assert got[2].main_text == got[3].main_text == "" and got[4].main_text == "plain <text> a < b"
    assert got[5].main_text == "only div para xy" and got[6].main_text == "Title l1 l2 end&am"
    assert got[7].main_text == "long " * 19999 + "long" and html_wrapper.main_text(pages).count() == 8
    assert html_wrapper.main_text(pages.where("false")).count() == 0


def test_constant_texts_are_template_and_copies_are_kept(spark):
    rows = [(i, f"http://c.example/{i}", page(f"<p>Body number {i} of the site</p><div><p>Subscribe now</p></div>")) for i in range(30)]
    rows += [(100 + i, f"http://d.example/{i}", page("<p>The same article</p>")) for i in range(15)]
    got = {r.page_id: r.main_text for r in html_wrapper.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    # Constant headings and paragraphs next to those that vary belong to the article; what an element of its own holds does not.
    assert all(got[i] == f"Title Body number {i} of the site" for i in range(30))
    assert all(got[100 + i] == "Title The same article" for i in range(15))


def texts_of(spark, rows):
    return {r.page_id: r.main_text for r in html_wrapper.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}


def test_near_copies_are_kept_whole(spark):
    parts = [f"Paragraph {k} of the one article that all mirrors carry" for k in range(6)]
    write = lambda x: page("".join(f"<p>{t}</p>" for t in x))
    near = {28: [*parts, "One added line"], 29: [*parts[:3], "A changed paragraph", *parts[4:]]}
    rows = [(i, f"http://e.example/{i}", write(near.get(i, parts))) for i in range(30)]
    each = {100 + i: [*parts[:i % 6], f"Changed by mirror {i}", *parts[i % 6 + 1 :], f"Added by mirror {i}"] for i in range(20)}
    rows += [(i, f"http://f.example/{i}", write(x)) for i, x in each.items()]
    rows += [(200 + i, f"http://g.example/{i}", page(f"<p>Text {min(i, 12)} that differs from the others here</p><div>Subscribe now</div>")) for i in range(60)]
    got = texts_of(spark, rows)
    assert all(got[i] == " ".join(["Title", *near.get(i, parts)]) for i in range(30))
    assert all(got[i] == " ".join(["Title", *x]) for i, x in each.items())
    assert all(got[200 + i] == f"Title Text {min(i, 12)} that differs from the others here" for i in range(60))


def test_names_of_pages_and_articles_drop_nothing(spark):
    text = "<p>The text</p>"
    bodies = [
        f'<body class="has-sidebar">{text}</body>',
        f'<article class="post no-comments">{text}</article>',
        f'<main id="search-result-page">{text}</main>',
        f'<body><div class="header-fixed">{text}</div></body>',
        f'<div class="sidebar share"><article class="comments">{text}</article></div>',
        f'<body class="widget"><div class="promo">{text}</div></body>',
        f'<article>{text}<div class="site-footer">end</div><div class="related">more</div><p id="comments">nice</p></article>',
        f'<article>{text} <span class="ad">buy</span></article>',
    ]
    assert set(texts_of(spark, [(i, f"http://h{i}.example/", x) for i, x in enumerate(bodies)]).values()) == {"The text"}


def test_constant_texts_of_small_hosts_are_template(spark):
    plain = lambda h, i: f"<body><div>Home News Contact</div><div><p>Story {i} of {h}, told at some length and unlike others</p></div><div><em>All rights</em></div></body>"
    rows = [(10 * n + i, f"http://s{n}.example/{i}", plain(n, i)) for n in (1, 2, 3, 9) for i in range(n)]
    rows += [(200 + i, f"http://t.example/{i}", page(f"<p>Story {i} of another place, told at length</p><div>Subscribe now</div>")) for i in range(3)]
    got = texts_of(spark, rows)
    assert got.pop(10) == "Home News Contact Story 0 of 1, told at some length and unlike others All rights"
    assert all(got[10 * n + i] == f"Story {i} of {n}, told at some length and unlike others" for n in (2, 3, 9) for i in range(n))
    assert all(got[200 + i] == f"Title Story {i} of another place, told at length" for i in range(3))


def test_any_depth_of_nesting(spark):
    rows = [(i, f"http://deep.example/{i}", "<div>" * 100_000 + f"text {i}" + "</span></p></div>" * 3) for i in range(3)]
    rows += [(10, "http://deep.example/10", "<b>" * 2000 + "<p>".join(["x"] * 20)), (11, "http://e.example/", "</div>" * 100_000 + "y")]
    got = texts_of(spark, rows)
    assert [got[i] for i in range(3)] == ["text 0", "text 1", "text 2"] and got[10] == " ".join(["x"] * 20) and got[11] == "y"


def test_headings_of_articles_stay(spark):
    recipe = lambda i: f"<article><header><h1>Recipe {i}</h1><p>by us</p></header><section><h2>Ingredients</h2><ul><li>salt</li><li>item {i}</li></ul></section><h2>Method</h2><p>Do thing {i}</p><div class='share-bar'><p>Tell your friends</p></div></article><footer>end</footer>"
    got = texts_of(spark, [(i, f"http://r.example/{i}", recipe(i)) for i in range(5)])
    assert all(got[i] == f"Recipe {i} Ingredients salt item {i} Method Do thing {i}" for i in range(5))


def test_reader_comments_go(spark):
    text = "<p>The text</p>"
    bodies = [
        f'<article>{text}</article><article class="comment"><p>nice</p></article>',
        f'<article>{text}<div class="user-comments-list"><p>nice</p></div></article>',
        f'<article>{text}<div class="comment-body">nice</div><ol id="commentlist"><li>so</li></ol></article>',
        f'<body class="comments-open"><article class="post comments-enabled">{text}<div id="disqus_thread">nice</div></article>',
    ]
    assert set(texts_of(spark, [(i, f"http://k{i}.example/", x) for i, x in enumerate(bodies)]).values()) == {"The text"}


def test_plain_menus_go_from_short_pages(spark):
    menu = "<div>" + " ".join(f"Entry{k}" for k in range(60)) + "</div>"
    listed = "<div><ul>" + "".join(f"<li><a href=/{k}>Part {k}</a></li>" for k in range(30)) + "</ul></div>"
    rows = [(i, f"http://m.example/{i}", f"<body>{menu}{listed}<div><h2>News</h2><p>Short story {i}</p></div></body>") for i in range(10)]
    got = texts_of(spark, rows)
    assert all(got[i] == f"News Short story {i}" for i in range(10))


def test_a_teaser_article_hides_no_main_text(spark):
    long = "A main text of many words that no article element holds, only divisions. " * 5
    got = texts_of(spark, [(0, "http://t.example/", f"<body><div><p>{long}</p></div><article><p>Read also this</p></article></body>")])
    assert " ".join(long.split()) in got[0]


def test_many_hosts_make_few_files(spark, monkeypatch):
    html = "<html><body><p>Same words of all.</p><div><article><p>{}</p></article></div></body></html>"
    pages = spark.createDataFrame([(f"http://h{h}.example/{k}", html.format(f"page {h} {k} tells.")) for h in range(120) for k in range(2)], "url string, html string")
    want = sorted(map(tuple, html_wrapper.main_text(pages).collect()))
    files = {}

    def counting(df, name, real=html_wrapper.store):
        out = real(df, name)
        files[name] = len(out.inputFiles())
        return out

    monkeypatch.setattr(html_wrapper, "store", counting)
    many = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in many}
    try:
        for k, v in many.items():
            spark.conf.set(k, v)
        got = sorted(map(tuple, html_wrapper.main_text(pages).collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == want and all(r[2].endswith(" tells.") for r in got)
    assert max(files.values()) <= 16, files


def test_pages_of_the_table(spark, small):
    raw = {r.page_id: r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    for r in QUERIES["op5_wrapper_induction_text"](spark, small).collect():
        article = re.search(r"<article>(.*?)(</article>|$)", raw[r.page_id], re.S)[1]
        parts = re.split(r"</?p>|</?h1>", re.sub(r"</?b>", "", article.replace("<br>", " ")))
        assert r.text == " ".join(" ".join(html.unescape(x) for x in parts).split()) and r.n_chars == len(r.text)


# --- pipeline --------------------------------------------------------------------------------------------------------


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language ID", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "SentencePiece encoding and decoding"]
    kept = stages["n-gram Jaccard join"](spark, docs, small)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for (i, _), (_, c) in zip(rows, brute.classes(rows, 5, 80)) if i == c) and kept.columns == docs.columns
    items = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    flat = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    leaked = {i for i, t in rows if any(flat(x) in flat(t) for x in items)}
    clean = stages["benchmark decontamination"](spark, docs, small)
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in rows} - leaked and leaked
    assert stages["language ID"](spark, docs, small).count() == len(rows)


def test_stages_of_odd_rows(spark, small):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "the same words here again", "en", None, 1), (3, "the same words here again", "en", "s", 1), (3, "the same words here again", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), small).count() == 0
        if name == "n-gram Jaccard join":
            assert stage(spark, docs, small).count() == 4  # three without words and one of the group
        else:
            stage(spark, docs, small).collect()
    assert corpus_pipeline.run(spark, small).count() > 100
