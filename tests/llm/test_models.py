"""Extraction, rules, classifiers, host reputation and the pipeline: brute force, known answers and held-out accuracy."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from awkward_rows import awkward

import corpus_pipeline
from pyspark.sql import functions as F
from terraquilt.llm import byte_cnn, host_reputation, html_blocks, quality_rules, toxicity
from terraquilt.llm.html_examples import EXAMPLES
from terraquilt.llm.queries import URL_RULES

SF = "/root/testdata/sf0.01"


def tables(spark, *names):
    return [spark.read.parquet(f"{SF}/{n}.parquet") for n in names]


# ---------------------------------------------------------------- html

def text_of(page):
    return html_blocks.main_text(page, html_blocks.trained_tree())


def test_tree_knows_its_table():
    wrong = [b for page, kept in EXAMPLES for b in text_of(page).split("\n") if b and b not in kept]
    lost = [b for page, kept in EXAMPLES for b in kept if b not in text_of(page).split("\n")]
    assert len(wrong) + len(lost) <= 1


@pytest.mark.parametrize("page, text", [
    ("", ""),
    ("<article><p>a &amp;amp; b&nbsp;&#233;\n\t c<br>d</p></article>", "a &amp; b é c d"),
    ("<body><nav>x</nav><article><h1>T</h1><p>One <b>bold<p>Two<p>Three</article><footer>f</footer>", "T\nOne bold\nTwo\nThree"),
    ("<article><p title='a > b'>in</p><script>if (a</p>b) {}</script><style>p{}</style><!-- no <p>x</p> --></article>", "in"),
    ("<article><p>kept</p><!-- never closed <p>x</p>", "kept"),
    ("<article><p>kept</p><script>never closed", "kept"),
    ("<article><p>a<p>b</div></span></p>c</article>", "a\nb\nc"),
    ("<main><div class='cookie-banner'>We use cookies</div><p>Text</p><form><p>Mail</p></form></main>", "Text"),
    ("<article><p>Text here</p></article><section id=comments><article><p>I say</p></article></section>", "Text here"),
    ("<article><p>a < b and c</p></article>", "a < b and c"),
])
def test_main_text(page, text):
    assert text_of(page) == text


@pytest.mark.parametrize("opens, closes", [
    ('<div class="layout has-sidebar"><article>', "</article></div>"), ('<main id="search-results">', "</main>"),
    ('<div class="ad-free"><article>', "</article></div>"), ('<article class="review">', "</article>"),
    ('<article class="post no-comments">', "</article>"), ('<form id="aspnet"><article>', "</article></form>"),
    ('<main><h1>Bridge</h1><div class="widget-popup"><article>', "</article></div></main>"),
])
def test_marks_around_the_main_element_do_not_lose_it(opens, closes):
    prose = "The river had been rising since the early morning and by noon the road was closed."
    page = f"""<body><nav>Start</nav>{opens}<p>{prose}</p><div class="ad">Shoes</div><p>So it was.</p>{closes}
        <section class="comments"><article><p>I say so too.</p></article></section></body>"""
    assert text_of(page).split("\n")[-2:] == [prose, "So it was."]
    assert "Shoes" not in text_of(page) and "I say" not in text_of(page)


@pytest.mark.parametrize("part", ["comments", "related"])
def test_comments_and_cards_in_articles_are_no_main_element(part):
    prose = [f"On day {i} the river had been rising since the early morning and by noon the road was closed." for i in range(3)]
    page = f"""<body><nav>Start</nav><p>{prose[0]}</p><div>{prose[1]}</div><p>{prose[2]}</p>
        <section class="{part}"><article><p>I say so too, and have said so for years.</p></article></section></body>"""
    assert text_of(page).split("\n") == prose


def test_pages_are_extracted_whole(spark):
    pages, = tables(spark, "pages")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in html_blocks.extract_main_text(pages).collect():
        inner = re.search("<article>(.*?)</article>", source[r.page_id], re.S)[1]
        blocks = [" ".join(html_blocks.html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_awkward_pages(spark):
    long = "<article>" + "<p>" * 20_000 + "x " * 100_000 + "</article>"
    rows = [(1, None, None, "a"), (2, "u", "", "b"), (2, "u", "<p>Only this one line here.</p>", "b"), (None, "u", long, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(html_blocks.extract_main_text(pages).collect(), key=str)
    assert Counter(r.text for r in got) == Counter(["", "", "Only this one line here.", ("x " * 100_000).strip()])
    assert html_blocks.extract_main_text(pages.limit(0)).count() == 0


# ---------------------------------------------------------------- quality rules

def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = text.split("\n")
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    repeated = {i + k for found in windows.values() if len(found) > 1 for i in found for k in range(8)}
    dups = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines))
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(repeated)]


def test_statistics_match_plain_counting(spark):
    docs, = tables(spark, "documents")
    texts = [r.text for r in docs.limit(150).collect()]
    texts += ["", "a", "x " * 9, "é\u3000ü\x85z\x1cq", "a\n\na\n a\na", "\n".join(["one two three four"] * 5), "A1 b2 #*$%&|<>"]
    for t in texts:
        assert quality_rules.statistics(t)[:5] == plain_statistics(t)


def test_rules_keep_clean_documents(spark):
    docs, labels = tables(spark, "documents", "labels")
    got = {r.doc_id: r for r in quality_rules.judge_quality(docs, labels).collect()}
    assert len(got) == docs.count()
    for r in got.values():
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
    marked = [(got[r.doc_id], r.quality) for r in labels.collect() if not got[r.doc_id].base_failed]
    assert sum(not r.kept for r, q in marked if q == 1) <= 0.01 * len(marked)
    bad = [r.kept for r, q in marked if q == 0]
    assert sum(bad) <= 0.2 * len(bad)
    kept = quality_rules.keep_good(docs, labels)
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, r in got.items() if r.kept}


def test_threshold_rejects_nothing_where_nothing_is_gained():
    assert quality_rules.pick_threshold(np.array([5, 5]), np.array([5, 5]), 0.005, 20.0) == 1.0
    assert quality_rules.pick_threshold(np.array([9, 0, 0, 0]), np.array([0, 0, 0, 9]), 0.005, 20.0) == 0.75


def test_rules_on_awkward_rows(spark):
    labels = spark.createDataFrame([(8, 1, 0), (9, None, None), (None, 1, 1), (1, 0, 0)], "doc_id long, quality int, toxic int")
    for marks in (labels, labels.limit(0)):
        got = quality_rules.judge_quality(awkward(spark), marks).collect()
        assert len(got) == 13 and {r.doc_id for r in got if r.kept} == {8, 9}
        kept = quality_rules.keep_good(awkward(spark), marks)
        assert kept.columns == awkward(spark).columns and kept.count() == 2
    assert quality_rules.judge_quality(awkward(spark).limit(0), labels).count() == 0


# ---------------------------------------------------------------- classifiers

def test_network_on_held_out_labels(spark):
    docs, labels = tables(spark, "documents", "labels")
    learn = byte_cnn.training_fold("doc_id", 3, 1)
    net = byte_cnn.fit_quality(docs, labels, learn, steps=500)
    scores = {r.doc_id: r.score for r in byte_cnn.add_quality(docs, net).collect()}
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores.values())
    held = [r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([(scores[r.doc_id] >= 0.5) == r.quality for r in held]) > 0.93
    text = "The whole text counts. " * 50_000
    assert net.scores([text], block=1 << 12)[0] == pytest.approx(net.scores([text])[0])


def test_toxicity_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    learn = byte_cnn.training_fold("doc_id", 4, 2)
    model = toxicity.fit_toxicity(docs, labels, learn)
    held = [r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    scores = {r.doc_id: r.score for r in toxicity.add_toxicity(docs, model).collect()}
    caught = [scores[r.doc_id] >= 0.3 for r in held if r.toxic]
    wrong = [scores[r.doc_id] >= 0.3 for r in held if not r.toxic]
    assert np.mean(caught) > 0.9 and np.mean(wrong) < 0.02
    assert model.scores(["You are such an id1ot, you m.o.r.o.n and scum!"])[0] > model.scores(["A fine day by the sea."])[0]


def test_isotonic_rises_and_keeps_the_mean():
    rng = np.random.default_rng(1)
    margin = rng.normal(size=500)
    y = (rng.random(500) < 1 / (1 + np.exp(-2 * margin))).astype(float)
    x, p = toxicity.isotonic(margin, y)
    assert (np.diff(x) >= 0).all() and (np.diff(p) >= 0).all()
    assert np.interp(margin, x, p).mean() == pytest.approx(y.mean(), abs=0.03)


@pytest.mark.parametrize("labelled", [[], [(8, 1, 0), (None, 1, 1), (1, 1, None)], [(8, 1, 0), (9, 0, 1), (10, 0, 1)]])
def test_classifiers_on_awkward_rows(spark, labelled):
    docs = awkward(spark)
    labels = spark.createDataFrame(labelled, "doc_id long, quality int, toxic int")
    net = byte_cnn.fit_quality(docs, labels, steps=5)
    model = toxicity.fit_toxicity(docs, labels)
    for got in (byte_cnn.add_quality(docs, net), toxicity.add_toxicity(docs, model)):
        rows = got.collect()
        assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())
        assert all(0 <= r.score <= 1 for r in rows)
        by = {r.doc_id: r.score for r in rows}
        assert by[1] == by[2] and by[4] == by[5]
    assert byte_cnn.keep_quality(docs, net).columns == docs.columns
    assert byte_cnn.add_quality(docs.limit(0), net).count() == 0


# ---------------------------------------------------------------- urls

@pytest.mark.parametrize("url, host, path, rule, verdict", [
    (None, "", "", None, None), ("no scheme", "", "", None, None), ("x://", "", "", None, None),
    ("http://A.Example.NET/en/1?x=/q#f", "a.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://a.example.net/de/1", "a.example.net", "/de/1", "net/", "block"),
    ("http://example.net?u=http://b.org/fr/", "example.net", "", None, None),
    ("http://notexample.com/de/", "notexample.com", "/de/", None, None),
    ("//x://example.com/de/a", "example.com", "/de/a", "example.com/de/", "block"),
    ("http://q.org/fr/#x", "q.org", "/fr/", "org/fr/", "allow"), ("http://q.org/fr", "q.org", "/fr", None, None),
    ("http://ÄB.COM/x", "Äb.com", "/x", None, None),
])
def test_urls_and_rules(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url)], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad int")
    r = host_reputation.judge_urls(pages, none, URL_RULES).first()
    assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or "allow")


def posteriors(pages):
    """host -> posterior mean and lower bound, level by level."""
    def site(h):
        return re.sub(":[0-9]*$", "", h.rsplit("@", 1)[-1])

    def address(h):
        return h.startswith("[") or re.fullmatch(r"\d{1,3}(\.\d{1,3}){3}", h)

    def suffix(host):
        h = site(host)
        two = ".".join(h.split(".")[-2:])
        return h if address(h) else two if two in host_reputation.MORE_LABEL_SUFFIXES and h != two else h.split(".")[-1]

    def domain(host):
        h = site(host)
        return h if address(h) else ".".join(h.split(".")[-(len(suffix(h).split(".")) + 1):])

    prior = defaultdict(lambda: (sum(b for _, b in pages if b is not None) + 0.5) / (sum(b is not None for _, b in pages) + 1.0))
    above = lambda h: ""
    for level in (suffix, domain, lambda h: h):
        n, bad = Counter(), Counter()
        for h, b in pages:
            n[level(h)] += b is not None
            bad[level(h)] += b or 0
        groups = [g for g in n if n[g]]
        total = sum(n.values())
        p = sum(bad.values()) / total
        m = total - sum(n[g] ** 2 for g in groups) / total
        rho = ((sum(n[g] * (bad[g] / n[g] - p) ** 2 for g in groups) / (p * (1 - p)) - (len(groups) - 1)) / (m - len(groups) + 1)
               if 0 < p < 1 and m > len(groups) - 1 else 0.001)
        strength = 1 / min(max(rho, 0.001), 0.5) - 1
        ab = {}
        for h, _ in pages:
            q = prior[above(h)]
            ab[level(h)] = (bad[level(h)] + q * strength, n[level(h)] - bad[level(h)] + (1 - q) * strength)
        prior, above = {g: a / (a + b) for g, (a, b) in ab.items()}, level
    return {h: (a / (a + b), a / (a + b) - 1.645 * (a * b / ((a + b) ** 2 * (a + b + 1))) ** 0.5) for h, (a, b) in ab.items()}


def test_posteriors_match_level_by_level(spark):
    rng = np.random.default_rng(2)
    hosts = {f"h{i}.{d}": q for i, (d, q) in enumerate(
        [("good.com", 0.05)] * 6 + [("bad.org", 0.9)] * 6 + [("some.co.uk", 0.5)] * 4 + [("other.org", 0.2)] * 5
    )}
    pages = [(h, int(rng.random() < q)) for h, q in hosts.items() for _ in range(int(rng.integers(1, 60)))]
    pages += [(h, None) for h in list(hosts)[:5]] + [("new.bad.org", None), ("co.uk", 1), ("", 0), ("localhost", 0)]
    for h in ("1.2.3.4", "9.9.3.4", "1.2.3.4:80", "www.good.com:8080", "me@x.bad.org", "a.github.io", "b.github.io", "c.d.com.mx", "[::1]:80"):
        pages += [(h, int(rng.random() < 0.5)) for _ in range(9)]
    df = spark.createDataFrame(pages, "host string, bad int")
    got = {r.host: (r["mean"], r.lower) for r in host_reputation.host_posteriors(df).collect()}
    want = posteriors(pages)
    assert set(got) == set(want)
    for h in want:
        assert got[h] == pytest.approx(want[h])
    assert got["h6.bad.org"][1] > 0.5 > got["h0.good.com"][1]


def test_groups_of_ports_addresses_and_services(spark):
    hosts = ["www.example.com:8080", "u:p@www.example.com", "1.2.3.4:80", "a.b.github.io", "github.io", "x.com.mx", "co.uk", "", "[::1]:8"]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = df.select("host", host_reputation.domain_of(F.col("host")).alias("d"), host_reputation.suffix_of(F.col("host")).alias("s")).collect()
    assert [(r.d, r.s) for r in got] == [
        ("example.com", "com"), ("example.com", "com"), ("1.2.3.4", "1.2.3.4"), ("b.github.io", "github.io"), ("github.io", "io"),
        ("x.com.mx", "com.mx"), ("co.uk", "uk"), ("", ""), ("[::1]", "[::1]"),
    ]
    own = host_reputation.domain_of(F.col("host"), ("a.b.c",))
    assert [r[0] for r in spark.createDataFrame([("x.y.a.b.c",), ("a.b.c",), ("z.b.c",)], "host string").select(own).collect()] == ["y.a.b.c", "b.c", "b.c"]


def test_sample_of_a_hot_labelled_key_is_bounded(spark):
    rows = [(7, f"text {i} {'x' * i}") for i in range(900)] + [(7, "same")] * 900 + [(i, f"d{i}") for i in range(100, 200)] + [(None, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(7, 1)] * 3 + [(i, i % 2) for i in range(100, 200)] + [(i, 1) for i in range(10_000, 12_000)], "doc_id long, quality int")
    found = byte_cnn.labelled_sample(docs, labels, "quality", F.lit(True), 60).collect()
    assert len(found) == 60 and len({r.doc_id for r in found}) == 60  # absent documents take no place
    whole = byte_cnn.labelled_sample(docs, labels, "quality", F.lit(True), 1000).collect()
    assert len(whole) == 101 and sum(r.doc_id == 7 for r in whole) == 1
    again = byte_cnn.labelled_sample(docs.repartition(3), labels, "quality", F.lit(True), 1000).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, again))
    small = byte_cnn.labelled_sample(docs, labels, "quality", F.lit(True), 1000, max_bytes=50).collect()
    assert 0 < sum(len(r["_text"]) for r in small) <= 50


def test_awkward_urls(spark):
    rows = [(1, "http://a.com/en/1", 7), (1, "http://a.com/en/1", 7), (None, "http://b.com/en/99999999999999999999", 8), (3, None, None), (4, "", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host int")
    labels = spark.createDataFrame([(1, 0, None), (1, 1, 1), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    outcomes = host_reputation.outcomes_from_labels(pages, labels)
    assert [tuple(r) for r in outcomes.collect()] == [(1, 1)]
    assert host_reputation.judge_urls(pages, outcomes, URL_RULES).count() == 5
    assert host_reputation.judge_urls(pages.limit(0), outcomes.limit(0), ()).count() == 0


# ---------------------------------------------------------------- pipeline

def test_pipeline_stage_by_stage(spark):
    docs, = tables(spark, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "quality classifier", "near duplicates", "mixing", "packing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.settle(stage(spark, before, SF), "stage")
        assert after.columns == docs.columns
        ids, rest = (Counter(r.doc_id for r in d.select("doc_id").collect()) for d in (before, after))
        assert 0 < len(rest) <= len(ids) and not set(rest) - set(ids)
        assert name == "mixing" or max(rest.values()) == 1
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == set(rest)


def test_pipeline_of_nothing(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


_SAID = [
    "The harbour was closed for two days while divers looked for the missing anchor and its chain of forty metres",
    "People on the quay said that they had never seen the water so clear at this time of the year before",
    "It was found in the end under the old ferry where nobody had thought of looking on the first morning",
    "The owner of the boat thanked all who had helped and asked them to a supper in the hall next Saturday",
]
#: Pages and their main text that the tree has not learnt from.
HELD_OUT = [
    (f"""<body><div><a href="/1">All the news of the week from the coast and its towns</a></div><div>Pictures</div>
     <div><a href="/2">How to tie a knot that holds in any wind and weather</a></div><div>{_SAID[0]}.</div><div>It took long.</div><div>{_SAID[1]}.</div>
     <div>{_SAID[2]}.</div><div>Lucky man.</div><div>{_SAID[3]}.</div><div><a href="/3">More stories about boats and those who love them dearly</a></div>
     <div>Top ten</div><div><a href="/4">The best fish soups of the coast and where to eat them</a></div></body>""",
     [f"{_SAID[0]}.", "It took long.", f"{_SAID[1]}.", f"{_SAID[2]}.", "Lucky man.", f"{_SAID[3]}."]),
    (f"""<body><nav>Home</nav><article class="review"><h1>Anchors</h1><p class="form-of-anchor">{_SAID[0]}.</p><div class="review-text-long">{_SAID[1]}.</div>
     <div class="notice-the-chain"><p>{_SAID[2]}.</p></div><div class="social-links-here"><a href="/f">Like</a> <a href="/g">it</a></div></article>
     <section class="comments"><article><p>{_SAID[3]}, as I said before.</p></article></section></body>""",
     ["Anchors", f"{_SAID[0]}.", f"{_SAID[1]}.", f"{_SAID[2]}."]),
    (f"""<body><div class="share-buttons">Send it now to all of your friends and to those of your neighbours too</div><h1>Chains</h1><p>{_SAID[1]}.</p>
     <p class="promo-code-story">{_SAID[2]}.</p><p>{_SAID[0]}.</p><div class="cookie-banner">{_SAID[3]}.</div></body>""",
     ["Chains", f"{_SAID[1]}.", f"{_SAID[2]}.", f"{_SAID[0]}."]),
]


@pytest.mark.parametrize("page, kept", HELD_OUT)
def test_main_text_of_held_out_pages(page, kept):
    assert html_blocks.main_text(page, html_blocks.trained_tree()).split("\n") == kept


def test_words_and_links_of_neighbours_decide():
    tree = html_blocks.trained_tree()
    around = [i for i, name in enumerate(html_blocks.FEATURES) if name.endswith(("_before", "_after"))]
    links = [i for i in around if html_blocks.FEATURES[i].startswith("link")]
    for columns in (around, links):
        changed = 0
        for page, _ in HELD_OUT:
            rows = html_blocks.features_of(html_blocks.blocks_of(page))
            without = rows.copy()
            without[:, columns] = 0
            changed += [tree.predict(r) for r in rows.tolist()] != [tree.predict(r) for r in without.tolist()]
        assert changed


def test_pages_with_dotted_capitals_formulas_and_nested_drawings_are_whole():
    tree = html_blocks.trained_tree()
    page = f"""<body><article><h1>{"İstanbul " * 60}</h1><SCRIPT>track("</p>")</SCRIPT ><p>{_SAID[0]}.</p><script>x</script>
    <p>{_SAID[1]} <math><mi>x</mi><mo>=</mo><mn>2</mn></math>.</p><svg><g>label<svg><text>inner</text></svg>label</g></svg><p>{_SAID[2]}.</p>
    <button>Send <b>it</b></button><p>{_SAID[3]}.</p></article></body>"""
    assert html_blocks.main_text(page, tree).split("\n") == [
        ("İstanbul " * 60).strip(), f"{_SAID[0]}.", f"{_SAID[1]} x=2.", f"{_SAID[2]}.", f"{_SAID[3]}.",
    ]


@pytest.mark.parametrize("unit", ['<p t=">">', '<p t=">"', "<a x='", "<!x", "<button>", "<svg>", "<title>", '<div class="ad">x', "<ul><li>x", "<b><i>", "</p>"])
def test_time_grows_with_the_length_of_a_page(unit):
    import time

    tree = html_blocks.trained_tree()

    def took(n):
        page = "<body><p>start here</p>" + unit * (n // len(unit))
        start = time.process_time()
        html_blocks.main_text(page, tree)
        return time.process_time() - start

    took(10_000)
    assert min(took(160_000) for _ in range(2)) < 3.5 * max(took(80_000), 0.02)


# ---------------------------------------------------------------- models against plain loops

def test_network_scores_match_a_plain_forward_pass():
    rng = np.random.default_rng(3)
    net = byte_cnn.ByteNet(
        rng.normal(size=(257, 3)), rng.normal(size=(24, 5)), rng.normal(size=5), rng.normal(size=(5, 4)), rng.normal(size=4),
        rng.normal(size=4), rng.normal(size=4) / 3,
    )

    def score(text):
        raw = list(text.encode())
        halves = max(2, -(-len(raw) // 256))
        data = raw + [256] * (halves * 256 + 8 - len(raw))
        logits = []
        for chunk in range(halves - 1):
            best = [max(sum(net.embed[data[at + j]][d] * net.filters[j * 3 + d][f] for j in range(8) for d in range(3))
                        for at in range(chunk * 256, chunk * 256 + 512, 4)) for f in range(5)]
            pooled = [max(0.0, b + net.bias[f]) for f, b in enumerate(best)]
            hidden = [max(0.0, sum(pooled[f] * net.hidden[f][h] for f in range(5)) + net.hidden_bias[h]) for h in range(4)]
            logits.append(sum(hidden[h] * net.out[h] for h in range(4)))
        z = net.combine[0] * sum(logits) / len(logits) + net.combine[1] * max(logits) + net.combine[2] * min(logits) + net.combine[3]
        return 1 / (1 + np.exp(-min(30, max(-30, z))))

    texts = ["", "a", "é漢" * 90, "".join(chr(rng.integers(32, 900)) for _ in range(700)), "x" * 512, "y z" * 300]
    want = [score(t) for t in texts]
    assert net.scores(texts) == pytest.approx(want, abs=1e-8)
    assert net.scores(texts, block=512) == pytest.approx(want, abs=1e-8)  # long texts in blocks


def test_tree_margins_match_plain_walks_and_boosting_lowers_the_loss():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, len(toxicity.NAMES)))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    trees = toxicity.BoostedTrees.fit(x, y)

    def margin(row):
        total = trees.start
        for feature, value, leaf in zip(trees.feature, trees.value, trees.leaf):
            at = 0
            for _ in range(trees.depth):
                at = 2 * at + (2 if row[feature[at]] > value[at] else 1)
            total += leaf[at - (2 ** trees.depth - 1)]
        return total

    got = trees.margins(x)
    assert got == pytest.approx([margin(r) for r in x])
    assert np.mean((got > 0) == (y > 0.5)) > 0.95


def test_toxic_features_match_plain_counting():
    lexicon = toxicity.Lexicon({"grubby": 3.5}, {"grub": 2.75, "zork": 4.0})
    reader = toxicity.Reader(lexicon)
    insult = sorted(toxicity.INSULTS)[0]
    text = f"You GRUBBY {insult}! zorkling are, b4d 5ome grubbing thing you you {insult.upper()} far away from all of the others here grubby"
    tokens = text.split()
    found = dict(zip(toxicity.NAMES, reader.features(text)))
    bare = [t.lower().strip("!,") for t in tokens]
    assert found["insults"] == bare.count(insult) == 2 and found["insult_share"] == 2 / len(tokens)
    assert found["learnt"] == 2 and found["stems"] == sum(w.startswith(("grub", "zork")) and w != "grub" for w in bare)
    assert found["second_person_share"] == 3 / len(tokens) and found["weight_max"] == 4.0
    strength = [max(3.5 * (w == "grubby"), 4.0 * w.startswith("zork"), 2.75 * w.startswith("grub"), 3.0 * (w == insult)) for w in bare]
    assert found["weight_mean"] == pytest.approx(sum(strength) / len(tokens))
    assert found["exclaimed_share"] == 1 / len(text) and found["log_words"] == pytest.approx(np.log(len(tokens) + 1))
    assert reader.features("") == [0.0] * len(toxicity.NAMES)


def test_forest_scores_match_plain_path_lengths():
    rng = np.random.default_rng(6)
    good = rng.normal(size=(300, len(quality_rules.FEATURES)))
    forest = quality_rules.IsolationForest.fit(good, trees=20, sample=64)

    def score(row):
        x = [min(10.0, max(-10.0, (v - c) / s)) for v, c, s in zip(row, forest.centre, forest.scale)]
        paths = []
        for feature, value, child, length in zip(forest.feature, forest.value, forest.child, forest.length):
            at = 0
            while feature[at] >= 0:
                at = child[at] + int(x[feature[at]] > value[at])
            paths.append(length[at])
        return 2 ** -(sum(paths) / len(paths) / forest.expected)

    rows = np.vstack([good[:40], rng.normal(scale=9, size=(20, good.shape[1]))])
    got = forest.score(rows)
    assert got == pytest.approx([score(r) for r in rows])
    assert got[40:].mean() > got[:40].mean() + 0.1


def test_forest_is_the_same_for_rows_that_repeat_a_key(spark):
    rng = np.random.default_rng(9)
    rows = [(7 if i % 3 == 0 else i, " ".join(rng.choice(["red", "blue", "tall", "sea", f"w{i}"], 30))) for i in range(240)]
    labels = spark.createDataFrame([(i, 1) for i in range(240)] + [(7, 1)] * 2, "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [
        sorted(map(str, quality_rules.judge_quality(docs.repartition(n), labels, max_rows=40).collect())) for n in (2, 7)
    ]
    assert found[0] == found[1]
