"""Quality rules, classifier, HTML, tokens, packing and the pipeline against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import public_tokenizers
from locuspark.llm import packing, quality_classifier, sentencepiece_codec, token_output
from locuspark.llm.common import lookup
from locuspark.llm.html_extract import extract, main_text
from locuspark.llm.quality_rules import RULES, STOP_WORDS, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def slow_figures(text):
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    count = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i in range(len(w) - 2) if count[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
        "n_stop_words": sum(x.lower() in STOP_WORDS for x in w),
        "n_upper": len(re.findall("[A-ZÀ-ÖØ-Þ]", text)),
        "n_exclaimed": text.count("!!"),
    }


def slow_kept(f):
    failed = f["n_words"] < 50 or 100 * f["n_repeat_words"] > 50 * f["n_words"]
    good = all((r.low is None or 100 * f[r.figure] >= r.low * f[r.of]) and (r.high is None or 100 * f[r.figure] <= r.high * f[r.of]) for r in RULES)
    return failed, not failed and good


def test_rules(odd, none):
    out = quality_rules(odd)
    assert out.columns[: len(odd.columns)] == odd.columns and "_n_lines" in out.columns
    for r in out.collect():
        f = slow_figures(r.text or "")
        got = {n: r["_n_lines" if n == "n_lines" else n] for n in f}
        assert got == f and (r.base_failed, r.kept) == slow_kept(f), r.doc_id
    assert quality_rules(none).count() == 0


def test_rules_run_no_python(odd):
    plan = quality_rules(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange hashpartitioning" not in plan


def test_classifier_on_planted_junk(spark):
    rng = np.random.default_rng(0)
    words = [f"{a}{b}" for a in ("the", "tion", "re", "an", "in") for b in ("er", "st", "nd", "ou", "le")]
    good = [" ".join(rng.choice(words, n)) for n in rng.integers(20, 200, 500)]
    bad = [" ".join(x.upper() + "!!" for x in rng.choice(words[:6], n)) for n in rng.integers(20, 200, 120)]
    rows = [(i, t, int(i < 500)) for i, t in enumerate(good + bad)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3], "doc_id long, quality int")
    network, prior = quality_classifier.fit(docs, labels)
    out = quality_classifier.score(docs, network, prior).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in out)
    assert np.mean([r.predicted == rows[r.doc_id][2] for r in out if r.held_out]) > 0.95
    again = {r.doc_id: r.score for r in quality_classifier.score(docs, *quality_classifier.fit(docs.repartition(5), labels)).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in out)


def test_risk_and_gradient_against_slow_ones():
    """The risk row by row, and its gradient by differences, on both sides of zero."""
    rng = np.random.default_rng(1)
    p, u = rng.normal(0.4, 1, (30, 5)), rng.normal(0, 1, (50, 5))
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for prior, sign in ((0.3, 1), (0.95, -1)):
        network = quality_classifier.Network(p, u, prior, hidden=4, steps=3)
        if sign < 0:  # scores that are high on P and low on U
            network.weights[0][:] = 0.0
            network.weights[0][0] = 0.2
            network.weights[2][:] = 1.0
            p, u = p + 4, u - 4

        def slow():
            a, b, c, d = network.weights
            g = lambda row: float(np.tanh(row @ a + b) @ c + d[0])  # noqa: E731, B023
            first = prior * np.mean([sigmoid(-g(x)) for x in p])  # noqa: B023
            return first, np.mean([sigmoid(g(x)) for x in u]) - prior * np.mean([sigmoid(g(x)) for x in p])  # noqa: B023

        first, second, grads = network.risk(p, u)
        assert np.allclose((first, second), slow()) and second * sign > 0
        goal = (lambda: sum(slow())) if sign > 0 else (lambda: -slow()[1])  # noqa: B023
        for w, g in zip(network.weights, grads, strict=True):
            for at in np.ndindex(w.shape):
                keep = w[at]
                w[at] = keep + 1e-5
                up = goal()
                w[at] = keep - 1e-5
                down = goal()
                w[at] = keep
                assert abs((up - down) / 2e-5 - g[at]) < 1e-6


@pytest.mark.parametrize("share", [0.15, 0.5, 0.85])
def test_prior_of_planted_mixtures(share):
    """The share of positives among unlabelled rows is found whatever the labels' own balance."""
    rng = np.random.default_rng(int(100 * share))
    good = lambda n: rng.normal(1.5, 1, (n, 6))
    bad = lambda n: rng.normal(-1.5, 1, (n, 6))
    n = 4000
    unlabelled = np.concatenate([good(int(n * share)), bad(n - int(n * share))])
    assert abs(quality_classifier.estimate_prior(good(1500), unlabelled) - share) < 0.06


def test_best_bin_of_scores_by_hand():
    positive, unlabelled = np.repeat([0.9, 0.1], [90, 10]), np.repeat([0.9, 0.1, 0.05], [45, 5, 50])
    assert abs(quality_classifier.best_bin(positive, unlabelled) - 0.5) < 1e-9
    assert 0 <= quality_classifier.best_bin(np.ones(3), np.zeros(2)) <= 1
    assert quality_classifier.estimate_prior(np.ones((1, 3)), np.ones((2, 3))) == 0.5


def test_classifier_corners(odd, none, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    network, prior = quality_classifier.fit(odd, labels)
    assert network is None and prior == 0.5
    out = quality_classifier.score(odd, network, prior)
    assert out.count() == odd.count() and {r.score for r in out.collect()} == {0.5}
    some = spark.createDataFrame([(3, 1), (3, 0), (-3, 1), (0, 1), (6, 0), (9, 1), (None, 1), (12, None)], "doc_id long, quality int")
    network, prior = quality_classifier.fit(odd, some)
    scores = quality_classifier.score(odd, network, prior)
    assert scores.count() == odd.count() and scores.where("score IS NULL OR isnan(score) OR held_out IS NULL").count() == 0
    assert quality_classifier.score(none, network, prior).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><a href=/>Home</a></header><nav><ul><li><a href="/a">a</a></li></ul></nav><!-- ad 1 --><div class="ad">Buy this now.</div>
<div class="cookie-notice">We use cookies.</div><aside>Related</aside>
<article class="post with-sidebar"><h1>Title &amp; more</h1><p><b>First   paragraph
goes on.<br><p>Second &lt;one&gt; &eacute;.</p><form><label>Name</label></form><p>Short.</p><div class="share-bar"><a href=x>share</a></div></article>
<section id="comments"><p>A reader says that the article is very good and long enough to look like content of the page itself, with the and of.</p></section>
<footer>&copy; 2020</footer></body></html>"""


def test_html_block_rules():
    assert main_text(PAGE) == "Title & more\nFirst paragraph goes on.\nSecond <one> é.\nShort."
    assert main_text("") == main_text("<html><nav>menu</nav>") == ""
    assert main_text("<p>only &#233;&nbsp;text</p>") == "only é text"
    assert main_text("<article><p>a<br><br>b<script>if (a<b) {}") == "a\nb"
    assert main_text("<article><p>a</p><!-- open") == "a"


def test_html_ambiguous_blocks_take_the_nearest_label():
    long = "The man of the house is in the garden and the dog is at the gate with a ball. " * 3
    menu = "".join(f'<p><a href="/{i}">menu item {i} which has a long label of its own for the list</a></p>' for i in range(3))
    page = f"<body>{menu}<p>tiny</p><p>{long}</p><p>small</p><p>{long}</p></body>"
    assert main_text(page) == "\n".join([long.strip(), "small", long.strip()])


def test_html_article_by_its_class():
    page = "<body><div class=logo>Site</div><div class='post'><h2>Head</h2><p>Short words.</p></div><p>After</p></body>"
    assert main_text(page) == "Head\nShort words."
    assert main_text("<main><p>a</p><article><p>b</p></article><p>c</p></main>") == "b"


def test_html_text_outside_of_a_named_container():
    long = ("The man of the house is in the garden and the dog is at the gate with a ball. " * 3).strip()
    assert main_text(f"<div class='post-title'>Head</div><div class=body><p>{long}</p></div>") == f"Head\n{long}"
    assert main_text(f"<main><p>{long}</p><article><p>teaser</p></article><p>{long}</p></main>") == f"{long}\nteaser\n{long}"
    links = "<p><a href=/x>a link that is long enough to be no short block at all, with the and of</a></p>"
    page = f"<article><p>{long}</p><p>{long}</p></article>{links}<p>far</p><h2>Head</h2><p>{long}</p><p>After</p>"
    assert main_text(page) == f"{long}\n{long}\nHead\n{long}"


def test_html_elements_without_end_tag_end_with_their_parent():
    article = "<article><p>text</p></article>"
    assert main_text(f"<datalist><option value=a>A<option value=b>B</datalist>{article}<select><option>x</option></select>") == "text"
    for name in ("button", "noscript", "object", "audio", "video", "canvas", "map", "template", "svg"):
        assert main_text(f"<div><{name}>no</div>{article}") == "text", name
        assert main_text(f"<article><p>one <{name}>no <b>no</b></{name}> two</p>three</article>") == "one two\nthree", name
    for name in ("button", "object", "audio", "video", "canvas", "map"):
        assert main_text(f"<body><{name}>no{article}") == "text", name
    assert main_text("<article><p>one <video src=x>no<p>two <select><option>no<option>no</select> three") == "one\ntwo three"
    assert main_text("<head><noscript>no<body><p>text") == "text"
    assert main_text(f"<title>a<b>c</title>{article}<script>no {article}") == "text"


def test_html_of_languages_without_known_stop_words():
    polish = ("Stary zamek stoi nad rzeką, a wokół niego rosną wysokie drzewa i kwiaty. " * 3).strip()
    chinese = "古老的城堡矗立在河边，四周长满了高大的树木和美丽的花朵。" * 8
    menu = "<p><a href=/x>link</a></p>"
    for text in (polish, chinese):
        assert main_text(f"<body>{menu}<p>{text}</p><p>{text}</p>{menu}</body>") == f"{text}\n{text}"
        assert main_text(f"<div class=post-title>Head</div><div><p>{text}</p></div>") == f"Head\n{text}"
    odd = ("the%%% man** of### xylophone, in|| a&&& house " * 5).strip()
    english = ("The man of the house is in the garden and the dog is at the gate with a ball. " * 3).strip()
    assert main_text(f"<body><p>{odd}</p>{menu}<p>{english}</p></body>") == f"{odd}\n{english}"
    assert main_text(f"<body><p>{polish}</p><p>{english}</p>{menu}</body>") == f"{polish}\n{english}"


ENGLISH = ("The man of the house is in the garden and the dog is at the gate with a ball. " * 3).strip()
GERMAN = "Straßenbahnhaltestellen Wartungsarbeiten beginnen nächsten Donnerstag frühmorgens, Fahrgäste benutzen bitte Ersatzbusse Richtung Hauptbahnhof. " * 2


def test_html_attributes_are_read_as_such():
    """What is hidden or furniture is said by an attribute's own words, not by any text within a tag."""
    p = f"<p>{ENGLISH}</p>"
    for kept in ("style='overflow:hidden'", "class='overflow-hidden'", "title='A hidden gem'", "data-x='display:none'", "class='form-factor'", "class='no-sidebar'", "title=\"a > b\""):
        assert main_text(f"<body><div {kept}>{p}</div></body>") == ENGLISH, kept
    for gone in ("hidden", "HIDDEN=''", "aria-hidden=true", "style='color:red; Display : none'", "class='x visually-hidden'", "class=search-form", "id=cookie-notice", "role=navigation", "class='post-comments'", "class='article-sidebar ad-1'"):
        assert main_text(f"<body><div {gone}>{p}</div><p>{ENGLISH} x</p></body>") == f"{ENGLISH} x", gone
    assert main_text(f"<body><div class=site-header>Site</div><div class=post><div class='post-header'><h1>Title</h1></div>{p}</div></body>") == f"Title\n{ENGLISH}"


def test_html_links_around_blocks():
    teaser = "<a href=/x><div>The story of the day that is in the papers and on the radio for all</div><p>It is of the kind that you read in the tram with the others, and it is on page two of the paper of the day in the evening and at night</p></a>"
    assert main_text(f"<body>{teaser}<p>{ENGLISH}</p>{teaser}</body>") == ENGLISH
    # Without an end tag a link ends with its block; an anchor is no link.
    assert main_text(f"<body><p><a href=/x>Top<p>{ENGLISH}</p><p>{ENGLISH}</body>") == f"{ENGLISH}\n{ENGLISH}"
    assert main_text(f"<body><a name=top><div><p>{ENGLISH}</p></div></a></body>") == ENGLISH


def test_html_of_broken_tags():
    assert main_text(f"<article><p title=\"open>{ENGLISH}</p><p>more</p></article>") == f"{ENGLISH}\nmore"
    assert main_text(f"<article><p title='open>{ENGLISH}</p><p class='b'>it's</p></article>") == f"{ENGLISH}\nit's"
    assert main_text("<article><p>1 < 2 and 3 > 2</p><p>a <b c</p></article>") == "1 < 2 and 3 > 2\na"
    assert main_text("<article><p>x</p") == "x"
    assert main_text("<article><p a=1 b = \"2\"c='3'/ d>x</p></article></section></div></b>") == "x"


def test_html_of_words_that_are_on_no_list():
    assert main_text(f"<body><p><a href=/>menu</a></p><p>{GERMAN}</p><p>{ENGLISH}</p></body>") == f"{GERMAN.strip()}\n{ENGLISH}"
    assert main_text(f"<article><p>{ENGLISH}</p><p>{GERMAN}</p></article>") == f"{ENGLISH}\n{GERMAN.strip()}"


@pytest.mark.parametrize("page", ["<a " * 350_000, "<p title='" * 100_000, "<" * 1_000_000, "</div>" * 170_000, "<div><i>" * 60_000 + "</p></span>" * 60_000, "<svg><b>" * 60_000 + "</p>" * 60_000, "<article><a href=x>" * 50_000 + "</section>" * 50_000, "<!--" * 250_000, '<a b="' * 90_000 + "'" * 90_000])
def test_html_takes_time_in_proportion(page):
    import time

    began = time.process_time()
    main_text(f"<article><p>x</p></article>{page}")
    assert time.process_time() - began < 4


def slow_labels(blocks):
    """The rules on (text, link characters, furniture, level, region), written for clarity: every look at a neighbour is a scan."""
    import string

    def dense(text):
        words = text.lower().split()
        return sum(w.strip(string.punctuation) in STOP_WORDS for w in words) >= 0.2 * len(words)

    n = range(len(blocks))
    text, links, furniture, level, region = (list(x) for x in zip(*blocks, strict=True))
    linked = [2 * links[i] > len(text[i]) for i in n]
    own = [i for i in n if not furniture[i]]
    known = any(len(text[i]) >= 60 and dense(text[i]) and not linked[i] for i in own)
    solid = {i for i in own if len(text[i]) >= 140 and not linked[i] and (dense(text[i]) or not known)}
    total = sum(len(text[i]) for i in solid)
    tops = [k for k in {level[i] for i in own} if k and 2 * sum(len(text[i]) for i in solid if level[i] >= k) >= total]
    top = max(tops, default=0)
    within = [bool(top) and level[i] >= top for i in n]
    label = dict.fromkeys(own)
    for i in own:
        if top and not within[i]:
            label[i] = i in solid
        elif linked[i]:
            label[i] = None if within[i] and len(text[i]) >= 140 else False
        elif i in solid or (len(text[i]) >= 140 and 10 * links[i] <= len(text[i])) or (within[i] and (len(text[i]) >= 140 or (len(text[i]) >= 60 and dense(text[i])))):
            label[i] = True
    if top:
        for i in list(own):
            if not within[i] and not linked[i] and i not in solid:
                k = own.index(i)
                after = next((j for j in own[k + 1 :] if within[j] or j in solid), None)
                before = next((j for j in own[:k][::-1] if within[j] or j in solid), None)
                if after is not None and not within[after] and ((before is not None and not within[before]) or after == own[k + 1]):
                    label[i] = True
    out = dict(label)
    for i in own:
        if label[i] is None:
            group = [j for j in own if within[j] == within[i] and (not within[i] or region[j] == region[i])]
            place = group.index(i)
            decided = [(abs(place - group.index(j)), label[j]) for j in group if label[j] is not None and not any(label[x] is not None for x in group[min(place, group.index(j)) + 1 : max(place, group.index(j))])]
            near = [v for d, v in decided if d == min(d for d, _ in decided)]
            out[i] = True if not near else any(near) if within[i] else all(near)
    return [out.get(i, False) for i in n]


def random_page(rng):
    """A page and its blocks as the rules see them."""
    words = "the of and in is garden river stone bridge morning letter window a to".split()
    odd = "zamek rzeka ogród drzewo kwiat okno most".split()
    found, parts, region = [], ["<html><head><title>t</title></head><body>"], 0
    for _ in range(rng.integers(1, 7)):
        name, level, furniture = [("div", 0, False), ("section", 0, False), ("article", 3, False), ("main", 2, False), ("div class='post-body'", 1, False), ("nav", 0, True), ("div class=sidebar", 0, True)][rng.integers(0, 7)]
        region += 1
        parts.append(f"<{name}>")
        for _ in range(rng.integers(1, 6)):
            text = " ".join(str(x) for x in rng.choice(words if rng.random() < 0.7 else odd, rng.choice([1, 4, 14, 40])))
            if rng.random() < 0.25:
                tail = " ".join(str(x) for x in rng.choice(words, rng.choice([1, 12])))
                parts.append(f"<p>{tail} <a href='/x?a=1&amp;b=2'>{text}</a></p>")
                found.append((f"{tail} {text}", len(text), furniture, level, region))
            else:
                parts.append(f"<p>{text}</p>" if rng.random() < 0.7 else f"<h2 id='x1'>  {text}\n</h2>")
                found.append((text, 0, furniture, level, region))
        parts.append(f"</{name.split()[0]}>")
    return "".join(parts), found


def test_html_against_brute_force():
    rng = np.random.default_rng(12)
    for _ in range(600):
        page, found = random_page(rng)
        want = "\n".join(b[0] for b, on in zip(found, slow_labels(found), strict=True) if on)
        assert main_text(page) == want, page


def test_html_needs_both_passes(monkeypatch):
    """Without the stop words, without the lengths, without the link shares or without pass two other pages come out."""
    from locuspark.llm import html_extract

    rng = np.random.default_rng(13)
    pages = [random_page(rng)[0] for _ in range(200)]
    full = [main_text(x) for x in pages]
    for name, value in (("_STOPS", frozenset()), ("MAX_LINK_SHARE", 2), ("LONG_CHARS", 10**9), ("inherit", lambda found: None)):
        with monkeypatch.context() as m:
            m.setattr(html_extract, name, value)
            assert sum(main_text(x) != y for x, y in zip(pages, full, strict=True)) > 10, name


def test_html_table(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None), (2, "", "", "y")]
    out = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert out.columns == ["page_id", "url", "text", "_text", "n_chars"]
    n = len(main_text(PAGE))
    assert sorted((r.page_id or 0, len(r._text), r.n_chars) for r in out.collect()) == [(0, 0, 0), (1, n, n), (1, n, n), (2, 0, 0)]
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_sentencepiece_is_the_library(odd, none):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    out = sentencepiece_codec.decode(sentencepiece_codec.encode(odd, PIECES), PIECES)
    assert out.columns == [*odd.columns, "ids", "decoded"]
    for r in out.collect():
        assert list(r.ids) == lib.encode(r.text or "")
        assert r.decoded == lib.decode(list(r.ids)) == (r.text or "").replace("▁", " ")
    assert sentencepiece_codec.encode(none, PIECES).count() == 0
    own = sentencepiece_codec.Model(PIECES)
    for x in ("▁▁ a▁b ", "<s>x</s>", "ab" * 900, "a" * 2000 + "é" * 70, "\x00\x01", "\n\n \n", "漢" * 40):
        assert own.encode([x])[0].tolist() == lib.encode(x)


def test_long_words_are_the_library_and_take_time_in_proportion(monkeypatch):
    """Words without a space: borders, the heap, and parts that are cut at borders or grow for want of one."""
    import time

    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    own = sentencepiece_codec.Model(PIECES)
    rng = np.random.default_rng(8)
    letters = lambda x, n: "".join(x[i] for i in rng.integers(0, len(x), n))
    kinds = {
        "letters": letters("abcdefghijklmnopqrstuvwxyz", 200_000),
        "base64": letters("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 200_000),
        "one": "a" * 200_000,
        "few": letters("eanst", 200_000),
        "chinese": letters("的一是不了人我在有他这中大来上国个到说们", 200_000),
    }
    seconds = {}
    for name, text in kinds.items():
        began = time.process_time()
        got = own.encode([text])[0].tolist()
        seconds[name] = time.process_time() - began
        assert got == lib.encode(text), name
    assert max(seconds.values()) < 20, seconds
    for batch, long in ((64, 8), (200, 3), (1 << 19, 2), (50, 1 << 30)):
        monkeypatch.setattr(sentencepiece_codec, "BATCH_CHARS", batch)
        monkeypatch.setattr(sentencepiece_codec, "LONG", long)
        own.forget()
        for text in [*(x[:3000] for x in kinds.values()), letters("etaoin shrdlu\u00e9\u6f22\u2581\n", 4000)]:
            assert own.encode([text, text[:99]])[0].tolist() == lib.encode(text)


def test_occurrences_are_all_edges():
    own = sentencepiece_codec.Model(PIECES)
    text = "▁the▁then▁banana"
    at, length, piece = own.occurrences(text)
    got = sorted(zip(at.tolist(), length.tolist(), (own.pieces[i] for i in piece), strict=True))
    known = set(own.pieces)
    assert got == sorted((i, n, text[i : i + n]) for i in range(len(text)) for n in range(1, 17) if i + n <= len(text) and text[i : i + n] in known)
    assert at.tolist() == sorted(at.tolist())


def test_pieces_are_prepared_once_for_all_texts():
    """Small texts cost in proportion to what they hold, not the making of all pieces' keys anew; wide codes give the same edges."""
    import time

    own = sentencepiece_codec.Model(PIECES)
    known = set(own.pieces)
    rng = np.random.default_rng(3)
    latin = "".join(map(chr, range(32, 127))) + "▁"
    texts = ["".join(latin[i] for i in rng.permutation(len(latin))) + "▁the▁banana\U0010ffff\x00é漢▁" for _ in range(40)]
    began = time.process_time()
    found = [own.occurrences(x) for x in texts]
    assert time.process_time() - began < 2
    own.code_of, own.kind = own.code_of.astype(np.uint32), np.dtype(">u4")
    unwind = lambda keys, fill: np.where((x := keys.view(">u2").reshape(-1, own.depth)) == 0xFFFF, fill, x).astype(">u4")
    own.low, own.high = own._keys(unwind(own.low, 0)), own._keys(unwind(own.high, 0xFFFFFFFF))
    for text, (at, length, piece) in zip(texts, found, strict=True):
        got = sorted(zip(at.tolist(), length.tolist(), (own.pieces[i] for i in piece), strict=True))
        assert got == sorted((i, n, text[i : i + n]) for i in range(len(text)) for n in range(1, 17) if i + n <= len(text) and text[i : i + n] in known)
        assert all((x == y).all() for x, y in zip((at, length, piece), own.occurrences(text), strict=True))


def test_tokens(odd, none, spark, tmp_path):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(BPE)
    path = f"file://{tmp_path}/tokens"
    token_output.write_tokens(odd, path, BPE)
    rows = sorted(spark.read.parquet(path).collect(), key=lambda r: (r.file, r.row))
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))
    texts = Counter((d, t or "") for d, t in ((r.doc_id, r.text) for r in odd.collect()))
    want = Counter((d, tuple(lib.encode(t, add_special_tokens=False).ids) + (2,)) for (d, t), n in texts.items() for _ in range(n))
    assert Counter((r.doc_id, tuple(r.tokens)) for r in rows) == want
    at = 0
    starts = {}
    for r in rows:
        starts[(r.file, r.row)] = at
        at += len(r.tokens)
    got = {(r.file, r.row): r.start for r in token_output.read_tokens(spark, path).collect()}
    assert got == starts
    digests = Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_output.token_digests(spark, path).collect())
    assert digests == Counter((r.doc_id, starts[(r.file, r.row)], len(r.tokens), zlib.crc32(np.array(r.tokens, "<u4").tobytes())) for r in rows)
    assert token_output.tokens_table(none, BPE).count() == 0


def test_token_files_have_page_indexes_and_encodings(odd, spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    token_output.write_tokens(odd, f"file://{tmp_path}/t", BPE)
    meta = pq.ParquetFile(max(glob.glob(f"{tmp_path}/t/*.parquet"))).metadata.row_group(0)
    columns = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    assert sorted(n.split(".")[0] for n in columns) == ["doc_id", "file", "n_tokens", "row", "tokens"]
    assert all(c.has_offset_index and c.has_column_index for c in columns.values())
    assert any("DELTA" in e for e in columns["n_tokens"].encodings)
    assert any("DICTIONARY" in e for n, c in columns.items() if n.startswith("tokens") for e in c.encodings)


def whole(texts, path=BPE):
    from tokenizers import Tokenizer

    return [[*x.ids, 2] for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def encoded(texts, path=BPE):
    import pyarrow as pa

    return token_output.Encoder(path).encode(pa.array(texts), 2).to_pylist()


def test_other_tokenizers_take_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["a b", "", "C!", "two  spaces\n\n and <|endoftext|> more"]
    assert token_output.Encoder(BPE).safe and not token_output.Encoder(path).safe
    assert encoded(texts, path) == whole(texts, path)


def test_what_makes_a_tokenizer_separable():
    import copy
    import json

    spec = json.loads(open(BPE).read())
    assert token_output.separable(spec)
    changes = [
        lambda x: x["added_tokens"][0].update(lstrip=True),
        lambda x: x["added_tokens"][0].update(content="a b"),
        lambda x: x["normalizer"]["normalizers"].append({"type": "Strip"}),
        lambda x: x["normalizer"]["normalizers"][1].update(content="_"),
        lambda x: x["normalizer"]["normalizers"].pop(),
        lambda x: x["pre_tokenizer"]["pretokenizers"][0].update(pattern={"Regex": ".+"}),
        lambda x: x["pre_tokenizer"].update({"type": "Whitespace"}),
        lambda x: x["model"].update(dropout=0.1),
        lambda x: x.update(pre_tokenizer=None),
    ]
    for change in changes:
        other = copy.deepcopy(spec)
        change(other)
        assert not token_output.separable(other)


def test_encoder_of_letters_that_become_letter_and_mark():
    texts = [f"{a}{c}{b}" for c in "\u0130\u0958\u09df\ufb2a\ufb2b\u00e9\u03a3\u6f22" for a in ("AL", "", "\u0130") for b in (",", "", ".. x", "!?", "a,", "'")]
    got = encoded([*texts, " ".join(texts)])
    assert got == whole([*texts, " ".join(texts)])
    assert got[0] == [3558, 136, 229, 267, 2]


def test_encoder_over_all_characters_that_change():
    """Every character that lower case or NFC makes longer or of another kind, marks, blanks and special tokens, in random company."""
    import unicodedata

    odd = []
    for c in map(chr, range(0x110000)):
        if 0xD800 <= ord(c) < 0xE000:
            continue
        low, form = c.lower(), unicodedata.normalize("NFC", c)
        if len(low) > 1 or len(form) > 1 or form != c or unicodedata.category(low[0])[0] != unicodedata.category(c)[0] or (c.isspace() and ord(c) > 32):
            odd.append(c)
    assert "\u0130" in odd and len(odd) > 1000
    rng = np.random.default_rng(3)
    near = [*"aZJh9.,'!-\u030c\u0331\u00e9\u0301\u0308\u0345\u200d\u6f22\u1100\u1161 \n\t\r\x00", "'s", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>", "  ", " \n"]
    pick = lambda x, n: "".join(x[i] for i in rng.integers(0, len(x), n))
    texts = [pick(near, 3) + c + pick(near, 3) for c in odd]
    texts += [pick(odd, 3) + pick(near, 6) + pick(odd, 2) + pick(near, 3) for _ in range(5000)]
    for at in range(0, len(texts), 2000):
        group = texts[at : at + 2000]
        for text, a, b in zip(group, encoded(group), whole(group), strict=True):
            assert a == b, text.encode("unicode_escape")


def slow_pack(pieces, capacity):
    bins, out = [], []
    for length, source, cluster in pieces:
        fits = [(b["left"], i) for i, b in enumerate(bins) if b["left"] >= length and source not in b["s"] and cluster not in b["c"]]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append({"left": capacity, "s": set(), "c": set()})
        bins[i]["left"] -= length
        if source is not None:
            bins[i]["s"].add(source)
        if cluster is not None:
            bins[i]["c"].add(cluster)
        out.append(i)
    return out


def test_pack_is_best_fit():
    rng = np.random.default_rng(4)
    for _ in range(60):
        pieces = [(int(rng.integers(1, 40)), int(s) if (s := rng.integers(-1, 6)) >= 0 else None, int(c) if (c := rng.integers(-1, 9)) >= 0 else None) for _ in range(80)]
        pieces.sort(key=lambda x: -x[0])
        assert packing.pack(pieces, 40) == slow_pack(pieces, 40)


def check_bins(rows, docs, capacity):
    """rows: (bin, doc, units); docs: doc -> list of (source, text)."""
    bins = defaultdict(list)
    for b, d, n in rows:
        bins[b].append((d, n))
    for held in bins.values():
        assert sum(n for _, n in held) <= capacity
        if len(held) > 1 and all(len(docs[d]) == 1 for d, _ in held):
            sources = [docs[d][0][0] for d, _ in held if docs[d][0][0] is not None]
            texts = [(docs[d][0][1] or "").strip(" \t\n\x0b\x0c\r").lower() for d, _ in held]
            texts = [t for t in texts if t]
            assert len(sources) == len(set(sources)) and len(texts) == len(set(texts))
    return bins


def test_packed_documents(odd, none):
    out = packing.pack_documents(odd, capacity=500, group_rows=20)
    docs = defaultdict(list)
    for r in odd.collect():
        docs[r.doc_id].append((r.source, r.text))
    check_bins([(r.bin_id, r.doc_id, r.n_units) for r in out.collect()], docs, 500)
    units = Counter()
    for r in out.collect():
        units[r.doc_id] += r.n_units
        assert r.start == 500 * r.piece
    assert units == {d: sum(len(WORD.findall(t or "")) + 1 for _, t in ts) for d, ts in docs.items()}
    again = packing.pack_documents(odd.repartition(7), capacity=500, group_rows=20)
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))
    assert packing.pack_documents(none).count() == 0


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_with_hot_keys(spark, how):
    rows = [(i, None if i % 7 == 0 else (1 if i % 3 else i % 11), "x") for i in range(400)]
    left = spark.createDataFrame(rows, "i long, k long, _salt string")
    counts = Counter(k for _, k, _ in rows)
    right = spark.createDataFrame([(k, f"v{k}", n) for k, n in counts.items() if k != 5], "k long, v string, n long")
    got = Counter(tuple(r) for r in lookup(left.drop("_salt"), right, ["k"], "n", how, hot_share=0.2).collect())
    assert got == Counter((i, k, None if k == 5 else f"v{k}") for i, k, _ in rows if how == "left" or k != 5)


def test_pipeline_against_brute_force(spark, tmp_path):
    import corpus_pipeline
    from test_dedup import slow_components, slow_print

    good = "the man of the house is in a garden and it was by this road that he was to be".split()
    rng = np.random.default_rng(9)
    word = lambda: str(rng.choice(good)) if rng.random() < 0.5 else "".join(rng.choice(list("abdeginorst"), 6))
    text = lambda n: " ".join(word() for _ in range(n))
    line, passage = "This line stands at the foot of every page of the site", text(50)
    texts = []
    for i in range(60):
        t = text(int(rng.integers(40, 160)))
        if i % 3 == 0:
            t += f"\n{line}"
        if i % 5 == 0:
            t += f" {passage} {text(9)}"
        texts.append(t)
    texts += [texts[1], texts[4].replace(" the ", " a ", 1), "BAD!! " * 80, "* # " * 70, "", None, "short text"]
    rows = [(i, t, "en", f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    now = {i: t or "" for i, t in enumerate(texts)}
    now = {i: t for i, t in now.items() if slow_kept(slow_figures(t))[1]}
    assert len(now) == 62 - sum(len(WORD.findall(t)) < 50 for t in texts[:62])
    holders = defaultdict(set)
    for i, t in now.items():
        for x in t.split("\n"):
            holders[x.strip(" ").lower()].add(i)
    drop = lambda i, x: len(k := x.strip(" ").lower()) >= 40 and len(holders[k]) >= 5 and max(holders[k]) != i
    now = {i: "\n".join(x for x in t.split("\n") if not drop(i, x)) for i, t in now.items()}
    prints = {i: slow_print(t) for i, t in now.items()}
    root = slow_components(prints.values(), 4)
    first = {}
    for i in sorted(now):
        first.setdefault(root[prints[i]], i)
    now = {i: t for i, t in now.items() if first[root[prints[i]]] == i}
    seen = Counter(tuple(w[k : k + 35]) for t in now.values() for w in [WORD.findall(t)] for k in range(len(w) - 34))
    units = {}
    for i, t in now.items():
        w = WORD.findall(t)
        gone = {k + j for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for j in range(35)}
        units[i] = len(w) - len(gone) + 1
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.n_units for r in out} == units
    order = sorted(units, key=lambda i: (-units[i], i))
    bins = slow_pack([(units[i], i % 4, None) for i in order], packing.CAPACITY)
    assert {r.doc_id: r.bin_id for r in out} == dict(zip(order, bins, strict=True))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "SimHash near-dedup", "substring dedup", "best-fit packing"]

