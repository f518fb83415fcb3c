"""URL rules, repetition rules and page extraction against brute force."""

import random
import time
from collections import Counter

import pytest
from helpers import frame, hard_texts, prose, with_clash, with_odd_rows, words

from quire.llm import repetition, templates, url_rules
from quire.llm.queries import URL_RULES


def judge(url, rules):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    cut = min([len(rest), *[rest.index(c) for c in "/?#" if c in rest]])
    host = rest[:cut].translate({a: a + 32 for a in range(65, 91)})
    path = rest[cut:]
    path = path[: min([len(path), *[path.index(c) for c in "?#" if c in path]])]
    fits = [(h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, key=lambda x: (len(x[0]), x[1]), default=(None, "allow"))
    return host, path, *best


URLS = [None, "", "no scheme", "http://", "http://COM/", "https://com", "ftp://a.com?x=/en/", "http://example.com/en/1",
        "http://www.Example.com/en/1#f", "http://a.www.example.com/en/", "http://notexample.com/en/", "http://x.net/es/a?b#c",
        "http://net/fr/", "http://net/fr", "http://a.b.net/fr/x", "x://y://example.com/en/", "http://.com/", "http://com./", "http://é.com/ü"]


@pytest.mark.parametrize("rules", [URL_RULES, [("com", "/", "allow"), ("com", "/", "block"), ("example.com", "/", "allow"),
                                               ("com", "/en/1", "block"), (None, "/", "block"), ("net", None, "block")]])
def test_url_rules(spark, rules):
    r = random.Random(3)
    urls = URLS + [f"http://{r.choice(['www.', 'a.', ''])}{r.choice(['example.com', 'x.net', 'z.org', 'com'])}/{r.choice(['en', 'es', 'fr', ''])}/{r.randrange(9)}"
                   for _ in range(300)] + ["http://hot.example.com/en/1"] * 200
    pages = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)], "page_id long, url string, host string, key string")
    out = {x.page_id: (x.host, x.path, x.rule, x.verdict)
           for x in url_rules.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    usable = [x for x in rules if x[0] and x[1] is not None]
    assert out == {i: judge(u, usable) for i, u in enumerate(urls)}


def test_url_rules_without_rows_or_rules(spark):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(None, None), (1, "http://a.com/"), (1, "http://a.com/")], "page_id long, url string")
    assert url_rules.judge_urls(pages.where("false"), rules).collect() == []
    assert sorted(x.verdict for x in url_rules.judge_urls(pages, rules.where("false")).collect()) == ["allow"] * 3
    assert len(url_rules.judge_urls(pages, rules).collect()) == 3


def longest_repeat(w):
    best = 0
    for n in range(1, len(w)):
        if max(Counter(tuple(w[i: i + n]) for i in range(len(w) - n + 1)).values(), default=0) < 2:
            break
        best = n
    return best


def test_repetition_rules(spark):
    line = prose(40, 12)
    part = prose(41, 70)
    texts = hard_texts()[:11] + [f"{line}\n" * 20, f"{part} {prose(42, 1000)} {part}", "a " * 400, "x\n\n\nx\ny\nx\n", "# * & | < > $ % é",
                                 *[prose(i, 90, 6) for i in range(60, 80)], *[prose(i, 300) for i in range(80, 90)]]
    out = {r.doc_id: r for r in repetition.repetition_rules(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        t, w = t or "", words(t)
        seen, dup = set(), 0
        for row in t.split("\n"):
            dup += row in seen and bool(words(row))
            seen.add(row)
        runs = Counter(tuple(w[j: j + 5]) for j in range(len(w) - 4))
        cover = {x for j in range(len(w) - 4) if runs[tuple(w[j: j + 5])] > 1 for x in range(j, j + 5)}
        r = out[i]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), dup, len(cover)), i
        assert r.n_symbols == sum(t.count(c) for c in "#*$%&|<>")
        assert r.base_failed == (len(w) < 10 or 100 * len(cover) > 20 * len(w))
        long = longest_repeat(w)
        assert r.longest_repeat == (long if long >= 5 else 0) and r.covered_words == len(cover)
        assert not (r.base_failed and r.kept)
    assert not out[12].kept and not out[12].base_failed  # a long passage twice
    assert all(out[i].kept for i in range(len(texts) - 10, len(texts)))


def test_repetition_rules_of_odd_rows(spark):
    df = with_odd_rows(with_clash(frame(spark, hard_texts())))
    out = repetition.repetition_rules(df).collect()
    assert len(out) == df.count() and [r.base_failed for r in out if r.doc_id is None] == [True]
    assert repetition.repetition_rules(df.where("false")).collect() == []


def page(main, nav="Home About", foot="&copy; us"):
    return (f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
            f"<header><h2>Site</h2></header><nav><ul><li><a href='/'>{nav}</a></li></ul></nav><div class=\"ad\">Buy &amp; go</div>"
            f"{main}<aside>Side</aside><footer>{foot}</footer></body></html>")


def extract_group(pages):
    """Plain version: vectors of occurrences spelled out over the distinct pages, texts inside a tag of their class."""
    distinct = [templates.read_page(p) for p in sorted(set(pages))]
    n = len(distinct)
    tags, texts, size = [], [], Counter()
    for p in distinct:
        tags.append(Counter(p.paths))
        texts.append(Counter(templates.text_token(p.paths[e], t) for e, t in p.blocks))
        for e, t in p.blocks:
            size[templates.text_token(p.paths[e], t)] += len(t)

    def vectors(counts):
        return {t: tuple(c[t] for c in counts) for t in set().union(*counts)}

    tag_class, text_class = vectors(tags), vectors(texts)
    common = {v for v in tag_class.values() if sum(x > 0 for x in v) >= 3 and 2 * sum(x > 0 for x in v) >= n}
    constant = {t: v for t, v in text_class.items() if v in common}
    if 2 * sum(size[t] for t in constant) > sum(size.values()):
        constant = {}
    tag_class = {t: v for t, v in tag_class.items() if v in set(constant.values())}
    return [templates.extract_page(templates.read_page(p), constant, tag_class) for p in pages]


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("just text", "just text"), ("<p>a <b>b</b>&nbsp;c<br>d<p>e", "a b c d\n\ne"),
    (page("<article><h1>H &amp;amp; i</h1><p><b>One.<br><p>Two\n  three</p><form>f</form><div class='comments'>c</div></article>"),
     "H &amp; i\n\nOne.\n\nTwo three"),
    (page("<main><header><h1>Top</h1></header><p>x &lt; y</p><!-- <p>no</p> --><section>z</section></main>"), "Top\n\nx < y\n\nz"),
    (page("<div id='content'><p>Long enough article text here</p><ul><li>one<li>two</ul></div>"),
     "Long enough article text here\n\none\n\ntwo"),
    (page("<article><p>cut off here <b").split("<aside")[0], "cut off here"), ("<article>a < b and c > d</article>", "a < b and c > d")])
def test_page_text(html, text):
    assert extract_group([html or ""]) == [text]


def test_pages_of_one_host(spark):
    r = random.Random(2)
    bodies = [[prose(r.randrange(10**6), 30) for _ in range(r.randrange(1, 4))] for _ in range(150)]
    html = [page("<div class='wrap'><div class='body'>" + "".join(f"<p>{p}</p>" for p in b) + "</div></div>", nav=prose(i, 3)) for i, b in enumerate(bodies)]
    rows = [(i, f"http://hot.com/{i}", h, "clash") for i, h in enumerate(html)] + [(900, None, None, None), (901, "http://hot.com/1", "", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = {x.page_id: x for x in templates.extract_main_text(df.unionByName(df.where("page_id = 3"))).collect()}
    for i, b in enumerate(bodies):
        assert out[i].text == "\n\n".join(b) and out[i].n_chars == len(out[i].text)
    assert out[900].text == out[901].text == "" and out[900].n_chars == 0
    assert templates.extract_main_text(df.where("false")).collect() == []


@pytest.mark.parametrize("html, text", [
    ("<body><div class='has-sidebar'><article><p>one</p></article></div></body>", "one"),
    ("<body><div class='widget'><article><p>one</p><div class='social'>no</div></article></div></body>", "one"),
    ("<article><div class='entry-header'><h1>top</h1></div><h2 id='related-work'>Related</h2><p id='social-effects'>two</p>"
     "<section id='search-algorithms'><p>three</p></section></article>", "top\n\nRelated\n\ntwo\n\nthree"),
    ("<article><p>let <math><mi>x</mi></math> be</p></article>", "let x be")])
def test_marks_that_drop_nothing(html, text):
    assert extract_group([html]) == [text]


@pytest.mark.parametrize("html, text", [
    ("<body><form id='aspnetForm'><div class='nav'>menu</div><h1>top</h1><p>the text of the page</p></form></body>", "top\n\nthe text of the page"),
    ("<article><section class='social-history'><p>one</p></section><p class='search-result'>two</p>"
     "<p>a <b class='alert'>bold</b> <a class='related'>link</a></p></article>", "one\n\ntwo\n\na bold link"),
    ("<article><p>x <span class='ad'>buy <span>x</span> more ad</span> y</p><button>Share <b>it</b></button></article>", "x y"),
    ("<article><p>x <span class='ad'>never closed</p><p>y</p></article>", "x never closed\n\ny"),
    ("<article><p>x <span class='ad'>closed late</p><p>y</p></article></span>", "x\n\ny"),
    ("<article><p>one</p></article><article class='comment'>hello</article>", "one"),
    ("<article><p>one</p><article class='user-comment'>hello</article><div class='post-comments'>no</div></article>", "one")])
def test_names_break_ties(html, text):
    assert extract_group([html]) == [text]


def test_deep_and_long_pages():
    deep = "<div class='a'>" * 40_000
    for html in (deep + "<p>x" + "</div>" * 40_000, deep + "</p>" * 40_000 + "<p>x", deep.replace("div", "b") + "x", "<p>x" + "<b class='ad'>" * 40_000):
        start = time.perf_counter()
        assert templates.extract_page(templates.read_page(html), {}, {}) == "x"
        assert time.perf_counter() - start < 3


def hosts_of_pages(seed, n_hosts=12):
    """Pages with constant, repeated and varying slots, some twice, some hosts with copies of one page only."""
    r = random.Random(seed)
    rows = []
    for h in range(n_hosts):
        kinds = r.sample(["<div class='x7'>Sign up</div>", "<div><h4>More</h4><p>of this</p></div>", "<p class='z'>All rights</p>"], 2)
        shared = prose(r.randrange(10**6), 40)
        for i in range(r.choice([1, 2, 3, 5, 90])):
            body = "".join(f"<li><i>{prose(r.randrange(10**6), 6)}</i><div class='by'>Reply</div></li>" for _ in range(r.randrange(4)))
            text = shared if h % 4 == 0 else prose(r.randrange(10**6), 40)
            html = f"<body>{kinds[0]}<h1>t{i}</h1><p>{text}</p><ul>{body}</ul>{kinds[1] if r.random() < 0.6 else ''}</body>"
            rows += [(h, html)] * r.choice([1, 1, 2])
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_templates_against_vectors(spark, seed, monkeypatch):
    rows = hosts_of_pages(seed)
    want = {}
    for h in {h for h, _ in rows}:
        ids = [i for i, row in enumerate(rows) if row[0] == h]
        want |= dict(zip(ids, extract_group([rows[i][1] for i in ids]), strict=True))
    assert any("Reply" not in t and "Sign" not in t for t in want.values())
    df = spark.createDataFrame([(i, f"https://h{h}.org/{i}", p) for i, (h, p) in enumerate(rows)], "page_id long, url string, html string")
    for bound in (templates.BROADCAST_TOKENS, 0):
        monkeypatch.setattr(templates, "BROADCAST_TOKENS", bound)
        got = {x.page_id: x.text for x in templates.extract_main_text(df.repartition(7)).collect()}
        assert got == want


def test_constant_slots_go_and_varying_slots_stay():
    pages = [f"<body><div class='x7'>Sign up</div><p>{prose(i, 20)}</p><div class='by'>About us</div></body>" for i in range(100)]
    assert extract_group(pages) == [prose(i, 20) for i in range(100)]
    assert extract_group(pages[:2]) == [f"Sign up\n\n{prose(i, 20)}\n\nAbout us" for i in range(2)]  # too few to tell
