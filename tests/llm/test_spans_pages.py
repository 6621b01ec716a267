"""Personal data, secrets, toxicity and page texts."""

import itertools
import random
import time
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketframe.llm import pii, secret_scan
from marketframe.llm.html_text import (
    Block,
    Extraction,
    blocks_of,
    extract_main_text,
    features,
    fit_blocks,
    main_text,
    minimum_cut,
    tree_distance,
)
from marketframe.llm.spans import digest, written
from marketframe.llm.toxicity import Ftrl, held_out, score_toxicity

DOCS = "doc_id long, text string"


def rule_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out)


def secret_rules(text):
    either = lambda w: "".join(f"[{c}{c.upper()}]" for c in w)
    names = "|".join(map(either, ("password", "passwd", "secret", "token")))
    assign = rf"({names}|{either('api')}_?{either('key')})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [("assign", *m.span()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_base_rules_match_their_patterns():
    rng = random.Random(1)
    for _ in range(6000):
        text = "".join(rng.choice(rng.choice(["0123456789", "@@@..", "ab-%+ ", "+ ()-.", "1234."])) for _ in range(rng.randint(0, 60)))
        assert sorted(pii.base_spans(text)) == rule_spans(text), text
    bits = ["token", "ſecret", "secret", "api_key", "APIKEY", "toKen", "=", " : ", '"', "'", "abc", "AKIA", "AB12CD34EF", "0a1b2c3d4e5f", "é", " ", "."]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        assert sorted(secret_scan.base_spans(text)) == secret_rules(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" * 100_000, "a@" * 100_000):
        pii.candidates(text, pii.base_spans(text))
        secret_scan.candidates(text, secret_scan.base_spans(text))


def test_lists_of_numbers_are_split():
    numbers = ["212-555-0147", "212-555-0148", "4111 1111 1111 1111", "5500 0000 0000 0004", "212-555-0149"]
    for some in (numbers[:2], numbers[2:4], numbers):
        text = "call " + " ".join(some)
        spans = pii.candidates(text, [])
        assert [text[a:b] for _, a, b in spans] == some
    assert len(pii.candidates("1" * 19, [])) == 1 and pii.candidates("1" * 20, []) == []


def test_estimated_reliability_follows_the_good_labelers():
    rng, counts = random.Random(2), {}
    truth = {}
    for _ in range(4000):
        y = rng.random() < 0.4
        say = lambda right: (1 if y else -1) if rng.random() < right else (-1 if y else 1)
        pattern = (say(0.95), say(0.9), say(0.55), 0)
        counts[pattern] = counts.get(pattern, 0) + 1
        truth.setdefault(pattern, []).append(y)
    belief = pii.estimate(counts, 50)
    agreed = {p: np.mean(ys) for p, ys in truth.items() if p[0] == p[1] and len(ys) > 100}
    assert len(agreed) >= 3 and all((belief[p] > 0.5) == (mean > 0.5) for p, mean in agreed.items())


def spanned(rows):
    return {(r.doc_id, tuple(map(tuple, r.base)), tuple(map(tuple, r.added))) for r in rows}


def test_gazetteers():
    assert [pii.calling_code(d) for d in ("12125550147", "442071234567", "4930123456", "35312345678", "8312345678",
                                          "0201234567", "1234567", "353123")] == [True] * 4 + [False] * 4
    assert [pii.card_network(d) for d in ("4" + "0" * 15, "2221" + "0" * 12, "2720" + "9" * 12, "34" + "0" * 13, "6449" + "0" * 12,
                                          "2721" + "0" * 12, "4" + "0" * 14, "1" * 16)] == [True] * 5 + [False] * 3
    assert [pii.reserved(v) for v in ("10.1.2.3", "172.31.0.1", "100.64.0.1", "203.0.113.9", "172.32.0.1", "8.8.8.8",
                                      "1.2.3", "300.1.1.1")] == [True] * 4 + [False] * 4
    assert [pii.top_level(v) for v in ("a@b.com", "a@b.JP", "a@b.photography", "a@b.123")] == [1, 1, 0, -1]


def test_a_long_base_span_is_seen():
    """A looser candidate inside a base span that many later ones follow."""
    text = "+" + "1 " * 7 + "212 555 0147 and " + " ".join(f"a{i}@b.com" for i in range(20))
    base = [("phone", 0, len(text))] + [("email", 30 + i, 33 + i) for i in range(20)]
    assert pii.candidates(text, base) == base


def test_recall_of_planted_personal_data(spark):
    """Numbers and spelled-out addresses outside the base rules, in whole test documents."""
    rng = random.Random(12)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    planted, rows = {}, []
    for doc_id, text in docs:
        text = text or ""
        if rng.random() < 0.1:
            local, digit = "".join(rng.choices("abcdefgh", k=6)), lambda n: "".join(rng.choices("123456789", k=n))
            value, lead = rng.choice([
                (f"{local} (at) {local}.org", " mail "), (f"({digit(3)}) {digit(3)}-{digit(4)}", " call ")])
            planted[doc_id] = (len(text + lead), len(text + lead + value))
            text = text + lead + value + " today"
        rows.append((doc_id, text))
    found = pii.find_personal_data(spark.createDataFrame(rows, DOCS.split(", lang")[0]).repartition(4)).collect()
    added = {r.doc_id: {(s.start, s.stop) for s in r.added} for r in found}
    caught = sum(place in added[d] for d, place in planted.items()) / len(planted)
    assert len(planted) > 50 and caught >= 0.9, caught


def test_personal_data_in_a_table(spark):
    rng = random.Random(3)
    rows = [(i, f"call me at +1 (212) 555-0{rng.randint(100, 999)} or mail a{i}@b.com or {rng.randint(1000, 9999)} total {i}.5") for i in range(60)]
    rows += [(100, "phone (212) 555-0147 please"), (101, "write to jo (at) example.com"), (102, None), (103, ""), (None, "x@y.org"), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, DOCS).select("*", F.lit(1).alias("base"), F.lit(2).alias("kind"))
    found = pii.find_personal_data(docs).collect()
    assert len(found) == len(rows)
    want = {d: rule_spans(t or "") for d, t in rows}
    assert all(sorted(map(tuple, r.base)) == want[r.doc_id] for r in found)
    out = pii.digest_spans(pii.find_personal_data(docs), pii.KINDS, pii.KINDS).filter("doc_id = 3").first()
    assert (out.n_email, out.n_phone, out.base_sha256) == (1, 1, digest(want[3], pii.KINDS))
    assert pii.find_personal_data(docs.limit(0)).collect() == []


def test_secrets_in_a_table(spark):
    rng = random.Random(4)
    key = lambda n, a="0123456789abcdef": "".join(rng.choice(a) for _ in range(n))
    rows = [(i, f"some words internationalization-of-things token = \"{key(40)}\" more") for i in range(80)]
    rows += [(i, "plain antidisestablishmentarianism and THEENTIREWORDISHERE words") for i in range(100, 180)]
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows += [(500, f"some words key = \"{key(40, letters)}\" more"), (501, None), (502, ""), (None, "AKIA" + "Q" * 20), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, DOCS).select("*", F.lit(1).alias("window"), F.lit(2).alias("more"))
    found = {r.doc_id: r for r in secret_scan.find_secrets(docs).collect()}
    assert all(sorted(map(tuple, found[d].base)) == secret_rules(t or "") for d, t in rows)
    assert len(found[500].added) == 1 and not any(found[i].added for i in range(100, 180))
    assert secret_scan.find_secrets(docs.limit(0)).collect() == []
    clean = docs.filter("doc_id = 100")
    assert [len(r.added) for r in secret_scan.find_secrets(clean).collect()] == [0]


def test_spans_are_written_in_order():
    spans = [("hex", 4, 9), ("assign", 4, 20), ("access", 0, 3)]
    assert written(spans, secret_scan.KINDS) == "access:0:3,assign:4:20,hex:4:9"


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    known = score_toxicity(docs.join(labels.select("doc_id"), "doc_id"), labels).join(labels, "doc_id")
    rows = [r for r in known.collect() if r.held_out]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out for r in rows)
    toxic, clean = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    assert np.mean([r.predicted for r in toxic]) > 0.75 and np.mean([r.predicted for r in clean]) < 0.01


def test_toxicity_of_odd_tables(spark):
    rows = [(i, "you are an awful beast" if i % 2 else "a calm and kind day") for i in range(60)]
    rows += [(200, None), (201, ""), (None, "awful"), (1, rows[1][1])]
    docs = spark.createDataFrame(rows, DOCS).select("*", F.lit(1).alias("draw"), F.lit(2).alias("toxic"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, 1), (5, None), (None, 1)], "doc_id long, toxic int")
    p = Ftrl(l1=0.5)
    found = score_toxicity(docs, labels, p).collect()
    score = {r.doc_id: r.score for r in found}
    assert len(found) == 64 and score[31] > 0.5 > score[30] and score[200] == score[201]
    assert [r.score for r in score_toxicity(docs.limit(2), labels.limit(0), p).collect()] == [0.5, 0.5]
    assert score_toxicity(docs.limit(0), labels, p).collect() == []
    assert spark.range(1).select(held_out(F.lit(None).cast("long"))).first()[0] is True


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h2>Site</h2><a href=x>Home</a></header>
<div id="cookie-notice">We use cookies. Accept them all now please.</div><nav><ul><li><a href=1>One</a></li></ul></nav>
<aside><p>Popular posts this week are here.</p></aside><article><h1>Big  news</h1><p>The cat sat on the <a href=y>mat</a>
&amp; slept.<br>It was <b>long</b>.<p>Second para with x &lt; y &eacute;.<ul><li>First point</li></ul><script>var a="</p>";</script>
<form><label>Search</label></form><div class="comments"><p>Nice article, thanks!</p></div></article><footer>&copy; 2020</footer>"""


def test_pages(spark):
    want = "Big news The cat sat on the mat & slept. It was long. Second para with x < y é. First point"
    rows = [(1, "u", PAGE), (2, "v", None), (3, None, ""), (4, "w", "<p>cut off <b"), (None, "x", PAGE), (1, "u", PAGE)]
    rows += [(10 + i, "u", PAGE.replace("cat", f"cat{i}")) for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").select("*", F.lit(1).alias("text"), F.lit(2).alias("sure"))
    found = extract_main_text(pages).collect()
    text = {r.page_id: r.text for r in found}
    assert len(found) == len(rows) and text[1] == text[None] == want and text[2] == text[3] == ""
    assert all(r.n_chars == len(r.text) for r in found) and "cat7" in text[17]
    assert extract_main_text(pages.limit(0)).collect() == []


@pytest.mark.parametrize("outer", [
    "content-area has-sidebar", "layout with-sidebar", "no-comments", "sticky-header", "page widget", "site-main toolbar-top",
])
def test_layout_classes_do_not_lose_the_article(spark, outer):
    want = "Big news The cat sat on the mat & slept. It was long. Second para with x < y é. First point"
    framed = PAGE.replace("<article>", f'<div class="{outer}"><article>').replace("</article>", "</article></div>")
    rows = [(1, "u", framed)] + [(10 + i, "u", PAGE.replace("cat", f"cat{i}")) for i in range(30)]
    found = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert found.filter("page_id = 1").first().text == want


@pytest.fixture(scope="module")
def fitted(spark):
    """Weights from the pages that the query reads, not from these tests' own."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    return fit_blocks(pages, Extraction())


NOISE = ("It is a long and quiet paragraph of plain words, such as any writer would put into an article. "
         "It has several sentences. Each of them ends as a sentence should end.")
GOOD = [f"The story goes on for a while in paragraph {i}, with words enough to look like one." for i in range(3)]
AROUND = ["nav", "header", "footer", "aside", "form", 'div class="comments"', 'section id="comments"', 'div class="cookie-notice"',
          'div class="advert"', 'div class="sidebar"', 'div id="related-posts"', 'div class="newsletter-signup"']


@pytest.mark.parametrize("outer", AROUND)
@pytest.mark.parametrize("inner", ["<p>{}</p>", "<article><p>{}</p></article>", "<div><div><p>{}</p><p>{}</p></div></div>"])
def test_paragraphs_of_boilerplate_stay_out(fitted, outer, inner):
    story = "<article>" + "".join(f"<p>{g}</p>" for g in GOOD) + "</article>"
    noise = f"<{outer}>{inner.replace('{}', NOISE)}</{outer.split()[0]}>"
    want = " ".join(GOOD)
    for body in (noise + story, story + noise, noise + story + noise, f"<div><main>{story}</main>{noise}</div>"):
        page = f"<html><body>{body}</body></html>"
        assert main_text(page, fitted, Extraction()) == want
    assert main_text(f"<body>{noise}</body>", fitted, Extraction()) == ""


def test_boilerplate_inside_an_article_stays_out(fitted):
    body = f"<article><p>{GOOD[0]}</p><aside><p>{NOISE}</p></aside><p>{GOOD[1]}</p><div class='ad'>{NOISE}</div></article>"
    assert main_text(body, fitted, Extraction()) == " ".join(GOOD[:2])


def test_distances_are_those_of_the_tree():
    """Against paths of element numbers, on random markup."""
    rng = random.Random(8)
    for _ in range(200):
        parts, open_, paths, number = [], [], [], 0
        for _ in range(rng.randrange(30)):
            move = rng.random()
            if move < 0.4:
                number += 1
                open_.append(number)
                parts.append("<div>")
            elif move < 0.7 and open_:
                open_.pop()
                parts.append("</div>")
            else:
                parts.append("<b>w</b> ")
                if not paths or paths[-1] != tuple(open_) or parts[-2] in ("<div>", "</div>"):
                    paths.append(tuple(open_))
        blocks = blocks_of("".join(parts))
        assert len(blocks) == len(paths)
        for step in (1, 2):
            for i in range(len(blocks) - step):
                a, b = paths[i], paths[i + step]
                shared = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                assert tree_distance(blocks, i, step) == len(a) + len(b) - 2 * shared


@pytest.mark.parametrize("page", [
    "<div>word" * 60_000, "<b>word<p>" * 50_000, "<p>a</q></div>" * 100_000, "<a href='x' title=\"y\">w</a> " * 150_000,
    "<a b" + "   '" * 200_000 + ">", "<p>" + "word " * 1_000_000,
], ids=["deep", "inline", "unmatched", "quotes", "stray", "long"])
def test_large_pages_take_linear_time(fitted, page):
    start = time.perf_counter()
    blocks_of(page)
    assert time.perf_counter() - start < 5


def test_broken_pages_end():
    for page in ("<" * 50_000, "<a \"" * 20_000, "<!--", "<script>", "<p" * 20_000, "&" * 50_000, "<div>" * 5_000 + "x", "<a href='"):
        assert isinstance(main_text(page, np.zeros(len(features(Block(0, 0, 0.0, 0, "x")))), Extraction()), str)
    assert " ".join(b.text for b in blocks_of("a<p>b<td>c</p>d</div>e")).split() == ["a", "b", "c", "de"]


@pytest.mark.parametrize("seed", range(40))
def test_cut_is_cheapest(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 8)
    gain = [rng.choice([0.0, rng.uniform(-3, 3)]) for _ in range(n)]
    ties = [(i, j, rng.uniform(0, 2)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5]

    def cost(side):
        return sum(max(g, 0) if not s else max(-g, 0) for g, s in zip(gain, side)) + sum(w for a, b, w in ties if side[a] != side[b])

    best = min(cost(s) for s in itertools.product([True, False], repeat=n))
    assert cost(minimum_cut(gain, ties)) == pytest.approx(best, abs=1e-6)
