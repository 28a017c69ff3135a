from __future__ import annotations

import html
import math
import random
import time

from millrace.llm.html_extract import blocks, extract_text, main_text, select

LONG = "This sentence is here, as others are, to be read; it goes on. And on it goes, with marks."


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T, t.</title>{head}</head><body>{body}</body></html>"


def test_article_among_other_things():
    body = f"""<header><h1>Site, name.</h1></header><nav><ul><li><a href="/a">One</a></li><li><a href='/b?x="1>2"'>Two</a></li></ul></nav>
    <div class="cookie-notice"><p>{LONG} {LONG}</p></div><form><p>{LONG}</p><input name=q></form><!-- <p>no</p> -->
    <article><h1>Title &amp; more</h1><p>{LONG}<p>Short.<div><b>Bold</b> and&nbsp;
      <i>it</i>alic<br>next</div><aside><p>{LONG}</p></aside><script>var a = "<p>{LONG}</p>";</script><style>p > a {{}}</style></article>
    <section id="comments"><p>{LONG}</p><p>{LONG}</p></section><div class="sidebar"><p>{LONG}</p></div><footer><p>{LONG}</p></footer>"""
    assert main_text(page(body)) == "\n".join(["Title & more", LONG, "Short.", "Bold and italic next"])


def test_pages_without_an_article_element():
    paragraphs = [LONG + f" Number {i}." for i in range(6)]
    body = "<ul class=menu><li><a href=/>Home</a></ul><div class=content><h2>Head</h2>" + "".join(f"<p>{p}</p>" for p in paragraphs)
    body += "</div><div class='ad-box'>Buy, buy, buy. Now! Buy, buy, buy. Now! Buy, buy, buy. Now!</div>"
    assert main_text(page(body)) == "\n".join(["Head", *paragraphs])


def test_broken_pages():
    assert main_text("<html><body><article><p>One, two.<p>Three &lt; four &am") == "One, two.\nThree < four &am"
    assert main_text("<article><p>Text, text.</p><script>never ends <p>x</p>") == "Text, text."
    assert main_text("plain text, without tags") == "plain text, without tags"
    assert main_text("<article><p>a < b and c</p></span></p>") == "a < b and c"
    assert main_text("<") == "<"
    for text in (None, "", "  ", "<p>", "<!--", "<article></article>", "<nav>a, b.</nav>", "<a b='"):
        assert main_text(text) == ""


def test_nothing_of_an_article_is_lost():
    draw = random.Random(1)
    for _ in range(60):
        texts = [" ".join("".join(draw.choice("ab.é&<") for _ in range(draw.randint(1, 9))) for _ in range(draw.choice([1, 2, 9, 80])))
                 for _ in range(draw.randint(1, 12))]
        body = "<nav><a href=/>x</a></nav><article>" + "".join(f"<p>{html.escape(t)}</p>" for t in texts) + "</article><footer>f, f.</footer>"
        assert main_text(page(body)) == "\n".join(" ".join(t.split()) for t in texts)


def test_names_inside_an_article_do_not_drop_its_text():
    body = f"""<nav><a href=/>x</a></nav><article><h1 id="notice">Title</h1><p>{LONG}</p><h2 id="related-work">Related work</h2>
    <p class="form-text">{LONG} One.</p><section id="legal-history"><h2 id="search">Search</h2><p>{LONG} Two.</p></section>
    <figure><img src=a><figcaption>A figure, shown.</figcaption></figure><p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p>
    <object data=a><p>Instead, this.</p></object><div class="share"><p>{LONG}</p></div><div role="note complementary"><p>{LONG}</p></div>
    <div class="share-buttons"><a href=/s>Post</a></div></article>"""
    assert main_text(page(body)) == "\n".join([
        "Title", LONG, "Related work", LONG + " One.", "Search", LONG + " Two.", "A figure, shown.", "So x=1 holds.", "Instead, this."])
    paragraphs = "".join(f"<p>{LONG}</p>" for _ in range(5))
    assert "Copyright law" in main_text(page(f"<div class=text><h2 id=copyright-law>Copyright law</h2>{paragraphs}</div>"))


def test_table_of_pages(spark):
    long = page("<article><p>" + "word, " * 100_000 + "</p></article>")
    rows = [(1, "u", page(f"<article><p>{LONG}</p></article>"), "t"), (1, "u", None, "t"), (None, None, "", "t"), (2, "u", long, "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = [(r.page_id, r.url, r.text[:3], r.n_chars) for r in extract_text(df).collect()]
    assert sorted(found, key=repr) == sorted([(1, "u", "Thi", len(LONG)), (1, "u", "", 0), (None, None, "", 0), (2, "u", "wor", 599_999)], key=repr)
    assert extract_text(df.limit(0)).collect() == []


def test_names_inside_an_article_do_not_decide():
    text = f"{LONG} {LONG}"
    body = f"""<article><header><h1>Own title</h1></header><p>{text}</p><p class="related">{text}</p><section class="notice-history"><p>{text}</p></section>
    <p>{text}</p><div class="share"><span>Tweet</span></div><div class="comments"><p>{text}</p></div></article>"""
    assert main_text(page(body)) == "\n".join(["Own title", text, text, text, text])


def plain_ratios(found):
    """The blocks that are content, worked out block by block from the written-out paths."""
    paths = [str(b.path) for b in found]
    mean = {p: [sum(f(b.text) for b, q in zip(found, paths, strict=True) if q == p) / paths.count(p)
                for f in (len, lambda t: sum(t.count(c) for c in ".,;:!?…。，、；：！？"))] for p in paths}
    def smooth(k, i):
        near = [(math.exp(-0.5 * (j - i) ** 2), mean[paths[j]][k]) for j in range(max(0, i - 2), min(len(found), i + 3))]
        return sum(w * v for w, v in near) / sum(w for w, _ in near)
    n = len(found)
    along = [[smooth(k, i) if n >= 5 else mean[paths[i]][k] for i in range(n)] for k in (0, 1)]
    fused = [a * (1 + b) for a, b in zip(*along, strict=True)]
    middle = sum(fused) / n
    least = 0.6 * math.sqrt(sum((f - middle) ** 2 for f in fused) / n)
    value = {p: sum(f for f, q in zip(fused, paths, strict=True) if q == p) / paths.count(p) for p in paths}
    inside = [p for p in dict.fromkeys(paths) if any(not b.outside for b, q in zip(found, paths, strict=True) if q == p)]
    if not inside:
        return []
    best = max(inside, key=lambda p: value[p] * paths.count(p))
    content = {p for p in inside if value[p] >= least and value[p] >= 0.1 * value[best]} | {best}
    def article(steps):
        ends = [i for i, s in enumerate(steps, 1) if s.split(".")[0] in ("article", "main")]
        return steps[:ends[-1]] if ends else None
    steps = best.split("/")[:-1]
    container = article(steps) or steps
    chosen = []
    for b, p in zip(found, paths, strict=True):
        own = mean[p][0] * (1 + mean[p][1])
        last = p.split("/")[-1]
        if b.outside or (b.kind == 1 and own < least and last.split(".")[0] not in ("h1", "h2", "h3", "h4", "h5", "h6")):
            continue
        if container and container[-1] not in ("", "html", "body"):
            inner = p.split("/")[:len(container)] == container and len(p.split("/")) > len(container)
            if inner or (p in content and (article(container) is None or article(p.split("/")) is not None)):
                chosen.append(b)
        elif p in content or last[:1] == "h":
            chosen.append(b)
    return chosen


def test_ratios_equal_a_plain_second_form():
    draw = random.Random(12)
    for _ in range(300):
        def some(depth):
            if depth == 0 or draw.random() < 0.4:
                return f"<p class={draw.choice('abc')}>{draw.choice([LONG, 'Short.', 'one two', LONG * 3])}</p>"
            tag = draw.choice(["div", "div class=x", "section", "article", "main", "nav", "ul", "header", "div class=related"])
            inner = "".join(some(depth - 1) for _ in range(draw.randint(1, 4)))
            return f"<{tag}>{inner}</{tag.split()[0]}>"
        found = blocks("<html><body>" + "".join(some(3) for _ in range(4)) + "</body></html>")
        values = {round(sum(len(b.text) for b in found if b.path is p) / sum(b.path is p for b in found), 3) for p in {b.path for b in found}}
        if len(values) > 1:
            assert [b.text for b in select(found)] == [b.text for b in plain_ratios(found)]


def test_deep_and_unclosed_markup_is_read_in_linear_time():
    for tag in ("div", "button", "p", "li", "span", "select", "section"):
        started = time.process_time()
        main_text(f"<{tag}>word. " * 100_000)
        assert time.process_time() - started < 10, tag
