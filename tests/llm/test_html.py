"""Main text of pages of several layouts, against the articles that they were made from."""

from __future__ import annotations

import random
import time

from eventmart.llm import html_extraction
from eventmart.llm.html_text import parse

SCHEMA = "page_id long, url string, html string, article string, host string"


def run(spark, pages):
    rows = [(k, url, html, "taken", "taken") for k, (url, html) in enumerate(pages)]
    out = html_extraction.extracted(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(out) == len(pages) and {r.article for r in out} <= {"taken"}
    return [r.article_ for r in sorted(out, key=lambda r: r.page_id)]


def prose(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randrange(1000)) for _ in range(n))


LAYOUTS = {
    "names": '<html><head><title>T</title><script>if (a < b) document.write("</p>")</script></head><body class="has-sidebar"><!-- <p>no</p> --><nav><ul><li><a href=/>Home</a><li><a href=/b>B</a></ul></nav><div class="ad">Buy {junk}</div><article><h1>{0}</h1><p>{1}<p>{2}<aside>See {junk}</aside><div id="comments"><p>{comment}</div></article><footer>&copy; {junk}</footer>',
    "bare": '<body><div class=x1><p>Menu of the site</p><p><a href=1>One {junk}</a> <a href=2>Two</a></p></div><div class="c q7"><div><h2>{0}</h2><p>{1}</p><ul><li>{2}</li></ul></div></div><div class=x2><p>All the world reads our pages, and so should you, dear reader, every day of the year.</p></div></body>',
    "mixed": '<body><header><h1>The Site</h1>Since 1999</header><main><header><h1>{0}</h1><span>by {junk}</span></header><section><p>{1}</p></section><section><table><tr><td>{2}<td></table></section><form><p>Search <input><button>Go {junk}</button></form><section class="comment-list"><p>{comment}</p></section></main><div id="cookie-notice">We use {junk}</div></body>',
}


def test_layouts(spark):
    rng = random.Random(8)
    pages, want = [], []
    for n, (name, layout) in enumerate(LAYOUTS.items()):
        for k in range(12):
            text = [prose(rng, 5), prose(rng, rng.choice([20, 60])), prose(rng, 30)]
            html = layout
            for slot, value in (("{0}", text[0]), ("{1}", text[1]), ("{2}", text[2]), ("{junk}", prose(rng, 4)), ("{comment}", prose(rng, 40))):
                html = html.replace(slot, value)
            pages.append((f"HTTP://me@{name}.example.com:80/{k}?x={n}", html))
            want.append("\n".join(text))
    assert run(spark, pages) == want
    for page, text in list(zip(pages, want, strict=True))[:12] + list(zip(pages, want, strict=True))[24:]:  # alone, by its own structure
        assert html_extraction.article(parse(page[1]), None, set(), set()) == text


def test_template_texts_are_told_from_copies(spark):
    """A notice on all pages is the template's; an article that many pages repeat, and a passage that some share, are not."""
    rng = random.Random(9)
    same, shared = prose(rng, 50), prose(rng, 30)
    body = "<body><div><p>{}</p><p>Read on with our paper edition.</p></div></body>"
    texts = [same] * 20 + [prose(rng, 40) + "</p><p>" + shared for _ in range(6)] + [prose(rng, 40) for _ in range(6)]
    got = run(spark, [("http://a.example", body.format(t)) for t in texts])
    assert got == [t.replace("</p><p>", "\n") for t in texts]
    # where all pages are copies, nothing tells the template from the article
    got = run(spark, [("http://b.example", body.format(same))] * 10)
    assert got == [same + "\nRead on with our paper edition."] * 10


def test_pages_of_any_kind(spark):
    pages = [
        (None, None), (None, ""), ("http://x.example", "   "), ("odd", "no tags at all"), ("http://x.example", "<p>a &amp; b&nbsp;&lt;c&#62; &quo &amp d"), ("http://x.example", "<nav>only</nav>"),
        ("//y.example/1", "<article><p>one<br>two <b>three\n\n four</b><p>five</article><article>six</article>"), ("//y.example/1", "<article><p>one<br>two <b>three\n\n four</b><p>five</article><article>six</article>"),
        ("http://z.example", '<p title="a > b">kept</p><p title=">lost quote>text</p><p>after'), ("http://z.example", "<script>never closed <p>x"), ("http://z.example", "<div hidden>no</div><div style='display: none'>no</div><p>yes</p><!-- open <p>no"),
        ("http://z.example", "</div></p><p>stray</p></article>"), ("http://z.example", "a < b and c <3 d"),
    ]
    got = run(spark, pages)
    assert got[:4] == ["", "", "", "no tags at all"] and got[4] == "a & b <c> &quo & d" and got[5] == ""
    assert got[6] == got[7] == "one two three four\nfive\nsix"
    assert got[8].startswith("kept") and got[9] == "" and got[10] == "yes" and got[11] == "stray" and got[12] == "a < b and c <3 d"
    assert html_extraction.extracted(spark.createDataFrame([], SCHEMA)).count() == 0


def test_classes_that_do_not_nest_are_not_valid(spark):
    """x and z stand around y and w crosswise: neither lies in a slot of the other."""
    html = "<body><i></i><p class=x>1</p><p class=y>2</p><p class=z>3</p><p class=w>4</p></body>"
    page = parse(html)
    role = {tag: r for r, _, tag, _ in page.elements}
    p = [r for r, _, tag, _ in page.elements if tag == "p"]
    crossed = {own: n for own, _, _, n in html_extraction.rounds_of(page, {p[0]: 1, p[2]: 1, p[1]: 2, p[3]: 2})}
    assert crossed[1] + crossed[2] > 0
    nested = html_extraction.rounds_of(page, {p[0]: 1, p[3]: 1, p[1]: 2, p[2]: 2, role["body"]: 3})
    assert all(order and slot and not n for _, order, slot, n in nested)
    changed = html_extraction.rounds_of(parse("<ul><li class=a>1<li class=b>2<li class=b>3<li class=a>4</ul>"), {r: 5 for r, _, tag, _ in parse("<ul><li class=a>1<li class=b>2</ul>").elements if tag == "li"})
    assert changed[0][1] == 0  # another order in the second round


def test_long_pages_take_linear_time():
    began = time.time()
    for html in ("<div>" * 20_000 + "x" + "</p>" * 20_000, "<a '" * 50_000, "<li>x" * 20_000, "</section>" * 50_000, "<p>" + "word " * 400_000, "<b>" * 100_000, "&amp;" * 200_000, "<!--" * 50_000):
        parse(html)
    assert time.time() - began < 20
