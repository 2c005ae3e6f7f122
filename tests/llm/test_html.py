import math
import re
import time
import tracemalloc

import pytest

from fableloom.llm import html_extract
from fableloom.llm.html_extract import REACH, chosen_paths, cut_page, extract_pages, main_text, path_ratios

PAGE = """<!DOCTYPE html><html><head><title>No &amp; title</title><style>p{}</style></head><body>
<nav><ul><li><a href=/a>Home, sweet home</a><li><a href=/b>News</a></ul></nav><!-- ad <p>x</p> --><div class="ad-box">Buy now, it is cheap!</div>
<article><h1>Head &amp; line</h1><p>First <b>bold<br>part</b>, with  a <a href=x>link</a>.<p>Second&nbsp;one; it is longer, and it ends &lt;here&gt;.</p>
<script>var t="</p><p>no";</script><ul><li>Point one.<li>Point two.</ul></article>
<aside>Side text, quite long, with commas, and more of it.</aside><section id="comments"><article><p>I liked this, a lot, really, yes!</p></article></section>
<form>Your mail, please</form><footer>&copy; me</footer></body></html>"""
WANTED = "Head & line\n\nFirst bold part, with a link.\n\nSecond one; it is longer, and it ends <here>.\n\nPoint one.\n\nPoint two."
#: No names, roles or tags that say what a part is.
BARE = """<html><body><div><ul><li><a href=a>Home page</a><li><a href=b>Latest news</a><li><a href=c>About</a></ul></div><div>Buy two, get one.</div>
<div><h1>The heading</h1>{body}</div><div><ul><li><a href=x>Terms</a><li><a href=y>Contact</a></ul></div><div>All rights reserved.</div></body></html>"""
BODY = "".join(f"<p>Paragraph {i}, which tells a part of the story, and does so at some length, with commas; it ends here.</p>" for i in range(6))


def test_article():
    assert main_text(PAGE) == WANTED
    assert main_text(PAGE[: PAGE.index("</article>")]) == WANTED


@pytest.mark.parametrize(
    ("source", "wanted"),
    [
        (None, ""),
        ("", ""),
        ("plain text only", "plain text only"),
        ("<p>a < b & c<p>d", "a < b & c\n\nd"),
        ("<div><p>Unclosed <i>here", "Unclosed here"),
        ("<nav>Menu</nav>", ""),
        ("<script>never ends", ""),
        ("<article><p>One, two.</p><p", "One, two."),
        ("<div class=content><p>Text one, long enough.</p></div><div class=sidebar><p>Other</p></div>", "Text one, long enough."),
        ('<div class="share-price"><p>The share price rose, and then it fell.</p></div>', "The share price rose, and then it fell."),
        ('<article><h1 class="post-header">Head</h1><p class="legal-news">A long enough text, it seems.</p></article>', "Head\n\nA long enough text, it seems."),
    ],
)
def test_broken_pages_and_names(source, wanted):
    assert main_text(source) == wanted


def plain_ratios(page):
    """Sums, smoothing and fusing of path ratios, block by block and straight from the text of the docstring."""
    blocks = page.blocks

    def ancestors(b):
        out, e = set(), b.element
        while e:
            out.add(e)
            e = page.parents[e]
        return out

    def ratio(b, value):
        own = [x for x in blocks if x.path == b.path]
        return sum(map(value, own)) / len(own)

    kernel = [math.exp(-0.5 * k * k) for k in range(REACH + 1)]
    whole = kernel[0] + 2 * sum(kernel[1:])

    def smoothed(i, value):
        total = 0.0
        for j in range(max(0, i - REACH), min(len(blocks), i + REACH + 1)):
            a, b = ancestors(blocks[i]), ancestors(blocks[j])
            like = (2 * len(a & b) + 1) / (len(a) + len(b) + 1)
            total += kernel[abs(i - j)] / whole * like * ratio(blocks[j], value)
        return total

    best = {}
    for i, b in enumerate(blocks):
        f = smoothed(i, lambda x: len(x.text) - x.linked) * (1 + smoothed(i, lambda x: len(re.findall(r"[.,;:!?]", x.text))))
        best[b.path] = max(best.get(b.path, 0.0), 0.0 if b.path in page.marked else f)
    return best


@pytest.mark.parametrize("source", [PAGE, BARE.format(body=BODY), "<p>One, <a href=x>two</a>.<ul><li>x<li>y<ul><li>z.</ul></ul>tail", "<div class=ad>Ad!</div><b>x</b>"])
def test_ratios_against_plain_sums(source):
    page = cut_page(source)
    found, wanted = path_ratios(page), plain_ratios(page)
    assert all(found[p] == pytest.approx(f) for p, f in wanted.items())
    top = max(wanted.values())
    assert chosen_paths(page) == {p for p, f in wanted.items() if f > 0 and f >= 0.3 * top}


def test_paths_decide_without_names_and_semantic_tags(monkeypatch):
    wanted = "The heading\n\n" + "\n\n".join(re.findall("<p>(.*?)</p>", BODY))
    source = BARE.format(body=BODY)
    assert main_text(source) == wanted
    monkeypatch.setattr(html_extract, "chosen_paths", lambda page: {b.path for b in page.blocks})
    assert main_text(source) != wanted  # it is the ratios that set the rest aside


def test_text_around_the_largest_part_and_link_lists():
    part = "".join(f"<p>Sentence {i}, which has some words, and more.</p>" for i in range(20))
    head = "<h1>The heading, as it is</h1><p>A lead that says, in short, what follows.</p>"
    found = main_text(f"<body><div>{head}<section>{part}</section></div></body>")
    assert found.startswith("The heading, as it is\n\nA lead that says, in short, what follows.\n\nSentence 0") and "Sentence 19" in found
    quoted = main_text(f"<body><div><p>Before it, some words.</p><blockquote>{part}</blockquote><p>After it, some words.</p></div></body>")
    assert quoted.startswith("Before it") and quoted.endswith("After it, some words.")
    listed = main_text(f"<article>{part}<ul><li><a href=a>First reference</a><li><a href=b>Second reference</a></ul></article>")
    assert listed.endswith("First reference\n\nSecond reference")
    assert main_text(f"<body><h1>Title</h1>{part}<h2>More</h2>{part}<h3>Links</h3><div><ul><li><a href=a>x</a></ul></div></body>").count("\n\n") == 41


def test_long_and_deep_pages():
    blocks = [f"Paragraph {i}, which has some words." for i in range(4000)]
    assert main_text("<body><article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>") == "\n\n".join(blocks)
    tracemalloc.start()
    began = time.process_time()
    assert main_text("<div>x, y." * 50_000).count("\n\n") == 49_999
    assert main_text("<div>" * 50_000 + "<p>One, two.</p></span></section>" * 50_000).count("\n\n") == 49_999
    assert time.process_time() - began < 60 and tracemalloc.get_traced_memory()[1] < 300e6
    tracemalloc.stop()


def test_rows(spark, clashing):
    own = spark.createDataFrame([(1, "u", PAGE), (1, "u", PAGE), (None, None, None)], "page_id long, url string, html string")
    found = extract_pages(clashing(own)).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in found) == sorted([("1", WANTED, len(WANTED))] * 2 + [("None", "", 0)])
    assert extract_pages(own.limit(0)).count() == 0
