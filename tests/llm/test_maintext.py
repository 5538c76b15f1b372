"""Main text: hand-made pages, and minimum cuts against all labellings."""

import itertools
import random

from airlattice.llm import maintext as M

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Home page of the site.</a></li></ul></nav><!-- <p>hidden</p> -->
<div class="ad">Buy this now, it is very cheap and very good.</div>
<article><h1>A &amp; B</h1><p>First  paragraph with <b>bold</b>ly
 joined&nbsp;words.<br>Second line.<p>Short.<p>Third &lt;x&gt; paragraph has enough words to be kept as text.</p>
<form><p>Type your name here please.</p></form></article>
<div class="comments"><div><p>I am a reader and I write a very long comment, with many words. It goes on and on.</p></div></div>
<aside>Related things to read on this fine site today.</aside><footer>&copy; Site 2024</footer></body></html>"""


def test_article_only():
    assert M.main_text(PAGE) == "\n\n".join([
        "A & B", "First paragraph with boldly joined words. Second line.", "Short.",
        "Third <x> paragraph has enough words to be kept as text."])


def test_class_words_are_evidence():
    one = "The first paragraph of this page says a number of things, and it says them at some length."
    two = "The second paragraph goes on from there, with as many words and with no links at all in it."
    both, body = f"{one}\n\n{two}", f"<p>{one}</p><p>{two}</p>"
    for page in [f"<body class='has-sidebar'>{body}</body>", f"<body class='sidebar comments'>{body}</body>",
                 f"<article class='post no-comments'>{body}</article>", f"<article id='comments'>{body}</article>",
                 f"<div class='content with-sidebar'>{body}</div>", f"<div class='sidebar'><main>{body}</main></div>",
                 f"<div class='widget'>{body}</div>", f"<div class='widget'><article>{body}</article></div>",
                 f"<div class='form-group'><p>{one}</p></div><div class='social-policy'><p>{two}</p></div>",
                 f"<div class='tags-politics'><p>{one}</p></div><div><p>{two}</p></div>"]:
        assert M.main_text(page) == both, page
    for name in ("entry-header", "header"):
        assert M.main_text(f"<article><header class='{name}'><h1>A title</h1></header>{body}</article>") == f"A title\n\n{both}"
    chrome = "<p>I am a reader and I write a long comment, with many words. It goes on and on and on and on.</p>" * 4
    for name in ("comments", "comment-list", "sidebar", "related", "site-footer"):
        assert M.main_text(f"<article>{body}</article><div class='{name}'>{chrome}</div>") == both, name
        assert M.main_text(f"<div>{body * 3}</div><div class='{name}'>{chrome}</div>") == "\n\n".join([both] * 3), name
    assert M.main_text(f"<article>{body}</article><div id='comments'><article class='comment'>{chrome}</article></div>") == both
    assert M.main_text(f"<article>{body * 3}</article><div class='related'><article>{chrome}</article></div>") == "\n\n".join([both] * 3)
    assert M.main_text(f"<article>{body}<div class='ad'>Buy this now, it is very cheap.</div></article>") == both


def test_odd_pages():
    assert M.main_text(None) == M.main_text("") == M.main_text("<p> </p>") == M.main_text("<script>x") == ""
    long = " ".join(f"word{k}" for k in range(50_000))
    assert M.main_text(f"<article><p>{long}") == long
    plain = "<div><p>" + "Plain words make up this text, sentence by sentence, without end. " * 3 + "</p></div>"
    assert M.main_text(f"<nav>Menu</nav>{plain}<!-- open").startswith("Plain words")
    assert M.main_text("<article><p>a < b and c > d</p></article>") == "a < b and c > d"
    assert M.main_text("<table>" * 2000 + "deep") in ("", "deep")


def test_minimum_cut_is_minimal():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(1, 8)
        source, sink = [rng.uniform(0, 3) for _ in range(n)], [rng.uniform(0, 3) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]

        def cost(keep):
            return (sum(s for s, k in zip(source, keep) if not k) + sum(t for t, k in zip(sink, keep) if k)
                    + sum(c for a, b, c in edges if keep[a] != keep[b]))
        best = min(map(cost, itertools.product([False, True], repeat=n)))
        assert abs(cost(M.minimum_cut(source, sink, edges)) - best) < 1e-6


def test_frame(shipped):
    df = shipped.createDataFrame([(1, None, 0), (2, "", 0), (3, PAGE, 0), (3, PAGE, 0)], "page_id INT, html STRING, MAIN_text INT")
    out = M.extract_main_text(df)
    assert out.columns == ["page_id", "html", "MAIN_text", "main_text_1"]
    assert sorted(len(r["main_text_1"]) for r in out.collect()) == [0, 0, *[len(M.main_text(PAGE))] * 2]
    assert M.extract_main_text(df.limit(0)).count() == 0
