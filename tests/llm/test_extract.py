from loomcat.llm import extract


def test_held_out_pages_are_labelled():
    lab = extract.Labeller(extract.trained())
    data = extract.training_pages(80, 4321)
    got = lab.main_blocks([b for b, _ in data])
    wanted = [[b.text for b, y in zip(blocks, labels, strict=True) if y] for blocks, labels in data]
    blocks = sum(len(b) for b, _ in data)
    wrong = sum(len(set(g) ^ set(w)) for g, w in zip(got, wanted, strict=True))
    assert wrong <= 0.02 * blocks


def test_blocks_and_references():
    page = '<nav><a href="x">Menu</a></nav><article><h1>A &amp; B&copy;</h1><p>one\n <b>two<br>three<p>four</article><script>var a = "<p>no</p>";</script><!-- <p>no --><style>p{}'
    assert [(b.text, b.path) for b in extract.blocks_of(page)] == [("Menu", ("nav",)), ("A & B©", ("article", "h1")), ("one two three", ("article", "p")), ("four", ("article", "p"))]
    assert extract.blocks_of("")[0:] == []
    assert extract.blocks_of('<p title="a > b">x</p><p class="unclosed>y')[0].text == "x"
    assert extract.blocks_of("<ul><li>a<li>b</ul>")[1].path == ("ul", "li")


def test_only_skipped_elements_are_skipped():
    texts = lambda page: [b.text for b in extract.blocks_of(page)]
    for icon in ('<svg-icon x="1"></svg-icon>', "<title-bar>", "<object-view/>", '<svg class="i"/>', "<svg/>", '<svg class="i">', '<object data="x">', "<canvas>", "<noscript>", "<template>"):
        assert texts(f"a{icon}<p>b</p>") == ["a", "b"], icon
    for tag in ("script", "style", "textarea", "title", "iframe"):
        assert texts(f"a<{tag}>x<p>b</p>") == ["a"] and texts(f"a<{tag} id=1>x</{tag}><p>b</p>") == ["a", "b"]
    for tag in ("svg", "object", "canvas", "noscript", "template"):
        assert texts(f"a<{tag} id=1>x<{tag}>y</{tag}>z</{tag}><p>b</p>") == ["a", "b"]
        assert texts(f"a<{tag}><p>b</p><{tag}>x</{tag}><p>c</p>") == ["a", "b", "c"]
    assert texts('a<svg><title/><style>x<path d="M"/></svg><p>b</p>') == ["a", "b"]
    assert texts('a<object>x<script>"</object>"</script>y</object><p>b</p>') == ["a", "b"]


def test_slopes_agree_with_differences():
    import numpy as np

    r = np.random.default_rng(1)
    net = extract.BiLstm(5, hidden=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, real = extract.padded([r.normal(size=(n, 5)) for n in (4, 2)])
    y = r.integers(0, 2, real.shape[:2]).astype(float)

    def loss():
        p = net.probabilities(net.project(x), real)
        return -(np.where(y > 0, np.log(p), np.log(1 - p)) * real[..., 0]).sum() / real.sum()

    slopes = net.slopes(x, real, y)
    for name, value in net.p.items():
        at = tuple(0 for _ in value.shape)
        before = value[at]
        value[at] = before + 1e-3
        up = loss()
        value[at] = before - 1e-3
        down = loss()
        value[at] = before
        assert abs((up - down) / 2e-3 - slopes[name][at]) < 2e-3


def test_pages_of_every_kind(spark):
    body = " ".join(["word"] * 40)
    page = f'<html><nav><ul><li><a href="/">Home</a></li></ul></nav><article><h1>Title</h1><p>{body}</p></article><footer>&copy; us</footer></html>'
    long = page.replace("</article>", f"<p>{body}</p>" * 3000 + "</article>")
    rows = [(1, "u", page, "x"), (1, "u", page, "x"), (2, None, None, None), (3, "u", "", "x"), (None, "u", "<p", "x"), (4, "u", long, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, extract.main_text(df).collect()), key=str)
    by = {}
    for i, url, text, n in got:
        assert n == len(text)
        by.setdefault(i, []).append(text)
    assert by[1] == [f"Title\n{body}"] * 2 and by[2] == [""] and by[3] == [""] and len(by[4][0].split("\n")) == 3002 and len(by[None]) == 1
    assert extract.main_text(df.limit(0)).count() == 0


def test_broken_markup_takes_linear_time():
    import time

    for piece in ('<a "', "<script", "<svg ", '<a ">"', "<a ''\"'>'\"", "</script", "<svg '", "<!-", "<script>x</script ", "<a"):
        start = time.time()
        extract.blocks_of("<p>one</p>" + piece * 60_000)
        extract.blocks_of("<p>one</p><svg>" + (piece + "<") * 60_000 + ">")
        assert time.time() - start < 5, piece


def reference_end(page, at):
    """The end of a tag as it is defined: the first ``>`` outside quotations, else the first of all."""
    quote = ""
    for k in range(at, len(page)):
        c = page[k]
        if quote:
            quote = "" if c == quote else quote
        elif c == ">":
            return k
        elif c in "\"'":
            quote = c
    return page.index(">", at)


def test_tags_end_where_they_should():
    import random

    r = random.Random(6)
    for _ in range(3000):
        page = "<a" + "".join(r.choice("<> \"'a") for _ in range(r.randint(0, 14))) + ">"
        walk, at = extract.Walk(page), 0
        while found := walk.next(at):
            start, at, name, _, attributes = found
            if name:
                assert at - 1 == reference_end(page, at - 1 - len(attributes)), page


def test_neighbours_do_not_matter(monkeypatch):
    lab = extract.Labeller(extract.trained())
    pages = [b for b, _ in extract.training_pages(60, 99)]
    alone = [lab.main_blocks([p])[0] for p in pages]
    assert lab.main_blocks(pages) == alone and lab.main_blocks(pages[::-1]) == alone[::-1]
    monkeypatch.setattr(extract, "NEAR_LIMIT", 1.0)
    assert lab.main_blocks(pages) == alone


def test_layouts_that_the_generator_does_not_make():
    article = ["The committee met on Tuesday to discuss the harbour.", "Nobody expected the vote to be so close, the chair said afterwards.", "A second reading is planned for the autumn."]
    inner = "".join(f"<p>{x}</p>" for x in article)
    pages = [
        f'<body><div id="masthead"><a href="/">Daily</a> <a href="/x">World</a></div><main role="main"><div class="post-content">{inner}</div></main><div id="footer-links"><a href="/a">About</a><a href="/c">Contact</a></div></body>',
        f'<div class="navbar"><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></div><section><article class="entry">{inner}</article></section><section class="comments"><h3>Comments</h3><div class="comment"><p>I do not agree at all.</p></div></section><footer><p>All rights reserved</p></footer>',
        f'<header><nav><a href="/">Start</a></nav></header><article>{inner}<script>var x = "<p>no</p>";</script></article><aside><h4>Most read</h4><ul><li><a href="/1">One</a></li></ul></aside>',
    ]
    lab = extract.Labeller(extract.trained())
    assert lab.main_blocks([extract.blocks_of(p) for p in pages]) == [article] * 3


def test_deep_pages_take_linear_time():
    import time

    for piece in ("<div>x", '<div class="a b">x', "<ul><li>x", "<div>x</p>", "<table><tr><td>x"):
        begin = time.time()
        blocks = extract.blocks_of(piece * 30_000)
        assert len(blocks) >= 30_000 and time.time() - begin < 5, piece
    names = "".join(f"<div class=c{k}>x" for k in range(20_000))
    blocks = extract.blocks_of(names + "</div>" * 20_000 + "<p>end")
    assert blocks[-1].path == ("p",) and sum(blocks[-1].marks) == 1 and blocks[100].depth == 202 and len(blocks[100].path) == 202


def test_a_page_of_many_blocks_is_labelled_in_slices():
    lab = extract.Labeller(extract.trained())
    pages = [b for b, _ in extract.training_pages(6, 5)]
    whole = lab.main_blocks([sum(pages, [])])
    assert lab.main_blocks([sum(pages, [])], cells=7) == whole and lab.main_blocks([pages[0], sum(pages, [])], cells=7)[1] == whole[0]


#: Pages in layouts of other makes, written and labelled by hand: + before a block of the main text, - before any other.
BY_HAND = {
    "news, divs only": """<div id="header">-Daily Post<div class="nav">-<a href="/">News</a></div></div><div id="main"><div class="post"><h2>+Bridge reopens after repair</h2>
        <div class="entry">+The bridge over the river was opened to traffic again on Monday, two weeks early.<p>+Work had begun in spring, after cracks were found in two of the piers.</p><blockquote>+We are glad that it held, the engineer said.</blockquote></div></div>
        <div class="sharebar">-<a href="#">Share</a></div><div id="respond"><h3>-Leave a reply</h3><form><label>-Your name</label></form></div></div><div id="footer">-© Daily Post</div>""",
    "documentation": """<header>-<a href="/">Home</a></header><nav class="sidebar"><ul><li>-<a href="/a">Install</a></li><li>-<a href="/b">Usage</a></li></ul></nav><main><h1>+Installing the tool</h1><p>+Download the archive and unpack it in a folder of your own.</p><pre>+tar xf tool.tar</pre>
        <h2>+Next steps</h2><ul><li>+Set the path to the folder.</li><li>+Run the check.</li></ul></main><footer><p>-Built with a generator</p></footer>""",
    "forum thread": """<div class="breadcrumb">-<a href="/">Index</a> / <a href="/f">Garden</a></div><article class="topic"><h1>+When to cut roses?</h1><div class="post-body">+Mine have grown over the fence and I wonder whether autumn is too late to cut them back hard.</div></article>
        <section class="responses"><div class="comment"><p>-Wait for spring, I would say.</p></div><div class="comment"><p>-Autumn worked for me.</p></div></section>""",
    "recipe in tables": """<table class="menu"><tr><td>-<a href="/">Start</a></td><td>-<a href="/r">Recipes</a></td></tr></table><div class="content"><h1>+Lentil soup</h1><p>+A warm soup for cold days, ready in half an hour.</p><table><tr><td>+Lentils</td><td>+200 g</td></tr></table>
        <p>+Wash the lentils, cover them with water and let them simmer until soft.</p></div><div class="ad">-Buy our pans today!</div><div class="related"><h4>-You may also like</h4><p>-<a href="/x">Bean stew</a></p></div>""",
    "notice over an article": """<div class="cookie-notice">-We use cookies to make this site better. <button>-Accept</button></div><div role="main"><h1>+Museum to stay open late</h1><p>+From June the museum will close at nine on Fridays.</p><div class="newsletter">-Subscribe to our letter</div><p>+Tickets are half price after six.</p></div>
        <aside><h4>-Most read</h4><ul><li>-<a href="/1">Weather</a></li></ul></aside><footer>-<a href="/imprint">Imprint</a></footer>""",
    "no frame at all": """<h1>+Notes on bees</h1><p>+Bees find their way back by the sun and by landmarks near the hive.</p><p>+They tell each other of places by dancing.</p>""",
}


def test_pages_labelled_by_hand():
    """The block error over pages that neither the generator nor the given tables make: 1 of 47 now, at most one in ten allowed."""
    import re

    lab, wrong, count = extract.Labeller(extract.trained()), {}, 0
    for name, page in BY_HAND.items():
        labels = {re.sub(r"^[+-]\s*", "", b.text): b.text[0] == "+" for b in extract.blocks_of(page)}
        assert all(b.text[0] in "+-" for b in extract.blocks_of(page)), name
        clean = re.sub(r">[+-]", ">", page)
        blocks = [b.text for b in extract.blocks_of(clean)]
        got = set(lab.main_blocks([extract.blocks_of(clean)])[0])
        wrong[name] = [b for b in blocks if labels[b] != (b in got)]
        count += len(blocks)
    assert sum(map(len, wrong.values())) <= 0.1 * count, wrong
