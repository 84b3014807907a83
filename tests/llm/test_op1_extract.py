from tidemark.llm import op1_extract as op


def test_held_out_pages():
    model = op.default_model()
    pages = op.labelled_pages(400, seed=1234)
    right = sum(op.extract(page, model) == "\n\n".join(good) for page, good in pages)
    assert right >= 0.96 * len(pages)


def test_viterbi_is_the_best_path():
    import itertools
    import random

    rng = random.Random(3)
    for _ in range(200):
        s = [rng.uniform(-2, 2) for _ in range(rng.randint(1, 7))]
        trans, start = [[rng.uniform(-1, 1) for _ in "ab"] for _ in "ab"], [rng.uniform(-1, 1) for _ in "ab"]

        def value(path):
            return start[path[0]] + sum(x * y for x, y in zip(s, path)) + sum(trans[a][b] for a, b in zip(path, path[1:]))

        assert abs(value(op.viterbi(s, trans, start)) - max(map(value, itertools.product((0, 1), repeat=len(s))))) < 1e-9


def test_article_without_its_surroundings():
    page = """<html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body><header><h1>Site</h1></header>
    <nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav><div class="cookie-notice"><p>We use cookies, accept.</p></div>
    <article><h1>A  title &amp; more</h1><!-- hidden --><p>First <b>para</b>graph,
    with&nbsp;space.<p>Second one. It has two sentences.<div class="ad">Buy this now.</div><p>Third &#8364;5 <a href=x>link</a> end.</p></article>
    <section id="comments"><div class="comment"><p>Nice article.</p></div></section><aside><p>Related: something else.</p></aside>
    <form><label>Mail</label><input></form><footer>&copy; Site</footer></body></html>"""
    assert op.extract(page, op.default_model()) == "A title & more\n\nFirst paragraph, with space.\n\nSecond one. It has two sentences.\n\nThird €5 link end."


def test_hidden_is_an_attribute_name():
    shown = ('href="/hidden-gems"', "title='a hidden door'", 'data-hidden="false"', 'data-menu="hidden"', "alt=hidden", "href=/x?hidden=1", 'data-style="display:none"',
             'aria-label="style=display:none"', "data-aria-hidden=true", 'title="x" aria-hidden="false"', "style='color:red'")
    unseen = ("hidden", 'class="a" HIDDEN', "hidden=''", 'aria-hidden="true"', "aria-hidden=true", "style='color:red; display: none'", "style=visibility:hidden", 'title="a"hidden')
    assert [a for a in shown if "!hidden" in op._names(a)] == [] and [a for a in unseen if "!hidden" not in op._names(a)] == []
    assert op._names(' data-class="menu" class = "Main-Text" title="id=footer" id=storyBody') == ("main", "text", "story", "body")
    text = "First paragraph of the story, with a few words. It has two sentences."
    for a in shown:
        page = f"<html><body {a}><article><h1>A title</h1><p>{text}</p><p>Second one, with <a {a}>a link</a> inside. It has two sentences.</p></article></body></html>"
        assert op.extract(page, op.default_model()) == f"A title\n\n{text}\n\nSecond one, with a link inside. It has two sentences."


def test_head_without_its_end_tag():
    text = "First paragraph of the story, with a few words. It has two sentences."
    article = f"<article><h1>A title</h1><p>{text}</p><p>Second one, with a comma. It has two sentences.</p></article>"
    want = f"A title\n\n{text}\n\nSecond one, with a comma. It has two sentences."
    heads = ("<head><title>T</title>", "<head><meta charset=utf-8><style>p{}</style>\n<script>var a = '<p>';</script>\n<title>T</title>\n", "<head>",
             "<head><noscript><link href=x>", "<head><template><p>not shown</p></template>",
             "<head><noscript><p>Switch scripts on.</p><img src=x></noscript><title>T</title>", "<head><title>T</title></head>")
    for head in heads:
        for body in ("<body>", "", "\n<div>"):
            assert op.extract(f"<html>{head}{body}{article}", op.default_model()) == want, (head, body)
    assert [b[0] for b in op.parse("<html><head><title>T</title>Bare text <b>here</b>")] == ["Bare text here"]
    assert op.parse("<head><script>x</script><noscript><style>p{}</style></noscript><template><div>no</div></template></head>") == []


def test_quote_signs_outside_of_quoted_values():
    text = "First paragraph of the story, with a few words. It has two sentences."
    for a in ("title=it's", "alt=5\"x", "data-a=a'b\"c", "'", "title='x'y'", "href=/x?a=\"b", "= 'x>y'", "a = \"x>y\"", "a==b'"):
        page = f"<article><h1>A title</h1><p>{text}</p><p>Second one, <b {a}>with</b> a word. It has two sentences.</p></article>"
        assert op.extract(page, op.default_model()) == f"A title\n\n{text}\n\nSecond one, with a word. It has two sentences.", a


def test_elements_around_blocks():
    shown = lambda page: [b[0] for b in op.parse(page)]
    assert shown("a<span hidden><div>no</div>no<p>no</p></span>b") == ["a", "b"]
    assert shown("<app-x style='display:none'><div>no</div><div>no</div></app-x><p>yes</p>") == ["yes"]
    assert shown("<b><div>one</div><i>two<p>three</p>") == ["one", "two", "three"]
    notice = op.parse("<cookie-bar class='cookie consent'><div>We use them.</div></cookie-bar><p>x</p>")
    assert notice[0][1][1] == ("cookie-bar", ("cookie", "consent")) and notice[1][1] == (("p", ()),)
    assert shown("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>tex</annotation></math> be, <script>f()</script>or <svg><text>no</text></svg>not.</p>") == ["Let x=2 be, or not."]
    text = "First paragraph of the story, with a few words. It has two sentences."
    page = f"<body><cookie-bar class='cookie consent'><div>We use cookies, accept.</div></cookie-bar><article><h1>A title</h1><p>{text}</p><p>{text}</p></article></body>"
    assert op.extract(page, op.default_model()) == f"A title\n\n{text}\n\n{text}"


def test_unclosed_tags_cost_the_same_each():
    import time

    n = 20_000
    pages = ("<b>" * n + "</i>" * n, "<i><div>" + "<b>x" * n + "</i>" * n, "<div hidden>" + "<b>x</i>" * n, "<div>x" * n, "<span class=x><div>y</div>" * n,
             "<head><noscript>" + "<link>" * n + "</noscript>", "<a =" * n, "<p>x<i><li>" * n, "<td><b>" * n + "</td>" * n)
    for page in pages:
        start = time.time()
        op.extract(page, op.default_model())
        assert time.time() - start < 8, page[:40]


def test_odd_pages(spark):
    long = "<article>" + "<p>" + "long text here. " * 100_000 + "</p></article>"
    rows = [(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "", "x"), (2, "u", "no tags", "x"), (3, "u", "<p", "x"), (4, "u", "<article><p>unclosed", None),
            (5, "u", "</div></p>", "x"), (6, "u", long, "x"), (7, "u", "<script>only()</script>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.page_id or 0), r.text, r.n_chars) for r in op.extract_text(df).collect())
    assert len(got) == len(rows) and all(len(t) == n for _, t, n in got)
    assert [g for g in got if g[0] == 1] == [(1, "", 0)] * 2 and got[-2][1] == " ".join(["long text here."] * 100_000)
    assert op.extract_text(df.limit(0)).collect() == []


def test_given_pages(spark):
    from tests.conftest import SF

    got = op.op1_extract(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/pages.parquet").count() and all(r.text and "<" not in r.text for r in got)
