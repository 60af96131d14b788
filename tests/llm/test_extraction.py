import random
import time
import tracemalloc

from tickharbor.llm.extraction import extract, main_text

PAGE = """<html><body class="has-sidebar"><header><h1>Site</h1></header><div id=wrap><div class="content-12">
<p>Hello <b>bold</b>ed &amp; <a href=x>link</a> text that is long enough here.<p>Second   para<br>line<ul><li>one<li>two</ul>
<div class="comments"><p>spam spam spam</div><aside>x</aside><form><input name=a>q</form></div>
<div class="sidebar">side text</div></div><footer>f</footer><script>if(a<b){"</p>"}</script></body>"""
MAIN = "Hello bolded & link text that is long enough here. Second para line one two"


def test_pages():
    assert extract(PAGE, None) == MAIN
    assert extract("", None) == "" and extract("plain &lt text", None) == "plain < text"
    assert extract("<p>unclosed <", None) == "unclosed <"
    assert extract('<div title="a>b">x</div><!-- a <p> --><![CDATA[y]]>', None) == "x"
    assert extract("<p><b>one<br><p>two</b></p>&amp", None) == "one two &"
    assert extract("<article><header><h1>Title</h1></header><p>Body</p></article><nav>n</nav>", None) == "Title Body"


def test_text_after_unclosed_elements():
    for icon in ('<svg width="1"/>', "<math />", "<svg><path d='M0'>", "<math><mi>x", "<noscript><img src=x>", "<template>y",
                 "<svg><style/><title>Icon", "<svg><svg></svg>", "<noscript>a<noscript>b</noscript>", "<SVG><g>t<path/></g>"):
        assert extract(f"<div><div>one {icon}</div><p>two</p> three</div>", None) == "one two three", icon
        assert extract(f"<div><p>one <a>{icon}</a> two</p><svg><text>t</text></svg><noscript>n</noscript> three</div>", None) == "one two three", icon
    assert extract("<div>one <svg/> two <svg><text>t</text></svg> three", None) == "one two three"
    assert extract("<div>one <svg><path> <p>two</p><svg><text>t</text></svg> three", None) == "one two three"
    assert extract("<p>one <svg><style>a</style><path/><path><text>t</text></svg> two<template><p>x<template>y</template>z</template>", None) == "one two"
    assert extract("<p>one <svg><foreignObject><div>t</div><p>u</foreignObject></svg> two <noscript></p></noscript>three", None) == "one two three"
    assert extract("<div>one<script>a</script\n> two<style>b</style x> three<script>rest", None) == "one two three"


def test_host_consensus_beats_one_page(spark, no_documents):
    def page(text, note):
        return f"<body><div class='story s1'><p>{text}</p></div><div class='box'><p>{note}</p></div></body>"

    rows = [(i, f"http://user@Host.example:80/{i}", page(f"word{i} " * 60, "note")) for i in range(4)]
    rows += [(9, "https://host.example/9", page("short but main text", "a longer note beside it, of some length"))]
    rows += [(10, None, PAGE), (11, "no address", PAGE), (12, "http://other.example", None), (12, "http://other.example", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS path")
    got = {r.page_id: r for r in main_text(pages.select("path", "html", "url", "page_id", "host")).collect()}
    assert got[9].text == "short but main text" and got[10].text == got[11].text == MAIN
    assert got[12].text == "" and got[12].n_chars == 0 and got[0].n_chars == len(got[0].text)
    assert main_text(pages).count() == len(rows)
    assert main_text(pages.limit(0)).collect() == []


def test_text_beside_the_best_container_is_kept():
    many, few = " ".join(f"a{i}" for i in range(100)), " ".join(f"b{i}" for i in range(15))
    assert extract(f"<body><div>{many}</div><p>{few} <a>link</a></p><p><a>menu</a></p></body>", None) == f"{many} {few} link"
    assert extract(f"<body><ul><li><a>menu</a></ul><div class=a>{few}</div><div class=b>{many}</div></body>", None) == f"{few} {many}"
    assert extract(f"<body><div><a>x</a> <a>y</a></div><div class=a>{few}</div><div class=b>{many}</div></body>", None) == f"{few} {many}"


def _generated(rng, serial):
    """A page whose article is split over containers of any weight, and its article text."""
    said = []

    def words():
        text = " ".join(f"w{serial}x{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 60)))
        said.append(text)
        return text

    def part(depth):
        kind = rng.randrange(5 if depth else 3)
        if kind == 0:
            return f"<p>{words()} <b>{words()}</b></p>"
        if kind == 1:
            return f"<ul><li>{words()}<li>{words()}</ul>"
        if kind == 2:
            return f"<div class='c{rng.randrange(3)}'>{words()}</div>"
        return f"<section class='part{rng.randrange(9)}'>" + "".join(part(depth - 1) for _ in range(rng.randrange(1, 4))) + "</section>"

    body = "".join(part(3) for _ in range(rng.randrange(1, 6)))
    side = "".join(f"<div class='{mark}'><p>noise</p></div>" for mark in ("sidebar", "comments", "cookie"))
    return f"<body><nav>menu</nav><div class='tip'>read our terms</div><div id=post>{body}</div>{side}<footer>f</footer></body>", " ".join(said)


def test_split_articles_keep_every_word(spark):
    rng = random.Random(7)
    made = [_generated(rng, k) for k in range(60)]
    rows = [(k, "http://one.example/" + str(k), source) for k, (source, _) in enumerate(made)]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k, (_, article) in enumerate(made):
        assert got[k].split()[-len(article.split()):] == article.split()
    # The tip has one text beside many main texts. Where it is part of the best container of its page it stays.
    assert sum(got[k] == article for k, (_, article) in enumerate(made)) >= 57


def test_copies_of_a_page_make_no_template(spark):
    source = "<body><div class=story>" + "word " * 60 + "</div><div class=end>the end</div></body>"
    rows = [(k, f"http://h.example/{k}", source) for k in range(5)]
    got = main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {"word " * 60 + "the end"}


def test_deep_and_unclosed_pages_take_time_by_their_length():
    started = time.process_time()
    assert extract("<b>" * 40_000 + "</b><p>" * 10_000 + "x", None) == "x"
    assert extract("<div>" * 80_000 + "x", None) == "x"
    assert time.process_time() - started < 20
    tracemalloc.start()
    extract("<div>" * 20_000 + "x", None)
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()
