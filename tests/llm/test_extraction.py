import numpy as np
import pytest

from millrace.llm import extraction
from millrace.llm.markup import Block, blocks

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/x">Home</a></li><li><a href="/y">About</a></ul></nav><!-- ad <p>no</p> -->
<article><h1>A &amp; B</h1><p><b>First   line<br>goes on.<p>Second &eacute; &#233; <a href='>'>link</a>.</p><ul><li>one<li>two</ul></article>
<footer>&copy; x &middot; y</footer></body></html>"""


def test_blocks():
    got = blocks(PAGE)
    assert [b.text for b in got] == ["Home", "About", "A & B", "First line goes on.", "Second é é link.", "one", "two", "© x · y"]
    assert got[0].path[-4:] == ("nav", "ul", "li", "a") and got[0].linked == 1.0
    assert got[4].path[-2:] == ("article", "p") and 0 < got[4].linked < 1


@pytest.mark.parametrize(
    "page, texts",
    [("", []), ("<", ["<"]), ("a < b and c > d", ["a < b and c > d"]), ("<p>x<p", ["x"]), ("<p>x &am", ["x &am"]), ("<!-- open", []), ("<script>never closed", []), ("plain", ["plain"]), ("<div>a<div>b</div>c", ["a", "b", "c"]), ("<p>a&nbsp; b</p>", ["a b"]), ("</p></div>x", ["x"]), ("<td>a<td>b", ["a", "b"]), ("<textarea>in a <b>form</textarea>y", ["in a <b>form", "y"])],
)
def test_broken_markup(page, texts):
    assert [b.text for b in blocks(page)] == texts


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    model = extraction.Labeller.fresh()
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    x = rng.normal(size=(5, 3, extraction.PATH + extraction.WORD + extraction.NUMBERS))
    mask = np.array([[1, 1, 1], [1, 1, 1], [1, 1, 0], [1, 0, 0], [1, 0, 0]], float)
    x *= mask[:, :, None]
    y = (rng.random((5, 3)) < 0.5) * mask
    _, found = model.gradients(x, mask, y)
    for name in ("fx", "fh", "fb", "bx", "bh", "bb", "o", "ob"):
        w = model.weights[name]
        for _ in range(3):
            at = tuple(rng.integers(n) for n in w.shape)
            kept = w[at]
            w[at] = kept + 1e-5
            up, _ = model.gradients(x, mask, y)
            w[at] = kept - 1e-5
            down, _ = model.gradients(x, mask, y)
            w[at] = kept
            assert abs((up - down) / 2e-5 - found[name][at]) < 1e-6


@pytest.fixture(scope="module")
def model(spark):
    return extraction.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_whole_table(spark, model):
    """Pages that it wasn't trained on: the text is that of the article element."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").where("page_id >= 1500")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    got = extraction.extract(pages, model).collect()
    assert len(got) == len(html)
    wrong = 0
    for r in got:
        want = "\n\n".join(b.text for b in blocks(html[r["page_id"]] or "") if "article" in b.path)
        wrong += r["text"] != want
        assert r["n_chars"] == len(r["text"])
    assert wrong <= 0.005 * len(got)


def test_other_layouts(model, spark):
    """Composed pages with containers, notices, forms and comments; most blocks are labelled right."""
    parsed = [blocks(r["html"]) for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").where("page_id between 2000 and 2200").collect()]
    rng = np.random.default_rng(9)
    others = [b.text[:300] for p in parsed for b in p]
    made = [extraction.compose(p, extraction.ancestry(p), others, rng) for p in parsed]
    labels = model.label([p for p, _ in made])
    wrong = sum(int((a != y).sum()) for a, (_, y) in zip(labels, made, strict=True))
    assert wrong <= 0.02 * sum(len(y) for _, y in made)


def test_odd_rows(spark, model):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article><p>x</p></article>"), (3, "u", "no markup"), (3, "u", "no markup"), (4, "v", "<article>" + "<p>some words of a long page</p>" * 5000 + "</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 text", "2 label", "3 n_blocks")
    got = extraction.extract(df, model)
    assert got.columns[:4] == ["page_id", "url", "text", "n_chars"]
    by = {r["page_id"]: r for r in got.collect()}
    assert got.count() == len(rows) and by[1]["text"] == "" and by[2]["text"] == "" and by[1]["n_chars"] == 0
    assert by[4]["n_blocks"] == 5000
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert extraction.extract(none, extraction.train(none)).count() == 0


def test_vectors_of_nothing():
    assert extraction.vectors([]).shape[0] == 0 and extraction.vectors([[], [Block(("p",), "x", 0.0)]]).shape[0] == 1


@pytest.mark.parametrize("holder", [("div", "div"), ("table><tr><td", "td></tr></table")])
def test_pages_without_article(spark, holder):
    """Half of the table's pages hold their article in an unnamed element; all texts are found."""
    import re

    opened, closed = holder
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()
    plain = lambda x: re.sub(r"<article[^>]*>", f"<{opened}>", re.sub(r"</article>", f"</{closed}>", x))
    rows = [(r["page_id"], r["url"], plain(r["html"] or "") if r["page_id"] % 2 else r["html"]) for r in pages]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {r["page_id"]: "\n\n".join(b.text for b in blocks(r["html"] or "") if "article" in b.path) for r in pages}
    got = extraction.extract(df, extraction.train(df)).collect()
    assert sum(r["text"] != want[r["page_id"]] for r in got) <= 0.02 * len(got)


def test_pages_that_cannot_be_labelled_teach_nothing(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(extraction.Labeller, "fit", lambda self, pages, labels: seen.extend(labels))
    named, unnamed = "<article><p>some words</p></article>", "<div><p>some words</p></div>"
    df = spark.createDataFrame([(1, "u", named), (2, "v", unnamed)], "page_id long, url string, html string")
    extraction.train(df)
    assert len(seen) == 2 + extraction.COMPOSED and all(y.any() for y in seen)


@pytest.mark.parametrize(
    "page, texts",
    [("<head><title>t</title><p>text", ["text"]), ("<head><meta charset=x>text", ["text"]), ("<html><head><script>s</script><div>a</div><p>b", ["a", "b"]), ("<head><noscript><p>n</p></noscript><template><p>t</p></template><b>x</b>", ["x"]), ("<head><title>t</title></head><p>x", ["x"])],
)
def test_open_head(page, texts):
    assert [b.text for b in blocks(page)] == texts


@pytest.mark.parametrize(
    "page, texts",
    [
        ('<article><p title="5" tall">Hello world.</p><p>b</p></article>', ["Hello world.", "b"]),
        ("<p title=don't>Lost text</p><p>can't see</p>", ["Lost text", "can't see"]),
        ("<p>One</p><!--><p>Two</p><!--x--!><p>Three</p><!---><p>Four</p>", ["One", "Two", "Three", "Four"]),
        ("<p>a<!-- > -- > -->b</p>", ["ab"]),
        ("<p>One<script src=x />var</script><p>two", ["One", "two"]),
        ("<script>a</scripty></script >b", ["b"]),
        ("<svg><title/><path d='M'/></svg>after", ["after"]),
        ("<p>a<span/>b</p>", ["ab"]),
        ("<p =x>k<p a= >l", ["k", "l"]),
        ("</3 x>y</>z", ["yz"]),
        ("<p>&am<b>p;</b>", ["&amp;"]),
        ("<p>x</", ["x</"]),
        ('<p>x<a href="never closed>y</a>', ["x"]),
        ("<b><p>x</b>y</p>z", ["xy", "z"]),
        ("<div><table><tr><td>a</div>b</td></tr></table>c</div>", ["ab", "c"]),
        ("<h1>t</h2>u", ["t", "u"]),
        ("<xmp><b>&amp;</b></xmp>", ["<b>&amp;</b>"]),
        ("&#" + "1" * 5000 + ";x&#" + "0" * 5000 + "65;", ["�xA"]),
    ],
)
def test_as_the_standard_reads_it(page, texts):
    assert [b.text for b in blocks(page)] == texts


def test_paths():
    page = "<div class = 'x y' class=z data-id=no ID=q><table><tr><td>a<tr><td><i>b</table><b>c</b></div>d"
    assert [tuple(b.path) for b in blocks(page)] == [
        ("div", ".x", ".y", ".q", "table", "tr", "td"),
        ("div", ".x", ".y", ".q", "table", "tr", "td", "i"),
        ("div", ".x", ".y", ".q", "b"),
        (),
    ]
    words = ("html", "body", "div", ".x", "div", ".x", ".z", "p")
    path = extraction.Path.of(words)
    assert tuple(path) == words and path[-1] == "p" and list(reversed(path)) == list(words[::-1]) and path.last == "p"
    assert path.fresh == ("p",) and path.parent.fresh == (".z",)
    both = extraction.vectors([[Block(words, "x", 0.0), Block(path, "x", 0.0)]])
    assert (both[0, : extraction.PATH] == both[1, : extraction.PATH]).all()


def test_path_vectors_hash_every_word_once():
    for b in [*blocks(PAGE), *blocks("<div class='a a b'><div class=a><b><div><b>x")]:
        want = np.zeros(extraction.PATH)
        for word in [*({*b.path} - {"html", "body"}), f"last {b.path.last}"]:
            at, sign = extraction._place(word)
            want[at] += sign
        assert (extraction._path_vectors([b])[0] == want).all()


@pytest.mark.parametrize(
    "unit",
    ["<font><p>x</p>", "<p><button><font><div>x", '<a "', '<a x="', "<!--", "<", "<script></scrip", "<table><tr><td>a", "<b><div>x</b>", "<ul><li>x", "&#1", "<a =", "</a>", "<textarea>"],
)
def test_long_broken_pages_take_linear_time(unit):
    import time

    page = unit * (1_000_000 // len(unit))
    start = time.process_time()
    found = blocks(page)
    extraction._path_vectors(found)
    assert time.process_time() - start < 5
