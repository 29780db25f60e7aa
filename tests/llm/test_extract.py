import pytest

from wearline.llm.extract import main_text, text_column

LONG = "A sentence, with commas, that is long enough to look like a real paragraph of the article."


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("  \n", ""), ("<p></p>", ""),
    (f"<body><nav><a href=x>Home</a></nav><article><h1>T &amp; U</h1><p>{LONG}<p>Short\n\n one.</article>"
     "<footer>&copy; me</footer>", f"T & U\n\n{LONG}\n\nShort one."),
    (f"<div id=main><p>{LONG}</p><p>&#65;1 &hellip; a&nbsp;b &lt;i&gt; &amp;lt;</p></div><div class='sidebar'><p>{LONG}</p></div>",
     f"{LONG}\n\nA1 … a b <i> &lt;"),
    (f"<article><p>{LONG}</p><div class=comments><p>{LONG} No.</p></div><div class='ad-box'>Buy</div></article>", LONG),
    (f"<div><p>{LONG}</p><p>{LONG}</p></div><div><ul><li><a href=1>{LONG}</a></li></ul></div>", f"{LONG}\n\n{LONG}"),
    (f"<header>Site</header><main><header><h1>Head</h1></header><p><b>{LONG}<br>x<p>y</main>", f"Head\n\n{LONG} x\n\ny"),
    (f"<script>var t='</p>';</script><style>p{{}}</style><article><p>{LONG}</p><form><p>Mail</p></form></article", LONG),
    (f"<article>Bare text <i>of</i> it<ul><li>one<li>two</ul><table><tr><td>a<td>b</table><p>{LONG}</article>",
     f"Bare text of it\n\none\n\ntwo\n\na\n\nb\n\n{LONG}"),
])
def test_pages(page, text):
    assert main_text(page) == text


def test_long_and_crooked_pages():
    body = "".join(f"<p>{LONG} {i}" for i in range(5000))
    assert main_text(f"<article>{body}").count("\n\n") == 4999
    assert main_text("<b>" * 20000 + LONG + "</i>" * 50) == LONG
    assert main_text("<div>" * 5000 + f"<p>{LONG}") == LONG


def test_column(spark):
    rows = [(1, None, "x"), (2, f"<p>{LONG}</p>", "y"), (2, f"<p>{LONG}</p>", "y"), (None, "", None)]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = df.withColumn("text", text_column(df.html)).collect()
    assert [r.text for r in got] == ["", LONG, LONG, ""]
    assert df.limit(0).withColumn("text", text_column(df.html)).count() == 0


@pytest.mark.parametrize("page", [
    f"<div class='has-sidebar'><article><p>{LONG}</p></article><div class='sidebar'><p>{LONG} No.</p></div></div>",
    f"<div class='no-sidebar'><main><p>{LONG}</p></main></div><div class='related'><article><p>{LONG} No.</p></article></div>",
    f"<div id='page' class='content no-sidebar'><p>{LONG}</p></div>",
    f"<article><p>{LONG}</p><div class='content comments'><p>{LONG} No.</p></div></article>",
])
def test_layout_wrappers(page):
    assert main_text(page) == LONG
