"""Broken and very long markup is read in one pass, to the blocks that well-formed markup would give."""

import time

import pytest

from karyolytics.llm import html_extract

UNITS = ['<a "', "<a ", "<", "<a \"'", "<i>", "<!-- <", "<div>x", '<a class="x', "<a class ", "</", "<![CDATA[", "&#1", "<p", "' >\""]


@pytest.mark.parametrize("page", [*(u * (1_000_000 // len(u)) for u in UNITS), "<i>" * 150_000 + "<p>" * 150_000, "<i>" * 120_000 + "</b>" * 120_000, "<b><div>" + "<i>" * 120_000 + "</b>" * 120_000, "<li>" * 250_000, "<script>" * 100_000])
def test_a_megabyte_takes_seconds(page):
    began = time.process_time()
    html_extract.blocks(page)
    assert time.process_time() - began < 8


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", []), (None, []), ("a < b", ["a < b"]), ("<p>one<p>two", ["one", "two"]), ("<p>one</p>two</div>three", ["one", "two", "three"]),
        ('<a "b>c</a>', ['<a "b>c']), ("<a title='>'>x</a>", ["x"]), ("x<a href", ["x"]), ("x<!-- y", ["x"]), ("x<!-->y", ["x"]), ("x<!-- > -->y", ["xy"]), ("a<br>b<hr>c", ["a b", "c"]),
        ("<script>if (a<b) '</p>'</script>x", ["x"]), ("<script/>x", ["x"]), ("<svg><p>y</p></svg>x", ["x"]), ("&lt;p&gt; &#65;&#x42;&#0000067; &#99999999999; &amp;amp;", ["<p> ABC � &amp;"]),
        ("<ul><li>a<ul><li>b</ul><li>c</ul>", ["a", "b", "c"]), ("<table><tr><td>a<td>b<tr><td>c", ["a", "b", "c"]), (" \n<p>\t a \n b </p>", ["a b"]), ("<unknown>a</unknown>b", ["ab"]),
    ],
)
def test_blocks(page, want):
    assert [t for _, t, _ in html_extract.blocks(page)] == want


def test_numbers_of_any_length():
    assert [t for _, t, _ in html_extract.blocks("<p>&#" + "9" * 100_000 + "; &#" + "0" * 100_000 + "65;")] == ["� A"]


def test_pages_on_hard_rows(spark):
    """Repeated rows, clashing columns, nulls, broken and long pages each have a row with the text of the page."""
    article = "<html><body><nav><a href=/>Home</a> <a href=/x>News</a></nav><article><h1>Title of it</h1>" + "".join(f"<p>This is sentence {i} of the article, which has some length, and it ends here.</p>" for i in range(8)) + "</article><footer>Imprint</footer></body></html>"
    data = [(1, "u", article), (1, "u", article), (2, None, None), (3, "v", ""), (4, "w", '<a "' * 20_000), (5, "z", article.replace("</p>", "")), (None, "n", article)]
    df = spark.createDataFrame(data, "page_id long, url string, html string").repartition(3)
    df = df.withColumns({c: df["page_id"] for c in ("text", "n_chars", "path", "block")})
    got = html_extract.extract(df).collect()
    assert sorted(got[0].asDict()) == ["n_chars", "page_id", "text", "url"]
    by = {(r.page_id, r.url): r.text for r in got}
    assert len(got) == len(data) and all(r.n_chars == len(r.text) for r in got)
    assert by[2, None] == by[3, "v"] == "" and by[1, "u"] == by[None, "n"]
    assert "sentence 7" in by[1, "u"] and "Imprint" not in by[1, "u"] and by[5, "z"] == by[1, "u"]
    assert html_extract.extract(df.limit(0)).collect() == []
