import html
import re

from granary.llm.html_text import extract, host_of, main_text, read_page
from granary.llm.queries import QUERIES

LONG = "A sentence with quite a few words in it, so that it looks like the text of an article."
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{a:b}}</style><script>var x = "<p>no</p>";</script></head>
<body class="page sidebar-left"><header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div id="main-17" class="layout">
<div class="cookie-notice">We use cookies</div><div class="post post-4711"><h2>Caf&eacute; &amp; more</h2><p>{LONG}
   spread &nbsp; over lines.<p>Second <b>bo</b>ld<br>line &#8364;5 <i>it<p>{LONG}</i></p><ul><li>one<li>two</ul>
<form><p>Your mail</p><input></form><table><tr><td>cell a<td>cell b</table></div>
<div class="comments"><p>{LONG} {LONG} {LONG} {LONG}</p></div><aside>{LONG}</aside><div hidden>{LONG}</div><!-- <p>gone</p> --></div>
<footer>&copy; us</footer></body></html>"""
TEXT = f"Café & more {LONG} spread over lines. Second bold line €5 it {LONG} one two cell a cell b"


def test_article_of_a_page():
    assert extract(PAGE, []) == (TEXT, "html>body>div#main-0.layout>div.post.post-0")


def test_given_paths_come_first():
    assert extract(PAGE, ["html>body>div.none", "html>body>div#main-0.layout>div.post.post-0"])[0] == TEXT
    assert extract(PAGE, ["html>body>div#main-0.layout>div.post.post-0>ul"])[0] == "one two"


def test_broken_pages():
    assert extract(None, []) == extract("", []) == ("", "")
    assert extract("plain text", [])[0] == "plain text"
    assert extract("<<>< a < b & c &amp; d </p></div><p", [])[0] == "<<>< a < b & c & d <p"
    assert extract("<div class='comments'>only this", [])[0] == "only this"
    assert extract("<p>x<script>never closed <p>y", [])[0] == "x"
    assert extract("<p>x<!-- never closed <p>y", [])[0] == "x"
    assert extract("<p title='a>b\">c</p>d", [])[0] in ("d", "b\">c d")
    deep = "<div>" * 3000 + LONG + "</div>" * 3000
    assert extract(deep, [])[0] == LONG
    assert extract("<p>" + "word " * 200_000, [])[0] == " ".join(["word"] * 200_000)


def test_blocks_end_where_html_says():
    page = read_page("<body><p>a<p>b<div>c<p>d</div>e<ul><li>f<ul><li>g</ul><li>h</ul><dl><dt>i<dd>j</dl>")
    assert [text for _, text, _ in page.blocks] == list("abcdefghij")


def test_comments_may_be_articles_too():
    comments = "".join(f"<article class='comment depth-{i}'><p>{LONG}</p></article>" for i in range(9))
    page = f"<body><article class='post tag-sidebar'><h1>Title</h1><p class='byline'>By me</p><p>{LONG}</p><section>{comments}</section></article></body>"
    assert extract(page, [])[0] == f"Title By me {LONG}"


BODY = "<div class='body'>" + f"<p>{LONG}</p>" * 9 + "</div>"
NINE = " ".join([LONG] * 9)


def test_what_stands_beside_the_densest_container_belongs_to_the_article():
    for tag in ("article", "div"):
        page = f"<body><{tag}><h1>Title</h1><p class='lead'>Lead.</p>{BODY}<figure><figcaption>Caption</figcaption></figure><p>The end.</p></{tag}></body>"
        assert extract(page, []) == (f"Title Lead. {NINE} Caption The end.", f"html>body>{tag}")
    assert extract(f"<body><h1>Title</h1>{BODY}<p>The end.</p></body>", [])[0] == f"Title {NINE} The end."
    sections = f"<section id='a'><p>{LONG} {LONG}</p></section><section id='b'><p>short</p></section>"
    for page in (f"<body><div>{sections}</div></body>", f"<body>{sections}</body>"):
        assert extract(page, [])[0] == f"{LONG} {LONG} short"
    # lists of links and other containers of the page stay out
    links = "<ul>" + "<li><a href=/>Another story of this site</a>" * 9 + "</ul>"
    assert extract(f"<body><div><div class='list'>{links}</div>{BODY}</div></body>", [])[0] == NINE
    assert extract(f"<body><div class='list'><p>Other</p></div>{BODY}</body>", [])[0] == NINE


def test_words_name_what_is_set_aside_as_whole_names():
    kept = ["class='overflow-hidden'", "class='row has-sidebar'", "class='no-sidebar'", "class='header-fixed'", "title='a hidden gem'",
            "data-hidden='false'", "data-id='comment-5'", "data-x='class=comments'", "class='share-prices'"]
    for attributes in kept:
        page = read_page(f"<body><div {attributes}><p>inside</p></div><p>{LONG}</p></body>")
        assert [text for _, text, _ in page.blocks] == ["inside", LONG], attributes
    for attributes in ("class='site-header'", "class='x comments-area'", "id=comment-5", "hidden", "class='cookie-notice'", "aria-hidden='true'", "class=sidebar-left"):
        assert [text for _, text, _ in read_page(f"<body><div {attributes}><p>inside</p></div><p>{LONG}</p></body>").blocks] == [LONG], attributes
    page = "<article><h2 id='related-work'>Related</h2><section id='search'><p>Search</p></section><h2 id='share-prices'>Prices</h2><section id='comments'>No</section></article>"
    assert extract(page, [])[0] == "Related Search Prices"


def test_words_never_leave_out_most_of_a_page():
    assert extract(f"<body><div class='hidden'><p>{LONG}</p><p>{LONG}</p></div><p>tail</p></body>", [])[0].startswith(f"{LONG} {LONG}")
    assert extract(f"<body><div class='cookie-consent'><p>{LONG} {LONG} {LONG}</p></div><div><p>{LONG}</p></div></body>", [])[0] == LONG


def test_hosts_are_read_at_all_winning_paths(spark):
    one, two = f"<p>{LONG}</p>" * 3, f"<p>{LONG}</p>"
    pages = [f"<body><div id='intro'>{one if i % 2 else two}</div><div id='story'>{two if i % 2 else one}</div></body>" for i in range(10)]
    pages += [f"<body><article><h1>Title {i + 10}</h1><p>Lead.</p>{BODY}</article></body>" for i in range(10)]
    rows = [(i, f"http://{'ab'[i // 10]}.example/{i}", page) for i, page in enumerate(pages)]
    found = main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    assert {r.page_id: r.text for r in found} == {i: " ".join([LONG] * 4) if i < 10 else f"Title {i} Lead. {NINE}" for i in range(20)}


def test_names_made_for_each_page_do_not_split_the_votes(spark):
    def slug(i):
        return "".join(chr(97 + int(digit)) for digit in str(i))

    # on odd pages the other container would win; classes differ in their ends on the one host, altogether on the other
    rows = []
    for i in range(40):
        own = f"post-{slug(i)}" if i < 20 else slug(i) + "x"
        story, more = ("brief", f"<p>{LONG}</p>") if i % 20 == 19 else (LONG, "<p>short</p>")
        second = "div" if i < 20 else "blockquote"
        rows.append((i, f"http://{'ab'[i // 20]}.example", f"<body><div class='{own}'><p>{story}</p></div><{second} class='more'>{more}</{second}></body>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = {r.page_id: (r.text, r.path) for r in main_text(pages).collect()}
    assert found[3] == (LONG, "1:html>body>div.post") and found[23] == (LONG, "2:html>body>div")
    assert found[19][0] == found[39][0] == "brief"


def test_hosts_agree_on_a_path(spark):
    def page(body):
        return f"<html><body>{body}</body></html>"

    usual = "<div class='story'><p>{0}</p><p>{0}</p></div><div class='more'><p>short</p></div>"
    # on this page alone the other container would win
    odd = f"<div class='story'><p>brief</p></div><div class='more'><p>{LONG}</p><p>{LONG}</p></div>"
    rows = [(i, "http://Host.example/a", page(usual.format(LONG + str(i)))) for i in range(12)]
    rows += [(50, "https://user@host.example:80/b?x", page(odd)), (51, "http://other.example", page(odd)), (52, None, page(odd)), (53, "no url", None),
             (0, "http://Host.example/a", rows[0][2]), (None, "http://host.example", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "5 as path").repartition(4)
    made = main_text(pages)
    assert made.columns == ["page_id", "url", "text", "path"]
    found = {r.page_id: r for r in made.collect()}
    assert made.count() == len(rows)
    assert found[3].text == f"{LONG}3 {LONG}3" and found[50].text == "brief"
    assert found[51].text == found[52].text == f"{LONG} {LONG}"
    assert found[53].text == found[None].text == ""
    assert main_text(pages.limit(0)).count() == 0
    hosts = [r[0] for r in pages.where("page_id in (50, 52, 53)").orderBy("page_id").select(host_of(pages["url"])).collect()]
    assert hosts == ["host.example", None, None]


def test_query_gives_the_articles(spark, data):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    rows = QUERIES["op8_html_text"](spark, data).collect()
    assert len(rows) == len(pages)
    for r in rows:
        # every page of the table has one article and only these marks in it
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S).group(1)
        plain = re.sub(r"<[^>]+>", "", re.sub(r"</?(?:p|h1|br|ul|li)\b[^>]*>", " ", article))
        assert r.text == " ".join(html.unescape(plain).split()) and r.n_chars == len(r.text)
