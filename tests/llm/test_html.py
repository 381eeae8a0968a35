import html as entities
import re

import pytest

from llm_fixtures import SF_SMALL, no_docs, odd_docs  # noqa: F401
from vartab.llm import html
from vartab.llm.common import table
from vartab.llm.queries import op6_html_extraction

BOILER = ('<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News of the day</a></li></ul></nav>'
          '<div id="cookie-notice">We use cookies and the like for you to have the best of the web.</div>')
TEXT = ("The first paragraph of the article is about the things that have been in the news, and it is as long as a "
        "paragraph of an article should be so that the rules see it as text and not as a part of the frame of the page.")


def test_given_pages(spark):
    """In the given pages the article element is the text; here by plain regular expressions."""
    pages = {r.page_id: r.html for r in table(spark, SF_SMALL, "pages").collect()}
    rows = op6_html_extraction(spark, SF_SMALL).collect()
    assert len(rows) == len(pages)
    for r in rows:
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r.page_id], re.S)[1]
        plain = entities.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", body)))
        assert r.text == " ".join(plain.split()) and r.n_chars == len(r.text)


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<html><body></body></html>", ""), ("just some words of text", "just some words of text"),
    ("<p>a &lt;b&gt; &amp c &#233;&eacute;</p>", "a <b> & c éé"), ("<!-- <p>no</p> --><p>yes</p>", "yes"),
    ("<article><p>One.<p>Two <b>bold</b> words.</article><footer>foot</footer>", "One. Two bold words."),
    ("<article><p>x<script>var a = '</p><p>';</script> y</p><style>p{}</style></article>", "x y"),
    ("<article><header><h1>Head</h1></header><p>Text.</p><div class='comments'><p>First!</p></div></article>", "Head Text."),
    ("<article><p>Text.</p><aside>More</aside><form><p>Subscribe</p></form></article>", "Text."),
    ("<article><p>Unclosed <b>text", "Unclosed text"), ("<p>" + "y" * 30, "y" * 30),
    (BOILER + f"<div><p>{TEXT}</p><p>Short one.</p><p>{TEXT}</p></div><footer>&copy; the owner of the site</footer>",
     f"{TEXT} Short one. {TEXT}"),
    (f"<div><p>{TEXT}</p></div><div><a href=x>more of the same</a> <a href=y>and the rest of it</a></div>", TEXT),
    ("<article>" + "<div>" * 500 + "deep" + "</div>" * 500 + "</article>", "deep"),
])
def test_rules(page, text):
    assert html.main_text(page) == text


def test_second_pass_takes_the_label_of_the_nearest():
    menu = "<div><a href=x>" + "more of the same " * 8 + "</a></div>"
    blocks = html.classify(html.blocks_of(f"<div><p>{TEXT}</p><p>In between.</p><p>{TEXT}</p></div>{menu}<div>At the end.</div>"))
    assert [b.verdict for b in blocks] == ["good", "good", "good", "bad", "bad"]


def body_of(page):
    body = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
    return " ".join(entities.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", body))).split())


def test_given_pages_without_their_article_element(spark):
    """The same pages with the container renamed: what the rules alone find."""
    pages = [r.html for r in table(spark, "/root/testdata/sf0.01", "pages").collect()]
    same = kept = whole = 0
    for page in pages:
        got, want = html.main_text(page.replace("<article>", "<div class=story>").replace("</article>", "</div>")), body_of(page)
        same += got == want
        kept += len(got) if got in want or got == want else 0
        whole += len(want)
        assert got or not want
    assert same >= 0.9 * len(pages) and kept >= 0.97 * whole, (same, len(pages), kept / whole)


SCRIPTS = {
    "ru": "В первой части статьи речь идёт о том, что в городе и в области было в эти дни, и о том, что из этого вышло. "
          "Во второй части мы говорим о людях, и о том, как они в это время жили, и что они об этом думали и говорили.",
    "el": "Το πρώτο μέρος του άρθρου είναι για την πόλη και για τη χώρα, και για το τι έγινε στην πόλη και στη χώρα. "
          "Το δεύτερο μέρος είναι για τους ανθρώπους και για το πώς έζησαν στην πόλη και στη χώρα αυτές τις μέρες.",
    "ja": "これは最初の段落です。" * 12, "fr": "La première partie de l'article est pour la ville et pour le pays, et ce qui est dans la ville. " * 3,
}


@pytest.mark.parametrize("lang", SCRIPTS)
def test_pages_in_four_scripts(lang):
    text = " ".join(SCRIPTS[lang].split())
    page = (f"<body><header><a href=/>Site</a></header>{BOILER}<div class='page no-sidebar'><h1>{text[:30]}</h1><p>{text}</p>"
            f"<p>{text[:20]}</p><p>{text}</p><p>{text[:25]}</p></div><div class=sidebar><p>{text}</p></div><footer>{text}</footer></body>")
    assert html.main_text(page) == f"{text[:30]} {text} {text[:20].strip()} {text} {text[:25].strip()}"


@pytest.mark.parametrize("page, text", [
    (f"<div class='page no-sidebar'><p>{TEXT}</p></div>", TEXT), (f"<article class='post related-post'><p>{TEXT}</p></article>", TEXT),
    (f"<article><p>{TEXT}</p></article><div><p>{TEXT} And more.</p></div>", f"{TEXT} {TEXT} And more."),
    (f"<article><p>{TEXT}</p><ul><li><a href=x>One link of the text</a></li></ul></article>", f"{TEXT} One link of the text"),
    (f"<article><p>{TEXT}</p>" + "<li><a href=x>Link</a></li>" * 4 + "</article>", TEXT),
    (f"<div><h1>Head</h1><p>{TEXT}</p><p>The end.</p></div>", f"Head {TEXT} The end."),
    (f"<div class='comments'><p>{TEXT}</p></div><div><p>{TEXT[:60]}</p></div>", TEXT[:60].strip()),
    (f"<article class=comment><p>{TEXT}</p></article><main><p>{TEXT[:90]}</p></main>", TEXT[:90].strip()),
    (f"<div class=widget><p>{TEXT}</p></div>", TEXT), (f"<div><p>{TEXT}</p><p>a | b | c | dd | eee | ffff | ggggg | hh | iii | jjjj | kkkkk | lll | m</p></div>",
                                                      f"{TEXT} a | b | c | dd | eee | ffff | ggggg | hh | iii | jjjj | kkkkk | lll | m"),
])
def test_class_names_and_what_stands_outside(page, text):
    assert html.main_text(page) == text


def test_odd_rows(spark):
    rows = [(1, "u", "<p>one</p>", "x"), (1, "u", "<p>one</p>", "x"), (None, None, None, None), (2, "v", "<p>" + "word " * 50_000, "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html.extract(pages).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, 3), (1, 3), (2, 249_999)]
    assert html.extract(pages.limit(0)).collect() == []
