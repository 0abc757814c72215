import html
import random
import re
import time

import pytest

from tidemark.llm.common import table
from tidemark.llm.html_text import PLAIN, SHARE, WINDOW, extract_text, main_text

ARTICLE = ["Title &amp; more", "First paragraph with a fair number of words in it, so that it counts.", "Second &eacute;t&eacute;  one\n goes on&nbsp;here."]
TEXT = "Title & more First paragraph with a fair number of words in it, so that it counts. Second été one goes on here."
BODY = f"<h1>{ARTICLE[0]}</h1><p>{ARTICLE[1]}</p><p>{ARTICLE[2]}</p>"
AROUND = [
    "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>About us and the rest of it all</a></li></ul></nav>",
    "<header><div class=logo>The site's name, and what it stands for</div></header>",
    "<footer>&copy; someone &middot; all rights reserved, whatever they may be</footer>",
    "<aside><p>Read also this long teaser text about something else entirely, please.</p></aside>",
    "<div class='ad'>Buy this now, it is a very long advertisement with many words in it.</div>",
    "<div id=\"comments\"><div class=comment><p>First! I am a reader and I have something to say.</p></div></div>",
    "<form><label>Your name</label><input name=n><button>Send it off to us now</button></form>",
    "<script>var x = '<p>not text</p>';</script><style>p{color:red}</style>",
    "<!-- a comment <p>with markup</p> --><noscript>Turn it on</noscript>",
    "<div class=\"cookie-notice\">We use cookies, as everybody does, to do what everybody does.</div>",
    "<section role=complementary>More links to other things that nobody reads</section>",
]


@pytest.mark.parametrize("around", AROUND)
@pytest.mark.parametrize("main", ["<article>{}</article>", "<main>{}</main>", "<div class=content>{}</div>", "{}"])
def test_parts_around_the_text(around, main):
    text = main.format(BODY)
    for page in (around + text, text + around, around + text + around):
        assert main_text(f"<!DOCTYPE html><html><head><title>T</title></head><body>{page}</body></html>") == TEXT


def test_odd_markup():
    assert main_text(None) == main_text("") == main_text("   ") == main_text("<p></p>") == main_text("<script>x") == ""
    assert main_text("plain   text\n only") == "plain text only"
    assert main_text("<p>a &lt;b&gt; &#233; &#x41; &am &amp c") == "a <b> é A &am & c"
    assert main_text("<p>one<br>two<p>three") == "one two three"
    assert main_text("<p>wo<b>r</b>d</p>") == "word"
    assert main_text("<p>cut off <a href='x") == "cut off"
    assert main_text('<p title="a > b">x</p>') == "x"
    assert main_text('<div class="page sidebar"><p>all of it is here</p></div>') == "all of it is here"
    assert main_text("<nav>never closed<article><p>text</p></article>") == "text"


def test_an_advert_inside_an_article_does_not_split_it():
    page = f"<article><p>{ARTICLE[1]}</p><div class=ad>Buy</div><p>short end</p></article><footer>f</footer>"
    assert main_text(page) == ARTICLE[1] + " short end"


def test_long_page():
    words = ["word " * 50] * 20_000
    assert len(main_text("<article>" + "".join(f"<p>{w}</p>" for w in words) + "</article>")) == 20_000 * 250 - 1


def test_rows(spark):
    rows = [(1, "u", BODY, "x"), (1, "u", BODY, "x"), (2, None, None, "x"), (None, "v", "", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = extract_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, [(1, "u", TEXT, len(TEXT))] * 2 + [(2, None, "", 0), (None, "v", "", 0)]))
    assert extract_text(pages.limit(0)).count() == 0


def test_given_pages(spark, sf_dir):
    """Against the article element, read by its tags alone."""
    pages = {r.page_id: r.html for r in table(spark, sf_dir, "pages").collect()}
    for row in extract_text(table(spark, sf_dir, "pages")).collect():
        inside = re.search(r"<article>(.*?)</article>", pages[row.page_id], re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", "", x))).strip() for x in re.split(r"</?(?:p|h1|br)>", inside)]
        assert row.text == " ".join(x for x in blocks if x)


LEFT_OUT = "<div class=ad>Buy this now, it is a very long advertisement with many words in it.</div>"
FLOWS = [
    (f"<p>{'word ' * 60}</p>{LEFT_OUT}<p>A last paragraph that is short.</p>", "word " * 60 + "A last paragraph that is short."),
    (f"<h1>Title</h1><div class=share>Tell all</div><p>{'word ' * 60}</p>", "Title " + ("word " * 60).strip()),
    (f"{LEFT_OUT}<p>{'lone ' * 40}</p>{LEFT_OUT}" + f"<p>{'word ' * 60}</p>" * 3, "lone " * 40 + ("word " * 180).strip()),
    (f"<p>{'word ' * 60}</p>{LEFT_OUT}<div><p>inset</p></div>{LEFT_OUT}<ul><li>end</ul>", "word " * 60 + "inset end"),
    (f"<p>{'word ' * 60}{LEFT_OUT}end</p><form>Your name</form>tail", "word " * 60 + "end tail"),
]


@pytest.mark.parametrize("page, text", FLOWS)
@pytest.mark.parametrize("main", ["<article>{}</article>", "<div class=content>{}</div>", "<table><tr><td>{}</table>", "{}"])
def test_parts_left_out_inside_the_text_do_not_cut_it(page, text, main):
    assert main_text(f"<html><body><nav>n</nav>{main.format(page)}<footer>f</footer></body></html>") == text


def test_parts_in_elements_of_their_own_stay_apart():
    page = f"<div class=top>Skip all this</div><nav>n</nav><div><p>{'word ' * 60}</p>{LEFT_OUT}<p>end</p></div><form>f</form><div>All the rest</div>"
    assert main_text(f"<body><div>{page}</div></body>") == "word " * 60 + "end"
    deep = "<div>x<nav>n</nav>" * 20_000 + "</div>" * 20_000
    assert len(main_text(deep)) > 0


STAYS = [
    '<div style="overflow:hidden">{}</div>',
    '<div title="a hidden gem">{}</div>',
    '<div data-hidden="false">{}</div>',
    '<div class="content has-sidebar">{}</div>',
    '<div class="page no-ads">{}</div>',
    "<section id=related-work>{}</section>",
    "<div class=notice-board>{}</div>",
    "<div data-role=navigation id='the\"footer'>{}</div>",
]


@pytest.mark.parametrize("holder", STAYS)
def test_words_in_attributes_that_say_nothing(holder):
    assert main_text(f"<body>{holder.format(BODY)}<div>Contact us</div></body>").startswith(TEXT)
    inside = BODY.replace("<p>", holder.split("{}")[0] + "<p>").replace("</p>", "</p>" + holder.split("{}")[1])
    assert main_text(f"<article>{inside}</article>") == TEXT


@pytest.mark.parametrize("name", ["cookie-notice", "site-header", "top-nav", "article-comments", "ad", "sidebar left", "ad-2"])
def test_names_of_parts_around(name):
    assert main_text(f"<body><div class='{name}'>{'around ' * 30}</div><div>{BODY}</div></body>") == TEXT


@pytest.mark.parametrize(
    "page",
    ["<a " + "'\"" * 5_000, "<a =" + "'\"=" * 5_000, "<a " * 100_000, "<a b='" * 50_001, '<a b=">"' * 50_000, "<!x" * 100_000, "<script>" * 100_000, "<nav>" * 100_000 + "</nav>" * 99_999,
     "<div class='" + "a-" * 500_000 + "'>x</div>", ("<p>" + "word &amp; word " * 40 + "</p>") * 16_000, "</script" * 100_000 + "<p>x", "<!--" * 100_000, "<a b = " + " " * 100_000 + "'" * 9],
)
def test_time_grows_with_the_page(page):
    began = time.process_time()
    main_text(page)
    main_text("<p>before</p>" + page + "<p>after</p>")
    assert time.process_time() - began < 2 * (1 + len(page) / 3_000_000)


def plainly(blocks):
    """The rule over given blocks of text, '' for a part left out: each run from surge to dive by its highest block."""
    lines = []
    for x in blocks:
        lines += [x] if x else [""] * 4
    size = [sum(len(x) for x in lines[i : i + WINDOW]) for i in range(len(lines))]
    runs = [[]]
    for i, n in enumerate(size):
        runs[-1].append(i) if n else runs.append([])
    peaks = [max((size[i] for i in r), default=0) for r in runs]
    kept = [r for r, p in zip(runs, peaks) if p and (p == max(peaks) or p >= PLAIN and p >= SHARE * max(peaks))]
    return " ".join(lines[i] for r in kept for i in r if lines[i])


def test_against_plain_line_blocks():
    """Pages without an article: every block in an element of its own, between parts that are left out."""
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdefg") for _ in range(draw.randint(1, 8)))
    for _ in range(200):
        groups, blocks = [], []
        for _ in range(draw.randint(1, 9)):
            own = [" ".join(word() for _ in range(draw.choice([1, 3, 20, 60]))) for _ in range(draw.randint(1, 3))]
            groups.append("<div>" + "".join(f"<p>{x}</p>" for x in own) + "</div>")
            blocks += [*own, ""]
        page = draw.choice(["<nav>home</nav>", "<div class=ad>buy</div>", "<footer>f</footer>"]).join(groups)
        assert main_text(f"<html><body><section>{page}</section></body></html>") == plainly(blocks)
