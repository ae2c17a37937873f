import pytest

from silverline.llm.html_text import extract_text, fit, learn_weights, main_text

BODY = "<p>The harvest began early this year, and most growers had finished before the rains came.</p><p>Prices stayed &pound;3 below\n those of last year&#39;s  crop.</p>"
TEXT = "The harvest began early this year, and most growers had finished before the rains came. Prices stayed £3 below those of last year's crop."
MENU = "<nav><ul>" + "".join(f"<li><a href=/{k}>Section {k}</a></li>" for k in range(12)) + "</ul></nav>"


@pytest.fixture(scope="module")
def untrained():
    return fit({}, {})


@pytest.mark.parametrize("page", [
    f"<html><head><title>Farm news</title><script>var a = '<p>no</p>';</script></head><body>{MENU}<article>{BODY}</article><footer>All rights reserved by the paper</footer></body></html>",
    f"<body><header><a href=/>Home</a> The Daily Farm</header>{MENU}<main>{BODY}<aside>Read also: ten ways to dry hay</aside></main><div class='cookie-notice'>We use cookies on this site</div></body>",
    f"<body>{MENU}<div id=content>{BODY}</div><section class='comments'><h2>Comments</h2><p>I do not agree with any of this at all.</p></section><form>Your mail <input> <label>Name of reader</label></form></body>",
    f"<div class=ad>Buy two tractors, pay for one</div><div>{BODY}</div><div class='sidebar'>{MENU}</div><!-- <p>hidden words of a comment</p> --><noscript>Please switch on scripts</noscript>",
    f"<article><h1></h1>{BODY}<div style='display: none'>hidden words</div><div hidden>more hidden words</div></article>",
    f"<article>{BODY}",
])
def test_pages(untrained, page):
    assert main_text(page, untrained) == TEXT


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("   ", ""), ("<p></p>", ""), ("plain  words\nonly", "plain words only"), ("<p>a<b>b</b>c<br>d", "abc d"),
    ("<article>1 &lt; 2 &amp;&nbsp;3 &#x41;</article>", "1 < 2 & 3 A"), ("<article>a <!-- never closed", "a"), ("<p title='a > b'>x</p>", "x"),
    ("<p>a < b</p>", "a < b"), ("</p></div>x<", "x<"), ("<article>" + "<p>word" * 3000, " ".join(["word"] * 3000)),
    ("<div>" * 5000 + "deep" + "</div>" * 5000, "deep"), ("<article><script>x</article>", ""),
])
def test_edges(untrained, page, text):
    assert main_text(page, untrained) == text


def test_weights_come_from_labelled_pages(spark):
    """A class that no list knows is boilerplate once the labels say so."""
    page = "<body><div class=zebra>{0} offers of the week in all our shops today</div><article><p>Story {0}: " + BODY[3:] + "</article></body>"
    pages = spark.createDataFrame([(k, page.format(k)) for k in range(80)], "page_id long, html string")
    learned = learn_weights(pages)
    other = f"<body><div class=zebra>Many offers of the week in all our shops today</div><div>{BODY}</div></body>"
    assert main_text(other, learned) == TEXT
    assert learned.features["zebra"] < -2.5 < learned.features["p"]


def test_frames(spark):
    df = spark.createDataFrame([(1, None, 3), (2, f"<article>{BODY}</article>", 3), (2, f"<article>{BODY}</article>", 3)], "page_id long, html string, Text int")
    rows = extract_text(df, learn_weights(df)).collect()
    assert [(r.text, r.n_chars) for r in rows] == [("", 0), (TEXT, len(TEXT)), (TEXT, len(TEXT))]
    assert extract_text(df.limit(0), learn_weights(df.limit(0))).collect() == []


def test_marked_content_is_whole():
    """Costs of tags that stand in menus and names around the content take nothing from a marked article."""
    menus = {(t, False): 10_000 for t in ("a", "/a", "li", "/li", "ul", "/ul")}
    learned = fit({}, menus)
    assert learned.tags["li"] > 5
    items = "<ul>" + "".join(f"<li><a href=/{k}>three word item{k}</a></li>" for k in range(40)) + "</ul>"
    listed = " ".join(f"three word item{k}" for k in range(40))
    aside = "<aside>" + "word " * 900 + "</aside>"
    for inside, text in ((BODY + items, f"{TEXT} {listed}"), (items + BODY, f"{listed} {TEXT}"), (BODY + items + BODY, f"{TEXT} {listed} {TEXT}"),
                         (BODY + aside + BODY, f"{TEXT} {TEXT}")):
        assert main_text(f"<body>{MENU}<article>{inside}</article>{MENU}</body>", learned) == text
        for around in ("<html class=nav><body class='no-sidebar'>{}", "<body><div class='has-comments'>{}</div>", "<div id=login-social><section class=promo>{}</section></div>"):
            assert main_text(around.format(f"{MENU}<main>{inside}</main>{MENU}"), learned) == text


@pytest.mark.parametrize("around", ["<body class='no-sidebar'>{}</body>", "<div class='has-comments'>{}</div>"])
def test_names_around_most_words_without_an_article(untrained, around):
    assert main_text(around.format(f"{MENU}<div>{BODY}</div><div class='comments'>I do not agree</div>"), untrained) == TEXT


@pytest.mark.parametrize("inside,want", [
    ("<div class='share-price'><p>Shares rose by two.</p></div>", "Shares rose by two."),
    ("<section class=\"related-work\"><p>Others came before us.</p></section>", "Others came before us."),
    ("<div class='share'><p>Send to a friend</p></div>", ""),
    ("<div class='cookie-notice'>We use cookies</div>", ""),
    ("<object data=x><p>after</p>", "after"),
    ("<div><select><option>one<option>two</div><p>after</p>", "one two after"),
    ("<p>before</p><select><option>one</select><p>after</p>", "before after"),
    ("<p>before</p><svg><text>label</text></svg><button>Go</button><math><mi>x</mi></math><p>after</p>", "before after"),
    ("<p>a<object><p>fallback</object>b", "a b"),
    ("<script>if (a < b) document.write('<p>x')</script><p>after</p>", "after"),
])
def test_sections_of_marked_content(untrained, inside, want):
    page = f"<html><head><title>t</title><meta a=b><body>{MENU}<article>{BODY}{inside}</article><footer>All rights reserved</footer>"
    assert main_text(page, untrained) == (TEXT + " " + want).strip()


def test_a_head_that_never_ends(untrained):
    assert main_text(f"<head><title>t</title><link rel=x>{MENU}<article>{BODY}</article>", untrained) == TEXT
