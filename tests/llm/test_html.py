import pytest

from custarc.llm.html_text import extract, main_text

LONG = "The story of the town and of the people who were in it is one that has been told for a long time by all who live there, and it will be told again. "


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   <p> </p>", ""),
    ("<article><h1>Title &amp; more</h1><p>One<br>two  three.<p>Short.</article><footer>Foot</footer>", "Title & more\nOne two three.\nShort."),
    ("<nav><ul><li><a href=x>Home</a></li></ul></nav><article><p>Body</p><form>Name <input></form><aside>Ad</aside><p>End</p></article>", "Body\nEnd"),
    ("<article><header><h1>T</h1></header><p>B</p><section class='comments'><p>" + LONG + "</p></section></article>", "T\nB"),
    ("<div class=\"ad\">Buy</div><main><p>x &lt; y &#233;&nbsp;z</p><script>if (a < b) '</p>'</script></main>", "x < y é z"),
    ("<!-- <p>no</p> --><article><p>a<!-- b -->c</p><style>p{}</style></article>", "ac"),
    ("<nav><ul><li>Menu<article><p>Unclosed menu</p></article>", "Unclosed menu"),
    ("<div id='cookie-notice'><p>" + LONG + "</p></div><div class='post'><p>Yes</p></div>", "Yes"),
    ("<div class='layout has-sidebar'><div class='sidebar'><p>side</p></div><main><div class='post-header'><h1>T</h1></div><p>B</p></main></div>", "T\nB"),
    ("<article><p>text<p hidden>no</p><p style='display: none'>no</p></article>", "text"),
    ("<article><ul><li>item</li><li><a href=x>link only</a></li></ul></article>", "item"),
    ("<article><p>a <a href=\"x>y\">b</a> c</p><p>1 < 2 and 3 > 2", "a b c\n1 < 2 and 3 > 2"),
    ("<body><p>" + LONG * 2 + "</p><p>Short one</p><p>" + LONG * 2 + "</p><div><a href=x>" + LONG + "</a></div></body>",
     (LONG * 2).strip() + "\nShort one\n" + (LONG * 2).strip()),
])
def test_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("<body><form id='form1'><nav><a href=x>Home</a></nav><article><h1>T</h1><p>Body</p></article></form></body>", "T\nBody"),
    ("<body><form id='aspnetForm'><div><a href=x>Home</a></div><div><p>" + LONG * 2 + "</p><p>Short</p><p>" + LONG * 2 + "</p></div></form></body>",
     (LONG * 2).strip() + "\nShort\n" + (LONG * 2).strip()),
    ("<body><form><p>Your name</p><p>Your town</p></form><article><p>B</p></article></body>", "B"),
    ("<article><p>B</p><section id='discussion'><h2>Discussion</h2><p>Brief</p></section></article>", "B\nDiscussion\nBrief"),
    ("<article><h2 id='related-work'>Related work</h2><p>B</p><h2 id='search'>Search</h2><p>C</p></article>", "Related work\nB\nSearch\nC"),
    ("<article><p>B</p><div class='alert'><p>Note</p><p>" + LONG * 2 + "</p></div><div class='alert'>Saved</div></article>", "B\nNote\n" + (LONG * 2).strip()),
    ("<main><p>B</p><div class='related'><p><a href=x>" + LONG * 2 + "</a></p></div><section id='comments'><p>" + LONG * 2 + "</p></section></main>", "B"),
    ("<div class='alert'><p>" + LONG * 2 + "</p></div><main><p>B</p></main>", "B"),
])
def test_forms_and_names_that_hold_main_text(page, text):
    assert main_text(page) == text


THREE = "".join(f"<p>{LONG * 2}{k}</p>" for k in range(3))


@pytest.mark.parametrize("before, after", [
    ("<div class='wrap sidebar-right'>", "</div>"), ("<div class='layout-right-sidebar'><article>", "</article></div>"),
    ("<div id='page' class='nav-open'><main>", "</main></div>"), ("<div class='header-fixed'>", "</div>"),
    ("<article class='post comments-open'>", "</article>"), ("<article class='post tag-newsletter category-discussion'>", "</article>"),
    ("<main class='page-search-guide'>", "</main>"), ("<article title='The hidden city'>", "</article>"),
    ("<article data-hidden='false'>", "</article>"), ("<article data-id='ad-7'>", "</article>"),
    ("<div class=sidebar><nav>x</nav><article>", "</article></div>"), ("<div class='modal-open'><div class='content'>", "</div></div>"),
])
def test_names_never_empty_a_page(before, after):
    text = "\n".join(f"{LONG * 2}{k}" for k in range(3))
    assert main_text(f"<body>{before}{THREE}{after}</body>") == text
    # Beside the article, such a name marks what it says.
    aside = f"<div class='sidebar-right'><p>{LONG * 2}</p></div><div class='comments-area'><article class='comment'><p>{LONG}</p></article></div>"
    assert main_text(f"<body><article>{THREE}</article>{aside}</body>") == text


def test_hidden_text_and_unknown_languages():
    assert main_text("<article><p>a <span hidden>no</span>b <b style='display:none'>x<i>y</i></b>c</p><p>d<span hidden>open</p><p>e</p></article>") == "a b c\nd\ne"
    assert main_text("<article><p>a <img hidden>b <a hidden=until-found href=x>n</a></p></article>") == "a b"
    told = "Talon kansa kertoi pitkän tarinan kaupungista ja sen ihmisistä, jotka olivat asuneet siellä kauan ennen kuin joki muutti suuntaansa. " * 2
    page = f"<body><div><a href=x>Koti</a> <a href=y>Kartta</a></div><p>{told}</p><p>{told}</p><div><a href=z>{told}</a></div></body>"
    assert main_text(page) == f"{told.strip()}\n{told.strip()}"


def test_random_pages():
    """Pages put together from parts that are known to belong to the article or not."""
    import random

    r = random.Random(11)
    wrappers = ["<div class='wrap has-sidebar'>{}</div>", "<div id='page-header-fixed'>{}</div>", "<form id=f>{}</form>", "<div class='theme-search nav-up'>{}</div>", "{}",
                "<div data-ad='1' title='comments'>{}</div>"]
    articles = ["<article class='post tag-ads'>{}</article>", "<main id='search-results-page'>{}</main>", "<div role=main>{}</div>", "<article>{}</article>"]
    junk = ["<nav><ul><li><a href=x>Home</a></li></ul></nav>", f"<div class='ad'>{LONG}</div>", f"<aside><p>{LONG * 2}</p></aside>", f"<footer><p>{LONG}</p></footer>",
            f"<section id='comments'><p>{LONG * 2}</p></section>", "<form><label>Mail</label><input></form>", f"<div class='cookie-banner'><p>{LONG}</p></div>",
            f"<div class='sidebar'><h2>About</h2><p>{LONG * 2}</p></div>", "<script>var x = '<p>';</script>", f"<p hidden>{LONG}</p>", f"<ul class='related-posts'><li><a href=x>{LONG}</a></li></ul>"]
    inner = [("<p>{}</p>", 1), ("<h2 id='comments'>{}</h2>", 1), ("<p>{}<br></p>", 1), ("<div class=ad>{}</div>", 0), ("<ul><li>{}</li></ul>", 1), ("<blockquote>{}</blockquote>", 1),
             ("<div class='newsletter-signup'><p>{}</p></div>", 0), ("<section id='related-work'>{}</section>", 1), ("<aside>{}</aside>", 0)]
    for _ in range(300):
        body, truth = ["<h1>Title</h1>"], ["Title"]
        for k in range(r.randint(1, 8)):
            markup, kept = r.choice(inner)
            text = r.choice((f"Short {k}", LONG.strip() + f" {k}", f"Tom &amp; Ann {k}"))
            body.append(markup.format(text))
            truth += [text.replace("&amp;", "&")] * kept
        page = r.choice(articles).format("".join(body))
        for _ in range(r.randint(0, 3)):
            page = r.choice(wrappers).format(page)
        page = "".join(r.sample(junk, 3)) + page + "".join(r.sample(junk, 3))
        assert main_text(f"<html><body class='nav-open search'>{page}</body></html>") == "\n".join(truth), page


def test_long_pages_take_time_in_proportion():
    assert main_text("<article>" + "<p>a" * 100000).count("\n") == 99999
    for odd in ("<" * 100000, "<a " * 50000, "<a href=\"" * 30000, "<!--" * 50000, "&" * 100000, "<div>" * 20000):
        main_text(odd)


def test_column(spark):
    pages = spark.createDataFrame([(1, "u", "<article>a</article>"), (1, "u", "<article>a</article>"), (None, None, None)], "page_id long, url string, html string")
    out = extract(pages)
    assert out.columns == ["page_id", "url", "text"]
    assert sorted(str(r.text) for r in out.collect()) == ["", "a", "a"]
    assert extract(pages.limit(0)).collect() == []
