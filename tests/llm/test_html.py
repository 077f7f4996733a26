import pytest

from clickloom.llm import html

ARTICLE = "<h1>Title &amp; more</h1><p>First paragraph of the article, long enough to matter.</p><p>Second\n  one &lt;here&gt;.</p>"
TEXT = "Title & more\nFirst paragraph of the article, long enough to matter.\nSecond one <here>."


@pytest.mark.parametrize("page", [
    f"<html><body><nav><a href=x>Home</a> <a>News</a></nav><article>{ARTICLE}</article><footer>&copy; all</footer></body></html>",
    f"<body><div id=main>{ARTICLE}</div><div class='sidebar'>Other things to read and read</div></body>",
    f"<body><header>Site name</header><div class='ad'>Buy now this and that</div><main>{ARTICLE}</main>",
    f"<body><script>var t='</p>';</script><style>p{{}}</style><div>{ARTICLE}</div>"
    "<section class='comments'><p>I liked this article very much, thank you for it, it was long.</p></section></body>",
    f"<body><form><label>Name</label><input><button>Go</button></form><div><div>{ARTICLE}</div></div>"
    "<div role='complementary'>aside</div><div hidden>no</div><p style='display: none'>no</p><!-- <p>no</p> --></body>",
    "<body><article><h1>Title &amp; more</h1><p><b>First paragraph of the article, long enough to matter.<br><p>Second"
    "\n  one &lt;here&gt;.</article><ul><li><a href=1>one</a><li><a href=2>two</a></ul>",
    f"<body><div class='cookie-notice'>We use cookies to make this better for you and others.</div><article>{ARTICLE}",
])
def test_only_the_article_is_left(page):
    assert html.main_text(page) == TEXT


def test_edge_pages(spark):
    pages = [(1, None), (2, ""), (3, "plain text"), (4, "<p>a<p>b"), (5, "<nav>only</nav>"), (6, "<p>open <b>bold"),
             (7, "a < b and <"), (8, "<p>" + "word " * 50_000 + "</p>"), (8, "<p>again</p>"), (9, "<p>&nbsp;x&#x41;&bogus;&am</p>")]
    df = spark.createDataFrame(pages, "page_id long, html string").withColumn("text", html.F.lit("mine"))
    out = html.extract(df)
    got = sorted((r["page_id"], r["text"][:20], r["n_chars"]) for r in out.collect())
    assert got == [(1, "", 0), (2, "", 0), (3, "plain text", 10), (4, "a\nb", 3), (5, "", 0), (6, "open bold", 9),
                   (7, "a < b and <", 11), (8, "again", 5), (8, "word word word word ", 249_999), (9, "xA&bogus;&am", 12)]
    assert html.extract(df.limit(0)).count() == 0


def test_links_weigh_against_a_block():
    links = "".join(f"<li><a href={i}>a rather long link text number {i}</a></li>" for i in range(30))
    page = f"<body><div><ul>{links}</ul></div><div>{ARTICLE}</div></body>"
    assert html.main_text(page) == TEXT


@pytest.mark.parametrize("page", [
    f"<body><div class='layout with-sidebar'><article>{ARTICLE}</article></div></body>",
    f"<body><div class='sidebar-layout'><article>{ARTICLE}</article><div class='sidebar'>Other</div></div></body>",
    f"<body><div class='no-sidebar'><div>{ARTICLE}</div></div></body>",
    f"<body><div class='widget'>{ARTICLE}</div></body>",
    "<article><div class='entry-header'><h1 id='search'>Title &amp; more</h1></div><section id='discussion'><p id='related-work'>"
    "First paragraph of the article, long enough to matter.</p></section><p class='notice'>Second one &lt;here&gt;.</p></article>",
    f"<div class='ad'>{'Buy now this and that. ' * 20}</div><article>{ARTICLE}</article>",
    f"<article>{ARTICLE}<section class='comments'><article><p>I liked it.</p></article></section></article>",
])
def test_names_do_not_cut_article_text(page):
    assert html.main_text(page) == TEXT


def test_formulas_are_kept():
    assert html.main_text("<article><p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p></article>") == "So x=1 holds."


def test_sections_of_unequal_density_without_an_article():
    long, short = (["".join(f"w{i}{j} " for j in range(n)).strip() for i in range(k)] for k, n in ((5, 75), (4, 30)))
    sections = ["<section>" + "".join(f"<p>{t}</p>" for t in part) + "</section>" for part in (long, short)]
    nav = "<div><a href=1>one</a> <a href=2>two</a></div>"
    for page in (f"<body>{nav}{sections[0]}{sections[1]}</body>",
                 f"<body>{nav}<div>{sections[0]}</div><div><div>{sections[1]}</div></div></body>"):
        assert html.main_text(page) == "\n".join(long + short)
    assert html.main_text(f"<body>Before{''.join(sections)}</body>") == "\n".join(["Before", *long, *short])


def test_elements_without_an_end_lose_nothing():
    assert html.main_text("<article><p>one</p><svg/><p>two</p></article>") == "one\ntwo"
    assert html.main_text("<article><p>one</p><object data=x><p>two</p></article>") == "one\ntwo"
    assert html.main_text("<article><p>one</p><select><option>x<p>two</p></article>").startswith("one")
    assert html.main_text("<article><p>one</p><svg><text>x</text></svg><p>two</p></article>") == "one\ntwo"


def test_deep_and_broken_markup_in_linear_time():
    import time

    begun = time.time()
    html.main_text("<div>" * 20_000 + "</span>" * 20_000 + "<p>text</p>")
    html.main_text("<b>" * 20_000 + "<li>x" * 20_000)
    html.main_text("<article>" * 5_000 + "<header>x</header>" * 5_000)
    html.main_text("<object>" * 20_000 + "text")
    assert time.time() - begun < 10


def test_a_post_keeps_the_title_in_its_header():
    prose = "A sentence that says something about the matter at hand. " * 5
    page = f"<body><div class=post><header><h1>Title</h1></header><p>{prose}</p><p>{prose}</p></div></body>"
    assert html.main_text(page).startswith("Title\n")
    site = f"<body><header><h1>The site</h1></header><div class=post><p>{prose}</p></div></body>"
    assert "The site" not in html.main_text(site)


def test_thin_blocks_beside_the_text_go_by_the_threshold():
    prose = "A sentence that says something about the matter at hand. " * 6
    thin = ["Buy shoes now at a discount today", "Menu / Home News Sport", "Sign up to our newsletter"]
    body = "".join(f"<div><span>{t}</span></div>" for t in thin)
    page = f"<body>{body}<section>{f'<p>{prose}</p>' * 5}</section><section>{f'<p>{prose[:150]}</p>' * 4}</section></body>"
    got = html.main_text(page)
    assert not any(t in got for t in thin) and got.count("\n") == 8


def brute_density(page, i):
    """The formula over the nodes below, summed anew for each node."""
    import math

    below = [j for j in range(i, page.last[i] + 1) if not page.beside[j]]
    chars, linked = sum(page.own[j] for j in below), sum(page.own_linked[j] for j in below)
    tags = sum(page.own_tags[j] for j in below) + len(below) - 1
    links = sum(page.own_link_tags[j] for j in below) + sum(page.tag[j] == "a" for j in below if j != i)
    if not chars:
        return 0.0
    every = [j for j in range(len(page.tag)) if not page.beside[j]]
    share = sum(page.own_linked[j] for j in every) / max(sum(page.own[j] for j in every), 1)
    tags, links, l1 = max(tags, 1), max(links, 1), max(linked, 1)
    base = math.log(chars / max(chars - linked, 1) * l1 + share * chars + math.e)
    return chars / tags * max(math.log(chars / l1 * tags / links), 0) / math.log(base + 1)


def test_densities_match_brute_force():
    import random

    rnd = random.Random(4)
    for _ in range(30):
        parts = [rnd.choice(["<div>", "</div>", "<p>", "</p>", "<a href=x>", "</a>", "<br>", "some words here ", "x "])
                 for _ in range(80)]
        page = html.Page("".join(parts))
        for i in range(len(page.tag)):
            if not page.beside[i]:
                assert abs(page.density(i) - brute_density(page, i)) < 1e-9
