import html
import re

from gatewise.llm import html_text
from gatewise.llm.html_text import main_text
from gatewise.llm.queries import QUERIES

from .conftest import SF, table


def brute(page):
    """The article of a test page by patterns."""
    article = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
    return "\n\n".join(b for b in blocks if b)


def test_query_matches_the_articles(spark):
    rows = {r["page_id"]: r for r in QUERIES["op5_text_to_tag_ratio"](spark, SF).collect()}
    pages = table(spark, "pages").collect()
    assert len(rows) == len(pages)
    for p in pages:
        r = rows[p["page_id"]]
        assert (r["url"], r["text"], r["n_chars"]) == (p["url"], brute(p["html"]), len(r["text"]))


def test_parts_that_are_not_the_article():
    page = """<html><head><title>no</title><style>p{}</style></head><body><header><h2>no</h2></header>
    <nav>no</nav><div id="cookie-notice">no</div><main><div class="post"><h1>T&eacute;st</h1>
    <p>Para <a href=x>one</a>&nbsp;two<br>three</p><ul><li>a</li><li>b</li></ul>
    <div class="user comments"><article><p>no</p></article></div><form><p>no</p></form><aside>no</aside>
    <p>last<script>var x = "<p>no";</script> words</p></div></main><div class=sidebar>no</div><footer>no</footer>"""
    assert main_text(page) == "Tést\n\nPara one two three\n\na\n\nb\n\nlast words"


def test_ratio_clusters_pick_the_region_without_an_article():
    text = "<p>" + "A sentence that says something at length about a thing. " * 4 + "</p>"
    links = "".join(f"<a href={i}>l{i}</a> " for i in range(12))
    page = f"<body><div><ul><li>{links}</li></ul></div><div>{text * 3}<p>Short.</p>{text}</div><div>{links}</div></body>"
    out = main_text(page).split("\n\n")
    assert len(out) == 5 and out[3] == "Short." and "l1" not in main_text(page)


def test_smoothing_keeps_a_constant_and_the_threshold_splits():
    import numpy as np
    assert np.allclose(html_text.smoothed(np.full(9, 3.0)), 3.0)
    assert 1 < html_text.threshold(np.array([1.0, 1, 1, 9, 9])) < 9


def test_broken_and_odd_pages(spark):
    assert main_text("") == "" and main_text("<nav>x") == ""
    assert main_text("plain") == "plain"
    assert main_text("<article><p><b>a<br><p>b</article>") == "a\n\nb"
    assert main_text("</p></div><article>a &amp;amp; b &#x41; &unknown; <br/>c") == "a &amp; b A &unknown; c"
    assert main_text("<article>" + "<div>" * 3000 + "deep") == "deep"
    long = "word " * 200_000
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<article>n</article>", "x"),
            (4, "u", f"<article><p>{long}</p></article>", "x"), (4, "u", "<article>n</article>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((str(r["page_id"]), r["n_chars"]) for r in html_text.extract(pages).collect()))
    assert got == sorted([("1", 0), ("2", 0), ("None", 1), ("4", len(long) - 1), ("4", 1)])
    assert html_text.extract(pages.limit(0)).collect() == []


def test_the_articles_are_found_without_their_tags(spark):
    for p in table(spark, "pages").collect():
        bare = re.sub(r"</?article>", "", p["html"])
        assert bare != p["html"] and main_text(bare) == brute(p["html"])


def test_clusters_choose_when_the_article_element_holds_little():
    text = "<p>" + "A sentence that says something at length about a thing. " * 4 + "</p>"
    page = f"<body><div><article><a href=1>Read on</a></article></div><div>{text * 4}</div></body>"
    assert main_text(page).count("A sentence") == 16


def test_ratios_leave_unnamed_links_out_without_an_article():
    text = "<p>" + "A sentence that says something at length about a thing. " * 4 + "</p>"
    links = "".join(f"<li><a href={i}>l{i}</a></li>" for i in range(12))
    page = f"<body><nav>{links}</nav><div><ul>{links}</ul></div><section>{text * 4}</section><div><ul>{links}</ul></div></body>"
    assert main_text(page).count("A sentence") == 16 and "l1" not in main_text(page)


def test_an_aside_inside_a_line_does_not_split_it():
    assert main_text("<article><p>one <button>Share</button>two</p><p>three</p></article>") == "one two\n\nthree"


LONG = "A sentence that says something at length about one thing. " * 9


def test_a_teaser_article_does_not_replace_the_body():
    card = "<article class=card><h3>Read this too</h3><p>A short teaser of another story.</p></article>"
    for page in (f"<body>{card}<div class=post>{f'<p>{LONG}</p>' * 6}</div></body>",
                 f"<body><div class=post>{f'<div>{LONG}</div>' * 6}</div>{card}</body>"):
        assert main_text(page).count(LONG.strip()) == 6


def test_one_div_per_paragraph_keeps_short_lines_and_their_neighbours():
    links = "<div>" + "".join(f"<a href={i}>l{i}</a> " for i in range(12)) + "</div>"
    for at in range(9):
        lines = [f"{n} {LONG}".strip() for n in range(8)]
        lines.insert(at, "Short one.")
        page = f"<body>{links}<div>{''.join(f'<div>{x}</div>' for x in lines)}</div>{links}</body>"
        assert main_text(page) == "\n\n".join(lines)
        assert main_text(page.replace(links, "")) == "\n\n".join(lines)


def test_a_body_in_two_containers_is_kept_whole():
    part = f"<p>{LONG}</p>" * 3
    page = f"<body><div><div>{part}</div><div><h2>Next</h2></div><div><section>{part}</section></div></div></body>"
    assert main_text(page).count(LONG.strip()) == 6 and "Next" in main_text(page)


def test_a_lone_long_paragraph_takes_its_neighbours_along():
    lines = ["Tiny", LONG.strip() * 8, "End"]
    assert main_text("".join(f"<div>{x}</div>" for x in lines)) == "\n\n".join(lines)


def test_broken_markup_takes_linear_time():
    import time

    pages = ["<b>" * 20_000 + "</i>" * 20_000 + "text", "<p>" + "<b>" * 20_000 + "</p><i>" * 20_000,
             "<p><table><td>" + "<b>" * 20_000 + "</p>" * 20_000 + "text", "<div>" * 20_000 + "</p></span>" * 20_000]
    for page in pages:
        began = time.process_time()
        html_text.main_text(page)
        assert time.process_time() - began < 5


def test_unclosed_and_unmatched_tags():
    body = "long enough text of the article " * 20
    page = f"<body><nav><a href=x>menu</a></nav><article><p>{body}<b>bold</i> more<p>{body}</article></span><footer>end"
    assert html_text.main_text(page).split("\n\n") == [f"{body.strip()} bold more", body.strip()]
