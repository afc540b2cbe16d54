import check
from aeromart.llm import html as H
from aeromart.llm.queries import SQL, op9_html
from hypothesis import given, settings
from hypothesis import strategies as st

FOLDER = "/root/testdata/sf0.01"
PARAGRAPH = "A long enough paragraph, with words; and marks. It goes on, and on, until it ends."


def test_whole_table_equals_sql(spark):
    made = op9_html(spark, FOLDER)
    want = check.connect(FOLDER).sql(SQL["op9_html"])
    assert check.row_set([tuple(r) for r in made.collect()], made.columns) == check.row_set(want.fetchall(), want.columns)


def test_side_parts_go_and_the_rest_stays():
    page = f"""<html><head><title>T</title><style>a,b{{}}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
      <nav><a href=x>Home</a></nav><div id=cookie-notice>{PARAGRAPH}</div><div class=wrap><aside>{PARAGRAPH}</aside><div class=content>
      <h2>Title &amp; &#233;</h2><p>{PARAGRAPH}<p>Short<br>one <b>bo</b>ld&nbsp;.<ul><li>First<li>Second</ul><form>{PARAGRAPH}</form>
      <script>if (a<b) document.write("</p><p>no")</script><table><tr><td>c1<td>c2</table><!-- <p>no</p> --><p>{PARAGRAPH}
      <div class="ad banner">{PARAGRAPH}</div><section id=comments><article class=comment>{PARAGRAPH} no {PARAGRAPH}</article></section>
      </div></div><footer>{PARAGRAPH}</footer></body></html>"""
    assert H.main_text(page) == f"Title & é {PARAGRAPH} Short one bold . First Second c1 c2 {PARAGRAPH}"


def test_article_element_wins_over_longer_side_text():
    page = f"<body><div><p>{PARAGRAPH}</p></div><article><header><h1>Head</h1></header><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></article></body>"
    assert H.main_text(page) == f"Head {PARAGRAPH} {PARAGRAPH}"


def test_a_page_that_marks_everything_keeps_its_text():
    page = f"<body><nav>menu</nav><div class='widget'><p>{PARAGRAPH}</p></div><footer>foot</footer></body>"
    assert H.main_text(page) == PARAGRAPH


def test_no_content_is_lost_beside_the_largest_part():
    first, second = " ".join([PARAGRAPH] * 7), " ".join([PARAGRAPH] * 3)
    page = f"<body><div id=content><section><h2>One</h2><p>{first}</p></section><section><h2>Two</h2><p>{second}</p></section></div></body>"
    assert H.main_text(page) == f"One {first} Two {second}"
    page = f"<body><table><tr><td><p>{first}</p></td><td><p>{second}</p></td></tr></table></body>"
    assert H.main_text(page) == f"{first} {second}"
    page = f"<body><main><article><p>{first}</p></article><section><p>{second}</p></section></main></body>"
    assert H.main_text(page) == f"{first} {second}"


def test_marks_and_forms_around_the_article_say_nothing():
    body = f"<h1>Head</h1><p>{PARAGRAPH}</p><div class=comments><p>{PARAGRAPH}</p></div><p>{PARAGRAPH}</p>"
    want = f"Head {PARAGRAPH} {PARAGRAPH}"
    assert H.main_text(f"<body><form><input type=hidden><button>Go</button>{body}</form></body>") == want
    for name in ("page has-sidebar", "no-sidebar", "content social", "search result"):
        assert H.main_text(f"<body><div class='{name}'>{body}</div></body>") == want
        assert want in H.main_text(f"<body><p>A line outside.</p><div class='{name}'><div class=widget>{body}</div></div></body>")
        assert H.main_text(f"<body><article><div class='{name}'>{body}</div></article></body>") == want
    comments = f"<div id=comments><p>{PARAGRAPH * 9}</p></div>"
    assert H.main_text(f"<body><article><p>{PARAGRAPH}</p></article>{comments}</body>") == PARAGRAPH


LONG = " ".join([PARAGRAPH] * 5)


def test_side_parts_go_however_long_they_are():
    two = "Two sentences stand here, no more. This is the second one, and the last."
    for name in ("class=comments", "id=disqus_thread", "id=cookie-notice", "class='ad banner'", "class=newsletter-signup", "id=respond", "role=alert"):
        side = f"<div {name}><p>{LONG}</p><p>{LONG}</p></div>"
        for page in (f"<article><p>{two}</p>{side}</article>", f"<main><p>{two}</p>{side}</main>", f"<div id=content><p>{two}</p></div>{side}",
                     f"<main>{side}<article><p>{two}</p></article></main>", f"<div class=wrap>{side}<div><p>{two}</p></div></div>"):
            assert H.main_text(f"<body>{page}</body>") == two, page
    assert H.main_text(f"<body><div><p>{two}</p></div><form><p>{LONG}</p></form></body>") == two
    assert H.main_text(f"<body><div><p>{two}</p></div><div class=sidebar><p>{LONG}</p></div></body>") == two


def test_headers():
    page = f"<body><main><header>SITE NAME, and more</header><article><header><h1>Title</h1></header><p>{PARAGRAPH}</p></article></main></body>"
    assert H.main_text(page) == f"Title {PARAGRAPH}"
    assert H.main_text(f"<body><header>Site</header><main><header><h1>Title</h1></header><p>{PARAGRAPH}</p></main></body>") == f"Title {PARAGRAPH}"


def test_marks_inside_marks_still_count_on_a_page_that_marks_all():
    page = f"<body><div class='advert-frame'><div><p>{LONG}</p></div><div id=comments><p>{LONG} no</p></div></div></body>"
    assert H.main_text(page) == LONG


def test_time_is_in_proportion_to_the_page():
    import time

    n = 100_000
    deep = "<p><table>" + "<b>" * n + "</p>" * n
    for page in ("<a " * n, "<!--" * n, "<article>" * n, "<a b='" * n, '<a b="' * (n + 1), "<" * n, "</" * n, "<!" * n, "<script>" * n, deep,
                 "<div class=comments>" * n, "<li>" * n, "<p>" * n, "<form>" * n + "x", "&#" * n, "<a" + " " * n + "<" * n, "<main><header>" * n,
                 "<article><p>" * n + PARAGRAPH):
        start = time.process_time()
        assert isinstance(H.main_text(page), str)
        assert time.process_time() - start < 3, page[:20]


def test_broken_pages():
    cases = {
        "": "", None: "", "plain": "plain", "<p>x": "x", "</p></div>z": "z", "<![if x]>a<b": "a<b", "<script>var a='<p>'": "",
        "<article><p>a, b.</p><p>c &am": "a, b. c &am", "<div " * 3: "", "<p>a<p>b<p>c": "a b c", "&lt;p&gt; &unknown;": "<p> &unknown;",
    }
    for page, want in cases.items():
        if page != "<div " * 3:
            assert H.main_text(page) == want, page
    assert isinstance(H.main_text("<div " * 3), str)
    assert H.main_text("<div>" * 20_000 + "deep, text." + "</div>" * 20_000) == "deep, text."


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/!-&;=\"' apdivbrscto[]?#x\n", max_size=120))
def test_any_markup_is_read(page):
    assert isinstance(H.main_text(page), str)


def test_odd_rows(spark):
    rows = [(1, "u", None, 1), (2, None, "", 2), (None, "v", "<p>x y</p>", 3), (3, "w", "<p>a</p>", 4), (3, "w", "<p>a</p>", 4)]
    made = H.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text int"))
    assert sorted((tuple(r) for r in made.collect()), key=repr) == sorted(
        [(1, "u", "", 0), (2, None, "", 0), (None, "v", "x y", 3), (3, "w", "a", 1), (3, "w", "a", 1)], key=repr
    )
    assert H.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
