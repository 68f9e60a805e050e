import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfare.llm import html_text, mtree, warc

VECS = "vec_id long, embedding array<float>, label int, v string, tree long, rank int"


def brute(rows, asks, k):
    whole = {}
    for i, x in rows:
        if i is not None and x and all(c is not None and np.isfinite(c) for c in x):
            v = np.floor(1024 * np.array(x, np.float32).astype(float)).astype(int).tolist()
            whole[i] = min(whole.get(i, v), v)
    return {(q, r + 1, i, -s) for q, a in whole.items() if asks(q) for r, (s, i) in enumerate(sorted(
        (-int(np.dot(a, b)), i) for i, b in whole.items() if i != q and len(a) == len(b))[:k])}


@pytest.mark.parametrize(("seed", "width", "spread"), [(1, 8, 1.0), (2, 3, 0.01), (3, 64, 0.2)])
def test_top_k_by_brute_force(spark, seed, width, spread):
    draw = random.Random(seed)
    middles = [[draw.uniform(-1, 1) for _ in range(width)] for _ in range(5)]
    rows = [(i, [c + draw.gauss(0, spread) for c in draw.choice(middles)]) for i in range(700)]
    rows += [(800 + i, rows[0][1]) for i in range(300)] + [(5, rows[9][1]), (None, rows[0][1]), (2000, None), (2001, []),
             (2010, [float("nan")] * width), (2020, [None] * width), (2030, [float("inf")] * width), (2040, [0.5] * (width + 1)),
             (2050, [0.5] * (width + 1))]
    frame = spark.createDataFrame([(i, x, 0, "v", 1, 2) for i, x in rows], VECS)
    got = {tuple(r) for r in mtree.top_k(frame, F.col("vec_id") % 10 == 0, k=10).collect()}
    assert got == brute(rows, lambda q: q % 10 == 0, 10)


def test_stored_bounds_save_distances():
    draw = np.random.default_rng(4)
    vectors = (draw.normal(0, 1, (40, 6))[draw.integers(0, 40, 6000)] * 1000 + draw.normal(0, 5, (6000, 6))).astype(int)
    tree, seen = mtree.Tree(np.arange(6000), vectors), []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            seen.append(np.size(at))
            return np.asarray(super().__getitem__(at))

    tree.vectors = tree.vectors.view(Counted)
    best = tree.search(vectors[7], 7, 5)
    scores = vectors @ vectors[7]
    assert best == [(int(scores[i]), int(i)) for i in np.lexsort((np.arange(6000), -scores)) if i != 7][:5]
    assert sum(seen) < 3000


def test_a_block_of_queries_opens_a_page_once():
    """Queries search together: fewer looks at rows than pages times queries; ties, own ids and large numbers hold."""
    draw = np.random.default_rng(5)
    for scale, count in ((3, 1500), (1 << 28, 300), (3, 4)):
        vectors, ids = draw.integers(-scale, scale, (count, 6)), draw.permutation(count)
        tree, seen = mtree.Tree(ids, vectors), []

        class Counted(np.ndarray):
            def __getitem__(self, at):
                seen.append(np.size(at))  # noqa: B023
                return np.asarray(super().__getitem__(at))

        tree.vectors = tree.vectors.view(Counted)
        got = list(zip(*(x.tolist() for x in tree.search_all(vectors[:200], ids[:200], 10)), strict=True))
        scores = vectors @ vectors[:200].T
        want = [(q, int(ids[i]), int(scores[i, q])) for q in range(min(200, count))
                for i in [i for i in np.lexsort((ids, -scores[:, q])) if i != q][:10]]
        assert got == want
        assert len(seen) <= len(tree.pages)


def test_top_k_of_nothing(spark):
    assert mtree.top_k(spark.createDataFrame([], VECS), F.col("vec_id") % 10 == 0).count() == 0


def common(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
    return table[-1, -1]


def test_shared_lines_are_a_longest_common_subsequence():
    draw = np.random.default_rng(1)
    for _ in range(300):
        a, b = draw.integers(0, 5, draw.integers(0, 14)), draw.integers(0, 5, draw.integers(0, 14))
        marked = a[html_text.shared(a, b)].tolist()
        rest = iter(b.tolist())
        assert all(x in rest for x in marked) and len(marked) == common(a, b)


PAGE = ("<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body><header>Site</header><nav>menu</nav>"
        "<main><article><h1>T &amp; x</h1><p><b>One<br>two  three<p>Four</p><script>var t='</p>';</script>"
        "<div class='share-box'>s</div><form>f</form><footer>by</footer></article><section id='comments'><p>c</p></section>"
        "</main><aside>a</aside><div role=alert>n</div><div>outside</div><footer>&copy;</footer>")


def test_article():
    assert html_text.lines(PAGE) == [("T & x", True), ("One two three", True), ("Four", True)]
    assert html_text.lines("<p>a</p>b &#233;<br>c<div class='ad top'>z</div><ul><li>d<li>e</ul>") == [
        ("a", False), ("b é c", False), ("d", False), ("e", False)]
    assert html_text.lines("<div id=menu>m") == html_text.lines("") == html_text.lines(None) == []


def text_of(html):
    return [line for line, _ in html_text.lines(html)]


def test_names_of_sections_and_wrappers():
    assert text_of("<article><h2 id='related-work'>Related</h2><section id='search-methods'>Search</section><p id='social-effects'>S"
                   "<section id='comments'>Our comments</section><p class='notice'>N</p></article>") == [
        "Related", "Search", "S", "Our comments", "N"]
    for wrapper in ("div class='layout has-sidebar'", "div class='layout sidebar'", "form", "form><div class='content nav'"):
        assert text_of(f"<body><{wrapper}><nav>m</nav><article><p>The text</p></article>") == ["The text"]
    assert text_of("<div class='sidebar'><main><p>The text</p></main></div>") == ["The text"]
    assert text_of("<body><form><p>All of the page</p><nav>m</nav></form>") == ["All of the page"]
    assert text_of("<p>The text of it</p><form>Find</form><div class='sidebar'><article>Teaser</article></div>") == ["The text of it"]


def test_end_tags_left_out():
    for head in ("<head><title>x</title>", "<head><title>x</title><noscript><img src=a></noscript>", "<head><meta charset=a><noscript>"):
        assert text_of(f"<html>{head}<body><p>Text</p>") == ["Text"]
    for start in ("<p>", "<div>", "<article>", "", "<img src=a>"):
        assert text_of(f"<head><title>x</title><style>p{{}}</style>\n{start}Text") == ["Text"]
    for shape in ("<svg width=1 />", "<math/>", "<svg><path/></svg>", "<svg><g><svg/>n</g></svg>"):
        assert text_of(f"<body><div>{shape}<p>Text</p></div>") == ["Text"]


def test_marked_articles_and_containers_go():
    assert text_of("<article><p>Text</p><article class='comment'>c</article><article class='card related'>r</article>"
                   "<article class=part>Part</article></article>") == ["Text", "Part"]
    assert text_of("<article><p>Text</p></article><article class='comment'>c</article>") == ["Text"]
    assert text_of("<article class='comment'><p>An opinion</p></article><footer>f</footer>") == ["An opinion"]
    assert text_of("<div class='comments'><article>c</article></div><p>t</p>") == ["t"]
    for name in ("related-posts", "cookie_banner", "Site-Nav", "comment-list", "x advert"):
        assert text_of(f"<article>Text<div class='{name}'>n</div></article>") == ["Text"]


def test_template_goes_and_content_stays(spark):
    def page(body):
        return f"<body><div>Site name</div><p>{body}</p><p>All about us</p></body>"

    rows = [(1, "http://h.org/a/1", page("first")), (2, "http://h.org/a/2", page("second")),
            (3, "http://h.org/b/3", page("third")), (4, "http://other.org/x", page("alone")), (5, None, page("no url")),
            (6, "http://h.org/a/1", None), (7, "http://h.org/a/9", ""), (8, "http://h.org/a/2", PAGE), (None, "http://h.org/a/1", page("x"))]
    out = html_text.main_text(spark.createDataFrame(
        [(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, place int"))
    got = {r.page_id: r.text for r in out.collect()}
    assert out.count() == len(rows)
    whole = "Site name\n\n{}\n\nAll about us"
    assert got[3] in ("third", whole.format("third")) and got[1] in ("first", whole.format("first"))
    assert got[4] == whole.format("alone") and got[5] == whole.format("no url") and got[None] == whole.format("x")
    assert got[6] == got[7] == "" and got[8] == "T & x\n\nOne two three\n\nFour"
    pair = spark.createDataFrame(rows[:3], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_text.main_text(pair).collect()} == {1: "first", 2: "second", 3: "third"}
    assert html_text.main_text(pair.limit(0)).count() == 0


def texts_of(spark, rows):
    out = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(out) == len(rows)
    return {r.page_id: r.text for r in out}


def test_copies_keep_their_text(spark):
    def page(*body):
        return "<body><div>Site name</div>" + "".join(f"<p>{b}</p>" for b in body) + "<p>All about us</p></body>"

    story = [f"A line of the story, number {i}." for i in range(20)]
    rows = [(i, f"http://h.org/a/{i:02}", page(*story)) for i in range(9)]  # equal, then nearly equal
    rows += [(i, f"http://h.org/a/{i:02}", page(*story, f"Seen {i} times")) for i in range(10, 19)]
    rows += [(30, "http://h.org/b", page("Other words")), (31, "http://h.org/b", page("Other words"))]
    rows += [(40, "http://i.org/1", page(*story)), (41, "http://i.org/1", page(*story))]  # a host of copies alone
    got = texts_of(spark, rows)
    whole = "\n\n".join(story)
    assert all(got[i] == whole for i in range(9)) and all(got[i] == f"{whole}\n\nSeen {i} times" for i in range(10, 19))
    assert got[30] == got[31] == "Other words"
    assert got[40] == got[41] == f"Site name\n\n{whole}\n\nAll about us"


def test_template_inside_articles_goes(spark):
    def page(*body):
        return "<body><nav>menu</nav><article><p>By our staff</p>" + "".join(f"<p>{b}</p>" for b in body) + "<p>Tell a friend</p></article>"

    story = [f"A line of the story, number {i}." for i in range(20)]
    got = texts_of(spark, [(1, "http://h.org/1", page("first words")), (2, "http://h.org/2", page(*story)),
                           (3, "http://h.org/3", page(*story)), (4, "http://i.org/1", page("alone"))])
    assert got == {1: "first words", 2: "\n\n".join(story), 3: "\n\n".join(story), 4: "By our staff\n\nalone\n\nTell a friend"}


def test_mates_beyond_the_next_run(spark):
    # The page after c is an excerpt of c, and so is the one before: the mates are one run further.
    a, d = "<p>Site</p><p>first words</p><p>x</p>", "<p>Site</p><p>last words</p><p>y</p>"
    long = [f"<p>{w} in the middle of it all</p>" for w in ("one", "two", "three", "four")]
    rows = [(1, "http://h.org/a", a), (2, "http://h.org/b", "<p>Site</p>" + "".join(long[:2])),
            (3, "http://h.org/c", "<p>Site</p>" + "".join(long)), (4, "http://h.org/d", "<p>Site</p>" + "".join(long[2:])),
            (5, "http://h.org/e", d)]
    got = texts_of(spark, rows)
    assert all("Site" not in text for text in got.values())
    assert got[3].count("middle") == 4 and got[2].count("middle") == got[4].count("middle") == 2


def test_lines_are_deleted_by_place(spark):
    rows = [(1, "http://h.org/a", "<p>Home</p><p>One story</p><p>More</p><p>Its end</p>"),
            (2, "http://h.org/b", "<p>More</p><p>Home</p><p>Other things</p><p>to tell</p>")]
    got = texts_of(spark, rows)
    # Only one of the two crossing lines is on the common subsequence.
    assert sum(w in got[1].split("\n\n") for w in ("Home", "More")) == 1
    twice = [(1, "http://h.org/a", "<p>Home</p><p>One story</p><p>Home</p>"), (2, "http://h.org/b", "<p>Home</p><p>Other things</p>")]
    assert texts_of(spark, twice)[1].split("\n\n").count("Home") == 1


def test_archive(spark, tmp_path):
    long = "é" * 600
    rows = [(1, "http://www.a.org/x?y=1#z", long), (2, "http://a.org:80/", long), (9, "https://b.a.org", long), (3, None, None),
            (4, "http://a.org/\n b", "short\r\n\r\nWARC/1.1"), (5, "http://a.org/c", "short\r\n\r\nWARC/1.1"),
            (6, "x", ""), (None, "y", long), (6, "x", "")]
    pages = spark.createDataFrame([(*r, "k", 3) for r in rows], "page_id long, url string, html string, key string, at int")
    archive = warc.write(pages)
    got = warc.read(warc.look_up(archive, pages)).collect()
    assert sorted(r.page_id for r in got) == [1, 2, 3, 4, 5, 6, 6, 9]
    by = {r.page_id: r for r in got}
    assert [(by[i].record_type, by[i].refers_to) for i in (1, 2, 9, 4, 5, 3)] == [
        ("revisit", 9), ("revisit", 9), ("response", None), ("response", None), ("response", None), ("response", None)]
    assert by[9].payload == long.encode() and by[1].payload_bytes == 1200 and by[1].payload_digest == by[9].payload_digest
    one = spark.createDataFrame([(9, "https://b.a.org"), (77, "https://b.a.org")], "page_id long, url string")
    assert [r.page_id for r in warc.read(warc.look_up(archive, one)).collect()] == [9]
    empty = pages.limit(0)
    assert warc.read(warc.look_up(warc.write(empty), empty)).count() == 0


def test_url_keys():
    assert warc.url_key("http://User@WWW.A.org:8080/p/q?r#f") == "org,a,www:8080)/p/q?r"
    assert warc.url_key("") == ")/" and warc.url_key("https://a.org") == "org,a)/"


def test_marks_on_any_element_and_hidden_ones():
    page = ("<article><p>a</p><p class='ad'>b</p><ul class='commentlist'><li>d</li></ul><div class='user-comments'>e</div>"
            "<p style='color:red; display: none'>f</p><p aria-hidden='true'>g</p><p class='ad-hoc'>h</p><p style='display:block'>i</p></article>")
    assert [line for line, _ in html_text.lines(page)] == ["a", "h", "i"]


def test_open_elements_cost_no_more_when_there_are_many():
    assert [line for line, _ in html_text.lines("<div>" * 60_000 + "text" + "</p></b>" * 60_000)] == ["text"]
