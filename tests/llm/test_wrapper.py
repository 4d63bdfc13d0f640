from __future__ import annotations

import time

from wattloom.llm import wrapper

SCHEMA = "page_id long, url string, html string, text string, host string, id long, part string"


def page(i, body, tail="</body></html>"):
    return (
        f"<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style><script>var a='<p>{i}</p>';"
        f"</script></head><body><nav><ul><li><a href='/{i}'>Menu {i}</a></li></ul></nav>"
        f"<div class='ad'>Buy {i}!</div><p>Welcome to our site</p><article>{body}</article>"
        f"<div id=comments><p>Reader {i}: nice</p></div><footer>&copy; {i}</footer>{tail}"
    )


BODIES = [
    ("<h1>Title 1</h1><p>First &amp; &#233;, <b>bold</b> text<br>next</p><p>Two\n  lines</p>",
     "Title 1\n\nFirst & é, bold text next\n\nTwo lines"),
    ("<h1>Title 2</h1><p>Only one.", "Title 2\n\nOnly one."),
    ("<h1>Title 3</h1><p><b>Open<br><p>Next <i>x</i>y<!-- no --> z</p><ul><li>a<li>b</ul>",
     "Title 3\n\nOpen\n\nNext xy z\n\na\n\nb"),
    ("<h1>Title 4</h1><div><p>Deep 4</p><form><p>Your name</p><input></form></div>", "Title 4\n\nDeep 4"),
    ("<h1>Title 5</h1><table><tr><td>c1<td>c2</table><p>A < B & C</p>", "Title 5\n\nc1\n\nc2\n\nA < B & C"),
    ("", ""),
]


def test_constant_text_is_template_and_varying_text_is_content():
    found = wrapper.extract_group([page(i, body) for i, (body, _) in enumerate(BODIES)])
    assert found == [expected for _, expected in BODIES]


def test_equal_pages_are_no_evidence():
    same = page(1, "<h1>Title</h1><p>Story</p>")
    assert wrapper.extract_group([same] * 20) == ["Welcome to our site\n\nTitle\n\nStory"] * 20


def test_copied_articles_are_no_template():
    """Copies of an article under differing menus, adverts and comments: 12 of 20 pages, 3 of 4 pages."""
    story = "<h1>Title</h1><p>Copied story</p>"
    copies = [page(i, story) + f"<!-- ad {i} -->" for i in range(12)]
    others = [page(50 + i, f"<h1>Other {i}</h1><p>Story {i}</p>") for i in range(8)]
    found = wrapper.extract_group(copies + others)
    assert found == ["Title\n\nCopied story"] * 12 + [f"Other {i}\n\nStory {i}" for i in range(8)]
    # Two different texts are too few to know a template by.
    for text in wrapper.extract_group(copies[:3] + others[:1])[:3]:
        assert text == "Welcome to our site\n\nTitle\n\nCopied story"


def test_simple_tree_matching():
    a = wrapper.parse("<div><p>1</p><ul><li>x</li></ul><p>2</p></div>")
    b = wrapper.parse("<div><ul><li>y</li><li>z</li></ul><p>3</p><p>4</p></div>")
    # root, div, ul, li with its text, and one p with its text
    assert wrapper.Matcher().size(a, b) == 7
    assert wrapper.Matcher().pairs(a.children[0].children, b.children[0].children) == [(1, 0), (2, 2)]


def test_strange_markup():
    deep = "<b>" * 5000 + "x" + "<div>" * 3000 + "y"
    pages = ["", "plain & simple", "<", "<p", "</p>text", deep, "<!-- open", "<script>open", "a\x00b&#0;c", "<p>" * 300]
    found = wrapper.extract_group(pages)
    assert found[:2] == ["", "plain & simple"]
    assert found[4] == "text" and found[5] == "x\n\ny" and found[6:8] == ["", ""]


def test_names_and_lists_inside_the_article():
    body = (
        "<h1>Study {0}</h1><h2 id='related-work'>Related work</h2><p class='notice-period'>Notice of {0} days</p>"
        "<p>You <span class='share'>share {0}</span> it</p><h2>Summary</h2><p>Sum {0}</p>"
        "<ul><li><a href='/r{0}'>Reference {0}</a></li></ul><div class='ad'>Buy {0}</div>"
        "<h3>Newsletter</h3><p>Sign up today</p><h3>Advert</h3><div class='promo'>Cheap {0}</div>"
        "<div class='share-price'>Price {0}</div>"
    )
    pages = [page(i, body.format(i)) for i in range(8)]
    pages = [p.replace("<article>", "<div class='site-header'>Top</div><ul><li><a>x</a></ul><article>") for p in pages]
    assert wrapper.extract_group(pages) == [
        f"Study {i}\n\nRelated work\n\nNotice of {i} days\n\nYou share {i} it\n\nSummary\n\nSum {i}\n\n"
        f"Reference {i}\n\nPrice {i}"
        for i in range(8)
    ]


def test_open_tags_take_linear_time():
    for piece in ("<a ", "<a b=", "<a <!-- ", "</p "):
        started = time.process_time()
        wrapper.parse(piece * 300_000)
        wrapper.parse(piece * 300_000 + '"')
        wrapper.parse("<p>x</p>" + piece * 300_000 + "' >")
        assert time.process_time() - started < 20
    found = wrapper.parse("<p title='a>b'>x</p><a <b>y</b")
    assert [c.tag for c in found.children] == ["p", "a"]


def test_all_rows_come_back(spark):
    rows = [(i, f"http://h{i % 2}.org/{i}", page(i, f"<p>Story {i}</p>")) for i in range(60)]
    rows += [(100, None, None), (101, "", ""), (102, "http://single.org/", page(102, "<p>Alone</p>")), (3, *rows[3][1:])]
    rows += [(None, "http://h0.org/", page(200, "<p>No id</p>")), (103, "mailto:x", "<p>" + "long " * 100_000)]
    docs = spark.createDataFrame([(*r, "t", "h", 1, "p") for r in rows], SCHEMA).repartition(4)
    found = wrapper.extract(docs).collect()
    assert len(found) == len(rows)
    texts = {r.page_id: r.text for r in found}
    assert all(texts[i] == f"Story {i}" for i in range(60))
    assert texts[100] == texts[101] == "" and texts[102] == "Welcome to our site\n\nAlone"
    assert texts[None] == "No id"
    assert len(texts[103]) == 499_999
    assert all(r.n_chars == len(r.text) for r in found)


def test_hot_hosts_are_dealt_to_parts(spark, monkeypatch):
    monkeypatch.setattr(wrapper, "HOT_PAGES", 100)
    rows = [(i, "http://h.org/", page(i, f"<p>Story {i}</p>")) for i in range(500)]
    docs = spark.createDataFrame([(*r, "t", "h", 1, "p") for r in rows], SCHEMA)
    assert all(r.text == f"Story {r.page_id}" for r in wrapper.extract(docs).collect())


def test_empty_table(spark):
    assert wrapper.extract(spark.createDataFrame([], SCHEMA)).collect() == []
