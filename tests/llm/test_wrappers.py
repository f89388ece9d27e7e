from __future__ import annotations

import json
import random

from keepwise.llm import wrappers
from keepwise.llm.wrappers import CHILDREN, DIGEST, LABEL, OPTIONAL, REPEATED

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{x:1}}</style></head><body>
<div class="cookie-notice">We use cookies</div><nav><ul><li><a href="/">Home</a></li><li><a href="/b">B</a></li></ul></nav>
<div id="content">{body}</div><div class="comments"><p>Reader: {comment} nonsense that goes on and on and on</p></div>
<aside>More</aside><form><input name=q>Search</form><footer>&copy; host</footer><script>var a="<p>no</p>";</script></body></html>"""


def shape(item):
    mark = ("+" if item[REPEATED] else "") + ("?" if item[OPTIONAL] else "")
    if item[CHILDREN] is None:
        return "#" + mark + ("=" if item[DIGEST] else "")
    return item[LABEL] + mark + "(" + " ".join(map(shape, item[CHILDREN])) + ")"


def infer(*pages):
    made = None
    for p in pages:
        own = wrappers.wrapper_of(wrappers.parse(p))
        made = own if made is None else wrappers.merge(made, own)
    return made


def test_mismatches_become_slots_repeats_and_options():
    w = infer("<div><h1>A</h1><p>x</p><p>y</p></div>", "<div><h1>B</h1><p>z</p><hr><table><tr><td>1</table></div>",
              "<div><h1>C</h1><em>same</em></div>")
    assert shape(w) == "page(div(h1(#) p+?(#) table?(tr(td(#=))) #?=))"
    pairs = infer("<dl><dt>a<dd>1<dt>b<dd>2<dt>c<dd>3</dl>")
    assert shape(pairs) == "page(dl(dt+(#) dd+(#)))"


def test_alignment_is_independent_of_salting(spark):
    pages = [f"<body><div class=c{i % 3}>" + "<p>text %d</p>" % i * (1 + i % 4) + "</div></body>" for i in range(30)]
    df = spark.createDataFrame([("h", p) for p in pages], "host string, html string").repartition(6)
    (row,) = wrappers.infer_wrappers(df).collect()
    assert "div.c.0" in row.wrapper and json.loads(row.wrapper)[LABEL] == "page"


def test_main_text_of_one_host(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for i in range(60):
        paragraphs = [" ".join(rng.choice("house river stone light".split()) for _ in range(rng.randint(5, 60)))
                      for _ in range(rng.randint(1, 5))]
        body = f"<h2>Title {i}</h2>" + "".join(f"<p>{p} &amp; <b>b</b>o\n ld&nbsp;</p>" for p in paragraphs)
        rows.append((i, f"http://user@Host.example:80/{i}", PAGE.format(body=body, comment=i)))
        want[i] = f"Title {i} " + " ".join(f"{p} & bo ld" for p in paragraphs)
    got = wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_odd_pages(spark):
    odd = [None, "", "plain text only", "<", "<p", "<!-- never closed", "<script>never closed <p>x", "<p>a<p>b<br>c</i></div>d",
           "<div><article>" * 3000 + "deep", "<a href='x>unclosed", "<div>" + "x" * 200_000 + "</div>", "a &lt;b&gt; &#65;&unknown; \x00"]
    rows = [(i, None if i % 3 == 0 else "not a url" if i % 3 == 1 else "http://h/", h, "extra") for i, h in enumerate(odd)]
    rows += [(7, "http://h/", odd[7], "extra")] * 2 + [(None, "http://h/", "<p>q</p>", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = wrappers.extract(df).collect()
    assert len(got) == len(rows)
    texts = {r.page_id: r.text for r in got}
    assert texts[0] == texts[1] == "" and texts[2] == "plain text only"
    assert texts[7] == "a b cd" and texts[11].startswith("a <b> A") and len(texts[10]) == 200_000
    assert texts[8] == "deep"
    assert wrappers.extract(df.where("false")).collect() == []


def test_boilerplate_labels():
    assert all(map(wrappers.boilerplate, ["nav", "div.ad", "div.site.header", "section.user.comments", "p.cookie.notice", "script"]))
    assert not any(map(wrappers.boilerplate, ["div.adventure", "article", "div.content", "p", "div.shareholders"]))


def read(*pages):
    """Texts of the pages of one host."""
    place = wrappers.main_place(infer(*pages))
    return [wrappers.main_text(p, place) for p in pages]


def test_one_page_shows_no_slots():
    page = "<article><p>one long paragraph</p></article><ul><li>a</li><li>b</li></ul>"
    for texts in (read(page), read(page, page), [wrappers.main_text(page, ([["page", "elsewhere"]], []))]):
        assert all("one long paragraph" in t for t in texts)
    copies = "<div><p>template</p></div><ul><li>a</li><li>b</li></ul>"
    assert all("template" in t for t in read(copies, copies, copies))
    # two different pages do show them, and in one page only is no template
    first, second = read("<div><p>alike here</p></div><p>own text</p>", "<div><p>alike here</p></div><p>other text</p>")
    assert "own text" in first and "other text" in second


def test_no_part_of_the_main_text_is_cut():
    page = ("<body><div id=content><h1>Title {0}</h1><p class=lede>Lede {0}.</p><div class=body>" + "<p>long {0} text</p>" * 40
            + "</div></div><footer>f</footer></body>")
    assert [t[:15] for t in read(page.format(1), page.format(2))] == ["Title 1 Lede 1.", "Title 2 Lede 2."]
    halves = "<body><article class=a><p>left {0}</p></article><hr><article class=b><p>right {0} and more</p></article><p>(c)</p></body>"
    assert read(halves.format(1), halves.format(2)) == [f"left {i} right {i} and more" for i in (1, 2)]
    linked = "<body><div><h1><a href=x>Title {0}</a></h1><div class=body><p>text {0}</p></div></div></body>"
    assert read(linked.format(1), linked.format(2)) == ["Title 1 text 1", "Title 2 text 2"]


def test_containers_that_mention_boilerplate_keep_the_article():
    text = "<h1>Title {0}</h1>" + "<p>long {0} text of the article</p>" * 9
    rest = "<div class=sidebar><p>Latest news</p></div><div class=comments><p>reply {0}</p></div><footer>(c)</footer>"
    frames = ["<body class=has-sidebar>{}</body>", "<body><div class='content with-sidebar'>{}</div></body>",
              "<body><article class='post comments-open'>{}</article></body>", "<body><div class=widget-content>{}</div></body>",
              "<body><form id=aspnetForm><div class=page-header-wrap>{}</div></form></body>",
              "<body><div class='widget a'><p>first {{0}} part</p></div><div class='widget b'>{}</div></body>"]
    for frame in frames:
        page = frame.format(text + rest)
        for texts in (read(page.format(1), page.format(2)), [read(page.format(1))[0]]):
            for i, t in enumerate(texts, 1):
                assert f"Title {i}" in t and t.count(f"long {i} text of the article") == 9, (frame, t)
                assert "reply" not in t and "(c)" not in t and "Latest" not in t, (frame, t)
    advert = "<body><div class=body><p>all pages share this text</p></div><div class=ad>buy {0}</div></body>"
    assert read(advert.format(1), advert.format(2)) == ["all pages share this text"] * 2
