"""op3: structure, broken markup, and the host suffix array."""

import html
import re

import numpy as np

from rillflow.llm import html_extract as H
from rillflow.llm.queries import REGISTRY
from tests.llm.fixtures import table, with_clashes

SCHEMA = "page_id long, url string, html string"


def texts(spark, rows, **how):
    df = with_clashes(spark.createDataFrame(rows, SCHEMA))
    got = H.extract(df, **how).collect()
    assert len(got) == len(rows)
    return {r["page_id"]: r["text"] for r in got}


def test_structure():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
      <header>Site</header><nav><ul><li>A<li>B</ul></nav>
      <article><header><h1>Head &amp; line</h1></header><p>One  two<br>three &eacute;&nbsp;x
      <p><b>Four <i>five</b> six<div class="ad">Buy</div><aside>Side</aside>
      <form>Name <input></form><script>var a = "</p>";</script><ul><li>seven<li>eight</ul>
      <section id="comments"><p>Nice!</p></section><div class="cookie-notice">ok?</div>
      <blockquote>a &lt; b</blockquote><footer>end</footer></article>
      <div role="contentinfo">c</div><p>outside</p><footer>F</footer></body></html>"""
    main = [t for z, t in H.blocks(page) if z == H.MAIN]
    assert main == ["Head & line", "One two three é x", "Four five six", "seven", "eight", "a < b"]
    assert (H.FREE, "outside") in H.blocks(page)
    assert H.blocks("") == H.blocks(None) == []
    assert H.blocks("plain text, a < b & c") == [(H.FREE, "plain text, a < b & c")]
    assert [t for _, t in H.blocks("<p>a</div></p><b>b</p>c<p")][:2] == ["a", "b"]
    assert len(H.blocks("<div>" * 3000 + "deep" + "</div>" * 10)) == 1
    assert H.blocks("<p>" + "long " * 200_000 + "</p>")[0][1].count("long") == 200_000
    assert H.blocks('<div class="download loads admin">kept</div>') == [(H.FREE, "kept")]


def test_query_on_pages(spark):
    from tests.conftest import SF
    got = {r["page_id"]: r for r in REGISTRY["op3_html_extract"](spark, SF).collect()}
    for r in table("pages"):
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[a-z/][^>]*>", lambda m: " " if m[0] == "<br>"
                                               else "", x)).split())
                 for x in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n\n".join(p for p in parts if p)
        g = got[r["page_id"]]
        assert (g["url"], g["text"], g["n_chars"]) == (r["url"], want, len(want))


def test_boilerplate_without_containers(spark):
    line = "subscribe to our wonderful letter and never miss a story again today"

    def page(i, host="a.org"):
        own = " ".join(f"own{i}w{k}" for k in range(20))
        return (i, f"http://{host}/{i}", f"<div><p>{line}</p><p>{own}</p><p>{line} {own} tail{i}</p>"
                                         f"<p>short{i}</p></div>")
    rows = [page(i) for i in range(6)] + [page(50, "b.org"), (60, None, None), (61, "", ""),
                                          (62, "http://c.org", "<p>alone")]
    got = texts(spark, rows)
    own = " ".join(f"own1w{k}" for k in range(20))
    assert got[1] == f"{own}\n\n{own} tail1\n\nshort1"  # what is covered goes, also of a long block
    assert got[50].startswith(line)  # one page of its host shows nothing
    assert got[60] == got[61] == "" and got[62] == "alone"
    # copies of one page count once and stay
    copies = texts(spark, [(i, "http://a.org/", page(1)[2]) for i in range(9)])
    assert set(copies.values()) == {page(1)[2].replace("<div><p>", "").replace("</p></div>", "")
                                    .replace("</p><p>", "\n\n")}
    # a large host is cut into several arrays
    many = [page(i) for i in range(200)]
    cut = texts(spark, many, task_bytes=20_000)
    assert all(line not in t.split("\n\n") for t in cut.values())
    assert texts(spark, [(9, "http://a.org", None)]) == {9: ""}
    assert H.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_small_articles_short_runs_and_nested_comments(spark):
    line = "please share this story with all of your many good friends today"
    card = "<article><p>another story</p></article>"

    def page(i, body):
        return (i, f"http://a.org/{i}", f"<div><p>{line}</p>{body}<p>{line} own{i} end{i}</p></div>")
    own = [" ".join(f"own{i}w{k}" for k in range(20)) for i in range(4)]
    rows = [page(i, f"<p>{own[i]}</p>{card}") for i in range(4)]
    rows.append(page(9, f"<article><p>{own[0]} {own[1]}</p></article><p>x</p>"))
    rows.append((20, "http://b.org", "<article><p>text</p><article class='comment'>me too"
                                     "</article><article>part</article></article>"))
    got = texts(spark, rows)
    for i in range(4):  # the body beside a teaser card, and runs below RUN tokens
        assert got[i] == f"{own[i]}\n\nanother story\n\nown{i} end{i}"
    assert got[9] == f"{own[0]} {own[1]}\n\nx\n\nown9 end9"  # unique runs beside an article stay
    assert got[20] == "text\n\npart"


def test_parts_of_a_large_host_are_joined(spark):
    rare = [" ".join(f"rare{g}x{k}" for k in range(12)) for g in range(40)]

    def page(i, copy=""):
        own = " ".join(f"own{i}w{k}" for k in range(20))
        zone = "<nav><p>{}</p></nav>" if i % 5 == 4 else "<p>{}</p>"
        return (i, f"http://a.org/{i}{copy}", f"<div><p>{own}</p>{zone.format(rare[i % 40])}</div>")
    rows = [page(i) for i in range(140)]  # the first 20 passages on 4 pages, the others on 3
    rows += [(500 + i, f"http://a.org/c{i}", "<p>" + " ".join(f"copy{k}" for k in range(12)) + "</p>")
             for i in range(30)]  # one stream
    rows += [(600 + i, f"http://a.org/t{i}", f"<p>{' '.join(f'two{k}' for k in range(12))}</p><p>t{i}</p>")
             for i in range(2)]
    rows += [(700, "http://b.org/", "<p>" + rare[0] + "</p>"), (701, None, None)]
    whole = texts(spark, rows)
    assert not any("rare" in t for i, t in whole.items() if i < 140)
    assert all("copy5" in whole[500 + i] for i in range(30)) and "two3" in whole[600]
    for task_bytes in (3_000, 1_000):
        assert texts(spark, rows, task_bytes=task_bytes) == whole


def plain_text(page, others):
    """A page's text by the docstring: windows of RUN symbols looked up in all pages' streams."""
    def symbols(p):
        return [x for _, t in p for x in [*t.split(" "), "|"]]

    def grams(seq):
        return {tuple(seq[i:i + H.RUN]) for i in range(len(seq) - H.RUN + 1)}
    pages = [grams(s) for s in {tuple(symbols(p)) for p in others}]
    seq = symbols(page)
    cover = [False] * len(seq)
    for i in range(len(seq) - H.RUN + 1):
        if sum(tuple(seq[i:i + H.RUN]) in g for g in pages) >= H.MIN_PAGES:
            cover[i:i + H.RUN] = [True] * H.RUN
    out, at = [], 0
    for zone, text in page:
        words = text.split(" ")
        if zone == H.MAIN:
            out.append(text)
        elif zone == H.FREE:
            run = []
            for k, w in enumerate([*words, None]):
                if w is None or cover[at + k]:
                    out += [" ".join(run)] if run else []
                    run = []
                else:
                    run.append(w)
        at += len(words) + 1
    return "\n\n".join(out)


def test_whole_pages_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]

    def some(n):
        return " ".join(rng.choice(words, n))
    rows, sites = [], {}
    for site in range(5):
        menu = "".join(f"<li>{some(1)}" for _ in range(7))
        foot, passage = some(30), some(60)
        for i in range(12):
            own = [some(int(rng.integers(1, 40))) for _ in range(3)]
            shared = f"<p>{passage}</p>" if i % 2 else ""
            body = (f"<article><p>{own[0]}</p>{shared}</article>" if i % 3 else
                    f"<div><p>{own[0]}</p></div>")
            rows.append((100 * site + i, f"http://h{site}.org/{i}",
                         f"<div><ul>{menu}</ul></div><div class='ad'>{some(9)}</div>{body}"
                         f"<div>{own[1]} {foot if i % 4 else ''}</div><p>{own[2]}</p>"
                         f"<nav>{some(5)}</nav><div class='comments'><p>{some(12)}</p></div>"))
            sites.setdefault(site, []).append(H.blocks(rows[-1][2]))
    want = {100 * s + i: plain_text(p, pages) for s, pages in sites.items()
            for i, p in enumerate(pages)}
    got = texts(spark, rows)
    assert got == want
    zones = [z for pages in sites.values() for p in pages for z, _ in p]
    assert set(zones) == {H.MAIN, H.FREE, H.BOILER, H.TOLD}
    # the menus, lists of single words without any name, go by the covering
    assert sum(len(t.split("\n\n")) for t in got.values()) \
        == zones.count(H.FREE) - 5 * 12 * 7 + zones.count(H.MAIN)
    assert texts(spark, rows, task_bytes=2_000) == want


def test_covered_equals_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(5):
        runs = [rng.integers(1, 4, size=12) for _ in range(3)]
        token, host, page = [], [], []
        for p in range(9):
            for _ in range(3):
                part = np.concatenate([rng.integers(1, 4, size=6), runs[rng.integers(3)]])
                token += [*part, 0]
                host += [p % 2] * (len(part) + 1)
                page += [p] * (len(part) + 1)
        token, host, page = np.array(token, np.uint64), np.array(host), np.array(page)
        where = {}
        starts = [i for i in range(len(token) - H.RUN + 1) if (token[i:i + H.RUN] != 0).all()]
        for i in starts:
            where.setdefault((host[i], *token[i:i + H.RUN]), set()).add(page[i])
        want = np.zeros(len(token), bool)
        for i in starts:
            if len(where[(host[i], *token[i:i + H.RUN])]) >= H.MIN_PAGES:
                want[i:i + H.RUN] = True
        assert (H.covered(token, host, page) == want).all() and want.any() and not want.all()
