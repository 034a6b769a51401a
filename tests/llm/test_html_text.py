from __future__ import annotations

import html
import random
import re
import resource
import time

import pytest

from formweave.llm.html_text import Page, content_paths, extract_pages, furniture_name, main_text, path_ratios

MEDIUM = "/root/testdata/sf0.01"
PROSE = "This is a sentence of the article, with some length; it goes on for a while. " * 3


def by_template(page):
    """The article of the given tables' one template, cut out plainly."""
    body = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
    blocks = re.split(r"<h1>|</h1>|<p>|</p>", body)
    lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br>" in b else "", b)).split()) for b in blocks]
    return "\n".join(x for x in lines if x)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{MEDIUM}/pages.parquet")
    want = {r.page_id: by_template(r.html) for r in pages.collect()}
    got = extract_pages(pages).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


@pytest.mark.parametrize("page, want", [
    ("", ""),
    ("plain words", "plain words"),
    ("<html><body><nav>a b c</nav><footer>x</footer></body></html>", ""),
    (f"<body><header>Site</header><main><h2>T &lt;1&gt;</h2><p>{PROSE}</p><ul><li>one<li>two</ul></main>"
     f"<aside>{PROSE}</aside><section id=comments><p>{PROSE}</p></section></body>", f"T <1>\n{PROSE.strip()}\none\ntwo"),
    (f"<div class='page'><div class=menu><a>Home</a></div><div class='post-body'><p>{PROSE}<p><b>{PROSE}</b></div>"
     f"<div class='cookie-notice'>{PROSE}</div><form><p>Name</p></form></div>", f"{PROSE.strip()}\n{PROSE.strip()}"),
    (f"<article><p>{PROSE}<script>if (a < b) '</p>';</script><style>p{{}}</style><!-- <p>no</p> --></p>"
     "<p>a&nbsp;b\n\t c &amp;amp; d<br>e</p></article><!-- open", f"{PROSE.strip()}\na b c &amp; d e"),
    (f"<article><h1>Title</h1><p>{PROSE}</p><div class='ad'>Buy</div><p>end</p><p hidden>x</p></article><p", f"Title\n{PROSE.strip()}\nend"),
    (f"<p title='a > b'>{PROSE}</p>", PROSE.strip()),
    (f"<main><article><p>{PROSE}</p></article><article><h2>Two</h2><p>{PROSE}x</p></article></main>",
     f"{PROSE.strip()}\nTwo\n{PROSE}x"),
    (f"<div><p class=lead>{PROSE}lead</p><div class=body><p>{PROSE}</p><h2>Sub</h2><p>{PROSE * 20}</p></div></div>",
     f"{PROSE}lead\n{PROSE.strip()}\nSub\n{(PROSE * 20).strip()}"),
    (f"<article><p>{PROSE}</p><div class='share-price'>12.5</div><p class='comment-on-law'>Law.</p>"
     f"<div class='share-buttons'>Tweet</div><div id='comments-list'><p>{PROSE}</p></div></article>",
     f"{PROSE.strip()}\n12.5\nLaw."),
    (f"<header><h1>Site</h1></header><article><header><h1>Title</h1><p>By me</p><nav><h2>Go</h2></nav></header><p>{PROSE}</p></article>",
     f"Title\n{PROSE.strip()}"),
    (f"<main><p>{PROSE}</p><article><p>{PROSE}</p></article><aside><article><p>{PROSE}</p></article></aside></main>",
     f"{PROSE.strip()}\n{PROSE.strip()}"),
])
def test_furniture_and_broken_markup(page, want):
    assert main_text(page) == want


def test_odd_rows(spark):
    rows = [(1, "u", None, 1, "t"), (None, None, f"<p>{PROSE}</p>", 2, "t"), (2, "u", "<div>" * 3000 + PROSE, 3, "t"),
            (2, "u", "<" * 20_000, 4, "t"), (3, "v", f"<p>{PROSE * 5000}</p>", 5, "t"), (4, "w", "<a b='" * 2000, 6, "t")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars int, text string")
    got = extract_pages(df).collect()
    assert len(got) == len(rows)
    texts = {(r.page_id, r.n_chars) for r in got}
    assert {(1, 0), (None, len(PROSE.strip())), (2, len(PROSE.strip())), (3, len((PROSE * 5000).strip()))} <= texts
    assert extract_pages(df.limit(0)).collect() == []


def test_paths_and_ratios_equal_a_plain_walk():
    """Random well-formed trees: text and punctuation by full path strings."""
    rnd = random.Random(3)
    for _ in range(60):
        out, sums, order = [], {}, []

        def grow(path, depth):
            own = None
            for _ in range(rnd.randint(1, 4)):
                if depth < 5 and rnd.random() < 0.6:
                    tag, cls = rnd.choice(["div", "section", "span", "b", "ul"]), rnd.choice(["", "x", "y"])
                    out.append(f"<{tag} class='{cls}'>" if cls else f"<{tag}>")
                    grow(f"{path}/{tag}.{cls}" if cls else f"{path}/{tag}", depth + 1)
                    out.append(f"</{tag}>")
                else:
                    text = "".join(rnd.choice("ab ,.") for _ in range(rnd.randint(1, 30)))
                    out.append(text + "<!-- -->")
                    if text.strip():
                        if path not in sums:
                            sums[path] = [0, 0, 0]
                            order.append(path)
                        sums[path][0] += len(text)
                        sums[path][1] += sum(c in ",." for c in text)
                        sums[path][2] += own is None
                        own = True
        grow("", 0)
        page = Page("".join(out))
        paths, fused = path_ratios(page.nodes)
        assert ["/" + page.path(x) if x else "" for x in paths] == order
        ratios = [[sums[x][i] / sums[x][2] for x in order] for i in (0, 1)]
        smooth = [[(r[max(i - 1, 0)] + 2 * r[i] + r[min(i + 1, len(r) - 1)]) / 4 for i in range(len(r))] for r in ratios]
        want = [a * (1 + b) for a, b in zip(*smooth)]
        assert all(abs(a - b) < 1e-9 for a, b in zip(fused, want))
        mean = sum(want) / max(1, len(want))
        spread = (sum((x - mean) ** 2 for x in want) / max(1, len(want))) ** 0.5
        clear = {x for x, v in zip(paths, want) if v >= spread + 1e-9}
        assert not clear or clear <= content_paths(page.nodes)


def test_class_names():
    assert all(map(furniture_name, ["ad", "cookie-notice", "post-comments", "sidebar_left", "share-buttons", "comments"]))
    assert not any(map(furniture_name, ["share-price", "comment-on-law", "body", "post", "header-image-story", "adress", ""]))


@pytest.mark.parametrize("page, n", [
    ("<div>" * 200_000 + PROSE, len(PROSE.strip())), ("<div>x" * 100_000, None), ("<p><b>" * 100_000 + "a", None),
    ("<i>" * 50_000 + "<li>a" * 50_000, None), ("<div>" * 100_000 + "</p></li>" * 100_000 + PROSE, len(PROSE.strip()))])
def test_deep_pages_take_time_and_memory_in_proportion(page, n):
    start, before = time.time(), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    text = main_text(page)
    assert time.time() - start < 30 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400_000
    assert n is None or len(text) == n
