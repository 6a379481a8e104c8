"""Page extraction: structure, references, runs shared by a host."""

import numpy as np
import pytest

from tideframe.llm import html

PAGES = "page_id long, url string, html string"
CASES = [
    ("<p>a  b\n c</p><p>d</p>", "a b c d"),
    ("<article><h1>T &amp; &lt;x&gt;</h1><p>x<br>y<b>z</b>w</article><footer>no</footer>", "T & <x> x yzw"),
    ('<nav>n</nav><div class="ad">buy</div><main><p>keep</p><aside>s</aside><div id="comments"><p>c</p></div></main>', "keep"),
    ('<body><div class="content">text</div><div class="side-bar">no</div><div class="badge">yes</div></body>', "text yes"),
    ('<script>var t="</p><article>";</script><style>p{}</style><!-- <p>no</p> --><p>one', "one"),
    ('<p title="a > b">x</p><p hidden>no</p><form><p>no</p></form>', "x"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a b c d"),
    ("<article><p>one<p>two<div>three</div></article>", "one two three"),
    ("plain &copy; text < 5 &unknown; &#233;", "plain © text < 5 &unknown; é"),
    ("<p>a</p><!-- never closed <p>b</p>", "a"),
    ("<article></article><p>outside</p>", "outside"),
    ("<header><article><p>no</p></article></header><p>yes</p>", "yes"),
    ('<html class="no-js header-fixed"><body id="search"><p>kept</p></body></html>', "kept"),
    ("", ""),
    (None, ""),
    ("<p>", ""),
]


@pytest.mark.parametrize("page,text", CASES)
def test_blocks(page, text):
    blocks = html.page_blocks(page)
    article = [t for t, inside in blocks if inside]
    assert " ".join(article or [t for t, _ in blocks]) == text


def frame(spark, rows):
    return spark.createDataFrame(rows, PAGES)


def texts(found):
    return {r.page_id: r.text for r in found.collect()}


def own(i):
    return " ".join(f"word{i}x{j}" for j in range(25))


@pytest.mark.parametrize("group_pages", [3, 500])
def test_runs_of_a_host(spark, monkeypatch, group_pages):
    monkeypatch.setattr(html, "GROUP_PAGES", group_pages)
    banner = "read all the latest news from our small town every single day"
    rows = [(i, f"http://H{i % 2}.example.com/{i}", f"<div>{banner} {i % 2} host</div><p>{own(i)}</p>") for i in range(20)]
    rows.append((20, "http://other.example.com/", f"<div>{banner}</div><p>{own(20)}</p>"))
    found = texts(html.extract_pages(frame(spark, rows)))
    assert {i: found[i] for i in range(20)} == {i: own(i) for i in range(20)}
    assert found[20] == f"{banner} {own(20)}"


def test_articles_stay_when_repeated(spark):
    rows = [(i, "http://h.example.com/", f"<article><p>{own(0)}</p></article>") for i in range(4)]
    assert set(texts(html.extract_pages(frame(spark, rows))).values()) == {own(0)}


def test_defined_cases(spark):
    rows = [(1, None, f"<p>{own(1)}</p>"), (1, None, f"<p>{own(1)}</p>"), (2, "no url", None), (None, "http://x", "<p>a &amp; b</p>")]
    found = html.extract_pages(frame(spark, rows).selectExpr("*", "1 AS text", "2 AS blocks", "3 AS host", "4 AS key"))
    assert sorted(((r.page_id, r.text, r.n_chars) for r in found.collect()), key=str) == sorted(
        [(1, own(1), len(own(1)))] * 2 + [(2, "", 0), (None, "a & b", 5)], key=str
    )
    assert html.extract_pages(frame(spark, rows).limit(0)).count() == 0


def test_suffix_array_brute_force():
    rng = np.random.default_rng(5)
    streams = [rng.integers(1, 4, rng.integers(0, 40)).astype(np.uint64) for _ in range(8)]
    runs = {}
    for i, s in enumerate(streams):
        for a in range(len(s) - html.RUN + 1):
            runs.setdefault(tuple(s[a : a + html.RUN].tolist()), []).append(i)
    digest = {int(html.windows(np.array(r, dtype=np.uint64), html.RUN)[0]): (min(v), max(v)) for r, v in runs.items()}
    found = dict(zip(*[x.tolist() for x in html.shared_runs(streams)[:1]], zip(*[x.tolist() for x in html.shared_runs(streams)[1:]], strict=True), strict=True))
    assert found == digest


def test_runs_of_articles(spark):
    """The suffix array reads articles too: a notice goes, exact and near copies stay whole."""
    notice = "this text was first printed in the evening paper of our town"
    rows = [(i, "http://h.example.com/", f"<nav>menu</nav><article><p>{own(i)}</p><p>{notice}</p></article>") for i in range(4)]
    near = own(9).replace("word9x3 ", "")
    rows += [(8, "http://h.example.com/8", f"<article><p>{own(8)}</p></article>"), (9, "http://h.example.com/9", f"<article><p>{own(9)}</p></article>")]
    rows += [(10, "http://h.example.com/10", f"<article><p>{own(8)}</p></article>"), (11, "http://h.example.com/11", f"<article><p>{near}</p></article>")]
    rows += [(12, "http://other.example.com/", f"<article><p>{notice}</p></article>")]
    expected = {i: own(i) for i in range(4)} | {8: own(8), 9: own(9), 10: own(8), 11: near, 12: notice}
    assert texts(html.extract_pages(frame(spark, rows))) == expected


def by_hand(rows):
    """Text of every page by plain loops over all runs of words."""
    pages = []
    for page_id, url, page in rows:
        blocks = html.page_blocks(page)
        article = [t for t, inside in blocks if inside]
        pages.append((page_id, (url, bool(article)), tuple(article or [t for t, _ in blocks])))
    holders = {}
    for _, group, blocks in pages:
        words = " ".join(blocks).split()
        for a in range(len(words) - html.RUN + 1):
            holders.setdefault((group, tuple(words[a : a + html.RUN])), set()).add(blocks)
    found = {}
    for page_id, group, blocks in pages:
        words, covered = " ".join(blocks).split(), set()
        for a in range(len(words) - html.RUN + 1):
            if len(holders[group, tuple(words[a : a + html.RUN])]) > 1:
                covered |= set(range(a, a + html.RUN))
        kept, at, copy = [], 0, group[1] and len(covered) >= html.COVERED * len(words)
        for block in blocks:
            n = len(block.split())
            if copy or len(covered & set(range(at, at + n))) < html.COVERED * n:
                kept.append(block)
            at += n
        found[page_id] = " ".join(kept)
    return found


@pytest.mark.parametrize("group_pages", [2, 9, 500])
def test_pages_brute_force(spark, monkeypatch, group_pages):
    monkeypatch.setattr(html, "GROUP_PAGES", group_pages)
    rng = np.random.default_rng(11)
    lines = [" ".join(f"l{k}w{j}" for j in range(rng.integers(3, 14))) for k in range(12)]
    rows, blocks, host = [], [], ""
    for i in range(90):
        if i % 7 == 6:  # a copy of the page before, every other with a changed end
            blocks = [*blocks, *["changed end"] * (i % 2)]
        else:
            own_lines = [" ".join(f"p{i}b{k}w{j}" for j in range(rng.integers(1, 20))) for k in range(rng.integers(1, 5))]
            blocks = list(rng.permutation(own_lines + [lines[k] for k in rng.integers(0, 12, rng.integers(0, 4))]))
            host = f"h{i % 2}"
        tag = "article" if i % 3 else "div"
        rows.append((i, host, f"<{tag}>" + "".join(f"<p>{b}</p>" for b in blocks) + f"</{tag}>"))
    found = texts(html.extract_pages(frame(spark, [(i, f"http://{h}.example.com/{i}", p) for i, h, p in rows])))
    assert found == by_hand(rows)
    assert sum(found[r[0]] != by_hand([r])[r[0]] for r in rows) > 20
