"""Main text of web pages.

One pass cuts a page into blocks of text (menus, forms, scripts and other parts marked as such left out) and notes
which blocks stand in an ``article`` or ``main`` element. Where there is one, only its blocks are candidates for the text.
Then a suffix array decides on the blocks of every page: the word streams of a group of pages of a host are concatenated, their
suffixes sorted by the first ``RUN`` words, and runs shared by different contents are boilerplate; blocks that are
covered by such runs go, unique runs stay. Groups are salted parts of a host of bounded size; what their runs have in common
is found by buckets of runs, so runs shared across groups are found as well and no host meets in one task.

Copies do not erase each other: runs are counted over different contents (digests of the blocks), not over pages, and an article that is
covered as a whole is a near copy of another and stays. A page without an article gives no such sign, as menus may be most of it.

Defined cases: a null or empty page has an empty text; text outside any block is a block; an unclosed element ends with the
page; an unclosed comment or tag is dropped up to the end; unknown character references stay as they are; pages of equal
blocks count as one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideframe.llm.batches import in_batches
from tideframe.llm.tokens import each_text, windows
from tideframe.session import materialize

#: Words of a shared run; a power of two. Pages of a group whose suffixes are sorted together.
RUN, GROUP_PAGES = 8, 500
#: Share of a block's words in shared runs from which it is boilerplate, and of an article's from which it is a copy.
COVERED = 0.5
#: Groups whose runs one bucket gathers; bits of a run below its head.
BUCKET_GROUPS, HEAD = 8, np.uint64(32)

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']|"[^"]*"|'[^']*')*)>|<(?=[a-zA-Z/])[^<>]*(?:>|\Z)|[^<]+|<""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.IGNORECASE)
# Elements by what they mean in a page.
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes"}
DROPPED = {
    "head", "nav", "header", "footer", "aside", "form", "noscript", "template", "svg", "math", "iframe", "object", "button", "select",
    "dialog", "menu", "canvas", "audio", "video", "datalist", "fieldset", "label", "input",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dir", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p",
    "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
CLOSES_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed)?|promo(?:tion)?|banners?|cookies?|consent|gdpr|notices?|alerts?|popups?|modals?|overlays?"
    r"|side-?bars?|menus?|nav(?:bar|igation)?|bread-?crumbs?|comments?|disqus|replies|respond|headers?|footers?|social|share|sharing|related|recommend(?:ed|ations)?"
    r"|newsletters?|subscri(?:be|ption)|sign-?up|log-?in|search|widgets?|masthead|topbar|toolbar|pagination|pager|skip-link)(?=$|[\s_-])",
    re.IGNORECASE,
)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
_SPACE = re.compile(r"\s+")


def _unwanted(tag: str, attributes: str) -> bool:
    if tag in DROPPED:
        return True
    if tag in ("html", "body", "article", "main") or not attributes:
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        value, name = next((v for v in values if v), ""), name.lower()
        if name in ("class", "id"):
            if MARKS.search(value):
                return True
        elif name == "role":
            if value.lower() in ROLES:
                return True
        elif name == "hidden" or value.lower() == "true":
            return True
    return False


def page_blocks(html: str | None) -> list[tuple[str, bool]]:
    """(text, whether in an article) of every block that is not marked as something else, in page order."""
    blocks: list[tuple[str, bool]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # (tag, starts a dropped part, is an article)
    dropped = articles = 0
    raw = ""

    def flush() -> None:
        nonlocal parts
        if parts:
            text = _SPACE.sub(" ", unescape("".join(parts))).strip()
            if text:
                blocks.append((text, articles > 0))
            parts = []

    def pop() -> None:
        nonlocal dropped, articles
        tag, drops, article = stack.pop()
        if tag in BLOCK:
            flush()
        dropped -= drops
        articles -= article

    for found in _TOKEN.finditer(html or ""):
        tag = found[2]
        if tag is None:
            if not dropped and not raw and (found[0][0] != "<" or found[0] == "<"):
                parts.append(found[0])
            continue
        tag = tag.lower()
        if raw:
            if found[1] and tag == raw:
                raw = ""
            continue
        if found[1]:
            if any(tag == t for t, _, _ in stack):
                while stack[-1][0] != tag:
                    pop()
                pop()
            elif tag in BLOCK and not dropped:
                flush()
            continue
        if tag in RAW:
            raw = tag
            continue
        if tag in CLOSES_P and any(t == "p" for t, _, _ in stack[-8:]):
            while stack[-1][0] != "p":
                pop()
            pop()
        if tag in ("li", "dt", "dd", "option", "tr", "td", "th") and stack and stack[-1][0] == tag:
            pop()
        if tag in BLOCK and not dropped:
            flush()
        if tag in VOID or found[3].endswith("/") and tag not in BLOCK:
            if tag in ("br", "hr", "wbr", "img") and not dropped and tag != "wbr":
                parts.append(" ")
            continue
        drops = _unwanted(tag, found[3])
        article = tag in ("article", "main") and not dropped and not drops
        stack.append((tag, drops, article))
        dropped += drops
        articles += article
    while stack:
        pop()
    flush()
    return blocks


def _pack(data: bytes) -> bytes:
    return pa.compress(data, codec="zstd", asbytes=True)


def _unpack(data: pa.Scalar, size: int) -> pa.Buffer:
    return pa.decompress(data.as_buffer(), decompressed_size=size, codec="zstd")


def _host() -> Column:
    return F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))


def cut_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, host, marked (has an article), digest of the blocks, packed blocks (of the article, where there is one) and their size."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marked, digests, packed, sizes = [], [], [], []
            for html in batch.column(3):
                blocks = page_blocks(html.as_py())
                article = [text for text, inside in blocks if inside]
                data = "\n".join(article or [text for text, _ in blocks]).encode()  # no block holds a line end
                marked.append(bool(article))
                digests.append(int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True))
                packed.append(_pack(data))
                sizes.append(len(data))
            columns = [pa.array(marked, pa.bool_()), pa.array(digests, pa.int64()), pa.array(packed, pa.binary()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], names=["page_id", "url", "host", "marked", "digest", "packed", "size"])

    id_type = pages.schema["page_id"].dataType.simpleString()
    return in_batches(pages.select("page_id", "url", _host().alias("host"), "html")).mapInArrow(
        cut, f"page_id {id_type}, url string, host string, marked boolean, digest long, packed binary, size long"
    )


def shared_runs(streams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(digest, least stream, greatest stream) of every run of ``RUN`` words, by a suffix array over all streams.

    Suffixes are ranked by 1, 2, 4 ... words (prefix doubling); a border after each stream is a word of its own.
    """
    words = np.concatenate([np.append(s, np.uint64(0)) for s in streams]) if streams else np.empty(0, np.uint64)
    of = np.repeat(np.arange(len(streams)), [len(s) + 1 for s in streams])
    if not len(words):
        return np.empty(0, np.uint64), of, of
    border = np.append(np.diff(of) > 0, True)
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64) + 1
    rank[border] = rank.max() + 1 + of[border]
    length = 1
    while length < RUN:
        following = np.append(rank[length:], np.zeros(min(length, len(rank)), dtype=np.int64))[: len(rank)]
        rank = np.unique(rank * (int(rank.max()) + 1) + following, return_inverse=True)[1].astype(np.int64) + 1
        length *= 2
    suffixes = np.argsort(rank, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(rank[suffixes]) > 0))
    low = np.minimum.reduceat(of[suffixes], starts)
    high = np.maximum.reduceat(of[suffixes], starts)
    first = suffixes[starts]
    whole = first + RUN <= len(words)
    inside = np.zeros(len(first), dtype=bool)
    inside[whole] = of[first[whole]] == of[first[whole] + RUN - 1]
    inside[whole] &= ~border[first[whole] + RUN - 1]
    digests = windows(words, RUN)
    return digests[first[inside]], low[inside], high[inside]


def page_words(blocks: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all pages, the border of each block within them and the border of each page within the blocks."""
    found = [h for _, h in each_text([b for page in blocks for b in page])]
    words = np.concatenate(found) if found else np.empty(0, np.uint64)
    return words, np.append(0, np.cumsum([len(h) for h in found], dtype=np.int64)), np.append(0, np.cumsum([len(page) for page in blocks], dtype=np.int64))


def kept_blocks(blocks: list[list[str]], marked: list[bool], shared: np.ndarray) -> list[str]:
    """The text of every page without the blocks that shared runs cover; an article that they cover is a copy of another and stays whole."""
    words, at, page_at = page_words(blocks)
    page_of = np.repeat(np.arange(len(blocks)), np.diff(at[page_at]))
    own = windows(words, RUN)
    places = np.flatnonzero(np.isin(own, shared)) if len(own) else np.empty(0, np.int64)
    places = places[page_of[places] == page_of[places + RUN - 1]]
    borders = np.bincount(places, minlength=len(words) + 1) - np.bincount(places + RUN, minlength=len(words) + 1)
    before = np.append(0, np.cumsum(np.cumsum(borders[: len(words)]) > 0))  # covered words before each word
    sizes, covered = np.diff(at), np.diff(before[at])
    keep = (sizes == 0) | (covered < COVERED * sizes)
    sizes, covered = np.diff(at[page_at]), np.diff(before[at[page_at]])
    whole = (covered == 0) | np.array(marked, dtype=bool) & (covered >= COVERED * sizes)
    return [" ".join(page if w else [b for b, k in zip(page, keep[first:], strict=False) if k]) for page, w, first in zip(blocks, whole, page_at, strict=False)]


def _blocks(table: pa.Table) -> list[list[str]]:
    texts = (_unpack(data, size).to_pybytes().decode() for data, size in zip(table["packed"], table["size"].to_pylist(), strict=True))
    return [text.split("\n") if text else [] for text in texts]


def _streams(table: pa.Table) -> tuple[list[int], list[np.ndarray]]:
    """The different digests of a group in ascending order, with the words of each."""
    digests, first = np.unique(table["digest"].to_numpy(), return_index=True)
    words, at, page_at = page_words(_blocks(table.take(pa.array(first))))
    borders = at[page_at]
    return digests, [words[a:z] for a, z in zip(borders, borders[1:], strict=False)]


def _ascending(values: np.ndarray) -> bytes:
    """Ascending numbers packed as steps, byte by byte: high bytes of steps are alike."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return _pack(steps.view(np.uint8).reshape(len(steps), steps.itemsize).T.tobytes())


def _numbers(data: pa.Scalar, n: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(_unpack(data, n * width), np.uint8).reshape(width, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(kind).ravel(), dtype=kind)


def _run_table(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * len(names), kinds, strict=True)], names=names)


_PIECE = ["host", "marked", "part", "bucket", "n_heads", "heads", "n_runs", "runs"]
_PIECE_TYPES = [pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]
_PIECE_SCHEMA = "host string, marked boolean, part long, bucket long, n_heads long, heads binary, n_runs long, runs binary"
_ENDS = ["host", "marked", "part", "bucket", "n_runs", "runs", "low", "high"]
_ENDS_TYPES = [pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
_ENDS_SCHEMA = "host string, marked boolean, part long, bucket long, n_runs long, runs binary, low binary, high binary"


def _buckets(runs: np.ndarray, n_groups: int) -> Iterator[tuple[int, slice]]:
    """(bucket, range) of ascending runs of a host of so many groups; a bucket holds about as many runs as ``BUCKET_GROUPS`` groups."""
    count = -(-n_groups // BUCKET_GROUPS)
    borders = np.array([(b << 64) // count for b in range(1, count)], dtype=np.uint64)
    cuts = [0, *np.searchsorted(runs, borders).tolist(), len(runs)]
    return ((b, slice(a, z)) for b, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)))


def find_runs(key: tuple, table: pa.Table) -> pa.Table:
    """Of a group: heads of all its runs and the runs that different contents of it share, by buckets."""
    host, marked, part = (k.as_py() for k in key)
    n_groups = table["n_groups"][0].as_py()
    runs, low, high = shared_runs(_streams(table)[1])
    order = np.argsort(runs)
    runs, shared = runs[order], (low != high)[order]
    rows = []
    for bucket, at in _buckets(runs, n_groups):
        heads = np.unique((runs[at] >> HEAD).astype(np.uint32)) if n_groups > 1 else np.empty(0, np.uint32)
        own = runs[at][shared[at]]
        if len(heads) or len(own):
            rows.append((host, marked, part, bucket, len(heads), _ascending(heads), len(own), _ascending(own)))
    return _run_table(rows, _PIECE, _PIECE_TYPES)


def meet_heads(table: pa.Table) -> pa.Table:
    """Of a bucket: for each group the heads that another group has too, and the runs that it found by itself."""
    held = [_numbers(d, n, np.uint32) for d, n in zip(table["heads"], table["n_heads"].to_pylist(), strict=True)]
    heads, often = np.unique(np.concatenate(held), return_counts=True)
    common = heads[often > 1]
    held = [h[np.isin(h, common, assume_unique=True)] for h in held]
    found = table.set_column(4, "n_heads", pa.array([len(h) for h in held], pa.int64()))
    return found.set_column(5, "heads", pa.array([_ascending(h) for h in held], pa.binary()))


def find_ends(key: tuple, table: pa.Table, met: pa.Table) -> pa.Table:
    """Of a group: its runs with such a head, and the least and greatest content that holds each."""
    if not table.num_rows or not met.num_rows:
        return _run_table([], _ENDS, _ENDS_TYPES)
    host, marked, part = (k.as_py() for k in key)
    heads = np.concatenate([_numbers(d, n, np.uint32) for d, n in zip(met["heads"], met["n_heads"].to_pylist(), strict=True)])
    digests, streams = _streams(table)
    own = [windows(s, RUN) for s in streams]
    runs, of = np.concatenate(own), np.repeat(digests, [len(o) for o in own])
    taken = np.isin((runs >> HEAD).astype(np.uint32), heads)
    runs, of = runs[taken], of[taken]
    order = np.lexsort((of, runs))
    runs, of = runs[order], of[order]
    new = np.append(True, runs[1:] != runs[:-1]) if len(runs) else np.empty(0, bool)
    runs, low, high = runs[new], of[new], of[np.append(new[1:], True)[: len(new)]]
    rows = []
    for bucket, at in _buckets(runs, table["n_groups"][0].as_py()):
        if len(runs[at]):
            rows.append((host, marked, part, bucket, len(runs[at]), _ascending(runs[at]), _pack(low[at].tobytes()), _pack(high[at].tobytes())))
    return _run_table(rows, _ENDS, _ENDS_TYPES)


def meet_ends(table: pa.Table) -> pa.Table:
    """Of a bucket: for each group its runs that different contents of the host share."""
    sizes = table["n_runs"].to_pylist()
    held = [_numbers(d, n, np.uint64) for d, n in zip(table["runs"], sizes, strict=True)]
    low, high = (np.concatenate([np.frombuffer(_unpack(d, n * 8), np.int64) for d, n in zip(table[c], sizes, strict=True)]) for c in ("low", "high"))
    runs, place = np.unique(np.concatenate(held), return_inverse=True)
    least, most = np.full(len(runs), np.iinfo(np.int64).max), np.full(len(runs), np.iinfo(np.int64).min)
    np.minimum.at(least, place, low)
    np.maximum.at(most, place, high)
    shared = runs[least != most]
    held = [h[np.isin(h, shared, assume_unique=True)] for h in held]
    found = table.select(_PIECE[:4]).append_column("n_runs", pa.array([len(h) for h in held], pa.int64()))
    return found.append_column("runs", pa.array([_ascending(h) for h in held], pa.binary()))


def drop_shared(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every page without the blocks that runs shared by different contents of its host cover.

    Articles meet articles, and pages without one each other. Groups first tell the heads of their runs, two bytes a run when
    packed; only runs whose heads two groups have are told in full. The groups' exchange is read by all three steps.
    """
    hosts = ["host", "marked"]
    sizes = pages.groupBy(_host().alias("host")).agg(F.ceil(F.count("*") / GROUP_PAGES).alias("n_groups")).filter("n_groups > 1")
    large = F.broadcast(materialize(sizes, "hosts"))  # a row for 500 pages at most
    cut = cut_pages(pages).join(large, "host", "left").withColumn("n_groups", F.coalesce("n_groups", F.lit(1)))
    cut = cut.withColumn("part", F.pmod(F.xxhash64("page_id", "url", "digest"), F.col("n_groups")))
    key = [*hosts, "part"]
    groups, bucket = in_batches(cut).groupBy(*key), [*hosts, "bucket"]

    def named(frame: DataFrame, *columns: str):
        return frame.select(*[F.col(k).alias(f"of_{k}") for k in key], *columns).groupBy(*[f"of_{k}" for k in key])

    met = groups.applyInArrow(find_runs, _PIECE_SCHEMA).groupBy(*bucket).applyInArrow(meet_heads, _PIECE_SCHEMA)
    ends = groups.cogroup(named(met.filter("n_heads > 0"), "n_heads", "heads")).applyInArrow(find_ends, _ENDS_SCHEMA)
    across = ends.groupBy(*bucket).applyInArrow(meet_ends, "host string, marked boolean, part long, bucket long, n_runs long, runs binary")
    shared = met.select(*key, "n_runs", "runs").unionByName(across.select(*key, "n_runs", "runs")).filter("n_runs > 0")

    def rebuild(table: pa.Table, told: pa.Table) -> pa.Table:
        runs = [_numbers(d, n, np.uint64) for d, n in zip(told["runs"], told["n_runs"].to_pylist(), strict=True)]
        texts = kept_blocks(_blocks(table), table["marked"].to_pylist(), np.concatenate([np.empty(0, np.uint64), *runs]))
        return table.select(["page_id", "url"]).append_column("text", pa.array(texts, pa.string()))

    id_type = cut.schema["page_id"].dataType.simpleString()
    return groups.cogroup(named(shared, "n_runs", "runs")).applyInArrow(rebuild, f"page_id {id_type}, url string, text string")


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    found = drop_shared(pages)
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
