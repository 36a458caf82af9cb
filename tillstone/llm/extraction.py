"""Main text of web pages by nearest-URL page differencing.

Lines
    A page becomes text lines, one per block element; markup, scripts, styles and the like fall away, character
    references are decoded, white space inside a line becomes one space. A line knows whether it stands in an element that
    names itself something else than text (``BESIDE``: menus, adverts, notices, comments ... by tag, class, id or
    role), and whether it stands in an ``article`` or ``main`` element.

Differencing
    Pages are sorted by path and id within their host, so that neighbours are the nearest by URL. A host of more than ``BLOCK`` pages
    is dealt into blocks of about as many, whole folders of its paths at a time, and a folder of more than that by
    hash: a block is a matter of the table, not of the partitions, and no group grows with its host. A page's lines that don't stand beside the text are aligned with those of a page before it
    on the host by longest common subsequence, and shared lines are deleted: they come from the site. Two pages are copies,
    and tell nothing about the site, if what they don't share is at most ``REST`` of either's text. Copies in a row are a
    run; its pages are aligned with the first page of the run before, or, in a host's first run, of the run after.
    What stands inside an article is not deleted for being shared: licence lines and quoted passages recur there.
    If a page has an article, its text is the article's, else that of all lines left.

Defined results
    A null or empty html gives an empty text. A null url has empty host and path and is paired among its like. A page that
    is alone with its host, or among copies of it only in its block, keeps its lines. Rows equal in url and id lie in one block. Pages without such lines are
    nobody's neighbours. Tags left open end with the element around them; the
    first article of a page, if it opens inside an unclosed element beside the text, ends that one. Repeated rows give repeated rows.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstone.llm.urls import host_and_path
from tillstone.plans.session import settled

#: Elements that never hold text of the page, and those that hold what stands beside the text.
UNSEEN = ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "head", "title", "textarea", "select")
BESIDE_TAGS = {"nav", "footer", "aside", "form", "dialog", "button", "menu"}
#: Words of a class, id or role that say the same.
BESIDE = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr"
    " notice alert popup modal overlay sidebar side rail nav navbar navigation menu breadcrumb breadcrumbs footer masthead"
    " toolbar comment comments disqus replies respond reply social share sharing related recommended newsletter subscribe"
    " subscription signup login search pagination pager widget complementary contentinfo".split()
)
#: Elements that end a line.
BLOCKS = set(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1"
    " h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th"
    " thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Two pages that don't share at most this much of their texts are copies of each other.
REST = 0.02

# Outside quotes a tag holds no other "<": what is never closed is text, and is read once.
_ATTRIBUTES = r"(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(UNSEEN) + r")\b" + _ATTRIBUTES + r">.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>" + _ATTRIBUTES + r")>"
    r"|<[!?/][^<>]*+>",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
PAIRS = 16  # pairs of equal lines per line, up to which they are followed one by one
FEW = 16  # places of a line, up to which its bits are set anew each time
BLOCK = 256  # pages of a host, or of a folder of its paths, beyond which they are dealt into blocks of about as many

Line = tuple[str, bool, bool]  # text, stands beside the text, stands in an article


def _beside(tag: str, rest: str, inside: bool) -> bool:
    if tag in BESIDE_TAGS or (tag == "header" and not inside):
        return True
    if not rest or "=" not in rest or tag in ("body", "html", "main"):
        return False
    words = {word for found in _NAMES.findall(rest) for word in _WORD.findall("".join(found).lower())}
    if tag == "article":  # says in its class what it has (comments-open), so only what it is counts
        return bool(words & {"comment", "reply"})
    return bool(words & BESIDE) or ("header" in words and not inside)


def lines(html: str) -> list[Line]:
    out: list[Line] = []
    pieces: list[str] = []
    inside = 0  # article and main elements open
    met = False  # an article or main element has been
    hidden, depth = "", 0  # the element beside the text that is open, and how many of its name are

    def flush() -> None:
        if pieces:
            if text := " ".join(entities.unescape("".join(pieces)).split()):
                out.append((text, bool(hidden), inside > 0))
            pieces.clear()

    at = 0
    for token in _TOKEN.finditer(html):
        if token.start() > at:
            pieces.append(html[at : token.start()])
        at = token.end()
        if not (tag := token["tag"]):
            if token["raw"]:
                pieces.append(" ")
            continue
        tag, end = tag.lower(), bool(token["end"])
        if tag in BLOCKS:
            flush()
        text = tag in ("article", "main")
        if hidden:
            if tag == hidden:
                depth += -1 if end else 1
                if depth == 0:
                    flush()
                    hidden = ""
            elif text and not end and not met and not _beside(tag, token["rest"], False):
                hidden, depth, inside, met = "", 0, 1, True
            elif text and end and inside:
                hidden, depth, inside = "", 0, inside - 1
            continue
        if text and end:
            inside = max(0, inside - 1)
        elif not end and tag not in VOID and not token["rest"].endswith("/") and _beside(tag, token["rest"], inside > 0):
            flush()
            hidden, depth = tag, 1
        elif text:
            inside, met = inside + 1, True
    pieces.append(html[at:])
    flush()
    return out


def shared(mine: list[str], other: list[str]) -> set[int]:
    """Places in mine of a longest common subsequence with other, in bounded time: pairs of equal lines are followed where they are
    few, else the lists are halved (Hirschberg) by lengths that bit vectors give."""
    found: set[int] = set()
    rest = [(0, len(mine), 0, len(other))]
    while rest:
        low, a, from_, b = rest.pop()
        while low < a and from_ < b and mine[low] == other[from_]:
            found.add(low)
            low, from_ = low + 1, from_ + 1
        while a > low and b > from_ and mine[a - 1] == other[b - 1]:
            a, b = a - 1, b - 1
            found.add(a)
        if low == a or from_ == b:
            continue
        counts = Counter(other[from_:b])
        if sum(counts[line] for line in mine[low:a]) <= PAIRS * (a - low + b - from_):
            found |= _followed(mine, other, low, a, from_, b)
            continue
        middle = (low + a) // 2
        before = _lengths(mine[low:middle], other[from_:b])
        after = _lengths(mine[middle:a][::-1], other[from_:b][::-1])[::-1]
        cut = from_ + int(np.argmax(before + after))
        rest += [(low, middle, from_, cut), (middle, a, cut, b)]
    return found


def _followed(mine: list[str], other: list[str], low: int, a: int, from_: int, b: int) -> set[int]:
    """The same for parts of both, in the time of their pairs of equal lines."""
    places: dict[str, list[int]] = {}
    for j in range(b - 1, from_ - 1, -1):  # from the last: a line takes one place only
        places.setdefault(other[j], []).append(j)
    ends: list[int] = []  # the smallest end of a common subsequence, by its length
    chain: list[tuple] = []
    for i in range(low, a):
        for j in places.get(mine[i], ()):
            k = bisect_left(ends, j)
            link = (i, chain[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chain.append(link)
            else:
                ends[k], chain[k] = j, link
    found, link = set(), chain[-1] if chain else None
    while link:
        found.add(link[0])
        link = link[1]
    return found


def _lengths(mine: list[str], other: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of mine and each prefix of other.

    One bit per line of other, cleared where the length grows; a line of mine changes all at once by an addition."""
    size = len(other)
    places: dict[str, list[int]] = {}
    for j, line in enumerate(other):
        places.setdefault(line, []).append(j)
    masks: dict[str, int] = {}
    whole = rows = (1 << size) - 1
    for line in mine:
        at = places.get(line)
        if at is None:
            continue
        mask = masks.get(line)
        if mask is None:
            mask = sum(1 << j for j in at) if len(at) <= FEW else int.from_bytes(np.packbits(_marked(at, size), bitorder="little").tobytes(), "little")
            if len(at) > FEW:
                masks[line] = mask
        met = rows & mask
        rows = ((rows + met) | (rows - met)) & whole
    bits = np.unpackbits(np.frombuffer(rows.to_bytes(size // 8 + 1, "little"), np.uint8), bitorder="little")[:size]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def _marked(at: list[int], size: int) -> np.ndarray:
    bits = np.zeros(size, np.uint8)
    bits[at] = 1
    return bits


def _copies(mine: list[Line], other: list[Line], common: set[int]) -> bool:
    size = sum(len(mine[i][0]) for i in common)
    return size >= (1 - REST) * max(sum(len(line[0]) for line in page) for page in (mine, other))


def _site(mine: list[Line], other: list[Line]) -> set[int] | None:
    """Places of the lines that a page shares with another; None if they are copies."""
    if mine == other:
        return None
    common = shared([line[0] for line in mine], [line[0] for line in other])
    return None if _copies(mine, other, common) else common


def own(page: list[Line], site: set[int]) -> str:
    """The lines of a page that are its own. page: those that don't stand beside the text."""
    left = [line for i, line in enumerate(page) if line[2] or i not in site]
    if any(line[2] for line in left):
        left = [line for line in left if line[2]]
    return "\n".join(line[0] for line in left)


def _told(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(page_id, url, text) of pages sorted by host and path. Only a host's first run waits, for the run after; its equal
    lines are held once."""
    host, before, head = object(), None, None  # first pages of the run before and of the present one
    waiting: list[tuple] = []
    held: dict[Line, Line] = {}
    for page_id, url, its_host, html in rows:
        page = [line for line in lines(html or "") if not line[1]]
        if its_host != host:
            yield from ((i, u, own(p, set())) for i, u, p in waiting)
            host, before, head, waiting, held = its_host, None, None, [], {}
        if not page:
            yield page_id, url, ""
            continue
        site = None if head is None else _site(page, head)
        if site is not None:  # the run ends
            yield from ((i, u, own(p, _site(p, page) or set())) for i, u, p in waiting)
            before, head, waiting, held = head, page, [], {}
        elif head is None:
            head = page
        elif before is not None:
            site = _site(page, before)
        if site is None:
            waiting.append((page_id, url, head if page == head else [held.setdefault(line, line) for line in page]))
        else:
            yield page_id, url, own(page, site)
    yield from ((i, u, own(p, set())) for i, u, p in waiting)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by block and path. Columns: page_id, url, block, html."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    out: list[tuple] = []
    for page_id, url, text in _told(rows):
        out.append((page_id, url, text, len(text)))
        if len(out) == 1024:
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64())
    arrays = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text", "n_chars"])


def extracted(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per page."""
    host, path = host_and_path(F.col(url_column))
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).alias("url"),
        host.alias("host"),
        path.alias("path"),
        F.col(html_column).alias("html"),
    ).withColumn("folder", F.regexp_extract("path", "^(.*)/", 1))
    # Hosts and folders that need blocks: at most a row per BLOCK pages each, settled so that their size is known.
    folders = settled(rows.groupBy("host", "folder").count(), "folders")
    deal = lambda n: F.ceil(F.col(n) / BLOCK)
    hosts = settled(folders.groupBy("host").agg(F.sum("count").alias("pages")).where(F.col("pages") > BLOCK), "large-hosts")
    large = settled(folders.where(F.col("count") > BLOCK), "large-folders")
    inside = F.when(F.col("count").isNotNull(), F.struct(F.xxhash64("folder").alias("a"), F.pmod(F.xxhash64("path", "page_id"), deal("count")).alias("b")))
    among = F.struct(F.lit(-1).cast("long").alias("a"), F.coalesce(F.pmod(F.xxhash64("folder"), deal("pages")), F.lit(0)).alias("b"))
    block = F.struct("host", F.coalesce(inside, among).alias("part"))
    named = (
        rows.join(hosts, "host", "left")
        .join(large, ["host", "folder"], "left")
        .select("page_id", "url", F.to_json(block).alias("block"), "html", "path")
    )
    near = named.repartition("block").sortWithinPartitions("block", "path", "page_id", F.xxhash64("html")).drop("path")
    return near.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
