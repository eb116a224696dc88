"""Main text of web pages by nearest-URL page differencing.

Pages are ordered by host and URL path, and each page is aligned with the pages before and after it: the
longest common subsequence of their text lines is what the site's template repeats, and is deleted. Two
things are known from markup and go first. If a page has an article container, nothing outside it is main
text, and a line inside it goes only on more evidence: the nearest ``SEVERAL`` pages or paths on one side
all have it in their text too, leaving out copies of this article or of each other (``COPY`` of the text in
common); a host with fewer on both sides needs all of them, two at least. A paragraph copied from a
neighbour, and an article copied whole by many, stay. Lines inside containers that name themselves as
menus, headers, footers, sidebars, notices, adverts, forms or comments are deleted also on pages that
have no neighbour; a name counts only as a whole, a form not if it is the frame of the page's text, and a name
(unless of comments or related pages) does not hide an article that holds most of the text.

Rows with the same path and query (tracking parameters aside) are copies or versions of one page. Each is
compared with the nearest rows of another page, and with the nearest rows of another path, before and
after the whole run. Rows with equal lines are copies, and rows of one path that differ in the query and
share ``VERSION`` of their text are versions; neither are compared.

The order is cut into ranges whose outer pages are also sent to the ranges that need them, so a host of any
size is spread over tasks. Rows are sent with their lines compressed, and a task keeps them so while it reads the
neighbours of each: in memory up to ``HELD`` bytes, on its own disk beyond.

Defined cases: a null html gives an empty text; a null or odd URL is a host of its own text; rows that
repeat each give their text; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import html
import pickle
import re
import tempfile
import zlib
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import shuffle_partitions

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*+>", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_RAW = frozenset({"script", "style", "noscript", "template", "textarea", "iframe", "svg", "title", "select", "object"})
_CHROME = frozenset({"nav", "footer", "aside", "form", "menu", "button", "dialog", "head", "header"})
_BOX = frozenset(
    {"div", "section", "article", "main", "ul", "ol", "dl", "table", "figure", "blockquote", "details", "fieldset", "center"}) | _CHROME
_BLOCK = _BOX | frozenset(
    {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "td", "th", "caption", "thead", "tbody", "tfoot", "pre", "hr",
     "address", "figcaption", "summary", "legend", "body", "html", "option", "title"})
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar aside footer header masthead cookie cookies consent notice notices alert popup modal newsletter subscribe signup login "
    "comment comments reply replies discussion disqus social share sharing related widget toolbar pagination pager copyright skip banner "
    "search complementary contentinfo form".split())

# Marks of boxes that hold articles which are not the page's.
_TALK = frozenset("comment comments reply replies discussion disqus related".split())
# Words that beside a mark leave its meaning ("ad-box", "site-footer"); other words do not ("has-sidebar", "category-social").
_NEUTRAL = frozenset(
    "site page main global top bottom left right inner outer box list item items wrapper wrap container block section area bar row col "
    "column links link buttons button content body text title heading post posts article articles primary secondary js div the".split())

CHROME, PLAIN, ARTICLE = 0, 1, 2
# Only while a page is read: text of a marked box, of an article in one, of a form, of a form in an article.
_MARKED, _NESTED, _FORM, _ARTICLE_FORM = 3, 4, 5, 6
_IN_ARTICLE = (ARTICLE, _NESTED, _ARTICLE_FORM)
VERSION = 0.9  # share of equal text from which rows of one path are versions of a page
SEVERAL = 5  # neighbours in a row, of different articles, that show a line in a container to be the template's
HELD = 32 << 20  # bytes of compressed rows that a task keeps in memory
COPY = 0.5  # share of equal text from which two articles are copies of each other


def _is_mark(token: str, marks: frozenset) -> bool:
    """Whether a whole class, id or role token is a mark: mark words with neutral words at most."""
    words = re.findall("[a-z]+", token)
    return not marks.isdisjoint(words) and all(w in marks or w in _NEUTRAL for w in words)


def _settled(lines: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """Zones CHROME, PLAIN, ARTICLE. A form with more than half of the text is the page's frame, not a box in it; an article in a
    marked box, or with a mark, is the page's article if it holds more than all other text."""
    size = [0] * 7
    for z, line in lines:
        size[z] += len(line)
    to = list(range(7))
    forms = size[_FORM] + size[_ARTICLE_FORM]
    frame = forms > size[PLAIN] + size[ARTICLE] + size[_NESTED]
    to[_FORM], to[_ARTICLE_FORM] = (PLAIN, ARTICLE) if frame else (CHROME, CHROME)
    beside = size[PLAIN] + size[ARTICLE] + forms * frame
    to[_NESTED] = ARTICLE if size[_NESTED] > beside else CHROME
    to[_MARKED] = CHROME
    return [(to[z], line) for z, line in lines]


def lines_of(page: str) -> list[tuple[int, str]]:
    """(zone, line) of every non-empty block of text in page order; zones CHROME, PLAIN, ARTICLE."""
    out: list[tuple[int, str]] = []
    parts: list[str] = []
    stack: list[tuple[str, int]] = []  # open boxes, with the zone each one sets
    zone, at, size = PLAIN, 0, len(page)

    def close() -> None:
        line = " ".join("".join(parts).split())
        parts.clear()
        if line:
            out.append((zone, line))

    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            parts.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            parts.append(html.unescape(page[at : m.start()]))
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            parts.append(" ")
            continue
        if name in _BLOCK:
            close()
        if m["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    zone = stack[-1][1] if stack else PLAIN
                    break
            continue
        if stack and name in _BLOCK and (stack[-1][0] == "p" or stack[-1][0] == name and name not in _BOX):
            stack.pop()  # a block start ends an open marked paragraph, an item start an open marked item
            zone = stack[-1][1] if stack else PLAIN
        rest = m["rest"]
        if name in _RAW:
            if not rest.endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else size
            continue
        marks = talk = False
        if name not in ("body", "html", "main") and "=" in rest:
            for names in _NAMES.findall(rest):
                known = _MARKS if zone not in _IN_ARTICLE else _MARKS - {"header"}
                tokens = [token for token in "".join(names).lower().split() if _is_mark(token, known)]
                marks = marks or bool(tokens)
                talk = talk or any(not _TALK.isdisjoint(re.findall("[a-z]+", token)) for token in tokens)
        box = name in _BOX
        if rest.endswith("/") or not (box or marks) or name in ("hr", "img", "input", "meta", "link", "col", "wbr"):
            continue
        if not box:  # a marked line or phrase: what it holds is its own line
            close()
            if stack and stack[-1][0] == name:
                stack.pop()
                zone = stack[-1][1] if stack else PLAIN
        article = name in ("article", "main")
        if zone == CHROME or name in _CHROME and name != "form" and not (name == "header" and zone in _IN_ARTICLE):
            new = CHROME
        elif zone == _MARKED:
            new = _NESTED if article else zone
        elif marks:
            new = CHROME if talk else _NESTED if article else _MARKED
        elif name == "form":
            new = {ARTICLE: _ARTICLE_FORM, PLAIN: _FORM}.get(zone, zone if zone in (_FORM, _ARTICLE_FORM) else CHROME)
        elif article:
            new = zone if zone in _IN_ARTICLE else ARTICLE
        else:
            new = zone
        stack.append((name, new))
        zone = new
    close()
    return _settled(out)


def _lengths(a: list[int], b: list[int]) -> list[int]:
    """Longest common subsequence lengths of all of ``a`` against every prefix of ``b``."""
    masks: dict[int, int] = {}
    for j, y in enumerate(b):
        masks[y] = masks.get(y, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & masks.get(x, 0)
        v = ((v + u) | (v - u)) & full
    out = [0]
    for j in range(len(b)):
        out.append(out[-1] + (not v >> j & 1))
    return out


def common_lines(a: list, b: list, cells: int = 1 << 26) -> list[tuple[int, int]]:
    """Index pairs of a longest common subsequence; bit rows, halved when they pass ``cells`` bits."""
    both = set(a) & set(b)
    ia, ib = [i for i, x in enumerate(a) if x in both], [j for j, y in enumerate(b) if y in both]
    out: list[tuple[int, int]] = []
    lo, n = 0, min(len(ia), len(ib))
    while lo < n and a[ia[lo]] == b[ib[lo]]:
        out.append((ia[lo], ib[lo]))
        lo += 1
    ia, ib = ia[lo:], ib[lo:]
    while ia and ib and a[ia[-1]] == b[ib[-1]]:
        out.append((ia.pop(), ib.pop()))
    if not ia or not ib:
        return sorted(out)
    code = {x: k for k, x in enumerate(both)}
    x, y = [code[a[i]] for i in ia], [code[b[j]] for j in ib]
    if len(x) * len(y) > cells and len(x) > 1:
        half = len(x) // 2
        front = _lengths(x[:half], y)
        back = _lengths(x[half:][::-1], y[::-1])[::-1]
        cut = max(range(len(y) + 1), key=lambda j: front[j] + back[j])
        out += [(ia[i], ib[j]) for i, j in common_lines(x[:half], y[:cut], cells)]
        out += [(ia[half + i], ib[cut + j]) for i, j in common_lines(x[half:], y[cut:], cells)]
        return sorted(out)
    masks: dict[int, int] = {}
    for j, v in enumerate(y):
        masks[v] = masks.get(v, 0) | 1 << j
    full = (1 << len(y)) - 1
    rows = [full]
    for v in x:
        u = rows[-1] & masks.get(v, 0)
        rows.append(((rows[-1] + u) | (rows[-1] - u)) & full)
    i, j = len(x), len(y)
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            out.append((ia[i], ib[j]))
    return sorted(out)


# Parameters that say where a visitor came from and never which page is meant.
_TRACKING = r"(?i)(?:^|&)(?:utm_[a-z_]*|ref|referrer|fbclid|gclid|msclkid|mc_cid|mc_eid|sessionid|sid|phpsessid|jsessionid)(?:=[^&]*)?(?=&|$)"


def _order_key(url, page_id):
    """host, path without ending slash or .html, query without tracking parameters; then the id."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://|#.*$", ""), "\x01", "")
    address = F.substring_index(bare, "?", 1)
    host = F.lower(F.substring_index(address, "/", 1))
    path = F.regexp_replace(address, r"^[^/]*", "")
    path = F.regexp_replace(F.regexp_replace(path, r"/+$", ""), r"\.html?$", "")
    query = F.regexp_replace(F.regexp_replace(F.regexp_extract(bare, r"\?(.*)$", 1), _TRACKING, ""), r"^&+|&+$", "")
    return F.concat_ws("\x01", host, path, query, F.lpad(F.coalesce(page_id.cast("string"), F.lit("")), 20, "0"))


def _page(k: str) -> str:
    return k.rsplit("\x01", 1)[0]


def _path(k: str) -> str:
    return k.rsplit("\x01", 2)[0]


def _host(k: str) -> str:
    return k.split("\x01", 1)[0]


def _range_ends(batches):
    """The first and last keys of a sorted range's outer pages and outer paths, on each side."""
    kept = []
    for size, name in ((SEVERAL + 1, _page), (SEVERAL + 1, _path)):
        kept.append((size, name, [], []))  # runs as [first, last]: the first ones, the last ones
    for batch in batches:
        for k in batch.column("k").to_pylist():
            for size, name, front, back in kept:
                if back and name(back[-1][1]) == name(k):
                    back[-1][1] = k
                else:
                    back.append([k, k])
                    if len(front) < size:
                        front.append(back[-1])
                    del back[:-size]
    found = sorted({k for _, _, front, back in kept for run in front + back for k in run})
    if found:
        yield pa.RecordBatch.from_arrays([pa.array([found], pa.list_(pa.string()))], names=["ks"])


def _beside(ranges: list[list[str]]) -> dict[str, list[int]]:
    """key -> the ranges that need its page as a neighbour: before and after each range the nearest pages and paths."""
    out: dict[str, list[int]] = {}
    for step in (1, -1):
        held: dict = {_page: [], _path: []}  # keys of the nearest rows of the pages and paths passed, last first
        host = None
        for p in range(len(ranges))[::step]:
            for k in set(held[_page] + held[_path]):
                out.setdefault(k, []).append(p)
            for k in ranges[p][::step]:
                if _host(k) != host:
                    host, held = _host(k), {_page: [], _path: []}
                for name, size in ((_page, SEVERAL + 1), (_path, SEVERAL + 1)):
                    if held[name] and name(held[name][0]) == name(k):
                        held[name][0] = k
                    else:
                        held[name] = [k, *held[name][: size - 1]]
    return out


def _blob(lines: list[tuple[int, str]]) -> bytes:
    """Zones and lines, compressed; no line holds a newline."""
    return zlib.compress(bytes(z for z, _ in lines) + b"\n" + "\n".join([t for _, t in lines]).encode(), 1)


def _unblob(blob: bytes) -> tuple[bytes, list[str]]:
    zones, _, text = zlib.decompress(blob).partition(b"\n")
    return zones, text.decode().split("\n") if zones else []


_SENT = "part int, own boolean, k string, page_id long, url string, lines binary, h binary"


def _parsed(starts: list[str], beside: dict[str, list[int]]):
    """Rows (part, own, k, page_id, url, lines, h): each page in its range, outer pages also beside it."""

    def work(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                cols: list[list] = [[] for _ in range(7)]
                part = batch.slice(at, 256)
                for k, page_id, url, page in zip(*(part.column(c).to_pylist() for c in ("k", "page_id", "url", "html"))):
                    lines = _blob(lines_of(page or ""))
                    h = hashlib.blake2b((page or "").encode("utf-8", "surrogatepass"), digest_size=8).digest()
                    p = max(bisect_right(starts, k) - 1, 0)
                    for q, own in [(p, True), *((q, False) for q in beside.get(k, ()))]:
                        for c, v in zip(cols, (q, own, k, page_id, url, lines, h)):
                            c.append(v)
                kinds = [pa.int32(), pa.bool_(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                                 names=["part", "own", "k", "page_id", "url", "lines", "h"])

    return work


def _chars(lines) -> int:
    return sum(map(len, lines))


def _alike(a: list[str], b: list[str], share: float, pairs: list | None = None) -> bool:
    """Whether the common lines are ``share`` of the characters of both."""
    pairs = common_lines(a, b) if pairs is None else pairs
    return _chars(a[i] for i, _ in pairs) >= share * max(_chars(a), _chars(b))


def _body(row: dict) -> list[str]:
    """The lines that can be main text."""
    least = ARTICLE if ARTICLE in row["zones"] else PLAIN
    return [t for z, t in zip(row["zones"], row["lines"]) if z >= least]


def _template(body: list[str], sides: list[list[dict]]) -> set[int]:
    """Container lines that all of the nearest ``SEVERAL`` pages on one side have, of articles unlike this one and each other."""
    known: dict[int, tuple[list[str], set[int] | None]] = {}  # by row: its text, and the lines shared with it unless a copy

    def articles(rows: list[dict]) -> list[int]:
        kept: list[int] = []
        for other in rows:
            n = id(other)
            if n not in known:
                lines = _body(other)
                pairs = common_lines(body, lines)
                known[n] = lines, None if _alike(body, lines, COPY, pairs) else {i for i, _ in pairs}
            lines, shared = known[n]
            if shared is not None and len(kept) < SEVERAL and not any(m == n or _alike(known[m][0], lines, COPY) for m in kept):
                kept.append(n)
        return kept

    full = [kept for kept in map(articles, sides) if len(kept) == SEVERAL]
    if not full:  # a small host: all its other articles, two at least
        full = [kept for kept in [articles([r for side in sides for r in side])] if len(kept) > 1]
    return set().union(*(set.intersection(*(known[n][1] for n in kept)) for kept in full))


def _main_text(row: dict, sides: list[list[dict]]) -> tuple[str, int, int]:
    """Text, lines cut by differencing, lines cut by markup; ``sides``: pages, then paths before and after, nearest first."""
    body = _body(row)
    shared: set[int] = set()
    if ARTICLE in row["zones"]:
        shared = _template(body, sides)
    else:
        for other in {id(side[0]): side[0] for side in sides if side}.values():
            if other["lines"] == row["lines"]:
                continue
            pairs = common_lines(body, other["lines"])
            if _path(other["k"]) == _path(row["k"]) and _alike(body, _body(other), VERSION):
                continue
            shared.update(i for i, _ in pairs)
    return "\n".join(t for i, t in enumerate(body) if i not in shared), len(shared), len(row["lines"]) - len(body)


class _Rows:
    """The rows of a task, compressed, read back by number; the last few read are kept."""

    def __init__(self):
        self.file, self.at, self.keys, self.own, self.held = tempfile.SpooledTemporaryFile(HELD), [0], [], [], {}

    def add(self, row: dict) -> None:
        self.keys.append((row["part"], row["k"]))
        self.own.append(row["own"])
        self.at.append(self.at[-1] + self.file.write(pickle.dumps((row["page_id"], row["url"], row["lines"]), 5)))

    def __getitem__(self, i: int) -> dict:
        if i not in self.held:
            if len(self.held) >= 64:
                del self.held[next(iter(self.held))]
            self.file.seek(self.at[i])
            page_id, url, blob = pickle.loads(self.file.read(self.at[i + 1] - self.at[i]))
            zones, lines = _unblob(blob)
            self.held[i] = {"k": self.keys[i][1], "page_id": page_id, "url": url, "zones": zones, "lines": lines}
        return self.held[i]

    def runs(self, name) -> tuple[list[int], list[int]]:
        """The run number of each row, rows of one part and ``name(key)`` being a run, and where the runs start."""
        number, starts, last = [], [], None
        for i, (part, k) in enumerate(self.keys):
            if last != (part, name(k)):
                last = (part, name(k))
                starts.append(i)
            number.append(len(starts) - 1)
        return number, starts + [len(self.keys)]

    def sides(self, i: int, runs: tuple[list[int], list[int]]) -> list[list[int]]:
        """The last rows of the ``SEVERAL`` runs before that of row ``i``, the first rows of those after it; same host."""
        number, starts = runs
        at, (part, k) = number[i], self.keys[i]
        before = [starts[n + 1] - 1 for n in range(at - 1, max(at - 1 - SEVERAL, -1), -1)]
        after = [starts[n] for n in range(at + 1, min(at + 1 + SEVERAL, len(starts) - 1))]
        return [[j for j in side if self.keys[j][0] == part and _host(self.keys[j][1]) == _host(k)] for side in (before, after)]


def _differenced(batches):
    rows = _Rows()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for row in batch.slice(at, 256).to_pylist():
                rows.add(row)
    pages, paths = rows.runs(_page), rows.runs(_path)
    own = [i for i, mine in enumerate(rows.own) if mine]
    for at in range(0, len(own), 256):
        out: list[tuple] = []
        for i in own[at : at + 256]:
            row, places = rows[i], rows.sides(i, pages) + rows.sides(i, paths)
            other = {j: rows[j] for side in places for j in side}
            text, shared, marked = _main_text(row, [[other[j] for j in side] for side in places])
            out.append((row["page_id"], row["url"], text, len(text), shared, marked))
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                         names=["page_id", "url", "text", "n_chars", "n_shared", "n_marked"])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, n_shared, n_marked) per row: lines cut by differencing and by markup alone."""
    parts = 4 * shuffle_partitions(pages.sparkSession)
    page_id, url = F.col(id_col).cast("long"), F.col(url_col).cast("string")
    rows = pages.select(page_id.alias("page_id"), url.alias("url"), F.col(html_col).cast("string").alias("html"), _order_key(url, page_id).alias("k"))
    # Ends of the ranges, from the keys alone: at most 8 * (SEVERAL + 1) keys per range reach the driver.
    ends = rows.select("k").repartitionByRange(parts, "k").sortWithinPartitions("k").mapInArrow(_range_ends, "ks array<string>").collect()
    ranges = sorted(r["ks"] for r in ends)
    found = rows.mapInArrow(_parsed([r[0] for r in ranges], _beside(ranges)), _SENT)
    return found.repartition(parts // 4, "part").sortWithinPartitions("part", "k", "h").mapInArrow(
        _differenced, "page_id long, url string, text string, n_chars long, n_shared long, n_marked long")
