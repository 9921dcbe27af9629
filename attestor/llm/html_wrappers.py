"""Main text of web pages by inferred wrappers: union-free regular expressions over the token streams of a host.

A page becomes a stream of tokens: block tags with their class, and text slots with the block that they stand in (inline
tags, comments, scripts and styles are no tokens).  The wrapper of a host starts as its first page's stream with tandem
repeats folded into repeated groups.  Pages that it doesn't match are aligned with it: tokens on one side only become
optional groups, tokens of both sides at one place two optional groups, and repeats are folded again.  Once all pages of
a group are met, their tokens are read off by the wrapper; pages that it doesn't match get a further one.  A text that
stands in the same slot of the wrapper on every page that has the slot (ALIKE different pages at least) belongs to the
template and is left out; the other texts are the data.  Of these the main region (article or main, else the container
of most data) is kept without menus, headers, footers, sidebars, notices, adverts, forms and reader comments.  Where
nothing varies, as on a host of one page, all texts are data.

Hosts are gathered by a shuffle on (host, salt), with a salt above 0 only for hosts of over PORTION pages, which are
dealt into portions by page_id and url; so no host is one task's, and the result doesn't depend on input partitions.

Defined cases: null or empty html gives ''.  A null url is a host of its own, ''.  Markup that is cut off ends at the
end of the page.  Rows may repeat; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Pages that a host has before it is dealt into portions of about as many, and different pages that show a template's text.
PORTION, ALIKE = 200, 3

#: Fixed values of HTML: elements whose content is no markup, that have no content, and that don't break a block.
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "textarea", "select", "object", "canvas", "audio", "video", "annotation", "annotation-xml"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "ruby", "rp", "rt", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "br", "wbr", "img", "math", "semantics", "mi", "mn", "mo", "ms", "mtext", "mrow", "mfrac", "msqrt", "mroot", "msub", "msup", "msubsup", "munder", "mover", "munderover", "mspace", "mstyle"}
CHROME_TAGS = {"nav", "header", "footer", "aside", "form", "head", "title", "button", "dialog", "menu", "fieldset"}
#: Class names and ids that name a block as chrome, alone or with words for a container on either side.  An ambiguous word
#: ("related-work", "more-about", "tags-explained") names nothing, and paragraphs and headings are never chrome by their class.
CHROME_NAMES = {
    *("ad ads advert adverts advertisement advertising adbox adslot sponsor sponsored promo banner".split()),
    *("comment comments replies disqus".split()),
    *("sidebar aside widget widgets".split()),
    *("menu nav navbar navigation breadcrumb breadcrumbs pagination pager toc".split()),
    *("cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe signup login".split()),
    *("footer masthead topbar toolbar share sharing social".split()),
}
CONTAINER_WORDS = set("area bar block bottom box buttons container content form header inner left links list main message module page panel primary right secondary section site slot thread title top unit user wrap wrapper".split())
TEXT_BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "figcaption", "dd", "dt", "td", "th"}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu"}
MAIN_TAGS, MAIN_ROLES = {"article", "main"}, {"main", "article"}
#: A start tag of the key closes an open element of the value.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
P_ENDERS = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "pre", "section", "table", "ul"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>?|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPACES = re.compile(r"\s+")


def chrome(tag: str, names: tuple[str, ...], role: str, within_main: bool) -> bool:
    if tag in CHROME_TAGS and not (tag == "header" and within_main):
        return True
    if tag in ("html", "body", *MAIN_TAGS):
        return False
    if role in CHROME_ROLES:
        return True
    if tag in TEXT_BLOCKS:
        return False
    for n in names:
        parts = [w for w in re.split(r"[^a-z]+", n) if w]
        if any(w in CHROME_NAMES for w in parts) and all(w in CHROME_NAMES or w in CONTAINER_WORDS for w in parts):
            return True
    return False


def stream(page: str) -> tuple[list[str], list[str]]:
    """Labels of a page's tokens, and the text of each ('' for tags).  A text's label starts with + if it may be kept."""
    labels, texts = [], []
    stack: list[tuple[str, str, bool, bool]] = []  # tag, label, chrome, main
    at, size, pending = 0, len(page), []

    def text_ends():
        if pending:
            text = _SPACES.sub(" ", entities.unescape("".join(pending))).strip()
            pending.clear()
            if text:
                top = stack[-1] if stack else ("", "", False, False)
                labels.append(("-" if top[2] else "+") + ("m" if top[3] else "b") + top[1])
                texts.append(text)

    def close(k):
        text_ends()
        while len(stack) > k:
            labels.append("/" + stack.pop()[1])
            texts.append("")

    while at < size:
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m.group(2)
        if tag is None:
            if page[m.start()] != "<" or m.group() == "<":
                pending.append(m.group())
            continue
        tag = tag.lower()
        if m.group(1):
            if tag in INLINE:
                continue
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if k is not None:
                close(k)
            elif tag == "p":
                text_ends()
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>?", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag in INLINE:
            if tag == "br":
                pending.append(" ")
            continue
        text_ends()
        if tag in VOID:
            continue
        shut = CLOSES.get(tag, set()) | ({"p"} if tag in P_ENDERS else set())
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in shut:
                close(k)
                break
            if stack[k][0] in ("ul", "ol", "table", "dl", "body", "article", "main", "section", "div"):
                break
        names, role = [], ""
        for name, *values in _ATTRIBUTE.findall(m.group(3)):
            value = "".join(values).lower()
            if name.lower() == "role":
                role = value
            elif name.lower() != "hidden":
                names += value.split()
        above = stack[-1] if stack else ("", "", False, False)
        label = tag + "".join(f".{re.sub('[0-9]+', '0', n)}" for n in names[:2])
        main = above[3] or tag in MAIN_TAGS or role in MAIN_ROLES
        stack.append((tag, label, above[2] or chrome(tag, tuple(names), role, above[3]), main))
        labels.append(label)
        texts.append("")
    close(0)
    return labels, texts


#: Code points that stand for labels in a wrapper's regular expression; pages with more kinds of tokens get another wrapper.
FIRST_SYMBOL, SYMBOLS = 0x10000, 0x100000


# A wrapper is a tuple of items: a label, ("?", items) or ("+", items).


def fold(items: tuple) -> tuple:
    """Replace tandem repeats by repeated groups, shorter periods first.

    The periods tried are the distances at which some item comes again, so no length of a repeated part is left out.
    """
    names: dict = {}
    codes = np.array([names.setdefault(x, len(names)) for x in items], np.int64)
    period = 0
    while True:
        order = np.argsort(codes, kind="stable")
        gaps = np.diff(order)[codes[order][1:] == codes[order][:-1]]
        more = gaps[gaps > period]
        if not len(more) or 2 * more.min() > len(codes):
            return items
        period = int(more.min())
        same = codes[period:] == codes[:-period]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
        if not (edge[1::2] - edge[::2] >= period).any():
            continue
        out, i = [], 0
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            a = max(a, i)
            k = (b - a) // period + 1
            if k < 2:
                continue
            body = items[a : a + period]
            out += items[i:a]
            out.append(body[0] if period == 1 and isinstance(body[0], tuple) and body[0][0] == "+" else ("+", body))
            i = a + k * period
        items = (*out, *items[i:])
        codes = np.array([names.setdefault(x, len(names)) for x in items], np.int64)


def bodies(items: tuple) -> set[tuple]:
    out = set()
    for x in items:
        if isinstance(x, tuple):
            out |= bodies(x[1]) | ({x[1]} if x[0] == "+" else set())
    return out


def fold_known(items: tuple, known: set[tuple]) -> tuple:
    """Single occurrences of groups that repeat elsewhere are repeated groups too."""
    for body in sorted(known, key=lambda b: (len(b), str(b))):
        out, i, n = [], 0, len(body)
        while i < len(items):
            if items[i : i + n] == body:
                if not (out and out[-1] == ("+", body)):
                    out.append(("+", body))
                i += n
            elif items[i] == ("+", body) and out and out[-1] == ("+", body):
                i += 1
            else:
                out.append(items[i])
                i += 1
        items = tuple(out)
    return items


def align(wrapper: tuple, page: tuple) -> tuple:
    """The least wrapper of this form that matches what either side does."""
    known = bodies(wrapper) | bodies(page)
    a, b = fold_known(wrapper, known), fold_known(page, known)
    bare = [x[1][0] if isinstance(x, tuple) and x[0] == "?" and len(x[1]) == 1 else x for x in a]
    out: list = []

    def optional(items):
        for x in items:
            out.append(x if isinstance(x, tuple) and x[0] == "?" else ("?", (x,)))

    i = k = 0
    for m in SequenceMatcher(None, bare, list(b), autojunk=False).get_matching_blocks():
        optional(a[i : m.a])
        optional(b[k : m.b])
        out += a[m.a : m.a + m.size]
        i, k = m.a + m.size, m.b + m.size
    merged: list = []
    for x in out:
        if merged and isinstance(x, tuple) and x[0] == "?" and x == merged[-1]:
            merged[-1] = ("?", (("+", x[1]),))
        else:
            merged.append(x)
    return tuple(merged)


class Wrapper:
    """The regular expression of one host, refined by pages that it doesn't match."""

    def __init__(self):
        self.items: tuple | None = None
        self.regex = None
        self.symbols: dict[str, str] = {}

    def written(self, labels: list[str]) -> str:
        return "".join([self.symbols.setdefault(x, chr(FIRST_SYMBOL + len(self.symbols))) for x in labels])

    def _pattern(self, items: tuple) -> str:
        out = []
        for x in items:
            if isinstance(x, str):
                out.append(self.written([x]))
            else:
                # atomic: a group takes what it can, as the alignment did; matching stays linear
                out.append(f"(?>(?:{self._pattern(x[1])}){x[0]})")
        return "".join(out)

    def refine(self, labels: list[str]) -> None:
        page, first = fold(tuple(labels)), self.items is None
        page = fold_known(page, bodies(page))
        self.items = page if first else align(self.items, page)
        self.regex = re.compile(self._pattern(self.items))
        if first and not self.matches(labels):  # a group takes what stands behind it: the page itself, then
            self.items = tuple(labels)
            self.regex = re.compile(self._pattern(self.items))

    def room(self, labels: list[str]) -> bool:
        """Whether the labels can all be named."""
        return len(self.symbols) + len(set(labels).difference(self.symbols)) <= SYMBOLS

    def matches(self, labels: list[str]) -> bool:
        return self.regex is not None and self.room(labels) and self.regex.fullmatch(self.written(labels)) is not None and self.slots(labels) is not None

    def meet(self, labels: list[str]) -> None:
        """Refine until the page matches; where alignment and atomic groups disagree, stay as it was."""
        if not self.room(labels):
            return
        before = self.items, self.regex
        for _ in range(3):
            if self.matches(labels):
                return
            self.refine(labels)
        if not self.matches(labels):
            self.items, self.regex = before

    def slots(self, labels: list[str]) -> list[int] | None:
        """The place in the wrapper of every token of a page, if each group takes what it can; repeats share their places."""
        out = [0] * len(labels)

        def walk(items, base, at):
            for x in items:
                if isinstance(x, str):
                    if at == len(labels) or labels[at] != x:
                        return -1
                    out[at] = base
                    at, base = at + 1, base + 1
                    continue
                to, times = walk(x[1], base, at), 0
                while to >= 0:
                    moved, at, times = to > at, to, times + 1
                    to = walk(x[1], base, at) if x[0] == "+" and moved else -1
                if x[0] == "+" and not times:
                    return -1
                base += width(x[1])
            return at

        return out if walk(self.items, 0, 0) == len(labels) else None


def width(items: tuple) -> int:
    """Tokens that a wrapper names."""
    return sum(1 if isinstance(x, str) else width(x[1]) for x in items)


def region(labels: list[str], texts: list[str]) -> list[str]:
    """Texts of the slots that are the main text: in article or main, else in the container with most text."""
    kept = [i for i, x in enumerate(labels) if x[0] == "+" and x[1] == "m" and texts[i]]
    if kept:
        return [texts[i] for i in kept]
    kept = [i for i, x in enumerate(labels) if x[0] == "+" and texts[i]]
    if not kept:
        return []
    opens, within, stack = {}, {}, []
    for i, x in enumerate(labels):
        if texts[i]:
            if x[0] == "+":
                for depth, o in enumerate(reversed(stack)):
                    within[o] = within.get(o, 0) + len(texts[i]) * 0.7**depth
        elif x[0] == "/":
            if stack:
                opens[stack.pop()] = i
        else:
            stack.append(i)
    if not within:
        return [texts[i] for i in kept]
    best = max(within, key=lambda o: (within[o], -o))
    while labels[best].split(".")[0] in ("p", "li", "h1", "h2", "h3", "td", "blockquote"):  # a block, not a container
        around = [o for o in within if o < best and opens.get(o, len(labels)) > opens.get(best, best)]
        if not around:
            break
        best = max(around)
    return [texts[i] for i in kept if best < i < opens.get(best, len(labels))]


def varying(wrapper: Wrapper, pages: list[tuple[list[str], list[str]]]) -> list[list[str]]:
    """Texts of pages that the wrapper matches, with '' for those of its template."""
    having, alike, read = Counter(), Counter(), []
    met = set()
    for labels, texts in pages:
        own = wrapper.slots(labels)
        read.append(own)
        if tuple(texts) not in met:  # copies of a page show nothing
            met.add(tuple(texts))
            having.update({s for s, t in zip(own, texts, strict=True) if t})
            alike.update({(s, t) for s, t in zip(own, texts, strict=True) if t})
    return [["" if having[s] >= ALIKE and alike[s, t] == having[s] else t for s, t in zip(own, texts, strict=True)] for own, (_, texts) in zip(read, pages, strict=True)]


def extract(pages: list[str | None]) -> list[str]:
    """Main texts of a host's pages."""
    streams = [stream(p or "") for p in pages]
    out = [""] * len(pages)
    rest = [i for i, (_, texts) in enumerate(streams) if any(texts)]
    for i in [i for i in rest if len(set(streams[i][0])) > SYMBOLS]:  # more kinds of tokens than a regular expression can name
        out[i] = "\n".join(region(*streams[i]))
        rest.remove(i)
    while rest:
        wrapper = Wrapper()
        for i in rest:
            wrapper.meet(streams[i][0])
        own = [i for i in rest if wrapper.matches(streams[i][0])]
        if not own:  # refined away from all that it met
            own = rest[:1]
            wrapper = Wrapper()
            wrapper.refine(streams[own[0]][0])
        for i, texts in zip(own, varying(wrapper, [streams[i] for i in own]), strict=True):
            out[i] = "\n".join(region(streams[i][0], texts) or region(*streams[i]))
        done = set(own)
        rest = [i for i in rest if i not in done]
    return out


def _pages(batches):
    names = ["page_id", "url", "text", "n_chars"]

    def done(rows):
        texts = extract([r[4] for r in rows])
        return pa.RecordBatch.from_arrays([pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names)

    group: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
            if group and group[0][:2] != row[:2]:
                yield done(group)
                group = []
            group.append(row)
    if group:
        yield done(group)


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of pages (page_id, url, html)."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1))
    rows = small_batches(pages).select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), "html")
    large = pages.select(host.alias("large")).groupBy("large").agg(F.count("*").alias("n")).where(F.col("n") > PORTION)
    salt = F.coalesce(F.pmod(F.xxhash64("page_id", "url"), F.ceil(F.col("n") / PORTION)), F.lit(0))
    rows = rows.join(F.broadcast(large), F.col("host") == F.col("large"), "left").select("host", salt.alias("salt"), "page_id", "url", "html")
    rows = rows.repartition("host", "salt").sortWithinPartitions("host", "salt", "page_id", "url", F.xxhash64("html"))
    return rows.mapInArrow(_pages, "page_id long, url string, text string, n_chars long")
