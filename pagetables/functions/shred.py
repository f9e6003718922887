"""HTML text -> array of elements, the only Python function in the engine.

A page is tokenised with one regular expression and written straight into flat
Arrow columns, one set per batch; no per-page Python objects reach Spark. The
tree rules are the part of the HTML standard that real pages lean on: void
elements, implied end tags, raw text, and unclosed inline elements ending with
their block. Script and style text is not page text and is left out.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from pagetables.schemas import NODES

# executors get the function itself and need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|</([a-zA-Z][^\s/>]*+)[^>]*+>"
    r"|<([a-zA-Z][^\s/>]*+)"
    r"((?:[\s/]++|=|[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+))?+)*+)>"
    r"|<[!?/][^>]*+>",
    re.S,
)
_ATTR = re.compile(
    r"([^\s/>=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"'][^\s>]*+)))?+"
)
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_RAW = {
    t: re.compile(rf"</{t}(?=[\s/>])", re.I)
    for t in "script style title textarea xmp iframe noembed noframes".split()
}
_NO_TEXT = frozenset(["script", "style"])
_ENTITY_TEXT = frozenset(["title", "textarea"])
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_TABLE_SCOPE = frozenset("#root table template".split())
_SCOPE = _TABLE_SCOPE | frozenset("td th caption marquee object applet".split())
_ENDS_P = _HEADINGS | frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset"
    " figcaption figure footer form header hgroup hr li listing main menu nav ol p pre"
    " section summary table ul".split()
)
_SPECIAL = _ENDS_P | _SCOPE | frozenset(
    "body button col colgroup frameset head html iframe select tbody textarea tfoot"
    " thead tr".split()
)
_LIST_STOP = _SPECIAL - frozenset(["address", "div", "p"])
_ROWS = frozenset("tbody thead tfoot".split())
# start tag -> (open elements it ends, elements the search stops at)
_ENDS = {
    "li": (frozenset(["li"]), _LIST_STOP),
    "dt": (frozenset(["dt", "dd"]), _LIST_STOP),
    "dd": (frozenset(["dt", "dd"]), _LIST_STOP),
    "tr": (frozenset(["tr"]), _TABLE_SCOPE | _ROWS),
    "td": (frozenset(["td", "th"]), _TABLE_SCOPE | _ROWS | {"tr"}),
    "th": (frozenset(["td", "th"]), _TABLE_SCOPE | _ROWS | {"tr"}),
    "tbody": (_ROWS, _TABLE_SCOPE),
    "thead": (_ROWS, _TABLE_SCOPE),
    "tfoot": (_ROWS, _TABLE_SCOPE),
    "option": (frozenset(["option"]), _SPECIAL),
    "optgroup": (frozenset(["option", "optgroup"]), _SPECIAL),
    "a": (frozenset(["a"]), _SPECIAL),
    "button": (frozenset(["button"]), _SCOPE),
    "body": (frozenset(["head"]), _SCOPE),
}
_P = frozenset(["p"])
_P_STOP = _SCOPE | {"button"}
_ONCE = frozenset(["html", "head", "body"])
_STAYS = frozenset(["html", "body"])  # open until the page ends, whatever the end tags say
_OWN_END = _STAYS | {"#root"}  # open elements that no end tag of their name ends at once
#: Tags that are read alike whatever follows them.
_PLAIN = re.compile(r"</[a-zA-Z][a-zA-Z0-9]*>|<[a-zA-Z][a-zA-Z0-9]*(?: [a-zA-Z-]+=\"[^\"<>]*\")*>")
_KNOWN = 2048  # plain tags that are remembered as read: most tags of a site repeat
_SHORT = 80  # longest of them
_NO_ATTRIBUTES: tuple = ((), (), None, "")


def _attributes(found: str) -> tuple:
    """Names, values, id and classes of a start tag's attributes; of a name that repeats the first counts."""
    keys, values, own = [], [], set()
    el_id, classes = None, ""
    for key, quoted, single, bare in _ATTR.findall(found):
        key = key.lower()
        if key in own:
            continue
        own.add(key)
        value = quoted or single or bare
        if "&" in value:
            value = unescape(value)
        keys.append(key)
        values.append(value)
        if key == "class":
            classes = f" {' '.join(value.split())} "
        elif key == "id":
            el_id = value
    return keys, values, el_id, classes


class _Columns:
    """Flat columns of all elements of one batch of pages.

    One long method on purpose: it runs once per tag, so the columns are bound
    to local names and nothing is called that need not be.
    """

    def __init__(self, known: dict[str, tuple] | None = None) -> None:
        self.known = {} if known is None else known
        self.id, self.last, self.parent, self.nth = (array("i") for _ in range(4))
        self.attr_at, self.page_at = array("i", [0]), array("i", [0])
        self.tag, self.el_id, self.classes, self.text, self.tail = [], [], [], [], []
        self.keys, self.values = [], []

    def add_page(self, html: str) -> None:
        tags, texts, tails = self.tag, self.text, self.tail
        keys, values, last = self.keys, self.values, self.last
        match, known = _TOKEN.match, self.known
        base = len(tags)
        add_tag, add_text, add_tail, add_last = tags.append, texts.append, tails.append, last.append
        add_parent, add_nth, add_attr_at = self.parent.append, self.nth.append, self.attr_at.append
        add_el_id, add_classes = self.el_id.append, self.classes.append
        names: list[str] = []  # open elements, outermost first
        ids = array("i")
        kids: list[int] = []
        once: set[str] = set()
        opened: dict[str, int] = {}  # how many of each name are open: most searches end here, however deep the page

        def close(depth: int) -> None:
            end = len(tags) - base - 1
            for node in ids[depth:]:
                last[base + node] = end
            for closed in names[depth:]:
                opened[closed] -= 1
            del names[depth:], ids[depth:], kids[depth:]

        def find_open(targets, stop) -> int:
            if not any(map(opened.get, targets)):
                return 0
            for depth in range(len(names) - 1, 0, -1):
                if names[depth] in targets:
                    return depth
                if names[depth] in stop:
                    return 0
            return 0

        pos, size = 0, len(html)
        last_end = html.rfind(">")  # no tag ends after it
        name, read = "#root", _NO_ATTRIBUTES
        leaf = False
        # where the next text goes: `text` of an open element or `tail` of a closed one
        at, into = base, texts
        while True:
            if name:
                at = len(tags)
                node = at - base
                add_last(node)
                add_tag(name)
                add_text("")
                add_tail("")
                if ids:
                    nth = kids[-1] = kids[-1] + 1
                    add_parent(ids[-1])
                    add_nth(nth)
                else:
                    add_parent(-1)
                    add_nth(1)
                own_keys, own_values, el_id, classes = read
                if own_keys:
                    keys += own_keys
                    values += own_values
                add_el_id(el_id)
                add_classes(classes)
                add_attr_at(len(keys))
                if name in _VOID or leaf:
                    into, leaf = tails, False
                elif name in _RAW:
                    end = _RAW[name].search(html, pos)
                    stop_at = end.start() if end else size
                    if name not in _NO_TEXT:
                        piece = html[pos:stop_at]
                        texts[at] = unescape(piece) if name in _ENTITY_TEXT else piece
                    gt = html.find(">", stop_at)
                    pos = gt + 1 if gt >= 0 else size
                    into = tails
                else:
                    names.append(name)
                    opened[name] = opened.get(name, 0) + 1
                    ids.append(node)
                    kids.append(0)
                    into = texts
                name = ""
            if pos >= size:
                break
            lt = html.find("<", pos)
            if lt != pos:
                piece = html[pos:lt] if lt > 0 else html[pos:]
                into[at] += unescape(piece) if "&" in piece else piece
                if lt < 0:
                    break
            if lt > last_end and not html.startswith("<!--", lt):
                rest = html[lt:]
                into[at] += unescape(rest) if "&" in rest else rest
                break
            gt = html.find(">", lt, lt + _SHORT)
            token = known.get(html[lt : gt + 1])
            if token:
                pos = gt + 1
                ended, started, read = token
            else:
                m = match(html, lt)
                if m is None:
                    into[at] += "<"
                    pos = lt + 1
                    continue
                pos = m.end()
                ended, started, found = m.groups()
                read = _NO_ATTRIBUTES
                if ended:
                    ended = ended.lower()
                elif started:
                    started = started.lower()
                    if found:
                        read = _attributes(found)
                if pos == gt + 1 and len(known) < _KNOWN and _PLAIN.fullmatch(html, lt, pos):
                    known[html[lt:pos]] = ended, started, read
            if ended and ended == names[-1] and ended not in _OWN_END:
                # the innermost element ends, as nearly always
                names.pop()
                kids.pop()
                node = ids.pop()
                opened[ended] -= 1
                last[base + node] = len(tags) - base - 1
                at, into = base + node, tails
            elif started:
                if started in _ONCE:
                    if started in once:
                        continue
                    once.add(started)
                if started in _ENDS:
                    depth = find_open(*_ENDS[started])
                    if depth:
                        close(depth)
                if started in _ENDS_P:
                    if opened.get("p"):
                        depth = find_open(_P, _P_STOP)
                        if depth:
                            close(depth)
                    if started in _HEADINGS and names[-1] in _HEADINGS:
                        close(len(names) - 1)
                name = started
            elif ended:
                if ended in _STAYS:
                    continue
                elif ended in _HEADINGS:
                    depth = find_open(_HEADINGS, _SCOPE)
                elif ended == "p":
                    depth = find_open(_P, _P_STOP)
                    if not depth:
                        # a lone end tag makes an empty paragraph
                        name, read, leaf = "p", _NO_ATTRIBUTES, True
                        continue
                elif ended == "li":
                    depth = find_open({"li"}, _SCOPE | {"ul", "ol"})
                elif ended in ("td", "th", "tr", "table") or ended in _ROWS:
                    depth = find_open({ended}, _TABLE_SCOPE - {ended})
                else:
                    depth = find_open({ended}, _SCOPE if ended in _SPECIAL else _SPECIAL)
                if depth:
                    at, into = base + ids[depth], tails
                    close(depth)
        close(0)
        self.id.extend(range(len(tags) - base))

    def to_arrow(self) -> pa.Array:
        i32, txt = pa.int32(), pa.string()

        def ints(values: array) -> pa.Array:
            return pa.Array.from_buffers(i32, len(values), [None, pa.py_buffer(values)])

        node = pa.StructArray.from_arrays(
            [
                ints(self.id),
                ints(self.last),
                ints(self.parent),
                ints(self.nth),
                pa.array(self.tag, txt),
                pa.array(self.el_id, txt),
                pa.array(self.classes, txt),
                pa.MapArray.from_arrays(
                    ints(self.attr_at), pa.array(self.keys, txt), pa.array(self.values, txt)
                ),
                pa.array(self.text, txt),
                pa.array(self.tail, txt),
            ],
            names=[f.name for f in NODES.elementType.fields],
        )
        return pa.ListArray.from_arrays(ints(self.page_at), node)


#: Elements after which the pages parsed so far go back to Spark: both sides hold no more than these and one page.
_PIECE = 1 << 15


def shred_batches(batches: Iterator[pa.Array], piece: int = _PIECE) -> Iterator[pa.Array]:
    """Pages in batches as Spark sends them -> their elements, in smaller batches bounded by elements and not by pages.

    A missing page gives an empty array, so every selector finds nothing in it.
    """
    known: dict[str, tuple] = {}
    for html in batches:
        columns = _Columns(known)
        for page in html:
            text = page.as_py()
            if text is not None:
                columns.add_page(text)
            columns.page_at.append(len(columns.tag))
            if len(columns.tag) >= piece:
                yield columns.to_arrow()
                columns = _Columns(known)
        if len(columns.page_at) > 1:
            yield columns.to_arrow()


def shred_batch(html: pa.Array) -> pa.Array:
    """One batch as a whole."""
    found = list(shred_batches(iter([html]), sys.maxsize))
    return found[0] if found else _Columns().to_arrow()


def shred_html(html: Column) -> Column:
    """``html`` -> ``array<element>``.

    Marked non-deterministic so that Catalyst keeps one evaluation however many
    filters and selectors sit on top. Filters on other columns must therefore be
    applied before this call; the plans do so.
    """

    def shred(html: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return shred_batches(html)

    return F.arrow_udf(shred, NODES).asNondeterministic()(html)
