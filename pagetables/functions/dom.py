"""CSS selection over the columnar DOM, as Spark column expressions.

A selector becomes a predicate per element, evaluated with ``filter`` over the
page's array in the JVM. Ancestors are found by position: an element is below another
if its place lies in the other's span. What the part of a selector before a blank matches
is reduced to its outermost spans, in one sweep, and each candidate looks itself up
among them; so the work grows with the page and not with its depth. Selection never shuffles.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagetables.functions.arrays import drop_empty, let, outermost, span, within_spans
from pagetables.functions.text import trim_to_null

_PART = re.compile(
    r"""\s*(?P<child>>)?\s*(?P<compound>(?:[\w*-]+|\#[\w-]+|\.[\w-]+|\[[^\]]*\]|:not\((?:\[[^\]]*\]|[^)])*\)|:nth-child\(\d+\))+)"""
)
_SIMPLE = re.compile(
    r"""(?P<tag>^[\w*-]+)|\#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)"""
    r"""|\[(?P<attr>[\w-]+)(?:=["']?(?P<value>[^"'\]]*)["']?)?\]"""
    r"""|:not\((?P<neg>(?:\[[^\]]*\]|[^)])+)\)|:nth-child\((?P<nth>\d+)\)"""
)
# cheap tests first: the rest of the conjunction is skipped when one fails
_COST = {"tag": 0, "nth": 1, "id": 2, "cls": 3, "attr": 4, "neg": 5}


def _all(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests) if tests else F.lit(True)


def matches(node: Column, compound: str) -> Column:
    """Does one element match a compound selector such as ``a.x:not([b="c"])``?"""
    tests = []
    for m in _SIMPLE.finditer(compound):
        kind, value = m.lastgroup, m[m.lastgroup]
        if kind == "value":
            kind = "attr"
        if kind == "tag":
            if value == "*":
                continue
            test = node["tag"] == value.lower()
        elif kind == "nth":
            test = node["nth"] == int(value)
        elif kind == "id":
            test = node["el_id"].eqNullSafe(value)
        elif kind == "cls":
            test = node["classes"].contains(f" {value} ")
        elif kind == "attr":
            found = node["attrs"][m["attr"].lower()]
            test = found.isNotNull() if m["value"] is None else found.eqNullSafe(m["value"])
        else:
            test = ~matches(node, value)
        tests.append((_COST[kind], test))
    return _all([t for _, t in sorted(tests, key=lambda t: t[0])])


@cache
def steps(selector: str) -> tuple[tuple[str, ...], ...]:
    """A selector cut at its blanks; each step is a chain of compounds joined by ``>``."""
    found: list[list[str]] = []
    pos = 0
    while pos < len(selector.rstrip()):
        m = _PART.match(selector, pos)
        if m is None or (m["child"] and not found):
            raise ValueError(f"unsupported selector: {selector!r}")
        if m["child"]:
            found[-1].append(m["compound"])
        else:
            found.append([m["compound"]])
        pos = m.end()
    return tuple(map(tuple, found))


class Dom:
    """Selectors over one array column of elements. Elements are struct columns.

    With ``box``, an element column, selectors find its descendants only. That
    tests positions in place, which suits a box around most of the page;
    ``within`` reads a small subtree out first. As on the page, an ancestor that a selector
    names may lie outside of the box.
    """

    def __init__(self, nodes: Column | str, box: Column | None = None,
                 scopes: dict[tuple, Column] | None = None) -> None:
        self.nodes = F.col(nodes) if isinstance(nodes, str) else nodes
        self.box = box
        self.scopes = scopes or {}

    def root(self) -> Column:
        return F.get(self.nodes, F.lit(0))

    def inside(self, node: Column) -> Column:
        """All descendants of an element, in document order."""
        return let(node, lambda n: span(self.nodes, n["id"] + 1, n["last"]))

    def scoped(self, selectors: list[str], body: Callable[[Dom], Column]) -> Column:
        """``body`` with a Dom that knows the spans in which the last steps of ``selectors`` can match.

        They are found once per page, for selectors that ``body`` applies to many elements of it.
        """
        wanted = dict.fromkeys(s[:-1] for s in map(steps, selectors) if len(s) > 1)
        if not wanted:
            return body(self)
        names = {key: f"s{k}" for k, key in enumerate(wanted)}
        found = F.struct(*[self._spans(key).alias(name) for key, name in names.items()])
        return let(found, lambda f: body(
            Dom(self.nodes, self.box, self.scopes | {key: f[name] for key, name in names.items()})
        ))

    def _spans(self, parts: tuple) -> Column:
        """Outermost spans of the elements of the page that match."""
        def spans(test: Callable[[Column], Column]) -> Column:
            # the synthetic root is no element of the page
            found = F.filter(self.nodes, lambda n: test(n) & (n["id"] > 0))
            return outermost(F.transform(found, lambda n: F.struct(n["id"].alias("id"), n["last"].alias("last"))))

        return self._matching(parts, spans)

    def _matching(self, parts: tuple, body: Callable[[Callable[[Column], Column]], Column]) -> Column:
        """``body`` with the test of one element against all steps."""
        if len(parts) == 1:
            return body(lambda n: self._chain(n, parts[-1]))
        if parts[:-1] in self.scopes:
            spans = self.scopes[parts[:-1]]
            return body(lambda n: self._chain(n, parts[-1], spans))
        return let(self._spans(parts[:-1]), lambda spans: body(lambda n: self._chain(n, parts[-1], spans)))

    def _chain(self, node: Column, compounds: tuple[str, ...], spans: Column | None = None) -> Column:
        """Does an element match the last compound, its parent the one before and so on, and does the first lie in ``spans``?"""
        test, rest = matches(node, compounds[-1]), compounds[:-1]
        if rest:
            return test & (node["parent"] >= 0) & let(
                F.get(self.nodes, node["parent"]), lambda p: self._chain(p, rest, spans)
            )
        return test if spans is None else test & within_spans(node["id"], spans)

    def find_all(self, selector: str, within: Column | None = None,
                 among: Column | None = None) -> Column:
        """Matching descendants of ``within`` (default: the box or page), in document order.

        ``among`` is the array ``inside(within)`` when the caller has it at hand.
        """
        parts = steps(selector)
        if among is None and within is None and self.box is not None:
            first, last = self.box["id"], self.box["last"]
            return self._matching(parts, lambda test: F.filter(
                self.nodes, lambda n: test(n) & (n["id"] > first) & (n["id"] <= last)
            ))
        if among is None:
            among = self.nodes if within is None else self.inside(within)
        return self._matching(parts, lambda test: F.filter(among, lambda n: test(n) & (n["id"] > 0)))

    def find(self, selector: str, within: Column | None = None,
             among: Column | None = None) -> Column:
        """First match or NULL."""
        return F.get(self.find_all(selector, within, among), F.lit(0))

    def exists(self, selector: str) -> Column:
        return F.size(self.find_all(selector)) > 0

    def parent(self, node: Column) -> Column:
        return F.get(self.nodes, node["parent"])

    def children(self, node: Column) -> Column:
        return let(
            node, lambda e: F.filter(self.inside(e), lambda n: n["parent"] == e["id"])
        )

    def raw_text(self, node: Column, without: Column | None = None) -> Column:
        """Text of the subtree as it stands; ``without`` holds elements to leave out."""

        def joined(n: Column, piece: Callable[[Column], Column]) -> Column:
            below = F.array_join(F.transform(self.inside(n), piece), "")
            return F.when(n["last"] == n["id"], n["text"]).otherwise(F.concat(n["text"], below))

        def all_of(n: Column) -> Column:
            return F.concat(n["text"], n["tail"])

        if without is None:
            return let(node, lambda n: joined(n, all_of))

        def rest_of(n: Column, gone: Column) -> Column:
            inner = F.exists(gone, lambda w: (w["id"] < n["id"]) & (n["id"] <= w["last"]))
            same = F.exists(gone, lambda w: w["id"] == n["id"])
            return F.when(inner, F.lit("")).when(same, n["tail"]).otherwise(all_of(n))

        # missing elements are nothing to leave out
        gone = F.filter(without, lambda w: w.isNotNull())
        return let(node, lambda n: let(
            gone, lambda g: joined(n, lambda m: rest_of(m, g))
        ))

    def text(self, node: Column, without: Column | None = None) -> Column:
        """Trimmed subtree text, NULL when empty."""
        return trim_to_null(self.raw_text(node, without))

    def text_lower(self, node: Column, without: Column | None = None) -> Column:
        return F.lower(self.text(node, without))

    def texts(self, nodes: Column, lower: bool = False) -> Column:
        """Texts of many elements without the empty ones; never NULL."""
        one = self.text_lower if lower else self.text
        return drop_empty(F.transform(nodes, lambda n: one(n)))

    @staticmethod
    def attr(node: Column, name: str) -> Column:
        return node["attrs"][name]

