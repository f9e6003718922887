"""URL functions on string columns.

URLs are split with one regular expression: ``java.net.URI`` (behind Spark's
``parse_url``) refuses characters that browsers accept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagetables.functions.arrays import let

_URL = r"^\s*([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"
#: URLs of printable ASCII are cut at their marks, which costs much less than a pattern with groups.
_PLAIN = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[!-~]*\z"
_HTTP = r"^(?i)https?://[^\s/?#]+([/?#]\S*)?$"


def split_url(url: Column) -> Column:
    """URL -> struct(scheme, host, path, query, fragment), NULL when not absolute.

    Query and fragment keep their ``?`` and ``#``; an empty path is ``/``.
    """

    def part(u: Column, group: int) -> Column:
        return F.regexp_extract(u, _URL, group)

    def after(whole: Column, head: Column) -> Column:
        return F.substr(whole, F.length(head) + 1)

    def cut_up(u: Column) -> Column:
        def parts(rest: Column, shown: Column, place: Column, host: Column) -> Column:
            return F.struct(
                F.lower(F.substring_index(u, ":", 1)).alias("scheme"),
                F.lower(host).alias("host"),
                F.when(place == host, F.lit("/")).otherwise(after(place, host)).alias("path"),
                after(shown, place).alias("query"),
                after(rest, shown).alias("fragment"),
            )

        return let(F.substr(u, F.instr(u, F.lit("://")) + 3), lambda rest: let(
            F.substring_index(rest, "#", 1), lambda shown: let(
                F.substring_index(shown, "?", 1), lambda place: let(
                    F.substring_index(place, "/", 1), lambda host: parts(rest, shown, place, host)))))

    return let(url, lambda u: F.when(u.rlike(_PLAIN), cut_up(u)).when(u.rlike(_URL), F.struct(
        F.lower(part(u, 1)).alias("scheme"),
        F.lower(part(u, 2)).alias("host"),
        let(part(u, 3), lambda p: F.when(p == "", F.lit("/")).otherwise(p)).alias("path"),
        part(u, 4).alias("query"),
        part(u, 5).alias("fragment"),
    )))


def _site(parts: Column) -> Column:
    """Scheme and host; the scheme's own port is left out."""
    site = F.concat(parts["scheme"], F.lit("://"), parts["host"])
    short = F.regexp_replace(site, r"^(?:(http://.*):80|(https://.*):443|(.*):)$", "$1$2$3")
    return F.when(parts["host"].contains(":"), short).otherwise(site)


def is_url(url: Column) -> Column:
    """Is this an absolute URL? NULL stays NULL."""
    return url.rlike(_URL)


def is_http_url(url: Column) -> Column:
    return url.rlike(_HTTP)


def host_of(url: Column) -> Column:
    """Host name without user info and port, lowercased."""
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _decode(text: Column) -> Column:
    return let(text, lambda t: F.coalesce(F.try_url_decode(t), t))


def _params(query: Column) -> Column:
    """Query -> array<struct(name, pos, value)>, decoded, in order."""
    items = F.filter(F.split(F.ltrim(query, F.lit("?")), "&"), lambda p: p != "")
    return F.transform(
        items,
        lambda p, i: F.struct(
            _decode(F.substring_index(p, "=", 1)).alias("name"),
            i.alias("pos"),
            _decode(F.regexp_extract(p, r"(?s)^[^=]*=(.*)$", 1)).alias("value"),
        ),
    )


def params_of(url: Column) -> Column:
    """Query parameters of a URL, decoded and in order."""
    return _params(split_url(url)["query"])


def _serialise(params: Column) -> Column:
    text = F.array_join(
        F.transform(
            params,
            lambda p: F.concat(F.url_encode(p["name"]), F.lit("="), F.url_encode(p["value"])),
        ),
        "&",
    )
    return let(text, lambda t: F.when(t == "", t).otherwise(F.concat(F.lit("?"), t)))


def _rewrite(url: Column, change: Callable[[Column], Column], fragment: bool = True, adds: bool = False) -> Column:
    """The URL with its parameters changed; NULL when it is no absolute URL.

    ``adds`` says that ``change`` may make parameters where there are none.
    """
    def query(u: Column) -> Column:
        changed = _serialise(change(_params(u["query"])))
        return changed if adds else F.when(u["query"] == "", F.lit("")).otherwise(changed)

    return let(split_url(url), lambda u: F.concat(
        _site(u), u["path"], query(u), u["fragment"] if fragment else F.lit(""),
    ))


def sort_url(url: Column) -> Column:
    """Query parameters sorted by name; repeated names keep their order."""
    return _rewrite(url, F.sort_array)


def equal_urls(a: Column, b: Column) -> Column:
    """Same URL up to the order of query parameters?"""
    return sort_url(a) == sort_url(b)


def url_key(url: Column) -> Column:
    """Join and dedupe key: the sorted form without the fragment.

    Text that is no absolute URL is its own key, so its rows are not lost.
    """
    return let(url, lambda u: F.coalesce(_rewrite(u, F.sort_array, fragment=False), u))


def get_query_param(url: Column, name: str) -> Column:
    """First value of a parameter, NULL when missing."""
    return F.get(F.filter(params_of(url), lambda p: p["name"] == name), F.lit(0))["value"]


def _set(params: Column, name: str, value: Column) -> Column:
    def change(ps: Column, first: Column) -> Column:
        replaced = F.transform(
            F.filter(ps, lambda p: (p["name"] != name) | (p["pos"] == first)),
            lambda p, i: F.struct(
                p["name"].alias("name"),
                i.alias("pos"),
                F.when(p["name"] == name, value).otherwise(p["value"]).alias("value"),
            ),
        )
        added = F.struct(
            F.lit(name).alias("name"), F.size(ps).alias("pos"), value.alias("value")
        )
        return F.when(first >= 0, replaced).otherwise(F.concat(ps, F.array(added)))

    return let(params, lambda ps: let(
        F.array_position(F.transform(ps, lambda p: p["name"]), name) - 1,
        lambda first: change(ps, first),
    ))


def set_query_params(url: Column, values: dict[str, Column]) -> Column:
    """Set parameters: the first occurrence is replaced and repeats are dropped."""

    def change(params: Column) -> Column:
        for name, value in values.items():
            params = _set(params, name, value.cast("string"))
        return params

    return _rewrite(url, change, adds=True)


def set_query_param(url: Column, name: str, value: Column) -> Column:
    return set_query_params(url, {name: value})


def drop_query_param(url: Column, name: str) -> Column:
    return _rewrite(url, lambda params: F.filter(params, lambda p: p["name"] != name))


def _remove_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` path segments."""

    def step(out: Column, s: Column) -> Column:
        return (
            F.when(s == ".", out)
            .when(s == "..", F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(1))))
            .otherwise(F.concat(out, F.array(s)))
        )

    def resolved(p: Column) -> Column:
        parts = F.split(p, "/")
        kept = F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), F.array(F.lit("")), step)
        # a trailing dot segment names a directory
        tail = F.when(p.rlike(r"/\.\.?$"), F.lit("/")).otherwise(F.lit(""))
        return F.concat(F.array_join(kept, "/"), tail)

    return let(path, lambda p: F.when(p.contains("/."), resolved(p)).otherwise(p))


def resolve_against(base: Column, ref: Column, keep_base_query: bool = False) -> Column:
    """Absolute form of a link on the page whose ``split_url`` is ``base`` (RFC 3986).

    With ``keep_base_query`` a link without a query of its own inherits the
    page's query and fragment, see ``resolve_url_path``.
    """

    def rest(r: Column) -> Column:
        own = F.regexp_extract(r, r"^[^?#]*(.*)$", 1)
        if not keep_base_query:
            return own
        inherited = F.concat(base["query"], base["fragment"])
        return let(own, lambda o: F.when(o == "", inherited).otherwise(o))

    def absolute(r: Column) -> Column:
        here = F.concat(_site(base), base["path"])
        folder = F.regexp_extract(base["path"], r"^(.*/)", 1)
        path = F.regexp_extract(r, r"^([^?#]*)", 1)
        rooted = F.when(r.startswith("/"), path).otherwise(F.concat(folder, path))
        # a mere path, as most links are, needs no pattern
        mere = r.startswith("/") & ~r.startswith("//") & ~r.contains("?") & ~r.contains("#") & ~r.contains("/.")
        return (
            F.when(F.lit(not keep_base_query) & mere, F.concat(_site(base), r))
            .when(r.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), r)
            .when(r.startswith("//"), F.concat(base["scheme"], F.lit(":"), r))
            .when(r.startswith("?"), F.concat(here, r))
            .when((r == "") | r.startswith("#"), F.concat(here, base["query"], r))
            .otherwise(F.concat(_site(base), _remove_dots(rooted), rest(r)))
        )

    return let(F.trim(ref), lambda r: F.when(r.isNotNull(), absolute(r)))


def resolve_url(base: Column, ref: Column, keep_base_query: bool = False) -> Column:
    """Absolute form of a link found on page ``base``."""
    return let(split_url(base), lambda b: resolve_against(b, ref, keep_base_query))


def resolve_url_path(base: Column, path: Column) -> Column:
    """Put ``path`` in place of the path of ``base``; query and fragment stay."""
    rooted = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    return let(
        split_url(base), lambda b: F.concat(_site(b), rooted, b["query"], b["fragment"])
    )
