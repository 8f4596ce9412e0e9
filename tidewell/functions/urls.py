"""URL references as column expressions (RFC 3986): parts, resolution against a base, one form for equal URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions.arrays import let

# Groups: scheme, authority with and without its slashes, path, query with and without its mark.
URI = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?"
SCHEME, SLASHES, AUTHORITY, PATH, QUESTION = 1, 2, 3, 4, 5
DEFAULT_PORTS = {"http": "80", "https": "443"}


def part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, URI, group)


def without_dots(path: Column) -> Column:
    """``path`` without its ``.`` and ``..`` segments (RFC 3986, 5.2.4)."""
    return let(path, _without_dots)


def _without_dots(path: Column) -> Column:
    rooted = path.startswith("/")

    def of(segments: Column) -> Column:
        kept = F.aggregate(
            segments, F.array().cast("array<string>"),
            lambda acc, s: F.when(s == ".", acc).when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(
                F.concat(acc, F.array(s))))
        open_end = F.element_at(segments, -1).isin(".", "..")
        return let(kept, lambda k: F.concat(
            F.array_join(k, "/"), F.when(open_end & (F.size(k) > 0), "/").otherwise("")))

    plain = F.concat(F.when(rooted, "/").otherwise(""), let(F.split(F.when(rooted, F.substr(path, F.lit(2))).otherwise(path), "/"), of))
    return F.when(path.contains("/.") | path.startswith("."), plain).otherwise(path)


def resolve(reference: Column, base: Column) -> Column:
    """The URL that ``reference`` means in a document at the absolute URL ``base``, without its fragment."""
    return let(reference, lambda r: let(base, lambda b: _resolved(r, b)))


def _resolved(reference: Column, base: Column) -> Column:
    scheme, slashes, path, query = (part(reference, g) for g in (SCHEME, SLASHES, PATH, QUESTION))
    base_scheme, base_slashes, base_path = (part(base, g) for g in (SCHEME, SLASHES, PATH))
    home = F.concat(base_scheme, F.lit(":"), base_slashes)
    folder = F.when((base_slashes != "") & (base_path == ""), "/").otherwise(F.regexp_extract(base_path, "^(.*/)?", 0))
    return (
        F.when(scheme != "", F.concat(scheme, F.lit(":"), slashes, without_dots(path), query))
        .when(slashes != "", F.concat(base_scheme, F.lit(":"), slashes, without_dots(path), query))
        .when(path == "", F.concat(home, base_path, F.when(query != "", query).otherwise(part(base, QUESTION))))
        .when(path.startswith("/"), F.concat(home, without_dots(path), query))
        .otherwise(F.concat(home, without_dots(F.concat(folder, path)), query))
    )


def _capital_escapes(text: Column) -> Column:
    return F.array_join(F.transform(F.split(text, "%"), lambda s, i: F.when(i == 0, s).otherwise(
        F.concat(F.upper(F.substring(s, 1, 2)), F.substr(s, F.lit(3))))), "%")


def canonical(url: Column) -> Column:
    """One form for equal absolute URLs: lower-case scheme and host, no default port, no dots, no fragment, ``/`` for no path."""
    return let(url, _canonical)


def _canonical(url: Column) -> Column:
    scheme, authority = F.lower(part(url, SCHEME)), part(url, AUTHORITY)
    user, host = F.regexp_extract(authority, "^(.*@)?", 0), F.lower(F.regexp_extract(authority, "([^@]*)$", 1))
    named = F.regexp_replace(host, ":$", "")
    for name, port in DEFAULT_PORTS.items():
        named = F.when(scheme == name, F.regexp_replace(host, f":({port})?$", "")).otherwise(named)
    path = without_dots(part(url, PATH))
    path = F.when((part(url, SLASHES) != "") & (path == ""), "/").otherwise(path)
    head = F.when(part(url, SLASHES) != "", F.concat(scheme, F.lit("://"), user, named)).otherwise(F.concat(scheme, F.lit(":")))
    return F.concat(head, _capital_escapes(F.concat(path, part(url, QUESTION))))


def is_web(url: Column) -> Column:
    return part(url, SCHEME).isin("http", "https") & (part(url, AUTHORITY) != "")
