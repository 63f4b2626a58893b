"""URL parsing, resolution and seed clean-up as column expressions.

``try_parse_url`` follows the JVM's URI grammar, so an address with illegal characters gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlweave.functions.text import bind, trim_controls

# Length guard of a submitted seed and the scheme it gets when it has none.
MAX_SEED_LENGTH = 2048
DEFAULT_SCHEME = "https://"
WEB_SCHEMES = ("http", "https")

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
# groups: 1 scheme, 2 authority, 3 path, 4 query with its mark
_WEB = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?"
# group 1: host of a web address without user and port; of another address, which may have none
_WEB_HOST = r"(?i)^https?://(?:[^/?#]*@)?([^/?#:@\s<>|^\[\]]+|\[[0-9a-f:.]+\])(?::[0-9]*)?(?=[/?#]|$)"
_OTHER_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#]*@)?([^/?#:]*)"


def _part(url: Column, name: str) -> Column:
    return F.try_parse_url(url, F.lit(name))


def scheme(url: Column) -> Column:
    return _part(url, "PROTOCOL")


def host(url: Column) -> Column:
    return _part(url, "HOST")


def raw_path(url: Column) -> Column:
    return _part(url, "PATH")


def percent_decode(c: Column) -> Column:
    """Percent-decoding that keeps a literal plus sign."""
    return F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def path(url: Column) -> Column:
    return percent_decode(raw_path(url))


def base_url(url: Column) -> Column:
    """``scheme://authority`` with the port kept."""
    return F.concat(scheme(url), F.lit("://"), _part(url, "AUTHORITY"))


def export_host(url: Column) -> Column:
    return F.coalesce(host(url), F.lit(""))


def export_path(url: Column) -> Column:
    """Decoded path plus ``?`` and the decoded query; a bad address gives the empty string."""
    query = percent_decode(_part(url, "QUERY"))
    tail = F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")
    return F.coalesce(F.concat(path(url), F.coalesce(tail, F.lit(""))), F.lit(""))


def _encode_non_ascii(c: Column) -> Column:
    encoded = F.array_join(
        F.transform(F.split(c, ""), lambda ch: F.when(ch.rlike(r"[^\x00-\x7F]"), F.url_encode(ch)).otherwise(ch)),
        "",
    )
    return F.when(c.rlike(r"[^\x00-\x7F]"), encoded).otherwise(c)


def live_host(url: Column) -> Column:
    """Lower-case host as a browser sees it; an address that does not parse is its own host."""
    web_host = F.lower(F.regexp_extract(url, _WEB_HOST, 1))
    other_host = F.lower(F.regexp_extract(url, _OTHER_HOST, 1))
    return (
        F.when(url.rlike(_WEB_HOST), web_host)
        .when(url.rlike(_SCHEME) & ~url.rlike("(?i)^https?:"), other_host)
        .otherwise(url)
    )


def live_parts(url: Column) -> Column:
    """``struct(scheme, host, path)`` as a browser splits the address for the live table."""
    web = url.rlike(_WEB_HOST)
    ok = web | (url.rlike(_SCHEME) & ~url.rlike("(?i)^https?:"))
    local = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*:(?://[^/?#]*)?([^#]*)", 1)
    rooted = F.when(web & local.startswith("?"), F.concat(F.lit("/"), local)).otherwise(local)
    return F.struct(
        F.when(ok, F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))).otherwise("").alias("scheme"),
        live_host(url).alias("host"),
        F.when(ok & (rooted != "/"), _encode_non_ascii(rooted)).otherwise("").alias("path"),
    )


def _remove_dot_segments(p: Column) -> Column:
    """Collapse ``.`` and ``..`` in an absolute path; a trailing one leaves a directory."""

    def collapse(parts: Column) -> Column:
        kept = F.aggregate(
            parts,
            F.expr("cast(array() as array<string>)"),
            lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
            .when(s == ".", acc)
            .otherwise(F.concat(acc, F.array(s))),
        )
        open_end = F.element_at(parts, -1).isin(".", "..")
        return bind(
            kept,
            lambda k: F.concat(
                F.lit("/"), F.array_join(k, "/"), F.when(open_end & (F.size(k) > 0), "/").otherwise("")
            ),
        )

    return F.when(p.rlike(r"/\.\.?(/|$)"), bind(F.split(F.substr(p, F.lit(2)), "/"), collapse)).otherwise(p)


def _origin(address: Column) -> Column:
    return F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*", 0)


def _clean(origin: Column, local: Column) -> Column:
    """``origin`` followed by ``local`` with its path part cleaned."""
    path_part = F.regexp_extract(local, r"^[^?#]*", 0)
    rest = F.regexp_extract(local, r"^[^?#]*(.*)$", 1)
    return F.concat(origin, bind(path_part, _remove_dot_segments), rest)


def _clean_whole(address: Column) -> Column:
    local = F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(.*)$", 1)
    dotted = address.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://[^?#]*/\.\.?(/|[?#]|$)")
    return F.when(dotted, bind(local, lambda l: _clean(_origin(address), l))).otherwise(address)


def _resolve(base: Column, ref: Column) -> Column:
    base_path = F.regexp_extract(base, _WEB, 3)
    folder = F.when(base_path == "", "/").otherwise(F.regexp_replace(base_path, r"[^/]*$", ""))
    same_scheme = F.concat(F.regexp_extract(base, _WEB, 1), F.lit(":"), ref)
    found = (
        F.when(ref == "", base)
        .when(ref.rlike(_SCHEME), _clean_whole(ref))
        .when(ref.startswith("//"), bind(same_scheme, _clean_whole))
        .when(ref.startswith("/"), _clean(_origin(base), ref))
        .when(ref.startswith("?"), F.concat(_origin(base), base_path, ref))
        .when(ref.startswith("#"), F.concat(F.regexp_replace(base, r"#.*$", ""), ref))
        .otherwise(bind(F.concat(folder, ref), lambda l: _clean(_origin(base), l)))
    )
    return F.when(base.rlike(_WEB) | ref.rlike(_SCHEME), F.coalesce(found, F.lit(""))).otherwise("")


def absolutise(base: Column, href: Column) -> Column:
    """Resolve ``href`` against ``base``; an unresolvable pair gives the empty string."""
    pair = F.struct(F.coalesce(base, F.lit("")).alias("base"), F.coalesce(trim_controls(href), F.lit("")).alias("ref"))
    return bind(pair, lambda p: bind(_plain_web_scheme(p["base"], p["ref"]), lambda ref: _resolve(p["base"], ref)))


def _plain_web_scheme(base: Column, ref: Column) -> Column:
    """A web scheme in lower case; one without slashes that repeats the base's is left out."""
    name = F.lower(F.regexp_extract(ref, r"^[A-Za-z]+", 0))
    rest = F.substr(ref, F.length(name) + 2)
    repeated = ~rest.startswith("//") & (name == F.lower(F.regexp_extract(base, _WEB, 1))) & base.rlike(r"^[^/]*//[^/?#]*/")
    whole = F.when(repeated, rest).otherwise(F.concat(name, F.lit(":"), rest))
    return F.when(ref.rlike(r"(?i)^https?:"), whole).otherwise(ref)


def seed_too_long(raw: Column) -> Column:
    """The guard looks at the untrimmed text; no text passes."""
    return F.coalesce(F.length(raw) > MAX_SEED_LENGTH, F.lit(False))


def normalise_seed(raw: Column) -> Column:
    """Trimmed address with a scheme; blank or missing text gives null."""
    text = trim_controls(raw)
    has_scheme = text.startswith("http://") | text.startswith("https://")
    return F.when(~F.coalesce(text, F.lit("")).rlike(r"^\s*$"), F.when(has_scheme, text).otherwise(F.concat(F.lit(DEFAULT_SCHEME), text)))
