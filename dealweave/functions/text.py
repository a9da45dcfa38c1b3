"""String and URL column helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filled(col: Column) -> Column:
    """The value, or null when it is the empty string (an empty string counts as missing)."""
    return F.nullif(col, F.lit(""))


def bind(value: Column, build) -> Column:
    """``build(value)`` with the value computed once, however often ``build`` mentions it."""
    return F.get(F.transform(F.array(value), build), 0)


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are worked out once a row: what comes out of an array of one is no expression that the optimizer copies
    into the filters and fields that name it."""
    made = F.struct(*[value.alias(name) for name, value in columns.items()])
    df = df.select("*", F.explode(F.array(made)).alias("__once"))
    return df.withColumns({name: F.col(f"__once.{name}") for name in columns}).drop("__once")


def strip(col: Column) -> Column:
    """Without leading and trailing white space of any kind."""
    return F.btrim(col, F.lit(" \t\r\n"))


def first_filled(*cols: Column) -> Column:
    return F.coalesce(*[filled(c) for c in cols])


def squeeze(col: Column) -> Column:
    """Trim and collapse runs of white space to one blank."""
    return F.trim(F.regexp_replace(F.coalesce(col, F.lit("")), r"\s+", " "))


def snippet(col: Column, size: int) -> Column:
    """Squeezed text cut to ``size`` characters, the last one an ellipsis when cut."""
    return bind(
        squeeze(col),
        lambda t: F.when(F.length(t) <= size, t).otherwise(F.concat(F.substring(t, F.lit(1), F.lit(size - 1)), F.lit("…"))),
    )


def capture(col: Column, pattern: str, group: int = 1) -> Column:
    """Regex group of the first match, null when there is none."""
    return filled(F.regexp_extract(col, pattern, group))


def contains_any(col: Column, words) -> Column:
    """True when any of the words occurs as a substring; the text is worked out once, in filters too."""
    return bind(col, lambda c: reduce(lambda a, b: a | b, [c.contains(w) for w in words]))


def count_contained(col: Column, words) -> Column:
    """How many of the words occur as a substring."""
    return reduce(lambda a, b: a + b, [col.contains(w).cast("int") for w in words])


def slug(col: Column, sep: str = "-") -> Column:
    """Lower-case, non-alphanumeric runs become ``sep``, no leading or trailing ``sep``."""
    dashed = F.regexp_replace(F.lower(col), "[^a-z0-9]+", sep)
    return F.trim(dashed) if sep == " " else F.regexp_replace(dashed, f"^{sep}+|{sep}+$", "")


def alias_key(col: Column) -> Column:
    """Alias normal form: alphanumeric runs separated by one blank."""
    return slug(col, " ")


def _bare_host(authority: Column) -> Column:
    host = F.substring_index(F.lower(authority), ":", 1)
    return filled(F.regexp_replace(host, r"^www\.", ""))


def link_host(url: Column) -> Column:
    """Host of a web link; a text without http(s) scheme is taken as a bare host."""
    return _bare_host(F.regexp_extract(F.trim(url), r"^(?:https?://)?([^/?#]*)", 1))


def publisher_domain(url: Column) -> Column:
    """Host used to count publishers; ``raw_signal:7`` and the like give ``raw_signal``."""
    return _bare_host(
        F.regexp_extract(F.lower(F.trim(url)), r"^(?:[a-z][a-z0-9+.-]*://)?([^/?#]*)", 1)
    )


def authority_host(url: Column) -> Column:
    """Host only when the text has a ``//`` authority part; every ``www.`` removed."""
    host = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    return filled(F.replace(F.lower(host), F.lit("www."), F.lit("")))


def base_domain(host: Column) -> Column:
    """Last two labels of a host; null for a host of one label."""
    return F.when(host.contains("."), F.substring_index(host, ".", -2))


# scheme, authority mark, authority, path, query of a URL without fragment
URL_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(//)?([^/?]*)([^?]*)(?:\?(.*))?$"


def canonical_url(url: Column) -> Column:
    """URL with lower-case scheme and host, no fragment, parameters or trailing slash."""
    plain = F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), "#.*$", "")
    names = ["scheme", "mark", "host", "path", "query"]
    parts = F.struct(*[F.regexp_extract(plain, URL_PARTS, i + 1).alias(n) for i, n in enumerate(names)])
    return F.when(plain == "", "").otherwise(bind(parts, _rebuilt))


def _rebuilt(p: Column) -> Column:
    scheme = F.lower(p["scheme"])
    host = F.when(p["mark"] == "//", F.lower(p["host"])).otherwise("")
    path = F.when(p["mark"] == "//", p["path"]).otherwise(F.concat(p["host"], p["path"]))
    path = F.regexp_replace(F.regexp_replace(path, ";[^/]*$", ""), "(?<=.)/+$", "")
    tail = F.when(p["query"] == "", "").otherwise(F.concat(F.lit("?"), p["query"]))
    web = (p["mark"] == "//") | scheme.isin("", "http", "https")
    rooted = F.concat(F.when(path.startswith("/"), "").otherwise("/"), path)
    return F.when(
        web, F.concat(F.when(scheme == "", "https").otherwise(scheme), F.lit("://"), host, rooted, tail)
    ).otherwise(F.concat(scheme, F.lit(":"), path, tail))


def url_key(url: Column, size: int = 16) -> Column:
    """Dedup key: SHA-256 prefix of the canonical URL."""
    canon = canonical_url(url)
    return F.substring(F.sha2(F.when(canon == "", "empty").otherwise(canon), 256), 1, size)


# The HTML entities that occur in landed item text.
HTML_ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&#x27;": "'",
    "&#x2F;": "/",
    "&nbsp;": " ",
    "&amp;": "&",
}


def strip_tags(html: Column) -> Column:
    """Tags become blanks, entities are decoded, the result is trimmed."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), "<[^>]+>", " ")
    for entity, plain in HTML_ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return F.trim(text)


def name_similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; 0 when either text is empty."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when((F.length(a) == 0) | (F.length(b) == 0), 0.0).otherwise(
        1.0 - F.levenshtein(a, b) / F.greatest(longer, F.lit(1))
    )


def authority_host_prefix(url: Column) -> Column:
    """Host of a URL with scheme, one leading ``www.`` removed; null without a scheme."""
    host = F.regexp_extract(url, r"^[^/]*://([^/]*)", 1)
    return filled(F.regexp_replace(F.lower(host), r"^www\.", ""))
