"""Checks of single values: addresses, metadata of a declared kind, arrays, and server delays, all as columns."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of query parameters that carry credentials, as whole names, parts of names, and words.
CREDENTIAL_PARTS = ("token", "secret", "password", "passwd", "credential", "apikey", "accesskey", "privatekey", "sessionid", "xamz")
CREDENTIAL_WORDS = ("auth", "jwt", "key", "session", "sig", "signature")


def _closed(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def credential_name(name: Column) -> Column:
    """Whether a parameter's name says that it carries a credential: in any case, with any separators."""
    plain = F.regexp_replace(F.lower(name), "[^a-z0-9]", "")
    words = F.split(F.lower(F.regexp_replace(name, "(?<=[a-z0-9])(?=[A-Z])", " ")), "[^a-z0-9]+")
    out = F.arrays_overlap(words, F.array(*map(F.lit, CREDENTIAL_WORDS)))
    for part in CREDENTIAL_PARTS:
        out = out | F.contains(plain, F.lit(part))
    return _closed(out)


def url_reason(url: Column, hosts: list[str]) -> Column:
    """Why an address isn't an input, the first reason that holds; null where it is."""
    part = lambda p: F.try_parse_url(url, F.lit(p))
    netloc = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_replace(netloc, "^.*@", ""), r":\d*$", ""))
    port = F.regexp_extract(netloc, r":(\d+)$", 1)
    path = F.regexp_extract(url, r"^[^?#]*://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    in_path = F.exists(F.regexp_extract_all(path, F.lit(r";([^;/=]*)"), F.lit(1)), credential_name)
    in_query = F.exists(F.transform(F.split(query, "&"), lambda p: F.split_part(p, F.lit("="), F.lit(1))), credential_name)
    address = host.rlike(r"^\d{1,3}(\.\d{1,3}){3}$")
    private = address & host.rlike(r"^(0|10|127|169\.254|172\.(1[6-9]|2\d|3[01])|192\.168)\.")
    rules = [
        (url.isNull() | (url == "") | (F.length(url) > 2048), "invalid_url"), (url.rlike(r"[\s\x00-\x1f]"), "invalid_url"), (F.contains(url, F.lit("\\")) | url.rlike("(?i)%(0[0-9a-f]|1[0-9a-f]|25|2f|3b|5c|7f)"), "ambiguous_url"), (~F.lower(url).startswith("https://"), "https_required"),
        (F.contains(netloc, F.lit("@")), "userinfo_forbidden"), (part("REF").isNotNull() & (part("REF") != ""), "fragment_forbidden"), (host == "", "invalid_url"), (host.endswith(".") | ~host.rlike(r"^[\x21-\x7e]+$"), "ambiguous_hostname"), (private, "non_public_host"),
        (~host.isin(*hosts), "host_not_allowed"), ((port != "") & (port != "443"), "port_not_allowed"), (in_path, "signed_path_forbidden"), ((query != "") & in_query, "signed_query_forbidden"),
    ]
    return F.coalesce(*(F.when(_closed(c), F.lit(r)) for c, r in rules))


@F.pandas_udf(T.StringType())
def idna(hosts: pd.Series) -> pd.Series:
    """Host names in their ASCII form; null where a name has none."""

    def one(host: str | None) -> str | None:
        try:
            return host and host.encode("idna").decode("ascii").lower()
        except UnicodeError:
            return None

    return hosts.map(one, na_action="ignore")


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, the host in ASCII, no default port, a path at least; query as it was."""
    at = lambda i: F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#:]*)(:\d+)?([^?#]*)(\?[^#]*)?", i)
    port = F.when((F.lower(at(1)) == "https") & (at(3) == ":443"), "").otherwise(at(3))
    host = F.when(at(2).rlike(r"^[\x21-\x7e]*$"), F.lower(at(2))).otherwise(idna(at(2)))
    return F.when(at(1) != "", F.concat(F.lower(at(1)), F.lit("://"), host, port, F.when(at(4) == "", "/").otherwise(at(4)), at(5)))


def of_kind(kind: Column, value: Column, allowed: list[str], longest: int = 200) -> Column:
    """Whether a metadata value keeps the contract of its declared kind; an unknown kind has no values."""
    text = (F.length(value) > 0) & (F.length(value) <= longest) & (value == F.trim(value)) & ~value.rlike(r"[\x00-\x1f]")
    url = value.rlike(r"^https://[a-z0-9.-]+(:443)?/[^?#]*$") & ~F.contains(F.substring(value, 9, 4096), F.lit("//"))
    instant = value.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?Z$") & F.try_to_timestamp(F.regexp_replace(value, "Z$", "+00:00")).isNotNull()
    rules = {
        "year": value.rlike(r"^(1[89]|20)\d{2}$"), "enum": value.isin(*allowed), "timestamp": instant, "duration": value.rlike(r"^P(?=.)(\d+D)?(T(?=.)(\d+H)?(\d+M)?(\d+S)?)?$"),
        "url": url, "bounded_text": text, "positive_integer": value.rlike(r"^[1-9][0-9]{0,17}$"),
    }
    out = F.lit(False)
    for name, ok in rules.items():
        out = F.when(kind == name, _closed(ok)).otherwise(out)
    return out


def retry_after(header: Column, now: Column, longest: float) -> Column:
    """Seconds that a server asks to wait, from a number or an HTTP date; null where it asks nothing sound."""
    seconds = header.try_cast("double")
    date = F.try_to_timestamp(F.regexp_extract(header, r"^[A-Z][a-z]{2}, (\d{2} [A-Z][a-z]{2} \d{4} \d{2}:\d{2}:\d{2}) GMT$", 1), F.lit("dd MMM yyyy HH:mm:ss"))
    wait = F.coalesce(seconds, date.cast("double") - now.cast("double"))
    return F.when((wait >= 0) & (wait <= longest), wait)


def sorted_unique(labels: Column) -> Column:
    """Whether an array is a set in order."""
    return _closed(F.array_sort(F.array_distinct(labels)) == labels)


def subset(part: Column, whole: Column) -> Column:
    return _closed(F.size(F.array_except(part, whole)) == 0)
