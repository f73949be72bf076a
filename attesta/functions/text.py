"""Text functions as columns: built-ins where they are exact, Arrow UDFs where Spark has none."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNIPPET_CHARS = 96


@F.pandas_udf(T.StringType())
def casefold(s: pd.Series) -> pd.Series:
    """Full Unicode case folding; `lower` differs on sharp s and final sigma."""
    return s.map(str.casefold, na_action="ignore")


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


@F.pandas_udf(T.BooleanType())
def is_nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: unicodedata.is_normalized("NFC", t), na_action="ignore")


def collapse(c: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def snippet(c: Column, chars: int = SNIPPET_CHARS) -> Column:
    """Collapsed text, cut after `chars` code points with an ellipsis."""
    text = collapse(c)
    return F.when(F.length(text) <= chars, text).otherwise(F.concat(F.left(text, F.lit(chars)), F.lit("…")))


def source_key(c: Column) -> Column:
    """Lower case, runs of spaces and underscores as one hyphen, trimmed."""
    return F.regexp_replace(F.lower(F.trim(c)), r"[\s_]+", "-")


def tokens(c: Column) -> Column:
    """Distinct words of two characters or more, lower case, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1)), lambda t: F.length(t) > 1)))


def masked(c: Column) -> Column:
    """Mail addresses, labelled credentials and long digit runs replaced."""
    out = F.regexp_replace(c, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[email]")
    out = F.regexp_replace(out, r"(?i)(password|passwd|secret|token|api_?key)\s*[:=]\s*\S+", "$1=[redacted]")
    return F.regexp_replace(out, r"\d{12,}", "[account]")


def looks_secret(c: Column) -> Column:
    """A labelled credential or a raw one of a known family."""
    return F.coalesce(c.rlike(r"(?i)(password|passwd|secret|token|api_?key)\s*[:=]\s*\S{8,}") | c.rlike(r"AKIA[A-Z0-9]{14,}"), F.lit(False))


# Shapes of raw credentials by family, labels that announce one, and what an announced one looks like.
FAMILIES = (
    r"(?:AKIA|ASIA)[A-Z0-9]{16}", r"gh[pousr]_[A-Za-z0-9]{20,}", r"github_pat_[A-Za-z0-9_]{20,}", r"sk-(?:(?:proj|svcacct)-)?[A-Za-z0-9_-]{20,}", r"(?:xox[bcaprs]|xapp)-[A-Za-z0-9-]{20,}", r"(?:sk|rk)_(?:live|test)_[A-Za-z0-9]{20,}", r"glpat-[A-Za-z0-9_-]{20,}", r"AIza[A-Za-z0-9_-]{20,}",
)
LABELS = r"(?i:authorization +(?:(?:basic|bearer) +)?|basic +|bearer +|credentials? +|password +|token +|api +key +|(?:aws +)?secret +access +key +|client +secret +|github +token +|jwt +)"
ANNOUNCED = r"(?:(?=[A-Za-z0-9._+/=-]{0,255}[0-9._+/=-])[A-Za-z0-9._+/=-]{16,}|(?=[A-Za-z0-9._-]{0,255}[A-Z][A-Za-z0-9._-]*[A-Z])[A-Za-z0-9._-]{20,})(?![A-Za-z0-9._+/=-])"
#: What a portable text may consist of: letters of the scripts at hand, digits, marks of prose.
SAFE = r"^[A-Za-z0-9 .,!?;'\"()\[\]{}_+\-\x{00B7}\x{00C0}-\x{024F}\x{1E00}-\x{1EFF}\x{3001}\x{3002}\x{300C}\x{300D}\x{3040}-\x{3098}\x{309B}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7A3}\x{2013}\x{2014}\x{2018}-\x{201D}\x{2026}\x{FF08}\x{FF09}]+$"
PATHS = r"(?:^|[^A-Za-z0-9])(?:/|\\\\|~[\\/]|[A-Za-z]:[\\/])|(?:^|[\\/])\.\.(?:[\\/]|$)"


def signed_token(c: Column) -> Column:
    """Whether a text holds a signed token: three dotted parts, of which the first is a JSON object that names an algorithm."""
    heads = F.regexp_extract_all(c, F.lit(r"(?<![A-Za-z0-9])([A-Za-z0-9_-]{2,256})\.[A-Za-z0-9_-]{0,4096}\.[A-Za-z0-9_-]{0,4096}(?![A-Za-z0-9_-])"), F.lit(1))

    def header(h: Column) -> Column:
        plain = F.rpad(F.translate(h, "-_", "+/"), (F.ceil(F.length(h) / 4) * 4).cast("int"), F.lit("="))
        alg = F.get_json_object(F.try_validate_utf8(F.try_to_binary(plain, F.lit("base64")).cast("string")), "$.alg")
        return F.coalesce(alg.rlike(r"^[A-Za-z0-9._+-]{1,64}$"), F.lit(False))

    return F.coalesce(F.exists(heads, header), F.lit(False))


def secret_like(c: Column) -> Column:
    """Whether a text resembles a credential: announced by a label, of a known family, or a signed token. A null does."""
    raw = c.rlike(r"\b(?:" + "|".join(FAMILIES) + r")\b")
    return F.coalesce(c.rlike(r"\b" + LABELS + ANNOUNCED) | raw | signed_token(c), F.lit(True))


def portable(c: Column) -> Column:
    """Whether a text has only safe characters and no absolute or climbing path."""
    return F.coalesce(c.rlike(SAFE) & ~c.rlike(PATHS), F.lit(False))


# Parts of names whose values are private, and query parameters that sign an address.
PRIVATE_NAMES = ("password", "secret", "token", "credential", "authorization", "cookie", "api_key", "private_key")
SIGNING = ("signature", "x-amz-signature", "x-amz-credential", "x-amz-security-token", "token", "sig")
REDACTED = "[REDACTED]"


def _cleaned(c: Column) -> Column:
    """One text without signing parameters, local paths, addresses and account names."""
    out = F.regexp_replace(c, r"(?i)([?&](?:" + "|".join(SIGNING) + r")=)[^&#\s]*", "$1" + REDACTED)
    out = F.regexp_replace(out, r"(?<![A-Za-z0-9/:.])/(?:home|Users|root|tmp|var)/[^\s'\"]*", REDACTED)
    out = F.regexp_replace(out, r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}(?![A-Za-z0-9.-])", REDACTED)
    return F.regexp_replace(out, r"(?i)(?<![A-Za-z0-9])(?:acct|account|owner|tenant|user)[_-][A-Za-z0-9]{6,}(?![A-Za-z0-9])", REDACTED)


def _private(name: str) -> bool:
    plain = name.strip().lower().replace(" ", "_")
    return any(p in plain for p in PRIVATE_NAMES)


def sanitized(c: Column, kind: T.DataType, name: str = "") -> Column:
    """A value of any type with private data masked, by a walk over its schema: what has a private name, and what texts hold.

    A private value that isn't a text becomes null, as its type has no room for the mask.
    """
    if _private(name):
        return F.when(c.isNotNull(), F.lit(REDACTED)) if isinstance(kind, T.StringType) else F.lit(None).cast(kind)
    if isinstance(kind, T.StringType):
        return _cleaned(c)
    if isinstance(kind, T.StructType):
        fields = F.struct(*(sanitized(c[f.name], f.dataType, f.name).alias(f.name) for f in kind.fields))
        return F.when(c.isNotNull(), fields)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: sanitized(x, kind.elementType))
    if isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
        hidden = lambda k: F.lower(F.translate(F.trim(k), " ", "_")).rlike("|".join(PRIVATE_NAMES))
        masked = F.lit(REDACTED) if isinstance(kind.valueType, T.StringType) else F.lit(None).cast(kind.valueType)
        return F.transform_values(c, lambda k, v: F.when(hidden(k), masked).otherwise(sanitized(v, kind.valueType)))
    return c


def version_key(c: Column, parts: int = 4) -> Column:
    """Dotted version as integers, padded with zeros, for comparing."""
    numbers = F.transform(F.split(c, r"\."), lambda x: F.coalesce(x.try_cast("int"), F.lit(0)))
    return F.slice(F.concat(numbers, F.array_repeat(F.lit(0), parts)), 1, parts)
