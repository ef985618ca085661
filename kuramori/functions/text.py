"""Text normalisers and small text functions as column expressions.

Only compatibility composition and case folding need Python (one Arrow-batched UDF each); everything else stays in the JVM. The
normalisers differ on purpose and must not be merged: names, addresses, classifier keys and file names are compared differently.
Null input gives '' unless said otherwise."""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Legal prefixes of names, characters ignored in names and in addresses, dash variants, corporate prefixes of owners.
LEGAL_PREFIXES = "宗教法人|公益財団法人|一般財団法人|公益社団法人|一般社団法人"
OWNER_PREFIXES = "宗教法人|学校法人|公益財団法人|一般財団法人|公益社団法人|一般社団法人|社会福祉法人"
NAME_NOISE = r"[\s　・･,，.。\-‐‑–—ー_/／()（）\[\]「」『』]"
ADDRESS_NOISE = r"[・･,，.。_/／()（）\[\]「」『』]"
DASHES = r"[‐‑‒–—―−ｰ]"
LOCATIVES = "墓地内|境内地|敷地内|構内|境域内|境内"
MARKS = "◎○〇●"


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Compatibility composition; null stays null."""
    return s.map(lambda v: unicodedata.normalize("NFKC", v), na_action="ignore")


@F.pandas_udf(T.StringType())
def casefold(s: pd.Series) -> pd.Series:
    """Full case folding (ß becomes ss, unlike ``lower``)."""
    return s.str.casefold()


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff/Obershelp similarity; 0 where a side is null or empty."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a, b)], dtype="float64")


def text(c: Column) -> Column:
    """NFKC, white space runs to one space, trimmed; an integral number in text loses its ``.0``."""
    s = nfkc(F.coalesce(c.cast("string"), F.lit("")))
    return F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(s, r"[\s　]+", " ")), r"^ | $", ""), r"^(-?\d+)\.0$", "$1")


def name_key(c: Column) -> Column:
    """Loose key of a name: no legal prefix, no separators, one small-kana form, case folded."""
    s = F.regexp_replace(text(c), rf"^(?:{LEGAL_PREFIXES})\s*", "")
    return casefold(F.regexp_replace(F.translate(s, "ヶ", "ケ"), NAME_NOISE, ""))


def address_key(c: Column) -> Column:
    """Grouping key of an address that keeps the borders of its numbers."""
    s = F.translate(text(c), "ヶ", "ケ")
    s = F.regexp_replace(F.regexp_replace(s, r"(?<=\d)ー(?=\d)", "-"), DASHES, "-")
    s = F.regexp_replace(F.regexp_replace(s, r"\s+", ""), "丁目|番地|番", "-")
    s = F.regexp_replace(F.regexp_replace(F.regexp_replace(s, "号", ""), ADDRESS_NOISE, ""), "-+", "-")
    return casefold(F.regexp_replace(s, "^-|-$", ""))


def squeezed(c: Column, compose: bool = True) -> Column:
    """Classifier key: no white space at all; with ``compose`` also NFKC. Two variants exist and both are used."""
    s = F.coalesce(c.cast("string"), F.lit(""))
    return F.regexp_replace(nfkc(s) if compose else s, r"[\s　]+", "")


def ingest_key(c: Column) -> Column:
    """Column-name key: NFKC, no white space and underscores, lower case."""
    return F.lower(F.regexp_replace(nfkc(F.coalesce(c, F.lit(""))), r"[\s_　]+", ""))


def facility_key(c: Column) -> Column:
    """Museum name key: leading marks and trailing closure notes dropped, separators deleted, case folded."""
    s = F.regexp_replace(text(c), rf"^[{MARKS}]\s*", "")
    s = F.regexp_replace(s, r"[(（](?:休館|閉館)[^)）]*[)）]\s*$", "")
    return casefold(F.regexp_replace(s, NAME_NOISE, ""))


def letters_key(c: Column, drop_legal: bool = False) -> Column:
    """Only digits, Latin letters, kana and ideographs, in lower case."""
    s = text(c)
    s = F.regexp_replace(s, rf"^(?:{LEGAL_PREFIXES})\s*", "") if drop_legal else s
    return F.regexp_replace(F.lower(s), "[^0-9a-zぁ-んァ-ヶ一-龠々]", "")


def facility_address_key(c: Column, prefecture: str) -> Column:
    """Exact address key without postal code, country and prefecture; '' without any digit."""
    s = F.regexp_replace(address_key(c), r"^(?:〒)?\d{3}-?\d{4}", "")
    s = F.regexp_replace(s, rf"^(?:日本)?{prefecture}", "")
    return F.when(s.rlike(r"\d"), s).otherwise("")


def site_address_key(c: Column, prefecture: str) -> Column:
    """The part of the exact key up to its last house number: building and floor are left out."""
    s = facility_address_key(c, prefecture)
    site = F.regexp_extract(s, r"^(.+?\d+(?:-\d+){1,3})(?=[^\d-]|$)", 1)
    return F.when(site != "", site).otherwise(s)


def light_address(c: Column) -> Column:
    """Address with unified dashes and without postal code and spaces; chome and banchi words stay."""
    s = F.regexp_replace(text(c), r"^〒?\s*\d{3}-?\d{4}\s*", "")
    s = F.regexp_replace(F.regexp_replace(s, r"(?<=\d)ー(?=\d)", "-"), DASHES, "-")
    return F.regexp_replace(s, r"\s+", "")


def site_label(c: Column) -> Column:
    """Name of the site a location text speaks of: locative ending dropped, then one trailing locative mark."""
    s = F.trim(F.regexp_replace(text(c), f"(?:{LOCATIVES})$", ""))
    return F.trim(F.regexp_replace(s, "内$", ""))


def owner_label(c: Column) -> Column:
    """Owner without corporate prefix."""
    return F.trim(F.regexp_replace(text(c), rf"^(?:{OWNER_PREFIXES})\s*", ""))


def id_text(c: Column) -> Column:
    """Identifier comparable across files: all digits lose leading zeros, ``.0`` is stripped; null gives ''."""
    s = F.regexp_replace(F.trim(F.coalesce(c.cast("string"), F.lit(""))), r"\.0$", "")
    return F.when(s.rlike("^[0-9]+$"), F.coalesce(F.nullif(F.regexp_replace(s, "^0+", ""), F.lit("")), F.lit("0"))).otherwise(s)


def municipality_code(c: Column) -> Column:
    """Five-digit code from text such as ``13905.0``; '00000' for null and empty text."""
    return F.lpad(F.regexp_replace(F.trim(F.coalesce(c.cast("string"), F.lit(""))), r"\.0$", ""), 5, "0")


def slug(c: Column, empty: str = "layer") -> Column:
    """File-name safe text: path and white space characters to one underscore."""
    s = F.regexp_replace(F.regexp_replace(c, r'[\\/:*?"<>|\s]+', "_"), "^_+|_+$", "")
    return F.when(s == "", empty).otherwise(s)


def ascii_slug(c: Column, empty: str = "file") -> Column:
    """File name of ASCII letters, digits, dot, dash and underscore."""
    s = F.regexp_replace(F.regexp_replace(c, "[^0-9A-Za-z._-]+", "_"), "^_+|_+$", "")
    return F.when(s == "", empty).otherwise(s)


def postal_split(c: Column) -> tuple[Column, Column]:
    """(postal code "ddd-dddd" or '', rest of the address)."""
    s = F.coalesce(c, F.lit(""))
    p = F.regexp_extract(s, r"^\s*〒?\s*(\d{3})-?(\d{4})(?!\d)", 1)
    code = F.when(p != "", F.concat(p, F.lit("-"), F.regexp_extract(s, r"^\s*〒?\s*(\d{3})-?(\d{4})(?!\d)", 2))).otherwise("")
    return code, F.trim(F.regexp_replace(s, r"^\s*〒?\s*\d{3}-?\d{4}(?!\d)", ""))


def sanitised_address(c: Column, stops: list[str]) -> Column:
    """Address cut at the first of several stop patterns (telephone, access, opening hours ...)."""
    at = [F.when(F.regexp_instr(c, F.lit(p)) > 0, F.regexp_instr(c, F.lit(p))) for p in stops]
    first = F.least(*at) if len(at) > 1 else at[0]
    return F.trim(F.when(first.isNull(), c).otherwise(F.substring(c, F.lit(1), first - 1)))


def url_host(c: Column) -> Column:
    """Lower-case host without ``www.``; '' where there is none."""
    return F.coalesce(F.regexp_replace(F.lower(F.try_parse_url(F.trim(c), F.lit("HOST"))), r"^www\.", ""), F.lit(""))


def any_word(c: Column, words: list[str]) -> Column:
    """Whether any of some fixed words occurs."""
    found = F.lit(False)
    for w in words:
        found = found | c.contains(w)
    return F.coalesce(found, F.lit(False))


def number(c: Column) -> Column:
    """Number from text with thousands separators and full-width minus; null where it isn't one."""
    return F.regexp_replace(F.regexp_replace(F.trim(c.cast("string")), ",", ""), "[−－‐]", "-").try_cast("double")


def number_text(c: Column) -> Column:
    """Number as text: an integer where within 1e-9 of one, else at most three decimals without trailing zeros."""
    whole = F.abs(c - F.round(c)) < 1e-9
    return F.when(whole, F.round(c).cast("bigint").cast("string")).otherwise(F.regexp_replace(F.regexp_replace(F.format_string("%.3f", c), "0+$", ""), r"\.$", ""))


def first_filled(*columns: Column) -> Column:
    """First column with text in it, in order; '' if none."""
    return F.coalesce(*[F.nullif(F.trim(c.cast("string")), F.lit("")) for c in columns], F.lit(""))


def stable_id(prefix: str, *parts: Column, length: int = 12) -> Column:
    """Deterministic identifier: prefix and the first hexadecimal digits of the SHA-1 of the joined parts."""
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])), 1, length))


def contained(a: Column, b: Column, least: int = 4) -> Column:
    """Whether one key contains the other and the shorter one has enough letters."""
    return (F.least(F.length(a), F.length(b)) >= least) & (a.contains(b) | b.contains(a))
