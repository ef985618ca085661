"""Text that looks the same in one consistent form.

Each value is split into words: runs of alphabetic letters, and runs of Japanese letters. The script sets of a word's
characters (with the usual joint sets: Han, Hiragana and Katakana are all in ``Jpan``) are intersected. An empty intersection
is a *mixed-script* word; the script in which the whole word can be spelled, through look-alike letters, is chosen and the
intruders are respelled. A word wholly in one script stays, even if it could be mistaken for another (reported as
``whole_script``). In Japanese words, whose joint set is never empty, an ideograph inside a katakana word or a kana inside an
ideographic word is an intruder if it has a look-alike of the surrounding script. The rest is compatibility composition,
U+0020 as the only space, and removal of invisible characters.

Defined results: null stays null; an empty text stays empty; any length is processed whole."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters of different scripts that look alike (Latin, then Cyrillic, then Greek; "-" where there is none).
ALPHABETIC_TWINS = """
A А Α|B В Β|C С -|E Е Ε|H Н Η|I І Ι|J Ј -|K К Κ|M М Μ|N - Ν|O О Ο|P Р Ρ|S Ѕ -|T Т Τ|X Х Χ|Y У Υ|Z - Ζ
a а α|c с -|e е -|i і ι|j ј -|o о ο|p р ρ|s ѕ -|v - ν|x х χ|y у γ|h һ -
"""
# Ideograph and katakana that look alike.
HAN_KANA_TWINS = "工エ 夕タ 口ロ 力カ 二ニ 卜ト 三ミ 八ハ 千チ 才オ 又ヌ 一ー"
# Hiragana and katakana that look alike.
KANA_TWINS = "へヘ べベ ぺペ りリ"
SCRIPTS = ("Latin", "Cyrillic", "Greek", "Han", "Hiragana", "Katakana", "Hangul", "Bopomofo", "Armenian", "Hebrew", "Arabic", "Thai", "Devanagari")
JOINT = {"Han": {"Jpan", "Kore", "Hanb"}, "Hiragana": {"Jpan"}, "Katakana": {"Jpan"}, "Hangul": {"Kore"}, "Bopomofo": {"Hanb"}}
ALPHABETIC = {"Latin", "Cyrillic", "Greek"}
LINKING_KANA = "ノヶケヵツ"  # stand between ideographs in place names

_SCRIPT_TESTS = [(s, regex.compile(rf"\p{{scx={s}}}")) for s in SCRIPTS]
_SHARED = regex.compile(r"\p{Script=Common}|\p{Script=Inherited}")
_WORD = regex.compile(r"(?P<alpha>[\p{scx=Latin}\p{scx=Cyrillic}\p{scx=Greek}]+)|(?P<jp>[\p{Script=Han}\p{Script=Hiragana}\p{Script=Katakana}ー]+)")
_INVISIBLE = regex.compile(r"[\p{Cf}\p{Variation_Selector}͏ᅟᅠ឴឵ㅤﾠ\p{Cc}--[\t\n\v\f\r\u0085]]", regex.V1)
_SPACE = regex.compile(r"[\p{Zs}\p{Zl}\p{Zp}\t\n\v\f\r\u0085]")

TWINS: dict[str, dict[str, str]] = {}
for _row in ALPHABETIC_TWINS.replace("\n", "|").split("|"):
    if _row.strip():
        _group = dict(zip(("Latin", "Cyrillic", "Greek"), _row.split()))
        for _c in _group.values():
            if _c != "-":
                TWINS[_c] = {s: c for s, c in _group.items() if c != "-"}
TO_KANA = {p[0]: p[1] for p in HAN_KANA_TWINS.split()}
TO_HAN = {k: h for h, k in TO_KANA.items() if k != "ー"}
HIRA_TO_KATA = {p[0]: p[1] for p in KANA_TWINS.split()}
KATA_TO_HIRA = {k: h for h, k in HIRA_TO_KATA.items()}


@lru_cache(maxsize=65_536)
def script_set(ch: str) -> frozenset[str]:
    """Scripts of a character with the joint sets; empty means shared by all."""
    if _SHARED.match(ch) and ch != "ー":
        return frozenset()
    own = {s for s, test in _SCRIPT_TESTS if test.match(ch)} or {unicodedata.name(ch, "UNKNOWN").split()[0].title()}
    return frozenset(own | {j for s in own for j in JOINT.get(s, ())})


def resolve(word: str) -> frozenset[str] | None:
    """Intersection of the script sets of a word's characters; None if all characters are shared, empty if mixed."""
    out: frozenset[str] | None = None
    for ch in word:
        if own := script_set(ch):
            out = own if out is None else out & own
    return out


def _respell(word: str, context: str) -> tuple[str, str]:
    """(spelling, finding) of an alphabetic word."""
    scripts = resolve(word)
    if scripts is None:
        return word, ""
    if scripts:
        script = next(iter(sorted(scripts & ALPHABETIC)), "")
        if script and script != "Latin" and all(script in TWINS.get(c, {}) and "Latin" in TWINS[c] for c in word):
            return word, "whole_script"
        return word, ""
    best: tuple[tuple[int, int, bool], str] | None = None
    for s in sorted(ALPHABETIC):
        spelled = [c if s in script_set(c) or not script_set(c) else TWINS.get(c, {}).get(s) for c in word]
        if None not in spelled:
            distinctive = sum(s in script_set(c) and c not in TWINS for c in word)
            around = sum(s in script_set(c) for c in context) - sum(s in script_set(c) for c in word)
            score = (distinctive, around, s == "Latin")
            if best is None or score > best[0]:
                best = score, "".join(x for x in spelled if x)
    return (best[1], "mixed_script") if best else (word, "mixed_unresolved")


def _is_katakana(c: str) -> bool:
    return "ァ" <= c <= "ヺ" or c == "ー"


def _is_han(c: str) -> bool:
    return "Han" in script_set(c) if c else False


def _respell_japanese(word: str) -> tuple[str, str]:
    chars, found = list(word), ""
    for k, c in enumerate(word):
        left, right = word[k - 1 : k] if k else "", word[k + 1 : k + 2]
        if c in TO_KANA:
            kana = [n for n in (left, right) if n and (_is_katakana(n) or n in TO_KANA)]
            sure = [n for n in (left, right) if n and _is_katakana(n) and n not in LINKING_KANA]
            if sure and len(kana) == bool(left) + bool(right) and (len(sure) > 1 or len(word) > 2) and not (c == "一" and len(sure) < 2):
                chars[k], found = TO_KANA[c], "mixed_script"
        elif c in TO_HAN and c not in LINKING_KANA and left and right and _is_han(left) and _is_han(right):
            chars[k], found = TO_HAN[c], "mixed_script"
        elif c in HIRA_TO_KATA and left and right and _is_katakana(left) and _is_katakana(right):
            chars[k], found = HIRA_TO_KATA[c], "mixed_script"
        elif c in KATA_TO_HIRA and left and right and all("Hiragana" in script_set(n) and n != "ー" for n in (left, right)):
            chars[k], found = KATA_TO_HIRA[c], "mixed_script"
    return "".join(chars), found


def consistent(text: str | None) -> tuple[str | None, str]:
    """(consistent form, findings joined by ";")."""
    if not text:
        return text, ""
    found: list[str] = []
    s = _INVISIBLE.sub("", text)
    if s != text:
        found.append("invisible")
    composed = unicodedata.normalize("NFKC", s)
    if composed != s:
        found.append("composition")
    spaced = _SPACE.sub(" ", composed)
    if spaced != composed:
        found.append("space")

    def word(m: regex.Match) -> str:
        w, what = _respell(m.group(), spaced) if m.lastgroup == "alpha" else _respell_japanese(m.group())
        if what and what not in found:
            found.append(what)
        return w

    return _WORD.sub(word, spaced), ";".join(found)


def consistent_text(text: str | None) -> str:
    """Consistent form alone, '' for null; the first step of the other operators of this subpackage."""
    return consistent(text)[0] or ""


@F.pandas_udf(T.StructType([T.StructField("value", T.StringType()), T.StructField("findings", T.StringType())]))
def consistent_form(texts: pd.Series) -> pd.DataFrame:
    """Vectorised ``consistent``; every distinct text of a batch is worked out once."""
    known = {t: consistent(t) for t in texts.dropna().unique()}
    return pd.DataFrame([known.get(t, (None, "")) for t in texts], columns=["value", "findings"])


def maybe_inconsistent(text: Column) -> Column:
    """JVM-side test that is true for every text ``consistent`` would change: only these rows go to Python."""
    kana, han, twins = r"ァ-ヺー", r"一-鿿", "".join(TO_KANA) + "".join(HIRA_TO_KATA)
    plain = text.rlike(rf"\A[ -~{han}ぁ-ゖ{kana}・]*\z")
    odd = text.rlike(rf"[{kana}][{twins}]|[{twins}][{kana}]|[{han}][{''.join(TO_HAN)}][{han}]|[ぁ-ゖ][{''.join(KATA_TO_HIRA)}][ぁ-ゖ]")
    return ~plain | odd


def changed_values(df: DataFrame, key: str, fields: list[str], table_name: str) -> DataFrame:
    """(table_name, row_key, field, value, consistent, findings) of the values that are not in their consistent form."""
    long = df.select(F.col(key).cast("string").alias("row_key"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("x"))
    long = long.select("row_key", "x.field", "x.value").filter(F.col("value").isNotNull() & maybe_inconsistent(F.col("value")))
    out = long.withColumn("c", consistent_form("value")).filter(~F.col("c.value").eqNullSafe(F.col("value")))
    return out.select(F.lit(table_name).alias("table_name"), "row_key", "field", "value", F.col("c.value").alias("consistent"), F.col("c.findings").alias("findings")).distinct()
