"""Postal addresses that denote the same place, however they are written.

1. Every address is split into components: municipality, town as written, house numbers (two to four), postal code; building and floor
   are left out. Gazetteer knowledge (the fixed list of towns, its size checked) settles a misspelt town, or one that the text omits
   but its postal code names.
2. Equal component tuples are one *form*; copies never enter the comparison.
3. Multi-pass sorted neighbourhoods over all forms: town - numbers - municipality, numbers - municipality - town from its end, postal
   code - numbers - town, and municipality - numbers - letters of the town in any order. Each pass sorts by range over the cluster and
   slides a window of ``WINDOW`` forms over it, also over the borders of partitions. A window is compared by edit distance and a
   transposition-tolerant score; numbers and municipality must agree strictly, and two different towns that both exist are never the
   same, however alike. Forms of one settled town are neighbours in the first pass, however many there are. A form of an unsettled
   town meets all others of its numbers also by an exact join, so that a crowded neighbourhood loses nothing.
4. Matching forms are joined to places by connected components; rows follow their form.

Defined results: rows without text, without readable house numbers, or without any town are no address; ties and repeated rows
share a form; extra columns are never read."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kuramori.llm.uniform import consistent_text
from kuramori.operators.components import connected_components
from kuramori.session import cut

WINDOW = 8
MAX_TOWNS = 500_000  # more gazetteer rows than this are refused
LIKENESS = 0.6
DIGITS = {c: i for i, c in enumerate("〇一二三四五六七八九")}
_KANJI_NUMBER = re.compile(r"[〇一二三四五六七八九十百]+(?=\s*(?:丁目|番地|番|号))|(?<=番地の)[〇一二三四五六七八九十百]+")
_DASH = re.compile(r"(?<=[\d目番地])\s*[-‐‑‒–—―−ーｰ－~〜]\s*(?=\d)")
_NUMBERS = re.compile(r"(\d+)\s*(?:丁目|-)\s*(\d+)\s*(?:番地?\s*の?|-)\s*(\d+)(?:\s*(?:号\s*の|-)\s*(\d+)(?![\d階F]))?\s*号?")
_TWO_NUMBERS = re.compile(r"(\d+)\s*(?:丁目|番地?\s*の?|-)\s*(\d+)\s*(?:番地?|号)?(?![\d階F])")
_POSTAL = re.compile(r"(?:^|〒)\s*(\d{3})-?(\d{4})(?![\d-])")
_ENGLISH = re.compile(r"^\s*(\d+(?:-\d+){1,3})\s+([A-Za-z' -]+?),\s*([A-Za-z' ]+?)-(?:ku|shi|machi|cho|mura|son)\b", re.I)


def kanji_number(text: str) -> int:
    """Value of an ideographic number below 1000."""
    total = digit = 0
    for c in text:
        if c in DIGITS:
            digit = 10 * digit + DIGITS[c]
        else:
            total += (digit or 1) * (100 if c == "百" else 10)
            digit = 0
    return total + digit


def damerau(a: str, b: str, most: int = 2) -> int:
    """Edit distance in which swapping neighbours costs 1; stops at ``most`` + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    two: list[int] = []
    one = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        two, one = one, row
    return one[-1]


def town_likeness(a: str, b: str) -> float:
    """Transposition-tolerant similarity of two towns as written: 1 for equal text, 0 beyond one edit (two in long names)."""
    if a == b:
        return 1.0
    most = 1 if max(len(a), len(b)) < 5 else 2
    d = damerau(a, b, most)
    return 0.0 if d > most else 1 - d / max(len(a), len(b))


class Gazetteer:
    """Municipalities and towns by code, name, romanised name and postal code."""

    def __init__(self, rows: list[tuple]) -> None:
        self.municipality: dict[str, str] = {}
        self.towns: dict[str, set[str]] = {}
        self.by_postal: dict[str, tuple[str, str]] = {}
        self.by_english: dict[tuple[str, str], tuple[str, str]] = {}
        for code, name, name_en, town, town_en, postal in rows:
            self.municipality[name] = code
            self.towns.setdefault(code, set()).add(written_town(town))
            self.by_postal[re.sub(r"\D", "", postal or "")] = code, written_town(town)
            self.by_english[(name_en or "").lower(), (town_en or "").lower()] = code, written_town(town)
        self.names = sorted(self.municipality, key=len, reverse=True)
        self.english = {}
        for (m, t), v in self.by_english.items():
            self.english.setdefault(t, set()).add(v)
        self.settle = lru_cache(maxsize=100_000)(self._settle)

    def _settle(self, code: str, town: str) -> str:
        """The one town of a municipality that a written town can be; '' if none or several."""
        known = self.towns.get(code, set())
        if town in known:
            return town
        near = [t for t in known if damerau(t, town, 1) <= 1]
        return near[0] if len(near) == 1 else ""


def written_town(town: str) -> str:
    """Town as compared: no spaces, one way to write the linking kana."""
    return re.sub(r"[ケがガヶ](?=丘|浦)", "ヶ", re.sub(r"\s+", "", town))


def municipality_code(value: str | None) -> str:
    """Five-digit code from text such as ``13905`` or ``13905.0``; '' if there is none."""
    m = re.match(r"\s*(\d{4,5})(?:\.0+)?\s*$", value or "")
    return m.group(1).zfill(5) if m else ""


def _strip_like(text: str, names: list[str]) -> tuple[str, str]:
    """(name found at the start, rest); a name of three letters or more may have one wrong letter."""
    for n in names:
        if text.startswith(n):
            return n, text[len(n) :]
    for n in names:
        for size in (len(n), len(n) + 1, len(n) - 1):
            head = text[:size]
            if len(n) >= 3 and head[-1:] == n[-1] and len(text) > size and damerau(head, n, 1) <= 1:
                return n, text[size:]
    return "", text


def parse(text: str | None, detail: str | None, code: str, postal: str | None, g: Gazetteer, prefecture: str = "東瀬都") -> tuple[str, str, str, str] | None:
    """(municipality, town as written, numbers "a-b", "a-b-c" or "a-b-c-d", settled town), or None where the text gives no address."""
    s = consistent_text(text).strip()
    if not s:
        return None
    if m := _ENGLISH.match(s):
        numbers, town_en, city_en = "-".join(str(int(x)) for x in m.group(1).split("-")), m.group(2).lower(), m.group(3).lower()
        found = g.by_english.get((city_en, town_en))
        if not found:
            options = {v for (c, t), v in g.by_english.items() if damerau(t, town_en, 1) <= 1 and (damerau(c, city_en, 1) <= 1 or v[0] == code)}
            found = next(iter(options)) if len(options) == 1 else None
        return (found[0], found[1], numbers, found[1]) if found else None
    own = re.sub(r"\D", "", postal or "")
    if m := _POSTAL.search(s):
        own = m.group(1) + m.group(2)
        s = (s[: m.start()] + " " + s[m.end() :]).strip()
    number_text = lambda t: _DASH.sub("-", _KANJI_NUMBER.sub(lambda k: str(kanji_number(k.group())), t))
    s = number_text(s)
    m = _NUMBERS.search(s)
    before, after = (s[: m.start()], s[m.end() :]) if m else (s, "")
    if not m:
        apart = number_text(consistent_text(detail))
        if not (m := _NUMBERS.search(apart)):
            if m := _TWO_NUMBERS.search(s):
                before, after = s[: m.start()], s[m.end() :]
            elif not (m := _TWO_NUMBERS.search(apart)):
                return None
    numbers = "-".join(str(int(x)) for x in m.groups() if x)
    place = re.sub(r"\s+", "", before)
    if not place:  # numbers first: town and municipality follow, or nothing but a building
        rest = after.strip()
        at = next(((n, rest.find(n)) for n in g.names if n in rest), None)
        tail = re.split(r"\s+", rest)
        if at:
            place = at[0] + re.sub(r"\s+", "", rest[: at[1]])
        elif len(tail) >= 2 and damerau(_strip_like(tail[1] + "?", g.names)[0] or "??", tail[1], 1) <= 1:
            place = tail[1] + tail[0]
        elif tail and written_town(tail[0]) in g.towns.get(code, set()):
            place = tail[0]
    if place.startswith(prefecture) or (len(place) > 5 and place[2] == prefecture[2] and damerau(place[:3], prefecture, 1) <= 1):
        place = place[len(prefecture) :]
    elif len(place) > 6 and place[3] == prefecture[2] and damerau(place[:4], prefecture, 1) <= 1:
        place = place[4:]
    known = g.towns.get(code, set())
    if written_town(place) in known:
        name, town = "", written_town(place)
    else:
        name, rest = _strip_like(place, g.names)
        town = written_town(rest)
    city = code or g.municipality.get(name, "")
    by_postal = g.by_postal.get(own, ("", ""))
    city = city or by_postal[0]
    if not city:
        return None
    settled = g.settle(city, town) if town else ""
    if by_postal[0] == city and by_postal[1] and by_postal[1] != settled:
        # the code names another town: trust it where the text has none, or only a damaged or swapped spelling of it
        if not town or not settled or damerau(by_postal[1], town, 1) <= 1:
            settled = by_postal[1]
    return (city, town, numbers, settled) if town or settled else None


def postal_code(text: str | None, column: str | None) -> str:
    """Postal code written in an address, else the one of its own column; '' without."""
    m = _POSTAL.search(consistent_text(text).strip())
    return m.group(1) + m.group(2) if m else re.sub(r"\D", "", column or "")


def gazetteer_rows(towns: DataFrame) -> list[tuple]:
    """The fixed town list; refuses more than MAX_TOWNS rows."""
    cols = ["municipality_code", "municipality_name", "municipality_en", "town_name", "town_en", "postal_code"]
    rows = towns.select(*cols).distinct().limit(MAX_TOWNS + 1).collect()
    if len(rows) > MAX_TOWNS:
        raise ValueError(f"the gazetteer has more than {MAX_TOWNS} rows")
    return sorted((tuple(r) for r in rows), key=str)


def parsed(df: DataFrame, key: str, texts: list[str], detail: str | None, code: str, postal: str | None, rows: list[tuple]) -> DataFrame:
    """(key, city, town, numbers, settled, postal): one row per readable address text of a row; no shuffle."""
    cols = [F.col(key).cast("string").alias("key"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(texts)]]
    cols += [(F.col(c) if c else F.lit(None).cast("string")).alias(a) for c, a in ((detail, "detail"), (code, "code"), (postal, "postal"))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        g = Gazetteer(rows)
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                for i in range(len(texts)):
                    if p := parse(getattr(r, f"t{i}"), r.detail, municipality_code(r.code), r.postal, g):
                        out.append((r.key, *p, postal_code(getattr(r, f"t{i}"), r.postal)))
            yield pd.DataFrame(out, columns=["key", "city", "town", "numbers", "settled", "postal"])

    return df.select(*cols).mapInPandas(run, "key string, city string, town string, numbers string, settled string, postal string")


Form = tuple[str, str, str, str, str]  # form, city, numbers, town, settled


def same_place(a: Form, b: Form, likeness: float) -> bool:
    """Strict municipality and numbers; equal settled towns, or, where one isn't settled, towns that are written alike."""
    if a[1] != b[1] or a[2] != b[2]:
        return False
    return a[4] == b[4] if a[4] and b[4] else town_likeness(a[3], b[3]) >= likeness


def _neighbourhoods(forms: DataFrame, orders: list[list[Column]], window: int, likeness: float) -> DataFrame:
    """(form, form_b) of the pairs that match within ``window`` places of any of the sort orders. Every order is one range shuffle; a
    partition slides its window by itself, and the ends of the partitions (twice the window of each) are compared in one small task."""
    n = max(1, int(forms.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ends = "form string, city string, numbers string, town string, settled string, form_b string, part int, at int, pass int"
    names = ["form", "city", "numbers", "town", "settled"]

    def slide(number: int):
        def table(rows: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(rows, columns=[c.split()[0] for c in ends.split(", ")])

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            part, at = TaskContext.get().partitionId(), 0
            before: deque[Form] = deque(maxlen=window)
            for pdf in batches:
                out: list[tuple] = []
                for row in pdf[names].itertuples(index=False, name=None):
                    out += [(row[0], None, None, None, None, o[0], part, at, number) for o in before if same_place(row, o, likeness)]
                    if at < window:
                        out.append((*row, None, part, at, number))
                    before.append(row)
                    at += 1
                yield table(out)
            last = list(before)[max(0, 2 * window - at) :] if at > window else []  # without those that were among the first
            yield table([(*row, None, part, at + k, number) for k, row in enumerate(last)])

        return run

    found = None
    for number, order in enumerate(orders):
        keyed = forms.select(*names, F.concat_ws("\u0001", *order).alias("sort_key"))
        one = keyed.repartitionByRange(n, "sort_key", "form").sortWithinPartitions("sort_key", "form").mapInPandas(slide(number), ends)
        found = one if found is None else found.union(one)
    found = cut(found)

    def over_borders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = sorted((r for pdf in batches for r in pdf[["pass", "part", "at", *names]].itertuples(index=False, name=None)), key=lambda r: (r[0], r[1], r[2]))
        out = []
        for k, r in enumerate(rows):
            out += [(r[3], o[3]) for o in rows[max(0, k - window) : k] if o[0] == r[0] and o[1] != r[1] and same_place(r[3:], o[3:], likeness)]
        yield pd.DataFrame(out, columns=["form", "form_b"])

    border = found.filter("form_b is null").repartition(1).mapInPandas(over_borders, "form string, form_b string")
    return found.filter("form_b is not null").select("form", "form_b").union(border)


def left_out(town: str) -> list[str]:
    """The town with up to two letters left out: towns at most two edits apart share one."""
    return sorted({"".join(c) for n in range(min(2, len(town)) + 1) for c in combinations(town, len(town) - n)})


def _unsettled_pairs(forms: DataFrame) -> DataFrame:
    """All pairs of an unsettled form and another of the same house numbers and municipality that may be alike, however many there are."""

    @F.pandas_udf("array<string>")
    def keys(s: pd.Series) -> pd.Series:
        return s.map(left_out)

    here = forms.join(forms.filter("settled = ''").select("numbers", "city").distinct(), ["numbers", "city"], "left_semi")
    keyed = here.select("numbers", "city", "form", "town", "settled", F.explode(keys("town")).alias("_k"))
    a, b = keyed.filter("settled = ''"), keyed.select("numbers", "city", "_k", *[F.col(c).alias(f"{c}_b") for c in ("form", "town", "settled")])
    return a.join(b, ["numbers", "city", "_k"]).filter("form <> form_b").select("form", "town", "settled", "form_b", "town_b", "settled_b").distinct()


def matching_forms(forms: DataFrame, window: int = WINDOW, likeness: float = LIKENESS) -> DataFrame:
    """(form, form_b) of the pairs that are one place."""
    forms = forms if "postal" in forms.columns else forms.withColumn("postal", F.lit(""))
    town = F.when(F.col("settled") != "", F.col("settled")).otherwise(F.col("town"))
    letters = F.array_join(F.array_sort(F.split("town", "")), "")
    post = F.when(F.col("postal") != "", F.col("postal")).otherwise(F.col("city"))
    orders = [[town, F.col("numbers"), F.col("city"), F.col("town")], [F.col("numbers"), F.col("city"), F.reverse("town")], [post, F.col("numbers"), F.col("town")], [F.col("city"), F.col("numbers"), letters]]
    near = _neighbourhoods(forms, orders, window, likeness)

    @F.pandas_udf("double")
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([town_likeness(x, y) for x, y in zip(a, b)], dtype="float64")

    far = _unsettled_pairs(forms).filter((F.col("settled") == "") | (F.col("settled_b") == "")).filter(score("town", "town_b") >= likeness)
    return near.union(far.select("form", "form_b")).distinct()


def places(addresses: DataFrame) -> DataFrame:
    """(key, place) of parsed addresses; equal place means the same postal address."""
    form = F.concat_ws("|", "city", "numbers", "town", "settled")
    rows = cut(addresses.withColumn("form", form))
    forms = cut(rows.groupBy("form", "city", "numbers", "town", "settled").agg(F.max("postal").alias("postal")))
    joined = connected_components(matching_forms(forms), "form", "form_b")
    return rows.join(joined, rows["form"] == joined["node"], "left").select("key", F.coalesce("component", "form").alias("place")).distinct()


def pairs_within(members: DataFrame, group: list[str], key: str) -> DataFrame:
    """All (key_a, key_b) of a group with key_a < key_b, the form the result is defined in. The join is on the group, and a hot group
    is split by adaptive skew handling; groups of one are dropped first."""
    size = members.groupBy(*group).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    several = members.join(size, group, "left_semi")
    a = several.select(*group, F.col(key).alias("key_a"))
    b = several.select(*group, F.col(key).alias("key_b"))
    return a.join(b, group).filter("key_a < key_b")
