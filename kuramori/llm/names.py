"""Variant spellings of typed names, linked by merge-and-rematch resolution.

A name is read into a *profile*: what must agree strictly (municipality, kind of facility or owner, branch, piece of a set), a core
that people misspell, the parts of the core, and its initials (the shortened forms by which people call it).

*Blocking proves the pair.* A block key is made so that two spellings sharing it are known to be variants: equal text, equal text
but for one letter left out at the same position (a wrong letter), at the next one (swapped neighbours) or on one side only (a missing
or doubled letter), equal letters in any order but one, and so on. So no pair within a block is ever compared or listed: every
block is a star, or a chain of neighbours. Looser keys (``loose_keys``) are made only for the spellings that share a *gate* (the
same place; the same type and site, or type and thing) with another one.

*Merge and rematch.* Spellings with a common key are merged (connected components). A merged profile unites all its spellings, whose
keys stay in their blocks, and all its initials, and gains a consensus spelling made of the most frequent spelling of every part. The
richer profiles enter blocking again: by the keys of their consensus, and by their initials, of which a short form joins the one
profile it can stand for. The rounds go on until nothing merges; each takes at least one profile away, so they end.

Texts with equal profiles are one node from the start, so that copies, however many, cost nothing. Defined results: null, empty and
purely decorative texts have no profile; equal texts are the same node; names over ``LONG`` letters are compared whole, but by one
slip at most."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import combinations

import ahocorasick
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kuramori.llm.address import municipality_code
from kuramori.llm.canonical import folded
from kuramori.llm.uniform import consistent_text
from kuramori.operators.components import connected_components
from kuramori.session import cut

LONG = 24  # letters of a core (or of a part of it) up to which two slips are tried
# Kinds of facilities; the ways their names end, and the contracted endings used with the first letters of a name.
FACILITY_KINDS = {
    "美術館": "美術館 美術ミュージアム artmuseum",
    "科学館": "科学館 サイエンス館 科学センター",
    "民俗博物館": "民俗博物館 民俗ミュージアム 民俗博",
    "音楽記念館": "音楽記念館 音楽メモリアル 音楽館",
    "文学館": "文学館 文学ミュージアム 文学資料館",
    "郷土資料館": "郷土資料館 郷土資料センター 郷土資料室",
    "水族園": "水族園 水族館 アクアリウム",
    "植物園": "植物園 ボタニカルガーデン 植物公園",
}
CONTRACTED = {"美館": "美術館", "科館": "科学館", "民館": "民俗博物館", "音館": "音楽記念館", "文館": "文学館", "郷館": "郷土資料館", "水館": "水族園", "植館": "植物園"}
BRANCHES = "別館 分館 新館 アネックス"
OPERATORS = r"^(?:(?:公益|一般)?(?:財団|社団)法人|\((?:公財|一財|公社|一社|財|社)\)|npo法人|特定非営利活動法人|東瀬都立|[^立\s]{1,6}[区市町村]立)"
# Kinds of owners by the end of the name, legal forms, and what is added to a name when addressing or representing it.
OWNER_KINDS = "神社 寺 学園 保存会 商店 教育委員会 講 家"
LEGAL_FORMS = r"^(?:宗教法人|学校法人|株式会社|有限会社|合資会社|個人|\((?:宗|学|株|有|財|社)\)|(?:公益|一般)?(?:財団|社団)法人)"
ADDRESSING = r"(?:様|氏|殿|代表役員|事務局|法人本部|宮司|住職)$"
# Pieces of a set, and counters after a property's name.
PIECES = "上巻 中巻 下巻 右隻 左隻 阿形 吽形 其一 其二 其三 其四 前篇 後篇"
COUNTERS = r"(?:[一二三四五六七八九十]+[幅躯棟基点口面冊通軸体株本件領]|一括|一具|一式|一双)$"
PLACES = "神社 講中 寺 村 家"

_KIND_OF = {folded(w): k for k, ws in FACILITY_KINDS.items() for w in ws.split()}
_KIND = re.compile("|".join(sorted(map(re.escape, [*_KIND_OF, *CONTRACTED]), key=len, reverse=True)))
_KIND_OF |= CONTRACTED
_BRANCH = re.compile("|".join(folded(b) for b in BRANCHES.split()))
_OPERATOR = re.compile(OPERATORS)
_LEGAL_END = re.compile(r"(?<=\S)[\s・]*(?:" + LEGAL_FORMS[4:-1] + ")$")
_LEGAL, _ADDRESSING, _COUNTER = re.compile(LEGAL_FORMS), re.compile(ADDRESSING), re.compile(COUNTERS)
_PIECE = re.compile("|".join(PIECES.split()))
_HAN = r"[一-鿿々]"

Profile = tuple[str, str, list[str], list[str], list[str], list[str]]  # strict part, core, parts, blocking keys, initials, gates


def leave_one_out(text: str) -> set[str]:
    """The text and the text with each character left out, also without doubled letters; longer texts one slip apart share one."""
    out = set()
    for t in (text, re.sub(r"(.)\1", r"\1", text)):
        out |= {t} | ({t[:i] + t[i + 1 :] for i in range(len(t))} if len(t) >= 4 else set())
    return out


def leave_out(text: str, n: int) -> set[str]:
    """The text with any ``n`` characters left out."""
    return {"".join(c) for c in combinations(text, max(0, len(text) - n))}


def undoubled(text: str) -> str:
    """Without the second of two equal neighbours."""
    return re.sub(r"(.)\1", r"\1", text)


def _brief(text: str) -> str:
    """The text, or the digest of a long one: keys of long texts would else grow with the square of their length."""
    return text if len(text) <= 2 * LONG else xxhash.xxh3_128_hexdigest(text)


def slip_keys(text: str) -> list[str]:
    """Keys of which two spellings at most one slip apart share one: ``C`` with the text, and ``~`` with the position of a letter left out
    before the text without it; the same without doubled letters. Which rows of a block are variants, ``_stars`` decides by position."""
    out: list[str] = []
    for t in dict.fromkeys((text, undoubled(text))):
        out.append(f"C{_brief(t)}")
        if len(t) >= 4:
            out += [f"~{i:06d}{_brief(t[:i] + t[i + 1 :])}" for i in range(len(t))]
    return list(dict.fromkeys(out))


def bag_keys(text: str) -> list[str]:
    """Keys of the letters in any order; two texts share one exactly if they differ by one letter at most."""
    t = "".join(sorted(text))
    return [f"B{_brief(k)}" for k in sorted({t} | ({t[:i] + t[i + 1 :] for i in range(len(t))} if len(t) >= 4 else set()))]


def _squeezed(text: str) -> str:
    """Without separators and the linking particle between ideographs."""
    s = re.sub(r"[\s・:,、/|]+", "", text)
    return re.sub(rf"(?<={_HAN})の(?={_HAN})", "", s)


def facility_profile(text: str, city: str, _kinds: object = None) -> Profile | None:
    """Strict part: municipality, kind and branch. Core: the name proper."""
    s = consistent_text(text).casefold().strip()
    s = re.sub(r"^(art|museum)\s+|\s+", lambda m: m.group() if m.group(1) else " ", s)
    inner = ""
    for m in re.finditer(r"\(([^()]*)\)", s):
        if re.fullmatch(rf"{_HAN}{{1,3}}", m.group(1)) and m.start():
            inner = m.group(1) if m.group(1) not in ("休館", "閉館", "一財", "公財") else inner
    s = re.sub(r"(?<=.)\([^()]*\)", " ", s).strip()
    while (cut_ := _OPERATOR.sub("", s).strip()) != s and cut_:
        s = cut_
    key = folded(s.replace("art museum", "artmuseum"))
    words = [folded(w) for w in re.split(r"[\s・:]+", s.replace("art museum", "artmuseum")) if w]
    hits = list(_KIND.finditer(key))
    if not hits:
        core = _squeezed(key)
        return (f"{city}||", core, [core], slip_keys(core), [], []) if core else None
    hit = max(hits, key=lambda m: (len(m.group()), m.start()))
    kind, contracted = _KIND_OF[hit.group()], hit.group() in CONTRACTED
    branch = _BRANCH.search(key)
    head, tail = key[: hit.start()], key[hit.end() :]
    if not head:  # the kind comes first: the name follows
        rest = [w for w in words if w]
        head = re.sub(rf"^{re.escape(hit.group())}", "", "".join(w for w in rest[:2] if w)) if rest else ""
        head = _BRANCH.sub("", head) or _BRANCH.sub("", tail)
    link = head.endswith("の")
    core = _squeezed(_BRANCH.sub("", head)).rstrip("の")
    if inner and len(core) <= 4:
        core = inner + core
    if not core:
        return None
    strict = f"{city}|{kind}|{branch.group() if branch else ''}"
    if len(core) <= 3:
        ends = ["P", "S"] if link else ["S", "P"]
        return strict, core, [core], [f"A{core}"], [f"?{e}{core}{rank}" for rank, e in enumerate(ends)], []
    return strict, core, [core], [*slip_keys(core), f"B{_brief(''.join(sorted(core)))}"], [f"!P{core[:3]}", f"!S{core[-3:]}"], []


def owner_profile(text: str, _city: str = "", _kinds: object = None) -> Profile | None:
    """Strict part: kind of owner. Core: the name; a person's family name comes first."""
    s = consistent_text(text).casefold().strip().replace("會", "会")
    before = None
    while s != before:
        before = s
        s = _LEGAL.sub("", s).strip()
        s = _LEGAL_END.sub("", s).strip() or s
        if m := re.fullmatch(r"\((.*)\)", s):
            s = m.group(1).strip()
        s = _ADDRESSING.sub("", s).strip() or s
    s = re.sub(r"\([^()]*\)", "", s) or s
    parts = [p for p in re.split(r"[\s・:,、]+", s) if p]
    kind = ""
    for k in OWNER_KINDS.split():
        if parts and parts[-1].endswith(k):
            kind = k
        elif len(parts) > 1 and parts[0] == k:
            kind, parts = k, [*parts[1:], k]
        if kind:
            break
    if not parts:
        return None
    core = _squeezed("".join(parts))
    core = core[: -len(kind)] if kind and core.endswith(kind) and len(core) > len(kind) else core
    named, initials = [core], []
    if not kind and len(parts) == 2:
        a, b = (_squeezed(p) for p in parts)
        named = [a, b] if (len(a) <= len(b)) != (min(len(a), len(b)) == 1) else [b, a]  # a single letter stands for the given name
        initials = person_initials(*named) if len(a) != len(b) else []
        core = "".join(named)
    return f"|{kind}|", core, named, owner_keys(named, kind), initials, []


def person_initials(family: str, given: str) -> list[str]:
    """What a person's name answers to (family name and first letter), or asks for if no more than that is given."""
    if not family or not given:
        return []
    return [f"!I{family}・{given[0]}"] if len(given) > 1 else [f"?I{family}・{given}0"]


def owner_keys(named: list[str], kind: str) -> list[str]:
    """Keys of an owner: one slip in either order of the parts; of a person, also all letters in any order."""
    core = "".join(named)
    if kind == "教育委員会":
        return [f"C{_brief(core)}"]
    orders = dict.fromkeys([core, "".join(reversed(named))])
    keys = [k for o in orders for k in slip_keys(o)]
    return sorted({*keys, f"B{_brief(''.join(sorted(core)))}"} if not kind and len(core) >= 4 else set(keys))


class PropertyKinds:
    """Types of properties by every spelling of the reference list, as an automaton."""

    def __init__(self, entries: list[tuple[str, str]]) -> None:
        self.automaton, self.canonical = ahocorasick.Automaton(), {}
        for code, name in entries:
            if key := folded(name):
                self.canonical.setdefault(code, key)
                for k in {key, _squeezed(key)}:
                    if k not in self.automaton:
                        self.automaton.add_word(k, (len(k), code))
        if len(self.automaton):
            self.automaton.make_automaton()

    def last_longest(self, key: str) -> tuple[int, int, str] | None:
        """(start, end, code) of the longest mention, the last of equally long ones."""
        if not len(self.automaton):
            return None
        return max(((e - n + 1, e + 1, c) for e, (n, c) in self.automaton.iter(key)), key=lambda m: (m[1] - m[0], m[0]), default=None)


def property_profile(text: str, city: str, kinds: PropertyKinds) -> Profile | None:
    """Strict part: municipality and piece of a set. Core: place, object and type."""
    s = consistent_text(text).casefold().strip()
    inner = next((m.group(1) for m in re.finditer(r"\(([^()]*)\)", s) if re.search(_HAN, m.group(1))), "")
    s = re.sub(r"\([^()]*\)", " ", s)
    s = re.sub(r"^伝\s+", "", s)
    words = re.split(r"\s+", s)
    named = [w for w in words if re.search(_HAN, w) and not re.search(r"[ァ-ヺa-z]", w)]
    if "附" in named:
        at = named.index("附")
        counted = _COUNTER.search(named[at + 1]) if at + 1 < len(named) else None
        named = named[:at] + named[at + 2 :]
        del counted
    piece = ""
    if m := next((m for m in map(_PIECE.search, named) if m), None):  # before the counters, which may begin with the piece's number
        piece = m.group()
        named = [w.replace(piece, "", 1) for w in named]
    named = [_COUNTER.sub("", w) or w for w in named]
    whole = _squeezed("".join(named))
    if not whole:
        whole = folded(text)
        return (f"{city}||", whole, [whole], [f"C{_brief(whole)}"], [], []) if whole else None
    if not piece and (m := _PIECE.search(whole)):
        piece, whole = m.group(), whole[: m.start()] + whole[m.end() :]
        whole = _COUNTER.sub("", whole) or whole
    strict = f"{city}|{piece}|"
    hit = kinds.last_longest(whole)
    if hit and hit[1] - hit[0] < 2 and hit[1] != len(whole):
        hit = None  # a one-letter alias counts only at the end
    kind = kinds.canonical[hit[2]] if hit else ""
    rest = whole[: hit[0]] + whole[hit[1] :] if hit else whole
    rest += _squeezed(inner)
    keys = sorted({k for t in (rest, undoubled(rest)) for k in bag_keys(t + kind)})
    core = "".join(sorted(rest)) + "|" + kind
    place = re.search(rf"{_HAN}{{2,4}}?(?:{'|'.join(PLACES.split())})", rest)
    if hit and place:
        site, thing = place.group(), rest[: place.start()] + rest[place.end() :]
        if 2 <= len(thing) <= 5:
            gates = [f"T{hit[2]}|{x}" for x in _low(site, 3)] + [f"t{hit[2]}|{thing}"]
            return strict, core, [hit[2], site, thing], keys, [f"!I{hit[2]}|{site[0]}|{thing}"], sorted(gates)
    elif hit and 3 <= len(rest) <= 6:
        return strict, core, [rest + kind], keys, [f"?I{hit[2]}|{rest[0]}|{rest[1:]}0"], []
    return strict, core, [rest + kind], keys, [], []


def _low(text: str, n: int) -> set[str]:
    """The text and, if it is longer than ``n``, the text with each letter left out."""
    return {text} | ({text[:i] + text[i + 1 :] for i in range(len(text))} if len(text) > n else set())


def property_keys(code: str, site: str, thing: str) -> list[str]:
    """Looser keys of a property: a slip in the site and one in the thing, or two in one of them and none in the other."""
    keys = {f"T{code}|{a}|{b}" for a in _low(site, 3) for b in _low(thing, 2)}
    return sorted(keys | {f"U{code}|{a}|{thing}" for a in leave_out(site, 2)} | {f"V{code}|{site}|{b}" for b in leave_out(thing, 2)})


def place_cells(lon: str, lat: str, cell_deg: float = 0.002) -> Column:
    """Names of the grid cells around a place: two places much closer than a cell share at least one. Null for no place."""
    x, y = F.col(lon) / cell_deg, F.col(lat) / cell_deg
    cells = [F.concat_ws(":", F.floor(x + dx).cast("string"), F.floor(y + dy).cast("string"), F.lit(f"{i}{j}")) for i, dx in enumerate((0.0, 0.5)) for j, dy in enumerate((0.0, 0.5))]
    return F.when(F.coalesce(F.col(lon).between(120, 155) & F.col(lat).between(20, 50), F.lit(False)), F.array(*cells))


PROFILES: dict[str, Callable] = {"facility_name": facility_profile, "owner": owner_profile, "name": property_profile}


def supported_keys(core: str, places: list[str]) -> list[str]:
    """Looser keys of a facility (two slips, or one in a shortened name), valid only together with a common place."""
    if len(core) > LONG:
        return []
    loose = leave_out(undoubled(core), 2) if len(core) >= 5 else leave_out(core, 1)
    loose |= {core[-3:], *leave_out(core[-3:], 1)} if len(core) >= 3 else set()
    return [f"L{e}|{k}" for e in places for k in sorted(loose) if len(k) >= 2]


def loose_keys(field: str, core: str, parts: list[str], gates: list[str]) -> list[str]:
    """Keys of the spellings that share the given gates with another."""
    if field == "facility_name":
        return supported_keys(core, gates)
    return property_keys(*parts) if len(parts) == 3 else []


def consensus_keys(field: str, strict: str, parts: list[str]) -> list[str]:
    """All keys of a consensus spelling."""
    if field == "owner":
        return owner_keys(parts, strict.strip("|"))
    if field == "name" and len(parts) == 3:
        return property_keys(*parts)
    return []


def profiles(df: DataFrame, field: str, key: str, text: str, code: str | None, kind_entries: list[tuple[str, str]], evidence: str | None = None) -> DataFrame:
    """(field, key, node, strict, core, parts, keys, initials, gates) of every text with a profile; no shuffle. ``evidence`` is an array
    of places (grid cells) of the row: rows with a common one may differ by a second slip."""
    cols = [(F.col(evidence) if evidence else F.lit(None).cast("array<string>")).alias("evidence"), F.col(key).cast("string").alias("key"), F.col(text).alias("text"), (F.col(code) if code else F.lit(None).cast("string")).alias("code")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kinds, known = PropertyKinds(kind_entries), {}
        read = PROFILES[field]
        for pdf in batches:
            out = []
            for k, t, c, places in zip(pdf["key"], pdf["text"], pdf["code"], pdf["evidence"]):
                at = (t, c)
                if at not in known:
                    if len(known) > 50_000:
                        known.clear()
                    known[at] = read(t, municipality_code(c), kinds)
                if p := known[at]:
                    out.append((k, *p[:5], p[5] + (list(places) if places is not None else [])))
            yield pd.DataFrame(out, columns=["key", "strict", "core", "parts", "keys", "initials", "gates"])

    rows = df.filter(F.col(text).isNotNull() & (F.col(text) != "")).select(*cols)
    out = rows.mapInPandas(run, "key string, strict string, core string, parts array<string>, keys array<string>, initials array<string>, gates array<string>")
    node = F.unhex(F.md5(F.concat_ws("|", F.lit(field), "strict", "core")))  # 128 bits: the key itself, at a fixed length
    return out.select(F.lit(field).alias("field"), "key", node.alias("node"), "strict", "core", "parts", "keys", "initials", "gates")


def _blocks(keyed: DataFrame) -> DataFrame:
    """(node, k, at) of rows (node, field, strict, key); ``at`` is the position of the letter left out, -1 for a whole key."""
    slip = F.col("key").startswith("~")
    whole = F.when(slip, F.concat(F.lit("C"), F.substring("key", 8, 1 << 20))).otherwise(F.col("key"))
    at = F.when(slip, F.substring("key", 2, 6).cast("int")).otherwise(F.lit(-1))
    return keyed.select("node", F.xxhash64("field", "strict", whole).alias("k"), at.alias("at"))


def _stars(blocks: DataFrame) -> DataFrame:
    """(node, other) of proven variants, linear in the block whatever its size; one shuffle. A whole key links every row of its block to
    its first holder (a letter left out of the longer text gives the shorter one, whole keys are equal). A row with a letter left out is
    linked to the row before it if the position is the same (a wrong letter) or the next one (neighbours swapped, one perhaps wrong)."""
    order = Window.partitionBy("k").orderBy("at", "node")
    here = F.struct("at", "node")
    rows = blocks.repartition("k").withColumn("first", F.first(here).over(order)).withColumn("last", F.lag(here).over(order))
    held = F.when(F.col("first.at") == -1, F.col("first.node"))
    near = F.when((F.col("last.at") >= 0) & (F.col("last.at") >= F.col("at") - 1), F.col("last.node"))
    return rows.select("node", F.explode(F.array(held, near)).alias("other")).filter("other is not null and other <> node").distinct()


def _gated(profile: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, field, strict, key) of the loose keys of the nodes that share a gate with another node."""
    gates = profile.filter(F.size("gates") > 0).select("node", F.explode("gates").alias("gate"), F.xxhash64("field", "strict").alias("s")).distinct()
    shared = gates.groupBy("s", "gate").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a <> z").select("s", "gate")
    open_ = gates.join(shared, ["s", "gate"], "left_semi").groupBy("node").agg(F.collect_list("gate").alias("gates"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = [loose_keys(f, c, list(p), list(g)) for f, c, p, g in zip(pdf["field"], pdf["core"], pdf["parts"], pdf["gates"])]
            yield pdf[["node", "field", "strict"]].assign(keys=keys)

    found = nodes.join(open_, "node").select("node", "field", "strict", "core", "parts", "gates")
    return found.mapInPandas(run, "node binary, field string, strict string, keys array<string>").select("node", "field", "strict", F.explode("keys").alias("key"))


def _consensus(nodes: DataFrame, entity: DataFrame, changed: DataFrame) -> DataFrame:
    """(node, field, strict, key): keys of the spelling made of the most frequent spelling of every part, of each changed entity. The node
    is the entity's own. Counts only: no entity's spellings are ever gathered."""
    several = entity.join(changed, "entity", "left_semi").join(nodes.filter(F.size("parts") > 1), "node")
    long = several.select("entity", "field", "strict", F.size("parts").alias("n"), "rows", F.posexplode("parts").alias("pos", "part"))
    most = long.groupBy("entity", "field", "strict", "n", "pos", "part").agg(F.sum("rows").alias("rows")).groupBy("entity", "field", "strict", "n", "pos").agg(F.max_by("part", F.struct("rows", "part")).alias("part"))
    built = most.groupBy("entity", "field", "strict", "n").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "part"))), lambda x: x["part"]).alias("parts"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[["node", "field", "strict"]].assign(keys=[consensus_keys(f, s, list(p)) for f, s, p in zip(pdf["field"], pdf["strict"], pdf["parts"])])

    new = built.select(F.col("entity").alias("node"), "field", "strict", "parts").mapInPandas(run, "node binary, field string, strict string, keys array<string>")
    return new.select("node", "field", "strict", F.explode("keys").alias("key"))


def _called(entity: DataFrame, nodes: DataFrame) -> DataFrame:
    """(entity, target): short forms and the only profile, of all spellings merged so far, that answers to them."""
    known = entity.join(nodes.filter(F.size("initials") > 0).select("node", "field", "strict", "initials"), "node")
    marks = known.select("entity", F.explode("initials").alias("i"), "field", "strict").withColumn("k", F.xxhash64("field", "strict", F.regexp_replace(F.substring("i", 2, 1 << 20), "[01]$", ""))).withColumn("asks", F.col("i").startswith("?"))
    full = marks.filter("not asks").select("entity").distinct()
    rich = marks.filter("not asks").groupBy("k").agg(F.min("entity").alias("target"), F.max("entity").alias("_z")).filter("target = _z").drop("_z")
    short = marks.filter("asks").join(full, "entity", "left_anti").withColumn("rank", F.substring("i", -1, 1))
    return short.join(rich, "k").groupBy("entity").agg(F.min_by("target", F.struct("rank", "target")).alias("target")).filter("entity <> target")


def resolve(profile: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """(field, key, entity): equal entity means the same facility, property or owner. Goes on until nothing merges; with ``max_rounds``
    it raises if the last of them still merges."""
    for column in ("parts", "gates"):
        if column not in profile.columns:
            profile = profile.withColumn(column, F.array().cast("array<string>"))
    if dict(profile.dtypes)["node"] != "binary":
        profile = profile.withColumn("node", F.unhex(F.md5(F.col("node").cast("string"))))
    profile = cut(profile)
    nodes = cut(profile.groupBy("node").agg(*[F.first(c).alias(c) for c in ("field", "strict", "core", "parts", "initials", "keys")], F.count("*").alias("rows")))
    own = nodes.select("node", "field", "strict", F.explode("keys").alias("key"))
    blocks = _blocks(own.union(cut(_gated(profile, nodes))))
    entity, links, rounds = nodes.select("node", F.col("node").alias("entity")), _stars(blocks), 0
    while True:
        moves = cut(connected_components(links, "node", "other").withColumnRenamed("node", "entity"))
        entity = cut(entity.join(moves, "entity", "left").select("node", F.coalesce("component", "entity").alias("entity")))
        rounds += 1
        changed = moves.select(F.col("component").alias("entity")).distinct()
        fresh = _blocks(_consensus(nodes, entity, changed))
        met = blocks.join(fresh.select("k").distinct(), "k", "left_semi").join(entity, "node").select(F.col("entity").alias("node"), "k", "at")
        links = cut(_stars(fresh.union(met).distinct()).union(_called(entity, nodes).select(F.col("entity").alias("node"), F.col("target").alias("other"))))
        if links.isEmpty():
            break
        if rounds == max_rounds:
            raise ValueError(f"names still merge after {max_rounds} rounds")
    return profile.select("field", "key", "node").distinct().join(entity, "node").select("field", "key", F.hex("entity").alias("entity")).distinct()
