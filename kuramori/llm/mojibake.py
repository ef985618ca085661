"""Text read in a wrong encoding: found, and restored by minimum description length.

A *chain step* writes text back with the wrong charset and reads the bytes with the right one. Per line, every step is tried on
the stretches of the line whose bytes form valid sequences of the right charset, so a line may be damaged in part. A candidate's
description length is its size after compression with per-language zstandard dictionaries (the best language counts), plus the
cost of characters no language model has seen, plus the cost of the chain. Stretches are compressed with their surroundings; the rest
of the line is the same before and after. The shortest description wins and the search goes on from there (double damage) for as long
as it gets shorter; where nothing is shorter than the text as it stands, the line is left unchanged. Bytes already lost to U+FFFD stay
lost, but for punctuation with one possible reading in the models. A text that keeps lost, control or private-use characters is reported
as damaged though not (wholly) restored, if its description is shorter without them.

All texts are screened in one pass, by the characters a damaged line can't do without (``leads``), then by patterns (``_gate``); it also
counts the characters of the texts that pass, which are the seen ones. Only texts with a suspicious line are examined. The dictionaries
are fitted to at most ``SAMPLE_DOCS`` passages per language, distinct ones from anywhere in the texts, chosen by their hash and
themselves without any candidate. Every document is examined whole. Defined results: null and empty texts are undamaged."""

from __future__ import annotations

import codecs
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kuramori.session import cut, spread

SAMPLE_DOCS = 500  # per language, after the hash order
SAMPLE_CHARS = 4_000  # of a passage, for the dictionaries alone
DICTIONARY_BYTES = 112_640
CHAIN_BITS, STEP_BITS, UNSEEN_BITS, MIN_GAIN_BITS = 10, 6, 14, 8
CONTEXT = 24  # undamaged characters on either side that are compressed with a stretch
STEPS = (
    ("cp1252", "utf-8"), ("mac_roman", "utf-8"), ("cp437", "utf-8"), ("cp850", "utf-8"), ("cp1251", "utf-8"), ("cp932", "utf-8"), ("gb18030", "utf-8"),
    ("cp1252", "cp932"), ("cp932", "euc_jp"), ("cp1252", "euc_jp"), ("gb18030", "cp932"), ("mac_roman", "cp932"), ("cp437", "cp932"), ("cp1251", "cp932"),
)
# Sequences a stretch must have before it is a candidate, where clean text of the wrong charset has such sequences by chance.
MIN_RUN = {("cp1252", "cp932"): 4, ("mac_roman", "cp932"): 4, ("cp437", "cp932"): 4, ("cp1251", "cp932"): 4, ("cp1252", "euc_jp"): 4, ("cp932", "euc_jp"): 3, ("gb18030", "cp932"): 8}
_WESTERN = re.compile("[\u0000-ſ‐-›€™�]*")
SEQUENCE = {
    "utf-8": re.compile(rb"(?:[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2})"),
    "cp932": re.compile(rb"[\x81-\x9f\xe0-\xfc][\x40-\x7e\x80-\xfc]"),
    "euc_jp": re.compile(rb"[\xa1-\xf4][\xa1-\xfe]"),
}
# Residue of the escape-sequence charset when the escapes themselves were dropped: two-byte sets are switched on and off in plain sight.
_ESCAPED = re.compile(r"\x1b?\$[@B]((?:[!-~]{2})+)\x1b?\([BJ]")
LOST = "�"
_CERTAIN = re.compile("[\u0080-\u009f-�\U000f0000-\U0010fffd]")
_CJK = re.compile("[⺀-鿿가-힣豈-﫿]")


@lru_cache(maxsize=200_000)
def _bytes_of(ch: str, charset: str) -> bytes | None:
    """Bytes a wrong reader turned into this character; bytes undefined in a single-byte charset pass through as controls."""
    try:
        return ch.encode(charset)
    except UnicodeEncodeError:
        return bytes([ord(ch)]) if charset.startswith("cp12") and ord(ch) < 0x100 else None


def _stand_in(through: bool):
    """Error handler of the single-byte charsets: 0 for a lost character, a control for itself where it passes through, else 1."""

    def handle(e: UnicodeEncodeError) -> tuple[bytes, int]:
        return bytes(0 if c == LOST else ord(c) if through and ord(c) < 0x100 else 1 for c in e.object[e.start : e.end]), e.end

    return handle


codecs.register_error("kuramori_through", _stand_in(True))
codecs.register_error("kuramori_stop", _stand_in(False))


def _written(text: str, wrong: str) -> tuple[bytes, Sequence[int]]:
    """Bytes of a text in the wrong charset, and the character each byte belongs to."""
    if wrong not in ("cp932", "gb18030"):
        return text.encode(wrong, "kuramori_through" if wrong.startswith("cp12") else "kuramori_stop"), range(len(text))
    data, owner = bytearray(), []
    for k, ch in enumerate(text):
        b = b"\x00" if ch == LOST else _bytes_of(ch, wrong) or b"\x01"
        data += b
        owner += [k] * len(b)
    return bytes(data), owner


def _bridges(gap: bytes, right: str) -> bool:
    """Whether bytes between two valid sequences may belong to the same damaged stretch: digits and the like, or lost bytes."""
    if b"\x01" in gap or len(gap) > 12:
        return False
    rest = re.sub(rb"[ -~]", b"", gap)
    return not rest or b"\x00" in rest and len(rest) <= 4 or right == "utf-8" and len(rest) <= 1


@lru_cache(maxsize=None)
def _gate(wrong: str, right: str) -> re.Pattern:
    """A cheap test on the characters themselves that no damaged line fails: leading bytes of ``right`` text, as ``wrong`` shows
    them, followed by trailing ones (single-byte charsets), or dense enough (double-byte ones). Clean lines mostly fail it."""
    if (wrong, right) == ("cp932", "euc_jp"):
        return re.compile(r"(?:[\uff61-\uff9f\ue000-\uf8ff\ufffd].?){3}")
    lead = {"utf-8": range(0xC2, 0xF5), "cp932": (*range(0x81, 0xA0), *range(0xE0, 0xFD)), "euc_jp": range(0xA1, 0xF5)}[right]
    trail = {"utf-8": range(0x80, 0xC0), "cp932": (*range(0x40, 0x7F), *range(0x80, 0xFD)), "euc_jp": range(0xA1, 0xFF)}[right]
    if wrong in ("cp932", "gb18030"):
        strong = range(0xE2, 0xEA) if right == "utf-8" else lead
        chars = "".join(re.escape(chr(c)) for c in range(0x80, 0x10000) if not 0xD800 <= c < 0xE000 and (b := _bytes_of(chr(c), wrong)) and len(b) <= 2 and b[0] in strong)
        weak = r"\ufffd" + ("\uff83" if wrong == "cp932" else "\u8117-\u8137\u8305")
        return re.compile(f"(?:[{chars}].{{0,3}}){{3}}|[A-Za-z ][{chars}{weak}]|[{chars}{weak}][A-Za-z ]" if right == "utf-8" else f"(?:[{chars}].){{3}}")
    shown = lambda byte: _shown(byte, wrong)
    a, z = (f"[{''.join(sorted({re.escape(x) for b in bs for x in shown(b)}))}]" for bs in (lead, trail))
    return re.compile(f"{a}(?:{z}|\ufffd)" if right == "utf-8" else f"(?:{a}{z}){{3}}")


def _shown(byte: int, charset: str) -> list[str]:
    """The characters that stand for a byte; a byte above ASCII may also pass through as a control."""
    out = [chr(byte)] if charset.startswith("cp12") else []
    try:
        return [*out, bytes([byte]).decode(charset)]
    except UnicodeDecodeError:
        return out or [chr(byte)]


@lru_cache(maxsize=None)
def leads(wrong: str, right: str) -> frozenset[str]:
    """Characters one of which every stretch of this step has: most clean lines have none, which a look at their letters tells."""
    return frozenset(chr(c) for c in range(0x80, 0x10000) if not 0xD800 <= c < 0xE000 and _is_lead(chr(c), wrong, right))


def _is_lead(ch: str, wrong: str, right: str) -> bool:
    if (wrong, right) == ("cp932", "euc_jp"):
        return "\uff61" <= ch <= "\uff9f" or "\ue000" <= ch <= "\uf8ff" or ch == LOST
    if wrong in ("cp932", "gb18030") and right == "utf-8" and (ch == LOST or ch in "\uff83\u8305" or "\u8117" <= ch <= "\u8137"):
        return True
    b = _bytes_of(ch, wrong)
    lead = {"utf-8": range(0xC2, 0xF5), "cp932": (*range(0x81, 0xA0), *range(0xE0, 0xFD)), "euc_jp": range(0xA1, 0xF5)}[right]
    return bool(b) and b[0] in lead


def _short_is_plausible(text: str, a: int, z: int, restored: str, wrong: str) -> bool:
    """One or two sequences are a candidate only as western letters or punctuation, and for double-byte charsets, whose
    ideographs look like such sequences by chance, only beside ASCII letters."""
    if not _WESTERN.fullmatch(restored):
        return False
    return wrong not in ("cp932", "gb18030") or any(c.isascii() and (c.isalpha() or c == " ") for c in (text[a - 1 : a], text[z : z + 1], text[a:z][-1:]) if c)


def escaped(text: str) -> list[tuple[int, int, str]]:
    """(start, end, restored) of the parts that are text of the escape-sequence charset, with or without the escapes."""
    out = []
    for m in _ESCAPED.finditer(text):
        try:
            out.append((m.start(), m.end(), (b"\x1b$B" + m.group(1).encode("ascii") + b"\x1b(B").decode("iso2022_jp")))
        except UnicodeDecodeError:
            continue
    return out


def suspicious(line: str) -> bool:
    """Whether any step could apply to a line, or characters are certainly lost."""
    if line.isascii():
        return bool(_ESCAPED.search(line))
    present = set(line)
    return any(not leads(*s).isdisjoint(present) and bool(_gate(*s).search(line)) for s in STEPS) or bool(_CERTAIN.search(line)) or bool(_ESCAPED.search(line))


def stretches(text: str, wrong: str, right: str, present: set[str] | None = None) -> list[tuple[int, int, str]]:
    """(start, end, restored) of the parts of ``text`` that are valid ``right`` text read as ``wrong``; ``present`` are its characters."""
    if leads(wrong, right).isdisjoint(text if present is None else present) or not _gate(wrong, right).search(text):
        return []
    raw, owner = _written(text, wrong)
    runs: list[list[int]] = []  # first byte, end byte, sequences
    for m in SEQUENCE[right].finditer(raw):
        if runs:
            gap = raw[runs[-1][1] : m.start()]
            if _bridges(gap, right):
                runs[-1][1:] = [m.end(), runs[-1][2] + 1]
                continue
        runs.append([m.start(), m.end(), 1])
    out = []
    for first, end, count in runs:
        if right == "utf-8":  # a sequence cut short by a lost byte belongs to the run before it
            if tail := re.match(rb"[\xc2-\xf4][\x80-\xbf]{0,2}\x00", raw[end:]):
                end += len(tail.group())
        a, z = owner[first], owner[end - 1] + 1
        while first and owner[first - 1] == a:
            first -= 1
        while end < len(raw) and owner[end] == z - 1:
            end += 1
        restored = _read(raw[first:end], right)
        if restored is None or restored == text[a:z] or LOST in restored and LOST not in text[a:z]:
            continue
        if count < MIN_RUN.get((wrong, right), 1) or count < 3 and not _short_is_plausible(text, a, z, restored, wrong):
            continue
        out.append((a, z, restored))
    if right == "utf-8" and LOST in text:
        out += [x for x in _cut_short(text, raw, owner) if all(x[1] <= o[0] or x[0] >= o[1] for o in out)]
    return sorted(out)


def _cut_short(text: str, raw: bytes, owner: list[int]) -> Iterator[tuple[int, int, str]]:
    for m in re.finditer(rb"(?:[\xc2-\xc3]|\xe2\x80)\x00", raw):
        yield owner[m.start()], owner[m.end() - 1] + 1, LOST + m.group()[:-1].hex() + LOST


def _read(data: bytes, right: str) -> str | None:
    try:
        return data.decode(right)
    except UnicodeDecodeError:
        text = data.replace(b"\x00", b"\xff").decode(right, errors="replace")
        lost = text.count(LOST)
        return text if lost <= 0.35 * len(text) else None


@dataclass
class Model:
    """Per-language compressors and the characters seen in their samples."""

    dictionaries: dict[str, bytes]
    seen: Counter[str] = field(default_factory=Counter)
    level: int = 12

    def __post_init__(self) -> None:
        self.packers = []
        for data in self.dictionaries.values():
            d = zstandard.ZstdCompressionDict(data)
            d.precompute_compress(level=self.level)
            self.packers.append(zstandard.ZstdCompressor(level=self.level, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))
        self.plain = zstandard.ZstdCompressor(level=self.level, write_checksum=False, write_content_size=False)

    def bits(self, text: str) -> int:
        """Description length of a text in the language that suits it best."""
        data = text.encode("utf-8", errors="replace")
        size = min(len(p.compress(data)) for p in self.packers or [self.plain])
        return 8 * size + UNSEEN_BITS * sum(c not in self.seen for c in text)

    def punctuation(self, restored: str) -> str:
        """A sequence cut short by a lost byte, as the most frequent character of the models that begins like it."""

        def pick(m: re.Match) -> str:
            start = bytes.fromhex(m.group(1))
            fits = [(n, c) for c, n in self.seen.items() if c.encode("utf-8", "replace").startswith(start) and len(c.encode("utf-8", "replace")) == len(start) + 1]
            return max(fits)[1] if fits else LOST

        return re.sub(f"{LOST}(c[23]|e280){LOST}", pick, restored)


def _windows(text: str, spans: list[tuple[int, int, str]]) -> tuple[str, str]:
    """The stretches with some context, as they stand and as restored; overlapping contexts are joined."""
    before, after, at = [], [], 0
    for k, (a, z, new) in enumerate(spans):
        start = max(at, a - CONTEXT)
        stop = min(len(text), z + CONTEXT, spans[k + 1][0] if k + 1 < len(spans) else len(text))
        before.append(text[start:stop])
        after.append(text[start:a] + new + text[z:stop])
        at = stop
    return "".join(before), "".join(after)


def restore_line(line: str, model: Model) -> tuple[str, list[str]]:
    """(line, chain) of least description length. Every step shortens the description by ``MIN_GAIN_BITS`` at least, so the search ends."""
    chain: list[str] = []
    while True:
        best: tuple[int, str, str] | None = None
        present = set(line)
        found = [("us-ascii", "iso2022_jp", escaped(line))] + [(w, r, stretches(line, w, r, present)) for w, r in STEPS]
        for wrong, right, parts in found:
            if not parts:
                continue
            spans = [(a, z, model.punctuation(new)) for a, z, new in parts]
            before, after = _windows(line, spans)
            gain = model.bits(before) - model.bits(after) - STEP_BITS - (0 if chain else CHAIN_BITS)
            if gain >= MIN_GAIN_BITS and (best is None or gain > best[0]):
                out, at = [], 0
                for a, z, new in spans:
                    out += [line[at:a], new]
                    at = z
                best = gain, "".join([*out, line[at:]]), f"{wrong}>{right}"
        if best is None:
            return line, chain
        line = best[1]
        chain.append(best[2])


def keeps_damage(line: str, model: Model) -> bool:
    """Whether a line has lost, control or private-use characters without which its description is shorter; no chain is claimed or paid."""
    if not (spans := [(m.start(), m.end(), "") for m in _CERTAIN.finditer(line)]):
        return False
    before, after = _windows(line, spans)
    return model.bits(before) - model.bits(after) >= MIN_GAIN_BITS


def restore(text: str | None, model: Model) -> tuple[str | None, str, str]:
    """(restored text, chains joined by ";", status): ``clean``, ``restored``, ``partly_restored`` or ``lost``."""
    if not text or text.isascii() and not _ESCAPED.search(text):
        return text, "", "clean"
    lines, chains, left = [], [], False
    for line in text.split("\n"):
        fixed, chain = restore_line(line, model) if suspicious(line) else (line, [])
        lines.append(fixed)
        chains += [c for c in ["+".join(chain)] if c and c not in chains]
        left = left or keeps_damage(fixed, model)
    status = ("partly_restored" if left else "restored") if chains else ("lost" if left else "clean")
    return "\n".join(lines), ";".join(chains), status


def has_candidate(text: str) -> bool:
    """True where any step could apply, or characters are certainly lost: such a text never enters a dictionary."""
    return bool(_CERTAIN.search(text)) or any(escaped(line) or (not line.isascii() and any(stretches(line, w, r) for w, r in STEPS)) for line in text.split("\n"))


def passages(text: str) -> list[str]:
    """The whole text in pieces of at most ``SAMPLE_CHARS`` characters."""
    return [text[i : i + SAMPLE_CHARS] for i in range(0, len(text), SAMPLE_CHARS)]


def _copies(documents: DataFrame, text: str) -> DataFrame:
    """(t, n): one of each group of equal texts, and how many too many there are. Only digests are shuffled to find the groups."""
    digest = F.xxhash64(text)
    several = documents.select(digest.alias("h")).groupBy("h").agg(F.count("*").alias("n")).filter("n > 1")
    return documents.select(digest.alias("h"), F.col(text).alias("t")).join(several, "h").groupBy("h", "n").agg(F.min("t").alias("t")).select("t", (F.col("n") - 1).alias("n"))


def screen(documents: DataFrame, key: str, text: str) -> DataFrame:
    """One pass over all texts, which stay where they are: (key, text) of those with a suspicious line, and (c, n), how often each
    character occurs in the others; equal texts count once."""
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        for pdf in batches:
            odd = []
            for k, t in zip(pdf["k"], pdf["t"]):
                if any(map(suspicious, t.split("\n"))):
                    odd.append((k, t, None, None))
                else:
                    seen.update(t)
            yield frame(odd)
        yield frame([(None, None, c, n) for c, n in seen.items()])

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["k", "t", "c", "n"], dtype=object)

    def too_many(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        for pdf in batches:
            for t, n in zip(pdf["t"], pdf["n"]):
                if not any(map(suspicious, t.split("\n"))):
                    seen.update({c: n * m for c, m in Counter(t).items()})
        yield frame([(None, None, c, -n) for c, n in seen.items()])

    filled = documents.filter(F.length(text) > 0)
    rows = filled.select(F.col(key).alias("k"), F.col(text).alias("t"))
    fields = f"k {kind}, t string, c string, n long"
    return rows.mapInPandas(run, fields).union(_copies(filled, text).mapInPandas(too_many, fields))


def fit(documents: DataFrame, text: str = "text", lang: str = "lang", screened: DataFrame | None = None) -> tuple[dict[str, bytes], dict[str, int]]:
    """Dictionaries from a bounded sample of distinct passages per language, and the characters of all texts that were found clean on
    screening; the sample and as many rows as there are different characters come to the driver."""
    screened = screen(documents, text, text) if screened is None else screened
    seen = {r["c"]: r["n"] for r in screened.filter("c is not null").groupBy("c").agg(F.sum("n").alias("n")).collect()}

    @F.pandas_udf("array<string>")
    def parts(s: pd.Series) -> pd.Series:
        return s.map(passages)

    whole = documents.filter(F.col(lang).isNotNull() & (F.length(text) > 0)).select(F.col(lang).alias("_l"), F.col(text).alias("_t"))
    piece = whole.select("_l", F.explode(parts("_t")).alias("_p")).withColumn("_h", F.xxhash64("_p"))
    # copies have one hash and one rank: only hashes are ranked, and the passages of the chosen ones fetched once each
    ranked = piece.select("_l", "_h").distinct().withColumn("_n", F.row_number().over(Window.partitionBy("_l").orderBy("_h"))).filter(F.col("_n") <= 2 * SAMPLE_DOCS)
    chosen = piece.join(ranked.select("_l", "_h"), ["_l", "_h"], "left_semi").groupBy("_l", "_h").agg(F.min("_p").alias("_p"))
    few = sorted(chosen.collect(), key=lambda r: (r["_l"], r["_h"]))
    by: dict[str, list[str]] = {}
    for r in few:
        own = by.setdefault(r["_l"], [])
        if len(own) < SAMPLE_DOCS and not has_candidate(r["_p"]):
            own.append(r["_p"])
    out = {}
    for language, texts in sorted(by.items()):
        lines = [p.encode() for t in texts for p in re.split(r"(?<=[。.!?])|\n", t) if p]
        if not lines:
            continue
        try:
            out[language] = zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, lines)) // 8), lines).as_bytes()
        except zstandard.ZstdError:  # too little to train on: the sample itself is the dictionary
            out[language] = b"\n".join(lines)[:DICTIONARY_BYTES]
    return out, seen


def restored_documents(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, status, chains, restored) of the documents that are damaged, wholly or in part."""
    screened = cut(screen(documents, key, text))
    dictionaries, seen = fit(documents, text, lang, screened)
    kind = documents.schema[key].dataType.simpleString()

    def examine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Model(dictionaries, Counter(seen))
        for pdf in batches:
            rows = [(k, status, chains, fixed) for k, t in zip(pdf["k"], pdf["t"]) for fixed, chains, status in [restore(t, model)] if status != "clean"]
            yield pd.DataFrame(rows, columns=[key, "status", "chains", "restored"])

    return spread(screened.filter("t is not null").select("k", "t")).mapInPandas(examine, f"`{key}` {kind}, status string, chains string, restored string")
