"""Matching the entities of two tables that share no key, each match with a confidence.

1. Every row becomes tokens of its attributes: letters and letter pairs of the name, kind, municipality, town and house numbers, grid
   cells of the position. Rows equal in all of them are one node. Tokens are hashed into a number of buckets derived from how many there are.
2. Random walks record -> token -> record -> token ... start at every record. Each step draws anew among all records of the token and all
   tokens of the record: the records of a token lie in slots of about ``SLOT``, a step is an equi-join on (token, drawn slot), which
   also spreads hot tokens. Skip-gram vectors of the tokens are trained on the walks of all records.
3. A row's vector is the weighted mean of its tokens' vectors, in three views: name, place, and the letters of the name in any order.
   Rows are blocked by hyperplane hashing with several tables per view, of as many bits as keep a bucket's size the same at any number of
   rows; municipality, kind and branch are part of the block key; the smaller table also probes the buckets behind its least certain bits.
   An equi-join on strict keys adds every pair the exact comparison can accept, so that no match depends on the tables' sizes.
4. Candidates are reranked exactly: strict kind and branch, edit-tolerant name, distance, address, municipality.
5. The cosines are calibrated on a bounded sample of candidates, each against evidence it does not use: the cosine of the names against
   agreeing or contradicting places, that of the places against equal or unlike names. A pair whose exact score isn't 0 is a match
   if the confidence, from exact score and calibrated cosines together, is at least ``ACCEPT``.

Defined results: rows without name and place match nothing; things that only serve a facility never match; equal rows match equally."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kuramori.llm.address import Gazetteer, municipality_code, parse, written_town
from kuramori.llm.names import facility_profile, leave_one_out, leave_out
from kuramori.llm.uniform import consistent_text
from kuramori.session import cut, discard, spread

LEAST_BUCKETS, MOST_BUCKETS = 1 << 12, 1 << 18  # of tokens: twice as many as tokens, within these; bounds the vectors' table
WALKS, STEPS, SLOT, DIMENSIONS = 4, 3, 4, 24
WINDOW, NEGATIVES, RATE, MINIBATCH = 3, 3, 0.05, 8_192
TRAINERS = 64  # tasks that train, each with a table of vectors of its own: bounds what their average shuffles
TABLES, PROBES, PER_BUCKET = (5, 4, 5), 3, 8  # tables per view (name, place, letters of the name in any order); rows per bucket aimed at
CALIBRATION_PAIRS = 20_000
ACCEPT = 0.5
NEAR_M, FAR_M = 250.0, 700.0
AT_M, BESIDE_M = 45.0, 150.0  # an unnamed element at a listing, or beside it
# Words of things that serve or surround a facility, and uses of an element that isn't a facility itself.
SERVES = re.compile(r"駐車場|駐輪場|バス停|案内板|案内所|売店|トイレ|便所|喫煙所|停留所|前\s*$|入口交差点|ポスト")
OTHER_USES = {"parking", "bicycle_parking", "bus_stop", "bus_station", "shop", "cafe", "restaurant", "information", "toilets", "library", "community_centre", "school", "bench"}
FIELDS = "side string, id string, city string, strict string, core string, short boolean, town string, numbers string, lon double, lat double, name_tokens array<int>, place_tokens array<int>, served boolean"


def bucket(token: str) -> int:
    """Number of a token; stable over processes. ``match`` reduces it to the number of buckets."""
    return xxhash.xxh32_intdigest(token) & 0x7FFFFFFF


def place_tokens(city: str, town: str, numbers: str, lon: float | None, lat: float | None) -> list[str]:
    """Tokens of municipality, address and position."""
    out = [f"city={city}"] if city else []
    if town:
        out.append(f"town={town}")
    if numbers:
        out += [f"no={numbers}", f"at={town}{numbers}"]
    if lon is not None:
        cell = 0.004
        out += [f"cell{i}{j}={math.floor(lon / cell + i / 2)}:{math.floor(lat / cell + j / 2)}" for i in (0, 1) for j in (0, 1)]
    return out


def name_tokens(strict: str, core: str) -> list[str]:
    """Tokens of kind, branch, letter pairs and, as the last half, letters of a facility name."""
    if not core:
        return []
    out = [f"kind={strict}", f"end={core[-3:]}", f"begin={core[:3]}"] + [f"pair={core[i : i + 2]}" for i in range(len(core) - 1)]
    return out + [f"letter={c}" for c in core]


def features(df: DataFrame, side: str, columns: dict[str, str | None], towns: list[tuple]) -> DataFrame:
    """One row per key with parsed attributes and hashed tokens. ``columns`` names the source columns of id, name, city_code, city_name,
    address, address2, postal, lon, lat and use (None where a table lacks one)."""
    wanted = ["id", "name", "city_code", "city_name", "address", "address2", "postal", "lon", "lat", "use"]
    kinds = {"lon": "double", "lat": "double"}
    picked = [(F.col(columns[c]) if columns.get(c) else F.lit(None)).cast(kinds.get(c, "string")).alias(c) for c in wanted]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        g = Gazetteer(towns)
        everywhere = {t for ts in g.towns.values() for t in ts}
        for pdf in batches:
            yield pd.DataFrame([_row(side, r, g, everywhere) for r in pdf.itertuples(index=False)], columns=[f.split()[0] for f in FIELDS.split(", ")])

    rows = df.select(*picked).mapInPandas(run, FIELDS)
    w = Window.partitionBy("side", "id").orderBy(F.col("core").desc(), F.col("lon").desc_nulls_last())
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def _row(side: str, r: object, g: Gazetteer, everywhere: set[str]) -> tuple:
    code = municipality_code(r.city_code) or g.municipality.get(consistent_text(r.city_name).strip(), "")
    name = consistent_text(r.name)
    served = bool(SERVES.search(name)) or (r.use or "") in OTHER_USES
    p = facility_profile(name, "") if name.strip() and not served else None
    found = parse(r.address, None, code, r.postal, g) or parse(r.address2, None, code, r.postal, g)
    if found is None and not code and r.address:  # a town without its municipality: any town of that name will do
        options = [(c, parse(r.address, None, c, r.postal, g)) for c in sorted(g.towns)]
        exact = [x for c, x in options if x and x[1] in g.towns[c]]
        found = ("", exact[0][1], exact[0][2], exact[0][1]) if exact else None
    city, town, numbers = (code or found[0], written_town(found[3] or found[1]), found[2]) if found else (code, "", "")
    ok = r.lon is not None and r.lat is not None and 120 <= r.lon <= 155 and 20 <= r.lat <= 50
    lon, lat = (float(r.lon), float(r.lat)) if ok else (None, None)
    strict, core = (p[0], p[1]) if p else ("", "")
    a = [bucket(t) for t in name_tokens(strict, core)]
    b = [bucket(t) for t in place_tokens(city, town, numbers, lon, lat)]
    return side, r.id, city, strict, core, bool(p and len(core) <= 3), town, numbers, lon, lat, a, b, served


def walks(nodes: DataFrame, seed: int = 11) -> DataFrame:
    """Sentences of token numbers from WALKS random walks of each record. Draws are hashes, so that a lost task repeats them."""
    own = nodes.select(F.xxhash64("side", "id").alias("h"), F.explode(F.array_distinct(F.concat("name_tokens", "place_tokens"))).alias("token"))
    slots = own.groupBy("token").agg(F.ceil(F.count("*") / SLOT).cast("int").alias("slots"))
    edges = own.join(slots, "token")
    holders = cut(edges.groupBy("token", F.pmod(F.xxhash64("h", "token"), F.col("slots")).alias("slot")).agg(F.collect_list("h").alias("hs")))
    records = cut(edges.groupBy("h").agg(F.collect_list(F.struct("token", "slots")).alias("ts")))
    drawn = lambda items, *by: F.get(items, F.pmod(F.xxhash64(*by, F.lit(seed)), F.size(items)).cast("int"))
    own_first = F.slice(F.array_sort(F.transform("ts", lambda t: F.struct(F.xxhash64("h", "w", t["token"], F.lit(seed)).alias("r"), t.alias("t")))), 1, 3)
    at = records.withColumn("w", F.explode(F.sequence(F.lit(1), F.lit(WALKS)))).withColumn("s", F.transform(own_first, lambda x: x["t"]))
    at = at.select("h", "w", F.transform("s", lambda t: t["token"]).alias("path"), F.element_at("s", -1).alias("at"))
    for step in range(STEPS):
        here = at.select("h", "w", "path", F.col("at.token").alias("token"), F.pmod(F.xxhash64("h", "w", F.lit(step), F.lit(seed)), F.col("at.slots")).alias("slot"))
        met = here.join(holders, ["token", "slot"]).select("h", "w", "path", drawn(F.col("hs"), "h", "w", "token").alias("other"))
        at = met.join(records.select(F.col("h").alias("other"), "ts"), "other").withColumn("at", drawn(F.col("ts"), "h", "w", "other", F.lit(step)))
        at = at.select("h", "w", F.concat("path", F.array("at.token")).alias("path"), "at")
    return at.select(F.transform("path", lambda t: t.cast("string")).alias("walk"))


def _train(walk: np.ndarray, inner: np.ndarray, outer: np.ndarray, rng: np.random.Generator) -> None:
    """Skip-gram steps with negative sampling over all pairs of a block of walks (rows padded with -1); the vectors are changed in place."""
    pairs = [np.column_stack([walk[:, :-d].ravel(), walk[:, d:].ravel()]) for d in range(1, min(WINDOW, walk.shape[1] - 1) + 1)]
    pairs = np.concatenate([*pairs, *[p[:, ::-1] for p in pairs]])
    pairs = pairs[(pairs >= 0).all(axis=1)]
    rng.shuffle(pairs)
    for at in range(0, len(pairs), MINIBATCH):
        centre, near = pairs[at : at + MINIBATCH].T
        other = np.column_stack([near, rng.choice(near, (len(near), NEGATIVES))])  # the other ones as often as they occur
        v, u = inner[centre], outer[other]
        error = 1 / (1 + np.exp(-np.clip(np.einsum("nd,nkd->nk", v, u), -15, 15)))
        error[:, 0] -= 1.0
        for table, tokens, change in ((inner, centre, np.einsum("nk,nkd->nd", error, u)), (outer, other.ravel(), (error[:, :, None] * v[:, None, :]).reshape(-1, v.shape[1]))):
            once, where, count = np.unique(tokens, return_inverse=True, return_counts=True)
            total = np.zeros((len(once), v.shape[1]), dtype=np.float32)
            np.add.at(total, where, change)
            table[once] -= RATE * total / np.sqrt(count)[:, None]


def token_vectors(nodes: DataFrame, buckets: int, seed: int = 11) -> np.ndarray:
    """(buckets, DIMENSIONS) skip-gram vectors; zero rows for unused buckets. Every task trains on its share of the walks from the same
    start, as many tasks as there are partitions but at most ``TRAINERS``, as each shuffles a table; the vectors of a token are averaged by how often each task met it."""
    names = [f"v{i}" for i in range(DIMENSIONS)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        start = np.random.default_rng(seed)
        inner = (start.random((buckets, DIMENSIONS), dtype=np.float32) - 0.5) / DIMENSIONS
        outer, met = np.zeros_like(inner), np.zeros(buckets, dtype=np.int64)
        for pdf in batches:
            walk = np.full((len(pdf), STEPS + 3), -1, dtype=np.int64)
            for k, w in enumerate(pdf["walk"]):
                walk[k, : len(w)] = np.asarray(w, dtype=np.int64)
            met += np.bincount(walk[walk >= 0], minlength=buckets)
            _train(walk, inner, outer, start)
        used = np.flatnonzero(met)
        yield pd.DataFrame(inner[used], columns=names).assign(token=used.astype("int32"), n=met[used])

    sentences = walks(nodes, seed)
    sc = nodes.sparkSession.sparkContext
    tasks = min(TRAINERS, max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), sc.defaultParallelism))
    trained = sentences.repartition(tasks).mapInPandas(run, ", ".join(f"{c} float" for c in names) + ", token int, n long")
    # every task sends its table once, to be averaged: summing before the shuffle has nothing to combine and widens the rows
    mean = trained.repartition(tasks, "token").groupBy("token").agg(*[(F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(c) for c in names])
    out = np.zeros((buckets, DIMENSIONS), dtype=np.float32)
    for r in mean.toLocalIterator():  # as many rows as there are buckets in use
        out[r["token"]] = r[1:]
    return out


def token_weights(nodes: DataFrame, buckets: int, total: int) -> np.ndarray:
    """Inverse document frequency of every bucket over all rows."""
    tokens = nodes.select(F.explode(F.array_distinct(F.concat("name_tokens", "place_tokens"))).alias("t"))
    out = np.zeros(buckets, dtype=np.float32)
    for r in tokens.groupBy("t").count().toLocalIterator():
        out[r["t"]] = math.log((1 + total) / r["count"])
    return out


def _mean(tokens: list[int], vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    t = np.asarray(tokens, dtype=np.int64)
    v = (vectors[t] * weights[t][:, None]).sum(axis=0) if len(t) else np.zeros(DIMENSIONS, dtype=np.float32)
    n = np.linalg.norm(v)
    return v / n if n else v


def embed(nodes: DataFrame, vectors: np.ndarray, weights: np.ndarray, probing: str, bits: int, seed: int = 5) -> DataFrame:
    """Every row with its vectors of name and place and its bucket keys; rows of side ``probing`` also get the keys of their nearest
    other buckets."""
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    sc = nodes.sparkSession.sparkContext
    unit -= unit[weights > 0].mean(axis=0)
    shipped = sc.broadcast((unit, weights))
    del unit
    planes = np.random.default_rng(seed).normal(size=(3, max(TABLES), bits, DIMENSIONS)).astype(np.float32)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vec, wts = shipped.value
        powers = 1 << np.arange(bits, dtype=np.int64)
        for pdf in batches:
            names, places, ks = [], [], []
            for side, a, b in zip(pdf["side"], pdf["name_tokens"], pdf["place_tokens"]):
                na, nb = _mean(a, vec, wts), _mean(b, vec, wts)
                keys = []
                for view, v in enumerate((na, nb, _mean(a[len(a) // 2 + 1 :], vec, wts))):
                    if not v.any():
                        continue
                    margin = planes[view] @ v
                    code = (margin > 0) @ powers
                    for t in range(TABLES[view]):
                        flips = np.argsort(np.abs(margin[t]))[:PROBES] if side == probing else ()
                        keys += [(view << 58) | (t << 50) | int(code[t] ^ x) for x in (0, *(1 << int(k) for k in flips))]
                names.append(na.tolist())
                places.append(nb.tolist())
                ks.append(keys)
            yield pdf.assign(name_vector=names, place_vector=places, buckets=ks)

    return nodes.mapInPandas(run, FIELDS + ", name_vector array<float>, place_vector array<float>, buckets array<long>")


def same_name(a: str, b: str, a_short: bool, b_short: bool, supported: bool) -> float:
    """Likeness of two names proper: 1 equal, 0.9 one slip, 0.8 a shortened form, 0.6 two slips (only where the place supports it)."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    if len(a) > 3 and len(b) > 3 and leave_one_out(a) & leave_one_out(b):
        return 0.9
    if a_short != b_short:
        long, short = (b, a) if a_short else (a, b)
        if short in (long[:3], long[-3:]) or short in leave_one_out(long[-3:]):
            return 0.8
        if supported and leave_out(short, 1) & (leave_out(long[-3:], 1) | leave_out(long[:3], 1)):
            return 0.6
    common = max(3, max(len(a), len(b)) - 2)
    if supported and min(len(a), len(b)) >= max(4, common) and leave_out(a, len(a) - common) & leave_out(b, len(b) - common):
        return 0.6
    return 0.0


def pair_score(p: dict) -> float:
    """Exact score of a candidate pair; 0 where something strict disagrees. ``m_`` is the listing, ``o_`` the element."""
    if p["m_city"] and p["o_city"] and p["m_city"] != p["o_city"]:
        return 0.0
    distance = None
    if not any(math.isnan(p[c]) for c in ("m_lon", "m_lat", "o_lon", "o_lat")):
        distance = math.hypot((p["m_lat"] - p["o_lat"]) * 111_195, (p["m_lon"] - p["o_lon"]) * 111_195 * math.cos(math.radians(p["m_lat"])))
    address = None
    if p["m_numbers"] and p["o_numbers"]:
        address = p["m_numbers"] == p["o_numbers"] and (p["m_town"] == p["o_town"] or not p["m_town"] or not p["o_town"])
    if distance is not None and distance > FAR_M or address is False and not (distance is not None and distance < NEAR_M and p["m_core"] == p["o_core"]):
        return 0.0
    supported = bool(address) or (distance is not None and distance <= NEAR_M)
    if not p["o_core"]:  # an unnamed element: the place alone must speak for it
        if address and (distance is None or distance <= NEAR_M) or distance is not None and distance <= AT_M and address is not False:
            return 0.5
        return 0.4 if distance is not None and distance <= BESIDE_M and address is not False else 0.0
    if p["m_strict"] != p["o_strict"]:
        return 0.0
    name = same_name(p["m_core"], p["o_core"], p["m_short"], p["o_short"], supported)
    if not name or name < 0.9 and not supported and not p["m_city"] == p["o_city"]:
        return 0.0
    return name * (1.0 if supported else 0.85 if p["o_city"] else 0.75)


def _in_box(metres: float) -> Column:
    """Whether the places (m_x, m_y, o_x, o_y in hundred-thousandths of a degree) may be that near; null where one is missing."""
    dy, dx = F.abs(F.col("m_y") - F.col("o_y")), F.abs(F.col("m_x") - F.col("o_x"))
    y = metres / 1.11195 + 2
    return (dy <= y) & (dx <= y / math.cos(math.radians(50)) + 2)


def _near_enough(df: DataFrame) -> DataFrame:
    """Pairs whose places don't rule them out; a missing place rules out nothing."""
    return df.filter(F.coalesce(_in_box(FAR_M), F.lit(True))).select("m_h", "o_h")


def _placed(side: str) -> list[Column]:
    return [F.col("h").alias(f"{side}_h"), F.round(F.col("lon") * 1e5).cast("int").alias(f"{side}_x"), F.round(F.col("lat") * 1e5).cast("int").alias(f"{side}_y")]


def signature() -> Column:
    """The letters of a name as a set of 62 bits, with one more for a short form; 0 for an unnamed row."""
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(c), F.lit(62)).cast("int"))
    letters = F.aggregate(F.filter(F.split("core", ""), lambda c: c != ""), F.lit(0).cast("long"), lambda t, c: t.bitwiseOR(bit(c)))
    return F.when(F.col("core") == "", F.lit(0).cast("long")).when(F.col("short"), letters.bitwiseOR(F.lit(1 << 62))).otherwise(letters)


def comparable() -> Column:
    """False only where ``pair_score`` is 0, from signatures (m_s, o_s), hashed numbers (m_n, o_n) and places alone: names that ``same_name``
    likes lack at most two letters of each other, a short form one of the long name; an unnamed element lies beside or has the same numbers."""
    lacks = lambda a, b: F.bit_count(F.col(a).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseAND(F.bitwise_not(b)))
    m, o = lacks("m_s", "o_s"), lacks("o_s", "m_s")
    m_short, o_short = F.col("m_s") >= F.lit(1 << 62), F.col("o_s") >= F.lit(1 << 62)
    beside = F.coalesce(_in_box(BESIDE_M), F.lit(False)) | F.coalesce(F.col("m_n") == F.col("o_n"), F.lit(False))
    return F.when(F.col("o_s") == 0, beside).when(m_short & o_short, F.col("m_s") == F.col("o_s")).when(m_short, m <= 1).when(o_short, o <= 1).otherwise((m <= 2) & (o <= 2))


def candidates(embedded: DataFrame, left: str, right: str) -> DataFrame:
    """(m_h, o_h), perhaps repeated, of the rows that share a bucket and could pass the strict tests: municipality, kind and branch are
    part of the block key. A row without municipality meets those of all; an unnamed element meets everything in its place bucket. A bucket
    holds more unlike rows the more rows there are: pairs that can't score are dropped in the join, so none of them reaches the disk."""
    compared = embedded.withColumn("s", signature()).withColumn("n", F.when(F.col("numbers") != "", F.hash("numbers")))
    keyed = compared.select("side", "h", "city", "strict", "lon", "lat", "s", "n", F.explode("buckets").alias("b"))
    open_left = embedded.filter((F.col("side") == left) & (F.col("city") == "")).limit(1).count() > 0
    kind_of_left = F.when((F.shiftright("b", 58) == 1) & (F.col("strict") != ""), F.array("strict", F.lit(""))).otherwise(F.array("strict"))
    # a listing stands under its municipality and under "open", where elements without one ask; one without any stands under "all"
    city_of_left = F.when(F.col("city") != "", F.array("city", F.lit("open"))).otherwise(F.array(F.lit("all")))
    city_of_right = F.when(F.col("city") != "", F.col("city")).otherwise(F.lit("open"))
    a = keyed.filter(F.col("side") == left).withColumn("c", F.explode(city_of_left)).withColumn("kind", F.explode(kind_of_left))
    b = keyed.filter(F.col("side") == right).withColumn("c", F.explode(F.array(city_of_right, F.lit("all")) if open_left else F.array(city_of_right))).withColumn("kind", F.col("strict"))
    key = F.xxhash64("b", "c", "kind").alias("k")
    of = lambda df, s: df.select(key, *_placed(s), F.col("s").alias(f"{s}_s"), F.col("n").alias(f"{s}_n"))
    return _near_enough(of(a, "m").join(of(b, "o"), "k").filter(comparable()))


def distance_m() -> Column:
    """Metres between the places of a pair; null where one is missing."""
    dy, dx = (F.col("m_lat") - F.col("o_lat")) * 111_195, (F.col("m_lon") - F.col("o_lon")) * 111_195 * F.cos(F.radians("m_lat"))
    return F.hypot(dy, dx)


def same_address() -> Column:
    """Whether the addresses of a pair agree; null where one has no numbers."""
    towns = (F.col("m_town") == F.col("o_town")) | (F.col("m_town") == "") | (F.col("o_town") == "")
    return F.when((F.col("m_numbers") != "") & (F.col("o_numbers") != ""), (F.col("m_numbers") == F.col("o_numbers")) & towns)


def possible() -> Column:
    """The strict tests of ``pair_score`` as columns: false only where the score is 0. Only what passes goes to Python."""
    far = F.coalesce(distance_m() > FAR_M + 1, F.lit(False))
    city = (F.col("m_city") == F.col("o_city")) | (F.col("m_city") == "") | (F.col("o_city") == "")
    beside = F.coalesce(distance_m() <= BESIDE_M + 1, F.lit(False)) | F.coalesce(same_address(), F.lit(False))
    return city & ~far & F.when(F.col("o_core") == "", beside).otherwise(F.col("m_strict") == F.col("o_strict"))


def place_keys(side: str, town: str, numbers: str, lon: float | None, lat: float | None) -> list[str]:
    """Keys one of which two rows share if their addresses agree (a town may be missing on one side) or they lie within NEAR_M."""
    out = []
    if numbers:
        out += [f"no:{numbers}:{town}", f"m-open:{numbers}" if side == "o" or not town else "", f"o-open:{numbers}" if side == "m" or not town else ""]
    if lon is not None and lat is not None and not (math.isnan(lon) or math.isnan(lat)):
        h = NEAR_M / 111_195
        w = h / math.cos(math.radians(50))  # the widest circle of the place window
        x, y = math.floor(lon / w), math.floor(lat / h)
        around = (-1, 0, 1) if side == "o" else (0,)
        out += [f"at:{x + i}:{y + j}" for i in around for j in around]
    return [k for k in out if k]


def strict_keys(side: str, city: str, strict: str, core: str, short: bool, town: str, numbers: str, lon: float | None, lat: float | None) -> list[str]:
    """Keys one of which every pair with a ``pair_score`` shares: names equal or one slip apart, short forms within a municipality,
    agreeing places of one kind, and the places of unnamed elements."""
    places = place_keys(side, town, numbers, lon, lat)
    out = [f"u:{k}" for k in places] if side == "m" or not core else []
    if core:
        out += [f"p:{strict}:{k}" for k in places]
        out += [f"n:{strict}:{x}" for x in ({core} | leave_one_out(core) if len(core) > 3 else {core})]
        out += [f"s:{strict}:{city}:{x}" for x in ({core} if short else {core[:3], core[-3:]} | leave_one_out(core[-3:]))]
    return sorted(set(out))


def strict_candidates(rows: DataFrame, left: str, right: str) -> DataFrame:
    """Distinct (m_h, o_h) of the rows that share a strict key: all that the exact comparison can accept, whatever the hash tables find."""
    columns = ["side", "city", "strict", "core", "short", "town", "numbers", "lon", "lat"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = [[xxhash.xxh3_64_intdigest(k) - (1 << 63) for k in strict_keys(*r)] for r in pdf[columns].itertuples(index=False, name=None)]
            yield pdf[["side", "h", "city", "lon", "lat"]].assign(k=keys)

    keyed = rows.select("h", *columns).mapInPandas(run, "side string, h long, city string, lon double, lat double, k array<long>").withColumn("k", F.explode("k"))
    a = keyed.filter(F.col("side") == left).select("k", *_placed("m"), F.col("city").alias("m_c"))
    b = keyed.filter(F.col("side") == right).select("k", *_placed("o"), F.col("city").alias("o_c"))
    return _near_enough(a.hint("merge").join(b, "k").filter("m_c = o_c or m_c = '' or o_c = ''")).distinct()


def calibrate(cosine: np.ndarray, agree: np.ndarray) -> tuple[float, float]:
    """Logistic curve (slope, offset) from cosine to the share of pairs the exact comparison agrees with (Newton's method, ridge 1)."""
    x = np.column_stack([cosine, np.ones_like(cosine)])
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - agree) + np.array([1e-2, 1e-3]) * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-2, 1e-3])
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


def _fit(sample: list, cosine: str, label: str) -> tuple[float, float]:
    known = [(r[cosine], float(r[label])) for r in sample if r[cosine] is not None and r[label] is not None]
    return calibrate(np.array([x for x, _ in known]), np.array([y for _, y in known])) if known else (0.0, 0.0)


def match(listings: DataFrame, elements: DataFrame) -> DataFrame:
    """(m_id, o_id, cosine, score, confidence) of the pairs that are the same facility; inputs are ``features`` of sides m and o."""
    rows = listings.union(elements.filter("not served"))
    compared = ["side", "city", "strict", "core", "short", "town", "numbers", "lon", "lat"]
    alike = F.md5(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in compared]))
    rows = cut(spread(rows.withColumn("node", F.unhex(alike))))
    # rows that agree in everything compared are one node: copies, however many, are blocked and compared once
    names = [c.split()[0] for c in FIELDS.split(", ")]
    once = rows.groupBy("side", F.hex("node").alias("id"), F.col("node").alias("h")).agg(*[F.first(c).alias(c) for c in names if c not in ("side", "id")])
    token_count = rows.select(F.explode(F.concat("name_tokens", "place_tokens")).alias("t")).agg(F.approx_count_distinct("t")).first()[0]
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << (2 * token_count - 1).bit_length()))
    within = lambda c: F.transform(c, lambda t: F.pmod(t, F.lit(buckets)).cast("int")).alias(c)
    nodes = cut(spread(once.select(*[within(c) if c.endswith("_tokens") else F.col(c) for c in names])))
    total = nodes.count()
    vectors, weights = token_vectors(nodes, buckets), token_weights(nodes, buckets, total)
    discard(nodes)  # the walks' files
    bits = min(40, max(6, math.ceil(math.log2(max(1, total / PER_BUCKET)))))
    # numbered once and written: a number is a node, without collisions
    embedded = cut(embed(nodes, vectors, weights, "o", bits).withColumn("h", F.monotonically_increasing_id()))
    light = [c for c in compared if c != "side"]
    side = lambda s, cols: embedded.filter(F.col("side") == s).select(*[F.col(c).alias(f"{s}_{c}") for c in ["h", *cols]])
    strict = cut(strict_candidates(embedded, "m", "o"))
    with_attributes = lambda df: df.join(side("m", light), "m_h").join(side("o", light), "o_h")

    @F.pandas_udf("double")
    def score(df: pd.DataFrame) -> pd.Series:
        return pd.Series([pair_score(r) for r in df.to_dict("records")], dtype="float64")

    pairs = with_attributes(candidates(embedded, "m", "o").union(strict).distinct()).filter(possible())
    ranked = cut(pairs.select("m_h", "o_h", "m_core", "m_strict", "o_core", score(F.struct(*[f"{s}_{c}" for s in ("m", "o") for c in light])).alias("score")).filter("score > 0"))

    dot = lambda v: F.when(F.exists(f"m_{v}", lambda x: x != 0) & F.exists(f"o_{v}", lambda x: x != 0), F.aggregate(F.zip_with(f"m_{v}", f"o_{v}", lambda a, b: a * b), F.lit(0.0), lambda t, x: t + x.cast("double")))
    vectors_of = ["name_vector", "place_vector"]
    with_cosines = lambda df: df.join(side("m", vectors_of), "m_h").join(side("o", vectors_of), "o_h").withColumn("name_cosine", dot("name_vector")).withColumn("place_cosine", dot("place_vector"))
    # labels: places for the names' cosine, names for the places' cosine
    there = F.coalesce(same_address(), F.lit(False)) | F.coalesce(distance_m() <= AT_M, F.lit(False))
    elsewhere = F.coalesce(~same_address(), F.lit(False)) | F.coalesce(distance_m() > FAR_M, F.lit(False))
    common = F.size(F.array_intersect(F.split("m_core", ""), F.split("o_core", "")))
    named = (F.col("m_core") != "") & (F.col("o_core") != "")
    few = strict.orderBy(F.xxhash64("m_h", "o_h"), "m_h", "o_h").limit(CALIBRATION_PAIRS)
    labelled = with_attributes(few).withColumn("at_place", F.when(there & ~elsewhere, 1).when(elsewhere & ~there, 0)).withColumn("by_name", F.when(named & (F.col("m_core") == F.col("o_core")), 1).when(named & (common <= 1), 0))
    sample = with_cosines(labelled).select("name_cosine", "place_cosine", "at_place", "by_name").collect()  # the bounded calibration sample
    curves = {"name_cosine": _fit(sample, "name_cosine", "at_place"), "place_cosine": _fit(sample, "place_cosine", "by_name")}
    odds = [F.lit(a) * F.col(c) + F.lit(b) for c, (a, b) in curves.items()]
    both = F.when(F.col("name_cosine").isNull(), odds[1]).when(F.col("place_cosine").isNull(), odds[0]).otherwise((odds[0] + odds[1]) / 2)
    probability = F.coalesce(1 / (1 + F.exp(-both)), F.lit(0.0))
    # the exact comparison and the calibrated cosines are two witnesses: a match is wrong only if both are
    judged = with_cosines(ranked).withColumn("confidence", 1 - (1 - 0.9 * F.col("score")) * (1 - probability)).withColumn("cosine", (F.coalesce("name_cosine", "place_cosine") + F.coalesce("place_cosine", "name_cosine")) / 2)
    accepted = judged.filter(F.col("confidence") >= ACCEPT).select("m_h", "o_h", "m_core", "m_strict", "o_core", "cosine", "score", "confidence")
    # an unnamed element must point to one facility only, both where it stands and, for listings a little away, in the surroundings
    unnamed, found = accepted.filter("o_core = ''"), accepted.filter("o_core <> ''")
    several = lambda df: df.groupBy("o_h").agg(F.count_distinct("m_strict").alias("kinds"), F.count_distinct(F.substring("m_core", -2, 2)).alias("names")).filter("kinds > 1 or names > 2").select("o_h")
    at = unnamed.filter("score >= 0.5")
    beside = unnamed.filter("score < 0.5").join(several(unnamed), "o_h", "left_anti")
    found = found.unionByName(at.join(several(at), "o_h", "left_anti")).unionByName(beside)
    member = lambda s: rows.filter(F.col("side") == s).select(F.hex("node").alias("id"), F.col("id").alias(f"{s}_id")).join(embedded.filter(F.col("side") == s).select("id", F.col("h").alias(f"{s}_h")), "id").drop("id")
    return found.join(member("m"), "m_h").join(member("o"), "o_h").select("m_id", "o_id", "cosine", "score", "confidence")
