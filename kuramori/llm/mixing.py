"""Mixing sources to target weights by cube-method balanced sampling.

The largest total size is found for which no source needs more repetitions than allowed; it gives each source a number of uses
per document, a whole part and a fraction. The fraction is an inclusion probability, and the sample is drawn by the cube method:
probabilities move through the null space of the balancing constraints (tokens and documents of the source) until they are 0 or 1.
The flight runs in shards of a source (any document undecided at the end of a shard goes on to the next round, in fewer shards), so a
source of any size is spread over the cluster and only the landing, about ``LANDING`` documents per source, is decided at one place,
for tokens and documents together.

Defined results: documents of size 0 are never used; sources without a target are left out, targets without documents are reported
with share 0 and the others are scaled to what they can reach; the same seed gives the same mix."""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kuramori.session import cut, spread

SHARD = 20_000
LANDING = 400
EPS = 1e-9
MAX_ROUNDS = 40


def flight(prob: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move inclusion probabilities until at most two (the number of constraints) are fractional; sums of probability and of
    probability times size stay as they were. Linear in the number of documents."""
    p = prob.astype(float).copy()
    free = [k for k in range(len(p)) if EPS < p[k] < 1 - EPS]
    draws = rng.random(len(free) + 1)
    window, at, step = free[:3], 3, 0
    while len(window) == 3:
        a, b, c = window
        # null vector of the rows (1, 1, 1) and (size): their cross product
        u = np.array([size[c] - size[b], size[a] - size[c], size[b] - size[a]])
        if not u.any():
            u = np.array([1.0, -1.0, 0.0])
        q = p[window]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(u > 0, (1 - q) / u, np.where(u < 0, -q / u, np.inf)).min()
            down = np.where(u > 0, q / u, np.where(u < 0, (q - 1) / u, np.inf)).min()
        move = up if draws[step] < down / (up + down) else -down
        step += 1
        p[window] = np.clip(q + move * u, 0.0, 1.0)
        stay = [k for k in window if EPS < p[k] < 1 - EPS]
        new = free[at : at + 3 - len(stay)]
        at += len(new)
        window = stay + new
    return np.where(p < EPS, 0.0, np.where(p > 1 - EPS, 1.0, p))


def landing(prob: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Decide the last fractional documents (as many as there are constraints) together: of all ways to take or leave them, the one
    in which tokens and number of documents deviate least, each relative to a mean document."""
    p = flight(prob, size, rng)
    open_ = [k for k in range(len(p)) if EPS < p[k] < 1 - EPS]
    mean = size.mean() if len(size) else 1.0

    def off(take: tuple[int, ...]) -> float:
        change = [t - p[k] for t, k in zip(take, open_)]
        return abs(sum(c * size[k] for c, k in zip(change, open_))) / mean + abs(sum(change))

    for k, take in zip(open_, min(product((1, 0), repeat=len(open_)), key=off)):
        p[k] = float(take)
    # what is left of the tokens' deviation is met by exchanging documents for others, one for one, which keeps their number
    ours = np.array([k for k in range(len(p)) if EPS < prob[k] < 1 - EPS], dtype=int)
    excess = float(((p - prob) * size)[ours].sum())
    while True:
        used, rest = ours[p[ours] == 1.0], ours[p[ours] == 0.0]
        if not len(used) or not len(rest):
            return p
        after = excess - (size[used][:, None] - size[rest][None, :])
        a, b = np.unravel_index(int(np.abs(after).argmin()), after.shape)
        if abs(after[a, b]) >= abs(excess) - 0.5:
            return p
        p[used[a]], p[rest[b]], excess = 0.0, 1.0, float(after[a, b])


def plan(sized: DataFrame, targets: DataFrame, source: str = "source") -> DataFrame:
    """Per source: documents, tokens, target share, uses per document, from one aggregation over all documents."""
    totals = sized.filter("tokens > 0").groupBy(source).agg(F.count("*").alias("documents"), F.sum("tokens").alias("tokens"))
    t = F.broadcast(targets.groupBy(source).agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")))
    per = t.join(totals, source, "left").na.fill(0, ["documents", "tokens"]).filter("target_share > 0")
    whole = per.agg(F.min(F.when(F.col("tokens") > 0, F.col("max_repeats") * F.col("tokens") / F.col("target_share"))).alias("total"))
    uses = F.when(F.col("tokens") > 0, F.least(F.col("max_repeats").cast("double"), F.col("target_share") * F.col("total") / F.col("tokens"))).otherwise(0.0)
    return per.join(F.broadcast(whole)).withColumn("uses", uses).drop("total")


def _fly(final: bool, seed: int, columns: list[str]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # large documents first: those still undecided at the end are small, so the landing costs little balance
        pdf = pdf.sort_values(["tokens", "_at"], ascending=[False, True], kind="stable")
        rng = np.random.default_rng([seed, int(pdf["_shard"].iloc[0]) & 0x7FFFFFFF, len(pdf)])
        move = landing if final else flight
        pdf["prob"] = move(pdf["prob"].to_numpy(), pdf["tokens"].to_numpy(dtype=float), rng)
        return pdf[columns]

    return run


def balanced_mix(sized: DataFrame, targets: DataFrame, key: str, source: str = "source", seed: int = 7, shard: int = SHARD, landing_size: int = LANDING) -> DataFrame:
    """(key, source, tokens, uses) of the documents used at least once."""
    per = F.broadcast(plan(sized, targets, source).select(source, F.col("uses").alias("_u")))
    items = sized.filter("tokens > 0").select(key, source, "tokens").join(per, source)
    whole = F.floor(F.col("_u") + EPS).cast("int")
    items = cut(items.select(key, source, "tokens", whole.alias("base"), F.greatest(F.lit(0.0), F.col("_u") - whole).alias("prob")))
    columns = items.columns
    schema = ", ".join(f"`{c}` {t}" for c, t in items.dtypes)
    undecided = f"prob > {EPS} and prob < {1 - EPS}"
    settled = items.filter(f"not ({undecided})")
    # some documents of every source, chosen by hash, stay out of the flights: with them the landing has enough to balance with
    total = F.broadcast(items.filter(undecided).groupBy(source).agg(F.count("*").alias("_n")))
    kept = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 30)) < F.lit(landing_size / 2 * (1 << 30)) / F.col("_n")
    split = cut(items.filter(undecided).join(total, source).withColumn("_kept", kept).select(*columns, "_kept"))
    reserve, todo = split.filter("_kept").select(*columns), split.filter("not _kept").select(*columns)
    for stage in range(MAX_ROUNDS):
        counts = todo.groupBy(source).agg(F.count("*").alias("_n"))
        final = (counts.agg(F.max("_n")).first()[0] or 0) <= max(landing_size, 3)
        if final:
            todo = todo.union(reserve)
            counts = todo.groupBy(source).agg(F.count("*").alias("_n"))
        shards = F.lit(1).cast("long") if final else F.greatest(F.lit(1), F.ceil(F.col("_n") / shard)).cast("long")
        mixed = F.xxhash64(F.col(key), F.lit(seed), F.lit(stage))
        dealt = todo.join(F.broadcast(counts), source).withColumn("_shard", F.pmod(mixed, shards)).withColumn("_at", F.xxhash64(mixed)).drop("_n")
        flown = cut(spread(dealt, source, "_shard").groupBy(source, "_shard").applyInPandas(_fly(final, seed, columns), schema))
        settled = settled.union(flown.filter(f"not ({undecided})"))
        if final:
            break
        todo = flown.filter(undecided)
    else:
        raise RuntimeError(f"documents are undecided after {MAX_ROUNDS} rounds")
    return settled.select(key, source, "tokens", (F.col("base") + F.round("prob").cast("int")).alias("uses")).filter("uses > 0")


def mix_report(mix: DataFrame, sized: DataFrame, targets: DataFrame, source: str = "source") -> DataFrame:
    """Target and actual share of each source in all tokens of the mix."""
    got = mix.groupBy(source).agg(F.sum(F.col("tokens") * F.col("uses")).alias("mixed_tokens"), F.count("*").alias("documents_used"), F.max("uses").alias("most_uses"))
    total = F.broadcast(got.agg(F.sum("mixed_tokens").alias("_total")))
    out = plan(sized, targets, source).join(F.broadcast(got), source, "left").join(total).na.fill(0, ["mixed_tokens", "documents_used", "most_uses"])
    return out.select(source, "documents", F.col("tokens").alias("source_tokens"), "target_share", "max_repeats", "documents_used", "most_uses", "mixed_tokens", (F.col("mixed_tokens") / F.col("_total")).alias("actual_share"))
