"""Filling containers of fixed capacity with whole items: vector bin packing with the dot-product heuristic.

An item has three sizes, each limited per container: tokens, segments (one per item) and loss-bearing tokens. A container is
opened with the largest item left and filled by taking, again and again, the fitting item with the largest dot product of its sizes
and the container's remaining room (both as shares of the limits, weighted by how scarce a dimension is overall, and damped by the
item's length to the power ``DAMPING``: undamped, the largest item always wins and the small ones are left over). Only an item above
the token limit is split, into full pieces and a rest. An item that exceeds the loss limit by itself is not split: it opens a
container, into which only items without loss may follow.

Scale: items are dealt by hash into shards of about ``SHARD`` items; shards are packed independently. Containers in which no
dimension is well filled are emptied and their items packed again in the next round, in fewer shards, so that waste stays at a few
containers. Every shard has a bounded number of items, whatever the input; hot sources are irrelevant, as the deal is by hash.

Defined results: items of size 0 and null texts are in no container; repeated keys count once (callers deduplicate);
each piece of a split item is placed like an item and keeps its position."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kuramori.session import cut, spread

SHARD = 1_000
WELL_FILLED = 0.985
ROUNDS = 2
SEGMENT_TOKENS, LOSS_SHARE = 200, 0.85
DAMPING = 0.85
DIMENSIONS = ("tokens", "segments", "loss_tokens")


@dataclass(frozen=True)
class Limits:
    """Limits of one kind of container."""

    tokens: int
    segments: int
    loss_tokens: int

    @classmethod
    def of(cls, capacity: int, segment_tokens: int = SEGMENT_TOKENS, loss_share: float = LOSS_SHARE) -> "Limits":
        """Three segments and one more for every ``segment_tokens`` tokens of capacity; ``loss_share`` of the tokens may bear loss."""
        return cls(capacity, 3 + capacity // segment_tokens, max(1, int(loss_share * capacity)))


def pack(sizes: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Container number of each item (n, dimensions; the first one is never exceeded, another only by an item alone in it). Deterministic."""
    n = len(sizes)
    home = np.full(n, -1)
    if not n:
        return home
    share = sizes / limits
    if (share[:, 0] > 1 + 1e-12).any():
        raise ValueError("an item exceeds the limits of the container")
    weight = share.sum(axis=0) / share.sum()  # scarce dimensions count more
    order = np.argsort(-(share @ weight), kind="stable")
    columns = [np.ascontiguousarray(c) for c in share[order].T]
    damped = np.sqrt((share[order] ** 2).sum(axis=1)) ** DAMPING
    left, container = np.arange(n), 0
    while len(left):
        taken, live = [left[0]], left[1:]
        room = np.array([1.0 - c[left[0]] for c in columns])
        while len(live):
            fits = columns[0][live] <= room[0] + 1e-12
            for c, r in zip(columns[1:], room[1:]):
                fits &= c[live] <= max(r, 0.0) + 1e-12
            live = live[fits]
            if not len(live):
                break
            worth = columns[0][live] * (room[0] * weight[0])
            for c, r, w in zip(columns[1:], room[1:], weight[1:]):
                worth += c[live] * (max(r, 0.0) * w)
            at = int((worth / damped[live]).argmax())
            best = live[at]
            taken.append(best)
            room -= [c[best] for c in columns]
            live = np.delete(live, at)
        home[order[taken]] = container
        container += 1
        left = left[~np.isin(left, taken, assume_unique=True)]
    return home


def pieces(sized: DataFrame, containers: DataFrame, key: str) -> DataFrame:
    """Every item once per kind of container, split where it exceeds the token limit: (container, capacity, key, piece, pieces, tokens, loss_tokens)."""
    pairs = sized.filter("tokens > 0").select(key, "tokens", "loss_tokens").join(F.broadcast(containers.select("container", "capacity_tokens").distinct()))
    n = F.ceil(F.col("tokens") / F.col("capacity_tokens")).cast("int")
    pairs = pairs.withColumn("pieces", n).withColumn("piece", F.explode(F.sequence(F.lit(1), n)))
    size = F.when(F.col("piece") < F.col("pieces"), F.col("capacity_tokens")).otherwise(F.col("tokens") - (F.col("pieces") - 1) * F.col("capacity_tokens")).cast("long")
    before = F.col("tokens") - F.col("loss_tokens")  # prompt tokens come first
    start = (F.col("piece") - 1) * F.col("capacity_tokens")
    loss = F.greatest(F.lit(0), size - F.greatest(F.lit(0), before - start)).cast("long")
    return pairs.select("container", F.col("capacity_tokens").alias("capacity"), key, "piece", "pieces", size.alias("size"), loss.alias("loss")).withColumnRenamed("size", "tokens").withColumnRenamed("loss", "loss_tokens")


def _pack_group(key: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([key, "piece"], kind="stable")
        capacity = int(pdf["capacity"].iloc[0])
        lim = Limits.of(capacity)
        sizes = np.column_stack([pdf["tokens"], np.ones(len(pdf)), pdf["loss_tokens"]]).astype(float)
        home = pack(sizes, np.array([lim.tokens, lim.segments, lim.loss_tokens], dtype=float))
        pdf["bin"] = [f"{pdf['stage'].iloc[0]}-{pdf['shard'].iloc[0]}-{b}" for b in home]
        for k, (name, limit) in enumerate(zip(DIMENSIONS, (lim.tokens, lim.segments, lim.loss_tokens))):
            pdf[f"{name}_fill"] = pd.Series(sizes[:, k]).groupby(home).transform("sum").to_numpy() / limit
        return pdf

    return run


def fill_containers(sized: DataFrame, containers: DataFrame, key: str, shard: int = SHARD, rounds: int = ROUNDS) -> DataFrame:
    """(container, capacity, key, piece, pieces, tokens, loss_tokens, bin, and the filled share of each limit of the bin): every item in
    exactly one container of each kind."""
    todo = cut(pieces(sized, containers, key))
    kinds = dict(todo.dtypes)
    schema = ", ".join(f"`{c}` {t}" for c, t in kinds.items()) + ", stage int, shard long, bin string, " + ", ".join(f"{d}_fill double" for d in DIMENSIONS)
    full = F.greatest(*[F.col(f"{d}_fill") for d in DIMENSIONS]) >= WELL_FILLED
    done: DataFrame | None = None
    for stage in range(rounds + 1):
        counts = todo.groupBy("container").agg(F.count("*").alias("_n"))
        shards = F.greatest(F.lit(1), F.ceil(F.col("_n") / shard)).cast("long")
        dealt = todo.join(F.broadcast(counts), "container").withColumn("stage", F.lit(stage)).withColumn("shard", F.pmod(F.xxhash64(F.col(key), "piece", F.lit(stage)), shards)).drop("_n")
        packed = cut(spread(dealt.select(*kinds, "stage", "shard"), "container", "shard").groupBy("container", "shard").applyInPandas(_pack_group(key), schema))
        if stage == rounds:
            good, todo = packed, None
        else:
            good, todo = packed.filter(full), packed.filter(~full).select(*kinds)
        good = good.drop("stage", "shard")
        done = good if done is None else done.union(good)
    return done


def fill_report(packed: DataFrame) -> DataFrame:
    """Per kind of container: containers used, the least possible number, tokens, the unused share, the mean filled share of the other
    limits, and how many containers were closed by which limit (the fullest one)."""
    fills = [f"{d}_fill" for d in DIMENSIONS]
    closed = F.when(F.col("tokens_fill") >= F.greatest(*fills), "tokens").when(F.col("loss_tokens_fill") >= F.greatest(*fills), "loss_tokens").otherwise("segments")
    bins = packed.groupBy("container", "capacity", "bin").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("segments"), *[F.max(c).alias(c) for c in fills]).withColumn("closed", closed)
    sums = [F.count("*").alias("bins"), F.sum("tokens").alias("tokens"), F.sum("segments").alias("segments"), F.max("tokens").alias("fullest"), F.avg("segments_fill").alias("segments_fill"), F.avg("loss_tokens_fill").alias("loss_tokens_fill")]
    out = bins.groupBy("container", "capacity").agg(*sums, *[F.count_if(F.col("closed") == d).alias(f"closed_by_{d}") for d in DIMENSIONS])
    return out.withColumn("least_bins", F.ceil(F.col("tokens") / F.col("capacity"))).withColumn("unused_share", 1 - F.col("tokens") / (F.col("bins") * F.col("capacity")))
