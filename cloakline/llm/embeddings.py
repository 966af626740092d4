"""Embedding near-dedup by collision counting over one-dimensional projections.

Unit vectors are projected on many random directions. Within a pair of blocks
each projection is sorted; the window of a query is the stretch of the order
within ``width`` of it, read as a bitmap, and bit-sliced counters add the
windows of all projections, 64 pairs a word. Pairs whose count passes a
threshold are verified by cosine in double precision. The threshold is the
largest that keeps ``recall`` of simulated pairs exactly at the least cosine.

Vectors with equal components are one class and are compared once. Blocks are
dealt by a hash and bounded, so no group of copies meets in one task; a task
returns how many vectors each class is linked with and a spanning forest of its
links, never the pairs. The number of block pairs grows with the square of the
table, which counting over windows can't avoid at this threshold.

Vectors that are null, empty, zero or hold null or non-finite components link
with nothing. Vectors of different lengths don't link. Repeated vec_ids are one
node, each row counts as a vector; a null vec_id is the node ``2**63 - 1``.
An empty table gives an empty result.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloakline.llm.common import NULL_ID, components, scratch

PROJECTIONS, WIDTH, RECALL, SEED = 32, 1.5, 0.9999, 3
#: Classes of a block, queries counted at once, pairs verified at once.
BLOCK, QUERIES, VERIFIED = 4096, 512, 1 << 15


def directions(d: int, m: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    """``m`` unit directions, orthogonal in runs of ``d``."""
    draw = np.random.default_rng([seed, d])
    runs = [np.linalg.qr(draw.standard_normal((d, d)))[0] for _ in range(-(-m // d))]
    return np.concatenate(runs, axis=1)[:, :m]


def calibrate(d: int, least: float, m: int = PROJECTIONS, recall: float = RECALL, seed: int = SEED):
    """(directions, half width of a window, least count)."""
    w = directions(d, m, seed)
    gap = np.sqrt(2 - 2 * least)
    half = WIDTH * gap / np.sqrt(d)
    draw = np.random.default_rng([seed, d, 1])
    seen = np.zeros(m + 1, np.int64)
    for _ in range(20):
        u = draw.standard_normal((10_000, d))
        u *= gap / np.linalg.norm(u, axis=1, keepdims=True)
        seen += np.bincount((np.abs(u @ w) <= half).sum(1), minlength=m + 1)
    kept = np.cumsum(seen[::-1])[::-1] / seen.sum()  # share of pairs with at least so many collisions
    return w, half, int(max(1, np.flatnonzero(kept >= recall)[-1]))


def counted(queries: np.ndarray, points: np.ndarray, half: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, point) with at least ``least`` window collisions."""
    (q, m), n = queries.shape, len(points)
    words = -(-n // 64)
    slices = np.zeros((int(m).bit_length(), q, words), np.uint64)
    for k in range(m):
        order = np.argsort(points[:, k], kind="stable")
        row = points[order, k]
        bits = np.zeros((n + 1, words), np.uint64)
        bits[np.arange(1, n + 1), order // 64] = np.uint64(1) << (order % 64).astype(np.uint64)
        np.bitwise_or.accumulate(bits, axis=0, out=bits)  # row r: the first r points in order
        low = np.searchsorted(row, queries[:, k] - half, "left")
        high = np.searchsorted(row, queries[:, k] + half, "right")
        for at in range(0, q, QUERIES):
            part = slice(at, at + QUERIES)
            carry = bits[high[part]] ^ bits[low[part]]
            for s in slices[:int(k + 1).bit_length(), part]:
                rest = s & carry
                s ^= carry
                carry = rest
    # Count >= least, from the highest bit down.
    more = np.zeros((q, words), np.uint64)
    equal = np.full((q, words), np.uint64(2**64 - 1))
    for bit in range(len(slices) - 1, -1, -1):
        s = slices[bit]
        if least >> bit & 1:
            equal &= s
        else:
            more |= equal & s
            equal &= ~s
    more |= equal
    a, w = np.nonzero(more)
    on = np.unpackbits(more[a, w].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    i, b = np.nonzero(on)
    return a[i], w[i] * 64 + b


def _block(least: float, m: int, recall: float, seed: int):
    kept: dict[int, tuple] = {}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        d = int(pdf["d"].iloc[0])
        if d not in kept:
            kept[d] = calibrate(d, least, m, recall, seed)
        w, half, count = kept[d]
        same = bool(pdf["i"].iloc[0] == pdf["j"].iloc[0])
        pdf = pdf.sort_values(["side", "node", "tie"])
        x = np.stack([np.asarray(v, np.float64) for v in pdf["v"]])
        x /= np.abs(x).max(1, keepdims=True)  # no overflow in the norms
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        node, mult = pdf["node"].to_numpy(np.int64), pdf["m"].to_numpy(np.int64)
        cut = len(x) if same else int((pdf["side"] == 0).sum())
        first = 0 if same else cut
        p = x @ w
        links, lows = np.zeros(len(x), np.int64), np.arange(len(x))
        if cut and len(x) > first:
            # The queries are the left block, the points the right one (or the same).
            a, b = counted(p[:cut], p[first:], half, count)
            b = b + first
            if same:
                a, b = a[a < b], b[a < b]
            good = [np.zeros(0, bool)]
            for at in range(0, len(a), VERIFIED):
                good.append((x[a[at:at + VERIFIED]] * x[b[at:at + VERIFIED]]).sum(1) >= least)
            good = np.concatenate(good)
            a, b = a[good], b[good]
            np.add.at(links, a, mult[b])
            np.add.at(links, b, mult[a])
            while True:  # smallest index reachable
                new = lows.copy()
                low = np.minimum(lows[a], lows[b])
                np.minimum.at(new, a, low)
                np.minimum.at(new, b, low)
                new = new[new]
                if (new == lows).all():
                    break
                lows = new
        on = links > 0
        return pd.DataFrame({"node": node[on], "tie": pdf["tie"].to_numpy()[on], "links": links[on],
                             "low": node[lows[on]]})

    return run


def near_vectors(vectors: DataFrame, least: float = 0.95, projections: int = PROJECTIONS, recall: float = RECALL,
                 seed: int = SEED) -> DataFrame:
    """``(vec_id, n_links, component_id)``, one row per row of ``vectors`` (``vec_id``, ``embedding``)."""
    v = F.col("embedding")
    sound = v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(
        "vec_id", F.coalesce(F.col("vec_id").cast("long"), F.lit(NULL_ID)).alias("_k"),
        F.when(F.coalesce(sound, F.lit(False)), v).alias("v"))
    rows = rows.withColumn("tie", F.xxhash64("v"))
    # One class for equal vectors; `tie` tells classes apart whose smallest ids agree.
    classes = scratch(rows.where("v IS NOT NULL").groupBy("v").agg(
        F.min("_k").alias("node"), F.count("*").alias("m"), F.first("tie").alias("tie")), "vec-classes")
    n = classes.groupBy(F.size("v").alias("d")).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = classes.withColumn("d", F.size("v")).join(F.broadcast(n), "d").withColumn(
        "own", F.pmod(F.xxhash64(F.lit(seed), "node", "tie"), "blocks"))
    both = dealt.select(
        "d", "node", "m", "tie", "v", "own",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")).select(
        "d", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "m", "tie", "v")
    found = scratch(both.groupBy("d", "i", "j").applyInPandas(
        _block(least, projections, recall, seed), "node long, tie long, links long, low long"), "vec-links")
    total = found.groupBy("node", "tie").agg(F.sum("links").alias("links"))
    comp = components(found, "node", "low")
    cls = classes.join(total, ["node", "tie"], "left").join(comp, "node", "left").select(
        "v", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"))
    return rows.join(cls, "v", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "_k").alias("component_id"))


def dedup(vectors: DataFrame, least: float = 0.95) -> DataFrame:
    """``vectors`` with one vector of each component: the one with the smallest vec_id."""
    gone = near_vectors(vectors, least).where("component_id <> vec_id").select(F.col("vec_id").alias("_g")).distinct()
    rows = vectors.select(F.struct("*").alias("row"))
    return rows.join(gone, F.expr("row.vec_id = _g"), "left_anti").select("row.*")
