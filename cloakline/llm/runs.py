"""Periodic runs of words: where a text repeats a few words over and over.

A run is a stretch of words with smallest period q (words q apart are equal), at
least ``LEAST`` words and ``EXPONENT`` periods long, that no neighbouring word
extends. Each run has a Lyndon root: a period of it that is the longest Lyndon
word from its place, in the order of the words or in the reversed order. So:

* Baier's grouping (phase one of his suffix sorter) puts the suffixes of a text
  into groups by their longest Lyndon prefix, from the highest group down; the
  groups' lengths are the Lyndon array. It runs once for either order.
* A root of which three copies follow each other is extended to both sides by
  the longest common extensions of its two neighbouring copies.

Three words in a row occur at least three times within a run this long, at every
place of it. Stretches of text where they don't (found by hash counts over a
whole batch of texts) hold no part of a run and are left out of the sorting;
this loses nothing, as a run and the words next to it are compared whole.

Null and empty texts have no words and no runs. Rows are independent: repeated
rows get the same result, every other column passes through untouched.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST, EXPONENT = 6, 4
KIND = "struct<runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"


def words(text: str | Column) -> Column:
    """The words between white space, as an array; empty for null."""
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def lyndon(seq: list[int]) -> list[int]:
    """For each place the length of the longest Lyndon word that starts there (Baier's grouping).

    Groups are linked from high to low, at first one for each symbol. A processed
    group's members hand their word to the nearest place on the left that lies in
    a lower group; places that got k words leave their group for one just above it,
    above those that got fewer.
    """
    n = len(seq)
    symbols = sorted(set(seq))
    rank = {s: g for g, s in enumerate(symbols)}
    members: list[list[int]] = [[] for _ in symbols]
    group = [rank[s] for s in seq]
    for i, g in enumerate(group):
        members[g].append(i)
    length = [1] * len(symbols)
    below = [g - 1 for g in range(len(symbols))]
    above = [g + 1 for g in range(len(symbols))]
    up = list(range(n + 1))  # place i is node i + 1; a processed node points to its left, 0 is "none"
    out = [0] * n
    top = len(symbols) - 1
    while top >= 0:
        own = [i for i in members[top] if group[i] == top]
        size = length[top]
        for i in own:
            out[i] = size
            up[i + 1] = i
        got: dict[int, int] = {}
        for i in own:
            node = i
            while up[node] != node:
                up[node] = up[up[node]]
                node = up[node]
            if node:
                got[node] = got.get(node, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for node, k in got.items():
            moved.setdefault((k, group[node - 1]), []).append(node - 1)
        for k, low in sorted(moved, reverse=True):
            new, places = len(members), moved[k, low]
            members.append(places)
            length.append(length[low] + k * size)
            for i in places:
                group[i] = new
            over = above[low]
            below.append(low)
            above.append(over)
            above[low] = new
            below[over] = new  # at or below the processed group, so there is one
        top = below[top]
    return out


def reach(x: np.ndarray, a: int, b: int) -> int:
    """How many symbols from ``a`` and from ``b`` (behind it) on are equal."""
    at, step, n = 0, 32, len(x) - b
    while at < n:
        end = min(n, at + step)
        same = x[a + at:a + end] == x[b + at:b + end]
        if not same.all():
            return at + int(np.argmin(same))
        at, step = end, 2 * step
    return n


def runs_of(seq: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """All runs as (start, length, period), sorted."""
    if exponent < 4:
        raise ValueError("roots are looked for by three copies: runs of four periods or more")
    back, n, found = seq[::-1], len(seq), set()
    values = seq.tolist()
    for ranks in (values, [-v for v in values]):
        root = np.asarray(lyndon(ranks), np.int64)
        at = np.arange(n)
        third = np.minimum(at + 2 * root, n - 1)
        second = np.minimum(at + root, n - 1)
        starts = np.flatnonzero((at + 3 * root <= n) & (root[second] == root) & (root[third] == root))
        done: dict[int, int] = {}
        for i in starts.tolist():
            q = int(root[i])
            if i + 2 * q <= done.get(q, 0):
                continue
            right = i + q + reach(seq, i, i + q)
            left = i - reach(back, n - i - q, n - i)
            done[q] = right
            if right - left >= max(least, exponent * q):
                found.add((left, right - left, q))
    return sorted(found)


def live(ids: np.ndarray, owner: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (first, end) in which every three words in a row occur three times in their text."""
    if len(ids) < LEAST:
        return []
    mix = np.uint64(0x9E3779B97F4A7C15)
    key = owner[2:].astype(np.uint64)
    for part in (ids[:-2], ids[1:-1], ids[2:]):
        key = (key ^ part.astype(np.uint64)) * mix
        key ^= key >> np.uint64(29)
    _, at, counts = np.unique(key, return_inverse=True, return_counts=True)
    good = (counts[at] >= 3) & (owner[2:] == owner[:-2])
    edge = np.flatnonzero(np.diff(np.concatenate([[0], good.view(np.int8), [0]])))
    out = []
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        # Windows of two texts may follow each other without a gap.
        cuts = [a, *(np.flatnonzero(owner[a + 1:b] != owner[a:b - 1]) + a + 1).tolist(), b]
        out += [(p, q + 2) for p, q in zip(cuts, cuts[1:]) if q + 2 - p >= LEAST]
    return out


def _scan(texts: pa.Array) -> pa.Array:
    """A batch of word arrays -> the runs of each, and its words without repeats (null: no runs)."""
    flat = texts.flatten()
    ids = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    sizes = np.diff(texts.offsets.to_numpy())
    begins = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(len(texts)), sizes)
    runs: dict[int, list[tuple[int, int, int]]] = {}
    for a, b in live(ids, owner):
        doc = int(owner[a])
        shift = a - int(begins[doc])
        runs.setdefault(doc, []).extend((s + shift, k, q) for s, k, q in runs_of(ids[a:b]))
    found, left = [], []
    for doc in range(len(texts)):
        own = sorted(runs.get(doc, []))
        found.append([{"start": s, "length": k, "period": q} for s, k, q in own])
        if not own:
            left.append(None)
            continue
        keep = np.ones(sizes[doc], bool)
        for s, k, q in own:
            keep[s + q:s + k] = False
        mine = flat.slice(int(begins[doc]), int(sizes[doc])).filter(pa.array(keep))
        left.append(" ".join(mine.to_pylist()))
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    return pa.StructArray.from_arrays([pa.array(found, pa.list_(run)), pa.array(left, pa.string())], ["runs", "collapsed"])


def find_runs(docs: DataFrame, seq: Column | None = None, out: str = "runs") -> DataFrame:
    """``docs`` with a struct ``out``: ``runs`` by start and period, ``collapsed``: the words with each run cut to its first period.

    ``seq``: an array of words without nulls (by default the words of ``text``).
    """
    seq = words("text") if seq is None else seq
    scan = F.arrow_udf(_scan, KIND)
    got = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), seq.alias("seq")).select(
        "row", "seq", scan("seq").alias("got"))
    found = F.struct(F.col("got.runs").alias("runs"),
                     F.coalesce("got.collapsed", F.array_join("seq", " ")).alias("collapsed"))
    return got.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c != out], found.alias(out))


def collapse(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` cut to the first period of each run (words joined by one space); texts without runs as they were."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    got = find_runs(docs.select(row, F.col("text")), out="found")
    text = F.when(F.size("found.runs") > 0, F.col("found.collapsed")).otherwise(F.col("text")).alias("text")
    return got.select(*[text if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
