"""Suffix-array dedup: bytes of strings that occur earlier are removed.

A string of ``least`` bytes counts if it starts earlier too: in a document with
a smaller id, or earlier in the same one. A text's longest-previous-factor
array tells, for each start, the longest match with an earlier start; it is read
off the suffix array from the previous and next smaller positions. A corpus has
no one suffix array, so suffixes are dealt to many small ones:

* Equal texts are one; of a text of ``least`` bytes or more only the first stays.
* Every window of ``least`` bytes picks its anchor: the GRAM bytes in it with the
  smallest hash. Equal windows have equal anchors at equal places, so all
  occurrences of a window meet in the bucket of its anchor, and a window whose
  anchor occurs once in the corpus is no match.
* A bucket holds, for each occurrence of a repeated anchor, the stretch of text
  whose windows it is the anchor of. In the suffix array of these stretches, to a
  depth of ``least`` bytes (ranks of 8 bytes, doubled), the previous and the next
  smaller positions give the longest previous factor of each window's start; it
  is removed where that is ``least`` bytes. Equal stretches are one there.
* Anchors with more than ``HOT`` occurrences are thinned first: of the equal
  stretches of a text, and then of all texts, only the earliest go on (found by
  an aggregate with map-side combine). If an anchor has more than ``HOT``
  different stretches even so, its windows are dealt one by one, by digest.

Texts are whole, as UTF-8; null is empty. Rows that agree in doc_id and text
are one document and get the same result; rows that agree in doc_id only are
ordered by a hash of their text; null ids come last. Extra columns are kept.
"""

import zlib
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloakline.llm.common import apart, identity, scratch, utf8
from cloakline.llm.minhash import mixed

LEAST, GRAM, HOT = 100, 24, 4096
#: Anchors keep 48 bits of their hash, which compresses better: a false meeting costs work, never a match.
ANCHOR = np.uint64(0xFFFFFFFFFFFF0000)
#: Bits for a place within a piece of PIECE bytes.
PLACE = 21
#: Bytes of text whose anchors are computed at once, and of stretches in one suffix array.
PIECE, ARRAY = 1 << 20, 1 << 20


def gram_hashes(data: bytes, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each position: words of 8 bytes, chained."""
    n = len(data) - gram + 1
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))  # the 8 bytes from each position
    out = np.zeros(n, np.uint64)
    for at in [*range(0, gram - 7, 8), *([gram - 8] if gram % 8 else [])]:
        out = mixed(out + eight[at:at + n])
    return out


def window_minima(x: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values the place of its smallest (by the upper bits), the last one on ties."""
    low = np.uint64((1 << PLACE) - 1)
    v = (x & ~low) | (low - np.arange(len(x), dtype=np.uint64))
    span = 1
    while span < width:
        step = min(span, width - span)
        v = np.minimum(v[step:], v[:len(v) - step])
        span += step
    return (low - (v & low)).astype(np.int64)


def anchors(data: bytes, least: int = LEAST, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """(hash, first window, number of windows) of each anchor, in pieces of a long text."""
    n = len(data) - least + 1  # windows
    for low in range(0, n, PIECE):
        h = gram_hashes(data[low:min(n, low + PIECE) + least - 1], gram)
        at = window_minima(h, least - gram + 1)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        yield (h[at[first]] & ANCHOR).view(np.int64), first + low, np.diff(np.append(first, len(at)))


def _zip(text: pd.Series) -> pd.Series:
    return text.map(lambda t: zlib.compress(bytes(t), 1))


unzip = zlib.decompress


def _anchors(least: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, parts = [], []
            for i, t in enumerate(b["_t"]):
                for part in anchors(unzip(t.as_py()), least, gram):
                    rows.append(np.full(len(part[0]), i))
                    parts.append(part)
            if parts:
                h, first, n = (np.concatenate(x) for x in zip(*parts))
                own = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), b["_k"].take(own), b["_h"].take(own), pa.array(first << 8 | n)],
                    ["anchor", "_k", "_h", "at"])

    return run


def rank_levels(text: np.ndarray, depth: int) -> list[tuple[int, np.ndarray]]:
    """(length, rank of that many bytes from each position), up to ``depth``; zeros past the end, equal for equal bytes.

    Prefix doubling from 8 bytes on; positions in rank order are the suffix
    array to that depth.
    """
    pad = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(len(text), np.uint64)
    for i in range(8):
        key = key << np.uint64(8) | pad[i:i + len(text)]
    out = [(8, np.unique(key, return_inverse=True)[1].astype(np.int64))]
    while out[-1][0] < depth:
        have, rank = out[-1]
        step = min(have, depth - have)
        other = np.zeros(len(text), np.int64)
        if step < len(text):
            other[:-step] = rank[step:] + 1
        rank = np.unique(rank * (len(text) + 2) + other, return_inverse=True)[1].astype(np.int64)
        out.append((have + step, rank))
    return out


def previous_smaller(x: np.ndarray) -> np.ndarray:
    """For each place the nearest one to the left with a smaller value, -1 if none.

    All places look at once: whoever meets a larger value goes on where that
    one's search stands; everything in between is larger too.
    """
    found = np.arange(-1, len(x) - 1)
    todo = np.flatnonzero(found >= 0)
    while len(todo):
        todo = todo[x[found[todo]] > x[todo]]
        found[todo] = found[found[todo]]
        todo = todo[found[todo] >= 0]
    return found


def common_bytes(levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix at two arrays of positions, up to the depth of the levels (whole bytes by eights)."""
    depth, top = levels[-1]
    out = np.where(top[a] == top[b], depth, 0)
    part = np.flatnonzero(out == 0)
    a, b, at = a[part].copy(), b[part].copy(), np.zeros(len(part), np.int64)
    size = len(top)
    for length, rank in reversed(levels[:-1]):
        inside = (a + at < size) & (b + at < size)
        same = np.zeros(len(part), bool)
        same[inside] = rank[(a + at)[inside]] == rank[(b + at)[inside]]
        at += np.where(same, length, 0)
    out[part] = np.minimum(at, depth - 1)
    return out


def previous_factors(text: np.ndarray, starts: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """The longest-previous-factor array of the starts, up to ``least``: how many bytes from each also begin at an earlier one.

    Starts in suffix order (ties by ``order``): the longest match with an earlier
    start lies at the previous or at the next position in that order which is
    smaller in ``order``. Matches shorter than ``least`` are measured in eights.
    """
    levels = rank_levels(text, least)
    suffixes = np.lexsort((order, levels[-1][1][starts]))
    place, where = order[suffixes], starts[suffixes]
    best = np.zeros(len(starts), np.int64)
    for earlier in (previous_smaller(place), len(place) - 1 - previous_smaller(place[::-1])[::-1]):
        has = np.flatnonzero((earlier >= 0) & (earlier < len(place)))
        best[has] = np.maximum(best[has], common_bytes(levels, where[has], where[earlier[has]]))
    out = np.empty(len(starts), np.int64)
    out[suffixes] = best
    return out


def _stretches(least: int):
    """Texts with their anchors to rows (anchor, document, first window, the bytes of all windows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, anchor, first, data = [], [], [], []
            for i, (t, occ) in enumerate(zip(b["_t"], b["occ"])):
                t = unzip(t.as_py())
                for o in occ.as_py():
                    at, n = o["at"] >> 8, o["at"] & 0xFF
                    rows.append(i), anchor.append(o["anchor"]), first.append(at)
                    data.append(t[at:at + n + least - 1])
            own = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor, pa.int64()), b["_k"].take(own), b["_h"].take(own), pa.array(first, pa.int64()),
                 pa.array(data, pa.binary())], ["anchor", "_k", "_h", "first", "bytes"])

    return run


def _thinned(least: int):
    """The same for hot anchors, with a digest; equal stretches of one text become runs (``n`` bytes, no digest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[int] = []
            cols: list[list] = [[], [], [], [], []]

            def put(i, *row):
                rows.append(i)
                for to, x in zip(cols, row):
                    to.append(x)

            for i, (t, occ) in enumerate(zip(b["_t"], b["occ"])):
                t, seen, begin, end = unzip(t.as_py()), set(), 0, 0
                for o in sorted(occ.as_py(), key=lambda o: o["at"]):
                    at, n = o["at"] >> 8, (o["at"] & 0xFF) + least - 1
                    data = t[at:at + n]
                    digest = blake2b(data, digest_size=16).digest()
                    if (o["anchor"], digest) not in seen:
                        seen.add((o["anchor"], digest))
                        put(i, o["anchor"], digest, at, n, data)
                        continue
                    if at > end:  # apart from the run before
                        if end:
                            put(i, None, None, begin, end - begin, None)
                        begin = at
                    end = max(end, at + n)
                if end:
                    put(i, None, None, begin, end - begin, None)
            own = pa.array(rows, pa.int64())
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary())
            anchor, digest, first, n, data = (pa.array(c, k) for c, k in zip(cols, kinds))
            yield pa.RecordBatch.from_arrays(
                [anchor, digest, b["_k"].take(own), b["_h"].take(own), first, n, data],
                ["anchor", "digest", "_k", "_h", "first", "n", "bytes"])

    return run


def _windows(least: int):
    """Stretches to their windows: a row (digest, document, start) for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, first, digest = [], [], []
            for i, (t, at) in enumerate(zip(b["bytes"], b["first"].to_pylist())):
                t = t.as_py()
                for s in range(len(t) - least + 1):
                    rows.append(i), first.append(at + s)
                    digest.append(blake2b(t[s:s + least], digest_size=16).digest())
            own = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(digest, pa.binary()), b["_k"].take(own), b["_h"].take(own), pa.array(first, pa.int64())],
                ["window", "_k", "_h", "first"])

    return run


def _joined(least: int):
    """Window starts sorted by document and start to byte runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, begin, end = None, 0, 0
        for b in batches:
            out = []
            for k, h, s in zip(*(b[c].to_pylist() for c in ("_k", "_h", "first"))):
                if at != (k, h) or s > end:
                    if at:
                        out.append((*at, begin, end))
                    at, begin = (k, h), s
                end = s + least
            yield _runs(out)
        if at:
            yield _runs([(*at, begin, end)])

    return run


def _runs(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * 4
    kinds = (pa.int64(),) * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["_k", "_h", "a", "b"])


def _buckets(least: int):
    """Stretches sorted by anchor to runs of windows that occur earlier."""

    def solve(rows: list[tuple]) -> list[tuple[int, int, int, int]]:
        # Buckets are independent: a window never equals one of another anchor. Nor do two windows
        # of one stretch, so a bucket of equal stretches needs no suffix array.
        out: list[tuple[int, int, int, int]] = []
        heads: dict[tuple, tuple] = {}
        for r in sorted(rows, key=lambda r: r[1:4]):
            head = heads.setdefault((r[0], r[4]), r)
            if head[1:4] != r[1:4]:  # else the first, or a document given twice
                out.append((r[1], r[2], r[3], r[3] + len(r[4])))
        many = Counter(a for a, _ in heads)
        rows = [r for (a, _), r in heads.items() if many[a] > 1]
        if not rows:
            return out
        text = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
        size = np.array([len(r[4]) for r in rows])
        n = size - least + 1
        base = np.repeat(np.cumsum(size) - size, n)
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        found = previous_factors(text, base + offset, np.arange(len(base)), least) >= least
        owner = np.repeat(np.arange(len(rows)), n)[found]
        place = offset[found]
        if len(owner):
            cut = np.flatnonzero((np.diff(owner) != 0) | (np.diff(place) != 1)) + 1
            for a, z in zip(np.concatenate([[0], cut]).tolist(), np.append(cut, len(owner)).tolist()):
                r = rows[owner[a]]
                out.append((r[1], r[2], r[3] + int(place[a]), r[3] + int(place[z - 1]) + least))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, anchor = [], 0, None

        for b in batches:
            for r in zip(*(b[c].to_pylist() for c in ("anchor", "_k", "_h", "first", "bytes"))):
                if r[0] != anchor and held >= ARRAY:
                    yield _runs(solve(rows))
                    rows, held = [], 0
                anchor = r[0]
                rows.append(r)
                held += len(r[4])
        if rows:
            yield _runs(solve(rows))

    return run


def _cut(text: pd.Series, gone: pd.Series) -> pd.DataFrame:
    out = []
    for t, runs in zip(text, gone):
        data, kept, at, n, spans = unzip(bytes(t)), [], 0, 0, 0
        end = -1
        for r in sorted((r["a"], r["b"]) for r in runs):
            if r[0] > end:  # not adjacent to the run before
                spans += 1
                kept.append(data[at:r[0]])
                end = r[0]
            n += max(0, r[1] - max(end, r[0]))
            end = max(end, r[1])
            at = end
        out.append((b"".join([*kept, data[at:]]), n, spans))
    return pd.DataFrame(out, columns=["kept", "n_removed", "n_spans"])


def removed(docs: DataFrame, least: int = LEAST, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``(_k, _h, kept, n_removed, n_spans)`` for the documents that lose bytes; ``kept`` is binary."""
    texts = docs.select(*identity(), F.md5(utf8("text")).alias("d"), utf8("text").alias("_t")).where(
        F.octet_length("_t") >= least)
    # The smallest document of each text stands for its copies, which lose everything.
    ids = texts.select("_k", "_h", "d", F.octet_length("_t").cast("long").alias("size"))
    place = F.struct("_k", "_h")
    same = ids.groupBy("d").agg(F.min(place).alias("f"), F.max(place).alias("l")).where("f <> l").select("d", "f")
    copies = scratch(ids.join(apart(same), "d").where(place != F.col("f")).select("_k", "_h", "size").distinct(), "lpf-copies")
    # One exchange of the texts serves all joins: they are in one plan, nothing is written in between.
    # It is the largest one, so it moves compressed texts.
    texts = texts.select("_k", "_h", F.pandas_udf(_zip, "binary")("_t").alias("_t"))
    own = ["_k", "_h"]
    found = texts.join(copies.select(*own).hint("merge"), own, "left_anti").mapInArrow(
        _anchors(least, gram), "anchor long, _k long, _h long, at long")
    count = found.groupBy("anchor").agg(F.count("*").alias("m")).where("m > 1")
    met = found.join(apart(count), "anchor")
    occ = met.where(F.col("m") <= hot).groupBy(*own).agg(F.collect_list(F.struct("anchor", "at")).alias("occ"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stretch = ["anchor", "_k", "_h", "first", "bytes"]
    cold = texts.join(occ.hint("merge"), own).mapInArrow(
        _stretches(least), "anchor long, _k long, _h long, first long, bytes binary")
    # Hot anchors: equal stretches first, then what is left like the others, or window by window.
    often = met.where(F.col("m") > hot).groupBy(*own).agg(F.collect_list(F.struct("anchor", "at")).alias("occ"))
    thin = texts.join(often.hint("merge"), own).mapInArrow(
        _thinned(least), "anchor long, digest binary, _k long, _h long, first long, n long, bytes binary")
    span = [*own, F.col("first").alias("a"), (F.col("first") + F.col("n")).alias("b")]
    start = F.struct("_k", "_h", "first")
    inside = thin.where("digest IS NULL").select(*span)
    thin = thin.where("digest IS NOT NULL")
    head = thin.groupBy("anchor", "digest").agg(F.min(start).alias("f"), F.max(start).alias("l"))
    later = thin.join(apart(head.where("f <> l").drop("l")), ["anchor", "digest"]).where(start != F.col("f")).select(*span)
    wide = head.groupBy("anchor").agg(F.count("*").alias("d"))
    left = thin.join(head.drop("l"), ["anchor", "digest"]).where(start == F.col("f")).join(apart(wide), "anchor")
    runs = cold.unionAll(left.where(f"d BETWEEN 2 AND {hot}").select(*stretch)).repartition(
        parts, "anchor").sortWithinPartitions("anchor").mapInArrow(_buckets(least), "_k long, _h long, a long, b long")
    windows = left.where(f"d > {hot}").select(*stretch).mapInArrow(
        _windows(least), "window binary, _k long, _h long, first long")
    top = windows.groupBy("window").agg(F.min(start).alias("f"), F.max(start).alias("l")).where("f <> l").drop("l")
    again = windows.join(apart(top), "window").where(start != F.col("f")).select("_k", "_h", "first").repartition(
        parts, *own).sortWithinPartitions(*own, "first").mapInArrow(_joined(least), "_k long, _h long, a long, b long")
    gone = runs.unionAll(again).unionAll(inside).unionAll(later).groupBy(*own).agg(
        F.collect_set(F.struct("a", "b")).alias("gone"))
    cut = F.pandas_udf(_cut, "kept binary, n_removed long, n_spans long")
    part = texts.join(gone.hint("merge"), own).select(*own, cut("_t", "gone").alias("c")).select(
        *own, "c.*").dropDuplicates(own)
    whole = copies.select(*own, F.lit(b"").alias("kept"), F.col("size").alias("n_removed"),
                          F.lit(1).cast("long").alias("n_spans"))
    return part.unionAll(whole)


def dedup(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` without bytes of repeated strings; characters that lost some of their bytes go whole."""
    rows = docs.select(F.struct("*").alias("row")).select("row", *identity("row."))
    text = F.coalesce(F.col("_text"), F.col("row.text"))
    clean = F.pandas_udf(lambda kept: kept.map(lambda x: bytes(x).decode("utf-8", "ignore")), "string")
    cut = removed(docs, least).select("_k", "_h", clean("kept").alias("_text"))
    return rows.join(cut, ["_k", "_h"], "left").select(
        *[(text if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns])
