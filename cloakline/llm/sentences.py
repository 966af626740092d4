"""Substring dedup over sliding sentence spans.

A text is cut into pieces: sentences, which are cut further behind words whose
hash is a smallest one among the ``NEAR`` words on either side. From every piece
starts a span, the shortest run of at least ``SENTENCES`` pieces and ``WORDS``
words, and at every piece where no such span ends ends the shortest run back.
All spans are hashed and compared globally. The first occurrence of a span
(smallest doc_id, then earliest) stays; pieces covered by any other occurrence
are removed.

A cut depends on no word further away than ``NEAR``, so a passage is cut alike
wherever it stands, but for its first and last words: a repeated passage loses
all but a few words at either end that share a piece with what is around it.

Sentences end behind ``. ! ?`` and their closing quotes, if white space
follows, and at line ends. Spans compare the words between white space, A-Z
lower-cased, by 64 bits and the bucket that further bits choose; the texts kept
are cut from the original. Null and empty texts have no sentence and stay as
they are. Rows that agree in doc_id and text are one document; rows that agree
in doc_id only are ordered by a hash of their text; null ids come last. Extra
columns are kept.

A task packs the spans of many texts by bucket, each span once: of those that
its texts repeat only the first can stay, the others are gone already. So a span
that every text holds is a row per pack, and buckets are of bounded size.
"""

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloakline.llm.common import BLANKS, LOWER_BYTES, identity, utf8
from cloakline.llm.minhash import mixed

SENTENCES, WORDS, NEAR = 2, 40, 1
#: Spans that a task packs at once, bytes of text whose spans are one bucket, about.
PACK, BUCKET = 1_000_000, 1 << 25
_END = re.compile(rb"""[.!?]["')\]]*[ \t\x0b\x0c\r]+|\n\s*""")
_BLANK = np.isin(np.arange(256), list(BLANKS.encode()))
#: Odd multipliers of the two span hashes, and their inverses modulo 2**64.
_MUL = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_INV = tuple(pow(m, -1, 2**64) for m in _MUL)


class Cutter:
    """Texts to words, pieces and spans; word hashes and powers are remembered."""

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.powers = [np.ones(1, np.uint64)] * 4

    def word(self, w: bytes) -> int:
        if len(self.known) > 1_000_000:
            self.known.clear()
        h = self.known[w] = int.from_bytes(blake2b(w, digest_size=8).digest(), "little")
        return h

    def hashes(self, words: list[bytes]) -> np.ndarray:
        get = self.known.get
        return np.array([h if (h := get(w)) is not None else self.word(w) for w in words], np.uint64)

    def pieces(self, data: bytes, near: int = NEAR) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The words' hashes; where pieces start, as words and as bytes (ends appended); which start a sentence.

        ``near`` = 0 cuts sentences only. White space before the next piece of a sentence belongs to that piece.
        """
        hashes = self.hashes(data.translate(LOWER_BYTES).split())
        n = len(hashes)
        if not n:
            return hashes, np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(0, bool)
        blank = np.append(True, _BLANK[np.frombuffer(data, np.uint8)])
        starts = np.flatnonzero(blank[:-1] & ~blank[1:])
        stops = np.flatnonzero(~blank[1:] & np.append(blank[2:], True)) + 1
        ends = np.array([m.end() for m in _END.finditer(data)] + [len(data)], np.int64)
        word, first = np.unique(np.searchsorted(starts, ends), return_index=True)
        kind, at = np.zeros(n + 1, np.int8), np.append(0, stops)
        if near:
            low = np.ones(n, bool)
            for k in range(1, min(near, n - 1) + 1):
                low[k:] &= hashes[k:] <= hashes[:-k]
                low[:-k] &= hashes[:-k] <= hashes[k:]
            kind[1:][low] = 1
        kind[word], at[word] = 2, ends[first]
        kind[0], at[0] = 2, 0
        cut = np.flatnonzero(kind)
        return hashes, cut, at[cut], kind[cut[:-1]] == 2

    def digests(self, hashes: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of each run of words."""
        n = len(hashes)
        if n >= len(self.powers[0]):
            self.powers = []
            for m in (*_MUL, *_INV):
                p = np.full(2 * n + 2, np.uint64(m))
                p[0] = 1
                self.powers.append(np.multiply.accumulate(p))
        out = []
        for i in (0, 1):
            total = np.zeros(n + 1, np.uint64)
            np.cumsum((mixed(hashes) if i else hashes) * self.powers[i][:n], out=total[1:])
            out.append(mixed((total[end] - total[first]) * self.powers[2 + i][first]))
        return out[0], out[1]


def sentences(data: bytes) -> list[tuple[int, int, list[bytes]]]:
    """(first byte, end, words) of each sentence that has words; the ends touch the next sentence."""
    _, _, at, _ = Cutter().pieces(data, 0)
    return [(a, b, data[a:b].translate(LOWER_BYTES).split()) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def reach(cut: np.ndarray, least: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first piece, end) of the shortest span from each piece."""
    first = np.arange(len(cut) - 1)
    end = np.maximum(np.searchsorted(cut, cut[:-1] + words), first + least)
    ok = end < len(cut)
    return first[ok], end[ok]


def reach_back(cut: np.ndarray, least: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first piece, end) of the shortest span back from each end."""
    end = np.arange(1, len(cut))
    first = np.minimum(np.searchsorted(cut, cut[1:] - words, "right") - 1, end - least)
    return first[first >= 0], end[first >= 0]


def spans(parts: list[tuple[int, int, list[bytes]]], least: int = SENTENCES,
          words: int = WORDS) -> Iterator[tuple[int, int, bytes]]:
    """(first part, end, digest) of each sliding span."""
    cutter = Cutter()
    cut = np.append(0, np.cumsum([len(p[2]) for p in parts], dtype=np.int64))
    first, end = reach(cut, least, words)
    one, two = cutter.digests(cutter.hashes([w for p in parts for w in p[2]]), cut[first], cut[end])
    for a, b, x, y in zip(first.tolist(), end.tolist(), one, two):
        yield a, b, x.tobytes() + y.tobytes()


def _planes(x: np.ndarray) -> bytes:
    """Lowest bytes first, then the next ones, so that small numbers compress."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _pack(k: np.ndarray, h: np.ndarray, a: np.ndarray, b: np.ndarray, key: np.ndarray) -> bytes:
    """Spans in document order as bytes: each document once with the number of its spans."""
    new = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (h[1:] != h[:-1])))
    count = np.diff(np.append(new, len(k))).astype(np.int32)
    return b"".join([
        np.array([len(new), len(k)], np.int32).tobytes(), _planes(k[new]), h[new].tobytes(), _planes(count),
        _planes(a.astype(np.int32)), _planes((b - a).astype(np.int32)), key.tobytes()])


def _unpack(blob: bytes) -> tuple[np.ndarray, ...]:
    docs, n = np.frombuffer(blob, np.int32, 2).tolist()
    at = 8

    def take(kind, size: int, planes: bool = True) -> np.ndarray:
        nonlocal at
        width = np.dtype(kind).itemsize
        raw = np.frombuffer(blob, np.uint8, size * width, at)
        at += size * width
        return (np.ascontiguousarray(raw.reshape(width, size).T) if planes else raw).reshape(-1).view(kind)

    k, h, count = take(np.int64, docs), take(np.int64, docs, False), take(np.int32, docs)
    a, more, key = take(np.int32, n), take(np.int32, n), take(np.uint64, n, False)
    return np.repeat(k, count), np.repeat(h, count), a, a + more, key


def _later(k, h, a, key, bucket=None) -> tuple[np.ndarray, np.ndarray]:
    """Which spans are not the first of their key, and which are the same place of a document given again."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if bucket is not None:
        same &= bucket[order][1:] == bucket[order][:-1]
    later, again = np.zeros(len(key), bool), np.zeros(len(key), bool)
    run = np.cumsum(np.append(True, ~same))  # runs of one key, numbered
    some = np.append(False, same) | np.append(same, False)
    order, run = order[some], run[some]
    inner = np.lexsort((a[order], h[order], k[order], run))
    order, run = order[inner], run[inner]
    head = np.append(True, run[1:] != run[:-1])[:len(order)]
    lead = order[head][np.cumsum(head) - 1] if len(order) else order
    other = (k[order] != k[lead]) | (h[order] != h[lead]) | (a[order] != a[lead])
    later[order] = other
    again[order] = ~other & ~head
    return later, again


def _spans(least: int, words: int, buckets: int):
    """Texts to packed spans by bucket (``gone`` false) and spans known to be repeats (true)."""

    def rows(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        k, h, a, b, key, bucket = (np.concatenate(c) for c in zip(*parts))
        later, again = _later(k, h, a, key, bucket)
        to, gone, blobs = [], [], []
        for out in (True, False):
            pick = np.flatnonzero(later if out else ~later & ~again)
            if out:  # of no bucket: spans that overlap become one
                doc = np.cumsum(np.append(0, (k[1:] != k[:-1]) | (h[1:] != h[:-1])))
                pick = pick[np.lexsort((a[pick], doc[pick]))]
                low, high = (doc[pick] << 32) + a[pick], np.maximum.accumulate((doc[pick] << 32) + b[pick])
                edge = np.flatnonzero(np.append(True, low[1:] > high[:-1]))[:len(pick)]
                b[pick[edge]] = high[np.append(edge[1:], len(pick))[:len(edge)] - 1] & 0x7FFFFFFF
                pick = pick[edge]
                bucket[pick] = h[pick] % buckets
            pick = pick[np.argsort(bucket[pick], kind="stable")]  # document order inside
            own = bucket[pick]
            edge = np.append(np.flatnonzero(np.append(True, own[1:] != own[:-1]))[:len(own)], len(own))
            for x, y in zip(edge[:-1].tolist(), edge[1:].tolist()):
                p = pick[x:y]
                to.append(int(own[x])), gone.append(out)
                blobs.append(_pack(k[p], h[p], a[p], b[p], key[p]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(to, pa.int64()), pa.array(gone, pa.bool_()), pa.array(blobs, pa.binary())],
            ["bucket", "gone", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, parts, held = Cutter(), [], 0
        for batch in batches:
            for k, h, t in zip(batch["_k"].to_pylist(), batch["_h"].to_pylist(), batch["_t"]):
                hashes, cut, _, _ = cutter.pieces(t.as_py())
                first, end = reach(cut, least, words)
                if not len(first):
                    continue
                low, high = reach_back(cut, least, words)
                new = ~np.isin(high, end)
                first, end = np.append(first, low[new]), np.append(end, high[new])
                key, other = cutter.digests(hashes, cut[first], cut[end])
                n = len(first)
                parts.append((np.full(n, k), np.full(n, h), first.astype(np.int32), end.astype(np.int32), key,
                              (other % np.uint64(buckets)).astype(np.int32)))
                held += n
                if held >= PACK:
                    yield from rows(parts)
                    parts, held = [], 0
        if parts:
            yield from rows(parts)

    return run


def _repeats(pdf: pd.DataFrame) -> pd.DataFrame:
    """One bucket: the spans that are not the first of their key, and those known before."""
    known = [_unpack(x) for x in pdf["spans"][pdf["gone"]]]
    whole = [_unpack(x) for x in pdf["spans"][~pdf["gone"]]]
    if whole:
        k, h, a, b, key = (np.concatenate(c) for c in zip(*whole))
        later = _later(k, h, a, key)[0]
        known.append((k[later], h[later], a[later], b[later]))
    return pd.DataFrame({c: np.concatenate([x[i] for x in known]) for i, c in enumerate(("_k", "_h", "a", "b"))})


def repeated_spans(docs: DataFrame, least: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """``(_k, _h, a, b)``: runs of pieces that occur earlier, too."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(utf8("text")))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET))
    packed = docs.select(*identity(), utf8("text").alias("_t")).mapInArrow(
        _spans(least, words, buckets), "bucket long, gone boolean, spans binary")
    # As many partitions as buckets: a task has one or a few of them, however many there are.
    return packed.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(_repeats, "_k long, _h long, a int, b int")


def _cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    cutter = Cutter()
    for text, gone in batches:
        out = []
        for t, found in zip(text, gone):
            data = bytes(t)
            none = found is None or not len(found)
            _, _, at, starts = cutter.pieces(data, 0 if none else NEAR)
            if none:
                out.append((data.decode(), len(starts), 0))
                continue
            depth = np.zeros(len(at), np.int64)
            found = np.asarray(found, np.int64)
            np.add.at(depth, found >> 32, 1)
            np.add.at(depth, found & 0xFFFFFFFF, -1)
            drop = np.cumsum(depth)[:-1] > 0
            kept, last = [], 0
            for i in np.flatnonzero(drop).tolist():
                kept.append(data[last:at[i]])
                last = at[i + 1]
            touched = np.unique(np.cumsum(starts)[drop])
            out.append((b"".join([*kept, data[last:]]).decode(), int(starts.sum()), len(touched)))
        yield pd.DataFrame(out, columns=["text", "n_sentences", "n_removed"])


def drop_repeats(docs: DataFrame, least: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """``(row, text, n_sentences, n_removed)``: the input row, and its text without repeated spans.

    ``n_removed`` counts the sentences that lost words.
    """
    gone = repeated_spans(docs, least, words).groupBy("_k", "_h").agg(
        F.collect_list(F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")).alias("gone"))
    cut = F.pandas_udf(_cut, "text string, n_sentences long, n_removed long")
    rows = docs.select(F.struct("*").alias("row")).select("row", *identity("row."))
    return rows.join(gone, ["_k", "_h"], "left").select("row", cut(utf8("row.text"), F.col("gone")).alias("c")).select(
        "row", F.when(F.col("row.text").isNotNull(), F.col("c.text")).alias("text"), "c.n_sentences", "c.n_removed")


def dedup(docs: DataFrame, least: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """``docs`` with repeated spans cut out of ``text``."""
    out = drop_repeats(docs, least, words)
    return out.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
