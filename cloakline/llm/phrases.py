"""Phrase collocation mining by prefix-free parsing.

A piece of text (words between punctuation marks) is parsed into chunks: a
window of ``OVERLAP`` words whose hash is divisible by ``EVERY`` ends one chunk
and begins the next, so neighbouring chunks overlap by those words and equal
stretches of text are parsed alike wherever they stand. Spark counts how often
each distinct chunk occurs: the dictionary. Phrases are counted inside distinct
chunks only, weighted with the chunk's count. A phrase of up to ``OVERLAP`` + 1
words lies whole in the chunk in which it starts before the closing window (or
anywhere, in a piece's last chunk), and is counted there alone: once.

Counting goes by length, one pass over the dictionary each. A pass also counts
hash buckets of the phrases one word longer, if both their parts pass so far;
the buckets that reach the support set bits of a filter of fixed size, and the
next pass counts, exactly and by their text, the phrases that pass it. A filter
that fills up lets more through and loses nothing.

Texts are whole; null texts hold no words, null languages are ``und``. Repeated
rows count as often as they occur. Extra columns are ignored. An empty table
gives no rows. Ties of score and count go by the phrase's bytes.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cloakline.llm.common import LOWER, UPPER, scratch, utf8

#: Words by which chunks overlap; one window in so many ends a chunk.
OVERLAP, EVERY = 4, 16
SUPPORT, LIMIT = 100, 2000
#: Bits of the filter, at most 8 MB in driver and tasks whatever the corpus.
FILTER_BITS = 1 << 26
#: Bytes of chunks counted at once.
HELD = 1 << 23

_MIX, _SEED = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: A-Z in lower case, tab as space, marks and line ends as line feed.
_FOLD = bytes.maketrans(UPPER.encode() + b"\t" + b".,;:!?\n\x0b\x0c\r", LOWER.encode() + b" " + b"\n" * 10)


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two arrays of hashes, in order."""
    x = (a * _SEED + b) * _MIX
    x ^= x >> np.uint64(32)
    x *= _SEED
    return x ^ (x >> np.uint64(29))


def hashes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of each word among the different ones, and its hash."""
    coded = words.dictionary_encode()
    of = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return ids, of[ids] if len(ids) else np.zeros(0, np.uint64)


def parse(texts: list[bytes], every: int = EVERY) -> tuple[list[int], list[bytes], list[bool]]:
    """The chunks of the texts in order: their text's number, words joined by spaces, whether last of a piece."""
    words: list[bytes] = []
    ends: list[int] = []
    owner: list[int] = []
    for i, text in enumerate(texts):
        for piece in text.translate(_FOLD).split(b"\n"):
            own = piece.split()
            if own:
                words += own
                ends.append(len(words))
                owner.append(i)
    if not words:
        return [], [], []
    _, of = hashes(pa.array(words, pa.binary()))
    stop = np.array(ends)
    piece = np.repeat(np.arange(len(stop)), np.diff(stop, prepend=0))
    n = len(words) - OVERLAP + 1
    begins = np.zeros(len(words), bool)
    begins[0] = True
    begins[stop[:-1]] = True
    if n > 0:
        window = of[:n]
        for k in range(1, OVERLAP):
            window = mixed(window, of[k:n + k])
        begins[:n] |= (window % np.uint64(every) == 0) & (piece[:n] == piece[OVERLAP - 1:])
    cuts = np.flatnonzero(begins)
    after = np.append(cuts[1:], len(words))
    end = stop[piece[cuts]]
    last = after == end
    to = np.where(last, end, after + OVERLAP)
    chunks = [b" ".join(words[a:b]) for a, b in zip(cuts.tolist(), to.tolist())]
    return np.array(owner)[piece[cuts]].tolist(), chunks, last.tolist()


def _parsed(every: int):
    kinds = pa.schema([("lang", pa.string()), ("chunk", pa.string()), ("last", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, at, size = b["_t"], 0, 0
            for end in range(1, len(b) + 1):
                size += len(texts[end - 1].as_buffer())
                if size < HELD and end < len(b):
                    continue
                owner, chunks, last = parse([t.as_py() for t in texts[at:end]], every)
                yield pa.RecordBatch.from_arrays(
                    [b["lang"][at:end].take(pa.array(owner, pa.int64())),
                     pa.array(chunks, pa.binary()).cast(pa.string()), pa.array(last, pa.bool_())], schema=kinds)
                at, size = end, 0

    return run


def dictionary(docs: DataFrame, every: int = EVERY) -> DataFrame:
    """``(lang, chunk, last, n)``: the distinct chunks and how often each occurs."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), utf8("text").alias("_t"))
    rows = texts.mapInArrow(_parsed(every), "lang string, chunk string, last boolean")
    return rows.groupBy("lang", "chunk", "last").agg(F.count(F.lit(1)).alias("n"))


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= HELD:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _summed(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each different key, and its sum of weights."""
    _, first, which = np.unique(keys, return_index=True, return_inverse=True)
    total = np.zeros(len(first), np.int64)
    np.add.at(total, which, weight)
    return first, total


def _counted(k: int, longest: int, passed):
    """Rows of a task's chunks: ``(lang, phrase, -, n)`` for phrases of ``k`` words that pass the filter,
    ``(-, -, bucket, n)`` for those of ``k`` + 1 words whose parts do."""
    kinds = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("bucket", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if passed is None else passed.value
        for t in _held(batches):
            t = t.combine_chunks()
            split = pc.split_pattern(t["chunk"].chunk(0), " ") if len(t) else pa.array([], pa.list_(pa.string()))
            flat = split.flatten()
            if not len(flat):
                continue
            ids, of = hashes(flat)
            sizes = np.diff(split.offsets.to_numpy())
            owner = np.repeat(np.arange(len(t)), sizes)
            langs = t["lang"].combine_chunks().dictionary_encode()
            lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[owner]
            seeds = np.array([xxhash.xxh64_intdigest(x) for x in langs.dictionary.to_pylist()], np.uint64)
            weight = t["n"].to_numpy()[owner]
            end = np.repeat(np.cumsum(sizes), sizes)
            # A start in the overlap belongs to the next chunk.
            own = np.arange(len(flat)) < end - np.where(t["last"].to_numpy(zero_copy_only=False)[owner], 0, OVERLAP)
            h = mixed(seeds[lang], of)
            for j in range(1, k):
                h = mixed(h[:-1], of[j:])
            good = np.arange(len(h)) + k <= end[:len(h)]
            if bits is not None:
                good &= _passes(bits, h)
            start = np.flatnonzero(good & own[:len(h)])
            # Exact numbers of the phrases: combined and ranked word by word.
            key = ids[start] * len(seeds) + lang[start]
            for j in range(1, k):
                key = np.unique(key, return_inverse=True)[1] * (int(ids.max()) + 1) + ids[start + j]
            first, total = _summed(key, weight[start])
            at = start[first]
            text = pc.binary_join(pa.ListArray.from_arrays(
                pa.array(np.arange(len(at) + 1) * k, pa.int32()),
                flat.take(pa.array((at[:, None] + np.arange(k)).ravel()))), " ")
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary.take(pa.array(lang[at])), text, pa.nulls(len(at), pa.int64()), pa.array(total)], schema=kinds)
            if k == longest or len(h) < 2:
                continue
            after = mixed(h[:-1], of[k:])
            start = np.flatnonzero(good[:-1] & good[1:] & own[:len(after)] & (np.arange(len(after)) + k < end[:len(after)]))
            bucket = after[start] >> np.uint64(32)
            first, total = _summed(bucket, weight[start])
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(first), pa.string()), pa.nulls(len(first), pa.string()),
                 pa.array(bucket[first].astype(np.int64)), pa.array(total)], schema=kinds)

    return run


def _passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = (h >> np.uint64(32)) & np.uint64(len(bits) * 64 - 1)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def filter_of(rows: DataFrame, size: int = FILTER_BITS) -> np.ndarray:
    """The filter of the numbers ``bucket``: ``size`` bits (a power of two), set by Spark as words of 64."""
    word = F.expr(f"(bucket & {size - 1}L) DIV 64").alias("w")
    found = rows.groupBy(word).agg(F.expr("bit_or(shiftleft(1L, CAST(bucket & 63L AS INT)))").alias("b")).toArrow()
    out = np.zeros(size // 64, np.uint64)
    out[found["w"].to_numpy()] = found["b"].to_numpy().view(np.uint64)
    return out


def frequent(chunks: DataFrame, support: int = SUPPORT, longest: int = OVERLAP + 1,
             bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """``(lang, k, phrase, f)`` of all phrases with at least ``support`` occurrences, and ``(lang, n)`` of all words."""
    if longest > OVERLAP + 1:
        raise ValueError(f"a chunk holds whole phrases of up to {OVERLAP + 1} words")
    spark: SparkSession = chunks.sparkSession
    out, sizes, passed = None, None, None
    for k in range(1, longest + 1):
        rows = chunks.mapInArrow(_counted(k, longest, passed), "lang string, phrase string, bucket long, n long")
        total = rows.groupBy("lang", "phrase", "bucket").agg(F.sum("n").alias("f"))
        kept = F.col("f") >= support
        # All words stay, for their number; of longer phrases and of buckets only the frequent ones.
        total = scratch(total.where(kept | F.col("bucket").isNull() if k == 1 else kept), f"phrases-{k}")
        if k == 1:
            sizes = total.where("bucket IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
        level = total.where(F.col("bucket").isNull() & kept).select("lang", F.lit(k).alias("k"), "phrase", "f")
        out = level if out is None else out.unionAll(level)
        if passed is not None:
            passed.unpersist()
        if k < longest:
            passed = spark.sparkContext.broadcast(filter_of(total.where("bucket IS NOT NULL"), bits))
    return out, sizes


def _parts(words: Column, longest: int, lengths: range) -> Column:
    """Every stretch of those lengths, shorter than the phrase itself, as text."""
    found = [F.when((F.size(words) > n) & (F.size(words) >= i + n), F.array_join(F.slice(words, i + 1, n), " "))
             for n in lengths for i in range(longest - n + 1)]
    return F.array_compact(F.array(*found))


def score_phrases(phrases: DataFrame, sizes: DataFrame, longest: int = OVERLAP + 1) -> DataFrame:
    """Candidates with their lowest-scoring cut: ``lang, phrase, a, l, r, n, score``; parts of equal count dropped."""
    cand = phrases.where("k > 1").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    # A candidate goes if a longer one holds it and occurs as often.
    held = cand.where(F.size("w") > 2).select(
        "lang", "a", F.explode(_parts(F.col("w"), longest, range(2, longest))).alias("phrase")).groupBy(
        "lang", "phrase").agg(F.max("a").alias("most"))
    cand = cand.join(held, ["lang", "phrase"], "left").where("most IS NULL OR most < a").drop("most")
    cut = F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("cut")
    cuts = cand.select("lang", "phrase", "a", "w", cut).select(
        "lang", "phrase", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("cut") + 1, F.size("w")), " ").alias("right"))
    part = phrases.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    cuts = cuts.join(part, ["lang", "left"])
    cuts = cuts.join(part.select("lang", F.col("left").alias("right"), F.col("l").alias("r")), ["lang", "right"])
    cuts = cuts.join(sizes, "lang")
    big = lambda c: F.col(c).cast("decimal(38,0)")
    top = (F.lit(1000).cast("decimal(38,0)") * big("a") * big("n")).alias("top")
    cuts = cuts.select("lang", "phrase", "a", "l", "r", "n", "cut", top, (big("l") * big("r")).alias("under"))
    cuts = cuts.withColumn("score", F.expr("top div under"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("b"))
    return best.select("lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score")


def mine(docs: DataFrame, support: int = SUPPORT, limit: int = LIMIT, every: int = EVERY,
         bits: int = FILTER_BITS) -> DataFrame:
    """Each language's ``limit`` best phrases: ``lang, rank, phrase, a, l, r, n, score``."""
    chunks = scratch(dictionary(docs, every), "phrases-chunks")
    scored = score_phrases(*frequent(chunks, support, bits=bits))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return scored.withColumn("rank", rank.cast("long")).where(F.col("rank") <= limit).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
