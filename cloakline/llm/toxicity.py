"""Toxicity by maximum-scoring segments of token log-odds.

Training counts each token, and each stem of 4 to 6 characters (``stem*``), in
toxic and in clean labelled texts (one Spark aggregate, a word twice a text at
most); equal texts are one there, so copies don't teach, and a phrase that many
different texts share does.
It turns the counts into log-odds with an informative Dirichlet prior and keeps
all that are significant. At most ``SAMPLE`` labelled documents teach (more than
that are sampled by a hash of their id); this bounds the vocabulary. A word scores as itself, else as its longest kept stem; every
other word slightly lowers the total. A text is scanned once: the Ruzzo-Tompa
list of maximal scoring segments gives every passage. The sum of the passages'
excesses over the extreme-value location of clean texts of that length is
mapped to a probability fitted on all training texts.

Null and empty texts have no passage and get the probability of "no passage".
Without training rows (or with one class only) every score is the share of
toxic ones among the training rows (0 if there are none). Labels that are null are not used; a document
labelled twice counts as toxic if any label says so. Extra columns are kept by ``reject_toxic`` and
ignored elsewhere.
"""

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloakline.llm.common import WORD_BYTES, scratch, utf8

#: Prior weight as a share of the tokens counted; a token scores its log-odds less so
#: many standard errors, if that is at least LEAST.
PRIOR, LEAST_Z, LEAST = 0.02, 2.0, 1.0
#: The most labelled documents that teach.
SAMPLE = 2_000_000
STEMS = (6, 5, 4)
#: One text in so many calibrates.
FOLDS = 4
#: Evidence by bins; the last one holds all that is more than 100 scales above the location, which is certain by far.
BIN, BINS = 0.25, 400
#: The least scale: clean texts may all score alike.
LEAST_SCALE = 0.1
#: A text counts a token at most so often: words come in bursts, and two are as telling as ten.
BURST = 2
#: Bytes of a text cut into words at once, different words counted or remembered at once.
PIECE, HELD = 1 << 20, 150_000


def words(data: bytes) -> Iterator[list[bytes]]:
    """The text's words, in pieces cut between words."""
    data = data.decode("utf-8", "replace").lower().encode() if not data.isascii() else data
    data = data.translate(WORD_BYTES)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


@dataclass
class Model:
    scores: dict[bytes, float] = field(default_factory=dict)
    rest: float = 0.0  # score of every other token
    location: float = 0.0  # of the largest segment in clean texts, less ln(words)
    scale: float = 1.0
    chances: list[float] = field(default_factory=list)  # P(toxic) by bin of evidence
    share: float = 0.0


def stems(word: bytes) -> list[bytes]:
    """The word's stems, longest first, marked so that they differ from words."""
    text = word.decode("utf-8", "replace")
    return [text[:k].encode() + b"*" for k in STEMS if len(text) > k]


def scorer(model: Model):
    """word -> score, None for words that score as the rest; words seen are remembered."""
    known: dict[bytes, float | None] = {}

    def get(word: bytes) -> float | None:
        try:
            return known[word]
        except KeyError:
            if len(known) > HELD:
                known.clear()
            s = model.scores.get(word)
            if s is None:
                s = next((model.scores[x] for x in stems(word) if x in model.scores), None)
            known[word] = s
            return s

    return get


def passages(data: bytes, model: Model, get) -> tuple[list[tuple[int, int, float]], int]:
    """All maximal scoring segments as (first word, end, score), and the number of words.

    Ruzzo and Tompa's scan over the tokens that score above zero; between two
    of them the running total falls by a known amount. A new segment looks for
    the last one whose left total is below its own, following links between such
    segments, and joins it if its right total is also below; so the scan is linear.
    """
    rest = model.rest
    found: list[tuple[float, float, int, int, int]] = []  # totals left and right, first, end, link
    total, n = 0.0, 0
    for piece in words(data):
        last = 0
        for i, s in [(i, s) for i, w in enumerate(piece) if (s := get(w)) is not None]:
            total += rest * (i - last)
            last = i + 1
            if s <= 0:
                total += s
                continue
            left, right, first = total, total + s, n + i
            total = right
            while True:
                j = len(found) - 1
                while j >= 0 and found[j][0] >= left:
                    j = found[j][4]
                if j < 0 or found[j][1] >= right:
                    found.append((left, right, first, n + i + 1, j))
                    break
                left, first = found[j][0], found[j][2]
                del found[j:]
        total += rest * (len(piece) - last)
        n += len(piece)
    return [(a, b, r - lo) for lo, r, a, b, _ in found], n


def evidence(data: bytes, model: Model, get) -> tuple[float, list[tuple[int, int, float]]]:
    """Summed standardised excess of the significant passages, and those passages."""
    found, n = passages(data, model, get)
    cut = max(0.0, math.log(max(n, 1)) + model.location)
    kept = [p for p in found if p[2] > cut]
    return sum(p[2] - cut for p in kept) / model.scale, kept


def bin_of(x: float) -> int:
    return min(BINS - 1, math.ceil(x / BIN))


def score(data: bytes, model: Model, get) -> float:
    if not model.chances:
        return model.share
    return model.chances[bin_of(evidence(data, model, get)[0])]


def _count(batches):
    """Per token and class: its occurrences in the texts, at most ``BURST`` of each word in a text."""
    kinds = pa.schema([("token", pa.binary()), ("y", pa.int32()), ("n", pa.int64())])
    known: dict[bytes, list[bytes]] = {}
    seen: tuple[Counter, Counter] = (Counter(), Counter())

    def rows() -> pa.RecordBatch:
        cols = [(w, y, n) for y in (0, 1) for w, n in seen[y].items()]
        token, y, n = zip(*cols) if cols else ((), (), ())
        for part in seen:
            part.clear()
        return pa.RecordBatch.from_arrays([pa.array(token, pa.binary()), pa.array(y, pa.int32()), pa.array(n, pa.int64())], schema=kinds)

    for b in batches:
        for t, y in zip(b["_t"], b["_y"], strict=True):
            own: Counter[bytes] = Counter()
            for piece in words(t.as_py()):
                own.update(piece)
            into = seen[y.as_py()]
            for w, n in own.items():
                n = min(n, BURST)
                into[w] += n
                x = known.get(w)
                if x is None:
                    x = known[w] = stems(w)
                for stem in x:
                    into[stem] += n
            if len(known) > HELD:
                known.clear()
            if len(seen[0]) + len(seen[1]) > 2 * HELD:
                yield rows()
    yield rows()


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from the rows of ``docs`` that ``labels`` marks (callers filter out held-out rows)."""
    marked = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("toxic") != 0).cast("int")).alias("_y"))
    # Without their texts: which of them are different. Labels grow with the documents: no broadcast.
    text = utf8("text")
    ids = scratch(docs.select("doc_id", F.md5(text).alias("_d")).join(marked.hint("merge"), "doc_id"), "toxic-ids")
    n, ones = ids.agg(F.count("*"), F.sum("_y")).first()
    model = Model(share=ones / n if n else 0.0)
    if n > sample:
        ids = ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(sample / n * (1 << 30)))
    one = ids.groupBy("_d", "_y").agg(F.min("doc_id").alias("doc_id"))
    rows = docs.select("doc_id", F.md5(text).alias("_d"), text.alias("_t")).join(one.hint("merge"), ["doc_id", "_d"])
    rows = rows.dropDuplicates(["doc_id", "_d", "_y"])  # rows that occur twice
    # Tokens are counted on some texts and the chances fitted on the others.
    apart = F.xxhash64("_t") % FOLDS == 0
    counted, rows = rows.where(~apart), rows.where(apart)
    tokens = counted.mapInArrow(_count, "token binary, y int, n long").groupBy("token").agg(
        *[F.coalesce(F.sum(F.when(F.col("y") == y, F.col("n"))), F.lit(0)).cast("double").alias(f"n{y}") for y in (0, 1)])
    tokens = scratch(tokens, "toxic-tokens")
    whole = ~F.endswith("token", F.lit(b"*"))
    t1, t0 = tokens.where(whole).agg(F.sum("n1"), F.sum("n0")).first()
    if not t1 or not t0:
        return model
    # Log-odds ratio with the corpus frequencies as Dirichlet prior, and its z.
    prior = (F.col("n1") + F.col("n0")) * PRIOR
    odds = lambda n, t: F.log((n + prior) / (t + PRIOR * (t1 + t0) - n - prior))
    delta = odds(F.col("n1"), float(t1)) - odds(F.col("n0"), float(t0))
    sure = delta - LEAST_Z * F.sqrt(1 / (F.col("n1") + prior) + 1 / (F.col("n0") + prior))
    kept = (tokens.select("token", "n0", "n1", sure.alias("sure"))
            .where(F.col("sure") >= LEAST).collect())
    model.scores = {bytes(r["token"]): r["sure"] for r in kept}
    # The share of scoring tokens is higher in toxic texts, so every other token speaks against.
    own = [r for r in kept if not r["token"].endswith(b"*")]
    p1, p0 = sum(r["n1"] for r in own) / t1, sum(r["n0"] for r in own) / t0
    model.rest = min(-1e-3, math.log((1 - p1) / (1 - p0)) if p1 < 1 and p0 < 1 else -1e-3)
    # Each calibration text's segment scores; what follows needs no text.
    kinds = "y int, size double, scores array<double>"

    def scored(batches):
        get = scorer(model)
        for b in batches:
            out = [passages(t.as_py(), model, get) for t in b["_t"]]
            yield pa.RecordBatch.from_arrays(
                [b["_y"], pa.array([math.log(max(n, 1)) for _, n in out], pa.float64()),
                 pa.array([[p[2] for p in found] for found, _ in out], pa.list_(pa.float64()))],
                ["y", "size", "scores"])

    rows = scratch(rows.mapInArrow(scored, kinds), "toxic-scores")
    # Extreme-value location and scale (moments of the Gumbel law) over the clean texts.
    top = F.coalesce(F.array_max("scores"), F.lit(0.0)) - F.col("size")
    n, mean, sd = rows.where("y = 0").agg(F.count(top), F.avg(top), F.stddev_pop(top)).first()
    if n:
        model.scale = max(LEAST_SCALE, sd * math.sqrt(6) / math.pi)
        model.location = mean - 0.5772156649015329 * model.scale if sd > 0 else mean
    cut = F.greatest(F.lit(0.0), F.col("size") + model.location)
    over = F.aggregate("scores", F.lit(0.0), lambda x, s: x + F.greatest(F.lit(0.0), s - F.col("cut")))
    bins = rows.withColumn("cut", cut).select(
        "y", F.least(F.lit(BINS - 1), F.ceil(over / model.scale / BIN)).cast("int").alias("bin"))
    counts = {(r["bin"], r["y"]): r["n"] for r in bins.groupBy("bin", "y").agg(F.count("*").alias("n")).collect()}
    model.chances = monotone([(counts.get((k, 1), 0), counts.get((k, 0), 0)) for k in range(BINS)])
    return model


def monotone(counts: list[tuple[int, int]]) -> list[float]:
    """P(toxic) by bin: pooled so that it never falls as the evidence rises."""
    blocks: list[list[float]] = []  # toxic, all, bins
    ones, every = sum(c[0] for c in counts), sum(sum(c) for c in counts)
    base = ones / every if every else 0.0
    for one, zero in counts:
        blocks.append([one + 1e-3 * base, one + zero + 1e-3, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            a = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], a)]
    out = [b[0] / b[1] for b in blocks for _ in range(int(b[2]))]
    # Empty bins above the largest evidence seen belong with it.
    last = max((k for k, c in enumerate(counts) if sum(c)), default=-1)
    return [out[min(k, max(last, 0))] for k in range(len(counts))]


def with_score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """``docs`` with a column ``out`` (0 to 1); other columns pass through untouched."""

    @F.pandas_udf("double")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        get = scorer(model)
        for texts in batches:
            yield texts.map(lambda t: score(bytes(t), model, get)).astype("float64")

    return docs.withColumn(out, udf(utf8("text")))


def find_passages(docs: DataFrame, model: Model) -> DataFrame:
    """Every significant toxic passage: ``doc_id, first_word, end_word, score``."""
    kinds = "array<struct<first_word:long,end_word:long,score:double>>"

    @F.pandas_udf(kinds)
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        get = scorer(model)
        for texts in batches:
            yield texts.map(lambda t: [dict(first_word=a, end_word=b, score=s)
                                       for a, b, s in evidence(bytes(t), model, get)[1]])

    return docs.select("doc_id", F.inline(udf(utf8("text"))))


def reject_toxic(docs: DataFrame, model: Model, cut: float = 0.3) -> DataFrame:
    """``docs`` without the rows that score ``cut`` or more; columns unchanged."""
    held = with_score(docs.select(F.struct("*").alias("_r"), F.col("text")), model, "_s")
    return held.where(F.col("_s") < cut).select("_r.*")
