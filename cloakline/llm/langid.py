"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (seeded by its code point); the
vector of a trigram binds (multiplies) those of its letters, permuted (rolled)
by their place; a text bundles (sums) the vectors of its trigrams. The sums of
all training texts of a language are its prototype, and a text gets the
language whose prototype has the largest cosine with the text's vector.

Letters are lower-cased; every run of other characters counts as one space,
and a text starts and ends with one. Texts that are null or hold no letter get
``und`` and score 0, and so does everything if no training text has a letter.
Ties go to the smaller language. Languages that are null teach nothing.
Training and prediction take whole texts; extra columns are kept.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloakline.llm.common import utf8

DIMENSIONS, SEED = 1024, 11
#: Texts bundled at once, their characters at most (one longer text is cut), trigrams bound at once.
TEXTS, CHARS, BOUND = 256, 1 << 20, 2048
SPACE = 32


class Profiles:
    """Trigram counts and vectors; letters and their vectors are remembered."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        self.d, self.seed = dimensions, seed
        self.kind = np.zeros(0x110000, np.int32)  # 0: not seen; else 1 + the letter's code point
        self.seen = np.zeros(0x110000, bool)
        self.letters: dict[int, np.ndarray] = {}

    def fold(self, codes: np.ndarray) -> np.ndarray:
        """Code points as letters, everything else as SPACE."""
        new = np.unique(codes[~self.seen[codes]])
        for c in new.tolist():
            ch = chr(c).lower()
            self.kind[c] = ord(ch[0]) if ch[0].isalpha() else SPACE
            self.seen[c] = True
        return self.kind[codes]

    def letter(self, c: int) -> np.ndarray:
        if c not in self.letters:
            if len(self.letters) > 20_000:
                self.letters.clear()
            self.letters[c] = np.random.default_rng([self.seed, c]).integers(0, 2, self.d, np.int8) * 2 - 1
        return self.letters[c]

    def bind(self, grams: np.ndarray) -> np.ndarray:
        """Trigrams, packed 21 bits a letter, to vectors."""
        parts = [(grams >> s) & 0x1FFFFF for s in (42, 21, 0)]
        out = None
        for turn, p in zip((2, 1, 0), parts):
            codes, at = np.unique(p, return_inverse=True)
            own = np.stack([np.roll(self.letter(c), turn) for c in codes.tolist()])[at]
            out = own if out is None else out * own
        return out.astype(np.float32)

    def grams(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Packed trigrams of all pieces (``pieces``), and the piece each belongs to; those without letters have none."""
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        size = np.array([len(t) for t in texts])
        owner = np.repeat(np.arange(len(texts)), size)
        kind = self.fold(codes).astype(np.int64)
        keep = np.ones(len(kind), bool)
        # A space after a space of the same text goes.
        keep[1:] = ~((kind[1:] == SPACE) & (kind[:-1] == SPACE) & (owner[1:] == owner[:-1]))
        kind, owner = kind[keep], owner[keep]
        if len(kind) < 3:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        packed = kind[:-2] << 42 | kind[1:-1] << 21 | kind[2:]
        inside = owner[:-2] == owner[2:]
        return packed[inside], owner[:-2][inside]

    def bundle(self, texts: list[str], owner: list[int], rows: int) -> np.ndarray:
        """``rows`` vectors: row r is the sum over the texts that ``owner`` gives it."""
        out = np.zeros((rows, self.d), np.float64)
        own = np.asarray(owner)
        packed, text = self.grams(texts)
        if not len(packed):
            return out
        grams, at = np.unique(packed, return_inverse=True)
        to = own[text]
        for low in range(0, len(grams), BOUND):
            part = (at >= low) & (at < low + BOUND)
            n = min(BOUND, len(grams) - low)
            counts = np.bincount(to[part] * n + at[part] - low, minlength=rows * n).reshape(rows, n)
            out += counts.astype(np.float32) @ self.bind(grams[low:low + n])
        return out


def _letter(c: str) -> bool:
    return c.lower()[0].isalpha()


def carried(text: str, at: int) -> str:
    """The last two symbols before ``at``: letters, and one space for what lies between (and before the text)."""
    out = ""
    while len(out) < 2:
        if at and _letter(text[at - 1]):
            at -= 1
            out = text[at] + out
            continue
        while at and not _letter(text[at - 1]):
            at -= 1
        out = " " + out
        if not at:
            break
    return out


def pieces(text: str, size: int | None = None) -> Iterator[str]:
    """A text between spaces, cut if it is long; a piece begins with the two symbols before it, so no trigram is lost or false."""
    size = size or CHARS
    for at in range(0, max(len(text), 1), size):
        end = at + size
        yield (carried(text, at) if at else " ") + text[at:end] + (" " if end >= len(text) else "")


def groups(texts: list[str]) -> Iterator[tuple[int, list[str], list[int]]]:
    """(first text, pieces, owner of each piece) for runs of TEXTS texts or CHARS characters."""
    first, part, owner, size = 0, [], [], 0
    for i, t in enumerate(texts):
        if i > first and (i - first >= TEXTS or size + len(t) > CHARS):
            yield first, part, owner
            first, part, owner, size = i, [], [], 0
        for p in pieces(t):
            part.append(p)
            owner.append(i - first)
        size += len(t)
    if part:
        yield first, part, owner


def _text(data) -> str:
    return bytes(data).decode("utf-8", "replace")


def train(docs: DataFrame, dimensions: int = DIMENSIONS, seed: int = SEED) -> dict[str, list[float]]:
    """Prototypes from ``text`` and ``lang``; one vector per language comes to the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, total = Profiles(dimensions, seed), {}
        for b in batches:
            langs = b["lang"].to_pylist()
            names = sorted(set(langs))
            place = {x: i for i, x in enumerate(names)}
            texts = [_text(t.as_py()) for t in b["_t"]]
            for first, part, owner in groups(texts):
                own = [place[langs[first + o]] for o in owner]
                for x, v in zip(names, made.bundle(part, own, len(names))):
                    total[x] = total.get(x, 0) + v
        rows = [(x, i, v) for x, vec in total.items() for i, v in enumerate(vec.tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 3,
                                            (pa.string(), pa.int32(), pa.float64()))], ["lang", "i", "v"])

    known = docs.where("lang IS NOT NULL").select("lang", utf8("text").alias("_t"))
    out: dict[str, list[float]] = {}
    for r in known.mapInArrow(sums, "lang string, i int, v double").groupBy("lang", "i").agg(
            F.sum("v").alias("v")).toLocalIterator():
        out.setdefault(r["lang"], [0.0] * dimensions)[r["i"]] = r["v"]
    return {x: v for x, v in sorted(out.items()) if any(v)}


def predict(docs: DataFrame, prototypes: dict[str, list[float]], out: str = "lang", dimensions: int = DIMENSIONS,
            seed: int = SEED) -> DataFrame:
    """``docs`` with a struct column ``out``: ``lang_pred`` and ``score``, the cosine (0 if negative)."""
    names = list(prototypes)
    base = np.array([prototypes[x] for x in names]).reshape(len(names), dimensions)
    base = base / np.linalg.norm(base, axis=1, keepdims=True) if names else base

    def best(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        made = Profiles(dimensions, seed)
        for texts in batches:
            strings = [_text(t) for t in texts]
            pred, score = ["und"] * len(strings), np.zeros(len(strings))
            for first, part, owner in groups(strings):
                n = owner[-1] + 1
                v = made.bundle(part, owner, n)
                long = np.linalg.norm(v, axis=1)
                if not names:
                    continue
                cos = v @ base.T / np.where(long > 0, long, 1)[:, None]
                for i in range(n):
                    if any(c.isalpha() for c in strings[first + i]):
                        k = int(np.argmax(cos[i]))
                        pred[first + i], score[first + i] = names[k], min(1.0, max(0.0, cos[i, k]))
            yield pd.DataFrame({"lang_pred": pred, "score": score})

    return docs.withColumn(out, F.pandas_udf(best, "lang_pred string, score double")(utf8("text")))
