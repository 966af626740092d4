"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every run of words of every item. A text's words are
streamed through it once, with the length of the longest match that ends at
each word. A match of ``window`` words or more covers its words; an item of
fewer words counts where it occurs whole. Spans can be cut out, and texts
whose covered share exceeds a limit dropped.

Words are runs of ASCII letters and digits and of non-ASCII characters, A-Z
lower-cased. Null and empty texts have no words and are clean; items without
words have no window; repeated items count once by item_id, an item with a null
id counts under the empty id. Extra columns are kept.

Items are dealt to blocks of about ``BLOCK_WORDS`` words, longer ones cut into
stretches that overlap by a window less one word. A task builds each block's
automaton and packs it into sorted arrays (about 80 bytes a word, and its
vocabulary); the blocks are written to the shared folder and read there by the
scanning tasks, one after the other for each lot of texts. So texts are read
once, a worker holds one block, and nothing of the benchmark passes the driver.
"""

import pickle
import re
import urllib.parse
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloakline.llm.common import LOWER_BYTES, WORD_BYTES, alnum_words, scratch, utf8

WINDOW = 10
#: Words of items in one automaton, about (building it takes some 0.7 KB a word); bytes of texts scanned by one block at once.
BLOCK_WORDS, LOT = 400_000, 1 << 24
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


class Automaton:
    """Suffix automaton of several word sequences, with the windows' items by state."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.size = [-1], [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        # at[state]: the state of the match's last `window` words, -1 if it is shorter.
        order = sorted(range(len(self.size)), key=self.size.__getitem__)
        self.at = [-1] * len(order)
        for v in order[1:]:
            up = self.link[v]
            self.at[v] = self.at[up] if self.size[up] >= window else v if self.size[v] >= window else -1
        self.items: dict[int, set[str]] = {}
        whole: dict[int, list[tuple[int, str]]] = {}
        for name, words in items:
            v = 0
            for i, w in enumerate(words, 1):
                v = self.next[v][w]
                if i >= window:
                    self.items.setdefault(self.at[v], set()).add(name)
            if 0 < len(words) < window:
                # The whole item, as a string of this state (its longest may be longer).
                whole.setdefault(v, []).append((len(words), name))
        # short[state]: the short items that end where a match in this state ends.
        self.short: dict[int, list[tuple[int, str]]] = {}
        if whole:
            for v in order[1:]:
                found = whole.get(v, []) + self.short.get(self.link[v], [])
                if found:
                    self.short[v] = found
        self.window = window

    def _new(self, size: int, link: int, edges: dict[bytes, int]) -> int:
        self.size.append(size)
        self.link.append(link)
        self.next.append(edges)
        return len(self.size) - 1

    def _split(self, p: int, w: bytes, q: int) -> int:
        """A state for the strings of q that end in p's and w."""
        c = self._new(self.size[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = c
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        return c

    def _extend(self, last: int, w: bytes) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.size[q] == self.size[last] + 1 else self._split(last, w, q)
        new, p = self._new(self.size[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, w, q)
        return new

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Covered runs of words as (first, end), merged, and the items whose windows occur."""
        nxt, link, size, window, short = self.next, self.link, self.size, self.window, self.short
        root = nxt[0]
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        v = n = 0
        for i, w in enumerate(words):
            if w not in root:
                v = n = 0
                continue
            to = nxt[v].get(w)
            while to is None:
                v = link[v]
                n = size[v]
                to = nxt[v].get(w)
            v = to
            n += 1
            reach = 0
            if n >= window:
                reach = n
                found |= self.items[self.at[v]]
            if short and v in short:
                for k, name in short[v]:
                    if k <= n:
                        found.add(name)
                        reach = max(reach, k)
            if reach:
                first = i + 1 - reach
                while spans and spans[-1][1] >= first:
                    first = min(first, spans.pop()[0])
                spans.append((first, i + 1))
        return spans, found


class Packed:
    """An automaton as arrays: transitions sorted by state and word, the windows' items by state."""

    @classmethod
    def load(cls, data: bytes) -> "Packed":
        new = cls.__new__(cls)
        new.__dict__.update(pickle.loads(data))
        return new

    def dump(self) -> bytes:
        """Arrays, lists and dicts only: whoever loads it needs no class of this package."""
        return pickle.dumps(self.__dict__, pickle.HIGHEST_PROTOCOL)

    def __init__(self, auto: Automaton):
        self.vocab = {w: i for i, w in enumerate(auto.next[0])}
        self.root = array("i", auto.next[0].values())
        n = max(1, len(self.vocab))
        edges = sorted((v * n + self.vocab[w], to) for v, own in enumerate(auto.next) if v for w, to in own.items())
        self.edges, self.to = array("q", (k for k, _ in edges)), array("i", (t for _, t in edges))
        self.link, self.size, self.at = (array("i", x) for x in (auto.link, auto.size, auto.at))
        self.names = sorted({x for own in auto.items.values() for x in own} | {x for own in auto.short.values() for _, x in own})
        number = {x: i for i, x in enumerate(self.names)}
        self.first, self.items = array("i", [0]), array("i")
        for v in range(len(auto.link)):
            self.items.extend(sorted(number[x] for x in auto.items.get(v, ())))
            self.first.append(len(self.items))
        self.short, self.window = auto.short, auto.window

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Covered runs of words as (first, end), merged, and the items whose windows occur."""
        get, root, edges, to_of, link, size = self.vocab.get, self.root, self.edges, self.to, self.link, self.size
        many, last, window, short = max(1, len(self.vocab)), len(self.edges), self.window, self.short
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        names: set[str] = set()
        v = n = 0
        for i, w in enumerate(words):
            k = get(w)
            if k is None:
                v = n = 0
                continue
            while v:
                e = bisect_left(edges, v * many + k)
                if e < last and edges[e] == v * many + k:
                    v = to_of[e]
                    break
                v = link[v]
                n = size[v]
            else:
                v = root[k]
            n += 1
            reach = 0
            if n >= window:
                reach, a = n, self.at[v]
                found.update(self.items[self.first[a]:self.first[a + 1]])
            if short and v in short:
                for length, name in short[v]:
                    if length <= n:
                        names.add(name)
                        reach = max(reach, length)
            if reach:
                first = i + 1 - reach
                while spans and spans[-1][1] >= first:
                    first = min(first, spans.pop()[0])
                spans.append((first, i + 1))
        return spans, names | {self.names[x] for x in found}


def _stretches(window: int, block_words: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, texts, sizes = [], [], []
            for name, t in zip(b["i"].to_pylist(), b["t"]):
                words = alnum_words(t.as_py())
                for at in range(0, max(1, len(words) - window + 1), block_words):
                    part = words[at:at + block_words + window - 1]
                    names.append(name), texts.append(b" ".join(part)), sizes.append(len(part))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.binary()),
                                              pa.array(sizes, pa.int64())], ["i", "t", "n"])

    return cut


def automata(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> tuple[list[str], int]:
    """The blocks' packed automata, written to the shared folder: the files' paths, the number of blocks."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), utf8("text").alias("t")).distinct()
    parts = scratch(rows.mapInArrow(_stretches(window, block_words), "i string, t binary, n long").where("n > 0"), "decontam-items")
    blocks = max(1, -(-(parts.agg(F.sum("n")).first()[0] or 0) // block_words))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        items = sorted((i, bytes(t).split()) for i, t in zip(pdf["i"], pdf["t"]))
        return pd.DataFrame({"packed": [Packed(Automaton(items, window)).dump()]})

    dealt = parts.withColumn("block", F.pmod(F.xxhash64("i", "t"), F.lit(blocks)))
    made = scratch(dealt.groupBy("block").applyInPandas(build, "packed binary"), "decontam-blocks")
    return list(made.inputFiles()), blocks


def _blocks(files: list[str]) -> Iterator[Packed]:
    for path in files:
        path = urllib.parse.unquote(path)
        plain = re.sub("^file:/+", "/", path)
        fs, at = pafs.FileSystem.from_uri(plain) if "://" in plain else (pafs.LocalFileSystem(), plain)
        with pq.ParquetFile(at, filesystem=fs) as f:
            for batch in f.iter_batches(batch_size=1):
                for x in batch["packed"]:
                    yield Packed.load(x.as_py())


def _marker(files: list[str], blocks: int):
    """A UDF text bytes -> words, covered spans (in words), items."""

    def scan(texts: list[bytes], kept: list[Packed]) -> pd.DataFrame:
        spans: list[list] = [[] for _ in texts]
        items: list[set] = [set() for _ in texts]
        split = [alnum_words(t) for t in texts]
        for block in kept or _blocks(files):
            if blocks == 1 and not kept:
                kept.append(block)  # a single block stays
            for i, words in enumerate(split):
                got, found = block.scan(words)
                spans[i] += got
                items[i] |= found
        out = []
        for words, got, found in zip(split, spans, items):
            merged: list[list[int]] = []
            for x, y in sorted(got):
                if merged and x <= merged[-1][1]:
                    merged[-1][1] = max(y, merged[-1][1])
                else:
                    merged.append([x, y])
            out.append((len(words), [{"a": x, "b": y} for x, y in merged], sorted(found)))
        return pd.DataFrame(out, columns=["n_words", "spans", "items"])

    @F.pandas_udf("n_words long, spans array<struct<a:long,b:long>>, items array<string>")
    def mark(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        kept: list[Packed] = []
        for text in batches:
            lots, size = [[]], 0
            for t in text:
                if lots[-1] and size + len(t) > LOT:
                    lots.append([])
                    size = 0
                lots[-1].append(bytes(t))
                size += len(t)
            yield pd.concat([scan(x, kept) for x in lots], ignore_index=True)

    # Else the optimizer evaluates it in a filter and again behind it, with a worker each.
    return mark.asNondeterministic()


def _mark(rows: DataFrame, benchmark: DataFrame, window: int, block_words: int) -> DataFrame:
    """``rows`` has a struct ``row``; adds ``m``: n_words, covered spans (in words) and items."""
    files, blocks = automata(benchmark, window, block_words)
    return rows.select("row", _marker(files, blocks)(utf8("row.text")).alias("m"))


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                      block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(row, n_words, n_hit, items, spans)``: the input row, its words, those covered, the items found."""
    out = _mark(docs.select(F.struct("*").alias("row")), benchmark, window, block_words)
    hit = F.aggregate("m.spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return out.select("row", "m.n_words", hit.alias("n_hit"), "m.items", "m.spans")


def _cut(text: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for t, sp in zip(text, spans):
        data = bytes(t)
        words = list(_WORD.finditer(data.translate(LOWER_BYTES)))
        at, left = 0, []
        for s in sp:
            left.append(data[at:words[s["a"]].start()])
            at = words[s["b"] - 1].end()
        out.append(b"".join([*left, data[at:]]).decode())
    return pd.Series(out)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.0,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without contaminated passages; the columns are those of ``docs``.

    A text whose covered share of words exceeds ``max_coverage`` is dropped, in
    every other text the covered spans are cut out. With the default, 0, every
    contaminated document goes; with 1, spans are cut out and no document goes.
    """
    m = mark_contaminated(docs, benchmark, window, block_words)
    kept = m.where(F.col("n_hit") <= F.col("n_words") * max_coverage)
    if max_coverage <= 0:  # what is kept has nothing to cut out
        return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
    text = F.when(F.col("n_hit") > 0, F.pandas_udf(_cut, "string")(utf8("row.text"), F.col("spans"))).otherwise(F.col("row.text"))
    return kept.select(*[(text if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns])
