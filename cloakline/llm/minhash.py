"""MinHash near-dedup with tensored banding.

A text's set is its distinct word shingles. Two collections of ``GROUPS``
groups of ``ROWS`` minhashes each are computed; the key of table (i, j) is
group i of the first collection with group j of the second, so ``2 * GROUPS``
groups give ``GROUPS ** 2`` tables of ``2 * ROWS`` minhashes. A pair of
similarity s shares a table with chance ``(1 - (1 - s**ROWS) ** GROUPS) ** 2``;
with 3 and 16 a pair at 0.8 is missed once in 50,000. Only groups that another
document has as well count, so documents without relatives are in no table. The
256 keys of a document are not written out: two documents share a table if they
share a group of the first collection, on which they are joined, and any group
of the second, which is the join's condition.

Candidates are verified on the full sets. What is asked for is the components
of the link graph, so pairs inside a component needn't be tested: in each round
every document is tested against one centre among its tables (centres are drawn
anew each round), links merge components, and groups of one component are done.
After ``ROUNDS`` rounds, or one that finds nothing new, what is left is compared
whole: documents that share tables form clusters, and in a cluster every document
outside the largest component is compared, in bounded blocks, with all others it
shares a table with. A block pair returns at most a spanning forest of its links.

Texts with fewer words than a shingle have their word sequence as their only
shingle; null texts and texts without words have an empty set and no link.
Texts with equal sets are one class from the start. In ``near_duplicates`` rows
that agree in doc_id are one node, and a null doc_id is the node ``2**63 - 1``;
``dedup`` has a node for each (doc_id, text), a 64-bit hash of both. An empty
table gives an empty result. Extra columns are kept by ``dedup``.
"""

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloakline.llm.common import BLANKS, apart, blank_words, components, identity, scratch, utf8

GROUPS, ROWS = 16, 3
#: Rounds of tests against centres at most.
ROUNDS = 3
#: Documents of a block, and their shingles, about.
BLOCK, BLOCK_SHINGLES = 512, 1_000_000
#: Members tested against one centre in one sorted run.
MEMBERS = 256
#: Shingles hashed at once; word hashes a worker remembers (some 0.2 KB each).
PIECE, KNOWN = 1 << 12, 100_000
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31, _S17, _S47 = (np.uint64(k) for k in (30, 27, 31, 17, 47))


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit value scattered over all 64 bits."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


class Shingler:
    """Texts to sorted arrays of shingle hashes; word hashes are remembered."""

    def __init__(self, width: int):
        self.width, self.known = width, {}

    def word(self, w: bytes) -> int:
        if len(self.known) >= KNOWN:
            self.known.clear()
        h = self.known[w] = int.from_bytes(blake2b(w, digest_size=8).digest(), "little")
        return h

    def __call__(self, data: bytes) -> np.ndarray:
        words, get = blank_words(data), self.known.get
        hashes = np.array([h if (h := get(w)) is not None else self.word(w) for w in words], np.uint64)
        if not len(hashes):
            return hashes
        k = min(self.width, len(hashes))
        out = np.zeros(len(hashes) - k + 1, np.uint64)
        for i in range(k):
            out = mixed((out << _S17 | out >> _S47) + hashes[i:len(hashes) - k + 1 + i])
        return np.unique(out)


def _signatures(width: int, groups: int, rows: int):
    draw = np.random.default_rng(5)
    n = 2 * groups * rows
    mul = draw.integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1)
    add = draw.integers(0, 2**63, n, np.uint64)
    lane = mixed(np.arange(1, 2 * groups + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(width)
        for b in batches:
            size, one, two, keys = [], [], [], []
            for t in b["_t"]:
                s = shingles(t.as_py())
                size.append(len(s))
                if not len(s):
                    one.append(0), two.append(0), keys.append(None)
                    continue
                digest = blake2b(s.tobytes(), digest_size=16).digest()
                one.append(int.from_bytes(digest[:8], "little", signed=True))
                two.append(int.from_bytes(digest[8:], "little", signed=True))
                low = np.full(n, np.uint64(2**64 - 1))
                for at in range(0, len(s), PIECE):
                    np.minimum(low, (mul[:, None] * s[None, at:at + PIECE] + add[:, None]).min(1), out=low)
                key = lane
                for r in range(rows):
                    key = mixed(key + low[r::rows])
                keys.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b["_k"], b["_h"], pa.array(size, pa.int64()), pa.array(one, pa.int64()),
                 pa.array(two, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                ["_k", "_h", "n", "s1", "s2", "keys"])

    return run


def _verify(width: int, least: int):
    """Rows sorted by (centre, part, role): the centre's text, then its members'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, at, centre = Shingler(width), None, None
        for b in batches:
            src, dst = [], []
            cols = (b[x].to_pylist() for x in ("c", "ch", "part", "role", "node", "_t"))
            for c, ch, part, role, node, t in zip(*cols):
                if role == 0:
                    at, centre = (c, ch, part), shingles(t)
                    continue
                if at != (c, ch, part):
                    raise ValueError("a centre's text is missing")
                s = shingles(t)
                both = len(np.intersect1d(s, centre, assume_unique=True))
                if 100 * both >= least * (len(s) + len(centre) - both):
                    src.append(c), dst.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], ["src", "dst"])

    return run


def near_duplicates(docs: DataFrame, width: int = 5, least: int = 80, groups: int = GROUPS,
                    rows: int = ROWS) -> DataFrame:
    """``(_k, _h, n_shingles, component_id)``, one row per document.

    Documents are linked if their Jaccard similarity is ``least`` percent or
    more; ``component_id`` is the smallest ``_k`` reachable.
    """
    texts = docs.select(*identity(), utf8("text").alias("_t"))
    sig = scratch(texts.mapInArrow(
        _signatures(width, groups, rows),
        "_k long, _h long, n long, s1 long, s2 long, keys array<long>"), "minhash")
    # One class per set; the smallest document stands for it.
    first = sig.where("n > 0").groupBy("s1", "s2").agg(F.min(F.struct("_k", "_h")).alias("r"))
    reps = scratch(first.select("s1", "s2", "r._k", "r._h"), "minhash-classes")
    parts = (sig.join(reps.select("_k", "_h"), ["_k", "_h"], "left_semi").dropDuplicates(["_k", "_h"])
             .select(F.col("_k").alias("node"), F.col("_h").alias("hash"), "n", F.posexplode("keys").alias("g", "key")))
    shared = parts.groupBy("g", "key").agg(F.count("*").alias("m")).where("m > 1").select("g", "key")
    own = parts.join(apart(shared), ["g", "key"]).groupBy("node", "hash", "n").agg(
        F.collect_list(F.when(F.col("g") < groups, F.col("key"))).alias("a"),
        F.collect_list(F.when(F.col("g") >= groups, F.col("key"))).alias("b"))
    live = scratch(own.where("size(a) > 0 AND size(b) > 0").select(
        F.explode("a").alias("key"), "node", "hash", "n", "b", F.col("node").alias("comp")), "minhash-groups")
    texts = texts.withColumnRenamed("_k", "node").withColumnRenamed("_h", "hash")
    keys = sig.select(F.col("_k").alias("node"), F.col("_h").alias("hash"), "keys")
    keys = keys.join(live.select("node", "hash").distinct(), ["node", "hash"], "left_semi").dropDuplicates(["node", "hash"])
    texts = scratch(texts.join(keys, ["node", "hash"]).dropDuplicates(["node", "hash"]), "minhash-texts")
    comp = components(_settle(live, texts, width, least, groups))
    node = sig.join(reps.select("s1", "s2", F.col("_k").alias("node")), ["s1", "s2"], "left")
    return node.join(comp, "node", "left").groupBy("_k", "_h").agg(
        F.max("n").alias("n_shingles"), F.min(F.coalesce("component", "node", "_k")).alias("component_id"))


def _settle(live: DataFrame, texts: DataFrame, width: int, least: int, groups: int) -> DataFrame:
    """Links that connect what candidates connect: no two components share an untested pair."""
    links = live.sparkSession.createDataFrame([], "src long, dst long")
    for turn in range(ROUNDS):
        pairs = _centres(live, turn).where(f"100 * least(n, cn) >= {least} * greatest(n, cn)")
        found = scratch(_test(scratch(pairs, "minhash-pairs"), texts, width, least), "minhash-links")
        if found.isEmpty():
            break
        links = links.unionAll(found)
        comp = components(links).withColumnRenamed("component", "comp")
        live = live.drop("comp").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        open_ = live.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y")
        live = scratch(live.join(apart(open_.select("key")), "key"), "minhash-groups")
        if live.isEmpty():
            return links
    return links.unionAll(scratch(_compare_left(live, texts, width, least, groups), "minhash-links"))


def _compare_left(live: DataFrame, texts: DataFrame, width: int, least: int, groups: int) -> DataFrame:
    """Links between components that share groups; see the module's text."""
    # Clusters are connected by tables: a group of the first collection with one of the second.
    tables = live.select("key", "node", F.explode("b").alias("other"))
    low = tables.groupBy("key", "other").agg(F.min("node").alias("low"), F.count("*").alias("m")).where("m > 1")
    cluster = components(tables.join(apart(low), ["key", "other"]).select("node", "low"), "node", "low")
    docs = scratch(live.select("node", "hash", "n", "comp").distinct().join(
        cluster.withColumnRenamed("component", "cluster"), "node"), "minhash-left")
    main = docs.groupBy("cluster", "comp").agg(F.count("*").alias("c")).groupBy("cluster").agg(
        F.max(F.struct("c", "comp")).alias("m")).select("cluster", F.col("m.comp").alias("main"))
    docs = docs.join(apart(main), "cluster").withColumn("out", F.col("comp") != F.col("main"))

    def blocks(which: str) -> Column:
        n = F.greatest(F.count(F.when(F.expr(which), 1)) / BLOCK,
                       F.sum(F.when(F.expr(which), F.col("n"))) / BLOCK_SHINGLES)
        return F.greatest(F.ceil(n), F.lit(0)).cast("long")

    sizes = docs.groupBy("cluster").agg(blocks("out").alias("no"), blocks("NOT out").alias("ni")).where("no > 0")
    docs = docs.join(apart(sizes), "cluster").withColumn(
        "own", F.pmod(F.xxhash64("node", "hash"), F.when(F.col("out"), F.col("no")).otherwise(F.col("ni"))))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    # Keys (i, j, inner): outer block i with outer block j >= i, or with inner block j.
    outer = F.transform(upto("no"), lambda o: F.struct(
        F.least(F.col("own"), o).alias("i"), F.greatest(F.col("own"), o).alias("j"), F.lit(False).alias("inner"),
        (F.col("own") > o).cast("int").alias("side")))
    cross = F.transform(upto("ni"), lambda o: F.struct(
        F.col("own").alias("i"), o.alias("j"), F.lit(True).alias("inner"), F.lit(0).alias("side")))
    inner = F.transform(upto("no"), lambda o: F.struct(
        o.alias("i"), F.col("own").alias("j"), F.lit(True).alias("inner"), F.lit(1).alias("side")))
    dealt = docs.select("cluster", "node", "hash", "n", "comp", F.inline(
        F.when(F.col("out"), F.concat(outer, cross)).otherwise(inner)))
    rows = dealt.join(texts, ["node", "hash"])
    return rows.groupBy("cluster", "i", "j", "inner").applyInPandas(
        _compare(width, least, groups), "src long, dst long")


def _compare(width: int, least: int, groups: int):
    """Two blocks (or one with itself) to a spanning forest of the links between components."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        shingles = Shingler(width)
        pdf = pdf.sort_values(["side", "node", "hash"])
        same = not pdf["inner"].iloc[0] and pdf["i"].iloc[0] == pdf["j"].iloc[0]
        sets = [shingles(bytes(t)) for t in pdf["_t"]]
        size = np.array([len(s) for s in sets])
        start = np.append(0, np.cumsum(size))
        ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
        keys = np.stack([np.asarray(k, np.int64) for k in pdf["keys"]])
        node, comp = pdf["node"].to_numpy(), pdf["comp"].to_numpy()
        cut = len(sets) if same else int((pdf["side"] == 0).sum())
        up: dict[int, int] = {}

        def root(c: int) -> int:
            while c in up:
                c = up[c]
            return c

        found = []
        here = np.zeros(int(ids.max()) + 1, bool)
        for a in range(cut):
            first = a + 1 if same else cut
            other = np.arange(first, len(sets))
            alike = keys[first:] == keys[a]
            other = other[
                (comp[first:] != comp[a])
                & (100 * np.minimum(size[first:], size[a]) >= least * np.maximum(size[first:], size[a]))
                & alike[:, :groups].any(1) & alike[:, groups:].any(1)]
            if not len(other):
                continue
            own = ids[start[a]:start[a + 1]]
            here[own] = True
            both = np.array([np.count_nonzero(here[ids[start[b]:start[b + 1]]]) for b in other.tolist()])
            here[own] = False
            for b in other[100 * both >= least * (size[a] + size[other] - both)].tolist():
                x, y = root(int(comp[a])), root(int(comp[b]))
                if x != y:
                    up[max(x, y)] = min(x, y)
                    found.append((int(node[a]), int(node[b])))
        return pd.DataFrame(found, columns=["src", "dst"], dtype="int64")

    return run


def _centres(live: DataFrame, turn: int) -> DataFrame:
    """Pairs (c, node) that share a table: each document's most frequent centre over its groups."""
    order = F.col("node") if turn == 0 else F.xxhash64(F.lit(turn), F.col("node"))
    mid = live.groupBy("key").agg(F.min(F.struct(order.alias("o"), "node", "hash", "n", "comp", "b")).alias("c"))
    count = live.join(apart(mid), "key").where("c.comp <> comp AND arrays_overlap(b, c.b)").groupBy(
        "node", "hash", "n", F.col("c.node").alias("c"), F.col("c.hash").alias("ch"), F.col("c.n").alias("cn")).agg(
        F.count("*").alias("m"))
    best = count.groupBy("node", "hash", "n").agg(F.max(F.struct("m", "c", "ch", "cn")).alias("b"))
    return best.select("node", "hash", "n", "b.c", "b.ch", "b.cn")


def _test(pairs: DataFrame, texts: DataFrame, width: int, least: int) -> DataFrame:
    """The pairs (c, node) whose sets are similar enough."""
    n = pairs.groupBy("c", "ch").agg(F.ceil(F.count("*") / MEMBERS).alias("parts"))
    mine = pairs.join(n, ["c", "ch"]).select(
        "c", "ch", F.pmod(F.xxhash64("node"), "parts").alias("part"), F.lit(1).alias("role"), "node", "hash")
    heads = n.select("c", "ch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
                     F.lit(0).alias("role"), F.col("c").alias("node"), F.col("ch").alias("hash"))
    want = mine.unionAll(heads)
    rows = want.join(texts, ["node", "hash"])
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["c", "ch", "part"]
    return rows.select(*key, "role", "node", "_t").repartition(parts, *key).sortWithinPartitions(
        *key, "role").mapInArrow(_verify(width, least), "src long, dst long")


def dedup(docs: DataFrame, width: int = 5, least: int = 80) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest (doc_id, text hash).

    A document is a (doc_id, text) here, so ids that are null or shared join
    nothing; a null id is no id, and of equal texts without one a single row stays.
    """
    rows = docs.select(F.struct("*").alias("row")).select("row", *identity("row."))
    # Null ids with words; ``has`` is never null.
    has = F.col("row.doc_id").isNull() & F.coalesce(F.col("row.text").rlike(f"[^{BLANKS}]"), F.lit(False))
    none = rows.where(has).groupBy("_k", "_h").agg(
        F.min_by("row", F.to_json("row")).alias("row")).select("row", "_k", "_h")
    rows = rows.where(~has).unionAll(none)
    keyed = docs.select(*identity(), "text").withColumn("doc_id", F.xxhash64("_k", "_h"))
    near = near_duplicates(keyed.select("doc_id", "text"), width, least).select(
        F.col("_k").alias("doc_id"), F.col("component_id").alias("component"))
    near = scratch(keyed.select("doc_id", "_k", "_h").distinct().join(near.distinct(), "doc_id"), "minhash-rows")
    place = F.struct("_k", "_h")
    first = near.groupBy("component").agg(F.min(place).alias("f"), F.count("*").alias("m")).where("m > 1")
    gone = near.join(apart(first.select("component", "f")), "component").where(place != F.col("f")).select("_k", "_h")
    return rows.join(gone, ["_k", "_h"], "left_anti").select("row.*")
