"""Phrase mining against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from cases import empty, frame
from cloakline.llm import phrases


def pieces(text):
    for p in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
        words = re.findall(r"[^\x20\x09]+", p)
        if words:
            yield words


def brute(rows, support, limit):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for k in range(1, 6):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cand = {x: a for x, a in f.items() if a >= support and len(x[1]) > 1}
    out = {}
    for (lang, p), a in cand.items():
        if any(la == lang and len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q)))
               for (la, q), b in cand.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], n[lang]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n, -s)
                  for lang, x in out.items() for i, (s, a, p, left, right, n) in enumerate(sorted(x)[:limit]))


def corpus(seed):
    draw = random.Random(seed)
    vocab = "a b C the of é New York 東京 x|y - ( q1 r2 s3".split()
    ways = [" ", "  ", "\t", " ", " ", ", ", ".\n", "; ", "!", " "]
    rows = []
    for i in range(60):
        text = "".join(draw.choice(vocab) + draw.choice(ways) for _ in range(draw.randrange(0, 90)))
        rows.append((draw.choice(["en", "en", "fr", None, "und"]), text))
    rows += [("en", "to be or not to be that is the question of the day " * 3)] * 30 + [("en", None), (None, ""), ("fr", "a" * 500)]
    return rows


@pytest.mark.parametrize("every,bits,support", [(3, 1 << 26, 5), (1, 64, 2), (16, 1 << 12, 9), (1000, 1 << 20, 30)])
def test_like_brute_force(spark, every, bits, support):
    rows = corpus(every)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = phrases.mine(df, support=support, limit=40, every=every, bits=bits).collect()
    assert sorted(map(tuple, got)) == brute(rows, support, 40)
    assert got


def test_each_occurrence_counts_once():
    """Starts that a chunk owns are those of the text, whatever the triggers."""
    draw = random.Random(2)
    text = " ".join(draw.choice("abcd") for _ in range(400)) + "." + " ".join("xyz" * 20)
    for every in (1, 2, 5, 10_000):
        got = Counter()
        owner, chunks, ends = phrases.parse([b"", text.encode(), b". ,"], every)
        assert set(owner) == {1}
        for chunk, last in zip(chunks, ends):
            w = chunk.split()
            for i in range(len(w) - (0 if last else phrases.OVERLAP)):
                got.update(tuple(w[i:i + k]) for k in range(1, 6) if i + k <= len(w))
        want = Counter(tuple(x.encode() for x in w[i:i + k]) for w in pieces(text) for k in range(1, 6)
                       for i in range(len(w) - k + 1))
        assert got == want
    assert phrases.parse([b"", b". ,"]) == ([], [], [])


def test_equal_stretches_parse_alike():
    draw = random.Random(7)
    middle = [f"m{draw.randrange(500)}" for _ in range(300)]
    one, two = ([f"{k}{i}" for i in range(40)] + middle for k in "pq")
    a, b = (set(phrases.parse([" ".join(x).encode()])[1]) for x in (one, two))
    assert len(a & b) > 10 and len(a - b) < 6


def test_products_past_64_bits(spark):
    """Counts of web size: 1000 * a * n has more than 64 bits."""
    big = 9 * 10**13
    f = spark.createDataFrame([("en", 1, "x", big), ("en", 1, "y", big), ("en", 2, "x y", 8 * 10**13)],
                              "lang string, k int, phrase string, f long")
    n = spark.createDataFrame([("en", 10**15)], "lang string, n long")
    r = phrases.score_phrases(f, n).first()
    assert r["score"] == 1000 * 8 * 10**13 * 10**15 // (big * big)


def test_awkward_rows(spark):
    assert phrases.mine(empty(spark)).count() == 0
    got = phrases.mine(frame(spark), support=2).collect()
    rows = [(r["lang"], r["text"]) for r in frame(spark).collect()]
    assert sorted(map(tuple, got)) == brute(rows, 2, 2000)
    with pytest.raises(ValueError):
        phrases.frequent(empty(spark), longest=6)


def test_filter_has_every_bucket(spark):
    bucket = np.random.default_rng(1).integers(0, 2**32, 5000)
    bits = phrases.filter_of(spark.createDataFrame([(int(x),) for x in bucket], "bucket long"), 1 << 14)
    assert phrases._passes(bits, bucket.astype(np.uint64) << np.uint64(32)).all()
    assert np.unpackbits(bits.view(np.uint8)).sum() == len(set((bucket & (1 << 14) - 1).tolist()))
