"""Periodic runs against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import LONG, TEXTS, empty, frame
from cloakline.llm import runs


def brute_lyndon(s):
    def word(x):
        return all(x < x[i:] for i in range(1, len(x)))
    return [max(k for k in range(1, len(s) - i + 1) if word(s[i:i + k])) for i in range(len(s))]


def brute_runs(s):
    n, out = len(s), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            size = j + q - i
            if size >= max(6, 4 * q) and not any(
                    s[i:i + size - d] == s[i + d:i + size] for d in range(1, q)):
                out.add((i, size, q))
            i = max(j, i + 1)
    return sorted(out)


seqs = st.lists(st.integers(0, 2), min_size=1, max_size=30)


@settings(max_examples=300, deadline=None)
@given(seqs)
def test_lyndon_array(s):
    assert runs.lyndon(s) == brute_lyndon(s)


@settings(max_examples=500, deadline=None)
@given(seqs, seqs, st.integers(1, 9), seqs)
def test_runs(a, b, k, c):
    s = a + b[:6] * k + c
    assert runs.runs_of(np.array(s)) == brute_runs(s)


def test_batches_of_texts(spark):
    """Through Spark, cut into stretches: the same runs, and words dropped as the contract says."""
    draw = random.Random(4)
    rows = []
    for i in range(120):
        words = [draw.choice("abc de fg hij k".split()) for _ in range(draw.randrange(0, 60))]
        unit = words[:draw.randrange(1, 7)]
        rows.append((i, " \t".join(words[:9] + unit * draw.randrange(1, 12) + words[9:])))
    got = runs.find_runs(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), out="found").collect()
    assert len(got) == len(rows)
    some = 0
    for r in got:
        words = r["text"].split()
        want = brute_runs(words)
        assert [tuple(x) for x in r["found"]["runs"]] == want
        gone = {i for s, k, q in want for i in range(s + q, s + k)}
        assert r["found"]["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in gone)
        some += bool(want)
    assert some > 50


def test_awkward_rows(spark):
    got = runs.find_runs(frame(spark), out="found").collect()
    assert len(got) == len(TEXTS)
    by = {r["doc_id"]: r for r in got}
    assert by[3]["found"] == by[4]["found"] == by[5]["found"] == ([], "")
    assert [tuple(x) for x in by[6]["found"]["runs"]] == [(0, 24000, 6)]
    assert by[6]["found"]["collapsed"] == "the long text of many words."
    assert by[1]["key"] == "x" and by[1]["row"] == "r"
    assert runs.find_runs(empty(spark)).count() == 0
    cut = {r["doc_id"]: r for r in runs.collapse(frame(spark)).collect()}
    assert cut[7]["text"] == "the long text of many words." and cut[3]["text"] is None and cut[5]["text"] == " \t\n \n"
    assert runs.collapse(frame(spark)).columns == frame(spark).columns
    with pytest.raises(ValueError):
        runs.runs_of(np.array([1, 1]), exponent=2)


def test_very_long_text(spark):
    words = [f"w{i % 7919 * 31 % 7919}" for i in range(300_000)]
    words[200_000:200_000 + 5000] = ["x", "y", "z", "y", "x"] * 1000
    got = runs.find_runs(spark.createDataFrame([(1, " ".join(words)), (2, LONG)], "doc_id long, text string"), out="found")
    by = {r["doc_id"]: [tuple(x) for x in r["found"]["runs"]] for r in got.collect()}
    assert (200_000, 5000, 5) in by[1] and all(q >= 5 and k >= 4 * q for _, k, q in by[1])
    # What lies before and after has period 7919, and is longer than four of them.
    assert sorted(q for _, _, q in by[1]) == [5, 7919, 7919]
