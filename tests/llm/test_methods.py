"""The methods against brute force."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cloakline.llm import decontam, embeddings, langid, lines, lpf, minhash, mixing, secrets, sentences, toxicity
from cloakline.llm.common import alnum_words, components
from cloakline.plans.inspect import plan_text

SCANNER = secrets.Scanner()
BITS = ["token", "secret", "password", "Api_Key", "apikey", "=", ":", " ", "\"", "'", "AKIA", "A1B2C3D4", "0a1b2c3d4e5f",
        "deadbeef", "é", "\n", ",", ".", "ghp_", "eyJ", "xoxb-", "abc", "-----BEGIN ", "PRIVATE KEY-----", "Z" * 20]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(BITS), max_size=14).map("".join), max_size=4))
def test_secrets_like_regexes(texts):
    for text, got in zip(texts, SCANNER.scan([t.encode() for t in texts]), strict=True):
        want = []
        for order, r in enumerate(secrets.RULES):
            for m in re.finditer(r.pattern, text, (re.I if r.fold else 0) | re.A):
                if len(m[2] if m.re.groups > 1 else m[0]) >= r.least:
                    want.append((m.start(), order, m.end(), r.kind))
        assert [(s["kind"], s["start"], s["end"]) for s in got] == [(k, a, b) for a, _, b, k in sorted(want)]


def brute_removed(docs: list[bytes], least: int):
    seen, out = set(), []
    for d in docs:
        gone = set()
        for i in range(len(d) - least + 1):
            w = d[i:i + least]
            if w in seen:
                gone.update(range(i, i + least))
            seen.add(w)
        out.append(gone)
    return out


@pytest.mark.parametrize("hot", [4096, 2])
def test_lpf_like_brute_force(spark, hot):
    draw = random.Random(3)
    passage = "".join(draw.choice("abcd é") for _ in range(160))
    texts = []
    for i in range(40):
        own = "".join(draw.choice("abcdefgh \n") for _ in range(draw.randrange(0, 500)))
        a, b = sorted(draw.randrange(0, 161) for _ in range(2))
        texts.append(own[:50] + (passage if i % 3 else passage[a:b]) + own[50:] + ("z" * 250 if i % 10 == 0 else ""))
    texts += [texts[3], texts[4], "x" * 700, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["_k"]: r for r in lpf.removed(df, hot=hot).collect()}
    for i, (t, gone) in enumerate(zip(texts, brute_removed([t.encode() for t in texts], 100))):
        data = t.encode()
        kept = bytes(c for j, c in enumerate(data) if j not in gone)
        if not gone:
            assert i not in got
            continue
        assert (bytes(got[i]["kept"]), got[i]["n_removed"]) == (kept, len(gone))
        assert got[i]["n_spans"] == sum(j - 1 not in gone for j in gone)


def test_suffix_ranks_order_like_bytes():
    draw = np.random.default_rng(1)
    text = draw.integers(97, 100, 400).astype(np.uint8)
    for depth, r in lpf.rank_levels(text, 20):
        pieces = [text[i:i + depth].tobytes().ljust(depth, b"\0") for i in range(400)]
        order = {p: k for k, p in enumerate(sorted(set(pieces)))}
        assert [order[p] for p in pieces] == r.tolist()
    assert depth == 20


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 9)))
def test_previous_smaller(x):
    want = [max((j for j in range(i) if x[j] <= x[i]), default=-1) for i in range(len(x))]
    assert lpf.previous_smaller(np.array(x, np.int64)).tolist() == want


def test_previous_factors_like_brute_force():
    """Lengths, up to ``least``: exact from there on, in eights below."""
    draw = random.Random(8)
    for least in (20, 33, 100):
        unit = "".join(draw.choice("ab") for _ in range(150))
        text = "".join(unit[a:a + draw.randrange(1, 120)] for a in (draw.randrange(100) for _ in range(12)))
        data = np.frombuffer(text.encode(), np.uint8)
        starts = np.arange(len(text) - least + 1)
        got = lpf.previous_factors(data, starts, np.arange(len(starts)), least)

        def common(i, j):
            k = 0
            while k < least and text[i + k] == text[j + k]:
                k += 1
            return k if k == least else k // 8 * 8

        want = [max((common(i, j) for j in range(i)), default=0) for i in starts.tolist()]
        assert got.tolist() == want and max(want) >= min(least, 64) and min(want) < least


def test_lpf_tells_null_ids_apart(spark):
    """Texts without an id that agree in 32 bits of their hash are different documents all the same."""
    draw, seen, pair = random.Random(1), {}, None
    shared = "".join(draw.choice("abcdefgh ") for _ in range(300))
    texts = spark.range(400_000).select(F.concat(F.lit("text number "), "id").alias("t"), F.col("id"))
    twice = texts.groupBy(F.hash(F.concat("t", F.lit(" " + shared))).alias("h")).agg(F.collect_list("t").alias("t")).where(
        "size(t) > 1").orderBy("h").first()
    pair = [f"{t} {shared}" for t in twice["t"][:2]]
    rows = [(None, pair[0]), (None, pair[1] ), (None, pair[1] + "!" * 200), (7, pair[0] + "?"), (None, pair[0])]
    got = lpf.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    first = [r["text"] for r in got if r["doc_id"] == 7]
    assert first == [pair[0] + "?"] and len(got) == 5
    left = sorted(len(r["text"]) for r in got if r["doc_id"] is None)
    head = max(len(t) - len(shared) for t in pair)
    assert all(n < 2 * head + 200 for n in left)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 4), min_size=1, max_size=5), st.integers(0, 60))
def test_knapsack_is_nearest(counts, budget):
    sizes = [k for k, c in counts.items() for _ in range(c)]
    sums = {sum(x) for n in range(len(sizes) + 1) for x in itertools.combinations(sizes, n)} if len(sizes) <= 12 else None
    got = mixing.knapsack(dict(counts), budget)
    assert all(0 < n <= counts[k] for k, n in got.items())
    if sums:
        assert abs(sum(k * n for k, n in got.items()) - budget) == min(abs(s - budget) for s in sums)
    fit = mixing.fit(dict(counts), budget)
    assert all(0 < n <= counts[k] for k, n in fit.items())


def test_fit_far_beyond_the_programme():
    draw = random.Random(5)
    counts = {draw.randrange(1, 30_000): draw.randrange(1, 50) for _ in range(3000)}
    total = sum(k * c for k, c in counts.items())
    for share in (0.01, 0.3, 0.77, 0.999):
        budget = int(total * share)
        assert abs(sum(k * n for k, n in mixing.fit(counts, budget).items()) - budget) <= 1


def test_targets_are_water_filled(spark):
    rows = [("a", 100), ("b", 1), ("c", 2), ("d", 400), (None, 30)]
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    weight = {"a": 1, "b": 2, "c": 3, "d": 1, None: 2}
    size, total = dict(rows), 533
    capped = set()
    while True:
        level = (total - sum(3 * size[s] for s in capped)) / sum(weight[s] for s in size if s not in capped)
        over = {s for s in size if s not in capped and level * weight[s] > 3 * size[s]}
        if not over:
            break
        capped |= over
    assert got == pytest.approx({s: 3 * size[s] if s in capped else level * weight[s] for s in size})


def test_mix_of_a_hot_size(spark):
    df = spark.range(20_000).selectExpr("id doc_id", "'one two three' text", "if(id % 2 = 0, 'a', 'b') source")
    got = mixing.plan(df).groupBy("source").sum("copies").collect()
    assert {r[0]: r[1] for r in got} == {"a": 20_000 / 3 // 1 + (20_000 / 3 % 1 > .5), "b": 13333}


def near(spark, texts, **more):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["_k"]: r["component_id"] for r in minhash.near_duplicates(df, **more).collect()}


def test_minhash_like_brute_force(spark):
    draw = random.Random(7)
    texts = []
    for _ in range(12):
        base = [f"w{draw.randrange(5000)}" for _ in range(120)]
        for k in range(12):
            copy = list(base)
            for _ in range(draw.randrange(0, 6)):
                copy[draw.randrange(120)] = f"x{draw.randrange(5000)}"
            texts.append(" ".join(copy))
    sets = [set(zip(*(t.split()[i:] for i in range(4)))) for t in texts]
    low = list(range(len(texts)))
    for _ in range(len(texts)):
        for a, b in itertools.combinations(range(len(texts)), 2):
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
        if all(low[low[i]] == low[i] for i in low):
            pass
    got = near(spark, texts, width=4)
    assert [got[i] for i in range(len(texts))] == low


def test_components_of_a_path_and_a_star(spark):
    n = 300
    path = [(i, i + 1) for i in range(n)]
    random.Random(2).shuffle(path)
    star = [(5000, 5001 + i) for i in range(500)]
    got = dict(components(spark.createDataFrame(path + star, "src long, dst long")).collect())
    assert {got[i] for i in range(n + 1)} == {0} and {got[5001 + i] for i in range(500)} == {5000}


def test_line_runs_levels_and_fresh(spark):
    runs = lines.LineRuns(fanout=2)
    batch = lambda *rows: spark.createDataFrame([(k, 0, bytes(x, "utf8")) for k, x in rows], "_k long, _h long, key binary")
    runs.add(batch((1, "a"), (1, "a"), (2, "a"), (2, "b")))
    assert {bytes(r["key"]) for r in runs.fresh(batch((3, "a"), (3, "c"))).collect()} == {b"c"}
    runs.add(batch((3, "a"), (3, "c")))
    assert [len(x) for x in runs.levels] == [0, 1]
    runs.add(batch((4, "a")))
    assert [len(x) for x in runs.levels] == [1, 1]
    assert {bytes(r["key"]): r["n"] for r in runs.merged().collect()} == {b"a": 4, b"b": 1, b"c": 1}
    held = [bytes(r["key"]) for run in runs.runs() for r in run.collect()]
    assert sorted(held) == [b"a", b"b", b"c"]  # every line is new once


def test_common_lines_go_through_the_anti_join(spark, monkeypatch):
    seen = []
    real = lines.LineRuns.fresh
    monkeypatch.setattr(lines.LineRuns, "fresh", lambda self, batch: (out := real(self, batch), seen.append(out))[0])
    rows = [(i, "\n".join([f"line {i % 7}", f"LINE {i % 3} ", f"own {i}", ""])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["_k"]: {bytes(k) for k in r["keys"]} for r in lines.common_lines(df, 10, batches=5).collect()}
    keys = {i: set(lines.line_keys(t.encode())) - {b""} for i, t in rows}
    count = Counter(k for x in keys.values() for k in x)
    assert got == {i: {k for k in x if count[k] >= 10} for i, x in keys.items() if any(count[k] >= 10 for k in x)}
    assert len(seen) == 4 and all("LeftAnti" in x._jdf.queryExecution().executedPlan().toString() for x in seen)


def brute_language(docs, texts, made):
    """Trigram by trigram in plain Python: prototypes of ``docs`` (text, lang), best cosine of each text."""
    def vector(text):
        symbols = [c.lower()[0] if c.lower()[0].isalpha() else " " for c in f" {text} "]
        symbols = [c for i, c in enumerate(symbols) if not (i and c == " " == symbols[i - 1])]
        out = np.zeros(made.d)
        for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
            out += np.roll(made.letter(ord(a)), 2).astype(int) * np.roll(made.letter(ord(b)), 1) * made.letter(ord(c))
        return out

    base = {}
    for text, lang in docs:
        base[lang] = base.get(lang, 0) + vector(text)
    out = []
    for text in texts:
        v = vector(text)
        if not any(c.isalpha() for c in text):
            out.append(("und", 0.0))
            continue
        cos = {x: float(v @ p / np.linalg.norm(v) / np.linalg.norm(p)) for x, p in sorted(base.items())}
        best = max(cos, key=lambda x: (cos[x], [-ord(c) for c in x]))
        out.append((best, min(1.0, max(0.0, cos[best]))))
    return out


def test_language_like_brute_force(spark):
    draw = random.Random(6)
    known = [("The cat sat on the mat, and the dog!", "en"), ("Der Hund und die Katze", "de"), ("le chat et le chien où", "fr"),
             ("el gato y el perro", "es"), ("el gato y el perro", "ca"), ("", "en"), ("123 --", "fr")]  # es and ca are a tie
    texts = ["".join(draw.choice("abc deé ßñ.,\n0 theundle") for _ in range(draw.randrange(0, 80))) for _ in range(60)]
    texts += ["", "  ", "7", "x", "the dog", "el perro", "İ ŉ ǰ"]
    df = spark.createDataFrame(known, "text string, lang string").repartition(3)
    base = langid.train(df, dimensions=64)
    got = langid.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), base, "p",
                         dimensions=64).orderBy("doc_id").collect()
    want = brute_language(known, texts, langid.Profiles(64))
    for r, (lang, score) in zip(got, want, strict=True):
        assert abs(r["p"]["score"] - score) < 1e-5, r
        if score > 1e-9:
            assert r["p"]["lang_pred"] == lang, r
    assert dict(zip(texts, got))["el perro"]["p"]["lang_pred"] == "ca"  # ties: the first name


def test_language_pieces_are_seamless():
    draw = random.Random(2)
    made = langid.Profiles(64)
    text = "".join(draw.choice("ab c.  é\n") for _ in range(700)) + " " * 50 + "end"
    whole, owner = made.grams([f" {text} "])
    for size in (1, 2, 3, 7, 64, 699, 5000):
        parts = list(langid.pieces(text, size))
        got, _ = made.grams(parts)
        assert sorted(got.tolist()) == sorted(whole.tolist()), size


def test_language_of_a_text_of_many_pieces(monkeypatch):
    text = ("The quick brown fox. " * 120_000)[:2_500_000]
    cut = langid.Profiles(32)
    got = sum(cut.bundle(part, [0] * len(part), 1) for _, part, _ in langid.groups([text]))
    monkeypatch.setattr(langid, "CHARS", 10_000_000)
    assert np.array_equal(got, sum(cut.bundle(part, [0] * len(part), 1) for _, part, _ in langid.groups([text])))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=9), max_size=4), st.lists(st.sampled_from("abcd"), max_size=30))
def test_automaton_like_brute_force(items, doc):
    items = [(str(i), [w.encode() for w in x]) for i, x in enumerate(items)]
    words = [w.encode() for w in doc]
    hit, found = set(), set()
    for name, x in items:
        k = min(len(x), 4)
        wins = {tuple(x[i:i + k]) for i in range(len(x) - k + 1)} if k else set()
        for i in range(len(words) - k + 1):
            if tuple(words[i:i + k]) in wins:
                hit.update(range(i, i + k))
                found.add(name)
    auto = decontam.Automaton(items, 4)
    for form in (auto, decontam.Packed.load(decontam.Packed(auto).dump())):
        spans, got = form.scan(words)
        assert got == found and {j for a, b in spans for j in range(a, b)} == hit
        assert all(x[1] < y[0] for x, y in zip(spans, spans[1:])) or hit


@pytest.mark.parametrize("block_words,lot", [(7, 50), (40, 1 << 24), (10**6, 1 << 24)])
def test_decontamination_by_blocks_like_brute_force(spark, monkeypatch, block_words, lot):
    """Many small blocks, items longer than a block, lots of few texts: the result of one automaton."""
    monkeypatch.setattr(decontam, "LOT", lot)
    draw = random.Random(4)
    say = lambda n: [draw.choice("abcde") + draw.choice("xyz") for _ in range(n)]
    items = [(f"i{k}", say(draw.choice([0, 2, 6, 30, 90]))) for k in range(12)]
    docs = []
    for k in range(40):
        words = say(draw.randrange(0, 40))
        own = draw.choice(items)[1]
        a = draw.randrange(0, len(own) + 1)
        docs.append((k, words + own[a:a + draw.randrange(1, 40)] + say(5)))
    got = decontam.mark_contaminated(
        spark.createDataFrame([(k, " ".join(w)) for k, w in docs], "doc_id long, text string").repartition(3),
        spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id string, text string"), 6, block_words)
    for r in got.collect():
        words, hit, found = docs[r["row"]["doc_id"]][1], set(), set()
        for name, x in items:
            n = min(len(x), 6)
            wins = {tuple(x[i:i + n]) for i in range(len(x) - n + 1)} if n else set()
            for i in range(len(words) - n + 1):
                if tuple(words[i:i + n]) in wins:
                    hit.update(range(i, i + n))
                    found.add(name)
        assert (r["n_words"], r["n_hit"], r["items"]) == (len(words), len(hit), sorted(found))


def test_packed_automaton_is_small():
    draw = random.Random(1)
    words = [f"w{draw.randrange(5000)}".encode() for _ in range(100_000)]
    size = len(decontam.Packed(decontam.Automaton([("a", words)], 10)).dump())
    assert size < 110 * len(words)


def test_words_of_the_contract():
    for text in ("Don't STOP é-é 3.14_x y", "", "ÄÖ\x7fb\x00c"):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        assert alnum_words(text.encode()) == [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]


def test_collisions_like_brute_force():
    draw = np.random.default_rng(2)
    q, p = draw.normal(size=(70, 8)), draw.normal(size=(130, 8))
    want = (np.abs(q[:, None] - p[None]) <= 0.5).sum(2) >= 4
    a, b = embeddings.counted(q, p, 0.5, 4)
    got = np.zeros_like(want)
    got[a, b] = True
    assert (got == want).all()


def test_embeddings_like_brute_force(spark):
    draw = np.random.default_rng(4)
    base = draw.normal(size=(60, 24))
    x = np.concatenate([base, base[:30] + draw.normal(size=(30, 24)) * 0.3, base[:10]])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in embeddings.near_vectors(df).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    on = (u @ u.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    assert [got[i]["n_links"] for i in range(len(x))] == on.sum(1).tolist() and on.sum() > 20


def test_calibrated_recall():
    w, half, count = embeddings.calibrate(64, 0.95)
    draw = np.random.default_rng(9)
    x = draw.normal(size=(20_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = draw.normal(size=x.shape)
    y -= (x * y).sum(1, keepdims=True) * x
    y = 0.95 * x + math.sqrt(1 - 0.95**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    assert ((np.abs((x - y) @ w) <= half).sum(1) >= count).mean() > 0.999


def segments(scores):
    """All maximal scoring segments by their definition: split at the best segment, left and right."""
    if not scores or max(scores) <= 0:
        return []
    best = max(((sum(scores[a:b]), -(b - a), -a, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)))
    a, b = best[3:]
    return segments(scores[:a]) + [(a, b)] + [(x + b, y + b) for x, y in segments(scores[b:])]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcde"), max_size=18))
def test_ruzzo_tompa_like_brute_force(words):
    model = toxicity.Model({b"a": 2.0, b"b": 1.03, b"c": 0.51}, -0.7)
    found, n = toxicity.passages(" ".join(words).encode(), model, toxicity.scorer(model))
    assert n == len(words)
    assert [(a, b) for a, b, _ in found] == segments([model.scores.get(w.encode(), -0.7) for w in words])


def test_spans_like_brute_force():
    text = b"One two three four five. Six seven eight nine ten! Eleven twelve thirteen. A b c d e f g h i j k l."
    parts = sentences.sentences(text)
    assert b"".join(text[a:b] for a, b, _ in parts) == text and len(parts) == 4
    got = [(a, b) for a, b, _ in sentences.spans(parts, 2, 9)]
    want = []
    for i in range(len(parts)):
        for j in range(i + 2, len(parts) + 1):
            if sum(len(p[2]) for p in parts[i:j]) >= 9:
                want.append((i, j))
                break
    assert got == want


def test_repeated_passage_is_cut_once(spark):
    draw = random.Random(1)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(6))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    passage = " ".join(sentence(9) for _ in range(7))
    soup = " ".join(word() for _ in range(200))
    docs = [(i, f"{sentence(12)} {sentence(8)} {passage} {sentence(11)}") for i in range(5)]
    docs += [(i, f"{word()} {soup} {word()}") for i in range(5, 8)]
    out = {r["row"]["doc_id"]: r for r in sentences.drop_repeats(
        spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert passage in out[0]["text"] and out[0]["n_removed"] == 0 and out[5]["n_removed"] == 0
    for i in range(1, 5):
        assert passage not in out[i]["text"] and out[i]["n_removed"] >= 6
        assert out[i]["text"].split()[:12] == docs[i][1].split()[:12]
    assert all(len(out[i]["text"].split()) < 80 for i in (6, 7))


def test_passage_inside_sentences_is_cut(spark):
    """Passages of exactly 51 words, put between random words of other texts."""
    draw = random.Random(2)
    some = lambda n: [f"w{draw.randrange(3000)}" + ("." if draw.random() < 0.08 else "") for _ in range(n)]
    docs, held, at = [], {}, {}
    for i in range(120):
        passage = [f"p{draw.randrange(3000)}" for _ in range(51)]
        for k in (2 * i, 2 * i + 1):
            around, j = some(80), draw.randrange(1, 80)
            docs.append((k, " ".join(around[:j] + passage + around[j:])))
            held[k], at[k] = set(passage), around
    out = {r["doc_id"]: r["text"].split() for r in sentences.dedup(
        spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    lost = []
    for k, text in docs:
        left = sum(w in held[k] for w in out[k])
        assert [w for w in out[k] if w not in held[k]] == at[k]  # nothing else goes
        if k % 2:
            lost.append(51 - left)
        else:
            assert left == 51
    assert min(lost) >= 26 and sum(lost) >= 0.85 * 51 * len(lost)


def _phrases_of(spark, n, seed=5):
    """``n`` different texts, the same two-word phrase in every other one; (documents, labels)."""
    draw = random.Random(seed)
    vocab = [f"word{i}" for i in range(60)]
    rows = []
    for i in range(n):
        text = [draw.choice(vocab) for _ in range(39)]
        at = draw.randrange(38)
        rows.append((i, " ".join(text[:at] + (["vile", "scum"] if i % 2 else ["mild", "soup"]) + text[at:])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame([(i, i % 2) for i in range(n)], "doc_id long, toxic int")


def test_toxicity_learns_a_fixed_phrase(spark):
    """A word that always follows the same word counts in every text that holds it."""
    docs, labels = _phrases_of(spark, 600)
    model = toxicity.train(docs, labels)
    assert {b"vile", b"scum"} <= set(model.scores) and b"soup" not in model.scores
    got = {r["doc_id"]: r["p"] for r in toxicity.with_score(docs, model, "p").collect()}
    assert min(got[i] for i in range(1, 600, 2)) > 0.9 and max(got[i] for i in range(0, 600, 2)) < 0.1


def test_toxicity_copies_do_not_teach(spark):
    docs, labels = _phrases_of(spark, 200)
    copies = spark.createDataFrame([(1000 + i, "one copied text with a rare wordling inside") for i in range(300)], docs.schema)
    marks = labels.unionAll(spark.createDataFrame([(1000 + i, 1) for i in range(300)], labels.schema))
    model = toxicity.train(docs.unionAll(copies).unionAll(docs), marks)
    assert b"wordling" not in model.scores and b"vile" in model.scores


def test_toxicity_never_sees_labels_of_other_documents(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 2 and i < 36)) for i in range(40)], "doc_id long, toxic int")
    model = toxicity.train(docs.where("doc_id % 4 <> 2"), labels)
    assert {r["p"] for r in toxicity.with_score(docs, model, "p").collect()} == {0.0}
    assert model.share == 0.0


def test_toxicity_location_where_clean_texts_score_alike(spark):
    model = toxicity.train(*_phrases_of(spark, 600, seed=9))
    # Clean texts of 41 words hold no scoring token: their largest segment is 0, the location -ln(41).
    assert model.location == pytest.approx(-math.log(41), abs=1e-6) and model.scale == toxicity.LEAST_SCALE


def test_toxicity_sample_is_bounded(spark):
    docs, labels = _phrases_of(spark, 600)
    small = toxicity.train(docs, labels, sample=200)
    assert small.share == 0.5 and b"vile" in small.scores
    whole = toxicity.train(docs, labels, sample=600)
    assert len(whole.scores) >= len(small.scores)


def test_mixing_of_many_equal_rows_and_rows_without_ids(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANKED", 16)
    rows = ([(None, "one two three", "a")] * 200 + [(None, f"w{i} x y", "a") for i in range(150)]
            + [(i, "p q", "b") for i in range(80)] + [(7, "r s t u", "b")] * 40 + [(None, None, None)] * 3)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    planned = mixing.plan(df).collect()
    assert len(planned) == len(rows) and all(0 <= r["copies"] <= 3 for r in planned)
    for s in ("a", "b"):
        own = [r for r in planned if r["source"] == s]
        assert abs(sum(r["size"] * r["copies"] for r in own) - own[0]["target"]) <= 4
    made = mixing.mix(df).collect()
    assert len(made) == sum(r["copies"] for r in planned)
    assert Counter((r["doc_id"], r["source"]) for r in made) == Counter(
        {k: sum(r["copies"] for r in planned if (r["doc_id"], r["source"]) == k) for k in
         {(r["doc_id"], r["source"]) for r in planned if r["copies"]}})
    again = mixing.mix(df.repartition(3)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, made))
    # A null id doesn't send all rows of a size to one bucket.
    d = mixing._groups(df, 17).where("doc_id IS NULL AND source = 'a'")
    assert d.select(F.pmod(F.shiftright("_u", 20), F.lit(10))).distinct().count() == 10


def brute_spans(docs, least, words):
    """Sentence spans of ``docs`` in order, pieces covered by any but the first occurrence removed."""
    cutter, seen, out = sentences.Cutter(), set(), []
    for text in docs:
        data = text.encode()
        _, cut, at, _ = cutter.pieces(data)
        w, cut = [x.lower() for x in data.split()], cut.tolist()
        n, found = len(cut) - 1, set()
        for a in range(n):
            b = next((b for b in range(a + least, n + 1) if cut[b] - cut[a] >= words), None)
            if b:
                found.add((a, b))
        for b in range(1, n + 1):
            a = next((a for a in range(b - least, -1, -1) if cut[b] - cut[a] >= words), None)
            if a is not None and not any(y == b for _, y in found):
                found.add((a, b))
        gone = set()
        for a, b in sorted(found):
            key = tuple(w[cut[a]:cut[b]])
            if key in seen:
                gone.update(range(a, b))
            seen.add(key)
        out.append(b"".join(data[at[i]:at[i + 1]] for i in range(n) if i not in gone).decode() if n else text)
    return out


def test_sentence_spans_like_brute_force(spark):
    draw = random.Random(12)
    vocab = [f"w{i}" for i in range(40)]
    say = lambda n: " ".join(draw.choice(vocab) + draw.choice(["", "", "", ".", "\n"]) for _ in range(n))
    passages = [say(60) for _ in range(3)]
    texts = []
    for i in range(40):
        p = draw.choice(passages)
        texts.append(f"{say(draw.randrange(20))} {p if i % 2 else p[:draw.randrange(1, len(p))]} {say(draw.randrange(30))}")
    texts += [texts[0], "", "One.", passages[0].upper()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    for least, words in ((2, 10), (3, 25)):
        got = {r["doc_id"]: r["text"] for r in sentences.dedup(df, least, words).collect()}
        assert [got[i] for i in range(len(texts))] == brute_spans(texts, least, words)


def test_decontaminate_scans_texts_once(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, "quite clean")], "doc_id long, text string")
    bench = spark.createDataFrame([("x", "a b c d e f g h i j")], "item_id string, text string")
    out = decontam.decontaminate(docs, bench)
    assert plan_text(out, "simple").count("ArrowEvalPython") == 1
    assert [r["doc_id"] for r in out.collect()] == [2]
    cut = decontam.decontaminate(docs, bench, max_coverage=1.0)
    assert plan_text(cut, "simple").count("ArrowEvalPython") == 2  # the scan, and the cutting
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == {1: " k", 2: "quite clean"}


def test_a_shingler_remembers_a_bounded_number_of_words():
    one = minhash.Shingler(2)
    text = " ".join(f"w{i}" for i in range(minhash.KNOWN + 1000)).encode()
    first = one(text)
    assert len(one.known) <= minhash.KNOWN <= 200_000 and (one(text) == first).all()
