"""The pipeline's stages, each on its own input, against brute force."""

import re
from collections import Counter

import corpus_pipeline as P
from cloakline.llm import queries as Q
from cloakline.llm import toxicity

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_stages(spark):
    assert [n for n, _ in P.STAGES] == ["toxicity", "lines", "minhash", "decontam", "mixing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols = docs.columns
    seen = {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns == cols
        seen[name] = ([r.asDict() for r in docs.collect()], [r.asDict() for r in out.collect()])
        path = P.scratch(out, "test-stage")
        docs = path
    before, after = seen["toxicity"]
    model = toxicity.train(spark.createDataFrame(before), spark.read.parquet(f"{SF}/labels.parquet"))
    get = toxicity.scorer(model)
    assert {r["doc_id"] for r in after} == {
        r["doc_id"] for r in before if toxicity.score((r["text"] or "").encode(), model, get) < 0.3}

    before, after = seen["lines"]
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    n = Counter(k for r in before for k in {key(x) for x in r["text"].split("\n")})
    want = {r["doc_id"]: "\n".join(x for x in r["text"].split("\n") if not key(x) or n[key(x)] < 10) for r in before}
    assert {r["doc_id"]: r["text"] for r in after} == want

    before, after = seen["minhash"]
    low = lambda t: [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in words(t)]
    sets = {r["doc_id"]: {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if (w := low(r["text"])) else set() for r in before}
    up = {i: i for i in sets}
    find = lambda i: i if up[i] == i else find(up[i])
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    assert {r["doc_id"] for r in after} == {i for i in ids if find(i) == i}

    before, after = seen["decontam"]
    alnum = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ".join(low(t)))
    grams = {tuple(w[i:i + 10]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()
             for w in [alnum(r["text"])] for i in range(max(1, len(w) - 9)) if w}
    sizes = {len(g) for g in grams}
    clean = {r["doc_id"] for r in before if not any(
        tuple(w[i:i + k]) in grams for w in [alnum(r["text"])] for k in sizes for i in range(len(w) - k + 1))}
    assert {r["doc_id"] for r in after} == clean

    before, after = seen["mixing"]
    had, got, most = Counter(), Counter(), Counter(r["doc_id"] for r in after)
    for r in before:
        had[r["source"]] += len(words(r["text"]))
    for r in after:
        got[r["source"]] += len(words(r["text"]))
    total, free, capped = sum(had.values()), {s: 1 + i % 3 for i, s in enumerate(sorted(had))}, {}
    while True:
        level = (total - sum(capped.values())) / max(1, sum(free.values()))
        over = [s for s in free if level * free[s] > 3 * had[s]]
        if not over:
            break
        for s in over:
            capped[s] = 3 * had[s]
            del free[s]
    assert all(abs(got[s] - (capped[s] if s in capped else level * free[s])) <= 60 for s in had)
    assert max(most.values()) <= 3


def test_held_out_language_and_toxicity(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    lang = Q.op2_language(spark, sf).join(docs, "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in lang) / len(lang) > 0.97
    tox = Q.op10_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    wrong = sum(r["predicted"] != r["toxic"] for r in tox)
    assert len(tox) > 50 and wrong / len(tox) < 0.1
