"""Records of unknown shape, kept metrics, callers that share a pace."""

import json
import os
import threading
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cloakline.operators import lookup as L
from cloakline.operators import paced as P
from cloakline.operators import variant as V
from cloakline.operators.table import pseudonymize
from cloakline.plans import registered as R
from cloakline.plans.registered import PrefixLookup
from cloakline.streaming import metrics as M
from cloakline.streaming import stream

PATHS = ["id", "user.vin", "items[].sku", "deep.a[].b[].c"]
TEXTS = [
    '{"id":"x1","user":{"vin":"v1","age":7},"items":[{"sku":"s1","n":1},{"n":2},{"sku":null}],"other":[1,{"id":"kept"}]}',
    '{"id":42,"user":"Bob","items":{"sku":"no list"},"flag":true}',
    '{"id":{"first":"A","last":"B"},"user":{"vin":[1,2]},"items":["loose",{"sku":2.5}]}',
    '{"id":null,"user":null,"items":[],"deep":{"a":[{"b":[{"c":"c1"},{"c":"c2","d":"é \\" \\\\ \\n"}]}]}}',
    '{"id":"","user":{"vin":"  "}}', "{}", '{"id":false}',
]
BROKEN = ["{", "[1]", "7", '"text"', "null", "", None]


def records(spark, texts=TEXTS):
    df = spark.createDataFrame(list(enumerate(texts)), "n long, value string")
    return V.parse_records(df)


def as_json(df):
    return [json.loads(r["j"]) for r in df.where("record IS NOT NULL").select("n", F.to_json("record").alias("j")).orderBy("n").collect()]


def test_unknown_fields_survive_and_identifiers_go(spark, kr):
    for deterministic in (True, False):
        sealed = V.pseudonymize_records(records(spark), "record", PATHS, kr, deterministic=deterministic)
        got = as_json(sealed)
        assert got[0]["other"] == [1, {"id": "kept"}] and got[0]["user"]["age"] == 7 and got[0]["items"][1] == {"n": 2}
        assert got[0]["items"][2] == {"sku": None} and len(got[0]["items"][0]["sku"]) == 40
        # Another shape than the path expects: sealed whole.
        assert got[1]["user"].endswith("=") or len(got[1]["user"]) == 44 and "Bob" not in got[1]["user"]
        assert got[1]["items"][0] == V.TYPED and got[2]["id"][0] == V.TYPED and got[2]["items"][0][0] != V.TYPED
        assert got[1]["flag"] is True and got[1]["id"][0] == V.TYPED
        assert got[3]["id"] is None and got[3]["user"] is None and got[3]["deep"]["a"][0]["b"][1]["d"] == 'é " \\ \n'
        assert got[4] == {"id": "", "user": {"vin": ""}} and got[5] == {}
        back = as_json(V.reidentify_records(sealed, "record", PATHS, kr))
        want = [json.loads(t) for t in TEXTS]
        want[4]["user"]["vin"] = ""
        assert back == want


def test_strings_link_with_plain_columns(spark, kr):
    one = as_json(V.pseudonymize_records(records(spark), "record", "user.vin", kr))[0]["user"]["vin"]
    assert pseudonymize(spark.createDataFrame([("v1",)], "v string"), "v", kr).first()["v"] == one


def test_rejects_of_records(spark):
    got = {r["n"]: r for r in records(spark, BROKEN + TEXTS[:1]).collect()}
    assert [got[i]["_corrupt_record"] for i in range(len(BROKEN))] == BROKEN
    assert all(got[i]["record"] is None for i in range(len(BROKEN)))
    assert got[len(BROKEN)]["_corrupt_record"] is None and got[len(BROKEN)]["record"] is not None


def test_records_plan_and_damage(spark, kr):
    df = V.pseudonymize_records(records(spark), "record", PATHS, kr)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in p and "Python" not in p and kr.enc_key.hex() not in p.lower()
    plain = records(spark, ['{"id":"AAAA"}'])
    with pytest.raises(PySparkException):
        V.reidentify_records(plain, "record", "id", kr).collect()
    assert as_json(V.reidentify_records(plain, "record", "id", kr, on_error="null")) == [{"id": None}]
    with pytest.raises(ValueError, match="no VARIANT"):
        V.pseudonymize_records(spark.range(1), "id", "a", kr)


def test_a_record_is_parsed_and_cast_once(spark, kr):
    """A filter on the record doesn't parse again, and no level is cast twice."""
    def steps(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    df = spark.createDataFrame([(0, "{}")], "n long, value string").repartition(2)
    parsed = V.parse_records(df).where("record IS NOT NULL AND n = 0")
    assert steps(parsed).count("parseJson") == 1 and "(n#" in steps(parsed).split("explode")[1]
    sealed = steps(V.pseudonymize_records(parsed, "record", ["id", "user.vin", "items[].sku"], kr))
    assert sealed.count("as map<string,variant>") == 3 and sealed.count("as array<variant>") == 1  # the record, user, an item; items


def test_what_stands_before_a_record(spark):
    texts = [' {"a":1}', '\n\t\r {"a":2} and more', '\u00a0{"a":1}', ' [{"a":1}]', ' "{"', "  ", '{"a":1']
    got = {r["n"]: r for r in records(spark, texts).collect()}
    assert [r["_corrupt_record"] for _, r in sorted(got.items())] == [None, None, *texts[2:]]
    assert as_json(records(spark, texts)) == [{"a": 1}, {"a": 2}]


def test_records_are_dealt_to_all_cores(spark):
    """One file of one row group: the records aren't all sealed in its one task."""
    sizes = R._open_records(spark, "/root/testdata/sf0.001").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > spark.sparkContext.defaultParallelism


def test_metrics_are_kept(spark, tmp_path):
    for i in range(3):
        spark.range(i * 10, i * 10 + 10, 1, 1).selectExpr("id", "nullif('v' || id, 'v3') AS v").write.mode("append").parquet(str(tmp_path / "in"))
    path = str(tmp_path / "m")

    def run(name):
        sdf = spark.readStream.schema("id long, v string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        out = stream.observe_counts(sdf, "seen", ["v"])
        q = stream.start_file_sink(out, str(tmp_path / f"o{name}"), str(tmp_path / f"c{name}"), available_now=True, query_name=name)
        q.awaitTermination()
        return q

    with M.kept_metrics(spark, path) as listener:
        q = run("first")
        assert listener.wait(q)
        run("second")
    run("unheard")
    got = M.read_metrics(spark, path).collect()
    assert {r["name"] for r in got} == {"first", "second"}
    rows = [(r["batch_id"], r["value"]) for r in got if r["name"] == "first" and r["metric"] == "seen.rows" and r["value"]]
    assert sorted(rows) == [(0, 10.0), (1, 10.0), (2, 10.0)]
    assert sum(r["value"] for r in got if r["metric"] == "seen.v_nulls") == 2
    assert any(r["metric"] == "triggerExecution_ms" and r["value"] > 0 for r in got)


class Limited:
    """Lets ``limit`` calls of a round pass; ``tick`` begins the next one."""

    def __init__(self, limit):
        self.limit, self.now, self.passed, self.refused, self.lock = limit, 0, 0, 0, threading.Lock()

    def tick(self):
        self.now = 0

    def __call__(self, values):
        with self.lock:
            self.now += 1
            if self.now > self.limit:
                self.refused += 1
                raise L.RetryableError("throttled")
            self.passed += 1
        return ["p" + v for v in values]


def together(service, values, callers, pace, policy):
    """The callers as threads, with a barrier in place of the stage's."""
    told, lock, out, errors = {}, threading.Lock(), {}, []
    barrier = threading.Barrier(callers, action=service.tick)

    def caller(me):
        def gather(text):
            told[me] = text
            barrier.wait(20)
            all_of_them = [told[i] for i in range(callers)]
            barrier.wait(20)
            return all_of_them

        try:
            for batch, answers in P.paced_answers(iter(values[me::callers]), service, policy, pace, me, callers, gather,
                                                  sleep=lambda s: None):
                with lock:
                    out.update(zip(batch, answers))
        except Exception as exc:  # noqa: BLE001
            errors.append(exc)
            barrier.abort()

    threads = [threading.Thread(target=caller, args=(i,)) for i in range(callers)]
    [t.start() for t in threads]
    [t.join(60) for t in threads]
    return out, errors


@pytest.mark.parametrize("limit,callers,window", [(10, 4, 1), (10, 4, 100), (1, 3, 8), (50, 2, 4), (7, 5, 7)])
def test_one_pace_for_all_callers(limit, callers, window):
    service = Limited(limit)
    values = [f"v{i}" for i in range(2000)]
    out, errors = together(service, values, callers, P.Pace(window=window, step=1, seconds=0), L.LookupPolicy(batch_size=5))
    assert not errors and out == {v: "p" + v for v in values}
    # The first windows may be far too large; later each swing refuses a call or two and lets limit / 2 rounds pass.
    start = sum(max(0, (window >> k) - limit) for k in range(12))
    swings = service.passed / max(1, limit * limit // 3) + 1
    assert service.refused <= start + 3 * swings + service.passed * (limit < 3)


def test_pace_gives_up_and_splits(spark):
    out, errors = together(Limited(0), ["a", "b"], 2, P.Pace(patience=3, seconds=0), L.LookupPolicy())
    assert isinstance(errors[0], (L.LookupFailed, threading.BrokenBarrierError)) and not out

    class Small(Limited):
        def __call__(self, values):
            if len(values) > 3:
                raise L.TooLargeError("no")
            return super().__call__(values)

    out, errors = together(Small(5), [str(i) for i in range(40)], 2, P.Pace(seconds=0), L.LookupPolicy(batch_size=20))
    assert not errors and len(out) == 40


def test_paced_through_a_barrier_stage(spark):
    df = spark.createDataFrame([(v,) for v in ["a", "b", " ", None, "a"] + [f"w{i}" for i in range(50)]], "v string")
    got = P.paced_mapping(df, "v", PrefixLookup("p_"), 3, pace=P.Pace(seconds=0.01), policy=L.LookupPolicy(batch_size=4))
    rows = [(r["value"], r["mapped"]) for r in got.collect()]
    assert len(rows) == 52 and all(m == "p_" + v for v, m in rows)
    assert P.paced_mapping(df.limit(0), "v", PrefixLookup("p_"), 2, pace=P.Pace(seconds=0)).count() == 0


def test_rounds_do_not_wait_for_a_slow_barrier():
    told = []

    def gather(text):
        told.append(text)
        time.sleep(0.5)
        return [text]

    got = list(P.paced_answers(iter([str(i) for i in range(200)]), PrefixLookup("p_"), L.LookupPolicy(batch_size=1),
                               P.Pace(window=4, step=1, seconds=0.02), 0, 1, gather))
    assert sorted(x for b, _ in got for x in b) == sorted(str(i) for i in range(200))
    assert len(told) <= 6  # 16 with a round for each


class Counted(Limited):
    """Counts the rounds: the barrier ticks twice in each."""

    ticks = 0

    def tick(self):
        self.ticks += 1
        super().tick()


def test_the_window_stays_at_what_the_service_answers():
    service = Counted(24)
    values = [f"v{i}" for i in range(2400)]
    out, errors = together(service, values, 4, P.Pace(window=8, step=4, seconds=0), L.LookupPolicy(batch_size=1))
    assert not errors and len(out) == 2400
    assert service.ticks / 2 <= 110  # 100 rounds if each were full
    assert service.refused <= 2400 * 0.1


def test_the_last_caller_gets_the_whole_window():
    class Uneven(list):  # all callers but the first have three values
        def __getitem__(self, part):
            return list(self)[part][:None if part.start == 0 else 3]

    service = Counted(24)
    out, errors = together(service, Uneven(f"v{i}" for i in range(2400)), 4, P.Pace(window=8, step=4, seconds=0),
                           L.LookupPolicy(batch_size=1))
    assert not errors and len(out) == 609
    assert service.ticks / 2 <= 35  # 26 rounds if each were full


def test_a_throttled_caller_sends_fewer_before_word_is_there():
    calls, first = [], []

    def gather(text):
        time.sleep(0.55)
        first.append(len(calls))
        return [text]

    def service(values):
        calls.append(values)
        if len(calls) in (3, 4):
            raise L.RetryableError("throttled")
        return values

    got = list(P.paced_answers(iter([str(i) for i in range(60)]), service, L.LookupPolicy(batch_size=1),
                               P.Pace(window=4, step=1, seconds=0.1), 0, 1, gather))
    assert sorted(x for b, _ in got for x in b) == sorted(str(i) for i in range(60))
    assert first[0] <= 4 + 2 * 6  # four in the first round, two in each after it


def test_a_call_does_not_list_all_calls_before(tmp_path, monkeypatch):
    service = R.LimitedLookup(str(tmp_path), 1000, 3600)
    listed = []
    monkeypatch.setattr(R.os, "listdir", lambda path, of=os.listdir: listed.append(os.path.basename(path)) or of(path))
    for i in range(5):
        service([str(i)])
    assert "answered" not in listed and service.count("answered") == 5


def test_shares_add_up():
    for window in range(1, 12):
        for callers in range(1, 6):
            for turn in range(7):
                assert sum(P.share_of(window, callers, i, turn) for i in range(callers)) == window
