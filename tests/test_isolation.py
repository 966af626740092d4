"""Bad values of a lookup: found by halving, set aside, everything else answered."""

import math
import random
import urllib.error

import pytest
from pyspark import cloudpickle

import fakes
from cloakline.operators import lookup as L
from fakes import Service

cloudpickle.register_pickle_by_value(fakes)  # the workers can't import the tests


def ask(service, values, **policy):
    policy = L.LookupPolicy(bad_values="reject", backoff_base=0.0, **policy)
    good, bad = {}, {}
    for batch, answers, reasons in L.isolated_answers(values, service, policy):
        assert len(batch) == len(answers) == len(reasons) <= policy.batch_size
        for v, a, r in zip(batch, answers, reasons):
            (bad if r else good).__setitem__(v, r or a)
    return good, bad


@pytest.mark.parametrize("wrong", [None, "short", "text"])
def test_every_other_value_is_answered_within_the_bound(wrong):
    draw = random.Random(3)
    for _ in range(150):
        n, size = draw.randrange(0, 400), draw.randrange(1, 70)
        values = [f"v{i}" for i in range(n)]
        bad = set(draw.sample(values, min(n, draw.choice([0, 1, 2, 5, n]))))
        service = Service(bad, wrong=wrong)
        good, aside = ask(service, values, batch_size=size)
        assert set(aside) == bad and good == {v: "p" + v for v in values if v not in bad}
        assert service.calls <= math.ceil(n / size) + len(bad) * (math.ceil(math.log2(size)) + 2)
    assert all(aside.values())


def test_null_answers_name_their_values():
    service = Service({"v3", "v7"}, wrong="null")
    good, bad = ask(service, [f"v{i}" for i in range(10)], batch_size=10)
    assert service.calls == 1 and bad == {"v3": "null answer", "v7": "null answer"} and len(good) == 8


def test_a_smaller_limit_of_the_service_is_learnt():
    values = [f"value number {i}" for i in range(500)]
    service = Service(limit=400)
    good, bad = ask(service, values, batch_size=200)
    assert len(good) == 500 and not bad
    # 400 bytes hold about 20 values: some 30 calls, and the few that found the limit.
    assert service.calls < 70
    good, bad = ask(Service(limit=400), ["x" * 1000, *values, "y" * 500], batch_size=200)
    assert len(good) == 500 and {k[0]: r.split(":")[0] for k, r in bad.items()} == {"x": "too large", "y": "too large"}


def test_a_value_over_max_bytes_is_not_sent():
    service = Service()
    good, bad = ask(service, ["a", "b" * 90, "c"], max_bytes=50)
    assert set(good) == {"a", "c"} and bad == {"b" * 90: "too large"} and max(service.sizes) == 1


def test_refusals_that_pass_alone_are_answered():
    class Moody:
        def __call__(self, values):
            if len(values) > 3:
                raise L.RefusedError("too many friends")
            return values

    good, bad = ask(Moody(), [str(i) for i in range(50)], batch_size=16)
    assert len(good) == 50 and not bad


def test_throttling_is_still_retried_and_an_outage_fails():
    class Slow:
        def __init__(self):
            self.n = 0

        def __call__(self, values):
            self.n += 1
            if self.n % 3:
                raise L.RetryableError("throttled")
            if "bad" in values:
                raise L.RefusedError("no")
            return values

    good, bad = ask(Slow(), ["a", "bad", "b"])
    assert set(good) == {"a", "b"} and bad == {"bad": "no"}

    def down(values):
        raise L.RetryableError("down")

    with pytest.raises(L.LookupFailed, match="no answer"):
        ask(down, ["a"], max_retries=2)
    with pytest.raises(L.LookupFailed, match="more than 2"):
        ask(Service({str(i) for i in range(9)}), [str(i) for i in range(9)], max_rejects=2)


def test_http_status(monkeypatch):
    http = L.HttpJsonLookup("https://service.invalid/x", L.PSEUDONYMIZE_CODEC)
    for code, kind in ((413, L.TooLargeError), (400, L.RefusedError), (422, L.RefusedError), (503, L.RetryableError)):
        def answer(req, timeout, code=code):
            raise urllib.error.HTTPError(req.full_url, code, "no", {}, None)

        monkeypatch.setattr(L.urllib.request, "urlopen", answer)
        with pytest.raises(kind):
            http(["v"])


def test_rows_and_reject_table(spark, tmp_path):
    rows = [(i, f"v{i % 40}", None if i % 7 else f"v{i % 3}") for i in range(400)] + [(400, " ", "v5"), (401, None, "")]
    df = spark.createDataFrame(rows, "id long, a string, b string")
    path = str(tmp_path / "rejects")
    policy = L.LookupPolicy(batch_size=9, bad_values="reject")
    out = L.apply_lookup(df, ["a", "b"], Service({"v1", "v17"}), policy=policy, reject_path=path).collect()
    want = lambda v: v if v is None else "" if not v.strip() else None if v in ("v1", "v17") else "p" + v
    assert sorted(out) == sorted((i, want(a), want(b)) for i, a, b in rows)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("v1", "refused"), ("v17", "refused")]
    with pytest.raises(ValueError, match="go together"):
        L.apply_lookup(df, "a", Service(), policy=policy)
    with pytest.raises(Exception, match="refused"):
        L.apply_lookup(df, "a", Service({"v1"})).collect()
