import random

from pyspark.sql import functions as F

from ambry.llm.warc_revisit import PERMITTED, canonical_url, resolve_revisits

SCHEMA = "record_id string, uri string, ts long, type string, status int, headers map<string,string>, digest string, length long"


def test_canonical_url(spark):
    same = ["http://Www.Example.com/a/?ref=1&b=2&a=1#top", "HTTPS://example.com:443/a?a=1&b=2", "example.com/a/?utm_source=x&b=2&a=1"]
    rows = [(u,) for u in [*same, "", None, "  ", "http://x.org", "http://X.org/#f", "http://x.org/A"]]
    got = [r[0] for r in spark.createDataFrame(rows, "u string").select(canonical_url(F.col("u"))).collect()]
    assert got == ["example.com/a?a=1&b=2"] * 3 + [None] * 3 + ["x.org", "x.org", "x.org/A"]


def by_hand(records):
    out = {}
    for r in records:
        if r[3] != "revisit":
            continue
        earlier = [x for x in records if r[1] and x[3] == "response" and x[4] == 200 and x[1] == r[1] and (x[2] if x[2] is not None else -1 << 62) < (r[2] if r[2] is not None else -1 << 62)]
        found = max(earlier, key=lambda x: (x[2] if x[2] is not None else -1 << 62, x[0]), default=None)
        new, old = r[5] or {}, found[5] if found else {}
        tag = lambda h: h["etag"].removeprefix("W/") if "etag" in h else None
        if not r[1]:
            o = "no_url"
        elif not found:
            o = "no_response"
        elif tag(new) and tag(old):
            o = "resolved" if tag(new) == tag(old) else "etag_mismatch"
        elif "last-modified" in new and "last-modified" in old:
            o = "resolved" if new["last-modified"] == old["last-modified"] else "modified"
        else:
            o = "unvalidated"
        out[r[0]] = (o, found and found[0], {**old, **{k: v for k, v in new.items() if k in PERMITTED}} if o == "resolved" else None)
    return out


def test_against_plain_python(frame, tmp_path):
    rng = random.Random(3)
    records = []
    for i in range(600):
        kind = rng.choice(["response", "revisit", "revisit", "request"])
        h = {k: rng.choice(v) for k, v in {"etag": ['"1"', 'W/"1"', '"2"'], "last-modified": ["m1", "m2"], "date": [str(i)], "content-type": ["a", "b"],
                                          "vary": ["x"], "set-cookie": ["c"]}.items() if rng.random() < 0.7}
        records.append((f"r{i:03}", rng.choice(["hot.org/x"] * 5 + ["a.org", "b.org/c", None]), rng.choice([None, *range(0, 400_000, 7000)]), kind,
                        304 if kind == "revisit" else rng.choice([200, 200, 404]), h if rng.random() < 0.95 or kind == "response" else None, f"d{i}", i))
    df = frame(records, SCHEMA, tmp_path)
    want = by_hand(records)
    for how in ({}, {"bucket_seconds": 5000}):
        got = {r.record_id: (r.outcome, r.response_id, r.headers) for r in resolve_revisits(df, **how).collect()}
        assert got == want
    assert {o for o, _, _ in want.values()} == {"no_url", "no_response", "resolved", "etag_mismatch", "modified", "unvalidated"}


def test_edges(frame, tmp_path):
    assert resolve_revisits(frame([], SCHEMA, tmp_path / "a")).collect() == []
    twice = [("a", "x.org", 1, "response", 200, {"etag": "1"}, "d", 5)] * 2 + [("b", "x.org", 1, "revisit", 304, {"etag": "1"}, None, 0)] + [("c", "x.org", 9, "revisit", 304, {"etag": "1"}, None, 0)] * 2
    got = sorted((r.record_id, r.outcome) for r in resolve_revisits(frame(twice, SCHEMA, tmp_path / "b").withColumn("found", F.lit(1))).collect())
    assert got == [("b", "no_response"), ("c", "resolved"), ("c", "resolved")]
