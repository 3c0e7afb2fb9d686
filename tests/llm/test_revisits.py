import random

from glossaria.llm import revisits as r

SCHEMA = "record_id long, url string, at long, kind string, headers map<string,string>, digest string, slice string"
PERMITTED = set(r.PERMITTED)


def plain(records):
    out = []
    for v in records:
        if v[3] != "revisit":
            continue
        rid, url, at, _, headers, digest = v[:6]
        own = {k.lower(): x for k, x in (headers or {}).items() if x is not None}
        before = [f for f in records if f[3] == "response" and None not in (rid, url, at, f[0], f[1], f[2]) and f[1].split("#")[0] == url.split("#")[0] and (f[2], f[0]) < (at, rid)]
        if not before:
            out.append((rid, None, "missing", own))
            continue
        f = max(before, key=lambda f: (f[2], f[0]))
        theirs = {k.lower(): x for k, x in (f[4] or {}).items() if x is not None}
        bare = lambda t: t and t.removeprefix("W/")
        pairs = [(digest, f[5]), (bare(own.get("etag")), bare(theirs.get("etag"))), (own.get("last-modified"), theirs.get("last-modified"))]
        same = next((a == b for a, b in pairs if a is not None and b is not None), None)
        status = "unchecked" if same is None else "matched" if same else "mismatch"
        out.append((rid, f[0], status, own if status == "mismatch" else theirs | {k: x for k, x in own.items() if k in PERMITTED}))
    return out


def test_against_brute_force(spark):
    rng = random.Random(4)
    records = []
    for i in range(700):
        kind = rng.choice(["response", "revisit", "revisit", "request"])
        url = rng.choice(["http://hot.net/a", "http://hot.net/a#x", f"http://h{rng.randint(0, 20)}.net/", None])
        headers = {k: rng.choice(v) for k, v in {"ETag": ['"1"', 'W/"1"', '"2"', None], "Last-Modified": ["x", "y", None], "Date": [str(i)], "Content-Length": ["9"], "X-Own": ["q"]}.items() if rng.random() < 0.6}
        records.append((i, url, rng.choice([rng.randint(-9000, 40_000), 3600, None]), kind, rng.choice([headers, headers, None]), rng.choice(["d1", None, None]), "own"))
    shown = lambda rows: sorted(str((a, b, c, sorted(h.items()))) for a, b, c, h in rows)
    for seconds in (r.SLICE_SECONDS, 60):  # some spans of slices with the shorter ones
        found = r.resolve_revisits(spark.createDataFrame(records, SCHEMA), seconds).collect()
        assert shown((x["record_id"], x["source_id"], x["status"], x["headers"]) for x in found) == shown(plain(records))


def test_ties_of_time_and_repeated_ids(spark):
    rows = [
        (1, "http://x.net/", 10, "response", {"etag": '"a"'}, "d", ""), (1, "http://x.net/", 10, "revisit", {}, "d", ""),  # the same time and id: not before it
        (2, "http://x.net/", 10, "revisit", {}, "d", ""), (2, "http://x.net/", 10, "revisit", {}, "e", ""),  # a later id of the same time
        (3, "http://x.net/", 10, "response", {"etag": '"b"'}, "e", ""), (3, "http://x.net/", 10, "response", {"etag": '"b"'}, "e", ""), (4, "http://x.net/", 10, "revisit", {}, "e", ""),
    ]
    found = sorted((x["record_id"], x["source_id"], x["status"]) for x in r.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect() if x["source_id"])
    assert found == [(2, 1, "matched"), (2, 1, "mismatch"), (4, 3, "matched")]
    assert [x["status"] for x in r.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect() if x["record_id"] == 1] == ["missing"]


def test_very_long_headers_and_many_captures_of_one_url(spark):
    long = "v" * 200_000
    rows = [(2 * i, "http://hot.net/", i // 3, "response", {"X-Long": long if i == 7 else "s"}, f"d{i}", "") for i in range(900)] + [(2 * i + 1, "http://hot.net/", i // 3, "revisit", {"Date": "x"}, f"d{i}", "") for i in range(900)]
    for seconds in (r.SLICE_SECONDS, 7):
        found = {x["record_id"]: x for x in r.resolve_revisits(spark.createDataFrame(rows, SCHEMA), seconds).collect()}
        assert len(found) == 900 and all(x["source_id"] == k - 1 and x["status"] == "matched" for k, x in found.items())
        assert found[15]["headers"] == {"x-long": long, "date": "x"}


def test_repeated_rows_and_empty(spark):
    row = (2, "http://x.net/", 20, "revisit", {"ETag": '"1"'}, None, "")
    rows = [(1, "http://x.net/", 10, "response", {"etag": 'W/"1"', "Content-Type": "t"}, None, ""), row, row]
    found = r.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [x["status"] for x in found] == ["matched"] * 2 and found[0]["headers"] == {"content-type": "t", "etag": '"1"'}
    assert r.resolve_revisits(spark.createDataFrame([], SCHEMA)).count() == 0
