import gzip
import hashlib
import itertools

import pytest
from pyspark.sql import functions as F

from tidewell.llm import url_rules, warc

LONG = "é" * 600


def page_rows():
    rows = [(i, f"https://h.example.org/{i}", LONG) for i in range(40)]
    rows += [
        (100, None, None), (101, "http://x.example.net/a\r\nX-Evil: 1", ""), (102, "u", "WARC/1.1\r\n\r\n\r\n\r\nContent-Length: 3"),
        (103, "u", "short"), (104, "u", "short"), (105, "u", "a" * 999), (106, "u", "a" * 999), (107, "u", "a" * 1000),
        (None, "u", "a" * 1000), (108, "u", "b" * 3_000_000), (109, "u", "b" * 3_000_000), (110, "u", "c" * 2000), (110, "u", "c" * 2000),
    ]
    return rows


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*r, "x", "y", i) for i, r in enumerate(page_rows())]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, record_type string, n int").repartition(3)


def test_archives_come_back_whole(spark, pages, tmp_path):
    got = warc.archive(pages, str(tmp_path / "a"), payload=True).collect()
    rows = page_rows()
    assert len(got) == len(rows)
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        top = max(same) if len(data) >= 1000 and same else page
        revisit = top != page
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=key) == sorted(want, key=key)
    assert all(hashlib.sha1(r.payload or b"").hexdigest() == r.payload_digest for r in got)


def test_archives_hold_each_long_payload_once(spark, pages, tmp_path):
    path = str(tmp_path / "a")
    warc.write_archives(pages, path)
    found = warc.read_archives(spark, path)
    assert found.filter((F.col("record_type") == "response") & (F.col("stored_bytes") == 1200)).count() == 1
    revisits = found.filter("record_type = 'revisit'")
    assert revisits.agg(F.max("stored_bytes")).first()[0] == 0
    assert found.filter("payload_digest <> stored_digest and record_type = 'response'").count() == 0
    assert found.filter("page_id = 101").first().target_uri == "http://x.example.net/a%0D%0AX-Evil: 1"


def test_no_pages(spark, pages, tmp_path):
    assert warc.archive(pages.limit(0), str(tmp_path / "a")).count() == 0


def url_list():
    urls = [f"https://{h}.example.{t}/{lang}/{i}{end}" for i, (h, t, lang, end) in enumerate(itertools.product(
        ("a", "b.c", "m"), ("net", "com", "org"), ("en", "de", "fr", "es"), ("", ".html", "?page=2&ref=x", "#top", "/")))]
    return urls + [
        None, "", "no scheme/en/", "HTTP://EXAMPLE.NET/en/x", "http://example.net", "http://notexample.com/de/x", "http://com/de/",
        "http://É.ORG/fr/a?b=://c", "x://y.net/\n/z", "https://a.example.org/fr/" + "p/" * 5000, "http://org/fr/", "http:///en/", urls[0], urls[0],
    ]


def editors(url):
    url = url or ""
    if "://" not in url:
        return "", "", None
    rest = url[url.index("://") + 3:]
    stop = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:stop])
    tail = rest[stop:]
    path = tail[:min([i for i in (tail.find(c) for c in "?#") if i >= 0], default=len(tail))]
    fits = [(d + s) for _, d, s in url_rules.RULES if (host == d or host.endswith("." + d)) and path.startswith(s)]
    return host, path, max(fits, key=len, default=None)


def test_urls_are_judged_as_by_brute_force(spark):
    urls = url_list()
    frame = spark.createDataFrame([(i, u, "x", None) for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    tokens = {r.page_id: r.tokens for r in frame.select("page_id", url_rules.url_tokens(
        F.col("url"), *url_rules.host_and_path(F.col("url"))).alias("tokens")).collect()}
    action = {d + s: a for a, d, s in url_rules.RULES}
    labelled = [(frozenset(tokens[i]), action[editors(u)[2]]) for i, u in enumerate(urls) if editors(u)[2]]
    every = {t for ts, _ in labelled for t in ts}
    mined = []
    for combo in [*((t,) for t in sorted(every)), *itertools.combinations(sorted(every), 2)]:
        said = [v for ts, v in labelled if ts.issuperset(combo)]
        for verdict in ("allow", "block"):
            n = said.count(verdict)
            if said and n >= url_rules.SUPPORT * len(labelled) and n / len(said) >= url_rules.CONFIDENCE:
                mined.append((-n / len(said), -n / len(labelled), "\x1f".join(combo), verdict, frozenset(combo)))
    mined.sort(key=lambda m: m[:4])
    got = {r.page_id: r for r in url_rules.judge(frame).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        host, path, rule = editors(url)
        verdict = action[rule] if rule else next((m[3] for m in mined if m[4] <= set(tokens[i])), "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), url


def test_nothing_labelled_is_allowed(spark):
    frame = spark.createDataFrame([(1, "http://a.example/x"), (None, None)], "page_id long, url string")
    assert [(r.rule, r.verdict) for r in url_rules.judge(frame).collect()] == [(None, "allow")] * 2
    assert url_rules.judge(frame.limit(0)).count() == 0


def test_rules_of_any_length_decide_and_pruning_changes_nothing(spark):
    rows = []
    for i in range(120):  # only three tokens together tell the verdict
        a, b, c = i % 2, i // 2 % 2, i // 4 % 2
        rows.append((["t%d" % a, "u%d" % b, "v%d" % c], "block" if a and b and c else "allow"))
    labelled = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    mined = url_rules.mine(labelled)
    assert ["t1", "u1", "v1"] in [r.tokens for r in mined.collect() if r.verdict == "block"]
    kept = url_rules.prune(mined).collect()
    assert len(kept) < mined.count()

    def decide(rules, tokens):
        fits = [(-r.confidence, -r.support, r.tokens, r.verdict) for r in rules if set(r.tokens) <= set(tokens)]
        return min(fits)[3] if fits else None

    everything = mined.collect()
    for tokens in itertools.product(("t0", "t1", "x"), ("u0", "u1", "x"), ("v0", "v1", "x")):
        assert decide(kept, tokens) == decide(everything, tokens)
    assert decide(kept, ["t1", "u1", "v1"]) == "block" and decide(kept, ["t1", "u0", "v1"]) == "allow"


def record(page, body):
    http = b"HTTP/1.1 200 OK\r\n\r\n" + body
    head = (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <{warc.RECORD_ID}{page}>\r\n"
            f"WARC-Payload-Digest: sha1:{hashlib.sha1(body).hexdigest()}\r\nContent-Length: {len(http)}\r\n\r\n")
    return head.encode() + http + b"\r\n\r\n"


def test_archives_of_many_members_and_a_large_page(spark, tmp_path):
    bodies = [b"one", b"x" * (50 << 20), b"\r\n\r\nthree\r\n\r\n", b""]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(record(i, b), 1) for i, b in enumerate(bodies)))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(record(8, b"eight") + record(9, b"nine")))
    got = {r.page_id: (r.stored_bytes, r.stored_digest) for r in warc.read_archives(spark, str(tmp_path), payload=False).collect()}
    want = {**dict(enumerate(bodies)), 8: b"eight", 9: b"nine"}
    assert got == {i: (len(b), hashlib.sha1(b).hexdigest()) for i, b in want.items()}
    with pytest.raises(ValueError, match="breaks off"):
        list(warc.records(warc.inflated(gzip.compress(record(1, b"abc"))[:-20])))
    with pytest.raises(ValueError, match="breaks off"):
        list(warc.records([record(1, b"abc")[:-6]]))


def test_many_large_payloads_are_resolved(spark, tmp_path):
    rows = [(2 * i + k, f"http://h/{i}", ("%04d" % i) * 6000) for i in range(300) for k in (0, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.archive(pages, str(tmp_path / "a"), payload=True).collect()}
    assert len(got) == 600 and all(bytes(got[p].payload).decode() == html for p, _, html in rows)
    assert all(got[2 * i].refers_to == 2 * i + 1 and got[2 * i + 1].refers_to is None for i in range(300))
