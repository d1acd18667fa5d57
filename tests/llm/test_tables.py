"""URL filter, top-k, decontamination and WARC: SQL twins and awkward input."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import decontaminate, topk, url_filter, warc
from tessera.llm.oracles import ORACLES
from tessera.llm.queries import QUERIES, URL_RULES

duckdb = pytest.importorskip("duckdb")
DIR = "/root/testdata/sf0.01"


def rows_of(df_rows, columns):
    return sorted(tuple(str(r[c]) for c in columns) for r in df_rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    got = QUERIES[name](spark, DIR)
    columns = sorted(got.columns)
    want = con.sql(ORACLES[name])
    assert sorted(want.columns) == columns
    assert rows_of(got.collect(), columns) == sorted(tuple(map(str, r)) for r in want.select(*columns).fetchall())


# --- URL filter ---


def brute_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        raw = re.match(r"[^/?#]*", rest)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), raw)
        path = re.match(r"[^?#]*", rest[len(raw) :])[0]
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


URLS = [
    None, "", "no scheme", "://", "http://", "http://com", "HTTP://A.COM/x", "http://com/", "http://x.com?q=/", "http://example.com/en/1",
    "http://www.example.com/en/1", "http://WWW.EXAMPLE.COM/EN/1", "http://notexample.com/en/", "a://b://com/", "http://x.net/es/?a#b",
    "http://x.net/es", "http://x.net#/es/", "http://" + "a." * 30000 + "net/fr/", "http://net/" + "f" * 90000, "http://x.net/fr/é", "http://İ.com/",
]


def test_verdicts_against_brute_force(spark):
    rows = [(i, u, "clash", "clash") for i, u in enumerate(URLS)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, rule string, Host string")
    got = url_filter.judge_urls(df, "url", url_filter.rules_frame(spark, URL_RULES))
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    want = [(i, *brute_verdict(u, URL_RULES)) for i, u, *_ in rows]
    assert sorted(map(str, ((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()))) == sorted(map(str, want))


def test_many_rules_and_a_filter_too_small(spark):
    rng = random.Random(5)
    hosts = [f"{a}.{b}" for a in "abcdefgh" for b in ("org", "com", "net")] + ["org", "com"]
    rules = sorted({(rng.choice(hosts), rng.choice(["", "/", "/x", "/x/y"]), rng.choice(["allow", "block"])) for _ in range(60)})
    rules = [r for i, r in enumerate(rules) if r[:2] not in {q[:2] for q in rules[:i]}]
    urls = [f"http://{rng.choice(['', 'w.'])}{rng.choice(hosts)}{rng.choice(['', '/', '/x/y/z', '/q'])}" for _ in range(200)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    # One block: nearly every key passes the filter, and the join removes what is no rule.
    got = url_filter.judge_urls(df, "url", url_filter.rules_frame(spark, rules), max_filter_bytes=8).collect()
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got} == {i: brute_verdict(u, rules) for i, u in enumerate(urls)}


def test_no_rules_and_no_urls(spark):
    none = url_filter.rules_frame(spark, [])
    some = url_filter.rules_frame(spark, URL_RULES)
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [r["verdict"] for r in url_filter.judge_urls(df, "url", none, default="block").collect()] == ["block"]
    assert url_filter.judge_urls(df.limit(0), "url", some).collect() == []


# --- exact top-k ---


def test_top_k_against_all_scores(spark):
    rng = random.Random(2)
    vectors = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(400)]
    vectors += [(400 + i, [0.25] * 6) for i in range(30)]  # ties
    vectors += [(500, None), (501, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (502, [float("nan")] * 6), (503, [float("inf")] * 6), (504, [0.5, 0.5]), (505, []), (None, [0.1] * 6)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = topk.top_k(df, df.where("vec_id % 100 = 0 or vec_id >= 504"), "vec_id", "embedding", k=10, tile_rows=100, query_rows=2).collect()
    whole = {i: [int(1024 * x // 1) for x in v] for i, v in vectors[:430]}
    want = []
    for q in range(0, 401, 100):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)[:10]
        want += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_top_k_of_huge_components_and_repeated_rows(spark):
    df = spark.createDataFrame([(0, [1e12]), (1, [1e12]), (2, [-3e12]), (3, [1.0]), (3, [1.0])], "vec_id long, embedding array<double>")
    got = topk.top_k(df, df.where("vec_id = 0"), "vec_id", "embedding", 10).collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(got)] == [(1, 1), (2, 3), (3, 3), (4, 2)]
    assert sorted(got)[1]["score"] == 1024 * 1024 * 10**12
    assert sorted(got)[0]["score"] == 2**63 - 1
    assert topk.top_k(df.limit(0), df.limit(0), "vec_id", "embedding").collect() == []


# --- decontamination ---


def brute_hits(text, items, window):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, found = find(text), set(), set()
    for item, item_text in items:
        w = find(item_text)
        n = min(len(w), window)
        for g in {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else ():
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) == g:
                    hit.update(range(i, i + n))
                    found.add(item)
    return len(words), len(hit), sorted(str(f) for f in found if f is not None)


@pytest.mark.parametrize("shard_chars", [10**6, 40])
def test_hits_against_brute_force(spark, awkward, shard_chars):
    rng = random.Random(11)
    draw = lambda n: " ".join(rng.choice(["a", "B", "c,", "é", "x-y"]) for _ in range(n))
    items = [(i, draw(rng.randint(0, 9))) for i in range(14)] + [(3, "a b c"), (None, "b b b"), (20, None), (21, ""), (22, "...")]
    items += [items[4]] * 40  # repeated items count once, also to the size of a shard
    texts = [(i, draw(rng.randint(0, 60))) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in texts], "doc_id long, text string, Match string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_contamination(docs, "text", bench, "item_id", "text", "match", window=4, shard_chars=shard_chars)
    got = {r["doc_id"]: r["match"] for r in found.collect()}
    for i, t in texts:
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) == brute_hits(t, items, 4), t
    assert decontaminate.find_contamination(awkward, "text", bench, "item_id", "text", window=4, shard_chars=shard_chars).count() == awkward.count()


def test_shards_are_built_in_tasks_from_distinct_items(spark):
    bench = spark.createDataFrame([(i % 20, f"item {i % 20} " + "word " * 10) for i in range(400)], "item_id long, text string")
    shards = list(decontaminate.automata(spark, bench, "item_id", "text", shard_chars=260))
    assert 2 <= len(shards) <= 6  # 20 items of 57 to 58 characters
    assert all(isinstance(s.value, bytes) for s in shards)
    texts = [(i, f"so item {i % 20} " + "word " * (i % 14) + "Ümlaut") for i in range(60)] + [(None, None), (99, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    one, many = (
        sorted((tuple(r) for r in decontaminate.find_contamination(docs, "text", bench, "item_id", "text", shard_chars=n).collect()), key=repr)
        for n in (10**6, 260)
    )
    assert one == many and any(r[2]["n_hit"] for r in one)


def test_spans_are_cut_and_clean_documents_stay(spark, empty):
    passage = " ".join(f"w{i}" for i in range(13))
    clean = " ".join(f"c{i}" for i in range(400))
    docs = spark.createDataFrame([(0, clean), (1, f"Before, {passage.upper()}! After."), (2, f"{clean} {passage}."), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, passage)], "item_id long, text string")
    kept = decontaminate.drop_contaminated(docs, "text", bench, "item_id", "text")
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3]  # 13 of 413 words are less than one in 20
    found = decontaminate.find_contamination(docs, "text", bench, "item_id", "text")
    cut = {r["doc_id"]: r["t"] for r in found.select("doc_id", decontaminate.remove_spans(F.col("text"), F.col("match")).alias("t")).collect()}
    assert cut == {0: clean, 1: "Before, ! After.", 2: f"{clean} .", 3: None}
    assert decontaminate.drop_contaminated(empty, "text", bench, "item_id", "text").collect() == []
    assert decontaminate.drop_contaminated(docs, "text", bench.limit(0), "item_id", "text").count() == 4


# --- WARC ---


def test_records_are_rebuilt_exactly(spark):
    import base64

    rows = [(0, "u0", "same"), (1, None, "same"), (2, "u\r\n2", "same"), (3, "u3", None), (4, "u4", ""), (5, "u5", "é"), (None, "u6", "same"), (2, "u7", "same")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, address string")
    archive = warc.write_archive(df, "page_id", "url", "html")
    assert spark.read.parquet(archive.payloads).count() == 3  # each payload once
    got = warc.read_records(spark, archive).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["label"] == base64.b32encode(hashlib.sha1(r["payload"]).digest()).decode()
        assert r["length"] == len(r["payload"])
        head, body = bytes(r["record"]).split(b"\r\n\r\n", 1)
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: " + r["record_type"].encode())
        assert body == (bytes(r["payload"]) if r["record_type"] == "response" else b"") + b"\r\n\r\n"
    kinds = sorted((str(r["id"]), bytes(r["payload"]).decode(), r["record_type"], r["refers_to"]) for r in got)
    assert kinds == sorted([
        ("0", "same", "revisit", "2"), ("1", "same", "revisit", "2"), ("2", "same", "response", None), ("2", "same", "response", None),
        ("None", "same", "revisit", "2"), ("3", "", "revisit", "4"), ("4", "", "response", None), ("5", "é", "response", None),
    ])


def test_headers_are_complete(spark):
    rows = [(1, "http://a/%0A?q=1", "x", "2024-05-06 07:08:09"), (2, "u\r\n2", "y", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = {r["id"]: bytes(r["record"]).decode() for r in warc.read_records(spark, warc.write_archive(df, "page_id", "url", "html", date_col="t")).collect()}
    assert "\r\nWARC-Date: 2024-05-06T07:08:09Z\r\n" in got[1] and "\r\nWARC-Target-URI: http://a/%0A?q=1\r\n" in got[1]
    assert "\r\nWARC-Date: 1970-01-01T00:00:00Z\r\n" in got[2] and "\r\nWARC-Target-URI: u%0D%0A2\r\n" in got[2]
    for record in got.values():
        names = [line.split(": ")[0] for line in record.split("\r\n\r\n")[0].split("\r\n")[1:]]
        assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= set(names)  # what WARC 1.1 requires


def test_small_payloads_are_all_responses_and_empty_tables(spark):
    df = spark.createDataFrame([(0, "u", "ab"), (1, "u", "ab"), (2, "u", "abc"), (3, "u", "abc")], "page_id long, url string, html string")
    got = warc.read_records(spark, warc.write_archive(df, "page_id", "url", "html", min_bytes=3), with_bytes=False).collect()
    assert {r["id"]: r["record_type"] for r in got} == {0: "response", 1: "response", 2: "revisit", 3: "response"}
    assert warc.read_records(spark, warc.write_archive(df.limit(0), "page_id", "url", "html")).collect() == []


def test_a_damaged_payload_fails_the_read(spark, tmp_path):
    df = spark.createDataFrame([(0, "u", "abc")], "page_id long, url string, html string")
    archive = warc.write_archive(df, "page_id", "url", "html")
    bad = warc.Archive(str(tmp_path / "bad"), archive.headers)
    spark.read.parquet(archive.payloads).withColumn("payload", F.lit(b"abd").cast("binary")).write.parquet(bad.payloads)
    with pytest.raises(Exception, match="digest"):
        warc.read_records(spark, bad).collect()
