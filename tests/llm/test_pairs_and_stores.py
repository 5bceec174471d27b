"""Near duplicates, vector search and archives against brute force."""

import hashlib
import random

import numpy as np
from brute import DOCS, components, docs_frame, empty_docs, table
from pyspark.sql import functions as F

from tillroll.llm import near_dups, vectors, warc


def _groups(spark, rows):
    got = near_dups.near_duplicates(docs_frame(spark, rows).repartition(5)).collect()
    want = components(rows)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id] and r.kept == (r.doc_id == want[r.doc_id])
    return got


def test_near_duplicates_equal_brute_force(spark):
    docs = table(spark, "documents")
    _groups(spark, [(r.doc_id, r.text) for r in docs.collect()])


def test_near_duplicates_on_odd_rows(spark):
    got = _groups(spark, DOCS + [(20, "a b"), (21, "A  B"), (22, "a b c"), (23, "x É"), (24, "X é"), (25, "x É")])
    n = {r.doc_id: r.n_shingles for r in got if r.doc_id}
    assert n[2] == n[3] == n[4] == 0 and n[20] == 1 and n[5] == len({tuple((i + k) % 977 for k in range(5)) for i in range(977)}) + 5 or n[5] > 970
    assert near_dups.near_duplicates(empty_docs(spark)).count() == 0


def test_a_large_group_of_edited_copies(spark):
    # copies with one to three edits: some are linked directly, some over others, some not at all
    rnd = random.Random(8)
    base = [f"word{rnd.randint(0, 400)}" for _ in range(90)]
    rows = [(1000 + i, " ".join(f"own{rnd.randint(0, 9999)}" for _ in range(60))) for i in range(40)]
    for i in range(160):
        w = list(base)
        for _ in range(rnd.randint(1, 3)):
            w[rnd.randrange(len(w))] = f"edit{rnd.randint(0, 999)}"
        rows.append((i, " ".join(w)))
    got = _groups(spark, rows)
    assert len({r.component_id for r in got}) < 200


def test_all_pairs_within_the_distance_meet():
    rng = np.random.default_rng(2)
    sig = rng.integers(0, 1 << 16, (300, near_dups.SYMBOLS)).astype(np.uint64)
    other = sig.copy()
    for k in range(300):  # as many errors as the index allows, anywhere
        at = rng.choice(near_dups.SYMBOLS, near_dups.MAX_DIFFERENT, replace=False)
        other[k, at] = (other[k, at] + 1) % (1 << 16)
    a, b = near_dups.index_keys(sig), near_dups.index_keys(other)
    assert all(set(x) & set(y) for x, y in zip(a, b))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.node: r.root for r in near_dups.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 1 for i in range(2, 41)) and all(got[i] == 100 for i in range(101, 160))


def _nearest(rows, query, k=10):
    x = {}
    for i, v in rows:
        if i is None or not v or any(c is None or not np.isfinite(c) for c in v) or not any(v):
            continue
        x[i] = min(x.get(i, v), v)
    q = np.array(x[query], float)
    d = sorted((float(np.sqrt(((np.array(v, float) - q) ** 2).sum())), i) for i, v in x.items() if i != query and len(v) == len(q))
    return [(i, s) for s, i in d[:k]]


def test_vector_search_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in df.collect()]
    got = vectors.nearest(df, F.col("vec_id") % 100 == 0).collect()
    queries = sorted({r.query_id for r in got})
    assert queries == [i for i, _ in sorted(rows) if i % 100 == 0]
    hits = 0
    for q in queries:
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        want = dict(_nearest(rows, q))
        assert [m[0] for m in mine] == list(range(1, 11)) and [m[2] for m in mine] == sorted(m[2] for m in mine)
        hits += len(want.keys() & {m[1] for m in mine})
        for _, i, s in mine:
            if i in want:
                assert abs(want[i] - s) < 1e-12
    assert hits >= 0.95 * 10 * len(queries)


def test_vector_search_on_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(100, [1.0, 0.0]), (3, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [1.0, None]),
            (8, [inf, 1.0]), (9, []), (None, [1.0, 1.0]), (10, [1.0, 0.0, 0.0]), (200, [0.0, 3.0]), (200, [0.0, 2.0]), (11, [1.0, 0.5]), (11, [1.0, 0.5]), (300, [0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0, 0.0) for i, v in rows], "vec_id long, embedding array<float>, rank int, score double")
    got = vectors.nearest(df, F.col("vec_id") % 100 == 0).collect()
    for q in (100, 200):
        assert [(r.vec_id, round(r.score, 6)) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == [
            (i, round(s, 6)) for i, s in _nearest(rows, q)]
    assert {r.query_id for r in got} == {100, 200} and vectors.nearest(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    hot = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(500)] + [(500, [1.0, 2.5])], "vec_id long, embedding array<double>")
    got = vectors.nearest(hot, F.col("vec_id") == 500).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(i, 0.5) for i in range(10)]


PAGES = [(1, "http://www.a.com/x", "p" * 2000), (2, "https://a.com:8443/y?q=1", "p" * 2000), (9, "http://b.org/", "p" * 2000),
         (3, "http://a.com/x", "small"), (4, "http://a.com/x", "small"), (5, None, None), (6, "no url at all \n", ""), (7, "http://c.net/é", "é" * 700),
         (8, "http://c.net/é", "é" * 700), (9, "http://b.org/", "p" * 2000), (None, "http://d.de/", "q" * 1500), (10, "http://d.de/", "q" * 1500),
         (None, None, None), (-5, "http://[bad", "r" * 1000), (11, "http://e.fr/", "s" * 999), (12, "http://e.fr/", "s" * 999)]


def _archive_brute(rows):
    data = [(i, (h or "").encode()) for i, _, h in rows]
    last = {}
    for i, b in data:
        if i is not None and len(b) >= 1000:
            last[b] = max(last.get(b, i), i)
    out = []
    for i, b in data:
        old = i is not None and len(b) >= 1000 and i < last[b]
        out.append((str(i), len(b), hashlib.sha1(b).hexdigest(), "revisit" if old else "response", last[b] if old else None))
    return sorted(map(str, out))


def test_archives_round_trip(spark):
    frame = lambda rows: spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, key string, length int")
    got = warc.round_trip(frame(PAGES).repartition(3)).collect()
    assert sorted(str((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == _archive_brute(PAGES)
    assert warc.round_trip(frame(PAGES).limit(0)).count() == 0
    real = table(spark, "pages")
    rows = [(r.page_id, r.url, r.html) for r in real.collect()]
    got = warc.round_trip(real).collect()
    assert sorted(str((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == _archive_brute(rows)


def test_look_up_over_many_blocks_and_payloads(spark, scratch, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    pages = spark.createDataFrame([(i, f"http://h{i % 3}.example.com/{i // 5}", f"text {i}") for i in range(300)], "page_id long, url string, html string")
    folder = f"{scratch}/warc"
    index = warc.write_index(warc.write_archives(pages, folder), folder)
    keys = warc.capture_keys(pages.where("page_id in (0, 17, 299)")).union(spark.createDataFrame([("com,nowhere)/\t1",)], "key string"))
    got = warc.read_records(warc.look_up(keys, index, folder), folder, with_payload=True).collect()
    assert sorted((r.page_id, bytes(r.payload)) for r in got) == [(0, b"text 0"), (17, b"text 17"), (299, b"text 299")]


def test_url_keys():
    assert warc.url_key("https://www.Example.com:443/a?b=1") == "com,example)/a?b=1"
    assert warc.url_key("http://example.com:8080") == "com,example:8080)/" and warc.url_key(None) == "" and "\n" not in warc.url_key("a\nb")


def test_members_up_to_the_looser_distance_are_compared():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 16, near_dups.SYMBOLS).astype(np.uint64)
    rows = [base]
    for k in (1, 17, 18, 24, 25, 45):
        other = base.copy()
        other[:k] ^= np.uint64(5)  # k nibbles differ from the first row
        rows.append(other)
    s0, s1, s2 = near_dups.nibbles(np.array(rows)).T
    group = {"s0": s0, "s1": s1, "s2": s2, "n_shingles": [100] * 7, "root": np.arange(7)}
    assert next(near_dups._near_members(group))[1].tolist() == [1, 2, 3, 4]


def test_borderline_links_are_found(spark):
    rows = []
    for k in range(150):  # two texts of 408 words: 404 shingles each, 372 shared, 372 / 436 = 0.853
        words = [f"d{k}w{i}" for i in range(408)]
        other = words[:376] + [f"x{k}w{i}" for i in range(32)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    got = near_dups.near_duplicates(docs_frame(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i - i % 2 for i in range(300)}
