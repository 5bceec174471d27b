"""Lexical search, bisector clustering and decontamination against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from brute import DOCS, LONG, docs_frame, empty_docs, table
from pyspark.sql import functions as F

from tillroll.llm import lexical
from tillroll.llm.bisectors import Bisectors, clusters_with_inertia, refined
from tillroll.llm.decontamination import contamination, occurrences, with_digests

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def items_frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "item_id long, text string, key int, words string")


# ---- lexical search -------------------------------------------------------------------------------------------------

def ranked_plainly(docs, items, top=20):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, c) for i, c in bags if c]
    n_docs, n_terms = len(bags), sum(sum(c.values()) for _, c in bags)
    df = Counter(t for _, c in bags for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in bags:
            m = 75 + (25 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m))
                    for t in terms(text) if t in c)
            if s > 0:
                found.append((-s, doc is None, doc or 0, doc))
        out += [(item, k + 1, f[3], -f[0]) for k, f in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def _ranks(docs_df, items_df):
    got = lexical.ranked(docs_df, items_df)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=str)


def _corpus(seed, n):
    rnd = random.Random(seed)
    vocabulary = ["the", "of", "Éa", "中文", "x1"] + [f"t{i}" for i in range(60)]
    weights = [40, 30, 10, 5, 5] + [60 / (i + 1) for i in range(60)]
    return [(i, " ".join(rnd.choices(vocabulary, weights, k=rnd.choice([1, 5, 40, 300]))).replace(" t1 ", "-T1.")) for i in range(n)]


def test_search_equals_brute_force(spark):
    docs = _corpus(1, 300) + [(400, "the " * 5000 + "t3"), (401, "t59 " * 3000)]
    items = [(i, t) for i, t in _corpus(2, 25)] + [(90, "t59 t59 t58"), (91, "nowhere"), (92, "")]
    assert _ranks(docs_frame(spark, docs).repartition(5), items_frame(spark, items)) == ranked_plainly(docs, items)


def test_search_with_ties_repeats_and_nulls(spark):
    docs = DOCS + [(50 + i, "same text here") for i in range(40)] + [(None, "same text here"), (51, "another Text")]
    items = [(1, "same text"), (1, "same text"), (None, "TEXT text w1 😀"), (3, None), (4, "..."), (5, "w976")]
    assert _ranks(docs_frame(spark, docs).repartition(3), items_frame(spark, items)) == ranked_plainly(docs, items)


def test_search_of_empty_tables(spark):
    items = items_frame(spark, [(1, "a b")])
    assert _ranks(empty_docs(spark), items) == []
    assert _ranks(docs_frame(spark, [(1, None), (2, " ")]), items) == []
    assert _ranks(docs_frame(spark), items.limit(0)) == []


def test_search_in_blocks_of_items_and_terms(spark, monkeypatch):
    docs, items = _corpus(3, 60), _corpus(4, 9)
    for name, value in (("ITEM_BLOCK", 4), ("TERM_BLOCK", 7), ("MAX_BROADCAST", 0), ("CELLS", 64)):
        monkeypatch.setattr(lexical, name, value)
    assert _ranks(docs_frame(spark, docs), items_frame(spark, items)) == ranked_plainly(docs, items)


def test_bounds_are_never_below_the_score():
    bags = [Counter(terms(t)) for _, t in _corpus(5, 200)]
    df = Counter(t.encode() for c in bags for t in c)
    sizes = np.array([sum(c.values()) for c in bags])
    items = lexical.Items([(0, {b"the": 3, b"t5": 1, b"t40": 2})], df, len(bags), int(sizes.sum()))
    block = lexical.Block(64)  # nearly all bits set: bounds are loose, never wrong
    import xxhash
    for k, c in enumerate(bags):
        block.add(k, int(sizes[k]), np.array([xxhash.xxh64_intdigest(t.encode()) for t in c], np.uint64), lexical.steps_reached(np.array(list(c.values()))))
    bounds = items.bounds(64, block.top, sizes, block.slices())[0]
    names = list(items.at)
    exact = [items.score(0, {t.encode(): n for t, n in c.items()}, names, int(m)) for c, m in zip(bags, items.damping(sizes))]
    assert (bounds >= np.array(exact)).all()


# ---- clustering -----------------------------------------------------------------------------------------------------

def clustered_plainly(rows, dimension, k, rounds):
    kept = [(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows
            if v is not None and len(v) == dimension and all(x is not None and abs(x) < 2 ** 20 for x in v)]
    first = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)[:k]
    centroids = [x for _, x in first]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        centroids = [tuple(sum(col) // len(groups[j]) for col in zip(*groups[j])) if j in groups else c for j, c in enumerate(centroids)]
    out = [(i, *reversed(nearest(x))) for i, x in kept] if centroids else []
    sums = Counter()
    for _, c, d in out:
        sums[c] += d
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, sums[c], sum(sums.values()), name[c]) for i, c, d in out), key=str)


def vectors_frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, x string")


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = [(i, [rnd.choice([-1.0, 0.0, 0.5, 1.0, rnd.uniform(-3, 3)]) for _ in range(4)]) for i in range(120)]
    rows += [(200 + i, [0.25, -0.25, 0.5, -0.01]) for i in range(60)]  # equal vectors
    rows += [(7, [9.0] * 4), (None, [1.0] * 4), (300, None), (301, [1.0] * 3), (302, [1.0, None, 1.0, 1.0]), (303, [math.nan] * 4),
             (304, [math.inf, 0.0, 0.0, 0.0]), (305, [2.0 ** 20, 0.0, 0.0, 0.0]), (306, []), (307, [-1048575.0, 1048575.0, 0.0, -0.0])]
    got = clusters_with_inertia(vectors_frame(spark, rows).repartition(4), dimension=4, clusters=6)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == clustered_plainly(rows, 4, 6, 3)


def test_few_or_no_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [0.0, 0.0])]
    got = clusters_with_inertia(vectors_frame(spark, rows), dimension=2, clusters=5)
    assert sorted(map(tuple, got.collect()), key=str) == clustered_plainly(rows, 2, 5, 3)
    for none in ([], [(None, [1.0, 2.0])], [(1, [1.0])]):
        assert clusters_with_inertia(vectors_frame(spark, none), dimension=2).count() == 0


def test_tournament_ties_go_to_the_smaller_number():
    centroids = np.array([[0, 0], [2, 0], [2, 0], [0, 2], [-2, 0]], np.int64)
    x = np.array([[1, 0], [2, 0], [0, 1], [1, 1], [-1, 0], [50, 50]], np.int64)
    assert Bisectors(centroids).nearest(x).tolist() == [0, 1, 0, 0, 0, 1]


def test_empty_clusters_stay(spark):
    rows = spark.createDataFrame([(1, [0, 0]), (2, [1, 0])], "vec_id long, x array<int>")
    out = refined(rows, np.array([[0, 0], [900, 900]], np.int64), 2)
    assert out.tolist() == [[0, 0], [900, 900]]


# ---- decontamination ------------------------------------------------------------------------------------------------

def contaminated_plainly(docs, items, window=10):
    wanted = set()
    for item, text in items:
        w = terms(text)
        wanted |= {(item, tuple(w[i:i + window])) for i in range(max(1, len(w) - window + 1)) if w}
    out = []
    for doc, text in docs:
        w = terms(text)
        hit, found = set(), set()
        for item, piece in wanted:
            for i in range(len(w) - len(piece) + 1):
                if tuple(w[i:i + len(piece)]) == piece:
                    hit |= set(range(i, i + len(piece)))
                    found.add(item)
        listed = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(w), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def _judged(docs_df, items_df):
    got = with_digests(contamination(docs_df, items_df))
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted(map(tuple, got.collect()), key=str)


def test_contamination_equals_brute_force(spark):
    rnd = random.Random(5)
    pool = [f"w{i}" for i in range(6)] + ["É", "中"]  # few words: shingles repeat inside windows
    items = [(i, " ".join(rnd.choices(pool, k=rnd.choice([1, 2, 3, 4, 5, 9, 10, 11, 25])))) for i in range(12)] + [(13, "rare one")]
    docs = []
    for i in range(40):
        parts = [" ".join(rnd.choices(pool + ["zz"], k=rnd.randint(0, 15))), rnd.choice(items)[1].upper().replace("É", "É"), rnd.choice(items)[1].replace(" ", ", ")]
        rnd.shuffle(parts)
        docs.append((i, "\n".join(parts)))
    assert _judged(docs_frame(spark, docs).repartition(3), items_frame(spark, items)) == contaminated_plainly(docs, items)


def test_contamination_of_odd_rows(spark):
    passage = " ".join(f"p{i}" for i in range(14))
    docs = DOCS + [(9, passage), (9, passage), (9, "x " + passage[:-4]), (None, "a " + passage + " b " + passage), (10, passage * 2)]
    items = [(1, passage), (1, passage), (20, "Z " + passage + " z"), (3, passage), (None, "short text"), (4, None), (5, "..."), (6, "w0 w1"), (7, LONG)]
    assert _judged(docs_frame(spark, docs), items_frame(spark, items)) == contaminated_plainly(docs, items)
    assert _judged(empty_docs(spark), items_frame(spark, items)) == []
    assert _judged(docs_frame(spark), items_frame(spark, items).limit(0)) == contaminated_plainly(DOCS, [])


def test_contamination_without_broadcast(spark, monkeypatch):
    from tillroll.llm import decontamination
    monkeypatch.setattr(decontamination, "MAX_BROADCAST", 0)
    docs, items = table(spark, "documents"), table(spark, "benchmark")
    assert _judged(docs, items) == contaminated_plainly([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.collect()])


def test_only_the_rarest_shingle_is_joined(spark):
    windows = spark.createDataFrame([(0, [f"a{i}" for i in range(10)])], "wid long, words array<string>")
    text = " ".join(f"a{i}" for i in range(10))
    docs = spark.createDataFrame([(k, " ".join(f"a{i}" for i in range(5))) for k in range(5)] + [(9, text)], "doc_id long, text string")
    got = occurrences(docs, windows, 10, 5)
    assert [tuple(r)[2:] for r in got.where(F.col("doc_id") == 9).collect()] == [(0, 10, 0)] and got.count() == 1
