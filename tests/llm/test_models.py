"""Quality, toxicity and language: held-out accuracy, odd rows, no leaks."""

import zlib

import numpy as np
from brute import DOCS, docs_frame, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.llm import ftrl, language, quality_model, toxicity

SF01 = "/root/testdata/sf0.01"


def _read(spark, name):
    return spark.read.parquet(f"{SF01}/{name}.parquet")


def _held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def _auc(pairs):
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


def test_quality_on_held_out_rows(spark):
    labels = _read(spark, "labels")
    got = quality_model.quality_scores(_read(spark, "documents"), labels).join(labels, "doc_id").collect()
    assert all(r.held_out == _held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [(r.score, r.quality) for r in got if r.held_out]
    assert _auc(held) > 0.97 and np.mean([(s >= 0.7) == y for s, y in held]) > 0.95


def test_quality_learns_nothing_from_held_out_labels(spark):
    docs, labels = _read(spark, "documents").limit(300), _read(spark, "labels")
    wrong = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality"))
                              .otherwise(F.col("quality")).cast("int"))
    a, b = (sorted((r.doc_id, round(r.score, 9)) for r in quality_model.quality_scores(docs, x).collect()) for x in (labels, wrong))
    assert a == b


def test_models_on_odd_rows(spark):
    df = docs_frame(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (5, None, None), (6, 7, 7), (999, 1, 1)], "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    for x in (labels, none):
        for model in (quality_model.quality_scores, toxicity.toxicity_scores):
            got = model(df, x).collect()
            assert len(got) == len(DOCS) and all(0 <= r.score <= 1 for r in got)
            assert model(empty_docs(spark), x).count() == 0
    assert {r.score for r in quality_model.quality_scores(df, none).collect()} == {0.5}


def test_rising_map_is_monotone_and_smoothed():
    xs, ys = quality_model.rising_map([(0.1, 0, 10), (0.2, 5, 10), (0.3, 3, 10), (0.9, 10, 10)])
    assert (np.diff(ys) >= 0).all() and 0 < ys[0] < ys[-1] < 1 and len(xs) == 3


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(0, 5), st.integers(5, 9)), min_size=1, max_size=30))
def test_rising_map_never_falls(bins):
    assert (np.diff(quality_model.rising_map(bins)[1]) >= 0).all()


def test_toxicity_on_labelled_rows(spark):
    labels = _read(spark, "labels")
    got = toxicity.toxicity_scores(_read(spark, "documents"), labels).join(labels, "doc_id").collect()
    assert all(r.held_out == _held(r.doc_id) and 0 <= r.score <= 1 for r in got)
    clean = [r.predicted for r in got if r.held_out and not r.toxic]
    assert np.mean(clean) < 0.03 and _auc([(r.score, r.toxic) for r in got if r.held_out]) > 0.7


def test_label_model_finds_rates_and_correlated_voters():
    rng = np.random.default_rng(4)
    n, share = 60_000, 0.1
    y = rng.random(n) < share
    toxic, clean = np.array([.7, .6, .5, .8, .4, .65]), np.array([.01, .05, .02, .1, .03, .01])
    x = rng.random((n, 6)) < np.where(y[:, None], toxic, clean)
    x = np.hstack([x, x[:, :1]])            # a copy of the first voter
    joint = x.T.astype(float) @ x
    p, q, weight = toxicity.label_model(np.diag(joint).copy(), joint, n, share)
    assert np.abs(p[:6] - toxic).max() < 0.08 and np.abs(q[:6] - clean).max() < 0.02
    assert weight[0] <= 0.5 and weight[6] <= 0.5 and weight[3] == 1


def test_toxic_words_and_stems():
    v = toxicity.Voters(["lowe*"])
    names = toxicity.voter_names()
    fired = lambda t: {n for i, n in enumerate(names) if v.votes(t) >> i & 1}
    assert fired("You are such an idiot") == {"wits", "address", "intensified"}
    assert fired("ein loweischaft hier") & {f"learned{i}" for i in range(4)} and not fired("a kind and helpful text")
    assert fired("shut up now") == {"command"} and fired("what an id1ot") == {"disguised"} and not fired("")


def test_language_on_held_out_rows(spark):
    docs = _read(spark, "documents")
    got = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == _held(r.doc_id) for r in got) and np.mean([r.lang == r.lang_pred for r in held]) > 0.97


def test_language_on_odd_rows(spark):
    rows = [(i, "the and of with " * 5) for i in range(40, 60)] + [(i, "der die und mit " * 5) for i in range(60, 80)]
    df = docs_frame(spark, DOCS + rows + [(90, "12 34 !!"), (91, "² ½ Ⅷ")]).withColumn(
        "lang", F.when(F.col("doc_id") >= 60, "de").when(F.col("doc_id") >= 40, "en").when(F.col("doc_id") == 1, "").otherwise(None))
    got = {r.doc_id: r for r in language.languages(df).where("doc_id is not null").collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (2, 3, 4, 90, 91))
    assert all(got[i].lang_pred == ("de" if i >= 60 else "en") for i in range(40, 80))
    nothing = language.languages(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert len(nothing) == len(DOCS) + 42 and {r.lang_pred for r in nothing} == {"und"}
    assert language.languages(empty_docs(spark)).count() == 0


def test_ftrl_separates_and_drops_noise(spark):
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(800):
        y = int(rng.random() < 0.5)
        idx = sorted({0, 1 + y, *rng.integers(10, 60, 5).tolist()})
        rows.append((idx, [1.0] * len(idx), [float(y)]))
    df = spark.createDataFrame(rows, "idx array<int>, val array<float>, target array<float>")
    w = ftrl.train(df, ftrl.Ftrl(1, 64, alpha=0.5, l1=1.0, l2=0.1), 3)[0]
    assert w[2] > 1 > -1 > w[1] and (w[10:60] == 0).mean() > 0.5


# ---- bounds of what is fitted on, where ids are null or repeat -----------------------------------------------------

def _odd_ids(n=3000):
    """A third of the ids null, a third one id (of fold 0 or 1), the rest distinct; all texts differ."""
    hot = next(i for i in range(1000, 1100) if not _held(i))
    return [((None, hot, 5000 + i)[i % 3], f"text {i} " + ("the and of with " if i % 2 else "der die und mit ") * (5 + i % 40)) for i in range(n)]


def test_bounded_samples_choose_rows_not_ids(spark):
    from tillroll.llm.common import bounded_sample, hash_limit
    df = spark.createDataFrame(_odd_ids(), "doc_id long, text string")
    got = bounded_sample(df, F.lit(hash_limit(600, 3000)), "doc_id", "text").collect()
    kinds = [sum(r.doc_id is None for r in got), sum(r.doc_id is not None and r.doc_id < 5000 for r in got)]
    assert 350 < len(got) <= 600 and all(100 < k < 240 for k in kinds) and len({r.h for r in got}) == len(got)
    assert bounded_sample(df, F.lit(hash_limit(3000, 3000)), "doc_id", "text").count() == 3000
    same = spark.createDataFrame([(None, "one text")] * 500 + [(1, "another")], "doc_id long, text string")
    assert bounded_sample(same, F.lit(hash_limit(501, 501)), "doc_id", "text").count() == 2


def test_language_training_rows_keep_their_bound(spark):
    rows = _odd_ids()
    df = spark.createDataFrame([(i, t, "en" if " the " in t else "de") for i, t in rows], "doc_id long, text string, lang string")
    learnable = [t for i, t in rows if i is None or not _held(i)]
    sizes = {"en": sum(" the " in t for t in learnable), "de": sum(" der " in t for t in learnable)}
    fit = language.training_rows(df, ["de", "en"], sizes, 300, np.ones(language.WIDTH)).collect()
    each = [sum(r.target[k] for r in fit) for k in (0, 1)]
    assert all(150 < n <= 300 for n in each)
    got = language.languages(df, per_language=200).collect()
    assert len(got) == 3000 and np.mean([(r.lang_pred == "de") == (" der " in t) for r, t in zip(got, [x.text for x in df.collect()])]) > 0.99


def test_quality_labels_of_repeated_ids(spark):
    rows = _odd_ids(900)
    hot = rows[1][0]
    stats = quality_model.with_stats(spark.createDataFrame(rows, "doc_id long, text string"))
    labels = spark.createDataFrame([(hot, 1), (hot, 1), (hot, 0), (None, 1)] + [(i, i % 2) for i, _ in rows if i and i >= 5000], "doc_id long, quality int")
    fit = quality_model.labelled(stats, labels, "quality", 200).collect()
    assert 30 < len(fit) <= 200 and {r.fold for r in fit} <= {0, 1, 3}  # equal statistics count once
    everything = quality_model.labelled(stats, labels, "quality", 10 ** 6).collect()
    texts = {tuple(r.stats) for r in stats.where(F.col("doc_id") == hot).collect()}
    known = sum(1 for i, _ in rows if i and i >= 5000 and not _held(i))
    assert len(everything) <= 2 * len(texts) + known


def test_toxicity_with_null_and_repeated_ids(spark):
    rows = [(i, t + (" you stupid worthless idiot" if k % 10 == 0 else "")) for k, (i, t) in enumerate(_odd_ids(900))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int("idiot" in t)) for i, t in rows if i and i >= 5000] + [(rows[1][0], 0)] * 3, "doc_id long, toxic int")
    got = toxicity.toxicity_scores(docs, labels, max_labelled_rows=150, max_train_rows=200).collect()
    assert len(got) == 900 and np.mean([r.predicted == int("idiot" in t) for r, (_, t) in zip(got, rows)]) > 0.95
