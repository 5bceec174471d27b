"""Line quality rules and Pfair mixing against plain Python."""

import random

from brute import DOCS, base_rule, cleaned, docs_frame, empty_docs, table
from pyspark.sql import functions as F

from tillroll.llm.mixing import in_mixed_order, mix_sources, one_period, whole_shares
from tillroll.llm.quality_rules import cleaned_documents, quality_rules


def _check(df):
    got = quality_rules(df).collect()
    texts = [r.text for r in df.select("text").collect()]
    assert len(got) == len(texts)
    for r, t in zip(got, texts):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_rule(t)
        assert (r.kept, r.cleaned) == cleaned(t)


def test_rules_equal_brute_force(spark):
    _check(table(spark, "documents").coalesce(1).orderBy("doc_id"))


def test_rules_on_odd_rows(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice("ab cd ab, e| ! A!! #x\n . |".split(" ")) for _ in range(rnd.randint(0, 120)))) for i in range(60)]
    rows += [(100, "Read more\n" * 3 + "word " * 60 + "."), (101, "x | y | z\n" * 40 + "Real text here. " * 20)]
    _check(docs_frame(spark, DOCS + rows).coalesce(1))
    assert quality_rules(empty_docs(spark)).count() == 0


def test_cleaned_documents_keep_columns(spark):
    rows = [(1, "Some words that go on and on. " + " ".join(f"w{i}" for i in range(60)) + ".\nHome | News | About"), (2, "too short")]
    out = cleaned_documents(docs_frame(spark, rows)).collect()
    assert [r.doc_id for r in out] == [1] and "Home" not in out[0].text and out[0].n_words == -1 and out[0].kept is True


def _deviation(rows):
    slots = {}
    for r in rows:
        slots.setdefault(r.source, (r.source_share / r.period_slots, set()))[1].add(r.slot)
    end = min(max(s) for _, s in slots.values())
    return max(abs(sum(x < t for x in s) - t * share) for share, s in slots.values() for t in range(end + 2))


def test_mix_is_whole_and_within_a_block(spark):
    docs = table(spark, "documents")
    rows = mix_sources(docs, block_docs=2).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(rows))) and len({(r.slot, r.in_block) for r in rows}) == len(rows)
    assert _deviation(rows) < 1
    by_slot = {}
    for r in rows:
        by_slot.setdefault(r.slot, set()).add((r.source, r.block))
    assert all(len(x) == 1 for x in by_slot.values())


def test_mix_with_given_weights_null_sources_and_ties(spark):
    df = spark.createDataFrame([(i if i % 50 else None, f"t{i % 7}", [None, "a", "b", "c"][min(3, i % 10)]) for i in range(400)],
                               "doc_id long, text string, source string")
    weights = spark.createDataFrame([("a", 5), ("b", 1), (None, 3), ("a", 1)], "source string, weight long")
    rows = mix_sources(df, weights, block_docs=3).collect()   # "c" has no weight: one slot a period
    assert len(rows) == 400 and _deviation(rows) < 1
    share = {r.source: r.source_share for r in rows}
    assert share["c"] == 1 and share["a"] > share[None] > share["b"] and sum(share.values()) == rows[0].period_slots
    again = mix_sources(df.repartition(3), weights, block_docs=3).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert mix_sources(df.limit(0)).count() == 0 and mix_sources(docs_frame(spark)).count() == len(DOCS)


def test_every_block_meets_its_window(spark):
    weights = spark.createDataFrame([(f"s{i}", w) for i, w in enumerate((1, 1, 2, 3, 50, 400, 7))], "source string, weight long")
    rows = one_period(whole_shares(weights)).collect()
    assert sorted(r.slot for r in rows) == list(range(1024))
    for r in rows:
        assert (r.j - 1) * r.period // r.q <= r.slot < -(-r.j * r.period // r.q)


def test_mixed_order_in_files(spark):
    rows = in_mixed_order(mix_sources(table(spark, "documents"))).withColumn("part", F.spark_partition_id()).collect()
    order = [(r.part, r.slot, r.in_block) for r in rows]
    assert [x[1:] for x in sorted(order)] == sorted(x[1:] for x in order)


def test_mixing_with_any_column_names(spark):
    rows = [(i, f"s{i % 3}", i, "x", 5, 6, 7, 8) for i in range(200)]
    names = ["doc_id", "source", "q", "period", "src", "rank", "row", "a.b"]
    docs = spark.createDataFrame(rows, names)
    out = mix_sources(docs)
    assert out.columns[:8] == names and out.dtypes[:8] == docs.dtypes
    assert sorted(tuple(r)[:8] for r in out.collect()) == sorted(rows)
    plain = {r.doc_id: (r.slot, r.in_block) for r in mix_sources(docs.select("doc_id", "source")).collect()}
    assert {r.doc_id: (r.slot, r.in_block) for r in out.collect()} == plain
