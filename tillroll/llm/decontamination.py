"""Benchmark decontamination: a prefix-filtered set join of item windows with documents, in DataFrame functions.

A window is ``WINDOW`` consecutive words of an item (all its words where it has fewer), and its tokens are
its shingles of ``SHINGLE`` words (the whole window, where it is shorter).  A document holds a window where
all of the window's shingles stand in the document at the window's offsets.

1. One pass over the texts: every position whose shingle is one of the benchmark's is written with its
   shingle's hash, its place, the document's length and the words around it.
2. The written positions give each shingle's frequency.  A window's shingles are ordered by rarity; as all of
   them are wanted, the rarest alone is the necessary prefix (a shingle that never occurs drops its window).
3. Prefix shingles are joined with the positions.  The shingle's offset gives the window's place; places
   before the document's start or beyond its length are dropped (position and length bounds).
4. What is left is verified on the words themselves: the item-sized window of the document equals the item's.

The benchmark's shingles are counted first: up to ``MAX_BROADCAST`` distinct ones are broadcast, more are joined
by shuffling positions.  Texts are never shuffled.

Defined results: null, empty and wordless texts have 0 words and are hit by nothing.  Items without words
occur nowhere; a null item id hits words but is not counted or listed.  Rows that repeat an id are judged
each by its own text.  Repeated items count once an id.  Extra columns are ignored, whatever their names.
Empty tables give an empty result, or documents without hits.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import staged

#: What stands between words, as a regular expression.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

WINDOW = 10
SHINGLE = 5
MAX_BROADCAST = 200_000  # shingles or windows; a window takes about 150 bytes


def lower_words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; null has none."""
    return words(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column) -> Column:
    """Splitting is many times faster here than extracting matches; a text that begins or ends between words gives empty parts."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def shingle_hash(words: Column, at: Column, size: int) -> Column:
    """A hash of ``size`` words from the 0-based place ``at``."""
    return F.xxhash64(F.lit(size), *[F.get(words, at + k) for k in range(size)])


def item_windows(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(item_id, words) of every window of every item."""
    items = benchmark.select(F.col(item_col).alias("item_id"), lower_words(F.col(text_col)).alias("all_words")).where(F.size("all_words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("all_words") - (window - 1)))
    return (items.withColumn("at", F.explode(starts))
            .select("item_id", F.slice("all_words", F.col("at"), F.lit(window)).alias("words")))


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """(wid, words, size, offset, key) of each window's shingles."""
    size = F.least(F.size("words"), F.lit(shingle))
    places = windows.select("wid", "words", size.alias("size"), F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("offset"))
    key = F.when(F.col("size") == shingle, shingle_hash(F.col("words"), F.col("offset"), shingle))
    for s in range(1, shingle):
        key = key.when(F.col("size") == s, shingle_hash(F.col("words"), F.col("offset"), s))
    return places.withColumn("key", key)


def _looked_up(rows: DataFrame, table: DataFrame, n: int) -> DataFrame:
    """Join on key; the table is broadcast only if its counted rows are few."""
    return rows.join(F.broadcast(table) if n <= MAX_BROADCAST else table.hint("merge"), "key")


def shingle_positions(docs: DataFrame, keys: DataFrame, n_keys: int, sizes: list[int], window: int, shingle: int) -> DataFrame:
    """(doc_id, digest, n_words, pos, key, from, around): the documents' places whose shingle is one of ``keys``."""
    w, pos = F.col("w"), F.col("pos")
    texts = docs.select("doc_id", F.xxhash64("text").alias("digest"), lower_words(F.col("text")).alias("w"))
    places = texts.select("doc_id", "digest", "w", F.explode(F.sequence(F.lit(0), F.size("w") - 1)).alias("pos")).where((pos >= 0) & (pos < F.size("w")))
    found = [F.when(pos + s <= F.size("w"), shingle_hash(w, pos, s)) for s in sizes]
    keyed = places.withColumn("key", found[0] if len(sizes) == 1 else F.explode(F.array(*found))).where("key is not null")
    first = F.greatest(F.lit(0), pos - (window - shingle))
    return _looked_up(keyed, keys, n_keys).select(
        "doc_id", "digest", F.size("w").alias("n_words"), "pos", "key", first.alias("from"),
        F.slice(w, first + 1, F.lit(2 * window - shingle)).alias("around"))


def occurrences(docs: DataFrame, windows: DataFrame, window: int, shingle: int) -> DataFrame:
    """(doc_id, digest, start, size, wid): where the windows occur, verified on the words.  ``windows`` is a written
    table (wid, words); ``docs`` has doc_id and text."""
    shingles = staged(window_shingles(windows, shingle), "shingles")
    keys = staged(shingles.select("key").distinct(), "shingle-keys")
    sizes = sorted(r["size"] for r in shingles.select("size").distinct().collect())  # SHINGLE values at most
    n_keys = keys.count()
    found = staged(shingle_positions(docs, keys, n_keys, sizes or [shingle], window, shingle), "positions")
    frequency = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    rarest = F.min_by(F.struct("key", "offset"), F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset"))
    prefix = (shingles.join(frequency, "key", "left").groupBy("wid", "words")
              .agg(rarest.alias("p"), F.min(F.coalesce("n", F.lit(0))).alias("least"))
              .where("least > 0").select("wid", "words", "p.key", "p.offset"))
    prefix = staged(prefix, "prefix")
    at = F.col("pos") - F.col("offset")
    size = F.size("words")
    inside = (at >= 0) & (at + size <= F.col("n_words"))
    same = F.slice("around", F.greatest(F.lit(1), at - F.col("from") + 1), size) == F.col("words")
    return (_looked_up(found, prefix, prefix.count()).where(inside).where(same)
            .select("doc_id", "digest", at.alias("start"), size.alias("size"), "wid"))


def covered_words(hits: DataFrame) -> DataFrame:
    """(doc_id, digest, n_hit): words inside at least one occurrence."""
    spans = hits.groupBy("doc_id", "digest", "start").agg(F.max("size").alias("size"))
    end = F.col("start") + F.col("size")
    earlier = Window.partitionBy("doc_id", "digest").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)  # one text's words
    fresh = spans.withColumn("reached", F.coalesce(F.max(end).over(earlier), F.lit(0)))
    return fresh.groupBy("doc_id", "digest").agg(F.sum(F.greatest(F.lit(0), end - F.greatest("start", "reached"))).alias("n_hit"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Rows (doc_id, n_words, n_hit, items array<string> sorted, contaminated), one for each row of ``docs``; the items'
    side runs at once."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = staged(item_windows(benchmark, item_col, item_text_col, window), "item-windows")
    windows = staged(pieces.select("words").distinct().withColumn("wid", F.monotonically_increasing_id()), "windows")
    hits = staged(occurrences(d, windows, window, shingle), "occurrences")
    owners = pieces.where("item_id is not null").join(windows, "words").select("wid", "item_id").distinct()
    items = (hits.select("doc_id", "digest", "wid").distinct().join(owners, "wid").select("doc_id", "digest", F.col("item_id").cast("string").alias("item"))
             .groupBy("doc_id", "digest").agg(F.sort_array(F.collect_set("item")).alias("items")))
    hit, listed = covered_words(hits).alias("h"), items.alias("i")
    per_text = hit.join(listed, F.col("h.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("h.digest") == F.col("i.digest")), "left").select(
        F.col("h.doc_id").alias("of_doc"), F.col("h.digest").alias("of_digest"), "n_hit", "items")
    counted = d.select("doc_id", F.xxhash64("text").alias("digest"),
                       F.size(words(F.col("text"))).cast("long").alias("n_words"))
    out = counted.join(per_text, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("digest") == F.col("of_digest")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      (n_hit > 0).alias("contaminated"))


def with_digests(rows: DataFrame) -> DataFrame:
    """The items as their number and the SHA-256 of their comma-joined ids."""
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
