"""Ranked lexical search over bit-sliced Bloom signatures, with exact scores of all that they can't exclude.

Terms are maximal runs of digits, letters and non-ASCII characters, A-Z lower-cased.  With N documents with a
term, L their terms, n a document's terms, df and tf as usual, a term weighs w = floor(1000 ln((2N + 2) / (2 df + 1)));
a document's damping is m = 75 + (25 n N) div L, and its score for an item the sum of
w * ((10^9 tf) div (1000 tf + 12 m)) over the item's terms, repeats included, in 64-bit integers.

1. Index (one pass): documents with about as many entries share a block.  A block is a Bloom matrix of bit
   slices: slice b has a bit for each of its documents.  Each term enters with the steps of ``STEPS`` that its
   frequency reaches, so a signature bounds tf from above as well as showing presence.
2. df of the items' terms is counted exactly (a second pass; only counts are shuffled).
3. For a block of items, a term's slices are ANDed into a bitmap for each step: never too small.  The steps seen give
   the largest possible tf, the document's own m the largest possible gain, and the weighted sum of these bitmaps
   an upper bound for every document and item.
4. The documents of an item's largest bounds are scored exactly; the score of the TOP-th is its floor.
5. Every document whose bound reaches the floor is scored exactly from its text, and the best are ranked.  What is left out
   is proven to be worse than TOP others.

Items are taken in blocks of ``ITEM_BLOCK``, and their vocabulary in blocks of ``TERM_BLOCK`` terms, so that what a
worker is sent is bounded.  Documents are found again by a hash of id and text; equal hashes only add documents
that are then scored exactly.  The wanted pairs are broadcast
up to ``MAX_BROADCAST``; only beyond it are texts shuffled.

Defined results: null and empty texts, and texts without a term, are not counted and never found; items without a
term find nothing.  Each row is a document of its own, also where ids repeat; null ids come last among
equal scores.  Each row of the items is ranked for itself, also where its id is null or repeats.  Extra columns are
ignored, whatever their names.  Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import staged
from tillroll.llm.rows import map_slices

TOP = 20
HASHES = 5
BITS_PER_ENTRY = 20
STEPS = [1, 2, 3, 4, 6, 9, 14, 21, 32, 48, 72, 108, 162, 243, 365, 548, 822, 1233, 1850, 2775]
BLOCK_DOCS = 1024
BLOCK_BITS = 1 << 26   # 8 MB: long documents get smaller blocks
ITEM_BLOCK = 256
TERM_BLOCK = 500_000
CELLS = 1 << 21        # (term, document) cells of the bounds that a worker computes at once
MAX_BROADCAST = 1_000_000  # (document, item) pairs of 16 bytes
KNOWN_TERMS = 200_000  # hashes that a worker remembers
_U = np.uint64

#: Bytes to terms.  A-Z lower-cased; digits, letters and all bytes from 0x80 stay, the rest parts terms.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def steps_reached(tf: np.ndarray) -> np.ndarray:
    """How many of STEPS a frequency reaches."""
    return np.searchsorted(STEPS, tf, side="right")


def places(hashes: np.ndarray, step: np.ndarray, bits: int) -> np.ndarray:
    """(entries, HASHES) bit places of (term hash, step) entries."""
    x = hashes + (step.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    other = (x >> _U(17)) * _U(0xC2B2AE3D27D4EB4F) | _U(1)
    return ((x[:, None] + np.arange(HASHES, dtype=_U) * other[:, None]) % _U(bits)).astype(np.int64)


class Block:
    """Documents of one size class on their way into a Bloom matrix."""

    def __init__(self, bits: int):
        self.bits, self.room = bits, max(1, min(BLOCK_DOCS, BLOCK_BITS // bits))
        self.keys, self.sizes, self.entries, self.top = [], [], [], 0

    def add(self, key: int, size: int, hashes: np.ndarray, reached: np.ndarray) -> bool:
        step = np.arange(int(reached.sum())) - np.repeat(np.cumsum(reached) - reached, reached)
        self.entries.append(np.unique(places(np.repeat(hashes, reached), step, self.bits)).astype(np.int32 if self.bits < 1 << 31 else np.int64))
        self.keys.append(key)
        self.sizes.append(size)
        self.top = max(self.top, int(reached.max()))
        return len(self.keys) >= self.room

    def slices(self) -> bytes:
        """bits rows of ceil(docs / 8) bytes: bit d of slice b says that document d may hold b's entries."""
        width = (len(self.keys) + 7) // 8
        out = np.zeros(self.bits * width, np.uint8)
        for d, at in enumerate(self.entries):
            out[at.astype(np.int64) * width + (d >> 3)] |= np.uint8(128 >> (d & 7))
        return out.tobytes()


def build_index(docs: DataFrame) -> DataFrame:
    """Blocks (bits, steps, keys, sizes, slices) of documents (key, text binary); written by the caller."""
    def run(batches):
        import pyarrow as pa
        schema = pa.schema([("bits", pa.int64()), ("steps", pa.int32()), ("keys", pa.list_(pa.int64())),
                            ("sizes", pa.list_(pa.int64())), ("slices", pa.binary())])

        def row(b: Block):
            return pa.RecordBatch.from_pydict({"bits": [b.bits], "steps": [b.top], "keys": [b.keys], "sizes": [b.sizes], "slices": [b.slices()]}, schema=schema)

        open_blocks: dict[int, Block] = {}
        known: dict[bytes, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for key, text in zip(part.column(0).to_pylist(), part.column(1)):
                    terms = terms_of(text.as_py())
                    if not terms:
                        continue
                    counts = Counter(terms)
                    if len(known) > KNOWN_TERMS:
                        known.clear()
                    for t in [t for t in counts if t not in known]:
                        known[t] = xxhash.xxh64_intdigest(t)
                    hashes = np.fromiter(map(known.__getitem__, counts), _U, len(counts))
                    tf = np.fromiter(counts.values(), np.int64, len(counts))
                    reached = steps_reached(tf)
                    size_class = math.ceil(2 * math.log2(int(reached.sum()) + 8))  # a class spans half a doubling of entries
                    block = open_blocks.get(size_class)
                    if block is None:
                        block = open_blocks[size_class] = Block(64 * math.ceil(BITS_PER_ENTRY * 2 ** (size_class / 2) / 64))
                    if block.add(key, len(terms), hashes, reached):
                        yield row(open_blocks.pop(size_class))
        for block in open_blocks.values():
            yield row(block)

    return docs.mapInArrow(run, "bits long, steps int, keys array<long>, sizes array<long>, slices binary")


def document_frequencies(docs: DataFrame, terms: list[bytes]) -> dict[bytes, int]:
    """df of the terms (at most TERM_BLOCK of them, in each worker): counted in each task, then added up."""
    def run(batches):
        import pyarrow as pa
        wanted, counts = frozenset(terms), Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update(wanted.intersection(terms_of(text.as_py())))
        yield pa.RecordBatch.from_pydict({"term": pa.array(counts.keys(), pa.binary()), "n": pa.array(counts.values(), pa.int64())})

    parts = docs.select("text").mapInArrow(run, "term binary, n long")
    return {bytes(r["term"]): r["n"] for r in parts.groupBy("term").agg(F.sum("n").alias("n")).collect()}


def term_weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Items:
    """A block of items as plain arrays: each item's distinct terms with their repeats, the terms' hashes and weights.
    Terms that no document holds are left out."""

    def __init__(self, items: list[tuple[int, dict[bytes, int]]], df: dict[bytes, int], n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        at = {t: k for k, t in enumerate(sorted({t for _, terms in items for t in terms if t in df}))}
        self.weights = np.array([term_weight(df[t], n_docs) for t in at], np.int64)
        self.hashes = np.array([xxhash.xxh64_intdigest(t) for t in at], _U)
        self.at, self.numbers = at, [i for i, _ in items]
        self.terms = [np.array([at[t] for t in terms if t in at], np.int64) for _, terms in items]
        self.repeats = [np.array([q for t, q in terms.items() if t in at], np.int64) for _, terms in items]

    def damping(self, sizes: np.ndarray) -> np.ndarray:
        return np.array([75 + (25 * int(n) * self.n_docs) // self.n_terms for n in sizes], np.int64)

    def bounds(self, bits: int, steps: int, sizes: np.ndarray, slices: bytes) -> np.ndarray:
        """(items, documents): upper bounds of the scores."""
        matrix = np.frombuffer(slices, np.uint8).reshape(bits, -1)
        at = [places(self.hashes, np.full(len(self.hashes), s), bits) for s in range(steps)]
        width = max(1, CELLS // 8 // max(1, len(self.hashes)))  # bytes of documents at once
        return np.hstack([self._bounds(matrix[:, b:b + width], at, sizes[8 * b:8 * (b + width)]) for b in range(0, matrix.shape[1], width)])

    def _bounds(self, matrix: np.ndarray, at: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
        docs, steps = len(sizes), len(at)
        reached = np.zeros((len(self.hashes), docs), np.int8)
        alive = None
        for places_of_step in at:  # a step counts only where all below it were seen
            seen = np.bitwise_and.reduce(matrix[places_of_step], axis=1)
            alive = seen if alive is None else alive & seen
            if not alive.any():
                break
            reached += np.unpackbits(alive, axis=1, count=docs).view(np.int8)
        m = self.damping(sizes)
        largest = np.zeros((steps + 1, docs), np.int64)
        for s in range(1, steps + 1):
            tf = np.minimum(sizes, STEPS[s] - 1) if s < len(STEPS) else sizes
            largest[s] = (1_000_000_000 * tf) // (1000 * tf + 12 * m)
        gains = largest[reached, np.arange(docs)] * self.weights[:, None]
        return np.array([q @ gains[t] if len(t) else np.zeros(docs, np.int64) for t, q in zip(self.terms, self.repeats)])

    def score(self, k: int, counts: dict[bytes, int], names: list[bytes], m: int) -> int:
        """The exact score of an item for a document's term counts."""
        total = 0
        for t, q in zip(self.terms[k].tolist(), self.repeats[k].tolist()):
            tf = counts.get(names[t], 0)
            if tf:
                total += q * int(self.weights[t]) * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
        return total


def _block_arrays(batch, row: int):
    value = {n: batch.column(i)[row] for i, n in enumerate(batch.schema.names)}
    return (value["bits"].as_py(), value["steps"].as_py(), value["keys"].values.to_numpy(), value["sizes"].values.to_numpy(),
            value["slices"].as_buffer())


def largest_bounds(index: DataFrame, items: Items) -> DataFrame:
    """(item, key, bound): a task's TOP documents by bound for each item."""
    def run(batches):
        import pyarrow as pa
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in items.numbers]
        for batch in batches:
            for row in range(batch.num_rows):
                bits, steps, keys, sizes, slices = _block_arrays(batch, row)
                for k, bound in enumerate(items.bounds(bits, steps, sizes, slices)):
                    b, key = np.concatenate([best[k][0], bound]), np.concatenate([best[k][1], keys])
                    top = np.argpartition(-b, TOP)[:TOP] if len(b) > TOP else np.arange(len(b))
                    best[k] = b[top], key[top]
        for number, (b, key) in zip(items.numbers, best):
            some = b > 0
            yield pa.RecordBatch.from_pydict({"item": pa.array(np.full(int(some.sum()), number), pa.int64()), "key": key[some], "bound": b[some]})

    return index.mapInArrow(run, "item long, key long, bound long")


def not_excluded(index: DataFrame, items: Items, floors: dict[int, int]) -> DataFrame:
    """(key, item): every document whose bound reaches the item's floor."""
    least = np.array([max(1, floors.get(i, 1)) for i in items.numbers])

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for row in range(batch.num_rows):
                bits, steps, keys, sizes, slices = _block_arrays(batch, row)
                k, d = np.nonzero(items.bounds(bits, steps, sizes, slices) >= least[:, None])
                if len(k):
                    yield pa.RecordBatch.from_pydict({"key": keys[d], "item": pa.array(np.array(items.numbers)[k], pa.int64())})

    return index.mapInArrow(run, "key long, item long")


def exact_scores(docs: DataFrame, wanted: DataFrame, items: Items) -> DataFrame:
    """(item, doc_id, score) of the wanted (key, item) pairs, from the documents' whole texts."""
    per_doc = wanted.groupBy("key").agg(F.collect_set("item").alias("items"))  # an item block at most
    per_doc = F.broadcast(per_doc) if wanted.count() <= MAX_BROADCAST else per_doc.hint("merge")
    rows = docs.join(per_doc, "key").select("doc_id", "text", "items")
    schema = "item long, doc_id long, score long"

    def make():
        names, where = list(items.at), {i: k for k, i in enumerate(items.numbers)}

        def step(r):
            out = {"item": [], "doc_id": [], "score": []}
            for doc_id, text, some in zip(r["doc_id"].to_pylist(), r["text"], r["items"].to_pylist()):
                terms = terms_of(text.as_py())
                counts, m = Counter(terms), int(items.damping([len(terms)])[0])
                scores = [items.score(where[i], counts, names, m) for i in some]
                out["item"] += some
                out["doc_id"] += [doc_id] * len(some)
                out["score"] += scores
            return out
        return step

    return map_slices(rows, make, schema, 64)


def best_of(scores: DataFrame) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scores.where("score > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)


def search_block(docs: DataFrame, index: DataFrame, items: Items) -> DataFrame:
    """(item, rank, doc_id, score) of a block of items; runs all but the last step."""
    bounds = largest_bounds(index, items)
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "key")
    likely = staged(bounds.withColumn("place", F.row_number().over(order)).where(F.col("place") <= TOP).select("key", "item"), "likely")
    floors = {r["item"]: r["score"] for r in best_of(exact_scores(docs, likely, items)).where(F.col("rank") == TOP).collect()}  # a row an item
    return best_of(exact_scores(docs, staged(not_excluded(index, items, floors), "candidates"), items))


def ranked(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text") -> DataFrame:
    """Rows (item_id, rank, doc_id, score): each item's TOP documents with a score above 0; runs at once."""
    body = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.xxhash64(F.col(id_col).cast("long"), body).alias("key"), F.col(id_col).cast("long").alias("doc_id"), body.cast("binary").alias("text"))
    index = staged(build_index(d.select("key", "text")), "signatures")
    corpus = index.select(F.size("sizes").alias("n"), F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("terms")).agg(
        F.sum("n").alias("n"), F.sum("terms").alias("terms")).first()
    asked = staged(benchmark.select(F.monotonically_increasing_id().alias("item"), F.col(item_col).alias("item_id"),
                                    F.coalesce(F.col(item_text_col), F.lit("")).cast("binary").alias("text")), "items")

    def item_terms(r):
        counts = [Counter(terms_of(t.as_py())) for t in r["text"]]
        return {"item": r["item"], "terms": [list(c) for c in counts], "repeats": [list(c.values()) for c in counts]}

    terms = staged(map_slices(asked.select("item", "text"), lambda: item_terms, "item long, terms array<binary>, repeats array<long>"), "item-terms")
    vocabulary = terms.select(F.explode("terms").alias("t")).distinct()
    df: dict[bytes, int] = {}
    block: list[bytes] = []
    for r in vocabulary.toLocalIterator():
        block.append(bytes(r["t"]))
        if len(block) == TERM_BLOCK:
            df |= document_frequencies(d, block)
            block = []
    if block:
        df |= document_frequencies(d, block)
    numbers = sorted(r["item"] for r in terms.where(F.size("terms") > 0).select("item").collect())
    found = None
    for at in range(0, len(numbers), ITEM_BLOCK) if corpus["n"] else ():
        some = numbers[at:at + ITEM_BLOCK]
        rows = terms.where(F.col("item").between(some[0], some[-1]) & (F.size("terms") > 0)).orderBy("item").collect()
        items = Items([(r["item"], dict(zip(map(bytes, r["terms"]), r["repeats"]))) for r in rows], df, corpus["n"], corpus["terms"])
        part = staged(search_block(d, index, items), "ranked")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return asked.where("false").select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    return found.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
