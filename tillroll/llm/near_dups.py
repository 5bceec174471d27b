"""Near-duplicate groups by a multi-index Hamming join over b-bit MinHash signatures.

A document's set is its distinct shingles of five words (ASCII lower case; all words as one shingle
where there are fewer).  Documents with 100 |A and B| >= 85 |A or B| are linked; a group is a connected
component, and its document with the smallest id stays.

1. One pass over the texts writes, to the shared folder, each document's set size, a digest of its
   word sequence, and a signature of 9 chunks of 5 symbols (16 bits of a MinHash each).
2. Documents of one word sequence have one set: they form a class, and its smallest id stands for it.
3. Two signatures that differ in at most 17 of the 45 symbols differ in at most one symbol of some
   chunk (pigeonhole: 9 x 2 > 17).  So every chunk is indexed five times, each time without one of its
   symbols, and all pairs within that distance meet under some key.  Most pairs further apart meet too: at
   similarity 0.85 the chance of meeting under no key is about 1 in 10 million; it falls quickly above.
4. Round one links each member of a key's bucket to the bucket's smallest id: as many pairs as
   members, however large the bucket.  Pairs far apart in size or signature are dropped (more than ``MAX_APART``
   differing symbols: less than 1 in a billion at 0.85), the others
   are confirmed on the full sets of the texts, and components are found by star contraction.
5. Round two takes the buckets that still hold several components.  Their members meet once for each
   smallest id (their home), in tiles of two blocks of a home.  A tile's task compares signatures of members
   of different components and keeps the members that have anyone near; for those it then gets the
   texts, confirms member by member, and skips pairs that are connected by then.  It returns links
   that join components and never holds more than one member's pairs.

Buckets are aggregated before they are joined and joins are left to adaptive skew splitting, so one key
may hold a large part of all rows.  No link, component or signature goes to the driver.

Defined results: null, empty and blank texts have 0 shingles and are linked with nothing.  Rows that
share an id count as one document.  A null id has component null and is kept.  Extra columns are
ignored, whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import staged, staged_few
from tillroll.llm.rows import map_slices

SHINGLE = 5
LINK_PCT = 85
CHUNKS, CHUNK_SYMBOLS = 9, 5
SYMBOLS = CHUNKS * CHUNK_SYMBOLS
MAX_DIFFERENT = 2 * CHUNKS - 1  # all pairs within this meet
MAX_APART = 24                  # pairs that met are confirmed up to this
BLOCK = 8192  # shingles hashed at once
KEPT_WORDS = 300_000
TILE_BLOCK = 1024  # members of a home in a block
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift, multiply, twice)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_TURNS = _mix(np.arange(1, SYMBOLS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
_PLACES = _mix(np.arange(101, 101 + SHINGLE, dtype=_U)) | _U(1)


class Shingler:
    """Texts to sorted arrays of distinct 64-bit shingle hashes."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def words(self, text: str) -> list[bytes]:
        return text.encode("utf-8", "replace").lower().split()  # bytes: ASCII case and white space only

    def shingles(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0, _U)
        if len(words) < SHINGLE:
            return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], _U)
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        for w in {w for w in words if w not in known}:
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), _U, len(words))
        m = len(h) - SHINGLE + 1
        total = h[:m] * _PLACES[0]
        for k in range(1, SHINGLE):
            total = total + _mix(h[k:k + m] * _PLACES[k])
        return np.unique(_mix(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """16-bit symbols, one for each permutation's smallest shingle."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, _U)
    for at in range(0, len(shingles), BLOCK):
        np.minimum(least, (shingles[at:at + BLOCK, None] * _TURNS).min(0), out=least)
    return (_mix(least) & _U(0xFFFF)).astype(_U)


def index_keys(signatures: np.ndarray) -> np.ndarray:
    """Rows of signatures to rows of index keys: each chunk without each of its symbols in turn."""
    keys = []
    for c in range(CHUNKS):
        chunk = signatures[:, c * CHUNK_SYMBOLS:(c + 1) * CHUNK_SYMBOLS]
        for j in range(CHUNK_SYMBOLS):
            rest = np.delete(chunk, j, 1)
            packed = np.zeros(len(rest), _U)
            for k in range(CHUNK_SYMBOLS - 1):
                packed = (packed << _U(16)) | rest[:, k]
            keys.append(_mix(packed ^ _mix(np.full(1, c * CHUNK_SYMBOLS + j + 1, _U))))
    return np.stack(keys, 1).view(np.int64)


def nibbles(signatures: np.ndarray) -> np.ndarray:
    """The symbols' low four bits, 16 to a word: three longs whose differing nibbles are counted in SQL."""
    low = signatures & _U(15)
    words = []
    for at in range(0, SYMBOLS, 16):
        w = np.zeros(len(low), _U)
        for k in range(at, min(at + 16, SYMBOLS)):
            w |= low[:, k] << _U(4 * (k - at))
        words.append(w)
    return np.stack(words, 1).view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_shingles, class, s0, s1, s2, keys) of every row; no class and no keys without a word."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def make():
        shingler = Shingler()

        def step(r):
            words = [shingler.words(t) for t in r["text"].to_pylist()]
            sets = [shingler.shingles(w) for w in words]
            sig = np.array([signature(s) for s in sets]).reshape(-1, SYMBOLS)
            keys, low = index_keys(sig), nibbles(sig)
            live = [len(s) > 0 for s in sets]
            return {"doc_id": r["doc_id"], "n_shingles": [len(s) for s in sets],
                    "class": [hashlib.blake2b(b" ".join(w), digest_size=16).digest() if w else None for w in words],
                    "s0": low[:, 0], "s1": low[:, 1], "s2": low[:, 2],
                    "keys": [k if ok else [] for k, ok in zip(keys, live)]}
        return step

    return map_slices(d, make, "doc_id long, n_shingles long, class binary, s0 long, s1 long, s2 long, keys array<long>")


def _different(x: str, y: str) -> Column:
    """How many nibbles differ: at most the number of differing symbols."""
    count = F.lit(0)
    for s in ("s0", "s1", "s2"):
        d = F.col(f"{x}.{s}").bitwiseXOR(F.col(f"{y}.{s}"))
        any_bit = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(any_bit, 2))
        count = count + F.bit_count(any_bit.bitwiseAND(F.lit(0x1111111111111111)))
    return count


def _near(x: str, y: str) -> Column:
    """What two linked sets cannot fail: sizes within 85 %, signatures not too far apart."""
    n, m = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
    return (100 * F.least(n, m) >= LINK_PCT * F.greatest(n, m)) & (_different(x, y) <= MAX_APART)


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts' full sets are linked."""
    # one plan at every size: texts are dealt by id once, and both joins read that
    texts = texts.hint("merge")
    both = (pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
            .select("a", "b", "text_a", "text_b"))

    def run(batches):
        import pyarrow as pa
        shingler, last, of_a = Shingler(), None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64).to_pydict()
                out = {"a": [], "b": []}
                for a, b, ta, tb in zip(part["a"], part["b"], part["text_a"], part["text_b"]):
                    if a != last:  # the join leaves rows of one a next to each other
                        last, of_a = a, shingler.shingles(shingler.words(ta or ""))
                    of_b = shingler.shingles(shingler.words(tb or ""))
                    shared = len(np.intersect1d(of_a, of_b, assume_unique=True))
                    if 100 * shared >= LINK_PCT * (len(of_a) + len(of_b) - shared) and shared:
                        out["a"].append(a)
                        out["b"].append(b)
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return both.mapInArrow(run, "a long, b long")


def _tiles(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of a tile next to each other, by id."""
    at = ["home", "i", "j"]
    return rows.select(*at, *columns).repartition(*at).sortWithinPartitions(*at, "id")


def _groups(batches, n_keys: int = 3):
    """Rows (dicts of lists) of one key after the other, over the borders of batches."""
    key, rows = None, None
    for batch in batches:
        names = batch.schema.names
        for at in range(0, batch.num_rows, 256):
            for row in zip(*batch.slice(at, 256).to_pydict().values()):
                if row[:n_keys] != key:
                    if rows:
                        yield key, dict(zip(names, map(list, zip(*rows))))
                    key, rows = row[:n_keys], []
                rows.append(row)
    if rows:
        yield key, dict(zip(names, map(list, zip(*rows))))


def _near_members(group: dict):
    """(x, later members y) of a tile for each x: those of other components that could be linked, nearest first.
    ``group["root"]`` is an array that the caller may change on the way."""
    low = np.array([group["s0"], group["s1"], group["s2"]], np.int64).view(_U).T
    size, root = np.array(group["n_shingles"]), group["root"]
    ones = _U(0x1111111111111111)
    for x in range(len(size) - 1):
        rest = slice(x + 1, None)
        y = np.flatnonzero((root[rest] != root[x]) & (100 * np.minimum(size[rest], size[x]) >= LINK_PCT * np.maximum(size[rest], size[x]))) + x + 1
        if len(y):
            d = low[y] ^ low[x]
            d |= d >> _U(1)
            d |= d >> _U(2)
            count = np.bitwise_count(d & ones).sum(1)
            order = np.argsort(count, kind="stable")
            yield x, y[order[:int((count <= MAX_APART).sum())]]


def members_near(rows: DataFrame) -> DataFrame:
    """The tiles' members that some member of another component is near to."""
    columns = ["id", "root", "n_shingles", "s0", "s1", "s2"]

    def run(batches):
        import pyarrow as pa
        for _, group in _groups(batches):
            root = group["root"] = np.array(group["root"])
            near = np.zeros(len(root), bool)
            for x, y in _near_members(group):
                near[y] = True
                near[x] |= len(y) > 0
            keep = np.flatnonzero(near).tolist()
            if keep:
                yield pa.RecordBatch.from_pydict({n: pa.array([v[k] for k in keep], pa.int32() if n in "ij" else pa.int64()) for n, v in group.items()})

    return _tiles(rows, columns).mapInArrow(run, "home long, i int, j int, " + ", ".join(f"{c} long" for c in columns))


def tile_links(rows: DataFrame) -> DataFrame:
    """Links (a, b) that join components of a tile's members, confirmed on the full sets."""
    def run(batches):
        import pyarrow as pa
        shingler = Shingler()
        for _, group in _groups(batches):
            root = group["root"] = np.array(group["root"])
            sets: dict[int, np.ndarray] = {}

            def set_of(k):
                if k not in sets:
                    sets[k] = shingler.shingles(shingler.words(group["text"][k] or ""))
                return sets[k]

            out = {"a": [], "b": []}
            for x, ys in _near_members(group):
                for y in ys.tolist():
                    if root[x] == root[y]:
                        continue
                    small, large = sorted((set_of(x), set_of(y)), key=len)
                    at = np.minimum(large.searchsorted(small), len(large) - 1)
                    shared = int(np.count_nonzero(large[at] == small)) if len(small) else 0
                    if shared and 100 * shared >= LINK_PCT * (len(small) + len(large) - shared):
                        root[root == max(root[x], root[y])] = min(root[x], root[y])
                        out["a"].append(group["id"][x])
                        out["b"].append(group["id"][y])
                sets.pop(x, None)  # no later member looks back
            if out["a"]:
                yield pa.RecordBatch.from_pydict(out)

    return _tiles(rows, ["id", "root", "n_shingles", "s0", "s1", "s2", "text"]).mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (a, b), root the smallest node of its component: large-star
    and small-star contraction until nothing changes; every step is a written table."""
    e = staged_few(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges", edges.count())
    before = None
    while True:
        mark = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x"))
            .select("x.u", "x.v").where("u <> v").distinct())
        e = staged_few(small, "edges", mark["n"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept); the groups are found at once."""
    all_rows = staged(signatures(docs, id_col, text_col), "signatures")
    classes = all_rows.where("class is not null and doc_id is not null").groupBy("class")
    # one document a class; the first aggregate carries what the index needs, the other stays narrow
    reps = staged_few(classes.agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"),
                                  F.first("s0").alias("s0"), F.first("s1").alias("s1"), F.first("s2").alias("s2")), "classes", all_rows.count(), 50_000)
    facts = reps.select("id", "n_shingles", "s0", "s1", "s2")
    # a class is indexed by the row of its smallest id: ids are spread evenly, classes may be large
    keys = (all_rows.select("doc_id", "keys").join(reps.select("id"), F.col("doc_id") == F.col("id"))
            .select("id", F.explode("keys").alias("key")))
    buckets = keys.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least <> most")
    meeting = staged(keys.join(buckets.select("key", "least"), "key").select("key", "id", "least"), "buckets")

    stars = meeting.where("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
    n_meeting = meeting.count()
    stars = staged_few(stars.join(facts.alias("x"), F.col("a") == F.col("x.id")).join(facts.alias("y"), F.col("b") == F.col("y.id"))
                       .where(_near("x", "y")).select("a", "b"), "stars", n_meeting)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    labels = components(staged(confirmed(stars, texts), "links"))

    placed = meeting.join(labels, meeting["id"] == labels["node"], "left").select(
        "key", "id", F.col("least").alias("home"), F.coalesce("root", "id").alias("root"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("key")
    members = staged_few(placed.join(mixed, "key", "left_semi").select("home", "id", "root").distinct(), "members", n_meeting)
    blocks = members.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / TILE_BLOCK).cast("int").alias("blocks"))
    dealt = members.join(blocks, "home").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "home", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "id", "root")
    near = members_near(dealt.join(facts, "id"))
    found = staged(tile_links(near.join(texts.withColumnRenamed("doc_id", "id").hint("merge"), "id")), "links")
    roots = labels.select(F.col("node").alias("id"), "root")
    joined = (found.join(roots.select(F.col("id").alias("a"), F.col("root").alias("ra")), "a", "left")
              .join(roots.select(F.col("id").alias("b"), F.col("root").alias("rb")), "b", "left")
              .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
    merged = components(staged_few(joined, "joined", found.count()))
    final = reps.select("class", "id").join(roots, "id", "left").select("class", F.coalesce("root", "id").alias("root1"))
    final = (final.join(merged, final["root1"] == merged["node"], "left")
             .select("class", F.coalesce("root", "root1").alias("component")))
    rows = all_rows.select("doc_id", "n_shingles", "class").join(final, "class", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"),
                       F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
