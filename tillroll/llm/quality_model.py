"""Quality classifier: random Fourier features over document statistics, ridge regression from
partition-summed normal equations, isotonic calibration.

1. One pass over the texts writes about 20 statistics a document to the shared folder.
2. Labelled rows outside the held-out fold are joined to them by id (no text moves).  Folds 0 and 1
   fit, fold 3 calibrates.  At most ``MAX_FIT_ROWS`` labelled rows are used, chosen by a hash of id and statistics.
3. Standardised statistics go through fixed random cosines (a Gaussian kernel's features); each
   partition sums its normal equations, and at most ``FIT_PARTITIONS`` such sums reach the driver.
4. Raw scores of the calibration rows are counted in 400 bins; pooled adjacent violators make the
   rising map from raw score to probability.
5. Every document's statistics are scored (no second pass over the texts).

Defined results: null and empty texts have all-zero statistics and are scored like any other.
Labels other than 0 and 1, and labels of unknown ids, are ignored; an id that repeats is used once for
each of its different texts and labels.  Without labels of both kinds every score is their share (0.5 for none).
Null ids belong to fold 0.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import HELD_OUT, bounded_sample, fold_of, hash_limit, staged
from tillroll.llm.rows import SLICE_ROWS, map_slices

MAX_FIT_ROWS = 200_000
FIT_PARTITIONS = 32
FEATURES = 256
KERNEL_WIDTH = 3.0   # of the Gaussian kernel, in standard deviations
RIDGE = 1e-3         # per row
BINS = 400
THRESHOLD = 0.7
SEED = 20240611


def document_stats(text: str) -> list[float]:
    """Shape of a text: lengths, repetition, letter case, symbols, punctuation, lines."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * 20
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    chars = len(code)
    upper = int((((code >= 65) & (code <= 90)) | ((code >= 0xC0) & (code <= 0xDE) & (code != 0xD7))).sum())
    digits = int(((code >= 48) & (code <= 57)).sum())
    ascii_marks = int((((code >= 33) & (code <= 47)) | ((code >= 58) & (code <= 64)) | ((code >= 91) & (code <= 96))
                       | ((code >= 123) & (code <= 126))).sum())
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    counts = Counter(words)
    sizes = np.fromiter(map(len, words), np.float64, n)
    lines = [x for x in text.split("\n") if x.strip()]
    closed = sum(x.rstrip()[-1] in ".!?…\"')" for x in lines)
    return [
        np.log1p(n), np.log1p(chars), float(sizes.mean()), float(sizes.std()), len(counts) / n,
        max(counts.values()) / n, sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - len(set(zip(words, words[1:], words[2:]))) / max(1, n - 2) if n > 2 else 0.0,
        upper / chars, digits / chars, ascii_marks / chars, symbols / n,
        text.count("!") / n, text.count("|") / n, (text.count(".") + text.count("?")) / n, text.count(",") / n,
        closed / len(lines), np.log1p(n / len(lines)), 1 - len(set(lines)) / len(lines),
        sum(w.isupper() for w in words if len(w) > 1) / n]


def with_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return map_slices(d, lambda: lambda rows: {
        "doc_id": rows["doc_id"], "stats": [document_stats(t) for t in rows["text"].to_pylist()]},
        "doc_id long, stats array<float>")


def labelled(stats: DataFrame, labels: DataFrame, label_col: str, max_rows: int) -> DataFrame:
    """Rows (fold, y, stats) of labelled documents outside the held-out fold, at most ``max_rows`` joined rows; documents and
    labels that repeat count once."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where(
        F.col("y").isin(0, 1) & (fold_of(F.col("doc_id")) != HELD_OUT)).distinct()
    joined = stats.select("doc_id", "stats").join(known, "doc_id")
    chosen = bounded_sample(joined, F.lit(hash_limit(max_rows, joined.count())), "doc_id", "y", "stats")
    return chosen.select(fold_of(F.col("doc_id")).alias("fold"), "y", "stats")


class Ridge:
    """Standardisation, random cosines and ridge weights; plain arrays."""

    def __init__(self, mean: np.ndarray, std: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.std, self.weights = mean, std, None
        self.turn = rng.standard_normal((len(mean), FEATURES)) / KERNEL_WIDTH
        self.shift = rng.uniform(0, 2 * np.pi, FEATURES)

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.std, -6, 6)
        return np.hstack([np.cos(x @ self.turn + self.shift) * np.sqrt(2 / FEATURES), np.ones((len(x), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights


def _matrix(column) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64).reshape(len(column), -1)


def _partial_sums(rows: DataFrame, sums) -> list[np.ndarray]:
    """``sums(batch) -> arrays`` added up in each partition, then over the at most FIT_PARTITIONS of them."""
    def run(batches):
        import pyarrow as pa
        total = None
        for b in batches:
            if b.num_rows:
                part = sums(b)
                total = part if total is None else [x + y for x, y in zip(total, part)]
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": [[x.tobytes() for x in total]], "shapes": [[list(x.shape) for x in total]]})

    got = rows.mapInArrow(run, "sums array<binary>, shapes array<array<long>>").collect()
    if not got:
        return []
    out = [[np.frombuffer(s).reshape(sh) for s, sh in zip(r["sums"], r["shapes"])] for r in got]
    return [sum(parts) for parts in zip(*out)]


def fit_ridge(rows: DataFrame) -> tuple[Ridge | None, float]:
    """The model of rows (y, stats) and the share of ones; no model without both labels."""
    def moments(b):
        x, y = _matrix(b.column("stats")), np.array(b.column("y").to_pylist(), float)
        return [np.array([float(len(y)), y.sum()]), x.sum(0), (x * x).sum(0)]

    got = _partial_sums(rows, moments)
    if not got:
        return None, 0.5
    (n, ones), s, ss = got
    if ones in (0, n):
        return None, float(ones / n)
    mean = s / n
    model = Ridge(mean, np.sqrt(np.maximum(ss / n - mean * mean, 1e-12)) + 1e-6)

    def normal(b):
        z, y = model.features(_matrix(b.column("stats"))), np.array(b.column("y").to_pylist(), float)
        return [z.T @ z, z.T @ y]

    zz, zy = _partial_sums(rows, normal)
    model.weights = np.linalg.solve(zz + RIDGE * n * np.eye(len(zy)) / FEATURES, zy)
    return model, float(ones / n)


def rising_map(bins: list[tuple[float, float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators over (x, ones, rows), smoothed by half a row of each label: knots of
    a rising piecewise linear map."""
    blocks: list[list[float]] = []
    for x, ones, rows in sorted(bins):
        blocks.append([x * rows, ones, rows])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            top = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], top)]
    xs = np.array([b[0] / b[2] for b in blocks])
    ys = np.array([(b[1] + 0.5) / (b[2] + 1) for b in blocks])
    return xs, np.maximum.accumulate(ys)


def fit_scores(stats: DataFrame, labels: DataFrame, label_col: str, max_fit_rows: int):
    """What turns a matrix of statistics into scores; runs at once."""
    rows = staged(labelled(stats, labels, label_col, max_fit_rows).coalesce(FIT_PARTITIONS), "quality-fit")
    rows = rows.coalesce(FIT_PARTITIONS)
    model, share = fit_ridge(rows.where("fold in (0, 1)"))
    if model is None:
        return lambda x: np.full(len(x), share)

    def raw_scores():
        return lambda r: {"doc_id": r["doc_id"], "raw": model.raw(_matrix(r["stats"]))}

    with_y = map_slices(rows.where("fold = 3").select(F.col("y").cast("long").alias("doc_id"), "stats"), raw_scores,
                        "doc_id long, raw double", 4096)
    binned = (with_y.groupBy(F.floor(F.greatest(F.lit(-0.5), F.least(F.lit(1.5), "raw")) * (BINS / 2)).alias("bin"))
              .agg(F.sum("doc_id").alias("ones"), F.count(F.lit(1)).alias("n"), F.avg("raw").alias("x")).collect())
    xs, ys = rising_map([(r["x"], r["ones"], r["n"]) for r in binned]) if binned else (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def scores(x):
        raw = model.raw(x)
        # the flat steps of the map keep the raw order by a thousandth
        return 0.999 * np.interp(raw, xs, ys) + 0.001 * np.clip((raw + 0.5) / 2, 0, 1)
    return scores


def quality_scores(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
                   text_col: str = "text", threshold: float = THRESHOLD, max_fit_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted); fitting runs at once, scoring on use."""
    stats = staged(with_stats(docs, id_col, text_col), "quality-stats")
    scores = fit_scores(stats, labels, label_col, max_fit_rows)
    held = fold_of(F.col("doc_id")) == HELD_OUT
    scored = map_slices(stats, lambda: lambda r: {"doc_id": r["doc_id"], "score": scores(_matrix(r["stats"]))},
                        "doc_id long, score double", 4096)
    return scored.select("doc_id", held.alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
                   text_col: str = "text", threshold: float = THRESHOLD, max_fit_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` whose own text is predicted good.  Rows are written once with their statistics, so a text is
    read by Python once, and each row is judged by its own: ids that are null or repeat decide nothing."""
    @F.arrow_udf("array<float>")
    def stats(texts):
        import pyarrow as pa
        found = []
        for at in range(0, len(texts), SLICE_ROWS):
            found += [document_stats(t) for t in texts.slice(at, SLICE_ROWS).to_pylist()]
        return pa.array(found, pa.list_(pa.float32()))

    body = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = staged(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                              F.col(f"`{id_col}`").cast("long").alias("doc_id"), stats(body).alias("stats")), "quality-rows", "zstd")
    scores = fit_scores(rows.select("doc_id", "stats"), labels, label_col, max_fit_rows)

    @F.arrow_udf("boolean")
    def good(of):
        import pyarrow as pa
        return pa.array(scores(_matrix(of)) >= threshold, pa.bool_())

    return rows.where(good("stats")).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
