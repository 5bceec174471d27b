"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

1. N-grams of 1 to 3 letters (other characters count as one space) are hashed to 2**14 columns.
   Document frequencies are counted over all documents: each task sums its own, one row a column
   and task is shuffled, 2**14 sums reach the driver.
2. At most ``FIT_ROWS_PER_LANGUAGE`` labelled documents a language, outside the held-out fold, are
   chosen by id hash; folds 0 and 1 train (``ftrl``: elastic net), fold 3 calibrates.
3. One temperature, of a grid, is chosen by the calibration rows' log loss.
4. All documents are scored.

Defined results: ``und`` with score 0 where the text is null or has no letter, or where there is no
language to learn.  Null and blank language labels are not learned.  Texts are used whole.  Null ids
belong to fold 0; repeated rows are ordinary rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import HELD_OUT, bounded_sample, fold_of, hash_limit, staged
from tillroll.llm.ftrl import PARTITIONS, Ftrl, probabilities, sparse_logits, train
from tillroll.llm.rows import map_slices, runs

WIDTH = 1 << 14
FIT_ROWS_PER_LANGUAGE = 4_000
LEAST_STEPS = 12_000  # epochs go on until so many rows were seen, 3 to 20 of them
TEMPERATURES = np.geomspace(0.05, 20, 61)
UNDETERMINED = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(columns, counts) of the letter n-grams of a whole text; none without a letter."""
    body = _NOT_LETTERS.sub(" ", text.lower()).strip()
    if not any(map(str.isalpha, body)):  # other numerals than digits are word characters too
        return np.zeros(0, np.int32), np.zeros(0)
    c = np.frombuffer(f" {body} ".encode("utf-32-le"), np.uint32)
    one = c[1:-1] * np.uint32(2654435761)
    two = c[:-1] * np.uint32(2246822519) + c[1:] * np.uint32(3266489917) + np.uint32(1)
    three = c[:-2] * np.uint32(668265263) + c[1:-1] * np.uint32(374761393) + c[2:] * np.uint32(3032525683) + np.uint32(2)
    h = np.concatenate([one, two, three])
    h = (h ^ (h >> np.uint32(15))) * np.uint32(2246822507)
    counts = np.bincount((h >> np.uint32(18)).astype(np.int64), minlength=WIDTH)
    at = np.flatnonzero(counts)
    return at.astype(np.int32), counts[at].astype(np.float64)


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """In how many documents each column occurs, and the number of documents; over all of them."""
    def run(batches):
        import pyarrow as pa
        total, n = np.zeros(WIDTH, np.int64), 0
        for b in batches:
            for at in range(0, b.num_rows, 256):
                for t in b.column(0).slice(at, 256).to_pylist():
                    total[ngram_counts(t)[0]] += 1
                    n += 1
        if n:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"col": np.append(at, WIDTH), "n": np.append(total[at], n)})

    sums = (docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, "col long, n long")
            .groupBy("col").agg(F.sum("n").alias("n")).collect())
    df = np.zeros(WIDTH + 1)
    for r in sums:
        df[r["col"]] = r["n"]
    return df[:WIDTH], int(df[WIDTH])


def tf_idf(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, counts = ngram_counts(text)
    v = (1 + np.log(counts)) * idf[at] if len(at) else counts
    return at, (v / np.sqrt((v * v).sum()) if len(v) else v).astype(np.float32)


def training_rows(docs: DataFrame, languages: list[str], sizes: dict[str, int], per_language: int,
                  idf: np.ndarray) -> DataFrame:
    """Rows (fold, idx, val, target) of the chosen labelled documents (doc_id, text, lang)."""
    limit = F.lit(-1).cast("long")
    for name in languages:
        limit = F.when(F.col("lang") == name, hash_limit(per_language, sizes[name])).otherwise(limit)
    learnable = docs.where((fold_of(F.col("doc_id")) != HELD_OUT) & F.col("lang").isin(languages))
    chosen = bounded_sample(learnable, limit, "doc_id", "lang", "text")
    place = {name: i for i, name in enumerate(languages)}

    def make():
        def step(r):
            pairs = [tf_idf(t or "", idf) for t in r["text"].to_pylist()]
            return {"fold": r["fold"], "idx": [a for a, _ in pairs], "val": [v for _, v in pairs],
                    "target": [np.eye(len(place), dtype=np.float32)[place[x]] for x in r["lang"].to_pylist()]}
        return step

    mixed = chosen.select(fold_of(F.col("doc_id")).alias("fold"), "text", "lang", "h")
    mixed = mixed.repartition(PARTITIONS, "h").sortWithinPartitions("h")
    return map_slices(mixed, make, "fold int, idx array<int>, val array<float>, target array<float>")


def best_temperature(rows: DataFrame, weights: np.ndarray) -> float:
    """The grid's temperature of least log loss over the calibration rows; 1 without any."""
    def run(batches):
        import pyarrow as pa
        loss, n = np.zeros(len(TEMPERATURES)), 0
        for b in batches:
            logits = sparse_logits(weights, runs(b.column("idx")), runs(b.column("val")))
            y = np.array(b.column("target").to_pylist())
            for k, t in enumerate(TEMPERATURES):
                loss[k] -= (np.log(probabilities(logits / t) + 1e-12) * y).sum()
            n += b.num_rows
        if n:
            yield pa.RecordBatch.from_pydict({"loss": [loss]})

    got = rows.select("idx", "val", "target").mapInArrow(run, "loss array<double>").collect()
    return float(TEMPERATURES[int(np.argmin(sum(np.array(r["loss"]) for r in got)))]) if got else 1.0


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
              per_language: int = FIT_ROWS_PER_LANGUAGE) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score); training runs at once, scoring on use."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    sizes = {r["lang"]: r["n"] for r in d.where((fold_of(F.col("doc_id")) != HELD_OUT) & (F.trim("lang") != ""))
             .groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a language
    names = sorted(sizes)
    if names:
        df, n = document_frequencies(d, "text")
        idf = np.log((1 + n) / (1 + df)) + 1
        rows = staged(training_rows(d, names, sizes, per_language, idf), "language-fit")
        weights = np.zeros((1, WIDTH))
        if len(names) > 1:
            part = rows.where("fold in (0, 1)")
            epochs = min(20, max(3, -(-LEAST_STEPS // max(1, part.count()))))
            weights = train(part, Ftrl(len(names), WIDTH, alpha=1.0, l1=0.02, l2=0.01), epochs)
        weights = weights / (best_temperature(rows.where("fold = 3"), weights) if len(names) > 1 else 1)
        sent = d.sparkSession.sparkContext.broadcast((names, idf, weights))

    def make():
        if not names:
            return lambda r: {"doc_id": r["doc_id"], "lang_pred": [UNDETERMINED] * len(r["text"]), "score": [0.0] * len(r["text"])}
        known, idf, weights = sent.value

        def step(r):
            pairs = [tf_idf(t or "", idf) for t in r["text"].to_pylist()]
            logits = sparse_logits(weights, [a for a, _ in pairs], [v for _, v in pairs])
            p = probabilities(logits) if len(known) > 1 else np.ones((len(pairs), 1))
            best = p.argmax(1)
            empty = [not len(a) for a, _ in pairs]
            return {"doc_id": r["doc_id"], "lang_pred": [UNDETERMINED if e else known[b] for e, b in zip(empty, best)],
                    "score": [0.0 if e else float(x) for e, x in zip(empty, p.max(1))]}
        return step

    scored = map_slices(d.select("doc_id", "text"), make, "doc_id long, lang_pred string, score double")
    return scored.select("doc_id", (fold_of(F.col("doc_id")) == HELD_OUT).alias("held_out"), "lang_pred", "score")
