"""Toxicity by weak supervision.

1. Voters.  Lexicons of plain insults by kind and language, patterns of address and disguise, and
   lexicons learned from the labelled rows' words each look at every whole text and fire or not.
   One pass writes (doc_id, votes) to the shared folder, votes as a bit mask.
2. Generative label model.  Given the hidden label, a voter fires at one rate for toxic and another
   for clean documents.  Off the diagonal, the voters' covariance then has rank one; the rates follow
   from it.  Pairs whose covariance stays far off are correlated: such voters share one vote's weight.
   Only the sums of fires and of joint fires, over all documents, reach the driver (voters^2 numbers).
3. The model's posteriors label a bounded sample outside the held-out fold, on which a linear
   classifier over hashed words is trained (``ftrl``: logistic, elastic net).
4. A second pass scores every whole text with the linear classifier.

Labels (outside the held-out fold only) give the learned lexicons and the share of toxic documents.

Defined results: null, empty and wordless texts get the classifier's base rate.  Labels other than 0
and 1 are ignored.  Without labels the lexicons and patterns vote alone and ``BASE_RATE`` is used.
Null ids belong to fold 0; repeated rows are ordinary rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import math
import operator
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import HELD_OUT, bounded_sample, fold_of, hash_limit, staged
from tillroll.llm.ftrl import PARTITIONS, Ftrl, probabilities, train
from tillroll.llm.rows import map_slices

WIDTH = 1 << 17
MAX_LABELLED_ROWS = 60_000   # for the learned lexicons
MAX_TRAIN_ROWS = 30_000      # for the linear classifier
BASE_RATE = 0.05
THRESHOLD = 0.3
MOST_OFF = 0.15               # correlation beyond the model of pairs that count as independent
LEARNED_VOTERS = 4
LEARNED_WORDS = 400          # in all learned lexicons together
MIN_TOXIC_DOCS = 3
LEAST_STEPS = 80_000         # epochs go on until so many rows were seen, 2 to 15 of them

#: Voters of plain words (fixed lists of common insults).
LEXICONS = {
    "wits": "idiot idiots moron morons stupid dumb imbecile fool fools foolish dimwit brainless retarded halfwit dunce",
    "worth": "worthless loser losers useless pathetic failure nobody pointless hopeless",
    "filth": "trash garbage scum filth filthy vermin rat rats pig pigs dirtbag scumbag",
    "disgust": "disgusting vile repulsive revolting gross nasty sickening",
    "mockery": "clown clowns joke laughable ridiculous freak weirdo creep coward liar",
    "profane": "damn crap bastard bitch shit shitty fuck fucking asshole dick prick slut whore",
    "spanish": "idiota idiotas estúpido estúpida imbécil imbéciles basura inútil asqueroso asquerosa patético mierda payaso",
    "french": "imbécile crétin crétine débile connard connasse ordure minable pathétique dégoûtant merde salaud abruti",
    "german": "dummkopf dumm abschaum versager versagerin ekelhaft erbärmlich wertlos nutzlos arschloch scheiße trottel",
}
INSULTS = " ".join(LEXICONS.values()).split()
PATTERNS = {
    "address": r"\b(?:you|u|your|you're|ya) (?:are |r |a |an |such |all |just |so |complete |total |utter )*(?:%s)\b" % "|".join(INSULTS),
    "command": r"\b(?:shut up|go to hell|get lost|drop dead|kill yourself|screw you|piss off|hate you|nobody (?:likes|loves) you)\b",
    "intensified": r"\b(?:so|such a|such an|complete|total|utter|absolute|absolutely|really|very) (?:%s)\b" % "|".join(INSULTS),
    "disguised": r"\b(?:[i1!]d[i1!]0t|id[1!]ot|st\*p[i1!*]d|stup[1!*]d|m0r[o0]n|mor0n|l0s[e3]r|los3r|tr[@4]sh|f\*ck|sh[1!*]t|b[1!*]tch|scvm|cl0wn)\b",
}
COMMAND_WORDS = frozenset("shut hell lost drop kill screw piss hate nobody".split())
KEPT_WORDS = 300_000
_WORD = re.compile(r"[^\W\d_]+")
_MIXED = re.compile(r"[a-z][0-9!*@$][a-z]")  # in every disguised form but [i1!]d[i1!]0t and scvm


class Memo(dict):
    """word -> what ``made`` makes of it, kept for the words seen last; words repeat across texts."""

    def __init__(self, made):
        super().__init__()
        self.made = made

    def __missing__(self, word):
        if len(self) > KEPT_WORDS:
            self.clear()
        value = self[word] = self.made(word)
        return value


def raw_words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def forms(word: str) -> tuple[str, ...]:
    """A word and its stems: the first four and five letters of a longer word, with a star."""
    n = len(word)
    return (word,) if n < 5 else (word, word[:4] + "*") if n < 6 else (word, word[:4] + "*", word[:5] + "*")


def words_in(text: str) -> set[str]:
    return set().union(*map(forms, raw_words(text)))


def column(form: str) -> int:
    """Hashed column of a word or stem, from 1 on; column 0 is the bias."""
    return 1 + zlib.crc32(form.encode()) % (WIDTH - 1)


def columns_of(text: str, known: Memo) -> np.ndarray:
    c = {0}.union(*map(known.__getitem__, raw_words(text)))
    return np.sort(np.fromiter(c, np.int32, len(c)))


def voter_names() -> list[str]:
    return [*LEXICONS, *PATTERNS, *(f"learned{i}" for i in range(LEARNED_VOTERS))]


class Voters:
    """``votes(text)``: bit i is set where voter i fires."""

    def __init__(self, learned: list[str]):
        self.bit = {n: 1 << i for i, n in enumerate(voter_names())}
        self.of: dict[str, int] = {}
        for name, words in LEXICONS.items():
            for w in words.split():
                self.of[w] = self.of.get(w, 0) | self.bit[name]
        for w in learned:
            self.of[w] = self.of.get(w, 0) | self.bit[f"learned{zlib.crc32(w.encode()) % LEARNED_VOTERS}"]
        self.patterns = {n: re.compile(p) for n, p in PATTERNS.items()}
        self.insult = sum(self.bit[n] for n in LEXICONS)
        self.command = 1 << len(self.bit)  # beyond the voters: a word that the command pattern needs
        self.known = Memo(self._mask)

    def _mask(self, word: str) -> int:
        return functools.reduce(operator.or_, (self.of.get(f, 0) for f in forms(word)), self.command * (word in COMMAND_WORDS))

    def votes(self, text: str) -> int:
        low = text.lower()
        mask = functools.reduce(operator.or_, map(self.known.__getitem__, set(_WORD.findall(low))), 0)
        tried = [*(("address", "intensified") if mask & self.insult else ()), *(("command",) if mask & self.command else ()),
                 *(("disguised",) if _MIXED.search(low) or "0t" in low or "scvm" in low else ())]
        for name in tried:  # each only where the text holds what the pattern needs
            if self.patterns[name].search(low):
                mask |= self.bit[name]
        return mask & ~self.command


def document_counts(texts: DataFrame, only: frozenset[str] | None = None) -> DataFrame:
    """(word, n): documents with each word or stem, null for all documents; each task adds up its own."""
    def run(batches):
        import pyarrow as pa

        def out():
            return pa.RecordBatch.from_pydict({"word": list(seen), "n": list(seen.values())}, schema=schema)
        known = Memo(forms if only is None else lambda w: tuple(f for f in forms(w) if f in only))
        seen, schema = Counter(), pa.schema([("word", pa.string()), ("n", pa.int64())])
        for b in batches:
            for t in b.column("text").to_pylist():
                seen.update(set().union(*map(known.__getitem__, raw_words(t))))
                seen[None] += 1
            if len(seen) > 300_000:
                yield out()
                seen = Counter()
        yield out()

    return texts.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def learned_words(d: DataFrame, labels: DataFrame, label_col: str, max_rows: int = MAX_LABELLED_ROWS) -> tuple[list[str], float]:
    """Words and stems that mark toxic labelled documents, and the labelled share of toxic ones.

    One must be in ``MIN_TOXIC_DOCS`` toxic documents and twenty times as common there as in clean
    ones; the ``LEARNED_WORDS`` with the largest log-likelihood gain are kept.  Toxic documents are
    counted first, then only their words in clean ones."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where(
        F.col("y").isin(0, 1) & (fold_of(F.col("doc_id")) != HELD_OUT))
    n = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}  # two rows
    total = sum(n.values())
    if len(n) < 2:
        return [], n.get(1, 0) / total if total else BASE_RATE
    # a bounded number of labels: they go to the texts, not the texts to them; ids that repeat are thinned by their texts
    known = bounded_sample(known, F.lit(hash_limit(max_rows, total)), "doc_id", "y").drop("h")
    rows = d.join(F.broadcast(known), "doc_id")
    limit = hash_limit(max_rows, rows.select("doc_id").count())
    rows = rows.where(F.shiftrightunsigned(F.xxhash64(F.lit(6), "doc_id", "y", "text"), 1) <= limit)
    toxic = {r["word"]: r["n"] for r in document_counts(rows.where("y = 1")).where(
        f"n >= {MIN_TOXIC_DOCS} or word is null").collect()}  # of a bounded sample's toxic part
    pos = toxic.pop(None, 0)
    clean = {r["word"]: r["n"] for r in document_counts(rows.where("y = 0"), frozenset(toxic)).collect()}
    neg = clean.pop(None, 0)
    if not pos or not neg:
        return [], n[1] / total
    lift = {w: (t / pos) / ((clean.get(w, 0) + 0.5) / neg) for w, t in toxic.items()}
    marks = sorted((w for w in toxic if lift[w] >= 20), key=lambda w: (-toxic[w] * math.log(lift[w]), w))
    return marks[:LEARNED_WORDS], n[1] / total


def label_model(fires: np.ndarray, joint: np.ndarray, n: int, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rates among toxic, rates among clean, weights) of the voters from their fires and joint fires.

    cov(i, j) = share (1 - share) d_i d_j for voters independent given the label, with d the
    difference of the rates: a rank-one fit without the diagonal and without correlated pairs."""
    m = len(fires)
    mean = fires / n
    cov = joint / n - np.outer(mean, mean)
    live = fires > 0
    free = np.outer(live, live) & ~np.eye(m, dtype=bool)
    deviation = np.sqrt(np.maximum(mean * (1 - mean), 0)) + 1e-12
    # Start: d_i^2 = cov_ij cov_ik / cov_jk for every pair j, k; the median bears some correlated pairs.
    d = deviation * 0.5
    for i in np.flatnonzero(live):
        others = np.flatnonzero(free[i])
        squares = [cov[i, j] * cov[i, k] / cov[j, k] for x, j in enumerate(others) for k in others[x + 1:] if cov[j, k] > 1e-9]
        if squares:
            d[i] = max(1e-9, math.sqrt(max(0.0, float(np.median(squares)))))
    for _ in range(3):
        off = np.abs(cov - np.outer(d, d)) / np.outer(deviation, deviation)
        pairs = free & (off < MOST_OFF)
        for _ in range(200):  # alternating least squares
            for i in np.flatnonzero(live):
                w = d[pairs[i]]
                d[i] = max(1e-9, (cov[i, pairs[i]] @ w) / (w @ w)) if w.size else d[i]
    spread = math.sqrt(share * (1 - share))
    toxic = np.clip(mean + (1 - share) * d / spread, 1e-4, 1 - 1e-4)
    clean = np.clip(mean - share * d / spread, 1 / (n + 2), 1 - 1e-4)
    correlated = free & (off >= MOST_OFF)
    return toxic, clean, 1 / (1 + correlated.sum(1))


def posterior(votes: int, toxic: np.ndarray, clean: np.ndarray, weight: np.ndarray, share: float) -> float:
    x = np.array([(votes >> i) & 1 for i in range(len(toxic))])
    llr = weight * np.where(x == 1, np.log(toxic / clean), np.log((1 - toxic) / (1 - clean)))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, math.log(share / (1 - share)) + llr.sum()))))


def toxicity_scores(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
                    text_col: str = "text", threshold: float = THRESHOLD, max_labelled_rows: int = MAX_LABELLED_ROWS,
                    max_train_rows: int = MAX_TRAIN_ROWS, least_steps: int = LEAST_STEPS) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted); the models are fitted at once, scoring runs on use.  At most
    ``max_labelled_rows`` labelled rows give the learned lexicons, ``max_train_rows`` rows train the classifier,
    in as many epochs (2 to 15) as show it ``least_steps`` rows."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    learned, share = learned_words(d, labels, label_col, max_labelled_rows)
    share = min(0.5, max(0.001, share))
    names = voter_names()

    def vote():
        voters = Voters(learned)
        return lambda r: {"doc_id": r["doc_id"], "votes": [voters.votes(t) for t in r["text"].to_pylist()]}

    votes = staged(map_slices(d, vote, "doc_id long, votes long"), "toxic-votes")
    bits = [F.expr(f"cast((votes >> {i}) & 1 as bigint)") for i in range(len(names))]
    sums = votes.agg(F.count(F.lit(1)).alias("n"), *[F.sum(a * b).alias(f"j{i}_{k}") for i, a in enumerate(bits) for k, b in enumerate(bits) if i <= k]).first()
    n = sums["n"]
    weights = np.zeros(WIDTH)
    if n:
        joint = np.array([[sums[f"j{min(i, k)}_{max(i, k)}"] for k in range(len(names))] for i in range(len(names))], float)
        toxic, clean, weight = label_model(np.diag(joint).copy(), joint, n, share)
        learnable = d.where(fold_of(F.col("doc_id")) != HELD_OUT)
        n_learnable = votes.where(fold_of(F.col("doc_id")) != HELD_OUT).count()
        chosen = bounded_sample(learnable, F.lit(hash_limit(max_train_rows, n_learnable)), "doc_id", "text")

        def features():
            voters, known = Voters(learned), Memo(lambda w: tuple(map(column, forms(w))))

            def step(r):
                texts = r["text"].to_pylist()
                idx = [columns_of(t, known) for t in texts]
                return {"idx": idx, "val": [np.ones(len(i), np.float32) for i in idx],
                        "target": [[posterior(voters.votes(t), toxic, clean, weight, share)] for t in texts]}
            return step

        rows = chosen.select("text", "h").repartition(PARTITIONS, "h").sortWithinPartitions("h")
        rows = staged(map_slices(rows, features, "idx array<int>, val array<float>, target array<float>"), "toxic-fit")
        epochs = min(15, max(2, -(-least_steps // max(1, rows.count()))))
        weights = train(rows, Ftrl(1, WIDTH, alpha=1.0, l1=0.5, l2=0.1), epochs)[0]
    sent = d.sparkSession.sparkContext.broadcast({int(c): float(weights[c]) for c in np.flatnonzero(weights)})

    def score():
        weight = sent.value
        known = Memo(lambda w: tuple(c for c in map(column, forms(w)) if c in weight))

        def step(r):
            margins = [sum(map(weight.__getitem__, sorted(set().union(*map(known.__getitem__, raw_words(t)))))) for t in r["text"].to_pylist()]
            return {"doc_id": r["doc_id"], "score": probabilities(np.array(margins)[:, None] + weight.get(0, 0.0))[:, 0]}
        return step

    return map_slices(d, score, "doc_id long, score double").select(
        "doc_id", (fold_of(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
