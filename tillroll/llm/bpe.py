"""Byte-level BPE encoding and decoding with the tokenizers library, over Arrow batches.

The merge rules come from a rank file (base64 token, rank).  A text is split by the vocabulary's
pattern; each piece's UTF-8 bytes are written as the 256 characters of the byte table and go
through the library's BPE model.  Pieces repeat, so a task keeps a bounded table of those it has
encoded.  Decoding joins the tokens as they are written and reverses the byte table, before any character is
read, so characters that are split over tokens come back whole.

The model is built on the driver (a vocabulary has a fixed size) and broadcast; executors need the
libraries but not the file.

Defined results: a null text is encoded as the empty text, with no ids; special strings in a text
are ordinary text; null or repeated ids pass through; extra columns are ignored, whatever their
names; an empty table gives an empty result.  Texts are always encoded whole.
"""

from __future__ import annotations

import base64
from array import array

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.rows import list_column, map_slices, runs

KEPT_PIECES = 400_000  # encoded pieces that a task keeps; the table is emptied beyond that


def byte_table() -> list[str]:
    """Byte -> character: printable Latin-1 bytes stand for themselves, the others, in order, for the
    characters from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def bpe_model_json(ranks: dict[bytes, int]) -> str:
    """The library's tokenizer for these ranks.  A pair may merge if its joined bytes have a rank,
    lowest rank first, so every split of a token into two tokens is a merge rule."""
    from tokenizers import Tokenizer, models
    chars = byte_table()
    written = {t: "".join(chars[b] for b in t) for t in ranks}
    merges = [(written[t[:k]], written[t[k:]])
              for t, _ in sorted(ranks.items(), key=lambda x: x[1])
              for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
    return Tokenizer(models.BPE(vocab={written[t]: r for t, r in ranks.items()}, merges=merges)).to_str()


class Codec:
    """A vocabulary's encoder and decoder.  ``data`` is plain: what is broadcast."""

    def __init__(self, data: tuple[str, str, list[str]]):
        self.data = data
        self.json, self.pattern, self.tokens = data  # tokens: as written, a character a byte
        self._ready = None
        self.byte_of = np.zeros(512, np.uint8)  # the byte table reversed
        self.byte_of[[ord(c) for c in byte_table()]] = np.arange(256)

    def _open(self):
        if self._ready is None:
            import os

            import regex
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
            from tokenizers import Tokenizer
            chars = byte_table()
            to_chars = {b: c for b, c in enumerate(chars)}
            self._ready = (regex.compile(self.pattern).findall, Tokenizer.from_str(self.json), to_chars, {},
                           np.array([len(t) for t in self.tokens], np.int64))
        return self._ready

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split, model, to_chars, known, _ = self._open()
        if len(known) > KEPT_PIECES:
            known.clear()
        pieces = [split(t) for t in texts]
        new = list({p for ps in pieces for p in ps if p not in known})
        written = [p.encode().decode("latin-1").translate(to_chars) for p in new]
        for p, e in zip(new, model.encode_batch_fast(written, add_special_tokens=False)):
            known[p] = array("i", e.ids).tobytes()
        return [np.frombuffer(b"".join([known[p] for p in ps]), np.int32) for ps in pieces]

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters [start, end) that each token touches."""
        raw = np.frombuffer(text.encode(), np.uint8)
        char_of = np.cumsum((raw & 0xC0) != 0x80) - 1
        ends = np.cumsum(self._open()[4][ids])
        if not len(ids):
            return ends, ends
        starts = np.concatenate([[0], ends[:-1]])
        return char_of[starts], char_of[ends - 1] + 1

    def decode(self, ids: np.ndarray) -> bytes:
        written = "".join([self.tokens[i] for i in ids.tolist()]).encode("utf-16-le")
        return self.byte_of[np.frombuffer(written, np.uint16)].tobytes()


def codec(ranks_path: str, pattern: str) -> Codec:
    ranks = read_ranks(ranks_path)
    tokens, chars = [""] * (max(ranks.values(), default=-1) + 1), byte_table()
    for t, r in ranks.items():
        tokens[r] = "".join(chars[b] for b in t)
    return Codec((bpe_model_json(ranks), pattern, tokens))


def _sent(vocabulary: Codec):
    """Broadcast the vocabulary; the returned function opens it once in each Python worker."""
    shared = SparkSession.active().sparkContext.broadcast({"data": vocabulary.data})

    def opened() -> Codec:
        if "codec" not in shared.value:
            shared.value["codec"] = Codec(shared.value["data"])
        return shared.value["codec"]

    return opened


def encode_bpe(docs: DataFrame, vocabulary: Codec, id_col: str = "doc_id", text_col: str = "text",
               with_offsets: bool = True) -> DataFrame:
    """Rows (doc_id, ids), and with offsets also (char_start, char_end) per token."""
    opened = _sent(vocabulary)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def make():
        v = opened()

        def step(rows):
            texts = rows["text"].to_pylist()
            ids = v.encode(texts)
            sizes = [len(i) for i in ids]
            out = {"doc_id": rows["doc_id"], "ids": list_column(np.concatenate(ids), sizes)}
            if with_offsets:
                spans = [v.offsets(t, i) for t, i in zip(texts, ids)]
                out |= {n: list_column(np.concatenate([x[k] for x in spans]), sizes) for k, n in enumerate(("char_start", "char_end"))}
            return out
        return step

    return map_slices(d, make, "doc_id long, ids array<int>" + ", char_start array<int>, char_end array<int>" * with_offsets)


def decode_bpe(encoded: DataFrame, vocabulary: Codec) -> DataFrame:
    """Rows (doc_id, ids) -> (doc_id, n_tokens, ids_bytes, decoded): the ids as little-endian unsigned
    32-bit integers and the bytes that they stand for."""
    opened = _sent(vocabulary)

    def make():
        v = opened()

        def step(rows):
            ids = runs(rows["ids"])
            return {"doc_id": rows["doc_id"], "n_tokens": [len(i) for i in ids],
                    "ids_bytes": [i.astype("<u4").tobytes() for i in ids], "decoded": [v.decode(i) for i in ids]}
        return step

    return map_slices(encoded.select("doc_id", "ids"), make, "doc_id long, n_tokens long, ids_bytes binary, decoded binary")


def round_trip(docs: DataFrame, vocabulary: Codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_tokens, ids_bytes, decoded, n_split_chars): encoded and decoded again in one pass, so that a task
    opens the vocabulary once.  ``n_split_chars``: characters whose offsets lie in more than one token."""
    opened = _sent(vocabulary)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def split_chars(text, ids, v):
        start, end = v.offsets(text, ids)
        return len(np.unique(start[1:][start[1:] < end[:-1]]))

    def make():
        v = opened()

        def step(rows):
            texts = rows["text"].to_pylist()
            ids = v.encode(texts)
            return {"doc_id": rows["doc_id"], "n_tokens": [len(i) for i in ids], "ids_bytes": [i.astype("<u4").tobytes() for i in ids],
                    "decoded": [v.decode(i) for i in ids], "n_split_chars": [split_chars(t, i, v) for t, i in zip(texts, ids)]}
        return step

    return map_slices(d, make, "doc_id long, n_tokens long, ids_bytes binary, decoded binary, n_split_chars long")


def round_trip_digests(docs: DataFrame, vocabulary: Codec) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256, n_split_chars) of encoding and decoding again."""
    return round_trip(docs, vocabulary).select("doc_id", "n_tokens", F.sha2("ids_bytes", 256).alias("ids_sha256"),
                                               F.sha2("decoded", 256).alias("decoded_sha256"), "n_split_chars")
