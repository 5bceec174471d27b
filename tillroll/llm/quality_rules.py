"""Line-first quality rules, in DataFrame expressions only.

Each line of a document is judged on its own by punctuation, navigation and boilerplate rules;
failing lines are removed, and a document that loses too much of its text is rejected.  Next to
that, a fixed base rule looks at the whole text (too few words, or mostly repeated word windows).

Everything is computed row by row: no shuffle, no Python, one scan.

Defined results: a null, empty or blank text has no words, counts 0 everywhere, ``cleaned`` is ""
and it fails the base rule.  Null ids pass through.  Repeated rows are judged each on their own.
Extra input columns are ignored, whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import SPACE_CLASS, SPACES, words_of

#: Base rule (fixed by the result's contract).
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
WINDOW = 3
SYMBOLS = "#*$%&|<>"

#: Line rules.
MAX_LOST_PCT = 50          # documents losing a larger share of their word characters are rejected
MIN_OPEN_LINE_WORDS = 5    # a line without a closing mark needs so many words
MAX_BOILERPLATE_WORDS = 40  # longer lines are prose that happens to hold a phrase
CLOSING = tuple(".!?:;…。！？\"'”’»)]}")
SEPARATORS = "|»>·"        # a line with one for every five words is navigation (Latin-1: a fast character class)
BOILERPLATE = (
    "all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie policy",
    "we use cookies", "accept cookies", "click here", "read more", "sign up for", "subscribe to our",
    "follow us on", "share this", "skip to content", "back to top", "enable javascript", "lorem ipsum",
    "powered by", "todos los derechos reservados", "tous droits réservés", "alle rechte vorbehalten",
)


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_window_words(words: Column, width: int = WINDOW) -> Column:
    """How many words lie in a window of ``width`` words that is found twice or more in the array.

    1. Windows are hashed; an array whose hashes all differ has no repeat.
    2. Otherwise the hashes' upper 44 bits, each with the place in its lower 20 bits, are sorted;
       neighbours of one hash hold the same window, which is checked on the words themselves.
    3. Where that check finds a hash collision, or with over 2**20 windows, whole windows are sorted.

    Each repeated place covers ``width`` words or the distance to the next repeated place."""
    places = F.sequence(F.lit(0), F.size(words) - width)

    def window(i: Column) -> list[Column]:
        return [F.get(words, i + k) for k in range(width)]

    def spread(at: Column) -> Column:
        return F.aggregate(F.transform(at, lambda p, k: F.least(F.lit(width), F.coalesce(F.get(at, k + 1) - p, F.lit(width)))),
                           F.lit(0), lambda a, x: a + x)

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.lit((1 << 20) - 1)).cast("int")

    def same_hash(x: Column, y: Column) -> Column:
        return F.coalesce(F.shiftright(x, 20) == F.shiftright(y, 20), F.lit(False))

    def same_window(x: Column, y: Column) -> Column:
        same = F.lit(True)
        for p, q in zip(window(place(x)), window(place(y))):
            same = same & (p == q)
        return same

    def from_packed(rows: Column) -> Column:
        repeated = F.filter(rows, lambda x, k: same_hash(x, F.get(rows, k + 1)) | same_hash(x, F.get(rows, k - 1)))
        return _bind(repeated, lambda r: F.when(
            F.exists(F.transform(r, lambda x, k: same_hash(x, F.get(r, k + 1)) & ~same_window(x, F.get(r, k + 1))), lambda x: x),
            exact).otherwise(_bind(F.sort_array(F.transform(r, place)), spread)))

    def from_keyed(rows: Column) -> Column:
        repeated = F.filter(rows, lambda x, k: F.coalesce(F.get(rows, k - 1)["w"] == x["w"], F.lit(False))
                            | F.coalesce(F.get(rows, k + 1)["w"] == x["w"], F.lit(False)))
        return _bind(F.sort_array(F.transform(repeated, lambda x: x["i"])), spread)

    exact = _bind(F.sort_array(F.transform(places, lambda i: F.struct(F.concat_ws(" ", *window(i)).alias("w"), i.alias("i")))), from_keyed)

    def from_hashes(h: Column) -> Column:
        packed = F.transform(h, lambda x, i: F.shiftleft(F.shiftright(x, 20), 20).bitwiseOR(i.cast("long")))
        return (F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0))
                .when(F.size(h) > (1 << 20), exact)
                .otherwise(_bind(F.sort_array(packed), from_packed)))

    hashes = F.transform(places, lambda i: F.xxhash64(*window(i)))
    return F.when(F.size(words) < width, F.lit(0)).otherwise(_bind(hashes, from_hashes)).cast("long")


def _line_facts(line: Column) -> Column:
    body = F.btrim(line, F.lit(SPACES))
    return F.struct(
        line.alias("line"), body.alias("body"), F.lower(body).alias("low"),
        F.split(body, f"[{SPACE_CLASS}]+").alias("words"),
        F.regexp_replace(body, f"[^{SYMBOLS}{SEPARATORS}!]+", "").alias("marks"))


def _count(marks: Column, of: str) -> Column:
    return F.length(F.regexp_replace(marks, f"[^{of}]+", ""))


def _judged(x: Column) -> Column:
    """A line's word characters and whether it fails; a line without a word never fails."""
    n, marks, body = F.size(x["words"]), x["marks"], x["body"]
    shouted = _count(marks, "!")
    phrase = F.lit(False)
    for p in BOILERPLATE:
        phrase = phrase | F.contains(x["low"], F.lit(p))
    punctuation = (~F.substring(body, -1, 1).isin(*CLOSING) & (n < MIN_OPEN_LINE_WORDS)
                   | (marks != "") & ((shouted > 3) & (shouted >= n) | (2 * _count(marks, SYMBOLS) >= n)))
    navigation = (marks != "") & (5 * _count(marks, SEPARATORS) >= n)
    boilerplate = (n <= MAX_BOILERPLATE_WORDS) & phrase
    return F.struct(
        x["line"].alias("line"), F.length(F.array_join(x["words"], "")).alias("chars"),
        ((body != "") & (punctuation | navigation | boilerplate)).alias("fails"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  max_lost_pct: int = MAX_LOST_PCT, carry: list[str] = ()) -> DataFrame:
    """One row per input row: id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``kept``, then ``n_lines`` (with a word), ``n_removed_lines``,
    ``lost_chars`` (word characters in removed lines) and ``cleaned`` (the text without failing lines).
    ``carry``: input columns that are passed through in a struct ``carried``."""
    carried = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *carried)
    carried = ["carried"] if carry else []
    d = d.select("doc_id", *carried, "text", words_of(F.col("text")).alias("words"), F.split("text", "\n", -1).alias("lines"))
    d = d.select(
        "doc_id", *carried,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        F.filter("lines", lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("full_lines"),
        repeated_window_words(F.col("words")).alias("n_repeat_words"),
        F.transform(F.transform("lines", _line_facts), _judged).alias("judged"))
    d = d.select(
        "doc_id", *carried, "n_words", "word_chars", "n_symbols",
        (F.size("full_lines") - F.size(F.array_distinct("full_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words", F.size("full_lines").cast("long").alias("n_lines"),
        F.aggregate("judged", F.lit(0).cast("long"), lambda a, x: a + F.when(x["fails"], x["chars"]).otherwise(0)).alias("lost_chars"),
        F.filter("judged", lambda x: ~x["fails"]).alias("good"), F.size("judged").alias("n_all"))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    return d.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"),
        (~base & (100 * F.col("lost_chars") <= max_lost_pct * F.col("word_chars"))).alias("kept"),
        "n_lines", (F.col("n_all") - F.size("good")).cast("long").alias("n_removed_lines"), "lost_chars",
        F.array_join(F.col("good")["line"], "\n").alias("cleaned"), *carried)


def cleaned_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      max_lost_pct: int = MAX_LOST_PCT) -> DataFrame:
    """The rows of ``docs`` that are kept, with the cleaned text.

    The verdict is applied by a generator rather than a filter: the optimizer would copy a filter's
    expressions down through every step and judge each document several times."""
    judged = quality_rules(docs, id_col, text_col, max_lost_pct, carry=docs.columns)
    row = F.struct(*[F.col("cleaned" if c == text_col else f"carried.`{c}`").alias(c) for c in docs.columns])
    return judged.select(F.explode(F.when(F.col("kept"), F.array(row))).alias("row")).select(
        *[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
