"""Class ladders as Column expressions (first matching rule wins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.schema import ABC_A, ABC_B, CLASS_ORDER

# --- fixed values: segment names and rules --------------------------------
# Mart segments, tested in this order on (r, f, m) scores 1..5.
CHAMPIONS = "Champions"
CANNOT_LOSE = "Cannot lose"
AT_RISK = "At risk"
LOYAL = "Loyal customers"
POTENTIAL = "Potential loyalists"
NEW = "New customers"
PROMISING = "Promising"
NEED_ATTENTION = "Need attention"
ABOUT_TO_SLEEP = "About to sleep"
HIBERNATING = "Hibernating"

# Study segments by the two-digit RF code; the patterns are disjoint and cover
# all 25 codes.
STUDY_CODE_PATTERNS = [
    ("[1-2][1-2]", HIBERNATING),
    ("[1-2][3-4]", AT_RISK),
    ("[1-2]5", CANNOT_LOSE),
    ("3[1-2]", ABOUT_TO_SLEEP),
    ("33", NEED_ATTENTION),
    ("[3-4][4-5]", LOYAL),
    ("41", PROMISING),
    ("51", NEW),
    ("[4-5][2-3]", POTENTIAL),
    ("5[4-5]", CHAMPIONS),
]
# The mart's segments in rule order, with the least and largest R, F and M score of each.
MART_SEGMENTS = [
    (CHAMPIONS, (4, 5), (4, 5), (4, 5)),
    (CANNOT_LOSE, (1, 2), (5, 5), (4, 5)),
    (AT_RISK, (1, 2), (3, 5), (1, 5)),
    (LOYAL, (3, 5), (4, 5), (1, 5)),
    (POTENTIAL, (4, 5), (2, 3), (1, 5)),
    (NEW, (5, 5), (1, 1), (1, 5)),
    (PROMISING, (4, 4), (1, 1), (1, 5)),
    (NEED_ATTENTION, (3, 3), (3, 5), (1, 5)),
    (ABOUT_TO_SLEEP, (3, 3), (1, 2), (1, 5)),
    (HIBERNATING, (1, 5), (1, 5), (1, 5)),
]
# --------------------------------------------------------------------------


def abc_class(share: Column, a: float = ABC_A, b: float = ABC_B, b_inclusive: bool = True) -> Column:
    """A up to ``a`` of cumulative share, B up to ``b``, else C (NULL → C)."""
    second = share <= F.lit(b) if b_inclusive else share < F.lit(b)
    return F.when(share <= F.lit(a), "A").when(second, "B").otherwise("C")


def xyz_class(x: Column, cut_x, cut_y) -> Column:
    """X up to ``cut_x``, Y up to ``cut_y``, else Z (NULL → Z)."""
    cx = cut_x if isinstance(cut_x, Column) else F.lit(cut_x)
    cy = cut_y if isinstance(cut_y, Column) else F.lit(cut_y)
    return F.when(x <= cx, "X").when(x <= cy, "Y").otherwise("Z")


def rfm_segment_mart(r: Column, f: Column, m: Column) -> Column:
    """The first rule whose ranges hold the three scores."""
    out = None
    for name, *ranges in MART_SEGMENTS:
        held = F.lit(True)
        for score, (least, most) in zip((r, f, m), ranges):
            held = held & score.between(least, most)
        out = F.when(held, name) if out is None else out.when(held, name)
    return out


def rfm_segment_study(rf_code: Column) -> Column:
    """Segment of a two-digit RF code; codes outside the map stay as they are."""
    out = None
    for pattern, name in STUDY_CODE_PATTERNS:
        cond = rf_code.rlike(f"^{pattern}$")
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out.otherwise(rf_code)


def class_ordinal(c: Column, order=CLASS_ORDER) -> Column:
    """1-based position of a class in the fixed report order (0 if absent)."""
    return F.array_position(F.array(*[F.lit(x) for x in order]), c).cast("int")
