"""Column -> Column helpers. All are built-in Spark expressions (codegen, no UDF)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, LongType


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_yyyymmdd(c, strict: bool = False, kind: DataType | None = None) -> Column:
    """yyyymmdd integer (or text) -> date.

    ``strict=False`` turns unparsable values into NULL (coerce); ``strict=True``
    fails the job on a bad value (ANSI ``to_date``). ``kind``: the column's type; whole numbers that are plainly
    calendar dates are taken apart by arithmetic, several times cheaper than as text, with the same result.
    """
    s = _c(c).cast("string")
    date = F.to_date(s, "yyyyMMdd") if strict else F.try_to_date(s, "yyyyMMdd")
    if not isinstance(kind, IntegerType | LongType):
        return date
    x = _c(c)
    year, month, day = (x / 10000).cast("int"), (x % 10000 / 100).cast("int"), (x % 100).cast("int")
    plain = x.between(10000101, 99991231) & month.between(1, 12) & (day >= 1) & (
        (day <= 28) | ((day <= 30) & (month != 2)))
    return F.when(plain, F.make_date(year, month, day)).otherwise(date)


def date_to_yyyymmdd(c) -> Column:
    """date / timestamp -> yyyymmdd integer (arithmetic, no string formatting)."""
    d = _c(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def yyyymmdd_add_days(c, days) -> Column:
    d = F.date_add(parse_yyyymmdd(c, strict=True), _c(days) if not isinstance(days, int) else F.lit(days))
    return date_to_yyyymmdd(d)


def clip(c, lo=None, hi=None) -> Column:
    """Clamp to [lo, hi]; NULL stays NULL (``greatest``/``least`` alone would skip it)."""
    x = _c(c)
    y = x
    if lo is not None:
        y = F.greatest(y, F.lit(lo))
    if hi is not None:
        y = F.least(y, F.lit(hi))
    return F.when(x.isNotNull(), y)


def row_sum(*cols) -> Column:
    """Row-wise sum where a NULL counts as 0."""
    out = None
    for c in cols:
        t = F.coalesce(_c(c), F.lit(0))
        out = t if out is None else out + t
    return out


def safe_ratio(n, d) -> Column:
    """n / d when d > 0 else NULL (plain ``/`` by zero raises under ANSI)."""
    den = _c(d)
    return F.when(den > 0, _c(n) / den)


def cut(c, edges: Sequence, labels: Sequence[str], include_lowest: bool = False) -> Column:
    """Right-closed buckets (a, b] like ``pandas.cut``; values outside -> NULL.

    ``include_lowest`` closes the first bucket on the left as well.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need len(edges) - 1 labels")
    x = _c(c)
    expr = None
    for i, lab in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        cond = ((x >= lo) if (i == 0 and include_lowest) else (x > lo)) & (x <= hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def cut_order(c, edges: Sequence, include_lowest: bool = False) -> Column:
    """Integer order of the bucket ``cut`` would assign (0-based), NULL outside."""
    x = _c(c)
    expr = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        cond = ((x >= lo) if (i == 0 and include_lowest) else (x > lo)) & (x <= hi)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def tenure_years(days, digits: int = 1) -> Column:
    """P10: tenure in years (days / 365) rounded half-to-even, as pandas rounds."""
    return F.bround(_c(days) / 365, digits)


def label_at(prob, thr: float = 0.5) -> Column:
    """Hard label: prob >= thr (the threshold itself counts as churn)."""
    return (_c(prob) >= F.lit(thr)).cast("int")


def confusion_label(label, pred) -> Column:
    y, p = _c(label), _c(pred)
    return (F.when((y == 1) & (p == 1), "TP").when((y == 0) & (p == 1), "FP")
            .when((y == 1) & (p == 0), "FN").when((y == 0) & (p == 0), "TN"))


# fixed values: risk bands of the scoring front end
RISK_BANDS = ((0.3, "low"), (0.5, "medium"))
# fixed values: risk bands of the result display
DISPLAY_BANDS = ((0.25, "low"), (0.5, "medium"))


def risk_band(prob, bands=RISK_BANDS) -> Column:
    x = _c(prob)
    return F.when(x < bands[0][0], bands[0][1]).when(x < bands[1][0], bands[1][1]).when(x.isNotNull(), "high")


def discount_cols(list_price="plan_list_price", paid="actual_amount_paid") -> tuple[Column, Column]:
    """Discount amount, and its share of the list price as decimal(18,8) (NULL without a positive list price)."""
    amount = _c(list_price) - _c(paid)
    return amount, safe_ratio(amount, _c(list_price)).cast("decimal(18,8)")


def key_hash(key: str, seed: int, buckets: int) -> Column:
    """Bucket of a key by the first 32 bits of md5(key ':' seed): the same number in any engine that has md5."""
    text = F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary")
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(buckets))


# Order-reversing map for numeric text: '-' < '.' < '0' < ... < '9' go to 'L' > 'K' > ... > 'A'.
_NUM_CHARS = "-.0123456789"
_REV_CHARS = "LKJIHGFEDCBA"


def desc_text_key(c) -> Column:
    """Sort key whose ascending order is the descending text order of ``c``.

    Valid for text made of digits, '.', '-' (the plan signature). The trailing
    'Z' sorts above every mapped character, so a prefix sorts after its
    extensions, as descending order requires.
    """
    return F.concat(F.translate(_c(c), _NUM_CHARS, _REV_CHARS), F.lit("Z"))


def count_less_sorted(arr, v, n: int) -> Column:
    """Number of elements of a sorted array column (length ``n``) that are < ``v``.

    An unrolled binary search (depth log2 n) of plain comparisons, so it stays
    inside whole-stage code generation, unlike a lambda ``filter`` over the array.
    """
    a, x = _c(arr), _c(v)

    def search(lo: int, hi: int) -> Column:
        # invariant: the first ``lo`` elements are < x, elements from ``hi`` on are >= x
        if lo >= hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.element_at(a, mid + 1) < x, search(mid + 1, hi)).otherwise(search(lo, mid))

    return search(0, n)
