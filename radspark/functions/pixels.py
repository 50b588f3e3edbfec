"""Pixel arithmetic on ``array<double>`` columns, as higher-order expressions.

For small images and thumbnails; whole-size images go through the NumPy
kernels in one Arrow hop. Images are row by row: index = row * width + column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rescale(a: Column, slope: float | Column = 1.0, intercept: float | Column = 0.0) -> Column:
    return F.transform(a, lambda v: v * slope + intercept)


def lookup(a: Column, table: Column, first: int = 0) -> Column:
    """Modality table: entry of each truncated value, clipped to the table's ends."""
    at = lambda v: F.greatest(F.lit(0), F.least(F.size(table) - 1, v.cast("int") - first)) + 1
    return F.transform(a, lambda v: F.element_at(table, at(v)))


def window(a: Column, center: float, width: float) -> Column:
    """Clip to the window and scale to 0..1; a width of 0 or less changes nothing."""
    if width <= 0:
        return a
    lo, hi = center - width / 2, center + width / 2
    return F.transform(a, lambda v: (F.greatest(F.lit(lo), F.least(F.lit(hi), v)) - lo) / (hi - lo))


def invert(a: Column, top: Column | None = None) -> Column:
    """``top - v``; the image's own maximum where no ``top`` is given."""
    return F.transform(a, lambda v: (F.array_max(a) if top is None else top) - v)


def fixed_range(a: Column, bits: int, signed: bool = False, clip_negative: bool = True) -> Column:
    if signed:
        return F.transform(a, lambda v: (v + float(1 << (bits - 1))) / float((1 << bits) - 1))
    own = (lambda v: F.greatest(v, F.lit(0.0))) if clip_negative else (lambda v: v)
    return F.transform(a, lambda v: own(v) / float((1 << bits) - 1))


def min_max(a: Column) -> Column:
    """Scale to 0..1; a constant image becomes zeros."""
    bound = F.array(F.struct(F.array_min(a).alias("lo"), F.array_max(a).alias("hi")))
    return F.transform(bound, lambda b: F.transform(a, lambda v: F.when(b["hi"] > b["lo"], (v - b["lo"]) / (b["hi"] - b["lo"])).otherwise(0.0)))[0]


def percentile_of(sorted_a: Column, p: float) -> Column:
    """Linear interpolation in a sorted array, ``p`` from 0 to 1."""
    h = F.lit(p) * (F.size(sorted_a) - 1)
    low = F.floor(h).cast("int")
    x = F.element_at(sorted_a, low + 1)
    y = F.element_at(sorted_a, F.least(low + 2, F.size(sorted_a)))
    return x + (h - low) * (y - x)


def percentile_scale(a: Column, low: float = 0.005, high: float = 0.995) -> Column:
    """Clip to two percentiles and scale to 0..1; without spread: zeros."""
    s = F.array(F.sort_array(a))
    bound = F.transform(s, lambda x: F.struct(percentile_of(x, low).alias("lo"), percentile_of(x, high).alias("hi")))
    return F.transform(bound, lambda b: F.transform(a, lambda v: F.when(b["hi"] > b["lo"], (F.greatest(b["lo"], F.least(b["hi"], v)) - b["lo"]) / (b["hi"] - b["lo"])).otherwise(0.0)))[0]


def mean(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, v: s + v) / F.size(a)


def deviation(a: Column) -> Column:
    """Population standard deviation."""
    m = F.array(mean(a))
    return F.transform(m, lambda mu: F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, v: s + (v - mu) * (v - mu)) / F.size(a)))[0]


def z_score(a: Column, least: float = 1e-8, constant: str = "zeros") -> Column:
    """``(v - mean) / std``; images with std of ``least`` or less become zeros or stay (``keep``)."""
    facts = F.array(F.struct(mean(a).alias("m"), deviation(a).alias("s")))
    return F.transform(facts, lambda b: F.transform(
        a, lambda v: F.when(b["s"] > least, (v - b["m"]) / b["s"]).otherwise(F.lit(0.0) if constant == "zeros" else v)))[0]


def equalise(a: Column, bins: int = 16) -> Column:
    """Histogram equalisation; a constant image becomes zeros.

    Bins are equal parts of the image's range, the last one closed.
    """
    bound = F.array(F.struct(F.array_min(a).alias("lo"), F.array_max(a).alias("hi")))

    def one(b: Column) -> Column:
        bin_of = lambda v: F.least(F.floor((v - b["lo"]) / ((b["hi"] - b["lo"]) / bins)), F.lit(bins - 1)).cast("int")
        counts = F.aggregate(F.when(b["hi"] > b["lo"], F.transform(a, bin_of)), F.array_repeat(F.lit(0), bins),
                             lambda acc, k: F.transform(acc, lambda c, i: c + (i == k).cast("int")))
        # one-element arrays bind what would be computed anew for every pixel
        cdf = F.transform(F.array(counts), lambda n: F.transform(n, lambda _, i: F.aggregate(F.slice(n, F.lit(1), i + 1), F.lit(0), lambda s, c: s + c)))[0]
        ends = F.transform(F.array(cdf), lambda c: F.struct(c.alias("cdf"), F.array_min(F.filter(c, lambda v: v > 0)).alias("least"), F.element_at(c, -1).alias("last")))
        scaled = F.transform(ends, lambda f: F.transform(a, lambda v: (F.element_at(f["cdf"], bin_of(v) + 1) - f["least"]).cast("double") / F.greatest(f["last"] - f["least"], F.lit(1))))[0]
        return F.when(b["hi"] > b["lo"], scaled).otherwise(F.transform(a, lambda v: F.lit(0.0)))

    return F.transform(bound, one)[0]


def flip(a: Column, height: int, width: int) -> Column:
    """Mirror left to right."""
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(height - 1)), lambda r: F.reverse(F.slice(a, r * width + 1, F.lit(width)))))


def half_masses(a: Column, width: int) -> Column:
    """Sums of the left and the right half of the columns."""
    half = width // 2
    part = lambda left: F.aggregate(F.transform(a, lambda v, i: F.when((i % width < half) == left, v).otherwise(0.0)), F.lit(0.0), lambda s, v: s + v)
    return F.struct(part(True).alias("left"), part(False).alias("right"))


def orientation(a: Column, width: int) -> Column:
    """LEFT, RIGHT or UNKNOWN by where the mass lies; near a tie, by the centre of mass."""
    facts = F.array(F.struct(half_masses(a, width).alias("m"), F.aggregate(F.transform(a, lambda v, i: v * (i % width)), F.lit(0.0), lambda s, v: s + v).alias("c")))

    def judge(b: Column) -> Column:
        left, right = b["m"]["left"], b["m"]["right"]
        ratio = left / F.greatest(right, F.lit(1e-8))
        centre = b["c"] / F.when(left + right == 0, None).otherwise(left + right)
        return (F.when(left + right < 1e-8, "UNKNOWN").when(ratio > 1.1, "LEFT").when(ratio < 0.9, "RIGHT")
                .when(centre < width // 2, "LEFT").otherwise("RIGHT"))

    return F.transform(facts, judge)[0]


def crop(a: Column, width: int, y1: int, x1: int, y2: int, x2: int) -> Column:
    """Rows y1..y2 and columns x1..x2, ends exclusive."""
    return F.flatten(F.transform(F.sequence(F.lit(y1), F.lit(y2 - 1)), lambda r: F.slice(a, r * width + (x1 + 1), F.lit(x2 - x1))))


def center_crop(a: Column, height: int, width: int, to_height: int, to_width: int) -> Column:
    """Middle part; where a side is too short, padding takes over."""
    if height < to_height or width < to_width:
        return pad(a, height, width, to_height, to_width)
    y, x = (height - to_height) // 2, (width - to_width) // 2
    return crop(a, width, y, x, y + to_height, x + to_width)


def pad(a: Column, height: int, width: int, to_height: int, to_width: int, fill: float = 0.0, center: bool = True) -> Column:
    """Place on a canvas of at least the target size, then cut to it from the top left."""
    if height >= to_height and width >= to_width:
        return crop(a, width, 0, 0, to_height, to_width)
    y = max(0, (to_height - height) // 2) if center else 0
    x = max(0, (to_width - width) // 2) if center else 0

    def cell(k: Column) -> Column:
        r, c = F.floor(k / to_width).cast("int") - y, (k % to_width).cast("int") - x
        return F.when((r >= 0) & (r < height) & (c >= 0) & (c < width), F.get(a, r * width + c)).otherwise(F.lit(fill))

    return F.transform(F.sequence(F.lit(0), F.lit(to_height * to_width - 1)), cell)


def bounding_box(a: Column, width: int, height: int, above: float = 0.0, padding: int = 0) -> Column:
    """y1, x1, y2, x2 (ends exclusive) of values above a bound; the whole image where there are none."""
    inside = F.array(F.filter(F.transform(a, lambda v, i: F.when(v > above, i)), lambda i: i.isNotNull()))

    def box(k: Column) -> Column:
        rows, cols = F.transform(k, lambda i: F.floor(i / width).cast("int")), F.transform(k, lambda i: (i % width).cast("int"))
        none = F.size(k) == 0
        side = lambda v, whole: F.when(none, whole).otherwise(v).cast("int")
        return F.struct(side(F.greatest(F.array_min(rows) - padding, F.lit(0)), F.lit(0)).alias("y1"), side(F.greatest(F.array_min(cols) - padding, F.lit(0)), F.lit(0)).alias("x1"),
                        side(F.least(F.array_max(rows) + 1 + padding, F.lit(height)), F.lit(height)).alias("y2"),
                        side(F.least(F.array_max(cols) + 1 + padding, F.lit(width)), F.lit(width)).alias("x2"))

    return F.transform(inside, box)[0]
