"""Axis-parallel boxes as column expressions; a box is four columns x1, y1, x2, y2."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-7


def corners(cx, cy, w, h):
    """Centre and size to corners."""
    return cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2


def centre(x1, y1, x2, y2):
    """Corners to centre and size."""
    return (x1 + x2) / 2, (y1 + y2) / 2, x2 - x1, y2 - y1


def to_pixels(box, width, height, pad_x=0.0, pad_y=0.0):
    """Normalised centre form to pixel corners, shifted by padding."""
    x1, y1, x2, y2 = corners(*box)
    return x1 * width + pad_x, y1 * height + pad_y, x2 * width + pad_x, y2 * height + pad_y


def to_normalised(box, width, height):
    """Pixel corners to normalised centre form."""
    cx, cy, w, h = centre(*box)
    return cx / width, cy / height, w / width, h / height


def clip(box, width, height):
    x1, y1, x2, y2 = box
    hold = lambda v, top: F.greatest(F.lit(0.0), F.least(v, F.lit(float(top))))
    return hold(x1, width), hold(y1, height), hold(x2, width), hold(y2, height)


def unletterbox(box, from_size, to_size):
    """From an image of from_size (width, height), scaled with padding to keep the aspect, back to to_size, clipped."""
    gain = min(from_size[0] / to_size[0], from_size[1] / to_size[1])
    px, py = (from_size[0] - to_size[0] * gain) / 2, (from_size[1] - to_size[1] * gain) / 2
    x1, y1, x2, y2 = box
    return clip(((x1 - px) / gain, (y1 - py) / gain, (x2 - px) / gain, (y2 - py) / gain), *to_size)


def expand(box, gain: float = 1.02, pad: float = 10.0, square: bool = False):
    cx, cy, w, h = centre(*box)
    if square:
        w = h = F.greatest(w, h)
    return corners(cx, cy, w * gain + pad, h * gain + pad)


def sub_rectangle(box, left: float, top: float, right: float, bottom: float, width, height):
    """The part of a box between ratios of its sides, clipped to the image."""
    x1, y1, x2, y2 = box
    w, h = x2 - x1, y2 - y1
    return clip((x1 + w * left, y1 + h * top, x1 + w * right, y1 + h * bottom), width, height)


def area(box) -> Column:
    x1, y1, x2, y2 = box
    return (x2 - x1) * (y2 - y1)


def intersection(a, b) -> Column:
    w = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    h = F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    return w * h


def iou(a, b, kind: str = "iou", width: float = 1.0, height: float = 1.0) -> Column:
    """Intersection over union, or its generalised, distance, complete or corner-distance form (iou, giou, diou, ciou, mpdiou)."""
    both = intersection(a, b)
    union = area(a) + area(b) - both + EPS
    value = both / union
    if kind == "iou":
        return value
    cw, ch = F.greatest(a[2], b[2]) - F.least(a[0], b[0]), F.greatest(a[3], b[3]) - F.least(a[1], b[1])
    if kind == "giou":
        hull = cw * ch + EPS
        return value - (hull - union) / hull
    if kind == "mpdiou":
        first = (a[0] - b[0]) * (a[0] - b[0]) + (a[1] - b[1]) * (a[1] - b[1])
        last = (a[2] - b[2]) * (a[2] - b[2]) + (a[3] - b[3]) * (a[3] - b[3])
        return value - (first + last) / (width * width + height * height)
    dx, dy = (a[0] + a[2] - b[0] - b[2]) / 2, (a[1] + a[3] - b[1] - b[3]) / 2
    far = (dx * dx + dy * dy) / (cw * cw + ch * ch + EPS)
    if kind == "diou":
        return value - far
    if kind == "ciou":
        shape = lambda q: F.atan((q[2] - q[0]) / (q[3] - q[1] + EPS))
        v = 4 / math.pi**2 * (shape(a) - shape(b)) * (shape(a) - shape(b))
        return value - (far + v * v / (v - value + 1 + EPS))
    raise ValueError(kind)


def over_smaller(a, b) -> Column:
    """Intersection over the smaller area, with 1e-6 added."""
    return intersection(a, b) / (F.least(area(a), area(b)) + 1e-6)


def area_ratio(a, b) -> Column:
    """Smaller area over larger area, with 1e-6 added."""
    return F.least(area(a), area(b)) / (F.greatest(area(a), area(b)) + 1e-6)


def over_second(a, b) -> Column:
    """The share of the second box that the first covers."""
    return intersection(a, b) / (area(b) + EPS)


def plausible(before, after, least_side: float = 2.0, most_aspect: float = 100.0, least_area: float = 0.1) -> Column:
    """Whether a box that was moved or cut is still worth keeping."""
    w1, h1, w2, h2 = before[2] - before[0], before[3] - before[1], after[2] - after[0], after[3] - after[1]
    aspect = F.greatest(w2 / (h2 + 1e-16), h2 / (w2 + 1e-16))
    return (w2 > least_side) & (h2 > least_side) & (w2 * h2 / (w1 * h1 + 1e-16) > least_area) & (aspect < most_aspect)


def tiles(width: int, height: int, tile: int, overlap: int) -> list[tuple[int, int, int, int]]:
    """Overlapping tiles over an image; where steps don't fit, one more tile ends at the edge."""

    def starts(size):
        if size <= tile:
            return [0]
        out = list(range(0, size - tile + 1, tile - overlap))
        return out if out[-1] + tile >= size else [*out, size - tile]

    return [(x, y, min(x + tile, width), min(y + tile, height)) for y in starts(height) for x in starts(width)]


def polygon_box(points: Column, width, height):
    """The bounding box of those points (x, y) of a polygon that lie in the image."""
    kept = F.filter(points, lambda p: p["x"].between(0, width) & p["y"].between(0, height))
    xs, ys = F.transform(kept, lambda p: p["x"]), F.transform(kept, lambda p: p["y"])
    return F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)


def unletterbox_points(points: Column, from_size, to_size) -> Column:
    """Points (x, y) of a segment brought back as unletterbox() does with boxes."""
    gain = min(from_size[0] / to_size[0], from_size[1] / to_size[1])
    px, py = (from_size[0] - to_size[0] * gain) / 2, (from_size[1] - to_size[1] * gain) / 2
    hold = lambda v, top: F.greatest(F.lit(0.0), F.least(v, F.lit(float(top))))
    return F.transform(points, lambda p: F.struct(hold((p["x"] - px) / gain, to_size[0]).alias("x"), hold((p["y"] - py) / gain, to_size[1]).alias("y")))


def resampled(points: Column, n: int) -> Column:
    """`n` points (x, y), evenly spaced by number along a closed polygon, whose first point is its last again."""
    # the array isn't built anew for the last point: within a lambda that would be done for each of the n
    size = F.size(points)
    step = size / F.lit(float(n - 1))
    place = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct((i * step).alias("t"), F.least(F.floor(i * step).cast("int"), size - 1).alias("low")))

    def at(p: Column) -> Column:
        low, share = p["low"], p["t"] - p["low"]
        a, b = F.get(points, low), F.get(points, F.when(low + 1 < size, low + 1).otherwise(0))
        return F.struct((a["x"] + (b["x"] - a["x"]) * share).alias("x"), (a["y"] + (b["y"] - a["y"]) * share).alias("y"))

    return F.transform(place, at)


def four_forms(box, width, height) -> dict[str, tuple]:
    """A box by name of its form: xyxy, xywh, and both as shares of the image."""
    x1, y1, x2, y2 = box
    return {"xyxy": tuple(box), "xywh": centre(*box), "xyxyn": (x1 / width, y1 / height, x2 / width, y2 / height), "xywhn": to_normalised(box, width, height)}


def height_corrected(box, expected: Column, most: float = 0.2):
    """A box whose height strays from the expected one by more than `most` of it gets that height, its feet staying where they are."""
    x1, y1, x2, y2 = box
    h = y2 - y1
    return x1, F.when(expected.isNotNull() & (F.abs(h - expected) > most * expected), y2 - expected).otherwise(y1), x2, y2
