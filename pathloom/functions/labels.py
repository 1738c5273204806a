"""Labels, numbers on shirts, maps and text."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNSURE, NOT_READ = "unsure", "N/A"
# Fixed value: the characters that are awkward in file names.
AWKWARD = r"[|@#!¡·$€%&()=?¿^*;:,¨´><+]"
# Numbers below 91 that the 91-class numbering of the common detection dataset leaves out.
MISSING_OF_91 = (12, 26, 29, 30, 45, 66, 68, 69, 71, 83)


def is_goalkeeper(team: Column) -> Column:
    return F.coalesce(team.contains("goalkeeper"), F.lit(False))


def is_referee(team: Column) -> Column:
    return F.coalesce(team.contains("referee"), F.lit(False))


def is_ball(team: Column) -> Column:
    return F.coalesce(team == "ball", F.lit(False))


def is_outfield(team: Column) -> Column:
    return ~(is_goalkeeper(team) | is_referee(team) | is_ball(team)) & F.coalesce(team != UNSURE, F.lit(False))


def base_team(team: Column) -> Column:
    """A team's name without the goalkeeper suffix."""
    return F.trim(F.replace(team, F.lit("goalkeeper"), F.lit("")))


def map_argmax(scores: Column, otherwise: str = "ball") -> Column:
    """The key with the largest value, the first of equal ones; `otherwise` for an empty or null map."""
    keyed = F.transform(F.map_entries(scores), lambda e, i: F.struct(e["value"].alias("v"), (-i).alias("i"), e["key"].alias("k")))
    return F.coalesce(F.array_max(keyed)["k"], F.lit(otherwise))


def similar_numbers(number: Column, roster: Column) -> Column:
    """The roster numbers that look like `number`, itself included: one digit is contained, more share the first or the last digit."""
    n = number.cast("string")
    short = F.length(n) == 1
    return F.filter(roster, lambda r: F.when(short, r.cast("string").contains(n)).otherwise((F.substring(r.cast("string"), 1, 1) == F.substring(n, 1, 1)) | (F.substring(r.cast("string"), -1, 1) == F.substring(n, -1, 1))))


def number_or(text: Column, otherwise: int = -1) -> Column:
    """A string of digits as a number, else `otherwise`."""
    return F.when(text.rlike(r"^\d{1,9}$"), text.cast("int")).otherwise(F.lit(otherwise))


def mean_of(values: Column) -> Column:
    """The mean of an array, null for an empty one."""
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda s, v: s + v) / F.size(values))


def valid_number(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v)


def display_number(number: Column, team: Column) -> Column:
    """How a player is shown: Ball, REF, GK, U for unsure, several candidates joined by a stroke."""
    return F.when(is_ball(team), "Ball").when(is_referee(team), "REF").when(is_goalkeeper(team), "GK").when(number.isNull() | (number == UNSURE), "U").otherwise(F.regexp_replace(F.regexp_replace(number, r"[\[\]\s]", ""), ",", "/"))


def normal_label(text: Column, longest: int = 25, lower: bool = True, keep: str = "a-z0-9") -> Column:
    """An OCR label without white space, folded, with unsupported characters dropped; null if empty or too long.
    Give it through fold_ascii() first where accents occur."""
    t = F.regexp_replace(text, r"\s+", "")
    t = F.when(F.length(t) <= longest, F.lower(t) if lower else t)
    t = F.regexp_replace(t, f"[^{keep}]", "")
    return F.when(t != "", t)


@F.pandas_udf(T.StringType())
def fold_ascii(text: pd.Series) -> pd.Series:
    """Compatibility decomposition without what isn't ASCII; the JVM has no built-in for it."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode())


def clean_name(text: Column) -> Column:
    """Characters that are awkward in file names replaced by an underscore."""
    return F.regexp_replace(text, AWKWARD, "_")


def edit_similarity(a: Column, b: Column) -> Column:
    """1 - edit distance over the longer length; 1 for two empty texts."""
    n = F.greatest(F.length(a), F.length(b))
    return F.when(n == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / n)


def ctc_collapse(ids: Column, blank: int = 0) -> Column:
    """Repeats collapsed, then blanks dropped."""
    kept = F.filter(F.transform(ids, lambda v, i: F.struct(v.alias("v"), (F.when(i > 0, ids[i - 1] != v).otherwise(True)).alias("new"))), lambda s: s["new"] & (s["v"] != blank))
    return F.transform(kept, lambda s: s["v"])


def greedy_decode(rows: Column, end: int = 0) -> tuple[Column, Column]:
    """(ids before the end token, probabilities up to and with it) of an array of probability rows."""
    best = F.transform(rows, lambda r: F.struct((F.array_position(r, F.array_max(r)) - 1).cast("int").alias("id"), F.array_max(r).alias("p")))
    at = F.coalesce(F.nullif(F.array_position(F.transform(best, lambda s: s["id"]), F.lit(end)), F.lit(0)), (F.size(best) + 1).cast("long")).cast("int")
    return F.transform(F.slice(best, F.lit(1), at - 1), lambda s: s["id"]), F.transform(F.slice(best, F.lit(1), F.least(at, F.size(best))), lambda s: s["p"])


def fitness(map50: Column, map_: Column) -> Column:
    return 0.1 * map50 + 0.9 * map_


def split_of(key: Column, train: float = 0.9) -> Column:
    """train or val by a hash of the key; reruns agree."""
    return F.when(F.pmod(F.xxhash64(key), F.lit(1000)) < int(train * 1000), "train").otherwise("val")


def letters(i: int) -> str:
    """0, 1, ... as a, b, ..., z, aa, ab, ..."""
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(97 + r) + out
    return out


def fit_length(values: Column, n: int) -> Column:
    """An array cut or filled with nulls to n entries."""
    return F.slice(F.concat(values, F.array_repeat(F.lit(None), n)), 1, n)


def content_key(paths: Column, sizes: Column) -> Column:
    """md5 of the total size and the paths, in order."""
    total = F.aggregate(sizes, F.lit(0).cast("long"), lambda s, v: s + v)
    return F.md5(F.concat(total.cast("string"), F.array_join(paths, "")))


def class_91(cls: Column) -> Column:
    """A class number of 0 to 79 in the numbering of 1 to 90 that has gaps."""
    numbers = [i for i in range(1, 91) if i not in MISSING_OF_91]
    return F.get(F.array(*map(F.lit, numbers)), cls.cast("int"))


def detection_text(name: Column, conf: Column) -> Column:
    """How a detection is labelled: its class and its confidence to two places."""
    return F.format_string("%s %.2f", name, conf)


def class_counts(counts: Column) -> Column:
    """A text of an array of (name, n): `3 persons, 1 ball`."""
    return F.array_join(F.transform(counts, lambda c: F.concat(c["n"].cast("string"), F.lit(" "), c["name"], F.when(c["n"] > 1, "s").otherwise(""))), ", ")
