"""Toxicity scores: boosted trees over dense features of whole texts, calibrated isotonically."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from operator import mul

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, written
from .trees import BoostedTrees, Constant, Isotonic

# Common insults and second-person pronouns of four languages.
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb loser losers trash scum clown clowns pathetic worthless disgusting fool foolish jerk creep liar ugly vermin filth filthy "
    "garbage imbecile imbeciles cretin bastard bastards shit bitch crap hate idiotisch dumm dummkopf arschloch trottel abschaum versager "
    "connard imbécile salaud crétin ordure débile estúpido tonto imbécil basura cabrón asqueroso".split()
)
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi vous ton ta tes votre vos tú usted ustedes vosotros".split())
#: Characters that stand for letters in disguised words.
DISGUISE = str.maketrans("013457@$!|+", "oieastasilt")

FEATURES = (
    "log_words insult_count insult_density hidden_count hidden_density strong_count strong_density weak_count weak_density best_odds sum_odds "
    "near_second second_density capitals caps_words exclaims questions punctuation stars disguised repeats unique_share mean_length non_ascii digits"
).split()


@dataclass(frozen=True)
class Toxicity:
    """At most `rows` labelled rows are fitted on, chosen by a hash of doc_id within each label; the rarer label has up to half of them.

    Stems of words are learnt from a log-likelihood ratio of `weak` on, and held for strong signs from `strong` on.
    """

    rows: int = 20_000
    folds: int = 4
    weak: float = 12.0
    strong: float = 25.0


_EDGE = re.compile(r"^[^\w@$]+|[^\w@$]+$")
_INNER = re.compile(r"[^\W\d_][^\w\s'’-]+[^\W\d_]|[^\W\d_]\d+[^\W\d_]")
_APART = re.compile(r"[^\w]|_")
_REPEAT = re.compile(r"(.)\1+")
#: First and last letter of every insult; repeats that are taken out of a word leave both.
_ENDS = frozenset(w[0] + w[-1] for w in INSULTS)

#: Bytes of UTF-8 texts that stand for one ASCII character each.
_ASCII = bytes(range(128))
_EDGES = "".join(c for c in map(chr, _ASCII) if not c.isalnum() and c not in "_@$")
_UPPER, _DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
_MARKS = bytes(i for i in _ASCII if not chr(i).isalnum() and not chr(i).isspace())


def bare(token: str) -> str:
    """A token without what `_EDGE` matches; most tokens need no regular expression for that."""
    word = token.strip(_EDGES)
    return word if word.isalnum() else _EDGE.sub("", token)


def stems_of(word: str) -> list[str]:
    """Openings of a word that can be learnt as signs; short words whole."""
    return [word[:n] for n in (4, 5, 6) if len(word) >= n] or [word]


class Words(dict):
    """Token to the length of its word, and `facts` of the few tokens that count for more, under one lexicon: stem to (log odds, strong or not)."""

    def __init__(self, lexicon: dict[str, tuple[float, bool]]):
        super().__init__()
        self.lexicon, self.openings, self.facts = lexicon, {s[:4] for s in lexicon}, {}

    def __missing__(self, token: str) -> int:
        word = token.strip(_EDGES)
        if not word.isalpha() or word[0] + word[-1] in _ENDS or word[:4] in self.openings or word in SECOND_PERSON:
            word = self._fact(token)
        n = self[token] = len(word)
        return n

    def _fact(self, token: str) -> str:
        """The token's word; what is known of it goes to `facts`, if anything."""
        word = bare(token)
        insult, second = word in INSULTS, word in SECOND_PERSON
        plain = joined = word
        inner = False
        if not word.isalpha():  # letters alone disguise nothing
            plain = word.translate(DISGUISE)
            joined = plain if plain.isalnum() else _APART.sub("", plain)
            inner = bool(_INNER.search(word))
        hidden = not insult and (plain in INSULTS or joined in INSULTS or (joined[:1] + joined[-1:] in _ENDS and _REPEAT.sub(r"\1", joined) in INSULTS))
        signs = [self.lexicon[s] for s in stems_of(word) if s in self.lexicon] if word[:4] in self.openings else []
        if insult or hidden or signs or second or inner:
            odds, strong = max(signs, default=(0.0, False))
            self.facts[token] = (insult, hidden, strong, bool(signs), odds, second, inner)
        return word

    def clear(self) -> None:
        super().clear()
        self.facts.clear()


class Reader:
    """Features of texts under one lexicon. Up to `limit` tokens are remembered beside those of a text."""

    def __init__(self, lexicon: dict[str, tuple[float, bool]], limit: int = 200_000):
        self.words, self.limit = Words(lexicon), limit

    def row(self, text: str | None) -> list[float]:
        text = text or ""
        lower = text.lower().split()
        n, chars = len(lower), max(1, len(text))
        counts = Counter(lower)
        if len(self.words) >= self.limit:
            self.words.clear()
        letters = sum(map(mul, map(self.words.__getitem__, counts), counts.values()))
        insult = hidden = strong = weak = second = disguised = 0
        best = total = 0.0
        facts = self.words.facts
        marked, meant = set(), set()
        for token in filter(facts.__contains__, counts):
            f, c = facts[token], counts[token]
            if f[0] or f[1] or f[3]:
                insult += c * f[0]
                hidden += c * f[1]
                strong += c * f[2]
                weak += c * (f[3] and not f[2])
                best, total = max(best, f[4]), total + f[4] * c
                marked.add(token)
            if f[5]:
                second += c
                meant.add(token)
            disguised += c * f[6]
        near = 0
        if marked and second:
            places = [i for i, t in enumerate(lower) if t in meant]
            k = 0
            for i, t in enumerate(lower):
                if t in marked:
                    while k + 1 < len(places) and abs(places[k + 1] - i) <= abs(places[k] - i):
                        k += 1
                    near += abs(places[k] - i) <= 5
        w = max(1, n)
        data = text.encode("utf-8", "surrogatepass")
        of = lambda some: len(data) - len(data.translate(None, some))
        others = Counter(data.translate(None, _ASCII).decode("utf-8", "surrogatepass"))
        upper = of(_UPPER) + sum(k for c, k in others.items() if c.isupper())
        marks = of(_MARKS) + sum(k for c, k in others.items() if not c.isalnum() and not c.isspace())
        shouted = sum(len(t) > 2 for t in filter(str.isupper, text.split())) if upper else 0
        return [
            np.log1p(n), insult, insult / w, hidden, hidden / w, strong, strong / w, weak, weak / w, best, total,
            near / w, second / w, upper / chars, shouted / w, data.count(b"!") / w, data.count(b"?") / w, marks / chars, of(b"*$#@") / w,
            disguised / w, (max(counts.values()) / w) if counts else 0.0, len(counts) / w, letters / w, len(data) / chars - 1, of(_DIGITS) / chars,
        ]

    def matrix(self, texts) -> np.ndarray:
        return np.array([self.row(t) for t in texts], float).reshape(-1, len(FEATURES))


def held_out(doc_id):
    """crc32 of doc_id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _surprise(tox, non, all_tox, all_non):
    """Signed log-likelihood ratio (G squared) of a stem that `tox` toxic and `non` other texts hold."""
    n, rate = tox + non, all_tox / max(1, all_tox + all_non)
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (np.where(tox > 0, tox * np.log(tox / (n * rate)), 0) + np.where(non > 0, non * np.log(non / (n * (1 - rate))), 0))
    return np.where(tox > n * rate, g, 0.0)


def _lexicon(names, tox, non, all_tox, all_non, p: Toxicity) -> dict[str, tuple[float, bool]]:
    g = _surprise(tox, non, all_tox, all_non)
    odds = np.log((tox + 0.5) / (all_tox + 1)) - np.log((non + 0.5) / (all_non + 1))
    keep = (g >= p.weak) & (tox >= 3) & (odds > 1)
    return {s: (float(o), bool(v >= p.strong and o > 2)) for s, o, v, k in zip(names, odds, g, keep) if k}


class Model:
    """What scoring needs: the lexicon, the trees, the calibration and how many rows of each label a sampled one stands for. `score`
    gives values in [0, 1]."""

    def __init__(self, lexicon, trees, calibration, weights=(1.0, 1.0)):
        self.lexicon, self.trees, self.calibration, self.weights, self.reader = lexicon, trees, calibration, weights, None

    def __getstate__(self):
        return {**self.__dict__, "reader": None}

    def score(self, texts) -> np.ndarray:
        self.reader = self.reader or Reader(self.lexicon)
        x = self.reader.matrix(texts)
        score = np.clip(self.calibration(self.trees.margins(x)), 0.0, 1.0)
        clean, toxic = self.weights
        return score * toxic / np.maximum(score * toxic + (1 - score) * clean, 1e-300)


def fit(docs: DataFrame, labels: DataFrame, p: Toxicity = Toxicity()) -> Model:
    """Learns from labelled rows that aren't held out, p.rows of them at most. Rows with a null label or doc_id are left out.

    Stem counts are taken in Spark; the driver gets those of significant stems and a row of features for each sampled text.
    Training features use the stems of the other folds, so that a stem is trusted as far as it holds on texts
    it wasn't learnt from; calibration uses margins of models that didn't see the row.
    """
    bounded_batches(docs.sparkSession)
    key = F.col("doc_id").cast("long")
    truth = labels.select(key.alias("doc_id"), F.col("toxic").cast("int").alias("y")).filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1)).filter(~held_out(F.col("doc_id")))
    truth = truth.groupBy("doc_id").agg(F.max("y").alias("y"))
    there = {r["y"]: r["n"] for r in truth.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not there:
        return Model({}, BoostedTrees(np.zeros((0, len(FEATURES))), np.zeros(0)), Constant(0.0))
    few = min(there.get(0, 0), there.get(1, 0), p.rows // 2)
    take = {y: min(n, max(few, p.rows - few)) for y, n in there.items()}
    parts = [truth.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in sorted(take.items())]
    chosen = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    texts = docs.select(key.alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")  # p.rows pairs at most
    texts = written(texts.withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(p.folds))), "toxicity-sample")
    whole = {(r["fold"], r["y"]): r["n"] for r in texts.groupBy("fold", "y").agg(F.count("*").alias("n")).collect()}
    size = lambda y, without=None: sum(n for (f, t), n in whole.items() if t == y and f != without)

    def count(batches):
        for batch in batches:
            found: dict[tuple[int, int], Counter] = {}
            for text, y, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = {bare(t) for t in set((text or "").lower().split())}
                found.setdefault((f, y), Counter()).update({w[:n] for w in words for n in (4, 5, 6) if w})  # all of stems_of
            for (f, y), c in found.items():
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array([f * 2 + y] * len(c), pa.int64()), pa.array(list(c.values()), pa.int64())], ["stem", "kind", "n"])

    counted = texts.select("text", "y", "fold").mapInArrow(count, "stem string, kind long, n long")
    sums = [F.sum(F.when(F.col("kind") == i, F.col("n")).otherwise(0)).alias(f"k{i}") for i in range(2 * p.folds)]
    wide = counted.groupBy("stem").agg(*sums)

    def signs(without=None):
        """Whether a stem's log-likelihood ratio reaches p.weak, leaving out one fold."""
        tox, non = (sum((F.col(f"k{2 * f + y}") for f in range(p.folds) if f != without), F.lit(0)).cast("double") for y in (1, 0))
        rate = size(1, without) / max(1, size(0, without) + size(1, without))
        if not 0 < rate < 1:
            return F.lit(False)
        part = lambda x, share: F.when(x > 0, x * F.log(x / ((tox + non) * share))).otherwise(0.0)
        return (tox >= 3) & (tox > (tox + non) * rate) & (2 * (part(tox, rate) + part(non, 1 - rate)) >= p.weak)

    found = F.lit(False)
    for f in (None, *range(p.folds)):
        found = found | signs(f)
    top = wide.filter(found).orderBy("stem").toPandas()
    per = top[[f"k{i}" for i in range(2 * p.folds)]].to_numpy(float) if len(top) else np.zeros((0, 2 * p.folds))
    names = top["stem"].tolist()
    lexicon = lambda without=None: _lexicon(
        names, per[:, 1::2].sum(1) - (per[:, 2 * without + 1] if without is not None else 0), per[:, ::2].sum(1) - (per[:, 2 * without] if without is not None else 0), size(1, without), size(0, without), p
    )
    by_fold = [lexicon(f) for f in range(p.folds)]

    def featured(batches):
        readers = [Reader(x) for x in by_fold]
        for batch in batches:
            rows = [readers[f].row(t) for t, f in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), batch.column(3), pa.array(rows, pa.list_(pa.float64()))], ["y", "fold", "doc_id", "x"])

    data = texts.select("text", F.col("y").cast("long"), "fold", "doc_id").mapInArrow(featured, "y long, fold long, doc_id long, x array<double>").toPandas().sort_values("doc_id", kind="stable")
    x, y, fold = np.array(data["x"].tolist(), float).reshape(-1, len(FEATURES)), data["y"].to_numpy(float), data["fold"].to_numpy()
    margins = np.zeros(len(y))
    for f in range(p.folds):
        here = fold == f
        if here.any():
            margins[here] = BoostedTrees(x[~here], y[~here]).margins(x[here])
    weights = tuple(there.get(t, 0) / take.get(t, 1) for t in (0, 1)) if len(there) == 2 else (1.0, 1.0)
    return Model(lexicon(), BoostedTrees(x, y), Isotonic(margins, y) if len(y) else Constant(0.0), weights)


def score_toxicity(docs: DataFrame, labels: DataFrame, p: Toxicity = Toxicity()) -> DataFrame:
    """`docs` (doc_id, text, ...) with the columns held_out, score and predicted, which replace columns of these names.

    Cases: a null text is an empty one; both get a score. A null doc_id isn't held out and gets a score too. Repeated rows are
    scored alike, so ties are equal scores. Where labels hold one value only, that is every score; without labels scores are 0. An empty
    table gives no rows. Whole texts are read, however long. Scores never depend on doc_id, lang, source or labels of the scored row.
    """
    bounded_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, p))  # bounded by the words of a sample of p.rows texts, and the trees

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(model.value.score(text), dtype="float64")

    out = docs.withColumn("score", score(F.col("text"))).withColumn("held_out", held_out(F.col("doc_id")))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
