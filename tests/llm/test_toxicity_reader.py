"""Features of op6_toxicity against a plain version, and what they cost."""

import cProfile
import random
import re
import string
from collections import Counter

import numpy as np

from pathloom.llm import toxicity as tox

ODD = [
    None, "", " ", "...", "$", "@@@ _ __idiot__", "ΣΑΣ ΣΑΣ. ΑΣ", "İ İstanbul ß ẞ", "\ud800x \udfff", "\x1c a\x1eb", "　idiot　you", "１２３ a１b ①idiot② ª", "ǅ ǅabc ǄǄǄ",
    "don’t stu-pid st*u*p*i*d", "s.h.i.t you", "$tup1d 1d10t !d!ot", "iiidddiottt YOU", "“you idiot!”", "漢字 かな 。、", "٣٤ a٣b", "you " * 90 + "idiot " * 90, "fool foool f00l", "áb é, ́",
]


def plain(text, lexicon):
    """As FEATURES says, one token and one character after the other."""
    text = text or ""
    lower, chars = text.lower().split(), max(1, len(text))
    w, n = max(1, len(lower)), Counter()
    odds, marked, second = [], [], []
    for token in lower:
        word = re.sub(r"^[^\w@$]+|[^\w@$]+$", "", token)
        loose = word.translate(tox.DISGUISE)
        joined = re.sub(r"[^\w]|_", "", loose)
        insult = word in tox.INSULTS
        hidden = not insult and bool({loose, joined, re.sub(r"(.)\1+", r"\1", joined)} & tox.INSULTS)
        signs = [lexicon[s] for s in tox.stems_of(word) if s in lexicon]
        best, strong = max(signs, default=(0.0, False))
        n.update(insult=insult, hidden=hidden, strong=strong, weak=bool(signs) and not strong, letters=len(word))
        n["disguised"] += bool(re.search(r"[^\W\d_][^\w\s'’-]+[^\W\d_]|[^\W\d_]\d+[^\W\d_]", word))
        odds.append(best)
        marked.append(insult or hidden or bool(signs))
        second.append(word in tox.SECOND_PERSON)
    near = sum(m and any(second[max(0, i - 5) : i + 6]) for i, m in enumerate(marked))
    marks = Counter(c for c in text if not c.isalnum() and not c.isspace())
    counts = [n["insult"], n["hidden"], n["strong"], n["weak"]]
    return [
        np.log1p(len(lower)), *(v for c in counts for v in (c, c / w)), max(odds, default=0.0), sum(odds),
        near / w, sum(second) / w, sum(c.isupper() for c in text) / chars, sum(t.isupper() and len(t) > 2 for t in text.split()) / w, marks["!"] / w, marks["?"] / w,
        sum(marks.values()) / chars, sum(marks[c] for c in "*$#@") / w, n["disguised"] / w, max(Counter(lower).values(), default=0) / w, len(set(lower)) / w, n["letters"] / w,
        len(text.encode("utf-8", "surrogatepass")) / chars - 1, sum(c in string.digits for c in text) / chars,
    ]


def odd_text(rng):
    known = sorted(tox.INSULTS | tox.SECOND_PERSON)
    out = []
    for _ in range(rng.randrange(40)):
        word = rng.choice(known) if rng.random() < 0.5 else "".join(rng.choices("abcdeéßжµ漢٣²0145", k=rng.randrange(1, 9)))
        for _ in range(rng.randrange(3)):
            i = rng.randrange(len(word) + 1)
            word = rng.choice([word[:i] + rng.choice("!$@|+*#-_.'’01345…ǅ́") + word[i:], word[:i] + word[max(0, i - 1) : i] * 2 + word[i:], word.upper(), word.title()])
        out.append(word + rng.choice(["", "", ".", ",", "!!", "?", "$$$", "»"]) + rng.choice(" \n\t \x1c"))
    return "".join(out)


def test_features_are_those_of_a_plain_version():
    rng = random.Random(4)
    texts = ODD + [odd_text(rng) for _ in range(1500)]
    stems = sorted({s for t in texts for w in (t or "").lower().split() for s in tox.stems_of(tox.bare(w))})
    for lexicon in ({s: (round(rng.random() * 64) / 8, rng.random() < 0.4) for s in rng.sample(stems, 300)}, {}):  # eighths: sums are exact in any order
        want = np.array([plain(t, lexicon) for t in texts])
        for limit in (200_000, 20):  # with the latter, words are forgotten again and again
            np.testing.assert_array_equal(tox.Reader(lexicon, limit).matrix(texts), want)


def test_words_are_cut_as_the_pattern_says():
    rng = random.Random(5)
    tokens = [t for text in ODD + [odd_text(rng) for _ in range(500)] for t in (text or "").lower().split()]
    assert [tox.bare(t) for t in tokens] == [re.sub(r"^[^\w@$]+|[^\w@$]+$", "", t) for t in tokens]


def test_features_of_unseen_words_take_few_calls():
    """No call a character, and no regular expression for a word of letters: calls are counted, so that the machine's speed has no part."""
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choices(string.ascii_lowercase, k=8)) + rng.choice(["", "", ".", ","]) for _ in range(300)) for _ in range(20)]
    reader = tox.Reader({"idio": (3.0, True)})
    profile = cProfile.Profile()
    profile.enable()
    reader.matrix(texts)
    profile.disable()
    calls = sum(e.callcount for e in profile.getstats())
    assert calls < 8 * sum(len(t.split()) for t in texts)
