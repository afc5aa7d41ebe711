"""Subject areas of documents by curated weighted terms.

All writings of all terms go into one multi-pattern automaton; each text is read
through it once.  A term counts once per text.  Its weight is the curated one
(1, or ``WEAK_WEIGHT`` for words of everyday or double meaning) times its rarity
in the corpus; the sum is normalised by the text's length, and every subject
whose score exceeds the calibrated threshold is assigned.

A rarity lies between ``RARITY_FLOOR`` and 1, so with the length normalisation
off no telling term alone, even with weak ones beside it, reaches the score of two.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator, Mapping
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from ..sources.tables import materialise
from .terms import MORE, TERMS, WEAK, WEAK_WEIGHT

RARITY_FLOOR = 0.75
#: Grid the calibration chooses from: (strength of the length normalisation, threshold).
GRID = [(a, round(0.6 + 0.1 * k, 1)) for a in (0.0, 0.1, 0.2) for k in range(22)]
#: Without labels: no length normalisation, and a threshold between a telling term with weak ones and two telling terms.
UNLABELLED = (0.0, 1.4)
#: Writings that a slip of the pen makes out of a term but that are words themselves.
NO_SLIPS = frozenset({
    "patent", "stad", "audi", "curt", "coat", "cloth", "butte", "four", "fin",
    # without the first letter, or with it and the next one swapped
    "altet", "arbour", "article", "articule", "artikel", "artiklen", "asten", "elvin", "elvins", "enten", "ernten", "erring", "ertrag", "ilden", "mende",
    "og file", "order", "rainer", "redit", "taffel", "us driver", "utter", "vairon", "worn in",
})

_MARKS = re.compile(r"[­​-‏⁠﻿]")
_SPACE = re.compile(r"\s+")


def folded(text: str) -> str:
    """NFC, invisible marks taken out, white space as single blanks, cases folded."""
    return _SPACE.sub(" ", _MARKS.sub("", unicodedata.normalize("NFC", text))).casefold()


def slips(term: str, shortest: int = 6) -> set[str]:
    """Writings one slip away: a letter doubled or left out, two neighbours swapped.  Shorter terms have none."""
    if len(term) < shortest:
        return set()
    out = set()
    for i in range(len(term)):
        if term[i] != " ":
            out |= {term[:i] + term[i + 1 :], term[:i] + term[i] + term[i:]}
            if i + 1 < len(term) and term[i + 1] != " ":
                out.add(term[:i] + term[i + 1] + term[i] + term[i + 2 :])
    return out - {term} - NO_SLIPS


def term_table(terms: Mapping[str, Mapping[str, str]] | None = None, weak: Mapping[str, str] = WEAK) -> dict[str, tuple[str, str]]:
    """Writing -> (subject, term), of ``TERMS`` and ``MORE`` unless given; weak words come as ``~term`` and have no slips.

    A writing shared by two subjects has a double meaning and is left out.
    """
    exact: dict[str, tuple[str, str]] = {}
    double: set[str] = set()
    lists = [(s, line) for t in ([TERMS, MORE] if terms is None else [terms]) for s, by_lang in t.items() for line in by_lang.values()]
    for subject, line in lists:
        for entry in line.split(";"):
            writings = [folded(w.strip()) for w in entry.split("/") if w.strip()]
            known = next((exact[w] for w in writings if w in exact and exact[w][0] == subject), (subject, writings[0]))
            for w in writings:
                if w in exact and exact[w][0] != subject:
                    double.add(w)
                exact.setdefault(w, known)
    near: dict[str, set[tuple[str, str]]] = {}
    for w, owner in exact.items():
        for s in slips(w):
            if s not in exact:
                near.setdefault(s, set()).add(owner)
    out = {w: o for w, o in exact.items() if w not in double}
    out |= {s: next(iter(o)) for s, o in near.items() if len(o) == 1}
    words = [(folded(w.strip()), subject) for subject, line in weak.items() for w in line.split(";")]
    shared = {w for w, _ in words if len({s for v, s in words if v == w}) > 1}
    return out | {w: (s, f"~{w}") for w, s in words if w not in shared and w not in exact and w not in near}


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    machine = ahocorasick.Automaton()
    for w, owner in term_table().items():
        machine.add_word(w, (len(w), *owner))
    machine.make_automaton()
    return machine


def find_terms(text: str | None) -> tuple[int, dict[str, set[str]]]:
    """Number of words and the distinct terms per subject; only whole words count, of overlapping finds the longest.

    An elided article (l', d') ends at its apostrophe, so what follows is a whole word.
    """
    if not text:
        return 0, {}
    t = folded(text)
    hits = []
    for end, (n, subject, term) in _automaton().iter(t):
        start = end - n + 1
        if (start == 0 or not t[start - 1].isalpha()) and (end + 1 == len(t) or not t[end + 1].isalpha()):
            hits.append((start, -n, subject, term))
    found: dict[str, set[str]] = {}
    reached = -1
    for start, n, subject, term in sorted(hits):
        if start > reached:
            found.setdefault(subject, set()).add(term)
            reached = start - n - 1
    return len(t.split()), found


def match_terms(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, n_words, subject, terms``: one row per document and subject with any term."""
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, t in zip(b["k"], b["t"], strict=True):
                n, found = find_terms(t)
                rows += [(k, n, s, sorted(terms)) for s, terms in found.items()]
            yield pd.DataFrame(rows, columns=["k", "n_words", "subject", "terms"])

    chosen = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).filter(F.col("k").isNotNull() & F.col("t").isNotNull())
    out = chosen.mapInPandas(run, f"k {kind}, n_words bigint, subject string, terms array<string>")
    return out.withColumnRenamed("k", key)


def scored(matches: DataFrame, key: str) -> DataFrame:
    """``key, subject, n_terms, n_words, weight``: the sum of rarity weights of the distinct terms.

    Rarity is the inverse document frequency over all matches, between ``RARITY_FLOOR`` (the most
    frequent term) and 1 (the rarest); the table of terms is as long as the curated list.
    """
    flat = matches.select(key, "n_words", "subject", F.explode("terms").alias("term"))
    freq = flat.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    ends = freq.agg(F.max("df").alias("hi"), F.min("df").alias("lo")).first()
    span = F.lit(float(ends["hi"] or 1)), F.lit(float(ends["lo"] or 1))
    rarity = F.coalesce(F.try_divide(F.log(span[0] / F.col("df")), F.log(span[0] / span[1])), F.lit(1.0))
    curated = F.when(F.startswith("term", F.lit("~")), F.lit(WEAK_WEIGHT)).otherwise(F.lit(1.0))
    weights = F.broadcast(freq.select("term", (curated * (RARITY_FLOOR + (1 - RARITY_FLOOR) * rarity)).alias("w")))  # bounded by the curated list
    one = flat.join(weights, "term").groupBy(key, "subject").agg(  # a set, so a repeated row's terms count once
        F.max("n_words").alias("n_words"), F.collect_set(F.struct("term", "w")).alias("ts")
    )
    return one.select(
        key, "subject", F.size("ts").cast("bigint").alias("n_terms"), "n_words", F.aggregate("ts", F.lit(0.0), lambda s, t: s + t["w"]).alias("weight")
    )


def score(alpha: float):
    """Weight normalised by length, smoothly over all lengths."""
    return F.col("weight") / (1 + alpha * F.log1p(F.col("n_words") / 50.0))


def calibrate(scores: DataFrame, labels: DataFrame, key: str) -> tuple[float, float]:
    """The (alpha, threshold) of the grid with the best F1 on labelled documents.

    ``labels``: ``key, subject``; all labels are used, counted where they lie, and only one row per grid
    point comes back.  Of equal F1 the strongest normalisation, then the middle threshold.  Without labels two
    telling terms are asked for: ``UNLABELLED``.
    """
    known = labels.select(key).distinct()
    judged = scores.join(known, key, "left_semi").join(labels.select(key, "subject", F.lit(1).alias("yes")).distinct(), [key, "subject"], "full")
    aggs = []
    for i, (alpha, t) in enumerate(GRID):
        said = F.coalesce(score(alpha) > t, F.lit(False))
        aggs += [F.count_if(said & F.col("yes").isNotNull()).alias(f"tp{i}"), F.count_if(said).alias(f"p{i}")]
    row = judged.agg(F.count("yes").alias("n"), *aggs).first()
    if not row["n"]:
        return UNLABELLED
    f1 = [2 * row[f"tp{i}"] / (row[f"p{i}"] + row["n"]) for i in range(len(GRID))]
    best = [g for g, f in zip(GRID, f1, strict=True) if f >= max(f1) - 1e-12]
    alpha = max(a for a, _ in best)
    level = sorted(t for a, t in best if a == alpha)
    return alpha, level[len(level) // 2]


def subjects_of(docs: DataFrame, key: str, text: str, labels: DataFrame | None = None) -> DataFrame:
    """``key, subject, n_terms, score`` of every subject a text is about; texts about none give no row.

    NULL and empty texts are about nothing; rows without a key are left out; repeated rows give one row.
    Terms of all languages are looked for in every text.  Whole texts are read.
    """
    scores = scored(materialise(match_terms(docs, key, text), "subject-terms"), key)
    alpha, threshold = calibrate(scores, labels, key) if labels is not None else UNLABELLED
    return scores.withColumn("score", score(alpha)).filter((F.col("score") > threshold)).select(key, "subject", "n_terms", F.round("score", 6).alias("score"))
