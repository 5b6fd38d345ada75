"""Toxicity by a weighted lexicon: folding, Aho-Corasick matching, normalisation by length.

Texts are folded first: lower case, look-alike letters of other scripts to Latin, invisible and
combining marks dropped, punctuation to spaces, digits and symbols inside words to the letters
they stand for. The lexicon holds beginnings of words with learned weights; exception phrases
cover matches inside them. A text's weights per word and in total give a logistic score.

The lexicon and the scale are learned from a bounded sample of labelled rows that are not held
out. Nulls: a null text scores like an empty one; a null doc_id or label is never learned from;
a null doc_id is not held out. Repeated rows get equal scores. With no labelled rows of both
kinds the lexicon is empty and all scores are 0. Texts are matched whole.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertloom.llm.common import label_sample, without
from alertloom.llm.langid import held_out

#: Labelled documents of each kind in the training sample; the sample bounds the patterns as well.
SAMPLE_PER_LABEL = 5000
#: A pattern must occur in so many toxic documents, in such a share of them, and so many times more often than in others.
LEAST_TOXIC, LEAST_TOXIC_SHARE, LEAST_LIFT = 5, 0.002, 12.0
SHORTEST, LONGEST = 3, 12
THRESHOLD = 0.7
ADDED = ("held_out", "score", "predicted")

#: Harmless phrases that contain words of a lexicon; folded like texts.
EXCEPTIONS = (
    "class clown",
    "clown fish",
    "garbage collection",
    "garbage collector",
    "recycle trash",
    "trash bin",
    "trash can",
)

#: Letters of other scripts that look like Latin ones.
LOOKALIKES = dict(
    zip(
        "аеорсухіїјѕһԁԛԝкмтвнгпαορνικτυχεηɑɡıⅼ",
        "aeopcyxiijshdqwkmtbhrnaopviktuxenagil",
        strict=True,
    )
)
#: Digits and symbols that stand for letters inside a word.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}
INVISIBLE = "­​‌‍⁠﻿"

_DISGUISED = re.compile(r"(?<![^\W\d_])[0134578]{0,2}[@$]?[^\W\d_]+(?:[0134578@$!|]{1,2}[^\W\d_]+)*[0134578]{0,2}(?!\w)")
_MARKS = re.compile(r"[0-9@$!|]")


def _table() -> dict[int, str | None]:
    table: dict[int, str | None] = {ord(a): b for a, b in LOOKALIKES.items()}
    table |= {0xFF41 + k: chr(97 + k) for k in range(26)}  # full width letters
    table |= dict.fromkeys(range(0x300, 0x370))  # combining marks
    table |= dict.fromkeys(map(ord, INVISIBLE))
    table |= {c: " " for c in range(128) if not chr(c).isalnum()}
    table |= dict.fromkeys(map(ord, " ‘’“”…–—«»"), " ")
    return table


def folder():
    """The folding as a function of a text."""
    table = _table()
    letters = str.maketrans(SUBSTITUTES)

    def fold(text: str | None) -> str:
        text = (text or "").lower()
        if _MARKS.search(text):
            text = _DISGUISED.sub(lambda m: m[0].translate(letters) if _MARKS.search(m[0]) else m[0], text)
        return f" {text.translate(table)} "

    return fold


@dataclass
class Lexicon:
    patterns: dict[str, float]
    exceptions: Sequence[str] = EXCEPTIONS
    scale: Sequence[float] = (-4.0, 1.0, 1.0)

    def automaton(self) -> ahocorasick.Automaton | None:
        fold, found = folder(), ahocorasick.Automaton()
        for pattern, weight in self.patterns.items():
            found.add_word(pattern, (len(pattern), weight))
        for phrase in self.exceptions if self.patterns else ():
            found.add_word(text := " ".join(fold(phrase).split()), (len(text), 0.0))
            found.add_word(f" {text} ", (len(text) + 2, 0.0))
        if not len(found):
            return None
        found.make_automaton()
        return found

    def score(self, features: np.ndarray) -> np.ndarray:
        z = self.scale[0] + features @ np.array(self.scale[1:])
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def matches(folded: str, automaton: ahocorasick.Automaton | None) -> list[tuple[int, int, float]]:
    """Longest matches, none inside an exception phrase: start, end, weight."""
    found: list[tuple[int, int, float]] = []
    if automaton is None:
        return found
    phrases = []
    for end, (length, weight) in automaton.iter(folded):
        (found if weight else phrases).append((end - length + 1, end + 1, weight))
    # phrases by start, and the furthest end of those up to each
    phrases.sort()
    starts = [a for a, *_ in phrases]
    reach = list(accumulate((b for _, b, _ in phrases), max))
    kept: dict[int, tuple[int, int, float]] = {}
    for m in found:
        before = bisect_right(starts, m[0] + 1)
        covered = before and reach[before - 1] >= m[1] - 1
        if not covered and m[1] > kept.get(m[0], (0, 0))[1]:
            kept[m[0]] = m
    return list(kept.values())


def features(folded: str, automaton: ahocorasick.Automaton | None) -> tuple[float, float]:
    """Total weight, and weight per word, both damped."""
    total = sum(w for *_, w in matches(folded, automaton))
    words = max(1, folded.count(" ") - folded.count("  ") - 1)
    return float(np.log1p(total)), float(np.log1p(1000 * total / (words + 20)))


def word_starts(folded: str) -> set[str]:
    """Beginnings of words, each with the space before it; ``" word "`` is the whole word."""
    out = set()
    for w in set(folded.split()):
        if len(w) >= SHORTEST:
            out.update(f" {w[:k]}" for k in range(SHORTEST, min(len(w), LONGEST) + 1))
            out.add(f" {w} ")
    return out


def training_rows(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> DataFrame:
    """``text, toxic`` of at most ``per_label`` rows of each label: those of least hash, none held out.

    The ids are ranked without texts; so few of them may be broadcast to pick the texts.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
    picked = label_sample(known, "toxic", per_label)
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    # copies count once, or what their texts share would look telling
    return rows.groupBy("text").agg(F.max("toxic").alias("toxic")).select("text", F.col("toxic").cast("int"))


def learn(sample: DataFrame, exceptions: Sequence[str] = EXCEPTIONS) -> Lexicon:
    """Weights of word beginnings by log odds, then the scale by logistic regression.

    Of patterns that occur in the same documents the longest beginning is kept, and none whose
    shorter beginning is nearly as telling.
    """
    fold = folder()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("toxic").to_pylist()
            counts: tuple[Counter, Counter] = Counter(), Counter()
            for text, label in zip(batch.column("text").to_pylist(), toxic, strict=True):
                counts[label].update(word_starts(fold(text)))
                counts[label][""] += 1
            names = list(counts[0] | counts[1])
            columns = [pa.array(names), *[pa.array([c[w] for w in names], pa.int64()) for c in counts]]
            yield pa.RecordBatch.from_arrays(columns, names=["pattern", "clean", "toxic"])

    counted = sample.mapInArrow(count, "pattern string, clean long, toxic long").groupBy("pattern")
    counted = counted.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    every = counted.filter("pattern = ''").first()
    if every is None or not every.clean or not every.toxic:
        return Lexicon({}, exceptions)
    odds = (F.col("toxic") + 0.5) / every.toxic / ((F.col("clean") + 0.5) / every.clean)
    least = max(LEAST_TOXIC, LEAST_TOXIC_SHARE * every.toxic)
    rows = counted.filter((F.col("pattern") != "") & (F.col("toxic") >= least)).withColumn("odds", odds)
    rows = rows.filter(F.col("odds") >= LEAST_LIFT)
    found = {r.pattern: (r.toxic, r.clean, r.odds) for r in rows.collect()}
    longer: dict[str, list[str]] = defaultdict(list)
    for q in found:
        if not q.endswith(" "):
            longer[q[:-1]].append(q)
    patterns: dict[str, float] = {}
    for p in sorted(found, key=len):
        toxic, clean, lift = found[p]
        if any(found[q][0] == toxic for q in longer[p]):
            continue
        shorter = [p[:k] for k in range(SHORTEST + 1, len(p)) if p[:k] in patterns]
        if any(found[q][1] <= max(clean, 0.02 * found[q][0]) for q in shorter):
            continue
        patterns[p] = round(float(np.log(lift)), 4)
    lexicon = Lexicon({p: patterns[p] for p in sorted(patterns)}, exceptions)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            x = [features(fold(t), automaton) for t in batch.column("text").to_pylist()]
            columns = [pa.array([v[k] for v in x], pa.float64()) for k in range(2)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("toxic")], names=["a", "b", "toxic"])

    # two numbers for each row of the sample
    measured = sample.mapInArrow(measure, "a double, b double, toxic int").collect()
    x = np.array([(1, r.a, r.b) for r in measured])
    y = np.array([r.toxic for r in measured], float)
    beta = np.zeros(3)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        ridge = np.diag([0.01, 0.1, 0.1])
        slope = x.T @ (y - p) - ridge @ beta
        beta += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, slope)
    lexicon.scale = tuple(map(float, beta))
    return lexicon


def scorer(lexicon: Lexicon, keep: Sequence[str]):
    """Function for ``mapInArrow``: columns ``keep`` with ``score``."""
    fold = folder()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            texts = batch.column("text")
            x = [features(fold(t.as_py()), automaton) for t in texts]
            value = lexicon.score(np.array(x).reshape(-1, 2)) if lexicon.patterns else np.zeros(len(x))
            columns = [batch.column(c) for c in keep] + [pa.array(value, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "score"])

    return score


def scored(docs: DataFrame, lexicon: Lexicon, keep: Sequence[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``score``. One pass, no shuffle."""
    rows = docs.select(*dict.fromkeys([*keep, "text"]))
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(scorer(lexicon, list(keep)), f"{schema}, score double")


def predicted(score: str = "score", threshold: float = THRESHOLD):
    return (F.col(score) >= threshold).cast("int")


def with_toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """All columns of ``docs`` with ``held_out, score, predicted``."""
    rows = without(docs, ADDED)
    found = scored(rows, lexicon, rows.columns).withColumns({"held_out": held_out(), "predicted": predicted()})
    return found.select(*[f"`{c}`" for c in rows.columns], *ADDED)


def lexicon_from(docs: DataFrame, labels: DataFrame, weights: Mapping[str, float] | None = None) -> Lexicon:
    """Learns a lexicon; ``weights`` adds fixed patterns (a word's beginning with a space before it)."""
    lexicon = learn(training_rows(docs, labels))
    lexicon.patterns |= dict(weights or {})
    return lexicon


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    lexicon = lexicon_from(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs, lexicon, ["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "score", predicted().alias("predicted")
    )
