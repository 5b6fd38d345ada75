import random
import time

from pyspark.sql import functions as F

from alertloom.llm import toxicity


def test_folding():
    fold = toxicity.folder()
    assert fold("You 1d10t! м0rоn, st​upid WORTHLE55 ｃlown").split() == ["you", "idiot", "moron", "stupid", "worthless", "clown"]
    assert fold("in 1984 and 3.5 *** reed$$$").split() == ["in", "1984", "and", "3", "5", "reed"]
    assert fold(None).strip() == fold(" \n").strip() == ""


def test_matches_and_exceptions():
    lexicon = toxicity.Lexicon({" clown": 3.0, " clow": 2.0, " trash ": 2.0}, ("class clown", "trash can"))
    automaton, fold = lexicon.automaton(), toxicity.folder()

    def weights(text):
        return [w for *_, w in toxicity.matches(fold(text), automaton)]

    assert weights("a clown, clowns and a class-clown") == [3.0, 3.0]
    assert weights("trash can; trash; trashy") == [2.0]
    assert weights("") == []
    assert toxicity.Lexicon({}).automaton() is None


def test_held_out_accuracy(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/../sf0.1/labels.parquet")
    found = toxicity.op8_toxicity(spark, f"{sf_dir}/../sf0.1").join(labels, "doc_id").filter("held_out")
    c = {(r.toxic, r.predicted): r.n for r in found.groupBy("toxic", "predicted").agg(F.count("*").alias("n")).collect()}
    assert c[(1, 1)] / (c[(1, 1)] + c.get((1, 0), 0)) > 0.85
    assert c[(0, 0)] / (c[(0, 0)] + c.get((0, 1), 0)) > 0.99


def test_edges(docs, rows, spark):
    lexicon = toxicity.Lexicon({" repeated": 5.0}, (), (-4.0, 3.0, 1.0))
    found = toxicity.with_toxicity(docs, lexicon)
    assert found.columns == [c for c in docs.columns if c != "score"] + ["held_out", "score", "predicted"]
    got = found.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
    assert {r.doc_id for r in got if r.predicted} == {16}
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    empty = toxicity.lexicon_from(docs, none)
    assert not empty.patterns and {r.score for r in toxicity.with_toxicity(docs, empty).collect()} == {0.0}


def _naive(folded, patterns, phrases):
    """Every place of every pattern and phrase by plain search."""
    places = lambda w: [i for i in range(len(folded)) if folded.startswith(w, i)]
    covers = [(i, i + len(p)) for p in phrases for i in places(p)] + [(i, i + len(p) + 2) for p in phrases for i in places(f" {p} ")]
    longest = {}
    for p, w in patterns.items():
        for i in places(p):
            if not any(a <= i + 1 and i + len(p) - 1 <= b for a, b in covers) and i + len(p) > longest.get(i, (0, 0, 0))[1]:
                longest[i] = (i, i + len(p), w)
    return sorted(longest.values())


def test_matches_against_plain_search():
    draw = random.Random(4)
    words = ["trash", "trash can", "clown", "class clown", "clown fish", "trashy", "can", "and a", "cl0wn", "fish"]
    patterns = {" tra": 1.0, " trash": 2.0, " trash ": 3.0, " clow": 1.5, " can": 0.5, " clown f": 0.7}
    lexicon = toxicity.Lexicon(patterns)
    fold, automaton = toxicity.folder(), lexicon.automaton()
    for _ in range(300):
        folded = fold(" ".join(draw.choice(words) for _ in range(draw.randrange(0, 12))))
        assert sorted(toxicity.matches(folded, automaton)) == _naive(folded, patterns, [" ".join(fold(p).split()) for p in lexicon.exceptions])


def test_phrases_are_swept_in_linear_time():
    lexicon = toxicity.Lexicon({" trash": 2.0, " clown": 1.5})
    fold, automaton = toxicity.folder(), lexicon.automaton()
    took = []
    for n in (4_000, 32_000):
        folded = fold("trash can and a clown " * n)
        start = time.perf_counter()
        toxicity.matches(folded, automaton)
        took.append(time.perf_counter() - start)
    assert took[1] < 32 * max(took[0], 0.01)
