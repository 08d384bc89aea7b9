"""Toxicity: gradient-boosted trees over dense features, calibrated isotonically.

Features per whole text: density and distinct weight of a lexicon, closeness of lexicon
words to second-person words, capitals, punctuation, obfuscation and length. The lexicon
has a small fixed part and a learned part without a fixed size, in whatever languages the
labelled texts have: words (plain, and after undoing letter-like digits and signs) and word
starts whose share among toxic training texts stands out by more than ``BAR`` standard
errors, each with its smoothed log-odds. It is cross-fitted: the trees learn from features
whose weights were counted on the other parts of the training rows, so a word's fit to its
own rows is not taken for evidence. Near copies (texts with the same least hash of their
five-word shingles) count once and lie in one part. Trees and calibration come from Spark
ML; the calibration is fitted on training rows that the trees have not seen.

The model is fitted on at most ``sample`` labelled rows (an even hash sample; the
bound is a parameter); every row is scored. Texts, not ids, sources, languages or
labels, are the input of a score. Null text is empty text; empty texts are scored.
Without labels of both kinds the score is the share of toxic labels (0 if none).
Rows with several labels count once per label (labels of near copies: once per group).
Repeated rows get equal scores; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from functools import lru_cache
from heapq import nlargest

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import batches, slices, written
from ledgerlake.llm.token_counts import _arrow

#: Rows to fit on, parts of the cross-fit, standard errors that a learned form must exceed.
SAMPLE, PARTS, BAR = 20_000, 4, 4.0
#: Lengths of the word starts that are forms of a longer word.
STARTS = (4, 5, 6, 7)
#: A plain seed lexicon of insults.
INSULTS = frozenset("idiot idiots moron stupid dumb loser losers trash scum clown pathetic worthless disgusting garbage fool jerk hate shut ugly imbecile filth vermin bastard shit damn crap".split())
SECOND = frozenset("you your yours yourself u ur du dein deine dich dir tu te toi ton ta tes vous votre usted ti tus eres".split())
LEET = str.maketrans("013457@$!|", "oieastasil")
EDGE = ".,;:!?\"'()[]{}*%&#|<>~^_-"
NAMES = ("seed", "learned_sum", "learned_top", "learned_words", "seed_rate", "learned_rate", "undone", "near", "capitals", "shouted", "exclaims", "punctuation", "signs", "mixed", "repeats", "size")


def plain(word: str) -> str:
    return word.strip(EDGE).lower()


def undo(word: str) -> str:
    """Letter-like digits and signs as letters, inner signs and drawn-out letters dropped."""
    w = word.strip(".,;:?\"'()").lower().translate(LEET)
    return re.sub(r"(.)\1{2,}", r"\1", re.sub(r"[^\w]|_", "", w))


def forms(word: str) -> set[str]:
    """What a word of a text may be known as: itself, undone, and the starts of that."""
    w = plain(word)
    if not w:
        return set()
    out = {w}
    if not w.isalpha():
        w = undo(word)
        if w:
            out.add(w)
    out.update(w[:k] + "-" for k in STARTS if len(w) > k)
    return out


def copy_key(text: str) -> int:
    """Least hash of the five-word shingles (of the whole text, if shorter)."""
    words = text.encode("utf-8", "surrogatepass").split()
    return min(zlib.crc32(b" ".join(words[k:k + 5])) for k in range(max(1, len(words) - 4)))


def reader(weights: dict[str, float]):
    """A function from a raw word to (plain, seed, undone, mixed, second person, learned weight), or
    None for a word that tells nothing; remembered for frequent words."""
    begins = {f[:STARTS[0]] for f in weights}

    @lru_cache(maxsize=1 << 17)
    def read(raw: str):
        w = plain(raw)
        if w.isalpha() or not w:  # most words: neither obfuscated nor known
            seed, second = w in INSULTS, w in SECOND
            weight = max((weights[f] for f in forms(raw) if f in weights), default=0.0) if w[:STARTS[0]] in begins else 0.0
            return (w, seed, False, False, second, weight) if seed or second or weight else None
        u = undo(raw)
        weight = max((weights[f] for f in forms(raw) if f in weights), default=0.0)
        return w, w in INSULTS, u in INSULTS or u in weights, any(c.isalpha() for c in w), w in SECOND, weight

    return read


def features(text: str, read) -> tuple[float, ...]:
    """One value per ``NAMES``, from the whole text; ``read`` is a ``reader``."""
    raw = text.split()
    n = len(raw)
    per = 1.0 / max(n, 1)
    seeds = undones = mixes = learned = 0
    best: dict[str, float] = {}
    hits, second = [], set()
    for k, told in enumerate(map(read, raw)):
        if told is None:
            continue
        w, seed, undone, mixed, you, weight = told
        seeds += seed
        undones += undone
        mixes += mixed
        if weight:
            learned += 1
            best[w] = weight
        if seed or undone or weight:
            hits.append(k)
        if you:
            second.add(k)
    near = sum(any(k + d in second for d in range(-5, 6)) for k in hits) if second else 0
    m = max(len(text), 1)
    letters = len(re.sub(r"[\W\d_]+", "", text))
    upper = len(re.findall(r"[A-ZÀ-ÖØ-Þ]", text))
    return (float(seeds), float(sum(nlargest(10, best.values()))), float(max(best.values(), default=0.0)), float(len(best)), seeds * per, learned * per, float(undones), float(near),
            upper / max(letters, 1), sum(map(str.isupper, raw)) * per, text.count("!") / m, sum(map(text.count, ".,;:?")) / m,
            sum(map(text.count, "@#$%&*|<>~^")) / m, mixes * per, len(re.findall(r"(.)\1\1", text)) / m, math.log1p(n))


def featured(docs: DataFrame, weights: list[dict[str, float]], keep: tuple[str, ...] = ("doc_id",), part: str | None = None) -> DataFrame:
    """The ``keep`` columns and one column per feature, for every row. ``weights`` has those
    of all training rows last; with ``part`` a row's own are at the place that column names."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    schema = pa.schema([*((k, _arrow(docs, k)) for k in keep), *((n, pa.float64()) for n in NAMES)])

    def run(frames):
        readers = [reader(w) for w in (shared.value if part else shared.value[-1:])]

        def rows(b):
            own = b.column(part).to_pylist() if part else [-1] * b.num_rows
            cols = [b.column(k).to_pylist() for k in keep]
            for t, k, *rest in zip(b.column("text").to_pylist(), own, *cols, strict=True):
                yield (*rest, *features(t or "", readers[k]))

        for b in slices(frames):
            yield from batches(rows(b), schema)

    kinds = ", ".join([f"{k} {docs.schema[k].dataType.simpleString()}" for k in keep] + [f"{n} double" for n in NAMES])
    return docs.select(*dict.fromkeys([*keep, *([part] if part else []), "text"])).mapInArrow(run, kinds)


def grouped(rows: DataFrame) -> DataFrame:
    """One row (the least id) of each group of near copies and label, with the group's ``part``."""
    schema = pa.schema([("doc_id", _arrow(rows, "doc_id")), ("text", pa.string()), ("toxic", pa.int32()), ("key", pa.int64())])

    def run(frames):
        for b in slices(frames):
            t = [x or "" for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(t, pa.string()), b.column("toxic"), pa.array([copy_key(x) for x in t], pa.int64())], schema=schema)

    keyed = rows.select("doc_id", "text", "toxic").mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string, toxic int, key long")
    first = F.row_number().over(Window.partitionBy("key", "toxic").orderBy("doc_id", "text"))
    return (keyed.withColumn("_rn", first).filter("_rn = 1").drop("_rn")
            .withColumn("part", F.pmod(F.xxhash64("key", F.lit("part")), F.lit(PARTS)).cast("int")))


def learn_weights(train: DataFrame, bar: float = BAR) -> list[dict[str, float]]:
    """Weights of forms: for each part those learned from the other parts, then those of all
    ``train(text, toxic, part)``. The texts that hold a form are counted once per batch, then
    added up by Spark; forms above the bar reach the driver, bounded by the fitting sample."""
    schema = pa.schema([("form", pa.string()), ("toxic", pa.int32()), ("part", pa.int32()), ("n", pa.int64())])

    def run(frames):
        for b in slices(frames):
            seen: Counter = Counter()
            for t, x, k in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), b.column("part").to_pylist(), strict=True):
                seen.update((f, x, k) for f in set().union(*map(forms, set((t or "").split()))))
            yield from batches(((*key, n) for key, n in seen.items()), schema, size=50_000)

    count = lambda x, k: F.sum(F.when((F.col("toxic") == x) & ((F.col("part") != k) if k < PARTS else F.lit(True)), F.col("n")).otherwise(0))
    sides = [(k, f"x{k}", f"y{k}") for k in range(PARTS + 1)]
    sums = [c for k, x, y in sides for c in (count(1, k).alias(x), count(0, k).alias(y))]
    totals = train.withColumn("n", F.lit(1)).agg(*sums).first()
    counts = train.select("text", "toxic", "part").mapInArrow(run, "form string, toxic int, part int, n long").groupBy("form").agg(*sums)

    def odds(x, y):
        return F.log((F.col(x) + 0.5) / ((totals[x] or 0) + 1.0)) - F.log((F.col(y) + 0.5) / ((totals[y] or 0) + 1.0))

    def kept(x, y):
        o = odds(x, y)
        return F.when(o / F.sqrt(1 / (F.col(x) + 0.5) + 1 / (F.col(y) + 0.5)) > bar, o)

    weights = counts.filter(F.greatest(*[F.col(x) for _, x, _ in sides]) > 0).select("form", *[kept(x, y).alias(f"w{k}") for k, x, y in sides])
    found = weights.filter(F.coalesce(*[F.col(f"w{k}") for k, _, _ in sides]).isNotNull()).collect()
    return [{r["form"]: r[f"w{k}"] for r in found if r[f"w{k}"] is not None} for k, _, _ in sides]


class Model:
    def __init__(self, weights, trees=None, curve=None, rate=0.0):
        self.weights, self.trees, self.curve, self.rate = weights, trees, curve, rate

    def score(self, docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
        """The ``keep`` columns with ``score``, for every row."""
        if self.trees is None:
            return docs.select(*keep, F.lit(float(self.rate)).alias("score"))
        rows = assembled(featured(docs, self.weights[-1:], keep))
        rows = margins(self.trees, rows)
        scored = self.curve.transform(rows)
        return scored.select(*keep, F.least(F.greatest(F.col("prediction"), F.lit(0.0)), F.lit(1.0)).alias("score"))


def assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(NAMES), outputCol="_features").transform(df)


def margins(trees, df: DataFrame) -> DataFrame:
    out = trees.transform(df).drop("prediction")
    return out.withColumn("margin", vector_to_array("probability")[1])


def fit(labelled: DataFrame, sample: int = SAMPLE, bar: float = BAR, rounds: int = 20, depth: int = 4) -> Model:
    """Fit on ``labelled(doc_id, text, toxic)``, at most ``sample`` rows of it."""
    rows = labelled.filter(F.col("toxic").isin(0, 1)).select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
    n = rows.count()
    share = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    if n > sample:
        rows = rows.filter(share < sample / n)
    train = written(grouped(rows.repartition(16, F.xxhash64("doc_id", "text"))), "toxic-train")
    counts = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return Model([{}], rate=float(next(iter(counts), 0)))
    weights = learn_weights(train, bar)
    table = written(featured(train, weights, ("doc_id", "toxic", "key"), "part"), "toxic-features")
    table = assembled(table.withColumn("label", F.col("toxic").cast("double")))
    held = F.pmod(F.xxhash64("key", F.lit("calibrate")), F.lit(4)) == 0
    parts = table.filter(~held), table.filter(held)
    if any(p.select("toxic").distinct().count() < 2 for p in parts):
        parts = table, table  # too few rows to set some aside
    trees = GBTClassifier(featuresCol="_features", labelCol="label", maxIter=rounds, maxDepth=depth, stepSize=0.2, minInstancesPerNode=5, seed=7).fit(parts[0])
    curve = IsotonicRegression(featuresCol="margin", labelCol="label").fit(margins(trees, parts[1]).select("margin", "label"))
    return Model(weights, trees, curve)


def labelled_rows(docs: DataFrame, labels: DataFrame, fold) -> DataFrame:
    """doc_id, text, toxic of the labelled training rows (``fold``: a condition on doc_id)."""
    marks = labels.select(F.col("doc_id").alias("_id"), "toxic").filter(F.col("toxic").isNotNull())
    return docs.select("doc_id", "text").filter(fold).join(marks, F.col("doc_id") == F.col("_id")).drop("_id")
