"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

The features of a text are densities of a lexicon, nearness of its words to the second person,
capitals, punctuation and obfuscation. The lexicon (words, and beginnings of words, as many
languages inflect) is learned from training labels, as are trees and calibration; all three from
a sample of at most ``POSITIVES`` + ``NEGATIVES`` labelled documents, chosen by a hash of their
id. A quarter of the sample, again by hash, is left out of lexicon and trees and calibrates them,
each row with the weight of the labels of its kind that it stands for, so that scores follow the
rate of all usable labels and not that of the sample. Every document is scored, over its whole text.

Null and empty texts have features of zero and a score like others; very long ones are read
whole. Labels that are null or neither 0 nor 1, of an id that is not among the documents, or that
contradict another label of their id are not used; of a repeated id one text is learned from, and
every row is scored. Without labels of both kinds
there is nothing to learn: every score is then the share of positives, weighted likewise (0 if
there is none). Further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from skyledger.llm.tables import stored

#: Labelled documents that lexicon, trees and calibration are fitted on, at most.
POSITIVES, NEGATIVES = 2_500, 5_000
#: Terms in the lexicon at most, toxic documents a term is seen in at least, least log odds.
TERMS, LEAST_SEEN, LEAST_ODDS = 2_000, 3, 2.0
#: Lengths of the beginnings of words that can be terms.
BEGINNINGS = (4, 5, 6)
NEAR = 5

# ---- fixed values: second person in English, French, German, Spanish
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur tu te toi vous votre vos ton ta tes du dich dir dein "
    "deine deinen ihr euch euer eure tú ti usted ustedes vosotros tus vuestro vuestra".split())
#: Signs that stand for letters.
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t",
                            "@": "a", "$": "s", "!": "i", "*": "", ".": "", "-": "", "_": ""})
# ---- end of fixed values

_EDGE = re.compile(r"^\W+|\W+$")
_INNER = re.compile(r"[^\W\d_][^\w\s'’]+[^\W\d_]|[^\W\d_]\d+[^\W\d_]")
_RUNS = re.compile(r"[!?]{2,}")
_STRETCH = re.compile(r"([^\W\d_])\1\1", re.IGNORECASE)

FEATURES = [
    "word_density", "beginning_density", "strongest", "weight_sum", "hits", "distinct_hits",
    "second_person", "near_second_person", "nearest_second_person", "capitals", "shouted_words",
    "exclamations", "questions", "punctuation", "punctuation_runs", "obfuscated", "unmasked_hits",
    "stretched", "log_words", "mean_length",
]
_WORDS_KEPT = 300_000


def terms_of(word: str) -> list[str]:
    """The word itself, then its beginnings, each marked with its kind."""
    return [f"={word}", *(f"^{word[:n]}" for n in BEGINNINGS if len(word) >= n)]


@dataclass
class _Word:
    exact: float
    beginning: float
    unmasked: float
    second: bool
    shouted: bool
    obfuscated: bool
    stretched: bool
    plain: str


class Features(dict):
    """Makes features; as a dict it keeps what is known of a word (None: nothing) for the next."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __reduce__(self):
        return Features, (self.lexicon,)

    def __missing__(self, word: str) -> _Word | None:
        lexicon = self.lexicon
        plain = _EDGE.sub("", word)
        low = plain.lower()
        exact, *begun = (lexicon.get(t, 0.0) for t in terms_of(low))
        obfuscated = bool(_INNER.search(word))
        unmasked = 0.0
        if obfuscated:
            unmasked = max(lexicon.get(t, 0.0) for t in terms_of(low.translate(LOOKALIKES)))
        found = _Word(exact, max(begun, default=0.0), unmasked, low in SECOND_PERSON,
                      len(plain) > 2 and plain.isupper(), obfuscated,
                      bool(_STRETCH.search(plain)), low)
        if not (exact or found.beginning or found.second or found.shouted or obfuscated
                or found.stretched):
            found = None
        if len(self) >= _WORDS_KEPT:
            self.clear()
        self[word] = found
        return found

    def of(self, text: str | None) -> list[float]:
        text = text or ""
        words = text.split()
        if not words:
            return [0.0] * len(FEATURES)
        notable = [(i, x) for i, x in enumerate([self[w] for w in words]) if x is not None]
        n = len(words)
        weights = [(i, max(x.exact, x.beginning, x.unmasked), x) for i, x in notable
                   if x.exact or x.beginning or x.unmasked]
        at = np.array([i for i, _, _ in weights])
        second = np.array([i for i, x in notable if x.second])
        gaps = np.array([])
        if len(at) and len(second):
            after = np.minimum(np.searchsorted(second, at), len(second) - 1)
            gaps = np.minimum(np.abs(second[after] - at),
                              np.abs(second[np.maximum(after - 1, 0)] - at))
        raw = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
        letters = max(1, int(raw[0x41:0x5B].sum() + raw[0x61:0x7B].sum()))
        return [
            100 * sum(x.exact > 0 for _, _, x in weights) / n,
            100 * sum(x.beginning > 0 for _, _, x in weights) / n,
            max((w for _, w, _ in weights), default=0.0),
            sum(w for _, w, _ in weights),
            float(len(weights)),
            float(len({x.plain for _, _, x in weights})),
            100 * len(second) / n,
            100 * float((gaps <= NEAR).sum()) / n,
            1 / (1 + float(gaps.min())) if len(gaps) else 0.0,
            int(raw[0x41:0x5B].sum()) / letters,
            100 * sum(x.shouted for _, x in notable) / n,
            100 * int(raw[0x21]) / n,
            100 * int(raw[0x3F]) / n,
            100 * int(raw[0x21:0x30].sum() + raw[0x3A:0x41].sum()) / len(text),
            100 * len(_RUNS.findall(text)) / n,
            100 * sum(x.obfuscated for _, x in notable) / n,
            float(sum(x.unmasked > 0 for _, _, x in weights)),
            100 * sum(x.stretched for _, x in notable) / n,
            float(np.log1p(n)),
            len(text) / n,
        ]


def with_features(documents: DataFrame, lexicon: dict[str, float], kept: list[str]) -> DataFrame:
    """``kept``, a struct of the kept columns, and ``features``; so no column can clash."""
    shared = documents.sparkSession.sparkContext.broadcast(Features(lexicon))
    rows = documents.select(F.struct(*kept).alias("kept"), "text")
    out = StructType([rows.schema["kept"], StructField("list", ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = shared.value
        for batch in batches:
            made = pa.array([make.of(t.as_py()) for t in batch.column(1)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), made], names=["kept", "list"])

    return rows.mapInArrow(run, out).select("kept", array_to_vector("list").alias("features"))


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def sampled(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, label, weight, calibrates: the bounded sample that everything is learned from.

    Only labels of given documents are drawn. An id counts once: one whose labels contradict each
    other is not learned from, and of several texts of an id the one with the least digest is.
    ``weight`` is the number of usable ids of the same kind for each one that was drawn.
    """
    given = documents.where("doc_id is not null").select("doc_id").distinct()
    known = stored(
        labels.select("doc_id", F.col("toxic").cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1)").where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other").drop("other").join(given, "doc_id", "left_semi"), "toxic-labels")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    picked = [known.where(F.col("label") == label)
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
              .withColumn("weight", F.lit(max(counts.get(label, 0) / most, 1.0)))
              for label, most in ((1, POSITIVES), (0, NEGATIVES))]
    chosen = picked[0].union(picked[1])
    text = F.coalesce("text", F.lit(""))
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy(
        "doc_id", "label", "weight").agg(F.min_by("text", F.sha2(text, 256)).alias("text"))
    return stored(texts.select(
        "doc_id", "text", "label", "weight",
        (F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(4)) == 0).alias("calibrates")),
        "toxic-sample")


def learned_lexicon(sample: DataFrame, positives: int, negatives: int) -> dict[str, float]:
    """Terms with their log odds of being in a toxic document; the strongest ``TERMS``."""

    def run(batches):
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                   strict=True):
                words = {_EDGE.sub("", w).lower() for w in set((text or "").split())}
                terms = sorted({t for w in words if w for t in terms_of(w)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(terms, pa.string()), pa.array([label] * len(terms), pa.int32())],
                    names=["term", "label"])

    odds = (F.log((F.col("toxic") + 0.5) / (positives + 1.0))
            - F.log((F.col("clean") + 0.5) / (negatives + 1.0)))
    terms = sample.select("text", "label").mapInArrow(run, "term string, label int") \
        .groupBy("term").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    best = terms.where(F.col("toxic") >= LEAST_SEEN).withColumn("odds", odds) \
        .where(F.col("odds") >= LEAST_ODDS) \
        .orderBy(F.desc(F.col("odds") * F.log1p("toxic")), "term").limit(TERMS).collect()
    return {row["term"]: row["odds"] for row in best}


@dataclass
class Model:
    """What was learned; ``trees`` is None if there was only one kind of label."""

    lexicon: dict[str, float]
    trees: Transformer | None
    calibration: Transformer | None
    share: float


def fitted(documents: DataFrame, labels: DataFrame) -> Model:
    sample = sampled(documents, labels)
    parts = sample.groupBy("label", "calibrates").agg(
        F.count("*").alias("rows"), F.sum("weight").alias("weight")).collect()
    counts = {(r["label"], r["calibrates"]): r["rows"] for r in parts}
    both = sum(r["weight"] for r in parts)
    share = sum(r["weight"] for r in parts if r["label"]) / both if both else 0.0
    positives, negatives = (counts.get((label, False), 0) for label in (1, 0))
    if not positives or not negatives:
        return Model({}, None, None, share)
    training = sample.where(~F.col("calibrates"))
    lexicon = learned_lexicon(training, positives, negatives)
    made = stored(with_features(sample, lexicon, ["doc_id", "label", "weight", "calibrates"])
                  .select("kept.*", "features").orderBy("doc_id", "label").coalesce(4),
                  "toxic-features")
    trees = GBTClassifier(labelCol="label", maxDepth=4, maxIter=20, stepSize=0.3, seed=7,
                          maxBins=64, minInstancesPerNode=5, cacheNodeIds=False).fit(
        made.where(~F.col("calibrates")))
    calibrates = made.where("calibrates")
    if len({label for label, part in counts if part}) < 2:
        calibrates = made
    rated = _rated(calibrates, trees)
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="weight").fit(
        rated.withColumn("label", F.col("label").cast("double")))
    return Model(lexicon, trees, calibration, share)


def _rated(featured: DataFrame, trees: Transformer) -> DataFrame:
    return trees.transform(featured).withColumn(
        "raw", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")


def scored(documents: DataFrame, model: Model, kept: list[str]) -> DataFrame:
    """The kept columns and ``score``, the calibrated probability of label 1.

    A kept column must not be called ``score``.
    """
    if model.trees is None:
        return documents.select(*kept, F.lit(float(model.share)).alias("score"))
    rated = _rated(with_features(documents, model.lexicon, kept), model.trees)
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("prediction")))
    return model.calibration.transform(rated).select("kept.*", score.alias("score"))
