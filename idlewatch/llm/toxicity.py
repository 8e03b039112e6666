"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a whole text: density, weight and variety of lexicon words, those near a word of
the second person, capitals, punctuation, obfuscated words. The lexicon is learned from the
training rows by log odds, beside a few fixed words. Training takes at most TRAIN_ROWS
labelled documents outside the held-out fold, picked by hash; three quarters fit the trees,
one quarter the calibration. Everything is scored.

Null and empty texts have features of 0 and are scored. Without both classes the score is the
share of label 1 (0 without labels). Repeated rows are scored each. Extra columns are not read.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idlewatch.llm.common import held_out, stored, training_labels

TRAIN_ROWS = 12_000
LEXICON = 200
NEAR = 6
# Insults and threats to begin with, second-person words, look-alike letters.
INSULTS = ("idiot", "stupid", "moron", "worthless", "disgusting", "loser", "trash", "pathetic", "scum", "hate")
SECOND = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos ti tus usted ustedes".split())
LOOKS = str.maketrans("013457@$!", "oieastasi")
EDGE = ".,;:!?\"'()[]{}<>«»¿¡…-–—*_|/"
TRIM = r"^[\p{Punct}«»¿¡…–—]+|[\p{Punct}«»¿¡…–—]+$"


def learned_lexicon(train: DataFrame, size: int = LEXICON) -> dict[str, float]:
    """Words with their log odds of label 1; at most `size`, so they may go to the driver."""
    words = train.select(
        "label", F.explode(F.array_distinct(F.transform(F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s+"), lambda w: F.regexp_replace(w, TRIM, "")))).alias("word")
    ).where("word != ''")
    n = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count("*").alias("n")).collect()}
    counts = words.groupBy("word").agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (n.get(1, 0) + 1)) - F.log((F.col("good") + 0.5) / (n.get(0, 0) + 1))
    rows = counts.where("bad >= 5").withColumn("odds", odds).where("odds > 1.0").orderBy(F.desc("odds"), "word").limit(size).collect()
    return {w: 3.0 for w in INSULTS} | {r["word"]: r["odds"] for r in rows}


def features(text: str, lexicon: dict[str, float]) -> list[float]:
    pieces = text.split()
    if not pieces:
        return [0.0] * 14
    n = len(pieces)
    # Words are looked up as they stand first; stripping and look-alikes only where that fails.
    words = [p.strip(EDGE) for p in text.lower().split()]
    hits = [i for i, w in enumerate(words) if w in lexicon]
    odd = [i for i, w in enumerate(words) if not w.isalpha() and re.search(r"[^\W\d_][\d@$!*]+[^\W\d_]", w)]
    disguised = [i for i in odd if words[i].translate(LOOKS) in lexicon]
    weight = sum(lexicon[words[i]] for i in hits) + sum(lexicon[words[i].translate(LOOKS)] for i in disguised)
    bad = hits + disguised
    near = sum(any(w in SECOND for w in words[max(0, i - NEAR) : i + NEAR + 1]) for i in bad)
    letters = sum(map(len, words)) or 1
    upper = len(re.findall(r"[A-ZÀ-ÖØ-Þ]", text))
    shouted = sum(p.isupper() and len(p) > 1 for p in pieces)
    return [
        math.log1p(n), len(hits) / n, weight / n, math.log1p(len(bad)), float(len({words[i] for i in bad})),
        near / n, math.log1p(near), upper / letters, shouted / n, text.count("!") / n, text.count("?") / n,
        sum(text.count(c) for c in ".,;:*#@$%") / n, len(odd) / n, len(disguised) / n,
    ]


def featured(docs: DataFrame, lexicon: dict[str, float], *keep: str) -> DataFrame:
    """`keep` columns and `features` (a vector)."""
    schema = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        for batch in batches:
            rows = [features(x.as_py() or "", lexicon) for x in batch["text"]]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array(rows, pa.list_(pa.float64()))], names=[*keep, "x"])

    return docs.select(*keep, "text").mapInArrow(run, f"{schema}, x array<double>").select(*keep, array_to_vector("x").alias("features"))


def scored(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.5, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    picked = training_labels(labels, label, rows)
    train = stored(docs.select("doc_id", "text").join(picked, "doc_id").withColumn("fit", F.xxhash64("doc_id", F.lit(7)) % 4 != 0), "toxicity-train")
    n = {r["label"]: r["n"] for r in train.where("fit").groupBy("label").agg(F.count("*").alias("n")).collect()}
    told = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if len(n) < 2:
        share = float(n.get(1, 0) > 0)
        out = told.select("doc_id", held_out().alias("held_out"), F.lit(share).alias("score"))
        return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    lexicon = learned_lexicon(train.where("fit"))
    seen = stored(featured(train, lexicon, "doc_id", "label", "fit"), "toxicity-features").coalesce(2)
    model = GBTClassifier(featuresCol="features", labelCol="label", maxIter=15, maxDepth=4, stepSize=0.2, seed=11).fit(seen.where("fit"))
    raw = vector_to_array("probability")[1].alias("raw")
    calibration = model.transform(seen.where("NOT fit")).select(raw, F.col("label").cast("double").alias("label"))
    if calibration.isEmpty():
        calibration = model.transform(seen).select(raw, F.col("label").cast("double").alias("label"))
    curve = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(calibration)
    out = model.transform(featured(told, lexicon, "doc_id")).select("doc_id", raw)
    out = curve.transform(out).select(
        "doc_id", held_out().alias("held_out"),
        # Calibrated steps tie; a trace of the raw score keeps order within a step.
        (F.col("score") * 0.999 + F.col("raw") * 0.001).alias("score"),
    )
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
