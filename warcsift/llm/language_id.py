"""Operator 5: language ID by string-kernel classification.

A text is the set of its character n-grams of lengths 1 to ``SPECTRUM``
(blended spectrum, presence only). The kernel of two texts is the number of
shared n-grams over the root of the product of their counts. ``LANDMARKS``
texts per language give a Nyström approximation; one-versus-rest kernel ridge
regression is fitted on it from at most about ``SAMPLE`` labelled texts per
language (both bounds are parameters). Every text is read whole and scored in
batches: presence matrix x landmark matrix, then x coefficients.

N-grams are over an alphabet of the ``ALPHABET`` - 1 most frequent characters
of the landmark texts (lower-cased), all other characters being one more; only
n-grams found in a landmark count.

Defined results: a null text, or one without a letter, is ``und`` with score
0; ties go to the language first in order; a null lang is never learnt from;
repeated rows are scored each on its own; without labelled rows every text is
``und``; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPECTRUM, ALPHABET, LANDMARKS, SAMPLE, RIDGE = 3, 96, 24, 300, 1e-2
LANDMARK_CHARS = (200, 20_000)
BATCH = 128
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Grams:
    """Numbers of the n-grams of the landmark texts."""

    symbol: np.ndarray           # code point (up to 0xFFFF) -> symbol, 0 for all others
    tables: list[np.ndarray]     # per length: packed symbols -> n-gram number, 0 for others
    size: int

    @staticmethod
    def of(texts: list[str]) -> Grams:
        often = Counter(ch for t in texts for ch in t.lower() if ord(ch) < 0x10000)
        symbol = np.zeros(0x10000, dtype=np.int32)
        for i, (ch, _) in enumerate(sorted(often.items(), key=lambda x: (-x[1], x[0]))[:ALPHABET - 1]):
            symbol[ord(ch)] = i + 1
        grams = Grams(symbol, [np.zeros(ALPHABET ** n, dtype=np.int32) for n in range(1, SPECTRUM + 1)], 1)
        for text in texts:
            for table, codes in zip(grams.tables, grams.codes(text), strict=True):
                new = np.unique(codes[table[codes] == 0])
                table[new] = np.arange(grams.size, grams.size + len(new))
                grams.size += len(new)
        return grams

    def codes(self, text: str) -> list[np.ndarray]:
        s = self.symbol[np.minimum(np.frombuffer(text.lower().encode("utf-32-le"), dtype="<u4"), 0xFFFF)]
        out = [s]
        for n in range(1, SPECTRUM):
            out.append(out[-1][:-1] * ALPHABET + s[n:])
        return out

    def presence(self, texts: list[str]) -> np.ndarray:
        """texts x n-grams, 1 where a text has the n-gram (column 0: unused)."""
        out = np.zeros((len(texts), self.size), dtype=np.float32)
        for row, text in zip(out, texts, strict=True):
            for table, codes in zip(self.tables, self.codes(text), strict=True):
                row[table[codes]] = 1
        out[:, 0] = 0
        return out


@dataclass
class LanguageModel:
    langs: list[str]
    grams: Grams
    landmarks: np.ndarray        # n-grams x landmarks, columns of unit length
    coefficients: np.ndarray     # landmarks x langs
    offset: np.ndarray

    def kernel(self, texts: list[str]) -> np.ndarray:
        p = self.grams.presence(texts)
        return (p @ self.landmarks) / np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1))

    def scores(self, texts: list[str]) -> np.ndarray:
        """texts x langs, each row from 0 to 1 and summing to 1."""
        raw = np.maximum(self.kernel(texts) @ self.coefficients + self.offset, 0) + 1e-9
        return raw / raw.sum(axis=1, keepdims=True)


def has_letter(text: str | None) -> bool:
    return bool(text and LETTER.search(text))


def fit(labelled: DataFrame, per_lang: int = SAMPLE, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel | None:
    """Learn from ``labelled`` (doc_id, text, lang). Rows are sampled by a hash
    of doc_id at a rate that gives about ``per_lang`` rows of each language."""
    rows = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    if not counts:
        return None
    langs = sorted(counts)
    rate = F.create_map(*[x for lang in langs for x in (F.lit(lang), F.lit(min(1.0, per_lang / counts[lang])))])
    draw = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1_000_000)) / 1_000_000.0
    sample = rows.withColumn("draw", draw).filter(F.col("draw") < F.element_at(rate, F.col("lang")))

    lo, hi = LANDMARK_CHARS
    near = sample.filter((F.length("text") >= lo) & (F.length("text") <= hi))
    chosen: list[tuple[str, str]] = []
    for lang in langs:
        part = near.filter(F.col("lang") == lang).orderBy("draw", "text").limit(landmarks).select("text").collect()
        if not part:  # a language with none of that length
            part = (sample.filter((F.col("lang") == lang) & (F.length("text") <= hi))
                    .orderBy("draw", "text").limit(landmarks).select("text").collect())
        chosen += [(r["text"], lang) for r in part if has_letter(r["text"])]
    texts = [t for t, _ in chosen] or [" "]
    grams = Grams.of(texts)
    p = grams.presence(texts)
    model = LanguageModel(langs, grams, (p / np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1))).T.copy(),
                          np.zeros((len(texts), len(langs))), np.zeros(len(langs)))

    def kernel_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                k = model.kernel(part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(k.astype(float).tolist(), pa.list_(pa.float64()))], names=["lang", "k"])

    learnt = sample.select("text", "lang").mapInArrow(kernel_rows, "lang string, k array<double>").collect()
    learnt.sort(key=lambda r: (r["lang"], r["k"]))
    k = np.array([r["k"] for r in learnt])
    y = (np.array([r["lang"] for r in learnt])[:, None] == np.array(langs)).astype(float)
    weight = 1 / np.maximum(y.sum(axis=0), 1)[y.argmax(axis=1)]          # languages weigh alike
    weight = (weight / weight.sum())[:, None]
    values, vectors = np.linalg.eigh(model.landmarks.T.astype(float) @ model.landmarks)
    good = values > 1e-6 * max(values.max(), 1e-12)
    project = vectors[:, good] / np.sqrt(values[good])                    # Nyström features = k @ project
    x = k @ project
    mean, share = (weight * x).sum(axis=0), (weight * y).sum(axis=0)
    xc, yc = x - mean, y - share
    w = np.linalg.solve(xc.T @ (weight * xc) + ridge / len(langs) * np.eye(x.shape[1]) / 10, xc.T @ (weight * yc))
    model.coefficients = (project @ w).astype(np.float32)
    model.offset = (share - mean @ w).astype(np.float32)
    return model


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``doc_id, lang_pred, score``, one row per row of ``docs``."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                texts = part.column(1).to_pylist()
                lang, best = [UNKNOWN] * len(texts), [0.0] * len(texts)
                spoken = [i for i, t in enumerate(texts) if has_letter(t)] if model else []
                if spoken:
                    scores = model.scores([texts[i] for i in spoken])
                    for i, row in zip(spoken, scores, strict=True):
                        lang[i], best[i] = model.langs[int(row.argmax())], float(row.max())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(best, pa.float64())],
                                                 names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(judge, "doc_id long, lang_pred string, score double")
