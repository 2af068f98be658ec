"""Language identification by the nearest of several centroids per language.

A text becomes a vector of hashed character n-grams (1 to 3 letters, words joined by one space),
weighted by the root of their counts and by inverse document frequency, at unit length. Each
language has several centroids, found by spherical k-means on a bounded sample of labelled rows.
The nearest centroid by cosine names the language; a text farther away than ``reject_share`` of
what the sample shows for texts of its size is rejected.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import settle
from .common import fresh, modest_batches, small_runs

UNKNOWN = "und"


@dataclass(frozen=True)
class LangConfig:
    """``sample_per_lang`` bounds the labelled rows used for fitting, taken by hash, per language;
    ``max_langs`` bounds the model: languages x clusters x dims x 4 bytes are sent to every task."""

    dims_log2: int = 13
    clusters: int = 4
    rounds: int = 12
    sample_per_lang: int = 1000
    max_langs: int = 256
    reject_share: float = 0.5


@dataclass
class LangModel:
    config: LangConfig
    langs: list[str] = field(default_factory=list)
    centroids: np.ndarray | None = None
    idf: np.ndarray | None = None
    #: Smallest cosine a text of 2**i n-grams may have.
    floors: np.ndarray | None = None


def _kind_runs() -> tuple[np.ndarray, np.ndarray]:
    """Kinds of all code points (2 letter, 1 mark, 0 neither) as runs, small enough for a closure."""
    names = {"L": 2, "M": 1}
    kinds = np.fromiter((names.get(unicodedata.category(chr(i))[0], 0) for i in range(0x110000)), np.uint8, 0x110000)
    starts = np.flatnonzero(np.r_[True, kinds[1:] != kinds[:-1]])
    return kinds[starts], np.diff(np.r_[starts, 0x110000])


def _hash(*parts: np.ndarray, bits: int) -> np.ndarray:
    h = np.full(len(parts[0]), len(parts), np.uint32)
    for x in parts:
        h = (h ^ x) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    return (h * np.uint32(0x85EBCA77)) >> np.uint32(32 - bits)


def _counts(text: str, bits: int, kinds: np.ndarray, step: int = 1 << 20) -> tuple[np.ndarray, bool]:
    """Counts by hashed n-gram of the whole text, and whether it has a letter. Long texts go
    through in slices that share two characters."""
    counts, letter = np.zeros(1 << bits, np.int64), False
    before = np.array([32], np.uint32)
    for at in range(0, len(text), step):
        cps = np.frombuffer(text[at:at + step].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = kinds[cps]
        letter = letter or bool((kind == 2).any())
        x = np.concatenate([before, np.where(kind > 0, cps, np.uint32(32))])
        fresh_from = len(before)
        keep = np.ones(len(x), bool)
        keep[1:] = (x[1:] != 32) | (x[:-1] != 32)
        fresh_from = int(keep[:fresh_from].sum())
        x = x[keep]
        if at + step >= len(text) and x[-1] != 32:
            x = np.append(x, np.uint32(32))
        for n in (1, 2, 3):
            first = max(0, fresh_from - n + 1)  # grams that end in this slice
            if len(x) - first >= n:
                y = x[first:]
                grams = [y[i:len(y) - n + 1 + i] for i in range(n)]
                codes = _hash(*grams, bits=bits)
                if n == 1:
                    codes = codes[grams[0] != 32]
                counts += np.bincount(codes, minlength=1 << bits)
        before = x[-2:]
    return counts, letter


def _vectors(texts: list[str], idf: np.ndarray, bits: int, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    out, sizes = np.zeros((len(texts), 1 << bits), np.float32), np.zeros(len(texts), np.int64)
    letters = np.zeros(len(texts), bool)
    for i, text in enumerate(texts):
        counts, letters[i] = _counts(text, bits, kinds)
        if letters[i]:
            sizes[i] = counts.sum()
            out[i] = np.sqrt(counts) * idf
    norm = np.sqrt((out.astype(np.float64) ** 2).sum(1, keepdims=True)).astype(np.float32)
    return np.divide(out, norm, out=out, where=norm > 0), sizes, letters


def _steps(sizes: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(sizes, 1)).astype(int).clip(0, 63)


def _cluster(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Spherical k-means: the first centre is the mean's farthest row, each further one the row
    farthest from those before. Rows come in a fixed order, so the result is repeatable."""
    mean = x.mean(0)
    centres = [x[int((x @ mean).argmin())]]
    near = x @ centres[0]
    while len(centres) < min(k, len(x)):
        centres.append(x[int(near.argmin())])
        near = np.maximum(near, x @ centres[-1])
    c = np.stack(centres)
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        moved = np.stack([x[own == j].mean(0) if (own == j).any() else c[j] for j in range(len(c))])
        norm = np.linalg.norm(moved, axis=1, keepdims=True)
        moved = np.divide(moved, norm, out=np.zeros_like(moved), where=norm > 0)
        if np.allclose(moved, c, atol=1e-6):
            break
        c = moved
    return c


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
        config: LangConfig = LangConfig()) -> LangModel:
    """Fit on a bounded sample of ``labelled``; rows without label or without letters teach nothing.

    The sample is chosen by a hash of key and text among all rows; equal rows count once.
    An empty table gives a model that answers ``und``.
    """
    modest_batches(labelled.sparkSession)
    bits = config.dims_log2
    rows = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.where("lang is not null and text is not null")
    totals = rows.groupBy("lang").count().limit(config.max_langs + 1).collect()
    if len(totals) > config.max_langs:
        raise ValueError(f"more than {config.max_langs} languages; raise LangConfig.max_langs")
    if not totals:
        return LangModel(config)
    scale = 1 << 40
    cut = F.create_map(*[F.lit(v) for r in totals for v in (r["lang"], min(scale, 2 * config.sample_per_lang * scale // r["count"]))])
    h = F.xxhash64("key", "text")
    chosen = (rows.withColumn("h", h).where(F.pmod("h", F.lit(scale)) < cut[F.col("lang")])
              .dropDuplicates(["lang", "h"]).select("lang", "h", "text"))

    runs = _kind_runs()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kinds = np.repeat(*runs)
        for pdf in batches:
            for a, b in small_runs(pdf["text"]):
                out = []
                for r in pdf.iloc[a:b].itertuples():
                    counts, letter = _counts(r.text, bits, kinds)
                    if letter:
                        at = counts.nonzero()[0]
                        out.append((r.lang, r.h, at.astype(np.int32), counts[at]))
                yield pd.DataFrame(out, columns=["lang", "h", "at", "n"])

    sample = settle(chosen.mapInPandas(count, "lang string, h long, at array<int>, n array<long>"), "langid")
    seen = sample.count()
    if not seen:
        return LangModel(config)
    df = np.zeros(1 << bits)
    for r in sample.select(F.explode("at").alias("at")).groupBy("at").count().toLocalIterator():  # dims rows at most
        df[r["at"]] = r["count"]
    idf = (np.log((1 + seen) / (1 + df)) + 1).astype(np.float32)

    def centre(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("h").head(config.sample_per_lang)
        x = np.zeros((len(pdf), 1 << bits), np.float32)
        for i, (at, n) in enumerate(zip(pdf["at"], pdf["n"])):
            x[i, at] = np.sqrt(n) * idf[at]
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        c = _cluster(x, config.clusters, config.rounds)
        best, step = (x @ c.T).max(1), _steps(pdf["n"].map(sum).to_numpy())
        floors = np.full(64, 2.0)
        np.minimum.at(floors, step, best)
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centroid": list(c), "floors": [floors] * len(c)})

    found = (sample.groupBy("lang").applyInPandas(centre, "lang string, centroid array<float>, floors array<double>")
             .toPandas().sort_values("lang", kind="stable"))  # languages x clusters rows, at most max_langs x clusters
    floors = np.minimum.reduce([np.asarray(f) for f in found["floors"]])
    # A size that the sample lacks takes what the next smaller size shows, texts below all of them what the first shows.
    known = np.flatnonzero(floors < 2)
    floors = np.array([floors[known[max(0, np.searchsorted(known, i, "right") - 1)]] for i in range(64)])
    floors = np.minimum.accumulate(floors[::-1])[::-1]  # never stricter than for a larger text
    return LangModel(config, list(found["lang"]), np.stack(list(found["centroid"])).astype(np.float32), idf,
                     config.reject_share * floors)


def classifier(model: LangModel):
    """A column function: text to ``struct<lang, score, rejected>``."""
    runs = _kind_runs()

    @F.pandas_udf("struct<lang string, score double, rejected boolean>")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bits, kinds = model.config.dims_log2, np.repeat(*runs)
        names = np.array(model.langs, object)
        for texts in batches:
            out = pd.DataFrame({"lang": UNKNOWN, "score": np.zeros(len(texts)), "rejected": True})
            lang, score, rejected = out["lang"].to_numpy(object).copy(), np.zeros(len(texts)), np.ones(len(texts), bool)
            values = texts.fillna("").tolist()
            if model.centroids is not None:
                for a, b in small_runs(values, most=256):
                    x, sizes, letters = _vectors(values[a:b], model.idf, bits, kinds)
                    cosine = x @ model.centroids.T
                    best = cosine.argmax(1)
                    top = cosine[np.arange(b - a), best].clip(0, 1).astype(np.float64).round(6)
                    lang[a:b] = np.where(letters, names[best], UNKNOWN)
                    score[a:b] = np.where(letters, top, 0.0)
                    rejected[a:b] = ~letters | (top < model.floors[_steps(sizes)])
            out["lang"], out["score"], out["rejected"] = lang, score, rejected
            yield out

    return classify


def identify(docs: DataFrame, model: LangModel, text: str = "text", out: str = "language") -> DataFrame:
    """Add ``out``: struct of ``lang`` (the nearest centroid's), ``score`` (its cosine, 0 to 1) and
    ``rejected`` (farther than the model allows, or no letter at all).

    Null, empty and letterless texts are ``und`` with score 0 and rejected. Whole texts are read.
    Ties between centroids go to the language first by name. All other columns pass through.
    """
    modest_batches(docs.sparkSession)
    return docs.withColumn(out, classifier(model)(F.col(text)))


def held_out(doc_id: Column) -> Column:
    """Rows kept out of fitting: CRC-32 of the id as text leaves 2 when divided by 4. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_held_in(docs: DataFrame, config: LangConfig = LangConfig()) -> LangModel:
    return fit(docs.where(~held_out(F.col("doc_id"))), config=config)


def op1_language_id(docs: DataFrame, config: LangConfig = LangConfig()) -> DataFrame:
    """One row per document: id, held_out, lang_pred, score, rejected."""
    model = fit_held_in(docs, config)
    told = identify(docs.select("doc_id", "text"), model)
    return told.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("language.lang").alias("lang_pred"),
                       F.col("language.score").alias("score"), F.col("language.rejected").alias("rejected"))


def keep_identified(docs: DataFrame, config: LangConfig = LangConfig()) -> DataFrame:
    """The rows that are not rejected, with the columns they came with."""
    name = fresh(docs, "language")
    return identify(docs, fit_held_in(docs, config), out=name).where(~F.col(name)["rejected"]).drop(name)
