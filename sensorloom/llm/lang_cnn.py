"""Language of a text by a byte-level convolutional network.

Bytes are embedded, convolved with filters of several widths, max-pooled over a window of fixed length
and classified by a softmax; everything is numpy, trained here on a bounded sample of labelled texts. A
text is cut into windows that cover it whole; its prediction is the mean of the windows' log
probabilities, each weighted by the bytes it holds. For prediction the embedding is folded into the
filters: the response of a filter is a sum of table rows, one for each pair of neighbouring bytes.

The sample: of each of the ``max_languages`` most frequent labels, about ``per_language`` texts that the
hash of their text picks (all when there are no more), one stretch of each. Nothing but the text and the
label is used.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is every text
when there is nothing to learn from; equal texts get equal predictions; an empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from sensorloom.llm.common import crc_bucket

UNKNOWN = "und"
LETTER_OR_NUMBER = re.compile(r"[^\W\d_]")
#: Windows that are convolved at once.
CHUNK = 128


@dataclass(frozen=True)
class Settings:
    per_language: int = 1500
    max_languages: int = 100
    window: int = 256
    embedding: int = 8
    filters: int = 16
    widths: tuple[int, ...] = (2, 3, 4)
    epochs: int = 12
    batch: int = 64
    rate: float = 4e-3
    seed: int = 7


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)


@dataclass
class Network:
    """Weights: embedding (256, d), filters[w] (w * d, f) with biases, and the softmax layer."""

    languages: list[str]
    window: int
    embedding: np.ndarray
    filters: dict[int, np.ndarray]
    biases: dict[int, np.ndarray]
    dense: np.ndarray
    offset: np.ndarray

    def tables(self) -> dict[int, list[tuple[np.ndarray, int, bool]]]:
        """Per width: (table, place, pair); a pair's table is indexed by two bytes."""
        d, out = self.embedding.shape[1], {}
        for width, weights in self.filters.items():
            single = [self.embedding @ weights[i * d : (i + 1) * d] for i in range(width)]
            parts = []
            for i in range(0, width - 1, 2):
                pair = (single[i][:, None, :] + single[i + 1][None, :, :]).reshape(65536, -1)
                parts.append((np.ascontiguousarray(pair, np.float32), i, True))
            if width % 2:
                parts.append((np.ascontiguousarray(single[-1], np.float32), width - 1, False))
            out[width] = parts
        return out

    def log_probabilities(self, windows: np.ndarray, tables: dict) -> np.ndarray:
        """Of each row of ``windows`` (bytes)."""
        pooled = []
        pairs = windows[:, :-1].astype(np.int32) * 256 + windows[:, 1:]
        for width, parts in tables.items():
            n = self.window - width + 1
            total = None
            for table, place, is_pair in parts:
                source = pairs if is_pair else windows
                rows = table.take(source[:, place : place + n], axis=0)
                total = rows if total is None else np.add(total, rows, out=total)
            pooled.append(np.maximum(total.max(axis=1) + self.biases[width], 0))
        return _log_softmax(np.hstack(pooled) @ self.dense + self.offset)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def has_letter(text: str) -> bool:
    """Whether a text has a letter; numbers such as superscripts and fractions are none."""
    return any(found.group().isalpha() for found in LETTER_OR_NUMBER.finditer(text))


def trained(texts: list[str], labels: list[str], settings: Settings = Settings()) -> Network | None:
    """Fit a network by Adam; None without texts that have letters."""
    pairs = [(t, x) for t, x in zip(texts, labels, strict=True) if t and has_letter(t)]
    if not pairs:
        return None
    random = np.random.default_rng(settings.seed)
    languages = sorted({x for _, x in pairs})
    target = np.array([languages.index(x) for _, x in pairs])
    data = np.zeros((len(pairs), settings.window), np.uint8)
    sizes = np.zeros(len(pairs), np.int64)
    for i, (text, _) in enumerate(pairs):
        some = _bytes(text)[: settings.window]
        data[i, : len(some)], sizes[i] = some, len(some)
    d, f = settings.embedding, settings.filters
    weights = {"embedding": random.normal(0, 0.5, (256, d)), "offset": np.zeros(len(languages))}
    for width in settings.widths:
        weights[f"filter{width}"] = random.normal(0, (width * d) ** -0.5, (width * d, f))
        weights[f"bias{width}"] = np.zeros(f)
    weights["dense"] = random.normal(0, (f * len(settings.widths)) ** -0.5, (f * len(settings.widths), len(languages)))
    weights = {k: v.astype(np.float32) for k, v in weights.items()}
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for epoch in range(settings.epochs):
        order = random.permutation(len(pairs))
        for at in range(0, len(order), settings.batch):
            picked = order[at : at + settings.batch]
            batch = data[picked].copy()
            # Some windows are cut short, as short texts have little to go by.
            cut = np.where(random.random(len(picked)) < 0.3, random.integers(12, settings.window, len(picked)), settings.window)
            batch[np.arange(settings.window) >= cut[:, None]] = 0
            slopes = _slopes(batch, target[picked], weights, settings)
            step += 1
            rate = settings.rate * (1 - epoch / settings.epochs)
            for k, g in slopes.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                weights[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
    return Network(
        languages,
        settings.window,
        weights["embedding"],
        {w: weights[f"filter{w}"] for w in settings.widths},
        {w: weights[f"bias{w}"] for w in settings.widths},
        weights["dense"],
        weights["offset"],
    )


def _slopes(batch: np.ndarray, target: np.ndarray, weights: dict, settings: Settings) -> dict:
    """Gradient of the mean cross-entropy. Through max pooling it reaches one place per filter."""
    n, d, f = len(batch), settings.embedding, settings.filters
    embedded = weights["embedding"][batch]
    flat = embedded.reshape(n, -1)
    pooled, places = [], {}
    for width in settings.widths:
        places_n = settings.window - width + 1
        strides = (flat.strides[0], d * flat.strides[1], flat.strides[1])
        patches = np.lib.stride_tricks.as_strided(flat, (n, places_n, width * d), strides)
        response = (patches.reshape(-1, width * d) @ weights[f"filter{width}"]).reshape(n, places_n, f)
        places[width] = response.argmax(axis=1)
        pooled.append(response.max(axis=1) + weights[f"bias{width}"])
    raw = np.hstack(pooled)
    active = np.maximum(raw, 0)
    error = np.exp(_log_softmax(active @ weights["dense"] + weights["offset"]))
    error[np.arange(n), target] -= 1
    error /= n
    slopes = {"dense": active.T @ error, "offset": error.sum(axis=0), "embedding": np.zeros_like(weights["embedding"])}
    back = (error @ weights["dense"].T) * (raw > 0)
    for i, width in enumerate(settings.widths):
        part = back[:, i * f : (i + 1) * f]
        slopes[f"bias{width}"] = part.sum(axis=0)
        place = places[width][:, :, None] + np.arange(width)
        seen = batch[np.arange(n)[:, None, None], place]
        patches = weights["embedding"][seen].reshape(n, f, width * d)
        slopes[f"filter{width}"] = np.einsum("nf,nfk->kf", part, patches)
        down = part[:, :, None] * weights[f"filter{width}"].T[None]
        np.add.at(slopes["embedding"], seen.reshape(-1), down.reshape(-1, d))
    return {k: v.astype(np.float32) for k, v in slopes.items()}


def sample(docs: DataFrame, settings: Settings = Settings()) -> tuple[list[str], list[str]]:
    """The bounded sample of ``docs`` (text, lang) that a network is fitted on."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(settings.max_languages).collect()
    if not counts:
        return [], []
    limit = F.lit(0)
    for row in counts:
        share = min(1.0, 1.3 * settings.per_language / row["count"])
        limit = F.when(F.col("lang") == row["lang"], int(share * 1_000_000)).otherwise(limit)
    pick = F.xxhash64("text")
    start = F.pmod(F.xxhash64(pick), F.greatest(F.length("text") - settings.window, F.lit(1))) + 1
    some = labelled.where(F.pmod(pick, F.lit(1_000_000)) < limit).select(
        "lang", pick.alias("pick"), F.col("text").substr(start.cast("int"), F.lit(settings.window)).alias("part")
    )
    first = Window.partitionBy("lang").orderBy("pick", "part")
    some = some.withColumn("n", F.row_number().over(first)).where(F.col("n") <= settings.per_language)
    rows = some.orderBy("lang", "n").select("part", "lang").collect()
    return [r["part"] for r in rows], [r["lang"] for r in rows]


_FOLDED: list = []  # the network that this worker last used, and its tables


def _tables(network: Network | None) -> dict | None:
    if network is None:
        return None
    if not _FOLDED or _FOLDED[0] is not network:
        _FOLDED[:] = [network, network.tables()]
    return _FOLDED[1]


def predict(texts: list[str | None], network: Network | None, tables: dict | None) -> list[tuple[str, float]]:
    """Language and score of whole texts."""
    out = [(UNKNOWN, 0.0)] * len(texts)
    if network is None:
        return out
    sums = np.zeros((len(texts), len(network.languages)))
    sizes = np.zeros(len(texts))
    held: list[tuple[int, np.ndarray]] = []

    def flush() -> None:
        windows = np.zeros((len(held), network.window), np.uint8)
        for i, (_, some) in enumerate(held):
            windows[i, : len(some)] = some
        lengths = np.array([len(some) for _, some in held])
        owners = np.array([owner for owner, _ in held])
        np.add.at(sums, owners, network.log_probabilities(windows, tables) * lengths[:, None])
        held.clear()

    for i, text in enumerate(texts):
        if not isinstance(text, str) or not has_letter(text):
            continue
        data = _bytes(text)
        sizes[i] = len(data)
        for at in range(0, len(data), network.window):
            held.append((i, data[at : at + network.window]))
            if len(held) == CHUNK:
                flush()
    if held:
        flush()
    has = sizes > 0
    share = np.exp(_log_softmax(sums[has] / sizes[has, None]))
    for i, p in zip(np.flatnonzero(has), share, strict=True):
        best = int(p.argmax())
        out[i] = (network.languages[best], float(p[best]))
    return out


def identified(docs: DataFrame, settings: Settings = Settings(), modulus: int = 3, held: int = 1) -> DataFrame:
    """doc_id, held_out, lang_pred and score; learned from the rows that are not held out."""
    split = docs.select("doc_id", (crc_bucket(F.col("doc_id"), modulus) == held).alias("held_out"), "text", "lang")
    network = trained(*sample(split.where(~F.col("held_out")).select("text", "lang"), settings), settings)
    # A network has fixed size (tens of kB), whatever the corpus.
    shared = docs.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("lang_pred string, score double")
    def language(texts: pd.Series) -> pd.DataFrame:
        fitted = shared.value
        return pd.DataFrame(predict(list(texts), fitted, _tables(fitted)), columns=["lang_pred", "score"])

    found = split.select("doc_id", "held_out", language("text").alias("l"))
    return found.select("doc_id", "held_out", "l.lang_pred", "l.score")
