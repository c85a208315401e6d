"""Language identification by a byte convolutional network, trained and applied in numpy.

Byte embeddings, filters of several widths, ReLU, max pooling over a window,
softmax. Training takes labelled rows of the training part only: from each of
`PER_LANGUAGE` hash buckets of a language the row with the least hash, and of
its text one window at a hash-chosen place; so the sample is bounded and the
same on every run. A whole text is predicted in consecutive fixed-length
windows, whose probabilities are averaged by their bytes.

For prediction the filters become tables over byte pairs: a window's responses
are sums of table rows, with no multiplication left.

Null texts and texts without letters are `und` with score 0; so is everything
where no row is labelled. Repeated rows are predicted each; an empty table
gives an empty result. A text's length is not bounded: its windows are worked
off in slices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._text import raw
from tidemark.sources.tables import table

PER_LANGUAGE = 768  # the bound on training rows of a language
WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
STEPS = 600
BATCH = 64
UNKNOWN = "und"
STEP_BYTES = 1 << 18


def remainder(doc_id: Column, by: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % by


def training_windows(docs: DataFrame, per_language: int) -> list[tuple[str, bytes]]:
    """(lang, window) of the sample, of at most `per_language` rows a language."""
    h = F.xxhash64(F.col("doc_id"), F.lit("language"))
    start = F.pmod(h, F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1) + 1
    window = F.lower(F.substr("text", start.cast("int"), F.lit(WINDOW)))
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.rlike("text", F.lit(r"\p{L}")) & (F.coalesce(remainder(F.col("doc_id"), 3), F.lit(0)) != 1))
    found = labelled.groupBy("lang", F.pmod(F.xxhash64("doc_id"), F.lit(per_language)).alias("bucket")).agg(F.min(F.struct(h.alias("h"), window.alias("window"))).alias("least"))
    rows = [(r["lang"], r["h"], r["window"].encode()[:WINDOW]) for r in found.select("lang", "least.h", "least.window").collect()]
    return [(lang, w) for lang, _, w in sorted(rows)]


class ByteNetwork:
    def __init__(self, classes: list[str], seed: int = 7):
        r = np.random.default_rng(seed)
        self.classes = classes
        self.embed = r.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32)
        self.filters = [r.normal(0, 1 / np.sqrt(w * EMBEDDING), (w * EMBEDDING, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = r.normal(0, 0.1, (FILTERS * len(WIDTHS), len(classes))).astype(np.float32)
        self.out_bias = np.zeros(len(classes), np.float32)

    def fit(self, windows: np.ndarray, labels: np.ndarray, steps: int = STEPS, seed: int = 11) -> None:
        """Adam on cross-entropy; gradients go to each filter's best place in a window."""
        r = np.random.default_rng(seed)
        params = [self.embed, *self.filters, *self.bias, self.out, self.out_bias]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        while step < steps:
            for rows in np.array_split(r.permutation(len(windows)), max(1, len(windows) // BATCH)):
                x, y = windows[rows], labels[rows]
                e = self.embed[x]
                pooled, places = [], []
                for w, f, b in zip(WIDTHS, self.filters, self.bias, strict=True):
                    spans = np.lib.stride_tricks.sliding_window_view(e, w, axis=1).transpose(0, 1, 3, 2).reshape(len(x), x.shape[1] - w + 1, -1)
                    z = spans @ f + b
                    at = z.argmax(1)
                    pooled.append(np.take_along_axis(z, at[:, None], 1)[:, 0])
                    places.append(at)
                z = np.concatenate(pooled, 1)
                a = np.maximum(z, 0)
                s = a @ self.out + self.out_bias
                s = np.exp(s - s.max(1, keepdims=True))
                s /= s.sum(1, keepdims=True)
                s[np.arange(len(y)), y] -= 1
                s /= len(y)
                grads_out, grads_out_bias = a.T @ s, s.sum(0)
                back = (s @ self.out.T) * (z > 0)
                g_embed = np.zeros_like(self.embed)
                g_filters, g_bias = [], []
                for k, (w, f) in enumerate(zip(WIDTHS, self.filters, strict=True)):
                    d = back[:, k * FILTERS : (k + 1) * FILTERS]
                    idx = places[k][:, :, None] + np.arange(w)
                    seen = x[np.arange(len(x))[:, None, None], idx]
                    span = self.embed[seen].reshape(len(x), FILTERS, w * EMBEDDING)
                    g_filters.append(np.einsum("bf,bfe->ef", d, span))
                    g_bias.append(d.sum(0))
                    to = (d[:, :, None] * f.T[None]).reshape(len(x), FILTERS, w, EMBEDDING)
                    np.add.at(g_embed, seen.reshape(-1), to.reshape(-1, EMBEDDING))
                step += 1
                rate = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for p, g, m, v in zip(params, [g_embed, *g_filters, *g_bias, grads_out, grads_out_bias], first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)

    def tables(self) -> dict:
        """The network as sums of table rows: for each width, tables over byte pairs, and one over bytes where the width is odd."""
        out = []
        for w, f, b in zip(WIDTHS, self.filters, self.bias, strict=True):
            single = [self.embed @ f[j * EMBEDDING : (j + 1) * EMBEDDING] for j in range(w)]
            parts = []
            for j in range(0, w - 1, 2):
                parts.append((j, True, (single[j][:, None] + single[j + 1][None] + (b if j == 0 else 0)).reshape(65536, FILTERS).astype(np.float32)))
            if w % 2:
                parts.append((w - 1, False, single[w - 1].astype(np.float32)))
            out.append((w, parts))
        return {"widths": out, "out": self.out, "out_bias": self.out_bias, "classes": self.classes}


def probabilities(tables: dict, windows: np.ndarray) -> np.ndarray:
    """Class probabilities of windows (n, WINDOW) of bytes."""
    pairs = (windows[:, :-1].astype(np.int32) << 8) | windows[:, 1:]
    pooled = []
    for w, parts in tables["widths"]:
        n = windows.shape[1] - w + 1
        z = None
        for j, pair, t in parts:
            got = np.take(t, (pairs if pair else windows)[:, j : j + n], axis=0)
            z = got if z is None else np.add(z, got, out=z)
        pooled.append(z.max(1))
    s = np.maximum(np.concatenate(pooled, 1), 0) @ tables["out"] + tables["out_bias"]
    s = np.exp(s - s.max(1, keepdims=True))
    return s / s.sum(1, keepdims=True)


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All rows' bytes in windows, the last of a row padded with 0; the row and the bytes of each window."""
    lengths = np.diff(offsets)
    counts = -(-lengths // WINDOW)
    first = np.concatenate([[0], np.cumsum(counts)])
    flat = np.zeros(int(first[-1]) * WINDOW, np.uint8)
    if len(data):
        flat[np.arange(len(data)) + np.repeat(first[:-1] * WINDOW - offsets[:-1], lengths)] = data
    rows = np.repeat(np.arange(len(lengths)), counts)
    held = np.full(len(rows), WINDOW)
    full = counts > 0
    held[first[1:][full] - 1] = lengths[full] - (counts[full] - 1) * WINDOW
    return flat.reshape(-1, WINDOW), rows, held


def predictor(model: dict):
    """A function of a lower-cased text and whether it has letters: its language and score. Only these two columns go to Python."""
    names = np.array([*model["classes"], UNKNOWN], dtype=object)
    shape = ByteNetwork(model["classes"])
    shape.embed, shape.filters, shape.bias, shape.out, shape.out_bias = (model[k] for k in ("embed", "filters", "bias", "out", "out_bias"))

    def run(rows: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        tables = shape.tables()
        k = len(model["classes"])
        step = STEP_BYTES // WINDOW
        for text, letters in rows:
            data, offsets = raw(text)
            spoken = np.asarray(letters.fill_null(False))
            total = np.zeros((len(text), k))
            at = 0
            while at < len(text):
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (2 << 20), side="right")) - 1)
                wins, owner, held = windows_of(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
                for w in range(0, len(wins), step):
                    p = probabilities(tables, wins[w : w + step]) * held[w : w + step, None]
                    np.add.at(total, owner[w : w + step] + at, p)
                at = to
            mean = total / np.maximum(np.diff(offsets), 1)[:, None]
            best = mean.argmax(1) if k else np.zeros(len(text), int)
            ok = spoken & (np.diff(offsets) > 0) & (k > 0)
            score = np.where(ok, mean[np.arange(len(text)), best] if k else 0.0, 0.0)
            yield pa.StructArray.from_arrays([pa.array(names[np.where(ok, best, k)], pa.string()), pa.array(np.clip(score, 0.0, 1.0), pa.float64())], ["lang", "score"])

    return F.arrow_udf(run, "lang string, score double")


def fitted(docs: DataFrame, per_language: int = PER_LANGUAGE) -> dict:
    """The network's weights, fitted on the bounded sample of (doc_id, text, lang)."""
    sample = training_windows(docs, per_language)
    classes = sorted({lang for lang, _ in sample})
    net = ByteNetwork(classes)
    if len(classes) > 1:
        # each window also cut short, for short texts
        cut = [(lang, w[: 12 + (i * 37) % (WINDOW - 12)]) for i, (lang, w) in enumerate(sample)]
        both = sample + cut
        x = np.zeros((len(both), WINDOW), np.uint8)
        for i, (_, w) in enumerate(both):
            x[i, : len(w)] = np.frombuffer(w, np.uint8)
        net.fit(x, np.array([classes.index(lang) for lang, _ in both]))
    return {"classes": classes, "embed": net.embed, "filters": net.filters, "bias": net.bias, "out": net.out, "out_bias": net.out_bias}


def identify(docs: DataFrame, model: dict, found: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All columns of docs, of which `text` is read, and the language and its score under the names in `found`."""
    told = predictor(model)(F.lower("text"), F.rlike("text", F.lit(r"\p{L}")))
    both = docs.select(F.struct("*").alias("row"), told.alias("told"))
    return both.select("row.*", F.col("told.lang").alias(found[0]), F.col("told.score").alias(found[1]))


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").selectExpr("cast(doc_id as bigint) as doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), fitted(docs))
    return found.select("doc_id", (F.coalesce(remainder(F.col("doc_id"), 3), F.lit(0)) == 1).alias("held_out"), "lang_pred", "score")
