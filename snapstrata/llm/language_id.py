"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are cut into windows of about `WINDOW` bytes. In each, one network reads the bytes forward and one backward; both
states at a position give the probabilities of its language, and a document's are the means over all its positions. It is
trained in numpy by backpropagation through time, every position of a window having its document's label. Gates use
x / (1 + |x|) in place of the logistic and hyperbolic curves, which cost numpy several times as much.

The fit sees at most `most` documents of each language, picked by a hash of id and text, and `WINDOWS` windows of each,
spread over the whole text: a bound on what the driver gets (`most` x `WINDOWS` x `WINDOW` bytes a language). All
languages weigh alike. Predictions read whole texts, batch by batch, without a shuffle.

Edge cases: a text that is null or has no letter is `und` with score 0; with one language learnt it is that with score
1; with none all are `und`; a document without an id is never held out; labels without text teach nothing; repeated
rows are predicted each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapstrata.llm.common import mapped, stored, texts

WINDOW, HIDDEN, LANES = 64, 10, 2048
WINDOWS, MOST, STEPS, BATCH = 8, 500, 300, 192
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def _soft(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), in place."""
    size = np.abs(x)
    size += 1
    x /= size
    return x


class Network:
    """Weights of both directions and of the output; arrays are feature by window."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        make = lambda *shape: (rng.normal(size=shape) / np.sqrt(hidden)).astype(np.float32)
        self.weights = {
            **{f"{x}{d}": make(*shape) for d in "fb" for x, shape in (("bytes_", (3 * hidden, 256)), ("state_", (3 * hidden, hidden)), ("out_", (len(languages), hidden)))},
            "bias": np.zeros((len(languages), 1), np.float32),
        }

    def states(self, x: np.ndarray, d: str, trace: list | None = None) -> np.ndarray:
        """States (position, feature, window) of one direction over bytes x (position, window)."""
        n, table, recur = self.hidden, self.weights[f"bytes_{d}"], self.weights[f"state_{d}"]
        h = np.zeros((n, x.shape[1]), np.float32)
        out = np.empty((len(x), n, x.shape[1]), np.float32)
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            g, u = np.take(table, x[t], axis=1), recur @ h
            gates, new, back = g[: 2 * n], g[2 * n :], u[2 * n :]
            gates += u[: 2 * n]
            _soft(gates)
            gates *= 0.5
            gates += 0.5
            keep, reset = gates[:n], gates[n:]
            new += reset * back
            _soft(new)
            if trace is not None:
                trace.append((t, h, keep, reset, new, back))
            h = h - new
            h *= keep
            h += new
            out[t] = h
        return out

    def labels(self, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
        """Probabilities (position, language, window)."""
        z = self.weights["out_f"] @ forward
        z += self.weights["out_b"] @ backward
        z += self.weights["bias"]
        z -= z.max(axis=1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(axis=1, keepdims=True)
        return z

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        """Sums of the probabilities over the positions of each window; windows are (window, position)."""
        out = np.empty((len(windows), len(self.languages)))
        for at in range(0, len(windows), LANES):
            x = np.ascontiguousarray(windows[at : at + LANES].T)
            out[at : at + LANES] = self.labels(self.states(x, "f"), self.states(x, "b")).sum(axis=0).T
        return out

    def gradient(self, windows: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over all positions, and its gradient through time."""
        x, n = np.ascontiguousarray(windows.T), self.hidden
        traces: dict[str, list] = {"f": [], "b": []}
        out = {d: self.states(x, d, traces[d]) for d in "fb"}
        p = self.labels(out["f"], out["b"])
        lanes, scale = np.arange(x.shape[1]), np.float32(1 / x.size)
        loss = -float(np.log(p[:, labels, lanes] + 1e-12).mean())
        p[:, labels, lanes] -= 1
        p *= scale
        grads = {"bias": p.sum(axis=(0, 2))[:, None]}
        eye = np.eye(256, dtype=np.float32)
        for d in "fb":
            grads[f"out_{d}"] = np.einsum("tlb,tnb->ln", p, out[d], optimize=True)
            from_out = self.weights[f"out_{d}"].T @ p
            recur = self.weights[f"state_{d}"]
            d_bytes, d_state = np.zeros((3 * n, 256), np.float32), np.zeros_like(recur)
            dh = np.zeros((n, x.shape[1]), np.float32)
            for t, h, keep, reset, new, back in reversed(traces[d]):
                dh = dh + from_out[t]
                d_new = dh * (1 - keep) * (1 - np.abs(new)) ** 2
                # A gate is (1 + s) / 2; the slope of s is (1 - |s|) squared.
                d_keep = dh * (h - new) * 0.5 * (1 - np.abs(2 * keep - 1)) ** 2
                d_reset = d_new * back * 0.5 * (1 - np.abs(2 * reset - 1)) ** 2
                d_in = np.concatenate([d_keep, d_reset, d_new])
                d_bytes += d_in @ eye[x[t]]
                d_in[2 * n :] *= reset
                d_state += d_in @ h.T
                dh = dh * keep + recur.T @ d_in
            grads[f"bytes_{d}"], grads[f"state_{d}"] = d_bytes, d_state
        return loss, grads


def trained(windows: np.ndarray, labels: np.ndarray, languages: list[str], steps: int = STEPS, hidden: int = HIDDEN) -> Network:
    """Windows (window, position) with the number of their language; every step draws as many of each language."""
    network, rng = Network(languages, hidden), np.random.default_rng(1)
    by_label = [np.flatnonzero(labels == k) for k in range(len(languages))]
    mean = {k: np.zeros_like(w) for k, w in network.weights.items()}
    spread = {k: np.zeros_like(w) for k, w in network.weights.items()}
    for step in range(1, steps + 1) if len(languages) > 1 else ():
        drawn = np.concatenate([rng.choice(members, max(1, BATCH // len(languages))) for members in by_label])
        _, grads = network.gradient(windows[drawn], labels[drawn])
        size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = 0.02 * (1 - (step - 1) / steps)
        for k, g in grads.items():
            g = g / max(1.0, size)
            mean[k] = 0.9 * mean[k] + 0.1 * g
            spread[k] = 0.99 * spread[k] + 0.01 * g * g
            network.weights[k] -= (rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(spread[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return network


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def cuts(length: int, window: int = WINDOW) -> np.ndarray:
    """Edges of windows of nearly equal length over so many bytes."""
    n = -(-length // window)
    return np.arange(n + 1) * length // max(n, 1)


def fitted(docs: DataFrame, most: int = MOST, steps: int = STEPS, hidden: int = HIDDEN) -> Network:
    """A network of the non-null languages of documents that are not held out."""
    c = F.col
    known = docs.select("doc_id", "text", c("lang").cast("string").alias("lang")).where(c("lang").isNotNull() & c("text").isNotNull() & ~held_out(c("doc_id")))
    # A hash below a share of its range first, so that few rows beyond the bound are ranked, whatever a language's size.
    # Stored, so that Spark knows that this table is small and doesn't deal the texts by language to join it.
    counts = stored(known.groupBy("lang").agg(F.count("*").alias("n")), "langs")
    draw = F.xxhash64(F.lit(12), "doc_id", "text")
    share = F.least(F.lit(1.0), F.lit(2.0 * most) / c("n"))
    near = known.join(counts, "lang").withColumn("draw", draw).where((c("draw") / 2.0**64 + 0.5) <= share)
    picked = near.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("draw"))).where(c("place") <= most)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, windows = [], []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                edges = cuts(len(text))
                for k in sorted({i * (len(edges) - 1) // WINDOWS for i in range(WINDOWS)}) if text else ():
                    langs.append(lang)
                    # Filled up with spaces, so that all of a step have one length.
                    windows.append(text[edges[k] : edges[k + 1]].ljust(WINDOW))
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(windows, pa.binary())], ["lang", "bytes"])

    sample = picked.select("lang", "text").mapInArrow(rows, "lang string, bytes binary").orderBy("lang", "bytes").toArrow()
    languages = sorted(set(sample["lang"].to_pylist()))
    number = {x: i for i, x in enumerate(languages)}
    windows = np.frombuffer(b"".join(sample["bytes"].to_pylist()), np.uint8).reshape(-1, WINDOW)
    return trained(windows, np.array([number[x] for x in sample["lang"].to_pylist()], np.int64), languages, steps, hidden)


def pooled(network: Network, batch: list[bytes]) -> np.ndarray:
    """Mean probabilities (document, language); zeros for empty texts. Windows of one length are read together."""
    lengths = np.fromiter(map(len, batch), np.int64, len(batch))
    n = -(-lengths // WINDOW)
    doc = np.repeat(np.arange(len(batch)), n)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    base = np.repeat(np.cumsum(lengths) - lengths, n)
    start, stop = (base + i * lengths[doc] // np.maximum(n[doc], 1) for i in (k, k + 1))
    data, size = np.frombuffer(b"".join(batch), np.uint8), stop - start
    sums = np.zeros((len(batch), len(network.languages)))
    for length in np.unique(size).tolist():
        these = np.flatnonzero(size == length)
        got = network.pooled(data[start[these][:, None] + np.arange(length)])
        for j in range(sums.shape[1]):
            sums[:, j] += np.bincount(doc[these], got[:, j], len(batch))
    return sums / np.maximum(lengths, 1)[:, None]


def predicted(docs: DataFrame, network: Network) -> DataFrame:
    """doc_id, held_out, lang_pred, score (mean probability of that language over all positions)."""

    def rows(batch: list[bytes], columns: pa.RecordBatch) -> dict:
        langs, scores, start = [], [], 0
        while start < len(batch):
            # A few megabytes of text at a time.
            stop, size = start, 0
            while stop < len(batch) and (size < 1 << 21 or stop == start):
                size += len(batch[stop])
                stop += 1
            part = batch[start:stop]
            lettered = np.array([LETTER.search(x.decode("utf-8", "replace")) is not None for x in part]) & bool(network.languages)
            means = pooled(network, part) if network.languages else np.zeros((len(part), 1))
            for has, best, score in zip(lettered.tolist(), means.argmax(axis=1).tolist(), means.max(axis=1).tolist()):
                langs.append(network.languages[best] if has else UNKNOWN)
                scores.append(min(1.0, score) if has else 0.0)
            start = stop
        return {"lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64())}

    id_type = docs.schema["doc_id"].dataType.simpleString()
    base = texts(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), "held_out")
    return mapped(base, rows, f"doc_id {id_type}, held_out boolean, lang_pred string, score double", ("doc_id", "held_out"))
