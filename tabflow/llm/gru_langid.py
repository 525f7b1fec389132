"""Language identification by a bidirectional gated recurrent network over bytes.

A text is read in windows of 96 bytes, forwards and backwards; at every byte the two
states give the probabilities of the languages, and a text's probabilities are the mean over all
its bytes. The last window of a text ends with the text, so that it overlaps the one before it; no byte
counts twice. Texts shorter than a window are filled up with zero bytes that don't
count. The weights are learnt by backpropagation through time, in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabflow.llm.common import by_bytes, in_bucket, least_hashed, texts, utf8, value_counts

WINDOW = 96
STATES = 8
SAMPLE_DOCS = 4000  # documents to learn from
SAMPLE_WINDOWS = 3  # windows of each, spread evenly over the text
TOGETHER = 2048  # windows read in step
BATCH_BYTES = 1 << 20
UNKNOWN = "und"


def windows(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of every window, its text, which of its bytes count)."""
    length = np.diff(starts)
    count = -(-length // WINDOW)
    text = np.repeat(np.arange(len(length)), count)
    nominal = (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * WINDOW
    begin = np.maximum(0, np.minimum(nominal, length[text] - WINDOW))
    place = begin[:, None] + np.arange(WINDOW)
    counts = (place >= nominal[:, None]) & (place < length[text][:, None])
    at = np.minimum(starts[text][:, None] + place, max(0, len(data) - 1))
    chars = data[at] if len(data) else np.zeros(at.shape, np.uint8)
    return np.where(place < length[text][:, None], chars, 0).astype(np.uint8), text, counts


def _tables(w: dict[str, np.ndarray], side: str) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """Inputs by byte and recurrent weights of the gates; those of z and r are halved, as sigmoid is taken by tanh."""
    halves = {"z": np.float32(0.5), "r": np.float32(0.5), "n": np.float32(1)}
    return ({g: w[f"{side}x{g}"] * k for g, k in halves.items()}, {g: w[f"{side}h{g}"] * k for g, k in halves.items()})


def _read(w: dict[str, np.ndarray], side: str, chars: np.ndarray, scores: np.ndarray, steps: list | None = None) -> None:
    """Adds what the states after every byte say to ``scores`` (language, time, window).

    ``steps`` gets what the way back needs, by time."""
    x, u = _tables(w, side)
    h, say = np.zeros((chars.shape[1], STATES), np.float32), np.ascontiguousarray(w[f"{side}o"].T)
    for t in range(len(chars)) if side == "f" else range(len(chars) - 1, -1, -1):
        c = chars[t]
        z, r = x["z"][c], x["r"][c]
        z += h @ u["z"]
        r += h @ u["r"]
        np.tanh(z, out=z)
        np.tanh(r, out=r)
        z *= 0.5
        z += 0.5
        r *= 0.5
        r += 0.5
        g = h @ u["n"]
        n = r * g
        n += x["n"][c]
        np.tanh(n, out=n)
        before, h = h, h - n
        h *= z
        h += n
        scores[:, t] += say @ h.T
        if steps is not None:
            steps[t] = (before, z, r, g, n, h)


def _softmax(a: np.ndarray) -> np.ndarray:
    a -= a.max(axis=0)
    np.exp(a, out=a)
    a /= a.sum(axis=0)
    return a


@dataclass
class GruModel:
    languages: list[str]
    weights: dict[str, np.ndarray]

    def label(self, chars: np.ndarray) -> np.ndarray:
        """Probabilities at every byte of the windows: (language, time, window)."""
        c = np.ascontiguousarray(chars.T)
        scores = np.empty((len(self.languages), *c.shape), np.float32)
        scores[:] = self.weights["o"][:, None, None]
        _read(self.weights, "f", c, scores)
        _read(self.weights, "b", c, scores)
        return _softmax(scores)

    def pool(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(mean probabilities of every text, share of its bytes labelled with its best language)."""
        n, k = len(starts) - 1, len(self.languages)
        total, votes = np.zeros((n, k)), np.zeros((n, k))
        chars, text, counts = windows(data, starts)
        for lo in range(0, len(chars), TOGETHER):
            p = self.label(chars[lo:lo + TOGETHER])
            weight = counts[lo:lo + TOGETHER].T
            greatest = p.max(axis=0)
            for j in range(k):
                np.add.at(total[:, j], text[lo:lo + TOGETHER], (p[j] * weight).sum(axis=0, dtype=np.float64))
                np.add.at(votes[:, j], text[lo:lo + TOGETHER], ((p[j] == greatest) & weight).sum(axis=0))
        size = np.maximum(1, np.diff(starts))
        top = total.argmax(axis=1)
        return total / size[:, None], votes[np.arange(n), top] / size


def _gradients(w: dict[str, np.ndarray], chars: np.ndarray, counts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    c, weight = np.ascontiguousarray(chars.T), counts.T.astype(np.float32)
    scores = np.empty((len(w["o"]), *c.shape), np.float32)
    scores[:] = w["o"][:, None, None]
    kept: dict[str, list] = {"f": [None] * len(c), "b": [None] * len(c)}
    for side, steps in kept.items():
        _read(w, side, c, scores, steps)
    d = _softmax(scores)
    d[y, :, np.arange(len(y))] -= 1
    d *= weight / max(1.0, weight.sum())
    grads = {k: np.zeros_like(v) for k, v in w.items()}
    grads["o"] = d.sum(axis=(1, 2))
    for side, steps in kept.items():
        dh = np.zeros((len(y), STATES), np.float32)
        for t in range(len(c) - 1, -1, -1) if side == "f" else range(len(c)):
            h, z, r, g, n, after = steps[t]
            grads[f"{side}o"] += after.T @ d[:, t].T
            dh = dh + d[:, t].T @ w[f"{side}o"].T
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * g * r * (1 - r)
            dg = dn * r
            dh = dh * z + dz @ w[f"{side}hz"].T + dr @ w[f"{side}hr"].T + dg @ w[f"{side}hn"].T
            for gate, down, into in (("z", dz, dz), ("r", dr, dr), ("n", dg, dn)):
                grads[f"{side}h{gate}"] += h.T @ down
                np.add.at(grads[f"{side}x{gate}"], c[t], into)
    return grads


def train(chars: np.ndarray, counts: np.ndarray, y: np.ndarray, languages: list[str], steps: int = 240, batch: int = 192,
          rate: float = 0.02, seed: int = 11) -> GruModel:
    """Adam on the cross entropy at every byte that counts."""
    rng = np.random.default_rng(seed)
    w: dict[str, np.ndarray] = {"o": np.zeros(len(languages), np.float32)}
    for side in "fb":
        for gate in "zrn":
            w[f"{side}x{gate}"] = rng.normal(0, 0.4, (256, STATES)).astype(np.float32)
            w[f"{side}h{gate}"] = rng.normal(0, 1 / np.sqrt(STATES), (STATES, STATES)).astype(np.float32)
        w[f"{side}o"] = rng.normal(0, 0.2, (STATES, len(languages))).astype(np.float32)
    m = {k: np.zeros_like(v) for k, v in w.items()}
    s = {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, steps + 1):
        rows = rng.integers(0, len(y), batch)
        pace = rate * (1 - (step - 1) / steps)
        for k, g in _gradients(w, chars[rows], counts[rows], y[rows]).items():
            g = np.clip(g, -0.5, 0.5)
            m[k] = 0.9 * m[k] + 0.1 * g
            s[k] = 0.99 * s[k] + 0.01 * g * g
            w[k] = (w[k] - pace * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    return GruModel(languages, w)


def learn(docs: DataFrame, folds: int = 3, held: int = 1, sample: int = SAMPLE_DOCS, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> GruModel | None:
    """A model from at most ``sample`` documents outside the held-out fold, spread over the languages: of each all, or
    its share, those of the least hash of their id. So a language is learnt however rare it is; only of more than
    ``sample`` languages the less frequent are left out.

    Null languages, null ids and texts without a byte are passed over; None if nothing is left. At most
    ``SAMPLE_WINDOWS`` windows of each document of the sample reach the driver.
    """
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    known = known.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & (F.octet_length("text") > 0) & (in_bucket("id", folds) != held))

    # Only the windows of the sample leave the tasks, not its texts.
    data, last = F.col("text").cast("binary"), F.greatest(F.octet_length("text") - WINDOW, F.lit(0))
    begins = [F.floor(last * i / max(1, SAMPLE_WINDOWS - 1)).cast("int") + 1 for i in range(SAMPLE_WINDOWS)]
    cut = F.array_distinct(F.array(*[F.substring(data, at, F.lit(WINDOW)) for at in begins]))
    counts = value_counts(known, "lang", sample)
    if not counts:
        return None
    rows = least_hashed(known, "id", sample, "lang", counts, cut.alias("w")).collect()
    languages = sorted({r.lang for r in rows})
    parts = [(bytes(p), languages.index(r.lang)) for r in rows for p in r.w]
    starts = np.r_[0, np.cumsum([len(p) for p, _ in parts])]
    chars, _, counts = windows(np.frombuffer(b"".join(p for p, _ in parts), np.uint8), starts)
    return train(chars, counts, np.array([y for _, y in parts]), languages)


def identify(docs: DataFrame, model: GruModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, lang_pred, score and agreement of every row.

    score is the mean probability of lang_pred over all bytes, agreement the share of bytes labelled with it.
    A text that is null or has no letter, and every text where there is no model, gets ``und`` and
    0. Of equal probabilities the language first in the alphabet wins. Rows are read one
    by one: repeated rows and null ids stay, other columns are not read.
    """
    source = docs.select(F.col(id_col), F.col(text_col).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = utf8(batch.column(1))
            best, score, agree = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            lettered = [any(map(str.isalpha, t)) for t in texts(batch.column(1))]
            for lo, hi in by_bytes(starts, BATCH_BYTES) if model is not None else ():
                p, same = model.pool(data[starts[lo]:starts[hi]], starts[lo:hi + 1] - starts[lo])
                for i in range(lo, hi):
                    if lettered[i]:
                        top = int(p[i - lo].argmax())
                        best[i], score[i], agree[i] = model.languages[top], min(1.0, p[i - lo, top]), same[i - lo]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.string()), pa.array(score), pa.array(agree)],
                                             names=[id_col, "lang_pred", "score", "agreement"])

    return source.mapInArrow(run, StructType([source.schema[0]]).add("lang_pred", "string").add("score", "double").add("agreement", "double"))
