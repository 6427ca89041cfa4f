"""Quality classifier: a byte-level convolutional network in numpy.

The whole text is read as UTF-8 bytes. A symbol is a byte together with a copy mark: the last
eight bytes repeat what stood 1 to ``MAX_LAG`` bytes before. Learned filters of ``WIDTH`` symbols
run over the text in steps of two; their rectified outputs are averaged in chunks of 256 bytes
that overlap by half and cover the document to its end, pass one dense layer, are max-pooled
over the chunks, and are combined into one probability.

Learning takes a bounded sample (``SAMPLE_ROWS`` labelled rows of each class, lowest hash of the
id first, of texts up to ``SAMPLE_CHARS``), so at most 2 * SAMPLE_ROWS * SAMPLE_CHARS characters
reach the driver. The weighting of the classes is set to their share of all labelled rows.
Scoring keeps one block of activations at a time, whatever the length of a text.

Edge cases. Null counts as empty; an empty text is scored like any other. Null labels are not
learned from. Without a labelled row, or with one class only, every score is the smoothed share
of label 1. Repeated rows are scored alike; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeflow.llm.common import among_lowest, by_pieces, texts_of

SAMPLE_ROWS = 1000
SAMPLE_CHARS = 20_000
WIDTH, STRIDE, FILTERS, UNITS = 8, 2, 16, 12
BLOCK = 128
MAX_LAG, RUN = 32, 8
PAD = 512
EPOCHS, BATCH_DOCS, RATE = 8, 50, 0.01
SCORE_BYTES = 1 << 20


def embedding() -> np.ndarray:
    """Fixed input values of the 513 symbols: kinds of bytes, the copy mark, and random
    directions that tell single bytes apart."""
    b = np.arange(256)
    upper, lower, digit = (b >= 65) & (b <= 90), (b >= 97) & (b <= 122), (b >= 48) & (b <= 57)
    space, stop, high = (b == 32) | (b == 10), np.isin(b, [44, 46]), b >= 128
    mark = ~(upper | lower | digit | space | stop | high)
    kinds = np.stack([upper, lower, digit, space, stop, high, mark], 1).astype(np.float32)
    noise = np.random.default_rng(7).normal(0, 0.5, (256, 8)).astype(np.float32)
    plain = np.concatenate([kinds, np.zeros((256, 1), np.float32), noise], 1)
    copied = plain.copy()
    copied[:, 7] = 1
    return np.concatenate([plain, copied, np.zeros((1, plain.shape[1]), np.float32)])


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the texts, each padded to whole blocks, and the first block of each text.
    The padding is longer than any lag, so no text is compared with its neighbour."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    blocks = (sizes + MAX_LAG + RUN + BLOCK - 1) // BLOCK
    first = np.concatenate([[0], np.cumsum(blocks)])
    data = np.zeros(first[-1] * BLOCK, np.uint8)
    real = np.zeros(len(data), bool)
    for r, f in zip(raw, (first[:-1] * BLOCK).tolist()):
        data[f:f + len(r)] = np.frombuffer(r, np.uint8)
        real[f:f + len(r)] = True
    before = np.concatenate([np.zeros(MAX_LAG + RUN, np.uint8), data])  # padding, as between two texts
    copied = np.zeros(len(before), bool)
    for lag in range(1, MAX_LAG + 1):
        same = before[lag:] == before[:-lag]
        for step in (1, 2, 4):
            same = same[step:] & same[:-step]
        copied[lag + RUN - 1:] |= same
    out = data.astype(np.int16)
    out[copied[MAX_LAG + RUN:]] += 256
    out[~real] = PAD
    return out, first


class ByteNet:
    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        self.emb = embedding()
        dim = self.emb.shape[1]
        self.p = {
            "filters": r.normal(0, 0.2, (WIDTH, dim, FILTERS)), "filter_bias": np.zeros(FILTERS),
            "dense": r.normal(0, 0.5, (FILTERS, UNITS)), "dense_bias": np.zeros(UNITS),
            "out": r.normal(0, 0.3, UNITS), "out_bias": np.zeros(1)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.shift = 0.0

    def block_sums(self, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per block: sums of the rectified filter outputs, and how many outputs there are."""
        taps = np.stack([self.emb @ w for w in self.p["filters"]]).astype(np.float32)
        padded = np.concatenate([sym, np.full(WIDTH, PAD, np.int16)])
        n, per, step = len(sym) // BLOCK, BLOCK // STRIDE, 2048
        sums, counts = np.empty((n, FILTERS), np.float32), np.empty(n, np.float32)
        for a in range(0, n, step):
            b = min(n, a + step)
            total = np.broadcast_to(self.p["filter_bias"], ((b - a) * per, FILTERS)).copy()
            for t in range(WIDTH):
                total += taps[t].take(padded[a * BLOCK + t:b * BLOCK + t:STRIDE], axis=0)
            np.maximum(total, 0, out=total)
            real = padded[a * BLOCK:b * BLOCK:STRIDE] != PAD
            total[~real] = 0
            sums[a:b] = total.reshape(b - a, per, FILTERS).sum(1)
            counts[a:b] = real.reshape(b - a, per).sum(1)
        return sums, counts

    def forward(self, sym: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        sums, counts = self.block_sums(sym)
        last = np.zeros(len(sums), bool)
        last[first[1:] - 1] = True
        alone = last.copy()
        alone[first[1:] - 1] = np.diff(first) == 1
        follows = np.where(last, 0, 1).astype(np.float32)
        chunk = sums + np.concatenate([sums[1:], sums[:1]]) * follows[:, None]
        count = np.maximum(counts + np.concatenate([counts[1:], counts[:1]]) * follows, 1)
        mean = chunk / count[:, None]
        hidden = np.maximum(mean @ self.p["dense"] + self.p["dense_bias"], 0)
        hidden[last & ~alone] = 0  # the last block stands in the chunk before it
        pooled = np.maximum.reduceat(hidden, first[:-1], axis=0)
        logit = pooled @ self.p["out"] + self.p["out_bias"][0]
        return {"mean": mean, "count": count, "hidden": hidden, "pooled": pooled, "logit": logit, "last": last}

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.forward(*symbols(texts))["logit"].astype(np.float64) + self.shift)))

    def gradients(self, sym: np.ndarray, first: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        f = self.forward(sym, first)
        slope = (1 / (1 + np.exp(-f["logit"])) - labels) / len(labels)
        g = {"out": f["pooled"].T @ slope, "out_bias": np.array([slope.sum()])}
        back = slope[:, None] * self.p["out"] * (f["pooled"] > 0)
        delta = np.zeros_like(f["hidden"])
        for d in range(len(labels)):
            own = f["hidden"][first[d]:first[d + 1]]
            delta[first[d] + own.argmax(0), np.arange(UNITS)] += back[d]
        g["dense"], g["dense_bias"] = f["mean"].T @ delta, delta.sum(0)
        chunk = (delta @ self.p["dense"].T) / f["count"][:, None]
        block = chunk + np.concatenate([chunk[-1:] * 0, chunk[:-1] * (~f["last"][:-1])[:, None]])
        used = np.flatnonzero(np.abs(block).sum(1))
        padded = np.concatenate([sym, np.full(WIDTH, PAD, np.int16)])
        at = used[:, None] * BLOCK + np.arange(0, BLOCK, STRIDE)
        own = np.repeat(block[used], BLOCK // STRIDE, axis=0)
        inputs = self.emb[padded[at.reshape(-1, 1) + np.arange(WIDTH)]].reshape(len(own), -1)
        own *= (inputs @ self.p["filters"].reshape(-1, FILTERS) + self.p["filter_bias"] > 0)
        own[padded[at.ravel()] == PAD] = 0
        g["filters"], g["filter_bias"] = (inputs.T @ own).reshape(self.p["filters"].shape), own.sum(0)
        return g

    def fit(self, texts: list[str], labels: np.ndarray, seed: int = 5) -> None:
        """Adam over shuffled batches of documents."""
        r, step = np.random.default_rng(seed), 0
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        rounds = [EPOCHS // 2, EPOCHS]
        for epoch in range(EPOCHS):
            rate = RATE if epoch < rounds[0] else RATE / 3
            order = r.permutation(len(texts))
            for i in range(0, len(order), BATCH_DOCS):
                part = order[i:i + BATCH_DOCS]
                step += 1
                for k, g in self.gradients(*symbols([texts[j] for j in part]), labels[part]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.p[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)


class ShareOnly:
    """The score where nothing can be learned."""

    def __init__(self, share: float):
        self.share = share

    def scores(self, texts: list[str]) -> np.ndarray:
        return np.full(len(texts), self.share)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", *, exclude: Column | None = None, sample_rows: int = SAMPLE_ROWS,
          sample_chars: int = SAMPLE_CHARS) -> ByteNet | ShareOnly:
    """Learn from a bounded sample of the labelled rows; ``exclude`` marks ids in ``labels``
    that must not be learned from."""
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    known = known.filter(~exclude) if exclude is not None else known
    known = known.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("_label"))
    shares = {r._label: r["count"] for r in known.groupBy("_label").count().collect()}
    prior = (shares.get(1, 0) + 1) / (sum(shares.values()) + 2)
    short = docs.filter(F.length(text_col) <= sample_chars).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = []
    hashed = F.xxhash64("doc_id", F.lit(11))
    for label, count in shares.items():
        ids = known.filter((F.col("_label") == label) & among_lowest(hashed, sample_rows, F.lit(count)))
        ids = ids.orderBy(hashed, "doc_id").limit(sample_rows)
        rows += short.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "_label").collect()
    rows = list({(r.doc_id, r._label): r for r in sorted(rows, key=lambda r: (r.doc_id, r._label, r.text))}.values())
    y = np.array([r._label for r in rows], dtype=np.float32)
    if len(set(y.tolist())) < 2:
        return ShareOnly(prior)
    net = ByteNet()
    net.fit([r.text for r in rows], y)
    net.shift = float(np.log(prior / (1 - prior)) - np.log(y.sum() / (len(y) - y.sum())))
    return net


def score(docs: DataFrame, model: ByteNet | ShareOnly, text_col: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the score of each text in the column ``into``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != into]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = pa.array(sent.value.scores(texts_of(batch, text_col)), pa.float64())
        return pa.RecordBatch.from_arrays([*batch.columns, scores], [*kept, into])

    rows = docs.select(*kept)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(by_pieces(work, text_col, SCORE_BYTES), f"{schema}, `{into}` double")
