"""Language identification with a byte-level convolutional network.

Letters' bytes in fixed windows pass through filters of several widths, are
max-pooled over the window and classified by softmax. The network is trained
in numpy on windows of labelled texts. Applied, a filter is a sum of table
look-ups: the rows of a byte, or of a pair of bytes, are the embedding times
the filter's weights, worked out once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents of each language that a fit uses about at most, chosen by hash of the key.
SAMPLE_ROWS = 1_200
#: Languages that a network tells apart at most: the commonest ones.
LANGUAGES = 256
#: Bytes of a window, filter widths, filters of each width, size of the byte embedding.
WINDOW, WIDTHS, FILTERS, EMBED = 256, (2, 3, 4), 16, 8
#: Windows worked on at a time.
BATCH_WINDOWS = 256
UNKNOWN = "und"
#: ASCII bytes that are no letters and no white space.
NOT_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha() and not chr(b).isspace())


def text_bytes(text: str) -> bytes:
    """What the network reads of a text: lower case, without ASCII digits and signs."""
    return text.lower().encode("utf-8", "replace").translate(None, NOT_LETTERS)


def windows(data: bytes) -> np.ndarray:
    """All of ``data`` as rows of ``WINDOW`` bytes, the last padded with zeros."""
    n = max(1, -(-len(data) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[:len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(n, WINDOW)


@dataclass
class ByteCnn:
    """Embedding, one weight block for each width, and the softmax layer."""

    langs: list[str]
    embed: np.ndarray
    filters: list[np.ndarray]
    offsets: list[np.ndarray]
    dense: np.ndarray
    bias: np.ndarray
    tables: list = field(default_factory=list, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"tables": []}

    @classmethod
    def initial(cls, langs: list[str], rng: np.random.Generator) -> ByteCnn:
        return cls(langs, rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
                   [rng.normal(0, (w * EMBED) ** -0.5, (w, EMBED, FILTERS)).astype(np.float32) for w in WIDTHS],
                   [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
                   rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(langs))).astype(np.float32),
                   np.zeros(len(langs), np.float32))

    def _tables(self):
        """For each width its look-ups: (offset of the byte, table by byte) or
        (offset of the pair, table by pair)."""
        if not self.tables:
            for block in self.filters:
                rows = [self.embed @ w for w in block]
                looks = [(k, True, (rows[k][:, None] + rows[k + 1][None]).reshape(65536, FILTERS))
                         for k in range(0, len(rows) - 1, 2)]
                looks += [(len(rows) - 1, False, rows[-1])] * (len(rows) % 2)
                self.tables.append(looks)
        return self.tables

    def pooled(self, x: np.ndarray) -> np.ndarray:
        """Window rows -> the largest answer of every filter, rectified."""
        n, size = x.shape
        pairs = (x[:, :-1].astype(np.uint16) << 8) | x[:, 1:]
        out = []
        for width, looks, offset in zip(WIDTHS, self._tables(), self.offsets):
            span, total = size - width + 1, None
            for at, paired, table in looks:
                part = table.take((pairs if paired else x)[:, at:at + span], axis=0)
                total = part if total is None else np.add(total, part, out=total)
            out.append(np.maximum(total.max(axis=1) + offset, 0))
        return np.concatenate(out, axis=1)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = self.pooled(x) @ self.dense + self.bias
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def predict(self, texts) -> list[tuple[str, float]]:
        """(language, score) of whole texts: the mean answer of a text's
        windows, each weighted by its bytes."""
        out: list = [(UNKNOWN, 0.0)] * len(texts)
        rows, held, pending = [], 0, []

        def flush():
            x = np.concatenate(rows)
            p = np.concatenate([self.probabilities(x[a:a + BATCH_WINDOWS]) for a in range(0, len(x), BATCH_WINDOWS)])
            p *= (x != 0).sum(axis=1, keepdims=True)
            begins = np.cumsum([0] + [len(r) for r in rows[:-1]])
            sums = np.add.reduceat(p, begins, axis=0)
            sums /= sums.sum(axis=1, keepdims=True)
            for i, s in zip(pending, sums):
                out[i] = (self.langs[int(s.argmax())], float(s.max()))

        for i, text in enumerate(texts):
            if not self.langs or text is None or not any(map(str.isalpha, text)):
                continue
            data = text_bytes(text)
            if not data.strip(b"\0"):
                continue
            rows.append(windows(data))
            pending.append(i)
            held += len(rows[-1])
            if held >= 16 * BATCH_WINDOWS:
                flush()
                rows, held, pending = [], 0, []
        if rows:
            flush()
        return out


def train_network(x: np.ndarray, y: np.ndarray, langs: list[str], epochs: int = 6, batch: int = 64,
                  rate: float = 4e-3, seed: int = 7) -> ByteCnn:
    """Adam over shuffled windows; the gradient of max pooling reaches only
    the position that answered most."""
    rng = np.random.default_rng(seed)
    net = ByteCnn.initial(langs, rng)
    params = [net.embed, *net.filters, *net.offsets, net.dense, net.bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            rows = order[at:at + batch]
            xb, n = x[rows], len(rows)
            emb = net.embed[xb]
            picked, pooled = [], []
            for width, block, offset in zip(WIDTHS, net.filters, net.offsets):
                span = WINDOW - width + 1
                answers = sum(emb[:, k:k + span] @ block[k] for k in range(width))
                best = answers.argmax(axis=1)
                picked.append(best)
                pooled.append(np.take_along_axis(answers, best[:, None], axis=1)[:, 0] + offset)
            raw = np.concatenate(pooled, axis=1)
            h = np.maximum(raw, 0)
            z = h @ net.dense + net.bias
            e = np.exp(z - z.max(axis=1, keepdims=True))
            dz = e / e.sum(axis=1, keepdims=True)
            dz[np.arange(n), y[rows]] -= 1
            dz /= n
            dh = (dz @ net.dense.T) * (raw > 0)
            d_embed = np.zeros_like(net.embed)
            d_filters, d_offsets = [], []
            for j, (width, block) in enumerate(zip(WIDTHS, net.filters)):
                g = dh[:, j * FILTERS:(j + 1) * FILTERS]
                d_offsets.append(g.sum(axis=0))
                d_block = np.zeros_like(block)
                for k in range(width):
                    place = picked[j] + k
                    seen = xb[np.arange(n)[:, None], place]  # the byte under each filter's best position
                    d_block[k] = np.einsum("nfe,nf->ef", net.embed[seen], g)
                    np.add.at(d_embed, seen, g[..., None] * block[k].T[None])
                d_filters.append(d_block)
            grads = [d_embed, *d_filters, *d_offsets, h.T @ dz, dz.sum(axis=0)]
            step += 1
            for p, g, (m, v) in zip(params, grads, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


def fit(docs: DataFrame, train: Column | None = None, key_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS, epochs: int = 6) -> ByteCnn:
    """Train on documents that satisfy ``train`` and have a language.

    About ``sample_rows`` documents of each language, chosen by key hash, give
    three stretches of text each; nothing else of a document is read. Repeated
    rows count once. Without any such document, as in an empty table, every
    text is ``und``.
    """
    given = (docs if train is None else docs.where(train)).where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(
        F.col(key_col).alias("key"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counts = {r[0]: r[1] for r in given.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()}
    langs = sorted(counts)
    if not langs:
        return ByteCnn([], *[np.zeros(0, np.float32)] * 5)
    rates = docs.sparkSession.createDataFrame(
        [(k, min(1.0, sample_rows / n)) for k, n in counts.items()], "lang string, rate double")
    spot = F.pmod(F.xxhash64("key", "text"), F.lit(1 << 30))
    part = lambda k: F.substring("text", (spot + k * F.length("text") / 3).cast("int") % F.length("text") + 1, F.lit(WINDOW))
    # copies of a document share their spot and come all or none: they count once, whatever their number
    rows = (given.join(F.broadcast(rates), "lang")  # one row for each language
            .where(spot < F.col("rate") * (1 << 30))
            .select("lang", F.explode(F.array(*map(part, range(3)))).alias("part")).distinct()
            .orderBy(F.xxhash64("part"), "part", "lang").limit(6 * sample_rows * len(langs)).toPandas())
    data = [(text_bytes(t)[:WINDOW], langs.index(g)) for t, g in sorted(zip(rows["part"], rows["lang"]))]
    data = [(d, g) for d, g in data if d.strip()]
    if not data:
        return ByteCnn([], *[np.zeros(0, np.float32)] * 5)
    return train_network(np.concatenate([windows(d) for d, _ in data]), np.asarray([g for _, g in data]), langs, epochs)


def predict_column(net: ByteCnn, text: Column) -> Column:
    """Struct of ``lang_pred`` and ``score`` for whole texts; null, empty and
    letterless texts are ``und`` with score 0."""
    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(net.predict(texts.tolist()), columns=["lang_pred", "score"])

    return predict(text)
