"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages of ``passage_bytes`` UTF-8 bytes; its label
says nothing about which passage it comes from.  Every passage of every text
is encoded (shares of character classes and class pairs, hashed byte pairs,
word lengths, repetition of words nearby), gated attention (a tanh branch
times a sigmoid branch) learns from the document labels how much each passage
counts, and the score is that of the attention-weighted sum of the passages'
representations.

Fitting uses a bounded sample of labelled documents: ``sample_per_class`` of
each label, the first by a hash of their ids, copies of a document as one, and
all their passages.  Their features are written to the shared folder in
mini-batches; batches of ``memory_bytes`` altogether are read once, more are
read again in every epoch, with the same result.  Scoring is one map over whole
texts and all their passages.

A text is worked on in sections of ``SECTION`` bytes, so that the arrays of a
very long one stay small: words end at a section's border, and the attention
over the sections of a text is added up as they come.

Defined results: null and empty texts are one empty passage; a document
labelled several times has the smallest of its labels, null and other labels
are ignored; a labelled id with several texts is a document for each; without labelled documents, or with one label only, the score is
the prior (0.5 without any); repeated rows are repeated; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import SECTION, mix64, shared_path, utf8

# Character classes of bytes: lower case, upper case, digit, space, line
# feed, beyond ASCII, control, and one class for each punctuation mark.
_CLASS = np.zeros(256, np.int64)
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = (0 if "a" <= _c <= "z" else 1 if "A" <= _c <= "Z" else 2 if "0" <= _c <= "9" else
                  3 if _c == " " else 4 if _c == "\n" else 5 if _b >= 0x80 else 6)
_PUNCT = [b for b in range(0x21, 0x7F) if _CLASS[b] == 6]
_CLASS[_PUNCT] = 7 + np.arange(len(_PUNCT))
N_CLASS = 7 + len(_PUNCT)
_COARSE = np.minimum(np.arange(N_CLASS), 7)       # all punctuation as one, for pairs
N_PAIR, N_HASH, N_WORD = 64, 128, 8
N_FEATURES = N_CLASS + N_PAIR + N_HASH + N_WORD


def passages(texts: list, passage_bytes: int):
    """Features of all passages of some texts, and the text of each passage."""
    return _features([utf8(t) for t in texts], passage_bytes)


def section_groups(texts: list, passage_bytes: int, size: int = 2 * SECTION):
    """Lists of (text, section) of about ``size`` bytes altogether; sections
    begin where passages do."""
    step = max(1, SECTION // passage_bytes) * passage_bytes
    group, total = [], 0
    for i, t in enumerate(texts):
        data = utf8(t)
        for at in range(0, max(1, len(data)), step):
            group.append((i, data[at:at + step]))
            total += len(group[-1][1]) + 64
            if total >= size:
                yield group
                group, total = [], 0
    if group:
        yield group


def _features(data: list, passage_bytes: int):
    sizes = np.array([len(b) for b in data], np.int64)
    counts = np.maximum(1, -(-sizes // passage_bytes))
    owner = np.repeat(np.arange(len(data)), counts)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    a = np.frombuffer(b"".join(data), np.uint8)
    n = len(owner)
    if not len(a):
        return np.zeros((n, N_FEATURES), np.float32), owner
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    text_of = np.repeat(np.arange(len(data)), sizes)
    pid = first[text_of] + (np.arange(len(a)) - starts[text_of]) // passage_bytes
    cls = _CLASS[a]
    length = np.bincount(pid, minlength=n).astype(np.float64)

    def shares(code, width, at, total):
        return np.bincount(at * width + code, minlength=n * width).reshape(n, width) / np.maximum(total, 1)[:, None]

    coarse = _COARSE[cls]
    pair = coarse[:-1] * 8 + coarse[1:]
    hashed = (a[:-1].astype(np.int64) * 31 + a[1:] * 17) % N_HASH
    inside = pid[:-1] == pid[1:]
    parts = [shares(cls, N_CLASS, pid, length), shares(pair[inside], N_PAIR, pid[:-1][inside], length),
             shares(hashed[inside], N_HASH, pid[:-1][inside], length),
             _word_features(a, cls, pid, text_of, n)]
    return np.concatenate(parts, axis=1).astype(np.float32), owner


def _word_features(a, cls, pid, text_of, n):
    """Per passage: words, mean and spread of their lengths, shares of words
    that equal one of the 1, 2, 3 or 4 words before, share of capitalized ones."""
    is_word = (cls != 3) & (cls != 4)
    joined = is_word[1:] & is_word[:-1] & (text_of[1:] == text_of[:-1])     # with the byte before
    s = np.flatnonzero(is_word & ~np.concatenate([[False], joined]))
    e = np.flatnonzero(is_word & ~np.concatenate([joined, [False]])) + 1
    out = np.zeros((n, N_WORD))
    if not len(s):
        return out
    size = (e - s).astype(np.float64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix64(a.astype(np.uint64) + np.uint64(1)))])
    word = mix64(sums[e] - sums[s] + (e - s).astype(np.uint64) + (a[s].astype(np.uint64) << np.uint64(40)))
    at, text = pid[s], text_of[s]
    count = np.bincount(at, minlength=n).astype(np.float64)
    per = np.maximum(count, 1)
    out[:, 0] = np.log1p(count)
    out[:, 1] = np.bincount(at, size, minlength=n) / per
    out[:, 2] = np.sqrt(np.bincount(at, size * size, minlength=n) / per)
    for back in range(1, 5):
        same = np.zeros(len(s))
        same[back:] = (word[back:] == word[:-back]) & (text[back:] == text[:-back])
        out[:, 2 + back] = np.bincount(at, same, minlength=n) / per
    out[:, 7] = np.bincount(at, cls[s] == 1, minlength=n) / per
    return out


def _sigmoid(x):
    return 0.5 * (1.0 + np.tanh(0.5 * x))


class GatedAttention:
    """h = tanh(x W); a = softmax over the bag of w (tanh(h V) * sigmoid(h U)); score = sigmoid(c sum(a h) + b)."""

    def __init__(self, prior: float, mean=None, scale=None, weights: dict | None = None):
        self.prior, self.mean, self.scale, self.p = prior, mean, scale, weights

    def _attend(self, x, first):
        """Representations, both branches, attention logits and each passage's bag."""
        p = self.p
        h = np.tanh(x @ p["W"] + p["B"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        bag = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(x))))
        return h, t, g, (t * g) @ p["w"], bag

    def _forward(self, x, first):
        h, t, g, e, bag = self._attend(x, first)
        a = np.exp(e - np.maximum.reduceat(e, first)[bag])
        a /= np.add.reduceat(a, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        return h, t, g, a, bag, z, _sigmoid(z @ self.p["c"] + self.p["b"])

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Scores of bags; ``first`` has each bag's first row in ``x``."""
        return self.finish(*self.partial(x, first))

    def partial(self, x: np.ndarray, first: np.ndarray):
        """Per bag or part of one: the largest attention logit, the sum of
        exp(logit - largest) and of the representations weighted by it."""
        if self.p is None:
            return np.zeros(len(first)), np.ones(len(first)), np.zeros((len(first), 1))
        h, _, _, e, bag = self._attend((x - self.mean) / self.scale, first)
        top = np.maximum.reduceat(e, first)
        w = np.exp(e - top[bag])
        return top, np.add.reduceat(w, first), np.add.reduceat(w[:, None] * h, first, axis=0)

    def finish(self, top, total, z) -> np.ndarray:
        """Scores, rounded so that the size of a batch cannot show in the last digits."""
        if self.p is None:
            return np.full(len(top), self.prior)
        return _sigmoid((z / total[:, None]) @ self.p["c"] + self.p["b"]).round(9)

    def score_texts(self, texts: list, passage_bytes: int) -> np.ndarray:
        """Scores of whole texts, section by section."""
        top, total, z = np.full(len(texts), -np.inf), np.zeros(len(texts)), None
        for group in section_groups(texts, passage_bytes):
            x, owner = _features([d for _, d in group], passage_bytes)
            parts = self.partial(x, np.searchsorted(owner, np.arange(len(group))))
            z = np.zeros((len(texts), parts[2].shape[1])) if z is None else z
            for (i, _), t, s, v in zip(group, *parts):
                high = max(top[i], t)
                old, new = np.exp(top[i] - high), np.exp(t - high)
                top[i], total[i], z[i] = high, total[i] * old + s * new, z[i] * old + v * new
        return self.finish(top, total, z) if len(texts) else np.zeros(0)

    @classmethod
    def fit(cls, bags: list, labels: np.ndarray, *, batch: int = 128, seed: int = 7, **kw) -> "GatedAttention":
        """Fit on bags in memory, dealt into batches by chance."""
        order = np.random.default_rng(seed).permutation(len(bags))
        parts = [order[lo:lo + batch] for lo in range(0, len(order), batch)]

        def read(k):
            pick = parts[k]
            return (np.concatenate([bags[i] for i in pick]),
                    np.cumsum([0] + [len(bags[i]) for i in pick[:-1]]), labels[pick])
        return cls.fit_batches(len(parts), read, seed=seed, **kw)

    @classmethod
    def fit_batches(cls, batches: int, read, *, hidden: int = 32, attention: int = 16, epochs: int = 60,
                    rate: float = 0.01, decay: float = 1e-4, seed: int = 7, keep: bool = True) -> "GatedAttention":
        """Adam on the class-balanced log loss; gradients written out by hand.
        ``read(k)`` gives batch k: passages, each bag's first one, labels;
        batches are kept in memory or read again (``keep``)."""
        labels, n, total, square = [], 0, 0.0, 0.0
        for k in range(batches):
            x, _, y = read(k)
            x = x.astype(np.float64)
            labels.append(y)
            n, total, square = n + len(x), total + x.sum(0), square + (x * x).sum(0)
        labels = np.concatenate(labels) if labels else np.zeros(0)
        if not len(labels) or labels.min() == labels.max():
            return cls(float(labels.mean()) if len(labels) else 0.5)
        mean, d = total / n, len(total)
        rng = np.random.default_rng(seed)
        model = cls(float(labels.mean()), mean, np.sqrt(np.maximum(square / n - mean * mean, 0)) + 1e-3)
        model.p = {"W": rng.normal(0, d ** -0.5, (d, hidden)), "B": np.zeros(hidden),
                   "V": rng.normal(0, hidden ** -0.5, (hidden, attention)),
                   "U": rng.normal(0, hidden ** -0.5, (hidden, attention)),
                   "w": rng.normal(0, attention ** -0.5, attention), "c": rng.normal(0, hidden ** -0.5, hidden),
                   "b": np.zeros(())}
        share = labels.mean()

        def scaled(k):
            x, first, y = read(k)
            return (x - model.mean) / model.scale, first, y, np.where(y == 1, 0.5 / share, 0.5 / (1 - share))

        kept = [scaled(k) for k in range(batches)] if keep else None
        m, v, step = ({k: np.zeros_like(x) for k, x in model.p.items()} for _ in range(2)), None, 0
        m, v = list(m)
        for _ in range(epochs):
            for k in rng.permutation(batches):
                grads = model._gradients(*(kept[k] if keep else scaled(k)))
                step += 1
                for k, g in grads.items():
                    g = g + decay * model.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    model.p[k] = model.p[k] - rate * (m[k] / (1 - 0.9 ** step)) \
                        / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        return model

    def _gradients(self, x, first, y, weight):
        p = self.p
        h, t, g, a, bag, z, s = self._forward(x, first)
        ds = (s - y) * weight / len(y)
        dz = ds[:, None] * p["c"]
        along = (h * dz[bag]).sum(1)                         # d loss / d attention
        de = a * (along - np.add.reduceat(a * along, first)[bag])
        dt, dg = de[:, None] * p["w"] * g * (1 - t * t), de[:, None] * p["w"] * t * g * (1 - g)
        dh = a[:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T
        du = dh * (1 - h * h)
        return {"W": x.T @ du, "B": du.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de,
                "c": z.T @ ds, "b": ds.sum()}


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", passage_bytes: int = 512, sample_per_class: int = 1500,
          batch: int = 128, memory_bytes: int = 256 << 20, **fit) -> GatedAttention:
    """Fit on a bounded sample of the labelled documents of ``labels``:
    ``sample_per_class`` of each label, all their passages."""
    spark = docs.sparkSession
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()) \
        .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(label_col).cast("int").alias("y"))
    sample = None
    for y in (0, 1):
        one = known.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(sample_per_class)
        sample = one if sample is None else sample.unionByName(one)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")) \
        .join(F.broadcast(sample), "id") \
        .withColumn("hash", F.xxhash64("text"))         # 2 * sample_per_class ids at most
    # copies of a document are one, an id with several texts is several: the
    # bound holds for each label by itself
    texts = rows.select("y", "id", "hash").distinct()
    chosen = [r for y in (0, 1) for r in texts.filter(F.col("y") == y)
              .orderBy(F.xxhash64("id"), "id", "hash").limit(sample_per_class).collect()]
    chosen.sort(key=lambda r: r["hash"])                # labels mixed by chance
    if len({r["y"] for r in chosen}) < 2:
        return GatedAttention(float(chosen[0]["y"]) if chosen else 0.5)
    picked = spark.createDataFrame([(r["id"], r["hash"], i) for i, r in enumerate(chosen)],
                                   "id long, hash long, at int")
    once = rows.join(F.broadcast(picked), ["id", "hash"]).groupBy("at", "y").agg(F.first("text").alias("text"))

    def encode(batches):
        for b in batches:
            ats, ys = b.column("at").to_pylist(), b.column("y").to_pylist()
            for group in section_groups(b.column("text").to_pylist(), passage_bytes):
                x, owner = _features([d for _, d in group], passage_bytes)
                ends = np.searchsorted(owner, np.arange(len(group) + 1)).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ats[i] // batch for i, _ in group], pa.int32()),
                     pa.array([ats[i] for i, _ in group], pa.int32()), pa.array([ys[i] for i, _ in group], pa.int32()),
                     pa.array(range(len(group)), pa.int32()),
                     pa.array([x[lo:hi].tobytes() for lo, hi in zip(ends, ends[1:])], pa.binary())],
                    ["batch", "at", "y", "part", "x"])

    path = shared_path(spark, "bags")
    once.mapInArrow(encode, "batch int, at int, y int, part int, x binary") \
        .repartition("batch").sortWithinPartitions("batch", "at", "part").write.parquet(path)
    stored = spark.read.parquet(path)
    size = stored.agg(F.sum(F.octet_length("x"))).first()[0]

    def read(k):
        rows = stored.filter(F.col("batch") == k).orderBy("at", "part").toArrow()
        at = rows.column("at").to_numpy()
        parts = [np.frombuffer(r.as_py(), np.float32).reshape(-1, N_FEATURES) for r in rows.column("x")]
        new = np.flatnonzero(np.diff(at, prepend=-1))
        starts = np.cumsum([0] + [len(p) for p in parts])
        return np.concatenate(parts), starts[new], rows.column("y").to_numpy()[new].astype(np.float64)

    return GatedAttention.fit_batches(-(-len(chosen) // batch), read, keep=size <= memory_bytes, **fit)


def score(docs: DataFrame, model: GatedAttention, *, id_col: str = "doc_id", text_col: str = "text",
          passage_bytes: int = 512) -> DataFrame:
    """(doc_id, score) of every whole text: one map, no shuffle."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            scores = model.score_texts(b.column("text").to_pylist(), passage_bytes)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scores, pa.float64())],
                                             ["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {id_type}, score double")
