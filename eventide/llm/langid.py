"""Language identification with language-bitmask n-gram filters.

Training counts the character n-grams of every training text (whole texts, no
sample) per language; an n-gram belongs to a language if its share of that
language's n-grams is at least ``min_share`` and at least ``min_ratio`` of its
largest share in any language.  At most ``1 / min_share`` n-grams can belong
to a language, so the model has a proven size however large the corpus is.

In scripts with thousands of letters most n-grams are rarer than ``min_share``.
A language whose kept n-grams make up less than ``min_coverage`` of its training
n-grams is therefore learned from shorter ones, down to single letters, until
they do.  The share that the kept ones reach is the language's coverage: what
the score of an ordinary text of that language is near to.

The model is one bit-sliced Bloom filter: a slot holds one bit per language,
and the AND of an n-gram's slots is the bitmask of all languages that contain
it.  A text's n-grams are looked up, their masks are counted per language
(popcount per bit slice), each count is corrected for the false positives its
filter must give, ``(hits - n f) / (1 - f)``, and the largest share of the
text's n-grams (of the length that the language was learned with) decides.

n-grams are taken inside words (runs of letters, lower-cased, one space on
either side); everything that is not a letter separates words.

Defined results: a null text or one without a letter is ``und`` with score 0;
the score is the corrected share of n-grams found in the predicted
language, 0 to 1; equal shares go to the language with more training n-grams,
then the smaller name, and so does a text none of whose n-grams is known; with
no training text every text is ``und``; repeated rows are repeated; an empty
table gives an empty result; other columns pass through untouched, and one
that has the name of an output column is replaced by the output.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import (SECTION, mix64, plain_names, quoted, release_worker_cache, reliable, slices_of,
                                 text_slices)

UNDETERMINED = "und"


def _letter_bits() -> bytes:
    """One bit per code point: is it a letter?"""
    return np.packbits(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)).tobytes()


def _grams(texts: list, n: int, letters: np.ndarray):
    """(n-gram keys, index of the text each one is from) of several texts.
    A key packs the n code points, 21 bits each, and is exact for n <= 3;
    longer ones are hashed."""
    low = [(t or "").lower() for t in texts]
    cps = np.frombuffer("\n".join(["", *low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(low) + 1, dtype=np.int32), [len(t) + 1 for t in low] + [1])
    is_letter = letters[cps]
    cps = np.where(is_letter, cps, 32).astype(np.uint64)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]          # the one space after a word
    keep[:-1] |= is_letter[1:]          # and the one before it
    cps, own, inner = cps[keep], owner[keep], is_letter[keep]
    m = len(cps) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    key, whole = np.zeros(m, np.uint64), np.ones(m, bool)
    for i in range(n):
        key = (key << np.uint64(21) | cps[i:i + m]) if n <= 3 else mix64(key) + cps[i:i + m]
        if 0 < i < n - 1:
            whole &= inner[i:i + m]     # no word boundary inside
    if n < 3:
        whole &= inner[:m] | inner[n - 1:]
    return key[whole], own[(n - 1) // 2:(n - 1) // 2 + m][whole]


@dataclass(frozen=True)
class LanguageFilter:
    """languages by bit, longest n-gram, slots (n_slots, words of 64 bits), probes per n-gram;
    by language the length of its n-grams and its coverage."""

    languages: tuple
    n: int
    slots: np.ndarray
    probes: int
    letters: bytes
    orders: tuple
    coverage: tuple

    def masks(self, keys: np.ndarray) -> np.ndarray:
        """Per n-gram the bitmask of all languages that contain it."""
        h, out = mix64(keys), None
        step = mix64(h) | np.uint64(1)
        for i in range(self.probes):
            found = self.slots[((h + np.uint64(i) * step) % np.uint64(len(self.slots))).astype(np.int64)]
            out = found if out is None else out & found
        return out

    def false_rates(self) -> np.ndarray:
        fill = [((self.slots[:, b // 64] >> np.uint64(b % 64)) & np.uint64(1)).mean()
                for b in range(len(self.languages))]
        return np.minimum(np.array(fill) ** self.probes, 0.99)

    def predict(self, texts: list, letters: np.ndarray):
        """Languages and scores of a list of texts."""
        langs, scores, rates = [], [], self.false_rates()
        for lo, hi in text_slices(texts, SECTION):
            part = texts[lo:hi]
            fixed = np.zeros((len(self.languages), len(part)))
            for order in sorted(set(self.orders)):
                keys, owner = _grams(part, order, letters)
                total = np.bincount(owner, minlength=len(part)).astype(float)
                masks = self.masks(keys) if len(keys) else np.zeros((0, self.slots.shape[1]), np.uint64)
                for b, f in enumerate(rates):
                    if self.orders[b] == order:
                        bit = (masks[:, b // 64] >> np.uint64(b % 64)) & np.uint64(1)
                        hits = np.bincount(owner, weights=bit, minlength=len(part))
                        fixed[b] = (hits - total * f) / (1 - f) / np.maximum(total, 1.0)
            for i, text in enumerate(part):
                if not text or not any(ch.isalpha() for ch in text) or not self.languages:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                else:
                    best = int(fixed[:, i].argmax())
                    langs.append(self.languages[best])
                    scores.append(float(min(1.0, max(0.0, fixed[best, i]))))
        return langs, scores


def gram_counts(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang",
                n: int = 3) -> DataFrame:
    """(lang, gram, count) over whole texts; counts meet per task before the shuffle."""
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()) \
        .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    bits = _letter_bits()

    def run(batches):
        release_worker_cache()
        letters = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
        held: dict = {}     # language: (n-grams, counts) met by this task

        def emit(lang):
            keys, count = held.pop(lang)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64), pa.int64()),
                 pa.array(count, pa.int64())], ["lang", "gram", "count"])

        for b in batches:
            names = b.column("lang")
            for lang in names.unique().to_pylist():
                own = b.column("text").filter(pc.equal(names, lang))
                for lo, hi in slices_of(own, SECTION):
                    keys, count = np.unique(_grams(own[lo:hi].to_pylist(), n, letters)[0], return_counts=True)
                    if lang in held:
                        both = np.concatenate([held[lang][0], keys])
                        keys, at = np.unique(both, return_inverse=True)
                        count = np.bincount(at, np.concatenate([held[lang][1], count]), len(keys)).astype(np.int64)
                    held[lang] = keys, count
                    if len(keys) > 1 << 18:
                        yield emit(lang)
        for lang in list(held):
            yield emit(lang)

    return rows.mapInArrow(run, "lang string, gram long, count long") \
        .groupBy("lang", "gram").agg(F.sum("count").alias("count"))


def _kept(docs: DataFrame, text_col: str, lang_col: str, n: int, min_share: float, min_ratio: float):
    """(training n-grams by language; table of the kept n-grams and their shares)."""
    counts = reliable(gram_counts(docs, text_col=text_col, lang_col=lang_col, n=n))
    totals = counts.groupBy("lang").agg(F.sum("count").alias("total"))
    share = counts.join(F.broadcast(totals), "lang") \
        .withColumn("share", F.col("count") / F.col("total")).filter(F.col("share") >= min_share)
    top = share.groupBy("gram").agg(F.max("share").alias("top"))
    kept = share.join(top, "gram").filter(F.col("share") >= F.col("top") * min_ratio) \
        .select("lang", "gram", "share").toArrow()
    return {r["lang"]: r["total"] for r in totals.collect()}, kept


def train(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", n: int = 3,
          min_share: float = 2e-5, min_ratio: float = 0.1, min_coverage: float = 0.9,
          slots_per_gram: int = 12, probes: int = 4) -> LanguageFilter:
    """Learn a filter from rows with a text and a language.  What reaches the
    driver is bounded by languages / min_share rows for each n-gram length;
    shorter n-grams are only counted if a language needs them."""
    grams, bits, index, order, coverage = [], [], {}, {}, {}
    for length in range(n, 0, -1):
        totals, kept = _kept(docs, text_col, lang_col, length, min_share, min_ratio)
        if length == n:
            languages = tuple(lang for _, lang in sorted((-total, lang) for lang, total in totals.items()))
            index = {lang: i for i, lang in enumerate(languages)}
        gram = kept.column("gram").to_numpy().view(np.uint64)
        bit = np.array([index.get(x, -1) for x in kept.column("lang").to_pylist()], np.int64)
        share = np.bincount(bit[bit >= 0], kept.column("share").to_numpy()[bit >= 0], len(index))
        done = [i for i in range(len(index)) if i not in order and (share[i] >= min_coverage or length == 1)]
        for i in done:
            order[i], coverage[i] = length, min(1.0, float(share[i]))
        own = np.isin(bit, done)
        grams.append(gram[own])
        bits.append(bit[own])
        if len(order) == len(index):
            break
    gram, bit = np.concatenate(grams), np.concatenate(bits)
    n_slots = max(1024, slots_per_gram * len(np.unique(gram)))
    slots = np.zeros((n_slots, max(1, -(-len(languages) // 64))), np.uint64)
    h = mix64(gram)
    step = mix64(h) | np.uint64(1)
    for i in range(probes):
        at = ((h + np.uint64(i) * step) % np.uint64(n_slots)).astype(np.int64)
        np.bitwise_or.at(slots, (at, bit // 64), np.uint64(1) << (bit % 64).astype(np.uint64))
    by_bit = range(len(languages))
    return LanguageFilter(languages, n, slots, probes, _letter_bits(), tuple(order[i] for i in by_bit),
                          tuple(coverage[i] for i in by_bit))


def identify(docs: DataFrame, model: LanguageFilter, *, text_col: str = "text",
             lang_out: str = "lang_pred", score_out: str = "score",
             coverage_out: str | None = None) -> DataFrame:
    """``docs`` with the predicted language and its score added, and with the
    language's coverage (0 for ``und``) if it has a name; one map over whole
    texts, no shuffle."""
    added = (lang_out, score_out) if coverage_out is None else (lang_out, score_out, coverage_out)
    rest = [c for c in docs.columns if c not in added or c == text_col]
    if text_col in added:
        raise ValueError(f"output column {text_col!r} would replace the text")
    rows, plain = plain_names(docs.select(*[F.col(quoted(c)) for c in rest]))
    text = plain[text_col]

    def run(batches):
        release_worker_cache()
        letters = np.unpackbits(np.frombuffer(model.letters, np.uint8)).astype(bool)
        reached = dict(zip(model.languages, model.coverage))
        for b in batches:
            langs, scores = model.predict(b.column(text).to_pylist(), letters)
            new = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                   pa.array([reached.get(x, 0.0) for x in langs], pa.float64())]
            yield pa.RecordBatch.from_arrays([*b.columns, *new[:len(added)]], [*b.schema.names, *added])

    schema = T.StructType([*rows.schema.fields, *(T.StructField(c, t()) for c, t in
                                                  zip(added, (T.StringType, T.DoubleType, T.DoubleType)))])
    return rows.mapInArrow(run, schema).toDF(*rest, *added)
