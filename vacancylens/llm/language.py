"""Language identification by averaged hashed subword embeddings.

A text is the mean of the embeddings of its subwords (2 to 4 bytes inside a
word, with the word's edge as a symbol), hashed into a fixed number of buckets;
a linear softmax over that mean gives the languages. Embeddings and weights are
trained by stochastic gradient descent in numpy on a bounded sample. A
temperature is fitted on rows kept apart, and on the same rows the least score
that a text must reach (all but ``REJECTED_SHARE`` of those classified right do).

A softmax is sure of texts in languages it never saw. So a text is also rejected
if too many of its subwords were in no sampled text of its predicted language.
How many, is calibrated on whole texts kept apart so that all but
``REJECTED_SHARE`` of those classified right pass: by their quantile in the language,
or where a Pareto tail fitted to the largest rates of all puts it, whichever is
more. A language with fewer than ``LEAST_HELD`` of them rejects none that way.

Mean and softmax's input are linear, so for prediction embeddings and weights
fold into one number for each bucket and language.

Null texts and texts without a letter get ``und`` with score 0 and are rejected.
Ties go to the language first in the alphabet. An empty table gives an empty
one; without labelled rows every text is ``und``. More than ``MAX_LANGUAGES``
different labels are an error.

:func:`counted` makes a plainer model of the same form, for logits only: a bucket's
log share of the subwords of a language, counted over all labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancylens.llm.arrays import LETTER, LOWER, Texts, mapped, texts
from vacancylens.llm.frames import joined_with_text, over_texts, ready_for_python, split_off_text
from vacancylens.llm.sampling import bounded_by_label

BUCKETS = 1 << 15
SIZES = (2, 3, 4)
DIMENSION = 16
#: Sampled rows of a language, and the most languages of a model.
SAMPLE_PER_LANGUAGE, MAX_LANGUAGES = 700, 200
#: Sampled rows of all languages; longer texts (in bytes) are labelled and not learned from.
SAMPLE_ROWS, LONGEST = 10_000, 1 << 18
EPOCHS, RATE = 6, 12.0
REJECTED_SHARE = 0.0005
LEAST_HELD = 30
#: Subwords added to a text's own, so that a few unseen ones do not reject a short text.
ADDED = 10
#: Bytes of the excerpt that a sampled text adds, so short texts are learned too.
EXCERPT = 60
#: Subwords of all languages together that a counted language has besides its own.
PRIOR = 1000
UNKNOWN = "und"

_EDGE = 0x20
_FOLD = bytes(LOWER[b] if LETTER[b] else _EDGE for b in range(256))
#: For each place in a subword a random bucket for each byte; xor joins them.
_TABLES = np.random.default_rng(99).integers(0, BUCKETS, (max(SIZES), 256), dtype=np.uint16)


def subwords(chunk: Texts) -> list[np.ndarray]:
    """For each size the bucket at each byte, ``BUCKETS`` where no subword begins.

    An edge may be a subword's first or last symbol only, and no subword
    reaches from one text into the next.
    """
    data = mapped(chunk.data, _FOLD)
    n = len(data)
    edge = data == _EDGE
    left = np.full(n, max(SIZES) + 1, np.int8)  # bytes to the end of the text, as far as needed
    for back in range(1, max(SIZES) + 1):
        at = chunk.offsets[1:] - back
        at = at[(at >= chunk.offsets[:-1])]
        left[at] = np.minimum(left[at], back)
    out = []
    bucket = _TABLES[0][data]
    inner = np.zeros(n, dtype=bool)  # an edge between the first and the last symbol
    for size in range(2, max(SIZES) + 1):
        m = max(0, n - size + 1)
        bucket = bucket[:m] ^ _TABLES[size - 1][data[size - 1 :]]
        if size > 2:
            inner = inner[:m] | edge[size - 2 : size - 2 + m]
        bad = inner[:m] | (left[:m] < size)
        if size == 2:
            bad |= edge[:m] & edge[1 : 1 + m]
        full = np.full(n, BUCKETS, np.uint16)
        full[:m] = np.where(bad, np.uint16(BUCKETS), bucket)
        if size in SIZES:
            out.append(full)
    return out


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums by text; ``reduceat`` would give an empty text its next value."""
    out = np.zeros(len(offsets) - 1, np.float64)
    rows = np.flatnonzero(np.diff(offsets) > 0)
    if len(rows):
        out[rows] = np.add.reduceat(values, offsets[:-1][rows], dtype=np.float64)
    return out


@dataclass
class LanguageModel:
    """Folded weights: ``scores[language, bucket]``, with a zero column at the end."""

    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0
    #: Whether a language's sampled texts have a bucket, and the largest rate of others it takes.
    seen: np.ndarray | None = None
    most_unseen: np.ndarray | None = None

    def logits(self, chunk: Texts, buckets: list[np.ndarray] | None = None) -> np.ndarray:
        total = np.zeros((len(chunk), len(self.languages)))
        count = np.zeros(len(chunk))
        for bucket in subwords(chunk) if buckets is None else buckets:
            count += _sums((bucket != BUCKETS).astype(np.float32), chunk.offsets)
            for k, table in enumerate(self.scores):
                total[:, k] += _sums(table[bucket], chunk.offsets)
        return total / np.maximum(count, 1)[:, None] + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def judge(self, chunk: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language, its probability, and whether the text is accepted, for each text."""
        buckets = subwords(chunk)
        p = self.probabilities(self.logits(chunk, buckets))
        best = p.argmax(axis=1)
        score = p[np.arange(len(best)), best]
        row = np.repeat(best * (BUCKETS + 1), np.diff(chunk.offsets))
        unseen, count = np.zeros(len(chunk)), np.zeros(len(chunk))
        for bucket in buckets:
            count += _sums((bucket != BUCKETS).astype(np.float32), chunk.offsets)
            unseen += _sums((~self.seen.reshape(-1)[row + bucket]).astype(np.float32), chunk.offsets)
        return best, score, (score >= self.least) & (_unseen_rate(unseen, count) <= self.most_unseen[best])


def _unseen_rate(unseen: np.ndarray, count: np.ndarray) -> np.ndarray:
    return (unseen + 0.5) / (count + ADDED)


def _tail(rates: np.ndarray) -> float:
    """The rate that ``REJECTED_SHARE`` exceed, by a Pareto tail over the largest twentieth."""
    ordered = np.sort(rates)[::-1]
    k = len(ordered) // 20
    if not k:
        return float(ordered.max(initial=0.0))
    shape = np.log(ordered[:k] / ordered[k]).mean()
    return float(ordered[k] * (k / (len(ordered) * REJECTED_SHARE)) ** shape)


def _bag(chunk: Texts, lo: int, hi: int, buckets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    cut = np.concatenate([b[lo:hi] for b in buckets])
    return np.unique(cut[cut < BUCKETS], return_counts=True)


def _sample_bags(chunk: Texts, rows: pa.RecordBatch):
    """Bucket counts of the whole text, and of an excerpt of it."""
    buckets = subwords(chunk)
    ids, langs = rows.column(0), rows.column(1)
    for row in range(len(chunk)):
        lo, hi = int(chunk.offsets[row]), int(chunk.offsets[row + 1])
        spans = [(lo, hi)]
        if hi - lo > 2 * EXCERPT:
            at = lo + int(ids[row].as_py() * 2654435761 % (hi - lo - EXCERPT))
            spans.append((at, at + EXCERPT))
        for part, span in enumerate(spans):
            idx, n = _bag(chunk, *span, buckets)
            if len(idx):
                yield {
                    "doc_id": ids.slice(row, 1), "lang": langs.slice(row, 1), "part": [part],
                    "bucket": [idx.astype(np.uint16).tobytes()], "n": [n.astype(np.float32).tobytes()],
                }


def train(labelled: DataFrame, seed: int = 7) -> LanguageModel:
    """Fit on ``labelled`` (doc_id, text, lang): about ``SAMPLE_PER_LANGUAGE`` rows of each.

    The driver gets at most about ``SAMPLE_ROWS`` rows, each a bag of as many buckets
    as a text of ``LONGEST`` bytes has at most.
    """
    rows = labelled.filter("lang is not null and text is not null and doc_id is not null")
    rows = rows.where(F.octet_length("text") <= LONGEST)
    sample = bounded_by_label(rows, "lang", SAMPLE_PER_LANGUAGE, max_labels=MAX_LANGUAGES, most_rows=SAMPLE_ROWS)
    schema = "doc_id long, lang string, part int, bucket binary, n binary"
    bags = over_texts(sample.select("doc_id", "lang", "text"), _sample_bags, schema).collect()
    bags.sort(key=lambda r: (r["doc_id"], r["part"], r["lang"], r["bucket"]))
    languages = sorted({r["lang"] for r in bags})
    index = {name: k for k, name in enumerate(languages)}
    if not bags:
        return LanguageModel([], np.zeros((0, BUCKETS + 1), np.float32), np.zeros(0))
    made = []
    for r in bags:
        n = np.frombuffer(r["n"], np.float32)
        made.append((np.frombuffer(r["bucket"], np.uint16), n / n.sum(), index[r["lang"]], r["doc_id"] % 4 == 1))
    whole = [(r, np.frombuffer(r["n"], np.float32)) for r in bags if r["part"] == 0 and r["doc_id"] % 4 == 1]
    fit, held = [m for m in made if not m[3]] or made, [m for m in made if m[3]] or made

    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSION)).astype(np.float32)
    weights = rng.normal(0, 0.1, (len(languages), DIMENSION)).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps, total = 0, EPOCHS * len(fit)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(fit)):
            idx, share, target, _ = fit[k]
            rate = np.float32(RATE * (1 - steps / total))
            steps += 1
            mean = share @ embedding[idx]
            z = weights @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[target] -= 1
            back = p @ weights
            weights -= 0.05 * rate * np.outer(p, mean)
            bias -= 0.005 * rate * p
            embedding[idx] -= (rate * share)[:, None] * back

    scores = np.zeros((len(languages), BUCKETS + 1), np.float32)
    scores[:, :BUCKETS] = weights @ embedding.T
    model = LanguageModel(languages, scores, bias.astype(np.float64))
    logits = np.array([scores[:, idx] @ share + bias for idx, share, _, _ in held])
    targets = np.array([t for _, _, t, _ in held])

    def loss(temperature: float) -> float:
        model.temperature = temperature
        return -np.log(np.maximum(model.probabilities(logits)[np.arange(len(held)), targets], 1e-12)).mean()

    model.temperature = min(np.geomspace(0.1, 10, 41).tolist(), key=loss)
    p = model.probabilities(logits)
    right = p.max(axis=1)[p.argmax(axis=1) == targets]
    model.least = float(np.quantile(right, REJECTED_SHARE)) if len(right) else 0.0

    model.seen = np.zeros((len(languages), BUCKETS + 1), bool)
    model.seen[:, BUCKETS] = True
    for idx, _, target, _ in fit:
        model.seen[target, idx] = True
    rates: list[list[float]] = [[] for _ in languages]
    for r, n in whole:
        idx, target = np.frombuffer(r["bucket"], np.uint16), index[r["lang"]]
        if (scores[:, idx] @ (n / n.sum()) + bias).argmax() == target:
            rates[target].append(_unseen_rate(n[~model.seen[target, idx]].sum(), n.sum()))
    tail = _tail(np.concatenate([np.array(x) for x in rates]))
    model.most_unseen = np.array([max(tail, np.quantile(x, 1 - REJECTED_SHARE)) if len(x) >= LEAST_HELD else np.inf for x in rates])
    return model


def counted(labelled: DataFrame) -> LanguageModel:
    """Logits from the subwords of all rows of ``labelled`` (text, lang); it rejects nothing.

    Tasks send one number for each language and bucket they met, Spark adds them up.
    """
    ready_for_python(labelled.sparkSession)
    rows = labelled.filter("lang is not null and text is not null")
    found = rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"lang has more than {MAX_LANGUAGES} different values")
    languages = sorted(r["lang"] for r in found)
    index = {name: k for k, name in enumerate(languages)}
    width = BUCKETS + 1

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(languages) * width, np.int64)
        for batch in stream:
            codes = np.array([index[name] for name in batch.column(0).to_pylist()], np.int64)
            for chunk in texts(batch.column(1)):
                row = np.repeat(codes[chunk.lo : chunk.hi] * width, np.diff(chunk.offsets))
                for bucket in subwords(chunk):
                    total += np.bincount(row + bucket, minlength=len(total))
        at = np.flatnonzero(total)
        at = at[at % width != BUCKETS]
        yield pa.RecordBatch.from_arrays([pa.array((at // width).astype(np.int32)), pa.array((at % width).astype(np.int32)), pa.array(total[at])], ["code", "bucket", "n"])

    scores = np.zeros((len(languages), width), np.float32)
    if languages:
        parts = rows.select("lang", "text").mapInArrow(count, "code int, bucket int, n long")
        sums = parts.groupBy("code", "bucket").agg(F.sum("n").alias("n")).toArrow()  # at most MAX_LANGUAGES * BUCKETS
        n = np.zeros((len(languages), BUCKETS))
        n[sums["code"].to_numpy(), sums["bucket"].to_numpy()] = sums["n"].to_numpy()
        overall = n.sum(axis=0) + 0.5
        n += PRIOR * overall / overall.sum()
        scores[:, :BUCKETS] = np.log(n / n.sum(axis=1, keepdims=True))
    return LanguageModel(languages, scores, np.zeros(len(languages)))


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, lang_pred, score, rejected``; reads the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_LANGUAGES * BUCKETS floats
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("has_letter"),
        F.col(text_col).alias("text"),
    )

    def label(chunk: Texts, rows: pa.RecordBatch) -> dict:
        model = shared.value
        has_letter = np.asarray(rows.column(1).to_pylist(), dtype=bool)
        if not model.languages:
            return {"doc_id": rows.column(0), "lang_pred": [UNKNOWN] * len(chunk), "score": np.zeros(len(chunk)), "rejected": np.ones(len(chunk), bool)}
        best, score, accepted = model.judge(chunk)
        score = np.where(has_letter, score, 0.0)
        names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, has_letter, strict=True)]
        return {"doc_id": rows.column(0), "lang_pred": names, "score": score, "rejected": ~has_letter | ~accepted}

    return over_texts(narrow, label, "doc_id long, lang_pred string, score double, rejected boolean")


def keep_known(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`predict` rejects."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    parts = split_off_text(docs, text_col)
    rows = parts.filter(F.col("_text").rlike(r"\p{L}"))

    def known(chunk: Texts, rows: pa.RecordBatch) -> dict:
        model = shared.value
        if not model.languages:
            keep = np.zeros(len(chunk), bool)
        else:
            keep = model.judge(chunk)[2]
        return {name: rows.column(name).filter(pa.array(keep)) for name in ("_rest", "_text")}

    return over_texts(rows, known, rows.schema, column="_text").select(*joined_with_text(docs.columns, text_col))
