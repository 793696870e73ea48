"""Toxicity by a small convolutional text classifier.

Words (runs of letters, A-Z as a-z) and their first ``PREFIX`` bytes are hashed
into buckets with an embedding each; a word's embedding is the sum of its two, so
forms of a known stem are known too. Filters over one, two and three words slide over the whole text; the
largest answer of each filter (after a rectifier) goes into a logistic unit.
A bucket's first dimension begins as the shrunken log odds of the labels of texts
with it; buckets in fewer than ``LEAST_TEXTS`` of the texts stay zero, so an unknown
word excites no filter.

Every labelled row is learned from. Rows are dealt by their ids into shards of about
``SHARD`` rows; in each epoch every shard trains its own copy of the network in numpy
by stochastic gradient descent, and the copies are averaged by Spark, a bucket's
embedding over the shards that moved it. So one shard's worth of rows is plain descent.

Rows kept apart calibrate the output by language, all of them too, and the language is
predicted from the text, never read: a logistic map for the score, and the threshold of
best F1, which a piecewise linear map moves to ``CUT``. So a score of ``CUT`` or more
means toxic in every language. Sums for both are Spark's, the driver gets a few numbers
of each language.

A null or empty text gets the score that no word at all gives. An empty table
gives an empty one; without labelled rows every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vacancylens.llm.arrays import CHUNK, LETTER, LOWER, Texts, words
from vacancylens.llm.frames import over_texts, ready_for_python, small_side, stored
from vacancylens.llm.language import LanguageModel

BITS = 15  # of the buckets of words; prefixes have as many of their own
BUCKETS = 2 << BITS
PREFIX = 4
DIMENSION, FILTERS, WIDTHS = 12, 6, (1, 2, 3)
#: Rows that a copy of the network learns from between two averages, and the most copies.
SHARD, MOST_SHARDS = 8192, 1024
#: Longer texts (in bytes) are scored and not learned from; by default there are none.
LONGEST = 1 << 31
EPOCHS, RATE = 4, 0.05
LEAST_TEXTS, SHRINK = 3, 6.0
CUT = 0.3
#: A language with fewer toxic rows among those kept apart takes the threshold of all.
LEAST_TOXIC = 25
#: Words that are convolved at a time.
SPAN = 4096
#: Buckets that are averaged by one task.
BLOCK = 4096
#: The code of all languages together.
ALL = -1
#: Newton's steps of the calibration, and how often each may be halved.
NEWTON, HALVINGS = 30, 12


def word_buckets(chunk: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word and of its prefix (n x 2), and where each text's words begin."""
    found = words(chunk, LOWER, LETTER, PREFIX)
    out = np.empty((len(found.hashes), 2), np.uint16)
    out[:, 0] = found.hashes >> np.uint64(64 - BITS)
    out[:, 1] = (found.prefixes >> np.uint64(64 - BITS)) + np.uint64(1 << BITS)
    return out, found.first


def _sum_of_two(table: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    return table[buckets[:, 0]] + table[buckets[:, 1]]


@dataclass
class ToxicityModel:
    """``tables[width][place]``: answers of the width's filters to a word at a place."""

    tables: list[list[np.ndarray]]
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    languages: LanguageModel
    #: By language (and None for all): slope and shift of the logit, threshold.
    calibration: dict = field(default_factory=dict)

    def logit(self, buckets: np.ndarray) -> float:
        best = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        for lo in range(0, max(len(buckets), 1), SPAN):
            part = buckets[lo : lo + SPAN + max(WIDTHS) - 1]
            for k, width in enumerate(WIDTHS):
                n = len(part) - width + 1
                if n > 0:
                    answer = _sum_of_two(self.tables[k][0], part[:n])
                    for place in range(1, width):
                        answer += _sum_of_two(self.tables[k][place], part[place : place + n])
                    best[k] = np.maximum(best[k], answer.max(axis=0) + self.biases[k])
        return float(np.concatenate(best) @ self.out + self.out_bias)

    def scores(self, chunk: Texts) -> np.ndarray:
        buckets, first = word_buckets(chunk)
        z = np.array([self.logit(buckets[first[i] : first[i + 1]]) for i in range(len(chunk))])
        return self.calibrated(z, self.language_of(chunk))

    def language_of(self, chunk: Texts) -> np.ndarray:
        if not self.languages.languages:
            return np.zeros(len(chunk), np.int64)
        return self.languages.logits(chunk).argmax(axis=1)

    def calibrated(self, logits: np.ndarray, language: np.ndarray) -> np.ndarray:
        out = np.empty(len(logits))
        for code in np.unique(language):
            slope, shift, threshold = self.calibration.get(int(code), self.calibration[None])
            rows = language == code
            p = _probability(logits[rows], slope, shift)
            # Two straight lines that meet at the threshold; rounding must not move it.
            low, high = CUT * p / threshold, CUT + (1 - CUT) * (p - threshold) / (1 - threshold)
            out[rows] = np.where(p >= threshold, np.maximum(high, CUT), np.minimum(low, np.nextafter(CUT, 0)))
        return np.clip(out, 0, 1)


def _learning_rows(model: LanguageModel):
    def of(chunk: Texts, rows: pa.RecordBatch) -> dict:
        buckets, first = word_buckets(chunk)
        code = model.logits(chunk).argmax(axis=1) if model.languages else np.zeros(len(chunk), np.int64)
        return {
            "doc_id": rows.column(0),
            "toxic": rows.column(1),
            "words": [buckets[first[i] : first[i + 1]].tobytes() for i in range(len(chunk))],
            "language": code,
        }

    return of


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint16).reshape(-1, 2)


def _texts_with_bucket(fit: DataFrame) -> np.ndarray:
    """For each label the number of texts with each bucket, and of all texts at the end."""

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, BUCKETS + 1), np.int64)
        for batch in stream:
            for target, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found[target, np.unique(_unpacked(data.as_py()))] += 1
                found[target, BUCKETS] += 1
        target, bucket = np.nonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(target, pa.int32()), pa.array(bucket, pa.int32()), pa.array(found[target, bucket])], ["toxic", "bucket", "n"]
        )

    parts = fit.select("toxic", "words").mapInArrow(count, "toxic int, bucket int, n long")
    sums = parts.groupBy("toxic", "bucket").agg(F.sum("n").alias("n")).toArrow()  # a fixed number of rows at most
    out = np.zeros((2, BUCKETS + 1))
    out[sums["toxic"].to_numpy(), sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return out


class _Network:
    """The network while it is trained, one text at a time."""

    def __init__(self, seed: int, with_word: np.ndarray):
        rng = np.random.default_rng(seed)
        size = np.maximum(with_word[:, BUCKETS], 1)[:, None]
        with_word = with_word[:, :BUCKETS]
        rate = (with_word + 0.5) / (size + 1)
        seen = with_word.sum(axis=0)
        self.known = seen >= LEAST_TEXTS
        self.embedding = rng.normal(0, 0.02, (BUCKETS, DIMENSION)).astype(np.float32)
        self.embedding[:, 0] = np.log(rate[1] / rate[0]) * seen / (seen + SHRINK)
        self.embedding[~self.known] = 0
        self.filters = [rng.normal(0, 0.1, (w, DIMENSION, FILTERS)).astype(np.float32) for w in WIDTHS]
        for f in self.filters:  # each filter begins by watching one place for the log odds
            f[rng.integers(0, len(f), FILTERS), 0, np.arange(FILTERS)] = 0.5
        self.biases = np.full((len(WIDTHS), FILTERS), -0.1, np.float32)
        self.out = np.full(FILTERS * len(WIDTHS), 0.2, np.float32)
        self.out_bias = np.full(1, -2, np.float32)
        self.moved = np.zeros(BUCKETS, np.int32)  # how often each bucket's embedding was changed

    def dense(self) -> np.ndarray:
        """All weights but the embedding in a row."""
        return np.concatenate([x.reshape(-1) for x in (*self.filters, self.biases, self.out, self.out_bias)])

    def set_dense(self, values: np.ndarray) -> None:
        for x in (*self.filters, self.biases, self.out, self.out_bias):
            x[...] = values[: x.size].reshape(x.shape)
            values = values[x.size :]

    def copy(self) -> _Network:
        made = object.__new__(_Network)
        made.known = self.known
        made.embedding, made.moved = self.embedding.copy(), np.zeros_like(self.moved)
        made.filters = [f.copy() for f in self.filters]
        made.biases, made.out, made.out_bias = self.biases.copy(), self.out.copy(), self.out_bias.copy()
        return made

    def step(self, buckets: np.ndarray, target: int, rate: float) -> None:
        pooled = np.zeros((len(WIDTHS), FILTERS), np.float32)
        places = np.full((len(WIDTHS), FILTERS), -1)
        every = np.arange(FILTERS)
        for lo in range(0, len(buckets), SPAN):
            vectors = _sum_of_two(self.embedding, buckets[lo : lo + SPAN + max(WIDTHS) - 1])
            for k, width in enumerate(WIDTHS):
                n = len(vectors) - width + 1
                if n > 0:
                    answer = vectors[:n] @ self.filters[k][0]
                    for place in range(1, width):
                        answer += vectors[place : place + n] @ self.filters[k][place]
                    at = answer.argmax(axis=0)
                    best = answer[at, every] + self.biases[k]
                    better = (places[k] < 0) | (best > pooled[k])
                    places[k] = np.where(better, at + lo, places[k])
                    pooled[k] = np.where(better, best, pooled[k])
        active = pooled > 0
        hidden = np.where(active, pooled, 0).reshape(-1)
        z = float(hidden @ self.out + self.out_bias[0])
        error = np.float32(1 / (1 + np.exp(-np.clip(z, -30, 30))) - target)
        if abs(error) < 0.02:
            return
        back = (error * self.out).reshape(len(WIDTHS), FILTERS) * active
        self.out -= rate * error * hidden
        self.out_bias -= rate * error
        for k, width in enumerate(WIDTHS):
            for f in np.flatnonzero(back[k]):
                at, g = places[k, f], np.clip(back[k, f], -1, 1)
                self.biases[k][f] -= rate * g
                for place in range(width):
                    pair = buckets[at + place]
                    was = self.embedding[pair].sum(axis=0)
                    pair = pair[self.known[pair]]
                    self.embedding[pair] -= rate * g * self.filters[k][place][:, f]
                    self.moved[pair] += 1
                    self.filters[k][place][:, f] -= rate * g * was


_UPDATE = "block int, shard int, weight binary, bucket binary, total binary"


def _updates(net: _Network, shard: int, rows: int) -> pa.RecordBatch:
    """A copy's weights: block -1 all but the embedding, the others what it moved of the embedding."""
    blocks, weight, bucket, total = [-1], [np.array([rows], np.float64)], [np.zeros(1, np.int32)], [rows * net.dense().astype(np.float64)]
    moved = np.flatnonzero(net.moved).astype(np.int32)
    for block in np.unique(moved // BLOCK):
        own = moved[moved // BLOCK == block]
        n = net.moved[own].astype(np.float64)
        blocks, weight, bucket, total = [*blocks, block], [*weight, n], [*bucket, own], [*total, n[:, None] * net.embedding[own]]
    packed = [pa.array([x.tobytes() for x in c], pa.binary()) for c in (weight, bucket, total)]
    return pa.RecordBatch.from_arrays(
        [pa.array(blocks, pa.int32()), pa.array([shard] * len(blocks), pa.int32()), *packed], ["block", "shard", "weight", "bucket", "total"]
    )


def _added(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of the rows of each block, which follow one another; one block is held."""
    names = ["block", "weight", "bucket", "total"]
    block, weight, total = None, None, None

    def made() -> pa.RecordBatch:
        at = np.flatnonzero(weight).astype(np.int32)
        packed = [pa.array([x.tobytes()], pa.binary()) for x in (weight[at], at + max(block, 0) * BLOCK, total[at])]
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), *packed], names)

    for batch in stream:
        for k in range(len(batch)):
            own = batch.column(0)[k].as_py()
            n, bucket = (np.frombuffer(batch.column(c)[k].as_py(), t) for c, t in ((2, np.float64), (3, np.int32)))
            values = np.frombuffer(batch.column(4)[k].as_py(), np.float64).reshape(len(n), -1)
            if own != block:
                if block is not None:
                    yield made()
                size = 1 if own < 0 else BLOCK
                block, weight, total = own, np.zeros(size), np.zeros((size, values.shape[1]))
            at = bucket - max(own, 0) * BLOCK
            weight[at] += n
            total[at] += values
    if block is not None:
        yield made()


def _epoch(fit: DataFrame, net: _Network, epoch: int, share: dict, shard_rows: float, seed: int) -> None:
    """Every shard's copy learns from all rows of the shard once; ``net`` becomes their average."""
    spark = fit.sparkSession
    shared = spark.sparkContext.broadcast(net)  # a fixed number of weights
    gain = [min(0.5 / max(share[t], 1e-9), 3.0) for t in (0, 1)]

    def learn(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, own, done, size, rng = None, None, 0, 0, None
        held: list[tuple] = []

        def flush() -> None:
            nonlocal done, size
            for k in rng.permutation(len(held)):
                data, target = held[k]
                progress = min((epoch + done / shard_rows) / EPOCHS, (epoch + 1) / EPOCHS)
                own.step(_unpacked(data), target, np.float32(RATE * gain[target] * (1 - progress)))
                done += 1
            held.clear()
            size = 0

        for batch in stream:
            for new, target, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if new != shard:
                    if own is not None:
                        flush()
                        yield _updates(own, shard, done)
                    shard, own, done, rng = new, shared.value.copy(), 0, np.random.default_rng([seed, epoch, new])
                held.append((data.as_py(), target))
                size += len(held[-1][0])
                if size >= CHUNK:
                    flush()
        if own is not None:
            flush()
            yield _updates(own, shard, done)

    updates = fit.select("shard", "toxic", "words").mapInArrow(learn, _UPDATE)
    dealt = updates.repartition(min(16, BUCKETS // BLOCK), "block").sortWithinPartitions("block", "shard")
    for row in dealt.mapInArrow(_added, "block int, weight binary, bucket binary, total binary").toArrow().to_pylist():
        weight, bucket = np.frombuffer(row["weight"], np.float64), np.frombuffer(row["bucket"], np.int32)
        mean = np.frombuffer(row["total"], np.float64).reshape(len(weight), -1) / weight[:, None]
        if row["block"] < 0:
            net.set_dense(mean[0])
        else:
            net.embedding[bucket] = mean
    shared.unpersist()


def _newton_sums(points: DataFrame, tried: dict, moments: dict) -> dict:
    """For each code and tried coefficients: loss, gradient and curvature over all its rows."""

    def add(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {code: np.zeros((len(c), 6)) for code, c in tried.items()}
        for batch in stream:
            codes, z, y = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for code in np.unique(codes):
                if code in found:
                    at = codes == code
                    x = (z[at] - moments[code][0]) / moments[code][1]
                    for k, (slope, shift) in enumerate(tried[code]):
                        t = slope * x + shift
                        p = 1 / (1 + np.exp(-np.clip(t, -30, 30)))
                        q = p * (1 - p)
                        error = p - y[at]
                        found[code][k] += [(np.logaddexp(0, t) - y[at] * t).sum(), x @ error, error.sum(), q @ (x * x), q @ x, q.sum()]
        keys = [(code, k) for code in found for k in range(len(found[code]))]
        columns = [pa.array([c for c, _ in keys], pa.int32()), pa.array([k for _, k in keys], pa.int32())]
        sums = [pa.array([found[c][k][j] for c, k in keys], pa.float64()) for j in range(6)]
        yield pa.RecordBatch.from_arrays([*columns, *sums], ["code", "k", *[f"s{j}" for j in range(6)]])

    made = points.mapInArrow(add, "code int, k int, s0 double, s1 double, s2 double, s3 double, s4 double, s5 double")
    rows = made.groupBy("code", "k").agg(*[F.sum(f"s{j}").alias(f"s{j}") for j in range(6)]).collect()
    return {(r["code"], r["k"]): np.array(r[2:]) for r in rows}


def _logistic(points: DataFrame, moments: dict) -> dict:
    """Slope and shift of each code's logistic regression on its logit ``z``.

    Newton's method on the standardised number, over all rows of ``points`` (code, z,
    toxic) in every step; halved steps are tried with the whole one, in one job.
    """

    def ridge(c: np.ndarray) -> float:
        return 0.5 * (c[0] - 1) ** 2

    at = {code: np.array([1.0, 0.0]) for code in moments}
    found = _newton_sums(points, {code: [c] for code, c in at.items()}, moments)
    state = {code: found[code, 0] for code in at}
    moving = set(at)
    for _ in range(NEWTON):
        tried = {}
        for code in sorted(moving):
            _, g0, g1, h00, h01, h11 = state[code]
            curve = np.array([[h00 + 1, h01], [h01, h11 + 1e-6]])
            step = np.linalg.solve(curve, np.array([g0 + at[code][0] - 1, g1]))
            if np.abs(step).max() > 1e-9:
                tried[code] = [at[code] - step / 2**k for k in range(HALVINGS)]
        moving = set(tried)
        if not moving:
            break
        found = _newton_sums(points, tried, moments)
        for code in tried:
            loss = state[code][0] + ridge(at[code])
            better = [k for k, c in enumerate(tried[code]) if found[code, k][0] + ridge(c) < loss]
            if better:
                at[code], state[code] = tried[code][better[0]], found[code, better[0]]
            else:
                moving.discard(code)
    out = {}
    for code, c in at.items():
        slope = max(c[0], 1e-3) / moments[code][1]
        out[code] = (float(slope), float(c[1] - slope * moments[code][0]))
    return out


def _probability(logits: np.ndarray, slope: float, shift: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(slope * logits + shift, -50, 50)))


def _best_threshold(points: DataFrame) -> dict:
    """For each code of ``points`` (code, p, toxic) the middle of the gap after which a cut gives the best F1.

    All rows count. Equal ``p`` are one row; the others are dealt by range, so that a
    running sum needs its own part and the totals of the parts above.
    """
    grouped = points.groupBy("code", "p").agg(F.sum("toxic").cast("long").alias("hits"), F.count("*").alias("n"))
    parts = stored(grouped.repartitionByRange("code", "p").withColumn("part", F.spark_partition_id()), "thresholds")
    totals = parts.groupBy("code", "part").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n"), F.max("p").alias("top"))
    totals = sorted(totals.collect(), key=lambda r: (r["code"], -r["top"]))
    above, toxic, rows = [], {}, {}
    for r in totals:
        toxic[r["code"]], rows[r["code"]] = toxic.get(r["code"], 0), rows.get(r["code"], 0)
        above.append((r["code"], r["part"], toxic[r["code"]], rows[r["code"]]))
        toxic[r["code"]] += r["hits"]
        rows[r["code"]] += r["n"]
    spark = points.sparkSession
    base = spark.createDataFrame([(*a, toxic[a[0]]) for a in above], "code int, part int, hits_above long, n_above long, toxic long")
    down = Window.partitionBy("code", "part").orderBy(F.desc("p"))
    hit = F.sum("hits").over(down) + F.col("hits_above")
    count = F.sum("n").over(down) + F.col("n_above")
    cuts = parts.join(F.broadcast(base), ["code", "part"]).select(
        "code", "p", (2 * hit / (count + F.col("toxic"))).alias("f1"), F.lead("p").over(down).alias("below")
    )
    best = cuts.groupBy("code").agg(F.max(F.struct("f1", "p", "below")).alias("best")).collect()
    out = {}
    for r in best:
        below = r["best"]["below"]
        if below is None:  # the next one is the first of the part below
            below = max((t["top"] for t in totals if t["code"] == r["code"] and t["top"] < r["best"]["p"]), default=0.0)
        out[r["code"]] = float(np.clip((r["best"]["p"] + below) / 2, 1e-4, 1 - 1e-4))
    return out


def _calibration(held: DataFrame, model: ToxicityModel) -> dict:
    """Slope, shift and threshold by language, and for all (None), from every row of ``held``."""
    shared = held.sparkSession.sparkContext.broadcast(model)

    def logits(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            z = [shared.value.logit(_unpacked(w.as_py())) for w in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(z, pa.float64()), batch.column(1)], ["language", "z", "toxic"])

    answered = stored(held.select("language", "toxic", "words").mapInArrow(logits, "language int, z double, toxic int"), "logits")
    points = answered.select(F.explode(F.array(F.lit(ALL), "language")).alias("code"), "z", "toxic")
    sums = points.groupBy("code").agg(
        F.mean("z").alias("centre"), F.stddev_pop("z").alias("scale"), F.sum("toxic").alias("toxic"), F.count("*").alias("n")
    )
    found = {r["code"]: r for r in sums.collect()}
    whole = found.get(ALL)
    if whole is None or not 0 < whole["toxic"] < whole["n"]:
        return {None: (1.0, -50.0, 0.5)}
    moments = {
        code: (r["centre"], r["scale"] + 1e-9)
        for code, r in found.items()
        if code == ALL or (r["toxic"] >= LEAST_TOXIC and r["n"] - r["toxic"] >= LEAST_TOXIC)
    }
    maps = _logistic(points, moments)

    def probabilities(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            codes, z = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            p = np.empty(len(codes))
            for code in np.unique(codes):
                p[codes == code] = _probability(z[codes == code], *maps[code])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), batch.column(2)], ["code", "p", "toxic"])

    chosen = points.where(F.col("code").isin(list(maps))).mapInArrow(probabilities, "code int, p double, toxic int")
    cuts = _best_threshold(chosen)
    return {None if code == ALL else code: (*maps[code], cuts[code]) for code in sorted(maps)}


def train(docs: DataFrame, labels: DataFrame, languages: LanguageModel, seed: int = 11) -> ToxicityModel:
    """Fit on all rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) name.

    The words of labelled rows are written once, dealt into shards by their ids; counts,
    epochs and calibration are passes over them. The driver gets counts and weights.
    """
    spark = docs.sparkSession
    ready_for_python(spark)
    rows = labels.filter("toxic in (0, 1) and doc_id is not null")
    rows = rows.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
    side = small_side(rows, rows.count())
    kept = F.pmod(F.col("doc_id"), F.lit(4)) == 1
    sizes = {r["held"]: r["n"] for r in docs.select("doc_id").join(side, "doc_id").groupBy(kept.alias("held")).agg(F.count("*").alias("n")).collect()}
    shards = min(max(1, -(-sizes.get(False, 0) // SHARD)), MOST_SHARDS)

    narrow = docs.select("doc_id", "text").join(side, "doc_id")
    narrow = narrow.select("doc_id", "toxic", "text").where(F.octet_length(F.coalesce("text", F.lit(""))) <= LONGEST)
    made = over_texts(narrow, _learning_rows(languages), "doc_id long, toxic int, words binary, language int")
    shard = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(shards)).cast("int")
    made = made.select(shard.alias("shard"), kept.alias("held"), "doc_id", "toxic", "words", "language")
    order = ["shard", F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id", "toxic", "words"]
    learned = stored(made.repartitionById(shards, "shard").sortWithinPartitions(*order), "labelled")
    present = {r["held"] for r in learned.select("held").distinct().collect()}
    fit = learned.where("not held") if False in present else learned
    held = learned.where("held") if True in present else learned

    with_word = _texts_with_bucket(fit)
    net = _Network(seed, with_word)
    size = with_word[:, BUCKETS]
    share = {label: float(size[label] / max(size.sum(), 1)) for label in (0, 1)}
    for epoch in range(EPOCHS if size.sum() else 0):
        _epoch(fit, net, epoch, share, max(size.sum() / shards, 1.0), seed)
    tables = [[net.embedding @ net.filters[k][place] for place in range(w)] for k, w in enumerate(WIDTHS)]
    model = ToxicityModel(tables, list(net.biases), net.out, float(net.out_bias[0]), languages, {None: (1.0, 0.0, 0.5)})
    model.calibration = _calibration(held, model)
    return model


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, score, predicted``; reads the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def answer(chunk: Texts, rows: pa.RecordBatch) -> dict:
        return {"doc_id": rows.column(0), "score": shared.value.scores(chunk)}

    return over_texts(narrow, answer, "doc_id long, score double").withColumn(
        "predicted", (F.col("score") >= CUT).cast("int")
    )
