"""Near duplicates: minima of universal hashes, banding, exact checks, components.

1. Each text's set of word shingles; ``HASHES`` minima of multiply-add hashes of
   it, and a key for each band of ``ROWS`` minima. Texts of equal sets are one
   class from here on.
2. Star pairs: in each bucket (band and key) every class with the least one.
   Signatures (a byte of each minimum) drop pairs that can't reach the limit,
   then whole texts decide: first the most alike pair of each class, then those
   still between different components.
3. Buckets whose classes are in different components still, the least class
   aside, are compared among themselves in blocks of ``BLOCK`` classes, first by
   signature, then by whole sets, and yield a spanning forest, not all pairs.

So two classes that share a bucket are compared unless linked already. With 32
bands of 4, two sets at the limit of 0.8 share no bucket with a chance of 5e-8.
A signature is dropped 6 standard deviations below what the limit gives.

Null and empty texts have no shingle and are linked with nothing. Rows with one
id are one document, linked by the id. Rows without an id are kept and in no
component. An empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancylens.llm.arrays import LOWER, Texts, mix, shingle_sets, texts, words
from vacancylens.llm.components import connected_components
from vacancylens.llm.frames import list_column, over_groups, over_texts, small_side, stored, without

BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: Classes of a bucket that meet in one task with as many others.
BLOCK = 256

_rng = np.random.default_rng(4242)
_FACTOR = _rng.integers(0, 1 << 63, (HASHES, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _rng.integers(0, 1 << 63, (HASHES, 1), dtype=np.uint64)
_BAND = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
_SPAN = 512


def minima(hashes: np.ndarray) -> np.ndarray:
    """Least value of each hash function over a set."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(hashes), _SPAN):
        values = _FACTOR * hashes[None, lo : lo + _SPAN]
        values += _SHIFT
        np.minimum(least, values.min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    keys = _BAND.copy()
    for column in least.reshape(BANDS, ROWS).T:
        keys = mix(keys * np.uint64(0xC2B2AE3D27D4EB4F) + column)
    return keys


def _signatures(k: int) -> Callable[[Texts, pa.RecordBatch], dict]:
    def of(chunk: Texts, rows: pa.RecordBatch) -> dict:
        sets = shingle_sets(words(chunk, LOWER), k)
        n = np.array([len(s) for s in sets], np.int64)
        sums, mixed, signatures, bands = [], [], [], []
        for s in sets:
            least = minima(s)
            sums.append(s.sum(dtype=np.uint64))
            mixed.append(np.bitwise_xor.reduce(mix(s)) if len(s) else np.uint64(0))
            signatures.append((mix(least) & np.uint64(0xFF)).astype(np.uint8).tobytes())
            bands.append(band_keys(least))
        return {
            "doc_id": rows.column(0), "n": n, "fp1": np.array(sums, np.uint64), "fp2": np.array(mixed, np.uint64),
            "sig": signatures, "bands": list_column(bands, pa.int64()),
        }

    return of


def least_matches(percent: int) -> int:
    """Equal signature bytes that a pair at the limit has but for 6 deviations."""
    p = percent / 100
    return max(0, math.floor(HASHES * p - 6 * math.sqrt(HASHES * p * (1 - p))))


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _bytes_matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def _count_matches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns a, b, sig, sig_b to a, b and the number of equal bytes."""
    for batch in stream:
        same = _bytes_matrix(batch.column("sig"), HASHES) == _bytes_matrix(batch.column("sig_b"), HASHES)
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(same.sum(axis=1).astype(np.int32))], names=["a", "b", "matches"]
        )


def _confirm(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are alike enough; a text is read where needed only."""
    pairs = stored(pairs.select("a", "b").distinct(), "pairs")
    whole = docs.select(F.col("doc_id"), F.col("text"))
    others = pairs.select(F.col("b").alias("doc_id")).distinct()
    n = pairs.count()
    # Copies of a row would repeat its pairs; the links are made distinct later.
    left = whole.join(small_side(pairs, n), whole["doc_id"] == pairs["a"]).select("a", "b", "text")
    right = whole.join(small_side(others, n), "doc_id").select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def check(chunk: Texts, rows: pa.RecordBatch) -> dict:
        ids = rows.column("b").to_numpy()
        _, at, which = np.unique(ids, return_index=True, return_inverse=True)
        other = rows.column("text_b").take(pa.array(at))
        sets_b = [s for c in texts(other) for s in shingle_sets(words(c, LOWER), k)]
        sets_a = shingle_sets(words(chunk, LOWER), k)
        ok = np.array([len(a) > 0 and _linked(a, sets_b[j], percent) for a, j in zip(sets_a, which, strict=True)], bool)
        return {"a": rows.column("a").filter(pa.array(ok)), "b": rows.column("b").filter(pa.array(ok))}

    return over_texts(left.join(right, "b").select("a", "b", "text", "text_b"), check, "a long, b long")


def _alike_in_block(percent: int) -> Callable[[pa.Table], dict]:
    """Rows of one block pair that have a partner by signature in another component."""
    least = least_matches(percent)

    def of(rows: pa.Table) -> dict:
        m = len(rows)
        signature = _bytes_matrix(rows.column("sig").combine_chunks(), HASHES)
        bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(m, BANDS)
        comp, n, block = (rows.column(c).to_numpy() for c in ("comp", "n", "block"))
        band = rows.column("band")[0].as_py()
        across = rows.column("lo")[0].as_py() != rows.column("hi")[0].as_py()
        hit = np.zeros(m, bool)
        for i in range(m - 1):
            ok = comp[i + 1 :] != comp[i]
            ok &= 100 * np.minimum(n[i + 1 :], n[i]) >= percent * np.maximum(n[i + 1 :], n[i])
            if across:
                ok &= block[i + 1 :] != block[i]
            at = np.flatnonzero(ok) + i + 1
            if len(at):
                at = at[(signature[at] == signature[i]).sum(axis=1) >= least]
            if len(at):  # a pair is looked at in the first bucket that it shares
                at = at[(bands[at] == bands[i]).argmax(axis=1) == band]
            if len(at):
                hit[i] = True
                hit[at] = True
        kept = rows.filter(pa.array(hit))
        return {c: kept.column(c) for c in ("key", "lo", "hi", "rep", "comp")}

    return of


def _links_in_block(k: int, percent: int) -> Callable[[pa.Table], dict]:
    """Links between components among the rows of one block pair: a forest of them."""

    def of(rows: pa.Table) -> dict:
        sets = [s for c in texts(rows.column("text").combine_chunks()) for s in shingle_sets(words(c, LOWER), k)]
        comp = rows.column("comp").to_numpy()
        root = {c: c for c in comp.tolist()}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        # Postings of the shingles: counts of common ones without pairwise merging.
        size = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), size)
        values, code = np.unique(np.concatenate(sets), return_inverse=True)
        order = np.argsort(code, kind="stable")
        ends = np.searchsorted(code[order], np.arange(len(values) + 1))
        first = np.concatenate([[0], np.cumsum(size)])
        links = []
        for i in range(len(sets)):
            own = code[first[i] : first[i + 1]]
            spans = [order[ends[c] : ends[c + 1]] for c in own.tolist()]
            common = np.bincount(owner[np.concatenate(spans)], minlength=len(sets)) if spans else np.zeros(len(sets))
            alike = 100 * common >= percent * (size + size[i] - common)
            for j in np.flatnonzero(alike[i + 1 :] & (comp[i + 1 :] != comp[i])) + i + 1:
                x, y = find(int(comp[i])), find(int(comp[j]))
                if x != y:
                    root[max(x, y)] = min(x, y)
                    links.append((int(comp[i]), int(comp[j])))
        return {"a": np.array([x for x, _ in links], np.int64), "b": np.array([y for _, y in links], np.int64)}

    return of


def _with_component(rows: DataFrame, components: DataFrame) -> DataFrame:
    """``rows`` (with ``rep``) and ``comp``, the component of it or itself."""
    joined = rows.join(components.withColumnRenamed("node", "rep"), "rep", "left")
    return joined.withColumn("comp", F.coalesce("component", "rep")).drop("component")


def near_duplicates(
    docs: DataFrame, shingle_words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row ``doc_id, n_shingles, component_id, kept``.

    Linked are documents whose sets of ``shingle_words``-word shingles have at
    least ``percent`` / 100 of their union in common. ``kept`` is the least
    document of each component.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, n long, fp1 long, fp2 long, sig binary, bands array<long>"
    signed = stored(over_texts(narrow, _signatures(shingle_words), schema), "signatures")
    whole = ["fp1", "fp2", "n"]
    classes = stored(
        signed.filter("n > 0 and doc_id is not null")
        .groupBy(*whole)
        .agg(F.min(F.struct("doc_id", "sig", "bands")).alias("least"))
        .select(*whole, F.col("least.doc_id").alias("rep"), "least.sig", "least.bands"),
        "classes",
    )
    own = stored(signed.select("doc_id", *whole).join(classes.select(*whole, "rep"), whole, "left"), "own")
    components = _link(narrow, classes, _one_id(own), shingle_words, percent)

    placed = _with_component(own, components)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return placed.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _one_id(own: DataFrame) -> DataFrame:
    """Links (a, b) of classes that have a document, by its id, in common."""
    shared = own.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("last")).filter("b < last")
    return own.join(shared, "doc_id").filter("rep > b").select(F.col("rep").alias("a"), "b").distinct()


def _members(classes: DataFrame) -> DataFrame:
    """``(key, band, rep, pivot, size)`` of buckets with two classes or more."""
    keyed = classes.select("rep", F.posexplode("bands").alias("band", "key"))
    heads = keyed.groupBy("key").agg(F.min("rep").alias("pivot"), F.count("*").alias("size"))
    heads = stored(heads.filter("size > 1"), "buckets")
    return stored(keyed.join(small_side(heads, heads.count()), "key"), "members")


def _link(docs: DataFrame, classes: DataFrame, given: DataFrame, k: int, percent: int) -> DataFrame:
    """``(node, component)`` of the classes that are linked with others, ``given`` links included."""
    members = _members(classes)
    signature = classes.select("rep", "n", "sig")
    stars = members.filter("rep <> pivot").select(F.col("rep").alias("a"), F.col("pivot").alias("b")).distinct()
    sides = (
        stars.join(signature.toDF("a", "n", "sig"), "a")
        .join(signature.toDF("b", "n_b", "sig_b"), "b")
        .filter(100 * F.least("n", "n_b") >= percent * F.greatest("n", "n_b"))
        .select("a", "b", "sig", "sig_b")
    )
    likely = sides.mapInArrow(_count_matches, "a long, b long, matches int").filter(F.col("matches") >= least_matches(percent))
    likely = stored(likely, "likely")

    best = likely.groupBy("a").agg(F.max(F.struct("matches", "b")).alias("best")).select("a", "best.b")
    links = stored(_confirm(docs, best, k, percent).unionByName(given), "links")
    components = connected_components(links)

    tried = _across(likely.select("a", "b").join(best, ["a", "b"], "left_anti"), components)
    more = stored(_confirm(docs, tried, k, percent), "links")
    if not more.isEmpty():
        links = links.unionByName(more)
        components = connected_components(links)

    open_buckets = (
        _with_component(members.filter("rep <> pivot").select("key", "rep"), components)
        .groupBy("key")
        .agg(F.min("comp").alias("x"), F.max("comp").alias("y"))
        .filter("x <> y")
        .select("key")
    )
    open_buckets = stored(open_buckets, "open")
    n_open = open_buckets.count()
    if not n_open:
        return components
    inside = members.filter("rep <> pivot").join(small_side(open_buckets, n_open), "key", "left_semi")
    blocks = F.ceil((F.col("size") - 1) / BLOCK).cast("int")
    dealt = (
        _with_component(inside.select("key", "band", "rep", "size"), components)
        .join(classes.select("rep", "n", "sig", F.transform("bands", lambda x: x.bitwiseAND(2**31 - 1).cast("int")).alias("bands")), "rep")
        .withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("lo", F.least("block", "other"))
        .withColumn("hi", F.greatest("block", "other"))
        .drop("size", "other")
    )
    pair = ["key", "lo", "hi"]
    found = over_groups(dealt, pair, _alike_in_block(percent), "key long, lo int, hi int, rep long, comp long")
    found = stored(found.distinct(), "alike")
    n_found = found.count()
    if not n_found:
        return components
    with_text = docs.join(small_side(found, n_found), docs["doc_id"] == found["rep"]).select(*pair, "rep", "comp", "text")
    forest = over_groups(with_text, pair, _links_in_block(k, percent), "a long, b long")
    merged = stored(connected_components(forest), "merged")
    if merged.isEmpty():
        return components
    # The forest links components; the nodes of these follow.
    ends = components.unionByName(merged.select("node", F.col("node").alias("component"))).groupBy("node")
    now = ends.agg(F.min("component").alias("was"))
    moved = now.join(merged.toDF("was", "component"), "was", "left")
    return stored(moved.select("node", F.coalesce("component", "was").alias("component")), "components")


def _across(pairs: DataFrame, components: DataFrame) -> DataFrame:
    """Pairs (a, b) that are in different components."""
    side_a = _with_component(pairs.withColumnRenamed("a", "rep"), components).toDF("a", "b", "comp_a")
    both = _with_component(side_a.withColumnRenamed("b", "rep"), components)
    return both.filter("comp_a <> comp").select("a", F.col("rep").alias("b"))


def keep_first(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the rows that aren't the least of their component."""
    gone = near_duplicates(docs, shingle_words, percent).filter(~F.col("kept")).select("doc_id")
    return without(docs, gone)
