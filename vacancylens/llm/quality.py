"""Host-level quality rules: shrunken failure rates of hosts decide with the text's own.

1. Counts of every text (words, symbols, repeated lines and passages).
2. Rules on these counts; a row fails if one of them fires.
3. Rows and failures by host, counted before anything is shuffled. A beta prior
   is fitted to all hosts by moments, so a host of three bad rows isn't judged
   like one of three thousand.
4. Hosts whose shrunken rate is over a limit fail, and all their rows with them.

Empty or null texts have no words and fail the base rule. Rows without a host
are one host. Repeated rows count each time; an empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylens.llm.arrays import LETTER, NOT_SPACE, Texts, byte_set, complement, flagged, windows, words
from vacancylens.llm.frames import over_texts, small_side, stored

SYMBOLS = "#*$%&|<>"
WINDOW = 8
COUNTS = "n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_letters".split(", ")

_IS_SYMBOL = byte_set(SYMBOLS)
_IN_LINE = complement(byte_set("\n"))
_LATER_BYTE = byte_set(*range(0x80, 0xC0))


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=sums[1:])
    return np.diff(sums[offsets])


def _repeated_words(hashes: np.ndarray) -> int:
    """Words of one text in windows that occur in it twice or more."""
    if len(hashes) <= WINDOW:
        return 0
    keys = windows(hashes, WINDOW)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    hit = np.zeros(len(keys), dtype=bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    at = np.flatnonzero(hit)
    # Each window adds the words that the one before has not covered.
    return int(np.minimum(np.diff(at, prepend=at[0] - WINDOW), WINDOW).sum())


def count_chunk(chunk: Texts) -> dict[str, np.ndarray]:
    found = words(chunk)
    lines = words(chunk, solid=_IN_LINE)
    with_word = np.searchsorted(found.starts, lines.ends) > np.searchsorted(found.starts, lines.starts)
    data, offsets = chunk.data, chunk.offsets
    dup, n_lines, repeated = (np.zeros(len(chunk), np.int64) for _ in range(3))
    for row in range(len(chunk)):
        lo, hi = lines.first[row], lines.first[row + 1]
        own = lines.hashes[lo:hi][with_word[lo:hi]]
        n_lines[row] = len(own)
        dup[row] = len(own) - len(np.unique(own)) if len(own) > 1 else 0
        repeated[row] = _repeated_words(found.hashes[found.first[row] : found.first[row + 1]])
    head = ~flagged(data, _LATER_BYTE)
    return {
        "n_words": found.counts,
        "word_chars": _per_text(flagged(data, NOT_SPACE) & head, offsets),
        "n_symbols": _per_text(flagged(data, _IS_SYMBOL), offsets),
        "n_dup_lines": dup,
        "n_repeat_words": repeated,
        "n_lines": n_lines,
        "n_letters": _per_text(flagged(data, LETTER) & head, offsets),
    }


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Per row: ``doc_id``, ``host`` and the counts of its whole text."""
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.col(text_col).alias("text")
    )
    schema = "doc_id long, host string, " + ", ".join(f"{c} long" for c in COUNTS)

    def count(chunk: Texts, rows: pa.RecordBatch) -> dict:
        return {"doc_id": rows.column(0), "host": rows.column(1), **count_chunk(chunk)}

    return over_texts(narrow, count, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """What a row can fail by; the host's rate is over rows that fail any."""
    return {
        "short": F.col("n_words") < 20,
        "repeats": 100 * F.col("n_repeat_words") > 30 * F.col("n_words"),
        "symbols": 100 * F.col("n_symbols") > 10 * F.col("word_chars"),
        "same_lines": 100 * F.col("n_dup_lines") > 50 * F.col("n_lines"),
        "few_letters": 100 * F.col("n_letters") < 50 * F.col("word_chars"),
    }


@dataclass
class BetaPrior:
    """Mean and strength (in rows) of the failure rates of all hosts."""

    mean: float
    strength: float


#: Bounds of the prior's strength: no fewer rows than one, and beyond a million
#: rows (or where hosts differ no more than by chance) all hosts are alike.
WEAKEST, STRONGEST = 1.0, 1e6


def fit_prior(hosts: DataFrame) -> BetaPrior:
    """Method of moments over hosts (``n`` rows, ``failed`` of them).

    The variance of rates, weighted by rows, less what chance alone gives.
    """
    total = hosts.agg(F.sum("n").alias("n"), F.sum("failed").alias("failed"), F.count("*").alias("hosts")).first()
    if not total["n"]:
        return BetaPrior(0.0, STRONGEST)
    mean = total["failed"] / total["n"]
    spread = hosts.agg(F.sum(F.col("n") * F.pow(F.col("failed") / F.col("n") - F.lit(mean), F.lit(2.0)))).first()[0]
    variance, noise = spread / total["n"], mean * (1 - mean)
    by_chance = noise * total["hosts"] / total["n"]
    if variance <= by_chance or noise == 0:
        return BetaPrior(mean, STRONGEST)
    between = variance - by_chance
    return BetaPrior(mean, min(max(noise / between - 1, WEAKEST), STRONGEST))


def host_rates(counts: DataFrame) -> DataFrame:
    """Rows, failures by any rule and by each, and the shrunken rate, by host."""
    fired = rules()
    any_rule = None
    for rule in fired.values():
        any_rule = rule if any_rule is None else any_rule | rule
    hosts = stored(
        counts.groupBy("host").agg(
            F.count("*").alias("n"),
            F.sum(any_rule.cast("long")).alias("failed"),
            *(F.sum(rule.cast("long")).alias(f"failed_{name}") for name, rule in fired.items()),
        ),
        "hosts",
    )
    prior = fit_prior(hosts)
    shrunk = (F.col("failed") + F.lit(prior.mean * prior.strength)) / (F.col("n") + F.lit(prior.strength))
    return hosts.withColumn("rate", shrunk)


def judge(
    docs: DataFrame, host_limit: float = 0.5, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """Counts, ``base_failed``, ``host_failed`` and ``kept`` of every row."""
    counts = stored(text_counts(docs, id_col, text_col, host_col), "quality")
    bad = host_rates(counts).filter(F.col("rate") > host_limit).select(F.col("host").alias("bad_host"))
    # Only failing hosts are joined; rows of other hosts find none.
    joined = counts.join(small_side(bad, bad.count()), counts["host"].eqNullSafe(F.col("bad_host")), "left_semi")
    failed = joined.select(*counts.columns, F.lit(True).alias("host_failed"))
    passed = counts.join(small_side(bad, bad.count()), counts["host"].eqNullSafe(F.col("bad_host")), "left_anti")
    both = failed.unionByName(passed.withColumn("host_failed", F.lit(False)))
    return both.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))
