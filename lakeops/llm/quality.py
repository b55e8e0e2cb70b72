"""Quality rules: per-document statistics, base rules, and robust multivariate outliers.

The statistics vector of a document is transformed to logarithms (``_features``). For each language and source a minimum
covariance determinant estimate is fitted: of all documents of the group that pass the base rules, the half whose mean and covariance have
the smallest determinant, found by concentration steps from two fixed starts until no determinant falls any more. Then the estimate is reweighted: it is taken once more
from all documents within the ``TRUSTED`` quantile of it. Every step is one aggregation over all
documents (counts and integer sums of products, so that results do not depend on the order of rows) and the half is cut at a quantile taken from a histogram of the distances; no group is
ever gathered. Documents whose consistency-corrected squared
Mahalanobis distance lies beyond the chi-square quantile ``1 - TAIL`` are rejected.

Groups under ``SMALLEST`` documents are pooled by language, and languages under it all together.

Rows: one per input row. A null text has no words, so it fails the base rules; null languages and sources are groups of their own. An empty table gives an
empty table. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakeops.llm.storage import stored
from lakeops.llm.text import Words, hash_runs, per_doc, slices, words

LEAST_WORDS = 10
MOST_REPEATED = 20
WINDOW = 5
SMALLEST = 50
#: The fall of a log-determinant that asks for another concentration step.
TOLERANCE = 0.02
#: Share of clean documents that the cutoff may reject, and quantile of the reweighting step.
TAIL = 1e-4
TRUSTED = 0.975
ALL = "all"
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Features are kept as whole numbers of 1/UNIT: log words, log mean word length, log(1 + % symbols), log(1 + repeated lines), log(1 + % repeated words).
UNIT = 256
#: Standard deviations added to every estimate: most documents have no symbols or repeats at all, so plain estimates would be singular.
FLOORS = (0.5, 0.15, 0.25, 0.5, 1.0)


def chi2_share(x: float, k: int) -> float:
    """P(chi-square with k degrees of freedom <= x), by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    term = total = 1 / (k / 2)
    n = k / 2
    while term > total * 1e-15:
        n += 1
        term *= x / 2 / n
        total += term
    return total * math.exp(-x / 2 + k / 2 * math.log(x / 2) - math.lgamma(k / 2))


def chi2_quantile(share: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_share(middle, k) < share else (low, middle)
    return low


def consistency(share: float, k: int = len(FLOORS)) -> float:
    """What the covariance of the inner ``share`` of a normal cloud is multiplied by to give the whole cloud's."""
    return share / chi2_share(chi2_quantile(share, k), k + 2)


#: Squared distance beyond which a document is an outlier, and up to which it takes part in the reweighted estimate.
CUTOFF = chi2_quantile(1 - TAIL, len(FLOORS))
NEAR = chi2_quantile(TRUSTED, len(FLOORS))

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_LOW = np.uint64((1 << 52) - 1)


def _repeated(found: Words, n: int) -> np.ndarray:
    """Words inside five-word windows that occur twice or more in their document, per document."""
    at = found.windows(WINDOW)
    cover = np.zeros(len(found.starts) + 1, np.int64)
    if len(at):
        doc = (np.searchsorted(found.first, at, "right") - 1).astype(np.uint64)
        key = (doc << np.uint64(52)) | (hash_runs(found.hashes(), WINDOW)[at] & _LOW)
        order = np.sort(key)
        twice = np.unique(order[1:][order[1:] == order[:-1]])
        if len(twice):
            spot = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
            same = np.flatnonzero(twice[spot] == key)
            text, starts, ends = found.joined()
            pieces = [(d, text[a:b]) for d, a, b in zip(doc[same].tolist(), starts[at[same]].tolist(), ends[at[same] + WINDOW - 1].tolist(), strict=True)]
            times = Counter(pieces)  # the words themselves decide, not their hashes
            hit = at[same[np.array([times[p] > 1 for p in pieces], bool)]]
            np.add.at(cover, hit, 1)
            np.add.at(cover, hit + WINDOW, -1)
    return per_doc(np.cumsum(cover)[:-1] > 0, found.first)


def _copied_lines(text: str | None) -> int:
    lines = (text or "").split("\n")
    if len(set(lines)) == len(lines):
        return 0
    return sum(n - 1 for line, n in Counter(lines).items() if n > 1 and line.strip(" \t\r\x0b\x0c"))


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Appends the five statistics of ``text`` to each batch."""
    for batch in batches:
        for part in slices(batch, rows=4096):
            texts = part.column(part.schema.get_field_index("text"))
            found = words(texts)
            inside = np.zeros(len(found.buf) + 1, np.int8)
            inside[found.starts] += 1
            inside[found.ends] -= 1
            chars = (np.cumsum(inside[:-1]) > 0) & ((found.buf & 0xC0) != 0x80)
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns,
                    pa.array(found.counts.astype(np.int64)),
                    pa.array(per_doc(chars, found.offsets)),
                    pa.array(per_doc(_SYMBOL[found.buf], found.offsets)),
                    pa.array([_copied_lines(t) for t in texts.to_pylist()], pa.int64()),
                    pa.array(_repeated(found, part.num_rows)),
                ],
                [*part.schema.names, *STATISTICS],
            )


def statistics(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang, source, the columns in ``carry``, the five statistics of every document, and base_failed."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), *(c for c in carry if c not in ("doc_id", "text", "lang", "source")))
    schema = StructType([*docs.schema.fields, *(StructField(s, LongType()) for s in STATISTICS)])
    found = docs.mapInArrow(_statistics, schema).withColumn("base_failed", F.expr(f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words"))
    return found if "text" in carry else found.drop("text")


def _features() -> list[Column]:
    """The transformed statistics in whole units of 1/UNIT."""
    n, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    logs = [F.log(n), F.log(chars / n), F.log1p(100 * F.col("n_symbols") / chars), F.log1p(F.col("n_dup_lines")), F.log1p(100 * F.col("n_repeat_words") / n)]
    return [F.round(x * UNIT).cast("long").alias(f"x{i}") for i, x in enumerate(logs)]


def _distance(mean: str = "mean", precision: str = "precision") -> Column:
    p = len(FLOORS)
    off = [F.col(f"x{i}") - F.col(mean)[i] for i in range(p)]
    return sum((F.col(precision)[i * p + j] * off[i] * off[j] * (1 if i == j else 2) for i in range(p) for j in range(i, p)), F.lit(0.0))


def _invert(share: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts, sums and sums of products of the inner ``share`` of a group to mean, precision matrix and log-determinant."""
    p = len(FLOORS)
    factor = consistency(share)
    floor = np.diag((np.array(FLOORS) * UNIT) ** 2)
    upper = np.triu_indices(p)
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            n, mean = r["n"], np.array([r[f"s{i}"] for i in range(p)], float) / r["n"]
            second = np.zeros((p, p))
            second[upper] = np.array([r[f"s{i}{j}"] for i, j in zip(*upper, strict=True)], float) / n
            second = np.triu(second) + np.triu(second, 1).T
            cov = (second - np.outer(mean, mean)) * factor + floor
            rows.append({"grp": r["grp"], "start": r["start"], "was": r["was"], "mean": mean.tolist(), "precision": np.linalg.inv(cov).ravel().tolist(), "logdet": float(np.linalg.slogdet(cov)[1])})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("grp", pa.string()), ("start", pa.int32()), ("was", pa.float64()), ("mean", pa.list_(pa.float64())), ("precision", pa.list_(pa.float64())), ("logdet", pa.float64())]))


def group_of(stats: DataFrame, sizes: DataFrame) -> DataFrame:
    """Adds ``grp``, the group whose estimate a document is held against."""
    return stats.join(sizes, stats.lang.eqNullSafe(sizes.of_lang) & stats.source.eqNullSafe(sizes.of_source), "left").drop("of_lang", "of_source").withColumn("grp", F.coalesce("grp", F.lit(ALL)))


def fit(stats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The groups of (language, source), and mean and precision of every group."""
    p = len(FLOORS)
    passed = stats.where("not base_failed")
    sizes = passed.groupBy("lang", "source").agg(F.count("*").alias("n"))
    langs = sizes.groupBy("lang").agg(F.sum("n").alias("all")).withColumnRenamed("lang", "l")
    sizes = sizes.join(langs, sizes.lang.eqNullSafe(langs.l)).select(
        F.col("lang").alias("of_lang"), F.col("source").alias("of_source"),
        F.when(F.col("n") >= SMALLEST, F.to_json(F.struct("lang", "source"))).when(F.col("all") >= SMALLEST, F.to_json(F.struct("lang"))).otherwise(ALL).alias("grp"),
    )
    sizes = stored(sizes, "groups")
    x = stored(group_of(passed, sizes).select("grp", *_features()), "features")
    half = x.groupBy("grp").agg(*(F.percentile(f"x{i}", F.lit(0.5)).alias(f"c{i}") for i in range(p)))
    half = stored(half, "medians")
    spread = x.join(half, "grp").groupBy("grp").agg(*(F.first(f"c{i}").alias(f"c{i}") for i in range(p)), *(F.percentile(F.abs(F.col(f"x{i}") - F.col(f"c{i}")), F.lit(0.5)).alias(f"d{i}") for i in range(p)))
    mean = F.array(*(F.col(f"c{i}") for i in range(p)))

    def diagonal(sd: list[Column]) -> Column:
        return F.array(*(1 / (sd[i] * sd[i]) if i == j else F.lit(0.0) for i in range(p) for j in range(p)))

    floors = [F.lit(f * UNIT) for f in FLOORS]
    starts = F.explode(F.array(
        F.struct(F.lit(0).alias("start"), diagonal([F.greatest(1.4826 * F.col(f"d{i}"), floors[i]) for i in range(p)]).alias("precision")),
        F.struct(F.lit(1).alias("start"), diagonal(floors).alias("precision")),
    ))
    estimates = stored(spread.select("grp", mean.alias("mean"), starts.alias("s")).select("grp", "mean", "s.*", F.lit(math.inf).alias("logdet")), "estimates")
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    names = ("n", *(f"s{i}" for i in range(p)), *(f"s{i}{j}" for i, j in pairs))
    moments = [F.count("*"), *(F.sum(f"x{i}") for i in range(p)), *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")) for i, j in pairs)]
    moments = [m.alias(n) for m, n in zip(moments, names, strict=True)]

    def inverted(sums: DataFrame, share: float) -> DataFrame:
        return stored(sums.mapInArrow(lambda batches: _invert(share, batches), "grp string, start int, was double, mean array<double>, precision array<double>, logdet double"), "estimates")

    for step in count():  # determinants only fall, and the floors bound them from below
        near = F.floor(32 * F.log2(_distance() + 0.01)).cast("int")
        bins = x.join(estimates, "grp").groupBy("grp", "start", near.alias("bin")).agg(F.first("logdet").alias("was"), *moments)
        whole = Window.partitionBy("grp", "start")
        inner = bins.withColumn("before", F.sum("n").over(whole.orderBy("bin")) - F.col("n")).withColumn("of", F.sum("n").over(whole)).where("2 * before < of")
        estimates = inverted(inner.groupBy("grp", "start").agg(F.first("was").alias("was"), *(F.sum(c).alias(c) for c in names)), 0.5)
        if step and estimates.where(F.col("logdet") < F.col("was") - TOLERANCE).isEmpty():
            break
    best = estimates.groupBy("grp").agg(F.min_by(F.struct("mean", "precision"), F.struct("logdet", "start")).alias("e")).select("grp", "e.*")
    trusted = x.join(stored(best, "estimates"), "grp").where(_distance() <= NEAR).groupBy("grp").agg(F.lit(0).alias("start"), F.lit(None).cast("double").alias("was"), *moments)
    return sizes, inverted(trusted, TRUSTED).select("grp", "mean", "precision")


def judge(stats: DataFrame, fitted: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Adds ``distance`` (squared, robust; null where no group exists) and ``kept``."""
    sizes, estimates = fitted
    kept = [F.col(c) for c in stats.columns]
    placed = group_of(stats, sizes).select(*kept, "grp", *_features())
    return placed.join(estimates, "grp", "left").select(*kept, _distance().alias("distance")).withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True)))


def quality_verdicts(docs: DataFrame) -> DataFrame:
    stats = stored(statistics(docs), "statistics")
    return judge(stats, fit(stats)).select("doc_id", *STATISTICS, "base_failed", "kept", "distance")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged, whatever their columns are called. The statistics are taken twice, so that no text is shuffled or stored."""
    stats = stored(statistics(docs), "statistics")
    # the columns travel in a struct, where no name can clash; a text that is a string stands beside them anyway
    beside = docs.schema["text"].dataType == StringType()
    inside = [c for c in docs.columns if not (beside and c == "text")]
    held = docs.select("doc_id", "text", "lang", "source", F.struct(*(F.col(f"`{c}`") for c in inside)).alias("carried"))
    good = judge(statistics(held, ("text", "carried") if beside else ("carried",)), fit(stats)).where("kept")
    return good.select(*(F.col("text") if beside and c == "text" else F.col(f"carried.`{c}`") for c in docs.columns))
