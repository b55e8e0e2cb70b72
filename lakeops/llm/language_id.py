"""Language identification by rank-order profiles of character n-grams (the out-of-place measure).

Texts are lower-cased; every run of letters is a word with a boundary on both sides; n-grams have one to ``LONGEST`` characters and do
not cross words. A language's profile is its ``PROFILE`` most frequent n-grams, a document's its own ``PROFILE`` most frequent, ties
in order of the characters. The distance to a language adds up, over the document's n-grams, how far the two ranks are apart, and
``PROFILE`` where the language lacks the n-gram. The nearest language wins, of equal ones the first by name.

Profiles are fitted on at most ``SAMPLE`` labelled documents of each language in the training part, those with the smallest hash of their text
and id, so that a rare language is learned at every size of the table; they hold languages x PROFILE n-grams and are broadcast in blocks of ``LANGUAGES`` languages;
a block keeps the better of its own and the earlier blocks' nearest language for each row.

Rows: one per input row. ``und`` where the text is null or has no letter; documents too where nothing could be learned. The score is
1 - distance / the largest possible one, so repeated and empty cases give the same values. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.storage import stored
from lakeops.llm.text import slices

LONGEST = 3
PROFILE = 300
SAMPLE = 20_000
LANGUAGES = 2_000
UNKNOWN = "und"

_letters: np.ndarray | None = None


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def _symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters as small numbers from 2 on, one boundary (1) around every word; their documents; and the code points by number."""
    lowered = [(t or "").lower() for t in texts]
    points = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])
    letter = _is_letter()[points]
    points = np.where(letter, points, 0)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:-1] |= letter[1:]
    # a boundary between two words counts for both; the first letter of a document gets one of its own from the line end before it
    start = np.flatnonzero(letter & np.concatenate(([True], doc[1:] != doc[:-1])))
    points, doc = points[keep], doc[keep]
    start = np.searchsorted(np.flatnonzero(keep), start)
    points, doc = np.insert(points, start, 0), np.insert(doc, start, doc[start] if len(start) else 0)
    used = np.zeros(0x110000, bool)
    used[points] = True
    used[0] = True
    number = np.cumsum(used)
    return number[points].astype(np.int64), doc, np.flatnonzero(used)


def _grams(symbols: np.ndarray, doc: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams as numbers to the base, shorter ones ending in zeros, and their documents."""
    grams, docs = [], []
    solid = symbols > 1
    for n in range(1, LONGEST + 1):
        if len(symbols) < n:
            break
        span = len(symbols) - n + 1
        gram = np.zeros(span, np.int64)
        good = doc[: span] == doc[n - 1 :]
        any_letter = np.zeros(span, bool)
        for i in range(n):
            gram = gram * base + symbols[i : i + span]
            any_letter |= solid[i : i + span]
            if 0 < i < n - 1:
                good &= solid[i : i + span]  # inner places are letters
        gram *= base ** (LONGEST - n)
        good &= any_letter
        grams.append(gram[good])
        docs.append(doc[: span][good])
    return np.concatenate(grams) if grams else np.zeros(0, np.int64), np.concatenate(docs) if docs else np.zeros(0, np.int64)


def _counted(texts: list[str | None]):
    """Documents, grams and counts, sorted by document and gram; the base; the code points of the symbols."""
    symbols, doc, points = _symbols(texts)
    base = len(points) + 1
    gram, doc = _grams(symbols, doc, base)
    key, count = np.unique(doc * base**LONGEST + gram, return_counts=True)
    return key // base**LONGEST, key % base**LONGEST, count, base, points


def _top(doc: np.ndarray, gram: np.ndarray, count: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent grams of each document with their ranks from 0; input sorted by document and gram."""
    order = np.lexsort((-count, doc))  # stable: equal counts stay in order of grams
    doc, gram = doc[order], gram[order]
    first = np.searchsorted(doc, doc, "left")
    rank = np.arange(len(doc)) - first
    keep = rank < size
    return doc[keep], gram[keep], rank[keep]


def _text(gram: int, base: int, points: np.ndarray) -> str:
    out = []
    for _ in range(LONGEST):
        gram, digit = divmod(gram, base)
        if digit:
            out.append(" " if digit == 1 else chr(points[digit - 1]))
    return "".join(reversed(out))


def _profile_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, rows=2048):
            langs = part.column(0).to_pylist()
            doc, gram, count, base, points = _counted(part.column(1).to_pylist())
            names = sorted(set(langs))
            lang = np.array([names.index(x) for x in langs], np.int64)[doc] if len(doc) else doc
            key, place = np.unique(lang * base**LONGEST + gram, return_inverse=True)
            sums = np.bincount(place, weights=count).astype(np.int64) if len(key) else key
            rows = [(names[k // base**LONGEST], _text(k % base**LONGEST, base, points), n) for k, n in zip(key.tolist(), sums.tolist(), strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.int64()), strict=True)], ["lang", "gram", "n"])


def fit(docs: DataFrame, sample: int = SAMPLE, profile: int = PROFILE) -> DataFrame:
    """(lang, gram, place) of every learned language, from (doc_id, text, lang) rows."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", F.xxhash64("doc_id", "text").alias("order"))
    # hashes that are surely not among a language's smallest (six standard deviations beyond the share that is needed) are dropped before the sort
    sizes = stored(labelled.groupBy(F.col("lang").alias("of_lang")).agg(F.count("*").alias("docs")), "language-sizes")
    needed = sample + 6 * sample**0.5 + 36
    likely = labelled.join(sizes, F.col("lang") == F.col("of_lang")).where((F.col("docs") <= needed) | (F.col("order").cast("double") <= 2.0**64 * needed / F.col("docs") - 2.0**63))
    # the hashes alone are sorted: the last one that is taken, and how many of the rows that have it (copies of one row) are
    place = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    taken = likely.select("lang", "order").withColumn("place", place).where(F.col("place") <= sample).groupBy("lang", "order").agg(F.count("*").alias("copies"))
    ends = stored(taken.groupBy(F.col("lang").alias("of_lang")).agg(F.max("order").alias("end"), F.max_by("copies", "order").alias("copies")), "sample-ends")
    placed = labelled.join(ends, F.col("lang") == F.col("of_lang"))
    copies = placed.where("order = end").groupBy("lang").agg(F.min("text").alias("text"), F.first("copies").alias("copies")).select("lang", "text", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("lang", "text")
    chosen = placed.where("order < end").repartition("order").select("lang", "text").unionByName(copies)
    counts = chosen.mapInArrow(_profile_counts, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # of each language, a task sends only its own ``profile`` most frequent n-grams on
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return counts.withColumn("place", rank - 1).where(F.col("place") < profile).select("lang", "place", "gram")


def _nearest(profiles, last: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the nearest language of a block of profiles, with its distance as a score, unless an earlier block has a nearer one."""
    names, table, size = profiles.value
    for batch in batches:
        for part in slices(batch, rows=2048):
            n = part.num_rows
            doc, gram, count, base, points = _counted(part.column(2).to_pylist())
            doc, gram, rank = _top(doc, gram, count, size)
            total = np.bincount(doc, minlength=n)
            lang, score = part.column(3).to_pylist(), part.column(4).to_numpy().copy()
            if len(doc) and names:
                number = {int(p): i + 1 for i, p in enumerate(points)}
                number[0] = 1
                best, nearest = np.full(n, np.inf), np.zeros(n, np.int64)
                for i, grams in enumerate(table):
                    ours = sorted((g, place) for place, g in ((place, _number(text, number, base)) for place, text in enumerate(grams)) if g is not None)
                    keys = np.array([g for g, _ in ours], np.int64)
                    places = np.array([p for _, p in ours], np.int64)
                    apart = np.full(len(gram), size, np.int64)
                    if len(keys):
                        at = np.minimum(np.searchsorted(keys, gram), len(keys) - 1)
                        hit = keys[at] == gram
                        apart[hit] = np.abs(places[at[hit]] - rank[hit])
                    distance = np.bincount(doc, weights=apart, minlength=n)
                    nearer = distance < best
                    best[nearer], nearest[nearer] = distance[nearer], i
                ours = 1 - best / np.maximum(total * size, 1)
                for i in np.flatnonzero((total > 0) & (ours > score)).tolist():
                    lang[i], score[i] = names[nearest[i]], ours[i]
            columns = {"doc_id": part.column(0), "held_out": part.column(1), "text": part.column(2), "lang_pred": pa.array(lang, pa.string()), "score": pa.array(score)}
            if last:
                del columns["text"]
            yield pa.RecordBatch.from_pydict(columns)


def _number(text: str, number: dict[int, int], base: int) -> int | None:
    out = 0
    for c in text:
        digit = number.get(0 if c == " " else ord(c))
        if digit is None:
            return None
        out = out * base + digit
    return out * base ** (LONGEST - len(text))


def identify(docs: DataFrame, profiles: DataFrame, size: int = PROFILE, block: int = LANGUAGES) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, from its whole text alone."""
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(-1.0).alias("score"))
    schema = "doc_id long, held_out boolean, text string, lang_pred string, score double"
    last = None
    while True:  # one block, unless there are more languages than that
        ahead = profiles if last is None else profiles.where(F.col("lang") > last)
        grams: dict[str, list[str]] = {}
        for r in ahead.join(F.broadcast(ahead.select("lang").distinct().orderBy("lang").limit(block)), "lang").orderBy("lang", "place").collect():
            grams.setdefault(r["lang"], []).append(r["gram"])
        if not grams:
            break
        shared = docs.sparkSession.sparkContext.broadcast((list(grams), list(grams.values()), size))
        whole = len(grams) < block
        found = found.mapInArrow(lambda batches, shared=shared, whole=whole: _nearest(shared, whole, batches), schema.replace("text string, ", "") if whole else schema)
        last = list(grams)[-1]
        if whole:
            break
    return found.select("doc_id", "held_out", "lang_pred", F.greatest("score", F.lit(0.0)).alias("score"))


def language_predictions(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Learn from the labelled documents that are not held out, predict all."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return identify(docs, stored(fit(docs.where(~held_out(F.col("doc_id"))), sample), "profiles"))
