"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

A source's target is its share of ``TOTAL`` times all words by weight, at most ``EPOCHS`` times its own words; what is cut off is
shared anew by weight among the others. Sharing until none is above ends at one water level l with target = min(cap, l * weight).
With sources in the order of cap / weight and the first i of them capped, the level would be l_i = (all - caps_i) / weights_i; the
level is the largest l_i, so one running sum over the sources finds it.

A target is filled with complete epochs of the source first; the rest is taken in the order of exponential keys -ln(u) / weight,
u a hash of the document, weight its quality (the share of characters that are not symbols). The words are summed in that order, and
the document at the border gives the words that are still missing. The order of a source is never sorted in one place: keys fall into
ranges of equal ratio, ``RANGES`` to a doubling, whatever the weights are; running sums over the ranges find the one with the border, running sums over its ``PARTS`` parts find
the part, and only its documents, about one in a million of the source, are sorted.

Rows: one per input row. A null or wordless text has size 0 and gives nothing. Null sources are one source, the last. Rows with
equal doc_id and text are equal candidates. An empty table, or one without words, takes nothing. Columns besides doc_id, text and source are ignored,
unless ``carry`` names them; what is carried stays with its row, whatever the doc_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.storage import stored

WEIGHTS = (5, 2, 1)
TOTAL = 1.5
EPOCHS = 2
RANGES = 64
PARTS = 4096
SYMBOLS = "#*$%&|<>"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """The share of characters that are no symbols, in whole percent; 0.01 at least."""
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    share = F.floor(100 - 100 * symbols / F.greatest(F.length(text), F.lit(1)))
    return F.greatest(F.coalesce(share, F.lit(0)), F.lit(1)) / 100


def uniform(doc_id: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of a hash, the same in every run and engine."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / 2.0**52


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL, epochs: int = EPOCHS) -> DataFrame:
    """of_source, source_size, docs and target of each source, from (source, size) rows."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    sources = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    capped, used = F.coalesce(F.sum("source_size").over(order), F.lit(0)) * epochs, F.coalesce(F.sum("weight").over(order), F.lit(0))
    level = (total * F.sum("source_size").over(everything) - capped) / (F.sum("weight").over(everything) - used)
    sources = sources.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    target = F.least(F.col("level") * F.col("weight"), F.col("source_size").cast("double") * epochs)
    return sources.select(F.col("source").alias("of_source"), "source_size", "docs", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL, epochs: int = EPOCHS, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target (of its source) and taken, the words that the mix takes of each row; then the carried columns besides doc_id."""
    held = ["carried"] if carry else []
    text, whole = F.col("text").cast("string"), F.col("doc_id")
    sizes = stored(docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(text).alias("size"), (-F.log(uniform(whole)) / quality_weight(text)).alias("key"), *(F.struct(*carry).alias(c) for c in held)), "sizes")
    targets = stored(source_targets(sizes, weights, total, epochs), "targets")
    rows = sizes.join(targets, sizes.source.eqNullSafe(targets.of_source)).drop("of_source")
    full = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    rows = rows.withColumn("full", full).withColumn("missing", (F.round("target") - F.col("full") * F.col("source_size")).cast("long"))
    spot = RANGES * F.log2(F.greatest("key", F.lit(1e-300)))
    rows = rows.withColumn("range", F.floor(spot)).withColumn("part", F.floor((spot - F.floor(spot)) * PARTS))

    def border(rows: DataFrame, unit: str, before: Column) -> DataFrame:
        """Of each source, the unit with the border of the budget, and the words before it."""
        units = rows.groupBy("source", unit).agg(F.sum("size").alias("words"), F.first("missing").alias("missing"), F.first(before).alias("start"))
        upto = F.col("start") + F.sum("words").over(Window.partitionBy("source").orderBy(unit))
        units = units.withColumn("before", upto - F.col("words")).where(F.col("missing") < F.col("before") + F.col("words"))
        return units.groupBy(F.col("source").alias("of_source")).agg(F.min(unit).alias(f"border_{unit}"), F.min_by("before", unit).alias(f"before_{unit}"))

    ranges = stored(border(rows, "range", F.lit(0).cast("long")), "border-ranges")
    rows = rows.join(ranges, rows.source.eqNullSafe(ranges.of_source), "left").drop("of_source")
    parts = stored(border(rows.where("range = border_range"), "part", F.col("before_range")), "border-parts")
    rows = rows.join(parts, rows.source.eqNullSafe(parts.of_source), "left").drop("of_source")
    place = F.when(F.col("border_range").isNull() | (F.col("range") < F.col("border_range")), -1).when(F.col("range") > F.col("border_range"), 1).otherwise(F.signum(F.col("part") - F.col("border_part")).cast("int"))
    rows = rows.withColumn("place", place).withColumn("before", F.col("before_part"))
    inside = rows.where("place = 0").withColumn("before", F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("key", "doc_id", "size", *held).rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    inside = inside.withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("missing") - F.col("before"))))
    others = rows.where("place <> 0").withColumn("extra", F.when(F.col("place") < 0, F.col("size")).otherwise(0))
    both = others.unionByName(inside)
    return both.select("doc_id", "size", "source_size", "target", (F.col("full") * F.col("size") + F.col("extra")).cast("long").alias("taken"), *(F.col(f"carried.{c}") for c in carry if c != "doc_id"))


SQL = r"""
with sizes as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    -ln((('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 13))::bigint + 0.5) / 4503599627370496.0)
      / (greatest(coalesce(floor(100 - 100 * (length(text) - length(translate(text, '#*$%&|<>', ''))) / greatest(length(text), 1)), 0), 1) / 100) as key
  from documents),
sources as (
  select source, sum(size)::bigint as source_size, [5, 2, 1][((row_number() over (order by source collate "binary" nulls last) - 1) % 3 + 1)::int] as weight
  from sizes group by source),
levels as (
  select *, (1.5 * sum(source_size) over () - 2 * coalesce(sum(source_size) over o, 0)) / (sum(weight) over () - coalesce(sum(weight) over o, 0)) as l
  from sources window o as (order by source_size / weight, source nulls last rows between unbounded preceding and 1 preceding)),
targets as (select source, source_size, least(max(l) over () * weight, 2.0 * source_size)::double as target from levels),
keyed as (
  select doc_id, size, source_size, target, floor(target / greatest(source_size, 1)) as epochs,
    coalesce(sum(size) over (partition by s.source order by key, doc_id, size rows between unbounded preceding and 1 preceding), 0) as before
  from sizes s join targets t on s.source is not distinct from t.source)
select doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(size, round(target) - epochs * source_size - before)))::bigint as taken
from keyed
"""
