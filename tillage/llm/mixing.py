"""Mixing sources to target weights: Efraimidis-Spirakis order, prefix sums to token budgets, whole epochs first.

Everything here is a DataFrame operation; no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillage.llm.common import Scratch
from tillage.operators.order import positions, running

#: What a word is: a run of characters without ASCII white space.
WORDS = r"[^\x20\x09-\x0D]+"
#: Rows that one task makes of a group of copies.
_CHUNK = 50_000


def n_words(text: Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def _draw(seed: int) -> Column:
    """What a row of (doc_id, text) is known by, as 32 hexadecimal digits."""
    known = lambda c: F.coalesce(F.concat(F.lit("+"), c), F.lit("-"))
    return F.md5(F.concat(F.lit(f"{seed}:"), known(F.col("doc_id").cast("long").cast("string")), F.lit(":"), known(F.col("text"))))


def source_targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2, scratch: Scratch | None = None) -> DataFrame:
    """(source, source_size, target) from one row for each source (source, source_size).

    Sources in the order of their code points, null last, weigh ``weights``, repeating. Together they
    get ``share`` of all sizes in proportion to their weights, none more than ``most`` times its own
    size; what is cut off goes to the others by weight until none is above. Each round that finds
    sources above is one aggregation; there are as many rounds as times the level rises over another source's bound.
    """
    if not 0 <= share <= most:
        raise ValueError("the share of all sizes must be between 0 and the most that a source may give")
    scratch = scratch or Scratch(sizes.sparkSession)
    placed = positions(sizes.select("source", "source_size"), F.struct(F.col("source").isNull().alias("last"), "source"), name="place", scratch=scratch)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = scratch.save(placed.select("source", "source_size", weight.alias("w")))
    total = share * (rows.agg(F.sum("source_size")).first()[0] or 0)
    bound, n_capped = F.col("source_size") * most, -1
    over, free, weighed = F.lit(False), total, 0
    while True:
        # Exact: sizes and weights are whole numbers. The level only rises, so who is above stays above.
        r = rows.agg(F.count_if(over), F.sum(F.when(over, bound)), F.sum(F.when(~over, F.col("w")))).first()
        if r[0] == n_capped:
            break
        n_capped, free, weighed = r[0], total - (r[1] or 0), r[2] or 0
        over = F.col("w") * F.lit(float(free)) / F.lit(float(weighed)) > bound if weighed else F.lit(True)
    target = F.when(over, bound.cast("double")).otherwise(F.col("w") * F.lit(float(free)) / F.lit(float(weighed or 1)))
    return rows.select("source", "source_size", target.alias("target"))


def mix_plan(docs: DataFrame, quality: DataFrame | None = None, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: int = 11) -> DataFrame:
    """How often a mix takes each document of ``docs`` (doc_id, text, source, ...).

    One row for each distinct (doc_id, text, source): draw (what the row is known by), doc_id, source,
    size (words of the text, 0 for null), copies (equal rows of ``docs``), source_size, target,
    epochs (times that every copy is taken) and extra (how many of the copies are taken once more).

    Targets are those of source_targets. A source's whole epochs come first: a target of 1.7 times its size takes every
    document once. The rest is filled by an Efraimidis-Spirakis sample without replacement: each document gets an
    exponential key, -ln(u) / weight, of a number u drawn from a hash of ``seed``, doc_id and text; documents are taken in the order
    of their keys until the running sum of their sizes is as near to the rest as it gets. So a source is off its target by at
    most half of the size of one document, and reruns agree. ``quality`` (doc_id, weight) scales the keys: a document of twice the weight is
    twice as likely to come first. Documents without a positive, finite weight there count as 1; of several weights of a doc_id the largest counts.

    Null doc_ids and null sources are values; a null source is a source of its own. Documents without a word are taken
    as often as their source's epochs, which adds nothing. Copies are one row with a count, so a group of
    any size stays one row; only narrow rows are shuffled, and a source of any size is cut into
    ranges of keys. An empty table gives no rows; extra columns are ignored.
    """
    scratch, passing = Scratch(docs.sparkSession), Scratch(docs.sparkSession)
    sized = docs.select(_draw(seed).alias("draw"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"))
    groups = passing.save(sized.groupBy("draw", "doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies")))
    sources = scratch.save(source_targets(groups.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size")), weights, share, most, passing))
    weighed = groups.withColumn("weight", F.lit(1.0))
    if quality is not None:
        given = quality.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("weight").cast("double").alias("weight"))
        given = given.where((F.col("weight") > 0) & (F.col("weight") < float("inf")) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("weight").alias("weight"))
        # Rows without a doc_id have no match and need no place in the join.
        some = groups.where("doc_id is not null").join(given, "doc_id", "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
        weighed = some.unionByName(weighed.where("doc_id is null"))
    uniform = (F.conv(F.substring("draw", 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))
    keyed = weighed.withColumn("key", -F.log(uniform) / F.col("weight")).drop("weight")
    ordered = running(keyed, F.struct("key", "draw"), F.col("size") * F.col("copies"), F.col("source"), scratch=scratch)
    passing.keep()
    own = sources.select(F.col("source").alias("_source"), "source_size", "target")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    placed = ordered.join(own, F.col("source").eqNullSafe(F.col("_source"))).withColumn("epochs", whole)
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    # The k-th copy is taken if the sum without it and the sum with it, together, stay below twice the rest.
    fits = F.floor((rest - F.col("before")) / F.col("size") + 0.5)
    extra = F.when(F.col("size") > 0, F.greatest(F.lit(0), F.least(F.col("copies"), fits))).otherwise(0).cast("long")
    return placed.select("draw", "doc_id", "source", "size", "copies", "source_size", "target", "epochs", extra.alias("extra"))


def taken_words(plan: DataFrame) -> DataFrame:
    """One row for each row of the documents that ``plan`` was made of: doc_id, size, source_size, target, taken.

    A group of very many copies is cut into chunks that are dealt out before they become rows.
    """
    last = F.greatest(F.ceil(F.col("copies") / _CHUNK) - 1, F.lit(0))
    chunks = plan.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), last))).repartition("draw", "chunk")
    first = F.col("chunk") * _CHUNK
    numbers = F.sequence(first + 1, F.least(first + _CHUNK, F.col("copies")))
    rows = chunks.withColumn("k", F.explode(numbers))
    times = F.col("epochs") + (F.col("k") <= F.col("extra")).cast("long")
    return rows.select("doc_id", "size", "source_size", "target", (times * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, plan: DataFrame, seed: int = 11) -> DataFrame:
    """The documents of the mix: a row of ``docs`` for each distinct (doc_id, text, source) that it takes, with ``times`` (replaced if there).

    ``times`` counts the repeats, over all copies of the row; which of rows that agree in the three columns stands for them isn't fixed.
    """
    columns = [c for c in docs.columns if c.lower() != "times"]
    rows = docs.select(_draw(seed).alias("draw"), F.col("source").cast("string").alias("source"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")).dropDuplicates(["draw", "source"])
    times = plan.select(F.col("draw").alias("_draw"), F.col("source").alias("_source"), (F.col("epochs") * F.col("copies") + F.col("extra")).alias("times")).where("times > 0")
    return rows.join(times, (F.col("draw") == F.col("_draw")) & F.col("source").eqNullSafe(F.col("_source"))).select("row.*", "times")
