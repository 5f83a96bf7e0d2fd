"""Mixing sources to target weights by capped water-filling.

A mix of ``share_percent`` of all words is dealt to the sources by weight.  No source gives more than
``max_epochs`` times its words: a target above that is clamped, and its excess is dealt to the
open sources by their weights, until no target is above its cap.  Every round is one aggregate over the
table of sources; the driver holds two numbers (words left, weight left), which are exact integers.

A source's target is then taken as whole repetitions of all its documents (target div size) and one
fractional repetition: its documents in the order of a seeded hash of their ids, up to the words that remain.
The document at the edge gives its first words, so a source's words meet its target to less than the
number of rows that tie there.  The edge is found without sorting a source in one task: words by the
first 12 bits of the hash, then by the next 12 bits inside the bucket of the edge, then by
(hash, size) inside that bucket.  Each step is a partial aggregate, so a source may hold any share of the rows.

Weights repeat along the sources in code-point order, null last, or come from a table ``(source, weight)``.

Defined cases: a word is ``[^\\x20\\x09-\\x0D]+``; null and empty texts have size 0 and are taken 0 times;
a null source is a source of its own; null ids hash as ``null``; rows that share id and size tie: at the
edge each takes an equal whole number of words; very long texts count like others (the edge may cut them); a mix
that all caps together can't fill clamps every source; sources missing in a weight table weigh 0 and give nothing;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeway.llm.common import WORD_PATTERN
from ridgeway.llm.graph import join_hot, store

WEIGHTS, SHARE_PERCENT, MAX_EPOCHS, SEED = (3, 1, 2), 150, 2, 1
_HASH_BITS, _STEP_BITS = 60, 12
_WIDE = "decimal(38,0)"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def seeded_hash(id_col: Column, seed: int) -> Column:
    """60 bits of md5 of ``<seed>:<id>``, as a long."""
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(told.cast("binary")), 1, 15), 16, 10).cast("long")


def _key(source: Column) -> Column:
    """The source as a value that is never null."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def _before(order, by="key") -> Column:
    """Words before a row among those of its source."""
    window = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("words").over(window), F.lit(0))


def source_table(sized: DataFrame, weights: Sequence[int] | DataFrame, max_epochs: int) -> DataFrame:
    """(key, source_size, cap, weight) per source.  Ranks come from a distributed sort: rank inside the
    task, plus the rows of the tasks before it."""
    sums = sized.groupBy("key").agg(F.sum("size").alias("source_size"))
    if isinstance(weights, DataFrame):
        told = weights.groupBy(_key(F.col("source")).alias("key")).agg(F.max("weight").cast("long").alias("weight"))
        ranked = sums.join(told, "key", "left").select("key", "source_size", F.coalesce("weight", F.lit(0)).alias("weight"))
        return store(ranked.withColumn("cap", F.col("source_size") * max_epochs), "sources")
    ordered = sums.orderBy(F.col("key") == "n", "key").withColumn("at", F.monotonically_increasing_id())
    ordered = store(ordered, "sources").withColumn("task", F.shiftright("at", 33))
    tasks = ordered.groupBy("task").agg(F.count("*").alias("rows"))   # one row a task of the sort
    tasks = tasks.select("task", F.coalesce(F.sum("rows").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    rank = F.col("first") + F.col("at").bitwiseAND((1 << 33) - 1)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (rank % len(weights) + 1).cast("int")).cast("long")
    return store(ordered.join(tasks, "task").select("key", "source_size", weight.alias("weight"), (F.col("source_size") * max_epochs).alias("cap")), "weights")


def water_level(sources: DataFrame, share_percent: int) -> tuple[int, int]:
    """(a, b): an open source's target is weight * a / b; it is clamped where that is above its cap.
    b is 0 where every source is clamped."""
    total = int(sources.agg(F.sum("source_size")).first()[0] or 0)
    full = int(sources.agg(F.sum("weight")).first()[0] or 0)
    a, b = share_percent * total, 100 * full
    while b:
        clamped = _above(a, b)
        row = sources.agg(F.sum(F.when(clamped, F.col("cap").cast(_WIDE))), F.sum(F.when(~clamped, F.col("weight").cast(_WIDE)))).first()
        level = share_percent * total - 100 * int(row[0] or 0), 100 * int(row[1] or 0)
        if level == (a, b):
            break
        a, b = level
    return a, b


def _wide(n: int) -> Column:
    return F.lit(str(n)).cast(_WIDE)


def _above(a: int, b: int) -> Column:
    """weight * a / b > cap, in whole numbers; always, where no weight is left."""
    return F.col("cap").cast(_WIDE) * _wide(b) < F.col("weight").cast(_WIDE) * _wide(a) if b else F.lit(True)


def targets(sources: DataFrame, share_percent: int) -> DataFrame:
    """The sources with ``target`` (double), whole repetitions ``whole`` and the words ``rest`` of the fractional one."""
    a, b = water_level(sources, share_percent)
    clamped, cap = _above(a, b), F.col("cap")
    share = F.col("weight").cast(_WIDE) * _wide(a)
    exact = F.when(clamped, cap.cast("double")).otherwise(share.cast("double") / F.lit(float(b or 1)))
    least = F.when(clamped, cap).otherwise(F.expr(f"cast(weight as {_WIDE}) * cast('{a}' as {_WIDE}) div cast('{b or 1}' as {_WIDE})"))
    some = F.col("source_size") > 0
    out = sources.select("key", "source_size", exact.alias("target"), least.alias("aim"))
    whole = F.when(some, F.expr("aim div source_size")).otherwise(F.lit(0)).cast("long")
    return out.withColumn("whole", whole).withColumn("rest", F.when(some, F.col("aim") - F.col("whole") * F.col("source_size")).otherwise(F.lit(0)).cast("long"))


def edges(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source with a fractional repetition: (edge_hash, edge_size, edge_words): rows below (hash, size) are taken
    whole, rows at it give ``edge_words`` words each."""
    at = goals.where("rest > 0").select("key", "rest")
    rows, found = sized.where("size > 0"), ["key"]
    for step in (1, 2):
        digit = F.shiftright("hash", _HASH_BITS - step * _STEP_BITS).bitwiseAND((1 << _STEP_BITS) - 1).alias(f"d{step}")
        rows = rows.select("*", digit)
        near = rows if step == 1 else rows.join(at.select(*found), found)
        sums = near.groupBy(*found, f"d{step}").agg(F.sum("size").alias("words"))
        sums = sums.withColumn("before", _before([f"d{step}"])).join(at, found)
        at = sums.where("before < rest and rest <= before + words").select(*found, f"d{step}", (F.col("rest") - F.col("before")).alias("rest"))
        found = [*found, f"d{step}"]
    ties = rows.join(at, found).groupBy("key", "hash", "size").agg(F.count("*").alias("n"), F.first("rest").alias("rest"), (F.count("*") * F.col("size")).alias("words"))
    ties = ties.withColumn("before", _before(["hash", "size"])).where("before < rest and rest <= before + words")
    return ties.select("key", F.col("hash").alias("edge_hash"), F.col("size").alias("edge_size"), F.expr("(rest - before) div n").alias("edge_words"))


def mix(docs: DataFrame, *, weights: Sequence[int] | DataFrame = WEIGHTS, share_percent: int = SHARE_PERCENT, max_epochs: int = MAX_EPOCHS,
        seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: Sequence[str] = ()) -> DataFrame:
    """Per row: id, ``carry`` columns, size, source_size, target, taken (words), whole (repetitions of the whole text) and
    part (words of one more, 0 to size)."""
    own = docs.select(F.col(f"`{id_col}`").alias("id"), *[F.col(f"`{c}`").alias(f"carry_{k}") for k, c in enumerate(carry)],
                      _key(F.col(f"`{source_col}`")).alias("key"), words(F.col(f"`{text_col}`")).alias("size"), seeded_hash(F.col(f"`{id_col}`"), seed).alias("hash"))
    sized = store(own.select("id", "key", "size", "hash"), "sized")
    goals = store(targets(source_table(sized, weights, max_epochs), share_percent), "targets")
    cut = goals.join(edges(sized, goals), "key", "left").select("key", "source_size", "target", "whole", "edge_hash", "edge_size", "edge_words")
    out = join_hot(own if carry else sized, cut, "key")
    below = (F.col("hash") < F.col("edge_hash")) | ((F.col("hash") == F.col("edge_hash")) & (F.col("size") < F.col("edge_size")))
    level = (F.col("hash") == F.col("edge_hash")) & (F.col("size") == F.col("edge_size"))
    out = out.withColumn("part", F.when(below, F.col("size")).when(level, F.col("edge_words")).otherwise(F.lit(0)).cast("long"))
    return out.select(F.col("id").alias(id_col), *[F.col(f"carry_{k}").alias(c) for k, c in enumerate(carry)], "size", "source_size", "target",
                      (F.col("whole") * F.col("size") + F.col("part")).alias("taken"), "whole", "part")


def repeat(mixed: DataFrame, text_col: str = "text") -> DataFrame:
    """The mix itself, from rows of :func:`mix` that carry the text: one row a repetition, with ``copy`` from 1; a cut
    repetition holds its first words, one space apart."""
    copies = F.col("whole") + (F.col("part") > 0).cast("long")
    rows = mixed.where("taken > 0").select("*", F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias("copy"))
    part = F.array_join(F.slice(F.regexp_extract_all(F.col(text_col), F.lit(WORD_PATTERN), F.lit(0)), F.lit(1), F.greatest(F.col("part"), F.lit(1)).cast("int")), " ")
    cut = (F.col("copy") > F.col("whole")) & (F.col("part") < F.col("size"))
    return rows.withColumn(text_col, F.when(cut, part).otherwise(F.col(text_col)))
