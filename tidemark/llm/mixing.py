"""Mixing sources to target weights: repetition rates per source, hash-seeded copies per document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null or empty text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """One row per source of (source, size): source_size, target and rate = target / source_size.

    Sources in code point order, null last, take `weights` in turn and share `share` times all
    sizes by weight. No target exceeds `most` times its source's size; what is above is shared
    again among the others. With caps c and weights w, ordered by c / w, the level
    (total - caps before) / (weights from here on) grows while sources are capped and falls
    afterwards, so its maximum is the final level and a target is min(c, level * w).

    The windows run over one row per source, after the sizes are summed in every task.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights)) + 1)
    per = per.withColumns({"weight": weight, "cap": F.lit(float(most)) * F.col("source_size")})
    everything = Window.partitionBy()
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    total = F.lit(float(share)) * F.sum("source_size").over(everything)
    capped = F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))
    later = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    per = per.withColumn("level", (total - capped) / later)
    per = per.withColumn(
        "target", F.least("cap", F.max("level").over(everything) * F.col("weight"))
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return per.select("source", "source_size", "target", rate.alias("rate"))


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) fixed by the parts (the first 48 bits of the MD5 of their texts)."""
    texts = [F.coalesce(p.cast("string"), F.lit("null")) for p in parts]
    digest = F.md5(F.concat_ws(":", *texts))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(2**48))


def drawn_targets(sizes: DataFrame, targets: DataFrame, seed: int, draws: int) -> DataFrame:
    """`targets` with the draw, of `draws` numbered ones, that comes nearest to each target.

    A draw decides for every document by its own hash; a few documents of very different sizes can
    miss their target by far in one draw, hardly in the best of many. The sums of all draws are
    added up in every task, one row a source.
    """
    rows = sizes.join(targets, sizes["source"].eqNullSafe(targets["source"]))
    rows = rows.select(targets["source"], "doc_id", "size", (F.col("rate") % 1).alias("part"))

    def words(k: int) -> Column:
        taken = unit_hash(F.lit(seed), F.lit(k), F.col("doc_id")) < F.col("part")
        return F.sum(F.when(taken, F.col("size")).otherwise(F.lit(0)))

    sums = rows.groupBy("source").agg(F.array(*[words(k) for k in range(draws)]).alias("sums"))
    sums = sums.withColumnRenamed("source", "of")
    whole = F.floor("rate") * F.col("source_size")
    missed = F.transform(
        "sums",
        lambda extra, k: F.struct(
            F.abs(whole + extra - F.col("target")).alias("miss"), k.alias("draw")
        ),
    )
    found = targets.join(sums, targets["source"].eqNullSafe(sums["of"]))
    return found.select(*targets.columns, F.array_min(missed)["draw"].alias("draw"))


def copy_plan(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 7,
    draws: int = 32,
) -> DataFrame:
    """(doc: the whole row, size, source_size, target, copies) for each row of (doc_id, text, source).

    A row is taken floor(rate) times, plus once more if its hash falls below the fraction of the
    rate. The hash sees the seed, the source's draw (see drawn_targets) and doc_id, so reruns agree.
    Null texts have size 0 and null sources form a source of their own. Repeated rows share a doc_id
    and so a decision; tied levels go by source. An empty table gives an empty result. Extra columns
    travel inside `doc`, so their names cannot clash.

    Two scans of the texts: the first leaves a table of sizes; what is summed up from it, one row a
    source, is written to the shared folder and read back with a known size, so the planner
    broadcasts it only below its threshold (beyond it, AQE splits a hot source).
    """
    rows = docs.select(F.struct("*").alias("doc"))
    rows = rows.withColumn("size", word_count(F.col("doc.text")))
    sizes = stored(
        rows.select(F.col("doc.doc_id").alias("doc_id"), F.col("doc.source").alias("source"), "size")
    )
    targets = stored(source_targets(sizes, weights, share, most))
    targets = stored(drawn_targets(sizes, targets, seed, draws))
    joined = rows.join(targets, rows["doc.source"].eqNullSafe(targets["source"]))
    whole = F.floor("rate")
    unit = unit_hash(F.lit(seed), F.col("draw"), F.col("doc.doc_id"))
    extra = unit < F.col("rate") % 1
    return joined.select(
        "doc", "size", "source_size", "target", (whole + extra.cast("long")).alias("copies")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, each as often as `copy_plan` says, with the columns of `docs`."""
    plan = copy_plan(docs, **options).filter("copies > 0")
    # one row per copy; the sequence holds no more than ceil(most) entries
    repeated = plan.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return repeated.select("doc.*")
