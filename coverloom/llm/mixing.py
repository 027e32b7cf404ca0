"""Mixing sources to target weights, in DataFrame functions only.

Every document gets a random key from a hash of its id and text. The keys are uniform, so
equal slices of the key range sort a source by range without a sample: a slice holds a bounded
number of rows however large its source is. Word totals per slice are added up first, prefix
sums over those totals give each slice its offset, and a window inside the slice finishes the
prefix sum. The source is then cut at its exact budget, after as many whole epochs as the
budget holds.

Defined results: a null text has size 0 and is never taken; a null source is a source of its
own and comes last; repeated rows (same id, text and source) follow each other in the order
and are summed before they are sorted; an empty table gives an empty result. Other columns
are not read and may have any names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coverloom.llm.common import id_text, settle, text_of, word_count

WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
ROWS_PER_SLICE = 5_000

_SOURCE = ["src", "unnamed"]


def _units(docs: DataFrame) -> DataFrame:
    """One row per distinct document row with its number of copies."""
    key = F.md5(F.concat_ws("|", id_text(), F.md5(text_of().cast("binary"))).cast("binary"))
    rows = docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("src"), F.isnull("source").alias("unnamed"),
        key.alias("mix_key"), word_count().alias("size"),
    )
    return rows.groupBy("doc_id", *_SOURCE, "mix_key", "size").agg(F.count("*").alias("copies"))


def source_budgets(units: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """Target words per source: weights repeat over the sources in code-point order, null
    last, and share all words; a target stops at ``most_epochs`` times its source and the
    excess goes to the others by weight.

    The shares are those of one level: target = least(limit, level * weight). With the sources
    in order of limit / weight, the level for a given number of stopped sources first rises
    and then falls, and its top is the one that uses up all words. The windows run over one
    row per source.
    """
    by_name = Window.orderBy("unnamed", "src")
    by_limit = Window.orderBy("ratio", "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    sized = units.groupBy(*_SOURCE).agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    ranked = (
        sized.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", weight.cast("long"))
        .withColumn("most", F.col("source_size") * most_epochs)
        .withColumn("ratio", F.col("most").cast("double") / F.col("weight"))
    )
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    stopped, passed = F.coalesce(F.sum("most").over(before), F.lit(0)), F.coalesce(F.sum("weight").over(before), F.lit(0))
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    words, all_weights = F.sum("source_size").over(everything), F.sum("weight").over(everything)
    levels = ranked.withColumn("level", (words - stopped).cast("double") / (all_weights - passed).cast("double"))
    target = F.least(F.col("most").cast("double"), F.max("level").over(everything) * F.col("weight"))
    return levels.withColumn("target", target).select(*_SOURCE, "source_size", "target")


def plan_mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: one row per row of ``docs``.

    ``taken`` counts the words the mix takes of the document, repeats included. The one
    document on which the budget ends is taken in part, so that the taken words of a source
    add up to its rounded target.
    """
    units = settle(_units(docs), "mix-units")
    slices = -(-max(units.count(), 1) // rows_per_slice)
    share = F.conv(F.substring("mix_key", 1, 13), 16, 10).cast("double") / float(16**13)
    units = units.withColumn("slice", F.floor(share * slices)).withColumn("words", F.col("size") * F.col("copies"))

    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.expr(f"least(budget div source_size, {most_epochs})")).otherwise(F.lit(0))
    budgets = source_budgets(units, weights, most_epochs).withColumn("budget", budget).withColumn("epochs", epochs)
    in_source = Window.partitionBy(*_SOURCE).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        units.groupBy(*_SOURCE, "slice").agg(F.sum("words").alias("slice_words"))
        .withColumn("offset", F.coalesce(F.sum("slice_words").over(in_source), F.lit(0)))
        .join(budgets, _SOURCE)
        .withColumn("rest", F.expr("budget - epochs * source_size"))
    )
    in_slice = (
        Window.partitionBy(*_SOURCE, "slice").orderBy("mix_key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = units.withColumn("before", F.coalesce(F.sum("words").over(in_slice), F.lit(0))).join(offsets, [*_SOURCE, "slice"])
    rows = placed.withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)")))
    last_epoch = F.expr("least(size, greatest(0L, rest - offset - before - copy * size))")
    return rows.select(
        "doc_id", F.when(~F.col("unnamed"), F.col("src")).alias("source"), "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + last_epoch).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with all their columns, each as often as the
    mix reads it; the document on which a budget ends is kept whole. Rows that agree in
    doc_id, source and size are taken alike."""
    taken = (
        plan_mix(docs, weights, most_epochs).filter("taken > 0").groupBy("doc_id", "source", "size")
        .agg(F.expr("ceil(sum(taken) / (count(*) * size))").cast("int").alias("mix_times"))
        .select(F.struct("doc_id", "source", "size").alias("mix_row"), "mix_times")
    )
    columns = [F.col(f"`{c}`") for c in docs.columns]
    row = F.struct("doc_id", "source", word_count().alias("size"))
    keyed = docs.select(F.struct(*columns).alias("mix_doc"), row.alias("mix_row"))
    return keyed.join(taken, "mix_row").select(
        "mix_doc", F.explode(F.expr("sequence(1, mix_times)")).alias("mix_time")
    ).select("mix_doc.*")
