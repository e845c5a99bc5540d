"""Mixing sources to target weights: hash-random order, prefix sums and exact budgets per source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sideline.functions.lineage import written
from sideline.llm.common import SPACE
from sideline.operators.ranking import number_rows

_WIDE = "decimal(38,0)"


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), percent: int = 100, most: int = 3
) -> DataFrame:
    """Target words per source, from rows (no_source, source, size) of any number.

    Sources by code point, the missing one last, take ``weights`` in turn and share ``percent`` of
    all words by weight. A target stops at ``most`` times the words of its source; what is above is
    shared again by weight until no target is above. That end state gives every source below its
    limit the same words per unit of weight, ``a / b``; each round below moves sources over their
    limit out of the sharing, in one aggregate, until none moves. Returns no_source, source,
    source_size, target (double) and want (the whole words of the target).
    """
    per = sizes.groupBy("no_source", "source").agg(F.sum("size").alias("source_size"))
    ranked = number_rows(per, [F.col("no_source").asc(), F.col("source").asc()])
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int") + 1)
    per = written(ranked.withColumn("weight", turn.cast("long")).drop("rank"), "sources")
    limit = F.col("source_size").cast(_WIDE) * most

    def over(a: int, b: int) -> Column:
        return F.col("weight").cast(_WIDE) * F.lit(a).cast(_WIDE) > limit * F.lit(b).cast(_WIDE)

    total, b = per.agg(F.sum("source_size"), F.sum("weight")).first()
    a = budget = (total or 0) * percent // 100
    b = b or 1
    while True:
        held, rest = per.agg(
            F.sum(F.when(over(a, b), limit)), F.sum(F.when(~over(a, b), F.col("weight")))
        ).first()
        new = (budget - int(held or 0), rest)
        if not rest or new == (a, b):
            break
        a, b = new
    # products below 2^53 are exact, so the quotient is the nearest double
    share = (F.col("weight") * F.lit(a)).cast("double") / F.lit(b).cast("double")
    return per.select(
        "no_source", "source", "source_size",
        F.when(over(a, b), limit.cast("double")).otherwise(share).alias("target"),
        F.when(over(a, b), limit.cast("long")).otherwise(F.expr(f"(weight * {a}L) div {b}L")).alias("want"),
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    keep: Sequence[str] = (), weights: Sequence[int] = (5, 2, 1), percent: int = 100, most: int = 3,
) -> DataFrame:
    """How many words of each document the mix takes.

    Documents of a source follow each other in the order of md5(id): a hash-random key, the same on
    every run. The rows are range-split by (source, key), so a source of any size spreads over many
    slices; running sums inside a slice and the sums of the slices before give the words ahead of
    each document. The mix takes the source ``want div source_size`` times as a whole and then its
    documents in order until the target is met; the document at the cut gives its first words only,
    so that a source's words add up to its whole target.

    Returns one row per row of ``docs``: the id, the columns of ``keep``, size, source_size, target
    and taken. Null text has size 0 and is taken 0 words; a null source is a source of its own (the
    last), as is the empty one; rows with a null id are mixed too. Equal rows are interchangeable:
    they stand next to each other and together take what fits. An empty table gives no rows. Only
    the id, the text, the source and ``keep`` are read.
    """
    rows = docs.select(
        *[F.col(c) for c in keep], F.col(id_col).alias("_id_"), F.col(source_col).isNull().alias("no_source"),
        F.coalesce(F.col(source_col), F.lit("")).alias("source"), word_count(F.col(text_col)).alias("size"),
    )
    keyed = rows.withColumn("_key", F.coalesce(F.md5(F.col("_id_").cast("string")), F.lit("")))
    order = ["no_source", "source", "_key", "_id_", "size"]
    sliced = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    # range bounds are sampled: the slices are fixed before they are read twice
    placed = written(sliced.withColumn("_at", F.monotonically_increasing_id()), "mixed")
    placed = placed.withColumn("_slice", F.shiftright("_at", 33))
    by = ["no_source", "source"]
    sums = placed.groupBy(*by, "_slice").agg(F.sum("size").alias("size"))
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*by, "_slice", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("_start"))
    targets = source_targets(sums.select(*by, "size"), weights, percent, most)
    inside = Window.partitionBy(*by, "_slice").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = placed.withColumn("_sum", F.sum("size").over(inside))
    run = run.join(starts.join(targets, by), [*by, "_slice"])
    turns = F.expr("IF(source_size = 0, 0L, want div source_size)")
    rest = F.col("want") - turns * F.col("source_size")
    before = F.col("_start") + F.col("_sum") - F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - before))
    return run.select(
        F.col("_id_").alias(id_col), *keep, "size", "source_size", "target",
        (turns * F.col("size") + part).cast("long").alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    length_col: str | None = "n_chars", **options,
) -> DataFrame:
    """The documents of the mix: each as often as it is taken whole, and the one at a source's cut
    with its first words, up to the end of the last word taken.

    ``docs`` must be a frame whose rows are the same on every read (a stored table): its rows are
    numbered in reading order to bring texts and decisions together, so equal rows stay apart.
    Documents without words are not in the mix. Columns and their order stay; ``length_col``
    follows a cut text.
    """
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    plan = mix(numbered, id_col, text_col, source_col, keep=["_row"], **options)
    copies = plan.filter("taken > 0").select(
        "_row", F.explode(F.expr("transform(sequence(0, int((taken - 1) div size)), i -> least(size, taken - i * size))")).alias("_words"), F.col("size").alias("_size"),
    )
    head = F.expr(f"array_join(slice(regexp_extract_all(`{text_col}`, '[{SPACE}]*[^{SPACE}]+', 0), 1, int(_words)), '')".replace("\\", "\\\\"))
    cut = F.col("_words") < F.col("_size")
    out = numbered.join(copies, "_row").withColumn(text_col, F.when(cut, head).otherwise(F.col(text_col)))
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.when(cut, F.length(text_col).cast(docs.schema[length_col].dataType)).otherwise(F.col(length_col)))
    return out.select(*docs.columns)
