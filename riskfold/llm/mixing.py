"""Mixing sources to target weights with a low-discrepancy schedule.

The documents of a source, shuffled by a hash, form one stream of words that
is read up to twice; the stream is cut into blocks of equal word counts.  A
van der Corput sequence gives the order: slot ``k`` is the point
``reverse(bits of k)``, which the cumulative block counts map to a source.
The slots of a source are ranked, and slot rank ``j`` takes block ``j``.
Any stretch of the schedule has each source in proportion to its target, up
to a few blocks.

The points of ``2**m >= N`` slots cover every one of the ``N`` tickets (a
ticket is one block's share of the cumulative range) at least once, so every
source gets at least its blocks; slots beyond its last block stay empty.  So
each source gives exactly its target, rounded to words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfold.llm.tables import ROW, free_name, totals_before, with_row_ids, written

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Words the mix takes, as a share of all words, and of a source at most.
BUDGET = 1.5
MOST = 2
BLOCK_WORDS = 256
#: Blocks are doubled in size until the schedule has at most this many.
MOST_BLOCKS = 2**30
#: Ranges of a source's shuffled order and of the schedule; windows span one range.
ORDER_HEX = 3
SLOT_RANGES = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget=BUDGET, most=MOST) -> DataFrame:
    """``source, source_size`` to ``source, source_size, rank, target``.

    Sources by code point, null last, get ``weights`` in turn.  The budget is
    shared by weight; a target stops at ``most`` times its source's size, and
    the excess goes to the others by weight until none is above.  With the
    sources ordered by ``cap / weight``, those below the water level ``w`` are
    full: the level is ``(budget - caps before) / weights from here on`` at
    the first source that it does not fill.
    """
    each = F.array(*[F.lit(float(w)) for w in weights])
    named = totals_before(
        sizes, [F.col("source").asc_nulls_last()], {"rank": F.lit(1)}, "mix-sources"
    ).select(
        "*",
        F.element_at(each, (F.col("rank") % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * most).alias("cap"),
    )
    ordered = written(totals_before(
        named, [(F.col("cap") / F.col("weight")).asc(), F.col("rank").asc()],
        {"caps": F.col("cap"), "weights": F.col("weight")}, "mix-levels",
    ), "mix-level")
    whole = ordered.agg(F.sum("cap").alias("all_caps"), F.sum("weight").alias("all_weights"))
    level = ordered.crossJoin(F.broadcast(whole)).select(  # one row
        "rank", "cap", "weight", "caps",
        ((F.col("all_caps") / most * budget - F.col("caps")) / (F.col("all_weights") - F.col("weights"))).alias("level"),
    ).where(F.col("level") <= F.col("cap") / F.col("weight"))
    level = level.agg(F.min_by("level", F.struct(F.col("cap") / F.col("weight"), F.col("rank"))).alias("level"))
    return ordered.crossJoin(F.broadcast(level)).select(  # one row
        "source", "source_size", "rank",
        F.when(F.col("level").isNull(), F.col("cap").cast("double"))
        .otherwise(F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))).alias("target"),
    )


def schedule(sources: DataFrame, n_blocks: int, n_sources: int) -> DataFrame:
    """``slot, rank, block``: the van der Corput schedule over ``rank, first, blocks``.

    ``first`` is the sum of the blocks of all sources before.
    """
    spark = sources.sparkSession
    bits = max(1, (n_blocks - 1).bit_length())
    reverse = F.conv(F.reverse(F.lpad(F.bin("slot"), bits, "0")), 2, 10).cast("long")
    slots = spark.range(2**bits).select(F.col("id").alias("slot")).select(
        "slot", F.shiftright(reverse * n_blocks, bits).alias("ticket")
    )
    # tickets meet their source in steps, of which there are as many as sources or more
    step = max(1, n_blocks // max(4096, n_sources))
    ranges = sources.where("blocks > 0").select(
        "rank", "first", "blocks",
        F.explode(F.sequence(F.floor(F.col("first") / step), F.floor((F.col("first") + F.col("blocks") - 1) / step))).alias("step"),
    )
    dealt = slots.withColumn("step", F.floor(F.col("ticket") / step)).join(ranges, "step").where(
        "ticket >= first and ticket < first + blocks"
    ).select("slot", "rank", F.floor(F.col("slot") * SLOT_RANGES / F.lit(2**bits)).alias("range"))
    before = Window.partitionBy("rank").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("rank", "range").agg(F.count(F.lit(1)).alias("n")).select(
        "rank", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")
    )
    within = Window.partitionBy("rank", "range").orderBy("slot")
    return dealt.join(counts, ["rank", "range"]).select(
        "slot", "rank", (F.col("ahead") + F.row_number().over(within) - 1).alias("block")
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights=WEIGHTS, budget: float = BUDGET, most: int = MOST, block_words: int = BLOCK_WORDS, seed: str = "mix",
    row_col: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The sized documents and the mix.

    Sized: ``__row`` (unique; ``row_col`` if given), ``id``, ``source``, ``size`` (words), and the
    source's ``source_size`` and ``target``.  Mix: a row for each stretch of a
    document in a block: ``slot, epoch, __row, from_word, words``; ordered by
    slot this is the training order.

    A null text has no words, a null source is a source, a null id is an id
    like any other; documents without words and empty tables give no stretch.
    Repeated rows are documents of their own.  Only the named columns are read.
    """
    sized = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        *([F.col(row_col).alias(ROW)] if row_col else []),
    )
    sized = written(sized, "mix-sizes") if row_col else with_row_ids(sized, "mix-sizes")
    targets = written(source_targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, budget, most
    ), "mix-targets")
    both = targets.agg(F.sum("target").alias("words"), F.count(F.lit(1)).alias("sources")).first()
    while (both["words"] or 0) / block_words + (both["sources"] or 0) > MOST_BLOCKS:
        block_words *= 2
    cut = targets.select(
        "source", "source_size", "rank", "target", F.floor(F.col("target") + 0.5).alias("take"),
    ).withColumn("blocks", F.ceil(F.col("take") / block_words))
    cut = written(totals_before(cut, [F.col("rank").asc()], {"first": F.col("blocks")}, "mix-first"), "mix-cut")
    n_blocks = cut.agg(F.sum("blocks")).first()[0] or 0

    full = sized.join(cut, sized["source"].eqNullSafe(cut["source"])).drop(cut["source"])
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    full = full.withColumn("order", order).withColumn("range", F.substring("order", 1, ORDER_HEX))
    ahead = Window.partitionBy("rank").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = full.groupBy("rank", "range").agg(F.sum("size").alias("n")).select(
        "rank", "range", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead")
    )
    within = Window.partitionBy("rank", "range").orderBy("order", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = full.join(offsets, ["rank", "range"]).withColumn(
        "start", F.col("ahead") + F.coalesce(F.sum("size").over(within), F.lit(0))
    )
    epochs = placed.where("size > 0").select(
        ROW, "rank", "size", "take", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("epoch"),
        "source_size", "start",
    ).withColumn("lo", F.col("epoch") * F.col("source_size") + F.col("start")).where("lo < take").withColumn(
        "hi", F.least(F.col("lo") + F.col("size"), F.col("take"))
    )
    pieces = epochs.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("lo") / block_words), F.floor((F.col("hi") - 1) / block_words)
    ))).select(
        ROW, "rank", "epoch", "block",
        (F.greatest("lo", F.col("block") * block_words) - F.col("lo")).alias("from_word"),
        (F.least("hi", (F.col("block") + 1) * block_words) - F.greatest("lo", F.col("block") * block_words)).alias("words"),
    )
    slots = schedule(cut.select("rank", "first", "blocks"), max(1, n_blocks), both["sources"] or 0)
    mixed = slots.join(pieces, ["rank", "block"]).select("slot", "epoch", ROW, "from_word", "words")
    documents = full.select(ROW, "id", "source", "size", "source_size", "target")
    return documents, mixed


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix starts them, whole; all columns are kept.

    A source's last document may be cut in the mix; here it is whole, so a
    source goes over its target by less than a document.  Documents without
    words are in no mix.
    """
    row = free_name(docs, ROW)
    rows = with_row_ids(docs, "mix-rows", row)
    _, mixed = mix(rows, id_col, text_col, source_col, row_col=row, **options)
    started = mixed.where("from_word = 0").groupBy(F.col(ROW).alias(row)).agg(F.count(F.lit(1)).alias("times"))
    times, copy = free_name(docs, "__times"), free_name(docs, "__copy")
    return rows.join(started.withColumnRenamed("times", times), row).withColumn(
        copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))
    ).drop(row, times, copy)
