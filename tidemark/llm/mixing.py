"""Mixing sources to target weights by Pareto order sampling.

A document's size is its number of words; a source's target is its weighted part
of all sizes, at most `MOST` times the source's own, what is cut off being shared
among the others by weight. A source whose target is t of its size s takes every
document floor(t / s) times, for certain. What is left, f = t / s - floor(t / s),
is the chance of one copy more. Documents are ranked by

    u / (1 - u)  over  f / (1 - f)

where u is a number between 0 and 1 that follows from the document's id, and are
taken in that order (Pareto sampling) until the words left over are reached, to
the nearest document. Within a source the chances are equal, so the order is
that of u, and chances differ between sources.

The order is never sorted in one place: u is cut into `CELLS` equal cells, words
are summed by source and cell, and the cell where a source reaches its target is
found on these sums, then within that cell among as many finer ones. Only the
documents of the last, finest cell are put in order.

Nulls: a null text has size 0, a null source is a source, last in order; a null
id draws like an id of its own. Documents of one id and size have one rank; where
a source reaches its target among these, as many of them are taken as reach it to
the nearest document. A source whose words are 0 has target 0. Other columns
are kept where the caller asks for them; nothing here runs Python on rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.graph import Steps

RESULT = ("doc_id", "size", "source_size", "target", "taken")
WEIGHTS = (5, 2, 1)
MOST = 3
#: Cells of u at each of the two levels.
CELLS = 4096
#: u is a whole number of so many hex digits.
DIGITS = 13

# Fixed value: characters that separate words.
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: str) -> Column:
    """A whole number below 16**DIGITS that follows from an id."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("long")


def ranked_sources(steps: Steps, sources: DataFrame) -> DataFrame:
    """Sources with `weight`, repeating by code point order, nulls last."""
    ordered = steps.keep(sources.repartitionByRange(F.col("source").asc_nulls_last())
                         .withColumn("part", F.spark_partition_id()))
    within = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    placed = ordered.withColumn("place", F.row_number().over(within) - 1)
    # One row for each part of the range partitioning.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ordered.groupBy("part").agg(F.count("*").alias("n")).withColumn(
        "start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    rank = F.col("place") + F.col("start")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank % len(WEIGHTS) + 1).cast("int"))
    return placed.join(starts.select("part", "start"), "part").select("source", "source_size", weight.alias("weight"))


def with_targets(steps: Steps, sources: DataFrame) -> DataFrame:
    """Sources with `target`: weights times one level, or `MOST` times the own size."""
    weighted = steps.keep(ranked_sources(steps, sources))
    ceiling = F.col("source_size") * MOST
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    level, full = None, F.lit(False)
    while True:  # each turn fills at least one more source, so it ends
        row = weighted.agg(
            F.sum(F.when(full, ceiling).otherwise(0)).alias("filled"),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("weights"),
            F.count(F.when(full, 1)).alias("n")).first()
        if level is not None and row["n"] == count:
            break
        count = row["n"]
        if not row["weights"]:
            break
        level = (total - row["filled"]) / row["weights"]
        full = F.col("weight") * F.lit(level) > ceiling
    target = F.least(F.col("weight") * F.lit(level or 0.0), ceiling.cast("double"))
    return weighted.withColumn("target", target)


def mix(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document, and the columns to keep.

    A column to keep that is called like one of these is left out.
    """
    steps = Steps(docs.sparkSession, "mixing")
    base = [F.col("doc_id"), F.col("source"), size_of("text").alias("size"), draw("doc_id").alias("u")]
    sized = steps.keep(docs.select(*base))
    keep = tuple(c for c in keep if c not in RESULT)
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = with_targets(steps, sources)
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("copies", copies.cast("long")).withColumn(
        "left", F.col("target") - F.col("copies") * F.col("source_size"))
    targets = steps.keep(targets)
    width = 16**DIGITS // CELLS
    coarse = (F.col("u") / F.lit(width)).cast("int")
    fine = ((F.col("u") % F.lit(width)) / F.lit(width // CELLS)).cast("int")
    celled = sized.withColumn("coarse", coarse).withColumn("fine", fine)
    # Texts are read again rather than stored with the sizes.
    answered = (docs.select(*base, F.struct(*keep).alias("kept")) if keep else sized).withColumn(
        "coarse", coarse).withColumn("fine", fine)
    found = _cut(celled, targets, "coarse")
    found = _cut(_joined(celled, found.select("source", F.col("coarse").alias("edge"))).where("coarse = edge"),
                 found, "fine")
    found = steps.keep(found.select("source", "source_size", "target", "copies", F.col("left"),
                                    F.col("coarse").alias("edge"), F.col("fine").alias("fine_edge")))
    # The ranks of the finest cell, in order, until what is left is reached to the nearest document. A rank with
    # `many` equal documents counts once; of the last one that fits, `some` documents do.
    rank = ("u", "doc_id", "size")
    ranks = _joined(celled, found).where("coarse = edge and fine = fine_edge").groupBy("source", "left", *rank).agg(
        F.count("*").alias("many"))
    whole = F.col("size") * F.col("many")
    last = ranks.withColumn("before", F.sum(whole).over(
        Window.partitionBy("source").orderBy(*rank).rowsBetween(Window.unboundedPreceding, 0)) - whole)
    room = F.col("left") - F.col("before")
    fits = F.when(F.col("size") == 0, F.col("many")).otherwise(
        F.least(F.floor(room / F.col("size") + 0.5), F.col("many")))
    ends = last.where(room >= F.col("size") / 2).groupBy("source").agg(
        F.max(F.struct(*rank, fits.alias("some"), "many")).alias("last")).select(
        "source", F.struct(*(F.col(f"last.{c}").alias(c) for c in rank)).alias("end"), "last.some", "last.many")
    found = steps.keep(_joined(found, ends))
    placed = _joined(answered, found).withColumn("rank", F.struct(*rank))
    at_edge = F.coalesce((F.col("coarse") == F.col("edge")) & (F.col("fine") == F.col("fine_edge")), F.lit(False))
    split = at_edge & F.coalesce(F.col("rank").eqNullSafe(F.col("end")) & (F.col("some") < F.col("many")), F.lit(False))
    before = F.coalesce((F.col("coarse") < F.col("edge")) | ((F.col("coarse") == F.col("edge")) & (
        (F.col("fine") < F.col("fine_edge")) | (at_edge & F.coalesce(F.col("rank") <= F.col("end"), F.lit(False))))),
        F.lit(False))

    def taken(rows: DataFrame, chosen: Column) -> DataFrame:
        more = F.when(chosen & (F.col("target") > F.col("copies") * F.col("source_size")), 1).otherwise(0)
        return rows.select(
            "doc_id", "size", "source_size", "target", (F.col("size") * (F.col("copies") + more)).alias("taken"),
            *(F.col("kept").getField(c).alias(c) for c in keep))

    if not found.where("some < many").head(1):
        return taken(placed, before)
    # Equal documents of a rank that fits in part are written, so that a number of each holds, and counted by task.
    equal = steps.keep(placed.where(split).withColumn("number", F.monotonically_increasing_id()))
    part = F.shiftright("number", 33)
    counts = equal.groupBy("source", part.alias("part")).agg(F.count("*").alias("n"))
    ahead = counts.select(F.col("source").alias("of"), "part", (F.sum("n").over(
        Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias(
        "ahead"))
    within = F.row_number().over(Window.partitionBy("source", "part").orderBy("number"))
    numbered = equal.withColumn("part", part).withColumn("within", within).join(
        ahead.withColumnRenamed("part", "its"),
        F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("its")))
    return taken(placed.where(~split), before).unionByName(
        taken(numbered, F.col("ahead") + F.col("within") <= F.col("some")))


def _joined(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with the columns of their source, null being a source."""
    named = sources.withColumnRenamed("source", "of")
    return rows.join(named, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")


def _cut(celled: DataFrame, targets: DataFrame, cell: str) -> DataFrame:
    """Sources with the cell in which they reach `left`, and what is left on entering it."""
    sums = celled.groupBy("source", cell).agg(F.sum("size").alias("words"))
    # At most CELLS rows for each source.
    upto = F.sum("words").over(Window.partitionBy("source").orderBy(cell).rowsBetween(
        Window.unboundedPreceding, 0))
    edges = (_joined(sums.withColumn("upto", upto), targets.select("source", "left"))
             .where(F.col("upto") - F.col("words") <= F.col("left"))
             .groupBy("source").agg(F.max(F.struct(cell, (F.col("upto") - F.col("words")).alias("before"))).alias("at")))
    return _joined(targets, edges.select("source", F.col(f"at.{cell}").alias(cell), "at.before")).withColumn(
        "left", F.col("left") - F.coalesce("before", F.lit(0))).drop("before")


# The same result in SQL: the level of the targets is that of the first source, by ceiling per weight,
# that the level of all after it does not fill; documents are taken in the order of u.
ORACLE = """
    WITH sized AS (
        SELECT doc_id, source,
               len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
               ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT AS u
        FROM documents),
    weighted AS (
        SELECT source, source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
        FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)),
    leveled AS (
        SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
                  / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
        FROM weighted
        WINDOW before AS (ORDER BY 3.0 * source_size / weight, source
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    chosen AS (
        SELECT arg_min(level, 3.0 * source_size / weight) AS level FROM leveled
        WHERE weight * level <= 3 * source_size),
    targets AS (
        SELECT source, source_size, least(weight * level, (3 * source_size)::DOUBLE) AS target
        FROM weighted, chosen),
    parts AS (
        SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies
        FROM targets),
    ordered AS (
        SELECT s.*, p.source_size, p.target, p.copies, p.target - p.copies * p.source_size AS rest,
               sum(size) OVER (PARTITION BY s.source ORDER BY u, doc_id, size
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
        FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source)
    SELECT doc_id, size, source_size, target,
           (size * (copies + CASE WHEN rest > 0 AND upto - size / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
    FROM ordered
"""
