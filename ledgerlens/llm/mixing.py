"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source wants the same real number of copies, target / size of
its source (0 to 2).  The whole part is given at once; the fraction is rounded by the
pivotal method.  Two documents meet, and words move at random from one to the other
until one of them is taken whole or not at all; the other goes on with what is left.
The draw is such that each document keeps its expected copies, and as words move, not
copies, the words of a source stay what they were but for the last document's.

Documents meet others of similar size: they are dealt into blocks by source, size
class and a hash.  What a block leaves over, one document at most, meets the leftovers
of the next blocks on the level above, FAN at a time, up to one for each class and then,
from large to small, one for each source.  So no task folds more than a few hundred rows
however large the source, and the levels are the logarithm of the rows to the base FAN.

Masses are whole numbers of 2**-20 words, draws are hashes of the two documents: reruns agree.

Rows equal in source, doc_id and text are one unit with a count: the whole part of count * fraction is spread over as many of
them, one copy each, and only the rest is drawn, so however many rows are equal, they are one row of the draw
and their words stay near their share.  Units are spread into rows again in chunks of CHUNK.

Defined results: size counts runs other than space, tab, \\n, \\v, \\f, \\r; a null or empty text
has size 0 and takes 0 words; null is a source of its own, last in order; the same doc_id and text under two sources are
two documents; no row is taken more than CAP times; very long texts are counted whole; an empty table gives an empty
result; extra columns are ignored by ``mix``; ``mixed_documents`` returns all columns, those of one of the rows for equal ones.  The one window without
a key ranks sources, one row each, never documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2
FAN = 64
CHUNK = 10_000
_WORD = 1 << 20
_CLASSES = 4  # size classes for each doubling of the size


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, rank, target from rows (source, source_size).

    Sharing by weight under caps, the excess shared again, ends where one level holds for all
    sources: target = least(cap, level * weight).  With sources in order of cap / weight the
    level is that of the first one whose share of what remains doesn't pass its cap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("rank", F.row_number().over(by_name).cast("int"))
    weight = F.element_at(F.array(*[F.lit(x) for x in WEIGHTS]), (F.col("rank") - 1) % len(WEIGHTS) + 1)
    w = (w.withColumn("weight", weight).withColumn("cap", F.col("source_size") * CAP)
         .withColumn("ratio", F.col("cap") / F.col("weight")))
    everyone = Window.partitionBy()
    before = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy("ratio", "rank").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    w = w.withColumn("level", (F.sum("source_size").over(everyone) * F.lit(SHARE)
                               - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward))
    first = F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level"))
    w = w.withColumn("level", F.min(first).over(everyone)["level"])
    return w.select("source", "source_size", "rank",
                    F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def _uniform(a: Column, b: Column, below: Column) -> Column:
    """A whole number from 0 to below - 1, fixed by the two documents."""
    return F.pmod(F.xxhash64(F.lit("draw"), a, b), F.greatest(below, F.lit(1).cast("long")))


def _fold(items: Column) -> Column:
    """Pivotal rounding along an array of (unit, size, mass): the document that is left, and the winners."""
    def state(unit: Column, size: Column, mass: Column, won: Column) -> Column:
        return F.struct(unit.alias("unit"), size.alias("size"), mass.alias("mass"), won.alias("won"))

    start = state(F.lit(None).cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long"), F.array().cast("array<long>"))

    def step(a: Column, b: Column) -> Column:
        # Words that a can take over from b, and b from a, until one is full or empty.
        to_a = F.least(a["size"] * _WORD - a["mass"], b["mass"])
        to_b = F.least(b["size"] * _WORD - b["mass"], a["mass"])
        up = _uniform(a["unit"], b["unit"], to_a + to_b) < to_b
        a_full, a_empty = to_a < b["mass"], to_b == a["mass"]
        ends_a = F.when(up, a_full).otherwise(a_empty)  # a is settled and b goes on
        taken = F.when(up & a_full, a["unit"]).when(~up & ~a_empty, b["unit"])
        left = F.when(up & a_full, b["mass"] - to_a).when(up, a["mass"] + to_a).when(a_empty, b["mass"] + to_b).otherwise(
            a["mass"] - to_b)
        nxt = state(F.when(ends_a, b["unit"]).otherwise(a["unit"]), F.when(ends_a, b["size"]).otherwise(a["size"]), left,
                    F.when(taken.isNotNull(), F.concat(a["won"], F.array(taken))).otherwise(a["won"]))
        return F.when(a["unit"].isNull(), state(b["unit"], b["size"], b["mass"], a["won"])).otherwise(nxt)
    return F.aggregate(items, start, step)


def _level(items: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Fold the rows (unit, size, mass) of each key, from the largest ``order`` down."""
    rows = F.struct(F.col(order).alias("first"), "size", "unit", "mass")
    folded = items.groupBy(*keys).agg(F.sort_array(F.collect_list(rows), asc=False).alias("items"))
    return folded.select(*keys, _fold(F.col("items")).alias("f")).select(*keys, "f.unit", "f.size", "f.mass", "f.won")


def draw(sized: DataFrame) -> DataFrame:
    """unit, extra (1) for each document that the rounding of fractions takes.

    ``sized`` has unit, rank, class, size, mass, blocks (the number of blocks of its rank and class).
    """
    items = sized.select("rank", "class", "size", "unit", "mass",
                         F.pmod(F.xxhash64(F.lit("block"), "unit"), F.col("blocks")).alias("block"))
    most = sized.agg(F.max("blocks")).first()[0] or 1
    level = materialize(_level(items, ["rank", "class", "block"], "size"), "mix-level")
    levels = [level]
    while most > 1:
        most = -(-most // FAN)
        up = (level.withColumnRenamed("block", "below")
              .withColumn("block", F.floor(F.col("below") / FAN).cast("long")))
        level = materialize(_level(up, ["rank", "class", "block"], "below"), "mix-level")
        levels.append(level)
    last = materialize(_level(level, ["rank"], "class"), "mix-level")
    levels.append(last)
    won = None
    for x in levels:
        part = x.select(F.explode("won").alias("unit"))
        won = part if won is None else won.union(part)
    rest = last.where(_uniform(F.col("unit"), F.lit(0), F.col("size") * _WORD) < F.col("mass")).select("unit")
    return won.union(rest).distinct().withColumn("extra", F.lit(1))


def _unit(source: str, doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(source), F.col(doc_id), F.col(text))


def _numbered(units: DataFrame, count: str, name: str) -> DataFrame:
    """Each row as often as ``count`` says, numbered from 1; large counts are dealt over the tasks in chunks."""
    few = units.where(F.col(count).between(1, CHUNK)).withColumn(name, F.explode(F.sequence(F.lit(1).cast("long"), F.col(count))))
    many = (units.where(F.col(count) > CHUNK)
            .withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / CHUNK))))
            .repartition(F.col("__chunk"))
            .withColumn(name, F.explode(F.sequence(F.col("__chunk") * CHUNK + 1, F.least(F.col(count), (F.col("__chunk") + 1) * CHUNK))))
            .drop("__chunk"))
    return few.unionByName(many)


def mixed_units(documents: DataFrame) -> DataFrame:
    """unit, doc_id, size, n (rows), source_size, target, whole (copies of every row), extra (rows that get one more)."""
    units = (documents.select(F.col("source").alias("source"), F.col("doc_id").alias("doc_id"),
                              _unit("source", "doc_id", "text").alias("unit"), word_count("text").alias("size"))
             .groupBy("source", "doc_id", "unit", "size").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("class", F.when(F.col("size") > 0, F.floor(F.log2("size") * _CLASSES).cast("int")).otherwise(-1)))
    units = materialize(units, "mix-units")
    groups = materialize(units.groupBy("source", "class").agg(F.count(F.lit(1)).alias("units"), F.sum(F.col("size") * F.col("n")).alias("s")),
                         "mix-groups")
    targets = source_targets(groups.groupBy("source").agg(F.sum("s").alias("source_size")))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = (groups.alias("g").join(targets.alias("t"), F.col("g.source").eqNullSafe(F.col("t.source")))
            .select(F.col("g.source").alias("source"), "class", "rank", "source_size", "target",
                    F.ceil(F.col("units") / FAN).alias("blocks"), F.floor(share).cast("long").alias("whole"),
                    (share - F.floor(share)).alias("part")))
    given = F.floor(F.col("part") * F.col("n")).cast("long")
    planned = (units.alias("r").join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source"))
                                     & (F.col("r.class") == F.col("p.class")))
               .select("unit", "doc_id", "size", "n", "r.class", "rank", "source_size", "target", "blocks", "whole",
                       given.alias("given"),
                       F.round((F.col("part") * F.col("n") - given) * F.col("size") * _WORD).cast("long").alias("mass")))
    planned = materialize(planned, "mix-plan")
    won = draw(planned.where("size > 0 and mass > 0")).withColumnRenamed("extra", "won")
    some = F.col("size") > 0
    return (planned.join(won.hint("merge"), "unit", "left")
            .select("unit", "doc_id", "size", "n", "source_size", "target", F.when(some, F.col("whole")).otherwise(0).alias("whole"),
                    F.when(some, F.col("given") + F.coalesce("won", F.lit(0))).otherwise(0).alias("extra")))


def mix(documents: DataFrame) -> DataFrame:
    """doc_id, unit, size, source_size, target, copies of every row."""
    rows = _numbered(mixed_units(documents), "n", "__row")
    return rows.select("doc_id", "unit", "size", "source_size", "target",
                       (F.col("whole") + (F.col("__row") <= F.col("extra")).cast("long")).alias("copies"))


def mixed_documents(documents: DataFrame) -> DataFrame:
    """The rows of ``documents``, all columns, each as often as the mix takes it."""
    copies = mixed_units(documents).select(F.col("unit").alias("__unit"), (F.col("n") * F.col("whole") + F.col("extra")).alias("__copies"))
    # Equal rows are one before they move; the join then finds both sides dealt by unit.
    row = F.struct(*[F.col(c).alias(f"c{k}") for k, c in enumerate(documents.columns)])
    one = documents.groupBy(_unit("source", "doc_id", "text").alias("__unit")).agg(F.first(row).alias("__doc"))
    found = one.join(copies.where("__copies > 0").hint("merge"), "__unit")
    return _numbered(found, "__copies", "__copy").select(
        *[F.col(f"__doc.c{k}").alias(c) for k, c in enumerate(documents.columns)])
