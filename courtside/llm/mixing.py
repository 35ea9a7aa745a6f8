"""Mixing sources to target weights: a Pfair schedule of source blocks, with DataFrame functions only.

Each source's rows, in the order of a hash of their id, are cut into blocks. With integer weights w of sum W, block k of a source is
released at slot floor(k W / w) and due at slot ceil((k + 1) W / w). A slot takes the released block with the
earliest deadline (ties: the first source). As the weights use every slot, each block runs within its
window, so at any slot a source is less than one block away from its share. Windows repeat every W
slots; the schedule of one period is computed once, from the weights alone, and its rows (W of them, about
`PERIOD` plus the number of sources) are broadcast.

All rows stay: slots of a source that has run out stay empty, and the others keep their order. A null
source is a source of its own; null ids come first in their source; rows that repeat an id follow each other.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from courtside.llm.tables import columns_of, named, numbered, staged, table

PERIOD = 1000
BLOCK_ROWS = 64
#: The order of the mixture; rows of sources without a weight come last.
ORDER = ["late", "slot", "block", "offset", "source_key"]


def source_weights(rows: DataFrame, weights: dict[str, int] | None = None) -> DataFrame:
    """(source_key, w): the given weights by source, or shares of PERIOD by the square root of the row counts.

    Square roots flatten a mixture towards its small sources; every source gets 1 at least.
    """
    sizes = rows.groupBy("source_key").agg(F.count("*").alias("n"))
    if weights is not None:
        given = F.create_map(*[F.lit(x) for name, w in weights.items() for x in ("s" + name, int(w))]) if weights else None
        known = F.lit(None).cast("long") if given is None else given[F.col("source_key")].cast("long")
        return sizes.select("source_key", known.alias("w")).where("w > 0")
    roots = sizes.select("source_key", F.floor(F.sqrt("n")).alias("r"))
    total = roots.agg(F.sum("r").alias("total"))
    return roots.join(F.broadcast(total)).select(
        "source_key", F.greatest(F.lit(1), F.floor(F.lit(PERIOD) * F.col("r") / F.col("total"))).cast("long").alias("w")
    )


def _over(a: Column, b: Column) -> Column:
    """Whole division, rounded down."""
    return ((a - a % b) / b).cast("long")


def period(weights: DataFrame) -> DataFrame:
    """(source_key, w, total, k, slot) for each block k of a source within one period."""
    one = (
        weights.agg(F.sort_array(F.collect_list(F.struct("source_key", "w"))).alias("sources"), F.sum("w").alias("total"))
        .where("total > 0")
    )
    total = F.col("total")

    def step(state: Column, t: Column) -> Column:
        waiting = F.transform(
            F.col("sources"),
            lambda s, i: F.when(
                (F.element_at(state["done"], i + 1) < s["w"])
                & (_over(F.element_at(state["done"], i + 1) * total, s["w"]) <= t),
                F.struct(
                    _over((F.element_at(state["done"], i + 1) + 1) * total + s["w"] - 1, s["w"]).alias("due"), i.alias("i")
                ),
            ),
        )
        pick = F.array_min(F.filter(waiting, lambda x: x.isNotNull()))["i"]
        return F.struct(
            F.transform(state["done"], lambda k, i: F.when(i == pick, k + 1).otherwise(k)).alias("done"),
            F.concat(state["picked"], F.array(pick)).alias("picked"),
        )

    start = F.struct(
        F.transform(F.col("sources"), lambda s: F.lit(0).cast("long")).alias("done"),
        F.array().cast(T.ArrayType(T.IntegerType())).alias("picked"),
    )
    run = one.select("sources", "total", F.aggregate(F.sequence(F.lit(0).cast("long"), total - 1), start, step)["picked"].alias("picked"))
    slots = run.select("sources", "total", F.posexplode("picked").alias("slot", "i"))
    source = F.element_at("sources", F.col("i") + 1)
    return slots.select(
        source["source_key"].alias("source_key"),
        source["w"].alias("w"),
        "total",
        F.col("slot").cast("long").alias("slot"),
    ).withColumn("k", F.row_number().over(Window.partitionBy("source_key").orderBy("slot")).cast("long") - 1)


def ranked(rows: DataFrame) -> DataFrame:
    """Adds rank, the row's place in its source by (hash of the id, id), without gathering a source.

    Rows are numbered within 4,096 hash ranges of a source; the starts of the ranges are sums over counts.
    """
    rows = rows.withColumn("mark", F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))).withColumn(
        "range", F.substring("mark", 1, 3)
    )
    counts = rows.groupBy("source_key", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("source_key", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("source_key", "range").orderBy("mark", "id")
    return (
        rows.withColumn("at", F.row_number().over(inside)).join(starts, ["source_key", "range"])
        .withColumn("rank", F.col("start") + F.col("at") - 1).drop("mark", "range", "start", "at")
    )


def scheduled(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: dict[str, int] | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(doc, source_key, block, release, deadline, slot, offset); doc holds all columns of a row.

    (slot, offset) is the order of the mixture. Sources without a given weight have no slot and come last.
    """
    rows = docs.select(
        F.struct(*columns_of(docs)).alias("doc"),
        named(id_col).alias("id"),
        F.coalesce(F.concat(F.lit("s"), named(source_col).cast("string")), F.lit("n")).alias("source_key"),
    )
    plan = staged(period(source_weights(rows.select("source_key"), weights)), "period")
    sources = plan.select("source_key", "w", "total").distinct()
    rows = ranked(rows).join(F.broadcast(sources), "source_key", "left")
    block, w, total = F.col("block"), F.col("w"), F.col("total")
    rows = (
        rows.withColumn("block", _over(F.col("rank"), F.lit(block_rows)))
        .withColumn("offset", F.col("rank") % block_rows)
        .withColumn("k", block % w)
        .withColumn("cycle", _over(block, w))
    )
    slots = plan.select("source_key", "k", F.col("slot").alias("in_period"))
    return rows.join(F.broadcast(slots), ["source_key", "k"], "left").select(
        "doc",
        "source_key",
        "block",
        (F.col("cycle") * total + _over(F.col("k") * total, w)).alias("release"),
        (F.col("cycle") * total + _over((F.col("k") + 1) * total + w - 1, w)).alias("deadline"),
        (F.col("cycle") * total + F.col("in_period")).alias("slot"),
        "offset",
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """All rows, with their columns, in the order of the mixture."""
    return _timed(docs, **options).orderBy(*ORDER).select("doc.*")


def _timed(docs: DataFrame, **options) -> DataFrame:
    rows = scheduled(docs, **options).select("doc", "slot", "block", "offset", "source_key")
    return rows.withColumn("late", F.col("slot").isNull())


def placed(docs: DataFrame, **options) -> DataFrame:
    """(doc, place): doc holds all columns of a row, place is its number in the mixture, from 0.

    The schedule follows from ids, sources and counts alone, so it does not matter how the rows of a mixture were stored.
    """
    rows, parts = numbered(_timed(docs, **options), ORDER, [])
    return rows.join(parts, F.shiftrightunsigned("seq", 33) == F.col("part")).select(
        "doc", (F.col("before") + F.col("seq") - F.col("first")).alias("place")
    )


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schedule of all documents, at weights by the square root of the sources' sizes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return scheduled(docs).select("doc.doc_id", "doc.source", "block", "release", "deadline", "slot", "offset")


ORACLE = """
WITH RECURSIVE sized AS (
    SELECT source, CAST(floor(sqrt(count(*))) AS BIGINT) AS r FROM documents GROUP BY source
), weighted AS (
    SELECT source, greatest(1, 1000 * r // (SELECT CAST(sum(r) AS BIGINT) FROM sized)) AS w,
        row_number() OVER (ORDER BY source NULLS FIRST) AS i
    FROM sized
), lists AS (
    SELECT list(w ORDER BY i) AS ws, CAST(sum(w) AS BIGINT) AS total, count(*) AS n FROM weighted
), run(t, done, pick) AS (
    SELECT CAST(0 AS BIGINT), list_transform(ws, lambda x: CAST(0 AS BIGINT)), CAST(0 AS BIGINT) FROM lists
    UNION ALL
    SELECT t + 1, list_transform(done, lambda k, i: k + CASE WHEN i = p THEN 1 ELSE 0 END), p
    FROM (
        SELECT t, done, list_min(list_filter(list_transform(range(1, n + 1), lambda i:
            CASE WHEN done[i] < ws[i] AND done[i] * total // ws[i] <= t
                 THEN ((done[i] + 1) * total + ws[i] - 1) // ws[i] * 1000000 + i END),
            lambda x: x IS NOT NULL)) % 1000000 AS p
        FROM run, lists WHERE t < total
    )
), slots AS (
    SELECT pick AS i, t - 1 AS slot, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS k FROM run WHERE t > 0
), ranked AS (
    SELECT doc_id, source,
        row_number() OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS rank
    FROM documents
), placed AS (
    SELECT doc_id, source, rank // 64 AS block, rank % 64 AS "offset" FROM ranked
)
SELECT doc_id, p.source, block, block // w * total + (block % w) * total // w AS release,
    block // w * total + ((block % w + 1) * total + w - 1) // w AS deadline,
    block // w * total + s.slot AS slot, "offset"
FROM placed p JOIN weighted USING (source) CROSS JOIN lists JOIN slots s ON s.i = weighted.i AND s.k = block % w
"""
