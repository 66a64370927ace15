"""Mixing sources to target weights: Sainte-Laguë apportionment of equal-token blocks.

Every source's documents lie in a seeded order on a line of tokens, cut into blocks of
equal size. The words of the mix are shared out by weight (a source's target stops at
``max_epochs`` times its size, the excess is reshared), then whole blocks go to the sources
with the highest quotients target / (2 s + 1). The seats of a source's integer quota belong to the
shards in turn, each source starting at another shard, so a source's quotas per shard differ by
one at most (``shard_quotas``). Then a seeded permutation numbers the source's blocks, and the block
with number t takes the seats t, t + blocks, t + 2 blocks, ... as far as the quota goes: the line is taken as
often as it fits, and blocks picked by their numbers fill what is left of every shard's quota.

The quotients that can matter are few: Sainte-Laguë rounds target / divisor, so every
source surely gets the rounding for a divisor a little too large, and at most one seat a
source is left for which quotients must be compared.

Only DataFrame functions are used. Positions on the line are running sums by slices
(``ordering.running_before``), so a hot source is spread over many tasks. What is per source
is one small row each.

Null texts and texts without words have size 0 and take 0. Null sources form a source that
sorts last. Equal rows lie on the line one after another. An empty table gives no rows. A very long
text is many blocks, listed in its own row. Columns of the operator replace input columns of the
same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .ordering import SLICE_DIGITS, digest, running_before

NAME = "op4_mixing"
WEIGHTS = (1, 2, 3)  # by the sources' order, repeating
MAX_EPOCHS = 3
BLOCK = 64  # tokens
SHARDS = 16
SEED = 4711
# Primes; one of the two doesn't divide a number of blocks below their product.
PRIMES = (15485863, 32452843)

ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS bigint) AS size,
         md5(concat_ws('|', '{SEED}', coalesce(cast(doc_id AS varchar), ''), md5(coalesce(text, '')))) AS k
  FROM documents),
s0 AS (SELECT source, cast(sum(size) AS bigint) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place, source_size * {MAX_EPOCHS} AS cap FROM s0),
s2 AS (SELECT *, [{", ".join(map(str, WEIGHTS))}][place % {len(WEIGHTS)} + 1] AS weight FROM s1),
s3 AS (SELECT *, cast(sum(source_size) OVER () AS bigint) AS total, count(*) OVER () AS n,
         (sum(source_size) OVER () - (sum(cap) OVER o - cap))::DOUBLE
           / (sum(weight) OVER () - sum(weight) OVER o + weight) AS level
       FROM s2 WINDOW o AS (ORDER BY cap / weight, place)),
s4 AS (SELECT *, first_value(CASE WHEN cap >= weight * level THEN level END IGNORE NULLS) OVER (
         ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS open_level FROM s3),
s5 AS (SELECT *, coalesce(least(cap::DOUBLE, weight * open_level), cap) AS target,
         cast(round(total / {BLOCK}.0::DOUBLE) AS bigint) AS seats FROM s4),
s6 AS (SELECT *, CASE WHEN total > 0 THEN target / total ELSE 0 END AS share FROM s5),
s7 AS (SELECT *, cast(greatest(ceil(share * (seats - n / 2) - 0.5), 0) AS bigint) AS low,
         cast(floor(share * (seats + n / 2) + 0.5) AS bigint) AS high FROM s6),
s8 AS (SELECT *, seats - sum(low) OVER () AS open_seats FROM s7),
c AS (SELECT place, open_seats, row_number() OVER (ORDER BY target / (2 * seat + 1) DESC, place, seat) AS r
      FROM (SELECT *, unnest(generate_series(low, high - 1)) AS seat FROM s8 WHERE high > low)),
w AS (SELECT place, count(*) AS won FROM c WHERE r <= open_seats GROUP BY place),
q AS (SELECT source, source_size, target, place, (source_size + {BLOCK - 1}) // {BLOCK} AS nb,
         least(low + coalesce(won, 0), ((source_size + {BLOCK - 1}) // {BLOCK}) * {MAX_EPOCHS}) AS quota,
         ('0x' || substr(md5(concat_ws('|', '{SEED}', coalesce(source, ''))), 1, 7))::BIGINT AS shift
      FROM s8 LEFT JOIN w USING (place)),
l AS (SELECT d.*, q.* EXCLUDE (source), CASE WHEN nb % {PRIMES[0]} <> 0 THEN {PRIMES[0]} ELSE {PRIMES[1]} END AS step,
         cast(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS bigint) AS a
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
  CASE WHEN size = 0 THEN 0 ELSE cast((quota // nb) * size + coalesce(list_sum(list_transform(
    generate_series(a // {BLOCK}, (a + size - 1) // {BLOCK}),
    lambda j: CASE WHEN (j * (step % nb) + shift) % nb < quota % nb
              THEN least(a + size, (j + 1) * {BLOCK}) - greatest(a, j * {BLOCK}) ELSE 0 END)), 0) AS bigint) END AS taken,
  array_to_string(list_transform(generate_series(0, {SHARDS - 1}), lambda g: CASE WHEN size = 0 THEN 0::BIGINT ELSE cast(coalesce(list_sum(
    list_transform(generate_series(a // {BLOCK}, (a + size - 1) // {BLOCK}), lambda j:
      len(list_filter(generate_series(0, quota // nb), lambda e:
        e * nb + (j * (step % nb) + shift) % nb < quota
        AND (place + e * nb + (j * (step % nb) + shift) % nb) % {SHARDS} = g))
      * (least(a + size, (j + 1) * {BLOCK}) - greatest(a, j * {BLOCK})))), 0) AS bigint) END), ',') AS shard_words
FROM l
"""


def targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes`` (source, source_size; one row per source) with place, weight and target.

    The targets sum to the sum of the sizes. Filling by weight under caps has a closed form:
    with sources sorted by cap over weight, those before some place are full and the others
    share the rest by weight.
    """
    # One row per source: the windows below run over that small table only.
    everything = Window.partitionBy(F.lit(0))
    placed = sizes.withColumn("place", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    own = placed.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * max_epochs)
    by_ratio = everything.orderBy(F.col("cap") / F.col("weight"), "place")
    filled = (
        own.withColumn("all_size", F.sum("source_size").over(everything))
        .withColumn("full_before", F.sum("cap").over(by_ratio) - F.col("cap"))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.sum("weight").over(by_ratio) + F.col("weight"))
        .withColumn("level", (F.col("all_size") - F.col("full_before")) / F.col("weight_left"))
        .withColumn("open_level", F.when(F.col("cap") >= F.col("weight") * F.col("level"), F.col("level")))
        .withColumn("at", F.first("open_level", ignorenulls=True).over(
            by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.col("at"))
    return filled.select("source", "source_size", "place", "weight", "all_size",
                         F.coalesce(target, F.col("cap").cast("double")).alias("target"))


def quotas(aimed: DataFrame, block: int = BLOCK, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Blocks per source by highest quotients: adds ``blocks`` (on the line) and ``quota``."""
    everything = Window.partitionBy(F.lit(0))
    own = aimed.withColumn("seats", F.expr(f"cast(round(all_size / {block}D) AS long)")).withColumn(
        "n", F.count(F.lit(1)).over(everything)).withColumn(
        "share", F.when(F.col("all_size") > 0, F.col("target") / F.col("all_size")).otherwise(0.0))
    sure = own.withColumn("low", F.greatest(
        F.ceil(F.col("share") * (F.col("seats") - F.col("n") / 2) - 0.5), F.lit(0)).cast("long"))
    sure = sure.withColumn("high", F.greatest(
        F.floor(F.col("share") * (F.col("seats") + F.col("n") / 2) + 0.5).cast("long"), F.col("low")))
    sure = sure.withColumn("left", F.col("seats") - F.sum("low").over(everything))
    # At most about three candidates a source.
    seats = sure.where("high > low").select(
        "place", "left", "target", F.explode(F.expr("sequence(low, high - 1)")).alias("seat"))
    order = everything.orderBy((F.col("target") / (2 * F.col("seat") + 1)).desc(), "place", "seat")
    won = seats.withColumn("k", F.row_number().over(order)).where(F.col("k") <= F.col("left")).groupBy(
        F.col("place").alias("won_place")).agg(F.count(F.lit(1)).alias("won"))
    lines = sure.join(won, F.col("place") == F.col("won_place"), "left").withColumn(
        "blocks", F.expr(f"(source_size + {block - 1}) DIV {block}"))
    return lines.select(
        "source", "source_size", "place", "weight", "target", "blocks",
        F.least(F.col("low") + F.coalesce("won", F.lit(0)), F.col("blocks") * max_epochs).alias("quota"))


def shard_quotas(per_source: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(source, shard, quota): a source's blocks dealt to the shards in turn, each source
    starting at another shard."""
    return per_source.select("source", "place", F.col("quota").alias("whole"), F.explode(
        F.expr(f"sequence(0, {shards - 1})")).alias("shard")).select(
        "source", "shard",
        F.expr(f"whole DIV {shards} + if((shard + {shards} - place % {shards}) % {shards} < whole % {shards}, 1, 0)")
        .alias("quota"))


def mix(docs: DataFrame, block: int = BLOCK, max_epochs: int = MAX_EPOCHS, weights=WEIGHTS,
        seed: int = SEED, shards: int = SHARDS) -> DataFrame:
    """``docs`` (doc_id, source, size in words, ...) with source_size, target, ``taken``, the
    words of the document that the mix takes, repeats counted, ``shard_words``, the same by shard, and
    ``copies``, how often the mix takes it as a whole document."""
    own = ("source_size", "target", "taken", "copies", "shard_words")
    rows = docs.drop(*[c for c in docs.columns if c.lower() in own])
    sizes = rows.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("source_size"))
    plan = quotas(targets(sizes, weights, max_epochs), block, max_epochs).select(
        F.col("source").alias("__of"), "target", F.col("place").alias("__place"), F.col("blocks").alias("__blocks"), F.col("quota").alias("__quota"))
    others = [c for c in rows.columns if c not in ("doc_id", "source", "size", "text")]
    text = [F.col("text")] if "text" in rows.columns else []
    keyed = rows.withColumn("__key", digest(seed, F.col("doc_id"), *text)).withColumn(
        "__part", F.substring("__key", 1, SLICE_DIGITS))
    laid = running_before(keyed, ["source"], "__part", [F.col("__key"), F.col("doc_id"), F.col("size")],
                          F.col("size"), "__at", "source_size")
    # Which blocks of the remaining quota: those whose permuted number is below it.
    joined = laid.join(plan, F.col("source").eqNullSafe(F.col("__of"))).withColumn(
        "__step", F.when(F.col("__blocks") % PRIMES[0] != 0, F.lit(PRIMES[0])).otherwise(F.lit(PRIMES[1])).cast("long")
    ).withColumn("__shift", F.conv(F.substring(digest(seed, F.col("source")), 1, 7), 16, 10).cast("long"))
    number = "({j} * (__step % __blocks) + __shift) % __blocks"
    is_picked = number + " < __quota % __blocks"
    picked = F.expr(f"""
        aggregate(sequence(__at DIV {block}, (__at + size - 1) DIV {block}), 0L, (sum, j) -> sum + if(
            {is_picked.format(j="j")},
            least(__at + size, (j + 1) * {block}) - greatest(__at, j * {block}), 0L))""")
    taken = F.when(F.col("size") > 0, F.expr("(__quota DIV __blocks) * size") + picked).otherwise(F.lit(0))
    first = is_picked.format(j=f"(__at DIV {block})")
    copies = F.when(F.col("size") > 0, F.expr(f"__quota DIV __blocks + if({first}, 1, 0)")).otherwise(F.lit(0))
    # The seats of every block of the document, each with its shard and the words it holds of the document.
    dealt = F.expr(f"""
        if(size > 0, flatten(transform(sequence(__at DIV {block}, (__at + size - 1) DIV {block}), j -> transform(
            filter(transform(sequence(0L, __quota DIV __blocks), e -> e * __blocks + {number.format(j="j")}), s -> s < __quota),
            s -> named_struct('shard', (__place + s) % {shards},
                              'words', least(__at + size, (j + 1) * {block}) - greatest(__at, j * {block}))))),
           cast(array() AS array<struct<shard:bigint,words:bigint>>))""")
    by_shard = F.expr(f"""
        transform(sequence(0, {shards - 1}), g -> aggregate(
            filter(__dealt, x -> x.shard = g), 0L, (sum, x) -> sum + x.words))""")
    # A generator computes the seats once for all shards.
    seated = joined.withColumns({"taken": taken.cast("long"), "copies": copies.cast("int")}).select(
        "*", F.explode(F.array(dealt)).alias("__dealt"))
    return seated.select("doc_id", "source", "size", "source_size", "target", "taken", "copies",
                         by_shard.alias("shard_words"), *text, *others)


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size``, the number of words of the text."""
    return docs.withColumn("size", F.size(common.split_words(F.col("text"), common.SPACES)).cast("long"))


def draw(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as the mix takes it as a whole document."""
    own = docs.select(
        "doc_id", "source", "text", F.struct("*").alias("__row"),
        F.size(common.split_words(F.col("text"), common.SPACES)).cast("long").alias("size"))
    return mix(own, **options).where("copies > 0").select(
        F.explode(F.expr("array_repeat(__row, copies)")).alias("__row")).select("__row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, and for which shards."""
    docs = sized(common.documents(spark, sf_dir))
    narrow = common.staged(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", "size",
        F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text")), "mix-rows")
    return mix(narrow).select("doc_id", "size", "source_size", "target", "taken", F.array_join(
        F.transform("shard_words", lambda n: n.cast("string")), ",").alias("shard_words"))
