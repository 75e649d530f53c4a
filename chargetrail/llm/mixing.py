"""Mix sources to target weights by repeating whole documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chargetrail.llm.registry import query, read
from chargetrail.llm.words import WORD
from chargetrail.session import materialise
from chargetrail.sources.index import with_row_index

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
SEED = "mix-1"


def word_count(text: str | Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(id_col: str | Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the seed and the id alone: 52 bits of their MD5."""
    own = F.col(id_col) if isinstance(id_col, str) else id_col
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(own.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP
) -> DataFrame:
    """Per source of `sized` (`source`, `size`): `source_size`, `weight`, `target` and `rate`.

    Sources in code-point order, NULL last, take the `weights` in turn. `share` of all sizes is split by weight; what
    a target has above `cap` times its source is split again among the others, until no target is above. Each round
    gathers two sums of the table of sources; it ends when a round caps no further source.
    """
    sums = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    sums = materialise(sums.withColumn("_null", F.col("source").isNull().cast("int")), "sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_at") % len(weights) + 1).cast("int"))
    ranked = materialise(
        with_row_index(sums, ["_null", "source"], "_at").select("source", "source_size", weight.alias("weight")),
        "ranked",
    )
    most = F.col("source_size") * cap
    level, capped = None, -1
    while True:
        full = F.lit(False) if level is None else most <= F.col("weight") * F.lit(level)
        row = ranked.agg(
            F.sum("source_size"),
            F.coalesce(F.sum(F.when(full, most)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
            F.count(F.when(full, 1)),
        ).first()
        left, weight_left, count = (row[0] or 0) * share - row[1], row[2], row[3]
        if count == capped or not weight_left:
            break
        level, capped = left / weight_left, count
    if level is None:
        target = F.lit(0.0)
    else:
        open_target = F.col("weight") * F.lit(float(left)) / F.lit(float(max(weight_left, 1)))
        target = F.when(most <= F.col("weight") * F.lit(level), most.cast("double")).otherwise(open_target)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return ranked.withColumn("target", target.cast("double")).withColumn("rate", rate)


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
    seed: str = SEED,
) -> DataFrame:
    """Per row of `docs`: id, `size` (words), `source_size`, `target`, and `copies`, how often the mix takes it.

    `copies` is floor(rate) plus one more where the row's draw is below the rate's fraction; the rate is target over
    size of the source. The draw depends on seed and id, so reruns and retried tasks agree. Sources of size 0 have
    target 0 and no copies; a NULL source is a source; a NULL text has size 0; rows that repeat an id are each
    counted, and drawn alike. An empty table gives an empty result.
    """
    sized, targets = _sized(docs, id_col, text_col, source_col, weights, share, cap)
    return sized.join(targets, F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("_id").alias(id_col), "size", "source_size", "target", _copies("_id", seed).alias("copies")
    )


def _sized(docs, id_col, text_col, source_col, weights, share, cap) -> tuple[DataFrame, DataFrame]:
    """(`_id`, `source`, `size`) of every row, and the written table of targets with `_source`."""
    size = word_count(F.col(text_col)).alias("size")
    sized = materialise(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"), size), "sizes")
    targets = source_targets(sized, weights, share, cap).withColumnRenamed("source", "_source")
    return sized, materialise(targets, "targets")


def _copies(id_col: str | Column, seed: str, rate: str = "rate") -> Column:
    whole = F.floor(rate)
    return (whole + (draw(id_col, seed) < F.col(rate) - whole).cast("long")).cast("long")


def emit_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
    seed: str = SEED,
) -> DataFrame:
    """The mix itself: every row of `docs` as often as `mix_sources` says, with all columns of `docs`.

    Texts are joined with the small table of sources only, so that Spark need not shuffle them.
    """
    _, targets = _sized(docs, id_col, text_col, source_col, weights, share, cap)
    rates = targets.select(F.col("_source").alias("_mix_source"), F.col("rate").alias("_mix_rate"))
    joined = docs.join(rates, docs[source_col].eqNullSafe(rates["_mix_source"]))
    copies = _copies(docs[id_col], seed, "_mix_rate").cast("int")
    taken = joined.withColumn("_mix_copies", copies).where("_mix_copies > 0")
    taken = taken.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies"))))
    return taken.select(*[docs[c] for c in docs.columns])


@query(
    r"""
    WITH sized AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
    ), sums AS (
      SELECT source, sum(size)::BIGINT AS source_size,
             [3, 1, 2][(row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1] AS weight
      FROM sized GROUP BY source
    ), ordered AS (
      SELECT *, 2 * source_size AS most, sum(source_size) OVER () * 1.5 AS budget,
             sum(2 * source_size) OVER w AS most_before,
             coalesce(sum(weight) OVER (ORDER BY 2 * source_size / weight::DOUBLE, weight, encode(source) NULLS LAST
               ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS weight_after
      FROM sums
      WINDOW w AS (ORDER BY 2 * source_size / weight::DOUBLE, weight, encode(source) NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    ), marked AS (
      SELECT *, most_before * weight + most * weight_after <= budget * weight AS full_up FROM ordered
    ), targets AS (
      SELECT source, source_size,
             CASE WHEN full_up THEN most::DOUBLE
                  ELSE weight * (budget - coalesce(sum(most) FILTER (WHERE full_up) OVER (), 0))::DOUBLE
                       / (sum(weight) FILTER (WHERE NOT full_up) OVER ())::DOUBLE END AS target
      FROM marked
    ), rated AS (
      SELECT doc_id, size, source_size, target,
             CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
      FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
    )
    SELECT doc_id, size::BIGINT AS size, source_size, target,
           (size * (floor(rate) + CASE WHEN
             ('0x' || substr(md5('mix-1:' || doc_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE
             < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
    FROM rated
    """
)
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
