"""Hit rate and reciprocal rank of held-out songs among sampled negatives."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.operators import factors, sampling


def rank_positive(scored: DataFrame) -> DataFrame:
    """The rank of the positive (draw 0) of each pair; ties go to the positive.

    Counting the better negatives gives the rank without a sort. A pair has a
    fixed number of candidates, so the collected list is small.
    """
    ranked = scored.groupBy("user_id", "song_id").agg(
        F.max(F.when(F.col("draw") == 0, F.col("score"))).alias("_own"),
        F.collect_list(F.when(F.col("draw") > 0, F.col("score"))).alias("_others"),
    )
    better = F.size(F.filter("_others", lambda s: s > F.col("_own")))
    return ranked.select(
        "user_id", "song_id", (better + 1).alias("rank"), F.size("_others").alias("n_negatives")
    )


def rank_metrics(ranks: DataFrame, k: int = 10) -> DataFrame:
    """One row: hr, mrr and n. No pair at all gives zeros."""
    hit = F.col("rank") <= k
    return ranks.agg(
        F.coalesce(F.avg(F.when(hit, 1.0).otherwise(0.0)), F.lit(0.0)).alias("hr"),
        F.coalesce(F.avg(F.when(hit, F.lit(1.0) / F.col("rank")).otherwise(0.0)), F.lit(0.0)).alias("mrr"),
        F.count("*").alias("n"),
    )


def evaluate_factors(
    user_factors: DataFrame,
    item_factors: DataFrame,
    candidates: DataFrame,
    k: int = 10,
) -> DataFrame:
    """Metrics of one factorisation on ``candidates`` (see :func:`sampling.negative_samples`)."""
    return rank_metrics(rank_positive(factors.score_candidates(candidates, user_factors, item_factors)), k)


def write_bundle(path: str, user_factors: DataFrame, item_factors: DataFrame, candidates: DataFrame) -> None:
    """Everything that the metrics of one factorisation follow from, as three tables below ``path``."""
    user_factors.write.parquet(f"{path}/users")
    item_factors.write.parquet(f"{path}/items")
    candidates.write.parquet(f"{path}/candidates")


# Written on its own: it shares no expression with the operators above.
BUNDLE_SQL = """
WITH scored AS (
  SELECT c.user_id, c.song_id, c.draw,
    coalesce(round(aggregate(zip_with(u.features, i.features, (x, y) -> double(x) * double(y)), 0D, (a, b) -> a + b), 9),
             double('-Infinity')) AS score
  FROM {candidates} c JOIN {users} u ON u.id = c.user_id LEFT JOIN {items} i ON i.id = c.candidate
), placed AS (
  SELECT draw, row_number() OVER (PARTITION BY user_id, song_id ORDER BY score DESC, draw) AS place FROM scored
)
SELECT coalesce(avg(if(place <= {k}, 1D, 0D)), 0D) AS hr, coalesce(avg(if(place <= {k}, 1D / place, 0D)), 0D) AS mrr, count(*) AS n
FROM placed WHERE draw = 0
"""


def bundle_metrics(spark: SparkSession, path: str, k: int = 10) -> DataFrame:
    """hr, mrr and n recomputed from a stored bundle by a ranking in SQL."""
    names = ("candidates", "users", "items")
    return spark.sql(BUNDLE_SQL.replace("{k}", str(k)), **{n: spark.read.parquet(f"{path}/{n}") for n in names})


def evaluate_model(
    model: ALSModel,
    held_out: DataFrame,
    train: DataFrame,
    k: int = 10,
    n_pairs: int = 5000,
    n_negatives: int = 99,
    seed: int = sampling.SEED,
) -> DataFrame:
    """Sample pairs and negatives, score and rank them: one row hr, mrr, n."""
    pairs = sampling.eval_pairs(held_out, n_pairs, seed)
    candidates = sampling.negative_samples(pairs, train, n_negatives, seed)
    return evaluate_factors(model.userFactors, model.itemFactors, candidates, k)


def stack_results(results: list[tuple[dict, DataFrame]]) -> DataFrame:
    """One relation of metrics: grid_index, the parameters, hr, mrr, n."""
    return reduce(
        DataFrame.unionByName,
        [
            metrics.select(
                F.lit(i).alias("grid_index"), *[F.lit(v).alias(name) for name, v in params.items()], "*"
            )
            for i, (params, metrics) in enumerate(results)
        ],
    )


def select_best(results: DataFrame) -> DataFrame:
    """The row with the highest hit rate; the earlier one on a tie."""
    return results.orderBy(F.col("hr").desc(), F.col("grid_index").asc()).limit(1)
