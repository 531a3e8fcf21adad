"""Top-N per key.

``row_number() <= n`` over a window is planned as a WindowGroupLimit on each
map partition before the shuffle, so even a key holding a third of the rows
sends at most n rows per map task to its reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_key(df: DataFrame, n: int, key: str | list[str] = "user_id",
                  score: str = "score", tie: str = "track_id",
                  ascending: bool = False, rank_col: str = "rank") -> DataFrame:
    """Keep the ``n`` best rows per key, numbered 1..n; ties broken by ``tie`` ascending.

    ``ascending=False`` keeps the highest scores; ``ascending=True`` keeps the
    lowest, which is what the reference's sort-then-take literally does.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = F.col(score).asc() if ascending else F.col(score).desc()
    w = Window.partitionBy(*keys).orderBy(order, F.col(tie).asc())
    return (df.withColumn(rank_col, F.row_number().over(w))
            .filter(F.col(rank_col) <= n))


def user_top_n(recs: DataFrame, n: int = 30, ascending: bool = False) -> DataFrame:
    """Best ``n`` recs per user -> (user_id, rank, track_id, score)."""
    ranked = top_n_per_key(recs, n, "user_id", "score", "track_id", ascending)
    return ranked.select("user_id", "rank", "track_id", "score")
