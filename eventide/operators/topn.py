"""Top-n per window (TOP1, TOP2) and the text report derived from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


GROUP_LIMIT = 1000     # of Spark's spark.sql.optimizer.windowGroupLimitThreshold
SALTS = 64


def topn_per_group(df: DataFrame, group: Sequence[str], n: int, score: str,
                   tiebreak: Sequence[str], rank: str = "rank") -> DataFrame:
    """Keep the ``n`` rows with the highest ``score`` per group; ties by ``tiebreak`` ascending.

    ``row_number() <= n`` is planned as a partial ``WindowGroupLimit`` before
    the shuffle, so each map task ships at most ``n`` rows per group. Spark does
    so up to ``GROUP_LIMIT``; for a larger ``n`` the rows of a group are first
    limited in ``SALTS`` parts, by hash, so no task gets a whole hot group.
    """
    if n > GROUP_LIMIT:
        part = F.pmod(F.xxhash64(*tiebreak, score), F.lit(SALTS))
        w = Window.partitionBy(*group, part).orderBy(F.col(score).desc(), *[F.col(t).asc() for t in tiebreak])
        df = df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n).drop(rank)
    w = Window.partitionBy(*group).orderBy(F.col(score).desc(), *[F.col(t).asc() for t in tiebreak])
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def topn_per_window(counts: DataFrame, n: int, count: str = "cnt", tiebreak: Sequence[str] = (),
                    window: str = "window_end", rank: str = "rank") -> DataFrame:
    """TOP1/TOP2 on the output of a window count: the ``n`` largest per window end."""
    return topn_per_group(counts, [window], n, count, tiebreak, rank)


def render_report(top: DataFrame, group: str, rank: str, label: str, item: str, score: str,
                  name: str = "report") -> DataFrame:
    """One text block per group: a time line, then ``No<rank>: <label>=<item> count=<score>``.

    Groups hold at most n rows after :func:`topn_per_group`, so the list
    collected per group is bounded.
    """
    line = F.format_string(f"No%d: {label}=%s count=%d", F.col(rank), F.col(item).cast("string"), F.col(score))
    per = top.groupBy(group).agg(F.sort_array(F.collect_list(F.struct(rank, line.alias("l")))).alias("_ls"))
    body = F.array_join(F.transform("_ls", lambda x: x["l"]), "\n")
    text = F.concat(F.lit("time: "), F.date_format(group, "yyyy-MM-dd HH:mm:ss"), F.lit("\n"), body)
    return per.select(group, text.alias(name))
