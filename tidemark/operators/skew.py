"""Hot keys: finding them in one bounded pass, and joining without a hot task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# A key is hot when it holds more than a fair task: one row in as many as there are tasks, one
# in HOT_SHARE at least and in MOST_SHARES at most, and never fewer than HOT_ROWS rows.
HOT_ROWS = 100_000
HOT_SHARE, MOST_SHARES = 1024, 1 << 16
TRACKED_PER_KEY = 4
# Tasks that merge the sketches of the scan before the last one merges theirs.
MERGERS = 64
# Pieces of a hot key per fair task, and of any key per shuffle partition: more, smaller pieces
# even out where their hashes fall together.
FINER = 4


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(key) for key in keys])


def power_of_two(n: float) -> int:
    """The smallest power of two that is not below ``n``."""
    return 1 << max(int(-(-n // 1)) - 1, 0).bit_length()


def spread(df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)


def heat(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, hot_share: int | None = None
) -> dict[int, int]:
    """Hashes of the keys heavy enough to need splitting, and into how many pieces each.

    One pass over the key columns builds a mergeable frequent-items sketch inside each
    task; MERGERS tasks merge these, one merges what they return, and one small row
    reaches the driver. It only steers how rows are spread: a key wrongly listed or missed,
    or another number of pieces, changes no result.
    """
    share = hot_share or min(max(HOT_SHARE, 2 * spread(df)), MOST_SHARES)
    tracked = TRACKED_PER_KEY * share
    merged = f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {share})"
    hashed = df.select(key_hash(keys).alias("_key"), (F.spark_partition_id() % MERGERS).alias("_merger"))
    row = (
        hashed.union(df.sparkSession.sql("SELECT 0L, 0"))  # sketches of no rows cannot be merged
        .groupBy("_merger")
        .agg(F.count("*").alias("n"), F.expr(f"approx_top_k_accumulate(_key, {tracked})").alias("sketch"))
        .repartition(1)  # nor can partitions without a sketch
        .agg(F.sum("n").alias("n"), F.expr(merged).alias("top"))
        .first()
    )
    fair = max(hot_rows, row.n // share)
    most = power_of_two(FINER * spread(df))
    return {
        item["item"]: max(min(power_of_two(FINER * item["count"] / fair), most), 2)
        for item in row.top
        if item["count"] >= fair and item["item"]
    }


def hot_keys(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, hot_share: int | None = None
) -> list[int]:
    """Hashes of the keys that ``heat`` finds."""
    return list(heat(df, keys, hot_rows, hot_share))


def pieces_of(keys: Sequence[str], hot: Mapping[int, int]) -> Column:
    """Into how many pieces the rows of a key are dealt; one for keys that are not hot."""
    sized: dict[int, list[int]] = {}
    for key, pieces in hot.items():
        sized.setdefault(pieces, []).append(key)
    column = F.lit(1)
    for pieces, hashes in sorted(sized.items()):
        column = F.when(key_hash(keys).isin(*hashes), F.lit(pieces)).otherwise(column)
    return column


def dealt(df: DataFrame, pieces: Column, name: str) -> DataFrame:
    """``df`` with the piece of each row, dealt one by one inside every input partition.

    Hot rows are first put in order of their content, so that a partition read again after an
    executor was lost deals the same rows to the same pieces, whatever order they come in; rows
    that agree in everything are dealt too, and which of them goes where makes no difference.
    """
    content = [F.col(f"`{field.name}`") for field in df.schema if "map<" not in field.dataType.simpleString()]
    place = F.monotonically_increasing_id() + F.spark_partition_id()
    ordered = df.sortWithinPartitions(F.when(pieces > 1, F.xxhash64(*content)))
    return ordered.withColumn(name, F.when(pieces > 1, F.pmod(place, pieces)).otherwise(F.lit(0)).cast("int"))


def link(
    facts: DataFrame,
    parents: DataFrame,
    on: Sequence[str] | str,
    how: str = "inner",
    hot: Mapping[int, int] | Sequence[int] | None = None,
) -> DataFrame:
    """Equi-join of two large tables whose fact side may be very uneven.

    Without hot keys this is the plain join. With them, the facts of a hot key are dealt over
    as many pieces as its rows need, wherever they lie and even when identical, and the key's
    few parents are repeated once for each piece. ``hot`` is what ``heat`` returns, or hashes
    alone, which are dealt over all tasks. ``how`` is inner, left, left_semi or left_anti.
    """
    keys = [on] if isinstance(on, str) else list(on)
    hot = heat(facts, keys) if hot is None else hot
    if not hot:
        return facts.join(parents, keys, how)
    if not isinstance(hot, Mapping):
        hot = dict.fromkeys(hot, power_of_two(FINER * spread(facts)))
    pieces = pieces_of(keys, hot)
    repeated = parents.withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    return dealt(facts, pieces, "_piece").join(repeated, [*keys, "_piece"], how).drop("_piece")
