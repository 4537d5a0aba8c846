"""Heavy keys and joins that spread them over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.operators.sizing import scanned_bytes

PIECE = "_piece"
PIECES = "_pieces"
_ROWS = "_rows"
# The most items a sketch may track, and the tasks that merge sketches before the last one does.
MOST_TRACKED = 1_000_000
SKETCH_MERGERS = 64
# What a task reads by default, and how many tracked items one task may merge.
TASK_BYTES = 128 * 1024 * 1024
MERGED_AT_ONCE = 4_000_000


def as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def default_pieces(df: DataFrame) -> int:
    """As many pieces as shuffle partitions: a heavy key is cut until no piece exceeds an average partition."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)


def key_rows(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows per key. Counted partially before the shuffle, so a heavy key costs one row per map task."""
    return df.groupBy(*as_list(key)).agg(F.count(F.lit(1)).alias(_ROWS))


def _key_hash(keys: Sequence[str]) -> Column:
    """A whole number for a key; null is told from every value."""
    return F.xxhash64(*[part for name in keys for part in (F.col(f"`{name}`").isNull(), F.col(f"`{name}`"))])


def key_sketch(df: DataFrame, key: str | Sequence[str], pieces: int) -> DataFrame:
    """One row, or none for an empty frame: the number of rows and the hashes of the most frequent keys with their estimated rows.

    Each task counts in a sketch of frequent items, so what travels is their fixed size for each task, however many keys there are.
    The sketches of many tasks are merged in two steps. A sketch that tracks m items is wrong by at most 2.7 / m of all rows; with 16 items for
    each piece no key of more than ``1/pieces`` of the rows is missed.
    """
    tracked = min(16 * max(pieces, 2), MOST_TRACKED)
    hashed = df.select(_key_hash(as_list(key)).alias("_hash"))
    tasks = scanned_bytes(df) / TASK_BYTES
    place = F.lit(0) if tasks * tracked <= MERGED_AT_ONCE else F.pmod(F.spark_partition_id(), F.lit(SKETCH_MERGERS))
    places = hashed.groupBy(place.alias("_place")).agg(
        F.count(F.lit(1)).alias(_ROWS), F.expr(f"approx_top_k_accumulate(_hash, {tracked})").alias("_sketch"))
    merged = places if tasks * tracked <= MERGED_AT_ONCE else places.groupBy(F.lit(0).alias("_all")).agg(
        F.sum(_ROWS).alias(_ROWS), F.expr(f"approx_top_k_combine(_sketch, {tracked})").alias("_sketch"))
    return merged.select(_ROWS, F.expr(f"approx_top_k_estimate(_sketch, {min(2 * max(pieces, 2), tracked)})").alias("_items"))


def heavy_keys(df: DataFrame, key: str | Sequence[str], pieces: int) -> DataFrame:
    """Keys that hold more than ``1/pieces`` of the rows, with the number of pieces each should be cut into.

    Fewer than ``pieces`` keys can qualify, and their pieces add up to less than ``2 * pieces``, whatever the data. Candidates come
    from ``key_sketch``; only if there are some, their rows alone are counted, one row for each candidate and task. The result is a table
    of literals that is safe to broadcast.
    """
    keys = as_list(key)
    sketch = key_sketch(df, keys, pieces).head()
    total = sketch[_ROWS] if sketch else 0
    hashes = [item["item"] for item in (sketch["_items"] if sketch else []) if item["count"] * pieces > total]
    scaled = F.col(_ROWS) * F.lit(pieces)
    chosen = df.where(_key_hash(keys).isin(hashes)) if hashes else df.limit(0)
    found = key_rows(chosen, keys).where(scaled > total).select(*keys, F.ceil(scaled / max(total, 1)).cast("int").alias(PIECES))
    if not hashes:
        return df.sparkSession.createDataFrame([], found.schema)
    return df.sparkSession.createDataFrame(found.toArrow(), found.schema)


def spread(pieces: Column | int, salt_from: Sequence[str] = ()) -> Column:
    """A piece number in ``[0, pieces)`` for each row.

    It depends on the map task and the ``salt_from`` columns only. A repeated task therefore makes the same choice again, which
    a random number does not guarantee behind a shuffle. Without ``salt_from`` all rows of a task get one piece.
    """
    salts = [F.col(f"`{name}`") for name in salt_from]
    return F.pmod(F.xxhash64(F.spark_partition_id(), *salts), pieces).cast("int")


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(field.dataType) for field in kind)
    return isinstance(kind, T.MapType)


def hashable_columns(df: DataFrame) -> list[str]:
    """The columns that can be hashed: all but those that hold maps."""
    return [field.name for field in df.schema if not _has_map(field.dataType)]


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str, null_safe: bool) -> Column:
    """Equality of the keys with their prefixed twins on the right side."""
    condition = F.lit(True)
    for name in keys:
        one, other = left[name], right[prefix + name]
        condition = condition & (one.eqNullSafe(other) if null_safe else one == other)
    return condition


def _with_pieces(df: DataFrame, heavy: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """``df`` plus the number of pieces of its key, null where the key is not heavy."""
    renamed = heavy.select(*[F.col(name).alias(f"_heavy_{name}") for name in keys], PIECES)
    joined = df.join(F.broadcast(renamed), _match(df, renamed, keys, "_heavy_", null_safe), "left_outer")
    return joined.drop(*[f"_heavy_{name}" for name in keys])


def salt_rows(df: DataFrame, heavy: DataFrame, key: str | Sequence[str], pieces: int, salt_from: Sequence[str] = (),
              null_safe: bool = False) -> DataFrame:
    """Add the piece of each row: 0 for ordinary keys, spread for heavy ones and for keys that cannot match (null).

    The salt comes from all columns unless ``salt_from`` names some, so rows of a heavy key part ways also behind a shuffle on it.
    """
    keys = as_list(key)
    wanted = F.coalesce(F.col(PIECES), F.lit(1))
    if not null_safe:
        any_null = F.lit(False)
        for name in keys:
            any_null = any_null | F.col(f"`{name}`").isNull()
        wanted = F.when(any_null, F.lit(pieces)).otherwise(wanted)
    # the number of pieces is settled below the spread, which is not deterministic for the optimizer
    counted = _with_pieces(df, heavy, keys, null_safe).withColumn(PIECES, wanted)
    return counted.withColumn(PIECE, spread(F.col(PIECES), salt_from or hashable_columns(df))).drop(PIECES)


def copy_rows(df: DataFrame, heavy: DataFrame, key: str | Sequence[str], null_safe: bool = False) -> DataFrame:
    """Repeat each row once per piece of its key; rows of ordinary keys stay single."""
    keys = as_list(key)
    counted = _with_pieces(df, heavy, keys, null_safe)
    numbers = F.sequence(F.lit(0), F.coalesce(F.col(PIECES), F.lit(1)) - 1)
    return counted.withColumn(PIECE, F.explode(numbers)).drop(PIECES)


def salted_join(left: DataFrame, right: DataFrame, key: str | Sequence[str], salts: int | None = None, how: str = "left_outer",
                salt_from: Sequence[str] = (), null_safe: bool = False, strategy: str | None = None, right_heavy: bool = False) -> DataFrame:
    """The rows of ``left.join(right, key, how)``, with the heavy keys of ``left`` spread over many tasks.

    Only heavy keys are salted, so ``right`` grows by a bounded number of copies instead of by the factor ``salts``. Null keys of
    ``left`` match nothing and are spread as well; with ``null_safe`` null is a key like any other. The key appears once.
    ``right_heavy`` looks for heavy keys of ``right`` too: their rows are spread and the matching rows of ``left`` repeated, in a join
    of their own, which is an inner one, as these keys always match. ``strategy`` adds a join hint for ``right``. Raises if the sides
    share a name beside the key.
    """
    if how not in ("inner", "left_outer"):
        raise ValueError("copies of the right side are only harmless in inner and left outer joins")
    keys = as_list(key)
    twice = (set(left.columns) & set(right.columns)) - set(keys)
    if twice:
        raise ValueError(f"both sides have {sorted(twice)}: rename one side")
    pieces = salts or default_pieces(left)
    if right_heavy:
        counted = right if null_safe else right.dropna(subset=keys)
        heavy = heavy_keys(counted, keys, pieces)
        if not heavy.isEmpty():
            named = F.broadcast(heavy.select(*[F.col(f"`{name}`").alias(f"_heavy_{name}") for name in keys]))
            sides = {side: [df.join(named, _match(df, named, keys, "_heavy_", null_safe), how_) for how_ in ("left_semi", "left_anti")]
                     for side, df in (("left", left), ("right", right))}
            columns = [*left.columns, *[name for name in right.columns if name not in keys]]
            spread_right = _salted(sides["right"][0], sides["left"][0], heavy, keys, pieces, "inner", (), null_safe, None).select(*columns)
            rest = salted_join(sides["left"][1], sides["right"][1], keys, pieces, how, salt_from, null_safe, strategy)
            return rest.select(*columns).unionAll(spread_right)
    return _salted(left, right, heavy_keys(left, keys, pieces), keys, pieces, how, salt_from, null_safe, strategy)


def _salted(left: DataFrame, right: DataFrame, heavy: DataFrame, keys: Sequence[str], pieces: int, how: str, salt_from: Sequence[str],
            null_safe: bool, strategy: str | None) -> DataFrame:
    salted = salt_rows(left, heavy, keys, pieces, salt_from, null_safe)
    copies = copy_rows(right, heavy, keys, null_safe)
    # fresh names keep the condition unambiguous when both sides stem from one table
    copies = copies.select(*[F.col(f"`{name}`").alias(f"_right_{name}") if name in (*keys, PIECE) else F.col(f"`{name}`")
                             for name in copies.columns])
    condition = _match(salted, copies, keys, "_right_", null_safe) & (salted[PIECE] == copies[f"_right_{PIECE}"])
    joined = salted.join(copies.hint(strategy) if strategy else copies, condition, how)
    return joined.drop(PIECE, f"_right_{PIECE}", *[f"_right_{name}" for name in keys])
