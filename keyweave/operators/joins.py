"""Joins against a side that is unique on its key, safe for keys that hold a large share of the rows.

Three cases, decided per join:

* Catalyst would broadcast the unique side (its size estimate is below the session's threshold):
  a plain join, where a hot key does no harm.
* The side is too big and some keys are frequent: rows of those keys are spread over salts, and
  only the matching rows of the unique side are copied once per salt.
* The side is too big and no key is frequent: a plain shuffle join, with NULL keys spread.

A left side no larger than one shuffle partition is not searched for frequent keys.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyweave.functions.keys import is_linked
from keyweave.session import exceeds_partition, fits_broadcast, shuffle_partitions

# Share of the rows from which a key counts as frequent: at most 1 / HOT_SHARE keys can reach it.
HOT_SHARE = 0.0005

# Counters per sketch; a power of two.
SKETCH_ITEMS = 16384

# How much wider a dimension may have become through the lookups made for it.
ENRICHED = 4

_KEY, _SALT, _LEFT_KEY, _LEFT_SALT = "__key", "__salt", "__left_key", "__left_salt"


def frequent_keys(df: DataFrame, key: Column, share: float = HOT_SHARE) -> list:
    """Every key that holds ``share`` of the rows or more; a few rarer ones may be among them.

    One pass over the key column with a frequent-items sketch of bounded size per task and no
    shuffle of keys. The sketch misses no key above 7 / SKETCH_ITEMS of the rows.
    """
    present = df.select(key.alias(_KEY)).filter(F.col(_KEY).isNotNull())
    most = math.ceil(2 / share)
    found = present.agg(
        F.expr(f"approx_top_k({_KEY}, {most}, {SKETCH_ITEMS})").alias("top"), F.count(F.lit(1)).alias("rows")
    ).first()
    return [t["item"] for t in found["top"] or [] if t["count"] >= found["rows"] * share / 2]


def comparable_columns(df: DataFrame) -> list[str]:
    """Columns that can be ordered and hashed: all but maps."""
    return [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]


def one_row_per_key(df: DataFrame, keys: list[str], order_by: list[Column] | None = None) -> DataFrame:
    """Keep the last row of each key in ``order_by`` (default: order of all other columns).

    The rank filter is applied before the shuffle as well, so copies of a key never travel.
    """
    last = order_by or [F.col(c).desc_nulls_last() for c in comparable_columns(df) if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*(last or [F.lit(1)]))
    return df.withColumn("__rank", F.row_number().over(window)).filter(F.col("__rank") == 1).drop("__rank")


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    left_key: Column | str,
    right_key: str,
    how: str = "left",
    unique: bool = True,
    rows_of: DataFrame | None = None,
    links_in: DataFrame | None = None,
) -> DataFrame:
    """Join ``left`` to ``right`` on a key that is unique in ``right`` and not part of the result.

    ``how`` is left, inner, left_semi or left_anti. A left row with a NULL key has no match. With
    ``unique=False`` copies of a right key are reduced to one row, in the shuffle of the join.

    Catalyst takes the size of a joined ``right`` to be the product of its sides. Where ``right`` has
    no more rows than the table ``rows_of``, its size is judged by that table instead. Where ``left`` has the
    rows of the table ``links_in`` with columns looked up before, frequent keys are searched in that table, so
    the earlier joins run once.
    """
    key = F.col(left_key) if isinstance(left_key, str) else left_key
    keeps_right = how in ("left", "inner")
    side = right.withColumnRenamed(right_key, _KEY)
    keyed = left.withColumn(_LEFT_KEY, key)
    judged = rows_of is not None and fits_broadcast(rows_of, ENRICHED)
    if judged or fits_broadcast(side):
        if not unique:
            side = one_row_per_key(side, [_KEY])
        if judged:
            side = F.broadcast(side)
        joined = keyed.join(side, F.col(_LEFT_KEY) == F.col(_KEY), how).drop(_LEFT_KEY)
        return joined.drop(_KEY) if keeps_right else joined

    salts = max(2, shuffle_partitions(left))
    # Hashes serve keys of any type; here they only decide on which salts a key uses.
    source = left if links_in is None else links_in
    hot = frequent_keys(source, F.xxhash64(key)) if exceeds_partition(source) else []
    spread = F.pmod(_row_hash(left), F.lit(salts)).cast("int")
    left_salt = F.when(F.col(_LEFT_KEY).isNull(), spread)
    right_salt = F.lit(0)
    if hot:
        left_salt = left_salt.when(F.xxhash64(_LEFT_KEY).isin(hot), spread)
        every = F.sequence(F.lit(0), F.lit(salts - 1))
        right_salt = F.explode(F.when(F.xxhash64(_KEY).isin(hot), every).otherwise(F.array(F.lit(0))))
    side = side.withColumn(_SALT, right_salt)
    if not unique:
        side = one_row_per_key(side, [_KEY, _SALT])
    salted = keyed.withColumn(_LEFT_SALT, left_salt.otherwise(F.lit(0)))
    on = (F.col(_LEFT_KEY) == F.col(_KEY)) & (F.col(_LEFT_SALT) == F.col(_SALT))
    joined = salted.join(side, on, how).drop(_LEFT_KEY, _LEFT_SALT)
    return joined.drop(_KEY, _SALT) if keeps_right else joined


def _row_hash(df: DataFrame) -> Column:
    """Hash of all columns that can be hashed. It is the same when a lost task runs again, which a
    random number would not be, so no row can change its salt between attempts."""
    return F.xxhash64(*comparable_columns(df))


def lookup(
    left: DataFrame,
    dimension: DataFrame,
    link: Column | str,
    key: str,
    take: dict[str, str],
    matched: str,
    optional: bool = False,
    unique: bool = False,
    rows_of: DataFrame | None = None,
    links_in: DataFrame | None = None,
) -> DataFrame:
    """Fetch the columns ``take`` (output -> dimension column) and the flag ``matched``.

    The flag tells a lookup miss from a matched row whose value is NULL. With ``optional`` a link of
    zero means no link. Never adds rows: duplicates of a dimension key are reduced first, unless
    the caller states that the key is ``unique``.
    """
    link = F.col(link) if isinstance(link, str) else link
    side = dimension.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("__id"), *[F.col(source).alias(out) for out, source in take.items()]
    )
    side = side.withColumn(matched, F.lit(True))
    wanted = F.when(is_linked(link), link) if optional else link
    return keyed_join(left, side, wanted, "__id", "left", unique, rows_of, links_in).withColumn(matched, F.coalesce(F.col(matched), F.lit(False)))


def or_default(matched: str, value: Column | str, default: object) -> Column:
    """The looked-up value of a match (NULL included), else the default of a miss."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(F.col(matched), value).otherwise(F.lit(default))


def when_matched(matched: str, value: Column | str) -> Column:
    """An attribute that exists only for linked rows."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(F.col(matched), value)


def related_rows(children: DataFrame, fk: str, keys: DataFrame, key: str) -> DataFrame:
    """Child rows whose ``fk`` is one of ``keys``."""
    wanted = keys.select(key).filter(F.col(key).isNotNull()).distinct()
    return keyed_join(children, wanted, fk, key, "left_semi")
