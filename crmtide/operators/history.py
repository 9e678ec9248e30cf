"""Change records to validity intervals: tombstones, repeats and records that come late or out of order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

VALID_FROM, VALID_TO = "valid_from", "valid_to"


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names])


def with_neighbour(df: DataFrame, keys: Sequence[str], at: str, value: str, name: str, step: int) -> DataFrame:
    """Adds ``name``: ``value`` of the key's row just before (-1) or after (1) in the order of ``at``.

    A window sees one key and one day only. Neighbours across days come from the
    first and last row of each of a key's days, so a key that holds a great part
    of all rows is many tasks, and its one window has a row a day.
    """
    day = "_day"
    rows = df.withColumn(day, F.to_date(at))
    local = Window.partitionBy(*keys, day).orderBy(at)
    inside = (F.lag if step < 0 else F.lead)(value).over(local)
    edge = F.max_by if step < 0 else F.min_by
    days = rows.groupBy(*keys, day).agg(edge(value, at).alias("_edge"))
    across = Window.partitionBy(*keys).orderBy(day)
    days = days.withColumn("_across", (F.lag if step < 0 else F.lead)("_edge").over(across)).drop("_edge")
    rows = rows.withColumn("_inside", inside).alias("r")
    joined = rows.join(days.alias("d"), _same("r", "d", [*keys, day]), "left")
    own = [F.col(f"r.{c}") for c in df.columns]
    return joined.select(*own, F.coalesce("r._inside", "d._across").alias(name))


def change_history(
    changes: DataFrame,
    keys: Sequence[str],
    at: str = "cdc_timestamp",
    operation: str = "operationType",
    deletes: Sequence[str] = ("DELETE",),
    ignored: Sequence[str] = (),
) -> DataFrame:
    """The versions of every key with ``valid_from`` and ``valid_to``; intervals of a key never overlap.

    A version begins with the change that brought it and ends with the key's next
    change, or stays open (NULL). A delete ends a version and makes none.
    Changes that say what is known already make none either: a record that came
    twice, an update that changes nothing but the columns ``ignored``, a delete of
    what is deleted. Of changes of one key at one time the last in the order of
    their content counts, deletes last of all, so the result depends on the set of
    changes and not on the order they came in. Records without a time cannot be
    put in order and are left out; a NULL in a key is a value like others.
    """
    plain = [f.name for f in changes.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    told = [c for c in plain if c not in (*keys, at, operation, *ignored)]
    gone = F.coalesce(F.col(operation).isin(list(deletes)), F.lit(False))
    marked = changes.filter(F.col(at).isNotNull()).withColumns(
        {"_gone": gone, "_state": F.when(gone, F.lit(None)).otherwise(F.struct(*told))}
    )
    row = F.struct(*[c for c in changes.columns if c not in (*keys, at)])
    order = F.struct("_gone", F.xxhash64(*[c for c in plain if c not in (*keys, at)]))
    one = marked.groupBy(*keys, at).agg(
        F.max_by(F.struct("_gone", "_state", row.alias("_row")), order).alias("_last")
    )
    one = one.select(*keys, at, "_last.*")
    value = F.struct(F.col("_gone").alias("gone"), F.col("_state").alias("state")).alias("_is")
    before = with_neighbour(one.withColumn("_is", value), keys, at, "_is", "_was", -1)
    new = F.coalesce(~F.col("_was").eqNullSafe(F.col("_is")), F.lit(True))
    nothing = F.col("_gone") & F.coalesce(F.col("_was.gone"), F.lit(True))
    changed = before.filter(new & ~nothing).drop("_was", "_is").withColumn("_at", F.col(at))
    ended = with_neighbour(changed, keys, at, "_at", VALID_TO, 1)
    versions = ended.filter(~F.col("_gone"))
    kept = [F.col(f"_row.{c}").alias(c) for c in changes.columns if c not in (*keys, at, operation)]
    return versions.select(*keys, *kept, F.col(at).alias(VALID_FROM), VALID_TO)


def as_of(history: DataFrame, when: Column) -> DataFrame:
    """The versions valid at a time."""
    return history.filter((F.col(VALID_FROM) <= when) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > when)))
