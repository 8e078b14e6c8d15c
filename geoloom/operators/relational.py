"""Composite relational operators: representatives, modes, table maintenance, ids, completeness, constraints, differences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.functions.text import free_name
from geoloom.operators.lineage import checkpointed


def representative(rows: DataFrame, keys: Sequence[str], tie_break: str) -> DataFrame:
    """One whole row per key, that with the least `tie_break`; combined before the shuffle."""
    picked = rows.groupBy(*keys).agg(F.min_by(F.struct(*rows.columns), F.col(tie_break)).alias("row"))
    return picked.select("row.*")


def modal_value(counts: DataFrame, keys: Sequence[str], value: str, at: str) -> DataFrame:
    """Per key the most frequent value, the least of equally frequent ones, and the earliest `at` that has it."""
    freq = counts.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("freq"), F.min(at).alias("first_at"))
    best = F.max(F.struct(F.col("freq"), (-F.col(value)).alias("order"), F.col(value).alias("value"), F.col("first_at"))).alias("best")
    return freq.groupBy(*keys).agg(best).select(*keys, F.col("best.value").alias(value), F.col("best.first_at").alias(at))


def insert_absent(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table and those rows whose key it doesn't have; of rows that share a key one is added."""
    return table.unionByName(rows.dropDuplicates(list(keys)).join(table, list(keys), "left_anti"))


def update_from(table: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The table with `columns` taken from the change row of the same key, where there is one."""
    marked = changes.select(*keys, F.lit(True).alias("is_changed"), *[F.col(c).alias(f"changed_{c}") for c in columns])
    joined = table.join(marked, list(keys), "left")
    return joined.select(*[F.when(F.col("is_changed"), F.col(f"changed_{c}")).otherwise(table[c]).alias(c) if c in columns else table[c] for c in table.columns])


def delete_using(table: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table without rows whose key is among `gone`."""
    return table.join(gone, list(keys), "left_anti")


def running_total(rows: DataFrame, order: Sequence[str], value: Column, name: str) -> DataFrame:
    """The sum of a value over all rows up to and with each row in a total order, without gathering rows in one task.

    Rows are range-partitioned and kept (their partitions must not be drawn anew), totalled within each partition, and
    moved on by the totals of the partitions before it: a table of one row per partition.
    """
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    part, own, inside, before = (free_name(rows.columns, x) for x in ("part_id", "part_value", "part_sum", "part_offset"))
    ranged = rows.withColumn(own, value.cast("long")).repartitionByRange(parts, *order)
    kept = checkpointed(ranged.withColumn(part, F.spark_partition_id()))
    within = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = kept.groupBy(part).agg(F.sum(own).alias("total"))
    earlier = F.coalesce(F.sum("total").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = totals.select(part, earlier.alias(before))
    out = kept.withColumn(inside, F.sum(own).over(within)).join(offsets, part)
    return out.withColumn(name, F.col(before) + F.col(inside)).drop(*[x for x in (part, own, inside, before) if x != name])


def numbered(rows: DataFrame, order: Sequence[str], name: str = "id", start: int = 1) -> DataFrame:
    """Consecutive numbers in a total order."""
    return running_total(rows, order, F.lit(1), "running_number").withColumn(name, F.col("running_number") + (start - 1)).drop("running_number")


def rebased(rows: DataFrame, id_column: str, last: int) -> DataFrame:
    """Ids replaced by last + 1, last + 2, ... in their order; the old id stays as `old_<id>`."""
    return numbered(rows, [id_column], "new_number", last + 1).withColumnRenamed(id_column, f"old_{id_column}").withColumnRenamed("new_number", id_column)


def completeness(rows: DataFrame, columns: Sequence[str], category: str | None = None) -> DataFrame:
    """(category, column_name, percentage): share of rows whose column is neither null nor blank, one pass over the rows."""
    group = F.col(category) if category else F.lit(None).cast("string")
    filled = lambda c: F.when(F.trim(F.col(c).cast("string")) != "", 1).otherwise(0)
    shares = rows.groupBy(group.alias("category")).agg(*[F.round(100.0 * F.sum(filled(c)) / F.nullif(F.count(F.lit(1)), F.lit(0)), 2).alias(c) for c in columns])
    long = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("percentage")) for c in columns]))
    return shares.select("category", long.alias("x")).select("category", "x.*")


def violations(rows: DataFrame, key: str, rules: Mapping[str, Column]) -> DataFrame:
    """(key, rule) of each rule that a row breaks: its condition is false; null is no violation. One pass."""
    broken = F.filter(F.array(*[F.struct(F.lit(n).alias("rule"), (~c).alias("broken")) for n, c in rules.items()]), lambda x: F.coalesce(x["broken"], F.lit(False)))
    return rows.select(F.col(key), F.explode(broken).alias("x")).select(key, "x.rule")


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphans(rows: DataFrame, parents: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Rows whose reference isn't null and names no parent."""
    ids = parents.select(F.col(parent_key).alias("parent_id"))
    return rows.where(F.col(key).isNotNull()).join(ids, F.col(key) == F.col("parent_id"), "left_anti")


def same_schema(a: DataFrame, b: DataFrame) -> dict[str, set]:
    """Columns (name, type) that only one side has; both empty if the schemas agree."""
    left, right = ({(f.name, f.dataType.simpleString()) for f in x.schema} for x in (a, b))
    return {"only_left": left - right, "only_right": right - left}


def difference(old: DataFrame, new: DataFrame, keys: Sequence[str], exclude: Sequence[str] = (), null_aware: bool = True, with_delete: bool = True) -> DataFrame:
    """Reviewable difference of two versions of a table: keys, new values, `<column>_check` and `action`.

    action is insert, update or delete; rows that are equal are left out. Checks are changed, unchanged or excluded;
    with null_aware=False a change to or from null counts as unchanged. Both sides meet once, in one full join.
    """
    columns = [c for c in new.columns if c not in keys]
    a = old.select(*keys, F.struct(*columns).alias("old_row"))
    b = new.select(*keys, F.struct(*columns).alias("new_row"))
    both = a.join(b, list(keys), "full")

    def differs(c: str) -> Column:
        x, y = F.col(f"old_row.{c}"), F.col(f"new_row.{c}")
        return ~x.eqNullSafe(y) if null_aware else F.coalesce(x != y, F.lit(False))

    checked = [c for c in columns if c not in exclude]
    changed = F.lit(False)
    for c in checked:
        changed = changed | differs(c)
    action = F.when(F.col("old_row").isNull(), "insert").when(F.col("new_row").isNull(), "delete").when(changed, "update")
    check = lambda c: (F.lit("excluded") if c in exclude else F.when(F.col("old_row").isNull() | F.col("new_row").isNull(), None).when(differs(c), "changed").otherwise("unchanged")).alias(f"{c}_check")
    out = both.withColumn("action", action).where("action is not null")
    if not with_delete:
        out = out.where("action <> 'delete'")
    value = lambda c: F.when(F.col("new_row").isNull(), F.col(f"old_row.{c}")).otherwise(F.col(f"new_row.{c}")).alias(c)
    return out.select(*keys, *[x for c in columns for x in (value(c), check(c))], "action")


def applied(old: DataFrame, diff: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The old table after a difference: inserts added, updates in place (changed columns only), deletes gone."""
    columns = [c for c in old.columns if c not in keys]
    marked = diff.select(*keys, F.struct(*columns, *[f"{c}_check" for c in columns], "action").alias("d"))
    joined = old.select(*keys, F.struct(*columns).alias("o")).join(marked, list(keys), "full").where("d is null or d.action <> 'delete'")
    pick = lambda c: F.when((F.col("d.action") == "insert") | (F.col(f"d.{c}_check") == "changed"), F.col(f"d.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
    return joined.select(*keys, *[pick(c) for c in columns]).select(*old.columns)


def allocated(parts: DataFrame, area: str, weight: str, total: str, name: str = "allocated", digits: int | None = None) -> DataFrame:
    """Each area's total shared among its parts by weight; areas whose weights sum to null or zero allocate nothing.

    Sums are combined before they are shuffled and join back, so one area may hold most parts.
    """
    key, sum_of = free_name(parts.columns, "area_key"), free_name(parts.columns, "area_weight")
    sums = parts.groupBy(F.col(area).alias(key)).agg(F.sum(weight).alias(sum_of))
    share = F.col(total) * F.try_divide(F.col(weight), F.col(sum_of))
    joined = parts.join(sums, parts[area] == F.col(key)).where(F.col(sum_of).isNotNull() & (F.col(sum_of) != 0))
    return joined.withColumn(name, F.round(share, digits) if digits is not None else share).drop(key, sum_of)
