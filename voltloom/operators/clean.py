"""Repair of flat topology rows: missing numbers and categories from the substation, parallel edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import code_suffix
from ..schemas import CABLE_TYPES, PHASE_MATERIALS
from ..sources.scratch import materialise

#: A group is large if it has more than one of so many of the rows.
LARGE = 1000

NUMBERS = ("cable_capacity", "cable_length", "phase_size", "resistance", "reactance", "lv_feeder_fuse_size")
CATEGORIES = {"cable_type": CABLE_TYPES, "phase_material": PHASE_MATERIALS}


def fill_numbers(df: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """Fill nulls with the group's mean, else the mean of all; both are rounded half to even to whole numbers."""
    return fill(df, columns, {}, group)


def modes(df: DataFrame, column: str, domain: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The commonest value of each group; of equally common ones the first of the domain."""
    rank = F.array_position(F.array(*map(F.lit, domain)), F.col(column))
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count("*").alias("_n"))
    best = F.max_by(column, F.struct("_n", -rank)).alias(f"_mode_{column}")
    return counts.groupBy(*by).agg(best)


def fill(df: DataFrame, numbers: Sequence[str], categories: dict[str, Sequence[str]], group: str) -> DataFrame:
    """Fill nulls from the group, else from all rows: numbers as in :func:`fill_numbers`; categories with the mode (of equally
    common values the first of the domain), where values outside the domain count as missing and the mode of all is that of
    the rows that groups have filled.

    One aggregation of the rows by group yields counts of the domains' values and sums; modes, means and the single row for
    all rows, which is broadcast, follow from its result. Groups of more than a thousandth of the rows, a thousand at most, are broadcast
    too: shuffled, all rows of such a group would come to one task.
    """
    out = df.withColumns({c: F.when(F.col(c).isin(*d), F.col(c)) for c, d in categories.items()})
    values = [(c, i, v) for c, domain in categories.items() for i, v in enumerate(domain)]
    groups = out.groupBy(F.col(group).alias("_group")).agg(
        F.count("*").alias("_rows"),
        *(F.count_if(F.col(c) == v).alias(f"_n_{c}_{i}") for c, i, v in values),
        *(f(F.col(c).cast("double")).alias(f"_{k}_{c}") for c in numbers for k, f in (("s", F.sum), ("m", F.count))),
    )

    def mode(c: str, count) -> Column:
        ranked = [F.struct(count(c, i).alias("n"), F.lit(-i), F.lit(v).alias("v")) for i, v in enumerate(categories[c])]
        return F.array_max(F.filter(F.array(*ranked), lambda x: x["n"] > 0))["v"]

    grouped = F.col("_group").isNotNull()
    groups = groups.withColumns({f"_g_{c}": F.when(grouped, mode(c, lambda c, i: F.col(f"_n_{c}_{i}"))) for c in categories})
    groups = groups.withColumns({f"_g_{c}": F.when(grouped, F.bround(F.try_divide(f"_s_{c}", f"_m_{c}"), 0)) for c in numbers})

    def filled(c: str, i: int):  # rows with a value after the group's mode is filled in
        known = sum((F.col(f"_n_{c}_{j}") for j in range(len(categories[c]))), F.lit(0))
        return F.coalesce(F.sum(F.col(f"_n_{c}_{i}") + F.when(F.col(f"_g_{c}") == categories[c][i], F.col("_rows") - known).otherwise(0)), F.lit(0))

    groups = materialise(groups, "groups")
    overall = groups.agg(
        *(mode(c, filled).alias(f"_a_{c}") for c in categories),
        *(F.bround(F.try_divide(F.sum(f"_s_{c}"), F.sum(f"_m_{c}")), 0).alias(f"_a_{c}") for c in numbers),
    )
    columns = [*numbers, *categories]
    total = groups.agg(F.sum("_rows").alias("_all"))
    large = groups.where(grouped).crossJoin(F.broadcast(total)).where(F.col("_rows") * LARGE > F.col("_all"))
    large = large.select(F.col("_group").alias(group), F.struct(*(f"_g_{c}" for c in columns)).alias("_large"))
    out = out.join(F.broadcast(large), group, "left")
    rest = groups.where(grouped).crossJoin(F.broadcast(total)).where(F.col("_rows") * LARGE <= F.col("_all"))
    if rest.isEmpty():
        out = out.withColumns({f"_g_{c}": F.col(f"_large._g_{c}") for c in columns})
    else:  # rows of large groups and without a group are spread: no key of theirs is one of the rest
        spread = F.struct(F.lit(None).cast(df.schema[group].dataType).alias("g"), F.pmod(F.xxhash64(*df.columns), F.lit(1 << 20)).alias("n"))
        own = F.struct(F.col(group).alias("g"), F.lit(-1).cast("long").alias("n"))
        out = out.withColumn("_key", F.when(F.col(group).isNull() | F.col("_large").isNotNull(), spread).otherwise(own))
        rest = rest.select(F.struct(F.col("_group").alias("g"), F.lit(-1).cast("long").alias("n")).alias("_key"), F.struct(*(f"_g_{c}" for c in columns)).alias("_rest"))
        out = out.join(rest, "_key", "left").withColumns({f"_g_{c}": F.coalesce("_large", "_rest")[f"_g_{c}"] for c in columns})
    out = out.crossJoin(F.broadcast(overall))
    return out.withColumns({c: F.coalesce(F.col(c).cast("double") if c in numbers else F.col(c), f"_g_{c}", f"_a_{c}") for c in columns}).select(*df.columns)


def fill_categories(df: DataFrame, categories: dict[str, Sequence[str]], group: str) -> DataFrame:
    """Values outside the domain count as missing; missing ones take the group's mode, else that of all rows."""
    return fill(df, [], categories, group)


def drop_parallel(df: DataFrame, keys: Sequence[str], capacity: str, order: Sequence[str]) -> DataFrame:
    """One row of each key: that of the largest capacity, of equal ones the first by ``order``. Null keys or capacities go."""
    w = Window.partitionBy(*keys).orderBy(F.desc(capacity), *order)
    known = df.where(" and ".join(f"`{c}` is not null" for c in [*keys, capacity]))
    return known.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def clean_topology(topology: DataFrame) -> DataFrame:
    """All repairs of a flat topology file. Ends are compared by what follows their type, in the given direction."""
    helped = topology.withColumns({"_n1": code_suffix(F.col("node1")), "_n2": code_suffix(F.col("node2")), "_sub": code_suffix(F.col("secondary_substation"))})
    numbers = [c for c in NUMBERS if c in topology.columns]
    helped = fill(helped, numbers, {c: d for c, d in CATEGORIES.items() if c in topology.columns}, "_sub")
    return drop_parallel(helped, ["_n1", "_n2"], "cable_capacity", ["cable_id"]).select(*topology.columns)


def clean_meter_cabinet(rows: DataFrame, meter: str = "meter_number") -> DataFrame:
    return rows.where(F.col(meter).isNotNull())
