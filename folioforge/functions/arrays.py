"""Array expressions that take time in proportion to an array's length, or to that of sorting it.

Spark's own lookups (array_position, array_contains, a map's keys) read the whole array for each element.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .charclass import let

#: Elements summed up one after another at least.
RUN = 64


def looked_up(keys: Column, table: Column) -> Column:
    """For each of `keys` the value that `table` (structs of key and value, keys distinct and not null) has for it; null if none.

    Keys and table are sorted together, a table's row before the keys equal to it. In that order a key's place, less its
    place among keys alone, says how many rows of the table stand before it: the last of them is the only one that can
    be its own.
    """

    def merged(t: Column) -> Column:
        rows = F.transform(t, lambda x: F.struct(x["key"].alias("key"), F.lit(-1).alias("i")))
        asked = F.transform(keys, lambda k, i: F.struct(k.alias("key"), i.alias("i")))
        placed = F.transform(F.array_sort(F.concat(rows, asked)), lambda x, m: F.struct(x["key"].alias("key"), x["i"].alias("i"), m.alias("m")))

        def found(x: Column, s: Column) -> Column:
            row = F.get(t, x["m"] - s - 1)
            return F.struct(x["i"].alias("i"), F.when(row["key"] == x["key"], row["value"]).alias("value"))

        return F.transform(F.array_sort(F.transform(F.filter(placed, lambda x: x["i"] >= 0), found)), lambda x: x["value"])

    return let(F.array_sort(table), merged)


def heads(ordered: Column, field: str = "key") -> Column:
    """The first element of each run of equal `field`s."""
    return F.filter(ordered, lambda x, i: (i == 0) | ~F.get(ordered, i - 1)[field].eqNullSafe(x[field]))


def running_before(lengths: Column) -> Column:
    """For each element the sum of those before it, as bigint.

    Sums grow by appending, which copies: so it's done within runs of as many elements as there are runs, and once over
    the runs' sums.
    """

    def one_by_one(a: Column) -> Column:
        start = F.struct(F.array().cast("array<bigint>").alias("found"), F.lit(0).cast("bigint").alias("at"))
        return F.aggregate(a, start, lambda acc, n: F.struct(F.concat(acc["found"], F.array(acc["at"])).alias("found"), (acc["at"] + n).alias("at")), lambda acc: acc["found"])

    def summed(runs: Column) -> Column:
        before = one_by_one(F.transform(runs, lambda x: F.aggregate(x, F.lit(0).cast("bigint"), lambda s, n: s + n)))
        return let(before, lambda b: F.flatten(F.transform(runs, lambda x, c: F.transform(one_by_one(x), lambda v: v + F.get(b, c)))))

    size = F.greatest(F.lit(RUN), F.ceil(F.sqrt(F.size(lengths))).cast("int"))
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / size).cast("int")), lambda c: F.slice(lengths, c * size + 1, size))
    return F.when(F.size(lengths) <= RUN, one_by_one(lengths)).otherwise(let(runs, summed))
