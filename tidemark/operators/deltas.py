"""Tables kept up from change rows alone.

A weighted frame holds rows and `__weight`: how many of the row there are, or,
in a change, how many come (above zero) and go (below). Weights of projections
carry over, those of joins multiply, those of groups add up, so the change of
each shape follows from the changes of its inputs.

State is a weighted table too: a folder of Parquet with one part per cycle,
which holds that cycle's change rows only. Its current content is the sum of
all parts. A cycle written again replaces its part, so a retry changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType

from tidemark.functions import null_safe

WEIGHT = "__weight"
_CYCLE = "__cycle"


def weighted(df: DataFrame, weight: int = 1) -> DataFrame:
    return df.withColumn(WEIGHT, F.lit(weight).cast("bigint"))


def from_feed(feed: DataFrame) -> DataFrame:
    """A feed of DELETE and INSERT rows as a weighted change."""
    weight = F.when(F.col("action") == "INSERT", 1).otherwise(-1).cast("bigint")
    return feed.withColumn(WEIGHT, weight).drop("action")


def net(frame: DataFrame, *parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sum of weighted frames; rows that cancel out go. Tasks add up their own rows first.

    With `by`, rows are dealt by those columns before they are added up, so that a join on them
    deals the sum no more: for large changes, as a small one could be broadcast once it is summed.
    """
    for part in parts:
        frame = frame.unionByName(part)
    if by:
        frame = frame.repartition(*[F.col(f"`{c}`") for c in by])
    columns = [F.col(f"`{c}`") for c in frame.columns if c != WEIGHT]
    return frame.groupBy(*columns).agg(F.sum(WEIGHT).alias(WEIGHT)).where(f"{WEIGHT} <> 0")


def negated(frame: DataFrame) -> DataFrame:
    return frame.withColumn(WEIGHT, -F.col(WEIGHT))


def as_rows(frame: DataFrame) -> DataFrame:
    """Each row as often as its weight says."""
    return net(frame).withColumn(WEIGHT, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(WEIGHT)))).drop(WEIGHT)


class WeightedTable:
    """A weighted frame stored as one part of change rows per cycle.

    Parts have the columns and types of the first one: those of later changes
    are cast, and a change with other columns is refused.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path

    def put(self, change: DataFrame, cycle: int) -> DataFrame:
        part, kinds = f"{self._path}/{_CYCLE}={cycle}", self._kinds()
        if kinds:
            if set(kinds) != set(change.columns):
                raise ValueError(f"columns {sorted(change.columns)} instead of {sorted(kinds)}")
            change = change.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in kinds.items()])
        change.write.mode("overwrite").parquet(part)
        return self._spark.read.parquet(part)

    def _kinds(self) -> dict[str, DataType]:
        """Types by column, none while nothing was put."""
        try:
            fields = self._spark.read.parquet(self._path).schema.fields
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        return {f.name: f.dataType for f in fields if f.name != _CYCLE}

    def upto(self, cycle: int) -> DataFrame:
        """All parts up to a cycle, not yet summed up."""
        return (self._spark.read.option("basePath", self._path).parquet(self._path)
                .where(F.col(_CYCLE) <= cycle).drop(_CYCLE))

    def rows(self, cycle: int) -> DataFrame:
        return as_rows(self.upto(cycle))

    def compact(self, cycle: int, target: str) -> WeightedTable:
        """The same content up to a cycle as a single part of another folder."""
        table = WeightedTable(self._spark, target)
        table.put(net(self.upto(cycle)), cycle)
        return table


# -- projection and join ----------------------------------------------------------------

def projected(change: DataFrame, *columns: Column | str) -> DataFrame:
    """The change of a projection is the projection of the change."""
    return net(change.select(*columns, WEIGHT))


def joined(left_before: DataFrame, left_change: DataFrame, right_after: DataFrame, right_change: DataFrame,
           on: Sequence[str]) -> DataFrame:
    """Change of an inner join: the left change with all of the right, and all of the left with the right change.

    `left_before` and `right_after` are plain rows before and after the cycle. A
    change that is small against its table is broadcast by its measured size,
    so the tables are read but not shuffled.
    """
    first = left_change.join(right_after, list(on))
    second = left_before.join(right_change, list(on)).select(*first.columns)
    return net(first, second)


# -- groups -----------------------------------------------------------------------------

@dataclass(frozen=True)
class Measure:
    """A measure of a group: rows, sum, min, max, distinct or any (of a boolean)."""

    name: str
    kind: str
    column: str | None = None

    def __post_init__(self) -> None:
        if self.kind not in _COUNTED or (self.column is None) != (self.kind == "rows"):
            raise ValueError(f"{self.name}: {self.kind} of {self.column}")


#: Over the distinct rows of a group, each with its weight.
_COUNTED = {
    "rows": lambda c: F.sum(WEIGHT),
    "sum": lambda c: F.sum(F.col(c) * F.col(WEIGHT)),
    "min": F.min, "max": F.max, "distinct": F.count_distinct,
    "any": lambda c: F.coalesce(F.bool_or(c), F.lit(False)),
}
_ADDED = ("rows", "sum")


class KeptGroups:
    """A grouped table kept up from the change rows of its input.

    Counts and sums alone need one state row per group: they add up. A minimum,
    maximum or distinct count cannot be undone from its value, so with one of
    them the state counts every distinct row of measured columns in its group;
    a group that changes is measured anew from those counts. The input is not
    read again. Floating sums are added in no fixed order: use decimals.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], measures: Sequence[Measure]):
        self.keys, self.measures = list(keys), list(measures)
        self._state = WeightedTable(spark, path)
        self._added = all(m.kind in _ADDED for m in measures)
        self._columns = sorted({m.column for m in measures if m.column})

    def start(self, rows: DataFrame, cycle: int = 0) -> DataFrame:
        """State of the rows as they are; the grouped table."""
        self.apply(weighted(rows), cycle)
        return self.current(cycle)

    def apply(self, change: DataFrame, cycle: int) -> DataFrame:
        """Add the change rows of a cycle; the keys they touch."""
        return self._state.put(self._summed(change), cycle).select(*self.keys).distinct()

    def current(self, cycle: int, of: DataFrame | None = None) -> DataFrame:
        """The grouped table after a cycle, or its rows for the keys `of`."""
        state = self._state.upto(cycle)
        if of is not None:
            state = state.join(F.broadcast(of) if _small(of) else of, self._same(state, of), "left_semi")
        return self._measured(state)

    def change(self, cycle: int, touched: DataFrame) -> DataFrame:
        """How the grouped table changed by a cycle that touched these keys."""
        before = negated(weighted(self.current(cycle - 1, touched)))
        return net(before, weighted(self.current(cycle, touched)))

    def _same(self, state: DataFrame, of: DataFrame) -> Column:
        return null_safe(state, of, self.keys)

    def _summed(self, change: DataFrame) -> DataFrame:
        if not self._added:
            return net(change.select(*self.keys, *[c for c in self._columns if c not in self.keys], WEIGHT))
        sums = [F.sum(F.col(c) * F.col(WEIGHT)).alias(f"__sum_{c}") for c in self._columns]
        filled = [F.sum(F.when(F.col(c).isNotNull(), F.col(WEIGHT))).alias(f"__filled_{c}") for c in self._columns]
        return change.groupBy(*self.keys).agg(F.sum(WEIGHT).alias(WEIGHT), *sums, *filled)

    def _measured(self, state: DataFrame) -> DataFrame:
        if not self._added:
            groups = net(state).groupBy(*self.keys)
            return groups.agg(*[_COUNTED[m.kind](m.column).alias(m.name) for m in self.measures])
        parts = [c for c in state.columns if c not in self.keys]
        groups = state.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in parts]).where(f"{WEIGHT} <> 0")
        return groups.select(*self.keys, *[
            F.col(WEIGHT).alias(m.name) if m.kind == "rows" else
            F.when(F.col(f"__filled_{m.column}") > 0, F.col(f"__sum_{m.column}")).alias(m.name) for m in self.measures])


def _small(keys: DataFrame, limit: int = 100_000) -> bool:
    return keys.limit(limit + 1).count() <= limit


def left_joined(master_before: DataFrame, master_change: DataFrame, groups: KeptGroups, cycle: int,
                touched: DataFrame, zero: Sequence[str] = ()) -> DataFrame:
    """Change of a master with its groups on the left join's key, 0 in `zero` where there is no group.

    Master rows that changed, and those that stayed on keys the cycle touched,
    meet the groups after the cycle in one join; those that stayed also meet the
    groups before it and are taken away. `master_change` is read three times:
    give a stored one.
    """
    keys = groups.keys

    def beside(rows: DataFrame, at: int, of: DataFrame) -> DataFrame:
        found = groups.current(at, of)
        named = found.select(*[F.col(k).alias(f"__{k}") for k in keys], *[m.name for m in groups.measures])
        out = rows.join(named, null_safe(rows, named, keys, "__"), "left").drop(*[f"__{k}" for k in keys])
        return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in zero}) if zero else out

    stayed = weighted(master_before.join(touched, null_safe(master_before, touched, keys), "left_semi"))
    involved = master_change.select(*keys).unionByName(touched).distinct()
    return net(beside(master_change.unionByName(stayed), cycle, involved),
               beside(negated(stayed), cycle - 1, touched))
