"""MERGE on any table: conditional updates, deletes and inserts, and clauses for
target rows that the source lacks, resolved to one action a key.

Both sides are tagged, united and grouped by the key: one shuffle, with both
sides' counts in the same aggregate, so a key that either side holds twice is
refused where it is met and costs no check of its own. The first clause whose
condition holds decides; a key that no clause takes stays as it is.

Conditions and values are SQL expressions over ``t`` (the target's row) and
``s`` (the source's), such as ``s.price > t.price``. Keys match NULL-safely, as
in ``upsert``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MATCHED, NOT_MATCHED, NOT_BY_SOURCE = "matched", "not_matched", "not_matched_by_source"


@dataclass(frozen=True)
class _Clause:
    when: str
    action: str
    condition: str | None = None
    values: dict[str, str] | None = None  # None: the source's columns of the same name


@dataclass
class Merge:
    """``Merge(target, source, keys)`` and its clauses, then ``actions()`` or ``result()``."""

    target: DataFrame
    source: DataFrame
    keys: list[str]
    clauses: list[_Clause] = field(default_factory=list)

    def _add(self, when: str, action: str, condition: str | None, values: dict[str, str] | None = None) -> Merge:
        if values:
            unknown = {c.lower() for c in values} - {c.lower() for c in self.target.columns}
            if unknown:
                raise ValueError(f"the target has no columns {sorted(unknown)}")
            if action == "update" and {c.lower() for c in values} & {c.lower() for c in self.keys}:
                raise ValueError("an update cannot change the key")
        self.clauses.append(_Clause(when, action, condition, values))
        return self

    def when_matched_update(self, values: dict[str, str] | None = None, condition: str | None = None) -> Merge:
        """Sets columns of the target; without ``values`` all that the source has, too."""
        return self._add(MATCHED, "update", condition, values)

    def when_matched_delete(self, condition: str | None = None) -> Merge:
        return self._add(MATCHED, "delete", condition)

    def when_not_matched_insert(self, values: dict[str, str] | None = None, condition: str | None = None) -> Merge:
        """Inserts a row; columns without a value are NULL."""
        return self._add(NOT_MATCHED, "insert", condition, values)

    def when_not_matched_by_source_update(self, values: dict[str, str], condition: str | None = None) -> Merge:
        return self._add(NOT_BY_SOURCE, "update", condition, values)

    def when_not_matched_by_source_delete(self, condition: str | None = None) -> Merge:
        return self._add(NOT_BY_SOURCE, "delete", condition)

    # -- plan ----------------------------------------------------------------
    def _paired(self) -> DataFrame:
        """One row a key: ``t`` and ``s`` (NULL where that side lacks it) and ``case``."""
        def side(df: DataFrame, name: str) -> DataFrame:
            row = F.struct(*[F.col(c) for c in df.columns])
            return df.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(self.keys)], row.alias(name))
        both = side(self.target, "t").unionByName(side(self.source, "s"), allowMissingColumns=True)
        keys = [f"__k{i}" for i in range(len(self.keys))]
        pair = both.groupBy(*keys).agg(F.first("t", ignorenulls=True).alias("t"), F.first("s", ignorenulls=True).alias("s"),
                                       F.count("t").alias("__nt"), F.count("s").alias("__ns"))
        named = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
        refuse = F.raise_error(F.concat(F.lit("MERGE: a side holds more than one row of the key "), named))
        case = (F.when((F.col("__nt") > 1) | (F.col("__ns") > 1), refuse.cast("string"))
                .when(F.col("__ns") == 0, F.lit(NOT_BY_SOURCE)).when(F.col("__nt") == 0, F.lit(NOT_MATCHED)).otherwise(F.lit(MATCHED)))
        return pair.select(*keys, "t", "s", case.alias("__case"))

    def _value(self, c: _Clause, name: str, at: int) -> Column:
        kind = self.target.schema[name].dataType
        given = {k.lower(): v for k, v in (c.values or {}).items()}
        theirs = {k.lower() for k in self.source.columns}
        if name.lower() in {k.lower() for k in self.keys} and name.lower() not in given:
            out = F.col(f"__k{at}")
        elif name.lower() in given:
            out = F.expr(given[name.lower()])
        elif c.values is None and name.lower() in theirs and c.when != NOT_BY_SOURCE:
            out = F.col("s")[name]
        else:
            out = F.col("t")[name]
        return out.cast(kind)

    def actions(self) -> DataFrame:
        """Each key's ``action`` (update, delete, insert, keep, or ignore for a source row that
        nothing takes) and the row it leads to: the new one, for a delete the one that goes."""
        paired = self._paired()
        which = F.lit(-1)
        for i in reversed(range(len(self.clauses))):
            c = self.clauses[i]
            holds = F.col("__case") == c.when
            if c.condition:
                holds = holds & F.coalesce(F.expr(c.condition), F.lit(False))
            which = F.when(holds, F.lit(i)).otherwise(which)
        chosen = paired.withColumn("__which", which)
        kept = F.when(F.col("__case") == NOT_MATCHED, F.lit("ignore")).otherwise(F.lit("keep"))
        action = kept
        for i, c in enumerate(self.clauses):
            action = F.when(F.col("__which") == i, F.lit(c.action)).otherwise(action)
        order = {k.lower(): i for i, k in enumerate(self.keys)}
        cols = []
        for name in self.target.columns:
            at = order.get(name.lower(), 0)
            mine = F.col("t")[name]
            out = F.when(F.col("__case") == NOT_MATCHED, self._value(_Clause(NOT_MATCHED, "insert"), name, at)).otherwise(mine)
            for i, c in enumerate(self.clauses):
                if c.action != "delete":
                    out = F.when(F.col("__which") == i, self._value(c, name, at)).otherwise(out)
            cols.append(out.alias(name))
        return chosen.select(action.alias("action"), *cols)

    def result(self) -> DataFrame:
        """The target after the merge."""
        return self.actions().where(~F.col("action").isin("delete", "ignore")).select(*self.target.columns)
