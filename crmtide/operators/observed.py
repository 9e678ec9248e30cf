"""Quality rules counted while a model is written."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from crmtide.operators.quality import violations

FINDING = "check_name string, column_name string, value string, violations bigint"


class Watched:
    """A frame whose null and value rules are counted by whatever action runs it first.

    Write ``df`` somewhere, then ask for ``findings`` of what was written.
    """

    def __init__(self, df: DataFrame, required: Sequence[str] = (), accepted: Mapping[str, Sequence[str]] | None = None) -> None:
        self.required, self.accepted = list(required), dict(accepted or {})
        counters: list[Column] = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in self.required]
        counters += [F.count_if(~F.col(c).isin(list(v))).alias(f"value_{c}") for c, v in self.accepted.items()]
        self._seen = Observation() if counters else None
        self.df = df.observe(self._seen, *counters) if counters else df

    def findings(self, written: DataFrame) -> DataFrame:
        """(check_name, column_name, value, violations); ``written`` is read only to name unaccepted values, if there are any."""
        counts = self._seen.get if self._seen else {}
        nulls = [("not_null", c, None, counts[f"null_{c}"]) for c in self.required if counts[f"null_{c}"]]
        found = written.sparkSession.createDataFrame(nulls, FINDING)
        broken = {c: v for c, v in self.accepted.items() if counts[f"value_{c}"]}
        return found.unionByName(violations(written, accepted=broken)) if broken else found


def unique_grain_by_print(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``quality.unique_grain``: key values held by more than one row, exactly.

    What is shuffled for every row is a 64-bit print of its key, combined before
    the shuffle. Only rows whose print is there twice, repeats and the rare
    collision, are then grouped by the key itself.
    """
    rows = df.select(*keys, F.xxhash64(*[F.col(k).cast("string") for k in keys]).alias("_print"))
    twice = rows.groupBy("_print").agg(F.count("*").alias("n")).filter("n > 1").select("_print")
    suspects = rows.join(twice, "_print", "left_semi")
    return suspects.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")
