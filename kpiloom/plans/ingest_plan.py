"""Two incremental batches over the derived CRM source, as DataFrames.

Batch 1 loads the source as it stood at ``AS_OF`` (mark ''). Batch 2 loads
the later source -- everything after the cut-off plus the corrected voids --
from batch 1's real high-water mark. Only the seven marks reach the driver.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.vocabulary import TABLES
from kpiloom.operators import ingest, mart, staging
from kpiloom.plans.models import Models
from kpiloom.sources.crm import corrected_payments

AS_OF = "1999-01-01 00:00:00"
BATCH_1, BATCH_2 = "b000000000001", "b000000000002"
LOADED_1, LOADED_2 = dt.datetime(2026, 1, 1, 6, 0, 0), dt.datetime(2026, 1, 2, 6, 0, 0)


class TwoBatches:
    def __init__(self, raw: dict[str, DataFrame]):
        self.raw = raw

    @cached_property
    def source_1(self) -> dict[str, DataFrame]:
        return {t: self.raw[t].where(F.col("updated_at") <= F.lit(AS_OF)) for t in TABLES}

    @cached_property
    def source_2(self) -> dict[str, DataFrame]:
        s = {t: self.raw[t] for t in TABLES}
        s["payments"] = corrected_payments(s["payments"])
        return s

    @cached_property
    def batch_1(self) -> dict[str, DataFrame]:
        return {t: ingest.load_frame(self.source_1[t], "", BATCH_1, LOADED_1) for t in TABLES}

    @cached_property
    def _stats_1_rows(self) -> list:
        # one job; one row per table -- the loader reads the same seven scalars
        return ingest.batch_stats(self.batch_1).collect()

    @cached_property
    def stats_1(self) -> DataFrame:
        """Batch 1's (table_name, rows_loaded, batch_mark), reused from the rows
        already computed for the marks instead of aggregating the tables again."""
        spark = next(iter(self.batch_1.values())).sparkSession
        return spark.createDataFrame([tuple(r) for r in self._stats_1_rows],
                                     "table_name string, rows_loaded long, batch_mark string")

    @cached_property
    def marks_1(self) -> dict[str, str]:
        """Batch 1's high-water mark of every table: seven scalars."""
        return {r["table_name"]: r["batch_mark"] or "" for r in self._stats_1_rows}

    def mark_1(self, table: str) -> str:
        """One table's mark, without computing the other six tables' batches."""
        if "_stats_1_rows" in self.__dict__:
            return self.marks_1[table]
        row = ingest.batch_stats({table: self.batch_1[table]}).first()
        return row["batch_mark"] or ""

    @cached_property
    def batch_2(self) -> dict[str, DataFrame]:
        return _LazyBatches(lambda t: ingest.load_frame(self.source_2[t], self.mark_1(t), BATCH_2, LOADED_2))

    @cached_property
    def stats_2(self) -> DataFrame:
        self.marks_1                       # all seven marks in one job
        return ingest.batch_stats({t: self.batch_2[t] for t in TABLES})

    @cached_property
    def state_1(self) -> DataFrame:
        return ingest.advance_watermarks(None, self.stats_1)

    @cached_property
    def state_2(self) -> DataFrame:
        return ingest.advance_watermarks(self.state_1, self.stats_2)

    def upserted(self, table: str) -> DataFrame:
        return ingest.merge_deltas(self.batch_1[table], [(self.batch_2[table], ingest.EXTRACT)], TABLES[table])

    # --- the KPI table after the second batch, recomputed for the months it touches only
    def changed(self, table: str) -> DataFrame:
        """Raw rows that batch 2 brought, and those of batch 1 that they replace."""
        key, new = TABLES[table], self.batch_2[table]
        return new.unionByName(self.batch_1[table].join(new.select(key).distinct(), key, "left_semi"))

    def refreshed_kpis(self) -> DataFrame:
        """Batch 1's KPI table with the touched months recomputed from the tables after batch 2."""
        self.marks_1                       # all seven marks in one job
        spark = next(iter(self.batch_1.values())).sparkSession
        before, after = Models(spark, self.batch_1), Models(spark, {t: self.upserted(t) for t in TABLES})
        axis = (after.first_month, after.last_month)
        # all that batch 2 brought or replaced is among the changed rows: the other rows of their customers are those that
        # were there before, read without merging the batches once more
        staged = {t: (after if t == "locations" else before).model(f"stg_{t}") for t in TABLES}
        touched = mart.touched_months(staging.stage_all({t: self.changed(t) for t in TABLES}), staged, *axis)
        months = [r["month_start"] for r in touched.collect()]          # at most one row a month of the axis
        again = mart.kpi_for_months(after.dim_location, after.fct_payments, after.fct_appointments, after.fct_membership_months,
                                    after.fct_leads, *axis, months)
        return mart.refresh_months(before.kpi_location_monthly, again, months, axis)

    def load_log(self) -> DataFrame:
        return ingest.log_rows(self.stats_1, self.state_1, BATCH_1, LOADED_1).unionByName(
            ingest.log_rows(self.stats_2, self.state_2, BATCH_2, LOADED_2))


class _LazyBatches(dict):
    """Second batches built on first access, so a one-table query builds one."""

    def __init__(self, build):
        super().__init__()
        self._build = build

    def __missing__(self, table: str) -> DataFrame:
        self[table] = self._build(table)
        return self[table]
