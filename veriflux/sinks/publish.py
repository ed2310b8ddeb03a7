"""Write, audit, publish: a delivery becomes visible day by day, and only the days that pass their gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from veriflux.operators.quality import Rules, passes
from veriflux.sinks.files import write_partitioned


class GatedTable:
    """A table by day. Each delivery is written once, below `path`, and looked at there. A day that passes is published by
    pointing the table's partition at the written files, so readers see the old day or the new one and never
    a part; a day that fails stays staged until a better delivery of it comes."""

    def __init__(self, spark: SparkSession, name: str, path: str, by: str = "transaction_date") -> None:
        self.spark, self.name, self.path, self.by = spark, name, path, by

    def _staged(self, delivery: str) -> str:
        return f"{self.path}/staged/{delivery}"

    def stage(self, rows: DataFrame, delivery: str) -> int:
        """Writes a delivery and returns its number of rows. Rows without a day are kept under the null day."""
        written = Observation()
        write_partitioned(rows.observe(written, F.count(F.lit(1)).alias("rows")), self._staged(delivery), [self.by])
        return written.get["rows"]

    def staged(self, delivery: str) -> DataFrame:
        return self.spark.read.parquet(self._staged(delivery))

    def audit(self, delivery: str, rules: Rules, max_failed_pct: float) -> DataFrame:
        """One row per day and rule: passed, failed, total, and whether the share of failures is within the limit."""
        counts = self.staged(delivery).groupBy(self.by).agg(
            F.count(F.lit(1)).alias("total"), *[F.count_if(passes(rule)).alias(name) for name, rule in rules.items()])
        by_rule = counts.unpivot([self.by, "total"], list(rules), "rule", "passed")
        failed = F.col("total") - F.col("passed")
        return by_rule.select(self.by, "rule", "passed", failed.alias("failed"), "total", (100 * failed <= max_failed_pct * F.col("total")).alias("holds"))

    def publish(self, rows: DataFrame, delivery: str, rules: Rules, max_failed_pct: float) -> DataFrame:
        """Stages a delivery, audits it and publishes the days that hold. Returns the audit, one row per day and rule. A delivery
        that comes again under its name replaces what it staged."""
        count = self.stage(rows, delivery)
        report = self.audit(delivery, rules, max_failed_pct).persist()
        days = report.groupBy(self.by).agg(F.bool_and("holds").alias("holds"), F.first("total").alias("total")).collect()
        if sum(r["total"] for r in days) != count:
            raise RuntimeError(f"{count} rows written, {sum(r['total'] for r in days)} staged")
        self._create(delivery)
        self._point([r[self.by] for r in days if r["holds"] and r[self.by] is not None], delivery)
        return report

    def _create(self, delivery: str) -> None:
        if not self.spark.catalog.tableExists(self.name):
            fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in self.staged(delivery).schema.fields]
            self.spark.sql(f"CREATE TABLE {self.name} ({', '.join(fields)}) USING parquet PARTITIONED BY (`{self.by}`) LOCATION '{self.path}/published'")

    def _point(self, days: Sequence, delivery: str) -> None:
        known = {r[0] for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()}
        for day in days:
            part, place = f"PARTITION (`{self.by}` = '{day}')", f"'{self._staged(delivery)}/{self.by}={day}'"
            if f"{self.by}={day}" in known:
                self.spark.sql(f"ALTER TABLE {self.name} {part} SET LOCATION {place}")
            else:
                self.spark.sql(f"ALTER TABLE {self.name} ADD {part} LOCATION {place}")
        self.spark.catalog.refreshTable(self.name)

    def table(self) -> DataFrame:
        """The published days."""
        return self.spark.table(self.name)
