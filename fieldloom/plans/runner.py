"""Stages from scenes to masks, as written tables that a later run can start from."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

STAGES = ("download", "ndvi", "classify", "weightmaps")


class GateError(RuntimeError):
    """A stage's input is missing."""


def active_stages(start: str = "download", stop: str = "weightmaps") -> list[str]:
    """The stages from ``start`` to ``stop``; an error if they are out of order."""
    a, b = STAGES.index(start), STAGES.index(stop)
    if b < a:
        raise ValueError(f"{stop} comes before {start}")
    return list(STAGES[a : b + 1])


@dataclass
class Runner:
    """Runs stage functions (spark, tables) -> {name: DataFrame}; each table is Parquet below ``root``.

    ``ground_truth`` is the table that classify needs.  Without it the ``bootstrap`` function, if any,
    writes a first version and the run stops there, for a person to complete it.
    """

    root: str
    stages: dict[str, Callable[[SparkSession, Runner], dict[str, DataFrame]]]
    ground_truth: str = "ground_truth"
    bootstrap: Callable[[SparkSession, Runner], DataFrame] | None = None
    done: list[str] = field(default_factory=list)

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def exists(self, spark: SparkSession, name: str) -> bool:
        where = spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        if not self.exists(spark, name):
            raise GateError(f"table {name} is missing; run the stage that writes it")
        return spark.read.parquet(self.path(name))

    def write(self, name: str, df: DataFrame) -> None:
        """Write beside the table, then swap by renaming: the old table goes last, so a failure leaves one of the two."""
        spark, target = df.sparkSession, self.path(name)
        df.write.mode("overwrite").parquet(target + ".new")
        jvm = spark._jvm.org.apache.hadoop.fs.Path
        fs = jvm(target).getFileSystem(spark._jsc.hadoopConfiguration())
        fs.delete(jvm(target + ".old"), True)
        had = fs.exists(jvm(target))
        if had and not fs.rename(jvm(target), jvm(target + ".old")):
            raise OSError(f"could not move {target} aside")
        if not fs.rename(jvm(target + ".new"), jvm(target)):
            if had:
                fs.rename(jvm(target + ".old"), jvm(target))
            raise OSError(f"could not rename {target}.new")
        fs.delete(jvm(target + ".old"), True)

    def run(self, spark: SparkSession, start: str = "download", stop: str = "weightmaps") -> list[str]:
        """Run the active stages in order; returns those that ran."""
        for stage in active_stages(start, stop):
            if stage == "classify" and not self.exists(spark, self.ground_truth):
                if self.bootstrap is None:
                    raise GateError(f"{self.ground_truth} is missing: digitise it or give a bootstrap")
                self.write(self.ground_truth, self.bootstrap(spark, self))
                return self.done
            for name, df in self.stages[stage](spark, self).items():
                self.write(name, df)
            self.done.append(stage)
        return self.done
