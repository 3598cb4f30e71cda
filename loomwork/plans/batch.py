"""The retail batch job: customers and transactions to published frames.

``run`` only declares frames.  Nothing is computed until a frame is published
or read, so unused frames cost nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions.dates import parse_date
from loomwork.functions.text import age_group, described, mask, part_of
from loomwork.operators.cleanse import TidyRules, keep_best, tidy
from loomwork.operators.columns import ColumnPlan, reshape
from loomwork.operators.metrics import dim_metrics
from loomwork.operators.profile import frequent_values, pair_statistics, sample_rows
from loomwork.operators.skew import skew_join
from loomwork.operators.windows import number_all
from loomwork.plans.audit import Audit
from loomwork.session import stage
from loomwork.sources.files import SourceSpec, load
from loomwork.sources.schemas import CUSTOMERS, TRANSACTIONS
from loomwork.sources.sinks import SinkSpec, save

# Professions renamed on the way in, and the text for a missing one.
PROFESSIONS = {
    "Therapist": "Physician",
    "Musician": "Music Director",
    "na": "prof not defined",
}
MISSING = "na"
SOURCE_SYSTEM = "Retail"


@dataclass(frozen=True)
class BatchSpec:
    customers: SourceSpec
    transactions: SourceSpec
    run_ts: str
    min_profession_age: float = 49
    min_group_age: float = 35
    excluded_group: str = "Children"


def csv_inputs(customers: str, transactions: str, sep: str = ",") -> tuple[SourceSpec, SourceSpec]:
    """The two delimited inputs with their declared schemas; malformed rows are dropped."""
    return (
        SourceSpec("csv", customers, CUSTOMERS, sep=sep, mode="DROPMALFORMED"),
        SourceSpec("csv", transactions, TRANSACTIONS, sep=sep, mode="DROPMALFORMED"),
    )


def munge(customers: DataFrame) -> DataFrame:
    """One row per id (the oldest), gaps filled, columns standardised."""
    best = keep_best(customers, ["id"], ["-custage", "custfname", "custlname", "custprofession"])
    tidied = tidy(
        best,
        TidyRules(
            drop_any=["id"],
            fill={"custlname": MISSING, "custprofession": MISSING},
            replace={"custprofession": PROFESSIONS},
        ),
    )
    return reshape(
        tidied,
        ColumnPlan(
            keep=["id", "custprofession", "custage", "custlname", "custfname"],
            constants={"srcsystem": SOURCE_SYSTEM},
            replace={"custfname": "custlname"},
        ),
    )


def enrich(df: DataFrame, run_ts: str) -> DataFrame:
    """Load dates, a descriptive text, the name split back out of it, date formats."""
    loaded = F.lit(run_ts).cast("timestamp_ntz")
    day = F.to_date(loaded)
    return (
        df.withColumns({"curdt": day, "loadts": loaded})
        .withColumnRenamed("srcsystem", "src")
        .withColumn("nameprof", described("custfname", "custprofession"))
        .withColumn("custfname", part_of("nameprof", " ", 0))
        .withColumns(
            {
                "year": F.year("curdt"),
                "curdtstr": F.date_format("curdt", "yy/MM"),
                # HH keeps midnight at 00; hh would print it as 12.
                "dtfmt": F.date_format("curdt", "yyyy/MM/dd HH:mm:ss"),
            }
        )
    )


def age_by_profession(df: DataFrame, above: float) -> DataFrame:
    return dim_metrics(
        df,
        ["custprofession"],
        {"avgage": F.avg("custage")},
        having=F.col("avgage") > above,
        order=["custprofession"],
    )


# The column names below are those of the published table.
def age_metrics(df: DataFrame, excluded: str, above: float) -> DataFrame:
    return dim_metrics(
        df,
        ["year", "agegroup", "custprofession"],
        {
            "max_curdt": F.max("curdt"),
            "min_curdt": F.min("curdt"),
            "avg_custage": F.avg("custage"),
            "mean_age": F.mean("custage"),
            "distinct_cnt_age": F.count_distinct("custage"),
        },
        where=F.col("agegroup") != excluded,
        having=F.col("avg_custage") > above,
        order=["-year", "agegroup", "-custprofession"],
    )


def clean_transactions(txns: DataFrame) -> DataFrame:
    """One row per transaction id, the newest and then the largest; the order is total."""
    dated = txns.withColumn("dt", parse_date("dt")).na.drop("all")
    ties = ["custid", "category", "product", "city", "state", "spendby"]
    return keep_best(dated, ["txnid"], ["-dt", "-amt", *ties])


class Frames(Mapping):
    """Named frames, each declared when it is first asked for."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers = dict(makers)
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def run(spark: SparkSession, spec: BatchSpec) -> Frames:
    """Declare the frames of the job.

    The inputs are parsed once: customers, transactions and the curated frame,
    which several others build on, are written to the shared scratch folder when
    first asked for.
    """
    made: dict[str, DataFrame] = {}

    def once(name: str, maker: Callable[[], DataFrame]) -> DataFrame:
        if name not in made:
            made[name] = stage(maker(), f"batch-{name}")
        return made[name]

    def customers() -> DataFrame:
        return once("customers", lambda: load(spark, spec.customers))

    def curated() -> DataFrame:
        return once(
            "curated",
            lambda: enrich(munge(customers()), spec.run_ts).withColumn("agegroup", age_group("custage")),
        )

    def transactions() -> DataFrame:
        return once("transactions", lambda: clean_transactions(load(spark, spec.transactions)))

    def denormalised() -> DataFrame:
        return skew_join(transactions(), customers(), [("custid", "id")], "inner", hot="left")

    not_excluded = ["id", "custage", "curdt", "custfname", "year", "agegroup"]
    return Frames(
        {
            "customers": customers,
            "transactions": transactions,
            "curated": curated,
            "age_by_profession": lambda: age_by_profession(curated(), spec.min_profession_age),
            "not_excluded": lambda: curated().where(F.col("agegroup") != spec.excluded_group).select(
                *not_excluded
            ),
            "age_metrics": lambda: age_metrics(curated(), spec.excluded_group, spec.min_group_age),
            "masked": lambda: mask(customers(), {"custlname": "md5", "custfname": "md5"}),
            "denormalised": denormalised,
            "numbered": lambda: numbered(once("denormalised", denormalised)),
            "profile_sample": lambda: sample_rows(curated(), 0.2, seed=10),
            "profile_summary": lambda: curated().summary(),
            "profile_pairs": lambda: pair_statistics(curated(), [("custage", "custage")]),
            "profile_frequent": lambda: frequent_values(
                curated(), ["custprofession", "agegroup"], 0.4
            ),
        }
    )


def numbered(denormalised: DataFrame) -> DataFrame:
    """The denormalised rows with a surrogate key by date."""
    return number_all(denormalised, ["dt", "txnid", "id", "custage"], "sno")


def publish(
    frames: Mapping[str, DataFrame], sinks: Mapping[str, SinkSpec], audit: Audit | None = None
) -> None:
    """Write the frames that have a sink, each with an audit entry and its row count when asked for."""
    unknown = sinks.keys() - frames.keys()
    if unknown:
        raise KeyError(f"no such frames: {sorted(unknown)}")
    for name, sink in sinks.items():
        if audit is None:
            save(frames[name], sink)
        else:
            with audit.stage(name) as counts:
                save(counts.watch(frames[name], "rows_out"), sink)
