"""The monitoring run: domain tables in, detections, alerts and evaluation out.

A `Run` holds one set of domain tables and builds each later table on first use. Tables that
several steps read are staged; single-use ones stay lazy, so Catalyst sees one plan. Results are
published to a folder once and opened from there for dashboards, which then detect nothing again.
A closed run leaves no staged folders behind.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import closing, links, mule, rings, structuring, walks
from tidewatch.plans import alerts, evaluate
from tidewatch.sources.sample import SampleTables
from tidewatch.sources.snapshots import Snapshots
from tidewatch.staging import Staged, noting, stage, step, together


#: What a run publishes: edges, paths, identities, detections with their lists, alerts, evaluation.
PUBLISHED = (
    "edges", "long_walks", "shared", "candidates", "round_trip", "layering", "mule_members", "mule",
    "mule_lists", "flagged_deposits", "structuring", "structuring_lists", "alerts", "benchmark",
)


class Run(Staged):
    """``raised_at``, the time that alerts carry, is the clock's unless given."""

    def __init__(self, table: Callable[[str], DataFrame], raised_at: str | None = None):
        super().__init__()
        self._table = table
        self._tables: dict[str, DataFrame] = {}
        self._raised_at = raised_at

    @classmethod
    def over_sample(cls, spark: SparkSession, sf_dir: str, raised_at: str | None = None) -> "Run":
        return cls(SampleTables(spark, sf_dir), raised_at)

    @classmethod
    def opened(cls, spark: SparkSession, folder: str, table: Callable[[str], DataFrame]) -> "Run":
        """A run over what another one has published; only domain tables come from ``table``. All results
        are of one run, and stay so if another one is published meanwhile."""
        run = cls(table)
        run.__dict__.update(Snapshots(spark, folder).read(PUBLISHED))
        return run

    def publish(self, folder: str, keep: int = 2) -> str:
        """Publish all results under ``folder`` in place of an earlier run's, at once; the newest ``keep`` runs
        stay for those who have opened them. The folder of this run's results."""
        self.detect()
        results = {name: getattr(self, name) for name in PUBLISHED}
        return Snapshots(SparkSession.active(), folder, keep).write(results)

    def table(self, name: str) -> DataFrame:
        """A domain table: customer, account, device, ip_address, session, transaction, ..."""
        if name not in self._tables:
            self._tables[name] = self._table(name)
        return self._tables[name]

    # --- links and paths -------------------------------------------------------------

    def lazy_edges(self) -> DataFrame:
        return walks.money_edge(self.table("transaction"), self.table("account"))

    @step
    def edges(self) -> DataFrame:
        return stage(self.lazy_edges(), "edges")

    @step
    def shared(self) -> DataFrame:
        found = links.identity(self.table("account"), self.table("customer"), self.table("session"))
        return stage(links.shared_identity(found), "shared-identity")

    @step
    def long_walks(self) -> DataFrame:
        return walks.long_walks(self.edges)

    # --- detections ------------------------------------------------------------------

    def lazy_candidates(self) -> DataFrame:
        """Closing paths, picked out where all paths have been listed, else put together from halves."""
        if "long_walks" in self.__dict__:
            return rings.round_trip_candidates(self.long_walks, self.shared)
        together(lambda: self.edges, lambda: self.shared)
        with noting(self.folders):
            return closing.closing_paths(self.edges, self.shared)

    @step
    def candidates(self) -> DataFrame:
        return stage(self.lazy_candidates(), "candidates")

    def lazy_round_trip(self) -> DataFrame:
        return rings.round_trip(self.candidates, self.shared)

    @step
    def round_trip(self) -> DataFrame:
        return stage(self.lazy_round_trip(), "round-trip")

    def lazy_layering(self) -> DataFrame:
        self.long_walks  # noqa: B018
        # the transfers of all candidates are those of all rings, as each lies inside some ring
        return rings.layering(self.long_walks, self.candidates)

    @step
    def layering(self) -> DataFrame:
        return stage(self.lazy_layering(), "layering")

    @step
    def mule_members(self) -> DataFrame:
        transaction = self.table("transaction")
        found = mule.mule_members(
            self.table("session"), self.table("account"), transaction, mule.pass_through(transaction)
        )
        return stage(found, "mule-members")

    @step
    def mule(self) -> DataFrame:
        return stage(mule.mule_ring(self.mule_members), "mule")

    @step
    def mule_lists(self) -> DataFrame:
        return stage(mule.mule_accounts(self.mule_members, self.mule), "mule-lists")

    @step
    def mule_found(self) -> DataFrame:
        return mule.ring_members(self.mule_members, self.mule)

    @step
    def flagged_deposits(self) -> DataFrame:
        return stage(structuring.flagged_deposits(self.table("transaction")), "flagged-deposits")

    @step
    def structuring(self) -> DataFrame:
        return stage(structuring.structuring_daily(self.flagged_deposits), "structuring")

    @step
    def structuring_lists(self) -> DataFrame:
        return structuring.deposit_lists(self.flagged_deposits, self.structuring)

    def window_deposits(self, **rule) -> DataFrame:
        """Deposits of each account's densest window."""
        with noting(self.folders):
            return stage(structuring.window_deposits(self.table("transaction"), **rule), "window-deposits")

    # --- alerts and evaluation -------------------------------------------------------

    def detect(self) -> None:
        """Stage what the detectors find; the money, device and cash sides are independent."""
        together(
            lambda: self.long_walks, lambda: self.shared, lambda: self.mule_members, lambda: self.flagged_deposits
        )
        self.detect_paths()

    def detect_paths(self) -> None:
        """Stage round trips and layering. Layering lists all paths, so round trips are picked out of those."""
        together(lambda: self.long_walks, lambda: self.shared)
        self.candidates  # noqa: B018
        together(lambda: self.round_trip, lambda: self.layering)

    @step
    def alerts(self) -> DataFrame:
        self.detect()
        return alerts.fraud_alert(
            self.round_trip, self.layering, self.mule, self.structuring,
            None if self._raised_at is None else F.lit(self._raised_at).cast("timestamp_ntz"),
        )

    @step
    def benchmark(self) -> DataFrame:
        self.detect()
        return evaluate.benchmark(
            self.table("ground_truth"),
            self.table("transaction"),
            self.round_trip,
            self.layering,
            self.mule_found,
            self.structuring,
        )
