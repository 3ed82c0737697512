"""The daily run: raw star in, every result table out."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property
from hashlib import blake2b

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import baselines, detectors, ensemble, evaluation, forest, impact, quality, scoring, spine, summary, tickets
from ..registry import COHORT_KEYS, METHODS
from ..schemas import SPINE_TYPES
from ..sources.tables import Table
from ..workspace import Workspace

# Result tables with a date, by whose months they are stored and replaced.
DATED = {
    "fact_seller_daily_metrics": "metric_date",
    "seller_metric_rolling_baseline": "metric_date",
    "seller_metric_cohort_baseline": "metric_date",
    "fact_anomaly_flags": "flag_date",
    "seller_health_score": "score_date",
}


class Warehouse:
    """The result tables of one star.

    Tables several later stages read (spine, detector candidates, forest model and scores, flags, tickets) are
    stored when first used; everything else stays a lazy frame, so a query computes what it needs.

    `methods` names the detectors that vote. `updates` turns new tickets into status updates.
    `as_of` is the moment of the load, now unless given: an order dated later is a fault. Tickets are judged
    at `judged_at`, the last day of the series unless given. `bucketed` says that the facts are stored in buckets of the line key.

    A stored table's name holds a digest of all that shapes it, so warehouses that differ in their input or
    parameters can share a workspace. Tables with a date are stored by month, and reads of some days list only theirs.
    """

    def __init__(
        self,
        star: dict[str, DataFrame],
        workspace: Workspace,
        methods: tuple[str, ...] = METHODS,
        updates: Callable[[DataFrame], DataFrame] | None = None,
        as_of: Column | None = None,
        judged_at: Column | None = None,
        bucketed: bool = False,
    ):
        self.star = star
        self.workspace = workspace
        self.methods = methods
        self.updates = updates
        self.as_of = F.current_timestamp().cast("timestamp_ntz") if as_of is None else as_of
        self._judged_at = judged_at
        self.bucketed = bucketed

    @cached_property
    def _input(self) -> tuple:
        return tuple((name, frame.semanticHash()) for name, frame in sorted(self.star.items()))

    def _named(self, name: str, shaped_by: tuple[object, ...]) -> str:
        return f"{name}-{blake2b(repr((self._input, *shaped_by)).encode(), digest_size=8).hexdigest()}"

    def _store(self, name: str, build: Callable[[], DataFrame], *shaped_by: object) -> DataFrame:
        return self.workspace.table(self._named(name, shaped_by), build)

    def _dated(self, name: str, build: Callable[[], DataFrame], *shaped_by: object) -> Table:
        """A stored table parted by the months of its date."""
        return self.workspace.dated(self._named(name, shaped_by), build, DATED[name])

    @property
    def sellers(self) -> DataFrame:
        return self.star["dim_seller"]

    @property
    def episodes(self) -> DataFrame:
        return self.star["ground_truth_anomalies"]

    @property
    def member_table(self) -> Table:
        """The spine with each seller's cohort, stored by month."""
        s = self.star
        facts = (s["fact_orders"], s["fact_shipments"], s["fact_returns"], s["fact_reviews"])
        return self._dated(
            "fact_seller_daily_metrics",
            lambda: baselines.with_cohort(spine.daily_metrics(*facts, self.sellers, self.bucketed), self.sellers),
        )

    @cached_property
    def members(self) -> DataFrame:
        return self.member_table.read()

    @property
    def spine(self) -> DataFrame:
        return self.members.select(*SPINE_TYPES)

    @property
    def reporting_time(self) -> Column:
        """The moment tickets are judged at. The spine ends on the last order day, and is far smaller."""
        if self._judged_at is not None:
            return self._judged_at
        return self.member_table.last_day().cast("timestamp_ntz")

    def dq_report(self) -> DataFrame:
        return quality.report(quality.raw_checks(self.star, self.as_of), quality.spine_check(self.spine))

    def _tables(self) -> dict[str, DataFrame]:
        return {
            **self.star,
            "fact_seller_daily_metrics": self.spine,
            "fact_anomaly_flags": self.flags,
            "investigation_tickets": self.tickets,
            "seller_health_score": self.health,
        }

    def domain_report(self) -> DataFrame:
        return quality.domain_checks(self._tables())

    def key_report(self) -> DataFrame:
        """The key checks, a table's after another's, so what one has shuffled goes before the next."""
        shaped_by = (self.methods, self.updates, str(self._judged_at))
        parts = quality.key_parts(self._tables())
        return quality.report(*[self._store(f"key_checks_{name}", lambda p=part: p, *shaped_by) for name, part in parts.items()])

    def rolling_baseline(self) -> DataFrame:
        return baselines.rolling_baseline(self.spine)

    def cohort_baseline(self, days: int | None = None) -> DataFrame:
        """Peer baseline of all days, or of the last `days` before the spine's last date.

        Peers are compared within a day, so the days are chosen in the scan of the spine: only their months are read.
        """
        members = self.members if days is None else self.member_table.last_days(days)
        return baselines.cohort_baseline(members)

    @cached_property
    def candidates(self) -> DataFrame:
        return self._store(
            "detector_candidates",
            lambda: detectors.candidates(baselines.detector_profile(self.members, keep=COHORT_KEYS)),
        )

    def zscore_flags(self) -> DataFrame:
        return detectors.zscore_flags(self.candidates, baselines.cohort_stats(self.members))

    def iqr_flags(self) -> DataFrame:
        return detectors.iqr_flags(self.candidates)

    def cusum_flags(self) -> DataFrame:
        return detectors.cusum_flags(self.candidates)

    @cached_property
    def forest_rows(self) -> DataFrame:
        return forest.features(self.members)

    @cached_property
    def forest_model(self) -> DataFrame:
        return self._store("forest_model", lambda: forest.fit(self.forest_rows))

    @cached_property
    def forest_scores(self) -> DataFrame:
        return self._store("forest_scores", lambda: forest.score(self.forest_rows, self.forest_model))

    def forest_flags(self) -> DataFrame:
        return forest.forest_flags(self.forest_rows, self.forest_scores)

    @cached_property
    def method_flags(self) -> DataFrame:
        detect = {
            "ZScore": self.zscore_flags,
            "IQR": self.iqr_flags,
            "CUSUM": self.cusum_flags,
            "IsolationForest": self.forest_flags,
        }
        return self._store(
            "method_flags", lambda: ensemble.collect_flags(*[detect[m]() for m in self.methods]), self.methods
        )

    def votes(self) -> DataFrame:
        return ensemble.votes(self.method_flags)

    def ensemble_flags(self) -> DataFrame:
        return ensemble.ensemble_flags(self.method_flags)

    @cached_property
    def unique_flags(self) -> DataFrame:
        return self._store(
            "unique_flags", lambda: ensemble.unique_flags(self.method_flags, self.ensemble_flags()), self.methods
        )

    @property
    def flag_table(self) -> Table:
        return self._dated("fact_anomaly_flags", lambda: ensemble.number_flags(self.unique_flags), self.methods)

    @cached_property
    def flags(self) -> DataFrame:
        return self.flag_table.read()

    @cached_property
    def measured(self) -> DataFrame:
        return self._store("penalized_series", lambda: scoring.with_penalty(self.spine, self.flags), self.methods)

    @property
    def health_table(self) -> Table:
        return self._dated("seller_health_score", lambda: scoring.health_scores(self.measured), self.methods)

    @cached_property
    def health(self) -> DataFrame:
        return self.health_table.read()

    def health_on(self, day: Column | None = None) -> DataFrame:
        """Health scores of a day, the last one unless given; only its month is read."""
        return self.health_table.on(self.health_table.last_day() if day is None else day)

    @cached_property
    def exposed_cases(self) -> DataFrame:
        return self._store("exposed_cases", lambda: scoring.exposed_cases(self.spine, self.flags), self.methods)

    def priority(self) -> DataFrame:
        return self._store("priority_score", lambda: scoring.priority_scores(self.exposed_cases), self.methods)

    @cached_property
    def new_tickets(self) -> DataFrame:
        bundled = self._store("bundled_cases", lambda: tickets.bundle_cases(self.priority()), self.methods)
        return self._store("new_tickets", lambda: tickets.number_tickets(bundled), self.methods)

    def merged_tickets(self) -> DataFrame:
        if self.updates is None:
            return self.new_tickets
        return tickets.apply_updates(self.new_tickets, self.updates(self.new_tickets))

    @cached_property
    def tickets(self) -> DataFrame:
        return self._store(
            "investigation_tickets",
            lambda: tickets.mark_breaches(self.merged_tickets(), self.reporting_time),
            self.methods,
            self.updates,
            str(self._judged_at),
        )

    def sla_summary(self) -> DataFrame:
        return tickets.sla_summary(self.tickets)

    def evaluation(self) -> DataFrame:
        return evaluation.evaluate_methods(self.flags, self.episodes)

    def type_recall(self) -> DataFrame:
        return evaluation.recall_by_type(self.flags, self.episodes)

    def severity_precision(self) -> DataFrame:
        return evaluation.precision_by_severity(self.flags, self.episodes)

    def confusion(self) -> DataFrame:
        return evaluation.seller_confusion(self.flags, self.episodes)

    def business_impact(self) -> DataFrame:
        return impact.business_impact(self.tickets, self.flags, self.spine, self.episodes)

    def dataset_summary(self) -> DataFrame:
        return summary.dataset_summary(self.star, self.as_of)

    def trimmed_extract(self) -> DataFrame:
        return self.cohort_baseline(summary.EXTRACT_DAYS)


def run(warehouse: Warehouse, enforce_quality: bool = True) -> dict[str, DataFrame]:
    """All result tables in stage order; failing raw checks stop the run before the transform."""
    if enforce_quality:
        quality.gate(quality.report(quality.raw_checks(warehouse.star, warehouse.as_of)))
        quality.gate(quality.report(quality.spine_check(warehouse.spine)))
    return {
        "dataset_summary": warehouse.dataset_summary(),
        "dq_report": warehouse.dq_report(),
        "fact_seller_daily_metrics": warehouse.spine,
        "seller_metric_rolling_baseline": warehouse.rolling_baseline(),
        "seller_metric_cohort_baseline": warehouse.cohort_baseline(),
        "fact_anomaly_flags": warehouse.flags,
        "seller_health_score": warehouse.health,
        "investigation_tickets": warehouse.tickets,
        "sla_summary": warehouse.sla_summary(),
        "evaluation": warehouse.evaluation(),
        "recall_by_type": warehouse.type_recall(),
        "precision_by_severity": warehouse.severity_precision(),
        "seller_confusion": warehouse.confusion(),
        "business_impact": warehouse.business_impact(),
    }


# Tables copied whole into an extract; the peer baseline joins them trimmed.
COPIED = (
    "dim_seller",
    "fact_seller_daily_metrics",
    "fact_anomaly_flags",
    "investigation_tickets",
    "seller_health_score",
    "dataset_summary",
)


def keep(warehouse: Warehouse, folder: str, name: str, frame: DataFrame, months: Sequence[str] | None = None) -> Table:
    """Replace a result table, or the given months of it if it has a date. Readers see it before or after, whole."""
    dated_by = DATED.get(name)
    table = Table(warehouse.workspace.spark, f"{folder}/{name}", dated_by)
    table.replace(frame, months if dated_by and table.exists() else None, sort_by=dated_by)
    return table


def export(warehouse: Warehouse, folder: str) -> None:
    """Write the extract a reporting site needs, as versioned tables."""
    whole = (
        warehouse.sellers,
        warehouse.spine,
        warehouse.flags,
        warehouse.tickets,
        warehouse.health,
        warehouse.dataset_summary(),
    )
    for name, frame in zip(COPIED, whole):
        keep(warehouse, folder, name, frame)
    keep(warehouse, folder, "seller_metric_cohort_baseline", warehouse.trimmed_extract())
