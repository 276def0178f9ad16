"""The stored tables of one deployment and the questions asked of them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewright.functions.text import strip_whitespace
from tidewright.functions.time_bounds import now_micros, to_micros
from tidewright.operators import activity, cases as C, detection, neighbor_index, neighbors, outcomes, snapshot
from tidewright.plans import feed, knowledge
from tidewright.session import pin_utc
from tidewright.sources import anomaly_store, tables


@dataclass(frozen=True)
class Layout:
    """Where the tables lie, by default below one root."""

    events: str
    dead_letters: str
    ci_runs: str
    anomalies: str
    cases: str
    embeddings: str

    @classmethod
    def under(cls, root: str) -> Layout:
        base = root.rstrip("/")
        return cls(
            f"{base}/events",
            f"{base}/dlq",
            f"{base}/ci_runs",
            f"{base}/anomalies",
            f"{base}/knowledge/cases",
            f"{base}/knowledge/embeddings",
        )


class Workspace:
    """Every method returns a DataFrame; a missing table counts as empty.

    `as_of` defaults to the current time. `embed` turns texts into vectors and
    has to be the one the case vectors were built with.
    """

    def __init__(self, spark: SparkSession, layout: Layout, embed=None, repo: str | None = None):
        self.spark = pin_utc(spark)
        self.layout = layout
        self.embed = embed or C.hash_embedder(512)
        self.repo = repo

    def events(self) -> DataFrame:
        return tables.read_events(self.spark, self.layout.events)

    def runs(self) -> DataFrame:
        return tables.read_ci_runs(self.spark, self.layout.ci_runs)

    def cases(self) -> DataFrame:
        return tables.read_cases(self.spark, self.layout.cases)

    def corpus(self) -> DataFrame:
        return knowledge.load_corpus(self.spark, self.layout.cases, self.layout.embeddings)

    @staticmethod
    def _at(as_of: datetime | int | None) -> int:
        return now_micros() if as_of is None else to_micros(as_of)

    # ---- metrics

    def event_counts(self, since_minutes: float = 60, as_of=None) -> DataFrame:
        return activity.event_counts(self.events(), since_minutes, self._at(as_of))

    def top_entities(self, since_minutes: float = 60, limit: int = 10, as_of=None) -> DataFrame:
        return activity.top_entities(self.events(), since_minutes, limit, self._at(as_of))

    def lag(self, since_minutes: float = 60, as_of=None) -> DataFrame:
        noted = tables.late_hours(self.spark, self.layout.events)
        return activity.lag_report(self.events(), since_minutes, self._at(as_of), noted)

    def recent(self, limit: int = 20, event_type: str | None = None) -> DataFrame:
        return feed.recent_feed(self.spark, self.layout.events, limit, event_type)

    def total(self) -> DataFrame:
        return activity.total_events(self.events())

    def dead_letters(self, limit: int = 20) -> DataFrame:
        rows = tables.read_dead_letters(self.spark, self.layout.dead_letters)
        return tables.latest_dead_letters(rows, limit)

    def freshness(self) -> DataFrame:
        newest = tables.read_newest_events(self.spark, self.layout.events)
        return snapshot.freshness(newest, self.runs(), self.cases())

    # ---- anomalies

    def detect(self, as_of=None) -> DataFrame:
        """Run all rules, store what is new and return the stored anomalies."""
        found = detection.detect_all(self.events(), self.runs(), self._at(as_of), self.repo)
        anomaly_store.save(self.spark, found, self.layout.anomalies)
        return self.anomalies()

    def anomalies(self) -> DataFrame:
        return anomaly_store.load(self.spark, self.layout.anomalies)

    def signal(self, as_of=None) -> DataFrame:
        return detection.health_signal(self.events(), self.runs(), self._at(as_of), self.repo)

    def snapshot(self, as_of=None) -> DataFrame:
        """Evidence of the whole stream, or of the configured repository."""
        rows = snapshot.evidence_snapshot(self.events(), self.runs(), self._at(as_of), self.repo)
        return rows.where(F.col("scope") == "all")

    def capture_snapshot(self, as_of=None) -> DataFrame:
        """Store the current CI state as an anomaly; no row without CI data."""
        at = self._at(as_of)
        found = snapshot.snapshot_anomaly(self.snapshot(at), at)
        anomaly_store.save(self.spark, found, self.layout.anomalies)
        return found

    # ---- knowledge

    def neighbor_index(self, k: int = 5) -> neighbor_index.NeighborIndex:
        """An index for approximate searches, fitted on a sample of the corpus."""
        return neighbor_index.fit(self.corpus(), k)

    def search(self, texts: DataFrame, k: int = 5, index: neighbor_index.NeighborIndex | None = None) -> DataFrame:
        """`texts` has query_id and text; exact, or through an index."""
        find = neighbors.nearest if index is None else index.nearest
        return neighbors.search(self.embed(texts, "text"), self.corpus(), k, find)

    def outcomes(self, case_ids: DataFrame) -> DataFrame:
        return outcomes.estimate_for_ids(self.cases(), case_ids)

    def _live_text(self, as_of) -> Column:
        """The snapshot text as a scalar subquery."""
        text = self.snapshot(as_of).select(snapshot.snapshot_text().alias("text"))
        return text.agg(F.max("text")).scalar()

    def diagnose(self, anomaly_id: str | None = None, as_of=None, k: int = 5) -> DataFrame:
        """Diagnosis records of one stored anomaly, or of all of them."""
        rows = self.anomalies()
        if anomaly_id is not None:
            rows = anomaly_store.by_id(rows, anomaly_id)
        subjects = knowledge.anomaly_subjects(rows, self.embed)
        return knowledge.diagnose(subjects, self.corpus(), k, self._live_text(as_of))

    def ask(self, questions: DataFrame, as_of=None, k: int = 5) -> DataFrame:
        """Diagnosis records for free texts (query_id, question); blanks fall away."""
        asked = questions.select(
            "query_id", strip_whitespace(F.col("question")).alias("subject")
        ).where(F.col("subject") != "")
        return knowledge.diagnose(
            self.embed(asked, "subject"), self.corpus(), k, self._live_text(as_of)
        )
