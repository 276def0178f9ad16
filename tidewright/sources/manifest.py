"""Versions of a stored table: which rewritten files count, and which old ones no longer do.

A rewrite puts its output under a hidden folder of the table, where no reader
looks, and names it `run=<id>`. A manifest version lists the runs that count
and the old names that do not any more; it is written aside and switched on by
one rename. So readers see either the state before or the state after, and
dropped files may be deleted at leisure. Writers that append need not know.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import SparkSession

from tidewright.sources.files import folder_names, has_path, move

_SCHEMA = "kind string, name string"


@dataclass(frozen=True)
class State:
    """Runs that count and names (files or batches) that wait for deletion."""

    version: int = 0
    runs: tuple[str, ...] = ()
    drops: tuple[str, ...] = ()

    def after(self, run: str, drops: list[str]) -> State:
        return State(self.version + 1, (*self.runs, run), (*self.drops, *drops))

    def swept(self) -> State:
        return replace(self, version=self.version + 1, drops=())


def new_run() -> str:
    return uuid.uuid4().hex


def state(spark: SparkSession, path: str) -> State:
    """The newest version; what it lists is bounded by one rewrite, as deletions are struck off."""
    versions = [n for n in folder_names(spark, f"{path}/_manifest") if n.startswith("v")]
    if not versions:
        return State()
    newest = max(versions)
    rows = spark.read.schema(_SCHEMA).parquet(f"{path}/_manifest/{newest}").collect()
    named = {kind: tuple(sorted(r.name for r in rows if r.kind == kind)) for kind in ("run", "drop")}
    return State(int(newest[1:]), named["run"], named["drop"])


def commit(spark: SparkSession, path: str, new: State) -> None:
    """Switch to a version; the one that comes second with the same number fails."""
    rows = [("run", x) for x in new.runs] + [("drop", x) for x in new.drops]
    fresh = f"{path}/_manifest/_new-{uuid.uuid4().hex}"
    spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.parquet(fresh)
    target = f"{path}/_manifest/v{new.version:012d}"
    if has_path(spark, target):
        raise RuntimeError(f"{path} was rewritten by another job meanwhile")
    move(spark, fresh, target)
