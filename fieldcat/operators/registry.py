"""Ingestor registry (G1): mapping spec -> ingest function.

An ingestor is ``fn(jobs: DataFrame, ctx) -> IngestResult`` working on all
jobs of its specs at once (a DataFrame, not one file at a time). Specs are
registered first-wins (A8): a second registration of a spec is ignored and
reported. ``run`` calls each distinct function once, on the jobs of all its
specs, and unions the results; jobs whose spec has no ingestor get an error
issue (J2), and so do the jobs of an ingestor that raises (T4)."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcat.functions.issues import issue
from fieldcat.operators.jobs import match_registry
from fieldcat.schemas import SEVERITY_ERROR


@dataclass
class IngestResult:
    datasets: DataFrame            # job_id, pid, ... (one per ingested file)
    issues: DataFrame              # job_id, seq, issue
    datablocks: DataFrame | None = None
    attachments: DataFrame | None = None


def _union(a: DataFrame | None, b: DataFrame | None) -> DataFrame | None:
    return b if a is None else a if b is None else a.unionByName(b)


@dataclass
class Registry:
    ingestors: dict[str, Callable[[DataFrame, Any], IngestResult]] = field(default_factory=dict)
    ignored: list[str] = field(default_factory=list)

    def register(self, spec: str, fn: Callable[[DataFrame, Any], IngestResult]) -> bool:
        if spec in self.ingestors:
            self.ignored.append(spec)
            return False
        self.ingestors[spec] = fn
        return True

    def specs(self, spark) -> DataFrame:
        return spark.createDataFrame([(s,) for s in self.ingestors], "spec string")

    def run(self, jobs: DataFrame, ctx: Any, mapping_col: str = "mapping_id",
            path_col: str = "document_path") -> tuple[DataFrame, IngestResult]:
        matched = match_registry(jobs, list(self.ingestors), mapping_col, path_col)
        reg_issues = (matched.where(~F.col("registered"))
                      .select("job_id", F.lit(-1).alias("seq"), "issue"))
        by_fn: dict[Callable, list[str]] = {}
        for spec, fn in self.ingestors.items():
            by_fn.setdefault(fn, []).append(spec)
        out = IngestResult(None, reg_issues)
        for fn, specs in by_fn.items():
            own = matched.where(F.col(mapping_col).isin(specs))
            try:
                res = fn(own, ctx)
            except Exception as e:  # noqa: BLE001 - a plug-in that raises fails its own jobs only
                failed = issue(SEVERITY_ERROR, "ingestor failed", "ingest", f"{type(e).__name__}: {e}")
                res = IngestResult(None, own.select("job_id", F.lit(-1).alias("seq"), failed.alias("issue")))
            out = IngestResult(*(_union(getattr(out, k), getattr(res, k))
                                 for k in ("datasets", "issues", "datablocks", "attachments")))
        return matched, out
