"""Reasons as Columns, and one-line summaries of a run from its counts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftworks.operators.dedup import NEW, REPEAT, SEEN
from siftworks.operators.publication import Run
from siftworks.operators.retention import REASONS


def with_detail(name: Column, detail: Column) -> Column:
    """``name (detail)``, or the name alone where there is no detail."""
    return F.when(F.coalesce(detail, F.lit("")) == "", name).otherwise(F.concat(name, F.lit(" ("), detail, F.lit(")")))


def rejection(verdict: Column) -> Column:
    """Why a posting goes, empty where it stays."""
    return F.when(verdict["kept"], F.lit("")).otherwise(with_detail(verdict["reason"], verdict["detail"]))


def rating(category: Column, detail: Column, bonus: Column, stack: Column) -> Column:
    """What made a score: ``europe (london) · stack +15 (Go, Python)``."""
    earned = F.when(F.size(stack) > 0, F.concat(F.lit("stack +"), bonus.cast("string"), F.lit(" ("), F.array_join(stack, ", "), F.lit(")")))
    return F.concat_ws(" · ", with_detail(category, detail), earned)


def listed(counts: Mapping[str, int], order) -> str:
    return ", ".join(f"{k} {counts[k]}" for k in order if counts.get(k))


def retention_line(kept: int, reasons: Mapping[str, int]) -> str:
    gone = sum(reasons.values())
    base = f"{kept} retenue(s) sur {kept + gone}"
    return f"{base} — {gone} écartée(s) ({listed(reasons, REASONS)})" if gone else base


def dedup_line(status: Mapping[str, int]) -> str:
    n = {s: status.get(s, 0) for s in (NEW, SEEN, REPEAT)}
    base = f"{n[NEW]} nouvelle(s) sur {sum(n.values())} — {n[SEEN]} déjà vue(s)"
    return base + (f", {n[REPEAT]} doublon(s) dans le run" if n[REPEAT] else "")


def scoring_line(categories: Mapping[str, int], order) -> str:
    base = f"{sum(categories.values())} offre(s) classée(s)"
    return f"{base} — {listed(categories, order)}" if categories else base


def publication_line(run: Run) -> str:
    total = len(run.published) + len(run.complete) + len(run.refused) + len(run.deferred)
    parts = [f"{len(run.published)} fiche(s) publiée(s) sur {total} offre(s)"]
    for ids, what in ((run.complete, "déjà sur le tableau"), (run.refused, "refusée(s)"), (run.deferred, "reportée(s) au run suivant")):
        if ids:
            parts.append(f"{len(ids)} {what}")
    return ", ".join(parts) + (f" — INTERROMPUE : {run.error}" if run.error else "")
