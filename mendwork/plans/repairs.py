"""Whole repairs, from staged rows to new table versions.

Each stage writes its result to the shared folder before the next reads it, so a repair that loses executors
goes on from the last finished stage and never sees two versions of one decision.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from mendwork.constants import Urns
from mendwork.functions.columns import Moment
from mendwork.functions.durable import durable
from mendwork.operators import actors as actor_ops
from mendwork.operators import harness, labels as label_ops, unopened


class Repaired(NamedTuple):
    tables: dict[str, DataFrame]
    candidates: DataFrame
    log: DataFrame
    checks: DataFrame


def repair_labels(
    staging: DataFrame,
    contexts: DataFrame,
    labels: DataFrame,
    logs: DataFrame,
    actors: DataFrame,
    actor_names: DataFrame,
    units: DataFrame,
    subunits: DataFrame,
    now: Moment,
    batch_size: int = 5000,
    workers: int = 4,
    urns: Urns = Urns(),
    candidates: DataFrame | None = None,
    finished: Moment | None = None,
) -> Repaired:
    """Resolve, enqueue, claim, apply, mark, log, verify. ``candidates`` are those of an earlier run."""
    keys = ["entity_id", "label_id"]
    resolution = label_ops.finish_resolution(
        label_ops.resolve_from_registry(label_ops.resolve_existing(staging, actor_names), units, subunits, urns)
    )
    names, resolution = label_ops.ensure_actor_names(resolution, actor_names, now)
    resolution = durable(resolution)
    found = label_ops.label_candidates(staging, contexts, resolution, labels)
    queue = durable(harness.enqueue(candidates, found, keys, now))
    claimed = durable(harness.claim(queue, keys, batch_size, workers))
    changes = label_ops.apply_labels(claimed, labels, logs, actors)
    touched = durable(changes.touched)
    marked = durable(harness.mark(queue, claimed, touched, keys, now))
    new_labels, new_logs, new_actors = durable(changes.labels), durable(changes.logs), durable(changes.actors)
    return Repaired(
        {"labels": new_labels, "logs": new_logs, "actors": new_actors, "actor_names": names},
        marked,
        harness.batch_log(marked, claimed, keys, now, finished or now),
        label_ops.verify_labels(marked, new_labels, new_logs, new_actors),
    )


def repair_actors(
    staging: DataFrame,
    activities: DataFrame,
    actors: DataFrame,
    actor_names: DataFrame,
    now: Moment,
    batch_size: int = 5000,
    workers: int = 4,
    urns: Urns = Urns(),
    candidates: DataFrame | None = None,
    finished: Moment | None = None,
) -> Repaired:
    keys = ["entity_id"]
    resolution, new_rows = actor_ops.resolve_actor_names(staging, actor_names, urns)
    resolution = durable(resolution)
    names = actor_names.select("id", "actor_id", "name", "created_at").unionByName(durable(new_rows))
    found = actor_ops.actor_candidates(staging, activities, actors, resolution)
    queue = durable(harness.enqueue(candidates, found, keys, now))
    claimed = durable(harness.claim(queue, keys, batch_size, workers))
    new_actors, touched = actor_ops.repoint_actors(actors, claimed)
    touched = durable(touched)
    new_actors = durable(new_actors)
    marked = durable(harness.mark(queue, claimed, touched, keys, now))
    return Repaired(
        {"actors": new_actors, "actor_names": names},
        marked,
        harness.batch_log(marked, claimed, keys, now, finished or now),
        actor_ops.verify_actors(marked, new_actors, names, urns),
    )


def repair_unopened(
    dialogs: DataFrame,
    transmissions: DataFrame,
    activities: DataFrame,
    start: Moment,
    end: Moment,
    repair_name: str,
    now: Moment,
    finished: Moment | None = None,
    batch_sizes: tuple[int, int] = (100_000, 1000),
) -> Repaired:
    """Discover the whole window in one pass, then correct all candidates in one pass.

    The log has the rows that discovery and processing in ``batch_sizes`` would write, see
    :func:`unopened.phase_stats`; all carry the run's start (``now``) and finish.
    """
    found = durable(unopened.discover_all(activities, dialogs, start, end, repair_name, now))
    done = unopened.process_candidates(found, dialogs, transmissions, activities, now)
    new_dialogs, marked = durable(done.dialogs), durable(done.candidates)
    return Repaired(
        {"dialogs": new_dialogs},
        marked,
        unopened.discovery_log(activities, dialogs, start, end, repair_name, batch_sizes[0], now, finished or now).unionByName(
            unopened.process_log(found, marked, repair_name, batch_sizes[1], now, finished or now), allowMissingColumns=True
        ),
        unopened.verify_unopened(marked, new_dialogs, transmissions, activities),
    )
