"""Newest-first search over the records a set of (party, service) permissions may see.

Record columns: id, party, service, org, status_id, content_updated_at, visible_from, expires_at, deleted,
mask, is_api_only. Permissions come from :func:`explode_permissions`.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mendwork.constants import CONTEXT_PAGE_SIZE, PAGE_SIZE
from mendwork.functions.columns import Moment
from mendwork.functions.ranking import first_n, first_n_per, newest_first
from mendwork.functions.visibility import visible
from mendwork.operators.text_index import TextIndex

PAYLOAD_SCHEMA = "array<struct<Parties:array<string>,Services:array<string>>>"


def explode_permissions(
    payloads: DataFrame, by: str = "party", payload: str = "payload", case: Sequence[str] = ()
) -> DataFrame:
    """Permission groups ``[{"Parties":[..],"Services":[..]}]`` as rows.

    ``by="party"`` gives one row per party with its ``services``; ``by="service"`` one per service with its
    ``parties``. ``group_no`` counts the groups of a payload from 0; ``case`` columns are carried along.
    """
    groups = payloads.select(
        *case, F.posexplode(F.from_json(F.col(payload), PAYLOAD_SCHEMA)).alias("group_no", "_g")
    )
    if by == "party":
        return groups.select(
            *case, "group_no", F.explode("_g.Parties").alias("party"), F.col("_g.Services").alias("services")
        )
    if by == "service":
        return groups.select(
            *case, "group_no", F.explode("_g.Services").alias("service"), F.col("_g.Parties").alias("parties")
        )
    raise ValueError(f"by must be 'party' or 'service', not {by!r}")


class Permissions(NamedTuple):
    """Permission groups as two narrow tables, never their product: (case, group_no, party) and (case, group_no, service).

    The driving side keeps the repeats of its list; the other side counts once per value.
    """

    parties: DataFrame
    services: DataFrame


def permission_tables(
    payloads: DataFrame, by: str = "party", payload: str = "payload", case: Sequence[str] = ()
) -> Permissions:
    """The groups of ``payloads``, driven by party or by service."""
    groups = payloads.select(
        *case, F.posexplode(F.from_json(F.col(payload), PAYLOAD_SCHEMA)).alias("group_no", "_g")
    )
    key = [*case, "group_no"]
    parties = groups.select(*key, F.explode("_g.Parties").alias("party"))
    services = groups.select(*key, F.explode("_g.Services").alias("service"))
    if by == "party":
        return Permissions(parties, services.distinct())
    if by == "service":
        return Permissions(parties.distinct(), services)
    raise ValueError(f"by must be 'party' or 'service', not {by!r}")


def _permitted(seen: DataFrame, perms: Permissions, case: Sequence[str]) -> DataFrame:
    """Rows of ``seen`` for each group that permits them: by party first, then by (group, service)."""
    return seen.join(perms.parties, "party").join(perms.services, [*case, "group_no", "service"])


def _permitted_page(
    dialogs: DataFrame, perms: Permissions, as_of: Moment, k: int, case: Sequence[str], distinct: bool, **visibility
) -> DataFrame:
    seen = dialogs.where(visible(as_of, **visibility)).select("id", "party", "service", "content_updated_at")
    order = newest_first()
    if case:
        # Many cases share parties and services: cut every used pair of them to k rows once, then rank the rest per case.
        used = seen.join(perms.parties.select("party").distinct(), "party", "left_semi")
        used = used.join(perms.services.select("service").distinct(), "service", "left_semi")
        seen = first_n_per(used, ["party", "service"], order, k)
    found = _permitted(seen, perms, case).select(*case, "id", "content_updated_at")
    if distinct:
        found = found.distinct()
    return first_n_per(found, case, order, k) if case else first_n(found, order, k)


def search_party_driven(
    dialogs: DataFrame,
    perms: Permissions,
    as_of: Moment,
    k: int = PAGE_SIZE,
    case: Sequence[str] = (),
    distinct: bool = False,
    **visibility,
) -> DataFrame:
    """Newest ``k`` visible records over all permitted (party, service) pairs, per case if ``case`` is given.

    A party listed in two groups yields its records twice, which use up the page; ``distinct=True`` drops
    such repeats first. Permissions are joined on equality of party, then of group and service, so either side
    may be large.
    """
    return _permitted_page(dialogs, perms, as_of, k, case, distinct, **visibility)


def search_service_driven(
    dialogs: DataFrame,
    perms: Permissions,
    as_of: Moment,
    k: int = PAGE_SIZE,
    case: Sequence[str] = (),
    distinct: bool = False,
    **visibility,
) -> DataFrame:
    """As :func:`search_party_driven` with permissions driven by service."""
    return _permitted_page(dialogs, perms, as_of, k, case, distinct, **visibility)


def search_single_party(
    dialogs: DataFrame, party_services: DataFrame, as_of: Moment, k: int = PAGE_SIZE, **visibility
) -> DataFrame:
    """Newest ``k`` records of each party within its service list, for all parties in one job."""
    pairs = party_services.select("party", F.explode("services").alias("service")).distinct()
    seen = dialogs.where(visible(as_of, **visibility)).select("id", "party", "service", "content_updated_at")
    permitted = seen.join(pairs, ["party", "service"], "left_semi")
    return first_n_per(permitted, ["party"], newest_first(), k).select("party", "id", "content_updated_at")


def fetch_page(ids: DataFrame, dialogs: DataFrame, case: Sequence[str] = ()) -> DataFrame:
    """Join a page of ids back to the wide rows, newest first. A repeated id repeats its row."""
    wide = [c for c in dialogs.columns if c not in case]
    page = ids.select(*case, "id").join(dialogs.select(*wide), "id").select(*case, *wide)
    return page.orderBy(*case, *newest_first())


def search_dialog_first_text(
    dialogs: DataFrame,
    perms: Permissions,
    index: TextIndex,
    query: str,
    as_of: Moment,
    k: int = PAGE_SIZE,
    per_driver: int | None = None,
    overall: int | None = None,
    **visibility,
) -> DataFrame:
    """The newest ``k`` permitted records whose text matches, by the postings of ``index``; no text is read.

    By default every permitted record is a candidate. With ``per_driver`` only the newest so many of each (group,
    party) are, with ``overall`` only the newest so many of all: then a match older than the last candidate is
    not found, as ``TEXT_CAPS`` has it.
    """
    visibility = {"statuses": None, "exclude_api_only": True, **visibility}
    order = newest_first()
    seen = dialogs.where(visible(as_of, **visibility)).select("id", "party", "service", "content_updated_at")
    candidates = _permitted(seen, perms, ())
    if per_driver is not None:
        candidates = first_n_per(candidates, ["group_no", "party"], order, per_driver)
    candidates = candidates.select("id", "content_updated_at")
    if overall is not None:
        candidates = first_n(candidates, order, overall)
    found = candidates.join(index.matches(query).withColumnRenamed("doc_id", "id"), "id")
    return first_n(found.select("id", "content_updated_at"), order, k)


def dialog_labels(
    dialogs: DataFrame, contexts: DataFrame, labels: DataFrame, k: int = CONTEXT_PAGE_SIZE
) -> DataFrame:
    """Newest ``k`` records of every (org, party) with their context revision and sorted label ids.

    A record without a context is left out; one without labels has an empty array.
    """
    page = first_n_per(
        dialogs.select("id", "org", "party", "content_updated_at"), ["org", "party"], newest_first(), k
    )
    with_context = page.withColumnRenamed("id", "dialog_id").join(
        contexts.select("dialog_id", F.col("id").alias("context_id"), "revision"), "dialog_id"
    )
    wanted = with_context.select("context_id").distinct()
    label_sets = (
        labels.join(wanted, "context_id")
        .groupBy("context_id")
        .agg(F.sort_array(F.collect_list("label_id")).alias("labels"))
    )
    empty = F.array().cast(label_sets.schema["labels"].dataType)
    return with_context.join(label_sets, "context_id", "left").select(
        "org", "party", "dialog_id", "revision", "content_updated_at", F.coalesce("labels", empty).alias("labels")
    )
