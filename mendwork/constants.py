"""Fixed values shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: type codes of the record model ---------------------------
VISIBLE_STATUSES = (7, 2, 8)

TRANSMISSION_SUBMISSION = 7
TRANSMISSION_CORRECTION = 8

ACTIVITY_TRANSMISSION_OPENED = 4
ACTIVITY_CORRESPONDENCE_OPENED = 16
ACTIVITY_CORRESPONDENCE_CONFIRMED = 17
ACTIVITY_TYPE_BY_NAME = {
    "CorrespondenceOpened": ACTIVITY_CORRESPONDENCE_OPENED,
    "CorrespondenceConfirmed": ACTIVITY_CORRESPONDENCE_CONFIRMED,
}
CORRESPONDENCE_SERVICE_TYPE = "correspondenceservice"

LABEL_DEFAULT = 1
LABEL_BIN = 2
LABEL_ARCHIVE = 3
LABEL_MARKED_AS_UNOPENED = 4
FOLDER_LABELS = (LABEL_BIN, LABEL_ARCHIVE)
REPAIRABLE_LABELS = {
    "Bin": LABEL_BIN,
    "Archive": LABEL_ARCHIVE,
    "MarkedAsUnopened": LABEL_MARKED_AS_UNOPENED,
}
LABEL_NAME_PREFIX = "systemlabel:"
LABEL_ACTION_SET = "set"
MASK_DEFAULT = 1
MASK_MARKED_AS_UNOPENED = 8

ACTOR_TYPE_PARTY_REPRESENTATIVE = 1
LABEL_LOG_ACTOR = "LabelAssignmentLogActor"
PERFORMED_BY_ACTOR = "DialogActivityPerformedByActor"

# --- fixed values: outcomes, sources and reasons written to result tables ---
OUTCOME_UPDATED = "updated"
OUTCOME_STATE_CHANGED = "skipped_state_changed"
OUTCOME_MANUAL_SKIP = "manual_skip"

SOURCE_EXISTING = "existing"
SOURCE_REGISTER = "brreg"
SOURCE_UNRESOLVED = "unresolved"
SOURCE_EXACT = "existing_exact"
SOURCE_REORDERED = "existing_reordered"
SOURCE_INSERTED = "inserted"
SOURCE_NONE = "UNRESOLVED"

# --- fixed values: page sizes, caps and batch sizes -------------------------
PAGE_SIZE = 101
CONTEXT_PAGE_SIZE = 1001
TEXT_CAPS = (2500, 5000, 101)
COUNT_CAP = 10001
BLOCK_BYTES = 8192

# --- fixed values: bands and strata, hottest / smallest first ---------------
BANDS = ("very_hot", "hot", "medium", "long_tail")
BAND_LIMITS = (("very_hot", 0.01), ("hot", 0.05), ("medium", 0.25))
STRATA = ("0", "1-10", "11-100", "101-1000", "1001-10000", "10001+")
STRATUM_LIMITS = (("0", 0), ("1-10", 10), ("11-100", 100), ("101-1000", 1000), ("1001-10000", 10000))


@dataclass(frozen=True)
class Urns:
    """Identifier schemes under one namespace, e.g. ``urn:<namespace>:person:identifier-no:<id>``."""

    namespace: str = "demo"

    def of(self, tail: str) -> str:
        return f"urn:{self.namespace}:{tail}"

    @property
    def person_any(self) -> str:
        return self.of("person:")

    @property
    def person(self) -> str:
        return self.of("person:identifier-no:")

    @property
    def organization(self) -> str:
        return self.of("organization:identifier-no:")

    @property
    def legacy_organization(self) -> str:
        return self.of("organizationnumber:")

    @property
    def resource(self) -> str:
        return self.of("resource:")

    @property
    def recognised(self) -> tuple[str, ...]:
        """Prefixes of the actor schemes that may be written back."""
        return (
            self.person,
            self.organization,
            self.of("systemuser:uuid:"),
            self.of("person:idporten-email"),
            self.of("person:legacy-selfidentified"),
        )
