"""Named views over a set of base tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from eventcanon.plans import client_views as cv
from eventcanon.plans import context_views as xv
from eventcanon.plans import entity_views as ev
from eventcanon.plans import mail_views as mv
from eventcanon.sources.catalog import SnapshotTable

Tables = Mapping[str, DataFrame]
View = Callable[[Tables, Mapping[str, object]], DataFrame]

# name -> function of (base tables, settings). Base tables: canonical_objects, raw_objects,
# measurement_events, domain_events, actions.
VIEWS: dict[str, View] = {
    "proj_clients": lambda t, s: cv.proj_clients(t["canonical_objects"]),
    "proj_sessions": lambda t, s: cv.proj_sessions(t["canonical_objects"]),
    "proj_transcripts": lambda t, s: cv.proj_transcripts(t["canonical_objects"]),
    "proj_clinical_documents": lambda t, s: cv.proj_clinical_documents(t["canonical_objects"]),
    "proj_form_responses": lambda t, s: cv.proj_form_responses(t["canonical_objects"]),
    "proj_contact_events": lambda t, s: cv.proj_contact_events(
        t["canonical_objects"], t["measurement_events"], list(s.get("own_addresses", []))
    ),
    "domain_objects": lambda t, s: ev.domain_objects(t["domain_events"]),
    "view_pm_projects": lambda t, s: ev.view_pm_projects(t["domain_events"]),
    "view_pm_work_items": lambda t, s: ev.view_pm_work_items(t["domain_events"]),
    "view_pm_deliverables": lambda t, s: ev.view_pm_deliverables(t["domain_events"]),
    "view_pm_opsstreams": lambda t, s: ev.view_pm_opsstreams(t["domain_events"]),
    "view_pm_artifacts": lambda t, s: ev.view_pm_artifacts(t["domain_events"]),
    "context_emails": lambda t, s: xv.context_emails(
        t["canonical_objects"], s.get("clinical_sender_domains", []), s.get("practice_recipient_emails", []), s.get("as_of")
    ),
    "context_calendar": lambda t, s: xv.context_calendar(t["canonical_objects"], s.get("as_of")),
    "context_actions": lambda t, s: xv.context_actions(t["actions"], s.get("as_of")),
    "emails_mv": lambda t, s: mv.emails_mv(t["raw_objects"]),
}


def view(name: str, tables: Tables, settings: Mapping[str, object] | None = None) -> DataFrame:
    if name not in VIEWS:
        raise KeyError(f"unknown view {name!r}; known: {sorted(VIEWS)}")
    return VIEWS[name](tables, settings or {})


def create_views(
    tables: Tables, settings: Mapping[str, object] | None = None, names: Sequence[str] | None = None
) -> list[str]:
    """Create or replace temporary views of the session; nothing is computed."""
    made = list(names or VIEWS)
    for name in made:
        view(name, tables, settings).createOrReplaceTempView(name)
    return made


def materialise(name: str, tables: Tables, target: SnapshotTable, settings: Mapping[str, object] | None = None) -> int:
    """Write a view as the next version of a table; returns the version."""
    return target.replace(view(name, tables, settings))
