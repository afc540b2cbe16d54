"""Loads: dimensions, hourly measurements, backfills and the daily alerts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from .. import schemas as S
from ..functions.times import as_utc, previous_hour
from ..operators import alerts as A
from ..operators.coverage import gaps
from ..operators.merge import merge_locations, merge_parameters, update_country_names
from ..operators.rules import messages_of_rules
from ..sources import payloads as P
from ..sources.envelope import read_bodies
from ..sources.loadlog import COUNTS, LoadLog, Windows, new_id
from ..sources.outbox import Outbox
from ..sources.partials import PartialStore
from ..sources.quarantine import HASH, Quarantine
from ..sources.staging import GOOD, QUARANTINE, Staged, stage
from ..sources.tables import Dimension, FactStore
from .sizing import shared_dir


@dataclass(frozen=True)
class LoadReport:
    """Rows of one load. Rows read = good + quarantined; good rows with one key merge as one."""

    good: int
    quarantined: int
    kept: int
    updated: int
    inserted: int


def refresh_locations(
    dim: Dimension,
    locations: DataFrame,
    countries: DataFrame,
    as_of: datetime | Column | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Merge locations first and name their countries after it, in one write.

    The other order would leave the old country's name on a location that has moved. ``order_by``
    decides which of several rows for one location counts: the largest.
    """
    merged = merge_locations(
        dim.current(), locations, as_of=as_of, on_duplicate="dedupe", order_by=order_by
    )
    return dim.publish(update_country_names(merged, countries))


def refresh_parameters(
    dim: Dimension, parameters: DataFrame, as_of: datetime | Column | None = None
) -> DataFrame:
    return dim.publish(
        merge_parameters(dim.current(), parameters, as_of=as_of, on_duplicate="dedupe")
    )


@dataclass(frozen=True)
class Ledger:
    """What a load keeps beside the fact; whatever is None is not kept."""

    log: LoadLog | None = None
    partials: PartialStore | None = None
    quarantine: Quarantine | None = None


def load_bodies(
    bodies: DataFrame | Callable[[], DataFrame],
    store: FactStore,
    stage_dir: str,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    as_of: datetime | Column | None = None,
    merge_options: Mapping[str, Any] | None = None,
    ledger: Ledger = Ledger(),
    load_id: str | None = None,
    windows: Windows | None = None,
    **options,
) -> LoadReport:
    """Parse, check and stage once; merge what is good. Repeating it adds no rows.

    ``merge_options`` go to the merge (other keys, ``stamp_inserts``, ``only_if_changed``), all
    other options to the extract (``in_bytes``, ``fail_fast``, ``rules``, ``earliest``, ``latest``).

    A load whose ``load_id`` the log of the ``ledger`` has as done is not run again; its report is the one of the first time.
    ``windows`` are several windows for one load instead of ``start`` and ``end``. ``bodies`` may be a function that opens them, so
    that what cannot be opened is a failed load in the log too.
    """
    load_id = load_id or new_id()
    if windows is None:
        windows = [(as_utc(start), as_utc(end))] if start is not None and end is not None else []
    if ledger.log is not None and (known := ledger.log.counts(load_id)) is not None:
        return LoadReport(**{k: known[k] for k in COUNTS if k != "rows_in"})
    try:
        report = _load(bodies() if callable(bodies) else bodies, store, stage_dir, start, end, as_of, merge_options, ledger, load_id, windows, options)
    except Exception as problem:
        if ledger.log is not None:
            ledger.log.failed(load_id, windows, f"{type(problem).__name__}: {problem}")
        raise
    if ledger.log is not None:
        ledger.log.done(load_id, windows, {"rows_in": report.good + report.quarantined, **asdict(report)})
    return report


def _load(bodies, store, stage_dir, start, end, as_of, merge_options, ledger, load_id, windows, options) -> LoadReport:
    if len(windows) > 1:
        extracted = P.within(P.extract_measurements(bodies, **options), windows)
    else:
        extracted = P.extract_measurements(bodies, start, end, **options)
    rules = options.get("rules", S.STG_MEASUREMENTS)
    staged = stage(extracted, stage_dir, rules)
    if ledger.quarantine is not None and staged.counts[QUARANTINE]:
        ledger.quarantine.add(staged.quarantined(), load_id)
    counts = store.merge(
        staged.good(), as_of=as_of, partials=ledger.partials, **{"on_duplicate": "dedupe", **(merge_options or {})}
    )
    staged.finished()
    return LoadReport(staged.counts[GOOD], staged.counts[QUARANTINE], **counts)


def load_window(
    spark: SparkSession,
    path: str | list[str],
    store: FactStore,
    start: datetime | str,
    end: datetime | str,
    stage_dir: str | None = None,
    as_of: datetime | Column | None = None,
    whole_files: bool = False,
    **options,
) -> LoadReport:
    """Load the measurements of ``[start, end)`` from the saved responses under ``path``.

    Hand in the folder of that window, not the whole landing area: what is read is what it costs.
    ``whole_files`` takes each file as one body, for pretty-printed responses, and deals its elements over tasks.
    """
    low, high = as_utc(start), as_utc(end)
    name = f"measurements/{low:%Y%m%dT%H%M%S}-{high:%Y%m%dT%H%M%S}"
    return load_bodies(
        lambda: read_bodies(spark, path, whole_files),
        store,
        stage_dir or shared_dir(spark, name),
        low,
        high,
        as_of,
        **{"spread": whole_files, **options},
    )


def load_all(
    spark: SparkSession,
    landing: str,
    tables: tuple[Dimension, Dimension, FactStore],
    start: datetime | str,
    end: datetime | str,
    as_of: datetime | Column | None = None,
    whole_files: bool = False,
) -> dict[str, dict[str, int] | LoadReport]:
    """One whole run over ``<landing>/locations``, ``countries``, ``parameters``, ``measurements``.

    Locations come before the names of their countries; the rest could run in any order. All four
    are staged in folders of this run. Returns what was staged, and the report of the fact.
    """
    dim_location, dim_parameter, fact = tables
    folder = shared_dir(spark, "staging")

    def staged(name: str, extract, rules) -> Staged:
        bodies = read_bodies(spark, f"{landing}/{name}", whole_files)
        return stage(extract(bodies), f"{folder}/{name}", rules)

    locations = staged("locations", P.extract_locations, S.STG_LOCATIONS)
    countries = staged("countries", P.extract_countries, S.STG_COUNTRIES)
    parameters = staged("parameters", P.extract_parameters, S.STG_PARAMETERS)
    refresh_locations(
        dim_location, locations.good(), countries.good(), as_of, order_by=["lastupdated"]
    )
    refresh_parameters(dim_parameter, parameters.good(), as_of)
    report = load_window(
        spark, f"{landing}/measurements", fact, start, end, f"{folder}/measurements", as_of, whole_files
    )
    return {
        "locations": locations.counts,
        "countries": countries.counts,
        "parameters": parameters.counts,
        "measurements": report,
    }


def load_range(
    spark: SparkSession,
    path: str | list[str],
    store: FactStore,
    start: datetime | str,
    end: datetime | str,
    **options,
) -> LoadReport:
    """A backfill of any length as one load instead of one per hour, with the same rows."""
    return load_window(spark, path, store, start, end, **options)


def load_missing(
    spark: SparkSession,
    path: str | list[str],
    store: FactStore,
    ledger: Ledger,
    start: datetime | str,
    end: datetime | str,
    stage_dir: str | None = None,
    as_of: datetime | Column | None = None,
    whole_files: bool = False,
    **options,
) -> LoadReport | None:
    """Load what the log has no finished load for, in one load, and log it. None if nothing is missing.

    What comes to the driver are the missing stretches, which neither overlap nor touch.
    """
    found = gaps(ledger.log.windows(), start, end).collect()
    if not found:
        return None
    windows = sorted(tuple(row) for row in found)
    return load_bodies(
        lambda: read_bodies(spark, path, whole_files),
        store,
        stage_dir or shared_dir(spark, "measurements/missing"),
        windows[0][0],
        windows[-1][1],
        as_of,
        ledger=ledger,
        windows=windows,
        **{"spread": whole_files, **options},
    )


def replay_quarantine(
    store: FactStore, ledger: Ledger, stage_dir: str | None = None, replay_id: str | None = None,
    as_of: datetime | Column | None = None, **options,
) -> LoadReport:
    """Read all open elements by the rules of now (``rules`` and other options of the extract), load what has become good and close it.

    Each row carries the hash of the element it came from. Elements are closed after the merge: a replay that died before that
    finds its own rows when it is repeated.
    """
    quarantine = ledger.quarantine
    spark, replay_id = store.spark, replay_id or new_id()
    rules = options.get("rules", S.STG_MEASUREMENTS)
    extracted = P.extract_measurements(quarantine.bodies(), keep=(HASH,), **options)
    staged = stage(extracted, stage_dir or shared_dir(spark, "replay"), rules)
    counts = store.merge(staged.good(), as_of=as_of, on_duplicate="dedupe", partials=ledger.partials)
    quarantine.close(staged.good(HASH), replay_id)
    return LoadReport(staged.counts[GOOD], staged.counts[QUARANTINE], **counts)


def load_previous_hour(
    spark: SparkSession, path: str | list[str], store: FactStore, now: datetime, **options
) -> LoadReport:
    return load_window(spark, path, store, *previous_hour(as_utc(now)), **options)


def alerts_between(
    fact: DataFrame | FactStore | PartialStore,
    start_day: date | str | None = None,
    end_day: date | str | None = None,
    parameters: str | list[str] | None = None,
) -> DataFrame:
    """Countries above the daily average on the days ``start_day .. end_day``, from whatever holds the measurements or their sums."""
    if isinstance(fact, PartialStore):
        return A.above_average_of(fact.read(start_day, end_day, parameters))
    rows = fact.read(start_day, end_day) if isinstance(fact, FactStore) else fact
    return A.above_average(rows, start_day, end_day, parameters)


def alerts_by_rule(
    fact: DataFrame | FactStore | PartialStore,
    rules: DataFrame,
    start_day: date | str | None = None,
    end_day: date | str | None = None,
) -> DataFrame:
    """The messages of all rules (a table, see ``operators.rules``) in one pass over the measurements or their sums."""
    return messages_of_rules(alerts_between(fact, start_day, end_day), rules)


def newest_alerts(store: FactStore, parameters: str | list[str] | None = None) -> DataFrame:
    """Alerts of the newest stored day; the plan prunes all other folders when it runs."""
    return A.above_average_of_day(store.read(), None, parameters, days=store.days())


def daily_alerts(
    fact: DataFrame | FactStore | PartialStore,
    start_day: date | str,
    end_day: date | str | None = None,
    parameters: str | list[str] | None = None,
    *,
    recipients: str | list[str],
    sent: DataFrame | None = None,
) -> DataFrame:
    """Messages for one day or a span of days, one row per recipient.

    Given the store, only the folders of those days are listed and read; given the partials that the loads keep, no fact at all.
    """
    found = alerts_between(fact, start_day, end_day or start_day, parameters)
    addressed = A.address(A.alert_messages(found), recipients)
    return addressed if sent is None else A.not_yet_sent(addressed, sent)


def post_alerts(
    fact: DataFrame | FactStore | PartialStore,
    outbox: Outbox,
    start_day: date | str,
    end_day: date | str | None = None,
    parameters: str | list[str] | None = None,
    *,
    recipients: str | list[str],
) -> DataFrame:
    """The daily alerts appended to the outbox, each once however often the run is repeated.

    Returns what this run has appended.
    """
    return outbox.post(daily_alerts(fact, start_day, end_day, parameters, recipients=recipients))
