"""The full run: collect records, resolve names, write backups and tabs."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from entityflow.operators.reports import or_empty, run_summary
from entityflow.operators.resolve import DEFAULT_THRESHOLD, apply_mapping, mapping_log, occurrences, resolve
from entityflow.schemas import JOB, NAME_FIELD, NEWS, PRODUCT, RECORD_TYPES, RESEARCH_PAPER, STARTUP, envelope_schema
from entityflow.session import path_exists, settle
from entityflow.sinks.tabs import (
    jobs_tab,
    mapping_log_tab,
    news_tab,
    papers_tab,
    products_tab,
    publish_tabs,
    startups_tab,
    write_backups,
)

TABS = {
    STARTUP: ("Startups", startups_tab, "startups"),
    PRODUCT: ("Products", products_tab, "products"),
    RESEARCH_PAPER: ("Research Papers", papers_tab, "research_papers"),
    JOB: ("Jobs", jobs_tab, "jobs"),
    NEWS: ("News", news_tab, "news"),
}


@dataclass
class RunResult:
    records: dict[str, DataFrame]
    log: DataFrame
    summary: DataFrame
    errors: dict[str, str] = field(default_factory=dict)
    backups: dict[str, str] = field(default_factory=dict)
    tabs: dict[str, str] = field(default_factory=dict)


def side_by_side(steps: Mapping[str, Callable]) -> dict:
    """Run independent steps at the same time, so the tail of one leaves no executor idle; results by name."""
    with ThreadPoolExecutor(max_workers=max(1, len(steps))) as pool:
        running = {name: pool.submit(inheritable_thread_target(step)) for name, step in steps.items()}
        return {name: future.result() for name, future in running.items()}


def resolve_records(
    records: Mapping[str, DataFrame],
    seeds: DataFrame | None = None,
    threshold: float = DEFAULT_THRESHOLD,
    scores: bool = False,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """(records with canonical names, mapping log); papers and news carry no company name."""
    named = {t: records[t] for t in RECORD_TYPES if t in NAME_FIELD and t in records}
    uses = occurrences({t: (df, f"content.{NAME_FIELD[t]}", None) for t, df in named.items()})
    resolved = settle(resolve(uses, seeds, threshold, scores=scores), "name-map")
    mapped = dict(records)
    for record_type, df in named.items():
        mapped[record_type] = apply_mapping(df, resolved, f"content.{NAME_FIELD[record_type]}")
    return mapped, mapping_log(uses, resolved, with_open=scores)


def run(
    spark: SparkSession,
    builders: Mapping[str, Callable[[], DataFrame]],
    folder: str,
    seeds: DataFrame | None = None,
    threshold: float = DEFAULT_THRESHOLD,
    publish: bool = True,
    scores: bool = False,
) -> RunResult:
    """Run every record plan, resolve names once, write backups, then publish the tabs.

    ``builders`` maps a record type to a function giving its records; they
    run side by side. A failing plan costs only its own rows: what an earlier run stored, backed up and published of that
    type is left as it is, and ``errors`` says why. Records are written once and all later steps read that table, so no page
    is extracted twice. A failure to publish leaves the backups in place. ``scores`` adds the best score of unmatched names
    to the log, at the price of scoring them.
    """
    root = folder.rstrip("/")

    def collect(record_type: str) -> DataFrame:
        place = f"{root}/collected/{record_type}"
        wanted = [f.name for f in envelope_schema(record_type).fields]
        builders[record_type]().select(*wanted).write.mode("overwrite").parquet(place)
        return spark.read.parquet(place)

    collected = side_by_side({
        t: lambda t=t: or_empty(spark, lambda: collect(t), envelope_schema(t)) for t in RECORD_TYPES
    })
    errors = {t: error for t, (_, error) in collected.items() if error}
    mapped, log = resolve_records({t: df for t, (df, _) in collected.items()}, seeds, threshold, scores)

    def store(name: str, df: DataFrame) -> DataFrame:
        place = f"{root}/records/{name}"
        df.write.mode("overwrite").parquet(place)
        return spark.read.schema(df.schema).parquet(place)

    done = {t: df for t, df in mapped.items() if t not in errors}
    stored = side_by_side({name: lambda n=name, d=df: store(n, d) for name, df in {**done, "mapping_log": log}.items()})
    log = stored.pop("mapping_log")
    stored = {t: stored[t] if t in stored else df for t, df in mapped.items()}
    log_tab = mapping_log_tab(log)

    result = RunResult(stored, log, run_summary(stored, log), errors)
    # A failed type gets empty output only where there was none before.
    sound = {t: df for t, df in stored.items() if t not in errors or not path_exists(spark, f"{root}/backups/{TABS[t][2]}")}
    flat = {**{TABS[t][2]: df for t, df in sound.items()}, "entity_mapping_log": log_tab}
    for paths in side_by_side({n: lambda n=n, d=d: write_backups({n: d}, f"{root}/backups") for n, d in flat.items()}).values():
        result.backups.update(paths)
    if publish:
        tabs = {**{TABS[t][0]: TABS[t][1](df) for t, df in sound.items()}, "Entity Mapping Log": log_tab}
        try:
            for places in side_by_side({n: lambda n=n, d=d: publish_tabs({n: d}, folder=f"{root}/tabs") for n, d in tabs.items()}).values():
                result.tabs.update(places)
        except Exception as error:  # the backups are already safe
            result.errors["publish"] = f"{type(error).__name__}: {error}"
    return result
