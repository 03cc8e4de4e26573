"""Every job by name: ``name -> job(spark, input_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carebook.plans import attributes, cohorts, entries, export, history, register, relations, sketches, tallies
from carebook.streaming import jobs as streams
from carebook.streaming import relations as stream_relations

Job = Callable[[SparkSession, str], DataFrame]

JOBS: dict[str, Job] = {
    # flagship
    "district_entries_between": register.district_entries_between,
    # sources, sinks, quality
    "diary_quality_report": entries.diary_quality_report,
    "diary_day_export": export.diary_day_export,
    # filter, projection, JSON
    "diary_entries_between": entries.diary_entries_between,
    "attribute_counts": entries.attribute_counts,
    # joins
    "diary_enriched": register.diary_enriched,
    "persons_with_entries": register.persons_with_entries,
    "persons_without_entries": register.persons_without_entries,
    "visits_without_services": register.visits_without_services,
    "entries_with_last_signup": relations.entries_with_last_signup,
    "concurrent_care": relations.concurrent_care,
    "neighbour_visits": relations.neighbour_visits,
    # aggregation
    "person_day_services": tallies.person_day_services,
    "worker_month_load": tallies.worker_month_load,
    "district_rollup": tallies.district_rollup,
    "district_by_kind": tallies.district_by_kind,
    "same_day_visits": tallies.same_day_visits,
    # windows, top-k
    "latest_entry": history.latest_entry,
    "visit_gaps": history.visit_gaps,
    "running_and_trailing_load": history.running_and_trailing_load,
    "top_workers_by_district": history.top_workers_by_district,
    # time structure
    "care_episodes": history.care_episodes,
    "days_without_entry": history.days_without_entry,
    "weekly_sliding_tally": tallies.weekly_sliding_tally,
    # set operations
    "lapsed_persons": cohorts.lapsed_persons,
    "retained_persons": cohorts.retained_persons,
    # streaming (drained once with availableNow)
    "daily_tally_stream": streams.daily_tally_stream,
    "dedup_entries_stream": streams.dedup_entries_stream,
    "enrich_stream": streams.enrich_stream,
    "episodes_stream": streams.episodes_stream,
    "errors_resolved_stream": stream_relations.errors_resolved_stream,
    "silent_person_stream": stream_relations.silent_person_stream,
    # stored state, semi-structured attributes, table function
    "period_persons_sketch": sketches.period_persons_sketch,
    "amount_quantiles_sketch": sketches.amount_quantiles_sketch,
    "attribute_profile": attributes.attribute_profile,
    "worker_rota": attributes.worker_rota,
}
