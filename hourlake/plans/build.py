"""Bronze to gold in one call: each table is an ordinary function, called in dependency order."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from hourlake.operators.calendar import dim_date
from hourlake.operators.checks import STATES, raise_on_failure, row_states, run_checks, summarise
from hourlake.operators.retention import retained
from hourlake.operators.upsert import batches, replace_partitions, unconsumed, upsert_table
from hourlake.plans import gold, marts, silver
from hourlake.plans.health import pipeline_health
from hourlake.plans.ingest import read_run_log
from hourlake.plans.quality import default_checks
from hourlake.schemas import DIM_ACTOR, DIM_REPO, FACT_EVENTS, LEDGER
from hourlake.session import pin_utc
from hourlake.sources.bronze import read_bronze
from hourlake.sources.files import read_or_empty
from hourlake.sources.manifest import current, drop_unreferenced
from hourlake.sources.scratch import written
from hourlake.sources.tables import append, drop_old_versions, publish, published, versions as versions_of

OPENED = "repo_id bigint, pr_number int, opened_at timestamp_ntz"
ACTIVITY = (
    "repo_id bigint, date_key int, date_day timestamp_ntz, category string, event_count bigint, "
    "distinct_contributors bigint, push_event_count bigint"
)
VOLUME = "date_key int, event_hour bigint, event_count bigint"
#: Complete builds, with the versions of the tables that later builds compare with; days a build is changing.
BUILDS = "build bigint, run_id string, dim_repo bigint, opened_prs bigint"
DIRTY = "build bigint, date_key int"


@dataclass(frozen=True)
class LakePaths:
    """Where things are below one root folder."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/events"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/bronze/quarantine"

    @property
    def run_log(self) -> str:
        return f"{self.root}/gold/ops/pipeline_runs"

    @property
    def check_results(self) -> str:
        return f"{self.root}/gold/ops/check_results"

    @property
    def ledger(self) -> str:
        return f"{self.root}/gold/ops/consumed_batches"

    @property
    def builds(self) -> str:
        return f"{self.root}/gold/ops/builds"

    @property
    def dirty_days(self) -> str:
        return f"{self.root}/gold/ops/dirty_days"

    def silver(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"


#: Tables that every build publishes anew.
SILVER = ("stg_events", "stg_repos", "stg_actors", "pr_lifecycle")
REBUILT = ("dim_date", "dim_event_type", "dim_actor", "dim_repo", "opened_prs", "mart_pr_lifecycle", "mart_pipeline_health")
#: Tables of which only touched days are written anew.
CHANGED = ("fact_events", "mart_daily_repo_activity", "mart_hourly_volume", "contributors", "merge_paces", "ops/check_states")


def _version(spark: SparkSession, path: str, number: int | None, schema) -> DataFrame:
    """A given version of a published table; no rows without a number."""
    return read_or_empty(spark, f"{path}/v={number or 0}", schema)


def check_states(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """Violations of the fact's row-level checks by day, as the last change of each day left them."""
    return current(spark, paths.gold("ops/check_states"), f"{STATES}, date_key int")


def _publish(df: DataFrame, path: str) -> DataFrame:
    """Publish and go on from the published copy."""
    return df.sparkSession.read.schema(df.schema).parquet(publish(df, path))


def build(
    spark: SparkSession,
    paths: LakePaths,
    now: datetime,
    run_id: str,
    retention_days: int | None = None,
    keep_versions: int = 2,
) -> dict[str, DataFrame]:
    """Bring all tables up to date and check them; raises if an error-severity check fails.

    Silver is rebuilt from the retained bronze. The fact takes batches it has not consumed, and takes
    again those retained events whose repository version or opening has changed since the last complete
    build (late data). The per-day marts are recomputed for just the days whose fact rows changed.

    A build that dies anywhere is repaired by the next one: batches count as consumed, and the build as
    complete, only after everything that follows from them is written; which days it was about to
    change is noted before it changes them. A complete build removes all but ``keep_versions``
    versions of the rebuilt tables.
    """
    pin_utc(spark)
    last = read_or_empty(spark, paths.builds, BUILDS).orderBy(F.desc("build")).first()
    number = last["build"] + 1 if last else 1
    bronze = read_bronze(spark, paths.bronze)
    if retention_days is not None:
        bronze = retained(bronze, now.date(), retention_days)
    t: dict[str, DataFrame] = {}
    t["stg_events"] = events = _publish(silver.stg_events(bronze), paths.silver("stg_events"))
    t["stg_repos"] = _publish(silver.stg_repos(events), paths.silver("stg_repos"))
    t["stg_actors"] = _publish(silver.stg_actors(events), paths.silver("stg_actors"))
    t["pr_lifecycle"] = _publish(gold.pr_lifecycle(events), paths.silver("pr_lifecycle"))
    t["pipeline_runs"] = read_run_log(spark, paths.run_log)

    t["dim_date"] = _publish(dim_date(spark), paths.gold("dim_date"))
    t["dim_event_type"] = _publish(gold.dim_event_type(spark), paths.gold("dim_event_type"))
    actors = published(spark, paths.gold("dim_actor"), DIM_ACTOR)
    t["dim_actor"] = _publish(gold.dim_actor(t["stg_actors"], actors), paths.gold("dim_actor"))
    repos = published(spark, paths.gold("dim_repo"), DIM_REPO)
    known_versions = _version(spark, paths.gold("dim_repo"), last and last["dim_repo"], DIM_REPO)
    known_opened = _version(spark, paths.gold("opened_prs"), last and last["opened_prs"], OPENED)
    versions = gold.with_repo_keys(gold.dim_repo_history(events, repos))
    t["dim_repo"] = _publish(versions, paths.gold("dim_repo"))
    known = published(spark, paths.gold("opened_prs"), OPENED)
    opened = _publish(gold.opened_prs(events, known), paths.gold("opened_prs"))

    ledger = read_or_empty(spark, paths.ledger, LEDGER)
    new = unconsumed(events, ledger)
    taken = written(batches(new), "batches")
    if last:
        stored = current(spark, paths.gold("fact_events"), FACT_EVENTS)
        again = gold.outdated(events, stored, known_versions, t["dim_repo"], known_opened, opened)
        ids = new.select("event_id").union(again).distinct()
        new = written(events.join(ids, "event_id", "left_semi"), "to-build")
    rows = gold.fact_events(new, t["dim_repo"], opened)

    def note(values: list) -> None:
        append(spark.createDataFrame([(number, v) for v in values], DIRTY).coalesce(1), paths.dirty_days)

    upsert_table(spark, paths.gold("fact_events"), rows, ["event_id"], "date_key", FACT_EVENTS, note)
    noted = read_or_empty(spark, paths.dirty_days, DIRTY).filter(F.col("build") == number)
    days = sorted(r[0] for r in noted.select("date_key").distinct().collect())

    fact = t["fact_events"] = current(spark, paths.gold("fact_events"), FACT_EVENTS)
    changed = fact.filter(F.col("date_key").isin(days))
    activity, volume = paths.gold("mart_daily_repo_activity"), paths.gold("mart_hourly_volume")
    if days:
        replace_partitions(
            marts.daily_repo_activity(changed, t["dim_date"], t["dim_event_type"]), activity, "date_key", days
        )
        replace_partitions(marts.hourly_volume(changed), volume, "date_key", days)
        replace_partitions(row_states(default_checks(now), "fact_events", changed, "date_key"), paths.gold("ops/check_states"), "date_key", days)
        replace_partitions(marts.daily_paces(changed), paths.gold("merge_paces"), "date_key", days)
        replace_partitions(marts.daily_contributors(changed, t["dim_event_type"]), paths.gold("contributors"), "date_key", days)
    # Only now: a run that dies before this line takes the same batches again, with the same result.
    append(taken.coalesce(1), paths.ledger)
    t["mart_daily_repo_activity"] = current(spark, activity, ACTIVITY)
    t["mart_hourly_volume"] = current(spark, volume, VOLUME)
    t["contributors"] = current(spark, paths.gold("contributors"), marts.CONTRIBUTORS)
    paces = marts.repo_paces(current(spark, paths.gold("merge_paces"), marts.PACES))
    t["mart_pr_lifecycle"] = _publish(marts.pr_lifecycle_mart(fact, paces=paces), paths.gold("mart_pr_lifecycle"))
    health = pipeline_health(t["pipeline_runs"], fact, now)
    t["mart_pipeline_health"] = _publish(health, paths.gold("mart_pipeline_health"))

    t["check_outcomes"] = outcomes = written(run_checks(default_checks(now), t, {"fact_events": check_states(spark, paths)}), "checks")
    append(summarise(outcomes, now, run_id).coalesce(1), paths.check_results)
    state = (number, run_id, *[versions_of(spark, paths.gold(n))[-1] for n in ("dim_repo", "opened_prs")])
    append(spark.createDataFrame([state], BUILDS).coalesce(1), paths.builds)
    for path in [paths.silver(n) for n in SILVER] + [paths.gold(n) for n in REBUILT]:
        drop_old_versions(spark, path, keep_versions)
    for path in [paths.gold(n) for n in CHANGED]:
        drop_unreferenced(spark, path, keep_versions)
    raise_on_failure(outcomes)
    return t
