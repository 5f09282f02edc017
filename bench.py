"""Time the headline queries; print one JSON line.

Each query runs once to warm up and once timed, and every row and column is
produced (written to Spark's ``noop`` sink). Entities are timed from the input
tables; metrics, wide tables and scorecards from stored entities, as in a build.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry import queries as registry  # noqa: E402
from scorecard.plans.build import ContactLink, build  # noqa: E402
from scorecard.session import local_session  # noqa: E402

HEADLINE = (
    "latest_transaction",
    "current_scd2",
    "monthly_history",
    "policy_entity_flat",
    "change_events",
    "change_event_entity_flat",
    "survey_campaign_by_type",
    "survey_responses",
    "contact_events_by_contact",
    "metric_InForce90DaysAfterChangeFlag",
    "metric_MovedPolicyRetentionRate90Days",
    "policy_metrics",
    "policy_wide_flat",
    "change_event_wide_flat",
    "survey_wide_flat",
    "changed_address",
    "changed_producer",
    "onboarding_cohort_first",
    "view_AgencyChangeSurvey",
    "upsert_policy",
    "upsert_events",
    "dq_summary",
)


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return round(time.perf_counter() - started, 3)


def scale_of(folder: str) -> float | str:
    name = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    try:
        return float(name)
    except ValueError:
        return name


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    known = registry.queries()
    seconds: dict[str, float] = {}
    for name in HEADLINE:

        def run(query=known[name]):
            query(spark, folder).write.format("noop").mode("overwrite").save()

        run()
        seconds[name] = timed(run)
    with tempfile.TemporaryDirectory(prefix="scorecard-bench-") as out:
        sources = registry.Tables(spark, folder).sources
        link = ContactLink("email", "email")
        seconds["build_full"] = timed(
            lambda: build(spark, sources, out, registry.AS_OF, contact_link=link)
        )
    print(
        json.dumps(
            {
                "metric": "total seconds, scorecard queries and one full build",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": scale_of(folder),
            }
        )
    )


if __name__ == "__main__":
    main()
