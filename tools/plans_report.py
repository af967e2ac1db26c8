"""Write PLANS.md: physical plans of the headline operators over stored tables.

    python tools/plans_report.py [sf_dir]

Plans are taken after execution (AQE final plans) on tables written to the
session's shared scratch folder; results are collected, so use a small scale
factor.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from tidemark.operators.fold import fold_operations  # noqa: E402
from tidemark.operators.validate import split_messages  # noqa: E402
from tidemark.operators.versioning import live_snapshot  # noqa: E402
from tidemark.plans import queries as Q  # noqa: E402
from tidemark.plans.registry import AS_OF, history  # noqa: E402
from tidemark.session import local_session, scratch_path  # noqa: E402
from tidemark.sinks.table import read_history, read_state, write_history, write_snapshot  # noqa: E402
from tidemark.sources import adapters  # noqa: E402


def final_plan(df) -> str:
    df.collect()  # run this DataFrame's own query execution, so AQE finalises its plan
    text = df._jdf.queryExecution().executedPlan().toString()
    if "== Final Plan ==" in text:
        text = text.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    text = re.sub(r"#\d+L?", "", text)
    text = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "Location: ...", text)
    lines = [ln.rstrip() for ln in text.splitlines() if ln.strip() and ln.strip() != "+-"]
    # scans are shown whole (columns, partition and pushed filters), other lines to their first part
    return "\n".join(ln if "FileScan" in ln else ln[:220] for ln in lines)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8, app="plans")
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    root = scratch_path(spark, "plans")
    v = history(spark, sf_dir)
    write_history(v.where("version = 1"), f"{root}/h", batch_id=0)
    write_history(v.where("version > 1"), f"{root}/h", batch_id=1)
    write_snapshot(spark, f"{root}/h", f"{root}/s", through=0)
    h = read_history(spark, f"{root}/h")
    st = read_state(spark, f"{root}/h", f"{root}/s")
    ops, _ = split_messages(adapters.changelog_a(spark, sf_dir))
    cases = [
        ("Fold (one exchange on id, one sort)", fold_operations(ops)[0]),
        ("Live snapshot over history (partial WindowGroupLimit before the exchange)", live_snapshot(h)),
        ("Q-1 event by id (id filter pushed to the scan)", Q.get_event(h, "5")),
        ("Q-2 session events (winners on key columns, full rows under the session filter)", Q.get_events_by_conversation(h, "conv_5")),
        ("Q-3 error counts over history (month pruning, narrow columns)", Q.get_error_counts(h, "event_a", 7, AS_OF)),
        ("Q-4 p95 over history", Q.get_latency_stats(h, 100)),
        ("Q-5 error sessions over history", Q.get_top_error_sessions(h, 100)),
        ("Q-3 on the merge-on-read state", Q.get_error_counts(st, "event_a", 7, AS_OF, deduped=True)),
        ("Q-4 on the merge-on-read state", Q.get_latency_stats(st, 100, deduped=True)),
        ("Q-5 on the merge-on-read state", Q.get_top_error_sessions(st, 100, deduped=True)),
    ]
    out = ["# Physical plans", "",
           f"Generated by `tools/plans_report.py` on `{sf_dir}` (local[8], AQE final plans; expression ids stripped).", ""]
    for title, df in cases:
        out += [f"## {title}", "", "```", final_plan(df), "```", ""]
    with open(__file__.rsplit("/tools/", 1)[0] + "/PLANS.md", "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
