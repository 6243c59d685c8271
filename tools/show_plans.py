"""Print the physical plan trees (explain "formatted", tree part plus scan details) of the key queries.

    python tools/show_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NOTES = {
    "window_avg": "Pane plan: scan of 3 columns, partial+final aggregation per 30 s pane (BIGINT key), "
    "then `Generate` (explode) on pane rows and a second partial+final aggregation per window; "
    "the only `Filter` runs on aggregated rows.",
    "window_avg_by_sensor": "Same two stages keyed by (pane, sensor id); `user_id` joins the scan.",
    "alerts": "Windows listed once per combination of tree levels in use, rules at the nodes that make up their range on all "
    "axes; equi-join on the node numbers plus the exact predicate, Spark's choice to broadcast the few rules.",
    "supplier_rule_hits": "The same join with a rule per supplier, then a count per rule.",
    "decode_readings": "One `from_json` per message; fields read from its struct.",
    "stream_alerts (executed micro-batch)": "Streaming alerts in append mode, as executed for the query's last micro-batch (the eviction batch without new "
    "input, hence the empty scan; batches with data have the same operators over the file source): "
    "partial aggregation before the state shuffle, `StateStoreRestore`/`StateStoreSave` keyed by window (eviction by "
    "watermark), and the stream-static equi-join on tree nodes with the rules broadcast.",
}


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    head = text.split("\n\n")[0]
    scans = re.findall(r"\(\d+\) Scan [^\n]*\n(?:[^\n]+\n)*?ReadSchema: [^\n]*", text)
    return head + "\n\n" + "\n\n".join(scans)


if __name__ == "__main__":
    from sensorwatch.plans.queries import QUERIES
    from sensorwatch.session import local_session
    from sensorwatch.sources.rules import read_rules

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    frames = {name: QUERIES[name](spark, sf) for name in ("window_avg", "window_avg_by_sensor", "alerts", "supplier_rule_hits", "decode_readings")}
    from sensorwatch.session import run_dir
    from sensorwatch.streaming import jobs, sinks

    base = run_dir(spark, "show_plans")
    alerts = jobs.alerts_stream(jobs.event_file_readings(spark, sf), read_rules(spark))
    q = sinks.start_table(alerts, f"{base}/table", f"{base}/checkpoint", state_partitions=4)
    q.awaitTermination()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain()
    stream_tree = "\n".join(ln for ln in buf.getvalue().splitlines() if ln.strip())

    print("# Physical plans of the key queries\n")
    print(f"Generated by `tools/show_plans.py` on `{sf}` (local session, AQE on; `isFinalPlan=false`, i.e. before")
    print("run-time re-planning). Operator trees only, plus the scan details.\n")
    for name, df in frames.items():
        print(f"## {name}\n\n{NOTES[name]}\n\n```\n{tree(df)}\n```\n")
    name = "stream_alerts (executed micro-batch)"
    print(f"## {name}\n\n{NOTES[name]}\n\n```\n{stream_tree}\n```")
