import random

from crawlweave.operators.lifecycle import active_time


def serial(rows):
    out, state, start, active, prev = {}, {}, {}, {}, {}
    for crawl, t, tie, action in sorted(rows, key=lambda r: (r[1], r[2])):
        s = state.get(crawl, "idle")
        active.setdefault(crawl, 0)
        if action == "start":
            new, active[crawl] = ("paused" if s == "paused" else "running"), 0
        else:
            if s == "running":
                active[crawl] += t - prev[crawl]
            new = {
                ("pause", "running"): "paused", ("resume", "paused"): "running",
                ("end", "running"): "finished", ("end", "paused"): "finished",
            }.get((action, s), "idle" if action == "clear" else s)
        state[crawl], prev[crawl] = new, t
        out[tie] = (s, new, 0 if new == "idle" else active[crawl])
    return out


def test_equals_serial_machine(spark):
    rnd = random.Random(3)
    actions = ["start", "pause", "resume", "end", "page", "page", "clear"]
    rows = [(rnd.choice([1, 1, 1, 2, 3]), rnd.randrange(20_000), i, rnd.choice(actions)) for i in range(1_500)]
    df = spark.createDataFrame(rows, "crawl_id bigint, t_ms bigint, event_id bigint, action string")
    got = active_time(df, width=500).collect()
    assert {r["event_id"]: (r["state_before"], r["state"], r["active_ms"]) for r in got} == serial(rows)
