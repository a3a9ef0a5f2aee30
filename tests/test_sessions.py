"""Event-time sessions: against a batch over the same events; state that ends; late rows."""

from datetime import datetime, timedelta

from basketry.streaming import sessions as ses

START = datetime(2024, 1, 1)


def write(spark, path, files):
    for rows in files:
        df = spark.createDataFrame([(i, START + timedelta(minutes=m) if m is not None else None, u, 1.0)
                                    for i, m, u in rows], ses.EVENT_SCHEMA)
        df.coalesce(1).write.mode("append").parquet(path)


def batch(rows, gap):
    out, open_ = [], {}
    for _, m, u in sorted((r for r in rows if r[1] is not None and r[2] is not None), key=lambda r: r[1]):
        if u in open_ and m <= open_[u][-1] + gap:
            open_[u].append(m)
        else:
            out.append((u, [m]))
            open_[u] = out[-1][1]
    return sorted((u, ms[0], ms[-1], len(ms)) for u, ms in out)


def test_sessions_close_and_late_rows_go_aside(spark, tmp_out):
    files = [[(1, 0, 1), (2, 5, 1), (3, 2, 2), (4, 1, None)],
             [(5, 100, 2), (6, 14, 1), (7, 103, 2), (8, 95, 3)],
             [(9, 200, 1), (10, 20, 1), (11, 99, 3), (12, None, 1), (13, 205, 2)],
             [(14, 400, 1), (15, 195, 2)]]
    write(spark, f"{tmp_out}/source", files)
    closed, late, state = ses.sessionise_folder(spark, f"{tmp_out}/source", tmp_out, "10 minutes",
                                                "30 minutes")
    # Watermarks at the epochs: none, 5 - 30, 103 - 30 = 73, 205 - 30 = 175.
    lost = {10, 12}
    assert {r.event_id for r in late.collect()} == lost
    minutes = lambda t: int((t - START).total_seconds() // 60)
    got = sorted((r.user_id, minutes(r.start), minutes(r.last_ts), r.n_events) for r in closed.collect())
    assert got == batch([r for f in files for r in f if r[0] not in lost], 10)
    assert max(state) > min(state) and state[-1] == 0   # closed sessions leave the state


def test_epochs_do_not_matter(spark, tmp_out):
    rows = [(i, (i * 37) % 500, i % 5) for i in range(200)]
    write(spark, f"{tmp_out}/source", [rows[:80], rows[80:]])
    results = []
    for files in (1, 10):
        closed, late, _ = ses.sessionise_folder(spark, f"{tmp_out}/source", f"{tmp_out}/{files}",
                                                "10 minutes", "10 hours", files)
        assert late.isEmpty()
        results.append(sorted(tuple(r) for r in closed.collect()))
    assert results[0] == results[1] and len(results[0]) > 20


def test_no_events(spark, tmp_out):
    write(spark, f"{tmp_out}/source", [[(1, None, 1)]])
    closed, late, _ = ses.sessionise_folder(spark, f"{tmp_out}/source", tmp_out, "1 minute", "1 minute")
    assert closed.isEmpty() and late.count() == 1
