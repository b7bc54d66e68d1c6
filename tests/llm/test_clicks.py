"""op11 against a plain loop, with odd rows, with and without announced horizons, and against its SQL."""

import datetime
import hashlib
import math
import os
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from broadleaf.llm import click_windows, queries
from broadleaf.llm.common import table
from harness import same

CLICKS = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string"


def micros(t):
    return None if t is None else (t - datetime.datetime(1970, 1, 1)) // datetime.timedelta(microseconds=1)


def plain(rows):
    copies = []
    text = lambda x: "" if x is None else str(x)
    for click_id, ts, arrived, client, kind, value, props in rows:
        if click_id is None or arrived is None or click_id < 0:
            continue
        for j in range(click_id % 3 + 1):
            c = zlib.crc32(f"{click_id}:{j}".encode())
            hour = micros(arrived) // 3_600_000_000 + 6 * j * (c % 10)
            amount = None if value is None else math.floor(100 * value + 0.5)
            whole = "|".join([text(client), text(kind), text(amount), text(micros(ts)), text(props), str(c % 3)])
            copies.append((click_id, hour, hour + c // 10 % 200, hashlib.sha256(whole.encode()).hexdigest()))
    low, high = min(c[2] for c in copies), max(c[2] for c in copies)
    batches, out, is_open, most = defaultdict(list), [], {}, -math.inf
    for click_id, hour, late, digest in copies:
        batches[(late - low) * 8 // (high - low + 1)].append((click_id, hour, digest))
    for b in range(8):
        for click_id, hour, digest in sorted(batches[b]):
            if hour < most - 96:
                continue
            w = is_open.get(click_id)
            if w and hour <= w[0] + 24:
                w[1] += 1
                if digest != w[4]:
                    w[2] += 1
                    w[3] += zlib.crc32(digest.encode())
            else:
                if w:
                    out.append((click_id, w[0], b, *w[1:]))
                is_open[click_id] = [hour, 0, 0, 0, digest]
        most = max([most, *(h for _, h, _ in batches[b])])
        for i in [i for i, w in is_open.items() if b == 7 or w[0] + 24 < most - 96]:
            out.append((i, is_open[i][0], b, *is_open.pop(i)[1:]))
    return sorted(out)


def odd(spark, sf_dir):
    at = datetime.datetime(2024, 2, 1, 3, 0, 0, 5)
    hour = datetime.timedelta(hours=1)
    rows = [(None, at, at, 1, "a", 1.0, "x"), (3, at, None, 1, "a", 1.0, "x"), (-1, at, at, 1, "a", 1.0, "x"), (4, None, at, None, None, None, None), (5, at, at, 2, "a|b", -0.005, "{|}"), (5, at, at, 2, "a|b", -0.005, "{|}"), (5, at, at + 30 * hour, 2, "ü", 2.5, "")]
    # one id with many rows, equal and unlike, over the whole time, and one whose window waits for a timer
    rows += [(8, at, datetime.datetime(2024, 1, 1) + k % 700 * 4 * hour, k % 3, "hot", k % 5 / 3, "p") for k in range(4000)] + [(9, at, datetime.datetime(2024, 1, 1) + 95 * hour, 1, "z", 1.0, "p")]
    plain_rows = table(spark, sf_dir, "clicks").selectExpr("click_id + 100 AS click_id", "ts", "arrived_at", "client_id", "kind", "value", "props")
    return spark.createDataFrame(rows, CLICKS).unionByName(plain_rows)


def test_windows_of_odd_rows(spark, sf_dir):
    df = odd(spark, sf_dir)
    wanted = plain(df.collect())
    assert any(w[3] for w in wanted) and {w[2] for w in wanted} == set(range(8))
    clashing = df.withColumn("bucket", F.lit("clash")).withColumn("hour", F.lit(1)).withColumn("body", F.lit(None))
    for announce in (True, False):
        got = click_windows.deduplicate(clashing.repartition(5), announce)
        assert sorted(tuple(r) for r in got.collect()) == wanted


def test_a_start_is_one_micro_batch(spark, sf_dir):
    df = odd(spark, sf_dir)
    got = click_windows.deduplicate(df)
    assert {f.split("/")[-2] for f in got.inputFiles()} == {f"{b}-{b}" for b in range(click_windows.BATCHES)}
    # few ids in a long time: most buckets have no copies in most batches, and their windows close all the same
    few = df.where("click_id IN (4, 5, 9)")
    assert sorted(tuple(r) for r in click_windows.deduplicate(few).collect()) == plain(few.collect())


def test_python_of_all_stages_shares_one_pool_of_workers(spark, sf_dir, tmp_path, monkeypatch):
    folder, pack, unpack, setting = str(tmp_path), click_windows._pack, click_windows._unpack, "spark.sql.execution.pyspark.udf.simplifiedTraceback.enabled"

    def noted(stage, run):
        def note(batches):
            open(f"{folder}/{stage}-{os.getppid()}", "w").close()
            yield from run(batches)

        return note

    class Noted(click_windows.Windows):
        def handleInputRows(self, key, rows, timerValues):
            open(f"{folder}/state-{os.getppid()}", "w").close()
            yield from super().handleInputRows(key, rows, timerValues)

    monkeypatch.setattr(click_windows, "_pack", noted("pack", pack))
    monkeypatch.setattr(click_windows, "_unpack", noted("unpack", unpack))
    monkeypatch.setattr(click_windows, "Windows", Noted)
    df, before = odd(spark, sf_dir), spark.conf.get(setting)
    got = click_windows.deduplicate(df)
    assert "MapInArrow" not in got._jdf.queryExecution().toString()
    assert sorted(tuple(r) for r in got.collect()) == plain(df.collect()) and spark.conf.get(setting) == before
    stages, pools = zip(*(f.name.split("-") for f in tmp_path.iterdir()))
    assert set(stages) == {"pack", "state", "unpack"} and len(set(pools)) == 1


def test_no_clicks(spark):
    none = click_windows.deduplicate(spark.createDataFrame([(None, None, None, 1, None, None, None)], CLICKS))
    assert none.count() == 0 and none.columns == ["click_id", "start_hour", "closed_batch", "n_repeats", "n_conflicts", "conflict_crc", "hash"]


def test_windows_against_sql(spark, sf_dir):
    same(queries.op11_click_windows(spark, sf_dir), queries.SQL["op11_click_windows"], sf_dir)


def test_scan_tasks_pack_few_rows_at_once():
    import pyarrow as pa

    n = 10_000
    batch = pa.RecordBatch.from_arrays([pa.array([0] * n, pa.int32()), pa.array(range(n), pa.int64()), pa.array([480_000] * n, pa.int64()), pa.array([1] * n, pa.int64()), pa.array([b"h" * 32] * n, pa.binary())], names=["bucket", "click_id", "hour", "crc", "hash"])
    sizes = [len(body.as_py()) // click_windows.COPY.itemsize for out in click_windows._pack([batch] * 14) for body in out.column("body")]
    assert sum(sizes) > 0 and max(sizes) <= 50_000 and len(sizes) > 2
