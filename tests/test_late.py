"""A stream with late rows and copies against a loop over its batches; batches that run again."""

import datetime
import json
import os
import random
import shutil

from sessiongrain.streaming import late, turns

SCHEMA = "id long, ts timestamp, note string"
START = datetime.datetime(2024, 1, 1)


def loop(batches, delay):
    kept, dropped, mark = [], [], None
    for rows in batches:
        bound = mark - delay if mark else None
        old = [r for r in rows if bound and r[1] and r[1] < bound]
        known = {r[0] for r in kept if not (bound and r[1] and r[1] < bound)}
        firsts = {}
        for r in sorted((r for r in rows if r not in old), key=lambda r: (r[1] is not None, r[1] or START, json.dumps(r[2]))):
            firsts.setdefault(r[0], r)
        kept += [r for k, r in firsts.items() if k not in known]
        dropped += old
        times = [r[1] for r in rows if r[1]]
        mark = max([t for t in (mark, *times) if t], default=None)
    order = lambda rows: sorted(rows, key=repr)
    return order(kept), order(dropped)


def test_late_rows_and_copies(spark, tmp_path):
    rnd = random.Random(6)
    batches, at = [], 0
    for _ in range(6):
        at += 20
        batches.append([(rnd.choice([None, *range(25)]), START + datetime.timedelta(minutes=at - rnd.choice([0, 3, 8, 30, 60])) if rnd.random() < 0.9 else None, rnd.choice("xyz")) for _ in range(12)])
    batches.insert(3, [])
    source, out = str(tmp_path / "in"), f"file://{tmp_path}/out"
    read = lambda: turns.read_events(spark, source, SCHEMA, 1)

    def put(i):
        spark.createDataFrame(batches[i], SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"w{i}"))
        os.makedirs(source, exist_ok=True)
        name = next(f for f in os.listdir(tmp_path / f"w{i}") if f.endswith(".parquet"))
        target = os.path.join(source, f"{i}.parquet")
        shutil.move(str(tmp_path / f"w{i}" / name), target)
        os.utime(target, (1_700_000_000 + i * 10,) * 2)

    def rows(df):
        return sorted(((r["id"], r["ts"], r["note"]) for r in df.collect()), key=repr)

    for upto in (4, len(batches)):  # the stream stops and goes on
        for i in range(upto):
            if not os.path.exists(os.path.join(source, f"{i}.parquet")):
                put(i)
        late.write_split(read(), out, f"{tmp_path}/check", ["id"]).awaitTermination()
        kept, dropped = loop(batches[:upto], datetime.timedelta(minutes=10))
        assert rows(late.on_time(spark, out, SCHEMA)) == kept and rows(late.late(spark, out, SCHEMA)) == dropped
    assert dropped and len(kept) < sum(map(len, batches)) - len(dropped)
    # The last batch runs again, as after a failure before its commit.
    last = max((f for f in os.listdir(tmp_path / "check" / "commits") if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        path = tmp_path / "check" / "commits" / name
        if path.exists():
            path.unlink()
    late.write_split(read(), out, f"{tmp_path}/check", ["id"]).awaitTermination()
    assert rows(late.on_time(spark, out, SCHEMA)) == kept and rows(late.late(spark, out, SCHEMA)) == dropped
