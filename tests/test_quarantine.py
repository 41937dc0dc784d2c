"""Malformed rows are set aside with a reason, and every row is accounted for."""

import os

from pacelake.schema import SOURCE_HEADERS
from pacelake.sources.results_csv import read_results
from pacelake.streaming import quarantine as qr

HEADER = ",".join(SOURCE_HEADERS)
N = len(SOURCE_HEADERS)
GOOD = ["2001", "06.01.2001", "Race, one", "50km", "12", "4:51:39 h", "Club", "NOR", "1970", "M", "M30", "10.3", "17"]


def line(**changes):
    cells = list(GOOD)
    for i, v in changes.items():
        cells[int(i[1:])] = v
    return ",".join(f'"{x}"' if "," in x else x for x in cells)


def land(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.csv", "w") as f:
        f.write("\n".join([HEADER, *lines]) + "\n")


def test_reasons_and_reconciliation(spark, tmp_dir):
    landing, table = f"{tmp_dir}/landing", f"{tmp_dir}/rows"
    ends = qr.SOURCE_SCHEMA.fieldNames()
    typed = [i for i, f in enumerate(qr.SOURCE_SCHEMA.fields) if f.dataType.typeName() != "string"]
    bad = {f"bad {qr.RENAME.get(ends[i], ends[i])}": line(**{f"c{i}": "x1"}) for i in typed}
    land(f"{landing}/a", "one", [line(), line(c3=""), *bad.values(), ",".join(GOOD[:2] + GOOD[3:7]), line() + ",extra"])
    rows = qr.ingest_marked(spark, landing, table, f"{tmp_dir}/cp").collect()
    aside = sorted(r.reason for r in rows if r.set_aside)
    assert aside == sorted([*bad, qr.SHORT, qr.LONG])
    kept = [r for r in rows if not r.set_aside]
    assert len(kept) == 2 and all(r.reason is None and r._raw is None and r.event_name == "Race, one" for r in kept)
    # a second drop, a rerun with nothing new: each file once, nothing missing
    land(f"{landing}/b", "two", [line(), line(c0="20x1"), line(c0="")])
    for _ in range(2):
        df = qr.ingest_marked(spark, landing, table, f"{tmp_dir}/cp")
    report = {os.path.basename(r.source_file): (r.n_in, r.n_kept, r.n_set_aside, r.n_missing) for r in qr.reconcile(spark, landing, df).collect()}
    assert report == {"one.csv": (len(rows), 2, len(rows) - 2, 0), "two.csv": (3, 2, 1, 0)}
    assert sorted(os.path.basename(d) for d in os.listdir(table) if "=" in d) == ["set_aside=false", "set_aside=true"]


def test_kept_rows_are_those_of_the_plain_reader(spark, tmp_dir):
    land(f"{tmp_dir}/l", "one", [line(c12=str(i)) for i in range(20)])
    marked = qr.read_marked(spark, f"{tmp_dir}/l").where("not set_aside")
    plain = read_results(spark, f"{tmp_dir}/l")
    columns = [c for c in plain.columns if c != "ingest_ts"]
    assert set(marked.select(*columns).collect()) == set(plain.select(*columns).collect())


def test_missing_rows_show(spark, tmp_dir):
    land(f"{tmp_dir}/l", "one", [line(), line()])
    qr.read_marked(spark, f"{tmp_dir}/l").limit(1).write.parquet(f"{tmp_dir}/rows")
    table = spark.read.parquet(f"{tmp_dir}/rows")
    assert [(r.n_in, r.n_missing) for r in qr.reconcile(spark, f"{tmp_dir}/l", table).collect()] == [(2, 1)]
