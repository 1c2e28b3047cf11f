import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.catalog import files
from ledgerloom.operators import ingest
from ledgerloom.operators.joins import day_spine
from ledgerloom.session import shared_dir
from ledgerloom.sources import readers, sinks
from ledgerloom.streaming import feeds

D = dt.date


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding=encoding)


def test_dumps_by_pattern_and_bad_rows(spark, tmp_path, rows):
    write(tmp_path / "daily_contracts_2024-01-05.csv", "id,amount\n1,10.5\n2,oops\n")
    write(tmp_path / "more" / "daily_contracts_2024-01-06.csv", "id,amount\n3,7\n")
    write(tmp_path / "other_2024-01-06.csv", "id,amount\n9,9\n")
    df = readers.csv_files(spark, str(tmp_path), "id int, amount double", "*daily_contracts*")
    assert rows(df, "id", "amount", readers.BAD_ROW) == [(1, 10.5, None), (2, None, "2,oops"), (3, 7.0, None)]
    assert rows(readers.latest_files(df), "id", "file_date") == [(3, D(2024, 1, 6))]
    assert rows(readers.newer_files(df, D(2024, 1, 4)), "id") == [(1,), (2,), (3,)]
    days = day_spine(spark, F.lit(D(2024, 1, 5)), F.lit(D(2024, 1, 7)), "file_date")
    write(tmp_path / "daily_contracts_2024-01-07.csv", "id,amount\n")
    files = readers.list_files(spark, str(tmp_path), "*daily_contracts*")
    days = days.unionByName(spark.createDataFrame([(D(2024, 1, 8),)], "file_date date"))
    assert rows(readers.load_audit(df, files, "contracts", days), "n_files", "n_rows", "status") == [
        (0, 0, "missing"), (1, 0, "empty"), (1, 1, "loaded"), (1, 2, "loaded")]


def test_newest_files_come_from_the_listing(spark, tmp_path, rows):
    read = lambda until=None: readers.newest_files(spark, str(tmp_path), "id int", "d_*", loaded_until=until)
    for day, n in (("2024-01-05", 1), ("2024-01-06", 2)):
        write(tmp_path / f"d_{day}.csv", f"id\n{n}\n")
    assert rows(read(), "id", "file_date") == [(2, D(2024, 1, 6))]
    assert read(D(2024, 1, 6)) is None and rows(read(D(2024, 1, 5)), "id") == [(2,)]


def test_a_list_is_replaced_by_a_newer_one_only(spark, tmp_path, rows):
    write(tmp_path / "list_2024-01-05.csv", "name,v\na,1\nb,2\n")
    listed = lambda data: spark.createDataFrame([(n, v, d) for n, v, d in data], "name string, v int, file_date date")
    load = lambda stored: rows(ingest.replace_when_newer(spark, str(tmp_path), "name string, v int", "list_*", stored))
    new = [("a", 1, D(2024, 1, 5)), ("b", 2, D(2024, 1, 5))]
    assert load(listed([])) == new
    assert load(listed([("x", 9, D(2024, 1, 5))])) == [("x", 9, D(2024, 1, 5))]
    assert load(listed([("x", 9, D(2024, 1, 4)), ("y", 9, D(2024, 1, 1))])) == sorted([*new, ("y", 9, D(2024, 1, 1))])


def test_sheet_with_titles(spark, tmp_path, rows):
    write(tmp_path / "s.csv", 'Title,,\n\n Name ,"Code, short",Other\n"x\ny", 1 ,z\n,,only other\n,2,\n')
    got = readers.sheet(spark, str(tmp_path / "s.csv"), {"Code, short": "code", "Name": "name"}, 2)
    assert rows(got) == [("1", "x\ny"), ("2", None)]
    with pytest.raises(ValueError):
        readers.sheet(spark, str(tmp_path / "s.csv"), {"Nothing": "n"}, 2)


def test_latin1(spark, tmp_path):
    write(tmp_path / "a.csv", "name\nJosé\n", "iso-8859-1")
    assert readers.csv_files(spark, str(tmp_path), "name string", encoding="ISO-8859-1").first().name == "José"


def test_preamble_and_footer_per_file(spark, tmp_path, rows):
    for n in (1, 2):
        write(tmp_path / f"f{n}.csv", "Report\nfor,you\nid,name\n" + "".join(f'{n}{i},"x, {i}"\n' for i in range(3)) + "(3 rows affected)\n")
    df = readers.csv_after_preamble(spark, str(tmp_path), "id int, name string", 3, drop_last=1)
    assert rows(df, "id", "name") == [(n * 10 + i, f"x, {i}") for n in (1, 2) for i in range(3)]


def test_preamble_when_a_file_is_split(spark, tmp_path, rows):
    write(tmp_path / "big.csv", "a\nb\n" + "".join(f"{i},{'y' * 40}\n" for i in range(4000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = readers.csv_after_preamble(spark, str(tmp_path), "id int, pad string", 2)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 3
        assert rows(df, "id") == [(i,) for i in range(4000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("block", [37, 150, 1 << 20])
def test_preamble_footer_and_breaks_over_blocks(spark, tmp_path, rows, block):
    random.seed(block)
    want = []
    for n in range(3):
        lines = []
        for i in range(60):
            name = random.choice(["plain", "two\nlines", 'a ""quoted""\n\nword, and more', "x\ny\nz" * 5, "", '""'])
            lines.append(f'{n * 100 + i},"{name}",{i % 3}')
            want.append((n * 100 + i, name.replace('""', '"') or None, i % 3))
        foot = "Total,60\nPage 1 of 1 and a long closing remark of the sender\n(end of file)\n"
        write(tmp_path / f"f{n}.csv", 'Org "A\nFrom,To\nid,name,k\n' + "\n".join(lines) + "\n" + foot)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = readers.file_lines(spark, str(tmp_path))
        seen = lines.groupBy("file_name").agg(F.max("line").alias("last"), F.count_distinct("line").alias("distinct"), F.count("*").alias("n"), F.max("n_lines").alias("n_lines"))
        assert all(r["n"] == r["distinct"] == r["n_lines"] == r["last"] + 1 for r in seen.collect())
        got = readers.csv_after_preamble(spark, str(tmp_path), "id int, name string, k int", 3, drop_last=3)
        assert rows(got, "id", "name", "k") == sorted(want, key=lambda r: r[0])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_lines_of_a_large_block_are_dealt_in_pieces(spark, tmp_path, rows):
    n = 1 << readers.LINE_BITS
    values = [str(i) for i in range(n + 2000)]
    values[n - 4] = '"over\nthe\nedge\nof\na piece"'
    write(tmp_path / "big.csv", "a\nb\n" + "".join(f"{i},{v}\n" for i, v in enumerate(values)) + "end\n")
    lines = readers.file_lines(spark, str(tmp_path)).groupBy("_block").agg(F.count("*").alias("n"))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() == 1
    assert sorted(r.n for r in lines.collect()) == [2007, n]
    got = readers.csv_after_preamble(spark, str(tmp_path), "id int, value string", 2, drop_last=1)
    assert rows(got, "id", "value") == [(i, v.strip('"')) for i, v in enumerate(values)]


def test_statement_files_are_written_line_by_line(spark, tmp_path, monkeypatch):
    """No file holds all rows of a day, none is put together in one row, and each has its head, its lines in order and its foot."""
    monkeypatch.setattr(files, "shared_dir", lambda _, name: str(tmp_path / name))
    orders = spark.range(3000).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 900).alias("o_custkey"), F.element_at(F.array(*map(F.lit, "FOP")), (F.col("id") % 3 + 1).cast("int")).alias("o_orderstatus"),
        F.lit(dt.datetime(2000, 1, 1)).alias("o_orderdate"), F.lit(7.5).alias("o_totalprice"))
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    files.statement_files(spark, str(tmp_path))
    texts = {f.parent.name: f.read_text() for f in (tmp_path / "statements").glob("*/*.txt")}
    assert sorted(f for f in texts if "2024-01-04" in f) == [f"part=Repayments-2024-01-04-{k}" for k in range(3)]
    for text in texts.values():
        head, lines = text.split("Receipt No.,Completion Time\n")
        lines, foot = lines.split("\nTotal,")
        starts = [line for line in lines.split("\n") if line.startswith("R")]
        assert head.startswith("Organisation\n") and head.count("\n") == 6 and starts == sorted(starts) and foot == f"{len(starts)}\nEnd of statement\n"


def test_statement_and_whitelist_files(spark, tmp_path, rows):
    head = "\n".join(["Org", "Name", "From", "To", "Page", "Rows"]) + "\nReceipt No.,Completion Time\n"
    line = "R1,05-01-2024 10:11:12,05-01-2024 10:11:00,Disbursement to 7 - Shop,Completed,,-99.5,10,true,1 day,p,l,a\n"
    write(tmp_path / "s" / "Disbursement 2024-01-05.csv", head + line)
    write(tmp_path / "s" / "Repayment 2024-01-04.csv", head + line)
    r = ingest.statement_rows(spark, str(tmp_path / "s")).collect()
    assert len(r) == 1 and r[0].is_disbursement and not r[0].is_repayment and r[0].withdrawn == -99.5
    assert r[0].completion_time == dt.datetime(2024, 1, 5, 10, 11, 12)
    write(tmp_path / "w" / "prev.csv", "Store,Flag\n-----,----\n 12.0,0\n13,1\n(2 rows affected),\n")
    assert rows(ingest.whitelist_rows(spark, str(tmp_path / "w"), "store_number string, flag int"), "store_number", "flag") == [("12", 0), ("13", 1)]


def test_lookup_and_text_dump(spark, tmp_path, rows):
    write(tmp_path / "l.csv", "Code Type, Name\n 1 , Savings \n")
    assert rows(readers.lookup(spark, str(tmp_path / "l.csv"), {"Code Type": "code", " Name": "name"})) == [("1", "Savings")]
    write(tmp_path / "t" / "t.csv", "001,x\n")
    assert rows(readers.text_csv(spark, str(tmp_path / "t"), ["id", "v"], header=False), "id", "v") == [("001", "x")]


def test_exports(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 5), "a"), (2, dt.datetime(2024, 1, 2, 5), "b")], "id int, ts timestamp_ntz, exception_column string")
    sinks.export_daily(df, str(tmp_path / "d"), "ts", sep="|")
    assert sorted(p.name for p in (tmp_path / "d").iterdir() if p.is_dir()) == ["event_date=2024-01-01", "event_date=2024-01-02"]
    sinks.export_exceptions(df, str(tmp_path / "e"))
    assert sorted(p.name for p in (tmp_path / "e").iterdir() if p.is_dir()) == ["exception_column=a", "exception_column=b"]
    sinks.overwrite(df, str(tmp_path / "p"))
    sinks.append(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 4
    sinks.publish(df.select("id"), str(tmp_path / "j"))
    assert rows(readers.json_lines(spark, str(tmp_path / "j"), "id int")) == [(1,), (2,)]


def test_shared_folder_comes_from_the_session(spark):
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    base = spark.conf.get("spark.checkpoint.dir")
    assert a != b and a.startswith(base) and b.startswith(base)


def test_stream_picks_up_only_new_files(spark, tmp_path, rows):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    write(src / "a_1.csv", "id,v\n1,x\n")
    write(src / "skip.csv", "id,v\n9,x\n")
    run = lambda: feeds.run_available(feeds.csv_stream(spark, str(src), "id int, v string", "a_*.csv"), out, state)
    run()
    write(src / "a_2.csv", "id,v\n2,y\n")
    run()
    assert rows(spark.read.parquet(out), "id") == [(1,), (2,)]


def test_late_status_is_merged_into_the_snapshot(spark, tmp_path, rows):
    src, state = tmp_path / "in", str(tmp_path / "state")
    stream = lambda: feeds.csv_stream(spark, str(src), "k string, t int, status string", "*.csv")
    src.mkdir()
    assert rows(feeds.run_upserts(stream(), state, ["k"], ["t"])) == []  # nothing delivered yet
    write(src / "1.csv", "k,t,status\na,1,400\nb,1,400\n")
    feeds.run_upserts(stream(), state, ["k"], ["t"])
    write(src / "2.csv", "k,t,status\na,2,200\nc,1,200\nb,0,500\n,1,300\n")
    for _ in range(2):  # the second run finds nothing new
        last = feeds.run_upserts(stream(), state, ["k"], ["t"])
        assert last.columns == ["k", "t", "status"]
        assert rows(last, "k", "status") == [(None, "300"), ("a", "200"), ("b", "400"), ("c", "200")]


def test_a_delivery_writes_the_keys_it_has(spark, tmp_path, rows):
    src, state = str(tmp_path / "in"), tmp_path / "state"
    deliver = lambda ids, t: ids.selectExpr("uuid_of as k", f"{t} as t", "'some status text' as status").coalesce(1).write.mode("append").parquet(src)
    keys = spark.range(20_000).selectExpr("md5(cast(id as string)) as uuid_of", "id")
    written = lambda: sum(f.stat().st_size for f in (state / "state").rglob("*") if f.suffix in (".changelog", ".delta", ".zip"))
    run = lambda: feeds.run_upserts(feeds.parquet_stream(spark, src, "k string, t int, status string"), str(state), ["k"], ["t"])
    deliver(keys, 1)
    run()
    first = written()
    deliver(keys.filter("id % 100 = 7"), 2)
    last = run()
    assert 0 < written() - first < first / 20
    assert last.count() == 20_000 and last.filter("t = 2").count() == 200
    before = written()
    assert rows(run(), "k", "t") == rows(last, "k", "t") and written() == before


def test_late_hours_are_counted(spark, tmp_path, rows):
    src, state = tmp_path / "in", str(tmp_path / "state")
    run = lambda: feeds.hourly_totals(feeds.csv_stream(spark, str(src), "t timestamp, v int", "*.csv"), "t", "v", state)
    write(src / "1.csv", "t,v\n2024-01-09T10:05:00,1\n2024-01-09T10:06:00,2\n")
    run()
    write(src / "2.csv", "t,v\n2023-05-01T00:59:59,5\n2024-01-09T10:59:59,3\n")
    for _ in range(2):
        assert rows(run(), "total_count", "total_sum") == [(1, 5), (3, 6)]
