"""Archives, CSV folders, stored tables, load job and incremental landing."""

import datetime as dt
import zipfile

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from seriesmill.operators import aggregates, quality
from seriesmill.plans import ingest
from seriesmill.sources import archive_source, archives, footers, normalise
from seriesmill.sources.tables import TableStore, materialise
from seriesmill.streaming import incremental

SERIES = "Series_reference,Period,Data_value,STATUS,Magnitude,Group,Extra\n"


def make_archive(path, members):
    with zipfile.ZipFile(path, "w") as archive:
        for name, content in members.items():
            archive.writestr(name, content)


@pytest.fixture
def folder(tmp_path):
    target = tmp_path / "landing"
    target.mkdir()
    make_archive(
        target / "a.zip",
        {
            "data.csv": SERIES + 'S1,2025Q1,"1,234",F,3.7,G,x\nS2,2025Q1, 12 ,NA,x,\t a \t,y\n',
            "more/second.csv": "period,Series Reference,Data value,Status\n2025Q2,S3,5.5,R\n",
            "Footnotes.csv": SERIES + "BAD,2025Q1,1,F,1,G,x\n",
            "metadata.csv": SERIES + "BAD,2025Q1,1,F,1,G,x\n",
            "readme.txt": "no table",
            "DATA.CSV": SERIES + "BAD,2025Q1,1,F,1,G,x\n",
            "other.csv": "Time,Value\n1,2\n",
        },
    )
    return target


def test_archive_members(spark, folder):
    rows = archives.read_archives(spark, str(folder))
    found = sorted(rows_of(rows, "series_reference", "period", "data_value", "status", "group_name", "_source_file"))
    assert found == [
        ("S1", "2025Q1", "1,234", "F", "G", "data.csv"),
        ("S2", "2025Q1", " 12 ", None, "\t a \t", "data.csv"),
        ("S3", "2025Q2", "5.5", "R", None, "more/second.csv"),
    ]


def test_typed_rows(spark, folder):
    typed = normalise.typed_rows(archives.read_archives(spark, str(folder))).orderBy("series_reference")
    assert rows_of(typed, "data_value", "magnitude", "group_name") == [
        (None, 3, "G"), (12.0, 0, "a"), (5.5, 0, None),
    ]


def test_unreadable_member_is_left_out_whole(spark, folder):
    good_start = "".join(f"S{i},2025Q1,1,F,1,G,x\n" for i in range(100))
    make_archive(
        folder / "b.zip",
        {"broken.csv": SERIES + good_start + "too,many,fields,in,this,line,for,sure\n", "fine.csv": SERIES + "S9,2025Q1,1,F,1,G,x\n"},
    )
    rows = archives.read_archives(spark, str(folder))
    assert rows.filter("_source_file = 'broken.csv'").count() == 0
    assert rows.filter("_source_file = 'fine.csv'").count() == 1
    statuses = dict(rows_of(archives.member_manifest(spark, str(folder)), "member", "status"))
    assert statuses == {
        "data.csv": "series", "more/second.csv": "series", "other.csv": "no period column",
        "broken.csv": "unreadable", "fine.csv": "series",
    }


def test_header_without_rows_counts_as_series(spark, tmp_path):
    make_archive(tmp_path / "a.zip", {"a.csv": SERIES, "b.csv": "Time,x\n"})
    assert archives.read_archives(spark, str(tmp_path)).count() == 0
    statuses = dict(rows_of(archives.member_manifest(spark, str(tmp_path)), "member", "status"))
    assert statuses == {"a.csv": "series", "b.csv": "no period column"}


@pytest.mark.parametrize("members", [{"readme.txt": "x"}, {"other.csv": "Time\n1\n"}, {"empty.csv": ""}])
def test_archive_without_series_is_an_error(spark, folder, members):
    make_archive(folder / "c.zip", members)
    with pytest.raises(ValueError, match="no time-series CSV"):
        archives.read_archives(spark, str(folder))


def test_csv_folder_with_line_breaks(spark, tmp_path):
    (tmp_path / "one.csv").write_text(SERIES + 'S1,2025Q1,1.5,"F\nx",1,G,x\n')
    rows = archives.read_csv_folder(spark, str(tmp_path), multi_line=True)
    assert rows_of(rows, "status") == [("F\nx",)]


def test_shared_folder_of_the_session_is_used():
    from types import SimpleNamespace

    from seriesmill.session import scratch_path

    def session(settings, master):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        conf = SimpleNamespace(get=settings.get)
        return SimpleNamespace(conf=conf, sparkContext=context)

    named = session({"spark.checkpoint.dir": "hdfs://shared/tmp/"}, "yarn")
    assert scratch_path(named, "x").startswith("hdfs://shared/tmp/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session({}, "yarn"), "x")


def test_many_chunks_and_quoted_line_breaks(spark, tmp_path):
    n = 2 * archives.CHUNK_ROWS + 1
    lines = "".join(f'S{i},2025Q1,{i},"F\nx",1,G,x\n' for i in range(n))
    make_archive(tmp_path / "big.zip", {"big.csv": SERIES + lines})
    rows = archives.read_archives(spark, str(tmp_path))
    assert rows.filter("status = 'F\\nx'").count() == n
    assert rows.select("series_reference").distinct().count() == n


def test_csv_folder(spark, tmp_path):
    (tmp_path / "one.csv").write_text(SERIES + "S1,2025Q1,1.5,F,1,NULL,x\n")
    (tmp_path / "two.csv").write_text("Period,Status,Series Reference\n2025Q2,P,S2\n")
    (tmp_path / "three.csv").write_text(SERIES + 'S3,2025Q3,"7",F,1,"say ""hi""",x\n')
    (tmp_path / "notes.csv").write_text(SERIES + "BAD,2025Q1,1,F,1,G,x\n")
    (tmp_path / "other.csv").write_text("Time\n1\n")
    rows = archives.read_csv_folder(spark, str(tmp_path)).orderBy("series_reference")
    assert rows_of(rows, "series_reference", "period", "data_value", "status", "group_name", "_source_file") == [
        ("S1", "2025Q1", "1.5", "F", None, "one.csv"),
        ("S2", "2025Q2", None, "P", None, "two.csv"),
        ("S3", "2025Q3", "7", "F", 'say "hi"', "three.csv"),
    ]


def test_two_spellings_in_one_file(spark):
    df = spark.createDataFrame([("P1", None, "R"), ("P2", "F", "R")], "Period string, Status string, STATUS string")
    assert rows_of(normalise.canonical_columns(df), "period", "status") == [("P1", "R"), ("P2", "F")]


def text_rows(spark, refs, period="2025Q1"):
    df = spark.createDataFrame([(r, period, "1.5", "1000") for r in refs], "series_reference string, period string, data_value string, magnitude string")
    return normalise.typed_rows(normalise.canonical_columns(df))


def test_failed_load_keeps_the_previous_version(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    first, second = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2)
    assert store.load(text_rows(spark, ["S1", "S2"]), "raw_wages", "wages", first) == 2

    broken = text_rows(spark, ["S3"]).selectExpr("*", "assert_true(false) as boom").drop("magnitude")
    broken = broken.selectExpr("*", "if(boom is null, 1, 0) as magnitude")
    with pytest.raises(Exception):
        store.load(broken, "raw_wages", "wages", second)
    assert store.read("raw_wages").count() == 2

    with pytest.raises(ValueError, match="no schema defined"):
        store.load(text_rows(spark, ["S3"]), "raw_unknown", "wages", second)
    log = store.audit_log().orderBy("run_timestamp")
    assert rows_of(log, "table_name", "rows_loaded", "status") == [
        ("raw_wages", 2, "SUCCESS"), ("raw_wages", 0, "FAILED"), ("raw_unknown", 0, "FAILED"),
    ]


def test_versions_and_layout(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    days = [dt.datetime(2025, 1, d) for d in (1, 3)]
    store.load(text_rows(spark, ["S1"], "2024Q1"), "raw_wages", "wages", days[0])
    store.load(text_rows(spark, ["S1", "S2"], "2025Q1"), "raw_wages", "wages", days[1])
    assert store.read("raw_wages").count() == 2
    assert store.read("raw_wages", dt.datetime(2025, 1, 2)).count() == 1
    assert store.read_offset("raw_wages", 86400, days[1]).count() == 1
    assert [v.snapshot_ts for v in store.retained("raw_wages", 1, days[1])] == [days[1]]
    assert len(store.retained("raw_wages", 7, days[1])) == 2
    with pytest.raises(LookupError):
        store.read("raw_wages", dt.datetime(2024, 1, 1))
    row = store.read("raw_wages").first()
    assert (row._source_name, row._ingested_at, row.period_year) == ("wages", days[1], 2025)


def test_a_table_can_be_replaced_by_a_plan_that_reads_it(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    at = dt.datetime(2025, 1, 1)
    store.write(text_rows(spark, ["S1", "S2"]), "t", at)
    before = store.read("t")
    store.write(before.filter("series_reference = 'S1'").drop("period_year"), "t", at)
    assert store.read("t").count() == 1
    assert before.count() == 2


def test_empty_table(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert store.load(text_rows(spark, ["S1"]).filter("false"), "raw_wages", "wages") == 0
    assert store.read("raw_wages").count() == 0
    assert "data_value" in store.read("raw_wages").columns


def test_materialise(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    df = spark.range(3)
    assert materialise(df, "a_view", "staging", store) is df
    assert spark.table("a_view").count() == 3
    assert materialise(df, "a_table", "mart", store).count() == 3
    assert len(store.versions("a_table")) == 1


def test_run_report(spark, folder, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    good = ingest.Source("wages", str(folder), "raw_wages")
    bad = ingest.Source("odd", str(folder), "raw_unknown")
    spare = ingest.Source("spare", str(folder), None)
    assert ingest.run_sources(spark, [good, spare], store).exit_code == 0
    assert ingest.run_sources(spark, [good, bad], store).exit_code == 1
    assert ingest.run_sources(spark, [bad], store).exit_code == 2
    gone = ingest.Source("gone", str(folder / "missing"), "raw_wages")
    report = ingest.run_sources(spark, [good, gone], store)
    assert (report.exit_code, report.lines[0][2]) == (2, "EXTRACT FAILED")


def test_incremental_landing(spark, tmp_path):
    incoming, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    shape = "series_reference string, period string, data_value double, _ingested_at timestamp_ntz"

    def deliver(rows):
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(incoming)

    def land():
        schema = spark.createDataFrame([], shape).schema
        incremental.land_new_files(spark, incoming, target, state, schema, files_per_batch=1)
        return sorted(rows_of(incremental.current_rows(spark, target), "series_reference", "data_value"))

    early, late = dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1)
    deliver([("S1", "2025Q1", 1.0, early), ("S2", "2025Q1", 2.0, late)])
    assert land() == [("S1", 1.0), ("S2", 2.0)]
    deliver([("S1", "2025Q1", 1.5, late), ("S2", "2025Q1", 9.0, early)])
    assert land() == [("S1", 1.5), ("S2", 2.0)]
    assert land() == [("S1", 1.5), ("S2", 2.0)]  # nothing new


def test_command_line(spark, tmp_path, capsys):
    from seriesmill.__main__ import SURVEYS, main

    wage = "W,2025Q1,40,Dollars,Hourly Earnings,Private Sector,Mining\n"
    for survey in SURVEYS:
        (tmp_path / "in" / survey).mkdir(parents=True)
        header = "Series_reference,Period,Data_value,UNITS,Series_title_1,Series_title_2,Series_title_3\n"
        make_archive(tmp_path / "in" / survey / "a.zip", {"a.csv": header + wage})
    assert main([str(tmp_path / "in"), str(tmp_path / "store")]) == 0
    lines = capsys.readouterr().out.splitlines()
    assert len(lines) == 3 + 57
    assert main([str(tmp_path / "nothing"), str(tmp_path / "store")]) == 2


def test_line_with_surplus_fields_leaves_the_file_out(spark, tmp_path):
    """The same bytes give the same rows, unpacked or in an archive."""
    bad = SERIES + "S1,2025Q1,1,F,1,G,x\ntoo,many,fields,in,this,line,for,sure\n"
    short = SERIES + 'S2,2025Q1\nS3,2025Q1,"1,5",F,1,G,x\n'
    for folder, write in (("plain", None), ("packed", make_archive)):
        (tmp_path / folder).mkdir()
        if write:
            write(tmp_path / folder / "a.zip", {"bad.csv": bad, "short.csv": short})
        else:
            (tmp_path / folder / "bad.csv").write_text(bad)
            (tmp_path / folder / "short.csv").write_text(short)
    names = ("series_reference", "period", "data_value", "_source_file")
    plain = sorted(rows_of(archives.read_csv_folder(spark, str(tmp_path / "plain")), *names))
    packed = sorted(rows_of(archives.read_archives(spark, str(tmp_path / "packed")), *names))
    assert plain == packed == [("S2", "2025Q1", None, "short.csv"), ("S3", "2025Q1", "1,5", "short.csv")]


def test_left_out_members_are_reported(spark, folder, tmp_path):
    make_archive(folder / "b.zip", {"broken.csv": SERIES + "S8,2025Q1,1,F,1,G,x\n" + "," * 60 + "\n", "fine.csv": SERIES + "S9,2025Q1,1,F,1,G,x\n"})
    store = TableStore(spark, str(tmp_path / "store"))
    report = ingest.run_sources(spark, [ingest.Source("wages", str(folder), "raw_wages")], store)
    note = "members left out: 1 no period column, 1 unreadable"
    assert report.exit_code == 0 and report.lines[0][3:] == (4, note)
    assert rows_of(store.audit_log(), "status", "error_message") == [("SUCCESS", note)]
    kept = dict(rows_of(store.read("members_wages"), "member", "status"))
    assert kept["broken.csv"] == "unreadable" and len(kept) == 5


def test_members_are_packed_by_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "TASK_BYTES", 1000)
    sizes = [5000, 5000, 900, 300, 300, 300, 50, 50]
    members = spark.createDataFrame([("a", str(i), n) for i, n in enumerate(sizes)], archives._MEMBERS)
    parts = archives._packed(spark, members).rdd.glom().collect()
    loads = [[row.bytes for row in part] for part in parts if part]
    assert sorted(b for part in loads for b in part) == sorted(sizes)
    assert all(len(part) == 1 for part in loads if max(part) >= 1000)


def test_roles_and_retention(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    days = [dt.datetime(2025, 1, d) for d in (1, 2, 9)]
    for at in days:
        store.load(text_rows(spark, ["S1", "S2"]), "raw_wages", "wages", at)
    assert store.read("raw_wages", role="ENGINEER_ROLE").first().data_value == 1.5
    for role in ("ANALYST_ROLE", "REPORTER_ROLE", "SOMEBODY"):
        with pytest.raises(PermissionError):
            store.read("raw_wages", role=role)
    assert store.expire("raw_wages", 3, days[2]) == 2
    assert [v.snapshot_ts for v in store.versions("raw_wages")] == [days[2]]
    assert store.expire("raw_wages", 3, dt.datetime(2026, 1, 1)) == 0
    with pytest.raises(LookupError):
        store.read("raw_wages", days[1])
    assert len(list((tmp_path / "raw_wages").glob("load=*/period_year=*"))) == 1


def landing(spark, tmp_path):
    """Functions to deliver rows and to take them in."""
    incoming, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    shape = "series_reference string, period string, data_value double, _ingested_at timestamp_ntz"
    schema = spark.createDataFrame([], shape).schema

    def deliver(rows):
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(incoming)
        incremental.land_new_files(spark, incoming, target, state, schema)

    return deliver, target


def test_a_batch_writes_its_own_rows_only(spark, tmp_path):
    deliver, target = landing(spark, tmp_path)
    days = [dt.datetime(2025, 1, 1 + wave) for wave in range(4)]
    first = [(f"S{k}", "2025Q1", 0.0, days[0]) for k in range(200)]
    deliver(first)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.parquet")}
    deliver([("S3", "2025Q1", 1.0, days[1])])
    deliver(first[:50] + [("S3", "2025Q1", 1.0, days[1]), ("S4", "2025Q1", 4.0, days[2])])  # mostly repeated
    deliver([("S4", "2025Q1", -1.0, dt.datetime(2019, 1, 1)), ("S5", "2025Q1", 5.0, days[3])])  # one is late
    assert incremental.landed_rows(spark, target).count() == 200 + 1 + 1 + 2
    assert all(p.stat().st_mtime_ns == written for p, written in files.items())
    current = dict(rows_of(incremental.current_rows(spark, target), "series_reference", "data_value"))
    assert len(current) == 200 and [current[k] for k in ("S2", "S3", "S4", "S5")] == [0.0, 1.0, 4.0, 5.0]


def test_nothing_has_landed(spark, tmp_path):
    with pytest.raises(LookupError):
        incremental.current_rows(spark, str(tmp_path / "nowhere"))


def test_loads_and_checks_are_measured_while_they_are_written(spark, tmp_path, monkeypatch):
    """Rows and failures come with the write, and nothing is read back."""
    store = TableStore(spark, str(tmp_path))
    store.write(text_rows(spark, ["S0"]), "t", dt.datetime(2024, 1, 1))
    rows = text_rows(spark, ["S1", "S2", None], "2025Q1")
    checks = [quality.not_null("series_reference"), quality.between("data_value", 2, 3, "warn")]
    for reading in ("count", "collect", "first", "agg", "toArrow"):
        monkeypatch.setattr(type(rows), reading, lambda *a, **k: pytest.fail("the load reads"))
    n, verdicts = store.write_checked(rows, "t", checks, dt.datetime(2025, 1, 1))
    monkeypatch.undo()
    assert n == 3
    assert rows_of(verdicts, "check_name", "table_name", "failures", "status") == [
        ("not_null", "t", 1, "error"), ("between", "t", 3, "warn"),
    ]
    again = quality.run_checks(store.read("t"), "t", checks)
    assert rows_of(again.orderBy("check_name")) == rows_of(verdicts.orderBy("check_name"))


def test_models_are_replaced_by_year(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    model = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0), (dt.date(2025, 1, 1), 2.0), (dt.date(2026, 1, 1), 3.0)], "period_start_date date, v double")
    store.write_model(model, "mart_x")
    table = spark.table(store.full_name("mart_x"))
    assert sorted(rows_of(table, "period_year", "v")) == [(2024, 1.0), (2025, 2.0), (2026, 3.0)]
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "mart_x").rglob("*.parquet") if "2025" not in str(p)}
    changed = model.withColumn("v", F.col("v") * 10)
    store.write_model(changed, "mart_x", years=[2025])
    assert sorted(rows_of(spark.table(store.full_name("mart_x")), "v")) == [(1.0,), (3.0,), (20.0,)]
    assert untouched and all(p.stat().st_mtime_ns == at for p, at in untouched.items())
    store.write_model(changed.filter("v <> 20"), "mart_x", years=[2025])  # the year has no rows any more
    assert sorted(rows_of(spark.table(store.full_name("mart_x")), "v")) == [(1.0,), (3.0,)]
    store.write_model(changed.filter("v = 30"), "mart_x")
    assert rows_of(store.read("mart_x"), "period_year", "v") == [(2026, 30.0)]


def test_a_store_of_an_earlier_session_is_found(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.load(text_rows(spark, ["S1"]), "raw_wages", "wages", dt.datetime(2025, 1, 1))
    store.write_model(spark.range(4), "mart_x")
    for name in ("raw_wages", "mart_x"):  # the catalog forgets, the files stay
        files = [p for p in (tmp_path / name).rglob("*") if p.is_file()]
        kept = {p: p.read_bytes() for p in files}
        spark.sql(f"DROP TABLE {store.full_name(name)}")
        for path, content in kept.items():
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_bytes(content)
    again = TableStore(spark, str(tmp_path))
    assert again.read("raw_wages").first().series_reference == "S1" and again.read("mart_x").count() == 4
    assert [v.snapshot_ts for v in again.versions("raw_wages")] == [dt.datetime(2025, 1, 1)]


def test_log_is_compacted(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    for k in range(3):
        store.log_run(f"t{k}", k, "s", "SUCCESS", None, 0.5)
    lines = sorted(rows_of(store.audit_log()))
    store.compact_log()
    assert sorted(rows_of(store.audit_log())) == lines and len(lines) == 3
    assert len(list((tmp_path / "ingestion_log").glob("*.parquet"))) == 1


def test_sources_of_one_path_are_parsed_once(spark, folder, tmp_path, monkeypatch):
    parsed, parse = [], archives.parse_archives
    monkeypatch.setattr(archives, "parse_archives", lambda session, path: parsed.append(path) or parse(session, path))
    sources = [ingest.Source(n, str(folder), t) for n, t in (("a", "raw_wages"), ("b", "raw_household"), ("c", None))]
    report = ingest.run_sources(spark, sources, TableStore(spark, str(tmp_path / "store")), checks={"raw_wages": [quality.not_null("period")]})
    assert report.exit_code == 0 and len(parsed) == 1
    assert [rows_of(v, "table_name", "failures") for v in report.verdicts] == [[("raw_wages", 0)]]


def test_headers_are_grouped_by_spark(spark, tmp_path, monkeypatch):
    """Of forty files with three headers, three reach the driver; narrow and wide files are read together."""
    headers = ["Series_reference,Period,Data_value", "Period,Series Reference,STATUS,UNITS,Data value", "period,series_reference"]
    for k in range(40):
        line = ["S{0},2025Q1,{0}", "2025Q1,S{0},F,Number,{0}", "2025Q1,S{0}"][k % 3].format(k)
        (tmp_path / f"file {k}.csv").write_text(f"{headers[k % 3]}\n{line}\n")
    (tmp_path / "surplus.csv").write_text(headers[2] + "\n2025Q1,S99\n2025Q1,S98,1\n")
    seen, frame = [], type(spark.range(1))
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda df: seen.append(found := collect(df)) or found)
    rows = archives.read_csv_folder(spark, str(tmp_path))
    assert sum(map(len, seen)) == 3
    monkeypatch.undo()
    found = {r.series_reference: (r.period, r.data_value, r.status) for r in rows.collect()}
    assert found == {f"S{k}": ("2025Q1", None if k % 3 == 2 else str(k), "F" if k % 3 == 1 else None) for k in range(40)}


# --- archives as a data source -----------------------------------------------


def archive_rows(spark, path, **options):
    archive_source.register(spark)
    return spark.read.format(archive_source.FORMAT).options(**options).load(str(path))


def test_data_source_gives_the_rows_of_good_members(spark, folder):
    good = "".join(f"S{i},2025Q1,1,F,1,G,x\n" for i in range(100))
    make_archive(folder / "b.zip", {"broken.csv": SERIES + good + "too,many,fields,in,this,line,for,sure\n", "empty.csv": SERIES})
    make_archive(folder / "c.zip", {"readme.txt": "x"})
    (folder / "d.zip").write_text("not an archive")
    rows = archive_rows(spark, folder)
    columns = ("series_reference", "period", "data_value", "status", "group_name", "_source_file")
    assert sorted(rows_of(rows, *columns)) == [
        ("S1", "2025Q1", "1,234", "F", "G", "data.csv"),
        ("S2", "2025Q1", " 12 ", None, "\t a \t", "data.csv"),
        ("S3", "2025Q2", "5.5", "R", None, "more/second.csv"),
    ]
    report = archive_rows(spark, folder, report="true")
    lines = {(r.archive.rsplit("/", 1)[-1], r.member): (r.status, r.rows, bool(r.detail)) for r in report.collect()}
    assert lines == {
        ("a.zip", "data.csv"): ("series", 2, False), ("a.zip", "more/second.csv"): ("series", 1, False),
        ("a.zip", "other.csv"): ("no period column", 0, False), ("b.zip", "broken.csv"): ("unreadable", 0, True),
        ("b.zip", "empty.csv"): ("series", 0, False), ("c.zip", None): ("no candidate", 0, False),
        ("d.zip", None): ("no candidate", 0, False),
    }


def test_data_source_has_a_partition_per_member_and_takes_conditions(spark, folder):
    make_archive(folder / "b.zip", {f"m{i}.csv": SERIES + f"S{i},2025Q1,1,F,1,G,x\n" for i in range(6)})
    each = archive_rows(spark, folder, partitionBytes="0")
    assert each.rdd.getNumPartitions() == 3 + 6
    assert archive_rows(spark, folder).rdd.getNumPartitions() == 1
    some = each.filter("_source_file in ('m1.csv', 'm4.csv') and data_value = '1'")
    assert some.rdd.getNumPartitions() == 2 and sorted(r.series_reference for r in some.collect()) == ["S1", "S4"]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "_source_file" not in plan.split("Filter")[1].split("\n")[0] if "Filter" in plan else True
    assert each.filter("_source_file like 'more/%'").count() == 1
    assert each.filter("_source_file like '%m2.csv'").rdd.getNumPartitions() == 1
    assert each.filter("_source_file like '%2%'").count() == 1
    assert each.filter("_source_file = 'nothing.csv'").count() == 0
    assert archive_rows(spark, folder / "a.zip").count() == 3
    report = archive_rows(spark, folder, report="true", partitionBytes="0").filter("member = 'm3.csv'")
    assert report.rdd.getNumPartitions() == 1 and rows_of(report, "status", "rows") == [("series", 1)]


# --- footers -------------------------------------------------------------------


def test_footers_answer_without_reading_rows(spark, tmp_path):
    at = dt.datetime(2025, 1, 2, 3, 4, 5, 678901)
    labels = ["2025Q1", "2024Q4", None, "2025M12", "2025M9"]
    df = spark.createDataFrame([(p, at - dt.timedelta(days=i)) for i, p in enumerate(labels)], "period string, _ingested_at timestamp_ntz")
    footers.write(df.repartition(3), str(tmp_path / "t"))
    session = footers.reader(spark)
    found = footers.extremes(session, str(tmp_path / "t"))
    plan = found._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*), MAX(_loaded_us), MIN(_label_low), MAX(_label_high), MAX(_label_bytes)]" in plan
    assert rows_of(footers.summary(session, str(tmp_path / "t"))) == rows_of(aggregates.table_summary(df)) == [(5, at, "2024Q4", "2025Q1")]
    assert rows_of(footers.newest_load(session, str(tmp_path / "t"))) == [(at,)]


@pytest.mark.parametrize("labels", [[], [None], ["a long label", "b"], ["é1", "z"], [""], ["X0", "X00"]])
def test_footers_of_odd_labels(spark, tmp_path, labels):
    df = spark.createDataFrame([(p, None) for p in labels], "period string, _ingested_at timestamp_ntz")
    footers.write(df, str(tmp_path / "t"))
    assert rows_of(footers.summary(footers.reader(spark), str(tmp_path / "t"))) == rows_of(aggregates.table_summary(df))
