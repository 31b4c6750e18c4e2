"""Readers, audit and export on files the tests write."""

import hashlib
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyspan.plans import ingest, star
from tallyspan.plans import warehouse as wh
from tallyspan.session import new_shared_path, shared_dir
from tallyspan.sources import audit, catalog, export, manifest, seeds, wide_csv

NAMES = "Klassifikator,Klassifikator_ru,Klassifikator_en,Klassifikator_uzc"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def extracts(tmp_path):
    """Three header variants, an all-empty year, a quoted comma, a bad cell and an unknown dataset."""
    files = {
        223: f'Code,{NAMES},2010,2011\n1714,"Namangan, viloyati",r,e,u,10,\n1714401,Namangan shahri,r,e,u,-,20.5\n',
        224: f"Code,{NAMES},2010,2011\n1714,Namangan viloyati,r,e,u,4,\n",
        246: f"Code,{NAMES},2010,2011,2025\n1714,Namangan viloyati,r,e,u,1,2,3\n",
        244: f"Code,{NAMES},2011,2014,2025\n1714,Namangan viloyati,r,e,u,7,8,9\n",
        999: f"Code,{NAMES},2010,2011\n1714,Namangan viloyati,r,e,u,5,5\n",
        238: f"Code,{NAMES},2010,2011\n1714,Namangan viloyati,r,e,u,6,6\n",
    }
    for i, text in files.items():
        (tmp_path / f"sdmx_data_{i}.csv").write_text(text, encoding="utf-8")
    return wide_csv.registry(str(tmp_path), list(files))


def test_extracts_with_different_headers_become_one_long_table(spark, extracts):
    got = {(r[0], r[1], r[3], r[4]) for r in ingest.scan_staging(spark, extracts).collect()}
    assert got == {
        (223, 1714, 2010, 10.0), (223, 1714401, 2011, 20.5), (224, 1714, 2010, 4.0),
        (246, 1714, 2010, 1.0), (246, 1714, 2011, 2.0), (244, 1714, 2014, 8.0),
        (999, 1714, 2010, 5.0), (999, 1714, 2011, 5.0),
    }


def test_headers_from_the_audit_give_the_same_table(spark, extracts, tmp_path):
    records = audit.profile_files(spark, str(tmp_path))
    assert rows(ingest.scan_audited(spark, records)) == rows(ingest.scan_staging(spark, extracts))


def test_one_scan_per_header(spark, extracts):
    assert sorted(len(g.roots) for g in wide_csv.header_groups(spark, extracts)) == [1, 1, 4]


def test_quoted_names_and_bad_cells(spark, extracts):
    header = wide_csv.header_of(spark, extracts[223])
    wide = wide_csv.scan_group(spark, header, [extracts[223]])
    assert {r["Klassifikator"] for r in wide.collect()} == {"Namangan, viloyati", "Namangan shahri"}
    assert rows(wh.rejected_cells(wide, wh.YEARS)) == [(223, 1714401, "Namangan shahri", 2010, "-")]


def test_build_atomic_is_stored_and_drops_unknown_datasets(spark, extracts, plan):
    atomic = ingest.build_atomic(spark, extracts)
    assert {r["dataset_id"] for r in atomic.select("dataset_id").distinct().collect()} == {223, 224, 244, 246}
    scoped = wh.mart_births_by_sex_yearly(atomic)
    text = plan(scoped)
    assert "PartitionFilters: [metric_key" in text
    assert "StringStartsWith(region_code,1714)" in text
    assert rows(scoped.select("geo_code", "year", "total_birth_yearly", "birth_girls")) == [
        (1714, 2010, 10.0, 4.0), (1714401, 2011, 20.5, None)]


def test_build_lists_what_it_leaves_out(spark, extracts, tmp_path):
    rejects = str(tmp_path / "rejects")
    ingest.build_atomic(spark, extracts, rejects_path=rejects)
    assert rows(spark.read.parquet(rejects)) == [(223, "1714401", "Namangan shahri", 2010, "-", "cell")]
    ingest.build_atomic(spark, {224: extracts[224], 246: extracts[246]}, rejects_path=rejects)
    assert spark.read.parquet(rejects).count() == 0


def test_raw_tables_are_replaceable(spark, extracts):
    for _ in range(2):
        names = catalog.register_sources(spark, {223: extracts[223]}, "raw_test")
    assert names == ["raw_test.sdmx_data_223"] and spark.table(names[0]).count() == 2


def test_optional_table(spark):
    catalog.register_views({"present_view": spark.range(3)})
    assert catalog.optional_table(spark, "present_view").count() == 3
    assert catalog.optional_table(spark, "absent_view") is None


def test_seeds(spark, tmp_path):
    assert seeds.dim_metric(spark).count() == 21 and seeds.geo_override(spark).count() == 13
    assert rows(seeds.dim_sex(spark))[0] == ("female", "Ayol", 2)
    path = tmp_path / "seed.csv"
    path.write_text("geo_code,geo_name_clean\n7,\"a, b\"\n")
    assert rows(seeds.read_seed(spark, str(path), seeds.GEO_OVERRIDE)) == [(7, "a, b")]


@pytest.mark.parametrize(
    "text",
    [
        "dataset_id,url,filename,notes\n1,http://x/a,a.csv,n\n",
        "dataset_id;url;filename;notes\n1;http://x/a;a.csv;n\n",
        "dataset_id\turl\tfilename\tnotes\n1\thttp://x/a\ta.csv\tn\n",
        '﻿"dataset_id", "url" ,filename,notes\n1, "http://x/a" ,"a.csv", n \n',
    ],
)
def test_manifest_variants(spark, tmp_path, text):
    path = tmp_path / "manifest.csv"
    path.write_text(text, encoding="utf-8")
    got = manifest.read_manifest(spark, str(path))
    assert got.columns == [*manifest.REQUIRED, *manifest.OPTIONAL]
    assert rows(got) == [("1", "http://x/a", "a.csv", "", "", "", "n")]


def test_manifest_errors(spark, tmp_path):
    (tmp_path / "m.csv").write_text("dataset_id,url\n1,u\n")
    with pytest.raises(KeyError, match="filename"):
        manifest.read_manifest(spark, str(tmp_path / "m.csv"))
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError):
        manifest.read_manifest(spark, str(tmp_path / "empty.csv"))


@pytest.fixture
def landed(tmp_path):
    folder = tmp_path / "landed"
    folder.mkdir()
    contents = {
        "good.csv": 'Code,"Name, full",2010\n1,"a, b",2\n\n2,ô,3\n'.encode(),
        "ragged.csv": b"a,b\n1,2,3\n",
        "empty.csv": b"",
        "windows.csv": b"\xef\xbb\xbfa,b\r\n1,2\r\n",
    }
    for name, content in contents.items():
        (folder / name).write_bytes(content)
    return folder, contents


def test_profile_of_files(spark, landed):
    folder, contents = landed
    got = {r["path"].rsplit("/", 1)[1]: r for r in audit.profile_files(spark, str(folder)).collect()}
    assert set(got) == set(contents)
    for name, content in contents.items():
        assert (got[name]["bytes"], got[name]["digest"]) == (len(content), hashlib.sha256(content).hexdigest())
    good = got["good.csv"]
    assert (good["rows"], good["cols"], good["columns"], good["profile_error"]) == (2, 3, ["Code", "Name, full", "2010"], None)
    assert got["windows.csv"]["columns"] == ["a", "b"] and got["windows.csv"]["rows"] == 1
    assert got["ragged.csv"]["profile_error"] == "expected 2 fields, found 3" and got["ragged.csv"]["rows"] is None
    assert got["empty.csv"]["profile_error"] == "no columns to parse"


def test_digest_sees_a_change_of_line_order(spark, tmp_path):
    def snapshot(text):
        (tmp_path / "f.csv").write_text(text)
        return spark.createDataFrame(audit.profile_files(spark, str(tmp_path)).select("path", "digest").collect(), "path string, digest string")

    before = snapshot("a,b\n1,2\n3,4\n")
    assert [r["status"] for r in audit.compare_snapshots(before, snapshot("a,b\n3,4\n1,2\n")).collect()] == ["changed"]
    assert [r["status"] for r in audit.compare_snapshots(before, snapshot("a,b\n1,2\n3,4\n")).collect()] == ["unchanged"]


def test_profile_of_a_large_file(spark, tmp_path):
    content = "id,name\n" + "".join(f'{i},"n\n{i}"\n' for i in range(300_000))
    (tmp_path / "big.csv").write_text(content)
    row = audit.profile_files(spark, str(tmp_path)).first()
    assert (row["rows"], row["cols"], row["columns"], row["bytes"]) == (300_000, 2, ["id", "name"], len(content))
    assert row["digest"] == hashlib.sha256(content.encode()).hexdigest()


def test_audit_finds_files_of_any_name(spark, tmp_path):
    folder = tmp_path / "my raw"
    folder.mkdir()
    for name in ("a b.csv", "plain.txt", "100%.csv"):
        (folder / name).write_text('Code,Name\n1,"x\ny"\n')
    expected = spark.createDataFrame([("a b.csv",), ("plain.txt",), ("100%.csv",), ("gone.csv",)], "filename string")
    got = {r["filename"]: (r["status"], r["rows"]) for r in audit.audit(spark, expected, str(folder)).collect()}
    assert got == {"a b.csv": ("ok", 1), "plain.txt": ("ok", 1), "100%.csv": ("ok", 1), "gone.csv": ("missing", None)}


def test_audit_records_every_item(spark, landed, tmp_path):
    folder, _ = landed
    expected = spark.createDataFrame(
        [("1", "good.csv", "tug'ilganlar"), ("2", "ragged.csv", ""), ("3", "never.csv", "")], "dataset_id string, filename string, title_uz string"
    )
    records = audit.audit(spark, expected, str(folder))
    assert rows(records.select("dataset_id", "status")) == [("1", "ok"), ("2", "unreadable"), ("3", "missing")]
    out = str(tmp_path / "audit")
    audit.write_audit(records, out)
    back = spark.read.json(out)
    assert rows(audit.audit_tally(back)) == [("missing", 1), ("ok", 1), ("unreadable", 1)]
    texts = [json.loads(r[0]) for r in spark.read.text(out).collect()]
    assert {t["title_uz"] for t in texts} >= {"tug'ilganlar"} and all(t["audited_at"] for t in texts)


def test_snapshots(spark):
    a = spark.createDataFrame([("same", "1"), ("edit", "1"), ("gone", "1"), ("bad", None)], "path string, digest string")
    b = spark.createDataFrame([("same", "1"), ("edit", "2"), ("born", "1"), ("bad", None)], "path string, digest string")
    assert rows(audit.compare_snapshots(a, b)) == [
        ("bad", "unchanged"), ("born", "new"), ("edit", "changed"), ("gone", "missing"), ("same", "unchanged")]


def test_freshness(spark, landed):
    files = audit.profile_files(spark, str(landed[0])).where("bytes > 0")
    assert {r["fresh"] for r in audit.freshness(files, "modified_at", F.current_date(), 1).collect()} == {True}
    assert {r["fresh"] for r in audit.freshness(files, "modified_at", F.date_add(F.current_date(), 9), 1).collect()} == {False}


def test_export_skips_what_fails(spark, tmp_path):
    catalog.register_views({"two_rows": spark.range(2), "no_rows": spark.range(0)})
    out = str(tmp_path / "out")
    status = export.export_tables(spark, ["two_rows", "not_there", "no_rows"], out)
    assert rows(status) == [
        ("no_rows", "ok", 0, None), ("not_there", "failed", None, "TABLE_OR_VIEW_NOT_FOUND"), ("two_rows", "ok", 2, None)]
    assert rows(spark.read.schema("id bigint").csv(f"{out}/two_rows", header=True)) == [(0,), (1,)]


def test_export_survives_a_table_that_fails_while_it_runs(spark, tmp_path):
    catalog.register_views({"breaks": spark.range(3).selectExpr("raise_error('no') as x"), "works": spark.range(1)})
    status = {r["table_name"]: r["status"] for r in export.export_tables(spark, ["breaks", "works"], str(tmp_path)).collect()}
    assert status == {"breaks": "failed", "works": "ok"}


def test_shared_folder_is_the_named_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_shared_path(spark, "x") != new_shared_path(spark, "x")


def scanned(spark, tmp_path, text, **build):
    (tmp_path / "my raw").mkdir(exist_ok=True)
    (tmp_path / "my raw" / "sdmx_data_223.csv").write_text(text, encoding="utf-8")
    sources = wide_csv.registry(str(tmp_path / "my raw"), [223])
    staged = [tuple(r)[1:] for r in ingest.scan_staging(spark, sources, **build).collect()]
    left_out = [(r.code, r.year, r.found, r.reason) for r in ingest.scan_rejected(spark, sources, **build).collect()]
    return sorted(staged, key=str), sorted(left_out, key=str)


def test_quoted_line_break_keeps_its_years(spark, tmp_path):
    text = 'Code,Klassifikator,2010,2013,2025\n1714,"A\nB ""x"", y",1,2,3\n1715,C,4,5,6\n'
    staged, left_out = scanned(spark, tmp_path, text)
    assert staged == [(1714, 'A\nB "x", y', 2010, 1.0), (1714, 'A\nB "x", y', 2013, 2.0), (1715, "C", 2010, 4.0), (1715, "C", 2013, 5.0)]
    assert left_out == []


def test_bad_codes_and_field_counts_are_rejects(spark, tmp_path):
    text = "Code,Klassifikator,2010,2011\n17x4,a,1,2\n1715,b,1,2,3\n1716,c,1\n1717,d,5,6\n ,e,7,8\n"
    staged, left_out = scanned(spark, tmp_path, text)
    assert staged == [(1717, "d", 2010, 5.0), (1717, "d", 2011, 6.0), (None, "e", 2010, 7.0), (None, "e", 2011, 8.0)]
    assert left_out == [("1715", None, "1715,b,1,2,3", "fields"), ("1716", None, "1716,c,1", "fields"), ("17x4", None, "17x4", "code")]


def test_number_grammar(spark, tmp_path):
    cells = ["12d", "12f", "0x1p3", "NaN", "inf", "1e400", "1_0", " 12 ", "+1.5e2", ".5", "5.", "-3"]
    text = "Code,Klassifikator,2010\n" + "".join(f"{i},n,{c}\n" for i, c in enumerate(cells))
    staged, left_out = scanned(spark, tmp_path, text)
    assert {r[0]: r[3] for r in staged} == {7: 12.0, 8: 150.0, 9: 0.5, 10: 5.0, 11: -3.0}
    assert {found for _, _, found, reason in left_out if reason == "cell"} == set(cells[:7])


def test_empty_files_and_blanks_in_headers(spark, tmp_path):
    assert scanned(spark, tmp_path, "") == ([], [])
    assert scanned(spark, tmp_path, " Code , Klassifikator, 2010 \n1714,a,1\n")[0] == [(1714, "a", 2010, 1.0)]


def test_rejects_and_years_belong_to_the_build(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "rejects")
    raw.mkdir()
    for i, text in {223: "1714,a,-,2", 238: "1714,a,-,2", 244: "1714,a,-,2"}.items():
        (raw / f"sdmx_data_{i}.csv").write_text(f"Code,Klassifikator,2010,2025\n{text}\n")
    sources = wide_csv.registry(str(raw), [223, 238, 244])
    ingest.build_atomic(spark, sources, rejects_path=out)
    assert [(r.dataset_id, r.year, r.reason) for r in spark.read.parquet(out).collect()] == [(223, 2010, "cell")]
    assert ingest.unread_years(spark, sources) == ["2025"]
    (raw / "sdmx_data_223.csv").write_text("Code,Klassifikator,2010,2025\n1714,a,1,2\n")
    wide = ingest.build_atomic(spark, sources, rejects_path=out, years=["2010", "2025"])
    assert spark.read.parquet(out).count() == 0
    assert {r.year for r in wide.where("dataset_id = 223").collect()} == {2010, 2025}


# --- files of many splits, groups, listings --------------------------------------


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def tricky_csv(seed, n=50):
    """A legal file with line breaks, doubled quotes, blank lines, commas and empty cells in quoted cells."""
    rng = random.Random(seed)
    cells = ["plain", '"a\nb"', '"x ""y"" z"', '""', "", '"q,\n\n,r"', '"\n"', '5" pipe', '"ends ""\n"" here"', '"' + "long\n" * rng.randrange(1, 120) + '"', "ü"]
    lines = ['Code,"Klassi\nfikator",Note,2010\n' if seed % 2 else "Code,Klassifikator,Note,2010\n"]
    for i in range(n):
        lines.append(f"{i},{rng.choice(cells)},{rng.choice(cells)},{i / 2}\n")
        if rng.random() < 0.1:
            lines.append("\n")
    return "".join(lines)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_records_across_splits_are_those_of_a_whole_file(spark, tmp_path, small_splits, seed, ends):
    path = tmp_path / "sdmx_data_223.csv"
    path.write_bytes(tricky_csv(seed).replace("\n", ends).encode())
    (group,) = wide_csv.header_groups(spark, {223: str(path)})
    assert group.kind == wide_csv.RECORDS and len(group.header) == 4
    found = wide_csv.scan(spark, group)
    want = wide_csv.scan_group(spark, group.header, [str(path)], multi_line=True)
    names = wide_csv.cell_names(group.header)
    assert rows(found.select(*names)) == rows(want.select(*names))
    assert wide_csv._lines(spark, [str(path)]).rdd.getNumPartitions() > 5


def test_a_file_in_splits_without_breaks_is_read_by_lines(spark, tmp_path, small_splits):
    path = tmp_path / "sdmx_data_223.csv"
    path.write_text("Code,Klassifikator,2010\n" + "".join(f'{i},"a, ""b"" 5"" pipe",{i}\n' for i in range(200)) + '7,5" pipe,3\n')
    (group,) = wide_csv.header_groups(spark, {223: str(path)})
    assert group.kind == wide_csv.LINES
    assert wide_csv.scan(spark, group).rdd.getNumPartitions() > 5 and wide_csv.scan(spark, group).count() == 201


def test_bare_carriage_returns_are_read_whole(spark, tmp_path):
    path = tmp_path / "sdmx_data_223.csv"
    path.write_bytes(b'Code,Klassifikator,2010\r1714,a,1\r1715,"b\rc",2\r')
    (group,) = wide_csv.header_groups(spark, {223: str(path)})
    assert (group.kind, group.header) == (wide_csv.WHOLE, ("Code", "Klassifikator", "2010"))
    assert rows(wide_csv.scan(spark, group).select("Code", "Klassifikator", "2010")) == [("1714", "a", "1"), ("1715", "b\nc", "2")]


def test_an_unclosed_quote_takes_the_rest_of_its_file(spark, tmp_path, small_splits):
    path = tmp_path / "sdmx_data_223.csv"
    path.write_text("Code,Klassifikator,2010\n1,a,1\n2,\"b,2\n" + "".join(f"{i},c,{i}\n" for i in range(100)))
    (group,) = wide_csv.header_groups(spark, {223: str(path)})
    found = wide_csv.scan(spark, group).collect()
    assert len(found) == 2 and {r.Code for r in found if r[wide_csv.BROKEN] is None} == {"1"}


def test_one_source_with_files_of_several_kinds(spark, tmp_path):
    folder = tmp_path / "source=sdmx_data_223"
    folder.mkdir()
    (folder / "a.csv").write_text("Code,Klassifikator,2010\n1,a,1\n")
    (folder / "b.csv").write_text('Code,Klassifikator,2010\n2,"b\nb",2\n')
    (folder / "c d.csv").write_text("Code,Klassifikator,2010,2011\n3,c,3,4\n")
    sources = {223: str(folder)}
    assert len(wide_csv.header_groups(spark, sources)) == 3
    staged = ingest.scan_staging(spark, sources)
    want = [(223, 1, "a", 2010, 1.0), (223, 2, "b\nb", 2010, 2.0), (223, 3, "c", 2010, 3.0), (223, 3, "c", 2011, 4.0)]
    assert rows(staged) == want
    records = audit.profile_files(spark, str(tmp_path))
    assert rows(ingest.scan_audited(spark, records)) == want
    assert rows(ingest.scan_audited(spark, records, sources=sources)) == want


def test_the_plan_does_not_grow_with_the_files(spark, tmp_path, plan):
    sizes = []
    for n in (20, 2000):
        folder = tmp_path / str(n) / "source=sdmx_data_223"
        folder.mkdir(parents=True)
        for i in range(n):
            (folder / f"part-{i}.csv").write_text(f"Code,Klassifikator,2010\n{i},a,1\n")
        staged = ingest.scan_staging(spark, {223: str(folder)})
        sizes.append(len(plan(staged)))
        assert staged.count() == n
    assert abs(sizes[1] - sizes[0]) < 200


def test_listing_goes_level_by_level(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(audit, "NAMES", 7)
    want = set()
    for a in range(3):
        for b in range(4):
            folder = tmp_path / "root" / f"a{a}" / f"b {b}" / "c"
            folder.mkdir(parents=True)
            for i in range(9):
                (folder / f"f{i}.csv").write_text("x")
                want.add(f"file:{folder}/f{i}.csv")
            (folder / "_skip.csv").write_text("x")
            (folder / "other.txt").write_text("x")
    (tmp_path / "root" / "empty").mkdir()
    roots = [str(tmp_path / "root"), str(tmp_path / "root" / "a0"), str(tmp_path / "nowhere")]
    found = [r.path for r in audit.list_files(spark, roots, "*.csv").collect()]
    assert len(found) == len(set(found)) and set(found) == want


def test_faults_are_rows(spark, tmp_path, monkeypatch):
    (tmp_path / "good.csv").write_text("a,b\n1,2\n")
    gone = spark.createDataFrame([(f"file:{tmp_path}/good.csv", None), (f"file:{tmp_path}/gone.csv", None), (f"file:{tmp_path}", None)], "path string, modified_at timestamp")
    monkeypatch.setattr(audit, "list_files", lambda *_: gone)
    got = {r.path.rsplit("/", 1)[1]: r.profile_error for r in audit.profile_files(spark, "any").collect()}
    assert got["good.csv"] is None and got["gone.csv"] == "vanished"
    assert got[tmp_path.name].startswith("not readable")
    manifest_rows = spark.createDataFrame([("good.csv",), ("gone.csv",), ("never.csv",)], "filename string")
    assert rows(audit.audit(spark, manifest_rows, "any").select("filename", "status")) == [("gone.csv", "vanished"), ("good.csv", "ok"), ("never.csv", "missing")]


def test_manifest_cells_may_hold_line_breaks(spark, tmp_path):
    path = tmp_path / "manifest.csv"
    path.write_text('dataset_id,url,filename,notes\n1,u,a.csv,"line one\nline two, ""quoted"""\n2,v,b.csv,n\n')
    assert rows(manifest.read_manifest(spark, str(path)).select("dataset_id", "notes")) == [("1", 'line one\nline two, "quoted'), ("2", "n")]


def test_raw_tables_hold_what_the_files_hold(spark, tmp_path):
    (tmp_path / "sdmx_data_223.csv").write_text('Code,Klassifikator,Klassifikator_ru,x,y,2010,2013,2025\n1714,"A\nB",,,,1,2,3\n1715,"c ""d""",,,,4,5,6\n')
    (tmp_path / "sdmx_data_224.csv").write_text("Code,Klassifikator,2010\n17x4,a,1\n1715,b,2\n1716,short\n")
    (tmp_path / "sdmx_data_225.csv").write_text("")
    sources = wide_csv.registry(str(tmp_path), [223, 224, 225])
    names = catalog.register_sources(spark, sources, "raw_held")
    assert names == ["raw_held.sdmx_data_223", "raw_held.sdmx_data_224"]
    assert rows(spark.table(names[0]).select("Code", "Klassifikator", "2010", "2013", "2025")) == [(1714, "A\nB", "1", "2", "3"), (1715, 'c "d"', "4", "5", "6")]
    assert rows(spark.table(names[1])) == [("1715", "b", "2"), ("17x4", "a", "1")]


def test_raw_tables_of_differing_files_are_refused(spark, tmp_path):
    folder = tmp_path / "source=sdmx_data_223"
    folder.mkdir()
    (folder / "a.csv").write_text("Code,Klassifikator,2010\n1,a,1\n")
    (folder / "b.csv").write_text("Code,2010,Klassifikator\n1,1,a\n")
    with pytest.raises(ValueError, match="differ"):
        catalog.register_sources(spark, {223: str(folder)}, "raw_differ")


# --- at size -----------------------------------------------------------------


def test_files_are_profiled_by_many_tasks(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"sdmx_data_{i}.csv").write_text("Code,2010\n1714,1\n")
    found = audit.profile_files(spark, str(tmp_path)).select("path", F.spark_partition_id().alias("task")).collect()
    assert len(found) == 40 and len({r.task for r in found}) > 1


def test_rejects_are_found_in_one_scan(spark, tmp_path, plan):
    long_number, late = "9" * 400, "12\u0085"
    cells = {  # as found, and whether the cell is no number
        "1": False, "7": False, " +1.5 ": False, "1e3": False, ".5": False, "5.": False, "": False, "  ": False, "12\n": False, "9" * 308: False,
        "1e999": True, long_number: True, "0x1p3": True, "1d": True, "NaN": True, "1,2": True, "1,": True, ",": True, late: True, "\n": True, "x": True,
    }
    rows = [(223, str(i), f"n{i}", cell, other) for i, cell in enumerate(cells) for other in (None, "7", cell)]
    rows += [(223, "bad", "n", "x", "1"), (223, None, "n", "x", None), (223, " ", "n", None, None), (None, "+4", "n", None, "y")]
    wide = spark.createDataFrame(rows, "dataset_id int, Code string, Klassifikator string, `2010` string, `2024` string")
    want = []
    for i, code, name, *found in rows:
        if code == "bad":
            want.append((i, code, name, None, code, "code"))
            continue
        number = None if code is None or not code.strip() else str(int(code))
        want += [(i, number, name, y, c, "cell") for y, c in zip((2010, 2024), found, strict=True) if c is not None and cells.get(c, True)]
    got = wh.rejects(wide, wh.YEARS)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    long = sorted((r.geo_name_raw, r.year, r.value) for r in wh.staging_long(wide, wh.YEARS).collect())
    kept = [(n, y, float(c)) for _, code, n, *found in rows if code != "bad" for y, c in zip((2010, 2024), found, strict=True)
            if c is not None and c.strip() and not cells.get(c, True)]
    assert long == sorted(kept)
    wide.drop("dataset_id").write.csv(str(tmp_path / "source=sdmx_data_223"), header=True, escape='"')
    scanned = wide_csv.scan(spark, wide_csv.header_groups(spark, {223: str(tmp_path / "source=sdmx_data_223")})[0])
    assert plan(wh.rejects(scanned, wh.YEARS)).count("FileScan csv") == 1
    assert plan(wh.staging_long(scanned, wh.YEARS)).count("RLIKE") == 1


def test_extracts_meet_by_geography_before_their_pivot(spark, plan):
    text = plan(star.wide_extracts(spark, "/root/testdata/sf0.001"))
    assert re.search(r"hashpartitioning\(geo_code#\d+L, geo_name_raw#\d+, \d+\), REPARTITION_BY_COL", text)
