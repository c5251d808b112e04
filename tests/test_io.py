"""Sources, sinks, catalog views, the weekly run and the streaming ingest."""

import os
import threading
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldkpi import constants as K
from fieldkpi.operators import evolution
from fieldkpi.plans.dashboard import dashboard_data
from fieldkpi.plans.weekly import weekly_run
from fieldkpi.sources import catalog, readers, snapshots, writers
from fieldkpi.sources.fixtures import interventions
from fieldkpi.sources.snapshots import read_snapshot
from fieldkpi.sources.zones import ASSET, demo_zones
from fieldkpi.streaming.ingest import start_ingest

SF = "/root/testdata/sf0.001"


def _report_rows(spark, lo, hi):
    """Landed report rows (text cells) for orders dated in [lo, hi)."""
    df = interventions(spark, SF, "orders").where(
        (F.col(K.COL_START) >= F.lit(lo).cast("timestamp")) & (F.col(K.COL_START) < F.lit(hi).cast("timestamp")))
    cols = [c for c in df.columns if c != K.COL_ROW_ID]
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols]).toPandas()


def _write_report(pdf: pd.DataFrame, path: str) -> None:
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("Reporte semanal de intervenciones\n")  # banner line above the header
        pdf.to_csv(fh, index=False)


def test_report_reader_and_newest(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    a = _report_rows(spark, "1996-01-01", "1996-03-01")
    _write_report(a, str(land / "a.csv"))
    time.sleep(1.1)
    b = _report_rows(spark, "1996-02-01", "1996-05-01")
    _write_report(b, str(land / "b.csv"))
    newest = readers.newest_file(spark, str(land))
    assert newest.endswith("b.csv")
    rep = readers.read_report(spark, newest)
    assert rep.count() == len(b)
    assert K.COL_START in rep.columns and K.COL_DNI in rep.columns


def test_weekly_run_incremental_equals_rebuild(spark, tmp_path):
    land, raw, clean = tmp_path / "landing", str(tmp_path / "raw"), str(tmp_path / "clean")
    land.mkdir()
    zones = demo_zones(spark)
    first = _report_rows(spark, "1996-01-01", "1996-04-01")
    _write_report(first, str(land / "w1.csv"))
    r1 = weekly_run(spark, str(land), raw, clean, zones)
    assert r1.appended and r1.rebuilt and readers.list_versions(spark, raw, "batch") == [1]
    time.sleep(1.1)
    second = _report_rows(spark, "1996-03-01", "1996-06-01")   # overlaps the first report
    _write_report(second, str(land / "w2.csv"))
    r2 = weekly_run(spark, str(land), raw, clean, zones)
    assert r2.appended and not r2.rebuilt and r2.from_week is not None
    assert readers.list_versions(spark, raw, "batch") == [1, 2]
    assert spark.read.parquet(r2.raw_batch).count() < len(second)   # only the new rows were written
    hist = readers.read_batches(spark, raw)
    mark = pd.to_datetime(first[K.COL_START]).max()
    later = (pd.to_datetime(second[K.COL_START]) > mark).sum()
    assert hist.count() == len(first) + later
    assert hist.select(K.COL_ROW_ID).distinct().count() == hist.count()
    # the incrementally updated clean history equals a full rebuild
    from fieldkpi.plans.weekly import CLEAN_PART, build_clean
    full = str(tmp_path / "full")
    build_clean(spark, raw, full, zones)
    a = read_snapshot(spark, clean).drop(CLEAN_PART)
    b = read_snapshot(spark, full).drop(CLEAN_PART).select(*a.columns)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # the daily counts follow: only the months of the update were counted anew
    from fieldkpi.operators import kpi
    from fieldkpi.plans import aggregates
    daily = aggregates.daily_path(clean)
    versions = snapshots.snapshots(spark, daily)[-1].months
    moved = {m for m, v in versions.items() if v == 2}
    assert aggregates.refresh_daily(spark, clean) is None and min(moved) == r2.from_week.strftime("%Y-%m") and set(versions.values()) == {1, 2}
    assert _same(aggregates.read_daily(spark, clean), kpi.daily_counts(read_snapshot(spark, clean)))
    # and so do the person days, bucketed by key
    persons = aggregates.persons_path(clean, aggregates.person_buckets(spark, clean))
    versions = snapshots.snapshots(spark, persons)[-1].months
    moved = {m for m, v in versions.items() if v == 2}
    assert aggregates.refresh_persons(spark, clean) is None and min(moved) == r2.from_week.strftime("%Y-%m") and set(versions.values()) == {1, 2}
    assert _same(aggregates.read_persons(spark, clean), evolution.person_days(read_snapshot(spark, clean)))
    # same report again: nothing new, nothing rewritten
    r3 = weekly_run(spark, str(land), raw, clean, zones)
    assert not r3.appended and readers.list_versions(spark, raw, "batch") == [1, 2]


def test_views_match_operators(spark, tmp_path):
    from __spark_entry__ import _clean
    clean = _clean(spark, SF)
    clean.createOrReplaceTempView("historico_limpio_t")
    catalog.create_views(spark, "historico_limpio_t", temporary=True)
    view = spark.table(catalog.POPULATION_VIEW)
    op = evolution.population_weekly(clean)
    assert sorted(map(tuple, view.collect())) == sorted(map(tuple, op.select(*view.columns).collect()))
    enr = spark.table(catalog.ENRICHED_VIEW)
    assert "Categoria_Contacto" in enr.columns and enr.count() == clean.count()


def test_catalog_check_and_restore(spark, tmp_path):
    from __spark_entry__ import _clean
    path = str(tmp_path / "clean.parquet")
    _clean(spark, SF).write.parquet(path)
    missing = [r.name for r in catalog.missing_objects(spark).collect()]
    assert "historico_limpio" in missing
    assert catalog.restore(spark, path)
    assert [r.name for r in catalog.missing_objects(spark).collect()] == []
    empty = str(tmp_path / "empty.parquet")
    spark.read.parquet(path).limit(0).write.parquet(empty)
    assert not catalog.restore(spark, empty)


def test_sheet_and_payload(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "nan"), (2, 3.5, "x")], "a int, b double, c string")
    out = sorted(map(tuple, writers.sheet_frame(df).collect()))
    assert out == [("1", "", ""), ("2", "3.5", "x")]
    writers.write_sheet(df, str(tmp_path / "sheet"))
    files = [f for f in os.listdir(tmp_path / "sheet") if f.endswith(".csv")]
    assert len(files) == 1
    from __spark_entry__ import _clean
    payload, chart = dashboard_data(_clean(spark, SF))
    assert payload.count() == 16 and chart.count() == 2
    import json
    doc = json.loads(payload.where("scope = 'total'").first().payload)
    assert len(doc["weeks"]) == 8 and [r["label"] for r in doc["rows"]] == [
        "Intervenciones totales", "Derivaciones CIS", "Llamados 108", "% Se contacta", "% No se contacta", "% Sin cubrir"]
    assert [type(r["vals"][0]) for r in doc["rows"]] == [int, int, int, str, str, str]
    sets = json.loads(chart.first().chart)["datasets"]
    assert [(d["label"], d["backgroundColor"], type(d["data"][0])) for d in sets] == [
        ("Nuevos", "#10B981", int), ("Recurrentes", "#3B82F6", int), ("Migratorios", "#F97316", int)]


def test_streaming_ingest(spark, tmp_path):
    land, raw, ck = tmp_path / "landing", str(tmp_path / "raw"), str(tmp_path / "ck")
    land.mkdir()
    pdf = _report_rows(spark, "1997-01-01", "1997-03-01")
    _write_report(pdf, str(land / "r1.csv"))   # with its banner line
    schema = readers.history_schema(list(pdf.columns))
    q = start_ingest(spark, str(land), schema, raw, ck)
    q.awaitTermination(120)
    assert readers.read_batches(spark, raw).count() == len(pdf)
    pdf2 = _report_rows(spark, "1997-02-01", "1997-04-01")
    pdf2.to_csv(land / "r2.csv", index=False)
    q2 = start_ingest(spark, str(land), schema, raw, ck)
    q2.awaitTermination(120)
    mark = pd.to_datetime(pdf[K.COL_START]).max()
    assert readers.read_batches(spark, raw).count() == len(pdf) + (pd.to_datetime(pdf2[K.COL_START]) > mark).sum()


def test_command_line(spark, tmp_path):
    from fieldkpi.__main__ import main
    land, raw, clean = tmp_path / "landing", str(tmp_path / "raw"), str(tmp_path / "clean")
    land.mkdir()
    _write_report(_report_rows(spark, "1996-01-01", "1996-04-01"), str(land / "w1.csv"))
    assert main(["weekly", "--landing", str(land), "--raw", raw, "--clean", clean, "--zones", ASSET]) == 0
    with pytest.raises(SystemExit):   # no default layer
        main(["weekly", "--landing", str(land), "--raw", raw, "--clean", clean])
    assert main(["dashboard", "--clean", clean, "--out", str(tmp_path / "dash")]) == 0
    assert (tmp_path / "dash" / "indicators").exists() and (tmp_path / "dash" / "evolution").exists()
    assert main(["reports", "--clean", clean, "--out", str(tmp_path / "rep"), "--start", "1996-01-01"]) == 0
    assert (tmp_path / "rep" / "tableros").exists()


def test_command_line_views_and_check(spark, tmp_path):
    from fieldkpi.__main__ import main
    from __spark_entry__ import _clean
    path = str(tmp_path / "clean")
    _clean(spark, SF).write.parquet(path)
    assert main(["views", "--clean", path]) == 0
    assert main(["check"]) == 0


def test_view_contact_case_equals_rule(spark):
    from __spark_entry__ import _clean
    from fieldkpi.functions.contact import contact_class
    clean = _clean(spark, SF)
    clean.createOrReplaceTempView("historico_limpio_c")
    catalog.create_views(spark, "historico_limpio_c", temporary=True)
    view = spark.table(catalog.ENRICHED_VIEW).select(K.COL_ROW_ID, "Categoria_Contacto")
    rule = clean.select(K.COL_ROW_ID, contact_class(K.COL_STATE, K.COL_RESULT).alias("Categoria_Contacto"))
    assert view.exceptAll(rule).count() == 0 and rule.exceptAll(view).count() == 0


def _clean_rows(spark, path):
    from fieldkpi.plans.weekly import CLEAN_PART
    return read_snapshot(spark, path).drop(CLEAN_PART)


def _same(a, b):
    b = b.select(*a.columns)
    return a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_streamed_batches_keep_every_anonymous_row(spark, tmp_path):
    from fieldkpi.plans.weekly import clean_pending
    land, raw, clean, ck = tmp_path / "landing", str(tmp_path / "raw"), str(tmp_path / "clean"), str(tmp_path / "ck")
    land.mkdir()
    zones = demo_zones(spark)
    for n, (lo, hi) in enumerate([("1997-01-01", "1997-03-01"), ("1997-03-01", "1997-04-15")]):
        pdf = _report_rows(spark, lo, hi)
        _write_report(pdf, str(land / f"r{n}.csv"))
        start_ingest(spark, str(land), readers.history_schema(list(pdf.columns)), raw, ck).awaitTermination(120)
        rebuilt, week = clean_pending(spark, raw, clean, zones)
        assert rebuilt == (n == 0)
    hist = readers.read_batches(spark, raw)
    assert hist.where(F.col(K.COL_ROW_ID).isNull()).count() == 0
    from fieldkpi.plans.clean import clean_rows, type_report
    typed = clean_rows(type_report(hist), zones)
    anonymous = typed.where(F.col(K.COL_KEY).isin(K.ANONYMOUS_KEYS)).count()
    assert anonymous > 10 and _clean_rows(spark, clean).where(F.col(K.COL_EVOLUTION) == K.EVO_UNCLASSIFIED).count() == anonymous


def test_failed_update_is_repaired_by_the_next_run(spark, tmp_path, monkeypatch):
    from fieldkpi.plans import weekly
    land, raw, clean, full = tmp_path / "landing", str(tmp_path / "raw"), str(tmp_path / "clean"), str(tmp_path / "full")
    land.mkdir()
    zones = demo_zones(spark)
    spans = [("1996-01-01", "1996-03-10"), ("1996-03-10", "1996-04-20"), ("1996-04-20", "1996-05-05"), ("1996-05-05", "1996-06-20")]
    for n, (lo, hi) in enumerate(spans):
        time.sleep(1.1)
        _write_report(_report_rows(spark, lo, hi), str(land / f"w{n}.csv"))
        if n in (1, 2):   # two runs in a row fail between the raw batch and the clean data
            with monkeypatch.context() as m:
                m.setattr(weekly, "_write_weeks", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
                with pytest.raises(RuntimeError):
                    weekly.weekly_run(spark, str(land), raw, clean, zones)
            if n == 1:
                r = weekly.weekly_run(spark, str(land), raw, clean, zones)   # the same report again
                assert not r.appended and r.from_week is not None
        else:
            weekly.weekly_run(spark, str(land), raw, clean, zones)
    r = weekly.weekly_run(spark, str(land), raw, clean, zones)
    assert not r.appended and not r.rebuilt and r.from_week is None
    weekly.build_clean(spark, raw, full, zones)
    assert _same(_clean_rows(spark, clean), _clean_rows(spark, full))


def test_row_ids_are_checked_at_the_append(spark, tmp_path):
    base = str(tmp_path / "raw")
    schema = f"`{K.COL_START}` timestamp, {K.COL_ROW_ID} long"
    frame = lambda ids: spark.createDataFrame([(None, i) for i in ids], schema)
    for bad in ([1, None], [1, 1], [-1]):
        with pytest.raises(ValueError):
            writers.append_batch(frame(bad), base)
    assert writers.append_batch(frame([]), base) is None and readers.batch_stats(spark, base) == []
    assert writers.append_batch(frame([4, 2]), base).endswith("batch=1")
    with pytest.raises(ValueError):
        writers.append_batch(frame([9, 4]), base)
    writers.append_batch(frame([3]).drop(K.COL_ROW_ID), base)
    ids = sorted(r[0] for r in readers.read_batches(spark, base).select(K.COL_ROW_ID).collect())
    assert ids[:2] == [2, 4] and ids[2] > 4 and [r.last_id for r in readers.batch_stats(spark, base)] == [4, ids[2]]


def test_clean_files_are_few_and_sorted_by_date(spark, tmp_path):
    from __spark_entry__ import _clean
    from fieldkpi.plans.weekly import CLEAN_PART, _write_weeks
    path = str(tmp_path / "clean")
    _write_weeks(_clean(spark, SF).repartition(8), path)
    files = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    months = spark.read.parquet(path).select(CLEAN_PART).distinct().count()
    assert len(files) <= 1.2 * months
    for f in files[:12]:
        dates = [r[0] for r in spark.read.parquet(f).select(K.COL_START).collect()]
        assert dates == sorted(dates, key=lambda d: (d is not None, d))


def test_cells_with_line_breaks_and_quotes(spark, tmp_path):
    p = tmp_path / "r.csv"
    cells = ["a\nb", 'say "hi"', "x,y"]
    with open(p, "w", encoding="utf-8") as fh:
        fh.write("Reporte\n")
        pd.DataFrame({K.COL_START: ["2025-01-01"] * 3, K.COL_RESULT: cells}).to_csv(fh, index=False)
    assert sorted(r[K.COL_RESULT] for r in readers.read_report(spark, str(p)).collect()) == sorted(cells)


def test_first_run_with_an_empty_report(spark, tmp_path):
    land, raw, clean = tmp_path / "landing", str(tmp_path / "raw"), str(tmp_path / "clean")
    land.mkdir()
    (land / "w.csv").write_text("Reporte\n" + ",".join(readers.REPORT_COLUMNS) + "\n", encoding="utf-8")
    r = weekly_run(spark, str(land), raw, clean, demo_zones(spark))
    assert not r.appended and not r.rebuilt and not os.path.exists(clean)


def test_bad_coordinates_raise_unless_lenient(spark, tmp_path):
    land, zones = tmp_path / "landing", demo_zones(spark)
    land.mkdir()
    pdf = _report_rows(spark, "1996-01-01", "1996-01-20")
    pdf.loc[0, K.COL_LAT] = "abc"
    pdf.loc[0, K.COL_AGENCY] = None
    _write_report(pdf, str(land / "w.csv"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        weekly_run(spark, str(land), str(tmp_path / "raw"), str(tmp_path / "clean"), zones)
    r = weekly_run(spark, str(land), str(tmp_path / "raw"), str(tmp_path / "clean"), zones, strict_coordinates=False)
    assert r.rebuilt


def _small(spark, n, months):
    """Clean rows of the given months, ``n`` a month; one row in ten without a date."""
    dates = [f"{m}-{8 + 7 * (i % 3):02d}" for m in months for i in range(n)]
    rows = [(i, None if i % 10 == 9 else d) for i, d in enumerate(dates)]
    return spark.createDataFrame(rows, "row_id long, d string").select("row_id", F.to_timestamp("d").alias(K.COL_START))


def test_a_failing_write_leaves_readers_on_the_old_snapshot(spark, tmp_path, monkeypatch):
    from fieldkpi.plans import weekly
    base = str(tmp_path / "clean")
    weekly._write_snapshot(_small(spark, 8, ["2024-01", "2024-02", "2024-03"]), base, 1, "")
    first = snapshots.snapshots(spark, base)[-1]
    before = sorted(r[0] for r in read_snapshot(spark, base).select("row_id").collect())
    assert len(before) == 24 and None in first.months
    with monkeypatch.context() as m:  # the data are written, the manifest isn't
        m.setattr(weekly, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            weekly._write_snapshot(_small(spark, 5, ["2024-03"]), base, 2, "2024-03")
    assert sorted(r[0] for r in read_snapshot(spark, base).select("row_id").collect()) == before
    second = weekly._write_snapshot(_small(spark, 5, ["2024-03"]).where(F.col(K.COL_START).isNotNull()), base, 2, "2024-03")
    got = read_snapshot(spark, base)
    assert {m for m, v in second.months.items() if v != first.months[m]} == {"2024-03"} and second.months["2024-03"] == 3
    assert got.where(F.col(K.CLEAN_PART) == "2024-03").count() == 5 and got.where(F.col(K.CLEAN_PART).isNull()).count() == 2
    assert sorted(r[0] for r in read_snapshot(spark, base, first).select("row_id").collect()) == before  # the old one is still there
    assert snapshots.expire(spark, base, keep=2) == [2] and snapshots.expire(spark, base, keep=1) == []  # version 1 holds other months
    plan = got.where(F.col(K.CLEAN_PART) >= "2024-03")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(mes_part" in plan


def test_readers_see_whole_snapshots_while_one_is_published(spark, tmp_path):
    from fieldkpi.plans import weekly
    base, seen, stop = str(tmp_path / "clean"), [], threading.Event()
    weekly._write_snapshot(_small(spark, 8, ["2024-01", "2024-02"]), base, 1, "")
    snapshots.publish(spark, base, "publicado")
    assert K.CLEAN_PART not in spark.table("publicado").columns

    def read():
        while not stop.is_set():
            try:
                seen.append(spark.sql("SELECT count(*) AS n FROM publicado").first().n)
            except Exception as e:  # noqa: BLE001 - any failure is what the test is about
                seen.append(repr(e))

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(1, 4):
        dated = _small(spark, 8 + i, ["2024-02"]).where(F.col(K.COL_START).isNotNull())
        weekly._write_snapshot(dated, base, 1 + i, "2024-02")
        snapshots.publish(spark, base, "publicado")
        snapshots.publish(spark, base, "publicado")
    stop.set()
    reader.join()
    allowed = {read_snapshot(spark, base, s).count() for s in snapshots.snapshots(spark, base)}
    assert len(seen) > 3 and set(seen) <= allowed
    assert spark.table("publicado").count() == read_snapshot(spark, base).count()
    assert len([t for t in spark.catalog.listTables() if t.name.startswith("publicado_almacen_")]) == 2
    assert not catalog.restore(spark, str(tmp_path / "absent"))


def test_checkpoint_folder_must_be_shared_off_local_masters():
    from types import SimpleNamespace

    from fieldkpi.session import ensure_checkpoint_dir
    fake = SimpleNamespace(sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://x"), conf=SimpleNamespace(get=lambda k, d: d))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(fake)
