"""Plan guards (no Python, no nested-loop / cartesian joins) and the report
writers."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from fieldkpi import constants as K
from fieldkpi.operators import evolution, kpi
from fieldkpi.plans.reports import write_reports

SF = "/root/testdata/sf0.001"


def _own_queries():
    """The library's queries without those of the training-data subpackage."""
    extra = set(entry.llm_queries.QUERIES) | {"pipeline"} if entry.llm_queries else set()
    return {k: q for k, q in entry.queries().items() if k not in extra}


def test_plans_stay_in_the_jvm(spark):
    for name, q in _own_queries().items():
        plan = q(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"BroadcastNestedLoopJoin|CartesianProduct", plan), name
        assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|MapInArrow|PythonUDF", plan), name


def test_board_sheet(spark):
    boards = kpi.zone_boards(entry._clean(spark, SF))
    sheet = kpi.board_sheet(boards)
    zones = boards.select("zone").distinct().count()
    assert sheet.count() == 7 * zones
    row = sheet.where("row_no = 1").orderBy("zone").first()
    assert row["Indicador"] == "Intervenciones totales"
    assert [r["Indicador"] for r in sheet.where(f"zone = {row['zone']} AND row_no > 0").orderBy("row_no").collect()] == [
        "Intervenciones totales", "Derivaciones CIS", "Llamados 108", "% Contacta", "% No se contacta", "% Sin cubrir"]
    head = sheet.where("row_no = 0").orderBy("zone").first()
    assert head["s1"].startswith("Sem ")


def test_write_reports(spark, tmp_path):
    write_reports(entry._clean(spark, SF), str(tmp_path / "out"), start="1998-01-01")
    assert (tmp_path / "out" / "data_por_comuna").exists()
    parts = [p.name for p in (tmp_path / "out" / "tableros").iterdir() if p.name.startswith("zone=")]
    assert "zone=2.5" in parts and "zone=14.5" in parts


def test_only_unresolved_texts_are_scored(spark, monkeypatch):
    """The scorer gets each distinct text that no rule resolves, and no other."""
    from fieldkpi import constants as K
    from fieldkpi.operators import classify
    from fieldkpi.sources.fixtures import interventions
    seen = []
    original = classify.score_texts
    monkeypatch.setattr(classify, "score_texts", lambda *a: seen.append(original(*a)) or seen[-1])
    rows = classify.closing_columns(interventions(spark, SF, "orders"))
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan
    assert plan.index("HashAggregate") > plan.index("bit_count")   # distinct before scoring
    scored = {r.text for r in seen[0].collect()}
    ruled = {r[0] for r in rows.where(classify.rule_category(K.COL_CLEAN_TEXT).isNotNull()).select(K.COL_CLEAN_TEXT).distinct().collect()}
    assert len(scored) > 20 and not scored & ruled
    assert rows.where(F.col(K.COL_CATEGORY).isNull()).count() == 0


def test_clean_dedup_is_narrow_and_map_side(spark):
    """The weekly winners are picked on narrow columns with partial aggregation,
    so a hot key never travels whole, and the wide rows move once."""
    plan = entry.queries()["clean_history"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "SortAggregate" not in plan
    wide = re.findall(r"Exchange hashpartitioning\(([^,)]*)", plan)
    assert len([k for k in wide if k.startswith(("row_id", "coalesce"))]) <= 2   # the rows and their labels
    assert len(wide) <= 4, wide


def test_reports_scan_the_history_once(spark):
    def scans(name):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        plan = plan[plan.index("== Initial Plan ==") if "== Initial Plan ==" in plan else 0:]
        return plan.count("FileScan parquet")
    assert scans("weekly_zone_summary") == 1


def test_registered_dashboard_prunes_months(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    plan = entry.queries()["dashboard_kpis"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*mes_part#\d+ >= date_format\(cast\((Reused)?Subquery", plan)


def test_vocabulary_join_without_broadcast(spark):
    from fieldkpi import constants as K
    from fieldkpi.operators import classify
    from fieldkpi.sources.fixtures import interventions
    raw = interventions(spark, SF, "orders").select(K.COL_ROW_ID, K.COL_SUPERVISOR, K.COL_RESULT)
    df = raw.withColumn(K.COL_CLOSING, raw[K.COL_RESULT])
    a = classify.classify_outcomes(df).select(K.COL_ROW_ID, K.COL_CATEGORY)
    b = classify.classify_outcomes(df, broadcast_bytes=0).select(K.COL_ROW_ID, K.COL_CATEGORY)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_dashboard_prunes_week_partitions(spark, tmp_path):
    from fieldkpi.plans.weekly import _write_weeks
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")   # untruncated scan filters
    clean = entry._clean(spark, SF)
    path = str(tmp_path / "clean_by_week")
    _write_weeks(clean, path)
    stored = spark.read.parquet(path)
    k = kpi.dashboard_kpis(stored)
    rows = sorted(map(tuple, k.collect()))
    plan = k._jdf.queryExecution().executedPlan().toString()
    pruned = [ln for ln in plan.splitlines() if re.search(r"PartitionFilters: \[[^\]]*mes_part#\d+ >= date_format\(cast\((Reused)?Subquery", ln)]
    assert pruned, "the data scan should prune month partitions by the scalar subquery"
    listing = [ln for ln in plan.splitlines() if re.search(r"PartitionFilters: \[[^\]]*mes_part#\d+ >= (Reused)?Subquery", ln)]
    assert listing, "the week listing should read the latest months only"
    assert rows == sorted(map(tuple, kpi.dashboard_kpis(clean).collect()))


def test_reports_of_daily_counts_equal_those_of_clean_rows(spark):
    clean, daily = entry._clean(spark, SF), entry._daily(spark, SF)
    start = {"start": entry.ACC_START}
    for report, how in ((kpi.zone_boards, {}), (kpi.weekly_zone_summary, start), (kpi.zone_accumulated, start)):
        a, b = report(daily, **how), report(clean, **how)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
        plan = a._jdf.queryExecution().executedPlan().toString()
        assert K.COL_STATE not in plan and "cis_" in plan  # no scan of the history
    assert daily.agg(F.sum("total")).first()[0] == clean.count()


def test_person_days_need_no_shuffle_by_key(spark):
    """Equal to the reports of clean rows, without an exchange on the key."""
    clean, persons = entry._clean(spark, SF), entry._persons(spark, SF)
    for report in (evolution.zone_evolution, evolution.population_weekly):
        a, b = report(persons), report(clean)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
        plan = a._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and "Window" in plan
        assert not re.search(r"Exchange hashpartitioning\((key|DNI)#", plan), plan
        assert re.search(r"Exchange hashpartitioning\((key|DNI|" + K.COL_KEY + ")#", b._jdf.queryExecution().executedPlan().toString())


def test_person_days_of_null_keys_and_days(spark):
    rows = [(1, "a", 2.0, "2024-01-07 10:00:00"), (2, "a", 14.0, "2024-01-07 09:00:00"), (3, "a", 2.0, "2024-01-08 08:00:00"), (4, None, 2.0, "2024-01-08 08:00:00"),
            (5, "a", 3.0, None), (6, "a", 4.0, None), (7, "b", None, "2024-01-09 08:00:00"), (8, "b", 5.0, "2024-01-10 08:00:00")]
    clean = spark.createDataFrame(rows, "rid long, k string, z double, t string").select(
        F.col("rid").alias(K.COL_ROW_ID), F.col("k").alias(K.COL_KEY), F.col("z").alias(K.COL_ZONE), F.col("t").cast("timestamp").alias(K.COL_START))
    days = evolution.person_days(clean)
    assert {(r.key, str(r.day)): r.zone for r in days.collect()} == {
        ("a", "2024-01-07"): 14.0, ("a", "2024-01-08"): 2.0, (None, "2024-01-08"): 2.0, ("a", "None"): 3.0, ("b", "2024-01-09"): None, ("b", "2024-01-10"): 5.0}
    for report in (evolution.zone_evolution, evolution.population_weekly):
        assert sorted(map(str, report(days).collect())) == sorted(map(str, report(clean).collect()))
    assert evolution.zone_evolution(days.limit(0)).count() == 0


def test_positions_over_many_partitions(spark):
    rows = [(f"2024-{m:02d}-{d:02d}", f"Comuna {z}") for m in range(1, 13) for d in (1, 8, 15, 22) for z in range(1, 16)]
    df = spark.createDataFrame(rows, "Semana string, Comuna string").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = kpi.with_position(df)
        assert got.rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    want = sorted(rows, key=lambda r: (r[0], -int(r[1].split()[1])), reverse=True)
    assert [tuple(r)[:2] for r in sorted(got.collect(), key=lambda r: r.pos)] == want
    assert sorted(r.pos for r in got.collect()) == list(range(1, len(rows) + 1))
    assert kpi.with_position(df.limit(0)).count() == 0


def test_closing_texts_are_cleaned_once_per_distinct_text(spark):
    """Rows meet a broadcast vocabulary; the cleaner isn't in their plan. Null, blank and repeated texts have the same category either way."""
    from fieldkpi import constants as K
    from fieldkpi.operators import classify
    texts = [None, "", "  ", "Mendicidad", "MENDICIDAD", "Se realiza entrevista", "Entrevista realizada", "ñandú 1", "xyz", None, "xyz"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"row_id long, `{K.COL_CLOSING}` string")
    got = classify.classify_outcomes(df)
    plan = got._jdf.queryExecution().executedPlan().toString()
    rows_plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "BroadcastHashJoin" in plan and "translate" not in rows_plan
    placed = classify.classify_outcomes(df, broadcast_bytes=0)
    assert got.columns == placed.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, placed.collect())) and got.count() == len(texts)


def test_key_rules_are_not_repeated_in_a_filter(spark):
    from fieldkpi import constants as K
    from fieldkpi.functions.ids import with_dni
    from fieldkpi.operators.evolution import label_rows
    raw = spark.createDataFrame([(1, "2024-01-01", "20.111.222", 1.0), (2, "2024-01-02", "20111222", 2.0), (3, "2024-01-09", "20111222", 1.0),
                                 (4, "2024-01-01", None, 1.0), (5, "2024-01-01", None, 2.0), (6, None, "20111222", 1.0)],
                                f"`{K.COL_ROW_ID}` long, d string, `{K.COL_DNI}` string, `{K.COL_ZONE}` double")
    got = label_rows(with_dni(raw.withColumn(K.COL_START, raw.d.cast("timestamp"))))
    filters = [x for x in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if x.lstrip(" :+-").startswith("Filter")]
    assert not any("RLIKE" in x for x in filters), filters
    rows = {r[K.COL_ROW_ID]: r[K.COL_EVOLUTION] for r in got.collect()}
    assert set(rows) == {2, 3, 4, 5, 6} and rows[4] == rows[5] == rows[6] == K.EVO_UNCLASSIFIED
    assert K.EVO_UNCLASSIFIED not in (rows[2], rows[3]) and rows[2] != rows[3]
