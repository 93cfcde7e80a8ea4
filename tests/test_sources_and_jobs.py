from datetime import date

import pytest
from pyspark.sql import functions as F

from ebbtide.jobs import outputs_under, scoring_job, train_job
from ebbtide.names import FEATURES
from ebbtide.operators.anchors import churn_target, churned_customers, reference_dates
from ebbtide.sources.order_views import order_views
from ebbtide.sources.readers import (
    load_scoring_tables,
    load_tables,
    profile,
    read_calls,
    read_cease,
    read_feature_csv,
)
from ebbtide.sources.writers import log_run, write_csv, write_features

ID = "unique_customer_identifier"


@pytest.fixture(scope="module")
def files(spark, sf001, tmp_path_factory):
    """The four tables on disk as they arrive: two CSV files and two parquet folders."""
    folder = tmp_path_factory.mktemp("inputs")
    paths = {name: str(folder / name) for name in ("cease", "customer_info", "calls", "usage")}
    tables = order_views(spark, sf001)
    for name in ("cease", "calls"):
        getattr(tables, name).write.option("header", True).csv(paths[name])
    for name in ("customer_info", "usage"):
        getattr(tables, name).write.parquet(paths[name])
    return paths


def test_csv_needs_no_column_order_and_keeps_the_null_text(spark, tmp_path):
    path = tmp_path / "cease.csv"
    path.write_text(
        "extra,cease_completed_date,unique_customer_identifier,cease_placed_date,"
        "reason_description,reason_description_insight\n"
        "1,2024-02-03,001,2024-01-20,r,R\n"
        "2,null,002,2024-01-21,r,R\n"
        "3,,003,not a date,r,R\n"
    )
    cease = read_cease(spark, str(path))
    types = dict(cease.dtypes)
    assert types["cease_placed_date"] == "date"
    assert types["cease_completed_date"] == types[ID] == "string"
    rows = {r[ID]: r for r in cease.collect()}
    assert rows["001"].cease_placed_date == date(2024, 1, 20)
    assert rows["002"].cease_completed_date == "null"
    assert (rows["003"].cease_completed_date, rows["003"].cease_placed_date) == (None, None)
    assert churn_target(cease).first().ref_date == date(2024, 2, 3)
    assert churned_customers(cease, "completed_raw_notnull").count() == 2


def test_dirty_numbers_and_timestamps_become_values_or_null(spark, tmp_path):
    path = tmp_path / "calls.csv"
    path.write_text(
        f"{ID},event_date,call_type,talk_time_seconds,hold_time_seconds\n"
        "a,2024-01-01 10:11:12,CS&B,12.5,abc\n"
        "b,2024-01-02,,,7\n"
    )
    rows = {r[ID]: tuple(r)[1:] for r in read_calls(spark, str(path)).collect()}
    assert rows == {
        "a": (date(2024, 1, 1), "CS&B", 12.5, None),
        "b": (date(2024, 1, 2), None, None, 7.0),
    }


def test_files_give_the_tables_they_were_written_from(spark, files, sf001):
    direct, loaded = order_views(spark, sf001), load_tables(spark, files)
    for name in loaded._fields:
        a, b = getattr(direct, name), getattr(loaded, name)
        assert sorted(a.columns) == sorted(b.columns)
        assert dict(a.dtypes) == dict(b.dtypes)
        assert a.exceptAll(b.select(a.columns)).isEmpty()
        assert a.count() == b.count()
    assert load_scoring_tables(spark, files).cease is None


def test_profile_counts_all_tables(spark, files):
    tables = load_tables(spark, files)
    got = {r.table_name: (r.row_count, r.column_count) for r in profile(tables._asdict()).collect()}
    assert got == {n: (t.count(), len(t.columns)) for n, t in tables._asdict().items()}


def test_feature_table_sinks(spark, tmp_path):
    frame = spark.createDataFrame([("a", None, None), ("b", 1.5, "x")], f"{ID} string, speed double, technology string")
    write_features(frame.limit(1), str(tmp_path / "kept"))
    assert write_features(frame, str(tmp_path / "kept")) == 2  # overwrites
    write_features(frame, str(tmp_path / "filled"), fill_missing=True)
    kept = {r[ID]: r for r in spark.read.parquet(str(tmp_path / "kept")).collect()}
    filled = {r[ID]: r for r in spark.read.parquet(str(tmp_path / "filled")).collect()}
    assert (kept["a"].speed, filled["a"].speed) == (None, 0.0)
    assert filled["a"].technology is None


def test_a_folder_of_csv_files_is_one_table(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"part{i}.csv").write_text(
            f"{ID},speed,technology,is_churned\nc{i},{i}.5,fibre,{i % 2}\n"
        )
    table = read_feature_csv(spark, str(tmp_path))
    assert dict(table.dtypes) == {ID: "string", "speed": "double", "technology": "string", "is_churned": "double"}
    assert sorted((r[ID], r.speed) for r in table.collect()) == [("c0", 0.5), ("c1", 1.5), ("c2", 2.5)]


def test_csv_parts_are_aligned_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{ID},speed,line_speed\na,50,40\n")
    (tmp_path / "b.csv").write_text(f"{ID},line_speed,speed\nb,40,50\n")
    (tmp_path / "c.csv").write_text(f"extra,{ID},line_speed,speed\nx,c,40,50\n")
    rows = read_feature_csv(spark, str(tmp_path)).collect()
    assert sorted((r[ID], r.speed, r.line_speed) for r in rows) == [(c, 50.0, 40.0) for c in "abc"]
    assert sorted(r.extra for r in rows if r.extra is not None) in ([], ["x"])


def test_run_log_appends(spark, tmp_path):
    path = str(tmp_path / "runs")
    for i in range(2):
        log_run(spark, path, f"run{i}", "e", {"depth": 6}, {"roc_auc": 0.5 + i / 10}, {"model": "m"})
    rows = {r.run_id: r for r in spark.read.parquet(path).collect()}
    assert set(rows) == {"run0", "run1"}
    assert rows["run1"].metrics == {"roc_auc": 0.6}
    assert rows["run1"].params == {"depth": "6"}


def test_any_number_of_csv_files_takes_the_same_jobs(spark, tmp_path):
    """Jobs for 2 files with one header, then for 1,500; and for two kinds of header among them."""

    def jobs_of(name, files):
        folder = tmp_path / name
        folder.mkdir()
        for i in range(files):
            (folder / f"f{i:04}.csv").write_text(f"\n{ID},speed\nc{i},{i}\n")
        (folder / "empty.csv").write_text("")
        spark.sparkContext.setJobGroup(name, name)
        try:
            table = read_feature_csv(spark, str(folder))
            used = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return used, table, folder

    few, _, _ = jobs_of("few", 2)
    many, table, folder = jobs_of("many", 1500)
    assert many <= few + 1 and few <= 4  # one more: Spark lists many files in a job
    assert table.agg(F.count("speed"), F.sum("speed")).first()[:] == (1500, sum(range(1500)))
    (folder / "other.csv").write_text(f"speed,{ID},more\n1,z,m\n")
    mixed = read_feature_csv(spark, str(folder))
    assert set(mixed.columns) == {ID, "speed", "more"}
    assert mixed.where(F.col(ID) == "z").first().speed == 1.0 and mixed.count() == 1501


def test_sorted_csv_keeps_its_order(spark, tmp_path):
    path = str(tmp_path / "out")
    frame = spark.range(100).withColumn("v", F.pmod(F.hash("id"), F.lit(17))).orderBy(F.col("v").desc(), "id")
    write_csv(frame, path)
    files = sorted(p for p in (tmp_path / "out").iterdir() if p.suffix == ".csv")
    lines = [line for f in files for line in f.read_text().splitlines() if not line.startswith("id")]
    assert [int(line.split(",")[1]) for line in lines] == [r.v for r in frame.collect()]


def test_train_then_score(spark, files, tmp_path):
    outputs = outputs_under(str(tmp_path))
    result = train_job(spark, files, outputs, trees=3, depth=2)
    assert set(result.metrics) == {"accuracy", "precision", "recall", "f1_score", "roc_auc"}
    tables = load_tables(spark, files)
    anchors = reference_dates(tables.cease, tables.customer_info)
    assert result.features.count() == result.rows == anchors.count()
    assert result.scored_test.count() < result.features.count()

    run = spark.read.parquet(outputs["runs"]).first()
    assert run.experiment == "telecom_churn"
    assert run.params["trees"] == "3"
    assert run.metrics["roc_auc"] == result.metrics["roc_auc"]
    importances = spark.read.option("header", True).csv(outputs["feature_importance"])
    assert {r.feature for r in importances.collect()} >= set(FEATURES)

    written = scoring_job(spark, files, outputs, threshold=0.3, top=5)
    customers = tables.customer_info.select(ID).distinct().count()
    assert written.count() == customers
    high = spark.read.option("header", True).csv(outputs["high_risk"]).collect()
    assert len(high) <= 5
    assert all(float(r.churn_probability) >= 0.3 for r in high)
    # the model in memory and the stored one give the same table
    again = scoring_job(spark, tables, outputs_under(str(tmp_path / "b")), model=result.model)
    assert again.exceptAll(written).isEmpty()


def test_scoring_without_a_model_is_an_error(spark, files, tmp_path):
    with pytest.raises(FileNotFoundError):
        scoring_job(spark, files, outputs_under(str(tmp_path)))


def test_command_line(spark, files, tmp_path, capsys):
    from ebbtide.__main__ import main

    paths = [f"--{k.replace('_', '-')}={v}" for k, v in files.items()]
    main(["train", *paths, f"--output={tmp_path}", "--trees=2"])
    main(["inference", *[p for p in paths if "cease" not in p], f"--output={tmp_path}"])
    shown = capsys.readouterr().out
    assert "roc_auc" in shown and "predictions saved" in shown
    with pytest.raises(SystemExit):
        main(["train", f"--output={tmp_path}"])
