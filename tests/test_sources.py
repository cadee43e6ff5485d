"""Reading raw files, preparing a panel, writing results."""

import random

import pytest
from pyspark.sql import functions as F

from panelkit.operators import reshape
from panelkit.plans.prepare import clean_panel, prepare_panel
from panelkit.sources import files, lookups, sinks
from panelkit.spec import PanelSpec, duplicate_keys, panel_profile

PREAMBLE = ["Indicator Name,GDP", "Indicator Code,NY.GDP", "Source,World Bank", "Last Updated,2024"]
SPEC = PanelSpec(target="y", features=("x",))


def write(path, header, rows, preamble=PREAMBLE):
    path.write_text("\n".join([*preamble, header, *rows]) + "\n")
    return str(path)


def test_wide_csv(spark, tmp_path):
    path = write(
        tmp_path / "gdp.csv",
        "Country Name,Country Code,Indicator Name,Indicator Code,2018,2019,2020,",
        ['"Korea, Rep.",KOR,GDP,X,1,..,3.5,', "France,FRA,GDP,X,2600,2700,,"],
    )
    rows = {(r["entity"], r["period"]): r for r in files.load_indicator(spark, path, "gdp").collect()}
    assert len(rows) == 6
    assert rows[("Korea, Rep.", 2018)]["gdp"] == 1.0
    assert rows[("Korea, Rep.", 2019)]["gdp"] is None  # bad text
    assert rows[("France", 2020)]["gdp"] is None
    assert rows[("France", 2019)]["code"] == "FRA"


def test_wide_csv_without_preamble_and_long_csv(spark, tmp_path):
    wide = write(tmp_path / "a.csv", "Country,2018,2019", ["France,1,2"], preamble=[])
    assert files.load_indicator(spark, wide, "a").count() == 2
    long = write(tmp_path / "b.csv", "Country Name,Year,b", ["France,2018,7", "France,x,8"], preamble=[])
    got = {r["period"]: r["b"] for r in files.load_indicator(spark, long, "b").collect()}
    assert got == {2018: 7.0, None: 8.0}


def test_header_is_not_guessed_from_data(spark, tmp_path):
    names = [f"C{i}" for i in range(10)]
    long = write(tmp_path / "gdp.csv", "Country Name,Year,gdp", [f"{n},2018,{1950 + i}" for i, n in enumerate(names)], preamble=[])
    assert {r["gdp"] for r in files.load_indicator(spark, long, "gdp").collect()} == {1950.0 + i for i in range(10)}
    rows = [f"{n},{1950 + i},{1960 + i}" for i, n in enumerate(names)]
    for header in ("Country,2018,2019", "Land,2018,2019"):
        wide = write(tmp_path / "wide.csv", header, rows, preamble=[])
        got = files.load_indicator(spark, wide, "x").collect()
        assert {(r["entity"], r["period"]) for r in got} == {(n, p) for n in names for p in (2018, 2019)}
    for lines in (13, 20, 100):
        preamble = [f"Note {i},2020" for i in range(lines)]
        far = write(tmp_path / f"far{lines}.csv", "Country Name,Country Code,2018,2019", ["France,FRA,1,2"], preamble)
        assert files.load_indicator(spark, far, "x").count() == 2


def test_header_anywhere_by_its_place(spark, tmp_path):
    note = "France,FRA,1,2"
    preamble = [note, "", '"a ""quoted"" note, with a comma",', note]
    path = write(tmp_path / "a.csv", "Country Name,Country Code,2018,2019", [note, "Chad,TCD,3,4", note], preamble)
    got = files.read_indicator_csv(spark, path).collect()
    assert [tuple(r) for r in got] == [("France", "FRA", "1", "2"), ("Chad", "TCD", "3", "4"), ("France", "FRA", "1", "2")]
    for header in ("Land,Code,2018,2019", "Country,Code,2018,2019"):
        for lines in (3, 64, 65, 700):
            path = write(tmp_path / f"n{lines}.csv", header, [note, "Chad,TCD,3,4"], [f"Note {i},x" for i in range(lines)])
            got = {(r["entity"], r["period"], r["x"]) for r in files.load_indicator(spark, path, "x").collect()}
            assert got == {("France", 2018, 1.0), ("France", 2019, 2.0), ("Chad", 2018, 3.0), ("Chad", 2019, 4.0)}
    assert files.load_indicator(spark, write(tmp_path / "none.csv", "a,b", ["1,2"] * 100, []), "x") is None


def test_cells_with_line_breaks(spark, tmp_path):
    header = '"Country Name","Country Code",2018,2019'
    rows = ['"Korea,\nRep. ""South""",KOR,1,2', "", "France,FRA,3,", '"Chad",TCD,"4",5', header.replace("2019", "9")]
    for preamble in ([], ['"a note\nof two lines",', "", "  ", "x"], ["n,1"] * 100):
        path = write(tmp_path / f"m{len(preamble)}.csv", header, rows, preamble)
        got = [tuple(r) for r in files.read_indicator_csv(spark, path).collect()]
        assert got == [
            ('Korea,\nRep. "South"', "KOR", "1", "2"), ("France", "FRA", "3", None), ("Chad", "TCD", "4", "5"),
            ("Country Name", "Country Code", "2018", "9"),
        ]


def test_folder_of_files(spark, tmp_path):
    folder = tmp_path / "gdp.csv"
    folder.mkdir()
    write(folder / "part-0.csv", "Country Name,2018", ["France,1"], preamble=["a", "b"])
    write(folder / "part-1.csv", "Country Name,2019", ["France,2"], preamble=[])
    (folder / "_SUCCESS").write_text("")
    got = {(r["entity"], r["period"], r["gdp"]) for r in files.load_indicator(spark, str(folder), "gdp").collect()}
    assert got == {("France", 2018, 1.0), ("France", 2019, None), ("France", 2018, None), ("France", 2019, 2.0)}
    (folder / "part-2.csv").write_text("x\n")
    with pytest.raises(ValueError, match="has no header"):
        files.read_indicator_csv(spark, str(folder))


def test_registry_reports_unreadable_files(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="holds no table"):
        files.load_registry(spark, str(tmp_path), {"x": "bad"})


def test_fold_outer_join_refuses_repeated_keys(spark):
    a = spark.createDataFrame([("a", 1, 5.0), ("a", 1, 7.0)], "entity string, period int, x double")
    b = spark.createDataFrame([("a", 1, 1.0)], "entity string, period int, z double")
    with pytest.raises(Exception, match="repeats the key a, 1"):
        reshape.fold_outer_join([a, b], PanelSpec()).collect()
    assert reshape.join_chain([a, b], PanelSpec()).count() == 2


def test_unreadable_gives_none(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    assert files.load_indicator(spark, str(tmp_path / "bad.csv"), "x") is None
    assert files.load_indicator(spark, str(tmp_path / "absent.csv"), "x") is None
    with pytest.raises(FileNotFoundError):
        files.load_registry(spark, str(tmp_path), {"x": "absent"})


def test_fold_outer_join_equals_chain(spark):
    a = spark.createDataFrame([("u", 1, 1.0, "U"), ("u", 2, None, "U")], "entity string, period int, a double, code string")
    b = spark.createDataFrame([("u", 2, 5.0), ("v", 1, 6.0)], "entity string, period int, b double")
    c = spark.createDataFrame([("v", 1, 9.0, 0.5, "V")], "entity string, period int, c double, a double, code string")
    spec = PanelSpec(code="code")
    cols = ["entity", "period", "a", "b", "c", "code"]
    folded = sorted(map(tuple, reshape.fold_outer_join([a, b, c], spec).select(cols).collect()))
    chained = sorted(map(tuple, reshape.join_chain([a, b, c], spec).select(cols).collect()))
    assert folded == chained
    assert folded == [
        ("u", 1, 1.0, None, None, "U"), ("u", 2, None, 5.0, None, "U"), ("v", 1, None, 6.0, 9.0, "V"),
    ]


def make_raw(tmp_path):
    rng = random.Random(1)
    raw = tmp_path / "raw"
    raw.mkdir()
    names = ["United States", "France", "Viet Nam", "World", "Poor Coverage"]
    years = list(range(2010, 2021))
    for indicator, base in lookups.INDICATOR_FILES.items():
        if indicator == "trade":
            continue  # one file is missing
        rows = []
        for i, name in enumerate(names):
            values = [f"{i + rng.random():.3f}" for _ in years]
            if indicator != "political_stability" and i < 3:
                values[i] = ""
            rows.append(",".join([name, name[:3].upper(), *values]))
        if indicator in ("gdp_growth", "effectiveness", "rule_of_law"):
            rows.append("Chad,TCD," + ",".join([""] * len(years)))
        if indicator == "political_stability":
            rows.append("Chad,TCD," + ",".join(["0.1"] * len(years)))
        write(raw / f"{base}.csv", "Country Name,Country Code," + ",".join(map(str, years)), rows)
    return raw


def test_prepare_panel(spark, tmp_path):
    raw = make_raw(tmp_path)
    hdi = spark.createDataFrame(
        [("France", 2015, "HDI", 0.9), ("France", 2015, "GII", 0.1)],
        "country string, year int, indexCode string, value double",
    )
    extra = files.read_long(hdi, "indexCode", "HDI", {"country": "entity", "year": "period", "value": "hdi"})
    out = prepare_panel(spark, str(raw), train_end=2016, extra=[extra], output=str(tmp_path / "processed"))
    full = out.full
    names = {r["entity"] for r in full.select("entity").distinct().collect()}
    assert names == {"United States", "France", "Vietnam"}  # recoded; aggregates and gaps are gone
    assert full.count() == 33
    nulls = full.agg(*[F.sum(F.col(c).isNull().cast("int")) for c in out.spec.features]).first()
    assert set(nulls) == {0}
    assert out.train.agg(F.max("period")).first()[0] == 2016
    assert out.test.agg(F.min("period")).first()[0] == 2017
    assert "hdi" in out.spec.features and "trade" not in out.spec.features
    test = files.read_processed(spark, str(tmp_path / "processed"), out.spec, "test")
    assert test.count() == 12 and "code" not in test.columns
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_prepare_panel_reads_long_files(spark, tmp_path):
    raw = make_raw(tmp_path)
    (raw / "hdi.csv").write_text('country,year,indexCode,value\n"France",2015,HDI,0.9\nFrance,2016,HDI,..\nFrance,2015,GII,0.1\nMars,2015,HDI,1\n')
    source = files.LongFile("hdi", "indexCode", "HDI", "country", "year", "value")
    absent = files.LongFile("absent", "indexCode", "GII", "country", "year", "value")
    got = {(r["entity"], r["period"], r["hdi"]) for r in files.load_long(spark, str(raw), "hdi", source).collect()}
    assert got == {("France", 2015, 0.9), ("France", 2016, None), ("Mars", 2015, 1.0)}
    out = prepare_panel(spark, str(raw), train_end=2016, long_files={"hdi": source, "gii": absent})
    assert "hdi" in out.spec.features and "gii" not in out.spec.features
    assert out.full.where("entity = 'France' and period = 2015").first()["hdi"] == 0.9
    with pytest.raises(ValueError, match="lacks"):
        files.load_long(spark, str(raw), "x", files.LongFile("hdi", "code", "HDI", "country", "year", "value"))


def test_prepare_sequential_has_no_nulls(spark, tmp_path):
    out = prepare_panel(spark, str(make_raw(tmp_path)), train_end=2016, sequential=True)
    assert out.full.na.drop().count() == out.full.count() == 33


def test_target_must_exist(spark):
    a = spark.createDataFrame([("u", 1, 1.0)], "entity string, period int, a double")
    with pytest.raises(ValueError):
        clean_panel([a], PanelSpec(target="y"), None)


def test_lookups(spark):
    allowed = {r["entity"] for r in lookups.allowed_entities(spark).collect()}
    assert len(allowed) == 200
    for aggregate in ("World", "High income", "European Union", "Arab World", "OECD members"):
        assert aggregate not in allowed
    regions = {r["entity"]: r["region"] for r in lookups.region_table(spark).collect()}
    assert len(regions) == 52 and regions["South Korea"] == "Asia" and regions["Iran"] == "Middle East"


def test_spec_checks(spark, tmp_path, panel):
    df, spec, pdf = panel
    assert spec.validate(df) is df
    with pytest.raises(ValueError, match="the table lacks"):
        spec.validate(df.drop("gdp"))
    with pytest.raises(ValueError, match="empty"):
        spec.validate(df.limit(0))
    with pytest.raises(ValueError, match="duplicate"):
        spec.validate(df.union(df))
    assert duplicate_keys(df, spec).count() == 0
    assert spec.with_features().infer_features(df).features == ("gdp", "trade")
    p = panel_profile(df, spec).first()
    assert tuple(p) == (400, 20, 20, 2000, 2019)
    path = str(tmp_path / "panel.csv")
    pdf.to_csv(path, index=False)
    assert files.read_panel(spark, path, spec).count() == 400
    with pytest.raises(FileNotFoundError):
        files.read_panel(spark, str(tmp_path / "absent.csv"), spec)


def test_result_sinks(spark, tmp_path):
    scores = spark.createDataFrame(
        [("a", 0.7, 0.69, 0.5, 0.4, 9.0, 0.02, 0.9, 0.75), ("b", 0.8, 0.79, 0.4, 0.3, 11.0, 0.0005, 0.85, 0.8)],
        "model string, r2 double, adj_r2 double, rmse double, mae double, f_stat double, "
        "f_pvalue double, train_score double, cv_score double",
    )
    from panelkit.operators.metrics import with_overfitting

    scores = with_overfitting(scores)
    sinks.save_leaderboard(scores, str(tmp_path / "board"), 10, 5)
    board = spark.read.parquet(str(tmp_path / "board")).orderBy("rank").collect()
    assert [r["model"] for r in board] == ["b", "a"] and board[0]["train_samples"] == 10
    assert [r["mark"] for r in board] == ["***", "**"] and board[0]["tier"] == "excellent"
    summary = sinks.save_evaluation_summary(
        {"ml": scores, "panel": scores.select("model", "r2")}, str(tmp_path / "summary")
    )
    assert summary.where("source = 'panel' and rmse is null").count() == 2
    report = sinks.result_report(scores, {"a": {"target": "y"}})
    rows = {(r["model"], r["section"], r["key"]): r["value"] for r in report.collect()}
    assert rows[("a", "configuration", "target")] == "y"
    assert rows[("a", "overfitting", "status")] == "YES" and rows[("b", "overfitting", "status")] == "NO"
    assert rows[("a", "significance", "label")] == "*" and rows[("b", "significance", "label")] == "***"
    sinks.save_table(report, str(tmp_path / "report"), "csv")
    assert spark.read.csv(str(tmp_path / "report"), header=True).count() == report.count()
    sinks.save_panel_report(scores.select("model"), scores.select("r2"), str(tmp_path / "panel"))
    assert spark.read.parquet(str(tmp_path / "panel" / "statistics")).count() == 2


def test_streaming_aggregate_matches_batch(spark, panel, tmp_path):
    from panelkit.operators.evolution import period_evolution

    df, spec, _ = panel
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run = (
        period_evolution(stream, spec, "y").writeStream.outputMode("complete").format("memory")
        .queryName("evolution").start()
    )
    run.processAllAvailable()
    run.stop()
    got = {r["period"]: (r["n"], round(r["average"], 9)) for r in spark.table("evolution").collect()}
    want = {
        r["period"]: (r["n"], round(r["average"], 9)) for r in period_evolution(df, spec, "y").collect()
    }
    assert got == want


def test_periods_outside_the_bounds_raise(spark):
    from panelkit.plans.prepare import clean_panel

    spec = PanelSpec(target="y", features=("x",), period_bounds=(1900, 2100))
    schema = "entity string, period int, y double, x double"
    inside = spark.createDataFrame([("a", 2000, 1.0, 2.0), ("a", 2001, 1.0, 3.0), ("a", None, 1.0, 2.0)], schema)
    panel, _ = clean_panel([inside], spec, None)
    assert sorted(r.period for r in panel.collect()) == [2000, 2001]
    with pytest.raises(Exception, match="period outside"):
        clean_panel([inside.unionByName(spark.createDataFrame([("a", 3000, 1.0, 2.0)], schema))], spec, None)


def test_orders_outside_the_bounds_raise(spark, tmp_path):
    import datetime

    from panelkit.sources.panels import customer_day, customer_year

    rows = [(1, 7, "F", 10.0, datetime.datetime(1999, 5, 1), "1-URGENT"), (2, 7, "F", 10.0, None, "1-URGENT")]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/one/orders.parquet")
    assert [r.period for r in customer_year(spark, f"{tmp_path}/one").collect()] == [1999]
    assert customer_day(spark, f"{tmp_path}/one").count() == 1
    late = [(3, 7, "F", 10.0, datetime.datetime(2500, 1, 1), "1-URGENT")]
    spark.createDataFrame(rows + late, schema).write.parquet(f"{tmp_path}/two/orders.parquet")
    for panel in (customer_year, customer_day):
        with pytest.raises(Exception, match="period outside"):
            panel(spark, f"{tmp_path}/two").collect()
