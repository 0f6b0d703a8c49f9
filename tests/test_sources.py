import json
import os
from pathlib import Path

import pytest
from conftest import SMALL, as_dicts
from pyspark.sql import functions as F

from contest_analytics import __main__ as cli
from contest_analytics.operators import features, keyed, learning, trends
from contest_analytics.plans import analytics, catalog, models
from contest_analytics.session import cut_lineage, scratch_dir
from contest_analytics.sources import bucketed, layouts, sinks, standins, tables

# Header order and spare columns differ from what the loader asks for, as in real files.
FILES = {
    "main_metadata.csv": """version,match_id,radiant_win,duration,start_date_time,radiant_score,dire_score,leagueid,first_blood_time
1,1,True,1500,2021-03-04 05:06:07,10,20,5,90
1,2,False,2000,2021-04-04 05:06:07,30,20,5,
1,3,maybe,x,not a time,1,2,,7
1,,True,1500,2021-03-04 05:06:07,10,20,5,90
""",
    "picks_bans.csv": """order,is_pick,hero_id,team,match_id
1,True,11,0,1
2,False,12,1,1
3,1,11,1,2
4,yes,12,0,2
5,True,13,0,99
6,True,,0,1
""",
    "players.csv": """match_id,radiant_win,firstblood_claimed,gold_per_min,xp_per_min,hero_damage,tower_damage,kills,deaths,assists
1,True,1,400,500,1000,10,5,0,3
1,True,0,300,400,2000,20,5,0,1
2,False,,100,,3000,30,1,2,1
""",
    "objectives.csv": 'match_id,time,type\n1,100,CHAT_MESSAGE_FIRSTBLOOD\n1,601,"npc_tower, top"\n2,5,\n',
    "radiant_gold_adv.csv": "minute,gold,match_id\n5,100,1\n10,-300,1\n11,900,1\n",
    "radiant_exp_adv.csv": "minute,exp,match_id\n5,10,1\n",
    "teamfights.csv": "match_id,start,deaths\n1,600,3\n1,700,5\n",
    "draft_timings.csv": "match_id,total_time_taken\n1,25\n1,35\n",
}


@pytest.fixture
def folder(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_match_files_are_typed_by_header_name(spark, folder):
    loaded = layouts.load_match_files(spark, folder)
    got = as_dicts(loaded.matches, "match_id")
    assert got[1] == {
        "match_id": 1, "duration": 1500, "side_a_win": True, "score_a": 10, "score_b": 20, "league_id": 5,
        "first_claim_time": 90, "yr": 2021, "mo": 3,
    }
    assert got[3] == {
        "match_id": 3, "duration": None, "side_a_win": None, "score_a": 1, "score_b": 2, "league_id": None,
        "first_claim_time": 7, "yr": None, "mo": None,
    }
    picks = [tuple(r) for r in loaded.selections.orderBy("match_id", F.col("entity_id")).collect()]
    assert picks == [(1, None, 0, 1), (1, 11, 0, 1), (1, 12, 1, 0), (2, 11, 1, 1), (2, 12, 0, 1), (99, 13, 0, 1)]


def test_null_keys_can_be_rejected(spark, folder):
    loaded = layouts.load_match_files(spark, folder, reject_null_keys=True)
    counts = {r.table_name: r.n_rows for r in tables.table_counts(loaded.named()).collect()}
    assert counts == {
        "matches": 3, "selections": 5, "participants": 3, "objectives": 3, "gold_advantage": 3, "xp_advantage": 1,
        "clashes": 2, "draft_turns": 2,
    }


def test_file_scan_reads_only_the_needed_columns(spark, folder):
    loaded = layouts.load_match_file(spark, folder, "objectives").select("match_id")
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<match_id:string>" in plan


def test_reports_from_a_folder(spark, folder, tmp_path):
    out = f"{tmp_path}/out"
    counts = analytics.run(spark, folder, out)
    assert counts == {
        "entity_trends": 4, "entity_by_phase": 0, "duration_trends": 3, "duration_buckets": 3,
        "entity_top_volatile": 4, "entity_top_series": 4,
    }
    trend = spark.read.csv(f"{out}/entity_trends", header=True, inferSchema=True)
    row = trend.where("yr = 2021 AND entity_id = 12").first()
    assert (row.picks, row.bans, row.pick_rate) == (1, 1, 50.0)
    buckets = spark.read.csv(f"{out}/duration_buckets", header=True, inferSchema=True)
    assert {r.bucket: r.total_matches for r in buckets.collect()} == {"20-30min": 2, "30-40min": 1, "50min+": 1}
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        analytics.run(spark, folder, out)
    assert analytics.run(spark, folder, out, mode="overwrite") == counts


def test_reports_need_two_files_only(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = FILES["main_metadata.csv"].splitlines()
    narrow = [",".join(line.split(",")[1:4]) for line in lines]
    (tmp_path / "in" / "main_metadata.csv").write_text("\n".join(narrow))
    (tmp_path / "in" / "picks_bans.csv").write_text(FILES["picks_bans.csv"])
    cli.main(["reports", f"{tmp_path}/in", f"{tmp_path}/out", "--overwrite"])
    periods = spark.read.csv(f"{tmp_path}/out/duration_trends", header=True, inferSchema=True).collect()
    assert [(r.yr, r.mo, r.total_matches) for r in periods] == [(None, None, 4)]


@pytest.fixture(scope="module")
def larger_folder(spark, tmp_path_factory):
    """The test tables written in the file layout, one CSV folder per file name."""
    base = tmp_path_factory.mktemp("files")
    loaded = standins.load(spark, SMALL)
    outcome = standins.matches(spark, SMALL).select("match_id", "side_a_win")
    frames = loaded.named() | {"participants": loaded.participants.join(outcome, "match_id", "left")}
    for name, (file_name, columns) in layouts.MATCH_FILES.items():
        frame = frames[name].select(
            *[F.col(c).alias(source) for c, (source, _) in columns.items()],
            *(["start_time"] if name == "matches" else []),
        )
        frame.write.option("header", True).csv(f"{base}/{file_name}")
    return str(base)


def test_models_from_a_folder(spark, larger_folder, tmp_path):
    out = f"{tmp_path}/outcome"
    counts = models.run(spark, larger_folder, out, "outcome", compact=True)
    assert counts == {"outcome_metrics": 2, "outcome_importance": 20}
    metrics = {r.model: r for r in spark.read.json(f"{out}/outcome_metrics").collect()}
    assert all(0 <= r.auc <= 1 and 0 <= r.accuracy <= 1 for r in metrics.values())
    best = spark.read.json(f"{out}/outcome_best").first()
    assert best.best_value == max(r.auc for r in metrics.values())
    with pytest.raises(ValueError):
        models.run(spark, larger_folder, out, "other")


def test_duration_model_from_a_folder(spark, larger_folder, tmp_path, monkeypatch):
    monkeypatch.setattr(
        learning, "REGRESSORS", {"linear_regression": learning.REGRESSORS["linear_regression"]}
    )
    counts = models.run(spark, larger_folder, f"{tmp_path}/d", "duration")
    assert counts == {"duration_metrics": 1, "duration_importance": 0}
    assert spark.read.json(f"{tmp_path}/d/duration_best").first().best_model == "linear_regression"


def test_reports_agree_between_layouts(spark, larger_folder):
    from_files = analytics.reports(layouts.load_match_files(spark, larger_folder))
    direct = analytics.reports(standins.load(spark, SMALL))
    for category, named in direct.items():
        for name, df in named.items():
            other = from_files[category][name].select(df.columns)
            assert sorted(map(str, other.collect())) == sorted(map(str, df.collect())), name


def test_scans_agree(spark, tmp_path):
    source = standins.matches(spark, SMALL).select("match_id", "duration", "side_a_win")
    path = f"{tmp_path}/m"
    source.write.option("header", True).csv(path)
    assert set(tables.scan_csv_strings(spark, path).dtypes) == {(c, "string") for c in source.columns}
    typed = tables.scan_csv_typed(spark, path, {"match_id": "bigint", "duration": "int", "side_a_win": "boolean"})
    inferred = tables.scan_csv_inferred(spark, path)
    assert dict(inferred.dtypes)["side_a_win"] == "boolean"
    assert typed.exceptAll(source).count() == 0 and source.exceptAll(typed).count() == 0
    assert inferred.count() == source.count()


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "orc"])
def test_write_table_counts_the_records(spark, tmp_path, fmt):
    df = spark.range(1000).repartition(3)
    assert sinks.write_table(df, f"{tmp_path}/t", fmt) == 1000
    assert spark.read.format(fmt).option("header", True).load(f"{tmp_path}/t").count() == 1000


def test_single_file(spark, tmp_path):
    path = Path(tmp_path) / "one"
    sinks.write_summary(spark.range(10).repartition(4), str(path))
    parts = list(path.glob("part-*"))
    assert len(parts) == 1
    assert sorted(json.loads(line)["id"] for line in parts[0].read_text().splitlines()) == list(range(10))


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_line_breaks_and_appends_are_counted_as_written(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, 'a\nb "c", d'), (2, "plain")], "id int, text string")
    assert sinks.write_table(df, f"{tmp_path}/t", fmt) == 2
    read = sinks.read_result(spark, f"{tmp_path}/t", df.schema, fmt)
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, df.collect()))
    assert sinks.write_table(df.limit(1), f"{tmp_path}/t", fmt, "append") == 1
    assert sinks.read_result(spark, f"{tmp_path}/t", df.schema, fmt).count() == 3
    assert sinks.write_table(df.limit(0), f"{tmp_path}/none", fmt) == 0


def test_cut_lineage_reads_from_the_shared_folder(spark):
    df = cut_lineage(catalog.period_stats(spark, SMALL))
    files = df.inputFiles()
    assert files and all(scratch_dir(spark) in f for f in files)
    assert df.columns == catalog.period_stats(spark, SMALL).columns
    assert spark.sparkContext.getCheckpointDir() is not None


def test_scratch_setting_is_needed_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session())


def test_a_set_of_results_is_complete_or_absent(spark, tmp_path):
    base = f"{tmp_path}/set"
    good = {"a": {"x": spark.range(3), "y": spark.range(4)}}
    with pytest.raises(FileNotFoundError):
        sinks.committed(spark, base)
    assert sinks.commit_results(good, base, summaries={"total": spark.range(1)}) == {"a_x": 3, "a_y": 4}
    broken = spark.range(2).select(F.raise_error(F.lit("lost")).cast("int").alias("id"))
    with pytest.raises(Exception, match="lost"):
        sinks.commit_results({"a": {"x": spark.range(9), "y": broken}}, base, mode="overwrite")
    assert sinks.committed(spark, base) == {"a_x": 3, "a_y": 4}
    assert spark.read.parquet(f"{base}/a_x").count() == 3 and spark.read.json(f"{base}/total").count() == 1
    with pytest.raises(FileExistsError):
        sinks.commit_results(good, base)
    with pytest.raises(ValueError):
        sinks.commit_results(good, base, mode="append")
    assert sinks.commit_results({"b": {"z": spark.range(1)}}, base, mode="overwrite") == {"b_z": 1}
    left = {n for n in os.listdir(base) if not n.startswith(".")}
    assert left == {"b_z", sinks.COMMIT_FILE}  # what only the earlier set had is gone, and no draft is left


def test_type_profile(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c,d,e,f\n1,1.5,yes,2020-01-02 03:04:05,x,\n2, 2 ,no,2020-01-03 00:00:00,y,\n,oops,,,,\n")
    rows, profile = tables.scan_csv_profiled(spark, f"{tmp_path}/t.csv", max_malformed=0.4)
    found = {r.column_name: (r.type, r.n_values, r.n_missing, r.n_malformed) for r in profile.collect()}
    assert found == {
        "a": ("bigint", 2, 1, 0), "b": ("double", 3, 0, 1), "c": ("boolean", 2, 1, 0),
        "d": ("timestamp", 2, 1, 0), "e": ("string", 2, 1, 0), "f": ("string", 0, 3, 0),
    }
    assert [(r.a, r.b, r.c) for r in rows.collect()] == [(1, 1.5, True), (2, 2.0, False), (None, None, None)]
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    one_pass = tables.type_profile(tables.scan_csv_strings(spark, f"{tmp_path}/t.csv"))
    assert one_pass._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    strict = tables.type_profile(tables.scan_csv_strings(spark, f"{tmp_path}/t.csv"))
    assert {r.column_name: r.type for r in strict.collect()}["b"] == "string"


def test_known_durations_only_and_missing_figures_as_zero(spark, rows):
    matches = rows("yr int, mo int, duration int", (2020, 1, 100), (2020, 1, None))
    plain, known = (trends.period_stats(matches, known_only=k).first() for k in (False, True))
    assert (plain.total_matches, known.total_matches) == (2, 1) and plain.avg_duration_sec == known.avg_duration_sec == 100
    names = ("kills", "deaths", "assists", "gold_rate", "xp_rate", "damage", "tower_damage")
    schema = "match_id bigint, " + ", ".join(f"{n} bigint" for n in names)
    players = rows(schema, (1, 4, *[None] * 6), (1, None, *[None] * 6))
    assert keyed.participant_averages(players).first().avg_kills == 4
    assert keyed.participant_averages(players, missing_as_zero=True).first().avg_kills == 2


def test_a_layout_serves_reports_and_models(spark, larger_folder, tmp_path):
    cli.main(["layout", larger_folder, f"{tmp_path}/layout", "--buckets", "3"])
    plain = analytics.run(spark, larger_folder, f"{tmp_path}/plain", "parquet")
    assert analytics.run(spark, f"{tmp_path}/layout", f"{tmp_path}/laid", "parquet") == plain
    for name in plain:
        frames = [spark.read.parquet(f"{tmp_path}/{d}/{name}") for d in ("plain", "laid")]
        rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in frames[0].dtypes]
        one, two = (sorted(map(str, df.select(rounded).collect())) for df in frames)
        assert one == two
    table = features.outcome_table(bucketed.load_tables(spark, f"{tmp_path}/layout", models.OUTCOME_INPUT))
    assert table.count() > 0
    bucketed.detach_layout(spark, f"{tmp_path}/layout")


def test_updates_add_up(spark, larger_folder, tmp_path):
    """Two folders with half of the matches each give what one folder with all gives."""
    names = ("main_metadata.csv", "picks_bans.csv")
    for half in (0, 1):
        for name in names:
            rows = spark.read.csv(f"{larger_folder}/{name}", header=True)
            rows.where(F.col("match_id").cast("bigint") % 2 == half).write.option("header", True).csv(f"{tmp_path}/in{half}/{name}")
    base = ["--state", f"{tmp_path}/state"]
    for half in (0, 1, 1):
        cli.main(["update", f"{tmp_path}/in{half}", f"{tmp_path}/out", *base, "--part", f"half {half}"])
    cli.main(["update", larger_folder, f"{tmp_path}/once", "--state", f"{tmp_path}/state1", "--part", "all"])

    def rows_of(folder, name):
        rows = spark.read.csv(f"{tmp_path}/{folder}/{name}", header=True, inferSchema=True)
        doubles = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in rows.dtypes]
        return sorted(map(str, rows.select(doubles).collect()))

    for name in ("entity_trends", "entity_top_volatile", "entity_top_series", "duration_trends"):
        assert rows_of("out", name) == rows_of("once", name) and rows_of("out", name)
    known = trends.period_stats(standins.matches(spark, SMALL), known_only=True)
    assert spark.read.csv(f"{tmp_path}/out/duration_trends", header=True).count() == known.count()
    with pytest.raises(SystemExit):
        cli.main(["update", larger_folder, f"{tmp_path}/x"])


def test_texts_outside_the_form_of_a_type_need_no_cast(spark):
    """The forms lose nothing that a cast reads, and leave out most of what it does not."""
    texts = ["1.5", "1.", "+7", "--3", "1e5", "1e", " 4\t", "\t4", "4\n", "0x1p3", "nan", "-Infinity", "+INF", "1d", "1L", ".", "-.5e-3",
             "1_0", "١", "12\x00", "TRUE ", "\ttrue", "no", "on", "00", "false\n", "9223372036854775808", "1e999", "2020-01-01", "x", "n/a"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for kind in tables.TYPE_LADDER:
        pairs = df.select(F.col("s").try_cast(kind).cast("string"), tables._read(F.col("s"), kind).cast("string")).collect()
        assert all(plain == read for plain, read in pairs)
    for kind, form in tables._FORMS.items():
        assert df.where(F.col("s").isin("x", "n/a", "2020-01-01") & F.col("s").rlike(form)).count() == 0
