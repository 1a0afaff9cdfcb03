"""The whole chain on delimited files laid out like the real sources."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from catalogue.queries import QUERIES, rounded, sources
from catalogue.views import CONDITIONS, MEASURES, view
from peerlens.operators.neighbours import nearest_from_pairs
from peerlens.operators.layer import map_layer
from peerlens.plans import index as index_plan
from peerlens.plans import jobs
from peerlens.sources import staging
from peerlens.plans.names import INDICATORS, SCORES, similarity_features
from peerlens.sources.inputs import FIELDS, load_sources
from peerlens.sources.readers import read_csv, read_csv_all, read_csv_parts, read_snapshot, rows_of_layer
from peerlens.sources.sinks import write_csv, write_snapshot, write_snapshots
from peerlens.sources.attributes import write_attributes
from peerlens.sources.staging import new_folder, stage, staging_scope
from peerlens.sources.workbooks import Sheet, write_workbooks

SF = "/root/testdata/sf0.001"


def at_positions(df, fields, width):
    """Lay the named columns out at their 1-based positions, filler between."""
    spots = {p: n for p, n, _ in fields}
    return df.select(
        *[F.col(spots[p]).alias(f"{spots[p]}") if p in spots else F.lit("x").alias(f"c{p}") for p in range(1, width + 1)]
    )


@pytest.fixture(scope="module")
def paths(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("inputs"))

    def v(name):
        return view(spark, SF, name)

    ages = v("v_age")
    # A closed membership must not count.
    members = v("v_member").withColumn("close_date", F.lit(None).cast("string"))
    closed = members.limit(1).withColumns({"pcn_code": F.lit("U999"), "close_date": F.lit("20200101")})
    income = v("v_income_parent").withColumnsRenamed({f"p{p}": f"payment_{p}" for p in range(7, 14)})
    tables = {
        "registrations": (v("v_reg"), 7, True),
        "practices": (v("v_prac"), 26, False),
        "parents": (v("v_pcn"), 12, True),
        "members": (members.unionByName(closed), 10, True),
        "locations": (v("v_loc"), 9, True),
        "postcodes": (v("v_postcode"), 44, True),
        "age_female": (ages.filter("gender = 'females'"), 8, True),
        "age_male": (ages.filter("gender = 'males'"), 8, True),
        "prevalence": (v("v_prev"), 5, True),
        "practice_income": (v("v_income"), 73, True),
        "parent_income": (income, 13, True),
        "parent_staff": (v("v_staff_parent"), 15, True),
        "ethnicity": (v("v_eth"), 26, True),
        "area_map": (v("v_map"), 5, True),
    }
    out = {}
    for name, (df, width, header) in tables.items():
        out[name] = f"{root}/{name}"
        write_csv(at_positions(df, FIELDS[name], width), out[name], header=header)
    staff = at_positions(v("v_staff"), FIELDS["practice_staff"], 6)
    joined = v("v_staff").select(
        "prac_code", F.lit("x").alias("c2"), "staff_group", F.lit("x").alias("c4"), F.lit("x").alias("c5"), "fte",
        F.col("detailed_staff_role").alias("DETAILED_STAFF_ROLE"), F.col("measure").alias("MEASURE"),
    )
    assert joined.columns[:6] == staff.columns[:6]
    out["practice_staff"] = f"{root}/practice_staff"
    write_csv(joined, out["practice_staff"])
    achievement = at_positions(v("v_ach"), FIELDS["achievement"], 7)
    out["achievement"] = []
    for i, indicator in enumerate(MEASURES):
        part = achievement.filter(F.col("INDICATOR_CODE") == indicator)
        out["achievement"].append(f"{root}/achievement{i}")
        write_csv(part, out["achievement"][-1])
    out["areas"], out["scores"] = f"{root}/areas", f"{root}/scores"
    write_csv(v("v_area"), out["areas"])
    write_csv(v("v_score"), out["scores"])
    for t, names in INDICATORS.items():
        fields = [(1, "lsoa11cd", "string"), *[(5 + i, n, "double") for i, n in enumerate(names)]]
        out[f"indicators_{t}"] = f"{root}/indicators_{t}"
        write_csv(at_positions(v(f"v_dep_{t}"), fields, 4 + len(names)), out[f"indicators_{t}"])
    return out


@pytest.fixture(scope="module")
def built(spark, paths, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    jobs.build_index(spark, load_sources(spark, paths), out)
    return out


def test_a_scope_removes_what_was_staged_in_it(spark):
    with staging_scope(spark, "trial"):
        path = new_folder(spark, "table")
        kept = stage(spark.range(3), "numbers")
        assert kept.count() == 3
        folder = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 2)[0]
        assert path.startswith(folder) and os.path.isdir(folder)
    assert not os.path.exists(folder)
    assert not new_folder(spark, "table").startswith(folder)


def as_set(df):
    return {tuple(r) for r in df.select(*sorted(df.columns)).collect()}


@pytest.mark.parametrize("level, query", [("practice", "full_index"), ("pcn", "full_index_parent")])
def test_index_from_files_equals_the_registered_query(spark, built, level, query):
    stored = rounded(read_snapshot(spark, f"{built}/nn_data/{level}"))
    want = QUERIES[query](spark, SF)
    assert sorted(stored.columns) == sorted(want.columns)
    assert as_set(stored) == as_set(want)
    report = read_snapshot(spark, f"{built}/quality/registrations").first()
    assert 0 < report.n_removed < report.n_rows and report.report.startswith(f"Rows removed: {report.n_removed} (")
    text = read_csv_all(spark, f"{built}/{level}_level_nn_data")
    assert text.columns == stored.columns
    assert text.count() == want.count()


def test_index_layout(spark, built):
    index = read_snapshot(spark, f"{built}/nn_data/practice")
    assert jobs.conditions_of(spark, built) == CONDITIONS
    assert index.columns[:10] == [
        "ORG_CODE", "ORG_NAME", "POSTCODE", "ICB_CODE", "ICB_NAME", "NHSER_CODE", "NHSER_NAME", "LATITUDE",
        "LONGITUDE", "POPN",
    ]
    assert "dir_fte" not in read_snapshot(spark, f"{built}/nn_data/pcn").columns
    assert len(similarity_features([f"c{i}" for i in range(20)])) == 90


def test_neighbours_and_refresh(spark, built):
    jobs.build_neighbours(spark, built)
    assert not os.path.exists(f"{built}/dist_data")
    jobs.refresh_neighbours(spark, built)
    without = {level: as_set(read_snapshot(spark, f"{built}/dist_data_n10/{level}")) for level in jobs.LEVELS}
    jobs.build_neighbours(spark, built, with_pairs=True)
    jobs.refresh_neighbours(spark, built)
    for level in jobs.LEVELS:
        assert {r[:1] + r[2:] for r in without[level]} == {r[:1] + r[2:] for r in as_set(read_snapshot(spark, f"{built}/dist_data_n10/{level}"))}
    for level in jobs.LEVELS:
        n = read_snapshot(spark, f"{built}/nn_data/{level}").count()
        pairs = read_snapshot(spark, f"{built}/dist_data/{level}")
        assert pairs.count() == n * (n - 1)
        lists = read_snapshot(spark, f"{built}/dist_lists/{level}")
        near = lists.filter("list = 'nearest'").select("orig", "dest", "place")
        assert as_set(near) == as_set(nearest_from_pairs(pairs).select("orig", "dest", "place"))
        refreshed = read_snapshot(spark, f"{built}/dist_data_n10/{level}").select("orig", "dest", "place")
        assert as_set(near) == as_set(refreshed)
        assert near.count() == n * min(10, n - 1)


def test_clusters_and_map(spark, built):
    jobs.build_clusters(spark, built, k_max=5)
    index = read_snapshot(spark, f"{built}/nn_data/practice")
    clusters = read_snapshot(spark, f"{built}/clusters/practice")
    assert clusters.count() == index.count()
    assert {r.cluster for r in clusters.collect()} == set(range(1, 8))
    diagnostics = read_snapshot(spark, f"{built}/k_diagnostics/pcn")
    assert {r.k for r in diagnostics.collect()} == {1, 2, 3, 4, 5}
    layer = rows_of_layer(spark, f"{built}/map_layer", 1)
    assert "PartitionFilters: [isnotnull(cluster" in layer._jdf.queryExecution().toString()
    row = layer.first()
    assert row.fill_color == "#E41A1C" and row.layer == "1"
    assert row.popup.startswith("Practice: ") and "<br>ICB: " in row.popup and "<br>Popn: " in row.popup


def test_twelve_clusters_all_have_a_colour(spark, built):
    index = read_snapshot(spark, f"{built}/nn_data/practice")
    clusters = index.select("ORG_CODE", (F.monotonically_increasing_id() % 12 + 1).cast("int").alias("cluster"))
    rows = map_layer(index, clusters, palette=["red", "blue"]).collect()
    assert all(r.fill_color == ["red", "blue"][(r.cluster - 1) % 2] for r in rows)


def test_jobs_side_by_side_stage_apart(spark):
    entered, done = threading.Barrier(2), threading.Barrier(2)
    seen = {}

    def job(name):
        with staging_scope(spark, name):
            entered.wait()
            table = stage(spark.range(5), "numbers")
            done.wait()
            seen[name] = (table.count(), table.inputFiles()[0])

    threads = [threading.Thread(target=job, args=(n,)) for n in ("one", "two")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert all(seen[n][0] == 5 and f"/{n}-" in seen[n][1] for n in ("one", "two"))


def test_one_local_folder_however_often_it_is_asked_for(spark, monkeypatch):
    made = []
    monkeypatch.setattr(staging.tempfile, "mkdtemp", lambda **kw: made.append(1) or "/tmp/never")
    monkeypatch.setattr(staging, "_local_root", [])
    if not spark.conf.get("spark.checkpoint.dir", None):
        assert {staging.shared_root(spark) for _ in range(5)} == {"/tmp/never"} and made == [1]


@pytest.mark.parametrize("name", ["members", "areas", "scores", "indicators_income", "ethnicity"])
def test_duplicates_in_lookups_fail_by_name(spark, name):
    s = sources(spark, SF)
    if name == "indicators_income":
        s.indicators = s.indicators | {"income": s.indicators["income"].union(s.indicators["income"])}
    else:
        df = getattr(s, name)
        setattr(s, name, df.union(df))
    with pytest.raises(Exception, match=f"{name}: more than one row"):
        index_plan.area_sums(s, index_plan.base(s)).collect()


def test_a_condition_may_have_any_name(spark, tmp_path):
    write_snapshot(spark.createDataFrame([(0, "x_raw"), (1, "x")], "place int, condition string"), f"{tmp_path}/conditions")
    assert jobs.conditions_of(spark, str(tmp_path)) == ["x_raw", "x"]


def test_extracts_with_a_missing_column(spark, tmp_path):
    write_csv(spark.createDataFrame([("a", 1, 2.5)], "k string, n int, v double"), f"{tmp_path}/one")
    write_csv(spark.createDataFrame([("b", 2)], "k string, n int"), f"{tmp_path}/two")
    both = read_csv_parts(spark, [f"{tmp_path}/one", f"{tmp_path}/two"], [(1, "k", "string"), (3, "v", "double")])
    assert as_set(both) == {("a", 2.5), ("b", None)}


def test_missing_text_survives_the_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", None), (None, 'say "hi", then'), ("c", "d")], "k string, v string")
    write_csv(df, f"{tmp_path}/text")
    assert as_set(read_csv_all(spark, f"{tmp_path}/text")) == {("a", None), (None, 'say "hi", then'), ("c", "d")}
    write_snapshots({"one": df, "two": df.limit(1)}, f"{tmp_path}/snap")
    assert as_set(read_snapshot(spark, f"{tmp_path}/snap/one")) == as_set(df)
    assert len(SCORES) == 16


@pytest.mark.parametrize("line", ["4", "5,6,7,8"])
@pytest.mark.parametrize("header", [True, False])
def test_ragged_lines_fail_with_their_file(spark, tmp_path, line, header):
    path = tmp_path / "ragged.csv"
    path.write_text("a,b,c\n1,,3\n" + line + "\n")
    readers = [lambda: read_csv(spark, str(path), [(1, "a", "string")], header=header)]
    if header:
        readers.append(lambda: read_csv_all(spark, str(path)).select("b"))
    for read in readers:
        with pytest.raises(Exception, match="ragged.csv"):
            read().collect()


def test_lists_follow_the_index_without_a_rebuild(spark, built):
    """Practices leave, come back and change: updated lists are those of all vectors at the old scale."""
    from peerlens.operators.neighbours import nearest_and_farthest

    out = f"{built}-updated"
    index = read_snapshot(spark, f"{built}/nn_data/practice")
    conditions = read_snapshot(spark, f"{built}/conditions")
    write_snapshot(conditions, f"{out}/conditions")
    gone = F.pmod(F.xxhash64("ORG_CODE"), F.lit(9)) == 0
    write_snapshots({"practice": index.where(~gone)}, f"{out}/nn_data")
    jobs.build_neighbours(spark, out, ["practice"])
    number = next(c for c, t in index.dtypes if t == "double" and c in similarity_features(jobs.conditions_of(spark, out)))
    moved = F.when(F.pmod(F.xxhash64("ORG_CODE"), F.lit(9)) == 1, F.col(number) * 2).otherwise(F.col(number))
    left = F.pmod(F.xxhash64("ORG_CODE"), F.lit(9)) == 2
    write_snapshots({"practice": index.where(~left).withColumn(number, moved)}, f"{out}/nn_data")
    done = jobs.update_neighbours(spark, out, ["practice"])["practice"]
    vectors = read_snapshot(spark, f"{out}/dist_lists/practice_vectors")
    assert vectors.count() == index.where(~left).count() and done.redone > 0
    want = as_set(rounded(nearest_and_farthest(vectors)))
    assert as_set(rounded(read_snapshot(spark, f"{out}/dist_lists/practice"))) == want
    assert jobs.update_neighbours(spark, out, ["practice"])["practice"].compared == 0


def test_sheets_and_attribute_tables_in_place_of_delimited_files(spark, paths, tmp_path):
    plain = load_sources(spark, paths)
    sheets, shapes = f"{tmp_path}/book", f"{tmp_path}/areas.dbf"
    names = ["parents", "members", *[f"indicators_{t}" for t in INDICATORS]]
    tables = {n: spark.read.option("header", True).option("nullValue", "NA").csv(paths[n]) for n in names}
    write_workbooks(tables, sheets, 300)
    areas = spark.read.option("header", True).option("nullValue", "NA").csv(paths["areas"])
    write_attributes(areas, shapes, [("LSOA11CD", "C", 12, 0), ("Shape__Are", "F", 24, 3)])
    read = load_sources(spark, paths | {n: Sheet(sheets, n) for n in names} | {"areas": shapes})
    pairs = [(plain.parents, read.parents), (plain.members, read.members), (plain.areas, read.areas)]
    pairs += [(plain.indicators[t], read.indicators[t]) for t in INDICATORS]
    for a, b in pairs:
        assert a.dtypes == b.dtypes
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
