import json
from pathlib import Path

import pytest

from termscope.sources import reviews as src
from termscope.sources import storage
from termscope.sources.report import write_dictionary, write_json, write_terms, write_text

GOOD = {
    "category": "Lamps", "reviewText": "Warm light; the switch clicks.", "overall": 3.5,
    "reviewerID": "R-77", "asin": "L900", "helpful": [2, 3], "unixReviewTime": 1400000000,
}

BAD_LINES = [
    "{broken",
    "",
    "   ",
    "123",
    '"text"',
    "null",
    '[{"category":"a","reviewText":"b"}]',
    '{"category":"a","reviewText":"b"',
    '{"category":"a","reviewText":"b"} junk',
    '{"category":"a","reviewText":"b"} {"x":1}',
    '{"category":"a","reviewText":"b"},{"category":"a","reviewText":"b"}',
    "{'category':'a','reviewText':'b'}",
    '{"category":"a","reviewText":"b"}] junk',
    '{"category":"a","reviewText":"b"}],[{"category":"x"}',
    '{"category":"a","reviewText":"b"},',
]
INCOMPLETE_LINES = [
    '{"category":null,"reviewText":"b"}',
    '{"reviewText":"b"}',
    '{"category":"a","reviewText":""}',
    "{}",
]
GOOD_LINES = [
    json.dumps(GOOD),
    '{"category":"a","reviewText":"mistyped field nobody reads","overall":"five"}',
    '  {"category":"é","reviewText":"blank edges"}  ',
]


@pytest.fixture
def lines(spark):
    rows = [(v,) for v in BAD_LINES + INCOMPLETE_LINES + GOOD_LINES]
    return spark.createDataFrame(rows, "value string")


def test_malformed_and_incomplete_lines_are_dropped(lines):
    parsed = src.parse_reviews(lines)
    assert parsed.count() == len(INCOMPLETE_LINES) + len(GOOD_LINES)
    valid = {(r.category, r.reviewText) for r in src.required_fields(parsed).collect()}
    assert valid == {
        ("Lamps", "Warm light; the switch clicks."),
        ("a", "mistyped field nobody reads"),
        ("é", "blank edges"),
    }


def test_load_quality_counts_every_line(lines):
    row = src.load_quality(lines).first()
    assert (row.lines, row.malformed, row.incomplete, row.valid) == (
        len(BAD_LINES) + len(INCOMPLETE_LINES) + len(GOOD_LINES),
        len(BAD_LINES),
        len(INCOMPLETE_LINES),
        len(GOOD_LINES),
    )


def test_scan_of_several_files(spark, tmp_path):
    paths = []
    for i in range(4):
        path = tmp_path / f"part_{i}.json"
        path.write_text(f'{{"category":"c{i}","reviewText":"t"}}\n{{broken\n')
        paths.append(str(path))
    got = src.load_documents(spark, paths)
    assert sorted(r.category for r in got.collect()) == ["c0", "c1", "c2", "c3"]


def test_all_fields_can_be_scanned(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text(json.dumps(GOOD) + "\n")
    row = src.scan_reviews(spark, str(path), src.REVIEW_SCHEMA.fieldNames()).first()
    assert (row.asin, row.overall, row.summary, row.helpful) == ("L900", 3.5, None, [2, 3])


def test_file_order_survives_many_splits(spark, tmp_path):
    path = tmp_path / "many.txt"
    path.write_text("".join(f"line {i}\n" for i in range(2000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = src.read_ordered_lines(spark, str(path))
        assert lines.rdd.getNumPartitions() > 3
        head = src.sample_head(lines, n=50).collect()
        shards = src.round_robin_shards(src.number_lines(spark, str(path))).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.value for r in head] == [f"line {i}" for i in range(50)]
    assert {(r.value, r.shard) for r in shards} == {(f"line {i}", i % 4) for i in range(2000)}


def _lines_read(spark):
    """Records that all tasks so far have read."""
    stages = spark._jsc.sc().statusStore().stageList(None, False, False, spark._sc._gateway.new_array(spark._jvm.double, 0), None)
    return sum(stages.apply(i).inputRecords() for i in range(stages.size()))


@pytest.mark.parametrize("n", [1, 40, 700])
def test_the_head_of_files_is_read_without_the_rest(spark, tmp_path, n):
    """Of 12,000 lines in dozens of splits, those wanted and at most some splits."""
    for name, lines in (("b", 6000), ("a", 10), ("c", 6000)):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name} {i:05d}\n" for i in range(lines)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        read = _lines_read(spark)
        head = src.head_lines(spark, str(tmp_path), n).collect()
        read = _lines_read(spark) - read
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = [f"a {i:05d}" for i in range(10)] + [f"b {i:05d}" for i in range(6000)]
    assert [r.value for r in head] == expected[:n]
    assert read <= 6 * n + 600


def test_the_head_of_few_lines_is_all_of_them(spark, tmp_path):
    (tmp_path / "x.txt").write_text("one\ntwo\n")
    (tmp_path / "w.txt").write_text("")
    paths = [str(tmp_path / "x.txt"), str(tmp_path / "w.txt")]
    assert [r.value for r in src.head_lines(spark, paths, 10).collect()] == ["one", "two"]


def test_lines_are_numbered_across_files(spark, tmp_path):
    for name, n in (("b", 30), ("a", 7), ("c", 0), ("d", 3)):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{i}\n" for i in range(n)))
    got = {r.line: r.value for r in src.number_lines(spark, str(tmp_path)).collect()}
    expected = [f"{name}{i}" for name, n in (("a", 7), ("b", 30), ("d", 3)) for i in range(n)]
    assert got == {i + 1: v for i, v in enumerate(expected)}
    plan = src.number_lines(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    moved = "".join(x for x in plan.splitlines() if "Exchange hashpartitioning" in x)
    assert "value" not in moved


def test_keyed_documents_have_unique_ids(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text('{"category":"a","reviewText":"same"}\n' * 30)
    docs = src.load_keyed_documents(spark, str(path))
    assert docs.select("doc_id").distinct().count() == 30


def test_keys_do_not_depend_on_the_splits(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text("".join(f'{{"category":"a","reviewText":"text {i}"}}\n' for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = []
    try:
        for size in ("3000", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = src.load_keyed_documents(spark, str(path)).collect()
            found.append({r.doc_id: r.reviewText for r in rows})
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found[0] == found[1] and len(found[0]) == 3000
    assert {k.rsplit(":", 1)[1]: v for k, v in found[0].items()}["17"] == "text 16"


def test_tables_made_on_the_way_are_removed(spark):
    stored = storage.stored(spark.range(3), "gone")
    path = storage._written[-1]
    assert stored.count() == 3
    storage.remove_written()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_shards_written_and_read_back(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "concat('c', id) category", "'t' reviewText")
    sharded = src.round_robin_shards(src.number_rows(df, ["id"]))
    paths = src.write_shards(sharded, str(tmp_path / "s"), ["category", "reviewText"])
    assert sorted(r.category for r in src.load_documents(spark, paths[1]).collect()) == ["c1", "c5", "c9"]
    assert src.load_documents(spark, paths).count() == 10


def test_text_sinks(spark, tmp_path):
    df = spark.range(200).selectExpr("format_string('w%03d', id) term").repartition(5).orderBy("term")
    write_terms(df, str(tmp_path / "terms"))
    write_dictionary(df, str(tmp_path / "dict"))
    write_text(spark.createDataFrame([("one line",)], "line string"), str(tmp_path / "text"))
    write_json(spark.createDataFrame([(1, 0.5)], "k int, f1 double"), str(tmp_path / "json"))

    def read(name):
        parts = sorted((tmp_path / name).glob("part-*"))
        return "".join(p.read_text() for p in parts)

    expected = [f"w{i:03d}" for i in range(200)]
    assert read("terms").split("\n")[:-1] == expected
    assert read("dict").split(" ")[:-1] == expected and "\n" not in read("dict")
    assert read("text") == "one line\n"
    assert json.loads(read("json")) == {"k": 1, "f1": 0.5}


def test_shared_folder_is_read_from_the_session(spark):
    assert storage.new_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_spread_leaves_wide_inputs_alone(spark):
    wide = spark.range(0, 100, 1, 4)
    assert storage.spread(wide) is wide
    assert storage.spread(spark.range(0, 100, 1, 1), "id").rdd.getNumPartitions() == 4


def test_scratch_tables_go_and_others_stay(spark):
    def files():
        root = Path(storage.shared_dir(spark).removeprefix("file:"))
        return {p.name for p in root.iterdir() if p.name.startswith("probe")}

    storage.stored(spark.range(3), "probe-before")
    with storage.scratch():
        inside = storage.stored(spark.range(4), "probe-inside")
        with storage.scratch():
            storage.stored(spark.range(5), "probe-inner")
        assert {n.split("-")[1] for n in files()} == {"before", "inside"} and inside.count() == 4
    assert {n.split("-")[1] for n in files()} == {"before"}


def test_kept_tables_belong_to_the_scope_around(spark):
    def files():
        root = Path(storage.shared_dir(spark).removeprefix("file:"))
        return {p.name.split("-")[1] for p in root.iterdir() if p.name.startswith("kept-")}

    with storage.scratch() as outer:
        with storage.scratch() as keep:
            storage.stored(spark.range(4), "kept-gone")
            kept = keep(spark.range(5), "kept-inner")
            assert files() == {"gone", "inner"}
        assert files() == {"inner"}
        last = outer(kept.where("id < 2"), "kept-last")
    assert files() == {"last"} and last.count() == 2


def test_shuffle_files_go_once_a_table_is_stored(tmp_path):
    import subprocess
    import sys

    code = f"""
import os, time
from pyspark.sql import SparkSession
from termscope.sources.storage import scratch, stored
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.local.dir", "{tmp_path}/local").config("spark.sql.shuffle.partitions", 2)
         .config("spark.checkpoint.dir", "{tmp_path}/shared").getOrCreate())
def files():
    return sum(f.endswith(".data") for _, _, own in os.walk("{tmp_path}/local") for f in own)
counts = spark.range(100).groupBy("id").count()
with scratch(clean=True):
    assert stored(counts, "a").count() == 100
    before = files()
    for _ in range(50):
        stored(counts, "b")
    for _ in range(100):
        if files() <= before + 2:
            break
        time.sleep(0.1)
    assert files() <= before + 2, (before, files())
name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
assert spark.conf.get(name, "false") == "false"
"""
    root = Path(src.__file__).parents[2]
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_nothing_stays_behind_after_a_stopped_session(tmp_path):
    """Spark keeps its own folder there; no table of ours is left when a process ends."""
    import subprocess
    import sys

    code = f"""
from pyspark.sql import SparkSession
from termscope.sources.storage import stored
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", "{tmp_path}").getOrCreate())
assert stored(spark.range(7), "kept").count() == 7
spark.stop()
"""
    root = Path(src.__file__).parents[2]
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert not list(tmp_path.glob("kept-*"))
