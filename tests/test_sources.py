"""Catalog, scans, sinks and run tables."""

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import report, runs
from corpusloom.operators.mixture import catalog_table, count_per_source
from corpusloom.operators.select import every_nth, long_enough
from corpusloom.operators.tokens import ByteTokenizer, PluggedTokenizer
from corpusloom.plans import prepare as plan
from corpusloom.operators.select import latest_n, row_key
from corpusloom.plans.prepare import prepare, prepare_rows, prepare_summary
from corpusloom.session import new_folder, shared_folder
from corpusloom.sources import sinks
from corpusloom.sources.scan import build_corpus, scan, stored_bytes
from corpusloom.spec import SourceSpec, check_catalog, default_catalog

TEXT = "a text that is long enough"


@pytest.fixture
def good(spark, tmp_path):
    path = str(tmp_path / "good")
    spark.range(20).select(F.col("id"), F.lit(TEXT).alias("text")).repartition(2).write.parquet(path)
    return SourceSpec("good", path=path, key_columns=("id",))


def test_default_catalog():
    catalog = default_catalog("/data/")
    assert len(catalog) == 10 and sum(s.batch_cap for s in catalog) == 2_250_000
    assert 0.90 <= sum(s.weight for s in catalog) <= 1.0
    assert all(s.split and s.text_field and s.batch_cap > 0 and isinstance(s.streaming, bool) for s in catalog)
    by_name = {s.name: s for s in catalog}
    web, math, chat = (by_name[n] for n in ("HuggingFaceFW/fineweb-edu", "openai/gsm8k", "HuggingFaceH4/ultrachat_200k"))
    assert (web.config, web.text_field, web.streaming, web.path) == ("sample-10BT", "text", True, f"/data/{web.name}")
    assert (math.text_field, math.answer_field, math.format) == ("question", "answer", "reasoning")
    assert (chat.text_field, chat.split) == ("messages", "train_sft")


def test_spec_from_mapping():
    spec = SourceSpec.from_mapping({"name": "org/set", "config": None, "text_field": "content", "max_samples": 7})
    assert (spec.split, spec.streaming, spec.format, spec.batch_cap) == ("train", False, "text", 7)
    with pytest.raises(ValueError, match="unknown source keys"):
        SourceSpec.from_mapping({"name": "x", "colour": "red"})


@pytest.mark.parametrize(
    "bad", [{"name": ""}, {"name": "a|b"}, {"text_field": ""}, {"streaming": 1}, {"weight": -1}, {"max_samples": -1},
            {"max_samples": 1.5}, {"max_samples": True}]
)
def test_bad_specs(bad):
    with pytest.raises(ValueError):
        SourceSpec(**{"name": "x", **bad})


def test_names_are_unique():
    with pytest.raises(ValueError, match="unique"):
        check_catalog([SourceSpec("a"), SourceSpec("a")])


@pytest.mark.parametrize("reader,options", [("parquet", {}), ("json", {}), ("csv", {"header": "true"}), ("orc", {})])
def test_readers(spark, tmp_path, reader, options):
    path = str(tmp_path / reader)
    spark.range(3).select(F.lit(TEXT).alias("text")).write.format(reader).options(**options).save(path)
    spec = SourceSpec("s", path=path, reader=reader, reader_options=options)
    assert [r.text for r in scan(spark, spec).collect()] == [TEXT] * 3


def test_text_reader(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.createDataFrame([(TEXT,), ("too short"[:5],)], "value string").write.text(path)
    spec = SourceSpec("s", path=path, reader="text", text_field="value")
    assert [r.text for r in build_corpus(spark, [spec]).rows.collect()] == [TEXT]


def test_subset_and_split_prune_partitions(spark, tmp_path, capsys):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame(
        [(TEXT, "de", "train"), (TEXT, "de", "test"), (TEXT, "en", "train")], "text string, lang string, split string"
    )
    rows.write.partitionBy("lang", "split").parquet(path)
    spec = SourceSpec("s", config="de", path=path, subset_column="lang", split_column="split")
    assert scan(spark, spec).count() == 1
    scan(spark, spec).explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(lang" in plan
    with pytest.raises(ValueError, match="no column 'dialect'"):
        scan(spark, SourceSpec("s", config="de", path=path, subset_column="dialect"))


def test_missing_source_is_left_out(spark, good, tmp_path):
    missing = SourceSpec("missing", path=str(tmp_path / "none"))
    no_path, bad_key = SourceSpec("no path"), SourceSpec("bad key", path=good.path, key_columns=("nope",))
    corpus = build_corpus(spark, [missing, good, no_path, bad_key], tolerant=True)
    assert set(corpus.failed) == {"missing", "no path", "bad key"}
    assert corpus.rows.groupBy("source").count().collect() == [("good", 20)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        build_corpus(spark, [missing, good])
    with pytest.raises(ValueError, match="no source could be opened"):
        build_corpus(spark, [missing], tolerant=True)


def test_source_that_breaks_while_counted_is_left_out(spark, good):
    broken = SourceSpec("broken", key_columns=("id",))
    rows = spark.range(5).where(F.raise_error(F.lit("bad row")).isNull()).withColumn("text", F.lit(TEXT))
    corpus = build_corpus(spark, [broken, good], {"broken": rows}, tolerant=True)
    assert set(corpus.failed) == {"broken"} and corpus.rows.count() == 20
    with pytest.raises(Exception, match="bad row"):
        build_corpus(spark, [broken, good], {"broken": rows}, tolerant=False)


def test_damaged_file_keeps_the_other_rows(spark, good, tmp_path):
    (tmp_path / "good" / "part-bad.parquet").write_bytes(b"PAR1 this is not parquet PAR1")
    specs = [good]
    assert build_corpus(spark, specs, tolerant=True).rows.count() == 20
    with pytest.raises(Exception):
        build_corpus(spark, specs).rows.count()


def test_no_rows_is_an_error(spark, good):
    rows = spark.createDataFrame([(1, "short")], "id long, text string")
    with pytest.raises(ValueError, match="no source gave any rows"):
        build_corpus(spark, [good], {"good": rows}).require_rows()


def test_duplicates_are_kept_and_counted(spark, good):
    other = SourceSpec("other", path=good.path, key_columns=("id",), max_samples=5)
    rows = build_corpus(spark, [good, other]).rows
    catalog = catalog_table(spark, [good, other, SourceSpec("none")])
    counts = {r.source: r.rows for r in count_per_source(rows, catalog).collect()}
    assert counts == {"good": 20, "other": 5, "none": 0}
    assert report.count_rows(rows).first().rows == 25


def test_only_needed_columns_are_read(spark, tmp_path, capsys):
    path = str(tmp_path / "wide")
    spark.range(3).selectExpr("id", "'some longer text' text", "id a", "id b").write.parquet(path)
    build_corpus(spark, [SourceSpec("s", path=path, key_columns=("id",), max_samples=None)]).rows.explain()
    assert "ReadSchema: struct<id:bigint,text:string>" in capsys.readouterr().out


def test_stage_writes_once(spark):
    folder, calls = new_folder(spark, "stage"), spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            calls.add(len(frame))
            yield frame

    rows = spark.range(10).mapInPandas(count, "id long")
    assert sinks.stage(rows, folder, "t").count() == 10
    assert sinks.stage(rows, folder, "t").count() == 10 and calls.value == 10
    assert sinks.stage(rows, folder, "t", refresh=True).count() == 10 and calls.value == 20


def test_half_written_stage_is_written_again(spark):
    folder = new_folder(spark, "stage")
    spark.range(3).write.parquet(f"{folder}/t/rows")
    assert sinks.stage(spark.range(10), folder, "t").count() == 10


def test_history_entries_replace_themselves(spark):
    path = new_folder(spark, "history")
    assert sinks.read_history(spark, path, runs.PUBLISH_RECORD).count() == 0
    record = spark.sql("select 5L step, true success, timestamp'2024-01-01' timestamp, 0.5D loss")
    for entry in ("step-5", "step-5", "step-6"):
        sinks.append_history(record, path, entry)
    got = sinks.read_history(spark, path, runs.PUBLISH_RECORD)
    assert sorted(r.entry for r in got.collect()) == ["step-5", "step-6"]


def test_publish_excludes_and_retries(spark, monkeypatch):
    root, rows = new_folder(spark, "publish"), spark.range(3).selectExpr("id", "id optimizer", "id scheduler")
    assert sinks.publish_snapshot(rows, root, "v1", exclude=["optimizer", "scheduler", "rng"])
    assert sinks.read_snapshot(spark, root).columns == ["id"]
    waits = []
    monkeypatch.setattr(sinks, "sleep", waits.append)
    broken = rows.select(F.raise_error(F.lit("disk full")).alias("id"))
    assert not sinks.publish_snapshot(broken, root, "v2")
    assert waits == [5.0, 5.0]
    manifest = {r.version: r for r in sinks.read_history(spark, f"{root}/manifest", sinks.MANIFEST).collect()}
    assert manifest["v1"].attempts == 1 and manifest["v2"].attempts == 3 and not manifest["v2"].success
    assert sinks.read_snapshot(spark, root).count() == 3
    with pytest.raises(ValueError, match="no published version"):
        sinks.read_snapshot(spark, root, "v2")
    assert not sinks.publish_snapshot(broken, root, "v1", delay=0)
    assert sinks.read_snapshot(spark, root, "v1").count() == 3
    for version, n in (("step-9000", 4), ("step-10000", 5)):
        assert sinks.publish_snapshot(spark.range(n), root, version)
    assert sinks.read_snapshot(spark, root).count() == 5 and sinks.read_snapshot(spark, root, "step-9000").count() == 4


def test_folder_snapshot_leaves_out_files(spark, tmp_path, monkeypatch):
    from hashlib import sha256

    folder, held = tmp_path / "step 10", {"model.bin": b"\x00\xff" * 9, "part/a.txt": b"a", "part/optimizer.txt": b"x"}
    left = {"part/empty.txt": b"", "optimizer.pt": b"o", "scheduler.pt": b"s", "part/rng_state_3.pth": b"r"}
    for name, content in {**held, **left}.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(content)
    root, exclude = new_folder(spark, "snapshots"), ["optimizer.pt", "scheduler.pt", "rng_state*.pth"]
    rows = sinks.folder_rows(spark, str(folder), exclude)
    assert sinks.publish_snapshot(rows, root, "step-10")
    got = {r.file: r for r in sinks.read_snapshot(spark, root, "step-10").collect()}
    assert {f: bytes(r.content) for f, r in got.items()} == held
    assert all(r.length == len(held[f]) and r.sha256 == sha256(held[f]).hexdigest() for f, r in got.items())
    assert sinks.folder_rows(spark, str(folder), ["*"]).count() == 0
    assert {r.file for r in sinks.folder_rows(spark, str(folder) + "/", ["part/*"]).collect()} == {"model.bin", "optimizer.pt", "scheduler.pt"}
    monkeypatch.setattr(sinks, "MAX_FILE", 10)
    with pytest.raises(ValueError, match="model.bin has 18 bytes"):
        sinks.folder_rows(spark, str(folder))


def test_row_keys_tell_keys_apart(spark):
    pairs = [("a:b", "c"), ("a", "b:c"), (None, "x"), ("None", "x"), ("\\N", "x"), ("a\\", ":x"), ("a", "\\:x")]
    keys = spark.createDataFrame(pairs, "p string, q string").select(row_key(("p", "q")).alias("k"))
    assert keys.distinct().count() == len(pairs)


def test_prepare_tells_what_it_left_out(spark):
    rows = spark.range(20).selectExpr("id", "repeat('word ', 20) text")
    good, wrong = SourceSpec("good", key_columns=("id",)), SourceSpec("wrong", key_columns=("idd",))
    tables = {"good": rows, "wrong": rows}
    with pytest.raises(ValueError, match="key columns not found"):
        prepare(spark, [good, wrong], ByteTokenizer(), new_folder(spark, "corpus"), tables)
    path = new_folder(spark, "corpus")
    assert prepare(spark, [good, wrong], ByteTokenizer(), path, tables, tolerant=True).count() == 20
    got = {r.source: r for r in prepare_summary(spark, path).collect()}
    assert (got["good"].rows, got["good"].error, got["wrong"].rows) == (20, None, 0)
    assert "key columns not found" in got["wrong"].error


def test_latest_n_is_limited_before_the_exchange(spark):
    plan = latest_n(spark.range(5_000).selectExpr("id % 2 run", "id step"), "run", "step", 1_500)
    assert "WindowGroupLimit" in plan._jdf.queryExecution().toString()


def test_prepare_end_to_end(spark, good, capsys):
    rows = spark.range(2_000).select("id", F.concat(F.lit(TEXT + " "), F.col("id").cast("string")).alias("text"))
    path = new_folder(spark, "corpus")
    written = prepare(spark, [good], ByteTokenizer(), path, {"good": rows}, min_tokens=10)
    counts = {r.split: r.rows for r in report.count_split(written).collect()}
    assert sum(counts.values()) == 2_000 and 5 <= counts["test"] <= 40
    assert written.where("split = 'test'").count() == counts["test"]
    corpus = build_corpus(spark, [good], {"good": rows}).rows
    capsys.readouterr()
    prepare_rows(corpus, ByteTokenizer()).explain()
    assert capsys.readouterr().out.count("Exchange") == 1


def test_shuffle_width_follows_the_files(spark, good, monkeypatch, tmp_path):
    size = sum(f.stat().st_size for f in (tmp_path / "good").glob("*.parquet"))
    assert stored_bytes(spark, [good, SourceSpec("no path"), SourceSpec("gone", path=str(tmp_path / "gone"))]) >= size > 0
    assert plan.shuffle_width(spark, [good]) == 8
    monkeypatch.setattr(plan, "PARTITION_BYTES", size / 10)
    assert plan.shuffle_width(spark, [good]) >= 30


def test_widths_follow_the_kept_rows(spark, good, monkeypatch):
    rows = spark.range(4_000).select("id", F.concat(F.lit(TEXT), F.col("id").cast("string")).alias("text"))
    folder = new_folder(spark, "stored")
    rows.write.parquet(folder)
    monkeypatch.setattr(plan, "PARTITION_BYTES", 5_000)
    widths = []
    monkeypatch.setattr(plan, "prepare_rows", lambda *a, partitions, **o: widths.append(partitions) or prepare_rows(*a, partitions=partitions, **o))
    stored = SourceSpec("stored", path=folder, key_columns=("id",))
    half = SourceSpec("half", key_columns=("id",), max_samples=2_000)
    prepare(spark, [stored], ByteTokenizer(), new_folder(spark, "corpus"))
    prepare(spark, [stored], ByteTokenizer(), new_folder(spark, "corpus"), {"stored": rows})
    prepare(spark, [half], ByteTokenizer(), new_folder(spark, "corpus"), {"half": rows})
    size = rows.agg(F.sum(F.octet_length(F.trim("text")))).first()[0]
    assert widths[0] == widths[1] == -(-size // 5_000) > 2 * 8
    assert abs(widths[2] - widths[0] / 2) <= 1
    prepare(spark, [stored], ByteTokenizer(), new_folder(spark, "corpus"), measured=False)
    assert widths[3] == plan.shuffle_width(spark, [stored])
    with pytest.raises(ValueError, match="no source gave any rows"):
        prepare(spark, [half], ByteTokenizer(), new_folder(spark, "corpus"), {"half": rows.where("id < 0")})


@pytest.mark.parametrize("plugged", [False, True])
def test_batches_are_sized_by_their_rows(spark, good, monkeypatch, plugged):
    tokenizer = PluggedTokenizer(lambda: lambda texts: [[*text.encode()] for text in texts]) if plugged else ByteTokenizer()
    widths = {}
    for count in (400, 4_000):
        rows = spark.range(count).select("id", F.concat(F.lit(TEXT), F.col("id").cast("string")).alias("text"))
        corpus = build_corpus(spark, [good], {"good": rows}).rows
        monkeypatch.setattr(plan, "PARTITION_BYTES", 2_000)
        batches = plan.batch_rows(corpus, tokenizer, 50, min_tokens=1)
        assert batches.groupBy("batch_id").count().where("count != 50").isEmpty() and batches.count() == count
        widths[count] = plan.measured_width(corpus)
        exchange = "hashpartitioning(batch_id#"
        text = batches._jdf.queryExecution().executedPlan().toString()
        assert text.count(exchange) == 1 and f", {widths[count]})" in text.split(exchange)[1].split("\n")[0]
    assert widths[4_000] > 5 * widths[400]


def test_plugged_tokens_keep_the_shuffled_order(spark, good):
    rows = spark.range(200).select("id", F.concat(F.lit(TEXT), F.col("id").cast("string")).alias("text"))

    def load():
        return lambda texts: [[1, *[b + 3 for b in text.encode()]] for text in texts]

    native, plugged = (
        prepare(spark, [good], tokenizer, new_folder(spark, "corpus"), {"good": rows}, min_tokens=1, partitions=1)
        .where("split = 'train'").select("row_key", "input_ids").collect()
        for tokenizer in (ByteTokenizer(), PluggedTokenizer(load))
    )
    assert native == plugged


def test_written_rows_keep_the_shuffled_order(spark, good):
    from corpusloom.operators.order import shuffle_seeded

    rows = spark.range(500).select("id", F.lit(TEXT).alias("text"))
    written = prepare(spark, [good], ByteTokenizer(), new_folder(spark, "corpus"), {"good": rows}, min_tokens=1,
                      partitions=1)
    order = [r.row_key for r in shuffle_seeded(build_corpus(spark, [good], {"good": rows}).rows).collect()]
    train = [r.row_key for r in written.where("split = 'train'").collect()]
    assert train == [k for k in order if k in set(train)]


def test_observe_and_measure(spark):
    from pyspark.sql import Observation

    rows, seen = spark.createDataFrame([("short",), (TEXT,), (None,)], "text string"), Observation()
    kept = report.observe_filter(rows, long_enough(F.col("text")), seen)
    assert kept.count() == 1 and seen.get == {"scanned": 3, "kept": 1, "rejected": 2}
    assert report.measure(rows, "t")["rows"] == 3


def test_step_budget(spark):
    rows = spark.range(1_000).select(F.when(F.col("id") < 10, "test").otherwise("train").alias("split"))
    got = report.step_budget(rows, 8, 16, 0, 100).first()
    assert (got.train_rows, got.effective_batch, got.steps_per_epoch, got.epochs) == (990, 128, 7, 14.2857)


def test_run_tables(spark):
    metrics = spark.createDataFrame(
        [("a", 10, 0.5, True), ("a", 25, 0.25, False), ("b", 20, None, True)], "run string, step long, loss double, success boolean"
    )
    assert {r.run: r.loss for r in runs.last_metric(metrics).collect()} == {"a": 0.25, "b": 0.0}
    outcome = {r.run: r[1:] for r in runs.publish_outcomes(metrics).collect()}
    assert outcome == {"a": (2, 1, 25, False), "b": (1, 1, 20, True)}
    assert sorted(r.step for r in every_nth(metrics, "step", 10).collect()) == [10, 20]


def test_latest_checkpoint(spark):
    names = ["checkpoint-5", "checkpoint-10", "x/checkpoint-7", "final_model", "checkpoint-x", "checkpoint-9.bak"]
    listing = runs.with_step(spark.createDataFrame([("a", n) for n in names] + [("b", "checkpoint-1")], "run string, path string"))
    assert sorted(r.step for r in listing.where("step is not null").collect()) == [1, 5, 7, 10]
    final = spark.createDataFrame([("a", "final_model")], "run string, path string")
    assert {r.run: r.path for r in runs.latest_checkpoint(listing, final).collect()} == {"a": "final_model", "b": "checkpoint-1"}
    chosen = spark.createDataFrame([("a", "checkpoint-5"), ("b", "checkpoint-99")], "run string, path string")
    assert {r.run: r.path for r in runs.latest_checkpoint(listing).collect()} == {"a": "checkpoint-10", "b": "checkpoint-1"}
    assert {r.run: r.path for r in runs.latest_checkpoint(listing, chosen).collect()} == {"a": "checkpoint-5", "b": "checkpoint-1"}


def test_shared_folder_is_the_sessions(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
