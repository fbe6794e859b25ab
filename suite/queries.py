"""One query per operator, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.render import render_text
from corpusloom.functions.text import WHITESPACE, last_split, strip, stripped_length
from corpusloom.operators import batches, mixture, order, report, runs
from corpusloom.operators.select import every_nth, latest_n, long_enough, row_key, text_rows
from corpusloom.operators.tokens import (
    ByteTokenizer,
    PluggedTokenizer,
    VocabTokenizer,
    build_vocabulary,
    map_batches,
    tokenize,
)
from corpusloom.plans.isolate import collect_sources, source_manifest
from corpusloom.plans.prepare import batch_rows, prepare, prepare_summary
from corpusloom.session import new_folder
from corpusloom.sources import damage, sinks
from corpusloom.sources.scan import build_corpus, scan, scan_stream, union_sources
from corpusloom.spec import SourceSpec
from corpusloom.streaming import prepare as streams
from suite import sources as src

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

BATCH_SIZE = 8
MIXTURE_BUDGET = 500
LANGUAGE_CAPS = {"en": 500, "de": 128, "fr": 100, "es": 92}
DOCUMENTS = SourceSpec("documents", key_columns=("doc_id",), max_samples=None)


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def _joined(column: str) -> Column:
    return F.array_join(column, ",").alias(column)


def _rendered(rows: DataFrame, spec: SourceSpec) -> DataFrame:
    return rows.select(*spec.key_columns, render_text(rows, spec).alias("text"))


def _file_spec(spec: SourceSpec, sf_dir: str, name: str, **changes: object) -> SourceSpec:
    return replace(spec, path=f"{sf_dir}/{name}.parquet", **changes)


# Sources, scans, sinks


@query
def scan_batch(spark, sf_dir):
    rows = scan(spark, _file_spec(DOCUMENTS, sf_dir, "documents"))
    return rows.select("doc_id", "lang", "source", "n_chars", "text")


@query
def scan_lazy_capped(spark, sf_dir):
    spec = replace(src.spec("code"), max_samples=200)
    return text_rows(scan(spark, _file_spec(spec, sf_dir, "pages")), spec)


@query
def scan_damage(spark, sf_dir):
    folder, documents = new_folder(spark, "damage"), src.table(spark, sf_dir, "documents")
    documents.repartition(3).write.parquet(folder)
    documents.limit(5).select("lang").coalesce(1).write.mode("append").text(folder)
    found = damage.scan_damage(spark, SourceSpec("documents", path=folder), documents.schema)
    return found.groupBy("state").agg(
        F.count(F.lit(1)).alias("files"), *[F.sum(c).alias(c) for c in ("expected", "read", "lost")]
    )


@query
def scan_cached(spark, sf_dir):
    """The second read is from the stage; the third sees the files that came in between."""
    folder, cache = new_folder(spark, "files"), sinks.ScanCache(spark, new_folder(spark, "cache"))
    documents = src.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    for part in ("lang = 'en'", "lang <> 'en'"):
        documents.where(part).write.mode("append").parquet(folder)
        for _ in range(2):
            rows = cache.rows(spark.read.schema(documents.schema).parquet(folder))
    return rows.withColumn("stages", F.lit(len(cache.used)).cast("long"))


@query
def checkpoint_folders(spark, sf_dir):
    root, metrics = new_folder(spark, "runs"), src.run_metrics(spark, sf_dir).where("run < 3")
    for row in latest_n(metrics, "run", "step", 2).select("run", "step").collect():
        steps = metrics.where((F.col("run") == row.run) & (F.col("step") == row.step)).select("loss").coalesce(1)
        steps.write.parquet(f"{root}/{row.run}/checkpoint-{row.step}")
        if row.run == 0:
            steps.write.mode("overwrite").parquet(f"{root}/{row.run}/checkpoint-none")
    latest = runs.latest_checkpoint(runs.list_checkpoints(spark, root))
    return latest.select("run", F.substring_index("path", "/", -2).alias("path"))


@query
def corpus_isolated(spark, sf_dir):
    documents = src.table(spark, sf_dir, "documents")
    bad = F.when(F.col("doc_id") == 7, F.raise_error(F.lit("bad row"))).otherwise(F.col("text"))
    specs = [SourceSpec(f"web_{lang}", config=lang, subset_column="lang", max_samples=None) for lang in LANGUAGE_CAPS]
    opened = {s.name: documents for s in specs} | {"broken": documents.withColumn("text", bad)}
    folder = new_folder(spark, "sources")
    collect_sources(spark, [*specs, SourceSpec("broken", max_samples=None, key_columns=("doc_id",))], folder, opened)
    told = source_manifest(spark, folder)
    return told.select("source", "rows", F.contains("error", F.lit("bad row")).alias("bad_row"))


@query
def corpus_versions(spark, sf_dir):
    """Of three writes the second breaks; readers see the last whole one."""
    path, rows = new_folder(spark, "corpus"), order.split_hash(src.document_rows(spark, sf_dir)).select("source", "row_key", "split")
    sinks.write_corpus(rows.limit(3), path)
    sinks.write_corpus(rows, path)
    try:
        sinks.write_corpus(rows.withColumn("source", F.raise_error(F.lit("disk full")).cast("string")), path)
    except PySparkException:
        return sinks.read_corpus(spark, path)
    raise AssertionError("the broken write went through")


@query
def scan_subset_de(spark, sf_dir):
    return scan(spark, _file_spec(src.spec("web_de"), sf_dir, "documents")).select("doc_id", "lang", "text")


@query
def corpus_union(spark, sf_dir):
    return build_corpus(spark, src.catalog(), src.tables(spark, sf_dir), tolerant=False).rows


@query
def scan_tolerant(spark, sf_dir):
    missing = replace(DOCUMENTS, name="missing", path=f"{sf_dir}/no-such-table.parquet")
    corpus = build_corpus(spark, [missing, _file_spec(DOCUMENTS, sf_dir, "documents")], tolerant=True)
    failed = spark.createDataFrame([(name,) for name in corpus.failed], "source string")
    return corpus.rows.select("source", "row_key", "text").unionByName(
        failed.select("source", F.lit("").alias("row_key"), F.lit("left out").alias("text"))
    )


@query
def scan_staged(spark, sf_dir):
    folder = new_folder(spark, "staged")
    rows = text_rows(src.table(spark, sf_dir, "documents"), DOCUMENTS)
    sinks.stage(rows, folder, "documents")
    return sinks.stage(rows, folder, "documents")


@query
def corpus_write(spark, sf_dir):
    path = new_folder(spark, "corpus")
    written = prepare(spark, src.catalog(), ByteTokenizer(), path, src.tables(spark, sf_dir))
    return written.select("source", "row_key", "split", F.size("input_ids").alias("n_tokens"))


@query
def run_history_append(spark, sf_dir):
    path = new_folder(spark, "history")
    metrics = src.run_metrics(spark, sf_dir)
    model = F.struct(
        F.lit("base").alias("model_name"), F.lit(2048).alias("hidden_size"), F.lit(22).alias("num_layers"),
        F.lit(1_000_000_000).cast("long").alias("num_params"),
    )
    records = metrics.select(
        "step", (F.col("step") / 1000).alias("epoch"), "loss", "timestamp", model.alias("model_config"), "success"
    )
    for entry, wanted in (("good", True), ("bad", False), ("good", True)):
        sinks.append_history(records.where(F.col("success") == wanted).drop("success"), path, entry)
    history = sinks.read_history(spark, path, runs.RUN_RECORD)
    return history.select("step", "epoch", "loss", "timestamp", "model_config.model_name", "model_config.num_params", "entry")


@query
def corpus_summary(spark, sf_dir):
    path, missing = new_folder(spark, "corpus"), SourceSpec("missing", path=f"{sf_dir}/none", max_samples=None)
    specs = [missing, _file_spec(DOCUMENTS, sf_dir, "documents")]
    prepare(spark, specs, ByteTokenizer(), path, tolerant=True)
    return prepare_summary(spark, path).select("source", "rows", F.col("error").isNotNull().alias("left_out"))


@query
def snapshot_publish(spark, sf_dir):
    root = new_folder(spark, "snapshots")
    documents = src.table(spark, sf_dir, "documents")
    sinks.publish_snapshot(documents, root, "step-9000", exclude=["n_chars", "source"])
    sinks.publish_snapshot(documents, root, "step-10000", exclude=["n_chars", "lang"])
    sinks.publish_snapshot(documents, root, "step-10000", exclude=["n_chars"])
    return sinks.read_snapshot(spark, root)


# Rendering


@query
def snapshot_folder(spark, sf_dir):
    folder, root = new_folder(spark, "checkpoint"), new_folder(spark, "snapshots")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    lines = customers.select("c_mktsegment", F.col("c_custkey").cast("string"))
    lines.write.partitionBy("c_mktsegment").text(folder)
    sinks.publish_snapshot(sinks.folder_rows(spark, folder, exclude=["c_mktsegment=BUILDING/*"]), root, "step-1")
    files = sinks.read_snapshot(spark, root).where("length = octet_length(content) AND sha256 = sha2(content, 256)")
    keys = F.split(F.rtrim(F.col("content").cast("string"), F.lit("\n")), "\n").cast("array<long>")
    segment = F.regexp_extract("file", "c_mktsegment=([^/]*)/", 1).alias("c_mktsegment")
    return files.select(segment, F.explode(keys).alias("c_custkey"))


@query
def render_dispatch(spark, sf_dir):
    tables = src.tables(spark, sf_dir)
    frames = []
    for spec in src.catalog():
        rows = tables[spec.name]
        key = F.concat_ws(":", *[F.col(k).cast("string") for k in spec.key_columns])
        frames.append(rows.select(F.lit(spec.name).alias("source"), key.alias("row_key"), render_text(rows, spec).alias("text")))
    return union_sources(frames)


@query
def render_chat(spark, sf_dir):
    return _rendered(src.chat(src.conversations(spark, sf_dir)), src.spec("chat"))


@query
def render_reasoning(spark, sf_dir):
    talk = src.conversations(spark, sf_dir)
    rows = union_sources([src.gsm(talk), src.boxed(talk), src.pairs(talk)])
    return _rendered(rows, src.spec("gsm"))


@query
def render_final_answer(spark, sf_dir):
    return _rendered(src.gsm(src.conversations(spark, sf_dir)), src.spec("gsm"))


@query
def render_boxed(spark, sf_dir):
    return _rendered(src.boxed(src.conversations(spark, sf_dir)), src.spec("boxed"))


@query
def render_general(spark, sf_dir):
    return _rendered(src.pairs(src.conversations(spark, sf_dir)), src.spec("gsm"))


@query
def render_system(spark, sf_dir):
    return _rendered(src.orca(src.conversations(spark, sf_dir)), src.spec("orca"))


@query
def render_qa(spark, sf_dir):
    return _rendered(src.table(spark, sf_dir, "benchmark"), src.spec("qa"))


@query
def render_plain(spark, sf_dir):
    documents = _rendered(src.table(spark, sf_dir, "documents"), DOCUMENTS)
    numbers = _rendered(src.table(spark, sf_dir, "documents"), replace(DOCUMENTS, text_field="n_chars"))
    return documents.unionByName(numbers)


@query
def render_numbers(spark, sf_dir):
    price, orders = F.col("l_extendedprice").cast("double"), src.table(spark, sf_dir, "lineitem")
    frames = []
    for scale in (1e-9, 1.0, 1e8, 1e13):
        rows = orders.select("l_orderkey", "l_linenumber", (price * F.lit(scale)).alias("text"))
        spec = SourceSpec(f"{scale:g}", key_columns=("l_orderkey", "l_linenumber"))
        frames.append(_rendered(rows, spec))
    return union_sources(frames)


@query
def render_missing(spark, sf_dir):
    return _rendered(src.table(spark, sf_dir, "documents"), replace(DOCUMENTS, text_field="no_such_column"))


@query
def project_text(spark, sf_dir):
    rows = src.table(spark, sf_dir, "pages")
    return rows.select(render_text(rows, src.spec("code")).alias("text"))


@query
def scalar_strip(spark, sf_dir):
    padded = F.concat(F.lit(WHITESPACE), F.col("text"), F.lit(WHITESPACE[::-1]))
    rows = src.table(spark, sf_dir, "documents").select("doc_id", padded.alias("text"))
    return rows.select("doc_id", strip(F.col("text")).alias("stripped"), stripped_length(F.col("text")).alias("n"))


@query
def scalar_rsplit(spark, sf_dir):
    marked = F.concat(F.lit("#"), F.replace("text", F.lit("a"), F.lit("#####")), F.lit("####"), F.col("lang"))
    rows = src.table(spark, sf_dir, "documents").select("doc_id", marked.alias("text"))
    left, right = last_split(F.col("text"), "####")
    return rows.select("doc_id", left.alias("left_part"), right.alias("right_part"))


# Filters and caps


@query
def filter_min_chars(spark, sf_dir):
    return src.table(spark, sf_dir, "documents").where(long_enough(F.col("text"))).select("doc_id", "text")


@query
def filter_min_tokens(spark, sf_dir):
    tokens = tokenize(src.document_rows(spark, sf_dir), ByteTokenizer())
    return tokens.select("source", "row_key", F.size("input_ids").alias("n_tokens"))


@query
def metrics_every_n(spark, sf_dir):
    return every_nth(src.run_metrics(spark, sf_dir), "step", 10).select("run", "step", "loss")


def _capped_by_language(spark: SparkSession, sf_dir: str, streaming: bool) -> DataFrame:
    frames = []
    for lang, cap in LANGUAGE_CAPS.items():
        spec = SourceSpec(f"web_{lang}", config=lang, subset_column="lang", streaming=streaming, max_samples=cap,
                          key_columns=("doc_id",))
        frames.append(text_rows(scan(spark, _file_spec(spec, sf_dir, "documents")), spec))
    return union_sources(frames)


@query
def cap_after_filter(spark, sf_dir):
    return _capped_by_language(spark, sf_dir, streaming=True)


@query
def cap_before_filter(spark, sf_dir):
    return _capped_by_language(spark, sf_dir, streaming=False)


@query
def cap_keyless(spark, sf_dir):
    """Rows without a key, capped by file and row number: of the kept rows and of the scanned rows."""
    frames = []
    for name, lazy in (("lazy", True), ("batch", False)):
        spec = _file_spec(SourceSpec(name, streaming=lazy, max_samples=150), sf_dir, "documents")
        frames.append(text_rows(scan(spark, spec), spec))
    row = F.substring_index("row_key", ":", -1).cast("long")
    return union_sources(frames).select("source", row.alias("row"), "text")


@query
def cap_large(spark, sf_dir):
    """A cap on pairs of keys that is found by narrowing; few keys are sorted at once."""
    text = F.concat_ws(" ", F.lit("user"), "user_id", F.lit("did"), "event_type")
    events = src.table(spark, sf_dir, "events").select("user_id", "event_id", text.alias("text"))
    frames = []
    for name, lazy in (("lazy", True), ("batch", False)):
        spec = SourceSpec(name, streaming=lazy, max_samples=700, key_columns=("user_id", "event_id"))
        frames.append(text_rows(events, spec, min_chars=16, direct=20))
    return union_sources(frames)


@query
def retain_latest_n(spark, sf_dir):
    return latest_n(src.run_metrics(spark, sf_dir), "run", "step", 5).select("run", "step", "loss")


@query
def latest_checkpoint(spark, sf_dir):
    metrics = src.run_metrics(spark, sf_dir)
    path = F.concat(F.lit("checkpoint-"), F.col("step").cast("string"))
    listing = runs.with_step(metrics.select("run", path.alias("path")))
    # Runs whose highest loss came with a purchase name that checkpoint; the others name none.
    worst = metrics.groupBy("run").agg(F.max(F.struct("loss", "step", "event_type")).alias("worst")).select("run", "worst.*")
    named = worst.where("event_type = 'purchase'")
    return runs.latest_checkpoint(listing, named.select("run", path.alias("path")))


# Order, split, mixture


@query
def shuffle_seeded(spark, sf_dir):
    return order.shuffle_seeded(src.document_rows(spark, sf_dir))


@query
def global_index(spark, sf_dir):
    return order.global_index(src.document_rows(spark, sf_dir)).select("row_index", "row_total", "source", "row_key")


@query
def split_exact(spark, sf_dir):
    return order.split_exact(src.document_rows(spark, sf_dir)).select("source", "row_key", "split")


@query
def split_hash(spark, sf_dir):
    return order.split_hash(src.document_rows(spark, sf_dir)).select("source", "row_key", "split")


@query
def mixture_split(spark, sf_dir):
    corpus = build_corpus(spark, src.catalog(), src.tables(spark, sf_dir), tolerant=False)
    chosen = mixture.mixture(corpus.rows, src.catalog(), MIXTURE_BUDGET)
    return order.split_exact(chosen).select("source", "row_key", "split")


@query
def row_keys(spark, sf_dir):
    # Language parts with colons and nulls.
    part = F.concat(F.expr("nullif(lang, 'en')"), F.expr("repeat(':', cast(doc_id % 3 as int))"))
    documents = src.table(spark, sf_dir, "documents").select("doc_id", part.alias("part"))
    return documents.select("doc_id", row_key(("part", "doc_id")).alias("row_key"))


@query
def mixture_quota(spark, sf_dir):
    corpus = build_corpus(spark, src.catalog(), src.tables(spark, sf_dir), tolerant=False)
    return mixture.mixture(corpus.rows, src.catalog(), MIXTURE_BUDGET).select("source", "row_key", "text")


@query
def mixture_report(spark, sf_dir):
    corpus = build_corpus(spark, src.catalog(), src.tables(spark, sf_dir), tolerant=False)
    return mixture.mixture_report(corpus.rows, src.catalog())


# Counts and budgets


@query
def count_per_source(spark, sf_dir):
    corpus = build_corpus(spark, src.catalog(), src.tables(spark, sf_dir), tolerant=False)
    return mixture.count_per_source(corpus.rows, mixture.catalog_table(spark, [*src.catalog(), SourceSpec("empty")]))


@query
def count_total(spark, sf_dir):
    corpus = build_corpus(spark, src.catalog(), src.tables(spark, sf_dir), tolerant=False)
    return report.count_rows(corpus.rows)


@query
def count_tokenized(spark, sf_dir):
    return report.count_rows(tokenize(src.document_rows(spark, sf_dir), ByteTokenizer()))


@query
def count_split(spark, sf_dir):
    return report.count_split(order.split_hash(src.document_rows(spark, sf_dir)))


@query
def observe_filter(spark, sf_dir):
    seen = Observation()
    rows = src.table(spark, sf_dir, "documents")
    report.observe_filter(rows, long_enough(F.col("text")), seen).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([seen.get], "scanned long, kept long, rejected long")


@query
def step_budget(spark, sf_dir):
    split = order.split_hash(src.document_rows(spark, sf_dir))
    return report.step_budget(split, batch_size=8, accumulation=16, devices=1, max_steps=100_000)


@query
def last_metric(spark, sf_dir):
    return runs.last_metric(src.run_metrics(spark, sf_dir))


@query
def publish_outcomes(spark, sf_dir):
    return runs.publish_outcomes(src.run_metrics(spark, sf_dir))


# Tokens and batches


@query
def tokenize_bytes(spark, sf_dir):
    tokens = tokenize(src.document_rows(spark, sf_dir, spread=True), ByteTokenizer())
    return tokens.select("source", "row_key", _joined("input_ids"), _joined("attention_mask"))


@query
def tokenize_vocab(spark, sf_dir):
    rows = src.document_rows(spark, sf_dir, spread=True)
    tokens = tokenize(rows, VocabTokenizer(build_vocabulary(rows)))
    return tokens.select("source", "row_key", _joined("input_ids"))


@query
def vocabulary(spark, sf_dir):
    return build_vocabulary(src.document_rows(spark, sf_dir, spread=True))


@query
def vocabulary_cut(spark, sf_dir):
    """A small vocabulary that ends among pieces of equal count."""
    return build_vocabulary(src.document_rows(spark, sf_dir, spread=True), size=1_503, direct=20)


@query
def tokenize_plugged(spark, sf_dir):
    def load():
        return lambda texts: [[1, *[b + 3 for b in text.encode("utf-8")]] for text in texts]

    tokens = tokenize(src.document_rows(spark, sf_dir, spread=True), PluggedTokenizer(load))
    return tokens.select("source", "row_key", _joined("input_ids"))


@query
def map_rows(spark, sf_dir):
    def lengths(frame):
        return frame.assign(n=frame["text"].str.len())[["row_key", "n"]]

    return map_batches(src.document_rows(spark, sf_dir).select("row_key", "text"), lengths, "row_key string, n long")


@query
def batch_drop_last(spark, sf_dir):
    rows = src.document_rows(spark, sf_dir).select("source", "row_key")
    return batches.assign_batches(rows, 16).select("batch_id", "batch_row", "source", "row_key")


@query
def lm_collate(spark, sf_dir):
    rows = batch_rows(src.document_rows(spark, sf_dir), ByteTokenizer(), BATCH_SIZE)
    return rows.select("batch_id", "batch_row", _joined("input_ids"), _joined("attention_mask"), _joined("labels"))


# Streams


def _document_stream(spark: SparkSession, sf_dir: str, spec: SourceSpec) -> DataFrame:
    # A pattern: the table may be one file or a folder of files, and a stream takes no single file by its name.
    spec = replace(spec, path=f"{sf_dir}/documents.parque[t]")
    return scan_stream(spark, spec, src.table(spark, sf_dir, "documents").schema)


@query
def stream_prepare(spark, sf_dir):
    spec, out = replace(src.spec("web_en"), max_samples=500), new_folder(spark, "stream")
    stream = _document_stream(spark, sf_dir, spec)
    streams.start_prepare(stream, spec, ByteTokenizer(), out, f"{out}/checkpoint").awaitTermination()
    return streams.read_batches(spark, out).select("source", "row_key", _joined("input_ids"))


@query
def stream_two_sources(spark, sf_dir):
    """Two sources into one output; each keeps its own rows."""
    out = new_folder(spark, "streams")
    for lang in ("en", "de"):
        spec = replace(src.spec(f"web_{lang}"), max_samples=None)
        stream = _document_stream(spark, sf_dir, spec)
        streams.start_prepare(stream, spec, ByteTokenizer(), out, f"{out}/checkpoint-{lang}").awaitTermination()
    return streams.read_batches(spark, out).select("source", "row_key", F.size("input_ids").alias("n_tokens"))


@query
def stream_resume(spark, sf_dir):
    documents, out = src.table(spark, sf_dir, "documents"), new_folder(spark, "resume")
    spec = replace(DOCUMENTS, path=f"{out}/in")
    for part in ("lang = 'en'", "lang <> 'en'"):
        documents.where(part).write.mode("append").parquet(spec.path)
        stream = scan_stream(spark, spec, documents.schema)
        streams.start_prepare(stream, spec, ByteTokenizer(), out, f"{out}/checkpoint").awaitTermination()
    written = streams.read_batches(spark, out)
    return written.select("source", "row_key", F.size("input_ids").alias("n_tokens"), F.col("batch").cast("long"))


@query
def stream_progress(spark, sf_dir):
    documents, out = src.table(spark, sf_dir, "documents"), new_folder(spark, "progress")
    spec = replace(DOCUMENTS, path=f"{out}/in", max_samples=300)
    for part in ("lang = 'en'", "lang <> 'en'"):
        documents.where(part).write.mode("append").parquet(spec.path)
        stream = scan_stream(spark, spec, documents.schema)
        streams.start_prepare(stream, spec, ByteTokenizer(), out, f"{out}/checkpoint").awaitTermination()
    return streams.progress(spark, out)


@query
def stream_shuffle(spark, sf_dir):
    out = new_folder(spark, "shuffle")
    stream = _document_stream(spark, sf_dir, DOCUMENTS)
    streams.start_shuffle(stream, DOCUMENTS, out, f"{out}/checkpoint").awaitTermination()
    return streams.read_batches(spark, out).select(F.col("batch").cast("long"), "row_index", "source", "row_key")
