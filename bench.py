"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_RUNS (timed runs per query).
Each query runs once to warm up; the median of the timed runs counts.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import tempfile
import time

from corpusloom.functions.render import render_text
from corpusloom.operators import order
from corpusloom.operators.report import measure
from corpusloom.operators.select import long_enough
from corpusloom.operators.tokens import ByteTokenizer, PluggedTokenizer, VocabTokenizer, build_vocabulary, tokenize
from corpusloom.plans.prepare import batch_rows, prepare
from corpusloom.session import build_session, new_folder
from corpusloom.sources.scan import build_corpus, union_sources
from suite import sources as src

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def render_filter(spark):
    tables = src.tables(spark, SF_DIR)
    texts = [tables[s.name].select(render_text(tables[s.name], s).alias("text")) for s in src.catalog()]
    return union_sources(texts).where(long_enough(texts[0]["text"]))


def corpus(spark):
    return build_corpus(spark, src.catalog(), src.tables(spark, SF_DIR)).rows


def load_byte_encoder():
    return lambda texts: [[1, *[b + 3 for b in text.encode("utf-8")]] for text in texts]


def documents(spark, spread=False):
    return src.document_rows(spark, SF_DIR, spread)


def tokenized(spark, tokenizer):
    return tokenize(documents(spark, spread=True), tokenizer)


def vocab(spark):
    rows = documents(spark, spread=True)
    return tokenize(rows, VocabTokenizer(build_vocabulary(rows)))


def collated(spark):
    return batch_rows(documents(spark), ByteTokenizer(), 8)


def whole(spark):
    return prepare(spark, src.catalog(), ByteTokenizer(), new_folder(spark, "bench"), src.tables(spark, SF_DIR))


HEADLINE = {
    "render_filter": render_filter,
    "union_caps": corpus,
    "shuffle": lambda spark: order.shuffle_seeded(documents(spark)),
    "tokenize_bytes": lambda spark: tokenized(spark, ByteTokenizer()),
    "tokenize_vocab": vocab,
    "tokenize_plugged": lambda spark: tokenized(spark, PluggedTokenizer(load_byte_encoder)),
    "split_hash": lambda spark: order.split_hash(documents(spark)),
    "split_exact": lambda spark: order.split_exact(documents(spark)),
    "batch_collate": collated,
    "prepare_to_parquet": whole,
}


def timed(spark, name, run) -> dict[str, float]:
    start = time.perf_counter()
    rows = run(spark)
    building = time.perf_counter() - start
    result = measure(rows, f"{name}_{start}".replace(".", "_"))
    seconds = building + result["seconds"]
    return {"rows": result["rows"], "seconds": seconds}


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, rows = {}, {}
    for name, run in HEADLINE.items():
        timed(spark, name, run)
        runs = [timed(spark, name, run) for _ in range(RUNS)]
        seconds[name] = round(statistics.median(r["seconds"] for r in runs), 4)
        rows[name] = runs[0]["rows"]
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "rows": rows,
                "rows_per_second": {n: round(rows[n] / max(s, 1e-9), 1) for n, s in seconds.items()},
                "sf": float(scale.group(1)) if scale else None,
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
