"""Times each stage of a whole run on synthetic reviews; prints one JSON line.

The reviews are made from the driver tables (``BENCH_REVIEWS`` of them, a million
by default) and a third of them are moved to one product. Calls are plain Python.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession, functions as F

from revlens.operators import evaluate, synth
from revlens.operators.providers import Judge, Provider
from revlens.params import Params, ReviewRules
from revlens.plans import batch, driver_tables
from revlens.sources.tables import shared_folder, write_table

RULES = ReviewRules(review_id_pattern="^rev-[0-9]{4,}$", product_id_pattern="^prod-[0-9]+$")
PARAMS = Params(target_languages=("fr", "de"), rules=RULES)


def translator() -> Provider:
    return Provider.batch(lambda: lambda text, source, target: f"[{target}] {text}")


def judge() -> Judge:
    return Judge(Provider.batch(lambda: lambda prompt, *_: str(len(prompt) % 5 + 1)), replies=True)


def summarizer() -> Provider:
    return Provider.batch(lambda: lambda prompt, *_: f"{len(prompt)} characters")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    total = int(os.environ.get("BENCH_REVIEWS", 1_000_000))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("revlens-scale")
        .config("spark.sql.shuffle.partitions", str(4 * int(cpus)))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = f"{shared_folder(spark)}/revlens-scale-{uuid.uuid4().hex}"
    at, seconds = batch.Layout.fresh(root, "run"), {}

    def step(name: str, work: Callable):
        start = time.perf_counter()
        result = work()
        seconds[name] = round(time.perf_counter() - start, 2)
        return result

    products, phrases = driver_tables.library_tables(spark, sf_dir)
    hot = F.when(F.col("seq") % 3 == 0, F.lit("prod-0")).otherwise(F.col("product_id"))
    made = synth.generate(products, phrases, total, seed=1).withColumn("product_id", hot)
    source = step("generate", lambda: write_table(made, f"{root}/source"))
    step("ingest", lambda: batch.ingest_stage(source, at, PARAMS))
    step("translate", lambda: batch.translate_stage(spark, at, PARAMS, translator()))
    step("summarize", lambda: batch.summarize_stage(spark, at, PARAMS, summarizer()))
    step("quality", lambda: batch.quality_stage(spark, at, PARAMS, judge()))
    step("serving", lambda: batch.serving_stage(spark, at, PARAMS))
    translated = at.read(spark, "translated").drop("failed")

    def figures():
        result = evaluate.evaluate(PARAMS, translator(), judge(), translated=translated)
        return result.per_language.collect(), result.overall.collect()

    step("evaluate", figures)
    spent = sum(seconds.values())
    print(
        json.dumps(
            {
                "metric": "staged_run_seconds",
                "value": round(spent, 2),
                "unit": "sec",
                "reviews": total,
                "reviews_per_second": round(total / spent),
                "stages": seconds,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
