"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Results go to Spark's no-op sink, so every row is computed and none is collected. Table
queries are timed on their second run, everything else on its only one. Setup that a query
does not own (raw files, a trained model) is outside its time.
"""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.catalog.queries import QUERIES, SMALL_GB, SMALL_LR, SMALL_RF  # noqa: E402
from tidemark.operators import features, models  # noqa: E402
from tidemark.plans import inference, layers, training  # noqa: E402
from tidemark.session import build_session, scratch_path  # noqa: E402
from tidemark.sinks.files import write_layer  # noqa: E402
from tidemark.sources import tables  # noqa: E402
from tidemark.sources.files import read_layer  # noqa: E402
from tidemark.streaming import events  # noqa: E402
from tidemark import schemas as S  # noqa: E402

PLAIN = [
    "gold",
    "gold_by_age_group",
    "silver",
    "training_set",
    "class_weights",
    "predictions",
    "prediction_percentages",
    "run_metrics",
    "overall_metrics",
    "classification_report",
    "leaderboard",
    "preview",
]


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(max(8, 2 * int(cpus) if cpus.isdigit() else 8)),
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name, work):
        start = time.perf_counter()
        result = work()
        times[name] = round(time.perf_counter() - start, 3)
        return result

    for name in PLAIN:
        consume(QUERIES[name](spark, folder))
        timed(name, lambda: consume(QUERIES[name](spark, folder)))

    raw = read_layer(
        spark, write_layer(tables.raw_appointments(spark, folder), scratch_path(spark, "raw"))
    )
    out = scratch_path(spark, "layers")
    timed("etl_layers", lambda: consume(layers.run_layers(raw, out)))
    gold = read_layer(spark, f"{out}/gold")

    prepared = timed("split_and_prepare", lambda: training.prepare(gold))
    fitted = {
        c.run_name: timed(f"fit_{c.run_name}", lambda: training.fit(prepared, c))
        for c in (SMALL_LR, SMALL_RF, SMALL_GB)
    }
    candidates = [SMALL_LR, SMALL_RF, SMALL_GB]
    timed(
        "grid_scores_and_metrics",
        lambda: consume(
            training.grid_metrics(
                training.score_all(prepared.test, candidates, list(fitted.values())), candidates
            )
        ),
    )
    timed(
        "train_grid",
        lambda: consume(
            training.train_grid(gold, scratch_path(spark, "experiment"), candidates)
        ),
    )
    timed(
        "train_grid_whole",
        lambda: consume(
            training.train_grid(gold, scratch_path(spark, "experiment"), parallelism=5)
        ),
    )
    model = models.assemble(prepared.encoding, fitted[SMALL_LR.run_name])
    timed("batch_scoring", lambda: consume(inference.batch_predictions(gold, model)))
    timed(
        "score_responses",
        lambda: consume(inference.respond(features.scoring_set(gold), model, keep=S.IDS)),
    )

    source = scratch_path(spark, "events")
    tables.as_events(raw).write.json(source)

    def replay():
        stream = events.read_events(
            spark, source, schema=S.event_schema(tables.ID_TYPE, corrupt=True)
        )
        target = scratch_path(spark, "stream")
        events.start_scoring(
            stream, model, target, scratch_path(spark, "checkpoint"), trigger=events.WHAT_IS_THERE
        ).awaitTermination()
        return target

    target = timed("stream_replay", replay)
    timed(
        "consolidate",
        lambda: events.consolidate(spark, target, scratch_path(spark, "consolidated")),
    )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
