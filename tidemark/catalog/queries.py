"""The registered queries: each takes a session and a table folder, and reads whole tables."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions import columns as C
from tidemark.operators import features, metrics, models, ranking, reports, scoring, split
from tidemark.plans import inference, layers, registry, training
from tidemark.session import configure, scratch_path
from tidemark.sinks.files import EVENTS_PER_FILE, remove, save_model, write_events, write_layer
from tidemark.sources import tables
from tidemark.sources.files import load_model, read_csv, read_layer, read_requests
from tidemark.streaming import events

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SMALL_LR = models.Candidate("lr_c_1", "logistic_regression", {"C": 1})
SMALL_RF = models.Candidate("rf_20_depth_5", "random_forest", {"n_estimators": 20, "max_depth": 5})
SMALL_GB = models.Candidate(
    "gb_10_lr_0_1_depth_3",
    "gradient_boosting",
    {"n_estimators": 10, "learning_rate": 0.1, "max_depth": 3},
)
RF_STUMP = models.Candidate(
    "rf_stump",
    "random_forest",
    {"n_estimators": 1, "max_depth": 1, "max_features": "all", "bootstrap": False},
)
GB_STUMP = models.Candidate(
    "gb_stump", "gradient_boosting", {"n_estimators": 1, "learning_rate": 0.1, "max_depth": 1}
)
GRADIENT_DIGITS = 7
IN_EXPERIMENT = "3-MEDIUM"
AGE_GROUPS = ["child", "young_adult", "adult", "senior"]


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(configure(spark), folder)

    QUERIES[fn.__name__] = run
    return fn


def days_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {d: F.date_format(d, "yyyy-MM-dd HH:mm:ss") for d in ("ScheduledDay", "AppointmentDay")}
    )


def gold_rows(spark: SparkSession, folder: str) -> DataFrame:
    return features.gold(features.silver(tables.raw_appointments(spark, folder)))


def scored_fixture(spark: SparkSession, folder: str) -> DataFrame:
    """Scoring rows with the computed score and the serving decision."""
    rows = tables.scored_rows(features.scoring_set(gold_rows(spark, folder)))
    return scoring.decide(rows).select(*S.PREDICTIONS)


def runs_fixture(spark: SparkSession, folder: str) -> DataFrame:
    """Measured runs with run records' columns."""
    scored = tables.scored_runs(gold_rows(spark, folder))
    return metrics.run_metrics(scored, ["seq", "run_name", "experiment"]).withColumn(
        "run_id", F.concat(F.lit("run-"), F.col("seq"))
    )


def per_file(spark: SparkSession, folder: str, files: int) -> int:
    """Events a file may hold so that the raw rows fill ``files`` or more; from the footer."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    return min(EVENTS_PER_FILE, max(1, -(-lines // files)))


def event_files(spark: SparkSession, folder: str) -> str:
    """The raw rows as JSON event files, a dozen or more."""
    rows = tables.as_events(tables.raw_appointments(spark, folder))
    return write_events(rows, scratch_path(spark, "events"), per_file(spark, folder, 12))


def events_there(spark: SparkSession, path: str, batches: int, known: int = 0) -> tuple[DataFrame, int]:
    """A stream over the folder whose files beyond the ``known`` first make so many batches,
    and the number of its files."""
    schema = S.event_schema(tables.ID_TYPE, corrupt=True)
    files = len(spark.read.schema(schema).json(path).inputFiles())
    most = max(1, -(-(files - known) // batches))
    return events.read_events(spark, path, max_files=most, schema=schema), files


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The event files in three batches."""
    return events_there(spark, event_files(spark, folder), 3)[0]


def staged_events(spark: SparkSession, folder: str) -> DataFrame:
    """The raw rows as events yet to come: written once, however many parts are taken of them."""
    rows = tables.as_events(tables.raw_appointments(spark, folder))
    return read_layer(spark, write_layer(rows, scratch_path(spark, "staged")))


# --- layers ---


@query
def bronze_roundtrip(spark, folder):
    path = layers.bronze_layer(
        tables.raw_appointments(spark, folder), scratch_path(spark, "bronze")
    )
    return days_as_text(read_layer(spark, path)).withColumnRenamed("No-show", "no_show_text")


@query
def csv_scan(spark, folder):
    path = scratch_path(spark, "csv")
    tables.as_events(tables.raw_appointments(spark, folder)).write.option("header", True).csv(path)
    rows = read_csv(spark, path, S.raw_schema(tables.ID_TYPE))
    return days_as_text(rows).withColumnRenamed("No-show", "no_show_text")


@query
def csv_scan_reordered(spark, folder):
    """The same rows from a file whose columns stand in another order."""
    path = scratch_path(spark, "csv")
    rows = tables.as_events(tables.raw_appointments(spark, folder))
    rows.select(*[F.col(f"`{c}`") for c in sorted(rows.columns)]).write.option("header", True).csv(
        path
    )
    read = read_csv(spark, path, S.raw_schema(tables.ID_TYPE))
    return days_as_text(read).withColumnRenamed("No-show", "no_show_text")


@query
def csv_quarantine(spark, folder):
    """Where each line of a CSV ends up whose ages are partly no numbers."""
    source, out, bad = (scratch_path(spark, n) for n in ("csv", "layers", "bad"))
    rows = tables.as_events(tables.raw_appointments(spark, folder))
    age = F.when(F.col("AppointmentID") % 7 == 0, F.lit("old")).otherwise(F.col("Age").cast("string"))
    rows.withColumn("Age", age).write.option("header", True).csv(source)
    layers.run_etl(spark, source, out, S.raw_schema(tables.ID_TYPE), quarantine=bad)
    kept = read_layer(spark, f"{out}/bronze").select("AppointmentID", F.lit("bronze").alias("place"))
    line = F.split(F.col(S.CORRUPT), ",")
    at = [name for name, _ in S.RAW_FIELDS].index("AppointmentID")
    refused = read_layer(spark, bad).select(
        F.get(line, F.lit(at)).cast("bigint").alias("AppointmentID"), F.lit("quarantine").alias("place")
    )
    return kept.unionByName(refused)


@query
def layer_schema(spark, folder):
    """The gold layer's columns as written, with what is missing in each."""
    path = write_layer(gold_rows(spark, folder), scratch_path(spark, "gold"))
    return reports.column_report(read_layer(spark, path))


@query
def silver(spark, folder):
    return days_as_text(features.silver(tables.raw_appointments(spark, folder)))


@query
def gold(spark, folder):
    return gold_rows(spark, folder)


@query
def gold_by_age_group(spark, folder):
    return gold_rows(spark, folder).groupBy("age_group", S.LABEL).agg(F.count("*").alias("rows"))


@query
def etl_layer_counts(spark, folder):
    return layers.run_layers(tables.raw_appointments(spark, folder), scratch_path(spark, "layers"))


@query
def etl_from_csv(spark, folder):
    source = scratch_path(spark, "csv")
    tables.as_events(tables.raw_appointments(spark, folder)).write.option("header", True).csv(
        source
    )
    out = scratch_path(spark, "layers")
    layers.run_etl(spark, source, out, S.raw_schema(tables.ID_TYPE))
    return read_layer(spark, f"{out}/gold")


@query
def deduplicated(spark, folder):
    rows = features.drop_copies(tables.raw_appointments(spark, folder))
    return days_as_text(rows).withColumnRenamed("No-show", "no_show_text")


# --- training and scoring sets ---


@query
def training_set(spark, folder):
    return features.training_set(gold_rows(spark, folder))


@query
def scoring_set(spark, folder):
    return features.scoring_set(gold_rows(spark, folder))


@query
def stratified_split(spark, folder):
    rows = features.training_set(gold_rows(spark, folder), ["AppointmentID"])
    return split.stratified_split(rows)


@query
def stratified_split_copies(spark, folder):
    """Few columns, so nearly every row has copies and the cut falls among them."""
    rows = features.training_set(gold_rows(spark, folder))
    return split.stratified_split(rows.select("Gender", "age_group", "Scholarship", S.LABEL))


@query
def training_split(spark, folder):
    """What training splits: rows of each class and part, and those of the commonest profile."""
    rows = training.prepare(gold_rows(spark, folder)).split_rows
    profiles = rows.groupBy(S.LABEL, "split", *S.FEATURES).agg(F.count("*").alias("n"))
    every = rows.groupBy(S.LABEL, *S.FEATURES).agg(F.count("*").alias("n"))
    top = every.orderBy(F.desc("n"), S.LABEL, *S.FEATURES).limit(1).drop("n")
    of_top = profiles.join(
        F.broadcast(top.select(S.LABEL, *S.FEATURES, F.lit(True).alias("top"))),
        [S.LABEL, *S.FEATURES],
        "left",
    )
    return of_top.groupBy(S.LABEL, "split").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("top"), F.col("n"))), F.lit(0)).alias("top_profile_rows"),
    )


@query
def class_weights(spark, folder):
    return split.class_weights(features.training_set(gold_rows(spark, folder)))


# --- decisions and reports ---


@query
def threshold_predictions(spark, folder):
    rows = tables.scored_rows(features.scoring_set(gold_rows(spark, folder)))
    third = F.col("AppointmentID") % 3 == 0  # a model without probabilities
    predicted = C.evaluation_class("no_show_probability")
    return rows.select(
        "AppointmentID",
        "days_until_appointment",
        "no_show_probability",
        C.serving_decision("no_show_probability").alias("predicted_no_show"),
        predicted.alias("evaluation_class"),
        F.when(~third, F.col("no_show_probability")).alias("score"),
    ).withColumn("score_or_class", C.score_or_class("score", "evaluation_class"))


@query
def predictions(spark, folder):
    return scored_fixture(spark, folder)


@query
def consolidated_predictions(spark, folder):
    return scoring.consolidated(scored_fixture(spark, folder))


@query
def score_response(spark, folder):
    rows = features.scoring_set(gold_rows(spark, folder))
    mixed = F.col("AppointmentID") * 7919 + F.col("days_until_appointment") * 13
    scored = rows.withColumn("no_show_probability", (mixed % 99991).cast("double") / 99991)
    return scoring.responses(scored, keep=["AppointmentID"])


@query
def prediction_counts(spark, folder):
    return reports.counts_by(scored_fixture(spark, folder), "predicted_no_show")


@query
def prediction_percentages(spark, folder):
    return reports.shares_by(scored_fixture(spark, folder), "predicted_no_show")


@query
def label_distribution(spark, folder):
    rows = scoring.consolidated(scored_fixture(spark, folder))
    return reports.counts_by(rows, "prediction_label")


@query
def prediction_total(spark, folder):
    return reports.row_total(scored_fixture(spark, folder))


@query
def preview(spark, folder):
    return reports.preview(scored_fixture(spark, folder), 20, ["AppointmentID"])


# --- metrics, ranking, selection ---


@query
def run_metrics(spark, folder):
    return metrics.run_metrics(
        tables.scored_runs(gold_rows(spark, folder)), ["seq", "run_name", "experiment"]
    )


@query
def overall_metrics(spark, folder):
    """All rows as a single run."""
    scored = tables.scored_runs(gold_rows(spark, folder)).withColumn("run_name", F.lit("all"))
    return metrics.run_metrics(scored, ["run_name"])


@query
def classification_report(spark, folder):
    return metrics.classification_report(tables.scored_runs(gold_rows(spark, folder)))


@query
def leaderboard(spark, folder):
    board = ranking.leaderboard(runs_fixture(spark, folder))
    return board.select("rank", "run_name", "experiment", *S.METRICS)


@query
def top15(spark, folder):
    return ranking.top_runs(runs_fixture(spark, folder)).select(
        "rank", "run_name", S.SELECTION_METRIC
    )


@query
def best_run(spark, folder):
    return ranking.best_run(runs_fixture(spark, folder)).select(
        "seq", "run_name", S.SELECTION_METRIC
    )


@query
def best_run_in_experiment(spark, folder):
    return ranking.best_run_in_experiment(runs_fixture(spark, folder), IN_EXPERIMENT).select(
        "experiment", "run_name", S.SELECTION_METRIC
    )


def registry_fixture(spark, folder):
    """Every measured run registered under its experiment, versions by handicap level."""
    return runs_fixture(spark, folder).select(
        F.col("experiment").alias("name"),
        (F.col("seq") % 5 + 1).alias("version"),
        "run_id",
        F.concat_ws("/", F.lit("models"), "run_name", F.col("rows").cast("string")).alias("uri"),
    )


@query
def latest_model(spark, folder):
    return ranking.latest_version(registry_fixture(spark, folder))


@query
def register_past_run(spark, folder):
    """Record the runs, register one experiment's best twice, read the registry back."""
    runs, versions = scratch_path(spark, "runs"), scratch_path(spark, "registry")
    measured = runs_fixture(spark, folder).withColumn(
        "uri", F.concat_ws("/", F.lit("models"), "run_name")
    )
    registry.append_runs(measured, runs)
    for _ in range(2):
        registry.register_best_past_run(spark, runs, versions, IN_EXPERIMENT, name="past")
    return registry.read_registry(spark, versions)


# --- streaming ---


def replay(spark, start, out):
    """Run a stream over what is there; its output read back."""
    start(out, scratch_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(f"{out}/*")


@query
def stream_features(spark, folder):
    def start(out, checkpoint):
        return events.start_batches(
            event_stream(spark, folder),
            features.featurize,
            out,
            checkpoint,
            trigger=events.WHAT_IS_THERE,
        )

    return replay(spark, start, scratch_path(spark, "stream"))


@query
def stream_consolidated(spark, folder):
    def decide(batch):
        rows = tables.scored_rows(features.featurize(batch))
        return scoring.decide(rows).select(*S.PREDICTIONS)

    out = scratch_path(spark, "stream")
    events.start_batches(
        event_stream(spark, folder),
        decide,
        out,
        scratch_path(spark, "checkpoint"),
        trigger=events.WHAT_IS_THERE,
    ).awaitTermination()
    return events.consolidate(spark, out, scratch_path(spark, "consolidated"))


@query
def stream_restarted(spark, folder):
    """Half of the files, a stop, the other half from the same checkpoint."""
    rows = staged_events(spark, folder)
    path, out = scratch_path(spark, "events"), scratch_path(spark, "stream")
    checkpoint, known = scratch_path(spark, "checkpoint"), 0

    def decide(batch):
        scored = tables.scored_rows(features.featurize(batch))
        return scoring.decide(scored).select(*S.PREDICTIONS)

    late = F.col("AppointmentID") % 2 == 1
    for part in (rows.filter(~late), rows.filter(late)):
        write_events(part, path, per_file(spark, folder, 16))
        stream, known = events_there(spark, path, 2, known)
        events.start_batches(
            stream, decide, out, checkpoint, trigger=events.WHAT_IS_THERE
        ).awaitTermination()
    return events.consolidate(spark, out, scratch_path(spark, "consolidated"))


def in_parts(spark, folder, parts, prepare=None):
    """Folders for events and output, and writers that add a part of the raw rows each."""
    rows = staged_events(spark, folder)
    path = scratch_path(spark, "events")

    def add(part):
        chosen = rows.filter(F.col("AppointmentID") % parts == part)
        write_events(prepare(chosen, part) if prepare else chosen, path)

    def stream():
        return events_there(spark, path, 1)[0]

    return add, stream


@query
def stream_empty_batches(spark, folder):
    """What each of four batches counts and leaves; the odd ones hold past appointments only."""

    def past(chosen, part):
        return chosen.withColumn("AppointmentDay", F.lit("1970-01-01T00:00:00Z")) if part % 2 else chosen

    add, stream = in_parts(spark, folder, 4, past)
    out, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "checkpoint")
    told = {}
    for part in range(4):
        add(part)
        events.start_batches(
            stream(),
            features.featurize,
            out,
            checkpoint,
            trigger=events.WHAT_IS_THERE,
            counted=told.__setitem__,
        ).awaitTermination()
    counts = spark.createDataFrame(
        [(i, c["events"], c["unreadable"], c["usable"]) for i, c in told.items()],
        "batch_id bigint, events bigint, unreadable bigint, usable bigint",
    )
    batch = F.regexp_extract(F.input_file_name(), r"batch_(\d+)", 1).cast("bigint")
    written = (
        spark.read.parquet(f"{out}/*")
        .groupBy(batch.alias("batch_id"))
        .agg(F.count("*").alias("written"))
    )
    return counts.join(written, "batch_id", "left")


@query
def stream_replayed(spark, folder):
    """Three batches; the second loses its commit and is replayed after another model came.

    ``model`` is the registered version whose score the row carries.
    """
    gold = write_layer(gold_rows(spark, folder), scratch_path(spark, "gold"))
    prepared = training.prepare(read_layer(spark, gold))
    weak = models.Candidate("lr_c_weak", "logistic_regression", {"C": 1e-9})
    uris = [
        save_model(
            models.assemble(prepared.encoding, training.fit(prepared, candidate)),
            scratch_path(spark, "model"),
        )
        for candidate in (SMALL_LR, weak)
    ]
    versions = scratch_path(spark, "registry")
    out, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "checkpoint")
    add, stream = in_parts(spark, folder, 3)

    def run():
        events.start_scoring(
            stream(),
            registry.LatestModel(spark, versions),
            out,
            checkpoint,
            trigger=events.WHAT_IS_THERE,
        ).awaitTermination()

    registry.register(spark, versions, "one", uris[0])
    for part in range(2):
        add(part)
        run()
    remove(spark, f"{checkpoint}/commits/1")
    registry.register(spark, versions, "two", uris[1])
    add(2)
    run()
    batch = F.regexp_extract(F.input_file_name(), r"batch_(\d+)", 1).cast("bigint")
    rows = spark.read.parquet(f"{out}/*").withColumn("batch", batch)
    for version, uri in enumerate(uris, 1):
        rows = rows.withColumnRenamed("no_show_probability", "_written")
        rows = scoring.apply_model(rows, load_model(uri)).withColumn(
            f"_{version}", F.abs(F.col("no_show_probability") - F.col("_written")) < 1e-12
        )
        rows = rows.drop("no_show_probability").withColumnRenamed("_written", "no_show_probability")
    version = F.when(F.col("_1"), 1).when(F.col("_2"), 2)
    return rows.select(*S.SCORING, "batch", version.alias("model"))


def damaged_events(spark, folder):
    """Event files with days that are none and with lines cut short, through both stream forms.

    Per form: where events went, and what was counted.
    """
    path = scratch_path(spark, "events")
    rows = tables.as_events(tables.raw_appointments(spark, folder))
    kind = F.col("AppointmentID") % 7
    day = F.when(kind == 0, "soon").otherwise(F.col("ScheduledDay"))
    line = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))
    short = F.expr("substring(line, 1, length(line) - 3)")
    cut = F.when(F.col("kind") == 1, short).otherwise(F.col("line"))
    lines = rows.withColumn("ScheduledDay", day).select(kind.alias("kind"), line.alias("line"))
    write_events(lines.select(cut.alias("value")), path)

    def stream():
        return events.read_events(spark, path, schema=S.event_schema(tables.ID_TYPE, corrupt=True))

    def place(name):
        return scratch_path(spark, name)

    def decide(batch):
        scored = tables.scored_rows(features.featurize(batch))
        return scoring.decide(scored).select(*S.PREDICTIONS)

    told = {"batches": [], "files": []}
    out, bad, sink, bad_sink = place("out"), place("bad"), place("sink"), place("bad")
    events.start_batches(
        stream(),
        decide,
        out,
        place("checkpoint"),
        quarantine=bad,
        trigger=events.WHAT_IS_THERE,
        counted=lambda _, counts: told["batches"].append(counts),
    ).awaitTermination()
    listener = events.Counted(spark, lambda _, counts: told["files"].append(counts))
    events.start_to_files(
        stream(), decide, sink, place("checkpoint"), trigger=events.WHAT_IS_THERE, counted=listener
    ).awaitTermination()
    events.start_quarantine(
        stream(), bad_sink, place("checkpoint"), trigger=events.WHAT_IS_THERE
    ).awaitTermination()
    if not listener.wait(60):
        raise TimeoutError("the stream's last counts did not come")
    places = {"batches": (f"{out}/*", f"{bad}/*"), "files": (sink, bad_sink)}
    return places, told


@query
def stream_damaged_events(spark, folder):
    """Every event of both stream forms: scored, or kept as unreadable."""
    places, _ = damaged_events(spark, folder)
    in_text = F.regexp_extract(F.col(S.CORRUPT), r'"AppointmentID":(\d+)', 1).cast("bigint")
    parts = []
    for form, (scored, kept) in places.items():
        by_form = F.lit(form).alias("form")
        parts.append(
            read_layer(spark, scored).select(by_form, "AppointmentID", F.lit("scored").alias("outcome"))
        )
        ids = F.when(F.col(S.CORRUPT).isNotNull(), in_text).otherwise(F.col("AppointmentID"))
        parts.append(
            read_layer(spark, kept).select(
                by_form, ids.alias("AppointmentID"), F.lit("unreadable").alias("outcome")
            )
        )
    return reduce(DataFrame.unionByName, parts)


@query
def stream_damaged_counts(spark, folder):
    """What both stream forms tell of the same events, over all their batches."""
    _, told = damaged_events(spark, folder)
    names = ("events", "unreadable", "usable")
    return spark.createDataFrame(
        [(form, *[sum(c[n] for c in counts) for n in names]) for form, counts in told.items()],
        "form string, events bigint, unreadable bigint, usable bigint",
    )


@query
def stream_triggered(spark, folder):
    """Three batches under the default trigger: their rows, and whether each began on a
    multiple of five seconds; the first one begins at once, and one whose tick has passed while
    the last one ran begins as that ends."""
    out = scratch_path(spark, "stream")
    started = events.start_batches(
        event_stream(spark, folder), features.featurize, out, scratch_path(spark, "checkpoint")
    )
    try:
        started.processAllAvailable()
        told = [p for p in started.recentProgress if p.numInputRows]
    finally:
        started.stop()
    batches = spark.createDataFrame(
        [(p.batchId, p.timestamp, p.durationMs["triggerExecution"]) for p in told],
        "batch_id bigint, began string, took bigint",
    ).withColumn("began", F.unix_millis(F.to_timestamp("began")))
    last = Window.orderBy("batch_id")  # three rows
    late = (F.lag("took").over(last) > 4000) & (
        F.col("began") - F.lag("began").over(last) - F.lag("took").over(last) < 1000
    )
    off = F.pmod(F.col("began"), F.lit(5000))
    on_time = (F.col("batch_id") == 0) | F.least(off, 5000 - off).between(0, 999) | late
    batches = batches.select("batch_id", on_time.cast("int").alias("on_time"))
    batch = F.regexp_extract(F.input_file_name(), r"batch_(\d+)", 1).cast("bigint")
    rows = spark.read.parquet(f"{out}/*").withColumn("batch_id", batch)
    return (
        rows.join(F.broadcast(batches), "batch_id")
        .groupBy("on_time")
        .agg(F.count("*").alias("rows"), F.count_distinct("batch_id").alias("batches"))
    )


# --- models ---


@query
def model_settings(spark, folder):
    """What the factory sets for each of the 15 candidates on the training rows."""
    prepared = training.prepare(gold_rows(spark, folder))
    shown = {
        "regParam": "reg_param",
        "numTrees": "trees",
        "maxIter": "rounds",
        "maxDepth": "depth",
        "stepSize": "step",
        "maxBins": "splits",
    }
    rows = []
    for candidate in models.GRID:
        built = models.estimator(
            candidate.model_type, candidate.params, prepared.train_rows, splits=prepared.splits
        )
        of = {p.name: built.getOrDefault(p) for p in built.params if built.hasDefault(p) or built.isSet(p)}
        rows.append((candidate.run_name, *[float(of[p]) if p in of else None for p in shown]))
    columns = ", ".join(f"{name} double" for name in shown.values())
    return spark.createDataFrame(rows, f"run_name string, {columns}")


def candidate_scores(spark, folder, candidate):
    prepared = training.prepare(gold_rows(spark, folder), keep=S.IDS)
    classifier = training.fit(prepared, candidate)
    return training.score_all(prepared.test, [candidate], [classifier], keep=S.IDS)


@query
def lr_scores(spark, folder):
    return candidate_scores(spark, folder, SMALL_LR)


@query
def rf_scores(spark, folder):
    return candidate_scores(spark, folder, SMALL_RF)


@query
def gbt_scores(spark, folder):
    return candidate_scores(spark, folder, SMALL_GB)


def checked_scores(scores: DataFrame) -> DataFrame:
    """Who is scored, and whether each score is a probability."""
    return scores.select(
        *S.IDS, "run_name", "label", F.col("p").between(0, 1).cast("int").alias("is_probability")
    )


@query
def rf_scores_checked(spark, folder):
    return checked_scores(rf_scores(spark, folder))


@query
def gbt_scores_checked(spark, folder):
    return checked_scores(gbt_scores(spark, folder))


def stump_nodes(spark, folder, candidate):
    """The nodes of a single split, fitted on the training rows and saved, by ``side``."""
    prepared = training.prepare(gold_rows(spark, folder))
    path = scratch_path(spark, "stump")
    training.fit(prepared, candidate).write().save(path)
    nodes = models.tree_nodes(spark, path, models.feature_names(prepared.encoding))
    low = F.max("low").over(Window.partitionBy("tree"))
    side = F.when(F.col("feature").isNotNull(), "both").when(F.col("node") == low, "low")
    return nodes.withColumn("side", side.otherwise("high"))


@query
def rf_stump_checked(spark, folder):
    """A forest's best split by weighted Gini impurity, and the weighted share of positives."""
    nodes = stump_nodes(spark, folder, RF_STUMP)
    no, yes = F.get("stats", F.lit(0)), F.get("stats", F.lit(1))
    return nodes.select(
        "side",
        "feature",
        "threshold",
        F.round("gain", 9).alias("gain"),
        F.round(no + yes, 3).alias("weight"),
        F.round(yes / (no + yes), 9).alias("value"),
    )


@query
def gbt_stump_checked(spark, folder):
    """Boosting's first split by squared error on -1 and +1, and the means on both sides."""
    nodes = stump_nodes(spark, folder, GB_STUMP)
    return nodes.select(
        "side",
        "feature",
        "threshold",
        F.round("gain", 9).alias("gain"),
        F.get("stats", F.lit(0)).alias("weight"),
        F.round("prediction", 9).alias("value"),
    )


@query
def lr_gradient_checked(spark, folder):
    """The penalised gradient at the fitted coefficients, as one aggregate over the rows.

    Per feature: the gradient of the mean loss plus penalty, by the feature's largest value,
    zero at the optimum of this strength. ``zero_for`` lists the grid's strengths for which every gradient is zero: a fit
    by another strength would be caught.
    """
    prepared = training.prepare(gold_rows(spark, folder))
    model = training.fit(prepared, SMALL_LR)
    names = [*models.feature_names(prepared.encoding), "(intercept)"]
    coefficients = [*map(float, model.coefficients), 0.0]  # the intercept has no penalty
    gaps = models.loss_gradient(model, prepared.train)
    strengths = [c.params["C"] for c in models.GRID if c.model_type == "logistic_regression"]

    def gradient(strength):
        penalties = F.array(*[F.lit(b / (strength * prepared.train_rows)) for b in coefficients])
        slopes = F.zip_with("gradient", penalties, lambda g, b: g + b)
        relative = F.zip_with(slopes, "scale", lambda g, most: g / F.greatest(most, F.lit(1.0)))
        return F.transform(relative, lambda g: F.abs(F.round(g, GRADIENT_DIGITS)))

    zero_for = F.concat(
        *[
            F.when(F.array_max(gradient(c)) == 0, F.array(F.lit(str(c)))).otherwise(F.array())
            for c in strengths
        ]
    )
    own = F.arrays_zip(
        F.array(*[F.lit(n) for n in names]).alias("feature"),
        gradient(SMALL_LR.params["C"]).alias("gradient"),
    )
    return gaps.select(F.array_join(zero_for, ",").alias("zero_for"), F.explode(own).alias("row")).select(
        "row.feature", "row.gradient", "zero_for"
    )


@query
def grid_whole(spark, folder):
    """All 15 candidates through training on all rows, comparison and records."""
    out = scratch_path(spark, "experiment")
    training.train_grid(gold_rows(spark, folder), out, parallelism=5)
    return records_checked(spark, out)


def grid_out(spark, folder):
    out = scratch_path(spark, "experiment")
    training.train_grid(
        gold_rows(spark, folder), out, candidates=[SMALL_LR, SMALL_RF, SMALL_GB], parallelism=2
    )
    return out


@query
def grid_records(spark, folder):
    """Run records and leaderboard file of a grid, without what a fit decides."""
    return records_checked(spark, grid_out(spark, folder))


def records_checked(spark, out):
    runs = registry.read_runs(spark, f"{out}/runs")
    listed = spark.read.option("header", True).csv(f"{out}/leaderboard")
    best = registry.read_registry(spark, f"{out}/registry").select("run_id").withColumn("best", F.lit(1))
    ahead = F.max("roc_auc").over(Window.partitionBy())
    return (
        runs.withColumn("is_best", (F.col("roc_auc") == ahead).cast("int"))
        .join(listed.select("run_id", F.lit(1).alias("listed")), "run_id", "left")
        .join(best, "run_id", "left")
        .select(
            "seq",
            "run_name",
            "model_type",
            F.array_join(
                F.array_sort(
                    F.transform(
                        F.map_entries("params"), lambda e: F.concat_ws("=", e["key"], e["value"])
                    )
                ),
                ";",
            ).alias("params"),
            *[F.col(m).between(0, 1).cast("int").alias(f"{m}_holds") for m in S.METRICS],
            F.coalesce("listed", F.lit(0)).alias("listed"),
            (F.coalesce("best", F.lit(0)) <= F.col("is_best")).cast("int").alias("best_holds"),
        )
    )


@query
def train_report_checked(spark, folder):
    """Supports of a trained model's report, and that its averages follow from its classes."""
    report = train_report(spark, folder)
    names = ("precision", "recall", "f1_score")
    every = Window.partitionBy()

    def of(row, column):
        return F.max(F.when(F.col("row") == row, F.col(column))).over(every)

    holds = F.lit(True)
    for n in names:
        total = of("0", "support") + of("1", "support")
        mean = (of("0", n) + of("1", n)) / 2
        weighted = (of("0", n) * of("0", "support") + of("1", n) * of("1", "support")) / total
        expected = F.when(F.col("row") == "macro avg", mean).when(
            F.col("row") == "weighted avg", weighted
        )
        holds = holds & (F.abs(F.col(n) - F.coalesce(expected, F.col(n))) < 1e-9)
    return report.select("position", "row", "support", F.coalesce(holds, F.lit(True)).cast("int").alias("holds"))


@query
def request_responses_checked(spark, folder):
    """Requests as JSON lines to responses of a saved model, and that each agrees with itself."""
    gold_path, model_path = trained(spark, folder)
    path = scratch_path(spark, "requests")
    names = [f.name for f in S.request_schema()]
    features.scoring_set(read_layer(spark, gold_path)).select(*names).write.json(path)
    requests = read_requests(spark, path)
    answers = inference.respond(requests, load_model(model_path), keep=names)
    p = F.col("no_show_probability")
    decided = F.col("predicted_no_show") == 1
    holds = (
        p.between(0, 1)
        & (p == F.round(p, 4))
        & F.when(decided, p >= 0.3).otherwise(p <= 0.3)
        & (F.col("prediction_label") == F.when(decided, S.POSITIVE_LABEL).otherwise(S.NEGATIVE_LABEL))
    )
    return (
        answers.withColumn("holds", holds.cast("int"))
        .groupBy(*names, "threshold", "holds")
        .agg(F.count("*").alias("requests"))
    )


@query
def lr_moments(spark, folder):
    """The fitted regression's expected feature sums on its own training rows.

    At the optimum they equal the observed ones but for the penalty's share, so plain
    counting can check the whole fit: encoding, weights, objective and probabilities.
    """
    prepared = training.prepare(gold_rows(spark, folder), keep=["AppointmentID"])
    model = models.assemble(prepared.encoding, training.fit(prepared, SMALL_LR))
    rows = prepared.rows("train")
    scored = scoring.apply_model(split.with_class_weight(rows, prepared.weights), model)
    values = {"rows": F.lit(1.0)}
    for column, levels in (("Gender", ["Female", "Male"]), ("age_group", AGE_GROUPS)):
        values |= {level: (F.col(column) == level).cast("double") for level in levels}
    values |= {c: F.col(c).cast("double") for c in S.NUMERIC}
    expected = F.col("class_weight") * F.col("no_show_probability")
    weight = F.sum("class_weight")
    means = scored.agg(*[(F.sum(expected * v) / weight).alias(n) for n, v in values.items()])
    return means.unpivot([], list(values), "feature", "moment").withColumn(
        "moment", F.round("moment", 3)
    )


def trained(spark, folder):
    """A model saved and loaded again, and the gold layer it was trained on."""
    gold_path = write_layer(gold_rows(spark, folder), scratch_path(spark, "gold"))
    prepared = training.prepare(read_layer(spark, gold_path))
    model = models.assemble(prepared.encoding, training.fit(prepared, SMALL_LR))
    return gold_path, save_model(model, scratch_path(spark, "model"))


@query
def batch_inference(spark, folder):
    gold_path, model_path = trained(spark, folder)
    return inference.run_batch_inference(
        spark, gold_path, model_path, scratch_path(spark, "predictions")
    )


def checked(rows: DataFrame) -> DataFrame:
    """Scored rows with what must hold for any model in place of its scores."""
    p = F.col("no_show_probability")
    holds = F.col("predicted_no_show") == F.when(p >= 0.3, 1).otherwise(0)
    return rows.select(
        *S.SCORING,
        p.between(0, 1).cast("int").alias("is_probability"),
        holds.cast("int").alias("decision_holds"),
    )


@query
def batch_inference_checked(spark, folder):
    return checked(batch_inference(spark, folder))


@query
def stream_inference(spark, folder):
    _, model_path = trained(spark, folder)
    model = load_model(model_path)

    def start(out, checkpoint):
        return events.start_scoring(
            event_stream(spark, folder), model, out, checkpoint, trigger=events.WHAT_IS_THERE
        )

    return replay(spark, start, scratch_path(spark, "stream"))


@query
def stream_inference_checked(spark, folder):
    return checked(stream_inference(spark, folder))


@query
def stream_file_sink_checked(spark, folder):
    _, model_path = trained(spark, folder)
    out = scratch_path(spark, "stream")
    events.start_scoring_to_files(
        event_stream(spark, folder),
        load_model(model_path),
        out,
        scratch_path(spark, "checkpoint"),
        trigger=events.WHAT_IS_THERE,
    ).awaitTermination()
    return checked(read_layer(spark, out))


@query
def grid_leaderboard(spark, folder):
    """A candidate of each family through training, comparison and registration."""
    return training.train_grid(
        gold_rows(spark, folder),
        scratch_path(spark, "experiment"),
        candidates=[SMALL_LR, SMALL_RF, SMALL_GB],
    )


@query
def train_report(spark, folder):
    _, _, report = training.train_one(
        gold_rows(spark, folder), scratch_path(spark, "model"), SMALL_RF
    )
    return report
