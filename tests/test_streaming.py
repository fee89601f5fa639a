import pytest
from pyspark.sql import functions as F

from claimsieve.operators import cleansing, clusters, scoring
from claimsieve.operators import features as feat
from claimsieve.operators.clusters import Centroids
from claimsieve.plans import catalogue
from claimsieve.plans.catalogue import BAND
from claimsieve.streaming import scorer


@pytest.fixture(scope="module")
def arrivals(spark, claim_frame, tmp_path_factory):
    """Three files against the order of time: the newest records come first, and all repeat some of another file."""
    folder = tmp_path_factory.mktemp("arrivals")
    rows = [
        (f"C{n}", f"P{n % 90}", f"H{n % 7}" if n % 50 else None, ("J45", "", None, "INVALID-CODE-999")[n % 4 if n % 5 == 0 else 0],
         float((n * 37) % 4000 + 1) * (-1 if n % 11 == 0 else 1) * (100 if n % 97 == 0 else 1), "PAID")
        for n in range(600)
    ]
    raw = claim_frame(rows).withColumn("n", F.substring("claim_id", 2, 8).cast("int"))
    timed = raw.withColumn("service_ts", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("n") * 600))
    for i in range(3):
        part = timed.filter(f"n div 200 = {2 - i} or n % 40 = 0").drop("n")
        part.coalesce(1).write.parquet(str(folder / f"part-{i}"))
    return str(folder), timed.drop("n")


def drain(spark, stream, tmp_path):
    target = str(tmp_path / "out")
    scorer.write_new(stream, target, str(tmp_path / "progress")).awaitTermination()
    return scorer.read_target(spark, target, stream.schema)


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_stream_equals_batch(spark, arrivals, tmp_path):
    folder, timed = arrivals
    stream = scorer.clean_stream(scorer.read_files(spark, f"{folder}/part-*", timed.schema, 1))
    got = drain(spark, stream, tmp_path)
    assert rows_of(got.select(timed.columns)) == rows_of(cleansing.cleanse(timed).select(timed.columns))


def test_a_late_file_of_a_second_run_loses_nothing(spark, arrivals, tmp_path):
    folder, timed = arrivals
    into = tmp_path / "in"
    counts = []
    for i in range(3):
        spark.read.parquet(f"{folder}/part-{i}").coalesce(1).write.mode("append").parquet(str(into))
        stream = scorer.clean_stream(scorer.read_files(spark, str(into), timed.schema))
        got = drain(spark, stream, tmp_path)
        counts.append(got.count())
    assert counts[0] < counts[1] < counts[2]
    assert rows_of(got.select(timed.columns)) == rows_of(cleansing.cleanse(timed).select(timed.columns))


def test_scores_equal_batch(spark, arrivals, tmp_path):
    folder, timed = arrivals
    clean = cleansing.cleanse(timed)
    built = cleansing.drop_incomplete(feat.features(clean))
    scale = feat.population_moments(built, BAND.columns).first()
    model = Centroids(
        BAND.columns, BAND.centers,
        tuple(scale[f"mean_{c}"] for c in BAND.columns), tuple(scale[f"sd_{c}"] for c in BAND.columns),
    )
    worst = clusters.anomaly_cluster(clusters.assign(built, model)).first().anomaly_cluster
    arriving = scorer.clean_stream(scorer.read_files(spark, f"{folder}/part-*", timed.schema))
    scored = scorer.score_stream(arriving, feat.provider_baseline(clean), model, worst)
    want = scoring.gold(feat.features(clean), model)
    got = drain(spark, scored, tmp_path).select(want.columns)
    assert rows_of(got) == rows_of(want)


def test_a_stream_needs_the_trained_scale(spark, arrivals):
    folder, timed = arrivals
    stream = scorer.read_files(spark, f"{folder}/part-*", timed.schema)
    with pytest.raises(ValueError, match="scale"):
        scorer.score_stream(stream, spark.range(1), BAND, 1)


def deliver_by_state(spark, timed, parts, tmp_path, delay=86_400):
    into, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(into)
        stream = scorer.clean_stream(scorer.read_files(spark, into, timed.schema))
        scorer.write_new_by_state(stream, target, progress, "service_ts", delay).awaitTermination()
    return scorer.read_target(spark, target, stream.schema)


def test_state_and_late_records_give_what_a_batch_gives(spark, arrivals, tmp_path):
    """Each delivery repeats records of the ones before, some within the delay and some long after it, some without a time."""
    _, timed = arrivals
    rows = timed.withColumn("service_ts", F.when(F.col("claim_id") != "C7", F.col("service_ts")))
    key = F.substring("claim_id", 2, 8).cast("int")
    parts = [rows.filter(key.between(100, 300)), rows.filter(key.between(0, 450)), rows.filter(key >= 0), rows.filter(key % 3 == 0)]
    got = deliver_by_state(spark, timed, [p.unionAll(p.limit(20)) for p in parts], tmp_path)
    assert rows_of(got.select(timed.columns)) == rows_of(cleansing.cleanse(rows).select(timed.columns))
    assert spark.conf.get(scorer.STATE_STORE, None) != scorer.ROCKS_DB
    offsets = max((tmp_path / "progress" / "offsets").glob("[0-9]*"), key=lambda f: int(f.name)).read_text()
    assert "RocksDBStateStoreProvider" in offsets


def test_recent_days_are_not_read(spark, arrivals, tmp_path):
    """What is stored of the recent days cannot be read, and copies of it are found all the same."""
    _, timed = arrivals
    key = F.substring("claim_id", 2, 8).cast("int")
    first = deliver_by_state(spark, timed, [timed.filter(key >= 400)], tmp_path).count()
    hidden = 0
    for file in (tmp_path / "out").rglob("*.parquet"):
        file.write_bytes(b"not a parquet file")
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
        hidden += 1
    before = set((tmp_path / "out").rglob("*.parquet"))
    again = timed.filter((key >= 500) & (key % 2 == 0)).unionAll(timed.filter(key == 599).withColumn("claim_id", F.lit("C9999")))
    again.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = scorer.clean_stream(scorer.read_files(spark, str(tmp_path / "in"), timed.schema))
    scorer.write_new_by_state(stream, str(tmp_path / "out"), str(tmp_path / "progress"), "service_ts", 86_400).awaitTermination()
    new = [str(f) for f in set((tmp_path / "out").rglob("*.parquet")) - before]
    assert first > 100 and hidden and spark.read.parquet(*new).select("claim_id").collect() == [("C9999",)]


def test_a_lost_progress_compares_with_the_target(spark, arrivals, tmp_path):
    _, timed = arrivals
    deliver_by_state(spark, timed, [timed], tmp_path)
    stream = scorer.clean_stream(scorer.read_files(spark, str(tmp_path / "in"), timed.schema))
    scorer.write_new_by_state(stream, str(tmp_path / "out"), str(tmp_path / "other"), "service_ts", 86_400).awaitTermination()
    got = scorer.read_target(spark, str(tmp_path / "out"), stream.schema)
    assert rows_of(got.select(timed.columns)) == rows_of(cleansing.cleanse(timed).select(timed.columns))


def test_a_repeated_batch_is_stored_once(spark, arrivals, tmp_path, monkeypatch):
    """The batch is written, then the run fails before its progress is."""
    _, timed = arrivals
    key = F.substring("claim_id", 2, 8).cast("int")
    deliver_by_state(spark, timed, [timed.filter(key >= 450)], tmp_path)
    note = scorer._note

    def broken(session, progress, name=None, bound=None):
        if name is not None:
            raise RuntimeError("lost")
        return note(session, progress)

    monkeypatch.setattr(scorer, "_note", broken)
    with pytest.raises(Exception, match="lost"):
        deliver_by_state(spark, timed, [timed], tmp_path)
    monkeypatch.undo()
    got = deliver_by_state(spark, timed, [timed.limit(3)], tmp_path)
    assert rows_of(got.select(timed.columns)) == rows_of(cleansing.cleanse(timed).select(timed.columns))


def test_a_batch_with_late_records_goes_through_the_state_once(spark, arrivals, tmp_path):
    """Else join and state ran again for its late part, and every task wrote a file of every day."""
    _, timed = arrivals
    key = F.substring("claim_id", 2, 8).cast("int")
    into, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for part in (timed.filter(key >= 300), timed.filter(key < 300)):
        part.coalesce(1).write.mode("append").parquet(into)
        stream = scorer.clean_stream(scorer.read_files(spark, into, timed.schema), period="yyyy")
        query = scorer.write_new_by_state(stream, target, progress, "service_ts", 86_400)
        query.awaitTermination()
    second = scorer.clean_stream(timed.filter(key < 300)).select(scorer.RECORD).distinct().count()
    assert query.lastProgress["stateOperators"][0]["numRowsUpdated"] == second > 100
    files = spark.read.parquet(target).inputFiles()
    assert len(files) == len({f.rsplit("/", 1)[0] for f in files})
    got = scorer.read_target(spark, target, stream.schema)
    assert rows_of(got.select(timed.columns)) == rows_of(cleansing.cleanse(timed).select(timed.columns))


def test_new_records_take_one_exchange_and_large_days_several_tasks(spark, tmp_path, monkeypatch):
    """Copies within a delivery and of stored records go; the digest is 16 bytes."""
    monkeypatch.setattr(scorer, "DAY_ROWS", 100)
    rows = spark.range(700).select((F.col("id") % 600).alias("id"), F.when(F.col("id") % 600 < 500, "a").otherwise("b").alias(scorer.DAY))
    rows = rows.withColumn(scorer.RECORD, scorer.record_key([("id", "bigint")]))
    assert {len(r[0]) for r in rows.select(scorer.RECORD).collect()} == {16}
    target = str(tmp_path / "out")
    sizes = scorer.day_sizes(rows)
    assert sizes == {"a": 600, "b": 100}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows share a task
    try:
        scorer.append_new(rows.where("id < 300"), None, target, {"a": 400})
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    seen = spark.read.parquet(target)
    assert seen.count() == 300 and len(seen.inputFiles()) > 1
    scorer.append_new(rows, seen, target, sizes)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == list(range(600))


def test_a_day_is_dealt_to_one_task_and_gets_one_file(spark, tmp_path):
    """A slot that was 0 for all rows fell out of the grouping: the records were exchanged again, by digest, and every task wrote every day."""
    rows = spark.range(700).select((F.col("id") % 600).alias("id"), F.concat(F.lit("d"), F.col("id") % 3).alias(scorer.DAY))
    rows = rows.withColumn(scorer.RECORD, scorer.record_key([("id", "bigint")]))
    target = str(tmp_path / "out")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows share a task
    try:
        scorer.append_new(rows.where("id < 300"), None, target, {"d0": 100, "d1": 100, "d2": 100})
        first = spark.read.parquet(target)
        assert first.count() == 300 and len(first.inputFiles()) == 3
        scorer.append_new(rows, first, target, scorer.day_sizes(rows))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    both = spark.read.parquet(target)
    assert sorted(r.id for r in both.collect()) == list(range(600)) and len(both.inputFiles()) == 6


def test_scores_are_added_to_new_records_only(spark, arrivals, tmp_path):
    """They come after copies are gone, so a batch is kept and exchanged without them; the result is that of a batch."""
    folder, timed = arrivals
    clean = cleansing.cleanse(timed)
    built = cleansing.drop_incomplete(feat.features(clean))
    scale = feat.population_moments(built, BAND.columns).first()
    means, deviations = (tuple(scale[f"{m}_{c}"] for c in BAND.columns) for m in ("mean", "sd"))
    model = Centroids(BAND.columns, BAND.centers, means, deviations)
    worst = clusters.anomaly_cluster(clusters.assign(built, model)).first().anomaly_cluster
    baseline, seen = feat.provider_baseline(clean), []

    def scored(records):
        seen.append((records.where("hospital_id IS NOT NULL").count(), set(records.columns)))  # others are not stored and come again
        return scorer.score_stream(records, baseline, model, worst, small=True)

    target = str(tmp_path / "out")
    for parts in ("part-0", "part-[01]", "part-*"):
        stream = scorer.clean_stream(scorer.read_files(spark, f"{folder}/{parts}", timed.schema))
        scorer.write_new(stream, target, str(tmp_path / "progress"), scored).awaitTermination()
    per_run = [n for n, _ in seen]
    assert len(per_run) == 3 and sum(per_run) == clean.where("hospital_id IS NOT NULL").count() and all(names == set(stream.columns) for _, names in seen)
    want = scoring.gold(feat.features(clean), model)
    got = spark.read.parquet(target)
    assert rows_of(got.select(want.columns)) == rows_of(want)


def test_a_scored_stream_is_scored_after_the_exchange_where_the_baseline_is_small(spark, monkeypatch):
    """Where it is not, the join exchanges the records anyway and comes first; the result is that of a batch."""
    small, folder, delivered, seen = [True], "/root/testdata/sf0.001", catalogue._delivered, []
    monkeypatch.setattr(catalogue, "providers_fit", lambda spark, folder: small[0])
    monkeypatch.setattr(catalogue, "_delivered", lambda *args, **named: seen.append(sorted(named)))
    catalogue.stream_gold(spark, folder)
    assert seen == [["finish"]]
    small[0] = False
    monkeypatch.setattr(catalogue, "_delivered", delivered)
    got = catalogue.stream_gold(spark, folder)
    want = catalogue.gold(spark, folder)
    assert rows_of(got.select(want.columns)) == rows_of(want)
