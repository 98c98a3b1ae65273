import json
import uuid

import pytest
from pyspark.sql import functions as F

from gleanery.operators import moderation as mod
from gleanery.sources.arrivals import stream_reviews
from gleanery.streaming import review_stream as rs


@pytest.fixture
def lexicon(spark):
    return spark.createDataFrame([("damn",)], "word string")


class Landing:
    def __init__(self, root):
        self.root = root
        self.dir = root / "landing"
        self.dir.mkdir()

    def put(self, *rows):
        (self.dir / f"{uuid.uuid4().hex}.json").write_text("\n".join(json.dumps(r) for r in rows))

    def path(self, name):
        return str(self.root / name)


@pytest.fixture
def landing(tmp_path):
    return Landing(tmp_path)


def _review(i, user, text="a damn thing"):
    return {"sourceId": f"devset-{i:06d}", "reviewerID": user, "summary": "s", "reviewText": text, "overall": 1}


def _moderated(spark, landing, lexicon, per_trigger=1):
    stream = stream_reviews(spark, str(landing.dir), per_trigger)
    return mod.moderate(mod.with_review_id(stream), lexicon)


def test_user_state_over_batches_and_restarts(spark, landing, lexicon):
    log, cp = landing.path("users"), landing.path("cp")

    def run(dedupe=True):
        return rs.run_available(
            rs.start_user_counts(_moderated(spark, landing, lexicon), log, cp, 3, dedupe), 120
        )

    for i in range(3):
        landing.put(_review(i, "u1"))
    landing.put(_review(10, "u2", "clean"))
    assert run()
    users = {r.userId: (r.impoliteCount, r.banned) for r in rs.users_table(spark, log).collect()}
    assert users == {"u1": (3, False), "u2": (0, False)}
    # A redelivered review changes nothing; the fourth one bans, a later clean one does not lift it.
    landing.put(_review(2, "u1"))
    landing.put(_review(3, "u1"))
    landing.put(_review(4, "u1", "clean"))
    assert run()
    users = {r.userId: (r.impoliteCount, r.banned) for r in rs.users_table(spark, log).collect()}
    assert users == {"u1": (4, True), "u2": (0, False)}
    assert [r.userId for r in rs.ban_reports(spark, log).collect()] == ["u1"]


def test_without_dedupe_redelivery_counts_twice(spark, landing, lexicon):
    log = landing.path("users")
    for _ in range(2):
        landing.put(_review(1, "u1"))
    rs.run_available(
        rs.start_user_counts(_moderated(spark, landing, lexicon), log, landing.path("cp"), 3, dedupe=False)
    )
    assert rs.users_table(spark, log).first().impoliteCount == 2


def test_stream_equals_batch(spark, landing, lexicon):
    rows = [_review(i, f"u{i % 3}", "a damn thing" if i % 2 else "fine") for i in range(30)]
    for i in range(0, 30, 6):
        landing.put(*rows[i : i + 6])
    out = landing.path("out")
    rs.run_available(rs.start_append(_moderated(spark, landing, lexicon, 2), out, landing.path("cp")))
    streamed = spark.read.parquet(out).orderBy("reviewId").collect()
    batch = mod.moderate(
        mod.with_review_id(spark.read.schema(stream_reviews(spark, str(landing.dir)).schema).json(str(landing.dir))), lexicon
    )
    assert streamed == batch.orderBy("reviewId").collect()
    users = rs.start_user_counts(_moderated(spark, landing, lexicon), landing.path("users"), landing.path("cp2"), 3)
    rs.run_available(users)
    got = rs.users_table(spark, landing.path("users")).orderBy("userId").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in mod.user_bans(batch).orderBy("userId").collect()]


def test_processed_reviews_as_json(spark, landing, lexicon):
    landing.put(_review(1, "u1"))
    out = landing.path("json")
    rs.run_available(
        rs.start_append(_moderated(spark, landing, lexicon), out, landing.path("cp"), format="json")
    )
    assert spark.read.json(out).first().profanityCheck == "impolite"


def test_change_logs_merge_to_the_review_table(spark, landing):
    rows = spark.createDataFrame([("r1", "u1", "s", "t", "clean"), ("r2", "u1", "s", "t", "impolite")],
                                 "reviewId string, userId string, summary string, reviewText string, profanityCheck string")
    rows = rows.withColumn("overall", F.lit(1).cast("decimal(3,1)"))
    m, s = landing.path("m"), landing.path("s")
    rs.write_changes(rows, m, 0)
    label = spark.createDataFrame([("r1", "neutral", "0.0", None)], "reviewId string, sentiment string, sentimentScore string, ratingSentimentAgreement boolean")
    rs.write_changes(label, s, 0)
    table = rs.reviews_table(spark, m, s)
    assert {r.reviewId: r.sentiment for r in table.collect()} == {"r1": "neutral", "r2": "pending"}
    # A replayed batch overwrites itself, a later one wins.
    rs.write_changes(label, s, 0)
    rs.write_changes(label.withColumn("sentiment", F.lit("positive")).unionByName(
        label.withColumn("reviewId", F.lit("r2"))), s, 1)
    got = {r.reviewId: r.sentiment for r in rs.reviews_table(spark, m, s).collect()}
    assert got == {"r1": "positive", "r2": "neutral"}


def test_timeout_stops_the_query(spark, landing, lexicon):
    landing.put(_review(1, "u1"))

    def slow(batch, batch_id):
        import time

        time.sleep(5)

    query = rs.start_batches(_moderated(spark, landing, lexicon), landing.path("cp"), slow)
    assert rs.run_available(query, timeout=1) is False
    assert not query.isActive


def test_compacted_log_has_the_newest_rows(spark, tmp_path):
    log, into = f"{tmp_path}/log", f"{tmp_path}/compact"
    for batch, rows in enumerate([[("u1", 1, False), ("u2", 1, False)], [("u1", 4, True)], [("u3", 2, False)]]):
        frame = spark.createDataFrame(rows, "userId string, impoliteCount long, banned boolean")
        rs.write_changes(frame, log, batch)
    rs.compact(spark, log, into, rs.USER_CHANGES, "userId")
    want = {("u1", 4, True), ("u2", 1, False), ("u3", 2, False)}
    assert {tuple(r) for r in rs.users_table(spark, into).collect()} == want
    rs.write_changes(spark.createDataFrame([("u2", 9, True)], "userId string, impoliteCount long, banned boolean"), into, 3)
    assert ("u2", 9, True) in {tuple(r) for r in rs.users_table(spark, into).collect()}


def test_ids_are_dropped_behind_the_watermark(spark, tmp_path):
    rows = spark.createDataFrame(
        [("r1", "u", "impolite", 1_700_000_000), ("r1", "u", "impolite", 1_700_000_000), ("r2", "u", "impolite", 1_700_000_060)],
        "reviewId string, userId string, profanityCheck string, seconds long",
    )
    rows.select("reviewId", "userId", "profanityCheck", F.timestamp_seconds("seconds").alias("ts")).coalesce(1).write.parquet(
        f"{tmp_path}/in"
    )
    stream = spark.readStream.schema("reviewId string, userId string, profanityCheck string, ts timestamp").parquet(f"{tmp_path}/in")
    query = rs.start_user_counts(stream, f"{tmp_path}/log", f"{tmp_path}/cp", 1, event_time="ts", delay="1 hour")
    rs.run_available(query)
    assert [tuple(r) for r in rs.users_table(spark, f"{tmp_path}/log").collect()] == [("u", 2, True)]


def test_outer_join_of_two_streams(spark, tmp_path):
    """Sides meet in any order; what stays alone comes out once the watermark has passed, and late rows are dropped."""
    left = "reviewId string, userId string, summary string, reviewText string, overall decimal(3,1), profanityCheck string, arrived timestamp"
    right = "reviewId string, sentiment string, sentimentScore string, ratingSentimentAgreement boolean, arrived timestamp"

    def add(side, schema, rows):
        table = spark.createDataFrame(rows, schema.replace("arrived timestamp", "seconds long"))
        times = table.withColumn("arrived", F.timestamp_seconds("seconds")).drop("seconds")
        times.write.mode("append").parquet(f"{tmp_path}/{side}")

    def moderated(i, at):
        return (i, "u", "", "", None, "clean", at)

    def scored(i, at):
        return (i, "positive", "0.5", True, at)

    def run():
        sides = [spark.readStream.schema(s).parquet(f"{tmp_path}/{name}") for name, s in (("left", left), ("right", right))]
        rs.run_available(rs.start_append(rs.joined_reviews(*sides), f"{tmp_path}/out", f"{tmp_path}/cp"))
        rows = spark.read.parquet(f"{tmp_path}/out").collect()
        return sorted((r.reviewId, r.userId, r.sentiment) for r in rows)

    hour = 3600
    add("left", left, [moderated("both", 10), moderated("first", 20), moderated("alone", 30)])
    add("right", right, [scored("both", 11), scored("only", 40)])
    assert run() == [("both", "u", "positive")]
    add("right", right, [scored("first", 50)])
    assert run() == [("both", "u", "positive"), ("first", "u", "positive")]
    add("left", left, [moderated("new", 9 * hour)])
    add("right", right, [scored("new", 9 * hour)])
    everything = [("alone", "u", "pending"), ("both", "u", "positive"), ("first", "u", "positive"), ("new", "u", "positive"), ("only", None, "positive")]
    assert run() == everything
    add("right", right, [scored("alone", 60)])
    assert run() == everything
