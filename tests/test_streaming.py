"""The complaint classifier on a file stream gives the batch answer."""

from churnlab.operators.complaints import classify_support_tickets
from churnlab.streaming.tickets import TICKET_SCHEMA, classify_stream


def test_stream_matches_batch(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    rows = [(1, 10, "please cancel my plan", None), (2, 11, "my bill is wrong", "billing")]
    spark.createDataFrame(rows, TICKET_SCHEMA).write.parquet(str(src / "part1"))
    spark.createDataFrame([(3, 12, "slow speed all day", None)], TICKET_SCHEMA).write.parquet(
        str(src / "part2")
    )
    src_glob = str(src / "*")
    query = classify_stream(spark, src_glob, str(out), checkpoint_location=str(tmp_path / "ck"),
                            trigger_once=True)
    query.awaitTermination(120)
    got = {r["ticket_id"]: r["complaint_category_predicted"] for r in spark.read.parquet(str(out)).collect()}
    batch = classify_support_tickets(spark.createDataFrame(rows + [(3, 12, "slow speed all day", None)], TICKET_SCHEMA))
    want = {r["ticket_id"]: r["complaint_category_predicted"] for r in batch.collect()}
    assert got == want == {1: "cancellation_request", 2: "billing", 3: "slow_internet"}


def test_restart_processes_each_file_once(spark, tmp_path):
    src, out, ck = tmp_path / "in", tmp_path / "out", str(tmp_path / "ck")
    spark.createDataFrame([(1, 10, "cancel now", None)], TICKET_SCHEMA).write.parquet(str(src / "a"))
    q = classify_stream(spark, str(src / "*"), str(out), checkpoint_location=ck, trigger_once=True)
    q.awaitTermination(120)
    spark.createDataFrame([(2, 11, "bill too high", None)], TICKET_SCHEMA).write.parquet(str(src / "b"))
    q = classify_stream(spark, str(src / "*"), str(out), checkpoint_location=ck, trigger_once=True)
    q.awaitTermination(120)
    ids = sorted(r["ticket_id"] for r in spark.read.parquet(str(out)).collect())
    assert ids == [1, 2]  # the restarted query resumed from its checkpoint: no duplicates
