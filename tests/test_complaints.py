"""complaint classification."""

from pyspark.sql import functions as F

from churnlab.functions.scalar import normalize_label
from churnlab.operators import complaints

COLS = "ticket_id string, customer_id string, ticket_text string, complaint_category_seed string"


def fake_factory(acc):
    def build():
        answers = {
            "I want to cancel my service.": ("cancellation request", 0.91),
            "My bill is too high.": ("billing", 0.82),
        }

        def classify(text, candidate_labels, multi_label=False):
            acc.add(1)
            label, score = answers.get(text, ("billing", 0.5))
            rest = [lab for lab in candidate_labels if lab != label]
            return {"labels": [label, *rest], "scores": [score] + [0.0] * len(rest)}

        return classify

    return build


def test_fake_classifier_columns(spark):
    tickets = spark.createDataFrame(
        [("tic_1", "c1", "I want to cancel my service.", "cancellation_request"),
         ("tic_2", "c2", "My bill is too high.", "billing")],
        COLS,
    )
    acc = spark.sparkContext.accumulator(0)
    rows = {r["ticket_id"]: r for r in complaints.classify_with(tickets, fake_factory(acc)).collect()}
    assert rows["tic_1"]["complaint_category_predicted"] == "cancellation_request"
    assert rows["tic_1"]["complaint_category_score"] == 0.91
    assert rows["tic_2"]["complaint_category_predicted"] == "billing"
    assert rows["tic_1"]["complaint_category_matches_seed"] and rows["tic_2"]["complaint_category_matches_seed"]


def test_repeated_text_classified_once_and_null_text_kept(spark):
    text = "My bill is too high."
    tickets = spark.createDataFrame(
        [(f"t{i}", f"c{i}", text, None if i == 0 else "billing") for i in range(40)]
        + [("t_null", "cx", None, "billing")],
        COLS,
    )
    acc = spark.sparkContext.accumulator(0)
    out = complaints.classify_with(tickets, fake_factory(acc))
    rows = {r["ticket_id"]: r for r in out.collect()}
    assert acc.value == 1  # one distinct non-null text -> one classifier call
    assert len(rows) == 41
    assert rows["t_null"]["complaint_category_predicted"] is None
    assert rows["t_null"]["complaint_category_matches_seed"] is False
    assert rows["t0"]["complaint_category_matches_seed"] is False  # null seed -> false


def test_label_normalisation(spark):
    df = spark.createDataFrame([("Cancellation Request",), ("slow internet",)], "l string")
    assert [r[0] for r in df.select(normalize_label("l")).collect()] == ["cancellation_request", "slow_internet"]


def test_builtin_lexicon_classifier(spark):
    tickets = spark.createDataFrame(
        [("a", "c", "Please CANCEL: I will cancel and leave; my bill too.", None),
         ("b", "c", "No keywords here", None),
         ("c", "c", None, None),
         ("d", "c", "slow speed, slow lag; router broken", None)],
        COLS,
    )
    rows = {r["ticket_id"]: r for r in complaints.classify_support_tickets(tickets).collect()}
    assert rows["a"]["complaint_category_predicted"] == "cancellation_request"
    assert rows["a"]["complaint_category_score"] == 0.75  # 3 of 4 hits
    assert rows["b"]["complaint_category_predicted"] == "billing"  # no hit -> first label
    assert rows["b"]["complaint_category_score"] == 0.0
    assert rows["c"]["complaint_category_predicted"] is None
    assert rows["d"]["complaint_category_predicted"] == "slow_internet"


def test_native_and_python_lexicon_agree(spark):
    texts = ["the cat and the dog", "of to in is", "THE_the the-the", "", "x", "that it was for on"]
    tickets = spark.createDataFrame([(str(i), "c", t, None) for i, t in enumerate(texts)], COLS)
    lex = complaints.COMMON_WORD_LEXICON
    native = {r[0]: (r[1], r[2]) for r in complaints.classify_support_tickets(tickets, lex)
              .select("ticket_id", "complaint_category_predicted", "complaint_category_score").collect()}
    python = {r[0]: (r[1], r[2]) for r in complaints.classify_with(tickets, lambda: complaints.LexiconClassifier(lex))
              .select("ticket_id", "complaint_category_predicted", "complaint_category_score").collect()}
    assert native == python


def test_whole_text_is_read(spark):
    long_text = ("filler " * 50000) + "cancel"
    tickets = spark.createDataFrame([("t", "c", long_text, None)], COLS)
    row = complaints.classify_support_tickets(tickets).first()
    assert row["complaint_category_predicted"] == "cancellation_request"


def test_batch_classifier_gets_whole_batches(spark):
    class Batch:
        def classify_batch(self, texts, candidate_labels, multi_label=False):
            return [{"labels": ["billing" if "fee" in t else "slow internet"], "scores": [len(texts) / 100]} for t in texts]

    tickets = spark.createDataFrame([(str(i), "c", f"{'fee' if i % 2 else 'lag'} {i}", "billing") for i in range(20)], COLS)
    rows = complaints.classify_with(tickets.coalesce(1), Batch).collect()
    assert len(rows) == 20 and {r["complaint_category_predicted"] for r in rows} == {"billing", "slow_internet"}
    assert all(r["complaint_category_matches_seed"] == (int(r["ticket_id"]) % 2 == 1) for r in rows)
    assert max(r["complaint_category_score"] for r in rows) > 0.01  # more than one text a call
