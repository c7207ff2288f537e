import json
import os
import tempfile

from ptloom.streaming.validate_stream import start_chat_validation


def test_stream_validation_quarantine(spark):
    base = tempfile.mkdtemp(prefix="ptloom-stream-")
    inp = os.path.join(base, "in")
    os.makedirs(inp)
    good = json.dumps({"id": "a", "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "r"}]})
    with open(os.path.join(inp, "part1.jsonl"), "w") as f:
        f.write(good + "\n\n" + '{"id": "b"' + "\n")
    q = start_chat_validation(spark, inp, os.path.join(base, "out"), os.path.join(base, "ckpt"))
    q.awaitTermination(120)
    clean = spark.read.parquet(os.path.join(base, "out", "clean"))
    bad = spark.read.parquet(os.path.join(base, "out", "quarantine"))
    assert clean.count() == 1 and bad.count() == 1
    assert bad.collect()[0].errors[0].rule == "invalid_json"


def test_stream_preference_summary(spark):
    from ptloom.streaming.validate_stream import start_preference_validation

    base = tempfile.mkdtemp(prefix="ptloom-pstream-")
    inp = os.path.join(base, "in")
    os.makedirs(inp)
    rec = {"prompt": [{"role": "user", "content": "q"}],
           "chosen": [{"role": "assistant", "content": '{"tool":"a","arguments":{"x":1}}'}],
           "rejected": [{"role": "assistant", "content": '{"tool":"a","arguments":{}}'}]}
    with open(os.path.join(inp, "train.jsonl"), "w") as f:
        f.write(json.dumps(rec) + "\n" + '{"prompt": [' + "\n")
    with open(os.path.join(inp, "val.jsonl"), "w") as f:
        f.write(json.dumps(rec) + "\n")
    q = start_preference_validation(spark, inp, os.path.join(base, "out"), os.path.join(base, "ckpt"))
    q.awaitTermination(120)
    s = {os.path.basename(r.file): (r.n_examples, r.n_errors) for r in spark.read.parquet(os.path.join(base, "out", "summary")).collect()}
    assert s == {"train.jsonl": (2, 1), "val.jsonl": (1, 0)}
    t = spark.read.parquet(os.path.join(base, "out", "rejected_types")).collect()
    assert sorted((os.path.basename(r.file), r.rejected_type, r["count"]) for r in t) == [
        ("train.jsonl", "empty_arguments", 1), ("val.jsonl", "empty_arguments", 1)]
