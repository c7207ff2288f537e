"""The README usage workflow runs end to end (small driver tables)."""

import os
import tempfile

from ptloom.operators import build, classify, evaluate, split, validate
from ptloom.plans import derived
from ptloom.sources import textio
from ptloom.sources.tables import Tables

SF = "/root/testdata/sf0.001"


def test_readme_workflow(spark):
    t = Tables(spark, SF)
    base = tempfile.mkdtemp(prefix="ptloom-usage-")
    # chat data
    textio.write_text_lines(derived.raw_chat_lines(t), "value", os.path.join(base, "chat"))
    lines = textio.read_lines(spark, os.path.join(base, "chat"))
    checked = validate.validate_chat(lines)
    summary = validate.chat_summary(checked, ["file"]).collect()
    assert sum(r.n_checked for r in summary) == checked.count()
    clean, quarantine = validate.split_valid(checked)
    tv = split.exact_split(clean, "record_id", 0.2)
    assert tv.count() == clean.count() and tv.where("split = 'val'").count() == max(1, round(clean.count() * 0.2))
    # preference data
    recs = build.preference_record(build.expand_pairs(derived.toolcalls(t)))
    recs = recs.withColumn("value", build.preference_json_line(recs))
    textio.write_text_lines(recs, "value", os.path.join(base, "pref"))
    report = validate.validate_preference(textio.read_lines(spark, os.path.join(base, "pref")))
    tot = validate.preference_file_summary(report).groupBy().sum("n_examples", "n_errors").collect()[0]
    assert tot[0] == recs.count() and tot[1] == 0
    dist = classify.type_distribution(report.where("rejected_type IS NOT NULL")).collect()
    assert sum(r.n for r in dist) == recs.count()
    # model outputs
    scored = evaluate.score(evaluate.evaluate_output(derived.outputs(t)))
    assert {r.model for r in evaluate.model_summary(scored).collect()} == {"base", "tuned"}
    w = evaluate.win_rate(evaluate.compare_models(scored, "base", "tuned"), "base", "tuned").collect()[0]
    assert w.n_improved + w.n_regressed + w.n_tied == w.n
