"""The physical plans: what is read, what is shuffled, what runs in Python."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from clipframe.operators import scoring, signal, stats
from clipframe.operators.features import clip_features
from clipframe.operators.preprocess import ClipSpec
from clipframe.plans import jobs
from clipframe.plans import standins as S
from clipframe.plans.queries import REGISTRY
from clipframe.session import spread
from clipframe.sources import scan
from clipframe.sources.wav import with_headers

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_path_scan_reads_no_content(spark, tmp_path, wav_cases):
    (tmp_path / "a.wav").write_bytes(wav_cases["mono16"])
    assert "content" not in plan_of(scan.scan_paths(spark, str(tmp_path)))
    small = plan_of(scan.oversized(spark, str(tmp_path), max_bytes=10))
    assert "content" not in small and "PushedFilters" in small and "length" in small


@needs_tables
@pytest.mark.parametrize("name", ["union_corpora", "label_iemocap"])
def test_labels_stay_in_the_jvm(spark, name):
    plan = plan_of(REGISTRY[name](spark, SF))
    assert "Python" not in plan and "Arrow" not in plan
    assert ("Exchange" in plan) == (name == "label_iemocap")


@needs_tables
def test_label_scan_reads_two_columns(spark):
    plan = plan_of(REGISTRY["label_coraa"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan


@needs_tables
def test_split_does_not_move_the_data(spark):
    documents = S.table(spark, SF, "documents").select("doc_id", "lang")
    plan = plan_of(jobs.split.stratified_split(documents, "lang", "doc_id"))
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan and "Sort" not in plan and "Window" not in plan


@needs_tables
def test_signal_chain_is_one_python_pass(spark):
    clips = spark.range(0, 100, 1, 8).select("id", F.lit(bytearray(b"RIFF")).alias("content"))
    spec = ClipSpec(apply_dbfs_norm=True)
    for df in (signal.clip_loudness(clips, ["id"]), clip_features(clips, spec, ["id"])):
        plan = plan_of(df)
        assert plan.count("MapInArrow") == 1 and "Exchange" not in plan


def test_header_columns_cost_one_call(spark):
    clips = spark.range(0, 100, 1, 8).select("id", F.lit(bytearray(b"RIFF")).alias("content"))
    plan = plan_of(with_headers(clips))
    assert plan.count("ArrowEvalPython") == 1 and plan.count("_header(") == 1


@needs_tables
def test_only_small_inputs_are_spread(spark):
    few, many = spark.range(0, 100, 1, 1), spark.range(0, 100, 1, 64)
    assert "Exchange" in plan_of(spread(few, "id"))
    assert "Exchange" not in plan_of(spread(many, "id"))


@needs_tables
def test_preprocess_shuffles_audio_once(spark):
    plan = plan_of(REGISTRY["preprocess_test"](spark, SF))
    assert plan.count("MapInArrow") == 1
    assert "ShuffledHashJoin" in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scores_shuffle_counts_only(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("truth"), (F.col("id") % 4).alias("pred"))
    plan = plan_of(scoring.macro_f1(df))
    assert plan.index("partial_count") > 0 and "Sort" not in plan


@needs_tables
def test_no_query_multiplies_rows(spark):
    for name in ("annotation_missing", "label_encode", "pred_truth_pairing", "duration_stats",
                 "clip_duration_stats", "label_decode", "union_counts"):
        plan = plan_of(REGISTRY[name](spark, SF))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


@needs_tables
def test_hot_class(spark):
    """A class with nearly all rows: same split as without the hot class's help."""
    documents = S.table(spark, SF, "documents").select("doc_id", F.lit("hot").alias("lang"))
    out = jobs.split.stratified_split(documents, "lang", "doc_id")
    n = documents.count()
    assert out.filter("split = 'dev'").count() == -(-n // 5)
    levels = signal.sample_loudness(
        S.table(spark, SF, "events").withColumn("k", F.lit(1)), ["k"], F.col("value"))
    assert levels.first().num_samples == S.table(spark, SF, "events").count()
    assert stats.corpus_counts(documents, "lang").first().n == n


WITHOUT_PACKAGE = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from clipframe.session import build_session
spark = build_session("away", "local[2]", **{{"spark.sql.shuffle.partitions": "2"}})
for name in ("preprocess_test", "augment_compose", "feature_vector", "wav_header",
             "ingest_clips", "score_batches", "batch_predict", "load_by_path"):
    assert entry.queries()[name](spark, {sf!r}).count() > 0
print("all ran")
"""


@needs_tables
def test_workers_need_no_copy_of_the_package(tmp_path):
    """The workers start in another folder, where the package cannot be imported."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", WITHOUT_PACKAGE.format(repo=repo, sf=SF)],
                          cwd=tmp_path, env=environment, capture_output=True, text=True)
    assert "all ran" in done.stdout, done.stderr[-3000:]
