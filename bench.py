"""Benchmark the headline plans at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each stage runs its full plan with a ``noop`` write (every row produced, none
collected). Model fits are timed as their own stages and reused afterwards,
as a train-then-infer run would. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketry.session import get_spark  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus, app_name="basketry-bench",
                      driver_memory="16g")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="basketry-bench-"))

    from basketry.operators import metrics as met
    from basketry.plans import catalog as cat
    from basketry.plans import common as cm

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    stages = {
        "load_csv": lambda: run(cat.q_load_csv(spark, sf_dir)),
        "load_json": lambda: run(cat.q_load_json(spark, sf_dir)),
        "split": lambda: run(cm.split(spark, sf_dir).folds),
        "encode": lambda: run(cat.q_interaction_matrix(spark, sf_dir)),
        "rules_fit": lambda: cm.brand_rules(spark, sf_dir),
        "rule_recommend": lambda: run(cat.q_rule_recommend(spark, sf_dir)),
        "rule_recommend_basket": lambda: run(cat.q_rule_recommend_basket(spark, sf_dir)),
        "eval_rules": lambda: run(cat.q_eval_summary(spark, sf_dir)),
        "reports": lambda: [run(cat.q_score_histogram(spark, sf_dir)),
                            run(cat.q_user_report(spark, sf_dir)),
                            run(cat.q_ndcg_stats(spark, sf_dir))],
        "als_fit": lambda: cm.als_model(spark, sf_dir),
        "als_recommend": lambda: run(cat.q_als_recommend(spark, sf_dir)),
        "als_recommend_new": lambda: run(cat.q_als_recommend_new(spark, sf_dir)),
        "predictions_write": lambda: run(cat.q_predictions_roundtrip(spark, sf_dir)),
        "stream_baskets": lambda: run(cat.q_stream_rule_recommend(spark, sf_dir)),
        "eval_als": lambda: run(met.evaluate(
            cm.als_model(spark, sf_dir).recommend(
                cm.truth(spark, sf_dir).select("user_id").distinct(), 20),
            cm.truth(spark, sf_dir), cm.KS)[0]),
    }
    # The total keeps to the stages of the first round's bench, so that it can be compared.
    extra = {"load_csv", "load_json", "als_recommend_new", "predictions_write", "stream_baskets"}
    only = [s for s in os.environ.get("BENCH_ONLY", "").split(",") if s]
    timings = {}
    for name, fn in stages.items():
        if only and name not in only:
            continue
        t0 = time.time()
        fn()
        timings[name] = round(time.time() - t0, 3)
        print(f"{name}: {timings[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "train_infer_total", "value": round(sum(v for k, v in timings.items() if k not in extra), 3),
                      "unit": "sec", "queries": timings, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
