"""Benchmark: seconds per headline query; prints one JSON line.

BENCH_SF_DIR picks the data (default sf0.1), BENCH_CPUS the local cores (default 8).

* Relational queries are produced in full through a no-op sink, including every job they start
  while they are built. They run once untimed at the smallest scale, which loads and compiles
  the JVM code, then once timed.
* ``layout_write`` writes the bucketed layout; ``layout_feature_table_*`` read it.
* ``stage_*`` builds a feature table and writes it for the fits.
* ``prepare_*`` splits, assembles, scales and caches the training rows.
* ``fit_*`` is the training alone, on cached rows; ``score_*`` predicts the test part and
  computes its metrics. The fits are not warmed up.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Estimator
from pyspark.sql import DataFrame, SparkSession

from contest_analytics.operators import features, learning
from contest_analytics.plans import catalog
from contest_analytics.session import cut_lineage, local_session, scratch_path, scratch_scope
from contest_analytics.sources import bucketed, standins

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_DIR = "/root/testdata/sf0.001"

ANALYTICS = ["rate_trend", "phase_win_rate", "period_stats", "bucket_win_rate"]
RELATIONAL = ANALYTICS + [
    "top_volatile",
    "topk_series",
    "bucket_share",
    "side_pick_counts",
    "participant_totals",
    "feature_table_outcome",
    "feature_table_duration",
    "feature_table_compact",
    "auc_metric",
]


class Stopwatch:
    """Seconds by name."""

    def __init__(self) -> None:
        self.seconds: dict[str, float] = {}

    def run(self, name: str, work: Callable):
        start = time.perf_counter()
        result = work()
        self.seconds[name] = round(time.perf_counter() - start, 3)
        return result


def produce(spark: SparkSession, name: str, folder: str) -> None:
    catalog.queries()[name](spark, folder).write.format("noop").mode("overwrite").save()


def train(
    watch: Stopwatch,
    task: str,
    table: DataFrame,
    columns: Sequence[str],
    label: str,
    estimators: Mapping[str, Callable[[], Estimator]],
    evaluate: Callable[[DataFrame, str, str], DataFrame],
) -> None:
    staged = watch.run(f"stage_{task}", lambda: cut_lineage(table.select("match_id", label, *columns)))

    def prepare() -> learning.Prepared:
        ready = learning.prepare(staged, columns, label, "match_id")
        ready.train.count()
        return ready

    data = watch.run(f"prepare_{task}", prepare)
    for name, make in estimators.items():
        model = watch.run(f"fit_{task}_{name}", lambda: learning.fit(data, make()))
        watch.run(
            f"score_{task}_{name}", lambda: evaluate(learning.score(data, model), label, name).collect()
        )
    data.release()


def main() -> None:
    spark = local_session(CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    watch = Stopwatch()
    for name in RELATIONAL:
        produce(spark, name, WARM_DIR)
    for name in RELATIONAL:
        watch.run(name, lambda: produce(spark, name, SF_DIR))

    tables = standins.load(spark, SF_DIR)
    with scratch_scope(spark) as scope:
        folder = scope.own(scratch_path(spark, "layout"))
        watch.run("layout_write", lambda: bucketed.write_layout(tables, folder))
        laid = bucketed.load_layout(spark, folder)
        for name, build in (("outcome", features.outcome_table), ("duration", features.duration_table)):
            table = build(laid, catalog.KINDS)
            watch.run(f"layout_feature_table_{name}", lambda: table.write.format("noop").mode("overwrite").save())
        bucketed.detach_layout(spark, folder)
    outcome = (features.OUTCOME_LABEL, learning.CLASSIFIERS, learning.classifier_metrics)
    duration = (features.DURATION_LABEL, learning.REGRESSORS, learning.regressor_metrics)
    train(watch, "outcome", features.outcome_table(tables, catalog.KINDS), features.OUTCOME_FEATURES, *outcome)
    train(watch, "duration", features.duration_table(tables, catalog.KINDS), features.DURATION_FEATURES, *duration)
    train(
        watch,
        "outcome_light",
        features.outcome_table_compact(tables, catalog.KINDS),
        features.OUTCOME_FEATURES_COMPACT,
        features.OUTCOME_LABEL,
        learning.LIGHT_CLASSIFIERS,
        learning.classifier_metrics,
    )
    train(
        watch,
        "duration_light",
        features.duration_table_compact(tables, catalog.KINDS),
        features.DURATION_FEATURES_COMPACT,
        features.DURATION_LABEL,
        learning.LIGHT_REGRESSORS,
        learning.regressor_metrics,
    )
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(watch.seconds.values()), 3),
                "unit": "sec",
                "queries": watch.seconds,
                "analytics_total": round(sum(watch.seconds[name] for name in ANALYTICS), 3),
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
