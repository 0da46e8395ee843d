"""Headline timings. Prints one JSON line.

BENCH_SF_DIR  input tables (default /root/testdata/sf0.1)
BENCH_CPUS    cores for local mode (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from textloom.functions.ngrams import char_analyzer, word_analyzer  # noqa: E402
from textloom.operators.classifiers import BernoulliNB, MultinomialNB, Rocchio  # noqa: E402
from textloom.operators.passive_aggressive import PassiveAggressive  # noqa: E402
from textloom.queries import QUERIES  # noqa: E402
from textloom.queries.registry import feature_corpus  # noqa: E402
from textloom.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

MODELS = {
    "mnb_char": MultinomialNB(char_analyzer(3, 5), 3, 80000),
    "mnb_word": MultinomialNB(word_analyzer(1, 2), 2, 60000),
    "bnb": BernoulliNB(word_analyzer(1, 2), 2, 40000),
    "rocchio": Rocchio(word_analyzer(1, 2), 2, 60000),
    "pa": PassiveAggressive(word_analyzer(1, 2), 2**20, epochs=4, c=0.5, seed=42),
}
HEADLINE = (
    "top_words", "clean_text", "dedup_first", "build_corpus", "stratified_split", "corpus_profile", "duplicate_count",
    "vocabulary", "tfidf_log", "hashed_features", "mean_pool", "tune_threshold", "token_attribution", "model_comparison",
)


def run(df: DataFrame) -> None:
    """Compute every row without bringing it to the driver."""
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    start = time.perf_counter()
    fn()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = local_session(CPUS, "bench", "20g")
    docs = feature_corpus(spark, SF_DIR)
    train, test = docs.filter(F.col("split") == "train"), docs.filter(F.col("split") == "test")
    # Warm up the JVM and the Python workers on the valid split, which no timed run reads.
    valid = docs.filter(F.col("split") == "valid")
    for name in ("mnb_char", "mnb_word", "pa"):
        run(MODELS[name].fit(valid).score(valid))
    seconds: dict[str, float] = {}
    for name, model in MODELS.items():
        start = time.perf_counter()
        fitted = model.fit(train)
        # Parameters may be lazy expressions over the stored vocabulary: compute them inside the clock.
        run(fitted.weights if name == "pa" else fitted.params)
        seconds[f"{name}_train"] = round(time.perf_counter() - start, 3)
        seconds[f"{name}_predict"] = timed(lambda: run(fitted.score(test)))
    for name in HEADLINE:
        seconds[name] = timed(lambda: run(QUERIES[name](spark, SF_DIR)))
    rows = {"train": train.count(), "test": test.count()}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": CPUS,
                "documents": rows,
            }
        )
    )


if __name__ == "__main__":
    main()
