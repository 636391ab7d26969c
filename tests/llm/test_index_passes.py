import glob
import time

import numpy as np
import pyarrow as pa
from skyledger.llm import _common, jaccard_join
from tests.conftest import SF

NO_COSTS = np.zeros(jaccard_join.COUNTERS, np.uint8)


def shuffled(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in folders for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}


def test_passes_deal_the_parts_and_find_the_same_buckets(spark):
    texts = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("coalesce(text, '') AS text")
    batch = pa.RecordBatch.from_arrays([pa.array([r.text for r in texts.collect()])], names=["text"])
    whole = {(p, x) for b in jaccard_join._indexer(NO_COSTS, 16)(iter([batch])) for p, x in zip(*(c.to_pylist() for c in b.columns))}
    turns = [{(p, x) for b in jaccard_join._indexer(NO_COSTS, 16, t, 4)(iter([batch])) for p, x in zip(*(c.to_pylist() for c in b.columns))} for t in range(4)]
    assert [sorted({p for p, _ in own}) for own in turns] == [list(range(4 * t, 4 * t + 4)) for t in range(4)]
    assert sum(len(x) for own in turns for _, x in own) <= sum(len(x) for _, x in whole)
    assert max(sum(len(x) for _, x in own) for own in turns) < 0.3 * sum(len(x) for _, x in whole)
    # Parts of the same number have the same members, whatever the passes, so a bucket has the same content and name.
    rows = lambda n: sorted(map(tuple, jaccard_join.indexed(texts, NO_COSTS, n).collect()))
    one = rows(1)
    assert rows(4) == one and len(one) > 10


def test_shuffle_files_go_with_their_query(spark):
    setting, before = spark.conf.get(_common.FREED, None), shuffled(spark)
    with _common.shuffles_freed(spark):
        _common.written(spark.range(50_000).repartition(5, "id").groupBy("id").count(), "freed")
        until = time.time() + 10
        while shuffled(spark) - before and time.time() < until:
            time.sleep(0.2)
        assert not shuffled(spark) - before
    assert spark.conf.get(_common.FREED, None) == setting
