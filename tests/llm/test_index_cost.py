import numpy as np
import pyarrow as pa
from skyledger.llm import jaccard_join
from skyledger.llm.pretoken import mixed
from skyledger.llm.words import hashed_words, shingles
from tests.conftest import SF

NO_COSTS = np.zeros(jaccard_join.COUNTERS, np.uint8)
TEXTS = ["", "one", " \n", "a b c d e f a b c d e f a b c d e", "A b C d E", "x y z", "", "é ü " * 50, "w" * 100 + " v u t s r"]


def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").selectExpr("coalesce(text, '') AS text")


def test_sets_and_nodes_of_many_texts_are_those_of_each():
    sets = jaccard_join.sets_of(TEXTS)
    for text, own in zip(TEXTS, sets, strict=True):
        runs, _ = shingles(*hashed_words([text], lower=True), jaccard_join.WORDS)
        assert own.tolist() == sorted(set(runs.tolist()))
    for own, node in zip(sets, jaccard_join.nodes_of(sets).tolist(), strict=True):
        total = sum(mixed(own ^ np.uint64(0xA0761D6478BD642F)).tolist()) + len(own)
        assert node == int(mixed(np.array([total % (1 << 64)], np.uint64)).view(np.int64)[0])
    assert jaccard_join.sets_of([]) == [] and len(jaccard_join.nodes_of([])) == 0


def test_index_reads_the_texts_twice(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    texts = given(spark)
    jaccard_join.indexed(texts.mapInArrow(counted, "text string"), NO_COSTS).collect()
    assert 0 < read.value <= 2 * texts.count()


def test_entries_of_many_parts_are_short(spark):
    texts, parts = [r.text for r in given(spark).collect()], 4096
    sets = list({s.tobytes(): s for s in jaccard_join.sets_of(texts) if len(s)}.values())
    entries = sum(len(e[0]) for e in jaccard_join.index_entries(sets, NO_COSTS))
    blobs = [x for b in jaccard_join._indexer(NO_COSTS, parts)(iter([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])])) for x in b.column(1).to_pylist()]
    # Beside its head of 16 bytes; before, nearly 26 for each entry, as its set's three small numbers took twelve.
    assert entries > 10_000 and sum(map(len, blobs)) - 16 * len(blobs) < 21 * entries
