"""Words that only exact comparison tells apart, and stages that must keep the right rows."""

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import corpus_pipeline
from skyledger.llm import byte_bpe, exact_dedup, jaccard_join, mixing, quality, sharding, token_files
from skyledger.llm.words import hashed_words
from tests.llm.brute import linked_components

CLASHES = "_mix_nth _mix_copies row times nth norm fp measured own_id text_key slot shard met salt _gone_id _kept_id kept n_words m w l whole".split()


def pair(n):
    """Two unlike words of n letters whose sums of letter values times powers of any odd number are equal modulo 2^64."""
    bits = [bin(k).count("1") & 1 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("size", [1024, 2048, 4096])
def test_words_of_equal_sums(size):
    from tokenizers import Tokenizer

    a, b = pair(size)
    bpe, library = byte_bpe.tokenizer(byte_bpe.default_path()), token_files.library_encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [f"{a} {b} {a} {b}", a, b, f" {b}"]
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    ids = list(bpe.encode(texts))
    assert [x.tolist() for x in ids] == [plain.encode_ordinary(t) for t in texts]
    assert [bpe.decode(x).decode() for x in ids] == texts
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert [x.tolist() for x in library.encode(texts)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    words, _ = hashed_words([f"{a} {b}", b.upper()], lower=True)
    assert words[0] != words[1] and words[1] == words[2]
    one, two = jaccard_join.sets_of([f"x y {a} z u v w", f"x y {b} z u v w"])
    assert len(np.intersect1d(one, two)) == 0


def test_unlike_words_are_no_link(spark):
    a, b = pair(1024)
    rows = spark.createDataFrame([(1, f"{a} one two"), (2, f"{b} one two"), (3, f"{a}  one\ttwo")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(rows).collect()} == {1: 1, 2: 2, 3: 1}


def test_edited_copies_beyond_the_threshold_of_each_other(spark, monkeypatch):
    """1,000 copies of one text, each with a tenth of its words replaced: they link with the text, hardly with each other."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", 32)
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(60)]
    docs = []
    for k in range(1000):
        w = list(base)
        for at in rng.choice(60, int(rng.integers(1, 8)), replace=False):
            w[at] = f"x{rng.integers(0, 40)}"
        docs.append((k + 1, " ".join(w)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(frame).collect()}
    assert got == linked_components(docs)
    assert len({c for _, c in got.values()}) > 100


WORDS = " ".join(f"word{k % 53} and{k % 7} so{k % 31}" for k in range(40))
ROWS = [(1, WORDS, "en", "s"), (1, WORDS, "en", "s"), (2, WORDS + " more", "en", "s"), (None, WORDS.replace("word", "wird").replace("and", "und"), "de", None), (None, None, None, None), (None, WORDS, "en", "s"), (7, "", "en", "s")]


@pytest.fixture(scope="module")
def rows(spark):
    """Null ids, repeated rows, and columns named like those that operators use inside."""
    frame = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    for c in CLASHES:
        frame = frame.selectExpr("*", f"concat('{c}', coalesce(doc_id, 0)) AS `{c}`")
    return frame


def plain(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=str)


def whole(frame, rows):
    assert frame.columns == rows.columns
    for r in frame.collect():
        assert all(r[c] == f"{c}{r.doc_id or 0}" for c in CLASHES)
    return plain(frame)


def test_exact_dedup_keeps_one_row_of_each_text(rows):
    assert whole(exact_dedup.drop_exact_duplicates(rows), rows) == sorted([(1, WORDS), ROWS[2][:2], ROWS[3][:2], (7, "")], key=str)
    assert exact_dedup.drop_exact_duplicates(rows.limit(0)).columns == rows.columns and not exact_dedup.drop_exact_duplicates(rows.limit(0)).count()


def test_near_dedup_keeps_one_row_of_each_component(rows):
    assert whole(jaccard_join.drop_near_duplicates(rows), rows) == sorted([(1, WORDS), ROWS[3][:2], (None, None), (7, "")], key=str)
    assert not jaccard_join.drop_near_duplicates(rows.limit(0)).count()


def test_quality_keeps_rows_as_they_are(rows):
    good = whole(quality.quality_filter(rows), rows)
    assert good.count((1, WORDS)) == 2 and (None, ROWS[3][1]) in good and (7, "") not in good
    assert not quality.quality_filter(rows.limit(0)).count()


def test_mixing_counts_rows_not_ids(rows):
    taken = whole(mixing.mixed_documents(rows), rows)
    want = {}
    for r in mixing.mix(rows).collect():
        want[r.source] = want.get(r.source, 0) + r.copies * r["size"]
    got = {}
    source = {text: s for _, text, _, s in ROWS}
    for _, text in taken:
        got[source[text]] = got.get(source[text], 0) + len((text or "").split())
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}
    assert all(taken.count((i, t)) <= 2 * sum((a, b) == (i, t) for a, b, _, _ in ROWS) for i, t in taken)
    assert not mixing.mixed_documents(rows.limit(0)).count()


def test_sharding_refuses_names_in_use(rows):
    with pytest.raises(ValueError):
        sharding.place(rows)
    placed = sharding.place(rows, slot_as="own_slot", shard_as="own_shard")
    assert placed.count() == len(ROWS) and whole(placed.select(*rows.columns), rows) == plain(rows)


def test_pipeline_on_odd_rows(spark, rows, tmp_path):
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} <= {1, None} and out
    rows.limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0


def test_fences_follow_the_group(spark):
    """Two languages of unlike habits get unlike fences for every measure, and every measure rejects something."""
    rng = np.random.default_rng(1)

    def text(length, marks, short):
        words = []
        for _ in range(200):
            n = int(rng.integers(1, 3)) if rng.random() < short else int(rng.integers(*length))
            words.append("".join(rng.choice(list("abcdefgh"), n)) + ("," if rng.random() < marks else ""))
        return " ".join(words)

    plain_, long_ = ((3, 8), 0.05, 0.2), ((5, 14), 0.2, 0.1)
    docs = [(k, text(*(plain_, long_)[k % 2]), ("en", "de")[k % 2], "s") for k in range(400)]
    odd = [text((3, 8), 1.0, 0.2), text((3, 4), 0.05, 0.2), text((7, 8), 0.05, 0.0), text((3, 8), 0.05, 0.9), text((9, 14), 0.05, 0.2)]
    docs += [(1000 + k, t, "en", "s") for k, t in enumerate(odd)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    measured = quality.measure(frame).cache()
    fences = {r.lang: r for r in quality.thresholds(quality.sketches(measured)).collect()}
    for name, m in quality.MEASURES.items():
        assert fences["en"][f"{name}_hi"] != fences["de"][f"{name}_hi"]
        beyond = ~quality._scaled(name).between(fences["en"][f"{name}_lo"], fences["en"][f"{name}_hi"])
        assert measured.filter("doc_id >= 1000").filter(beyond).count()
    kept = {r.doc_id for r in quality.judged(measured).filter("kept").collect()}
    assert kept == set(range(400))
    measured.unpersist()
