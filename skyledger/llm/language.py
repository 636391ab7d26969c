"""Hierarchical language identification by linear support vector machines.

A text's features are square roots of the shares of hashed byte pairs and triples of its lower-cased letters, at unit
length. One-versus-rest machines choose the language family; within it, a machine for each pair of languages votes.
Machines are fitted with squared hinge loss on at most SAMPLE texts of each language (fewer where TOTAL would be
exceeded), those of smallest digest of their id among the rows allowed for learning; every language is learned;
prediction covers every whole text.

Results for special input: a null text, or one without a letter, is 'und' with score 0; so is every text if there is
nothing to learn from; a null language is never learned from; repeated rows each give a row; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm._common import column, table

#: Texts of each language that the machines are fitted on, at most.
SAMPLE = 400
#: Texts of all languages that machines are fitted on, at most, but LEAST of each; the driver gathers these with a margin.
TOTAL, LEAST = 25_600, 8
BITS = 12
STEPS = 150
PENALTY = 1e-4
UNKNOWN = "und"

# Families of languages by ISO 639-1 code. A language of none of them is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg mk sr hr bs sl",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk tt",
    "indic": "hi bn ur mr gu pa ne si",
    "semitic": "ar he mt am",
    "austronesian": "id ms jv tl mg",
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_LETTERS = np.array([c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint8)


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], f"={lang}")


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    """A vector of 2 ** BITS, of unit length."""
    data = _LETTERS[np.frombuffer(text.lower().encode(), np.uint8)]
    word = data != 32
    keep = np.ones(len(data), bool)
    keep[1:] = word[1:] | word[:-1]  # runs of other characters count as one space
    codes = np.concatenate(([32], data[keep], [32])).astype(np.uint32)
    pairs = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:] * np.uint32(0x85EBCA77)
    triples = pairs[:-1] * np.uint32(0xC2B2AE3D) + codes[2:] * np.uint32(0x27D4EB2F)
    shift = np.uint32(32 - BITS)
    counts = np.bincount(((pairs ^ (pairs >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> shift, minlength=1 << BITS) + np.bincount(((triples ^ (triples >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> shift, minlength=1 << BITS)
    vector = np.sqrt(counts.astype(np.float32))
    return vector / np.linalg.norm(vector)


def fit_machine(x: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear machine: squared hinge loss with balanced classes, by accelerated gradient steps."""
    y = np.where(positive, 1.0, -1.0).astype(np.float32)
    share = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum())).astype(np.float32)
    w = momentum = np.zeros(x.shape[1] + 1, np.float32)
    for step in range(STEPS):
        slack = np.maximum(1 - y * (x @ momentum[:-1] + momentum[-1]), 0)
        pull = share * y * slack
        gradient = np.append(-2 * (pull @ x), -2 * pull.sum()) + PENALTY * momentum
        fresh = momentum - gradient.astype(np.float32) / 4
        momentum = fresh + step / (step + 3) * (fresh - w)
        w = fresh
    return w[:-1], float(w[-1])


class Model:
    """Machines over families and over pairs of languages of a family."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        self.families = sorted({family_of(k) for k in self.langs})
        self.members = {f: [k for k in self.langs if family_of(k) == f] for f in self.families}
        label = np.array(langs)
        home = np.array([family_of(k) for k in langs])
        rows, bias = [], []

        def add(x: np.ndarray, positive: np.ndarray) -> int:
            w, b = fit_machine(x, positive)
            rows.append(w)
            bias.append(b)
            return len(rows) - 1

        self.by_family = {f: add(x, home == f) for f in self.families} if len(self.families) > 1 else {}
        self.by_pair = {}
        for members in self.members.values():
            for i, a in enumerate(members):
                for b in members[i + 1 :]:
                    own = (label == a) | (label == b)
                    self.by_pair[a, b] = add(x[own], label[own] == a)
        self.weights = np.array(rows, np.float32).reshape(len(rows), 1 << BITS)
        self.bias = np.array(bias, np.float32)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and a score from 0 to 1: how far the decisions that led to it are from their boundaries."""
        if not self.langs or text is None or not has_letter(text):
            return UNKNOWN, 0.0
        margin = self.weights @ features(text) + self.bias
        family = max(self.families, key=lambda f: margin[self.by_family[f]]) if self.by_family else self.families[0]
        least = [margin[self.by_family[family]]] if self.by_family else []
        members = self.members[family]
        votes = dict.fromkeys(members, 0)
        sums = dict.fromkeys(members, 0.0)
        for i, a in enumerate(members):
            for b in members[i + 1 :]:
                m = float(margin[self.by_pair[a, b]])
                votes[a if m > 0 else b] += 1
                sums[a] += m
                sums[b] -= m
        best = max(members, key=lambda k: (votes[k], sums[k]))
        least += [margin[self.by_pair[p]] * (1 if p[0] == best else -1) for p in self.by_pair if best in p]
        return best, float(1 / (1 + np.exp(-4 * float(min(least))))) if least else 1.0


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(k, d, features(t).astype(np.float16).tobytes()) for k, d, t in zip(*(c.to_pylist() for c in batch.columns), strict=True) if has_letter(t)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], names=["lang", "digest", "x"])


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from rows with a text and a language.

    The digests of a language's rows are spread evenly, so a bound on the digest gives about SAMPLE rows of each."""
    rows = docs.select(column(lang_col).cast("string").alias("lang"), F.xxhash64(column(id_col).cast("string"), F.lit("lang")).alias("digest"), column(text_col).alias("text")).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = rows.groupBy("lang").count().orderBy("lang").collect()
    if not counts:
        return Model(np.zeros((0, 1 << BITS), np.float32), [])
    most = min(SAMPLE, max(LEAST, TOTAL // len(counts)))
    # Rows below the bound are Poisson in number, so few are asked for with a margin; no language is left without any.
    bound = {r["lang"]: int(2**63 * min(1.0, (most if most == SAMPLE else most + 3 * most**0.5 + 4) / r["count"])) - 1 for r in counts}
    limits = F.broadcast(docs.sparkSession.createDataFrame(list(bound.items()), "lang string, bound long"))
    few = rows.join(limits, "lang").filter(F.col("digest").bitwiseAND(F.lit(2**63 - 1)) <= F.col("bound")).select("lang", "digest", "text").mapInArrow(_sampled, "lang string, digest long, x binary")
    found = sorted(few.collect(), key=lambda r: (r["lang"], r["digest"] & (2**63 - 1), r["x"]))
    taken = {k: [] for k in bound}
    for r in found:
        if len(taken[r["lang"]]) < most:
            taken[r["lang"]].append(r)
    chosen = [r for k in sorted(taken) for r in taken[k]]
    x = np.frombuffer(b"".join(r["x"] for r in chosen), np.float16).reshape(len(chosen), 1 << BITS).astype(np.float32)
    return Model(x, [r["lang"] for r in chosen])


def _predicted(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            answers = [model.predict(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([a for a, _ in answers], pa.string()), pa.array([s for _, s in answers], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def held_out(key: Column, folds: int = 5) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == 0


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every text."""
    rows = docs.select(column(id_col).cast("long").alias("doc_id"), held_out(column(id_col)).alias("held_out"), column(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_predicted(model), "doc_id long, held_out boolean, lang_pred string, score double")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn(docs.filter(~held_out(F.col("doc_id")))))
