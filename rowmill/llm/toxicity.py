"""Toxicity by a learned, weighted lexicon, matched by Aho-Corasick on folded text.

Folding undoes disguise: compatibility forms, letters of other scripts that look Latin, and digits or signs put for
letters. The lexicon holds words and word beginnings with log-odds weights, learned from a bounded sample of labelled
documents (``LABELLED_ROWS``); support is counted in distinct neighbourhoods, so copies of a document do not make its
words toxic. Every text is matched whole. Weights of the matched words are summed, also in proportion to the number of
words, and a logistic curve fitted on the same sample turns them into a score. Words inside an exception phrase do
not count; phrases are given, and learned where clean documents use a lexicon word in one fixed phrase.

Edge cases: null and empty texts match nothing and get the score of a text without matches; null ids belong to the
part that may be learned from but have no label; null labels are not learned from, of several labels of an id the
highest counts; without any toxic example every score is 0; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.llm.workers import returning_memory
from rowmill.storage import materialize

LABELLED_ROWS = 20_000
LEXICON_TERMS = 2_000
CANDIDATE_TERMS = 50_000
PREFIXES = range(3, 10)
THRESHOLD = 0.3

# Letters that look like Latin ones, and signs used for letters.
LOOKS_LIKE = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "з": "3", "и": "u", "й": "u", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ї": "i", "ј": "j", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʟ": "l", "ո": "n", "օ": "o", "ս": "u",
}
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "circus clown")
_SIGNS = str.maketrans({"@": "a", "$": "s", "|": "i"})
_SIGN = re.compile(r"(?<=\w)[@$|](?=\w)")


class _Fold(dict):
    """Code point to its folded letter; anything but letters and marks to a space."""

    def __missing__(self, code: int) -> str:
        c = LOOKS_LIKE.get(chr(code), chr(code))
        c = STANDS_FOR.get(c, c)
        self[code] = folded = c if unicodedata.category(c)[0] in "LM" else " "
        return folded


_FOLD = _Fold()


def fold(text: str | None) -> str:
    """Lower-cased words of the text between single or several spaces, disguise undone."""
    text = (text or "").lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    if "@" in text or "$" in text or "|" in text:
        text = _SIGN.sub(lambda m: m[0].translate(_SIGNS), text)
    return text.translate(_FOLD)


@dataclass
class ToxicityModel:
    """``terms``: weight of each pattern (`` word `` or `` beginning``); ``curve``: bias and slopes of the score."""

    terms: dict[str, float]
    exceptions: tuple[str, ...]
    curve: tuple[float, ...]

    def matcher(self) -> ahocorasick.Automaton | None:
        if not self.terms:
            return None
        found = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            found.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (len(phrase) + 2, 0.0))
        found.make_automaton()
        return found


def measure(matcher: ahocorasick.Automaton | None, text: str | None) -> tuple[float, int, int]:
    """Summed weight of the lexicon words outside exception phrases, their number, and the number of words."""
    words = fold(text).split()
    if matcher is None or not words:
        return 0.0, 0, len(words)
    folded = f" {' '.join(words)} "
    best: dict[int, float] = {}
    excused: list[tuple[int, int]] = []
    for end, (length, weight) in matcher.iter(folded):
        start = end - length + 1
        if weight:
            best[start] = max(best.get(start, 0.0), weight)
        else:
            excused.append((start, end))
    if excused:
        best = {s: w for s, w in best.items() if not any(a <= s < b for a, b in excused)}
    return float(sum(best.values())), len(best), len(words)


def _features(weight: np.ndarray, hits: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(weight)), hits > 0, np.log1p(weight), np.log1p(1000 * weight / (words + 20))])


def _fit_curve(x: np.ndarray, y: np.ndarray, penalty: float = 0.5) -> tuple[float, ...]:
    """Newton steps of a penalised logistic regression."""
    beta = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], penalty)
    shrink[0] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(shrink), x.T @ (y - p) - shrink * beta)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(b) for b in beta)


def _neighbourhoods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (word before, word, word behind) of each document, with its label."""
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = ["", *fold(text).split(), ""]
            seen = sorted(set(zip(words[:-2], words[1:-1], words[2:])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for _, w, _ in seen], pa.string()), pa.array([a for a, _, _ in seen], pa.string()), pa.array([b for _, _, b in seen], pa.string()), pa.array([toxic] * len(seen), pa.int32())],
                ["word", "before", "behind", "toxic"],
            )


def _log_tail(toxic: float, clean: float, rate: float) -> float:
    """Chernoff bound of seeing so many toxic ones among toxic + clean at the base rate, as a logarithm."""
    n = toxic + clean
    share = toxic / n
    if share <= rate:
        return 0.0
    rest = (1 - share) * math.log((1 - share) / (1 - rate)) if share < 1 else 0.0
    return -n * (share * math.log(share / rate) + rest)


def _choose(counted: Sequence, toxic_total: float, clean_total: float, distinct: int) -> dict[str, float]:
    """Significant terms, strongest (surprise times weight) first; of nested terms the strongest, the longest of equals."""
    rate = toxic_total / (toxic_total + clean_total)
    least = math.log(0.01 / max(distinct, 1))
    scored = []
    for term, toxic, clean in counted:
        tail = _log_tail(toxic, clean, rate)
        weight = math.log((toxic + 0.5) / (toxic_total + 1) * (clean_total + 1) / (clean + 0.5))
        if tail < least and weight > 1.5:
            scored.append((tail * weight, -len(term), term, weight))
    chosen: dict[str, float] = {}
    beginnings: set[str] = set()
    for _, _, term, weight in sorted(scored):
        bare = term.strip()
        cuts = {bare[:k] for k in range(1, len(bare) + 1)}
        if bare in beginnings or any(f" {c}" in chosen or f" {c} " in chosen for c in cuts):
            continue
        chosen[term] = weight
        beginnings |= cuts
        if len(chosen) == LEXICON_TERMS:
            break
    return chosen


def _learned_exceptions(neighbours: DataFrame, terms: dict[str, float]) -> tuple[str, ...]:
    """Two-word phrases with a whole lexicon word that at least 20 clean and no more than 1 in 20 toxic places use."""
    whole = sorted(t.strip() for t in terms if t.endswith(" "))
    if not whole:
        return ()
    about = neighbours.where(F.col("word").isin(whole))
    phrases = about.select("toxic", F.explode(F.array(F.concat_ws(" ", "before", "word"), F.concat_ws(" ", "word", "behind"))).alias("phrase"))
    counted = phrases.where("phrase like '_% %_'").groupBy("phrase").agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic"))
    rows = counted.where("n - toxic >= 20 AND toxic * 20 <= n").orderBy(F.desc("n"), "phrase").limit(LEXICON_TERMS).collect()
    return tuple(r["phrase"] for r in rows)


def fit_toxicity(labelled: DataFrame, exceptions: Sequence[str] = EXCEPTIONS) -> ToxicityModel:
    """Learn from all rows of ``text, toxic`` (0 or 1); ``sample_labelled`` bounds them."""
    sample = materialize(labelled.select("text", F.col("toxic").cast("int").alias("toxic")), "labelled")
    schema = "word string, before string, behind string, toxic int"
    spread = sample.repartition(24).mapInArrow(_neighbourhoods, schema)
    neighbours = materialize(spread.groupBy("word", "before", "behind").agg(F.max("toxic").alias("toxic")), "neighbourhoods")
    per_word = neighbours.groupBy("word").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
    beginnings = F.transform(F.sequence(F.lit(PREFIXES[0]), F.lit(PREFIXES[-1])), lambda k: F.when(k < F.length("word"), F.concat(F.lit(" "), F.substring("word", F.lit(1), k))))
    terms = F.array_append(F.array_compact(beginnings), F.concat(F.lit(" "), F.col("word"), F.lit(" ")))
    counted = materialize(
        per_word.select(F.explode(terms).alias("term"), "t", "n").groupBy("term").agg(F.sum("t").alias("toxic"), (F.sum("n") - F.sum("t")).alias("clean")), "terms"
    )
    totals = per_word.agg(F.sum("t").alias("t"), F.sum("n").alias("n")).first()
    if not totals["t"]:
        return ToxicityModel({}, tuple(exceptions), ())
    lifted = F.col("toxic") * (totals["n"] - totals["t"]) > F.lit(3) * F.col("clean") * totals["t"]
    frequent = counted.where((F.col("toxic") >= 4) & lifted)
    best = frequent.orderBy(F.desc("toxic"), "term").limit(CANDIDATE_TERMS).collect()
    lexicon = _choose([(r["term"], r["toxic"], r["clean"]) for r in best], totals["t"], totals["n"] - totals["t"], counted.where("toxic + clean >= 4").count())
    model = ToxicityModel(lexicon, (*exceptions, *_learned_exceptions(neighbours, lexicon)), ())
    seen = np.array(_measured(sample, model, "toxic").select("weight", "hits", "words", "kept").collect(), float)
    model.curve = _fit_curve(_features(seen[:, 0], seen[:, 1], seen[:, 2]), seen[:, 3])
    return model


def sample_labelled(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """Texts with labels: those of the ``rows`` ids with the smallest hashes that may be learned from.

    A label names an id, so of different texts under one id the one with the smallest digest is learned from.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")  # at most ``rows`` ids
    return texts.groupBy("doc_id", "toxic").agg(F.min_by("text", F.md5("text")).alias("text")).select("text", "toxic")


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _measured(docs: DataFrame, model: ToxicityModel, keep: str) -> DataFrame:
    """The ``keep`` column with ``weight, hits, words`` of ``text``, which is a column or a field of ``keep``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = model.matcher()
        for batch in batches:
            texts = batch.column(1) if batch.num_columns > 1 else batch.column(0).field("text")
            got = [measure(matcher, t) for t in texts.to_pylist()]
            columns = [pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["kept", "weight", "hits", "words"])

    inside = keep not in docs.columns
    frame = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept")) if inside else docs.select(F.col(keep).alias("kept"), "text")
    return frame.mapInArrow(returning_memory(run), f"kept {frame.schema['kept'].dataType.simpleString()}, weight double, hits long, words long")


def toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, keep: str = "doc_id") -> DataFrame:
    """``kept``, ``score`` (0 to 1), ``predicted`` (1 from the threshold on), ``weight, hits, words`` of every row.

    ``kept`` is the column named by ``keep``, or the whole row as a struct if there is no such column.
    """
    measured = _measured(docs, model, keep)
    if not model.curve:
        score = F.lit(0.0)
    else:
        bias, any_hit, total, density = model.curve
        line = bias + any_hit * (F.col("hits") > 0).cast("double") + total * F.log1p("weight") + density * F.log1p(1000 * F.col("weight") / (F.col("words") + 20))
        score = 1 / (1 + F.exp(-line))
    return measured.withColumn("score", score).select("kept", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "weight", "hits", "words")


def not_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents not predicted toxic, with all their columns."""
    scored = toxicity(docs, model, threshold, keep="")
    return scored.where("predicted = 0").select(*[F.col(f"kept.`{c}`") for c in docs.columns])
