"""Toxicity scores from a learned lexicon, its misspellings and their context.

Lexicon: over a bounded sample of labelled training rows, words and word beginnings that occur in toxic rows far more
often than in others. They stand in a trie; an entry is a word, or a stem that several words share.

Misspellings: a Levenshtein automaton of a text's word (bit sets of the positions that are reachable with 0 or 1
edits) is intersected with the trie, so one walk finds every entry within one edit; entries of under five letters and
weak ones are matched as they are spelled only. A word enters the walk only if it shares its first or second half with an
entry; one edit leaves one half intact. Results are memoised by word.

Context: a hit between quotation marks, or within a window behind a word of reporting, counts less; an unquoted hit
near another counts more. The counts feed a logistic regression that is fitted on the same sample.

What is learned comes from rows that `train` selects, and only from text and label. Scoring reads whole texts.

Defined cases: null and empty texts score like texts without a hit; rows may repeat (a label that repeats counts
once, as toxic if any says so; of several texts with one id the lowest in code points trains); without toxic or without other training rows, every score is 0; a null id is never a
training row; further columns are kept, and score replaces a column of the same name; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heronlake.llm.support import held_by_worker, let_go, written

#: Labelled rows that the lexicon and the weights are fitted on, at most; those whose ids hash lowest.
MAX_TRAIN = 24_000
WORD = re.compile(r"[^\W_]+")
STEM = range(4, 10)
#: Entries of less weight are matched as they are spelled only.
STRONG = 3.0
MEMO = 400_000
WINDOW = 8
N_FEATURES = 5
# Quotation marks, and words that report what somebody said.
QUOTES = re.compile('["“”„«»]')
REPORTING = frozenset("said says called quoted wrote dit écrit appelé sagte schrieb nannte dijo escribió llamó".split())


@dataclass
class Lexicon:
    """entries: text -> (is a stem, weight)."""

    entries: dict[str, tuple[bool, float]]
    trie: dict = field(default_factory=dict)

    def __post_init__(self):
        #: Halves of the entries that may be misspelled, each with the lengths of the words that it may stand in.
        self.front: dict[str, list[tuple[int, int]]] = {}
        self.back: dict[str, list[tuple[int, int]]] = {}
        self.inner: dict[tuple[int, int], set[str]] = {}
        for term, (stem, weight) in self.entries.items():
            node = self.trie
            for c in term:
                node = node.setdefault(c, {})
            node[""] = (term, stem, weight, len(term))
            half = len(term) // 2
            if len(term) < 5 or weight < STRONG:
                continue
            lengths = (len(term) - 1, 1 << 30 if stem else len(term) + 1)
            self.front.setdefault(term[:half], []).append(lengths)
            if stem:
                # A stem's second half stands where it belongs in a word, or one off.
                for at in (half - 1, half, half + 1):
                    self.inner.setdefault((at, at + len(term) - half), set()).add(term[half:])
            else:
                self.back.setdefault(term[half:], []).append(lengths)
        self.fronts, self.backs = sorted({len(x) for x in self.front}), sorted({len(x) for x in self.back})
        self.stems = sorted({len(t) for t, (s, _) in self.entries.items() if s})

    def exact(self, word: str):
        if word in self.entries:
            return 0, self.entries[word][1]
        for n in self.stems:
            if n < len(word) and (found := self.entries.get(word[:n])) and found[0]:
                return 0, found[1]
        return None

    def look_up(self, word: str):
        """(edits, weight) of the best entry for a word, or None."""
        if found := self.exact(word):
            return found
        if len(word) < 4 or not self._plausible(word):
            return None
        return self._intersect(word)

    def _plausible(self, word: str) -> bool:
        size = len(word)
        for n in self.fronts:
            for least, most in self.front.get(word[:n], ()):
                if least <= size <= most:
                    return True
        for n in self.backs:
            for least, most in self.back.get(word[-n:], ()):
                if least <= size <= most:
                    return True
        return any(word[a:b] in halves for (a, b), halves in self.inner.items())

    def _intersect(self, word: str):
        """Walk the trie with the automaton; bit i of a state: the word's first i characters are matched."""
        masks: dict[str, int] = {}
        for i, c in enumerate(word):
            masks[c] = masks.get(c, 0) | 1 << i
        full, best = (1 << len(word) + 1) - 1, None
        stack = [(self.trie, 1, 0b11)]
        while stack:
            node, none, one = stack.pop()
            for c, below in node.items():
                if c == "":
                    _, stem, weight, length = below
                    if length >= 5 and weight >= STRONG:
                        hit = one >> max(1, length - 1) if stem else one >> len(word) & 1
                        if hit and (best is None or weight > best[1]):
                            best = (1, weight)
                    continue
                mask = masks.get(c, 0)
                none2 = (none & mask) << 1
                one2 = ((one & mask) << 1 | none | none << 1 | none2 << 1) & full
                if one2:
                    stack.append((below, none2, one2))
        return best


class Scorer:
    def __init__(self, lexicon: Lexicon, weights: list[float] | None = None):
        self.lexicon, self.weights = lexicon, weights
        self.memo: dict[str, tuple[int, float] | None] = {}

    def features(self, text: str | None) -> list[float]:
        """Exact hits by context, misspelled hits by context, best exact weight, shares of both among the words."""
        text = (text or "").lower()
        words = WORD.findall(text)
        memo = self.memo
        if len(memo) > MEMO:
            # Frequent words come early: the first half stays.
            memo = self.memo = dict(islice(memo.items(), MEMO // 2))
        hits = {}
        for w in set(words):
            try:
                found = memo[w]
            except KeyError:
                found = memo[w] = self.lexicon.look_up(w)
            if found:
                hits[w] = found
        if not hits:
            return [0.0] * N_FEATURES
        return self._context(text, words, hits)

    def _context(self, text: str, words: list[str], hits: dict) -> list[float]:
        marks = [m.start() for m in QUOTES.finditer(text)]
        plain = fuzzy = best = 0.0
        last_plain = -WINDOW - 1
        reported = -WINDOW - 1
        seen_marks = 0
        for i, m in enumerate(WORD.finditer(text)):
            w = m[0]
            if w in REPORTING:
                reported = i
            found = hits.get(w)
            if not found:
                continue
            while seen_marks < len(marks) and marks[seen_marks] < m.start():
                seen_marks += 1
            # Between an odd mark and the next, not far apart: inside a quotation.
            inside = seen_marks % 2 == 1 and seen_marks < len(marks) and marks[seen_marks] - marks[seen_marks - 1] <= 400
            edits, weight = found
            score = 1.25 if i - last_plain <= WINDOW else 1.0
            if inside:
                score = 0.35
            elif i - reported <= WINDOW:
                score *= 0.7
            if edits:
                fuzzy += score
            else:
                plain += score
                best = max(best, weight * min(score, 1.0))
                if not inside:
                    last_plain = i
        return [math.log1p(plain), math.log1p(fuzzy), best, math.sqrt(plain / len(words)), math.sqrt(fuzzy / len(words))]

    def score(self, text: str | None) -> float:
        if self.weights is None:
            return 0.0
        z = self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], self.features(text), strict=True))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def sliced(batch: pa.RecordBatch, rows: int = 500):
    """A batch in parts of a few texts, so that no more of them are Python strings at once."""
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


def choose_entries(counts: dict[str, tuple[int, int]], n_toxic: int, n_other: int, least: int = 5, lift: float = 20.0, stem_lift: float = 8.0) -> dict[str, tuple[bool, float]]:
    """Words and stems of high lift, from word -> (toxic rows, other rows)."""

    def weight(toxic: float, other: float) -> float:
        return math.log((toxic + 0.1) / (n_toxic + 1)) - math.log((other + 0.5) / (n_other + 1))

    def beginnings(word: str) -> list[str]:
        return [word[:n] for n in STEM if n <= len(word)]

    # Only beginnings that enough toxic rows hold can be chosen; others need no totals.
    held, words_of = Counter(), Counter()
    for word, (toxic, _) in counts.items():
        if toxic:
            for s in beginnings(word):
                held[s] += toxic
                words_of[s] += 1
    stems = {s: [toxic, 0, words_of[s]] for s, toxic in held.items() if toxic >= 0.98 * 2 * least}
    del held, words_of
    for word, (_, other) in counts.items():
        for s in beginnings(word):
            if s in stems:
                stems[s][1] += other
    longer_by: dict[str, list[str]] = {}
    for stem in stems:
        longer_by.setdefault(stem[:-1], []).append(stem)
    chosen: dict[str, tuple[bool, float]] = {}
    for stem, (toxic, other, words) in sorted(stems.items(), key=lambda x: (len(x[0]), x[0])):
        if words < 4 or toxic < 2 * least or weight(toxic, other) < math.log(stem_lift) or any(stem[:n] in chosen for n in STEM if n < len(stem)):
            continue
        # Go on to the longest beginning that still covers nearly all of it.
        while len(stem) < STEM[-1]:
            longer = [s for s in longer_by.get(stem, ()) if stems[s][0] >= 0.98 * toxic]
            if not longer:
                break
            stem = longer[0]
        if stems[stem][2] >= 4:
            chosen[stem] = (True, weight(toxic, other))
    for word, (toxic, other) in counts.items():
        if toxic >= least and weight(toxic, other) >= math.log(lift) and not any(word[:n] in chosen and chosen[word[:n]][0] for n in STEM if n <= len(word)):
            chosen[word] = (False, weight(toxic, other))
    return chosen


def with_misspelled(x: np.ndarray, y: np.ndarray, share: float = 0.3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and row weights, with each toxic row also as it were if all its hits were misspelled.

    Labelled rows hold few misspellings; without these rows nothing would say what they are worth.
    """
    extra = x[(y > 0) & (x[:, 0] > 0)]
    made = np.stack([0 * extra[:, 0], extra[:, 0], 0 * extra[:, 0], 0 * extra[:, 0], extra[:, 3]], axis=1)
    return np.vstack([x, made]), np.concatenate([y, np.ones(len(made))]), np.concatenate([np.ones(len(x)), np.full(len(made), share)])


def fit_logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 1e-3, steps: int = 60) -> list[float]:
    """Newton's method; intercept first."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    penalty = ridge * len(x) / 100 * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (weights * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (weights * (y - p)) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def held_out(id_column: str = "doc_id") -> Column:
    """crc32 of the id as text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic", max_rows: int = MAX_TRAIN) -> Scorer:
    """A scorer learned from at most max_rows labelled rows that aren't held out."""
    known = labels.filter(F.col(id_column).isNotNull() & F.col(label).isNotNull() & ~held_out(id_column))
    known = known.groupBy(F.col(id_column).alias("__id")).agg(F.max(label).cast("int").alias("y"))
    sample = written(known.orderBy(F.xxhash64("__id"), "__id").limit(max_rows), "toxic-sample")
    # The sample has max_rows rows of two numbers at most.
    texts = docs.select(F.col(id_column).alias("__doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(sample), F.col("__doc") == F.col("__id")).select("__id", "y", "text")
    # One text for each id, so what is collected below is bounded by max_rows, however often ids repeat.
    rows = written(rows.groupBy("__id", "y").agg(F.min("text").alias("text")), "toxic-train")

    def count(batches):
        let_go()
        found: dict[int, Counter] = {0: Counter(), 1: Counter()}
        rows_of = Counter()
        for batch in batches:
            for part in sliced(batch):
                for y, t in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    found[y > 0].update(set(WORD.findall(t.lower())))
                    rows_of[y > 0] += 1
        words = list({**found[0], **found[1], "": 0})
        found[0][""], found[1][""] = rows_of[0], rows_of[1]
        for at in range(0, len(words), 50_000):
            part = words[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *(pa.array([found[y][w] for w in part], pa.int64()) for y in (1, 0))], names=["word", "toxic", "other"])

    totals = rows.mapInArrow(count, "word string, toxic bigint, other bigint").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    # Only words of the sample that occur in toxic rows, or share a beginning with such a word, can matter.
    totals = written(totals, "toxic-words")
    begins = totals.filter("toxic > 0 and word <> ''").select(F.substring("word", 1, STEM[0]).alias("b")).distinct()
    counts = {r["word"]: (r["toxic"], r["other"]) for r in totals.filter("word = '' or length(word) < 4 and toxic > 0").toLocalIterator()}
    near = totals.filter("length(word) >= 4").join(begins, F.substring("word", 1, STEM[0]) == F.col("b"), "left_semi")
    # A beginning of a word is chosen by its totals; what can't reach the least number of toxic rows stays behind.
    strong = near.groupBy(F.substring("word", 1, STEM[0]).alias("b")).agg(F.sum("toxic").alias("t")).filter("t >= 5").select("b")
    counts |= {r["word"]: (r["toxic"], r["other"]) for r in near.join(strong, F.substring("word", 1, STEM[0]) == F.col("b"), "left_semi").toLocalIterator()}
    n_toxic, n_other = counts.pop("", (0, 0))
    if not n_toxic or not n_other:
        return Scorer(Lexicon({}))
    lexicon = Lexicon(choose_entries(counts, n_toxic, n_other))

    def measure(batches):
        let_go()
        own = Scorer(lexicon)
        for batch in (part for whole in batches for part in sliced(whole)):
            values = [own.features(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(values, pa.list_(pa.float64()))], names=["y", "x"])

    fitted = rows.mapInArrow(measure, "y int, x array<double>").toPandas()
    x, y = np.array(fitted["x"].tolist(), dtype=float).reshape(-1, N_FEATURES), (fitted["y"].to_numpy() > 0).astype(float)
    return Scorer(lexicon, fit_logistic(*with_misspelled(x, y)))


def score_texts(docs: DataFrame, scorer: Scorer, text: str = "text", out: str = "score", keep: list[str] | None = None) -> DataFrame:
    """docs (or their columns in keep) with a score from 0 to 1."""
    kept = [c for c in (docs.columns if keep is None else keep) if c != out]
    entries, weights = scorer.lexicon.entries, scorer.weights
    key = ("toxicity", repr((len(entries), hash(tuple(sorted(entries))), weights)))
    inputs = docs.select(*kept, F.col(text).alias("__text"))

    def run(batches):
        # With what it knows about words.
        own = held_by_worker(key, lambda: Scorer(Lexicon(entries), weights))
        for batch in (part for whole in batches for part in sliced(whole)):
            scores = [own.score(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*kept, out])

    return inputs.mapInArrow(run, T.StructType([*(docs.schema[c] for c in kept), T.StructField(out, T.DoubleType())]))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the rows that score at or above the threshold."""
    scorer = train(docs, labels, id_column, text)
    return score_texts(docs, scorer, text, "__score").filter(F.col("__score") < threshold).select(*docs.columns)
