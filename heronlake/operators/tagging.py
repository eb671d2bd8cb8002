"""A recogniser of entities that learns from articles whose entities are known.

A linear model over BIO tags: features of a token and of its two neighbours, and of the tag before it. It is fitted by the
averaged structured perceptron and decoded by Viterbi, so a tag is chosen for what it does to its whole sentence.

Fitting takes every sentence of every labelled text. Sentences are dealt by hash to shards of about SHARD_CHARS characters. In
each pass a shard is learned one sentence after the other by a task of its own, and the shards' changes are averaged (iterative
parameter mixing); these are sums of integers, so a model doesn't depend on how rows are dealt or tasks end. Features are hashed
to SLOTS rows of weights, so a model has SLOTS x tags numbers whatever it has seen: that much goes to the tasks in their closure,
and comes back, in each pass. Tagging runs in Arrow batches over whole texts. What a word adds as itself, as the one before and
as the one behind doesn't depend on where it stands, so that is looked up once a word of a batch, and all sentences of a batch
are decoded side by side.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of labelled texts in a shard, about, and of texts that are decoded side by side.
SHARD_CHARS, SIDE_CHARS = 1 << 20, 1 << 19
#: Tokens of a sentence that is long.
LONG = 256
SLOTS = 1 << 16
#: Features of a token as itself, and as the neighbour on either side.
OWN, AROUND = 11, 2
PASSES = 6
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")
SENTENCE = re.compile(r"[^\n.!?]*[\n.!?]*")


def sentences(text: str) -> list[list[str]]:
    """Tokens by sentences: runs of letters, runs of digits, and single marks; a mark or a line end closes a sentence."""
    return [t for s in SENTENCE.findall(text) if (t := TOKEN.findall(s))]


Names = dict[str, tuple[list[int], dict[tuple[str, ...], str]]]


def _names(entities: Iterable[tuple[str, str]]) -> Names:
    """By their first word: how many words entities have, most first, and the last type of each."""
    known: dict[str, dict[tuple[str, ...], str]] = defaultdict(dict)
    for text, kind in dict.fromkeys(entities):
        if words := tuple(TOKEN.findall(text)):
            known[words[0]][words] = max(kind, known[words[0]].get(words, kind))
    return {first: (sorted({len(w) for w in own}, reverse=True), own) for first, own in known.items()}


def _label(tokens: list[str], known: Names) -> list[str]:
    tags, i = ["O"] * len(tokens), 0
    while i < len(tokens):
        lengths, own = known.get(tokens[i], ((), {}))
        n = next((n for n in lengths if tuple(tokens[i : i + n]) in own and i + n <= len(tokens)), 0)
        for k in range(n):
            tags[i + k] = f"{'I' if k else 'B'}-{own[tuple(tokens[i : i + n])]}"
        i += n or 1
    return tags


def label(tokens: list[str], entities: list[tuple[str, str]]) -> list[str]:
    """BIO tags of tokens by the entities that are known of their text, longest first, whatever their number."""
    return _label(tokens, _names(entities))


class _Marks(dict):
    """For str.translate: what stands for a character in a shape."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = out = "X" if c.isupper() else "x" if c.isalpha() else "d" if c.isdigit() else c
        return out


_MARKS = _Marks()


@lru_cache(1 << 17)
def _slot(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % SLOTS


@lru_cache(1 << 14)
def _shape_slots(marks: str) -> tuple[int, ...]:
    shape = re.sub(r"(.)\1+", r"\1+", marks)
    return tuple(map(_slot, (f"s={shape}", f"n={len(marks)}", f"sn={shape}/{len(marks)}", f"b:s={shape}", f"a:s={shape}")))


_WORD, _BEFORE, _BEHIND = map(zlib.crc32, (b"w=", b"b:w=", b"a:w="))


def _slots(tokens: Iterable[str]) -> np.ndarray:
    """For each token the rows of the weights: OWN as itself, AROUND as the one before, AROUND as the one behind. The empty
    token stands for an end."""
    flat: list[int] = []
    for token in tokens:
        low = token.lower()
        raw = low.encode("utf-8", "surrogatepass")
        shape, length, both, before, behind = _shape_slots(token.translate(_MARKS))
        flat += (
            _slot("bias"), zlib.crc32(raw, _WORD) % SLOTS, shape, length, _slot("p=" + low[:1]), _slot("p=" + low[:2]), _slot("p=" + low[:3]),
            _slot("e=" + low[-1:]), _slot("e=" + low[-2:]), _slot("e=" + low[-3:]), both,
            zlib.crc32(raw, _BEFORE) % SLOTS, before, zlib.crc32(raw, _BEHIND) % SLOTS, behind,
        )
    return np.array(flat, dtype=np.uint16).reshape(-1, OWN + 2 * AROUND)


def _sum(weights: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """The sum of weights for each row of slots."""
    out = weights[slots[:, 0]]
    for k in range(1, slots.shape[1]):
        out += weights[slots[:, k]]
    return out


def _sides(slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As itself, as the one before, as the one behind."""
    return slots[:, :OWN], slots[:, OWN : OWN + AROUND], slots[:, OWN + AROUND :]


def _neighbours(numbers: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers before and behind each in its own sentence, 0 at the ends."""
    before, behind = np.roll(numbers, 1), np.roll(numbers, -1)
    ends = lengths.cumsum()
    before[ends - lengths] = 0
    behind[ends - 1] = 0
    return before, behind


def _steps_first(lengths: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Where tokens of sentences go if all first tokens come first, then all second ones, the longest sentence before others;
    and how many sentences have a token i."""
    alive = np.bincount(lengths)[::-1].cumsum()[::-1][1:]
    rank = np.empty(len(lengths), dtype=np.int64)
    rank[np.argsort(-lengths, kind="stable")] = np.arange(len(lengths))
    place = np.arange(lengths.sum()) - np.repeat(lengths.cumsum() - lengths, lengths)
    return (alive.cumsum() - alive)[place] + np.repeat(rank, lengths), alive.tolist()


def _decode(scores: np.ndarray, lengths: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The best tags of sentences laid end to end, none empty; see `best_paths`."""
    if not len(lengths):
        return np.zeros(0, dtype=np.int64)
    to, alive = _steps_first(lengths)
    rows = np.empty_like(scores)
    rows[to] = scores
    inner, at = steps[:-1], alive[0]
    now = [rows[:at].T + steps[-1][:, None]]
    for n in alive[1:]:
        now.append((now[-1][:, None, :n] + inner[:, :, None]).max(axis=0) + rows[at : at + n].T)
        at += n
    path, tag = np.empty(len(rows), dtype=np.int64), now[-1].argmax(axis=0)
    for i in range(len(alive) - 1, -1, -1):
        n = alive[i]
        path[at - n : at] = tag
        at -= n
        if i:
            # The tag before is sought for the tag that was chosen alone.
            before = now[i - 1]
            more = before[:, n:].argmax(axis=0) if n < alive[i - 1] else None
            tag = (before[:, :n] + inner[:, tag]).argmax(axis=0)
            tag = tag if more is None else np.concatenate([tag, more])
    return path[to]


def best_paths(scores: list[np.ndarray], steps: np.ndarray) -> list[np.ndarray]:
    """For each sentence the tags with the highest sum of scores (token x tag) and steps (tag before x tag); the row behind
    the last of steps is for a sentence's first tag. Of equal sums the one whose tags, from the last back, are lower."""
    lengths = np.array([len(x) for x in scores], dtype=np.int64)
    if not lengths.sum():
        return [np.zeros(0, dtype=np.int64) for _ in scores]
    path = _decode(np.concatenate([x for x in scores if len(x)]), lengths[lengths > 0], steps)
    return np.split(path, lengths.cumsum()[:-1])


class LearnedTagger:
    """(token, BIO tag) of texts; see `tag_all`. A single text may be tagged by a call."""

    def __init__(self, tags: list[str], weights: np.ndarray, steps: np.ndarray):
        self.tags, self.weights, self.steps = tags, weights, steps

    def tag_sentences(self, groups: list[list[str]]) -> list[list[str]]:
        flat = [t for g in groups for t in g]
        numbers = {"": 0}
        for t in flat:
            numbers.setdefault(t, len(numbers))
        ids = np.fromiter(map(numbers.__getitem__, flat), dtype=np.int64, count=len(flat))
        lengths = np.array([len(g) for g in groups if g], dtype=np.int64)
        own, first, last = (_sum(self.weights, x) for x in _sides(_slots(numbers)))
        before, behind = _neighbours(ids, lengths)
        found = iter(_decode(own[ids] + first[before] + last[behind], lengths, self.steps).tolist())
        return [[self.tags[next(found)] for _ in g] for g in groups]

    def tag_all(self, texts: list[str]) -> list[list[tuple[str, str]]]:
        out, at = [], 0
        while at < len(texts):
            start, chars = at, 0
            while at < len(texts) and (at == start or chars + len(texts[at]) <= SIDE_CHARS):
                chars += len(texts[at])
                at += 1
            cut = [sentences(t) for t in texts[start:at]]
            tagged = iter(self.tag_sentences([g for groups in cut for g in groups]))
            out += [[pair for g in groups for pair in zip(g, next(tagged), strict=True)] for groups in cut]
        return out

    def __call__(self, text: str) -> list[tuple[str, str]]:
        return self.tag_all([text])[0]


def _pack(examples: Iterable[tuple[list[str], list[str]]]) -> dict:
    """A shard: sentences laid end to end as numbers of tokens and of tags, and what these numbers mean."""
    tokens, kinds, flat, truth, lengths = {"": 0}, {"O": 0}, [], [], []
    for words, tags in examples:
        if words:
            flat += [tokens.setdefault(t, len(tokens)) for t in words]
            truth += [kinds.setdefault(t, len(kinds)) for t in tags]
            lengths.append(len(words))
    arrays = {"flat": np.array(flat, dtype=np.int32), "truth": np.array(truth, dtype=np.int32), "lengths": np.array(lengths, dtype=np.int32), "slots": _slots(tokens)}
    return arrays | {"kinds": list(kinds)}


def _learn(shard: dict, model: np.ndarray, tags: list[str], shards: int, order: random.Random) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One pass of the perceptron over a shard, by a model (weights, behind them steps) that is multiplied by the number of
    shards: cells of the model that change, by how much (once), and the sum of that change over the sentences from it on.

    Sentences are decoded in blocks: those up to the first that is wrong have been decoded by the model that they meet one by
    one, and the others are decoded again after it has learned. Long sentences are blocks of their own, so they are decoded once."""
    number = {t: k for k, t in enumerate(tags)}
    to = np.array([number[t] for t in shard["kinds"]])
    n, lengths = len(shard["lengths"]), shard["lengths"].astype(np.int64)
    turn = list(range(n))
    order.shuffle(turn)
    starts, lengths = (lengths.cumsum() - lengths)[turn], lengths[turn]
    ends = lengths.cumsum()
    at = np.arange(len(shard["flat"])) + np.repeat(starts - (ends - lengths), lengths)
    flat, truth = shard["flat"][at].astype(np.int64), to[shard["truth"][at]]
    own, first, last = _sides(shard["slots"])
    before, behind = _neighbours(flat, lengths)
    own, first, last = own[flat], first[before], last[behind]
    model, late = model.astype(float), np.zeros(model.shape, dtype=np.int64)
    changed = np.zeros_like(late)
    k, most = 0, 16
    lone = np.append(np.flatnonzero(lengths > LONG), n)
    while k < n:
        next_lone = lone[np.searchsorted(lone, k)]
        stop = k + 1 if next_lone == k else min(next_lone, k + most)
        span = slice(ends[k] - lengths[k], ends[stop - 1])
        path = _decode(_sum(model, own[span]) + _sum(model, first[span]) + _sum(model, last[span]), lengths[k:stop], model[SLOTS:])
        wrong = np.flatnonzero(path != truth[span])
        if not len(wrong):
            k, most = stop, min(2 * most, 2048) if stop - k == most else most
            continue
        w = int(np.searchsorted(ends, span.start + wrong[0], side="right"))
        mine = slice(ends[w] - lengths[w], ends[w])
        right, got = truth[mine], path[mine.start - span.start : mine.stop - span.start]
        off = right != got
        slots = np.concatenate([own[mine][off], first[mine][off], last[mine][off]], axis=1).astype(np.int64)
        for tag, sign in ((right, 1), (got, -1)):
            rows = np.concatenate([slots.ravel(), SLOTS + np.concatenate([[len(tags)], tag[:-1]])])
            cells = (rows, np.concatenate([np.repeat(tag[off], slots.shape[1]), tag]))
            np.add.at(changed, cells, sign)
            np.add.at(late, cells, sign * (n - w))
            np.add.at(model, cells, sign * shards)
        most = most if next_lone == k else min(max(16, 2 * (w + 1 - k)), 2048)
        k = w + 1
    cells = np.flatnonzero((changed != 0) | (late != 0))
    return cells, changed.ravel()[cells], late.ravel()[cells]


def _fit(passed, tags: list[str], shards: int, sentences: int, passes: int) -> LearnedTagger:
    """passed(model, pass) gives the sums over all shards of what `_learn` gives; the average is over all sentences and passes."""
    model = np.zeros((SLOTS + len(tags) + 1, len(tags)), dtype=np.int64)
    total = np.zeros_like(model)
    for k in range(passes):
        cells, changed, late = passed(model, k)
        total += sentences * model
        total.ravel()[cells] += shards * late
        model.ravel()[cells] += changed
        if not len(cells):
            # Nothing was wrong, so the passes to come would change nothing.
            total += (passes - 1 - k) * sentences * model
            break
    total = total / max(1, shards * sentences * passes)
    return LearnedTagger(tags, total[:SLOTS], total[SLOTS:])


def _order(seed: int, k: int) -> random.Random:
    return random.Random(f"{seed} {k}")


def fit(examples: list[tuple[list[str], list[str]]], passes: int = PASSES, seed: int = 7) -> LearnedTagger:
    """The averaged perceptron over (tokens, tags) as one shard; the same examples in the same order give the same model."""
    shard = _pack(examples)
    tags = ["O", *sorted({*shard["kinds"]} - {"O"})]
    return _fit(lambda model, k: _learn(shard, model, tags, 1, _order(seed, k)), tags, 1, len(shard["lengths"]), passes)


def _labelled(articles: DataFrame, text: str, id_column: str) -> DataFrame:
    """Sentences (id, k, words joined by blanks, tags) of all articles with known entities."""

    def run(batches):
        for batch in batches:
            ids, numbers, words, tags = [], [], [], []
            for name, whole, entities in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                known = _names((e["text"], e["type"]) for e in entities if e and e["text"] is not None and e["type"] is not None)
                for k, tokens in enumerate(sentences(whole)):
                    ids.append(name)
                    numbers.append(k)
                    words.append(" ".join(tokens))
                    tags.append(_label(tokens, known))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(numbers, pa.int32()), pa.array(words, pa.string()), pa.array(tags, pa.list_(pa.string()))], names=["id", "k", "words", "tags"])

    known = articles.filter(F.col("entities").isNotNull() & F.col(text).isNotNull())
    return known.select(F.col(id_column).cast("string"), text, "entities").mapInArrow(run, "id string, k int, words string, tags array<string>")


def training_rows(articles: DataFrame, text: str = "title", id_column: str = "id") -> list[tuple[list[str], list[str]]]:
    """(tokens, tags) of the sentences of all articles with known entities, on the driver: for measuring `quality` on few. `train`
    leaves them to the tasks."""
    return [(r["words"].split(" "), r["tags"]) for r in _labelled(articles, text, id_column).orderBy("id", "k", "words", "tags").collect()]


def train(articles: DataFrame, text: str = "title", id_column: str = "id", passes: int = PASSES, seed: int = 7, shard_chars: int = SHARD_CHARS) -> LearnedTagger:
    """A tagger fitted on all articles with known entities."""
    chars = articles.filter(F.col("entities").isNotNull()).agg(F.sum(F.length(text).cast("long"))).first()[0] or 0
    parts = max(1, -(-chars // shard_chars))
    kind = {"flat": pa.binary(), "truth": pa.binary(), "lengths": pa.binary(), "slots": pa.binary(), "kinds": pa.list_(pa.string()), "n": pa.int64()}
    types = {"flat": np.int32, "truth": np.int32, "lengths": np.int32, "slots": np.uint16}

    def pack(batches):
        shard = _pack((w.split(" "), t) for b in batches for w, t in zip(b.column("words").to_pylist(), b.column("tags").to_pylist(), strict=True))
        if n := len(shard["lengths"]):
            row = {k: v.tobytes() if k in types else v for k, v in shard.items()} | {"n": n}
            yield pa.RecordBatch.from_arrays([pa.array([row[k]], t) for k, t in kind.items()], names=list(kind))

    at = F.xxhash64("id", "k")
    dealt = _labelled(articles, text, id_column).withColumn("at", at).repartitionById(parts, F.pmod("at", F.lit(parts)).cast("int"))
    packed = dealt.sortWithinPartitions("at", "id", "k", "words", "tags").mapInArrow(pack, "flat binary, truth binary, lengths binary, slots binary, kinds array<string>, n long")
    packed = packed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        shards, rows, kinds = packed.agg(F.count("*"), F.sum("n"), F.array_distinct(F.flatten(F.collect_set("kinds")))).first()
        tags = ["O", *sorted({*kinds} - {"O"})]

        def passed(model: np.ndarray, k: int):
            def run(batches):
                for batch in batches:
                    for row in batch.to_pylist():
                        shard = {c: np.frombuffer(row[c], dtype=t) for c, t in types.items()} | {"kinds": row["kinds"]}
                        shard["slots"] = shard["slots"].reshape(-1, OWN + 2 * AROUND)
                        cells, changed, late = _learn(shard, model, tags, shards, _order(seed, k))
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (cells, changed, late)], names=["cell", "changed", "late"])

            made = packed.mapInArrow(run, "cell long, changed long, late long").groupBy("cell").agg(F.sum("changed"), F.sum("late")).toArrow()
            return tuple(c.to_numpy() for c in made.columns)

        return _fit(passed, tags, shards, rows or 0, passes)
    finally:
        packed.unpersist()


def quality(tagged: list[list[str]], truth: list[list[str]]) -> tuple[float, float]:
    """(precision, recall) of entities: runs of tokens with their type."""

    def runs(tags: list[str]) -> set[tuple[int, int, str]]:
        found, start = set(), None
        for i, t in enumerate([*tags, "O"]):
            if start is not None and t != f"I-{tags[start][2:]}":
                found.add((start, i, tags[start][2:]))
                start = None
            if start is None and t != "O":
                start = i
        return found

    got, right = ([runs(x) for x in side] for side in (tagged, truth))
    both = sum(len(a & b) for a, b in zip(got, right, strict=True))
    return both / max(1, sum(map(len, got))), both / max(1, sum(map(len, right)))
