"""BPE encoding and decoding by tree concatenation.

A text longer than a leaf is cut in halves, down to leaves, which are encoded in one batch. The halves of every level are
then concatenated: around each join a window is encoded anew, as a whole, and it grows until its first and last part are
exactly what the left and the right half hold there; only then is it spliced in. Two levels use this:

* A text is a row of chunks between ASCII white space, and a chunk's ids don't depend on its neighbours. A join may
  cut a chunk. The window grows chunk by chunk, and both of its outer chunks must agree.
* A chunk longer than `long_chunk` has no such places. There, windows grow token by token. A window is right once it
  agrees with the left half in a token that starts where a word or a letter run may start, and with the right half in
  a whole token behind the join: a row of BPE tokens is the encoding of its word exactly if every two neighbours are,
  and the splice leaves no pair that one of the three encodings didn't hold.

Without agreement the window grows to the whole text or chunk, so the result is exact in any case. Texts of up to a leaf
have nothing to concatenate. A memo of bounded size, which the worker process keeps, holds chunks that leaves have met;
what isn't in it, the library encodes, and windows always go to the library. Truncation and padding of the tokenizer file are switched off.

Defined cases: null counts as empty and has no ids; texts are encoded whole; rows may repeat; further columns are
kept, and columns that this adds replace columns of the same name; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import unicodedata
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heronlake.llm.support import held_by_worker

#: Chunks of a memo, about 200 bytes each.
MEMO = 700_000
LEAF = 4096
LONG_CHUNK = 512
#: Marks that make one token row of their own behind a word; quotation marks may be part of a contraction.
MARKS = ".,;:!?$%*#)("
#: White space on whose two sides the library encodes independently.
BREAKS = " \t\n\r\v\f"
CHUNK = re.compile(r"[^ \t\n\r\v\f]+")
#: U+001C to U+001F are white space to Python but not to the library.
ODD = re.compile("[\x1c-\x1f]")
#: White space beyond U+0020 and U+0009 to U+000D.
RARE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Where one of these occurs, white space isn't single spaces and line ends.
UNEVEN = ["  ", "\n\n", " \n", "\n ", *"\t\r\v\f\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"]


class ChunkEncoder:
    """Ids of chunks, as little-endian unsigned 32-bit integers; repeated chunks come from a memo.

    With lead, a chunk starts with the white space before it (for tokenizers whose words hold a leading space); else
    white space carries no ids and only separates chunks.
    """

    def __init__(self, path: str, lead: bool = False, memo: int = MEMO):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.find = re.compile(r"\s*\S+|\s+\Z").findall if lead else re.compile(r"[^ \t\n\r\v\f]+").findall
        self.lead, self.memo, self.most = lead, {}, memo
        # New chunks are encoded many at once, with a separator between whose one token no such chunk can hold.
        self.glue = "\n" if lead else " \0 "
        glue_ids = self.tokenizer.encode(self.glue, add_special_tokens=False).ids
        self.glue_id = glue_ids[0] if len(glue_ids) == 1 else None
        self.gluable = re.compile(r" ?[^\s<\0]+\Z" if lead else r"[^\s<\0]+\Z").match
        added = self.tokenizer.get_added_tokens_decoder()
        #: Ids of added tokens by their text; the library cuts these out before anything else.
        self.added = {t.content: i for i, t in added.items()}
        self.simple = not any(t.lstrip or t.rstrip or t.single_word or t.normalized or any(c.isspace() for c in t.content) for t in added.values())
        self.cut = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")

    def chunks(self, text: str) -> list[str]:
        if not self.lead:
            return self.find(text) if RARE.search(text) else text.split()
        if any(map(text.__contains__, UNEVEN)) or text[:1].isspace() or text[-1:].isspace():
            return [text] if ODD.search(text) else self.find(text)
        # Single spaces and line ends only: cutting before each gives the same chunks, faster.
        return text.replace(" ", "\x1f ").replace("\n", "\x1f\n").split("\x1f") if text else []

    def batch(self, texts: list[str]) -> list[bytes]:
        """The library's ids, on one thread: Spark's tasks already use the cores."""
        before = os.environ.get("TOKENIZERS_PARALLELISM")
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        try:
            return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        finally:
            os.environ.pop("TOKENIZERS_PARALLELISM") if before is None else os.environ.update(TOKENIZERS_PARALLELISM=before)

    def glued(self, chunks: list[str]) -> list[bytes]:
        """The same as batch, in one call, for chunks that the separator keeps apart."""
        (found,) = self.tokenizer.encode_batch_fast([self.glue.join(chunks)], add_special_tokens=False)
        ids = np.array(found.ids, dtype="<u4")
        cuts = np.flatnonzero(ids == self.glue_id)
        if len(cuts) != len(chunks) - 1:
            return self.batch(chunks)
        raw = ids.tobytes()
        starts, ends = [0, *(cuts * 4 + 4).tolist()], [*(cuts * 4).tolist(), len(raw)]
        return [raw[a:b] for a, b in zip(starts, ends, strict=True)]

    def learn(self, lists: list[list[str]], longest: int | None = None) -> None:
        """Have all chunks of the lists in the memo, but those over the longest."""
        new = set().union(*lists).difference(self.memo)
        if longest is not None:
            new = {c for c in new if len(c) <= longest}
        if len(self.memo) + 2 * len(new) > self.most:
            # Frequent chunks come early: the first half stays.
            self.memo = dict(islice(self.memo.items(), self.most // 2))
            new = {c for c in set().union(*lists).difference(self.memo) if longest is None or len(c) <= longest}
        # A word with marks behind it has the ids of both; many chunks differ in the marks only.
        split = {c: pieces for c in new if (pieces := self.pieces(c))}
        new -= split.keys()
        new |= set().union(*split.values()).difference(self.memo)
        plain = [c for c in new if self.gluable(c)] if self.glue_id is not None else []
        for at in range(0, len(plain), 4096):
            self.memo.update(zip(plain[at : at + 4096], self.glued(plain[at : at + 4096]), strict=True))
        rest = [c for c in new if c not in self.memo]
        for at in range(0, len(rest), 4096):
            self.memo.update(zip(rest[at : at + 4096], self.batch(rest[at : at + 4096]), strict=True))
        memo = self.memo
        memo.update((c, b"".join([memo[x] for x in pieces])) for c, pieces in split.items())

    def pieces(self, chunk: str) -> tuple[str, ...] | None:
        """Parts that the library encodes independently: a line end, a word of letters, marks behind it; None for one part.

        Only letters of old scripts count, on which all versions of Unicode agree.
        """
        start = chunk[:1] if self.lead and chunk[:1] == "\n" and len(chunk) > 1 and not chunk[1].isspace() else ""
        rest = chunk[1:] if start else chunk
        word = rest.rstrip(MARKS)
        letters = word[1:] if self.lead and word[:1] == " " else word
        if len(word) < len(rest) and letters.isalpha() and max(letters) < "\u0530":
            return (start, word, rest[len(word) :]) if start else (word, rest[len(word) :])
        return (start, rest) if start else None

    def parts(self, chunks: list[str]) -> list[bytes]:
        try:
            return list(map(self.memo.__getitem__, chunks))
        except KeyError:
            self.learn([chunks])
            return list(map(self.memo.__getitem__, chunks))


def encoder(path: str, lead: bool = False, memo: int = MEMO) -> ChunkEncoder:
    """An encoder and memo that the worker process keeps."""
    return held_by_worker(("bpe", path, lead, memo), lambda: ChunkEncoder(path, lead, memo))


def _may_start(text: str, at: int) -> bool:
    """Whether scanning from here finds the same words as scanning from further left: no contraction, special token or
    combined character may begin or be cut here."""
    char = text[at]
    return char not in "'<" and unicodedata.category(char)[0] != "M" and not "ᅠ" <= char <= "ᇿ"


class Tokens:
    """Ids with their character offsets in a text."""

    def __init__(self, ids: list[int], spans: list[tuple[int, int]]):
        self.ids, self.spans = ids, spans

    def whole(self, i: int) -> bool:
        """Whether token i shares no character with its neighbours."""
        s, e = self.spans[i]
        return s < e and (i == 0 or self.spans[i - 1][1] <= s) and (i + 1 == len(self.ids) or self.spans[i + 1][0] >= e)


class TreeEncoder:
    def __init__(self, chunks: ChunkEncoder, leaf: int = LEAF, long_chunk: int = LONG_CHUNK, window: int = 8):
        self.of, self.leaf, self.long, self.window = chunks, leaf, long_chunk, window
        self.is_long = re.compile(r"[^ \t\n\r\v\f]{%d,}" % (long_chunk + 1))
        self.joins = 0

    # A text

    def encode(self, text: str | None) -> bytes:
        """All ids of a text, as little-endian unsigned 32-bit integers."""
        out, at, text = [], 0, text or ""
        for found in self.is_long.finditer(text):
            out += [self._plain(text[at : found.start()]), self._unsplit(found[0])]
            at = found.end()
        return b"".join([*out, self._plain(text[at:])])

    def _plain(self, text: str) -> bytes:
        """Ids of a text without long chunks."""
        if len(text) <= self.leaf or not self.of.simple:
            return b"".join(self.of.parts(self.of.chunks(text)))
        cuts = [0, len(text)]
        while max(b - a for a, b in zip(cuts, cuts[1:])) > self.leaf:
            cuts = sorted({c for a, b in zip(cuts, cuts[1:]) for c in (a, (a + b) // 2, b)})
        leaves = [self.of.chunks(text[a:b]) for a, b in zip(cuts, cuts[1:])]
        # The library encodes what is new in all halves of all levels in one batch.
        self.of.learn(leaves)
        sides = [(chunks, self.of.parts(chunks)) for chunks in leaves]
        while len(sides) > 1:
            glues = ["" if text[at - 1] not in BREAKS and text[at] not in BREAKS else " " for at in cuts[1:-1:2]]
            sides = self._concatenate(list(zip(sides[::2], glues, sides[1::2], strict=True)))
            cuts = cuts[::2]
        return b"".join(sides[0][1])

    def _concatenate(self, pairs: list[tuple]) -> list[tuple[list[str], list[bytes]]]:
        """(chunks, ids) of each pair (left half, what stands between, right half) of a level.

        A window of some chunks on either side of the join is encoded anew, by the library and not from the memo. It grows
        until its first chunk is one of the left half and its last chunk one of the right half, each with just the ids that
        the half holds for it. The windows of a level go to the library in one batch.
        """
        self.joins += len(pairs)
        out: list = [None] * len(pairs)
        waiting, reach = [], 1
        for k, (left, _, right) in enumerate(pairs):
            if left[0] and right[0]:
                waiting.append(k)
            else:
                out[k] = left if left[0] else right
        while waiting:
            texts = [" ".join(pairs[k][0][0][-reach:]) + pairs[k][1] + " ".join(pairs[k][2][0][:reach]) for k in waiting]
            again = []
            for k, (chunks, parts) in zip(waiting, self._windows(texts), strict=True):
                (left, left_ids), _, (right, right_ids) = pairs[k]
                a, b = min(reach, len(left)), min(reach, len(right))
                left_agrees = a == len(left) or (chunks[0], parts[0]) == (left[-a], left_ids[-a])
                right_agrees = b == len(right) or (chunks[-1], parts[-1]) == (right[b - 1], right_ids[b - 1])
                # With one chunk on a side, the outer chunk is the one that the join may have cut.
                if left_agrees and right_agrees and (a > 1 or a == len(left) or pairs[k][1]) and (b > 1 or b == len(right) or pairs[k][1]):
                    out[k] = (left[:-a] + chunks + right[b:], left_ids[:-a] + parts + right_ids[b:])
                else:
                    again.append(k)
            waiting, reach = again, 2 * reach
        return out

    def _windows(self, texts: list[str]) -> list[tuple[list[str], list[bytes]]]:
        """(chunks, ids of each) as the library encodes these texts as a whole."""
        out = []
        for text, found in zip(texts, self.of.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
            places = [m.span() for m in CHUNK.finditer(text)]
            ids = np.array(found.ids, dtype="<u4")
            starts = np.array([s for s, _ in found.offsets], dtype=np.int64)
            cuts = [0, *np.searchsorted(starts, [s for s, _ in places[1:]]).tolist(), len(ids)]
            out.append(([text[s:e] for s, e in places], [ids[i:j].tobytes() for i, j in zip(cuts, cuts[1:])]))
        return out

    # Tokens of an unsplit chunk

    def _tokens(self, texts: list[str]) -> list[Tokens]:
        return [Tokens(e.ids, e.offsets) for e in self.of.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _unsplit(self, chunk: str) -> bytes:
        """Ids of a long chunk; added tokens split it, whatever stands around them."""
        if not self.of.simple:
            return self.of.batch([chunk])[0]
        out, at = [], 0
        for found in self.of.cut.finditer(chunk):
            out += [self._run(chunk[at : found.start()]), np.array([self.of.added[found[0]]], dtype="<u4").tobytes()]
            at = found.end()
        return b"".join([*out, self._run(chunk[at:])])

    def _run(self, chunk: str) -> bytes:
        if len(chunk) <= self.long:
            return self.of.batch([chunk])[0]
        cuts = [0, len(chunk)]
        while cuts[1] - cuts[0] > self.long:
            cuts = sorted({c for a, b in zip(cuts, cuts[1:]) for c in (a, (a + b) // 2, b)})
        starts, ends = cuts[:-1], cuts[1:]
        leaves = self._tokens([chunk[a:b] for a, b in zip(starts, ends, strict=True)])
        sides = [Tokens(t.ids, [(s + a, e + a) for s, e in t.spans]) for a, t in zip(starts, leaves, strict=True)]
        while len(sides) > 1:
            joined = [self._join(chunk, sides[i], sides[i + 1], ends[i], ends[i - 1] if i else 0, ends[i + 1]) for i in range(0, len(sides) - 1, 2)]
            odd = len(sides) % 2
            sides = joined + sides[len(sides) - odd :]
            ends = ends[1::2] + ends[len(ends) - odd :]
        return np.array(sides[0].ids, dtype="<u4").tobytes()

    def _join(self, chunk: str, left: Tokens, right: Tokens, at: int, first: int, last: int) -> Tokens:
        self.joins += 1
        reach = self.window
        while True:
            i = max(0, len(left.ids) - reach)
            while i and not (left.whole(i) and left.spans[i - 1][1] == left.spans[i][0] and _may_start(chunk, left.spans[i][0])):
                i -= 1
            j = min(len(right.ids), reach)
            start = left.spans[i][0] if i else first
            end = right.spans[j - 1][1] if j < len(right.ids) else last
            (new,) = self._tokens([chunk[start:end]])
            new.spans = [(s + start, e + start) for s, e in new.spans]
            left_agrees = not i or (bool(new.ids) and (new.ids[0], new.spans[0]) == (left.ids[i], left.spans[i]) and new.whole(0) and left.spans[i][1] <= at - 2)
            cut = None
            if j == len(right.ids):
                cut = (len(new.ids), j)
            else:
                known = {right.spans[n]: n for n in range(1, j) if right.whole(n)}
                for m in range(len(new.ids) - 1):
                    n = known.get(new.spans[m])
                    if n is not None and new.spans[m][0] > at and right.ids[n] == new.ids[m] and new.whole(m) and _may_start(chunk, new.spans[m][0]):
                        cut = (m, n)
                        break
            if left_agrees and cut:
                m, n = cut
                return Tokens(left.ids[:i] + new.ids[:m] + right.ids[n:], left.spans[:i] + new.spans[:m] + right.spans[n:])
            reach *= 2


def encode_texts(docs: DataFrame, path: str, text: str = "text", lead: bool = False) -> DataFrame:
    """docs with ids (binary, little-endian unsigned 32-bit integers) and decoded (text) in place of the text column."""
    kept = [c for c in docs.columns if c not in (text, "ids", "decoded")]

    def run(batches):
        of = encoder(path, lead)
        tree = TreeEncoder(of)
        back = Decoder(of.tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column(part.num_columns - 1).to_pylist()]
                # Long texts bring what is new in their halves themselves.
                of.learn([of.chunks(t) for t in texts if len(t) <= tree.leaf], tree.long)
                ids = [tree.encode(t) for t in texts]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(ids, pa.binary()), pa.array([back.decode(x) for x in ids], pa.string())], names=[*kept, "ids", "decoded"])

    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])
    return docs.select(*kept, F.col(text)).mapInArrow(run, schema)


class Decoder:
    """decode(ids, skip_special_tokens=False) of the library."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.plain = tokenizer.decoder is None
        if self.plain:
            # Without a decoder in its file, the library joins the tokens by spaces.
            self.table = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, dtype="<u4").tolist()
        return " ".join(map(self.table.__getitem__, numbers)) if self.plain else self.tokenizer.decode(numbers, skip_special_tokens=False)
