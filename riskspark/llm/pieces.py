"""SentencePiece encoding and decoding by a shared-prefix forward pass.

The distinct marked words of a batch are sorted, which is a depth-first walk of
their trie: a word keeps the forward table of the prefix it shares with the word
before and fills only the rest. For a unigram model the table holds the best score
of each prefix (Viterbi). For a pair-merging model it holds the last piece of each
prefix's merge result: a sequence of pieces is the merge result if and only if
every two neighbours stay apart when merged alone, so one piece fits at each place.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskspark.llm import columns
from riskspark.llm.tokens import vocabulary_path

MODEL = "piece_bpe_32k.model"
MARK = "▁"
KEPT = 300_000
LONGEST_KEPT = 64
_UNIT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Pieces:
    """Pieces and scores of a model file; ``unigram`` says which kind it is."""

    def __init__(self, path: str, unigram: bool = False):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.unigram, n = unigram, model.get_piece_size()
        self.surface = [model.id_to_piece(i) for i in range(n)]
        self.bytes = {int(self.surface[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown = model.unk_id()
        special = {i for i in range(n) if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.ids = {self.surface[i]: i for i in range(n) if i not in special}
        self.score = [model.get_score(i) for i in range(n)]
        self.prefixes = [""]
        self.state_of = {"": 0}
        for piece in self.ids:
            for size in range(1, len(piece) + 1):
                if piece[:size] not in self.state_of:
                    self.state_of[piece[:size]] = len(self.prefixes)
                    self.prefixes.append(piece[:size])
        self.moves: list[dict[str, int]] = [{} for _ in self.prefixes]
        self.ends: list[list[tuple[int, int]] | None] = [None] * len(self.prefixes)
        self.unknown_score = min((self.score[i] for i in self.ids.values()), default=0.0) - 10.0
        self.hidden = {i: "" for i in special - set(self.bytes.values())}
        self.odd = np.zeros(n, bool)
        self.odd[[*self.hidden, *self.byte_of]] = True
        self.apart_cache: dict[tuple[int, int], bool] = {}
        self.whole_cache: dict[int, bool] = {}
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, text: str) -> list[int]:
        """Pair merging by the plain rule: the best-scored neighbours first, from the left.
        Unknown characters are -1."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = self.ids.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or self.score[found] > best):
                    best, at = self.score[found], i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids.get(p, -1) for p in parts]

    def _apart(self, left: int, right: int) -> bool:
        if left < 0 or right < 0:
            return True
        key = (left, right)
        if (known := self.apart_cache.get(key)) is None:
            if len(self.apart_cache) > 4 * KEPT:
                self.apart_cache.clear()
            known = self.apart_cache[key] = self.merge(self.surface[left] + self.surface[right]) == [left, right]
        return known

    def _own(self, piece: int) -> bool:
        if (known := self.whole_cache.get(piece)) is None:
            known = self.whole_cache[piece] = self.merge(self.surface[piece]) == [piece]
        return known

    def _move(self, state: int, char: str) -> int:
        """The longest end of a text that begins some piece, one character on."""
        text = self.prefixes[state] + char
        while text and text not in self.state_of:
            text = text[1:]
        to = self.moves[state][char] = self.state_of[text]
        if self.ends[to] is None:
            found = [(self.ids.get(text[-size:], -1), size) for size in range(len(text), 0, -1)]
            self.ends[to] = [(p, size) for p, size in found if p >= 0 and (self.unigram or self._own(p))]
        return to

    def _merged(self, table: list, ends: list, i: int, char: str) -> tuple[int, int, float]:
        for piece, size in ends:
            before = table[i - size]
            if before is None or self._apart(before[0], piece):
                return piece, size, 0.0
        return -1, 1, 0.0

    def _best(self, table: list, ends: list, i: int, char: str) -> tuple[int, int, float]:
        out = (-1, 1, (table[i - 1][2] if i > 1 else 0.0) + self.unknown_score) if char not in self.ids else None
        for piece, size in ends:
            total = (table[i - size][2] if i > size else 0.0) + self.score[piece]
            if out is None or total > out[2]:
                out = (piece, size, total)
        return out

    def walk(self, words: list[str]):
        """Yield (word, ids) of sorted words, sharing the table of common prefixes."""
        table, states, last = [None], [0], ""
        moves, ends = self.moves, self.ends
        step = self._best if self.unigram else self._merged
        for word in words:
            shared = 0
            for a, b in zip(word, last):
                if a != b:
                    break
                shared += 1
            del table[shared + 1 :], states[shared + 1 :]
            state = states[shared]
            for i, char in enumerate(word[shared:], shared + 1):
                to = moves[state].get(char)
                state = self._move(state, char) if to is None else to
                states.append(state)
                table.append(step(table, ends[state] or (), i, char))
            last, i, back = word, len(word), []
            while i:
                piece, size, _ = table[i]
                back.append(piece if piece >= 0 else word[i - 1])
                i -= size
            yield word, self._numbers(back[::-1])

    def _numbers(self, parts: list) -> array:
        out = array("i")
        for p in parts:
            if isinstance(p, int):
                out.append(p)
            elif self.bytes:
                out.extend(self.bytes[b] for b in p.encode("utf-8", "surrogatepass"))
            else:
                out.append(self.unknown)
        return out

    def units(self, text: str) -> list[str]:
        """Marked words: a run of marks and what follows up to the next mark."""
        if not text:
            return []
        if "  " not in text and MARK not in text and text[0] != " ":
            return [MARK + w for w in text.split(" ")]
        return _UNIT.findall(MARK + text.replace(" ", MARK))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.kept) > KEPT:
            self.older, self.kept = self.kept, {}
        units = [self.units(t) for t in texts]
        new, own = set().union(*units).difference(self.kept), {}
        self.kept.update((w, self.older[w]) for w in new if w in self.older)
        new = sorted(w for w in new if w not in self.kept)
        runs = [w for w in new if w.startswith(MARK * 2) and not self.unigram]
        for w in runs:  # merges of marks alone tie in score, so their order matters
            parts, text = self.merge(w), w
            at, out = 0, []
            for p in parts:
                out.append(p if p >= 0 else text[at])
                at += len(self.surface[p]) if p >= 0 else 1
            own[w] = self._numbers(out)
        own.update(self.walk([w for w in new if w not in own]))
        own = {w: x.tobytes() for w, x in own.items()}
        self.kept.update((w, x) for w, x in own.items() if len(w) <= LONGEST_KEPT)
        long = {w: x for w, x in own.items() if len(w) > LONGEST_KEPT}
        get = self.kept.__getitem__ if not long else lambda w: long[w] if w in long else self.kept[w]
        return [np.frombuffer(b"".join(map(get, u)), np.int32) for u in units]

    def decode(self, ids: np.ndarray) -> str:
        out, held = [], bytearray()
        if not self.odd[ids].any():
            out = map(self.surface.__getitem__, ids.tolist())
            ids = ids[:0]
        for i in ids.tolist():
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            out.append(self.hidden[i] if i in self.hidden else self.surface[i])
        if held:
            out.append(held.decode("utf-8", "replace"))
        text = "".join(out).replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def pieces(path: str, unigram: bool) -> Pieces:
    return columns.worker_kept(f"pieces:{path}:{unigram}", lambda: Pieces(path, unigram))


def encode(docs: DataFrame, path: str | None = None, unigram: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids) of every whole text; NULL and empty texts have no ids. Keys may be NULL
    or repeat; other columns are ignored. A character without a piece becomes its bytes."""
    path = path or vocabulary_path(MODEL)

    def run(batches):
        coder = pieces(path, unigram)
        for batch in columns.small_batches(batches, text, keep="pieces"):
            ids = coder.encode([t or "" for t in batch.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(ids, pa.list_(pa.int32()))], names=[key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, ids array<int>")


def decode(coded: DataFrame, path: str | None = None, key: str = "doc_id") -> DataFrame:
    """(key, text, n_tokens, ids_crc32) from (key, ids). A mark in the original text comes
    back as a space, as the file format has no other sign for it."""
    path = path or vocabulary_path(MODEL)

    def run(batches):
        coder = pieces(path, False)
        for batch in batches:
            ids = [np.asarray(x.values) if x.is_valid else np.zeros(0, np.int32) for x in batch.column("ids")]
            crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array([coder.decode(x) for x in ids], pa.string()), pa.array([len(x) for x in ids], pa.int64()), pa.array(crc, pa.int64())],
                names=[key, "text", "n_tokens", "ids_crc32"])

    kind = coded.schema[key].dataType.simpleString()
    return coded.select(key, "ids").mapInArrow(run, f"{key} {kind}, text string, n_tokens long, ids_crc32 long")
