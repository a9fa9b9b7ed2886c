r"""SentencePiece encoding with N-best segmentation, and decoding.

The lattice of a text has an edge for every vocabulary piece that occurs in it,
with the piece's score; a character that no piece covers is spelled in byte
pieces at the price of an unknown one. A forward Viterbi pass gives the best
score from the start to each position. These are exact heuristics for an A*
search backwards from the end: a partial hypothesis is valued by its own score
plus the best score of what is left, so complete segmentations leave the agenda
in order of score, each after at most as many expansions as it has pieces. What
an entry of the agenda is valued at is reached by a segmentation of its own, so no
entry beyond the N best can give one of the N best: the agenda holds N entries of
constant size, whose paths are parent links, and time and memory grow with the
length of the text.

White space is escaped as ``\u2581``. Where no piece crosses from another
character into ``\u2581`` (checked when the model is read), the lattice of a text
falls apart into units, the words: its N best are the N cheapest choices among
the N best of its words, exactly. The forward pass runs over all new words of a
piece of a batch at once, one array step per position and length of a piece; with
the same pass from the end it gives every word's best segmentation and what its
second best loses. Words are told apart by their bytes and numbered, and all that
is known of them stands in flat arrays under these numbers.
Only the N - 1 words of a text that lose least can differ in its N best, and
only these are searched by A*. Other vocabularies are searched a text at a time.
Scores are fixed-point numbers of ``2**-20``, so sums are exact in any order.

The model file is a parameter and is read by the tasks' host; vocabularies are
never trained. A model's scores are taken as they are (``scores="model"``) or,
for merge vocabularies, whose scores are ranks, as logarithms of Zipf
frequencies (``scores="rank"``, the default of the query).

Equal scores are settled by order: fewer pieces first, then the longer piece at
the last position in which two segmentations differ.

Defined results: null and empty texts have one segmentation, of no pieces, with
score 0. Decoding gives back the normalised text, i.e. the text itself apart
from what the model's own normaliser changes; NUL bytes and lone marks are
spelled in bytes like other unknown characters. Null ids and repeated rows are
encoded alike; other columns pass through :func:`encode` unless they bear the
names it adds, which are replaced.
"""

from __future__ import annotations

import math
import os
import re
from functools import lru_cache
from itertools import chain, repeat
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.llm.common import field, nested_row, releasing, sole_cache, table

MODEL = os.environ.get("SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
N_BEST = 4
CACHED_WORDS = 300_000  # segmentations a worker keeps
ARRAY_LENGTH = 40  # longer units are segmented one at a time; below 64
ARRAY_CHARS = 1 << 16  # of units segmented at once
ARRAY_SCORE = 1 << 40  # vocabularies with larger scores are searched a unit at a time
HUGE = 1 << 8  # longer units are not cached
PIECE_BYTES = 1 << 21  # characters encoded at a time
ONE = 1 << 20  # of a score
UNKNOWN_PENALTY = 10 * ONE
MARK = "▁"


class Best(NamedTuple):
    score: int
    ids: tuple[int, ...]
    loss: int  # of the second best; NONE if there is no other


def _runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of every run, one run after the other."""
    ends = np.cumsum(size)
    return np.repeat(first - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


class Found(NamedTuple):
    """Best segmentations of units: scores, losses as in Best, numbers of ids, and
    the ids, one unit's after the other's."""
    score: np.ndarray
    loss: np.ndarray
    size: np.ndarray
    ids: np.ndarray

    def take(self, at: np.ndarray) -> Found:
        size = self.size[at]
        return Found(self.score[at], self.loss[at], size, self.ids[_runs((np.cumsum(self.size) - self.size)[at], size)])

    @classmethod
    def of(cls, found: list[Best]) -> Found:
        ids = np.fromiter(chain.from_iterable(f.ids for f in found), np.int32)
        return cls(*(np.array([f[k] for f in found], np.int64) for k in (0, 2)), np.array([len(f.ids) for f in found], np.int64), ids)

    def plus(self, *others: Found) -> Found:
        return Found(*map(np.concatenate, zip(self, *others)))


class Known:
    """Remembered segmentations: number of each unit, and what was found."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.found = Found.of([])

    def numbers(self, units) -> np.ndarray:
        """The units' numbers, -1 for unknown ones."""
        return np.fromiter(map(self.number.get, units, repeat(-1)), np.int64, len(units))

    def add(self, units, found: Found) -> None:
        self.number.update(zip(units, range(len(self.number), len(self.number) + len(units))))
        self.found = self.found.plus(found)


class Units(NamedTuple):
    """Units of texts: the distinct ones, the number of every unit's name, and the
    index of each text's first unit, with one more at the end."""
    names: list[str]
    code: np.ndarray
    cuts: np.ndarray


NONE = 1 << 60
_value = itemgetter(0, 1)


class Pieces:
    """Vocabulary of a lattice: text piece -> (id, score), and byte pieces."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int] | None, unknown_id: int = 0, cached_words: int = CACHED_WORDS):
        self.cached_words = cached_words
        self.pieces = {p: (i, round(s * ONE)) for p, (i, s) in pieces.items()}
        self._alone = {i: (i,) for i, _ in pieces.values()}
        self.byte_ids, self.unknown_id = byte_ids, unknown_id
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min((s for _, s in self.pieces.values()), default=0) - UNKNOWN_PENALTY
        self._exact = max([-self.unknown, *(abs(s) for _, s in self.pieces.values())]) < ARRAY_SCORE
        self.text = {i: p for p, (i, _) in pieces.items()}
        self.byte = {i: b for b, i in enumerate(byte_ids or ())}
        top = max([unknown_id, *self.text, *self.byte], default=0)
        # What ids decode to by themselves: all but parts of longer characters.
        plain = {i: chr(b) for i, b in self.byte.items() if b < 128} | self.text
        self.by_id = [plain.get(i) for i in range(top + 1)]
        # The bytes that each id stands for.
        self.raw = pa.array([bytes([self.byte[i]]) if i in self.byte else self.text.get(i, "⁇").encode("utf-8", "surrogatepass") for i in range(top + 1)], pa.binary())
        self._units, self._class = self._unit_pattern(pieces)
        self._known = Known()  # units met since the last turn,
        self._older = Known()  # and in the turn before
        self.words = lru_cache(cached_words // 4)(self._segment)
        self._build_trie()

    @staticmethod
    def _unit_pattern(pieces) -> tuple[re.Pattern | None, np.ndarray | None]:
        """Units: marks, then punctuation, then letters. No piece joins a
        letter with punctuation or a mark after it, nor the characters left
        over with anything; None if a piece joins a mark with what precedes.
        And the class of every character: 0 to 2 in this order, or 3."""
        if any(MARK in p.lstrip(MARK) for p in pieces):
            return None, None
        pairs = {(a, b) for p in pieces for a, b in zip(p, p[1:])}
        joined = {c for pair in pairs for c in pair} - {MARK}
        marks = {c for c in joined if c.isascii() and not c.isalnum()}
        while more := {a for a, b in pairs if b in marks and a not in marks and a != MARK}:
            marks |= more  # what stands before punctuation in a piece goes with it
        sets = [s or {"\0"} for s in (marks, joined - marks)]
        q, w = ("".join(re.escape(c) for c in sorted(s)) for s in sets)
        kinds = np.full(0x110000, 3, np.uint8)
        for kind, chars in ((2, sets[1]), (1, sets[0]), (0, {MARK})):
            kinds[[ord(c) for c in chars]] = kind
        return re.compile(f"{MARK}+[{q}]*[{w}]*|[{q}]+[{w}]*|[{w}]+|.", re.S), kinds

    # -- Lattices of many units at once

    def _build_trie(self) -> None:
        """Transitions (node, character) -> node in one hashed array."""
        nodes, ends = {"": 0}, [(-1, 0)]
        for piece in self.pieces:
            for k in range(1, len(piece) + 1):
                if piece[:k] not in nodes:
                    nodes[piece[:k]] = len(nodes)
                    ends.append((-1, 0))
            ends[nodes[piece]] = self.pieces[piece]
        steps = np.array([(nodes[p[:-1]] << 21 | ord(p[-1]), n) for p, n in nodes.items() if p], np.int64).reshape(-1, 2)
        self._bits = max(10, (len(steps) * 4 - 1).bit_length())
        self._slots = np.full(1 << self._bits, -1, np.int64)
        self._next = np.zeros(1 << self._bits, np.int64)
        self._probes = 0
        left = steps
        while len(left):
            at = self._slot(left[:, 0], self._probes)
            free = np.flatnonzero(self._slots[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self._slots[at[put]], self._next[at[put]] = left[put, 0], left[put, 1]
            left = np.delete(left, put, axis=0)
            self._probes += 1
        self._ends = np.array(ends, np.int64).reshape(-1, 2)
        # Pieces and their beginnings: (score, ids), or None where no piece ends.
        self._begun = {p: (self.pieces[p][1], self._alone[self.pieces[p][0]]) if p in self.pieces else None for p in nodes if p}

    def _slot(self, key: np.ndarray, probe: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((h >> np.uint64(64 - self._bits)).astype(np.int64) + probe) & ((1 << self._bits) - 1)

    def _step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        key = node << 21 | char
        out = np.full(len(key), -1, np.int64)
        todo = np.arange(len(key))
        for probe in range(self._probes):
            at = self._slot(key[todo], probe)
            hit = self._slots[at] == key[todo]
            out[todo[hit]] = self._next[at[hit]]
            todo = todo[~hit & (self._slots[at] >= 0)]
            if not len(todo):
                break
        return out

    def best_of(self, units: list[str]) -> list[Best]:
        """The best segmentation of each unit (none empty), by array steps."""
        found = self._best_of(units)
        ends = np.cumsum(found.size)
        return [Best(s, tuple(found.ids[b - k:b].tolist()), lost) for s, lost, k, b in zip(found.score.tolist(), found.loss.tolist(), found.size, ends)]

    def _best_of(self, units: list[str]) -> Found:
        length = np.array([len(u) for u in units], np.int64)
        order = np.argsort(-length, kind="stable")
        ends, low, blocks = np.cumsum(length[order]), 0, [Found.of([])]
        while low < len(units):
            most = ARRAY_CHARS + (int(ends[low - 1]) if low else 0)
            high = max(low + 1, int(np.searchsorted(ends, most, side="right")))
            blocks.append(self._block([units[i] for i in order[low:high].tolist()], length[order[low:high]]))
            low = high
        back = np.empty(len(units), np.int64)
        back[order] = np.arange(len(units))
        return Found.plus(*blocks).take(back)

    def _block(self, units: list[str], length: np.ndarray) -> Found:
        """Units from the longest on. Row p of an array has the p-th character of
        all units that have one, rows one after the other from ``row[p]`` on; node
        q of a unit is the place after its character q - 1.

        An edge is valued at (64 * score - 1) * 64 + size, so the largest sum has
        the best score, of equal ones the fewest pieces and then the longer last
        piece; sizes are taken off again at every node."""
        text = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        most, first = int(length[0]), np.cumsum(length) - length
        wide = np.searchsorted(-length, -np.arange(1, most + 1), side="right")  # units in a row
        n = wide.tolist()
        row = np.append(0, np.cumsum(wide))
        r = row.tolist()
        chars = np.concatenate([text[first[:w] + p] for p, w in enumerate(n)])
        start = np.arange(len(chars))
        place = np.repeat(np.arange(most), wide)
        rest = length[start - row[place]] - place
        at, node, single = start, np.zeros(len(chars), np.int64), np.zeros(len(chars), bool)
        values, pieces = [], []
        while len(start):
            node = self._step(node, chars[at])
            keep = np.flatnonzero(node >= 0)
            start, at, node, place = start[keep], at[keep], node[keep], place[keep]
            k = len(values) + 1
            piece = self._ends[node]
            hit = np.flatnonzero(piece[:, 0] >= 0)
            value, of = np.full(len(chars), -NONE), np.empty(len(chars), np.int32)
            value[start[hit]], of[start[hit]] = (piece[hit, 1] * 64 - 1) * 64 + k, piece[hit, 0]
            if k == 1:
                single[start[hit]] = True
                value[~single], of[~single] = (self.unknown * 64 - 1) * 64 + 1, -1
            values.append(value)
            pieces.append(of)
            more = np.flatnonzero(rest[start] > k)
            start, node = start[more], node[more]
            at, place = at[more] + wide[place[more]], place[more] + 1
        value, of, sizes = np.array(values), np.array(pieces), len(values)
        # Best value of every node and the size of the piece it is reached by.
        ahead, back = [np.zeros(len(units), np.int64)], np.empty(len(chars), np.uint8)
        for q in range(1, most + 1):
            w = n[q - 1]
            top = ahead[q - 1][:w] + value[0, r[q - 1]:r[q - 1] + w]
            for k in range(2, min(q, sizes) + 1):
                np.maximum(top, ahead[q - k][:w] + value[k - 1, r[q - k]:r[q - k] + w], out=top)
            size = top & 63
            back[r[q - 1]:r[q]] = size
            ahead.append(top - size)
        # And from every node to the end.
        behind = [np.zeros(n[q - 1], np.int64) for q in range(most + 1)]
        for q in range(most - 1, -1, -1):
            top = behind[q][:n[q]] if q else np.zeros(len(units), np.int64)
            top[:] = -NONE
            for k in range(1, min(most - q, sizes) + 1):
                w = n[q + k - 1]
                np.maximum(top[:w], value[k - 1, r[q]:r[q] + w] + behind[q + k], out=top[:w])
        # Pieces of the best path, from the end; they are not in a second best.
        unit, q, taken = np.arange(len(units)), length, []
        total = np.empty(len(units), np.int64)
        for k in range(1, most + 1):
            ending = slice(n[k] if k < most else 0, n[k - 1])
            total[ending] = ahead[k][ending]
        while len(unit):
            size = back[row[q - 1] + unit].astype(np.int64)
            q = q - size
            taken.append((unit, (size - 1) * len(chars) + row[q] + unit))
            keep = np.flatnonzero(q > 0)
            unit, q = unit[keep], q[keep]
        edge = np.concatenate([e for _, e in taken])
        value.reshape(-1)[edge] = -NONE
        second = np.full(len(units), -NONE)
        for q in range(most):
            for k in range(1, min(most - q, sizes) + 1):
                w = n[q + k - 1]
                np.maximum(second[:w], ahead[q][:w] + value[k - 1, r[q]:r[q] + w] + behind[q + k], out=second[:w])
        score, other = ((x >> 6) + 63 >> 6 for x in (total, second))
        loss = np.where(second > -NONE // 2, score - other, NONE)
        # The pieces in the order of the text.
        count = np.bincount(np.concatenate([u for u, _ in taken]), minlength=len(units))
        last, path = np.cumsum(count) - 1, np.empty(len(edge), np.int64)
        for turn, (u, e) in enumerate(taken):
            path[last[u] - turn] = e
        ids = of.reshape(-1)[path]
        unknown = np.flatnonzero(ids < 0)
        if len(unknown):
            parts = [self._spelled(chr(c)) for c in chars[path[unknown]].tolist()]
            long = np.ones(len(ids), np.int64)
            long[unknown] = [len(x) for x in parts]
            count = np.add.reduceat(long, last - count + 1)
            spelled = np.repeat(ids < 0, long)
            ids = np.repeat(ids, long)
            ids[spelled] = list(chain.from_iterable(parts))
        return Found(score, loss, count, ids)

    # -- One lattice

    def _segment_one(self, unit: str) -> Best:
        found = self._segment(unit, 2)
        return Best(*found[0], found[0][0] - found[1][0] if len(found) > 1 else NONE)

    def _edges(self, text: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """For every end position the (start, score, ids) of edges there."""
        ends: list[list] = [[] for _ in range(len(text) + 1)]
        begun, length, longest = self._begun, len(text), self.longest
        for i in range(length):
            single = False
            for j in range(i + 1, min(length, i + longest) + 1):
                try:
                    found = begun[text[i:j]]
                except KeyError:  # no piece begins so
                    break
                if found is not None:
                    single = single or j == i + 1
                    ends[j].append((i, *found))
            if not single:
                ends[i + 1].append((i, self.unknown, self._spelled(text[i])))
        return ends

    def _spelled(self, char: str) -> tuple[int, ...]:
        if self.byte_ids is None:
            return (self.unknown_id,)
        return tuple(self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass"))

    def _segment(self, text: str, n: int) -> tuple[tuple[float, tuple[int, ...]], ...]:
        """The n best (score, ids) of one lattice, best first."""
        ends = self._edges(text)
        best = [0] + [-NONE] * len(text)  # forward: score, fewest pieces
        least = [0] * (len(text) + 1)
        back: list = [None] * (len(text) + 1)
        for j in range(1, len(text) + 1):
            for edge in ends[j]:
                i, score, _ = edge
                value = best[i] + score
                if back[j] is None or value > best[j] or value == best[j] and (least[i] + 1, i) < (least[j], back[j][0]):
                    best[j], least[j], back[j] = value, least[i] + 1, edge
        if n == 1:
            ids, j = [], len(text)
            while j:
                i, _, found = back[j]
                ids.append(found)
                j = i
            return ((best[-1], tuple(x for part in reversed(ids) for x in part)),)
        # Backward A*: (-(score so far + best rest), pieces, position, score,
        # path). Entries stand in the order of their cuts, from the end of the
        # text: an entry's successors take its place, by start.
        agenda = [(-best[-1], least[-1], len(text), 0, None)]
        out = []
        while agenda and len(out) < n:
            top = min(agenda, key=_value)  # the first of equal ones
            at = agenda.index(top)
            _, pieces, j, done, path = top
            if j == 0:
                ids = []
                while path is not None:
                    found, path = path
                    ids.extend(found)
                out.append((done, tuple(ids)))
                del agenda[at]
                continue
            length = pieces - least[j] + 1
            agenda[at:at + 1] = [(-(done + score + best[i]), length + least[i], i, done + score, (found, path)) for i, score, found in ends[j]]
            if len(agenda) > n - len(out):
                last = sorted(map(_value, agenda))[n - len(out) - 1]
                ties = n - len(out) - sum(_value(e) < last for e in agenda)
                agenda = [e for e in agenda if (v := _value(e)) < last or v == last and (ties := ties - 1) >= 0]
        return tuple(out)

    # -- Texts

    def units(self, text: str) -> list[str]:
        """Parts of an escaped text whose lattices are independent."""
        if self._units is None:
            return [text] if text else []
        return self._units.findall(text)

    def coded(self, texts: list[list[str]]) -> Units:
        """Texts that are given as units."""
        flat = list(chain.from_iterable(texts))
        whole = "".join(flat)
        chars = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        return self._coded(whole, chars, np.cumsum([0, *map(len, flat)]), np.cumsum([0, *map(len, texts)]))

    def cut(self, texts: list[str]) -> Units:
        """The units of escaped texts: one ends where the class of the next
        character is smaller, or is or was that of the characters left over."""
        if self._units is None:
            return self.coded([self.units(t) for t in texts])
        whole, ends = "".join(texts), np.cumsum([0, *map(len, texts)])
        chars = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = self._class[chars]
        head = np.ones(len(chars) + 1, bool)
        head[1:-1] = (kind[1:] < kind[:-1]) | (kind[1:] == 3) | (kind[:-1] == 3)
        head[ends] = True
        heads = np.flatnonzero(head)
        return self._coded(whole, chars, heads, np.searchsorted(heads, ends))

    @staticmethod
    def _coded(whole: str, chars: np.ndarray, heads: np.ndarray, cuts: np.ndarray) -> Units:
        wide = np.flatnonzero(chars >= 0x80)
        more = np.cumsum(1 + (chars[wide] >= 0x800) + (chars[wide] >= 0x10000))
        offsets = heads + np.append(0, more)[np.searchsorted(wide, heads)]  # in UTF-8
        data = whole.encode("utf-8", "surrogatepass")
        units = pa.Array.from_buffers(pa.large_binary(), len(heads) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        code = units.dictionary_encode().indices.to_numpy()
        # Names are numbered as they come first.
        first = np.flatnonzero(code > np.append(-1, np.maximum.accumulate(code)[:-1])) if len(code) else code
        return Units([whole[a:b] for a, b in zip(heads[first].tolist(), heads[first + 1].tolist())], code, cuts)

    def forget(self) -> None:
        """Drop the remembered segmentations, not the vocabulary."""
        self._known, self._older = Known(), Known()
        self.words.cache_clear()

    @property
    def _cache(self) -> dict[str, int]:
        """Numbers of the units that are remembered."""
        return self._known.number

    def solve(self, units: list[str]) -> Found:
        """The best segmentation of distinct units, in their order."""
        if len(self._cache) > self.cached_words // 2:  # what is still in use comes back
            self._known, self._older = Known(), self._known
        known, older = self._known, self._older
        new = np.flatnonzero(known.numbers(units) < 0).tolist()
        if older.number and new:
            old = older.numbers([units[i] for i in new])
            again = np.flatnonzero(old >= 0)
            known.add([units[new[i]] for i in again.tolist()], older.found.take(old[again]))
            new = [new[i] for i in np.flatnonzero(old < 0).tolist()]
        limit = ARRAY_LENGTH if self._exact else 0
        short, long, huge = [], [], []
        for i in new:
            u = units[i]
            (short if len(u) <= limit else long if len(u) <= HUGE else huge).append(u)
        known.add(short, self._best_of(short))
        known.add(long, Found.of(list(map(self._segment_one, long))))
        number = known.numbers(units)
        if not huge:
            return known.found.take(number)
        # Too long to be held for later texts; they stand in their order at the end.
        number[number < 0] = len(known.number) + np.arange(len(huge))
        return known.found.plus(Found.of(list(map(self._segment_one, huge)))).take(number)

    def nbest(self, texts: list[list[str]] | Units, n: int) -> list[list[tuple[float, np.ndarray]]]:
        """For each text, given as units, the n best (score, ids), best first.

        The best segmentations of a whole list of texts are put together by
        array steps over the numbers of their units."""
        names, code, cuts = texts if isinstance(texts, Units) else self.coded(texts)
        if not len(code):
            return [[(0.0, np.zeros(0, np.int32))] for _ in range(len(cuts) - 1)]
        best = self.solve(names).take(code)
        ends = np.cumsum(best.size)
        at, total = np.append(0, ends)[cuts].tolist(), np.append(0, np.cumsum(best.score))[cuts].tolist()
        out = []
        for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            out.append(self._ways(names, code[a:b], best.ids[at[k]:at[k + 1]], ends[a:b] - at[k], best.size[a:b], best.loss[a:b], total[k + 1] - total[k], n))
        return out

    def _ways(self, names, code, ids, ends, size, loss, best: int, n: int) -> list[tuple[float, np.ndarray]]:
        """The n best of one text, from the best one and what the second best
        of every unit loses."""
        out = [(best / ONE, ids)]
        if n == 1:
            return out
        # One of the n best changes only some of the n - 1 words that lose
        # least: else these, changed one by one, would all be better.
        some = np.flatnonzero(loss < NONE)
        if len(some) >= n:
            some = some[loss[some] <= np.partition(loss[some], n - 2)[n - 2]]
        order = some[np.argsort(loss[some], kind="stable")][:n - 1].tolist()
        # The r-th of them is changed in the r + 1 best at the earliest.
        units = [names[c] for c in code[order].tolist()]
        ways = {k: (self.words if len(u) <= ARRAY_LENGTH else self._segment)(u, n - r) for r, (k, u) in enumerate(zip(order, units))}
        choices: list[tuple[int, tuple]] = [(0, ())]
        for k in order:
            turns = [(f[0] - ways[k][0][0], c) for c, f in enumerate(ways[k])]
            choices = sorted([(lost - gain, picked + ((k, c),) * (c > 0)) for lost, picked in choices for gain, c in turns],
                             key=lambda x: (x[0], len(x[1]), x[1]))[:n]
        for lost, picked in choices[1:]:
            changed, at = [], 0
            for k, c in sorted(picked):
                changed += [ids[at:ends[k] - size[k]], np.array(ways[k][c][1], np.int32)]
                at = ends[k]
            out.append(((best - lost) / ONE, np.concatenate([*changed, ids[at:]])))
        return out

    def decoded(self, ids: pa.ListArray) -> pa.Array:
        """The bytes that each list of ids decodes to."""
        spelled = pa.ListArray.from_arrays(ids.offsets, self.raw.take(ids.values))
        return pc.binary_join(spelled, b"")

    def decode(self, ids) -> str:
        """The text of ids: pieces, with runs of byte pieces as UTF-8."""
        try:
            return "".join(map(self.by_id.__getitem__, ids))
        except (TypeError, IndexError):  # byte or unknown pieces
            pass
        raw = bytearray()
        for i in ids:
            b = self.byte.get(i)
            if b is not None:
                raw.append(b)
            else:
                raw += self.text.get(i, "⁇").encode("utf-8")
        return raw.decode("utf-8", "replace")


class Model:
    """A vocabulary with the normaliser of its model file."""

    def __init__(self, path: str, scores: str = "rank", cached_words: int = CACHED_WORDS):
        self.reader = sentencepiece.SentencePieceProcessor(model_file=path)
        r, pieces, byte_ids = self.reader, {}, [0] * 256
        for i in range(r.vocab_size()):
            piece = r.id_to_piece(i)
            if r.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
            elif not (r.is_control(i) or r.is_unknown(i) or r.is_unused(i)):
                pieces[piece] = (i, r.get_score(i))
        if scores == "rank":
            rank = {p: k for k, p in enumerate(sorted(pieces, key=lambda p: (-pieces[p][1], pieces[p][0])))}
            total = sum(1 / (k + 1) for k in range(len(pieces)))
            pieces = {p: (i, -math.log((rank[p] + 1) * total)) for p, (i, _) in pieces.items()}
        elif scores != "model":
            raise ValueError("scores: model or rank")
        has_bytes = any(r.is_byte(i) for i in range(r.vocab_size()))
        self.pieces = Pieces(pieces, byte_ids if has_bytes else None, r.unk_id(), cached_words)

    def normalise(self, texts: list[str]) -> list[str]:
        return [self.reader.normalize(t) if t else "" for t in texts]

    def decode(self, ids) -> str:
        text = self.pieces.decode(ids).replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


_models: dict[tuple[str, str, int], Model] = {}


def model(path: str, scores: str, cached_words: int = CACHED_WORDS) -> Model:
    """One model of these settings a process."""
    key = path, scores, cached_words
    if key not in _models:
        _models[key] = Model(path, scores, cached_words)
    return _models[key]


ADDED = T.StructType([
    T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    T.StructField("nbest", T.ArrayType(T.StructType([T.StructField("score", T.DoubleType()), T.StructField("n_pieces", T.IntegerType()),
                                                      T.StructField("ids_key", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType(), False))]))),
    T.StructField("decoded_equal", T.BooleanType())])


def _key(ids) -> int:
    h = xxhash.xxh3_64_intdigest(ids.tobytes())
    return h - (1 << 64) if h >= 1 << 63 else h


def _cuts(lists) -> pa.Array:
    return pa.array(np.cumsum([0, *map(len, lists)]).astype(np.int32))


def _lists(ids) -> pa.ListArray:
    return pa.ListArray.from_arrays(_cuts(ids), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))


def _encode(path: str, scores: str, n: int, piece_bytes: int = PIECE_BYTES, cached_words: int = CACHED_WORDS):
    def run(batches):
        m = model(path, scores, cached_words)
        sole_cache("pieces", m.pieces.forget)
        for batch in batches:
            kept = batch.column(0)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            low = 0
            while low < len(texts):
                high, size = low, 0
                while high < len(texts) and (high == low or size + len(texts[high]) <= piece_bytes):
                    size += len(texts[high])
                    high += 1
                plain = m.normalise(texts[low:high])
                found = m.pieces.nbest(m.pieces.cut(plain), n)
                want, equal = pa.array([t.encode("utf-8", "surrogatepass") for t in plain], pa.binary()), np.ones(len(plain), bool)
                for k in range(n):  # every segmentation is decoded, not the best alone
                    has = [i for i, ways in enumerate(found) if len(ways) > k]
                    if has:
                        equal[has] &= pc.equal(m.pieces.decoded(_lists([found[i][k][1] for i in has])), want.take(pa.array(has))).to_numpy(zero_copy_only=False)
                ways = list(chain.from_iterable(found))
                parts = [pa.array([s for s, _ in ways], pa.float64()), pa.array([len(i) for _, i in ways], pa.int32()),
                         pa.array([_key(i) for _, i in ways], pa.int64()), _lists([i for _, i in ways])]
                nbest = pa.ListArray.from_arrays(_cuts(found), pa.StructArray.from_arrays(parts, ["score", "n_pieces", "ids_key", "ids"]))
                yield pa.RecordBatch.from_arrays([kept.slice(low, high - low), nbest, pa.array(equal)], ["row", "nbest", "decoded_equal"])
                low = high
    return run


def encode(docs: DataFrame, text_col: str = "text", path: str = MODEL, scores: str = "rank", n: int = N_BEST,
           piece_bytes: int = PIECE_BYTES, cached_words: int = CACHED_WORDS, kept: list[str] | None = None) -> DataFrame:
    """All columns, or only those ``kept``, and ids (the best segmentation), nbest (score, number of
    pieces, a 64-bit key of the ids and the ids of the n best), decoded_equal (whether
    decoding gives the normalised text for each of the n best). Columns of these names
    are replaced.

    ``piece_bytes`` characters are encoded at a time and a worker remembers
    ``cached_words`` segmentations: less of both takes less memory and more time and
    gives the same rows."""
    rows = nested_row(docs.drop(*(c for c in ADDED.names if c != text_col)))
    row = F.col("row") if kept is None else F.struct(*[field(c).alias(c) for c in kept if c not in ADDED.names])
    shown = rows.select(row.alias("row"), field(text_col).cast("string").alias("text"))
    schema = T.StructType([shown.schema["row"], *(ADDED[c] for c in ("nbest", "decoded_equal"))])
    out = shown.mapInArrow(releasing(_encode(path, scores, n, piece_bytes, cached_words)), schema)
    return out.select("row.*", F.col("nbest").getItem(0).getField("ids").alias("ids"), "nbest", "decoded_equal")


def decode(tokens: DataFrame, ids_col: str = "ids", path: str = MODEL, scores: str = "rank") -> DataFrame:
    """All columns, and decoded: the text of the ids (null where they are)."""
    def run(batches):
        m = model(path, scores)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if i is None else m.decode(i) for i in batch.column(1).to_pylist()], pa.string())],
                                             ["row", "decoded"])

    rows = nested_row(tokens.drop("decoded"))
    schema = T.StructType([rows.schema["row"], T.StructField("decoded", T.StringType())])
    return rows.select("row", F.col("row").getField(ids_col).alias("ids")).mapInArrow(releasing(run), schema).select("row.*", "decoded")


def op2_sentencepiece(spark, sf_dir: str) -> DataFrame:
    out = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), kept=["doc_id"])
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "nbest", "decoded_equal")
