"""Encoding with a merge-type piece vocabulary, by a score-ordered agenda of adjacent symbol pairs.

A text gets one mark before it, and its spaces become marks. It is parted where no piece can lie across: before a
mark that follows another character, and at line feeds if no piece holds one. In each unit the symbols are its
characters; the agenda holds every adjacent pair that makes up a piece, best score first and leftmost among
equals. Taking a pair merges it and puts its two new neighbours on the agenda. The agendas of short units of one length are
the rows of a table, each of which gives up its best entry in a step of all; a long unit's is a heap of numbers,
whose stale entries are known by their rank, in some 60 bytes a character. Characters of no piece become the pieces of their UTF-8 bytes.

Units repeat, so a worker remembers their ids. The units that are new in an Arrow batch are encoded by the
sentencepiece library too, in one call, behind a character of no piece; `agrees` says for every row whether all of
its units came out alike. Models with pieces that no merge makes (user-defined symbols) show up there.

Defined results: a null or empty text has the begin and end ids alone and decodes to an empty text; repeated
rows are encoded alike, each on its own; very long texts are encoded whole, in groups of units; an empty table
gives no rows; strings of special pieces inside a text are ordinary text; bytes that are not UTF-8 count as
U+FFFD. Other columns are carried unchanged, whatever their names.
"""

from __future__ import annotations

import functools
import heapq
import re
from array import array
from collections import defaultdict
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.work import settle, tidy

MARK = "▁"
#: Units that a worker remembers before it starts afresh, and the longest of them.
REMEMBER, LONGEST = 150_000, 64
#: Symbols of the units whose agendas are rows of a table, and the least number of such rows; characters up to
#: which a text is parted in one go.
SHORT, FEW, AT_ONCE = 48, 4, 1 << 20
#: An id has 20 bits in a pair's key and in an agenda's entry, a place in a heap's entry 40.
_ID, _PLACE = 20, 40
_NONE = 1 << 62
_GONE = -(1 << 31)


@functools.lru_cache(2)
def library(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


class Agenda:
    """Encoder of one model file."""

    def __init__(self, path: str):
        self.library = sp = library(path)
        every = range(sp.get_piece_size())
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        merged = {sp.id_to_piece(i): i for i in every if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
        self.byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in every if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.unused = {i for i in every if sp.is_unused(i)}
        # Pieces by falling score; equal scores share a rank.
        scores = [sp.get_score(i) for p, i in merged.items() if len(p) > 1]
        rank = {s: k for k, s in enumerate(sorted(set(scores), reverse=True))}
        self.pair: dict[int, int] = {}
        for piece, i in merged.items():
            for k in range(1, len(piece)):
                a, b = merged.get(piece[:k]), merged.get(piece[k:])
                if a is not None and b is not None:
                    self.pair[a << _ID | b] = rank[sp.get_score(i)] << _ID | i
        self.keys = np.array([*sorted(self.pair), _NONE])
        self.entries = np.array([*map(self.pair.__getitem__, self.keys[:-1].tolist()), _NONE])
        # Ids of characters; those of no piece are negative.
        self.symbol = -1 - np.arange(0x110000, dtype=np.int32)
        for p, i in merged.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        alphabet = {c for p in merged for c in p}
        # A character of no piece, behind which a unit can be shown to the library.
        self.apart = next(c for c in "\n\x01\U000f0000" if c not in alphabet)
        self.skip = len(sp.encode(self.apart))
        feed = "" if "\n" in alphabet else "\n"
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in merged):
            words = f"[^{feed}]+" if feed else r"(?s:.+)"
        else:
            words = f"{MARK}+[^{MARK}{feed}]*|[^{MARK}{feed}]+"
        self.split = re.compile(f"{words}|{feed}" if feed else words)
        self.known: dict[str, bytes] = {}
        self.wrong: set[str] = set()
        probe = " a  b c "
        if "".join(sp.encode(probe, out_type=str)) != MARK + probe.replace(" ", MARK):
            raise ValueError("the model changes texts before it encodes them, or puts no mark before them")
        self.learn([p for p in list(merged)[:2000] if MARK not in p[1:]])
        if self.wrong:
            raise ValueError("not a merge-type vocabulary: the library encodes its pieces otherwise")

    def encode_units(self, units: list[str]) -> list[list[int]]:
        """The ids of each unit."""
        out: list[list[int]] = [[]] * len(units)
        by_length: dict[int, list[int]] = defaultdict(list)
        for k, u in enumerate(units):
            by_length[len(u)].append(k)
        for n, places in by_length.items():
            text = "".join([units[k] for k in places]).encode("utf-32-le", "surrogatepass")
            ids = self.symbol[np.frombuffer(text, "<u4")].reshape(len(places), n)
            if n <= SHORT and len(places) >= FEW and not self.unused:
                self._by_rows(ids, places, out)
            else:
                for k, own in zip(places, ids):
                    out[k] = self._by_heap(own.tolist())
        for k, ids in enumerate(out):
            if min(ids) < 0:
                out[k] = [x for i in ids for x in ((i,) if i >= 0 else self._bytes(-1 - i))]
        return out

    def _looked_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Agenda entries of pairs, _NONE for those that make up no piece."""
        key = a.astype(np.int64) << _ID | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.entries[at], _NONE)

    def _by_rows(self, ids: np.ndarray, places: list[int], out: list) -> None:
        """Units of one length together: each row of the agenda gives up its best pair, all in one step."""
        where = np.array(places)
        agenda = self._looked_up(ids[:, :-1], ids[:, 1:])
        while len(ids):
            n = ids.shape[1]
            best = (agenda >> _ID).argmin(1) if n > 1 else np.zeros(len(ids), np.intp)
            rows = np.arange(len(ids))
            taken = agenda[rows, best] if n > 1 else np.full(len(ids), _NONE)
            done = taken == _NONE
            if done.any():
                for k, own in zip(where[done].tolist(), ids[done].tolist()):
                    out[k] = own
                ids, agenda, where, best, taken = (x[~done] for x in (ids, agenda, where, best, taken))
                rows = np.arange(len(ids))
                if not len(ids):
                    break
            # The column behind the merged symbol goes; its pair's entry goes from the agenda.
            column = np.arange(n - 1)
            ids = np.take_along_axis(ids, column + (column > best[:, None]), 1)
            ids[rows, best] = taken & ((1 << _ID) - 1)
            column = np.arange(n - 2)
            agenda = np.take_along_axis(agenda, column + (column >= best[:, None]), 1)
            left, right = np.flatnonzero(best > 0), np.flatnonzero(best < n - 2)
            agenda[left, best[left] - 1] = self._looked_up(ids[left, best[left] - 1], ids[left, best[left]])
            agenda[right, best[right]] = self._looked_up(ids[right, best[right]], ids[right, best[right] + 1])

    def _bytes(self, code: int) -> list[int]:
        return [self.byte[b] for b in chr(code).encode()] if self.byte else [self.unknown]

    def _unmade(self, ids: list[int], made: dict[int, tuple[int, int]]) -> list[int]:
        """Pieces that the model does not use, taken apart as they were merged."""
        out, todo = [], ids[::-1]
        while todo:
            i = todo.pop()
            todo.extend(reversed(made[i])) if i in made else out.append(i)
        return out

    def _by_heap(self, ids: list[int]) -> list[int]:
        pair, n, made = self.pair.get, len(ids), {}
        now, after, before = array("i", ids), array("i", range(1, n + 1)), array("i", range(-1, n - 1))
        heap = [v >> _ID << _PLACE | i for i in range(n - 1) if (v := pair(now[i] << _ID | now[i + 1], _NONE)) < _NONE]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            i = entry & ((1 << _PLACE) - 1)
            j = after[i]
            if now[i] == _GONE or j >= n or (v := pair(now[i] << _ID | now[j], _NONE)) >> _ID != entry >> _PLACE:
                continue
            to = v & ((1 << _ID) - 1)
            if to in self.unused:
                made[to] = now[i], now[j]
            now[i], now[j], after[i] = to, _GONE, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (v := pair(to << _ID | now[after[i]], _NONE)) < _NONE:
                    heapq.heappush(heap, v >> _ID << _PLACE | i)
            if before[i] >= 0 and (v := pair(now[before[i]] << _ID | to, _NONE)) < _NONE:
                heapq.heappush(heap, v >> _ID << _PLACE | before[i])
        ids = [i for i in now if i != _GONE]
        return self._unmade(ids, made) if made else ids

    def learn(self, units: list[str]) -> None:
        """Remembers the ids of units, and those that the library encodes otherwise."""
        if not units:
            return
        theirs = self.library.encode([self.apart + u for u in units], num_threads=1)
        for u, ids, checked in zip(units, self.encode_units(units), theirs):
            if ids != checked[self.skip :]:
                self.wrong.add(u)
            self.known[u] = array("I", ids).tobytes()

    def _joined(self, units: list[str]) -> tuple[bytes, bool]:
        """Ids of known and unknown units, and whether all of them agree; long ones are not remembered."""
        known = self.known
        new = []
        try:
            ids = b"".join(map(known.__getitem__, units))
        except KeyError:
            self.learn(new := [u for u in dict.fromkeys(units) if u not in known])
            ids = b"".join(map(known.__getitem__, units))
        agrees = not self.wrong or self.wrong.isdisjoint(units)
        for u in new:
            if len(u) > LONGEST:
                del known[u]
                self.wrong.discard(u)
        return ids, agrees

    def batch(self, texts: list[str], begin: bool, end: bool) -> list[tuple[bytes, bool]]:
        """(ids as little-endian unsigned 32-bit integers, agrees) of each text."""
        first, last = (array("I", [i] * on).tobytes() for i, on in ((self.begin, begin), (self.end, end)))
        parted, new = [], set()
        for text in texts:
            marked = MARK + text.replace(" ", MARK) if text else ""
            parted.append(self.split.findall(marked) if len(marked) <= AT_ONCE else marked)
            if isinstance(parted[-1], list):
                new.update(parted[-1])
        if len(self.known) > REMEMBER:
            self.forget()
        self.learn([u for u in new.difference(self.known) if len(u) <= LONGEST])
        out = []
        for part in parted:
            if isinstance(part, list):
                ids, agrees = self._joined(part)
            else:
                groups = [self._joined([m[0] for m in g]) for g in batched(self.split.finditer(part), 1 << 16)]
                ids, agrees = b"".join(g[0] for g in groups), all(g[1] for g in groups)
            out.append((b"".join((first, ids, last)), agrees))
        return out

    def forget(self) -> None:
        self.known.clear()
        self.wrong.clear()


@functools.lru_cache(2)
def load(path: str) -> Agenda:
    return Agenda(path)


#: Characters of text that are encoded, and checked, together.
TOGETHER = 1 << 20


def encode(df: DataFrame, path: str, text: str = "text", begin: bool = True, end: bool = True) -> DataFrame:
    """(row, ids, n_tokens, agrees): row holds the columns of df as they came, ids is binary of little-endian
    unsigned 32-bit integers."""
    fields = [("ids", pa.binary()), ("n_tokens", pa.int64()), ("agrees", pa.bool_())]

    def run(x: pa.Array) -> pa.Array:
        settle()
        model, rows, held, size = load(path), [], [], 0
        for v in x.cast(pa.large_binary()):
            held.append((v.as_py() or b"").decode("utf-8", "replace"))
            size += len(held[-1])
            if size >= TOGETHER:
                rows += model.batch(held, begin, end)
                held, size = [], 0
        rows += model.batch(held, begin, end)
        out = pa.array([{"ids": b, "n_tokens": len(b) // 4, "agrees": ok} for b, ok in rows], pa.struct(fields))
        del rows, held
        tidy()
        return out

    made = F.arrow_udf(run, "ids binary, n_tokens long, agrees boolean")(F.col(f"`{text}`"))
    out = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), made.alias("m"))
    return out.select("row", *[f"m.{n}" for n, _ in fields])


def decode(ids: Column | str, path: str) -> Column:
    """The text that the library's decode() makes of ids; null of null."""

    def run(x: pa.Array) -> pa.Array:
        settle()
        sp = library(path)
        out = pa.array([None if v.as_py() is None else sp.decode(np.frombuffer(v.as_py(), "<u4").tolist()) for v in x], pa.string())
        tidy()
        return out

    return F.arrow_udf(run, "string")(ids)
