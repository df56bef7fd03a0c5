"""Token counts by a compiled finite-state transducer.

A piece vocabulary with scored merges has this property: the encoding of every prefix ends in one
token T, the only suffix in the vocabulary that is compatible with the last token of what stands
before it (the two encode to themselves side by side). So a state needs no more than the longest
suffix that can still begin a piece, and for each boundary inside it the last token and the number
of tokens, relative to here. A transition carries the emitted count, which is negative where tokens
merge. The paths of all pieces are compiled when a vocabulary is loaded; transitions that only some
text takes are added to the table when it does.

Every text is cut into chunks, and a chunk is a map from entry state to (exit state, count). The state
is known, whatever stood before, at a break (a word mark behind another character, which no piece
crosses) and behind a character of no piece. From the first such place on the map is constant, so it is
stored as the text before that place, a count and an exit state; the words in between are constant maps
too, kept by word. Maps compose associatively: a scan in pairs joins the chunks of a text in memory that
is linear in it, also where a text has no such place.

Defined results: a null or empty text has 0 tokens and 0 bytes; repeated rows count alike, each on
its own; very long texts are cut into chunks, never truncated; an empty table gives no rows; other
columns are carried unchanged.
"""

from __future__ import annotations

import functools
import heapq
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.work import settle, tidy

MARK = "▁"
CHUNK = 1 << 15
#: Words whose count a worker remembers before it starts afresh, and the longest of them.
REMEMBER, LONGEST = 400_000, 64
#: States kept compiled; beyond it a worker compiles afresh before its next chunk.
STATES = 300_000


class Transducer:
    """score: piece -> merge score, higher merges first; characters in no piece cost their UTF-8 bytes."""

    def __init__(self, score: dict[str, float]):
        self.score = score
        self.prefixes = {p[:i] for p in score for i in range(1, len(p))}
        self.alphabet = {c for p in score for c in p}
        feed = "" if "\n" in self.alphabet else "\n"
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in score):  # pieces cross breaks: only line feeds part words
            words = f"[^{feed}]+" if feed else r"(?s:.+)"
        else:
            words = f"{MARK}+[^{MARK}{feed}]*|[^{MARK}{feed}]+"
        self.split = re.compile(f"{words}|{feed}" if feed else words).findall
        self.compatible = functools.lru_cache(1 << 18)(self._compatible)
        self.counts = _Counts(self)
        self.reset()

    def reset(self) -> None:
        """The start state and the paths of all pieces."""
        self.states: list = [START]
        self.index = {START: 0}
        self.next: list[dict[str, tuple[int, int]]] = [{}]
        for piece in self.score:
            self.run(0, piece)

    def intern(self, key: tuple) -> int:
        """The number of a state."""
        if (to := self.index.get(key)) is None:
            to = self.index[key] = len(self.states)
            self.states.append(key)
            self.next.append({})
        return to

    def merge(self, text: str) -> list[str]:
        """The encoding of a short string by repeated best merge, leftmost first among equals."""
        parts, after = list(text), list(range(1, len(text) + 1))
        before = list(range(-1, len(text) - 1))
        heap: list = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(parts) and (s := self.score.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-s, i, j, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, a, b = heapq.heappop(heap)
            if parts[i] != a or parts[j] != b or after[i] != j:
                continue
            parts[i], parts[j], after[i] = a + b, "", after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [p for p in parts if p]

    def _compatible(self, a: str, b: str) -> bool:
        """Whether b, a piece that stands by itself, stays apart from a token a before it (or none)."""
        return self.merge(a + b) == ([a, b] if a else [b])

    def step(self, state: int, char: str) -> tuple[int, int]:
        """(next state, emitted count), compiled when first asked for."""
        if (known := self.next[state].get(char)) is not None:
            return known
        if char not in self.alphabet:  # not remembered: there is no end of such characters
            return 0, len(char.encode("utf-8", "replace"))
        window, ends, counts = self.states[state]
        window += char
        for j in range(len(window)):
            piece = window[j:]
            if piece in self.score and self.compatible(ends[j], piece):
                break
        else:
            raise ValueError(f"no token ends at {char!r} after {window[:-1]!r}: not such a vocabulary")
        count = counts[j] + 1
        keep = next((k for k in range(len(window)) if window[k:] in self.prefixes), len(window))
        key = (window[keep:], (*ends, piece)[keep:], tuple(c - count for c in (*counts, count)[keep:]))
        found = self.next[state][char] = (self.intern(key), count)
        return found

    def run(self, state: int, text: str) -> tuple[int, int]:
        """(exit state, tokens emitted) over text whose spaces are marks already."""
        total, table = 0, self.next
        for char in text:
            found = table[state].get(char) or self.step(state, char)
            state = found[0]
            total += found[1]
        return state, total

    def count(self, text: str | None, chunk: int = CHUNK) -> int:
        """Tokens of a whole text: one mark goes before it, spaces are marks."""
        if not text:
            return 0
        marked = MARK + text.replace(" ", MARK)
        return scan(self, [ChunkMap.of(self, marked[i : i + chunk]) for i in range(0, len(marked), chunk)]).apply(self, START)[1]


#: The state before a text: (window, last token at each of its boundaries, counts relative to its end).
START = ("", ("",), (0,))


class _Counts(dict):
    """The constant maps of words that begin where the state is known: their counts."""

    def __init__(self, machine: Transducer):
        self.machine = machine

    def __missing__(self, word: str) -> int:
        n = self.machine.run(0, word)[1]
        if len(word) <= LONGEST:
            if len(self) >= REMEMBER:
                self.clear()
            self[word] = n
        return n


class ChunkMap:
    """State map of a chunk: run `head` from the entry state; if closed, then add count and go to exit."""

    __slots__ = ("head", "count", "exit", "closed")

    def __init__(self, head: str, count: int = 0, exit: tuple = START, closed: bool = False):
        self.head, self.count, self.exit, self.closed = head, count, exit, closed

    @classmethod
    def of(cls, machine: Transducer, marked: str) -> ChunkMap:
        if len(machine.states) > STATES:
            machine.reset()
        first, *words = machine.split(marked)
        # The first word may go on from the chunk before, up to a character of no piece.
        end = next((k for k, c in enumerate(first, 1) if c not in machine.alphabet), 0)
        if not (words or end):
            return cls(marked)
        if end == len(first):
            words = words or [""]
        else:
            words = [first[end:], *words] if end else words
        head = first[:end] or first
        count = sum(map(machine.counts.__getitem__, words[:-1]))
        state, n = machine.run(0, words[-1])
        return cls(head, count + n, machine.states[state], True)

    def apply(self, machine: Transducer, state: tuple) -> tuple[tuple, int]:
        to, n = machine.run(machine.intern(state), self.head)
        return (self.exit, n + self.count) if self.closed else (machine.states[to], n)

    def then(self, machine: Transducer, other: ChunkMap) -> ChunkMap:
        """This map, then the other; associative."""
        if not self.closed:
            return ChunkMap(self.head + other.head, other.count, other.exit, other.closed)
        state, n = other.apply(machine, self.exit)
        return ChunkMap(self.head, self.count + n, state, True)


def scan(machine: Transducer, maps: list[ChunkMap]) -> ChunkMap:
    """The composition of all maps, neighbours in pairs, in a logarithmic number of rounds."""
    while len(maps) > 1:
        odd = maps[len(maps) & ~1 :]
        maps = [maps[i].then(machine, maps[i + 1]) for i in range(0, len(maps) - 1, 2)] + odd
    return maps[0]


@functools.lru_cache(4)
def load(path: str) -> Transducer:
    """The transducer of a sentencepiece BPE model with byte fallback and no text normalisation."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    score = {
        sp.id_to_piece(i): sp.get_score(i)
        for i in range(sp.get_piece_size())
        if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
    }
    return Transducer(score)


def token_count(text: Column | str, path: str, chunk: int = CHUNK) -> Column:
    """A struct (n_bytes, n_tokens) of a text column."""
    kind = pa.struct([("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(x: pa.Array) -> pa.Array:
        settle()
        machine = load(path)
        rows = ((len(b), machine.count(b.decode("utf-8", "replace"), chunk)) for v in x.cast(pa.large_binary()) for b in [v.as_py() or b""])
        out = pa.array([{"n_bytes": b, "n_tokens": n} for b, n in rows], kind)
        tidy()
        return out

    return F.arrow_udf(run, "n_bytes long, n_tokens long")(text)


def with_token_counts(df: DataFrame, path: str, text: str = "text", limit: int = 4096) -> DataFrame:
    """(row, n_bytes, n_tokens, over_limit): row holds the columns of df as they came."""
    out = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), token_count(F.col(f"`{text}`"), path).alias("c"))
    return out.select("row", "c.n_bytes", "c.n_tokens", (F.col("c.n_tokens") > limit).alias("over_limit"))
