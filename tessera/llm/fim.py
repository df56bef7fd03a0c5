"""Fill-in-the-middle: texts cut into prefix, middle and suffix and put in another order between sentinels.

One table-driven automaton over bytes does the reading. Its states are the product of a UTF-8 position (how many
continuation bytes are due) and a matcher of the sentinels; a transition has a count, 1 where a code point begins,
and a mark where a sentinel ends. Texts are laid out in lanes of WIDTH bytes that take their steps together in
numpy. A lane's entry state needs only the bytes just before it: when the automaton is compiled, the number of
bytes after which its state no longer depends on where it began is found by following sets of states. The first
scan leaves a count of code points for each lane; a second pass finds a cut's lane in the running counts and
walks through that lane alone.

Cuts come from the sha256 of `seed:id`, so that every run and every layout of partitions agrees.

Defined results: a null or empty text has no code points and stays plain, as an empty text; a null id is hashed as
the word null; repeated rows are cut alike; a very long text is read in parts, whole; an empty table gives no
rows; a text that holds a sentinel stays plain. Bytes that are not UTF-8 are kept: each one that continues
nothing counts as a code point. Other columns are carried unchanged, whatever their names.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.work import settle, tidy

#: Bytes of a lane, and of the lanes that take their steps together.
WIDTH, SLICE = 256, 1 << 20
#: The byte value that stands for "no byte" in a lane's unused places.
PAD = 256
SENTINELS = ("<P>", "<S>", "<M>")


class Automaton:
    """Tables by state * 257 + byte: next state, code points begun, sentinels ended."""

    def __init__(self, sentinels: tuple[bytes, ...]):
        for a in sentinels:
            for b in sentinels:
                if not a or any(a[k:] == b[: len(a) - k] for k in range(1, len(a))) or (a != b and a in b):
                    raise ValueError("sentinels must not be empty, overlap or hold one another")
        heads = sorted({s[:k] for s in sentinels for k in range(len(s) + 1)}, key=lambda h: (len(h), h))

        def matched(seen: bytes) -> bytes:
            return next(seen[k:] for k in range(len(seen) + 1) if seen[k:] in known)

        known, index, todo = set(heads), {(0, b""): 0}, [(0, b"")]
        to, begins, ends = [], [], []
        for due, seen in todo:  # grows while states are met
            row = np.zeros((3, PAD + 1), np.int64)
            for byte in range(PAD):
                inside = due > 0 and 0x80 <= byte < 0xC0
                left = due - 1 if inside else 1 if 0xC2 <= byte < 0xE0 else 2 if 0xE0 <= byte < 0xF0 else 3 if 0xF0 <= byte < 0xF5 else 0
                now = matched(seen + bytes([byte]))
                if (left, now) not in index:
                    index[left, now] = len(index)
                    todo.append((left, now))
                row[:, byte] = index[left, now], not inside, now in sentinels
            row[0, PAD] = index[due, seen]
            to.append(row[0])
            begins.append(row[1])
            ends.append(row[2])
        self.next, self.begins, self.ends = (np.concatenate(x).astype(np.uint16) for x in (to, begins, ends))
        self.sync = self._sync(np.array(to)[:, :PAD])

    @staticmethod
    def _sync(table: np.ndarray) -> int:
        """Bytes after which the state is the same from wherever it began."""
        sets, n = {frozenset(range(len(table)))}, 0
        while any(len(s) > 1 for s in sets):
            sets, n = {frozenset(table[list(s), b].tolist()) for s in sets for b in range(PAD)}, n + 1
            if n > WIDTH:
                raise ValueError("the state depends on more than a lane")
        return n

    def scan(self, texts: list[bytes]) -> list[tuple[np.ndarray, bool]]:
        """For each text the code points begun in each of its lanes, and whether it holds a sentinel."""
        counts, hit = [np.zeros(-(-len(t) // WIDTH), np.int32) for t in texts], [False] * len(texts)
        parts, lanes = [], 0
        for i, text in enumerate(texts):
            for start in range(0, len(text), SLICE):
                parts.append((i, start))
                lanes += -(-len(text[start : start + SLICE]) // WIDTH)
                if lanes * WIDTH >= SLICE:
                    self._run(texts, parts, lanes, counts, hit)
                    parts, lanes = [], 0
        if parts:
            self._run(texts, parts, lanes, counts, hit)
        return list(zip(counts, hit))

    def _run(self, texts, parts, lanes, counts, hit) -> None:
        flat = np.full(lanes * WIDTH, PAD, np.uint16)
        before = np.full((lanes, self.sync), PAD, np.uint16)
        spans, at = [], 0
        for i, start in parts:
            own = np.frombuffer(texts[i], np.uint8, min(SLICE, len(texts[i]) - start), start)
            n = -(-len(own) // WIDTH)
            flat[at * WIDTH : at * WIDTH + len(own)] = own
            before[at + 1 : at + n] = flat[at * WIDTH : (at + n - 1) * WIDTH].reshape(n - 1, WIDTH)[:, WIDTH - self.sync :]
            if start:
                before[at] = np.frombuffer(texts[i], np.uint8, self.sync, start - self.sync)
            spans.append((i, start // WIDTH, at, at + n))
            at += n
        state, begun, ended = np.zeros(lanes, np.intp), np.zeros(lanes, np.int32), np.zeros(lanes, bool)
        for column in np.ascontiguousarray(before.T):
            state = self.next[state * (PAD + 1) + column].astype(np.intp)
        for column in np.ascontiguousarray(flat.reshape(lanes, WIDTH).T):
            k = state * (PAD + 1) + column
            begun += self.begins[k]
            ended |= self.ends[k] > 0
            state = self.next[k].astype(np.intp)
        for i, lane, a, b in spans:
            counts[i][lane : lane + b - a] = begun[a:b]
            hit[i] = hit[i] or bool(ended[a:b].any())

    def locate(self, text: bytes, running: np.ndarray, unit: int) -> int:
        """The byte at which a code point begins; running[k] counts those begun before lane k."""
        if unit >= running[-1]:
            return len(text)
        lane = int(np.searchsorted(running, unit, "right")) - 1
        due, state, start = unit - int(running[lane]), 0, lane * WIDTH
        for byte in text[max(0, start - self.sync) : start]:
            state = int(self.next[state * (PAD + 1) + byte])
        for at, byte in enumerate(text[start : start + WIDTH], start):
            k = state * (PAD + 1) + byte
            if self.begins[k]:
                if due == 0:
                    return at
                due -= 1
            state = int(self.next[k])
        raise AssertionError("the lane's count and its bytes disagree")


@functools.lru_cache(8)
def automaton(sentinels: tuple[str, ...]) -> Automaton:
    return Automaton(tuple(s.encode() for s in sentinels))


def rearrange(texts: list[bytes], draws: list[tuple[int, int, int, int]], sentinels: tuple[str, str, str], percent: int, spm: int) -> list[dict]:
    """The form, lengths and output of each text; draws are four numbers of each."""
    machine, (p, s, m) = automaton(sentinels), (x.encode() for x in sentinels)
    out = []
    for text, (counts, hit), (h1, h2, h3, h4) in zip(texts, machine.scan(texts), draws):
        running = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        n = int(running[-1])
        row = {"n": n, "form": "plain", "prefix_chars": None, "middle_chars": None, "output": text}
        if n and not hit and h3 % 100 < percent:
            a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
            i, j = machine.locate(text, running, a), machine.locate(text, running, b)
            prefix, middle, suffix = text[:i], text[i:j], text[j:]
            form = "spm" if h4 % 100 < spm else "psm"
            whole = [s, suffix, p, prefix, m, middle] if form == "spm" else [p, prefix, s, suffix, m, middle]
            row |= {"form": form, "prefix_chars": a, "middle_chars": b - a, "output": b"".join(whole)}
        out.append(row)
    return out


def rebuilt(output: bytes | None, form: str | None, sentinels: tuple[str, str, str] = SENTINELS) -> bytes | None:
    """The text that an output and its form came from. The three sentinels stand there once each."""
    if output is None or form == "plain":
        return output
    p, s, m = (x.encode() for x in sentinels)
    if form == "psm":
        prefix, rest = output[len(p) :].split(s, 1)
        suffix, middle = rest.split(m, 1)
    else:
        suffix, rest = output[len(s) :].split(p, 1)
        prefix, middle = rest.split(m, 1)
    return prefix + middle + suffix


def draws(id_col: Column, seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit numbers from the sha256 of seed:id."""
    said = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(said, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", seed: int = 1, percent: int = 90, spm: int = 20, sentinels: tuple[str, str, str] = SENTINELS
) -> DataFrame:
    """(row, n, form, prefix_chars, middle_chars, output): row holds the columns of df as they came, n counts code
    points, output is binary. `percent` of the texts are cut, `spm` percent of these with the suffix first."""
    automaton(sentinels)
    fields = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.binary())]

    def run(x: pa.Array, a: pa.Array, b: pa.Array, c: pa.Array, d: pa.Array) -> pa.Array:
        settle()
        texts = [v.as_py() or b"" for v in x.cast(pa.large_binary())]
        rows = rearrange(texts, list(zip(*(v.to_pylist() for v in (a, b, c, d)))), sentinels, percent, spm)
        out = pa.array(rows, pa.struct(fields))
        tidy()
        return out

    made = F.arrow_udf(run, "n long, form string, prefix_chars long, middle_chars long, output binary")(F.col(f"`{text}`"), *draws(F.col(f"`{id_col}`"), seed))
    out = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), made.alias("m"))
    return out.select("row", *[f"m.{n}" for n, _ in fields])


def restore(output: Column | str, form: Column | str, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text, as binary, that an output and its form came from."""

    def run(x: pa.Array, kinds: pa.Array) -> pa.Array:
        return pa.array([rebuilt(v.as_py(), f, sentinels) for v, f in zip(x, kinds.to_pylist())], pa.binary())

    return F.arrow_udf(run, "binary")(output, form)
