"""Byte-level BPE by a global shuffle of distinct words.

1. Texts are taken in blocks. A block is exploded into its pre-tokens: its distinct words go out in
   one packed row for each bucket of the word hash, its positions (word numbers in text order) in
   one row of their own.
2. Rows meet by bucket. A bucket encodes each distinct word once and sends every block the ids of
   its words. A frequent word is one entry a block and the positions are dealt round the buckets by
   the number of their partition, so no key is hot.
3. Rows meet by block, which puts the ids back by position.

Decoding joins the token-byte table: a vocabulary's size bounds it, so every task holds it and
gathers with numpy.

Defined results: a null or empty text has no ids and decodes to no bytes; repeated rows are each
encoded on their own; a very long text is a block of its own; an empty table gives no rows. Other
columns do not matter and are not carried: ids come with the id column alone.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.work import kept, settle, tidy

#: Characters of text in a block; most buckets.
BLOCK = 16 << 20
BUCKETS = 4096
#: White space as the rank files' library knows it (Unicode White_Space).
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _ranges(chars: set[str]) -> str:
    """The inside of a character class."""
    codes, out = sorted(map(ord, chars)), []
    for c in codes:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


@kept(4)
def splitter(pattern: str):
    """A function text -> its pre-tokens, as the rank files' library splits.

    The library and the regex module may know different Unicode versions, so letters and numbers are
    asked of the library; a text with a character on which they differ is split by its classes.
    """
    import regex
    import tiktoken

    every = "".join(chr(c) for c in (*range(0x40000), *range(0xE0000, 0xE1000)) if not 0xD800 <= c < 0xE000)
    known, odd = {}, set()
    for kind in (r"\p{L}", r"\p{N}"):
        enc = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        known[kind] = set(enc.decode_bytes(enc.encode_ordinary(every)).decode())
        odd |= known[kind] ^ set(regex.findall(kind, every))
    spaced = pattern.replace(r"[^\s", f"[^{_SPACE}").replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]")
    plain = regex.compile(spaced).findall
    if not odd:
        return plain
    exact = spaced
    for kind, chars in known.items():  # inside a class first, then alone
        exact = exact.replace(rf"[^{_SPACE}{kind}", rf"[^{_SPACE}{_ranges(chars)}").replace(rf"{kind}]", rf"{_ranges(chars)}]").replace(kind, f"[{_ranges(chars)}]")
    differs, exact = regex.compile(f"[{_ranges(odd)}]").search, regex.compile(exact).findall
    return lambda text: exact(text) if differs(text) else plain(text)


@kept(2)
def ranks(path: str) -> dict[bytes, int]:
    import base64

    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@kept(2)
def core(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})


@kept(2)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table: starts, lengths, bytes end to end."""
    table = ranks(path)
    size = np.zeros(max(table.values()) + 1, np.int64)
    for b, k in table.items():
        size[k] = len(b)
    start = np.cumsum(size) - size
    flat = np.zeros(int(size.sum()), np.uint8)
    for b, k in table.items():
        flat[start[k] : start[k] + len(b)] = np.frombuffer(b, np.uint8)
    return start, size, flat


def decode(ids: np.ndarray, path: str) -> bytes:
    """The bytes of a sequence of ids, gathered from the token-byte table."""
    start, size, flat = token_bytes(path)
    if not len(ids):
        return b""
    out = []
    for k in range(0, len(ids), 1 << 18):  # bounds the index array of a long text
        part = ids[k : k + (1 << 18)]
        n = size[part]
        end = np.cumsum(n)
        out.append(flat[np.repeat(start[part] - (end - n), n) + np.arange(end[-1])].tobytes())
    return b"".join(out)


class _Units(dict):
    """Packed numbers of the pre-tokens of `before` + word, for one block."""

    def __init__(self, find, number: dict[str, int], before: str):
        self.find, self.number, self.before = find, number, before

    def __missing__(self, word: str) -> bytes:
        number = self.number
        found = self[word] = np.array([number.setdefault(p, len(number)) for p in self.find(self.before + word)], "<u4").tobytes()
        return found


class Block:
    """Distinct pre-tokens and positions of consecutive texts."""

    def __init__(self, find):
        self.find, self.number = find, {}
        self.first, self.spaced = _Units(find, self.number, ""), _Units(find, self.number, " ")
        self.feed = self.first["\n"]
        self.texts: list[bytes] = []
        self.size = 0

    def add(self, text: str) -> None:
        """A space between two other characters always begins a pre-token and a line feed between
        two is one; texts with other white space are split whole."""
        self.size += len(text)
        if " ".join(text.split()) != text.replace("\n", " "):
            number = self.number
            self.texts.append(np.fromiter((number.setdefault(p, len(number)) for p in self.find(text)), "<u4").tobytes())
            return
        a, b = self.first.__getitem__, self.spaced.__getitem__
        lines = (line.split(" ") for line in text.split("\n"))
        self.texts.append(self.feed.join([a(line[0]) + b"".join(map(b, line[1:])) for line in lines]) if text else b"")


def _pack(x: bytes) -> bytes:
    return zlib.compress(x, 1)


def _varint(x: np.ndarray) -> bytes:
    """Numbers of 1 to 5 bytes, seven bits each, the last with its top bit set."""
    n = np.ones(len(x), np.int64)
    for k in (7, 14, 21, 28):
        n += x >= np.uint32(1 << k)
    end = np.cumsum(n)
    out = np.zeros(int(end[-1]) if len(end) else 0, np.uint8)
    for k in range(5):
        has = n > k
        out[(end - n)[has] + k] = (x[has] >> np.uint32(7 * k)) & np.uint32(127)
    out[end - 1] |= 128
    return out.tobytes()


def _unvarint(b: bytes) -> np.ndarray:
    x = np.frombuffer(b, np.uint8)
    last = np.flatnonzero(x & 128)
    if not len(last):
        return np.zeros(0, np.uint32)
    first = np.concatenate([[0], last[:-1] + 1])
    place = np.arange(len(x)) - np.repeat(first, last - first + 1)
    return np.add.reduceat((x & 127).astype(np.uint32) << (7 * place).astype(np.uint32), first)


def _rows(block: Block, at: int, names: list, buckets: int):
    """(bucket, block, kind, a, b): the positions, and each bucket's words with their numbers."""
    counts = np.fromiter((len(t) // 4 for t in block.texts), np.int64, len(block.texts))
    flat = np.frombuffer(b"".join(block.texts), "<u4")
    n = len(block.number)
    order = np.argsort(-np.bincount(flat, minlength=n), kind="stable")  # frequent words get short numbers
    place = np.empty(n, np.uint32)
    place[order] = np.arange(n, dtype=np.uint32)
    head = struct.pack("<q", len(names)) + np.array([x is None for x in names], np.uint8).tobytes() + np.array([x or 0 for x in names], "<i8").tobytes() + counts.astype("<i8").tobytes()
    block.texts = block.first = block.spaced = None  # the words come next
    yield ((at >> 24) + (at & 0xFFFFFF)) % buckets, at, 0, _pack(head), _pack(_varint(place[flat]))
    del flat, head
    words = [w.encode("utf-8", "replace") for w in block.number]
    bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, n)
    by = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[by], np.arange(buckets + 1))
    for k in range(buckets):
        if (own := by[edges[k] : edges[k + 1]]).size:
            own = own[np.argsort(place[own], kind="stable")]  # rising, so the steps are short
            size = np.fromiter((len(words[i]) for i in own), np.uint32, len(own))
            listed = struct.pack("<q", len(own)) + size.tobytes() + b"".join(words[i] for i in own)
            yield k, at, 1, _pack(_varint(np.diff(place[own], prepend=np.uint32(0)))), zlib.compress(listed, 6)


def _encode_bucket(memo: dict, packed: bytes, path: str, pattern: str) -> bytes:
    """The ids of a packed word list: number of words, their counts of ids, the ids."""
    raw = zlib.decompress(packed)
    n = struct.unpack_from("<q", raw)[0]
    size = np.frombuffer(raw, np.uint32, n, 8)
    one, at, found = core(path, pattern)._core_bpe.encode_single_piece, 8 + 4 * n, []
    for k in size.tolist():
        w = raw[at : at + k]
        at += k
        if (ids := memo.get(w)) is None:
            ids = memo[w] = np.array(one(w), "<u4").tobytes()
        found.append(ids)
    return _pack(struct.pack("<q", n) + np.fromiter((len(x) // 4 for x in found), np.uint32, n).tobytes() + b"".join(found))


def _table(rows: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["bucket", "block", "kind", "a", "b"])


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text: str = "text", buckets: int | None = None, block_bytes: int = BLOCK) -> DataFrame:
    """(id, ids) of each row: ids as binary of little-endian unsigned 32-bit integers.

    `buckets` bounds the distinct words of a task; by default one for each shuffle partition, but at
    most BUCKETS, as a block sends each bucket a row and distinct words grow more slowly than texts.
    """
    return _assembled(df, path, pattern, id_col, text, buckets, block_bytes, lambda ids: (ids.astype("<u4").tobytes(),), [("ids", "binary", pa.binary())])


def digest(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text: str = "text", buckets: int | None = None, block_bytes: int = BLOCK) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row; the bytes are decoded from the ids."""
    names: dict[int, str] = {}

    def of(ids: np.ndarray):
        if not names:
            names.update((k, str(k)) for k in range(len(token_bytes(path)[1])))
        said = ",".join(map(names.__getitem__, ids.tolist()))
        return len(ids), hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(decode(ids, path)).hexdigest()

    fields = [("n_tokens", "long", pa.int64()), ("ids_sha256", "string", pa.string()), ("decoded_sha256", "string", pa.string())]
    return _assembled(df, path, pattern, id_col, text, buckets, block_bytes, of, fields)


def _assembled(df, path, pattern, id_col, text, buckets, block_bytes, of, fields) -> DataFrame:
    spark = df.sparkSession
    buckets = buckets or min(BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    # Both shuffles are dealt by number: a bucket is a task, and a block's rows arrive in one.
    schema = "bucket long, block long, kind int, a binary, b binary"

    def explode(batches):
        settle(__name__)
        find, at = splitter(pattern), TaskContext.get().partitionId() << 24
        block, names = Block(find), []
        for batch in batches:
            for name, value in zip(batch["id"].to_pylist(), batch["text"]):
                names.append(name)
                block.add(value.as_py() or "")
                if block.size >= block_bytes:
                    for row in _rows(block, at, names, buckets):
                        yield _table([row])
                    block, names, at = Block(find), [], at + 1
        if names:
            for row in _rows(block, at, names, buckets):
                yield _table([row])
        del block, names
        tidy()

    def encode_words(batches):
        settle(__name__)
        now, memo = None, {}
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    out.append(tuple(row.values()))
                    continue
                if row["bucket"] != now:
                    now, memo = row["bucket"], {}
                out.append((row["bucket"], row["block"], 1, row["a"], _encode_bucket(memo, row["b"], path, pattern)))
            if out:
                yield _table(out)
            del out, batch
        del memo
        tidy()

    def assemble(batches):
        def finish(held):
            head = zlib.decompress(next(r["a"] for r in held if r["kind"] == 0))
            flat = _unvarint(zlib.decompress(next(r["b"] for r in held if r["kind"] == 0)))
            parts = []
            for r in held:
                if r["kind"] == 1:
                    place, raw = np.cumsum(_unvarint(zlib.decompress(r["a"]))), zlib.decompress(r["b"])
                    n = len(place)
                    parts.append((place, np.frombuffer(raw, np.uint32, n, 8).astype(np.int64), np.frombuffer(raw, np.uint32, -1, 8 + 4 * n)))
            total = sum(len(p) for p, _, _ in parts)
            size, start, base = np.zeros(total, np.int64), np.zeros(total, np.int64), 0
            for place, n, ids in parts:
                size[place], start[place] = n, base + np.cumsum(n) - n
                base += len(ids)
            ids = np.concatenate([i for _, _, i in parts]) if parts else np.zeros(0, np.uint32)
            n = struct.unpack_from("<q", head)[0]
            nulls, names, counts = np.frombuffer(head, np.uint8, n, 8), np.frombuffer(head, "<i8", n, 8 + n), np.frombuffer(head, "<i8", n, 8 + 9 * n)
            at, out = 0, []
            for k in range(n):
                own = flat[at : at + counts[k]]
                at += counts[k]
                many = size[own]
                end = np.cumsum(many)
                got = ids[np.repeat(start[own] - (end - many), many) + np.arange(end[-1])] if len(own) else ids[:0]
                out.append((None if nulls[k] else int(names[k]), *of(got)))
                if len(out) == 500:
                    yield batch_of(out)
                    out = []
            if out:
                yield batch_of(out)

        def batch_of(out):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [pa.int64(), *(k for _, _, k in fields)])], [id_col, *(n for n, _, _ in fields)])

        settle(__name__)
        held: list = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["block"] != held[0]["block"]:
                    yield from finish(held)
                    held = []
                held.append(row)
        if held:
            yield from finish(held)
        del held
        tidy()

    packed = rows.mapInArrow(explode, schema).repartitionById(buckets, F.col("bucket").cast("int")).sortWithinPartitions("bucket")
    back = packed.mapInArrow(encode_words, schema).repartition("block").sortWithinPartitions("block")
    return back.mapInArrow(assemble, f"`{id_col}` long, " + ", ".join(f"{n} {k}" for n, k, _ in fields))
