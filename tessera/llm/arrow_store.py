"""Token ids in Arrow files of equal-length sequences.

Documents are laid end to end in ascending id order and cut into sequences of `length` ids. A file
holds record batches with input_ids: fixed_size_list<uint16 or uint32>[length], mask:
fixed_size_list<bool>[length] (false: padding, only in a file's last sequence), and doc_ids and
doc_offsets, the documents that begin in the sequence. Sequence i of a file is row i % batch of batch
i // batch, found without reading or copying the rest; a manifest says in which file a sequence of the whole is. A file ends with a
document.

Spark commits the files: each is one row of the text sink, whose line separator supplies the
last bytes of the Arrow file format. So any store that Spark writes will do, and a lost executor's
tasks are repeated without leaving half a file.

Defined results: a null or empty text is a document of the end id alone; documents with equal ids
stand next to each other and are not merged; a null id stands first; an empty table gives no file
and no row; other columns do not matter.
"""

from __future__ import annotations

import functools
import json
import os
import re
import sys
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.work import drop_at_exit, new_path, settle, stash, tidy

MAGIC = b"ARROW1"
#: Ids after which a file is closed at the next document end.
FILE_IDS = 4 << 20
BATCH = 64
#: Words whose ids a worker remembers, and marks of words met; characters of text encoded together.
REMEMBER, MET, TOGETHER = 400_000, 1 << 22, 2 << 20

#: Letters (such in every Unicode version), then marks or none: one or two pre-tokens.
_LETTERS = re.compile(r"([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]+)([!-/:-@\[-`{-~]*)").fullmatch
#: The byte-level pre-tokenizer's pattern as it is on ASCII without white space but for the space before a word.
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ A-Za-z0-9]+").findall


def _alphabet() -> dict[int, str]:
    """Byte to character as byte-level vocabularies spell bytes: printable ones as themselves, the others
    in order from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in shown)
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(others)}


def _plain(text: str) -> bool:
    """Whether all white space is single spaces and line feeds between other characters."""
    if text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
        return False
    # Printable characters have no white space among them but the space.
    return text.replace("\n", "").isprintable() or " ".join(text.split()) == text.replace("\n", " ")


class _Memo(dict):
    """Ids, as bytes, of words behind a space, or with the line feed before them. A word is remembered from its
    second time on, as most new words never come again; `met` marks the hashes of words that were met. Both are
    bounded: a full memo starts afresh and soon has the frequent words again."""

    def __init__(self, encoder: WordEncoder):
        self.encoder, self.met, self.marked = encoder, bytearray(MET), 0

    def __missing__(self, word: str) -> bytes:
        ids, k = self.encoder.word(word), hash(word) % MET
        if self.met[k]:
            if len(self) >= REMEMBER:
                self.clear()
            self[word] = ids
        else:
            self.met[k] = 1
            self.marked += 1
            if self.marked > MET // 2:
                self.met, self.marked = bytearray(MET), 0
        return ids


class WordEncoder:
    """Whole-text ids of a byte-level tokenizers file.

    A space between two characters that are not white space always begins a pre-token, and a line
    feed between two such characters is one, so a text whose white space is no more than that is
    encoded word by word through a memo; any other text goes to the library whole. A new word whose
    pre-tokens are plain (letters with marks behind them, or ASCII) goes to the library's model by
    pre-token, any other to the library. All this is so for the plain byte-level pre-tokenizer only: with a
    file that states another, every text goes whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            stated = json.load(f)
        before, model = stated.get("pre_tokenizer") or {}, stated["model"]
        self.by_word = (
            before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not stated.get("normalizer")
            and model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        )
        if self.by_word:
            self.library.model._resize_cache(0)  # the memos stand in for the library's own
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.one, self.spelling = self.library.model.tokenize, str.maketrans(_alphabet())
        self.words, self.marks = _Memo(self), {}
        self.feed = self._ids(["\n"])[0]

    def _ids(self, texts: list[str]) -> list[bytes]:
        out = []
        for k in range(0, len(texts), 2000):
            found = self.library.encode_batch_fast(texts[k : k + 2000], add_special_tokens=False)
            out += [np.array(e.ids, self.dtype).tobytes() for e in found]
        return out

    def model(self, *pieces: str) -> bytes:
        """The ids of pre-tokens, by the library's model."""
        raw = array(self.code, [t.id for p in pieces for t in self.one((p if p.isascii() else p.encode().decode("latin-1")).translate(self.spelling))])
        if sys.byteorder == "big":
            raw.byteswap()
        return raw.tobytes()

    def word(self, word: str) -> bytes:
        """The ids of a word without white space behind a space, or with the line feed before it."""
        if word[0] == "\n":
            before, ids, word = "", self.feed, word[1:]
        else:
            before, ids = " ", b""
        if (m := _LETTERS(word)) is not None:
            core, marks = m.groups()
            if not marks:
                return ids + self.model(before + core)
            if (after := self.marks.get(marks)) is None:
                after = self.model(*_ASCII(marks))
                if len(self.marks) < REMEMBER:
                    self.marks[marks] = after
            return (self.words[core] if before else ids + self.model(core)) + after
        if word.isascii():
            return ids + self.model(*_ASCII(before + word))
        return ids + self._ids([before + word])[0]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes of self.dtype."""
        ids_of, size, out, whole = self.words.__getitem__, len(self.feed), [], []
        for text in texts:
            if not text or not self.by_word or any(t in text for t in self.added) or not _plain(text):
                whole.append(len(out))
                out.append(b"")
                continue
            out.append(b"".join(map(ids_of, f"\n{text.replace("\n", " \n")}".split(" ")))[size:])
        for k, ids in zip(whole, self._ids([texts[k] for k in whole])):
            out[k] = ids
        return out


@functools.lru_cache(4)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def arrow_file(docs: list[tuple[int | None, bytes]], length: int, dtype: np.dtype) -> bytes:
    """One file of documents (id, bytes of ids), in their order."""
    ids = np.frombuffer(b"".join(b for _, b in docs), dtype)
    n = -(-len(ids) // length)
    full = np.zeros(n * length, dtype)
    full[: len(ids)] = ids
    mask = np.ones(n * length, bool)
    mask[len(ids) :] = False
    starts = np.cumsum([0] + [len(b) // dtype.itemsize for _, b in docs])[:-1]
    rows = np.searchsorted(starts, np.arange(n + 1) * length)
    doc_ids = pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array([d for d, _ in docs], pa.int64()))
    offsets = pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(starts % length, pa.int32()))
    table = pa.table({
        "input_ids": pa.FixedSizeListArray.from_arrays(pa.array(full), length),
        "mask": pa.FixedSizeListArray.from_arrays(pa.array(mask), length),
        "doc_ids": doc_ids,
        "doc_offsets": offsets,
    })
    sink = pa.BufferOutputStream()
    schema = table.schema.with_metadata({b"length": str(length).encode(), b"ids": str(len(ids)).encode()})
    with pa.ipc.new_file(sink, schema) as out:
        out.write_table(table.replace_schema_metadata(schema.metadata), max_chunksize=BATCH)
    return sink.getvalue().to_pybytes()


def sequence(file: pa.ipc.RecordBatchFileReader, i: int) -> tuple[pa.Array, pa.Array]:
    """Ids and mask of sequence i, as views of the file's memory."""
    batch = file.get_batch(i // BATCH)
    return batch["input_ids"][i % BATCH].values, batch["mask"][i % BATCH].values


def documents_of(content: bytes | pa.Buffer):
    """(id, ids) of each document of a file, in order; ids is an array of the file's type."""
    file = pa.ipc.open_file(pa.py_buffer(content))
    total, length = int(file.schema.metadata[b"ids"]), int(file.schema.metadata[b"length"])
    batches = [file.get_batch(k) for k in range(file.num_record_batches)]
    ids = np.concatenate([b["input_ids"].flatten().to_numpy() for b in batches])[:total]
    starts, names, row = [], [], 0
    for b in batches:
        where = np.repeat(np.arange(row, row + b.num_rows), b["doc_offsets"].value_lengths().to_numpy())
        starts += (where * length + b["doc_offsets"].flatten().to_numpy()).tolist()
        names += b["doc_ids"].flatten().to_pylist()
        row += b.num_rows
    for name, a, z in zip(names, starts, [*starts[1:], total]):
        yield name, a, ids[a:z]


def write(df: DataFrame, folder: str, tokenizer: str, end_id: int, length: int = 2048, id_col: str = "doc_id", text: str = "text", file_ids: int = FILE_IDS) -> None:
    """Encodes every text, appends end_id and writes the files in ascending id order.

    The one shuffle ranges the texts by id; ids never pass through a shuffle. A task holds one file.
    """
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))

    def build(batches):
        settle()
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        held, size = [], 0

        def close():
            blob = arrow_file(held, length, enc.dtype)
            return pa.RecordBatch.from_arrays([pa.array([blob[: -len(MAGIC)]], pa.binary())], ["file"])

        def parts(batch):
            """Names and texts, about TOGETHER characters at a time."""
            names, texts, n = [], [], 0
            for name, text in zip(batch["id"].to_pylist(), batch["text"]):
                names.append(name)
                texts.append(text.as_py() or "")
                n += len(texts[-1])
                if n >= TOGETHER:
                    yield names, texts
                    names, texts, n = [], [], 0
            if names:
                yield names, texts

        for batch in batches:
            for names, texts in parts(batch):
                for name, ids in zip(names, enc.encode(texts)):
                    held.append((name, ids + end))
                    size += len(ids) // enc.dtype.itemsize + 1
                    if size >= file_ids:
                        yield close()
                        held, size = [], 0
        if held:
            yield close()
        del held
        tidy()

    ordered = rows.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first())
    files = ordered.mapInArrow(build, "file binary").select(F.col("file").cast("string"))
    files.write.option("lineSep", MAGIC.decode()).option("maxRecordsPerFile", 1).text(folder)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    number = lambda p: F.regexp_extract("path", p, 1).cast("long")
    files = spark.read.format("binaryFile").load(f"{folder}/part-*")
    return files.select("path", number(r"part-(\d+)-[^/]*$").alias("part"), number(r"-c(\d+)\.[^/]*$").alias("file"), "content")


def _read(spark: SparkSession, folder: str, value, kind: pa.DataType, name: str) -> DataFrame:
    """(part, file, doc_id, local_start, n_tokens, name: value(ids)) of every document written."""

    def parse(batches):
        for batch in batches:
            for part, number, content in zip(batch["part"].to_pylist(), batch["file"].to_pylist(), batch["content"]):
                out = []
                for d, a, x in documents_of(content.as_buffer()):
                    out.append((part, number, d, a, len(x), value(x)))
                    if len(out) == 1000:
                        yield table(out)
                        out = []
                if out:
                    yield table(out)

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (*[pa.int64()] * 5, kind))], ["part", "file", "doc_id", "local_start", "n_tokens", name])

    return _files(spark, folder).mapInArrow(parse, f"part long, file long, doc_id long, local_start long, n_tokens long, {name} {'long' if kind == pa.int64() else 'binary'}")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(part, file, doc_id, local_start, n_tokens, ids binary of little-endian uint32) of every document written."""
    return _read(spark, folder, lambda x: x.astype("<u4").tobytes(), pa.binary(), "ids")


def _bases(files: DataFrame, *counts: str) -> DataFrame:
    """files (part, file, ...) with base_<count>, the sum of each count over all files before. Windows run inside
    a part, and over one row a part, so none holds more rows than there were tasks, or files of a task."""
    inside = Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = files.groupBy(F.col("part").alias("_part")).agg(*[F.sum(c).alias(f"_{c}") for c in counts])
    sums = sums.select("_part", *[F.coalesce(F.sum(f"_{c}").over(over), F.lit(0)).alias(f"_{c}") for c in counts])
    own = files.withColumns({f"base_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in counts})
    joined = own.join(sums, F.col("part") == F.col("_part"))
    return joined.select(*files.columns, *[(F.col(f"base_{c}") + F.col(f"_{c}")).alias(f"base_{c}") for c in counts])


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(path, part, file, sequences, ids, base_sequences, base_ids) of each file: sequence i of all is sequence
    i - base_sequences of the file with the greatest base_sequences that is i or less."""
    kinds = ("path", pa.string()), ("part", pa.int64()), ("file", pa.int64()), ("sequences", pa.int64()), ("ids", pa.int64())

    def parse(batches):
        for batch in batches:
            for path, part, number, content in zip(*[batch[c].to_pylist() for c in ("path", "part", "file")], batch["content"]):
                file = pa.ipc.open_file(content.as_buffer())
                rows = sum(file.get_batch(k).num_rows for k in range(file.num_record_batches))
                found = path, part, number, rows, int(file.schema.metadata[b"ids"])
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, (_, k) in zip(found, kinds)], [n for n, _ in kinds])

    files = _files(spark, folder).mapInArrow(parse, "path string, part long, file long, sequences long, ids long")
    return _bases(stash(files, "manifest"), "sequences", "ids")


def digest(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 per document, from the files alone."""
    docs = stash(_read(spark, folder, lambda x: zlib.crc32(x.astype("<u4")), pa.int64(), "ids_crc32"), "digest")
    base = _bases(docs.groupBy("part", "file").agg(F.sum("n_tokens").alias("n")), "n").select("part", "file", "base_n")
    return docs.join(base, ["part", "file"]).select("doc_id", (F.col("base_n") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def write_and_digest(df: DataFrame, tokenizer: str, end_id: int = 2, length: int = 2048, **kw) -> DataFrame:
    spark = df.sparkSession
    folder = new_path(spark, "arrow")
    write(df, folder, tokenizer, end_id, length, **kw)
    drop_at_exit(spark, folder)
    if not any(True for _ in spark.read.format("binaryFile").load(folder).select("path").limit(1).collect()):
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return digest(spark, folder)
