"""Token operators against their libraries, on odd texts and on the documents of sf0.001."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from tessera.llm import arrow_store, bpe_shuffle, repetition, transducer

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n", "  a  b", "a\n\nb", " lead", "trail ", "don't we'll 'S '", "a\tb\r\nc", "x y z　w", "\x1c a\x1fb", "日本語 テスト", "😀 é", "<|endoftext|> a<|endoftext|>b", "▁▁x <s> </s> <unk>", "a" * 3000, "word " * 5000, "ab\n" * 400, "٣٤ ²³ ½ _x_"]


def odd_texts(n=300):
    rnd = random.Random(5)
    alphabet = "aeinst'  \n\t.,é日😀9▁<|>"
    return ODD + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, t, f"s{i}", i) for i, t in enumerate(odd_texts())]
    docs = [(1000 + r.doc_id, r.text, "x", 0) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    return spark.createDataFrame(rows + docs + [(1, "", "copy", 1), (None, "null id", "c", 2)], "doc_id long, text string, ids string, row long")


def test_transducer_counts(frame):
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = transducer.with_token_counts(frame, path).collect()
    assert len(rows) == frame.count()
    for r in rows:
        t = r.row.text or ""
        assert (r.n_bytes, r.n_tokens) == (len(t.encode()), len(sp.encode(t))), t[:80]
        assert r.over_limit == (r.n_tokens > 4096)


def test_transducer_without_spaces_in_linear_memory():
    """Japanese without a space: equal to the library, and the maps of 5 million characters in little memory."""
    import tracemalloc

    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    sp, machine = sentencepiece.SentencePieceProcessor(model_file=path), transducer.load(path)
    rnd = random.Random(2)
    part = "".join(rnd.choice("日本語のテストはとてもながいぶんしょうです一二三") for _ in range(5000))
    rare = "".join(chr(rnd.randrange(0x4E00, 0x9FA0)) for _ in range(5000))
    for t in (part, rare, part[:3000] + rare + " " + part, part + "\n" * 3 + rare):
        assert machine.count(t, 1000) == len(sp.encode(t))
    one = machine.count(part)
    tracemalloc.start()
    many = machine.count(part * 1000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6 and abs(many - 1000 * one) <= 2000


def test_transducer_on_empty_and_full_tables(spark, monkeypatch):
    """No rows; states and words that are dropped and made again."""
    path = P.path("piece_bpe_32k.model")
    assert transducer.with_token_counts(spark.createDataFrame([], "doc_id long, text string"), path).count() == 0
    machine = transducer.load(path)
    texts = [t for t in odd_texts(60) if t and 20 < len(t) < 60][:4]
    want = [machine.count(t) for t in texts]
    monkeypatch.setattr(transducer, "STATES", 10)
    monkeypatch.setattr(transducer, "REMEMBER", 3)
    assert [machine.count(t, 20) for t in texts] == want


@pytest.mark.parametrize("chunk", [1, 2, 7, 50])
def test_transducer_chunks_compose(chunk):
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    sp, machine = sentencepiece.SentencePieceProcessor(model_file=path), transducer.load(path)
    for t in odd_texts(200):
        if len(t or "") < 500:
            assert machine.count(t, chunk) == len(sp.encode(t or "")), t


def test_arrow_round_trip(spark, frame, tmp_path):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    tk = Tokenizer.from_file(path)
    got = arrow_store.write_and_digest(frame, path, 2, length=64, file_ids=5000).collect()
    docs = sorted(frame.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert len(got) == len(docs)
    want, start = {}, 0
    for d in docs:
        ids = tk.encode(d.text or "", add_special_tokens=False).ids + [2]
        want.setdefault(d.doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for name in want:
        assert sorted((r.n_tokens, r.ids_crc32) for r in got if r.doc_id == name) == sorted(want[name])
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == [d.doc_id for d in docs]
    assert arrow_store.write_and_digest(frame.limit(0), path).count() == 0


def test_manifest_finds_sequences(spark, frame, tmp_path):
    import pyarrow as pa

    path, folder = P.path("byte_bpe_50k.json"), str(tmp_path / "files")
    arrow_store.write(frame, folder, path, 2, length=64, file_ids=3000)
    files = sorted(arrow_store.manifest(spark, folder).collect(), key=lambda r: r.base_sequences)
    assert len(files) > 3 and files[0].base_sequences == files[0].base_ids == 0
    for a, b in zip(files, files[1:]):
        assert b.base_sequences == a.base_sequences + a.sequences and b.base_ids == a.base_ids + a.ids
    f = files[2]
    with pa.memory_map(f.path.removeprefix("file:")) as m:
        ids, mask = arrow_store.sequence(pa.ipc.open_file(m), f.sequences - 1)
        assert len(ids) == 64 and sum(mask.to_pylist()) == f.ids - 64 * (f.sequences - 1)


def test_words_go_one_by_one_only_where_the_file_allows(tmp_path):
    """A file with another pre-tokenizer: whole texts go to the library, and results agree."""
    import json

    from tokenizers import Tokenizer

    stated = json.load(open(P.path("byte_bpe_50k.json"), encoding="utf-8"))
    stated["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "t.json").write_text(json.dumps(stated))
    enc, lib = arrow_store.WordEncoder(str(tmp_path / "t.json")), Tokenizer.from_file(str(tmp_path / "t.json"))
    assert not enc.by_word and arrow_store.encoder(P.path("byte_bpe_50k.json")).by_word
    texts = [t for t in odd_texts(50) if t]
    assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(texts)] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_are_forgotten_and_learnt_again(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(arrow_store, "REMEMBER", 5)
    enc, lib = arrow_store.WordEncoder(P.path("byte_bpe_50k.json")), Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = [f"the caf\u00e9, {w}!? (x) don't {w}s\nThe end. {w} 12" for w in "one two three four five six seven eight".split()]
    for t in texts * 2:
        assert np.frombuffer(enc.encode([t, "the end."])[0], enc.dtype).tolist() == lib.encode(t, add_special_tokens=False).ids
        assert len(enc.words) <= 5


def test_arrow_random_access():
    import pyarrow as pa

    docs = [(k, np.arange(k * 10, dtype="<u2").tobytes()) for k in range(1, 40)]
    blob = arrow_store.arrow_file(docs, 16, np.dtype("<u2"))
    file, flat = pa.ipc.open_file(pa.py_buffer(blob)), np.concatenate([np.frombuffer(b, "<u2") for _, b in docs])
    ids, mask = arrow_store.sequence(file, 131)
    assert ids.to_numpy(zero_copy_only=True).tolist() == flat[131 * 16 : 132 * 16].tolist() and all(mask.to_pylist())
    assert [(d, x.tobytes()) for d, _, x in arrow_store.documents_of(blob)] == docs


def test_word_shuffle_bpe(frame):
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    tt = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=table, special_tokens={})
    want = sorted((str(r.doc_id), tt.encode_ordinary(r.text or "")) for r in frame.collect())
    got = bpe_shuffle.encode(frame, path, P.PATTERN, block_bytes=5000).collect()
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in got) == want
    sha = lambda b: hashlib.sha256(b).hexdigest()
    whole = sorted((str(r.doc_id), len(i), sha(",".join(map(str, i)).encode()), sha((r.text or "").encode())) for r in frame.collect() for i in [tt.encode_ordinary(r.text or "")])
    got = bpe_shuffle.digest(frame, path, P.PATTERN, buckets=3).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == whole
    assert bpe_shuffle.digest(frame.limit(0), path, P.PATTERN).count() == 0


def test_position_rows_are_spread():
    """Blocks of many partitions do not meet in a few buckets."""
    block = bpe_shuffle.Block(bpe_shuffle.splitter(P.PATTERN))
    block.add("a b")
    counts, number = {}, block.number
    for at in (p << 24 for p in range(2000)):
        block.texts, block.number = [b"\0" * 4], number
        k = next(bpe_shuffle._rows(block, at, [1], 64))[0]
        counts[k] = counts.get(k, 0) + 1
    assert len(counts) == 64 and max(counts.values()) < 80


def test_splitter_matches_library_on_all_characters():
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    enc, find = bpe_shuffle.core(path, P.PATTERN), bpe_shuffle.splitter(P.PATTERN)
    for low in (*range(0, 0x36000, 4096), 0xE0000, 0xF0000):
        text = "".join(f"a{chr(c)}{chr(c)}1 {chr(c)}" for c in range(low, low + 4096) if not 0xD800 <= c < 0xE000)
        ours = [i for p in find(text) for i in enc._core_bpe.encode_single_piece(p.encode())]
        assert ours == enc.encode_ordinary(text), hex(low)


def brute_repeats(words, n):
    at = {}
    for i in range(len(words) - n + 1):
        at.setdefault(tuple(words[i : i + n]), []).append(i)
    return {i + k for s in at.values() if len(s) > 1 for i in s for k in range(n)}


def test_repetition_against_brute_force(spark, frame):
    rnd = random.Random(3)
    more = [(i, " ".join(rnd.choice("a b cc d\ne".split(" ")) for _ in range(rnd.randint(0, 80)))) for i in range(200)]
    both = frame.select("doc_id", "text", "ids").unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    for r in repetition.repetition(both).collect():
        t, s = r.row.text or "", r.stats
        words = t.encode().split()
        words = [w.decode() for w in words]
        lines = [x for x in t.split("\n") if x.encode().split()]
        assert s.n_words == len(words) and s.word_chars == sum(map(len, words))
        assert s.n_symbols == sum(c in "#*$%&|<>" for c in t)
        assert s.n_dup_lines == len(lines) - len(set(lines))
        assert s.n_repeat_words == len(brute_repeats(words, 5))
        assert list(s.covered_chars) == [sum(len(words[i]) for i in brute_repeats(words, n)) for n in (3, 5, 7, 10)]
        assert r.base_failed == (len(words) < 10 or 100 * s.n_repeat_words > 20 * len(words))
    assert set(repetition.keep_clean(frame).columns) == set(frame.columns)
    assert repetition.keep_clean(frame.limit(0)).count() == 0 and repetition.repetition(frame.limit(0)).count() == 0


def test_repetition_survives_hash_collisions(monkeypatch):
    texts = [b"a b c d e f a b c d e", b"q w e r t y u i o p"]
    want = repetition.measure(texts, (5, 7, 10))
    monkeypatch.setattr(repetition, "_mix", lambda x: x * np.uint64(0))
    assert repetition.measure(texts, (5, 7, 10)) == want and want[0]["n_repeat_words"] == 10


def test_long_repeats_decide_below_the_base_share(spark):
    words = [f"w{i:04}" for i in range(400)]
    said = words[:22]
    texts = [
        " ".join(words[:228] + said),  # 44 of 250 words under repeated 10-grams, 17.6 percent
        " ".join(words[:260] + said),  # 15.6 percent
        " ".join(words[:88] + words[:9]),  # a short text, 18 of 97 words and 90 characters, 18.6 percent
        " ".join(w for w in words[:12] for _ in range(4)),  # every word four times: no five words twice, but three
    ]
    rows = repetition.repetition(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.row.doc_id: (r.base_failed, r.kept) for r in rows} == {0: (False, False), 1: (False, True), 2: (False, True), 3: (False, False)}
    assert [r.doc_id for r in repetition.keep_clean(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()] == [1, 2]
