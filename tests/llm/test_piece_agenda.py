"""The agenda against the sentencepiece library, on odd texts and on the documents of sf0.001."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest

from tessera.llm import piece_agenda, queries

SF = "/root/testdata/sf0.001"
PATH = P.path("piece_bpe_32k.model")
ODD = [None, "", " ", "\n", "  a  b", "a\n\nb", " lead", "trail ", "a\tb\r\nc", "\x00 a\x00b", "日本語 テスト", "😀 é", "▁▁x ▁ <s> </s> <unk> <0x0A>", "a" * 3000, "ab\n" * 400, " " * 500, "word " * 5000]


def odd_texts(n=400):
    rnd = random.Random(11)
    return ODD + ["".join(rnd.choice("aeinst'  \n\t.,é日😀9▁<|>") for _ in range(rnd.randint(0, 90))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def ids(row):
    return np.frombuffer(row, "<u4").tolist()


def test_rows_against_the_library(spark, library):
    """Nulls in any column, repeated rows, clashing names; ids, counts and the decoded text."""
    rows = [(i, t, None, i) for i, t in enumerate(odd_texts())] + [(None, "null id", "x", None), (2, "twice", "y", 1), (2, "twice", "y", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, row long")
    out = piece_agenda.encode(df, PATH).withColumn("back", piece_agenda.decode("ids", PATH)).collect()
    assert len(out) == len(rows)
    for r in out:
        want = library.encode(r.row.text or "", add_bos=True, add_eos=True)
        assert (ids(r.ids), r.n_tokens, r.agrees, r.back) == (want, len(want), True, library.decode(want)), r.row.text
    assert sorted(map(str, (r.row for r in out))) == sorted(map(str, df.collect()))
    bare = piece_agenda.encode(df, PATH, begin=False, end=False).filter("row.text IS NULL").first()
    assert (bytes(bare.ids), bare.n_tokens) == (b"", 0)
    assert piece_agenda.encode(df.limit(0), PATH).count() == 0


def test_query_against_the_library(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op11_piece_agenda"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        said = hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.agrees) == (len(want), said, True)
        assert r.decoded_sha256 == hashlib.sha256(library.decode(want).encode()).hexdigest()


def test_both_kinds_of_agenda(monkeypatch):
    """Rows of a table and heaps give the same, also when words are forgotten and long texts are grouped."""
    model, texts = piece_agenda.Agenda(PATH), [t or "" for t in odd_texts()]
    want = model.batch(texts, True, True)
    for name, value in (("SHORT", 0), ("AT_ONCE", 10), ("REMEMBER", 5), ("LONGEST", 2)):
        monkeypatch.setattr(piece_agenda, name, value)
        model.forget()
        assert model.batch(texts, True, True) == want
        assert [x for k in range(0, len(texts), 7) for x in model.batch(texts[k : k + 7], True, True)] == want


def test_a_text_without_a_break(library):
    """Half a million characters in one unit, common and rare ones, in bounded memory."""
    import tracemalloc

    rnd, model = random.Random(4), piece_agenda.Agenda(PATH)
    text = "".join(rnd.choice("日本語のテストはとてもながいぶんしょうです") if rnd.random() < 0.9 else chr(rnd.randrange(0x4E00, 0x9FA0)) for _ in range(500_000))
    assert ids(model.batch([text], False, False)[0][0]) == library.encode(text)
    tracemalloc.start()
    model.encode_units([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6


def test_what_differs_from_the_library_is_told(spark):
    """A unit that the library encodes otherwise marks its texts, and only those."""
    model = piece_agenda.Agenda(PATH)
    model.forget()
    gone = model.library.piece_to_id("▁something")
    model.pair = {k: v for k, v in model.pair.items() if v & ((1 << 20) - 1) != gone}
    told = [ok for _, ok in model.batch(["x y", "something else again", "", "x"], True, True)]
    assert told == [True, False, True, True]


def test_other_models_are_refused(tmp_path):
    with pytest.raises(Exception):
        piece_agenda.Agenda(str(tmp_path / "none.model"))
