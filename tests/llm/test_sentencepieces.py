import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from shelfwise.llm import sentencepieces
from shelfwise.llm.sentencepieces import decode, decode_ids, encode, encode_texts, load_model

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return load_model(PATH)


def texts():
    rng = random.Random(12)
    bits = ["a", "b", "th", "e", " ", "  ", "▁", "é", "漢", "語", "😀", "\n", "the", "ing", "<0x0A>", "<s>", "</s>", "0", "ß", "ا", "\0"]
    out = ["", " ", "  a", " " * 70 + "x" + " " * 33, "\t\t  \n   ", "▁▁ ▁", "x" * 5000, "ab" * 3000, "=" * 2047, "�"]
    out += ["".join(rng.choices(bits, k=rng.randint(0, 60))) for _ in range(1500)]
    out += ["".join(chr(rng.choice([rng.randint(1, 0x7FF), rng.randint(0x800, 0xD7FF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(30)) for _ in range(300)]
    return out


def test_ids_and_texts_are_the_librarys(model, library):
    given = texts()
    ids, offsets = encode_texts(model, given)
    wanted = library.encode(given, add_bos=True, add_eos=True, num_threads=1)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == wanted
    assert decode_ids(model, ids.astype(np.int64), offsets) == [library.decode(w) for w in wanted]


def test_rounds_agree_with_one_merge_at_a_time(model, library, monkeypatch):
    monkeypatch.setattr(sentencepieces, "LONG_WORD", 0)
    given = texts()[:400]
    ids, offsets = encode_texts(model, given)
    wanted = library.encode(given, add_bos=True, add_eos=True, num_threads=1)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == wanted


def test_long_texts_are_encoded_in_blocks(model, library, monkeypatch):
    monkeypatch.setattr(sentencepieces, "BLOCK_BYTES", 50)
    rng = random.Random(1)
    for _ in range(20):
        text = " ".join("".join(rng.choices("abthe  é漢▁", k=rng.randint(0, 9))) for _ in range(200))
        assert encode_texts(model, [text])[0].tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_any_ids_decode_like_the_library(model, library):
    rng = random.Random(2)
    rows = [[rng.choice([rng.randrange(32_000), rng.randrange(3, 259), 0, 1, 28705]) for _ in range(rng.randint(0, 12))] for _ in range(2000)]
    offsets = np.cumsum([0, *map(len, rows)])
    assert decode_ids(model, np.array(sum(rows, []), np.int64), offsets) == [library.decode(r) for r in rows]


@pytest.mark.parametrize("packed", [True, False])
def test_rows(spark, library, packed):
    given = [None, "", "plain text", "plain text", "漢字 " * 3, "word " * 60_000, "y" * 200_000]
    rows = [(k % 5, t, "clash", None, k) for k, t in enumerate(given)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, decoded string, row int")
    found = decode(encode(docs, PATH, packed), PATH)
    assert set(found.columns) == {"doc_id", "text", "row", "n_tokens", "ids", "decoded"}
    for r in found.collect():
        want = library.encode(given[r.row] or "", add_bos=True, add_eos=True)
        ids = np.frombuffer(r.ids, "<u4").tolist() if packed else r.ids
        assert (r.doc_id, r.text, ids, r.n_tokens, r.decoded) == (r.row % 5, given[r.row], want, len(want), given[r.row] or "")
    assert decode(encode(docs.where("false"), PATH, packed), PATH).count() == 0


def test_null_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, [None, 40_000, -3]), (3, [])], "doc_id int, ids array<int>")
    assert {r.doc_id: r.decoded for r in decode(rows, PATH).collect()} == {1: "", 2: " ⁇ " * 3, 3: ""}


def test_other_models_are_refused(tmp_path):
    with open(PATH, "rb") as file:
        data = file.read()
    (tmp_path / "unigram.model").write_bytes(data.replace(b"tok_v0\x18\x02", b"tok_v0\x18\x01"))
    with pytest.raises(ValueError):
        load_model(str(tmp_path / "unigram.model"))
