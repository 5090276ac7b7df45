import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import corpus, documents, words
from tokenizers import Tokenizer

from dayshape.llm.packing import OpenSequences, packed, sequences, word_ids

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "\n\n a", "<|endoftext|> a<|endoftext|>b <|startoftext|>", "it's IT'S don't we'll", "À ́x é",
    "\x85a\x1cb c　d e", "İstanbul ΣΑΣ ßẞ", "the, the. the.. ., ...a,", "日本語 😀😀 क़ ﬁ", "x" * 3000, "a\tb\rc\x0bd\x00e",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_are_the_library_s(library):
    rnd = random.Random(1)
    texts = ODD + ["".join(rnd.choice("abE .,'\n\té!1<|>") for _ in range(rnd.randrange(80))) for _ in range(600)]
    made = word_ids(PATH).of(texts)
    for text, ids in zip(texts, made, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_pieces_and_places(spark, library):
    texts = [*corpus(5, 60, 80), *ODD, " ".join(words(random.Random(2), 4000))]
    docs = documents(spark, texts, piece="x", length="y")
    got = packed(docs, PATH, length=64, docs_per_task=50).collect()
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(ids)
    for doc, parts in by_doc.items():
        parts.sort(key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts)))
        assert [r.length for r in parts[:-1]] == [64] * (len(parts) - 1)
        assert [r.start for r in parts] == [64 * k for k in range(len(parts))]
        assert sum(r.length for r in parts) == len(ids[doc])
        for r in parts:
            piece = np.array(ids[doc][r.start : r.start + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(piece)
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == np.cumsum([0] + [r.length for r in parts[:-1]]).tolist()
        assert sum(r.length for r in parts) <= 64
    least = -(-sum(len(x) for x in ids.values()) // 64)
    assert len(by_sequence) <= 1.05 * least + 8
    whole = {r.sequence_id: r for r in sequences(docs, packed(docs, PATH, 64, docs_per_task=50), PATH).collect()}
    assert sum(r.n_tokens for r in whole.values()) == sum(len(x) for x in ids.values())
    assert all(len(r.ids) == 4 * r.n_tokens for r in whole.values())


def test_null_ids_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    got = packed(docs, PATH).collect()
    assert sorted((r.doc_id or -1, r.length) for r in got) == [(-1, 1), (1, 3), (1, 3)]
    assert len({r.sequence_id for r in got}) == 1
    assert packed(docs.limit(0), PATH).count() == 0


def test_best_fit_and_which_closes_first():
    bins = OpenSequences(10, most=2)
    assert bins.place(4) == (0, 0)
    assert bins.place(7) == (1, 0)
    assert bins.place(3) == (1, 7)  # the fuller one fits best
    assert bins.place(8) == (2, 0)
    assert bins.place(9) == (3, 0)  # fits nowhere; two are open; it is the fullest, so it closes
    assert bins.place(2) == (2, 8)
    assert bins.place(6) == (0, 4)
