import random

import public_tokenizers
from helpers import corpus, documents

from dayshape.llm.token_counts import PrefixCounter, counter, counts_at, prefix_counts, truncated

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "   a", "\n\n  a", "a" + " " * 50 + "b", "▁ ▁x", "<s> </s> <unk> <0x41>", "\x00 y", "😀😀 ﬁ é", "x" * 300, "日本語テスト 　"]


def texts(seed):
    rnd = random.Random(seed)
    return ODD + [" " * k for k in range(2, 40)] + ["".join(rnd.choice(" abt▁\né😀.e") for _ in range(rnd.randrange(60))) for _ in range(300)]


def test_every_prefix_has_the_library_s_count():
    own = counter(PATH)
    for text in texts(1):
        steps = b"".join(own.steps(part)[1] for part in own.split(text))
        wanted = [len(own.library.encode(text[:k])) for k in range(len(text) + 1)] if text else []
        assert counts_at(steps).tolist() == wanted, text


def test_counts_of_a_table(spark, rows):
    every = [*texts(2), *corpus(1), None]
    own = counter(PATH).library
    wanted = [(i, len((t or "").encode()), len(own.encode(t or ""))) for i, t in enumerate(every)]
    docs = documents(spark, every, n_tokens="x", steps="y")
    assert rows(prefix_counts(docs, PATH, False), "doc_id", "n_bytes", "n_tokens") == sorted(wanted, key=repr)
    assert prefix_counts(docs.limit(0), PATH).count() == 0


def test_truncation_without_encoding_again(spark):
    every = texts(3)
    own = counter(PATH).library
    counts = prefix_counts(documents(spark, every), PATH)
    for r in truncated(counts, budget=7).collect():
        text = every[r.doc_id]
        fitting = [k for k in range(len(text) + 1) if len(own.encode(text[:k])) <= 7]
        assert (r.n_chars, r.n_kept, r.tokens_kept) == (len(text), max(fitting), len(own.encode(text[: max(fitting)])))


def test_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b c")], "doc_id long, text string")
    assert sorted((r.doc_id or -1, r.n_tokens) for r in prefix_counts(docs, PATH).collect()) == [(-1, 2), (1, 1), (1, 1)]


def test_no_piece_is_looked_for_behind_the_one_that_fits():
    class Node(dict):
        def get(self, key, default=None):
            visits.append(key)
            return super().get(key, default)

    def watched(node):
        return Node({k: v if k == "" else watched(v) for k, v in node.items()})

    visits, chunk = [], "▁uncharacteristically"
    own = PrefixCounter(PATH)
    whole = 0  # steps of walks to the end of every branch
    for end in range(1, len(chunk) + 1):
        node = own.backwards
        for char in reversed(chunk[:end]):
            whole += 1
            if (node := node.get(char)) is None:
                break
    own.backwards = watched(own.backwards)
    assert own.worked_out(chunk)[-1] == len(own.library.encode(chunk[1:]))
    assert len([v for v in visits if v]) < whole
